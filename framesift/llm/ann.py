"""Nearest neighbours by largest inner product, with adaptive dimension scans.

Inner products become distances by one more component that evens out the norms.  All vectors are turned
by one random rotation, so that the first components of a difference are a random sample of it.
Within each probed list, distances are summed over blocks of columns; after each block a hypothesis
test drops the candidates whose partial distance is already too large for their query's threshold.
The threshold is the distance to the k-th neighbour in a bounded sample, which is an upper bound.
Survivors get the exact inner product of the original vectors in double precision.

How many lists to probe is set on sample queries, so that the lists hold the wished share of their
true neighbours.  Defined results: vectors that are null, zero, of another length than the commonest or
hold null or non-finite components take no part; null ids take no part; ties go to the smaller id; a query
never finds rows with its own id; with fewer candidates than k all are returned; an empty table is an
empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut
from . import ivf

COLUMNS = 16  # per block
EPSILON = 2.1  # of the test: larger values drop fewer candidates
SPARSE = 0.02  # share of pairs left from which on they are followed one by one
RECALL = 0.97  # share of sample neighbours that the probed lists must hold
FOUND = "query_id long, vec_id long, score double"


class Index:
    """Rotation, centroids and the bounded sample with its ids."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, largest: float, lists: int, k: int, seed: int = 2) -> None:
        rng = np.random.default_rng(seed)
        width = points.shape[1] + 1
        self.largest = largest  # squared norm
        self.rotation = np.linalg.qr(rng.standard_normal((width, width)))[0]
        self.ids, self.points, self.k = ids, points, k
        turned = self.turn(points)
        self.centres = ivf.kmeans(turned, lists)
        self.probes = self._probes(turned, rng)

    def turn(self, points: np.ndarray, query: bool = False) -> np.ndarray:
        rest = np.zeros(len(points)) if query else np.sqrt(np.maximum(0.0, self.largest - (points**2).sum(1)))
        return np.hstack([points, rest[:, None]]) @ self.rotation

    def ranked(self, queries: np.ndarray) -> np.ndarray:
        """Lists of each turned query, nearest first."""
        return np.argsort((self.centres**2).sum(1) - 2 * queries @ self.centres.T, axis=1, kind="stable")

    def _probes(self, turned: np.ndarray, rng) -> int:
        some = rng.choice(len(turned), min(128, len(turned)), replace=False)
        owner, _ = ivf.nearest(turned, self.centres)
        score = self.points[some] @ self.points.T
        score[np.arange(len(some)), some] = -np.inf
        k = min(self.k, len(turned) - 1)
        if k < 1:
            return len(self.centres)
        true = np.argpartition(-score, k - 1, axis=1)[:, :k]
        order = self.ranked(self.turn(self.points[some], query=True))
        place = np.empty_like(order)
        np.put_along_axis(place, order, np.arange(order.shape[1])[None, :].repeat(len(order), 0), axis=1)
        needed = np.sort(np.take_along_axis(place, owner[true], axis=1).ravel())
        return int(needed[min(len(needed) - 1, int(np.ceil(RECALL * len(needed))))]) + 1


def _best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best rows of each query: larger score, then smaller id."""
    order = np.lexsort((ids, -score, query))
    owner = query[order]
    first = np.searchsorted(owner, owner, side="left")
    return order[np.arange(len(order)) - first < k]


def scan(queries: np.ndarray, threshold: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, row) that no test dropped; inputs are turned, thresholds are squared distances."""
    width = queries.shape[1]
    q = r = partial = None
    bound = threshold * (1 + 1e-9) + 1e-9
    # products of whole blocks round more than differences do; pairs within that of a limit stay
    slack = 1e-12 * ((queries**2).sum(1).max(initial=0.0) + (rows**2).sum(1).max(initial=0.0))
    whole, open_ = np.zeros((len(queries), len(rows))), np.ones((len(queries), len(rows)), bool)
    for start in range(0, width, COLUMNS):
        stop = min(width, start + COLUMNS)
        a, b = queries[:, start:stop], rows[:, start:stop]
        limit = bound * (stop / width) * (1 + EPSILON / np.sqrt(stop)) ** 2 if stop < width else bound
        if q is None:  # while many pairs are left, a product for all is cheaper than one difference a pair
            ones = np.ones((len(a), 1)), np.ones((len(b), 1))
            whole += np.hstack([a, (a**2).sum(1)[:, None], ones[0]]) @ np.hstack([-2 * b, ones[1], (b**2).sum(1)[:, None]]).T
            open_ &= whole <= (limit + slack)[:, None]
            if stop == width or np.count_nonzero(open_) <= SPARSE * open_.size:
                q, r = np.nonzero(open_)
                partial = whole[q, r]
        else:
            partial = partial + ((a[q] - b[r]) ** 2).sum(1)
            keep = partial <= limit[q] + slack
            q, r, partial = q[keep], r[keep], partial[keep]
    return q, r


def search(vectors: DataFrame, is_query: Column, id_: str = "vec_id", embedding: str = "embedding", k: int = 20) -> DataFrame:
    """``(query_id, rank, vec_id, score)``; ``is_query`` is a condition over the column ``id``."""
    spark = vectors.sparkSession
    usable = cut(ivf.valid(vectors, id_, embedding))
    width = ivf.width_of(usable)
    if not width:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    usable = usable.where(F.size("v") == width)
    facts = usable.agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("m")).first()
    ids, points = ivf.sample(usable, width, facts["n"])
    lists = int(np.clip(np.sqrt(facts["n"]) / 4, 4, 512))
    index = Index(ids, points, facts["m"], lists, k)
    sent = spark.sparkContext.broadcast(index)  # bounded: sample, rotation and centroids

    def assign(batches):
        for batch in batches:
            owner, _ = ivf.nearest(sent.value.turn(ivf.matrix(batch.column("v"), width)), sent.value.centres)
            yield pa.record_batch([batch.column("id"), batch.column("v"), pa.array(owner)], ["id", "v", "list"])

    def ask(batches):
        at = sent.value
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                own, v = part.column("id").to_numpy(), ivf.matrix(part.column("v"), width)
                score = v @ at.points.T
                score[own[:, None] == at.ids[None, :]] = -np.inf
                known = min(k, score.shape[1])
                last = -np.partition(-score, known - 1, axis=1)[:, known - 1] if known == k else np.full(len(own), -np.inf)
                norm = (v**2).sum(1)
                limit = np.where(np.isfinite(last), norm + at.largest - 2 * np.where(np.isfinite(last), last, 0), np.inf)
                order = at.ranked(at.turn(v, query=True))[:, : at.probes].astype(np.int32)
                ends = np.arange(0, order.size + 1, order.shape[1], dtype=np.int32)
                yield pa.record_batch([part.column("id"), part.column("v"), pa.array(limit), pa.ListArray.from_arrays(pa.array(ends), pa.array(order.ravel()))], ["id", "v", "limit", "lists"])

    def sampled(batches):
        """The sample's own neighbours, so that k rows are found whatever the lists hold."""
        at = sent.value
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                own, v = part.column("id").to_numpy(), ivf.matrix(part.column("v"), width)
                score = v @ at.points.T
                score[own[:, None] == at.ids[None, :]] = -np.inf
                known = min(k, score.shape[1])
                last = -np.partition(-score, known - 1, axis=1)[:, known - 1]
                q, r = np.nonzero(score >= last[:, None])
                best = _best(q, at.ids[r], score[q, r], known)
                q, r = q[best], r[best]
                fine = own[q] != at.ids[r]
                q, r = q[fine], r[fine]
                yield pa.record_batch([pa.array(own[q]), pa.array(at.ids[r]), pa.array((v[q] * at.points[r]).sum(1))], ["query_id", "vec_id", "score"])

    def unit(rows: pa.Table, asks: pa.Table) -> pa.Table:
        empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not rows.num_rows or not asks.num_rows:
            return empty
        at = sent.value
        v, w = ivf.matrix(asks.column("v"), width), ivf.matrix(rows.column("v"), width)
        own, other = asks.column("id").to_numpy(), rows.column("id").to_numpy()
        q, r = scan(at.turn(v, query=True), asks.column("limit").to_numpy(), at.turn(w))
        fine = own[q] != other[r]
        q, r = q[fine], r[fine]
        score = np.concatenate([(v[q[i : i + 65536]] * w[r[i : i + 65536]]).sum(1) for i in range(0, len(q), 65536)] or [np.zeros(0)])
        best = _best(own[q], other[r], score, k)
        return pa.table({"query_id": own[q][best], "vec_id": other[r][best], "score": score[best]})

    rows = usable.mapInArrow(assign, "id long, v array<double>, list int")
    queries = cut(usable.where(is_query).mapInArrow(ask, "id long, v array<double>, limit double, lists array<int>"))
    probes = queries.select("id", "v", "limit", F.explode("lists").alias("list"))
    left, right = ivf.units(cut(rows), probes)
    keys = ("list", "c", "q")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(unit, FOUND)
    found = found.unionByName(queries.select("id", "v").mapInArrow(sampled, FOUND)).dropDuplicates(["query_id", "vec_id"])
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
