"""Hard negatives by exact integer inner products, looked up from tables of subset sums.

Components become the integers ``floor(256 * x)``.  A candidate is kept as bit planes in two's complement:
for each plane, one byte holds the bits of eight dimensions.  An anchor has, for each group of eight
dimensions, a table of the 256 sums of its own components over every subset of the group.  The sum of the
table entries named by a plane's bytes is the product of the anchor with that plane; planes are added from the highest
(which counts negative) to the lowest, doubling in between.  That gives the full product without one multiplication
by a component.

Anchors and candidates meet in work units of at most about ``CHUNK`` candidates and ``ASKS`` anchors, dealt by a hash of
the id: neither a frequent label nor a group of equal vectors makes a unit larger.  One pass over
the candidates of an anchor's label finds its positives, a second one over the other labels, whose limits then stand,
its negatives; every unit passes on only what can still be among the first.

Defined results: rows with a null id, label or vector, an empty vector, a null or non-finite component, or a
vector of another length than the commonest take no part (labels are integers), and neither do components too large for a score
of 64 bits (beyond ``sqrt(2 ** 62 / width)`` after scaling).  Of rows that repeat an id the one with the smallest label,
then vector, counts.  Ties go to the smaller id.  Other columns are not looked at.  An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut
from . import ivf

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = (50, 100), (95, 100)  # a negative scores from 50/100 to 95/100 of the positive
CHUNK = 8_192  # candidates a work unit sees
ASKS = 1_024  # and anchors
_ROWS, _COLUMNS = 256, 128  # of one step inside a unit, so that tables and sums stay in the cache

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def tables(anchors: np.ndarray) -> np.ndarray:
    """Subset sums ``(groups, 256, anchors)``; the first dimension of a group is the highest bit."""
    n, width = anchors.shape
    grouped = anchors.T.reshape(width // 8, 8, n)
    sums = np.zeros((width // 8, 256, n), anchors.dtype)
    for bit in range(8):
        span = 1 << bit
        sums[:, span : 2 * span] = sums[:, :span] + grouped[:, 7 - bit, None]
    return sums


def planes(rows: np.ndarray, bits: int) -> np.ndarray:
    """Bit planes ``(rows, bits, groups)`` of integers that fit in ``bits`` bits of two's complement, lowest first."""
    return np.stack([np.packbits(((rows >> b) & 1).astype(np.uint8), axis=1) for b in range(bits)], axis=1)


def products(sums: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """Inner products ``(rows, anchors)`` from subset sums and bit planes."""
    groups, _, n = sums.shape
    total = np.empty((len(packed), n), sums.dtype)
    for left in range(0, n, _COLUMNS):
        table = [np.ascontiguousarray(sums[g, :, left : left + _COLUMNS]) for g in range(groups)]
        for top in range(0, len(packed), _ROWS):
            part = packed[top : top + _ROWS]
            score = np.zeros((len(part), table[0].shape[1]), sums.dtype)
            taken = np.empty_like(score)
            for plane in range(packed.shape[1] - 1, -1, -1):
                for g in range(groups):
                    np.take(table[g], part[:, plane, g], axis=0, out=taken, mode="clip")
                    score += taken
                if plane == packed.shape[1] - 1:
                    np.negative(score, out=score)  # the sign plane
                if plane:
                    score += score
            total[top : top + _ROWS, left : left + _COLUMNS] = score
    return total


def _integers(column, width: int) -> np.ndarray:
    """Scaled rows with the width filled up to whole groups."""
    whole = np.floor(ivf.matrix(column, width) * SCALE).astype(np.int64)
    return np.pad(whole, ((0, 0), (0, -width % 8)))


def _best(owner: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first k of each owner in order: larger score, then smaller id."""
    order = np.lexsort((ids, -score, owner))
    sorted_ = owner[order]
    return order[np.arange(len(order)) - np.searchsorted(sorted_, sorted_, side="left") < k]


def _dealt(rows: DataFrame, asks: DataFrame, n_rows: int, n_asks: int, chunk: int, asked: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with columns ``c`` and ``q``: each row goes to every part of the other side."""
    parts, groups = max(1, math.ceil(n_rows / chunk)), max(1, math.ceil(n_asks / asked))
    mark = F.xxhash64("id", F.lit(29))
    left = rows.withColumn("c", F.pmod(mark, F.lit(parts)).cast("int"))
    right = asks.withColumn("q", F.pmod(mark, F.lit(groups)).cast("int"))
    left = left.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    return left, right.withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    id_: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    chunk: int = CHUNK,
    asked: int = ASKS,
) -> DataFrame:
    """Negatives of every anchor and positive, as ``RESULT``; ``is_anchor`` is a condition over the column ``id``."""
    spark = vectors.sparkSession
    v = F.col(embedding).cast("array<double>")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    there = F.col(id_).isNotNull() & F.col(label).isNotNull() & F.coalesce((F.size(v) > 0) & ~odd, F.lit(False))
    rows = vectors.where(there).select(F.col(id_).cast("long").alias("id"), F.struct(F.col(label).cast("long").alias("label"), v.alias("v")).alias("row"))
    usable = cut(rows.groupBy("id").agg(F.min("row").alias("row")).select("id", "row.label", "row.v"))
    width = ivf.width_of(usable)
    if not width:
        return spark.createDataFrame([], RESULT)
    largest = F.aggregate("v", F.lit(0.0), lambda top, x: F.greatest(top, F.abs(F.floor(x * SCALE).cast("double"))))
    usable = usable.where((F.size("v") == width) & (largest <= math.isqrt((1 << 62) // width)))
    facts = usable.agg(F.count("*").alias("n"), F.count_if(is_anchor).alias("anchors"), F.max(largest).alias("top")).first()
    if not facts["anchors"]:
        return spark.createDataFrame([], RESULT)
    top = int(facts["top"])
    bits = max(1, top.bit_length()) + 1
    kind = np.int32 if width * max(1, top) * (1 << bits) < 1 << 31 else np.int64
    padded, groups = width + -width % 8, (width + 7) // 8

    def pack(batches):
        for batch in batches:
            packed = planes(_integers(batch.column("v"), width), bits).reshape(batch.num_rows, bits * groups)
            ends = np.arange(0, packed.size + 1, bits * groups, dtype=np.int32)
            planes_ = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(packed))])
            yield pa.record_batch([batch.column("id"), batch.column("label"), planes_], ["id", "label", "planes"])

    rows = cut(usable.mapInArrow(pack, "id long, label long, planes binary"))
    anchors = usable.where(is_anchor)

    def scores(found: pa.Table, asks: pa.Table) -> np.ndarray:
        raw = found.column("planes").combine_chunks()
        packed = np.frombuffer(b"".join(raw.to_pylist()), np.uint8).reshape(found.num_rows, bits, groups)
        return products(tables(_integers(asks.column("v"), width).astype(kind)), packed)

    def positives(found: pa.Table, asks: pa.Table) -> pa.Table:
        if not found.num_rows or not asks.num_rows:
            return pa.table({"anchor_id": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        score = scores(found, asks)
        ids, own = found.column("id").to_numpy(), asks.column("id").to_numpy()
        other = ids[:, None] != own[None, :]
        if len(ids) > POSITIVES + 1:  # one of the first may be the anchor itself
            other &= score >= np.partition(score, len(ids) - POSITIVES - 1, axis=0)[len(ids) - POSITIVES - 1]
        r, q = np.nonzero(other)
        best = _best(q, ids[r], score[r, q], POSITIVES)
        r, q = r[best], q[best]
        return pa.table({"anchor_id": own[q], "id": ids[r], "score": score[r, q].astype(np.int64)})

    same_rows, same_asks = _dealt(rows, anchors, facts["n"], facts["anchors"], chunk, asked)
    same = ("label", "c", "q")
    near = same_rows.groupBy(*same).cogroup(same_asks.groupBy(*same)).applyInArrow(positives, "anchor_id long, id long, score long")
    first = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id"))
    near = near.withColumn("place", first).where(F.col("place") <= POSITIVES)
    listed = near.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("place", "id", "score"))).alias("positives"))
    asks = cut(anchors.join(listed.withColumnRenamed("anchor_id", "id"), "id"))

    def negatives(found: pa.Table, asks: pa.Table) -> pa.Table:
        columns = ("anchor_id", "positive_id", "negative_id", "positive_score", "negative_score")
        none = pa.table({c: pa.array([], pa.int64()) for c in columns})
        if not found.num_rows or not asks.num_rows:
            return none
        score = scores(found, asks)
        ids, own = found.column("id").to_numpy(), asks.column("id").to_numpy()
        listed = asks.column("positives").combine_chunks()
        owner = np.repeat(np.arange(len(own)), np.diff(listed.offsets.to_numpy()))
        flat = listed.flatten()
        place, with_, reach = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
        low, high = -((-LOW[0] * reach) // LOW[1]), (HIGH[0] * reach) // HIGH[1]
        floor_, ceiling = np.full(len(own), np.iinfo(np.int64).max), np.full(len(own), np.iinfo(np.int64).min)
        np.minimum.at(floor_, owner, low)
        np.maximum.at(ceiling, owner, high)
        r, q = np.nonzero((score >= floor_) & (score <= ceiling) & (found.column("label").to_numpy()[:, None] != asks.column("label").to_numpy()[None, :]))
        value = score[r, q].astype(np.int64)
        order = np.lexsort((ids[r], -value, q))
        r, q, value = r[order], q[order], value[order]
        out = {c: [] for c in columns}
        for number in range(1, POSITIVES + 1):  # every positive has limits of its own
            at = np.flatnonzero(place == number)
            row = np.full(len(own), -1)
            row[owner[at]] = at
            mine_ = row[q]
            keep = (mine_ >= 0) & (value >= low[mine_]) & (value <= high[mine_])
            kept = np.flatnonzero(keep)
            mark = q[kept]
            kept = kept[np.arange(len(kept)) - np.searchsorted(mark, mark, side="left") < NEGATIVES]
            for name, values in zip(columns, (own[q[kept]], with_[row[q[kept]]], ids[r[kept]], reach[row[q[kept]]], value[kept])):
                out[name].append(values)
        return pa.table({c: pa.array(np.concatenate(v), pa.int64()) for c, v in out.items()})

    all_rows, all_asks = _dealt(rows, asks, facts["n"], facts["anchors"], chunk, asked)
    unit = ("c", "q")
    found = all_rows.groupBy(*unit).cogroup(all_asks.groupBy(*unit)).applyInArrow(
        negatives, "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"
    )
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    return found.select("anchor_id", "positive_id", rank.alias("rank"), "negative_id", "positive_score", "negative_score").where(F.col("rank") <= NEGATIVES)
