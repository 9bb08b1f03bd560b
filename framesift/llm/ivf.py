"""Inverted lists over vectors, shared by the searches of this subpackage.

Lists are split into chunks of a bounded number of rows, and so are the queries that probe a list.
A work unit is one (list, query chunk, row chunk); no list, however large, meets in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SAMPLE = 16_384  # vectors that centroids and codebooks are fitted on, on the driver
CHUNK = 1_024  # rows of a list that one work unit sees
ASKS = 4_096  # and vectors that ask it


def valid(vectors: DataFrame, id_: str, embedding: str, exclude_zero: bool = True) -> DataFrame:
    """``(id, v)`` of the vectors that take part: no null, non-finite component, and not all zero."""
    v = F.col(embedding).cast("array<double>")
    fine = F.col(embedding).isNotNull() & (F.size(v) > 0)
    fine = fine & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    if exclude_zero:
        fine = fine & F.exists(v, lambda x: x != 0)
    return vectors.where(F.col(id_).isNotNull()).select(F.col(id_).cast("long").alias("id"), v.alias("v"), fine.alias("_fine")).where(F.coalesce("_fine", F.lit(False))).drop("_fine")


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def listed(rows: np.ndarray) -> pa.Array:
    n, width = rows.shape
    ends = np.arange(0, (n + 1) * width, width, dtype=np.int32) if width else np.zeros(n + 1, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(rows).ravel()))


def sample(vectors: DataFrame, width: int, total: int, limit: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of at most ``limit`` rows and 64 MB, chosen by a hash of the id."""
    limit = max(1, min(limit, (1 << 26) // (8 * max(1, width))))
    mark = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 20))
    part = vectors if total <= limit else vectors.where(mark < int((1 << 20) * 0.9 * limit / total))
    found = part.orderBy("id").limit(limit).toArrow()
    ids = found.column("id").to_numpy()
    return ids, matrix(found.column("v"), width).astype(np.float64) if len(ids) else np.zeros((0, width))


def nearest(points: np.ndarray, centres: np.ndarray, step: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre of each point and the squared distance to it, in slices."""
    owner, near = np.zeros(len(points), np.int32), np.zeros(len(points))
    norm = (centres**2).sum(1)
    for at in range(0, len(points), step):
        part = points[at : at + step]
        distance = norm - 2 * part @ centres.T
        owner[at : at + step] = distance.argmin(1)
        near[at : at + step] = distance.min(1) + (part**2).sum(1)
    return owner, np.maximum(near, 0)


def kmeans(points: np.ndarray, k: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Centroids by plain iterations on a bounded sample; empty ones restart at far points."""
    rng = np.random.default_rng(seed)
    k = max(1, min(k, len(points)))
    centres = points[rng.choice(len(points), k, replace=False)].astype(np.float64)
    for _ in range(rounds):
        owner, near = nearest(points, centres)
        count = np.bincount(owner, minlength=k)
        total = np.zeros_like(centres)
        np.add.at(total, owner, points)
        filled = count > 0
        centres[filled] = total[filled] / count[filled, None]
        if (~filled).any():
            far = np.argsort(-near)[: (~filled).sum()]
            centres[~filled] = points[far]
    return centres


def units(rows: DataFrame, probes: DataFrame, chunk: int = CHUNK, asked: int = ASKS) -> tuple[DataFrame, DataFrame]:
    """Both sides of (list, ...) with columns ``c`` and ``q``, so that units (list, c, q) hold at most about
    ``chunk`` rows and ``asked`` vectors that ask."""
    parts = rows.groupBy("list").agg(F.ceil(F.count("*") / chunk).cast("int").alias("parts"))
    asks = probes.groupBy("list").agg(F.ceil(F.count("*") / asked).cast("int").alias("asks"))
    sizes = parts.join(asks, "list")
    mark = F.xxhash64("id", F.lit(17))
    left = rows.join(sizes, "list").withColumn("c", F.pmod(mark, "parts").cast("int"))
    left = left.withColumn("q", F.explode(F.sequence(F.lit(0), F.col("asks") - 1))).drop("parts", "asks")
    right = probes.join(sizes, "list").withColumn("q", F.pmod(mark, "asks").cast("int"))
    right = right.withColumn("c", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts", "asks")
    return left, right


def width_of(vectors: DataFrame) -> int:
    """The commonest number of components; 0 for an empty table."""
    found = vectors.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), "w").first()
    return found["w"] if found else 0
