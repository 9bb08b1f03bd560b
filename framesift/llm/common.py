"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import cut

BITS = 8  # of a bitmap, per key
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def crc_of(column: Column) -> Column:
    """crc32 of the decimal text of an id; null ids count as 0."""
    return F.coalesce(F.crc32(column.cast("string").cast("binary")), F.lit(0))


def utf8_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (n + 1) and bytes of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.large_binary()
    plain = pc.fill_null(column.cast(wide), pa.scalar(b"", wide))
    _, offsets, data = plain.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[plain.offset : plain.offset + len(plain) + 1]
    return offsets, np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)


def sum_by_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs ``[offsets[i], offsets[i+1])``; empty runs give 0."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def packed(values: np.ndarray, kind=np.int32) -> bytes:
    """Numbers as compressed bytes, first bytes together, then second ones."""
    values = np.ascontiguousarray(values, kind)
    return zstandard.ZstdCompressor(level=1).compress(values.view(np.uint8).reshape(len(values), -1).T.tobytes() if len(values) else b"")


def unpacked(value: bytes, kind=np.int32) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(value), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


_drop_kept: list = []


def make_room(drop) -> None:
    """Called by a worker that begins to keep something large; ``drop`` gives it up.

    Workers serve one stage after the other, so what another operator keeps there is given up first.
    """
    for other in _drop_kept:
        if other is not drop:
            other()
    _drop_kept[:] = [drop]


def spare(df: DataFrame, stem: str = "_") -> str:
    """A beginning of names that no column of ``df`` has, whatever their case."""
    names = [c.lower() for c in df.columns]
    while any(c.startswith(stem.lower()) for c in names):
        stem = f"_{stem}"
    return stem


def perhaps_in(rows: DataFrame, known: DataFrame, n: int, key: str = "id") -> DataFrame:
    """``rows`` without most of those whose key is not among the ``n`` keys of ``known``, by a bitmap of hashes.

    No row whose key is known is lost; rows with other keys stay with a chance of one in ``BITS``.  The bitmap is broadcast, a byte per key.
    """
    own = spare(rows, "bit_")
    place = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(max(1, BITS * n))) + 1
    held = known.select(F.bitmap_bucket_number(place).alias(f"{own}b"), F.bitmap_bit_position(place).alias("at"))
    bitmap = cut(held.groupBy(f"{own}b").agg(F.bitmap_construct_agg("at").alias(f"{own}m")))
    at = F.bitmap_bit_position(place).cast("int")
    byte = F.conv(F.hex(F.substring(F.col(f"{own}m"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = rows.join(F.broadcast(bitmap), F.bitmap_bucket_number(place) == F.col(f"{own}b"))
    return found.where(F.floor(byte / F.pow(F.lit(2), at % 8)) % 2 == 1).select(*rows.columns)
