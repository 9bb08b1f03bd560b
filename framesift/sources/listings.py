"""File listings, label text, metric CSV and raster tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..constants import EPOCH_METRICS, IMAGE_SUFFIXES
from ..functions.text import file_stem, file_suffix, strip
from .documents import file_path


def files(spark: SparkSession, path: str, recursive: bool = False, glob: str | None = None) -> DataFrame:
    """``path, stem, suffix, size, mtime``; file contents are never read."""
    options = {"recursiveFileLookup": str(recursive).lower()}
    if glob:
        options["pathGlobFilter"] = glob
    listed = spark.read.format("binaryFile").options(**options).load(path).select("path", "length", "modificationTime")
    clean = F.regexp_replace("path", r"^file:/*", "/")
    return listed.select(
        clean.alias("path"), file_stem(clean).alias("stem"), file_suffix(clean).alias("suffix"), F.col("length").alias("size"), F.col("modificationTime").alias("mtime")
    )


def digests(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """``path, sha256``; reads the contents."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path)
    return raw.select(F.regexp_replace("path", r"^file:/*", "/").alias("path"), F.sha2("content", 256).alias("sha256"))


def images(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    return files(spark, path, recursive).where(F.col("suffix").isin(*IMAGE_SUFFIXES))


def images_from_spec(spark: SparkSession, spec: str, kind: str) -> DataFrame:
    """Images of a ``directory`` (recursive), a single ``file``, or a text ``list`` of paths."""
    if kind == "directory":
        return images(spark, spec, recursive=True).select("path")
    if kind == "file":
        return files(spark, spec).where(F.col("suffix").isin(*IMAGE_SUFFIXES)).select("path")
    if kind == "list":
        base = F.regexp_replace(file_path(), r"/[^/]*$", "")
        rows = spark.read.text(spec).select(strip(F.col("value")).alias("v"), base.alias("base")).where("v <> ''")
        return rows.select(F.when(F.col("v").startswith("/"), F.col("v")).otherwise(F.concat_ws("/", "base", "v")).alias("path"))
    raise ValueError("kind must be directory, file or list")


def frame_files(spark: SparkSession, path: str) -> DataFrame:
    """``scene_id, stream, frame_id`` of all PNG frames below ``<scene>/<stream>/``."""
    listed = files(spark, path, recursive=True, glob="*.png")
    parts = F.split("path", "/")
    return listed.select(F.element_at(parts, -3).alias("scene_id"), F.element_at(parts, -2).alias("stream"), F.col("stem").alias("frame_id"))


def label_files(spark: SparkSession, path: str, split: str) -> DataFrame:
    """``split, stem, text`` of label files (one small file per frame)."""
    raw = spark.read.text(path, wholetext=True, pathGlobFilter="*.txt")
    return raw.select(F.lit(split).alias("split"), file_stem(file_path()).alias("stem"), F.col("value").alias("text"))


# fixed values: column names of the training log
_CSV_NAMES = {
    "epoch": "epoch",
    "precision_m": "metrics/precision(M)",
    "recall_m": "metrics/recall(M)",
    "map50_m": "metrics/mAP50(M)",
    "map50_95_m": "metrics/mAP50-95(M)",
    "map50_95_b": "metrics/mAP50-95(B)",
}


def epoch_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Training logs ``<run>/results.csv`` with trimmed names and values; metrics stay text.

    ``row_no`` is the line number, which decides ties.
    """
    lines = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="results.csv").select(
        F.element_at(F.split(file_path(), "/"), -2).alias("run"), F.split("value", r"\r?\n").alias("lines")
    )

    def cells(line):
        return F.transform(F.split(line, ","), strip)

    rows = lines.select("run", cells(F.col("lines")[0]).alias("names"), F.posexplode("lines").alias("row_no", "line")).where(
        (F.col("row_no") > 0) & (strip(F.col("line")) != "")
    )
    record = F.map_from_arrays("names", F.slice(cells(F.col("line")), 1, F.size("names")))
    named = rows.where(F.size(cells(F.col("line"))) >= F.size("names")).select("run", "row_no", record.alias("r"))
    return named.select("run", "row_no", *[F.try_element_at("r", F.lit(_CSV_NAMES[c])).alias(c) for c in ("epoch", *EPOCH_METRICS)])


def mask_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.MASK_RUNS).parquet(path)


def depth_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.DEPTH_ROWS).parquet(path)


def frame_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.FRAME_VECTORS).parquet(path)


def size_mismatches(runs: DataFrame, frames: DataFrame) -> DataFrame:
    """Masks that reach outside their image (``frames``: scene_id, frame_id, width, height)."""
    joined = runs.join(frames.select("scene_id", "frame_id", "width", "height"), ["scene_id", "frame_id"])
    wrong = (F.col("x_end") > F.col("width")) | (F.col("y") >= F.col("height")) | (F.col("x_start") < 0) | (F.col("y") < 0)
    return joined.where(wrong).select("scene_id", "frame_id", "instance_id").distinct()
