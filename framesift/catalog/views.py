"""Driver tables seen as capture tables, in Spark and as SQL common table expressions.

The views are projections of whole tables: nothing is sampled or cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..constants import OFFICIAL_CLASSES
from ..functions.text import frame_name
from ..plans.blocks import time_block
from ..plans.ordered import scan

WIDTH, HEIGHT = 640, 480  # image size of the measured frames
MASK_WIDTH, MASK_HEIGHT = 160, 24  # image size of the drawn masks


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def joined(column: str) -> Column:
    return F.array_join(column, "|").alias(column)


def r6(column, name: str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column, 6).alias(name)


def long(column, name: str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.cast("long").alias(name)


# --- frames of a scene: events of a user in time order ----------------------
def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``scene_id, idx, frame_id, event_id, ts, event_type, value, user_id``."""
    raw = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    placed = scan(raw, ["user_id"], ["ts", "event_id"], time_block(F.col("ts"), "DAY"), index="idx")
    return placed.select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("scene_id"),
        "idx",
        frame_name(F.col("idx")).alias("frame_id"),
        "event_id",
        "ts",
        "event_type",
        "value",
        "user_id",
    )


EVENTS = """ev AS (
  SELECT 'u' || user_id AS scene_id,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS idx,
         lpad(CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS VARCHAR), 6, '0') AS frame_id,
         event_id, ts, event_type, value, user_id
  FROM events)"""


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three instances per frame: the events of a scene, three by three."""
    e = events(spark, sf_dir)
    number = F.floor(F.col("idx") / 3)
    return e.select(
        "scene_id",
        "user_id",
        frame_name(number).alias("frame_id"),
        number.alias("frame_index"),
        (F.col("idx") % 3).alias("ord"),
        F.concat(F.lit("obj_"), (F.col("idx") % 3).cast("string")).alias("instance_id"),
        "event_id",
        "event_type",
        F.floor(F.col("value") * 20).cast("long").alias("mask_area"),
        (F.floor(F.col("value") * 20) / F.lit(float(WIDTH * HEIGHT))).alias("area_fraction"),
        (150 + F.col("event_id") % 340).cast("double").alias("cx"),
        (100 + (F.col("event_id") * 7) % 280).cast("double").alias("cy"),
        F.least(F.col("value") / 60, F.lit(1.0)).alias("depth_coverage"),
        (0.6 + (F.col("event_id") % 5) / 10).alias("dominant_component_ratio"),
        (F.col("event_id") % 13 == 0).alias("touches_border"),
        (F.col("event_type") != "error").alias("recorded"),
        (F.col("event_id") % 23 != 0).alias("has_mask"),
        F.lit(WIDTH).alias("width"),
        F.lit(HEIGHT).alias("height"),
        (number == 0).alias("registration"),
    )


MEASUREMENTS = EVENTS + """, m AS (
  SELECT scene_id, user_id, lpad(CAST(idx // 3 AS VARCHAR), 6, '0') AS frame_id, idx // 3 AS frame_index,
         idx % 3 AS ord, 'obj_' || (idx % 3) AS instance_id, event_id, event_type,
         CAST(floor(value * 20) AS BIGINT) AS mask_area, floor(value * 20) / 307200::DOUBLE AS area_fraction,
         CAST(150 + event_id % 340 AS DOUBLE) AS cx, CAST(100 + (event_id * 7) % 280 AS DOUBLE) AS cy,
         least(value / 60, 1.0::DOUBLE) AS depth_coverage, 0.6::DOUBLE + (event_id % 5) / 10::DOUBLE AS dominant,
         event_id % 13 = 0 AS touches_border, event_type <> 'error' AS recorded, event_id % 23 <> 0 AS has_mask
  FROM ev)"""


# --- mask runs: one run per line item ----------------------------------------
def mask_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    number = F.floor(F.col("l_orderkey") / 75)
    start = ((F.col("l_linenumber") * 17) % 100).cast("int")
    return li.select(
        F.concat(F.lit("s"), F.floor(number / 50).cast("string")).alias("scene_id"),
        frame_name(number).alias("frame_id"),
        F.concat(F.lit("m"), (F.col("l_suppkey") % 3).cast("string")).alias("instance_id"),
        (F.col("l_partkey") % MASK_HEIGHT).cast("int").alias("y"),
        start.alias("x_start"),
        (start + F.floor("l_quantity").cast("int")).alias("x_end"),
    )


RUNS = """runs AS (
  SELECT 's' || (l_orderkey // 75 // 50) AS scene_id, lpad(CAST(l_orderkey // 75 AS VARCHAR), 6, '0') AS frame_id,
         'm' || (l_suppkey % 3) AS instance_id, l_partkey % 24 AS y, (l_linenumber * 17) % 100 AS x_start,
         (l_linenumber * 17) % 100 + CAST(floor(l_quantity) AS BIGINT) AS x_end
  FROM lineitem)"""
PIXELS = RUNS + """, px AS (
  SELECT DISTINCT scene_id, frame_id, instance_id, y, unnest(range(x_start, x_end)) AS x FROM runs)"""


def depth_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scan line per image row that holds a mask."""
    lines = mask_runs(spark, sf_dir).select("scene_id", "frame_id", "y").distinct()
    base = F.col("frame_id").cast("int") * 31 + F.col("y") * 17
    values = F.transform(
        F.sequence(F.lit(0), F.lit(MASK_WIDTH - 1)),
        lambda x: F.when((x + F.col("y")) % 11 == 0, 0).otherwise((base + x * 7) % 6000).cast("int"),
    )
    return lines.select("scene_id", "frame_id", "y", values.alias("depth_mm"))


DEPTH_OF_PX = "CASE WHEN (x + y) % 11 = 0 THEN 0 ELSE (CAST(frame_id AS INT) * 31 + y * 17 + x * 7) % 6000 END"


# --- reports: one per order ---------------------------------------------------
def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    names = F.array(*[F.lit(OFFICIAL_CLASSES[i]) for i in range(9)])
    class_name = F.element_at(names, (F.col("o_custkey") % 9 + 1).cast("int"))
    key = F.lpad(F.col("o_orderkey").cast("string"), 9, "0")
    month = F.date_format("o_orderdate", "yyyyMM")
    return o.select(
        F.concat(F.lit("r"), key, F.lit("_report.json")).alias("report_path"),
        F.concat(class_name, F.lit("_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_"), key).alias("scene"),
        F.when(F.col("o_custkey") % 7 == 0, "val").otherwise("train").alias("split"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string"), F.lit("_"), month).alias("capture_session_id"),
        F.concat(F.lit("v"), F.floor(F.col("o_orderkey") / 4).cast("string")).alias("source_video_id"),
        F.array(class_name).alias("class_names"),
        class_name.alias("class_name"),
        (F.col("o_orderkey") % 50).cast("long").alias("accepted"),
        "o_orderkey",
        "o_custkey",
    )


_CLASS_LIST = "[" + ", ".join(f"'{OFFICIAL_CLASSES[i]}'" for i in range(9)) + "]"
REPORTS = f"""rep AS (
  SELECT 'r' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') || '_report.json' AS report_path,
         ({_CLASS_LIST})[o_custkey % 9 + 1] || '_' || strftime(o_orderdate, '%Y%m%d') || '_' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS scene,
         CASE WHEN o_custkey % 7 = 0 THEN 'val' ELSE 'train' END AS split,
         'c' || o_custkey || '_' || strftime(o_orderdate, '%Y%m') AS capture_session_id,
         'v' || (o_orderkey // 4) AS source_video_id, ({_CLASS_LIST})[o_custkey % 9 + 1] AS class_name,
         o_orderkey % 50 AS accepted, o_orderkey, o_custkey
  FROM orders)"""


def class_catalogue(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(OFFICIAL_CLASSES.items()), "class_id int, class_name string")


CLASSES = "cls AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, '{n}')" for i, n in OFFICIAL_CLASSES.items()) + ") t(class_id, class_name))"


# --- files: one image per document --------------------------------------------
def document_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    split = F.when(F.col("doc_id") % 5 == 0, "val").otherwise("train")
    return d.select(
        split.alias("split"),
        F.col("doc_id").cast("string").alias("stem"),
        F.concat(F.lit("images/"), split, F.lit("/"), F.col("doc_id").cast("string"), F.lit(".png")).alias("path"),
        F.octet_length("text").cast("long").alias("size"),
        "text",
    )


FILES = """fl AS (
  SELECT CASE WHEN doc_id % 5 = 0 THEN 'val' ELSE 'train' END AS split, CAST(doc_id AS VARCHAR) AS stem,
         'images/' || CASE WHEN doc_id % 5 = 0 THEN 'val' ELSE 'train' END || '/' || doc_id || '.png' AS path,
         octet_length(encode(text)) AS size, text
  FROM documents)"""
