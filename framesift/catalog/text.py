"""Names and paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import text as t
from ..functions.geometry import rotation_jump_deg, scaled_intrinsics, translation_jump_m
from ..functions.labels import class_map_from_list, class_map_from_text_keys
from . import views as v

REPO, PROJECT = "/srv/framekit", "/srv/framekit/projects/lab"


def safe_names(spark, sf_dir) -> DataFrame:
    d = v.table(spark, sf_dir, "documents")
    return d.select("doc_id", t.safe_name(F.col("text")).alias("safe"), t.safe_name(F.col("text"), trim=True).alias("safe_trimmed"))


SAFE_NAMES = r"""SELECT doc_id, coalesce(nullif(regexp_replace(text, '[^\p{L}\p{N}_-]', '_', 'g'), ''), 'instance') AS safe,
  coalesce(nullif(regexp_replace(trim(text), '[^\p{L}\p{N}_-]', '_', 'g'), ''), 'instance') AS safe_trimmed FROM documents"""


def valid_ids(spark, sf_dir) -> DataFrame:
    p = v.table(spark, sf_dir, "part")
    name = F.when(F.col("p_size") % 2 == 0, F.col("p_name")).otherwise(F.translate("p_name", " ", "_"))
    return p.select("p_partkey", v.long(t.valid_output_id(name), "ok"))


VALID_IDS = "SELECT p_partkey, CAST(regexp_full_match(CASE WHEN p_size % 2 = 0 THEN p_name ELSE replace(p_name, ' ', '_') END, '[A-Za-z0-9_-]+') AS BIGINT) AS ok FROM part"


def label_paths(spark, sf_dir) -> DataFrame:
    p = v.table(spark, sf_dir, "pages")
    k = F.col("page_id")
    host = F.regexp_replace("url", r"^https?://([^/]*).*$", "$1")
    middle = F.when(k % 4 == 0, "images").when(k % 4 == 1, "images/a/images").when(k % 4 == 2, "my_images").otherwise("images.d/images")
    path = F.concat(F.lit("/ds/"), middle, F.lit("/val/"), host, F.lit("_"), k.cast("string"), F.when(k % 3 == 0, ".png").when(k % 3 == 1, ".tar.jpeg").otherwise(""))
    return p.select("page_id", t.label_path(path).alias("label"))


LABEL_PATHS = r"""WITH h AS (SELECT page_id, regexp_replace(url, '^https?://([^/]*).*$', '\1') || '_' || page_id || CASE page_id % 3 WHEN 0 THEN '.png' WHEN 1 THEN '.tar.jpeg' ELSE '' END AS f FROM pages)
SELECT page_id, CASE page_id % 4 WHEN 0 THEN '/ds/labels/val/' WHEN 1 THEN '/ds/images/a/labels/val/' WHEN 3 THEN '/ds/images.d/labels/val/' END || regexp_replace(f, '\.[^.]*$', '') || '.txt' AS label FROM h"""


def _old_path():
    k = F.col("page_id")
    tail = F.concat(F.lit("data/x"), k.cast("string"), F.lit(".png"))
    return (
        F.when(k % 6 == 0, F.concat(F.lit("/home/a/framekit/projects/lab/"), tail))
        .when(k % 6 == 1, F.concat(F.lit("/srv/framekit/"), tail))
        .when(k % 6 == 2, F.concat(F.lit("/mnt/framekit/old/framekit/"), tail))
        .when(k % 6 == 3, F.concat(F.lit("C:\\framekit\\"), tail))
        .when(k % 6 == 4, F.concat(F.lit("/elsewhere/"), tail))
        .otherwise(F.col("url"))
    )


def paths_relocated(spark, sf_dir) -> DataFrame:
    p = v.table(spark, sf_dir, "pages")
    return p.select("page_id", t.relocated_path(_old_path(), [REPO], "/out", "projects/lab").alias("moved"))


PATHS_RELOCATED = """SELECT page_id, CASE page_id % 6 WHEN 0 THEN '/out/projects/lab/data/x' || page_id || '.png' WHEN 1 THEN '/out/data/x' || page_id || '.png'
  WHEN 2 THEN '/out/data/x' || page_id || '.png' END AS moved FROM pages"""


def paths_compatible(spark, sf_dir) -> DataFrame:
    p = v.table(spark, sf_dir, "pages")
    k = F.col("page_id")
    path = (
        F.when(k % 5 == 0, F.concat(F.lit("/old/framekit/projects/lab/datasets/d"), k.cast("string")))
        .when(k % 5 == 1, F.concat(F.lit("/old/framekit/models/m"), k.cast("string")))
        .when(k % 5 == 2, F.concat(F.lit("/other/data/d"), k.cast("string")))
        .when(k % 5 == 3, F.concat(F.lit("/old/lab/manifests/lab/data/d"), k.cast("string")))
        .otherwise(F.concat(F.lit("/srv/framekit/data/d"), k.cast("string")))
    )
    resolved = t.compatible_path(path, REPO, PROJECT)
    inside = resolved.startswith(REPO + "/")
    return p.select(
        "page_id",
        resolved.alias("resolved"),
        t.owning_project(resolved, REPO, PROJECT).alias("project"),
        t.relative_path(resolved, F.lit(PROJECT + "/datasets/reports"), inside).alias("portable"),
    )


PATHS_COMPATIBLE = """WITH r AS (SELECT page_id, CASE page_id % 5 WHEN 0 THEN '/srv/framekit/projects/lab/datasets/d' WHEN 1 THEN '/srv/framekit/models/m' WHEN 2 THEN '/other/data/d'
  WHEN 3 THEN '/srv/framekit/projects/lab/data/d' ELSE '/srv/framekit/data/d' END || page_id AS resolved FROM pages)
SELECT page_id, resolved, '/srv/framekit/projects/lab' AS project, CASE page_id % 5 WHEN 0 THEN '../d' || page_id WHEN 1 THEN '../../../../models/m' || page_id WHEN 2 THEN resolved
  WHEN 3 THEN '../../data/d' || page_id ELSE '../../../../data/d' || page_id END AS portable FROM r"""


def _nested_document():
    path = _old_path()
    return F.to_json(
        F.struct(
            F.col("page_id").alias("id"), path.alias("image"), F.struct(F.array(path, F.lit("plain \" text"), F.lit("/srv/framekit/data/k")).alias("list"), F.lit(None).alias("none")).alias("nested"),
            F.create_map(F.lit("/srv/framekit/key"), F.lit(1.5)).alias("keys"), F.col("html").alias("html"),
        )
    )


def json_paths(spark, sf_dir) -> DataFrame:
    """Absolute paths rewritten inside nested JSON, with the number of changes."""
    p = v.table(spark, sf_dir, "pages")
    document = _nested_document()
    text, changes = t.rewrite_json_paths(document, lambda s: t.relocated_path(s, [REPO], "/out", "projects/lab"))
    moved = F.get_json_object(text, "$.image")
    return p.select("page_id", moved.alias("image"), F.get_json_object(text, "$.nested.list[2]").alias("third"), (F.get_json_object(text, "$.html") == F.col("html")).cast("long").alias("html_same"), changes.cast("long").alias("changes"))


JSON_PATHS = r"""SELECT page_id, CASE page_id % 6 WHEN 0 THEN '/out/projects/lab/data/x' || page_id || '.png' WHEN 1 THEN '/out/data/x' || page_id || '.png' WHEN 2 THEN '/out/data/x' || page_id || '.png'
  WHEN 3 THEN 'C:\framekit\data/x' || page_id || '.png' WHEN 4 THEN '/elsewhere/data/x' || page_id || '.png' ELSE url END AS image, '/out/data/k' AS third, CAST(1 AS BIGINT) AS html_same,
  CAST(CASE WHEN page_id % 6 < 3 THEN 3 ELSE 1 END AS BIGINT) AS changes FROM pages"""


def json_paths_relative(spark, sf_dir) -> DataFrame:
    """The same documents, each written to a folder of its own, with paths seen from there."""
    p = v.table(spark, sf_dir, "pages")
    base = F.when(F.col("page_id") % 2 == 0, "/out/data").otherwise(F.concat(F.lit("/out/docs/d"), F.col("page_id").cast("string")))
    text, changes = t.rewrite_json_paths(_nested_document(), lambda s: t.relocated_relative(s, base, [REPO], "/out", "projects/lab"))
    return p.select(
        "page_id", F.get_json_object(text, "$.image").alias("image"), F.get_json_object(text, "$.nested.list[0]").alias("first"),
        F.get_json_object(text, "$.nested.list[2]").alias("third"), changes.cast("long").alias("changes"),
    )


_RELATIVE_IMAGE = r"""CASE page_id % 6 WHEN 0 THEN '../projects/lab/data/x' || page_id || '.png' WHEN 1 THEN '../../data/x' || page_id || '.png' WHEN 2 THEN 'x' || page_id || '.png'
  WHEN 3 THEN 'C:\framekit\data/x' || page_id || '.png' WHEN 4 THEN '/elsewhere/data/x' || page_id || '.png' ELSE url END"""
JSON_PATHS_RELATIVE = f"""SELECT page_id, {_RELATIVE_IMAGE} AS image, {_RELATIVE_IMAGE} AS first, CASE WHEN page_id % 2 = 0 THEN 'k' ELSE '../../data/k' END AS third,
  CAST(CASE WHEN page_id % 6 < 3 THEN 3 ELSE 1 END AS BIGINT) AS changes FROM pages"""


def report_names(spark, sf_dir) -> DataFrame:
    o = v.table(spark, sf_dir, "orders")
    name = F.concat(F.lit("s"), F.col("o_orderkey").cast("string"), F.when(F.col("o_orderkey") % 3 == 0, "_train_report.json").otherwise("_report.json"))
    return o.select(
        "o_orderkey", t.val_report_name(name).alias("val_name"), t.frame_name(F.col("o_orderkey") * 97).alias("frame"),
        t.stage_directory((F.col("o_custkey") % 200).cast("int"), F.concat(F.lit("can "), F.col("o_custkey").cast("string"))).alias("stage"),
    )


REPORT_NAMES = """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 's' || o_orderkey || '_val_report.json' END AS val_name,
  CASE WHEN o_orderkey * 97 > 999999 THEN CAST(o_orderkey * 97 AS VARCHAR) ELSE lpad(CAST(o_orderkey * 97 AS VARCHAR), 6, '0') END AS frame,
  'class_' || lpad(CAST(o_custkey % 200 AS VARCHAR), 3, '0') || '_can_' || o_custkey AS stage FROM orders"""


def rotation_jump(spark, sf_dir) -> DataFrame:
    """Pose differences of planar rotations built from orders."""
    o = v.table(spark, sf_dir, "orders")

    def pose(angle, shift):
        c, s, zero, one = F.cos(angle), F.sin(angle), F.lit(0.0), F.lit(1.0)
        return F.array(c, -s, zero, shift, s, c, zero, shift * 2, zero, zero, one, shift / 2, zero, zero, zero, one)

    a, b = F.col("o_orderkey") % 360 / 100.0, F.col("o_custkey") % 200 / 100.0
    first, second = pose(a, F.col("o_totalprice") / 1e5), pose(b, F.col("o_totalprice") / 2e5)
    absent = F.when(F.col("o_orderkey") % 10 > 0, first)
    return o.select("o_orderkey", F.round(rotation_jump_deg(absent, second), 4).alias("rotation_deg"), v.r6(translation_jump_m(absent, second), "translation_m"))


ROTATION_JUMP = """WITH p AS (SELECT o_orderkey, (o_orderkey % 360 / 100) AS a, (o_custkey % 200 / 100) AS b, o_totalprice / 1e5::DOUBLE AS s, o_totalprice / 2e5::DOUBLE AS u FROM orders)
SELECT o_orderkey, CASE WHEN o_orderkey % 10 > 0 THEN round(degrees(acos(greatest(-1, least(1, (2 * (cos(a) * cos(b) + sin(a) * sin(b)) + 1 - 1) * 0.5::DOUBLE)))), 4) END AS rotation_deg,
  CASE WHEN o_orderkey % 10 > 0 THEN round(sqrt((u - s) * (u - s) + (2 * u - 2 * s) * (2 * u - 2 * s) + (u / 2 - s / 2) * (u / 2 - s / 2)), 6) END AS translation_m FROM p"""


def intrinsics_scaled(spark, sf_dir) -> DataFrame:
    s = v.table(spark, sf_dir, "supplier")
    k = F.struct(F.lit(600.0).alias("fx"), F.lit(610.0).alias("fy"), (F.col("s_suppkey") + 0.5).alias("cx"), F.lit(240.0).alias("cy"))
    scaled = scaled_intrinsics(k, F.col("s_acctbal") / 1000, F.lit(0.5))
    return s.select("s_suppkey", *[v.r6(scaled[c], c) for c in ("fx", "fy", "cx", "cy")])


INTRINSICS = """SELECT s_suppkey, round(600 * (s_acctbal / 1000), 6) AS fx, 305.0::DOUBLE AS fy, round((s_suppkey + 0.5::DOUBLE) * (s_acctbal / 1000), 6) AS cx, 120.0::DOUBLE AS cy FROM supplier"""


def class_names_map(spark, sf_dir) -> DataFrame:
    """Class maps from list form and from text-keyed map form."""
    p = v.table(spark, sf_dir, "part")
    words = F.split("p_name", " ")
    as_list = class_map_from_list(words)
    as_map = class_map_from_text_keys(F.map_from_arrays(F.array(F.lit("0"), F.col("p_size").cast("string")), F.array(F.col("p_brand"), F.col("p_type"))))
    return p.select("p_partkey", F.try_element_at(as_list, F.lit(1)).alias("second_word"), F.try_element_at(as_map, F.col("p_size")).alias("of_size"), v.long(F.size(as_map), "entries"))


CLASS_NAMES = "SELECT p_partkey, split_part(p_name, ' ', 2) AS second_word, p_type AS of_size, CAST(2 AS BIGINT) AS entries FROM part"

QUERIES = {
    "safe_names": (safe_names, SAFE_NAMES),
    "valid_ids": (valid_ids, VALID_IDS),
    "label_paths": (label_paths, LABEL_PATHS),
    "paths_relocated": (paths_relocated, PATHS_RELOCATED),
    "paths_compatible": (paths_compatible, PATHS_COMPATIBLE),
    "json_paths": (json_paths, JSON_PATHS),
    "json_paths_relative": (json_paths_relative, JSON_PATHS_RELATIVE),
    "report_names": (report_names, REPORT_NAMES),
    "rotation_jump": (rotation_jump, ROTATION_JUMP),
    "intrinsics_scaled": (intrinsics_scaled, INTRINSICS),
    "class_names_map": (class_names_map, CLASS_NAMES),
}
