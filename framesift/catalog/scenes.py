"""Scene inventory and workflow state."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..constants import OFFICIAL_CLASSES
from ..functions.text import class_of_scene, scene_name, session_id, video_id
from ..operators import inventory as inv
from . import views as v


def _streams(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Colour frames, depth frames, recorded frames and scenes, with gaps in each."""
    e = v.events(spark, sf_dir).select("scene_id", "frame_id", "event_type", "value", "user_id")
    clean = F.col("user_id") % 3 == 0
    rgb = e.where(clean | ~((F.col("event_type") == "error") & (F.col("value") < 8)))
    depth = e.where(clean | ~((F.col("event_type") == "view") & (F.col("value") < 8)))
    recorded = e.where(clean | (F.col("value") >= F.when(F.col("user_id") % 3 == 1, 8).otherwise(4)))
    scenes = e.groupBy("scene_id").agg(F.max(F.when((F.col("user_id") % 10 == 1), "unreadable")).alias("metadata_error"))
    return rgb.select("scene_id", "frame_id"), depth.select("scene_id", "frame_id"), recorded.select("scene_id", "frame_id"), scenes


_STREAMS = f"""{v.EVENTS}, b AS (
  SELECT scene_id, frame_id, user_id, user_id % 3 = 0 OR NOT (event_type = 'error' AND value < 8) AS r, user_id % 3 = 0 OR NOT (event_type = 'view' AND value < 8) AS d,
         user_id % 3 = 0 OR value >= (CASE WHEN user_id % 3 = 1 THEN 8 ELSE 4 END) AS m FROM ev), it AS (
  SELECT scene_id, max(CASE WHEN user_id % 10 = 1 THEN 'unreadable' END) AS metadata_error, count(*) FILTER (r) AS rgb_count, count(*) FILTER (d) AS depth_count,
    count(*) FILTER (r AND d) AS paired_count, count(*) FILTER (r AND NOT d) AS orphan_rgb, count(*) FILTER (d AND NOT r) AS orphan_depth,
    count(*) FILTER (m AND NOT r) AS recorded_without_rgb, count(*) FILTER (m AND NOT d) AS recorded_without_depth, count(*) FILTER (m) AS recorded,
    count(*) FILTER (r <> d AND NOT m) AS loose FROM b GROUP BY scene_id), ig AS (
  SELECT *, CASE WHEN metadata_error IS NULL THEN loose ELSE 0 END AS safe_orphans, recorded_without_rgb + recorded_without_depth AS unsafe_missing,
    orphan_rgb + orphan_depth = 0 AND recorded_without_rgb + recorded_without_depth = 0 AS is_complete FROM it)"""


def scene_integrity(spark, sf_dir) -> DataFrame:
    i = inv.scene_integrity(*_streams(spark, sf_dir))
    flags = ("is_complete", "can_auto_repair")
    return i.select(*[c for c in i.columns if c not in flags], *[v.long(F.col(c), c) for c in flags])


SCENE_INTEGRITY = f"""WITH {_STREAMS}
SELECT * EXCLUDE (loose, is_complete), CAST(is_complete AS BIGINT) AS is_complete,
  CAST(orphan_rgb + orphan_depth > 0 AND safe_orphans = orphan_rgb + orphan_depth AND unsafe_missing = 0 AND metadata_error IS NULL AS BIGINT) AS can_auto_repair FROM ig"""


def unsafe_recorded(spark, sf_dir) -> DataFrame:
    rgb, depth, recorded, _ = _streams(spark, sf_dir)
    return inv.unsafe_recorded(rgb, depth, recorded)


UNSAFE = f"""WITH {_STREAMS} SELECT scene_id, frame_id || ':rgb' AS item FROM b WHERE m AND NOT r UNION ALL SELECT scene_id, frame_id || ':depth' FROM b WHERE m AND NOT d"""


def discardable(spark, sf_dir) -> DataFrame:
    """Sessions (customers) without any event frame."""
    c = v.table(spark, sf_dir, "customer").select(F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("scene_id"))
    rgb, depth, _, _ = _streams(spark, sf_dir)
    return inv.discardable_sessions(c, rgb, depth)


DISCARDABLE = "SELECT 'u' || c_custkey AS scene_id FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)"


def _documents(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Manifests, export reports and review markers of the scenes, from customers and orders."""
    c = v.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    k = F.col("c_custkey")
    scene = F.concat(F.lit("u"), k.cast("string"))
    splits = F.array(*[F.when(k % m != r, F.lit(s)) for s, m, r in (("train", 4, 1), ("val", 3, 2), ("test", 2, 1))])
    manifests = c.select(
        scene.alias("scene_id"), F.explode(F.array_compact(splits)).alias("file_split"), "c_nationkey"
    ).withColumns({"manifest_path": F.concat_ws("_", "scene_id", "file_split"), "split": F.when(F.col("c_nationkey") % 7 == 0, "val")})
    o = v.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    per = o.groupBy("o_custkey", "o_orderstatus").agg(F.max("o_orderkey").alias("version"), F.count(F.lit(1)).alias("n"))
    split = F.when(F.col("o_orderstatus") == "F", "train").when(F.col("o_orderstatus") == "O", "val").otherwise("test")
    reports = per.select(
        F.concat(F.lit("u"), F.col("o_custkey").cast("string")).alias("scene_id"),
        split.alias("file_split"),
        F.concat_ws("_", F.lit("rep"), F.col("o_custkey").cast("string"), split).alias("report_path"),
        "version",
        (F.col("n") - 1).alias("accepted"),
        (F.col("version") % 3).alias("review"),
        (F.col("version") % 2).alias("rejected"),
    )
    markers = reports.where("file_split = 'train'").select(
        "scene_id",
        F.col("scene_id").alias("m_scene"),
        F.when(F.col("version") % 9 != 0, "can").otherwise("box").alias("m_class"),
        "report_path",
        (F.col("version") + F.when(F.col("version") % 5 == 0, 1).otherwise(0)).alias("m_version"),
    ).withColumnRenamed("report_path", "m_report")
    return manifests, reports, markers


_DOCS = """mf AS (
  SELECT 'u' || c_custkey AS scene_id, s.split AS file_split, s.r, CASE WHEN c_nationkey % 7 = 0 THEN 'val' ELSE s.split END AS split, 'u' || c_custkey || '_' || s.split AS manifest_path
  FROM customer, (VALUES ('train', 1, 4, 1), ('val', 2, 3, 2), ('test', 3, 2, 1)) s(split, r, m, x) WHERE c_custkey % m <> x), pm AS (
  SELECT scene_id, arg_min(manifest_path, r) AS manifest_path, arg_min(split, r) AS split FROM mf GROUP BY scene_id), rp AS (
  SELECT 'u' || o_custkey AS scene_id, CASE o_orderstatus WHEN 'F' THEN 'train' WHEN 'O' THEN 'val' ELSE 'test' END AS file_split, max(o_orderkey) AS version, count(*) - 1 AS accepted,
    'rep_' || o_custkey || '_' || CASE o_orderstatus WHEN 'F' THEN 'train' WHEN 'O' THEN 'val' ELSE 'test' END AS report_path FROM orders GROUP BY o_custkey, o_orderstatus), """
_CHOSEN = """sc AS (SELECT scene_id, manifest_path, coalesce(split, 'train') AS split FROM bs LEFT JOIN pm USING (scene_id)), ch AS (
  SELECT sc.scene_id, arg_min(struct_pack(p := report_path, v := version, a := accepted), CASE WHEN file_split = sc.split THEN 0 WHEN file_split = 'train' THEN 1 WHEN file_split = 'val' THEN 2 ELSE 3 END) AS c
  FROM sc JOIN rp USING (scene_id) GROUP BY sc.scene_id), ex AS (
  SELECT sc.*, c.p AS report_path, c.v AS version, c.a AS accepted, c.v % 3 AS review, c.v % 2 AS rejected FROM sc LEFT JOIN ch USING (scene_id)), mk AS (
  SELECT scene_id, CASE WHEN version % 9 <> 0 THEN 'can' ELSE 'box' END AS m_class, report_path AS m_report, version + CASE WHEN version % 5 = 0 THEN 1 ELSE 0 END AS m_version FROM rp WHERE file_split = 'train'), rv AS (
  SELECT ex.*, CASE WHEN m_class IS NULL THEN 'marker_missing' WHEN m_class <> 'can' THEN 'marker_invalid' WHEN report_path IS NULL THEN 'export_report_missing'
    WHEN m_report <> report_path OR m_version <> version THEN 'export_report_changed' ELSE 'valid' END AS review_state FROM ex LEFT JOIN mk USING (scene_id))"""


def _with_documents(scenes: DataFrame, spark, sf_dir) -> DataFrame:
    manifests, reports, markers = _documents(spark, sf_dir)
    found = inv.preferred_report(inv.preferred_manifest(scenes, manifests), reports)
    return inv.review_marker_state(found, markers)


def scene_documents(spark, sf_dir) -> DataFrame:
    """Manifest, report and review state of every customer scene."""
    c = v.table(spark, sf_dir, "customer").select(F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("scene_id"), F.lit("can").alias("class_name"))
    return _with_documents(c, spark, sf_dir).select("scene_id", "manifest_path", "split", "report_path", "version", "review_state")


SCENE_DOCUMENTS = f"WITH {_DOCS} bs AS (SELECT 'u' || c_custkey AS scene_id FROM customer), {_CHOSEN} SELECT scene_id, manifest_path, split, report_path, version, review_state FROM rv"


def _states(spark, sf_dir) -> DataFrame:
    integrity = inv.scene_integrity(*_streams(spark, sf_dir)).select("scene_id", "paired_count", "is_complete")
    user = F.substring("scene_id", 2, 20).cast("long")
    scenes = integrity.withColumns(
        {"class_name": F.lit("can"), "has_segments": user % 8 != 3, "masks_total": user % 5, "masks_done": F.when(user % 7 == 0, 0).otherwise(user % 5)}
    )
    return inv.next_action(inv.scene_state(_with_documents(scenes, spark, sf_dir)))


def scene_state(spark, sf_dir) -> DataFrame:
    return _states(spark, sf_dir).select("scene_id", "group", "code", "color", "next_action")


_STATES = f"""{_STREAMS}, {_DOCS} bs AS (SELECT scene_id FROM ig), {_CHOSEN}, jn AS (
  SELECT rv.*, paired_count, is_complete, CAST(substr(rv.scene_id, 2) AS BIGINT) AS u FROM rv JOIN ig USING (scene_id)), mt AS (
  SELECT *, u % 8 <> 3 AS has_segments, u % 5 > 0 AND (u % 7 <> 0) AS complete FROM jn), cd AS (
  SELECT *, CASE WHEN paired_count <= 0 OR NOT is_complete THEN 'rgbd_incomplete' WHEN manifest_path IS NULL THEN 'manifest_missing' WHEN NOT has_segments THEN 'segments_missing' WHEN NOT complete THEN 'masks_missing'
    WHEN report_path IS NULL THEN 'pending_export' WHEN accepted <= 0 THEN 'export_failed' WHEN review + rejected > 0 THEN 'export_needs_review' ELSE 'dataset_ready' END AS code FROM mt), ss AS (
  SELECT *, CASE WHEN code IN ('rgbd_incomplete', 'manifest_missing', 'segments_missing', 'masks_missing') THEN 'needs_manual' WHEN code <> 'pending_export' AND review_state = 'valid' THEN 'human_reviewed' ELSE 'keyframes_complete' END AS "group",
    CASE code WHEN 'pending_export' THEN 'blue' WHEN 'export_failed' THEN 'red' WHEN 'export_needs_review' THEN 'yellow' WHEN 'dataset_ready' THEN 'green' ELSE 'gray' END AS color,
    CASE WHEN manifest_path IS NULL THEN 'manifest_missing' WHEN NOT has_segments THEN 'segment' WHEN NOT complete THEN 'mask' ELSE 'run' END AS next_action FROM cd)"""
SCENE_STATE = f'WITH {_STATES} SELECT scene_id, "group", code, color, next_action FROM ss'


def _classed(spark, sf_dir) -> DataFrame:
    names = F.array(*[F.lit(n) for n in OFFICIAL_CLASSES.values()])
    number = (F.substring("scene_id", 2, 20).cast("long") % 9 + 1).cast("int")
    return _states(spark, sf_dir).withColumn("class_name", F.element_at(names, number))


def class_workflow(spark, sf_dir) -> DataFrame:
    return inv.class_workflow(_classed(spark, sf_dir))


_LIST = ", ".join(f"'{n}'" for n in OFFICIAL_CLASSES.values())
CLASS_WORKFLOW = f"""WITH {_STATES} SELECT ([{_LIST}])[u % 9 + 1] AS class_name, count(*) AS scenes, CAST(sum(paired_count) AS BIGINT) AS paired_frames,
  CAST(coalesce(sum(accepted + review + rejected), 0) AS BIGINT) AS processed_frames, CAST(coalesce(sum(accepted), 0) AS BIGINT) AS accepted, CAST(coalesce(sum(review), 0) AS BIGINT) AS review,
  CAST(coalesce(sum(rejected), 0) AS BIGINT) AS rejected, count(*) FILTER (code = 'pending_export') AS pending_propagation, count(*) FILTER ("group" = 'needs_manual') AS needs_manual FROM ss GROUP BY 1"""


def training_readiness(spark, sf_dir) -> DataFrame:
    return inv.training_readiness(_states(spark, sf_dir))


READINESS = f"""WITH {_STATES} SELECT count(*) FILTER (accepted > 0) AS usable_scenes, count(*) FILTER ("group" = 'needs_manual') AS manual_scenes,
  count(*) FILTER (code = 'pending_export') AS pending_scenes, CAST(coalesce(sum(accepted), 0) AS BIGINT) AS accepted_frames FROM ss"""


def state_listing(spark, sf_dir) -> DataFrame:
    return inv.state_listing(_states(spark, sf_dir)).select("scene_id", "group", v.long("group_rank", "group_rank"))


STATE_LISTING = f"""WITH {_STATES} SELECT scene_id, "group", CAST(CASE "group" WHEN 'needs_manual' THEN 1 WHEN 'keyframes_complete' THEN 2 ELSE 3 END AS BIGINT) AS group_rank FROM ss"""


def expected_frames(spark, sf_dir) -> DataFrame:
    return inv.expected_split_frames(v.reports(spark, sf_dir))


EXPECTED_FRAMES = f"WITH {v.REPORTS} SELECT split, CAST(sum(accepted) AS BIGINT) AS frames FROM rep GROUP BY split"


def _project_files(spark, sf_dir) -> DataFrame:
    """All files of a project: images, labels, key masks and reports."""
    images = v.document_files(spark, sf_dir).select("split", F.lit("image").alias("kind"), "stem", "path")
    split = F.when(F.col("doc_id") % 5 == 0, "val").otherwise("train")
    stem = F.col("doc_id").cast("string")
    labels = v.table(spark, sf_dir, "labels").select(split.alias("split"), F.lit("label").alias("kind"), stem.alias("stem"), F.concat(F.lit("labels/"), stem).alias("path"))
    key = F.col("p_partkey").cast("string")
    masks = v.table(spark, sf_dir, "part").select(F.lit("").alias("split"), F.lit("key_mask").alias("kind"), key.alias("stem"), F.concat(F.lit("keys/"), key).alias("path"))
    name = F.col("s_suppkey").cast("string")
    reports = v.table(spark, sf_dir, "supplier").select(F.lit("").alias("split"), F.lit("report").alias("kind"), name.alias("stem"), F.concat(F.lit("reports/"), name).alias("path"))
    return images.unionByName(labels).unionByName(masks).unionByName(reports)


def snapshot_counts(spark, sf_dir) -> DataFrame:
    scenes = v.table(spark, sf_dir, "events").select(F.col("user_id").alias("scene_id")).distinct()
    return inv.snapshot_counts(_project_files(spark, sf_dir), scenes)


SNAPSHOT = """SELECT (SELECT count(DISTINCT user_id) FROM events) AS scenes, (SELECT count(*) FROM part) AS key_masks, (SELECT count(*) FROM supplier) AS reports,
  (SELECT count(DISTINCT doc_id) FROM labels WHERE doc_id IN (SELECT doc_id FROM documents) AND doc_id % 5 <> 0) AS train_pairs,
  (SELECT count(DISTINCT doc_id) FROM labels WHERE doc_id IN (SELECT doc_id FROM documents) AND doc_id % 5 = 0) AS val_pairs"""


def file_kind_counts(spark, sf_dir) -> DataFrame:
    return inv.file_kind_counts(_project_files(spark, sf_dir))


FILE_KINDS = """SELECT * FROM (SELECT 'image' AS kind, count(*) AS files FROM documents UNION ALL SELECT 'label', count(*) FROM labels UNION ALL SELECT 'key_mask', count(*) FROM part UNION ALL SELECT 'report', count(*) FROM supplier)"""


def dataset_descriptor(spark, sf_dir) -> DataFrame:
    d = inv.dataset_descriptor(_project_files(spark, sf_dir), allow_val_fallback=True)
    return d.select("train", "val", "test", v.long(F.col("val_has_images"), "val_has_images"), v.long(F.col("test_has_images"), "test_has_images"))


DESCRIPTOR = """SELECT 'images/train' AS train, CASE WHEN count(*) FILTER (doc_id % 5 = 0) > 0 THEN 'images/val' ELSE 'images/train' END AS val, CAST(NULL AS VARCHAR) AS test,
  CAST(count(*) FILTER (doc_id % 5 = 0) > 0 AS BIGINT) AS val_has_images, CAST(0 AS BIGINT) AS test_has_images FROM documents"""


def independent_val(spark, sf_dir) -> DataFrame:
    i = inv.independent_val(_project_files(spark, sf_dir), "images/train", "images/val/")
    return i.select("val_images", v.long(F.col("independent"), "independent"))


INDEPENDENT_VAL = "SELECT count(*) AS val_images, CAST(count(*) > 0 AS BIGINT) AS independent FROM documents WHERE doc_id % 5 = 0"


def next_sequence(spark, sf_dir) -> DataFrame:
    """Next capture number per class and day."""
    o = v.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    names = F.array(*[F.lit(n) for n in OFFICIAL_CLASSES.values()])
    cls = F.element_at(names, (F.col("o_custkey") % 9 + 1).cast("int"))
    day = F.date_format("o_orderdate", "yyyyMM")
    text = F.concat_ws("_", cls, day, F.when(F.col("o_orderkey") % 6 == 0, F.lit("xx")).otherwise((F.col("o_orderkey") % 100).cast("string")))
    return inv.next_sequence(o.select(cls.alias("class_name"), day.alias("month"), text.alias("name")), r"^[a-z_]+_[0-9]{6}_([0-9]+)$", ["class_name", "month"])


NEXT_SEQUENCE = f"""SELECT ([{_LIST}])[o_custkey % 9 + 1] AS class_name, strftime(o_orderdate, '%Y%m') AS month,
  CAST(coalesce(max(CASE WHEN o_orderkey % 6 <> 0 THEN o_orderkey % 100 END), 0) + 1 AS BIGINT) AS next_number FROM orders GROUP BY 1, 2"""


def capture_names(spark, sf_dir) -> DataFrame:
    """Names and ids of new captures, and the class read back from the name."""
    o = v.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    prefixes = F.array(*[F.lit(n) for n in ("can", "yellow_can", "meal_box", "red_paper_bag", "canister", "green_bin")])
    name = scene_name(F.element_at(prefixes, (F.col("o_custkey") % 6 + 1).cast("int")), F.col("o_orderdate"), F.col("o_orderkey") % 120)
    return o.select("o_orderkey", name.alias("scene"), session_id(name).alias("capture_session_id"), video_id(name).alias("source_video_id"), class_of_scene(name).alias("class_name"))


CAPTURE_NAMES = """WITH n AS (SELECT o_orderkey, (['can', 'yellow_can', 'meal_box', 'red_paper_bag', 'canister', 'green_bin'])[o_custkey % 6 + 1] AS p,
  strftime(o_orderdate, '_%Y%m%d_%H%M_') || CASE WHEN o_orderkey % 120 < 10 THEN '0' ELSE '' END || (o_orderkey % 120) AS t FROM orders)
SELECT o_orderkey, p || t AS scene, 'session_' || p || t AS capture_session_id, p || t || '_clip_01' AS source_video_id,
  CASE p WHEN 'yellow_can' THEN 'can' WHEN 'canister' THEN NULL ELSE p END AS class_name FROM n"""


def roster(spark, sf_dir) -> DataFrame:
    scenes = v.table(spark, sf_dir, "events").select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("scene_id")).distinct()
    r = inv.roster(scenes, v.class_catalogue(spark), 2, include_bins=True, can_tracker="foundationpose")
    return r.select("scene_id", "instance_id", v.long("class_id", "class_id"), "class_name", "tracker")


ROSTER = f"""WITH {v.CLASSES} SELECT 'u' || user_id AS scene_id, class_name || '_0' || k AS instance_id, CAST(class_id AS BIGINT) AS class_id, class_name,
  CASE WHEN class_id = 0 THEN 'foundationpose' ELSE 'sam2' END AS tracker FROM (SELECT DISTINCT user_id FROM events), cls, (VALUES (1), (2)) n(k) WHERE class_id < 4 OR (class_id < 7 AND k = 1)"""


def scene_manifests(spark, sf_dir) -> DataFrame:
    """Manifests that refer to a scene, counted per scene."""
    manifests, _, _ = _documents(spark, sf_dir)
    scenes = v.table(spark, sf_dir, "customer").select(F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("scene"))
    return inv.manifests_of_scene(scenes, manifests.withColumnRenamed("scene_id", "scene"))


SCENE_MANIFESTS = f"WITH {_DOCS} x AS (SELECT 1) SELECT scene_id AS scene, manifest_path FROM mf"


def reviewable_instances(spark, sf_dir) -> DataFrame:
    p = v.table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_name")
    k = F.col("p_partkey")
    ids = [F.lit("s").alias("scene_id"), k.cast("string").alias("instance_id")]
    export = p.select(*ids, F.when(k % 7 > 0, F.concat(F.lit("stage/"), k.cast("string"))).otherwise(F.lit("")).alias("stage"), F.when(k % 2 == 0, "sam2").otherwise("mask_sequence").alias("tracker"))
    manifest = p.where("p_size > 3").select(
        *ids, F.when(k % 5 == 0, "foundationpose").when(k % 5 == 1, "sam2").alias("tracker"), F.when(k % 3 == 0, F.lit("k")).alias("key_mask_dir"), F.when(k % 4 == 0, F.lit("g")).alias("registration_mask_dir")
    )
    return inv.reviewable_instances(export, manifest).select("instance_id", "stage", "key_dir")


REVIEWABLE = """SELECT CAST(p_partkey AS VARCHAR) AS instance_id, 'stage/' || p_partkey AS stage, CASE WHEN p_partkey % 3 = 0 THEN 'k' ELSE 'g' END AS key_dir FROM part
WHERE p_size > 3 AND p_partkey % 7 > 0 AND (p_partkey % 3 = 0 OR p_partkey % 4 = 0) AND (p_partkey % 5 = 1 OR (p_partkey % 5 > 1 AND p_partkey % 2 = 0))"""

QUERIES = {
    "scene_integrity": (scene_integrity, SCENE_INTEGRITY),
    "unsafe_recorded": (unsafe_recorded, UNSAFE),
    "discardable_sessions": (discardable, DISCARDABLE),
    "scene_documents": (scene_documents, SCENE_DOCUMENTS),
    "scene_state": (scene_state, SCENE_STATE),
    "class_workflow": (class_workflow, CLASS_WORKFLOW),
    "training_readiness": (training_readiness, READINESS),
    "state_listing": (state_listing, STATE_LISTING),
    "expected_split_frames": (expected_frames, EXPECTED_FRAMES),
    "snapshot_counts": (snapshot_counts, SNAPSHOT),
    "file_kind_counts": (file_kind_counts, FILE_KINDS),
    "dataset_descriptor": (dataset_descriptor, DESCRIPTOR),
    "independent_val": (independent_val, INDEPENDENT_VAL),
    "next_sequence": (next_sequence, NEXT_SEQUENCE),
    "capture_names": (capture_names, CAPTURE_NAMES),
    "scene_roster": (roster, ROSTER),
    "scene_manifests": (scene_manifests, SCENE_MANIFESTS),
    "reviewable_instances": (reviewable_instances, REVIEWABLE),
}
