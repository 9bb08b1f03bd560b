"""Rerun ranges, range algebra and incremental replacement."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import range_end, range_start, range_text
from ..operators import review as r
from . import views as v

SEGMENT = 12


def _frames(spark, sf_dir) -> DataFrame:
    e = v.events(spark, sf_dir)
    status = F.when(F.col("event_type") == "purchase", "accepted").when(F.col("value") < 30, "rejected").otherwise("review")
    return e.select(
        "scene_id",
        F.lit("obj").alias("instance_id"),
        F.floor(F.col("idx") / SEGMENT).alias("segment_id"),
        "frame_id",
        F.col("idx").alias("position"),
        status.alias("effective_status"),
        "event_id",
        "event_type",
        "value",
        "user_id",
    )


_FRAMES = f"""{v.EVENTS}, fr AS (
  SELECT *, idx // {SEGMENT} AS seg, CASE WHEN event_type = 'purchase' THEN 'accepted' WHEN value < 30 THEN 'rejected' ELSE 'review' END AS st FROM ev)"""


def rerun_ranges(spark, sf_dir) -> DataFrame:
    f = _frames(spark, sf_dir)
    found = r.rerun_ranges(f, f.where("effective_status = 'rejected'"))
    return found.select("scene_id", "segment_id", "start_frame", "last_frame", "end_before_frame", "boundary_reason")


RERUN_RANGES = f"""WITH {_FRAMES}, n AS (
  SELECT *, min(CASE WHEN st = 'accepted' THEN idx END) OVER (PARTITION BY scene_id, seg ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nx,
         max(idx) OVER (PARTITION BY scene_id, seg) AS sl, max(idx) OVER (PARTITION BY scene_id) AS el FROM fr)
SELECT scene_id, seg AS segment_id, frame_id AS start_frame, lpad(CAST(CASE WHEN nx IS NOT NULL THEN nx - 1 ELSE sl END AS VARCHAR), 6, '0') AS last_frame,
       CASE WHEN nx IS NOT NULL THEN lpad(CAST(nx AS VARCHAR), 6, '0') WHEN sl < el THEN lpad(CAST(sl + 1 AS VARCHAR), 6, '0') END AS end_before_frame,
       CASE WHEN nx IS NOT NULL THEN 'next_accepted' ELSE 'segment_end' END AS boundary_reason FROM n WHERE st = 'rejected'"""


def merge_ranges(spark, sf_dir) -> DataFrame:
    f = _frames(spark, sf_dir).withColumnRenamed("position", "start_pos")
    spans = f.select("scene_id", "instance_id", "segment_id", "start_pos", (F.col("start_pos") + 1 + F.floor(F.col("value") / 40)).alias("end_pos"), "effective_status")
    merged = r.merge_ranges(spans.where("effective_status = 'rejected'"))
    return merged.select("scene_id", "segment_id", "start_pos", "end_pos", "merged")


_MERGED = f"""{_FRAMES}, s AS (SELECT scene_id, seg, idx AS a, idx + 1 + CAST(floor(value / 40) AS BIGINT) AS b FROM fr WHERE st = 'rejected'), m AS (
  SELECT *, max(b) OVER (PARTITION BY scene_id, seg ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM s), g AS (
  SELECT *, sum(CASE WHEN reach IS NULL OR a > reach THEN 1 ELSE 0 END) OVER (PARTITION BY scene_id, seg ORDER BY a) AS island FROM m)"""
MERGE_RANGES = f"WITH {_MERGED} SELECT scene_id, seg AS segment_id, min(a) AS start_pos, max(b) AS end_pos, count(*) AS merged FROM g GROUP BY scene_id, seg, island"


def validate_ranges(spark, sf_dir) -> DataFrame:
    f = _frames(spark, sf_dir)
    e, p = F.col("event_id"), F.col("position")
    name = lambda c: F.lpad(c.cast("string"), 6, "0")
    requests = f.select(
        e.alias("request_id"),
        "scene_id",
        F.when(e % 29 == 0, "999999").otherwise(F.col("frame_id")).alias("start_frame"),
        F.when(e % 3 == 0, F.lit(None)).when(e % 3 == 1, name(p + e % 7)).otherwise(F.lit("")).alias("end_before_frame"),
        F.when(e % 5 == 0, (F.floor(p / SEGMENT) + (e % 2)).cast("string")).alias("segment_id"),
    )
    frames = f.select("scene_id", "frame_id", "position", (F.col("value") > 3).alias("active"))
    spans = f.groupBy("scene_id", F.col("segment_id").cast("string").alias("segment_id")).agg(F.min("position").alias("start_pos"), F.max("position").alias("end_pos"))
    return r.validate_ranges(requests, frames, spans).select("request_id", "start_pos", "end_pos", "error")


VALIDATE_RANGES = f"""WITH {_FRAMES}, mx AS (SELECT scene_id, max(idx) AS last FROM fr GROUP BY 1), q AS (
  SELECT event_id, fr.scene_id, CASE WHEN event_id % 29 <> 0 THEN idx END AS a, seg, last, least(seg * {SEGMENT} + {SEGMENT - 1}, last) AS sl,
    CASE WHEN event_id % 3 = 1 THEN idx + event_id % 7 END AS e, event_id % 3 <> 1 AS open, CASE WHEN event_id % 5 = 0 THEN seg + event_id % 2 END AS dec FROM fr JOIN mx USING (scene_id)), b AS (
  SELECT *, CASE WHEN open THEN CASE WHEN a IS NOT NULL THEN sl + 1 END WHEN e <= last THEN e END AS z FROM q)
SELECT event_id AS request_id, a AS start_pos, z AS end_pos,
       CASE WHEN a IS NULL THEN 'start_outside_segments' WHEN dec <> seg THEN 'segment_mismatch' WHEN z IS NULL THEN 'end_unknown' WHEN z <= a THEN 'end_not_after_start'
            WHEN z - 1 > sl THEN 'crosses_segment' WHEN EXISTS (SELECT 1 FROM fr i WHERE i.scene_id = b.scene_id AND i.idx >= a AND i.idx < z AND i.value <= 3) THEN 'outside_active_frames' END AS error
FROM b"""


def reject_tail(spark, sf_dir) -> DataFrame:
    f = _frames(spark, sf_dir)
    asked = f.where("event_type = 'error' and value > 70")
    a = r.reject_tail(f, asked, "segment").select("scene_id", "frame_id", "reason")
    b = r.reject_tail(f, f.where("event_type = 'error' and value > 150"), "scene").select("scene_id", "frame_id", "reason")
    return a.unionByName(b)


REJECT_TAIL = f"""WITH {_FRAMES}
SELECT scene_id, frame_id, 'manual_rejected_segment_tail' AS reason FROM fr WHERE idx >= (SELECT min(idx) FROM fr x WHERE x.scene_id = fr.scene_id AND x.seg = fr.seg AND event_type = 'error' AND value > 70)
UNION ALL SELECT scene_id, frame_id, 'manual_rejected_scene_tail' FROM fr WHERE idx >= (SELECT min(idx) FROM fr x WHERE x.scene_id = fr.scene_id AND event_type = 'error' AND value > 150)"""


def reject_range(spark, sf_dir) -> DataFrame:
    f = _frames(spark, sf_dir)
    other = F.lpad(F.greatest(F.col("position") + F.col("event_id") % 9 - 4, F.lit(0)).cast("string"), 6, "0")
    marks = f.where("event_type = 'signup' and value > 40").select("scene_id", "instance_id", F.col("frame_id").alias("mark_a"), other.alias("mark_b"))
    return r.reject_range(f, marks).select("scene_id", "frame_id", "reason")


REJECT_RANGE = f"""WITH {_FRAMES}, k AS (SELECT scene_id, idx AS a, greatest(idx + event_id % 9 - 4, 0) AS b FROM fr WHERE event_type = 'signup' AND value > 40)
SELECT DISTINCT fr.scene_id, frame_id, 'manual_problem_range' AS reason FROM fr JOIN k ON k.scene_id = fr.scene_id AND idx BETWEEN least(a, b) AND greatest(a, b)"""


def report_upsert(spark, sf_dir) -> DataFrame:
    """Records of the propagation report after replacing the rejected frames."""
    f = _frames(spark, sf_dir)
    keys = ("scene_id", "instance_id", "frame_id")
    old = f.select(*keys, F.col("effective_status").alias("status"), F.lit("old").alias("mode"))
    partial = f.where("value < 60").select(*keys, F.lit("accepted").alias("status"), F.lit("track").alias("mode"))
    replaced = f.where("effective_status = 'rejected'").select(*keys)
    merged, _ = r.upsert_report(old, partial, replaced)
    return merged.groupBy("scene_id", "status", "mode").agg(F.count(F.lit(1)).alias("frames"), F.min("frame_id").alias("first_frame"), F.max("frame_id").alias("last_frame"))


REPORT_UPSERT = f"""WITH {_FRAMES}, m AS (SELECT scene_id, frame_id, CASE WHEN st = 'rejected' AND value < 60 THEN 'accepted' ELSE st END AS status,
  CASE WHEN st = 'rejected' AND value < 60 THEN 'track' ELSE 'old' END AS mode FROM fr)
SELECT scene_id, status, mode, count(*) AS frames, min(frame_id) AS first_frame, max(frame_id) AS last_frame FROM m GROUP BY ALL"""


def upsert_missing(spark, sf_dir) -> DataFrame:
    f = _frames(spark, sf_dir)
    keys = ("scene_id", "instance_id", "frame_id")
    partial = f.where("value > 5").select(*keys)
    replaced = f.where("effective_status = 'rejected'").select(*keys)
    return r.upsert_report(f.select(*keys), partial, replaced)[1].select("rule", "key")


UPSERT_MISSING = f"WITH {_FRAMES} SELECT 'partial_record_missing' AS rule, scene_id || '/obj/' || frame_id AS key FROM fr WHERE st = 'rejected' AND value <= 5"


def replace_masks(spark, sf_dir) -> DataFrame:
    """Mask areas after replacing the masks of rejected frames."""
    f = _frames(spark, sf_dir)
    keys = ("scene_id", "instance_id", "frame_id")
    old = f.select(*keys, F.floor("value").cast("long").alias("mask_area"))
    new = f.where("value > 10").select(*keys, (F.col("event_id") % 1000).alias("mask_area"))
    done = r.replace_masks(old, new, f.where("effective_status = 'rejected'").select(*keys))
    return done.select("scene_id", "frame_id", "mask_area")


REPLACE_MASKS = f"""WITH {_FRAMES} SELECT scene_id, frame_id, CASE WHEN st = 'rejected' THEN event_id % 1000 ELSE CAST(floor(value) AS BIGINT) END AS mask_area FROM fr WHERE st <> 'rejected' OR value > 10"""


def report_completeness(spark, sf_dir) -> DataFrame:
    f = _frames(spark, sf_dir)
    return r.missing_from_report(f, f.where("event_type <> 'view'")).select("scene_id", "frame_id")


REPORT_COMPLETENESS = f"WITH {_FRAMES} SELECT scene_id, frame_id FROM fr WHERE event_type = 'view'"


def review_batches(spark, sf_dir) -> DataFrame:
    segments = _frames(spark, sf_dir).select("scene_id", "segment_id").distinct()
    return r.review_batches(segments)


REVIEW_BATCHES = f"WITH {_FRAMES} SELECT scene_id, seg AS segment_id, (row_number() OVER (PARTITION BY scene_id ORDER BY seg) - 1) // 3 AS batch FROM (SELECT DISTINCT scene_id, seg FROM fr)"


def accept_violations(spark, sf_dir) -> DataFrame:
    f = _frames(spark, sf_dir)
    keys = ("scene_id", "instance_id", "frame_id")
    decisions = f.select(*keys, F.col("effective_status").alias("status"))
    areas = f.where("value > 1").select(*keys, F.floor(F.col("value") - 3).cast("long").alias("mask_area"))
    return r.accept_violations(decisions, areas).select("scene_id", "frame_id", "rule")


ACCEPT_VIOLATIONS = f"WITH {_FRAMES} SELECT scene_id, frame_id, 'accept_without_mask' AS rule FROM fr WHERE st = 'accepted' AND (value <= 1 OR floor(value - 3) <= 0)"


def range_texts(spark, sf_dir) -> DataFrame:
    """Range specifications read from text and written for people."""
    f = _frames(spark, sf_dir)
    end = F.when(F.col("event_id") % 4 == 0, F.lit("")).otherwise(F.lpad((F.col("position") + 3).cast("string"), 6, "0"))
    spec = F.when(F.col("event_id") % 10 == 0, F.col("frame_id")).otherwise(F.concat(F.lit(" "), "frame_id", F.lit(":"), end, F.lit(" ")))
    start, stop = range_start(spec), range_end(spec)
    return f.select("event_id", start.alias("start_frame"), stop.alias("end_before_frame"), range_text(start, stop, F.lit("999999")).alias("text"))


RANGE_TEXTS = f"""WITH {v.EVENTS}, s AS (SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN frame_id END AS a, CASE WHEN event_id % 10 <> 0 AND event_id % 4 <> 0 THEN lpad(CAST(idx + 3 AS VARCHAR), 6, '0') END AS b FROM ev)
SELECT event_id, a AS start_frame, b AS end_before_frame, CASE WHEN b IS NULL THEN a || '–999999（包含末帧）' ELSE a || '–' || b || '（结束边界不包含）' END AS text FROM s"""


QUERIES = {
    "rerun_ranges": (rerun_ranges, RERUN_RANGES),
    "merge_ranges": (merge_ranges, MERGE_RANGES),
    "validate_ranges": (validate_ranges, VALIDATE_RANGES),
    "reject_tail": (reject_tail, REJECT_TAIL),
    "reject_range": (reject_range, REJECT_RANGE),
    "report_upsert": (report_upsert, REPORT_UPSERT),
    "upsert_missing": (upsert_missing, UPSERT_MISSING),
    "replace_masks": (replace_masks, REPLACE_MASKS),
    "report_completeness": (report_completeness, REPORT_COMPLETENESS),
    "review_batches": (review_batches, REVIEW_BATCHES),
    "accept_violations": (accept_violations, ACCEPT_VIOLATIONS),
    "range_texts": (range_texts, RANGE_TEXTS),
}
