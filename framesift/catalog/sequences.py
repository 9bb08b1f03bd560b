"""Scene cuts, timestamp gaps, segments and key-mask planning."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import detections, metrics, segments as seg
from ..plans.blocks import index_block
from ..session import stored
from . import views as v

MAX_FRAMES = 10


def scene_cuts(spark, sf_dir) -> DataFrame:
    e = v.table(spark, sf_dir, "embeddings")
    vectors = e.select(
        F.concat(F.lit("l"), F.col("label").cast("string")).alias("scene_id"),
        "vec_id",
        F.when(F.col("vec_id") % 29 != 0, F.col("embedding")).alias("vec"),
    )
    found = seg.scene_cuts(vectors, 0.145, "vec_id", index_block(F.col("vec_id")))
    return found.select("scene_id", "vec_id", v.r6("visual_diff", "visual_diff"), v.long(F.col("is_cut"), "is_cut"))


SCENE_CUTS = """WITH e AS (SELECT 'l' || label AS scene_id, vec_id, CASE WHEN vec_id % 29 <> 0 THEN embedding END AS vec FROM embeddings), p AS (
  SELECT *, last_value(vec IGNORE NULLS) OVER (PARTITION BY scene_id ORDER BY vec_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pv FROM e), d AS (
  SELECT scene_id, vec_id, CASE WHEN vec IS NOT NULL AND pv IS NOT NULL
    THEN list_sum(list_transform(range(1, len(vec) + 1), lambda i: CAST(abs(vec[i] - pv[i]) AS DOUBLE))) / len(vec) END AS diff FROM p)
SELECT scene_id, vec_id, round(diff, 6) AS visual_diff, CAST(coalesce(diff >= 0.145, false) AS BIGINT) AS is_cut FROM d"""


def _timed(spark, sf_dir) -> DataFrame:
    e = v.events(spark, sf_dir)
    ms = F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1000.0)
    return e.withColumn("timestamp_ms", F.when(F.col("event_id") % 31 != 0, ms))


def _gaps(spark, sf_dir) -> DataFrame:
    e = _timed(spark, sf_dir)
    return seg.timestamp_gaps(e, seg.gap_limits(e))


def timestamp_gaps(spark, sf_dir) -> DataFrame:
    return _gaps(spark, sf_dir).select("scene_id", "frame_id", F.round("gap_ms", 3).alias("gap_ms"), v.long(F.col("is_gap"), "is_gap"))


def gap_limits(spark, sf_dir) -> DataFrame:
    found = seg.gap_limits(_timed(spark, sf_dir))
    return found.select("scene_id", F.round("median_gap_ms", 3).alias("median_gap_ms"), F.round("gap_limit_ms", 3).alias("gap_limit_ms"))


_GAPS = f"""{v.EVENTS}, t AS (SELECT *, CASE WHEN event_id % 31 <> 0 THEN epoch_us(ts) / 1000::DOUBLE END AS ms FROM ev), b AS (
  SELECT *, last_value(ms IGNORE NULLS) OVER (PARTITION BY scene_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM t), lim AS (
  SELECT scene_id, quantile_cont(ms - pm, 0.5) AS med FROM b WHERE ms - pm > 0 GROUP BY scene_id), gp AS (
  SELECT b.*, ms - pm AS gap_ms, coalesce(ms - pm > med * 3, false) AS is_gap FROM b LEFT JOIN lim USING (scene_id))"""
TIMESTAMP_GAPS = f"WITH {_GAPS} SELECT scene_id, frame_id, round(gap_ms, 3) AS gap_ms, CAST(is_gap AS BIGINT) AS is_gap FROM gp"
GAP_LIMITS = f"WITH {_GAPS} SELECT scene_id, round(med, 3) AS median_gap_ms, round(med * 3, 3) AS gap_limit_ms FROM lim"


def _bounded(spark, sf_dir) -> DataFrame:
    g = _gaps(spark, sf_dir)
    ratio = F.when(F.col("event_id") % 37 != 0, F.least(F.col("value"), F.lit(100.0)) / 100)
    warned = F.size(seg.frame_warnings(ratio, F.col("event_id") % 43 != 0, 0.2)) > 0
    g = g.withColumns({"is_cut": (F.col("event_type") == "error") & (F.col("value") > 60), "has_warning": warned})
    return seg.boundaries(g, MAX_FRAMES)


def boundaries(spark, sf_dir) -> DataFrame:
    return _bounded(spark, sf_dir).where("is_boundary").select("scene_id", "frame_id", v.joined("boundary_reasons"))


def segments(spark, sf_dir) -> DataFrame:
    s = seg.segments(_bounded(spark, sf_dir))
    return s.select("scene_id", "segment_id", "start_index", "end_index", "start_id", "end_id", "frame_count", "boundary_reasons", "warned_frames")


_SEGMENTS = f"""{_GAPS}, hd AS (
  SELECT *, event_type = 'error' AND value > 60 AS is_cut, event_id % 37 = 0 OR least(value, 100) / 100 < 0.2 OR event_id % 43 = 0 AS warned FROM gp), hh AS (
  SELECT *, max(CASE WHEN idx = 0 OR is_cut OR is_gap THEN idx END) OVER (PARTITION BY scene_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS h FROM hd), bd AS (
  SELECT *, concat_ws('|', CASE WHEN idx = 0 THEN 'sequence_start' END, CASE WHEN is_cut THEN 'visual_scene_cut' END, CASE WHEN is_gap THEN 'timestamp_gap' END,
    CASE WHEN idx > 0 AND (idx - h) % {MAX_FRAMES} = 0 THEN 'max_segment_length' END) AS why FROM hh), sn AS (
  SELECT *, sum(CASE WHEN why <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY scene_id ORDER BY idx) - 1 AS seg FROM bd), sg AS (
  SELECT scene_id, CAST(seg AS BIGINT) AS segment_id, min(idx) AS start_index, max(idx) AS end_index, min(frame_id) AS start_id, max(frame_id) AS end_id,
         count(*) AS frame_count, max(CASE WHEN why <> '' THEN why END) AS boundary_reasons, count(*) FILTER (warned) AS warned_frames FROM sn GROUP BY scene_id, seg)"""
BOUNDARIES = f"WITH {_SEGMENTS} SELECT scene_id, frame_id, why AS boundary_reasons FROM bd WHERE why <> ''"
SEGMENTS = f"WITH {_SEGMENTS} SELECT * FROM sg"


def _positioned(spark, sf_dir) -> DataFrame:
    return v.events(spark, sf_dir).select("scene_id", "frame_id", F.col("idx").alias("position"), "event_id", "event_type")


def segment_of_frame(spark, sf_dir) -> DataFrame:
    """Segments listed backwards and with overlaps; the first listed one wins."""
    e = _positioned(spark, sf_dir)
    starts = e.groupBy("scene_id", F.floor(F.col("position") / 8).alias("_run")).agg(F.min("position").alias("p"))
    listed = starts.select(
        "scene_id",
        F.concat(F.lit("g"), F.col("p").cast("string")).alias("segment_id"),
        (-F.col("p")).alias("list_pos"),
        (F.col("p") + 9).alias("start_pos"),
        F.col("p").alias("end_pos"),
    )
    return seg.segment_of_frame(e, listed).select("scene_id", "frame_id", "segment_id")


SEGMENT_OF_FRAME = f"""WITH {v.EVENTS}, ls AS (SELECT scene_id, idx AS p FROM ev WHERE idx % 8 = 0)
SELECT ev.scene_id, frame_id, 'g' || max(p) AS segment_id FROM ev JOIN ls ON ls.scene_id = ev.scene_id AND ev.idx BETWEEN p AND p + 9 GROUP BY ALL"""


def usable_segments(spark, sf_dir) -> DataFrame:
    """Listed segments of a scene: swapped ends, unknown ends, scenes without any."""
    e = stored(v.events(spark, sf_dir))
    odd = F.col("event_id") % 2 == 1
    other = F.lpad((F.col("idx") + 5).cast("string"), 6, "0")
    listed = e.where("event_type <> 'view' and value > 20").select(
        "scene_id",
        F.col("idx").cast("string").alias("segment_id"),
        F.col("idx").alias("list_pos"),
        F.when(odd, other).otherwise(F.col("frame_id")).alias("start_id"),
        F.when(odd, F.col("frame_id")).otherwise(other).alias("end_id"),
    )
    return seg.usable_segments(listed, e).select("scene_id", "segment_id", "start_id", "end_id", "start_pos", "end_pos")


USABLE_SEGMENTS = f"""WITH {v.EVENTS}, mx AS (SELECT scene_id, max(idx) AS last FROM ev GROUP BY 1), ok AS (
  SELECT ev.scene_id, CAST(idx AS VARCHAR) AS segment_id, idx AS a, idx + 5 AS b FROM ev JOIN mx USING (scene_id)
  WHERE event_type <> 'view' AND value > 20 AND idx + 5 <= last), al AS (
  SELECT * FROM ok UNION ALL SELECT scene_id, '0', 0, last FROM mx WHERE scene_id NOT IN (SELECT scene_id FROM ok))
SELECT scene_id, segment_id, lpad(CAST(a AS VARCHAR), 6, '0') AS start_id, lpad(CAST(b AS VARCHAR), 6, '0') AS end_id, a AS start_pos, b AS end_pos FROM al"""


def _starts(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    e = v.events(spark, sf_dir)
    table = e.groupBy("scene_id", F.floor(F.col("idx") / MAX_FRAMES).alias("segment_id")).agg(F.min("frame_id").alias("start_id"))
    names = [("can_01", "can"), ("can_02", "can"), ("box_01", "meal_box")]
    roster = F.array(*[F.struct(F.lit(i).alias("instance_id"), F.lit(c).alias("class_name"), F.lit(f"/keys/{i}").alias("key_mask_dir")) for i, c in names])
    instances = e.select("scene_id").distinct().select("scene_id", F.inline(roster))
    drawn = e.select(
        "scene_id",
        F.element_at(F.array(*[F.lit(i) for i, _ in names]), (F.col("event_id") % 3 + 1).cast("int")).alias("instance_id"),
        "frame_id",
        F.floor("value").cast("long").alias("mask_area"),
    )
    return table, instances, drawn


def key_mask_todo(spark, sf_dir) -> DataFrame:
    return seg.key_mask_todo(*_starts(spark, sf_dir))


_TODO = f"""{v.EVENTS}, st AS (SELECT scene_id, idx // {MAX_FRAMES} AS segment_id, frame_id AS start_id FROM ev WHERE idx % {MAX_FRAMES} = 0),
ins AS (SELECT * FROM (SELECT DISTINCT scene_id FROM ev), (VALUES ('can_01', 'can', 0), ('can_02', 'can', 1), ('box_01', 'meal_box', 2)) i(instance_id, class_name, k)),
td AS (SELECT st.*, ins.instance_id, ins.class_name FROM st JOIN ins USING (scene_id)
  WHERE NOT EXISTS (SELECT 1 FROM ev WHERE ev.scene_id = st.scene_id AND ev.frame_id = st.start_id AND ev.event_id % 3 = ins.k AND floor(ev.value) > 0))"""
KEY_MASK_TODO = f"WITH {_TODO} SELECT scene_id, segment_id, start_id, instance_id, '/keys/' || instance_id || '/' || start_id || '.png' AS target FROM td"


def segment_progress(spark, sf_dir) -> DataFrame:
    table, instances, drawn = _starts(spark, sf_dir)
    done = seg.segment_progress(table, instances, seg.key_mask_todo(table, instances, drawn))
    return done.select("scene_id", "segment_id", v.long("required", "required"), v.joined("missing_key_masks"), v.long(F.col("ready"), "ready"))


SEGMENT_PROGRESS = f"""WITH {_TODO}, ms AS (SELECT scene_id, segment_id, string_agg(instance_id, '|' ORDER BY instance_id) AS missing FROM td GROUP BY ALL)
SELECT scene_id, segment_id, CAST(3 AS BIGINT) AS required, coalesce(missing, '') AS missing_key_masks, CAST(missing IS NULL AS BIGINT) AS ready
FROM st LEFT JOIN ms USING (scene_id, segment_id)"""


def segment_readiness(spark, sf_dir) -> DataFrame:
    table, instances, drawn = _starts(spark, sf_dir)
    done = seg.readiness(seg.segment_progress(table, instances, seg.key_mask_todo(table, instances, drawn)))
    return done.select("scene_id", *[v.long(c, c) for c in ("segments", "ready_segments", "missing_key_masks", "required_key_masks")])


SEGMENT_READINESS = f"""WITH {_TODO}, ms AS (SELECT scene_id, segment_id, count(*) AS n FROM td GROUP BY ALL)
SELECT scene_id, count(*) AS segments, count(*) FILTER (n IS NULL) AS ready_segments, CAST(coalesce(sum(n), 0) AS BIGINT) AS missing_key_masks,
       CAST(count(*) * 3 AS BIGINT) AS required_key_masks FROM st LEFT JOIN ms USING (scene_id, segment_id) GROUP BY scene_id"""


def missing_by_class(spark, sf_dir) -> DataFrame:
    table, instances, drawn = _starts(spark, sf_dir)
    found = seg.missing_by_class(seg.key_mask_todo(table, instances, drawn), instances)
    return found.select("scene_id", "segment_id", "class_name", v.joined("instance_ids"))


MISSING_BY_CLASS = f"""WITH {_TODO}
SELECT scene_id, segment_id, class_name, string_agg(instance_id, '|' ORDER BY instance_id) AS instance_ids FROM td GROUP BY ALL"""

_KINDS = ("yellow_can", "plastic_bottle", "eco_meal_box", "blue_trash_bin", "strange_thing", "red_paper_bag", "dry_leaf")
_DETECTORS = ("robot_objects", "trash_bins", "unified_crosscheck")


def _routed(spark, sf_dir) -> DataFrame:
    table, instances, drawn = _starts(spark, sf_dir)
    e = v.events(spark, sf_dir)
    # detections of the whole segment, so that every event takes part
    seen = e.select(
        "scene_id",
        F.floor(F.col("idx") / MAX_FRAMES).alias("segment_id"),
        "frame_id",
        F.element_at(F.array(*[F.lit(d) for d in _DETECTORS]), (F.col("event_id") % 3 + 1).cast("int")).alias("detector"),
        F.element_at(F.array(*[F.lit(k) for k in _KINDS]), (F.col("event_id") % 7 + 1).cast("int")).alias("source_class"),
        (F.col("value") / 500).alias("confidence"),
        "event_id",
        (F.col("event_id") % 100).alias("det_index"),
    )
    missing = seg.missing_by_class(seg.key_mask_todo(table, instances, drawn), instances)
    return detections.route(seen, *detections.teacher_tables(spark), missing)


def detection_routing(spark, sf_dir) -> DataFrame:
    return _routed(spark, sf_dir).select(
        "event_id", "kind", "official_class", "classification", F.array_join("candidate_instance_ids", "|").alias("candidate_instance_ids")
    )


_ROUTED = f"""{_TODO}, mc AS (SELECT scene_id, segment_id, class_name, string_agg(instance_id, '|' ORDER BY instance_id) AS ids FROM td GROUP BY ALL), dt AS (
  SELECT *, idx // {MAX_FRAMES} AS segment_id, (['robot_objects', 'trash_bins', 'unified_crosscheck'])[event_id % 3 + 1] AS det,
         ([{', '.join(repr(k) for k in _KINDS)}])[event_id % 7 + 1] AS src FROM ev), o AS (
  SELECT *, CASE src WHEN 'yellow_can' THEN 'can' WHEN 'eco_meal_box' THEN 'meal_box' WHEN 'blue_trash_bin' THEN 'blue_bin' WHEN 'red_paper_bag' THEN 'red_paper_bag' END AS off FROM dt), j AS (
  SELECT o.*, mc.ids, CASE WHEN src IN ('plastic_bottle', 'dry_leaf') THEN 'neg' WHEN off IS NULL THEN 'unmapped_source_class'
    WHEN det = 'robot_objects' AND off = 'blue_bin' OR det = 'trash_bins' AND off <> 'blue_bin' THEN 'detector_scope_mismatch'
    WHEN det = 'unified_crosscheck' THEN 'crosscheck_only' WHEN ids IS NULL THEN 'no_missing_manifest_instance' END AS why
  FROM o LEFT JOIN mc ON mc.scene_id = o.scene_id AND mc.segment_id = o.segment_id AND mc.class_name = o.off), rt AS (
  SELECT event_id, frame_id, det, CASE WHEN why = 'neg' THEN 'hard_negative' WHEN why IS NULL THEN 'proposal' ELSE 'crosscheck' END AS kind, CASE WHEN why <> 'neg' OR why IS NULL THEN off END AS official_class,
         nullif(why, 'neg') AS classification, CASE WHEN why IS NULL THEN ids END AS candidate_instance_ids FROM j)"""
DETECTION_ROUTING = f"WITH {_ROUTED} SELECT event_id, kind, official_class, classification, candidate_instance_ids FROM rt"


def detections_at_starts(spark, sf_dir) -> DataFrame:
    """Detections that fall on the first frame of a segment."""
    table, _, _ = _starts(spark, sf_dir)
    seen = v.events(spark, sf_dir).select("scene_id", "frame_id", "event_id")
    return detections.at_segment_starts(seen, table).select("event_id", "segment_id")


AT_STARTS = f"WITH {v.EVENTS} SELECT event_id, idx // {MAX_FRAMES} AS segment_id FROM ev WHERE idx % {MAX_FRAMES} = 0"


def proposal_counts(spark, sf_dir) -> DataFrame:
    return detections.kind_counts(_routed(spark, sf_dir))


def proposals(spark, sf_dir) -> DataFrame:
    found = detections.proposals(_routed(spark, sf_dir))
    return found.select("event_id", "proposal_id")


PROPOSALS = f"""WITH {_ROUTED} SELECT event_id, concat_ws('__', frame_id, official_class, det, lpad(CAST(event_id % 100 AS VARCHAR), 2, '0')) AS proposal_id FROM rt WHERE kind = 'proposal'"""


def promotion_check(spark, sf_dir) -> DataFrame:
    routed = detections.proposals(_routed(spark, sf_dir))
    _, instances, drawn = _starts(spark, sf_dir)
    requests = routed.select(
        F.col("event_id").alias("proposal_id"),
        "scene_id",
        F.element_at(F.array(*[F.lit(i) for i in ("can_01", "can_02", "box_01", "lid_01")]), (F.col("event_id") % 4 + 1).cast("int")).alias("instance_id"),
    )
    proposed = routed.select(
        F.col("event_id").alias("proposal_id"), "frame_id", "official_class", "candidate_instance_ids", (F.col("event_id") % 5).alias("mask_area")
    )
    return detections.promotion_check(requests, proposed, instances, drawn).select("proposal_id", "instance_id", "rejection")


PROMOTION = f"""WITH {_ROUTED}, rq AS (
  SELECT rt.*, ev.scene_id, (['can_01', 'can_02', 'box_01', 'lid_01'])[rt.event_id % 4 + 1] AS inst FROM rt JOIN ev USING (event_id) WHERE kind = 'proposal')
SELECT rq.event_id AS proposal_id, inst AS instance_id,
       CASE WHEN ins.class_name IS NULL THEN 'unknown_instance' WHEN ins.class_name <> official_class THEN 'class_mismatch'
            WHEN NOT list_contains(string_split(candidate_instance_ids, '|'), inst) THEN 'not_a_candidate'
            WHEN EXISTS (SELECT 1 FROM ev k WHERE k.scene_id = rq.scene_id AND k.frame_id = rq.frame_id AND k.event_id % 3 = ins.k) THEN 'key_mask_exists'
            WHEN rq.event_id % 5 = 0 THEN 'empty_candidate_mask' END AS rejection
FROM rq LEFT JOIN ins ON ins.scene_id = rq.scene_id AND ins.instance_id = inst"""


def frame_rates(spark, sf_dir) -> DataFrame:
    e = v.events(spark, sf_dir)
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)
    found = metrics.frame_rates(e, ["scene_id"], ["idx"], seconds, index_block(F.col("idx")))
    return found.select("event_id", v.r6("fps", "fps"))


FRAME_RATES = f"""WITH {v.EVENTS}, t AS (SELECT *, epoch_us(ts) / 1e6::DOUBLE AS s FROM ev), p AS (
  SELECT *, lag(s) OVER (PARTITION BY scene_id ORDER BY idx) AS ps FROM t)
SELECT event_id, CASE WHEN ps IS NOT NULL THEN round(1.0::DOUBLE / greatest(s - ps, 1e-6::DOUBLE), 6) END AS fps FROM p"""

def missing_or_absent_by_class(spark, sf_dir) -> DataFrame:
    """Missing masks of orders as segments; where an order lists none, its lines without a file count."""
    k, n = F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")
    lines = v.table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("s"), F.col("l_orderkey").cast("string")).alias("scene_id"), k.alias("segment_id"), F.concat(F.lit("i"), n).alias("instance_id"),
        F.when(F.col("l_linenumber") == 4, "").otherwise(F.concat_ws("/", F.lit(""), k, n)).alias("path"), "l_returnflag", "l_linestatus",
        F.concat(F.lit("c"), (F.col("l_linenumber") % 3).cast("string")).alias("class_name"),
    )
    missing = lines.where("l_returnflag = 'R'").select("scene_id", "segment_id", "instance_id")
    found = seg.with_absent_paths(missing, lines, lines.where("l_linestatus = 'F'"))
    instances = lines.select("scene_id", "instance_id", "class_name").distinct()
    return seg.missing_by_class(found, instances).select("segment_id", "class_name", F.array_join("instance_ids", "|").alias("instances"))


MISSING_OR_ABSENT = """WITH li AS (SELECT CAST(l_orderkey AS VARCHAR) AS segment_id, 'i' || l_linenumber AS instance_id, 'c' || l_linenumber % 3 AS class_name,
    l_returnflag = 'R' AS missing, l_linenumber <> 4 AND NOT EXISTS (SELECT 1 FROM lineitem f WHERE f.l_orderkey = l.l_orderkey AND f.l_linenumber = l.l_linenumber AND f.l_linestatus = 'F') AS absent FROM lineitem l),
  listed AS (SELECT DISTINCT segment_id FROM li WHERE missing),
  m AS (SELECT DISTINCT segment_id, class_name, instance_id FROM li WHERE missing OR (absent AND segment_id NOT IN (SELECT segment_id FROM listed)))
SELECT segment_id, class_name, string_agg(instance_id, '|' ORDER BY instance_id) AS instances FROM m GROUP BY ALL"""


QUERIES = {
    "missing_or_absent_by_class": (missing_or_absent_by_class, MISSING_OR_ABSENT),
    "scene_cuts": (scene_cuts, SCENE_CUTS),
    "timestamp_gaps": (timestamp_gaps, TIMESTAMP_GAPS),
    "gap_limits": (gap_limits, GAP_LIMITS),
    "segment_boundaries": (boundaries, BOUNDARIES),
    "segments": (segments, SEGMENTS),
    "segment_of_frame": (segment_of_frame, SEGMENT_OF_FRAME),
    "usable_segments": (usable_segments, USABLE_SEGMENTS),
    "key_mask_todo": (key_mask_todo, KEY_MASK_TODO),
    "segment_progress": (segment_progress, SEGMENT_PROGRESS),
    "segment_readiness": (segment_readiness, SEGMENT_READINESS),
    "missing_by_class": (missing_by_class, MISSING_BY_CLASS),
    "detection_routing": (detection_routing, DETECTION_ROUTING),
    "detections_at_starts": (detections_at_starts, AT_STARTS),
    "proposal_counts": (proposal_counts, f"WITH {_ROUTED} SELECT kind, count(*) AS detections FROM rt GROUP BY kind"),
    "proposals": (proposals, PROPOSALS),
    "promotion_check": (promotion_check, PROMOTION),
    "frame_rates": (frame_rates, FRAME_RATES),
}
