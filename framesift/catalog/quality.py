"""Quality gate, grading chain, overrides and frame verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..constants import MASK_SEQUENCE_THRESHOLDS, OFFICIAL_CLASSES
from ..functions.geometry import box_label
from ..operators import quality as q
from ..operators import review, verdict
from ..plans.ordered import scan
from ..session import cut
from . import views as v

def _thresholds():
    own = F.when(F.col("instance_id") == "obj_1", F.create_map(F.lit("min_depth_coverage"), F.lit(0.30)))
    project = F.when(F.col("user_id") % 2 == 0, F.create_map(F.lit("min_mask_area"), F.lit(100.0)))
    return q.resolve_thresholds(own, project)


STATIC = """concat_ws('|',
    CASE WHEN mask_area < (CASE WHEN user_id % 2 = 0 THEN 100 ELSE 80 END) THEN 'mask_area_too_small' END,
    CASE WHEN area_fraction < 0.00015 THEN 'object_too_small_in_image' END,
    CASE WHEN area_fraction > 0.65 THEN 'object_too_large_in_image' END,
    CASE WHEN depth_coverage < (CASE WHEN instance_id = 'obj_1' THEN 0.30 ELSE 0.25 END) THEN 'depth_coverage_too_low' END,
    CASE WHEN dominant < 0.70 THEN 'mask_fragmented' END)"""
REVIEW_STATIC = """CASE WHEN touches_border THEN 'touches_image_border' END,
    CASE WHEN depth_coverage < 0.60 THEN 'depth_coverage_marginal' END"""


def quality_gate(spark, sf_dir) -> DataFrame:
    m = v.measurements(spark, sf_dir)
    graded = q.classify(m, _thresholds(), F.lit(False))
    return graded.select("event_id", "status", v.joined("reject_reasons"), v.joined("review_reasons"))


QUALITY_GATE = f"""WITH {v.MEASUREMENTS}, g AS (SELECT *, {STATIC} AS rej FROM m)
SELECT event_id, rej AS reject_reasons,
       CASE WHEN rej <> '' THEN '' ELSE concat_ws('|', {REVIEW_STATIC}) END AS review_reasons,
       CASE WHEN rej <> '' THEN 'rejected' WHEN touches_border OR depth_coverage < 0.60 THEN 'review' ELSE 'accepted' END AS status
FROM g"""


def graded(spark, sf_dir, m: DataFrame | None = None) -> DataFrame:
    return q.grade_sequence(v.measurements(spark, sf_dir) if m is None else m, _thresholds())


def quality_fold(spark, sf_dir) -> DataFrame:
    return graded(spark, sf_dir).select(
        "event_id",
        "status",
        v.joined("reject_reasons"),
        v.joined("review_reasons"),
        v.r6("area_ratio", "area_ratio"),
        v.r6("center_shift_norm", "center_shift_norm"),
    )


# reference frame of every frame by recursion over the frame number, then the verdict
GRADED_CTE = f"""{v.MEASUREMENTS}, g AS (
  SELECT *, {STATIC} AS rej, (has_mask AND {STATIC} = '') AS usable FROM m),
r AS (
  SELECT scene_id, instance_id, CAST(0 AS BIGINT) AS n, CAST(NULL AS DOUBLE) AS ra, CAST(NULL AS DOUBLE) AS rx, CAST(NULL AS DOUBLE) AS ry
  FROM g WHERE frame_index = 0
  UNION ALL
  SELECT r.scene_id, r.instance_id, r.n + 1,
         CASE WHEN k THEN mask_area ELSE ra END, CASE WHEN k THEN cx ELSE rx END, CASE WHEN k THEN cy ELSE ry END
  FROM (SELECT r.*, g.mask_area, g.cx, g.cy,
               g.usable AND (r.n = 0 OR ra IS NULL OR NOT (mask_area > 0 AND (mask_area / ra < 0.35 OR mask_area / ra > 2.8
                 OR sqrt((cx - rx) * (cx - rx) + (cy - ry) * (cy - ry)) / 800 > 0.40))) AS k
        FROM r JOIN g ON g.scene_id = r.scene_id AND g.instance_id = r.instance_id AND g.frame_index = r.n) r),
w AS (
  SELECT g.*, CASE WHEN ra > 0 AND mask_area > 0 THEN mask_area / ra END AS area_ratio,
         CASE WHEN ra > 0 AND mask_area > 0 THEN sqrt((cx - rx) * (cx - rx) + (cy - ry) * (cy - ry)) / 800 END AS shift
  FROM g JOIN r ON g.scene_id = r.scene_id AND g.instance_id = r.instance_id AND g.frame_index = r.n),
z AS (
  SELECT *, CASE WHEN NOT has_mask THEN 'mask_file_missing' ELSE concat_ws('|', nullif(rej, ''),
      CASE WHEN frame_index > 0 AND (area_ratio < 0.35 OR area_ratio > 2.8) THEN 'mask_area_jump' END,
      CASE WHEN frame_index > 0 AND shift > 0.40 THEN 'mask_center_jump' END) END AS reject_reasons FROM w),
gr AS (
  SELECT *, CASE WHEN reject_reasons <> '' THEN '' ELSE concat_ws('|', {REVIEW_STATIC},
      CASE WHEN frame_index > 0 AND shift > 0.22 THEN 'large_center_motion' END) END AS review_reasons FROM z),
graded AS (
  SELECT *, CASE WHEN reject_reasons <> '' THEN 'rejected' WHEN review_reasons <> '' THEN 'review' ELSE 'accepted' END AS status FROM gr)"""
QUALITY_FOLD = f"""WITH RECURSIVE {GRADED_CTE}
SELECT event_id, status, reject_reasons, review_reasons, round(area_ratio, 6) AS area_ratio, round(shift, 6) AS center_shift_norm
FROM graded"""


POSE_LIMITS = {**MASK_SEQUENCE_THRESHOLDS, "max_translation_jump_m": 0.22, "max_rotation_jump_deg": 55.0}


def _pose_chain(spark, sf_dir, reset: bool, block_rows: int) -> DataFrame:
    """Poses along one sequence per event type: steps of 5 cm, turns of 20 degrees, every 13th frame without a mask."""
    raw = v.table(spark, sf_dir, "events").withColumnRenamed("event_type", "scene_id")
    placed = scan(raw, ["scene_id"], ["ts", "event_id"], index="frame_index")
    angle = F.radians((F.col("event_id") % 5 * 20).cast("double"))
    step = F.floor("value") % 7 * F.lit(0.05)
    zero, one = F.lit(0.0), F.lit(1.0)
    pose = F.array(F.cos(angle), -F.sin(angle), zero, step, F.sin(angle), F.cos(angle), zero, zero, zero, zero, one, zero, zero, zero, zero, one)
    frames = placed.select(
        "event_id", "scene_id", F.lit("p").alias("instance_id"), "frame_index", F.lit(1000).cast("long").alias("mask_area"), F.lit(50.0).alias("cx"), F.lit(50.0).alias("cy"),
        F.lit(640).alias("width"), F.lit(480).alias("height"), (F.col("event_id") % 397 == 0 if reset else F.lit(False)).alias("registration"),
        (F.col("event_id") % 13 != 0).alias("has_mask"), pose.alias("pose"),
    )
    graded = q.grade_sequence(frames, q.resolve_thresholds(defaults=POSE_LIMITS), reset_at_registration=reset, block_rows=block_rows)
    return graded.select(
        "event_id", "status", v.joined("reject_reasons"), v.joined("review_reasons"),
        F.round("translation_jump_m", 4).alias("translation_jump_m"), F.round("rotation_jump_deg", 3).alias("rotation_jump_deg"),
    )


def pose_fold(spark, sf_dir) -> DataFrame:
    """Jumps against the last good pose, forgotten at every registration."""
    return _pose_chain(spark, sf_dir, True, 64)


def pose_fold_long(spark, sf_dir) -> DataFrame:
    """The same without registrations: few sequences over many blocks."""
    return _pose_chain(spark, sf_dir, False, 256)


def _pose_sql(registration: str) -> str:
    return f"""WITH RECURSIVE po AS (
  SELECT event_id, event_type AS s, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS n, CAST(floor(value) AS BIGINT) % 7 * 0.05::DOUBLE AS tx,
         event_id % 5 * 20::DOUBLE AS ang, event_id % 13 <> 0 AS has, {registration} AS reg FROM events),
r AS (
  SELECT s, CAST(0 AS BIGINT) AS n, CAST(NULL AS DOUBLE) AS rt, CAST(NULL AS DOUBLE) AS ra FROM po WHERE n = 0 UNION ALL
  SELECT s, n + 1, CASE WHEN k THEN tx WHEN reg THEN NULL ELSE rt END, CASE WHEN k THEN ang WHEN reg THEN NULL ELSE ra END
  FROM (SELECT r.*, po.tx, po.ang, po.reg, po.has AND (po.reg OR rt IS NULL OR (abs(tx - rt) <= 0.22 AND abs(ang - ra) <= 55)) AS k FROM r JOIN po ON po.s = r.s AND po.n = r.n)),
w AS (
  SELECT event_id, has, reg, abs(tx - CASE WHEN NOT reg THEN rt END) AS t, abs(ang - CASE WHEN NOT reg THEN ra END) AS a FROM po JOIN r USING (s, n)),
z AS (
  SELECT *, CASE WHEN NOT has THEN 'mask_file_missing' ELSE concat_ws('|', CASE WHEN t > 0.22 THEN 'translation_jump' END, CASE WHEN a > 55 THEN 'rotation_jump' END) END AS bad FROM w),
y AS (
  SELECT *, CASE WHEN bad <> '' THEN '' ELSE concat_ws('|', CASE WHEN t > 0.12 THEN 'large_translation_motion' END, CASE WHEN a > 35 THEN 'large_rotation_motion' END) END AS soft FROM z)
SELECT event_id, CASE WHEN bad <> '' THEN 'rejected' WHEN soft <> '' THEN 'review' ELSE 'accepted' END AS status, bad AS reject_reasons, soft AS review_reasons,
       round(t, 4) AS translation_jump_m, round(a, 3) AS rotation_jump_deg FROM y"""


def reject_streaks(spark, sf_dir) -> DataFrame:
    e = v.events(spark, sf_dir).withColumn("status", F.when(F.col("value") < 45, "rejected").otherwise("accepted"))
    hits = q.reject_streaks(e, 3, keys=["scene_id"], index="idx")
    return hits.select("scene_id", "frame_id", "streak")


REJECT_STREAKS = f"""WITH {v.EVENTS}, s AS (
  SELECT *, value < 45 AS rej, sum(CASE WHEN value < 45 THEN 0 ELSE 1 END) OVER (PARTITION BY scene_id ORDER BY idx) AS island FROM ev)
SELECT scene_id, frame_id, CAST(3 AS BIGINT) AS streak FROM (
  SELECT *, sum(CASE WHEN rej THEN 1 ELSE 0 END) OVER (PARTITION BY scene_id, island ORDER BY idx) AS n FROM s)
WHERE rej AND n = 3"""


def tracking_segments(spark, sf_dir) -> DataFrame:
    e = v.events(spark, sf_dir)
    e = e.withColumn("registration", (F.col("idx") == 0) | (F.col("event_type") == "signup"))
    e = q.tracking_segments(e, keys=["scene_id"], index="idx")
    e = e.withColumn("is_key", F.col("registration")).withColumn("status", F.when(F.col("value") >= 5, "accepted").otherwise("rejected"))
    keyed = q.key_frame_distance(e, 5, keys=["scene_id"], index="idx")
    return keyed.select(
        "event_id", v.long("tracking_segment", "tracking_segment"), "since_key", v.long(F.col("refresh_due"), "refresh_due")
    )


TRACKING = f"""WITH {v.EVENTS}, k AS (
  SELECT *, idx = 0 OR event_type = 'signup' AS key FROM ev), s AS (
  SELECT *, sum(CASE WHEN key AND idx > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY scene_id ORDER BY idx) AS seg,
         max(CASE WHEN key THEN idx END) OVER (PARTITION BY scene_id ORDER BY idx) AS last_key FROM k)
SELECT event_id, CAST(seg AS BIGINT) AS tracking_segment, CAST(idx - last_key AS BIGINT) AS since_key,
       CAST(value >= 5 AND NOT key AND (idx - last_key) % 5 = 0 AS BIGINT) AS refresh_due
FROM s"""


def _overrides(spark, sf_dir, m: DataFrame | None = None) -> DataFrame:
    """Override log: most rows carry no known status and are ignored on reading."""
    m = v.measurements(spark, sf_dir) if m is None else m
    kinds = F.array(*[F.lit(s) for s in ("accepted", "review", "rejected", "", "skip", "open", "", "", "", "", "")])
    return m.select(
        "scene_id",
        "instance_id",
        "frame_id",
        F.element_at(kinds, (F.col("event_id") % 11 + 1).cast("int")).alias("status"),
        F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("note_"), F.col("event_id").cast("string"))).alias("reason"),
        F.lit("2024-01-01").alias("updated_at"),
    )


def _with_line(df: DataFrame) -> DataFrame:
    """Box label of every frame whose mask is large enough."""
    size = F.col("event_id") % 40
    line = box_label(
        (F.col("ord")).cast("int"), F.col("cx") - size, F.col("cy") - size, F.col("cx") + size + 1, F.col("cy") + size + 1,
        F.col("width"), F.col("height"),
    )
    ok = F.col("has_mask") & (F.col("mask_area") >= F.when(F.col("user_id") % 2 == 0, 100).otherwise(80))
    return df.withColumn("line", F.when(ok, line))


def reviewed(spark, sf_dir, m: DataFrame | None = None) -> DataFrame:
    m = cut(v.measurements(spark, sf_dir)) if m is None else m  # graded, and read for the overrides
    return review.apply_overrides(_with_line(graded(spark, sf_dir, m)), review.latest_overrides(_overrides(spark, sf_dir, m)))


def manual_override(spark, sf_dir) -> DataFrame:
    return reviewed(spark, sf_dir).select(
        "event_id", "status", "auto_status", "manual_status", "manual_reason", v.joined("reject_reasons"), v.joined("review_reasons")
    )


_OVERRIDDEN = f"""{GRADED_CTE}, ov AS (
  SELECT *, CASE event_id % 11 WHEN 0 THEN 'accepted' WHEN 1 THEN 'review' WHEN 2 THEN 'rejected' END AS manual_status,
         CASE WHEN event_id % 2 = 0 THEN 'note_' || event_id END AS note,
         has_mask AND mask_area >= (CASE WHEN user_id % 2 = 0 THEN 100 ELSE 80 END) AS has_line FROM graded), fin AS (
  SELECT * EXCLUDE (status, reject_reasons, review_reasons), status AS auto_status,
         CASE WHEN manual_status IS NOT NULL THEN coalesce(note, 'manual_' || manual_status) END AS manual_reason,
         CASE WHEN manual_status IS NULL THEN status WHEN manual_status = 'accepted' AND NOT has_line THEN 'rejected' ELSE manual_status END AS status,
         CASE WHEN manual_status IS NULL THEN reject_reasons
              WHEN manual_status = 'accepted' AND NOT has_line THEN 'manual_accept_blocked_invalid_mask'
              WHEN manual_status = 'rejected' THEN coalesce(note, 'manual_rejected') ELSE '' END AS reject_reasons,
         CASE WHEN manual_status IS NULL THEN review_reasons
              WHEN manual_status = 'review' THEN coalesce(note, 'manual_review') ELSE '' END AS review_reasons
  FROM ov)"""
MANUAL_OVERRIDE = f"""WITH RECURSIVE {_OVERRIDDEN}
SELECT event_id, status, auto_status, manual_status, manual_reason, reject_reasons, review_reasons FROM fin"""


def effective_status(spark, sf_dir) -> DataFrame:
    m = cut(v.measurements(spark, sf_dir))
    g = graded(spark, sf_dir, m).withColumn("auto_status", F.when(F.col("event_id") % 3 == 0, F.lit("")).otherwise(F.col("status")))
    done = review.effective_status(g, review.latest_overrides(_overrides(spark, sf_dir, m)))
    return done.select("event_id", "effective_status", "reason_text")


EFFECTIVE = f"""WITH RECURSIVE {GRADED_CTE}, ov AS (
  SELECT *, CASE event_id % 11 WHEN 0 THEN 'accepted' WHEN 1 THEN 'review' WHEN 2 THEN 'rejected' END AS manual_status,
         CASE WHEN event_id % 2 = 0 THEN 'note_' || event_id END AS note FROM graded)
SELECT event_id, coalesce(manual_status, status) AS effective_status,
       CASE WHEN manual_status IS NOT NULL THEN coalesce(note, 'manual_' || manual_status)
            ELSE coalesce(nullif(replace(concat_ws('|', nullif(reject_reasons, ''), nullif(review_reasons, '')), '|', ', '), ''), '-') END AS reason_text
FROM ov"""


def eligible_labels(spark, sf_dir) -> DataFrame:
    rows = review.eligible(reviewed(spark, sf_dir), F.col("user_id") % 3 == 0)
    return rows.select("event_id", "line")


ELIGIBLE = f"""WITH RECURSIVE {_OVERRIDDEN}
SELECT event_id, printf('%d %.6f %.6f %.6f %.6f', ord, ((cx - event_id % 40) + (cx + event_id % 40 + 1)) * 0.5 / 640,
    ((cy - event_id % 40) + (cy + event_id % 40 + 1)) * 0.5 / 480, CAST(2 * (event_id % 40) + 1 AS DOUBLE) / 640, CAST(2 * (event_id % 40) + 1 AS DOUBLE) / 480) AS line
FROM fin WHERE has_line AND (status = 'accepted' OR (status = 'review' AND user_id % 3 = 0))"""


def _items(spark, sf_dir, m: DataFrame) -> DataFrame:
    rows = reviewed(spark, sf_dir, m).where("recorded")
    # read several times below; written once instead of graded again
    return cut(rows.select(
        "scene_id",
        F.concat_ws("_", "scene_id", "frame_id").alias("output_id"),
        "frame_id",
        "instance_id",
        "ord",
        "status",
        F.col("line").isNotNull().alias("has_label"),
        F.coalesce("line", F.lit("")).alias("label"),
        "has_mask",
        "cx",
        "cy",
        "event_id",
    ))


def _expected(m: DataFrame) -> DataFrame:
    frames = m.select("scene_id", "frame_id", F.concat_ws("_", "scene_id", "frame_id").alias("output_id")).distinct()
    roster = frames.select("scene_id").distinct().select(
        "scene_id",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(f"obj_{i}").alias("instance_id"), F.lit(i).alias("ord"), F.lit(start).alias("start"), F.lit(limit).alias("max_frames"))
                    for i, start, limit in ((0, 0, 0), (1, 2, 0), (2, 0, 10))
                ]
            )
        ),
    )
    return verdict.expected_instances(frames, roster)


def _box_overlaps(items: DataFrame) -> DataFrame:
    """Overlap of the label boxes of a frame (squares around the mask centre)."""
    s = F.col("event_id") % 40
    boxes = items.select("scene_id", "output_id", "instance_id", "ord", (F.col("cx") - s).alias("x1"), (F.col("cy") - s).alias("y1"), (2 * s + 1).alias("w"))
    a = boxes.select("scene_id", "output_id", *[F.col(c).alias(f"a_{c}") for c in ("instance_id", "ord", "x1", "y1", "w")])
    b = boxes.select("scene_id", "output_id", *[F.col(c).alias(f"b_{c}") for c in ("instance_id", "ord", "x1", "y1", "w")])

    def common(axis: str):
        low = F.greatest(f"a_{axis}1", f"b_{axis}1")
        return F.greatest(F.least(F.col(f"a_{axis}1") + F.col("a_w"), F.col(f"b_{axis}1") + F.col("b_w")) - low, F.lit(0.0))

    smaller = F.least(F.col("a_w") * F.col("a_w"), F.col("b_w") * F.col("b_w"))
    pairs = a.join(b, ["scene_id", "output_id"]).where("a_ord < b_ord")
    return pairs.select(
        "scene_id", "output_id", F.col("a_instance_id").alias("a"), F.col("b_instance_id").alias("b"), (common("x") * common("y") / smaller).alias("overlap")
    )


def _verdicts(spark, sf_dir) -> DataFrame:
    m = cut(v.measurements(spark, sf_dir))
    items = _items(spark, sf_dir, m)
    images = m.where("event_type <> 'signup'").select("scene_id", "frame_id")
    return verdict.frame_verdicts(_expected(m), items, _box_overlaps(items), max_overlap=0.05, images=images)


def frame_verdict(spark, sf_dir) -> DataFrame:
    return _verdicts(spark, sf_dir).select(
        "output_id", "source_frame", v.joined("reasons"), "status", "instance_count", v.long("n_expected", "n_expected"), v.long("n_observed", "n_observed")
    )


_VERDICT = f"""{_OVERRIDDEN}, fr AS (SELECT DISTINCT scene_id, frame_id, frame_index FROM m),
ex AS (
  SELECT f.scene_id, f.frame_id, i.instance_id FROM fr f, (VALUES ('obj_0', 0, 0), ('obj_1', 2, 0), ('obj_2', 0, 10)) i(instance_id, s, lim)
  WHERE f.frame_index >= s AND (lim = 0 OR f.frame_index < s + lim)),
it AS (SELECT *, event_id % 40 AS h, 2 * (event_id % 40) + 1 AS bw FROM fin WHERE recorded),
ids AS (SELECT DISTINCT scene_id, frame_id FROM (SELECT scene_id, frame_id FROM ex UNION ALL SELECT scene_id, frame_id FROM it)),
mis AS (
  SELECT scene_id, frame_id, string_agg(instance_id || ':record_missing', '|' ORDER BY instance_id) AS t
  FROM ex WHERE NOT EXISTS (SELECT 1 FROM it WHERE it.scene_id = ex.scene_id AND it.frame_id = ex.frame_id AND it.instance_id = ex.instance_id)
  GROUP BY ALL),
ob AS (
  SELECT scene_id, frame_id, count(*) AS cnt, bool_or(has_line) AS any_line,
         string_agg(CASE WHEN status <> 'accepted' OR NOT has_line THEN instance_id || ':' || status END, '|' ORDER BY ord) AS st,
         string_agg(CASE WHEN NOT has_mask THEN instance_id || ':mask_missing' END, '|' ORDER BY ord) AS mm FROM it GROUP BY ALL),
cf AS (
  SELECT a.scene_id, a.frame_id FROM it a JOIN it b ON a.scene_id = b.scene_id AND a.frame_id = b.frame_id AND a.ord < b.ord
  WHERE greatest(least(a.cx - a.h + a.bw, b.cx - b.h + b.bw) - greatest(a.cx - a.h, b.cx - b.h), 0)
      * greatest(least(a.cy - a.h + a.bw, b.cy - b.h + b.bw) - greatest(a.cy - a.h, b.cy - b.h), 0) / least(a.bw * a.bw, b.bw * b.bw) > 0.05
  GROUP BY ALL),
im AS (SELECT DISTINCT scene_id, frame_id FROM m WHERE event_type <> 'signup'),
ne AS (SELECT scene_id, frame_id, count(*) AS n FROM ex GROUP BY ALL),
vd AS (
  SELECT i.scene_id, i.frame_id, coalesce(ne.n, 0) AS n_expected, coalesce(ob.cnt, 0) AS n_observed, coalesce(any_line, false) AS any_line,
         concat_ws('|', mis.t, ob.st, ob.mm, CASE WHEN cf.scene_id IS NOT NULL THEN 'instance_mask_overlap' END,
           CASE WHEN im.scene_id IS NULL THEN 'source_image_missing' END) AS reasons
  FROM ids i LEFT JOIN mis USING (scene_id, frame_id) LEFT JOIN ob USING (scene_id, frame_id) LEFT JOIN cf USING (scene_id, frame_id)
  LEFT JOIN im USING (scene_id, frame_id) LEFT JOIN ne USING (scene_id, frame_id)),
ver AS (SELECT *, CASE WHEN reasons = '' AND any_line THEN 'accepted' WHEN any_line THEN 'review' ELSE 'rejected' END AS status FROM vd)"""
FRAME_VERDICT = f"""WITH RECURSIVE {_VERDICT}
SELECT scene_id || '_' || frame_id AS output_id, frame_id AS source_frame, reasons, status, CAST(n_observed AS BIGINT) AS instance_count,
       CAST(n_expected AS BIGINT) AS n_expected, CAST(n_observed AS BIGINT) AS n_observed FROM ver"""


def expected_observed(spark, sf_dir) -> DataFrame:
    m = cut(v.measurements(spark, sf_dir))
    found = m.where("recorded").select("scene_id", F.concat_ws("_", "scene_id", "frame_id").alias("output_id"), "instance_id")
    both = verdict.expected_observed(_expected(m), found)
    return both.select("output_id", v.long("n_expected", "n_expected"), v.long("n_observed", "n_observed"), v.joined("missing"))


EXPECTED_OBSERVED = f"""WITH {v.MEASUREMENTS}, fr AS (SELECT DISTINCT scene_id, frame_id, frame_index FROM m),
ex AS (
  SELECT f.scene_id, f.frame_id, i.instance_id FROM fr f, (VALUES ('obj_0', 0, 0), ('obj_1', 2, 0), ('obj_2', 0, 10)) i(instance_id, s, lim)
  WHERE f.frame_index >= s AND (lim = 0 OR f.frame_index < s + lim)),
ob AS (SELECT scene_id, frame_id, instance_id FROM m WHERE recorded),
j AS (SELECT coalesce(ex.scene_id, ob.scene_id) AS s, coalesce(ex.frame_id, ob.frame_id) AS f, ex.instance_id AS e, ob.instance_id AS o
      FROM ex FULL JOIN ob ON ex.scene_id = ob.scene_id AND ex.frame_id = ob.frame_id AND ex.instance_id = ob.instance_id)
SELECT s || '_' || f AS output_id, count(e) AS n_expected, count(o) AS n_observed,
       coalesce(string_agg(CASE WHEN o IS NULL THEN e END, '|' ORDER BY e), '') AS missing FROM j GROUP BY s, f"""


def project_report(spark, sf_dir) -> DataFrame:
    return verdict.project_summary(_verdicts(spark, sf_dir))


PROJECT_REPORT = f"""WITH RECURSIVE {_VERDICT}
SELECT scene_id, count(*) FILTER (status = 'accepted') AS accepted, count(*) FILTER (status = 'review') AS review,
       count(*) FILTER (status = 'rejected') AS rejected FROM ver GROUP BY scene_id"""


def status_counts(spark, sf_dir) -> DataFrame:
    return q.status_counts(graded(spark, sf_dir), ["scene_id", "instance_id"])


STATUS_COUNTS = f"""WITH RECURSIVE {GRADED_CTE}
SELECT scene_id, instance_id, count(*) FILTER (status = 'accepted') AS accepted, count(*) FILTER (status = 'review') AS review,
       count(*) FILTER (status = 'rejected') AS rejected FROM graded GROUP BY ALL"""

_NAMES = [OFFICIAL_CLASSES[i] for i in range(9)]


def class_split_rollup(spark, sf_dir) -> DataFrame:
    """Accepted frames per class and split (class by scene, split by source)."""
    user = F.substring("scene_id", 2, 20).cast("long")
    classes = F.array(*[F.lit(n) for n in _NAMES])
    accepted = _verdicts(spark, sf_dir).where("status = 'accepted'").select(
        F.when(user % 5 == 0, "val").otherwise("train").alias("split"), F.element_at(classes, (user % 9 + 1).cast("int")).alias("class_name")
    )
    return verdict.class_split_table(accepted, _NAMES)


CLASS_SPLIT_ROLLUP = f"""WITH RECURSIVE {_VERDICT}, a AS (
  SELECT CASE WHEN CAST(substr(scene_id, 2) AS BIGINT) % 5 = 0 THEN 'val' ELSE 'train' END AS split,
         ([{', '.join(repr(n) for n in _NAMES)}])[CAST(substr(scene_id, 2) AS BIGINT) % 9 + 1] AS class_name FROM ver WHERE status = 'accepted')
SELECT coalesce(split, 'total') AS split, {', '.join(f"count(*) FILTER (class_name = '{n}') AS {n}" for n in _NAMES)}, count(*) AS total
FROM a GROUP BY ROLLUP (split)"""


def quick_gate(spark, sf_dir) -> DataFrame:
    m = v.measurements(spark, sf_dir).withColumn("area_ratio", F.when(F.col("event_id") % 6 > 0, F.col("mask_area") / (F.col("event_id") % 6 * 200)))
    gated = q.quick_gate(m)
    return gated.select("event_id", v.joined("reasons"), v.long(F.col("good"), "good"))


QUICK_GATE = f"""WITH {v.MEASUREMENTS}, a AS (SELECT *, CASE WHEN event_id % 6 > 0 THEN mask_area / (event_id % 6 * 200) END AS ratio FROM m), g AS (
  SELECT event_id, concat_ws('|', CASE WHEN mask_area < 80 THEN 'mask_area_too_small' END,
    CASE WHEN ratio < 0.35 OR ratio > 2.8 THEN 'mask_area_jump' END, CASE WHEN depth_coverage < 0.25 THEN 'depth_coverage_too_low' END) AS reasons FROM a)
SELECT event_id, reasons, CAST(reasons = '' AS BIGINT) AS good FROM g"""


def recovery(spark, sf_dir) -> DataFrame:
    m = q.quick_gate(v.measurements(spark, sf_dir).withColumn("area_ratio", F.lit(None).cast("double")))
    e = F.col("event_id")
    rows = m.select(
        "event_id",
        "scene_id",
        "reasons",
        "good",
        (e % 9 == 0).alias("is_key"),
        (F.col("frame_index") > 0).alias("has_last_good"),
        (e % 2).alias("failures_before"),
        F.when(e % 5 == 0, "recovery_seed_empty").alias("seed_reason"),
        (e % 100).alias("seed_area"),
        (e % 3 > 0).alias("recovered_good"),
        F.when(e % 3 == 0, F.array(F.lit("mask_area_jump"))).otherwise(F.array().cast("array<string>")).alias("recovered_reasons"),
        (e % 10 / 10).alias("seed_iou"),
    )
    done = q.recovery_decision(rows, after_failures=2)
    return done.select(
        "event_id", v.long(F.col("attempted"), "attempted"), v.long(F.col("succeeded"), "succeeded"), "final_status", v.joined("final_reasons")
    )


RECOVERY = f"""WITH {v.MEASUREMENTS}, g AS (
  SELECT *, concat_ws('|', CASE WHEN mask_area < 80 THEN 'mask_area_too_small' END, CASE WHEN depth_coverage < 0.25 THEN 'depth_coverage_too_low' END) AS why FROM m), a AS (
  SELECT *, why <> '' AND event_id % 9 <> 0 AND frame_index > 0 AND event_id % 2 + 1 >= 2 AS att FROM g), s AS (
  SELECT *, att AND event_id % 5 <> 0 AND event_id % 100 > 0 AND event_id % 3 > 0 AND event_id % 10 / 10 >= 0.35 AS ok FROM a)
SELECT event_id, CAST(att AS BIGINT) AS attempted, CAST(ok AS BIGINT) AS succeeded, CASE WHEN why = '' OR ok THEN 'accepted' ELSE 'rejected' END AS final_status,
       CASE WHEN ok THEN '' WHEN att THEN concat_ws('|', why, CASE WHEN event_id % 5 = 0 THEN 'recovery_seed_empty' END, 'auto_reregister_failed') ELSE why END AS final_reasons
FROM s"""


QUERIES = {
    "quality_gate": (quality_gate, QUALITY_GATE),
    "quality_fold": (quality_fold, QUALITY_FOLD),
    "pose_fold": (pose_fold, _pose_sql("event_id % 397 = 0")),
    "pose_fold_long": (pose_fold_long, _pose_sql("false")),
    "reject_streaks": (reject_streaks, REJECT_STREAKS),
    "tracking_segments": (tracking_segments, TRACKING),
    "manual_override": (manual_override, MANUAL_OVERRIDE),
    "effective_status": (effective_status, EFFECTIVE),
    "eligible_labels": (eligible_labels, ELIGIBLE),
    "frame_verdict": (frame_verdict, FRAME_VERDICT),
    "expected_observed": (expected_observed, EXPECTED_OBSERVED),
    "project_report": (project_report, PROJECT_REPORT),
    "status_counts": (status_counts, STATUS_COUNTS),
    "class_split_rollup": (class_split_rollup, CLASS_SPLIT_ROLLUP),
    "quick_gate": (quick_gate, QUICK_GATE),
    "recovery_decision": (recovery, RECOVERY),
}
