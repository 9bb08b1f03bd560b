"""Manual review: overrides, effective status, rerun ranges, range algebra."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..constants import STATUSES
from ..plans.blocks import index_block
from ..plans.ordered import blocked, scan

FRAME = ("scene_id", "instance_id", "frame_id")
EMPTY = "array<string>"


def latest_overrides(log: DataFrame, keys: Sequence[str] = FRAME) -> DataFrame:
    """Newest row per frame of the append-only override log; unknown statuses ignored."""
    newest = F.struct("updated_at", "status", "reason")
    return (
        log.where(F.col("status").isin(*STATUSES))
        .groupBy(*keys)
        .agg(F.max(newest).alias("o"))
        .select(*keys, F.col("o.status").alias("manual_status"), F.col("o.reason").alias("manual_note"), F.col("o.updated_at").alias("updated_at"))
    )


def apply_overrides(quality: DataFrame, overrides: DataFrame, keys: Sequence[str] = FRAME) -> DataFrame:
    """Manual status over automatic status.

    quality  ``keys, status, reject_reasons, review_reasons, line``; ``line`` is the label text or null.
    Accepting a frame without a label line is turned into a rejection.
    """
    keys = list(keys)
    manual = F.col("manual_status")
    reason = F.coalesce(F.nullif(F.col("manual_note"), F.lit("")), F.concat(F.lit("manual_"), manual))
    blocked = (manual == "accepted") & F.col("line").isNull()
    joined = quality.join(overrides.select(*keys, "manual_status", "manual_note"), keys, "left")
    none = F.array().cast(EMPTY)
    automatic = manual.isNull()
    return joined.withColumns(
        {
            "auto_status": F.col("status"),
            "manual_reason": F.when(~automatic, reason),
            "status": F.when(automatic, F.col("status")).when(blocked, "rejected").otherwise(manual),
            "reject_reasons": F.when(automatic, F.col("reject_reasons"))
            .when(blocked, F.array(F.lit("manual_accept_blocked_invalid_mask")))
            .when(manual == "rejected", F.array(reason))
            .otherwise(none),
            "review_reasons": F.when(automatic, F.col("review_reasons")).when(manual == "review", F.array(reason)).otherwise(none),
        }
    ).drop("manual_note")


def effective_status(quality: DataFrame, overrides: DataFrame, keys: Sequence[str] = FRAME) -> DataFrame:
    """Manual, else automatic, else final, else rejected; with the reason text."""
    keys = list(keys)
    joined = quality.join(overrides.select(*keys, "manual_status", "manual_note"), keys, "left")
    manual = F.col("manual_status")
    automatic = F.coalesce(
        F.nullif(F.col("auto_status"), F.lit("")), F.nullif(F.col("status"), F.lit("")), F.lit("rejected")
    )
    none = F.array().cast(EMPTY)
    reasons = F.array_join(F.concat(F.coalesce("reject_reasons", none), F.coalesce("review_reasons", none)), ", ")
    note = F.coalesce(F.nullif(F.col("manual_note"), F.lit("")), F.concat(F.lit("manual_"), manual))
    return joined.withColumns(
        {
            "effective_status": F.coalesce(manual, automatic),
            "reason_text": F.when(manual.isNotNull(), note).otherwise(
                F.coalesce(F.nullif(reasons, F.lit("")), F.lit("-"))
            ),
        }
    ).drop("manual_note")


def eligible(df: DataFrame, include_review) -> DataFrame:
    """Rows that become labels: a line, and accepted (or review when allowed)."""
    allow = include_review if not isinstance(include_review, bool) else F.lit(include_review)
    ok = F.col("line").isNotNull() & ((F.col("status") == "accepted") | (allow & (F.col("status") == "review")))
    return df.where(ok)


def rerun_ranges(frames: DataFrame, requests: DataFrame, keys: Sequence[str] = ("scene_id", "instance_id")) -> DataFrame:
    """Range from a requested frame to the next accepted frame of its segment.

    frames    ``keys, segment_id, frame_id, effective_status``
    requests  ``keys, frame_id``
    Without a later accepted frame the range runs to the segment end and names the first
    frame of the next segment as its open end (null at the last segment).
    """
    keys = list(keys)
    segment = [*keys, "segment_id"]
    frames = blocked(frames, segment, ["frame_id"])
    behind = scan(frames, segment, ["frame_id"], prev={"_before": F.col("frame_id")})
    accepted = F.when(F.col("effective_status") == "accepted", F.struct("frame_id", "_before"))
    marked = scan(behind, segment, ["frame_id"], next={"_next": accepted})
    bounds = frames.groupBy(*segment).agg(F.min("frame_id").alias("first_frame"), F.max("frame_id").alias("segment_last"))
    bounds = scan(bounds, keys, ["first_frame"], next={"next_segment_first": F.col("first_frame")})
    wanted = requests.select(*keys, "frame_id").distinct()
    found = marked.join(wanted, [*keys, "frame_id"]).join(bounds.drop("first_frame"), segment)
    found = found.withColumns({"next_accepted": F.col("_next.frame_id"), "before_accepted": F.col("_next._before")})
    hit = F.col("next_accepted").isNotNull()
    return found.select(
        *segment,
        F.col("frame_id").alias("start_frame"),
        F.when(hit, F.col("before_accepted")).otherwise(F.col("segment_last")).alias("last_frame"),
        F.when(hit, F.col("next_accepted")).otherwise(F.col("next_segment_first")).alias("end_before_frame"),
        F.when(hit, "next_accepted").otherwise("segment_end").alias("boundary_reason"),
    )


def reject_tail(frames: DataFrame, requests: DataFrame, scope: str, keys: Sequence[str] = ("scene_id", "instance_id")) -> DataFrame:
    """Override rows that reject everything from a frame to the end of its segment or scene."""
    if scope not in ("segment", "scene"):
        raise ValueError("scope must be segment or scene")
    keys = list(keys)
    first = frames.join(requests.select(*keys, "frame_id"), [*keys, "frame_id"])
    group = [*keys, "segment_id"] if scope == "segment" else keys
    starts = first.groupBy(*group).agg(F.min("frame_id").alias("_from"))
    return (
        frames.join(starts, group)
        .where(F.col("frame_id") >= F.col("_from"))
        .select(*keys, "frame_id", F.lit("rejected").alias("status"), F.lit(f"manual_rejected_{scope}_tail").alias("reason"))
    )


def reject_range(frames: DataFrame, marks: DataFrame, keys: Sequence[str] = ("scene_id", "instance_id")) -> DataFrame:
    """Override rows for marked problem ranges ``keys, mark_a, mark_b`` (any order, both included)."""
    keys = list(keys)
    starts = marks.select(*keys, F.least("mark_a", "mark_b").alias("frame_id"), F.lit(0).alias("_kind"), F.greatest("mark_a", "mark_b").alias("_to"))
    starts = starts.groupBy(*keys, "frame_id", "_kind").agg(F.max("_to").alias("_to"))
    rows = frames.select(*keys, "frame_id", F.lit(1).alias("_kind"), F.lit(None).cast("string").alias("_to"))
    # a frame is inside when some range that began at or before it reaches it
    reach = scan(starts.unionByName(rows), keys, ["frame_id", "_kind"], cummax={"_reach": F.col("_to")})
    return reach.where((F.col("_kind") == 1) & (F.col("_reach") >= F.col("frame_id"))).select(
        *keys, "frame_id", F.lit("rejected").alias("status"), F.lit("manual_problem_range").alias("reason")
    )


def review_batches(segments: DataFrame, size: int = 3, keys: Sequence[str] = ("scene_id",)) -> DataFrame:
    """Segments in order, ``size`` of them per batch."""
    numbered = scan(segments, list(keys), ["segment_id"], index_block(F.col("segment_id")), index="_i")
    return numbered.withColumn("batch", F.floor(F.col("_i") / size).cast("long")).drop("_i")


def merge_ranges(ranges: DataFrame, keys: Sequence[str] = ("scene_id", "instance_id", "segment_id")) -> DataFrame:
    """Merge overlapping or touching ``[start_pos, end_pos)`` ranges inside a segment."""
    keys = list(keys)
    # equal starts collapse first, which also makes the order total
    unique = ranges.groupBy(*keys, "start_pos").agg(F.max("end_pos").alias("end_pos"))
    block = index_block(F.col("start_pos"))
    marked = scan(unique, keys, ["start_pos"], block, cummax={"_reach": F.col("end_pos")})
    fresh = F.when(F.col("_reach").isNull() | (F.col("start_pos") > F.col("_reach")), 1).otherwise(0)
    islands = scan(marked, keys, ["start_pos"], block, cumsum={"_island": fresh})
    return islands.groupBy(*keys, "_island").agg(
        F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos"), F.count(F.lit(1)).alias("merged")
    ).drop("_island")


def validate_ranges(requests: DataFrame, frames: DataFrame, segments: DataFrame) -> DataFrame:
    """Check range requests; adds positions, the resolved segment and an ``error`` (null = fine).

    requests  ``request_id, scene_id, start_frame, end_before_frame, segment_id`` (last two nullable)
    frames    ``scene_id, frame_id, position, active``
    segments  ``scene_id, segment_id, start_pos, end_pos`` (closed, not overlapping)
    """
    place = frames.select("scene_id", "frame_id", "position")
    start = place.select("scene_id", F.col("frame_id").alias("start_frame"), F.col("position").alias("start_pos"))
    end = place.select("scene_id", F.col("frame_id").alias("end_before_frame"), F.col("position").alias("_end"))
    seg = segments.select("scene_id", F.col("segment_id").alias("found_segment"), F.col("start_pos").alias("_s"), F.col("end_pos").alias("_e"))
    asked = requests.withColumn("end_before_frame", F.nullif(F.col("end_before_frame"), F.lit("")))
    located = asked.join(start, ["scene_id", "start_frame"], "left").join(end, ["scene_id", "end_before_frame"], "left")
    home = interval_join(located.where(F.col("start_pos").isNotNull()), seg, "scene_id", "start_pos", "_s", "_e")
    keep = [c for c in located.columns]
    lost = located.join(home.select("request_id"), "request_id", "left_anti").select(
        *keep, F.lit(None).cast(segments.schema["segment_id"].dataType).alias("found_segment"), F.lit(None).cast("long").alias("_s"), F.lit(None).cast("long").alias("_e")
    )
    both = home.select(*keep, "found_segment", "_s", "_e").unionByName(lost)
    end_pos = F.when(F.col("end_before_frame").isNull(), F.col("_e") + 1).otherwise(F.col("_end"))
    both = both.withColumn("end_pos", end_pos)
    # inactive frames inside the range, counted by prefix sums at both ends
    idle = scan(frames, ["scene_id"], ["position"], index_block(F.col("position")), cumsum={"_idle": F.when(F.col("active"), 0).otherwise(1)})
    idle = idle.select("scene_id", "position", "_idle", F.when(F.col("active"), 0).otherwise(1).alias("_own"))
    at_start = idle.select("scene_id", F.col("position").alias("start_pos"), (F.col("_idle") - F.col("_own")).alias("_idle_before"))
    at_end = idle.select("scene_id", (F.col("position") + 1).alias("end_pos"), F.col("_idle").alias("_idle_upto"))
    both = both.join(at_start, ["scene_id", "start_pos"], "left").join(at_end, ["scene_id", "end_pos"], "left")
    declared = F.col("segment_id").isNotNull() & (F.col("segment_id") != F.col("found_segment"))
    error = (
        F.when(F.col("found_segment").isNull(), "start_outside_segments")
        .when(declared, "segment_mismatch")
        .when(F.col("end_pos").isNull(), "end_unknown")
        .when(F.col("end_pos") <= F.col("start_pos"), "end_not_after_start")
        .when(F.col("end_pos") - 1 > F.col("_e"), "crosses_segment")
        .when(F.col("_idle_upto") > F.col("_idle_before"), "outside_active_frames")
    )
    return both.select("request_id", "scene_id", "start_frame", "end_before_frame", "found_segment", "start_pos", "end_pos", error.alias("error"))


def interval_join(points: DataFrame, intervals: DataFrame, key: str, point: str, low: str, high: str, size: int = 1024) -> DataFrame:
    """Points inside closed integer intervals of the same key, by equi-join on blocks.

    Every interval is listed under the blocks it covers, so the join has an equality key
    and neither side of a long sequence meets in one task.
    """
    covered = F.sequence(F.floor(F.col(low) / size).cast("long"), F.floor(F.col(high) / size).cast("long"))
    spread = intervals.where(F.col(high) >= F.col(low)).withColumn("_cell", F.explode(covered))
    placed = points.withColumn("_cell", F.floor(F.col(point) / size).cast("long"))
    return placed.join(spread, [key, "_cell"]).where(F.col(point).between(F.col(low), F.col(high))).drop("_cell")


def upsert_report(old: DataFrame, partial: DataFrame, replaced: DataFrame, keys: Sequence[str] = FRAME) -> tuple[DataFrame, DataFrame]:
    """Replace the listed frames by their partial rows; second result lists frames without one."""
    keys = list(keys)
    fresh = partial.join(replaced, keys, "left_semi")
    merged = old.join(fresh.select(*keys), keys, "left_anti").unionByName(fresh)
    missing = replaced.join(partial.select(*keys), keys, "left_anti").select(
        F.lit("partial_record_missing").alias("rule"), F.concat_ws("/", *keys).alias("key"), F.lit(None).cast("string").alias("detail")
    )
    return merged, missing


def replace_masks(old: DataFrame, new: DataFrame, replaced: DataFrame, keys: Sequence[str] = FRAME) -> DataFrame:
    """Old masks outside the replaced frames, only new masks inside them."""
    keys = list(keys)
    return old.join(replaced, keys, "left_anti").unionByName(new.join(replaced, keys, "left_semi"))


def missing_from_report(active: DataFrame, report: DataFrame, keys: Sequence[str] = FRAME) -> DataFrame:
    """Active frames for which the report has no record."""
    return active.select(*keys).join(report.select(*keys), list(keys), "left_anti")


def accept_violations(overrides: DataFrame, areas: DataFrame, keys: Sequence[str] = FRAME) -> DataFrame:
    """Accept decisions on frames without a non-empty mask."""
    keys = list(keys)
    joined = overrides.where(F.col("status") == "accepted").join(areas.select(*keys, "mask_area"), keys, "left")
    return joined.where(F.coalesce("mask_area", F.lit(0)) <= 0).select(*keys, F.lit("accept_without_mask").alias("rule"))
