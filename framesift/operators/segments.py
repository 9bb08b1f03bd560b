"""Cutting frame sequences into segments and planning their key masks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..plans.blocks import index_block
from ..plans.ordered import scan
from ..plans.quantiles import exact_quantiles
from ..session import cut
from .review import interval_join

SCENE = ("scene_id",)
JOIN_ROWS = 250_000  # frames in one part of a join by frame id, so parts grow in number and not in size


def scene_cuts(vectors: DataFrame, threshold: float, order: str = "frame_id", block: Column | None = None) -> DataFrame:
    """Mean absolute difference to the last readable frame; ``is_cut`` at or above the threshold.

    vectors  ``scene_id, <order>, vec ARRAY`` with a null vec for an unreadable frame
    """
    carried = scan(vectors, list(SCENE), [order], block, prev={"_last": F.col("vec")})
    steps = F.zip_with("vec", "_last", lambda a, b: F.abs(a - b).cast("double"))
    diff = F.aggregate(steps, F.lit(0.0), lambda acc, v: acc + v) / F.size("vec")
    diff = F.when(F.col("vec").isNotNull() & F.col("_last").isNotNull(), diff)
    return carried.withColumn("visual_diff", diff).withColumn(
        "is_cut", F.coalesce(F.col("visual_diff") >= threshold, F.lit(False))
    ).drop("_last")


def gap_limits(frames: DataFrame, manual_ms: float = 0.0, block: Column | None = None, order: Sequence[str] = ("frame_id",)) -> DataFrame:
    """Median positive gap of each scene and the limit derived from it (3 x median, or manual)."""
    known = frames.where(F.col("timestamp_ms").isNotNull())
    paired = scan(known, list(SCENE), list(order), block, prev={"_before": F.col("timestamp_ms")})
    gaps = paired.select("scene_id", (F.col("timestamp_ms") - F.col("_before")).alias("gap")).where("gap > 0")
    median = exact_quantiles(gaps, SCENE, "gap", {"median_gap_ms": 0.5})
    limit = F.lit(float(manual_ms)) if manual_ms > 0 else F.col("median_gap_ms") * 3.0
    return median.withColumn("gap_limit_ms", limit)


def timestamp_gaps(frames: DataFrame, limits: DataFrame, block: Column | None = None, order: Sequence[str] = ("frame_id",), manual_ms: float = 0.0) -> DataFrame:
    """Gap to the last known timestamp; ``is_gap`` above the limit of the scene."""
    carried = scan(frames, list(SCENE), list(order), block, prev={"_before": F.col("timestamp_ms")})
    joined = carried.join(limits.select("scene_id", "gap_limit_ms"), "scene_id", "left")
    limit = F.lit(float(manual_ms)) if manual_ms > 0 else F.col("gap_limit_ms")
    gap = F.col("timestamp_ms") - F.col("_before")
    return joined.withColumn("gap_ms", gap).withColumn("is_gap", F.coalesce(gap > limit, F.lit(False))).drop("_before", "gap_limit_ms")


def boundaries(frames: DataFrame, max_frames: int, order: str = "frame_id", block: Column | None = None) -> DataFrame:
    """Boundary reasons of every frame.

    frames  ``scene_id, <order>, is_cut, is_gap``
    A segment also ends after ``max_frames``: with ``h`` the last cut, gap or start before a
    frame, the length rule holds when ``(index - h) % max_frames = 0``.
    """
    numbered = scan(frames, list(SCENE), [order], block, index="frame_index")
    hard = (F.col("frame_index") == 0) | F.col("is_cut") | F.col("is_gap")
    marked = scan(
        numbered, list(SCENE), ["frame_index"], index_block(F.col("frame_index")), prev={"_hard": F.when(hard, F.col("frame_index"))}
    )
    too_long = F.coalesce((F.col("frame_index") - F.col("_hard")) % max_frames == 0, F.lit(False))
    first = F.col("frame_index") == 0

    def one(condition: Column, reason: str) -> Column:
        return F.when(condition, F.lit(reason))

    reasons = F.array_compact(
        F.array(
            one(first, "sequence_start"),
            one(F.col("is_cut"), "visual_scene_cut"),
            one(F.col("is_gap"), "timestamp_gap"),
            one(~first & too_long, "max_segment_length"),
        )
    )
    found = marked.withColumn("boundary_reasons", reasons).drop("_hard")
    return found.withColumn("is_boundary", F.size("boundary_reasons") > 0)


def segments(bounded: DataFrame, order: str = "frame_id") -> DataFrame:
    """Segment table: number, closed index range, ids, length, reasons, warned frames.

    bounded  result of ``boundaries``; an optional ``has_warning`` is counted per segment
    """
    warned = F.col("has_warning") if "has_warning" in bounded.columns else F.lit(False)
    rows = bounded.withColumn("_w", F.coalesce(warned, F.lit(False)))
    block = index_block(F.col("frame_index"))
    numbered = scan(rows, list(SCENE), ["frame_index"], block, cumsum={"_seg": F.col("is_boundary").cast("long")})
    return (
        numbered.groupBy("scene_id", (F.col("_seg") - 1).alias("segment_id"))
        .agg(
            F.min("frame_index").alias("start_index"),
            F.max("frame_index").alias("end_index"),
            F.min(order).alias("start_id"),
            F.max(order).alias("end_id"),
            F.count(F.lit(1)).alias("frame_count"),
            F.max(F.when(F.col("is_boundary"), F.array_join("boundary_reasons", "|"))).alias("boundary_reasons"),
            F.count_if("_w").alias("warned_frames"),
        )
    )


def frame_warnings(depth_ratio: Column, rgb_readable: Column, minimum: float) -> Column:
    """Capture warnings of a frame: depth first, then colour."""
    return F.array_compact(
        F.array(
            F.when(depth_ratio.isNull(), F.lit("depth_missing")).when(depth_ratio < minimum, F.lit("depth_valid_ratio_low")),
            F.when(~rgb_readable, F.lit("rgb_unreadable")),
        )
    )


def segment_of_frame(frames: DataFrame, table: DataFrame) -> DataFrame:
    """First listed segment that contains each frame position.

    frames  ``scene_id, frame_id, position``; table ``scene_id, segment_id, list_pos, start_pos, end_pos``
    with the ends in any order.
    """
    spans = table.select(
        "scene_id", "segment_id", "list_pos", F.least("start_pos", "end_pos").alias("_lo"), F.greatest("start_pos", "end_pos").alias("_hi")
    )
    hits = interval_join(frames, spans, "scene_id", "position", "_lo", "_hi")
    return hits.groupBy("scene_id", "frame_id", "position").agg(F.min(F.struct("list_pos", "segment_id")).alias("s")).select(
        "scene_id", "frame_id", "position", F.col("s.segment_id").alias("segment_id")
    )


def usable_segments(table: DataFrame, frames: DataFrame) -> DataFrame:
    """Segments with known ends, swapped when reversed; one whole-scene segment where none is left.

    table  ``scene_id, segment_id, list_pos, start_id, end_id``; frames ``scene_id, frame_id``
    """
    placed = cut(scan(frames.select("scene_id", "frame_id"), list(SCENE), ["frame_id"], index="position"))
    parts = max(1, -(-placed.count() // JOIN_ROWS))
    first = placed.select("scene_id", F.col("frame_id").alias("start_id"), F.col("position").alias("_a"))
    last = placed.select("scene_id", F.col("frame_id").alias("end_id"), F.col("position").alias("_b"))
    known = table.repartition(parts, "scene_id", "start_id").join(first.repartition(parts, "scene_id", "start_id"), ["scene_id", "start_id"])
    known = known.repartition(parts, "scene_id", "end_id").join(last.repartition(parts, "scene_id", "end_id"), ["scene_id", "end_id"])
    swapped = F.col("_b") < F.col("_a")
    good = known.select(
        "scene_id",
        F.col("segment_id").cast("string").alias("segment_id"),
        "list_pos",
        F.when(swapped, F.col("end_id")).otherwise(F.col("start_id")).alias("start_id"),
        F.when(swapped, F.col("start_id")).otherwise(F.col("end_id")).alias("end_id"),
        F.least("_a", "_b").alias("start_pos"),
        F.greatest("_a", "_b").alias("end_pos"),
    )
    whole = placed.groupBy("scene_id").agg(
        F.min("frame_id").alias("start_id"), F.max("frame_id").alias("end_id"), F.max("position").alias("end_pos")
    )
    fallback = whole.join(good.select("scene_id").distinct(), "scene_id", "left_anti").select(
        "scene_id", F.lit("0").alias("segment_id"), F.lit(0).alias("list_pos"), "start_id", "end_id", F.lit(0).cast("long").alias("start_pos"), "end_pos"
    )
    return good.unionByName(fallback)


def key_mask_todo(table: DataFrame, instances: DataFrame, key_masks: DataFrame) -> DataFrame:
    """Every (segment, instance) whose start frame has no key mask yet, with the target path.

    table      ``scene_id, segment_id, start_id``
    instances  ``scene_id, instance_id, key_mask_dir``
    key_masks  ``scene_id, instance_id, frame_id, mask_area``
    """
    needed = table.select("scene_id", "segment_id", "start_id").join(instances, "scene_id")
    drawn = key_masks.where("mask_area > 0").select("scene_id", "instance_id", F.col("frame_id").alias("start_id")).distinct()
    return needed.join(drawn, ["scene_id", "instance_id", "start_id"], "left_anti").select(
        "scene_id", "segment_id", "start_id", "instance_id", F.concat("key_mask_dir", F.lit("/"), "start_id", F.lit(".png")).alias("target")
    )


def segment_progress(table: DataFrame, instances: DataFrame, todo: DataFrame) -> DataFrame:
    """Per segment: required, missing (names) and whether tracking may start."""
    required = instances.groupBy("scene_id").agg(F.count(F.lit(1)).alias("required"))
    missing = todo.groupBy("scene_id", "segment_id").agg(F.array_sort(F.collect_list("instance_id")).alias("missing_key_masks"))
    joined = table.select("scene_id", "segment_id", "start_id").join(required, "scene_id", "left").join(missing, ["scene_id", "segment_id"], "left")
    none = F.array().cast("array<string>")
    return joined.select(
        "scene_id",
        "segment_id",
        "start_id",
        F.coalesce("required", F.lit(0)).alias("required"),
        F.coalesce("missing_key_masks", none).alias("missing_key_masks"),
        (F.size(F.coalesce("missing_key_masks", none)) == 0).alias("ready"),
    )


def readiness(progress: DataFrame) -> DataFrame:
    """Ready segments, key masks missing and required, per scene."""
    return progress.groupBy("scene_id").agg(
        F.count(F.lit(1)).alias("segments"),
        F.count_if("ready").alias("ready_segments"),
        F.sum(F.size("missing_key_masks")).alias("missing_key_masks"),
        F.sum("required").alias("required_key_masks"),
    )


def with_absent_paths(missing: DataFrame, required: DataFrame, files: DataFrame) -> DataFrame:
    """``missing``, and for segments that list nothing there the instances whose required file is absent.

    missing  ``scene_id, segment_id, instance_id``
    required  ``scene_id, segment_id, instance_id, path``; files  ``path``
    """
    on = ["scene_id", "segment_id"]
    listed = missing.select(*on).distinct()
    absent = required.where("path <> ''").join(listed, on, "left_anti").join(files.select("path"), "path", "left_anti")
    return missing.select(*on, "instance_id").unionByName(absent.select(*on, "instance_id")).distinct()


def missing_by_class(missing: DataFrame, instances: DataFrame) -> DataFrame:
    """Missing instances of a segment grouped by class, names sorted.

    missing  ``scene_id, segment_id, instance_id``; unknown instances are dropped
    """
    known = missing.join(instances.select("scene_id", "instance_id", "class_name"), ["scene_id", "instance_id"])
    return known.groupBy("scene_id", "segment_id", "class_name").agg(
        F.array_sort(F.collect_list("instance_id")).alias("instance_ids")
    )
