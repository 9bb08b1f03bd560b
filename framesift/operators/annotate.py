"""From frames, mask runs and depth to graded records, verdicts and labels in one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.geometry import box_label, touches_border
from ..functions.text import output_id
from ..session import stored
from . import depth, masks, review, verdict
from .quality import grade_sequence, resolve_thresholds


def measure_masks(runs: DataFrame, depth_rows: DataFrame) -> DataFrame:
    """Area, box, fragments and depth coverage of every non-empty mask, from its runs or tiles."""
    tiles = stored(masks.tiles(runs))
    areas = masks.area_and_box(tiles)
    parts = masks.fragments(tiles)
    seen = depth.coverage(tiles, depth_rows)
    keys = list(masks.MASK)
    return areas.join(parts, keys).join(seen, keys)


def score_masks(
    frames: DataFrame,
    instances: DataFrame,
    mask_files: DataFrame,
    runs: DataFrame,
    depth_rows: DataFrame,
    thresholds: Column | None = None,
) -> DataFrame:
    """Graded record of every (frame, instance).

    frames      ``scene_id, frame_id, frame_index, width, height``
    instances   ``scene_id, instance_id, ord, class_id`` and what ``thresholds`` refers to
    mask_files  ``scene_id, frame_id, instance_id`` of masks that exist (possibly empty ones)
    runs        runs, or tiles that were made of them (``masks.tiles``)
    The label line is the box of the mask and needs the minimum area.
    """
    limits = resolve_thresholds() if thresholds is None else thresholds
    keys = list(masks.MASK)
    measured = measure_masks(runs, depth_rows)
    present = mask_files.select(*keys).distinct().withColumn("has_mask", F.lit(True))
    rows = frames.join(instances, "scene_id").join(present, keys, "left").join(measured, keys, "left")
    has_mask = F.coalesce("has_mask", F.lit(False))
    zero = lambda c, v: F.when(has_mask, F.coalesce(c, F.lit(v)))
    rows = rows.withColumns(
        {
            "has_mask": has_mask,
            "mask_area": zero("mask_area", 0),
            "area_fraction": zero(F.col("mask_area") / (F.col("width") * F.col("height")), 0.0),
            "depth_coverage": zero("depth_coverage", 0.0),
            "dominant_component_ratio": zero("dominant_component_ratio", 0.0),
            "cx": (F.col("x1") + F.col("x2")) * 0.5,
            "cy": (F.col("y1") + F.col("y2")) * 0.5,
            "touches_border": touches_border(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"), F.col("width"), F.col("height"), limits["border_margin_px"]),
            "registration": F.col("frame_index") == 0,
            "line": F.when(
                F.col("mask_area") >= limits["min_mask_area"],
                box_label(F.col("class_id"), F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"), F.col("width"), F.col("height")),
            ),
        }
    )
    return grade_sequence(rows, limits)


def aggregate_frames(
    frames: DataFrame, instances: DataFrame, records: DataFrame, runs: DataFrame, overrides: DataFrame | None = None, *, max_overlap: float = 0.20, include_review: bool = False
) -> DataFrame:
    """Verdict of every frame from its records, after manual overrides.

    records  ``scene_id, frame_id, instance_id, ord, status, reject_reasons, review_reasons, line, has_mask``
    """
    rows = records
    if overrides is not None:
        rows = review.apply_overrides(rows, review.latest_overrides(overrides))
    name = lambda df: df.withColumn("output_id", output_id(F.col("frame_id"), F.col("scene_id")))
    allowed = ["accepted", "review"] if include_review else ["accepted"]
    labeled = F.col("line").isNotNull() & F.col("status").isin(allowed)
    items = stored(
        name(rows).select(
            "scene_id", "output_id", "frame_id", "instance_id", "ord", "status", labeled.alias("has_label"),
            F.when(labeled, F.col("line")).otherwise("").alias("label"), F.lit(True).alias("has_mask"),
        )
    )
    expected = verdict.expected_instances(name(frames.select("scene_id", "frame_id")), instances)
    tiles = stored(masks.tiles(runs))
    overlaps = name(masks.overlap_ratios(masks.pair_overlaps(tiles), masks.areas(tiles)))
    return verdict.frame_verdicts(expected, items, overlaps, max_overlap=max_overlap, include_review=include_review)
