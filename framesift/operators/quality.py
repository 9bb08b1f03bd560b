"""Quality gates: thresholds, reject and review reasons, motion against the last good frame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..constants import MASK_SEQUENCE_THRESHOLDS
from ..functions.geometry import center_shift_norm, hypotenuse, rotation_jump_deg, translation_jump_m
from ..plans.blocks import FRAMES_PER_BLOCK, index_block
from ..plans.chains import Rule, last_kept
from ..plans.ordered import scan
from ..session import stored

INSTANCE = ("scene_id", "instance_id")
METRICS = (
    "mask_area",
    "area_fraction",
    "depth_coverage",
    "depth_median_abs_m",
    "depth_rmse_m",
    "dominant_component_ratio",
    "area_ratio",
    "center_shift_norm",
    "translation_jump_m",
    "rotation_jump_deg",
    "touches_border",
)


def resolve_thresholds(*layers: Column, defaults: Mapping[str, float] = MASK_SEQUENCE_THRESHOLDS) -> Column:
    """One struct of thresholds from MAP layers, most specific layer first."""
    return F.struct(
        *[
            F.coalesce(*[F.try_element_at(layer, F.lit(name)) for layer in layers], F.lit(float(value))).alias(name)
            for name, value in defaults.items()
        ]
    )


def _fires(condition: Column, reason: str) -> Column:
    # a null metric leaves the rule silent
    return F.when(condition, F.lit(reason))


def static_reject_reasons(t: Column, m=F.col) -> Column:
    """Reject rules that look at the frame alone."""
    return F.array_compact(
        F.array(
            _fires(m("mask_area") < t["min_mask_area"], "mask_area_too_small"),
            _fires(m("area_fraction") < t["min_area_fraction"], "object_too_small_in_image"),
            _fires(m("area_fraction") > t["max_area_fraction"], "object_too_large_in_image"),
            _fires(m("depth_coverage") < t["min_depth_coverage"], "depth_coverage_too_low"),
            _fires(m("depth_median_abs_m") > t["max_depth_median_abs_m"], "depth_alignment_bad"),
            _fires(m("depth_rmse_m") > t["max_depth_rmse_m"], "depth_rmse_bad"),
            _fires(m("dominant_component_ratio") < t["min_dominant_component_ratio"], "mask_fragmented"),
        )
    )


def motion_reject_reasons(t: Column, m=F.col) -> Column:
    """Reject rules against the last good frame."""
    ratio = m("area_ratio")
    return F.array_compact(
        F.array(
            _fires((ratio < t["min_area_ratio"]) | (ratio > t["max_area_ratio"]), "mask_area_jump"),
            _fires(m("center_shift_norm") > t["max_center_shift_norm"], "mask_center_jump"),
            _fires(m("translation_jump_m") > t["max_translation_jump_m"], "translation_jump"),
            _fires(m("rotation_jump_deg") > t["max_rotation_jump_deg"], "rotation_jump"),
        )
    )


def review_reasons(t: Column, registration: Column, m=F.col) -> Column:
    moving = ~registration
    return F.array_compact(
        F.array(
            _fires(m("touches_border"), "touches_image_border"),
            _fires(m("depth_coverage") < t["review_depth_coverage"], "depth_coverage_marginal"),
            _fires(m("depth_median_abs_m") > t["review_depth_median_abs_m"], "depth_alignment_marginal"),
            _fires(moving & (m("center_shift_norm") > t["review_center_shift_norm"]), "large_center_motion"),
            _fires(moving & (m("translation_jump_m") > t["review_translation_jump_m"]), "large_translation_motion"),
            _fires(moving & (m("rotation_jump_deg") > t["review_rotation_jump_deg"]), "large_rotation_motion"),
        )
    )


def classify(df: DataFrame, thresholds: Column, registration: Column) -> DataFrame:
    """Adds ``status, reject_reasons, review_reasons``; absent metrics count as null."""
    present = set(df.columns)

    def metric(name: str) -> Column:
        return F.col(name) if name in present else F.lit(None).cast("boolean" if name == "touches_border" else "double")

    nothing = F.array().cast("array<string>")
    motion = F.when(registration, nothing).otherwise(motion_reject_reasons(thresholds, metric))
    reject = F.concat(static_reject_reasons(thresholds, metric), motion)
    return (
        df.withColumn("reject_reasons", reject)
        .withColumn(
            "review_reasons",
            F.when(F.size("reject_reasons") > 0, nothing).otherwise(review_reasons(thresholds, registration, metric)),
        )
        .withColumn(
            "status",
            F.when(F.size("reject_reasons") > 0, "rejected").when(F.size("review_reasons") > 0, "review").otherwise("accepted"),
        )
    )


def quick_gate(df: DataFrame, *, min_area=80.0, min_ratio=0.35, max_ratio=2.8, min_coverage=0.25) -> DataFrame:
    """Gate of propagated masks; adds ``reasons`` and ``good``."""
    ratio = F.col("area_ratio")
    reasons = F.array_compact(
        F.array(
            _fires(F.coalesce("mask_area", F.lit(0)) < min_area, "mask_area_too_small"),
            _fires((ratio < min_ratio) | (ratio > max_ratio), "mask_area_jump"),
            _fires(F.coalesce("depth_coverage", F.lit(0.0)) < min_coverage, "depth_coverage_too_low"),
        )
    )
    return df.withColumn("reasons", reasons).withColumn("good", F.size("reasons") == 0)


def registration_iou_gate(df: DataFrame, minimum: float) -> DataFrame:
    """Registration frames whose mask disagrees with the drawn one become rejected."""
    low = F.coalesce(F.col("registration_mask_iou") < minimum, F.lit(False))
    return df.withColumns(
        {
            "status": F.when(low, "rejected").otherwise(F.col("status")),
            "reject_reasons": F.when(
                low, F.concat("reject_reasons", F.array(F.lit("registration_mask_iou_too_low")))
            ).otherwise(F.col("reject_reasons")),
        }
    )


class Motion(Rule):
    """The motion rules against the last good frame, for whole columns; the same limits as the column rules.

    columns  ``area, x, y, pose`` and ``_usable, _first, _min_ratio, _max_ratio, _max_shift, _max_step, _max_turn, _diagonal``
    """

    def possible(self, rows):
        return rows["_usable"].astype(bool)

    def near(self, refs, rows):
        both = (refs["area"] > 0) & (rows["area"] > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = rows["area"] / refs["area"]
            dx, dy = rows["x"] - refs["x"], rows["y"] - refs["y"]
            far = np.sqrt(dx * dx + dy * dy) / rows["_diagonal"] > rows["_max_shift"]
            bad = both & ((ratio < rows["_min_ratio"]) | (ratio > rows["_max_ratio"]) | far)
            before, pose = refs["pose"], rows["pose"]
            if pose.ndim == 2 and pose.shape[1] >= 12:  # a null pose is NaN, and no limit holds or fails for it
                step = np.sqrt(((pose[:, [3, 7, 11]] - before[:, [3, 7, 11]]) ** 2).sum(axis=1))
                turned = [0, 1, 2, 4, 5, 6, 8, 9, 10]
                trace = (pose[:, turned] * before[:, turned]).sum(axis=1)
                turn = np.degrees(np.arccos(np.clip((trace - 1.0) * 0.5, -1.0, 1.0)))
                bad |= (step > rows["_max_step"]) | (turn > rows["_max_turn"])
        return rows["_first"].astype(bool) | ~bad


def grade_sequence(
    frames: DataFrame,
    thresholds: Column,
    *,
    keys: Sequence[str] = INSTANCE,
    index: str = "frame_index",
    reset_at_registration: bool = False,
    block_rows: int = FRAMES_PER_BLOCK,
) -> DataFrame:
    """Grade every frame against the last frame that was not rejected.

    frames     ``keys, frame_index, mask_area, cx, cy, width, height, registration BOOLEAN,
               has_mask BOOLEAN`` plus the frame's own metrics; optional ``pose``, ``iou_ok``.
               ``frame_index`` counts the frames of a key from 0.
    thresholds struct column as from ``resolve_thresholds``
    reset_at_registration  forget earlier frames at a registration frame (pose tracking)
    block_rows  frames of a sequence that are evaluated apart from the others

    Adds ``area_ratio, center_shift_norm, translation_jump_m, rotation_jump_deg, status,
    reject_reasons, review_reasons``.  Frames without a mask are rejected and never become
    the frame others are compared with.
    """
    keys = list(keys)
    if reset_at_registration:
        # a registration starts a sequence of its own, whatever its verdict
        frames = tracking_segments(frames, keys=keys, index=index)
        keys.append("tracking_segment")
    pose = F.col("pose") if "pose" in frames.columns else F.lit(None).cast("array<double>")
    frames = stored(frames)  # read by the chain and by the verdict
    iou_ok = F.col("iou_ok") if "iou_ok" in frames.columns else F.lit(True)
    present = set(frames.columns)

    def metric(name: str) -> Column:
        return F.col(name) if name in present else F.lit(None).cast("double")

    alone_ok = F.size(static_reject_reasons(thresholds, metric)) == 0
    limits = {
        "_min_ratio": thresholds["min_area_ratio"],
        "_max_ratio": thresholds["max_area_ratio"],
        "_max_shift": thresholds["max_center_shift_norm"],
        "_max_step": thresholds["max_translation_jump_m"],
        "_max_turn": thresholds["max_rotation_jump_deg"],
        "_diagonal": hypotenuse(F.col("width"), F.col("height")),
    }
    compact = frames.select(
        *keys,
        index,
        F.coalesce(F.col("mask_area"), F.lit(0)).cast("double").alias("area"),
        F.col("cx").cast("double").alias("x"),
        F.col("cy").cast("double").alias("y"),
        pose.alias("pose"),
        F.coalesce(F.col("has_mask") & alone_ok & iou_ok, F.lit(False)).alias("_usable"),
        F.coalesce("registration", F.lit(False)).alias("_first"),
        *[c.alias(name) for name, c in limits.items()],
    )
    chain = last_kept(
        compact, keys, index, index_block(F.col(index), block_rows), ["area", "x", "y", "pose"], Motion(), ["_usable", "_first", *limits]
    ).select(*keys, index, F.col("ref_area").alias("_ra"), F.col("ref_x").alias("_rx"), F.col("ref_y").alias("_ry"), F.col("ref_pose").alias("_rp"))
    joined = frames.join(chain, [*keys, index])
    registration = F.coalesce("registration", F.lit(False))
    has_ref = (F.col("_ra") > 0) & (F.col("mask_area") > 0)
    before = F.col("_rp")
    graded = joined.withColumns(
        {
            "area_ratio": F.when(has_ref, F.col("mask_area") / F.col("_ra")),
            "center_shift_norm": F.when(
                has_ref,
                center_shift_norm(F.col("cx"), F.col("cy"), F.col("_rx"), F.col("_ry"), F.col("width"), F.col("height")),
            ),
            "translation_jump_m": translation_jump_m(before, pose),
            "rotation_jump_deg": rotation_jump_deg(before, pose),
        }
    ).drop("_ra", "_rx", "_ry", "_rp")
    graded = classify(graded, thresholds, registration)
    absent = ~F.coalesce("has_mask", F.lit(False))
    graded = graded.withColumns(
        {
            "status": F.when(absent, "rejected").otherwise(F.col("status")),
            "reject_reasons": F.when(absent, F.array(F.lit("mask_file_missing"))).otherwise(F.col("reject_reasons")),
            "review_reasons": F.when(absent, F.array().cast("array<string>")).otherwise(F.col("review_reasons")),
        }
    )
    if "iou_ok" in frames.columns:
        low = ~F.coalesce("iou_ok", F.lit(True))
        graded = graded.withColumns(
            {
                "status": F.when(low, "rejected").otherwise(F.col("status")),
                "reject_reasons": F.when(
                    low, F.concat("reject_reasons", F.array(F.lit("registration_mask_iou_too_low")))
                ).otherwise(F.col("reject_reasons")),
            }
        )
    return graded


def reject_streaks(
    records: DataFrame,
    limit: int,
    *,
    keys: Sequence[str] = INSTANCE,
    index: str = "frame_index",
    counted: Column | None = None,
    reset: Column | None = None,
) -> DataFrame:
    """Frames at which a run of rejections reaches exactly ``limit`` (one request per run).

    counted  rows that take part; others neither lengthen nor end a run
    reset    rows that start counting anew before their own status is looked at
    """
    rejected = F.col("status") == "rejected"
    reset = F.lit(False) if reset is None else F.coalesce(reset, F.lit(False))
    rows = records if counted is None else records.where(F.coalesce(counted, F.lit(False)))
    hits = F.when(rejected, 1).otherwise(0)
    # running count of rejections, and its value when the run last ended or was reset
    scanned = scan(rows, list(keys), [index], index_block(F.col(index)), cumsum={"_hits": hits})
    base = F.when(~rejected, F.col("_hits")).when(reset, F.col("_hits") - 1)
    scanned = scan(scanned, list(keys), [index], index_block(F.col(index)), prev={"_base": base})
    own_base = F.when(rejected & reset, F.col("_hits") - 1).otherwise(F.coalesce("_base", F.lit(0)))
    streak = F.col("_hits") - own_base
    return scanned.where(rejected & (streak == limit)).withColumn("streak", streak.cast("long")).drop("_hits", "_base")


def tracking_segments(records: DataFrame, *, keys: Sequence[str] = INSTANCE, index: str = "frame_index") -> DataFrame:
    """Number of registrations so far, the first one not counted: ``tracking_segment``."""
    flagged = F.when(F.coalesce("registration", F.lit(False)) & (F.col(index) > 0), 1).otherwise(0)
    return scan(records, list(keys), [index], index_block(F.col(index)), cumsum={"tracking_segment": flagged})


def key_frame_distance(
    records: DataFrame, every: int, *, keys: Sequence[str] = INSTANCE, index: str = "frame_index", key_flag: str = "is_key"
) -> DataFrame:
    """Frames since the last key frame and whether the memory refresh is due.

    A refresh follows a good frame that is no key frame, every ``every`` frames; frames
    before the first key frame wait (null distance).
    """
    marker = F.when(F.col(key_flag), F.col(index))
    scanned = scan(records, list(keys), [index], index_block(F.col(index)), prev={"_key": marker})
    since = F.when(F.col(key_flag), F.lit(0)).otherwise(F.col(index) - F.col("_key"))
    good = F.col("status") == "accepted" if "status" in records.columns else F.lit(True)
    due = good & ~F.col(key_flag) & (since % every == 0) if every > 0 else F.lit(False)
    return scanned.withColumns({"since_key": since.cast("long"), "refresh_due": F.coalesce(due, F.lit(False))}).drop("_key")


def recovery_decision(df: DataFrame, *, after_failures: int = 1, min_seed_iou: float = 0.35) -> DataFrame:
    """Outcome of an automatic recovery attempt for a failed propagation.

    df  ``good, is_key, has_last_good, failures_before, reasons, seed_reason, seed_area,
        recovered_good, recovered_reasons, seed_iou``
    Adds ``attempted, succeeded, final_status, final_reasons, quality_reasons``.
    """
    attempted = ~F.col("good") & ~F.col("is_key") & F.col("has_last_good") & (F.col("failures_before") + 1 >= after_failures)
    seed = F.col("seed_reason").isNull() & (F.col("seed_area") > 0)
    close = F.col("seed_iou") >= min_seed_iou
    succeeded = F.coalesce(attempted & seed & F.col("recovered_good") & close, F.lit(False))
    checked = F.concat(
        F.coalesce("recovered_reasons", F.array().cast("array<string>")),
        F.when(~close, F.array(F.lit("recovery_seed_iou_too_low"))).otherwise(F.array().cast("array<string>")),
    )
    failed = F.concat(
        "reasons", F.array_compact(F.array(F.col("seed_reason"))), F.array(F.lit("auto_reregister_failed"))
    )
    return df.withColumns(
        {
            "attempted": attempted,
            "succeeded": succeeded,
            "quality_reasons": F.when(attempted & seed, checked),
            "final_status": F.when(F.col("good") | succeeded, "accepted").otherwise("rejected"),
            "final_reasons": F.when(succeeded, F.array().cast("array<string>"))
            .when(attempted, failed)
            .otherwise(F.col("reasons")),
        }
    )


def recovery_counts(records: DataFrame, keys: Sequence[str] = ("scene_id",)) -> DataFrame:
    """Attempted and succeeded recoveries; a null recovery counts as none."""
    return records.groupBy(*keys).agg(
        F.count_if(F.coalesce(F.col("recovery.attempted"), F.lit(False))).alias("attempted"),
        F.count_if(F.coalesce(F.col("recovery.succeeded"), F.lit(False))).alias("succeeded"),
    )


def status_counts(records: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Accepted / review / rejected per key, zeros kept."""
    return records.groupBy(*keys).agg(
        *[F.count_if(F.col("status") == s).alias(s) for s in ("accepted", "review", "rejected")]
    )


def user_fold(frames: DataFrame, keys: Sequence[str], order: Sequence[str], function, schema) -> DataFrame:
    """Hook for own logic over the ordered frames of a key.

    ``function(iterator of pandas frames) -> iterator of pandas frames`` sees the rows of a
    partition sorted by key and order, streamed batch by batch; a long sequence is never
    held in memory as a whole.
    """
    ordered = frames.repartition(*keys).sortWithinPartitions(*keys, *order)
    return ordered.mapInPandas(function, schema)
