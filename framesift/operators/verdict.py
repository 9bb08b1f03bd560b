"""Several instances of a frame -> one verdict per frame, and the report built from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import STATUSES
from ..functions.text import safe_name
from ..plans.ordered import scan

OUTPUT = ("scene_id", "output_id")
EMPTY = "array<string>"


def expected_instances(frames: DataFrame, instances: DataFrame) -> DataFrame:
    """Which instances each frame should show, from the frame window of each instance.

    frames     ``scene_id, frame_id, output_id``
    instances  ``scene_id, instance_id, ord, start, max_frames`` (0 = all frames)
    """
    placed = scan(frames, ["scene_id"], ["frame_id"], index="_pos")
    start = F.greatest(F.coalesce("start", F.lit(0)), F.lit(0))
    limit = F.coalesce("max_frames", F.lit(0))
    inside = (F.col("_pos") >= start) & ((limit <= 0) | (F.col("_pos") < start + limit))
    return (
        placed.join(instances, "scene_id")
        .where(inside)
        .select("scene_id", "output_id", "frame_id", safe_name(F.col("instance_id")).alias("instance_id"), "ord")
    )


def frame_slice(frames: DataFrame, start: int, max_frames: int) -> DataFrame:
    """Frames ``[start, start + max_frames)`` of every scene; adds ``frame_index`` from 0."""
    begin = max(0, start)
    placed = scan(frames, ["scene_id"], ["frame_id"], index="_pos")
    kept = placed.where(F.col("_pos") >= begin)
    if max_frames > 0:
        kept = kept.where(F.col("_pos") < begin + max_frames)
    return kept.withColumn("frame_index", F.col("_pos") - begin).drop("_pos")


def expected_observed(expected: DataFrame, items: DataFrame) -> DataFrame:
    """All output ids with the sorted names of expected instances that left no record."""
    e = expected.select(*OUTPUT, "instance_id", F.lit(True).alias("e"))
    o = items.select(*OUTPUT, "instance_id", F.lit(True).alias("o"))
    both = e.union(o.select(*OUTPUT, "instance_id", F.lit(False))).groupBy(*OUTPUT, "instance_id").agg(
        F.bool_or("e").alias("expected"), F.bool_or(~F.col("e")).alias("observed")
    )
    lost = F.collect_list(F.when(F.col("expected") & ~F.col("observed"), F.col("instance_id")))
    return both.groupBy(*OUTPUT).agg(
        F.count_if("expected").alias("n_expected"),
        F.count_if("observed").alias("n_observed"),
        F.array_sort(lost).alias("missing"),
    )


def frame_verdicts(
    expected: DataFrame,
    items: DataFrame,
    overlaps: DataFrame,
    *,
    max_overlap: float | Column = 0.20,
    include_review: bool = False,
    keep_conflicts: bool = False,
    images: DataFrame | None = None,
) -> DataFrame:
    """One verdict per output id with ordered reasons.

    expected  ``scene_id, output_id, frame_id, instance_id``
    items     ``scene_id, output_id, frame_id, instance_id, ord, status, has_label, label, has_mask``
    overlaps  ``scene_id, output_id, a, b, overlap`` of intersecting pairs
    images    ``scene_id, frame_id`` of existing source images (None = all exist)

    All arrays are per frame, bounded by the instances of one frame.
    """
    allowed = ["accepted", "review"] if include_review else ["accepted"]
    name = F.col("instance_id")
    bad = ~F.col("status").isin(allowed) | ~F.coalesce("has_label", F.lit(False)) | (F.coalesce("label", F.lit("")) == "")
    line = F.nullif(F.col("label"), F.lit(""))

    def in_order(value: Column) -> Column:
        picked = F.collect_list(F.when(value.isNotNull(), F.struct("ord", "instance_id", value.alias("v"))))
        return F.transform(F.array_sort(picked), lambda s: s["v"])

    observed = items.groupBy(*OUTPUT).agg(
        in_order(F.when(bad, F.concat(name, F.lit(":"), F.col("status")))).alias("status_reasons"),
        in_order(F.when(~F.col("has_mask"), F.concat(name, F.lit(":mask_missing")))).alias("mask_reasons"),
        in_order(line).alias("lines"),
        F.min(F.struct("ord", "instance_id", "frame_id")).alias("_first"),
        F.count(F.lit(1)).alias("instance_count"),
    )
    conflict = overlaps.where(F.col("overlap") > max_overlap).groupBy(*OUTPUT).agg(F.count(F.lit(1)).alias("conflicts"))
    wanted = expected.groupBy(*OUTPUT).agg(F.min("frame_id").alias("_expected_frame"))
    base = expected_observed(expected, items)
    joined = (
        base.join(observed, list(OUTPUT), "left").join(conflict, list(OUTPUT), "left").join(wanted, list(OUTPUT), "left")
    )
    source = F.coalesce("_first.frame_id", "_expected_frame")
    joined = joined.withColumn("source_frame", source)
    if images is None:
        joined = joined.withColumn("_image", F.col("source_frame").isNotNull())
    else:
        present = images.select("scene_id", F.col("frame_id").alias("source_frame"), F.lit(True).alias("_image")).distinct()
        joined = joined.join(present, ["scene_id", "source_frame"], "left")
    none = F.array().cast(EMPTY)

    def one(condition: Column, reason: str) -> Column:
        return F.when(condition, F.array(F.lit(reason))).otherwise(none)

    overlapping = F.lit(False) if keep_conflicts else F.coalesce(F.col("conflicts") > 0, F.lit(False))
    reasons = F.concat(
        F.transform("missing", lambda i: F.concat(i, F.lit(":record_missing"))),
        F.coalesce("status_reasons", none),
        F.coalesce("mask_reasons", none),
        one(overlapping, "instance_mask_overlap"),
        one(F.col("source_frame").isNull(), "source_frame_unknown"),
        one(~F.coalesce("_image", F.lit(False)), "source_image_missing"),
    )
    lines = F.coalesce("lines", none)
    has_line = F.size(lines) > 0
    return joined.select(
        *OUTPUT,
        "source_frame",
        reasons.alias("reasons"),
        F.when((F.size(reasons) == 0) & has_line, "accepted").when(has_line, "review").otherwise("rejected").alias("status"),
        F.when(has_line, F.array_join(lines, "\n")).alias("label_text"),
        F.coalesce("instance_count", F.lit(0)).cast("long").alias("instance_count"),
        F.coalesce("conflicts", F.lit(0)).cast("long").alias("conflicts"),
        "n_expected",
        "n_observed",
    )


def project_summary(verdicts: DataFrame, keys=("scene_id",)) -> DataFrame:
    """Frame status counts per report."""
    return verdicts.groupBy(*keys).agg(*[F.count_if(F.col("status") == s).alias(s) for s in STATUSES])


def instance_violations(instances: DataFrame) -> DataFrame:
    """Manifest checks: duplicate instance names, class ids with two names, unknown origins."""
    named = instances.withColumn("_safe", safe_name(F.col("instance_id")))
    duplicate = named.groupBy("scene_id", "_safe").count().where("count > 1").select(
        F.lit("duplicate_instance").alias("rule"), F.concat_ws("/", "scene_id", "_safe").alias("key")
    )
    conflict = (
        instances.groupBy("scene_id", "class_id")
        .agg(F.min("class_name").alias("lo"), F.max("class_name").alias("hi"))
        .where("lo <> hi")
        .select(F.lit("class_name_conflict").alias("rule"), F.concat_ws("/", "scene_id", F.col("class_id").cast("string")).alias("key"))
    )
    tracker = F.coalesce("tracker", F.lit("foundationpose"))
    unknown = named.where(~tracker.isin("foundationpose", "mask_sequence", "sam2")).select(
        F.lit("unknown_tracker").alias("rule"), F.concat_ws("/", "scene_id", "_safe").alias("key")
    )
    return duplicate.unionByName(conflict).unionByName(unknown)


def class_split_table(accepted: DataFrame, class_names: list[str]) -> DataFrame:
    """Accepted counts per split and class with a total row and a total column."""
    counts = [F.count_if(F.col("class_name") == c).alias(c) for c in class_names]
    table = accepted.rollup("split").agg(*counts, F.count_if(F.col("class_name").isin(class_names)).alias("total"))
    return table.withColumn("split", F.coalesce("split", F.lit("total")))
