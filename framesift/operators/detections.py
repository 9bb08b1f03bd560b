"""Teacher detections: routing, proposals, promotion, and mapping checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..constants import TEACHER_DETECTORS, TEACHER_HARD_NEGATIVES, TEACHER_MAPPING
from ..functions.text import proposal_id


def teacher_tables(spark):
    """Mapping, hard negatives, detectors and detector scopes as tables."""
    mapping = spark.createDataFrame(list(TEACHER_MAPPING.items()), "source_class string, official_class string")
    negatives = spark.createDataFrame([(n,) for n in TEACHER_HARD_NEGATIVES], "source_class string")
    detectors = spark.createDataFrame([(n, p, bool(a)) for n, p, a in TEACHER_DETECTORS], "detector string, proposal_source boolean, scoped boolean")
    scopes = spark.createDataFrame([(n, c) for n, _, a in TEACHER_DETECTORS for c in a], "detector string, official_class string")
    return mapping, negatives, detectors, scopes


def route(detections: DataFrame, mapping: DataFrame, negatives: DataFrame, detectors: DataFrame, scopes: DataFrame, missing: DataFrame) -> DataFrame:
    """Adds ``official_class, kind, classification, candidate_instance_ids`` to detections.

    detections  ``scene_id, segment_id, frame_id, detector, source_class, ...``
    missing     ``scene_id, segment_id, class_name, instance_ids ARRAY``
    Rules in order: hard negative, unmapped, outside the detector's scope, cross-check only,
    nothing missing, proposal.
    """
    rows = (
        detections.join(negatives.select("source_class", F.lit(True).alias("_neg")).distinct(), "source_class", "left")
        .join(mapping, "source_class", "left")
        .join(detectors, "detector", "left")
        .join(scopes.select("detector", "official_class", F.lit(True).alias("_in")), ["detector", "official_class"], "left")
        .join(
            missing.select("scene_id", "segment_id", F.col("class_name").alias("official_class"), F.col("instance_ids").alias("_ids")),
            ["scene_id", "segment_id", "official_class"],
            "left",
        )
    )
    negative = F.col("_neg").isNotNull()
    reason = (
        F.when(F.col("official_class").isNull(), "unmapped_source_class")
        .when(F.coalesce("scoped", F.lit(False)) & F.col("_in").isNull(), "detector_scope_mismatch")
        .when(~F.coalesce("proposal_source", F.lit(False)), "crosscheck_only")
        .when(F.coalesce(F.size("_ids"), F.lit(0)) <= 0, "no_missing_manifest_instance")
    )
    kind = F.when(negative, "hard_negative").when(reason.isNotNull(), "crosscheck").otherwise("proposal")
    return rows.withColumns(
        {
            "official_class": F.when(~negative, F.col("official_class")),
            "kind": kind,
            "classification": F.when(~negative, reason),
            "candidate_instance_ids": F.when(kind == "proposal", F.col("_ids")),
        }
    ).drop("_neg", "_in", "_ids", "scoped", "proposal_source")


def at_segment_starts(detections: DataFrame, segments: DataFrame) -> DataFrame:
    """Detections on the first frame of a segment, with the segment number."""
    starts = segments.select("scene_id", "segment_id", F.col("start_id").alias("frame_id"))
    return detections.join(starts, ["scene_id", "frame_id"])


def proposals(routed: DataFrame) -> DataFrame:
    """Proposal rows with their ids; ``det_index`` numbers the detections of a frame and detector."""
    return routed.where("kind = 'proposal'").withColumn(
        "proposal_id", proposal_id(F.col("frame_id"), F.col("official_class"), F.col("detector"), F.col("det_index"))
    )


def kind_counts(routed: DataFrame) -> DataFrame:
    return routed.groupBy("kind").agg(F.count(F.lit(1)).alias("detections"))


def refuse_val(manifests: DataFrame) -> DataFrame:
    """Validation manifests keep independent truth and get no teacher proposals."""
    return manifests.where(F.coalesce("split", F.lit("train")) == "val").select(
        F.lit("val_refuses_proposals").alias("rule"), F.col("scene_id").alias("key")
    )


def mapping_violations(mapping: DataFrame, negatives: DataFrame, scopes: DataFrame, official: DataFrame) -> DataFrame:
    """Targets and scopes must be official classes; a source class is mapped or negative, not both."""
    names = official.select(F.col("class_name").alias("official_class"))
    return (
        mapping.join(names, "official_class", "left_anti").select(F.lit("unknown_target").alias("rule"), F.col("official_class").alias("key"))
        .unionByName(
            mapping.select("source_class").intersect(negatives.select("source_class")).select(
                F.lit("mapped_and_negative").alias("rule"), F.col("source_class").alias("key")
            )
        )
        .unionByName(
            scopes.join(names, "official_class", "left_anti").select(
                F.lit("unknown_scope_class").alias("rule"), F.concat_ws(":", "detector", "official_class").alias("key")
            )
        )
        .distinct()
    )


def promotion_check(requests: DataFrame, proposed: DataFrame, instances: DataFrame, key_masks: DataFrame) -> DataFrame:
    """One rejection code (null = fine) per request to turn a proposal into a key mask.

    requests   ``proposal_id, scene_id, instance_id``
    proposed   ``proposal_id, frame_id, official_class, candidate_instance_ids, mask_area``
    instances  ``scene_id, instance_id, class_name, key_mask_dir``
    key_masks  ``scene_id, instance_id, frame_id``
    """
    rows = requests.join(proposed, "proposal_id", "left").join(instances, ["scene_id", "instance_id"], "left")
    taken = key_masks.select("scene_id", "instance_id", "frame_id", F.lit(True).alias("_taken")).distinct()
    rows = rows.join(taken, ["scene_id", "instance_id", "frame_id"], "left")
    code = (
        F.when(F.col("official_class").isNull(), "unknown_proposal")
        .when(F.col("class_name").isNull(), "unknown_instance")
        .when(F.col("class_name") != F.col("official_class"), "class_mismatch")
        .when(~F.coalesce(F.array_contains("candidate_instance_ids", F.col("instance_id")), F.lit(False)), "not_a_candidate")
        .when(F.col("key_mask_dir").isNull(), "no_key_mask_dir")
        .when(F.col("_taken"), "key_mask_exists")
        .when(F.coalesce("mask_area", F.lit(0)) <= 0, "empty_candidate_mask")
    )
    return rows.select("proposal_id", "scene_id", "instance_id", code.alias("rejection"))
