"""Scene inventory, workflow state and project views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import BIN_CLASSES, DEFAULT_ROSTER_CLASSES
from ..functions.text import two_digits


def scene_integrity(rgb: DataFrame, depth: DataFrame, recorded: DataFrame, scenes: DataFrame) -> DataFrame:
    """Frame counts, orphans and safety of a repair, per scene.

    rgb / depth / recorded  ``scene_id, frame_id``
    scenes  ``scene_id, metadata_error`` (null error = metadata readable or not needed)
    """
    on = ["scene_id", "frame_id"]
    tagged = (
        rgb.select(*on, F.lit(1).alias("bit"))
        .unionByName(depth.select(*on, F.lit(2).alias("bit")))
        .unionByName(recorded.select(*on, F.lit(4).alias("bit")))
    )
    frames = tagged.groupBy(*on).agg(F.bit_or("bit").alias("b"))
    has = lambda bit: F.col("b").bitwiseAND(bit) > 0
    orphan = has(1) != has(2)
    counted = frames.groupBy("scene_id").agg(
        F.count_if(has(1)).alias("rgb_count"),
        F.count_if(has(2)).alias("depth_count"),
        F.count_if(has(1) & has(2)).alias("paired_count"),
        F.count_if(has(1) & ~has(2)).alias("orphan_rgb"),
        F.count_if(has(2) & ~has(1)).alias("orphan_depth"),
        F.count_if(orphan & ~has(4)).alias("_loose"),
        F.count_if(has(4) & ~has(1)).alias("recorded_without_rgb"),
        F.count_if(has(4) & ~has(2)).alias("recorded_without_depth"),
        F.count_if(has(4)).alias("recorded"),
    )
    numbers = [c for c in counted.columns if c != "scene_id"]
    joined = scenes.join(counted, "scene_id", "left").fillna(0, numbers)
    fine = F.col("metadata_error").isNull()
    orphans = F.col("orphan_rgb") + F.col("orphan_depth")
    unsafe = F.col("recorded_without_rgb") + F.col("recorded_without_depth")
    safe = F.when(fine, F.col("_loose")).otherwise(0)
    return joined.select(
        "scene_id", *[c for c in numbers if c != "_loose"],
        safe.cast("long").alias("safe_orphans"),
        unsafe.alias("unsafe_missing"),
        ((orphans == 0) & (unsafe == 0)).alias("is_complete"),
        ((orphans > 0) & (safe == orphans) & (unsafe == 0) & fine).alias("can_auto_repair"),
        "metadata_error",
    )


def unsafe_recorded(rgb: DataFrame, depth: DataFrame, recorded: DataFrame) -> DataFrame:
    """``scene_id, item`` with item ``frame:stream`` for recorded frames that lack a file."""
    on = ["scene_id", "frame_id"]
    listed = recorded.select(*on).distinct()
    parts = [
        listed.join(files.select(*on), on, "left_anti").select("scene_id", F.concat("frame_id", F.lit(f":{name}")).alias("item"))
        for name, files in (("rgb", rgb), ("depth", depth))
    ]
    return parts[0].unionByName(parts[1])


def discardable_sessions(sessions: DataFrame, rgb: DataFrame, depth: DataFrame) -> DataFrame:
    """Captures without a frame in either stream."""
    return sessions.join(rgb.select("scene_id"), "scene_id", "left_anti").join(depth.select("scene_id"), "scene_id", "left_anti")


def preferred_manifest(scenes: DataFrame, manifests: DataFrame) -> DataFrame:
    """First manifest of a scene in the order train, val, test; its declared split wins."""
    rank = F.array_position(F.array(F.lit("train"), F.lit("val"), F.lit("test")), F.col("file_split"))
    best = (
        manifests.where(rank > 0)
        .groupBy("scene_id")
        .agg(F.min(F.struct(rank.alias("r"), "manifest_path", F.coalesce("split", "file_split").alias("s"))).alias("m"))
    )
    return scenes.join(best, "scene_id", "left").select(
        *scenes.columns, F.col("m.manifest_path").alias("manifest_path"), F.coalesce("m.s", F.lit("train")).alias("split")
    )


def preferred_report(scenes: DataFrame, reports: DataFrame) -> DataFrame:
    """Export report of a scene: the one of the scene's split, else train, val, test.

    scenes ``scene_id, split``; reports ``scene_id, file_split, report_path, version, accepted, review, rejected``
    """
    rank = F.array_position(F.array(F.lit("train"), F.lit("val"), F.lit("test")), F.col("file_split"))
    joined = scenes.select("scene_id", "split").join(reports.where(rank > 0), "scene_id")
    choice = F.struct(
        F.when(F.col("file_split") == F.col("split"), 0).otherwise(rank).alias("r"), "report_path", "version", "accepted", "review", "rejected"
    )
    best = joined.groupBy("scene_id").agg(F.min(choice).alias("e"))
    return scenes.join(best, "scene_id", "left").select(
        *scenes.columns, *[F.col(f"e.{c}").alias(c) for c in ("report_path", "version", "accepted", "review", "rejected")]
    )


def review_marker_state(scenes: DataFrame, markers: DataFrame) -> DataFrame:
    """State of the "review complete" marker against the current export.

    scenes ``scene_id, class_name, report_path, version``;
    markers ``scene_id, m_scene, m_class, m_report, m_version`` (nulls = unreadable field)
    """
    joined = scenes.join(markers.withColumn("_has", F.lit(True)), "scene_id", "left")
    state = (
        F.when(F.col("_has").isNull(), "marker_missing")
        .when(~F.col("m_scene").eqNullSafe(F.col("scene_id")) | ~F.col("m_class").eqNullSafe(F.col("class_name")), "marker_invalid")
        .when(F.col("report_path").isNull(), "export_report_missing")
        .when(F.col("m_report").isNull() | F.col("m_version").isNull(), "marker_invalid")
        .when((F.col("m_report") != F.col("report_path")) | (F.col("m_version") != F.col("version")), "export_report_changed")
        .otherwise("valid")
    )
    return joined.withColumn("review_state", state).drop("_has", "m_scene", "m_class", "m_report", "m_version")


def scene_state(scenes: DataFrame) -> DataFrame:
    """Workflow group, code and colour of a scene.

    scenes  ``paired_count, is_complete, manifest_path, has_segments, masks_done, masks_total,
            report_path, accepted, review, rejected, review_state``
    The first rule that holds decides.
    """
    exported = F.col("report_path").isNotNull()
    accepted = F.coalesce("accepted", F.lit(0))
    pending = (F.coalesce("review", F.lit(0)) > 0) | (F.coalesce("rejected", F.lit(0)) > 0)
    complete = (F.col("masks_total") > 0) & (F.col("masks_done") == F.col("masks_total"))
    code = (
        F.when((F.col("paired_count") <= 0) | ~F.col("is_complete"), "rgbd_incomplete")
        .when(F.col("manifest_path").isNull(), "manifest_missing")
        .when(~F.col("has_segments"), "segments_missing")
        .when(~complete, "masks_missing")
        .when(~exported, "pending_export")
        .when(accepted <= 0, "export_failed")
        .when(pending, "export_needs_review")
        .otherwise("dataset_ready")
    )
    with_code = scenes.withColumn("code", code)
    manual = F.col("code").isin("rgbd_incomplete", "manifest_missing", "segments_missing", "masks_missing")
    reviewed = F.col("code").isin("export_failed", "export_needs_review", "dataset_ready") & (F.col("review_state") == "valid")
    color = (
        F.when(manual, "gray")
        .when(F.col("code") == "pending_export", "blue")
        .when(F.col("code") == "export_failed", "red")
        .when(F.col("code") == "export_needs_review", "yellow")
        .otherwise("green")
    )
    return with_code.withColumns(
        {
            "group": F.when(manual, "needs_manual").when(reviewed, "human_reviewed").otherwise("keyframes_complete"),
            "color": color,
        }
    )


def next_action(scenes: DataFrame) -> DataFrame:
    """Next step of a scene: segment, mask or run; a scene without manifest is an error."""
    action = (
        F.when(F.col("manifest_path").isNull(), "manifest_missing")
        .when(~F.col("has_segments"), "segment")
        .when(~((F.col("masks_total") > 0) & (F.col("masks_done") == F.col("masks_total"))), "mask")
        .otherwise("run")
    )
    return scenes.withColumn("next_action", action)


def class_workflow(states: DataFrame) -> DataFrame:
    """Scene and frame counts per class."""
    n = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return states.groupBy("class_name").agg(
        F.count(F.lit(1)).alias("scenes"),
        n("paired_count").alias("paired_frames"),
        (n("accepted") + n("review") + n("rejected")).alias("processed_frames"),
        n("accepted").alias("accepted"),
        n("review").alias("review"),
        n("rejected").alias("rejected"),
        F.count_if(F.col("code") == "pending_export").alias("pending_propagation"),
        F.count_if(F.col("group") == "needs_manual").alias("needs_manual"),
    )


def training_readiness(states: DataFrame) -> DataFrame:
    """Usable, manual and pending scenes and accepted frames over all scenes (one row)."""
    return states.agg(
        F.count_if(F.coalesce("accepted", F.lit(0)) > 0).alias("usable_scenes"),
        F.count_if(F.col("group") == "needs_manual").alias("manual_scenes"),
        F.count_if(F.col("code") == "pending_export").alias("pending_scenes"),
        F.coalesce(F.sum("accepted"), F.lit(0)).cast("long").alias("accepted_frames"),
    )


def expected_split_frames(reports: DataFrame) -> DataFrame:
    """Accepted frames per proposed split."""
    return reports.groupBy("split").agg(F.sum("accepted").cast("long").alias("frames"))


def state_listing(states: DataFrame) -> DataFrame:
    """Scenes by state group, newest name first inside a group."""
    groups = ["needs_manual", "keyframes_complete", "human_reviewed"]
    rank = F.array_position(F.array(*[F.lit(g) for g in groups]), F.col("group"))
    return states.withColumn("group_rank", rank.cast("int")).orderBy("group_rank", F.col("scene_id").desc())


def independent_val(files: DataFrame, train_dir: str, val_dir: str) -> DataFrame:
    """One row: whether val is another directory than train and holds images."""
    inside = F.count_if((F.col("kind") == "image") & F.col("path").startswith(val_dir.rstrip("/") + "/"))
    return files.agg(inside.alias("val_images")).select(
        "val_images", (F.lit(train_dir.rstrip("/") != val_dir.rstrip("/")) & (F.col("val_images") > 0)).alias("independent")
    )


def file_kind_counts(files: DataFrame) -> DataFrame:
    return files.groupBy("kind").agg(F.count(F.lit(1)).alias("files"))


def next_sequence(names: DataFrame, pattern: str, keys: list[str]) -> DataFrame:
    """Next free number per key from names that match ``pattern`` (group 1 is the number)."""
    number = F.regexp_extract("name", pattern, 1).try_cast("long")
    return names.groupBy(*keys).agg((F.coalesce(F.max(number), F.lit(0)) + 1).alias("next_number"))


def manifests_of_scene(scenes: DataFrame, manifests: DataFrame) -> DataFrame:
    """Manifests that refer to a scene, by resolved scene path."""
    return scenes.select("scene").join(manifests.select("scene", "manifest_path"), "scene")


def checksum_violations(expected: DataFrame, files: DataFrame) -> DataFrame:
    """Expected digests against files: missing or different."""
    joined = expected.join(files.select("path", F.col("sha256").alias("found")), "path", "left")
    rule = F.when(F.col("found").isNull(), "file_missing").when(F.lower("found") != F.lower("sha256"), "digest_mismatch")
    return joined.select(rule.alias("rule"), F.col("path").alias("key")).where(F.col("rule").isNotNull())


def reviewable_instances(export: DataFrame, manifest: DataFrame) -> DataFrame:
    """Export instances that can be reviewed: propagated masks with stage and key-mask directory.

    export ``scene_id, instance_id, stage, tracker``; manifest ``scene_id, instance_id, tracker, key_mask_dir, registration_mask_dir``
    """
    m = manifest.select(
        "scene_id", "instance_id", F.col("tracker").alias("m_tracker"), F.coalesce("key_mask_dir", "registration_mask_dir").alias("key_dir")
    )
    joined = export.join(m, ["scene_id", "instance_id"], "left")
    tracker = F.coalesce("m_tracker", "tracker")
    return joined.where((tracker == "sam2") & (F.coalesce("stage", F.lit("")) != "") & F.col("key_dir").isNotNull()).select(
        "scene_id", "instance_id", "stage", "key_dir"
    )


def roster(scenes: DataFrame, classes: DataFrame, per_class: int, include_bins: bool = False, only_class: str | None = None, can_tracker: str = "sam2") -> DataFrame:
    """Instance list of new scenes: chosen classes times instances, named ``class_NN``."""
    if only_class:
        wanted = classes.where(F.col("class_name") == only_class).withColumn("_n", F.lit(per_class))
    else:
        core = F.col("class_id").isin(*DEFAULT_ROSTER_CLASSES)
        bins = F.col("class_id").isin(*BIN_CLASSES) if include_bins else F.lit(False)
        wanted = classes.where(core | bins).withColumn("_n", F.when(core, per_class).otherwise(1))
    named = wanted.select(
        "class_id",
        "class_name",
        F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_k"),
    ).select(
        "class_id",
        "class_name",
        F.concat("class_name", F.lit("_"), two_digits(F.col("_k"))).alias("instance_id"),
        F.when(F.col("class_id") == 0, can_tracker).otherwise("sam2").alias("tracker"),
    )
    # the roster is a short list by nature; its size is checked before it goes into the plan
    entries = named.orderBy("class_id", "instance_id").limit(10_001).collect()
    if len(entries) > 10_000:
        raise ValueError("class catalogue too large")
    listed = F.array(
        *[
            F.struct(
                F.lit(e["instance_id"]).alias("instance_id"),
                F.lit(e["class_id"]).alias("class_id"),
                F.lit(e["class_name"]).alias("class_name"),
                F.lit(e["tracker"]).alias("tracker"),
            )
            for e in entries
        ]
    )
    return scenes.select("scene_id", F.inline(listed))


def dataset_descriptor(files: DataFrame, allow_val_fallback: bool = False) -> DataFrame:
    """One row: directories of train, val and test (val falls back to train only when allowed)."""
    val = F.count_if((F.col("split") == "val") & (F.col("kind") == "image")) > 0
    test = F.count_if((F.col("split") == "test") & (F.col("kind") == "image")) > 0
    flags = files.agg(val.alias("val_has_images"), test.alias("test_has_images"))
    fallback = F.lit(allow_val_fallback)
    path_val = F.when(F.col("val_has_images") | ~fallback, "images/val").otherwise("images/train")
    path_test = F.when(F.col("test_has_images"), "images/test")
    return flags.select(
        F.lit("images/train").alias("train"),
        path_val.alias("val"),
        F.nullif(path_test, path_val).alias("test"),
        "val_has_images",
        "test_has_images",
    )


def snapshot_counts(files: DataFrame, scenes: DataFrame) -> DataFrame:
    """One row: scenes, key masks, reports, train and val pairs."""

    pairs = files.where(F.col("kind").isin("image", "label")).groupBy("split", "stem").agg(F.count_distinct("kind").alias("k")).where("k = 2")
    rows = (
        files.where(F.col("kind").isin("key_mask", "report")).select("kind")
        .unionByName(pairs.select(F.concat("split", F.lit("_pair")).alias("kind")))
        .unionByName(scenes.select(F.lit("scene").alias("kind")))
    )
    names = {"scene": "scenes", "key_mask": "key_masks", "report": "reports", "train_pair": "train_pairs", "val_pair": "val_pairs"}
    return rows.agg(*[F.count_if(F.col("kind") == k).alias(v) for k, v in names.items()])
