"""Golden cases of validation, review, scenes, metrics, class maps and detections."""

from pyspark.sql import functions as F

from framesift import schemas
from framesift.constants import OFFICIAL_CLASSES
from framesift.functions.geometry import fixed6
from framesift.operators import detections, inventory, metrics, quality, review, segments, validation

LABEL = "0 0.125 0.166667 0.5625 0.166667 0.5625 0.75 0.125 0.75"


def test_label_rules(spark):
    lines = [LABEL, "0 0.1 0.2", "x 0.1 0.1 0.4 0.1 0.4 0.5", "12 0.1 0.1 0.4 0.1 0.4 0.5", "0 0.1 0.1 nan 0.1 0.4 0.5", "0 0.1 0.1 0.2 0.2 0.3 0.3", "0 0.1 0.1 1.5 0.1 0.4 0.5", "0 0.1 0.1 0.2 0.2 0.3 1d", "0 0.1 0.1 1e999 0.1 0.4 0.5"]
    files = spark.createDataFrame([("train", "f", "\n \n".join(lines))], "split string, stem string, text string")
    checked = validation.checked_lines(validation.numbered_lines(files), list(range(9)))
    got = {r.line_no: (list(r.errors), r.counted) for r in checked.collect()}
    assert got == {
        1: ([], True), 2: (["bad_format"], False), 3: (["not_numeric"], False), 4: (["unknown_class"], True), 5: (["not_finite"], False),
        6: (["degenerate_polygon"], True), 7: (["out_of_range"], True), 8: (["not_numeric"], False), 9: (["not_finite"], False),
    }


def test_duplicates_across_splits(spark):
    files = spark.createDataFrame(
        [("train", "t1", 3, "x"), ("train", "t2", 3, "x"), ("val", "v1", 3, "x"), ("val", "v2", 3, "y"), ("train", "t3", 4, "z"), ("test", "e1", 3, "x")],
        "split string, path string, size long, sha256 string",
    )
    row = validation.cross_split_duplicates(files).first()
    assert (row.sha256, row.train_files, row.val_files, row.pairs) == ("x", 2, 1, 2)
    assert {r.path for r in validation.duplicate_members(files, validation.cross_split_duplicates(files)).collect()} == {"t1", "t2", "v1"}


def test_leakage_needs_train_and_val(spark):
    rows = [("a", "train", 3), ("a", "val", 1), ("b", "train", 3), ("b", "val", 0), ("c", "train", 1), ("c", "test", 1)]
    df = spark.createDataFrame([(s, p, n, None, "") for s, p, n in rows], "scene string, split string, accepted long, capture_session_id string, source_video_id string")
    assert [(r.kind, r.value) for r in validation.leakage(df).collect()] == [("scene", "a")]
    assert validation.missing_source_ids(df, "scene").count() == 5


def test_claims_and_scene_prefixes(spark):
    claims = spark.createDataFrame([("f1", "r1", "s"), ("f1", "r1", "s"), ("f2", "r1", "s"), ("f2", "r2", "s")], "output_id string, report_path string, scene string")
    assert [r.output_id for r in validation.claim_conflicts(claims).collect()] == ["f2"]
    scenes = spark.createDataFrame([("can_1",)], "scene string")
    accepted = spark.createDataFrame([("can_1", "can_1_000000"), ("can_1", "can_1_000001")], "scene string, output_id string")
    files = spark.createDataFrame([("can_1_000000",), ("can_1_000009",), ("can_10_000000",)], "stem string")
    got = {(r.rule, r.output_id) for r in validation.scene_output_differences(scenes, accepted, files, files).collect()}
    assert got == {("extra_output", "can_1_000009"), ("missing_output", "can_1_000001")}


def _review_frames(spark, changes=None):
    status = ["accepted"] * 3 + ["review"] * 5
    for n, s in (changes or {}).items():
        status[n] = s
    return spark.createDataFrame([("s", "a", str(n // 4), f"{n:06d}", status[n]) for n in range(8)], "scene_id string, instance_id string, segment_id string, frame_id string, effective_status string")


def _range(spark, frame, changes=None):
    asked = spark.createDataFrame([("s", "a", f"{frame:06d}")], "scene_id string, instance_id string, frame_id string")
    r = review.rerun_ranges(_review_frames(spark, changes), asked).first()
    return (r.start_frame, r.last_frame, r.end_before_frame, r.boundary_reason)


def test_rerun_ranges(spark):
    assert _range(spark, 1) == ("000001", "000001", "000002", "next_accepted")
    assert _range(spark, 1, {2: "rejected"}) == ("000001", "000003", "000004", "segment_end")
    assert _range(spark, 4, {5: "accepted"}) == ("000004", "000004", "000005", "next_accepted")
    assert _range(spark, 3) == ("000003", "000003", "000004", "segment_end")
    assert _range(spark, 6) == ("000006", "000007", None, "segment_end")


def test_reject_tail_and_range(spark):
    frames = _review_frames(spark)
    at = lambda n: spark.createDataFrame([("s", "a", f"{n:06d}")], "scene_id string, instance_id string, frame_id string")
    assert sorted(r.frame_id for r in review.reject_tail(frames, at(5), "segment").collect()) == ["000005", "000006", "000007"]
    assert review.reject_tail(frames, at(2), "scene").count() == 6
    marks = spark.createDataFrame([("s", "a", "000003", "000001")], "scene_id string, instance_id string, mark_a string, mark_b string")
    assert sorted(r.frame_id for r in review.reject_range(frames, marks).collect()) == ["000001", "000002", "000003"]
    masks = spark.createDataFrame([("s", "a", "000005", 9)], "scene_id string, instance_id string, frame_id string, mask_area long")
    decisions = spark.createDataFrame([("s", "a", "000005", "accepted"), ("s", "a", "000006", "accepted")], "scene_id string, instance_id string, frame_id string, status string")
    assert [r.frame_id for r in review.accept_violations(decisions, masks).collect()] == ["000006"]


def test_range_merge(spark):
    rows = [("0", 1, 3), ("0", 3, 5), ("1", 1, 2), ("1", 4, 9), ("2", 5, 6), ("3", 6, 7)]
    df = spark.createDataFrame([("s", "a", *r) for r in rows], "scene_id string, instance_id string, segment_id string, start_pos long, end_pos long")
    got = sorted((r.segment_id, r.start_pos, r.end_pos) for r in review.merge_ranges(df).collect())
    assert got == [("0", 1, 5), ("1", 1, 2), ("1", 4, 9), ("2", 5, 6), ("3", 6, 7)]
    again = review.merge_ranges(review.merge_ranges(df).drop("merged"))
    assert sorted((r.segment_id, r.start_pos, r.end_pos) for r in again.collect()) == got


def test_report_upsert(spark):
    schema = "scene_id string, instance_id string, frame_id string, status string, mode string"
    old = spark.createDataFrame([("s", "a", f"{n}", "rejected" if n == 2 else "accepted", "old") for n in range(4)], schema)
    new = spark.createDataFrame([("s", "a", "1", "accepted", "key_mask"), ("s", "a", "2", "accepted", "track"), ("s", "a", "3", "accepted", "ignored")], schema)
    replaced = spark.createDataFrame([("s", "a", "1"), ("s", "a", "2")], "scene_id string, instance_id string, frame_id string")
    merged, missing = review.upsert_report(old, new, replaced)
    assert {r.frame_id: r.mode for r in merged.collect()} == {"0": "old", "1": "key_mask", "2": "track", "3": "old"}
    assert missing.count() == 0
    counts = quality.status_counts(merged, ["scene_id"]).first()
    assert (counts.accepted, counts.rejected) == (4, 0)


def test_segment_boundaries(spark):
    rows = [("s", f"{n:06d}", n in (5, 12), n == 12) for n in range(20)]
    df = spark.createDataFrame(rows, "scene_id string, frame_id string, is_cut boolean, is_gap boolean")
    bounded = segments.boundaries(df, 7)
    got = {r.frame_id: list(r.boundary_reasons) for r in bounded.where("is_boundary").collect()}
    assert got == {"000000": ["sequence_start"], "000005": ["visual_scene_cut"], "000012": ["visual_scene_cut", "timestamp_gap", "max_segment_length"], "000019": ["max_segment_length"]}
    table = sorted((r.segment_id, r.start_index, r.end_index, r.frame_count) for r in segments.segments(bounded).collect())
    assert table == [(0, 0, 4, 5), (1, 5, 11, 7), (2, 12, 18, 7), (3, 19, 19, 1)]


def test_scene_integrity(spark):
    f = lambda rows: spark.createDataFrame(rows, "scene_id string, frame_id string")
    rgb = f([("ok", "0"), ("orphan", "0"), ("orphan", "1"), ("lost", "0")])
    depth = f([("ok", "0"), ("orphan", "0")])
    recorded = f([("ok", "0"), ("orphan", "0"), ("lost", "0")])
    scenes = spark.createDataFrame([("ok", None), ("orphan", None), ("lost", None), ("empty", None)], "scene_id string, metadata_error string")
    got = {r.scene_id: r for r in inventory.scene_integrity(rgb, depth, recorded, scenes).collect()}
    assert got["ok"].is_complete and not got["ok"].can_auto_repair
    assert (got["orphan"].safe_orphans, got["orphan"].can_auto_repair) == (1, True)
    assert (got["lost"].unsafe_missing, got["lost"].can_auto_repair) == (1, False)
    assert got["empty"].paired_count == 0
    assert [r.item for r in inventory.unsafe_recorded(rgb, depth, recorded).collect()] == ["0:depth"]


def test_scene_state_ladder(spark):
    base = dict(paired_count=2, is_complete=True, manifest_path="m", has_segments=True, masks_done=1, masks_total=1, report_path="r", accepted=1, review=0, rejected=0, review_state="marker_missing")
    cases = [
        ({"manifest_path": None}, ("needs_manual", "manifest_missing", "gray")),
        ({"has_segments": False}, ("needs_manual", "segments_missing", "gray")),
        ({"masks_done": 0}, ("needs_manual", "masks_missing", "gray")),
        ({"report_path": None}, ("keyframes_complete", "pending_export", "blue")),
        ({"accepted": 0, "rejected": 1}, ("keyframes_complete", "export_failed", "red")),
        ({"review": 1}, ("keyframes_complete", "export_needs_review", "yellow")),
        ({}, ("keyframes_complete", "dataset_ready", "green")),
        ({"review_state": "valid"}, ("human_reviewed", "dataset_ready", "green")),
        ({"review_state": "export_report_changed"}, ("keyframes_complete", "dataset_ready", "green")),
        ({"paired_count": 0}, ("needs_manual", "rgbd_incomplete", "gray")),
    ]
    rows = [(n, *{**base, **change}.values()) for n, (change, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, "n int, paired_count int, is_complete boolean, manifest_path string, has_segments boolean, masks_done int, masks_total int, report_path string, accepted int, review int, rejected int, review_state string")
    got = {r.n: (r.group, r.code, r.color) for r in inventory.scene_state(df).collect()}
    assert got == {n: want for n, (_, want) in enumerate(cases)}


def test_best_epochs(spark):
    df = spark.createDataFrame([("r", 1, 1, 0.80, 0.81, 0.92, 0.90, 0.40), ("r", 2, 2, 0.90, 0.91, 0.92, 0.85, 0.60), ("r", 3, 3, 0.1, 0.1, 0.1, 0.85, 0.60)], schemas.EPOCHS)
    r = metrics.best_epochs(df).first()
    assert (r.best_epoch, round(r.fitness, 9), r.mask_peak_epoch, r.mask_peak_map50_95) == (2, 1.45, 1, 0.90)
    text = spark.createDataFrame([("r", 0, "0", " 0.30"), ("r", 1, "1", "0.55"), ("r", 2, "2", "oops")], "run string, row_no int, epoch string, map50_95_m string")
    assert metrics.dashboard_epochs(text).first().best_epoch == 1
    bad = metrics.metric_violations(text.withColumn("x", F.lit("nan")), ["map50_95_m", "x"], ["run", "row_no"]).collect()
    assert sorted((r.metric, r.rule) for r in bad) == [("map50_95_m", "not_a_number")] + [("x", "not_finite")] * 3


def test_class_maps(spark):
    official = spark.createDataFrame(list(OFFICIAL_CLASSES.items()), "class_id int, class_name string")
    maps = {"seven": list(OFFICIAL_CLASSES.items())[:7], "wrong": [(0, "wrong_can")], "late": [(1, "watermelon_rind")], "all": list(OFFICIAL_CLASSES.items())}
    df = spark.createDataFrame([(k, i, n) for k, v in maps.items() for i, n in v], "map_id string, class_id int, class_name string")
    got = {r.map_id: r.compatible for r in metrics.prefix_compatibility(df, official).collect()}
    assert got == {"seven": True, "wrong": False, "late": False, "all": True}
    merged, conflicts = metrics.merge_class_maps(df)
    assert merged.count() == 9 and {r.map_id for r in conflicts.collect()} == {"wrong", "late"}


def test_detection_routing(spark):
    tables = detections.teacher_tables(spark)
    missing = spark.createDataFrame([("s", 0, "can", ["can_01", "can_02"])], "scene_id string, segment_id int, class_name string, instance_ids array<string>")
    names = [("robot_objects", "plastic_bottle"), ("robot_objects", "yellow_can"), ("unified_crosscheck", "yellow_can"), ("trash_bins", "yellow_can"), ("robot_objects", "mystery"), ("robot_objects", "red_paper_bag")]
    df = spark.createDataFrame([("s", 0, "000000", d, c, n) for n, (d, c) in enumerate(names)], "scene_id string, segment_id int, frame_id string, detector string, source_class string, n int")
    got = {r.n: (r.kind, r.classification, r.candidate_instance_ids) for r in detections.route(df, *tables, missing).collect()}
    assert got == {
        0: ("hard_negative", None, None), 1: ("proposal", None, ["can_01", "can_02"]), 2: ("crosscheck", "crosscheck_only", None),
        3: ("crosscheck", "detector_scope_mismatch", None), 4: ("crosscheck", "unmapped_source_class", None), 5: ("crosscheck", "no_missing_manifest_instance", None),
    }


def test_reject_streaks(spark):
    pattern = "AARRRRARRRARR"
    df = spark.createDataFrame([("s", n, "rejected" if c == "R" else "accepted") for n, c in enumerate(pattern)], "scene_id string, frame_index long, status string")
    assert [r.frame_index for r in quality.reject_streaks(df, 3, keys=["scene_id"]).orderBy("frame_index").collect()] == [4, 9]
    reset = quality.reject_streaks(df, 3, keys=["scene_id"], reset=F.col("frame_index") == 4)
    assert sorted(r.frame_index for r in reset.collect()) == [9]


def test_six_decimals_match_exact_rounding(spark):
    import random

    rng = random.Random(1)
    values = [k / 1280 for k in range(0, 1281)] + [k / 960 for k in range(0, 961)] + [rng.random() for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", fixed6(F.col("v")).alias("t"))
    assert all(r.t == f"{r.v:.6f}" for r in df.collect())
