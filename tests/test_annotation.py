"""Seven synthetic frames with known verdicts, then overrides and a missing record."""

import pytest
from pyspark.sql import functions as F

from framesift import schemas
from framesift.constants import MASK_SEQUENCE_THRESHOLDS
from framesift.operators import annotate, quality, review

W, H = 160, 120
RECTANGLES = {
    "a": [(20, 30, 50, 60), (20, 30, 50, 60), (4, 8, 115, 95), None, (0, 30, 30, 60), (20, 30, 50, 60), (20, 30, 50, 60)],
    "b": [(52, 30, 82, 60), (48, 30, 78, 60)] + [(52, 30, 82, 60)] * 5,
}


@pytest.fixture(scope="module")
def scene(spark):
    runs, files = [], []
    for name, boxes in RECTANGLES.items():
        for n, box in enumerate(boxes):
            if box is None:
                continue
            x1, y1, x2, y2 = box
            files.append(("s", f"{n:06d}", name))
            runs += [("s", f"{n:06d}", name, y, x1, x2 + 1) for y in range(y1, y2 + 1)]
    depth = []
    for n in range(7):
        for y in range(H):
            line = [1000] * W
            if n == 5 and 30 <= y <= 60:
                line[20:51] = [0] * 31
            depth.append(("s", f"{n:06d}", y, line))
    return {
        "frames": spark.createDataFrame([("s", f"{n:06d}", n, W, H) for n in range(7)], "scene_id string, frame_id string, frame_index long, width int, height int"),
        "instances": spark.createDataFrame([("s", "a", 0, 0, 0, 0), ("s", "b", 1, 1, 0, 0)], "scene_id string, instance_id string, ord int, class_id int, start int, max_frames int"),
        "files": spark.createDataFrame(files, "scene_id string, frame_id string, instance_id string"),
        "runs": spark.createDataFrame(runs, schemas.MASK_RUNS),
        "depth": spark.createDataFrame(depth, schemas.DEPTH_ROWS),
    }


@pytest.fixture(scope="module")
def records(scene):
    return annotate.score_masks(scene["frames"], scene["instances"], scene["files"], scene["runs"], scene["depth"]).cache()


def _status(df, name):
    return {r.frame_id: r for r in df.where(F.col("instance_id") == name).collect()}


def test_grades(records):
    a = _status(records, "a")
    assert [a[f"{n:06d}"].status for n in range(7)] == ["accepted", "accepted", "rejected", "rejected", "review", "rejected", "accepted"]
    assert "mask_area_jump" in a["000002"].reject_reasons
    assert a["000003"].reject_reasons == ["mask_file_missing"]
    assert "touches_image_border" in a["000004"].review_reasons
    assert "depth_coverage_too_low" in a["000005"].reject_reasons
    assert a["000000"].mask_area == 31 * 31 and a["000000"].connected_components == 1
    counts = quality.status_counts(records.where("instance_id = 'a'"), ["instance_id"]).first()
    assert (counts.accepted, counts.review, counts.rejected) == (3, 1, 3)


def test_verdicts(scene, records):
    found = annotate.aggregate_frames(scene["frames"], scene["instances"], records, scene["runs"], max_overlap=0.05)
    by_id = {r.output_id: r for r in found.collect()}
    assert [by_id[f"s_{n:06d}"].status for n in range(7)] == ["accepted"] + ["review"] * 5 + ["accepted"]
    assert by_id["s_000001"].reasons == ["instance_mask_overlap"]
    assert len(by_id["s_000000"].label_text.split("\n")) == 2
    lost = annotate.aggregate_frames(
        scene["frames"], scene["instances"], records.where("not (instance_id = 'b' and frame_id = '000006')"), scene["runs"], max_overlap=0.05
    )
    row = lost.where("output_id = 's_000006'").first()
    assert (row.status, row.reasons) == ("review", ["b:record_missing"])


def test_overrides(spark, records):
    log = spark.createDataFrame(
        [
            ("s", "a", "000004", "rejected", None, "2026-01-01"),
            ("s", "a", "000004", "accepted", None, "2026-01-02"),
            ("s", "a", "000006", "rejected", "blurred", "2026-01-01"),
            ("s", "a", "000003", "accepted", None, "2026-01-01"),
            ("s", "a", "000000", "perhaps", None, "2026-01-01"),
        ],
        schemas.OVERRIDES,
    )
    done = _status(review.apply_overrides(records, review.latest_overrides(log)), "a")
    assert (done["000004"].status, done["000004"].auto_status, done["000004"].manual_reason) == ("accepted", "review", "manual_accepted")
    assert (done["000006"].status, done["000006"].reject_reasons) == ("rejected", ["blurred"])
    assert (done["000003"].status, done["000003"].reject_reasons) == ("rejected", ["manual_accept_blocked_invalid_mask"])
    assert done["000000"].manual_status is None
    labels = review.eligible(review.apply_overrides(records, review.latest_overrides(log)).where("instance_id = 'a'"), False)
    assert {r.frame_id for r in labels.collect()} == {"000000", "000001", "000004"}


def test_long_sequence_equals_loop(spark):
    """Chain over several blocks, with poses and a registration that forgets what came before."""
    import math
    import random

    rng = random.Random(11)
    rows = []
    for n in range(9000):
        angle = rng.choice([0.0, 0.3, 1.2])
        pose = [math.cos(angle), -math.sin(angle), 0.0, rng.choice([0.0, 0.1, 0.5]), math.sin(angle), math.cos(angle), 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0]
        rows.append(("s", "a", n, rng.choice([100, 150, 400, 900, 20]), 50.0 + rng.randint(0, 60), 50.0, W, H, n % 2500 == 0, rng.random() > 0.05, pose))
    df = spark.createDataFrame(
        rows,
        "scene_id string, instance_id string, frame_index long, mask_area long, cx double, cy double, width int, height int, registration boolean, has_mask boolean, pose array<double>",
    )
    limits = {**MASK_SEQUENCE_THRESHOLDS, "max_translation_jump_m": 0.2, "max_rotation_jump_deg": 55.0}
    graded = quality.grade_sequence(df, quality.resolve_thresholds(defaults=limits), reset_at_registration=True)
    got = {r.frame_index: r.status for r in graded.select("frame_index", "status").collect()}
    ref = None
    for _, _, n, area, cx, cy, w, h, reg, has, pose in rows:
        if reg:
            ref = None
        bad = not has or area < 80
        soft = False
        if not bad and ref is not None:
            ratio, shift = area / ref[0], abs(cx - ref[1]) / math.hypot(w, h)
            step = math.dist([pose[3], pose[7], pose[11]], [ref[2][3], ref[2][7], ref[2][11]])
            trace = sum(pose[i * 4 + j] * ref[2][i * 4 + j] for i in range(3) for j in range(3))
            turn = math.degrees(math.acos(max(-1, min(1, (trace - 1) / 2))))
            if not reg:
                bad = ratio < 0.35 or ratio > 2.8 or shift > 0.40 or step > 0.2 or turn > 55
                soft = shift > 0.22 or step > 0.12 or turn > 35
        status = "rejected" if bad else "review" if soft else "accepted"
        assert got[n] == status, n
        if not bad:
            ref = (area, cx, pose)
