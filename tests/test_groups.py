"""Capture groups and the whole-group split against a direct reading of the rules."""

import random

import pytest

from framesift.operators import groups as g

SCHEMA = "report_path string, scene string, split string, capture_session_id string, source_video_id string, class_names array<string>, accepted long"


def _reports(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _scene(name, frames, cls="can", split="train", session=None, video=None):
    return (f"/r/{name}_train_report.json", f"/data/scenes/{cls}/{name}", split, session or f"session_{name}", video or f"{name}_clip", [cls], frames)


def _chosen(spark, rows, ratio=0.2):
    reports = _reports(spark, rows)
    groups = g.capture_groups(reports)
    plan = g.auto_split(reports, groups, ratio)
    return sorted(r.group_key for r in plan.chosen.collect()), plan


def test_shared_session_is_one_group(spark):
    rows = [_scene("a_1", 5, session="s"), _scene("b_2", 6, session="s"), _scene("c_3", 7), ("/r/x", "/data/x", "train", None, None, [], 0)]
    reports = _reports(spark, rows)
    groups = {r.report_path: r.group_key for r in g.capture_groups(reports).collect()}
    assert groups[rows[0][0]] == groups[rows[1][0]] == "scene:/data/scenes/can/b_2"
    assert len(set(groups.values())) == 3
    summary = {r.group_key: r for r in g.group_summary(reports, g.capture_groups(reports)).collect()}
    both = summary["scene:/data/scenes/can/b_2"]
    assert (both.scenes, both.sessions, both.videos, both.accepted, both.newest_scene) == (2, 1, 2, 11, "b_2")


def test_small_scenes(spark):
    rows = [_scene(f"can_20260901_{t}_01", n) for t, n in (("0800", 8), ("0900", 7), ("1000", 5))]
    chosen, plan = _chosen(spark, rows)
    assert chosen == ["scene:/data/scenes/can/can_20260901_1000_01"]
    assert (plan.selected_frames, plan.total_frames) == (5, 20)


def test_nearest_to_ratio(spark):
    rows = [_scene(f"can_20260901_{t}_01", n) for t, n in (("0800", 54), ("0900", 56), ("1000", 82), ("1100", 259))]
    assert _chosen(spark, rows)[0] == ["scene:/data/scenes/can/can_20260901_1000_01"]


def test_single_scene_is_refused(spark):
    with pytest.raises(ValueError, match="at least two"):
        _chosen(spark, [_scene("can_1", 9)])


def test_existing_validation_gives_empty_plan(spark):
    rows = [_scene("can_1", 9), _scene("can_2", 9, split="val")]
    chosen, plan = _chosen(spark, rows)
    assert chosen == [] and plan.existing_val_classes == ["can"]


@pytest.mark.parametrize("seed", range(4))
def test_split_keeps_its_promises(spark, seed):
    rng = random.Random(seed)
    classes = ["can", "box", "bag", "bin"][: rng.randint(2, 4)]
    rows = []
    for n in range(rng.randint(12, 30)):
        row = list(_scene(f"s_{rng.randint(0, 99):02d}_{n:02d}", rng.choice([0, 1, 2, 3, 5, 8, 40]), "x"))
        row[5] = sorted(rng.sample(classes, rng.choice([1, 1, 1, 2])))
        rows.append(tuple(row))
    ratio = rng.choice([0.2, 0.35, 0.5])
    names, plan = _chosen(spark, rows, ratio)
    frames = {f"scene:{r[1]}": r[6] for r in rows if r[6] > 0}
    holders = {c: {f"scene:{r[1]}" for r in rows if r[6] > 0 and c in r[5]} for c in classes}
    taken, total = set(names), sum(frames.values())
    assert taken <= frames.keys() and (plan.selected_frames, plan.total_frames) == (sum(frames[k] for k in taken), total)
    # every class that can spare a group is seen in validation
    assert all(holders[c] & taken for c in classes if len(holders[c]) >= 2)
    # no group that its classes could spare would still bring the share closer
    gap = abs(plan.selected_frames / total - ratio)
    for key in frames.keys() - taken:
        spared = all(len(holders[c] - taken) > 1 for c in classes if key in holders[c])
        assert not spared or abs((plan.selected_frames + frames[key]) / total - ratio) >= gap


def test_newest_groups_fill_up_first(spark):
    # 100 frames, a fifth wanted: the class gives the group of 20 of the middle day and nothing more fits
    rows = [_scene(f"can_2026090{d}_0800_01", n) for d, n in ((1, 30), (2, 20), (3, 30), (4, 20))]
    assert _chosen(spark, rows)[0] == ["scene:/data/scenes/can/can_20260904_0800_01"]
    # a half wanted: 40 is nearest to 50, then the newest of the two groups of 10 is taken, and the other not
    rows = [_scene(f"can_2026090{d}_0800_01", n) for d, n in ((1, 40), (2, 10), (3, 10), (4, 40))]
    assert _chosen(spark, rows, 0.5)[0] == ["scene:/data/scenes/can/can_20260903_0800_01", "scene:/data/scenes/can/can_20260904_0800_01"]


def test_last_train_group_of_a_class_stays(spark):
    rows = [_scene("a_20260901_0800_01", 10), _scene("a_20260902_0800_01", 10), _scene("a_20260903_0800_01", 10)]
    names, plan = _chosen(spark, rows, 0.9)
    assert len(names) == 2 and plan.selected_frames == 20


def test_scene_named_in_two_ways_is_one_group(spark):
    rows = [list(_scene("can_1", 5)), list(_scene("can_1", 6))]
    rows[1][0], rows[1][1] = "other_report.json", "/data/scenes/x/../can/./can_1"
    assert g.capture_groups(_reports(spark, [tuple(r) for r in rows])).select("group_key").distinct().count() == 1


def test_assignment_moves_whole_groups(spark):
    rows = [_scene("a_1", 5, session="s"), _scene("b_2", 6, session="s"), _scene("c_3", 7)]
    reports = _reports(spark, rows)
    groups = g.capture_groups(reports)
    chosen = g.select_groups(g.group_members(reports, groups), ["a_1"], [])
    moved = {r.report_path: r.split for r in g.assign_split(reports, groups, chosen).collect()}
    assert sorted(moved.values()) == ["train", "val", "val"]
    assert g.mixed_group_violations(g.group_summary(reports, groups), chosen).count() == 0
