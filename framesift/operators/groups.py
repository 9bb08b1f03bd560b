"""Grouping reports by shared origin and splitting whole groups into train and val.

reports  ``report_path, scene, split, capture_session_id, source_video_id,
         class_names ARRAY<STRING>, accepted BIGINT``
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import blank_to_null, scene_identity
from ..plans.blocks import index_block
from ..plans.components import component_numbers
from ..plans.ordered import ranked, scan
from ..session import cut

MAX_CLASSES = 10_000  # class catalogues are lists of names; more is refused


def resolved_scenes(reports: DataFrame, repository: str | None = None, project: str | None = None) -> DataFrame:
    """``reports`` with one spelling per scene, so that a scene named in two ways stays one scene."""
    return reports.withColumn("scene", scene_identity(F.col("scene"), repository, project))


def identifiers(reports: DataFrame) -> DataFrame:
    """One row per report and origin: scene, session and video; a scene is known by its resolved path."""
    kinds = [("scene", scene_identity(F.col("scene"))), ("session", F.col("capture_session_id")), ("video", F.col("source_video_id"))]
    names = F.array_compact(F.array(*[F.concat(F.lit(k + ":"), blank_to_null(c)) for k, c in kinds]))
    return reports.select("report_path", F.explode(names).alias("identifier"))


def capture_groups(reports: DataFrame) -> DataFrame:
    """``report_path, group_key``: reports linked by scene, session or video.

    The key names the scene of the last report of the group in path order, as it is spelled there.  Scenes are
    compared by their resolved paths; an old checkout counts as the present one after ``resolved_scenes``.
    """
    found = cut(component_numbers(identifiers(reports), "report_path", "identifier"))
    key = ["round", "number"]
    placed = found.join(reports.select("report_path", "scene"), "report_path")
    keys = placed.groupBy(*key).agg(F.max(F.struct("report_path", "scene")).alias("last"))
    named = keys.select(*key, F.concat(F.lit("scene:"), F.col("last.scene")).alias("group_key"))
    return found.join(named, key).select("report_path", "group_key")


def base_name(column: Column) -> Column:
    return F.element_at(F.split(column, "/"), -1)


def group_summary(reports: DataFrame, groups: DataFrame) -> DataFrame:
    """One row per group: counts of scenes, sessions and videos, accepted frames, classes, newest scene.

    Members are counted, not collected: a group may hold a large part of all reports.  The
    long form is ``group_members``.  ``class_names`` is bounded by the class catalogue.
    """
    columns = ("scene", "split", "capture_session_id", "source_video_id", "class_names", "accepted")
    joined = cut(reports.select("report_path", *columns).join(groups, "report_path").drop("report_path"))  # read three times
    members = _members(joined)
    counted = members.groupBy("group_key").agg(
        *[F.count_if(F.col("kind") == k).alias(f"{k}s") for k in ("scene", "session", "video")]
    )
    classes = (
        joined.select("group_key", F.explode("class_names").alias("c")).distinct()
        .groupBy("group_key").agg(F.array_sort(F.collect_list("c")).alias("class_names"))
    )
    base = joined.groupBy("group_key").agg(
        F.count(F.lit(1)).alias("reports"),
        F.sum("accepted").cast("long").alias("accepted"),
        F.max(base_name(F.col("scene"))).alias("newest_scene"),
        F.bool_and(F.col("split") == "train").alias("pure_train"),
    )
    none = F.array().cast("array<string>")
    return (
        base.join(counted, "group_key").join(classes, "group_key", "left")
        .withColumn("class_names", F.coalesce("class_names", none))
    )


def group_members(reports: DataFrame, groups: DataFrame) -> DataFrame:
    """Distinct ``group_key, kind, value`` rows (scene, session, video)."""
    return _members(reports.join(groups, "report_path"))


def _members(joined: DataFrame) -> DataFrame:
    values = F.array(
        F.struct(F.lit("scene").alias("kind"), base_name(F.col("scene")).alias("value")),
        F.struct(F.lit("session").alias("kind"), blank_to_null(F.col("capture_session_id")).alias("value")),
        F.struct(F.lit("video").alias("kind"), blank_to_null(F.col("source_video_id")).alias("value")),
    )
    rows = joined.select("group_key", F.inline(values))
    return rows.where(F.col("value").isNotNull()).distinct()


def select_groups(members: DataFrame, scenes: list[str], videos: list[str]) -> DataFrame:
    """Groups that contain one of the scenes or one of the videos."""
    hit = ((F.col("kind") == "scene") & F.col("value").isin(scenes)) | ((F.col("kind") == "video") & F.col("value").isin(videos))
    return members.where(hit).select("group_key").distinct()


def select_groups_in(members: DataFrame, named: DataFrame) -> DataFrame:
    """Groups that contain one of the members named by a table ``kind, value`` of any size."""
    return members.join(named.select("kind", "value").distinct(), ["kind", "value"], "left_semi").select("group_key").distinct()


def mixed_group_violations(summary: DataFrame, chosen: DataFrame) -> DataFrame:
    """Chosen groups that are not purely train."""
    return summary.join(chosen, "group_key", "left_semi").where(~F.col("pure_train")).select(
        F.lit("group_not_pure_train").alias("rule"), F.col("group_key").alias("key")
    )


def newest_first(summary: DataFrame) -> DataFrame:
    """Position of each group when ordered by newest scene, then key, both descending.

    The ranks come from range partitions and their counts, so no task sorts all groups.
    """
    ascending = ranked(summary, ["newest_scene", "group_key"], "_up", "_all")
    return ascending.withColumn("position", F.col("_all") - 1 - F.col("_up")).drop("_up", "_all")


@dataclass
class SplitPlan:
    chosen: DataFrame  # group_key of the groups that become val
    insufficient: list[str]
    existing_val_classes: list[str]
    total_frames: int
    selected_frames: int


def auto_split(reports: DataFrame, groups: DataFrame, ratio: float = 0.20) -> SplitPlan:
    """Choose whole groups for validation, stratified by class.

    First every class without validation data gets the group closest to its share, unless
    an earlier class already took one of its groups.  Then, newest first, further groups
    are added while the overall share strictly improves and every class keeps a train group.
    """
    if not 0.0 < ratio < 1.0:
        raise ValueError("ratio must lie between 0 and 1")
    existing = [
        r[0]
        for r in reports.where("split = 'val'").select(F.explode("class_names").alias("c")).distinct().limit(MAX_CLASSES + 1).collect()
    ]
    summary = group_summary(reports, groups)
    usable = newest_first(summary.where("accepted > 0 and size(class_names) > 0 and pure_train"))
    usable = cut(usable.select("group_key", "accepted", "class_names", "newest_scene", "position"))
    by_class = usable.select("position", "group_key", "accepted", "newest_scene", "class_names", F.explode("class_names").alias("class_name"))
    totals = by_class.groupBy("class_name").agg(F.count(F.lit(1)).alias("n"), F.sum("accepted").alias("frames"), F.max("position").alias("oldest"))
    distance = F.abs(F.col("accepted") - F.col("frames") * F.lit(ratio))
    # the nearest group of each class; equal distances go to the newest (lowest position)
    best = (
        by_class.join(totals, "class_name")
        .groupBy("class_name")
        .agg(
            F.min(F.struct(distance.alias("d"), F.col("position").alias("p"), "group_key", "accepted", "class_names")).alias("best"),
            F.first("n").alias("n"),
        )
        .orderBy("class_name")
        .limit(MAX_CLASSES + 1)
        .collect()
    )
    if len(best) > MAX_CLASSES or len(existing) > MAX_CLASSES:
        raise ValueError("more classes than a class catalogue can hold")
    touched: set[str] = set()
    picked: dict[int, tuple[str, int]] = {}
    insufficient: list[str] = []
    for row in best:  # one row per class, alphabetical
        name = row["class_name"]
        if name in existing:
            continue
        if row["n"] < 2:
            insufficient.append(name)
        elif name not in touched:
            choice = row["best"]
            picked[choice["p"]] = (choice["group_key"], choice["accepted"])
            touched.update(choice["class_names"])
    spark = reports.sparkSession
    if not picked:
        if not existing:
            raise ValueError("cannot choose val: every class needs at least two independent scenes with accepted frames")
        return SplitPlan(spark.createDataFrame([], "group_key string"), insufficient, sorted(existing), 0, 0)
    total = usable.agg(F.sum("accepted")).first()[0]
    selected = sum(frames for _, frames in picked.values())
    added = _improve(usable, by_class, picked, total, selected, ratio)
    first = spark.createDataFrame([(p,) for p in picked], "position long")
    taken = first if added is None else first.unionByName(added)
    chosen = cut(usable.join(taken, "position", "left_semi").select("group_key", "accepted"))
    frames = chosen.agg(F.sum("accepted")).first()[0]
    return SplitPlan(chosen.select("group_key"), insufficient, sorted(existing), total, frames)


def _improve(usable: DataFrame, by_class: DataFrame, picked: dict, total: int, selected: int, ratio: float) -> DataFrame | None:
    """Positions added by the newest-first pass.

    A group of ``c`` frames improves the share exactly when ``c < 2 * room`` with ``room`` the
    frames still wanted.  While the room stays above half of what it was, every group up to
    that size is taken, so a prefix sum finds the next change in one job; the room halves
    each time.  The only group that can be refused for the sake of its class is the oldest
    open one of a class, so those few positions are handled one by one.
    """
    target = ratio * max(1, total)
    open_rows = usable.where(~F.col("position").isin(list(picked))) if picked else usable
    per_class = (
        by_class.where(~F.col("position").isin(list(picked)))
        .groupBy("class_name")
        .agg(F.max("position").alias("last"), F.count(F.lit(1)).alias("n_open"))
        .collect()
    )
    last_of: dict[int, list[str]] = {}
    for row in per_class:  # one row per class
        last_of.setdefault(row["last"], []).append(row["class_name"])
    parts: list[DataFrame] = []
    refused_classes: set[str] = set()
    n_open = {row["class_name"]: row["n_open"] for row in per_class}
    taken_by_class: dict[str, int] = {}
    start = 0
    guard = sorted(last_of)
    while True:
        room = target - selected
        if room <= 0:
            break
        stop = next((p for p in guard if p >= start), None)
        window = open_rows.where(F.col("position") >= start)
        if stop is not None:
            window = window.where(F.col("position") < stop)
        # sizes below `room` always fit while the room stays above half of it
        small = F.when(F.col("accepted") < room, F.col("accepted")).otherwise(0)
        ranked = scan(
            window.select("position", "accepted", "class_names"), [], ["position"], index_block(F.col("position"), 65536), cumsum={"_sum": small}
        )
        left = F.lit(room) - F.col("_sum")
        big = (F.col("accepted") >= room) & (F.col("accepted") < 2 * left)
        event = ranked.where(big | (left <= room / 2.0)).agg(F.min("position")).first()[0]
        limit = F.lit(True) if event is None else F.col("position") < event
        chosen = ranked.where(limit & (F.col("accepted") < room))
        ahead = cut(chosen.select("position", "accepted", "class_names"))
        selected += ahead.agg(F.coalesce(F.sum("accepted"), F.lit(0))).first()[0]
        for row in ahead.select(F.explode("class_names").alias("c")).groupBy("c").count().collect():  # per class
            taken_by_class[row["c"]] = taken_by_class.get(row["c"], 0) + row["count"]
        parts.append(ahead.select("position"))
        if event is not None:
            single = event
        elif stop is not None:
            single = stop
        else:
            break
        row = open_rows.where(F.col("position") == single).select("accepted", "class_names").first()
        room = target - selected
        names = last_of.get(single, [])
        # the class would lose its last open group
        blocked = any(taken_by_class.get(c, 0) == n_open[c] - 1 for c in names)
        better = abs((selected + row["accepted"]) / max(1, total) - ratio) < abs(selected / max(1, total) - ratio)
        if better and not blocked:
            selected += row["accepted"]
            for c in row["class_names"]:
                taken_by_class[c] = taken_by_class.get(c, 0) + 1
            parts.append(usable.where(F.col("position") == single).select("position"))
        start = single + 1
    if not parts:
        return None
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def assign_split(rows: DataFrame, groups: DataFrame, chosen: DataFrame) -> DataFrame:
    """``split`` becomes val for every row of a chosen group; other rows keep theirs."""
    moved = groups.join(chosen.select("group_key"), "group_key", "left_semi").select("report_path", F.lit(True).alias("_moved"))
    joined = rows.join(moved, "report_path", "left")
    return joined.withColumn("split", F.when(F.col("_moved"), "val").otherwise(F.col("split"))).drop("_moved")


def manifest_violations(chosen_scenes: DataFrame, manifests: DataFrame) -> DataFrame:
    """Scenes to move whose train manifest is absent or inconsistent, or whose val manifest exists.

    chosen_scenes ``scene, scene_id``; manifests ``scene_id, file_split, split, scene`` (resolved scene path)
    """
    train = manifests.where("file_split = 'train'").select("scene_id", F.col("split").alias("m_split"), F.col("scene").alias("m_scene"), F.lit(True).alias("has_train"))
    val = manifests.where("file_split = 'val'").select("scene_id", F.lit(True).alias("has_val")).distinct()
    joined = chosen_scenes.join(train, "scene_id", "left").join(val, "scene_id", "left")
    rule = (
        F.when(F.col("has_train").isNull(), "train_manifest_missing")
        .when(F.col("has_val"), "val_manifest_exists")
        .when(~F.col("m_split").eqNullSafe("train"), "manifest_split_not_train")
        .when(F.coalesce(F.trim("m_scene"), F.lit("")) == "", "manifest_scene_missing")
        .when(F.col("m_scene") != F.col("scene"), "manifest_scene_mismatch")
    )
    return joined.select(rule.alias("rule"), F.col("scene_id").alias("key")).where(F.col("rule").isNotNull())
