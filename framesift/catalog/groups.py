"""Capture groups and the train / val split."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import groups as g
from ..session import cut
from . import views as v
from .text import PROJECT, REPO


def _grouped(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    reports = v.reports(spark, sf_dir)
    return reports, g.capture_groups(reports)


def capture_groups(spark, sf_dir) -> DataFrame:
    return _grouped(spark, sf_dir)[1].select("report_path", "group_key")


_GROUPS = f"""{v.REPORTS}, idn AS (
  SELECT o_orderkey AS n, 's' || capture_session_id AS i FROM rep UNION ALL SELECT o_orderkey, source_video_id FROM rep), mn AS (
  SELECT i, min(n) AS m FROM idn GROUP BY i HAVING count(*) > 1), st AS (
  SELECT n, m FROM idn JOIN mn USING (i) WHERE n <> m), ed AS (SELECT n AS a, m AS b FROM st UNION SELECT m, n FROM st), cl AS (
  SELECT a AS n, a AS l FROM ed UNION SELECT ed.b, cl.l FROM cl JOIN ed ON ed.a = cl.n WHERE cl.l > ed.b), lb AS (
  SELECT n, max(l) AS top FROM cl GROUP BY n), gr AS (
  SELECT rep.*, 'scene:' || coalesce(t.scene, rep.scene) AS group_key FROM rep LEFT JOIN lb ON lb.n = rep.o_orderkey LEFT JOIN rep t ON t.o_orderkey = lb.top)"""
CAPTURE_GROUPS = f"WITH RECURSIVE {_GROUPS} SELECT report_path, group_key FROM gr"


def capture_groups_mixed_paths(spark, sf_dir) -> DataFrame:
    """The same groups when reports spell their scenes in an old checkout or with detours."""
    reports = v.reports(spark, sf_dir)
    turn = F.pmod(F.xxhash64("report_path"), F.lit(3))
    root = F.when(turn == 0, "/old/framekit/data/").when(turn == 1, f"{PROJECT}/data/x/../").otherwise(f"{PROJECT}/./data//")
    mixed = reports.withColumn("scene", F.concat(root, "scene"))
    return g.capture_groups(g.resolved_scenes(mixed, REPO, PROJECT)).select("report_path", "group_key")


CAPTURE_GROUPS_MIXED = f"""WITH RECURSIVE {_GROUPS}
SELECT report_path, 'scene:{PROJECT}/data/' || substr(group_key, 7) AS group_key FROM gr"""


def group_summary(spark, sf_dir) -> DataFrame:
    s = g.group_summary(*_grouped(spark, sf_dir))
    return s.select(
        "group_key", *[v.long(c, c) for c in ("reports", "accepted", "scenes", "sessions", "videos")],
        "newest_scene", v.long(F.col("pure_train"), "pure_train"), v.joined("class_names"),
    )


GROUP_SUMMARY = f"""WITH RECURSIVE {_GROUPS}
SELECT group_key, count(*) AS reports, CAST(sum(accepted) AS BIGINT) AS accepted, count(DISTINCT scene) AS scenes, count(DISTINCT capture_session_id) AS sessions,
       count(DISTINCT source_video_id) AS videos, max(scene) AS newest_scene, CAST(bool_and(split = 'train') AS BIGINT) AS pure_train,
       string_agg(DISTINCT class_name, '|' ORDER BY class_name) AS class_names FROM gr GROUP BY group_key"""


def group_members(spark, sf_dir) -> DataFrame:
    members = g.group_members(*_grouped(spark, sf_dir))
    return members.groupBy("kind").agg(F.count(F.lit(1)).alias("members"), F.count_distinct("group_key").alias("groups"))


GROUP_MEMBERS = f"""WITH RECURSIVE {_GROUPS}, mb AS (
  SELECT DISTINCT group_key, 'scene' AS kind, scene AS value FROM gr UNION SELECT group_key, 'session', capture_session_id FROM gr UNION SELECT group_key, 'video', source_video_id FROM gr)
SELECT kind, count(*) AS members, count(DISTINCT group_key) AS groups FROM mb GROUP BY kind"""


def newest_groups(spark, sf_dir) -> DataFrame:
    reports = v.reports(spark, sf_dir)
    per_video = reports.groupBy(F.col("source_video_id").alias("group_key")).agg(F.max("scene").alias("newest_scene"))
    return g.newest_first(per_video).select("group_key", "newest_scene", "position")


NEWEST_GROUPS = f"""WITH {v.REPORTS}, p AS (SELECT source_video_id AS group_key, max(scene) AS newest_scene FROM rep GROUP BY 1)
SELECT *, row_number() OVER (ORDER BY newest_scene DESC, group_key DESC) - 1 AS position FROM p"""


def mixed_groups(spark, sf_dir) -> DataFrame:
    """Groups named by a scene or a video that may not move because they are not purely train."""
    reports, groups = _grouped(spark, sf_dir)
    groups = cut(groups)
    named = reports.where("o_orderkey % 10 < 3").select(F.lit("video").alias("kind"), F.col("source_video_id").alias("value"))
    chosen = g.select_groups_in(g.group_members(reports, groups), named)
    return g.mixed_group_violations(g.group_summary(reports, groups), chosen)


MIXED_GROUPS = f"""WITH RECURSIVE {_GROUPS}, ch AS (SELECT DISTINCT group_key FROM gr WHERE source_video_id IN (SELECT source_video_id FROM rep WHERE o_orderkey % 10 < 3))
SELECT 'group_not_pure_train' AS rule, group_key AS key FROM gr JOIN ch USING (group_key) GROUP BY group_key HAVING NOT bool_and(split = 'train')"""


def _unsplit(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Reports before any validation split exists, and their groups."""
    reports = v.reports(spark, sf_dir).withColumn("split", F.lit("train"))
    return reports, cut(g.capture_groups(reports))


def auto_split(spark, sf_dir) -> DataFrame:
    """Groups chosen for validation when all reports are still train."""
    return g.auto_split(*_unsplit(spark, sf_dir)).chosen


def split_assignment(spark, sf_dir) -> DataFrame:
    """Reports and accepted frames per split after the choice."""
    reports, groups = _unsplit(spark, sf_dir)
    plan = g.auto_split(reports, groups)
    moved = g.assign_split(reports, groups, plan.chosen)
    return moved.groupBy("split").agg(F.count(F.lit(1)).alias("reports"), F.sum("accepted").alias("frames"))


#: The rules read one by one: classes by name, then groups from the newest to the oldest.
_SPLIT = f"""{_GROUPS}, gs AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY newest DESC, group_key DESC) - 1 AS pos FROM (
    SELECT group_key, CAST(sum(accepted) AS BIGINT) AS acc, max(scene) AS newest, list(DISTINCT class_name) AS cls FROM gr GROUP BY group_key) WHERE acc > 0),
gc AS MATERIALIZED (SELECT pos, acc, cls, unnest(cls) AS c FROM gs),
ct AS MATERIALIZED (SELECT c, count(*) AS n, sum(acc) AS frames, row_number() OVER (ORDER BY c) AS k FROM gc GROUP BY c),
be AS MATERIALIZED (SELECT k, c, n, arg_min(struct_pack(pos := pos, acc := acc, cls := cls), struct_pack(d := abs(acc - frames * 0.2::DOUBLE), p := pos)) AS b FROM gc JOIN ct USING (c) GROUP BY k, c, n),
p1 AS (
  SELECT CAST(0 AS BIGINT) AS k, CAST([] AS VARCHAR[]) AS touched, CAST([] AS BIGINT[]) AS picked UNION ALL
  SELECT be.k, CASE WHEN n >= 2 AND NOT list_contains(touched, c) THEN list_concat(touched, b.cls) ELSE touched END,
         CASE WHEN n >= 2 AND NOT list_contains(touched, c) THEN list_append(picked, b.pos) ELSE picked END FROM p1 JOIN be ON be.k = p1.k + 1),
pk AS MATERIALIZED (SELECT picked FROM p1 ORDER BY k DESC LIMIT 1),
fr AS MATERIALIZED (SELECT sum(acc)::DOUBLE AS total FROM gs),
sp AS MATERIALIZED (
  SELECT pos, any_value(acc) AS acc, list(k) AS ks, any_value(list_contains(picked, pos)) AS taken FROM gc JOIN ct USING (c), pk GROUP BY pos),
op AS MATERIALIZED (SELECT list(coalesce(o.n, 0) ORDER BY ct.k) AS open FROM ct LEFT JOIN (SELECT c, count(*) AS n FROM gc, pk WHERE NOT list_contains(picked, pos) GROUP BY c) o USING (c)),
p2 AS (
  SELECT CAST(-1 AS BIGINT) AS pos, (SELECT coalesce(sum(acc), 0)::BIGINT FROM sp WHERE taken) AS sel, open, false AS took FROM op UNION ALL
  SELECT pos, CASE WHEN took THEN sel + acc ELSE sel END, list_transform(open, lambda x, i: x - CASE WHEN took AND list_contains(ks, i) THEN 1 ELSE 0 END), took
  FROM (SELECT sp.pos, acc, sel, open, ks, NOT taken AND list_min(list_transform(ks, lambda i: open[i])) > 1 AND abs((sel + acc) / total - 0.2::DOUBLE) < abs(sel / total - 0.2::DOUBLE) AS took
        FROM p2 JOIN sp ON sp.pos = p2.pos + 1, fr)),
ch AS (SELECT group_key FROM gs JOIN p2 USING (pos) WHERE took UNION SELECT group_key FROM gs, pk WHERE list_contains(picked, pos))"""
AUTO_SPLIT = f"WITH RECURSIVE {_SPLIT} SELECT group_key FROM ch"
SPLIT_ASSIGNMENT = f"""WITH RECURSIVE {_SPLIT}
SELECT CASE WHEN group_key IN (SELECT group_key FROM ch) THEN 'val' ELSE 'train' END AS split, count(*) AS reports, CAST(sum(accepted) AS BIGINT) AS frames FROM gr GROUP BY 1"""


def manifest_violations(spark, sf_dir) -> DataFrame:
    o = v.table(spark, sf_dir, "orders").select("o_orderkey")
    k = F.col("o_orderkey")
    scenes = o.select(F.concat(F.lit("/data/s"), k.cast("string")).alias("scene"), F.concat(F.lit("s"), k.cast("string")).alias("scene_id"))
    wrong = F.when(k % 5 == 1, F.lit("")).when(k % 5 == 2, F.concat(F.lit("/old/s"), k.cast("string"))).otherwise(F.concat(F.lit("/data/s"), k.cast("string")))
    files = F.array_compact(
        F.array(
            F.when(k % 11 != 0, F.struct(F.lit("train").alias("file_split"), F.when(k % 7 == 0, "val").otherwise("train").alias("split"), wrong.alias("scene"))),
            F.when(k % 13 == 0, F.struct(F.lit("val").alias("file_split"), F.lit("val").alias("split"), wrong.alias("scene"))),
        )
    )
    manifests = o.select(F.concat(F.lit("s"), k.cast("string")).alias("scene_id"), F.inline(files))
    return g.manifest_violations(scenes, manifests)


MANIFEST_VIOLATIONS = """SELECT rule, key FROM (
  SELECT 's' || o_orderkey AS key, CASE WHEN o_orderkey % 11 = 0 THEN 'train_manifest_missing' WHEN o_orderkey % 13 = 0 THEN 'val_manifest_exists'
    WHEN o_orderkey % 7 = 0 THEN 'manifest_split_not_train' WHEN o_orderkey % 5 = 1 THEN 'manifest_scene_missing' WHEN o_orderkey % 5 = 2 THEN 'manifest_scene_mismatch' END AS rule
  FROM orders) WHERE rule IS NOT NULL"""

QUERIES = {
    "capture_groups": (capture_groups, CAPTURE_GROUPS),
    "capture_groups_mixed_paths": (capture_groups_mixed_paths, CAPTURE_GROUPS_MIXED),
    "group_summary": (group_summary, GROUP_SUMMARY),
    "group_members": (group_members, GROUP_MEMBERS),
    "newest_groups": (newest_groups, NEWEST_GROUPS),
    "mixed_groups": (mixed_groups, MIXED_GROUPS),
    "auto_split": (auto_split, AUTO_SPLIT),
    "split_assignment": (split_assignment, SPLIT_ASSIGNMENT),
    "manifest_violations": (manifest_violations, MANIFEST_VIOLATIONS),
}
