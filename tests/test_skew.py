"""One scene, session or digest holds most rows: results stay whole and plans stay blocked."""

from pyspark.sql import functions as F

from framesift.operators import groups, segments, validation
from framesift.plans.blocks import index_block
from framesift.plans.ordered import scan
from framesift.plans.quantiles import exact_quantiles


def test_hot_scene_scan(spark):
    hot = spark.range(60_000).select(F.lit("hot").alias("scene_id"), F.col("id").alias("i"))
    cold = spark.range(3_000).select(F.concat(F.lit("c"), (F.col("id") % 50).cast("string")).alias("scene_id"), F.col("id").alias("i"))
    rows = hot.unionByName(cold)
    out = scan(rows, ["scene_id"], ["i"], index_block(F.col("i"), 512), index="n", cumsum={"s": F.lit(1)}, prev={"before": F.col("i")})
    total = out.where("scene_id = 'hot'").agg(F.count("*").alias("c"), F.count_if(F.col("n") == F.col("i")).alias("ok"), F.count_if(F.col("s") == F.col("n") + 1).alias("sum_ok"), F.count_if(F.col("before") == F.col("i") - 1).alias("prev_ok")).first()
    assert (total.c, total.ok, total.sum_ok, total.prev_ok) == (60_000, 60_000, 60_000, 59_999)
    assert out.count() == 63_000


def test_row_windows_are_partitioned_by_block(spark):
    rows = spark.range(100).select(F.lit("hot").alias("scene_id"), F.col("id").alias("i"))
    out = scan(rows, ["scene_id"], ["i"], index_block(F.col("i"), 16), index="n")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    rows_window = [line for line in plan.splitlines() if "Window [" in line and "row_number" in line]
    assert rows_window and all("_blk" in line for line in rows_window)


def test_hot_quantile(spark):
    rows = spark.range(50_001).select(F.lit("hot").alias("k"), (F.col("id") % 1000).cast("double").alias("v"))
    r = exact_quantiles(rows, ["k"], "v", {"m": 0.5}, count="n").first()
    want = sorted(i % 1000 for i in range(50_001))[25_000]
    assert (r.n, r.m) == (50_001, float(want))


def test_hot_session_and_digest(spark):
    reports = spark.range(5_000).select(
        F.format_string("r%05d", F.col("id")).alias("report_path"), F.format_string("/d/s_%05d", F.col("id")).alias("scene"), F.lit("train").alias("split"),
        F.when(F.col("id") < 3_000, "hot").alias("capture_session_id"), F.lit(None).cast("string").alias("source_video_id"),
        F.array(F.lit("can")).alias("class_names"), F.lit(1).cast("long").alias("accepted"),
    )
    found = groups.capture_groups(reports).groupBy("group_key").count()
    assert found.count() == 2_001 and found.agg(F.max("count")).first()[0] == 3_000
    files = spark.range(4_000).select(F.when(F.col("id") % 2 == 0, "train").otherwise("val").alias("split"), F.col("id").cast("string").alias("path"), F.lit(7).cast("long").alias("size"), F.lit("same").alias("sha256"))
    row = validation.cross_split_duplicates(files).first()
    assert row.pairs == 2_000 * 2_000
    assert validation.duplicate_members(files, validation.cross_split_duplicates(files)).count() == 4_000


def test_hot_scene_segments(spark):
    frames = spark.range(20_000).select(
        F.lit("hot").alias("scene_id"), F.format_string("%06d", F.col("id")).alias("frame_id"), (F.col("id") % 997 == 0).alias("is_cut"), F.lit(False).alias("is_gap")
    )
    table = segments.segments(segments.boundaries(frames, 300))
    starts, last = [], 0
    for i in range(20_000):
        if i == 0 or i % 997 == 0 or i - last >= 300:
            starts.append(i)
            last = i
    assert sorted(r.start_index for r in table.collect()) == starts
    assert table.agg(F.sum("frame_count")).first()[0] == 20_000


def test_near_equal_gaps_of_one_scene(spark):
    rows = spark.range(100_000).select(F.lit("hot").alias("k"), (F.lit(33.0) + F.pmod(F.col("id") * 7919, F.lit(100_000)) * 1e-7).alias("v"))
    r = exact_quantiles(rows, ["k"], "v", {"m": 0.5, "p": 0.95}, count="n").first()
    assert r.n == 100_000 and abs(r.m - (33.0 + 49_999.5e-7)) < 1e-12 and abs(r.p - (33.0 + 94_999.05e-7)) < 1e-12


def test_undated_groups_are_ranked_without_one_window(spark):
    summary = spark.range(3_000).select(F.format_string("g%04d", F.col("id")).alias("group_key"), F.lit("scene").alias("newest_scene"))
    ranks = groups.newest_first(summary)
    assert "Window" not in ranks._jdf.queryExecution().optimizedPlan().toString()
    assert ranks.where(F.col("position") == 2_999 - F.substring("group_key", 2, 4).cast("int")).count() == 3_000
