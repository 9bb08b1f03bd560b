"""Late scenes and pauses in streams, labels that must go, scenes with several spellings."""

import datetime as dt

from pyspark.sql import functions as F

from framesift.functions.text import normal_path
from framesift.operators import groups
from framesift.sinks import writers
from framesift.streaming import frames as streams

VERDICT = "split string, scene_id string, output_id string, status string, label_text string"
PROJECT = "/srv/kit/projects/lab"


def test_streams_keep_late_scenes_and_pauses(spark, tmp_path):
    start = dt.datetime(2024, 1, 1, 12)
    seconds = lambda scene, seqs, at: [(scene, i, at + dt.timedelta(seconds=i)) for i in seqs]
    files = [
        seconds("new", range(10), start),
        seconds("mid", range(10), start + dt.timedelta(hours=1)),
        seconds("new", range(10, 20), start + dt.timedelta(hours=3)),  # after a long pause
        seconds("old", range(10), start - dt.timedelta(hours=6)),  # replayed late
    ]
    folder = str(tmp_path / "in")
    for rows in files:
        spark.createDataFrame(rows, "scene_id string, seq long, ts timestamp").coalesce(1).write.mode("append").parquet(folder)
    stored = spark.read.parquet(folder)
    stream = spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    keys = lambda df: sorted((r.scene_id, r.seq) for r in df.collect())
    cases = {
        "warmup": (streams.warmup(stream, 4), streams.warmup_batch(stored, 4)),
        "throttle": (streams.throttle(stream, 3.0, 5), streams.throttle_batch(stored, 3.0, 5)),
    }
    for name, (run, twin) in cases.items():
        out = str(tmp_path / name)
        query = run.writeStream.format("parquet").option("path", out).option("checkpointLocation", out + "_state")
        query.outputMode("append").trigger(availableNow=True).start().awaitTermination()
        found = keys(spark.read.schema(run.schema).parquet(out))
        assert found == keys(twin) and {s for s, _ in found} == {"new", "mid", "old"}


def test_labels_of_moved_and_rejected_frames_go(spark, tmp_path):
    path = str(tmp_path / "labels")
    stored = lambda: sorted((r.split, r.scene_id, r.output_id) for r in writers.read_labels(spark, path).collect())
    run = lambda *rows: writers.write_labels(spark.createDataFrame(list(rows), VERDICT), path)
    run(("train", "s1", "a", "accepted", "0"), ("train", "s2", "b", "accepted", "0"), ("train", "s3", "c", "accepted", "0"), ("train", "s3", "d", "accepted", "0"))
    run(("val", "s1", "a", "accepted", "0"), ("train", "s2", "b", "rejected", None), ("train", "s3", "d", "review", "0"))
    assert stored() == [("train", "s3", "c"), ("val", "s1", "a")]
    run(("val", "s2", "b", "accepted", "0"))
    assert stored() == [("train", "s3", "c"), ("val", "s1", "a"), ("val", "s2", "b")]


def test_paths_have_one_spelling(spark):
    cases = {"/a/./b//c/": "/a/b/c", "/a/x/../b": "/a/b", "/../a": "/a", "../a/../b": "../b", "../../a": "../../a", "/": "/", "a/..": "", "": "", None: None}
    rows = spark.createDataFrame([(k, w) for k, w in cases.items()], "p string, wanted string")
    assert [(r.p, r.got) for r in rows.select("p", normal_path(F.col("p")).alias("got")).collect()] == list(cases.items())


def test_spellings_of_a_scene_form_one_group(spark):
    scenes = ["/old/kit/data/s", f"{PROJECT}/data/x/../s", f" {PROJECT}/./data/s/ ", f"{PROJECT}/data/t"]
    rows = [(f"r{i}", s, "train", " v " if i == 3 else None, "v" if i == 0 else "  ") for i, s in enumerate(scenes)]
    reports = spark.createDataFrame(rows, "report_path string, scene string, split string, capture_session_id string, source_video_id string")
    found = groups.capture_groups(groups.resolved_scenes(reports, "/srv/kit", PROJECT)).collect()
    assert len({r.group_key for r in found if r.report_path != "r3"}) == 1 and len({r.group_key for r in found}) == 2


def test_segments_of_many_scenes_share_folders(spark, tmp_path):
    path = str(tmp_path / "segments")
    rows = spark.range(300).select(F.concat(F.lit("s"), "id").alias("scene_id"), F.lit(0).cast("long").alias("segment_id"), F.col("id").alias("end_index"))
    writers.write_segments(rows.unionByName(rows.where("end_index = 7").withColumn("segment_id", F.lit(1).cast("long"))), {"max_frames": 9}, path, parts=4)
    assert len(list((tmp_path / "segments").glob("part=*"))) == 4 and len(list((tmp_path / "segments").glob("part=*/*.json"))) <= 8
    writers.write_segments(rows.where("end_index = 7").withColumn("end_index", F.lit(1000).cast("long")), {"max_frames": 5}, path, parts=4)
    found = spark.read.json(path)
    assert found.count() == 300 and found.agg(F.sum("end_index")).first()[0] == sum(range(300)) - 7 + 1000
    assert [(r.scene_id, r.segment_id) for r in found.where("parameters.max_frames = 5").collect()] == [("s7", 0)]
