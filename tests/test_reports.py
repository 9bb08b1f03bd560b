"""Reports that lose scenes, unreadable manifests, ended scenes, batches that run again, folds over a hot key."""

import datetime

import pytest
from pyspark.sql import functions as F

from framesift.catalog.reports import _hysteresis
from framesift.operators import quality
from framesift.sinks import writers
from framesift.sources import documents
from framesift.streaming import frames


def test_scene_that_left_a_report_loses_its_rows(spark, tmp_path):
    path = str(tmp_path / "report")
    first = spark.createDataFrame([("a", 1, ["x"]), ("b", 2, []), ("c", 3, [])], "scene_id string, n int, reasons array<string>")
    writers.write_report(first, path, "scene_id")
    second = spark.createDataFrame([("a", 4, [])], first.schema)
    writers.write_report(second, path, "scene_id", judged=spark.createDataFrame([("a",), ("b",)], "scene_id string"))
    left = writers.read_report(spark, path, first.schema, "scene_id").select("scene_id", "n").collect()
    assert sorted(map(tuple, left)) == [("a", 4), ("c", 3)]


def test_unreadable_manifest_stops_the_run(spark, tmp_path):
    (tmp_path / "good_train.yaml").write_text('{"project": {"scene": "/d/s1"}, "instances": []}')
    assert documents.manifests(spark, str(tmp_path)).count() == 1
    (tmp_path / "bad_train.yaml").write_text("{")
    (tmp_path / "other_train.yaml").write_text("{}")
    with pytest.raises(ValueError, match="bad_train"):
        documents.manifests(spark, str(tmp_path), strict=True)
    assert documents.manifests(spark, str(tmp_path)).count() == 2
    rules = {(r.rule, r.key.rsplit("/", 1)[-1]) for r in documents.manifest_errors(documents.yaml_documents(spark, str(tmp_path))).collect()}
    assert rules == {("manifest_unreadable", "bad_train.yaml"), ("manifest_without_project", "other_train.yaml")}


def test_ended_scene_starts_anew(spark, tmp_path):
    schema = "scene_id string, seq long, ts timestamp, ended boolean"
    start = datetime.datetime(2026, 1, 1)
    turns = [[("s", 0, 0, False), ("s", 1, 1, False), ("t", 0, 0, False)], [("s", 2, 2, True)], [("s", 0, 0, False), ("s", 1, 1, False), ("t", 1, 1, False)]]
    out = None
    for number, turn in enumerate(turns):
        rows = [(k, seq, start + datetime.timedelta(seconds=s), end) for k, seq, s, end in turn]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = frames.warmup(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), 1)
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
        out = sorted((r.scene_id, r.seq) for r in spark.read.schema(schema).parquet(str(tmp_path / "out")).collect())
    # the first frame of the new scene s is skipped again, t goes on
    assert out == [("s", 1), ("s", 1), ("s", 2), ("t", 1)]


def test_batch_that_runs_again_counts_once(spark, tmp_path):
    keep = frames.keep_status(str(tmp_path))
    keep(spark.createDataFrame([("a", 1), ("b", 1)], "scene_id string, n int"), 0)
    for _ in range(2):
        keep(spark.createDataFrame([("a", 5)], "scene_id string, n int"), 1)
    assert sorted(map(tuple, frames.read_status(spark, str(tmp_path)).collect())) == [("a", 5), ("b", 1)]


def test_fold_over_a_hot_key_is_streamed(spark):
    rows = spark.range(60_000).select(F.lit("hot").alias("scene_id"), F.col("id").alias("event_id"), (F.col("id") * 37 % 101).cast("double").alias("value"))
    seen = []

    def fold(batches):
        for batch in _hysteresis(batches):
            yield batch.assign(rows=len(batch))

    out = quality.user_fold(rows, ["scene_id"], ["event_id"], fold, "event_id long, active long, rows long").collect()
    state = 0
    for i in range(60_000):
        value = i * 37 % 101
        state = 1 if value > 60 else 0 if value < 30 else state
        seen.append(state)
    assert [r.active for r in sorted(out, key=lambda r: r.event_id)] == seen
    assert max(r.rows for r in out) <= 10_000  # no batch holds the whole key
