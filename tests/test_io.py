"""Readers and writers on small files, and the streams against their stored twins."""

import csv
import json

import pytest
from pyspark.sql import functions as F

from framesift import schemas
from framesift.operators import inventory, segments
from framesift.sinks import writers
from framesift.sources import documents, listings
from framesift.streaming import frames as streams


def _write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text if isinstance(text, str) else json.dumps(text, ensure_ascii=False), encoding="utf-8")


def test_manifests_and_classes(spark, tmp_path):
    _write(
        tmp_path / "m/can_01_val.yaml",
        "classes:\n  0: can\nproject:\n  scene: ../data/scenes/can/can_01\n  capture_session_id: s1\n  mask_quality:\n    min_mask_area: 90\n"
        "instances:\n- {instance_id: can 1, class_id: 0, class_name: can, tracker: sam2}\n- {instance_id: can_2, class_id: 0, class_name: can}\n",
    )
    _write(tmp_path / "m/broken.yaml", "a: [1")
    table = documents.manifests(spark, str(tmp_path / "m"))
    row = table.first()
    assert table.count() == 1
    assert (row.scene_id, row.split, row.file_split, row.name_prefix, row.mask_quality["min_mask_area"]) == ("can_01", "train", "val", "can_01_", 90.0)
    assert [r.instance_id for r in documents.manifest_instances(table).orderBy("ord").collect()] == ["can 1", "can_2"]
    _write(tmp_path / "c/list.yaml", "classes: [can, box]\n")
    _write(tmp_path / "c/map.yaml", "classes:\n  0: can\n  1: box\nobjects:\n  box: {chinese_name: 盒, role: extra}\n")
    assert sorted((r.class_id, r.class_name) for r in documents.class_catalogue(spark, str(tmp_path / "c/list.yaml")).collect()) == [(0, "can"), (1, "box")]
    named = {r.class_name: (r.display_name, r.role) for r in documents.class_catalogue(spark, str(tmp_path / "c/map.yaml")).collect()}
    assert named == {"can": ("can", None), "box": ("盒", "extra")}


def test_scene_reports(spark, tmp_path):
    _write(
        tmp_path / "a_train_report.json",
        {"scene": "/d/a", "capture_session_id": " ", "frame_status_counts": {"accepted": 2}, "instances": [{"class_name": " can "}, {"class_name": ""}],
         "frames": [{"output_id": "a_1 ", "status": "accepted"}, {"output_id": "a_1", "status": "accepted"}, {"output_id": "a_2", "status": "review"}, {"output_id": "", "status": "accepted"}]},
    )
    _write(tmp_path / "b_train_report.json", "{not json")
    _write(tmp_path / "c_train_report.json", {"split": "val"})
    good = documents.scene_reports(spark, str(tmp_path)).collect()
    assert [(r.scene, r.split, r.capture_session_id, r.class_names, r.output_ids, r.accepted, r.review) for r in good] == [("/d/a", "train", None, ["can"], ["a_1"], 2, 0)]
    every = documents.scene_reports(spark, str(tmp_path), keep_errors=True).collect()
    assert len(every) == 3 and sum(r.error is not None for r in every) == 1


def test_metadata_overrides_ranges_negatives(spark, tmp_path):
    _write(tmp_path / "s1/metadata.json", {"depth_to_metre": 0.002, "frames": [{"id": "000000", "color_timestamp_ms": 1.0}, {"id": "000001"}, {"id": "000000", "color_timestamp_ms": 5.0}]})
    meta = {r.frame_id: r.color_timestamp_ms for r in documents.capture_metadata(spark, str(tmp_path / "s1")).collect()}
    assert meta == {"000000": 5.0, "000001": None}
    _write(tmp_path / "o/x.json", {"scene": "s", "instance_id": "a", "frames": {"000001": {"status": "accepted"}, "000002": {"status": "maybe"}}})
    assert [(r.frame_id, r.status) for r in documents.review_overrides(spark, str(tmp_path / "o")).collect()] == [("000001", "accepted")]
    _write(tmp_path / "r/one.json", {"action": "rerun_range", "scene": "s", "instance_id": "a", "start_frame": "1", "end_before_frame": ""})
    _write(tmp_path / "r/two.json", {"action": "rerun_ranges", "scene": "s", "instance_id": "a", "ranges": [{"segment_id": "0", "start_frame": "1", "end_before_frame": "3"}, {"start_frame": "4"}]})
    asked = sorted((r.start_frame, r.end_before_frame) for r in documents.range_requests(spark, str(tmp_path / "r")).collect() if r.start_frame != "1" or r.segment_id)
    assert asked == [("1", "3"), ("4", None)]
    items = [{"split": "val", "image": "a.png", "reviewed_no_targets": True}, {"split": "val", "image": "a.jpg", "reviewed_no_targets": True}, {"split": "dev", "image": "b.png", "reviewed_no_targets": True}, {"split": "train", "image": "c.png", "reviewed_no_targets": False}]
    _write(tmp_path / "n.json", {"items": items})
    kept, wrong = documents.reviewed_negatives(spark, str(tmp_path / "n.json"))
    assert [r.stem for r in kept.collect()] == ["a"]
    assert sorted(r.rule for r in wrong.collect()) == ["bad_split", "duplicate", "not_confirmed"]


def test_segment_reports_fall_back(spark, tmp_path):
    _write(tmp_path / "s/segments.json", {"scene": "/d/s", "segments": [{"start_id": "000003", "end_id": "000001"}, {"start_id": "000009", "end_id": "000004"}]})
    listed = documents.segment_reports(spark, str(tmp_path))
    frames = spark.createDataFrame([(s, f"{n:06d}") for s in ("s", "t") for n in range(5)], "scene_id string, frame_id string")
    got = sorted((r.scene_id, r.segment_id, r.start_id, r.end_id) for r in segments.usable_segments(listed, frames).collect())
    assert got == [("s", "0", "000001", "000003"), ("t", "0", "000000", "000004")]


def test_listings(spark, tmp_path):
    for name in ("images/val/a.PNG", "images/val/b.jpg", "images/val/c.txt", "images/val/deep/d.webp"):
        _write(tmp_path / name, name)
    flat = listings.images(spark, str(tmp_path / "images/val"))
    assert sorted(r.stem for r in flat.collect()) == ["a", "b"]
    assert listings.images_from_spec(spark, str(tmp_path / "images"), "directory").count() == 3
    _write(tmp_path / "list.txt", "x/a.png\n\n /abs/b.png \n")
    assert sorted(r.path for r in listings.images_from_spec(spark, str(tmp_path / "list.txt"), "list").collect()) == ["/abs/b.png", f"{tmp_path}/x/a.png"]
    _write(tmp_path / "scenes/s1/rgb/000000.png", "x")
    _write(tmp_path / "scenes/s1/depth/000000.png", "x")
    assert sorted((r.scene_id, r.stream, r.frame_id) for r in listings.frame_files(spark, str(tmp_path / "scenes")).collect()) == [("s1", "depth", "000000"), ("s1", "rgb", "000000")]
    digests = listings.digests(spark, str(tmp_path / "images/val"))
    expected = digests.select("path", F.when(F.col("path").endswith("jpg"), "0").otherwise(F.col("sha256")).alias("sha256"))
    assert [r.rule for r in inventory.checksum_violations(expected, digests).collect()] == ["digest_mismatch"]
    _write(tmp_path / "runs/r1/results.csv", " epoch , metrics/precision(M),metrics/mAP50-95(M), metrics/mAP50-95(B)\n 1, 0.5,0.7 , 0.6\n\n2,0.6,nan,0.1\n")
    rows = listings.epoch_metrics(spark, str(tmp_path / "runs")).orderBy("row_no").collect()
    assert [(r.run, r.epoch, r.map50_95_m, r.recall_m) for r in rows] == [("r1", "1", "0.7", None), ("r1", "2", "nan", None)]


def test_sinks(spark, tmp_path):
    lines = spark.createDataFrame([("train", "s", "s_0", 1, "1 b"), ("train", "s", "s_0", 0, "0 a")], "split string, scene_id string, output_id string, ord int, line string")
    assert writers.label_texts(lines).first().text == "0 a\n1 b\n"
    verdicts = spark.createDataFrame([("train", "s", "s_0", "accepted", "0 a"), ("train", "s", "s_1", "review", "1 b"), ("train", "t", "t_0", "accepted", "2 c")], "split string, scene_id string, output_id string, status string, label_text string")
    out = str(tmp_path / "labels")
    writers.write_labels(verdicts, out)
    writers.write_labels(verdicts.where("scene_id = 's'").withColumn("label_text", F.lit("9 z")), out)
    stored = {r.output_id: r.text for r in spark.read.parquet(out).collect()}
    assert stored == {"s_0": "9 z\n", "t_0": "2 c\n"}  # the other scene is untouched
    writers.write_candidates(verdicts, str(tmp_path / "candidates"))
    assert [r.output_id for r in spark.read.parquet(str(tmp_path / "candidates")).collect()] == ["s_1"]
    report = verdicts.select("scene_id", "output_id", F.array(F.lit("x"), F.lit("y")).alias("reasons"), F.array(F.struct(F.lit(1).alias("n"))).alias("overlaps"))
    writers.write_report(report, str(tmp_path / "report"), "scene_id")
    part = next((tmp_path / "report/csv/scene_id=t").glob("*.csv"))
    assert list(csv.DictReader(part.open()))[0]["reasons"] == "x|y"
    broken = spark.createDataFrame([("missing_label", f"train/{n}", None) for n in range(30)], schemas.VIOLATIONS)
    with pytest.raises(ValueError, match="30 violations"):
        writers.write_validation(broken, spark.range(1), str(tmp_path / "check"))
    writers.write_validation(broken.limit(0), spark.range(1), str(tmp_path / "clean"))
    writers.append_overrides(spark.createDataFrame([("s", "a", "0", "rejected", "x")], "scene_id string, instance_id string, frame_id string, status string, reason string"), str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).first().updated_at


def _packets(spark, tmp_path):
    rows = []
    for scene in ("a", "b"):
        for n in range(40):
            second = n * (2 if scene == "a" else 3)
            rows.append((scene, n, f"2026-01-01 00:{second // 60:02d}:{second % 60:02d}"))
    df = spark.createDataFrame(rows, "scene_id string, seq long, t string").select("scene_id", "seq", F.col("t").cast("timestamp").alias("ts"))
    path = str(tmp_path / "packets")
    for low in (0, 15, 30):  # three files, so three micro-batches
        df.where((F.col("seq") >= low) & (F.col("seq") < low + 15)).coalesce(1).write.mode("append").parquet(path)
    return df, spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _drain(stream, tmp_path, name):
    query = stream.writeStream.format("parquet").option("path", str(tmp_path / name)).option("checkpointLocation", str(tmp_path / f"{name}_state")).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return sorted((r.scene_id, r.seq) for r in stream.sparkSession.read.schema(stream.schema).parquet(str(tmp_path / name)).collect())


def test_streams_equal_stored_twins(spark, tmp_path):
    stored, stream = _packets(spark, tmp_path)
    keys = lambda df: sorted((r.scene_id, r.seq) for r in df.collect())
    assert _drain(streams.throttle(stream, 5.0, 6), tmp_path, "throttle") == keys(streams.throttle_batch(stored, 5.0, 6))
    assert _drain(streams.warmup(stream, 17), tmp_path, "warmup") == keys(streams.warmup_batch(stored, 17)) == [(s, n) for s in "ab" for n in range(17, 40)]


def test_measure_on_stream(spark, tmp_path):
    runs = spark.createDataFrame([("s", f"{f:06d}", "a", y, 1, 9) for f in range(2) for y in range(1, 7)], schemas.MASK_RUNS)
    rows = spark.createDataFrame([("s", f"{f:06d}", y, [1000 + f] * 10) for f in range(2) for y in range(8)], schemas.DEPTH_ROWS)
    rows.coalesce(1).write.parquet(str(tmp_path / "lines"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "lines"))
    out = str(tmp_path / "measured")
    body = streams.measure_batches(runs, {"fx": 100.0, "fy": 100.0, "cx": 5.0, "cy": 4.0}, 10, 8, lambda df, epoch: df.write.mode("append").parquet(out))
    query = stream.writeStream.foreachBatch(body).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(round(r.depth_m, 3) for r in spark.read.parquet(out).collect()) == [1.0, 1.001]


def test_documents_by_line(spark, tmp_path):
    """Many documents of one file, as the queries write them."""
    lines = [{"scene": f"/d/s{i}", "instance_id": "a", "records": [{"id": "1", "status": "accepted"}]} for i in range(3)]
    (tmp_path / "q.json").write_text("\n".join(map(json.dumps, lines)))
    assert sorted(r.scene_id for r in documents.quality_reports(spark, str(tmp_path), "q.json", lines=True).collect()) == ["s0", "s1", "s2"]
    lines = [{"scene": f"s{i}", "frames": [{"id": "f", "color_timestamp_ms": 1.0}, {"id": "f", "color_timestamp_ms": 2.0 + i}]} for i in range(2)]
    (tmp_path / "m.json").write_text("\n".join(map(json.dumps, lines)))
    found = documents.capture_metadata(spark, str(tmp_path), "m.json", lines=True).collect()
    assert sorted((r.scene_id, r.color_timestamp_ms) for r in found) == [("s0", 2.0), ("s1", 3.0)]
    lines = [{"scene": f"/d/s{i}", "frames": [{"output_id": " o ", "status": "accepted"}]} for i in range(2)]
    (tmp_path / "r.json").write_text("\n".join(map(json.dumps, lines)))
    found = documents.accepted_ids(documents.scene_reports(spark, str(tmp_path), glob="r.json", lines=True)).collect()
    assert sorted((r.scene, r.output_id) for r in found) == [("/d/s0", "o"), ("/d/s1", "o")]
