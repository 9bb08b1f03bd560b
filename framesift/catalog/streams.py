"""Capture operators on stored tables and on streams of the same files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from ..session import checkpoint_dir
from ..streaming import frames as s
from . import views as v

INTERVAL_S = 43200.0
CAP = 12
LONG_S = 1800.0
TURNS = 3
SKIP = 5


def _packets(events: DataFrame) -> DataFrame:
    """Events as frame packets of a scene; some lack a stream or have another size."""
    k = F.col("event_id")
    return events.select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("scene_id"),
        k.alias("seq"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.lit(640).alias("width"),
        F.lit(480).alias("height"),
        F.when(F.col("event_type") != "error", 640).alias("rgb_width"),
        F.lit(480).alias("rgb_height"),
        F.when(F.col("value") > 5, 640).otherwise(320).alias("depth_width"),
        F.lit(480).alias("depth_height"),
        F.when(F.col("event_type") != "error", F.encode("event_type", "UTF-8")).alias("rgb"),
        F.encode("event_type", "UTF-8").alias("depth"),
        "value",
    )


def _stored(spark, sf_dir) -> DataFrame:
    return _packets(v.table(spark, sf_dir, "events"))


def _arriving(spark, sf_dir) -> DataFrame:
    """The same packets as a file stream; the table is one file or a folder of parts."""
    schema = v.table(spark, sf_dir, "events").schema
    raw = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    return _packets(raw)


def _drain(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Run a stream over everything that is there and read back what it wrote."""
    spark = stream.sparkSession
    base = f"{checkpoint_dir(spark).rstrip('/')}/framesift-stream-{uuid.uuid4().hex}"
    if mode == "append":
        writer = stream.writeStream.format("parquet").option("path", f"{base}/out")
    else:
        # latest full state of the aggregate; each batch replaces the one before
        writer = stream.writeStream.foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(f"{base}/out"))
    query = writer.option("checkpointLocation", f"{base}/state").outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def _drain_in_turns(spark, sf_dir, build, mode: str = "append") -> DataFrame:
    """Files that arrive in turns, and a query that stops and goes on after each of them."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/framesift-turns-{uuid.uuid4().hex}"
    events = v.table(spark, sf_dir, "events")
    ends = events.agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi")).first()
    turn = F.floor((F.col("event_id") - F.lit(ends["lo"] or 0)) * TURNS / F.lit((ends["hi"] or 0) - (ends["lo"] or 0) + 1))
    for number in range(TURNS):
        events.where(turn == number).write.mode("append").parquet(f"{base}/in")
        stream = build(_packets(spark.readStream.schema(events.schema).parquet(f"{base}/in")))
        if mode == "append":
            writer = stream.writeStream.format("parquet").option("path", f"{base}/out")
        else:
            writer = stream.writeStream.foreachBatch(s.keep_status(f"{base}/out"))
        query = writer.option("checkpointLocation", f"{base}/state").outputMode(mode).trigger(availableNow=True).start()
        query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out") if mode == "append" else s.read_status(spark, f"{base}/out")


_PACKETS = """pk AS (SELECT 'u' || user_id AS scene_id, event_id AS seq, ts, value, event_type FROM events),
vp AS (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY seq) - 1 AS n FROM pk WHERE event_type <> 'error')"""


def warmup(spark, sf_dir) -> DataFrame:
    return s.warmup_batch(s.valid_frames(_stored(spark, sf_dir)), SKIP).select("scene_id", "seq")


def warmup_stream(spark, sf_dir) -> DataFrame:
    return _drain(s.warmup(s.valid_frames(_arriving(spark, sf_dir)), SKIP).select("scene_id", "seq"))


WARMUP = f"WITH {_PACKETS} SELECT scene_id, seq FROM vp WHERE n >= {SKIP}"


def throttle(spark, sf_dir) -> DataFrame:
    return s.throttle_batch(s.valid_frames(_stored(spark, sf_dir)), INTERVAL_S, CAP).select("scene_id", "seq")


def throttle_stream(spark, sf_dir) -> DataFrame:
    return _drain(s.throttle(s.valid_frames(_arriving(spark, sf_dir)), INTERVAL_S, CAP).select("scene_id", "seq"))


THROTTLE = f"""WITH RECURSIVE {_PACKETS}, r AS (
  SELECT scene_id, n, seq, ts AS last, true AS kept, 1 AS c FROM vp WHERE n = 0 UNION ALL
  SELECT r.scene_id, v.n, v.seq, CASE WHEN epoch_us(v.ts) - epoch_us(r.last) >= {int(INTERVAL_S * 1e6)} THEN v.ts ELSE r.last END,
         epoch_us(v.ts) - epoch_us(r.last) >= {int(INTERVAL_S * 1e6)}, r.c + CASE WHEN epoch_us(v.ts) - epoch_us(r.last) >= {int(INTERVAL_S * 1e6)} THEN 1 ELSE 0 END
  FROM r JOIN vp v ON v.scene_id = r.scene_id AND v.n = r.n + 1)
SELECT scene_id, seq FROM r WHERE kept AND c <= {CAP}"""


def throttle_in_turns(spark, sf_dir) -> DataFrame:
    """The throttle over a stream that stops between its files."""
    return _drain_in_turns(spark, sf_dir, lambda packets: s.throttle(s.valid_frames(packets), INTERVAL_S, CAP).select("scene_id", "seq"))


def status_in_turns(spark, sf_dir) -> DataFrame:
    """Status in update mode: every batch writes the scenes it changed."""
    found = _drain_in_turns(spark, sf_dir, lambda packets: s.capture_status(s.valid_frames(packets)), "update")
    return found.select("scene_id", "saved_frames", "last_seq")


def throttle_long(spark, sf_dir) -> DataFrame:
    """One long sequence per event type, over many blocks."""
    packets = v.table(spark, sf_dir, "events").select(F.col("event_type").alias("scene_id"), F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("ts"))
    return s.throttle_batch(packets, LONG_S, block_rows=128)


THROTTLE_LONG = f"""WITH RECURSIVE vp AS (
  SELECT event_type AS scene_id, event_id AS seq, epoch_us(ts) AS t, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS n FROM events),
r AS (
  SELECT scene_id, n, t AS last, true AS kept FROM vp WHERE n = 0 UNION ALL
  SELECT r.scene_id, v.n, CASE WHEN v.t - r.last >= {int(LONG_S * 1e6)} THEN v.t ELSE r.last END, v.t - r.last >= {int(LONG_S * 1e6)}
  FROM r JOIN vp v ON v.scene_id = r.scene_id AND v.n = r.n + 1)
SELECT scene_id, seq, ts FROM r JOIN vp USING (scene_id, n) JOIN events ON event_id = seq WHERE kept"""


def consistent_packets(spark, sf_dir) -> DataFrame:
    good, dead = s.consistent(_stored(spark, sf_dir))
    return good.select("seq", F.lit("good").alias("kind")).unionByName(dead.select("seq", F.lit("dead").alias("kind")))


CONSISTENT = "SELECT event_id AS seq, CASE WHEN event_type <> 'error' AND value > 5 THEN 'good' ELSE 'dead' END AS kind FROM events"


def capture_status_stream(spark, sf_dir) -> DataFrame:
    stream = s.capture_status(s.valid_frames(_arriving(spark, sf_dir)))
    return _drain(stream.select("scene_id", "saved_frames", "last_seq"), "complete")


CAPTURE_STATUS = f"WITH {_PACKETS} SELECT scene_id, count(*) AS saved_frames, max(seq) AS last_seq FROM vp GROUP BY scene_id"


def _measured(packets: DataFrame) -> DataFrame:
    k = F.col("seq")
    return packets.select(
        "scene_id",
        F.lit("obj").alias("instance_id"),
        "seq",
        "ts",
        F.floor(F.col("value") * 20).cast("double").alias("area"),
        (150 + k % 340).cast("double").alias("cx"),
        (100 + (k * 7) % 280).cast("double").alias("cy"),
        (F.col("value") > 5).alias("usable"),
        F.lit(False).alias("registration"),
        F.lit(800.0).alias("diagonal"),
        F.lit(0.35).alias("min_ratio"),
        F.lit(2.8).alias("max_ratio"),
        F.lit(0.40).alias("max_shift"),
    )


def online_gate_stream(spark, sf_dir) -> DataFrame:
    stream = s.online_gate(_measured(s.valid_frames(_arriving(spark, sf_dir))))
    return _drain(stream.select("seq", "ref_area", F.col("good").cast("long").alias("good")))


ONLINE_GATE = f"""WITH RECURSIVE {_PACKETS}, m AS (
  SELECT *, floor(value * 20) AS area, CAST(150 + seq % 340 AS DOUBLE) AS cx, CAST(100 + (seq * 7) % 280 AS DOUBLE) AS cy, value > 5 AS usable FROM vp), r AS (
  SELECT scene_id, CAST(0 AS BIGINT) AS n, CAST(NULL AS DOUBLE) AS ra, CAST(NULL AS DOUBLE) AS rx, CAST(NULL AS DOUBLE) AS ry FROM m WHERE n = 0 UNION ALL
  SELECT scene_id, n + 1, CASE WHEN k THEN area ELSE ra END, CASE WHEN k THEN cx ELSE rx END, CASE WHEN k THEN cy ELSE ry END FROM (
    SELECT r.*, m.area, m.cx, m.cy, usable AND (ra IS NULL OR NOT (area / ra < 0.35 OR area / ra > 2.8 OR sqrt((cx - rx) * (cx - rx) + (cy - ry) * (cy - ry)) / 800 > 0.40)) AS k
    FROM r JOIN m ON m.scene_id = r.scene_id AND m.n = r.n))
SELECT seq, ra AS ref_area, CAST(usable AND (ra IS NULL OR NOT (area / ra < 0.35 OR area / ra > 2.8 OR sqrt((cx - rx) * (cx - rx) + (cy - ry) * (cy - ry)) / 800 > 0.40)) AS BIGINT) AS good
FROM m JOIN r ON m.scene_id = r.scene_id AND m.n = r.n"""


def resume_point(spark, sf_dir) -> DataFrame:
    e = v.events(spark, sf_dir)
    return s.resume_point(e.select("scene_id", "frame_id"))


RESUME = f"WITH {v.EVENTS} SELECT scene_id, max(idx) + 1 AS next_index, count(*) AS saved_frames FROM ev GROUP BY scene_id"

QUERIES = {
    "warmup": (warmup, WARMUP),
    "warmup_stream": (warmup_stream, WARMUP),
    "throttle": (throttle, THROTTLE),
    "throttle_in_turns": (throttle_in_turns, THROTTLE),
    "status_in_turns": (status_in_turns, CAPTURE_STATUS),
    "throttle_long": (throttle_long, THROTTLE_LONG),
    "throttle_stream": (throttle_stream, THROTTLE),
    "consistent_packets": (consistent_packets, CONSISTENT),
    "capture_status_stream": (capture_status_stream, CAPTURE_STATUS),
    "online_gate_stream": (online_gate_stream, ONLINE_GATE),
    "resume_point": (resume_point, RESUME),
}
