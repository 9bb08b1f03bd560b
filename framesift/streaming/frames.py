"""Frame streams: validity, warm-up, throttle, online quality gate, metadata.

Stateful operators keep one small row per scene (or instance), for as long as the query
lives: no watermark drops frames of a scene that arrives late, and a pause does not reset
a scene; a row marked ``ended`` ends its state.  Order comes from ``seq``, so the rows of a micro-batch are sorted first; the size
of a micro-batch is bounded by the trigger options of the source.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .. import schemas
from ..operators.quality import Motion
from ..plans.blocks import FRAMES_PER_BLOCK, index_block
from ..plans.chains import Spacing, kept_rows, last_kept
from ..plans.ordered import scan


def frame_stream(spark: SparkSession, path: str, schema: str = schemas.FRAME_EVENTS, files_per_trigger: int = 64) -> DataFrame:
    """Frame packets from a directory of Parquet files."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def valid_frames(packets: DataFrame) -> DataFrame:
    """Packets that carry colour and depth."""
    return packets.where(F.col("rgb").isNotNull() & F.col("depth").isNotNull())


def consistent(packets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Packets whose declared, colour and depth sizes agree, and the others (dead letters).

    Uses ``rgb_width, rgb_height, depth_width, depth_height`` when present, else the byte
    length of 16-bit depth.
    """
    if "depth_width" in packets.columns:
        same = (
            (F.col("rgb_width") == F.col("width"))
            & (F.col("rgb_height") == F.col("height"))
            & (F.col("depth_width") == F.col("width"))
            & (F.col("depth_height") == F.col("height"))
        )
    else:
        same = F.octet_length("depth") == F.col("width") * F.col("height") * 2
    same = F.coalesce(same, F.lit(False))
    return packets.where(same), packets.where(~same)


def _stateful(stream: DataFrame, keys: list[str], state_schema: str, output: str, step: Callable) -> DataFrame:
    """Rows of a key in the order of ``seq`` through ``step``; a row whose column ``ended`` is true ends the state of its key."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches), ignore_index=True).sort_values("seq", kind="stable")
        kept, renewed = step(rows, state.get if state.exists else None)
        if "ended" in rows and rows["ended"].fillna(False).any():
            if state.exists:
                state.remove()  # later rows of the key start anew
        else:
            state.update(renewed)
        if len(kept):
            yield kept

    return stream.groupBy(*keys).applyInPandasWithState(run, output, state_schema, "append", GroupStateTimeout.NoTimeout)


def warmup(stream: DataFrame, skip: int) -> DataFrame:
    """Drop the first ``skip`` frames of a scene."""

    def step(rows, state):
        seen = 0 if state is None else state[0]
        kept = rows.iloc[max(0, skip - seen):]
        return kept, (seen + len(rows),)

    return _stateful(stream, ["scene_id"], "seen long", _ddl(stream), step)


def warmup_batch(frames: DataFrame, skip: int) -> DataFrame:
    placed = scan(frames, ["scene_id"], ["seq"], index_block(F.col("seq")), index="_i")
    return placed.where(F.col("_i") >= skip).drop("_i")


def throttle(stream: DataFrame, interval_s: float, cap: int = 0) -> DataFrame:
    """Keep a frame when at least ``interval_s`` passed since the last kept one; stop at ``cap`` frames."""

    def step(rows, state):
        last, count = (None, 0) if state is None else state
        flags = []
        for moment in rows["ts"].astype("datetime64[us]").astype("int64").tolist():
            keep = (last is None or (moment - last) / 1e6 >= interval_s) and (cap <= 0 or count < cap)
            flags.append(keep)
            if keep:
                last, count = moment, count + 1
        return rows[flags], (last, count)

    return _stateful(stream, ["scene_id"], "last long, kept long", _ddl(stream), step)


def throttle_batch(frames: DataFrame, interval_s: float, cap: int = 0, keys: tuple[str, ...] = ("scene_id",), block_rows: int = FRAMES_PER_BLOCK) -> DataFrame:
    """The same rule over a stored table (``seq`` orders a scene, ``ts`` is a timestamp).

    The successor of every row is found by a sorted search, and the kept ones by doubled steps.
    """
    keys = list(keys)
    moments = frames.select(*keys, "seq", F.unix_micros(F.col("ts").cast("timestamp")).alias("moment"))
    placed = scan(moments, keys, ["seq"], index="_i")
    chosen = last_kept(placed, keys, "_i", index_block(F.col("_i"), block_rows), ["moment"], Spacing("moment", math.ceil(round(interval_s * 1e6, 3)))).where("kept")
    kept = placed.join(chosen.select(*keys, "_i"), [*keys, "_i"], "left_semi").select(*keys, "seq")
    if cap > 0:
        kept = scan(kept, keys, ["seq"], index_block(F.col("seq")), index="_i").where(F.col("_i") < cap).drop("_i")
    return frames.join(kept, [*keys, "seq"], "left_semi")


def online_gate(stream: DataFrame) -> DataFrame:
    """Motion rules on a stream of measured masks, against the last good frame of the instance.

    stream  ``scene_id, instance_id, seq, ts, area, cx, cy, usable, registration, diagonal,
            min_ratio, max_ratio, max_shift``; ``usable`` = passed the rules of a single frame
    Adds ``ref_area, ref_cx, ref_cy`` (the frame compared with) and ``good``.
    """
    output = _ddl(stream) + ", ref_area double, ref_cx double, ref_cy double, good boolean"

    limits = {"_min_ratio": "min_ratio", "_max_ratio": "max_ratio", "_max_shift": "max_shift", "_diagonal": "diagonal", "area": "area", "x": "cx", "y": "cy"}

    def step(rows, state):
        ref = None if state is None or state[0] is None else state
        n = len(rows)
        columns = {name: rows[source].to_numpy(dtype="float64", na_value=np.nan) for name, source in limits.items()}
        columns |= {"_usable": rows["usable"].fillna(False).to_numpy(bool), "_first": rows["registration"].fillna(False).to_numpy(bool), "pose": np.zeros((n, 0))}
        held = dict(zip(("area", "x", "y"), ref or (np.nan,) * 3))
        seeds = {name: np.array([value]) for name, value in held.items()} | {"pose": np.zeros((1, 0))}
        good = kept_rows(Motion(), columns, np.array([0]), seeds, np.array([ref is not None]))
        last = np.maximum.accumulate(np.where(good, np.arange(n), -1))
        before = np.concatenate([[-1], last[:-1]])
        added = {f"ref_{source}": np.where(before >= 0, columns[name][before], held[name]) for name, source in (("area", "area"), ("x", "cx"), ("y", "cy"))}
        end = int(last[-1])
        renewed = tuple(float(columns[name][end]) for name in ("area", "x", "y")) if end >= 0 else ref or (None, None, None)
        return pd.concat([rows, pd.DataFrame(added | {"good": good}, index=rows.index)], axis=1), renewed

    return _stateful(stream, ["scene_id", "instance_id"], "area double, cx double, cy double", output, step)


def capture_status(stream: DataFrame) -> DataFrame:
    """Saved frames and last time per scene, for update mode."""
    return stream.groupBy("scene_id").agg(F.count(F.lit(1)).alias("saved_frames"), F.max("ts").alias("last_ts"), F.max("seq").alias("last_seq"))


def keep_status(path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body for update mode: the changed rows of a batch, in a folder named by its number.

    A batch that is run again replaces its own folder, so every batch counts once.
    """

    def run(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={number}")

    return run


def read_status(spark: SparkSession, path: str, keys: tuple[str, ...] = ("scene_id",)) -> DataFrame:
    """The newest row of every key that ``keep_status`` wrote."""
    rows = spark.read.parquet(path)
    fields = [c for c in rows.columns if c not in (*keys, "batch")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*fields), "batch").alias("r")).select(*keys, "r.*")


def resume_point(saved: DataFrame) -> DataFrame:
    """Next frame number per scene after a stop (stored frames decide)."""
    number = F.col("frame_id").try_cast("long")
    return saved.groupBy("scene_id").agg((F.coalesce(F.max(number), F.lit(-1)) + 1).alias("next_index"), F.count(F.lit(1)).alias("saved_frames"))


def measure_batches(runs: DataFrame, intrinsics: dict, width: int, height: int, sink: Callable[[DataFrame, int], None]):
    """``foreachBatch`` body: distance of every detected instance of the arriving scan lines."""
    from ..operators.depth import measure_instances

    def run(batch: DataFrame, epoch: int) -> None:
        frames = batch.select("scene_id", "frame_id").distinct()
        masks = runs.join(frames, ["scene_id", "frame_id"], "left_semi")
        sink(measure_instances(masks, batch, intrinsics, width, height), epoch)

    return run


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
