"""Mask algebra on pixel tiles.

A mask arrives as half-open horizontal runs ``(y, x_start, x_end)``.  The
working form is a table of tiles: 32 neighbouring pixels of one row as the bits
of one integer.  Overlapping runs merge by ``bit_or``, which combines
map-side; areas are bit counts; the intersection of two masks is an equi-join on
(frame, row, tile) followed by a bitwise AND, so neither a range join nor a pixel
explosion is needed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

TILE = 32
SHIFT = 5  # TILE as a power of two
FULL = (1 << TILE) - 1
FRAME = ("scene_id", "frame_id")
MASK = ("scene_id", "frame_id", "instance_id")


def _ones(count: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), count.cast("int")) - F.lit(1)


def tiles(runs: DataFrame, keys: Sequence[str] = MASK) -> DataFrame:
    """``keys, y, tile, bits`` with one row per non-empty tile; tiles stay as they are."""
    if "bits" in runs.columns:
        return runs
    first, last = F.floor(F.col("x_start") / TILE), F.floor((F.col("x_end") - 1) / TILE)
    spread = runs.where(F.col("x_end") > F.col("x_start")).select(
        *keys, "y", "x_start", "x_end", F.explode(F.sequence(first.cast("int"), last.cast("int"))).alias("tile")
    )
    origin = F.col("tile") * TILE
    low = F.greatest(F.col("x_start") - origin, F.lit(0))
    high = F.least(F.col("x_end") - origin, F.lit(TILE))
    bits = F.call_function("shiftleft", _ones(high - low), low.cast("int"))
    return spread.groupBy(*keys, "y", "tile").agg(F.bit_or(bits).alias("bits"))


def area_and_box(runs: DataFrame, keys: Sequence[str] = MASK) -> DataFrame:
    """Area from merged tiles and bounding box ``[x1, y1, x2, y2)`` per mask."""
    merged = tiles(runs, keys)
    # lowest set bit is b & -b; the highest one is the length of the binary text
    low = F.log2(F.col("bits").bitwiseAND(-F.col("bits")).cast("double")).cast("int")
    high = F.length(F.bin("bits"))
    return merged.groupBy(*keys).agg(
        F.sum(F.bit_count("bits")).cast("long").alias("mask_area"),
        F.min(F.col("tile") * TILE + low).cast("int").alias("x1"),
        F.min("y").cast("int").alias("y1"),
        F.max(F.col("tile") * TILE + high).cast("int").alias("x2"),
        (F.max("y") + 1).cast("int").alias("y2"),
    )


def areas(mask_tiles: DataFrame, keys: Sequence[str] = MASK) -> DataFrame:
    """Pixel count of each mask."""
    return mask_tiles.groupBy(*keys).agg(F.sum(F.bit_count("bits")).cast("long").alias("mask_area"))


def pair_overlaps(mask_tiles: DataFrame, order: str = "instance_id") -> DataFrame:
    """Intersection size of every two masks of a frame that share a pixel.

    ``order`` ranks the instances of a frame; the pair is listed once with the
    lower rank as ``a``.
    """
    a = mask_tiles.select(*FRAME, "y", "tile", F.col("instance_id").alias("a"), F.col(order).alias("oa"), F.col("bits").alias("ba"))
    b = mask_tiles.select(*FRAME, "y", "tile", F.col("instance_id").alias("b"), F.col(order).alias("ob"), F.col("bits").alias("bb"))
    common = F.col("ba").bitwiseAND(F.col("bb"))
    return (
        a.join(b, [*FRAME, "y", "tile"])
        .where((F.col("oa") < F.col("ob")) & (common != 0))
        .groupBy(*FRAME, "a", "b")
        .agg(F.sum(F.bit_count(common)).cast("long").alias("intersection"))
    )


def overlap_ratios(pairs: DataFrame, mask_areas: DataFrame) -> DataFrame:
    """Adds ``overlap`` (over the smaller mask) and ``iou`` to intersecting pairs."""
    first = mask_areas.select(*FRAME, F.col("instance_id").alias("a"), F.col("mask_area").alias("area_a"))
    second = mask_areas.select(*FRAME, F.col("instance_id").alias("b"), F.col("mask_area").alias("area_b"))
    joined = pairs.join(first, [*FRAME, "a"]).join(second, [*FRAME, "b"])
    return joined.select(
        *FRAME,
        "a",
        "b",
        "intersection",
        (F.col("intersection") / F.least("area_a", "area_b")).alias("overlap"),
        (F.col("intersection") / (F.col("area_a") + F.col("area_b") - F.col("intersection"))).alias("iou"),
    )


def iou_between(left: DataFrame, right: DataFrame, keys: Sequence[str] = MASK) -> DataFrame:
    """IoU of two masks with the same key; 0 when one is empty or absent."""
    keys = list(keys)
    both = left.select(*keys, "y", "tile", F.col("bits").alias("bl")).join(
        right.select(*keys, "y", "tile", F.col("bits").alias("br")), [*keys, "y", "tile"], "full_outer"
    )
    bl, br = F.coalesce("bl", F.lit(0)), F.coalesce("br", F.lit(0))
    sizes = both.groupBy(*keys).agg(
        F.sum(F.bit_count(bl.bitwiseAND(br))).alias("i"), F.sum(F.bit_count(bl.bitwiseOR(br))).alias("u")
    )
    return sizes.select(*keys, F.when(F.col("u") > 0, F.col("i") / F.col("u")).otherwise(F.lit(0.0)).alias("iou"))


def erode(mask_tiles: DataFrame, width: int, height: int, keys: Sequence[str] = MASK) -> DataFrame:
    """3x3 erosion; pixels outside the image do not erode."""
    keys = list(keys)
    last_tile, used = (width - 1) // TILE, (width - 1) % TILE + 1
    row = Window.partitionBy(*keys, "y").orderBy("tile")  # at most width / 32 tiles

    def beside(offset: int) -> Column:
        fn = F.lag if offset < 0 else F.lead
        hit = fn("tile").over(row) == F.col("tile") + offset
        return F.when(hit, fn("bits").over(row)).otherwise(F.lit(0).cast("long"))

    bits = F.col("bits")
    edge_left = F.when(F.col("tile") == 0, F.lit(1)).otherwise(F.shiftrightunsigned(beside(-1), TILE - 1).bitwiseAND(1))
    from_left = F.shiftleft(bits, 1).bitwiseOR(edge_left).bitwiseAND(FULL)
    edge_right = F.shiftleft(beside(1).bitwiseAND(1), TILE - 1)
    outside = F.when(F.col("tile") == last_tile, F.lit(1 << (used - 1)).cast("long")).otherwise(F.lit(0).cast("long"))
    from_right = F.shiftrightunsigned(bits, 1).bitwiseOR(edge_right).bitwiseOR(outside)
    thin = mask_tiles.select(*keys, "y", "tile", bits.bitwiseAND(from_left).bitwiseAND(from_right).alias("bits"))

    # each row votes for itself and its two neighbours; three votes keep a pixel
    votes = thin.select(*keys, "tile", "bits", F.explode(F.array(F.col("y") - 1, F.col("y"), F.col("y") + 1)).alias("y"))
    votes = votes.where((F.col("y") >= 0) & (F.col("y") < height))
    needed = F.lit(3) - (F.col("y") == 0).cast("int") - (F.col("y") == height - 1).cast("int")
    kept = votes.groupBy(*keys, "y", "tile").agg(F.bit_and("bits").alias("bits"), F.count(F.lit(1)).alias("n"))
    return kept.where((F.col("n") == needed) & (F.col("bits") != 0)).select(*keys, "y", "tile", "bits")


def pixels(mask_tiles: DataFrame, keys: Sequence[str] = MASK) -> DataFrame:
    """One row ``keys, y, x`` per mask pixel."""
    inside = F.filter(
        F.sequence(F.lit(0), F.lit(TILE - 1)),
        lambda i: F.call_function("getbit", F.col("bits"), i) == 1,
    )
    return mask_tiles.select(*keys, "y", "tile", F.explode(inside).alias("_i")).select(
        *keys, "y", (F.col("tile") * TILE + F.col("_i")).cast("int").alias("x")
    )


def tiled_flow(flow: DataFrame) -> DataFrame:
    """Pixel rows of a flow as one row per tile: ``MASK, prev_frame_id, y, tile, moves``.

    ``moves`` lists ``x, dx, dy`` of the pixels of the tile that have a flow.
    """
    if "moves" in flow.columns:
        return flow
    tile = F.floor(F.col("x") / TILE).cast("int").alias("tile")
    return flow.groupBy(*MASK, "prev_frame_id", "y", tile).agg(F.collect_list(F.struct("x", "dx", "dy")).alias("moves"))


def warp(mask_tiles: DataFrame, flow: DataFrame, lengths: bool = False) -> DataFrame:
    """Gather a mask of the previous frame along a backward flow.

    flow     ``scene_id, frame_id, instance_id, prev_frame_id, y, x, dx, dy``: pixel (x, y) of
             the frame takes the value at (x + dx, y + dy) of the previous frame; or the same
             per tile (``tiled_flow``)
    lengths  also give the ``length`` of the flow at each pixel
    Coordinates round half to even; positions outside are empty.

    Pixels travel as lists, one row per tile and tile they look at; they are unfolded after the join.
    """
    def target(m: Column) -> Column:
        sx, sy = F.rint(m["x"] + m["dx"]).cast("int"), F.rint(F.col("y") + m["dy"]).cast("int")
        inside = (sx >= 0) & (sy >= 0)
        # the row and tile looked at in one number; both places inside a tile in another
        place = F.shiftleft(sy.cast("long"), 32).bitwiseOR(F.shiftright(sx, SHIFT).cast("long"))
        bits = (F.pmod(m["x"], F.lit(TILE)) * TILE + sx % TILE).cast("int")
        parts = [F.when(inside, place).alias("place"), bits.alias("at")]
        return F.struct(*parts, *([F.hypot(m["dx"], m["dy"]).alias("length")] if lengths else []))

    fixed = [*MASK, "prev_frame_id", "y", "tile"]
    targets = tiled_flow(flow).select(*fixed, F.filter(F.transform("moves", target), lambda t: t["place"].isNotNull()).alias("targets"))
    source = targets.select(*fixed, "targets", F.explode(F.array_distinct("targets.place")).alias("place"))
    here = F.filter("targets", lambda t: t["place"] == F.col("place"))
    lists = [here["at"].alias("at")] + ([here["length"].alias("length")] if lengths else [])
    source = source.select(*fixed, F.shiftright("place", 32).cast("int").alias("sy"), F.col("place").bitwiseAND((1 << 32) - 1).cast("int").alias("st"), *lists)
    before = mask_tiles.select(
        "scene_id",
        F.col("frame_id").alias("prev_frame_id"),
        "instance_id",
        F.col("y").alias("sy"),
        F.col("tile").cast("int").alias("st"),
        "bits",
    )
    hit = source.join(before, ["scene_id", "prev_frame_id", "instance_id", "sy", "st"])
    listed = F.arrays_zip("at", "length") if lengths else F.transform("at", lambda a: F.struct(a.alias("at")))
    set_ = F.filter(listed, lambda p: F.call_function("getbit", F.col("bits"), p["at"] % TILE) == 1)
    found = hit.select(*MASK, "y", "tile", F.explode(set_).alias("p"))
    x = (F.col("tile") * TILE + F.shiftright("p.at", SHIFT)).cast("int").alias("x")
    return found.select(*MASK, "y", x, *(["p.length"] if lengths else []))


def merged_runs(mask_tiles: DataFrame, keys: Sequence[str] = MASK) -> DataFrame:
    """Maximal disjoint runs per row, from tiles (at most width / 2 per row)."""
    keys = list(keys)
    bits = F.col("bits")
    before = F.shiftleft(bits, 1).bitwiseAND(FULL)
    starts, ends = bits.bitwiseAND(F.bitwise_not(before)), bits.bitwiseAND(F.bitwise_not(F.shiftrightunsigned(bits, 1)))

    def positions(mask: Column) -> Column:
        return F.filter(F.sequence(F.lit(0), F.lit(TILE - 1)), lambda i: F.call_function("getbit", mask, i) == 1)

    origin = F.col("tile") * TILE
    parts = mask_tiles.select(
        *keys, "y", "tile", F.explode(F.arrays_zip(positions(starts).alias("s"), positions(ends).alias("e"))).alias("r")
    ).select(*keys, "y", (origin + F.col("r.s")).cast("int").alias("x_start"), (origin + F.col("r.e") + 1).cast("int").alias("x_end"))
    row = Window.partitionBy(*keys, "y").orderBy("x_start")
    fresh = F.when(F.lag("x_end").over(row) == F.col("x_start"), 0).otherwise(1)
    marked = parts.withColumn("_new", fresh).withColumn("_run", F.sum("_new").over(row))
    return marked.groupBy(*keys, "y", "_run").agg(F.min("x_start").alias("x_start"), F.max("x_end").alias("x_end")).drop("_run")


def _label_runs(batch: pd.DataFrame, keys: list[str]) -> pd.DataFrame:
    """8-connected components of the runs of whole masks (vectorised over masks)."""
    codes = batch.groupby(keys, sort=False).ngroup().to_numpy()
    y, xs, xe = (batch[c].to_numpy(dtype=np.int64) for c in ("y", "x_start", "x_end"))
    n = len(batch)
    # rows arrive sorted by mask, y, x_start; candidates of a run are found by binary search
    width = int(xe.max()) + 2
    height = int(y.max()) + 3
    line = (codes * height + y) * width
    first_key, last_key = line + xs, line + xe
    below = line + width
    lo = np.searchsorted(last_key, below + xs, side="left")  # ends at or after our start
    hi = np.searchsorted(first_key, below + xe, side="right")  # starts at or before our end
    counts = np.maximum(hi - lo, 0)
    source = np.repeat(np.arange(n), counts)
    target = np.repeat(lo - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())
    label = np.arange(n)
    while True:
        low = np.minimum(label[source], label[target])
        renewed = label.copy()
        np.minimum.at(renewed, label[source], low)
        np.minimum.at(renewed, label[target], low)
        renewed = renewed[renewed]
        renewed = renewed[renewed]
        if np.array_equal(renewed, label):
            break
        label = renewed
    size = np.bincount(label, weights=(xe - xs), minlength=n)
    roots = np.flatnonzero(label == np.arange(n))
    per_mask = pd.DataFrame({"code": codes[roots], "size": size[roots]}).groupby("code", sort=True)["size"]
    heads = batch.drop_duplicates(subset=keys)[keys].reset_index(drop=True)
    summary = per_mask.agg(["count", "max", "sum"]).reset_index(drop=True)
    return heads.assign(
        connected_components=summary["count"].astype("int64"),
        dominant_component_ratio=summary["max"] / summary["sum"],
    )


def fragments(mask_tiles: DataFrame, keys: Sequence[str] = MASK) -> DataFrame:
    """Number of 8-connected fragments and share of the largest, per mask.

    A mask is bounded by its image, so it is labelled inside one task; all masks
    of an Arrow batch are labelled together.
    """
    keys = list(keys)
    runs = merged_runs(mask_tiles, keys)
    schema = T.StructType(
        [runs.schema[k] for k in keys]
        + [T.StructField("connected_components", T.LongType()), T.StructField("dominant_component_ratio", T.DoubleType())]
    )

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            if batch.empty:
                continue
            frame = batch if held is None else pd.concat([held, batch], ignore_index=True)
            tail = frame[keys].iloc[-1]
            open_mask = (frame[keys] == tail).all(axis=1).to_numpy()
            held = frame[open_mask].reset_index(drop=True)
            closed = frame[~open_mask].reset_index(drop=True)
            if len(closed):
                yield _label_runs(closed, keys)
        if held is not None and len(held):
            yield _label_runs(held, keys)

    # a fixed number of tasks: the runs are few bytes, labelling them is the work
    tasks = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = runs.repartition(tasks, *keys).sortWithinPartitions(*keys, "y", "x_start")
    return ordered.mapInPandas(work, schema)
