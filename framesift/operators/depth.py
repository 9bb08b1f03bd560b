"""Depth readings under masks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.geometry import back_project
from ..session import stored
from .masks import MASK, TILE, erode, tiles


def under_mask(mask_tiles: DataFrame, depth_rows: DataFrame, keys: Sequence[str] = MASK) -> DataFrame:
    """Depth of every mask pixel: ``keys, y, x, depth_mm`` (null outside the raster)."""
    lines = depth_rows.select("scene_id", "frame_id", "y", "depth_mm")
    piece = mask_tiles.join(lines, ["scene_id", "frame_id", "y"])
    values = F.slice("depth_mm", F.col("tile") * TILE + 1, TILE)
    chosen = F.filter(
        F.transform(values, lambda d, i: F.struct((F.col("tile") * TILE + i).cast("int").alias("x"), d.alias("d"), i.alias("i"))),
        lambda p: F.call_function("getbit", F.col("bits"), p["i"]) == 1,
    )
    return piece.select(*keys, "y", F.explode(chosen).alias("p")).select(
        *keys, "y", F.col("p.x").alias("x"), F.col("p.d").alias("depth_mm")
    )


def _bits(values: Column, test) -> Column:
    """The readings of a tile that pass ``test`` as bits, the first reading lowest; null for null."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    return F.aggregate(F.reverse(values), none, lambda done, d: F.shiftleft(done, 1).bitwiseOR(F.when(test(d), one).otherwise(none)))


def coverage(mask_tiles: DataFrame, depth_rows: DataFrame, keys: Sequence[str] = MASK) -> DataFrame:
    """Valid depth pixels of each mask and their share, without exploding pixels."""
    # valid pixels of a line as bits per tile, once for all masks of the frame
    starts = F.sequence(F.lit(0), F.floor((F.size("depth_mm") - 1) / TILE).cast("int"))
    word = lambda t: _bits(F.slice("depth_mm", t * TILE + 1, TILE), lambda d: d > 0)
    lines = depth_rows.select("scene_id", "frame_id", "y", "depth_mm")
    words = F.when(F.size("depth_mm") > 0, F.transform(starts, word)).when(F.col("depth_mm").isNotNull(), F.array().cast("array<bigint>"))
    lines = lines.select("scene_id", "frame_id", "y", words.alias("valid"))
    joined = mask_tiles.join(lines, ["scene_id", "frame_id", "y"], "left")
    seen = F.bit_count(F.col("bits").bitwiseAND(F.coalesce(F.get("valid", F.col("tile").cast("int")), F.lit(0).cast("long"))))
    return joined.groupBy(*keys).agg(
        F.sum(seen).cast("long").alias("depth_valid_pixels"),
        (F.sum(seen) / F.greatest(F.sum(F.bit_count("bits")), F.lit(1))).alias("depth_coverage"),
    )


def residuals(pixel_rows: DataFrame, keys: Sequence[str] = MASK) -> DataFrame:
    """Coverage, median absolute and RMS residual from pixel rows.

    pixel_rows  ``keys, rendered_m, observed_m``; both must be positive to compare.
    A mask is bounded by its image, so the exact percentile buffer is as well.
    """
    usable = (F.col("rendered_m") > 0) & (F.col("observed_m") > 0)
    difference = F.when(usable, F.col("rendered_m") - F.col("observed_m"))
    return pixel_rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("mask_area"),
        F.count(difference).alias("depth_valid_pixels"),
        (F.count(difference) / F.greatest(F.count(F.lit(1)), F.lit(1))).alias("depth_coverage"),
        F.percentile(F.abs(difference), 0.5).alias("depth_median_abs_m"),
        F.sqrt(F.avg(difference * difference)).alias("depth_rmse_m"),
    )


def frame_depth_ratios(depth_rows: DataFrame, min_mm: int = 100, max_mm: int = 5000) -> DataFrame:
    """Share of positive and of in-range readings per frame."""
    size = F.size("depth_mm")

    def matching(test):
        return F.size(F.filter("depth_mm", test))

    return depth_rows.groupBy("scene_id", "frame_id").agg(
        (F.sum(matching(lambda d: d > 0)) / F.sum(size)).alias("depth_valid_ratio"),
        (F.sum(matching(lambda d: (d >= min_mm) & (d <= max_mm))) / F.sum(size)).alias("valid_depth_ratio"),
    )


def measure_instances(
    runs: DataFrame,
    depth_rows: DataFrame,
    intrinsics: dict[str, float],
    width: int,
    height: int,
    *,
    min_mm: int = 100,
    max_mm: int = 5000,
    min_pixels: int = 20,
    keys: Sequence[str] = MASK,
) -> DataFrame:
    """Median X, Y, Z in metres of each mask.

    Valid pixels left by a 3x3 erosion are used when there are enough of them, else all
    valid pixels; with too few of those the result is null.  Which of the two applies is
    decided on bit counts per tile; only the pixels that count are unfolded.
    """
    keys = list(keys)
    merged = stored(tiles(runs, keys))
    inner = erode(merged, width, height, keys).withColumnRenamed("bits", "inner")
    lines = depth_rows.select("scene_id", "frame_id", "y", "depth_mm")
    rows = merged.join(inner, [*keys, "y", "tile"], "left").join(lines, ["scene_id", "frame_id", "y"], "left")
    rows = rows.withColumn("d", F.slice("depth_mm", F.col("tile").cast("int") * TILE + 1, TILE)).drop("depth_mm")
    zero = F.lit(0).cast("long")
    valid = F.coalesce(_bits(F.col("d"), lambda d: d.between(min_mm, max_mm)), zero)
    rows = rows.withColumn("_all", F.col("bits").bitwiseAND(valid)).withColumn("_in", F.coalesce("inner", zero).bitwiseAND(F.col("_all")))
    mask = Window.partitionBy(*keys)  # tiles of one mask: bounded by its image
    rows = rows.withColumns({"_n_all": F.sum(F.bit_count("_all")).over(mask), "_n_in": F.sum(F.bit_count("_in")).over(mask)})
    enough = F.col("_n_in") >= min_pixels
    rows = rows.withColumns({"used": F.when(enough, F.col("_n_in")).otherwise(F.col("_n_all")), "pick": F.when(enough, F.col("_in")).otherwise(F.col("_all"))})
    fx, fy, cx, cy = (F.lit(float(intrinsics[k])) for k in ("fx", "fy", "cx", "cy"))

    def point(place):
        z = F.get("d", place).cast("double") * F.lit(0.001)
        x = F.col("tile") * TILE + place
        return F.struct(back_project(x, cx, z, fx).alias("x"), back_project(F.col("y"), cy, z, fy).alias("y"), z.alias("z"))

    places = F.filter(F.sequence(F.lit(0), F.lit(TILE - 1)), lambda i: F.call_function("getbit", F.col("pick"), i) == 1)
    points = rows.select(*keys, "used", F.when(F.col("used") >= min_pixels, F.transform(places, point)).alias("p"))
    # the pixels of a mask travel as lists: its image bounds them
    gathered = points.groupBy(*keys).agg(F.max("used").alias("valid_pixels"), F.flatten(F.collect_list("p")).alias("p"))
    return gathered.select(*keys, "valid_pixels", *[_median(F.col("p")[part]).alias(name) for part, name in (("x", "x_m"), ("y", "y_m"), ("z", "depth_m"))])


def _median(values: Column) -> Column:
    """Interpolated median of a list of numbers; null for an empty one."""
    half = lambda s, extra: F.get(s, F.floor((F.size(s) - 1 + extra) / 2).cast("int"))
    # the list is sorted once, however often it is named
    return F.get(F.transform(F.array(F.sort_array(values)), lambda s: half(s, 0) * 0.5 + half(s, 1) * 0.5), 0)


def flow_in_seed(flow: DataFrame, seed: DataFrame, width: int, height: int, limit: float = 0.35) -> DataFrame:
    """Motion statistics of the flow inside a warped seed and the limit check.

    A seed that holds the ``length`` of the flow (``warp(lengths=True)``) is not joined to the flow again.
    Equal lengths are counted before the quantiles, so no mask brings its pixels to the shuffle.
    """
    if "length" in seed.columns:
        inside = seed
    else:
        inside = flow.withColumn("length", F.hypot("dx", "dy")).join(seed.select(*MASK, "y", "x"), [*MASK, "y", "x"])
    diagonal = max(float(width * width + height * height) ** 0.5, 1.0)
    stats = inside.groupBy(*MASK, "length").agg(F.count(F.lit(1)).alias("n")).groupBy(*MASK).agg(
        F.sum("n").alias("seed_area"),
        F.percentile("length", 0.5, F.col("n")).alias("flow_median_px"),
        F.percentile("length", 0.95, F.col("n")).alias("flow_p95_px"),
    )
    shift = F.col("flow_p95_px") / F.lit(diagonal)
    everything = flow.select(*MASK).distinct().join(stats, list(MASK), "left")
    return everything.select(
        *MASK,
        F.coalesce("seed_area", F.lit(0)).alias("seed_area"),
        "flow_median_px",
        "flow_p95_px",
        shift.alias("flow_p95_shift_norm"),
        F.when(F.col("seed_area").isNull(), F.lit("recovery_seed_empty"))
        .when(shift > limit, F.lit("recovery_flow_shift_too_large"))
        .alias("reason"),
    )
