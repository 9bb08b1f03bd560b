"""Joins in bounded parts, tiles made once, pixels that travel as lists."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from framesift.operators import annotate, depth, masks, segments


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_usable_segments_join_in_parts_that_grow_with_the_frames(spark, monkeypatch):
    frames = spark.range(600).select(F.lit("s").alias("scene_id"), F.format_string("%06d", F.col("id")).alias("frame_id"))
    listed = frames.where("frame_id < '000590'").select(
        "scene_id", F.col("frame_id").alias("segment_id"), F.lit(0).alias("list_pos"),
        F.format_string("%06d", F.col("frame_id").cast("int") + 5).alias("start_id"), F.col("frame_id").alias("end_id"),
    )
    monkeypatch.setattr(segments, "JOIN_ROWS", 100, raising=False)
    found = segments.usable_segments(listed, frames)
    rows = found.collect()
    assert len(rows) == 590 and all((r.start_pos, r.end_pos) == (int(r.segment_id), int(r.segment_id) + 5) for r in rows)
    assert all(r.start_id == r.segment_id for r in rows)
    joins = [line for line in _plan(found).splitlines() if "RepartitionByExpression" in line]
    assert len(joins) >= 4 and all(line.rstrip().endswith(", 6") for line in joins)


def _rasters(spark, width=70, height=6):
    rng = random.Random(3)
    runs = [("s", "f", f"m{m}", y, x, x + rng.randint(1, 20)) for m in range(3) for y in range(height) for x in [rng.randint(0, 50)] + [rng.randint(0, 50)] * (y % 2)]
    runs = [r for r in runs if (r[2], r[3]) != ("m2", 3)] + [("s", "f", "tiny", 0, 3, 5)]
    lines = [("s", "f", y, [rng.choice([0, 50, 900, 1700, 4000, 9000, None]) for _ in range(width)]) for y in range(height - 1)]
    table = spark.createDataFrame(runs, "scene_id string, frame_id string, instance_id string, y int, x_start int, x_end int")
    pixels = {}
    for _, _, m, y, a, b in runs:
        pixels.setdefault(m, set()).update((y, x) for x in range(a, b))
    return table, spark.createDataFrame(lines, "scene_id string, frame_id string, y int, depth_mm array<int>"), pixels, {y: d for _, _, y, d in lines}


def test_coverage_and_medians_equal_pixel_loops(spark):
    runs, lines, pixels, depths = _rasters(spark)
    at = lambda y, x: (depths[y][x] if y in depths and x < len(depths[y]) else None) or 0
    for r in depth.coverage(masks.tiles(runs), lines).collect():
        valid = sum(at(y, x) > 0 for y, x in pixels[r.instance_id])
        assert (r.depth_valid_pixels, r.depth_coverage) == (valid, pytest.approx(valid / len(pixels[r.instance_id])))
    found = depth.measure_instances(runs, lines, {"fx": 100.0, "fy": 50.0, "cx": 30.0, "cy": 2.0}, 70, 6, min_pixels=5)
    assert "Generate" not in _plan(found).split("Join")[0]  # no pixel rows
    around = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1)]
    seen = set()
    for r in found.collect():
        mask = pixels[r.instance_id]
        inner = {(y, x) for y, x in mask if all((y + a, x + b) in mask or not (0 <= y + a < 6 and 0 <= x + b < 70) for a, b in around)}
        good = lambda ps: [(y, x, at(y, x)) for y, x in ps if 100 <= at(y, x) <= 5000]
        used = good(inner) if len(good(inner)) >= 5 else good(mask)
        seen.add(r.instance_id)
        assert r.valid_pixels == len(used)
        if len(used) < 5:
            assert (r.x_m, r.y_m, r.depth_m) == (None, None, None)
            continue
        z = [d * 0.001 for *_, d in used]
        assert r.depth_m == pytest.approx(statistics.median(z))
        assert r.x_m == pytest.approx(statistics.median((x - 30) * d / 100 for (_, x, _), d in zip(used, z, strict=True)))
        assert r.y_m == pytest.approx(statistics.median((y - 2) * d / 50 for (y, _, _), d in zip(used, z, strict=True)))
    assert seen == set(pixels)


def test_tiles_are_taken_as_they_are(spark):
    runs, lines, _, _ = _rasters(spark)
    tiles = masks.tiles(runs)
    assert masks.tiles(tiles) is tiles
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(annotate.measure_masks(tiles, lines)) == rows(annotate.measure_masks(runs, lines))
