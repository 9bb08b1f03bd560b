"""Mask algebra against pixel rasters."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from framesift import schemas
from framesift.operators import depth, masks

W, H = 75, 20


def _random_runs(seed, frames=5, names="abc", per=25):
    rng = np.random.default_rng(seed)
    rows, rasters = [], {}
    for f in range(frames):
        for name in names:
            raster = np.zeros((H, W), bool)
            for _ in range(per):
                y, a = int(rng.integers(0, H)), int(rng.integers(0, W - 1))
                b = int(min(W, a + rng.integers(1, 50)))
                raster[y, a:b] = True
                rows.append(("s", f"{f:06d}", name, y, a, b))
            rasters[(f"{f:06d}", name)] = raster
    return rows, rasters


def _runs_of(rasters):
    return [("s", f, i, int(y), int(x), int(x) + 1) for (f, i), m in rasters.items() for y, x in zip(*np.where(m))]


def test_area_box_overlap_iou(spark):
    rows, rasters = _random_runs(0)
    runs = spark.createDataFrame(rows, schemas.MASK_RUNS)
    tiles = masks.tiles(runs)
    for r in masks.area_and_box(runs).collect():
        ys, xs = np.where(rasters[(r.frame_id, r.instance_id)])
        assert (r.mask_area, r.x1, r.y1, r.x2, r.y2) == (len(xs), xs.min(), ys.min(), xs.max() + 1, ys.max() + 1)
    found = masks.overlap_ratios(masks.pair_overlaps(tiles), masks.area_and_box(runs)).collect()
    assert len(found) == 5 * 3
    for r in found:
        a, b = rasters[(r.frame_id, r.a)], rasters[(r.frame_id, r.b)]
        assert r.intersection == (a & b).sum()
        assert r.overlap == pytest.approx((a & b).sum() / min(a.sum(), b.sum()))
        assert r.iou == pytest.approx((a & b).sum() / (a | b).sum())


def test_iou_of_shifted_rectangles(spark):
    def rectangle(x1, x2):
        return [("s", "000000", "a", y, x1, x2) for y in range(12, 28)]

    left = masks.tiles(spark.createDataFrame(rectangle(10, 22), schemas.MASK_RUNS))
    right = masks.tiles(spark.createDataFrame(rectangle(14, 26), schemas.MASK_RUNS))
    assert masks.iou_between(left, right).first().iou == pytest.approx(0.5)
    assert masks.iou_between(right, left).first().iou == pytest.approx(0.5)
    none = masks.tiles(spark.createDataFrame([], schemas.MASK_RUNS))
    assert masks.iou_between(left, none).first().iou == 0.0


def test_erosion(spark):
    rasters = {}
    for n, (x1, x2, y1, y2) in enumerate([(0, 75, 0, 20), (0, 40, 3, 18), (20, 75, 5, 20), (31, 66, 2, 9)]):
        m = np.zeros((H, W), bool)
        m[y1:y2, x1:x2] = True
        m[6, 50] = False
        rasters[(f"{n:06d}", "a")] = m
    tiles = masks.tiles(spark.createDataFrame(_runs_of(rasters), schemas.MASK_RUNS))
    got = {k: np.zeros((H, W), bool) for k in rasters}
    for r in masks.pixels(masks.erode(tiles, W, H)).collect():
        got[(r.frame_id, r.instance_id)][r.y, r.x] = True
    for key, m in rasters.items():
        padded = np.pad(m, 1, constant_values=True)
        want = np.logical_and.reduce([padded[dy : dy + H, dx : dx + W] for dy in range(3) for dx in range(3)])
        assert (got[key] == want).all()


def _components(m):
    seen, sizes = np.zeros_like(m), []
    for start in zip(*np.where(m)):
        if seen[start]:
            continue
        stack, size = [start], 0
        seen[start] = True
        while stack:
            y, x = stack.pop()
            size += 1
            for v in range(max(0, y - 1), min(H, y + 2)):
                for u in range(max(0, x - 1), min(W, x + 2)):
                    if m[v, u] and not seen[v, u]:
                        seen[v, u] = True
                        stack.append((v, u))
        sizes.append(size)
    return len(sizes), max(sizes) / sum(sizes)


def test_fragments(spark):
    rng = np.random.default_rng(4)
    rasters = {(f"{f:06d}", "a"): rng.random((H, W)) < 0.25 for f in range(12)}
    tiles = masks.tiles(spark.createDataFrame(_runs_of(rasters), schemas.MASK_RUNS))
    found = masks.fragments(tiles).collect()
    assert len(found) == 12
    for r in found:
        count, share = _components(rasters[(r.frame_id, r.instance_id)])
        assert r.connected_components == count and r.dominant_component_ratio == pytest.approx(share)


def test_warp_moves_against_the_flow(spark):
    previous = [("s", "000000", "a", y, 10, 22) for y in range(12, 28)]
    tiles = masks.tiles(spark.createDataFrame(previous, schemas.MASK_RUNS))
    flow = spark.range(48 * 64).select(
        F.lit("s").alias("scene_id"), F.lit("000001").alias("frame_id"), F.lit("a").alias("instance_id"), F.lit("000000").alias("prev_frame_id"),
        F.floor(F.col("id") / 64).cast("int").alias("y"), (F.col("id") % 64).cast("int").alias("x"), F.lit(-5.0).alias("dx"), F.lit(0.0).alias("dy"),
    )
    seed = masks.warp(tiles, flow)
    assert {(r.y, r.x) for r in seed.collect()} == {(y, x) for y in range(12, 28) for x in range(15, 27)}
    stats = depth.flow_in_seed(flow, seed, 64, 48, limit=0.20).first()
    assert (stats.seed_area, stats.flow_p95_px, stats.reason) == (12 * 16, 5.0, None)
    fast = flow.withColumn("dx", F.lit(-20.0))
    assert depth.flow_in_seed(fast, masks.warp(tiles, fast), 64, 48, limit=0.20).first().reason == "recovery_flow_shift_too_large"


def test_instance_depth_ignores_outlier(spark):
    runs = [("s", "000000", "a", y, 1, 9) for y in range(1, 7)]
    rows = [("s", "000000", y, [4000 if (x, y) == (4, 3) else 1000 for x in range(10)]) for y in range(8)]
    found = depth.measure_instances(
        spark.createDataFrame(runs, schemas.MASK_RUNS), spark.createDataFrame(rows, schemas.DEPTH_ROWS),
        {"fx": 100.0, "fy": 100.0, "cx": 5.0, "cy": 4.0}, 10, 8, min_pixels=20,
    ).first()
    assert found.depth_m == pytest.approx(1.0) and found.valid_pixels == 24
    few = depth.measure_instances(
        spark.createDataFrame(runs, schemas.MASK_RUNS), spark.createDataFrame(rows, schemas.DEPTH_ROWS),
        {"fx": 100.0, "fy": 100.0, "cx": 5.0, "cy": 4.0}, 10, 8, min_pixels=60,
    ).first()
    assert few.depth_m is None


def test_warp_reads_pixel_and_tile_flows_alike(spark):
    rng = np.random.default_rng(8)
    previous = [("s", "000000", "a", y, int(x), int(x) + 9) for y in range(20) for x in rng.integers(0, 50, 2)]
    tiles = masks.tiles(spark.createDataFrame(previous, schemas.MASK_RUNS))
    rows = [("s", "000001", "a", "000000", y, x, float(rng.integers(-80, 80)) / 4, float(rng.integers(-20, 20)) / 4) for y in range(20) for x in range(64)]
    flow = spark.createDataFrame(rows, "scene_id string, frame_id string, instance_id string, prev_frame_id string, y int, x int, dx double, dy double")
    inside = {(y, x) for _, _, _, y, first, last in previous for x in range(first, last)}
    wanted = {(y, x): np.hypot(dx, dy) for *_, y, x, dx, dy in rows if (round(y + dy), round(x + dx)) in inside}
    assert {(r.y, r.x) for r in masks.warp(tiles, flow).collect()} == set(wanted)
    packed = masks.tiled_flow(flow)
    seed = masks.warp(tiles, packed, lengths=True)
    assert {(r.y, r.x): r.length for r in seed.collect()} == pytest.approx(wanted)
    # the pixels of a flow do not meet again: one joining of tiles, and none of pixels
    stats = depth.flow_in_seed(packed, seed, 64, 48)
    assert stats._jdf.queryExecution().optimizedPlan().toString().count("Join Inner") == 1
    found, plain = stats.first(), depth.flow_in_seed(flow, masks.warp(tiles, flow), 64, 48).first()
    assert found == plain and found.seed_area == len(wanted)
    assert found.flow_p95_px == pytest.approx(np.percentile(list(wanted.values()), 95))
