"""Mask algebra and depth readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..constants import MASK_SEQUENCE_THRESHOLDS
from ..operators import annotate, depth, masks
from ..operators.quality import resolve_thresholds
from ..plans.ordered import scan
from ..plans.quantiles import exact_quantiles
from ..session import cut, stored
from . import views as v

M = ("scene_id", "frame_id", "instance_id")
INTRINSICS = {"fx": 100.0, "fy": 100.0, "cx": 80.0, "cy": 12.0}


def mask_area_bbox(spark, sf_dir) -> DataFrame:
    found = masks.area_and_box(v.mask_runs(spark, sf_dir))
    return found.select(*M, "mask_area", *[v.long(c, c) for c in ("x1", "y1", "x2", "y2")])


MASK_AREA_BBOX = f"""WITH {v.PIXELS}
SELECT scene_id, frame_id, instance_id, count(*) AS mask_area, CAST(min(x) AS BIGINT) AS x1, CAST(min(y) AS BIGINT) AS y1,
       CAST(max(x) + 1 AS BIGINT) AS x2, CAST(max(y) + 1 AS BIGINT) AS y2 FROM px GROUP BY ALL"""


def _pairs(spark, sf_dir) -> DataFrame:
    tiles = masks.tiles(v.mask_runs(spark, sf_dir))
    return masks.overlap_ratios(masks.pair_overlaps(tiles), masks.areas(tiles))


def mask_overlap(spark, sf_dir) -> DataFrame:
    return _pairs(spark, sf_dir).select("scene_id", "frame_id", "a", "b", "intersection", v.r6("overlap", "overlap"), v.r6("iou", "iou"))


MASK_OVERLAP = f"""WITH {v.PIXELS}, ar AS (SELECT scene_id, frame_id, instance_id, count(*) AS n FROM px GROUP BY ALL),
i AS (SELECT p.scene_id, p.frame_id, p.instance_id AS a, q.instance_id AS b, count(*) AS k
      FROM px p JOIN px q ON p.scene_id = q.scene_id AND p.frame_id = q.frame_id AND p.y = q.y AND p.x = q.x AND p.instance_id < q.instance_id GROUP BY ALL)
SELECT i.scene_id, i.frame_id, a, b, k AS intersection, round(k / least(u.n, w.n), 6) AS overlap, round(k / (u.n + w.n - k), 6) AS iou
FROM i JOIN ar u ON u.scene_id = i.scene_id AND u.frame_id = i.frame_id AND u.instance_id = a
       JOIN ar w ON w.scene_id = i.scene_id AND w.frame_id = i.frame_id AND w.instance_id = b"""


def mask_iou(spark, sf_dir) -> DataFrame:
    """IoU of every mask with the mask of the same instance one frame earlier."""
    now = masks.tiles(v.mask_runs(spark, sf_dir))
    later = now.withColumn("frame_id", F.lpad((F.col("frame_id").cast("int") + 1).cast("string"), 6, "0"))
    later = later.withColumn("scene_id", F.concat(F.lit("s"), F.floor(F.col("frame_id").cast("int") / 50).cast("string")))
    return masks.iou_between(now, later).select(*M, v.r6("iou", "iou"))


MASK_IOU = f"""WITH {v.PIXELS}, later AS (
  SELECT 's' || ((CAST(frame_id AS BIGINT) + 1) // 50) AS scene_id, lpad(CAST(CAST(frame_id AS BIGINT) + 1 AS VARCHAR), 6, '0') AS frame_id, instance_id, y, x FROM px)
SELECT coalesce(p.scene_id, l.scene_id) AS scene_id, coalesce(p.frame_id, l.frame_id) AS frame_id, coalesce(p.instance_id, l.instance_id) AS instance_id,
       round(count(*) FILTER (p.x IS NOT NULL AND l.x IS NOT NULL) / count(*), 6) AS iou
FROM px p FULL JOIN later l ON p.frame_id = l.frame_id AND p.instance_id = l.instance_id AND p.y = l.y AND p.x = l.x GROUP BY 1, 2, 3"""


def mask_fragments(spark, sf_dir) -> DataFrame:
    found = masks.fragments(masks.tiles(v.mask_runs(spark, sf_dir)))
    return found.select(*M, "connected_components", v.r6("dominant_component_ratio", "dominant_component_ratio"))


MASK_FRAGMENTS = f"""WITH RECURSIVE {v.PIXELS}, e AS (
  SELECT *, x - row_number() OVER (PARTITION BY scene_id, frame_id, instance_id, y ORDER BY x) AS g FROM px), rn AS (
  SELECT scene_id || frame_id || instance_id AS k, scene_id, frame_id, instance_id, y, min(x) AS a, max(x) + 1 AS b FROM e GROUP BY scene_id, frame_id, instance_id, y, g), nd AS (
  SELECT *, y * 1000 + a AS id FROM rn), ed AS (
  SELECT p.k, p.id AS u, q.id AS w FROM nd p JOIN nd q ON p.k = q.k AND abs(p.y - q.y) = 1 AND p.a <= q.b AND q.a <= p.b), cl AS (
  SELECT k, id AS n, id AS l FROM nd UNION SELECT cl.k, ed.w, cl.l FROM cl JOIN ed ON ed.k = cl.k AND ed.u = cl.n AND cl.l < ed.w), lab AS (
  SELECT k, n, min(l) AS l FROM cl GROUP BY ALL), sz AS (
  SELECT nd.scene_id, nd.frame_id, nd.instance_id, fin.l, sum(b - a) AS s FROM nd JOIN lab fin ON fin.k = nd.k AND fin.n = nd.id GROUP BY ALL)
SELECT scene_id, frame_id, instance_id, count(*) AS connected_components, round(max(s) / sum(s), 6) AS dominant_component_ratio FROM sz GROUP BY ALL"""


def mask_erode(spark, sf_dir) -> DataFrame:
    thin = masks.pixels(masks.erode(masks.tiles(v.mask_runs(spark, sf_dir)), v.MASK_WIDTH, v.MASK_HEIGHT))
    return thin.groupBy(*M).agg(
        F.count(F.lit(1)).alias("eroded_area"), F.sum("x").cast("long").alias("sum_x"), F.sum("y").cast("long").alias("sum_y")
    )


_ERODED = f"""{v.PIXELS}, nb AS (
  SELECT p.scene_id, p.frame_id, p.instance_id, p.y, p.x, q.y AS qy FROM px p, (VALUES (-1), (0), (1)) dy(dy), (VALUES (-1), (0), (1)) dx(dx), px q
  WHERE q.scene_id = p.scene_id AND q.frame_id = p.frame_id AND q.instance_id = p.instance_id AND q.y = p.y + dy AND q.x = p.x + dx), er AS (
  SELECT scene_id, frame_id, instance_id, y, x FROM nb GROUP BY ALL
  HAVING count(*) = (3 - (y = 0)::INT - (y = 23)::INT) * (3 - (x = 0)::INT - (x = 159)::INT))"""
MASK_ERODE = f"""WITH {_ERODED}
SELECT scene_id, frame_id, instance_id, count(*) AS eroded_area, CAST(sum(x) AS BIGINT) AS sum_x, CAST(sum(y) AS BIGINT) AS sum_y FROM er GROUP BY ALL"""


def _flow(tiles: DataFrame) -> DataFrame:
    """Backward flow of the pixels of each mask, taken from their position, per tile."""
    number = F.col("frame_id").cast("int")
    inside = F.filter(F.sequence(F.lit(0), F.lit(masks.TILE - 1)), lambda i: F.call_function("getbit", F.col("bits"), i) == 1)

    def move(i):
        x = (F.col("tile") * masks.TILE + i).cast("int")
        return F.struct(x.alias("x"), ((x % 5 - 2) * 0.75).alias("dx"), ((F.col("y") % 3 - 1) * 0.75).alias("dy"))

    return tiles.where(number > 0).select(
        *M, F.lpad((number - 1).cast("string"), 6, "0").alias("prev_frame_id"), "y", "tile", F.transform(inside, move).alias("moves")
    )


def mask_warp(spark, sf_dir) -> DataFrame:
    t = stored(masks.tiles(v.mask_runs(spark, sf_dir)))
    seed = masks.warp(t, _flow(t))
    return seed.groupBy(*M).agg(F.count(F.lit(1)).alias("seed_area"), F.sum("x").cast("long").alias("sum_x"), F.sum("y").cast("long").alias("sum_y"))


_WARP = f"""{v.PIXELS}, fl AS (
  SELECT *, ((x % 5) - 2) * 0.75::DOUBLE AS dx, ((y % 3) - 1) * 0.75::DOUBLE AS dy FROM px WHERE CAST(frame_id AS INT) > 0), sd AS (
  SELECT fl.* FROM fl JOIN px p ON p.scene_id = fl.scene_id AND p.instance_id = fl.instance_id AND p.frame_id = lpad(CAST(CAST(fl.frame_id AS INT) - 1 AS VARCHAR), 6, '0')
    AND p.x = CAST(round_even(fl.x + dx, 0) AS BIGINT) AND p.y = CAST(round_even(fl.y + dy, 0) AS BIGINT))"""
MASK_WARP = f"""WITH {_WARP}
SELECT scene_id, frame_id, instance_id, count(*) AS seed_area, CAST(sum(x) AS BIGINT) AS sum_x, CAST(sum(y) AS BIGINT) AS sum_y FROM sd GROUP BY ALL"""


def flow_statistics(spark, sf_dir) -> DataFrame:
    t = stored(masks.tiles(v.mask_runs(spark, sf_dir)))
    flow = _flow(t)
    stats = depth.flow_in_seed(flow, masks.warp(t, flow, lengths=True), v.MASK_WIDTH, v.MASK_HEIGHT, limit=0.008)
    return stats.select(*M, v.long("seed_area", "seed_area"), *[v.r6(c, c) for c in ("flow_median_px", "flow_p95_px", "flow_p95_shift_norm")], "reason")


FLOW_STATISTICS = f"""WITH {_WARP}, st AS (
  SELECT scene_id, frame_id, instance_id, count(*) AS n, quantile_cont(sqrt(dx * dx + dy * dy), 0.5) AS med, quantile_cont(sqrt(dx * dx + dy * dy), 0.95) AS p95 FROM sd GROUP BY ALL),
al AS (SELECT DISTINCT scene_id, frame_id, instance_id FROM fl)
SELECT scene_id, frame_id, instance_id, coalesce(n, 0) AS seed_area, round(med, 6) AS flow_median_px, round(p95, 6) AS flow_p95_px,
       round(p95 / sqrt(160 * 160 + 24 * 24), 6) AS flow_p95_shift_norm,
       CASE WHEN n IS NULL THEN 'recovery_seed_empty' WHEN p95 / sqrt(160 * 160 + 24 * 24) > 0.008 THEN 'recovery_flow_shift_too_large' END AS reason
FROM al LEFT JOIN st USING (scene_id, frame_id, instance_id)"""


def depth_coverage(spark, sf_dir) -> DataFrame:
    found = depth.coverage(masks.tiles(v.mask_runs(spark, sf_dir)), v.depth_rows(spark, sf_dir))
    return found.select(*M, "depth_valid_pixels", v.r6("depth_coverage", "depth_coverage"))


DEPTH_COVERAGE = f"""WITH {v.PIXELS}
SELECT scene_id, frame_id, instance_id, count(*) FILTER ({v.DEPTH_OF_PX} > 0) AS depth_valid_pixels,
       round(count(*) FILTER ({v.DEPTH_OF_PX} > 0) / count(*), 6) AS depth_coverage FROM px GROUP BY ALL"""


def depth_residual(spark, sf_dir) -> DataFrame:
    li = v.table(spark, sf_dir, "lineitem")
    number = F.floor(F.col("l_orderkey") / 75)
    rows = li.select(
        number.cast("long").alias("frame_no"),
        (F.col("l_suppkey") % 3).alias("instance_no"),
        ((F.col("l_partkey") % 2000) / 1000.0).alias("rendered_m"),
        ((F.floor("l_extendedprice") % 6000) / 1000.0).alias("observed_m"),
    )
    found = depth.residuals(rows, ["frame_no", "instance_no"])
    return found.select(
        "frame_no", "instance_no", "mask_area", "depth_valid_pixels", *[v.r6(c, c) for c in ("depth_coverage", "depth_median_abs_m", "depth_rmse_m")]
    )


DEPTH_RESIDUAL = """WITH p AS (
  SELECT l_orderkey // 75 AS frame_no, l_suppkey % 3 AS instance_no, (l_partkey % 2000) / 1000::DOUBLE AS r, (CAST(floor(l_extendedprice) AS BIGINT) % 6000) / 1000::DOUBLE AS o FROM lineitem),
d AS (SELECT *, CASE WHEN r > 0 AND o > 0 THEN r - o END AS d FROM p)
SELECT frame_no, instance_no, count(*) AS mask_area, count(d) AS depth_valid_pixels, round(count(d) / count(*), 6) AS depth_coverage,
       round(quantile_cont(abs(d), 0.5), 6) AS depth_median_abs_m, round(sqrt(avg(d * d)), 6) AS depth_rmse_m FROM d GROUP BY ALL"""


def depth_visible(spark, sf_dir) -> DataFrame:
    """Rendered pixels that stay visible, per frame."""
    from ..functions.geometry import visible_rendered

    li = v.table(spark, sf_dir, "lineitem")
    rendered, observed = (F.col("l_partkey") % 2000) / 1000.0, (F.floor("l_extendedprice") % 6000) / 1000.0
    seen = visible_rendered(rendered, observed, F.lit(0.02))
    return li.groupBy(F.floor(F.col("l_orderkey") / 75).cast("long").alias("frame_no")).agg(
        F.count_if(seen).alias("visible_pixels"), F.count(F.lit(1)).alias("pixels")
    )


DEPTH_VISIBLE = """WITH p AS (
  SELECT l_orderkey // 75 AS frame_no, (l_partkey % 2000) / 1000::DOUBLE AS r, (CAST(floor(l_extendedprice) AS BIGINT) % 6000) / 1000::DOUBLE AS o FROM lineitem)
SELECT frame_no, count(*) FILTER (r > 0 AND (o <= 0 OR r <= o + 0.02::DOUBLE)) AS visible_pixels, count(*) AS pixels FROM p GROUP BY ALL"""


def instance_xyz(spark, sf_dir) -> DataFrame:
    found = depth.measure_instances(v.mask_runs(spark, sf_dir), v.depth_rows(spark, sf_dir), INTRINSICS, v.MASK_WIDTH, v.MASK_HEIGHT)
    return found.select(*M, v.long("valid_pixels", "valid_pixels"), *[v.r6(c, c) for c in ("x_m", "y_m", "depth_m")])


INSTANCE_XYZ = f"""WITH {_ERODED}, d AS (
  SELECT px.*, {v.DEPTH_OF_PX} AS mm, er.x IS NOT NULL AS inn FROM px LEFT JOIN er USING (scene_id, frame_id, instance_id, y, x)), q AS (
  SELECT *, mm * 0.001::DOUBLE AS z FROM d WHERE mm BETWEEN 100 AND 5000), n AS (
  SELECT scene_id, frame_id, instance_id, count(*) AS na, count(*) FILTER (inn) AS ni FROM q GROUP BY ALL), u AS (
  SELECT q.*, CASE WHEN ni >= 20 THEN ni ELSE na END AS used FROM q JOIN n USING (scene_id, frame_id, instance_id) WHERE ni < 20 OR inn), f AS (
  SELECT scene_id, frame_id, instance_id, used, quantile_cont((x - 80) * z / 100, 0.5) AS x_m, quantile_cont((y - 12) * z / 100, 0.5) AS y_m, quantile_cont(z, 0.5) AS depth_m
  FROM u GROUP BY ALL), al AS (SELECT DISTINCT scene_id, frame_id, instance_id FROM px)
SELECT scene_id, frame_id, instance_id, coalesce(used, 0) AS valid_pixels, CASE WHEN used >= 20 THEN round(x_m, 6) END AS x_m,
       CASE WHEN used >= 20 THEN round(y_m, 6) END AS y_m, CASE WHEN used >= 20 THEN round(depth_m, 6) END AS depth_m
FROM al LEFT JOIN f USING (scene_id, frame_id, instance_id)"""


def frame_depth_ratios(spark, sf_dir) -> DataFrame:
    found = depth.frame_depth_ratios(v.depth_rows(spark, sf_dir), 100, 5000)
    return found.select("scene_id", "frame_id", v.r6("depth_valid_ratio", "depth_valid_ratio"), v.r6("valid_depth_ratio", "valid_depth_ratio"))


FRAME_DEPTH_RATIOS = f"""WITH {v.RUNS}, ln AS (SELECT DISTINCT scene_id, frame_id, y FROM runs), p AS (
  SELECT *, unnest(range(0, 160)) AS x FROM ln), d AS (SELECT *, {v.DEPTH_OF_PX} AS mm FROM p)
SELECT scene_id, frame_id, round(count(*) FILTER (mm > 0) / count(*), 6) AS depth_valid_ratio,
       round(count(*) FILTER (mm BETWEEN 100 AND 5000) / count(*), 6) AS valid_depth_ratio FROM d GROUP BY ALL"""


def depth_to_mm(spark, sf_dir) -> DataFrame:
    """Sensor readings in millimetres, counted per value."""
    from ..functions.geometry import depth_scale
    from ..functions.geometry import depth_to_mm as to_mm

    li = v.table(spark, sf_dir, "lineitem")
    scale = depth_scale(F.when(F.col("l_suppkey") % 4 == 0, F.lit(0.5)), F.when(F.col("l_suppkey") % 4 == 1, F.lit(2.0)))
    return li.groupBy(to_mm(F.col("l_extendedprice"), scale).alias("depth_mm")).agg(F.count(F.lit(1)).alias("readings"))


DEPTH_TO_MM = """SELECT CAST(least(greatest(round_even(l_extendedprice * (CASE l_suppkey % 4 WHEN 0 THEN 0.5::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 0.001::DOUBLE END), 0), 0), 65535) AS INT) AS depth_mm,
       count(*) AS readings FROM lineitem GROUP BY 1"""


def depth_quantiles(spark, sf_dir) -> DataFrame:
    """Exact quantiles of all readings of a supplier camera."""
    li = v.table(spark, sf_dir, "lineitem")
    found = exact_quantiles(li, ["l_returnflag"], "l_extendedprice", {"median": 0.5, "p95": 0.95}, count="readings")
    return found.select("l_returnflag", "readings", v.r6("median", "median"), v.r6("p95", "p95"))


DEPTH_QUANTILES = """SELECT l_returnflag, count(l_extendedprice) AS readings, round(quantile_cont(l_extendedprice, 0.5), 6) AS median,
       round(quantile_cont(l_extendedprice, 0.95), 6) AS p95 FROM lineitem GROUP BY 1"""


def _annotation(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Frames, instances, mask files and runs of the drawn masks."""
    runs = v.mask_runs(spark, sf_dir)
    files = cut(runs.select(*M).distinct())
    frames = scan(files.select("scene_id", "frame_id").distinct(), ["scene_id"], ["frame_id"], index="frame_index")
    frames = frames.withColumns({"width": F.lit(v.MASK_WIDTH), "height": F.lit(v.MASK_HEIGHT)})
    names = F.array(*[F.struct(F.lit(f"m{i}").alias("instance_id"), F.lit(i).alias("ord"), F.lit(i).alias("class_id"), F.lit(0).alias("start"), F.lit(0).alias("max_frames")) for i in range(3)])
    instances = files.select("scene_id").distinct().select("scene_id", F.inline(names))
    return frames, instances, files, runs


def _scored(spark, sf_dir):
    frames, instances, files, runs = _annotation(spark, sf_dir)
    tiles = cut(masks.tiles(runs))  # for scores, areas and overlaps
    limits = resolve_thresholds(F.lit(None).cast("map<string,double>"), defaults={**MASK_SEQUENCE_THRESHOLDS, "max_area_fraction": 0.95, "min_dominant_component_ratio": 0.3})
    return frames, instances, tiles, annotate.score_masks(frames, instances, files, tiles, v.depth_rows(spark, sf_dir), limits)


def mask_scores(spark, sf_dir) -> DataFrame:
    """Runs and scan lines to graded records: the whole scoring chain in one query."""
    records = _scored(spark, sf_dir)[3]
    return records.select(*M, "status", v.joined("reject_reasons"), v.joined("review_reasons"), "line", v.r6("area_ratio", "area_ratio"))


def mask_verdicts(spark, sf_dir) -> DataFrame:
    """Runs and scan lines to frame verdicts with labels."""
    frames, instances, tiles, records = _scored(spark, sf_dir)
    found = annotate.aggregate_frames(frames, instances, records, tiles, max_overlap=0.9, include_review=True)
    return found.select("output_id", "status", v.joined("reasons"), "label_text")


_FRAGMENTS = MASK_FRAGMENTS.rsplit("SELECT scene_id", 1)[0].removeprefix("WITH RECURSIVE ").rstrip()
_SCORES = f"""{_FRAGMENTS}, fg AS (SELECT scene_id, frame_id, instance_id, max(s) / sum(s) AS dom FROM sz GROUP BY ALL), ms AS (
  SELECT scene_id, frame_id, instance_id, count(*) AS area, min(x) AS x1, min(y) AS y1, max(x) + 1 AS x2, max(y) + 1 AS y2, count(*) FILTER ({v.DEPTH_OF_PX} > 0) / count(*) AS cov FROM px GROUP BY ALL), fr AS (
  SELECT scene_id, frame_id, row_number() OVER (PARTITION BY scene_id ORDER BY frame_id) - 1 AS n FROM (SELECT DISTINCT scene_id, frame_id FROM px)), al AS (
  SELECT fr.*, 'm' || i AS instance_id, i AS ord FROM fr, range(0, 3) t(i)), b AS (
  SELECT al.*, area IS NOT NULL AS has_mask, coalesce(area, 0) AS area, x1, y1, x2, y2, (x1 + x2) * 0.5::DOUBLE AS cx, (y1 + y2) * 0.5::DOUBLE AS cy, cov, dom,
    concat_ws('|', CASE WHEN area < 80 THEN 'mask_area_too_small' END, CASE WHEN area / 3840 < 0.00015 THEN 'object_too_small_in_image' END, CASE WHEN area / 3840 > 0.95 THEN 'object_too_large_in_image' END,
      CASE WHEN cov < 0.25 THEN 'depth_coverage_too_low' END, CASE WHEN dom < 0.3 THEN 'mask_fragmented' END) AS rej
  FROM al LEFT JOIN ms USING (scene_id, frame_id, instance_id) LEFT JOIN fg USING (scene_id, frame_id, instance_id)), r AS (
  SELECT scene_id, instance_id, CAST(0 AS BIGINT) AS n, CAST(NULL AS DOUBLE) AS ra, CAST(NULL AS DOUBLE) AS rx, CAST(NULL AS DOUBLE) AS ry FROM b WHERE n = 0 UNION ALL
  SELECT scene_id, instance_id, n + 1, CASE WHEN k THEN area ELSE ra END, CASE WHEN k THEN cx ELSE rx END, CASE WHEN k THEN cy ELSE ry END FROM (
    SELECT r.*, b.area, b.cx, b.cy, has_mask AND rej = '' AND (r.n = 0 OR ra IS NULL OR NOT (area / ra < 0.35 OR area / ra > 2.8
      OR sqrt((cx - rx) * (cx - rx) + (cy - ry) * (cy - ry)) / sqrt(160 * 160 + 24 * 24) > 0.40)) AS k
    FROM r JOIN b ON b.scene_id = r.scene_id AND b.instance_id = r.instance_id AND b.n = r.n)), w AS (
  SELECT b.*, CASE WHEN area > 0 THEN area / ra END AS ratio, CASE WHEN area > 0 THEN sqrt((cx - rx) * (cx - rx) + (cy - ry) * (cy - ry)) / sqrt(160 * 160 + 24 * 24) END AS shift
  FROM b JOIN r ON b.scene_id = r.scene_id AND b.instance_id = r.instance_id AND b.n = r.n), z AS (
  SELECT *, CASE WHEN NOT has_mask THEN 'mask_file_missing' ELSE concat_ws('|', nullif(rej, ''), CASE WHEN n > 0 AND (ratio < 0.35 OR ratio > 2.8) THEN 'mask_area_jump' END,
      CASE WHEN n > 0 AND shift > 0.40 THEN 'mask_center_jump' END) END AS reject_reasons FROM w), y AS (
  SELECT *, CASE WHEN reject_reasons <> '' THEN '' ELSE concat_ws('|', CASE WHEN x1 <= 2 OR y1 <= 2 OR x2 >= 158 OR y2 >= 22 THEN 'touches_image_border' END,
      CASE WHEN cov < 0.60 THEN 'depth_coverage_marginal' END, CASE WHEN n > 0 AND shift > 0.22 THEN 'large_center_motion' END) END AS review_reasons FROM z), g AS (
  SELECT *, CASE WHEN reject_reasons <> '' THEN 'rejected' WHEN review_reasons <> '' THEN 'review' ELSE 'accepted' END AS status,
    CASE WHEN area >= 80 THEN printf('%d %.6f %.6f %.6f %.6f', ord, (x1 + x2) * 0.5::DOUBLE / 160, (y1 + y2) * 0.5::DOUBLE / 24, (x2 - x1)::DOUBLE / 160, (y2 - y1)::DOUBLE / 24) END AS line FROM y)"""
MASK_SCORES = f"WITH RECURSIVE {_SCORES} SELECT scene_id, frame_id, instance_id, status, reject_reasons, review_reasons, line, round(ratio, 6) AS area_ratio FROM g"
MASK_VERDICTS = f"""WITH RECURSIVE {_SCORES}, ar AS (SELECT scene_id, frame_id, instance_id, count(*) AS n FROM px GROUP BY ALL), cf AS (
  SELECT p.frame_id FROM (SELECT p.scene_id, p.frame_id, p.instance_id AS a, q.instance_id AS b, count(*) AS k FROM px p JOIN px q ON p.scene_id = q.scene_id AND p.frame_id = q.frame_id AND p.y = q.y AND p.x = q.x AND p.instance_id < q.instance_id GROUP BY ALL) p
  JOIN ar u ON u.frame_id = p.frame_id AND u.instance_id = a JOIN ar t ON t.frame_id = p.frame_id AND t.instance_id = b WHERE k / least(u.n, t.n) > 0.9 GROUP BY p.frame_id), v AS (
  SELECT scene_id, frame_id, string_agg(CASE WHEN status = 'rejected' OR line IS NULL THEN instance_id || ':' || status END, '|' ORDER BY ord) AS bad,
         string_agg(CASE WHEN status <> 'rejected' THEN line END, chr(10) ORDER BY ord) AS label_text FROM g GROUP BY ALL), o AS (
  SELECT scene_id || '_' || v.frame_id AS output_id, concat_ws('|', bad, CASE WHEN cf.frame_id IS NOT NULL THEN 'instance_mask_overlap' END) AS reasons, label_text FROM v LEFT JOIN cf ON cf.frame_id = v.frame_id)
SELECT output_id, CASE WHEN reasons = '' AND label_text IS NOT NULL THEN 'accepted' WHEN label_text IS NOT NULL THEN 'review' ELSE 'rejected' END AS status, reasons, label_text FROM o"""

QUERIES = {
    "mask_scores": (mask_scores, MASK_SCORES),
    "mask_verdicts": (mask_verdicts, MASK_VERDICTS),
    "mask_area_bbox": (mask_area_bbox, MASK_AREA_BBOX),
    "mask_overlap": (mask_overlap, MASK_OVERLAP),
    "mask_iou": (mask_iou, MASK_IOU),
    "mask_fragments": (mask_fragments, MASK_FRAGMENTS),
    "mask_erode": (mask_erode, MASK_ERODE),
    "mask_warp": (mask_warp, MASK_WARP),
    "flow_statistics": (flow_statistics, FLOW_STATISTICS),
    "depth_coverage": (depth_coverage, DEPTH_COVERAGE),
    "depth_residual": (depth_residual, DEPTH_RESIDUAL),
    "depth_visible": (depth_visible, DEPTH_VISIBLE),
    "instance_xyz": (instance_xyz, INSTANCE_XYZ),
    "frame_depth_ratios": (frame_depth_ratios, FRAME_DEPTH_RATIOS),
    "depth_to_mm": (depth_to_mm, DEPTH_TO_MM),
    "depth_quantiles": (depth_quantiles, DEPTH_QUANTILES),
}
