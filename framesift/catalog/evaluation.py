"""Training metrics, false positives, decisions, class maps and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..constants import OFFICIAL_CLASSES
from ..operators import detections as det
from ..operators import metrics as m
from . import views as v


def _epochs(spark, sf_dir) -> DataFrame:
    li = v.table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_suppkey").alias("run"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_no"),
        F.col("l_orderkey").alias("epoch"),
        (F.lit(1.0) - F.col("l_discount")).alias("precision_m"),
        (F.lit(1.0) - F.col("l_tax")).alias("recall_m"),
        (F.lit(1.0) - F.col("l_discount") * 2).alias("map50_m"),
        (F.lit(1.0) - F.col("l_tax") * 4).alias("map50_95_m"),
        (F.lit(1.0) - F.col("l_discount") * 4).alias("map50_95_b"),
    )


_EPOCHS = """ep AS (
  SELECT l_suppkey AS run, l_orderkey * 10 + l_linenumber AS row_no, l_orderkey AS epoch, 1.0::DOUBLE - l_discount AS precision_m, 1.0::DOUBLE - l_tax AS recall_m,
         1.0::DOUBLE - l_discount * 2 AS map50_m, 1.0::DOUBLE - l_tax * 4 AS map50_95_m, 1.0::DOUBLE - l_discount * 4 AS map50_95_b FROM lineitem)"""


def best_epoch(spark, sf_dir) -> DataFrame:
    b = m.best_epochs(_epochs(spark, sf_dir))
    numbers = ("fitness", "precision_m", "recall_m", "map50_m", "map50_95_m", "map50_95_b", "mask_peak_map50_95")
    return b.select("run", "epochs_recorded", "best_epoch", "mask_peak_epoch", *[v.r6(c, c) for c in numbers])


BEST_EPOCH = f"""WITH {_EPOCHS}, r AS (
  SELECT *, row_number() OVER (PARTITION BY run ORDER BY map50_95_b + map50_95_m DESC, row_no, epoch, precision_m, recall_m, map50_m, map50_95_m, map50_95_b) AS a,
         row_number() OVER (PARTITION BY run ORDER BY map50_95_m DESC, row_no, epoch) AS p, count(*) OVER (PARTITION BY run) AS n FROM ep)
SELECT run, max(n) AS epochs_recorded, max(epoch) FILTER (a = 1) AS best_epoch, max(epoch) FILTER (p = 1) AS mask_peak_epoch, round(max(map50_95_b + map50_95_m) FILTER (a = 1), 6) AS fitness,
  round(max(precision_m) FILTER (a = 1), 6) AS precision_m, round(max(recall_m) FILTER (a = 1), 6) AS recall_m, round(max(map50_m) FILTER (a = 1), 6) AS map50_m,
  round(max(map50_95_m) FILTER (a = 1), 6) AS map50_95_m, round(max(map50_95_b) FILTER (a = 1), 6) AS map50_95_b, round(max(map50_95_m) FILTER (p = 1), 6) AS mask_peak_map50_95 FROM r GROUP BY run"""


def dashboard_epoch(spark, sf_dir) -> DataFrame:
    """Best epoch from text cells, some of which are no numbers."""
    e = _epochs(spark, sf_dir)
    text = F.when(F.col("epoch") % 7 == 0, F.lit("n/a")).otherwise(F.col("map50_95_m").cast("string"))
    best = m.dashboard_epochs(e.select("run", "row_no", F.col("epoch").cast("string").alias("epoch"), text.alias("map50_95_m")))
    return best.select("run", v.long("best_epoch", "best_epoch"), v.r6("map50_95_m", "map50_95_m"))


DASHBOARD = f"""WITH {_EPOCHS}, r AS (SELECT *, CASE WHEN epoch % 7 <> 0 THEN map50_95_m END AS s FROM ep)
SELECT run, arg_min(epoch, row_no * 1000000000 + epoch) AS best_epoch, round(max(s), 6) AS map50_95_m FROM r JOIN (SELECT run, max(s) AS top FROM r GROUP BY run) t USING (run) WHERE s = top GROUP BY run"""


def metric_violations(spark, sf_dir) -> DataFrame:
    """Metric cells of the part table that are no finite numbers."""
    p = v.table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    k = F.col("p_partkey")
    rows = p.select(
        k.alias("row_no"),
        F.when(k % 13 == 0, "nan").when(k % 17 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(" "))).alias("precision_m"),
        F.when(k % 11 == 0, "inf").when(k % 19 == 0, "bad").otherwise(F.col("p_size").cast("string")).alias("recall_m"),
    )
    return m.metric_violations(rows, ["precision_m", "recall_m"], ["row_no"]).select("row_no", "metric", "rule")


METRIC_VIOLATIONS = """SELECT p_partkey AS row_no, 'precision_m' AS metric, CASE WHEN p_partkey % 13 = 0 THEN 'not_finite' ELSE 'not_a_number' END AS rule FROM part WHERE p_partkey % 13 = 0 OR p_partkey % 17 = 0
UNION ALL SELECT p_partkey, 'recall_m', CASE WHEN p_partkey % 11 = 0 THEN 'not_finite' ELSE 'not_a_number' END FROM part WHERE p_partkey % 11 = 0 OR p_partkey % 19 = 0"""


def latest_run(spark, sf_dir) -> DataFrame:
    o = v.table(spark, sf_dir, "orders")
    runs = o.select(F.concat(F.lit("run_"), F.col("o_orderkey").cast("string")).alias("run"), F.concat(F.lit("/runs/"), F.col("o_orderkey").cast("string")).alias("path"), F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("mtime"))
    return m.latest_run(runs).unionByName(m.latest_run(runs, "run_7")).unionByName(m.latest_run(runs, "no_such_run"))


LATEST_RUN = """WITH l AS (SELECT 'run_' || o_orderkey AS run, '/runs/' || o_orderkey AS path FROM orders ORDER BY o_orderdate DESC, 'run_' || o_orderkey LIMIT 1)
SELECT * FROM l UNION ALL SELECT * FROM l UNION ALL SELECT 'run_' || o_orderkey, '/runs/' || o_orderkey FROM orders WHERE o_orderkey = 7"""


def _distractors(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    e = v.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    frames = e.select(F.col("event_type").alias("model"), F.col("user_id").alias("frame_id")).distinct()
    names = F.array(*[F.lit(n) for n in OFFICIAL_CLASSES.values()])
    found = e.where("value > 25").select(
        F.col("event_type").alias("model"), F.col("user_id").alias("frame_id"), F.element_at(names, (F.col("event_id") % 7 + 1).cast("int")).alias("class_name")
    )
    return frames, found


def fp_summary(spark, sf_dir) -> DataFrame:
    s = m.false_positives(*_distractors(spark, sf_dir))
    fractions = ("false_positive_frames_fraction", "false_positive_instances_per_frame")
    return s.select("model", "frames", "false_positive_instances", "frames_with_false_positive", *[v.r6(c, c) for c in fractions])


FP_SUMMARY = """WITH f AS (SELECT event_type AS model, count(DISTINCT user_id) AS frames FROM events GROUP BY 1), d AS (
  SELECT event_type AS model, count(*) AS i, count(DISTINCT user_id) AS h FROM events WHERE value > 25 GROUP BY 1)
SELECT model, frames, coalesce(i, 0) AS false_positive_instances, coalesce(h, 0) AS frames_with_false_positive, round(coalesce(h, 0) / frames, 6) AS false_positive_frames_fraction,
  round(coalesce(i, 0) / frames, 6) AS false_positive_instances_per_frame FROM f LEFT JOIN d USING (model)"""


def fp_by_class(spark, sf_dir) -> DataFrame:
    return m.false_positives_by_class(_distractors(spark, sf_dir)[1], v.class_catalogue(spark))


_LIST = ", ".join(f"'{n}'" for n in OFFICIAL_CLASSES.values())
FP_BY_CLASS = f"""WITH {v.CLASSES}, d AS (SELECT event_type AS model, ([{_LIST}])[event_id % 7 + 1] AS class_name FROM events WHERE value > 25), n AS (SELECT model, class_name, count(*) AS c FROM d GROUP BY ALL)
SELECT x.model, cls.class_name, coalesce(c, 0) AS instances FROM (SELECT DISTINCT model FROM d) x CROSS JOIN cls LEFT JOIN n ON n.model = x.model AND n.class_name = cls.class_name"""


def throughput(spark, sf_dir) -> DataFrame:
    e = v.table(spark, sf_dir, "events").select(F.col("event_type").alias("model"), (F.col("value") / 1000).alias("seconds"))
    t = m.throughput(e)
    return t.select("model", "frames", v.r6("elapsed", "elapsed"), v.r6("fps", "fps"), v.long(F.col("meets_target"), "meets_target"))


THROUGHPUT = """SELECT event_type AS model, count(*) AS frames, round(sum(value / 1000), 6) AS elapsed, round(count(*) / sum(value / 1000), 6) AS fps, CAST(count(*) / sum(value / 1000) >= 20 AS BIGINT) AS meets_target FROM events GROUP BY 1"""


def benchmark_frames(spark, sf_dir) -> DataFrame:
    """The report covers the first 500 frames; 20 of them warm up."""
    e = v.table(spark, sf_dir, "events").select(F.lpad(F.col("event_id").cast("string"), 8, "0").alias("frame_id"))
    return m.benchmark_frames(e, 500, 20).select("frame_id", v.long(F.col("warmup"), "warmup"))


BENCHMARK_FRAMES = """SELECT frame_id, CAST(row_number() OVER (ORDER BY frame_id) <= 20 AS BIGINT) AS warmup FROM (SELECT lpad(CAST(event_id AS VARCHAR), 8, '0') AS frame_id FROM events ORDER BY 1 LIMIT 500)"""


def class_metrics(spark, sf_dir) -> DataFrame:
    """Recall per class of the catalogue, from reviewed documents."""
    lab = v.table(spark, sf_dir, "labels")
    by = lab.groupBy((F.col("doc_id") % 8).cast("int").alias("class_id")).agg(F.avg("quality").alias("recall"), F.avg(1 - F.col("toxic")).alias("precision"))
    t = m.class_metrics(v.class_catalogue(spark), by)
    return t.select(v.long("class_id", "class_id"), "class_name", v.r6("recall", "recall"), v.r6("precision", "precision"), v.long(F.col("missing"), "missing"))


CLASS_METRICS = f"""WITH {v.CLASSES}, b AS (SELECT doc_id % 8 AS class_id, avg(quality) AS r, avg(1 - toxic) AS p FROM labels GROUP BY 1)
SELECT CAST(cls.class_id AS BIGINT) AS class_id, class_name, round(r, 6) AS recall, round(p, 6) AS precision, CAST(r IS NULL AS BIGINT) AS missing FROM cls LEFT JOIN b ON b.class_id = cls.class_id"""


def candidate_decision(spark, sf_dir) -> DataFrame:
    """A / B decision per supplier pair of runs."""
    li = v.table(spark, sf_dir, "lineitem")
    pair, side = F.floor(F.col("l_suppkey") / 2), F.col("l_suppkey") % 2
    a = lambda c: F.avg(F.when(side == 0, c))
    b = lambda c: F.avg(F.when(side == 1, c))
    per_class = li.groupBy(pair.alias("pair"), F.col("l_returnflag").alias("class_id")).agg(a(F.col("l_tax")).alias("recall_a"), b(F.col("l_tax")).alias("recall_b"))
    overall = li.groupBy(pair.alias("pair")).agg(
        a(F.col("l_discount")).alias("map_a"), b(F.col("l_discount")).alias("map_b"), F.count_if(side == 0).alias("fp_a"), F.count_if(side == 1).alias("fp_b")
    )
    d = m.candidate_decision(per_class, overall)
    return d.select("pair", "classes", *[v.long(F.col(c), c) for c in ("map_better", "all_recalls_better", "fp_not_worse", "adopt_b")])


CANDIDATE_DECISION = """WITH c AS (
  SELECT l_suppkey // 2 AS pair, l_returnflag AS k, avg(CASE WHEN l_suppkey % 2 = 0 THEN l_tax END) AS ra, avg(CASE WHEN l_suppkey % 2 = 1 THEN l_tax END) AS rb FROM lineitem GROUP BY ALL), r AS (
  SELECT pair, count(*) AS n, bool_and(coalesce(rb > ra, false)) AS ok FROM c GROUP BY pair), o AS (
  SELECT l_suppkey // 2 AS pair, avg(CASE WHEN l_suppkey % 2 = 0 THEN l_discount END) AS ma, avg(CASE WHEN l_suppkey % 2 = 1 THEN l_discount END) AS mb,
         count(*) FILTER (l_suppkey % 2 = 0) AS fa, count(*) FILTER (l_suppkey % 2 = 1) AS fb FROM lineitem GROUP BY ALL)
SELECT o.pair, n AS classes, CAST(mb > ma AS BIGINT) AS map_better, CAST(ok AS BIGINT) AS all_recalls_better, CAST(fb <= fa AS BIGINT) AS fp_not_worse, CAST(mb > ma AND fb <= fa AND ok AS BIGINT) AS adopt_b FROM o JOIN r USING (pair)"""


def first_sample_per_class(spark, sf_dir) -> DataFrame:
    p = v.table(spark, sf_dir, "part")
    return m.first_samples(p.select(F.col("p_type").alias("class_id"), F.concat_ws("/", "p_brand", "p_name", F.col("p_partkey").cast("string")).alias("image")))


FIRST_SAMPLE = "SELECT p_type AS class_id, min(p_brand || '/' || p_name || '/' || p_partkey) AS image FROM part GROUP BY 1"


def classes_without_sample(spark, sf_dir) -> DataFrame:
    p = v.table(spark, sf_dir, "part").where("p_size < 8")
    samples = m.first_samples(p.select(F.col("p_size").alias("class_id"), F.col("p_name").alias("image")))
    return m.classes_without_sample(samples, v.class_catalogue(spark)).select(v.long("class_id", "class_id"), "class_name")


WITHOUT_SAMPLE = f"WITH {v.CLASSES} SELECT CAST(class_id AS BIGINT) AS class_id, class_name FROM cls WHERE class_id NOT IN (SELECT p_size FROM part WHERE p_size < 8)"


def _class_maps(spark, sf_dir) -> DataFrame:
    """One class map per order: prefixes of the official list, some of them damaged."""
    o = v.table(spark, sf_dir, "orders").select("o_orderkey")
    k = F.col("o_orderkey")
    names = F.array(*[F.lit(n) for n in OFFICIAL_CLASSES.values()])
    entry = lambda n, i: F.struct(
        (i + F.when(k % 11 == 0, 1).otherwise(0)).cast("int").alias("class_id"),
        F.when((k % 7 == 0) & (i == 1), F.lit("wrong")).when((k % 13 == 0) & (i == 0), F.lit(" ")).when((k % 17 == 0) & (i == 2), names[0]).otherwise(n).alias("class_name"),
    )
    return o.select(k.alias("map_id"), F.inline(F.transform(F.slice(names, F.lit(1), (k % 9 + 1).cast("int")), entry)))


_MAPS = f"""{v.CLASSES}, mp AS (
  SELECT o_orderkey AS map_id, class_id + CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 0 END AS class_id,
    CASE WHEN o_orderkey % 7 = 0 AND class_id = 1 THEN 'wrong' WHEN o_orderkey % 13 = 0 AND class_id = 0 THEN ' ' WHEN o_orderkey % 17 = 0 AND class_id = 2 THEN 'can' ELSE class_name END AS class_name
  FROM orders, cls WHERE class_id < o_orderkey % 9 + 1), mv AS (
  SELECT map_id, min(class_id) <> 0 OR max(class_id) + 1 <> count(*) AS gap, count(DISTINCT class_name) < count(*) AS twice, bool_or(trim(class_name) = '') AS blank FROM mp GROUP BY map_id)"""


def class_map_violations(spark, sf_dir) -> DataFrame:
    return m.class_map_violations(_class_maps(spark, sf_dir))


CLASS_MAPS = f"""WITH {_MAPS} SELECT map_id, 'ids_not_contiguous' AS rule FROM mv WHERE gap UNION ALL SELECT map_id, 'blank_name' FROM mv WHERE blank UNION ALL SELECT map_id, 'duplicate_name' FROM mv WHERE twice"""


def class_map_prefix(spark, sf_dir) -> DataFrame:
    p = m.prefix_compatibility(_class_maps(spark, sf_dir), v.class_catalogue(spark))
    return p.select("map_id", v.long(F.col("compatible"), "compatible"))


CLASS_PREFIX = f"""WITH {_MAPS}, sm AS (SELECT map_id, bool_and(mp.class_name IS NOT DISTINCT FROM cls.class_name) AS same FROM mp LEFT JOIN cls USING (class_id) GROUP BY map_id)
SELECT map_id, CAST(same AND NOT (gap OR twice OR blank) AS BIGINT) AS compatible FROM sm JOIN mv USING (map_id)"""


def class_map_merge(spark, sf_dir) -> DataFrame:
    """Maps that conflict with the longest one."""
    return m.merge_class_maps(_class_maps(spark, sf_dir))[1]


CLASS_MERGE = f"""WITH {_MAPS}, sz AS (SELECT map_id, count(*) AS n FROM mp GROUP BY 1), lg AS (SELECT map_id FROM sz ORDER BY n DESC, map_id LIMIT 1), rf AS (SELECT class_id, class_name FROM mp JOIN lg USING (map_id)), sm AS (
  SELECT mp.map_id, bool_and(mp.class_name IS NOT DISTINCT FROM rf.class_name) AS same FROM mp LEFT JOIN rf USING (class_id) GROUP BY 1)
SELECT map_id FROM sm JOIN mv USING (map_id) WHERE NOT (same AND NOT (gap OR twice OR blank))"""


def teacher_mapping(spark, sf_dir) -> DataFrame:
    """Checks of a teacher mapping taken from product types and brands."""
    p = v.table(spark, sf_dir, "part")
    names = F.array(*[F.lit(n) for n in [*OFFICIAL_CLASSES.values(), "lid"]])
    mapping = p.select(F.col("p_name").alias("source_class"), F.element_at(names, (F.col("p_size") % 10 + 1).cast("int")).alias("official_class"))
    negatives = p.where("p_size > 40").select(F.col("p_name").alias("source_class"))
    scopes = p.select(F.col("p_brand").alias("detector"), F.element_at(names, (F.col("p_partkey") % 10 + 1).cast("int")).alias("official_class"))
    return det.mapping_violations(mapping, negatives, scopes, v.class_catalogue(spark))


TEACHER_MAPPING = """SELECT DISTINCT 'unknown_target' AS rule, 'lid' AS key FROM part WHERE p_size % 10 = 9 UNION ALL SELECT DISTINCT 'mapped_and_negative', p_name FROM part WHERE p_size > 40
UNION ALL SELECT DISTINCT 'unknown_scope_class', p_brand || ':lid' FROM part WHERE p_partkey % 10 = 9"""


def refuse_val(spark, sf_dir) -> DataFrame:
    o = v.table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return det.refuse_val(o.select(k.cast("string").alias("scene_id"), F.when(k % 5 == 0, "val").when(k % 5 == 1, "train").alias("split")))


REFUSE_VAL = "SELECT 'val_refuses_proposals' AS rule, CAST(o_orderkey AS VARCHAR) AS key FROM orders WHERE o_orderkey % 5 = 0"

QUERIES = {
    "best_epoch": (best_epoch, BEST_EPOCH),
    "dashboard_epoch": (dashboard_epoch, DASHBOARD),
    "metric_violations": (metric_violations, METRIC_VIOLATIONS),
    "latest_run": (latest_run, LATEST_RUN),
    "fp_summary": (fp_summary, FP_SUMMARY),
    "fp_by_class": (fp_by_class, FP_BY_CLASS),
    "throughput": (throughput, THROUGHPUT),
    "benchmark_frames": (benchmark_frames, BENCHMARK_FRAMES),
    "class_metrics": (class_metrics, CLASS_METRICS),
    "candidate_decision": (candidate_decision, CANDIDATE_DECISION),
    "first_sample_per_class": (first_sample_per_class, FIRST_SAMPLE),
    "classes_without_sample": (classes_without_sample, WITHOUT_SAMPLE),
    "class_map_violations": (class_map_violations, CLASS_MAPS),
    "class_map_prefix": (class_map_prefix, CLASS_PREFIX),
    "class_map_merge": (class_map_merge, CLASS_MERGE),
    "teacher_mapping": (teacher_mapping, TEACHER_MAPPING),
    "refuse_val": (refuse_val, REFUSE_VAL),
}
