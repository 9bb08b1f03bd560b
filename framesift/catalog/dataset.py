"""Dataset validation: labels, pairing, duplicates, leakage, classes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..constants import OFFICIAL_CLASSES
from ..functions.geometry import polygon_area
from ..operators import inventory, validation as val
from ..sinks.writers import merge_labels, new_negatives
from ..sources.documents import check_negatives
from . import views as v

KNOWN = list(range(9))


def _part_lines(spark, sf_dir) -> DataFrame:
    """``split, stem, part, text``: one label line per part, some of them malformed."""
    p = v.table(spark, sf_dir, "part").select("p_partkey", "p_size")
    k = F.col("p_partkey")
    c = (F.col("p_size") % 11).cast("string")
    a = F.concat(F.lit("0."), F.lpad((F.lit(20) + F.col("p_size")).cast("string"), 2, "0"))
    b = F.concat(F.lit("0."), F.lpad((F.lit(30) + k % 50).cast("string"), 2, "0"))
    text = (
        F.when(k % 17 == 0, F.concat(c, F.lit(" 0.1 0.2")))
        .when(k % 19 == 0, F.concat(F.lit("x 0.1 0.1 0.4 0.1 0.4 0.5")))
        .when(k % 23 == 0, F.concat(c, F.lit(" 0.1 0.1 nan 0.1 0.4 0.5")))
        .when(k % 29 == 0, F.concat(c, F.lit(" 0.1 0.1 1.5 0.1 0.4 0.5")))
        .when(k % 31 == 0, F.concat(c, F.lit(" 0.1 0.1 0.2 0.2 0.3 0.3")))
        .when(k % 37 == 0, F.concat(c, F.lit(" 0.1 0.1 0.2 0.2 0.3 1d")))
        .when(k % 41 == 0, F.lit("   "))
        .otherwise(F.concat_ws(" ", c, F.lit("0.1 0.1"), a, F.lit("0.1"), a, b, F.lit("0.1"), b))
    )
    stem = F.floor(k / 3)
    return p.select(F.when(stem % 5 == 0, "val").otherwise("train").alias("split"), stem.cast("string").alias("stem"), k.alias("part"), text.alias("text"))


_PART_LINES = """pl AS (
  SELECT CASE WHEN p_partkey // 3 % 5 = 0 THEN 'val' ELSE 'train' END AS split, CAST(p_partkey // 3 AS VARCHAR) AS stem, p_partkey AS part, p_size % 11 AS c,
    CASE WHEN p_partkey % 17 = 0 THEN 'short' WHEN p_partkey % 19 = 0 THEN 'text' WHEN p_partkey % 23 = 0 THEN 'nan' WHEN p_partkey % 29 = 0 THEN 'out'
         WHEN p_partkey % 31 = 0 THEN 'flat' WHEN p_partkey % 37 = 0 THEN 'text' WHEN p_partkey % 41 = 0 THEN 'blank' ELSE 'ok' END AS kind, p_size, p_partkey
  FROM part), ln AS (
  SELECT *, row_number() OVER (PARTITION BY split, stem ORDER BY part) AS line_no FROM pl WHERE kind <> 'blank'), ck AS (
  SELECT *, kind IN ('ok', 'out', 'flat') AS counted,
    CASE kind WHEN 'short' THEN 'bad_format' WHEN 'text' THEN 'not_numeric' ELSE concat_ws('|', CASE WHEN c > 8 THEN 'unknown_class' END,
      CASE kind WHEN 'nan' THEN 'not_finite' WHEN 'out' THEN 'out_of_range' WHEN 'flat' THEN 'degenerate_polygon' END) END AS errors FROM ln)"""


def _label_files(spark, sf_dir) -> DataFrame:
    """Label files: the lines of three parts, with empty lines in between."""
    lines = _part_lines(spark, sf_dir)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("part", "text"))), lambda s: s["text"])
    return lines.groupBy("split", "stem").agg(F.concat(F.array_join(ordered, "\n\r\n"), F.lit("\n")).alias("text"))


def _checked(spark, sf_dir) -> DataFrame:
    return val.checked_lines(val.numbered_lines(_label_files(spark, sf_dir)), KNOWN)


def label_rules(spark, sf_dir) -> DataFrame:
    return _checked(spark, sf_dir).select("split", "stem", v.long("line_no", "line_no"), v.joined("errors"), v.long(F.col("counted"), "counted"))


LABEL_RULES = f"WITH {_PART_LINES} SELECT split, stem, line_no, errors, CAST(counted AS BIGINT) AS counted FROM ck"


def polygon_areas(spark, sf_dir) -> DataFrame:
    c = _checked(spark, sf_dir).where("counted")
    return c.select("split", "stem", v.long("line_no", "line_no"), v.r6(polygon_area(F.col("coords")), "area"))


POLYGON_AREAS = f"""WITH {_PART_LINES}
SELECT split, stem, line_no, round(CASE kind WHEN 'flat' THEN 0 WHEN 'out' THEN abs((1.5 - 0.1) * (0.5 - 0.1)) / 2
  ELSE ((20 + p_size) / 100::DOUBLE - 0.1) * ((30 + p_partkey % 50) / 100::DOUBLE - 0.1) END, 6) AS area FROM ck WHERE counted"""


def label_violations(spark, sf_dir) -> DataFrame:
    return val.line_violations(_checked(spark, sf_dir))


LABEL_VIOLATIONS = f"""WITH {_PART_LINES} SELECT unnest(string_split(errors, '|')) AS rule, split || '/' || stem AS key, CAST(line_no AS VARCHAR) AS detail FROM ck WHERE errors <> ''"""


def first_errors(spark, sf_dir) -> DataFrame:
    """Error preview of a failed check: the first 20."""
    return val.first_errors(val.line_violations(_checked(spark, sf_dir)), 20)


FIRST_ERRORS = f"SELECT * FROM ({LABEL_VIOLATIONS}) ORDER BY rule, key, detail LIMIT 20"


def _doc_labels(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Images from documents; labels from the label table plus orphan labels."""
    images = v.document_files(spark, sf_dir).select("split", "stem")
    known = v.table(spark, sf_dir, "labels").select("doc_id")
    split = lambda c: F.when(c % 5 == 0, "val").otherwise("train")
    own = known.select(split(F.col("doc_id")).alias("split"), F.col("doc_id").cast("string").alias("stem"))
    stray = v.table(spark, sf_dir, "documents").where("lang = 'es'").select(
        split(F.col("doc_id")).alias("split"), (F.col("doc_id") + 1000000).cast("string").alias("stem")
    )
    return images, own.unionByName(stray)


_DOC_LABELS = """im AS (SELECT CASE WHEN doc_id % 5 = 0 THEN 'val' ELSE 'train' END AS split, CAST(doc_id AS VARCHAR) AS stem FROM documents), lb AS (
  SELECT CASE WHEN doc_id % 5 = 0 THEN 'val' ELSE 'train' END AS split, CAST(doc_id AS VARCHAR) AS stem FROM labels UNION ALL
  SELECT CASE WHEN doc_id % 5 = 0 THEN 'val' ELSE 'train' END, CAST(doc_id + 1000000 AS VARCHAR) FROM documents WHERE lang = 'es')"""


def pairing(spark, sf_dir) -> DataFrame:
    return val.pairing_violations(*_doc_labels(spark, sf_dir)).select("rule", "key")


PAIRING = f"""WITH {_DOC_LABELS}
SELECT 'missing_label' AS rule, split || '/' || stem AS key FROM im WHERE NOT EXISTS (SELECT 1 FROM lb WHERE lb.split = im.split AND lb.stem = im.stem)
UNION ALL SELECT 'orphan_label', split || '/' || stem FROM (SELECT DISTINCT * FROM lb) lb WHERE NOT EXISTS (SELECT 1 FROM im WHERE lb.split = im.split AND lb.stem = im.stem)"""


def set_diff(spark, sf_dir) -> DataFrame:
    images, labels = _doc_labels(spark, sf_dir)
    return val.set_differences(images, labels, "stem")


SET_DIFF = f"""WITH {_DOC_LABELS} SELECT coalesce(i.stem, l.stem) AS stem, CASE WHEN l.stem IS NULL THEN 'extra' ELSE 'missing' END AS side
FROM (SELECT DISTINCT stem FROM im) i FULL JOIN (SELECT DISTINCT stem FROM lb) l ON i.stem = l.stem WHERE i.stem IS NULL OR l.stem IS NULL"""


def same_stem_images(spark, sf_dir) -> DataFrame:
    files = v.document_files(spark, sf_dir).select("split", F.floor(F.col("stem").cast("long") * 3 / 4).cast("string").alias("stem"))
    return val.same_stem_images(files)


SAME_STEM = """WITH f AS (SELECT CASE WHEN doc_id % 5 = 0 THEN 'val' ELSE 'train' END AS split, CAST(CAST(floor(doc_id * 3 / 4) AS BIGINT) AS VARCHAR) AS stem FROM documents)
SELECT 'several_images_per_stem' AS rule, split || '/' || stem AS key, CAST(count(*) AS VARCHAR) AS detail FROM f GROUP BY split, stem HAVING count(*) > 1"""


def _negative_rows(spark, sf_dir) -> DataFrame:
    d = v.table(spark, sf_dir, "documents").select("doc_id", "lang")
    k = F.col("doc_id")
    return d.select(
        k.alias("pos"),
        F.when(k % 4 == 0, "val").when(k % 9 == 0, "dev").otherwise("train").alias("split"),
        F.when(k % 7 == 0, F.lit("")).otherwise(F.concat(F.lit("img/n_"), F.floor(k / 2).cast("string"), F.lit(".png"))).alias("image"),
        F.when(k % 5 != 0, "true").otherwise("false").alias("reviewed_no_targets"),
        F.col("lang").alias("capture_session_id"),
        F.lit(None).cast("string").alias("source_video_id"),
    )


_NEGATIVES = """nr AS (
  SELECT doc_id AS pos, CASE WHEN doc_id % 4 = 0 THEN 'val' WHEN doc_id % 9 = 0 THEN 'dev' ELSE 'train' END AS split,
    CASE WHEN doc_id % 7 = 0 THEN '' ELSE 'n_' || (doc_id // 2) END AS stem, doc_id % 5 <> 0 AS ok, lang FROM documents), nc AS (
  SELECT *, CASE WHEN split = 'dev' THEN 'bad_split' WHEN stem = '' THEN 'image_missing' WHEN NOT ok THEN 'not_confirmed' END AS r FROM nr), nd AS (
  SELECT *, CASE WHEN r IS NULL AND row_number() OVER (PARTITION BY r IS NULL, split, stem ORDER BY pos) > 1 THEN 'duplicate' ELSE r END AS rule FROM nc)"""


def reviewed_negatives(spark, sf_dir) -> DataFrame:
    kept, wrong = check_negatives(_negative_rows(spark, sf_dir))
    return wrong.select("pos", "rule").unionByName(kept.select(F.lit(-1).cast("long").alias("pos"), F.lit("kept").alias("rule")))


REVIEWED_NEGATIVES = f"WITH {_NEGATIVES} SELECT CASE WHEN rule IS NULL THEN -1 ELSE pos END AS pos, coalesce(rule, 'kept') AS rule FROM nd"


def negative_violations(spark, sf_dir) -> DataFrame:
    """Empty labels, filled negatives, and negatives without an image."""
    files = _label_files(spark, sf_dir)
    lines = val.numbered_lines(files)
    p = v.table(spark, sf_dir, "part").select("p_partkey", "p_size")
    k = F.col("p_partkey")
    stem = F.when(k % 3 == 0, k + 500000).otherwise(k)
    negatives = p.where("p_size < 20").select(F.when(k % 5 == 0, "val").otherwise("train").alias("split"), stem.cast("string").alias("stem"))
    empties = files.select("split", "stem").unionByName(
        p.select(F.when(k % 5 == 0, "val").otherwise("train").alias("split"), (k + 600000).cast("string").alias("stem"))
    )
    found = val.empty_label_violations(empties, lines, negatives).unionByName(val.negatives_without_image(negatives, empties))
    return found.select("rule", "key")


NEGATIVE_VIOLATIONS = f"""WITH {_PART_LINES}, ng AS (
  SELECT DISTINCT CASE WHEN p_partkey % 5 = 0 THEN 'val' ELSE 'train' END AS split, CAST(CASE WHEN p_partkey % 3 = 0 THEN p_partkey + 500000 ELSE p_partkey END AS VARCHAR) AS stem FROM part WHERE p_size < 20), em AS (
  SELECT DISTINCT split, stem FROM pl UNION SELECT CASE WHEN p_partkey % 5 = 0 THEN 'val' ELSE 'train' END, CAST(p_partkey + 600000 AS VARCHAR) FROM part), fl AS (SELECT DISTINCT split, stem FROM ln)
SELECT CASE WHEN fl.stem IS NULL THEN 'empty_label_not_reviewed' ELSE 'reviewed_negative_has_label' END AS rule, em.split || '/' || em.stem AS key
FROM em LEFT JOIN fl USING (split, stem) LEFT JOIN ng ON ng.split = em.split AND ng.stem = em.stem WHERE (fl.stem IS NULL) = (ng.stem IS NULL)
UNION ALL SELECT 'reviewed_negative_without_image', split || '/' || stem FROM ng WHERE NOT EXISTS (SELECT 1 FROM em WHERE em.split = ng.split AND em.stem = ng.stem)"""


def register_negatives(spark, sf_dir) -> DataFrame:
    """Which reviewed negatives may be added to an existing list."""
    kept, _ = check_negatives(_negative_rows(spark, sf_dir))
    named = kept.withColumn("stem", F.when(F.col("stem").endswith("3"), F.concat("stem", F.lit(" x"))).otherwise(F.col("stem")))
    existing = v.table(spark, sf_dir, "part").select(F.lit("train").alias("split"), F.concat(F.lit("n_"), (F.col("p_partkey") * 6).cast("string")).alias("stem"))
    taken = v.table(spark, sf_dir, "part").select(F.concat(F.lit("n_"), (F.col("p_partkey") * 10).cast("string")).alias("stem"))
    fine, wrong = new_negatives(named, existing, taken)
    return wrong.select("rule", "key").unionByName(fine.select(F.lit("added").alias("rule"), F.concat_ws("/", "split", "stem").alias("key")))


REGISTER_NEGATIVES = f"""WITH {_NEGATIVES}, kp AS (SELECT split, CASE WHEN stem LIKE '%3' THEN stem || ' x' ELSE stem END AS stem FROM nd WHERE rule IS NULL), x AS (
  SELECT *, stem LIKE '% x' AS bad, EXISTS (SELECT 1 FROM part WHERE 'n_' || (p_partkey * 10) = kp.stem) AS used,
         split = 'train' AND EXISTS (SELECT 1 FROM part WHERE 'n_' || (p_partkey * 6) = kp.stem) AS listed FROM kp)
SELECT 'bad_output_id' AS rule, split || '/' || stem AS key FROM x WHERE bad UNION ALL SELECT 'file_exists', split || '/' || stem FROM x WHERE NOT bad AND used
UNION ALL SELECT 'negative_exists', split || '/' || stem FROM x WHERE NOT bad AND listed UNION ALL SELECT 'added', split || '/' || stem FROM x WHERE NOT (bad OR used OR listed)"""


def dup_across_splits(spark, sf_dir) -> DataFrame:
    files = v.document_files(spark, sf_dir)
    return val.cross_split_duplicates(files, F.sha2(F.col("text"), 256))


DUP_ACROSS_SPLITS = f"""WITH {v.FILES}, h AS (SELECT *, sha256(text) AS sha256 FROM fl)
SELECT size, sha256, count(*) FILTER (split = 'train') AS train_files, count(*) FILTER (split = 'val') AS val_files, min(path) FILTER (split = 'train') AS first_train,
       min(path) FILTER (split = 'val') AS first_val, count(*) FILTER (split = 'train') * count(*) FILTER (split = 'val') AS pairs
FROM h GROUP BY size, sha256 HAVING count(*) FILTER (split = 'train') > 0 AND count(*) FILTER (split = 'val') > 0"""


def dup_members(spark, sf_dir) -> DataFrame:
    files = v.document_files(spark, sf_dir).withColumn("sha256", F.sha2(F.col("text"), 256))
    return val.duplicate_members(files, val.cross_split_duplicates(files)).select("sha256", "split", "path")


DUP_MEMBERS = f"""WITH {v.FILES}, h AS (SELECT *, sha256(text) AS sha256 FROM fl), d AS (SELECT sha256 FROM h GROUP BY 1 HAVING count(DISTINCT split) = 2)
SELECT sha256, split, path FROM h JOIN d USING (sha256)"""


def _origins(spark, sf_dir) -> DataFrame:
    """Report origins that really cross the splits."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return v.reports(spark, sf_dir).select(
        "report_path",
        F.concat(F.lit("sc"), F.floor(k / 3).cast("string")).alias("scene"),
        F.when(k % 3 == 2, "test").otherwise(F.col("split")).alias("split"),
        F.when(k % 8 > 0, F.concat(F.lit("c"), F.floor(c / 2).cast("string"))).alias("capture_session_id"),
        F.when(k % 9 > 0, F.col("source_video_id")).otherwise(F.lit("")).alias("source_video_id"),
        "accepted",
        "o_custkey",
    )


_ORIGINS = f"""{v.REPORTS}, og AS (
  SELECT report_path, 'sc' || (o_orderkey // 3) AS scene, CASE WHEN o_orderkey % 3 = 2 THEN 'test' ELSE split END AS split,
    CASE WHEN o_orderkey % 8 > 0 THEN 'c' || (o_custkey // 2) END AS capture_session_id, CASE WHEN o_orderkey % 9 > 0 THEN source_video_id ELSE '' END AS source_video_id, accepted FROM rep), lk AS (
  SELECT split, accepted, 'scene' AS kind, scene AS value FROM og UNION ALL SELECT split, accepted, 'capture_session_id', capture_session_id FROM og UNION ALL SELECT split, accepted, 'source_video_id', source_video_id FROM og)"""


def leakage(spark, sf_dir) -> DataFrame:
    return val.leakage(_origins(spark, sf_dir))


LEAKAGE = f"""WITH {_ORIGINS} SELECT kind, value, string_agg(DISTINCT split, '|' ORDER BY split) AS splits FROM lk
WHERE accepted > 0 AND value <> '' GROUP BY kind, value HAVING bool_or(split = 'train') AND bool_or(split = 'val')"""


def leakage_combined(spark, sf_dir) -> DataFrame:
    reports = _origins(spark, sf_dir)
    negatives = v.table(spark, sf_dir, "customer").select(
        F.when(F.col("c_custkey") % 2 == 0, "val").otherwise("train").alias("split"),
        F.concat(F.lit("c"), F.floor(F.col("c_custkey") * 3).cast("string")).alias("capture_session_id"),
        F.concat(F.lit("v"), F.col("c_custkey").cast("string")).alias("source_video_id"),
    )
    return val.combined_leakage(reports, negatives)


LEAKAGE_COMBINED = f"""WITH {_ORIGINS}, al AS (SELECT split, kind, value FROM lk WHERE kind <> 'scene' AND accepted > 0 UNION ALL
  SELECT CASE WHEN c_custkey % 2 = 0 THEN 'val' ELSE 'train' END, 'capture_session_id', 'c' || (c_custkey * 3) FROM customer UNION ALL
  SELECT CASE WHEN c_custkey % 2 = 0 THEN 'val' ELSE 'train' END, 'source_video_id', 'v' || c_custkey FROM customer)
SELECT kind, value, string_agg(DISTINCT split, '|' ORDER BY split) AS splits FROM al WHERE value <> '' GROUP BY kind, value HAVING bool_or(split = 'train') AND bool_or(split = 'val')"""


def missing_source_ids(spark, sf_dir) -> DataFrame:
    return val.missing_source_ids(_origins(spark, sf_dir))


MISSING_SOURCE_IDS = f"""WITH {_ORIGINS} SELECT report_path, capture_session_id, nullif(source_video_id, '') AS source_video_id FROM og
WHERE accepted > 0 AND (coalesce(capture_session_id, '') = '' OR coalesce(source_video_id, '') = '')"""


def independence_warning(spark, sf_dir) -> DataFrame:
    w = val.independence_warning(_origins(spark, sf_dir))
    return w.select(v.long("reports", "reports"), v.long("reused", "reused"), v.long(F.col("needs_manual_check"), "needs_manual_check"))


INDEPENDENCE = f"""SELECT (SELECT count(*) FROM orders) AS reports, count(*) AS reused, CAST(count(*) = 0 AND (SELECT count(*) FROM orders) > 0 AS BIGINT) AS needs_manual_check FROM ({LEAKAGE})"""


def class_counts(spark, sf_dir) -> DataFrame:
    return val.class_counts(_checked(spark, sf_dir)).select("split", v.long("class_id", "class_id"), "instances")


CLASS_COUNTS = f"WITH {_PART_LINES} SELECT split, CAST(c AS BIGINT) AS class_id, count(*) AS instances FROM ck WHERE counted GROUP BY split, c"


def absent_classes(spark, sf_dir) -> DataFrame:
    """Classes of an extended catalogue without instances, per split."""
    extra = spark.createDataFrame([(9, "chest"), (10, "lid"), (11, "cap")], "class_id int, class_name string")
    counts = val.class_counts(_checked(spark, sf_dir)).where("instances >= 1")
    return val.absent_classes(counts, v.class_catalogue(spark).unionByName(extra), ["train", "val", "test"]).select("split", v.long("class_id", "class_id"), "class_name")


ABSENT_CLASSES = f"""WITH {_PART_LINES}, {v.CLASSES}, ac AS (SELECT * FROM cls UNION ALL SELECT * FROM (VALUES (9, 'chest'), (10, 'lid'), (11, 'cap')) t(a, b))
SELECT s.split, CAST(class_id AS BIGINT) AS class_id, class_name FROM ac, (VALUES ('train'), ('val'), ('test')) s(split)
WHERE NOT EXISTS (SELECT 1 FROM ck WHERE counted AND ck.split = s.split AND ck.c = ac.class_id)"""


def active_classes(spark, sf_dir) -> DataFrame:
    a = val.active_classes(val.class_counts(_checked(spark, sf_dir)), v.class_catalogue(spark))
    return a.select(v.long("class_id", "class_id"), "class_name", *[v.long(F.col(c), c) for c in ("in_train", "in_val", "contiguous", "declared")])


ACTIVE_CLASSES = f"""WITH {_PART_LINES}, {v.CLASSES}, s AS (SELECT c, bool_or(split = 'train') AS t, bool_or(split = 'val') AS w FROM ck WHERE counted GROUP BY c)
SELECT CAST(c AS BIGINT) AS class_id, class_name, CAST(t AS BIGINT) AS in_train, CAST(w AS BIGINT) AS in_val,
  CAST((SELECT min(c) = 0 AND max(c) + 1 = count(*) FROM s) AS BIGINT) AS contiguous, CAST(class_name IS NOT NULL AS BIGINT) AS declared FROM s LEFT JOIN cls ON cls.class_id = s.c"""


def claim_conflicts(spark, sf_dir) -> DataFrame:
    li = v.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    claims = li.select(
        F.concat(F.lit("f"), F.col("l_orderkey").cast("string"), F.lit("_"), F.col("l_linenumber").cast("string")).alias("output_id"),
        F.concat(F.lit("r"), (F.col("l_partkey") % 5).cast("string")).alias("report_path"),
        F.concat(F.lit("s"), (F.col("l_partkey") % 5).cast("string")).alias("scene"),
    )
    return val.claim_conflicts(claims)


CLAIM_CONFLICTS = """SELECT 'f' || l_orderkey || '_' || l_linenumber AS output_id, 'r' || min(l_partkey % 5) AS first_report, 'r' || max(l_partkey % 5) AS last_report
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(DISTINCT l_partkey % 5) > 1"""


def scene_outputs(spark, sf_dir) -> DataFrame:
    """Files named after a scene against the accepted ids of that scene (names nest)."""
    o = v.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    k, c = F.col("o_orderkey"), (F.col("o_custkey") % 20).cast("string")
    scene = F.when(k % 2 == 0, F.concat(F.lit("can_"), c)).otherwise(F.concat(F.lit("can_"), c, F.lit("_1")))
    name = F.concat_ws("_", scene, k.cast("string"))
    rows = o.select(scene.alias("scene"), name.alias("output_id"), name.alias("stem"), "o_orderstatus", "o_orderpriority", "o_totalprice")
    scenes = rows.select("scene").distinct()
    accepted = rows.where("o_orderstatus <> 'P'")
    return val.scene_output_differences(scenes, accepted, rows.where("o_orderpriority <> '5-LOW'"), rows.where("o_totalprice > 90000"))


SCENE_OUTPUTS = """WITH f AS (
  SELECT 'can_' || (o_custkey % 20) || CASE WHEN o_orderkey % 2 = 1 THEN '_1' ELSE '' END AS scene,
         'can_' || (o_custkey % 20) || CASE WHEN o_orderkey % 2 = 1 THEN '_1' ELSE '' END || '_' || o_orderkey AS id,
         o_orderstatus <> 'P' AS acc, o_orderpriority <> '5-LOW' AS im, o_totalprice > 90000 AS lb FROM orders), sc AS (SELECT DISTINCT scene FROM f), e AS (SELECT scene, id FROM f WHERE acc),
i AS (SELECT sc.scene, f.id, bool_or(im) AS im, bool_or(lb) AS lb FROM sc JOIN f ON starts_with(f.id, sc.scene || '_') WHERE im OR lb GROUP BY ALL)
SELECT CASE WHEN e.id IS NULL THEN 'extra_output' ELSE 'missing_output' END AS rule, coalesce(e.scene, i.scene) AS scene, coalesce(e.id, i.id) AS output_id
FROM e FULL JOIN i ON e.scene = i.scene AND e.id = i.id WHERE (e.id IS NULL) OR NOT (coalesce(im, false) AND coalesce(lb, false))"""


def accepted_files(spark, sf_dir) -> DataFrame:
    images, labels = _doc_labels(spark, sf_dir)
    accepted = v.table(spark, sf_dir, "documents").select((F.col("doc_id") * 2).cast("string").alias("output_id"))
    return val.accepted_without_files(accepted, images, labels).select("key")


ACCEPTED_FILES = f"""WITH {_DOC_LABELS} SELECT CAST(doc_id * 2 AS VARCHAR) AS key FROM documents
WHERE NOT (CAST(doc_id * 2 AS VARCHAR) IN (SELECT stem FROM im) AND CAST(doc_id * 2 AS VARCHAR) IN (SELECT stem FROM lb))"""


def move_conflicts(spark, sf_dir) -> DataFrame:
    d = v.table(spark, sf_dir, "documents").select("doc_id")
    moves = d.select(F.concat(F.lit("images/val/"), F.floor(F.col("doc_id") * 2 / 3).cast("string")).alias("target"))
    existing = v.table(spark, sf_dir, "labels").select(F.concat(F.lit("images/val/"), F.col("doc_id").cast("string")).alias("target"))
    return val.move_violations(moves, existing).select("rule", "key")


MOVE_CONFLICTS = """WITH m AS (SELECT 'images/val/' || CAST(floor(doc_id * 2 / 3) AS BIGINT) AS t FROM documents)
SELECT 'target_exists' AS rule, t AS key FROM m WHERE t IN (SELECT 'images/val/' || doc_id FROM labels)
UNION ALL SELECT 'duplicate_target', t FROM m GROUP BY t HAVING count(*) > 1"""


def split_summary(spark, sf_dir) -> DataFrame:
    checked = _checked(spark, sf_dir)
    images = _label_files(spark, sf_dir).select("split", "stem")
    return val.split_summary(images, checked, val.line_violations(checked))


SPLIT_SUMMARY = f"""WITH {_PART_LINES}, v AS (SELECT split, unnest(string_split(errors, '|')) AS rule FROM ck WHERE errors <> '')
SELECT split, (SELECT count(DISTINCT stem) FROM pl WHERE pl.split = s.split) AS images, (SELECT count(*) FROM ck WHERE counted AND ck.split = s.split) AS polygons,
       (SELECT count(*) FROM v WHERE v.split = s.split) AS errors FROM (SELECT DISTINCT split FROM pl) s"""


def checksum_violations(spark, sf_dir) -> DataFrame:
    d = v.table(spark, sf_dir, "documents")
    path = F.concat(F.lit("f"), F.col("doc_id").cast("string"))
    files = d.where("lang <> 'fr'").select(path.alias("path"), F.sha2("text", 256).alias("sha256"))
    expected = d.select(path.alias("path"), F.when(F.col("doc_id") % 6 == 0, F.sha2("lang", 256)).otherwise(F.upper(F.sha2("text", 256))).alias("sha256"))
    return inventory.checksum_violations(expected, files)


CHECKSUMS = """SELECT CASE WHEN lang = 'fr' THEN 'file_missing' ELSE 'digest_mismatch' END AS rule, 'f' || doc_id AS key FROM documents
WHERE lang = 'fr' OR (doc_id % 6 = 0 AND sha256(lang) <> sha256(text))"""

assert sorted(OFFICIAL_CLASSES) == KNOWN

def label_merge(spark, sf_dir) -> DataFrame:
    """Stored labels after a run that judged urgent and high orders again, some of them in another split."""
    o = v.table(spark, sf_dir, "orders")
    scene, frame = F.concat(F.lit("s"), F.col("o_custkey").cast("string")), F.concat(F.lit("o"), F.col("o_orderkey").cast("string"))

    def labels(rows, turn, text):
        split = F.when(F.col("o_custkey") % turn == 0, "val").otherwise("train")
        return rows.select(scene.alias("scene_id"), frame.alias("output_id"), split.alias("split"), F.lit(text).alias("text"))

    judged = o.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    chosen = labels(judged.where("o_orderstatus = 'F'"), 5, "new")
    return merge_labels(labels(o.where("o_orderstatus <> 'P'"), 7, "old"), labels(judged, 5, "new"), chosen)


LABEL_MERGE = """WITH n AS (SELECT * FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH'))
SELECT 's' || o_custkey AS scene_id, 'o' || o_orderkey AS output_id, CASE WHEN o_custkey % 7 = 0 THEN 'val' ELSE 'train' END AS split, 'old' AS text
FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey NOT IN (SELECT o_orderkey FROM n) UNION ALL
SELECT 's' || o_custkey, 'o' || o_orderkey, CASE WHEN o_custkey % 5 = 0 THEN 'val' ELSE 'train' END, 'new' FROM n WHERE o_orderstatus = 'F'"""


QUERIES = {
    "label_merge": (label_merge, LABEL_MERGE),
    "label_rules": (label_rules, LABEL_RULES),
    "polygon_area": (polygon_areas, POLYGON_AREAS),
    "label_violations": (label_violations, LABEL_VIOLATIONS),
    "first_errors": (first_errors, FIRST_ERRORS),
    "pairing": (pairing, PAIRING),
    "set_diff": (set_diff, SET_DIFF),
    "same_stem_images": (same_stem_images, SAME_STEM),
    "reviewed_negatives": (reviewed_negatives, REVIEWED_NEGATIVES),
    "negative_violations": (negative_violations, NEGATIVE_VIOLATIONS),
    "register_negatives": (register_negatives, REGISTER_NEGATIVES),
    "dup_across_splits": (dup_across_splits, DUP_ACROSS_SPLITS),
    "dup_members": (dup_members, DUP_MEMBERS),
    "leakage": (leakage, LEAKAGE),
    "leakage_combined": (leakage_combined, LEAKAGE_COMBINED),
    "missing_source_ids": (missing_source_ids, MISSING_SOURCE_IDS),
    "independence_warning": (independence_warning, INDEPENDENCE),
    "class_counts": (class_counts, CLASS_COUNTS),
    "absent_classes": (absent_classes, ABSENT_CLASSES),
    "active_classes": (active_classes, ACTIVE_CLASSES),
    "claim_conflicts": (claim_conflicts, CLAIM_CONFLICTS),
    "scene_outputs": (scene_outputs, SCENE_OUTPUTS),
    "accepted_files": (accepted_files, ACCEPTED_FILES),
    "move_conflicts": (move_conflicts, MOVE_CONFLICTS),
    "split_summary": (split_summary, SPLIT_SUMMARY),
    "checksum_violations": (checksum_violations, CHECKSUMS),
}
