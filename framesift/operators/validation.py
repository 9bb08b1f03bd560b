"""Dataset checks: label lines, file pairing, claims, duplicates, leakage, classes.

Every check gives rows ``rule, key, detail``; ``all_of`` unions them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.labels import counts_as_polygon, line_errors, parse_line
from ..functions.text import strip


def violation(df: DataFrame, rule: str, key: Column, detail: Column | None = None) -> DataFrame:
    return df.select(
        F.lit(rule).alias("rule"), key.cast("string").alias("key"), (F.lit(None) if detail is None else detail).cast("string").alias("detail")
    )


def all_of(*tables: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def first_errors(violations: DataFrame, k: int = 20) -> DataFrame:
    return violations.orderBy("rule", "key", "detail").limit(k)


def numbered_lines(label_files: DataFrame) -> DataFrame:
    """``split, stem, line_no, line``: blank lines are dropped before numbering.

    label_files  ``split, stem, text``
    """
    lines = F.filter(F.transform(F.split("text", r"\r\n|\r|\n"), strip), lambda x: x != "")
    return label_files.select("split", "stem", F.posexplode(lines).alias("_p", "line")).select(
        "split", "stem", (F.col("_p") + 1).alias("line_no"), "line"
    )


def checked_lines(lines: DataFrame, class_ids: list[int]) -> DataFrame:
    """Adds ``class_id, coords, errors ARRAY, counted`` to label lines."""
    parsed = lines.withColumn("_p", parse_line(F.col("line")))
    known = F.coalesce(F.col("_p.class_id").isin(class_ids), F.lit(False))
    return parsed.select(
        *lines.columns,
        F.col("_p.class_id").alias("class_id"),
        F.col("_p.coords").alias("coords"),
        line_errors(F.col("_p"), known).alias("errors"),
        counts_as_polygon(F.col("_p")).alias("counted"),
    )


def line_violations(checked: DataFrame) -> DataFrame:
    return checked.select(F.explode("errors").alias("rule"), "split", "stem", "line_no").select(
        "rule", F.concat_ws("/", "split", "stem").alias("key"), F.col("line_no").cast("string").alias("detail")
    )


def empty_label_violations(label_files: DataFrame, lines: DataFrame, negatives: DataFrame) -> DataFrame:
    """Empty labels need a reviewed negative, and a reviewed negative must be empty."""
    filled = lines.select("split", "stem").distinct().withColumn("filled", F.lit(True))
    reviewed = negatives.select("split", "stem").distinct().withColumn("reviewed", F.lit(True))
    joined = label_files.select("split", "stem").distinct().join(filled, ["split", "stem"], "left").join(reviewed, ["split", "stem"], "left")
    rule = F.when(F.col("filled").isNull() & F.col("reviewed").isNull(), "empty_label_not_reviewed").when(
        F.col("filled").isNotNull() & F.col("reviewed").isNotNull(), "reviewed_negative_has_label"
    )
    return joined.select(
        rule.alias("rule"), F.concat_ws("/", "split", "stem").alias("key"), F.lit(None).cast("string").alias("detail")
    ).where(F.col("rule").isNotNull())


def pairing_violations(images: DataFrame, labels: DataFrame) -> DataFrame:
    """Images without a label and labels without an image (``split, stem`` each)."""
    on = ["split", "stem"]
    key = F.concat_ws("/", "split", "stem")
    return violation(images.select(*on).distinct().join(labels, on, "left_anti"), "missing_label", key).unionByName(
        violation(labels.select(*on).distinct().join(images, on, "left_anti"), "orphan_label", key)
    )


def same_stem_images(images: DataFrame) -> DataFrame:
    """Stems with more than one image file."""
    counted = images.groupBy("split", "stem").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return violation(counted, "several_images_per_stem", F.concat_ws("/", "split", "stem"), F.col("n"))


def negatives_without_image(negatives: DataFrame, images: DataFrame) -> DataFrame:
    on = ["split", "stem"]
    rest = negatives.select(*on).distinct().join(images, on, "left_anti")
    return violation(rest, "reviewed_negative_without_image", F.concat_ws("/", "split", "stem"))


def claim_conflicts(claims: DataFrame) -> DataFrame:
    """Accepted ids claimed by more than one (report, scene).

    Owners are compared by their minimum and maximum, so no list of owners is built.
    """
    owner = F.struct("report_path", "scene")
    return (
        claims.groupBy("output_id")
        .agg(F.min(owner).alias("a"), F.max(owner).alias("b"))
        .where(F.col("a") != F.col("b"))
        .select("output_id", F.col("a.report_path").alias("first_report"), F.col("b.report_path").alias("last_report"))
    )


def scene_prefixes(stem: Column) -> Column:
    """All prefixes of a stem that end before an underscore."""
    parts = F.split(stem, "_")
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda i: F.array_join(F.slice(parts, 1, i), "_"))


def scene_output_differences(scenes: DataFrame, accepted: DataFrame, images: DataFrame, labels: DataFrame) -> DataFrame:
    """Files that start with a scene name against the accepted ids of that scene.

    scenes ``scene``; accepted ``scene, output_id``; images / labels ``stem``.
    ``startswith`` is turned into an equality join on the underscore prefixes of a stem.
    """

    def of_scene(files: DataFrame, flag: str) -> DataFrame:
        spread = files.select("stem").distinct().where(F.contains(F.col("stem"), F.lit("_"))).select(
            F.col("stem").alias("output_id"), F.explode(F.array_distinct(scene_prefixes(F.col("stem")))).alias("scene")
        )
        return spread.join(scenes.select("scene").distinct(), "scene", "left_semi").withColumn(flag, F.lit(True))

    expected = accepted.join(scenes, "scene", "left_semi").select("scene", "output_id").distinct().withColumn("e", F.lit(True))
    on = ["scene", "output_id"]
    joined = expected.join(of_scene(images, "i"), on, "full_outer").join(of_scene(labels, "l"), on, "full_outer")
    image, label, wanted = (F.coalesce(c, F.lit(False)) for c in ("i", "l", "e"))
    rule = F.when((image | label) & ~wanted, "extra_output").when(wanted & ~(image & label), "missing_output")
    return joined.select(rule.alias("rule"), "scene", "output_id").where(F.col("rule").isNotNull())


def move_violations(moves: DataFrame, existing: DataFrame) -> DataFrame:
    """Targets that exist already, and targets named twice (``target`` column)."""
    taken = moves.join(existing.select("target").distinct(), "target", "left_semi")
    twice = moves.groupBy("target").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return violation(taken, "target_exists", F.col("target")).unionByName(
        violation(twice, "duplicate_target", F.col("target"), F.col("n"))
    )


def accepted_without_files(accepted: DataFrame, images: DataFrame, labels: DataFrame) -> DataFrame:
    """Accepted ids that lack an image or a label."""
    i = images.select(F.col("stem").alias("output_id")).distinct().withColumn("i", F.lit(True))
    lab = labels.select(F.col("stem").alias("output_id")).distinct().withColumn("l", F.lit(True))
    joined = accepted.select("output_id").distinct().join(i, "output_id", "left").join(lab, "output_id", "left")
    return violation(joined.where(F.col("i").isNull() | F.col("l").isNull()), "accepted_without_files", F.col("output_id"))


def shared_sizes(files: DataFrame) -> DataFrame:
    """Files whose size occurs in both splits; only these need a digest.

    The test is an aggregate per size, so a size shared by many files is combined map-side.
    """
    sizes = files.groupBy("size").agg(F.bool_or(F.col("split") == "train").alias("t"), F.bool_or(F.col("split") == "val").alias("v"))
    return files.join(sizes.where("t and v").select("size"), "size", "left_semi")


def cross_split_duplicates(files: DataFrame, digest: Column | None = None) -> DataFrame:
    """Digests present in train and val: file counts per side and number of pairs.

    files  ``split, path, size`` and ``sha256`` (or pass ``digest``).  The pairs of a digest are all
    train files times all val files; they are counted as a product and the files are
    listed by ``duplicate_members``, never multiplied out.
    """
    candidates = shared_sizes(files)
    if digest is not None:
        candidates = candidates.withColumn("sha256", digest)
    train, val = F.col("split") == "train", F.col("split") == "val"
    counted = candidates.groupBy("size", "sha256").agg(
        F.count_if(train).alias("train_files"),
        F.count_if(val).alias("val_files"),
        F.min(F.when(train, F.col("path"))).alias("first_train"),
        F.min(F.when(val, F.col("path"))).alias("first_val"),
    )
    return counted.where("train_files > 0 and val_files > 0").withColumn("pairs", F.col("train_files") * F.col("val_files"))


def duplicate_members(files: DataFrame, duplicates: DataFrame) -> DataFrame:
    """Every file that takes part in a cross-split duplicate, in long form."""
    on = ["size", "sha256"]
    return files.where(F.col("split").isin("train", "val")).join(duplicates.select(*on), on, "left_semi").select(*on, "split", "path")


def leakage(origins: DataFrame) -> DataFrame:
    """Scenes, sessions and videos used in train and in val.

    origins  ``split, accepted`` and any of ``scene, capture_session_id, source_video_id``
    """
    kinds = [c for c in ("scene", "capture_session_id", "source_video_id") if c in origins.columns]
    pairs = F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("value")) for c in kinds])
    rows = origins.where((F.col("accepted") > 0) & (F.coalesce("split", F.lit("")) != "")).select("split", F.inline(pairs))
    return (
        rows.where(F.coalesce("value", F.lit("")) != "")
        .groupBy("kind", "value")
        .agg(
            F.bool_or(F.col("split") == "train").alias("t"),
            F.bool_or(F.col("split") == "val").alias("v"),
            F.bool_or(F.col("split") == "test").alias("x"),
        )
        .where("t and v")
        .select("kind", "value", F.when(F.col("x"), "test|train|val").otherwise("train|val").alias("splits"))
    )


def combined_leakage(reports: DataFrame, negatives: DataFrame) -> DataFrame:
    """Leakage over reports together with reviewed negatives (sessions and videos)."""
    columns = ["split", "accepted", "capture_session_id", "source_video_id"]
    both = reports.select(*columns).unionByName(negatives.withColumn("accepted", F.lit(1)).select(*columns))
    return leakage(both)


def missing_source_ids(reports: DataFrame, key: str = "report_path") -> DataFrame:
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    return reports.where((F.col("accepted") > 0) & (F.coalesce("split", F.lit("")) != "") & (blank("capture_session_id") | blank("source_video_id"))).select(
        key, F.nullif("capture_session_id", F.lit("")).alias("capture_session_id"), F.nullif("source_video_id", F.lit("")).alias("source_video_id")
    )


def independence_warning(reports: DataFrame) -> DataFrame:
    """One row: no origin is reused although reports exist, so people should still check."""
    rows = reports.select(F.lit(1).alias("r"), F.lit(0).alias("u")).unionByName(
        leakage(reports).select(F.lit(0).alias("r"), F.lit(1).alias("u"))
    )
    counted = rows.agg(F.coalesce(F.sum("r"), F.lit(0)).alias("reports"), F.coalesce(F.sum("u"), F.lit(0)).alias("reused"))
    return counted.withColumn("needs_manual_check", (F.col("reports") > 0) & (F.col("reused") == 0))


def class_counts(checked: DataFrame) -> DataFrame:
    """Polygons per split and class."""
    return checked.where("counted").groupBy("split", "class_id").agg(F.count(F.lit(1)).alias("instances"))


def absent_classes(counts: DataFrame, classes: DataFrame, splits: list[str]) -> DataFrame:
    """Classes of the catalogue without an instance in a split."""
    wanted = classes.select("class_id", "class_name", F.explode(F.array(*[F.lit(s) for s in splits])).alias("split"))
    return wanted.join(counts.where("instances > 0"), ["split", "class_id"], "left_anti").select("split", "class_id", "class_name")


def active_classes(counts: DataFrame, classes: DataFrame) -> DataFrame:
    """Classes seen in train or val with their checks; all must hold for training.

    One row per class: in which splits it occurs, whether its id belongs to the run
    of ids from 0, and whether it is declared.
    """
    seen = counts.where((F.col("instances") > 0) & F.col("split").isin("train", "val")).groupBy("class_id").agg(
        F.bool_or(F.col("split") == "train").alias("in_train"), F.bool_or(F.col("split") == "val").alias("in_val")
    )
    # class ids are few: one row per class is left here
    every = Window.partitionBy()
    shape = (F.min("class_id").over(every) == 0) & (F.max("class_id").over(every) + 1 == F.count(F.lit(1)).over(every))
    return seen.withColumn("contiguous", shape).join(classes.select("class_id", "class_name"), "class_id", "left").select(
        "class_id", "class_name", "in_train", "in_val", "contiguous", F.col("class_name").isNotNull().alias("declared")
    )


def set_differences(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Values on one side only: ``extra`` left of right, ``missing`` right of left."""
    tagged = left.select(key, F.lit(True).alias("l")).unionByName(right.select(key, F.lit(False).alias("l")))
    sides = tagged.groupBy(key).agg(F.bool_or("l").alias("l"), F.bool_or(~F.col("l")).alias("r"))
    return sides.where("not (l and r)").select(key, F.when(F.col("l"), "extra").otherwise("missing").alias("side"))


def split_summary(images: DataFrame, checked: DataFrame, violations: DataFrame) -> DataFrame:
    """Images, polygons and errors per split; violations carry ``split/...`` keys."""
    a = images.groupBy("split").agg(F.count(F.lit(1)).alias("images"))
    b = checked.where("counted").groupBy("split").agg(F.count(F.lit(1)).alias("polygons"))
    c = violations.groupBy(F.substring_index("key", "/", 1).alias("split")).agg(F.count(F.lit(1)).alias("errors"))
    return a.join(b, "split", "full_outer").join(c, "split", "full_outer").fillna(0, ["images", "polygons", "errors"])
