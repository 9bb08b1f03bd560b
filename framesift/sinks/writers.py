"""Labels, reports, descriptors and logs."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators.validation import violation
from ..session import cut

SEGMENT_PARTS = 64  # folders that scenes are dealt to


def replace_partitions(df: DataFrame, path: str, *partition: str, format: str = "parquet") -> None:
    """Overwrite exactly the partitions present in ``df``; rows of an earlier run vanish with them."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition).format(format).save(path)


def label_texts(lines: DataFrame) -> DataFrame:
    """One text per frame: instance lines in manifest order, each ended by a newline."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("ord", "line"))), lambda s: s["line"])
    return lines.groupBy("split", "scene_id", "output_id").agg(F.concat(F.array_join(ordered, "\n"), F.lit("\n")).alias("text"))


def merge_labels(stored: DataFrame, verdicts: DataFrame, chosen: DataFrame) -> DataFrame:
    """Labels after a run: those of frames the run did not judge, and the ``chosen`` ones.

    A frame of ``verdicts`` loses its earlier label in every split, whatever its new status;
    ``output_id`` names a frame of a scene.
    """
    on = ["scene_id", "output_id"]
    return stored.join(verdicts.select(*on).distinct(), on, "left_anti").select(*chosen.columns).unionByName(chosen)


def _rewrite_scenes(verdicts: DataFrame, chosen: DataFrame, path: str) -> None:
    """Merge ``chosen`` into the table at ``path`` and write every scene of ``verdicts`` anew.

    Partitions are scenes, and ``split`` is a column, so a scene that moves leaves its split.  A stored
    scene that loses all labels keeps one row without ``output_id``, since a partition that gets no rows
    would stay as it was.  ``read_labels`` leaves these rows out.
    """
    spark = verdicts.sparkSession
    scenes = verdicts.select("scene_id").distinct()
    try:
        stored = spark.read.schema(chosen.schema).parquet(path).join(scenes, "scene_id", "left_semi")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = chosen.limit(0)
    merged = cut(merge_labels(stored.where("output_id is not null"), verdicts, chosen))
    empty = stored.select("scene_id").distinct().join(merged.select("scene_id").distinct(), "scene_id", "left_anti")
    rows = cut(merged.unionByName(empty, allowMissingColumns=True))  # all is read before the scenes are replaced
    replace_partitions(rows, path, "scene_id")


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """The labels that ``write_labels`` or ``write_candidates`` stored."""
    return spark.read.parquet(path).where("output_id is not null")


def write_labels(verdicts: DataFrame, path: str) -> None:
    """Label texts of accepted frames by scene; frames that are no longer accepted lose theirs."""
    accepted = verdicts.where("status = 'accepted'").select("split", "scene_id", "output_id", F.concat("label_text", F.lit("\n")).alias("text"))
    _rewrite_scenes(verdicts, accepted, path)


def write_candidates(verdicts: DataFrame, path: str) -> None:
    """Label texts of frames that still need review, by scene; decided frames lose theirs."""
    rest = verdicts.where("status <> 'accepted' and label_text is not null")
    rest = rest.select("split", "scene_id", "output_id", "status", F.concat("label_text", F.lit("\n")).alias("text"))
    _rewrite_scenes(verdicts, rest, path)


def flat(df: DataFrame) -> DataFrame:
    """CSV form: lists of text joined by a pipe, other nested cells as JSON."""
    columns = []
    for field in df.schema.fields:
        kind = field.dataType.simpleString()
        c = F.col(field.name)
        if kind == "array<string>":
            c = F.array_join(c, "|")
        elif kind.startswith(("array", "struct", "map")):
            c = F.to_json(c)
        columns.append(c.alias(field.name))
    return df.select(*columns)


def write_report(df: DataFrame, path: str, *partition: str, judged: DataFrame | None = None) -> None:
    """The same rows as JSON and as CSV.

    ``judged`` names the partitions that the run looked at (their partition columns).  Those that got no row are
    written anew as well, with one row that is null but for the partition, which ``read_report`` leaves out:
    a scene that left a report does not keep its old rows there.
    """
    if judged is not None:
        absent = judged.select(*partition).distinct().join(df.select(*partition).distinct(), list(partition), "left_anti")
        df = cut(df.unionByName(absent, allowMissingColumns=True))
    replace_partitions(df, f"{path}/json", *partition, format="json")
    flat_df = flat(df)
    flat_df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("header", True).partitionBy(*partition).csv(f"{path}/csv")


def read_report(spark: SparkSession, path: str, schema: StructType, *partition: str) -> DataFrame:
    """The rows of the JSON half of ``write_report``."""
    rows = spark.read.schema(schema).json(f"{path}/json")
    rest = [F.col(c).isNotNull() for c in rows.columns if c not in partition]
    return rows.where(reduce(Column.__or__, rest))


def write_segments(segments: DataFrame, parameters: dict, path: str, parts: int = SEGMENT_PARTS) -> None:
    """Segments with the parameters that produced them; scenes written again lose their earlier rows.

    Scenes are dealt to ``parts`` folders by a hash, so the number of files does not grow with that of the scenes.
    Folders that hold a scene of ``segments`` are written anew, with the rows of their other scenes.
    ``parts`` may not change between runs.
    """
    settings = F.struct(*[F.lit(v).alias(k) for k, v in parameters.items()])
    rows = segments.withColumns({"parameters": settings, "part": F.pmod(F.xxhash64("scene_id"), F.lit(parts)).cast("int")})
    spark = segments.sparkSession
    try:
        stored = spark.read.schema(rows.schema).json(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    else:
        rows = cut(rows)
        scenes = rows.select(F.col("scene_id").alias("_scene"), F.col("part").alias("_part")).distinct()
        touched = F.broadcast(scenes.select("_part").distinct())  # at most as many as there are parts
        others = stored.join(touched, F.col("part") == F.col("_part"), "left_semi")
        others = others.join(scenes, F.col("scene_id").eqNullSafe(F.col("_scene")), "left_anti")
        rows = cut(rows.unionByName(others))  # all is read before the folders are replaced
    replace_partitions(rows.repartition("part"), path, "part", format="json")


def write_proposals(routed: DataFrame, path: str) -> None:
    """Proposals, hard negatives and cross-checks in one table; an existing report is kept."""
    routed.write.mode("errorifexists").partitionBy("kind").json(path)


def write_summary(row: DataFrame, path: str) -> None:
    """One-row documents: descriptors, snapshots, release and evaluation summaries."""
    row.coalesce(1).write.mode("overwrite").json(path)


def write_validation(violations: DataFrame, summary: DataFrame, path: str, fail: bool = True) -> None:
    """Violations and per-split numbers; raises with the first 20 when there are any."""
    violations.write.mode("overwrite").parquet(f"{path}/violations")
    summary.write.mode("overwrite").parquet(f"{path}/summary")
    if not fail:
        return
    stored = violations.sparkSession.read.schema(violations.schema).parquet(f"{path}/violations")
    first = stored.orderBy("rule", "key", "detail").limit(20).collect()
    if first:
        lines = "\n".join(f" - {r['rule']}: {r['key']} {r['detail'] or ''}".rstrip() for r in first)
        raise ValueError(f"dataset check failed, {stored.count()} violations; first ones:\n{lines}")


def append_overrides(decisions: DataFrame, path: str) -> None:
    """Append review decisions to the override log; readers take the newest row per frame."""
    stamped = decisions.withColumn("updated_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"))
    stamped.write.mode("append").partitionBy("scene_id").parquet(path)


def new_negatives(rows: DataFrame, existing: DataFrame, taken_ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Negatives that may be added, and violations of the rest.

    rows ``split, stem, ...``; existing ``split, stem``; taken_ids ``stem`` of images and labels in the dataset
    """
    on = ["split", "stem"]
    bad_name = rows.where(~F.col("stem").rlike(r"^[A-Za-z0-9_-]+$"))
    named = rows.where(F.col("stem").rlike(r"^[A-Za-z0-9_-]+$"))
    used = named.join(taken_ids.select("stem"), "stem", "left_semi")
    listed = named.join(existing.select(*on), on, "left_semi")
    fine = named.join(taken_ids.select("stem"), "stem", "left_anti").join(existing.select(*on), on, "left_anti").dropDuplicates(on)
    key = F.concat_ws("/", "split", "stem")
    wrong = (
        violation(bad_name, "bad_output_id", key)
        .unionByName(violation(used, "file_exists", key))
        .unionByName(violation(listed, "negative_exists", key))
    )
    return fine, wrong


def append_negatives(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").partitionBy("split").json(path)
