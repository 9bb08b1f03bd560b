"""YAML and JSON documents as tables."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..constants import SPLITS, STATUSES
from ..functions.text import blank_to_null, file_stem, scene_identity, strip

_RAW_REPORT = (
    "scene string, split string, capture_session_id string, source_video_id string, frame_status_counts map<string,int>, "
    "instances array<struct<instance_id:string,class_id:int,class_name:string,stage:string,tracker:string>>, "
    "frames array<struct<output_id:string,status:string>>, _corrupt_record string"
)
_RAW_MANIFEST = (
    "classes map<string,string>, project struct<scene:string,split:string,capture_session_id:string,source_video_id:string,"
    "name_prefix:string,quality:map<string,double>,mask_quality:map<string,double>,max_instance_overlap:double,"
    "include_review:boolean,keep_conflicts:boolean,allow_val_fallback_for_smoke:boolean>, "
    "instances array<struct<instance_id:string,class_id:int,class_name:string,tracker:string,start:int,max_frames:int,"
    "key_mask_dir:string,registration_mask_dir:string,mask_dir:string,quality:map<string,double>>>"
)


def file_path() -> Column:
    """Path of the scanned file, decoded, without the scheme of local files."""
    raw = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))  # a plus is no space here
    return F.regexp_replace(F.url_decode(raw), r"^file:/*", "/")


def _yaml_to_json(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    try:
        import yaml

        parse = yaml.safe_load
    except ImportError:  # JSON is a subset of YAML; plain YAML then becomes an error row
        parse = json.loads
    for batch in batches:
        rows = []
        for path, text in zip(batch["path"], batch["value"]):
            try:
                rows.append((path, json.dumps(parse(text) or {}, ensure_ascii=False, default=str), None))
            except Exception as error:  # a bad document is a row, not a failed job
                rows.append((path, None, f"{type(error).__name__}: {error}"))
        yield pd.DataFrame(rows, columns=["path", "json", "error"])


def yaml_documents(spark: SparkSession, path: str, glob: str = "*.y*ml") -> DataFrame:
    """``path, json, error`` per YAML file; one small document per file."""
    texts = spark.read.text(path, wholetext=True, pathGlobFilter=glob).select(file_path().alias("path"), "value")
    return texts.mapInPandas(_yaml_to_json, "path string, json string, error string")


def manifest_errors(documents: DataFrame) -> DataFrame:
    """Documents of ``yaml_documents`` that cannot be read, and those without a project, as violations."""
    project = F.get_json_object("json", "$.project")
    rule = F.when(F.col("error").isNotNull(), "manifest_unreadable").when(project.isNull(), "manifest_without_project")
    return documents.select(rule.alias("rule"), F.col("path").alias("key"), F.coalesce("error", F.lit("")).alias("detail")).where("rule is not null")


def manifests(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Scene manifests; the split defaults to train, the file split comes from the file name.

    An unreadable manifest stops the run (``strict``), or is left out here and listed by ``manifest_errors``.
    """
    documents = yaml_documents(spark, path)
    if strict:
        first = manifest_errors(documents).where("rule = 'manifest_unreadable'").orderBy("key").limit(5).collect()
        if first:
            raise ValueError("unreadable manifests: " + "; ".join(f"{r['key']} ({r['detail']})" for r in first))
    documents = documents.where("error is null")
    m = documents.select("path", F.from_json("json", _RAW_MANIFEST).alias("m"))
    p = F.col("m.project")
    scene = F.element_at(F.split(p["scene"], "/"), -1)
    return m.select(
        F.col("path").alias("manifest_path"),
        scene.alias("scene_id"),
        p["scene"].alias("scene"),
        F.coalesce(p["split"], F.lit("train")).alias("split"),
        F.nullif(F.regexp_extract(file_stem(F.col("path")), r"_(train|val|test)$", 1), F.lit("")).alias("file_split"),
        p["capture_session_id"].alias("capture_session_id"),
        p["source_video_id"].alias("source_video_id"),
        F.coalesce(p["name_prefix"], F.concat(scene, F.lit("_"))).alias("name_prefix"),
        p["quality"].alias("quality"),
        p["mask_quality"].alias("mask_quality"),
        F.coalesce(p["max_instance_overlap"], F.lit(0.20)).alias("max_instance_overlap"),
        F.coalesce(p["include_review"], F.lit(False)).alias("include_review"),
        F.coalesce(p["keep_conflicts"], F.lit(False)).alias("keep_conflicts"),
        F.coalesce(p["allow_val_fallback_for_smoke"], F.lit(False)).alias("allow_val_fallback"),
        F.col("m.instances").alias("instances"),
    )


def manifest_instances(table: DataFrame) -> DataFrame:
    """One row per declared instance, in manifest order (``ord``)."""
    return table.select("scene_id", "split", F.posexplode("instances").alias("ord", "i")).select("scene_id", "split", "ord", "i.*")


def class_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Classes of a configuration, given as a list or as a map of ids."""
    documents = yaml_documents(spark, path, "*")
    raw = F.get_json_object("json", "$.classes")
    as_list = F.from_json(raw, "array<string>")
    as_map = F.from_json(raw, "map<string,string>")
    is_list = raw.startswith("[")
    entries = F.when(is_list, F.transform(as_list, lambda n, i: F.struct(i.cast("int").alias("class_id"), n.alias("class_name")))).otherwise(
        F.transform(F.map_entries(as_map), lambda e: F.struct(e["key"].try_cast("int").alias("class_id"), e["value"].alias("class_name")))
    )
    listed = documents.select("json", F.inline(entries))
    info = F.from_json(F.get_json_object("json", "$.objects"), "map<string,struct<chinese_name:string,role:string>>")
    entry = F.try_element_at(info, F.col("class_name"))
    return listed.select(
        "class_id", "class_name", F.coalesce(entry["chinese_name"], F.col("class_name")).alias("display_name"), entry["role"].alias("role")
    )


def scene_reports(
    spark: SparkSession, path: str, keep_errors: bool = False, repository: str | None = None, project: str | None = None,
    glob: str = "*_report.json", lines: bool = False,
) -> DataFrame:
    """Scene reports ``*_report.json``; scene paths get one spelling, in the checkout ``repository`` if given.

    ``lines``: files hold one report per line, and ``report_path`` names the file they share.

    keep_errors=False drops unreadable reports and reports without a scene;
    keep_errors=True keeps every file and fills ``error`` for unreadable ones.
    """
    raw = spark.read.schema(_RAW_REPORT).json(path, multiLine=not lines, pathGlobFilter=glob)
    rows = raw.select(file_path().alias("report_path"), "*")
    counts = F.coalesce("frame_status_counts", F.create_map().cast("map<string,int>"))
    ids = F.filter(
        F.transform(F.filter("frames", lambda f: f["status"] == "accepted"), lambda f: strip(f["output_id"])), lambda o: o != ""
    )
    names = F.filter(F.transform("instances", lambda i: strip(i["class_name"])), lambda n: n != "")
    none = F.array().cast("array<string>")
    error = F.when(F.col("_corrupt_record").isNotNull(), "unreadable")
    table = rows.select(
        "report_path",
        scene_identity(F.col("scene"), repository, project).alias("scene"),
        F.coalesce("split", F.lit("" if keep_errors else "train")).alias("split"),
        blank_to_null(F.col("capture_session_id")).alias("capture_session_id"),
        blank_to_null(F.col("source_video_id")).alias("source_video_id"),
        F.array_sort(F.array_distinct(F.coalesce(names, none))).alias("class_names"),
        F.array_sort(F.array_distinct(F.coalesce(ids, none))).alias("output_ids"),
        *[F.coalesce(F.try_element_at(counts, F.lit(s)), F.lit(0)).alias(s) for s in STATUSES],
        "instances",
        error.alias("error"),
    )
    if keep_errors:
        return table
    return table.where(F.col("error").isNull() & (F.coalesce("scene", F.lit("")) != "")).drop("error")


def accepted_ids(reports: DataFrame) -> DataFrame:
    """Distinct accepted, non-blank output ids of each report."""
    return reports.select("report_path", "scene", F.explode("output_ids").alias("output_id"))


def quality_reports(spark: SparkSession, path: str, glob: str = "quality_report.json", lines: bool = False) -> DataFrame:
    """Per-frame quality records of the instance reports; with ``lines`` files hold one report per line."""
    schema = (
        "scene string, instance_id string, class_id int, class_name string, split string, tracker string, "
        "records array<struct<id:string,output_id:string,status:string,auto_status:string,manual_status:string,manual_reason:string,"
        "has_label:boolean,reject_reasons:array<string>,review_reasons:array<string>,metrics:map<string,string>>>"
    )
    raw = spark.read.schema(schema).json(path, multiLine=not lines, recursiveFileLookup=True, pathGlobFilter=glob)
    scene = F.element_at(F.split("scene", "/"), -1)
    return raw.select(scene.alias("scene_id"), "instance_id", "class_id", "class_name", "split", F.explode("records").alias("r")).select(
        "scene_id", "instance_id", "class_id", "class_name", "split", F.col("r.id").alias("frame_id"), *[
            F.col(f"r.{c}").alias(c)
            for c in ("output_id", "status", "auto_status", "manual_status", "manual_reason", "has_label", "reject_reasons", "review_reasons", "metrics")
        ]
    )


def segment_reports(spark: SparkSession, path: str) -> DataFrame:
    """Segments as listed in ``segments.json`` files (see ``segments.usable_segments``)."""
    schema = (
        "scene string, segments array<struct<segment_id:string,start_id:string,end_id:string,start_index:int,end_index:int,"
        "frame_count:int,boundary_reasons:array<string>,missing_key_masks:array<string>,required_key_mask_paths:map<string,string>>>"
    )
    raw = spark.read.schema(schema).json(path, multiLine=True, recursiveFileLookup=True, pathGlobFilter="segments.json")
    scene = F.element_at(F.split("scene", "/"), -1)
    return raw.select(scene.alias("scene_id"), F.posexplode("segments").alias("list_pos", "s")).select(
        "scene_id", "list_pos", F.coalesce("s.segment_id", F.col("list_pos").cast("string")).alias("segment_id"), *[
            F.col(f"s.{c}").alias(c)
            for c in ("start_id", "end_id", "start_index", "end_index", "frame_count", "boundary_reasons", "missing_key_masks", "required_key_mask_paths")
        ]
    )


def last_rows_per_frame(rows: DataFrame) -> DataFrame:
    """Of rows with the same frame id the last one counts (``scene_id, frame_id, pos`` + fields)."""
    fields = [c for c in rows.columns if c not in ("scene_id", "frame_id", "pos")]
    return rows.groupBy("scene_id", "frame_id").agg(F.max_by(F.struct(*fields), "pos").alias("r")).select("scene_id", "frame_id", "r.*")


def capture_metadata(spark: SparkSession, path: str, glob: str = "metadata.json", lines: bool = False) -> DataFrame:
    """Frame rows of ``metadata.json`` files; a repeated id keeps its last row.

    The scene is the folder of the file.  With ``lines`` files hold one document per line, which names its ``scene``.
    """
    schema = (
        "frames array<struct<id:string,color_timestamp_ms:double,depth_timestamp_ms:double,sensor_depth_scale:double,valid_depth_ratio:double>>, "
        "depth_to_metre double, scene string"
    )
    raw = spark.read.schema(schema).json(path, multiLine=not lines, recursiveFileLookup=True, pathGlobFilter=glob)
    scene = F.col("scene") if lines else F.element_at(F.split(file_path(), "/"), -2)
    rows = raw.select(scene.alias("scene_id"), "depth_to_metre", F.posexplode("frames").alias("pos", "f")).where("f.id is not null")
    return last_rows_per_frame(rows.select("scene_id", F.col("f.id").alias("frame_id"), "pos", "depth_to_metre", *[
        F.col(f"f.{c}").alias(c) for c in ("color_timestamp_ms", "depth_timestamp_ms", "sensor_depth_scale", "valid_depth_ratio")
    ]))


def reviewed_negatives(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Valid reviewed negatives and the violations of the rest."""
    schema = "items array<struct<split:string,image:string,reviewed_no_targets:string,capture_session_id:string,source_video_id:string>>"
    raw = spark.read.schema(schema).json(path, multiLine=True)
    rows = raw.select(F.posexplode("items").alias("pos", "i")).select("pos", "i.*")
    return check_negatives(rows)


def check_negatives(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Validate negative rows ``pos, split, image, reviewed_no_targets, ...``; the first of a repeated key stays."""
    image = F.coalesce("image", F.lit(""))
    rule = (
        F.when(F.col("split").isNull() & F.col("image").isNull() & F.col("reviewed_no_targets").isNull(), "not_an_object")
        .when(~F.coalesce(F.col("split").isin("train", "val"), F.lit(False)), "bad_split")
        .when((image == "") | (file_stem(image) == ""), "image_missing")
        .when(~F.col("reviewed_no_targets").cast("string").eqNullSafe("true"), "not_confirmed")
    )
    staged = rows.withColumns({"stem": file_stem(image), "rule": rule})
    fine = staged.where("rule is null")
    first = fine.groupBy("split", "stem").agg(F.min("pos").alias("_first"))
    fine = fine.join(first, ["split", "stem"])
    kept = fine.where("pos = _first").select("split", "image", "stem", *[
        F.coalesce(c, F.lit("")).alias(c) for c in ("capture_session_id", "source_video_id")
    ])
    repeated = fine.where("pos > _first").select(F.lit("duplicate").alias("rule"), "pos", F.concat_ws("/", "split", "stem").alias("key"))
    wrong = staged.where("rule is not null").select("rule", "pos", F.concat_ws("/", F.coalesce("split", F.lit("")), image).alias("key"))
    return kept, wrong.unionByName(repeated)


def review_overrides(spark: SparkSession, path: str) -> DataFrame:
    """Override files: one row per frame with a known status."""
    schema = "scene string, instance_id string, frames map<string,struct<status:string,reason:string,updated_at:string>>"
    raw = spark.read.schema(schema).json(path, multiLine=True, recursiveFileLookup=True)
    return raw.select(F.col("scene").alias("scene_id"), "instance_id", F.explode("frames").alias("frame_id", "o")).select(
        "scene_id", "instance_id", "frame_id", "o.status", "o.reason", "o.updated_at"
    ).where(F.col("status").isin(*STATUSES))


def range_requests(spark: SparkSession, path: str) -> DataFrame:
    """Rerun requests in list form or as a single range."""
    item = "struct<segment_id:string,start_frame:string,end_before_frame:string>"
    schema = f"action string, scene string, instance_id string, ranges array<{item}>, segment_id string, start_frame string, end_before_frame string"
    raw = spark.read.schema(schema).json(path, multiLine=True).where(F.col("action").isin("rerun_ranges", "rerun_range"))
    single = F.when(F.col("start_frame").isNotNull(), F.array(F.struct("segment_id", "start_frame", "end_before_frame")))
    return raw.select(F.col("scene").alias("scene_id"), "instance_id", F.explode(F.coalesce("ranges", single)).alias("r")).select(
        "scene_id", "instance_id", "r.segment_id", "r.start_frame", F.nullif("r.end_before_frame", F.lit("")).alias("end_before_frame")
    )


def teacher_config(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Mapping, hard negatives, detectors and scopes of a teacher configuration file."""
    schema = (
        "source_to_official map<string,string>, hard_negative_classes array<string>, "
        "detectors array<struct<name:string,proposal_source:boolean,allowed_official_classes:array<string>>>"
    )
    c = yaml_documents(spark, path, "*").where("error is null").select(F.from_json("json", schema).alias("c")).select("c.*")
    detectors = c.select(F.explode("detectors").alias("d"))
    return (
        c.select(F.explode("source_to_official").alias("source_class", "official_class")),
        c.select(F.explode("hard_negative_classes").alias("source_class")),
        detectors.select(
            F.col("d.name").alias("detector"),
            F.coalesce("d.proposal_source", F.lit(False)).alias("proposal_source"),
            (F.coalesce(F.size("d.allowed_official_classes"), F.lit(0)) > 0).alias("scoped"),
        ),
        detectors.select(F.col("d.name").alias("detector"), F.explode("d.allowed_official_classes").alias("official_class")),
    )


def split_of_file(stem: Column) -> Column:
    """Split named at the end of a manifest or report stem."""
    return F.nullif(F.regexp_extract(stem, rf"_({'|'.join(SPLITS)})(_report)?$", 1), F.lit(""))
