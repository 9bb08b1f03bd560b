"""Training and evaluation metrics, class-map checks and sample selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import EPOCH_METRICS, TARGET_FPS


def metric_violations(rows: DataFrame, columns: list[str], id_columns: list[str]) -> DataFrame:
    """Metric cells that are no number, or not finite (columns hold text)."""
    text = rows.select(*id_columns, *[F.col(c).cast("string").alias(c) for c in columns])
    cells = text.unpivot(id_columns, columns, "metric", "value")
    number = F.trim("value").try_cast("double")
    infinite = F.isnan(number) | (F.abs(number) == float("inf"))
    rule = F.when(number.isNull(), "not_a_number").when(infinite, "not_finite")
    return cells.select(*id_columns, "metric", "value", rule.alias("rule")).where(F.col("rule").isNotNull())


def best_epochs(epochs: DataFrame, keys: tuple[str, ...] = ("run",)) -> DataFrame:
    """Best epoch by box plus mask mAP, and the peak of mask mAP alone; the first row wins ties.

    epochs  ``run, row_no, epoch`` and the metric columns
    """
    fitness = F.col("map50_95_b") + F.col("map50_95_m")
    best = F.min(F.struct((-fitness).alias("f"), "row_no", "epoch", *EPOCH_METRICS))
    peak = F.min(F.struct((-F.col("map50_95_m")).alias("f"), "row_no", "epoch", "map50_95_m"))
    grouped = epochs.groupBy(*keys).agg(F.count(F.lit(1)).alias("epochs_recorded"), best.alias("b"), peak.alias("p"))
    return grouped.select(
        *keys,
        "epochs_recorded",
        F.col("b.epoch").alias("best_epoch"),
        (-F.col("b.f")).alias("fitness"),
        *[F.col(f"b.{c}").alias(c) for c in EPOCH_METRICS],
        F.col("p.epoch").alias("mask_peak_epoch"),
        F.col("p.map50_95_m").alias("mask_peak_map50_95"),
    )


def dashboard_epochs(epochs: DataFrame, keys: tuple[str, ...] = ("run",)) -> DataFrame:
    """Best row by mask mAP only; text that is no number counts as lowest."""
    value = F.trim(F.col("map50_95_m").cast("string")).try_cast("double")
    score = F.coalesce(value, F.lit(float("-inf")))
    best = F.min(F.struct((-score).alias("s"), "row_no", "epoch", value.alias("v")))
    return epochs.groupBy(*keys).agg(best.alias("b")).select(
        *keys, F.coalesce(F.col("b.epoch").try_cast("int"), F.lit(-1)).alias("best_epoch"), F.col("b.v").alias("map50_95_m")
    )


def latest_run(runs: DataFrame, name: str | None = None) -> DataFrame:
    """The named run if it exists, else the one with the newest ``mtime`` (``run, path, mtime``)."""
    named = F.lit(1) if not name else F.when(F.col("run") == name, 0).otherwise(1)
    return runs.agg(F.min(F.struct(named.alias("n"), (-F.col("mtime")).alias("m"), "run", "path")).alias("b")).select("b.run", "b.path").where(
        F.col("run").isNotNull()
    )


def false_positives(frames: DataFrame, detections: DataFrame, keys: tuple[str, ...] = ("model",)) -> DataFrame:
    """Detections on frames without targets: counts and rates (null without frames).

    frames ``model, frame_id``; detections ``model, frame_id, class_name``
    """
    keys = list(keys)
    total = frames.groupBy(*keys).agg(F.count(F.lit(1)).alias("frames"))
    # count per frame first: the distinct-frame count is then a plain count
    per_frame = detections.join(frames, [*keys, "frame_id"], "left_semi").groupBy(*keys, "frame_id").agg(F.count(F.lit(1)).alias("n"))
    hits = per_frame.groupBy(*keys).agg(F.sum("n").alias("instances"), F.count(F.lit(1)).alias("frames_hit"))
    joined = total.join(hits, keys, "left").fillna(0, ["instances", "frames_hit"])
    return joined.select(
        *keys,
        "frames",
        F.col("instances").alias("false_positive_instances"),
        F.col("frames_hit").alias("frames_with_false_positive"),
        F.when(F.col("frames") > 0, F.col("frames_hit") / F.col("frames")).alias("false_positive_frames_fraction"),
        F.when(F.col("frames") > 0, F.col("instances") / F.col("frames")).alias("false_positive_instances_per_frame"),
    )


def false_positives_by_class(detections: DataFrame, classes: DataFrame, keys: tuple[str, ...] = ("model",)) -> DataFrame:
    """Detections per model and class of the catalogue, zeros kept."""
    keys = list(keys)
    counted = detections.groupBy(*keys, "class_name").agg(F.count(F.lit(1)).alias("instances"))
    names = [r["class_name"] for r in classes.select("class_name").distinct().limit(10_001).collect()]
    if len(names) > 10_000:
        raise ValueError("class catalogue too large")
    models = detections.select(*keys).distinct().withColumn("class_name", F.explode(F.lit(names)))
    return models.join(counted, [*keys, "class_name"], "left").fillna(0, ["instances"])


def throughput(timings: DataFrame, keys: tuple[str, ...] = ("model",)) -> DataFrame:
    """Frames per second and whether the target is met (``seconds`` per frame)."""
    grouped = timings.groupBy(*keys).agg(F.count(F.lit(1)).alias("frames"), F.sum("seconds").alias("elapsed"))
    fps = F.when(F.col("elapsed") > 0, F.col("frames") / F.col("elapsed"))
    return grouped.withColumn("fps", fps).withColumn("meets_target", F.coalesce(fps >= TARGET_FPS, F.lit(False)))


def benchmark_frames(frames: DataFrame, cap: int, warmup: int) -> DataFrame:
    """First ``cap`` frames in name order, the first ``warmup`` of them flagged (a top-k report)."""
    first = frames.select("frame_id").orderBy("frame_id").limit(cap)
    head = first.orderBy("frame_id").limit(warmup).withColumn("warmup", F.lit(True))
    return first.join(head, "frame_id", "left").fillna(False, ["warmup"])


def class_metrics(classes: DataFrame, metrics: DataFrame) -> DataFrame:
    """Catalogue with its metric rows; ``missing`` marks classes without one."""
    return classes.select("class_id", "class_name").join(metrics, "class_id", "left").withColumn("missing", F.col("recall").isNull())


def candidate_decision(per_class: DataFrame, overall: DataFrame, keys: tuple[str, ...] = ("pair",)) -> DataFrame:
    """Take B only if mask mAP and every class recall beat A and false positives do not grow.

    per_class  ``pair, class_id, recall_a, recall_b``
    overall    ``pair, map_a, map_b, fp_a, fp_b``
    """
    recalls = per_class.groupBy(*keys).agg(
        F.bool_and(F.coalesce(F.col("recall_b") > F.col("recall_a"), F.lit(False))).alias("all_recalls_better"),
        F.count(F.lit(1)).alias("classes"),
    )
    better = F.col("map_b") > F.col("map_a")
    clean = F.col("fp_b") <= F.col("fp_a")
    joined = overall.join(recalls, list(keys), "left")
    take = better & clean & F.coalesce("all_recalls_better", F.lit(False))
    return joined.select(*keys, "classes", better.alias("map_better"), "all_recalls_better", clean.alias("fp_not_worse"), take.alias("adopt_b"))


def first_samples(labels: DataFrame) -> DataFrame:
    """First image (by path) that shows each class."""
    return labels.groupBy("class_id").agg(F.min("image").alias("image"))


def classes_without_sample(samples: DataFrame, classes: DataFrame) -> DataFrame:
    return classes.join(samples, "class_id", "left_anti").select("class_id", "class_name")


def class_map_violations(maps: DataFrame) -> DataFrame:
    """Checks of class maps ``map_id, class_id, class_name``: contiguous ids, unique and non-blank names."""
    by_name = maps.groupBy("map_id", "class_name").agg(F.count(F.lit(1)).alias("n"), F.min("class_id").alias("lo"), F.max("class_id").alias("hi"))
    shape = by_name.groupBy("map_id").agg(
        F.sum("n").alias("n"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
        F.bool_or(F.col("n") > 1).alias("twice"),
        F.bool_or(F.trim("class_name") == "").alias("blank"),
    )
    rules = F.array_compact(
        F.array(
            F.when((F.col("lo") != 0) | (F.col("hi") + 1 != F.col("n")), F.lit("ids_not_contiguous")),
            F.when(F.col("blank"), F.lit("blank_name")),
            F.when(F.col("twice"), F.lit("duplicate_name")),
        )
    )
    return shape.select("map_id", F.explode(rules).alias("rule"))


def prefix_compatibility(maps: DataFrame, official: DataFrame) -> DataFrame:
    """Whether each map is an exact prefix of the official one (``map_id, compatible``)."""
    bad = class_map_violations(maps).select("map_id").distinct().withColumn("_bad", F.lit(True))
    names = official.select("class_id", F.col("class_name").alias("_official"))
    match = maps.join(names, "class_id", "left").groupBy("map_id").agg(
        F.bool_and(F.col("class_name").eqNullSafe(F.col("_official"))).alias("_same")
    )
    return match.join(bad, "map_id", "left").select("map_id", (F.col("_same") & F.col("_bad").isNull()).alias("compatible"))


def merge_class_maps(maps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The longest map, and the maps that are no prefix of it (ties: lowest map id)."""
    sizes = maps.groupBy("map_id").agg(F.count(F.lit(1)).alias("n"))
    longest = sizes.agg(F.min(F.struct((-F.col("n")).alias("n"), "map_id")).alias("b")).select(F.col("b.map_id").alias("map_id"))
    merged = maps.join(longest, "map_id", "left_semi").select("class_id", "class_name")
    conflicts = prefix_compatibility(maps, merged).where(~F.col("compatible")).select("map_id")
    return merged, conflicts


def frame_rates(events: DataFrame, keys: list[str], order: list[str], seconds: Column, block: Column) -> DataFrame:
    """Instantaneous rate against the previous event; null for the first one."""
    from ..functions.geometry import rate_fps
    from ..plans.ordered import scan

    carried = scan(events.withColumn("_s", seconds), keys, order, block, prev={"_before": F.col("_s")})
    return carried.withColumn("fps", F.when(F.col("_before").isNotNull(), rate_fps(F.col("_s") - F.col("_before")))).drop("_s", "_before")
