"""Exact interpolated quantiles per key for groups of any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from .ordered import BLOCK, blocked


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: Mapping[str, float],
    *,
    count: str | None = None,
) -> DataFrame:
    """One row per key with linear-interpolated quantiles of the non-null values.

    The built-in exact percentile keeps every distinct value of a group in one
    buffer.  Here equal values are counted before the shuffle and put in order by range partitions.
    Sums per block tell which blocks hold a wanted rank, and only their rows are ranked.
    """
    keys = list(keys)
    counted = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    histogram = blocked(counted, keys, ["_v"])
    along = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    per_block = histogram.groupBy(*keys, BLOCK).agg(F.sum("_c").alias("_n"))
    reach = per_block.select(
        *keys, BLOCK, "_n", F.coalesce(F.sum("_n").over(along), F.lit(0)).alias("_before"), F.sum("_n").over(Window.partitionBy(*keys)).alias("_total")
    )
    ranks = {}
    for name, p in probabilities.items():
        rank = (F.col("_total") - 1) * F.lit(float(p))
        ranks |= {f"_lo_{name}": F.floor(rank), f"_hi_{name}": F.ceil(rank)}
    # only blocks that hold a wanted rank are looked into
    wanted = F.exists(F.array(*ranks.values()), lambda r: (F.col("_before") <= r) & (r < F.col("_before") + F.col("_n")))
    chosen = histogram.join(reach.where(wanted).drop("_n"), [*keys, BLOCK])
    inside = Window.partitionBy(*keys, BLOCK).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = chosen.withColumn("_upto", F.col("_before") + F.sum("_c").over(inside))
    aggregates = [F.max("_total").alias("_total")]
    for name, target in ranks.items():
        here = (F.col("_upto") - F.col("_c") <= target) & (target < F.col("_upto"))
        aggregates.append(F.max(F.when(here, F.col("_v"))).alias(name))
    picked = ranked.groupBy(*keys).agg(*aggregates)
    result = [F.col(k) for k in keys]
    if count:
        result.append(F.col("_total").cast("long").alias(count))
    for name, p in probabilities.items():
        rank = (F.col("_total") - 1) * F.lit(float(p))
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        result.append((low + (high - low) * (rank - F.floor(rank))).alias(name))
    return picked.select(*result)
