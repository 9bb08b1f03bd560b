"""Running functions over long ordered sequences, one block at a time.

``scan`` gives the usual window functions (row index, carry-forward, running
sum, running maximum) without ever putting a whole sequence into one window
partition.  Inside a block they are ordinary windows; across blocks a small
table with one row per block carries the totals, and is joined back.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut, stored

BLOCK = "_blk"
BLOCK_BITS = 14  # a block holds at most 2 ** 14 rows, whatever their ids look like


def blocked(df: DataFrame, keys: Sequence[str], order: Sequence[str], bits: int | None = None) -> DataFrame:
    """``df`` stored in the order of keys and ``order``, with a column ``BLOCK`` for ``scan``.

    Range partitions of the whole order are cut by row number, so blocks are bounded for any spelling of ids and any
    share of a key.  The row numbers are stored with the rows: repeated stages see the same blocks.
    """
    placed = stored(df).repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    number = F.monotonically_increasing_id()
    return cut(placed.withColumn(BLOCK, F.shiftright(number, BLOCK_BITS if bits is None else bits)))


def ranked(df: DataFrame, order: Sequence[str], rank: str, total: str | None = None) -> DataFrame:
    """``df`` with the position of each row in the order of the whole table, from 0.

    Rows are numbered inside range partitions; what came before a partition is the sum of the counts of the earlier ones,
    one number per partition.  There is no window over all rows.
    """
    number = F.monotonically_increasing_id()
    placed = cut(stored(df).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_row", number))
    part = F.shiftright("_row", 33)
    counts = placed.groupBy(part.alias("p")).count().orderBy("p").collect()  # as many as a shuffle has partitions
    offsets, before = [], 0
    for row in counts:
        offsets += [F.lit(row["p"]).cast("long"), F.lit(before).cast("long")]
        before += row["count"]
    inside = F.col("_row") - F.shiftleft(part, 33)
    found = {rank: F.element_at(F.create_map(*offsets), part) + inside if offsets else F.lit(0).cast("long")}
    if total:
        found[total] = F.lit(before).cast("long")
    return placed.withColumns(found).drop("_row")


def scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    block: Column | None = None,
    *,
    index: str | None = None,
    total: str | None = None,
    prev: Mapping[str, Column] | None = None,
    next: Mapping[str, Column] | None = None,
    cumsum: Mapping[str, Column] | None = None,
    cummax: Mapping[str, Column] | None = None,
    whole: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add running columns to ``df``.

    keys, order   sequence key and a total order inside it (neither null, no ties)
    block         monotone expression of the order, see ``blocks``; without one, the column ``BLOCK`` of a table
                  from ``blocked`` is used, or the rows are put in blocks here
    index         zero-based position in the sequence
    total         number of rows of the sequence
    prev / next   last non-null value strictly before / first strictly after
    cumsum        running sum including the row
    cummax        running maximum over the rows strictly before
    whole         sum over the whole sequence

    To carry values that may themselves be null, pass a struct.
    """
    keys, order = list(keys), list(order)
    prev, next = dict(prev or {}), dict(next or {})
    cumsum, cummax, whole = dict(cumsum or {}), dict(cummax or {}), dict(whole or {})
    original = df.columns
    if block is None:
        if BLOCK not in df.columns:
            df = blocked(df, keys, order)
        block = F.col(BLOCK)

    # read twice: once for the block totals (few columns), once for the rows
    work = stored(df).withColumn(BLOCK, block)
    inputs: dict[str, Column] = {}
    for kind, columns in (("p", prev), ("n", next), ("s", cumsum), ("m", cummax), ("w", whole)):
        inputs.update({f"_{kind}_{name}": expr for name, expr in columns.items()})
    if inputs:
        work = work.withColumns(inputs)

    # one row per block; max_by / sum combine map-side before the shuffle
    position = F.struct(*order)
    sums = [F.count(F.lit(1)).alias("_n")]
    for name in prev:
        value = F.col(f"_p_{name}")
        sums.append(F.max_by(value, F.when(value.isNotNull(), position)).alias(f"_p_{name}"))
    for name in next:
        value = F.col(f"_n_{name}")
        sums.append(F.min_by(value, F.when(value.isNotNull(), position)).alias(f"_n_{name}"))
    sums += [F.sum(f"_s_{name}").alias(f"_s_{name}") for name in cumsum]
    sums += [F.max(f"_m_{name}").alias(f"_m_{name}") for name in cummax]
    sums += [F.sum(f"_w_{name}").alias(f"_w_{name}") for name in whole]
    per_block = work.groupBy(*keys, BLOCK).agg(*sums)

    along = Window.partitionBy(*keys).orderBy(BLOCK)
    everything = Window.partitionBy(*keys)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    after = (
        Window.partitionBy(*keys).orderBy(F.col(BLOCK).desc()).rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = per_block.select(
        *keys,
        BLOCK,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_c_n"),
        F.sum("_n").over(everything).alias("_c_total"),
        *[F.last(f"_p_{n}", ignorenulls=True).over(before).alias(f"_c_p_{n}") for n in prev],
        *[F.last(f"_n_{n}", ignorenulls=True).over(after).alias(f"_c_n_{n}") for n in next],
        *[F.sum(f"_s_{n}").over(before).alias(f"_c_s_{n}") for n in cumsum],
        *[F.max(f"_m_{n}").over(before).alias(f"_c_m_{n}") for n in cummax],
        *[F.sum(f"_w_{n}").over(everything).alias(f"_c_w_{n}") for n in whole],
    )

    inside = Window.partitionBy(*keys, BLOCK).orderBy(*order)
    inside_before = inside.rowsBetween(Window.unboundedPreceding, -1)
    inside_upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    # descending order keeps the frame growing; "following" frames are rescanned per row
    inside_after = (
        Window.partitionBy(*keys, BLOCK)
        .orderBy(*[F.col(c).desc() for c in order])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local: dict[str, Column] = {}
    if index:
        local["_l_n"] = F.row_number().over(inside) - 1
    for name in prev:
        local[f"_l_p_{name}"] = F.last(f"_p_{name}", ignorenulls=True).over(inside_before)
    for name in cumsum:
        local[f"_l_s_{name}"] = F.sum(f"_s_{name}").over(inside_upto)
    for name in cummax:
        local[f"_l_m_{name}"] = F.max(f"_m_{name}").over(inside_before)
    for name in next:
        local[f"_l_n_{name}"] = F.last(f"_n_{name}", ignorenulls=True).over(inside_after)
    rows = work.withColumns(local) if local else work

    joined = rows.join(carried, [*keys, BLOCK], "left")
    result = [F.col(c) for c in original]
    if index:
        result.append((F.coalesce("_c_n", F.lit(0)) + F.col("_l_n")).cast("long").alias(index))
    if total:
        result.append(F.col("_c_total").cast("long").alias(total))
    for name in prev:
        result.append(F.coalesce(f"_l_p_{name}", f"_c_p_{name}").alias(name))
    for name in next:
        result.append(F.coalesce(f"_l_n_{name}", f"_c_n_{name}").alias(name))
    for name in cumsum:
        zero = F.lit(0)
        result.append((F.coalesce(f"_l_s_{name}", zero) + F.coalesce(f"_c_s_{name}", zero)).alias(name))
    for name in cummax:
        result.append(F.greatest(f"_l_m_{name}", f"_c_m_{name}").alias(name))
    result += [F.col(f"_c_w_{name}").alias(name) for name in whole]
    return joined.select(*result)
