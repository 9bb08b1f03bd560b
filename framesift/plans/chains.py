"""Chains in which each kept row decides which later row is kept next.

The motion checks compare a frame with the last frame that passed, and the capture throttle compares a
frame with the last one stored.  Such a chain is sequential by definition, but a block of rows is a function from
the row it inherits to the row it hands on, and most blocks hand on the same row whatever they inherit.

All blocks are first run with nothing inherited, then with the row that the block before handed on.  A block whose
inherited row turns out to be another one is run again; after ``AGAIN`` such rounds, each over the few blocks
still open, the rest of a sequence that has not settled is read once in order, from its first open
block on.  So the number of passes has a fixed bound for any data, and no pass holds more than a batch of rows.

Inside a block there is no step per row: a rule answers for whole columns.  Whether each row would be kept right after
the row before it is asked for all rows at once; a chain follows such runs to their end, and only where a
run breaks the next kept row is searched, in growing stretches.  Rules of even spacing find every row's successor by
one sorted search and mark the chain by doubling its steps.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import cut
from .ordered import BLOCK

AGAIN = 3
Rows = dict[str, np.ndarray]
Keep = Callable[[tuple | None, tuple, tuple], bool]


def taken(rows: Rows, at) -> Rows:
    return {name: values[at] for name, values in rows.items()}


class Rule:
    """Which rows a chain keeps, for whole columns at once; absent numbers are NaN."""

    ahead = True  # may be asked with rows that are never kept
    stretch = 16  # rows asked at first when the next kept one is searched

    def possible(self, rows: Rows) -> np.ndarray:
        """Rows that may be kept at all."""
        return np.ones(_size(rows), bool)

    def starts(self, rows: Rows) -> np.ndarray:
        """Rows that are kept when none was kept before."""
        return np.ones(_size(rows), bool)

    def near(self, refs: Rows, rows: Rows) -> np.ndarray:
        """Rows that are kept when the last kept row was that of ``refs`` (one for all, or one each)."""
        raise NotImplementedError

    def follow(self, rows: Rows) -> np.ndarray | None:
        """Place of the row kept after each row of one sequence (its size for none), where known at once."""
        return None


class Spacing(Rule):
    """Keep a row when ``column`` has grown by ``least`` since the last kept one."""

    def __init__(self, column: str, least: float) -> None:
        self.column, self.least = column, least

    def possible(self, rows: Rows) -> np.ndarray:
        return rows[self.column] == rows[self.column]  # not NaN

    def near(self, refs: Rows, rows: Rows) -> np.ndarray:
        return rows[self.column] - refs[self.column] >= self.least

    def follow(self, rows: Rows) -> np.ndarray | None:
        value = rows[self.column]
        if len(value) > 1 and not (np.diff(value) >= 0).all():
            return None
        if self.least <= 0:
            return np.arange(1, len(value) + 1)
        return np.searchsorted(value, value + self.least, side="left")


class EachRow(Rule):
    """A plain function of the last kept row (or None), the row and its extra columns."""

    ahead = False
    stretch = 1

    def __init__(self, keep: Keep, state: Sequence[str], extra: Sequence[str]) -> None:
        self.keep, self.state, self.extra = keep, list(state), list(extra)

    @staticmethod
    def _tuples(rows: Rows, names: list[str]) -> list[tuple]:
        columns = [[None if isinstance(x, float) and x != x else x for x in rows[n].tolist()] for n in names]
        return list(zip(*columns)) if columns else [()] * _size(rows)

    def starts(self, rows: Rows) -> np.ndarray:
        return np.array([self.keep(None, r, e) for r, e in zip(self._tuples(rows, self.state), self._tuples(rows, self.extra))], bool)

    def near(self, refs: Rows, rows: Rows) -> np.ndarray:
        before, own, more = self._tuples(refs, self.state), self._tuples(rows, self.state), self._tuples(rows, self.extra)
        before = before * len(own) if len(before) == 1 else before
        return np.array([self.keep(b, r, e) for b, r, e in zip(before, own, more)], bool)


def _size(rows: Rows) -> int:
    return len(next(iter(rows.values())))


def _found(rule: Rule, refs: Rows, rows: Rows, start: int, stop: int) -> int:
    """First row in ``[start, stop)`` kept after ``refs``; ``stop`` for none."""
    step = rule.stretch
    while start < stop:
        hits = np.flatnonzero(rule.near(refs, taken(rows, slice(start, min(stop, start + step)))))
        if len(hits):
            return start + int(hits[0])
        start, step = start + step, min(step * 4, 1 << 16)
    return stop


def kept_rows(rule: Rule, rows: Rows, begins: np.ndarray, seeds: Rows, seeded: np.ndarray) -> np.ndarray:
    """Rows that are kept, for consecutive sequences that begin at ``begins``.

    ``seeds`` holds one inherited row per sequence, used where ``seeded``.
    """
    n = _size(rows)
    kept = np.zeros(n, bool)
    index = np.flatnonzero(rule.possible(rows))
    if not len(index):
        return kept
    some = taken(rows, index)
    bounds = np.append(np.searchsorted(index, begins), len(index))
    starts = rule.starts(some)
    linked = np.zeros(len(index) + 1, bool)
    if rule.ahead and len(index) > 1:
        linked[1:-1] = rule.near(taken(some, slice(0, -1)), taken(some, slice(1, None)))
    linked[bounds] = False
    breaks = np.flatnonzero(~linked)
    for g in range(len(begins)):
        low, high = int(bounds[g]), int(bounds[g + 1])
        if low == high:
            continue
        if seeded[g]:
            at = _found(rule, taken(seeds, slice(g, g + 1)), some, low, high)
        else:
            first = np.flatnonzero(starts[low:high])
            at = low + int(first[0]) if len(first) else high
        if at >= high:
            continue
        jump = rule.follow(taken(some, slice(at, high)))
        if jump is not None:
            kept[index[at:high][_reached(jump)]] = True
            continue
        while at < high:
            end = int(breaks[np.searchsorted(breaks, at, side="right")])  # the run that ``at`` begins
            kept[index[at:end]] = True
            # where rows were asked ahead, the one at the break is known not to fit
            at = _found(rule, taken(some, slice(end - 1, end)), some, min(high, end + rule.ahead), high)
    return kept


def _reached(jump: np.ndarray) -> np.ndarray:
    """Rows on the way from the first row, by marks that travel twice as far each time."""
    n = len(jump)
    mark = np.zeros(n + 1, bool)
    mark[0] = True
    step = np.append(jump, n)
    for _ in range(n.bit_length()):
        mark[step[mark]] = True
        step = step[step]
    return mark[:n]


def _numbers(column: pa.Array) -> np.ndarray:
    """Numbers with NaN for null; lists of one length become rows, all NaN for null."""
    if pa.types.is_list(column.type):
        sizes = column.value_lengths().to_numpy(zero_copy_only=False)
        width = int(np.nanmax(sizes)) if len(sizes) and column.null_count < len(column) else 0
        out = np.full((len(column), width), np.nan)
        full = np.flatnonzero(sizes == width) if width else np.zeros(0, int)
        if len(full):
            out[full] = column.take(pa.array(full)).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        return out
    return column.to_numpy(zero_copy_only=False)


def _walker(rule: Rule, head: list[str], names: list[str], state: list[str], out: pa.Schema, position: str):
    """Pass over rows sorted by ``head`` and position; a sequence may go on in the next batch."""
    kinds = {f.name: f.type for f in out}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tag, carried = None, None  # sequence in progress, and its last kept row as a one-row table
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            heads = [batch.column(c).dictionary_encode() if not pa.types.is_dictionary(batch.column(c).type) else batch.column(c) for c in head]
            codes = [h.indices.fill_null(-1).to_numpy(zero_copy_only=False) for h in heads]
            change = np.ones(n, bool)
            change[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in codes])
            begins = np.flatnonzero(change)
            own = pa.table({c: batch.column(c) for c in ("_pos", *state)})
            first = tuple(batch.column(c)[0].as_py() for c in head)
            inherited = pa.table({c: batch.column(f"_in_{c}").take(pa.array(begins)) for c in ("_pos", *state)})
            if first == tag and carried is not None:
                inherited = pa.concat_tables([carried, inherited.slice(1)])
            columns = {c: _numbers(batch.column(c)) for c in names}
            seeds = {c: _numbers(inherited.column(c).combine_chunks() if c in state else batch.column(c).take(pa.array(begins))) for c in names}
            for c in state:  # lists that are null in one of both have no width of their own
                if columns[c].ndim == 2 and columns[c].shape[1] != seeds[c].shape[1]:
                    width = max(columns[c].shape[1], seeds[c].shape[1])
                    columns[c], seeds[c] = (x if x.shape[1] == width else np.full((len(x), width), np.nan) for x in (columns[c], seeds[c]))
            seeded = inherited.column("_pos").fill_null(-1).to_numpy() >= 0
            kept = kept_rows(rule, columns, begins, seeds, seeded)
            # the row each row was compared with: a kept one of this batch, else the inherited one
            group = np.cumsum(change) - 1
            last = np.maximum.accumulate(np.where(kept, np.arange(n), -1))
            before = np.concatenate([[-1], last[:-1]])
            none = np.where(seeded, n + np.arange(len(begins)), 2 * n + len(begins))
            ref = np.where(before >= begins[group], before, none[group])
            ends = np.append(begins[1:], n) - 1
            left = np.where(last[ends] >= begins, last[ends], none)
            pool = pa.concat_tables([own, inherited])
            missing = 2 * n + len(begins)
            ref_at, left_at = pa.array(ref, mask=ref == missing), pa.array(left, mask=left == missing)
            before_rows, left_rows = pool.take(ref_at), pool.take(left_at)
            final = np.full(n, len(begins))
            final[ends] = np.arange(len(begins))
            given = pa.array(final, mask=final == len(begins))
            made = {c: batch.column(c) for c in out.names if c in batch.schema.names}
            made |= {position: batch.column("_pos"), "kept": pa.array(kept), "_last": pa.array(final < len(begins))}
            made |= {"ref_pos": before_rows.column("_pos").combine_chunks().fill_null(-1)} | {f"ref_{c}": before_rows.column(c) for c in state}
            made |= {f"_out_{c}": left_rows.column(c).take(given) for c in ("_pos", *state)}
            arrays = [made[c].combine_chunks() if isinstance(made[c], pa.ChunkedArray) else made[c] for c in out.names]
            yield pa.record_batch([a.cast(kinds[c]) for a, c in zip(arrays, out.names)], out.names)
            tag = tuple(batch.column(c)[n - 1].as_py() for c in head)
            carried = left_rows.slice(len(begins) - 1, 1) if left[-1] != missing else None

    return run


def last_kept(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    block: Column,
    state: Sequence[str],
    keep: Keep | Rule,
    extra: Sequence[str] = (),
) -> DataFrame:
    """``keys, position, ref_pos, ref_<state>..., kept`` for every row of ``df``.

    The ``ref`` columns describe the last kept row before it (``ref_pos`` -1 at the start).
    ``keep`` is a ``Rule``, or a pure function ``keep(ref, row, extra)`` of the state of both rows and the extra
    columns of the row.  State columns are numbers or lists of numbers.  ``position`` is a long from 0,
    unique and ascending in a sequence; ``block`` is a monotone expression of it.
    """
    keys, state, extra = list(keys), list(state), list(extra)
    rule = keep if isinstance(keep, Rule) else EachRow(keep, state, extra)
    rows = cut(df.select(*keys, block.alias(BLOCK), F.col(position).cast("long").alias("_pos"), *state, *extra))
    kind = {f.name: f.dataType for f in rows.schema.fields}
    carried = ["_pos", *state]
    fields = [
        *[T.StructField(c, kind[c]) for c in (*keys, BLOCK)],
        T.StructField(position, T.LongType()), T.StructField("ref_pos", T.LongType()),
        *[T.StructField(f"ref_{c}", kind[c]) for c in state],
        T.StructField("kept", T.BooleanType()), T.StructField("_last", T.BooleanType()),
        *[T.StructField(f"_out_{c}", kind[c]) for c in carried],
    ]
    schema = T.StructType(fields)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    result = [*keys, position, "ref_pos", *[f"ref_{c}" for c in state], "kept"]
    nothing = [F.lit(None).cast(kind[c]).alias(f"_in_{c}") for c in carried]
    columns = [*keys, BLOCK, *carried, *extra, *[f"_in_{c}" for c in carried]]

    def walked(fed: DataFrame, head: list[str]) -> DataFrame:
        ordered = fed.select(*columns).repartition(*head).sortWithinPartitions(*head, "_pos")
        return ordered.mapInArrow(_walker(rule, head, [*state, *extra], state, arrow, position), schema)

    def handed(out: DataFrame) -> DataFrame:
        """What each block hands on."""
        last = F.max(F.struct(position, *[f"_out_{c}" for c in carried])).alias("h")
        return out.where("_last").groupBy(*keys, BLOCK).agg(last).select(*keys, BLOCK, *[F.col(f"h._out_{c}") for c in carried])

    head = [*keys, BLOCK]
    several = rows.groupBy(*keys).agg((F.min(BLOCK) != F.max(BLOCK)).alias("m")).where("m")
    if several.isEmpty():  # every sequence is one block
        return walked(rows.select("*", *nothing), head).select(*result)

    along = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)

    def inheriting(exits: DataFrame) -> DataFrame:
        """What each block should inherit, by what the blocks before it handed on."""
        rest = F.last(F.when(F.col("_out__pos").isNotNull(), F.struct(*[f"_out_{c}" for c in carried])), ignorenulls=True).over(along)
        return exits.withColumn("_s", rest).select(*head, *[F.col(f"_s._out_{c}").alias(f"_in_{c}") for c in carried])

    exits = cut(handed(walked(rows.select("*", *nothing), head)))
    used = cut(inheriting(exits))
    parts = [cut(walked(rows.join(used, head), head))]
    exits = cut(handed(parts[0]))
    for _ in range(AGAIN):
        wanted = inheriting(exits).withColumnRenamed("_in__pos", "_want")
        open_ = cut(wanted.join(used.select(*head, F.col("_in__pos").alias("_had")), head).where(~F.col("_want").eqNullSafe(F.col("_had"))).drop("_had").withColumnRenamed("_want", "_in__pos"))
        if open_.isEmpty():
            break
        again = cut(walked(rows.join(open_, head), head))
        parts = [p.join(open_.select(*head), head, "left_anti") for p in parts] + [again]
        exits = cut(exits.join(open_.select(*head), head, "left_anti").unionByName(handed(again)))
        used = cut(used.join(open_.select(*head), head, "left_anti").unionByName(open_.select(*used.columns)))
    else:
        wanted = inheriting(exits).withColumnRenamed("_in__pos", "_want")
        still = wanted.join(used.select(*head, F.col("_in__pos").alias("_had")), head).where(~F.col("_want").eqNullSafe(F.col("_had")))
        # all blocks before the first open one of a sequence are settled
        tail = cut(still.groupBy(*keys).agg(F.min_by(F.struct(BLOCK, "_want", *[f"_in_{c}" for c in state]), BLOCK).alias("t")).select(*keys, F.col(f"t.{BLOCK}").alias("_from"), F.col("t._want").alias("_in__pos"), *[F.col(f"t._in_{c}") for c in state]))
        if not tail.isEmpty():
            rest = rows.join(tail, keys).where(F.col(BLOCK) >= F.col("_from"))
            since = tail.select(*keys, "_from")
            parts = [p.join(since, keys, "left").where(F.col("_from").isNull() | (F.col(BLOCK) < F.col("_from"))).drop("_from") for p in parts]
            parts.append(cut(walked(rest, keys)))
    whole = parts[0].select(*result)
    for part in parts[1:]:
        whole = whole.unionByName(part.select(*result))
    return whole
