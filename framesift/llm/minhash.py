"""Near-duplicate documents by ProbMinHash signatures, banding and exact verification.

Words are lower-cased runs without white space; shingles are five words.  A document has a signature of
its distinct shingles and, where shingles repeat, a second one of shingles weighted by a damped count.
ProbMinHash lets every shingle arrive as a Poisson process whose rate is its weight; each arrival falls
on a random register, which keeps the earliest one.  Arrivals later than the latest register cannot
matter, so a document stops early.  Two registers agree with the probability Jaccard similarity of
the shingles as weighted.  Bands are those of both signatures; the similarity that the links are about is
that of distinct shingles, so pairs are told likely or not by the first signature alone.

Texts that agree as word sequences are one class from the start.  Classes that agree in a band are
compared with the band's smallest member; wherever a band still holds several components, its
remaining cross pairs are compared by signature in bounded tiles, which hold the words as well and count likely ones.
Links are pairs whose distinct shingles have a Jaccard similarity of at least the threshold, counted
exactly.  Texts shorter than five words are one shingle; texts without words are duplicates of nothing.

Defined results: null and empty texts stand alone; the document with the smallest id of a component
stays; repeated ids are treated as rows of one document; null ids stand alone and stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut
from .common import perhaps_in, spare
from .graph import components

SHINGLE = 5
REGISTERS, BANDS = 120, 24
ROWS = REGISTERS // BANDS
THRESHOLD = 0.8
LIKELY = 0.58  # signature agreement below which a pair of 0.8 is out of the question: a chance under 1 in 10 million
TILE = 512  # members of a band in a stretch, and
TILE_WORDS = 1_000_000  # their words
SLICE = 400_000  # shingles handled at once


def words(text: Column) -> Column:
    """Hashes of the words of a text, in order."""
    return F.transform(F.regexp_extract_all(F.lower(text), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)), lambda w: F.xxhash64(w))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and row numbers of all shingles; a text of one to four words gives one."""
    with np.errstate(over="ignore"):
        sizes = np.diff(offsets)
        counts = np.where(sizes >= SHINGLE, sizes - SHINGLE + 1, (sizes > 0).astype(sizes.dtype))
        row = np.repeat(np.arange(len(sizes)), counts)
        first = np.repeat(np.cumsum(counts) - counts, counts)
        start = offsets[:-1][row] + (np.arange(len(row)) - first)
        value = np.full(len(row), 0x9E3779B97F4A7C15, np.uint64)
        padded = np.concatenate([flat.astype(np.int64).view(np.uint64), np.zeros(SHINGLE, np.uint64)])
        for i in range(SHINGLE):
            inside = i < sizes[row]
            value = _mix(value * np.uint64(31) + np.where(inside, padded[start + i], np.uint64(1)))
    return value, row


def distinct_shingles(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct shingles per row: hash, row and count."""
    value, row = shingles(flat, offsets)
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    return value[at], row[at], np.diff(np.append(at, len(value)))


def signatures(value: np.ndarray, row: np.ndarray, weight: np.ndarray, rows: int) -> np.ndarray:
    """ProbMinHash registers per row: a 32-bit mark of the earliest arrival of each register."""
    time = np.full(rows * REGISTERS, np.inf)
    mark = np.zeros(rows * REGISTERS, np.uint32)
    clock = np.zeros(len(value))
    live = np.arange(len(value))
    with np.errstate(over="ignore"):
        step = 0
        while len(live):
            step += 1
            h = _mix(value[live] + np.uint64(step) * np.uint64(0xD1342543DE82EF95))
            uniform = ((h >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)
            clock[live] -= np.log(uniform) / weight[live]
            register = (_mix(h ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(REGISTERS)).astype(np.int64)
            slot = row[live] * REGISTERS + register
            at = clock[live]
            early = at < time[slot]
            order = np.lexsort((at[early], slot[early]))
            slots, times, marks = slot[early][order], at[early][order], (value[live][early][order] >> np.uint64(32)).astype(np.uint32)
            first = np.ones(len(slots), bool)
            first[1:] = slots[1:] != slots[:-1]
            time[slots[first]], mark[slots[first]] = times[first], marks[first]
            latest = time.reshape(rows, REGISTERS).max(axis=1)
            live = live[at < latest[row[live]]]  # later arrivals of these can still matter
    return mark.reshape(rows, REGISTERS)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.array(pa.compute.fill_null(pa.compute.list_value_length(column), 0))
    return column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, words) to (id, signature, weighted); rows are handled in slices of bounded size.

    ``signature`` is that of distinct shingles.  ``weighted`` is null where no shingle repeats, as both agree there.
    """
    for batch in batches:
        flat, offsets = _flat(batch.column("words"))
        out, heavy, row = [], [], 0
        while row < batch.num_rows:
            stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLICE, side="right")) - 1)
            value, owner, count = distinct_shingles(flat[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row])
            found = signatures(value, owner, np.ones(len(count)), stop - row)
            out += [found[i].tobytes() for i in range(stop - row)]
            repeats = np.unique(owner[count > 1])
            inside = np.isin(owner, repeats)
            found = signatures(value[inside], np.searchsorted(repeats, owner[inside]), 1.0 + np.log(count[inside]), len(repeats))
            own = dict(zip(repeats.tolist(), (x.tobytes() for x in found), strict=True))
            heavy += [own.get(i) for i in range(stop - row)]
            row = stop
        yield pa.record_batch([batch.column("id"), pa.array(out, pa.binary()), pa.array(heavy, pa.binary())], ["id", "signature", "weighted"])


def _bands(signature: Column) -> Column:
    width = ROWS * 4
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, F.substring(signature, b * width + 1, F.lit(width))))


def _tiles(threshold: float):
    """Links between a stretch of a band's members and the whole stretch of another; pairs of one component are left out.

    Pairs that are likely by signature are counted here, where the words of both are at hand, so only links leave a tile.
    """

    def run(table: pa.Table) -> pa.Table:
        ids, side = table.column("id").to_numpy(), table.column("side").to_numpy()
        component = table.column("component").to_numpy()
        marks = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint32).reshape(-1, REGISTERS)
        value, owner, _ = distinct_shingles(*_flat(table.column("words")))
        sizes = np.bincount(owner, minlength=len(ids))
        first = np.concatenate([[0], np.cumsum(sizes)])
        names, value = np.unique(value, return_inverse=True)
        held = np.zeros(len(names), bool)
        left, right = np.flatnonzero(side <= 1), np.flatnonzero(side >= 1)
        a, b = [], []
        for i in left.tolist():
            others = right[(component[right] != component[i]) & ((right > i) | (side[i] == 0))]
            near = others[(marks[others] == marks[i]).mean(axis=1) >= LIKELY] if len(others) else others
            if len(near):
                held[value[first[i] : first[i + 1]]] = True
                both = np.array([np.count_nonzero(held[value[first[j] : first[j + 1]]]) for j in near.tolist()])
                held[value[first[i] : first[i + 1]]] = False
                found = near[both >= threshold * (sizes[i] + sizes[near] - both) - 1e-9]
                a += [int(ids[i])] * len(found)
                b += ids[found].tolist()
        low, high = np.minimum(a, b) if a else np.zeros(0, np.int64), np.maximum(a, b) if a else np.zeros(0, np.int64)
        return pa.table({"a": pa.array(low, pa.int64()), "b": pa.array(high, pa.int64())})

    return run


def verified(pairs: DataFrame, words_of: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose distinct shingles have at least the threshold's Jaccard similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            left, right = batch.column("left"), batch.column("right")
            for i in range(batch.num_rows):
                sets = []
                for column in (left, right):
                    flat = column[i].values.to_numpy(zero_copy_only=False)
                    sets.append(np.unique(shingles(flat, np.array([0, len(flat)]))[0]))
                both = len(np.intersect1d(*sets, assume_unique=True))
                keep[i] = both >= threshold * (len(sets[0]) + len(sets[1]) - both) - 1e-9
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    found = pairs.join(words_of.select(F.col("id").alias("a"), F.col("words").alias("left")), "a")
    found = found.join(words_of.select(F.col("id").alias("b"), F.col("words").alias("right")), "b")
    return found.select("a", "b", "left", "right").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, doc: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """``(members, links)``.

    ``members``: (id, text_class, component), one row per distinct id that is not null: the smallest
    id with the same words, and the smallest id of the component.  ``links``: the verified pairs of
    different texts that joined the components.
    """
    # numbers of the rows that carry each id keep repeated ids together
    rows = docs.where(F.col(doc).isNotNull()).select(F.col(doc).cast("long").alias("id"), words(F.col(text)).alias("words"))
    stored = cut(rows.select("id", F.expr("nullif(words, cast(array() as array<bigint>))").alias("words")))
    print_ = F.struct(F.xxhash64("words").alias("x"), F.hash("words").alias("y"), F.size("words").alias("n"))
    keyed = stored.where("words is not null").select("id", print_.alias("print"))
    classes = cut(keyed.groupBy("print").agg(F.min("id").alias("text_class")))
    owners = keyed.join(classes, "print").select("id", "text_class").distinct()
    owners = cut(owners.unionByName(stored.where("words is null").select("id", F.col("id").alias("text_class"))).distinct())
    # signatures are short, so they are left out after the fact and no text moves; all ids below are those of classes
    one = stored.where("words is not null")
    lead = classes.select(F.col("text_class").alias("id")).distinct()
    sketched = cut(one.mapInArrow(sketch, "id long, signature binary, weighted binary").join(lead, "id", "left_semi"))
    both = F.when(F.col("weighted").isNull(), _bands(F.col("signature"))).otherwise(F.array_union(_bands(F.col("signature")), _bands(F.col("weighted"))))
    bands = sketched.select("id", F.explode(both).alias("band"))
    leads = bands.groupBy("band").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a < z").select("band", "a")
    members = cut(bands.join(leads, "band").select("band", "id", "a"))  # bands with one member are gone
    first = cut(members.where("id <> a").select("a", F.col("id").alias("b")).distinct())
    ends = cut(first.select(F.explode(F.array("a", "b")).alias("id")).distinct())
    links = cut(verified(first, perhaps_in(one, ends, ends.count()), threshold))
    found = cut(components(members.select("id").distinct(), links))
    # bands that still hold several components
    named = members.select("band", "id").join(found.join(one.select("id", F.size("words").alias("size")), "id"), "id")
    several = named.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n"), F.sum("size").alias("words"))
    parts = F.greatest(F.ceil(F.col("n") / TILE), F.ceil(F.col("words") / TILE_WORDS)).cast("int")
    mixed = several.where("lo < hi").select("band", parts.alias("parts"))
    named = cut(named.drop("size").join(mixed, "band"))
    wanted = cut(named.select("id").distinct())
    number = wanted.count()
    marks, texts = (perhaps_in(x, wanted, number) for x in (sketched.drop("weighted"), one))  # other texts need not move
    spread = named.join(marks.join(texts, "id"), "id")
    spread = spread.withColumn("tile", F.pmod(F.xxhash64("id", F.lit(5)), F.col("parts")).cast("int"))
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    spread = spread.select(
        "band", "id", "component", "signature", "words",
        F.least("tile", "other").alias("t1"), F.greatest("tile", "other").alias("t2"),
        F.when(F.col("tile") == F.col("other"), 1).when(F.col("tile") < F.col("other"), 0).otherwise(2).alias("side"),
    )
    # pairs with the smallest member were counted before and link no two components
    more = cut(spread.groupBy("band", "t1", "t2").applyInArrow(_tiles(threshold), "a long, b long").distinct())
    every = links.unionByName(more)
    if not more.isEmpty():
        found = cut(components(members.select("id").distinct(), every))
    named = owners.join(found.withColumnsRenamed({"id": "text_class"}), "text_class", "left")
    named = named.groupBy("id").agg(F.min("text_class").alias("text_class"), F.min(F.coalesce("component", "text_class")).alias("component"))
    return named, every


def kept_documents(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each group: the one whose id names the component."""
    members, _ = near_duplicates(docs, doc, text)
    name = spare(docs, "gone")
    gone = members.where("component <> id").select(F.col("id").alias(name))
    return docs.join(gone, F.col(doc) == F.col(name), "left_anti")
