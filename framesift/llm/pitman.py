"""Language model scores from a hierarchical Pitman-Yor model over words.

Every text is a sequence of words and one end.  A token's restaurant is that of the word before it (a text
begins after an end); all context restaurants share the root restaurant, whose
base is even over the known words and one place for unknown ones.  Seatings are sampled by Gibbs
sweeps: each sweep seats every context anew given the root's predictive probabilities, then the root
given its customers, with the totals of the sweep before.  Predictive probabilities are averaged over
the sweeps after the burn-in.

A word is known by a 63-bit hash of its bytes; a type is a word after a context.  Map tasks number the words of
a chunk of documents and store it.  A chunk sends its types to buckets by a hash of both words, so no word,
however common, meets in one task.  A type that one chunk holds once, and no other chunk at all, has one customer and one
table at all times, and only counts for its two words; the others are seated in every sweep.  Words are dealt to
ranges of their hashes.  A sweep sends tables of contexts and root counts from the ranges to the buckets that need
them, and sums of new tables back.  In the end every chunk gets the numbers of its words and types.  Number
lists travel as compressed bytes.

Defined results: null or empty text is one end token; documents may repeat or have null ids, each row is
scored (a null id stays null); without training rows all words are unknown; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut, forget
from .common import packed, unpacked

FLUSH = 1_200_000  # tokens of a chunk; its last text is always whole
BUCKET_BYTES = 10_000_000  # text per bucket of types
RANGE_BYTES = 150_000_000  # text per range of words
BURN_IN, SAMPLES = 2, 3
STRENGTH = 1.0
SEED = 13
END = b" "  # no word holds a space
NO_ID = np.iinfo(np.int64).min
#: columns that hold numbers as bytes
KINDS = {
    "n": np.int32, "ids": np.int64, "words": np.int64, "seq": np.int32, "u": np.int32, "w": np.int32, "c": np.int64, "t": np.int64,
    "live": np.uint8, "mark": np.uint8, "at": np.int32, "held": np.int64, "s": np.int64, "f": np.int64, "homes": np.int32, "sizes": np.int32, "places": np.int32,
    "tables": np.int64, "customers": np.int64, "roots": np.int64,
}
SORTED = ("words", "u", "places", "at")
DOCS = "chunk long, n binary, ids binary, words binary, seq binary"
TYPES = "bucket long, chunk long, words binary, u binary, w binary, c binary"
MET = "bucket long, range long, chunk long, mark binary, at binary, words binary, u binary, w binary, c binary, live binary, held binary, s binary, f binary, tables binary, customers binary, once long, twice long"
KNOWN = (
    "range long, bucket long, words binary, held binary, s binary, f binary, homes binary, sizes binary, places binary, tables binary, customers binary, roots binary, "
    "root_c long, root_t long, words_once long, words_twice long, learnt long"
)
SEATED = "bucket long, range long, tables binary, customers binary, t binary"
HEARD = "range long, bucket long, tables binary, customers binary, roots binary, root_c long, root_t long"
ASKED = "range long, chunk long, words binary"
TOLD = "chunk long, range long, bucket long, held binary, tables binary, customers binary, roots binary, c binary, t binary"
SCORE = "id long, held_out boolean, n_tokens long, known long, base double, score double"


class _Local(dict):
    """Numbers of the words met so far in a chunk."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _bytes(values: np.ndarray, name: str) -> bytes:
    """Numbers as compressed bytes; sorted lists as differences."""
    values = np.ascontiguousarray(values, KINDS[name])
    return packed(np.diff(values, prepend=values.dtype.type(0)) if name in SORTED else values, KINDS[name])


def _numbers(value: bytes, name: str) -> np.ndarray:
    values = unpacked(value, KINDS[name])
    return np.cumsum(values, dtype=KINDS[name]) if name in SORTED else values


def _record(schema: str, rows: list[dict]) -> pa.RecordBatch:
    """Rows with arrays turned into bytes; absent columns are null."""
    columns = []
    for field in schema.split(", "):
        name, kind = field.split(" ")
        values = [r.get(name) for r in rows]
        if name in KINDS:
            values = [None if v is None else _bytes(v, name) for v in values]
        columns.append(pa.array(values, {"long": pa.int64(), "binary": pa.binary()}[kind]))
    return pa.record_batch(columns, [f.split(" ")[0] for f in schema.split(", ")])


def _table(schema: str, rows: Iterable[dict]) -> pa.Table:
    """Rows turned into bytes one by one, as they come."""
    return pa.Table.from_batches([_record(schema, []), *(_record(schema, [r]) for r in rows)])


def _each(table: pa.Table | pa.RecordBatch, *order: str) -> Iterator[dict]:
    """Rows by ``order``, each with its numbers read when it is asked for."""
    for r in sorted(table.to_pylist(), key=lambda r: tuple(r[k] for k in order)):
        yield {k: _numbers(v, k) if k in KINDS and v is not None else v for k, v in r.items()}


def _rows(table: pa.Table | pa.RecordBatch, *order: str) -> list[dict]:
    return list(_each(table, *order))


def _joined(rows: Iterable[dict], name: str) -> np.ndarray:
    return np.concatenate([np.zeros(0, KINDS[name]), *(r[name] for r in rows)])


def _hashes(words) -> np.ndarray:
    words = list(words)
    return (np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) >> np.uint64(1)).view(np.int64)


def _ranges(words: np.ndarray, n: int) -> np.ndarray:
    """Where each of ``n`` even ranges of hashes begins in a sorted list, and the end."""
    return np.append(np.searchsorted(words, np.arange(n) * ((1 << 63) // n)), len(words))


def _chunk(texts: list[bytes], held: list[bool], ids: list, key: int) -> pa.RecordBatch:
    local = _Local()
    local[END]
    numbers = []
    for text in texts:
        words = text.lower().split()
        words.append(END)
        numbers.append(np.fromiter(map(local.__getitem__, words), np.int32, len(words)))
    sizes = np.array([len(x) for x in numbers], np.int64)
    names = _hashes(local)
    order = np.argsort(names)
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order))
    ids = np.array([NO_ID if i is None else i for i in ids])
    return _record(DOCS, [{"chunk": key, "n": np.where(held, -sizes, sizes), "ids": ids, "words": names[order], "seq": place[np.concatenate(numbers)]}])


def gathered(docs: DataFrame) -> DataFrame:
    """Documents as numbers of words, one row per chunk."""

    def run(batches):
        numbers = count(TaskContext.get().partitionId() << 22)
        texts, held, ids, size = [], [], [], 0
        for batch in batches:
            for row in range(batch.num_rows):
                text, h, i = (batch.column(k)[row].as_py() for k in ("text", "held", "id"))
                texts.append((text or "").encode())
                held.append(bool(h))
                ids.append(i)
                size += len(texts[-1]) // 5 + 1
                if size >= FLUSH:
                    yield _chunk(texts, held, ids, next(numbers))
                    texts, held, ids, size = [], [], [], 0
        if texts:
            yield _chunk(texts, held, ids, next(numbers))

    return docs.mapInArrow(run, DOCS)


class _Types:
    """Types of a chunk in the order of their buckets: context, word, training customers; and the type of every token."""

    def __init__(self, row: dict, buckets: int) -> None:
        n, words, seq = row["n"], row["words"], row["seq"]
        sizes = np.abs(n.astype(np.int64))
        start = np.searchsorted(words, _hashes([END])[0])
        before = np.concatenate([[start], seq[:-1]]).astype(np.int64)
        before[np.cumsum(sizes)[:-1]] = start
        before *= len(words)
        before += seq
        types, token = np.unique(before, return_inverse=True)
        del before
        learnt = np.bincount(token, np.repeat(n > 0, sizes), minlength=len(types)).astype(np.int64)
        u, w = np.divmod(types, len(words))
        mixed = (words[u].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + words[w].view(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        home = ((mixed ^ mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.uint16 if buckets < 1 << 16 else np.int64)
        order = np.argsort(home, kind="stable")
        self.u, self.w, self.c = u[order].astype(np.int32), w[order].astype(np.int32), learnt[order]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(home, minlength=buckets))])
        self.sizes, self._order, self._token = sizes, order.astype(np.int32), token.astype(np.int32)

    def token(self) -> np.ndarray:
        place = np.empty(len(self._order), np.int32)
        place[self._order] = np.arange(len(self._order))
        return place[self._token]


def sent(stored: DataFrame, buckets: int) -> DataFrame:
    """Types of every chunk, one row per chunk and bucket."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = _rows(batch.slice(i, 1))[0]
                types = _Types(row, buckets)
                number, used = np.empty(len(row["words"]), np.int32), np.zeros(len(row["words"]), bool)
                for b in np.flatnonzero(np.diff(types.first)).tolist():
                    at = slice(types.first[b], types.first[b + 1])
                    used[types.u[at]] = used[types.w[at]] = True
                    places = np.flatnonzero(used)
                    used[places] = False
                    number[places] = np.arange(len(places))
                    yield _record(TYPES, [{"bucket": b, "chunk": row["chunk"], "words": row["words"][places], "u": number[types.u[at]], "w": number[types.w[at]], "c": types.c[at]}])

    return stored.select("chunk", "n", "words", "seq").mapInArrow(run, TYPES)


def _met(ranges: int, table: pa.Table) -> pa.Table:
    """The types of a bucket that are seated, which of each chunk's types these are, and sums over all types for the words of each range."""
    words = np.unique(_joined(_each(table.select(["words"])), "words"))
    codes, learnt, chunks = [], [], []
    for r in _each(table, "chunk"):
        chunks.append((r["chunk"], len(r["u"])))
        place = np.searchsorted(words, r["words"])
        codes.append(place[r["u"]] * len(words) + place[r["w"]])
        learnt.append(r["c"])
    codes, learnt = np.concatenate(codes), np.concatenate(learnt)
    code, at = np.unique(codes, return_inverse=True)
    c = np.bincount(at, learnt, minlength=len(code)).astype(np.int64)
    seated = (c > 1) | (c > 0) & (np.bincount(at, minlength=len(code)) > 1)
    del codes, learnt
    u, w = np.divmod(code, max(1, len(words)))
    alone = (c > 0) & ~seated

    def total(of: np.ndarray, which: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(of[which], None if weight is None else weight[which], minlength=len(words)).astype(np.int64)

    sums = {"held": total(u, c > 0, c), "s": total(u, alone), "f": total(w, alone), "tables": total(u, seated), "customers": total(w, seated)}
    live = (sums["tables"] > 0) | (sums["customers"] > 0)
    number = np.cumsum(live) - 1
    bucket = table.column("bucket")[0].as_py()
    own = {"u": number[u[seated]], "w": number[w[seated]], "c": c[seated]}
    out = [{"bucket": bucket, "range": -1, "once": int((c == 1).sum()), "twice": int((c == 2).sum()), **own}]
    number, end = np.cumsum(seated) - 1, 0
    for chunk, size in chunks:
        some = at[end : (end := end + size)]
        mark = seated[some]
        out.append({"bucket": bucket, "range": -2, "chunk": chunk, "mark": mark, "at": number[some[mark]]})
    known = np.flatnonzero((sums["held"] > 0) | (sums["f"] > 0) | live)
    first = _ranges(words[known], ranges)
    for v in np.flatnonzero(np.diff(first)).tolist():
        some = known[first[v] : first[v + 1]]
        out.append({"bucket": bucket, "range": v, "words": words[some], "live": live[some], **{k: x[some] for k, x in sums.items()}})
    return _table(MET, out)


def _told(row: dict, keep: bool, range_: int, tables: np.ndarray, customers: np.ndarray, roots: np.ndarray) -> list[dict]:
    """What a range tells every bucket about its words, and a row of its own."""
    own = {"range": range_, "bucket": -1, "root_c": int(customers.sum()), "root_t": int(roots.sum())}
    out = [own | ({"tables": tables, "customers": customers, "roots": roots} if keep else {})]
    ends = np.cumsum(row["sizes"])
    for b, end, size in zip(row["homes"].tolist(), ends.tolist(), row["sizes"].tolist()):
        at = row["places"][end - size : end]
        out.append({"range": range_, "bucket": b, "tables": tables[at], "customers": customers[at], "roots": roots[at]})
    return out


def _known(table: pa.Table) -> pa.Table:
    """The words of a range with one table for every type to begin with, and where the words of each bucket are among them."""
    rows = _rows(table, "bucket")
    words = np.unique(_joined(rows, "words"))
    sums = {k: np.zeros(len(words), np.int64) for k in ("held", "s", "f", "tables", "customers")}
    homes, places = [], []
    for r in rows:
        at = np.searchsorted(words, r["words"])
        for k, v in sums.items():
            v[at] += r[k]
        if r["live"].any():
            homes.append(r["bucket"])
            places.append(at[r["live"] > 0])
    tables, customers = sums["s"] + sums["tables"], sums["f"] + sums["customers"]
    fixed = {
        "words": words, "homes": np.array(homes, np.int32), "sizes": np.array([len(x) for x in places], np.int32), "places": np.concatenate([np.zeros(0, np.int64), *places]),
        "words_once": int((customers == 1).sum()), "words_twice": int((customers == 2).sum()), "learnt": int(sums["held"].sum()),
    }
    own, *others = _told(fixed, False, rows[0]["range"], tables, customers, (customers > 0).astype(np.int64))
    return _table(KNOWN, [own | fixed | {k: sums[k] for k in ("held", "s", "f")}, *others])


def seat(customers: np.ndarray, pull: np.ndarray, discount: float, rng) -> np.ndarray:
    """Tables after seating: customer i opens one with probability pull / (pull + i - discount * tables).

    The first 32 customers sit one by one; later ones skip to the next opening by inverting the chance
    that none opens up to it.
    """
    tables = (customers > 0).astype(np.float64)
    for i in range(1, 33):
        live = np.flatnonzero(customers > i)
        if not len(live):
            return tables.astype(np.int64)
        chance = pull[live] / (pull[live] + i - discount * tables[live])
        tables[live] += rng.random(len(live)) < chance
    at = np.full(len(customers), 33.0)
    live = np.flatnonzero(customers > 33)
    while len(live):
        shift = discount * tables[live]
        with np.errstate(over="ignore"):
            at[live] = np.ceil(shift + (at[live] - shift) * rng.random(len(live)) ** (-1 / np.maximum(pull[live], 1e-12)))
        live = live[at[live] < customers[live]]
        tables[live] += 1
        at[live] += 1
    return tables.astype(np.int64)


class Totals:
    """One number for the root, and the constants of a sweep."""

    def __init__(self, root_c: int, root_t: int, vocabulary: int, discounts) -> None:
        self.root_c, self.root_t, self.base = root_c, root_t, 1.0 / (vocabulary + 1)
        self.discount, self.root_discount = discounts

    def root(self, c: np.ndarray, t: np.ndarray) -> np.ndarray:
        d = self.root_discount
        return (c - d * t + (STRENGTH + d * self.root_t) * self.base) / (STRENGTH + self.root_c)


def _seated(at: Totals, number: int, keep: bool, types: pa.Table, told: pa.Table) -> pa.Table:
    """New tables of the types of one bucket, summed for the words of each range."""
    if not types.num_rows or not told.num_rows:
        return _table(SEATED, [])
    row, told = _rows(types)[0], _rows(told, "range")
    tables, customers, roots = (_joined(told, k) for k in ("tables", "customers", "roots"))
    u, w, bucket = row["u"], row["w"], row["bucket"]
    pull = (STRENGTH + at.discount * tables[u]) * at.root(customers, roots)[w]
    t = seat(row["c"], pull, at.discount, np.random.default_rng([SEED, number, bucket]))
    new, root, end = np.bincount(u, t, minlength=len(tables)), np.bincount(w, t, minlength=len(tables)), 0
    out = [{"bucket": bucket, "range": -1, "t": t}] if keep else []
    for r in told:
        some = slice(end, end := end + len(r["tables"]))
        out.append({"bucket": bucket, "range": r["range"], "tables": new[some], "customers": root[some]})
    return _table(SEATED, out)


def _heard(at: Totals, number: int, keep: bool, words: pa.Table, parts: pa.Table) -> pa.Table:
    """The root's tables of the words of one range after the sums of all buckets."""
    row, range_ = _rows(words)[0], words.column("range")[0].as_py()
    tables, customers = row["s"].copy(), row["f"].copy()
    ends = np.cumsum(row["sizes"])
    places = {b: row["places"][end - size : end] for b, end, size in zip(row["homes"].tolist(), ends, row["sizes"])}
    for r in _rows(parts, "bucket"):
        tables[places[r["bucket"]]] += r["tables"]
        customers[places[r["bucket"]]] += r["customers"]
    pull = np.full(len(customers), (STRENGTH + at.root_discount * at.root_t) * at.base)
    roots = seat(customers, pull, at.root_discount, np.random.default_rng([SEED, number, 1, range_]))
    return _table(HEARD, _told(row, keep, range_, tables, customers, roots))


def _answers(asked: pa.Table, known: pa.Table) -> pa.Table:
    """The numbers of a chunk's words in one range, all samples one after the other; unknown words have zeros."""
    names = ("tables", "customers", "roots")
    rows = _rows(known, "sample")
    words = rows[0]["words"] if rows else np.zeros(0, np.int64)
    held = np.append(rows[0]["held"], 0) if rows else np.zeros(1, np.int64)
    samples = {k: np.diff(np.array([np.append(r[k], 0) for r in rows[1:]] or np.zeros((SAMPLES, 1), np.int64)), axis=0, prepend=0) for k in names}

    def of(r: dict) -> dict:
        place = _places(words, r["words"])
        return {"chunk": r["chunk"], "range": r["range"], "bucket": -1, "held": held[place], **{k: v[:, place].ravel() for k, v in samples.items()}}

    return _table(TOLD, map(of, _each(asked)))


def _places(among: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Places in a sorted list, its length for values that it lacks."""
    place = np.searchsorted(among, values)
    return np.where(np.append(among, -1)[place] == values, place, len(among))


def _types_told(marked: pa.Table, known: pa.Table) -> pa.Table:
    """Customers and the sum of the sampled tables for the types of every chunk; zeros for types that are not seated."""
    fixed, *samples = _rows(known, "sample")
    t = sum((r["t"] for r in samples), np.zeros(len(fixed["c"]), np.int64))

    def of(r: dict) -> dict:
        c_, t_ = np.zeros((2, len(r["mark"])), np.int64)
        c_[r["mark"] > 0], t_[r["mark"] > 0] = fixed["c"][r["at"]], t[r["at"]]
        return {"chunk": r["chunk"], "range": -1, "bucket": r["bucket"], "c": c_, "t": t_}

    return _table(TOLD, map(of, _each(marked)))


def _finished(samples: list[Totals], low: float, buckets: int, documents: pa.Table, told: pa.Table) -> pa.Table:
    """One row per document of a chunk; every document has a token."""
    row, of_types = _rows(documents)[0], pc.less(told.column("range"), 0)
    n, seq = row["n"], row["seq"]
    of_words = _rows(told.filter(pc.invert(of_types)), "range")
    held = _joined(of_words, "held")
    tables, customers, roots = (
        np.cumsum(np.concatenate([r[k].reshape(SAMPLES, -1) for r in of_words], axis=1), axis=0) for k in ("tables", "customers", "roots")
    )
    pull = [STRENGTH + at.discount * x for at, x in zip(samples, tables, strict=True)]
    root = [at.root(x, y) for at, x, y in zip(samples, customers, roots, strict=True)]
    del of_words, tables, customers, roots
    types = _Types(row, buckets)
    chance = np.empty(len(types.u))
    for r in _each(told.filter(of_types), "bucket"):
        at = slice(types.first[r["bucket"]], types.first[r["bucket"] + 1])
        u, w, c, t = types.u[at], types.w[at], r["c"], r["t"]
        c, t = np.where(c > 0, c, types.c[at]), np.where(c > 0, t, SAMPLES * types.c[at])  # a type that is not seated has at most one customer
        some = SAMPLES * c - samples[0].discount * t
        for x, y in zip(pull, root, strict=True):
            some += x[u] * y[w]
        chance[at] = np.log10(some / (SAMPLES * (STRENGTH + held[u])))
    doc = np.repeat(np.arange(len(n), dtype=np.int32), types.sizes)
    add = lambda v: np.bincount(doc, v, minlength=len(n))
    score = add(chance[types.token()])
    del types, chance
    return pa.table({
        "id": pa.array(row["ids"], mask=row["ids"] == NO_ID), "held_out": n < 0, "n_tokens": np.abs(n.astype(np.int64)),
        "known": add((held > 0)[seq]).astype(np.int64), "base": add((np.log10(held + 0.1) - low)[seq]), "score": score,
    })


def _both(left: DataFrame, right: DataFrame, key: str, schema: str, run, *fixed) -> DataFrame:
    return left.groupBy(key).cogroup(right.groupBy(key)).applyInArrow(lambda a, b: run(*fixed, a, b), schema)


def _sampled(fixed: DataFrame, kept: list[DataFrame]) -> DataFrame:
    """Rows of the first table as sample 0, and of each of the others as 1, 2, ..."""
    out = fixed.withColumn("sample", F.lit(0))
    for number, rows in enumerate(kept, 1):
        out = out.unionByName(rows.withColumn("sample", F.lit(number)), allowMissingColumns=True)
    return out


def score(docs: DataFrame, held_out: Column, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc, held_out, n_tokens, n_known, train_tokens, base_score, score)``, one per row.

    ``held_out`` is a condition over the column ``id``; those rows train nothing.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc).cast("long").alias("id"), F.col(text).alias("text"))
    rows = rows.select("id", "text", held_out.alias("held"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets, ranges = (int(max(4, -(-size // part))) for part in (BUCKET_BYTES, RANGE_BYTES))
    stored = cut(gathered(rows), tidy=True)
    met = cut(sent(stored, buckets).repartition(2 * buckets, "bucket").groupBy("bucket").applyInArrow(lambda table: _met(ranges, table), MET), tidy=True)
    types = met.where("range = -1").select("bucket", "u", "w", "c")
    parts = met.where("range >= 0").select("range", "bucket", "words", "live", "held", "s", "f", "tables", "customers")
    told = cut(parts.groupBy("range").applyInArrow(_known, KNOWN), tidy=True)
    words = told.where("bucket < 0").select("range", "words", "held", "s", "f", "homes", "sizes", "places")
    total = lambda df, *names: tuple(df.agg(*(F.coalesce(F.sum(k), F.lit(0)) for k in names)).first())
    once, twice = total(met, "once", "twice")
    root_c, root_t, words_once, words_twice, train = total(told, "root_c", "root_t", "words_once", "words_twice", "learnt")
    share = lambda a, b: min(0.95, max(0.05, a / (a + 2 * b) if a + b else 0.5))
    vocabulary, discounts = root_t, (share(once, twice), share(words_once, words_twice))
    at = Totals(root_c, root_t, vocabulary, discounts)
    samples, kept_t, kept_words, passing = [], [], [], [met, told]
    for number in range(BURN_IN + SAMPLES):
        keep = number >= BURN_IN
        heard = told.where("bucket >= 0").select("range", "bucket", "tables", "customers", "roots")
        seated = cut(_both(types, heard, "bucket", SEATED, _seated, at, number, keep), tidy=True)
        sums = seated.where("range >= 0").select("range", "bucket", "tables", "customers")
        own = words.select("range", "s", "f", "homes", "sizes", "places")
        told = cut(_both(own, sums, "range", HEARD, _heard, at, number, keep), tidy=True)
        passing += [seated, told]
        at = Totals(*total(told, "root_c", "root_t"), vocabulary, discounts)
        if keep:
            samples.append(at)
            kept_t.append(seated.where("range < 0").select("bucket", "t"))
            kept_words.append(told.where("bucket < 0").select("range", "tables", "customers", "roots"))

    def ask(batches):
        for batch in batches:
            for r in _rows(batch, "chunk"):
                first = _ranges(r["words"], ranges)
                yield _record(ASKED, [{"range": v, "chunk": r["chunk"], "words": r["words"][first[v] : first[v + 1]]} for v in np.flatnonzero(np.diff(first)).tolist()])

    asked = stored.select("chunk", "words").mapInArrow(ask, ASKED)
    of_words = cut(_both(asked, _sampled(words.select("range", "words", "held"), kept_words), "range", TOLD, _answers), tidy=True)
    marked = met.where("range = -2").select("bucket", "chunk", "mark", "at")
    of_types = cut(_both(marked, _sampled(types.select("bucket", "c"), kept_t), "bucket", TOLD, _types_told), tidy=True)
    forget(*passing)
    low = np.log10(train + 0.1 * (vocabulary + 1))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * stored.count())  # few chunks meet in one task
    stored, told = (df.repartition(parts, "chunk") for df in (stored, of_words.unionByName(of_types)))
    found = _both(stored, told, "chunk", SCORE, _finished, samples, low, buckets)
    return found.select(
        F.col("id").alias(doc), "held_out", "n_tokens", F.col("known").alias("n_known"), F.lit(train).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"), "score",
    )
