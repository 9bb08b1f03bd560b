"""Alignment of two tokenizations of the same text, and how often token pairs meet in a corpus.

Both tokenizers cut the same bytes (a space, then the text).  A token of one side and a token of the other are
linked where their byte ranges overlap; where both sides end a token, a group of linked tokens ends.

Groups come from pointer jumping.  Every token points to the overlapping token that reaches farthest to the right; a token
whose end is also an end of the other side points to the left side's token that ends there, which points to
itself.  Replacing every pointer by its pointer's pointer doubles the way it spans, so after about log2 of the
longest group all tokens of a group name the same terminal token.  All texts of a batch are one row of
pointers: ranges of different texts never overlap.

Neither tokenizer joins signs across a space that follows a letter, digit or mark (checked when the vocabularies are read;
where it does not hold, texts are not cut).  So texts are cut there, and each different piece of a part of the
corpus is encoded and aligned once.  A part is a bounded stretch of whole texts.  It stores its documents as
numbers of pieces, its pieces as numbers of pairs, and its pairs with the documents that hold them.  Pairs are summed
over all parts by plain aggregation, each part gets the totals of its own pairs back, and sums them per document.

Defined results: texts that are null or empty, or whose joined token bytes differ from the space and the text on
either side, have no tokens, zeros and an empty text of groups; special tokens are plain text; a text of any length is
one whole text; rows may repeat, and each counts as a document; null ids are kept; other columns are not
looked at by ``summarise`` and pass through ``with_groups``; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import cut
from .bpe import _Sent
from .common import packed, sum_by_row, unpacked

MODEL_LIMIT = 64_000_000  # bytes of a tokenizer file that may be sent to every task
PART = 1 << 22  # signs of text after which a part ends; its last text is always whole
_SLICE = 128  # texts encoded at a time
_STRETCH = 64  # pieces encoded as one text
_BEFORE_CUT = re.compile("[!-~À-߿]")
_CUT = re.compile("(?<=[!-~À-߿]) (?!\\Z)")  # only after signs that are no white space anywhere


def _byte_signs() -> dict[str, int]:
    """The sign that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Sides:
    """Both tokenizers with the bytes of their tokens, from the contents of their files."""

    def __init__(self, left: bytes, right: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(left.decode("utf-8"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=right)
        signs = _byte_signs()
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for entry, number in vocabulary.items():
            self.a_bytes[number] = b"".join(bytes([signs[c]]) if c in signs else c.encode() for c in entry)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_size = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_size = np.array([len(t) for t in self.b_bytes], np.int64)
        made = json.loads(left)
        before = made.get("pre_tokenizer") or {}
        level = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space", True)
        probe = "é ﬁ  x\t① "
        same = self.b.normalize(probe) == "▁" + probe.replace(" ", "▁")
        self.cuts = bool(level and not made.get("normalizer") and same and not any(re.search("[^▁]▁", p) for p in pieces))
        decimal = [str(i).encode() for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        self.written = pa.array([d + end for end in (b",", b"|", b";") for d in decimal], pa.binary())
        self.numbers = len(decimal)

    def pieces(self, text: str) -> list[str]:
        return _CUT.split(text) if self.cuts else [text]

    def encode(self, pieces: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids and tokens per piece of both sides, and whether both give back a piece's bytes; if not, it has no ids.

        Pieces that may stand before a cut are encoded many at a time, joined by spaces; a stretch that does not come
        apart again at its pieces is encoded piece by piece.
        """
        stretches, some = [], []
        for piece in pieces:
            some.append(piece)
            if len(some) == _STRETCH or not self.cuts or not _BEFORE_CUT.match(piece[-1:]):
                stretches.append(some)
                some = []
        if some:
            stretches.append(some)
        ids_a, ids_b, n_a, n_b, fine = [], [], [], [], []
        joined = [" ".join(some) for some in stretches]
        for some, text, a, b in zip(stretches, joined, self._left(joined), self._right(joined)):
            found = self._apart(some, text, a, b)
            if found is not None:
                parts = [(*found, True)]
            elif len(some) == 1:
                parts = [([], [], [0], [0], False)]
            else:
                parts = []
                for one, x, y in zip(some, self._left(some), self._right(some)):
                    alone = self._apart([one], one, x, y)
                    parts.append((*alone, True) if alone is not None else ([], [], [0], [0], False))
            for x, y, x_n, y_n, good in parts:
                ids_a.append(x)
                ids_b.append(y)
                n_a += list(x_n)
                n_b += list(y_n)
                fine += [good] * len(x_n)

        def flat(lists: list) -> np.ndarray:
            return np.concatenate([np.asarray(x, np.int64) for x in lists]) if lists else np.zeros(0, np.int64)

        return flat(ids_a), flat(ids_b), np.array(n_a, np.int64), np.array(n_b, np.int64), np.array(fine, bool)

    def _left(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]

    def _right(self, texts: list[str]) -> list[list[int]]:
        return self.b.encode(texts, num_threads=1)

    def _apart(self, pieces: list[str], text: str, a: list[int], b: list[int]):
        """Ids and tokens per piece, where both sides give back all bytes and end a token at the end of every piece."""
        raw = (" " + text).encode()
        if b"".join(map(self.a_bytes.__getitem__, a)) != raw or b"".join(map(self.b_bytes.__getitem__, b)) != raw:
            return None
        ends = np.cumsum([1 + (len(p) if p.isascii() else len(p.encode())) for p in pieces])
        out = []
        for ids, size in ((np.array(a, np.int64), self.a_size), (np.array(b, np.int64), self.b_size)):
            upto = np.cumsum(size[ids])
            at = np.searchsorted(upto, ends)
            if (upto[at] != ends).any():
                return None
            out.append((ids, np.diff(at, prepend=-1)))
        return out[0][0], out[1][0], out[0][1], out[1][1]


def terminals(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The terminal token (a place on the left side) of every token of both sides, by pointer jumping.

    The ends are positions on one axis of bytes; both sides end at its end.
    """
    n = len(a_ends)
    to_b = np.searchsorted(b_ends, a_ends)  # the last overlapping token: the first that ends no earlier
    to_a = np.searchsorted(a_ends, b_ends)
    pointer = np.concatenate([np.where(b_ends[to_b] == a_ends, np.arange(n), n + to_b), to_a])
    while True:
        farther = pointer[pointer]
        if np.array_equal(farther, pointer):
            return pointer[:n], pointer[n:]
        pointer = farther


class Aligned:
    """Groups and links of a batch of pieces; ``a`` and ``b`` are ids, ``a_n`` and ``b_n`` tokens per piece."""

    def __init__(self, sides: Sides, a: np.ndarray, b: np.ndarray, a_n: np.ndarray, b_n: np.ndarray) -> None:
        self.a, self.b, self.a_n, self.b_n = a, b, a_n, b_n
        a_ends, b_ends = np.cumsum(sides.a_size[self.a]), np.cumsum(sides.b_size[self.b])
        self.a_at, self.b_at = (np.concatenate([[0], np.cumsum(n)]) for n in (self.a_n, self.b_n))
        if not len(self.a):
            self.a_group = self.b_group = self.link_a = self.link_b = np.zeros(0, np.int64)
            self.groups = self.links = np.zeros(len(a_n), np.int64)
            self.link_at = np.zeros(len(a_n) + 1, np.int64)
            return
        last_a, last_b = terminals(a_ends, b_ends)
        number = np.cumsum(last_a == np.arange(len(self.a))) - 1
        self.a_group, self.b_group = number[last_a], number[last_b]
        self.groups = sum_by_row((last_a == np.arange(len(self.a))).astype(np.float64), self.a_at).astype(np.int64)
        first = np.searchsorted(b_ends, a_ends - sides.a_size[self.a], side="right")
        count = np.searchsorted(b_ends, a_ends) - first + 1
        at = np.concatenate([[0], np.cumsum(count)])
        self.link_a = np.repeat(self.a, count)
        self.link_b = self.b[np.repeat(first - at[:-1], count) + np.arange(at[-1])]
        self.link_at = at[self.a_at]
        self.links = np.diff(self.link_at)

    def texts(self, sides: Sides) -> list[bytes]:
        """The groups of every piece as ``a1,a2|b1;...``."""
        if not len(self.a):
            return [b""] * len(self.a_n)
        n_groups = int(self.a_group[-1]) + 1
        a_upto = np.cumsum(np.bincount(self.a_group, minlength=n_groups))
        b_upto = np.concatenate([[0], np.cumsum(np.bincount(self.b_group, minlength=n_groups))])
        order = np.empty(len(self.a) + len(self.b), np.int64)
        more_a = np.append(self.a_group[1:] == self.a_group[:-1], False)
        more_b = np.append(self.b_group[1:] == self.b_group[:-1], False)
        order[np.arange(len(self.a)) + b_upto[self.a_group]] = self.a + np.where(more_a, 0, sides.numbers)
        order[np.arange(len(self.b)) + a_upto[self.b_group]] = self.b + np.where(more_b, 0, 2 * sides.numbers)
        written = sides.written.take(pa.array(order))
        _, offsets, data = written.buffers()
        ends = np.frombuffer(offsets, np.int32)[: len(written) + 1][self.a_at + self.b_at].tolist()
        view = data.to_pybytes()
        return [view[x : y - 1] if y > x else b"" for x, y in zip(ends, ends[1:])]


class _Part:
    """The documents of one part, their pieces and the pairs of these."""

    def __init__(self, sides: Sides) -> None:
        self.sides, self.size, self.place = sides, 0, {}
        self.ids: list = []
        self.word_n: list[int] = []
        self.words: list[np.ndarray] = []
        self.digest: list[str] = []
        self.text: list[bytes] = []
        self.facts: list[np.ndarray] = []  # tokens left and right, groups, links, fine; per piece
        self.keys: list[np.ndarray] = []
        self.key_n: list[np.ndarray] = []

    def add(self, ids: list, texts: list[str | None]) -> None:
        place, cut_up = self.place, [self.sides.pieces(t) if t else [] for t in texts]
        new = list(dict.fromkeys(p for pieces in cut_up for p in pieces if p not in place))
        for piece in new:
            place[piece] = len(place)
        if new:
            *tokens, fine = self.sides.encode(new)
            found = Aligned(self.sides, *tokens)
            self.text += found.texts(self.sides)
            self.facts.append(np.stack([found.a_n, found.b_n, found.groups, found.links, fine.astype(np.int64)], axis=1))
            self.keys.append(found.link_a << 32 | found.link_b)
            self.key_n.append(found.links)
        fine = np.concatenate([f[:, 4] for f in self.facts]) > 0 if self.facts else np.zeros(0, bool)
        text = self.text.__getitem__
        for pieces in cut_up:
            words = list(map(place.__getitem__, pieces))
            held = np.array(words, np.int32)
            if not fine[held].all():
                words, held = [], held[:0]
            self.words.append(held)
            self.word_n.append(len(words))
            self.digest.append(sha256(b";".join(map(text, words))).hexdigest() if words else "")
        self.ids += ids
        self.size += sum(map(len, (t for t in texts if t)))
        if len(self.facts) > 64:  # few long arrays instead of many short ones
            self.facts, self.keys, self.key_n = ([np.concatenate(x)] for x in (self.facts, self.keys, self.key_n))

    def row(self, number: int) -> pa.RecordBatch:
        facts = np.concatenate(self.facts) if self.facts else np.zeros((0, 5), np.int64)
        keys = np.concatenate(self.keys) if self.keys else np.zeros(0, np.int64)
        key_n = np.concatenate(self.key_n) if self.key_n else np.zeros(0, np.int64)
        pairs, pair = np.unique(keys, return_inverse=True)
        # links of a piece that have the same pair become one with a count
        of_piece = np.repeat(np.arange(len(key_n)), key_n) * max(1, len(pairs)) + pair
        of_piece, times = np.unique(of_piece, return_counts=True)
        owner, pair = np.divmod(of_piece, max(1, len(pairs)))
        pair_at = np.searchsorted(owner, np.arange(len(key_n) + 1))
        words = np.concatenate(self.words) if self.words else np.zeros(0, np.int32)
        word_at = np.concatenate([[0], np.cumsum(self.word_n)]).astype(np.int64)
        docs = np.zeros(len(pairs), np.int64)
        for start in range(0, len(self.ids), _SLICE):
            stop = min(len(self.ids), start + _SLICE)
            held = words[word_at[start] : word_at[stop]].astype(np.int64)
            doc = np.repeat(np.arange(stop - start), np.diff(word_at[start : stop + 1]))
            doc, held = np.divmod(np.unique(doc * max(1, len(key_n)) + held), max(1, len(key_n)))
            count = pair_at[held + 1] - pair_at[held]
            at = np.concatenate([[0], np.cumsum(count)])
            there = pair[np.repeat(pair_at[held] - at[:-1], count) + np.arange(at[-1])]
            once = np.unique(np.repeat(doc, count) * max(1, len(pairs)) + there)
            docs += np.bincount(once % max(1, len(pairs)), minlength=len(pairs))
        sums = {name: sum_by_row(facts[words, i], word_at).astype(np.int64) for i, name in enumerate(("n_a", "n_b", "n_groups", "n_links"))}
        columns = {
            "part": pa.array([number], pa.int64()),
            "ids": pa.array([self.ids], pa.list_(pa.int64())),
            **{name: _one(value, pa.int64()) for name, value in sums.items()},
            "digests": pa.array([self.digest], pa.list_(pa.string())),
            **{name: pa.array([packed(value)], pa.binary()) for name, value in zip(PACKED, (self.word_n, words, np.diff(pair_at), pair, times))},
            "a": _one(pairs >> 32, pa.int32()), "b": _one(pairs & 0xFFFFFFFF, pa.int32()), "docs": _one(docs, pa.int32()),
        }
        return pa.record_batch(list(columns.values()), list(columns))


def _one(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """One row that holds the whole list."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


PACKED = ("word_n", "words", "pair_n", "pairs", "times")  # the long lists of a part, which only Python reads
_PART_SCHEMA = (
    "part long, ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, digests array<string>, "
    "word_n binary, words binary, pair_n binary, pairs binary, times binary, a array<int>, b array<int>, docs array<int>"
)
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

_sides: dict[int, Sides] = {}


def _sides_of(sent: _Sent) -> Sides:
    """Both tokenizers, once per worker and broadcast."""
    if sent.id not in _sides:
        _sides.clear()
        _sides[sent.id] = Sides(*sent.value)
    return _sides[sent.id]


def _parts_of(sent: _Sent, limit: int, batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    sides = _sides_of(sent)
    base, part = TaskContext.get().partitionId() << 32, None
    for batch in batches:
        for start in range(0, batch.num_rows, _SLICE):
            some = batch.slice(start, _SLICE)
            part = part or _Part(sides)
            part.add(some.column("id").to_pylist(), some.column("text").to_pylist())
            if part.size >= limit:
                yield part.row(base)
                base, part = base + 1, None
    if part:
        yield part.row(base)


def _per_document(part: pa.Table, totals: pa.Table) -> pa.Table:
    """Documents of a part with the sums over the corpus-wide counts of their links."""
    schema = pa.schema([("doc_id", pa.int64()), *[(n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")], ("groups_sha256", pa.string())])
    if not part.num_rows:
        return schema.empty_table()
    lists = {name: part.column(name).combine_chunks().flatten() for name in part.column_names if name not in ("part", *PACKED)}
    number = {name: unpacked(part.column(name)[0].as_py()) for name in PACKED}
    count, best = np.zeros(len(lists["a"]), np.int64), np.zeros(len(lists["a"]), np.int64)
    place = totals.column("place").to_numpy()
    count[place], best[place] = totals.column("count").to_numpy(), totals.column("best").to_numpy()
    pair_at = np.concatenate([[0], np.cumsum(number["pair_n"], dtype=np.int64)])
    word_at = np.concatenate([[0], np.cumsum(number["word_n"], dtype=np.int64)])

    def summed(value: np.ndarray) -> np.ndarray:
        of_piece = np.concatenate([[0], np.cumsum(value[number["pairs"]] * number["times"])])
        of_doc = np.concatenate([[0], np.cumsum(np.diff(of_piece[pair_at])[number["words"]])])
        return np.diff(of_doc[word_at])

    columns = {"doc_id": lists["ids"], **{n: lists[n] for n in ("n_a", "n_b", "n_groups", "n_links")}, "n_best": pa.array(summed(best)), "count_sum": pa.array(summed(count)), "groups_sha256": lists["digests"]}
    return pa.table(columns, schema=schema)


def _read(path: str) -> bytes:
    with open(path, "rb") as file:
        raw = file.read(MODEL_LIMIT + 1)
    if len(raw) > MODEL_LIMIT:
        raise ValueError("the tokenizer is too large to be sent to every task")
    return raw


class Aligner:
    """Alignment by two tokenizer files, read by the driver and broadcast (bounded above)."""

    def __init__(self, spark: SparkSession, left: str, right: str) -> None:
        self._sent = _Sent(spark.sparkContext.broadcast((_read(left), _read(right))))

    def groups(self, text: Column) -> Column:
        """Groups of linked tokens as ``array<struct<a array<int>, b array<int>>>``."""
        sent = self._sent

        def run(texts: pa.Array) -> pa.Array:
            sides, out = _sides_of(sent), []
            for text in texts.to_pylist():
                pieces = sides.pieces(text) if text else []
                *tokens, fine = sides.encode(pieces)
                rows = b";".join(Aligned(sides, *tokens).texts(sides)).decode() if fine.all() and pieces else ""
                both = [group.split("|") for group in rows.split(";")] if rows else []
                out.append([{"a": [int(x) for x in a.split(",")], "b": [int(x) for x in b.split(",")]} for a, b in both])
            return pa.array(out, pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))])))

        return F.arrow_udf(run, "array<struct<a:array<int>,b:array<int>>>")(text)

    def with_groups(self, docs: DataFrame, text: str = "text", groups: str = "groups") -> DataFrame:
        """``docs`` with a column of groups; a column of that name is replaced."""
        return docs.withColumn(groups, self.groups(F.col(text)))

    def parts(self, docs: DataFrame, id_: str = "doc_id", text: str = "text", limit: int = PART) -> DataFrame:
        """The stored parts of the corpus."""
        sent = self._sent
        rows = docs.select(F.col(id_).cast("long").alias("id"), F.col(text).alias("text"))
        return cut(rows.mapInArrow(lambda batches: _parts_of(sent, limit, batches), _PART_SCHEMA))

    @staticmethod
    def pair_counts(parts: DataFrame) -> DataFrame:
        """``(a, b, count, best)``: documents that hold a pair, and whether no pair of its ``a`` is held by more."""
        pairs = parts.select(F.inline(F.arrays_zip("a", "b", "docs")))
        counts = cut(pairs.groupBy("a", "b").agg(F.sum("docs").alias("count")))
        most = counts.groupBy("a").agg(F.max("count").alias("most"))
        return counts.join(most, "a").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))

    def summarise(self, docs: DataFrame, id_: str = "doc_id", text: str = "text", limit: int = PART) -> DataFrame:
        """One row per document, as ``RESULT``."""
        parts = self.parts(docs, id_, text, limit)
        held = parts.select("part", F.posexplode(F.arrays_zip("a", "b")).alias("place", "pair")).select("part", "place", "pair.a", "pair.b")
        totals = held.join(self.pair_counts(parts), ["a", "b"]).select(F.col("part").alias("of"), "place", "count", F.col("best").cast("long").alias("best"))
        return parts.groupBy("part").cogroup(totals.groupBy("of")).applyInArrow(_per_document, RESULT)
