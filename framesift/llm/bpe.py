"""Byte-level BPE encoding and decoding by backtracking over longest matches.

A vocabulary of byte strings with ranks defines the merges.  The bytes of a piece are read as
Latin-1 text, so that one Aho-Corasick pass finds the longest token at every position.  Encoding
then walks from left to right: the longest token is taken unless it could not stand beside its
left neighbour after exact merging; then the next shorter prefix is tried, and where none is left the
last token is taken back.  Whether two tokens can be neighbours is decided once per pair and kept.
Every position fails at most once, so the work is linear in the piece.

Defined results: null or empty text has no ids and decodes to no bytes; a text of any length is
encoded whole; rows may repeat; other columns, whatever their names, pass through untouched.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable
from hashlib import sha256

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import make_room

VOCABULARY_LIMIT = 64_000_000  # bytes of a rank file that may be sent to every task
KEPT_STRETCHES = 120_000  # encodings a worker keeps in each of two generations
KEPT_PAIRS = 400_000
_WIDE_GAP = regex.compile(r"[\s\x1c-\x1f] ")


def tokens_of(ranks: dict[bytes, int]) -> list[bytes]:
    """The bytes of every rank; ranks that are not used have none."""
    token = [b""] * (max(ranks.values()) + 1)
    for raw, rank in ranks.items():
        token[rank] = raw
    return token


class Codec:
    """Exact encoder and decoder of one rank table."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.pattern = regex.compile(pattern)
        self.token = tokens_of(ranks)
        self.rank = {raw.decode("latin-1"): rank for raw, rank in ranks.items()}
        self.length = {rank: len(raw) for raw, rank in ranks.items()}
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the vocabulary must hold every single byte")
        if max(ranks[bytes([b])] for b in range(256)) > 255:
            raise ValueError("single bytes must have the lowest ranks")
        self.finder = ahocorasick.Automaton()
        for text, rank in self.rank.items():
            self.finder.add_word(text, rank)
        self.finder.make_automaton()
        self.shorter: dict[int, int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        for text, rank in self.rank.items():
            for cut in range(len(text) - 1, 0, -1):
                if (found := self.rank.get(text[:cut])) is not None:
                    self.shorter[rank] = found
                    break
            if len(text) > 1:
                parts = self._merge(text, rank)
                if len(parts) == 2:
                    self.halves[rank] = (parts[0], parts[1])
                    self.joined[parts[0], parts[1]] = rank
        self.beside: dict[int, bool] = {}
        self.kept: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _merge(self, text: str, below: int) -> list[int]:
        """Plain merging with the ranks under ``below``; only for building the tables."""
        parts = list(text)
        while len(parts) > 1:
            best, at = below, -1
            for i in range(len(parts) - 1):
                if (found := self.rank.get(parts[i] + parts[i + 1], below)) < best:
                    best, at = found, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.rank[p] for p in parts]

    def compatible(self, left: int, right: int) -> bool:
        """True if exact merging of both byte strings together leaves the two tokens apart.

        The later formed token is opened first; a merge over the border that would have come
        before that moment is a contradiction.
        """
        key = left << 32 | right  # one number takes a third of the room of a pair
        known = self.beside.get(key)
        if known is not None:
            return known
        limit, answer = 1 << 62, True
        while True:
            crossing = self.joined.get((left, right))
            if crossing is not None and crossing < limit:
                answer = False
                break
            later = left if left > right else right
            opened = self.halves.get(later)
            if opened is None:
                break
            if left > right:
                limit, left = left, opened[1]
            else:
                limit, right = right + 1, opened[0]
        if len(self.beside) >= KEPT_PAIRS:
            self.beside.clear()
        self.beside[key] = answer
        return answer

    def encode_piece(self, piece: str) -> list[int]:
        """Ids of one match of the pattern."""
        text = piece if piece.isascii() else piece.encode("utf-8").decode("latin-1")
        whole = self.rank.get(text)
        if whole is not None:
            return [whole]
        size, length, beside, shorter = len(text), self.length, self.beside, self.shorter
        longest = [0] * size
        for end, token in self.finder.iter(text):
            longest[end + 1 - length[token]] = token  # ends only grow, so the longest stays
        dead: set[int] = set()
        taken: list[int] = []
        at, last, token = 0, -1, longest[0]
        while at < size:
            end = at + length[token]
            if end not in dead:
                fits = last < 0 or beside.get(last << 32 | token)
                if fits is None:
                    fits = self.compatible(last, token)
                if fits:
                    taken.append(token)
                    at, last = end, token
                    if at < size:
                        token = longest[at]
                    continue
            fallback = shorter.get(token)
            while fallback is None:  # nothing fits here: the token before was wrong
                dead.add(at)
                wrong = taken.pop()
                at -= length[wrong]
                last = taken[-1] if taken else -1
                fallback = shorter.get(wrong)
            token = fallback
        return taken

    def _run(self, chunk: str) -> bytes:
        words, out = self.words, []
        for piece in self.pattern.findall(chunk):
            found = words.get(piece)
            if found is None:
                if len(words) >= KEPT_STRETCHES:
                    words.clear()
                found = words[piece] = array("i", self.encode_piece(piece)).tobytes()
            out.append(found)
        return b"".join(out) if len(out) != 1 else out[0]

    def packed(self, text: str) -> bytes:
        """Ids as packed 32-bit integers.

        A single space between two other characters always starts a piece, so such stretches are
        encoded apart and kept; a text where white space precedes a space is split by the pattern alone.
        """
        if not text:
            return b""
        if _WIDE_GAP.search(text):
            return b"".join(array("i", self.encode_piece(m[0])).tobytes() for m in self.pattern.finditer(text))
        head, *rest = text.split(" ")
        if len(self.kept) >= KEPT_STRETCHES:  # what was not used for a whole generation is dropped
            self.kept, self.before = {}, self.kept
        kept, before = self.kept, self.before
        for chunk in set(rest).difference(kept):
            found = before.get(chunk)
            kept[chunk] = self._run(" " + chunk) if found is None else found
        return self._run(head) + b"".join(map(kept.__getitem__, rest))

    def ids(self, text: str) -> list[int]:
        return array("i", self.packed(text)).tolist()

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank file: base64 token and rank on each line."""
    with open(path, "rb") as lines:
        raw = lines.read(VOCABULARY_LIMIT + 1)
    if len(raw) > VOCABULARY_LIMIT:
        raise ValueError("the vocabulary is too large to be sent to every task")
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line.strip())}


_codecs: dict[int, Codec] = {}
_tables: dict[int, pa.Array] = {}


def _drop() -> None:
    _codecs.clear()
    _tables.clear()


def _codec(sent) -> Codec:
    """One codec per worker and broadcast."""
    if sent.id not in _codecs:
        make_room(_drop)
        _codecs.clear()
        _codecs[sent.id] = Codec(*sent.value)
    return _codecs[sent.id]


def _table(sent) -> pa.Array:
    """The bytes of all tokens, which is all that decoding needs of a codec."""
    if sent.id not in _tables:
        make_room(_drop)
        _tables.clear()
        _tables[sent.id] = pa.array(tokens_of(sent.value[0]), pa.large_binary())
    return _tables[sent.id]


_AT_ONCE = 1_000_000  # ids whose bytes are put together at a time


def _joined(words: pa.Array, lists: pa.Array) -> Iterable[memoryview]:
    """The words of each row's ids, one after the other; null ids are skipped, a null row has none."""
    flat = lists.flatten()
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    if flat.null_count:
        there = flat.is_valid().to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(sizes)), sizes)[there]
        flat, sizes = flat.drop_null(), np.bincount(row, minlength=len(sizes))
    ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    row = 0
    while row < len(sizes):
        stop = max(row + 1, int(np.searchsorted(ends, ends[row] + _AT_ONCE, side="right")) - 1)
        taken = words.take(flat.slice(ends[row], ends[stop] - ends[row]))
        _, offsets, data = taken.buffers()
        places = np.frombuffer(offsets, np.int64)[ends[row : stop + 1] - ends[row]].tolist() if len(taken) else [0] * (stop - row + 1)
        view = memoryview(data) if data is not None else memoryview(b"")
        for start, end in zip(places, places[1:]):
            yield view[start:end]
        row = stop


class Tokenizer:
    """Column functions of one vocabulary; ranks are read by the driver and broadcast (bounded above)."""

    def __init__(self, spark: SparkSession, path: str, pattern: str) -> None:
        self._sent = _Sent(spark.sparkContext.broadcast((read_ranks(path), pattern)))

    def encode(self, text: Column) -> Column:
        """``array<int>`` of token ids; null text gives no ids."""
        sent = self._sent

        def run(texts: pa.Array) -> pa.Array:
            codec = _codec(sent)
            parts = [codec.packed(t) for t in texts.to_pylist()]
            ends = np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts], dtype=np.int64)]).astype(np.int32)
            flat = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(parts))])
            return pa.ListArray.from_arrays(pa.array(ends), flat)

        return F.arrow_udf(run, "array<int>").asNondeterministic()(text)  # else every use of the ids encodes anew

    def decode(self, ids: Column) -> Column:
        """Bytes of an ``array<int>``; null ids are skipped, a null array gives no bytes."""
        sent = self._sent

        def run(lists: pa.Array) -> pa.Array:
            return pa.array([bytes(row) for row in _joined(_table(sent), lists)], pa.binary())

        return F.arrow_udf(run, "binary")(ids)


class _Sent:
    """A broadcast with a stable id, so that workers can keep what they build from it."""

    def __init__(self, broadcast) -> None:
        self._broadcast = broadcast
        self.id = broadcast._jbroadcast.id() if broadcast._jbroadcast is not None else id(broadcast)

    @property
    def value(self):
        return self._broadcast.value

    def __reduce__(self):
        return _restore, (self._broadcast, self.id)


def _restore(broadcast, number):
    self = object.__new__(_Sent)
    self._broadcast, self.id = broadcast, number
    return self


def digest(ids: Column) -> Column:
    """SHA-256, in lower-case hex, of the decimal ids joined by single spaces."""

    def run(lists: pa.Array) -> pa.Array:
        return pa.array([sha256(row[:-1]).hexdigest() for row in _joined(_decimals(lists), lists)], pa.string())

    return F.arrow_udf(run, "string")(ids)


_written: list[pa.Array] = [pa.array([], pa.large_binary())]


def _decimals(lists: pa.Array) -> pa.Array:
    """Decimal text and a space of every id up to the largest one met."""
    top = pc.max(lists.flatten()).as_py()
    if top is not None and top >= len(_written[0]):
        _written[0] = pa.array([b"%d " % number for number in range(top + 1)], pa.large_binary())
    return _written[0]


def encode_documents(docs: DataFrame, tokenizer: Tokenizer, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with a column of token ids; an existing column of that name is replaced."""
    return docs.withColumn(ids, tokenizer.encode(F.col(text)))


def decode_documents(docs: DataFrame, tokenizer: Tokenizer, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    return docs.withColumn(decoded, tokenizer.decode(F.col(ids)))
