"""Toxicity by noisy-channel deobfuscation.

Disguised spellings are read as a lattice: leetspeak signs stand for letters, marks between letters and
repeated letters may be dropped, and letters set apart by spaces belong together.  Viterbi decoding
under a character model finds the likeliest word; restored words and their beginnings are then scored
by a lexicon learned from labelled documents.

The lexicon is a greedy cover: the feature with the largest number of still unexplained toxic documents
(copies with the same words in the same order count once) among those that hardly occur in clean ones, again and again.  It is fitted on
all labelled rows: documents, words and letters are counted by Spark, and the driver sees features that at least one toxic document
in 400 holds (their number does not grow with the table) and counts of three letters.  A round of the cover is one count over the documents still
unexplained.  Texts without a label stay where they are: a bitmap of the labelled ids keeps most of them out of the join, whose plan is the
same at every size, and a document travels as one line of its distinct words.

Defined results: null or empty text has no evidence and gets the base score; several labels of a document
count as toxic if any is; without labels every score is 0; repeated rows score alike; extra columns pass.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut
from .bpe import _Sent
from .common import make_room, perhaps_in

FLUSH = 300_000  # counts that a task holds before it sends them
ROWS = 512  # documents whose words are listed at once
PREFIXES = (4, 5, 6, 7, 8)
PURITY = 0.9
KEPT_SIGNS = 1_000_000  # of the tokens whose scores a worker keeps, in each of two generations

#: Signs and the letters they may stand for; fixed values.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "*": "aeiou", "#": "h",
}
SWAP, DROP, REPEAT, MISS = -1.2, -0.7, -0.4, -9.0
_SPACED = re.compile(r"(?<!\S)(?:\S[^\S\r\n]+){2,}\S(?!\S)")
_TRIPLE = re.compile(r"(.)\1\1")
_TWICE = re.compile(r"(.)\1")
_RUN = re.compile(r"(.)\1{2,}")
_WORDS = re.compile(r"[^\W\d_]+")
_PLAIN = re.compile(r"[^\W\d_]+[^\w@$!|+€£(*#]*$")
_EDGE = re.compile(r"^[^\w@$!|+€£(*#]+|[^\w@$!|+€£(*#]+$")
_DECOR = re.compile(r"([^\w\s])\1+")
_END_RUN = re.compile(r"(?:([^\w\s])\1+)+$")
_MARKS = re.compile(r"(?:[^\w@$!|+€£(*#]|_)+")
_ALL_MARKS = re.compile(r"[\W_]+")


def letters_of(words: Iterator[tuple[str, int]]) -> Counter:
    """Counts of three letters in a row, from word counts; ``^`` marks the ends of a word."""
    three: Counter = Counter()
    for word, count in words:
        text = f"^^{word}^"
        for i in range(2, len(text)):
            three[text[i - 2 : i + 1]] += count
    return three


class Characters:
    """Trigram character model with back-off, from counts of three letters."""

    def __init__(self, three: dict[str, int]) -> None:
        two, one = defaultdict(float), defaultdict(float)
        head3, head2 = defaultdict(float), defaultdict(float)
        for k, v in three.items():
            two[k[1:]] += v
            one[k[2]] += v
            head3[k[:2]] += v
            head2[k[1]] += v
        total = sum(one.values()) or 1.0
        self.one = {k: math.log(0.02 * v / total) for k, v in one.items()}
        self.two = {k: math.log(0.2 * v / head2[k[0]]) for k, v in two.items()}
        self.three = {k: math.log(0.78 * v / head3[k[:2]]) for k, v in three.items()}

    def __call__(self, before: str, char: str) -> float:
        found = self.three.get(before + char)
        if found is None:
            found = self.two.get(before[1] + char)
            if found is None:
                found = self.one.get(char, MISS)
        return found


def decode(token: str, model: Characters, breaks: bool = False) -> str:
    """Likeliest spelling of a disguised token; with ``breaks`` it may consist of several words.

    The time grows with the length of the token; texts are kept as links to the text before.  A state is the two letters
    before, so all states that can be reached are kept.
    """
    states: dict[str, tuple[float, tuple | None]] = {"^^": (0.0, None)}
    last = ""
    for char in token:
        letters = LEET.get(char, "" if not char.isalpha() else char)
        cost = 0.0 if char.isalpha() else SWAP
        found: dict[str, tuple[float, tuple | None]] = {}
        for before, (score, text) in states.items():
            options = [(before, score, text)]
            if breaks and text and before != "^^":
                options.append(("^^", score + model(before, "^"), (text, " ")))
            for state, base, so_far in options:
                for letter in letters:
                    value = base + cost + model(state, letter)
                    key = state[1] + letter
                    if key not in found or found[key][0] < value:
                        found[key] = (value, (so_far, letter))
            drop = REPEAT if char == last else DROP if not char.isalnum() else None
            if drop is not None and (before not in found or found[before][0] < score + drop):
                found[before] = (score + drop, text)
        if not found:
            return ""
        states, last = found, char
    spelt, node = [], max(((score + model(before, "^"), text) for before, (score, text) in states.items()), key=lambda x: x[0])[1]
    while node:
        node, letter = node
        spelt.append(letter)
    return "".join(reversed(spelt))


def _disguised(form: str) -> bool:
    """Whether a form has letters, and signs or repeats that decoding may change."""
    letters, signs = sum(c.isalpha() for c in form), sum(c in LEET for c in form)
    return letters > 0 and letters + signs >= 3 and (signs > 0 or _TWICE.search(form) is not None)


def _stretches(form: str) -> list[str]:
    """A form without the signs that are neither letters, nor stand for one, nor may be dropped."""
    return "".join(" " if c.isalnum() and not c.isalpha() and c not in LEET else c for c in form).split()


def readings(token: str, model: Characters) -> list[str]:
    """Restored words of one lower-case token between spaces, whatever its length.

    A token is read as one word, as several words, and part by part between its marks.
    """
    if _PLAIN.match(token) and not _TRIPLE.search(token):
        return [_WORDS.match(token)[0]]
    run = _END_RUN.search(token)
    if run and token[: run.start()].isalpha() and not _TWICE.search(token[: run.start()]):
        # a plain word with marks at its end: each mark may also stand for a last letter, once or twice
        word, ends = token[: run.start()], LEET.get(run[0][0], "")
        return [word, *[word + end for letter in ends for end in (letter, letter * 2)]]
    core = _EDGE.sub("", _DECOR.sub("", token))
    plain = _WORDS.findall(token)
    letters = sum(map(len, plain))
    if not letters or letters + sum(c in LEET for c in core) < 3:
        return plain
    out = list(plain) if len(plain) == 1 else [w for w in plain if len(w) > 2]
    squeezed = _RUN.sub(r"\1\1", token)
    whole = _RUN.sub(r"\1\1", core)
    whole_forms = {whole, core.strip("!|(*#+"), squeezed}
    for form in whole_forms:
        if form and (any(c in LEET or not c.isalnum() for c in form) or _TWICE.search(form)):
            out.append(decode(form, model))
    parts = {part for cut_at in (_MARKS, _ALL_MARKS) for part in cut_at.split(squeezed)}
    for part in sorted(parts | {whole}):
        if _disguised(part):
            if part not in whole_forms:
                out.append(decode(part, model))
            for stretch in _stretches(part):
                out += decode(stretch, model, breaks=True).split()
    return [w for w in dict.fromkeys(out) if w]


def spaced_words(low: str, model: Characters) -> Iterator[str]:
    """Words written letter by letter in a lower-case text."""
    for run in _SPACED.finditer(low):
        letters = "".join(run[0].split())
        if sum(c.isalpha() or c in LEET for c in letters) >= 3:
            yield from decode(letters, model, breaks=True).split()


def marks(word: str) -> list[str]:
    """Features of a word: itself and its beginnings."""
    return [f"={word}", *[word[:n] for n in PREFIXES if len(word) > n]]


class Lexicon:
    """Feature shares and the base score; features are those of at least one toxic document in 400."""

    def __init__(self, model: Characters, shares: dict[str, float], base: float) -> None:
        self.model, self.shares, self.base = model, shares, base

    def share(self, word: str) -> float:
        return max((self.shares.get(m, 0.0) for m in marks(word)), default=0.0)


def print_of(spelt: list[str]) -> int:
    """A number that only texts with the same words in the same order share."""
    return int.from_bytes(hashlib.blake2b(" ".join(spelt).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def _listed_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS):
            part = batch.slice(first, ROWS)
            prints, words = [], []
            for value in part.column("text"):
                spelt = [w for token in (value.as_py() or "").lower().split() for w in _WORDS.findall(token)]
                prints.append(print_of(spelt))
                words.append(" ".join(sorted(set(spelt))))
            yield pa.record_batch([pa.array(prints, pa.int64()), part.column("toxic").cast(pa.int32()), pa.array(words, pa.string())], ["print", "toxic", "words"])


def _sent_counts(found: Counter, name: str) -> pa.RecordBatch:
    return pa.record_batch([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], [name, "n"])


def _counted(docs: DataFrame, name: str, items) -> DataFrame:
    """``(name, n)``: how often ``items`` of a row's words gives each text; summed in tasks, then by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for words in batch.column("words"):
                found.update(items(words.as_py().split()))
                if len(found) >= FLUSH:
                    yield _sent_counts(found, name)
                    found = Counter()
        yield _sent_counts(found, name)

    return docs.select("words").mapInArrow(run, f"{name} string, n long").groupBy(name).agg(F.sum("n").alias("n"))


def _features(words: list[str]) -> set[str]:
    return {m for w in words for m in marks(w)}


def _letter_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield _sent_counts(letters_of(zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True)), "letters")


def _numbers(counted: DataFrame, name: str) -> dict[str, int]:
    table = counted.toArrow()
    return dict(zip(table.column(name).to_pylist(), table.column("n").to_pylist(), strict=True))


def cover(held: DataFrame, holders: dict[str, int], least: int) -> tuple[list[str], int]:
    """Features chosen greedily, and the number of documents they explain.

    ``held`` lists the features of each toxic document (``features ARRAY<STRING>``).  Each round counts the documents that are not
    explained yet by feature; a round explains at least ``least`` documents, so there are at most as many rounds as shares of that size.
    """
    open_ = cut(held.groupBy("features").agg(F.count(F.lit(1)).alias("n")))
    chosen: list[str] = []
    explained = 0
    while True:
        gains = _numbers(open_.select(F.explode("features").alias("feature"), "n").groupBy("feature").agg(F.sum("n").alias("n")), "feature")
        # largest gain first; among equals the more frequent one, then the most general feature, then the smallest text
        best = min(gains, key=lambda f: (-gains[f], -holders[f], len(f), f), default=None)
        if best is None or gains[best] < least:
            return chosen, explained
        chosen.append(best)
        explained += gains[best]
        open_ = open_.where(~F.array_contains("features", best))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, doc: str = "doc_id", text: str = "text", label: str = "toxic") -> Lexicon:
    spark = docs.sparkSession
    known = labels.where(F.col(label).isNotNull()).groupBy(F.col(doc).alias("id")).agg(F.max(F.col(label).cast("int")).alias("toxic"))
    known = cut(known.where(learn))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    bad, good = counts.get(1, 0), counts.get(0, 0)
    if not bad:
        return Lexicon(Characters({}), {}, 0.0)
    rows = perhaps_in(docs.select(F.col(doc).alias("id"), F.col(text).alias("text")), known, sum(counts.values()))
    rows = rows.join(known.hint("merge"), "id").select("text", "toxic")
    words = rows.mapInArrow(_listed_words, "print long, toxic int, words string")
    # copies count once, in each class they have labels of
    flags = [F.bool_or(F.col("toxic") == k).alias(name) for k, name in ((1, "bad"), (0, "good"))]
    once = cut(words.groupBy("print").agg(F.first("words").alias("words"), *flags))
    toxic = once.where("bad")
    total = toxic.count()
    least = max(2, total // 400)
    # a document holds a bounded number of features, so those of one document in 400 do not grow with the table
    frequent = _numbers(_counted(toxic, "feature", _features).where(F.col("n") >= least), "feature")
    sent = spark.sparkContext.broadcast(frozenset(frequent))
    clean = _numbers(_counted(once.where("good"), "feature", lambda words: _features(words) & sent.value), "feature")
    holders = {f: n for f, n in frequent.items() if n >= PURITY * (n + clean.get(f, 0))}
    pure = spark.sparkContext.broadcast(frozenset(holders))

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [sorted(_features(words.as_py().split()) & pure.value) for words in batch.column("words")]
            yield pa.record_batch([pa.array(lists, pa.list_(pa.string()))], ["features"])

    chosen, explained = cover(toxic.select("words").mapInArrow(held, "features array<string>").where("size(features) > 0"), holders, least)
    share = lambda f: holders[f] / (holders[f] + clean.get(f, 0) + 2.1)
    shares = {f: share(f) for f in chosen}
    # features as frequent as a chosen one, whole words above all, also count by themselves
    shares |= {f: share(f) for f, n in holders.items() if f not in shares and n >= max(6, total // 100) and clean.get(f, 0) * 20 <= n}
    base = (total - explained + 0.5) / (total + max(1, good) + 1.0)
    spelt = cut(_counted(once, "word", lambda words: words).where("n > 1"))
    letters = Counter(_numbers(spelt.mapInArrow(_letter_counts, "letters string, n long").groupBy("letters").agg(F.sum("n").alias("n")), "letters"))
    signs = spelt.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    boost = max(20, signs // (20 * max(1, len(shares))))
    letters.update(letters_of((f[1:], boost) for f in shares if f[0] == "="))
    return Lexicon(Characters(letters), shares, float(min(0.4, base)))


class _Kept:
    """Scores of the tokens a worker has met lately, for one lexicon; what was not used for a whole generation is dropped."""

    def __init__(self, number: int) -> None:
        self.number, self.signs, self.scores, self.before = number, 0, {}, {}


_kept = _Kept(-1)


def _drop() -> None:
    global _kept
    _kept = _Kept(-1)


def _scores(sent: _Sent, texts: pa.Array) -> pa.Array:
    """A function of the module, so that all tasks of a worker share what is kept."""
    global _kept
    if _kept.number != sent.id:
        make_room(_drop)
        _kept = _Kept(sent.id)
    lex, kept, out = sent.value, _kept, []
    model = lex.model
    for value in texts:
        low = (value.as_py() or "").lower()
        clean = 1.0 - lex.base
        for token in set(low.split()):
            found = kept.scores.get(token)
            if found is None:
                if kept.signs > KEPT_SIGNS:
                    kept.scores, kept.before, kept.signs = {}, kept.scores, 0
                kept.signs += len(token)
                found = kept.before.get(token)
                if found is None:
                    found = max((lex.share(w) for w in readings(token, model)), default=0.0)
                kept.scores[token] = found
            if found:
                clean *= 1.0 - found
        for word in spaced_words(low, model):
            clean *= 1.0 - lex.share(word)
        out.append(1.0 - clean)
    return pa.array(out, pa.float64())


def score(text: Column, lexicon: Lexicon, spark) -> Column:
    """Probability of toxic from the restored words: noisy-or over the distinct lexicon words."""
    sent = _Sent(spark.sparkContext.broadcast(lexicon))
    return F.arrow_udf(lambda texts: _scores(sent, texts), "double")(text)


def kept_documents(docs: DataFrame, lexicon: Lexicon, text: str = "text", limit: float = 0.5) -> DataFrame:
    """``docs`` without the documents whose score reaches ``limit``."""
    return docs.where(score(F.col(text), lexicon, docs.sparkSession) < limit)
