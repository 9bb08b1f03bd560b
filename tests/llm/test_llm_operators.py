"""Operators of the training-data subpackage against brute force, and their edge cases."""

import base64
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from framesift.llm import ann, bpe, common, language, minhash, mixing, pitman, pq, quality, toxicity, urlfilter

DOCS = "doc_id long, text string, source string, lang string, score double, ids string, N_TOKENS int"


def _docs(spark, texts, sources=None):
    rows = [(i, t, (sources or [None])[i % len(sources or [None])], "en", 1.0, "x", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def prose():
    rng = random.Random(4)
    syllables = ["the", "an", "er", "tion", "ou", "st", "bl", "é", "sch", "ü"]
    return [" ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(rng.randint(8, 60))) for _ in range(60)]


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)


def test_bpe_equals_tiktoken(codec):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    signs = "abcdeghilmnorstu    \n\t\r\x1c\x85'd's0123!?.-éüñ漢😀<|endoftext|>"
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 80))) for _ in range(2000)]
    texts += ["", " ", "  ", "a  b", "a \n b", "x" * 3000, " " * 500 + "y", "ab" * 2000, "-" * 999]
    for text in texts:
        ids = other.encode_ordinary(text)
        assert codec.ids(text) == ids, text
        assert codec.decode(ids) == text.encode()


def test_bpe_columns_and_edges(spark):
    tokenizer = bpe.Tokenizer(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    docs = _docs(spark, ["Hello world", None, "", "Hello world", "ä" * 70_000])
    rows = {r["doc_id"]: r for r in bpe.decode_documents(bpe.encode_documents(docs, tokenizer), tokenizer).collect()}
    assert rows[0]["ids"] == rows[3]["ids"] and bytes(rows[0]["decoded"]) == b"Hello world"
    assert rows[1]["ids"] == [] and bytes(rows[1]["decoded"]) == b"" and bytes(rows[4]["decoded"]).decode() == "ä" * 70_000
    assert bpe.encode_documents(docs.limit(0), tokenizer).count() == 0


def test_language_fusion(spark):
    english = ["the cat and the other thing are with that", "this is the way that they think of it"]
    german = ["die katze und der hund sind nicht mit uns", "das ist ein weg und auch der richtige"]
    rows = [(i, t, lang, host, tld) for i in range(40) for t, lang, host, tld in (
        (english[i % 2], "en", "a.example", "com"), (german[i % 2], "de", "b.example", "de"))]
    rows += [(900, None, "de", "b.example", "de"), (901, "", None, None, None), (902, german[0], "en", "b.example", None), (903, "\x01\x02\x03" * 2000, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, declared string, host string, suffix string")
    parts = tuple(F.col(c) for c in ("text", "declared", "host", "suffix"))
    evidence = language.gather(docs, *parts, languages=("de", "en"))
    found = {(r["doc_id"], r["declared"]): r for r in language.identify(docs, evidence, *parts).collect()}
    assert all(found[i, lang]["language"] == lang and found[i, lang]["kept"] for i in range(40) for lang in ("en", "de"))
    assert found[900, "de"]["language"] == "de"  # declaration, suffix and host alone
    assert found[902, "en"]["language"] == "de"  # text against the declaration
    assert found[903, None]["language"] == "und" and not found[903, None]["kept"]
    empty = docs.limit(0)
    assert language.identify(empty, language.gather(empty, *parts), *parts).count() == 0


def _vectors(spark, matrix, more=()):
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(matrix)] + list(more)
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")


ODD = [(900, None, 1), (901, [0.0] * 8, 1), (902, [1.0] * 7 + [None], 1), (903, [float("nan")] * 8, 1), (904, [float("inf")] * 8, 1), (905, [1.0] * 5, 1), (None, [1.0] * 8, 1)]


def test_nearest_neighbours(spark):
    points = np.random.default_rng(1).standard_normal((300, 8))
    points[10] = points[20] = points[40]
    found = {}
    for r in ann.search(_vectors(spark, points, ODD), F.col("id") % 20 == 0).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert set(found) == set(range(0, 300, 20))
    hits = 0
    for q, rows in found.items():
        score = points @ points[q]
        best = sorted((-s, i) for i, s in enumerate(score) if i != q)[:20]
        assert sorted(rows) == list(range(1, 21))
        assert [v for _, v in sorted((r, (-s, i)) for r, (i, s) in rows.items())] == sorted((-s, i) for i, s in rows.values())
        hits += len({i for _, i in best} & {i for i, _ in rows.values()})
    assert hits >= 0.95 * 20 * len(found)
    few = ann.search(_vectors(spark, points[:3]), F.col("id") == 0).collect()
    assert len(few) == 2
    assert ann.search(_vectors(spark, points[:0]), F.col("id") == 0).count() == 0


def test_embedding_links(spark):
    rng = np.random.default_rng(2)
    points = rng.standard_normal((120, 8))
    points = np.vstack([points, points[:60] * 3 + 0.05 * rng.standard_normal((60, 8)), np.repeat(points[:1], 40, 0)])
    rows = {r["vec_id"]: r for r in pq.links(_vectors(spark, points, ODD)).collect()}
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    label = np.arange(len(points))
    for _ in range(len(points)):
        label = np.array([min([label[i], *label[linked[i]]]) for i in range(len(points))])
    for i in range(len(points)):
        assert (rows[i]["n_links"], rows[i]["component_id"], rows[i]["kept"]) == (linked[i].sum(), label[i], label[i] == i)
    assert all(rows[i]["n_links"] == 0 and rows[i]["kept"] for i in range(900, 906))
    assert pq.links(_vectors(spark, points[:0])).count() == 0


def test_url_filter(spark):
    urls = [None, "no scheme", "http://A.Org/x", "https://example.org/es/1", "https://w.example.org/en/12", "ftp://x.example.com/fr/", "http://x.com/de/q?a#b", "http://www.casino-win.example.net/", "http://museum.example.net/en/7", "http://org", "http://borg/x", "http://a.com?/fr/", "http://é.org/" + "p" * 5000]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    rows = {r["page_id"]: r for r in urlfilter.judge(pages, urlfilter.seed_table(spark)).collect()}
    assert [rows[i]["rule"] for i in range(12)] == [None, None, "org/", "example.org/es/", "example.org/en/1", "com/fr/", "com/de/", None, None, None, None, None]
    assert [rows[i]["verdict"] for i in (2, 3, 4, 5, 6, 7, 8)] == ["allow", "block", "block", "allow", "block", "block", "allow"]
    assert (rows[2]["host"], rows[6]["path"], rows[11]["host"], rows[11]["path"], rows[1]["host"]) == ("a.org", "/de/q", "a.com", "", "")


def test_mixing(spark, prose):
    docs = _docs(spark, [*prose, None, "", prose[0], " ".join(["w"] * 5000)], ["b", "a", None, "é", "z"])
    docs = docs.unionByName(docs.where("doc_id = 3"))
    taken, slots, plan = mixing.mix(docs, block=16, shard_slots=50)
    rows = taken.collect()
    assert len(rows) == docs.count()
    sizes, got, target = {}, {}, {}
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        got[r["source"]] = got.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    capped: set = set()
    while True:
        left = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in capped)
        rest = sum(w for s, w in weight.items() if s not in capped)
        want = {s: 2 * sizes[s] if s in capped else left * weight[s] / rest for s in names}
        over = {s for s in names if s not in capped and want[s] > 2 * sizes[s]}
        if not over:
            break
        capped |= over
    for s in names:
        assert target[s] == pytest.approx(want[s]) and abs(got[s] - want[s]) <= 1
    assert sorted(map(str, taken.collect())) == sorted(map(str, mixing.mix(docs, block=16, shard_slots=50)[0].collect()))
    kept = mixing.mixed_documents(docs, block=16, shard_slots=50)
    assert kept.columns == docs.columns
    words = {}
    for r in kept.collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(r["text"].split())
    expected = {}
    for r in rows:
        expected[r["doc"]] = expected.get(r["doc"], 0) + r["taken"]
    assert words == {i: n for i, n in expected.items() if n}
    assert mixing.mix(docs.limit(0))[0].count() == 0


def test_quality(spark, prose):
    texts = prose * 4 + [t.upper().replace(" ", "!! ") + "!!" for t in prose * 2] + [None, "", "q" * 100_000]
    docs = _docs(spark, texts)
    labels = spark.createDataFrame([(i, int(i < 4 * len(prose))) for i in range(6 * len(prose))] + [(None, 1), (3, None)], "doc_id long, quality int")
    remainder = F.crc32(F.col("id").cast("string").cast("binary")) % 4
    rows = quality.classify(docs, labels, remainder != 2, remainder == 3).collect()
    assert len(rows) == len(texts) and all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if not r["learn"] and r["doc_id"] < 6 * len(prose)]
    assert np.mean([(r["score"] >= 0.7) == (r["doc_id"] < 4 * len(prose)) for r in held]) > 0.95
    none = quality.classify(docs, labels.limit(0), remainder != 2, remainder == 3).collect()
    assert {r["score"] for r in none} == {0.5}


def test_isotonic():
    assert quality.isotonic(np.array([1, 1, 1, 0, 2.0]), np.array([0, 1, 0, 0, 2.0])).tolist() == pytest.approx([0, 0.5, 0.5, 0.75, 1])


def _jaccard(a, b):
    def cut(t):
        w = (t or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    x, y = cut(a), cut(b)
    return len(x & y) / len(x | y) if x | y else 0.0


def test_near_duplicates(spark, prose):
    rng = random.Random(8)
    texts = list(prose)
    base = " ".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=90))
    texts += [base.upper(), base + "  x", base, *[f"{base} {' '.join(rng.choices('xyz', k=rng.randint(1, 20)))}" for _ in range(30)]]
    texts += [None, None, "", "  ", "one two", "ONE two", "one", "one", " ".join(rng.choices("abcdefgh", k=30_000))]
    members, links = minhash.near_duplicates(_docs(spark, texts))
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if _jaccard(texts[i], texts[j]) >= 0.8:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    assert {r["id"]: r["component"] for r in members.collect()} == dict(enumerate(label))
    for r in links.collect():
        assert _jaccard(texts[r["a"]], texts[r["b"]]) >= 0.8
    kept = minhash.kept_documents(_docs(spark, texts))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(label))
    assert minhash.near_duplicates(_docs(spark, texts).limit(0))[0].count() == 0


def test_probability_jaccard_is_estimated():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 2**63, 400).astype(np.uint64)
    w1, w2 = rng.uniform(1, 4, 300), rng.uniform(1, 4, 300)
    a, b = dict(zip(values[:300].tolist(), w1, strict=True)), dict(zip(values[100:].tolist(), w2, strict=True))
    exact = sum(1 / sum(max(a.get(k, 0) / a[i], b.get(k, 0) / b[i]) for k in a | b) for i in a.keys() & b.keys())
    row = np.repeat([0, 1], 300)
    found = minhash.signatures(np.concatenate([values[:300], values[100:]]), row, np.concatenate([w1, w2]), 2)
    assert abs((found[0] == found[1]).mean() - exact) < 0.16


def test_pitman_yor(spark, prose):
    texts = [*prose, None, "", prose[0], prose[1], "A b " * 3000]
    rows = {r["doc_id"]: r for r in pitman.score(_docs(spark, texts), F.crc32(F.col("id").cast("string").cast("binary")) % 10 == 0).collect()}
    tokens = {i: (t or "").encode().lower().split() + [b""] for i, t in enumerate(texts)}
    held = {i for i in tokens if zlib.crc32(str(i).encode()) % 10 == 0}
    counts: dict = {}
    for i, words in tokens.items():
        for w in words if i not in held else ():
            counts[w] = counts.get(w, 0) + 1
    total, kinds = sum(counts.values()), len(counts)
    for i, words in tokens.items():
        r = rows[i]
        base = sum(np.log10((counts.get(w, 0) + 0.1) / (total + 0.1 * (kinds + 1))) for w in words)
        assert r["base_score"] == pytest.approx(base) and r["score"] < 0
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (i in held, len(words), sum(w in counts for w in words), total)
    trained = [i for i in tokens if i not in held]
    assert sum(rows[i]["score"] for i in trained) > sum(rows[i]["base_score"] for i in trained)
    assert pitman.score(_docs(spark, texts).limit(0), F.lit(False)).count() == 0


def test_seating_follows_the_process():
    rng = np.random.default_rng(5)
    n, pull, discount = 400, 0.7, 0.4

    def slow():
        tables = 1
        for i in range(1, n):
            tables += rng.random() < pull / (pull + i - discount * tables)
        return tables

    fast = pitman.seat(np.full(4000, n), np.full(4000, pull), discount, rng)
    assert fast.mean() == pytest.approx(np.mean([slow() for _ in range(2000)]), rel=0.05)


def test_toxicity(spark, prose):
    insults = ["idiot", "moron", "worthless"]
    texts = [f"{t} {insults[i % 3]} {t[:9]}" if i % 4 == 0 else t for i, t in enumerate(prose * 4)]
    hidden = ["you 1d10t there", "such a m0r0n indeed", "w.o.r.t.h.l.e.s.s thing", "an i d i o t here", "iiidiiiot now"]
    texts += [*hidden, None, "", "a b c d", "x" * 50_000]
    docs = _docs(spark, texts)
    n = 4 * len(prose)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(n)] + [(1, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    lexicon = toxicity.fit(docs, labels, F.crc32(F.col("id").cast("string").cast("binary")) % 5 != 0)
    rows = {r["doc_id"]: r["s"] for r in docs.select("doc_id", toxicity.score(F.col("text"), lexicon, spark).alias("s")).collect()}
    assert all((rows[i] >= 0.5) == (i % 4 == 0) for i in range(n))
    assert all(rows[n + i] >= 0.5 for i in range(len(hidden)))
    assert all(rows[n + len(hidden) + i] < 0.5 for i in range(4))
    assert toxicity.kept_documents(docs, lexicon).columns == docs.columns
    none = toxicity.fit(docs, labels.limit(0), F.lit(True))
    assert docs.select(toxicity.score(F.col("text"), none, spark).alias("s")).agg(F.max("s")).first()[0] == 0.0


def test_toxicity_counts_documents_that_share_a_word(spark):
    """One common word does not make copies; the same words in the same order do."""
    common = min((f"common{i}" for i in range(5000)), key=lambda w: zlib.crc32(w.encode()))
    texts = [f"{common} idiot toxic{chr(97 + i)} here" for i in range(12)] + [f"{common} plain clean{chr(97 + i)} here" for i in range(12)]
    texts += [texts[0].upper().replace(" ", ", ")] * 30 + ["rare word alone"] * 30
    docs = _docs(spark, texts)
    labels = spark.createDataFrame([(i, int(i < 12 or i >= 24)) for i in range(len(texts))], "doc_id long, toxic int")
    lexicon = toxicity.fit(docs, labels, F.lit(True))
    assert lexicon.shares["=idiot" if "=idiot" in lexicon.shares else "idio"] > 0.8
    assert "=rare" not in lexicon.shares and "rare" not in lexicon.shares
    assert toxicity.print_of(["a", "b"]) != toxicity.print_of(["b", "a"])


def test_toxicity_learns_from_every_labelled_row(spark):
    """More toxic rows than any fixed number of them: shares and the base are those of all."""
    rows = spark.range(21_000).select(F.col("id").alias("doc_id"), (F.col("id") < 9_000).cast("int").alias("toxic"))
    word = F.when(F.col("doc_id") % 3 == 0, "idiot").when(F.col("doc_id") % 3 == 1, "moron").otherwise("fool")
    text = F.concat_ws(" ", F.when(F.col("toxic") == 1, word), F.lit("row"), F.translate(F.col("doc_id").cast("string"), "0123456789", "abcdefghij"))
    docs = rows.select("doc_id", text.alias("text")).repartition(4)
    lexicon = toxicity.fit(docs, rows, F.lit(True))
    for name in ("idiot", "moron", "fool"):
        assert lexicon.shares[f"={name}" if len(name) < 5 else name[:4]] == pytest.approx(3_000 / 3_002.1)
    assert lexicon.base == pytest.approx(0.5 / (9_000 + 12_000 + 1))


def test_toxicity_reads_long_and_joined_tokens(spark, prose):
    insults = ["idiot", "moron", "worthless"]
    texts = [f"{t} {insults[i % 3]} {t[:9]}" if i % 4 == 0 else t for i, t in enumerate(prose * 4)]
    n = len(texts)
    joined = "-".join(prose[1].split())
    hidden = [
        "stop,1d10t", "you...1d10t", "word/m0r0n", "stop!1d10t now", f"i{'d' * 80}iot", f"{joined}-1d10t-{joined}", f"{joined}/{joined}.m0r0n",
        f"{joined}²{joined}²1d10t", "a/" * 30_000 + "m0r0n",
    ]
    plain = ["stop,then", joined, f"{joined}/{joined}", "x-" * 30_000, "²" * 100, "1/" * 100 + "a"]
    docs = _docs(spark, [*texts, *hidden, *plain])
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(n)], "doc_id long, toxic int")
    lexicon = toxicity.fit(docs, labels, F.lit(True))
    rows = {r["doc_id"]: r["s"] for r in docs.select("doc_id", toxicity.score(F.col("text"), lexicon, spark).alias("s")).collect()}
    assert [t[:30] for i, t in enumerate(hidden) if rows[n + i] < 0.5] == []
    assert [t[:30] for i, t in enumerate(plain) if rows[n + len(hidden) + i] >= 0.5] == []


def test_signatures_follow_distinct_shingles(spark):
    """A copy that repeats a passage stays as similar as its distinct shingles, and likely pairs of 0.8 are not lost."""
    rng = random.Random(6)
    pairs = []
    for _ in range(12):
        words = [f"w{rng.randrange(10**9)}" for _ in range(204)]
        pairs += [" ".join(words), " ".join(words + words[:104] * 50)]
    docs = _docs(spark, pairs)
    rows = docs.select(F.col("doc_id").alias("id"), minhash.words(F.col("text")).alias("words"))
    marks = {r["id"]: r for r in rows.mapInArrow(minhash.sketch, "id long, signature binary, weighted binary").collect()}
    for i in range(0, len(pairs), 2):
        a, b = (np.frombuffer(marks[i + k]["signature"], np.uint32) for k in (0, 1))
        assert abs((a == b).mean() - _jaccard(pairs[i], pairs[i + 1])) < 0.08
        assert marks[i]["weighted"] is None and marks[i + 1]["weighted"] != marks[i + 1]["signature"]
    members, _ = minhash.near_duplicates(docs)
    assert {r["id"]: r["component"] for r in members.collect()} == {i: i - i % 2 for i in range(len(pairs))}
    n = minhash.REGISTERS
    lost = sum(math.comb(n, k) * 0.8**k * 0.2 ** (n - k) for k in range(n + 1) if k / n < minhash.LIKELY)
    assert lost < 1e-7


def test_tiles_send_links_only(spark):
    """Members of a band that are likely by signature but no links stay in their tile."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(60):  # pairs of these have about seven tenths of their shingles in common
        words = list(base)
        for at in rng.sample(range(400), 7):
            words[at] = f"x{rng.randrange(10**9)}"
        texts.append(" ".join(words))
    texts += [texts[0] + " more", texts[7] + " words", texts[7] + " words here"]
    docs = _docs(spark, texts)
    rows = docs.select(F.col("doc_id").alias("id"), minhash.words(F.col("text")).alias("words")).mapInArrow(
        lambda batches: (pa.RecordBatch.from_arrays([*b.columns, *next(minhash.sketch(iter([b]))).columns[1:2]], ["id", "words", "signature"]) for b in batches),
        "id long, words array<long>, signature binary",
    )
    links = {(i, j) for j in range(len(texts)) for i in range(j) if _jaccard(texts[i], texts[j]) >= 0.8}
    likely = 0
    marks = {r["id"]: np.frombuffer(r["signature"], np.uint32) for r in rows.collect()}
    for i in marks:
        likely += sum((marks[i] == marks[j]).mean() >= minhash.LIKELY for j in range(i))
    one_tile = rows.withColumns({"component": F.col("id"), "side": F.lit(1)})
    found = minhash._tiles(0.8)(one_tile.toArrow())
    assert set(zip(*(found.column(k).to_pylist() for k in "ab"), strict=True)) == links and likely > 10 * len(links) > 0
    members, _ = minhash.near_duplicates(docs)
    assert {r["id"]: r["component"] for r in members.collect()} == {**{i: i for i in range(60)}, 60: 0, 61: 7, 62: 7}


def test_toxicity_leaves_unlabelled_texts_in_place(spark):
    """The bitmap loses no labelled row and keeps most others out of the join, at any number of labels."""
    for n in (0, 1, 5, 9000):
        rows = spark.range(20_000).unionByName(spark.createDataFrame([(None,), (-3,), (-3,)], "id long"))
        known = spark.range(n).union(spark.createDataFrame([(-3,)], "id long"))
        left = [r["id"] for r in common.perhaps_in(rows, known, n + 1).collect()]
        assert left.count(-3) == 2 and set(range(n)) <= set(left)
        assert len(left) < n + 0.2 * 20_000 + 3


def test_toxicity_keeps_few_tokens(monkeypatch):
    """What a worker keeps is bounded, recent tokens stay, and scores do not depend on it."""

    class Sent:
        id, value = -7, toxicity.Lexicon(toxicity.Characters({}), {"=idiot": 0.9}, 0.1)

    texts = pa.array([f"idiot w{'abcdefghij'[i % 10]}{'x' * (i // 10)}" for i in range(300)])
    whole = toxicity._scores(Sent, texts)
    monkeypatch.setattr(toxicity, "KEPT_SIGNS", 400)
    monkeypatch.setattr(toxicity, "_kept", toxicity._Kept(-1))
    assert toxicity._scores(Sent, texts).equals(whole)
    assert "idiot" in {**toxicity._kept.scores, **toxicity._kept.before}
    assert sum(map(len, [*toxicity._kept.scores, *toxicity._kept.before])) < 1_000
