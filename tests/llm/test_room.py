"""What operators move and keep: texts that no pair needs stay in place, and workers keep things of one operator."""

import tracemalloc
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa

from framesift.llm import ann, bpe, minhash, toxicity


def test_scan_follows_pairs_only_when_few_are_left():
    rng = np.random.default_rng(4)
    queries, rows = rng.standard_normal((400, 65)), rng.standard_normal((1000, 65))
    distance = ((queries[:, None, :] - rows[None, :, :]) ** 2).sum(2)
    threshold = np.sort(distance, axis=1)[:, 30]
    found = set(zip(*(x.tolist() for x in ann.scan(queries, threshold, rows)), strict=True))
    wanted = set(zip(*(x.tolist() for x in np.nonzero(distance <= threshold[:, None])), strict=True))
    assert found <= wanted and len(found) >= 0.95 * len(wanted)
    tracemalloc.start()
    q, r = ann.scan(queries, np.full(400, np.inf), rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(set(zip(q.tolist(), r.tolist(), strict=True))) == 400_000
    assert peak < 40_000_000  # a difference of every pair would take 51 MB a block, and as much again for its squares


def test_only_texts_of_pairs_are_joined(spark, monkeypatch):
    rng = np.random.default_rng(6)
    texts = [" ".join(f"w{n}" for n in rng.integers(0, 5000, 60)) for _ in range(400)]
    texts += [texts[0] + " more", texts[1] + " more", texts[1], None, ""]
    sent, check = [], minhash.verified
    monkeypatch.setattr(minhash, "verified", lambda pairs, words, limit: (sent.append(words.count()), check(pairs, words, limit))[1])
    docs = spark.createDataFrame([*enumerate(texts), (7, "an id that occurs twice")], "doc_id long, text string")
    members, links = minhash.near_duplicates(docs)
    assert {(r.a, r.b) for r in links.collect()} == {(0, 400), (1, 401)}
    assert {r.id: r.component for r in members.collect() if r.id != r.component} == {400: 0, 401: 1, 402: 1}
    assert sent[0] < 150  # four texts, and some by chance; all 404 before


def test_workers_keep_one_operator():
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    sent = SimpleNamespace(id=-7, value=(ranks, public_tokenizers.PATTERN))
    bpe._drop()
    assert bpe._table(sent)[ranks[b"the"]].as_py() == b"the" and not bpe._codecs  # decoding builds no codec
    assert bpe._codec(sent).decode(bpe._codec(sent).ids("the end")) == b"the end"
    words = SimpleNamespace(id=-8, value=toxicity.Lexicon(toxicity.Characters({}), {"=bad": 0.9}, 0.1))
    assert toxicity._scores(words, pa.array(["a bad one"]))[0].as_py() > 0.9
    assert not bpe._codecs and not bpe._tables and toxicity._kept.number == -8
    bpe._codec(sent)
    assert toxicity._kept.number == -1
    bpe._drop()
