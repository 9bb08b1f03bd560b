"""Contexts of the language model are the words before, however many there are."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from framesift.llm import pitman


def _scores(spark, texts, first_held):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return {r["doc_id"]: r["score"] for r in pitman.score(docs, F.col("id") >= first_held).collect()}


def test_words_with_the_same_end_are_contexts_of_their_own(spark):
    pairs = [(f"word{i}ing", f"next{i}") for i in range(100)]
    learnt = [f"{u} {w}" for u, w in pairs for _ in range(3)]
    right, wrong = [f"{u} {w}" for u, w in pairs], [f"{u} {w}" for (u, _), (_, w) in zip(pairs, pairs[1:] + pairs[:1])]
    found = _scores(spark, learnt + right + wrong, len(learnt))
    n = len(learnt)
    assert all(found[n + i] > found[n + len(pairs) + i] + 1 for i in range(len(pairs)))


def test_one_text_of_different_words_has_no_chance_in_its_seating(spark):
    found = _scores(spark, ["a b c d", "d a", "d e", "e a"], 1)
    d = 0.95  # all types occur once
    root, unknown = ((k * (1 - d) + (1 + d * 5) / 6) / 6 for k in (1, 0))
    met, unmet = (1 - d + (1 + d) * root) / 2, (1 + d) * root / 2
    assert found[0] == pytest.approx(5 * np.log10(met))
    assert found[1] == pytest.approx(3 * np.log10(unmet))
    assert found[2] == pytest.approx(np.log10(unmet * (1 + d) * unknown / 2 * root))
    assert found[3] == pytest.approx(np.log10((1 + d) * unknown / 2 * root * unmet))


def test_results_do_not_depend_on_chunks(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.4, 40)) for _ in range(60)]
    whole = _scores(spark, texts, 50)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    again = {r["doc_id"]: r["score"] for r in pitman.score(docs, F.col("id") >= 50).collect()}
    assert again == pytest.approx(whole)


def test_types_of_a_chunk():
    row = {"n": np.array([3, -2], np.int32), "words": np.sort(pitman._hashes([pitman.END, b"a", b"b"]))}
    place = {w: int(np.searchsorted(row["words"], pitman._hashes([w])[0])) for w in (pitman.END, b"a", b"b")}
    row["seq"] = np.array([place[w] for w in (b"a", b"b", pitman.END, b"a", pitman.END)], np.int32)
    kinds = pitman._Types(row, 4)
    got = {(u, w): c for u, w, c in zip(kinds.u.tolist(), kinds.w.tolist(), kinds.c.tolist())}
    end, a, b = place[pitman.END], place[b"a"], place[b"b"]
    assert got == {(end, a): 1, (a, b): 1, (b, end): 1, (a, end): 0}
    assert [(int(kinds.u[t]), int(kinds.w[t])) for t in kinds.token()] == [(end, a), (a, b), (b, end), (end, a), (a, end)]
