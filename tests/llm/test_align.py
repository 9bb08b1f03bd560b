"""Alignment of two tokenizations against plain loops over whole texts."""

import random
from collections import Counter
from hashlib import sha256

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from framesift.llm import align

LEFT, RIGHT = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def sides():
    with open(LEFT, "rb") as left, open(RIGHT, "rb") as right:
        return align.Sides(left.read(), right.read())


def _plain(texts):
    """Per text: ids, groups and links, by the definition and without cutting texts."""
    a_of, b_of = Tokenizer.from_file(LEFT), sentencepiece.SentencePieceProcessor(model_file=RIGHT)
    a_of.encode_special_tokens = True
    signs = align._byte_signs()
    out = []
    for text in texts:
        if not text:
            out.append(None)
            continue
        encoded = a_of.encode(" " + text, add_special_tokens=False)
        a, b = encoded.ids, b_of.encode(text)
        a_bytes = [bytes(signs[c] for c in a_of.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(b_of.id_to_piece(i)[3:5], 16)]) if b_of.is_byte(i) else b_of.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
            out.append(None)
            continue

        def ranges(tokens):
            at, found = 0, []
            for t in tokens:
                found.append((at, at + len(t)))
                at += len(t)
            return found

        ra, rb = ranges(a_bytes), ranges(b_bytes)
        ends = sorted({y for _, y in ra} & {y for _, y in rb})
        groups, i, j = [], 0, 0
        for end in ends:
            ga, gb = [], []
            while i < len(a) and ra[i][1] <= end:
                ga.append(str(a[i]))
                i += 1
            while j < len(b) and rb[j][1] <= end:
                gb.append(str(b[j]))
                j += 1
            groups.append(",".join(ga) + "|" + ",".join(gb))
        links = [(a[x], b[y]) for x, (s, e) in enumerate(ra) for y, (t, f) in enumerate(rb) if s < f and t < e]
        out.append((len(a), len(b), groups, links))
    counts = Counter(pair for r in out if r for pair in set(r[3]))
    most = Counter()
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    rows = []
    for r in out:
        if r is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
        else:
            best = sum(counts[p] == most[p[0]] for p in r[3])
            rows.append((r[0], r[1], len(r[2]), len(r[3]), best, sum(counts[p] for p in r[3]), sha256(";".join(r[2]).encode()).hexdigest()))
    return rows


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    signs = list("aeinrstou    .,'\"é漢😀\n\t 　\u0085\x1c\x00ß0123") + ["the ", " and", "<|endoftext|>", "<s>", "▁", "  ", "'s", "<0x41>", "é"]
    made = ["".join(rng.choices(signs, k=rng.randint(0, 60))) for _ in range(400)]
    words = ["the", "tionou", "aner,", "été", "straße", "1234", "don't", "x" * 30]
    made += [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(100)]
    return made + [None, "", " ", "  ", "a ", " a", "a  b", made[-1], "ab" * 400, "-" * 300 + " " * 50 + "é" * 100]


def test_texts_are_cut_where_neither_side_joins(sides):
    assert sides.cuts and sides.pieces("a b  c  d ") == ["a", "b", " c  d "]


def test_summary_equals_plain_loops(spark, texts):
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part int, place string").repartition(3)
    expected = _plain(texts)
    aligner = align.Aligner(spark, LEFT, RIGHT)
    for limit in (align.PART, 500):  # one part a task, and many
        found = {r["doc_id"]: tuple(r)[1:] for r in aligner.summarise(docs, limit=limit).collect()}
        assert [found[i] for i in range(len(texts))] == expected


def test_groups_and_edges(spark, texts):
    aligner = align.Aligner(spark, LEFT, RIGHT)
    docs = spark.createDataFrame([(1, "the tionou", "own"), (None, None, "own"), (1, "the tionou", "own")], "doc_id long, text string, parts string")
    rows = aligner.with_groups(docs).collect()
    joined = [";".join(",".join(map(str, g["a"])) + "|" + ",".join(map(str, g["b"])) for g in r["groups"]) for r in rows]
    assert joined[1] == "" and sha256(joined[0].encode()).hexdigest() == _plain(["the tionou"])[0][6] and rows[0]["parts"] == "own"
    repeated = sorted((tuple(r) for r in aligner.summarise(docs).collect()), key=str)
    assert len(repeated) == 3 and repeated[0] == repeated[1] and repeated[2][0] is None and repeated[2][1:] == (0, 0, 0, 0, 0, 0, "")
    assert aligner.summarise(docs.limit(0)).count() == 0


def test_long_text_in_one_group_converges():
    import numpy as np

    a, b = np.arange(2, 20_001, 2), np.append(np.arange(1, 20_000, 2), 20_000)
    left, right = align.terminals(a, b)
    assert (left == len(a) - 1).all() and (right == len(a) - 1).all()
