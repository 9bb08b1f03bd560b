"""The corpus pipeline over a small fixture, stage by stage, against plain readings of its decisions."""

import base64
import hashlib
import random

import public_tokenizers
import tiktoken

import corpus_pipeline
from framesift.session import cut

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the and that with this from they have were which their would there about other into more some time very when come here just like long make many over such take than them well only know year work first after where most".split()


def _folder(spark, tmp_path, docs, labels):
    spark.createDataFrame(docs, DOCS).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def test_stages_decide_and_digests_hold(spark, tmp_path):
    rng = random.Random(8)

    def prose(n=60):
        return " ".join(rng.choices(WORDS, k=n))

    texts = {i: prose() for i in range(120)}
    for i in range(60, 100):  # labelled and unlabelled toxic documents
        texts[i] += " moronface " + prose(20)
    for i in range(100, 104):  # a group of near copies
        texts[i] = texts[100][:-3] + f" x{i}" if i > 100 else prose(200)
    texts[101] = texts[102] = texts[100]
    texts[110], texts[111] = None, ""
    docs = [(i, t, "en", "web" if i % 3 else None, len(t or "")) for i, t in texts.items()]
    labels = [(i, 1, int(60 <= i < 95)) for i in range(95) if i not in (110, 111)]
    folder = _folder(spark, tmp_path, docs, labels)
    current, seen = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        current = cut(stage(spark, current, folder))
        assert current.columns == [c.split()[0] for c in DOCS.split(", ")]
        seen[name] = {r.doc_id for r in current.collect()}
    assert not seen["toxicity"] & set(range(60, 100)) and set(range(60)) <= seen["toxicity"]
    assert set(range(60)) <= seen["language_id"]
    assert seen["minhash_near_dedup"] & {100, 101, 102} == {100} and set(range(60)) <= seen["minhash_near_dedup"]
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    wanted = {r.doc_id: r.text or "" for r in current.collect()}
    rows = corpus_pipeline.STAGES[-1][1](spark, current, folder).collect()
    assert len(rows) == len(wanted)
    for r in rows:
        ids = plain.encode_ordinary(wanted[r.doc_id])
        assert list(r.ids) == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(wanted[r.doc_id].encode()).hexdigest()


def test_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, _folder(spark, tmp_path, [], [])).count() == 0


def test_batches_are_small(spark, tmp_path):
    """A smaller setting of the session holds; a larger one, or none, is brought down."""
    rows, folder = "spark.sql.execution.arrow.maxRecordsPerBatch", _folder(spark, tmp_path, [], [])
    before = spark.conf.get(rows)
    try:
        for given, wanted in (("10000", corpus_pipeline.BATCH), ("0", corpus_pipeline.BATCH), ("500", 500)):
            spark.conf.set(rows, given)
            corpus_pipeline.run(spark, folder)
            assert int(spark.conf.get(rows)) == wanted
    finally:
        spark.conf.set(rows, before)
