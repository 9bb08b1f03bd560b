"""The queries of this subpackage over the driver tables; thin layers over the operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import align, ann, bpe, language, minhash, mixing, negatives, pii, pitman, pq, quality, toxicity, urlfilter
from .common import crc_of, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.tiktoken")


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text and the bytes decoded from them, as digests."""
    tokenizer = bpe.Tokenizer(spark, TOKENIZER, public_tokenizers.PATTERN)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode_documents(docs, tokenizer)
    return bpe.decode_documents(encoded, tokenizer).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        bpe.digest(F.col("ids")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule or model verdict on every page's url."""
    judged = urlfilter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), urlfilter.seed_table(spark))
    return judged.select("page_id", "host", "path", "rule", "verdict", F.round("probability", 6).alias("probability"))


def mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    taken, _, _ = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return taken.select(F.col("doc").alias("doc_id"), "size", "source_size", "target", "taken", "source")


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every whole text; labels with remainder 2 are never seen."""
    remainder = crc_of(F.col("id")) % 4
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality.classify(docs, table(spark, sf_dir, "labels"), learn=remainder != 2, calibrate=remainder == 3)
    return found.select("doc_id", (~F.col("learn")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; its source takes the part of the host, ``lang`` that of the declaration."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    parts = (F.col("text"), F.col("lang"), F.col("source"), F.lit(None).cast("string"))
    found = language.identify(docs, language.gather(docs, *parts), *parts)
    return found.select("doc_id", "language", F.round("confidence", 6).alias("confidence"), "kept")


def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page from its text, markup declaration, address suffix and host."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    host = urlfilter.host_of(F.col("url"))
    body = F.regexp_replace(F.col("html"), r"(?s)<(script|style)\b.*?</\1>|<[^>]*>", " ")
    marked = F.nullif(F.lower(F.regexp_extract("html", r"(?i)<html[^>]*\slang=[\"']?([a-zA-Z]{2})", 1)), F.lit(""))
    known = pages.select("page_id", body.alias("text"), marked.alias("declared"), F.nullif(host, F.lit("")).alias("host"))
    known = known.withColumn("suffix", F.nullif(F.regexp_extract("host", r"([^.]+)$", 1), F.lit("")))
    parts = (F.col("text"), F.col("declared"), F.col("host"), F.col("suffix"))
    found = language.identify(known, language.gather(known, *parts), *parts)
    return found.select("page_id", "declared", "language", F.round("confidence", 6).alias("confidence"), "kept")


def minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class, links that joined it to its class, and representative of every document."""
    members, links = minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    ends = links.select(F.col("a").alias("text_class")).unionByName(links.select(F.col("b").alias("text_class")))
    counts = ends.groupBy("text_class").agg(F.count("*").alias("n_links"))
    return members.join(counts, "text_class", "left").select(
        F.col("id").alias("doc_id"), "text_class", F.col("component").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_joining_links"), (F.col("id") == F.col("component")).alias("kept"),
    )


def toxic_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every whole text; labels with remainder 0 are never seen."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = toxicity.fit(docs, table(spark, sf_dir, "labels"), learn=crc_of(F.col("id")) % 5 != 0)
    scored = docs.select("doc_id", (crc_of(F.col("doc_id")) % 5 == 0).alias("held_out"), toxicity.score(F.col("text"), lexicon, spark).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20 nearest rows of every twentieth vector."""
    return ann.search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("id") % 20 == 0)


def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return pq.links(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every whole text; rows with remainder 0 train nothing."""
    return pitman.score(table(spark, sf_dir, "documents").select("doc_id", "text"), crc_of(F.col("id")) % 10 == 0)


def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives of every fiftieth vector; labels of every seventh row are moved on by one first."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return negatives.mine(vectors, F.col("id") % 50 == 0)


HARD_NEGATIVES_SQL = """
WITH whole AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.id AS anchor_id, b.id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM whole a JOIN whole b ON a.id % 50 = 0 AND a.id <> b.id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
found AS (
  SELECT p.anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS rank
  FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score FROM found WHERE rank <= 3
"""


def token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizations of every whole text, with corpus-wide counts of the linked pairs."""
    aligner = align.Aligner(spark, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return aligner.summarise(table(spark, sf_dir, "documents").select("doc_id", "text"))


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every whole text: counts and places of the base kinds, and the places of all."""
    found = pii.find_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("pii", lambda x: x["kind"].isin("email", "ip", "card", "phone"))

    def count(kind: str) -> Column:
        return F.size(F.filter("pii", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(kind) for kind in ("email", "ip", "card", "phone")],
        F.sha2(pii.written(base).cast("binary"), 256).alias("base_sha256"), pii.written(F.col("pii")).alias("spans"),
    )


PERSONAL_DATA_SQL = f"""
WITH rows AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
spans AS ({pii.spans_sql("rows")}),
listed AS (
  SELECT r, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
         count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
         string_agg(kind || ':' || start || ':' || end_, ',' ORDER BY kind_no, start) FILTER (kind_no < 4) AS base,
         string_agg(kind || ':' || start || ':' || end_, ',' ORDER BY kind_no, start) AS spans
  FROM spans GROUP BY r)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
       coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM rows LEFT JOIN listed USING (r)
"""

QUERIES = {
    "op1_language_id": language_id,
    "language_id_pages": language_id_pages,
    "op2_byte_bpe": byte_bpe,
    "op3_nearest_neighbours": nearest_neighbours,
    "op4_url_filter": url_filter,
    "op5_mixing_sources": mixing_sources,
    "op6_quality_classifier": quality_classifier,
    "op7_minhash_near_dedup": minhash_near_dedup,
    "op8_pitman_yor": language_model,
    "op9_toxicity": toxic_documents,
    "op10_embedding_near_dedup": embedding_near_dedup,
    "op11_hard_negatives": hard_negatives,
    "op12_token_alignment": token_alignment,
    "op13_pii": personal_data,
}

ORACLE: dict[str, str] = {"op11_hard_negatives": HARD_NEGATIVES_SQL, "op13_pii": PERSONAL_DATA_SQL}
