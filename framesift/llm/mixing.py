"""Mixing sources to target weights by packed blocks and pseudorandom index permutations.

1. Every document gets its place in its source's stream of words (prefix sums over small hashed
   buckets, so that a hot source is never one task), and the stream is cut into blocks of a fixed
   number of words.
2. Targets per source come from weights and a total share; a source stops at ``limit`` times its
   size and the excess is shared anew by weight (one row per source).
3. The mix consists of output shards with a fixed number of slots.  For each shard the counts of its
   sources are drawn multinomially: every slot draws an integer whose interval names the source.
   Slots beyond a source's target are void, and shards of remainders make up what is missing, so that
   the drawn counts end exactly at the targets.
4. The k-th slot of a source takes block ``perm(k)`` of the source: an affine permutation per pass,
   with a multiplier prime to the number of blocks.  The short last block ends each pass, and the
   last slot of a source is cut to the words still missing.
5. Slots and blocks are joined by (source, block).

Everything is column expressions.  Defined results: null text has size 0; documents of size 0 take
nothing; a null source is a source of its own, ordered last; an empty table gives an empty result;
rows that agree in id, source and text are interchangeable and are counted each on their own; the
draws depend on the seed and the data only, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut
from .common import WORD

BLOCK = 64  # words
SHARD_SLOTS = 65_536
CELLS = 1024
WEIGHTS = (5.0, 2.0, 1.0)
#: Primes just under a million; at most three of them divide a number below 2**60.
PRIMES = (999_863, 999_883, 999_907, 999_917, 999_931, 999_953, 999_959, 999_961)


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sizes(docs: DataFrame, doc: str, text: str, source: str) -> DataFrame:
    """``(doc, source, print, size)``, one row per document; ``print`` breaks ties of repeated ids."""
    return docs.select(
        F.col(doc).alias("doc"),
        F.col(source).alias("source"),
        F.xxhash64(F.col(text)).alias("print"),
        size_of(F.col(text)).alias("size"),
    )


def targets(sized: DataFrame, share: float, weights=WEIGHTS, limit: float = 2.0) -> DataFrame:
    """``(source_id, source, source_size, target)``: one row per source.

    With sources in the order of size over weight, those before some point are capped and the rest
    share what is left by weight; windows over one row per source find that point.
    """
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    number = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (number % len(weights) + 1).cast("int"))
    named = per_source.select("*", number.cast("long").alias("source_id"), weight.alias("weight"))
    cap = F.col("source_size") * limit
    by_ratio = Window.orderBy((cap / F.col("weight")).asc(), F.col("source_id"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything) * share
    left = total - F.coalesce(F.sum(cap).over(before), F.lit(0.0))
    heavy = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    levelled = named.select("*", cap.alias("cap"), (left / heavy).alias("level"))
    # the first source whose cap is not below its level ends the capped ones
    rank = F.struct((F.col("cap") / F.col("weight")).alias("ratio"), "source_id", "level")
    final = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), rank)).over(everything)["level"]
    chosen = F.least(F.col("cap"), F.coalesce(final * F.col("weight"), F.col("cap")))
    return levelled.select("source_id", "source", "source_size", "docs", F.greatest(chosen, F.lit(0.0)).alias("target"))


def plan_of(per_source: DataFrame, block: int) -> DataFrame:
    """What each source takes, as whole passes and slots of the last, partial pass."""
    words = F.round("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0).cast("long")
    counted = per_source.withColumns({"passes": passes, "words": words})
    rest = F.when(F.col("source_size") > 0, F.col("words") - F.col("passes") * F.col("source_size")).otherwise(F.lit(0))
    counted = counted.withColumns({"rest": rest.cast("long"), "blocks": F.ceil(F.col("source_size") / block).cast("long")})
    full = F.floor(F.col("source_size") / block).cast("long")
    return counted.withColumns({"full": full, "slots": F.col("passes") * F.col("blocks") + F.ceil(F.col("rest") / block).cast("long")})


def placed(sized: DataFrame, per_source: DataFrame, bucket_rows: int = 4096) -> DataFrame:
    """Documents of size > 0 with ``start``, their first word's place in the source's stream."""
    named = per_source.select("source_id", F.col("source").alias("_name"), (F.floor(F.col("docs") / bucket_rows) + 1).alias("_buckets"))
    tagged = sized.join(named, sized["source"].eqNullSafe(named["_name"])).drop("_name")
    tagged = tagged.where(F.col("size") > 0).withColumn("bucket", F.pmod(F.xxhash64("doc", "print"), F.col("_buckets")))
    tagged = tagged.select("source_id", "bucket", "doc", "print", "size")
    totals = tagged.groupBy("source_id", "bucket").agg(F.sum("size").alias("_sum"))
    first = F.coalesce(F.sum("_sum").over(Window.partitionBy("source_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = totals.select("source_id", "bucket", first.alias("_first"))
    inside = Window.partitionBy("source_id", "bucket").orderBy("doc", "print").rowsBetween(Window.unboundedPreceding, -1)
    ordered = tagged.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return ordered.join(offsets, ["source_id", "bucket"]).select("source_id", "doc", "print", "size", (F.col("_first") + F.col("_inside")).alias("start"))


def drawn_slots(plan: DataFrame, seed: int, shard_slots: int) -> DataFrame:
    """``(shard, source_id, k)`` and the source's plan: slot k of its source, drawn for a shard."""
    everything = Window.partitionBy()
    upto = Window.orderBy("source_id").rowsBetween(Window.unboundedPreceding, -1)
    spans = plan.where(F.col("slots") > 0).select(
        "source_id",
        F.coalesce(F.sum("slots").over(upto), F.lit(0)).alias("low"),
        "slots",
        F.sum("slots").over(everything).alias("total"),
    )
    total = spans.agg(F.coalesce(F.max("total"), F.lit(0)).cast("long")).first()[0]
    spark = plan.sparkSession
    wide = max(1, -(-total // CELLS))
    cells = spans.select(
        "source_id", "low", (F.col("low") + F.col("slots")).alias("high"),
        F.explode(F.sequence(F.floor(F.col("low") / wide), F.floor((F.col("low") + F.col("slots") - 1) / wide))).alias("cell"),
    )
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.lit(max(1, total)))
    draws = spark.range(total).select(F.floor(F.col("id") / shard_slots).alias("shard"), draw.alias("draw"))
    draws = draws.withColumn("cell", F.floor(F.col("draw") / wide))
    hits = draws.join(cells, "cell").where((F.col("draw") >= F.col("low")) & (F.col("draw") < F.col("high")))
    counts = hits.groupBy("source_id", "shard").agg(F.count("*").alias("n"))  # multinomial counts of each shard
    first = F.coalesce(F.sum("n").over(Window.partitionBy("source_id").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.withColumn("first", first)
    made = counts.groupBy("source_id").agg(F.sum("n").alias("made"))
    shards = max(1, -(-total // shard_slots))
    short = plan.join(made, "source_id", "left").select("source_id", F.coalesce("made", F.lit(0)).alias("first"), "slots").where("first < slots")
    # remainders, in pieces of a shard's size
    pieces = short.withColumn("_piece", F.explode(F.sequence(F.lit(0), F.floor((F.col("slots") - F.col("first") - 1) / shard_slots))))
    pieces = pieces.select(
        "source_id",
        (F.col("_piece") + shards).alias("shard"),
        (F.col("first") + F.col("_piece") * shard_slots).alias("first"),
        F.least(F.lit(shard_slots), F.col("slots") - F.col("first") - F.col("_piece") * shard_slots).alias("n"),
    )
    both = counts.select("source_id", "shard", "first", "n").unionByName(pieces)
    both = both.join(plan.select("source_id", "slots", "blocks", "full", "passes", "rest", "source_size"), "source_id")
    kept = both.withColumn("n", F.least(F.col("n"), F.col("slots") - F.col("first"))).where("n > 0")
    return kept.withColumn("k", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)))


def blocks_of_slots(slots: DataFrame, seed: int, block: int) -> DataFrame:
    """``(source_id, shard, k, block, pass, words)``: the block that each slot takes and how much of it."""
    run = F.floor(F.col("k") / F.col("blocks"))
    at = F.col("k") - run * F.col("blocks")
    fair = F.filter(F.array(*[F.lit(p).cast("long") for p in PRIMES]), lambda p: F.col("full") % p != 0)
    factor = F.element_at(fair, (F.pmod(F.xxhash64(F.lit(seed), F.col("source_id"), run), F.size(fair)) + 1).cast("int"))
    shift = F.pmod(F.xxhash64(F.lit(seed + 1), F.col("source_id"), run), F.greatest(F.col("full"), F.lit(1)))
    moved = F.pmod(F.pmod(at, F.col("full")) * factor + shift, F.col("full"))
    chosen = F.when(at < F.col("full"), moved).otherwise(at)  # the short last block ends a pass
    left = F.when(run < F.col("passes"), F.lit(block)).otherwise(F.col("rest") - at * block)
    length = F.least(F.lit(block), F.col("source_size") - chosen * block)
    return slots.select("source_id", "shard", "k", chosen.cast("long").alias("block"), run.alias("pass"), F.least(left, length).alias("words"))


def mix(
    docs: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    source: str = "source",
    share: float = 1.5,
    weights=WEIGHTS,
    limit: float = 2.0,
    seed: int = 7,
    block: int = BLOCK,
    shard_slots: int = SHARD_SLOTS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(taken, slots, per_source)``.

    ``taken``: (doc, print, size, source_id, source, source_size, target, taken, whole, parts), one
    row per document; ``whole`` counts the passes that take all of it, and ``parts`` lists the word
    ranges ``(from, words)`` of the last pass.  ``slots``: the blocks of every output shard.
    """
    sized = cut(sizes(docs, doc, text, source))
    per_source = cut(plan_of(targets(sized, share, weights, limit), block))
    stream = placed(sized, per_source)
    slots = blocks_of_slots(drawn_slots(per_source, seed, shard_slots), seed, block)
    # whole passes take every block; only the last pass is joined
    last = slots.join(per_source.select("source_id", "passes"), "source_id").where(F.col("pass") == F.col("passes"))
    last = last.select("source_id", "block", "words")
    cover = stream.withColumn(
        "block",
        F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block))),
    )
    joined = cover.join(last, ["source_id", "block"])
    low = F.greatest(F.col("start"), F.col("block") * block)
    high = F.least(F.col("start") + F.col("size"), F.col("block") * block + F.col("words"))
    pieces = joined.select("source_id", "doc", "print", "size", "start", (low - F.col("start")).alias("from"), (high - low).alias("words")).where("words > 0")
    grouped = pieces.groupBy("source_id", "doc", "print", "size", "start").agg(
        F.sum("words").alias("partly"), F.array_sort(F.collect_list(F.struct("from", "words"))).alias("parts")
    )
    keyed = stream.join(grouped.select("source_id", "start", "partly", "parts"), ["source_id", "start"], "left")
    info = per_source.select("source_id", "source", "source_size", "target", "passes")
    none = F.array().cast("array<struct<from:bigint,words:bigint>>")
    filled = keyed.join(info, "source_id").select(
        "doc", "print", "size", "source", "source_size", "target",
        (F.col("passes") * F.col("size") + F.coalesce("partly", F.lit(0))).alias("taken"),
        F.col("passes").alias("whole"),
        F.coalesce("parts", none).alias("parts"),
    )
    names = per_source.select(F.col("source").alias("_name"), "source_size", "target")
    empty = sized.where("size = 0").join(names, F.col("source").eqNullSafe(F.col("_name"))).select(
        "doc", "print", "size", "source", "source_size", "target", F.lit(0).cast("long").alias("taken"), F.lit(0).cast("long").alias("whole"), none.alias("parts")
    )
    return filled.unionByName(empty), slots, per_source


def mixed_documents(docs: DataFrame, doc: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mix as documents: same columns, with the text that the mix takes.

    A document taken as a whole keeps its text, once per pass, and the word ranges of the last pass
    follow, joined by spaces; a document of which nothing is taken goes.  ``n_chars``, if there, is
    counted anew.
    """
    taken, _, _ = mix(docs, doc, text, source, **options)
    same = Window.partitionBy("doc", "source", "print").orderBy(F.lit(1))
    chosen = taken.where("taken > 0").select("doc", "source", "print", "whole", "parts", F.row_number().over(same).alias("copy"))
    own = Window.partitionBy("_doc", "_source", "_print").orderBy(F.lit(1))
    keyed = docs.withColumns({"_doc": F.col(doc), "_source": F.col(source), "_print": F.xxhash64(F.col(text))})
    keyed = keyed.withColumn("_copy", F.row_number().over(own))
    chosen = chosen.select(*[F.col(c).alias(f"_m_{c}") for c in chosen.columns])
    pair = (
        F.col("_doc").eqNullSafe(F.col("_m_doc")) & F.col("_source").eqNullSafe(F.col("_m_source"))
        & (F.col("_print") == F.col("_m_print")) & (F.col("_copy") == F.col("_m_copy"))
    )
    words = F.regexp_extract_all(F.col(text), F.lit(f"({WORD})"), 1)
    ranges = F.transform("_m_parts", lambda p: F.array_join(F.slice(words, (p["from"] + 1).cast("int"), p["words"].cast("int")), " "))
    parts = F.concat(F.array_repeat(F.col(text), F.col("_m_whole").cast("int")), F.when(F.size("_m_parts") > 0, ranges).otherwise(F.array().cast("array<string>")))
    found = keyed.join(chosen, pair).withColumn(text, F.array_join(parts, "\n"))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType))
    return found.select(*docs.columns)
