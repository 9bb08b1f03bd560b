"""Language identification by fusing evidence with Bayes' rule.

* text: hashed byte-trigram likelihoods per language, summed per partition and smoothed;
* declared markup language and address suffix: how often texts that read as a language carry the
  declaration or suffix (grouped counts against the text-only reading);
* host: prior shares of the languages per host, smoothed towards the host's suffix group, which is
  smoothed towards the whole corpus.

A background class of even likelihoods stands for "none of these"; its posterior or an unsure best
language rejects a record.

Defined results: null or empty text gives even likelihoods, so the other evidence decides; null
declarations, suffixes and hosts carry no evidence; declarations outside the languages are ignored;
an empty table gives an empty result; repeated rows are judged alike; extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut
from .common import sum_by_row, utf8_parts, spare

LANGUAGES = ("de", "en", "es", "fr")
BINS = 1 << 14
SLICE = 1 << 20  # bytes handled at once
TEMPER = 0.25  # neighbouring trigrams overlap, so they count less than independent ones
SMOOTH_HOST = 20.0
BACKGROUND = 1e-4
_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32


def _codes(data: np.ndarray) -> np.ndarray:
    b = _LOWER[data]
    return ((b[:-2] * 961 + b[1:-1] * 31 + b[2:]) * np.uint32(2654435761) >> np.uint32(18)).astype(np.int32)


def trigram_counts(docs: DataFrame, text: Column, declared: Column, languages=LANGUAGES) -> np.ndarray:
    """Counts per language and bin over all texts that declare one of the languages."""
    size = len(languages)
    names = {name: i for i, name in enumerate(languages)}

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * BINS, np.int64)
        for batch in batches:
            offsets, data = utf8_parts(batch.column("text"))
            kinds = np.array([names.get(d, -1) for d in batch.column("declared").to_pylist()])
            for start, end, kind in zip(offsets[:-1].tolist(), offsets[1:].tolist(), kinds.tolist(), strict=True):
                for at in range(start, end - 2, SLICE) if kind >= 0 else ():
                    total[kind * BINS : (kind + 1) * BINS] += np.bincount(_codes(data[at : min(end, at + SLICE + 2)]), minlength=BINS)
        ends = np.arange(0, size * BINS + 1, BINS, dtype=np.int32)
        yield pa.record_batch([pa.array(np.arange(size, dtype=np.int32)), pa.ListArray.from_arrays(pa.array(ends), pa.array(total))], ["kind", "counts"])

    def added(table: pa.Table) -> pa.Table:
        rows = table.column("counts").combine_chunks().flatten().to_numpy().reshape(-1, BINS)
        return pa.table({"kind": table.column("kind")[:1], "counts": pa.array([rows.sum(axis=0)], pa.list_(pa.int64()))})

    parts = docs.select(text.alias("text"), declared.alias("declared")).mapInArrow(partial, "kind int, counts array<long>")
    counts = np.zeros((size, BINS))
    for row in parts.groupBy("kind").applyInArrow(added, "kind int, counts array<long>").toArrow().to_pylist():
        counts[row["kind"]] = row["counts"]  # languages x bins numbers
    return counts


def log_table(counts: np.ndarray) -> np.ndarray:
    """Smoothed log likelihoods per bin and language; the background is last."""
    total = counts.sum(axis=1, keepdims=True)
    table = np.log((counts + 0.5) / (total + 0.5 * BINS))
    return np.vstack([table, np.full((1, BINS), -np.log(BINS))]).T.copy()


def text_evidence(text: Column, table: np.ndarray, spark) -> Column:
    """``array<double>``: tempered log likelihood per language and, last, of the background."""
    sent, size = spark.sparkContext.broadcast(table), table.shape[1]

    def run(texts: pa.Array) -> pa.Array:
        logs = sent.value
        offsets, data = utf8_parts(texts)
        out = np.zeros((len(offsets) - 1, size))
        small, row = 0, 0
        while row < len(out):  # as many rows at once as fit a slice
            stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLICE, side="right")) - 1)
            first, last = int(offsets[row]), int(offsets[stop])
            if stop == row + 1:
                for at in range(first, last - 2, SLICE):
                    out[row] += logs[_codes(data[at : min(last, at + SLICE + 2)])].sum(axis=0)
            elif last - first > 2:
                found = _codes(data[first:last])
                ends = np.minimum(offsets[row : stop + 1] - first, len(found))
                cross = np.concatenate([ends[1:-1] - 1, ends[1:-1] - 2])
                cross = cross[cross >= 0]
                for k in range(size):
                    values = logs[found, k]
                    values[cross] = 0.0  # trigrams over the border of two texts
                    out[row:stop, k] = sum_by_row(values, ends)
            row = stop
        del small
        flat = pa.array((out * TEMPER).ravel())
        return pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, size, dtype=np.int32)), flat)

    return F.arrow_udf(run, "array<double>").asNondeterministic()(text)


def _numbers(values: list[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def _log_table_of(rows: list, key: str, languages, alpha: float) -> dict[str, list[float]]:
    """Smoothed log P(key | language) relative to the mean over languages."""
    per = np.zeros(len(languages))
    keys = sorted({r[key] for r in rows})
    counts = {k: np.zeros(len(languages)) for k in keys}
    for r in rows:
        counts[r[key]][r["best"]] += r["count"]
        per[r["best"]] += r["count"]
    return {k: np.log((counts[k] + alpha) / (per + alpha * (len(keys) + 1))).tolist() for k in keys}


class Evidence:
    """What was gathered from the corpus; ``hosts`` is a table, the rest is bounded."""

    def __init__(self, table: np.ndarray, declared: dict[str, list[float]], suffixes: DataFrame, hosts: DataFrame, overall: list[float], languages) -> None:
        self.table, self.declared, self.suffixes, self.hosts, self.overall, self.languages = table, declared, suffixes, hosts, overall, languages


def _best(evidence: Column, size: int) -> Column:
    part = F.slice(evidence, 1, size)
    return (F.array_position(part, F.array_max(part)) - 1).cast("int")


def gather(docs: DataFrame, text: Column, declared: Column, host: Column, suffix: Column, languages=LANGUAGES) -> Evidence:
    """All statistics of the fusion, from grouped aggregates over the whole table."""
    spark, size = docs.sparkSession, len(languages)
    declared = F.when(declared.isin(*languages), declared)
    table = log_table(trigram_counts(docs, text, declared, languages))
    read = docs.select(text_evidence(text, table, spark).alias("_e"), declared.alias("declared"), host.alias("host"), suffix.alias("suffix"))
    sure = F.array_max(F.slice("_e", 1, size)) > F.col("_e")[size]
    counts = cut(read.select("declared", "host", "suffix", _best(F.col("_e"), size).alias("best"), sure.alias("sure")).where("sure").groupBy("declared", "host", "suffix", "best").count())
    by_declared = counts.where("declared is not null").groupBy("declared", "best").agg(F.sum("count").alias("count")).collect()  # languages squared
    total = np.full(size, 1.0)
    for r in counts.groupBy("best").agg(F.sum("count").alias("count")).collect():
        total[r["best"]] += r["count"]
    overall = total / total.sum()

    def shares(key: str) -> list[Column]:
        return [F.sum(F.when(F.col("best") == i, F.col("count")).otherwise(0)).alias(f"n{i}") for i in range(size)]

    suffixes = counts.where("suffix is not null").groupBy("suffix").agg(F.sum("count").alias("n"), *shares("suffix"))
    # how much likelier each language is to carry the suffix than the corpus is
    carried = [F.log((F.col(f"n{i}") + 0.5) / (total[i] + 1.0)) for i in range(size)]
    grouped = [(F.col(f"n{i}") + SMOOTH_HOST * float(overall[i])) / (F.col("n") + SMOOTH_HOST) for i in range(size)]
    suffixes = cut(suffixes.select("suffix", F.array(*carried).alias("suffix_log"), F.array(*grouped).alias("suffix_share")))
    hosts = counts.where("host is not null").groupBy("host").agg(F.sum("count").alias("n"), F.min("suffix").alias("suffix"), *shares("host"))
    hosts = hosts.join(suffixes.select("suffix", "suffix_share"), "suffix", "left")
    parent = F.coalesce("suffix_share", _numbers(overall.tolist()))
    prior = [F.log((F.col(f"n{i}") + SMOOTH_HOST * parent[i]) / (F.col("n") + SMOOTH_HOST)) for i in range(size)]
    hosts = cut(hosts.select("host", F.array(*prior).alias("host_log")))
    return Evidence(table, _log_table_of(by_declared, "declared", languages, 1.0), suffixes.select("suffix", "suffix_log"), hosts, np.log(overall).tolist(), languages)


def identify(docs: DataFrame, evidence: Evidence, text: Column, declared: Column, host: Column, suffix: Column, prefix: str = "") -> DataFrame:
    """``docs`` with ``language`` ('und' for the background), ``confidence`` and ``kept``."""
    spark, size = docs.sparkSession, len(evidence.languages)
    none = _numbers([0.0] * size)
    said = none
    for name, values in evidence.declared.items():
        said = F.when(declared == name, _numbers(values)).otherwise(said)
    own = spare(docs, "own_")
    keyed = docs.withColumns({f"{own}t": text_evidence(text, evidence.table, spark), f"{own}said": said, f"{own}h": host, f"{own}s": suffix})
    keyed = keyed.join(evidence.hosts.withColumnsRenamed({"host": f"{own}hk", "host_log": f"{own}hl"}), F.col(f"{own}h") == F.col(f"{own}hk"), "left")
    keyed = keyed.join(evidence.suffixes.withColumnsRenamed({"suffix": f"{own}sk", "suffix_log": f"{own}sl"}), F.col(f"{own}s") == F.col(f"{own}sk"), "left")
    sums = [
        F.col(f"{own}t")[i] + F.col(f"{own}said")[i] + F.coalesce(F.col(f"{own}hl")[i], F.lit(evidence.overall[i])) + F.coalesce(F.col(f"{own}sl")[i], F.lit(0.0))
        for i in range(size)
    ]
    # the background carries declarations and suffixes as the average language does
    mean = (sum(F.col(f"{own}said")[i] + F.coalesce(F.col(f"{own}sl")[i], F.lit(0.0)) for i in range(size))) / size
    sums.append(F.col(f"{own}t")[size] + mean + float(np.log(BACKGROUND)))
    scored = keyed.withColumn(f"{own}post", F.array(*sums)).withColumn(f"{own}top", F.array_max(f"{own}post"))
    weight = F.aggregate(F.transform(f"{own}post", lambda x: F.exp(x - F.col(f"{own}top"))), F.lit(0.0), lambda a, x: a + x)
    names = F.array(*[F.lit(n) for n in (*evidence.languages, "und")])
    found = scored.withColumns({f"{prefix}language": F.element_at(names, F.array_position(f"{own}post", F.col(f"{own}top")).cast("int")), f"{prefix}confidence": 1.0 / weight})
    found = found.withColumn(f"{prefix}kept", (F.col(f"{prefix}language") != "und") & (F.col(f"{prefix}confidence") >= 0.5))
    return found.drop(*[f"{own}{c}" for c in ("t", "said", "h", "s", "hk", "hl", "sk", "sl", "post", "top")])


def kept_documents(docs: DataFrame, text: str = "text", declared: str = "lang", host: str = "source") -> DataFrame:
    """``docs`` without records whose language is unsure or none of the known ones."""
    none = F.lit(None).cast("string")
    parts = (F.col(text), F.col(declared), F.col(host), none)
    own = spare(docs, "id_")
    return identify(docs, gather(docs, *parts), *parts, prefix=own).where(F.col(f"{own}kept")).select(*docs.columns)
