"""Quality scores: random Fourier features over document statistics, ridge regression, isotonic calibration.

One pass computes a fixed number of statistics per whole text.  Random Fourier features approximate a
Gaussian kernel on the standardised statistics.  Every partition sums its part of the normal
equations; the parts are added row by row, and the driver solves one system of a fixed size.
Isotonic regression on equal-count-free, fixed score cells (pooled adjacent violators on grouped
counts) turns raw scores into probabilities, fitted on labelled rows that the ridge did not see.

Defined results: null or empty text has statistics of its own and gets a score like any other; rows
repeat freely; a document with several labels counts with their mean; without usable labels every
score is 0.5; null labels are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut

FEATURES = 256
CELLS = 512
SEED = 11
NAMES = (
    "log_bytes", "log_words", "mean_word", "word_spread", "distinct", "top_word", "letters", "capitals", "digits", "spaces",
    "ascii_marks", "bar_words", "marked_words", "end_repeat", "upper_words", "single_words", "lines", "line_repeat", "stops", "pairs",
)
_STOPS = frozenset(b".!?:;")


def statistics_of(text: str | None) -> list[float]:
    """Shape of one text; shares are over bytes, words or lines."""
    raw = (text or "").encode()
    words = raw.split()
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) if raw else np.zeros(256, np.int64)
    size, n = max(1, len(raw)), max(1, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    lines = [x for x in raw.split(b"\n") if x.strip()]
    small, large = int(count[97:123].sum()), int(count[65:91].sum())
    high, digits = int(count[128:].sum()), int(count[48:58].sum())
    spaces = int(count[[9, 10, 11, 12, 13, 32]].sum())
    kinds = len(seen)
    ends: dict[bytes, int] = {}
    marked = upper = 0
    for w, c in seen.items():
        tail = w[-1]
        if tail < 48 or 57 < tail < 65 or 122 < tail < 128:
            if tail not in b".,":
                marked += c
            if len(w) > 1 and w[-2] == tail:
                ends[w[-2:]] = ends.get(w[-2:], 0) + c
        if w.isupper() and len(w) > 1:
            upper += c
    return [
        np.log1p(len(raw)), np.log1p(len(words)), float(lengths.mean()), float(lengths.std()), kinds / n,
        max(seen.values(), default=0) / n, (small + large + high) / size, large / max(1, small + large), digits / size, spaces / size,
        (len(raw) - small - large - high - digits - spaces) / size, seen.get(b"|", 0) / n, marked / n, sum(ends.values()) / n, upper / n,
        sum(c for w, c in seen.items() if len(w) == 1) / n, np.log1p(len(lines)), 1 - len(set(lines)) / max(1, len(lines)),
        sum(int(count[b]) for b in _STOPS) / n, float(sum(a == b for a, b in zip(words, words[1:], strict=False))) / n,
    ]


def statistics(text: Column) -> Column:
    """``array<double>`` of the statistics, in the order of ``NAMES``."""

    def run(texts: pa.Array) -> pa.Array:
        flat = np.array([x for t in texts.to_pylist() for x in statistics_of(t)], dtype=np.float64)
        ends = np.arange(0, (len(texts) + 1) * len(NAMES), len(NAMES), dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    return F.arrow_udf(run, "array<double>").asNondeterministic()(text)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


class Kernel:
    """Standardisation and random Fourier features; a constant is the last feature."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, features: int = FEATURES, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        self.mean, self.spread = mean, spread
        self.directions = rng.standard_normal((len(mean), features)) / np.sqrt(len(mean))
        self.shift = rng.uniform(0, 2 * np.pi, features)

    def __call__(self, raw: np.ndarray) -> np.ndarray:
        z = np.clip((raw - self.mean) / self.spread, -8, 8)
        waves = np.cos(z @ self.directions + self.shift) * np.sqrt(2 / len(self.shift))
        return np.hstack([waves, z / 8, np.ones((len(raw), 1))])

    @property
    def width(self) -> int:
        return len(self.shift) + len(self.mean) + 1


def isotonic(total: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Non-decreasing shares of positives per cell (pooled adjacent violators); empty cells are filled between."""
    filled = np.flatnonzero(total > 0)
    if not len(filled):
        return np.full(len(total), 0.5)
    blocks: list[list[float]] = []  # positives, weight, cells
    for t, p in zip(total[filled].tolist(), positive[filled].tolist(), strict=True):
        blocks.append([p, t, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            p2, t2, n2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + p2, blocks[-1][1] + t2, blocks[-1][2] + n2]
    shares = np.concatenate([np.full(int(n), p / t) for p, t, n in blocks])
    return np.interp(np.arange(len(total)), filled, shares)


class Model:
    """Kernel, ridge weights and calibration; a few thousand numbers."""

    def __init__(self, kernel: Kernel, weights: np.ndarray, edges: tuple[float, float], levels: np.ndarray) -> None:
        self.kernel, self.weights, self.edges, self.levels = kernel, weights, edges, levels

    def raw(self, statistics: np.ndarray) -> np.ndarray:
        return self.kernel(statistics) @ self.weights

    def place(self, raw: np.ndarray) -> np.ndarray:
        low, high = self.edges
        return np.clip((raw - low) / max(high - low, 1e-9) * CELLS, 0, CELLS - 1e-6)

    def score(self, statistics: np.ndarray) -> np.ndarray:
        """Calibrated share, with a slight slope inside flat stretches so that ranks stay."""
        at = self.place(self.raw(statistics))
        level = np.interp(at, np.arange(CELLS) + 0.5, self.levels)
        return np.clip(0.999 * level + 0.001 * at / CELLS, 0.0, 1.0)


def fit(rows: DataFrame, calibrate: str = "calibrate", ridge: float = 1.0) -> Model | None:
    """``rows``: (statistics array<double>, label double, calibrate boolean)."""
    spark, width = rows.sparkSession, len(NAMES)
    fitted = rows.where(~F.col(calibrate))
    moments = fitted.select(F.count("*").alias("n"), *[
        f(F.col("statistics")[i]).alias(f"{k}{i}") for i in range(width) for k, f in (("m", F.avg), ("s", F.stddev_pop))
    ]).first()
    if not moments["n"]:
        return None
    mean = np.array([moments[f"m{i}"] for i in range(width)])
    kernel = Kernel(mean, np.maximum([moments[f"s{i}"] for i in range(width)], 1e-6))
    sent = spark.sparkContext.broadcast(kernel)
    wide = kernel.width

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = sent.value
        gram, seen = np.zeros((wide, wide + 1)), 0
        for batch in batches:
            x = k(_matrix(batch.column("statistics"), width))
            y = batch.column("label").to_numpy(zero_copy_only=False)
            gram += x.T @ np.hstack([x, y[:, None]])
            seen += len(y)
        if seen:
            ends = np.arange(0, wide * (wide + 1) + 1, wide + 1, dtype=np.int32)
            yield pa.record_batch([pa.array(np.arange(wide, dtype=np.int32)), pa.ListArray.from_arrays(pa.array(ends), pa.array(gram.ravel()))], ["line", "sums"])

    parts = fitted.select("statistics", "label").mapInArrow(partial, "line int, sums array<double>")

    def added(table: pa.Table) -> pa.Table:
        total = _matrix(table.column("sums"), wide + 1).sum(axis=0)
        return pa.table({"line": table.column("line")[:1], "sums": pa.array([total.tolist()])})

    lines = parts.groupBy("line").applyInArrow(added, "line int, sums array<double>").collect()  # width x width numbers
    system = np.array([r["sums"] for r in sorted(lines, key=lambda r: r["line"])])
    penalty = np.eye(wide) * ridge
    penalty[-1, -1] = 1e-9
    weights = np.linalg.solve(system[:, :-1] + penalty, system[:, -1])
    model = Model(kernel, weights, (-0.5, 1.5), np.full(CELLS, 0.5))
    sent_model = spark.sparkContext.broadcast(model)

    def cell(found: pa.Array) -> pa.Array:
        m = sent_model.value
        return pa.array(m.place(m.raw(_matrix(found, width))).astype(np.int32))

    counted = (
        rows.where(F.col(calibrate))
        .select(F.arrow_udf(cell, "int")("statistics").alias("cell"), "label")
        .groupBy("cell").agg(F.count("*").alias("n"), F.sum("label").alias("positive")).collect()
    )  # at most CELLS rows
    total, positive = np.zeros(CELLS), np.zeros(CELLS)
    for r in counted:
        total[r["cell"]], positive[r["cell"]] = r["n"], r["positive"]
    if counted:
        model.levels = isotonic(total, positive)
    else:
        model.levels = np.clip(np.linspace(-0.5, 1.5, CELLS), 0, 1)
    return model


def score(statistics_column: Column, model: Model | None, spark) -> Column:
    if model is None:
        return F.lit(0.5)
    sent, width = spark.sparkContext.broadcast(model), len(NAMES)

    def run(found: pa.Array) -> pa.Array:
        return pa.array(sent.value.score(_matrix(found, width))) if len(found) else pa.array([], pa.float64())

    return F.arrow_udf(run, "double")(statistics_column)


def classify(docs: DataFrame, labels: DataFrame, learn: Column, calibrate: Column, doc: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """``(doc, learn, score)`` for every document.

    ``labels``: (doc, label).  ``learn``: over the column ``id``, the rows whose labels may be seen;
    ``calibrate``: those of them that are kept for the calibration.
    """
    stats = cut(docs.select(F.col(doc).alias("id"), statistics(F.col(text)).alias("statistics")))
    known = labels.where(F.col(label).isNotNull()).groupBy(F.col(doc).alias("id")).agg(F.avg(F.col(label).cast("double")).alias("label"))
    rows = stats.where(learn).join(known, "id").withColumn("calibrate", calibrate)
    model = fit(cut(rows.select("statistics", "label", "calibrate")))
    return stats.select(F.col("id").alias(doc), learn.alias("learn"), score(F.col("statistics"), model, docs.sparkSession).alias("score"))
