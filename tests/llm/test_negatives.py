"""Hard negatives against plain integer products."""

import math

import numpy as np
from pyspark.sql import functions as F

from framesift.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, score double, c int, q string"


def _plain(rows):
    fine = [(i, l, [math.floor(256 * float(x)) for x in v]) for i, v, l in rows if None not in (i, l, v) and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, label, v in fine:
        if a % 50:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(v, w)), i, l) for i, l, w in fine if i != a))
        for s, p, _ in [x for x in scored if x[2] == label][:5]:
            hits = [(t, n) for t, n, l in scored if l != label and 50 * -s <= 100 * -t <= 95 * -s][:3]
            out += [(a, p, k + 1, n, -s, -t) for k, (t, n) in enumerate(hits)]
    return sorted(out)


def _mined(spark, rows, **sizes):
    table = spark.createDataFrame([(i, v, l, 0.5, 1, "x") for i, v, l in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in negatives.mine(table, F.col("id") % 50 == 0, **sizes).collect())


def test_products_equal_multiplication():
    rng = np.random.default_rng(1)
    for width, top in ((8, 1), (64, 200), (24, 70_000)):
        a, b = rng.integers(-top, top + 1, (300, width)), rng.integers(-top, top + 1, (700, width))
        found = negatives.products(negatives.tables(a), negatives.planes(b, int(top).bit_length() + 1))
        assert (found == b @ a.T).all()


def test_negatives_equal_brute_force_over_several_units(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 13).astype(np.float32)], int(rng.integers(0, 3))) for i in range(700)]
    rows = [(i, rows[1][1] if i % 3 == 0 else v, l) for i, v, l in rows]  # a third are equal: ties
    rows += [(700, None, 1), (750, [None] * 13, 1), (None, rows[0][1], 1), (800, rows[0][1], None), (850, [float("nan")] * 13, 2), (900, [0.0] * 13, 0), (950, [0.1] * 12, 0)]
    expected = _plain([r for r in rows if r[0] != 950])  # another length takes no part
    assert expected and _mined(spark, rows, chunk=100, asked=4) == expected == _mined(spark, rows)


def test_repeated_ids_and_small_tables(spark):
    v, w = [0.5, 0.25], [0.25, 0.25]
    assert _mined(spark, []) == [] and _mined(spark, [(50, v, 1)]) == [] and _mined(spark, [(50, None, 1)]) == []
    assert _mined(spark, [(50, v, 1), (50, v, 1), (1, v, 1), (2, w, 2)]) == [(50, 1, 1, 2, 128 * 128 + 64 * 64, 128 * 64 + 64 * 64)]
    assert _mined(spark, [(50, [1e30, 1.0], 1), (1, v, 1), (2, w, 2)]) == []  # too large for a score
