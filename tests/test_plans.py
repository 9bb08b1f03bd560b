"""Block-wise scans, quantiles, chains and components against plain Python."""

import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from framesift.plans.blocks import index_block, number_block, text_block
from framesift.plans.chains import Spacing, last_kept
from framesift.plans.components import connected_components, join_one_per_key
from framesift.plans.ordered import BLOCK, blocked, ranked, scan
from framesift.plans.quantiles import exact_quantiles


def _rows(seed, n=100):
    rng = random.Random(seed)
    return [(k, i, rng.choice([None, 1.5 * i, -2.0 * i]), rng.randint(0, 9)) for k in "ab" for i in range(n)]


def test_scan_equals_python_loop(spark):
    rows = _rows(1)
    df = spark.createDataFrame(rows, "k string, i int, v double, w int")
    out = scan(
        df, ["k"], ["i"], index_block(F.col("i"), 7), index="idx", total="n", prev={"pv": F.col("v")}, next={"nv": F.col("v")},
        cumsum={"cs": F.col("w")}, cummax={"cm": F.col("v")}, whole={"all": F.col("w")},
    ).collect()
    for key in "ab":
        source = [r for r in rows if r[0] == key]
        got = sorted((r for r in out if r.k == key), key=lambda r: r.i)
        for n, r in enumerate(got):
            before = [x[2] for x in source[:n] if x[2] is not None]
            after = [x[2] for x in source[n + 1 :] if x[2] is not None]
            assert (r.idx, r.n, r.all) == (n, len(source), sum(x[3] for x in source))
            assert r.pv == (before[-1] if before else None)
            assert r.nv == (after[0] if after else None)
            assert r.cs == sum(x[3] for x in source[: n + 1])
            assert r.cm == (max(before) if before else None)


def test_blocks_are_monotone(spark):
    values = sorted(random.Random(3).uniform(-1e6, 1e6) for _ in range(500))
    df = spark.createDataFrame([(float(x),) for x in values], "v double")
    blocks = [r.b for r in df.select("v", number_block(F.col("v")).alias("b")).orderBy("v").collect()]
    assert blocks == sorted(blocks)
    names = sorted(["000001", "0001", "000999", "001000", "1000000", "", "9"])
    ids = spark.createDataFrame([(n,) for n in names], "v string").select("v", text_block(F.col("v")).alias("b")).orderBy("v").collect()
    assert [r.b for r in ids] == sorted(r.b for r in ids)


def test_exact_quantiles(spark):
    rows = _rows(5)
    df = spark.createDataFrame(rows, "k string, i int, v double, w int")
    for r in exact_quantiles(df, ["k"], "v", {"m": 0.5, "p": 0.95}, count="n").collect():
        values = [x[2] for x in rows if x[0] == r.k and x[2] is not None]
        assert r.n == len(values)
        assert abs(r.m - np.median(values)) < 1e-9 and abs(r.p - np.percentile(values, 95)) < 1e-9


def _chain(rows, keep):
    ref, out = None, []
    for row in rows:
        kept = keep(ref, (row[2],), ())
        out.append((None if ref is None else ref[0], kept))
        if kept:
            ref = (row[2],)
    return out


def test_chain_over_blocks(spark):
    rng = random.Random(7)
    for rule in ("near", "spaced"):
        if rule == "near":
            rows = [(k, i, float(rng.randint(0, 100))) for k in "ab" for i in range(200)]
            keep = lambda ref, row, _: ref is None or abs(row[0] - ref[0]) < 15
        else:  # equal spacing: two interleaved chains that never meet
            rows = [(k, i, float(i)) for k in "ab" for i in range(200)]
            keep = lambda ref, row, _: ref is None or row[0] - ref[0] >= 2
        df = spark.createDataFrame(rows, "k string, i long, v double")
        got = last_kept(df, ["k"], "i", index_block(F.col("i"), 17), ["v"], keep).collect()
        for key in "ab":
            mine = sorted((r for r in got if r.k == key), key=lambda r: r.i)
            want = _chain([r for r in rows if r[0] == key], keep)
            assert [(r.ref_v, r.kept) for r in mine] == want


def test_chains_that_never_meet_take_a_fixed_number_of_passes(spark):
    # nine interleaved chains, 15 blocks: more than the rounds that run blocks again
    rows = [("a", i, float(i)) for i in range(250)] + [("b", i, None if i % 50 else 1.0) for i in range(120)] + [("c", 0, 5.0)]
    df = spark.createDataFrame(rows, "k string, i long, v double")
    block = index_block(F.col("i"), 17)
    plain = lambda ref, row, _: row[0] is not None and (ref is None or row[0] - ref[0] >= 9)
    for keep in (plain, Spacing("v", 9.0)):
        got = last_kept(df, ["k"], "i", block, ["v"], keep).collect()
        assert len(got) == len(rows)
        for key in "abc":
            mine = sorted((r for r in got if r.k == key), key=lambda r: r.i)
            assert [(r.ref_v, r.kept) for r in mine] == _chain([r for r in rows if r[0] == key], plain)


def test_spacing_with_times_that_go_back(spark):
    rng = random.Random(13)
    rows = [(k, i, float(i * 3 + rng.randint(-20, 20))) for k in "ab" for i in range(300)]
    df = spark.createDataFrame(rows, "k string, i long, v double")
    got = last_kept(df, ["k"], "i", index_block(F.col("i"), 40), ["v"], Spacing("v", 10.0)).collect()
    for key in "ab":
        mine = sorted((r for r in got if r.k == key), key=lambda r: r.i)
        want = _chain([r for r in rows if r[0] == key], lambda ref, row, _: ref is None or row[0] - ref[0] >= 10)
        assert [(r.ref_v, r.kept) for r in mine] == want


def test_blocks_are_bounded_for_any_spelling(spark):
    ids = spark.range(5_000).select(F.lit("hot").alias("k"), F.format_string("frame_%06d", F.col("id")).alias("f"), F.col("id").alias("n"))
    placed = blocked(ids, ["k"], ["f"], bits=6)
    assert placed.groupBy("k", BLOCK).count().agg(F.max("count")).first()[0] <= 64
    out = scan(placed, ["k"], ["f"], index="i", prev={"before": F.col("n")}, total="all").collect()
    assert all(r.i == r.n and r["all"] == 5_000 and r.before == (r.n - 1 if r.n else None) for r in out) and len(out) == 5_000


def test_ranks_over_the_whole_table(spark):
    names = [f"n{random.Random(i).randint(0, 500):03d}" for i in range(2_000)]
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "n string, i int").repartition(5)
    out = ranked(df, ["n", "i"], "r", "all").collect()
    want = {key: place for place, key in enumerate(sorted((n, i) for i, n in enumerate(names)))}
    assert {(x.n, x.i): x.r for x in out} == want and {x["all"] for x in out} == {2_000}
    assert "Window" not in ranked(df, ["n", "i"], "r")._jdf.queryExecution().optimizedPlan().toString()
    assert ranked(df.limit(0), ["n"], "r", "all").count() == 0


def test_components(spark):
    edges = [(f"n{i}", f"x{i // 3}") for i in range(300)] + [(f"n{i}", f"y{(i + 1) // 3}") for i in range(300) if i % 17] + [("lone", None)]
    edges += [(f"h{i}", "hot") for i in range(200)]
    random.Random(2).shuffle(edges)
    table = spark.createDataFrame(edges, "n string, x string")
    found = connected_components(table, "n", "x").collect()
    parent = {}

    def root(a):
        parent.setdefault(a, a)
        while parent[a] != a:
            a = parent[a]
        return a

    for n, x in edges:
        root(n)
        if x:
            parent[root(n)] = root(x)
    mine, theirs = defaultdict(set), defaultdict(set)
    for r in found:
        mine[r.component].add(r.n)
        theirs[root(r.n)].add(r.n)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))
    apart = connected_components(table, "n", "x", floor=50).collect()  # hot keys are split off
    assert sorted(map(tuple, apart)) == sorted(map(tuple, found))


def test_giant_component(spark):
    chain = spark.range(3_000).select(F.col("id").cast("string").alias("n"), F.explode(F.array(F.col("id").cast("string"), (F.col("id") + 1).cast("string"))).alias("x"))
    star = spark.range(5_000).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("n"), F.lit("0").alias("x"))
    found = connected_components(chain.unionByName(star), "n", "x", floor=500)
    assert found.count() == 8_000 and found.select("component").distinct().count() == 1


def test_hot_key_join_keeps_every_row(spark):
    left = spark.createDataFrame([("hot", i) for i in range(500)] + [(f"k{i}", i) for i in range(50)], "k string, i int")
    right = spark.createDataFrame([("hot", "H")] + [(f"k{i}", str(i)) for i in range(0, 50, 2)], "k string, v string")
    joined = join_one_per_key(left, right, "k", 550, floor=100)
    assert sorted(map(tuple, joined.select("k", "i", "v").collect())) == sorted(map(tuple, left.join(right, "k").select("k", "i", "v").collect()))
