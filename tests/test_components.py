"""Numbered components, and scene paths resolved once per row."""

from pyspark.sql import functions as F

from framesift.functions.text import scene_identity
from framesift.plans.components import component_numbers, connected_components


def test_nodes_without_a_name_link_nothing(spark):
    rows = [(None, "x")] * 3 + [("a", "x"), ("b", "x"), ("b", "x"), ("c", "y"), (None, "y"), ("d", "y"), ("e", "z"), ("f", None)]
    table = spark.createDataFrame(rows, "n string, x string")
    found = {r.n: r.component for r in connected_components(table, "n", "x").collect()}
    assert found == {None: None, "a": "a", "b": "a", "c": "c", "d": "c", "e": "e", "f": "f"}
    numbers = {r.n: (r["round"], r.number) for r in component_numbers(table, "n", "x", floor=2).collect()}
    assert len(numbers) == 7 and len(set(numbers.values())) == 5
    assert numbers["a"] == numbers["b"] and numbers["c"] == numbers["d"]


def test_round_names_are_one_to_one(spark):
    ids = spark.range(200_000).unionByName(spark.range(1 << 33, (1 << 33) + 100_000))
    assert ids.select(F.xxhash64("id", F.lit(1))).distinct().count() == 300_000


def test_scene_paths_are_split_once(spark):
    same = scene_identity(F.col("p"), "/srv/kit", "/srv/kit/projects/lab")
    rows = spark.createDataFrame([(" /old/kit/data/s ",), ("/old/kit/data/x/../s",), ("/srv/kit/data/./s",), ("a//b",), ("",), (None,)], "p string").select(same.alias("s"))
    assert [r.s for r in rows.collect()] == ["/srv/kit/projects/lab/data/s", "/srv/kit/projects/lab/data/s", "/srv/kit/data/s", "a/b", "", None]
    assert rows._jdf.queryExecution().analyzed().toString().count("split(") <= 2
