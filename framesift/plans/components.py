"""Connected components of a node-identifier table.

Nodes that share an identifier belong together.  Nodes and shared identifiers are numbered first, so only that
step moves texts; identifiers of one node link nothing and are left out.  Each round every identifier
picks its node of highest priority (a number that changes per round, so long
chains break up), every node moves to the best pick of its identifiers, and the
table is rewritten in terms of the picks.  Identifiers left with one node
are dropped.  The table shrinks by a constant factor per round in expectation,
so the number of rounds is logarithmic; both the picks and the moves are plain
map-side combined aggregates of numbers, and no pair of nodes is ever listed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import cut

HOT_SHARE = 1000  # a key with more than 1/1000 of the rows is joined by broadcast


def join_one_per_key(left: DataFrame, right: DataFrame, key: str, rows: int, floor: int = 1_000_000, size: str | None = None) -> DataFrame:
    """Inner join to a table with one row per key, safe for hot keys of ``left``.

    Keys that hold more than ``max(floor, rows / 1000)`` rows cannot number more
    than 1,000, so exactly those are broadcast; the rest is shuffled as usual.
    ``size`` names a column of ``right`` that holds the rows of the key in ``left``; without it they are counted.
    """
    limit = max(floor, rows // HOT_SHARE)
    if rows <= limit:
        return left.join(right.drop(size) if size else right, key)
    if size:
        hot = right.where(F.col(size) > limit).drop(size)
        light = left.join(F.broadcast(hot.select(key)), key, "left_anti").join(right.where(F.col(size) <= limit).drop(size), key)
        return light.unionByName(left.join(F.broadcast(hot), key))
    hot = left.groupBy(key).count().where(F.col("count") > limit).select(key, F.lit(True).alias("_hot"))
    tagged = left.join(F.broadcast(hot), key, "left")
    hot_right = right.join(F.broadcast(hot.select(key)), key, "left_semi")
    light = tagged.where(F.col("_hot").isNull()).drop("_hot").join(right, key)
    heavy = tagged.where(F.col("_hot")).drop("_hot").join(F.broadcast(hot_right), key)
    return light.unionByName(heavy)


def component_numbers(edges: DataFrame, node: str, identifier: str, floor: int = 1_000_000) -> DataFrame:
    """``(node, round, number)``: nodes of one component have the same round and number.

    ``edges`` holds rows (node, identifier), repeated or not; rows with a null identifier only declare the node.
    ``floor`` is the number of rows from which a key may count as hot.

    A round renames its nodes by ``xxhash64``, which maps long numbers one to one (its steps are additions and products
    by odd numbers, rotations and shifted ors), so the largest name is the pick itself.  The moves of every round are
    stored.  Rows are never joined to the label of a growing component while the table contracts: at the end the
    moves are resolved from the last round back to the first, each over the nodes that were left in its round.
    A component is known by the round that ended it and the name of its last node there.
    """
    declared = cut(edges.select(F.col(node).alias("node"), F.col(identifier).alias("ident")))
    number = F.monotonically_increasing_id().alias("id")
    count = F.count(F.lit(1)).alias("rows")
    nodes = cut(declared.groupBy("node").agg(F.count("ident").alias("rows")).select("node", "rows", number))
    shared = declared.where("ident is not null").groupBy("ident").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), count)
    shared = cut(shared.where("lo <> hi").select("ident", "rows", number))
    rows = declared.count()
    linked = join_one_per_key(declared, shared.withColumnRenamed("id", "i"), "ident", rows, floor, "rows").drop("ident")
    named = nodes.withColumnRenamed("id", "n")
    current = cut(join_one_per_key(linked, named, "node", rows, floor, "rows").select(F.col("n").alias("node"), F.col("i").alias("ident")))
    rounds: list[DataFrame] = []
    while True:
        rows = current.count()
        name = F.xxhash64("node", F.lit(len(rounds) + 1))
        picks = current.groupBy("ident").agg(F.max(name).alias("pick"), F.min(name).alias("least"), count)
        picks = cut(picks.where("pick <> least").select("ident", "pick", "rows"))
        linked = cut(join_one_per_key(current, picks, "ident", rows, floor, "rows"))
        moves = cut(linked.groupBy("node").agg(F.max("pick").alias("to"), count))
        if moves.isEmpty():  # some node moves whenever an identifier has two nodes, so this comes
            break
        rounds.append(moves.drop("rows"))
        current = cut(join_one_per_key(linked.drop("pick"), moves, "node", rows, floor, "rows").select(F.col("to").alias("node"), "ident").distinct())
    final = None  # (to, round, number): where the nodes left after a round end up
    for at in range(len(rounds), 0, -1):
        moves = rounds[at - 1]
        here = [F.lit(at).alias("round"), F.col("to").alias("number")]
        if final is not None:
            ended = join_one_per_key(moves, final, "to", moves.count(), floor).select("node", "round", "number")
            stayed = moves.join(final.select("to"), "to", "left_anti").select("node", *here)
            moves = ended.unionByName(stayed)
        else:
            moves = moves.select("node", *here)
        final = cut(moves).withColumnRenamed("node", "to")
    if final is None:
        return nodes.select(F.col("node").alias(node), F.lit(0).alias("round"), F.col("id").alias("number"))
    found = nodes.join(final.withColumnRenamed("to", "id"), "id", "left")
    return found.select(F.col("node").alias(node), F.coalesce("round", F.lit(0)).alias("round"), F.coalesce("number", "id").alias("number"))


def connected_components(edges: DataFrame, node: str, identifier: str, floor: int = 1_000_000) -> DataFrame:
    """``(node, component)``; the component is named by its smallest node."""
    found = cut(component_numbers(edges, node, identifier, floor))
    key = ["round", "number"]
    members = found.groupBy(*key).agg(F.min(node).alias("component"), F.count(F.lit(1)).alias("n"))
    alone = members.where("n = 1").select("component")
    several = found.join(members.where("n > 1").drop("n"), key).select(node, "component")
    return several.unionByName(alone.select(F.col("component").alias(node), "component"))
