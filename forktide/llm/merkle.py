"""A Merkle manifest of a dataset: one tree per group, one tree over the groups' roots.

Every row is a leaf, the hash of its fields. The leaves of a group, in key order, are paired level by
level up to the group's subroot; the subroots, in order of the groups, are paired likewise up to the
root. A row's proof is the list of siblings on its way to the root.

Rows get their position by a range exchange on (group, key) and one offset per range. 1,024 consecutive
nodes make a superblock. Going up, each superblock is reduced to one node, tier by tier, so a tier has
a 1,024th of the nodes of the one below. Going down, each superblock is cogrouped with the
outer nodes it needs (the siblings above its own top): its levels are built once more, the local part of
every proof is joined to the outer part, and at the leaves the proofs are folded to the root. No task
sees more than one superblock and its one path, however large a group is.

Defined results: NULL is a group of its own, before the others, and a NULL field is written ``-``. Rows of
one group with equal keys (or NULL keys, which come first) are ordered by leaf; equal rows are equal
leaves, of which each has its own position and proof. A group of one row has that leaf as its
subroot. Texts of any length are hashed whole by the engine. An empty table gives no rows. Only the
key, the group and the hashed fields are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forktide.llm.common import stored

BITS = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

ALONE = ""  # a step of a path: no sibling; otherwise its side and its hash
LEFT, RIGHT = "<", ">"


def digest(*nodes: str) -> str:
    return sha256("".join(nodes).encode()).hexdigest()


def written(value: Column) -> Column:
    """A value as it is hashed: byte count and value, ``-`` for NULL."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[written(v) for v in values]).cast("binary"), 256)


def height(nodes: int) -> int:
    """Levels from so many nodes to one."""
    return (nodes - 1).bit_length()


def climb(nodes: list[str], levels: int) -> list[list[str]]:
    """All levels over consecutive nodes, which start at an even position on each level but the top."""
    out = [nodes]
    for _ in range(levels):
        below = out[-1]
        out.append([digest(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return out


def steps(levels: list[list[str]], at: int) -> Iterator[str]:
    """Siblings of node ``at`` of the lowest level, up to below the top."""
    for level in levels[:-1]:
        other = at ^ 1
        if other >= len(level):
            yield ALONE
        else:
            yield (LEFT if other < at else RIGHT) + level[other]
        at >>= 1


def fold(node: str, path: Sequence[str]) -> str:
    """The root that a node and its path lead to."""
    for step in path:
        if step == ALONE:
            node = digest(node)
        else:
            node = digest(step[1:], node) if step[0] == LEFT else digest(node, step[1:])
    return node


def siblings(path: Sequence[str]) -> list[str]:
    return [step[1:] for step in path if step != ALONE]


def numbered(spark: SparkSession, rows: DataFrame, order: Sequence[str], purpose: str) -> DataFrame:
    """Adds ``i``, the position from 0 within ``g``, and ``n``, the rows of ``g``.

    Sorted ranges of (g, order) are written with their place in the range; one row per range and
    group then carries the offsets. ``order`` has to tell apart rows of one group that are many.
    """
    placed = rows.repartitionByRange("g", *order).sortWithinPartitions("g", *order)
    placed = stored(spark, placed.withColumn("_at", F.monotonically_increasing_id()), purpose)
    placed = placed.withColumn("_part", F.shiftright("_at", 33))  # the id is the partition and the place in it
    runs = placed.groupBy("g", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # One row per range and group: few, however many rows a group has.
    before = F.coalesce(
        F.expr("sum(_n) over (partition by g order by _part rows between unbounded preceding and 1 preceding)"),
        F.lit(0),
    )
    offsets = runs.select("g", "_part", "_first", before.alias("_before"), F.expr("sum(_n) over (partition by g)").alias("n"))
    found = placed.join(offsets, ["g", "_part"]).withColumn("i", F.col("_at") - F.col("_first") + F.col("_before"))
    return found.drop("_at", "_part", "_first", "_before")


NODES = "g string, i bigint, n bigint, h string"
PATHS = "g string, i bigint, path string"


def _levels(block: pd.DataFrame, bits: int) -> list[list[str]]:
    """Levels of one superblock, sorted by ``i``: all of a small group, else those up to the next tier."""
    return climb(block["h"].tolist(), min(bits, height(int(block["n"].iloc[0]))))


def _blocked(nodes: DataFrame, bits: int) -> DataFrame:
    return nodes.withColumn("b", F.shiftright("i", bits))


def tiers(spark: SparkSession, nodes: DataFrame, bits: int, purpose: str) -> list[DataFrame]:
    """The nodes and all tiers above; a group ends with the tier in which it has one node."""

    def top(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("i")
        n = (int(block["n"].iloc[0]) + (1 << bits) - 1) >> bits
        return pd.DataFrame({"g": [key[0]], "i": [key[1]], "n": [n], "h": [_levels(block, bits)[-1][0]]})

    out, below = [nodes], nodes
    while True:
        above = _blocked(below.select("g", "i", "n", "h"), bits).groupBy("g", "b").applyInPandas(top, NODES)
        out.append(stored(spark, above, f"{purpose}_{len(out)}"))
        most = out[-1].agg(F.max("n")).first()[0]
        if most is None or most <= 1:
            return out
        below = out[-1].filter("n > 1")


def _paths_in(block: pd.DataFrame, outer: pd.DataFrame, bits: int) -> list[str]:
    """Written paths of a superblock's nodes, sorted by ``i``: the local part, then the outer one."""
    levels, rest = _levels(block, bits), outer["path"].iloc[0]
    return ["".join(f"{step};" for step in steps(levels, at)) + rest for at in range(len(block))]


def _split(path: str) -> list[str]:
    return path.split(";")[:-1]


def paths(spark: SparkSession, built: list[DataFrame], tops: DataFrame, bits: int, purpose: str) -> DataFrame:
    """Paths ``(g, i, path)`` of the nodes of tier 1; ``tops`` has those of each group's last node."""

    def descend(key: tuple, block: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("i")
        return pd.DataFrame({"g": key[0], "i": block["i"], "path": _paths_in(block, outer, bits)})

    def ended(tier: DataFrame) -> DataFrame:
        return tier.filter("n = 1").join(tops, "g").select("g", "i", "path")

    found = ended(built[-1])
    for k in range(len(built) - 2, 0, -1):
        nodes = _blocked(built[k].filter("n > 1"), bits).groupBy("g", "b")
        outer = found.withColumnRenamed("i", "b").groupBy("g", "b")
        below = nodes.cogroup(outer).applyInPandas(descend, PATHS)
        found = stored(spark, below.unionByName(ended(built[k])), f"{purpose}_{k}")
    return found


def manifest(
    docs: DataFrame,
    key: str = "doc_id",
    group: str = "lang",
    fields: Sequence[str] = FIELDS,
    tampered: dict[str, Column] | None = None,
    with_proof: bool = False,
    bits: int = BITS,
) -> DataFrame:
    """Per row: key, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root`` and ``verified``.

    ``tampered`` gives changed fields; the row's proof is then folded from the leaf they make, and it is
    verified if that leads to the root of the unchanged rows. ``with_proof`` adds the siblings,
    ``proof``, of which ``proof_sha256`` is the hash. A superblock has ``2 ** bits`` nodes.
    """
    spark, kind = docs.sparkSession, docs.schema[key].dataType.simpleString()
    own = leaf([F.col(f) for f in fields])
    seen = own if not tampered else leaf([tampered.get(f, F.col(f)) for f in fields])
    # Groups are never NULL here: the empty text comes first, others are led by a sign.
    name = F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit(""))
    rows = docs.select(name.alias("g"), F.col(key).alias("k"), own.alias("h"), seen.alias("seen"))
    rows = stored(spark, rows.withColumn("salt", F.monotonically_increasing_id()), "leaves")

    placed = numbered(spark, rows, ["k", "h", "salt"], "placed")
    trees = tiers(spark, placed, bits, "tier")
    ends = [t.filter("n = 1").select(F.col("g").alias("name"), "h") for t in trees[1:]]
    subs = reduce(DataFrame.unionByName, ends).withColumn("g", F.lit(""))
    subs = numbered(spark, subs, ["name"], "subroots")
    over = tiers(spark, subs, bits, "over")
    last = over[-1].first()
    root = "" if last is None else last["h"]

    def named(key: tuple, block: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("i")
        return pd.DataFrame({"g": block["name"], "path": _paths_in(block, outer, bits), "subroot": block["h"]})

    outer = paths(spark, over, over[-1].select("g", F.lit("").alias("path")), bits, "over_path")
    outer = outer.withColumnRenamed("i", "b").groupBy("g", "b")
    whole = _blocked(subs, bits).groupBy("g", "b").cogroup(outer)
    whole = stored(spark, whole.applyInPandas(named, "g string, path string, subroot string"), "tops")
    blocks = paths(spark, trees, whole.select("g", "path"), bits, "path").withColumnRenamed("i", "b")
    blocks = blocks.join(whole.select("g", "subroot"), "g")

    def finish(at: tuple, block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("i")
        levels, rest = _levels(block, bits), _split(above["path"].iloc[0])
        found = [[*steps(levels, place), *rest] for place in range(len(block))]
        folded = [fold(h, path) for h, path in zip(block["seen"], found)]
        proofs = [siblings(path) for path in found]
        return pd.DataFrame(
            {
                "k": block["k"],
                "leaf": block["h"],
                "subroot": above["subroot"].iloc[0],
                "root": root,
                "proof_sha256": [digest(*p) for p in proofs],
                "folded_root": folded,
                "verified": [f == root for f in folded],
                **({"proof": proofs} if with_proof else {}),
            }
        )

    result = (
        "k string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        + (", proof array<string>" if with_proof else "")
    )
    leaves = _blocked(placed.withColumn("k", F.col("k").cast("string")).drop("salt"), bits).groupBy("g", "b")
    done = leaves.cogroup(blocks.groupBy("g", "b")).applyInPandas(finish, result)
    return done.select(F.col("k").cast(kind).alias(key), *done.columns[1:])
