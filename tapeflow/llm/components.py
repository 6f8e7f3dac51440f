"""Connected components of an edge table, in rounds of joins and grouping."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeflow.scratch import staged

MAX_ROUNDS = 60
_BIT_WORDS = 1 << 21


def components(edges: DataFrame, small: str = "a", large: str = "b") -> DataFrame:
    """(node, component) for every node of an edge; the component is its smallest node.

    Each round links every neighbour of a node to the smallest one (the larger neighbours,
    then the smaller ones), which turns every component into a star in about log(n) rounds.
    Each round is written to the shared folder, so a lost executor costs one round.
    Edges may repeat, point either way or join a node to itself; rows with a null end are
    left out.
    """
    a, b = F.col(small), F.col(large)
    current = staged(
        edges.filter(a.isNotNull() & b.isNotNull() & (a != b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "edges",
    )
    for _ in range(MAX_ROUNDS):
        both = current.union(current.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        outward = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        step = staged(outward.distinct(), "stars")
        # the smaller neighbours of a node all move to the smallest of them
        lowest = step.groupBy("u").agg(F.min("v").alias("m"))
        inward = step.join(lowest, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = staged(
            inward.union(lowest.select("u", F.col("m").alias("v"))).distinct(), "stars"
        )
        if not _differ(current, after):
            break
        current = after
    else:
        raise RuntimeError("components did not settle")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return roots.union(current.select("u", "v")).distinct()


def pair_groups(members: DataFrame, keys: list[str], weight: str, most: int) -> DataFrame:
    """``members`` with ``groups``: where a row goes so that any two rows of equal ``keys``
    meet in one group of bounded weight.

    Rows whose weights add up to no more than ``most`` meet in one group.  Others are dealt
    into chunks by a hash of ``node``, and a group holds two chunks; a row goes to one group
    per chunk.  A group is a struct (first, second) of chunk numbers; ``chunk`` is the row's own.
    """
    totals = members.groupBy(*keys).agg(F.sum(weight).alias("total"))
    dealt = members.join(totals, keys)
    n = F.greatest(F.lit(1), F.ceil(2 * F.col("total") / most)).cast("int")
    n = F.when(F.col("total") <= most, F.lit(1)).otherwise(n)
    chunk = F.pmod(F.xxhash64(F.lit(5), "node"), n).cast("int")
    with_chunk = dealt.withColumn("chunk", chunk).withColumn("n", n)
    groups = F.transform(
        F.sequence(F.lit(0), F.col("n") - 1),
        lambda j: F.struct(F.least("chunk", j).alias("first"), F.greatest("chunk", j).alias("second")),
    )
    return with_chunk.withColumn("groups", groups).drop("total", "n")


def bitmap(nodes: DataFrame) -> np.ndarray:
    """A bit map that holds every node of a table, and others by chance: a number per
    ``_BIT_WORDS`` at most, so its size does not grow with the table."""
    place = F.pmod(F.shiftright("node", 6), F.lit(_BIT_WORDS))
    bit = F.expr("shiftleft(1L, cast(node & 63 as int))")
    table = nodes.groupBy(place.alias("place")).agg(F.bit_or(bit).alias("bits")).toArrow()
    bits = np.zeros(_BIT_WORDS, np.int64)
    bits[table.column("place").to_numpy()] = table.column("bits").to_numpy()
    return bits.view(np.uint64)


def marked(bits: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Which nodes, or others by chance, a bit map holds."""
    word = bits[(node >> 6) & (_BIT_WORDS - 1)]
    return (word >> (node & 63).astype(np.uint64)) & np.uint64(1) == 1


def _differ(one: DataFrame, other: DataFrame) -> bool:
    """Whether two edge sets differ, by their sizes and a sum of hashes."""
    digest = [F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))]
    return one.agg(*digest).first() != other.agg(*digest).first()
