"""Merkle manifest of a dataset: every row's proof that it belongs under one root.

A row's leaf is the digest of its fields.  The leaves of a tree are numbered in order and
every ``FANOUT`` consecutive ones get a parent, until one node is left.  A level is one
grouping by (tree, number div fanout): conditional aggregates spread the children of a parent
into a column for each slot; the columns concatenated, hashed, are the parent, and the columns
without a child's own one are its siblings.  The trees' last nodes, in the order of
their names, are the leaves of one more tree, whose last node is the root.

Paths go down the same tables: a parent hands its children its own path behind their
siblings.  A level is joined with the one above only, so all levels together touch half as many
rows again as there are leaves, and the leaves get their paths without a shuffle of their own.
Numbers come from ranges: a range keeps its rows in order and is counted, and where it starts
in its tree is added, so a tree of any size is spread over tasks.

Only DataFrame functions are used.  Levels are written to the shared folder as they are made.

Defined cases: a null field counts as ``-``; a null tree is a tree of its own, first in
order; rows with a null key come first in their tree; rows of equal keys are ordered by their
leaf, so equal rows are leaves of their own next to each other; a tree of one leaf has it as its
last node; an empty table has no rows and no root; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeflow.scratch import staged

FANOUT = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field_text(field: Column) -> Column:
    """A field so that no two lists of fields have the same text: its bytes' number, then it."""
    text = field.cast("string")
    sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(sized, F.lit("-"))


def leaf_of(*fields: Column) -> Column:
    return F.sha2(F.concat(*[field_text(f) for f in fields]), 256)


def numbered(rows: DataFrame, tree: str, *order: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``place`` (from 0, in ``order``) and ``leaves`` of their tree; and the
    table (tree, leaves).

    ``tree`` is not null.  Rows that ``order`` leaves equal must be equal.
    """
    ranges = rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    ranges = ranges.withColumns({"part": F.spark_partition_id(), "seat": F.monotonically_increasing_id()})
    ranges = staged(ranges, "merkle-leaves")
    counts = ranges.groupBy(tree, "part").agg(F.min("seat").alias("first"), F.count("*").alias("held"))
    earlier = Window.partitionBy(tree).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("held").over(earlier), F.lit(0))
    sizes = counts.groupBy(tree).agg(F.sum("held").alias("leaves"))
    starts = counts.select(tree, "part", (start - F.col("first")).alias("start")).join(sizes, tree)
    placed = ranges.join(starts, [tree, "part"]).withColumn("place", F.col("seat") + F.col("start"))
    return placed.drop("part", "seat", "start", "first"), sizes


def _height(leaves: Column, levels: int, fanout: int) -> Column:
    """Levels between a tree's leaves and its last node."""
    return sum(((leaves > F.lit(fanout**k)).cast("int") for k in range(levels)), F.lit(0))


def levels_of(placed: DataFrame, sizes: DataFrame, tree: str, leaf: str, carry: tuple[str, ...], fanout: int) -> list[DataFrame]:
    """One table a level: (tree, place, leaves, node) of the parents with ``slot0``, ``slot1``, ...

    Slots of the first level are structs of the child's ``node`` and the carried columns.
    """
    largest = sizes.agg(F.max("leaves")).first()[0] or 0
    child = placed.select(tree, "place", "leaves", F.struct(F.col(leaf).alias("node"), *carry).alias("child"))
    levels = []
    while fanout ** len(levels) < largest:
        slot = F.pmod(F.col("place"), F.lit(fanout))
        # a tree that is down to one node has its last
        open_nodes = child.filter(F.col("leaves") > F.lit(fanout ** len(levels)))
        spread = open_nodes.groupBy(tree, F.floor(F.col("place") / fanout).alias("place"), "leaves").agg(
            *[F.first(F.when(slot == i, F.col("child")), ignorenulls=True).alias(f"slot{i}") for i in range(fanout)]
        )
        hashes = [F.coalesce(F.col(f"slot{i}.node"), F.lit("")) for i in range(fanout)]
        levels.append(staged(spread.withColumn("node", F.sha2(F.concat(*hashes), 256)), "merkle-level"))
        child = levels[-1].select(tree, "place", "leaves", F.struct("node").alias("child"))
    return levels


def last_nodes(placed: DataFrame, levels: list[DataFrame], tree: str, leaf: str, fanout: int) -> DataFrame:
    """(tree, last) of every tree."""
    found = placed.filter("leaves = 1").select(tree, F.col(leaf).alias("last"))
    for k, level in enumerate(levels, 1):
        done = level.filter((F.col("leaves") <= F.lit(fanout**k)) & (F.col("leaves") > F.lit(fanout ** (k - 1))))
        found = found.union(done.select(tree, F.col("node").alias("last")))
    return found


def _children(level: DataFrame, tree: str, share: tuple[str, ...], fanout: int) -> DataFrame:
    """A row per child: (tree, place, child, path, ``share``), the path with its siblings first."""
    hashes = [F.coalesce(F.col(f"slot{i}.node"), F.lit("")) for i in range(fanout)]
    each = []
    for own in range(fanout):
        siblings = F.struct(
            F.concat(F.lit(""), *hashes[:own]).alias("before"), F.concat(F.lit(""), *hashes[own + 1 :]).alias("after")
        )
        moved = F.struct(
            (F.col("place") * fanout + own).alias("place"),
            F.col(f"slot{own}").alias("child"),
            F.concat(F.array(siblings), F.col("path")).alias("path"),
        )
        each.append(F.when(F.col(f"slot{own}").isNotNull(), moved))
    present = F.filter(F.array(*each), lambda c: c.isNotNull())
    return level.select(tree, *share, F.explode(present).alias("c")).select(tree, *share, "c.*")


def paths(
    placed: DataFrame, levels: list[DataFrame], tops: DataFrame, tree: str, leaf: str, carry: tuple[str, ...], fanout: int
) -> DataFrame:
    """(tree, leaf, carried columns, path, further columns of ``tops``) of every leaf.

    ``tops`` holds for each tree the ``leaves``, the ``path`` of its last node and what all of the
    tree's leaves get; that goes down with the paths, as a join by tree would put a large
    tree into one task.
    """
    depth = len(levels)
    share = tuple(c for c in tops.columns if c not in (tree, "leaves", "path"))
    tops = tops.withColumn("height", _height(F.col("leaves"), depth, fanout))
    above = None
    for k in range(depth, 0, -1):
        ends = tops.filter(F.col("height") == k).select(tree, F.lit(0).cast("long").alias("place"), "path", *share)
        known = ends if above is None else above.select(tree, "place", "path", *share).union(ends)
        above = _children(levels[k - 1].drop("node", "leaves").join(known, [tree, "place"]), tree, share, fanout)
    names = [tree, F.col("child.node").alias(leaf), *[F.col(f"child.{c}") for c in carry], "path", *share]
    lone = placed.filter("leaves = 1").select(tree, F.struct(F.col(leaf).alias("node"), *carry).alias("child"))
    lone = lone.join(tops.filter("height = 0").select(tree, "path", *share), tree).select(*names)
    return lone if above is None else above.select(*names).union(lone)


def manifest(
    rows: DataFrame, group: str, order: tuple[str, ...], leaf: str = "leaf", carry: tuple[str, ...] = (), fanout: int = FANOUT
) -> DataFrame:
    """The carried columns of every row with its leaf, ``subroot`` (the last node of the
    group's tree), ``root`` and ``path``: for each level from the leaf to the root the siblings
    ``before`` and ``after``, as joined digests.

    ``rows`` holds the group, the columns to order by and the leaf; none of the names
    ``tree``, ``place``, ``leaves``, ``node``, ``child``, ``path``.
    """
    # a name that orders null first and joins as any other
    name = F.when(F.col(group).isNull(), "").otherwise(F.concat(F.lit("a"), F.col(group).cast("string")))
    columns = dict.fromkeys([leaf, *order, *carry])
    placed, sizes = numbered(rows.select(name.alias("tree"), *columns), "tree", *order, leaf, *carry)
    levels = levels_of(placed, sizes, "tree", leaf, carry, fanout)
    subroots = last_nodes(placed, levels, "tree", leaf, fanout)

    whole = subroots.select(F.lit("").alias("whole"), "tree", F.col("last").alias("subroot"))
    tops_placed, tops_sizes = numbered(whole, "whole", "tree", "subroot")
    tops_levels = levels_of(tops_placed, tops_sizes, "whole", "subroot", ("tree",), fanout)
    root = last_nodes(tops_placed, tops_levels, "whole", "subroot", fanout)
    start = tops_sizes.select("whole", "leaves", F.array().cast("array<struct<before:string,after:string>>").alias("path"))
    tops = paths(tops_placed, tops_levels, start, "whole", "subroot", ("tree",), fanout)
    tops = tops.join(root.select("whole", F.col("last").alias("root")), "whole").drop("whole")
    tops = staged(tops.join(sizes, "tree"), "merkle-tops")

    return paths(placed, levels, tops, "tree", leaf, carry, fanout).drop("tree")


def proof(path: Column) -> Column:
    """The digest of all siblings of a path, level by level, left to right."""
    text = F.aggregate(path, F.lit(""), lambda s, p: F.concat(s, p.before, p.after))
    return F.sha2(text, 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf leads to along a path."""
    return F.aggregate(path, leaf, lambda h, p: F.sha2(F.concat(p.before, h, p.after), 256))


def op12_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*FIELDS)
    fields = {f: F.col(f) for f in FIELDS}
    tampered = fields | {"text": F.replace(F.col("text"), F.lit("\n"), F.lit(""))}
    chosen = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0
    leaves = docs.select(
        "doc_id",
        "source",
        leaf_of(*fields.values()).alias("leaf"),
        # where nothing is tampered with, the original leaf is claimed
        F.when(chosen & F.contains("text", F.lit("\n")), leaf_of(*tampered.values())).alias("claimed"),
    )
    rows = manifest(leaves, "source", ("doc_id",), carry=("doc_id", "claimed"))
    root = folded(F.coalesce("claimed", "leaf"), F.col("path"))
    rows = rows.withColumn("folded_root", root)
    return rows.select(
        "doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _sql(levels: int = 12, top_levels: int = 6) -> str:
    """The same in SQL, for up to 3**levels rows a source and 3**top_levels sources."""
    enc = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = lambda text: f"sha256({' || '.join(enc(c) for c in FIELDS[:4])} || {enc(text)})"
    crc = (
        "list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),"
        " lambda ch: ascii(ch)::BIGINT)), lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],"
        " lambda x, i: xor(x >> 1, (x & 1) * 3988292384)))"
    )
    parts = [
        # the last step of the checksum flips the lowest bit
        f"docs AS (SELECT *, {leaf('text')} AS leaf, CASE WHEN ({crc}) % 2 = 1 THEN {leaf("replace(text, chr(10), '')")}"
        f" ELSE {leaf('text')} END AS claimed FROM documents)",
        "a0 AS (SELECT coalesce('a' || source, '') AS tree, leaf AS h, doc_id, claimed, count(*) OVER (PARTITION BY source) AS n,"
        " row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM docs)",
    ]

    def climb(a: str, depth: int) -> None:
        for k in range(depth):
            parts.append(
                f"{a}g{k} AS (SELECT tree, place // 3 AS place, n, list(h ORDER BY place) AS hs FROM {a}{k} WHERE n > {3**k} GROUP BY ALL)"
            )
            parts.append(f"{a}{k + 1} AS (SELECT tree, place, n, sha256(array_to_string(hs, '')) AS h FROM {a}g{k})")
        last = " UNION ALL ".join(
            f"SELECT tree, h FROM {a}{k} WHERE n <= {3**k} AND n > {3 ** (k - 1) if k else 0}" for k in range(depth + 1)
        )
        parts.append(f"{a}_last AS ({last})")

    climb("a", levels)
    parts.append(
        "b0 AS (SELECT 'x' AS tree, tree AS name, h, count(*) OVER () AS n, row_number() OVER (ORDER BY tree) - 1 AS place FROM a_last)"
    )
    climb("b", top_levels)
    parts.append("up0 AS (SELECT a0.*, h AS leaf, claimed AS f, '' AS sib FROM a0)")

    def fold(source: str, a: str, k: int, name: str) -> None:
        own = f"CAST((s.place // {3**k}) % 3 AS INTEGER) + 1"
        before, after = f"array_to_string(g.hs[1:{own} - 1], '')", f"array_to_string(g.hs[{own} + 1:], '')"
        parts.append(
            f"{name} AS (SELECT s.* REPLACE (CASE WHEN g.hs IS NULL THEN f ELSE sha256({before} || f || {after}) END AS f,"
            f" CASE WHEN g.hs IS NULL THEN sib ELSE sib || {before} || {after} END AS sib)"
            f" FROM {source} s LEFT JOIN {a}g{k} g ON s.tree = g.tree AND s.place // {3 ** (k + 1)} = g.place)"
        )

    for k in range(levels):
        fold(f"up{k}", "a", k, f"up{k + 1}")
    parts.append(
        f"top0 AS (SELECT u.doc_id, u.leaf, u.f, u.sib, b0.tree, b0.place, b0.h AS subroot FROM up{levels} u JOIN b0 ON u.tree = b0.name)"
    )
    for k in range(top_levels):
        fold(f"top{k}", "b", k, f"top{k + 1}")
    return (
        "WITH " + ",\n".join(parts) + "\nSELECT doc_id, leaf, subroot, (SELECT h FROM b_last) AS root, sha256(sib) AS proof_sha256,"
        f" f AS folded_root, f = (SELECT h FROM b_last) AS verified FROM top{top_levels}"
    )


OP12_SQL = _sql()
