"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Only DataFrame functions are used.  Every source gets a target in words: a share of
the total by weight, no more than ``MOST_REPEATS`` times its own size, what is over going
to the other sources by weight.  A source's documents are put in a random order and laid
end to end, as often as needed; the stretch up to the target is its quota, cut into
blocks of words.  Where a document lies across the target, the words up to it are filled by the
smallest documents that fit, so a source misses its target by no more than half of the
smallest document that it leaves out (or, with none left out, of the last one it takes).  The tree starts with all blocks at its root and splits them in
halves: how many blocks of each source go left is drawn from the multivariate
hypergeometric distribution, one source after the other.  Its leaves are the output
shards; each takes the next blocks of a source's permuted sequence, so blocks are disjoint
and every source's blocks are used up exactly.  Rows of a shard then get a local order.

All draws come from hashes of the seed, so reruns agree, also after a lost executor.
Running sums over a source are made per hash range first, so a source of any size is
spread over tasks.  What lies in one row or one task is one number per source and shard.

Defined cases: a null text has size 0; documents of size 0 are taken with the stretch
that they lie in; null is a source of its own, last in order; a source of size 0 has
target 0; rows without an id and repeated rows are mixed as rows of their own; an empty
table gives an empty mix; other columns pass through, but a given column that has the name of
an added one gives way to it.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeflow.scratch import staged

SEED = 20240229
SHARE = 1.5
MOST_REPEATS = 2
WEIGHTS = (3.0, 1.0, 2.0)
LEVELS = 4
BLOCK_SHARE = 256
RANGES = 256

_WORD = r"[^\x20\x09-\x0D]+"
_NEW = ("size", "source_size", "target", "draws")
_MIXED = ("shard", "copy", "mix_block", "_local_order")


def _uniform(*parts) -> Column:
    """A number in [0, 1) from a hash."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *parts), 11)
    return bits.cast("double") / F.lit(float(1 << 53))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value reckoned once, and once only in the plan."""
    return F.transform(F.array(value), use)[0]


def _hypergeometric(good: Column, pool: Column, drawn: Column, u: Column) -> Column:
    """The number of good ones among ``drawn`` of ``pool``, by inversion at ``u``.

    The distribution is summed by its ratio of neighbours over 12 standard deviations
    around the mean, beyond which a double holds nothing of it.
    """
    names = ("good", "pool", "drawn", "u")
    known = F.struct(*[c.cast("double").alias(n) for n, c in zip(names, (good, pool, drawn, u), strict=True)])

    def add(name: str, number) -> None:
        nonlocal known
        known = _let(known, lambda g: g.withField(name, number(g)))

    add("share", lambda g: F.when(g.pool > 0, g.good / g.pool).otherwise(0.0))
    add("mean", lambda g: g.drawn * g.share)
    add("spread", lambda g: F.sqrt(F.greatest(F.lit(0.0), g["mean"] * (1 - g.share) * (g.pool - g.drawn) / F.greatest(g.pool - 1, F.lit(1.0)))))
    add("low", lambda g: F.greatest(F.lit(0.0), g.drawn - (g.pool - g.good), F.floor(g["mean"] - 12 * g.spread - 1).cast("double")))
    add("high", lambda g: F.greatest(g.low, F.least(g.good, g.drawn, F.ceil(g["mean"] + 12 * g.spread + 1).cast("double"))))
    add("steps", lambda g: F.sequence(g.low.cast("long"), g.high.cast("long")))

    def onward(g: Column, k: Column, weight: Column) -> Column:
        return weight * (g.good - k) * (g.drawn - k) / ((k + 1) * (g.pool - g.good - g.drawn + k + 1))

    add(
        "total",
        lambda g: F.aggregate(
            g.steps,
            F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum")),
            lambda s, k: F.struct(onward(g, k, s.w).alias("w"), (s.sum + s.w).alias("sum")),
            lambda s: s.sum,
        ),
    )

    def picked(g: Column) -> Column:
        return F.aggregate(
            g.steps,
            F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"), g.low.cast("long").alias("at")),
            lambda s, k: F.struct(
                onward(g, k, s.w).alias("w"),
                (s.sum + s.w).alias("sum"),
                F.when(s.sum <= g.u * g.total, k).otherwise(s.at).alias("at"),
            ),
            lambda s: s.at,
        )

    return _let(known, lambda g: F.when(g.high <= g.low, g.low.cast("long")).otherwise(picked(g)))


def _seeded(level: int, q: Column) -> Column:
    return q.withField("u", _uniform(F.lit(level), F.col("node"), q.source_key))


def split_tree(quotas: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(source_key, ends): the running number of blocks up to each of the 2**levels shards.

    ``quotas`` holds (source_key, blocks).  All nodes of a level are split at once, each
    in one row that has a number per source.
    """
    pair = F.struct("source_key", F.col("blocks").cast("long").alias("blocks"))
    nodes = quotas.agg(F.array_sort(F.collect_list(pair)).alias("quota")).select(F.lit(0).cast("long").alias("node"), "quota")
    for level in range(levels):
        total = F.aggregate("quota", F.lit(0).cast("long"), lambda s, q: s + q.blocks)
        node = F.col("node")

        def draw(state: Column, q: Column) -> Column:
            return _let(
                _hypergeometric(q.blocks, state.pool, state.want, q.u),
                lambda left: F.struct(
                    (state.pool - q.blocks).alias("pool"),
                    (state.want - left).alias("want"),
                    F.concat(state.left, F.array(left)).alias("left"),
                ),
            )

        seeded = F.transform("quota", partial(_seeded, level))
        start = F.struct(
            total.alias("pool"), F.floor((total + node % 2) / 2).cast("long").alias("want"), F.lit([]).cast("array<bigint>").alias("left")
        )
        drawn = nodes.withColumn("left", F.aggregate(seeded, start, draw, lambda s: s.left))
        to_left = F.zip_with("quota", "left", lambda q, n: F.struct(q.source_key.alias("source_key"), n.alias("blocks")))
        to_right = F.zip_with(
            "quota", "left", lambda q, n: F.struct(q.source_key.alias("source_key"), (q.blocks - n).alias("blocks"))
        )
        sides = [
            F.struct((node * 2 + side).alias("node"), half.alias("quota")) for side, half in enumerate((to_left, to_right))
        ]
        nodes = drawn.select(F.explode(F.array(*sides)).alias("half")).select("half.*")
    shares = nodes.select(F.col("node").alias("shard"), F.explode("quota").alias("q")).select("shard", "q.*")
    end = F.sum("blocks").over(Window.partitionBy("source_key").orderBy("shard"))
    placed = shares.select("source_key", F.struct("shard", end.alias("end")).alias("place"))
    whole = placed.groupBy("source_key").agg(F.array_sort(F.collect_list("place")).alias("places"))
    return whole.select("source_key", F.col("places.end").alias("ends"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """(source_key, source_size, target) from (source_key, source_size).

    Sources that stop at their cap are those with the least cap per weight: after
    sorting by it, the level for the rest follows from two running sums.
    """
    given = F.array(*[F.lit(float(w)) for w in weights])
    number = F.row_number().over(Window.orderBy("source_key"))
    size = F.col("source_size").cast("double")
    cap = MOST_REPEATS * size
    ranked = sizes.withColumn("weight", F.element_at(given, ((number - 1) % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("cap", cap).withColumn("full_at", F.col("cap") / F.col("weight"))
    rest = Window.orderBy("full_at", "source_key").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = Window.orderBy("full_at", "source_key").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum(size).over(everything) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = left / F.sum("weight").over(rest)
    # the first source that its level does not fill sets the level of all from there on
    final = F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "source_key", "level"))).over(everything)
    leveled = ranked.withColumn("level", level).withColumn("final", final["level"])
    target = F.least(F.col("cap"), F.coalesce(F.col("final"), F.lit(float("inf"))) * F.col("weight"))
    return leveled.select("source_key", "source_size", target.alias("target"))


def _up_to(number: Column, end: Column) -> Column:
    return end <= number


def _taken(docs: DataFrame, weights, share, levels, source: str, text: str, keep_text: bool) -> tuple[DataFrame, DataFrame]:
    """(given, row_id): the documents' columns as a struct; (row_id, size, source_size, target,
    draws): what the mix takes of each.  Sizes are counted once, all else reads the narrow rows."""
    key = F.struct(F.col(source).isNull().alias("absent"), F.col(source).alias("name"))
    size = F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")
    order = F.xxhash64(F.lit(SEED), *[F.col(c) for c, kind in docs.dtypes if kind != "void" and "map<" not in kind])
    # the key as text: a null source sorts last and joins as any other
    name = F.when(key["absent"], F.lit("n")).otherwise(F.concat(F.lit("a"), key["name"].cast("string")))
    rows = staged(
        docs.select(
            F.struct(*[F.col(c) for c in docs.columns if keep_text or c != text]).alias("given"),
            F.monotonically_increasing_id().alias("row_id"),
            name.alias("source_key"),
            size.alias("size"),
            order.alias("place"),
            F.pmod(F.shiftright(order, 40), F.lit(RANGES)).alias("part"),
        ),
        "mix-rows",
    )
    narrow = rows.drop("given")

    # small tables are written too: what is used in several places would be planned in each, in the driver
    parts = staged(narrow.groupBy("source_key", "part").agg(F.sum("size").alias("part_size")), "mix-parts")
    by_source = Window.partitionBy("source_key").orderBy("part")
    earlier = by_source.rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("part_size").over(earlier), F.lit(0))
    goals = targets(parts.groupBy("source_key").agg(F.sum("part_size").alias("source_size")), weights, share)
    block = F.greatest(F.lit(1), F.ceil(F.col("source_size") / BLOCK_SHARE)).cast("long")
    goals = goals.withColumn("block", block).withColumn("blocks", F.ceil(F.col("target") / F.col("block")).cast("long"))
    goals = staged(goals, "mix-goals")
    goals = goals.join(split_tree(goals.select("source_key", "blocks"), levels), "source_key")
    # one row per source and range: it also spreads what is known of a source over its ranges
    starts = staged(parts.select("source_key", "part", before.alias("before")).join(goals, "source_key"), "mix-quotas")
    ranges = starts.select("source_key", "part")

    # equal rows have the same place and are told apart by their number
    within = Window.partitionBy("source_key", "part").orderBy("place", "row_id")
    in_part = F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1))
    laid = narrow.withColumn("in_part", F.coalesce(in_part, F.lit(0))).join(starts, ["source_key", "part"])
    laid = laid.withColumn("first", F.col("before") + F.col("in_part")).drop("before", "in_part")
    ends = [F.col("first") + copy * F.col("source_size") + F.col("size") for copy in range(MOST_REPEATS)]
    whole = [(end <= F.col("target")) & (F.col("target") > 0) for end in ends]
    reached = F.greatest(*[F.when(full, end) for full, end in zip(whole, ends, strict=True)], F.lit(0))
    rounds = F.aggregate(F.array(*whole), F.lit(0), lambda n, full: n + full.cast("int"))
    laid = staged(laid.withColumn("rounds", rounds).withColumn("reached", reached), "mix-laid")

    # what the cut leaves open is filled by the smallest rows: first those that fit and are not
    # taken yet, then those taken fewer times, then one that reaches nearer than none
    gaps = laid.groupBy("source_key").agg((F.max("target") - F.max("reached")).alias("gap")).filter("gap > 0")
    gaps = staged(ranges.join(gaps, "source_key"), "mix-gaps")
    kind = F.struct((F.col("size") > F.col("gap")).alias("over"), "rounds", "size")
    able = laid.join(gaps, ["source_key", "part"]).filter(f"rounds < {MOST_REPEATS} AND size > 0 AND size < 2 * gap")
    able = able.select("row_id", "source_key", "part", "place", "gap", kind.alias("kind"))
    kinds = able.groupBy("source_key", "kind").agg(F.count("*").alias("n"), F.first("gap").alias("gap"))
    words = F.col("n") * F.col("kind.size")
    filled = F.sum(words).over(Window.partitionBy("source_key").orderBy("kind"))
    kinds = kinds.withColumn("rest", F.col("gap") - filled + words)
    some = F.round(F.col("rest") / F.col("kind.size")).cast("long")
    cuts = kinds.filter(words > F.col("rest")).groupBy("source_key").agg(F.min(F.struct("kind", some.alias("some"))).alias("cut"))
    able = able.join(staged(ranges.join(cuts, "source_key"), "mix-cuts"), ["source_key", "part"], "left")
    at_cut = able.filter("kind = cut.kind AND cut.some > 0")
    counts = at_cut.groupBy("source_key", "part").agg(F.count("*").alias("n"))
    counts = counts.select("source_key", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_before"))
    at_cut = at_cut.withColumn("number", F.row_number().over(within)).join(counts, ["source_key", "part"])
    fills = able.filter("cut IS NULL OR kind < cut.kind").select("row_id")
    fills = fills.unionByName(at_cut.filter("n_before + number <= cut.some").select("row_id"))
    # no more rows of a source than words in one of its documents
    fills = staged(fills.withColumn("fills", F.lit(True)), "mix-fills")

    also = F.coalesce(F.col("fills"), F.lit(False))
    copies = []
    for copy in range(MOST_REPEATS):
        start = F.col("first") + copy * F.col("source_size")
        number = F.least(F.floor(start / F.col("block")).cast("long"), F.col("blocks") - 1)
        shard = F.size(F.filter("ends", partial(_up_to, number)))
        local = F.xxhash64(F.lit(SEED), F.lit(copy), F.col("place"))
        draw = F.struct(F.lit(copy).alias("copy"), number.alias("block"), shard.alias("shard"), local.alias("local_order"))
        copies.append(F.when((F.col("rounds") > copy) | also & (F.col("rounds") == copy), draw))
    draws = F.filter(F.array(*copies), lambda d: d.isNotNull())
    drawn = laid.join(fills, "row_id", "left").select("row_id", "size", "source_size", "target", draws.alias("draws"))
    return rows.select("given", "row_id"), drawn


def _beside(docs: DataFrame, added: tuple[str, ...], text: str | None = None) -> list[Column]:
    """The given columns but those that have the name of an added one, and ``text``."""
    taken = {a.lower() for a in added}
    return [F.col("given")[c].alias(c) for c in docs.columns if c.lower() not in taken and c != text]


def plan(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    levels: int = LEVELS,
    source: str = "source",
    text: str = "text",
    keep_text: bool = True,
) -> DataFrame:
    """``docs`` with size, source_size, target and ``draws``: the copies of the document
    that the mix takes, each with block, shard and local order."""
    rows, drawn = _taken(docs, weights, share, levels, source, text, keep_text)
    return rows.join(drawn, "row_id").select(*_beside(docs, _NEW, None if keep_text else text), *_NEW)


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    levels: int = LEVELS,
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """The mix: a row per taken copy with ``shard``, ``copy`` and ``mix_block``, each shard's
    rows shuffled.  Shards are sorted in ranges of their local order, so a shard of any
    size is spread over tasks."""
    rows, drawn = _taken(docs, weights, share, levels, source, text, True)
    rows = rows.join(drawn.select("row_id", F.explode("draws").alias("draw")), "row_id").select(
        *_beside(docs, _MIXED),
        F.col("draw.shard").alias("shard"),
        F.col("draw.copy").alias("copy"),
        F.col("draw.block").alias("mix_block"),
        F.col("draw.local_order").alias("_local_order"),
    )
    return rows.repartitionByRange("shard", "_local_order").sortWithinPartitions("shard", "_local_order").drop("_local_order")


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    planned = plan(docs, keep_text=False)
    return planned.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("draws")).cast("long").alias("taken"))
