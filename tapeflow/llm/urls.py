"""URL filters: dated list entries as validity intervals, joined as of each fetch time.

A list's history is a table of changes (list, pattern, changed_at, listed).  The changes
of one pattern on one list become intervals from one change to the next.  A pattern is a
host, which also covers its subdomains, or a host with the beginning of a path.  A capture
is compared with the patterns that its URL can match, by equality, and with the intervals
that hold its fetch time.  Intervals are cut into slices of time and joined on (pattern,
slice), so a host with a long history or very many captures is spread over keys; what is
left of skew is split by the join.

Defined cases: of several changes of a pattern on a list at one time the one that lists
it wins; a change without list, pattern or time is ignored, and a null ``listed`` means no
longer listed; a null or relative URL, and a null fetch time, match nothing; of the
active entries the longest pattern decides, then an allowing list, then the list's name;
repeated captures get the same answer; an empty table of changes leaves all without a
verdict; other columns pass through, but one that has the name of an added one gives way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeflow.llm.columns import beside

SLICE_DAYS = 28
_SLICE = SLICE_DAYS * 86400
_ADDED = ("url_host", "n_active", "lists", "pattern", "verdict")


def host_of(url: Column) -> Column:
    """The host in lower case, without user, port and final dot; null if there is none."""
    place = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    host = F.lower(F.regexp_replace(F.regexp_replace(place, r"^.*@", ""), r"(\.?:\d*|\.)$", ""))
    return F.when(host != "", host)


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)


def patterns_of(url: Column) -> Column:
    """All patterns that match a URL: its host and every parent, and the host with every
    beginning of its path that ends at a slash or the path's end."""
    labels = F.split(host_of(url), r"\.")
    parents = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), ".")
    )
    steps = F.filter(F.split(path_of(url), "/"), lambda s: s != "")
    paths = F.transform(
        F.filter(F.sequence(F.lit(0), F.size(steps)), lambda i: i > 0),
        lambda i: F.concat(host_of(url), F.lit("/"), F.array_join(F.slice(steps, 1, i), "/")),
    )
    return F.when(host_of(url).isNull(), F.array().cast("array<string>")).otherwise(F.concat(parents, paths))


def intervals(changes: DataFrame) -> DataFrame:
    """(list, pattern, action, valid_from, valid_until) in which a pattern is listed."""
    given = changes.filter("list IS NOT NULL AND pattern IS NOT NULL AND changed_at IS NOT NULL")
    at_once = given.groupBy("list", "pattern", "changed_at").agg(
        F.max(F.coalesce("listed", F.lit(False))).alias("listed"), F.min("action").alias("action")
    )
    order = Window.partitionBy("list", "pattern").orderBy("changed_at")
    until = F.lead("changed_at").over(order)
    return at_once.withColumn("valid_until", until).filter("listed").select(
        "list", "pattern", "action", F.col("changed_at").alias("valid_from"), "valid_until"
    )


def evaluate(captures: DataFrame, changes: DataFrame, url: str = "url", at: str = "fetched_at") -> DataFrame:
    """``captures`` with host, number of active entries, their lists, and who decides."""
    return beside(captures, lambda rows: _evaluate(rows, changes, url, at), ["u", "t"], _ADDED)


def _evaluate(captures: DataFrame, changes: DataFrame, url: str, at: str) -> DataFrame:
    seen = captures.select(F.col(url).alias("u"), F.col(at).alias("t")).filter("u IS NOT NULL AND t IS NOT NULL").distinct()
    slice_of = lambda time: F.floor(F.unix_seconds(time) / _SLICE)
    asked = seen.select("u", "t", F.explode(patterns_of(F.col("u"))).alias("pattern"), slice_of(F.col("t")).alias("slice"))

    valid = intervals(changes)
    last = F.greatest(seen.agg(F.max("t").alias("last")).select("last").scalar(), F.col("valid_from"))
    until = F.coalesce(F.col("valid_until"), last)
    cut = valid.withColumn("slice", F.explode(F.sequence(slice_of(F.col("valid_from")), slice_of(until))))

    active = asked.join(cut, ["pattern", "slice"]).filter(
        (F.col("t") >= F.col("valid_from")) & (F.col("valid_until").isNull() | (F.col("t") < F.col("valid_until")))
    )
    allows = (F.col("action") == "allow").cast("int")
    rank = F.struct(-F.length("pattern"), -allows, "list", "pattern", "action")
    found = active.groupBy("u", "t").agg(
        F.count("*").alias("n_active"), F.array_sort(F.collect_set("list")).alias("names"), F.min(rank).alias("first")
    )
    found = found.select(
        "u", "t", "n_active", F.array_join("names", ",").alias("lists"), "first.pattern", F.col("first.action").alias("verdict")
    )
    joined = captures.withColumn("url_host", host_of(F.col(url))).join(
        found, (F.col(url) == F.col("u")) & (F.col(at) == F.col("t")), "left"
    )
    return joined.select(
        *captures.columns,
        "url_host",
        F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"),
        F.coalesce("lists", F.lit("")).alias("lists"),
        "pattern",
        F.coalesce("verdict", F.lit("none")).alias("verdict"),
    )


def _number(text: Column, digits: int = 6) -> Column:
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def captures_of(pages: DataFrame) -> DataFrame:
    """The pages with fetch times over the year 2024, which their ids stand for."""
    second = F.pmod(F.col("page_id") * 7919 * 613, F.lit(366 * 86400))
    return pages.select("page_id", "url", F.timestamp_seconds(F.lit(1704067200) + second).alias("fetched_at"))


def changes_of(pages: DataFrame) -> DataFrame:
    """List histories over the hosts, their parents and first path steps that occur in pages.

    By a hash of its name a pattern is on up to three lists, added, removed and added again.
    """
    patterns = pages.select(F.explode(patterns_of(F.col("url"))).alias("pattern")).distinct()
    lists = F.array(
        *[
            F.struct(F.lit(name).alias("list"), F.lit(action).alias("action"), F.lit(one_in).alias("one_in"))
            for name, action, one_in in (("adult", "block", 5), ("spam", "block", 7), ("trusted", "allow", 11))
        ]
    )
    on = patterns.withColumn("l", F.explode(lists)).select("pattern", "l.*")
    seed = F.concat("list", F.lit(":"), "pattern")
    on = on.filter(_number(seed) % F.col("one_in") == 0)
    day = 86400
    start = 1704067200 + _number(F.concat(seed, F.lit(":a"))) % (200 * day)
    stay = day + _number(F.concat(seed, F.lit(":b"))) % (90 * day)
    away = _number(F.concat(seed, F.lit(":c"))) % (60 * day)
    steps = F.array(
        *[
            F.struct(F.timestamp_seconds(when).alias("changed_at"), F.lit(listed).alias("listed"))
            for when, listed in ((start, True), (start + stay, False), (start + stay + away, True))
        ]
    )
    return on.select("list", "pattern", "action", F.explode(steps).alias("s")).select("list", "pattern", "action", "s.*")


def op9_url_filters(spark, sf_dir: str) -> DataFrame:
    """Every page as a capture against histories derived from the pages' hosts and paths."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    done = evaluate(captures_of(pages), changes_of(pages))
    return done.select("page_id", "url_host", F.unix_seconds("fetched_at").alias("fetched_unix"), "n_active", "lists", "pattern", "verdict")


OP9_SQL = r"""
WITH c AS (
  SELECT page_id, url, 1704067200 + (page_id * 7919 * 613) % (366 * 86400) AS t,
    nullif(lower(regexp_replace(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1), '^.*@', ''),
      '(\.?:\d*|\.)$', '')), '') AS host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1) AS path FROM pages),
s AS (SELECT *, string_split(host, '.') AS labels, list_filter(string_split(path, '/'), lambda x: x <> '') AS steps FROM c),
q AS (
  SELECT page_id, t, host, unnest(list_concat(
    list_transform(range(1, len(labels) + 1), lambda i: array_to_string(labels[i:], '.')),
    list_transform(range(1, len(steps) + 1), lambda i: host || '/' || array_to_string(steps[1:i], '/')))) AS pattern
  FROM s WHERE host IS NOT NULL),
l AS (SELECT * FROM (VALUES ('adult', 'block', 5), ('spam', 'block', 7), ('trusted', 'allow', 11)) v(list, action, one_in)),
o AS (
  SELECT DISTINCT pattern, list, action,
    ('0x' || md5(list || ':' || pattern)[1:6])::BIGINT % one_in AS pick,
    1704067200 + ('0x' || md5(list || ':' || pattern || ':a')[1:6])::BIGINT % (200 * 86400) AS a,
    86400 + ('0x' || md5(list || ':' || pattern || ':b')[1:6])::BIGINT % (90 * 86400) AS b,
    ('0x' || md5(list || ':' || pattern || ':c')[1:6])::BIGINT % (60 * 86400) AS g
  FROM q, l),
m AS (
  SELECT q.page_id, o.pattern, o.list, o.action FROM q JOIN o USING (pattern)
  WHERE pick = 0 AND ((q.t >= a AND q.t < a + b) OR q.t >= a + b + g)),
f AS (
  SELECT page_id, count(*) AS n_active, string_agg(DISTINCT list, ',' ORDER BY list) AS lists,
    first(pattern ORDER BY length(pattern) DESC, action, list, pattern) AS pattern,
    first(action ORDER BY length(pattern) DESC, action, list, pattern) AS verdict
  FROM m GROUP BY page_id)
SELECT c.page_id, c.host AS url_host, c.t AS fetched_unix, coalesce(n_active, 0)::BIGINT AS n_active,
  coalesce(lists, '') AS lists, pattern, coalesce(verdict, 'none') AS verdict
FROM c LEFT JOIN f USING (page_id)"""
