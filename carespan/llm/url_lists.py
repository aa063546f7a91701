"""URL filtering against lists that change over time.

A list is a history of dated entries: from its date on, a pattern is added to the list or removed
from it. Each entry holds until the next one of the same list and pattern, so a pattern's history
becomes validity intervals. A capture (a URL fetched at some time) is tested as of its time:

* ``domain``: the pattern is the URL's host or a parent domain of it;
* ``prefix``: the pattern is host and first path segment;
* ``url``: the pattern is host and path.

A pattern's intervals travel as one sorted array, so the join gives one row for a capture and
matching pattern, however often the pattern changed; equal captures are tested once, and a host with a
third of all captures is split by adaptive execution. Host and path are
lower-cased; scheme, port, user, query, fragment, a final dot of the host and a final slash of the path don't count.

Nulls, ties and odd rows: a null URL or one without a host, or a null time, matches nothing; of entries of
the same time a removal comes last; entries with a null pattern, list, kind or date are void; an entry
repeated changes nothing; each repeated capture has its row; other columns are ignored; no entries block
nothing, no captures give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*)"
PATH = r"^[a-z][a-z0-9+.-]*://[^/?#]*([^?#]*)"


def _host(url: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(F.lower(url), HOST, 1), r"\.$", "")


def _path(url: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(F.lower(url), PATH, 1), "/+$", "")


def _patterns() -> Column:
    """Every (kind, pattern) that a capture with host and path can match."""
    labels = F.split("host", r"\.")
    parents = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda k: F.struct(F.lit("domain").alias("kind"), F.array_join(F.slice(labels, k, F.size(labels)), ".").alias("pattern")),
    )
    first = F.concat(F.col("host"), F.lit("/"), F.element_at(F.split("path", "/"), 2))
    exact = F.concat(F.col("host"), F.col("path"))
    others = F.array(
        F.struct(F.lit("prefix").alias("kind"), F.when(F.length("path") > 0, first).alias("pattern")),
        F.struct(F.lit("url").alias("kind"), exact.alias("pattern")),
    )
    return F.concat(parents, others)


def intervals(entries: DataFrame) -> DataFrame:
    """(kind, pattern, spans): spans are the (list, since, until) in which the pattern is on a list."""
    known = entries.select("list", "kind", F.lower("pattern").alias("pattern"), "action", "effective_at").dropna().distinct()
    history = Window.partitionBy("list", "kind", "pattern").orderBy("effective_at", "action")  # add < remove
    return (
        known.withColumn("until", F.lead("effective_at").over(history))
        .where("action = 'add' AND (until IS NULL OR until > effective_at)")
        .groupBy("kind", "pattern")
        .agg(F.sort_array(F.collect_list(F.struct(F.col("effective_at").alias("since"), "until", "list"))).alias("spans"))
    )


def filtered(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """(page_id, url, host, fetched_at, blocked, n_entries, lists) of every capture."""
    captures = captures.select("page_id", "url", "fetched_at", F.coalesce(_host(F.col("url")), F.lit("")).alias("host"))
    distinct = captures.select("url", "host", "fetched_at").where("host <> '' AND fetched_at IS NOT NULL").distinct()
    tried = distinct.withColumn("path", _path(F.col("url"))).select("url", "fetched_at", F.explode(_patterns()).alias("p"))
    tried = tried.select("url", "fetched_at", F.col("p.kind").alias("kind"), F.col("p.pattern").alias("pattern"))
    active = F.filter("spans", lambda s: (s.since <= F.col("fetched_at")) & (s.until.isNull() | (F.col("fetched_at") < s.until)))
    hits = tried.join(intervals(entries), ["kind", "pattern"]).withColumn("active", active).where(F.size("active") > 0)
    verdicts = hits.groupBy("url", "fetched_at").agg(
        F.sum(F.size("active")).alias("n_entries"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.transform("active", lambda s: s.list))))), ",").alias("lists"),
    )
    return captures.join(verdicts, ["url", "fetched_at"], "left").select(
        "page_id",
        "url",
        "host",
        "fetched_at",
        F.col("n_entries").isNotNull().alias("blocked"),
        F.coalesce("n_entries", F.lit(0)).cast("long").alias("n_entries"),
        F.coalesce("lists", F.lit("")).alias("lists"),
    )


# The given pages carry neither fetch times nor lists. Both are derived from all pages: the time from the
# page's number, the lists' entries from the md5 of the hosts, their parents and the first segments.
SPAN_SECONDS = 30 * 86_400


def page_captures(pages: DataFrame) -> DataFrame:
    seconds = F.expr(f"(page_id * 7919) % {SPAN_SECONDS}")
    return pages.select("page_id", "url", F.timestamp_seconds(F.lit(1_704_067_200) + seconds).alias("fetched_at"))


def page_lists(pages: DataFrame) -> DataFrame:
    """Dated entries: patterns whose md5 begins low are listed, most are removed later, some come back."""
    hosts = pages.select(_host(F.col("url")).alias("host"), _path(F.col("url")).alias("path")).where("host <> ''").distinct()
    patterns = hosts.select(F.explode(_patterns()).alias("p")).select("p.kind", "p.pattern").dropna().distinct()
    digest = patterns.withColumn("d", F.md5(F.concat_ws(":", "kind", "pattern")))
    digit = lambda a, n: F.conv(F.substring("d", a, n), 16, 10).cast("long")
    listed = digest.select(
        "kind",
        "pattern",
        F.element_at(F.array(*map(F.lit, ("adult", "malware", "spam"))), (digit(2, 1) % 3 + 1).cast("int")).alias("list"),
        digit(1, 1).alias("chance"),
        (digit(3, 5) % SPAN_SECONDS).alias("since"),
        (digit(8, 5) % SPAN_SECONDS).alias("length"),
    ).where("chance < 5")
    changes = F.array(
        F.struct(F.lit("add").alias("action"), F.col("since").alias("at")),
        F.struct(F.lit("remove").alias("action"), (F.col("since") + F.col("length")).alias("at")),
        F.struct(F.when(F.col("chance") < 2, F.lit("add")).alias("action"), (F.col("since") + 2 * F.col("length")).alias("at")),
    )
    return listed.select("list", "kind", "pattern", F.explode(changes).alias("c")).select(
        "list", "kind", "pattern", "c.action", F.timestamp_seconds(F.lit(1_704_067_200) + F.col("c.at")).alias("effective_at")
    ).where("action IS NOT NULL")


def op5_temporal_url_lists(spark, folder: str) -> DataFrame:
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url")
    out = filtered(page_captures(pages), page_lists(pages))
    return out.withColumn("fetched_at", F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss"))


def _sql_digit(first: int, n: int) -> str:
    return f"CAST('0x' || substr(d, {first}, {n}) AS BIGINT)"


ORACLE = f"""
WITH captures AS (
  SELECT page_id, url, (page_id * 7919) % {SPAN_SECONDS} AS moment,
    coalesce(regexp_replace(regexp_extract(lower(url), '{HOST}', 1), '\\.$', ''), '') AS host,
    regexp_replace(regexp_extract(lower(url), '{PATH}', 1), '/+$', '') AS path
  FROM pages
), tried AS (
  SELECT DISTINCT url, host, moment, 'domain' AS kind,
    unnest(list_transform(range(1, greatest(len(string_split(host, '.')) - 1, 1) + 1),
      lambda k: array_to_string(string_split(host, '.')[k:], '.'))) AS pattern
  FROM captures WHERE host <> ''
  UNION ALL
  SELECT DISTINCT url, host, moment, 'prefix', host || '/' || string_split(path, '/')[2] FROM captures WHERE host <> '' AND path <> ''
  UNION ALL
  SELECT DISTINCT url, host, moment, 'url', host || path FROM captures WHERE host <> ''
), listed AS (
  SELECT kind, pattern, ['adult', 'malware', 'spam'][{_sql_digit(2, 1)} % 3 + 1] AS list, {_sql_digit(1, 1)} AS chance,
    {_sql_digit(3, 5)} % {SPAN_SECONDS} AS since, {_sql_digit(8, 5)} % {SPAN_SECONDS} AS length
  FROM (SELECT DISTINCT kind, pattern, md5(kind || ':' || pattern) AS d FROM tried) WHERE {_sql_digit(1, 1)} < 5
), entries AS (
  SELECT list, kind, pattern, 'add' AS action, since AS moment FROM listed
  UNION SELECT list, kind, pattern, 'remove', since + length FROM listed
  UNION SELECT list, kind, pattern, 'add', since + 2 * length FROM listed WHERE chance < 2
), latest AS (
  SELECT url, t.moment, t.kind, t.pattern, list, arg_max(action, (e.moment, action)) AS action
  FROM tried t JOIN entries e ON t.kind = e.kind AND t.pattern = e.pattern AND e.moment <= t.moment
  GROUP BY ALL
), verdicts AS (
  SELECT url, moment, count(*) AS n, array_to_string(list_sort(list_distinct(list(list))), ',') AS lists
  FROM latest WHERE action = 'add' GROUP BY url, moment
)
SELECT page_id, c.url, host, strftime(TIMESTAMP '2024-01-01' + to_seconds(c.moment), '%Y-%m-%d %H:%M:%S') AS fetched_at,
  n IS NOT NULL AS blocked, coalesce(n, 0)::BIGINT AS n_entries, coalesce(lists, '') AS lists
FROM captures c LEFT JOIN verdicts v ON c.url = v.url AND c.moment = v.moment
"""
