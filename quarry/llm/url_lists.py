"""URL filters (operator 2): a temporal list join.

A list is a log of dated entries: at some time a pattern was added to a list or
removed from it. The log becomes validity intervals (from an addition to the
next entry for the same list and pattern), and every capture is evaluated
against the entries active when it was fetched, not those of today.

Patterns are hosts (they hold for all subdomains), path prefixes (whole
segments) and exact addresses. A capture has one key for each suffix of its
host, each prefix of its path and its whole address, so matching is an equality
join. Time is part of the key: intervals are laid out over periods of
``PERIOD`` and a capture looks into its own period only, which keeps the
intervals met per capture few and spreads a host with very many captures over
the periods; ``SALTS`` splits it further. Equal captures are looked up once.

Only DataFrame functions are used.

Defined cases: a NULL, empty or unparsable address or a NULL time matches
nothing; entries with a NULL in list, kind, pattern, time or action are
ignored; of several entries for one pattern at one time a removal wins;
repeated captures get the same verdict each; with no entries nothing is
blocked. Columns of the captures other than address and time pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PERIOD = 30
SALTS = 8
OPEN_END = 1 << 40


def host_of(url: Column) -> Column:
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r"^[^@]*@", ""), r":[0-9]*$", "")
    return F.regexp_replace(F.regexp_replace(host, r"\.$", ""), r"^www\.", "")


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def address_of(url: Column) -> Column:
    """Host, path and query, without scheme, fragment and a slash at the end."""
    rest = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)", 1)
    return F.regexp_replace(F.concat(host_of(url), rest), r"/$", "")


def keys_of(url: Column) -> Column:
    """Array of (kind, pattern): all a list entry could name to match the address."""
    labels = F.split(host_of(url), r"\.")
    hosts = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.struct(F.lit("host").alias("kind"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("pattern"))
    )
    segments = F.filter(F.split(path_of(url), "/"), lambda s: s != "")
    prefixes = F.transform(
        segments, lambda s, i: F.struct(F.lit("prefix").alias("kind"), F.concat(host_of(url), F.lit("/"), F.array_join(F.slice(segments, 1, i + 1), "/")).alias("pattern"))
    )
    exact = F.array(F.struct(F.lit("url").alias("kind"), address_of(url).alias("pattern")))
    return F.when(host_of(url) != "", F.concat(hosts, prefixes, exact)).otherwise(F.array().cast("array<struct<kind:string,pattern:string>>"))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, kind, pattern, start, stop) from (list, kind, pattern, at, action); ``stop`` is not included."""
    log = (
        entries.where("list IS NOT NULL AND kind IS NOT NULL AND pattern IS NOT NULL AND at IS NOT NULL AND action IN ('add', 'remove')")
        .groupBy("list", "kind", "pattern", F.col("at").cast("long").alias("start")).agg(F.max("action").alias("action"))
    )
    following = F.lead("start").over(Window.partitionBy("list", "kind", "pattern").orderBy("start"))
    return log.withColumn("stop", F.coalesce(following, F.lit(OPEN_END))).where("action = 'add'").drop("action")


def evaluate(
    captures: DataFrame, entries: DataFrame, url_col: str = "url", time_col: str = "fetched",
    allow: str = "allow", period: int = PERIOD,
) -> DataFrame:
    """The captures with (n_active, first_list, allowed, blocked).

    ``n_active`` counts active entries that match, ``first_list`` is the first
    list they are in; a match in the list ``allow`` outweighs the others.
    """
    url, time = F.col(url_col), F.col(time_col).cast("long")
    seen = captures.where(url.isNotNull() & time.isNotNull()).select(url.alias("__url"), time.alias("__time")).distinct()
    looked = seen.select(
        "__url", "__time", F.expr(f"floor(__time / {period})").alias("__period"),
        F.pmod(F.xxhash64("__url", "__time"), F.lit(SALTS)).cast("int").alias("__salt"), F.explode(keys_of(F.col("__url"))).alias("__key"),
    ).select("__url", "__time", "__period", "__salt", F.col("__key.kind").alias("kind"), F.col("__key.pattern").alias("pattern"))
    bounds = seen.agg(F.min("__time").alias("lo"), F.max("__time").alias("hi"))
    lo, hi = bounds.select("lo").scalar(), bounds.select("hi").scalar()
    valid = intervals(entries).where((F.col("stop") > lo) & (F.col("start") <= hi))
    first = F.floor(F.greatest("start", lo) / period)
    last = F.floor(F.least(F.col("stop") - 1, hi) / period)
    laid = valid.withColumn("__period", F.explode(F.sequence(first, last))).withColumn(
        "__salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)]))
    )
    met = looked.join(laid, ["kind", "pattern", "__period", "__salt"]).where("start <= __time AND __time < stop")
    verdict = met.groupBy("__url", "__time").agg(
        F.count(F.lit(1)).alias("n_active"), F.min("list").alias("first_list"), F.max((F.col("list") == allow).cast("int")).alias("__allowed")
    )
    out = captures.withColumn("__t", time).join(verdict, (url == F.col("__url")) & (F.col("__t") == F.col("__time")), "left")
    allowed = F.coalesce(F.col("__allowed") == 1, F.lit(False))
    return out.select(
        *captures.columns, F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"), "first_list",
        allowed.alias("allowed"), (F.col("n_active").isNotNull() & ~allowed).alias("blocked"),
    )


def _mark(*parts: Column) -> Column:
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 6), 16, 10).cast("long")


def page_captures(pages: DataFrame) -> DataFrame:
    """(page_id, url, fetched): pages with a fetch day made from their identifier."""
    return pages.select("page_id", "url", (_mark(F.lit("day"), F.col("page_id").cast("string")) % 365).alias("fetched"))


def page_entries(pages: DataFrame) -> DataFrame:
    """A list log made from the pages' own hosts, paths and addresses: added, removed, added again."""
    url = F.col("url")
    first = F.regexp_extract(path_of(url), r"^/([^/]+)", 1)
    named = pages.where(url.isNotNull()).select(F.explode(F.array(
        F.struct(F.lit("host").alias("kind"), host_of(url).alias("pattern"), F.lit(3).alias("each")),
        F.struct(F.lit("prefix").alias("kind"), F.concat(host_of(url), F.lit("/"), first).alias("pattern"), F.lit(9).alias("each")),
        F.struct(F.lit("url").alias("kind"), address_of(url).alias("pattern"), F.lit(20).alias("each")),
    )).alias("e")).select("e.*").distinct()
    named = named.where((_mark("kind", "pattern") % F.col("each") == 0) & (F.col("pattern") != ""))
    day = _mark(F.lit("added"), F.col("pattern")) % 300
    lists = F.element_at(F.array(F.lit("adult"), F.lit("spam"), F.lit("malware"), F.lit("allow")), (_mark(F.lit("list"), F.col("pattern")) % 4 + 1).cast("int"))
    steps = F.array(
        F.struct(day.alias("at"), F.lit("add").alias("action")), F.struct((day + 40).alias("at"), F.lit("remove").alias("action")),
        F.struct((day + 90).alias("at"), F.lit("add").alias("action")),
    )
    return named.select(lists.alias("list"), "kind", "pattern", F.explode(F.slice(steps, F.lit(1), (_mark(F.lit("n"), F.col("pattern")) % 3 + 1).cast("int"))).alias("s")).select(
        "list", "kind", "pattern", "s.at", "s.action"
    )


ORACLE_SQL = r"""
WITH p AS (
  SELECT page_id, url, ('0x' || substr(md5('day|' || CAST(page_id AS VARCHAR)), 1, 6))::BIGINT % 365 AS fetched,
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^[^@]*@', ''), ':[0-9]*$', ''), '\.$', ''), '^www\.', '') AS host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)', 1) AS rest
  FROM pages),
named AS (
  SELECT DISTINCT * FROM (
    SELECT 'host' AS kind, host AS pattern, 3 AS each FROM p WHERE url IS NOT NULL UNION ALL
    SELECT 'prefix', host || '/' || regexp_extract(path, '^/([^/]+)', 1), 9 FROM p WHERE url IS NOT NULL UNION ALL
    SELECT 'url', regexp_replace(host || rest, '/$', ''), 20 FROM p WHERE url IS NOT NULL)
  WHERE pattern <> ''),
chosen AS (
  SELECT kind, pattern, ('0x' || substr(md5('added|' || pattern), 1, 6))::BIGINT % 300 AS day,
    ['adult', 'spam', 'malware', 'allow'][(('0x' || substr(md5('list|' || pattern), 1, 6))::BIGINT % 4 + 1)::INT] AS list,
    ('0x' || substr(md5('n|' || pattern), 1, 6))::BIGINT % 3 + 1 AS n
  FROM named WHERE ('0x' || substr(md5(kind || '|' || pattern), 1, 6))::BIGINT % each = 0),
valid AS (
  SELECT list, kind, pattern, day AS start, CASE WHEN n >= 2 THEN day + 40 ELSE 1099511627776 END AS stop FROM chosen UNION ALL
  SELECT list, kind, pattern, day + 90, 1099511627776 FROM chosen WHERE n >= 3),
labels AS (SELECT page_id, url, fetched, host, string_split(host, '.') AS l, list_filter(string_split(path, '/'), lambda x: x <> '') AS s, rest FROM p WHERE host <> ''),
keys AS (
  SELECT page_id, 'host' AS kind, array_to_string(l[i:], '.') AS pattern FROM (SELECT page_id, l, unnest(range(1, len(l) + 1)) AS i FROM labels) UNION ALL
  SELECT page_id, 'prefix', host || '/' || array_to_string(s[1:i], '/') FROM (SELECT page_id, host, s, unnest(range(1, len(s) + 1)) AS i FROM labels) UNION ALL
  SELECT page_id, 'url', regexp_replace(host || rest, '/$', '') FROM labels),
met AS (
  SELECT keys.page_id, COUNT(*) AS n_active, MIN(list) AS first_list, MAX(CASE WHEN list = 'allow' THEN 1 ELSE 0 END) AS a
  FROM keys JOIN p ON keys.page_id = p.page_id JOIN valid ON keys.kind = valid.kind AND keys.pattern = valid.pattern AND start <= fetched AND fetched < stop
  GROUP BY keys.page_id)
SELECT p.page_id, p.url, p.fetched, COALESCE(n_active, 0)::BIGINT AS n_active, first_list, COALESCE(a = 1, FALSE) AS allowed,
  (n_active IS NOT NULL AND NOT COALESCE(a = 1, FALSE)) AS blocked
FROM p LEFT JOIN met ON p.page_id = met.page_id
"""
