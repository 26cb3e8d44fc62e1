"""URL filters by a temporal list join.

Lists change over time: an entry names a list, a pattern, a day and whether the pattern was added or
removed that day. Entries become validity intervals, each ending where the pattern's next entry in that
list begins. A capture is judged by the entries that were active on the day it was fetched: the host,
its parent domains and its path prefixes are looked up, and the as-of condition picks the intervals
that hold the day. As intervals of one list and pattern do not overlap, a capture meets at most one of
each. Only keys, days and list names are shuffled, never pages; a hot host's captures are counted once
per distinct host, path prefix set and day before the join.

A pattern is a host or domain (``example.org`` covers its subdomains) or a host and path prefix
(``example.org/a/b`` covers everything at and below that path). Patterns and URLs are brought to one
form: hosts in lower case without dots at their end, paths without empty steps or a slash at their end;
an IPv6 host stands in brackets.

Defined cases: a NULL or unparsable URL or day meets no entry and is not blocked; entries with a NULL
list, pattern or day are ignored; of several entries of one list, pattern and day a removal counts
before an addition, so the addition holds; an entry repeated while active changes nothing; ties between
the matched patterns go to the longest, then to the alphabetically first list; repeated captures are
judged each; other columns are passed by; an empty list blocks nothing, an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stage


def host_of(url: Column) -> Column:
    """The host in lower case, without port, user or dots at its end, or NULL."""
    found = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]+)", 1))
    bare = F.regexp_replace(found, r"\.+$", "")
    return F.when(bare != "", bare)


def pattern_of(entry: Column) -> Column:
    """A list entry's pattern in the form of ``patterns_of``; NULL if it has no host."""
    steps = F.split(entry, "/")
    host = F.regexp_replace(F.lower(F.get(steps, F.lit(0))), r"\.+$", "")
    path = F.filter(F.slice(steps, 2, F.greatest(F.size(steps) - 1, F.lit(0))), lambda s: s != "")
    return F.when(host != "", F.array_join(F.concat(F.array(host), path), "/"))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+([^?#]*)", 1)


def patterns_of(host: Column, path: Column) -> Column:
    """Every pattern that covers the URL: the host and its parents, and the host with each path prefix."""
    labels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    steps = F.filter(F.split(path, "/"), lambda s: s != "")
    prefixes = F.when(F.size(steps) > 0, F.transform(
        F.sequence(F.lit(1), F.size(steps)), lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(steps, 1, i), "/"))))
    return F.array_distinct(F.concat(domains, F.coalesce(prefixes, F.array().cast("array<string>"))))


def validity(entries: DataFrame) -> DataFrame:
    """``list, pattern, since, until`` (NULL: still active) from ``list, pattern, day, added``."""
    formed = entries.select("list", pattern_of(F.col("pattern")).alias("pattern"), "day", "added")
    known = formed.filter(F.col("list").isNotNull() & F.col("pattern").isNotNull() & F.col("day").isNotNull())
    daily = known.groupBy("list", "pattern", "day").agg(F.max(F.coalesce("added", F.lit(False))).alias("added"))
    following = F.lead("day").over(Window.partitionBy("list", "pattern").orderBy("day"))
    return (daily.withColumn("until", following).filter("added")
            .select("list", "pattern", F.col("day").alias("since"), "until"))


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``url, fetched, host, n_active, pattern, list, blocked`` for every distinct URL and day."""
    distinct = captures.select("url", "fetched").distinct()
    read = distinct.select("url", "fetched", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    # Queries and fragments do not matter: equal hosts, paths and days are looked up once.
    places = read.filter(F.col("host").isNotNull() & F.col("fetched").isNotNull()).select("host", "path", "fetched").distinct()
    keyed = places.select("host", "path", "fetched", F.explode(patterns_of(F.col("host"), F.col("path"))).alias("pattern"))
    # Written first, so that a hot host's rows can be split between tasks of the join.
    active = keyed.join(stage(validity(entries), "intervals"), "pattern").filter(
        (F.col("fetched") >= F.col("since")) & (F.col("until").isNull() | (F.col("fetched") < F.col("until"))))
    best = F.min(F.struct((-F.length("pattern")).alias("longest"), "list", "pattern")).alias("best")
    judged = active.groupBy("host", "path", "fetched").agg(F.count("*").alias("n_active"), best)
    return read.join(judged, ["host", "path", "fetched"], "left").select(
        "url", "fetched", "host", F.coalesce("n_active", F.lit(0)).alias("n_active"),
        F.col("best.pattern").alias("pattern"), F.col("best.list").alias("list"), F.col("n_active").isNotNull().alias("blocked"))


def filter_captures(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Every capture (``page_id, url, fetched``) with its verdict."""
    verdicts = judge(captures, entries).withColumnsRenamed({"url": "__url", "fetched": "__fetched"})
    same = F.col("url").eqNullSafe(F.col("__url")) & F.col("fetched").eqNullSafe(F.col("__fetched"))
    return captures.select("page_id", "url", "fetched").join(verdicts, same).drop("__url", "__fetched")


# The test tables have pages but neither fetch times nor lists. Both are drawn from them by rule: a page's
# fetch day from its id, and dated entries from the hosts, their parent domains and their first path step.
FIRST_DAY, DAYS = "2023-01-01", 730


def captures_of(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", F.date_add(F.lit(FIRST_DAY).cast("date"), F.pmod(F.col("page_id") * 37, F.lit(DAYS)).cast("int")).alias("fetched"))


def _number(text: Column, first: int) -> Column:
    return F.conv(F.substring(F.md5(text.cast("binary")), first, 6), 16, 10).cast("int")


def entries_of(pages: DataFrame) -> DataFrame:
    """Four dated entries of one of two lists for a third of all patterns: added, removed, added, removed."""
    read = pages.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).filter("host IS NOT NULL").distinct()
    step = F.split("path", "/")
    first = F.when((F.size(step) > 1) & (F.get(step, F.lit(1)) != ""), F.concat("host", F.lit("/"), F.get(step, F.lit(1))))
    parent = F.regexp_extract("host", r"^[^.]+\.(.+\..+)$", 1)
    named = read.select(F.explode(F.array("host", parent, first)).alias("pattern")).filter("pattern <> ''").distinct()
    chosen = named.filter(_number(F.col("pattern"), 1) % 3 == 0)
    day = lambda n: F.date_add(F.lit(FIRST_DAY).cast("date"), F.col("start") + F.lit(n))
    dated = chosen.select("pattern", F.when(_number(F.col("pattern"), 7) % 2 == 0, "phishing").otherwise("spam").alias("list"),
                          (_number(F.col("pattern"), 13) % 400).alias("start"))
    steps = F.array(*[F.struct(day(n).alias("day"), F.lit(n in (0, 200)).alias("added")) for n in (0, 90, 200, 320)])
    return dated.select("list", "pattern", F.explode(steps).alias("entry")).select("list", "pattern", "entry.day", "entry.added")


ORACLE = f"""
WITH read AS (
    SELECT page_id, url, DATE '{FIRST_DAY}' + (page_id * 37 % {DAYS})::INT AS fetched,
           nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\\[[^\\]/?#]*\\]|[^/?#:]+)', 1)), '\\.+$', ''), '') AS host,
           regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+([^?#]*)', 1) AS path
    FROM pages),
named AS (
    SELECT DISTINCT unnest([host, regexp_extract(host, '^[^.]+\\.(.+\\..+)$', 1),
        CASE WHEN len(string_split(path, '/')) > 1 AND string_split(path, '/')[2] <> '' THEN host || '/' || string_split(path, '/')[2] END]) AS pattern
    FROM read WHERE host IS NOT NULL),
entries AS (
    SELECT pattern, CASE WHEN ('0x' || substr(md5(pattern), 7, 6))::INT % 2 = 0 THEN 'phishing' ELSE 'spam' END AS list,
           DATE '{FIRST_DAY}' + (('0x' || substr(md5(pattern), 13, 6))::INT % 400) AS day
    FROM named WHERE pattern <> '' AND ('0x' || substr(md5(pattern), 1, 6))::INT % 3 = 0),
intervals AS (
    SELECT list, pattern, day AS since, day + 90 AS until FROM entries
    UNION ALL SELECT list, pattern, day + 200, day + 320 FROM entries),
keys AS (
    SELECT page_id, fetched, unnest(list_distinct(list_concat(
        [array_to_string(string_split(host, '.')[i:], '.') FOR i IN range(1, len(string_split(host, '.')) + 1)],
        [host || '/' || array_to_string(steps[1:i], '/') FOR i IN range(1, len(steps) + 1)]))) AS pattern
    FROM (SELECT *, list_filter(string_split(path, '/'), lambda s: s <> '') AS steps FROM read WHERE host IS NOT NULL)),
active AS (
    SELECT k.page_id, i.list, i.pattern FROM keys k JOIN intervals i ON k.pattern = i.pattern AND k.fetched >= i.since AND k.fetched < i.until),
judged AS (
    SELECT page_id, count(*) AS n_active, first(pattern ORDER BY length(pattern) DESC, list, pattern) AS pattern,
           first(list ORDER BY length(pattern) DESC, list, pattern) AS list
    FROM active GROUP BY page_id)
SELECT r.page_id, r.url, r.fetched, r.host, coalesce(j.n_active, 0) AS n_active, j.pattern, j.list, j.n_active IS NOT NULL AS blocked
FROM read r LEFT JOIN judged j ON r.page_id = j.page_id
"""
