"""URL filters as a temporal list join, in DataFrame operations alone.

A list is a table of dated entries ``(list_name, pattern, action, listed_at)``; action is
``block``, ``allow`` or ``remove``. A pattern is a host, which covers its subdomains, or a
host with the first segments of a path. An entry holds from its date up to the next entry of
the same list and pattern. All lists together give, for each pattern, a timeline of states:
how many lists block it and how many allow it from that time on.

A capture looks up every pattern that could cover it (suffixes of its host, prefixes of its
path) as of its fetch time: captures and timelines are sorted together by pattern and time,
and the last state seen is the one in force. No pair of capture and entry is ever built.
Of the patterns in force the most specific decides: paths before hosts, then longer ones. At
one pattern, allow comes before block.

Patterns under which many captures meet (a third may be on one host) are found by a sketch;
their captures go to several tasks, with a copy of the timeline each. A pattern's own
history, its distinct change times, stays in one task.

A capture without a URL or time, or with a URL that has no host, gets ``none``. Of entries of one list
and pattern with the same time the strictest counts (block, allow, remove). Entries
without a pattern, a time or a known action do nothing. Repeated captures give repeated rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from docketry.operators.skew import hot_key_hashes

HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"
PATH = r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    return F.regexp_extract(F.lower(url), HOST, 1)


def segments_of(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda s: s != "")


def clean_pattern(pattern: Column) -> Column:
    parts = segments_of(pattern)
    return F.concat_ws("/", F.lower(F.get(parts, F.lit(0))), F.slice(parts, F.lit(2), F.size(parts)))


def timelines(entries: DataFrame) -> DataFrame:
    """``pattern, at, n_block, n_allow``: the state of each pattern from each of its change times on."""
    severity = F.expr("CASE action WHEN 'block' THEN 2 WHEN 'allow' THEN 1 WHEN 'remove' THEN 0 END")
    known = entries.select("list_name", clean_pattern(F.col("pattern")).alias("pattern"), F.col("listed_at").alias("at"), severity.alias("mode"))
    known = known.filter("pattern <> '' AND at IS NOT NULL AND mode IS NOT NULL")
    dated = known.groupBy("list_name", "pattern", "at").agg(F.max("mode").alias("mode"))
    history = Window.partitionBy("list_name", "pattern").orderBy("at")
    valid = dated.withColumn("until", F.lead("at").over(history)).filter("mode > 0")
    block, allow = F.col("mode") == 2, F.col("mode") == 1
    start = F.struct(F.col("at").alias("at"), block.cast("int").alias("block"), allow.cast("int").alias("allow"))
    end = F.struct(F.col("until").alias("at"), (-block.cast("int")).alias("block"), (-allow.cast("int")).alias("allow"))
    steps = valid.select("pattern", F.explode(F.array(start, end)).alias("step")).select("pattern", "step.*").filter("at IS NOT NULL")
    changes = steps.groupBy("pattern", "at").agg(F.sum("block").alias("block"), F.sum("allow").alias("allow"))
    running = Window.partitionBy("pattern").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return changes.select("pattern", "at", F.sum("block").over(running).alias("n_block"), F.sum("allow").over(running).alias("n_allow"))


def covering_patterns(url: Column, host_labels: int, path_segments: int) -> Column:
    """Every pattern that could cover the URL, as deep as the lists go; never an empty array."""
    host = host_of(url)
    labels, parts = F.split(host, r"\."), segments_of(F.regexp_extract(url, PATH, 1))
    host_depth, path_depth = F.least(F.size(labels), F.lit(host_labels)), F.least(F.size(parts), F.lit(path_segments))
    hosts = F.transform(F.sequence(F.lit(1), F.greatest(host_depth, F.lit(1))), lambda n: F.array_join(F.slice(labels, -n, n), "."))
    paths = F.transform(F.sequence(F.lit(1), F.greatest(path_depth, F.lit(1))), lambda n: F.concat_ws("/", host, F.slice(parts, 1, n)))
    both = F.when(path_depth > 0, F.concat(hosts, paths)).otherwise(hosts)
    return F.coalesce(F.when(host != "", both), F.array(F.lit("")))


def judged(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``captures(page_id, url, fetched_at)`` with verdict, pattern, n_lists and since.

    ``since`` is the time of the last change to the deciding pattern's state.
    """
    spark = captures.sparkSession
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    history = timelines(entries)
    depth = history.agg(
        F.max(F.size(F.split(F.substring_index("pattern", "/", 1), r"\."))).alias("labels"),
        F.max(F.size(F.split("pattern", "/")) - 1).alias("segments"),
    ).first()
    plain = captures.groupBy("page_id", "url", "fetched_at").agg(F.count("*").alias("copies"))
    patterns = covering_patterns(F.col("url"), depth.labels or 1, depth.segments or 0)
    asked = plain.select("page_id", "url", F.col("fetched_at").alias("at"), "copies", F.explode(patterns).alias("pattern"))
    every = captures.select(F.explode(covering_patterns(F.col("url"), depth.labels or 1, depth.segments or 0)).alias("pattern"))
    is_hot = F.coalesce(F.array_contains(hot_key_hashes(every, ["pattern"]), F.xxhash64("pattern")), F.lit(False))
    salt = F.when(is_hot, F.pmod(F.xxhash64("page_id", "url", "at"), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    state = F.struct("n_block", "n_allow", "at")
    nothing = F.lit(None).cast("struct<n_block: bigint, n_allow: bigint, at: timestamp>")
    told = history.select(
        "pattern", "at", F.explode(copies).alias("salt"), F.lit(0).alias("turn"), state.alias("state"),
        F.lit(None).cast("long").alias("page_id"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("long").alias("copies"),
    )
    questions = asked.select("pattern", "at", salt.alias("salt"), F.lit(1).alias("turn"), nothing.alias("state"), "page_id", "url", "copies")
    as_of = Window.partitionBy("pattern", "salt").orderBy("at", "turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A capture without a time sorts before every entry, and so finds no state.
    found = told.unionByName(questions).withColumn("state", F.last("state", ignorenulls=True).over(as_of)).filter("turn = 1")
    in_force = F.coalesce((F.col("state.n_block") > 0) | (F.col("state.n_allow") > 0), F.lit(False))
    allowed = F.col("state.n_allow") > 0
    answer = F.struct(
        F.col("pattern").contains("/").alias("path"),
        F.length("pattern").alias("length"),
        F.col("pattern").alias("pattern"),
        F.when(allowed, "allow").otherwise("block").alias("verdict"),
        F.when(allowed, F.col("state.n_allow")).otherwise(F.col("state.n_block")).alias("n_lists"),
        F.col("state.at").alias("since"),
    )
    best = found.groupBy("page_id", "url", "at").agg(
        F.max(F.when(in_force, answer)).alias("best"), F.max("copies").cast("int").alias("copies")
    )
    rows = best.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return rows.select(
        "page_id",
        "url",
        F.col("at").alias("fetched_at"),
        F.coalesce("best.verdict", F.lit("none")).alias("verdict"),
        "best.pattern",
        F.coalesce("best.n_lists", F.lit(0)).cast("long").alias("n_lists"),
        "best.since",
    )


# --- the query: lists and fetch times derived from the pages --------------------------

# The given tables hold no lists, so three are written from the hosts of the pages, in SQL
# that both engines read. ``{day}`` adds days and ``{minute}`` minutes to the first of 2024.
CAPTURES_SQL = "SELECT page_id, url, {minute((page_id * 37) % 86400)} AS fetched_at FROM pages"
LISTS_SQL = """
WITH hosts AS (
  SELECT host, min(page_id) AS k FROM (
    SELECT page_id, regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://([^/:?#]+)', 1) AS host FROM pages) h
  WHERE host <> '' GROUP BY host),
sites AS (
  SELECT regexp_extract(host, '([^.]+[.][^.]+[.][^.]+)$', 1) AS site, min(k) AS k FROM hosts GROUP BY 1)
SELECT 'hosts' AS list_name, host AS pattern, 'block' AS action, {day(k % 20)} AS listed_at FROM hosts WHERE k % 2 = 0
UNION ALL SELECT 'hosts', host, 'remove', {day(k % 20 + 15)} FROM hosts WHERE k % 6 = 0
UNION ALL SELECT 'hosts', host, 'block', {day(k % 20 + 30)} FROM hosts WHERE k % 12 = 0
UNION ALL SELECT 'sites', site, 'allow', {day((k * 7) % 40)} FROM sites WHERE site <> '' AND k % 3 = 1
UNION ALL SELECT 'sites', site, 'block', {day((k * 7) % 40 + 12)} FROM sites WHERE site <> '' AND k % 3 <> 0
UNION ALL SELECT 'paths', concat(host, '/en/'), 'block', {day((k * 5) % 50)} FROM hosts WHERE k % 4 = 1
UNION ALL SELECT 'paths', concat(host, '/fr'), 'allow', {day((k * 3) % 50)} FROM hosts WHERE k % 5 < 3
"""


def _filled(sql: str, day: str, minute: str) -> str:
    import re

    sql = re.sub(r"\{day\((.*?)\)\}", lambda m: day.format(m[1]), sql)
    return re.sub(r"\{minute\((.*?)\)\}", lambda m: minute.format(m[1]), sql)


SPARK_TIMES = ("timestamp_seconds(1704067200 + ({}) * 86400)", "timestamp_seconds(1704067200 + ({}) * 60)")
DUCK_TIMES = ("(TIMESTAMP '2024-01-01' + to_days(CAST({} AS INTEGER)))", "(TIMESTAMP '2024-01-01' + to_minutes({}))")


def page_verdicts(pages: DataFrame) -> DataFrame:
    """Every page judged as of its fetch time; times as text, so that both engines print them alike."""
    spark = pages.sparkSession
    captures = spark.sql(_filled(CAPTURES_SQL, *SPARK_TIMES).replace("FROM pages", "FROM {pages}"), pages=pages)
    entries = spark.sql(_filled(LISTS_SQL, *SPARK_TIMES).replace("FROM pages", "FROM {pages}"), pages=pages)
    shown = [F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("fetched_at", "since")]
    return judged(captures, entries).select("page_id", "url", shown[0], "verdict", "pattern", "n_lists", shown[1])


ORACLE = f"""
WITH captures AS ({_filled(CAPTURES_SQL, *DUCK_TIMES)}),
entries AS ({_filled(LISTS_SQL, *DUCK_TIMES)}),
dated AS (
  SELECT list_name, rtrim(pattern, '/') AS pattern, listed_at,
    max(CASE action WHEN 'block' THEN 2 WHEN 'allow' THEN 1 ELSE 0 END) AS mode
  FROM entries GROUP BY ALL),
valid AS (
  SELECT *, lead(listed_at) OVER (PARTITION BY list_name, pattern ORDER BY listed_at) AS until FROM dated),
asked AS (
  SELECT *, regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://([^/:?#]+)', 1) AS host,
    regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path
  FROM captures),
keys AS (
  SELECT page_id, url, fetched_at, host AS pattern FROM asked
  UNION ALL SELECT page_id, url, fetched_at, regexp_extract(host, '([^.]+[.][^.]+)$', 1) FROM asked WHERE regexp_matches(host, '[.].+[.]')
  UNION ALL SELECT page_id, url, fetched_at, regexp_extract(host, '([^.]+[.][^.]+[.][^.]+)$', 1) FROM asked WHERE regexp_matches(host, '[.].+[.].+[.]')
  UNION ALL SELECT page_id, url, fetched_at, host || '/' || split_part(path, '/', 2) FROM asked WHERE split_part(path, '/', 2) <> ''),
states AS (
  SELECT k.page_id, k.url, k.fetched_at, k.pattern,
    sum(CASE WHEN v.mode = 2 THEN 1 ELSE 0 END) AS n_block, sum(CASE WHEN v.mode = 1 THEN 1 ELSE 0 END) AS n_allow
  FROM keys k JOIN valid v ON v.pattern = k.pattern AND v.mode > 0 AND v.listed_at <= k.fetched_at
    AND (v.until IS NULL OR k.fetched_at < v.until)
  GROUP BY ALL),
changes AS (
  SELECT s.page_id, s.pattern, max(c.at) AS since
  FROM states s JOIN (SELECT DISTINCT pattern, listed_at AS at FROM valid WHERE mode > 0
    UNION SELECT DISTINCT pattern, until FROM valid WHERE mode > 0 AND until IS NOT NULL) c
    ON c.pattern = s.pattern AND c.at <= s.fetched_at
  GROUP BY ALL),
ranked AS (
  SELECT s.*, c.since, row_number() OVER (PARTITION BY s.page_id
    ORDER BY CASE WHEN contains(s.pattern, '/') THEN 1 ELSE 0 END DESC, length(s.pattern) DESC, s.pattern DESC) AS place
  FROM states s JOIN changes c ON c.page_id = s.page_id AND c.pattern = s.pattern)
SELECT a.page_id, a.url, strftime(a.fetched_at, '%Y-%m-%d %H:%M:%S') AS fetched_at,
  CASE WHEN r.pattern IS NULL THEN 'none' WHEN r.n_allow > 0 THEN 'allow' ELSE 'block' END AS verdict,
  r.pattern, CAST(coalesce(CASE WHEN r.n_allow > 0 THEN r.n_allow ELSE r.n_block END, 0) AS BIGINT) AS n_lists,
  strftime(r.since, '%Y-%m-%d %H:%M:%S') AS since
FROM asked a LEFT JOIN ranked r ON r.page_id = a.page_id AND r.place = 1
"""
