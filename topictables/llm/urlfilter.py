"""URL filters: dated list entries as validity intervals, joined with captures as of their fetch time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topictables.llm.common import table

#: Kinds of entries and how specific they are: a domain covers its subdomains, a prefix is a host and the
#: first directories of its paths.
KINDS = {"domain": 1, "host": 2, "prefix": 3}


def host(url: Column) -> Column:
    """Host of a URL in lower case; empty without one."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def intervals(history: DataFrame) -> DataFrame:
    """(list, kind, pattern, effect, valid_from, valid_to) out of dated changes (list, kind, pattern,
    effect, action, at) with action `add` or `remove`.

    An entry is valid from its addition to before its next removal; valid_to is null while it lasts.
    Additions of what is there, and removals of what is not, change nothing; at one moment an addition
    counts over a removal. Changes with a null in any column but effect, or another action, are ignored.
    """
    entry = ["list", "kind", "pattern", "effect"]
    told = history.where(F.col("list").isNotNull() & F.col("kind").isNotNull() & F.col("pattern").isNotNull() & F.col("at").isNotNull() & F.col("action").isin("add", "remove"))
    states = told.groupBy(*entry, "at").agg(F.max(F.col("action") == "add").alias("on"))
    in_time = Window.partitionBy(*entry).orderBy("at")
    changes = states.withColumn("before", F.lag("on", 1, False).over(in_time)).where(F.col("on") != F.col("before"))
    return changes.withColumn("valid_to", F.lead("at").over(in_time)).where("on").select(*entry, F.col("at").alias("valid_from"), "valid_to")


def keys(url: Column) -> Column:
    """Array of (kind, pattern) that entries for this URL can have: its host, each domain above it and
    itself, and each directory of its path, the full path too."""
    labels = F.split(host(url), r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.struct(F.lit("domain").alias("kind"), F.concat_ws(".", F.slice(labels, i, F.size(labels))).alias("pattern")))
    steps = F.filter(F.split(path(url), "/"), lambda s: s != "")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda i: F.struct(F.lit("prefix").alias("kind"), F.concat(host(url), F.lit("/"), F.concat_ws("/", F.slice(steps, F.lit(1), i))).alias("pattern")))
    own = F.array(F.struct(F.lit("host").alias("kind"), host(url).alias("pattern")))
    return F.concat(own, domains, F.when(F.size(steps) > 0, prefixes).otherwise(F.slice(own, 1, 0)))


def evaluate(captures: DataFrame, valid: DataFrame, id_column: str, url_column: str, time_column: str) -> DataFrame:
    """(id, url, fetched, n_active, blocked, kind, pattern, list, valid_from) of every capture.

    An as-of join: an entry counts if the capture was fetched while it was valid. n_active is the number
    of such entries. The most specific decides (prefix, host, domain; then the longest pattern); among
    equals `allow` counts over `block`, then the order of list and time. Null or malformed URLs and null
    times match nothing and are not blocked. Captures that repeat are returned as often; other columns
    are ignored. Equal captures are evaluated once. The join is on the exact pattern, so a hot host
    meets only its own few entries, and adaptive execution splits it.
    """
    source = captures.select(F.col(id_column).alias("id"), F.col(url_column).alias("url"), F.col(time_column).alias("fetched"))
    once = source.groupBy("id", "url", "fetched").agg(F.count("*").alias("copies"))
    wanted = once.where("url is not null and fetched is not null").where(host(F.col("url")) != "").select("id", "url", "fetched", F.explode(keys(F.col("url"))).alias("key"))
    wanted = wanted.select("id", "url", "fetched", F.col("key.kind").alias("kind"), F.col("key.pattern").alias("pattern"))
    active = wanted.join(valid, ["kind", "pattern"]).where((F.col("fetched") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("fetched") < F.col("valid_to"))))
    rank = F.element_at(F.create_map(*(x for k, v in KINDS.items() for x in (F.lit(k), F.lit(v)))), F.col("kind"))
    order = F.struct((-rank).alias("rank"), (-F.length("pattern")).alias("length"), "effect", "list", "pattern", "valid_from", "kind")
    best = active.where(F.col("kind").isin(*KINDS)).groupBy(F.col("id").alias("of_id"), F.col("url").alias("of_url"), F.col("fetched").alias("of_time")).agg(F.count("*").alias("n_active"), F.min(order).alias("best"))
    same = F.col("id").eqNullSafe(F.col("of_id")) & (F.col("url") == F.col("of_url")) & (F.col("fetched") == F.col("of_time"))
    found = once.join(best, same, "left").select(
        "id", "url", "fetched", F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"),
        F.coalesce(F.col("best.effect") == "block", F.lit(False)).alias("blocked"), "best.kind", "best.pattern", "best.list", "best.valid_from",
        F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"),
    )
    return found.drop("copy")


def _number(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("int")


def history_of(pages: DataFrame) -> DataFrame:
    """A list's history made from the pages: which hosts, domains and directories are on it, and when,
    follows from hashes of their names."""
    day = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), n.cast("int"))
    urls = pages.select(host(F.col("url")).alias("host"), F.split(path(F.col("url")), "/").alias("steps")).where("host != ''")
    hosts = urls.select("host").distinct()
    n = F.col("n")
    by_host = hosts.select(F.col("host").alias("pattern"), _number(F.col("host")).alias("n")).where("n % 3 = 0")
    start = n % 300
    host_changes = [("add", start, F.lit(True)), ("remove", start + 20 + n % 60, n % 2 == 0), ("add", start + 150, n % 4 == 0)]
    domains = hosts.select(F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1).alias("pattern")).where("pattern != ''").distinct().select("pattern", _number(F.col("pattern")).alias("n"))
    folders = urls.where(F.size("steps") > 2).select(F.concat_ws("/", "host", F.get("steps", F.lit(1))).alias("pattern")).distinct().select("pattern", _number(F.col("pattern")).alias("n")).where("n % 5 = 0")

    def changes(df: DataFrame, name: str, kind: str, effect: str, steps: list) -> DataFrame:
        rows = F.array(*(F.when(on, F.struct(F.lit(action).alias("action"), day(at).alias("at"))) for action, at, on in steps))
        return df.select(F.lit(name).alias("list"), F.lit(kind).alias("kind"), "pattern", F.lit(effect).alias("effect"), F.inline(F.filter(rows, lambda r: r.isNotNull())))

    return (
        changes(by_host, "hosts", "host", "block", host_changes)
        .unionByName(changes(domains, "domains", "domain", "block", [("add", n % 100, F.lit(True)), ("remove", n % 100 + 60 + n % 30, F.lit(True))]))
        .unionByName(changes(folders, "exceptions", "prefix", "allow", [("add", n % 200, F.lit(True))]))
    )


def op5_url_filter_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") * 37 % 365).cast("int")))
    return evaluate(captures, intervals(history_of(pages)), "page_id", "url", "fetched").withColumnRenamed("id", "page_id")


ORACLE = r"""
WITH p AS (
    SELECT page_id, url, DATE '2024-01-01' + CAST(page_id * 37 % 365 AS INTEGER) AS fetched,
           lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
           string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/') AS steps
    FROM pages
), h AS (SELECT DISTINCT host AS pattern, CAST('0x' || substr(md5(host), 1, 7) AS INTEGER) AS n FROM p WHERE host <> ''
), d AS (
    SELECT DISTINCT pattern, CAST('0x' || substr(md5(pattern), 1, 7) AS INTEGER) AS n
    FROM (SELECT regexp_extract(pattern, '([^.]+\.[^.]+)$', 1) AS pattern FROM h) WHERE pattern <> ''
), f AS (
    SELECT DISTINCT pattern, CAST('0x' || substr(md5(pattern), 1, 7) AS INTEGER) AS n
    FROM (SELECT host || '/' || steps[2] AS pattern FROM p WHERE host <> '' AND len(steps) > 2)
), e AS (
    SELECT 'hosts' AS list, 'host' AS kind, pattern, 'block' AS effect, 'add' AS action, n % 300 AS moment FROM h WHERE n % 3 = 0
    UNION ALL SELECT 'hosts', 'host', pattern, 'block', 'remove', n % 300 + 20 + n % 60 FROM h WHERE n % 3 = 0 AND n % 2 = 0
    UNION ALL SELECT 'hosts', 'host', pattern, 'block', 'add', n % 300 + 150 FROM h WHERE n % 3 = 0 AND n % 4 = 0
    UNION ALL SELECT 'domains', 'domain', pattern, 'block', 'add', n % 100 FROM d
    UNION ALL SELECT 'domains', 'domain', pattern, 'block', 'remove', n % 100 + 60 + n % 30 FROM d
    UNION ALL SELECT 'exceptions', 'prefix', pattern, 'allow', 'add', n % 200 FROM f WHERE n % 5 = 0
), s AS (
    SELECT list, kind, pattern, effect, moment, max(CASE WHEN action = 'add' THEN 1 ELSE 0 END) AS state
    FROM e GROUP BY ALL
), c AS (
    SELECT *, coalesce(lag(state) OVER w, 0) AS before FROM s WINDOW w AS (PARTITION BY list, kind, pattern, effect ORDER BY moment)
), v AS (
    SELECT list, kind, pattern, effect, DATE '2024-01-01' + moment AS valid_from,
           DATE '2024-01-01' + lead(moment) OVER (PARTITION BY list, kind, pattern, effect ORDER BY moment) AS valid_to, state
    FROM c WHERE state <> before
), a AS (
    SELECT p.page_id, p.url, p.fetched, v.*
    FROM p JOIN v ON v.state = 1 AND p.host <> '' AND p.fetched >= v.valid_from AND (v.valid_to IS NULL OR p.fetched < v.valid_to)
     AND ((v.kind = 'host' AND v.pattern = p.host)
       OR (v.kind = 'domain' AND (v.pattern = p.host OR ends_with(p.host, '.' || v.pattern)))
       OR (v.kind = 'prefix' AND starts_with(p.host || '/' || array_to_string(list_filter(p.steps, lambda x: x <> ''), '/') || '/', v.pattern || '/')))
), r AS (
    SELECT *, count(*) OVER (PARTITION BY page_id) AS n_active,
           row_number() OVER (PARTITION BY page_id ORDER BY CASE kind WHEN 'prefix' THEN 1 WHEN 'host' THEN 2 ELSE 3 END, -length(pattern), effect, list, pattern, valid_from) AS k
    FROM a
)
SELECT p.page_id, p.url, p.fetched, coalesce(r.n_active, 0) AS n_active, coalesce(r.effect = 'block', false) AS blocked,
       r.kind, r.pattern, r.list, r.valid_from
FROM p LEFT JOIN r ON r.page_id = p.page_id AND r.k = 1
"""
