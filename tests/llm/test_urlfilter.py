import datetime

from pyspark.sql import functions as F

from topictables.llm import urlfilter as u

HISTORY = "list string, kind string, pattern string, effect string, action string, at int"
CAPTURES = "page_id long, url string, at int, kind string, list string, id string"


def brute(url, at, valid):
    """Entries in force for one capture, most specific first."""
    rest = url.partition("://")[2] if "://" in url else ""
    host = rest.split("/")[0].split("?")[0].split("#")[0].split("@")[-1].split(":")[0].lower()
    path = "/".join(s for s in rest[len(rest.split("/")[0].split("?")[0].split("#")[0]) :].split("?")[0].split("#")[0].split("/") if s)
    hits = []
    for name, kind, pattern, effect, start, end in valid:
        if not host or at is None or not (start <= at and (end is None or at < end)):
            continue
        if kind == "host" and pattern == host or kind == "domain" and (host == pattern or host.endswith("." + pattern)) or kind == "prefix" and f"{host}/{path}/".startswith(pattern + "/"):
            hits.append((-u.KINDS[kind], -len(pattern), effect, name, pattern, start))
    return sorted(hits)


def test_intervals(spark):
    rows = [("l", "host", "a", "block", *x) for x in [("add", 1), ("add", 3), ("remove", 5), ("remove", 6), ("add", 8), ("remove", 8), ("remove", 9), ("add", 12), ("add", 12)]]
    rows += [("l", "host", "b", "block", "remove", 2), ("l", "host", None, "block", "add", 1), ("l", "host", "c", "block", "add", None), ("l", "host", "c", "block", "other", 1), ("l", "host", "d", None, "add", 4)]
    got = u.intervals(spark.createDataFrame(rows, HISTORY)).select("pattern", "valid_from", "valid_to").collect()
    assert sorted(map(tuple, got), key=str) == [("a", 1, 5), ("a", 12, None), ("a", 8, 9), ("d", 4, None)]


def test_as_of_join_matches_brute_force(spark):
    history = [("l", "domain", "example.com", "block", "add", 5), ("l", "domain", "example.com", "block", "remove", 20), ("l", "domain", "com", "block", "add", 18), ("m", "host", "www.example.com", "allow", "add", 10), ("m", "host", "www.example.com", "allow", "remove", 15), ("k", "prefix", "www.example.com/a", "block", "add", 12), ("k", "prefix", "www.example.com/a/b", "allow", "add", 12), ("n", "host", "www.example.com", "block", "add", 10), ("z", "other", "www.example.com", "block", "add", 0)]
    urls = ["http://www.example.com/a/b/c?q#f", "https://user@WWW.example.com:80/a//b", "http://www.example.com/ab", "http://notexample.com/", "ftp://example.com", "http://www.example.com?x=/a/b", "no url", "", None, "http:///path", "http://sub.www.example.com/a"]
    captures = [(i * 100 + t, url, t) for i, url in enumerate(urls) for t in (0, 5, 11, 13, 18, 19, 25)]
    captures += [(1, urls[0], None), captures[3], (None, urls[0], 13), (None, None, None)]
    frame = spark.createDataFrame([(*c, "x", "y", "z") for c in captures], CAPTURES)
    valid = u.intervals(spark.createDataFrame(history, HISTORY))
    entries = [tuple(r) for r in valid.select("list", "kind", "pattern", "effect", "valid_from", "valid_to").collect() if r["kind"] in u.KINDS]
    expected = []
    for key, url, at in captures:
        hits = brute(url or "", at, entries)
        top = hits[0] if hits else None
        expected.append((key, url, at, len(hits), bool(top) and top[2] == "block", top and top[4], top and top[3], top and top[5]))
    got = u.evaluate(frame, valid, "page_id", "url", "at").select("id", "url", "fetched", "n_active", "blocked", "pattern", "list", "valid_from").collect()
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    assert any(e[4] for e in expected) and any(e[3] and not e[4] for e in expected)


def test_empty_tables_and_no_python(spark):
    captures = spark.createDataFrame([(1, "http://a/", 1, "x", "y", "z")], CAPTURES)
    none = u.intervals(spark.createDataFrame([], HISTORY))
    found = u.evaluate(captures, none, "page_id", "url", "at")
    assert [(r["n_active"], r["blocked"]) for r in found.collect()] == [(0, False)]
    assert u.evaluate(captures.where(F.lit(False)), none, "page_id", "url", "at").count() == 0
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
