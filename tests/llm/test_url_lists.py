"""Captures against the lists' entries, one capture and entry after another, and DuckDB."""

import random
from datetime import datetime, timedelta
from urllib.parse import urlsplit

from pyspark.sql import functions as F

from carespan.llm import url_lists
from oracle import compare, connect

START = datetime(2024, 1, 1)


def brute(captures, entries):
    out = []
    for page_id, url, at in captures:
        parts = urlsplit((url or "").lower())
        host, path = (parts.hostname or "").rstrip("."), parts.path.rstrip("/")
        labels = host.split(".")
        own = {("domain", ".".join(labels[k:])) for k in range(max(len(labels) - 1, 1))} | {("url", host + path)}
        own |= {("prefix", f"{host}/{path.split('/')[1]}")} if path and host else set()
        active = []
        for name, kind, pattern in {e[:3] for e in entries if None not in e and host and at}:
            if (kind, pattern.lower()) in own:
                past = sorted((t, a) for n, k, p, a, t in entries if None not in (n, k, p, a, t) and (n, k, p.lower()) == (name, kind, pattern.lower()) and t <= at)
                if past and past[-1][1] == "add":
                    active.append((name, kind, pattern.lower()))
        active = set(active)
        out.append((page_id, url, host, at, bool(active), len(active), ",".join(sorted({a[0] for a in active}))))
    return sorted(out, key=str)


def run(spark, captures, entries):
    c = spark.createDataFrame(captures, "page_id long, url string, fetched_at timestamp").withColumn("list", F.lit("x")).withColumn("spans", F.lit(1))
    e = spark.createDataFrame(entries, "list string, kind string, pattern string, action string, effective_at timestamp").withColumn("url", F.lit("x"))
    return sorted(map(tuple, url_lists.filtered(c, e).collect()), key=str)


def fixture(seed):
    rng = random.Random(seed)
    hosts = ["a.example.com", "b.a.example.com", "EXAMPLE.com", "c.net", "localhost", "x.co.uk."]
    paths = ["", "/", "/en", "/en/1", "/en/1/", "/De/2.html"]
    captures = [(k, f"http{rng.choice(['', 's'])}://{rng.choice(['', 'u:p@'])}{rng.choice(hosts)}{rng.choice(['', ':8080'])}{rng.choice(paths)}{rng.choice(['', '?q=/x', '#top'])}",
                 START + timedelta(hours=rng.randint(0, 60))) for k in range(120)]
    patterns = [("domain", "example.com"), ("domain", "a.example.com"), ("domain", "net"), ("domain", "localhost"), ("prefix", "c.net/en"), ("url", "c.net/en/1"), ("url", "example.com"), ("domain", "co.uk")]
    entries = [(rng.choice(["l1", "l2"]), *rng.choice(patterns), rng.choice(["add", "add", "remove"]), START + timedelta(hours=rng.randint(0, 60))) for _ in range(60)]
    return captures, entries


def test_captures_as_of_their_time(spark):
    captures, entries = fixture(1)
    got = run(spark, captures, entries + entries[:5])
    assert got == brute(captures, entries) and {r[4] for r in got} == {True, False}


def test_odd_rows(spark):
    captures, entries = fixture(2)
    captures += [(None, None, START), (1, "not a url", START), (2, "http://", START), (3, captures[0][1], None), captures[0], captures[0]]
    entries += [(None, "domain", "c.net", "add", START), ("l1", "domain", None, "add", START), ("l3", "domain", "C.net", "add", START + timedelta(hours=9)), ("l3", "domain", "c.net", "remove", START + timedelta(hours=9))]
    assert run(spark, captures, entries) == brute(captures, entries)
    assert not any(r[4] for r in run(spark, captures, [])) and run(spark, [], entries) == []


def test_matches_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert compare(url_lists.op5_temporal_url_lists(spark, folder), connect(folder), url_lists.ORACLE) is None
