"""Greedy string tiling against a plain search for the longest common run, again and again."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from carespan.llm import decontaminate


def plain_tiles(item, text, shortest=5):
    """Sizes of tiles: mark the longest common unmarked run (first in item, then text) until it is too short."""
    a, b, out = [False] * len(item), [False] * len(text), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while i + n < len(item) and j + n < len(text) and not a[i + n] and not b[j + n] and item[i + n] == text[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < shortest:
            return out
        a[i : i + n] = b[j : j + n] = [True] * n
        out.append((i, j, n))


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        for item_id, passage in items:
            x, y = words(passage), words(text)
            if not x:
                continue
            if len(x) < 5:
                marks = [(0, 0, len(x))] if any(y[j : j + len(x)] == x for j in range(len(y))) else []
            else:
                marks = plain_tiles(x, y)
            n = sum(k for _, _, k in marks)
            if marks and n >= decontaminate.COVERAGE * len(x):
                out.append((doc_id, item_id, len(x), n, len(marks), max(k for _, _, k in marks), n / len(x)))
    return sorted(out, key=str)


def fixture(seed):
    rng = random.Random(seed)
    some = lambda n: [rng.choice("abcdefgh") + str(rng.randrange(6)) for _ in range(n)]
    items = [(k, some(rng.randint(3, 40))) for k in range(14)] + [(14, ["x1"] * 12), (15, ["x1", "x2"] * 10)]
    docs = []
    for k in range(70):
        parts = []
        for _, w in rng.sample(items, 2):
            cut = sorted(rng.sample(range(len(w) + 1), 2)) if rng.random() < 0.6 else [0, len(w)]
            pieces = [w[: cut[0]], w[cut[0] : cut[1]], w[cut[1] :]]
            rng.shuffle(pieces)
            parts += [p + some(rng.randint(0, 4)) for p in pieces[: rng.randint(1, 3)]]
        docs.append((k, " ".join(some(5) + [w.upper() if rng.random() < 0.1 else w for p in parts for w in p])))
    return docs, [(k, " ".join(w)) for k, w in items]


def run(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("z"))
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("block", F.lit("z"))
    got = sorted((tuple(r) for r in decontaminate.leaks(d, b).collect()), key=str)
    clean = decontaminate.without_leaks(d, b)
    assert clean.columns == d.columns
    leaky = {r[0] for r in got}
    assert sorted(r.doc_id for r in clean.collect() if r.doc_id is not None) == sorted(k for k, _ in docs if k is not None and k not in leaky)
    return got


def test_leaks(spark, monkeypatch):
    docs, items = fixture(3)
    want = brute(docs, items)
    assert len(want) > 30 and any(r[4] > 1 for r in want)
    assert run(spark, docs, items) == want
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 200)
    assert run(spark, docs, items) == want


def test_tiles_are_greedy():
    rng = random.Random(6)
    for _ in range(150):
        item, text = ([rng.randrange(3) for _ in range(rng.randint(5, 40))] for _ in range(2))
        got = decontaminate.tiles(np.array(item, np.uint64) + np.uint64(9), np.array(text, np.uint64) + np.uint64(9))
        want = plain_tiles(item, text)
        assert sorted((n for _, _, n in got), reverse=True) == [n for _, _, n in want]


def test_odd_rows(spark):
    items = [(1, "one two three four five six seven eight"), (2, None), (3, " "), (4, "alpha beta"), (None, "k l m n o p"), (1, "one two three four five six seven eight")]
    docs = [(1, None), (2, ""), (None, "x k L m n o p"), (3, "seven eight one two three four five six"), (3, "seven eight one two three four five six"), (4, "Alpha BETA"), (5, "w " * 100_000 + items[0][1])]
    assert run(spark, docs, items) == brute(docs, items)
    assert run(spark, docs, []) == [] and run(spark, [], items) == []


def test_real_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    got = decontaminate.leaks(docs, items).collect()
    seeds = {r.item_id: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for r in items.collect() for w in [words(r.text)]}
    share = {}
    for r in docs.collect():
        w = words(r.text)
        own = {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
        share |= {(r.doc_id, k): len(own & s) / len(s) for k, s in seeds.items()}
    assert {(r.doc_id, r.item_id) for r in got} == {k for k, v in share.items() if v > 0.55}
