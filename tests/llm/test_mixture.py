"""The mix against the targets' definition, its law, and DuckDB."""

import random
from collections import defaultdict

import duckdb
import pandas as pd
import pytest

from carespan.llm import mixture
from carespan.llm.storage import documents
from oracle import compare, connect


def filled(sizes):
    """Targets of sources in order: share by weight again and again until none is above its most."""
    weights = [mixture.WEIGHTS[k % 3] for k in range(len(sizes))]
    targets, full = [0.0] * len(sizes), set()
    while True:
        left = 1.5 * sum(sizes) - sum(2 * sizes[k] for k in full)
        open_ = [k for k in range(len(sizes)) if k not in full]
        total = sum(weights[k] for k in open_)
        over = [k for k in open_ if weights[k] * left / total > 2 * sizes[k]]
        if not over:
            for k in open_:
                targets[k] = weights[k] * left / total
            return [float(2 * sizes[k]) if k in full else targets[k] for k in range(len(sizes))]
        full.update(over)


def rows_of(seed, n):
    rng = random.Random(seed)
    names = ["hot"] * 6 + ["é", "b", "Z", "", None, "empty"]
    rows = [(k, "w " * (0 if (s := rng.choice(names)) == "empty" else int(rng.paretovariate(1.2))), s) for k in range(n)]
    return rows + [(None, "one two", "b"), (90_003, None, "b"), (90_004, "a\x0bb\x85c d", "b"), (90_004, "a\x0bb\x85c d", "b"), (90_005, "w " * 30_000, "hot")]


def frames(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_targets_and_law(spark):
    rows = rows_of(1, 4000)
    got = mixture.taken_words(frames(spark, rows).repartition(7)).collect()
    assert sorted((r.doc_id or -1, r.size) for r in got) == sorted((d or -1, len((t or "").replace("\x0b", " ").split(" ")) - (t or " ").endswith(" ")) for d, t, _ in rows)
    sizes, targets, largest = defaultdict(int), {}, defaultdict(int)
    by_id = {d: s for d, _, s in rows if d is not None}
    taken = defaultdict(int)
    for r in got:
        s = by_id.get(r.doc_id, "b") if r.doc_id is not None else "b"
        sizes[s], targets[s], taken[s] = r.source_size, r.target, taken[s] + r.taken
        largest[s] = max(largest[s], r.size)
        assert r.taken in (0, r.size, 2 * r.size)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    assert [targets[s] for s in order] == pytest.approx(filled([sizes[s] for s in order]))
    assert all(abs(taken[s] - targets[s]) <= max(2 * largest[s], 0.05 * targets[s]) for s in order)


def test_same_mix_again_and_as_rows(spark):
    docs = frames(spark, rows_of(2, 800))
    first, second = (sorted(map(tuple, mixture.taken_words(d).collect()), key=str) for d in (docs, docs.repartition(9)))
    assert first == second
    mix = mixture.mixed(docs)
    assert mix.columns == docs.columns
    words = sum(len((r.text or "").replace("\x0b", " ").split()) for r in mix.collect() if "\x85" not in (r.text or ""))
    assert words == sum(r[4] for r in first) - 3 * sum(1 for r in mix.collect() if "\x85" in (r.text or ""))


def test_clashing_names_and_no_rows(spark):
    docs = frames(spark, rows_of(3, 50)).selectExpr("*", "1 AS size", "2 AS base", "3 AS copies", "'x' AS target", "4 AS `a.b`")
    assert mixture.mixed(docs).columns == docs.columns and mixture.mixed(docs).count() > 0
    assert mixture.taken_words(docs.where("false")).count() == 0
    assert mixture.taken_words(frames(spark, [(1, None, None)])).collect() == [(1, 0, 0, 0.0, 0)]


def test_matches_sql(spark):
    assert compare(mixture.taken_words(documents(spark, "/root/testdata/sf0.001")), connect("/root/testdata/sf0.001"), mixture.ORACLE) is None
    rows = [r for r in rows_of(4, 1500) if r[0] != 90_004]
    duck = duckdb.connect()
    duck.register("documents", pd.DataFrame(rows, columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"}))
    assert compare(mixture.taken_words(frames(spark, rows)), duck, mixture.ORACLE) is None
