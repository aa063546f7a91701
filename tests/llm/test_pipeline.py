"""The pipeline against its stages' plain counterparts, one after another."""

from collections import Counter, defaultdict

import duckdb
import pandas as pd

import corpus_pipeline
from carespan.llm import mixture
from test_decontaminate import words
from test_ngram_join import brute as components
from test_quality_rules import brute as rules
from test_token_files import whole

FOLDER = "/root/testdata/sf0.001"


def test_stages_and_run(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("n_chars < 4000")
    rows = {r.doc_id: r for r in docs.collect()}
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["quality", "near_copies", "leaks", "mix", "tokens"]

    good = stage["quality"](spark, docs, FOLDER)
    left = [k for k in sorted(rows) if rules(rows[k].text)[-1]]
    assert good.columns == docs.columns and sorted(r.doc_id for r in good.collect()) == left and len(left) < len(rows)

    single = stage["near_copies"](spark, good, FOLDER)
    found = components([(k, rows[k].text) for k in left])
    left = [k for k, (_, c) in zip(left, found) if k == c]
    assert single.columns == docs.columns and sorted(r.doc_id for r in single.collect()) == left

    clean = stage["leaks"](spark, single, FOLDER)
    items = [words(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    seeds = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in items]
    own = {k: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for k in left for w in [words(rows[k].text)]}
    left = [k for k in left if not any(len(own[k] & s) > 0.55 * len(s) for s in seeds)]
    assert clean.columns == docs.columns and sorted(map(tuple, clean.collect())) == [tuple(rows[k]) for k in left]

    mix = stage["mix"](spark, clean, FOLDER)
    duck = duckdb.connect()
    duck.register("documents", pd.DataFrame([rows[k].asDict() for k in left]))
    times = Counter({r[0]: r[4] // max(r[1], 1) for r in duck.execute(mixture.ORACLE).fetchall()})
    assert mix.columns == docs.columns and Counter(r.doc_id for r in mix.collect()) == +times

    out = stage["tokens"](spark, mix, FOLDER)
    want = whole([(k, rows[k].text) for k in times.elements()])
    assert sorted(map(tuple, out.collect()), key=lambda r: r[1]) == want


def test_one_of_each_of_odd_rows(spark):
    near = " ".join(f"w{i}" for i in range(60))
    rows = [(1, None, "a"), (1, None, "a"), (2, "", "a"), (None, near, "b"), (None, near, "b"), (3, near + " x", None), (7, near, "c"), (7, near, "c"),
            (9, "q r s t u v", "d"), (9, "other words under the same id", "d"), (None, "alone here", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = [tuple(r) for r in corpus_pipeline.near_copies(spark, docs, "").collect()]
    kept = defaultdict(int)
    for r in out:
        kept[r] += 1
    assert kept == {(1, None, "a"): 1, (2, "", "a"): 1, (3, near + " x", None): 1, rows[8]: 1, rows[9]: 1, rows[10]: 1}


def test_run_has_rows_and_no_rows_do_no_harm(spark, tmp_path):
    assert corpus_pipeline.run(spark, FOLDER).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    for table in ("documents", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{table}.parquet").where("false").write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
