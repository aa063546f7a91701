"""Held-out accuracy, the compiled rules against numpy, and what may not be learnt from."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from carespan.llm import rule_ensemble
from carespan.llm.storage import documents

FOLDER = "/root/testdata/sf0.01"


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    got = rule_ensemble.quality_scores(documents(spark, FOLDER), labels).collect()
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.held_out == held_out(r.doc_id) for r in got)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    tested = [(r.score, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    good, bad = ([s for s, q in tested if q == k] for k in (1, 0))
    area = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert len(bad) > 5 and area > 0.97 and np.mean([(s >= 0.5) == q for s, q in tested]) > 0.93


def test_held_out_labels_change_nothing(spark):
    docs, labels = documents(spark, FOLDER), spark.read.parquet(f"{FOLDER}/labels.parquet")
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    first, second = (sorted(map(tuple, rule_ensemble.quality_scores(docs.repartition(3), x).collect())) for x in (labels, turned))
    assert first == second


def test_compiled_rules(spark):
    stats = rule_ensemble.statistics(documents(spark, FOLDER))
    model = rule_ensemble.fit(stats, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    rows = stats.select(*rule_ensemble.STATISTICS, model.column().alias("score")).toPandas()
    assert 1 < len(model.rules) < 150 and all(len(r) <= rule_ensemble.DEPTH for r, _ in model.rules)
    np.testing.assert_allclose(rows["score"], model.score(rows[list(rule_ensemble.STATISTICS)].to_numpy()), rtol=1e-9)


def test_lasso_is_a_minimum():
    rng = np.random.default_rng(3)
    a = (rng.random((400, 6)) < 0.4).astype(float)
    y = (rng.random(400) < 1 / (1 + np.exp(-(2 * a[:, 0] - 2 * a[:, 1])))).astype(float)
    b, w = rule_ensemble.lasso(a, y)
    scale = np.maximum(a.std(axis=0), 0.05)

    def loss(b, w):
        margin = a @ w + b
        return np.mean(np.log1p(np.exp(margin)) - y * margin) + rule_ensemble.PENALTY * np.abs(w * scale).sum()

    for k in range(7):
        for move in (-1e-3, 1e-3):
            assert loss(b + move * (k == 6), w + move * (np.arange(6) == k)) >= loss(b, w) - 1e-9


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "x y"), (3, "w " * 200_000), (3, "w " * 200_000)], "doc_id long, text string").withColumn("label", F.lit(5)).withColumn("words", F.lit(5))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (3, None, 0), (None, 0, 0), (9, 0, 1)], none.schema)
    for labels, score in ((none, 0.5), (some, None)):
        got = rule_ensemble.quality_scores(docs, labels).collect()
        assert len(got) == 5 and all(r.score == score or score is None and 0 <= r.score <= 1 for r in got)
    assert rule_ensemble.quality_scores(docs.where("false"), some).count() == 0
