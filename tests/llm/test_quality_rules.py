"""Repetition rules against counting by hand, and longest repeats against comparing all pairs."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from carespan.llm import quality_rules


def common_length(words, i, j):
    n = 0
    while j + n < len(words) and words[i + n] == words[j + n]:
        n += 1
    return n


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    longest = [max((common_length(words, min(i, j), max(i, j)) for j in range(n) if j != i), default=0) for i in range(n)]
    repeated, united = set(), set()
    for i, k in enumerate(longest):
        if k >= 5:
            repeated.update(range(i, i + 5))
        if k >= quality_rules.MIN_REPEAT:
            united.update(range(i, i + k))
    chars = sum(map(len, words))
    inside = sum(len(words[i]) for i in united)
    top = max([k for k in longest if k >= 5], default=0)
    failed = n < 10 or 100 * len(repeated) > 20 * n
    good = not failed and inside <= quality_rules.MAX_COVERED * chars and top <= quality_rules.MAX_REPEAT
    return (n, chars, len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated), inside, top, failed, good)


def texts_to_judge():
    rng = random.Random(4)
    out = [None, "", " \n ", "a b c", "De " * 40, "x " * 9 + "y", "a\n\nb\na\n a\nb", "Ä#ß | ñ $$ <b> & * %", "one\x0btwo\x85three\xa0four"]
    for _ in range(60):
        words = ["".join(rng.choices("abcé", k=rng.randint(1, 3))) for _ in range(rng.randint(5, 120))]
        for _ in range(rng.randint(0, 3)):
            i, k = rng.randrange(len(words)), rng.randint(3, 30)
            words[rng.randrange(len(words)) : 0] = words[i : i + k]
        out.append(re.sub(" ", lambda _: rng.choice(" \n\t "), " ".join(words)))
    base = [f"w{i}" for i in range(900)]
    out += [" ".join(base + base[100:201]), " ".join(base + base[100:200]), " ".join(base[:80] + base[:12]), " ".join(base * 300)]
    return out


def test_measures_and_verdicts(spark):
    rows = list(enumerate(texts_to_judge()[:-1]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit("no"))
    got = {r[0]: tuple(r[1:]) for r in quality_rules.repetition_rules(docs).collect()}
    assert got == {i: brute(t) for i, t in rows}
    assert {x[-1] for x in got.values()} == {True, False} and any(not x[-2] and not x[-1] for x in got.values())
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, x in got.items() if x[-1])


def test_long_repeated_null_and_no_rows(spark):
    long = texts_to_judge()[-1]
    rows = [(None, long), (1, long), (1, long), (2, " ".join(f"w{i}" for i in range(200_000)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in quality_rules.repetition_rules(docs).collect()]
    assert [r[1] for r in got] == [270_000] * 3 + [200_000] and [r[-1] for r in got] == [False] * 3 + [True]
    assert got[0][7] == 270_000 - 900
    empty = docs.where("false")
    assert quality_rules.repetition_rules(empty).count() == 0 and quality_rules.keep_good(empty).count() == 0


def test_longest_repeats_by_pairs():
    rng = random.Random(8)
    words = [rng.randrange(3) for _ in range(160)]
    rows = np.sort(np.array([rng.randrange(4) for _ in words]))
    at, best = quality_rules.longest_repeats(np.array(words, np.uint64), rows, np.ones(160, bool))
    for i in range(160):
        own = [w if r == rows[i] else (w, k) for k, (w, r) in enumerate(zip(words, rows))]
        assert best[i] == max((common_length(own, min(i, j), max(i, j)) for j in range(160) if j != i and rows[j] == rows[i]), default=0)


def test_real_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    short = docs.where("n_chars < 3000")
    got = {r[0]: tuple(r[1:]) for r in quality_rules.repetition_rules(short).collect()}
    assert got == {r.doc_id: brute(r.text) for r in short.collect()}
