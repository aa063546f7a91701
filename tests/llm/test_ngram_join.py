"""The n-gram join against all pairs of sets."""

import random
import re

from pyspark.sql import functions as F

from carespan.llm import ngram_join


def brute(rows):
    """{index: (n_shingles, component_id)} by comparing every pair."""
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= 80 * (len(a) + len(b) - both):
                    root[find(i)] = find(j)
    ids = {}
    for i, (doc_id, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(doc_id)
    return [(len(sets[i]), min((x for x in ids[find(i)] if x is not None), default=None)) for i in range(len(rows))]


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, ngram_join.similar_components(docs).collect()), key=str)
    want = sorted(((doc_id, *x) for (doc_id, _), x in zip(rows, brute(rows))), key=str)
    assert got == want


def near_copies(seed, groups, size, length):
    """Chains of edits: each text is an edit of an earlier one of its group, all sharing one passage."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=3))
    passage = [word() for _ in range(30)]
    rows = []
    for _ in range(groups):
        family = [[word() for _ in range(rng.randint(5, length))] + passage]
        for _ in range(rng.randint(0, size)):
            text = list(rng.choice(family))
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = word()
            family.append(text)
        rows += [" ".join(t) for t in family]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_edits_and_shared_passages(spark, monkeypatch):
    check(spark, near_copies(1, 12, 14, 120))
    monkeypatch.setattr(ngram_join, "ORDERED", 40)
    check(spark, near_copies(2, 6, 30, 40))


def test_real_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    check(spark, [tuple(r) for r in docs.collect()])


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One two"), (5, "one TWO"), (5, "one TWO"), (None, "one two"), (6, "one two three four five"),
            (7, "one"), (8, long), (9, long + " end"), (9, "ÄB äb   x y z"), (10, "äb äb   x y z")]
    check(spark, rows)


def test_empty_table_and_extra_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, node string, n string, token string")
    out = ngram_join.similar_components(empty)
    assert out.columns == ["doc_id", "n_shingles", "component_id"] and out.count() == 0
    docs = empty.union(spark.createDataFrame([(1, "a b", "x", "y", "z")], empty.schema)).withColumn("text_2", F.lit(1))
    assert ngram_join.similar_components(docs).collect() == [(1, 1, 1)]
