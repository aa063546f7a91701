"""Phrases against counting every one in a dictionary, and the query against its SQL."""

import collections
import random
import re

import duckdb
import pytest

from carespan.llm import collocations as co

LOWER = {i: i + 32 for i in range(65, 91)}


def brute(rows, least, first):
    f, n = collections.Counter(), collections.Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    f[lang or "und", tuple(words[i : i + k])] += 1
    frequent = {key: a for key, a in f.items() if a >= least and len(key[1]) >= 2}
    dropped = set()
    for (lang, y), b in frequent.items():
        for k in range(2, len(y)):
            for i in range(len(y) - k + 1):
                if 100 * b >= 100 * frequent[lang, y[i : i + k]]:
                    dropped.add((lang, y[i : i + k]))
    scored = collections.defaultdict(list)
    for (lang, x), a in frequent.items():
        if (lang, x) not in dropped:
            cuts = [(1000 * a * n[lang] // (f[lang, x[:k]] * f[lang, x[k:]]), k) for k in range(1, len(x))]
            score, k = min(cuts)
            scored[lang].append((-score, -a, " ".join(x).encode(), f[lang, x[:k]], f[lang, x[k:]]))
    out = []
    for lang, phrases in scored.items():
        for rank, (s, a, phrase, left, right) in enumerate(sorted(phrases)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def made(seed, count):
    rng = random.Random(seed)
    rows = [(None, "en"), ("", None), (" \t.,\n", "en"), ("New York", None), ("A\x0bB A\x0cB", "de")]
    phrases = ["New York City hall", "de facto", "on the other hand side", "Ünder éxact", "a a a a a a", "San  Francisco", "in\tvitro"]
    for _ in range(count):
        parts = [rng.choice(phrases) if rng.random() < 0.3 else rng.choice("the of a b c d tick #! né 中".split()) for _ in range(rng.randint(0, 40))]
        text = "".join(p + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", "?! "]) for p in parts)
        rows.append((text, rng.choice(["en", "en", "en", "de", None])))
    return rows + rows[-3:]


def run(spark, rows, least, first):
    docs = spark.createDataFrame([(t, x, "p") for t, x in rows], "text string, lang string, phrase string")
    return sorted(map(tuple, co.collocations(docs, least, first).collect()))


def test_against_counting(spark):
    for seed, least in ((1, 5), (2, 12), (3, 2)):
        rows = made(seed, 250)
        want = brute(rows, least, 2000)
        assert run(spark, rows, least, 2000) == want and len(want) > 20
        assert run(spark, rows, least, 7) == brute(rows, least, 7)


def test_full_bitmap_changes_nothing(spark, monkeypatch):
    rows = made(4, 150)
    monkeypatch.setattr(co, "FILTER_BITS", 64)
    assert run(spark, rows, 5, 50) == brute(rows, 5, 50)


def test_long_texts_are_cut_between_pieces(spark, monkeypatch):
    rng = random.Random(9)
    long = " ".join(rng.choice(["a b", "c d. e f", "g", "h,i j k"]) for _ in range(6000))
    rows = [(long, "en"), ("x y " * 9000, "en"), (long, "de")]
    want = brute(rows, 50, 100)
    assert run(spark, rows, 50, 100) == want
    monkeypatch.setattr(co, "CHUNK_BYTES", 1000)
    spans = [d.tobytes() for d, _, _ in co._parts(co.pa.array([long, "x y " * 9000, long + "."]))]
    mapped = co._MAPPED[co.np.frombuffer((long + "x y " * 9000 + long + ".").encode(), co.np.uint8)].tobytes()
    assert b"".join(spans) == mapped and max(map(len, spans)) == 36_000 and sorted(map(len, spans))[-2] <= 1000


def test_scores_beyond_64_bits(spark):
    counts = spark.createDataFrame([(10**13, 10**13, 10**13, 10**15)], "a long, l long, r long, n long")
    exact = {c: counts[c].cast("decimal(19,0)") for c in "alrn"}
    score = co.F.call_function("div", co.F.lit(1000).cast("decimal(4,0)") * exact["a"] * exact["n"], exact["l"] * exact["r"])
    assert counts.select(score).first()[0] == 1000 * 10**13 * 10**15 // 10**26


def test_no_rows(spark):
    assert run(spark, [], 1, 10) == [] and run(spark, [(None, None), ("one", "en")], 2, 10) == []


@pytest.mark.parametrize("least", [co.LEAST, 30])
def test_sql(spark, least, monkeypatch):
    folder = "/root/testdata/sf0.01"
    sql = co.ORACLE.replace(f"f >= {co.LEAST}", f"f >= {least}")
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS FROM '{folder}/documents.parquet'")
        want = sorted(db.execute(sql).fetchall())
    assert sorted(map(tuple, co.collocations(co.documents(spark, folder), least).collect())) == want and len(want) > 10
