"""Byte-level removal against a dictionary of all windows, and the suffix sort against sorted()."""

import hashlib
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from carespan.llm import suffix_dedup


def brute(rows):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    out = []
    for (doc_id, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - 199):
            if seen[t[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        rest = bytes(b for b, g in zip(t, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc_id, len(t), sum(gone), runs, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit("x")).withColumn("gram", F.lit(1))
    got = sorted((tuple(r) for r in suffix_dedup.without_repeats(docs).collect()), key=str)
    assert got == brute(rows)
    return got


def mixed_rows(seed):
    rng = random.Random(seed)
    letters = lambda n, of="abcdeé ": "".join(rng.choice(of) for _ in range(n))
    passages = [letters(rng.choice([150, 199, 200, 201, 230, 320, 700])) for _ in range(8)]
    rows = [letters(rng.randint(0, 300)) + rng.choice(passages)[rng.randint(0, 40) :] + letters(rng.randint(0, 300)) for _ in range(60)]
    rows += [rows[0]] * 5 + [r[: rng.randint(0, len(r))] + "#" + r[rng.randint(0, 50) :] for r in rows[:20]]
    rows += ["a" * 450, "ab" * 300, letters(199), "x" * 200, "x" * 200, letters(100) * 4]
    return list(enumerate(rows))


def test_windows(spark, monkeypatch):
    rows = mixed_rows(5)
    assert sum(r[2] for r in check(spark, rows)) > 10_000
    monkeypatch.setattr(suffix_dedup, "GROUP", 3)
    check(spark, rows)


def test_odd_rows(spark):
    text = "".join(random.Random(3).choices("abcdefg", k=400))
    check(spark, [(1, None), (2, ""), (None, text), (3, text), (3, text), (4, "ü" * 150), (5, text[:200]), (5, text[1:200])])
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.without_repeats(empty).count() == 0


def test_real_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    check(spark, [tuple(r) for r in docs.collect()])


def test_long_text_in_pieces(monkeypatch):
    import pyarrow as pa

    text = "".join(random.Random(9).choices("abcdefgh", k=30_000))
    whole = suffix_dedup.anchors(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
    monkeypatch.setattr(suffix_dedup.texts, "CHUNK_BYTES", 4000)
    places = []
    for _, data, offsets, shift, (low, high) in suffix_dedup._segments(pa.array([text])):
        found = suffix_dedup.anchors(data, offsets)
        own = (found["place"] >= low) & (found["place"] < high)
        places += list(zip(found["place"][own] + shift, found["context"][own]))
    assert places == list(zip(whole["place"], whole["context"]))


def test_mergesort_and_extensions():
    rng = random.Random(1)
    pieces = ["".join(rng.choices("ab", k=rng.randint(0, 12))).encode() for _ in range(300)]
    groups = np.sort(np.array([rng.randrange(9) for _ in pieces]))
    side = suffix_dedup.Suffixes(pieces)
    order = side.mergesort(groups)
    want = sorted(range(300), key=lambda i: (groups[i], pieces[i], i))
    assert [pieces[i] for i in order] == [pieces[i] for i in want] and list(groups[order]) == list(groups)
    a, b = np.array(order[:-1]), np.array(order[1:])
    common = [len(__import__("os").path.commonprefix([pieces[i], pieces[j]])) for i, j in zip(a, b)]
    assert list(side.verified(a, b)) == common
