"""Counts against the tokenizers library's word pieces and a plain greedy cut."""

import random
import re

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import models

from carespan.llm import piece_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")


def greedy(word, begins, goes_on):
    """Number of pieces, None if the word can't be cut."""
    at, n = 0, 0
    while at < len(word):
        own = begins if at == 0 else goes_on
        end = next((e for e in range(len(word), at, -1) if word[at:e] in own), None)
        if end is None:
            return None
        at, n = end, n + 1
    return n


def test_automaton_of_random_vocabularies():
    rng = random.Random(1)
    some = lambda k, n: {"".join(rng.choices("abc", k=rng.randint(1, k))) for _ in range(n)}
    for _ in range(60):
        begins, goes_on = some(5, rng.randint(0, 12)), some(4, rng.randint(0, 12))
        words = sorted(some(14, 200))
        data = np.frombuffer("".join(words).encode(), np.uint8)
        ends = np.cumsum([len(w) for w in words])
        machine = piece_counts.Automaton([p.encode() for p in begins], [p.encode() for p in goes_on])
        got, unknown = machine.count(data, ends - [len(w) for w in words], ends)
        want = [greedy(w, begins, goes_on) for w in words]
        assert list(got) == [n or 1 for n in want] and list(unknown) == [n is None for n in want]


def expected(rows):
    begins, goes_on = piece_counts.vocabulary(PATH)
    ids = {p: k for k, p in enumerate(["[UNK]", *begins, *("\x01" + p for p in goes_on)])}
    model = models.WordPiece(ids, unk_token="[UNK]", max_input_chars_per_word=1 << 30, continuing_subword_prefix="\x01")
    out = []
    for doc_id, text in rows:
        cut = [[t.value for t in model.tokenize(w)] for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
        out.append((doc_id, len(cut), sum(map(len, cut)), sum(c == ["[UNK]"] for c in cut)))
    return sorted(out, key=str)


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_words", F.lit(0))
    got = sorted(map(tuple, piece_counts.piece_counts(docs, PATH).collect()), key=str)
    assert got == expected(rows)
    return got


def test_real_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    assert sum(r[2] for r in check(spark, [tuple(r) for r in docs.collect()])) > 100_000


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "naïve 漢字 🙂🙂 don't"), (4, "a" * 700 + " ##b ▁c"), (4, "a" * 700 + " ##b ▁c"), (5, "xy\x85z\xa0 w" * 30_000)]
    assert any(r[3] for r in check(spark, rows))
    assert piece_counts.piece_counts(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
