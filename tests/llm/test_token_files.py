"""Token files against the tokenizers library on whole texts, and their bytes."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from carespan.llm import texts, token_files
from carespan.session import fresh_path

PATH = public_tokenizers.path("byte_bpe_50k.json")


def whole(rows, path=PATH):
    tokenizer = Tokenizer.from_file(path)
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def odd_texts(n):
    rng = random.Random(2)
    bits = ["a", "Zoë", " ", "  ", "\n", "\t", "\xa0", " ", "　", "\x85", "\x1c", "'s", "'ll", "1", "23", "é", "ß.", "-", "漢字", "🙂", "‍", "<|endoftext|>", "\r\n", "don't", "é"]
    return ["".join(rng.choices(bits, k=rng.randint(0, 40))) for _ in range(n)]


def test_pieces_give_the_ids_of_whole_texts():
    encoder = token_files.Encoder(PATH)
    assert encoder.cuts and encoder.width == 2
    rows = [t.encode() for t in odd_texts(3000)]
    data = np.frombuffer(b"".join(rows), np.uint8)
    ids, sizes = encoder.encode(data, np.concatenate([[0], np.cumsum([len(r) for r in rows])]))
    tokenizer = Tokenizer.from_file(PATH)
    want = [tokenizer.encode(r.decode(), add_special_tokens=False).ids for r in rows]
    assert list(sizes) == [len(w) for w in want]
    assert list(ids) == [i for w in want for i in w]


def test_the_special_token_in_texts():
    mark = "<|endoftext|>"
    rows = [f"x {mark} y", mark, mark * 2, f"{mark} a {mark}", f"in{mark}word", f"a  {mark}  b", f" {mark}\n{mark}x", "<|endoftext", "|endoftext|>", f"<{mark[:-1]}",
            f"a<{mark}> b", f"<|endof{mark}text|>", f"é{mark}", f"\xa0{mark}\xa0", f"the same word <|endoftext| > {mark}"]
    tokenizer = Tokenizer.from_file(PATH)
    assert tokenizer.encode(rows[0], add_special_tokens=False).ids.count(50256) == 1
    for given in (rows, rows * 2, [r.replace(mark, "-") for r in rows] + rows):
        encoded = [r.encode() for r in given]
        encoder = token_files.Encoder(PATH)
        assert encoder.mark == (mark, 50256)
        ids, sizes = encoder.encode(np.frombuffer(b"".join(encoded), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in encoded])]))
        want = [tokenizer.encode(r, add_special_tokens=False).ids for r in given]
        assert list(sizes) == [len(w) for w in want] and list(ids) == [i for w in want for i in w]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_odd_rows(spark, name):
    path = public_tokenizers.path(name)
    rows = [(i * 7 % 101, t) for i, t in enumerate(odd_texts(90))] + [(5, None), (None, "x y"), (3, ""), (3, ""), (-4, "lo ng " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("part", F.lit("p")).repartition(5)
    got = [tuple(r) for r in token_files.tokenize(spark, docs, path).collect()]
    assert sorted(got, key=lambda r: r[1]) == whole(rows, path)
    assert token_files.tokenize(spark, docs.where("false")).count() == 0


def test_real_documents_and_files(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    folder = fresh_path(spark, "tokens")
    manifest = token_files.write_token_files(docs, folder, PATH)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted(map(tuple, token_files.read_token_files(manifest).collect()), key=lambda r: r[1])
    assert got == whole(rows)
    texts_by_id, tokenizer = dict(rows), Tokenizer.from_file(PATH)
    for part in manifest.collect():
        shard = token_files.Shard(part.shard)
        assert shard.ids.dtype == np.dtype("<u2") and len(shard) == part.n_docs and len(shard.ids) == part.n_ids
        for k in range(0, len(shard), 7):
            assert shard[k][-1] == token_files.END_ID
            assert tokenizer.decode(shard[k][:-1].tolist(), skip_special_tokens=False) == texts_by_id[shard.doc_ids[k]]


def test_keeping_few_pieces_changes_nothing(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 50)
    encoder = token_files.Encoder(PATH)
    for t in odd_texts(200):
        ids, _ = encoder.encode(texts.np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))
        assert list(ids) == encoder.tokenizer.encode(t, add_special_tokens=False).ids
