"""Runs against trying every place and period, the wavelet matrix against counting, digests by hand."""

import hashlib
import random
import re
import zlib

import numpy as np

from carespan.llm import periodic_runs as pr


def brute_runs(words):
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in out.items())


def words_of(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def brute(doc_id, text):
    words = words_of(doc_id, text)
    runs = brute_runs(words)
    dropped = {i for s, k, q in runs for i in range(s + q, s + k)}
    best = min(((-k, s, q) for s, k, q in runs), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    head = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
    return (len(runs), *head, sha(lines), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def sequences():
    rng = random.Random(11)
    out = ["", "a", "a" * 11, "a" * 12, "ab" * 6, "ab" * 5 + "a", "a" * 100, "aab" * 30, "abcabd" * 12, fibonacci(400), thue_morse(512)]
    out += [("a" * 20 + "b") * 6, ("a" * 7 + "b") * 3 + "a" * 30, "abaaba" * 2, "abaababaabaab" * 4]
    for size in (2, 3, 5, 40):
        for _ in range(60):
            s = "".join(chr(97 + rng.randrange(size)) for _ in range(rng.randint(1, 150)))
            for _ in range(rng.randint(0, 4)):
                i, k = rng.randrange(len(s)), rng.randint(1, 40)
                s = s[:i] + s[i : i + k] * rng.randint(2, 6) + s[i + k :]
            out.append(s)
    return out


def runs_of(all_words):
    ids = {}
    words = np.array([ids.setdefault(w, len(ids)) for s in all_words for w in s], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    counts = np.array([len(s) for s in all_words])
    rows = np.repeat(np.arange(len(all_words)), counts)
    firsts = np.cumsum(counts) - counts
    start, stop, period = pr.find_runs(words, rows, firsts, firsts + counts)
    out = [[] for _ in all_words]
    for s, e, q in zip(start.tolist(), stop.tolist(), period.tolist()):
        out[rows[s]].append((s - firsts[rows[s]], e - s, q))
    return out


def test_runs_by_every_place_and_period():
    many = sequences()
    assert runs_of(many) == [brute_runs(s) for s in many]
    for s in many[:40]:
        assert runs_of([s]) == [brute_runs(s)]


def test_all_short_binary_sequences():
    many = [format(i, f"0{n}b") for n in (12, 13, 15) for i in range(1 << n)]
    assert runs_of(many) == [brute_runs(s) for s in many]


def test_wavelet_matrix_by_counting():
    rng = np.random.default_rng(3)
    for n in (1, 5, 64, 65, 700):
        values = rng.permutation(n)
        matrix = pr.WaveletMatrix(values, max(1, (n - 1).bit_length()))
        lo = rng.integers(0, n + 1, 200)
        hi = np.minimum(lo + rng.integers(0, n + 1, 200), n)
        x = rng.integers(0, 2 * n + 2, 200)
        assert matrix.below(lo, hi, x).tolist() == [int((values[a:b] < v).sum()) for a, b, v in zip(lo, hi, x)]
        some = hi > lo
        lo, hi = lo[some], hi[some]
        rank = rng.integers(0, hi - lo)
        assert matrix.smallest(lo, hi, rank).tolist() == [int(np.sort(values[a:b])[k]) for a, b, k in zip(lo, hi, rank)]


def check(spark, rows, folder):
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    docs.write.parquet(f"{folder}/documents.parquet")
    got = sorted(map(tuple, pr.op11_periodic_runs(spark, str(folder)).collect()), key=str)
    want = [(d, *brute(d, t)) for d, t, _ in rows]
    assert got == sorted(want, key=str)
    return got


def test_query_on_odd_rows(spark, tmp_path):
    rng = random.Random(2)
    rows = [(None, None, "x"), (None, "a " * 30, "x"), (7, "", None), (7, " \t\n", None), (3, "Ä\x0bß " * 20, "y"), (3, "Ä\x0bß " * 20, "y")]
    for i in range(250):
        words = [rng.choice("abcdeé") * rng.randint(1, 2) for _ in range(rng.randint(1, 90))]
        rows.append((i, "".join(w + rng.choice([" ", "\n", "\t ", "\x0c"]) for w in words), None))
    got = check(spark, rows, tmp_path)
    assert sum(r[1] > 0 for r in got) > 10
    assert pr.text_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_long_texts(spark, tmp_path):
    rng = random.Random(6)
    words = [f"w{rng.randrange(50)}" for _ in range(100_000)]
    words[20_000:60_000] = (words[20_000:20_700] * 60)[:40_000]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, "a " * 300_000), (3, "a b " * 100_000)], "doc_id long, text string")
    got = {r.doc_id: r for r in pr.text_runs(docs).collect()}
    assert [tuple(r) for r in got[2].runs] == [(0, 300_000, 1)] and [tuple(r) for r in got[3].runs] == [(0, 200_000, 2)]
    assert got[2].collapsed_sha256 == hashlib.sha256(b"a").hexdigest()
    longest = max(got[1].runs, key=lambda r: r.length)
    assert longest.period == 700 and 40_000 <= longest.length < 40_010


def test_real_documents(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("n_chars < 6000")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in pr.op11_periodic_runs(spark, str(tmp_path)).collect()}
    assert got == {r.doc_id: brute(r.doc_id, r.text) for r in docs.collect()}
