"""Base spans against the plain patterns, checksums and context by hand, and running values of long arrays."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from carespan.llm import personal_data as pd

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def holds(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    found = []
    for rank, kind in enumerate(PLAIN):
        found += [(m.start(), rank, kind, m.end()) for m in re.finditer(PLAIN[kind], text or "") if holds(kind, m[0])]
    found.sort()
    shown = ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in found)
    return [sum(f[2] == k for f in found) for k in PLAIN] + [hashlib.sha256(shown.encode()).hexdigest()], shown


def check(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pd.span_digests(docs).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        want, shown = brute(text)
        assert list(got[i])[1:6] == want, text
        assert set(shown.split(",")) - {""} <= set(got[i].spans.split(",")), text
    return got


def test_base_spans_of_random_texts(spark):
    rng = random.Random(13)
    pieces = ["a@b.c", "x.y+z@d-e.f.g", "@", "@@", "%", "10.0.0.255", "256.1.1.1", "0255.1.1.1", "1.2.3.4.5.6.7.8", "1.2.3", ".", "-", " ", "  ",
              "4111 1111 1111 1111", "4465758382889437", "79927398713", "000000000000", "12", "7", "+1 (743) 555-3824", "+49", "(", ")", "+", "é", "\U0001f600",
              "\n", "\t", "b@c", "a@b.c%d@e.f", "GB82WEST12345698765432"]
    texts = [None, "", "no data", "+1((((", "+1)9"]
    texts += ["".join(rng.choices(pieces, k=rng.randint(1, 14))) for _ in range(600)]
    texts += ["".join(rng.choices("01+@.- (a9", k=rng.randint(5, 60))) for _ in range(300)]
    got = check(spark, texts)
    assert sum(r.n_email for r in got.values()) > 100 and min(sum(r[k] for r in got.values()) for k in ("n_ip", "n_card", "n_phone")) > 20


def test_many_places_and_long_runs(spark):
    n = 3000
    texts = ["é a@b.c " * n, "1.2.3.4\n" * n, "+12 345 678 901;" * n, "4111111111111111, " * n]
    texts += [c * 20_000 for c in ("1", "a", "a@", "+1(", "1 ", "(", "1.", "AB12", "aé")]
    check(spark, texts)


def spans(spark, text):
    return pd.span_digests(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().spans


def test_checksums_and_context_add_spans(spark):
    assert spans(spark, "IBAN GB82 WEST 1234 5698 7654 32.") == "iban:5:32"
    assert spans(spark, "pay to DE89370400440532013000 now") == "iban:7:29"
    assert spans(spark, "pay to DE89370400440532013001 now") == ""
    assert spans(spark, "4465758382889437 4465758382889437") == "card_part:0:16,card_part:17:33"
    assert spans(spark, "4465758382889437 4465758382889438") == "card_part:0:16"
    assert spans(spark, "my SSN: 123-45-6789") == "ssn:8:19"
    assert spans(spark, "code 123-45-6789") == "" and spans(spark, "SSN 666-45-6789") == ""
    assert spans(spark, "call my phone 555-123-4567") == "local_phone:14:26"
    assert spans(spark, "order 555-123-4567") == "" and spans(spark, "isbn no phone 555-123-4567") == ""
    assert spans(spark, "phone +1 555-123-4567") == "phone:6:21"  # an added span gives way to the base one


def test_clear_keeps_base_and_what_meets_none(spark):
    rng = random.Random(5)
    for _ in range(5):
        rows = []
        for _ in range(rng.randint(0, 120)):
            a = rng.randrange(400)
            rows.append((a, rng.randrange(8), a + rng.randint(1, 12), 100))
        rows.sort()
        frame = spark.createDataFrame([(rows,)], "s array<struct<start:int,rank:int,end:int,score:int>>")
        base = [r for r in rows if r[1] < 4]
        want = [r for r in rows if r[1] < 4 or all(r[2] <= b[0] or b[2] <= r[0] for b in base)]
        assert [tuple(r) for r in frame.select(pd._clear(F.col("s"))).first()[0]] == want


def test_odd_rows_and_other_columns(spark):
    rows = [(None, "a@b.c", 1, "x"), (None, "a@b.c", 1, "x"), (5, None, 2, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pii int, start string")
    out = pd.personal_spans(docs)
    assert set(docs.columns) <= set(out.columns) and out.count() == 3
    assert sorted((len(r.pii), r.start) for r in out.collect()) == [(0, "y"), (1, "x"), (1, "x")]
    assert pd.span_digests(docs.where("false")).count() == 0


def test_real_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    got = check(spark, [r.text for r in rows])
    assert sum(r.n_email + r.n_phone for r in got.values()) > 5
