"""Personal data in texts by patterns, checksums and context, with DataFrame functions only.

Patterns propose spans, each kind from left to right without overlaps. Where they stand follows from
the text between them: ``split`` by the same pattern gives the gaps, and running sums of
the lengths of gaps and matches are the places, in code points.

Base kinds hold by their own checks alone: ``email``, ``ip`` (parts up to 255), ``card`` (12 to 19
digits that pass Luhn), ``phone`` (a plus sign and 9 to 15 digits). The method adds, where no base
span lies, what reaches ``THRESHOLD`` in total of a weight for the shape, one for a passed checksum,
and one for context words in the ``BEFORE`` characters before or the ``AFTER`` behind it (back to and
up to the neighbouring match of its kind at most); words of harmless numbers count against it:

* ``iban``: country, check digits and account, confirmed by the remainder 1 modulo 97;
* ``card_part``: a number of 13 to 19 digits by itself inside a longer row of digits, blanks and hyphens,
  confirmed by Luhn and an issuer's first digit;
* ``ssn``: nine digits as 3-2-4, of a range that is given out; needs a context word;
* ``local_phone``: ten digits as 3-3-4 without a country code; needs a context word.

Every row is worked on by itself, in time proportional to its text: no shuffle, no group. All
patterns are possessive or anchored at the start of a run, so long runs of digits or letters
are read once and need no deep stack.

Nulls, ties and odd rows: a null text is empty and has no spans; spans of several base kinds may overlap
(they are independent); two added spans may overlap each other; rows repeated or with null ids each have their result;
other columns stay as they are; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carespan.llm.storage import documents

THRESHOLD = 80
BEFORE = 60
AFTER = 30
BLOCK_BITS = 5  # running values are taken over blocks of 32, and blocks of blocks

# The kinds in order, then patterns and words.
BASE = ["email", "ip", "card", "phone"]
ADDED = ["iban", "card_part", "ssn", "local_phone"]
# The same matches as the plain patterns: possessive where nothing could be given back, and tried only at the start of a run.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}+|(?:\x20[A-Z0-9]{4}){2,7}+(?:\x20[A-Z0-9]{1,3})?+)(?![A-Za-z0-9])",
    "card_part": r"(?<![0-9.])(?:[0-9]{13,19}+|[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4})(?![0-9])",
    "ssn": r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
    "local_phone": r"(?<![0-9+(.)-])\(?+[0-9]{3}\)?+[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
}
CONTEXT = {
    "iban": "iban account bank konto compte cuenta",
    "card_part": "card credit visa mastercard payment karte carte tarjeta",
    "ssn": "ssn social security sozialversicherung",
    "local_phone": "phone tel call mobile fax cell telefon handy numéro teléfono",
}
HARMLESS = "isbn order invoice version serial part model item sku"
SHAPE = {"iban": 40, "card_part": 30, "ssn": 40, "local_phone": 40}
CONFIRMED = {"iban": 40, "card_part": 50}
IN_CONTEXT = 40
HARMLESS_CONTEXT = -30



def _with(value: Column, body) -> Column:
    """body of a value that is worked out once, as a variable of the expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(values: Column, zero: int, step, levels: int = 3) -> Column:
    """For each place of an array of integers, ``step`` over all values before it.

    Blocks are taken together first, then blocks of blocks: a place costs half a block a level.
    """

    def given(v: Column) -> Column:
        if levels == 1:
            return F.transform(v, lambda _, i: F.aggregate(F.slice(v, F.lit(1), i), F.lit(zero), step))
        blocks = F.transform(
            F.sequence(F.lit(0), F.shiftright(F.size(v) - 1, BLOCK_BITS)),
            lambda b: F.aggregate(F.slice(v, F.shiftleft(b, BLOCK_BITS) + 1, F.lit(1 << BLOCK_BITS)), F.lit(zero), step),
        )
        inside = F.lit((1 << BLOCK_BITS) - 1)
        return _with(
            _running(blocks, zero, step, levels - 1),
            lambda bases: F.transform(
                v,
                lambda _, i: step(
                    F.get(bases, F.shiftright(i, BLOCK_BITS)),
                    F.aggregate(F.slice(v, i - i.bitwiseAND(inside) + 1, i.bitwiseAND(inside)), F.lit(zero), step),
                ),
            ),
        )

    return _with(values, lambda v: F.when(F.size(v) > 0, given(v)).otherwise(F.array().cast("array<int>")))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _mod97(match: Column) -> Column:
    """Remainder of an account number, its first four characters moved to the end, letters as 10 to 35."""
    plain = F.replace(match, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    numbers = F.transform(F.split(turned, ""), lambda c: F.conv(c, 36, 10).cast("int"))
    return F.aggregate(numbers, F.lit(0), lambda acc, v: F.pmod(acc * F.when(v > 9, 100).otherwise(10) + v, F.lit(97)))


def _valid(kind: str, match: Column) -> Column:
    """The check of a base kind, or the checksum of an added one."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
        return match.rlike(rf"\A{part}\.{part}\.{part}\.{part}\z")
    digits = _digits(match)
    if kind == "card":
        return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "card_part":
        return F.call_function("luhn_check", digits) & digits.rlike(r"\A[3-6]")
    if kind == "iban":
        return _mod97(match) == 1
    return F.lit(True)


def _matches(text: Column, kind: str, present: str) -> Column:
    """Array of (start, end, match, ahead, behind) of a kind, before its checks; ``present`` is a cheap test for none."""
    item = "struct<gap:string,match:string,next:string>"

    def spans(cut: Column) -> Column:
        after = F.slice(cut["gaps"], 2, F.size(cut["gaps"]))
        triples = F.filter(F.arrays_zip(cut["gaps"], cut["found"], after).cast(f"array<{item}>"), lambda t: t["match"].isNotNull())
        return _with(triples, placed)

    def placed(triples: Column) -> Column:
        lengths = F.transform(triples, lambda t: F.length(t["gap"]) + F.length(t["match"]))
        return F.zip_with(
            triples,
            _running(lengths, 0, lambda a, b: a + b),
            lambda t, before: F.struct(
                (before + F.length(t["gap"])).alias("start"),
                (before + F.length(t["gap"]) + F.length(t["match"])).alias("end"),
                t["match"].alias("match"),
                F.right(t["gap"], F.lit(BEFORE)).alias("ahead"),
                F.left(t["next"], F.lit(AFTER)).alias("behind"),
            ),
        )

    cut = F.struct(
        F.split(text, PATTERNS[kind], -1).alias("gaps"), F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0)).alias("found")
    )
    none = F.array().cast("array<struct<start:int,end:int,match:string,ahead:string,behind:string>>")
    return F.when(text.rlike(present), _with(cut, spans)).otherwise(none)


# What a text must have for a kind to be in it; read once and left at the first find.
_PRESENT = {
    "email": "@",
    "ip": r"[0-9]\.[0-9]",
    "card": r"[0-9][\x20-]?[0-9]",
    "phone": r"\+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}",
    "card_part": r"[0-9]{4}[\x20-]?[0-9]{4}",
    "ssn": r"[0-9]-[0-9]{2}-[0-9]",
    "local_phone": r"[0-9]{3}[\x20.-][0-9]{4}",
}


def _base_spans(text: Column, kind: str) -> Column:
    held = F.filter(_matches(text, kind, _PRESENT[kind]), lambda m: _valid(kind, m["match"]))
    rank = F.lit(BASE.index(kind))
    return F.transform(held, lambda m: F.struct(m["start"].alias("start"), rank.alias("rank"), m["end"].alias("end")))


def _words(listed: str) -> str:
    return r"(?iu)(?<!\p{L})(?:" + "|".join(listed.split()) + r")s?(?!\p{L})"


def _added_spans(text: Column, kind: str) -> Column:
    """Spans of an added kind that reach the threshold, with their scores."""

    def score(m: Column) -> Column:
        around = F.concat(m["ahead"], F.lit(" \n "), m["behind"])
        total = F.lit(SHAPE[kind])
        if kind in CONFIRMED:
            total = total + F.when(_valid(kind, m["match"]), CONFIRMED[kind]).otherwise(-100)
        total = total + F.when(around.rlike(_words(CONTEXT[kind])), IN_CONTEXT).otherwise(0)
        return total + F.when(around.rlike(_words(HARMLESS)), HARMLESS_CONTEXT).otherwise(0)

    rank = F.lit(len(BASE) + ADDED.index(kind))
    scored = F.transform(
        _matches(text, kind, _PRESENT[kind]),
        lambda m: F.struct(m["start"].alias("start"), rank.alias("rank"), m["end"].alias("end"), score(m).alias("score")),
    )
    return F.filter(scored, lambda m: m["score"] >= THRESHOLD)


def _clear(spans: Column) -> Column:
    """Sorted spans without the added ones that meet a base span, in one pass from each side."""
    far = (1 << 31) - 1
    base = lambda x: x["rank"] < len(BASE)

    def from_left(s: Column) -> Column:
        reach = _running(F.transform(s, lambda x: F.when(base(x), x["end"]).otherwise(0)), 0, lambda a, b: F.greatest(a, b))
        return F.zip_with(s, reach, lambda x, r: F.when(base(x) | (x["start"] >= r), x))

    def from_right(s: Column) -> Column:
        least = _running(F.transform(s, lambda x: F.when(base(x), x["start"]).otherwise(far)), far, lambda a, b: F.least(a, b))
        return F.zip_with(s, least, lambda x, r: F.when(base(x) | (x["end"] <= r), x))

    clear = _with(F.filter(_with(spans, from_left), lambda x: x.isNotNull()), lambda s: F.filter(_with(F.reverse(s), from_right), lambda x: x.isNotNull()))
    return F.reverse(clear)


def personal_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with ``pii_base`` and ``pii``: sorted arrays of (start, rank, end), the latter with the score.

    ``rank`` is the place of the kind in BASE + ADDED, base spans score 100. Columns of these names are replaced.
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    own = docs.withColumns({f"__pii_{k}": _base_spans(whole, k) for k in BASE} | {f"__pii_{k}": _added_spans(whole, k) for k in ADDED})
    own = own.withColumns(
        {
            "pii_base": F.array_sort(F.concat(*[f"__pii_{k}" for k in BASE])),
            "__pii_added": F.concat(*[f"__pii_{k}" for k in ADDED]),
        }
    )
    held = F.transform("pii_base", lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), F.lit(100).alias("score")))
    every = F.when(F.size("__pii_added") == 0, held).otherwise(_clear(F.array_sort(F.concat(held, F.col("__pii_added")))))
    return own.withColumn("pii", every).drop("__pii_added", *[f"__pii_{k}" for k in BASE + ADDED])


def _joined(spans: str) -> Column:
    kinds = F.array(*[F.lit(k) for k in BASE + ADDED])
    shown = F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(shown, ",")


def span_digests(docs: DataFrame) -> DataFrame:
    """Contract columns of every row."""
    found = personal_spans(docs.select(F.col("doc_id"), F.col("text")))

    def count(rank: int) -> Column:
        return F.size(F.filter("pii_base", lambda s: s["rank"] == rank)).cast("long")

    counts = [count(rank).alias(f"n_{kind}") for rank, kind in enumerate(BASE)]
    return found.select("doc_id", *counts, F.sha2(_joined("pii_base"), 256).alias("base_sha256"), _joined("pii").alias("spans"))


def op13_personal_data(spark, folder: str) -> DataFrame:
    return span_digests(documents(spark, folder))
