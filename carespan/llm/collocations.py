"""Phrases of words that stand together far more often than by chance, from a weighted de Bruijn graph.

Texts are lower-cased (A-Z) and cut at ``.,;:!?`` and line ends into pieces, pieces at blanks and tabs
into words. Everything is counted for each language (null: ``und``).

* Edges: every word of a piece starts one gram, the longest that goes on from it: five words, an edge between
  two overlapping nodes of four, or fewer where the piece ends. Equal grams are summed in the task that reads them
  and then by a combining aggregate; nothing else is counted in the texts.
* Shorter counts follow from the graph: a phrase occurs as often as grams begin with it, the flow out of its node over
  longer edges plus the grams that the end of a piece stopped there. So one more combining aggregate over the prefixes
  of distinct grams gives the counts of phrases of every length, and the sum of all grams of a language is its number of words.
* Unary paths are compacted: a phrase whose whole flow goes on to, or comes from, one neighbour one word longer is only a part
  of that path and goes. (A longer phrase that holds it equally often holds such a neighbour, too.)
* A phrase's score is the least, over its cuts in two, of how often it occurs against what its parts' counts let expect,
  in thousandths; the parts of a frequent phrase are frequent, so the joins only meet phrases above the threshold.

Grams stop where two neighbouring words together are rarer than the threshold, as they can be in no candidate: a first pass
counts pairs by 64-bit hash, and a bitmap of fixed size (8 MB) of the frequent ones is broadcast. It only saves
work: hashes that agree by chance, or a bitmap filled by very much data, let grams run on, and counts stay exact.

Products are taken in 38-digit decimals. The first phrases of a language are chosen in parts by hash first, as
many as there are shuffle partitions, so a language with most of the phrases is no single task.

Nulls, ties and odd rows: a null text has no words; repeated rows count each; other columns are ignored; phrases equal in
score and count stand in byte order; no rows, or no frequent phrase, give no rows. A text longer than
``CHUNK_BYTES`` is worked on in parts that end where a piece ends.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from carespan.llm import texts
from carespan.llm.storage import documents, kept, ship, small_batches, trimmed

WIDTH = 5
LEAST = 100  # occurrences of a candidate
FIRST = 2000  # phrases of a language
NO_LANG = "und"
CHUNK_BYTES = 1 << 21
PAIRS_AT_ONCE = 1 << 21  # summed up together in a task
FILTER_BITS = 1 << 26  # of the bitmap of frequent pairs (8 MB)

_END, _BLANK = 10, 32
_MAPPED = texts.LOWER.copy()
_MAPPED[list(b".,;:!?\n\x0b\x0c\r")] = _END
_MAPPED[9] = _BLANK
_PLACES = texts.stream(WIDTH, 29)
_LENGTHS = texts.stream(WIDTH + 1, 31)


def _parts(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(bytes, offsets of rows in them, first row), mapped so that pieces end at ``_END`` and words at ``_BLANK``."""
    for first, last, data, offsets in texts.chunks(column, CHUNK_BYTES):
        data = _MAPPED[data]
        if last - first > 1 or len(data) <= CHUNK_BYTES:
            yield data, offsets, first
            continue
        ends = np.flatnonzero(data == _END) + 1
        start = 0
        while start < len(data):
            k = int(np.searchsorted(ends, start + CHUNK_BYTES, side="right"))  # the last end within, or the first behind
            k -= bool(k and ends[k - 1] > start)
            stop = int(ends[k]) if k < len(ends) and len(data) - start > CHUNK_BYTES else len(data)
            yield data[start:stop], np.array([0, stop - start]), first
            start = stop


def _languages(column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Names, code of each row, and a hash of each name."""
    coded = column.fill_null(NO_LANG).dictionary_encode()
    names = coded.dictionary.to_pylist()
    seeds = [int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in names]
    return names, coded.indices.to_numpy().astype(np.int64), np.array(seeds, np.uint64)


def _sequence(data: np.ndarray, offsets: np.ndarray) -> tuple[texts.Words, np.ndarray, np.ndarray]:
    """Words, their hashes, and whether the next word stands in the same piece."""
    found = texts.words(data, offsets)
    hashes = texts.word_hashes(data, found)
    pieces = np.cumsum(data == _END, dtype=np.int32)[found.starts]
    goes_on = np.zeros(len(hashes), bool)
    goes_on[:-1] = (pieces[1:] == pieces[:-1]) & (found.rows[1:] == found.rows[:-1])
    return found, hashes, goes_on


def _pair_hashes(hashes: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Of each word and the next, in the word's language; the last has none."""
    return texts.mix(hashes[:-1] * _PLACES[0] + hashes[1:] * _PLACES[1] + seeds[:-1])


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []

    def summed() -> pa.RecordBatch:
        pairs, times = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        return pa.record_batch([pa.array(texts.signed(pairs)), pa.array(times)], names=["pair", "times"])

    for batch in batches:
        _, codes, seeds = _languages(batch.column("lang"))
        for data, offsets, first in _parts(batch.column("text")):
            found, hashes, goes_on = _sequence(data, offsets)
            if len(hashes) > 1:
                held.append(_pair_hashes(hashes, seeds[codes[first + found.rows]])[goes_on[:-1]])
            if sum(map(len, held)) >= PAIRS_AT_ONCE:
                yield summed()
    if held:
        yield summed()


def _frequent_pairs(docs: DataFrame, least: int) -> np.ndarray:
    """A bit for each hash modulo FILTER_BITS that some frequent pair has; its size is fixed."""
    pairs = docs.mapInArrow(trimmed(_count_pairs), "pair long, times long").groupBy("pair").agg(F.sum("times").alias("times"))
    spot = F.pmod("pair", F.lit(FILTER_BITS))
    words = (
        pairs.where(F.col("times") >= least)
        .groupBy(F.shiftright(spot, 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(pair & 63 AS int))")).alias("bits"))
        .toPandas()
    )
    bits = np.zeros(FILTER_BITS >> 6, np.uint64)
    bits[words["word"].to_numpy(dtype=np.int64)] = words["bits"].to_numpy(dtype=np.int64).view(np.uint64)
    return bits


def _longest_grams(hashes: np.ndarray, linked: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words in the longest gram from each word, and its hash."""
    n = len(hashes)
    size = np.ones(n, np.int64)
    total = hashes * _PLACES[0]
    on = linked.copy()  # words k and k + 1 from here, and all between, are linked
    for k in range(1, WIDTH):
        at = np.flatnonzero(on)
        size[at] += 1
        total[at] += hashes[at + k] * _PLACES[k]
        following = np.zeros(n, bool)
        following[: n - k] = linked[k:]
        on &= following
    return size, texts.mix(total + _LENGTHS[size] + seeds)


def longest_grams(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, phrase, words, times): each word's longest gram, summed up within tasks only."""
    rows = docs.select("text", F.col("lang").cast("string").alias("lang"))
    bits = small_batches(ship(docs.sparkSession)).sparkContext.broadcast(_frequent_pairs(rows, least))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = bits.value
        for batch in batches:
            names, codes, seeds = _languages(batch.column("lang"))
            for data, offsets, first in _parts(batch.column("text")):
                found, hashes, linked = _sequence(data, offsets)
                if not len(hashes):
                    continue
                lang = codes[first + found.rows]
                spot = _pair_hashes(hashes, seeds[lang]) & np.uint64(FILTER_BITS - 1)
                linked[:-1] &= (frequent[spot >> np.uint64(6)] >> (spot & np.uint64(63))) & np.uint64(1) == 1
                size, grams = _longest_grams(hashes, linked, seeds[lang])
                _, at, times = np.unique(grams, return_index=True, return_counts=True)
                raw = data.tobytes()
                starts, size = found.starts[at], size[at]
                ends = found.ends[at + size - 1]
                letters = np.concatenate([[0], np.cumsum(found.ends - found.starts)])
                plain = ends - starts == letters[at + size] - letters[at] + size - 1
                phrases = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
                for k in np.flatnonzero(~plain).tolist():
                    phrases[k] = b" ".join(x for x in phrases[k].split(b" ") if x)
                yield pa.record_batch(
                    [
                        pa.DictionaryArray.from_arrays(pa.array(lang[at], pa.int32()), pa.array(names, pa.string())).dictionary_decode(),
                        pa.array(phrases, pa.binary()).cast(pa.string()),
                        pa.array(size),
                        pa.array(times),
                    ],
                    names=["lang", "phrase", "words", "times"],
                )

    return rows.mapInArrow(trimmed(count), "lang string, phrase string, words long, times long")


def _first_words(phrase: str, k: str) -> Column:
    return F.expr(f"substring_index({phrase}, ' ', cast({k} AS int))")


def _top(rows: DataFrame, first: int) -> DataFrame:
    """rows with the ``rank`` of the first ones of each language, chosen within parts by hash before the whole."""
    order = [F.desc("score"), F.desc("a"), "phrase"]
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    for salts in (parts, math.isqrt(parts)):
        if salts > 1:
            part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(salts))).orderBy(*order)
            rows = rows.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= first).drop("rank")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return rows.withColumn("rank", rank).where(F.col("rank") <= first)


def phrase_counts(grams: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, phrase, words, f) of every phrase of 1 to 5 words with at least that many occurrences."""
    prefixes = grams.select("lang", "words", "phrase", "times", F.explode(F.sequence(F.lit(1).cast("long"), F.col("words"))).alias("k"))
    flow = prefixes.select("lang", F.col("k").alias("words"), _first_words("phrase", "k").alias("phrase"), "times")
    return flow.groupBy("lang", "phrase", "words").agg(F.sum("times").alias("f")).where(F.col("f") >= least)


def collocations(docs: DataFrame, least: int = LEAST, first: int = FIRST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first phrases of each language."""
    found = longest_grams(docs, least).groupBy("lang", "phrase", "words").agg(F.sum("times").alias("times"))
    grams = kept(found, "grams")
    totals = grams.groupBy("lang").agg(F.sum("times").alias("n"))
    counts = kept(phrase_counts(grams, least), "phrase-counts")
    candidates = counts.where("words >= 2").withColumnRenamed("f", "a")

    longer = candidates.where("words >= 3").select(
        F.col("lang").alias("in_lang"),
        F.col("a").alias("in_a"),
        F.explode(F.array(_first_words("phrase", "words - 1"), _first_words("phrase", "1 - words"))).alias("part"),
    )
    compact = candidates.join(longer, F.expr("lang = in_lang AND phrase = part AND in_a >= a"), "left_anti")

    cuts = compact.select("lang", "phrase", "words", "a", F.explode(F.expr("sequence(1L, words - 1)")).alias("k"))
    cuts = cuts.select("*", _first_words("phrase", "k").alias("left"), _first_words("phrase", "k - words").alias("right"))
    left = counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    valued = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(totals, "lang")
    exact = {c: F.col(c).cast("decimal(19,0)") for c in "alrn"}
    score = F.call_function("div", F.lit(1000).cast("decimal(4,0)") * exact["a"] * exact["n"], exact["l"] * exact["r"])
    weakest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    scored = valued.groupBy("lang", "phrase", "a", "n").agg(weakest)
    out = scored.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    return _top(out, first).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_phrase_collocations(spark, folder: str) -> DataFrame:
    return collocations(documents(spark, folder).select("text", "lang"))


_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ORACLE = rf"""
WITH lists AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, '{NO_LANG}') AS lang,
    unnest(regexp_split_to_array(translate(text, '{_LETTERS}', '{_LETTERS.lower()}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
), counts AS (
  SELECT lang, phrase, words, count(*) AS f FROM (
    SELECT lang, words, unnest(list_transform(range(1, len(w) - words + 2), lambda i: array_to_string(w[i:i + words - 1], ' '))) AS phrase
    FROM lists, range(1, {WIDTH + 1}) AS t(words))
  GROUP BY ALL
), totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE words = 1 GROUP BY lang
), candidates AS (SELECT lang, phrase, words, f AS a FROM counts WHERE words >= 2 AND f >= {LEAST}
), kept AS (
  SELECT * FROM candidates c WHERE NOT EXISTS (
    SELECT 1 FROM candidates d WHERE d.lang = c.lang AND d.words > c.words AND 100 * d.a >= 100 * c.a
      AND contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' '))
), cuts AS (
  SELECT lang, phrase, words, a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS head,
    array_to_string(string_split(phrase, ' ')[k + 1:words], ' ') AS rest
  FROM kept, range(1, {WIDTH}) AS t(k) WHERE k < words
), valued AS (
  SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, n, ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = head JOIN counts y ON y.lang = c.lang AND y.phrase = rest
    JOIN totals t ON t.lang = c.lang
), scored AS (SELECT * FROM valued QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM scored)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= {FIRST}
"""
