"""Runs of periodic words in texts, found by internal pattern matching over dyadic blocks.

A run is a stretch of words with smallest period q, at least ``max(LEAST, 2 * q)`` words long, that no
neighbouring word extends with that period. Take a run of a period between 2 * L - 1 and 4 * L - 2 for
a power of two L: its first q words hold a whole block of L words that begins at a multiple of
L, and that block comes again q words on. So each block asks where it occurs in the window of neighbours
that far behind it:

* A suffix array over the words of a chunk of texts is made by prefix doubling, only equal
  prefixes being sorted further. After each doubling, the suffixes that begin with a block are an interval of it.
* Occurrences in a window are a range query on that interval: a wavelet matrix over the suffix array
  counts the interval's places below each end of the window and gives the first two in it (range successor).
* A window has as many starts as the block has words, so the occurrences in it are an arithmetic progression, known by its
  first two members and its size. Its members are the candidate periods. Those that lie in one
  run with the block, of the progression's own difference, are multiples of a shorter period and go.
* Candidates are extended both ways by binary search over prefix hashes (modulo two primes below 2**31 of
  the words' 64-bit hashes). Of runs over the same words the one of smallest period stays.

All queries of a chunk and level are answered together as arrays. Texts never meet, so there is no shuffle; memory
follows the chunk (half a megabyte) or a longer text, some 70 bytes a word.

Nulls, ties and odd rows: a null text has no words and no runs; a null doc_id is a row like any other (and
never rewritten in the query); rows repeated each have their result; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carespan.llm import texts
from carespan.llm.storage import documents, ship

LEAST = 12  # words in a run
PRIMES = ((2**31 - 1, 1_000_003), (2**31 - 19, 998_244_353))  # modulus and base of the prefix hashes
WORDS_AT_ONCE = 1 << 14  # joined for a digest


class WaveletMatrix:
    """Counts and order statistics of the values in any range of an array of numbers below 2**bits."""

    def __init__(self, values: np.ndarray, bits: int) -> None:
        self.n, self.bits = len(values), bits
        self.words: list[np.ndarray] = []  # 64 bits each, one word more than needed
        self.ones: list[np.ndarray] = []  # ones before each word
        self.zeros: list[int] = []
        now = values.astype(np.uint32)
        for bit in range(bits - 1, -1, -1):
            one = (now >> np.uint32(bit)) & np.uint32(1)
            packed = np.zeros((self.n // 64 + 1) * 64, np.uint8)
            packed[: self.n] = one
            packed = np.packbits(packed, bitorder="little").view(np.uint64)
            ones = np.zeros(len(packed), np.int64)
            np.cumsum(np.bitwise_count(packed)[:-1], out=ones[1:])
            self.words.append(packed)
            self.ones.append(ones)
            self.zeros.append(self.n - int(one.sum()))
            now = np.concatenate([now[one == 0], now[one == 1]])

    def _ones_before(self, level: int, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.ones[level][word] + np.bitwise_count(self.words[level][word] & below)

    def below(self, lo: np.ndarray, hi: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many of the values at lo..hi-1 are less than ``value`` (at most 2**bits)."""
        lo, hi, count = lo.copy(), hi.copy(), np.zeros(len(lo), np.int64)
        over = value >= 1 << self.bits
        count[over] = (hi - lo)[over]
        for level in range(self.bits):
            one = (value >> (self.bits - 1 - level)) & 1 == 1
            lo1, hi1 = self._ones_before(level, lo), self._ones_before(level, hi)
            zeros = (hi - lo) - (hi1 - lo1)
            count += np.where(one & ~over, zeros, 0)
            lo = np.where(one, lo1 + self.zeros[level], lo - lo1)
            hi = np.where(one, hi1 + self.zeros[level], hi - hi1)
        return count

    def smallest(self, lo: np.ndarray, hi: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The value of that rank, from 0, among those at lo..hi-1."""
        lo, hi, rank, out = lo.copy(), hi.copy(), rank.copy(), np.zeros(len(lo), np.int64)
        for level in range(self.bits):
            lo1, hi1 = self._ones_before(level, lo), self._ones_before(level, hi)
            zeros = (hi - lo) - (hi1 - lo1)
            one = rank >= zeros
            rank -= np.where(one, zeros, 0)
            out = out * 2 + one
            lo = np.where(one, lo1 + self.zeros[level], lo - lo1)
            hi = np.where(one, hi1 + self.zeros[level], hi - hi1)
        return out


class Extensions:
    """How far two places of a sequence agree, forwards and backwards, by binary search on prefix hashes."""

    def __init__(self, words: np.ndarray) -> None:
        n = len(words)
        self.sums, self.powers = [], []
        for prime, base in PRIMES:
            power = np.ones(n + 1, np.uint64)
            filled = 1
            while filled < n + 1:  # powers 0..filled-1 times base**filled
                step = np.uint64(pow(base, filled, prime))
                take = min(filled, n + 1 - filled)
                power[filled : filled + take] = power[:take] * step % np.uint64(prime)
                filled += take
            terms = words % np.uint64(prime) * power[:n] % np.uint64(prime)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(terms, out=sums[1:])  # below 2**31 times the number of words
            self.sums.append((sums % np.uint64(prime)).astype(np.uint32))
            self.powers.append(power.astype(np.uint32))

    def _equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the stretches from a and from b >= a agree."""
        same = np.ones(len(a), bool)
        for (prime, _), sums, power in zip(PRIMES, self.sums, self.powers):
            p = np.uint64(prime)
            x = (sums[a + length].astype(np.uint64) + p - sums[a]) % p
            y = (sums[b + length].astype(np.uint64) + p - sums[b]) % p
            same &= x * power[b - a] % p == y
        return same

    def _longest(self, most: np.ndarray, agree: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        length = np.zeros(len(most), np.int64)
        step = 1 << int(most.max(initial=0)).bit_length()
        while step:
            tried = length + step
            fits = tried <= most
            length = np.where(fits & agree(np.where(fits, tried, 0)), tried, length)
            step >>= 1
        return length

    def forwards(self, a: np.ndarray, b: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Words equal from a and from b > a on, b's before ``end``."""
        return self._longest(end - b, lambda k: self._equal(a, b, k))

    def backwards(self, a: np.ndarray, b: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Words equal before a and before b > a, a's from ``start`` on."""
        return self._longest(a - start, lambda k: self._equal(a - k, b - k, k))


def _doubling(words: np.ndarray, rows: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]:
    """Suffix array, and for every length 2, 4, ... the blocks there that come again: (length, places, interval's start and end)."""
    n = len(words)
    order = np.lexsort((words, rows))
    new = np.ones(n, bool)
    new[1:] = (words[order][1:] != words[order][:-1]) | (rows[order][1:] != rows[order][:-1])
    heads = np.flatnonzero(new)
    group = np.repeat(heads, np.diff(np.append(heads, n)))  # slot of the first member
    rank = np.empty(n, np.int64)
    rank[order] = group
    slots = np.flatnonzero(np.repeat(np.diff(np.append(heads, n)) > 1, np.diff(np.append(heads, n))))
    levels, length = [], 1
    while len(slots):
        at = order[slots]
        beyond = at + length
        second = np.where(beyond < ends[rows[at]], rank[np.minimum(beyond, n - 1)], -1)
        first = rank[at]
        sorting = np.lexsort((second, first))
        at, first, second = at[sorting], first[sorting], second[sorting]
        order[slots] = at
        new = np.ones(len(at), bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        heads = np.flatnonzero(new)
        sizes = np.diff(np.append(heads, len(at)))
        low = np.repeat(slots[heads], sizes)
        size = np.repeat(sizes, sizes)
        rank[at] = low
        length *= 2
        several = size > 1
        aligned = several & (at & (length - 1) == 0)
        levels.append((length, at[aligned], low[aligned], (low + size)[aligned]))
        slots = slots[several]
    return order, levels


def _windows(length: int) -> list[tuple[int, int]]:
    """(first, last) period asked of blocks of this length, in windows of at most that many."""
    first, last = (1, 6) if length == 2 else (2 * length - 1, 4 * length - 2)
    return [(k, min(k + length - 1, last)) for k in range(first, last + 1, length)]


def find_runs(words: np.ndarray, rows: np.ndarray, firsts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs, by start and then period; row r has the words firsts[r]..ends[r]-1."""
    n = len(words)
    nothing = np.zeros(0, np.int64)
    if n < LEAST:
        return nothing, nothing, nothing
    order, levels = _doubling(words, rows, ends)
    matrix = WaveletMatrix(order, max(1, int(n - 1).bit_length()))
    extensions = Extensions(words)
    starts, stops, periods = [], [], []
    for length, blocks, low, high in levels:
        for nearest, farthest in _windows(length):
            fits = blocks + nearest + length <= ends[rows[blocks]]
            b, lo, hi = blocks[fits], low[fits], high[fits]
            if not len(b):
                continue
            before = matrix.below(lo, hi, b + nearest)
            found = matrix.below(lo, hi, b + farthest + 1) - before
            some = found > 0
            b, lo, hi, before, found = b[some], lo[some], hi[some], before[some], found[some]
            if not len(b):
                continue
            first = matrix.smallest(lo, hi, before)
            more = found > 1
            step = np.zeros(len(b), np.int64)
            step[more] = matrix.smallest(lo[more], hi[more], before[more] + 1) - first[more]
            # Members that the block reaches with the progression's own difference are that period or multiples of it.
            near = np.full(len(b), -1)
            end = ends[rows[b]]
            near[more] = b[more] + step[more] + extensions.forwards(b[more], b[more] + step[more], end[more])
            which = np.repeat(np.arange(len(b)), found)
            place = np.arange(len(which)) - np.repeat(np.cumsum(found) - found, found)
            other = first[which] + place * step[which]
            apart = (other + length > near[which]) | (other - b[which] == step[which])
            which, other = which[apart], other[apart]
            a = b[which]
            period = other - a
            ahead = extensions.forwards(a, other, end[which])
            behind = extensions.backwards(a, other, firsts[rows[a]])
            start, stop = a - behind, other + ahead
            long = stop - start >= np.maximum(LEAST, 2 * period)
            starts.append(start[long])
            stops.append(stop[long])
            periods.append(period[long])
    if not starts:
        return nothing, nothing, nothing
    start, stop, period = map(np.concatenate, (starts, stops, periods))
    by = np.lexsort((period, stop, start))
    start, stop, period = start[by], stop[by], period[by]
    keep = np.ones(len(by), bool)
    keep[1:] = (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    start, stop, period = start[keep], stop[keep], period[keep]
    by = np.lexsort((period, start))
    return start[by], stop[by], period[by]


def rewritten(doc_id: int | None, n: int) -> np.ndarray | None:
    """Which original word stands at each place of a text of n words, for the ids of the query's rule; else None."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i >= a, a + (i - a) % p, i)


def _digest(data: bytes, starts: np.ndarray, ends: np.ndarray) -> str:
    """Of words joined by one space, taken in blocks."""
    out = hashlib.sha256()
    for first in range(0, len(starts), WORDS_AT_ONCE):
        if first:
            out.update(b" ")
        last = first + WORDS_AT_ONCE
        out.update(b" ".join([data[a:b] for a, b in zip(starts[first:last].tolist(), ends[first:last].tolist())]))
    return out.hexdigest()


_RUNS = "array<struct<start:long,length:long,period:long>>"
_OUT = f"n_words long, runs {_RUNS}, collapsed_sha256 string"


def _texts_runs(column: pa.Array, ids: list[int | None] | None) -> Iterator[tuple[int, int, list[int], list, list[str]]]:
    """Per chunk: its rows, and each row's words, runs and digest of the words left when runs keep one period."""
    for first, last, data, offsets in texts.chunks(column):
        found = texts.words(data, offsets)
        hashes = texts.word_hashes(data, found)
        starts, ends = found.starts, found.ends
        firsts = found.firsts
        if ids is not None:
            source = np.arange(len(starts))
            for r, doc_id in enumerate(ids[first:last]):
                moved = rewritten(doc_id, int(found.counts[r]))
                if moved is not None:
                    source[firsts[r] : firsts[r] + found.counts[r]] = firsts[r] + moved
            hashes, starts, ends = hashes[source], starts[source], ends[source]
        stops = firsts + found.counts
        start, stop, period = find_runs(hashes, found.rows, firsts, stops)
        edges = np.zeros(len(starts) + 1, np.int64)
        np.add.at(edges, start + period, 1)
        np.add.at(edges, stop, -1)
        left = np.cumsum(edges[:-1]) == 0
        row = found.rows[start]
        cuts = np.searchsorted(row, np.arange(last - first + 1))
        raw = data.tobytes()
        runs, digests = [], []
        for r in range(last - first):
            mine = slice(cuts[r], cuts[r + 1])
            runs.append(
                [
                    {"start": s, "length": k, "period": p}
                    for s, k, p in zip((start[mine] - firsts[r]).tolist(), (stop[mine] - start[mine]).tolist(), period[mine].tolist())
                ]
            )
            words = slice(firsts[r], stops[r])
            keep = left[words]
            digests.append(_digest(raw, starts[words][keep], ends[words][keep]))
        yield first, last, found.counts.tolist(), runs, digests


def text_runs(docs: DataFrame, rewrite: bool = False) -> DataFrame:
    """(doc_id, n_words, runs, collapsed_sha256) of every row; ``runs`` by start, then period.

    The digest is of the words, joined by a space, without those of a run behind its first period.
    ``rewrite`` applies the query's rule to the words of some ids first.
    """
    ship(docs.sparkSession)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            ids = batch.column("doc_id").to_pylist() if rewrite else None
            for first, last, counts, runs, digests in _texts_runs(batch.column("text"), ids):
                yield pa.record_batch(
                    [batch.column("doc_id").slice(first, last - first), pa.array(counts, pa.int64()), pa.array(runs, kind), pa.array(digests)],
                    names=["doc_id", "n_words", "runs", "collapsed_sha256"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(measure, f"doc_id long, {_OUT}")


def op11_periodic_runs(spark, folder: str) -> DataFrame:
    found = text_runs(documents(spark, folder), rewrite=True)
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("shorter"), r["start"], r["period"])))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.shorter")).alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * -best.shorter div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        "collapsed_sha256",
    )
