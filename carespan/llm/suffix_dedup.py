"""Removal of repeated byte strings by hash-compared suffix sorting.

A byte goes if it lies in a string of ``WINDOW`` bytes that starts anywhere else, too, in
any text; strings do not cross texts and are judged on the input.

1. Buckets of suffixes. In every window of 200 bytes the 48-byte grams with the least
   hash are its anchors, so equal windows hold equal anchors at equal places. An
   anchor's context is what the windows around it can reach: up to 152 bytes on each side.
   About one byte in 75 is an anchor.
2. One shuffle by anchor. Anchors found once in the corpus are dropped. An anchor whose
   whole context occurs twice is settled: the whole context goes. A task that meets a
   context again within a block settles it there and posts one entry of it, so a group of
   copies costs the lists one entry for a block.
3. What is left, different contexts of one anchor, is sorted. Suffixes (from the anchor to
   the right, and to the left) are ordered by mergesort; two of them are compared in
   logarithmic time by binary search for their common extension on prefix polynomial
   hashes, and the extension found is verified byte by byte. A window that takes j bytes
   left of the anchor is repeated if two contexts lie in one interval of left common
   prefixes of at least j and in one of right common prefixes of at least 152 - j.
   An anchor with more than ``GROUP`` different contexts is never gathered: its windows
   are counted one by one with a combining aggregate and joined back.
4. The repeated windows of a text are united and cut out.

Nulls, ties and odd rows: a null text is empty; texts under 200 bytes lose nothing; a row
repeated as a whole repeats its text; a null doc_id is a row like any other, and rows are told
apart by doc_id and text; other columns are ignored; no rows give no rows. Grams
and whole contexts are compared by 64-bit hashes (see texts.py for the odds).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from carespan.llm import texts
from carespan.llm.storage import documents, kept, ship, small_batches, trimmed

WINDOW = 200
GRAM = 48
REACH = WINDOW - GRAM
BLOCK = 1 << 18  # anchors combined together in a task
GROUP = 30_000  # most contexts of one anchor sorted in a task
SORTED_AT_ONCE = 1 << 13


def _runs_minimum(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) of every ``width`` neighbours, by doubling."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = pick(out[:-step], out[step:])
        have += step
    return out


def anchors(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Anchors of the texts in a chunk: row, place in it, reach to both sides, gram and context hash."""
    n = len(data)
    names = ("row", "place", "left", "right", "gram", "context")
    if n < WINDOW:
        return {k: np.zeros(0, np.int64 if k not in ("gram", "context") else np.uint64) for k in names}
    sums = texts.prefix_hashes(data)
    at = np.arange(n - GRAM + 1)
    grams = texts.mix(texts.span_hashes(sums, at, at + GRAM))
    least = _runs_minimum(grams, REACH + 1, np.minimum)
    whole = np.zeros(len(least), bool)
    for a, b in zip(offsets[:-1], offsets[1:]):
        if b - a >= WINDOW:
            whole[a : b - WINDOW + 1] = True
    least[~whole] = 0
    edge = np.zeros(REACH, np.uint64)
    seen = _runs_minimum(np.concatenate([edge, least, edge]), REACH + 1, np.maximum)
    places = np.flatnonzero(seen == grams)
    rows = np.searchsorted(offsets, places, side="right") - 1
    begin, end = offsets[rows], offsets[rows + 1]
    left = np.minimum(places - begin, REACH)
    right = np.minimum(end - places - GRAM, REACH)
    context = texts.span_hashes(sums, places - left, places + GRAM + right)
    context = texts.mix(context + (left * 1000 + right).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return dict(zip(names, (rows, places - begin, left, right, grams[places], context)))


def _segments(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, int, tuple[int, int]]]:
    """(first row, bytes, offsets, bytes of the row before them, bytes to answer for); long texts come in overlapping pieces."""
    margin = WINDOW + 2 * REACH
    for first, last, data, offsets in texts.chunks(column):
        if last - first > 1 or len(data) <= 2 * texts.CHUNK_BYTES:
            yield first, data, offsets, 0, (0, len(data))
            continue
        for a in range(0, len(data), texts.CHUNK_BYTES):
            low, high = max(0, a - margin), min(len(data), a + texts.CHUNK_BYTES + margin)
            yield first, data[low:high], np.array([0, high - low]), low, (a - low, a - low + texts.CHUNK_BYTES)


_ANCHOR = "doc_id long, text_key long, gram long, context long, place long, lead int, trail int, met int"


def _post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors, each context once for a block; further ones as settled rows of their own (met 0)."""
    waiting: list[list] = []

    def flush() -> pa.RecordBatch:
        ids = pa.concat_arrays([x[0] for x in waiting])
        keys, gram, context, place, left, right = (np.concatenate([x[k] for x in waiting]) for k in range(1, 7))
        waiting.clear()
        pair = texts.mix(gram ^ texts.mix(context))
        _, first, back, times = np.unique(pair, return_index=True, return_inverse=True, return_counts=True)
        met = times[back].astype(np.int32)
        again = np.ones(len(pair), bool)
        again[first] = False
        met[again] = 0
        # A settled row must not gather with the others of its anchor.
        spread = texts.mix(pair + np.arange(len(pair), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        gram = np.where(again, spread, gram)
        return pa.record_batch(
            [ids, pa.array(keys), pa.array(texts.signed(gram)), pa.array(texts.signed(context)), pa.array(place)]
            + [pa.array(x.astype(np.int32)) for x in (left, right, met)],
            names=["doc_id", "text_key", "gram", "context", "place", "lead", "trail", "met"],
        )

    for batch in batches:
        keys = batch.column("text_key").to_numpy()
        for first, data, offsets, shift, (low, high) in _segments(batch.column("text")):
            found = anchors(data, offsets)
            own = slice(None) if not shift and high >= len(data) else (found["place"] >= low) & (found["place"] < high)
            rows = found["row"][own] + first
            if len(rows):
                waiting.append(
                    [batch.column("doc_id").take(pa.array(rows)), keys[rows]]
                    + [found["gram"][own], found["context"][own], found["place"][own] + shift]
                    + [found["left"][own], found["right"][own]]
                )
            if sum(len(x[1]) for x in waiting) >= BLOCK:
                yield flush()
    if waiting:
        yield flush()


def _repeated(posted: DataFrame) -> DataFrame:
    """Anchors found again, with ``settled`` (their context is, too) and ``only`` (no other context)."""
    by_gram = Window.partitionBy("gram").orderBy("context")
    around = [f(F.struct("gram", "context")).over(by_gram) for f in (F.lag, F.lead)]
    return (
        posted.withColumn("before", around[0])
        .withColumn("after", around[1])
        .where("met <> 1 OR before IS NOT NULL OR after IS NOT NULL")
        .withColumn(
            "settled",
            F.expr("met <> 1 OR coalesce(before.context = context, false) OR coalesce(after.context = context, false)"),
        )
        .withColumn("first", F.expr("met > 0 AND NOT coalesce(before.context = context, false)"))
        .select("doc_id", "text_key", "gram", "context", "place", "lead", "trail", "settled", "first")
    )


class Suffixes:
    """Contexts of anchors, with prefix hashes, seen from the anchor to one side."""

    def __init__(self, pieces: list[bytes]):
        self.length = np.array([len(p) for p in pieces], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(pieces) + bytes(8), np.uint8)
        self.sums = texts.prefix_hashes(self.data)

    def equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        _, down = texts.powers(len(self.sums))
        x, y = self.start[a], self.start[b]
        return (self.sums[x + length] - self.sums[x]) * down[x] == (self.sums[y + length] - self.sums[y]) * down[y]

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefix lengths by binary search on the hashes."""
        low = np.zeros(len(a), np.int64)
        high = np.minimum(self.length[a], self.length[b])
        while len(open_ := np.flatnonzero(low < high)):
            middle = (low[open_] + high[open_] + 1) // 2
            same = self.equal(a[open_], b[open_], middle)
            low[open_[same]] = middle[same]
            high[open_[~same]] = middle[~same] - 1
        return low

    def verified(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Extensions as the bytes have them; a collision found is cut to the true length."""
        found = self.extension(a, b)
        for k in range(0, len(a), 4096):
            part = slice(k, k + 4096)
            width = int(found[part].max(initial=0))
            reach = np.arange(width)
            last = len(self.data) - 1
            x = self.data[np.minimum(self.start[a[part], None] + reach, last)]
            y = self.data[np.minimum(self.start[b[part], None] + reach, last)]
            differs = (x != y) & (reach < found[part][:, None])
            wrong = differs.any(axis=1)
            if wrong.any():
                found[part] = np.where(wrong, differs.argmax(axis=1), found[part])
        return found

    def before(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether suffix a sorts before b, and whether they are equal."""
        common = self.extension(a, b)
        ends = (common == self.length[a]) & (common == self.length[b])
        last = len(self.data) - 1
        x = np.where(common < self.length[a], self.data[np.minimum(self.start[a] + common, last)].astype(np.int64), -1)
        y = np.where(common < self.length[b], self.data[np.minimum(self.start[b] + common, last)].astype(np.int64), -1)
        return (x < y) & ~ends, ends

    def mergesort(self, groups: np.ndarray) -> np.ndarray:
        """Order of the suffixes within each group (groups come in order), merging runs bottom-up."""
        n = len(groups)
        heads = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
        sizes = np.diff(np.append(heads, n))
        head, size = np.repeat(heads, sizes), np.repeat(sizes, sizes)
        order = np.arange(n)
        local = np.arange(n) - head
        width = 1
        while width < sizes.max(initial=0):
            live = np.flatnonzero(size > width)
            mine = local[live] // width
            other = mine ^ 1
            low = np.minimum(other * width, size[live])
            high = np.minimum(low + width, size[live])
            base, first = low.copy(), (mine & 1) == 0
            while len(todo := np.flatnonzero(low < high)):
                middle = (low[todo] + high[todo]) // 2
                less, same = self.before(order[head[live[todo]] + middle], order[live[todo]])
                goes = less | (same & ~first[todo])
                low[todo[goes]] = middle[goes] + 1
                high[todo[~goes]] = middle[~goes]
            pair = (mine & ~1) * width
            to = head[live] + pair + (local[live] - mine * width) + (low - base)
            moved = order.copy()
            moved[to] = order[live]
            order = moved
            width *= 2
        return order


def repeated_runs(groups: np.ndarray, contexts: list[bytes], lead: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context index, low, high): the windows that take low to high bytes left of the anchor are repeated.

    A window is if another context of the group has it, too. Groups come in order.
    """
    right = Suffixes([c[k:] for c, k in zip(contexts, lead)])
    left = Suffixes([c[:k][::-1] for c, k in zip(contexts, lead)])
    ranks = []
    for side in (right, left):
        order = side.mergesort(groups)
        common = np.full(len(order), -1, np.int64)
        if len(order) > 1:
            near = groups[order[1:]] == groups[order[:-1]]
            common[1:][near] = side.verified(order[:-1][near], order[1:][near])
        ranks.append((order, common))
    (r_order, r_common), (l_order, l_common) = ranks
    heads = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
    sizes = np.diff(np.append(heads, len(groups)))

    # Two contexts: one extension to each side says it all.
    pair = heads[sizes == 2]
    low = np.maximum(GRAM + REACH - r_common[pair + 1], 0)
    high = np.minimum(l_common[pair + 1], REACH)
    pair, low, high = (x[low <= high] for x in (pair, low, high))
    out = [(np.concatenate([pair, pair + 1]), np.tile(low, 2), np.tile(high, 2))]

    # More: for each j, intervals of common prefixes on both sides.
    many = np.repeat(sizes > 2, sizes)
    at = np.flatnonzero(many)
    new_index = np.cumsum(many) - 1
    r_common, r_order = r_common[many[r_order]], new_index[r_order[many[r_order]]]
    l_common, l_order = l_common[many[l_order]], new_index[l_order[many[l_order]]]
    before, behind = lead[at], right.length[at] - GRAM
    r_class, l_class = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
    since = np.full(len(at), -1)  # the j from which on each context's windows are repeated, while they are
    for j in range(REACH + 2 if len(at) else 0):
        hit = np.zeros(len(at), bool)
        fits = np.flatnonzero((before >= j) & (behind >= REACH - j)) if j <= REACH else at[:0]
        if len(fits) > 1:
            r_class[r_order] = np.cumsum(r_common < GRAM + REACH - j)
            l_class[l_order] = np.cumsum((l_common < j) | (l_common < 0))
            both = r_class[fits] * (len(at) + 1) + l_class[fits]
            order = np.argsort(both)
            both = both[order]
            same = np.zeros(len(both), bool)
            same[1:] = both[1:] == both[:-1]
            same[:-1] |= same[1:]
            hit[fits[order[same]]] = True
        ended = np.flatnonzero(~hit & (since >= 0))
        out.append((at[ended], since[ended], np.full(len(ended), j - 1)))
        since[ended] = -1
        since[hit & (since < 0)] = j
    return tuple(np.concatenate(x) for x in zip(*out))


_SPAN = "doc_id long, text_key long, start long, stop long"


def _sort_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of the repeated windows of contexts that come in order of their anchors."""
    waiting: list[pa.RecordBatch] = []

    def solve(table: pa.Table) -> pa.RecordBatch:
        lead = table["lead"].to_numpy().astype(np.int64)
        context, low, high = repeated_runs(table["gram"].to_numpy(), table["bytes"].to_pylist(), lead)
        left, end = high, WINDOW - low
        keep = ~table["settled"].to_numpy(zero_copy_only=False)[context]
        context, left, end = context[keep], left[keep], end[keep]
        place = table["place"].to_numpy()[context]
        at = pa.array(context)
        return pa.record_batch(
            [table["doc_id"].combine_chunks().take(at), table["text_key"].combine_chunks().take(at)]
            + [pa.array(place - left), pa.array(place + end)],
            names=["doc_id", "text_key", "start", "stop"],
        )

    rows = 0
    for batch in batches:
        waiting.append(batch)
        rows += batch.num_rows
        if rows < SORTED_AT_ONCE:
            continue
        table = pa.Table.from_batches(waiting)
        grams = table["gram"].to_numpy()
        cut = int(np.searchsorted(grams, grams[-1], side="left"))  # the last anchor may go on
        if cut:
            yield solve(table.slice(0, cut))
            waiting = table.slice(cut).to_batches()
            rows -= cut
    if rows:
        yield solve(pa.Table.from_batches(waiting))


def _cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, 256):
            part = batch.slice(first, 256)
            wanted = part.column("wanted")
            rows = np.repeat(np.arange(part.num_rows), wanted.value_lengths().to_numpy())
            flat = wanted.flatten()
            place, lead, trail = (flat.field(k).to_numpy().astype(np.int64) for k in ("place", "lead", "trail"))
            content = part.column("text").cast(pa.binary())
            data = [content[k].as_buffer() for k in range(part.num_rows)]
            cut = [data[r].slice(p - a, a + GRAM + b).to_pybytes() for r, p, a, b in zip(rows.tolist(), place.tolist(), lead.tolist(), trail.tolist())]
            at = pa.array(rows)
            yield pa.record_batch(
                [part.column("doc_id").take(at), part.column("text_key").take(at)]
                + [flat.field(k) for k in ("gram", "place", "lead", "settled")]
                + [pa.array(cut, pa.binary())],
                names=["doc_id", "text_key", "gram", "place", "lead", "settled", "bytes"],
            )


def _count_windows(contexts: DataFrame) -> DataFrame:
    """Spans of repeated windows of anchors with too many contexts to sort: windows counted one by one."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = Suffixes(batch.column("bytes").to_pylist())
            lead = batch.column("lead").to_numpy().astype(np.int64)
            grams = batch.column("gram").to_numpy().view(np.uint64)
            for j in range(REACH + 1):
                fits = np.flatnonzero((lead >= j) & (pieces.length - lead - GRAM >= REACH - j))
                begin = pieces.start[fits] + lead[fits] - j
                sums = texts.mix(texts.span_hashes(pieces.sums, begin, begin + WINDOW))
                at = pa.array(fits)
                yield pa.record_batch(
                    [pa.array(texts.signed(texts.mix(sums ^ grams[fits])))]
                    + [batch.column(c).take(at) for c in ("doc_id", "text_key", "place", "settled")]
                    + [pa.array(np.full(len(fits), j, np.int32))],
                    names=["window", "doc_id", "text_key", "place", "settled", "j"],
                )

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            taken = batch.column("taken")
            rows = np.repeat(np.arange(batch.num_rows), taken.value_lengths().to_numpy())
            stop = batch.column("place").to_numpy()[rows] - taken.flatten().to_numpy() + WINDOW
            rows, start, stop = _united(rows, stop - WINDOW, stop)
            at = pa.array(rows)
            yield pa.record_batch(
                [batch.column("doc_id").take(at), batch.column("text_key").take(at), pa.array(start), pa.array(stop)],
                names=["doc_id", "text_key", "start", "stop"],
            )

    found = contexts.mapInArrow(trimmed(windows), "window long, doc_id long, text_key long, place long, settled boolean, j int")
    often = found.groupBy("window").agg(F.count("*").alias("times")).where("times > 1")
    again = found.where("NOT settled").join(often, "window", "left_semi")
    # At most 153 windows hold an anchor, so its list is short.
    by_anchor = again.groupBy("doc_id", "text_key", "place").agg(F.collect_list("j").alias("taken"))
    return by_anchor.mapInArrow(trimmed(runs), _SPAN)


def _united(rows: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of each row without overlaps or touching ends, in order."""
    order = np.lexsort((start, rows))
    rows, start, stop = rows[order], start[order], stop[order]
    far = int(stop.max(initial=0)) + 1  # rows one behind the other on one line
    reach = np.maximum.accumulate(rows * far + stop)
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (rows[1:] * far + start[1:] > reach[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(rows))[: len(first)] - 1
    return rows[first], start[first], reach[last] - rows[first] * far


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, 1024):
            part = batch.slice(k, 1024)
            spans = part.column("spans")
            counts = spans.value_lengths().fill_null(0).to_numpy()
            flat = spans.flatten()
            rows = np.repeat(np.arange(part.num_rows), counts)
            rows, start, stop = _united(rows, flat.field("start").to_numpy(), flat.field("stop").to_numpy())
            runs = np.bincount(rows, minlength=part.num_rows)
            removed = np.bincount(rows, weights=stop - start, minlength=part.num_rows).astype(np.int64)
            ends = np.cumsum(runs)
            size, digest = [], []
            for text, a, b in zip(part.column("text").fill_null("").cast(pa.binary()), (ends - runs).tolist(), ends.tolist()):
                data = memoryview(text.as_buffer())
                left, at = hashlib.sha256(), 0
                for x, y in zip(start[a:b].tolist(), stop[a:b].tolist()):
                    left.update(data[at:x])
                    at = y
                left.update(data[at:])
                size.append(len(data))
                digest.append(left.hexdigest())
            yield pa.record_batch(
                [part.column("doc_id"), pa.array(size, pa.int64()), pa.array(removed), pa.array(runs.astype(np.int64)), pa.array(digest, pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, start, stop): byte spans of repeated windows; they may overlap. docs has text_key."""
    found = kept(_repeated(docs.mapInArrow(trimmed(_post), _ANCHOR)), "anchors")
    settled = found.where("settled").select(
        "doc_id", "text_key", F.expr("place - lead").alias("start"), F.expr(f"place + {GRAM} + trail").alias("stop")
    )
    # Only anchors with some context that occurs once need their bytes: these, and one of each settled context.
    open_grams = (
        found.where("first")
        .groupBy("gram")
        .agg(F.count("*").alias("contexts"), F.max(~F.col("settled")).alias("open"))
        .where("open AND contexts > 1")
        .select("gram", (F.col("contexts") > GROUP).alias("large"))
    )
    wanted = found.where("first").join(open_grams, "gram")
    by_text = wanted.groupBy("doc_id", "text_key").agg(
        F.collect_list(F.struct("gram", "place", "lead", "trail", "settled", "large")).alias("wanted")
    )
    w = by_text.select(F.col("doc_id").alias("w_doc_id"), F.col("text_key").alias("w_text_key"), "wanted")
    with_text = docs.join(w, F.col("text_key").eqNullSafe(F.col("w_text_key")) & F.col("doc_id").eqNullSafe(F.col("w_doc_id")))
    schema = "doc_id long, text_key long, gram long, place long, lead int, settled boolean, bytes binary"
    small, large = (
        with_text.select("doc_id", "text_key", "text", F.expr(f"filter(wanted, x -> x.large = {y})").alias("wanted"))
        .where(F.size("wanted") > 0)
        .mapInArrow(trimmed(_cut_contexts), schema)
        for y in ("false", "true")
    )
    sorted_out = small.repartition("gram").sortWithinPartitions("gram").mapInArrow(trimmed(_sort_groups), _SPAN)
    spans = settled.unionByName(sorted_out)
    if open_grams.where("large").limit(1).count():
        spans = spans.unionByName(_count_windows(large))
    return spans


def without_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    small_batches(ship(docs.sparkSession))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))
    spans = kept(repeated_spans(docs), "spans")
    by_text = spans.groupBy(F.col("doc_id").alias("s_doc_id"), F.col("text_key").alias("s_text_key")).agg(
        F.collect_list(F.struct("start", "stop")).alias("spans")
    )
    both = F.col("doc_id").eqNullSafe(F.col("s_doc_id")) & F.col("text_key").eqNullSafe(F.col("s_text_key"))
    joined = docs.join(by_text, both, "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(trimmed(_removed), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op6_suffix_dedup(spark, folder: str) -> DataFrame:
    return without_repeats(documents(spark, folder))
