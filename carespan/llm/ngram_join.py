"""Similarity join of documents on word shingles, by skipping along set relations.

Two documents link when ``100 * |A & B| >= 80 * |A | B|`` for their sets of distinct
5-word shingles (words are lower-cased A-Z; a shorter document has its whole sequence
as one shingle; one without words has an empty set, linked with nothing).

* Equal sets are one node: a 64-bit sum over the set's mixed hashes. A task meeting a
  set again within a block posts it once.
* Order of shingles: those counted often in some block of any task, at most
  ``ORDERED`` of them, come last by count; all others come first by hash. The order
  only decides how much is compared, never what links.
* Index: a set of s shingles posts its first ``s - ceil(0.8 s) + 1`` ones with their
  positions. Linked sets share one of these. Entries whose shingle nobody else
  posts go at once; a list of an often counted shingle is dealt over salts for that.
* Block skipping: a list's entries stand in blocks by size, position and
  (second pass) component; a pair of blocks is opened only if the sizes can link, the
  positions still leave enough shingles behind them, and the components differ.
* Answers from similar sets: in each round of the first pass every set is compared with one
  leader of a list, of another component, the one it shares most entries with; rounds end
  when they hardly link any more. Linked sets are one component and
  never compared with each other. In the second pass every block is
  compared across components, first through leaders: with the known overlaps
  ``|x & l|`` and ``|z & l|``, ``|x & z|`` lies between ``|x & l| - |l - z|`` and
  ``|x & l| + |z - l|``. Only pairs that this does not decide are compared by themselves.

So no link between components is lost, and a group of n near copies costs about n
comparisons. Shingles are compared as 63-bit hashes: among n different
shingles of one corpus a wrong match has a chance of about n*n / 2**64.

Nulls, ties and odd rows: a null text is empty; rows repeated or with a null doc_id
are kept, each with its result (a null doc_id is never the smallest of a group with
another id); other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from carespan.llm import texts
from carespan.llm.components import connected
from carespan.llm.storage import documents, kept, ship, small_batches, trimmed

WIDTH = 5
BLOCK = 1 << 22  # shingles counted together in a task
OFTEN = 4  # least count in a block for a shingle to be reported
ORDERED = 1 << 20  # most shingles whose counts decide their order (8 MB)
SALTS = 64
FILTER_BITS = 1 << 26  # of the bitmap of asked rows (8 MB)
POSITION_BLOCKS = 8
ROUNDS = 8  # at most, of comparing with leaders before the rest is compared
_TOP = np.uint64(1 << 63)


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per chunk: its rows, the distinct shingles with their rows, sizes and set hashes."""
    for first, last, data, offsets in texts.chunks(batch.column("text")):
        data = texts.LOWER[data]
        found = texts.words(data, offsets)
        values, rows = texts.shingles(texts.word_hashes(data, found), found, WIDTH)
        n = last - first
        values, rows = texts.distinct_within_rows(values >> np.uint64(1), rows, n)
        sizes = np.bincount(rows, minlength=n)
        nodes = texts.mix(texts.sums_by_row(texts.mix(values + np.uint64(97)), rows, n) + sizes.astype(np.uint64))
        yield first, last, values, rows, sizes, nodes


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text_key, node, n) of documents and (token, times) of often counted shingles."""
    waiting: list[np.ndarray] = []

    def often() -> pa.RecordBatch:
        tokens, times = np.unique(np.concatenate(waiting or [np.zeros(0, np.uint64)]), return_counts=True)
        pick = times >= OFTEN
        none = pa.nulls(int(pick.sum()), pa.int64())
        waiting.clear()
        return pa.record_batch(
            [none, none, none, none, pa.array(texts.signed(tokens[pick])), pa.array(times[pick])],
            names=["doc_id", "text_key", "node", "n", "token", "times"],
        )

    for batch in batches:
        for first, last, values, _, sizes, nodes in _sets(batch):
            none = pa.nulls(last - first, pa.int64())
            ids = [batch.column(c).slice(first, last - first) for c in ("doc_id", "text_key")]
            yield pa.record_batch(
                [*ids, pa.array(texts.signed(nodes)), pa.array(sizes), none, none],
                names=["doc_id", "text_key", "node", "n", "token", "times"],
            )
            waiting.append(values)
            if sum(map(len, waiting)) >= BLOCK:
                yield often()
    yield often()


def _frequent(spark, counts: DataFrame) -> np.ndarray:
    """Up to ORDERED most counted shingles, the least counted first."""
    totals = counts.groupBy("token").agg(F.sum("times").alias("times"))
    totals = kept(totals, "often")
    sizes = {r.times: r.n for r in totals.groupBy("times").agg(F.count("*").alias("n")).orderBy(F.desc("times")).limit(1 << 16).collect()}
    least, room = 1 << 62, ORDERED
    for times in sorted(sizes, reverse=True):
        if sizes[times] > room:
            break
        least, room = times, room - sizes[times]
    rows = totals.where(F.col("times") >= least).toPandas()
    rows = rows.sort_values(["times", "token"], kind="stable")
    return rows["token"].to_numpy(dtype=np.int64).view(np.uint64)


def _index_entries(by_hash, rank):
    """Function for mapInArrow: entries (token, node, n, place) of the sets' prefixes."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, ranks = by_hash.value, rank.value
        seen: set[int] = set()
        for batch in batches:
            for first, last, values, rows, sizes, nodes in _sets(batch):
                if len(often):
                    at = np.minimum(np.searchsorted(often, values), len(often) - 1)
                    values = np.where(often[at] == values, _TOP | ranks[at], values)
                    values = values[texts.sort_within_rows(values, rows, last - first)]
                fresh = np.zeros(last - first, bool)
                for k in np.flatnonzero(sizes):
                    if (node := int(nodes[k])) not in seen:
                        seen.add(node)
                        fresh[k] = True
                if len(seen) > 1 << 20:
                    seen.clear()
                places = np.arange(len(rows)) - (np.cumsum(sizes) - sizes)[rows]
                take = fresh[rows] & (places <= sizes[rows] - (4 * sizes[rows] + 4) // 5)
                yield pa.record_batch(
                    [
                        pa.array(texts.signed(values[take])),
                        pa.array(texts.signed(nodes[rows[take]])),
                        pa.array(sizes[rows[take]].astype(np.int32)),
                        pa.array(places[take].astype(np.int32)),
                    ],
                    names=["token", "node", "n", "place"],
                )

    return entries


def _shared_entries(entries: DataFrame) -> DataFrame:
    """Entries whose shingle another set posts, each once; often counted ones stay for the lists."""
    salt = F.when(F.col("token") < 0, F.pmod(F.col("node"), F.lit(SALTS))).otherwise(F.lit(0))
    by_list = Window.partitionBy("token", "salt").orderBy("node")
    once = (
        entries.withColumn("salt", salt)
        .withColumn("before", F.lag("node").over(by_list))
        .where("before IS NULL OR before <> node")
    )
    return (
        once.withColumn("before", F.lag("node").over(by_list))
        .withColumn("after", F.lead("node").over(by_list))
        .where("token < 0 OR before IS NOT NULL OR after IS NOT NULL")
        .select("token", "node", "n", "place")
    )


def _blocks(entries: DataFrame) -> DataFrame:
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(1.25)).cast("int")
    block = F.floor(F.col("place") * (5 * POSITION_BLOCKS) / (F.col("n") + 5)).cast("int")
    return entries.withColumn("band", band).withColumn("block", block)


def _open_blocks(entries: DataFrame, key: list[str], apart: str) -> DataFrame:
    """Pairs of blocks (x, y) of one list that can hold a link and meet the condition ``apart``."""
    blocks = entries.groupBy("token", *key).agg(
        F.min("n").alias("small"),
        F.max("n").alias("large"),
        F.max(F.expr("n - place")).alias("behind"),
        F.min("node").alias("low"),
        F.max("node").alias("high"),
    )
    x, y = (blocks.select("token", *[F.col(c).alias(f"{c}_{s}") for c in blocks.columns[1:]]) for s in "xy")
    return x.join(y, "token").where(
        f"{apart} AND 5 * large_x >= 4 * small_y AND 5 * large_y >= 4 * small_x"
        " AND 9 * least(behind_x, behind_y) >= 4 * (small_x + small_y)"
    )


def _enough(x: str, y: str) -> str:
    """The sizes can link, and what lies behind the shared place on both sides is enough."""
    need = f"4 * ({x}.n + {y}.n)"
    return f"9 * least({x}.n - {x}.place, {y}.n - {y}.place) >= {need}"


def _bitmap(ids: DataFrame) -> np.ndarray:
    """A bit for each hash value modulo FILTER_BITS that some id has; its size is fixed."""
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    words = (
        ids.select(spot.alias("spot"))
        .groupBy(F.shiftright("spot", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(spot & 63 AS int))")).alias("bits"))
        .toPandas()
    )
    bits = np.zeros(FILTER_BITS >> 6, np.uint64)
    bits[words["word"].to_numpy(dtype=np.int64)] = words["bits"].to_numpy(dtype=np.int64).view(np.uint64)
    return bits


def _set_table(docs: DataFrame, sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, n, items) of the given nodes; items are the shingles as an array.

    The texts are read where they are: a bitmap of fixed size tells most rows that are not
    asked for, and only the sets of the others are shuffled to be matched exactly.
    """
    wanted = kept(sets.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("doc_id")), "wanted")
    bits = docs.sparkSession.sparkContext.broadcast(_bitmap(wanted))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = bits.value
        for batch in batches:
            spot = batch.column("spot").to_numpy()
            batch = batch.filter(pa.array((asked[spot >> 6] >> (spot & 63).astype(np.uint64)) & np.uint64(1) == 1))
            for first, last, values, _, sizes, hashes in _sets(batch):
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                yield pa.record_batch(
                    [
                        batch.column("doc_id").slice(first, last - first),
                        pa.array(texts.signed(hashes)),
                        pa.array(sizes),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(texts.signed(values))),
                    ],
                    names=["doc_id", "node", "n", "items"],
                )

    spotted = docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)).alias("spot"))
    built = spotted.mapInArrow(trimmed(build), "doc_id long, node long, n long, items array<long>")
    found = built.alias("t").join(
        wanted.alias("w"), F.expr("t.node = w.node AND t.doc_id <=> w.doc_id"), "left_semi"
    )
    return found.dropDuplicates(["node"]).select("node", "n", "items")


def _may_link(pairs: DataFrame, shared: DataFrame) -> DataFrame:
    """Pairs (a, b) whose posted shingles leave a link possible.

    Of two prefixes, the one that ends first in the common order has all common shingles up to
    its end in the other prefix; behind it there are at most ceil(0.8 n) - 1 more.
    """
    heads = shared.join(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node", "left_semi")
    heads = heads.groupBy("node").agg(F.first("n").alias("n"), F.collect_set("token").alias("tokens"))

    def side(x):
        return heads.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("tokens").alias(f"tokens_{x}"))

    return (
        pairs.select("a", "b")
        .join(side("a"), "a")
        .join(side("b"), "b")
        .withColumn("met", F.size(F.array_intersect("tokens_a", "tokens_b")))
        .where("9 * (met + greatest((4 * n_a + 4) div 5, (4 * n_b + 4) div 5) - 1) >= 4 * (n_a + n_b)")
        .select("a", "b", "n_a", "n_b")
    )


def _overlaps(pairs: DataFrame, items: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b, common) of each pair (a, b) of nodes, from the whole sets."""

    def side(x):
        return items.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("items").alias(f"items_{x}"))

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    common = F.size(F.array_intersect("items_a", "items_b")).cast("long")
    return both.select("a", "b", "n_a", "n_b", common.alias("common"))


def _with_roots(entries: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return entries.withColumn("root", F.col("node"))
    return entries.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _joined(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, root) after more links (a, b) are drawn between the components of ``roots``."""
    if roots is None:
        return connected(links)
    for x in "ab":
        links = links.join(roots.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}")), x, "left")
        links = links.withColumn(f"root_{x}", F.coalesce(f"root_{x}", x))
    found = connected(links.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))
    found = found.select(F.col("node").alias("old"), F.col("root").alias("new"))
    moved = roots.join(found, roots.root == found.old, "left").select("node", F.coalesce("new", "root").alias("root"))
    alone = found.join(roots, found.old == roots.node, "left_anti").select(F.col("old").alias("node"), F.col("new").alias("root"))
    return kept(moved.unionByName(alone), "roots")


def _leaders(placed: DataFrame, turn: int) -> DataFrame:
    """(a, b): for each set the leader of another component that it shares most entries with.

    A list's leader is, in the first round, the set with the largest part of its prefix in lists
    (the text that others were made from, rather than a changed one), then another one each round.
    """
    if turn:
        merit = placed.withColumn("merit", (F.xxhash64("node", F.lit(turn)) / float(1 << 63)))
    else:
        share = F.count("*") / F.first("n")
        merit = placed.join(placed.groupBy("node").agg(share.alias("merit")), "node")
    lists = (
        merit.groupBy("token", "band")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"), F.max(F.struct("merit", "node", "n", "place", "root")).alias("l"))
        .where("low <> high")
        .select("token", "band", *[F.col(f"l.{c}").alias(c) for c in ("node", "n", "place", "root")])
    )
    return (
        placed.alias("x")
        .join(lists.alias("l"), ["token", "band"])
        .where(f"x.root <> l.root AND {_enough('x', 'l')}")
        .groupBy(F.col("x.node").alias("a"), F.col("l.node").alias("b"))
        .agg(F.count("*").alias("times"))
        .groupBy("a")
        .agg(F.max(F.struct("times", "b")).alias("best"))
        .select("a", F.col("best.b").alias("b"))
    )


_LINKS = "180 * common >= 80 * (n_a + n_b)"


def _components(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, root, n_shingles, component_id) of every row of docs (doc_id, text)."""
    spark = small_batches(ship(docs.sparkSession))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))
    survey = "doc_id long, text_key long, node long, n long, token long, times long"
    survey = kept(docs.mapInArrow(trimmed(_survey), survey), "survey")
    docs = docs.drop("text_key")
    sets = survey.where("node IS NOT NULL").select("doc_id", "text_key", "node", "n")
    often = _frequent(spark, survey.where("node IS NULL"))
    order = np.argsort(often)
    by_hash = spark.sparkContext.broadcast(often[order])
    rank = spark.sparkContext.broadcast(order.astype(np.uint64))
    entries = docs.mapInArrow(trimmed(_index_entries(by_hash, rank)), "token long, node long, n int, place int")
    shared = kept(_blocks(_shared_entries(entries)), "shared")

    # First pass, in rounds: each set against one leader of another component.
    roots, led, linked = None, None, 0
    for turn in range(ROUNDS):
        placed = _with_roots(shared, roots)
        best = kept(_may_link(_leaders(placed, turn), shared).select("a", "b"), "best")
        nodes = best.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        tested = kept(_overlaps(best, kept(_set_table(docs, sets, nodes), "items")), "led")
        led = tested if led is None else led.unionByName(tested)
        links = tested.where(_LINKS).select("a", "b")
        new = links.count()
        linked += new
        roots = _joined(roots, links)
        if 20 * new <= linked:
            break

    # Second pass: blocks of different components.
    placed = kept(_with_roots(shared, roots), "placed")
    lists = placed.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    placed = placed.join(lists.select("token"), "token", "left_semi")
    key = ["root", "band", "block"]
    opened = _open_blocks(placed, key, "root_x < root_y")
    x = placed.select("token", *[F.col(c).alias(f"{c}_x") for c in ("root", "band", "block", "node", "n", "place")])
    y = placed.select("token", *[F.col(c).alias(f"{c}_y") for c in ("root", "band", "block", "node", "n", "place")])
    cross = kept(
        opened.select("token", *[f"{c}_{s}" for s in "xy" for c in ("root", "band", "block")])
        .join(x, ["token", "root_x", "band_x", "block_x"])
        .join(y, ["token", "root_y", "band_y", "block_y"])
        .where("9 * least(n_x - place_x, n_y - place_y) >= 4 * (n_x + n_y)")
        .select(
            F.least("node_x", "node_y").alias("a"),
            F.greatest("node_x", "node_y").alias("b"),
        )
        .distinct(),
        "cross",
    )
    known = (
        led.where(_LINKS)
        .groupBy(F.col("a").alias("z"))
        .agg(F.max(F.struct("common", "b", "n_b")).alias("best"))
        .select("z", F.col("best.b").alias("l"), F.col("best.n_b").alias("n_l"), F.col("best.common").alias("common_zl"))
    )
    cross = kept(_may_link(cross, shared), "possible")
    # Pairs seen from the member that has a linked leader; without one a pair decides itself.
    sided = cross.join(known, cross.b == known.z, "left").select(
        cross["*"], F.col("l"), F.col("n_l"), F.col("common_zl")
    )
    nodes = sided.select(F.explode(F.array("a", "b", "l")).alias("node")).where("node IS NOT NULL").distinct()
    items = kept(_set_table(docs, sets, nodes), "items")
    through = kept(
        _overlaps(sided.where("l IS NOT NULL AND l <> a").select("a", F.col("l").alias("b")).distinct(), items)
        .select("a", F.col("b").alias("l"), F.col("common").alias("common_al")),
        "through",
    )
    bounded = sided.join(through, ["a", "l"], "left").withColumn(
        "least_common", F.expr("common_al - (n_l - common_zl)")
    ).withColumn("most_common", F.expr("common_al + (n_b - common_zl)"))
    sure = bounded.where("180 * least_common >= 80 * (n_a + n_b)").select("a", "b")
    open_pairs = bounded.where(
        "coalesce(180 * most_common >= 80 * (n_a + n_b), true) AND NOT coalesce(180 * least_common >= 80 * (n_a + n_b), false)"
    ).select("a", "b")
    checked = _overlaps(open_pairs, items).where(_LINKS).select("a", "b")
    more = kept(sure.unionByName(checked), "more")
    roots = _joined(roots, more)

    by_node = sets.groupBy("node").agg(F.min("doc_id").alias("least_id"))
    by_node = by_node.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = by_node.groupBy("root").agg(F.min("least_id").alias("component"))
    named = by_node.join(ids, "root").select("node", "root", "component")
    return (
        sets.join(named, "node", "left")
        .select(
            "doc_id",
            "text_key",
            "root",
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
        )
    )


def similar_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row; links as the module says."""
    return _components(docs).select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of docs for each component, the one with its smallest id; columns as they are.

    Rows without words are no copies of each other and all stay. Of equal rows one stays. For the choice a
    null doc_id counts as a large number made from the text.
    """
    number = F.coalesce(F.col("doc_id").cast("long"), F.shiftrightunsigned(F.xxhash64("text"), 2) + (1 << 62))
    keyed = docs.withColumns({"__doc": number, "__text": F.xxhash64("text")})
    found = _components(keyed.select(F.col("__doc").alias("doc_id"), "text"))
    chosen = (
        found.where("n_shingles > 0")
        .groupBy("root")
        .agg(F.min(F.struct("doc_id", "text_key")).alias("one"))
        .select(F.col("one.doc_id").alias("__doc"), F.col("one.text_key").alias("__text"))
    )
    empty = found.where("n_shingles = 0").select(F.col("doc_id").alias("__doc"), F.col("text_key").alias("__text"))
    stay = keyed.join(chosen.unionByName(empty).distinct(), ["__doc", "__text"], "left_semi")
    return stay.dropDuplicates(["__doc", "__text"]).select(*[F.col(f"`{c}`") for c in docs.columns])


def op1_ngram_jaccard_join(spark, folder: str) -> DataFrame:
    return similar_components(documents(spark, folder))
