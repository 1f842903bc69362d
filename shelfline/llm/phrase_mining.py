"""Phrase collocations by a weighted de Bruijn graph.

Nodes are runs of four words, edges runs of five; an edge joins its first four words to its last four and weighs what it occurs.
Counts of shorter runs follow from the flow: a run of k words occurs as often as the runs of k + 1 words that begin with it, and
once more for each piece that ends with it.

Two passes over the texts. The first fills a fixed number of counters with adjacent pairs and triples of words. One whose counter stays
below `min_count` is surely rare, so no phrase of that count holds it, and the second pass ends the piece inside such pairs and
triples. What shares a counter only leaves more runs, never fewer. The second pass emits at each word the longest run that starts
there, five words or up to the end of its piece: the former are edges, the latter the corrections for piece ends. Runs are words
themselves, not hashes.

A node whose only edge in and only edge out have its own weight is inside a path without branches. Such paths are compacted by
pointer doubling; nodes inside are never results, for the edge that holds them weighs the same.

Cases: NULL text is empty, NULL lang is `und`; empty texts and pieces give nothing; repeated rows count each time; ids are not
read and columns of other names are ignored; an empty table gives no rows. Texts of any length are taken whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfline.llm.common import GRAM, checkpointed, lowered, mixed, pieces, utf8, words

EDGE = 5
#: Runs of up to so many words are counted before any run is emitted.
COUNTED = 3
#: Counters of pairs and triples, of which the driver gets one bit each; more make the second pass read fewer rare runs.
SLOTS = 1 << 24
BLOCK = 1 << 14
#: Groups in which the tasks' counters are added up first.
MERGED = 8
#: Bytes of text whose runs a task sums at once.
SHARE = 8 << 20
#: Runs that a task holds before it sums them, or hands them on where half as many are left.
HELD = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09]] = True
STOP = np.zeros(256, bool)
STOP[list(b".,;:!?\n\x0b\x0c\r")] = True
INSIDE = ~(SPACE | STOP)


class Tokens:
    """Words of some rows: bytes, hash, language and whether the next word follows in the same piece."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, langs: np.ndarray):
        self.raw = raw
        self.start, self.end, self.hashed, firsts = words(raw, offsets, INSIDE)
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(firsts))
        self.lang = langs[row]
        stops = np.append(0, np.cumsum(STOP[raw], dtype=np.int64))
        self.linked = np.zeros(len(row), bool)
        self.linked[:-1] = (row[:-1] == row[1:]) & (stops[self.end[:-1]] == stops[self.start[1:]])

    def slots(self, seeds: np.ndarray, count: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For runs of two and three words: the words that one starts with, and its counter."""
        seed, found = seeds[self.lang], []
        for k in range(2, COUNTED + 1):
            at = np.flatnonzero(np.logical_and.reduce([self.linked[j : max(0, len(seed) - k + 1) + j] for j in range(k - 1)]))
            total = seed[at] + np.uint64(k)
            for j in range(k):
                total = total + self.hashed[at + j] * GRAM[j]
            found.append((at, (mixed(total) & np.uint64(count - 1)).astype(np.int64)))
        return found

    def spelled(self) -> tuple[pa.Array, np.ndarray]:
        """The different words, A-Z lower-cased, and the number of each word among them."""
        offsets = np.append(0, np.cumsum(self.end - self.start))
        data = lowered()[self.raw[INSIDE[self.raw]]]
        text = pa.LargeStringArray.from_buffers(len(self.start), pa.py_buffer(offsets), pa.py_buffer(data))
        coded = text.dictionary_encode()
        return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def tokens(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray, Tokens]]:
    """(languages, a number from each, words) of about SHARE bytes of text at a time."""
    coded = batch.column("lang").dictionary_encode()
    names, number = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
    seeds = np.array([zlib.crc32(x.encode()) for x in names.to_pylist()], np.uint64)
    for first, end, raw, offsets in pieces(*utf8(batch.column("text")), limit=SHARE):
        yield names, seeds, Tokens(raw, offsets, number[first:end])


def frequent_slots(docs: DataFrame, min_count: int, slots: int = SLOTS) -> bytes:
    """One bit for each counter of pairs and triples: whether it reaches min_count over all rows of (lang, text)."""
    block = min(BLOCK, slots)
    small = np.min_scalar_type(min_count)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(slots, small)
        for batch in batches:
            for _, seeds, found in tokens(batch):
                for _, slot in found.slots(seeds, slots):
                    which, n = np.unique(slot, return_counts=True)
                    counts[which] = np.minimum(n + counts[which], min_count)
        blocks = counts.reshape(-1, block)
        used = np.flatnonzero(blocks.any(axis=1))
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array([zlib.compress(blocks[b], 1) for b in used], pa.binary())], ["block", "counts"])

    def total(table: pa.Table) -> np.ndarray:
        sums = np.zeros(block, np.int64)
        for x in table.column("counts"):
            sums = np.minimum(sums + np.frombuffer(zlib.decompress(x.as_buffer()), small), min_count)
        return sums.astype(small)

    def added(table: pa.Table) -> pa.Table:
        return pa.table({"block": table.column("block")[:1], "counts": pa.array([zlib.compress(total(table), 1)], pa.binary())})

    def judged(table: pa.Table) -> pa.Table:
        return pa.table({"block": table.column("block")[:1], "bits": pa.array([np.packbits(total(table) >= min_count).tobytes()], pa.binary())})

    parts = docs.mapInArrow(count, "block long, counts binary").withColumn("part", F.spark_partition_id() % MERGED)
    merged = parts.groupBy("block", "part").applyInArrow(added, "block long, counts binary").groupBy("block").applyInArrow(judged, "block long, bits binary")
    bits = np.zeros((slots // block, block // 8), np.uint8)
    for row in merged.collect():  # slots / block rows at most, slots / 8 bytes in all
        bits[row["block"]] = np.frombuffer(row["bits"], np.uint8)
    return bits.tobytes()


def runs(docs: DataFrame, frequent: bytes, slots: int = SLOTS) -> DataFrame:
    """(lang, phrase, k, n): the longest run of up to EDGE words from each word on; k < EDGE where a piece or frequent triples end."""

    names = ["lang", "phrase", "k", "n"]

    def found_in(langs: pa.Array, seeds: np.ndarray, found: Tokens, bits: np.ndarray) -> Iterator[pa.Table]:
        spelling, word = found.spelled()
        reach = [np.ones(len(word) + EDGE, bool)]  # words from which on the run of 1, 2, 3 may be frequent
        for at, slot in found.slots(seeds, slots):
            own = np.zeros(len(word) + EDGE, bool)
            own[at] = bits[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8) & 1
            own[:-1] &= reach[-1][:-1] & reach[-1][1:]
            reach.append(own)
        longest = np.ones(len(word), np.int64)
        for k in range(2, EDGE + 1):
            held = reach[min(k, COUNTED) - 1]
            longest[(longest == k - 1) & held[max(0, k - COUNTED) :][: len(word)]] = k
        place, code = np.arange(len(word)), found.lang.astype(np.int64)
        for k in range(1, EDGE + 1):
            code = np.unique(code * len(spelling) + word[place + k - 1], return_inverse=True)[1]
            ends = longest[place] == k
            _, first, n = np.unique(code[ends], return_index=True, return_counts=True)
            if len(first):
                where = place[ends][first]
                spelt = [spelling.take(pa.array(word[where + j])) for j in range(k)]
                phrase = pc.binary_join_element_wise(*spelt, pa.scalar(" ", pa.large_string())) if k > 1 else spelt[0]
                lang = langs.take(pa.array(found.lang[where]))
                yield pa.table([lang.cast(pa.string()), phrase.cast(pa.string()), pa.array(np.full(len(n), k, np.int32)), pa.array(n)], names)
            place, code = place[~ends], code[~ends]

    def summed(parts: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(parts).group_by(names[:3], use_threads=False).aggregate([("n", "sum")]).rename_columns(names)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(frequent, np.uint8)
        held: list[pa.Table] = []
        for batch in batches:
            for piece in tokens(batch):
                held += found_in(*piece, bits)
                if sum(t.num_rows for t in held) >= HELD:
                    held = [summed(held)]
                    if held[0].num_rows >= HELD // 2:
                        yield from held.pop().to_batches(1 << 16)
        if held:
            yield from summed(held).to_batches(1 << 16)

    return docs.mapInArrow(scan, "lang string, phrase string, k int, n long").groupBy("lang", "phrase", "k").agg(F.sum("n").alias("n"))


def first_words(phrase: F.Column, k: F.Column | int) -> F.Column:
    return F.substring_index(phrase, " ", k) if isinstance(k, int) else F.call_function("substring_index", phrase, F.lit(" "), k)


def without(phrase: F.Column, first: F.Column) -> F.Column:
    """What follows the words `first` and a space."""
    return F.substr(phrase, F.length(first) + 2)


def flow(counted: DataFrame) -> list[DataFrame]:
    """(lang, phrase, a) of all runs of 1, 2, ... EDGE words: those of k + 1 words summed by their first k, plus the ends after k."""
    level = counted.filter(F.col("k") == EDGE).select("lang", "phrase", F.col("n").alias("a"))
    levels = [level]
    for k in range(EDGE - 1, 0, -1):
        ends = counted.filter(F.col("k") == k).select("lang", "phrase", F.col("n").alias("a"))
        through = level.select("lang", first_words(F.col("phrase"), k).alias("phrase"), "a")
        level = through.unionByName(ends).groupBy("lang", "phrase").agg(F.sum("a").alias("a"))
        levels.insert(0, level)
    return levels


def unary_paths(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(lang, phrase, head, place, length) of each edge: its path's first edge, its place in it from 0, the edges of the path.

    Two edges follow each other in a path where the node between them weighs what both weigh: nothing else enters or leaves it.
    Such edges form no ring, as every text that walks a ring has come in at some node, which then weighs more than the edge before.
    """
    edge, node = F.col("phrase"), nodes.select("lang", F.col("phrase").alias("node"), "a")
    into = edges.withColumn("node", without(edge, first_words(edge, 1))).join(node, ["lang", "node", "a"]).select("lang", "node", edge.alias("before"))
    out = edges.withColumn("node", first_words(edge, EDGE - 1)).join(node, ["lang", "node", "a"]).select("lang", "node", edge)
    links = into.join(out, ["lang", "node"]).select("lang", "phrase", "before")
    step = checkpointed(edges.select("lang", "phrase").join(links, ["lang", "phrase"], "left").select("lang", "phrase", F.coalesce("before", "phrase").alias("head"), F.col("before").isNotNull().cast("long").alias("place")))
    while True:
        ahead = step.select("lang", F.col("phrase").alias("head"), F.col("head").alias("further"), F.col("place").alias("more"))
        longer = checkpointed(step.join(ahead, ["lang", "head"]).select("lang", "phrase", F.col("further").alias("head"), (F.col("place") + F.col("more")).alias("place"), (F.col("more") > 0).alias("moved")))
        step = longer.drop("moved")
        if longer.filter("moved").isEmpty():
            break
    lengths = step.groupBy("lang", "head").agg(F.count(F.lit(1)).alias("length"))
    return step.join(lengths, ["lang", "head"]).select("lang", "phrase", "head", "place", "length")


def mine_phrases(docs: DataFrame, min_count: int = 100, top: int = 2000, slots: int = SLOTS, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The best collocations of 2 to EDGE words per language: lang, rank, phrase, a, l, r, n, score, passage_words.

    a counts the phrase, n all words of the language. Every cut after the first words, l, with the rest, r, scores
    floor(1000 * a * n / (l * r)) in exact decimals; the lowest counts, of equal ones the earliest. A phrase whose words lie in a
    longer one of the same count is no result. Order: score and a descending, phrase by bytes. `passage_words` is the length of
    the passage without branches that a phrase of EDGE words lies in, NULL for shorter ones. Counts are exact up to 10^17.
    """
    texts = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    counted = checkpointed(runs(texts, frequent_slots(texts, min_count, slots), slots))
    levels = flow(counted)
    kept = [x.filter(F.col("a") >= min_count).withColumn("k", F.lit(k)) for k, x in enumerate(levels, 1)]
    known = kept[0]
    for x in kept[1:]:
        known = known.unionByName(x)
    known = checkpointed(known)
    at = lambda k: known.filter(F.col("k") == k).drop("k")
    paths = checkpointed(unary_paths(at(EDGE), at(EDGE - 1)))
    phrase = F.col("phrase")

    inside = paths.filter("place > 0").select("lang", first_words(phrase, EDGE - 1).alias("phrase"))
    last = without(phrase, first_words(phrase, 1))
    longer = known.filter("k > 2").select("lang", F.explode(F.array(first_words(phrase, F.col("k") - 1), last)).alias("phrase"), F.col("a").alias("longer"))
    most = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    open_ended = known.filter("k > 1").join(inside, ["lang", "phrase"], "left_anti")
    results = open_ended.join(most, ["lang", "phrase"], "left").filter(F.coalesce("longer", F.lit(0)) < F.col("a")).drop("longer")

    cuts = results.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1))).withColumn("left", first_words(phrase, F.col("cut"))).withColumn("right", without(phrase, F.col("left")))
    part = lambda side, name: known.select("lang", phrase.alias(side), F.col("a").alias(name))
    total = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    cuts = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"]).join(total, "lang")
    exact = lambda c: F.col(c).cast("decimal(18,0)")
    score = F.call_function("div", F.lit(1000).cast("decimal(4,0)") * exact("a") * exact("n"), exact("l") * exact("r"))
    lowest = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("lowest")
    scored = cuts.groupBy("lang", "phrase", "k", "a", "n").agg(lowest).select("lang", "phrase", "k", "a", "lowest.l", "lowest.r", "n", "lowest.score")

    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    passages = paths.select("lang", "phrase", (F.col("length") + EDGE - 1).alias("passage_words"))
    return best.join(passages, ["lang", "phrase"], "left").select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score", "passage_words")
