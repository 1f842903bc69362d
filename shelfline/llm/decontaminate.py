"""Benchmark decontamination: n-gram seeds find passages, Smith-Waterman alignment scores them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfline.llm.common import ROW, each, grams, keyed, pieces, utf8, words

#: Words of a seed. Every seed counts, common ones too: an edited copy may have kept no other.
SEED = 3
#: Cells of passages that are aligned at once.
CELLS = 1 << 18
#: Scores of the alignment by words, and the least share of an item's perfect score that counts as a copy.
MATCH, MISMATCH, GAP = 2, -1, 1
COPY = 0.5
#: Items of fewer words must be matched nearly whole.
SHORT, SHORT_COPY = 8, 0.9
#: Bits of the map of seed hashes that goes to every task; its size does not depend on the benchmark's.
MAP_BITS = 22

INSIDE = np.zeros(256, bool)
INSIDE[48:58] = INSIDE[65:91] = INSIDE[97:123] = INSIDE[128:] = True


def item_grams(items: DataFrame) -> DataFrame:
    """(item_id, length, hashes, gram, place) of every seed of the items, from (item_id, text); equal items share an id's text."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, (part, edges) in zip(batch.column("item_id").to_pylist(), each(*utf8(batch.column("text"))), strict=True):
                _, _, hashed, firsts = words(part, edges, INSIDE)
                found, at = grams(hashed, firsts, SEED)
                rows += [{"item_id": item, "length": len(hashed), "hashes": hashed.tobytes(), "gram": int(g), "place": int(p)} for g, p in zip(found.view(np.int64), at, strict=True)]
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("item_id", pa.int64()), ("length", pa.int64()), ("hashes", pa.binary()), ("gram", pa.int64()), ("place", pa.int64())]))

    return items.mapInArrow(scan, "item_id long, length long, hashes binary, gram long, place long")


def seed_hits(docs: DataFrame, seeds: DataFrame) -> DataFrame:
    """(row id, at, gram) of the places whose n-gram may be a seed: a map of hash slots, of fixed size, is sent to every task."""
    slots = seeds.select(F.shiftrightunsigned("gram", 64 - MAP_BITS).cast("int").alias("slot")).distinct().toPandas()["slot"].to_numpy()
    marked = np.zeros(1 << MAP_BITS, bool)
    marked[slots] = True
    packed = np.packbits(marked).tobytes()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(np.frombuffer(packed, np.uint8)).astype(bool)
        for batch in batches:
            ids = batch.column(ROW).to_numpy()
            for lo, _, part, edges in pieces(*utf8(batch.column("text"))):
                _, _, hashed, firsts = words(part, edges, INSIDE)
                found, at = grams(hashed, firsts, SEED)
                hit = np.flatnonzero(known[(found >> np.uint64(64 - MAP_BITS)).astype(np.int64)])
                row = np.searchsorted(firsts, at[hit], "right") - 1
                yield pa.RecordBatch.from_arrays([pa.array(ids[lo + row]), pa.array(at[hit] - firsts[row]), pa.array(found[hit].view(np.int64))], [ROW, "at", "gram"])

    return docs.select(ROW, "text").mapInArrow(scan, f"`{ROW}` long, at long, gram long")


def aligned(items: list[np.ndarray], passages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score of each item with its passage, and the passage word at which it ends.

    All pairs advance together, one item word at a time; gaps along the passage are a running maximum.
    """
    best, end = np.zeros(len(items), np.int64), np.zeros(len(items), np.int64)
    order = sorted(range(len(items)), key=lambda i: (len(passages[i]), len(items[i])))
    lo = 0
    while lo < len(order):
        rows = order[lo : lo + 256]
        rows = [i for n, i in enumerate(rows, 1) if n == 1 or n * len(passages[i]) <= CELLS]
        lo += len(rows)
        wide, long = max(len(passages[i]) for i in rows), max(len(items[i]) for i in rows)
        text, item = np.zeros((len(rows), wide), np.uint64), np.zeros((len(rows), long), np.uint64)
        for r, i in enumerate(rows):
            text[r, : len(passages[i])] = passages[i]
            item[r, : len(items[i])] = items[i]
        slope = GAP * np.arange(wide + 1)
        above = np.zeros((len(rows), wide + 1), np.int64)
        for j in range(long):
            equal = (text == item[:, j : j + 1]) & (text != 0)
            now = np.zeros_like(above)
            now[:, 1:] = np.maximum(above[:, :-1] + np.where(equal, MATCH, MISMATCH), above[:, 1:] - GAP)
            np.maximum(now, 0, out=now)
            above = np.maximum.accumulate(now + slope, axis=1) - slope
            top = above.argmax(axis=1)
            value = above[np.arange(len(rows)), top]
            better = value > best[rows]
            best[rows] = np.where(better, value, best[rows])
            end[rows] = np.where(better, top, end[rows])
    return best, end


def passages(hits: DataFrame, seeds: DataFrame) -> DataFrame:
    """(row id, item_id, length, hashes, first, end, seeds): stretches of a text in which seeds of one item lie close together."""
    known = seeds.withColumn("body", F.xxhash64("hashes"))  # tells texts of one item id apart
    met = hits.join(known.select("item_id", "body", "length", "gram", "place"), "gram")
    of = W.partitionBy(ROW, "item_id", "body").orderBy("at", "place")
    met = met.withColumn("fresh", F.when(F.col("at") - F.lag("at").over(of) <= F.col("length"), 0).otherwise(1)).withColumn("run", F.sum("fresh").over(of))
    found = met.groupBy(ROW, "item_id", "body", "length", "run").agg(
        F.min(F.col("at") - F.col("place")).alias("first"), F.max(F.col("at") - F.col("place") + F.col("length")).alias("end"), F.countDistinct("place").alias("seeds")
    )
    return found.join(known.select("item_id", "body", "hashes").distinct(), ["item_id", "body"]).drop("body", "run")


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(row id, doc_id, item_id, score, first_word, end_word, seeds): each text that holds a copy of an item, with its best passage.

    Words are runs of a-z (A-Z lower-cased), 0-9 and non-ASCII characters. Edited and paraphrased copies score the share of the
    item's perfect alignment that is left. Every stretch that holds a seed of the item, however common, is aligned with as much
    text around it as a copy can stretch to, unless too few of the item's words occur there for any alignment to be a copy; a copy
    with no SEED words of the item left in a row is not found. first_word and end_word bound the alignment, seeds counts the item's
    seeds in the stretch. NULL texts and items are empty; items of fewer than SEED words are never found, as
    nothing tells them from chance. Repeated rows are judged each; empty tables give no rows.
    """
    base = keyed(docs, id_col, text_col)
    seeds = item_grams(items.select(F.col(item_col).cast("long").alias("item_id"), F.coalesce(F.col(item_text), F.lit("")).alias("text")).distinct())
    found = passages(seed_hits(base, seeds), seeds)
    per_row = found.groupBy(ROW).agg(F.collect_list(F.struct("item_id", "hashes", "first", "end", "seeds")).alias("found"))

    def least(item: np.ndarray) -> float:
        return SHORT_COPY if len(item) < SHORT else COPY

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(ROW, pa.int64()), ("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("seeds", pa.int64())])
        for batch in batches:
            rows, left, right = [], [], []
            texts = each(*utf8(batch.column("text")))
            for row, doc, wanted, (part, edges) in zip(batch.column(ROW).to_pylist(), batch.column("doc_id").to_pylist(), batch.column("found").to_pylist(), texts, strict=True):
                hashed = words(part, edges, INSIDE)[2]
                for p in wanted:
                    item = np.frombuffer(p["hashes"], np.uint64)
                    # A copy has at most as many words put in as the item has: more cost what COPY leaves.
                    lo = max(0, p["first"] - len(item))
                    passage = hashed[lo : p["end"] + len(item)]
                    # Words that occur nowhere in the passage cannot match, so this share bounds the score.
                    if np.isin(item, passage).sum() >= least(item) * len(item):
                        rows.append((row, doc, p["item_id"], lo, p["seeds"]))
                        left.append(item)
                        right.append(passage)
            best, end = aligned(left, right)
            share = best / np.array([MATCH * len(x) for x in left], float)
            copies = [i for i in range(len(rows)) if share[i] >= least(left[i])]
            # The best alignment of what ends there, read backwards, ends where it begins.
            _, back = aligned([left[i][::-1] for i in copies], [right[i][: end[i]][::-1] for i in copies])
            out = []
            for i, n in zip(copies, back.tolist(), strict=True):
                row, doc, item_id, lo, found_seeds = rows[i]
                out.append(dict(zip(schema.names, (row, doc, item_id, float(share[i]), lo + int(end[i]) - n, lo + int(end[i]), found_seeds), strict=True)))
            yield pa.RecordBatch.from_pylist(out, schema)

    scored = base.join(per_row, ROW).mapInArrow(score, f"`{ROW}` long, doc_id long, item_id long, score double, first_word long, end_word long, seeds long")
    best = F.row_number().over(W.partitionBy(ROW, "item_id").orderBy(F.desc("score"), "first_word", F.desc("seeds")))
    return scored.withColumn("best", best).filter("best = 1").drop("best")


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that hold no copy of an item."""
    found = contaminated(docs, items, id_col, text_col).select(ROW).distinct()
    return docs.withColumn(ROW, F.monotonically_increasing_id()).join(found, ROW, "left_anti").drop(ROW)
