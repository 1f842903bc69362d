"""Hard negatives by coordinate pruning over length buckets.

Rows are dealt into buckets of like length, a bucket into blocks of bounded size. A block holds one sorted list of normalised values
for each coordinate. An anchor with a score bound looks up, for the coordinates where it is largest itself, the range of values that
a vector of the block can have if its score reaches the bound, intersects what the lists give, and computes exact scores for the rest.
Whole buckets are passed over where even a parallel vector is too short.

Positives come first: a pilot of the longest rows of each label bounds the anchor's k-th best score from below, then all rows of the
label are searched with that bound. The positives' scores bound the search for negatives among all rows of other labels. Every block
gives at most k rows per anchor and positive, which are merged by rank.

Anchors are dealt into blocks as well, so no task holds more than one block of rows and one of anchors. Vectors of other lengths are
compared as if zeros followed. Scores are exact; beyond 64 bits they stay at the largest 64-bit number of their sign.

Cases: rows with a NULL id, label or vector, a NULL or non-finite component, or a length beyond double range, take no part; an empty or zero vector scores 0 with
all; a repeated row is a row of its own, so a copy of an anchor can be its positive; equal scores go by id; an empty table, or one
without anchors, gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfline.llm.common import ROW, checkpointed

#: A component x becomes floor(SCALE * x).
SCALE = 256
#: Rows of a block, anchors of a block, rows of a label that bound the positives' scores, focus coordinates of an anchor.
BLOCK, ANCHORS, PILOT, FOCUS = 4096, 2048, 1024, 4
#: Length buckets to a doubling of the length.
STEPS = 4
SHORTEST = -(1 << 20)
SLACK = 1e-9


def vectors(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(row id, id, label, vector, norm, bucket) of the rows that take part: components as doubles in binary, length and bucket."""
    column = lambda c: F.col(f"`{c}`")
    chosen = rows.select(F.monotonically_increasing_id().alias(ROW), column(id_col).cast("long").alias("id"), column(label_col).cast("string").alias("label"), column(vector_col).cast("array<double>").alias("vector"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            lists = lists.cast(pa.large_list(pa.float64()))
            offsets = lists.offsets.to_numpy()
            flat = np.floor(lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]] * SCALE) if len(lists) else np.zeros(0)
            offsets = offsets - offsets[0] if len(lists) else offsets
            bad = np.append(0, np.cumsum(~np.isfinite(flat)))
            fine = bad[offsets[1:]] == bad[offsets[:-1]]
            each = [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            norms = np.array([np.linalg.norm(v) for v in each])
            buckets = np.full(len(each), SHORTEST, np.int64)
            some = fine & (norms > 0) & np.isfinite(norms)
            buckets[some] = np.floor(np.log2(norms[some]) * STEPS)
            found = pa.RecordBatch.from_arrays(
                [batch.column(ROW), batch.column("id"), batch.column("label"), pa.array([v.tobytes() for v in each], pa.binary()), pa.array(norms), pa.array(buckets)],
                [ROW, "id", "label", "vector", "norm", "bucket"],
            )
            yield found.filter(pa.array(fine & np.isfinite(norms)))

    known = chosen.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull())
    return known.mapInArrow(scan, f"`{ROW}` long, id long, label string, vector binary, norm double, bucket long")


def matrix(columns: pd.Series, width: int) -> np.ndarray:
    """One row for each vector, zeros behind its end."""
    out = np.zeros((len(columns), width))
    for i, v in enumerate(columns):
        row = np.frombuffer(v, np.float64)
        out[i, : len(row)] = row
    return out


def exact_scores(rows: np.ndarray, norms: np.ndarray, anchor: np.ndarray, norm: float) -> np.ndarray:
    """Inner products as 64-bit integers: in doubles where lengths bound all sums below 2^53, else in whole numbers."""
    safe = norms * norm < 2.0**52
    out = np.zeros(len(rows), np.int64)
    out[safe] = rows[safe] @ anchor
    most = (1 << 63) - 1
    for i in np.flatnonzero(~safe):
        out[i] = max(-most, min(most, sum(int(a) * int(b) for a, b in zip(rows[i], anchor, strict=True))))
    return out


class Lists:
    """A block of rows with a sorted list for each coordinate of its normalised vectors."""

    def __init__(self, rows: pd.DataFrame, width: int):
        self.ids, self.rows, self.labels = rows["id"].to_numpy(), rows[ROW].to_numpy(), rows["label"].to_numpy()
        self.vectors, self.norms = matrix(rows["vector"], width), rows["norm"].to_numpy()
        self.longest = self.norms.max(initial=0.0)
        self.unit = self.vectors / np.where(self.norms > 0, self.norms, 1.0)[:, None]
        self.order = np.argsort(self.unit, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.unit, self.order, axis=0)

    def candidates(self, anchor: np.ndarray, norm: float, bound: float) -> np.ndarray:
        """Numbers of rows whose score may reach the bound."""
        if not bound > 0 or norm == 0:
            return np.arange(len(self.ids)) if not bound > 0 else np.zeros(0, np.int64)
        cosine = bound / norm / self.longest - SLACK if self.longest else 2.0
        if cosine > 1:
            return np.zeros(0, np.int64)
        unit = anchor / norm
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        angle, width = np.arccos(np.clip(unit[focus], -1, 1)), np.arccos(cosine)
        low, high = np.cos(np.minimum(np.pi, angle + width)) - SLACK, np.cos(np.maximum(0, angle - width)) + SLACK
        begin = np.array([np.searchsorted(self.sorted[:, f], x) for f, x in zip(focus, low, strict=True)])
        end = np.array([np.searchsorted(self.sorted[:, f], x, "right") for f, x in zip(focus, high, strict=True)])
        by_size = np.argsort(end - begin, kind="stable")
        first = by_size[0]
        found = self.order[begin[first] : end[first], focus[first]]
        for j in by_size[1:]:
            values = self.unit[found, focus[j]]
            found = found[(values >= low[j]) & (values <= high[j])]
        return found


def best(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, equal ones by id and row."""
    if len(scores) > 8 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((rows[at], ids[at], -scores[at]))[:k]]


def width_of(*frames: pd.DataFrame) -> int:
    return max((len(v) // 8 for f in frames for v in f["vector"]), default=0)


def shares(rows: DataFrame, by: list[str], size: int, name: str) -> DataFrame:
    """(by, name): into how many blocks of `size` rows each group is dealt."""
    return rows.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(name))


def dealt(n: str) -> F.Column:
    """The block of a row among n of its group, by its row id."""
    return F.pmod(F.xxhash64(ROW), F.col(n)).cast("int")


def ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first k rows found of each group, with their rank."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "other", "other_row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def met(anchors: DataFrame, rows: DataFrame, key: list[str], search, schema: str) -> DataFrame:
    """search(anchors, rows) of each key that has both."""

    def both(group: pd.DataFrame) -> pd.DataFrame:
        asks = group["asks"].to_numpy()
        return search(group[asks], group[~asks])

    names = list(dict.fromkeys([*key, ROW, "id", "label", "vector", "norm", "bound", *(c for c in anchors.columns if c == "wanted")]))
    one = anchors.select(*names, F.lit(True).alias("asks"))
    other = rows.select(*(F.col(c) if c in rows.columns else F.lit(None).alias(c) for c in names), F.lit(False).alias("asks"))
    return one.unionByName(other).groupBy(*key).applyInPandas(both, schema)


def searched(rows: DataFrame, anchors: DataFrame, by_label: bool, search, schema: str) -> DataFrame:
    """What `search` finds for each block of rows and each block of anchors that may reach the rows' bucket, of one label or of all.

    Anchors carry `bound`; a bucket is met where a parallel vector of its length could reach it, all of them where it is not positive.
    """
    if by_label:
        blocks, sides = shares(rows, ["label", "bucket"], BLOCK, "blocks"), shares(anchors, ["label"], ANCHORS, "sides")
        held, asked, key = rows.join(blocks, ["label", "bucket"]).join(sides, "label"), anchors.join(sides, "label"), ["label", "bucket"]
        placed = asked.join(blocks, "label")
    else:  # the driver reads one row for each bucket: STEPS to a doubling of a double's range at most
        blocks = {r["bucket"]: r["blocks"] for r in shares(rows, ["bucket"], BLOCK, "blocks").collect()} or {SHORTEST: 1}
        sides = F.lit(max(1, -(-anchors.count() // ANCHORS)))
        many = F.create_map(*(F.lit(x) for pair in blocks.items() for x in pair))
        held, asked, key = rows.withColumn("blocks", F.element_at(many, F.col("bucket"))).withColumn("sides", sides), anchors.withColumn("sides", sides), ["bucket"]
        placed = asked.select("*", F.explode(many).alias("bucket", "blocks"))
    meets = (F.col("bound") <= 0) | (F.pow(F.lit(2.0), (F.col("bucket") + 1) / STEPS) * F.col("norm") * (1 + SLACK) >= F.col("bound"))
    key += ["block", "side"]
    held = held.withColumn("block", dealt("blocks")).withColumn("side", F.explode(F.sequence(F.lit(0), F.col("sides") - 1)))
    sent = placed.filter(meets).withColumn("side", dealt("sides")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return met(sent, held, key, search, schema)


def positive_search(k: int):
    """The k best other rows of each anchor of a block; rows and anchors are of one label."""

    def search(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        width, out = width_of(anchors, rows), []
        block = Lists(rows if len(anchors) else rows[:0], width)
        for row, norm, bound, anchor in zip(anchors[ROW], anchors["norm"], anchors["bound"], matrix(anchors["vector"], width), strict=True):
            found = block.candidates(anchor, norm, bound)
            found = found[block.rows[found] != row]
            scores = exact_scores(block.vectors[found], block.norms[found], anchor, norm)
            out += [(row, block.ids[found[i]], block.rows[found[i]], scores[i]) for i in best(scores, block.ids[found], block.rows[found], k)]
        return pd.DataFrame(out, columns=["row", "other", "other_row", "score"])

    return search


def negative_search(k: int, least: int, most: int):
    """For each anchor of a block and each of its positives the k best rows of other labels within the positive's range of scores."""

    def search(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        width, out = width_of(anchors, rows), []
        block = Lists(rows if len(anchors) else rows[:0], width)
        labels = block.labels
        for row, label, norm, bound, wanted, anchor in zip(anchors[ROW], anchors["label"], anchors["norm"], anchors["bound"], anchors["wanted"], matrix(anchors["vector"], width), strict=True):
            found = block.candidates(anchor, norm, bound)
            found = found[labels[found] != label]
            scores = exact_scores(block.vectors[found], block.norms[found], anchor, norm)
            inside = np.flatnonzero((scores >= bound) & (scores <= max(wanted)))
            found, scores = found[inside], scores[inside]
            for score in dict.fromkeys(wanted):
                low, high = -(-int(score) * least // 100), int(score) * most // 100
                fits = np.flatnonzero((scores >= low) & (scores <= high))
                out += [(row, score, block.ids[found[i]], block.rows[found[i]], scores[i]) for i in fits[best(scores[fits], block.ids[found[fits]], block.rows[found[fits]], k)]]
        return pd.DataFrame(out, columns=["row", "wanted", "other", "other_row", "score"])

    return search


FOUND = "row long, other long, other_row long, score long"


def pilot_bounds(rows: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    """Anchors with `bound`: their k-th best score among the PILOT longest rows of their label, NULL-safe 0 where that has fewer."""
    order = Window.partitionBy("label").orderBy(F.desc("norm"), ROW)
    pilot = rows.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= PILOT).drop("n")
    sides = shares(anchors, ["label"], ANCHORS, "sides")
    held = pilot.join(sides, "label").withColumn("side", F.explode(F.sequence(F.lit(0), F.col("sides") - 1)))
    asked = anchors.join(sides, "label").withColumn("side", dealt("sides")).withColumn("bound", F.lit(0.0))
    key = ["label", "side"]
    found = met(asked, held, key, positive_search(k), FOUND)
    bounds = ranked(found, ["row"], k).filter(F.col("rank") == k).select(F.col("row").alias(ROW), F.col("score").cast("double").alias("bound"))
    return anchors.join(bounds, ROW, "left").withColumn("bound", F.coalesce("bound", F.lit(0.0)))


def mine_negatives(
    rows: DataFrame, is_anchor: F.Column, positives: int = 5, negatives: int = 5, least: int = 80, most: int = 100, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """For each anchor and each of its best `positives` rows of its label, the best `negatives` rows of other labels.

    `is_anchor` is a condition on the column `id`. A negative's score is `least` to `most` percent (100 at most) of the positive's.
    Columns: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    known = checkpointed(vectors(rows, id_col, vector_col, label_col))
    anchors = known.filter(F.coalesce(is_anchor, F.lit(False))).drop("bucket")
    anchors = anchors.toDF(*anchors.columns)  # columns of their own beside those of `known`
    bounded = pilot_bounds(known, anchors, positives)
    best_rows = checkpointed(ranked(searched(known, bounded, True, positive_search(positives), FOUND), ["row"], positives))
    chosen = best_rows.filter(F.col("score") >= 0).select(F.col("row").alias(ROW), F.col("other").alias("positive_id"), F.col("score").alias("wanted"), F.col("rank").alias("place"))

    wanted = chosen.groupBy(ROW).agg(F.array_sort(F.collect_list("wanted")).alias("wanted"))  # at most `positives` scores
    asked = anchors.join(wanted, ROW).withColumn("bound", F.element_at("wanted", 1).cast("double") * (least / 100 * (1 - SLACK)))
    found = ranked(searched(known, asked, False, negative_search(negatives, least, most), "row long, wanted long, other long, other_row long, score long"), ["row", "wanted"], negatives)
    pairs = found.withColumnRenamed("row", ROW).join(chosen, [ROW, "wanted"]).join(anchors.select(ROW, F.col("id").alias("anchor_id")), ROW)
    return pairs.select("anchor_id", "positive_id", "rank", F.col("other").alias("negative_id"), F.col("wanted").alias("positive_score"), F.col("score").alias("negative_score"))
