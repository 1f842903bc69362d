"""Exact Jaccard join of word-shingle sets in the metric space of Jaccard distances.

Pivots are documents: of all that share a shingle among their prefixes the one with the least key. A document belongs to the
regions of the pivots that its shared prefix shingles vote for, its home being that with most votes; the regions with few votes
are left out as far as no link can hang on them, so only boundary documents are in several. Inside a region distances to the
pivot bound those between documents (triangle inequality), and what no window rules out is joined recursively with new pivots.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfline.llm.common import ROW, checkpointed, grams, keyed, mixed, pieces, sequence_hash, utf8, words
from shelfline.llm.components import components

#: Words of a shingle; a link needs PERCENT of the union in common.
SHINGLE, PERCENT = 5, 80
#: Members of a region that one task joins; larger regions are dealt out in blocks of this size.
REGION = 2000
#: Distances up to which documents link, as a share.
NEAR = 1 - PERCENT / 100

INSIDE = np.ones(256, bool)
INSIDE[[32, *range(9, 14)]] = False


def shingle_sets(raw: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text of fewer words has its whole sequence as one, an empty text none."""
    for _, _, part, edges in pieces(raw, offsets):
        _, _, hashed, firsts = words(part, edges, INSIDE)
        found, at = grams(hashed, firsts, SHINGLE)
        bounds = np.searchsorted(at, firsts)
        for r in range(len(edges) - 1):
            lo, hi = bounds[r], bounds[r + 1]
            if hi > lo:
                yield np.unique(found[lo:hi])
            elif firsts[r + 1] > firsts[r]:
                yield np.array([sequence_hash(hashed[firsts[r] : firsts[r + 1]])], np.uint64)
            else:
                yield np.zeros(0, np.uint64)


def set_key(shingles: np.ndarray) -> int:
    """64-bit key of a set; equal sets have equal keys."""
    return int(mixed(mixed(shingles).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(shingles))).view(np.int64)[0])


def least_overlap(n: int) -> int:
    """Shingles that a set of n shares at least with any set it links to."""
    return -(-n * PERCENT // 100)


def prefix_length(n: int) -> int:
    """Least hashes of a set that are compared: any two linked sets share n // 10 of them, and one at least."""
    return n - least_overlap(n) + max(1, n // 8)


def set_table(docs: DataFrame) -> DataFrame:
    """(row id, doc_id, n_shingles, key) of every row of keyed(); the key of an empty set is NULL."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(*utf8(batch.column("text"))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(ROW), batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_key(s) if len(s) else None for s in sets], pa.int64())],
                [ROW, "doc_id", "n_shingles", "key"],
            )

    return docs.mapInArrow(scan, f"`{ROW}` long, doc_id long, n_shingles long, key long")


def prefixes(docs: DataFrame) -> DataFrame:
    """(shingle, key): the prefix of each distinct set of a partition."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            shingles, keys, lengths = [], [], []
            for s in shingle_sets(*utf8(batch.column("text"))):
                if len(s) and (key := set_key(s)) not in seen:
                    seen.add(key)
                    shingles.append(s[: prefix_length(len(s))])
                    keys.append(key)
                    lengths.append(len(shingles[-1]))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(shingles).view(np.int64)), pa.array(np.repeat(np.array(keys, np.int64), lengths))], ["shingle", "key"])

    return docs.select("text").mapInArrow(scan, "shingle long, key long")


def pivot_votes(rows: DataFrame) -> DataFrame:
    """(key, pivot, votes): how many of a set's prefix shingles are shared and have that pivot, the least key that holds them.

    The rows stream by in the order of shingle and key, so a shingle of any number of sets costs no memory.
    """

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = pivot = key = None
        paired = False  # whether the pivot of the running shingle has its own vote
        for batch in batches:
            s, k = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(s):
                continue
            if shingle is not None:
                s, k = np.append(np.int64(shingle), s), np.append(np.int64(key), k)
            new = np.ones(len(s), bool)
            new[1:] = (s[1:] != s[:-1]) | (k[1:] != k[:-1])
            known = shingle is not None
            s, k = s[new], k[new]
            begins = np.ones(len(s), bool)
            begins[1:] = s[1:] != s[:-1]
            start = np.flatnonzero(begins)
            run = np.cumsum(begins) - 1
            pivots = k[start]
            if known:
                pivots = pivots.copy()
                pivots[0] = pivot
            member = ~begins
            second = member & np.append(False, begins[:-1])
            if known and paired and len(second) > 1 and second[1]:
                second[1] = False
            own, of = k[member], pivots[run[member]]
            extra = pivots[run[second]]
            if len(own):
                yield pa.RecordBatch.from_arrays([pa.array(np.append(own, extra)), pa.array(np.append(of, extra))], ["key", "pivot"])
            last = len(s) - 1
            stays = known and run[last] == 0
            paired = (paired if stays else False) or bool(member[last])
            shingle, key, pivot = int(s[last]), int(k[last]), int(pivots[run[last]])

    ordered = rows.repartition(F.col("shingle")).sortWithinPartitions("shingle", "key")
    return ordered.mapInArrow(vote, "key long, pivot long").groupBy("key", "pivot").agg(F.count(F.lit(1)).alias("votes"))


def regions(votes: DataFrame, sizes: DataFrame) -> DataFrame:
    """(pivot, key, members) of the regions with two members or more.

    Linked sets share `least` prefix shingles, each with one pivot for both. A set with fewer shared ones links to nothing. It
    leaves its least regions as long as these have fewer than half of `least` votes together: whatever its partner leaves, one
    shared region stays.
    """
    by_key = W.partitionBy("key")
    least = F.greatest(F.lit(1), F.floor(F.col("n_shingles") / 10))
    rows = votes.join(sizes, "key").withColumn("least", least).withColumn("shared", F.sum("votes").over(by_key)).filter("shared >= least")
    rows = rows.withColumn("below", F.sum("votes").over(by_key.orderBy("votes", "pivot").rowsBetween(W.unboundedPreceding, 0)))
    rows = rows.filter(F.col("below") > F.floor((F.col("least") - 1) / 2)).select("pivot", "key")
    return rows.join(rows.groupBy("pivot").agg(F.count(F.lit(1)).alias("members")).filter("members > 1"), "pivot")


class Sets:
    """Sets of one task as rows of (column, set) entries, without the shingles that only one of them holds."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sizes = np.array([len(s) for s in sets], np.int64)
        _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = count[column] > 1
        self.column = column[shared]
        self.count = count
        owner = np.repeat(np.arange(len(sets)), self.sizes)[shared]
        self.first = np.searchsorted(owner, np.arange(len(sets) + 1))

    def entries(self, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in `of`, column) of all entries of these sets."""
        n = self.first[of + 1] - self.first[of]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[of], n)
        return np.repeat(np.arange(len(of)), n), self.column[at]

    def linked(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances and links of each set of `left` with each of `right`; links are judged in whole numbers.

        Columns that many sets hold are multiplied as dense matrices, the others by their entries.
        """
        both = np.zeros((len(left), len(right)), np.float32)
        i, a = self.entries(left)
        j, b = self.entries(right)
        dense = np.flatnonzero(self.count >= max(32, len(right) // 8))
        for part in np.array_split(dense, -(-len(dense) // 1024)) if len(dense) else ():
            place = np.full(len(self.count), -1, np.int64)
            place[part] = np.arange(len(part))
            sides = []
            for rows, columns, n in ((i, a, len(left)), (j, b, len(right))):
                has = place[columns] >= 0
                sides.append(np.zeros((n, len(part)), np.float32))
                sides[-1][rows[has], place[columns[has]]] = 1
            both += sides[0] @ sides[1].T
        rare = self.count < max(32, len(right) // 8)
        i, a = i[rare[a]], a[rare[a]]
        j, b = j[rare[b]], b[rare[b]]
        order = np.argsort(b, kind="stable")
        j, b = j[order], b[order]
        lo, hi = np.searchsorted(b, a, "left"), np.searchsorted(b, a, "right")
        n = hi - lo
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        both += np.bincount(np.repeat(i, n) * len(right) + j[at], minlength=both.size).reshape(both.shape)
        whole = both.astype(np.int64)
        union = self.sizes[left][:, None] + self.sizes[right][None, :] - whole
        return 1 - whole / union, 100 * whole >= PERCENT * union


def joined(sets: list[np.ndarray], queries: np.ndarray | None = None) -> np.ndarray:
    """For each set the least index of its component, by links of at least PERCENT of the union.

    A pivot's ball (distance up to NEAR) is one component without further comparison. Outside it a set can link into the ball
    only within twice NEAR of the pivot, and only to members whose distance differs by NEAR at most; the sets outside are joined
    in the same way with a pivot of their own, until few are left or pivots gather few. With `queries` only links of these count.
    """
    of = Sets(sets)
    root = np.arange(len(sets))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return int(i)

    def link(i: int, j: int) -> None:
        a, b = top(i), top(j)
        if a != b:
            root[max(a, b)] = min(a, b)

    def compare(left: np.ndarray, right: np.ndarray) -> None:
        for rows in np.array_split(left, -(-len(left) // 256)) if len(left) and len(right) else ():
            for x, y in zip(*np.nonzero(of.linked(rows, right)[1]), strict=True):
                link(int(rows[x]), int(right[y]))

    rest = np.arange(len(sets))
    if queries is not None:
        compare(np.flatnonzero(queries), rest)
        rest = rest[:0]
    while len(rest) > 1:
        if len(rest) <= 32:
            compare(rest, rest)
            break
        pivot = rest[:1]
        distance, linked = of.linked(pivot, rest[1:])
        rest, distance, linked = rest[1:], distance[0], linked[0]
        ball, outside, far = rest[linked], rest[~linked], distance[~linked]
        for i in ball:
            link(int(pivot[0]), int(i))
        close = far <= 2 * NEAR + 1e-9
        if len(ball) and close.any():
            compare(outside[close], ball[distance[linked] >= far[close].min() - NEAR - 1e-9])
        if len(ball) * 16 < len(rest):
            compare(outside, outside)
            break
        rest = outside
    return np.array([top(i) for i in range(len(sets))])


def _edges(part: pd.DataFrame) -> pd.DataFrame:
    part = part.sort_values("key", ignore_index=True)
    keys = part["key"].to_numpy()
    queries = part["query"].to_numpy() if "query" in part else None
    root = joined([np.frombuffer(s, np.uint64) for s in part["shingles"]], queries)
    moved = root != np.arange(len(root))
    return pd.DataFrame({"a": keys[moved], "b": keys[root[moved]]})


def region_links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Edges (a, b) that connect exactly what links inside the regions (pivot, key, members); sets holds (key, shingles).

    A region of up to REGION members is joined in one task. In a larger one every member is measured against the centre where it
    lies; the ball around the centre needs no more. The centre is the least member: the pivot, unless that has left its own region.
    What is outside is dealt into blocks, and each block meets the whole region in blocks, so no task holds more than two blocks
    and no pair is written out.
    """
    small = members.filter(F.col("members") <= REGION).select("pivot", "key").join(sets, "key")
    links = small.groupBy("pivot").applyInPandas(lambda key, part: _edges(part), "a long, b long")
    large = members.filter(F.col("members") > REGION)
    centre = large.groupBy("pivot").agg(F.min("key").alias("middle")).join(sets.select(F.col("key").alias("middle"), F.col("shingles").alias("centre")), "middle")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for s, c in zip(batch.column("shingles"), batch.column("centre"), strict=True):
                a, b = np.frombuffer(s.as_py(), np.uint64), np.frombuffer(c.as_py(), np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                near.append(100 * both >= PERCENT * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("pivot", "middle", "key")), pa.array(near, pa.bool_())], ["pivot", "middle", "key", "near"])

    # The few distinct centres come first, so that the many members of one are split by the adaptive join.
    measured = large.join(centre, "pivot").join(sets, "key")
    measured = checkpointed(measured.select("pivot", "middle", "key", "shingles", "centre").mapInArrow(measure, "pivot long, middle long, key long, near boolean"))
    ball = measured.filter("near AND key != middle").select(F.col("key").alias("a"), F.col("middle").alias("b"))
    counted = measured.groupBy("pivot").agg(F.count_if(~F.col("near")).alias("outside"), F.count(F.lit(1)).alias("members")).filter("outside > 0")
    blocks = counted.select("pivot", F.ceil(F.col("outside") / REGION).alias("rows"), F.ceil(F.col("members") / REGION).alias("columns"))
    dealt = measured.join(blocks, "pivot").withColumn("hash", F.xxhash64("key"))
    queries = dealt.filter("NOT near").select("pivot", "key", F.expr("pmod(hash, rows)").alias("r"), F.explode(F.expr("sequence(0L, columns - 1)")).alias("c"), F.lit(1).alias("asks"))
    others = dealt.select("pivot", "key", F.explode(F.expr("sequence(0L, rows - 1)")).alias("r"), F.expr("pmod(hash, columns)").alias("c"), F.lit(0).alias("asks"))
    met = queries.union(others).groupBy("pivot", "r", "c", "key").agg((F.max("asks") > 0).alias("query"))
    met = met.join(sets, "key").groupBy("pivot", "r", "c")
    return links.union(ball).union(met.applyInPandas(lambda key, part: _edges(part), "a long, b long"))


def linked_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: row id, doc_id, n_shingles, component_id (the smallest doc_id that links reach), root.

    The root is a key of the component that no other has, also where doc_ids repeat or are NULL; empty texts have none.

    Words are runs of bytes other than ASCII white space, A-Z lower-cased. NULL text is empty; empty sets link to nothing, equal
    sets always do. A row without doc_id links like any other but never names a component, unless alone: then it is NULL. An
    empty table gives no rows. Starts Spark jobs; what is cut goes to the shared checkpoint folder.
    """
    base = keyed(docs, id_col, text_col)
    table = checkpointed(set_table(base))
    known = table.filter("key IS NOT NULL")
    by_key = known.groupBy("key").agg(F.first("n_shingles").alias("n_shingles"), F.min("doc_id").alias("least_id"), F.min(ROW).alias(ROW))
    members = checkpointed(regions(pivot_votes(prefixes(base)), by_key.select("key", "n_shingles")))
    wanted = by_key.join(members.select("key").distinct(), "key", "left_semi").select(ROW)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(*utf8(batch.column("text"))))
            yield pa.RecordBatch.from_arrays([pa.array([set_key(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["key", "shingles"])

    sets = checkpointed(base.join(wanted, ROW, "left_semi").select("text").mapInArrow(collect, "key long, shingles binary"))
    roots = components(region_links(members, sets))
    rooted = by_key.join(roots, F.col("node") == F.col("key"), "left").select("key", "least_id", F.coalesce("root", "key").alias("root"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("least_id").alias("component_id")), "root").select("key", "component_id", "root")
    return table.join(named, "key", "left").select(ROW, "doc_id", "n_shingles", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "root")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` without near copies: of each component the row with the smallest doc_id stays, the first where it repeats.

    Rows without doc_id come last. Empty texts link to nothing, so they stay.
    """
    found = linked_components(docs, id_col, text_col)
    first = found.filter("root IS NOT NULL").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", ROW)).alias("first"))
    stays = first.select(f"first.{ROW}").union(found.filter("root IS NULL").select(ROW))
    return docs.withColumn(ROW, F.monotonically_increasing_id()).join(stays, ROW, "left_semi").drop(ROW)
