"""Best-fit packing under conflicts: a bin never holds two documents of one source or of one duplicate cluster."""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import ROW

#: Bytes of a bin, and what one shard, packed by one task, holds about: bytes and documents.
CAPACITY = 8192
SHARD_BYTES, SHARD_ROWS = 1 << 24, 1 << 13
PACKED = f"`{ROW}` long, doc_id long, chunk long, start long, length long, shard long, bin long, place long"


class Bins:
    """Open bins in the order of their residual; each carries a bitmap of its sources and one of its duplicate clusters."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.order: list[tuple[int, int]] = []
        self.sources: list[int] = []
        self.clusters: list[int] = []

    def put(self, length: int, source: int, cluster: int) -> tuple[int, int]:
        """(bin, offset) of the tightest bin that has room and no conflict: from the least residual that fits, successor by successor."""
        for at in range(bisect_left(self.order, (length, -1)), len(self.order)):
            residual, b = self.order[at]
            if not self.sources[b] & source and not self.clusters[b] & cluster:
                del self.order[at]
                break
        else:
            residual, b = self.capacity, len(self.sources)
            self.sources.append(0)
            self.clusters.append(0)
        self.sources[b] |= source
        self.clusters[b] |= cluster
        if residual > length:
            insort(self.order, (residual - length, b))
        return b, self.capacity - residual


def pack_shard(part: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Places of the chunks of one shard, longest first."""
    part = part.sort_values(["length", "doc_id", ROW, "chunk"], ascending=[False, True, True, True], ignore_index=True)
    bit = lambda c: [0 if x < 0 else 1 << x for x in pd.factorize(part[c])[0].tolist()]
    bins = Bins(capacity)
    put = [bins.put(*x) for x in zip(part["length"].tolist(), bit("source"), bit("cluster"), strict=True)]
    part["bin"], part["place"] = ([p[i] for p in put] for i in (0, 1))
    return part


def pack(docs: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cluster_col: str | None = None) -> DataFrame:
    """One row per chunk: row id, doc_id, chunk, start and length in bytes, shard, bin (within the shard), place (offset in the bin).

    A document of more than `capacity` UTF-8 bytes is cut into chunks of that size and a rest. Empty and NULL texts take a place
    of length 0. A NULL source or cluster conflicts with nothing; without `cluster_col` equal texts are a cluster. Repeated rows
    are packed each. Shards are dealt by a hash of the row, so no source or cluster makes one large, and their number follows
    bytes and rows; of a group of copies of any size every member gets a bin. An empty table gives no rows.
    """
    cluster = F.xxhash64(F.coalesce(text_col, F.lit(""))) if cluster_col is None else F.col(cluster_col)
    rows = docs.select(
        F.monotonically_increasing_id().alias(ROW), F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), cluster.alias("cluster"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("size"),
    )
    count, size = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()
    shards = max(1, -(-size // SHARD_BYTES), -(-count // SHARD_ROWS))
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0), F.ceil(F.col("size") / capacity) - 1)))
    chunks = rows.withColumn("chunk", chunk).withColumn("start", F.col("chunk") * capacity)
    chunks = chunks.withColumn("length", F.least(F.lit(capacity), F.col("size") - F.col("start"))).drop("size")
    dealt = chunks.withColumn("shard", F.pmod(F.xxhash64(ROW, "chunk"), F.lit(shards).cast("long")))
    columns = [c.split()[0].strip("`") for c in PACKED.split(", ")]
    return dealt.groupBy("shard").applyInPandas(lambda part: pack_shard(part, capacity)[columns], PACKED)
