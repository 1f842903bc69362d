"""Exact dedup by counting quotient filters that merge without loss, and byte verification of what counts above one."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import ROW, keyed, written

#: Quotients of one slice: a slice holds the runs of this many neighbouring quotients.
SLICE = 8
FILTER = "slice int, runs binary, remainders binary, counts binary"


def _slices(prints: np.ndarray, counts: np.ndarray, bits: int) -> Iterator[dict]:
    """Slices of a counting quotient filter: per quotient the length of its run, then the sorted remainders and their counters.

    The quotient is the first `bits` bits of a fingerprint and is kept by position only; prints are sorted.
    """
    quotient = (prints >> np.uint64(64 - bits)).astype(np.int64)
    remainder = prints & np.uint64((1 << (64 - bits)) - 1)
    number = quotient >> SLICE
    edges = np.flatnonzero(np.diff(number, prepend=-1)) if len(number) else np.zeros(0, np.int64)
    for lo, hi in zip(edges, [*edges[1:], len(number)], strict=True):
        runs = np.bincount(quotient[lo:hi] & ((1 << SLICE) - 1), minlength=1 << SLICE).astype(np.int32)
        yield {"slice": int(number[lo]), "runs": runs.tobytes(), "remainders": remainder[lo:hi].tobytes(), "counts": counts[lo:hi].tobytes()}


def _counted(prints: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal fingerprints as one, counters added, sorted."""
    found, where = np.unique(prints, return_inverse=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, where, counts)
    return found, total


def quotient_filters(prints: DataFrame, bits: int) -> DataFrame:
    """One counting quotient filter for each partition of the one-column frame, in slices of 2^SLICE quotients."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [_counted((x := b.column(0).to_numpy().view(np.uint64)), np.ones(len(x), np.int64)) for b in batches]
        if held:
            whole = _counted(np.concatenate([x for x, _ in held]), np.concatenate([n for _, n in held]))
            if rows := list(_slices(*whole, bits)):
                yield pa.RecordBatch.from_pylist(rows, pa.schema([("slice", pa.int32()), ("runs", pa.binary()), ("remainders", pa.binary()), ("counts", pa.binary())]))

    return prints.mapInArrow(build, FILTER)


def repeated_fingerprints(filters: DataFrame, bits: int) -> DataFrame:
    """(fp, copies) of the fingerprints that count above one, once the slices of all partitions are merged by sorted remainders."""

    def merge(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        prints, counts = [], []
        for runs, remainders, n in zip(part["runs"], part["remainders"], part["counts"], strict=True):
            quotients = (np.uint64(key[0]) << np.uint64(SLICE)) + np.repeat(np.arange(1 << SLICE, dtype=np.uint64), np.frombuffer(runs, np.int32))
            prints.append((quotients << np.uint64(64 - bits)) | np.frombuffer(remainders, np.uint64))
            counts.append(np.frombuffer(n, np.int64))
        found, total = _counted(np.concatenate(prints), np.concatenate(counts))
        return pd.DataFrame({"fp": found[total > 1].view(np.int64), "copies": total[total > 1]})

    return filters.groupBy("slice").applyInPandas(merge, "fp long, copies long")


def filter_bits(rows: int) -> int:
    """Bits of the quotient: slices of about 2^18 rows each, 256 slices at least."""
    return SLICE + max(8, (max(rows, 1) >> 18).bit_length())


def copy_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: row id, doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are. Of equal texts the row with the largest doc_id stays; a NULL doc_id is the smallest,
    and of rows that repeat doc_id and text exactly one stays. NULL text is empty. An empty table gives no rows.
    Each partition's filter holds one counter per distinct fingerprint, so a group of copies of any size is one entry of it, and
    its texts meet in a grouping that combines before the shuffle. The repeated fingerprints are written, so their size is
    known: while Spark may broadcast them, the filter goes below the grouping and no other text moves; beyond that size it
    meets grouped rows, in which a group of copies is one.
    """
    base = keyed(docs, id_col, text_col).withColumn("fp", F.xxhash64("text")).withColumn("text_sha256", F.sha2("text", 256))
    bits = filter_bits(docs.count())
    repeated = written(repeated_fingerprints(quotient_filters(base.select("fp"), bits), bits))
    order = F.coalesce("doc_id", F.lit(-(1 << 63)))
    classes = (
        base.groupBy("fp", "text")
        .agg(F.max("doc_id").alias("keep_id"), F.max_by(ROW, order).alias("keep_row"), F.count(F.lit(1)).alias("group_size"))
        .join(repeated, "fp", "left_semi")
        .select(F.sha2("text", 256).alias("text_sha256"), "keep_id", "keep_row", "group_size")
    )
    return base.drop("text", "fp").join(classes, "text_sha256", "left").select(
        ROW,
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("keep_row") == F.col(ROW), F.lit(True)).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns."""
    dropped = copy_groups(docs, id_col, text_col).filter(~F.col("kept")).select(ROW)
    return docs.withColumn(ROW, F.monotonically_increasing_id()).join(dropped, ROW, "left_anti").drop(ROW)
