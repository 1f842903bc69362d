"""Helpers shared by the operators: row ids, UTF-8 buffers of Arrow batches, word and n-gram hashes in numpy."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROW = "__llm_row"
#: Bytes of text that a task turns into numpy arrays at once; one longer document is taken alone.
PIECE = 1 << 20


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row id, doc_id, text): NULL text is empty; every input row has an id of its own, repeated doc_ids too.

    The ids follow the partitions of the scan, so the input should be a stored table: a retried task gives the same ids.
    """
    return docs.select(F.monotonically_increasing_id().alias(ROW), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared folder, so that lost executors cost no recomputation of it."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where the session has none, a folder of its warehouse, which all executors share as well."""
    return spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints"


def written(df: DataFrame) -> DataFrame:
    """The rows from a table in the shared folder: no lineage, and a size that Spark knows when it picks a join."""
    path = f"{shared_folder(df.sparkSession)}/written-{uuid4().hex}.parquet"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's files to the executors, once per application, as --py-files would.

    Functions that run in Python workers are found there by name, and executors need not see the driver's folders.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        target = Path(tempfile.mkdtemp(prefix="shelfline-")) / "shelfline_package.zip"
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
            for file in sorted(package.rglob("*.py")):
                archive.write(file, file.relative_to(package.parent))
        context.addPyFile(str(target))
        _shipped.add(context.applicationId)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offset of each row, with the end; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]] if len(column) else raw[:0], offsets - offsets[0]


def pieces(raw: np.ndarray, offsets: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows that hold about `limit` bytes."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, end, raw[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def each(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, offsets) of every row by itself."""
    for lo, hi in zip(offsets[:-1], offsets[1:], strict=True):
        yield raw[lo:hi], np.array([0, hi - lo])


def table(seed: int, size: int = 256) -> np.ndarray:
    """Fixed random 64-bit odd numbers."""
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 63, size, np.uint64) * np.uint64(2) + np.uint64(1)


BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
BYTE = table(1)
GRAM = table(2, 64)
#: Masks that keep the first 0 to 8 bytes of a little-endian word.
KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64; kept up to the size of a piece."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, PIECE + 1), base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if n <= 4 * PIECE:
            _powers[base] = have
    return have[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every input bit over the whole word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix_hash(codes: np.ndarray) -> np.ndarray:
    """Running sums of code * BASE^position, with a leading zero."""
    out = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * powers(BASE, len(codes)), dtype=np.uint64, out=out[1:])
    return out


def lowered() -> np.ndarray:
    """Byte to byte, A-Z to a-z."""
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    return out


def span_hash(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes, none of them empty.

    Every 8 bytes are mixed with their place before they are added up, so no difference of two spans cancels out by its form, as
    it does in polynomials modulo 2^64. Spans of equal length up to 8 bytes never collide.
    """
    padded = np.zeros(len(raw) + 8, np.uint8)
    padded[: len(raw)] = raw
    eights = np.ndarray(len(raw) + 1, "<u8", padded, strides=(1,))
    length = end - start
    parts = (length + 7) // 8
    first = np.cumsum(parts) - parts
    place = np.arange(int(parts.sum())) - np.repeat(first, parts)
    left = np.repeat(length, parts) - 8 * place
    chunks = eights[np.repeat(start, parts) + 8 * place] & KEEP[np.minimum(left, 8)]
    terms = mixed(chunks ^ mixed(place.astype(np.uint64) + np.uint64(1)))
    sums = np.add.reduceat(terms, first) if len(first) else np.zeros(0, np.uint64)
    return mixed(sums + length.astype(np.uint64) * np.uint64(BASE))


def words(raw: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words are runs of bytes for which `inside` holds, A-Z lower-cased; they end with their row.

    Returns start and end of each word in `raw`, its 64-bit hash, and the index of each row's first word, with the end.
    """
    flags = np.zeros(len(raw) + 2, bool)
    flags[1:-1] = inside[raw]
    begins = flags[1:-1] & ~flags[:-2]
    ends = flags[1:-1] & ~flags[2:]
    edges = offsets[1:-1]
    at = edges[(edges > 0) & (edges < len(raw))]
    begins[at] |= flags[1:-1][at]
    ends[at - 1] |= flags[1:-1][at - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, span_hash(lowered()[raw], start, end), np.searchsorted(start, offsets)


def grams(hashed: np.ndarray, firsts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each n consecutive words of one row, and the index of its first word."""
    count = len(hashed) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.full(count, np.uint64(n), np.uint64)
    for j in range(n):
        total += hashed[j : j + count] * GRAM[j]
    row = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    at = np.flatnonzero(row[:count] == row[n - 1 :])
    return mixed(total[at]), at


def sequence_hash(hashed: np.ndarray) -> int:
    """Hash of a whole word sequence of fewer than 64 words, as grams() gives for its length."""
    total = np.uint64(len(hashed)) + (hashed * GRAM[: len(hashed)]).sum(dtype=np.uint64)
    return int(mixed(np.array([total], np.uint64))[0])
