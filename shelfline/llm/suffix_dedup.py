"""Repeated-substring removal by suffix arrays of candidate passages, built by linear grouping.

A window is LENGTH bytes. Its anchor is the ANCHOR-gram of least hash in it, so equal windows have equal anchors at the same
place, and a window whose anchor occurs once in the corpus is unique. The windows around one anchor position form a fragment; of
fragments with equal bytes all but the first are covered. Where an anchor stands in different fragments, the windows are dealt by
the bytes that STEP neighbouring ones share (their core), and the suffixes of core and surroundings are sorted: groups of equal
Lyndon prefix in descending order by previous-smaller pointers, then each group's order, with no renaming and no recursion.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import BYTE, GRAM, INVERSE, ROW, checkpointed, each, keyed, mixed, pieces, powers, prefix_hash, utf8

#: Bytes of a string that counts as repeated, of an anchor, and windows that share a core.
LENGTH, ANCHOR, STEP = 100, 32, 18
WINDOWS = LENGTH - ANCHOR + 1
CORE = LENGTH - STEP + 1
CLASSES = -(-WINDOWS // STEP)
#: Bytes of a text whose windows are taken at once; the bits of their positions are part of the ordering.
SEGMENT, BITS = 1 << 19, np.uint64(20)
#: Different pieces of one core that one task sorts; those of a core with more are dealt out window by window.
PIECES = 20_000
#: Symbols of pieces that are sorted together.
SYMBOLS = 1 << 15


def lyndon_groups(text: list[int]) -> tuple[list[int], list[int]]:
    """Suffixes grouped by longest Lyndon prefix: each suffix's group, by the rank of its first member, and previous-smaller pointers.

    The last symbol is the only 0. Groups are taken from the highest down. A member's pointer leads to the last suffix before it
    in a lower group; suffixes to which the group points have its prefix behind their own, once per pointer, and move up into
    groups of their own, those with more repetitions higher.
    """
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    group, size, place = [0] * n, [0] * n, [0] * n
    first = 0
    for i, s in enumerate(order):
        if i and text[s] != text[order[i - 1]]:
            first = i
        group[s] = first
        size[first] += 1
        place[s] = i
    before = [-1] * n
    top = n - 1
    while top > 0:
        low = group[order[top]]
        times: dict[int, int] = {}
        for s in sorted(order[low : top + 1]) if top > low else (order[top],):
            p = s - 1
            while p >= 0 and group[p] >= low:
                p = before[p]
            before[s] = p
            if p >= 0:
                times[p] = times.get(p, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for p, t in times.items():
            moved.setdefault((t, group[p]), []).append(p)
        for (_, g), members in sorted(moved.items(), key=lambda x: -x[0][0]):
            end = g + size[g]
            begin = end - len(members)
            size[g] = begin - g
            size[begin] = len(members)
            for p in members:
                end -= 1
                q, at = order[end], place[p]
                order[end], order[at] = p, q
                place[p], place[q] = end, at
                group[p] = begin
        top = low - 1
    return group, before


def suffix_array(text: list[int]) -> list[int]:
    """Starts of the suffixes in order. The last symbol is the only 0."""
    group, before = lyndon_groups(text)
    n = len(text)
    out, done = [n - 1] * n, bytearray(n)
    free = list(range(n))
    done[n - 1] = 1
    for i in range(n):
        s = out[i] - 1
        while s >= 0 and not done[s]:
            g = group[s]
            out[free[g]] = s
            free[g] += 1
            done[s] = 1
            s = before[s]
    return out


def _gram(sums: np.ndarray, at: np.ndarray, size: int | np.ndarray) -> np.ndarray:
    """Hashes of the byte strings at these places."""
    return mixed((sums[at + size] - sums[at]) * powers(INVERSE, len(sums))[at])


def _parts(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, start within it, bytes, offsets): runs of whole texts, longer texts in overlapping segments."""
    for lo, hi, part, edges in pieces(raw, offsets, SEGMENT):
        if len(part) <= SEGMENT:
            yield lo, 0, part, edges
        else:  # one or more texts, of which the last may be long
            for r in range(hi - lo):
                text = part[edges[r] : edges[r + 1]]
                for base in range(0, max(len(text) - LENGTH + 1, 1), SEGMENT):
                    cut = text[base : base + SEGMENT + LENGTH - 1]
                    yield lo + r, base, cut, np.array([0, len(cut)])


def _fragments(part: np.ndarray, edges: np.ndarray) -> dict[str, np.ndarray] | None:
    """Fragments of some texts: row, start, windows, anchor place from the start, anchor and content hashes, and core hashes."""
    if len(part) < LENGTH:
        return None
    sums = prefix_hash(BYTE[part])
    hashes = _gram(sums, np.arange(len(part) - ANCHOR + 1), ANCHOR)
    keys = (hashes >> BITS << BITS) | np.arange(len(hashes), dtype=np.uint64)
    # Least key of each WINDOWS neighbours: ends of blocks before, starts of blocks after.
    blocks = np.append(keys, np.full(-len(keys) % WINDOWS, ~np.uint64(0))).reshape(-1, WINDOWS)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(part) - LENGTH + 1
    anchor = (np.minimum(behind[:count], ahead[WINDOWS - 1 : WINDOWS - 1 + count]) & np.uint64((1 << int(BITS)) - 1)).astype(np.int64)
    row = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    start = np.flatnonzero(row[:count] == row[LENGTH - 1 :])
    if not len(start):
        return None
    at = anchor[start]
    first = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)))
    last = np.append(first[1:], len(start)) - 1
    begin, end, at = start[first], start[last], at[first]
    cores = np.zeros(len(at), np.uint64)
    for c in range(CLASSES):
        core = at - STEP * c
        has = (begin <= core) & (end > core - STEP)
        cores[has] |= (_gram(sums, core[has], CORE) >> np.uint64(48)) << np.uint64(16 * c)
    r = row[begin]
    return {"row": r, "start": begin - edges[r], "windows": end - begin + 1, "lead": at - begin, "anchor": hashes[at], "content": _gram(sums, begin, end - begin + LENGTH), "cores": cores}


FRAGMENTS = f"anchor long, content long, doc_id long, `{ROW}` long, start long, windows short, lead short, cores long"


def _batch_fragments(batch: pa.RecordBatch) -> pa.RecordBatch | None:
    """The fragments of one batch. Of equal ones all but the first are known to be covered: they get keys of their own, so a
    passage of any number of places sends one fragment per batch to the task of its anchor. Their windows are counted negative."""
    ids, docs = batch.column(ROW).to_numpy(), batch.column("doc_id")
    found = []
    for lo, origin, part, edges in _parts(*utf8(batch.column("text"))):
        if (f := _fragments(part, edges)) is not None:
            f["row"], f["start"] = lo + f["row"], f["start"] + origin
            found.append(f)
    if not found:
        return None
    f = {c: np.concatenate([x[c] for x in found]) for c in found[0]}
    rank = docs.fill_null(-(1 << 63)).to_numpy()
    place = np.arange(len(f["row"]))
    if (rank[1:] < rank[:-1]).any():
        place = np.lexsort((f["start"], ids[f["row"]], rank[f["row"]]))
    key = mixed(f["anchor"] + f["content"] * GRAM[0])
    order = place[np.argsort(key[place], kind="stable")]
    known = np.zeros(len(order), bool)
    known[order[1:]] = key[order[1:]] == key[order[:-1]]
    own = (ids[f["row"]].astype(np.uint64) << np.uint64(24)) + f["start"].astype(np.uint64)
    f["anchor"], f["content"] = np.where(known, own, f["anchor"]), np.where(known, np.uint64(0), f["content"])
    f["cores"] = np.where(known, np.uint64(0), f["cores"])
    columns = [f["anchor"].view(np.int64), f["content"].view(np.int64), docs.take(pa.array(f["row"])), ids[f["row"]], f["start"], np.where(known, -f["windows"], f["windows"]).astype(np.int16), f["lead"].astype(np.int16), f["cores"].view(np.int64)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "content", "doc_id", ROW, "start", "windows", "lead", "cores"])


def fragments(base: DataFrame) -> DataFrame:
    """All fragments of the texts of keyed()."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if (out := _batch_fragments(batch)) is not None:
                yield out

    return base.mapInArrow(scan, FRAGMENTS)


MET = f"`{ROW}` long, start long, windows short, lead short, anchor long, cores long, covered boolean"


def met_fragments(rows: DataFrame) -> DataFrame:
    """Fragments that are covered by an equal one before, and the first of each kind where an anchor has several kinds.

    The rows stream by in the order of anchor, content and place, so an anchor of any number of fragments costs no memory: the
    first kind of an anchor is held back until a second one comes.
    """
    names = [ROW, "start", "windows", "lead", "anchor", "cores"]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None  # the last row before this batch
        kinds = 0  # kinds of its anchor so far, up to 2
        waiting: pa.RecordBatch | None = None  # the first row of its anchor while it is the only kind
        for batch in batches:
            if not batch.num_rows:
                continue
            anchor, content = batch.column("anchor").to_numpy(), batch.column("content").to_numpy()
            before = (held.column("anchor")[0].as_py(), held.column("content")[0].as_py()) if held is not None else (None, None)
            new_anchor = np.append(anchor[0] != before[0] if held is not None else True, anchor[1:] != anchor[:-1])
            new_kind = new_anchor | np.append(content[0] != before[1] if held is not None else True, content[1:] != content[:-1])
            run = np.cumsum(new_anchor)
            carried = 0 if new_anchor[0] else kinds
            per_run = np.bincount(run, weights=new_kind, minlength=run[-1] + 1)
            per_run[0] += carried
            several = per_run[run] > 1
            if not new_anchor[0] and waiting is not None and per_run[0] > 1:
                yield pa.RecordBatch.from_arrays([*(waiting.column(c) for c in names), pa.array([False])], [*names, "covered"])
                waiting = None
            covered = ~new_kind | (batch.column("windows").to_numpy() < 0)
            pick = np.flatnonzero(covered | several)
            if len(pick):
                some = batch.take(pa.array(pick))
                yield pa.RecordBatch.from_arrays([*(some.column(c) for c in names), pa.array(covered[pick])], [*names, "covered"])
            kinds = int(min(per_run[run[-1]], 2))
            starts = np.flatnonzero(new_anchor)
            if kinds > 1:
                waiting = None
            elif len(starts):
                waiting = batch.slice(int(starts[-1]), 1)
            held = batch.slice(batch.num_rows - 1, 1)

    ordered = rows.repartition(F.col("anchor")).sortWithinPartitions("anchor", "content", "doc_id", ROW, "start")
    return ordered.mapInArrow(stream, MET)


def shared_cores(met: DataFrame) -> DataFrame:
    """(row id, core): places of the cores of first fragments whose anchor, class and core hash another first fragment has too, with the
    part of the text around them that belongs to windows of the fragment (first, end)."""
    at = F.col("start") + F.col("lead")
    classes = F.explode(F.array(*(F.struct(F.lit(c).alias("class"), (at - STEP * c).alias("core"), F.shiftright("cores", 16 * c).bitwiseAND(0xFFFF).alias("hash")) for c in range(CLASSES))))
    last = F.col("start") + F.col("windows") - 1
    rows = met.filter("NOT covered").select(ROW, "start", last.alias("last"), "anchor", classes.alias("c")).select(ROW, "start", "last", "anchor", "c.*")
    rows = rows.filter((F.col("start") <= F.col("core")) & (F.col("last") > F.col("core") - STEP))
    rows = rows.select(ROW, "core", F.greatest("start", F.col("core") - STEP + 1).alias("first"), (F.least("last", "core") + LENGTH).alias("end"), F.xxhash64("anchor", "class", "hash").alias("key"))
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    return rows.join(shared, "key", "left_semi").drop("key")


PIECE = f"core long, left binary, right binary, doc_id long, `{ROW}` long, at long"


def core_pieces(base: DataFrame, places: DataFrame) -> DataFrame:
    """(core hash, bytes before and after the core, doc_id, row id, place of the core) of each place, read from its text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            texts = each(*utf8(batch.column("text")))
            for row, doc, wanted, (part, _) in zip(batch.column(ROW).to_pylist(), batch.column("doc_id").to_pylist(), batch.column("places").to_pylist(), texts, strict=True):
                text = part.tobytes()
                for p in wanted:
                    at, end = p["core"], p["core"] + CORE
                    core = int.from_bytes(hashlib.blake2b(text[at:end], digest_size=8).digest(), "little", signed=True)
                    out.append((core, text[p["first"] : at], text[end : p["end"]], doc, row, at))
            kinds = [("core", pa.int64()), ("left", pa.binary()), ("right", pa.binary()), ("doc_id", pa.int64()), (ROW, pa.int64()), ("at", pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*out, strict=True) if out else [[]] * 6, kinds, strict=True)], schema=pa.schema(kinds))

    per_row = places.groupBy(ROW).agg(F.collect_list(F.struct("core", "first", "end")).alias("places"))
    return base.join(per_row, ROW).mapInArrow(cut, PIECE)


def repeated_windows(found: list[tuple[int, bytes, bytes, int]]) -> list[int]:
    """For pieces (number of the core, bytes before, bytes after, order) codes piece * STEP + offset of the windows that an earlier piece has.

    All pieces are one text, a core being one symbol: two windows of a core are equal if their STEP symbols are.
    """
    text, owner, offset = [], [], []
    for i, (core, left, right, _) in enumerate(found):
        size = len(left) + 1 + len(right)
        text += [b + 2 for b in left]
        text.append(258 + core)
        text += [b + 2 for b in right]
        text.append(1)
        owner += [i] * (size + 1)
        offset += [*range(size - STEP + 1)] + [-1] * STEP
    text.append(0)
    owner.append(-1)
    offset.append(-1)
    covered, run, window = [], [], None
    for s in suffix_array(text):
        if offset[s] < 0:
            continue
        now = text[s : s + STEP]
        if now != window:
            if len(run) > 1:
                run.sort(key=lambda x: found[x[0]][3])
                covered += [i * STEP + o for i, o in run[1:]]
            run, window = [], now
        run.append((owner[s], offset[s]))
    if len(run) > 1:
        run.sort(key=lambda x: found[x[0]][3])
        covered += [i * STEP + o for i, o in run[1:]]
    return covered


COVERED = f"`{ROW}` long, first long, end long"


def covered_in_cores(found: DataFrame) -> DataFrame:
    """(row id, first, end) of bytes covered by windows around cores, from core_pieces().

    The pieces stream by in the order of core, surroundings and place. Equal pieces are covered but for the first; the different
    ones of a number of cores are sorted as one text.
    """

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[tuple[int, bytes, bytes, int]] = []
        places: list[tuple[int, int]] = []
        ranks: list[tuple] = []
        last, number, symbols = None, 0, 0

        def flush() -> list[tuple[int, int, int]]:
            for i, rank in enumerate(sorted(range(len(ranks)), key=ranks.__getitem__)):
                pending[rank] = (*pending[rank][:3], i)
            codes = repeated_windows(pending) if len(pending) > 1 else []
            out = [(row, first + c % STEP, first + c % STEP + LENGTH) for c in codes for row, first in (places[c // STEP],)]
            pending.clear(), places.clear(), ranks.clear()
            return out

        for batch in batches:
            out = []
            for core, left, right, doc, row, at in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if last == (core, left, right):
                    out.append((row, at - len(left), at + CORE + len(right)))
                    continue
                if last is None or last[0] != core:
                    if symbols > SYMBOLS:
                        out += flush()
                        number, symbols = 0, 0
                    number += 1
                last = (core, left, right)
                pending.append((number, left, right, 0))
                places.append((row, at - len(left)))
                ranks.append((doc is not None, doc or 0, row, at))
                symbols += len(left) + len(right) + 2
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in range(3)], [ROW, "first", "end"])
        out = flush()
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in range(3)], [ROW, "first", "end"])

    kinds = found.groupBy("core").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    found = found.join(kinds, "core")
    some = found.filter(F.col("n") <= PIECES).drop("n").repartition(F.col("core")).sortWithinPartitions("core", "left", "right", "doc_id", ROW, "at")
    # A core with more surroundings than a task should sort: every window is a key of its own.
    offset = F.explode(F.expr(f"sequence(0, octet_length(left) + octet_length(right) + 1 - {STEP})")).alias("o")
    many = found.filter(F.col("n") > PIECES).select("core", "left", "right", "doc_id", ROW, "at", offset)
    window = F.expr(f"struct(core, substring(left, o + 1, 1000) as l, substring(right, 1, {STEP} - 1 - octet_length(left) + o) as r)")
    many = many.select(window.alias("w"), ROW, (F.expr("at - octet_length(left) + o")).alias("first"), F.struct(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("d"), F.col(ROW).alias("row"), F.expr("at - octet_length(left) + o").alias("p")).alias("rank"))
    least = many.groupBy("w").agg(F.min("rank").alias("least"))
    many = many.join(least, "w").filter("rank != least").select(ROW, "first", (F.col("first") + LENGTH).alias("end"))
    return some.mapInArrow(stream, COVERED).union(many)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: row id, doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (first byte, end).

    A byte goes if some LENGTH-byte string over it also starts earlier: in a row of smaller doc_id (NULL the smallest, repeated
    ids in the order of the rows) or earlier in the same text. Strings never span texts and are judged on the input. NULL text is
    empty; texts of fewer bytes stay whole. An empty table gives no rows. Starts Spark jobs.
    """
    base = keyed(docs, id_col, text_col)
    met = checkpointed(met_fragments(fragments(base)))
    whole = met.filter("covered").select(ROW, F.col("start").alias("first"), (F.col("start") + F.abs("windows") + (LENGTH - 1)).alias("end"))
    inner = covered_in_cores(checkpointed(core_pieces(base, shared_cores(met))))
    spans = whole.union(inner).groupBy(ROW).agg(F.collect_list(F.struct("first", "end")).alias("spans"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            out = []
            texts = each(*utf8(batch.column("text")))
            lists = batch.column("spans")
            for i, (part, _) in enumerate(texts):
                runs = np.zeros((0, 2), np.int64)
                if lists[i].is_valid:
                    flat = lists[i].values
                    first, end = flat.field("first").to_numpy(), flat.field("end").to_numpy()
                    order = np.argsort(first, kind="stable")
                    first, end = first[order], np.maximum.accumulate(end[order])
                    new = np.append(True, first[1:] > end[:-1])
                    runs = np.stack([first[new], end[np.append(np.flatnonzero(new)[1:], len(first)) - 1]], 1)
                keep, at = hashlib.sha256(), 0
                for a, b in runs.tolist():
                    keep.update(part[at:a].tobytes())
                    at = b
                keep.update(part[at:].tobytes())
                out.append((len(part), int((runs[:, 1] - runs[:, 0]).sum()), len(runs), keep.hexdigest(), [{"first": a, "end": b} for a, b in runs.tolist()]))
            columns = [pa.array([x[j] for x in out], k) for j, k in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string(), kind))]
            yield pa.RecordBatch.from_arrays([batch.column(ROW), batch.column("doc_id"), *columns], [ROW, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    result = f"`{ROW}` long, doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<first: bigint, end: bigint>>"
    return base.join(spans, ROW, "left").select(ROW, "doc_id", "text", "spans").mapInArrow(remove, result)
