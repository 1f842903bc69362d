"""Token counts of byte-level BPE by rank-synchronous merging of ragged numpy arrays."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import pieces, utf8

TOKENIZER = "byte_bpe_50k.json"
#: Fixed by the tokenizer's format: how byte-level BPE cuts a text into pre-tokens.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: The same for texts of code points below U+0240, whose letters, numbers and white space are few enough to list.
LETTER, NUMBER, SPACE = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be", "\t-\r \u0085\u00a0"
SIMPLE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^{SPACE}{LETTER}{NUMBER}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: Lead bytes from this on begin code points of U+0240 and more.
BEYOND = 0xC9
#: Pre-tokens whose counts a worker remembers before it starts anew.
REMEMBERED = 1 << 18
COUNTS = "doc_id long, n_bytes long, n_tokens long"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: printable bytes themselves, the others from 256 on in order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


class Merges:
    """Merge ranks of a byte-level BPE file, and the number of symbols that survive for batches of pre-tokens."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.base = max(vocab.values()) + 1
        self.of_byte = np.array([vocab[x] for x in byte_letters()], np.int64)
        keys = np.array([vocab[a] * self.base + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.none = len(pairs)
        two = np.arange(1 << 16)
        self.of_bytes = self.ranked(self.of_byte[two >> 8], self.of_byte[two & 255])
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.pattern = regex.compile(PRE_TOKEN)
        self.known: dict[str, int] = {}

    def ranked(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols; `none` where no merge fits."""
        pair = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        return np.where(self.keys[at] == pair, self.ranks[at], self.none)

    def survivors(self, tokens: list[bytes]) -> np.ndarray:
        """Symbols left of each non-empty sequence of bytes.

        Each round applies, in all sequences at once, the pair of lowest rank that the sequence has, at every place from the
        left where it does not overlap the place before. A merge never makes a pair of lower rank, so this is the usual order.
        Only pairs beside a merged place are ranked anew.
        """
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        result = lengths.copy()
        owner = np.arange(len(tokens))
        raw = np.frombuffer(b"".join(tokens), np.uint8)
        symbols = self.of_byte[raw]
        if not len(raw):
            return result
        first = self.of_bytes[raw[:-1].astype(np.int64) * 256 + raw[1:]]
        rank = np.append(first, self.none)
        rank[np.cumsum(lengths) - 1] = self.none
        while True:
            lowest = np.minimum.reduceat(rank, np.cumsum(lengths) - lengths)
            alive = lowest < self.none
            result[owner[~alive]] = lengths[~alive]
            if not alive.any():
                return result
            inside = np.repeat(alive, lengths)
            symbols, rank, lowest = symbols[inside], rank[inside], lowest[alive]
            owner, lengths = owner[alive], lengths[alive]
            at = np.flatnonzero(rank == np.repeat(lowest, lengths))
            fresh = np.flatnonzero(np.diff(at, prepend=-2) != 1)
            nth = np.arange(len(at)) - np.repeat(fresh, np.diff(fresh, append=len(at)))
            at = at[nth % 2 == 0]  # of a row of overlapping places every second is free
            symbols[at] = self.made[rank[at]]
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            ends = np.cumsum(lengths)
            lengths = np.add.reduceat(stay, ends - lengths, dtype=np.int64)
            moved = (np.cumsum(stay) - 1)[at]
            symbols, rank = symbols[stay], rank[stay]
            final = np.zeros(len(symbols), bool)
            final[np.cumsum(lengths) - 1] = True
            beside = np.concatenate([moved, moved[(moved > 0)] - 1])
            beside = beside[~final[beside]]
            rank[moved] = self.none
            rank[beside] = self.ranked(symbols[beside], symbols[beside + 1])

    def counted(self, texts: list[str], simple: bool = False) -> list[int]:
        """Tokens of each text; simple: every code point is below U+0240."""
        pattern = SIMPLE if simple else self.pattern
        extra, cut = [0] * len(texts), []
        for i, text in enumerate(texts):
            parts = [text]
            if self.special is not None and (n := len(self.special.findall(text))):
                extra[i], parts = n, self.special.split(text)
            cut.append([t for part in parts for t in pattern.findall(part)])
        if len(self.known) > REMEMBERED:
            self.known.clear()
        if new := list({t for tokens in cut for t in tokens} - self.known.keys()):
            self.known.update(zip(new, self.survivors([t.encode() for t in new]).tolist(), strict=True))
        return [n + sum(map(self.known.__getitem__, tokens)) for n, tokens in zip(extra, cut, strict=True)]


_loaded: dict[str, Merges] = {}


def merges(name_or_path: str) -> Merges:
    """The merges of a file, read once per worker; a plain name is looked up among the installed public tokenizers."""
    if name_or_path not in _loaded:
        path = name_or_path
        if "/" not in path:
            import public_tokenizers

            path = public_tokenizers.path(path)
        _loaded[name_or_path] = Merges(str(path))
    return _loaded[name_or_path]


def count_tokens(docs: DataFrame, tokenizer: str = TOKENIZER, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    The counts are those of the tokenizer's own library, special strings inside a text counting as one token. NULL text is
    empty: 0 bytes, 0 tokens. Repeated rows and NULL ids pass through; an empty table gives no rows. No shuffle. A task holds one
    piece of about a megabyte of text, or one longer document, and the counts of a bounded number of pre-tokens.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = merges(tokenizer)
        for batch in batches:
            text = pc.fill_null(batch.column("text").cast(pa.large_string()), "")
            raw, offsets = utf8(text)
            n = [x for lo, hi, part, _ in pieces(raw, offsets) for x in known.counted(text.slice(lo, hi - lo).to_pylist(), not (part >= BEYOND).any())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(count, COUNTS).withColumn("over_limit", F.col("n_tokens") > limit)
