"""License scan: rolling word k-grams vote for diagonals of template texts; neighbouring diagonals merge and spans are verified."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfline.llm.common import ROW, grams, keyed, pieces, utf8, words

#: Phrases whose exact places are counted, by label.
PHRASES = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
#: Opening words of common notices, by label; a text may hold several.
NOTICES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("gpl-2", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2"),
    ("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 3"),
    ("gpl-2", "licensed under the gnu general public license version 2"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license version 2 0"),
    ("cc-by", "licensed under a creative commons attribution international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial international license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]
#: Words of a k-gram, how far apart diagonals may lie to merge, and the least share of a notice's words that a span must hold.
K, NEAR, COVER = 3, 3, 0.7
#: A span may be this many times as long as its notice.
STRETCH = 1.5

INSIDE = np.zeros(256, bool)
INSIDE[48:58] = INSIDE[65:91] = INSIDE[97:123] = INSIDE[128:] = True
HITS = f"`{ROW}` long, doc_id long, n_words long, hits array<struct<at: bigint, hash: bigint, gram: string>>"


def template_rows() -> list[tuple[int, str, bool, int, int, int, str]]:
    """(template, label, whether a phrase, its words, position, hash, gram) of every k-gram of the templates; a fixed, small table."""
    out = []
    for i, (label, text, phrase) in enumerate([(a, t, True) for a, t in PHRASES.items()] + [(a, t, False) for a, t in NOTICES]):
        raw = np.frombuffer(text.encode(), np.uint8)
        _, _, hashed, firsts = words(raw, np.array([0, len(raw)]), INSIDE)
        each = text.split()
        hashes, at = grams(hashed, firsts, K)
        out += [(i, label, phrase, len(each), int(p), int(h), " ".join(each[p : p + K])) for p, h in zip(at, hashes.view(np.int64), strict=True)]
    return out


def templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(template_rows(), "template int, label string, phrase boolean, length int, position int, hash long, gram string")


def hits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row id, doc_id, n_words, hits): the rolling k-grams of each text whose hash some template has, with their words."""
    wanted = np.unique(np.array([r[5] for r in template_rows()], np.int64).view(np.uint64))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("at", pa.int64()), ("hash", pa.int64()), ("gram", pa.string())]))
        low = np.zeros(1 << 16, bool)
        low[(wanted & np.uint64(0xFFFF)).astype(np.int64)] = True
        for batch in batches:
            raw, offsets = utf8(batch.column("text"))
            counts, found = [], []
            for _, _, part, edges in pieces(raw, offsets):
                start, end, hashed, firsts = words(part, edges, INSIDE)
                counts.append(np.diff(firsts))
                of: list[list] = [[] for _ in range(len(edges) - 1)]
                hashes, at = grams(hashed, firsts, K)
                maybe = np.flatnonzero(low[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
                for j in maybe[np.isin(hashes[maybe], wanted)]:
                    i = int(at[j])
                    row = int(np.searchsorted(firsts, i, "right")) - 1
                    gram = b" ".join(part[start[x] : end[x]].tobytes().lower() for x in range(i, i + K)).decode("utf-8", "replace")
                    of[row].append({"at": i - int(firsts[row]), "hash": int(hashes[j].view(np.int64)), "gram": gram})
                found += of
            counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(ROW), batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(found, kind)], [ROW, "doc_id", "n_words", "hits"])

    return keyed(docs, id_col, text_col).mapInArrow(scan, HITS)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Words are runs of a-z (A-Z lower-cased), 0-9 and non-ASCII characters. n_base counts all places of the phrases. A notice
    is found where a band of diagonals at most NEAR apart holds COVER of its words within STRETCH times its length; score is the
    best such share (1 with a phrase, else 0). Of overlapping spans only the best count. NULL text is empty; labels are '' and the places NULL where nothing is found.
    Repeated rows and NULL ids each keep a row of their own; an empty table gives no rows. One shuffle, by row.
    """
    rows = hits(docs, id_col, text_col).select(ROW, "doc_id", "n_words", F.explode_outer("hits").alias("hit"))
    rows = rows.repartition(F.col(ROW)).select(ROW, "doc_id", "n_words", "hit.at", "hit.hash", "hit.gram")
    place = ["template", "label", "phrase", "length"]
    row = [ROW, "doc_id", "n_words"]
    # Equal hashes count only with equal words.
    votes = rows.join(F.broadcast(templates(docs.sparkSession)), ["hash", "gram"], "left").withColumn("diagonal", F.col("at") - F.col("position"))
    lines = votes.groupBy(*row, *place, "diagonal").agg(F.collect_set("position").alias("positions"), F.min("at").alias("first"), (F.max("at") + K).alias("end"))
    of = W.partitionBy(*row, *place).orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(of)
    fresh = F.when(F.col("phrase") | apart.isNull() | (apart > NEAR), 1).otherwise(0)
    bands = lines.withColumn("fresh", fresh).withColumn("band", F.sum("fresh").over(of)).groupBy(*row, *place, "band")
    bands = bands.agg(F.array_distinct(F.flatten(F.collect_list("positions"))).alias("positions"), F.min("first").alias("first"), F.max("end").alias("end"))
    covered = F.array_distinct(F.flatten(F.transform("positions", lambda p: F.sequence(p, p + K - 1))))
    share = F.size(covered) / F.col("length")
    exact = F.col("phrase") & (F.size("positions") == F.col("length") - K + 1)
    seen = ~F.col("phrase") & (share >= COVER) & (F.col("end") - F.col("first") <= F.col("length") * STRETCH)
    bands = bands.select(*row, "label", "first", "end", exact.alias("exact"), F.when(exact, 1.0).when(seen, share).alias("share"))
    # Of spans that overlap only those of the best share count, so that one notice does not pass for its variants.
    in_row = W.partitionBy(*row, F.col("share").isNotNull()).orderBy("first", "end", "label")
    reach = F.max("end").over(in_row.rowsBetween(W.unboundedPreceding, -1))
    bands = bands.withColumn("fresh", F.when(F.col("first") < reach, 0).otherwise(1)).withColumn("run", F.sum("fresh").over(in_row))
    best = F.max("share").over(W.partitionBy(*row, F.col("share").isNotNull(), "run"))
    bands = bands.withColumn("share", F.when(F.col("share") == best, F.col("share")))
    labels = lambda hit: F.array_join(F.array_sort(F.collect_set(F.when(hit, F.col("label")))), ",")
    found = bands.groupBy(*row).agg(
        F.count_if("exact").alias("n_base"),
        F.min(F.when(F.col("exact"), F.col("first"))).alias("first_word"),
        F.max(F.when(F.col("exact"), F.col("first"))).alias("last_word"),
        labels(F.col("exact")).alias("base_labels"),
        labels(F.col("share").isNotNull()).alias("labels"),
        F.coalesce(F.max("share"), F.lit(0.0)).alias("score"),
    )
    return found.drop(ROW)
