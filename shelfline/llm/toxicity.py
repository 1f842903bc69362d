"""Toxic passages as maximum-scoring segments over token log-odds, judged by extreme-value statistics."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import checkpointed

TOKEN = re.compile(r"\w+")
#: Bound of the labelled rows that the model is fitted on; they are broadcast, and so are its tokens, each seen in several of them.
MAX_LABELS = 1 << 17
#: Weight of the Dirichlet prior as a share of all observations, and the least |z| of a token that the model keeps.
PRIOR, LEAST_Z = 0.1, 2.5
THRESHOLD = 0.7


@dataclass
class Model:
    """Token log-odds, the log-odds of every other token, and the calibration of a document's evidence."""

    weights: dict[str, float] = field(default_factory=dict)
    other: float = -0.01
    k: float = 1.0
    bias: float = 0.0
    slope: float = 0.0

    def segments(self, text: str) -> tuple[int, list[tuple[int, int, float]]]:
        """Number of tokens, and all maximal scoring segments (first token, end token, score) by one pass of Ruzzo and Tompa.

        Tokens outside the model share one negative score, so runs of them only move the running sum. Each segment points to
        the nearest earlier one that begins at a lower sum, so the search skips what it has passed and the scan stays linear.
        """
        tokens = TOKEN.findall(text.lower())
        weights, found = self.weights, []
        total, before = 0.0, 0
        for i in [i for i, t in enumerate(tokens) if t in weights]:
            total += self.other * (i - before)
            before, w = i + 1, weights[tokens[i]]
            left, total = total, total + w
            if w <= 0:
                continue
            first, lower = i, len(found) - 1
            while lower >= 0 and found[lower][2] >= left:
                lower = found[lower][4]
            while lower >= 0 and found[lower][3] < total:
                first, left, below = found[lower][0], found[lower][2], found[lower][4]
                del found[lower:]
                lower = below
            found.append((first, i + 1, left, total, lower))
        return len(tokens), [(a, b, right - left) for a, b, left, right, _ in found]

    def evidence(self, n: int, scores: list[float]) -> float:
        """-ln of the p-value that a clean text of n tokens holds such segments: the least over the r best of the sum statistic."""
        best, total = 0.0, 0.0
        for r, s in enumerate(sorted(scores, reverse=True), 1):
            total += s - math.log(max(self.k * n, 1e-300))
            if r == 1:
                tail = total if total > 30 else -math.log(-math.expm1(-math.exp(-total))) if total > -3 else 0.0
            else:
                tail = total - (r - 1) * math.log(total) + math.lgamma(r + 1) + math.lgamma(r) if total > r else 0.0
            best = max(best, tail)
        return best

    def score(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.bias + self.slope * math.log1p(evidence)))))


def remainder(id_col: str = "doc_id") -> F.Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(fold, toxic, text) of the labelled rows outside the held-out third; of equal texts with one label one row.

    At most MAX_LABELS labels are used, those of smallest hash; only they and a fingerprint of each are broadcast.
    """
    known = labels.filter(F.col(label_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
    known = known.withColumn("fold", remainder("doc_id")).filter("fold != 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELS)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(known), "doc_id")
    rows = rows.withColumn("fp", F.xxhash64("text"))
    one = rows.groupBy("fp", "toxic").agg(F.min("doc_id").alias("doc_id"))
    return rows.join(F.broadcast(one), ["fp", "toxic", "doc_id"]).select("fold", "toxic", "text")


def token_counts(rows: DataFrame) -> DataFrame:
    """(token, toxic, clean): in how many texts of either label each token is."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of: tuple[Counter, Counter] = (Counter(), Counter())
            for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist(), strict=True):
                of[toxic > 0].update(set(TOKEN.findall(text.lower())))
            tokens = list(of[0].keys() | of[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.string()), *(pa.array([of[x][t] for t in tokens], pa.int64()) for x in (1, 0))], ["token", "toxic", "clean"])

    return rows.mapInArrow(count, "token string, toxic long, clean long").groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def log_odds(counts: DataFrame) -> Model:
    """Tokens whose log-odds under an informative Dirichlet prior stand out, by z, and the log-odds of all others together.

    A token's weight is its log-odds less one standard deviation towards 0, so that what few texts hold counts for less. The
    scores are bounded by log-likelihood ratios, so the decay of the extreme-value distribution of their segments is 1.
    """
    n1, n0 = counts.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum("clean"), F.lit(0))).first()
    if not n1 or not n0:
        return Model()
    prior = PRIOR * (n1 + n0)
    share = (F.col("toxic") + F.col("clean")) / F.lit(float(n1 + n0)) * prior
    a, b = F.col("toxic") + share, F.col("clean") + share
    delta = F.log(a / (n1 + prior - a)) - F.log(b / (n0 + prior - b))
    z = delta / F.sqrt(1 / a + 1 / b)
    kept = counts.select("token", (a / (n1 + prior)).alias("p1"), (b / (n0 + prior)).alias("p0"), z.alias("z")).filter(F.abs("z") >= LEAST_Z)
    kept = kept.withColumn("weight", F.log(F.col("p1") / F.col("p0")) * (1 - 1 / F.abs("z")))
    rows = kept.orderBy("token").collect()
    p1, p0 = sum(r["p1"] for r in rows), sum(r["p0"] for r in rows)
    other = math.log(max(1 - p1, 1e-9) / max(1 - p0, 1e-9))
    return Model({r["token"]: r["weight"] for r in rows}, min(other, -1e-4))


def extreme_value_rate(n: np.ndarray, top: np.ndarray, clean: np.ndarray) -> float:
    """K of the extreme-value distribution, from token counts and best segment scores of the clean texts."""
    return float(clean.sum() / max((n * np.exp(-top))[clean].sum(), 1e-9))


def logistic(evidence: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Bias and slope (at least 0) of the label odds as a logistic function of log(1 + evidence)."""
    x = np.stack([np.ones_like(evidence), np.log1p(evidence)], 1)
    w, ridge = np.zeros(2), np.array([1e-3, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (toxic - p) - ridge * w)
        w = w + np.clip(step, -2, 2)
        if abs(step).max() < 1e-9:
            break
    return float(w[0]), float(max(w[1], 0.0))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Log-odds from one half of the training rows, calibration from the other; starts Spark jobs.

    Without labels of both kinds every text gets the score 0.5. The segment scores of the calibration texts stay in the
    checkpoint folder; the driver takes two numbers of each text, of at most MAX_LABELS.
    """
    rows = training_rows(docs, labels, id_col, text_col, label_col)
    model = log_odds(token_counts(rows.filter("fold = 0")))
    if not model.weights:
        return model

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.segments(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array([n for n, _ in found], pa.int64()), pa.array([[s for *_, s in x] for _, x in found], pa.list_(pa.float64()))], ["toxic", "n", "scores"])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            evidence = [model.evidence(n, s) for n, s in zip(batch.column("n").to_pylist(), batch.column("scores").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(evidence, pa.float64())], ["toxic", "evidence"])

    seen = checkpointed(rows.filter("fold = 2").select("toxic", "text").mapInArrow(scan, "toxic int, n long, scores array<double>"))
    best = seen.select("toxic", "n", F.coalesce(F.array_max("scores"), F.lit(0.0)).alias("top")).toPandas()
    clean = best["toxic"].to_numpy() == 0
    if clean.any() and not clean.all():
        model.k = extreme_value_rate(best["n"].to_numpy(), best["top"].to_numpy(), clean)
        judged = seen.mapInArrow(weigh, "toxic int, evidence double").toPandas()
        model.bias, model.slope = logistic(judged["evidence"].to_numpy(), (judged["toxic"].to_numpy() > 0).astype(float))
    return model


def score_texts(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """`docs` with score (0 to 1), predicted (1 from 0.7 on) and passages (first and end token, score), in place of columns so named.

    A passage is listed when clean texts of that length hold one as high less than once in 20. NULL text is empty and has no
    passage, repeated rows get equal scores. One pass without shuffle; a text is held alone, its tokens included.
    """
    names = [c for c in docs.columns if c not in ("score", "predicted", "passages")]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in names)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
        for batch in batches:
            scores, passages = [], []
            for value in batch.column(text_col):
                n, found = model.segments(value.as_py() or "")
                scores.append(model.score(model.evidence(n, [s for *_, s in found])))
                passages.append([{"first": a, "end": b, "score": s} for a, b, s in found if model.k * n * math.exp(-s) < 0.05])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(scores, pa.float64()), pa.array([int(s >= THRESHOLD) for s in scores], pa.int32()), pa.array(passages, kind)], [*names, "score", "predicted", "passages"])

    return docs.select(*(F.col(f"`{c}`") for c in names)).mapInArrow(scan, f"{kinds}, score double, predicted int, passages array<struct<first: bigint, end: bigint, score: double>>")


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of `docs` that are not predicted toxic, with all their columns, those named like a score's too."""
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    kept = score_texts(plain, model, f"c{docs.columns.index(text_col)}").filter("predicted = 0")
    return kept.drop("score", "predicted", "passages").toDF(*docs.columns)
