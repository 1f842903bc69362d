"""The corpus pipeline: toxicity, exact dedup, n-gram Jaccard join, benchmark decontamination, best-fit packing.

All but the last stage return the columns of their input unchanged, whatever their names; only `__llm_row` is reserved. An
empty table passes through every stage as an empty table.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce, wraps
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from shelfline.llm import best_fit, decontaminate, exact_dedup, jaccard_join, toxicity
from shelfline.llm.common import ROW, shared_folder, ship


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a toxicity score of 0.7 or more go; the model learns from the labels outside the held-out third.

    NULL and empty texts have no toxic passage and get the score of a text without evidence; repeated rows are judged alike.
    Without labels of both kinds, or without documents, nothing goes.
    """
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays, that with the largest doc_id.

    NULL text equals the empty one, so one row of all these stays; NULL is the smallest doc_id, and of repeated rows one stays.
    """
    return exact_dedup.drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by 80 % common word shingles the row with the smallest doc_id stays.

    Texts without words link to nothing and stay. A row without doc_id stays where no row of its group has one.
    """
    return jaccard_join.drop_near_copies(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a benchmark item go.

    NULL and empty texts hold none, and NULL or empty items are in no document; without items nothing goes.
    """
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents in bins of bytes: no bin has two of one source or two equal texts.

    NULL and empty texts take a place of length 0, a NULL source conflicts with nothing, texts over one bin are cut into chunks.
    """
    return best_fit.pack(docs).drop(ROW)


def _stage(name: str, function: Callable) -> tuple[str, Callable]:
    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        return function(spark, docs, sf_dir)

    return name, run_stage


STAGES = [
    _stage("toxicity", toxic),
    _stage("exact_dedup", exact),
    _stage("ngram_jaccard_join", near),
    _stage("benchmark_decontamination", clean),
    _stage("best_fit_packing", packed),
]
#: Segment scores, set distances, alignments and packing are beyond SQL; tests/llm holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table `documents`, each written in the shared checkpoint folder and read again.

    The tables stay there, since the returned DataFrame reads the last of them whenever it is used.
    """
    folder = f"{shared_folder(spark)}/corpus_pipeline-{uuid4().hex}"

    def step(docs: DataFrame, numbered: tuple[int, tuple]) -> DataFrame:
        number, (name, function) = numbered
        kept = function(spark, docs, sf_dir)
        if number == len(STAGES):
            return kept
        target = f"{folder}/{number}_{name}.parquet"
        kept.write.parquet(target)
        return spark.read.parquet(target)

    return reduce(step, enumerate(STAGES, 1), spark.read.parquet(f"{sf_dir}/documents.parquet"))
