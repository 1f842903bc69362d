"""The registered queries of the operators: each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm import best_fit, chat_format, decontaminate, exact_dedup, hard_negatives, html_blocks, jaccard_join, license_scan, phrase_mining, suffix_dedup, token_counts, toxicity, url_filter
from shelfline.llm.common import ROW, ship

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_read(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "score")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_read(spark, sf_dir, "documents")).drop(ROW, "spans")


def op3_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation against itself with its last reply swapped; masks as text, first-end, comma-joined."""
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    pairs = chat_format.format_preferences(turns, chat_format.swapped_replies(turns))
    spans = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws("-", x["first"], x["end"])), ",")
    return pairs.withColumn("chosen_mask", spans("chosen_mask")).withColumn("rejected_mask", spans("rejected_mask"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _read(spark, sf_dir, "labels").select("doc_id", "toxic"))
    scored = toxicity.score_texts(docs, model)
    held = F.coalesce(toxicity.remainder() == 1, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted", F.size("passages").alias("n_passages"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_read(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(_read(spark, sf_dir, "documents")).drop(ROW)


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "score", "first_word", "end_word", "seeds")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(_read(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.copy_groups(_read(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.linked_components(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 collocations of each language, of phrases that occur 100 times or more."""
    found = phrase_mining.mine_phrases(_read(spark, sf_dir, "documents"))
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page, by the tree fitted on the labelled pages built in."""
    return html_blocks.extract_text(_read(spark, sf_dir, "pages"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five negatives for each of the five positives of every hundredth vector; every seventh vector first gets the next label."""
    rows = _read(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_negatives(rows.select("vec_id", "embedding", label.alias("label")), F.col("id") % 100 == 0)


def queries() -> dict[str, Query]:
    return {name: query for name, query in globals().items() if name.startswith("op")}
