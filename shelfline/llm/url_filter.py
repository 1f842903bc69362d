"""URL filter: domain and path rules first, then the ratio of two character models, in DataFrame operations only.

The models are variable-order Markov models of accepted and of rejected URLs, smoothed by Witten and Bell; the URLs that rules
decide train the models (three of four) and set the threshold (the fourth).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import checkpointed

#: (verdict, host, path): a rule fits its host and all subdomains, where the path starts with its path; the longest fits best.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
#: Symbols of the models, numbered from 1: a-z, digits, / . - and all others; 0 begins and ends a URL.
LETTERS = "abcdefghijklmnopqrstuvwxyz0/.-?"
SYMBOLS = len(LETTERS) + 1
#: Characters of the longest context; the model then has at most SYMBOLS^(ORDER+1) entries, about a million.
ORDER = 3
#: Log-likelihoods are counted in millionths, as whole numbers, so sums do not depend on their order.
UNIT = 1_000_000
#: Labelled URLs whose MD5 begins below this hexadecimal digit, a quarter, are kept for calibration.
HELD = "4"


def host(url: F.Column) -> F.Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; '' without ://."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: F.Column) -> F.Column:
    """After the host up to ? # or the end; '' without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def best_rule(rules: list[tuple[str, str, str]] = RULES) -> tuple[F.Column, F.Column]:
    """(rule, verdict) of the longest fitting rule over the columns host and path; NULL without one. The rules are a short list."""
    fits = lambda h, p: ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
    ordered = sorted(rules, key=lambda r: (-len(r[1]) - len(r[2]), r))
    chain = lambda value: reduce(lambda c, r: c.when(fits(r[1], r[2]), value(r)), ordered, F.when(F.lit(False), F.lit(None)))
    return chain(lambda r: F.lit(r[1] + r[2])), chain(lambda r: F.lit(r[0]))


def spelled(url: F.Column) -> F.Column:
    """What the models read: the URL after ://, lower-cased, each run of digits as one 0, other characters as ?."""
    rest = F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^(?:.*?://)?(.*)$", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_replace(F.regexp_replace(rest, "[0-9]+", "0"), "[^a-z0/.-]", "?")


def symbols(spelled: F.Column) -> F.Column:
    """Numbers of the symbols of a spelled URL and a 0 for its end; one pass over its characters."""
    return F.transform(F.split(F.concat(spelled, F.lit(" ")), ""), lambda c: F.instr(F.lit(LETTERS), c))


def with_grams(urls: DataFrame) -> DataFrame:
    """One row per symbol of the column `spelled` and one for its end: `gram` holds the symbol and its ORDER predecessors.

    The predecessors are read from an array by position, so a URL of any length takes time in proportion to it.
    """
    rows = urls.withColumn("padded", F.concat(F.array_repeat(F.lit(0), ORDER), symbols(F.col("spelled"))))
    code = lambda i: reduce(lambda high, j: high * SYMBOLS + F.get("padded", i - j), range(ORDER - 1, -1, -1), F.get("padded", i - ORDER))
    return rows.select(*(c for c in urls.columns if c != "spelled"), F.explode(F.transform(F.sequence(F.lit(ORDER), F.size("padded") - 1), code)).alias("gram"))


def gram_weights(counts: DataFrame) -> DataFrame:
    """(gram, weight) from (gram, allow, block): log of its probability by the accepted URLs less that by the rejected.

    A gram's probability is that of its last symbol after the others: each order's share, mixed with the order below by as many
    parts as the context has kinds of continuation, down to equal shares.
    """
    kinds = ("allow", "block")
    lower = None
    for k in range(ORDER + 1):
        size = SYMBOLS ** (k + 1)
        own = counts.groupBy((F.col("gram") % size).alias("g")).agg(*(F.sum(c).alias(c) for c in kinds)).withColumn("x", F.floor(F.col("g") / SYMBOLS))
        contexts = own.groupBy("x").agg(*(F.sum(c).alias(f"n_{c}") for c in kinds), *(F.count_if(F.col(c) > 0).alias(f"t_{c}") for c in kinds))
        rows = own.join(contexts, "x")
        if lower is None:
            rows = rows.select("*", *(F.lit(1.0 / SYMBOLS).alias(f"p_{c}") for c in kinds))
        else:
            rows = rows.withColumn("below", F.col("g") % (size // SYMBOLS)).join(lower.withColumnRenamed("g", "below"), "below")
        share = lambda c: F.when(F.col(f"n_{c}") == 0, F.col(f"p_{c}")).otherwise((F.col(c) + F.col(f"t_{c}") * F.col(f"p_{c}")) / (F.col(f"n_{c}") + F.col(f"t_{c}")))
        lower = rows.select("g", *(share(c).alias(f"p_{c}") for c in kinds))
    weight = F.round((F.log("p_allow") - F.log("p_block")) * UNIT).cast("long")
    return lower.select(F.col("g").alias("gram"), weight.alias("weight"))


def weight_table(weights: DataFrame) -> DataFrame:
    """One row, `weights`: the weight of every gram at the place of its number, 0 where it was not seen. SYMBOLS^(ORDER+1) entries."""
    every = weights.sparkSession.range(SYMBOLS ** (ORDER + 1)).withColumnRenamed("id", "gram").join(weights, "gram", "left")
    rows = F.array_sort(F.collect_list(F.struct("gram", F.coalesce(F.col("weight").cast("int"), F.lit(0)).alias("weight"))))
    return every.agg(F.transform(rows, lambda x: x["weight"]).alias("weights"))


def mean_weight() -> F.Column:
    """Mean weight of all grams of the column `spelled`, rounded down, by one pass that keeps the last gram; reads the column `weights`.

    Both columns are named once, so Spark folds them into this expression and copies the table into no row.
    """
    start = F.struct(F.lit(0).alias("gram"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("total"))

    def step(seen: F.Column, symbol: F.Column) -> F.Column:
        gram = seen["gram"] % SYMBOLS**ORDER * SYMBOLS + symbol
        return F.struct(gram.alias("gram"), (seen["n"] + 1).alias("n"), (seen["total"] + F.get("weights", gram)).alias("total"))

    return F.aggregate(symbols(F.col("spelled")), start, step, lambda seen: F.floor(seen["total"] / seen["n"]))


def threshold(scored: DataFrame) -> DataFrame:
    """One row: the score as many deviations below the mean of accepted as above that of rejected held-out URLs; 0 lacking either."""
    square = F.sum((F.col("score") * F.col("score")).cast("decimal(38,0)")).cast("double")
    of = scored.filter("held").groupBy().pivot("by_rule", ["allow", "block"]).agg(F.count("score").alias("n"), F.sum("score").alias("s"), square.alias("q"))
    mean = lambda c: F.col(f"{c}_s") / F.col(f"{c}_n")
    spread = lambda c: F.sqrt(F.greatest(F.col(f"{c}_q") / F.col(f"{c}_n") - mean(c) * mean(c), F.lit(0.0))) + 1.0
    return of.select(F.coalesce((mean("allow") * spread("block") + mean("block") * spread("allow")) / (spread("allow") + spread("block")), F.lit(0.0)).alias("threshold"))


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """One row per input row: page_id, host, path, rule, verdict, score (millionths of a nat per symbol), threshold.

    Where no rule fits, the verdict is allow from the threshold on. NULL or a URL without :// has empty host and path and is
    judged by its characters; repeated rows stay; an empty table gives no rows. Each URL is scored in its own row, without a
    shuffle, in time that grows with its length. Only the weights are sent to the tasks: SYMBOLS^(ORDER+1) whole numbers,
    however many URLs there are.
    """
    rule, verdict = best_rule(rules)
    url = F.col(url_col)
    urls = pages.select(F.col(id_col).alias("page_id"), host(url).alias("host"), path(url).alias("path"), spelled(url).alias("spelled"))
    urls = urls.withColumn("rule", rule).withColumn("by_rule", verdict)
    urls = urls.withColumn("held", F.col("by_rule").isNotNull() & (F.md5(F.col("spelled").cast("binary")) < HELD))
    seen = with_grams(urls.select("spelled", F.when(~F.col("held"), F.col("by_rule")).alias("label")))
    counts = seen.groupBy("gram").agg(F.count_if(F.col("label") == "allow").alias("allow"), F.count_if(F.col("label") == "block").alias("block"))
    table = weight_table(gram_weights(checkpointed(counts))).scalar()
    scored = urls.withColumn("weights", table).select("page_id", "host", "path", "rule", "by_rule", "held", mean_weight().alias("score"))
    limit = threshold(scored).scalar()
    by_score = F.when(F.col("score") >= F.col("threshold"), "allow").otherwise("block")
    return scored.withColumn("threshold", limit).select("page_id", "host", "path", "rule", F.coalesce("by_rule", by_score).alias("verdict"), "score", "threshold")
