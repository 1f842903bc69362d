"""URL filter and preference formatting on small tables; their queries are held against SQL in test_llm_oracle.py."""

from __future__ import annotations

import math
import random
import re
import time
from collections import Counter

from pyspark.sql import functions as F

from shelfline.llm import chat_format, url_filter


def test_urls(spark):
    urls = [
        "http://a.NET/x?y#z", "https://EXAMPLE.net/en/1", "https://www.example.net/fr/1", "http://b.example.com/de/2", "http://notexample.com/de/2", "https://c.org/fr/", "https://c.org/frx",
        "https://c.org#/fr/", None, "", "no scheme", "a://b://c/d", "http://host", "http://net?x", "http://é漢.org/ü",
    ]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)] + [(0, urls[0], "x"), (None, urls[1], "x")], "page_id long, url string, rule string")
    rows = url_filter.judge_urls(pages).collect()
    got = {r["page_id"]: (r["host"], r["path"], r["rule"]) for r in rows}
    assert len(rows) == len(urls) + 2
    assert got[0] == ("a.net", "/x", "net/") and got[1] == ("example.net", "/en/1", "example.net/en/") and got[2] == ("www.example.net", "/fr/1", "net/")
    assert got[3] == ("b.example.com", "/de/2", "example.com/de/") and got[4] == ("notexample.com", "/de/2", None)
    assert got[5][2] == "org/fr/" and got[6] == ("c.org", "/frx", None) and got[7] == ("c.org", "", None)
    assert got[8] == got[9] == got[10] == ("", "", None) and got[11] == ("b:", "//c/d", None) and got[12] == ("host", "", None)
    assert got[13] == ("net", "", None)
    assert {r["verdict"] for r in rows} <= {"allow", "block"}
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


def test_models_tell_accepted_from_rejected(spark):
    rows = [(i, f"http://site{i}.org/fr/article-{i}/read") for i in range(200)] + [(200 + i, f"http://x{i}.net/win-cash-{i}.exe") for i in range(200)]
    rows += [(1000, "http://site.com/article-5/read"), (1001, "http://x5.com/win-cash-7.exe")]
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert got[1000] == "allow" and got[1001] == "block"


def test_grams_and_scores_equal_brute_force(spark):
    rnd = random.Random(5)
    urls = ["", "a", *("".join(rnd.choice("ab./-09?Zé") for _ in range(rnd.randint(1, 40))) for _ in range(60))]
    rows = spark.createDataFrame([(u,) for u in urls], "url string").select("url", url_filter.spelled(F.col("url")).alias("spelled"))
    size, order = url_filter.SYMBOLS, url_filter.ORDER

    def grams(text):
        numbers = [0] * order + [url_filter.LETTERS.find(c) + 1 for c in text] + [0]
        return [sum(numbers[i - j] * size**j for j in range(order + 1)) for i in range(order, len(numbers))]

    spelled = [r["spelled"] for r in rows.collect()]
    assert Counter(r["gram"] for r in url_filter.with_grams(rows).collect()) == Counter(g for t in spelled for g in grams(t))
    weights = {g: rnd.randint(-5_000_000, 5_000_000) for t in spelled for g in grams(t) if g % 3}
    table = url_filter.weight_table(spark.createDataFrame(list(weights.items()), "gram long, weight long")).scalar()
    got = rows.withColumn("weights", table).select(url_filter.mean_weight().alias("score"))
    assert [r["score"] for r in got.collect()] == [math.floor(sum(weights.get(g, 0) for g in grams(t)) / len(grams(t))) for t in spelled]


def test_very_long_urls_take_linear_time_and_the_table_stays_out_of_the_rows(spark):
    rows = [(i, f"http://site{i}.org/fr/article-{i}/read") for i in range(20)] + [(20 + i, f"http://x{i}.net/win-cash-{i}.exe") for i in range(20)]
    rows += [(100, "http://site.com/" + "article/read-" * 80_000), (101, "http://site.com/" + "win.cash.exe" * 80_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    began = time.perf_counter()
    judged = url_filter.judge_urls(pages)
    got = {r["page_id"]: r["verdict"] for r in judged.collect()}
    assert got[100] == "allow" and got[101] == "block" and time.perf_counter() - began < 60
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Project \[[^\n]*scalar-subquery#\d+ \[[^\n]*\] AS weights", plan)


def test_preferences(spark):
    ddl = "conv_id long, turn long, role string, text string, prompt string"
    good = [(1, 0, "user", "hi", ""), (1, 1, "assistant", "yes", ""), (2, 0, "user", "a", ""), (3, 0, "user", None, ""), (3, 1, None, "x", ""), (4, 0, "user", "q", ""), (None, 0, "user", "lost", ""), (5, 0, "user", "only", "")]
    bad = [(1, 0, "user", "hi", ""), (1, 1, "assistant", "no", ""), (1, 2, "user", "why", ""), (2, 0, "user", "b", ""), (3, 0, "user", "", ""), (3, 1, "", "x", ""), (4, 0, "user", "q", ""), (4, 0, "user", "q", "")]
    got = {r["conv_id"]: r for r in chat_format.format_preferences(spark.createDataFrame(good, ddl), spark.createDataFrame(bad, ddl)).collect()}
    assert set(got) == {1, 2, 3, 4}
    assert got[1]["n_prefix"] == 1 and got[1]["prompt"] == "<|user|>\nhi\n"
    assert got[1]["chosen"] == "<|assistant|>\nyes\n" and got[1]["rejected"] == "<|assistant|>\nno\n<|user|>\nwhy\n"
    assert [tuple(s) for s in got[1]["chosen_mask"]] == [(14, 18)] and [tuple(s) for s in got[1]["rejected_mask"]] == [(14, 17)]
    assert got[2]["n_prefix"] == 0 and got[2]["prompt"] == ""
    assert got[3]["n_prefix"] == 2 and got[3]["chosen"] == "" == got[3]["rejected"]
    assert got[4]["n_prefix"] == 1 and got[4]["chosen"] == "" and got[4]["rejected"] == "<|user|>\nq\n"
    none = spark.createDataFrame([], ddl)
    assert chat_format.format_preferences(none, none).count() == 0


def test_swapped_replies(spark):
    rows = [(2, 0, "user", "a"), (2, 1, "assistant", "b"), (2, 2, "assistant", "c"), (3, 0, "assistant", "d"), (4, 0, "assistant", "e"), (5, 0, "user", "f")]
    got = {(r["conv_id"], r["turn"]): r["text"] for r in chat_format.swapped_replies(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got == {(2, 0): "a", (2, 1): "b", (2, 2): "d", (3, 0): "c", (4, 0): "e", (5, 0): "f"}
