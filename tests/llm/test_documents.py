"""The operators on documents against brute force, with awkward rows: NULLs, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from shelfline.llm import best_fit, decontaminate, exact_dedup, jaccard_join, license_scan, suffix_dedup, token_counts, toxicity
from shelfline.llm.common import ROW

DDL = "doc_id long, text string, source string, score string, at int"
WORDS = [f"w{i}" for i in range(400)]


def prose(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) for _ in range(n))


def edited(text: str, seed: int, share: float) -> str:
    rnd = random.Random(seed)
    return " ".join(f"x{rnd.random()}" if rnd.random() < share else w for w in text.split(" "))


def awkward() -> list[tuple]:
    """Rows (doc_id, text, source, score, at): the last two clash with names the operators use."""
    long = prose(1, 4000)
    texts = [None, "", "", " ", "one", "ONE", "a b c d", "A B C D", prose(2, 80), prose(2, 80), prose(2, 80), edited(prose(2, 80), 3, 0.02), edited(prose(2, 80), 4, 0.3)]
    texts += [long, long + " tail", prose(5, 60) + " " + prose(2, 40), "é漢字🙂 " * 30, "aaaa" * 100, "ab" * 200, edited(long, 6, 0.01), "x" * 99, "x" * 100]
    rows = [(i, t, f"s{i % 3}", "clash", i) for i, t in enumerate(texts)]
    return [*rows, rows[8], (8, prose(2, 80), "s2", None, None), (None, prose(2, 80), None, None, None), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "t.parquet")
    spark.createDataFrame(awkward(), DDL).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DDL)


@pytest.fixture(scope="module")
def given(docs):
    """(row id, doc_id, text) as the operators number them."""
    from pyspark.sql import functions as F

    return [tuple(r) for r in docs.select(F.monotonically_increasing_id(), "doc_id", "text").collect()]


def rank(doc_id):
    return (doc_id is not None, doc_id or 0)


# exact dedup


def test_exact_groups(docs, given):
    by_text = defaultdict(list)
    for row, doc, text in given:
        by_text[text or ""].append((rank(doc), row, doc))
    got = {r[ROW]: r for r in exact_dedup.copy_groups(docs).collect()}
    assert len(got) == len(given)
    for text, members in by_text.items():
        keep = max(members)[2]
        assert {got[row]["keep_id"] for _, row, _ in members} == {keep}
        assert {got[row]["group_size"] for _, row, _ in members} == {len(members)}
        kept = [got[row] for _, row, _ in members if got[row]["kept"]]
        assert len(kept) == 1 and kept[0]["doc_id"] == keep
        assert {got[row]["text_sha256"] for _, row, _ in members} == {hashlib.sha256(text.encode()).hexdigest()}


def test_exact_drop_keeps_columns(docs, empty):
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({t or "" for _, t, *_ in awkward()})
    assert exact_dedup.copy_groups(empty).count() == 0


def test_quotient_filters_merge_without_loss(spark):
    rnd = random.Random(1)
    prints = [rnd.choice([-5, 0, 7, rnd.getrandbits(63), -rnd.getrandbits(62)]) for _ in range(3000)]
    frame = spark.createDataFrame([(x,) for x in prints], "fp long").repartition(5)
    got = {tuple(r) for r in exact_dedup.repeated_fingerprints(exact_dedup.quotient_filters(frame, 16), 16).collect()}
    assert got == {(x, prints.count(x)) for x in set(prints) if prints.count(x) > 1}


# suffix arrays


def test_suffix_array_is_sorted():
    rnd = random.Random(3)
    for _ in range(500):
        text = [rnd.randint(1, rnd.choice([1, 2, 3, 5])) for _ in range(rnd.randint(0, 40))] * rnd.choice([1, 1, 3]) + [0]
        assert suffix_dedup.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def repeats(rows):
    """n_bytes, n_removed, n_spans, kept_sha256 of every row by a set of all windows seen."""
    seen, out = set(), {}
    for row, _, text in sorted(rows, key=lambda r: (rank(r[1]), r[0])):
        b = (text or "").encode()
        covered = bytearray(len(b))
        for i in range(len(b) - 99):
            if b[i : i + 100] in seen:
                covered[i : i + 100] = b"\1" * 100
            seen.add(b[i : i + 100])
        spans = len(re.findall(b"\1+", bytes(covered)))
        out[row] = (len(b), sum(covered), spans, hashlib.sha256(bytes(x for x, c in zip(b, covered, strict=True) if not c)).hexdigest())
    return out


@pytest.mark.parametrize("pieces", [20_000, 2])
def test_repeats(docs, given, monkeypatch, pieces):
    monkeypatch.setattr(suffix_dedup, "PIECES", pieces)  # 2: cores with more surroundings go window by window
    got = {r[ROW]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.remove_repeats(docs).collect()}
    assert got == repeats(given)


def test_repeats_in_a_long_text(spark, empty):
    text = prose(11, 150_000) + prose(12, 300) + " between " + prose(12, 300)
    assert len(text) > suffix_dedup.SEGMENT
    frame = spark.createDataFrame([(1, text), (2, prose(11, 50))], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.remove_repeats(frame).collect()}
    want = repeats([(1, 1, text), (2, 2, prose(11, 50))])
    assert got == want and want[1][1] > 1000
    assert suffix_dedup.remove_repeats(empty).count() == 0


# n-gram Jaccard join


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def linked(rows):
    """component id per row by comparing all pairs."""
    sets = [shingles(t) for *_, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                root[top(i)] = top(j)
    ids = defaultdict(list)
    for i, (_, doc, _) in enumerate(rows):
        ids[top(i)].append(doc)
    return {row: (len(sets[i]), min((x for x in ids[top(i)] if x is not None), default=None)) for i, (row, _, _) in enumerate(rows)}


def found(frame):
    return {r[ROW]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.linked_components(frame).collect()}


def test_components(docs, given, empty):
    assert found(docs) == linked(given)
    assert jaccard_join.linked_components(empty).count() == 0
    assert jaccard_join.drop_near_copies(docs).columns == docs.columns


def test_one_row_of_each_component_stays(spark, tmp_path):
    """Components are told apart by themselves, not by a doc_id that repeats or is NULL."""
    a, b, c = prose(500, 80), prose(501, 80), prose(502, 80)
    near = lambda t: f"{t} tail"
    rows = [(1, a), (2, near(a)), (1, b), (3, near(b)), (None, c), (None, near(c)), (None, c), (4, ""), (4, None), (None, "")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "t"))
    kept = [tuple(r) for r in jaccard_join.drop_near_copies(spark.read.parquet(str(tmp_path / "t"))).collect()]
    assert sorted(map(str, kept)) == sorted(map(str, [(1, a), (1, b), (None, c), (4, ""), (4, None), (None, "")]))


@pytest.mark.parametrize("region", [2000, 7])
def test_chains_of_near_copies(spark, tmp_path, monkeypatch, region):
    """Groups at every distance around the threshold; 7: regions are dealt out in blocks."""
    monkeypatch.setattr(jaccard_join, "REGION", region)
    rnd, rows = random.Random(5), []
    for g in range(4):
        text = prose(100 + g, 90)
        for _ in range(25):
            rows.append((len(rows), text))
            text = edited(text if rnd.random() < 0.6 else rows[rnd.randrange(g * 25, len(rows))][1], rnd.random(), rnd.choice([0.005, 0.01, 0.02, 0.03]))
    rnd.shuffle(rows)
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "t"))
    frame = spark.read.parquet(str(tmp_path / "t"))
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.linked_components(frame).collect()}
    want = linked([(i, i, t) for i, t in rows])
    assert got == {i: c for i, (_, c) in want.items()}
    assert 4 < len(set(got.values())) < 100


@pytest.mark.parametrize("region", [2000, 7])
def test_region_whose_pivot_has_left(spark, tmp_path, monkeypatch, region):
    """A long text has the least key and shares a passage with short near copies, too little of it to stay in the region."""
    import numpy as np

    monkeypatch.setattr(jaccard_join, "REGION", region)
    passage = prose(300, 60)
    key = lambda t: jaccard_join.set_key(next(jaccard_join.shingle_sets(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))))
    short = [f"{passage} tail{i}" for i in range(20)]
    long = next(t for t in (f"{passage} {prose(400 + i, 3000)}" for i in range(1000)) if key(t) < min(map(key, short)))
    rows = [*enumerate(short), (100, long)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "t"))
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.linked_components(spark.read.parquet(str(tmp_path / "t"))).collect()}
    assert got == {**dict.fromkeys(range(20), 0), 100: 100}


def test_linked_sets_share_prefixes():
    rnd = random.Random(8)
    for _ in range(2000):
        n = rnd.randint(1, 60)
        a = set(rnd.sample(range(1000), n))
        b = {x for x in a if rnd.random() > 0.12} | {rnd.randrange(1000) for _ in range(rnd.randint(0, n // 8))}
        if b and 100 * len(a & b) >= 80 * len(a | b):
            cut = lambda s: set(sorted(s)[: jaccard_join.prefix_length(len(s))])
            assert len(cut(a) & cut(b)) >= max(1, len(a) // 10, len(b) // 10)


# token counts


def test_token_counts(docs, given, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path(token_counts.TOKENIZER))
    want = sorted(((d is not None, d or 0), len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for _, d, t in given)
    got = sorted((rank(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in token_counts.count_tokens(docs).collect())
    assert got == want
    assert token_counts.count_tokens(empty).count() == 0
    assert all(r["over_limit"] == (r["n_tokens"] > 20) for r in token_counts.count_tokens(docs, limit=20).collect())


def test_token_counts_of_odd_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    rnd = random.Random(1)
    letters = "ab aaa  \n\t'sll12é漢字🙂  \x1c\x85<|endoftext|>-_=.,"
    texts = ["", "<|endoftext|>", "a<|endoftext|> b<|endoftext|>", " " * 100, "a" * 1000, "\n\n  x", *("".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(500))]
    library = Tokenizer.from_file(public_tokenizers.path(token_counts.TOKENIZER))
    want = [len(x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]
    known = token_counts.merges(token_counts.TOKENIZER)
    assert known.counted(texts) == want
    low = [i for i, t in enumerate(texts) if all(ord(c) < 0x240 for c in t)]
    assert known.counted([texts[i] for i in low], True) == [want[i] for i in low]


# license scan


def test_license_places(spark, docs, empty):
    rows = [
        (1, "Under the MIT license. under the mit license"), (2, "Apache License, Version 2.0; cc-by-nc 4.0"), (3, "mit license under the"), (4, None),
        (5, "This is licensed under the GNU General Public License, version 3."), (6, "Permission is hereby granted, free of charge, to every person obtaining a copy of this software and its associated documentation files"),
    ]
    got = {r["doc_id"]: r for r in license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1]["n_base"], got[1]["first_word"], got[1]["last_word"], got[1]["base_labels"]) == (2, 0, 4, "mit")
    assert (got[2]["n_base"], got[2]["base_labels"], got[2]["first_word"], got[2]["last_word"]) == (2, "apache-2,cc-by-nc", 0, 5)
    assert (got[3]["n_base"], got[3]["labels"], got[3]["score"], got[3]["first_word"]) == (0, "", 0.0, None)
    assert (got[4]["n_words"], got[4]["n_base"]) == (0, 0)
    assert (got[5]["base_labels"], got[5]["labels"]) == ("", "gpl-3")
    assert got[6]["labels"] == "mit" and 0.7 <= got[6]["score"] < 1
    assert license_scan.scan_licenses(docs).count() == len(awkward())
    assert license_scan.scan_licenses(empty).count() == 0


# decontamination


def alignment(item, passage):
    above, best = [0] * (len(passage) + 1), 0
    for x in item:
        now = [0]
        for j, y in enumerate(passage):
            now.append(max(0, above[j] + (decontaminate.MATCH if x == y else decontaminate.MISMATCH), above[j + 1] - decontaminate.GAP, now[j] - decontaminate.GAP))
        above, best = now, max(best, *now)
    return best


def test_alignment_equals_the_table():
    import numpy as np

    rnd = random.Random(2)
    pairs = [([rnd.randint(1, 4) for _ in range(rnd.randint(1, 12))], [rnd.randint(1, 4) for _ in range(rnd.randint(1, 30))]) for _ in range(300)]
    best, _ = decontaminate.aligned([np.array(a, np.uint64) for a, _ in pairs], [np.array(b, np.uint64) for _, b in pairs])
    assert best.tolist() == [alignment(a, b) for a, b in pairs]


def test_contamination(spark, docs, empty):
    items = [(1, prose(50, 30)), (2, prose(51, 12)), (3, None), (4, "two words"), (5, prose(50, 30))]
    texts = [prose(60, 200), f"{prose(61, 90)} {prose(50, 30).upper()} {prose(62, 90)}", f"{prose(63, 20)} {edited(prose(50, 30), 1, 0.15)}", prose(51, 12), "two words", None]
    frame = spark.createDataFrame([(i, t, "a") for i, t in enumerate(texts)], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.contaminated(frame, bench).collect()}
    assert set(got) == {(1, 1), (1, 5), (2, 1), (2, 5), (3, 2)}
    assert got[1, 1]["score"] == 1.0 and got[1, 1]["end_word"] == 120 and 0.5 <= got[2, 1]["score"] < 1
    assert [r["doc_id"] for r in decontaminate.drop_contaminated(frame, bench).orderBy("doc_id").collect()] == [0, 4, 5]
    assert decontaminate.contaminated(empty, bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0


def test_copies_with_common_seeds(spark):
    """Short items edited by changing, adding and leaving out words, their 3-grams common, against alignment with the whole text."""
    rnd = random.Random(12)
    items = {i: [f"i{i}w{j}" for j in range(20)] for i in range(8)}
    texts = []
    for i, item in items.items():
        texts += [" ".join(item[j : j + 3]) + f" f{rnd.random()}" for j in (range(0, 20, 4) if i % 2 else range(0, 16, 4)) for _ in range(40)]
        edits = [[f"x{i}y{j}" if j % 4 == 3 else w for j, w in enumerate(item)]]
        for _ in range(40):
            share = rnd.uniform(0.1, 0.4)
            copy = []
            for w in item:
                copy += rnd.choice([[f"n{rnd.random()}"], [w, f"n{rnd.random()}"], []]) if rnd.random() < share else [w]
            edits.append(copy)
        noise = lambda: [f"z{rnd.randrange(10**9)}" for _ in range(rnd.randint(0, 60))]
        texts += [" ".join([*noise(), *copy, *noise()]) for copy in edits]
    split = lambda t: re.findall("[a-z0-9]+", t)
    want = {}
    for n, text in enumerate(texts):
        words = split(text)
        grams = {tuple(words[a : a + 3]) for a in range(len(words) - 2)}
        for i, item in items.items():
            share = alignment(item, words) / (2 * len(item)) if set(item) & set(words) else 0
            if share >= decontaminate.COPY and any(tuple(item[a : a + 3]) in grams for a in range(18)):
                want[n, i] = share
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.contaminated(frame, bench).collect()}
    assert {k: r["score"] for k, r in got.items()} == want and len(want) > 200
    for (n, i), r in got.items():
        assert alignment(items[i], split(texts[n])[r["first_word"] : r["end_word"]]) == want[n, i] * 40


# toxicity


def best_segments(values):
    """All maximal segments by their definition: the best segment, then the same to its left and right."""
    best = max(((sum(values[i:j]), -(j - i), i, j) for i in range(len(values)) for j in range(i + 1, len(values) + 1)), default=(0, 0, 0, 0))
    if best[0] <= 1e-12:
        return []
    *_, i, j = best
    return best_segments(values[:i]) + [(i, j)] + [(a + j, b + j) for a, b in best_segments(values[j:])]


def test_segments_are_all_maximal():
    rnd = random.Random(4)
    for _ in range(200):
        weights = {f"t{i}": rnd.uniform(-2, 3) for i in range(6)}
        model = toxicity.Model(weights, -rnd.uniform(0.1, 1))
        tokens = [rnd.choice([*weights, "other"]) for _ in range(rnd.randint(0, 25))]
        n, found = model.segments(" ".join(tokens))
        assert n == len(tokens)
        assert [(a, b) for a, b, _ in found] == best_segments([weights.get(t, model.other) for t in tokens])


def test_segments_of_very_long_texts_take_linear_time():
    """Rising sums that never merge, and one listed token among many others, keep every segment; 10^6 tokens take seconds."""
    model = toxicity.Model({"bad": 1.0, "good": -0.9}, -0.02)

    def seconds(text):
        began = time.perf_counter()
        n, found = model.segments(text)
        assert n == len(text.split()) and found
        return time.perf_counter() - began

    for phrase in ("bad good ", "bad " + "word " * 60, "bad good good "):
        repeats = 500_000 // len(phrase.split())
        short = min(seconds(phrase * repeats) for _ in range(2))
        assert seconds(phrase * repeats * 2) < 4 * short + 0.5 and short < 10


def test_evidence_follows_the_extreme_value_distribution():
    model = toxicity.Model({"bad": 1.0}, k=0.5)
    for n, s in ((10, 4.0), (1000, 9.0), (50, 3.0)):
        assert math.isclose(model.evidence(n, [s]), -math.log(1 - math.exp(-0.5 * n * math.exp(-s))), rel_tol=1e-9)
    assert model.evidence(0, []) == 0.0 and model.evidence(100, [8.0, 7.0]) > model.evidence(100, [8.0]) > model.evidence(10_000, [8.0])
    top, n, clean = np.array([1.0, 2.0, 9.0]), np.array([10, 20, 30]), np.array([True, True, False])
    assert math.isclose(toxicity.extreme_value_rate(n, top, clean), 2 / (10 * math.exp(-1) + 20 * math.exp(-2)))
    evidence, label = np.array([0.0] * 50 + [20.0] * 50), np.array([0.0] * 49 + [1.0] * 51)
    bias, slope = toxicity.logistic(evidence, label)
    assert slope > 0 and 1 / (1 + math.exp(-bias)) < 0.1 < 0.9 < 1 / (1 + math.exp(-bias - slope * math.log1p(20)))


def test_toxicity_finds_held_out_texts(spark, docs, empty):
    rnd = random.Random(6)
    rows, labels = [], []
    for i in range(900):
        bad = rnd.random() < 0.2
        words = prose(1000 + i, 60).split()
        for _ in range(4 if bad else 0):
            words.insert(rnd.randrange(60), rnd.choice(["vile", "nasty", "rotten"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    frame, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([*labels, (5000, 1), (None, 1), (7, None)], "doc_id long, toxic int")
    model = toxicity.fit(frame, marks)
    scored = toxicity.score_texts(frame.withColumn("held", toxicity.remainder() == 1), model).collect()
    truth = dict(labels)
    assert all(r["predicted"] == truth[r["doc_id"]] for r in scored if r["held"])
    assert all(0 <= r["score"] <= 1 and (r["predicted"] == 1) == (r["score"] >= 0.7) for r in scored)
    assert any(r["passages"] for r in scored)
    assert toxicity.score_texts(docs, model).count() == len(awkward())
    assert toxicity.score_texts(empty, model).count() == 0
    assert {r["score"] for r in toxicity.score_texts(docs, toxicity.fit(frame, marks.limit(0))).collect()} == {0.5}


# packing


def test_packing(docs, empty):
    rows = best_fit.pack(docs, capacity=512).collect()
    texts = {r: t for r, _, t in [(x[0], x[1], x[2]) for x in given_rows(docs)]}
    whole, bins = defaultdict(int), defaultdict(list)
    for r in rows:
        whole[r[ROW]] += r["length"]
        bins[r["shard"], r["bin"]].append(r)
    assert whole == {r: len((t or "").encode()) for r, t in texts.items()}
    sources = {r[0]: r[3] for r in given_rows(docs)}
    for held in bins.values():
        assert sum(r["length"] for r in held) <= 512
        named = [sources[r[ROW]] for r in held if sources[r[ROW]] is not None]
        assert len(named) == len(set(named))
        assert len({texts[r[ROW]] or "" for r in held}) == len(held)
        at = 0
        for r in sorted(held, key=lambda r: (r["place"], r["length"])):
            assert r["place"] == at
            at += r["length"]
    assert best_fit.pack(empty).count() == 0


def given_rows(frame):
    from pyspark.sql import functions as F

    return [tuple(r) for r in frame.select(F.monotonically_increasing_id(), "doc_id", "text", "source").collect()]


def test_tightest_compatible_bin():
    rnd = random.Random(9)
    bins, plain = best_fit.Bins(100), []
    for _ in range(400):
        length, source, cluster = rnd.randint(0, 60), 1 << rnd.randrange(5), 1 << rnd.randrange(30)
        fits = [(100 - used - length, i) for i, (used, s, c) in enumerate(plain) if used + length <= 100 and used < 100 and not s & source and not c & cluster]
        b, place = bins.put(length, source, cluster)
        if fits:
            assert (100 - plain[b][0] - length, b) == min(fits)
        else:
            assert b == len(plain)
            plain.append((0, 0, 0))
        assert place == plain[b][0]
        plain[b] = (plain[b][0] + length, plain[b][1] | source, plain[b][2] | cluster)


# pipeline


def test_pipeline_stages(spark, tmp_path):
    rows = [(i, prose(2000 + i, 60)) for i in range(60)]
    rows += [(100, rows[3][1]), (101, edited(rows[4][1], 1, 0.01)), (102, f"{prose(70, 20)} {prose(71, 25)}")]
    rows += [(200 + i, prose(3000 + i, 40) + " vile nasty vile") for i in range(60)]
    frame = spark.createDataFrame([(i, t, "en", f"s{i % 4}", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    folder = str(tmp_path)
    frame.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i >= 200)) for i, _ in rows if i != 100], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, prose(71, 25))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    kept, seen = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, kept, folder)
        if name != "best_fit_packing":
            assert out.columns == kept.columns
        out.write.parquet(f"{folder}/{name}")
        kept = spark.read.parquet(f"{folder}/{name}")
        seen.append({r["doc_id"] for r in kept.select("doc_id").collect()})
    clean = {i for i, _ in rows if i < 200}
    assert seen[0] == clean
    assert seen[1] == clean - {3}
    assert seen[2] == clean - {3, 101}
    assert seen[3] == clean - {3, 101, 102} == seen[4]
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect()} == seen[4]


CLASHING = ["score", "predicted", "passages", "fp", "key", "root", "component_id", "kept", "item_id", "seeds"]


def edge_corpus(spark, folder: str, rows: list[tuple], labels: list[tuple], items: list[tuple]):
    """The pipeline's tables from (doc_id, text) rows; documents carry columns named like those the operators make."""
    ddl = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
    full = [(i, t, "en", None if n % 5 == 0 else f"s{n % 4}", len(t or ""), *(f"{c}{i}" for c in CLASHING)) for n, (i, t) in enumerate(rows)]
    spark.createDataFrame(full, ddl).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def stage_tables(spark, folder: str) -> dict[str, Counter]:
    """The rows (doc_id, text) that each stage leaves; the columns of documents have to come through it unchanged."""
    kept, seen = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, kept, folder)
        out.write.parquet(f"{folder}/{name}")
        if name == "best_fit_packing":
            seen[name] = Counter((r["doc_id"], r["length"]) for r in spark.read.parquet(f"{folder}/{name}").collect())
            break
        assert out.schema == kept.schema
        kept = spark.read.parquet(f"{folder}/{name}")
        found = kept.collect()
        assert all(r[c] == f"{c}{r['doc_id']}" for r in found for c in CLASHING)
        seen[name] = Counter((r["doc_id"], r["text"]) for r in found)
    return seen


def test_pipeline_edge_rows(spark, tmp_path):
    """NULL ids and texts, empty texts, repeated rows and clashing columns pass all stages with the results their docstrings state."""
    folder = str(tmp_path)
    clean = [(i, prose(4000 + i, 60)) for i in range(60)]
    toxic = [(200 + i, prose(5000 + i, 40) + " vile nasty vile") for i in range(60)]
    nameless, twice, item = prose(6000, 50), prose(6001, 50), prose(6002, 25)
    near = edited(nameless, 7, 0.01) + " end"
    odd = [(None, nameless), (None, twice), (None, twice), (50, clean[50][1]), (51, clean[50][1]), (90, None), (91, ""), (92, None), (None, None)]
    odd += [(None, near), (93, f"{prose(6003, 20)} {item}"), (None, f"{item} {prose(6004, 20)}"), (94, "...")]
    labels = [(i, 1, int(i >= 200)) for i, _ in [*clean, *toxic]] + [(3, 1, 0), (90, 1, None), (None, 1, 1), (91, None, 0), (999, 1, 1)]
    edge_corpus(spark, folder, [*clean, *toxic, *odd], labels, [(1, item), (1, item), (2, None), (3, ""), (None, "two words")])
    seen = stage_tables(spark, folder)

    assert seen["toxicity"] == Counter([*clean, *odd])
    unequal = {(i, t) for i, t in clean if i != 50} | {(51, clean[50][1]), (94, "..."), (None, nameless), (None, near), (None, twice), odd[10], odd[11]}
    exact = seen["exact_dedup"]
    assert set(exact.values()) == {1} and {x for x in exact if x[1]} == unequal
    assert [i for i, t in exact if not t] == [92]
    left = set(seen["ngram_jaccard_join"])
    assert len(left & {(None, nameless), (None, near)}) == 1
    assert left | {(None, nameless), (None, near)} == set(exact)
    assert set(seen["benchmark_decontamination"]) == left - {odd[10], odd[11]}
    assert seen["best_fit_packing"] == Counter((i, len(t or "")) for i, t in left - {odd[10], odd[11]})


def test_pipeline_empty_tables(spark, tmp_path):
    """Without documents every stage is empty; without labels and items nothing goes for their sake."""
    (tmp_path / "none").mkdir()
    edge_corpus(spark, f"{tmp_path}/none", [], [], [])
    assert all(not rows for rows in stage_tables(spark, f"{tmp_path}/none").values())
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
    (tmp_path / "some").mkdir()
    rows = [(i, prose(7000 + i, 40) + " vile") for i in range(8)]
    edge_corpus(spark, f"{tmp_path}/some", rows, [], [])
    assert all(found == Counter(rows) for name, found in stage_tables(spark, f"{tmp_path}/some").items() if name != "best_fit_packing")
