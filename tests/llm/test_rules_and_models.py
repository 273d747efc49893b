import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiform.llm import pairwise_rank, quality_rules, text_stats, toxicity

TEXTS = [
    None,
    "",
    " \n\t ",
    "one two three",
    "a b c d e f g h i j a b c d e f g h i j tail",
    "same line\nsame line\n\nother\nsame line",
    "% <|> ## word & * $",
    "x\x0by\x0cz\rw\x1cv u",
    "é ß 漢字 " * 30,
    "spam " * 5000,
    "one two three",
]


def counted(text):
    """The contract's counts, word by word."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            inside.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    repeated = sum(x in lines[:i] for i, x in enumerate(lines))
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, repeated, len(inside)


def documents(spark, texts, **extra):
    rows = spark.createDataFrame(
        [(i, t, "en" if i % 3 else None) for i, t in enumerate(texts)],
        "doc_id bigint, text string, lang string",
    )
    for name, value in extra.items():
        rows = rows.withColumn(name, F.lit(value))
    return rows


def test_counts_match_the_definition(spark):
    found = text_stats.measure(documents(spark, TEXTS, n_words="clash", key=1, _text="x"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    by_id = {r["doc_id"]: tuple(r[n] for n in names) for r in found.collect()}
    assert by_id == {i: counted(t) for i, t in enumerate(TEXTS)}


def test_binomial_tail_and_bound():
    for n, p in ((1, 0.3), (12, 0.05), (200, 0.02)):
        for k in range(0, n + 1, max(1, n // 9)):
            exact = sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1))
            assert quality_rules.at_most(k, n, p) == pytest.approx(exact, rel=1e-9)
    bound = quality_rules.upper_bound(3, 500, 0.01)
    assert quality_rules.at_most(3, 500, bound) == pytest.approx(0.01, rel=1e-6)
    assert quality_rules.upper_bound(0, 0, 0.1) == 1.0


def test_rules_reject_junk_and_respect_the_risk(spark):
    good = [" ".join(f"word{i} and{j} more{j}" for j in range(9)) for i in range(700)]
    noisy = [t.replace(" and", " #") for t in good[:40]]  # good documents with symbols
    junk = [" ".join(f"x{j}%%% y{j}***" for j in range(20)) for _ in range(30)]
    texts = good + noisy + junk + [None, ""]
    docs = documents(spark, texts).withColumn("lang", F.lit("en"))
    marked = [(i, 1 if i < 740 else 0) for i in range(770)] + [(5, None), (None, 1)]
    labels = spark.createDataFrame(marked, "doc_id bigint, quality int")
    made = quality_rules.judge(docs, labels)
    kept = {r["doc_id"]: r["kept"] for r in made.collect()}
    assert len(kept) == len(texts)
    assert all(kept[i] for i in range(700))
    assert not any(kept[i] for i in range(740, 772))


def test_risk_alone_ends_the_ladders(spark):
    """Junk with few repetitions is rejected where no good document has any."""
    good = [" ".join(f"word{i} and{j} more{j}" for j in range(9)) for i in range(900)]
    lines = [" ".join(f"line{i}x{j}x{k}" for k in range(8)) for i in range(1) for j in range(10)]
    half = "\n".join(lines + lines[:1] * 5)  # 5 of 15 lines repeat
    words = [f"v{j}" for j in range(90)]
    again = " ".join(words[:8] + words + ["end"])  # 16 of 99 words
    docs = documents(spark, good + [half, again]).withColumn("lang", F.lit("en"))
    labels = spark.createDataFrame([(i, 1) for i in range(900)], "doc_id bigint, quality int")
    made = {r["doc_id"]: r for r in quality_rules.judge(docs, labels).collect()}
    assert all(made[i]["kept"] for i in range(900))
    assert "dup_lines" in made[900]["violated"]
    assert made[901]["violated"] == ["repeats"] and not made[901]["base_failed"]


def test_rules_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    made = quality_rules.judge(documents(spark, TEXTS), none).collect()
    assert {r["kept"] for r in made if not r["base_failed"]} <= {True}
    assert quality_rules.judge(documents(spark, []), none).count() == 0


def quality_data(spark, n=240):
    texts = [
        f"Good plain sentence number {i}, with some words. And another one follows here."
        if i % 3
        else f"a{i}%%% b### " * 12
        for i in range(n)
    ]
    docs = documents(spark, texts + [None, ""], score="clash", label=9)
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(n)], "doc_id bigint, quality int")
    return docs, labels, n


def test_rank_separates_held_out_documents(spark):
    docs, labels, n = quality_data(spark)
    made = {r["doc_id"]: r for r in pairwise_rank.rank(docs, labels).collect()}
    assert len(made) == n + 2
    assert {r["held_out"] for r in made.values()} == {True, False}
    assert all(r["predicted"] == int(i % 3 > 0) for i, r in made.items() if i < n)
    assert all(0 <= r["score"] <= 1 for r in made.values())


def test_rank_ignores_held_out_labels(spark):
    docs, labels, _ = quality_data(spark, 60)
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    flipped = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    one = pairwise_rank.rank(docs, labels).orderBy("doc_id").collect()
    assert one == pairwise_rank.rank(docs, flipped).orderBy("doc_id").collect()


def test_rank_without_a_class(spark):
    docs, labels, _ = quality_data(spark, 12)
    only = pairwise_rank.rank(docs, labels.filter("quality = 1"))
    assert {r["score"] for r in only.collect()} == {1.0}
    assert {r["score"] for r in pairwise_rank.rank(docs, labels.limit(0)).collect()} == {0.5}
    assert pairwise_rank.rank(docs.limit(0), labels).count() == 0


def test_rank_threshold_is_a_quantile_of_all_labels(spark, monkeypatch):
    """A smaller sample of unbalanced classes that overlap leaves the share below the threshold."""
    rng = np.random.default_rng(3)
    texts = [
        " ".join(f"w{rng.integers(900)}" + "%" * int(rng.random() < level) for _ in range(40))
        for level in (rng.normal(0.5 if i % 10 == 0 else 0.3, 0.1) for i in range(600))
    ]
    docs = documents(spark, texts)
    labels = spark.createDataFrame(
        [(i, int(i % 10 > 0)) for i in range(600)], "doc_id bigint, quality int"
    )
    monkeypatch.setattr(pairwise_rank, "MAX_LABELLED", 40)
    monkeypatch.setattr(pairwise_rank, "HELD", 5, raising=False)
    made = pairwise_rank.rank(docs, labels).filter("NOT held_out").collect()
    bad = sum(r["doc_id"] % 10 == 0 for r in made)
    assert sum(r["predicted"] == 0 for r in made) == bad


def test_between_takes_the_middle_of_two_positions(spark, monkeypatch):
    monkeypatch.setattr(pairwise_rank, "HELD", 3)
    monkeypatch.setattr(pairwise_rank, "BINS", 4)
    values = [0.5, 0.5, 0.5, 0.5, -2.0, 1.0, 7.0, 7.5, 7.25, 900.0, 0.0]
    scores = spark.createDataFrame([(v,) for v in values], "raw double")
    order = sorted(values)
    for rank in range(1, len(order)):
        assert pairwise_rank.between(scores, rank) == (order[rank - 1] + order[rank]) / 2
    assert pairwise_rank.between(scores, len(order)) == 900.0


def test_bradley_terry_weights_are_the_minimum():
    rng = np.random.default_rng(0)
    rows = rng.normal(size=(200, 3)) + [1.0, 0.0, -0.5]
    w = pairwise_rank.logistic(rows, np.ones(200), 0.01)
    p = 1 / (1 + np.exp(rows @ w))
    assert np.abs(-(rows * p[:, None]).mean(0) + 0.01 * w).max() < 1e-8


def toxic_data(spark, n=400):
    rng = np.random.default_rng(1)
    plain = [f"w{i}" for i in range(60)]
    bad = ["scum", "trash", "vermin"]
    texts, toxic = [], []
    for i in range(n):
        words = list(rng.choice(plain, 60))
        if i % 4 == 0:
            for place in rng.integers(0, 60, 3):
                words[place] = str(rng.choice(bad)) + "!"
        texts.append(" ".join(words))
        toxic.append(int(i % 4 == 0))
    docs = documents(spark, texts + [None, ""], toxic=3, n="clash", pair=1)
    labels = spark.createDataFrame(list(enumerate(toxic)), "doc_id bigint, toxic int")
    return docs, labels, toxic


def test_toxicity_of_held_out_documents(spark):
    docs, labels, toxic = toxic_data(spark)
    made = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, labels).collect()}
    assert len(made) == len(toxic) + 2
    held = [i for i in range(len(toxic)) if made[i]["held_out"]]
    right = [made[i]["predicted"] == toxic[i] for i in held]
    assert np.mean(right) > 0.95
    assert made[len(toxic)]["mean_ratio"] == made[len(toxic) + 1]["mean_ratio"] == 0


def test_toxicity_without_a_class(spark):
    docs, labels, _ = toxic_data(spark, 20)
    assert {r["score"] for r in toxicity.score_toxicity(docs, labels.limit(0)).collect()} == {0.0}
    only = toxicity.score_toxicity(docs, labels.filter("toxic = 1"))
    assert {r["predicted"] for r in only.collect()} == {1}
    assert toxicity.score_toxicity(docs.limit(0), labels).count() == 0


def test_toxicity_of_a_shard_of_the_labelled_corpus(spark, monkeypatch):
    """Labels of documents elsewhere and copies take no places of the sample."""
    docs, labels, toxic = toxic_data(spark)
    monkeypatch.setattr(toxicity, "SAMPLE", 400)
    alone = toxicity.score_toxicity(docs, labels).orderBy("doc_id").collect()
    others = spark.range(10_000, 60_000).selectExpr("id AS doc_id", "int(id % 2) AS toxic")
    copies = docs.filter("doc_id = 0").crossJoin(spark.range(500).withColumnRenamed("id", "i"))
    copies = copies.withColumn("doc_id", F.col("i") + 5_000).drop("i")
    marked = copies.selectExpr("doc_id", "1 AS toxic")
    made = toxicity.score_toxicity(
        docs.unionByName(copies), labels.unionByName(others).unionByName(marked)
    )
    made = {r["doc_id"]: r for r in made.collect()}
    right = [made[i]["predicted"] == toxic[i] for i in range(len(toxic))]
    assert np.mean(right) > 0.95
    plain = [r["score"] for r in alone if r["doc_id"] in (1, 2, 3, 5)]
    assert np.allclose([made[i]["score"] for i in (1, 2, 3, 5)], plain, atol=0.1)
    # Not one labelled document is here: no label counts.
    far = toxicity.score_toxicity(docs, others)
    assert {(r["score"], r["predicted"]) for r in far.collect()} == {(0.0, 0)}


def test_toxicity_keeps_every_word_and_pair_of_the_samples(spark):
    rows = [(f"w{i} rare{i}", i % 2, False) for i in range(50)]
    sample = spark.createDataFrame(rows, "text string, toxic int, apart boolean")
    words = spark.sparkContext.broadcast(toxicity._vocabulary(sample))
    assert len(toxicity.numbers_of(words.value)) == 100
    assert [len(toxicity._class_counts(sample, words, 102, c).pairs) for c in (0, 1)] == [50, 50]


def test_surroundings_count_words_without_a_number(spark):
    docs = documents(spark, ["x a", "y a", "x z", "a z"])
    words = spark.sparkContext.broadcast(b"a")
    # a: x, y, start; of the others x: start, y: start, z: x, a
    found = toxicity.surroundings(docs, words, np.zeros(3), "text")
    assert found.tolist() == [4, 3, 3]


def test_surroundings_count_different_words_in_front(spark):
    docs = documents(spark, ["a b", "c b a b", "a b", None, "b"])
    words = spark.sparkContext.broadcast(b"a\nb\nc")
    for contexts in (np.zeros(5), np.array([0, 0, 1.0, 500.0, 2.0])):  # spread over parts or not
        found = toxicity.surroundings(docs, words, contexts, "text")
        assert found[2:].tolist() == [2, 3, 1]  # a: start, b; b: a, c, start; c: start


def test_packed_pairs_come_back():
    rng = np.random.default_rng(8)
    for n in (1, 2, 500):
        word = rng.integers(2, 9, n) + np.where(rng.random(n) < 0.4, toxicity.HASHED, 0)
        before = rng.integers(0, 1 << 62, n) + np.where(rng.random(n) < 0.3, toxicity.HASHED, 0)
        order = np.lexsort((before, word))
        word, before = word[order], before[order]
        made = toxicity.unpacked(toxicity.packed(before, word), n)
        assert (made == np.stack([before, word])).all()


def kneser_ney(counted, corpus):
    """Log-likelihoods of a class by the formulas, from its own texts and those of the corpus."""
    words = {w for t in counted[0] + counted[1] for w in t.split()}
    around = {w: {b for t in corpus for b, x in zip(["^", *t.split()], t.split()) if x == w}
              for w in {x for t in corpus for x in t.split()}}
    unknown = [w for w in around if w not in words]
    shared = {w: len(around.get(w, ())) + 0.5 for w in words}
    others = sum(len(around[w]) for w in unknown) + 0.5 * max(len(unknown), 1)
    total = sum(shared.values()) + others

    def model(texts):
        pairs = Counter(p for t in texts for p in zip(["^", *t.split()], t.split()))
        contexts = Counter(w for _, w in pairs)
        after, kinds = Counter(), Counter()
        for (b, _), n in pairs.items():
            after[b] += n
            kinds[b] += 1
        all_contexts = sum(contexts.values())
        left = 0.75 * len(contexts) / all_contexts

        def word(w):
            return max(contexts[w] - 0.75, 0) / all_contexts + left * shared[w] / total

        def pair(b, w):
            backoff = 0.75 * kinds[b] / after[b] if after[b] else 1.0
            return max(pairs[b, w] - 0.75, 0) / max(after[b], 1) + backoff * word(w)

        return word, pair, contexts, kinds, after, pairs

    return words, [model(texts) for texts in counted]


def test_ratios_equal_the_formulas(spark):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(12)]
    toxic = [" ".join(rng.choices(vocabulary[:8], k=rng.randrange(1, 9))) for _ in range(20)]
    plain = [" ".join(rng.choices(vocabulary[4:], k=rng.randrange(1, 9))) for _ in range(30)]
    corpus = toxic + plain + [" ".join(rng.choices(vocabulary + ["new", "other"], k=6)) for _ in range(40)]
    sample = spark.createDataFrame(
        [(t, 1, False) for t in toxic] + [(t, 0, False) for t in plain],
        "text string, toxic int, apart boolean",
    )
    blob = toxicity._vocabulary(sample)
    words = spark.sparkContext.broadcast(blob)
    size = blob.count(b"\n") + 3
    classes = [toxicity._class_counts(sample, words, size, c) for c in (1, 0)]
    around = toxicity.surroundings(
        documents(spark, corpus), words, classes[0].contexts + classes[1].contexts, "text"
    )
    model = toxicity.KneserNey.of(*classes, around)
    known, (bad, good) = kneser_ney((toxic, plain), corpus)

    def ratio(b, w):
        """A position's ratio, damped by how often the samples have seen what it rests on."""
        logs = lambda m: 0.0 if w not in known else math.log(m[0](w))
        off = [math.log(0.75 * m[3][b] / m[4][b]) if m[4][b] else 0.0 for m in (bad, good)]
        kinds, contexts = bad[3][b] + good[3][b], bad[2][w] + good[2][w]
        smooth = (off[0] - off[1]) * kinds / (kinds + 5)
        smooth += (logs(bad) - logs(good)) * contexts / (contexts + 5)
        seen = bad[5][b, w] + good[5][b, w]
        if not seen:
            return smooth
        exact = math.log(bad[1](b, w)) - math.log(good[1](b, w))
        return smooth + (exact - smooth) * seen / (seen + 200)

    texts = [*corpus, "new w3", "w1"]
    means, peaks, _ = model.compare(texts, toxicity.numbers_of(blob))
    for text, mean, peak in zip(texts, means, peaks):
        split = text.split()
        values = [ratio(b, w) for b, w in zip(["^", *split], split)]
        assert mean == pytest.approx(np.mean(values), abs=1e-5)
        assert peak == pytest.approx(max(values), abs=1e-5)


def test_windows_stay_inside_a_text():
    model = toxicity.KneserNey(
        np.zeros(0, np.int64), np.zeros(0), np.zeros(3), np.array([0.0, 0.0, 4.0])
    )
    mean, peak, window = model.compare(["x", "", "a x a", "x x x x"], {"x": 2})
    assert mean.tolist() == [4.0, 0.0, 4 / 3, 4.0]
    assert peak.tolist() == [4.0, 0.0, 4.0, 4.0]
    assert window.tolist() == [4 / 3, 0.0, 4 / 3, 4.0]
