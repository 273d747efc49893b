import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexiform.llm import components, metric_join, order_minhash


def united(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("kind", ["path", "star", "random", "none"])
def test_components(spark, kind):
    rng = random.Random(3)
    links = {
        "path": [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)],
        "star": [(0, i) for i in range(1, 60)] + [(None, 5)],
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(200)],
        "none": [],
    }[kind]
    rng.shuffle(links)
    df = spark.createDataFrame(links, "a bigint, b bigint")
    made = {r["node"]: r["component"] for r in components.components(df).collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    assert made == united({n for link in real for n in link}, real)


def vectors(spark, rows):
    return spark.createDataFrame(
        rows, "vec_id bigint, embedding array<float>, label int, rep bigint, cell string"
    )


def brute(rows, threshold):
    usable = {}
    for i, (key, v, label, *_) in enumerate(rows):
        if key is None or label is None or v is None or not v or any(x is None for x in v):
            continue
        a = np.array(v, np.float32).astype(float)
        if np.isfinite(a).all() and a.any():
            usable[i] = (label, a / np.linalg.norm(a))
    links = [
        (i, j)
        for i, (x, a) in usable.items()
        for j, (y, b) in usable.items()
        if i != j and x == y and len(a) == len(b) and a @ b >= threshold
    ]
    keys = {i: r[0] for i, r in enumerate(rows)}
    groups = united({k for k in keys.values() if k is not None}, [(keys[i], keys[j]) for i, j in links])
    counts = np.bincount([i for i, _ in links], minlength=len(rows)) if links else [0] * len(rows)
    return sorted(
        (keys[i] or -1, int(counts[i]), groups.get(keys[i])) for i in range(len(rows))
    )


@pytest.mark.parametrize("cell_rows,block_rows", [(2000, 4096), (15, 8)])
def test_range_join_is_exact(spark, cell_rows, block_rows):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 6))
    rows = []
    for i in range(220):
        v = (centres[i % 12] + rng.normal(size=6) * 0.25).astype(np.float32).tolist()
        rows.append([1000 - i, v, i % 2])
    rows += [[2000 + i, rows[0][1], 0] for i in range(30)]  # copies
    rows += [[3000, [x * 3 for x in rows[1][1]], 1], [1000, rows[0][1], 0]]
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [0.0] * 6, [1.0, None, 0.0, 0.0, 0.0, 0.0], [nan] * 6, [inf] + [0.0] * 5, [1.0, 2.0]]
    rows += [[4000 + i, v, 0] for i, v in enumerate(bad)]
    rows += [[4100, rows[0][1], None], [None, rows[0][1], 0], [4200, [1.0, 2.0], 0]]
    rows = [(*r, 1, "clash") for r in rows]
    made = metric_join.range_join(
        vectors(spark, rows), 0.93, cell_rows=cell_rows, block_rows=block_rows
    ).collect()
    found = sorted((r["vec_id"] or -1, r["n_links"], r["component_id"]) for r in made)
    assert found == brute(rows, 0.93)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in made if r["vec_id"])


def test_range_join_of_nothing(spark):
    assert metric_join.range_join(vectors(spark, [])).count() == 0
    only = metric_join.range_join(vectors(spark, [(1, None, 1, 1, "x")])).collect()
    assert [tuple(r) for r in only] == [(1, 0, 1, True)]


def test_cells_replicate_every_neighbour():
    rng = np.random.default_rng(6)
    rows = rng.normal(size=(400, 3))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    radius = np.sqrt(2 - 2 * 0.93)
    cells = metric_join.Cells({0: (0, rows[:20])}, radius)
    home, inside, _ = cells.assign(0, rows)
    near = rows @ rows.T >= 0.93
    assert all(inside[j, home[i]] for i, j in zip(*np.nonzero(near)))
    assert inside.mean() < 0.6  # and far from everywhere


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        following = [i]
        for j, y in enumerate(b, 1):
            following.append(min(row[j] + 1, following[-1] + 1, row[j - 1] + (x != y)))
        row = following
    return row[-1]


def test_alignment_equals_edit_distance():
    rng = random.Random(1)
    for _ in range(1500):
        a = [rng.randrange(4) for _ in range(rng.randrange(14))]
        b = a[:] if rng.random() < 0.5 else [rng.randrange(4) for _ in range(rng.randrange(14))]
        for _ in range(rng.randrange(3)):
            if b:
                b[rng.randrange(len(b))] = 9
                b.insert(rng.randrange(len(b)), b.pop())
        allowed, x, y = rng.randrange(8), np.array(a, "<u4"), np.array(b, "<u4")
        want = edit_distance(a, b) <= allowed
        assert order_minhash.within(x, y, allowed) == want
        if a and b and order_minhash._greedy(x, y, allowed):
            assert want
        if a and b and abs(len(a) - len(b)) <= allowed:
            assert order_minhash._by_band(x, y, allowed) == want


def test_bags_never_reject_near_texts():
    rng = np.random.default_rng(2)
    for _ in range(50):
        a = rng.integers(0, 1 << 30, 100).astype(np.uint64)
        b = a.copy()
        b[rng.choice(100, 20, replace=False)] += np.uint64(1)
        sides = [
            {"bags": order_minhash.bags(x).astype(np.int64)[None, :], "n": np.array([100]),
             "part": np.array([part])}
            for part, x in enumerate((a, b))
        ]
        assert len(order_minhash.plausible(*sides, None)[0]) == 1


def test_signatures_never_reject_near_texts():
    rng = np.random.default_rng(3)
    texts = []
    for n in (5, 40, 100, 100, 600):
        source = rng.integers(0, 200 if n == 600 else 1 << 30, n).astype("<u4")
        texts.append(source)
        for share in (0.05, 0.2, 0.5):
            changed = source.copy()
            changed[rng.choice(n, int(n * share + 1e-9), replace=False)] += np.uint32(1)
            texts.append(changed)
    signatures = np.stack([np.frombuffer(order_minhash.signature(t), np.uint8) for t in texts])
    n, part = np.array([len(t) for t in texts]), np.arange(len(texts))
    near = {
        (i, j) for i in part for j in part if i < j and order_minhash.near(texts[i], texts[j])
    }
    made = set(zip(*(x.tolist() for x in order_minhash.proposed(signatures, n, part, part, None))))
    assert near <= made and len(made) < len(part) ** 2 / 4
    i, j = order_minhash.proposed(signatures, n, part, part[::2], part[1::2])
    assert {(min(p), max(p)) for p in zip(i.tolist(), j.tolist())} >= {p for p in near if sum(p) % 2}
    assert order_minhash.proposed(signatures, n, part, part, None, dense=0) is None
    assert not len(order_minhash.proposed(signatures, n, part * 0, part, None, dense=0)[0])
    for i, j in near:
        assert order_minhash.words_apart(texts[i], texts[j]) <= 0.2 * max(n[i], n[j])


def test_groups_stay_whole_over_batches():
    rows = [(0, 1), (0, 1), (0, 2), (3, 2), (3, 2), (3, 2), (4, 0)]
    batches = [
        pa.RecordBatch.from_pylist([{"k": k, "x": x} for k, x in rows[i : i + 2]])
        for i in range(0, len(rows), 2)
    ]
    seen = []
    for part, edges in order_minhash.whole_groups(iter(batches), ["k", "x"]):
        seen += [part.slice(a, b - a).to_pylist() for a, b in zip(edges, edges[1:])]
    assert [[(r["k"], r["x"]) for r in group] for group in seen] == [
        rows[:2], rows[2:3], rows[3:6], rows[6:],
    ]


def test_a_common_passage_makes_few_rows(spark, monkeypatch):
    """Rows of the blocks of what is left in a bucket stay near the rows of the buckets."""
    rng = random.Random(7)
    passage = " ".join(f"p{i}" for i in range(40))
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) + " " + passage for _ in range(600)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    counts, rest = [], order_minhash._rest

    def counted(members, texts, keys, similarity, written):
        def noted(rows, name):
            made = written(rows, name)
            counts.append((name, made.count()))
            return made

        counts.append(("members", members.count()))
        return rest(members, texts, keys, similarity, noted)

    monkeypatch.setattr(order_minhash, "_rest", counted)
    made = order_minhash.near_duplicates(df)
    assert made.filter("doc_id <> class_id").count() == 0 and made.count() == 600
    counts = dict(counts)
    assert 600 < counts["blocks"] <= counts["members"]


def test_dense_blocks_link_what_all_pairs_link(spark, monkeypatch):
    """Blocks whose plausible pairs are too many align with the words at hand."""
    monkeypatch.setattr(order_minhash, "BLOCK", 6)
    rng = random.Random(8)
    source = [f"w{i}" for i in range(40)]
    texts = []
    for i in range(40):  # a chain: each near to the one before, far from most others
        for _ in range(3):
            source[rng.randrange(40)] = f"c{rng.randrange(10**6)}"
        texts.append(" ".join(source))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    plain = sorted(map(tuple, order_minhash.near_duplicates(df).collect()))
    monkeypatch.setattr(order_minhash, "DENSE", 0)
    assert sorted(map(tuple, order_minhash.near_duplicates(df).collect())) == plain


def test_order_and_occurrence_change_a_sketch():
    def keys(*texts):
        words = [order_minhash.words_of(t) for t in texts]
        return order_minhash.sketches(*order_minhash.word_hashes(words))

    rng = random.Random(5)
    words = [f"w{rng.randrange(10_000)}" for _ in range(120)]
    text, swapped = " ".join(words), " ".join(words[60:] + words[:60])
    same, moved, alone = keys(text, swapped, text)
    assert (same == alone).all()
    assert 0 < (same == moved).mean() < 0.7  # the sets of k-mers are nearly equal
    assert (keys(text)[0] == same).all()  # whatever else is in the batch
    once, twice = keys(text, f"{text} {text}")
    assert (once == twice).mean() < 0.8


def corpus():
    rng = random.Random(9)

    def words(n):
        return [f"w{rng.randrange(3000)}" for _ in range(n)]

    def changed(source, share):
        out = list(source)
        for i in rng.sample(range(len(out)), int(len(out) * share)):
            out[i] = f"c{rng.randrange(10**6)}"
        return out

    passage = words(60)
    texts = []
    for n in (30, 90, 250, 700):
        source = words(n)
        texts += [source] + [changed(source, 0.03) for _ in range(6)] + [source]
        texts += [changed(source, 0.5)]
    texts += [words(60) + passage + words(30) for _ in range(25)]  # a shared passage only
    hot = words(80)
    texts += [changed(hot, 0.02) for _ in range(60)]
    texts = [" ".join(t) for t in texts] + [None, "", "two words", "two words", "Two  WORDS"]
    texts += ["x " * 4000, "x " * 4000 + "y"]
    return texts


def test_near_duplicates_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(order_minhash, "BLOCK", 4)
    texts = corpus()
    rows = [(500 - i, t, "clash", 7) for i, t in enumerate(texts)] + [(None, texts[0], "c", 1)]
    rows.append(rows[3])
    df = spark.createDataFrame(rows, "doc_id bigint, text string, digest string, n_words int")
    made = order_minhash.near_duplicates(df).collect()
    assert len(made) == len(rows)
    words = {r[0]: order_minhash.words_of(r[1] or "") for r in rows if r[0] is not None}
    numbers: dict = {}
    coded = {
        k: np.array([numbers.setdefault(w, len(numbers)) for w in ws], "<u4")
        for k, ws in words.items()
    }
    links = [
        (a, b)
        for a in coded
        for b in coded
        if a > b and order_minhash.near(coded[a], coded[b])
    ]
    want = united(set(coded), links)
    assert {r["doc_id"]: r["class_id"] for r in made if r["doc_id"] is not None} == want
    assert [(r["class_id"], r["kept"]) for r in made if r["doc_id"] is None] == [(None, True)]
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in made if r["doc_id"])


def test_near_duplicates_at_the_threshold(spark):
    """10 to 20 % of the words changed, spread by chance or evenly, in short and long texts."""
    rng = random.Random(11)
    texts, number = [], iter(range(10**6))
    for n in (5, 6, 7, 9, 10, 14, 20, 33, 45, 60, 120, 400):
        for share in (0.1, 0.15, 0.18, 0.2):
            for spread in ("chance", "even"):
                edits = max(1, int(n * share + 1e-9))
                source = [f"w{next(number)}" for _ in range(n)]
                step = n / edits
                even = [int(i * step + step / 2) for i in range(edits)]
                changed = list(source)
                for i in even if spread == "even" else rng.sample(range(n), edits):
                    changed[i] = f"c{next(number)}"
                texts += [source, changed]
    df = spark.createDataFrame(
        [(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id bigint, text string"
    )
    made = {r["doc_id"]: r["class_id"] for r in order_minhash.near_duplicates(df).collect()}
    assert [i for i in made if made[i] != i - i % 2] == []


def test_near_duplicates_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert order_minhash.near_duplicates(df).count() == 0


def test_components_in_rounds_and_together(spark, monkeypatch):
    rng = random.Random(8)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(2**40, 3), (7, -9)]
    real = [(a, b) for a, b in links if a != b]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    wanted = united({n for link in real for n in link}, real)
    for most in (0, 60, 10_000):
        monkeypatch.setattr(components, "TOGETHER", most)
        rows = components.components(df).collect()
        assert len(rows) == len(wanted)
        assert {r["node"]: r["component"] for r in rows} == wanted
    # What is left is finished at once: no rounds of shuffles.
    monkeypatch.setattr(components, "_stars", None)
    assert components.components(df).count() == len(wanted)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_alignment_by_bits_is_exact():
    rng = random.Random(5)
    for _ in range(300):
        kinds = rng.choice([2, 4, 60])
        a = [rng.randrange(kinds) for _ in range(rng.choice([0, 1, 2, 9, 63, 64, 65, 90]))]
        b = [w if rng.random() > 0.15 else rng.randrange(kinds) for w in a if rng.random() > 0.1]
        exact = distance(a, b)
        for allowed in {max(0, exact - 1), exact, exact + 2}:
            assert order_minhash.within(np.array(a, "<u4"), np.array(b, "<u4"), allowed) == (
                exact <= allowed
            )


def test_a_dense_block_aligns_few_pairs(monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 32, 40).astype("<u4")
    words = [base.copy() for _ in range(400)]
    for i, w in enumerate(words):
        w[i % 40] = i
    side = {
        "bags": np.stack([order_minhash.bags(w) for w in words]).astype(np.int64),
        "words": words, "n": np.full(400, 40), "nodes": list(range(400)),
        "part": np.arange(400), "keys": np.full((400, 3), 7),
    }
    met, plausible = [], order_minhash.plausible
    monkeypatch.setattr(
        order_minhash, "plausible",
        lambda *a: met.append(found := plausible(*a)) or found,
    )
    links = order_minhash._forest(side, side, 7, 0.8)
    assert len(links) == 399 and set(united(range(400), links).values()) == {0}
    assert sum(len(i) for i, *_ in met) < 400 * 400 / 10


def test_marks_keep_every_wanted_id_and_few_others(spark, monkeypatch):
    ids = spark.createDataFrame([(i * 7919 - 2**40,) for i in range(3000)], "id bigint")
    others = spark.range(20_000).select(F.col("id") + 10**15)
    for most in (1 << 27, 1 << 12):
        monkeypatch.setattr(order_minhash, "MOST_MARKS", most)
        many, bits = order_minhash.marked(ids, "id")

        def share(df):
            at = df.toDF("id").select(F.pmod(F.xxhash64("id"), F.lit(many)).alias("at")).toArrow()
            return order_minhash.has_mark(bits, at["at"].to_numpy()).mean()

        assert share(ids) == 1
        assert share(others) < (0.1 if most > 1 << 20 else 0.7)
    many, bits = order_minhash.marked(ids.limit(0), "id")
    assert not order_minhash.has_mark(bits, np.arange(many)).any()
