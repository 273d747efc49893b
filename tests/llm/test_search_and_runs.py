import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from lexiform.cluster import fresh_path
from lexiform.llm import kmeans_tree, lexical_search, periodic_runs, queries

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ASCII_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text):
    return TERM.findall((text or "").translate(ASCII_LOWER))


def ranked(docs, items, k):
    """All scores by the formula, per item in order."""
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n, total = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in counts:
            m = 75 + 25 * c.total() * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t in terms(text) if t in c
            )
            if score > 0:
                found.append((-score, i is None, i or 0))
        for rank, (score, null, i) in enumerate(sorted(found)[:k], 1):
            out.append((item, rank, None if null else i, -score))
    return sorted(out, key=str)


def search(spark, docs, items, k=5):
    documents = spark.createDataFrame(
        [(i, t, "clash", 1, "x") for i, t in docs],
        "doc_id bigint, text string, term string, segment int, key string",
    )
    asked = spark.createDataFrame(
        [(i, t, 0) for i, t in items], "item_id bigint, text string, query int"
    )
    index = lexical_search.build_index(documents, fresh_path(spark, "index"))
    found = lexical_search.search(index, asked, k)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def texts(rng, n, words=60):
    vocabulary = [f"W{i}" if i % 3 else f"wört{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    return [" ".join(rng.choices(vocabulary, weights, k=rng.randrange(1, 40))) for _ in range(n)]


def test_search_equals_all_scores(spark, monkeypatch):
    rng = random.Random(3)
    docs = list(enumerate(texts(rng, 300)))
    docs += [(1000 + i, docs[7][1]) for i in range(30)]  # copies: equal scores
    docs += [(None, docs[7][1]), (7, docs[7][1]), (7, docs[7][1]), (400, None), (401, ""),
             (402, "--- \n"), (403, "W1 " * 30_000), (404, "ÄÖ\x00W2\x7fw2[W2")]
    items = [*enumerate(texts(rng, 12)), (50, "unheard of"), (51, None), (52, ""),
             (53, docs[7][1]), (3, docs[9][1]), (None, "w1 w2 w2"), (54, "Äö äÖ")]
    wanted = ranked(docs, items, 5)
    assert search(spark, docs, items) == wanted
    for name, value in (("SEGMENT_DOCS", 20), ("RANGE", 4), ("SHORT", 3), ("BLOCK_TERMS", 40),
                        ("BROADCAST_BYTES", 0), ("PIECE_BYTES", 10)):
        monkeypatch.setattr(lexical_search, name, value)
    assert search(spark, docs, items) == wanted


def test_traversal_skips_and_stays_exact():
    rng = np.random.default_rng(4)
    docs, ranges = 4000, -(-4000 // lexical_search.RANGE)
    for _ in range(30):
        lists, whole = [], np.zeros(docs, np.int64)
        for _ in range(rng.integers(1, 12)):
            places = np.sort(rng.choice(docs, rng.integers(1, docs), replace=False))
            scores, times = rng.integers(0, 50, len(places)), int(rng.integers(1, 3))
            lists.append((lexical_search.Lists(places, scores, ranges), times))
            whole[places] += scores * times
        ids = rng.permutation(docs)
        best = lexical_search.Best(7)
        lexical_search.traverse(lists, docs, best, ids, np.zeros(docs, bool))
        order = np.lexsort((ids, -whole))[:7]
        order = order[whole[order] > 0]
        assert best.ids.tolist() == ids[order].tolist()
        assert best.scores.tolist() == whole[order].tolist()


def test_search_of_empty_tables(spark):
    assert search(spark, [], [(1, "a")]) == []
    assert search(spark, [(1, "a"), (2, "b")], []) == []
    assert search(spark, [(1, None), (2, "  ")], [(1, "a")]) == []
    assert search(spark, [(1, "a")], [(1, None)]) == []


def near(spark, rows, **options):
    df = spark.createDataFrame(
        [(i, v, 0, "x") for i, v in rows],
        "vec_id bigint, embedding array<float>, cell int, same string",
    )
    found = kmeans_tree.nearest(df, **options)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in found.collect())


def brute(rows, k, every):
    """All inner products; rows that repeat key and vector are one."""
    held = {}
    for i, v in rows:
        usable = v and None not in v and all(map(math.isfinite, v)) and any(v)
        if i is not None and usable:
            held[i, tuple(np.float32(v).tolist())] = np.float32(v).astype(float)
    out = []
    for (q, a), x in held.items():
        if q % every:
            continue
        found = [
            (-float((x * y).sum()), i)
            for (i, b), y in held.items()
            if len(x) == len(y) and (i, b) != (q, a)
        ]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("unit", [True, False])
def test_neighbours_have_the_promised_recall(spark, monkeypatch, unit):
    monkeypatch.setattr(kmeans_tree, "LEAF_ROWS", 20)
    monkeypatch.setattr(kmeans_tree, "LEAF_SAMPLE", 2)
    monkeypatch.setattr(kmeans_tree, "BLOCK_ROWS", 64)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(30, 12))
    vectors = centres[rng.integers(0, 30, 1500)] + 0.4 * rng.normal(size=(1500, 12))
    if unit:
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(2000 + i, rows[20][1]) for i in range(500)]  # a hot group of copies
    wanted, made = brute(rows, 10, 20), near(spark, rows, k=10)
    assert [r[:2] for r in made] == [r[:2] for r in wanted]
    hits = Counter(q for q, _, _, _ in set((q, 0, i, 0) for q, _, i, _ in made)
                   & set((q, 0, i, 0) for q, _, i, _ in wanted))
    assert hits.total() >= 0.9 * len(wanted)
    exact = {(q, i): s for q, _, i, s in brute(rows, len(rows), 20)}
    assert all(exact[q, i] == s for q, _, i, s in made)
    copies = [r for r in made if r[0] == 2000]
    assert [r for r in wanted if r[0] == 2000] == copies  # ties by key, its own left out


def test_neighbours_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]),
            (3, [-1.0, 0.0]), (20, [0.0, 0.0]), (40, None), (60, [nan, 1.0]), (80, [inf, 1.0]),
            (100, [None, 1.0]), (120, []), (None, [1.0, 1.0]), (140, [1.0, 2.0, 3.0]),
            (160, [3.0]), (180, [4.0]), (181, [1.0, 1.0, 1.0]), (-20, [0.5, 0.5])]
    assert near(spark, rows, k=3) == brute(rows, 3, 20)
    assert near(spark, [], k=3) == near(spark, [(1, [1.0])], k=3) == []
    assert near(spark, [(20, [1.0])], k=3) == []


def runs_of(words):
    """All runs by trying every period from the smallest."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(6, 4 * q):
                found.setdefault((start, i + q), q)
            i += 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def periodic_words(rng):
    words = [rng.choice("abcdefgh"[: rng.choice([1, 2, 3, 8])]) for _ in range(rng.randrange(160))]
    for _ in range(rng.randrange(4)):
        if len(words) > 8:
            a = rng.randrange(len(words))
            p = 1 + rng.randrange(1 + (len(words) - a) // 3)
            for i in range(a, rng.randrange(a, len(words)) + 1):
                words[i] = words[a + (i - a) % p]
    return words


def test_runs_equal_all_periods(spark):
    rng = random.Random(6)
    held = [" ".join(periodic_words(rng)) for _ in range(400)]
    held += [None, "", " \t\n", "a", "a a a a a", "a a a a a a", "ab\x1cc " * 5, "é é " * 7,
             "x " * 70_000, "one two three " * 20_000 + "end", held[0], held[0]]
    rows = [(i if i % 50 else None, t, "clash", 0) for i, t in enumerate(held)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, runs string, start int")
    made = sorted(
        (str(r["doc_id"]), r["n_words"], tuple(map(tuple, r["runs"])),
         r["strongest"] and tuple(r["strongest"]), r["collapsed"])
        for r in periodic_runs.periodic_runs(df).collect()
    )
    wanted = []
    for i, text, _, _ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs = runs_of(words) if len(words) < 1000 else None
        if runs is None:
            runs = [(0, 70_000, 1)] if words[0] == "x" else [(0, 60_000, 3)]
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        gone = {w for s, length, q in runs for w in range(s + q, s + length)}
        left = " ".join(w for n, w in enumerate(words) if n not in gone)
        wanted.append((str(i), len(words), tuple(runs), best, left))
    assert made == sorted(wanted)
    assert periodic_runs.periodic_runs(df.limit(0)).count() == 0


def test_runs_across_scales():
    rng = random.Random(7)
    for _ in range(300):
        docs = [periodic_words(rng) for _ in range(rng.randrange(6))]
        codes = np.array([ord(w) for d in docs for w in d], np.int64)
        found = periodic_runs.find_runs(codes, [len(d) for d in docs])
        made = [(d, s, e - s, q) for d, s, e, q in found.tolist() if e - s >= 6]
        assert made == [(d, *r) for d, words in enumerate(docs) for r in runs_of(words)]


def test_digests_of_runs(spark, tmp_path):
    rows = [(i, " ".join(f"w{j * j % 53}" for j in range(i))) for i in range(60)] + [(60, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    made = {r["doc_id"]: r for r in queries.op13_periodic_runs(spark, str(tmp_path)).collect()}
    assert len(made) == 61 and any(r["n_runs"] for r in made.values())
    for i, text in rows:
        words = (text or "").split()
        h, n = zlib.crc32(str(i).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = words[:a] + [words[a + (j - a) % p] for j in range(a, n)]
        runs = runs_of(words)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        assert made[i]["n_runs"] == len(runs)
        assert made[i]["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        if runs:
            s, length, q = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
            assert (s, length, q) == (made[i]["start"], made[i]["length"], made[i]["period"])
            assert made[i]["exponent_milli"] == 1000 * length // q
        else:
            assert made[i]["start"] is None and made[i]["exponent_milli"] is None
