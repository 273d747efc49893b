import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lexiform.cluster import fresh_path
from lexiform.llm import forced_boundary, packing, token_files

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", " ", "Hello, world.", "a  b\t\tc\n\nd \n e", "it's don't WE'LL 12345",
    "<|endoftext|> x<|endoftext|>y", "naïve Ünïcode ñ 漢字 🎉 é", "İ, İ. ß! Σ",
    " nbsp　wide\x1cfs\x00nul", "###***!!! a.b,c;d", "word " * 9000, "x" * 5000,
    "Hello, world.",
]


def documents(spark, texts):
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, ids string, width int")


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_codec_equals_the_library(path):
    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        codec = forced_boundary.FragmentCodec(file.read())
    rng = random.Random(5)
    parts = ["a", "Bc", " ", "  ", "\n", "\t", ".", ",", "'s", "é", " ", "<|endoftext|>", "1",
             "²", "\x1c", "\x00", "_", "é", "İ", "Σ", "|", "###", "क़", " the"]
    texts = [t or "" for t in TEXTS]
    texts += ["".join(rng.choices(parts, k=rng.randrange(14))) for _ in range(1500)]
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):  # the second time from memory
        assert [np.frombuffer(i, "<u4").tolist() for i in codec.encode(texts)] == want
    assert all("".join(codec.fragments(t)) == t for t in texts)


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_codec_of_long_stretches(monkeypatch, path):
    """Texts without white space, whose pairs of bytes are often in no token."""
    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        codec = forced_boundary.FragmentCodec(file.read())
    rng = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyzABCXYZ0123456789"
    parts = [*letters, "'s", "'", "!'", "'re", "qz", "漢", "字", "é", "ñ", "🎉", "Ж", "<|", "|>", "_",
             "<|endoftext|>", "...", "—", "\u0301", "ß", "İ"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(40, 300))) for _ in range(400)]
    texts += [" " + t for t in texts[:50]] + ["".join(rng.choices("漢字日本語中文大学生", k=5000))]
    texts += [a + " \n " + b + "." + a for a, b in zip(texts, texts[1:])][:100]
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(i, "<u4").tolist() for i in codec.encode(texts)] == want
    monkeypatch.setattr(forced_boundary, "LONG_CHARS", 8)
    assert [np.frombuffer(i, "<u4").tolist() for i in codec.encode(texts[::-1])] == want[::-1]
    cut = [codec.cut_inside(t) for t in texts]
    assert all("".join(c) == t for c, t in zip(cut, texts))
    assert sum(map(len, cut)) > 5 * len(texts)
    for token, number in tokenizer.get_vocab().items():
        if codec.inner and number % 50 == 0:
            assert len(codec.cut_inside(tokenizer.decode([number]) or "a")) == 1 or "�" in tokenizer.decode([number])


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(forced_boundary, "REMEMBERED", 3)
    monkeypatch.setattr(forced_boundary, "REMEMBERED_CHARS", 2)
    with open(WORDS, encoding="utf-8") as file:
        codec = forced_boundary.FragmentCodec(file.read())
    texts = ["some words, and more words.", "and some more"]
    first = codec.encode(texts)
    assert first == codec.encode(texts) == [codec.encode([t])[0] for t in texts]


def test_digests(spark):
    tokenizer = Tokenizer.from_file(WORDS)
    made = {r["doc_id"]: r for r in forced_boundary.digests(documents(spark, TEXTS), WORDS).collect()}
    assert len(made) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        row = made[i]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
    assert forced_boundary.digests(documents(spark, []), WORDS).count() == 0


def expected_ids(texts, path, end):
    tokenizer = Tokenizer.from_file(path)
    coded = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    return [np.array([*ids, end], "<u4") for ids in coded]


@pytest.mark.parametrize("per_task", [packing.BINS_PER_TASK, 3])
def test_packing_is_whole_and_tight(spark, per_task):
    texts = TEXTS + ["some text " * (37 * i % 900) for i in range(60)] + ["long text " * 5000]
    want = expected_ids(texts, BYTES, 0)
    docs = documents(spark, texts).repartition(5)
    rows = packing.pack_documents(docs, BYTES, bins_per_task=per_task).toPandas()
    for doc, ids in enumerate(want):
        pieces = rows[rows["doc_id"] == doc].sort_values("piece")
        assert pieces["piece"].tolist() == list(range(len(pieces)))
        assert (pieces["length"].iloc[1:] == packing.CAPACITY).all()
        at = 0
        for piece in pieces.itertuples():
            assert piece.start == at
            assert piece.ids_crc32 == zlib.crc32(ids[at : at + piece.length].tobytes())
            at += piece.length
        assert at == len(ids)
    for _, sequence in rows.sort_values("offset").groupby("sequence_id"):
        assert sequence["offset"].tolist() == [0, *sequence["length"].cumsum().tolist()[:-1]]
        assert sequence["length"].sum() <= packing.CAPACITY
    least = -(-sum(map(len, want)) // packing.CAPACITY)
    assert rows["sequence_id"].nunique() <= least + (1 if per_task > 3 else 6)


def test_packing_repeated_and_null_ids(spark):
    rows = [(None, "a b"), (None, "a b"), (1, "c"), (1, "c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    made = packing.pack_documents(docs, BYTES).collect()
    assert sorted(str(r["doc_id"]) for r in made) == ["1", "1", "None", "None"]
    assert packing.pack_documents(docs.limit(0), BYTES).count() == 0


def test_best_fit_chooses_the_fullest_bin():
    sizes = np.array([6, 5, 4, 3, 2])
    assert [sorted(sizes[b].tolist()) for b in packing.best_fit(sizes, 10)] == [[4, 6], [2, 3, 5]]
    assert packing.cut_points(10, 4) == [(0, 2), (2, 4), (6, 4)]
    assert packing.cut_points(8, 4) == [(0, 4), (4, 4)]


@pytest.mark.parametrize("n,u", [(1, 0), (1, 2**62), (5, 3), (1000, 10**6), (700, 2**62), (600, 0)])
def test_elias_fano_selects(n, u):
    values = np.sort(np.random.default_rng(n).integers(0, u + 1, n))
    coded, _ = token_files.EliasFano.read(token_files.EliasFano.of(values).to_bytes(), 0)
    assert coded.values().tolist() == values.tolist()
    assert [coded.select(i) for i in range(n)] == values.tolist()


def test_elias_fano_is_small():
    ends = np.cumsum(np.random.default_rng(2).integers(1, 2000, 10_000))
    assert 8 * len(token_files.EliasFano.of(ends).to_bytes()) < 10_000 * (2.5 + np.log2(1000))


@pytest.mark.parametrize("segment_ids", [token_files.SEGMENT_IDS, 50])
def test_token_files_round_trip(spark, segment_ids):
    order = [7, 3, 11, -4, 900, 5, 6, 1, 0, 2, 40, 41, 42, 43]
    docs = documents(spark, TEXTS).replace(dict(enumerate(order)), subset=["doc_id"]).repartition(4)
    folder = fresh_path(spark, "test-tokens")
    token_files.write_tokens(docs, WORDS, folder, 2, segment_ids=segment_ids)
    by_id = dict(zip(order, expected_ids(TEXTS, WORDS, 2)))
    rows = token_files.read_tokens(spark, folder).orderBy("doc_id").collect()
    at = 0
    for row, (doc, ids) in zip(rows, sorted(by_id.items()), strict=True):
        assert (row["doc_id"], row["start"], row["n_tokens"]) == (doc, at, len(ids))
        assert row["ids_crc32"] == zlib.crc32(ids.tobytes())
        at += len(ids)
    for file in spark.read.format("binaryFile").load(folder).collect():
        if file["length"]:
            segment = token_files.Segment(bytes(file["content"]))
            for i, key in enumerate(segment.keys):
                assert segment.ids(i).tolist() == by_id[key].tolist()


def test_token_files_nulls_ties_and_nothing(spark):
    rows = [(None, "a"), (3, "b"), (3, "b"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    folder = fresh_path(spark, "test-tokens")
    token_files.write_tokens(docs, WORDS, folder, 2)
    found = token_files.read_tokens(spark, folder).collect()
    assert sorted((r["start"], r["doc_id"]) for r in found)[2][1] == 3
    assert sorted(r["start"] for r in found) in ([0, 1, 3, 5], [0, 2, 3, 5])
    folder = fresh_path(spark, "test-tokens")
    token_files.write_tokens(docs.limit(0), WORDS, folder, 2)
    assert token_files.read_tokens(spark, folder).count() == 0
