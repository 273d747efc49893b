import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from lexiform.llm import order_minhash, pairwise_rank, toxicity

SF = "/root/testdata/sf0.001"


def test_stages_and_registration():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "pairwise quality", "Kneser-Ney toxicity", "Order MinHash near-dedup", "best-fit packing",
    ]
    names = list(entry.queries())
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names


def test_run_keeps_what_the_decisions_keep(spark):
    """Each stage's decisions again, on what the stage before kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    ranked = pairwise_rank.rank(docs, labels).filter("predicted = 1").select("doc_id")
    good = docs.join(ranked, "doc_id").select(docs.columns)
    calm = toxicity.score_toxicity(good, labels).filter("predicted = 0").select("doc_id")
    texts = {r["doc_id"]: r["text"] for r in good.join(calm, "doc_id").collect()}
    words = {d: tuple(order_minhash.words_of(t or "")) for d, t in texts.items()}
    numbers: dict = {}
    coded = {
        d: np.array([numbers.setdefault(w, len(numbers)) for w in ws], "<u4")
        for d, ws in words.items()
    }
    parent = {d: d for d in coded}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(coded)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = root(a), root(b)
            if x != y and order_minhash.near(coded[a], coded[b]):
                parent[max(x, y)] = min(x, y)
    left = {d for d in ids if root(d) == d}
    made = corpus_pipeline.run(spark, SF).toPandas()
    assert set(made["doc_id"]) == left
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for doc, pieces in made.groupby("doc_id"):
        want = len(tokenizer.encode(texts[doc] or "", add_special_tokens=False).ids) + 1
        assert pieces["length"].sum() == want
    assert 0 < len(left) < docs.count()


def test_stages_keep_columns_nulls_and_one_of_repeated_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    odd = docs.limit(1).withColumns({"doc_id": F.lit(None).cast("bigint")})
    docs = docs.unionByName(docs.limit(5)).unionByName(odd)
    docs = docs.withColumns({"score": F.lit("clash"), "digest": F.lit(1), "kept": F.lit(None)})
    docs = docs.withColumn("kept", F.lit(False))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, SF)
        assert made.columns == docs.columns
        ids = [r["doc_id"] for r in made.select("doc_id").collect()]
        assert None in ids and len(ids) > 10
    assert len(ids) == len(set(ids))


def test_decisions_follow_the_row(spark):
    """Rows without an id are judged by their text; a rejected row takes no other of its id along."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    ranked = pairwise_rank.rank(docs, labels).select("doc_id", "predicted")
    bad = docs.join(ranked.filter("predicted = 0"), "doc_id").select(docs.columns).limit(3)
    bad = bad.checkpoint()
    good = docs.join(ranked.filter("predicted = 1"), "doc_id").select(docs.columns).limit(2)
    twins = good.checkpoint().withColumn("doc_id", F.lit(bad.first()["doc_id"]).cast("bigint"))
    nameless = bad.withColumn("doc_id", F.lit(None).cast("bigint"))
    whole = docs.unionByName(nameless).unionByName(twins)
    kept = corpus_pipeline.keep_quality(spark, whole, SF)
    assert kept.filter("doc_id IS NULL").count() == 0
    same = kept.filter(F.col("doc_id") == bad.first()["doc_id"]).select("text").collect()
    assert sorted(same) == sorted(twins.select("text").collect())
    # Copies without an id are one class; one id on different texts is two documents.
    few = nameless.limit(1).unionByName(nameless.limit(1)).unionByName(twins)
    left = corpus_pipeline.drop_near_duplicates(spark, few, SF)
    assert left.filter("doc_id IS NULL").count() == 1
    assert left.filter("doc_id IS NOT NULL").count() == twins.select("text").distinct().count() == 2


def test_stages_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
