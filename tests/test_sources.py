import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lexiform import sources
from lexiform.operators.profile import class_distribution, dataset_summary, target_names
from lexiform.sources.corpus import load_category_corpus
from lexiform.sources.tables import standardize


def test_delimited_reads_quotes_lines_and_missing_values(spark, tmp_path):
    path = tmp_path / "reviews.tsv"
    path.write_text(
        "\tcustomer_review\treturn\n"
        '0\t"two\nlines with ""quotes"""\t1\n'
        "1\tplain\t0.0\n"
        "2\tNA\t1\n"
        "3\tno target\t\n"
        "4\tspelled None\tNone\n",
        encoding="utf-8",
    )
    rows = sources.load(spark, "csv_file", path=f"file:{path}").orderBy("doc_id").collect()
    assert [tuple(r) for r in rows] == [
        (0, 'two\nlines with "quotes"', 1),
        (1, "plain", 0),
    ]
    assert rows[0].__fields__ == ["doc_id", "text", "target"]


def test_delimited_rejects_bad_labels_columns_and_paths(spark, tmp_path):
    path = tmp_path / "bad.tsv"
    path.write_text("\tcustomer_review\treturn\n0\ttext\tx\n")
    with pytest.raises(Exception, match="not a number"):
        sources.load(spark, "csv_file", path=str(path)).collect()
    with pytest.raises(ValueError, match="columns not in"):
        sources.load(spark, "csv_file", path=str(path), text_column="words")
    with pytest.raises(AnalysisException):
        sources.load(spark, "object_store_csv", path="file:/no/such/file.tsv")
    with pytest.raises(ValueError, match="unknown source"):
        sources.load(spark, "carrier_pigeon")


@pytest.mark.parametrize(
    "second",
    [
        "\treturn\tcustomer_review\n9\t7\ttext\n",  # columns in another order
        "\tcustomer_review\treturn\n9\ttext\t0\tmore\n",  # a field too many
        "\tcustomer_review\treturn\n9\ttext\n",  # a field too few
    ],
)
def test_delimited_rejects_malformed_files(spark, tmp_path, second):
    (tmp_path / "a.tsv").write_text("\tcustomer_review\treturn\n0\tfirst\t1\n")
    (tmp_path / "b.tsv").write_text(second)
    with pytest.raises(Exception, match="FAILED_READ_FILE|MALFORMED|header"):
        sources.load(spark, "csv_file", path=f"file:{tmp_path}").collect()


def test_delimited_rejects_repeated_ids(spark, tmp_path):
    for name in "ab":
        (tmp_path / f"{name}.tsv").write_text("\tcustomer_review\treturn\n0\tx\t1\n1\ty\t0\n")
    with pytest.raises(ValueError, match="more than once"):
        sources.load(spark, "csv_file", path=f"file:{tmp_path}")
    assert sources.load(spark, "csv_file", path=f"file:{tmp_path}", check_ids=False).count() == 4


def test_table_source_and_standardize(spark, tmp_path, reviews):
    path = f"{tmp_path}/reviews"
    reviews.write.parquet(path)
    assert sources.load(spark, "table", path=path).count() == 40
    odd = spark.createDataFrame([(1, "a", "1.7"), (2, None, "0"), (3, "c", None)], "k int, w string, y string")
    assert [tuple(r) for r in standardize(odd, "w", "y", "k").collect()] == [(1, "a", 1)]
    with pytest.raises(ValueError):
        sources.load(spark, "table")


def test_category_folders(spark, tmp_path):
    for subset, category, name in [
        ("train", "sports", "1"), ("train", "arts", "2"), ("test", "arts", "3"), ("train", "news", "4"),
    ]:
        folder = tmp_path / subset / category
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text(f"{category}\nline {name}")
    loaded = load_category_corpus(spark, path=f"file:{tmp_path}", categories=["sports", "arts"])
    rows = {r["target_name"]: (r["target"], r["text"]) for r in loaded.collect()}
    assert rows == {"arts": (0, "arts\nline 2"), "sports": (1, "sports\nline 1")}
    assert load_category_corpus(spark, path=f"file:{tmp_path}", subset="all", shuffle=False).count() == 4


def test_profiles(spark, reviews):
    rows = class_distribution(reviews).collect()
    assert [tuple(r) for r in rows] == [(0, "class_0", 30, 40, 2), (1, "class_1", 10, 40, 2)]
    assert [r["target_name"] for r in target_names(reviews).collect()] == ["class_0", "class_1"]
    marked = reviews.withColumn("split", F.when(F.col("doc_id") < 30, "train").otherwise("test"))
    summary = {(r["split"], r["target"]): r["n"] for r in dataset_summary(marked).collect()}
    assert summary[(None, None)] == 40 and summary[("train", None)] == 30
    assert summary[(None, 1)] == 10 and len(summary) == 9
