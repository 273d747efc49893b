"""The registered queries: each operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiform.cluster import fresh_path, spread_groups
from lexiform.functions import text as words
from lexiform.functions import vectors
from lexiform.functions.stop_words import ENGLISH
from lexiform.operators import columns, embed, knn, metrics, pooling, profile, ranks, scale, split
from lexiform.operators import terms, trials, vectorize, weights
from lexiform.plans import runs, search
from lexiform.plans.models import make_model
from lexiform.plans.stages import TermFeatures
from lexiform.sources import corpus, load, tables, trials_store
from lexiform.sources.delimited import save_delimited
from lexiform.streaming import score

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

OBJECTIVES = [("accuracy", False), ("training_time", True)]
THRESHOLDS = {"accuracy": 910.0, "training_time": 30.0}
PREFERENCES = {"accuracy": 0.7, "training_time": 0.3}
SPACE = search.default_space("tfidf_vectorizer", "logistic_regression")
SPACE.training["weighting"] = search.Parameter("fixed", "string", value="balanced")


def query(function):
    """Register a query under its function's name."""
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents_of(spark: SparkSession, sf: str) -> DataFrame:
    """Documents, over as many tasks as there are cores at least."""
    return spread_groups(table(spark, sf, "documents").select("doc_id", "text"))


def labelled(spark: SparkSession, sf: str, target: str = "quality") -> DataFrame:
    """Labelled documents: doc_id, text, target."""
    codes = table(spark, sf, "labels").select("doc_id", F.col(target).alias("target"))
    return documents_of(spark, sf).join(codes, "doc_id")


def vector_table(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").withColumnRenamed("label", "target")


def predicted(spark: SparkSession, sf: str) -> DataFrame:
    """A true and a predicted code per labelled document."""
    return table(spark, sf, "labels").select(
        "doc_id", F.col("quality").alias("target"), F.col("toxic").alias("prediction")
    )


def trial_history(spark: SparkSession, sf: str, gaps: bool = False) -> DataFrame:
    """Parts as trials: price is to be maximised, size to be minimised."""
    price = F.col("p_retailprice")
    plain = ~F.col("p_brand").isin("Brand#13", "Brand#7") if gaps else F.lit(True)
    entries = [
        F.when(plain, F.struct(F.lit("accuracy").alias("k"), price.alias("v"))),
        F.when(~plain & (F.col("p_brand") == "Brand#13"),
               F.struct(F.lit("val_accuracy").alias("k"), price.alias("v"))),
        F.struct(F.lit("training_time").alias("k"), F.col("p_size").cast("double").alias("v")),
    ]
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("trial_index"),
        F.when(F.col("p_size") <= 2, "failed").otherwise("completed").alias("status"),
        F.create_map(
            F.lit("model_kind"), F.col("p_type"),
            F.lit("extractor_terms"), (F.col("p_size") * 100).cast("string"),
        ).alias("params"),
        F.map_from_entries(F.array_compact(F.array(*entries))).alias("metrics"),
    )


# Sources


@query
def load_delimited(spark, sf):
    path = fresh_path(spark, "delimited")
    rows = labelled(spark, sf).select(
        F.col("doc_id").alias("row"), F.col("text").alias("customer_review"),
        F.col("target").alias("return"),
    )
    save_delimited(rows, path)
    return load(spark, "csv_file", path=path)


@query
def load_category_corpus(spark, sf):
    documents = table(spark, sf, "documents")
    return load(spark, "category_corpus", corpus=documents, category_column="source")


@query
def category_filter(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return corpus.category_filter(documents, ["fr", "de"], "lang")


@query
def class_distribution(spark, sf):
    return profile.class_distribution(labelled(spark, sf))


@query
def target_names(spark, sf):
    return profile.target_names(vector_table(spark, sf))


@query
def dataset_summary(spark, sf):
    return profile.dataset_summary(split.stratified_split(labelled(spark, sf)))


@query
def trial_table(spark, sf):
    path = fresh_path(spark, "trials")
    history = trial_history(spark, sf)
    results = F.map_concat(
        F.transform_values("metrics", lambda k, v: v.cast("string")),
        F.create_map(F.lit("target_names"), F.lit('["class_0","class_1"]')),
    )
    done = F.col("status") == "completed"
    trials_store.save_trials(
        history.select(
            "trial_index",
            F.concat(F.lit("trial-"), F.col("trial_index").cast("string")).alias("trial_id"),
            F.col("params").alias("hyperparameters"),
            F.when(done, results).alias("results"),
            F.col("metrics")["training_time"].alias("training_time"),
            F.when(~done, "no result").alias("error"),
            "status",
        ),
        path,
    )
    recorded = trials_store.read_trials(spark, path)
    return recorded.select(
        "trial_index",
        "trial_id",
        "status",
        F.col("params")["model_kind"].alias("model_kind"),
        trials.metric_value("accuracy").alias("accuracy"),
        trials.metric_value("training_time").alias("metric_time"),
        F.coalesce(F.size("metrics"), F.lit(0)).alias("n_metrics"),
        "training_time",
        "error",
    )


# Columns and rows


@query
def standardize(spark, sf):
    rows = table(spark, sf, "part").withColumn(
        "label", F.when(F.col("p_size") > 3, F.col("p_size").cast("string"))
    )
    rows = rows.withColumn("words", F.when(F.col("p_type") != "SMALL", F.col("p_name")))
    return tables.complete_rows(tables.standardize(rows, "words", "label", "p_partkey"))


@query
def select_features(spark, sf):
    return columns.select_features(
        table(spark, sf, "lineitem"),
        ["l_ship*", "l_ord*", "l_partkey", "l_suppkey", "l_linenumber", "l_q*", "zz"],
        ["l_orderk*"],
    )


@query
def concat_text(spark, sf):
    rows = table(spark, sf, "part").withColumn("p_type", F.expr("nullif(p_type, 'SMALL')"))
    joined = columns.concat_text(rows, ["p_*"], ["p_partkey", "p_retailprice"])
    return joined.select("p_partkey", "text")


@query
def expand_vector(spark, sf):
    return columns.expand_vector(table(spark, sf, "embeddings"), "embedding").drop("embedding")


@query
def assemble_features(spark, sf):
    rows = table(spark, sf, "lineitem")
    made = columns.assemble_features(rows, ["l_quantity", "l_dis*", "l_tax"])
    wide = columns.expand_vector(made, "features", 3)
    return wide.select("l_orderkey", "l_linenumber", *[f"features_{i}" for i in range(3)])


# Text functions


@query
def tokenize_words(spark, sf):
    tokens = documents_of(spark, sf).select("doc_id", words.tokenize_words("text").alias("t"))
    return tokens.select("doc_id", F.concat_ws(" ", "t").alias("tokens"), F.size("t").alias("n"))


@query
def tokenize_whitespace(spark, sf):
    documents = documents_of(spark, sf)
    tokens = documents.select("doc_id", words.tokenize_whitespace("text").alias("t"))
    return tokens.select("doc_id", F.concat_ws(" ", "t").alias("tokens"), F.size("t").alias("n"))


@query
def strip_accents(spark, sf):
    return documents_of(spark, sf).select("doc_id", words.strip_accents("text").alias("text"))


@query
def remove_stop_words(spark, sf):
    tokens = documents_of(spark, sf).select("doc_id", words.tokenize_words("text").alias("t"))
    kept = tokens.select("doc_id", words.remove_stop_words("t", ENGLISH).alias("t"))
    return kept.select("doc_id", F.concat_ws(" ", "t").alias("tokens"), F.size("t").alias("n"))


# Vector functions


def long_vector(df: DataFrame, key: str, column) -> DataFrame:
    entries = df.select(key, F.posexplode(column).alias("dim", "v"))
    return entries.select(key, "dim", F.round("v", 6).alias("value"))


@query
def l2_normalize(spark, sf):
    rows = table(spark, sf, "embeddings")
    return long_vector(rows, "vec_id", vectors.l2_normalize(vectors.as_array(rows, "embedding")))


@query
def softmax(spark, sf):
    rows = table(spark, sf, "embeddings")
    return long_vector(rows, "vec_id", vectors.softmax(vectors.as_array(rows, "embedding")))


@query
def minkowski_distance(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", F.expr("cast(embedding as array<double>)").alias("a"))
    both = rows.withColumn("b", F.reverse("a"))
    return both.select(
        "vec_id",
        *[F.round(vectors.minkowski_distance("a", "b", p), 6).alias(f"d{p}") for p in (1, 2, 3)],
    )


@query
def decide_class(spark, sf):
    rows = table(spark, sf, "embeddings").withColumn("s", F.col("embedding")[0].cast("double") * 4)
    return rows.select(
        "vec_id",
        vectors.decide_class("embedding", "argmax").alias("by_argmax"),
        vectors.decide_class("s", "threshold").alias("by_threshold"),
        vectors.decide_class("s", "score", 2).alias("by_score"),
        vectors.decide_class("s", "score", 3).alias("by_rounding"),
        vectors.decide_class("label", "label").alias("by_label"),
    )


# Splits and weights


@query
def stratified_split(spark, sf):
    return split.stratified_split(labelled(spark, sf)).select("doc_id", "target", "split")


@query
def shuffle_rows(spark, sf):
    return split.shuffle_rows(table(spark, sf, "documents").select("doc_id", "source"))


@query
def class_weights(spark, sf):
    made = weights.class_weights(labelled(spark, sf))
    return made.select("target", "n", F.round("weight", 9).alias("weight"))


@query
def weighted_rows(spark, sf):
    rows = labelled(spark, sf).select("doc_id", "target")
    frequent = weights.class_weights(rows).filter(F.col("weight") < 1)
    made = weights.with_class_weight(rows, frequent)
    return made.select("doc_id", "target", F.round("weight", 9).alias("weight"))


@query
def label_predictions(spark, sf):
    rows = predicted(spark, sf)
    names = profile.target_names(rows)
    return profile.label_predictions(rows, names)


# Features


def document_vocabulary(spark, sf) -> DataFrame:
    documents = documents_of(spark, sf)
    statistics = vectorize.term_statistics(documents, words.tokenize_words("text"))
    return vectorize.vocabulary(statistics, documents.count(), min_df=2, max_df=0.8)


@query
def vocabulary(spark, sf):
    return document_vocabulary(spark, sf)


@query
def idf(spark, sf):
    return document_vocabulary(spark, sf).select(
        "term",
        F.round(vectorize.idf(), 6).alias("smooth"),
        F.round(vectorize.idf(smooth_idf=False), 6).alias("plain"),
        vectorize.idf(use_idf=False).alias("off"),
    )


def term_features(spark, sf, **settings) -> DataFrame:
    documents = documents_of(spark, sf)
    fitted = TermFeatures(minDF=2, maxDF=0.8, **settings).fit(documents)
    known = next(s for s in fitted.stages if hasattr(s, "vocabulary")).vocabulary
    return vectorize.long_form(fitted.transform(documents), known)


@query
def count_vectorize(spark, sf):
    made = term_features(spark, sf)
    return made.select("doc_id", "term", F.col("value").cast("bigint").alias("tf"))


@query
def tfidf_vectorize(spark, sf):
    made = term_features(spark, sf, tfidf=True)
    return made.select("doc_id", "term", F.round("value", 6).alias("weight"))


@query
def tfidf_sublinear(spark, sf):
    made = term_features(spark, sf, tfidf=True, sublinearTf=True, accents=False)
    return made.select("doc_id", "term", F.round("value", 6).alias("weight"))


@query
def tfidf_all_terms(spark, sf):
    """Weights over all terms, without a bound on the vocabulary."""
    documents = documents_of(spark, sf)
    made = TermFeatures(maxFeatures=None, tfidf=True).fit(documents).transform(documents)
    entries = made.select("doc_id", F.explode(vectors.sparse_entries("features")).alias("e"))
    return entries.select("doc_id", "e.index", F.round("e.value", 6).alias("weight"))


@query
def numbered_terms(spark, sf):
    """All terms of at least two documents with their numbers."""
    documents = documents_of(spark, sf)
    statistics = vectorize.term_statistics(documents, words.tokenize_words("text"))
    return terms.numbered_terms(statistics, documents.count(), min_df=2).drop("n_docs")


def _embedded(made: DataFrame, *extra: str) -> DataFrame:
    """Entries other than 0, and the first one of every document."""
    entries = made.select("doc_id", *extra, F.posexplode("embedding").alias("dim", "v"))
    kept = entries.filter("v != 0 OR dim = 0")
    return kept.select("doc_id", *extra, "dim", F.round("v", 6).alias("value"))


@query
def embed_text(spark, sf):
    return _embedded(embed.embed_text(documents_of(spark, sf), once=True))


@query
def embed_text_batched(spark, sf):
    documents = documents_of(spark, sf)
    return _embedded(embed.embed_text_batched(documents, size=64, once=True), "embed_ok")


def hashed_word_vectors(spark, sf) -> DataFrame:
    """A vector of eight numbers for every word that occurs twice, from its md5."""
    documents = documents_of(spark, sf)
    tokens = documents.select(F.explode_outer(words.tokenize_whitespace("text")).alias("word"))
    known = tokens.filter("word is not null").groupBy("word").count().filter("count >= 2")
    digits = [F.conv(F.substring(F.md5("word"), 4 * i + 1, 4), 16, 10) for i in range(8)]
    return known.select(
        "word", F.array(*[d.cast("double") / 65535.0 - 0.5 for d in digits]).alias("vector")
    )


@query
def mean_pool(spark, sf):
    documents = documents_of(spark, sf)
    bags = documents.select("doc_id", words.tokenize_whitespace("text").alias("tokens"))
    pooled = pooling.mean_pool(bags, hashed_word_vectors(spark, sf), 8)
    wide = columns.expand_vector(pooled, "embedding", 8)
    return wide.select(
        "doc_id", "n_known", *[F.round(f"embedding_{i}", 6).alias(f"d{i}") for i in range(8)]
    )


@query
def standardize_features(spark, sf):
    marked = split.stratified_split(vector_table(spark, sf), "vec_id")
    made = scale.standardize_features(marked.filter("split = 'train'"), marked, "embedding")
    return long_vector(made, "vec_id", F.col("scaled"))


# Metrics


@query
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(predicted(spark, sf))


@query
def accuracy(spark, sf):
    return metrics.accuracy(predicted(spark, sf)).select(F.round("accuracy", 9).alias("accuracy"), "n")


@query
def classification_report(spark, sf):
    near = neighbours(spark, sf)
    truth = vector_table(spark, sf).select(F.col("vec_id").alias("query_id"), "target")
    made = metrics.classification_report(knn.knn_predict(near).join(truth, "query_id"))
    return made.select(
        "label", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")], "support"
    )


@query
def f1_scores(spark, sf):
    made = metrics.f1_scores(predicted(spark, sf))
    return made.select(*[F.round(c, 9).alias(c) for c in made.columns if c != "support"], "support")


@query
def ranking_scores(spark, sf):
    """How well the length of a document, coarsely, ranks its labels."""
    rows = table(spark, sf, "labels").join(
        table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id"
    )
    made = ranks.ranking_scores(rows, F.col("quality") == 1, F.floor(F.col("n_chars") / 100))
    return made.select(
        F.round("roc_auc", 9).alias("roc_auc"),
        F.round("average_precision", 9).alias("average_precision"), "n_positive", "n_negative",
    )


# Neighbours


def neighbours(spark, sf) -> DataFrame:
    marked = split.stratified_split(vector_table(spark, sf), "vec_id")
    return knn.k_nearest(
        marked.filter("split = 'test'"), marked.filter("split = 'train'"), 5,
        identifier="vec_id", features="embedding",
    )


@query
def k_nearest(spark, sf):
    made = neighbours(spark, sf)
    return made.select("query_id", "neighbour_id", "label", F.round("distance", 6).alias("distance"), "rank")


@query
def k_nearest_pivots(spark, sf):
    """The same neighbours by pivots, as for a query set that is not broadcast."""
    marked = split.stratified_split(vector_table(spark, sf), "vec_id")
    made = knn.k_nearest(
        marked.filter("split = 'test'"), marked.filter("split = 'train'"), 5,
        identifier="vec_id", features="embedding", broadcast_numbers=0,
    )
    return made.select("query_id", "neighbour_id", "label", F.round("distance", 6).alias("distance"), "rank")


@query
def knn_predict(spark, sf):
    return knn.knn_predict(neighbours(spark, sf))


def vector_classes(spark, sf) -> list[int]:
    rows = vector_table(spark, sf).select("target").distinct().orderBy("target").collect()
    return [row[0] for row in rows]


@query
def knn_proba(spark, sf):
    made = knn.knn_proba(neighbours(spark, sf), vector_classes(spark, sf), "distance")
    return made.select("query_id", F.posexplode("probability").alias("class", "p")).select(
        "query_id", "class", F.round("p", 6).alias("proba")
    )


@query
def probability_columns(spark, sf):
    classes = vector_classes(spark, sf)
    made = knn.knn_proba(neighbours(spark, sf), classes)
    wide = columns.probability_columns(made, len(classes))
    names = [f"prediction_proba_{i}" for i in range(len(classes))]
    return wide.select("query_id", *[F.round(n, 6).alias(n) for n in names])


# Trials


@query
def best_trial(spark, sf):
    return trials.best_trial(trial_history(spark, sf, gaps=True), OBJECTIVES)


@query
def convergence(spark, sf):
    return trials.convergence(trial_history(spark, sf, gaps=True), OBJECTIVES)


@query
def threshold_filter(spark, sf):
    bounds = {**THRESHOLDS, "unknown": 1.0}
    kept = trials.threshold_filter(trial_history(spark, sf, gaps=True), OBJECTIVES, bounds)
    return kept.select(
        "trial_index",
        trials.metric_value("accuracy").alias("accuracy"),
        trials.metric_value("training_time").alias("training_time"),
    )


@query
def pareto_frontier(spark, sf):
    return trials.pareto_frontier(trial_history(spark, sf), OBJECTIVES)


@query
def pareto_frontier_weak(spark, sf):
    return trials.pareto_frontier(trial_history(spark, sf), OBJECTIVES, "weak")


@query
def pareto_frontier_gaps(spark, sf):
    """The frontier of three objectives, one of them unknown to some trials."""
    third = F.struct(
        F.lit("model_size").alias("k"), (F.col("trial_index") * 7919 % 1009).cast("double").alias("v")
    )
    history = trial_history(spark, sf, gaps=True).withColumn(
        "metrics", F.map_concat("metrics", F.map_from_entries(F.array(third)))
    )
    return trials.pareto_frontier(history, [*OBJECTIVES, ("model_size", True)], "weak")


@query
def recommend_configs(spark, sf):
    made = trials.recommend_configs(trial_history(spark, sf), OBJECTIVES, PREFERENCES)
    return made.select("trial_index", F.round("score", 6).alias("score"))


@query
def trial_wide(spark, sf):
    return trials.trial_wide(
        trial_history(spark, sf), OBJECTIVES, ["model_kind", "extractor_terms"],
        ["accuracy", "training_time"],
    )


@query
def trial_status(spark, sf):
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("trial_index"), "p_size")
    status = F.when(F.col("p_size") <= 40, "completed").otherwise("failed").alias("status")
    recorded = parts.filter("p_size <= 40 or p_size > 45").select("trial_index", status)
    return trials.trial_status(parts, recorded)


@query
def search_summary(spark, sf):
    return trials.search_summary(trial_history(spark, sf), OBJECTIVES)


@query
def search_space_trials(spark, sf):
    indexes = table(spark, sf, "part").select(F.col("p_partkey").alias("trial_index"))
    made = search.sample_trials(indexes, SPACE)
    floats = ("extractor_max_df", "model_C")
    return made.select(*[F.round(c, 9).alias(c) if c in floats else c for c in made.columns])


@query
def experiment_summary(spark, sf):
    parts = table(spark, sf, "part")
    fine = F.col("p_size") > 5
    records = parts.select(
        F.when(fine, "success").otherwise("failed").alias("status"),
        F.when(fine, F.col("p_retailprice")).alias("accuracy"),
        F.when(fine, F.col("p_size").cast("double")).alias("f1_macro"),
        F.when(~fine, F.col("p_name")).alias("error"),
    )
    made = runs.experiment_summary(records)
    return made.withColumn("mean_accuracy", F.round("mean_accuracy", 6))


# Models and runs

WEIGHED = {"extractor": "tfidf_vectorizer", "extractor_params": {"min_df": 2, "max_df": 0.8}}
EMBEDDED = {"extractor": "sentence_embeddings", "extractor_params": {"size": 64}}
# Solved so far that the digits shown do not depend on the way.
SOLVED = {"model_params": {"tol": 1e-9}}


def judged(df: DataFrame, *kept: str, digits: int = 4) -> DataFrame:
    """The predicted class, its name and the highest probability."""
    confidence = F.array_max(vector_to_array("probability"))
    return df.select(
        *kept, "prediction", "prediction_name", F.round(confidence, digits).alias("confidence")
    )


def scored(result: runs.RunResult, digits: int = 4) -> DataFrame:
    """The test side with its predictions."""
    return judged(result.predictions, "doc_id", "target", digits=digits)


def classification_scores(spark, sf) -> DataFrame:
    return runs.classification_run(labelled(spark, sf), use_class_weights=True, **WEIGHED).metrics


@query
def classification_run(spark, sf):
    """Sizes and scores of a run."""
    made = runs.classification_run(
        labelled(spark, sf), use_class_weights=True, **EMBEDDED, **SOLVED
    ).metrics
    names = ("accuracy", "precision_macro", "recall_macro", "f1_macro", "f1_weighted")
    return made.select(
        F.col("n_train").cast("bigint"), F.col("n_test").cast("bigint"),
        *[F.round(n, 9).alias(n) for n in names],
    )


@query
def run_metrics(spark, sf):
    """Metrics of a run that are asked for by name."""
    names = ["roc_auc", "average_precision", "log_loss", "brier_score", "f1_macro"]
    scores = runs.classification_run(
        labelled(spark, sf), metrics=names, **EMBEDDED, **SOLVED
    ).metrics
    return scores.select(*[F.round(n, 4).alias(n) for n in names])


@query
def logreg(spark, sf):
    return scored(runs.classification_run(labelled(spark, sf), **EMBEDDED, **SOLVED))


@query
def logreg_terms(spark, sf):
    return scored(runs.classification_run(labelled(spark, sf), **WEIGHED))


@query
def class_weighted_training(spark, sf):
    rows = labelled(spark, sf, "toxic")
    return scored(runs.classification_run(rows, use_class_weights=True, **EMBEDDED, **SOLVED))


@query
def mlp(spark, sf):
    return scored(
        runs.classification_run(
            labelled(spark, sf), model="neural_network", use_class_weights=True,
            model_params={"hidden_size": 32, "epochs": 30}, **EMBEDDED,
        )
    )


@query
def mlp_simple(spark, sf):
    return scored(
        runs.classification_run(
            labelled(spark, sf), model="neural_network_simple",
            model_params={"hidden_size": 32, "epochs": 30}, **EMBEDDED,
        )
    )


@query
def knn_classifier(spark, sf):
    result = runs.classification_run(
        labelled(spark, sf), model="knn_classifier", use_class_weights=True, **EMBEDDED
    )
    return scored(result, 6)


@query
def gbt_classifier(spark, sf):
    return scored(
        runs.classification_run(
            labelled(spark, sf), model="gbt_classifier", use_class_weights=True,
            model_params={"n_estimators": 3, "max_depth": 3, "binning": "width"}, **EMBEDDED,
        )
    )


@query
def gbt_multiclass(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding", F.col("label").alias("target"))
    result = runs.classification_run(
        rows, "column", "gbt_classifier", {"column": "embedding"},
        {"n_estimators": 2, "max_depth": 3, "binning": "width"}, identifier="vec_id",
    )
    return judged(result.predictions, "vec_id", "target")


@query
def mlp_terms(spark, sf):
    return scored(
        runs.classification_run(
            labelled(spark, sf), "tfidf_vectorizer", "neural_network_simple",
            {"max_features": 5000}, {"hidden_size": 32, "epochs": 10},
        )
    )


@query
def gbt_regressor(spark, sf):
    rows = spread_groups(table(spark, sf, "lineitem"))
    made = columns.assemble_features(
        rows.withColumnRenamed("l_extendedprice", "label"), ["l_quantity", "l_discount", "l_tax"]
    )
    trees = make_model("gbt_regressor", n_estimators=3, max_depth=3, binning="width").fit(made)
    guessed = trees.transform(made)
    return guessed.select(
        "l_orderkey", "l_linenumber", "label", F.round("prediction", 4).alias("prediction")
    )


@query
def word2vec_fit(spark, sf):
    model = pooling.word2vec_fit(
        documents_of(spark, sf), vector_size=16, min_count=5, epochs=1
    )
    return pooling.word_vectors(model).select("word", F.posexplode("vector").alias("dim", "value"))


@query
def word2vec_words(spark, sf):
    """The words that have a vector, and its size."""
    model = pooling.word2vec_fit(
        documents_of(spark, sf), vector_size=16, min_count=5, epochs=1
    )
    return pooling.word_vectors(model).select("word", F.size("vector").alias("n_dims"))


def pooled_documents(spark, sf) -> DataFrame:
    documents = documents_of(spark, sf)
    model = pooling.word2vec_fit(documents, vector_size=16, min_count=5, epochs=1)
    return pooling.word2vec_embed(documents, model)


@query
def word2vec_embed(spark, sf):
    made = pooled_documents(spark, sf)
    return made.select("doc_id", F.posexplode("embedding").alias("dim", "value"))


@query
def word2vec_known(spark, sf):
    """How many words of each document have a vector."""
    return pooled_documents(spark, sf).select("doc_id", F.col("n_known").cast("bigint").alias("n_known"))


@query
def score_text(spark, sf):
    fitted = runs.classification_run(labelled(spark, sf), **EMBEDDED, **SOLVED).fitted
    return judged(runs.score_text(fitted, documents_of(spark, sf)), "doc_id")


@query
def score_stream(spark, sf):
    fitted = runs.classification_run(labelled(spark, sf), **WEIGHED).fitted
    documents = documents_of(spark, sf)
    incoming = fresh_path(spark, "incoming")
    documents.write.parquet(incoming)
    texts = spark.readStream.schema(documents.schema).parquet(incoming)
    output = fresh_path(spark, "scored")
    score.score_stream(fitted, texts, output, fresh_path(spark, "progress")).awaitTermination()
    streamed = spark.read.parquet(output).select(
        "doc_id", "prediction_name", F.col("probability").alias("chances")
    )
    batch = runs.score_text(fitted, documents).select(
        "doc_id", F.col("prediction_name").alias("name"), "probability"
    )
    apart = F.zip_with(
        vector_to_array("chances"), vector_to_array("probability"), lambda a, b: F.abs(a - b)
    )
    same = (F.col("name") == F.col("prediction_name")) & (F.array_max(apart) < 1e-9)
    return streamed.join(batch, "doc_id").select("doc_id", same.alias("as_in_batch"))


def streamed(rows: DataFrame) -> DataFrame:
    """The rows as a stream of files."""
    incoming = fresh_path(rows.sparkSession, "incoming")
    rows.write.parquet(incoming)
    return rows.sparkSession.readStream.schema(rows.schema).parquet(incoming)


@query
def score_stream_neighbours(spark, sf):
    """The test side scored as a stream that meets the training rows."""
    result = runs.classification_run(
        labelled(spark, sf), model="knn_classifier", use_class_weights=True, **EMBEDDED
    )
    tested = documents_of(spark, sf).join(result.predictions.select("doc_id"), "doc_id", "left_semi")
    output = fresh_path(spark, "scored")
    score.score_stream(
        result.fitted, streamed(tested), output, fresh_path(spark, "progress")
    ).awaitTermination()
    return judged(score.read_batches(spark, output), "doc_id", digits=6)


@query
def pool_stream(spark, sf):
    """Documents as a stream, pooled over a table of word vectors."""
    output = fresh_path(spark, "pooled")
    score.pool_stream(
        streamed(documents_of(spark, sf)), hashed_word_vectors(spark, sf), 8, output,
        fresh_path(spark, "progress"),
    ).awaitTermination()
    wide = columns.expand_vector(score.read_batches(spark, output), "embedding", 8)
    return wide.select(
        "doc_id", "n_known", *[F.round(f"embedding_{i}", 6).alias(f"d{i}") for i in range(8)]
    )


@query
def experiment_suite(spark, sf):
    weighted = {"extractor": "sentence_embeddings", "extractor_params": {"size": 32}}
    configs = [
        {"description": "plain", **EMBEDDED, **SOLVED},
        {"description": "weighted", "use_class_weights": True, **weighted,
         "model_params": {"tol": 1e-9, "C": 0.5}},
        {"extractor": "no such extractor", "description": "a failure"},
    ]
    made = runs.experiment_suite(spark, configs, labelled(spark, sf), parallel=2)
    cells = F.flatten("performance.confusion_matrix")
    return made.select(
        "experiment_id", "description", "status",
        F.aggregate(cells, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n_test"),
        *[F.round(f"performance.{n}", 9).alias(n) for n in ("accuracy", "f1_macro", "f1_weighted")],
        F.substring("error", 1, 17).alias("error"),
    )


@query
def run_trials(spark, sf):
    space = search.SearchSpace(
        {"size": search.Parameter("choice", "int", values=[32, 64])},
        {"C": search.Parameter("range", "float", 0.01, 1.0, log=True)},
    )
    made = search.hyperparameter_search(
        labelled(spark, sf), fresh_path(spark, "search"), "sentence_embeddings", space=space,
        total_trials=3, **SOLVED,
    )
    return made.select(
        "trial_index", "status",
        F.element_at("params", "extractor_size").cast("bigint").alias("size"),
        F.round(F.element_at("params", "model_C").cast("double"), 9).alias("C"),
        F.round(trials.metric_value("accuracy"), 9).alias("accuracy"),
        F.round(trials.metric_value("f1_score"), 9).alias("f1_score"),
    )
