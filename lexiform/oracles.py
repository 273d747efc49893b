"""The registered queries as SQL for DuckDB, over whole tables."""

from __future__ import annotations

import hashlib
import math

from lexiform.functions.stop_words import ENGLISH

ORACLES: dict[str, str] = {}

LABELLED = (
    "SELECT d.doc_id, d.text, l.{target} AS target FROM documents d JOIN labels l USING (doc_id)"
)
QUALITY = LABELLED.format(target="quality")
STOP = ", ".join("'" + word.replace("'", "''") + "'" for word in ENGLISH)
WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"
SPACES = (
    r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
)
PIECES = f"list_filter(string_split_regex(lower(text), '{SPACES}'), lambda x: x <> '')"


def split_rows(rows: str, key: str, target: str = "target", kept: str = "") -> str:
    """Rows of a source with their side of the stratified split."""
    extra = f", {kept}" if kept else ""
    return f"""
    SELECT {key}, {target}{extra}, CASE WHEN rn <= quota THEN 'train' ELSE 'test' END AS split
    FROM (
        SELECT *, row_number() OVER (
            PARTITION BY {target} ORDER BY md5(CAST({key} AS VARCHAR) || ':42'), {key}) AS rn
        FROM ({rows}) s0
    ) s1 JOIN (
        SELECT {target}, base + CASE WHEN place <= n_train - sum(base) OVER () THEN 1 ELSE 0 END
            AS quota
        FROM (
            SELECT {target}, n_train, (n * n_train) // total AS base,
                row_number() OVER (ORDER BY (n * n_train) % total DESC, {target}) AS place
            FROM (
                SELECT {target}, n, total,
                    total - CAST(ceil(CAST(0.2 AS DOUBLE) * total) AS BIGINT) AS n_train
                FROM (
                    SELECT {target}, n, CAST(sum(n) OVER () AS BIGINT) AS total
                    FROM (SELECT {target}, count(*) AS n FROM ({rows}) s2 GROUP BY {target}) s3
                ) s4
            ) s5
        ) s6
    ) s7 USING ({target})"""


# Sources

ORACLES["load_delimited"] = f"SELECT doc_id, text, target FROM ({QUALITY}) t"

ORACLES["load_category_corpus"] = """
SELECT doc_id, text, CAST(dense_rank() OVER (ORDER BY source) - 1 AS INTEGER) AS target,
    source AS target_name,
    row_number() OVER (ORDER BY md5(CAST(doc_id AS VARCHAR) || ':42'), doc_id) AS position
FROM documents"""

ORACLES["category_filter"] = """
SELECT doc_id, lang, source, n_chars FROM documents WHERE lang IN ('fr', 'de')"""

ORACLES["class_distribution"] = f"""
SELECT target, 'class_' || CAST(target AS VARCHAR) AS target_name, n,
    CAST(sum(n) OVER () AS BIGINT) AS n_samples, count(*) OVER () AS n_classes
FROM (SELECT target, count(*) AS n FROM ({QUALITY}) t GROUP BY target) c"""

ORACLES["target_names"] = """
SELECT DISTINCT label AS target, 'class_' || CAST(label AS VARCHAR) AS target_name
FROM embeddings"""

ORACLES["dataset_summary"] = f"""
SELECT split, target, count(*) AS n, CAST(grouping(split) AS INTEGER) AS all_splits,
    CAST(grouping(target) AS INTEGER) AS all_targets
FROM ({split_rows(QUALITY, 'doc_id')}) t
GROUP BY GROUPING SETS ((split, target), (split), (target), ())"""

HISTORY = """
SELECT p_partkey AS trial_index, p_retailprice AS accuracy,
    CAST(p_size AS DOUBLE) AS training_time, p_type, p_size
FROM part WHERE p_size > 2"""
GAPPED = """
SELECT p_partkey AS trial_index, CASE WHEN p_brand <> 'Brand#7' THEN p_retailprice END AS accuracy,
    CAST(p_size AS DOUBLE) AS training_time
FROM part WHERE p_size > 2"""

ORACLES["trial_table"] = """
SELECT p_partkey AS trial_index, 'trial-' || CAST(p_partkey AS VARCHAR) AS trial_id,
    CASE WHEN p_size <= 2 THEN 'failed' ELSE 'completed' END AS status,
    p_type AS model_kind,
    CASE WHEN p_size > 2 THEN p_retailprice END AS accuracy,
    CASE WHEN p_size > 2 THEN CAST(p_size AS DOUBLE) END AS metric_time,
    CAST(CASE WHEN p_size > 2 THEN 2 ELSE 0 END AS INTEGER) AS n_metrics,
    CAST(p_size AS DOUBLE) AS training_time,
    CASE WHEN p_size <= 2 THEN 'no result' END AS error
FROM part"""

# Columns and rows

ORACLES["standardize"] = """
SELECT p_partkey AS doc_id, p_name AS text, p_size AS target
FROM part WHERE p_type <> 'SMALL' AND p_size > 3"""

ORACLES["select_features"] = """
SELECT l_shipdate, l_partkey, l_suppkey, l_linenumber, l_quantity FROM lineitem"""

ORACLES["concat_text"] = """
SELECT p_partkey, concat_ws(' ', p_name, p_brand, CASE WHEN p_type <> 'SMALL' THEN p_type ELSE '' END,
    CAST(p_size AS VARCHAR)) AS text
FROM part"""

ORACLES["expand_vector"] = (
    "SELECT vec_id, label, "
    + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS embedding_{i}" for i in range(64))
    + " FROM embeddings"
)

ORACLES["assemble_features"] = """
SELECT l_orderkey, l_linenumber, l_quantity AS features_0, l_discount AS features_1,
    l_tax AS features_2
FROM lineitem"""

# Text functions


def token_lists(tokens: str) -> str:
    return f"""
    SELECT doc_id, array_to_string(t, ' ') AS tokens, CAST(len(t) AS INTEGER) AS n
    FROM (SELECT doc_id, {tokens} AS t FROM documents) d"""


ORACLES["tokenize_words"] = token_lists(WORDS)
ORACLES["tokenize_whitespace"] = token_lists(PIECES)
ORACLES["strip_accents"] = "SELECT doc_id, strip_accents(text) AS text FROM documents"
ORACLES["remove_stop_words"] = token_lists(f"list_filter({WORDS}, lambda x: x NOT IN ({STOP}))")

# Vector functions

LONG = """
SELECT vec_id, label, CAST(unnest(range(0, 64)) AS INTEGER) AS dim,
    CAST(unnest(embedding) AS DOUBLE) AS v
FROM embeddings"""

ORACLES["l2_normalize"] = f"""
SELECT vec_id, dim, round(v / sqrt(sum(v * v) OVER (PARTITION BY vec_id)), 6) AS value
FROM ({LONG}) t"""

ORACLES["softmax"] = f"""
SELECT vec_id, dim, round(exp(v) / sum(exp(v)) OVER (PARTITION BY vec_id), 6) AS value
FROM ({LONG}) t"""

ORACLES["minkowski_distance"] = f"""
SELECT a.vec_id, round(sum(abs(a.v - b.v)), 6) AS d1,
    round(sqrt(sum((a.v - b.v) * (a.v - b.v))), 6) AS d2,
    round(pow(sum(pow(abs(a.v - b.v), 3.0)), CAST(1 AS DOUBLE) / 3), 6) AS d3
FROM ({LONG}) a JOIN ({LONG}) b ON a.vec_id = b.vec_id AND a.dim = 63 - b.dim
GROUP BY a.vec_id"""

ORACLES["decide_class"] = """
SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS by_argmax,
    CAST(s > 0.5 AS INTEGER) AS by_threshold,
    CAST(CASE WHEN s BETWEEN 0 AND 1 THEN CAST(s > 0.5 AS INTEGER) ELSE trunc(s) END AS INTEGER)
        AS by_score,
    CAST(CASE WHEN s BETWEEN 0 AND 1 THEN round_even(s, 0) ELSE trunc(s) END AS INTEGER)
        AS by_rounding,
    label AS by_label
FROM (SELECT *, CAST(embedding[1] AS DOUBLE) * 4 AS s FROM embeddings) t"""

# Splits and weights

ORACLES["stratified_split"] = split_rows(QUALITY, "doc_id")

ORACLES["shuffle_rows"] = """
SELECT doc_id, source,
    row_number() OVER (ORDER BY md5(CAST(doc_id AS VARCHAR) || ':42'), doc_id) AS position
FROM documents"""

WEIGHTS = f"""
SELECT target, n, CAST(sum(n) OVER () AS DOUBLE) / (n * count(*) OVER ()) AS weight
FROM (SELECT target, count(*) AS n FROM ({QUALITY}) t GROUP BY target) c"""

ORACLES["class_weights"] = f"SELECT target, n, round(weight, 9) AS weight FROM ({WEIGHTS}) w"

ORACLES["weighted_rows"] = f"""
SELECT r.doc_id, r.target, round(coalesce(w.weight, 1.0), 9) AS weight
FROM ({QUALITY}) r LEFT JOIN (SELECT * FROM ({WEIGHTS}) w0 WHERE weight < 1) w USING (target)"""

ORACLES["label_predictions"] = """
SELECT l.doc_id, l.quality AS target, l.toxic AS prediction,
    n.target_name AS prediction_name
FROM labels l LEFT JOIN (
    SELECT DISTINCT quality AS code, 'class_' || CAST(quality AS VARCHAR) AS target_name FROM labels
) n ON l.toxic = n.code"""

# Features

VOCABULARY = f"""
SELECT term, tf, df, n_docs FROM (
    SELECT term, CAST(sum(c) AS BIGINT) AS tf, count(*) AS df,
        (SELECT count(*) FROM documents) AS n_docs
    FROM (
        SELECT doc_id, term, count(*) AS c
        FROM (SELECT doc_id, unnest({WORDS}) AS term FROM documents) t
        WHERE term NOT IN ({STOP}) GROUP BY doc_id, term
    ) p GROUP BY term
) v WHERE df >= 2 AND df <= CAST(0.8 AS DOUBLE) * n_docs
ORDER BY tf DESC, term LIMIT 10000"""

ORACLES["vocabulary"] = VOCABULARY

ORACLES["idf"] = f"""
SELECT term, round(ln(CAST(n_docs + 1 AS DOUBLE) / (df + 1)) + 1, 6) AS smooth,
    round(ln(CAST(n_docs AS DOUBLE) / df) + 1, 6) AS plain, CAST(1 AS DOUBLE) AS off
FROM ({VOCABULARY}) v"""

TERM_COUNTS = f"""
SELECT t.doc_id, t.term, v.df, v.n_docs, count(*) AS tf
FROM (SELECT doc_id, unnest({WORDS}) AS term FROM documents) t JOIN ({VOCABULARY}) v USING (term)
GROUP BY t.doc_id, t.term, v.df, v.n_docs"""

ORACLES["count_vectorize"] = f"SELECT doc_id, term, tf FROM ({TERM_COUNTS}) c"


def weighed_terms(counts: str, tf: str) -> str:
    return f"""
    SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight
    FROM (
        SELECT doc_id, term, {tf} * (ln(CAST(n_docs + 1 AS DOUBLE) / (df + 1)) + 1) AS w
        FROM ({counts}) c
    ) x"""


ORACLES["tfidf_vectorize"] = weighed_terms(TERM_COUNTS, "tf")
ORACLES["tfidf_sublinear"] = weighed_terms(
    TERM_COUNTS.replace("lower(text)", "lower(strip_accents(text))"), "(1 + ln(tf))"
)

ALL_TERMS = f"""
SELECT term, CAST(sum(c) AS BIGINT) AS tf, count(*) AS df FROM (
    SELECT doc_id, term, count(*) AS c
    FROM (SELECT doc_id, unnest({WORDS}) AS term FROM documents) t
    WHERE term NOT IN ({STOP}) GROUP BY doc_id, term
) p GROUP BY term"""

ORACLES["numbered_terms"] = f"""
SELECT term, tf, df, row_number() OVER (ORDER BY term) - 1 AS index
FROM ({ALL_TERMS}) v WHERE df >= 2"""

ORACLES["tfidf_all_terms"] = f"""
WITH v AS (SELECT *, row_number() OVER (ORDER BY term) - 1 AS index FROM ({ALL_TERMS}) a),
weighed AS (
    SELECT doc_id, index,
        count(*) * (ln(CAST((SELECT count(*) FROM documents) + 1 AS DOUBLE) / (any_value(df) + 1)) + 1) AS w
    FROM (SELECT doc_id, unnest({WORDS}) AS term FROM documents) t JOIN v USING (term)
    GROUP BY doc_id, index)
SELECT doc_id, CAST(index AS INTEGER) AS index,
    round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight
FROM weighed"""


def hashed_sums(size: int = 64) -> str:
    return f"""
    SELECT doc_id, CAST(CAST('0x' || substring(h, 1, 8) AS BIGINT) % {size} AS INTEGER) AS dim,
        CAST(sum(CASE WHEN CAST('0x' || substring(h, 9, 1) AS BIGINT) % 2 = 1 THEN 1 ELSE -1 END)
            AS DOUBLE) AS s
    FROM (SELECT doc_id, md5(term) AS h
          FROM (SELECT doc_id, unnest({WORDS}) AS term FROM documents) t) m
    GROUP BY 1, 2"""


HASHED = f"""
SELECT doc_id, dim, round(s / sqrt(sum(s * s) OVER (PARTITION BY doc_id)), 6) AS value
FROM ({hashed_sums()}) x WHERE s <> 0"""

# Entries other than 0, and the first one of every document.
HASHED_ROWS = f"""
SELECT doc_id, dim, value FROM ({HASHED}) h
UNION ALL
SELECT doc_id, 0 AS dim, 0.0 AS value FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM ({HASHED}) z WHERE dim = 0)"""

ORACLES["embed_text"] = HASHED_ROWS
ORACLES["embed_text_batched"] = (
    f"SELECT doc_id, true AS embed_ok, dim, value FROM ({HASHED_ROWS}) h"
)

ORACLES["mean_pool"] = f"""
WITH tokens AS (SELECT doc_id, unnest({PIECES}) AS word FROM documents),
known AS (
    SELECT word, {', '.join(f"CAST('0x' || substring(md5(word), {4 * i + 1}, 4) AS BIGINT) / CAST(65535 AS DOUBLE) - CAST(0.5 AS DOUBLE) AS v{i}" for i in range(8))}
    FROM (SELECT word FROM tokens GROUP BY word HAVING count(*) >= 2) k
),
pooled AS (
    SELECT doc_id, count(*) AS n_known, {', '.join(f'avg(v{i}) AS m{i}' for i in range(8))}
    FROM tokens JOIN known USING (word) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_known, 0) AS n_known,
    {', '.join(f'round(coalesce(m{i}, 0), 6) AS d{i}' for i in range(8))}
FROM documents d LEFT JOIN pooled USING (doc_id)"""

VECTORS = "SELECT vec_id, label AS target, embedding FROM embeddings"
SPLIT_VECTORS = split_rows(VECTORS, "vec_id", kept="embedding")

ORACLES["standardize_features"] = f"""
WITH rows AS ({SPLIT_VECTORS}),
long AS (SELECT vec_id, split, CAST(unnest(range(0, 64)) AS INTEGER) AS dim,
    CAST(unnest(embedding) AS DOUBLE) AS v FROM rows),
moments AS (SELECT dim, avg(v) AS m, stddev_pop(v) AS s FROM long WHERE split = 'train' GROUP BY dim)
SELECT vec_id, dim, round((v - m) / CASE WHEN s > 0 THEN s ELSE 1 END, 6) AS value
FROM long JOIN moments USING (dim)"""

# Metrics

PAIRS = "SELECT quality AS y_true, toxic AS y_pred FROM labels"

ORACLES["confusion_matrix"] = f"""
WITH pairs AS ({PAIRS}),
seen AS (SELECT y_true AS label FROM pairs UNION SELECT y_pred FROM pairs),
cells AS (SELECT y_true, y_pred, count(*) AS n FROM pairs GROUP BY 1, 2)
SELECT a.label AS y_true, b.label AS y_pred, coalesce(n, 0) AS n
FROM seen a CROSS JOIN seen b LEFT JOIN cells c ON c.y_true = a.label AND c.y_pred = b.label"""

ORACLES["accuracy"] = f"""
SELECT round(avg(CAST(y_true = y_pred AS DOUBLE)), 9) AS accuracy, count(*) AS n
FROM ({PAIRS}) p"""


def class_scores(pairs: str) -> str:
    return f"""
    SELECT label, tp, CASE WHEN pred > 0 THEN tp / pred ELSE 0 END AS precision,
        CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall,
        CASE WHEN pred + support > 0 THEN 2 * tp / (pred + support) ELSE 0 END AS f1, support
    FROM (
        SELECT label, CAST(sum(hit) AS DOUBLE) AS tp, CAST(sum(t) AS BIGINT) AS support,
            CAST(sum(p) AS BIGINT) AS pred
        FROM (
            SELECT y_true AS label, CAST(y_true = y_pred AS INTEGER) AS hit, 1 AS t, 0 AS p
            FROM ({pairs}) p1
            UNION ALL SELECT y_pred, 0, 0, 1 FROM ({pairs}) p2
        ) u GROUP BY label
    ) s"""


ORACLES["f1_scores"] = f"""
SELECT round(sum(tp) / sum(support), 9) AS accuracy,
    round(avg(precision), 9) AS precision_macro, round(avg(recall), 9) AS recall_macro,
    round(avg(f1), 9) AS f1_macro,
    round(sum(precision * support) / sum(support), 9) AS precision_weighted,
    round(sum(recall * support) / sum(support), 9) AS recall_weighted,
    round(sum(f1 * support) / sum(support), 9) AS f1_weighted,
    CAST(sum(support) AS BIGINT) AS support
FROM ({class_scores(PAIRS)}) c"""

RANKED = """
SELECT quality = 1 AS pos, n_chars // 100 AS score FROM labels JOIN documents USING (doc_id)
WHERE quality IS NOT NULL"""


def ranking(pairs: str) -> str:
    """Pairs won, ties as half, and precision at the distinct scores by the recall that they add."""
    return f"""
    SELECT sum(pos * (neg_below + CAST(neg AS DOUBLE) / 2)) / (any_value(p) * any_value(n)) AS roc_auc,
        sum(CAST(pos * pos_above AS DOUBLE) / (pos_above + neg_above)) / any_value(p)
            AS average_precision,
        CAST(any_value(p) AS BIGINT) AS n_positive, CAST(any_value(n) AS BIGINT) AS n_negative
    FROM (
        SELECT *, coalesce(sum(neg) OVER (
                ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below,
            sum(pos) OVER (ORDER BY score DESC) AS pos_above,
            sum(neg) OVER (ORDER BY score DESC) AS neg_above,
            sum(pos) OVER () AS p, sum(neg) OVER () AS n
        FROM (
            SELECT score, count(*) FILTER (WHERE pos) AS pos, count(*) FILTER (WHERE NOT pos) AS neg
            FROM ({pairs}) s0 GROUP BY score) s1) s2"""


ORACLES["ranking_scores"] = f"""
SELECT round(roc_auc, 9) AS roc_auc, round(average_precision, 9) AS average_precision,
    n_positive, n_negative
FROM ({ranking(RANKED)}) r"""

# Neighbours

NEAR = f"""
SELECT query_id, neighbour_id, label, distance, CAST(rank AS INTEGER) AS rank FROM (
    SELECT query_id, neighbour_id, label, distance,
        row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS rank
    FROM (
        SELECT q.vec_id AS query_id, t.vec_id AS neighbour_id, t.target AS label,
            round(list_distance(CAST(q.embedding AS DOUBLE[]), CAST(t.embedding AS DOUBLE[])), 9)
                AS distance
        FROM ({SPLIT_VECTORS}) q JOIN ({SPLIT_VECTORS}) t ON q.split = 'test' AND t.split = 'train'
    ) d
) r WHERE rank <= 5"""

ORACLES["k_nearest"] = f"""
SELECT query_id, neighbour_id, label, round(distance, 6) AS distance, rank FROM ({NEAR}) n"""

ORACLES["k_nearest_pivots"] = ORACLES["k_nearest"]

PREDICT = f"""
SELECT query_id, label AS prediction FROM (
    SELECT query_id, label,
        row_number() OVER (PARTITION BY query_id ORDER BY count(*) DESC, label) AS place
    FROM ({NEAR}) n GROUP BY query_id, label
) v WHERE place = 1"""

ORACLES["knn_predict"] = PREDICT

ORACLES["knn_proba"] = f"""
WITH near AS (
    SELECT query_id, label, CASE WHEN min(distance) OVER (PARTITION BY query_id) = 0
        THEN CAST(distance = 0 AS DOUBLE) ELSE 1 / distance END AS w
    FROM ({NEAR}) n
),
classes AS (SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS class
            FROM (SELECT DISTINCT label FROM embeddings) e),
total AS (SELECT query_id, sum(w) AS w FROM near GROUP BY query_id),
part AS (SELECT query_id, label, sum(w) AS w FROM near GROUP BY query_id, label)
SELECT t.query_id, c.class, round(coalesce(p.w, 0) / t.w, 6) AS proba
FROM total t CROSS JOIN classes c
LEFT JOIN part p ON p.query_id = t.query_id AND p.label = c.label"""

ORACLES["probability_columns"] = (
    "SELECT query_id, "
    + ", ".join(
        f"round(CAST(sum(CASE WHEN label = {i} THEN 1 ELSE 0 END) AS DOUBLE) / count(*), 6)"
        f" AS prediction_proba_{i}"
        for i in range(10)
    )
    + f" FROM ({NEAR}) n GROUP BY query_id"
)


def dense(rows: str, size: int = 64) -> str:
    """Rows of doc_id and target with the hashed vector of their document."""
    return f"""
    SELECT p.doc_id, p.target, list(coalesce(h.value, 0) ORDER BY p.dim) AS v
    FROM (
        SELECT doc_id, target, CAST(unnest(range(0, {size})) AS INTEGER) AS dim FROM ({rows}) q
    ) p
    LEFT JOIN (
        SELECT doc_id, dim, s / sqrt(sum(s * s) OVER (PARTITION BY doc_id)) AS value
        FROM ({hashed_sums(size)}) x WHERE s <> 0
    ) h ON h.doc_id = p.doc_id AND h.dim = p.dim
    GROUP BY p.doc_id, p.target"""


ORACLES["knn_classifier"] = f"""
WITH rows AS MATERIALIZED ({split_rows(dense(QUALITY), 'doc_id', kept='v')}),
near AS (
    SELECT query_id, truth, label, distance FROM (
        SELECT q.doc_id AS query_id, q.target AS truth, t.target AS label,
            round(list_distance(q.v, t.v), 9) AS distance,
            row_number() OVER (
                PARTITION BY q.doc_id ORDER BY round(list_distance(q.v, t.v), 9), t.doc_id) AS rank
        FROM rows q JOIN rows t ON q.split = 'test' AND t.split = 'train'
    ) r WHERE rank <= 5
),
weighed AS (
    SELECT query_id, truth, label, CASE WHEN min(distance) OVER (PARTITION BY query_id) = 0
        THEN CAST(distance = 0 AS DOUBLE) ELSE 1 / distance END AS w
    FROM near
),
votes AS (SELECT query_id, truth, label, sum(w) AS w FROM weighed GROUP BY 1, 2, 3),
best AS (
    SELECT query_id, truth, label, w / sum(w) OVER (PARTITION BY query_id) AS share,
        row_number() OVER (PARTITION BY query_id ORDER BY round(w, 9) DESC, label) AS place
    FROM votes
)
SELECT query_id AS doc_id, truth AS target, label AS prediction,
    'class_' || CAST(label AS VARCHAR) AS prediction_name, round(share, 6) AS confidence
FROM best WHERE place = 1"""

ORACLES["score_stream_neighbours"] = (
    f"SELECT * EXCLUDE (target) FROM ({ORACLES['knn_classifier']}) k"
)
ORACLES["pool_stream"] = ORACLES["mean_pool"]

JUDGED = f"""
SELECT v.label AS y_true, p.prediction AS y_pred
FROM ({PREDICT}) p JOIN embeddings v ON v.vec_id = p.query_id"""

ORACLES["classification_report"] = f"""
WITH pairs AS MATERIALIZED ({JUDGED}), c AS ({class_scores('SELECT * FROM pairs')}),
rows AS (
    SELECT CAST(label AS VARCHAR) AS label, precision, recall, f1, support FROM c
    UNION ALL SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support),
        sum(tp) / sum(support), CAST(sum(support) AS BIGINT) FROM c
    UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1),
        CAST(sum(support) AS BIGINT) FROM c
    UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support),
        sum(recall * support) / sum(support), sum(f1 * support) / sum(support),
        CAST(sum(support) AS BIGINT) FROM c
)
SELECT label, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1,
    support
FROM rows"""

# Trials

ORACLES["best_trial"] = f"""
SELECT objective, minimize, trial_index, value FROM (
    SELECT 'accuracy' AS objective, false AS minimize, trial_index, accuracy AS value,
        row_number() OVER (ORDER BY accuracy DESC, trial_index) AS place
    FROM ({GAPPED}) g WHERE accuracy IS NOT NULL
    UNION ALL
    SELECT 'training_time', true, trial_index, training_time,
        row_number() OVER (ORDER BY training_time, trial_index)
    FROM ({GAPPED}) g
) b WHERE place = 1"""

ORACLES["convergence"] = f"""
SELECT trial_index, 'accuracy' AS objective, accuracy AS value,
    max(accuracy) OVER (ORDER BY trial_index ROWS UNBOUNDED PRECEDING) AS best
FROM ({GAPPED}) g
UNION ALL
SELECT trial_index, 'training_time', training_time,
    min(training_time) OVER (ORDER BY trial_index ROWS UNBOUNDED PRECEDING)
FROM ({GAPPED}) g"""

ORACLES["threshold_filter"] = f"""
SELECT trial_index, accuracy, training_time FROM ({GAPPED}) g
WHERE accuracy >= 910 AND training_time <= 30"""

FRONTIER = f"""
SELECT trial_index, accuracy, training_time FROM ({HISTORY}) a WHERE NOT EXISTS (
    SELECT 1 FROM ({HISTORY}) b
    WHERE b.accuracy > a.accuracy AND b.training_time < a.training_time)"""

ORACLES["pareto_frontier"] = FRONTIER

ORACLES["pareto_frontier_weak"] = f"""
SELECT trial_index, accuracy, training_time FROM ({HISTORY}) a WHERE NOT EXISTS (
    SELECT 1 FROM ({HISTORY}) b
    WHERE b.accuracy >= a.accuracy AND b.training_time <= a.training_time
        AND (b.accuracy > a.accuracy OR b.training_time < a.training_time))"""

ORACLES["pareto_frontier_gaps"] = f"""
WITH t AS (SELECT *, CAST(trial_index * 7919 % 1009 AS DOUBLE) AS model_size FROM ({GAPPED}) g)
SELECT * FROM t a WHERE NOT EXISTS (
    SELECT 1 FROM t b
    WHERE coalesce(b.accuracy >= a.accuracy, true) AND b.training_time <= a.training_time
        AND b.model_size <= a.model_size
        AND (coalesce(b.accuracy > a.accuracy, false) OR b.training_time < a.training_time
            OR b.model_size < a.model_size))"""

ORACLES["recommend_configs"] = f"""
SELECT trial_index, round((CAST(0.7 AS DOUBLE) * accuracy + CAST(0.3 AS DOUBLE)
    / (1 + training_time)) / CAST(1 AS DOUBLE), 6) AS score
FROM ({FRONTIER}) f"""

ORACLES["trial_wide"] = f"""
SELECT h.trial_index, 'COMPLETED' AS status, f.trial_index IS NOT NULL AS is_pareto_optimal,
    h.p_type AS param_model_kind, CAST(h.p_size * 100 AS VARCHAR) AS param_extractor_terms,
    h.accuracy AS metric_accuracy, h.training_time AS metric_training_time
FROM ({HISTORY}) h LEFT JOIN ({FRONTIER}) f USING (trial_index)"""

ORACLES["trial_status"] = """
SELECT p_partkey AS trial_index, CASE WHEN p_size <= 40 THEN 'completed'
    WHEN p_size > 45 THEN 'failed' ELSE 'running' END AS status
FROM part"""

ORACLES["search_summary"] = f"""
SELECT 'total_trials' AS item, CAST(NULL AS VARCHAR) AS key, CAST(count(*) AS DOUBLE) AS value
FROM ({HISTORY}) h
UNION ALL SELECT 'best_accuracy', CAST(trial_index AS VARCHAR), accuracy FROM (
    SELECT * FROM ({HISTORY}) h ORDER BY accuracy DESC, trial_index LIMIT 1) a
UNION ALL SELECT 'best_training_time', CAST(trial_index AS VARCHAR), training_time FROM (
    SELECT * FROM ({HISTORY}) h ORDER BY training_time, trial_index LIMIT 1) t
UNION ALL SELECT 'frontier', CAST(trial_index AS VARCHAR), NULL FROM ({FRONTIER}) f"""


def draw(name: str) -> str:
    hashed = f"md5(CAST(p_partkey AS VARCHAR) || ':{name}:42')"
    return f"CAST('0x' || substring({hashed}, 1, 8) AS BIGINT) / CAST(4294967296 AS DOUBLE)"


ORACLES["search_space_trials"] = f"""
SELECT p_partkey AS trial_index,
    CAST(([1000, 5000, 10000, 20000, 50000])[CAST(floor({draw('extractor_max_features')} * 5) AS INTEGER) + 1]
        AS BIGINT) AS extractor_max_features,
    CAST(floor(1 + {draw('extractor_min_df')} * 10) AS BIGINT) AS extractor_min_df,
    round(CAST(0.5 AS DOUBLE) + {draw('extractor_max_df')}
        * (CAST(0.95 AS DOUBLE) - CAST(0.5 AS DOUBLE)), 9) AS extractor_max_df,
    round(exp(ln(CAST(0.001 AS DOUBLE)) + {draw('model_C')}
        * (ln(CAST(10 AS DOUBLE)) - ln(CAST(0.001 AS DOUBLE)))), 9) AS model_C,
    CAST(([100, 200, 500, 1000])[CAST(floor({draw('model_max_iter')} * 4) AS INTEGER) + 1]
        AS BIGINT) AS model_max_iter,
    'balanced' AS training_weighting
FROM part"""

ORACLES["experiment_summary"] = """
SELECT CASE WHEN p_size > 5 THEN 'success' ELSE 'failed' END AS status, count(*) AS n,
    round(avg(CASE WHEN p_size > 5 THEN p_retailprice END), 6) AS mean_accuracy,
    max(CASE WHEN p_size > 5 THEN p_retailprice END) AS best_accuracy,
    max(CASE WHEN p_size > 5 THEN CAST(p_size AS DOUBLE) END) AS best_f1_macro,
    count(CASE WHEN p_size <= 5 THEN p_name END) AS n_errors
FROM part GROUP BY 1"""

# Models and runs. The optimum of a penalised logistic regression is unique, so SQL can look for it
# by itself: accelerated gradient descent over vectors of documents, until it stands still.

TOXIC = LABELLED.format(target="toxic")
STEPS = 700


def logistic(
    rows: str, weighted: bool, c: float | str = 1.0, size: int = 64, name: str = "",
    limit: str = "true",
) -> str:
    """Common table expressions split{name} (rows with v and side) and fitted{name} (w, the weights and
    last the intercept) of the training side."""
    weight = "total / (n * classes)" if weighted else "1"
    places = size + 1
    return f"""
    split{name} AS MATERIALIZED ({split_rows(dense(rows, size), 'doc_id', kept='v')}),
    sides{name} AS (
        SELECT target, CAST({weight} AS DOUBLE) AS om FROM (
            SELECT target, count(*) AS n, CAST(sum(count(*)) OVER () AS DOUBLE) AS total,
                count(*) OVER () AS classes
            FROM split{name} WHERE split = 'train' GROUP BY target) t),
    train{name} AS MATERIALIZED (
        SELECT list_append(v, CAST(1 AS DOUBLE)) AS x, CAST(target AS DOUBLE) AS y, om
        FROM split{name} JOIN sides{name} USING (target) WHERE split = 'train' AND {limit}),
    speed{name} AS MATERIALIZED (
        SELECT 1 / l AS step, (sqrt(l * c) - 1) / (sqrt(l * c) + 1) AS beta, 1 / c AS penalty FROM (
            SELECT sum(om) / 2 + 1 / c AS l, c
            FROM train{name}, (SELECT CAST({c} AS DOUBLE) AS c) p GROUP BY c) t),
    descent{name} AS (
        SELECT 0 AS k, list_transform(range({places}), lambda i: CAST(0 AS DOUBLE)) AS w,
            list_transform(range({places}), lambda i: CAST(0 AS DOUBLE)) AS ahead
        UNION ALL
        SELECT k + 1, list(w ORDER BY j), list(w + beta * (w - old) ORDER BY j) FROM (
            SELECT k, j, old, beta,
                here - step * (g + CASE WHEN j < {places} THEN here * penalty ELSE 0 END) AS w
            FROM (
                SELECT k, j, any_value(w[j]) AS old, any_value(ahead[j]) AS here, sum(r * x[j]) AS g
                FROM (
                    SELECT k, w, ahead, x, r, unnest(range(1, {places + 1})) AS j FROM (
                        SELECT k, w, ahead, x,
                            om * (1 / (1 + exp(-list_inner_product(x, ahead))) - y) AS r
                        FROM descent{name}, train{name} WHERE k < {STEPS}) a) b
                GROUP BY k, j) c, speed{name}) d
        GROUP BY k),
    fitted{name} AS MATERIALIZED (SELECT w FROM descent{name} WHERE k = {STEPS}),
    chances{name} AS (
        SELECT doc_id, target, split,
            1 / (1 + exp(-list_inner_product(list_append(v, CAST(1 AS DOUBLE)), w))) AS p
        FROM split{name}, fitted{name})"""


JUDGEMENT = """CAST(p > 0.5 AS INTEGER) AS prediction,
    'class_' || CAST(CAST(p > 0.5 AS INTEGER) AS VARCHAR) AS prediction_name,
    round(greatest(p, 1 - p), 4) AS confidence"""


def logistic_tests(rows: str, weighted: bool) -> str:
    return f"""
    WITH RECURSIVE {logistic(rows, weighted)}
    SELECT doc_id, target, {JUDGEMENT} FROM chances WHERE split = 'test'"""


ORACLES["logreg"] = logistic_tests(QUALITY, False)
ORACLES["class_weighted_training"] = logistic_tests(TOXIC, True)


def test_pairs(name: str = "") -> str:
    return f"""
    SELECT target AS y_true, CAST(p > 0.5 AS INTEGER) AS y_pred
    FROM chances{name} WHERE split = 'test'"""


ORACLES["classification_run"] = f"""
WITH RECURSIVE {logistic(QUALITY, True)}
SELECT count(*) FILTER (WHERE split = 'train') AS n_train,
    count(*) FILTER (WHERE split = 'test') AS n_test, any_value(s.accuracy) AS accuracy,
    any_value(s.precision_macro) AS precision_macro, any_value(s.recall_macro) AS recall_macro,
    any_value(s.f1_macro) AS f1_macro, any_value(s.f1_weighted) AS f1_weighted
FROM chances, (
    SELECT round(sum(tp) / sum(support), 9) AS accuracy,
        round(avg(precision), 9) AS precision_macro, round(avg(recall), 9) AS recall_macro,
        round(avg(f1), 9) AS f1_macro, round(sum(f1 * support) / sum(support), 9) AS f1_weighted
    FROM ({class_scores(test_pairs())}) c) s"""

ORACLES["run_metrics"] = f"""
WITH RECURSIVE {logistic(QUALITY, False)},
tested AS (SELECT target, p FROM chances WHERE split = 'test')
SELECT round(roc_auc, 4) AS roc_auc, round(average_precision, 4) AS average_precision,
    (SELECT round(avg(-ln(CASE WHEN target = 1 THEN p ELSE 1 - p END)), 4) FROM tested) AS log_loss,
    (SELECT round(avg(2 * (p - target) * (p - target)), 4) FROM tested) AS brier_score,
    (SELECT round(avg(f1), 4) FROM ({class_scores(test_pairs())}) c) AS f1_macro
FROM ({ranking('SELECT target = 1 AS pos, p AS score FROM tested')}) r"""

ORACLES["score_text"] = f"""
WITH RECURSIVE {logistic(QUALITY, False)},
scored AS (
    SELECT doc_id, 1 / (1 + exp(-list_inner_product(list_append(v, CAST(1 AS DOUBLE)), w))) AS p
    FROM ({dense('SELECT doc_id, 0 AS target FROM documents')}) d, fitted)
SELECT doc_id, {JUDGEMENT} FROM scored"""


def run_scores(name: str) -> str:
    return f"""
    SELECT round(sum(tp) / sum(support), 9) AS accuracy, round(avg(f1), 9) AS f1_macro,
        round(sum(f1 * support) / sum(support), 9) AS f1_weighted
    FROM ({class_scores(test_pairs(name))}) c"""


ORACLES["experiment_suite"] = f"""
WITH RECURSIVE {logistic(QUALITY, False, 1.0, 64, '1')}, {logistic(QUALITY, True, 0.5, 32, '2')},
made AS (
    SELECT 1 AS e, 'plain' AS d, * FROM ({run_scores('1')}) a
    UNION ALL SELECT 2, 'weighted', * FROM ({run_scores('2')}) b)
SELECT CAST(e AS INTEGER) AS experiment_id, d AS description, 'success' AS status,
    (SELECT count(*) FROM split1 WHERE split = 'test') AS n_test, accuracy, f1_macro, f1_weighted,
    CAST(NULL AS VARCHAR) AS error
FROM made
UNION ALL SELECT 3, 'a failure', 'failed', NULL, NULL, NULL, NULL, 'unknown extractor' """


def drawn(name: str, trial: int) -> float:
    """The uniform number of a parameter in a trial."""
    return int(hashlib.md5(f"{trial}:{name}:42".encode()).hexdigest()[:8], 16) / 2**32


TRIALS = {
    i: (math.exp(math.log(0.01) * (1 - drawn("model_C", i))), 32 + 32 * int(2 * drawn("extractor_size", i)))
    for i in range(3)
}
ORACLES["run_trials"] = (
    "WITH RECURSIVE "
    + ", ".join(logistic(QUALITY, True, c, size, str(i)) for i, (c, size) in TRIALS.items())
    + " UNION ALL ".join(
        f"""
    SELECT CAST({i} AS BIGINT) AS trial_index, 'completed' AS status, CAST({size} AS BIGINT) AS size,
        round(CAST({c!r} AS DOUBLE), 9) AS C, accuracy, f1_macro AS f1_score
    FROM ({run_scores(str(i))}) s{i}"""
        for i, (c, size) in TRIALS.items()
    )
)

COMMON = f"""
SELECT word FROM (SELECT unnest({PIECES}) AS word FROM documents) t
GROUP BY word HAVING count(*) >= 5"""

ORACLES["word2vec_words"] = f"SELECT word, 16 AS n_dims FROM ({COMMON}) c"

ORACLES["word2vec_known"] = f"""
SELECT d.doc_id, coalesce(n, 0) AS n_known
FROM documents d LEFT JOIN (
    SELECT doc_id, count(*) AS n
    FROM (SELECT doc_id, unnest({PIECES}) AS word FROM documents) t
    WHERE word IN ({COMMON}) GROUP BY doc_id) k USING (doc_id)"""

ORACLES["score_stream"] = "SELECT doc_id, true AS as_in_batch FROM documents"


# Boosted trees, grown level by level: sums of gradients by node, feature and bin, the best split of
# each node, and Newton steps in the leaves.


def boosted(rows: str, key: str, objective: str, outputs: int, rounds: int, depth: int) -> str:
    """Common table expressions from ``rows`` (key, y, w, v, split) to margins{rounds} (key, c, m)."""
    parts = [f"""
    spans AS (
        SELECT f, min(x) AS low, max(x) AS high FROM (
            SELECT unnest(range(1, len(v) + 1)) AS f, unnest(v) AS x FROM ({rows}) r
            WHERE split = 'train') s GROUP BY f),
    edges AS (
        SELECT f, list_distinct(list_transform(range(1, 32), lambda i: low + (high - low) * i / 32)) AS e
        FROM spans),
    bins AS MATERIALIZED (
        SELECT {key}, f, CAST(len(list_filter(e, lambda t: t <= x)) AS INTEGER) AS bin
        FROM (SELECT {key}, unnest(range(1, len(v) + 1)) AS f, unnest(v) AS x FROM ({rows}) r) s
        JOIN edges USING (f)),
    truth AS MATERIALIZED (SELECT {key}, y, w, split FROM ({rows}) r),
    margins0 AS (
        SELECT {key}, c, {'(SELECT sum(y * w) / sum(w) FROM truth)' if objective == 'squared' else 'CAST(0 AS DOUBLE)'} AS m
        FROM truth, (SELECT unnest(range({outputs})) AS c) k)"""]
    derivatives = {
        "squared": "w * (m - y) AS g, w AS h",
        "logistic": "w * (1 / (1 + exp(-m)) - y) AS g, w / (1 + exp(-m)) / (1 + exp(m)) AS h",
        "softmax": "w * (p - CAST(y = c AS INTEGER)) AS g, w * greatest(2 * p * (1 - p), 1e-16) AS h",
    }[objective]
    shares = "exp(m) / sum(exp(m)) OVER (PARTITION BY " + key + ") AS p"
    for r in range(1, rounds + 1):
        parts.append(f"""
    pull{r} AS MATERIALIZED (
        SELECT {key}, c, split, {derivatives} FROM (
            SELECT {key}, c, split, y, w, m, {shares} FROM margins{r - 1} JOIN truth USING ({key})) t),
    at{r}_0 AS (SELECT {key}, c, 0 AS node, true AS fresh FROM margins{r - 1})""")
        for level in range(depth):
            parts.append(f"""
    cells{r}_{level} AS (
        SELECT c, node, f, bin, sum(g) AS g, sum(h) AS h
        FROM at{r}_{level} JOIN pull{r} USING ({key}, c) JOIN bins USING ({key})
        WHERE split = 'train' AND fresh GROUP BY ALL),
    best{r}_{level} AS MATERIALIZED (
        SELECT c, node, f, bin FROM (
            SELECT *, row_number() OVER (PARTITION BY c, node ORDER BY gain DESC, f, bin) AS k FROM (
                SELECT c, node, f, bin, round(0.5 * (gl * gl / (hl + 1) + (ga - gl) * (ga - gl) / (ha - hl + 1)
                    - ga * ga / (ha + 1)), 9) AS gain, hl, ha, following
                FROM (
                    SELECT c, node, f, bin, sum(g) OVER o AS gl, sum(h) OVER o AS hl,
                        sum(g) OVER (PARTITION BY c, node, f) AS ga,
                        sum(h) OVER (PARTITION BY c, node, f) AS ha, lead(bin) OVER o AS following
                    FROM cells{r}_{level} WINDOW o AS (PARTITION BY c, node, f ORDER BY bin)) s) t
            WHERE following IS NOT NULL AND hl >= 1 AND ha - hl >= 1 AND gain > 0) u
        WHERE k = 1),
    at{r}_{level + 1} AS MATERIALIZED (
        SELECT a.{key}, a.c, CASE WHEN b.f IS NULL OR NOT a.fresh THEN a.node
                ELSE 2 * a.node + 1 + CAST(i.bin > b.bin AS INTEGER) END AS node,
            a.fresh AND b.f IS NOT NULL AS fresh
        FROM at{r}_{level} a LEFT JOIN best{r}_{level} b ON a.c = b.c AND a.node = b.node AND a.fresh
        LEFT JOIN bins i ON i.{key} = a.{key} AND i.f = b.f)""")
        parts.append(f"""
    leaves{r} AS (
        SELECT c, node, CASE WHEN node = 0 THEN 0 ELSE -0.1 * sum(g) / (sum(h) + 1) END AS step
        FROM at{r}_{depth} JOIN pull{r} USING ({key}, c) WHERE split = 'train' GROUP BY c, node),
    margins{r} AS MATERIALIZED (
        SELECT m.{key}, m.c, m.m + step AS m
        FROM margins{r - 1} m JOIN at{r}_{depth} USING ({key}, c) JOIN leaves{r} USING (c, node))""")
    return ",".join(parts)


BOOSTED_VECTORS = f"""
SELECT vec_id, CAST(target AS DOUBLE) AS y, CAST(1 AS DOUBLE) AS w,
    CAST(embedding AS DOUBLE[]) AS v, split FROM ({SPLIT_VECTORS}) s"""

ORACLES["gbt_multiclass"] = f"""
WITH source AS MATERIALIZED ({BOOSTED_VECTORS}),
{boosted('SELECT * FROM source', 'vec_id', 'softmax', 10, 2, 3)},
shares AS (
    SELECT vec_id, c, exp(m) / sum(exp(m)) OVER (PARTITION BY vec_id) AS p,
        row_number() OVER (PARTITION BY vec_id ORDER BY round(m, 12) DESC, c) AS place
    FROM margins2)
SELECT vec_id, CAST(y AS INTEGER) AS target, CAST(c AS INTEGER) AS prediction,
    'class_' || CAST(c AS VARCHAR) AS prediction_name, round(p, 4) AS confidence
FROM shares JOIN truth USING (vec_id) WHERE place = 1 AND split = 'test'"""

ORACLES["gbt_classifier"] = f"""
WITH split AS MATERIALIZED ({split_rows(dense(QUALITY), 'doc_id', kept='v')}),
sides AS (
    SELECT target, sum(count(*)) OVER () / (CAST(count(*) AS DOUBLE) * count(*) OVER ()) AS w
    FROM split WHERE split = 'train' GROUP BY target),
source AS MATERIALIZED (
    SELECT doc_id, CAST(target AS DOUBLE) AS y, w, v, split FROM split JOIN sides USING (target)),
{boosted('SELECT * FROM source', 'doc_id', 'logistic', 1, 3, 3)},
chances AS (SELECT doc_id, CAST(y AS INTEGER) AS target, 1 / (1 + exp(-m)) AS p
    FROM margins3 JOIN truth USING (doc_id) WHERE split = 'test')
SELECT doc_id, target, {JUDGEMENT} FROM chances"""

ORACLES["gbt_regressor"] = f"""
WITH lines AS MATERIALIZED (SELECT row_number() OVER () AS id, * FROM lineitem),
source AS MATERIALIZED (
    SELECT id, l_extendedprice AS y, CAST(1 AS DOUBLE) AS w,
        [CAST(l_quantity AS DOUBLE), CAST(l_discount AS DOUBLE), CAST(l_tax AS DOUBLE)] AS v,
        'train' AS split
    FROM lines),
{boosted('SELECT * FROM source', 'id', 'squared', 1, 3, 3)}
SELECT l_orderkey, l_linenumber, l_extendedprice AS label, round(m, 4) AS prediction
FROM margins3 JOIN lines USING (id)"""
