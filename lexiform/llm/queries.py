"""One query per operator over its whole table, and their SQL twins."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiform.cluster import fresh_path
from lexiform.llm import (
    chat,
    forced_boundary,
    kmeans_tree,
    lexical_search,
    metric_join,
    order_minhash,
    packing,
    pairwise_rank,
    periodic_runs,
    quality_rules,
    token_files,
    toxicity,
    warc,
)
from lexiform.llm.batches import chunks_of_text

BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_risk_controlled_rules(spark: SparkSession, folder: str) -> DataFrame:
    """All documents judged by base rules and by cutoffs learnt from all labelled good documents."""
    judged = quality_rules.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op2_pairwise_quality(spark: SparkSession, folder: str) -> DataFrame:
    """All documents ranked by quality."""
    return pairwise_rank.rank(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op3_residual_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return packing.pack_documents(table(spark, folder, "documents"), BYTE_VOCABULARY, end_id=0)


def op4_metric_range_join(spark: SparkSession, folder: str) -> DataFrame:
    """All embeddings joined within their label."""
    return metric_join.range_join(table(spark, folder, "embeddings"), 0.93)


def op5_boundary_chain_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages written as archives and read back."""
    archives = fresh_path(spark, "archives")
    warc.write_archives(table(spark, folder, "pages"), archives)
    return warc.page_records(spark, archives)


def op6_forced_boundary_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """All documents encoded and decoded."""
    return forced_boundary.digests(table(spark, folder, "documents"), WORD_VOCABULARY)


def op7_typed_chat(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, and one that quotes control strings, formatted and read back."""
    quoting = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-7, 0, "user", quoting), (-7, 1, "assistant", quoting)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    messages = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    formatted = chat.format_conversations(chat.as_parts(messages.unionByName(extra)))
    return chat.conversation_digests(formatted)


def op8_kneser_ney_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """All documents scored for toxicity."""
    scored = toxicity.score_toxicity(
        table(spark, folder, "documents"), table(spark, folder, "labels")
    )
    return scored.select("doc_id", "held_out", "score", "predicted")


def op9_elias_fano_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """All documents written as token files and read back."""
    files = fresh_path(spark, "tokens")
    token_files.write_tokens(table(spark, folder, "documents"), WORD_VOCABULARY, files, end_id=2)
    return token_files.read_tokens(spark, files)


def op10_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with the class of their near duplicates."""
    return order_minhash.near_duplicates(table(spark, folder, "documents"))


def op11_hybrid_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    """All documents ranked for each benchmark item."""
    index = lexical_search.build_index(
        table(spark, folder, "documents"), fresh_path(spark, "lexical")
    )
    return lexical_search.search(index, table(spark, folder, "benchmark"), 20)


def op12_kmeans_tree_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest of every twentieth embedding among all others."""
    return kmeans_tree.nearest(table(spark, folder, "embeddings"), 20, 20)


def repeated_words(doc_id: int, words: list[bytes]) -> list[bytes]:
    """The words of a document, of every tenth one with a stretch that repeats up to its end."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def with_periods(documents: DataFrame) -> DataFrame:
    """Documents of which every tenth, by the hash of its id, is made periodic from some word on."""

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks_of_text(batches):
            ids = part.column("doc_id").to_pylist()
            made = [
                t.encode() if i is None or zlib.crc32(str(i).encode()) % 10
                else b" ".join(repeated_words(i, periodic_runs.words_of(t)))
                for i, t in zip(ids, texts)
            ]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(made, pa.binary()).cast(pa.string())],
                names=["doc_id", "text"],
            )

    return documents.select("doc_id", "text").mapInArrow(rewrite, "doc_id bigint, text string")


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The periodic runs of all documents, every tenth of them made periodic."""
    runs = periodic_runs.periodic_runs(with_periods(table(spark, folder, "documents")))
    length, period = F.col("strongest.length"), F.col("strongest.period")
    return runs.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "strongest.start",
        "strongest.length", "strongest.period",
        F.floor(F.try_divide(1000 * length - (1000 * length) % period, period))
        .alias("exponent_milli"),
        F.sha2(periodic_runs.written("runs"), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_risk_controlled_rules": op1_risk_controlled_rules,
    "op2_pairwise_quality": op2_pairwise_quality,
    "op3_residual_packing": op3_residual_packing,
    "op4_metric_range_join": op4_metric_range_join,
    "op5_boundary_chain_warc": op5_boundary_chain_warc,
    "op6_forced_boundary_bpe": op6_forced_boundary_bpe,
    "op7_typed_chat": op7_typed_chat,
    "op8_kneser_ney_toxicity": op8_kneser_ney_toxicity,
    "op9_elias_fano_tokens": op9_elias_fano_tokens,
    "op10_order_minhash": op10_order_minhash,
    "op11_hybrid_lexical_search": op11_hybrid_lexical_search,
    "op12_kmeans_tree_search": op12_kmeans_tree_search,
    "op13_periodic_runs": op13_periodic_runs,
}


def escaped(column: str) -> str:
    """Characters of a text after escaping: two for every control string, one for a backslash."""
    gone = (
        f"2 * (length({column}) - length(replace({column}, '{c}', ''))) // {len(c)}"
        for c in chat.CONTROL
    )
    backslashes = f"length({column}) - length(replace({column}, chr(92), ''))"
    return f"(length({column}) + {backslashes} + {' + '.join(gone)})"


def rules_sql() -> str:
    """Operator 1: its counts, and the ladders tested by sums of binomial probabilities."""
    rules = quality_rules.RULES
    ladders = ", ".join(
        f"('{rule}', {step}, {cutoff})"
        for rule, (_, _, ladder) in rules.items()
        for step, cutoff in enumerate(ladder)
    )
    measures = " UNION ALL ".join(
        f"SELECT doc_id, '{rule}' AS rule, {a} AS num, {b} AS den FROM counts"
        for rule, (a, b, _) in rules.items()
    )
    p, level = quality_rules.RISK / len(rules), quality_rules.ERROR / len(rules)
    white = r"\x20\x09-\x0D"
    return rf"""
    WITH texts AS (
        SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text FROM documents),
    worded AS (SELECT *, regexp_extract_all(text, '[^{white}]+') AS w FROM texts),
    windows AS (
        SELECT doc_id, p, array_to_string(w[p + 1:p + 8], ' ') AS words
        FROM (SELECT doc_id, w, unnest(range(0, len(w) - 7)) AS p FROM worded WHERE len(w) >= 8) t),
    twice AS (
        SELECT doc_id, unnest(range(p, p + 8)) AS place
        FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, words) AS n FROM windows) t
        WHERE n > 1),
    repeats AS (SELECT doc_id, count(DISTINCT place) AS n_repeat_words FROM twice GROUP BY doc_id),
    lines AS (
        SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts) t
        WHERE regexp_matches(line, '[^{white}]') GROUP BY doc_id),
    counts AS (
        SELECT doc_id, stratum, len(w) AS n_words,
            length(regexp_replace(text, '[{white}]', '', 'g')) AS word_chars,
            length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
            coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
            coalesce(n_repeat_words, 0) AS n_repeat_words,
            length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_upper,
            length(text) - length(regexp_replace(text, '[A-Za-z]', '', 'g')) AS n_letters
        FROM worded LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)),
    good AS (
        SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1),
    measured AS ({measures}),
    holdout AS (
        SELECT stratum, rule, num, den FROM measured JOIN counts USING (doc_id)
        WHERE doc_id IN (SELECT doc_id FROM good)),
    ladders(rule, step, cutoff) AS (VALUES {ladders}),
    tested AS (
        SELECT stratum, rule, step, cutoff, count(*) AS n,
            count(*) FILTER (WHERE den > 0 AND 1000 * num >= cutoff * den) AS k
        FROM holdout JOIN ladders USING (rule) GROUP BY ALL),
    passed AS (
        SELECT stratum, rule, cutoff, bool_and(
            list_sum(list_transform(range(0, k + 1), lambda j: exp(
                lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1)
                + j * ln({p!r}::DOUBLE) + (n - j) * ln(1 - {p!r}::DOUBLE))))
            <= {level!r}::DOUBLE / (SELECT count(DISTINCT stratum) FROM holdout)
            ) OVER (PARTITION BY stratum, rule ORDER BY step) AS ok
        FROM tested),
    cutoffs AS (SELECT stratum, rule, min(cutoff) AS cutoff FROM passed WHERE ok GROUP BY ALL),
    violated AS (
        SELECT DISTINCT doc_id
        FROM measured JOIN counts USING (doc_id) JOIN cutoffs USING (stratum, rule)
        WHERE den > 0 AND 1000 * num >= cutoff * den)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
        n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
        NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
            AND doc_id NOT IN (SELECT doc_id FROM violated) AS kept
    FROM counts"""


ORACLES: dict[str, str] = {
    "op1_risk_controlled_rules": rules_sql(),
    "op4_metric_range_join": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e
            FROM embeddings),
        ok AS (
            SELECT * FROM v
            WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x <> 0)) > 0
              AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b
            FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
        reach AS (
            SELECT vec_id AS a, vec_id AS b FROM v
            UNION
            SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
        parts AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
        counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
        SELECT v.vec_id, coalesce(n, 0) AS n_links, component_id,
               v.vec_id = component_id AS kept
        FROM v JOIN parts USING (vec_id) LEFT JOIN counts USING (vec_id)""",
    "op5_boundary_chain_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                   sha256(coalesce(html, '')) AS payload_digest
            FROM pages),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit'
                    ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
        FROM f""",
    "op7_typed_chat": f"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        e AS (
            SELECT *, {escaped('text')} AS text_chars, {escaped('role')} AS role_chars FROM c)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
                   AS turns_sha256,
               CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT)
                   AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
                               FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               CAST(3 + sum(text_chars + role_chars + 13) AS BIGINT) AS formatted_chars
        FROM e GROUP BY conv_id""",
    "op11_hybrid_lexical_search": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
        q AS (
            SELECT item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
        totals AS (SELECT count(*) AS nn, sum(len(t)) AS ll FROM d WHERE len(t) > 0),
        tf AS (
            SELECT doc_id, term, count(*) AS tf
            FROM (SELECT doc_id, unnest(t) AS term FROM d) x
            WHERE term IN (SELECT term FROM q) GROUP BY ALL),
        w AS (
            SELECT term, CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / (2 * count(*) + 1)))
                AS BIGINT) AS w
            FROM tf, totals GROUP BY term, nn),
        m AS (
            SELECT doc_id, 75 + CAST((25 * len(t) * nn) // ll AS BIGINT) AS m
            FROM d, totals WHERE len(t) > 0),
        s AS (
            SELECT item_id, doc_id,
                CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
            FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (doc_id)
            GROUP BY item_id, doc_id)
        SELECT item_id, doc_id, score, CAST(rank AS INTEGER) AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
              FROM s WHERE score > 0) t
        WHERE rank <= 20""",
    "op13_periodic_runs": r"""
        WITH crc AS (
            SELECT list_transform(range(256), lambda v: list_reduce(
                range(8), lambda c, b: xor(c >> 1, (c & 1) * 3988292384), v)) AS t),
        d AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                xor(list_reduce(
                    list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                        lambda x: CAST(ord(x) AS BIGINT)),
                    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]),
                    4294967295::BIGINT), 4294967295) AS h
            FROM documents, crc),
        g AS (SELECT *, h // 10 AS g, len(w) AS n FROM d),
        a AS (SELECT *, CASE WHEN n > 0 THEN g % n END AS a FROM g),
        p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
        texts AS (
            SELECT doc_id, n, CASE WHEN h % 10 <> 0 OR n = 0 THEN w ELSE list_transform(
                range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END])
                END AS w
            FROM p),
        words AS (
            SELECT doc_id, n, unnest(w) AS word, unnest(range(n)) AS i FROM texts),
        same AS (
            SELECT x.doc_id, x.i AS i, y.i - x.i AS q
            FROM words x JOIN words y
                ON x.doc_id = y.doc_id AND x.word = y.word
                AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
        stretches AS (
            SELECT doc_id, q, min(i) AS s, max(i) + 1 + q AS e
            FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k
                  FROM same) t
            GROUP BY doc_id, q, k
            HAVING max(i) + 1 + q - min(i) >= greatest(6, 4 * q)),
        runs AS (
            SELECT doc_id, s, e - s AS length, min(q) AS q FROM stretches GROUP BY doc_id, s, e),
        best AS (
            SELECT * FROM (SELECT *, row_number() OVER (
                PARTITION BY doc_id ORDER BY length / q DESC, s, q) AS k FROM runs) t
            WHERE k = 1),
        lists AS (
            SELECT doc_id, count(*) AS n_runs,
                string_agg(s || ',' || length || ',' || q || chr(10), '' ORDER BY s, q) AS lines
            FROM runs GROUP BY doc_id),
        dropped AS (
            SELECT DISTINCT doc_id, unnest(range(s + q, s + length)) AS i FROM runs),
        kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text
            FROM words ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id)
        SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.length AS length,
            best.q AS period, 1000 * best.length // best.q AS exponent_milli,
            sha256(coalesce(lines, '')) AS runs_sha256,
            sha256(coalesce(kept.text, '')) AS collapsed_sha256
        FROM texts LEFT JOIN lists USING (doc_id) LEFT JOIN best USING (doc_id)
            LEFT JOIN kept USING (doc_id)""",
}
