"""One query per operator, over its whole table, with DuckDB twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockrisk.llm.best_fit_packing import pack_documents
from blockrisk.llm.bit_packing import token_file_index
from blockrisk.llm.byte_cnn import fit_quality, score_quality
from blockrisk.llm.hard_negatives import mine
from blockrisk.llm.jaccard_join import near_duplicate_groups
from blockrisk.llm.labelled_sample import held_out
from blockrisk.llm.language_crf import fit_language, tag_languages
from blockrisk.llm.language_crf import held_out as language_held_out
from blockrisk.llm.maxscore import top_k
from blockrisk.llm.numpy_bpe import encoding_digests
from blockrisk.llm.stream_dedup import deduplicate
from blockrisk.llm.string_kernel import fit_toxicity, score_toxicity
from blockrisk.llm.token_counts import count_tokens
from blockrisk.llm.transcript_hmm import format_transcripts
from blockrisk.llm.whitening import whitened_rows

WORD_BPE, WORD_BPE_IDS = "word_bpe_49k.json", 49_408
BYTE_BPE = "byte_bpe_50k.json"
END_ID = 1
QUALITY_LEAST, TOXICITY_MOST = 0.3, 0.5


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def op1_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_file_index(_read(spark, folder, "documents"), WORD_BPE, WORD_BPE_IDS, END_ID).drop("shard", "segment")


def op2_stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return deduplicate(_read(spark, folder, "documents")).drop("file", "row")


def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(_read(spark, folder, "documents"), WORD_BPE, END_ID)


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(_read(spark, folder, "documents"), WORD_BPE, 2048)


def op5_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicate_groups(_read(spark, folder, "documents"))


def op6_numpy_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return encoding_digests(_read(spark, folder, "documents"), BYTE_BPE)


def op9_maxscore(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _read(spark, folder, "embeddings")
    return top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)


def op7_byte_cnn(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents")
    scored = score_quality(docs, fit_quality(docs, _read(spark, folder, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= QUALITY_LEAST).cast("int").alias("predicted"))


def op8_string_kernel(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents")
    scored = score_toxicity(docs, fit_toxicity(docs, _read(spark, folder, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= TOXICITY_MOST).cast("int").alias("predicted"))


def op10_transcript_hmm(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations as raw transcripts, each turn behind its speaker's name, parsed from the text alone."""
    turns = _read(spark, folder, "conversations")
    raw = F.concat_ws(": ", F.initcap("role"), F.coalesce("text", F.lit("")))
    return format_transcripts(turns.select("conv_id", "turn", raw.alias("text")))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(_read(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, label)


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitened_rows(_read(spark, folder, "embeddings"))


def op13_language_crf(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents")
    tagged = tag_languages(docs, fit_language(docs))
    return tagged.select("doc_id", language_held_out().alias("held_out"), F.col("lang").alias("lang_pred"), "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_token_files, op2_stream_dedup, op3_best_fit_packing, op4_token_counts, op5_jaccard_join, op6_numpy_bpe, op7_byte_cnn, op8_string_kernel, op9_maxscore, op10_transcript_hmm, op11_hard_negatives, op12_whitening, op13_language_crf)
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op2_stream_dedup": f"""
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
        FROM (SELECT doc_id, {_LOWER} AS t FROM documents) WINDOW same AS (PARTITION BY t)""",
    "op5_jaccard_join": f"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
                THEN [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]
                WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        links AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
            JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
            GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
        reached(doc_id, other) AS (
            SELECT doc_id, doc_id FROM documents
            UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other)
        SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.other) AS component_id
        FROM documents d JOIN reached r ON r.doc_id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
        GROUP BY d.doc_id""",
    "op9_maxscore": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(CAST(q.w AS DOUBLE[]), CAST(c.w AS DOUBLE[])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5""",
    "op11_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS same,
                   CAST(list_inner_product(CAST(a.w AS DOUBLE[]), CAST(c.w AS DOUBLE[])) AS BIGINT) AS score
            FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
        positives AS (
            SELECT anchor_id, vec_id, score FROM (
                SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM scored WHERE same) q WHERE place <= 5),
        windows AS (
            SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
                   row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS rank
            FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
            WHERE 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score)
        SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM windows WHERE rank <= 5""",
}
