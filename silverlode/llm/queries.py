"""The operators of this folder over their whole tables, with the SQL some are compared with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.llm import align, bpe, chat, hmm, mixing, naming, negatives, pii, quality, shards, simhash, tokenfile, urls

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
#: The vocabulary of byte_bpe_50k.json as ranks.
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    return bpe.digests(table(spark, sf_dir, "documents"), VOCABULARY)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: three-word shingles, at most two bits apart."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=2)
    return found.select("doc_id", simhash.hex_digits(found.fp).alias("fingerprint"), "component_id")


def op3_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards of nearly equal bytes, and each document's place in its shard."""
    return shards.sharded(table(spark, sf_dir, "documents"))


def op4_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every document under a hidden Markov model and under word shares alone."""
    return hmm.scores(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix of sources takes."""
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict for the URL of every page."""
    return urls.judged(table(spark, sf_dir, "pages"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one made of control strings, formatted and read back."""
    return chat.digests(chat.with_control_strings(table(spark, sf_dir, "conversations")))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of every document and the verdict of the rules."""
    return quality.judged(table(spark, sf_dir, "documents"))


def op10_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents with equal texts, and which of each stays."""
    return naming.exact_duplicates(table(spark, sf_dir, "documents"))


def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenizers aligned in every document, with corpus-wide counts of the linked pairs."""
    return align.digests(table(spark, sf_dir, "documents"), BYTE_RANKS, PIECES)


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives for every hundredth vector and its five best of the same label."""
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(vectors.vec_id % 7 == 0, (vectors.label + 1) % 10).otherwise(vectors.label)
    whole = negatives.whole_vectors(vectors, "embedding", 256)
    rows = vectors.select(vectors.vec_id.alias("id"), label.alias("label"), whole.alias("vector"))
    return negatives.hard_negatives(rows, F.col("id") % 100 == 0)


def op13_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written to binary files with a shared dictionary and read back."""
    return tokenfile.digests(table(spark, sf_dir, "documents"), VOCABULARY, end_id=1)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_simhash": op2_simhash,
    "op3_kd_shards": op3_kd_shards,
    "op4_hmm": op4_hmm,
    "op5_pii": op5_pii,
    "op6_mixing": op6_mixing,
    "op7_urls": op7_urls,
    "op8_chat": op8_chat,
    "op9_quality": op9_quality,
    "op10_exact": op10_exact,
    "op11_align": op11_align,
    "op12_negatives": op12_negatives,
    "op13_tokens": op13_tokens,
}

#: For the queries that DuckDB can express; the others are tested against brute force.
ORACLES: dict[str, str] = {
    "op8_chat": """
        WITH rows AS (
            SELECT conv_id, turn, role, text FROM conversations
            UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
        turns AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                row_number() OVER (PARTITION BY conv_id
                    ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place
            FROM rows),
        escaped AS (
            SELECT *, length(regexp_replace(text, '([<\\[])(\\\\*)(/?(s>|INST\\]|ROLE\\]))', '\\1\\\\\\2\\3', 'g')) AS chars,
                length(regexp_replace(role, '([<\\[])(\\\\*)(/?(s>|INST\\]|ROLE\\]))', '\\1\\\\\\2\\3', 'g')) AS role_chars
            FROM turns)
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
            sum(CASE role WHEN 'user' THEN 18 + chars WHEN 'assistant' THEN 6 + chars
                ELSE 24 + role_chars + chars END)::BIGINT AS formatted_chars
        FROM escaped GROUP BY conv_id
    """,
    "op6_mixing": """
        WITH sizes AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size
            FROM documents),
        sources AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
            FROM sizes GROUP BY source),
        -- Sources fill up in the order of size by weight; 6 / weight is whole.
        filled AS (
            SELECT *, row_number() OVER w AS place,
                (SELECT sum(source_size) FROM sources)::HUGEINT
                    - coalesce(sum(3 * source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS num,
                (SELECT sum(weight) FROM sources)::HUGEINT
                    - coalesce(sum(weight) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS den
            FROM sources WINDOW w AS (ORDER BY source_size * (6 // weight), source)),
        level AS (
            SELECT num, den, place AS first FROM filled
            WHERE num * weight <= 3 * source_size::HUGEINT * den ORDER BY place LIMIT 1),
        shares AS (
            SELECT f.source, source_size,
                CASE WHEN place < first THEN (3 * source_size)::DOUBLE
                    ELSE (weight * level.num)::DOUBLE / level.den::DOUBLE END AS target,
                CASE WHEN source_size = 0 THEN 0 WHEN place < first THEN 12884901888
                    ELSE (weight * level.num * 4294967296) // (source_size * level.den) END AS expected
            FROM filled f, level),
        ends AS (
            SELECT doc_id, size, source_size, target, expected,
                sum(expected::HUGEINT) OVER (PARTITION BY d.source ORDER BY size, doc_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                + ('0x' || substr(md5(coalesce(d.source, '') || '#42'), 1, 8))::BIGINT AS upto
            FROM sizes d JOIN shares s ON d.source IS NOT DISTINCT FROM s.source)
        SELECT doc_id, size, source_size, target,
            ((upto // 4294967296 - (upto - expected) // 4294967296) * size)::BIGINT AS taken
        FROM ends
    """,
    "op9_quality": """
        WITH words AS (
            SELECT doc_id, unnest(found) AS word, generate_subscripts(found, 1) AS pos
            FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS found FROM documents)),
        windows AS (
            SELECT doc_id, pos, CASE WHEN lead(word, 4) OVER w IS NOT NULL THEN
                [word, lead(word, 1) OVER w, lead(word, 2) OVER w, lead(word, 3) OVER w, lead(word, 4) OVER w] END AS five
            FROM words WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
        found AS (
            SELECT doc_id, pos, five IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, five) > 1 AS twice FROM windows),
        covered AS (
            SELECT doc_id, bool_or(twice) OVER (PARTITION BY doc_id ORDER BY pos
                ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS again FROM found),
        repeats AS (SELECT doc_id, count(*) FILTER (again) AS n_repeat_words FROM covered GROUP BY doc_id),
        lines AS (
            SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
            FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents)
            WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
        measured AS (
            SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_words,
                length(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
                length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols,
                length(regexp_replace(coalesce(text, ''), '[^A-Z]', '', 'g')) AS n_upper,
                length(regexp_replace(coalesce(text, ''), '[^a-z]', '', 'g')) AS n_lower,
                coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
                coalesce(n_repeat_words, 0) AS n_repeat_words
            FROM documents LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)),
        judged AS (
            SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
            NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 100 * n_symbols > 10 * n_words
                OR 100 * n_dup_lines > 50 * n_lines OR 100 * n_upper > 50 * (n_upper + n_lower)) AS kept
        FROM judged
    """,
    "op10_exact": """
        WITH cleaned AS (
            SELECT doc_id, length(coalesce(text, '')) AS chars,
                regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS clean
            FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY clean) AS group_size,
            row_number() OVER w = 1 AS kept, sha256(clean) AS text_sha256
        FROM cleaned
        WINDOW w AS (PARTITION BY clean ORDER BY chars DESC, doc_id)
    """,
    "op12_negatives": """
        WITH rows AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vector
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
                list_dot_product(a.vector, r.vector)::BIGINT AS score
            FROM rows a, rows r WHERE a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id,
            (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
            vec_id AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN scored USING (anchor_id)
        WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        QUALIFY rank <= 10
    """,
}
