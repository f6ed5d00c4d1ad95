"""The registered queries of the language-model operators: production parameters over whole tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.compression import learn_toxicity, toxicity
from tidemark.llm.editmatch import benchmark_matches
from tidemark.llm.fingerprints import exact_classes
from tidemark.llm.frames import bounded, given_id
from tidemark.llm.hyperdim import learn_profiles, predict_language, remainder
from tidemark.llm.lexical import ranked_documents
from tidemark.llm.lines import line_classes
from tidemark.llm.multiindex import nearest_neighbours
from tidemark.llm.negatives import hard_negatives
from tidemark.llm.packing import pack_documents
from tidemark.llm.phrases import drop_repeated_phrases
from tidemark.llm.probminhash import near_duplicates
from tidemark.llm.separators import token_counts
from tidemark.llm.suffixes import drop_repeated_strings


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bounded(spark).read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def op4_multi_index_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op5_language_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn_profiles(docs.where(remainder("doc_id", 3) != 1))
    found = docs.select(
        "doc_id", F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        predict_language(F.col("text"), model).alias("found"),
    )
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")


def op6_repeated_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_repeated_phrases(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


def op1_hierarchical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pack_documents(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier", "step_id"
    )


def op2_benchmark_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_classes(table(spark, sf_dir, "documents"))
    return found.select(
        given_id("doc").alias("doc_id"), F.col("place").alias("line_no"), given_id("first_doc").alias("class_doc_id"),
        F.col("first_place").alias("class_line_no"),
    )


def op8_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents")).select("doc_id", "n_tokens")


def op9_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = learn_toxicity(docs, labels.where(remainder("doc_id", 5) != 0))
    found = docs.select(
        "doc_id", F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"), toxicity("text", model).alias("score")
    )
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op10_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_repeated_strings(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0)


def op12_exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("sha256").alias("text_sha256"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_hierarchical_packing": op1_hierarchical_packing,
    "op2_benchmark_edits": op2_benchmark_edits,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_multi_index_search": op4_multi_index_search,
    "op5_language_profiles": op5_language_profiles,
    "op6_repeated_phrases": op6_repeated_phrases,
    "op7_fuzzy_lines": op7_fuzzy_lines,
    "op8_separator_scan": op8_separator_scan,
    "op9_compression_toxicity": op9_compression_toxicity,
    "op10_repeated_strings": op10_repeated_strings,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_exact_copies": op12_exact_copies,
    "op13_lexical_search": op13_lexical_search,
}
ORACLES: dict[str, str] = {
    "op6_repeated_phrases": r"""WITH split AS (
          SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        places AS (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM split WHERE len(words) >= 13),
        windows AS (SELECT doc_id, i, array_to_string(words[i : i + 12], ' ') AS phrase FROM places),
        firsts AS (SELECT phrase, min(doc_id) AS first FROM windows GROUP BY phrase),
        gone AS (SELECT DISTINCT doc_id, i + k AS i FROM windows JOIN firsts USING (phrase), range(13) AS r(k) WHERE first < doc_id),
        kept AS (
          SELECT doc_id, i, word, g.i IS NOT NULL AS lost
          FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM split) LEFT JOIN gone g USING (doc_id, i)),
        made AS (
          SELECT doc_id, count(*) AS n_words, count(*) FILTER (lost) AS n_removed,
            coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT lost), '') AS kept FROM kept GROUP BY doc_id)
        SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM documents LEFT JOIN made USING (doc_id)""",
    "op10_repeated_strings": r"""WITH bytes AS (
          SELECT doc_id, hex(encode(coalesce(text, ''))) AS hexed, strlen(coalesce(text, '')) AS n FROM documents),
        windows AS (
          SELECT doc_id, i, substr(hexed, 2 * i + 1, 100) AS piece
          FROM (SELECT doc_id, hexed, unnest(range(0, n - 49)) AS i FROM bytes WHERE n >= 50)),
        firsts AS (SELECT piece, min(doc_id) AS first FROM windows GROUP BY piece),
        late AS (SELECT doc_id, i FROM windows JOIN firsts USING (piece) WHERE first < doc_id),
        runs AS (
          SELECT doc_id, min(i) AS a, max(i) + 49 AS b FROM (
            SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (
              SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS fresh FROM late))
          GROUP BY doc_id, run),
        cuts AS (
          SELECT doc_id, count(*) AS n_spans, sum(b - a + 1) AS n_removed, list(a ORDER BY a) AS begins, list(b ORDER BY a) AS ends
          FROM runs GROUP BY doc_id)
        SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
          sha256(unhex(CASE WHEN n_spans IS NULL THEN hexed ELSE array_to_string(list_transform(range(1, n_spans + 2), lambda j:
            substr(hexed, 2 * CASE WHEN j = 1 THEN 0 ELSE ends[j - 1] + 1 END + 1,
              2 * (CASE WHEN j = n_spans + 1 THEN n ELSE begins[j] END - CASE WHEN j = 1 THEN 0 ELSE ends[j - 1] + 1 END))), '') END))
            AS kept_sha256
        FROM bytes LEFT JOIN cuts USING (doc_id)""",
    "op11_hard_negatives": r"""WITH good AS (
          SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
          FROM embeddings
          WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        pairs AS (
          SELECT a.vec_id AS anchor_id, b.vec_id AS id, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score, a.label = b.label AS same
          FROM good a JOIN good b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        positives AS (
          SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
        SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN pairs USING (anchor_id)
        WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
        QUALIFY row_number() OVER w <= 10""",
    "op12_exact_copies": r"""WITH plain AS (
          SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
          sha256(body) AS text_sha256
        FROM plain WINDOW w AS (PARTITION BY body)""",
    "op13_lexical_search": r"""WITH split AS (
          SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
        tf AS (SELECT doc_id, term, count(*) AS tf FROM split GROUP BY doc_id, term),
        sizes AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
        corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sizes),
        weights AS (
          SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
          FROM tf, corpus GROUP BY term),
        wanted AS (
          SELECT item_id, term, count(*) AS times FROM (
            SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY item_id, term),
        scored AS (
          SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // total)))) AS BIGINT) AS score
          FROM wanted JOIN tf USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), corpus
          GROUP BY item_id, doc_id)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
        FROM scored WHERE score > 0
        QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20""",
}
