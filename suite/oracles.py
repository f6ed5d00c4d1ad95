"""The same queries in plain SQL over the given tables."""

from __future__ import annotations

from suite import derived as D
from tidemark import constants as C

FIELDS = ", ".join(D.FIELDS)
TOKENS = ", ".join("'" + t + "'" for t in C.NULL_TOKENS)
CHUNK = D.CHUNK_ROWS
CLEANED = (
    "marketplace, customer_id, review_id, product_id, product_title, product_category, star_rating, "
    "helpful_votes, total_votes, vine, verified_purchase, review_headline, review_body, "
    "strftime(review_date, '%Y-%m-%d') AS review_date, seq"
)


def nulled(column: str) -> str:
    return f"CASE WHEN {column} NOT IN ({TOKENS}) THEN {column} END"


def number(column: str) -> str:
    return f"CASE WHEN regexp_matches({column}, '^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*$') THEN TRY_CAST({column} AS DOUBLE) END"


def flag(column: str) -> str:
    return f"CASE {column} WHEN 'Y' THEN TRUE WHEN 'N' THEN FALSE END"


# Raw reviews.
RAW = """raw AS (
  SELECT 'US' AS marketplace, CAST(o_custkey AS VARCHAR) AS customer_id,
    'R' || l_orderkey || '-' || l_linenumber AS review_id, CAST(l_partkey AS VARCHAR) AS product_id,
    p_name AS product_title, p_type AS product_category,
    CASE WHEN l_quantity = 50 THEN 'abc' WHEN l_quantity = 49 THEN '4.5'
      ELSE CAST(CAST(l_quantity AS INTEGER) % 6 AS VARCHAR) END AS star_rating,
    CAST(CAST(round(l_tax * 100) AS INTEGER) AS VARCHAR) AS helpful_votes,
    CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) AS total_votes,
    CASE WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N' END AS vine,
    CASE l_returnflag WHEN 'A' THEN 'Y' WHEN 'N' THEN 'N' ELSE 'y' END AS verified_purchase,
    o_orderpriority AS review_headline,
    CASE WHEN l_suppkey % 17 = 0 THEN '' WHEN l_suppkey % 19 = 0 THEN 'N/A'
      ELSE p_name || ' ' || p_brand END AS review_body,
    CASE WHEN p_size = 13 THEN 'notadate' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS review_date,
    l_extendedprice AS seq, l_partkey AS part,
    l_orderkey + l_partkey + CAST(round(l_extendedprice * 100) AS BIGINT) AS spread
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

# Null tokens read as null.
NULLED = RAW + ", nulled AS (SELECT " + ", ".join(f"{nulled(c)} AS {c}" for c in D.FIELDS) + ", seq FROM raw)"


def typed_from(source: str, extra: str) -> str:
    columns = []
    for c in D.FIELDS:
        if c in C.FLAG_COLUMNS:
            columns.append(f"{flag(c)} AS {c}")
        elif c in C.NUMBER_COLUMNS:
            columns.append(f"{number(c)} AS {c}")
        elif c in C.DATE_COLUMNS:
            columns.append(f"TRY_CAST({c} AS TIMESTAMP) AS {c}")
        else:
            columns.append(c)
    return f"SELECT {', '.join(columns)}, {extra} FROM {source}"


TYPED = NULLED + f", typed AS ({typed_from('nulled', 'seq')})"
RULES = "star_rating > 1 AND star_rating <= 5 AND helpful_votes <= total_votes AND review_body IS NOT NULL"
KEPT = TYPED + f", kept AS (SELECT * FROM typed WHERE {RULES})"
PLACED = KEPT + """, placed AS (SELECT *, row_number() OVER (
    PARTITION BY review_id ORDER BY seq, product_id, customer_id) AS place FROM kept)"""
CLEAN = PLACED + ", clean AS (SELECT * FROM placed WHERE place = 1)"



def learned_terms(text: str) -> str:
    words = f"regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}'']+')"
    return f"list_distinct(list_concat({words}, list_transform(range(1, len({words})), lambda i: {words}[i] || ' ' || {words}[i + 1])))"


def learned_model(source: str, key: str, text: str, rating: str, condition: str) -> str:
    """Weights of terms and the weight of having none."""
    good = f"CASE WHEN {rating} >= 4 THEN 1 WHEN {rating} <= 2 THEN 0 END"
    return f"""labelled AS (SELECT {key}, {text} AS body, {good} AS good FROM {source} WHERE {condition} AND {good} IS NOT NULL AND {text} IS NOT NULL),
      term_counts AS (
        SELECT term, sum(good) AS good, sum(1 - good) AS bad FROM (SELECT good, unnest({learned_terms("body")}) AS term FROM labelled)
        GROUP BY term HAVING count(*) >= 2),
      term_totals AS (SELECT sum(good) + 1.0 * count(*) AS good, sum(bad) + 1.0 * count(*) AS bad FROM term_counts),
      weights AS (
        SELECT term, CAST(round(1000000 * ln(((c.good + 1.0) / t.good) / ((c.bad + 1.0) / t.bad))) AS BIGINT) AS weight
        FROM term_counts c, term_totals t),
      prior AS (SELECT CAST(round(1000000 * ln((sum(good) + 1.0) / (sum(1 - good) + 1.0))) AS BIGINT) AS p FROM labelled)"""


def learned_scores(source: str, key: str, text: str) -> str:
    return f"""found AS (SELECT {key}, unnest({learned_terms(text)}) AS term FROM {source} WHERE {text} IS NOT NULL),
      hits AS (SELECT {key}, CAST(sum(weight) AS BIGINT) AS s FROM found JOIN weights USING (term) GROUP BY {key}),
      scored AS (
        SELECT {key}, coalesce(s, 0) + p AS score, CAST(greatest(least(floor((coalesce(s, 0) + p) / 2000000), 9), -10) AS INTEGER) AS bin
        FROM {source} LEFT JOIN hits USING ({key}), prior WHERE {text} IS NOT NULL)"""


# Documents rated by their quality, in three parts.
LEARNED = f"""rated AS (
    SELECT doc_id, text, 1 + 4 * quality AS stars, doc_id % 5 AS part FROM documents JOIN labels USING (doc_id)),
  {learned_model("rated", "doc_id", "text", "stars", "part > 1")}, {learned_scores("documents", "doc_id", "text")},
  shares AS (
    SELECT bin, count(*) AS n, CAST(sum((stars > 3)::INT) AS BIGINT) AS n_good, (sum((stars > 3)::INT) + 1) / (count(*) + 2) AS probability
    FROM rated JOIN scored USING (doc_id) WHERE part = 1 GROUP BY bin)"""

# Lines of the dump, with the place each has in its file.
LINES = RAW + f""", named AS (
  SELECT *, 'amazon_reviews_us_' || product_category || '_v1_' ||
    lpad(CAST(spread % (SELECT 2 + count(*) // {D.ROWS_PER_FILE} FROM lineitem) AS VARCHAR), 2, '0') || '.tsv' AS source_file,
    part % 97 = 0 AS is_long, part % 89 = 0 AND part % 97 <> 0 AS is_short, part % 83 = 0 AS has_blank
  FROM raw), lines AS (
  SELECT *, CAST(row_number() OVER w - 1 + coalesce(sum(CAST(has_blank AS INTEGER)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS pos
  FROM named WINDOW w AS (PARTITION BY source_file ORDER BY seq, review_id, product_id))"""


def scan_column(c: str) -> str:
    if c == "review_date":
        return f"CASE WHEN NOT is_short THEN {nulled(c)} END AS {c}"
    if c == "review_headline":
        return f"CASE WHEN source_file <> '{D.BROKEN_FILE}' THEN {nulled(c)} END AS {c}"
    return f"{nulled(c)} AS {c}"


SCANNED = LINES + f""", scanned AS (
  SELECT {", ".join(scan_column(c) for c in D.FIELDS)},
    CASE WHEN source_file = '{D.BROKEN_FILE}' THEN {nulled("review_headline")} END AS {D.BROKEN_FIELD},
    source_file, pos, CAST(pos // {CHUNK} AS INTEGER) AS chunk_idx, is_short, product_category AS category
  FROM lines WHERE NOT is_long)"""
SCAN_TYPED = SCANNED + f", typed AS ({typed_from('scanned', 'source_file, pos, chunk_idx, category, is_short')})"
PER_CHUNK = SCAN_TYPED + f""", per_chunk AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY source_file, chunk_idx, review_id ORDER BY pos) AS place
  FROM typed WHERE {RULES}) WHERE place = 1)"""
# The run: the broken file fails, the others share one set of keys.
GOOD = f"source_file <> '{D.BROKEN_FILE}'"
RUN = SCAN_TYPED + f""", ordered AS (
  SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY source_file, pos) AS place
  FROM typed WHERE {GOOD} AND {RULES}), run AS (SELECT * FROM ordered WHERE place = 1),
chunks AS (
  SELECT source_file, min(product_category) AS category,
    unnest(range(CAST((max(pos + CAST(has_blank AS INTEGER))) // {CHUNK} + 1 AS BIGINT))) AS chunk_idx
  FROM lines WHERE {GOOD} GROUP BY source_file)"""
OBJECT = """'bronze/reviews/year=2024/month=02/category=' || category || '/part_' ||
  lpad(CAST(chunk_idx AS VARCHAR), CAST(greatest(5, length(CAST(chunk_idx AS VARCHAR))) AS INTEGER), '0') || '.parquet'"""

RECORD = "to_json(struct_pack(" + ", ".join(f"{c} := {c}" for c in D.FIELDS) + "))"
BROKEN_RECORD = (
    "to_json(struct_pack("
    + ", ".join(f"{D.BROKEN_FIELD} := {D.BROKEN_FIELD}" if c == "review_headline" else f"{c} := {c}" for c in D.FIELDS)
    + "))"
)
# Records of the dump keep the text of a row, so the rules look at typed copies.
FAILED_RULE = f"""CASE
  WHEN NOT coalesce({number('star_rating')} > 1 AND {number('star_rating')} <= 5, FALSE) THEN 'rating'
  WHEN NOT coalesce({number('helpful_votes')} <= {number('total_votes')}, FALSE) THEN 'votes'
  WHEN review_body IS NULL THEN 'null_text' END"""
REASON = """CASE WHEN NOT coalesce(star_rating > 1 AND star_rating <= 5, FALSE) THEN 'rating'
  WHEN NOT coalesce(helpful_votes <= total_votes, FALSE) THEN 'votes'
  WHEN review_body IS NULL THEN 'null_text' END"""

RATINGS = CLEAN + """, ratings AS (
  SELECT product_category, product_id, count(star_rating) AS n_reviews, sum(star_rating) AS rating_sum,
    count(*) FILTER (verified_purchase) AS n_verified
  FROM clean GROUP BY product_category, product_id)"""
DAMPED = RATINGS + """, means AS (
  SELECT product_category, sum(rating_sum) / sum(n_reviews) AS category_rating FROM ratings GROUP BY product_category),
damped AS (
  SELECT product_category, product_id, n_reviews,
    (5.0::DOUBLE * category_rating + rating_sum) / (5.0::DOUBLE + n_reviews) AS damped_rating
  FROM ratings JOIN means USING (product_category)),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY product_category ORDER BY damped_rating DESC, n_reviews DESC, product_id) AS rank FROM damped)"""

EVENTS = """ev AS (
  SELECT 'file_' || user_id AS file_name, CASE WHEN event_type <> 'signup' THEN event_type <> 'error' END AS processed, ts
  FROM events), latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY ts DESC, processed IS NULL DESC, processed DESC) AS place FROM ev)
  WHERE place = 1 AND processed IS NOT NULL),
pending AS (
  SELECT DISTINCT 'file_' || user_id AS source_file FROM events
  WHERE 'file_' || user_id NOT IN (SELECT file_name FROM latest WHERE processed))"""

SHOWN = "review_id, product_id, customer_id, star_rating"
LISTED = ", ".join(f"'{c}'" for c in ("Economy", "Small", *C.CATEGORIES))


def hits(words: tuple[str, ...], tokens: str = "tokens") -> str:
    listed = ", ".join(f"'{w}'" for w in words)
    return f"len(list_filter({tokens}, lambda w: w IN ({listed})))"


def scores(source: str, key: str, text: str, positive: tuple[str, ...], negative: tuple[str, ...]) -> str:
    return f"""counted AS (
  SELECT {key}, {hits(positive)} AS good, {hits(negative)} AS bad
  FROM (SELECT {key}, regexp_split_to_array(lower({text}), '[^\\p{{L}}]+') AS tokens FROM {source})),
scored AS (
  SELECT {key}, CASE WHEN good + bad > 0 THEN (good - bad)::DOUBLE / (good + bad) ELSE 0.0::DOUBLE END AS score FROM counted)"""


TYPE_NAMES = {
    **{c: "string" for c in D.FIELDS},
    **{c: "boolean" for c in C.FLAG_COLUMNS},
    **{c: "double" for c in (*C.NUMBER_COLUMNS, "seq")},
    **{c: "timestamp_ntz" for c in C.DATE_COLUMNS},
}


def oracle_sql(text_lexicon, part_lexicon) -> dict[str, str]:
    label = "CASE WHEN score > 0 THEN 'POSITIVE' WHEN score < 0 THEN 'NEGATIVE' ELSE 'NEUTRAL' END"
    profile = " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, '{TYPE_NAMES[c]}' AS data_type, "
        f"count({c}) AS non_null, count(*) AS n_rows FROM typed"
        for i, c in enumerate((*D.FIELDS, "seq"))
    )
    return {
        "scan_file_inventory": f"WITH {LINES} SELECT DISTINCT source_file, TRUE AS has_content FROM lines",
        "scan_tsv": f"WITH {SCANNED} SELECT source_file, {FIELDS}, {D.BROKEN_FIELD} FROM scanned",
        "malformed_skip_long": f"""WITH {LINES} SELECT source_file, review_id, CAST({len(D.FIELDS) + 1} AS INTEGER) AS n_fields,
            concat_ws(chr(9), {FIELDS}, 'extra') AS line FROM lines WHERE is_long""",
        "malformed_count": f"""WITH {LINES} SELECT source_file, count(*) FILTER (NOT is_long) AS valid_rows,
            count(*) FILTER (is_long) AS bad_rows, count(*) FILTER (is_short) AS short FROM lines GROUP BY source_file""",
        "malformed_strict": f"WITH {SCANNED} SELECT source_file, {SHOWN}, review_date FROM scanned WHERE NOT is_short",
        "malformed_failfast": f"WITH {NULLED} SELECT {FIELDS} FROM nulled",
        "null_tokens": f"WITH {NULLED} SELECT review_id, product_id, seq, review_body FROM nulled",
        "scan_category_partition": f"""WITH {TYPED} SELECT {SHOWN}, seq, product_category AS category
            FROM typed WHERE product_category = 'ECONOMY'""",
        "scan_first_n_files": f"""WITH {SCANNED} SELECT source_file, review_id, product_id, star_rating FROM scanned
            WHERE source_file IN (SELECT DISTINCT source_file FROM scanned ORDER BY source_file LIMIT 5)""",
        "list_dataset_files": """SELECT DISTINCT 'category=' || p_type AS folder, TRUE AS is_parquet
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
        "lineage_read": f"""WITH {RUN} SELECT c.source_file, {OBJECT.replace("category ||", "c.category ||").replace("chunk_idx", "c.chunk_idx")} AS output_parquet,
            c.category, count(r.review_id) AS row_count, CAST(c.chunk_idx AS INTEGER) AS chunk_idx,
            '2024-02-03T04:05:06.000000+00:00' AS processed_at
            FROM chunks c LEFT JOIN run r ON c.source_file = r.source_file AND c.chunk_idx = r.chunk_idx
            GROUP BY c.source_file, c.category, c.chunk_idx""",
        "write_parquet_roundtrip": f"WITH {TYPED} SELECT {CLEANED} FROM typed",
        "write_partitioned": f"""WITH {RUN} SELECT CAST(2024 AS INTEGER) AS year, '02' AS month, category, source_file,
            count(*) AS n_rows, sum(star_rating) AS sum_rating FROM run GROUP BY category, source_file""",
        "overwrite_idempotent": f"""WITH {TYPED} SELECT product_category AS category, count(*) AS n_rows,
            sum(CASE WHEN product_category = 'ECONOMY' THEN 5.0::DOUBLE ELSE star_rating END) AS sum_rating
            FROM typed GROUP BY product_category""",
        "sample_first_chunk": f"""WITH {PER_CHUNK} SELECT category, source_file, review_id, product_id, star_rating
            FROM per_chunk WHERE chunk_idx = 0""",
        "sample_if_absent": f"""WITH {TYPED} SELECT product_category AS category, count(*) AS n_rows,
            sum(CASE WHEN product_category IN ('SMALL', 'LARGE') THEN star_rating ELSE 1.0::DOUBLE END) AS sum_rating
            FROM typed GROUP BY product_category""",
        "dlq_records": f"""WITH {SCANNED}, checked AS (SELECT *, {FAILED_RULE} AS reason FROM scanned WHERE {GOOD}),
            copies AS (SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY source_file, pos) AS place
              FROM checked WHERE reason IS NULL)
            SELECT source_file, reason, CAST({RECORD} AS VARCHAR) AS record FROM checked WHERE reason IS NOT NULL
            UNION ALL SELECT source_file, 'duplicate', CAST({RECORD} AS VARCHAR) FROM copies WHERE place > 1
            UNION ALL SELECT source_file, 'missing columns: [''review_headline'']', CAST({BROKEN_RECORD} AS VARCHAR)
              FROM scanned WHERE NOT ({GOOD})
            UNION ALL SELECT source_file, 'too_many_fields', CAST(to_json(struct_pack(
                line := concat_ws(chr(9), {FIELDS}, 'extra'))) AS VARCHAR) FROM lines WHERE is_long AND {GOOD}""",
        "lineage_records": f"""WITH {PER_CHUNK} SELECT source_file, {OBJECT} AS output_parquet, category,
            count(*) AS row_count, chunk_idx FROM per_chunk GROUP BY source_file, category, chunk_idx""",
        "compact_files": f"WITH {TYPED} SELECT {SHOWN}, seq FROM typed",
        "convert_tsv_to_parquet": f"WITH {SCANNED} SELECT source_file, {FIELDS} FROM scanned WHERE NOT is_short",
        "map_yn_bool": f"WITH {TYPED} SELECT review_id, product_id, seq, vine, verified_purchase FROM typed",
        "safe_numeric": f"WITH {TYPED} SELECT review_id, product_id, seq, star_rating, helpful_votes, total_votes FROM typed",
        "safe_date": f"""WITH {TYPED} SELECT review_id, product_id, seq,
            strftime(review_date, '%Y-%m-%d %H:%M:%S') AS review_date FROM typed""",
        "audit_columns": f"""WITH {SCANNED} SELECT source_file, chunk_idx,
            sha256('{D.RUN_ID}|' || source_file || '|' || chunk_idx) AS batch_id,
            '2024-02-03T04:05:06.000000+00:00' AS ingest_time, count(*) AS n_rows FROM scanned GROUP BY source_file, chunk_idx""",
        "category_from_name": f"""WITH named AS (SELECT CASE WHEN l_linenumber % 4 = 0 THEN 'amazon_reviews_multilingual_US_v1_'
              ELSE 'amazon_reviews_us_' || p_type || '-' || l_returnflag || '_v1_v' END
              || lpad(CAST(l_linenumber AS VARCHAR), 2, '0') || '.tsv' AS file_name
            FROM lineitem JOIN part ON l_partkey = p_partkey)
            SELECT file_name, CASE regexp_extract(file_name, '{C.CATEGORY_PATTERN}', 1) WHEN '' THEN 'Unknown'
              ELSE regexp_extract(file_name, '{C.CATEGORY_PATTERN}', 1) END AS category, count(*) AS n_rows
            FROM named GROUP BY file_name""",
        "partition_values": """SELECT CAST(year(l_shipdate) AS INTEGER) AS year, strftime(l_shipdate, '%m') AS month,
            l_linenumber AS chunk_idx, count(*) AS n_rows,
            'bronze/reviews/year=' || year(l_shipdate) || '/month=' || strftime(l_shipdate, '%m') ||
            '/category=Unknown/part_' || lpad(CAST(l_linenumber AS VARCHAR), 5, '0') || '.parquet' AS object_name
            FROM lineitem GROUP BY year(l_shipdate), strftime(l_shipdate, '%m'), l_linenumber""",
        "path_parts": """SELECT page_id, string_split(url, '/')[-1] AS base_name, ends_with(url, '0') AS has_suffix FROM pages""",
        "chunk_index": f"WITH {SCANNED} SELECT source_file, review_id, product_id, pos, chunk_idx FROM scanned",
        "format_timestamps": """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS iso,
            strftime(ts, '%Y%m%d_%H%M%S') AS stamp FROM events""",
        "json_round_trip": f"WITH {NULLED} SELECT CAST({RECORD} AS VARCHAR) AS record, {FIELDS} FROM nulled",
        "filter_rating": f"WITH {TYPED} SELECT {SHOWN}, seq FROM typed WHERE star_rating > 1 AND star_rating <= 5",
        "filter_votes": f"""WITH {TYPED} SELECT {SHOWN}, seq, helpful_votes, total_votes FROM typed
            WHERE helpful_votes <= total_votes""",
        "filter_not_null": f"WITH {TYPED} SELECT {SHOWN}, seq, review_body FROM typed WHERE review_body IS NOT NULL",
        "required_columns": f"""WITH {LINES} SELECT DISTINCT source_file, 'review_headline' AS missing_column
            FROM lines WHERE source_file = '{D.BROKEN_FILE}'""",
        "category_membership": f"""WITH {RAW}, named_category AS (
              SELECT upper(product_category[1]) || lower(product_category[2:]) AS category FROM raw)
            SELECT category, count(*) AS n_rows FROM named_category WHERE category NOT IN ({LISTED}) GROUP BY category""",
        "clean_reviews": f"WITH {CLEAN} SELECT {CLEANED} FROM clean",
        "rejects_by_reason": f"""WITH {PLACED}, rejects AS (
              SELECT product_category, {REASON} AS reason, star_rating FROM typed
              UNION ALL SELECT product_category, 'duplicate', star_rating FROM placed WHERE place > 1)
            SELECT product_category, reason, count(*) AS n_rows, sum(star_rating) AS sum_rating
            FROM rejects WHERE reason IS NOT NULL GROUP BY product_category, reason""",
        "dedup_keep_first": f"""WITH {TYPED}, d AS (SELECT *, row_number() OVER (
              PARTITION BY review_id ORDER BY seq, product_id, customer_id) AS place FROM typed)
            SELECT {SHOWN}, seq FROM d WHERE place = 1""",
        "dedup_per_chunk": f"""WITH {SCANNED}, d AS (SELECT *, row_number() OVER (
              PARTITION BY source_file, chunk_idx, review_id ORDER BY pos) AS place FROM scanned)
            SELECT source_file, chunk_idx, review_id, product_id, pos FROM d WHERE place = 1""",
        "run_metrics": f"""WITH {RUN} SELECT (SELECT count(DISTINCT source_file) FROM chunks) AS processed_files,
            (SELECT count(*) FROM chunks) AS processed_chunks, (SELECT count(*) FROM run) AS processed_rows,
            (SELECT count(*) FROM scanned WHERE NOT ({GOOD})) AS failed_rows""",
        "failed_rows": f"""WITH {SCANNED} SELECT source_file, count(*) AS failed_rows FROM scanned
            WHERE NOT ({GOOD}) GROUP BY source_file""",
        "running_rows": f"""WITH {SCANNED}, c AS (
              SELECT source_file, chunk_idx, count(*) AS row_count FROM scanned GROUP BY source_file, chunk_idx)
            SELECT *, CAST(sum(row_count) OVER (PARTITION BY source_file ORDER BY chunk_idx) AS BIGINT) AS total_rows FROM c""",
        "profile_table": f"WITH {TYPED} {profile}",
        "preview_head": f"WITH {NULLED} SELECT {SHOWN}, seq FROM nulled ORDER BY seq, review_id, product_id LIMIT 20",
        "union_parts": f"""WITH {NULLED} SELECT review_id, product_id, seq, CASE vine WHEN 'Y' THEN review_body END AS review_body,
            CASE vine WHEN 'N' THEN review_headline END AS review_headline FROM nulled""",
        "pending_files": f"WITH {EVENTS} SELECT source_file FROM pending",
        "dataset_complete": f"WITH {EVENTS} SELECT count(*) AS n_pending, count(*) = 0 AS complete FROM pending",
        "manifest_latest": f"""WITH {EVENTS} SELECT file_name, processed,
            strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS updated_at FROM latest""",
        "manifest_reset": f"WITH {EVENTS} SELECT file_name, processed FROM latest WHERE NOT processed",
        "manifest_list": f"WITH {EVENTS} SELECT file_name FROM latest",
        "file_failures": f"""WITH {LINES} SELECT DISTINCT source_file, 'missing columns: [''review_headline'']' AS error_message
            FROM lines WHERE NOT ({GOOD})""",
        "dedup_across_runs": f"""WITH {RUN} SELECT source_file, count(*) AS n_rows, sum(star_rating) AS sum_rating
            FROM run GROUP BY source_file""",
        "sentiment_learned": f"""WITH {LEARNED}
            SELECT doc_id, scored.score, round(coalesce(probability, CASE WHEN scored.score > 0 THEN 2 / 3 WHEN scored.score < 0 THEN 1 / 3 ELSE 0.5 END), 6) AS probability
            FROM scored LEFT JOIN shares ON shares.bin = scored.bin""",
        "sentiment_calibration": f"WITH {LEARNED} SELECT bin, n, n_good, round(probability, 6) AS probability FROM shares",
        "product_sentiment_learned": f"""WITH {CLEAN}, {learned_model("clean", "review_id", "review_body", "star_rating", "TRUE")}, {learned_scores("clean", "review_id", "review_body")}
            SELECT product_category, product_id, count(*) AS n_reviews, CAST(sum(score) AS BIGINT) AS sum_score, CAST(count_if(score > 0) AS BIGINT) AS n_good
            FROM clean JOIN scored USING (review_id) GROUP BY product_category, product_id""",
        "nearest_passages": """WITH split AS (
              SELECT doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '') AS tokens FROM documents),
            places AS (
              SELECT doc_id, tokens, unnest(range(0, 1 + CAST(greatest(ceil((len(tokens) - 128) / 96.0), 0) AS BIGINT))) AS passage_no
              FROM split WHERE len(tokens) > 0),
            words AS (
              SELECT doc_id, passage_no, unnest(regexp_extract_all(lower(array_to_string(tokens[passage_no * 96 + 1 : passage_no * 96 + 128], ' ')), '[\\p{L}\\p{N}]+')) AS term
              FROM places),
            tf AS (SELECT doc_id, passage_no, term, count(*) AS tf FROM words GROUP BY ALL),
            sizes AS (SELECT doc_id, passage_no, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY ALL),
            corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sizes),
            weights AS (
              SELECT term, CAST(floor(1000 * ln(1 + (any_value(docs) - count(*) + 0.5) / (count(*) + 0.5))) AS BIGINT) AS w FROM tf, corpus GROUP BY term),
            wanted AS (
              SELECT item_id, term, count(*) AS times FROM (
                SELECT item_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS term FROM benchmark) GROUP BY ALL),
            scored AS (
              SELECT item_id, doc_id, passage_no,
                CAST(sum(times * w * ((2200000 * tf) // (1000 * tf + (12 * (250 + (750 * n * docs) // total)) // 10))) AS BIGINT) AS score
              FROM wanted JOIN tf USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id, passage_no), corpus GROUP BY ALL)
            SELECT item_id, doc_id, CAST(passage_no AS INTEGER) AS passage_no, score,
              CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, passage_no) AS INTEGER) AS rank
            FROM scored WHERE score > 0
            QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, passage_no) <= 10""",
        "bought_together": f"""WITH {CLEAN}, lines AS (SELECT DISTINCT customer_id, product_id FROM clean),
            pairs AS (
              SELECT a.product_id AS item, b.product_id AS other, count(*) AS together
              FROM lines a JOIN lines b ON a.customer_id = b.customer_id AND a.product_id <> b.product_id GROUP BY ALL HAVING count(*) >= 2)
            SELECT item, other, together, CAST(row_number() OVER (PARTITION BY item ORDER BY together DESC, other) AS INTEGER) AS rank
            FROM pairs QUALIFY row_number() OVER (PARTITION BY item ORDER BY together DESC, other) <= 5""",
        "scan_quoted": f"""WITH {RAW} SELECT review_id, product_id, seq,
              CASE WHEN part % 3 = 0 THEN review_body || chr(10) || '"said"' || chr(9) || 'so' WHEN review_body <> '' THEN review_body END AS review_body
            FROM raw""",
        "infer_dates": f"""WITH {RAW}, chunks AS (SELECT *, CAST(spread % 3 AS INTEGER) AS chunk FROM raw),
            dated AS (
              SELECT review_id, product_id, seq, product_category, chunk, CASE WHEN review_date = 'notadate' THEN review_date
                WHEN (length(product_category) + chunk) % 3 = 0 THEN strftime(CAST(review_date AS DATE), '%m/%d/%Y')
                WHEN (length(product_category) + chunk) % 3 = 1 THEN strftime(CAST(review_date AS DATE), '%d.%m.%Y') ELSE review_date END AS text
              FROM (SELECT * REPLACE (nullif(review_date, 'notadate') AS review_date), review_date AS was FROM chunks) c
            )
            SELECT review_id, product_id, seq, product_category, chunk, strftime(CASE WHEN (length(product_category) + chunk) % 3 = 0 THEN try_strptime(text, '%m/%d/%Y')
                WHEN (length(product_category) + chunk) % 3 = 1 THEN try_strptime(text, '%d.%m.%Y') ELSE try_strptime(text, '%Y-%m-%d') END, '%Y-%m-%d') AS review_date
            FROM dated""",
        "unreadable_files": """SELECT p_type AS category, TRUE AS readable, CAST(NULL AS VARCHAR) AS error, count(*) AS n_rows
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY p_type
            UNION ALL SELECT '', FALSE, 'no footer', 0""",
        "dedup_any_order": f"""WITH {RUN} SELECT source_file, count(*) AS n_rows, sum(star_rating) AS sum_rating
            FROM run GROUP BY source_file""",
        "dedup_replaced_files": f"""WITH {KEPT} SELECT DISTINCT
            CASE WHEN CAST(product_id AS BIGINT) % 3 = 0 THEN 'amazon_reviews_us_A_v1_00.tsv' ELSE 'amazon_reviews_us_B_v1_00.tsv' END AS source_file,
            review_id FROM kept
            -- A key of both files stays with the first one.
            QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY CAST(product_id AS BIGINT) % 3 <> 0) = 1""",
        "manifest_snapshot": """WITH last AS (
              SELECT 'file_' || user_id AS file_name, max_by(event_type, event_type) AS kind FROM events GROUP BY user_id)
            SELECT file_name, kind <> 'error' AS processed FROM last WHERE kind <> 'signup'""",
        "incremental_ingest": f"WITH {RUN} SELECT source_file, count(*) AS n_rows FROM run GROUP BY source_file",
        "rating_vs_popularity": f"""WITH {RATINGS} SELECT product_category, product_id, n_reviews, n_verified,
            round(rating_sum / n_reviews, 6) AS avg_rating FROM ratings""",
        "rating_popularity_correlation": f"""WITH {RATINGS} SELECT product_category, count(*) AS n_products,
            round(corr(rating_sum / n_reviews, CAST(n_reviews AS DOUBLE)), 6) AS correlation FROM ratings GROUP BY product_category""",
        "best_products": f"""WITH {DAMPED} SELECT product_category, product_id, n_reviews, round(damped_rating, 6) AS damped_rating,
            CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 10""",
        "suggest_products": f"""WITH {DAMPED}, per AS (
              SELECT customer_id, product_category, count(*) AS n, avg(star_rating) AS rating FROM clean
              GROUP BY customer_id, product_category),
            favourite AS (SELECT customer_id, product_category FROM (
              SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, rating DESC, product_category) AS place FROM per)
              WHERE place = 1),
            free AS (SELECT f.customer_id, r.product_category, r.product_id, r.damped_rating,
                row_number() OVER (PARTITION BY f.customer_id ORDER BY r.rank) AS place
              FROM favourite f JOIN ranked r USING (product_category)
              WHERE NOT EXISTS (SELECT 1 FROM clean c WHERE c.customer_id = f.customer_id
                AND c.product_category = r.product_category AND c.product_id = r.product_id))
            SELECT customer_id, CAST(place AS INTEGER) AS place, product_category, product_id, round(damped_rating, 6) AS damped_rating FROM free WHERE place <= 5""",
        "sentiment_score": f"""WITH {scores("documents", "doc_id", "text", text_lexicon.positive, text_lexicon.negative)}
            SELECT doc_id, {label} AS label, round(score, 6) AS score FROM scored""",
        "product_sentiment": f"""WITH {CLEAN}, {scores("clean", "product_category, product_id", "review_body", part_lexicon.positive, part_lexicon.negative)}
            SELECT product_category, product_id, count(*) AS n_reviews, round(avg(score), 6) AS avg_score,
              count(*) FILTER (score > 0) AS n_positive, count(*) FILTER (score < 0) AS n_negative
            FROM scored GROUP BY product_category, product_id""",
        "passages": """WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '') AS tokens FROM documents),
            w AS (SELECT doc_id, tokens, unnest(range(0, greatest(CAST(ceil((len(tokens) - 128) / 96) AS BIGINT), 0) + 1)) AS i
              FROM t WHERE len(tokens) > 0)
            SELECT doc_id, CAST(i AS INTEGER) AS passage_no, array_to_string(tokens[i * 96 + 1 : i * 96 + 128], ' ') AS passage FROM w""",
        "nearest_vectors": """WITH q AS (SELECT label AS query, arg_min(embedding, vec_id) AS v FROM embeddings GROUP BY label),
            s AS (SELECT query, vec_id,
                list_dot_product(CAST(embedding AS DOUBLE[]), CAST(v AS DOUBLE[])) /
                sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) /
                sqrt(list_dot_product(CAST(v AS DOUBLE[]), CAST(v AS DOUBLE[]))) AS similarity
              FROM embeddings, q),
            r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY similarity DESC, vec_id) AS rank FROM s)
            SELECT query, vec_id, round(similarity, 6) AS similarity, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10""",
    }
