"""The registered queries: one function per operator, over whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from suite import derived as D
from tidemark import constants as C
from tidemark.functions import learned
from tidemark.functions import scalars as S
from tidemark.functions.sentiment import Lexicon, with_sentiment
from tidemark.operators import observe
from tidemark.operators.clean import audit, clean, coerce, partition_values, with_chunk
from tidemark.operators.dates import infer_dates as chunk_dates
from tidemark.operators.dedup import first_per_key, flag_duplicates
from tidemark.operators.quality import missing_by_group, profile, unknown_categories
from tidemark.operators.rules import InRange, NotAbove, Present, keep, with_reason
from tidemark.operators.tables import head, union_parts
from tidemark.plans import products as P
from tidemark.plans import retrieval as R
from tidemark.plans.baskets import bought_together as together
from tidemark.plans.ingest import ingest_files, retire_files
from tidemark.plans.passage_index import build_index
from tidemark.plans.passage_index import nearest_passages as find_passages
from tidemark.session import OPEN_FILES, scratch_path, settings, stored
from tidemark.sinks import tables as K
from tidemark.sources import tsv
from tidemark.sources.categories import default_categories, read_categories
from tidemark.sources.files import list_files
from tidemark.sources.quoted import scan_quoted as read_quoted
from tidemark.sources.parquet import probe_files, read_category, read_dataset, read_first_files
from tidemark.state import manifest
from tidemark.streaming.incremental import start_ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TEXT_LEXICON = Lexicon(positive=("the", "and", "la", "le"), negative=("is", "of", "un", "by"))
PART_LEXICON = Lexicon(positive=("new", "hot", "red"), negative=("old", "cold", "small"))
SHOWN = ("review_id", "product_id", "customer_id", "star_rating")
CLEANED = (
    "marketplace", "customer_id", "review_id", "product_id", "product_title", "product_category", "star_rating",
    "helpful_votes", "total_votes", "vine", "verified_purchase", "review_headline", "review_body",
)


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


# Scans


@query
def scan_file_inventory(spark, sf):
    return D.dump_files(spark, sf).select("source_file", (F.col("length") > 0).alias("has_content"))


def _scan(spark, sf, **options):
    return tsv.scan_tsv(
        spark, list(D.dump_headers(spark, sf)), name_pattern=D.DUMP_NAME, headers=D.dump_headers(spark, sf), **options
    )


@query
def scan_tsv(spark, sf):
    return _scan(spark, sf).select("source_file", *D.FIELDS, D.BROKEN_FIELD)


def _parts(spark, sf):
    """Fields of all data lines; every layout of the dump has the same number of fields."""
    groups = tsv.group_by_header(D.dump_headers(spark, sf))
    return union_parts(
        [tsv.drop_blank(tsv.data_lines(tsv.raw_lines(spark, p, D.DUMP_NAME), h)) for h, p in groups.items()]
    )


@query
def malformed_skip_long(spark, sf):
    skipped = tsv.bad_rows(_parts(spark, sf), len(D.FIELDS), tsv.SKIP_LONG)
    return skipped.select("source_file", F.get("parts", F.lit(2)).alias("review_id"), "n_fields", "line")


@query
def malformed_count(spark, sf):
    return tsv.line_counts(
        spark, list(D.dump_headers(spark, sf)), name_pattern=D.DUMP_NAME, headers=D.dump_headers(spark, sf)
    ).select(
        "source_file", (F.col("fit") + F.col("short")).alias("valid_rows"), F.col("long").alias("bad_rows"), "short"
    )


@query
def malformed_strict(spark, sf):
    return _scan(spark, sf, policy=tsv.STRICT).select("source_file", *SHOWN, "review_date")


@query
def malformed_failfast(spark, sf):
    def make():
        path = scratch_path(spark, "plain")
        D.reviews(spark, sf).select(*D.FIELDS).write.option("sep", "\t").option("header", True).csv(path)
        return path

    rows = tsv.read_plain(spark, D.once(spark, sf, "plain", make))
    return rows.select(*[S.null_if_token(F.col(c)).alias(c) for c in D.FIELDS])


@query
def null_tokens(spark, sf):
    return D.reviews(spark, sf).select(
        "review_id", "product_id", "seq", S.null_if_token(F.col("review_body")).alias("review_body")
    )


def _stored_by_category(spark, sf):
    def make():
        path = scratch_path(spark, "by-category")
        rows = D.typed(spark, sf).withColumn("category", F.col("product_category"))
        # Many small files, as a load leaves them; the rows are not shuffled once more to be written.
        K.write_partitioned(rows, path, ["category"], rebalance=False)
        return path

    return D.once(spark, sf, "by-category", make)


@query
def scan_category_partition(spark, sf):
    return read_category(spark, _stored_by_category(spark, sf), "ECONOMY").select(*SHOWN, "seq", "category")


@query
def scan_first_n_files(spark, sf):
    def make():
        # One part per source file.
        path = scratch_path(spark, "parts")
        rows = _scan(spark, sf).select("source_file", "review_id", "product_id", "star_rating")
        # A task has few files, so it writes them side by side and need not sort its rows.
        with settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": OPEN_FILES}):
            rows.repartition("source_file").write.partitionBy("source_file").parquet(path)
        return path

    return read_first_files(spark, D.once(spark, sf, "parts", make), 5)


@query
def list_dataset_files(spark, sf):
    files = list_files(spark, _stored_by_category(spark, sf), ".parquet")
    folder = F.element_at(F.split("path", "/"), -2)
    return files.select(folder.alias("folder"), S.has_suffix(F.col("source_file"), ".parquet").alias("is_parquet")).distinct()


@query
def lineage_read(spark, sf):
    config, _ = D.run(spark, sf)
    stored = manifest.read_or_empty(spark, config.path("state/lineage"), observe.LINEAGE_SCHEMA)
    return stored.select(
        "source_file", "output_parquet", "category", "row_count", "chunk_idx",
        S.iso_utc(F.col("processed_at")).alias("processed_at"),
    )


# Sinks


@query
def write_parquet_roundtrip(spark, sf):
    path = scratch_path(spark, "roundtrip")
    K.convert(D.typed(spark, sf), path)
    return spark.read.parquet(path).select(*CLEANED, D.day(), "seq")


def _positioned(spark, sf):
    """Typed rows of the dump with positions, chunk index and partition values."""
    rows = with_chunk(coerce(_scan(spark, sf, positions=True)), D.CHUNK_ROWS)
    return partition_values(audit(rows, D.RUN_ID, D.AS_OF), D.AS_OF)


@query
def write_partitioned(spark, sf):
    config, _ = D.run(spark, sf)
    return (
        read_dataset(spark, config.clean_path)
        .groupBy("year", "month", "category", "source_file")
        .agg(F.count("*").alias("n_rows"), F.sum("star_rating").alias("sum_rating"))
    )


@query
def overwrite_idempotent(spark, sf):
    path = scratch_path(spark, "overwrite")
    rows = D.typed(spark, sf).select("review_id", "star_rating", F.col("product_category").alias("category"))
    K.write_partitioned(rows, path, ["category"])
    K.write_partitioned(rows, path, ["category"])
    again = rows.filter("category = 'ECONOMY'").withColumn("star_rating", F.lit(5.0))
    K.write_partitioned(again, path, ["category"])
    return read_dataset(spark, path).groupBy("category").agg(
        F.count("*").alias("n_rows"), F.sum("star_rating").alias("sum_rating")
    )


def _per_chunk(spark, sf):
    scope = ("source_file", "chunk_idx")
    return clean(_positioned(spark, sf), tsv.POSITION, scope=scope).drop(*tsv.ORDER)


@query
def sample_first_chunk(spark, sf):
    path = scratch_path(spark, "sample")
    K.write_sample(_per_chunk(spark, sf), path)
    return read_dataset(spark, path).select("category", "source_file", "review_id", "product_id", "star_rating")


@query
def sample_if_absent(spark, sf):
    path = scratch_path(spark, "sample-absent")
    rows = D.typed(spark, sf).select(
        "review_id", "star_rating", F.col("product_category").alias("category"), F.lit(0).alias("chunk_idx")
    )
    K.write_sample(rows.filter("category IN ('SMALL', 'LARGE')"), path)
    K.write_sample(rows.withColumn("star_rating", F.lit(1.0)), path, only_absent=True)
    return read_dataset(spark, path).groupBy("category").agg(
        F.count("*").alias("n_rows"), F.sum("star_rating").alias("sum_rating")
    )


@query
def dlq_records(spark, sf):
    config, _ = D.run(spark, sf)
    return spark.read.schema(K.QUARANTINE_SCHEMA).parquet(config.path("quarantine")).select(
        "source_file", "reason", "record"
    )


@query
def lineage_records(spark, sf):
    return observe.lineage(_per_chunk(spark, sf), D.AS_OF).drop("processed_at")


@query
def compact_files(spark, sf):
    path = scratch_path(spark, "compact")
    K.compact(spark.read.parquet(_stored_by_category(spark, sf)), path)
    return spark.read.parquet(path).select(*SHOWN, "seq")


@query
def convert_tsv_to_parquet(spark, sf):
    path = scratch_path(spark, "convert")
    K.convert(_scan(spark, sf, policy=tsv.STRICT).drop(*tsv.ORDER), path)
    return spark.read.parquet(path).select("source_file", *D.FIELDS)


# Projections


@query
def map_yn_bool(spark, sf):
    return D.reviews(spark, sf).select(
        "review_id", "product_id", "seq",
        *[S.yes_no(F.col(c)).alias(c) for c in C.FLAG_COLUMNS],
    )


@query
def safe_numeric(spark, sf):
    return D.reviews(spark, sf).select(
        "review_id", "product_id", "seq",
        *[S.safe_number(F.col(c)).alias(c) for c in C.NUMBER_COLUMNS],
    )


@query
def safe_date(spark, sf):
    parsed = S.safe_timestamp(F.col("review_date"))
    return D.reviews(spark, sf).select(
        "review_id", "product_id", "seq", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("review_date")
    )


@query
def audit_columns(spark, sf):
    return (
        _positioned(spark, sf)
        .groupBy("source_file", "chunk_idx", "batch_id", S.iso_utc(F.col("ingest_time")).alias("ingest_time"))
        .agg(F.count("*").alias("n_rows"))
    )


def _file_names():
    """Names with and without a category in them."""
    return F.concat(
        F.when(F.col("l_linenumber") % 4 == 0, "amazon_reviews_multilingual_US_v1_").otherwise(
            F.concat(F.lit("amazon_reviews_us_"), "p_type", F.lit("-"), "l_returnflag", F.lit("_v1_v"))
        ),
        F.lpad(F.col("l_linenumber").cast("string"), 2, "0"),
        F.lit(".tsv"),
    )


@query
def category_from_name(spark, sf):
    line, part = D.table(spark, sf, "lineitem"), D.table(spark, sf, "part")
    named = line.join(part, line.l_partkey == part.p_partkey).select(_file_names().alias("file_name"))
    return named.groupBy("file_name").agg(F.count("*").alias("n_rows")).select(
        "file_name", S.category_of(F.col("file_name")).alias("category"), "n_rows"
    )


@query
def partition_values_query(spark, sf):
    ship = F.col("l_shipdate")
    return (
        D.table(spark, sf, "lineitem")
        .groupBy(F.year(ship).alias("year"), S.month_text(ship).alias("month"), F.col("l_linenumber").alias("chunk_idx"))
        .agg(F.count("*").alias("n_rows"))
        .withColumn(
            "object_name", S.object_name(F.col("year"), F.col("month"), F.lit(C.UNKNOWN_CATEGORY), F.col("chunk_idx"))
        )
    )


QUERIES["partition_values"] = QUERIES.pop("partition_values_query")


@query
def path_parts(spark, sf):
    url = F.col("url")
    return D.table(spark, sf, "pages").select(
        "page_id", S.base_name(url).alias("base_name"), S.has_suffix(url, "0").alias("has_suffix")
    )


@query
def chunk_index(spark, sf):
    return _positioned(spark, sf).select("source_file", "review_id", "product_id", "pos", "chunk_idx")


@query
def format_timestamps(spark, sf):
    return D.table(spark, sf, "events").select(
        "event_id", S.iso_utc(F.col("ts")).alias("iso"), S.file_stamp(F.col("ts")).alias("stamp")
    )


@query
def json_round_trip(spark, sf):
    record = D.nulled(spark, sf).select(S.to_record(D.FIELDS).alias("record"))
    return record.select("record", S.from_record(F.col("record"), D.FIELDS).alias("r")).select("record", "r.*")


# Filters


@query
def filter_rating(spark, sf):
    return keep(D.typed(spark, sf), [InRange()]).select(*SHOWN, "seq")


@query
def filter_votes(spark, sf):
    return keep(D.typed(spark, sf), [NotAbove()]).select(*SHOWN, "seq", "helpful_votes", "total_votes")


@query
def filter_not_null(spark, sf):
    return keep(D.typed(spark, sf), [Present()]).select(*SHOWN, "seq", "review_body")


@query
def required_columns(spark, sf):
    headers = tsv.header_rows(spark, D.dump(spark, sf), D.DUMP_NAME)
    return missing_by_group(headers, "source_file", "column_name", C.REQUIRED_COLUMNS)


@query
def category_membership(spark, sf):
    reviews = D.reviews(spark, sf).withColumn("category", F.initcap("product_category"))


    def make():
        # A list of categories as a configuration file has it, two of the table's own among them.
        path = scratch_path(spark, "categories")
        own = D.table(spark, sf, "part").select(F.initcap("p_type").alias("category")).distinct()
        listed = own.filter("category IN ('Economy', 'Small')").union(default_categories(spark))
        listed.select(F.concat(F.lit("  - "), "category")).coalesce(1).write.text(path)
        return path

    known = read_categories(spark, D.once(spark, sf, "categories", make))
    return unknown_categories(reviews, "category", [r.category for r in known.collect()])


@query
def clean_reviews(spark, sf):
    return clean(D.typed(spark, sf), ["seq", "product_id", "customer_id"]).select(*CLEANED, D.day(), "seq")


@query
def rejects_by_reason(spark, sf):
    rows = D.typed(spark, sf)
    by_rule = with_reason(rows).filter("reason IS NOT NULL")
    flagged = flag_duplicates(keep(rows), C.DEDUP_KEYS, ["seq", "product_id", "customer_id"])
    copies = flagged.filter("is_duplicate").withColumn("reason", F.lit("duplicate"))
    columns = ["product_category", "reason", "star_rating"]
    return (
        by_rule.select(*columns)
        .unionByName(copies.select(*columns))
        .groupBy("product_category", "reason")
        .agg(F.count("*").alias("n_rows"), F.sum("star_rating").alias("sum_rating"))
    )


# Duplicates and aggregates


@query
def dedup_keep_first(spark, sf):
    return first_per_key(D.typed(spark, sf), C.DEDUP_KEYS, ["seq", "product_id", "customer_id"]).select(*SHOWN, "seq")


@query
def dedup_per_chunk(spark, sf):
    return first_per_key(
        _positioned(spark, sf), C.DEDUP_KEYS, ["pos"], scope=("source_file", "chunk_idx")
    ).select("source_file", "chunk_idx", "review_id", "product_id", "pos")


@query
def run_metrics(spark, sf):
    config, _ = D.run(spark, sf)
    stored = spark.read.schema(observe.METRICS_SCHEMA).parquet(config.path("state/metrics"))
    return stored.select("processed_files", "processed_chunks", "processed_rows", "failed_rows")


@query
def failed_rows(spark, sf):
    config, result = D.run(spark, sf)
    stored = spark.read.schema(K.QUARANTINE_SCHEMA).parquet(config.path("quarantine"))
    return observe.failed_rows(stored.filter(F.col("source_file").isin(*result.failed)))


@query
def running_rows(spark, sf):
    chunks = _positioned(spark, sf).groupBy("source_file", "chunk_idx").agg(F.count("*").alias("row_count"))
    return observe.running_rows(chunks)


@query
def profile_table(spark, sf):
    return profile(D.typed(spark, sf))


# Limits and unions


@query
def preview_head(spark, sf):
    return head(D.nulled(spark, sf).select(*SHOWN, "seq"), 20, D.TIE)


@query
def union_parts_query(spark, sf):
    rows = D.nulled(spark, sf)
    first = rows.filter("vine = 'Y'").select("review_id", "product_id", "seq", "review_body")
    second = rows.filter("vine = 'N'").select("seq", "review_id", "product_id", "review_headline")
    return union_parts([first, second])


QUERIES["union_parts"] = QUERIES.pop("union_parts_query")


# State


def _events(spark, sf):
    """File events: one file per user; a sign-up forgets the file, an error leaves it unprocessed."""
    kind = F.col("event_type")
    return D.table(spark, sf, "events").select(
        F.concat(F.lit("file_"), F.col("user_id").cast("string")).alias("file_name"),
        F.lit(None).cast("string").alias("path"),
        F.when(kind != "signup", kind != "error").alias("processed"),
        F.col("ts").cast("timestamp").alias("updated_at"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("seq"),
    )


def _inventory(spark, sf):
    users = D.table(spark, sf, "events").select(F.col("user_id").cast("string").alias("u")).distinct()
    return users.select(F.concat(F.lit("file_"), F.col("u")).alias("source_file"))


@query
def pending_files(spark, sf):
    return manifest.pending(_inventory(spark, sf), _events(spark, sf)).select("source_file")


@query
def dataset_complete(spark, sf):
    left = manifest.pending(_inventory(spark, sf), _events(spark, sf))
    return left.agg(F.count("*").alias("n_pending"), (F.count("*") == 0).alias("complete"))


@query
def manifest_latest(spark, sf):
    return manifest.latest(_events(spark, sf)).select(
        "file_name", "processed", S.iso_utc(F.col("updated_at")).alias("updated_at")
    )


@query
def manifest_reset(spark, sf):
    events = _events(spark, sf)
    done = manifest.latest(events).filter("processed").select(F.col("file_name").alias("source_file"))
    forgotten = manifest.marks(done, D.AS_OF, None)
    return manifest.latest(events.unionByName(forgotten)).select("file_name", "processed")


@query
def manifest_list(spark, sf):
    return manifest.known_files(_events(spark, sf))


@query
def file_failures(spark, sf):
    config, _ = D.run(spark, sf)
    return spark.read.parquet(config.path("state/failures")).select("source_file", "error_message")


@query
def incremental_ingest(spark, sf):
    def make():
        config = D.run_config(spark, "stream")
        for _ in range(2):  # the second start finds nothing new
            start_ingest(spark, D.dump(spark, sf), config, max_files=3).awaitTermination()
        return config

    config = D.once(spark, sf, "stream", make)
    return read_dataset(spark, config.clean_path).groupBy("source_file").agg(F.count("*").alias("n_rows"))


@query
def dedup_across_runs(spark, sf):
    """Two runs over halves of the dump, with one run id, store what one run over all of it stores."""

    def make():
        config = D.run_config(spark, "halves")
        files = sorted(D.dump_paths(spark, sf).items(), key=lambda x: (x[1], x[0]))
        for half in (files[: len(files) // 2], files[len(files) // 2 :]):
            ingest_files(spark, dict(half), config)
        return config

    config = D.once(spark, sf, "halves", make)
    return read_dataset(spark, config.clean_path).groupBy("source_file").agg(
        F.count("*").alias("n_rows"), F.sum("star_rating").alias("sum_rating")
    )


@query
def dedup_any_order(spark, sf):
    """The later half of the dump first, then the earlier one: as one run over all of it."""

    def make():
        config = D.run_config(spark, "halves-back")
        files = sorted(D.dump_paths(spark, sf).items(), key=lambda x: (x[1], x[0]))
        for half in (files[len(files) // 2 :], files[: len(files) // 2]):
            ingest_files(spark, dict(half), config)
        return config

    config = D.once(spark, sf, "halves-back", make)
    return read_dataset(spark, config.clean_path).groupBy("source_file").agg(
        F.count("*").alias("n_rows"), F.sum("star_rating").alias("sum_rating")
    )


@query
def dedup_replaced_files(spark, sf):
    """File A holds the keys of two thirds of the products, B of another two; A is replaced by a third, so B gets some back."""

    def make():
        config, folder = D.run_config(spark, "replaced"), scratch_path(spark, "replaced-dump")
        old = D.part_dump(spark, sf, os.path.join(folder, "1"), "amazon_reviews_us_A_v1_00.tsv", (0, 1))
        other = D.part_dump(spark, sf, os.path.join(folder, "3"), "amazon_reviews_us_B_v1_00.tsv", (1, 2))
        ingest_files(spark, D.part_paths(spark, old, other), config)
        new = D.part_dump(spark, sf, os.path.join(folder, "2"), "amazon_reviews_us_A_v1_00.tsv", (0,))
        retire_files(spark, list(D.part_paths(spark, old)), config)
        ingest_files(spark, D.part_paths(spark, new), config)
        return config

    config = D.once(spark, sf, "replaced", make)
    return read_dataset(spark, config.clean_path).select("source_file", "review_id")


@query
def manifest_snapshot(spark, sf):
    """State read from snapshots and the commits behind them, after a commit per kind of event."""

    def make():
        path = scratch_path(spark, "log")
        events = D.table(spark, sf, "events")
        kinds = [r.event_type for r in events.select("event_type").distinct().orderBy("event_type").collect()]
        for kind in kinds:
            files = events.where(F.col("event_type") == kind)
            names = files.select(F.concat(F.lit("file_"), F.col("user_id").cast("string")).alias("source_file")).distinct()
            manifest.append(manifest.marks(names, D.AS_OF, None if kind == "signup" else kind != "error"), path)
            if kind == kinds[len(kinds) // 2]:
                manifest.snapshot(spark, path)
        return path

    path = D.once(spark, sf, "log", make)
    return manifest.latest(manifest.load(spark, path)).select("file_name", "processed")


# Stated goals


def _clean(spark, sf):
    return clean(D.typed(spark, sf), ["seq", "product_id", "customer_id"])


@query
def rating_vs_popularity(spark, sf):
    return P.rating_vs_popularity(_clean(spark, sf))


@query
def rating_popularity_correlation(spark, sf):
    return P.rating_popularity_correlation(_clean(spark, sf))


@query
def best_products(spark, sf):
    return P.best_products(_clean(spark, sf), k=10)


@query
def suggest_products(spark, sf):
    return P.suggest_products(_clean(spark, sf), k=5)


@query
def sentiment_score(spark, sf):
    scored = with_sentiment(D.table(spark, sf, "documents"), "text", TEXT_LEXICON)
    return scored.select("doc_id", "label", F.round("score", 6).alias("score"))


@query
def product_sentiment(spark, sf):
    return P.product_sentiment(_clean(spark, sf), PART_LEXICON)


@query
def passages(spark, sf):
    return R.passages(D.table(spark, sf, "documents"), "doc_id", "text")


@query
def nearest_vectors(spark, sf):
    corpus = D.table(spark, sf, "embeddings")
    firsts = corpus.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("v")).collect()
    found = R.nearest(corpus, "vec_id", "embedding", {r.label: r.v for r in firsts}, k=10)
    return found.withColumn("query", F.col("query").cast("int"))


def _rated_documents(spark, sf):
    """Documents with a rating of five stars or one, by their quality, and three parts to learn, calibrate and look."""
    rated = D.table(spark, sf, "documents").join(D.table(spark, sf, "labels"), "doc_id")
    stars = (1 + 4 * F.col("quality")).alias("stars")
    part = F.pmod(F.col("doc_id"), F.lit(5))
    return rated.select("doc_id", "text", stars, F.when(part > 1, "learn").when(part == 1, "calibrate").otherwise("look").alias("part"))


def _learned(spark, sf):
    def make():
        rows = _rated_documents(spark, sf)
        model = learned.fit(rows.where("part = 'learn'"), "doc_id", "text", "stars")
        return learned.calibrate(rows.where("part = 'calibrate'"), "doc_id", "text", "stars", model)

    return D.once(spark, sf, "learned", make)


@query
def sentiment_learned(spark, sf):
    """All documents, rated or not, by a model learned from ratings."""
    model = _learned(spark, sf)
    scored = learned.scores(D.table(spark, sf, "documents"), "doc_id", "text", model)
    return learned.with_probability(scored, model).withColumn("probability", F.round("probability", 6))


@query
def sentiment_calibration(spark, sf):
    return _learned(spark, sf).shares.withColumn("probability", F.round("probability", 6))


@query
def product_sentiment_learned(spark, sf):
    """Per category and product, by a model of the words and ratings of the reviews themselves."""
    rows = _clean(spark, sf).select("review_id", "product_category", "product_id", "review_body", "star_rating")
    rows = D.once(spark, sf, "rated", lambda: stored(rows, "rated"))
    scored = learned.scores(rows, "review_id", "review_body", learned.fit(rows, "review_id", "review_body", "star_rating"))
    joined = rows.join(scored, "review_id").groupBy("product_category", "product_id")
    return joined.agg(F.count("*").alias("n_reviews"), F.sum("score").alias("sum_score"), F.count_if(F.col("score") > 0).alias("n_good"))


@query
def nearest_passages(spark, sf):
    index = D.once(spark, sf, "passage-index", lambda: build_index(D.table(spark, sf, "documents"), "doc_id", "text"))
    return find_passages(index, D.table(spark, sf, "benchmark"), "item_id", "text", k=10)


@query
def bought_together(spark, sf):
    return together(_clean(spark, sf), "customer_id", "product_id", k=5)


@query
def scan_quoted(spark, sf):
    """Reviews whose texts hold line breaks and quotes, read back from quoted files."""

    def make():
        path = scratch_path(spark, "quoted")
        body = F.when(F.col("_part") % 3 == 0, F.concat(F.col("review_body"), F.lit('\n"said"\tso'))).otherwise(F.col("review_body"))
        rows = D.reviews(spark, sf).withColumn("review_body", body).select("review_id", "product_id", "seq", "review_body")
        written = rows.write.option("sep", "\t").option("header", True).option("escape", '"').option("emptyValue", "")
        written.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
        return path

    path = D.once(spark, sf, "quoted", make)
    files = [r.path for r in list_files(spark, path, ".csv").select("path").collect()]
    return read_quoted(spark, files).select("review_id", "product_id", F.col("seq").cast("double").alias("seq"), "review_body")


@query
def infer_dates(spark, sf):
    """Each category and third of it writes its dates in a way of its own."""
    rows = D.reviews(spark, sf).withColumn("chunk", (F.col("_spread") % 3).cast("int"))
    text = lambda f: F.date_format(F.to_date("review_date", "yyyy-MM-dd"), f)
    way = F.pmod(F.length("product_category") + F.col("chunk"), F.lit(3))
    known = F.col("review_date") != "notadate"
    made = F.when(~known, F.col("review_date")).when(way == 0, text("MM/dd/yyyy")).when(way == 1, text("dd.MM.yyyy")).otherwise(F.col("review_date"))
    rows = rows.withColumn("review_date", made).select("review_id", "product_id", "seq", "product_category", "chunk", "review_date")
    return chunk_dates(rows, ("product_category", "chunk"), D.TIE, ["review_date"]).withColumn("review_date", D.day())


@query
def unreadable_files(spark, sf):
    def make():
        path = scratch_path(spark, "probed")
        rows = D.reviews(spark, sf).select("review_id", F.col("product_category").alias("category"))
        K.write_partitioned(rows, path, ["category"])
        # One that is no file of this kind.
        spark.range(3).coalesce(1).selectExpr("concat('not a table ', id) AS value").write.text(os.path.join(path, "broken"))
        return path

    path = D.once(spark, sf, "probed", make)
    found = probe_files(spark, path, suffix=".parquet").unionByName(probe_files(spark, os.path.join(path, "broken"), suffix=".txt"))
    folder = F.regexp_extract("path", r"category=([^/]*)/", 1)
    return found.groupBy(folder.alias("category"), "readable", "error").agg(F.sum("n_rows").alias("n_rows"))
