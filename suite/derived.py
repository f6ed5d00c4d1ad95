"""Reviews derived from the given tables, as a view and as a dump of delimited files.

The tables hold no dirt, so a fixed rule per column makes some. Everything grows with the tables.
"""

from __future__ import annotations

import os
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.clean import coerce
from tidemark.plans.ingest import ALL, IngestConfig, IngestResult, ingest
from tidemark.session import scratch_path
from tidemark.sinks.text import write_sorted_text
from tidemark.sources.tsv import read_headers
from tidemark.sources.files import list_files
from tidemark.functions.scalars import null_if_token

AS_OF = datetime(2024, 2, 3, 4, 5, 6)
RUN_ID = "run-1"
CHUNK_ROWS = 2500
FIELDS = (
    "marketplace", "customer_id", "review_id", "product_id", "product_title", "product_category",
    "star_rating", "helpful_votes", "total_votes", "vine", "verified_purchase", "review_headline",
    "review_body", "review_date",
)
# The dump is a folder per file; the folder carries the name.
DUMP_NAME = r"dump=([^/]+)/[^/]+$"
# One file of the dump has a misspelt column and fails as a whole.
BROKEN_FILE = "amazon_reviews_us_PROMO_v1_01.tsv"
BROKEN_FIELD = "headline"
ROWS_PER_FILE = 120_000_000
# Rows of a range that is sorted by one task; there are no fewer ranges than the session has partitions.
ROWS_PER_RANGE = 400_000
# Keys by which a range is cut.
KEYS_PER_RANGE = 100
TIE = ("seq", "review_id", "product_id")
# Between the values of a packed text, which are numbers and letters, and in place of one that is null.
SEP, NONE = "|", "-"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def reviews(spark: SparkSession, sf_dir: str, share: float = 1.0, packed: bool = False) -> DataFrame:
    """Raw reviews: text columns and the order key ``seq``; or those of a ``share`` of the lines, taken at random.

    Whoever reads all columns has what only the line tells ``packed`` into one text while rows are shuffled, which is narrower.
    """
    line, order, part = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "part"))
    line = line.sample(share, seed=1) if share < 1 else line
    text = lambda c: F.col(c).cast("string")
    quantity = F.col("l_quantity").cast("int")
    percent = lambda c: F.round(F.col(c) * 100).cast("int").cast("string")
    own = {
        "number": text("l_linenumber"),
        "star_rating": F.when(quantity == 50, "abc").when(quantity == 49, "4.5").otherwise((quantity % 6).cast("string")),
        "helpful_votes": percent("l_tax"),
        "total_votes": percent("l_discount"),
        "vine": F.when(F.col("l_linestatus") == "F", "Y").otherwise("N"),
        "verified_purchase": F.when(F.col("l_returnflag") == "A", "Y").when(F.col("l_returnflag") == "N", "N").otherwise("y"),
        # A body that is not there, or null for the part's.
        "body": F.when(F.col("l_suppkey") % 17 == 0, "").when(F.col("l_suppkey") % 19 == 0, "N/A"),
    }
    if packed:
        line = line.select("l_orderkey", "l_partkey", "l_extendedprice", F.concat_ws(SEP, *[F.coalesce(c, F.lit(NONE)) for c in own.values()]).alias("_own"))
        cut = F.split("_own", f"[{SEP}]", -1)
        own = {name: F.nullif(F.get(cut, F.lit(i)), F.lit(NONE)) for i, name in enumerate(own)}
    joined = line.join(order, line.l_orderkey == order.o_orderkey).join(part, line.l_partkey == part.p_partkey)
    return joined.select(
        F.lit("US").alias("marketplace"),
        text("o_custkey").alias("customer_id"),
        F.concat(F.lit("R"), text("l_orderkey"), F.lit("-"), own["number"]).alias("review_id"),
        text("l_partkey").alias("product_id"),
        F.col("p_name").alias("product_title"),
        F.col("p_type").alias("product_category"),
        *[own[c].alias(c) for c in ("star_rating", "helpful_votes", "total_votes", "vine", "verified_purchase")],
        F.col("o_orderpriority").alias("review_headline"),
        F.coalesce(own["body"], F.concat_ws(" ", "p_name", "p_brand")).alias("review_body"),
        F.when(F.col("p_size") == 13, "notadate").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("review_date"),
        F.col("l_extendedprice").alias("seq"),
        # What the dump needs besides.
        (F.col("l_orderkey") + F.col("l_partkey") + F.round(F.col("l_extendedprice") * 100).cast("long")).alias("_spread"),
        F.col("l_partkey").alias("_part"),
    )


def nulled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews with null tokens read as null."""
    return reviews(spark, sf_dir).select(*[null_if_token(F.col(c)).alias(c) for c in FIELDS], "seq")


def typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coerce(nulled(spark, sf_dir))


def day(column: str = "review_date") -> Column:
    """A date as text, so that every engine prints it alike."""
    return F.date_format(column, "yyyy-MM-dd").alias(column)


_made: dict[tuple[str, str, str], object] = {}


def once(spark: SparkSession, sf_dir: str, name: str, make):
    """Written inputs are made once per session and scale."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _made:
        _made[key] = make()
    return _made[key]


def dump(spark: SparkSession, sf_dir: str) -> str:
    """Folder with the reviews as delimited files, lines of a file in ``seq`` order.

    Some lines have a field too many or too few, some are followed by a blank line. A file is written by
    one task, so the number of files grows with the rows. That task sorts no lines: ranges of them are
    sorted by many tasks, and it gets them packed.
    """

    def make() -> str:
        rows = table(spark, sf_dir, "lineitem").count()
        slots, parts = 2 + rows // ROWS_PER_FILE, 1 + rows // ROWS_PER_RANGE
        # Keys that tell where ranges begin; all lines are sorted and written.
        share = KEYS_PER_RANGE * max(parts, int(spark.conf.get("spark.sql.shuffle.partitions"))) / max(rows, 1)
        types = sorted(r.p_type for r in table(spark, sf_dir, "part").select("p_type").distinct().collect() if r.p_type is not None)
        # A number per category and slot, from which the name follows; a remainder may be below zero, and the last one is for none.
        span = 2 * slots
        number = (F.array_position(F.array(*map(F.lit, types)), F.col("product_category")) - 1) * span + F.coalesce(F.col("_spread") % slots + slots - 1, F.lit(span - 1))
        kind = F.get(F.array(*map(F.lit, types)), F.floor(F.col("number") / span).cast("int"))
        slot = F.format_string("%02d", F.when(F.col("number") % span < span - 1, F.col("number") % span - (slots - 1)))
        name = F.when(F.col("number").isNotNull(), F.concat(F.lit("amazon_reviews_us_"), kind, F.lit("_v1_"), slot, F.lit(".tsv")))
        whole = F.concat_ws("\t", *FIELDS)
        line = (
            F.when(F.col("_part") % 97 == 0, F.concat_ws("\t", whole, F.lit("extra")))
            .when(F.col("_part") % 89 == 0, F.concat_ws("\t", *FIELDS[:-1]))
            .otherwise(whole)
        )
        line = F.when(F.col("_part") % 83 == 0, F.concat(line, F.lit("\n"))).otherwise(line)
        header = "\t".join(FIELDS)
        broken = "\t".join(BROKEN_FIELD if f == "review_headline" else f for f in FIELDS)
        head = F.when(F.col("dump") == BROKEN_FILE, broken).otherwise(header)
        path = scratch_path(spark, "dump")
        lines, some = (r.select(number.cast("int").alias("number"), *TIE, line.alias("line")) for r in (reviews(spark, sf_dir, packed=True), reviews(spark, sf_dir, share)))
        write_sorted_text(lines, path, {"dump": name, "head": head}, len(types) * span, order=TIE, parts=parts, sample=some)
        return path

    return once(spark, sf_dir, "dump", make)


def part_dump(spark: SparkSession, sf_dir: str, folder: str, name: str, remainders: tuple[int, ...]) -> str:
    """A file of the reviews of some products, as compressed parts with a header each; returns its folder."""
    path = os.path.join(folder, f"dump={name}")
    rows = reviews(spark, sf_dir, packed=True).where((F.col("_part") % 3).isin(*remainders)).select(*FIELDS)
    rows.write.option("header", True).option("sep", "\t").option("quote", "\0").option("emptyValue", "").option("compression", "gzip").csv(path)
    return path


def part_paths(spark: SparkSession, *folders: str) -> dict[str, str]:
    found = list_files(spark, folders, ".csv.gz", name_pattern=DUMP_NAME)
    return {r.path: r.source_file for r in found.collect()}


def dump_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return list_files(spark, dump(spark, sf_dir), ".txt", name_pattern=DUMP_NAME)


def dump_paths(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Path to name of every file of the dump."""
    return {r.path: r.source_file for r in dump_files(spark, sf_dir).collect()}


def dump_headers(spark: SparkSession, sf_dir: str):
    return once(spark, sf_dir, "headers", lambda: read_headers(spark, list(dump_paths(spark, sf_dir))))


def run(spark: SparkSession, sf_dir: str) -> tuple[IngestConfig, IngestResult]:
    """A full run over the dump, shared by the queries that look at its tables."""

    def make():
        config = run_config(spark, "run")
        return config, ingest(spark, dump(spark, sf_dir), config)

    return once(spark, sf_dir, "run", make)


def run_config(spark: SparkSession, name: str) -> IngestConfig:
    return IngestConfig(
        root=scratch_path(spark, name), run_id=RUN_ID, as_of=AS_OF, suffix=".txt", recursive=True,
        name_pattern=DUMP_NAME, chunk_rows=CHUNK_ROWS, rejects=ALL,
    )
