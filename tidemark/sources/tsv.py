"""Delimited text scan with explicit policies for malformed rows.

Lines are read as text, so quotes and backslashes are ordinary characters and a large
file is split over many tasks. Nothing here sorts or shuffles the lines.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark import constants as C
from tidemark.functions.scalars import null_if_token
from tidemark.session import broadcast_if_small, stored
from tidemark.sources.files import PLAIN_NAME, file_id, literal, logical_name

SKIP_LONG = "skip_long"  # drop rows with too many fields, pad rows with too few
STRICT = "strict"  # drop every row with a wrong number of fields
FAIL = "fail"  # a row with too many fields stops the query
POLICIES = (SKIP_LONG, STRICT, FAIL)

# The position of a line. Ordering by these three gives file order without counting lines.
ORDER = ("_path", "_block", "_mid")
# The same, for scans that count lines.
POSITION = ("_path", "pos")
# A split table with up to this many rows (about 150 bytes each, one per 128 MB of input) is broadcast.
BROADCAST_SPLITS = 1_500_000


# Columns a scan adds. A field called source_file gives way to the added column; a field with
# one of the other names gets a suffix.
ADDED = ("pos", "chunk_idx", "reason", "file_id", "_record", "_line", *ORDER)


@dataclass(frozen=True)
class Header:
    """The header line of one or more files and the column names it stands for."""

    line: str
    columns: tuple[str, ...]
    # Why the file could not be read, if it could not.
    error: str | None = None


def parse_header(line: str, sep: str = "\t") -> tuple[str, ...]:
    """Column names of a header line; empty ones are numbered, repeated ones get a suffix."""
    seen = dict.fromkeys(ADDED, 1)
    names = []
    for i, raw in enumerate(line.lstrip("\ufeff").split(sep)):
        name = raw or f"Unnamed: {i}"
        n = seen.get(name, 0)
        seen[name] = n + 1
        names.append(f"{name}.{n}" if n else name)
    return tuple(names)


def is_blank(line: Column, sep: str = "\t") -> Column:
    """A line of white space only. A line of separators is a row of missing values."""
    return ~F.contains(line, F.lit(sep)) & line.rlike(r"^\s*$")


def read_headers(spark: SparkSession, paths: Sequence[str], sep: str = "\t", workers: int = 16) -> dict[str, Header]:
    """First non-blank line of each file. Each read stops after one line of the first split.

    A file that cannot be read does not stop the others; its header has the error.
    """

    def first_line(path: str) -> Header:
        try:
            row = spark.read.text(literal(path)).filter(~is_blank(F.col("value"), sep)).first()
        except Exception as error:  # noqa: BLE001
            return Header("", (), f"cannot read: {type(error).__name__}")
        return Header(row.value, parse_header(row.value, sep)) if row else Header("", (), "no columns to parse from file")

    with ThreadPoolExecutor(max_workers=workers) as pool:
        return dict(zip(paths, pool.map(first_line, paths), strict=True))


def header_rows(spark: SparkSession, folder: str, name_pattern: str = PLAIN_NAME, sep: str = "\t") -> DataFrame:
    """Column names of all files below a folder: ``source_file``, ``column_name``. One job, whatever the number of files."""
    text = spark.read.option("recursiveFileLookup", "true").text(folder).select(
        "value", F.col("_metadata.file_path").alias("_path"), F.monotonically_increasing_id().alias("_mid"),
        F.col("_metadata.file_block_start").alias("_block"),
    )
    first = text.filter(~is_blank(F.col("value"), sep)).groupBy("_path").agg(
        F.min_by("value", F.struct("_block", "_mid")).alias("line")
    )
    names = F.split(F.regexp_replace("line", "^\ufeff", ""), _literal(sep), -1)
    return first.select(logical_name(F.col("_path"), name_pattern, encoded=True).alias("source_file"), F.explode(names).alias("column_name"))


def group_by_header(headers: Mapping[str, Header]) -> dict[Header, list[str]]:
    """Files that share a header are scanned together; the number of scans is that of layouts."""
    groups: dict[Header, list[str]] = {}
    for path, header in headers.items():
        groups.setdefault(header, []).append(path)
    return groups


def raw_lines(
    spark: SparkSession,
    paths: Sequence[str],
    name_pattern: str = PLAIN_NAME,
    sep: str = "\t",
    tokens: Sequence[str] = (),
) -> DataFrame:
    """Every physical line, its fields (``parts``) and the place it came from.

    The fields are cut in the projection that numbers the lines, and ``tokens`` among them become
    null there. Filters are not pushed below a numbering, so this is done once per line, however
    many later conditions look at the fields.
    """
    parts = F.split(F.col("value"), _literal(sep), -1)
    if tokens:
        parts = F.transform(parts, lambda field: null_if_token(field, tokens))
    return spark.read.text([literal(p) for p in paths]).select(
        F.col("value").alias("line"),
        parts.alias("parts"),
        logical_name(F.col("_metadata.file_path"), name_pattern, encoded=True).alias("source_file"),
        file_id(F.col("_metadata.file_path"), encoded=True).alias("file_id"),
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_mid"),
    )


def _literal(sep: str) -> str:
    return sep if sep in "\t,;" else "\\" + sep


def split_table(lines: DataFrame, header: Header, sep: str = "\t") -> DataFrame:
    """One row per scan split: where its lines start in the file, and where the header is.

    This reads the files once more, but keeps a few numbers per split (one row per
    ``spark.sql.files.maxPartitionBytes`` of input), so the running sum over one file is small.
    """
    counts = lines.groupBy("source_file", "file_id", "_path", "_block").agg(
        F.min("_mid").alias("first_mid"),
        F.count("*").alias("n_lines"),
        F.min(F.when(~is_blank(F.col("line"), sep) & (F.col("line") == header.line), F.col("_mid"))).alias("found"),
    )
    in_file = W.partitionBy("_path").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    whole_file = W.partitionBy("_path")
    before = F.coalesce(F.sum("n_lines").over(in_file), F.lit(0))
    placed = counts.withColumn("before", before)
    # The first line that equals the header is the header.
    header_at = F.min(F.col("before") + F.col("found") - F.col("first_mid")).over(whole_file)
    return placed.withColumn("header_at", header_at).drop("found").withColumn("_split", _split())


def _split() -> Column:
    """A number for a split. Two splits with one number make the counts of lines fail below."""
    return F.xxhash64("_path", "_block")


def with_positions(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """Drop the header by its place and add ``pos``, the 0-based number of the line after it.

    ``pos`` counts blank and malformed lines too. ``splits`` is a stored :func:`split_table`, so
    its size is known when it is broadcast; a larger one is joined by shuffle.
    """
    offset = F.col("_mid") - F.col("first_mid")
    # Both reads must cut the files alike; a different cut stops the query.
    checked = F.when((offset >= 0) & (offset < F.col("n_lines")), offset).otherwise(
        F.raise_error(F.lit("the files or their splits changed between two reads")).cast("long")
    )
    pos = F.col("before") + checked - F.col("header_at") - 1
    # Names are worked out once per split, not once per line.
    placed = splits.drop("_path", "_block")
    return (
        lines.drop("source_file", "file_id")
        .withColumn("_split", _split())
        .join(broadcast_if_small(placed, BROADCAST_SPLITS), "_split")
        .withColumn("pos", pos)
        .filter("pos >= 0")
        .select(*lines.columns, "pos")
    )


def chunks_of(splits: DataFrame, chunk_rows: int = C.CHUNK_ROWS) -> DataFrame:
    """Every chunk of every file, those without a surviving row too. A file has at least one."""
    lines = F.sum("n_lines") - F.max("header_at") - 1
    files = splits.groupBy("source_file", "file_id", "_path").agg(lines.alias("n"))
    last = F.greatest(F.ceil(F.col("n") / chunk_rows) - 1, F.lit(0)).cast("int")
    return files.select("source_file", "file_id", F.explode(F.sequence(F.lit(0), last)).alias("chunk_idx")).distinct()


def data_lines(lines: DataFrame, header: Header) -> DataFrame:
    """Drop the header by its text, wherever it stands. Reads the files once.

    A line that repeats the header goes too, in every split alike. Use :func:`with_positions` where
    such a line must stay.
    """
    return lines.filter(F.col("line") != header.line)


def drop_blank(lines: DataFrame, sep: str = "\t") -> DataFrame:
    return lines.filter(~is_blank(F.col("line"), sep))


def apply_policy(rows: DataFrame, arity: int, policy: str = SKIP_LONG) -> DataFrame:
    """Keep the rows the policy accepts."""
    size = F.size("parts")
    if policy == SKIP_LONG:
        return rows.filter(size <= arity)
    if policy == STRICT:
        return rows.filter(size == arity)
    if policy == FAIL:
        message = F.concat(F.lit("too many fields in "), F.col("source_file"))
        return rows.filter(F.when(size <= arity, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    raise ValueError(f"policy must be one of {POLICIES}")


def misfit(arity: int, policy: str = SKIP_LONG) -> Column:
    """Why the policy leaves a line out, null if it does not."""
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    long_, short = F.size("parts") > arity, F.size("parts") < arity
    reason = F.when(long_, "too_many_fields")
    return reason.when(short, "too_few_fields") if policy == STRICT else reason


def bad_rows(rows: DataFrame, arity: int, policy: str = SKIP_LONG) -> DataFrame:
    """The rows a policy leaves out, for a handler of the caller's own."""
    size = F.size("parts")
    wrong = size != arity if policy == STRICT else size > arity
    return rows.filter(wrong).withColumn("n_fields", size)


def name_fields(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One text column per field; missing fields are null."""
    keep = [c for c in ("source_file", "file_id", *ORDER, "pos", "reason", "_line") if c in rows.columns]
    named = [F.get("parts", F.lit(i)).alias(c) for i, c in enumerate(columns) if c != "source_file"]
    return rows.select(*named, *keep)


def scan_tsv(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    policy: str = SKIP_LONG,
    positions: bool = False,
    sep: str = "\t",
    tokens: Sequence[str] = C.NULL_TOKENS,
    name_pattern: str = PLAIN_NAME,
    headers: Mapping[str, Header] | None = None,
    repeated_headers: bool = True,
) -> DataFrame:
    """Delimited files as text columns plus ``source_file``, ``file_id`` and the order columns.

    The header is dropped by its place, which a counting read finds; ``positions`` adds ``pos``.
    ``repeated_headers=False`` drops every line that equals the header and reads the files once.
    Files with different headers are aligned by column name.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    headers = headers or read_headers(spark, paths, sep)
    scans = []
    for header, members in group_by_header(headers).items():
        if header.error:
            raise ValueError(f"{header.error}: {members[0]}")
        lines = raw_lines(spark, members, name_pattern, sep, tokens)
        if positions or repeated_headers:
            body = with_positions(lines, stored(split_table(lines, header, sep), "splits"))
            body = body if positions else body.drop("pos")
        else:
            body = data_lines(lines, header)
        rows = apply_policy(drop_blank(body, sep), len(header.columns), policy)
        scans.append(name_fields(rows, header.columns))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def line_counts(
    spark: SparkSession,
    paths: Sequence[str],
    *,
    sep: str = "\t",
    name_pattern: str = PLAIN_NAME,
    headers: Mapping[str, Header] | None = None,
) -> DataFrame:
    """Per file: rows that fit, rows that are short, rows that are long. One pass, exact."""
    headers = headers or read_headers(spark, list(paths), sep)
    counts = []
    for header, members in group_by_header(headers).items():
        if header.error:
            raise ValueError(f"{header.error}: {members[0]}")
        rows = drop_blank(raw_lines(spark, members, name_pattern, sep), sep)
        arity, size = len(header.columns), F.size("parts")
        # The header line itself has the right number of fields: exactly one per physical file.
        counts.append(
            rows.groupBy("source_file", "_path")
            .agg(
                (F.count_if(size == arity) - 1).alias("fit"),
                F.count_if(size < arity).alias("short"),
                F.count_if(size > arity).alias("long"),
            )
            .groupBy("source_file")
            .agg(*[F.sum(c).alias(c) for c in ("fit", "short", "long")])
        )
    merged = reduce(lambda a, b: a.unionByName(b), counts)
    return merged.groupBy("source_file").agg(*[F.sum(c).alias(c) for c in ("fit", "short", "long")])


def read_plain(spark: SparkSession, paths: str | Sequence[str], sep: str = "\t") -> DataFrame:
    """Quoted delimited text, all columns as text; a row that does not fit stops the query."""
    return (
        spark.read.option("sep", sep).option("header", True).option("mode", "FAILFAST").csv(paths)
    )
