"""Column expressions. All of them are built-ins and stay inside generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import constants as C


def null_if_token(col: Column, tokens: Sequence[str] = C.NULL_TOKENS) -> Column:
    """Null for text that means "missing", the text itself otherwise.

    Longer text than any token is let through without a look at its content.
    """
    longest = max(len(t.encode()) for t in tokens)
    return F.when((F.octet_length(col) > longest) | ~col.isin(*tokens), col)


def yes_no(col: Column, yes: str = C.FLAG_TRUE, no: str = C.FLAG_FALSE) -> Column:
    """``Y`` is true, ``N`` is false, every other spelling is null."""
    return F.when(col == yes, F.lit(True)).when(col == no, F.lit(False))


def safe_number(col: Column) -> Column:
    """Number from text, null when it is not one; fractions and padding are accepted.

    The column occurs once in the expression, so a filter on the number stays small when the
    optimizer moves it below the projection.
    """
    return F.regexp_extract(col, C.NUMBER_PATTERN, 0).try_cast("double")


def safe_timestamp(col: Column, formats: Sequence[str] = (C.DATE_FORMAT,)) -> Column:
    """Timestamp without zone from text in one of ``formats``, null otherwise."""
    parsed = [_parsed(col, fmt) for fmt in formats]
    return F.coalesce(*parsed) if len(parsed) > 1 else parsed[0]


def _parsed(col: Column, fmt: str) -> Column:
    if fmt == C.DATE_FORMAT:
        # The plain date has a parser of its own, which is faster and takes other spellings too.
        day = F.regexp_extract(col, r"^\d{4}-\d{2}-\d{2}$", 0).try_cast("date")
        return day.cast("timestamp_ntz")
    return F.try_to_timestamp(col, F.lit(fmt)).cast("timestamp_ntz")


def category_of(file_name: Column, pattern: str = C.CATEGORY_PATTERN) -> Column:
    """Category named in a file name; ``Unknown`` when the name does not match."""
    found = F.regexp_extract(file_name, pattern, 1)
    return F.when(found == "", F.lit(C.UNKNOWN_CATEGORY)).otherwise(found)


def base_name(path: Column) -> Column:
    """Last part of a path."""
    return F.element_at(F.split(path, "/"), -1)


def has_suffix(path: Column, suffix: str) -> Column:
    return F.endswith(path, F.lit(suffix))


def chunk_of(position: Column, size: int = C.CHUNK_ROWS) -> Column:
    """Index of the fixed-size chunk a 0-based position falls in."""
    return F.floor(position / F.lit(size)).cast("int")


def batch_id(run_id: str, file_name: Column, chunk_idx: Column) -> Column:
    """One id per run, file and chunk; a retried task computes the same one."""
    return F.sha2(F.concat_ws("|", F.lit(run_id), file_name, chunk_idx.cast("string")), 256)


def month_text(ts: Column) -> Column:
    return F.lpad(F.month(ts).cast("string"), 2, "0")


def part_name(idx: Column) -> Column:
    """``part_00000.parquet``; a longer index is kept whole."""
    text = idx.cast("string")
    padded = F.when(F.length(text) < 5, F.lpad(text, 5, "0")).otherwise(text)
    return F.concat(F.lit("part_"), padded, F.lit(".parquet"))


def object_name(year: Column, month: Column, category: Column, idx: Column) -> Column:
    """Name of one output part in the ``year=/month=/category=`` layout."""
    return F.concat_ws(
        "/",
        F.lit("bronze/reviews"),
        F.concat(F.lit("year="), year.cast("string")),
        F.concat(F.lit("month="), month),
        F.concat(F.lit("category="), category),
        part_name(idx),
    )


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text with offset, six fraction digits; the session zone must be UTC."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def file_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd_HHmmss")


def quoted(name: str) -> str:
    """A column name that may have dots in it."""
    return "`" + name.replace("`", "``") + "`"


def to_record(columns: Sequence[str]) -> Column:
    """JSON text of a row, every value as text, missing values kept as null."""
    fields = [F.col(quoted(c)).cast("string").alias(c) for c in columns]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def from_record(col: Column, columns: Sequence[str]) -> Column:
    """Struct of text columns from :func:`to_record` output."""
    return F.from_json(col, ", ".join(f"{quoted(c)} STRING" for c in columns))
