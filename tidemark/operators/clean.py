"""Coercion, audit columns and the cleaning chain. Each step is DataFrame in, DataFrame out."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import constants as C
from tidemark.functions.scalars import batch_id, category_of, chunk_of, safe_number, safe_timestamp, yes_no
from tidemark.operators.dedup import first_per_key
from tidemark.operators.rules import REVIEW_RULES, Rule, keep


def coerce(
    df: DataFrame,
    *,
    flags: Sequence[str] = C.FLAG_COLUMNS,
    numbers: Sequence[str] = C.NUMBER_COLUMNS,
    dates: Sequence[str] = C.DATE_COLUMNS,
    date_formats: Sequence[str] = (C.DATE_FORMAT,),
) -> DataFrame:
    """Typed columns from text; columns the table lacks are left out of account."""
    typed = {c: yes_no(F.col(c)) for c in flags if c in df.columns}
    typed |= {c: safe_number(F.col(c)) for c in numbers if c in df.columns}
    typed |= {c: safe_timestamp(F.col(c), date_formats) for c in dates if c in df.columns}
    return df.withColumns(typed) if typed else df


def with_chunk(df: DataFrame, chunk_rows: int = C.CHUNK_ROWS) -> DataFrame:
    """Add the index of the chunk a row's position falls in."""
    return df.withColumn("chunk_idx", chunk_of(F.col("pos"), chunk_rows))


def with_file_chunk(df: DataFrame) -> DataFrame:
    """Every file is one chunk. Needs no positions."""
    return df.withColumn("chunk_idx", F.lit(0))


def audit(df: DataFrame, run_id: str, run_at: datetime) -> DataFrame:
    """Ingest time and batch id of a run. They follow from the file and chunk, so add them last."""
    return df.withColumns(
        {
            "ingest_time": F.lit(run_at).cast("timestamp"),
            "batch_id": batch_id(run_id, F.col("source_file"), F.col("chunk_idx")),
        }
    )


def partition_values(df: DataFrame, as_of: datetime, pattern: str = C.CATEGORY_PATTERN) -> DataFrame:
    """``year`` and ``month`` of the run and ``category`` of the source file."""
    return df.withColumns(
        {
            "year": F.lit(as_of.year).cast("int"),
            "month": F.lit(f"{as_of.month:02d}"),
            "category": category_of(F.col("source_file"), pattern),
        }
    )


def clean(
    df: DataFrame,
    order: Sequence[Column | str],
    *,
    rules: Sequence[Rule] = REVIEW_RULES,
    keys: Sequence[str] = C.DEDUP_KEYS,
    scope: Sequence[str] = (),
) -> DataFrame:
    """Filters first, duplicates last: a copy that was filtered out lets a later one stay."""
    kept = keep(df, rules)
    present = [k for k in keys if k in df.columns]
    return first_per_key(kept, present, order, scope=scope) if present else kept
