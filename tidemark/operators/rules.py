"""Row rules as data: the same rules run on any table that has the columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import constants as C


@dataclass(frozen=True)
class InRange:
    """A number between two bounds; a missing one does not pass."""

    column: str = "star_rating"
    low: float = C.RATING_LOW
    high: float = C.RATING_HIGH
    low_inclusive: bool = False
    high_inclusive: bool = True
    name: str = "rating"

    def applies(self, columns: Sequence[str]) -> bool:
        return self.column in columns

    def passes(self, df: DataFrame) -> Column:
        # NaN is above every number, so the upper bound keeps it out.
        col = F.col(self.column)
        low = col >= self.low if self.low_inclusive else col > self.low
        high = col <= self.high if self.high_inclusive else col < self.high
        return low & high


@dataclass(frozen=True)
class NotAbove:
    """One number is at most another; a missing one does not pass."""

    smaller: str = "helpful_votes"
    larger: str = "total_votes"
    name: str = "votes"

    def applies(self, columns: Sequence[str]) -> bool:
        return self.smaller in columns and self.larger in columns

    def passes(self, df: DataFrame) -> Column:
        within = F.col(self.smaller) <= F.col(self.larger)
        if dict(df.dtypes)[self.larger] in ("double", "float"):
            # Every number is below NaN, which must not let a row pass.
            within = within & (F.col(self.larger) <= float("inf"))
        return within


@dataclass(frozen=True)
class Present:
    """The listed columns that exist are not null; white space counts as present."""

    columns: tuple[str, ...] = C.TEXT_COLUMNS
    name: str = "null_text"

    def applies(self, columns: Sequence[str]) -> bool:
        return any(c in columns for c in self.columns)

    def passes(self, df: DataFrame) -> Column:
        tests = [F.col(c).isNotNull() for c in self.columns if c in df.columns]
        out = tests[0]
        for test in tests[1:]:
            out = out & test
        return out


Rule = InRange | NotAbove | Present
REVIEW_RULES: tuple[Rule, ...] = (InRange(), NotAbove(), Present())


def keep(df: DataFrame, rules: Sequence[Rule] = REVIEW_RULES) -> DataFrame:
    """Rows that pass every rule that applies; rules on absent columns do nothing."""
    for rule in rules:
        if rule.applies(df.columns):
            df = df.filter(rule.passes(df))
    return df


def with_reason(df: DataFrame, rules: Sequence[Rule] = REVIEW_RULES, column: str = "reason") -> DataFrame:
    """Name of the first rule a row fails, null when it passes all."""
    failed = [
        F.when(~F.coalesce(rule.passes(df), F.lit(False)), F.lit(rule.name))
        for rule in rules
        if rule.applies(df.columns)
    ]
    return df.withColumn(column, F.coalesce(*failed) if failed else F.lit(None).cast("string"))
