"""Narrow filters over events; none of them shuffles."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changefeed.functions.subjects import subject_matches
from changefeed.operators.envelope import PUBLISHED_TYPES, TABLE_EVENT_TYPES


def listed_tables(
    tables: Iterable[str],
    qualified: bool = False,
    table_col: str = "table",
    schema_col: str = "schema",
) -> Column:
    """Is the row's table on the list?

    Bare names ignore the schema. With ``qualified`` each entry is an exact
    ``schema.table`` cut at the first dot, or a pair (schema, table), which also
    names schemas with a dot.
    """
    if not qualified:
        return F.col(table_col).isin(sorted(set(tables)))
    # Testing the parts, not their concatenation, lets the test reach the scan.
    by_schema: dict[str, list[str]] = {}
    for name in set(tables):
        schema, table = name.partition(".")[::2] if isinstance(name, str) else name
        by_schema.setdefault(schema, []).append(table)
    keep = F.lit(False)
    for schema, listed in sorted(by_schema.items()):
        keep = keep | ((F.col(schema_col) == schema) & F.col(table_col).isin(sorted(listed)))
    return keep


def filter_tables(
    df: DataFrame, tables: Iterable[str] | None, qualified: bool = False
) -> DataFrame:
    """Keep listed tables; an empty list keeps all."""
    names = list(tables or ())
    return df.filter(listed_tables(names, qualified)) if names else df


def publishable(df: DataFrame) -> DataFrame:
    """Row changes, truncates and DDL; markers and heartbeats stay inside."""
    return df.filter(F.col("type").isin(PUBLISHED_TYPES))


def table_events(df: DataFrame) -> DataFrame:
    """Events that belong to one table."""
    return df.filter(F.col("type").isin(TABLE_EVENT_TYPES))


def match_subject(df: DataFrame, pattern: str, address: str = "subject") -> DataFrame:
    """Keep rows whose subject matches a consumer pattern."""
    return df.filter(subject_matches(F.col(address), pattern))
