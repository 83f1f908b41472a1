"""Subjects: the dotted address an event is published under."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stand-ins for an empty schema and an empty table.
DEFAULT_SCHEMA = "default"
DDL_TABLE = "_ddl"

DEFAULT_PREFIX = "cdc"


def sanitize_token(text: Column) -> Column:
    """Replace the separator and wildcard characters with an underscore."""
    return F.translate(text, ".*> ", "____")


def subject(schema: Column, table: Column, prefix: Column | str = DEFAULT_PREFIX) -> Column:
    """``prefix.schema.table`` with stand-ins for empty parts."""
    lead = F.lit(prefix) if isinstance(prefix, str) else prefix
    schema_part = F.coalesce(F.nullif(schema, F.lit("")), F.lit(DEFAULT_SCHEMA))
    table_part = F.coalesce(F.nullif(table, F.lit("")), F.lit(DDL_TABLE))
    return F.concat_ws(".", lead, sanitize_token(schema_part), sanitize_token(table_part))


def subject_matches(address: Column, pattern: str) -> Column:
    """Does a subject match a consumer pattern?

    ``*`` stands for one token and a trailing ``>`` for one or more. Patterns
    without ``*`` become an equality or a prefix test, which reach the scan.
    """
    if pattern == ">":
        return address != ""
    open_end = pattern.endswith(".>")
    tokens = (pattern[:-2] if open_end else pattern).split(".")
    if "*" not in tokens:
        fixed = ".".join(tokens)
        if open_end:
            return address.startswith(fixed + ".") & (F.length(address) > len(fixed) + 1)
        return address == fixed
    parts = [r"[^.]+" if token == "*" else re.escape(token) for token in tokens]
    return address.rlike("^" + r"\.".join(parts) + (r"\..+$" if open_end else "$"))
