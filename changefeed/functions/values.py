"""Row images: typed source values rendered as JSON text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from changefeed.functions.json_text import is_valid_json, json_quote

# Postgres type OIDs.
PG_NUMERIC_OIDS = [20, 21, 23, 26, 700, 701, 1700]
PG_BOOL_OID = 16
PG_JSON_OIDS = [114, 3802]

# MySQL type names by how they are rendered.
MYSQL_NUMBER_TYPES = [
    "tinyint", "smallint", "mediumint", "int", "integer", "bigint",
    "float", "double", "real", "decimal", "numeric", "year", "bit",
]
MYSQL_BOOL_TYPES = ["bool", "boolean"]
MYSQL_INSTANT_TYPES = ["datetime", "timestamp"]
MYSQL_BINARY_TYPES = [
    "binary", "varbinary", "tinyblob", "blob", "mediumblob", "longblob",
]

# How a column is rendered, whatever database it came from.
NUMBER, BOOL, JSON, TEXT, INSTANT, BYTES = (
    "number", "bool", "json", "text", "instant", "bytes",
)


def pg_kind(oid: Column) -> Column:
    return (
        F.when(oid.isin(PG_NUMERIC_OIDS), NUMBER)
        .when(oid == PG_BOOL_OID, BOOL)
        .when(oid.isin(PG_JSON_OIDS), JSON)
        .otherwise(TEXT)
    )


def mysql_kind(type_name: Column) -> Column:
    """Rendering kind of a declared type such as ``decimal(10,2) unsigned``."""
    lower = F.lower(F.trim(type_name))
    base = F.regexp_extract(lower, r"^([a-z]+)", 1)
    return (
        F.when(lower.rlike(r"^tinyint\(1\)") | base.isin(MYSQL_BOOL_TYPES), BOOL)
        .when(base.isin(MYSQL_NUMBER_TYPES), NUMBER)
        .when(base == "json", JSON)
        .when(base.isin(MYSQL_INSTANT_TYPES), INSTANT)
        .when(base.isin(MYSQL_BINARY_TYPES), BYTES)
        .otherwise(TEXT)
    )


def render_pg_kind(
    text: Column, kind: Column, quote: Callable[[Column], Column] = json_quote
) -> Column:
    """Text value of a known kind to JSON text."""
    return (
        F.when(kind == NUMBER, text)
        .when(kind == BOOL, F.when(text == "t", "true").otherwise("false"))
        .when((kind == JSON) & is_valid_json(text), text)
        .otherwise(quote(text))
    )


def render_pg_cell(
    marker: Column, text: Column, kind: Column, quote: Callable[[Column], Column] = json_quote
) -> Column:
    """One tuple cell: null, unchanged, text or an unknown marker."""
    return (
        F.when(marker == "t", render_pg_kind(text, kind, quote))
        .when(marker == "n", "null")
        .when(marker == "u", '"unchanged"')
        .otherwise('"unknown"')
    )


def render_pg_value(text: Column, oid: Column, marker: Column | None = None) -> Column:
    """A Postgres value by type OID; a null text without marker is ``null``."""
    if marker is None:
        marker = F.when(text.isNull(), "n").otherwise("t")
    return render_pg_cell(marker, text, pg_kind(oid))


def render_mysql_kind(text: Column, kind: Column) -> Column:
    is_true = F.lower(text).isin("1", "true")
    # zone-less source times are UTC; the result always has milliseconds
    instant = F.date_format(text.try_cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")
    unreadable = (kind == BYTES) & ~F.is_valid_utf8(text)
    shown = F.when(unreadable, F.base64(text.cast("binary"))).otherwise(
        F.coalesce(F.when(kind == INSTANT, instant), text)
    )
    return (
        F.when(text.isNull(), "null")
        .when(kind == NUMBER, text)
        .when(kind == BOOL, F.when(is_true, "true").otherwise("false"))
        .when((kind == JSON) & is_valid_json(text), text)
        .otherwise(json_quote(shown))
    )


def render_mysql_value(text: Column, type_name: Column) -> Column:
    """A MySQL value by declared type name."""
    return render_mysql_kind(text, mysql_kind(type_name))


def json_key(name: Column) -> Column:
    """``"name":``, ready to be put before a value."""
    return F.concat(json_quote(name), F.lit(":"))


def positional_key(index: Column) -> Column:
    """Key of a value whose column name is unknown."""
    return F.concat(F.lit('"col_'), index.cast("string"), F.lit('":'))


def json_object(members: Column) -> Column:
    """Array of ``"key":value`` texts to one object text."""
    return F.concat(F.lit("{"), F.array_join(members, ", "), F.lit("}"))


def render_row(names: Column, values: Column) -> Column:
    """Column names and already rendered values to one object text."""
    return json_object(
        F.transform(
            values,
            lambda value, i: F.concat(
                F.coalesce(json_key(F.get(names, i)), positional_key(i)), value
            ),
        )
    )


def quoted_or_null(value: Column) -> Column:
    """Any value as a quoted string, null as ``null``."""
    return F.coalesce(json_quote(value.cast("string")), F.lit("null"))
