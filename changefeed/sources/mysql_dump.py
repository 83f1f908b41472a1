"""MySQL dumps: every INSERT statement is one line, so lines decode alone."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changefeed.functions.json_text import json_quote
from changefeed.functions.positions import binlog_file_number
from changefeed.functions.values import json_key, json_object, positional_key
from changefeed.operators.envelope import EVENT_COLUMNS, make_event
from changefeed.operators.filters import filter_tables
from changefeed.sources.pg_dump import read_lines

# The statement head and the recorded log position.
INSERT_HEAD = r"^INSERT INTO `([^`]+)` VALUES "
LOG_POSITION = r"MASTER_LOG_FILE='([^']+)',\s*MASTER_LOG_POS=(\d+)"

_QUOTED = r"'[^'\\]*+(?:(?:\\.|'')[^'\\]*+)*+'"
TUPLE = rf"\((?:{_QUOTED}|[^()'])*+\)"
# A character set introducer (_binary, _utf8mb4) belongs to the literal after it.
INTRODUCER = r"_[a-z0-9]+ +(?=')"
VALUE = rf"(?:{INTRODUCER})?{_QUOTED}|[^,()'\s]+"

# String escapes other than the backslash itself.
STRING_ESCAPES = [
    ("''", "'"), ("\\'", "'"), ('\\"', '"'), ("\\0", "\0"), ("\\b", "\b"),
    ("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t"), ("\\Z", "\x1a"),
]


def _unescape(text: Column) -> Column:
    # Cut at escaped backslashes first, so what follows one is not an escape.
    def part(piece: Column) -> Column:
        for old, new in STRING_ESCAPES:
            piece = F.replace(piece, F.lit(old), F.lit(new))
        return piece

    whole = F.array_join(F.transform(F.split(text, r"\\\\"), part), "\\")
    return F.when(text.rlike(r"\\|''"), whole).otherwise(text)


def _value(token: Column) -> Column:
    """A quoted string by content, a bare NULL as null, other tokens as text."""
    token = F.regexp_replace(token, f"^{INTRODUCER}", "")
    inner = F.substring(token, F.lit(2), F.length(token) - 2)
    return (
        F.when(token.startswith("'"), json_quote(_unescape(inner)))
        .when(token == "NULL", "null")
        .otherwise(json_quote(token))
    )


def _object(tuple_text: Column, names: Column) -> Column:
    tokens = F.regexp_extract_all(tuple_text, F.lit(VALUE), F.lit(0))
    return json_object(
        F.transform(
            tokens,
            lambda token, i: F.concat(
                F.coalesce(json_key(F.get(names, i)), positional_key(i)), _value(token)
            ),
        )
    )


UNREAD = "unread text in statement"
NO_PLAIN_INSERT = "no plain insert"
TOO_FEW = "too few values"
UNREAD_VALUE = "unread text in tuple"


def _inserts(lines: DataFrame) -> DataFrame:
    """Lines that begin an INSERT, with their table and the text after the head."""
    # A line that records a log position is never also a statement.
    text = F.col("value")
    head = F.nullif(F.regexp_extract("value", INSERT_HEAD, 1), F.lit(""))
    return lines.filter(text.startswith("INSERT INTO ") & ~text.rlike(LOG_POSITION)).select(
        "file", "line", "value", head.alias("table"), F.regexp_replace("value", INSERT_HEAD, "").alias("body"),
    )


def _names(columns: Mapping[str, list[str]] | None) -> Column:
    names = F.lit(None).cast("array<string>")
    for table, listed in (columns or {}).items():
        names = F.when(F.col("table") == table, F.array(*[F.lit(name) for name in listed])).otherwise(names)
    return names


def _tuples(statements: DataFrame, columns: Mapping[str, list[str]] | None) -> DataFrame:
    """One row per value tuple; ``reject_reason`` tells those that yield no event."""
    tuples = statements.select(
        "file", "table", "line", _names(columns).alias("_names"),
        F.posexplode(F.regexp_extract_all("body", F.lit(TUPLE), F.lit(0))).alias("idx", "_tuple"),
    )
    tuples = tuples.withColumn("_n", F.size(F.regexp_extract_all("_tuple", F.lit(VALUE), F.lit(0))))
    # without its values a tuple is commas in parentheses, one fewer than values
    frame = F.regexp_replace(F.regexp_replace("_tuple", VALUE, ""), r"\s+", "")
    whole = frame == F.concat(F.lit("("), F.repeat(F.lit(","), F.greatest(F.col("_n") - 1, F.lit(0))), F.lit(")"))
    reason = F.when(~whole, UNREAD_VALUE).when(F.col("_names").isNotNull() & (F.size("_names") > F.col("_n")), TOO_FEW)
    return tuples.withColumn("reject_reason", reason)


def read_mysql_dump(
    spark: SparkSession,
    path: str,
    schema: str,
    tables: Iterable[str] | None = None,
    columns: Mapping[str, list[str]] | None = None,
    source: str = "",
    timestamp: Column | None = None,
    pieces: bool = False,
) -> DataFrame:
    """One INSERT event per value tuple.

    Values are named ``col_i`` unless ``columns`` lists a table's names; then a tuple
    needs a value for each, and more are named by their place. ``seq`` is the number of the line in the whole dump, ``idx``
    that of the tuple in it. What yields no event is told by ``mysql_dump_rejects``.
    ``pieces`` as for ``read_lines``.
    """
    inserts = _inserts(read_lines(spark, path, pieces)).filter(F.col("table").isNotNull())
    tuples = _tuples(filter_tables(inserts, tables), columns).filter(F.col("reject_reason").isNull())
    data = _object(F.col("_tuple"), F.col("_names"))
    event = make_event("INSERT", schema, F.col("table"), data, "", timestamp)
    nothing = F.lit(None).cast("bigint")
    return tuples.select(
        F.lit(source).alias("source"),
        *[value.alias(name) for name, value in event.items()],
        nothing.alias("pos_hi"),
        nothing.alias("pos_lo"),
        F.col("line").alias("seq"),
        "idx",
    ).select(*EVENT_COLUMNS)


def mysql_dump_rejects(
    spark: SparkSession,
    path: str,
    tables: Iterable[str] | None = None,
    columns: Mapping[str, list[str]] | None = None,
    pieces: bool = False,
) -> DataFrame:
    """What the INSERT lines of a dump hold beside events: (file, line, idx, table, value, reject_reason).

    Whole statements whose head is not understood, tuples with text that is no value or
    with fewer values than names, and what is left of a statement without its tuples.
    """
    inserts = _inserts(read_lines(spark, path, pieces))
    known = filter_tables(inserts.filter(F.col("table").isNotNull()), tables)
    none = F.lit(None).cast("int").alias("idx")
    odd = inserts.filter(F.col("table").isNull()).select(
        "file", "line", none, "table", "value", F.lit(NO_PLAIN_INSERT).alias("reject_reason")
    )
    rest = F.trim(F.regexp_replace("body", TUPLE, ""))
    unread = known.withColumn("_rest", rest).filter(~F.col("_rest").rlike(r"^(\s*,\s*)*;?$")).select(
        "file", "line", none, "table", F.col("_rest").alias("value"), F.lit(UNREAD).alias("reject_reason")
    )
    bad = _tuples(known, columns).filter(F.col("reject_reason").isNotNull()).select(
        "file", "line", "idx", "table", F.col("_tuple").alias("value"), "reject_reason"
    )
    return odd.unionByName(unread).unionByName(bad)


def dump_position(spark: SparkSession, path: str, pieces: bool = False) -> DataFrame:
    """The last log position each dump file records, where streaming starts.

    Files without one have no row. With ``pieces`` a folder is one dump (see ``read_lines``).
    """
    lines = read_lines(spark, path, pieces).filter(F.col("value").rlike(LOG_POSITION))
    found = lines.select(
        "file", "line",
        F.regexp_extract("value", LOG_POSITION, 1).alias("log_file"),
        F.regexp_extract("value", LOG_POSITION, 2).cast("bigint").alias("log_pos"),
    )
    last = F.max_by(F.struct("log_file", "log_pos"), F.col("line"))
    return (
        found.groupBy("file")
        .agg(last.alias("_p"))
        .select(
            "file", "_p.log_file", "_p.log_pos",
            binlog_file_number(F.col("_p.log_file")).alias("pos_hi"),
        )
    )
