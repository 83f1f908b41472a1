"""Schema versions per table as an append-only table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from changefeed.functions.positions import format_lsn
from changefeed.operators.ordered import asof_join

HISTORY_SCHEMA = (
    "source string, schema string, `table` string, position string, timestamp bigint, "
    "columns array<struct<name: string, typeName: string, typeOid: bigint>>, "
    "lsn_pos bigint, seq bigint"
)


def schema_history(relations: DataFrame, dedupe: bool = False) -> DataFrame:
    """One row per announced table layout, before any table filter.

    ``dedupe`` drops announcements that repeat the version before them.
    """
    known = F.col("lsn_pos").isNotNull()
    history = relations.select(
        "source",
        F.col("namespace").alias("schema"),
        F.col("name").alias("table"),
        F.when(known, format_lsn(F.col("lsn_pos"))).otherwise("unknown").alias("position"),
        "timestamp",
        "columns",
        "lsn_pos",
        "seq",
    )
    return collapse_repeats(history) if dedupe else history


def collapse_repeats(history: DataFrame) -> DataFrame:
    """Keep a version only where it differs from the one just before it."""
    print_of = F.to_json("columns")
    rows = history.withColumn("_print", print_of)
    earlier = rows.select("source", "schema", "table", "lsn_pos", "seq",
                          F.col("_print").alias("_prev"))
    # The history grows with the log: take the path that splits long histories.
    marked = asof_join(
        rows, earlier, ["source", "schema", "table"], ["lsn_pos", "seq"], ["_prev"],
        broadcast=False, inclusive=False,
    )
    return marked.filter(~F.col("_print").eqNullSafe(F.col("_prev"))).drop("_print", "_prev")


def latest_schema(history: DataFrame) -> DataFrame:
    """Newest version of every table, reduced before it is shuffled."""
    newest = F.max_by(
        F.struct("position", "timestamp", "columns"), F.struct("lsn_pos", "seq")
    )
    return (
        history.groupBy("source", "schema", "table")
        .agg(newest.alias("_v"))
        .select("source", "schema", "table", "_v.position", "_v.timestamp", "_v.columns")
    )


def table_history(
    history: DataFrame, schema: str, table: str, source: str | None = None
) -> DataFrame:
    """All versions of one table in order; none if the table is unknown."""
    rows = history.filter((F.col("schema") == schema) & (F.col("table") == table))
    if source is not None:
        rows = rows.filter(F.col("source") == source)
    return rows.orderBy("source", "lsn_pos", "seq")


def append_history(history: DataFrame, path: str) -> None:
    history.write.mode("append").json(path)


def load_history(spark: SparkSession, path: str) -> DataFrame:
    """Read stored versions: a missing store is empty, a damaged one an error."""
    try:
        return spark.read.schema(HISTORY_SCHEMA).option("mode", "FAILFAST").json(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], HISTORY_SCHEMA)
        raise
