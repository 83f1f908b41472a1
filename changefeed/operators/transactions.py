"""Transaction framing of a feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefeed.functions.positions import combined_position
from changefeed.operators.log_scan import carry_along
from changefeed.operators.ordered import LOWEST, asof_join, lookup_join, running_number


def assign_transactions(
    df: DataFrame, boundary: str = "BEGIN", initial: DataFrame | None = None
) -> DataFrame:
    """Add ``tx_no`` per source and the transaction's ``tx_timestamp``.

    Every BEGIN starts the next number, and the rows after it carry its
    ``sourceTimestamp``. A feed without BEGIN markers uses ``boundary="COMMIT"``:
    the rows after a commit, up to and with the next one, are one transaction.
    Rows before the first boundary have number 0.

    ``initial`` (``source, tx_no, tx_timestamp``) carries the last number over
    from an earlier batch. A feed that lies in log order is framed where it lies, by
    two scans; any other one is shuffled by position.
    """
    at = combined_position(F.col("pos_hi"), F.col("pos_lo"))
    scanned = carry_along(
        df, [at, F.col("seq"), F.col("idx")], ["source"], F.col("type") == boundary,
        F.nullif(F.col("sourceTimestamp"), F.lit(0)), inclusive=boundary == "BEGIN",
    )
    if scanned is not None:
        return _numbered(scanned, initial).select(*df.columns, "tx_no", "tx_timestamp")
    order = ["_pos", "seq", "idx"]
    rows = df.withColumn("_pos", at)
    marks = rows.filter((F.col("type") == boundary) & F.col("_pos").isNotNull())
    marks = marks.select(
        "source", *order, F.nullif("sourceTimestamp", F.lit(0)).alias("tx_timestamp")
    )
    starts = running_number(marks, ["source"], order, "tx_no")
    if initial is not None:
        begun = initial.select(
            "source", F.col("tx_no").alias("_base"), F.col("tx_timestamp").alias("_ts")
        )
        starts = (
            starts.join(begun, "source", "left")
            .withColumn("tx_no", F.col("tx_no") + F.coalesce("_base", F.lit(0)))
            .drop("_base", "_ts")
            .unionByName(
                begun.select(
                    "source",
                    F.lit(LOWEST).alias("_pos"),
                    F.lit(-1).cast("bigint").alias("seq"),
                    F.lit(-1).alias("idx"),
                    F.col("_ts").alias("tx_timestamp"),
                    F.col("_base").alias("tx_no"),
                )
            )
        )
    # Boundaries grow with the data: never broadcast them.
    framed = asof_join(
        rows, starts, ["source"], order, ["tx_no", "tx_timestamp"],
        broadcast=False, inclusive=boundary == "BEGIN",
    )
    return framed.withColumn("tx_no", F.coalesce("tx_no", F.lit(0))).drop("_pos")


def _numbered(scanned: DataFrame, initial: DataFrame | None) -> DataFrame:
    if initial is None:
        return scanned.withColumnsRenamed({"_count": "tx_no", "_value": "tx_timestamp"})
    # one row for each source
    begun = initial.select("source", F.col("tx_no").alias("_base"), F.col("tx_timestamp").alias("_ts"))
    placed = F.col("pos_hi").isNotNull() & F.col("pos_lo").isNotNull()
    rows = lookup_join(scanned, begun, ["source"], "left")
    return rows.withColumns({
        "tx_no": F.col("_count") + F.when(placed, F.coalesce("_base", F.lit(0))).otherwise(0),
        "tx_timestamp": F.when(F.col("_count") > 0, F.col("_value")).otherwise(F.when(placed, F.col("_ts"))),
    })


def with_source_timestamp(framed: DataFrame) -> DataFrame:
    """Copy the transaction's time to rows that have no time of their own."""
    known = F.nullif(F.col("sourceTimestamp"), F.lit(0))
    return framed.withColumn(
        "sourceTimestamp", F.coalesce(known, F.col("tx_timestamp"), F.lit(0))
    )
