"""Sharding by a k-d tree over metadata.

Each node that is to hold several leaves is cut in two at the weighted median of
its widest dimension; all nodes of a level are cut by the same jobs. Rows of a
node are ordered by that dimension, then by a hash of their key, the key and the
text's checksum, and the running weight in that order decides the side. So sizes
come out near equal even where a dimension has few values, and a hot source or
copies split like any other rows.

Running weights come from a range partitioning that is settled once: sums inside
partitions, offsets from one row per partition. No node is ever in one task.

Cases: a null dimension counts as the smallest value; null and empty texts weigh
1; rows that are equal in everything keep apart by a row number; with no rows
there are no shards. A row heavier than a leaf fills its leaf alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changefeed.session import settle


def running_weight(df: DataFrame, within: str, order: list[str], weight: str, out: str) -> DataFrame:
    """Add the weight of all rows of ``within`` up to and including each row, in order.

    ``order`` must tell rows apart, or equal rows may come in any order.
    """
    cut = settle(
        df.repartitionByRange(within, *order)
        .sortWithinPartitions(within, *order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id())
    )
    inside = Window.partitionBy("_part", within).orderBy("_at")
    sums = cut.groupBy(within, "_part").agg(F.sum(weight).alias("_sum"))
    # one row for each partition and node: bounded by the plan
    before = Window.partitionBy(within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(within, "_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    return (
        cut.withColumn(out, F.sum(weight).over(inside))
        .join(F.broadcast(starts), [within, "_part"])
        .withColumn(out, F.col(out) + F.col("_start"))
        .drop("_part", "_at", "_start")
    )


def kd_partition(rows: DataFrame, dims: dict[str, Column], weight: str, ties: list[str], target: int) -> DataFrame:
    """Add ``leaf`` (0, 1, 2 …) so that leaves weigh about ``target`` each.

    ``rows`` must be narrow: they are range partitioned once per level. Dimensions
    are scaled to the range they have over all rows, so that widths compare.
    """
    names = [f"_d{i}" for i in range(len(dims))]
    df = rows.select("*", *[F.coalesce(c.cast("double"), F.lit(float("-inf"))).alias(n) for n, c in zip(names, dims.values())])
    df = settle(df)
    finite = [F.when(F.col(n) > float("-inf"), F.col(n)) for n in names]
    span = df.agg(
        F.sum(weight).alias("total"),
        *[F.min(f).alias(f"lo{n}") for f, n in zip(finite, names)],
        *[F.max(f).alias(f"hi{n}") for f, n in zip(finite, names)],
    ).first()
    leaves = max(1, -(-int(span["total"] or 0) // target))
    scaled = []
    for n in names:
        low, high = span[f"lo{n}"] or 0.0, span[f"hi{n}"] or 0.0
        scaled.append(F.greatest((F.col(n) - low) / ((high - low) or 1.0), F.lit(-1.0)).alias(n))
    rest = [c for c in df.columns if c not in names]
    # a node is its first leaf and how many leaves it is to hold
    df = df.select(*rest, *scaled, F.lit(0).alias("leaf"), F.lit(leaves).alias("_holds"))
    while leaves > 1:
        widths = [(F.max(n) - F.min(n)).alias(n) for n in names]
        nodes = df.groupBy("leaf").agg(F.sum(weight).alias("_total"), *widths)
        widest = F.greatest(*[F.col(n) for n in names])
        axis = F.coalesce(*[F.when(F.col(n) == widest, F.lit(i)) for i, n in enumerate(names)])
        # one row for each node: bounded by the number of leaves
        df = df.join(F.broadcast(nodes.select("leaf", "_total", axis.alias("_axis"))), "leaf")
        df = df.withColumn("_value", F.coalesce(*[F.when(F.col("_axis") == i, F.col(n)) for i, n in enumerate(names)]))
        df = running_weight(df, "leaf", ["_value", *ties], weight, "_upto")
        low = F.floor(F.col("_holds") / 2)
        # the row that crosses the median goes to the side that holds more of it
        left = (F.col("_upto") - F.col(weight) / 2) * F.col("_holds") <= F.col("_total") * low
        cut = F.col("_holds") > 1
        df = df.withColumn("_low", low).withColumn("_left", left)
        df = df.select(
            *rest, *names,
            F.when(~cut | F.col("_left"), F.col("leaf")).otherwise(F.col("leaf") + F.col("_low")).cast("int").alias("leaf"),
            F.when(~cut, F.col("_holds")).when(F.col("_left"), F.col("_low")).otherwise(F.col("_holds") - F.col("_low")).cast("int").alias("_holds"),
        )
        leaves = -(-leaves // 2)
    return df.select(*rest, "leaf")


def spread(name: Column) -> Column:
    """A number for a name: the first 32 bits of its MD5."""
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("bigint")


def shard_documents(docs: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, shard, slot): documents in shards of near equal bytes.

    ``size`` is the UTF-8 bytes of the text plus 1; the target is the total over
    ``shards``. Dimensions: length, language and source of a document, the latter
    two as numbers made of their names. ``slot`` numbers the rows of a shard from 0.
    """
    columns = set(docs.columns)
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1
    rows = docs.select(
        F.col(key).alias("key"), size.alias("size"), F.crc32(F.coalesce(F.col(text), F.lit(""))).alias("crc"),
        *[(F.col(c).cast("string") if c in columns else F.lit(None).cast("string")).alias(f"_{c}") for c in ("lang", "source")],
    )
    rows = settle(rows.withColumn("_tie", spread(F.col("key").cast("string"))))
    total = rows.agg(F.sum("size")).first()[0] or 1
    dims = {"length": F.col("size"), "lang": spread(F.col("_lang")), "source": spread(F.col("_source"))}
    placed = kd_partition(rows, dims, "size", ["_tie", "key", "crc"], -(-total // shards))
    numbered = running_weight(placed.withColumn("_one", F.lit(1)), "leaf", ["_tie", "key", "crc"], "_one", "_n")
    return numbered.select(
        F.col("key").alias(key), "size", F.col("crc").alias("text_crc32"), F.col("leaf").alias("shard"),
        (F.col("_n") - 1).alias("slot"),
    )
