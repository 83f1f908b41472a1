"""Delivery to file sinks and from streaming queries.

Everything a batch writes goes into a folder named by its batch id and replaces
what an earlier try of the same batch left there, so a batch that runs again
delivers nothing twice. A batch is committed by its manifest in ``_commits``, written
last, after messages, rejects and positions: readers see committed batches only. The
manifest's counts and positions are read from the messages that were written.

State that later batches need is kept as one small table per batch, and in full once in
``STATE_EVERY`` batches, so that loading it reads a bounded number of folders.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException
from pyspark.sql.streaming import StreamingQuery

from changefeed.functions.subjects import DEFAULT_PREFIX
from changefeed.operators.delivery import acked_positions
from changefeed.operators.envelope import to_messages
from changefeed.operators.filters import publishable
from changefeed.operators.ordered import is_small
from changefeed.operators.validation import accepted, rejected
from changefeed.session import folder_names, settle
from changefeed.sources.wal import REJECT_COLUMNS

STATE_EVERY = 20

MESSAGE_SCHEMA = (
    "key string, value string, headers array<struct<key: string, value: binary>>, batch_id string, subject string"
)
ACKED_SCHEMA = "source string, lsn string, pos_hi bigint, pos_lo bigint"


def require_target(spark: SparkSession, target: str) -> None:
    """Fail unless the sink exists; it is provisioned by its owner, never here."""
    try:
        spark.read.schema("value string").text(target)
    except AnalysisException as error:
        raise RuntimeError(
            f"target {target!r} does not exist: provision it before publishing"
        ) from error


def _write_messages(messages: DataFrame, path: str, mode: str) -> None:
    # Rebalancing splits a hot subject over many files and gathers rare ones.
    (
        messages.withColumn("subject", F.col("key"))
        .hint("rebalance", "subject")
        .write.mode(mode)
        .partitionBy("subject")
        .parquet(path)
    )


def _deliver(events: DataFrame, target: str, batch: str, prefix: Column | str) -> DataFrame:
    """Write the messages of a batch; returns one row per source of what was written."""
    path = f"{target}/batch_id={batch}"
    _write_messages(to_messages(events, prefix, ["source", "lsn", "pos_hi", "pos_lo"]), path, "overwrite")
    written = events.sparkSession.read.schema(ACKED_SCHEMA).parquet(path)
    counted = written.groupBy("source").agg(F.count("*").alias("messages"))
    return counted.join(acked_positions(written).withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")


def _commit(manifest: DataFrame, target: str, batch: str) -> None:
    manifest.write.mode("overwrite").parquet(f"{target}/_commits/batch_id={batch}")


def publish(
    df: DataFrame,
    target: str,
    prefix: Column | str = DEFAULT_PREFIX,
    require_existing: bool = False,
    batch: str | None = None,
) -> DataFrame:
    """Write the accepted, publishable events and commit them; returns the positions delivered.

    A call with the name of an earlier ``batch`` replaces that one; without a name it
    is a batch of its own.
    """
    spark = df.sparkSession
    if require_existing:
        require_target(spark, target)
    batch = batch or f"u{uuid.uuid4().hex}"
    _commit(settle(_deliver(publishable(accepted(df)), target, batch, prefix)), target, batch)
    stored = spark.read.schema(ACKED_SCHEMA).parquet(f"{target}/_commits/batch_id={batch}")
    return stored.filter(F.col("lsn").isNotNull())


def committed_batches(spark: SparkSession, target: str) -> DataFrame:
    """(batch_id, source, messages, lsn, pos_hi, pos_lo): what each committed batch holds."""
    columns = f"batch_id string, messages bigint, {ACKED_SCHEMA}"
    if not folder_names(spark, f"{target}/_commits"):
        return spark.createDataFrame([], columns)
    return spark.read.schema(columns).parquet(f"{target}/_commits")


def read_published(spark: SparkSession, target: str) -> DataFrame:
    """Committed messages with their ``subject``; subject filters prune folders."""
    done = committed_batches(spark, target).select("batch_id").distinct()
    done = F.broadcast(done) if is_small(done) else done
    return spark.read.schema(MESSAGE_SCHEMA).parquet(target).join(done, "batch_id", "left_semi")


def store_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write a small per-batch table, replacing an earlier try of the batch."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def store_state(
    df: DataFrame, path: str, batch_id: int, schema: str, newest: Callable[[DataFrame], DataFrame]
) -> None:
    """Store what a batch adds to a state, and from time to time the state in full.

    ``newest`` reduces rows of many batches to those that later ones still need.
    """
    store_batch(df, path, batch_id)
    if batch_id % STATE_EVERY == STATE_EVERY - 1:
        whole = newest(load_state(df.sparkSession, path, schema, batch_id + 1))
        whole.drop("batch_id").write.mode("overwrite").parquet(f"{path}/_full/batch_id={batch_id}")


def _batch_ids(spark: SparkSession, path: str, before: int | None) -> list[int]:
    names = folder_names(spark, path)
    ids = (int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id="))
    return sorted(i for i in ids if before is None or i < before)


def load_state(spark: SparkSession, path: str, schema: str, before: int | None = None) -> DataFrame:
    """Rows of the newest full state and of the batches after it (only those before a given one)."""
    full = _batch_ids(spark, f"{path}/_full", before)
    start = full[-1] if full else -1
    later = [f"{path}/batch_id={i}" for i in _batch_ids(spark, path, before) if i > start]
    rows = spark.createDataFrame([], f"{schema}, batch_id bigint")
    if later:
        rows = spark.read.schema(f"{schema}, batch_id bigint").option("basePath", path).parquet(*later)
    if full:
        whole = spark.read.schema(schema).parquet(f"{path}/_full/batch_id={start}")
        rows = rows.unionByName(whole.withColumn("batch_id", F.lit(start).cast("bigint")))
    return rows


def load_acked(spark: SparkSession, path: str) -> DataFrame:
    """Furthest stored position per source, for ``resume_from``."""
    return acked_positions(load_state(spark, path, ACKED_SCHEMA))


def with_rejects(prepared) -> tuple[DataFrame, DataFrame | None]:
    """What a ``prepare`` returned, as events and rejected messages."""
    if isinstance(prepared, tuple):
        return prepared
    if "reject_reason" not in prepared.columns:
        return prepared, None
    good = F.col("reject_reason").isNull()
    return (
        prepared.filter(good).drop("rel_id", "payload", "reject_reason"),
        prepared.filter(~good).select(*[c for c in REJECT_COLUMNS if c in prepared.columns]),
    )


def publish_stream(
    df: DataFrame,
    target: str,
    checkpoint: str,
    prefix: str = DEFAULT_PREFIX,
    prepare: Callable[[DataFrame, int], DataFrame | tuple[DataFrame, DataFrame]] | None = None,
    acked: str | None = None,
    quarantine: str | None = None,
    on_batch: Callable[[DataFrame, int], None] | None = None,
    require_existing: bool = False,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Run a stream of events (or of captured messages, with ``prepare``) out.

    ``prepare`` turns a micro-batch into events, or into events and rejected messages,
    which go to the quarantine with the rejected events. ``acked`` and ``quarantine`` are
    folders for positions and rejected events. ``on_batch`` is called with the
    delivered events after everything is stored; it may be called again for the
    same batch. A failure anywhere fails the batch, which then runs again.
    """
    spark = df.sparkSession
    if require_existing:
        require_target(spark, target)

    def deliver(batch: DataFrame, batch_id: int) -> None:
        prepared = prepare(batch, batch_id) if prepare else batch
        # both sides of one table are decoded once
        held = (prepared[0] if isinstance(prepared, tuple) else prepared).persist()
        events, rejects = with_rejects(prepared)
        try:
            good = publishable(accepted(events))
            manifest = settle(_deliver(good, target, str(batch_id), prefix))
            if quarantine is not None:
                bad = rejected(events)
                if rejects is not None:
                    bad = bad.unionByName(rejects, allowMissingColumns=True)
                store_batch(bad, quarantine, batch_id)
            if acked is not None:
                store_state(manifest.filter("lsn is not null").select("source", "lsn", "pos_hi", "pos_lo"),
                            acked, batch_id, ACKED_SCHEMA, acked_positions)
            _commit(manifest, target, str(batch_id))
            if on_batch is not None:
                on_batch(good, batch_id)
        finally:
            held.unpersist()

    return (
        df.writeStream.foreachBatch(deliver)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
