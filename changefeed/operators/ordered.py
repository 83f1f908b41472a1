"""Order-dependent building blocks that never gather one key in one task.

Log order is serial per source, and one source may hold most of the rows. The
usual window over the source would sort all of them in one task, so the work is
cut along the position axis instead:

* a *segment* is a run of 2**SEGMENT_BITS positions: the only level that sees
  rows, so no window group can grow past one segment;
* a *block* is 2**BLOCK_BITS segments: what each segment inherits is worked out
  from one summary per segment, block by block;
* one last window per key runs over one summary per block.

The result is the exact whole-key answer for any density of positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changefeed.session import settle

SEGMENT_BITS = 20
BLOCK_BITS = 16

# Rows of one segment that are worked on together; a fuller segment is dealt out.
SEGMENT_ROWS = 2_000_000

# A lookup side is broadcast only below both bounds; each has another way beyond.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 * 1024 * 1024

# Versions one row may be compared with in a broadcast interval lookup.
VERSIONS_PER_CELL = 16

LOWEST = -(2**63)


def is_small(df: DataFrame) -> bool:
    """Measure a lookup table: few enough rows and bytes to broadcast?

    The probe stops one row past the bound, so asking costs little even when
    the answer is no.
    """
    width = F.octet_length(F.to_json(F.struct(*df.columns)))
    probe = df.select(width.alias("w")).limit(BROADCAST_ROWS + 1)
    size = probe.agg(F.count("*").alias("n"), F.sum("w").alias("b")).first()
    return size["n"] <= BROADCAST_ROWS and (size["b"] or 0) <= BROADCAST_BYTES


def _content_hash(df: DataFrame) -> Column:
    """The same number for a row however often it is computed."""
    plain = [
        field.name
        for field in df.schema
        if not any(part in field.dataType.simpleString() for part in ("map<", "variant"))
    ]
    return F.xxhash64(*[F.col(f"`{name}`") for name in plain])


def _with_tie(right: DataFrame) -> DataFrame:
    """Rows of one key and order are told apart by the content of their values."""
    plain = [
        F.col("_v")[field.name]
        for field in right.schema["_v"].dataType
        if not any(part in field.dataType.simpleString() for part in ("map<", "variant"))
    ]
    return right.withColumn("_tie", F.xxhash64(*plain) if plain else F.lit(0).cast("bigint"))


def lookup_join(
    df: DataFrame,
    table: DataFrame,
    on: list[str],
    how: str = "inner",
    salts: int = 64,
) -> DataFrame:
    """Join to a usually small table by equality.

    A measured small table is broadcast. A larger one is copied once per salt
    and hash joined, so that rows sharing one hot key spread over many tasks.
    """
    if is_small(table):
        return df.join(F.broadcast(table), on, how)
    # By content, so that a task run again sends its rows where it sent them before.
    salted = df.withColumn("_salt", F.pmod(_content_hash(df), F.lit(salts)).cast("int"))
    copies = table.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    order: list[str],
    values: list[str],
    broadcast: bool = True,
    inclusive: bool = True,
) -> DataFrame:
    """Give each left row the values of the newest right row at or before it.

    ``order`` names columns of both sides, a BIGINT position first, tie-breakers
    after it; ``inclusive=False`` asks for strictly before. Left rows with
    nothing before them get nulls; of right rows that agree in key and order the
    one with the largest content hash counts, on every path. With ``broadcast`` the right side is settled
    and measured first; when it is small and has few versions per key, the left
    side is not shuffled at all.
    """
    right = right.select(*on, *order, F.struct(*values).alias("_v"))
    joined = None
    if broadcast:
        right = settle(right)
        joined = _broadcast_asof(left, right, on, order, inclusive)
    if joined is None:
        joined = _segment_asof(left, right, on, order, inclusive)
    return joined.select(
        *left.columns, *[F.col("_v")[name].alias(name) for name in values]
    )


def _broadcast_asof(left, right, on, order, inclusive) -> DataFrame | None:
    pos = order[0]
    size = F.octet_length(F.to_json("_v"))
    shape = (
        right.groupBy(*on)
        .agg(
            F.count("*").alias("n"),
            F.sum(size).alias("bytes"),
            F.min(pos).alias("first"),
            F.max(pos).alias("last"),
        )
        .agg(
            F.count("*").alias("keys"),
            F.sum("n").alias("rows"),
            F.sum("bytes").alias("bytes"),
            F.max("n").alias("n"),
            F.min("first").alias("first"),
            F.max("last").alias("last"),
        )
        .first()
    )
    if (shape["rows"] or 0) > BROADCAST_ROWS or (shape["bytes"] or 0) > BROADCAST_BYTES:
        return None
    # right is bounded from here on: the windows and counts below run over it only
    cells = 1
    if shape["n"] is not None and shape["n"] > VERSIONS_PER_CELL:
        cells = max(1, min(shape["n"], BROADCAST_ROWS // shape["keys"]))

    by_key = Window.partitionBy(*on).orderBy(*order, "_tie")
    spans = _with_tie(right).select(
        *[F.col(name).alias(f"_k_{name}") for name in on],
        "_v",
        F.col(pos).alias("_at"),
        F.struct(*order).alias("_from"),
        F.lead(F.struct(*order)).over(by_key).alias("_to"),
    )
    here = F.struct(*[left[name] for name in order])
    match = [left[name] == F.col(f"_k_{name}") for name in on]
    if inclusive:
        match += [here >= F.col("_from"), F.col("_to").isNull() | (here < F.col("_to"))]
    else:
        match += [here > F.col("_from"), F.col("_to").isNull() | (here <= F.col("_to"))]

    if cells > 1:
        # Many versions: also key on a coarse cell of the position axis, so a row
        # meets only the versions valid in its own cell.
        width = max(1, (shape["last"] - shape["first"]) // cells + 1)

        def cell(position: Column) -> Column:
            inside = F.least(
                F.greatest(position, F.lit(shape["first"])), F.lit(shape["last"])
            )
            return F.call_function("div", inside - F.lit(shape["first"]), F.lit(width))

        until = F.coalesce(F.col("_to")[pos], F.lit(shape["last"]))
        spans = spans.withColumn(
            "_cell", F.explode(F.sequence(cell(F.col("_at")), cell(until)))
        )
        fullest = (
            spans.groupBy(*[f"_k_{name}" for name in on], "_cell")
            .agg(F.count("*").alias("n"), F.sum(size).alias("bytes"))
            .agg(F.max("n").alias("most"), F.sum("n").alias("rows"), F.sum("bytes").alias("bytes"))
            .first()
        )
        # a version is copied to every cell it spans, so its bytes are measured again
        if (
            fullest["most"] > 4 * VERSIONS_PER_CELL
            or fullest["rows"] > 2 * BROADCAST_ROWS
            or (fullest["bytes"] or 0) > BROADCAST_BYTES
        ):
            return None
        match.append(cell(left[pos]) == F.col("_cell"))

    condition = match[0]
    for part in match[1:]:
        condition = condition & part
    return left.join(F.broadcast(spans), condition, "left")


def _segment_asof(left, right, on, order, inclusive) -> DataFrame:
    pos = order[0]
    segment = F.shiftright(pos, SEGMENT_BITS)
    sizes = settle(
        left.filter(F.col(pos).isNotNull())
        .groupBy(*on, segment.alias("_seg"))
        .agg(F.count("*").alias("_n"))
    )
    right = _with_tie(right).withColumn("_seg", segment)
    # Rows without a position match nothing; spread them over their own groups.
    stray = -(F.pmod(_content_hash(left), F.lit(4096)) + 1)
    left = left.withColumn("_seg", F.coalesce(segment, stray))
    group = [*on, "_seg"]

    last_in_segment = right.groupBy(*group).agg(
        F.max_by("_v", F.struct(*order, "_tie")).alias("_v")
    )
    inherited = _inherit(
        sizes.select(*group), last_in_segment, on, lambda over: F.last("_v", True).over(over),
        combine=lambda near, far: F.coalesce(near, far), value="_v",
    ).withColumnRenamed("_v", "_in")

    full = sizes.filter(F.col("_n") > SEGMENT_ROWS).select(
        *group, F.ceil(F.col("_n") / SEGMENT_ROWS).cast("int").alias("_parts")
    )
    if not full.isEmpty():
        # Many rows at few positions (copies, say): deal the rows of such a segment
        # out to parts, each of which gets all the versions of the segment.
        parts = F.coalesce(F.col("_parts"), F.lit(1))
        dealt = F.pmod(F.monotonically_increasing_id(), parts).cast("int")
        copied = F.explode(F.sequence(F.lit(0), parts - 1))
        # Settled, because a task run again might deal its rows differently.
        left = settle(lookup_join(left, full, group, "left").withColumn("_part", dealt))
        right = lookup_join(right, full, group, "left").withColumn("_part", copied)
        inherited = lookup_join(inherited, full, group, "left").withColumn("_part", copied)
        left, right, inherited = (side.drop("_parts") for side in (left, right, inherited))
        group = [*group, "_part"]

    mixed = left.withColumn("_is_left", F.lit(True)).unionByName(
        right.withColumn("_is_left", F.lit(False)), allowMissingColumns=True
    )
    side = F.col("_is_left") if inclusive else ~F.col("_is_left")
    within = (
        Window.partitionBy(*group)
        .orderBy(*order, side, "_tie")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = (
        mixed.withColumn("_near", F.last("_v", True).over(within))
        .filter("_is_left")
        .drop("_v")
    )
    return local.join(inherited, group, "left").withColumn(
        "_v", F.coalesce("_near", "_in")
    )


def _inherit(wanted, summary, on, running, combine, value) -> DataFrame:
    """What each wanted segment inherits from all earlier segments of its key.

    ``wanted`` has one row per key and segment, ``summary`` one row per key and
    segment that contributes ``value``.
    """
    block = F.shiftright("_seg", BLOCK_BITS)
    asked = wanted.select(*on, "_seg", block.alias("_block"), F.lit(0).alias("_given"))
    given = summary.select(
        *on, "_seg", block.alias("_block"), F.lit(1).alias("_given"), value
    )
    rows = asked.unionByName(given, allowMissingColumns=True)

    in_block = (
        Window.partitionBy(*on, "_block")
        .orderBy("_seg", "_given")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    near = rows.withColumn("_near", running(in_block))
    # The last running value of a block is the block's own summary.
    blocks = near.groupBy(*on, "_block").agg(
        F.max_by("_near", F.struct("_seg", "_given")).alias(value)
    )
    before = (
        Window.partitionBy(*on)
        .orderBy("_block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    far = blocks.select(*on, "_block", running(before).alias("_far"))
    return (
        near.filter("_given = 0")
        .join(far, [*on, "_block"], "left")
        .select(*on, "_seg", combine(F.col("_near"), F.col("_far")).alias(value))
    )


def running_number(df: DataFrame, on: list[str], order: list[str], out: str) -> DataFrame:
    """Number the rows of each key 1, 2, 3 … in order; ``on`` may be empty.

    ``order`` starts with a BIGINT and must be unique within the key.
    """
    df = df.withColumn("_seg", F.shiftright(order[0], SEGMENT_BITS))
    counts = df.groupBy(*on, "_seg").agg(F.count("*").alias("_n"))
    offsets = _inherit(
        counts.select(*on, "_seg"), counts, on, lambda over: F.sum("_n").over(over),
        combine=lambda near, far: F.coalesce(near, F.lit(0)) + F.coalesce(far, F.lit(0)),
        value="_n",
    )
    within = Window.partitionBy(*on, "_seg").orderBy(*order)
    return (
        df.withColumn("_rn", F.row_number().over(within))
        .join(offsets, [*on, "_seg"])
        .withColumn(out, F.col("_rn") + F.col("_n"))
        .drop("_seg", "_rn", "_n")
    )


def number_rows(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """Number all rows 1, 2, 3 … by any columns, equal rows in any order.

    The range partitions are settled once, so counting them and numbering inside
    them see the same cut. The row id in the range key lets even a long run of
    identical rows split over several partitions.
    """
    spread = (
        df.withColumn("_hash", _content_hash(df))
        .withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*order, "_hash", "_tie")
        .sortWithinPartitions(*order, "_hash", "_tie")
        .withColumn("_part", F.spark_partition_id())
        .withColumn(
            "_at",
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
        )
        .drop("_hash", "_tie")
    )
    settled = settle(spread)
    # one row per partition of the shuffle above: bounded by the plan, not the data
    sizes = settled.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    return (
        settled.join(F.broadcast(starts), "_part")
        .withColumn(out, F.col("_start") + F.col("_at") + 1)
        .drop("_part", "_at", "_start")
    )
