"""Log positions: text forms, parsing and the numeric order behind them.

Text order is wrong for both kinds of position, so every feed also carries
``pos_hi`` and ``pos_lo``: the two halves of an LSN, or the binlog file number
and the offset in that file.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOW_32 = 0xFFFFFFFF

# Fixed value: 2000-01-01T00:00:00Z in epoch milliseconds.
PG_EPOCH_MS = 946684800000


def format_lsn(lsn: Column) -> Column:
    """64-bit LSN to upper-case ``hi/lo`` hex."""
    return F.concat(F.hex(lsn_high(lsn)), F.lit("/"), F.hex(lsn_low(lsn)))


def parse_lsn(text: Column) -> Column:
    """``hi/lo`` hex to a 64-bit LSN; null when the text is not a position."""
    shape = r"^([0-9A-Fa-f]{1,8})/([0-9A-Fa-f]{1,8})$"
    high = F.conv(F.regexp_extract(text, shape, 1), 16, 10).try_cast("bigint")
    low = F.conv(F.regexp_extract(text, shape, 2), 16, 10).try_cast("bigint")
    return F.when(text.rlike(shape), F.shiftleft(high, 32).bitwiseOR(low))


def lsn_high(lsn: Column) -> Column:
    return F.shiftrightunsigned(lsn, 32)


def lsn_low(lsn: Column) -> Column:
    return lsn.bitwiseAND(F.lit(LOW_32))


def combined_position(pos_hi: Column, pos_lo: Column) -> Column:
    """Both ordering halves as one BIGINT."""
    return F.shiftleft(pos_hi.cast("bigint"), 32).bitwiseOR(pos_lo.cast("bigint"))


def format_binlog_pos(file: Column, position: Column) -> Column:
    """``file:pos``, or the empty text while the file is unknown."""
    known = file.isNotNull() & (file != "") & position.isNotNull()
    return F.when(known, F.concat_ws(":", file, position.cast("string"))).otherwise("")


def parse_binlog_pos(text: Column) -> Column:
    """``file:pos`` to ``struct<file, position, error>``.

    The last colon splits. Empty text is no position and no error.
    """
    shape = r"(?s)^(.*):([0-9]+)$"
    number = F.regexp_extract(text, shape, 2).try_cast("decimal(38,0)")
    in_range = F.coalesce(number <= F.lit(LOW_32), F.lit(False))
    good = text.rlike(shape) & in_range
    error = (
        F.when(text.isNull() | (text == "") | good, F.lit(None))
        .when(~text.contains(":"), F.concat(F.lit("no colon in position: "), text))
        .otherwise(F.concat(F.lit("bad position number: "), text))
    )
    return F.struct(
        F.when(good, F.regexp_extract(text, shape, 1)).alias("file"),
        F.when(good, number.cast("bigint")).alias("position"),
        error.cast("string").alias("error"),
    )


def binlog_file_number(file: Column) -> Column:
    """Numeric suffix of a binlog file name, the high half of its order."""
    return F.regexp_extract(file, r"([0-9]+)$", 1).try_cast("bigint")


def pg_micros_to_epoch_ms(micros: Column) -> Column:
    """Microseconds since 2000-01-01 to epoch milliseconds."""
    return F.lit(PG_EPOCH_MS) + F.call_function("div", micros, F.lit(1000))


def message_end_lsn(wal_start: Column, payload: Column) -> Column:
    """Position after a captured message: where it starts plus its length."""
    return wal_start + F.octet_length(payload)
