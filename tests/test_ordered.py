"""Order-dependent building blocks against brute force on skewed fixtures."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from changefeed.operators import ordered
from changefeed.operators.ordered import asof_join, is_small, lookup_join, number_rows, running_number


def skewed(seed, n, top):
    """One key holds most rows; positions are dense in places and sparse in others."""
    rnd = random.Random(seed)
    rows = set()
    while len(rows) < n:
        key = "hot" if rnd.random() < 0.6 else rnd.choice("abc")
        pos = rnd.choice([rnd.randrange(40), rnd.randrange(top), rnd.randrange(-50, 5000)])
        rows.add((key, pos, rnd.randrange(3)))
    return sorted(rows)


def brute(left, right, inclusive):
    out = []
    for key, pos, seq in left:
        earlier = [(p, s, v) for k, p, s, v in right if k == key and
                   ((p, s) <= (pos, seq) if inclusive else (p, s) < (pos, seq))]
        out.append((key, pos, seq, max(earlier)[2] if earlier else None))
    return sorted(out, key=str)


@pytest.fixture
def small_segments(monkeypatch):
    monkeypatch.setattr(ordered, "SEGMENT_BITS", 3)
    monkeypatch.setattr(ordered, "BLOCK_BITS", 4)


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("broadcast", [True, False])
def test_asof_join(spark, small_segments, inclusive, broadcast):
    left = skewed(1, 400, 1 << 40)
    right = [(*row, f"v{i}") for i, row in enumerate(skewed(2, 150, 1 << 40))]
    got = asof_join(
        spark.createDataFrame(left, "k string, pos bigint, seq int"),
        spark.createDataFrame(right, "k string, pos bigint, seq int, v string"),
        ["k"], ["pos", "seq"], ["v"], broadcast=broadcast, inclusive=inclusive,
    )
    rows = sorted((tuple(r) for r in got.collect()), key=str)
    assert rows == brute(left, right, inclusive)


@pytest.mark.parametrize("inclusive", [True, False])
def test_asof_join_deals_out_full_segments(spark, small_segments, monkeypatch, inclusive):
    monkeypatch.setattr(ordered, "SEGMENT_ROWS", 20)
    left = skewed(4, 300, 1 << 40) + [("hot", 17, 1)] * 300
    right = [(*row, f"v{i}") for i, row in enumerate(skewed(5, 200, 1 << 40))]
    got = asof_join(
        spark.createDataFrame(left, "k string, pos bigint, seq int").repartition(7),
        spark.createDataFrame(right, "k string, pos bigint, seq int, v string"),
        ["k"], ["pos", "seq"], ["v"], broadcast=False, inclusive=inclusive,
    )
    rows = sorted((tuple(r) for r in got.collect()), key=str)
    assert rows == brute(left, right, inclusive)


def test_asof_join_keeps_rows_without_position(spark, small_segments):
    left = spark.createDataFrame([("a", None, 0), ("a", 5, 0)] * 3, "k string, pos bigint, seq int")
    right = spark.createDataFrame([("a", 1, 0, "x")], "k string, pos bigint, seq int, v string")
    for broadcast in (True, False):
        got = asof_join(left, right, ["k"], ["pos", "seq"], ["v"], broadcast=broadcast)
        assert sorted(str(r.v) for r in got.collect()) == ["None"] * 3 + ["x"] * 3


def test_asof_join_turns_to_segments_when_versions_cluster(spark):
    # 500 versions in one cell and a far outlier: the lookup must not be broadcast
    right = [("a", i, 0, i) for i in range(500)] + [("a", 1 << 50, 0, -1)]
    left = [("a", i * 3 + 1, 0) for i in range(300)]
    left_df = spark.createDataFrame(left, "k string, pos bigint, seq int")
    right_df = spark.createDataFrame(right, "k string, pos bigint, seq int, v int")
    packed = right_df.select("k", "pos", "seq", F.struct("v").alias("_v"))
    assert ordered._broadcast_asof(left_df, packed, ["k"], ["pos", "seq"], True) is None
    even = packed.filter("pos < 500")
    assert ordered._broadcast_asof(left_df, even, ["k"], ["pos", "seq"], True) is not None
    got = asof_join(left_df, right_df, ["k"], ["pos", "seq"], ["v"])
    assert {r.pos: r.v for r in got.collect()} == {p: min(p, 499) for _, p, _ in left}


def test_running_number(spark, small_segments):
    rows = skewed(3, 500, 1 << 40)
    got = running_number(
        spark.createDataFrame(rows, "k string, pos bigint, seq int"), ["k"], ["pos", "seq"], "n"
    )
    seen, want = {}, set()
    for row in rows:
        seen[row[0]] = seen.get(row[0], 0) + 1
        want.add((*row, seen[row[0]]))
    assert {tuple(r) for r in got.collect()} == want


def test_number_rows_with_many_equal_rows(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("x"))
    got = number_rows(df.repartition(6), ["x"], "n").collect()
    assert sorted(r.n for r in got) == list(range(1, 3001))
    assert [r.x for r in sorted(got, key=lambda r: r.n)] == sorted(r.x for r in got)


def test_lookup_join_beyond_the_bound(spark, monkeypatch):
    left = spark.range(1000).select(F.when(F.col("id") < 700, 1).otherwise(F.col("id")).alias("k"), "id")
    right = spark.range(900).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    small = sorted(lookup_join(left, right, ["k"]).collect())
    monkeypatch.setattr(ordered, "BROADCAST_ROWS", 100)
    assert not is_small(right)
    large = lookup_join(left, right, ["k"])
    assert sorted(large.collect()) == small
    assert len(lookup_join(left, right, ["k"], "left").collect()) == 1000


def _ties(spark):
    left = spark.sql("select 1 k, id pos, id from range(0, 400)")
    right = spark.sql("select 1 k, id * 40 pos, v from range(0, 10) lateral view explode(array('a', 'b', 'c')) t as v")
    return left, right


def test_equal_positions_give_one_answer(spark, monkeypatch):
    left, right = _ties(spark)

    def answer(broadcast):
        found = asof_join(left, right, ["k"], ["pos"], ["v"], broadcast=broadcast)
        return sorted((r.id, r.v) for r in found.collect())

    small, cut = answer(True), answer(False)
    monkeypatch.setattr(ordered, "SEGMENT_ROWS", 50)
    assert len(small) == 400 and small == cut == answer(False)


def test_wide_versions_are_measured_per_cell(spark, monkeypatch):
    left = spark.sql("select id % 2 k, id pos, id from range(0, 2000)")
    right = spark.sql(
        "select 0L k, id pos, 'x' v from range(0, 2000, 2) union all "
        "select 1L, id * 500 + 1, repeat('y', 5000) from range(0, 4)"
    )
    monkeypatch.setattr(ordered, "BROADCAST_BYTES", 200_000)
    assert ordered._broadcast_asof(
        left, right.selectExpr("k", "pos", "struct(v) _v"), ["k"], ["pos"], True
    ) is None
    found = asof_join(left, right, ["k"], ["pos"], ["v"])
    assert found.filter("v is not null").count() == 2000
