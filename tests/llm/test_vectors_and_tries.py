"""Nearest neighbours, centroid clustering and prefix tries against brute force and odd inputs."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from changefeed.llm import cross_polytope, prefix_trie, va_clusters
from changefeed.llm.common import table

VECTORS = "vec_id bigint, embedding array<float>, label int, v string, point string, distance double, cells int, cluster int"
TURNS = "conv_id bigint, turn bigint, role string, text string, depth int, size string, h1 int"


def _brute_nearest(rows, asks, most):
    """Exact lists: {(query id, vector): [(distance, id)]} with the library's rules for odd rows."""
    usable = set()
    for vec_id, v in rows:
        if vec_id is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        usable.add((vec_id, tuple(float(np.float32(x)) for x in v)))
    out = {}
    for q, v in usable:
        if asks(q):
            near = sorted(
                (math.dist(v, w), p) for p, w in usable if p != q and len(w) == len(v)
            )[:most]
            out.setdefault(q, []).append(near)
    return out


@pytest.mark.parametrize("sf, axes, asked", [("sf0.001", 1, 24), ("sf0.01", 1, 24), ("sf0.1", 1, 24), ("sf0.01", 2, 4000)])
def test_nearest_recall(spark, sf, axes, asked):
    vectors = table(spark, f"/root/testdata/{sf}", "embeddings")
    rows = vectors.select("vec_id", "embedding").collect()
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], np.float64)
    found: dict[int, dict[int, tuple]] = {}
    for q, rank, vec_id, score in cross_polytope.nearest_neighbours(vectors, axes=axes, asked=asked).collect():
        found.setdefault(q, {})[rank] = (vec_id, score)
    assert sorted(found) == sorted(ids[ids % 100 == 0].tolist())
    hits = 0
    for q, ranked in found.items():
        distance = np.sqrt(((x - x[ids == q]) ** 2).sum(1))
        distance[ids == q] = np.inf
        best = ids[np.lexsort((ids, distance))[:10]]
        assert sorted(ranked) == list(range(1, 11))
        hits += len(set(best.tolist()) & {v for v, _ in ranked.values()})
        for vec_id, score in ranked.values():
            assert abs(score - distance[ids == vec_id][0]) < 1e-12
        assert list(ranked[k] for k in sorted(ranked)) == sorted(ranked.values(), key=lambda r: (r[1], r[0]))
    assert hits >= 0.9 * 10 * len(found)


def test_nearest_odd_rows(spark):
    """Copies beyond a list's length, ties, other lengths, null, zero, infinite and huge vectors, clashing columns."""
    draw = random.Random(5)
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(0, 1200, 40)]  # copies, some of them queries
    rows += [(i, [draw.gauss(0, 1) for _ in range(4)]) for i in range(1, 60)]
    rows += [(700, [0.5, 0.5]), (701, [0.5, -0.5]), (703, [1.5, 0.5]), (704, [0.5, 1.5])]  # ties at distance 1, few rows
    rows += [(None, [1.0, 2.0, 3.0, 4.0]), (900, None), (1000, []), (1100, [0.0] * 4), (1300, [math.inf, 1.0, 1.0, 1.0]),
             (1400, [math.nan, 1.0, 1.0, 1.0]), (1500, [None, 1.0, 1.0, 1.0]), (1600, [1.0, 2.0, 3.0, 4.5]), (1600, [1.0, 2.0, 3.0, 4.5]),
             (1700, [1e30, -1e30, 1e30, 1e30]), (1800, [7.0])]
    vectors = spark.createDataFrame([(i, v, 0, "x", "y", 0.0, 0, 0) for i, v in rows], VECTORS)
    got: dict[int, list] = {}
    for r in cross_polytope.nearest_neighbours(vectors, asked=8).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    want = _brute_nearest(rows, lambda q: q % 100 == 0, 10)
    want = {q: lists[0] for q, lists in want.items() if lists[0]}
    assert sorted(got) == sorted(want)  # the only vector of its length finds nothing
    for q, near in want.items():
        mine = sorted(got[q])
        assert [r for r, _, _ in mine] == list(range(1, len(near) + 1))
        if near[-1][0] == 0 or len(near) < 10:  # copies and small spaces are found whole
            assert [i for _, _, i in mine] == [i for _, i in near]
            assert [d for _, d, _ in mine] == pytest.approx([d for d, _ in near])
    # every bucket probed: exact
    exact = cross_polytope.nearest_neighbours(vectors, tables=1, asked=cross_polytope.EVERY_CODE).collect()
    lists: dict[int, list] = {}
    for r in exact:
        lists.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    for q, near in want.items():
        assert [i for _, _, i in sorted(lists[q])] == [i for _, i in near]
        assert [s for _, s, _ in sorted(lists[q])] == pytest.approx([d for d, _ in near])


def test_nearest_splits_full_buckets(spark, monkeypatch):
    """Blocks much smaller than buckets give the same lists."""
    vectors = table(spark, "/root/testdata/sf0.01", "embeddings")
    whole = sorted(map(tuple, cross_polytope.nearest_neighbours(vectors).collect()))
    monkeypatch.setattr(cross_polytope, "BLOCK", 2)
    assert sorted(map(tuple, cross_polytope.nearest_neighbours(vectors).collect())) == whole


def test_nearest_empty(spark):
    assert cross_polytope.nearest_neighbours(spark.createDataFrame([], VECTORS)).count() == 0


def _brute_clusters(rows, k, rounds, width):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    middles = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(middles))

    for _ in range(rounds):
        groups: dict[int, list] = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for c, members in groups.items():
            middles[c] = [sum(column) // len(members) for column in zip(*members)]
    return [(i, *nearest(v)[::-1]) for i, v in kept], middles


@pytest.mark.parametrize("bits", [1, 4, 7])
def test_clusters_brute(spark, bits):
    """Null ids, ties, copies, other lengths and empty clusters; any number of bits gives the same result."""
    draw = random.Random(bits)
    rows = [(i, [draw.choice([-1.5, -0.25, 0.0, 0.1, 2.0]) for _ in range(4)]) for i in range(80)]
    rows += [(None, [0.5] * 4), (None, None), (90, [1.0]), (91, [math.nan] * 4), (92, [None] * 4), (93, [math.inf] * 4)]
    rows += [(95, [3.0] * 4)] * 9 + [(96, [1000.0, -1000.0, 0.0, 0.0])]
    vectors = spark.createDataFrame([(i, v, 0, "x", "y", 0.0, 0, 0) for i, v in rows], VECTORS)
    assigned, middles = va_clusters.cluster(vectors, centroids=12, rounds=3, dimensions=4, bits=bits)
    got = va_clusters.with_inertia(assigned, middles).collect()
    want, wanted_middles = _brute_clusters(rows, 12, 3, 4)
    assert middles.tolist() == wanted_middles
    assert sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in got), key=str) == sorted(want, key=str)
    total = sum(d for _, _, d in want)
    for r in got:
        assert r["inertia"] == total
        assert r["cluster_inertia"] == sum(d for _, c, d in want if c == r["cluster"])
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, wanted_middles[r["cluster"]])).encode()).hexdigest()


def test_clusters_small_and_wrong(spark):
    def of(rows):
        return va_clusters.with_inertia(*va_clusters.cluster(
            spark.createDataFrame([(i, v, 0, "x", "y", 0.0, 0, 0) for i, v in rows], VECTORS), dimensions=2))

    assert of([]).count() == 0
    assert of([(1, [0.5]), (2, None)]).count() == 0
    assert [(r["vec_id"], r["distance"]) for r in of([(1, [0.5, 0.5])]).collect()] == [(1, 0)]
    with pytest.raises(Exception, match="beyond"):
        of([(1, [1e9, 0.0])]).collect()


def test_intervals_hold(spark):
    """Every distance lies in its interval, and cells spare distances."""
    draw = np.random.default_rng(2)
    x = draw.integers(-120, 120, (500, 16))
    cuts = np.array([np.clip(np.linspace(-100, 100, 33), x[:, j].min(), x[:, j].max() + 1).astype(int) for j in range(16)])
    cuts[:, 0], cuts[:, -1] = x.min(0), x.max(0) + 1
    cells = np.stack([np.searchsorted(cuts[j, 1:-1], x[:, j], "right") for j in range(16)], 1).astype(np.uint8)
    middles = draw.integers(-120, 120, (9, 16))
    tables = va_clusters.Intervals(middles, cuts)
    distance = ((x[:, None] - middles[None]) ** 2).sum(2)
    ends = sum(t[cells[:, j]] for j, t in enumerate(tables.tables))
    assert (ends[:, :9] <= distance).all() and (distance <= ends[:, 9:]).all()
    found, fetched = tables.nearest(cells, lambda rows: x[rows])
    assert (found == distance.argmin(1)).all() and 0 < fetched < 500


def _brute_trie(rows, rebuilt=True):
    by: dict[int, list] = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    said = {c: [t[2:] for t in sorted(turns)] for c, turns in by.items()}
    whole = {}
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = said.get(c - c % 100, [])[:h] + own[h:] if rebuilt else own
    nodes: dict[tuple, list] = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        ends = sorted(c for c in members if len(whole[c]) == len(path))
        children = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below)]
        out.append((
            min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), len(children), len(leaves),
            sum((len(nodes[p]) - 1) * len(p[-1][1]) for p in below if p),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def _trie(spark, rows, **options):
    df = spark.createDataFrame([(*r, 0, "x", 1) for r in rows], TURNS)
    return sorted((tuple(r) for r in prefix_trie.prefix_trie(df, **options).drop("size").collect()), key=str)


@pytest.mark.parametrize("segment_bits, piece_ids", [(16, 8192), (1, 3)])
def test_trie_brute(spark, monkeypatch, segment_bits, piece_ids):
    """Shared starts, copies, prefixes of others, turnless and long conversations; small segments and pieces."""
    monkeypatch.setattr(prefix_trie, "SEGMENT_BITS", segment_bits)
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", piece_ids)
    draw = random.Random(3)
    rows = []
    for c in range(0, 260):
        for t in range(draw.randint(1, 7)):
            rows.append((c, t, draw.choice(["user", "bot", None]), draw.choice(["a", "bb", "", "日本", None])))
    rows += [(300 + c, t, "user", "same") for c in range(40) for t in range(3)]  # copies
    rows += [(199, 50 + t, "user", f"line {t % 2}") for t in range(40)]  # a long one
    rows += [(None, 0, "user", "nobody"), (401, None, "user", "first"), (401, 1, None, None), (7_000, 0, "u", "x")]
    draw.shuffle(rows)
    assert len({(c, t) for c, t, _, _ in rows}) == len(rows)
    for rebuilt in (True, False):
        assert _trie(spark, rows, rebuilt=rebuilt) == _brute_trie(rows, rebuilt)


def test_trie_ties_and_empty(spark):
    assert _trie(spark, []) == []
    assert _trie(spark, [(None, 1, "a", "b")]) == []
    # equal rows of one turn number are turns of their own, in any order the same result
    rows = [(1, 0, "u", "x"), (1, 0, "u", "x"), (1, 0, "u", "y"), (2, 0, "u", "y"), (2, 0, "u", "x"), (2, 0, "u", "x")]
    once = _trie(spark, rows, rebuilt=False)
    assert once == _trie(spark, rows[::-1], rebuilt=False)
    assert [(r[0], r[1], r[3]) for r in once] == [(1, d, 2) for d in range(4)]
    long = [(5, t, "u", "w" * (200_000 if t == 1 else 3)) for t in range(3)]
    assert _trie(spark, long, rebuilt=False) == _brute_trie(long, False)


def test_trie_no_turns_left(spark):
    """A conversation whose family is absent may lose all its turns and is a member of the root alone."""
    lost = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 2)
    rows = [(lost, 0, "u", "x")]
    assert _trie(spark, rows) == _brute_trie(rows)
    assert _trie(spark, rows)[0][1:6] == (0, None, 1, 0, 1)
