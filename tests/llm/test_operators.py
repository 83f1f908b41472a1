"""The training-data operators against brute force, round trips and small fixtures."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from changefeed.llm import (
    cotraining, decontaminate, golay, induced_sort, kd_shards, licenses, line_chunks, pieces, repair_store, rules,
    similar, simhash, suffix_dedup,
)
from changefeed.llm.components import components
from changefeed.llm.common import table
from tests.oracle_check import compare, connect

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, words string, spans string"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

PASSAGE = " ".join(f"pass{i} age{i}" for i in range(40))
ODD = [
    (1, f"intro one\n{PASSAGE}\nsame line a\nsame line b\nsame line c", "en", "s", 5, None, None),
    (2, f"other two\n{PASSAGE}\nsame line a\nsame line b\nsame line c", "en", "s", 5, "x", "y"),
    (3, None, None, None, None, None, None),
    (4, "", "en", None, 0, "", ""),
    (5, "  \t\n ", None, "s", 5, None, None),
    (5, "  \t\n ", None, "s", 5, None, None),
    (None, "no id here but some words", "de", "t", 3, None, None),
    (6, "Grüße an <|endoftext|> 日本語 €uro don't. stop, " * 30, "de", "t", 9, None, None),
    (7, "long " * 60_000, "en", "t", 9, None, None),
    (8, PASSAGE, "en", "t", 9, None, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


@pytest.mark.parametrize("name", sorted(n for n in queries() if re.match(r"op\d+_|pipeline", n)))
def test_query(spark, name):
    ok, note = compare(spark, connect(SF), SF, queries()[name], oracle_sql().get(name))
    assert ok, note


def test_golay_neighbours_meet():
    x = np.random.default_rng(1).integers(0, 1 << 23, 500).astype(np.uint32)
    near, first = golay.indices(x)
    assert first.sum(axis=1).max() <= 6
    for bit in range(23):
        own = golay.index(x ^ np.uint32(1 << bit))
        assert ((near == own[:, None]) & first).any(axis=1).all()


def _classes(links, nodes):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_edges_are_contracted_in_their_task(monkeypatch):
    """A task's edges become a forest over the same nodes, in pieces of bounded size."""
    from changefeed.llm import components as module

    rng = np.random.default_rng(4)
    u, v = rng.integers(-300, 300, (2, 400))
    u, v = np.maximum(u, v)[u != v], np.minimum(u, v)[u != v]
    for together in (50, 1 << 18):
        monkeypatch.setattr(module, "_TOGETHER", together)
        batches = [pa.RecordBatch.from_arrays([pa.array(u[i : i + 30]), pa.array(v[i : i + 30])], names=["u", "v"]) for i in range(0, len(u), 30)]
        out = pa.Table.from_batches(module._contracted(iter(batches)))
        got = list(zip(out["u"].to_pylist(), out["v"].to_pylist()))
        assert all(a > b for a, b in got)
        nodes = np.unique(np.concatenate((u, v))).tolist()
        want = _classes(list(zip(u.tolist(), v.tolist())), nodes)
        assert _classes(got, nodes) == want
        if together > 400:
            assert sorted(got) == sorted((n, c) for n, c in want.items() if n != c)


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(500, i) for i in range(400, 450)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    want = _classes(edges, {n for e in edges if e[0] != e[1] for n in e})
    assert got == want


def test_components_of_few_edges_take_no_rounds(spark, monkeypatch):
    """The forest of a single task is the result; edges of several tasks still take rounds."""
    from changefeed.llm import components as module

    rng = random.Random(13)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    want = _classes(edges, {n for e in edges if e[0] != e[1] for n in e})
    frame, settled, settle = spark.createDataFrame(edges, "u bigint, v bigint").repartition(6), [], module.settle
    monkeypatch.setattr(module, "settle", lambda df: settled.append(df) or settle(df))
    assert {r.node: r.component for r in module.components(frame).collect()} == want
    assert len(settled) == 2
    monkeypatch.setattr(module, "EDGES_EACH", 40)
    assert {r.node: r.component for r in module.components(frame).collect()} == want
    assert len(settled) > 5


@pytest.mark.parametrize("members", [128, 1])
def test_simhash_links(spark, members, monkeypatch):
    monkeypatch.setattr(simhash, "PLAIN_MEMBERS", members)
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(60)]
    fps = set(base)
    for b in base[:25]:
        for _ in range(12):
            x = b
            for bit in rng.sample(range(64), rng.randint(1, 5)):
                x ^= 1 << bit
            fps.add(x)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3]
    want = _classes(links, {n for e in links for n in e})
    got = simhash.link_fingerprints(spark.createDataFrame([(f,) for f in signed], "fp bigint")).collect()
    assert {r.fp: r.component for r in got} == want


def test_fingerprint_brute():
    import xxhash

    for text in ("", "one", "One two", "a b c d e a b c " * 9, "é ü " * 50):
        words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
        grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
        assert simhash.fingerprint(text.encode()) == want


def test_keep_one(spark, odd):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    # 3, 4 and 5 have no words and link; the row without an id stays
    assert ids.count(3) == 1 and 4 not in ids and 5 not in ids and None in ids


def _near_copies():
    rng = random.Random(12)
    rows, base = [], []
    for i in range(40):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([40, 150, 600]))]
        base.append(words)
        for _ in range(3):
            copy = list(words)
            for at in rng.sample(range(len(copy)), rng.randint(1, max(1, len(copy) // 35))):
                copy[at] = f"x{rng.randrange(10**6)}"
            base.append(copy)
    base += [[f"h{i}" for i in range(400)]] * 3
    for j in range(60):  # one group of many near copies
        copy = [f"h{i}" for i in range(400)]
        for at in rng.sample(range(400), 3):
            copy[at] = f"y{j}-{at}"
        base.append(copy)
    return list(enumerate(" ".join(w) for w in base)) + [(1000, None), (1001, " "), (1002, "two words"), (1003, "Two  words")]


def test_keep_one_similar_brute(spark):
    rows = _near_copies()

    def grams(text):
        w = (text or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = {i: grams(t) for i, t in rows}
    same = lambda a, b: a == b or 5 * len(a & b) >= 4 * len(a | b)
    links = [(a, b) for a in sets for b in sets if a < b and same(sets[a], sets[b])]
    want = set(_classes(links, sets).values())
    docs = spark.createDataFrame(rows + [(None, rows[0][1]), (0, rows[0][1])], "doc_id bigint, text string")
    got = sorted((r.doc_id for r in similar.keep_one_similar(docs).collect()), key=str)
    assert got == sorted([*want, None], key=str)


def test_unlike_classes_get_no_fingerprint(spark):
    """Of all classes only those with 0.8 of their shingles in others are fingerprinted; none with a link is lost."""
    rows = [r for r in _near_copies() if r[1] and r[1].strip()] + [(2000 + i, " ".join(f"z{i}-{j}" for j in range(90))) for i in range(50)]
    sets = {i: set(similar.shingles(t.encode()).tolist()) for i, t in rows}
    named = spark.createDataFrame(rows, "key bigint, text string")
    found = similar._named_classes(named).selectExpr("key as first", "c", "n").dropDuplicates(["c"])
    got = {r["first"] for r in similar._able(named, found).collect()}
    different = {r["first"]: sets[r["first"]] for r in found.collect()}
    often = Counter(s for a in different.values() for s in a)
    assert got == {i for i, a in different.items() if 5 * sum(often[s] > 1 for s in a) >= 4 * len(a)}
    assert max(got) < 2000 and len(got) > 30


def test_small_groups_are_listed_by_aggregates(spark):
    """Least, greatest and xor of its parts give every class of a group whose parts have three at most, and of no other."""
    rng = random.Random(3)
    groups = {k: [rng.randrange(-(1 << 62), 1 << 62) for _ in range(k % 10 + 1)] for k in range(200)}
    rows = spark.createDataFrame([(k, c) for k, g in groups.items() for c in g], "k bigint, c bigint")
    parts = rows.groupBy("k").agg(*[F.sum(similar._part(i).cast("int")).alias(f"x{i}") for i in range(similar.PARTS)])
    fit = {r.k for r in parts.filter(F.greatest(*[f"x{i}" for i in range(similar.PARTS)]) <= similar.FEW).collect()}
    found = rows.groupBy("k").agg(*similar._members()).filter(F.greatest(*similar._COUNTS) <= similar.FEW)
    got = {r.k: sorted(r.m) for r in found.select("k", similar._listed_members().alias("m")).collect()}
    assert got == {k: sorted(groups[k]) for k in fit} and len(fit) > 60


def test_near_copies_meet_by_simhash():
    """Fingerprints are the majorities of their sets' bits; segments and whole ones keep pairs at 0.8 and part unrelated texts."""
    rng = random.Random(8)
    apart, met = [], []
    for i in range(120):
        words = [f"v{i}-{rng.randrange(10**6)}" for _ in range(404)]
        copy = [*words[:355], *[f"n{i}-{j}" for j in range(5)], *words[360:]]  # 391 of 409 shingles, 0.956
        far = [*words[:360], *[f"f{i}-{j}" for j in range(44)]]  # 356 of 444, 0.802
        sets = [similar.shingles(" ".join(w).encode()) for w in (words, copy, far)]
        prints = np.stack([similar.fingerprint(s) for s in sets])
        keys = similar.segment_keys(prints)
        assert keys.shape == (3, similar.TABLES) and len(np.unique(keys[0])) == similar.TABLES
        bits = np.unpackbits(prints.view(np.uint8), axis=1)
        assert ((keys[0] == keys[2]) == (bits[0] == bits[2])[similar._SEGMENTS].all(axis=1)).all()
        apart.append((bits[0] != bits[2]).mean())
        met.append([(keys[0] == keys[j]).any() for j in (1, 2)])
        other = similar.fingerprint(similar.shingles(" ".join(reversed(words)).encode()))
        assert (bits[0] != np.unpackbits(other.view(np.uint8))).sum() > similar.APART
    assert 0.14 < np.mean(apart) < 0.165 and np.mean(np.array(apart) * similar.BITS <= similar.APART) > 0.98
    assert all(m[0] for m in met) and np.mean(met, axis=0)[1] > 0.94


def test_links_in_one_dense_group(spark, monkeypatch):
    """Copies of one text with up to 9 edits, compared in many cells after one pivot: the components are those of all pairs."""
    monkeypatch.setattr(similar, "PIVOTS", 1)
    monkeypatch.setattr(similar, "CELL", 16)
    rng = random.Random(5)
    texts = []
    for i in range(150):
        words = [f"d{j}" for j in range(150)]
        for at in rng.sample(range(150), rng.randint(0, 9)):
            words[at] = f"e{i}-{at}" if rng.random() < 0.7 else f"shared{at}"
        texts.append(" ".join(words))
    sets = {}
    for text in texts:
        found = similar.shingles(text.encode())
        sets[similar.class_id(found)] = set(found.tolist())
    links = [(a, b) for a in sets for b in sets if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    alone = len(set(sets) - {c for link in links for c in link})
    assert len(links) > 300 and alone > 5
    named = spark.createDataFrame(enumerate(texts), "key bigint, text string")
    classes = similar._sketches(named).selectExpr("key as first", "c", "n", "bands").dropDuplicates(["c"])
    got = dict(similar.link_classes(classes, named).collect())
    want = _classes(links, sets)
    assert all(got.get(c, c) == want[c] for c in sets)


def test_keep_one_tells_rows_of_one_id_apart(spark):
    """Two texts under one id both stay, copies go, and no column name clashes."""
    other = " ".join(f"z{i}" for i in range(80))
    rows = [(1, PASSAGE, 0, "a", 1), (1, other, 0, "a", 1), (2, PASSAGE, 0, "a", 1), (1, PASSAGE, 0, "a", 1), (None, other, 0, "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _kept int, `key` string, mark int")
    for keep in (similar.keep_one_similar, simhash.keep_one):
        got = keep(docs)
        assert got.columns == docs.columns
        assert sorted(((r.doc_id, r.text == other) for r in got.collect()), key=str) == [(1, False), (1, True), (None, True)]
        assert keep(docs.limit(0)).count() == 0


def test_contamination(spark, odd):
    items = [(10, PASSAGE), (11, "some words"), (11, "some words"), (None, "an"), (12, None), (13, "...")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    one = {(r.doc_id, r.text): r for r in decontaminate.judge(decontaminate.find_contamination(odd, bench)).collect()}
    many = {
        (r.doc_id, r.text): r
        for r in decontaminate.judge(decontaminate.find_contamination(odd, bench, block_bytes=100)).collect()
    }
    assert one == many
    row = one[(1, ODD[0][1])]
    assert row["items"] == [10] and row.n_hit == 80 and row.contaminated
    assert one[(None, ODD[6][1])]["items"] == [11]
    kept = decontaminate.drop_contaminated(odd, bench)
    assert kept.columns == odd.columns and kept.filter("doc_id = 1 or doc_id = 8").count() == 0
    cut = decontaminate.remove_spans(decontaminate.find_contamination(odd, bench)).filter("doc_id = 2").first().text
    assert "pass3" not in cut and cut.startswith("other two") and cut.endswith("same line c")
    none = decontaminate.find_contamination(odd, bench.limit(0)).filter("size(spans) > 0")
    assert none.count() == 0


def test_rules_brute(spark, odd):
    got = {(r.doc_id, r.n_words): r for r in rules.cascade(odd).collect()}
    for row in ODD:
        words = [w for w in re.split("[\x20\x09-\x0d]+", row[1] or "") if w]
        grams = Counter(zip(words, words[1:], words[2:]))
        covered = {i + d for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for d in range(3)}
        r = got[(row[0], len(words))]
        assert (r.word_chars, r.n_repeat_words) == (sum(map(len, words)), len(covered))
        assert r.base_failed == (len(words) < 50 or 100 * len(covered) > 50 * len(words))
    assert rules.cascade(odd.limit(0)).count() == 0


def test_rules_in_order(spark):
    """The order follows rejections per cost among the rows left, the same each time; a dear rule comes last."""
    texts = ["plain words of a text that is in the end good " * 8] * 3 + ["Short ## && ## bits " * 20] * 40
    docs = spark.createDataFrame([(i, f"{t}{i} one two {i * 7} three {i * 3}") for i, t in enumerate(texts)], "key long, text string")
    some = (
        rules.Rule("dear", "n_symbols > 10", "1000 * word_chars"), rules.Rule("cheap", "n_symbols > 10", "1"),
        rules.Rule("same_rows", "n_symbols > 5", "2"), rules.Rule("other_rows", "n_symbols = 0", "1"),
        rules.Rule("null", "cast(null as boolean)", "word_chars"),
    )
    rows = rules._add(docs, "n_symbols", "cast(length(text) - length(replace(replace(text, '#', ''), '&', '')) as bigint)")
    rows = rows.withColumn("word_chars", F.length("text"))
    for parts in (1, 5):
        names = [r.name for r in rules.in_order(rows.repartition(parts), some)]
        assert names == ["cheap", "other_rows", "same_rows", "null", "dear"]
    assert rules.in_order(rows.limit(0), some) and rules.in_order(rows, ()) == []


def test_rules_sample(spark, monkeypatch):
    monkeypatch.setattr(rules, "SAMPLE_ROWS", 20)
    rows = spark.range(300).selectExpr("id % 100 as key", "concat('t', id % 100) as text").repartition(7)
    few = rules.sampled(rows).collect()
    assert len(few) == 20 == len({r.key for r in few})
    assert sorted(map(str, few)) == sorted(map(str, rules.sampled(rows.repartition(2)).collect()))
    assert rules.sampled(rows.limit(5)).count() <= 5 and rules.sampled(rows.limit(0)).count() == 0


def test_licenses(spark, odd):
    text = "Words first.\nreleased under the MIT license\nLicensed under CC BY-NC 4.0."
    extra = spark.createDataFrame([(1, text), (2, None), (3, "MIT")], "doc_id bigint, text string")
    rows = {r.doc_id: r for r in licenses.scan_licenses(extra).collect()}
    assert {m.name for m in rows[1].matches} >= {"MIT", "CC-BY-NC-4.0"}
    assert rows[2].matches == [] and rows[3].matches == []
    assert licenses.scan_licenses(odd).count() == len(ODD)


def test_line_chunks(spark, odd):
    out = line_chunks.dedup_lines(odd)
    assert out.columns == odd.columns and out.count() == len(ODD)
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[1].text == ODD[0][1] and rows[3].text is None and rows[4].text == ""
    lines = [f"line {i} of it" for i in range(60)]
    pair = spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join(["new", *lines, "end"]))], "doc_id bigint, text string")
    left = {r.doc_id: r for r in line_chunks.remove_repeated(pair).collect()}
    assert left[1].removed == 0 and left[2].removed_lines > 45


def test_dedup_lines_takes_whole_runs(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    line = lambda: " ".join(word() for _ in range(6))
    rows, own = [], {}
    for i in range(30):
        run = [line() for _ in range(rng.choice([2, 3, 4, 7]))]
        run[1:1] = [""] * rng.choice([0, 0, 1, 4])
        for side in range(2):
            head, tail = [line() for _ in range(3)], [line() for _ in range(2)]
            own[2 * i + side] = "\n".join(head + tail if side else [*head, *run, *tail])
            rows.append((2 * i + side, "\n".join([*head, *run, *tail]), 7))
    out = line_chunks.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string, n_chars int")).collect()
    assert {r.doc_id: r.text for r in out} == own
    assert all(r.n_chars == (len(r.text) if r.doc_id % 2 else 7) for r in out)


def test_repair_round_trip(spark, odd):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORD_BPE)
    path = repair_store.store_documents(odd.filter("doc_id is not null"), WORD_BPE)
    rows = sorted(repair_store.read_store(spark, path).collect(), key=lambda r: r.start)
    want = sorted((r for r in ODD if r[0] is not None), key=lambda r: r[0])
    start = 0
    for got, row in zip(rows, want, strict=True):
        ids = tokenizer.encode(row[1] or "", add_special_tokens=False).ids + [2]
        raw = np.array(ids, "<u4").tobytes()
        assert (got.doc_id, got.start, got.n_tokens, got.ids_crc32) == (row[0], start, len(ids), zlib.crc32(raw))
        assert bytes(got.ids) == raw
        start += len(ids)


def test_repair_random_access():
    rng = np.random.default_rng(2)
    ids = rng.integers(0, 6, 5000)
    starts = np.arange(0, 5001, 250)
    symbols, begins, base, grammar, lengths = repair_store.compress(ids, starts)
    assert len(symbols) < len(ids) and len(begins) == len(starts)
    assert (repair_store.expand(symbols, base, grammar, lengths) == ids).all()
    for a, b in ((0, 5000), (17, 18), (900, 1100), (4999, 5000)):
        assert (repair_store.ids_between(symbols, base, grammar, lengths, a, b) == ids[a:b]).all()


def test_repair_leaves_no_pair_that_pays():
    """Random and repeated sequences: exact round trips, and no pair occurs often enough for another rule."""
    rng = np.random.default_rng(5)
    for trial in range(200):
        ids = rng.integers(0, rng.integers(1, 9), rng.integers(1, 600))
        if trial % 5 == 0:
            ids = np.tile(ids[:7], 90)
        starts = np.unique(np.concatenate(([0, len(ids)], rng.integers(0, len(ids) + 1, 3))))
        symbols, begins, base, grammar, lengths = repair_store.compress(ids, starts)
        assert (repair_store.expand(symbols, base, grammar, lengths) == ids).all()
        left = Counter()
        for a, b in zip(begins[:-1], begins[1:]):
            at = a
            while at < b - 1:  # occurrences that do not overlap
                pair = (symbols[at], symbols[at + 1])
                left[pair] += 1
                at += 2 if at + 2 < b and symbols[at + 1 : at + 3].tolist() == list(pair) and pair[0] == pair[1] else 1
        assert max(left.values(), default=0) < repair_store.LEAST_COUNT
    long = repair_store.compress(np.zeros(100_000, np.int64), np.array([0, 100_000]))
    assert long[4].max() > 10_000


def test_pairs_are_counted_as_unique_does():
    rng = np.random.default_rng(3)
    for most in (1, 2, 50, 1 << 40, 1 << 62):  # the last do not fit beside their places
        for n in (0, 1, 300):
            code = rng.integers(0, most, n)
            want = np.unique(code, return_inverse=True, return_counts=True)
            assert all((a == b).all() and len(a) == len(b) for a, b in zip(repair_store._counted(code), want))


def test_rare_pairs_are_left_aside_while_counting():
    rng = np.random.default_rng(4)
    for most in (9, 60, 1 << 62):
        code = np.concatenate([rng.integers(0, most, 300), np.full(5, most // 2)])
        values, each = np.unique(code, return_counts=True)
        got, pair, counts = repair_store._counted(code, 4)
        assert got.tolist() == values[each >= 4].tolist() and counts.tolist() == each[each >= 4].tolist()
        number = {v: i for i, v in enumerate(got.tolist())}
        assert pair.tolist() == [number.get(c, -1) for c in code.tolist()]


def test_words_of_letters_pass_as_bytes():
    """The bytes of words of letters become the vocabulary's letters here, not in the tokenizer, with the ids of the library."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(WORD_BPE)
    encoder = repair_store.WordEncoder(WORD_BPE)
    assert "ByteLevel" not in str(encoder.bare.pre_tokenizer)
    letters = [chr(c) for c in range(0x180) if chr(c).isalpha()]
    words = [f"a{c}{d}z" for c in letters for d in random.Random(ord(c)).sample(letters, 4)]
    for word, ids in zip(words, encoder.encode_all([w.encode() for w in words])):
        assert np.frombuffer(ids, np.uint32).tolist() == whole.encode(word, add_special_tokens=False).ids


def test_words_are_learnt_without_their_signs():
    """One stem for all signs after it, ids as the library gives them, and words in use outlive a full cache."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(WORD_BPE)
    encoder = repair_store.WordEncoder(WORD_BPE)
    encoder.encode_all([b"stem stem*** stem!! Stem,&&& \xc3\xa9t\xc3\xa9. \xc4\xb0."])
    assert {b"stem", "été".encode(), "İ.".encode()} <= set(encoder.known)
    assert not {b"stem***", b"stem!!", b"stem,&&&", "été.".encode()} & set(encoder.known)
    rng = random.Random(12)
    odd = "abZ éÉßİıſKñ01.,;!?'\"#*&-_()[]<|>=\t\n\u0301\u0338\u2028\xa0字²"
    texts = ["".join(rng.choices(odd, k=rng.randint(0, 30))) for _ in range(3000)]
    texts += ["a <|endoftext|>. b", "it's we'll. you'd!! 's. x's. ''s", "", " "]
    for text, ids in zip(texts, encoder.encode_all([t.encode() for t in texts])):
        assert np.frombuffer(ids, np.uint32).tolist() == whole.encode(text, add_special_tokens=False).ids
    encoder.held = repair_store.CACHE_BYTES
    encoder.encode_all([b"stem"])
    assert set(encoder.known) == {b"stem"}
    encoder.held = repair_store.CACHE_BYTES
    encoder.encode_all([b"other"])
    assert b"stem" in encoder.older and len(encoder.older) == 1


def test_caches_are_bounded_by_bytes():
    vocabulary = pieces.load(MODEL)
    vocabulary.known.clear()
    vocabulary.held = 0
    vocabulary.encode("x" * 1_000_001)
    assert not vocabulary.known
    encoder = repair_store.word_encoder(WORD_BPE)
    encoder.encode_all([b"y" * 3_000_000])
    assert encoder.held > 3_000_000


def test_cotraining_held_out(spark):
    rng = random.Random(4)
    vocabulary = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)]
    rows, labels = [], []
    for i in range(900):
        words, bad = rng.choices(vocabulary, k=80), i % 4 == 0
        if bad:
            words[rng.randrange(80)] = rng.choice(["vile", "awful"])
        rows.append((i, " ".join(words), "en", "a", 1))
        if i < 600:
            labels.append((i, 1, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, kept int")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    kept = {r.doc_id for r in cotraining.keep_good(docs, marks).collect()}
    held = range(600, 900)
    assert sum((i in kept) == (i % 4 != 0) for i in held) >= 0.97 * len(held)
    assert cotraining.keep_good(docs, marks.limit(0)).count() == len(rows)


def test_cotraining_exchange_brute(spark, docs):
    """The gradients of the exchange are those of all unlabelled rows, whatever the partitions."""
    marks = cotraining._labelled(docs, table(spark, SF, "labels"), "doc_id")
    start = cotraining._start(docs, marks, "doc_id", "text")
    numbered = cotraining._numbered(cotraining._rows(docs, "doc_id", "text"), start)
    views = [cotraining.View(v.weights * 3, v.bias) for v in start.views]
    got, counts = cotraining._exchange(numbered.repartition(5), start, start.views, views)
    rows = numbered.collect()
    x = [np.zeros((len(rows), m.shape[1])) for m in start.x]
    for i, r in enumerate(rows):
        x[0][i, r.words] = 1
        x[1][i, r.steps] = 1
    chance = [1 / (1 + np.exp(-np.clip(start.views[k].logit(x[k]), -30, 30))) for k in range(2)]
    for k in range(2):
        p = 1 / (1 + np.exp(-np.clip(views[k].logit(x[k]), -30, 30)))
        for c, sure in enumerate((chance[1 - k] <= 0.02, chance[1 - k] >= 0.98)):
            error = (p - c) * sure
            assert counts[k][c] == sure.sum()
            assert got[k][c] == pytest.approx(np.append(error @ x[k], error.sum()), abs=1e-3)
    scored = {r.doc_id: r.score for r in cotraining.train_and_score(docs, table(spark, SF, "labels")).collect()}
    kept = {r.doc_id for r in cotraining.keep_good(docs, table(spark, SF, "labels")).collect()}
    assert kept == {i for i, p in scored.items() if p >= 0.5}


def test_cotraining_fits_few_rows_at_a_time():
    """Fits of the driver copy no whole columns, and take the same steps as over all rows at once."""
    import tracemalloc

    rng = np.random.default_rng(7)
    y = (rng.random(4000) < 0.7).astype(float)
    rows = [np.unique(rng.integers(0, 600, 200) + 300 * int(good)) for good in y]
    dense = np.hstack([rng.random((4000, cotraining.DENSE)), rng.integers(0, 30, (4000, 2)).astype(float)])
    tracemalloc.start()
    start = cotraining._Start(rows, dense, y)
    view = start.step(0, start.views[0], np.ones((2, start.x[0].shape[1] + 1)), np.array([5.0, 0.0]))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 30e6  # 17 MB; 46 MB when all rows were widened at once
    train = ~start.aside
    x, good = np.hstack([start.x[0][train], np.ones((train.sum(), 1))]).astype(float), y[train]
    w, penalty = np.append(start.views[0].weights, start.views[0].bias), np.ones(x.shape[1])
    penalty[-1] = 1e-6
    p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
    weight = np.where(good == 0, 2, 1)
    gradient = x.T @ (p - good) + penalty * w + (good == 0).sum() / 5
    move = np.linalg.solve((x * (weight * (p * (1 - p) + 1e-6))[:, None]).T @ x + np.diag(penalty), gradient)
    assert np.append(view.weights, view.bias) == pytest.approx(w - move / max(1.0, np.abs(move).max() / 4), abs=1e-6)


def test_cotraining_odd_rows(spark, odd):
    scored = cotraining.score_documents(odd, cotraining.train(odd, table(spark, SF, "labels")))
    assert scored.count() == len(ODD)


def _brute_repeats(texts, length):
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        cover = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                cover[i : i + length] = b"\1" * length
        out.append(bytes(x for x, c in zip(t, cover) if not c))
    return out


def test_suffix_dedup_brute(spark):
    rng = random.Random(6)
    text = lambda n: "".join(rng.choices("abcdé ", k=n))
    shared = [text(n) for n in (150, 199, 200, 260, 700)]
    texts = ["".join(x for s in rng.sample(shared, 3) for x in (text(rng.randint(0, 300)), s)) for _ in range(25)]
    texts += [texts[0], "x" * 500, "", "ab" * 90, text(2500)]
    got = suffix_dedup.remove_repeated(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    rows = {r.doc_id: r for r in got.collect()}
    for i, want in enumerate(_brute_repeats([t.encode() for t in texts], 200)):
        assert bytes(rows[i].kept) == want and rows[i].kept_sha256 == hashlib.sha256(want).hexdigest()


def test_suffix_dedup_shuffles_texts_once(spark):
    """Null ids, null texts and equal rows; both joins of the texts read the same shuffle files, nothing is broadcast for its size."""
    rng = random.Random(8)
    text = lambda n: "".join(rng.choices("abcdé ", k=n))
    shared = [text(n) for n in (199, 260, 500)]
    rows = [(i % 4 or None, text(rng.randint(0, 200)) + rng.choice(shared) + text(rng.randint(0, 200))) for i in range(30)]
    rows += [(None, None), (7, None), (7, ""), rows[0], rows[1], (8, text(900))]
    out = suffix_dedup.remove_repeated(spark.createDataFrame(rows, "doc_id bigint, text string"))
    got = sorted((r.doc_id or 0, bytes(r.kept)) for r in out.collect())
    want = _brute_repeats([(t or "").encode() for _, t in rows], 200)
    assert got == sorted((i or 0, kept) for (i, _), kept in zip(rows, want))
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ReusedExchange") == 2


def test_equal_runs_go_to_their_anchor_once():
    k = np.array([5, 5, 6, 5, 5, 6])
    digests = [b"a" * 16, b"b" * 16, b"a" * 16, b"a" * 16, b"a" * 8 + b"b" * 8, b"a" * 16]
    assert suffix_dedup._copies(k, digests).tolist() == [2, 1, 2, 0, 1, 0]
    assert suffix_dedup._copies(k[:0], []).tolist() == []


def test_sort_by_doubling():
    rng = random.Random(9)
    for trial in range(100):
        t = [rng.randint(0, rng.choice([1, 9, 1 << 40])) for _ in range(rng.randint(1, 60))]
        t = t[:5] * 9 if trial % 5 == 0 else t
        assert induced_sort.by_doubling(np.array(t)).tolist() == sorted(range(len(t)), key=lambda i: t[i:])


@pytest.mark.parametrize("held", [40, 1 << 26])
def test_induced_sort(held, monkeypatch):
    monkeypatch.setattr(induced_sort, "HELD", held)
    rng = random.Random(7)
    for trial in range(150):
        monkeypatch.setattr(induced_sort, "FEW_EACH", rng.choice([0, 200]))
        t = [rng.randint(0, rng.choice([1, 2, 5])) for _ in range(rng.randint(1, 50))]
        assert induced_sort.order(np.array(t)).tolist() == sorted(range(len(t)), key=lambda i: t[i:])
        count = Counter(tuple(t[i : i + 3]) for i in range(len(t) - 2))
        want = [i + 3 <= len(t) and count[tuple(t[i : i + 3])] > 1 for i in range(len(t))]
        assert induced_sort.repeated_starts(np.array(t), 3).tolist() == want


def test_pieces_brute(spark, odd):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    vocabulary = pieces.load(MODEL)
    scores = {library.id_to_piece(i): library.get_score(i) for i in vocabulary.raw if not library.is_byte(i)}
    rows = pieces.decode_pieces(pieces.encode_pieces(odd, MODEL), MODEL).collect()
    once = pieces.round_trip(odd, MODEL).collect()
    assert all(r.round_trip for r in once) and pieces.round_trip(odd.limit(0), MODEL).count() == 0
    assert sorted((str(r.doc_id), r.ids_crc32, str(r.ids)) for r in once) == sorted((str(r.doc_id), r.ids_crc32, str(r.ids)) for r in rows)
    for row in rows:
        assert row.decoded == row.text
        if row.text and len(row.text) < 2000:
            assert library.decode(list(row.ids)) == row.text
            text = "▁" + row.text.replace(" ", "▁")
            best = [0.0] + [-1e18] * len(text)
            for end in range(1, len(text) + 1):
                best[end] = best[end - 1] + vocabulary.fallback
                for start in range(max(0, end - 64), end):
                    if text[start:end] in scores:
                        best[end] = max(best[end], best[start] + scores[text[start:end]])
            byte_ids, total, held = set(vocabulary.byte_ids), 0.0, b""
            for i in row.ids:
                if i in byte_ids:
                    held += vocabulary.raw[i]
                else:
                    total += library.get_score(i)
            total += vocabulary.fallback * len(held.decode())
            assert total == pytest.approx(best[-1])


def test_shards(spark, odd, docs):
    rows = kd_shards.shard_documents(docs).collect()
    total, sums = sum(r["size"] for r in rows), Counter()
    for r in rows:
        sums[r.shard] += r["size"]
    largest = max(r["size"] for r in rows)
    assert set(sums) == set(range(8)) and max(abs(s - total / 8) for s in sums.values()) <= 2 * largest
    for shard in sums:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    assert kd_shards.shard_documents(odd).count() == len(ODD)
    assert kd_shards.shard_documents(odd.limit(0)).count() == 0


def test_pipeline_stages(spark):
    docs = table(spark, SF, "documents")
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = stage(spark, docs, SF).checkpoint()
        assert docs.columns == names and docs.count() <= before, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).filter("not round_trip").count() == 0
