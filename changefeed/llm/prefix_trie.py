"""A prefix trie of conversations by collapsing whole sequences.

Identical conversations are grouped first, into *sequences* with a weight (how many
conversations) and the digest of their list of ids; copies cost nothing after that.
A sequence that is a proper prefix of another one is found by an anti-join; the
others are the leaves. Then every prefix of every sequence, weighted, is one row of
an aggregation whose groups are the nodes of the trie.

A turn stands for itself by two 64-bit hashes of role and text; a prefix by the XOR
of its turns' hashes, each mixed with its place, 128 bits in all. Such digests need
no order to be summed up, so nothing walks along a conversation in one task: turns
are numbered, and prefixes accumulated, in segments of ``2**SEGMENT_BITS`` places.
Texts are read once, at the scan, and never shuffled.

Sums over a subtree come from sequences as well. All nodes of a subtree, each as
often as it has members, are the rest of each member sequence from that depth on.
Each node once is counted through its *owner*, the sequence with its smallest
conversation: an owner owns the end of its path, from some depth on, so the rests
that members own add up to the distinct nodes below.

Lists of ids are hashed in order without gathering them: ranges of (sequence, id)
become pieces of text of ``PIECE_IDS`` ids, and only those meet in one task.

Cases: null role and text are empty; a null turn comes first; turns with one number
follow each other in an order of their hashes; rows without a conversation id belong
to none; ids are rounded down to hundreds toward zero; an empty table gives no rows,
not even a root.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changefeed.llm.common import in_parts
from changefeed.operators.ordered import LOWEST, running_number
from changefeed.session import settle

FAMILY, SHARES = 100, 6
SEGMENT_BITS = 16
PIECE_IDS = 8192

NODE = ["depth", "h1", "h2"]


def _turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, i, d1, d2, size): each turn with its number in the conversation, from 1, its hashes and code points."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.coalesce(F.col("turn").cast("bigint"), F.lit(LOWEST)).alias("turn"),
        F.col("turn").isNotNull().alias("numbered"),
        F.xxhash64(F.lit(1), role, text).alias("d1"), F.xxhash64(F.lit(2), role, text).alias("d2"),
        F.char_length(text).cast("bigint").alias("size"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = ["turn", "numbered", "d1", "d2", "row"]
    return running_number(settle(rows), ["conv_id"], order, "i").select("conv_id", "i", "d1", "d2", "size")


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns) after each took over the first turns of its family's first one.

    Conversation c has h = crc32(c) mod ``SHARES``; its first h turns become those of
    c - c mod ``FAMILY`` (as many as there are), its own follow after their first h.
    """
    own = turns.groupBy("conv_id").agg(F.max("i").alias("n"))
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARES
    convs = own.select(
        "conv_id", "n", shared.alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("first")
    )
    firsts = own.select(F.col("conv_id").alias("first"), F.col("n").alias("n_first"))
    convs = settle(
        convs.join(firsts, "first", "left")
        .withColumn("k", F.least("h", F.coalesce("n_first", F.lit(0))))
        .select("conv_id", "first", "h", "k")
    )
    heads = turns.filter(f"i < {SHARES} and conv_id % {FAMILY} = 0").withColumnRenamed("conv_id", "first")
    taken = convs.filter("k > 0").join(heads, "first").filter("i <= k")
    kept = turns.join(convs, "conv_id").filter("i > h").withColumn("i", F.col("k") + F.col("i") - F.col("h"))
    columns = ["conv_id", "i", "d1", "d2", "size"]
    return convs.select("conv_id"), taken.select(*columns).unionByName(kept.select(*columns))


def _mixed(number: int) -> Column:
    return F.xxhash64(F.lit(number), "i", "d1", "d2")


def _pieces(batches):
    """Ids of one sequence after the other, in order, joined to pieces of text."""

    def rows():
        now, ids = None, []
        for batch in batches:
            for *key, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if key != now or len(ids) == PIECE_IDS:
                    if ids:
                        yield *now, ids[0], len(ids), ",".join(map(str, ids))
                    now, ids = key, []
                ids.append(conv)
        if ids:
            yield *now, ids[0], len(ids), ",".join(map(str, ids))

    yield from in_parts(rows(), [*NODE, "total", "least", "w", "ids"], [*[pa.int64()] * 6, pa.string()], 1000)


def _weighted(batches):
    """One row for each sequence from its pieces in order."""

    def rows():
        now, least, w, digest = None, None, 0, None
        for batch in batches:
            for *key, first, n, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if key != now:
                    if now:
                        yield *now, least, w, digest.hexdigest()
                    now, least, w, digest = key, first, n, hashlib.sha256(ids.encode())
                else:
                    w += n
                    digest.update(b"," + ids.encode())
        if now:
            yield *now, least, w, digest.hexdigest()

    yield from in_parts(rows(), [*NODE, "total", "conv_id", "w", "ends_sha256"], [*[pa.int64()] * 6, pa.string()])


def sequences(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """(depth, h1, h2, total, conv_id, w, ends_sha256): distinct sequences of turns.

    total is the code points of all texts, conv_id the smallest of the w conversations.
    """
    whole = turns.groupBy("conv_id").agg(
        F.max("i").alias("depth"), F.bit_xor(_mixed(3)).alias("h1"), F.bit_xor(_mixed(4)).alias("h2"),
        F.sum("size").alias("total"),
    )
    key = [*NODE, "total"]
    listed = convs.join(whole, "conv_id", "left").select(
        *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in key], "conv_id"
    )
    schema = ", ".join(f"{c} bigint" for c in key)
    pieces = (
        settle(listed).repartitionByRange(*key, "conv_id").sortWithinPartitions(*key, "conv_id")
        .mapInArrow(_pieces, f"{schema}, least bigint, w bigint, ids string")
    )
    return (
        pieces.repartition(*NODE).sortWithinPartitions(*key, "least")
        .mapInArrow(_weighted, f"{schema}, conv_id bigint, w bigint, ends_sha256 string")
    )


def _prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, h1, h2, p1, p2, before, size) of every prefix: its digest, its parent's, and the code points before."""
    rows = turns.select(
        "conv_id", "i", "size", _mixed(3).alias("x1"), _mixed(4).alias("x2"), F.shiftright("i", SEGMENT_BITS).alias("seg")
    )
    inside = Window.partitionBy("conv_id", "seg").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    parts = rows.groupBy("conv_id", "seg").agg(F.bit_xor("x1").alias("s1"), F.bit_xor("x2").alias("s2"), F.sum("size").alias("s"))
    parts = parts.select(
        "conv_id", "seg", F.coalesce(F.bit_xor("s1").over(earlier), zero).alias("s1"),
        F.coalesce(F.bit_xor("s2").over(earlier), zero).alias("s2"), F.coalesce(F.sum("s").over(earlier), zero).alias("s"),
    )
    run = rows.select(
        "*", F.bit_xor("x1").over(inside).alias("r1"), F.bit_xor("x2").over(inside).alias("r2"), F.sum("size").over(inside).alias("r")
    ).join(parts, ["conv_id", "seg"])
    h1, h2 = F.col("r1").bitwiseXOR(F.col("s1")), F.col("r2").bitwiseXOR(F.col("s2"))
    return run.select(
        "conv_id", F.col("i").alias("depth"), h1.alias("h1"), h2.alias("h2"),
        h1.bitwiseXOR(F.col("x1")).alias("p1"), h2.bitwiseXOR(F.col("x2")).alias("p2"),
        (F.col("r") + F.col("s") - F.col("size")).alias("before"), "size",
    )


def prefix_trie(conversations: DataFrame, rebuilt: bool = True) -> DataFrame:
    """One row for each node of the trie of all conversations (conv_id, turn, role, text).

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256, size): size is the code points of the node's last text. With
    ``rebuilt`` false the conversations are taken as they are.
    """
    turns = settle(_turns(conversations))
    convs = turns.select("conv_id").distinct()
    if rebuilt:
        convs, turns = rebuild(turns)
        turns = settle(turns)
    seqs = settle(sequences(convs, turns))
    zero = F.lit(0).cast("bigint")
    # the rows of one conversation for each sequence, and the root for all
    chosen = _prefixes(turns.join(seqs.select("conv_id"), "conv_id", "left_semi"))
    roots = seqs.select("conv_id", *[zero.alias(c) for c in chosen.columns[1:]])
    paths = settle(chosen.unionByName(roots))
    lengths = seqs.select("conv_id", "w", "total", F.col("depth").alias("n"))
    inner = paths.join(lengths, "conv_id").filter("depth < n").select(*NODE).distinct()
    leaves = seqs.join(inner, NODE, "left_anti").select("conv_id", F.lit(1).cast("bigint").alias("leaf"))
    owned = (
        paths.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.min("before").alias("before"))
        .groupBy("conv_id").agg(F.min(F.struct("depth", "before")).alias("top"))
    )
    lengths = settle(
        lengths.join(leaves, "conv_id", "left").join(owned, "conv_id", "left").select(
            "conv_id", "w", "total", F.coalesce("leaf", zero).alias("leaf"),
            F.coalesce(F.col("total") - F.col("top.before"), zero).alias("own"),
        )
    )
    rest = F.col("total") - F.col("before")
    nodes = settle(
        paths.join(lengths, "conv_id").groupBy(*NODE).agg(
            F.min(F.struct("conv_id", "total", "own")).alias("owner"), F.min("p1").alias("p1"), F.min("p2").alias("p2"),
            F.min("before").alias("before"), F.min("size").alias("size"), F.sum("w").alias("n_convs"),
            F.sum("leaf").alias("n_leaves"), F.sum(F.col("w") * rest).alias("members"), F.sum("own").alias("distinct"),
        )
    )
    root = nodes.filter("depth = 0").select("owner.conv_id").first()
    parents = nodes.filter("depth > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("h1").alias("p1"), F.col("h2").alias("p2"),
        F.col("owner.conv_id").alias("parent_conv_id"),
    )
    children = (
        nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("h1"), F.col("p2").alias("h2"))
        .agg(F.count("*").alias("n_children"))
    )
    once = F.col("owner.total") - F.col("before") - F.col("owner.own") + F.col("distinct")
    return (
        nodes.join(parents, ["depth", "p1", "p2"], "left").join(children, NODE, "left")
        .join(seqs.select(*NODE, "ends_sha256"), NODE, "left")
        .select(
            F.col("owner.conv_id").alias("conv_id"), "depth",
            F.when(F.col("depth") == 1, F.lit(root[0] if root else None).cast("bigint")).otherwise(F.col("parent_conv_id")).alias("parent_conv_id"),
            "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves",
            (F.col("members") - once).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"), "size",
        )
    )
