"""Token ids in Re-Pair grammar files.

Documents are put in order of their id by a range partitioning, encoded and cut
into blocks of about ``BLOCK_IDS`` ids. Each block has a grammar of its own: the
most frequent neighbouring id pairs that do not cross a document's end become
nonterminals and are replaced everywhere in the block, in rounds, until no pair is
left that pays for its rule (a rule is three numbers, a replaced pair saves one, so
it pays from ``LEAST_COUNT`` on). A round replaces all pairs that pay; where two of them
overlap the more frequent one is taken, in a run of equal ones every other from the
left. Pairs are counted once: later rounds look at pairs with a symbol of the round
before, and at what was left over.

File format: Parquet rows, one for each block, in the order of ``part, block``:

    part, block        place of the block; ids of the table follow this order
    docs               the document ids
    starts             where each document starts in ``symbols``, and the end
    offsets            where each document starts in the block's ids, and the end
    base               ids below are terminals; nonterminal k is base + k
    rules              two little-endian unsigned 32-bit symbols for each nonterminal
    lengths            how many ids each nonterminal expands to (unsigned 32-bit)
    symbols            the compressed sequence, unsigned 32-bit

Document i is decoded from ``symbols[starts[i]:starts[i + 1]]`` alone, and any id
inside it is found by the running sum of the lengths. Parquet pages are
compressed on top. Spark's writer commits whole files only, so a lost executor
repeats its blocks and leaves no half-written ones.

Words are encoded once per worker and the latest are remembered (in about ``CACHE_BYTES``): the tokenizer
drops blanks and never joins across them, so whole texts give the same ids.

Cases: a null or empty text is the end id alone; rows of equal ids stand together
in any order; a null id comes first; an empty table gives no blocks.
"""

from __future__ import annotations

import os
import re
import uuid
from array import array
from codecs import charmap_decode
from functools import cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changefeed.llm.common import bounded_broadcast, in_parts, utf8
from changefeed.session import gone_at_exit, settle, shared_dir

BLOCK_IDS = 500_000
CACHE_BYTES = 64 * 1024 * 1024
# Letters below 0x180 are composed and have simple lower cases.
# Letters of Latin that signs after them leave as they are (one capital has a mark of its own in lower case), and ASCII signs.
SIGNED = r"([a-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{17F}])([!-/:-@\[-`{-~]+)( |$)"
LATIN = re.compile("[" + "".join(c for c in map(chr, range(0x180)) if c.isalpha()) + "]+")
# The letter that stands for each byte in a byte-level vocabulary; bytes that no word of letters holds are left as they are.
BYTE_LETTERS = "".join(chr({byte: 0x122 + i for i, byte in enumerate([*range(0x80, 0xA1), 0xAD])}.get(b, b)) for b in range(256))
LEAST_COUNT = 4
_ENTRY, _BINS = 180, 1 << 18
_LOOK, _LAST = 1, 2


class WordEncoder:
    """Ids, as bytes, of each blank-separated word seen lately.

    The tokenizer lower-cases, so A-Z are lowered first, and it parts letters from
    signs, so ASCII signs after the last letter of a word are a word of their own: fewer
    different words are encoded. Words of Latin letters alone pass normalising and
    splitting unchanged, skip both and are encoded many at a time, their bytes put into letters here.
    Texts that may hold a special token go whole.

    Of two generations of words the older is dropped when the younger is full; a word
    that is used moves to the younger.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.bare = Tokenizer(self.whole.model)
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.whole.get_vocab()
        self.last = np.zeros(max(vocabulary.values(), default=0) + 1, bool)  # ids that end a word
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.held = 0  # bytes of the younger words

    def _keep(self, words: list[bytes], ids: list[bytes]) -> None:
        self.known.update(zip(words, ids))
        self.held += _ENTRY * len(words) + sum(map(len, words)) + sum(map(len, ids))

    def _letters(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of letters, cut where a word ends."""
        out = []
        for at in range(0, len(words), 256):
            some = words[at : at + 256]
            raw = b" ".join(some)
            text = raw.decode() if raw.isascii() else charmap_decode(raw, "strict", BYTE_LETTERS)[0]
            ids = np.array(self.bare.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(some):
                raw, ends = ids.tobytes(), (4 * ends).tolist()
                out.extend([raw[a:b] for a, b in zip([0, *ends], ends)])
            else:  # a vocabulary without marked ends
                out.extend(_encoded(self.bare, text.split(" ")))
        return out

    def _learn(self, unseen: list[bytes]) -> None:
        again = [w for w in unseen if w in self.older] if self.older else []
        self._keep(again, list(map(self.older.__getitem__, again)))
        new = [w for w in unseen if w not in self.known] if again else unseen
        letters = [w for w in new if w.isalpha()]
        lowered, others = letters.copy(), []
        if len(letters) < len(new):
            rest = [w for w in new if not w.isalpha()]
            for w, word in zip(rest, b" ".join(rest).decode().lower().split(" ")):
                if LATIN.fullmatch(word):
                    letters.append(w)
                    lowered.append(word.encode())
                else:
                    others.append(w)
        self._keep(letters, self._letters(lowered))
        self._keep(others, _encoded(self.whole, [w.decode() for w in others]))

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        out = []
        for at in range(0, len(texts), 512):
            if self.held > CACHE_BYTES // 2:
                self.older, self.known, self.held = self.known, {}, 0
            part = texts[at : at + 512]
            special = [b"<|" in t for t in part]
            plain = [b"" if whole else t.lower().replace(b"\n", b" ") for t, whole in zip(part, special)]
            apart = pc.replace_substring_regex(pa.array(plain, pa.large_binary()).cast(pa.large_string()), SIGNED, r"\1 \2\3")
            cut = pc.split_pattern(apart.cast(pa.large_binary()), b" ")
            coded = cut.values.dictionary_encode()
            # no word holds a blank, and one split is faster than a value at a time
            distinct = pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary)
            words = pc.binary_join(distinct, pa.scalar(b" ", pa.large_binary()))[0].as_py().split(b" ")
            ids = list(map(self.known.get, words))
            unseen = [i for i, found in enumerate(ids) if found is None]
            self._learn([words[i] for i in unseen])
            for i in unseen:
                ids[i] = self.known[words[i]]
            # each word's ids are copied to its places
            code, edges = coded.indices.to_numpy(), cut.offsets.to_numpy()
            sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            begins = (np.cumsum(sizes) - sizes)[code]
            sizes = sizes[code]
            ends = np.concatenate(([0], np.cumsum(sizes)))
            places = np.arange(ends[-1]) + np.repeat(begins - ends[:-1], sizes)
            raw = np.frombuffer(b"".join(ids), np.uint32)[places].tobytes()
            bounds = (4 * ends[edges]).tolist()
            for text, whole, a, b in zip(part, special, bounds[:-1], bounds[1:]):
                out.append(_encoded(self.whole, [text.decode()])[0] if whole else raw[a:b])
        return out


def _encoded(tokenizer, texts: list[str]) -> list[bytes]:
    return [array("I", x.ids).tobytes() for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


@cache
def word_encoder(path: str) -> WordEncoder:
    """One encoder for each Python worker, so that its words outlive a task; tasks are the parallel part."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return WordEncoder(path)


def _apart(at: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Which of the ascending places to take so that no two are neighbours, heavier ones first; neighbours differ in weight."""
    chosen = np.zeros(len(at), bool)
    left = np.arange(len(at))
    while len(left):
        near, w = np.diff(at[left]) == 1, weight[left]
        wins = np.concatenate(([True], ~near | (w[1:] > w[:-1]))) & np.concatenate((~near | (w[:-1] > w[1:]), [True]))
        chosen[left[wins]] = True
        beside = np.zeros(len(left), bool)
        beside[1:] |= near & wins[:-1]
        beside[:-1] |= near & wins[1:]
        left = left[~(wins | beside)]
    return chosen


def _every_other(at: np.ndarray, same: np.ndarray) -> np.ndarray:
    """False for every second place in a run of neighbouring pairs of one symbol, which overlap."""
    out = np.ones(len(at), bool)
    follows = np.flatnonzero((np.diff(at) == 1) & same[1:] & same[:-1]) + 1
    if len(follows):
        number = np.arange(len(follows))
        begins = np.maximum.accumulate(np.where(np.diff(follows, prepend=-1) == 1, 0, number))
        out[follows] = (number - begins) % 2 == 1
    return out


def _counted(code: np.ndarray, least: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, inverse, counts) of numbers from 0 on that occur ``least`` times, -1 as the inverse of others.

    Number and place are sorted as one if they fit.
    """
    bits = len(code).bit_length()
    if int(code.max(initial=0)).bit_length() + bits > 62:
        places = np.argsort(code, kind="stable")
        ordered = code[places]
    else:
        both = np.sort(code << bits | np.arange(len(code)))
        ordered = both >> bits
        places = both & ((1 << bits) - 1)
    heads = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])[: len(code)])
    counts = np.diff(np.append(heads, len(code)))
    often = counts >= least
    values, each = ordered[heads[often]], counts[often]
    pair = np.full(len(code), -1, np.int32)
    pair[places[np.repeat(often, counts)]] = np.repeat(np.arange(len(values), dtype=np.int32), each)
    return values, pair, each


def compress(ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, int, np.ndarray, np.ndarray]:
    """(symbols, starts, base, rules, lengths) of one block of documents."""
    symbols = ids.astype(np.int64)
    base = int(symbols.max(initial=0)) + 1
    rules, lengths = [], [np.ones(base, np.int64)]
    flags = np.full(len(symbols), _LOOK, np.uint8)  # pairs to count, by their left symbol
    flags[starts[1:] - 1] |= _LAST  # the last symbol of a document
    width = base
    while len(symbols) > 1:
        at = np.flatnonzero(flags[:-1] == _LOOK)
        code = symbols[at] * width + symbols[at + 1]
        # rare pairs share few bins: most of them go before anything is sorted
        bins = (code.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(46)).view(np.int64)
        often = (np.bincount(bins, minlength=_BINS) >= LEAST_COUNT)[bins]
        at, code = at[often], code[often]
        again = at
        once = _every_other(at, symbols[at] == symbols[at + 1])
        at, code = at[once], code[once]
        values, pair, counts = _counted(code, LEAST_COUNT)
        good = np.flatnonzero(pair >= 0)
        at, pair = at[good], pair[good]
        # each pair has a weight of its own, so the most frequent one is replaced wherever it stands
        rank = np.empty(len(values), np.int64)
        rank[np.argsort(counts, kind="stable")] = np.arange(len(values))
        taken = _apart(at, rank[pair])
        pays = np.bincount(pair[taken], minlength=len(values)) >= LEAST_COUNT
        if not pays.any():
            break
        taken &= pays[pair]
        number = width + np.cumsum(pays) - 1
        new = np.stack([values[pays] // width, values[pays] % width], axis=1)
        known = np.concatenate(lengths)
        lengths.append(known[new[:, 0]] + known[new[:, 1]])
        rules.append(new)
        flags &= _LAST
        flags[again] |= _LOOK
        where = at[taken]
        symbols[where] = number[pair[taken]]
        flags[where] = flags[where + 1] & _LAST | _LOOK
        flags[np.maximum(where - 1, 0)] |= _LOOK
        keep = np.ones(len(symbols), bool)
        keep[where + 1] = False
        symbols, flags = symbols[keep], flags[keep]
        # a pair whose left symbol was swallowed to its left begins with the new symbol now
        width += len(new)
    ends = np.flatnonzero(flags & _LAST) + 1
    rules = np.concatenate(rules) if rules else np.empty((0, 2), np.int64)
    return symbols, np.concatenate(([0], ends)), base, rules, np.concatenate(lengths[1:]) if len(lengths) > 1 else np.empty(0, np.int64)


def _unfold(symbols: np.ndarray, base: int, rules: np.ndarray) -> np.ndarray:
    while len(symbols) and symbols.max() >= base:
        inner = symbols >= base
        out = np.empty(len(symbols) + int(inner.sum()), np.int64)
        at = np.arange(len(symbols)) + np.concatenate(([0], np.cumsum(inner)[:-1]))
        out[at] = symbols
        pairs = rules[symbols[inner] - base]
        out[at[inner]], out[at[inner] + 1] = pairs[:, 0], pairs[:, 1]
        symbols = out
    return symbols


def expand(symbols: np.ndarray, base: int, rules: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ids that symbols stand for: each rule in use is unfolded once, then copied to its places."""
    symbols = symbols.astype(np.int64)
    inner = symbols >= base
    if not inner.any():
        return symbols
    used, rank = np.unique(symbols[inner], return_inverse=True)
    flat = _unfold(used, base, rules)
    begin = np.concatenate(([0], np.cumsum(lengths[used - base])[:-1]))
    # terminals follow the unfolded rules, one place each
    source = np.empty(len(symbols), np.int64)
    source[inner] = begin[rank.reshape(-1)]
    source[~inner] = len(flat) + np.arange(int((~inner).sum()))
    pool = np.concatenate((flat, symbols[~inner]))
    size = np.ones(len(symbols), np.int64)
    size[inner] = lengths[symbols[inner] - base]
    ends = np.cumsum(size)
    return pool[np.arange(ends[-1]) + np.repeat(source - (ends - size), size)]


def ids_between(symbols: np.ndarray, base: int, rules: np.ndarray, lengths: np.ndarray, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a sequence, expanding only the symbols that hold them."""
    sizes = np.where(symbols < base, 1, 0).astype(np.int64)
    sizes[symbols >= base] = lengths[symbols[symbols >= base] - base]
    upto = np.cumsum(sizes)
    first, past = np.searchsorted(upto, start, "right"), np.searchsorted(upto, stop, "left") + 1
    skipped = int(upto[first - 1]) if first else 0
    return expand(symbols[first:past], base, rules, lengths)[start - skipped : stop - skipped]


_BLOCK = {
    "part": pa.int32(), "block": pa.int32(), "docs": pa.list_(pa.int64()), "starts": pa.binary(), "offsets": pa.binary(),
    "base": pa.int64(), "rules": pa.binary(), "lengths": pa.binary(), "symbols": pa.binary(),
}
_BLOCK_SQL = (
    "part int, block int, docs array<bigint>, starts binary, offsets binary, base bigint, "
    "rules binary, lengths binary, symbols binary"
)


def _packed(values: np.ndarray) -> bytes:
    return values.astype("<u4").tobytes()


def _numbers(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u4").astype(np.int64)


def write_store(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text", block_ids: int = BLOCK_IDS
) -> None:
    """Encode texts and write them as grammar blocks in ascending order of the key."""
    ordered = (
        docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
        .withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange("key", "_tie")
        .sortWithinPartitions("key", "_tie")
        .select(F.spark_partition_id().alias("part"), "key", "text")
    )
    end = np.array([end_id], np.uint32).tobytes()

    def blocks(batches):
        part, number, held, size = 0, 0, [], 0

        def block():
            raw = [np.frombuffer(ids, np.uint32) for _, ids in held]
            offsets = np.concatenate(([0], np.cumsum([len(r) for r in raw])))
            symbols, starts, base, rules, lengths = compress(np.concatenate(raw), offsets)
            return (
                part, number, [k for k, _ in held], _packed(starts), _packed(offsets), base,
                _packed(rules.ravel()), _packed(lengths), _packed(symbols),
            )

        encoder = word_encoder(tokenizer)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                part = batch.column(0)[0].as_py()
                texts = [raw or b"" for raw in utf8(batch.column(2))]
                for k, ids in zip(batch.column(1), encoder.encode_all(texts)):
                    held.append((k.as_py(), ids + end))
                    size += len(held[-1][1]) // 4
                    if size >= block_ids:
                        yield block()
                        number, held, size = number + 1, [], 0
        if held:
            yield block()

    ordered.mapInArrow(lambda b: in_parts(blocks(b), list(_BLOCK), list(_BLOCK.values()), 1), _BLOCK_SQL).write.parquet(path)


def read_store(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids) of every document in the files; start counts all ids before it."""
    stored = spark.read.schema(_BLOCK_SQL).parquet(path)
    # one narrow row for each block
    counts = stored.select("part", "block", "offsets").mapInArrow(_block_sizes, "part int, block int, n bigint")
    # blocks are numbered inside their part, and parts, of which there is one a task, among each other
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    parts = counts.groupBy("part").agg(F.sum("n").alias("n")).select("part", F.coalesce(F.sum("n").over(earlier), zero).alias("base_ids"))
    begins = settle(
        counts.withColumn("inside", F.coalesce(F.sum("n").over(inside), zero)).join(parts, "part")
        .select("part", "block", (F.col("inside") + F.col("base_ids")).alias("begin"))
    )

    def decode(batches):
        for batch in batches:
            column = {name: batch.column(name) for name in batch.schema.names}
            for i in range(batch.num_rows):
                symbols, offsets, rules, lengths = (
                    _numbers(column[c][i].as_buffer()) for c in ("symbols", "offsets", "rules", "lengths")
                )
                ids = expand(symbols, column["base"][i].as_py(), rules.reshape(-1, 2), lengths).astype("<u4").tobytes()
                begin = column["begin"][i].as_py()
                edges = offsets.tolist()
                for doc, a, b in zip(column["docs"][i].values.to_pylist(), edges[:-1], edges[1:]):
                    own = ids[4 * a : 4 * b]
                    yield doc, begin + a, b - a, crc32(own), own

    names = [key, "start", "n_tokens", "ids_crc32", "ids"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return stored.join(bounded_broadcast(begins, 40), ["part", "block"]).mapInArrow(
        lambda b: in_parts(decode(b), names, types, 2000),
        f"`{key}` bigint, start bigint, n_tokens bigint, ids_crc32 bigint, ids binary",
    )


def _block_sizes(batches):
    for batch in batches:
        n = [int(_numbers(raw.as_py())[-1]) for raw in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], names=["part", "block", "n"])


def store_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, key: str = "doc_id", text: str = "text") -> str:
    """Encode all texts, write them as grammar files in shared storage, and return the folder."""
    spark = docs.sparkSession
    path = f"{shared_dir(spark)}/repair-{uuid.uuid4().hex}"
    write_store(docs, path, tokenizer, end_id, key, text)
    gone_at_exit(spark, path)
    return path
