"""SentencePiece encoding by a Viterbi that an Aho-Corasick automaton drives, and decoding.

The automaton holds all ordinary pieces. As it passes over a text it reports, by
its output links, every piece that ends at a position, longest first; each one
relaxes the best score there, so one pass finds the split with the highest sum of
piece scores. Of equal sums the longer last piece wins. A character that no piece
covers becomes its UTF-8 bytes, at ten below the lowest piece score.

Texts are cut where no piece can reach across (before a run of blanks, around
characters that occur in no longer piece), which changes no result but lets each
task keep the encodings of the cuts it has seen, in ``CACHE_BYTES``; a cut of more
than ``LONGEST_KEPT`` characters is not kept.

As in the library, blanks become U+2581 and one is put before the text. Cases: a
null text has null ids and decodes to null; an empty text has no ids; U+2581 in a text
stands for a blank, so such a text comes back with blanks (``round_trip`` false).
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from changefeed.llm.common import utf8

BLANK = "▁"
CACHE_BYTES, LONGEST_KEPT = 32 * 1024 * 1024, 64
# What a kept cut takes besides its characters and ids, and bytes of text worked on together.
_ENTRY, _TOGETHER = 200, 1 << 20


class Pieces:
    """A piece vocabulary: (text, score) for ordinary pieces by id, and the ids of bytes."""

    def __init__(self, pieces: dict[int, tuple[str, float]], byte_ids: list[int]):
        self.automaton = ahocorasick.Automaton()
        for number, (piece, score) in pieces.items():
            self.automaton.add_word(piece, (len(piece), score, number))
        self.automaton.make_automaton()
        self.byte_ids = byte_ids
        self.fallback = min((s for _, s in pieces.values()), default=0.0) - 10.0
        self.raw = {number: piece.replace(BLANK, " ").encode() for number, (piece, _) in pieces.items()}
        self.raw |= {number: bytes([i]) for i, number in enumerate(byte_ids)}
        self.single = {p for p, _ in pieces.values() if len(p) == 1}
        longer = [p for p, _ in pieces.values() if len(p) > 1]
        inner = "".join(re.escape(c) for c in sorted({c for p in longer for c in p} - {BLANK}))
        crossing = any(BLANK in p.lstrip(BLANK) for p in longer)
        word = f"{BLANK}*[{inner}]+|{BLANK}+|." if inner else f"{BLANK}+|."
        self.cut = re.compile(".+" if crossing else word, re.DOTALL)
        self.known: dict[str, bytes] = {}
        self.held = 0  # bytes of the kept cuts

    def viterbi(self, text: str) -> list[int]:
        """Ids of the best split of a text in which blanks are already replaced."""
        size = len(text)
        best, back = [0.0] + [-np.inf] * size, [None] * (size + 1)
        if self.single.issuperset(text):
            # each character is a piece, and its score is above the fallback's
            for last, piece in self.automaton.iter(text):
                score = piece[1] + best[last + 1 - piece[0]]
                if score > best[last + 1]:
                    best[last + 1], back[last + 1] = score, piece
        else:
            done = 0  # positions up to here also have their fallback considered
            for last, piece in self.automaton.iter(text):
                self._fall_back(best, back, done, last)
                done = max(done, last)
                score = piece[1] + best[last + 1 - piece[0]]
                if score > best[last + 1]:
                    best[last + 1], back[last + 1] = score, piece
            self._fall_back(best, back, done, size)
        ids: list[int] = []
        at = size
        while at:
            length, _, number = back[at]
            if number is None:
                ids.extend(self.byte_ids[b] for b in reversed(text[at - 1].encode()))
            else:
                ids.append(number)
            at -= length
        return ids[::-1]

    def _fall_back(self, best: list, back: list, done: int, end: int) -> None:
        """Offer the positions after ``done`` up to ``end`` the character before them as bytes."""
        for at in range(done + 1, end + 1):
            score = best[at - 1] + self.fallback
            if score > best[at]:
                best[at], back[at] = score, (1, score, None)

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        known, out = self.known, []
        for cut in self.cut.findall(BLANK + text.replace(" ", BLANK)):
            ids = known.get(cut)
            if ids is None:
                ids = array("i", self.viterbi(cut)).tobytes()
                if len(cut) <= LONGEST_KEPT:
                    if self.held > CACHE_BYTES:
                        known.clear()
                        self.held = 0
                    known[cut] = ids
                    self.held += _ENTRY + 4 * len(cut) + len(ids)
            out.append(ids)
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids) -> str:
        raw = self.raw
        return b"".join([raw.get(i, b"") for i in ids]).decode("utf-8", "replace")[1:]


@cache
def load(model: str) -> Pieces:
    """The pieces of a SentencePiece model file, which every executor must have at this path."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    ordinary, byte_ids = {}, [0] * 256
    for i in range(sp.vocab_size()):
        if sp.is_byte(i):
            byte_ids[int(sp.id_to_piece(i)[3:5], 16)] = i
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            ordinary[i] = (sp.id_to_piece(i), sp.get_score(i))
    return Pieces(ordinary, byte_ids)


def _parts(batches, column: int):
    """Batches cut to about ``_TOGETHER`` bytes of text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes) // _TOGETHER
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
        for a, b in zip(edges[:-1], edges[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def round_trip(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, ids_crc32, decoded_sha256, round_trip): encoded, decoded and compared in one pass; texts stay behind.

    ids_crc32 is that of the ids as little-endian 32-bit numbers.
    """
    named = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = StructType([
        named.schema["key"], StructField("ids", ArrayType(IntegerType())), StructField("ids_crc32", LongType()),
        StructField("decoded_sha256", StringType()), StructField("round_trip", BooleanType()),
    ])

    def run(batches):
        pieces = load(model)
        for part in _parts(batches, 1):
            ids, sums, digests, same = [], [], [], []
            for raw in utf8(part.column(1)):
                found = None if raw is None else pieces.encode(raw.decode())
                back = None if found is None else pieces.decode(found.tolist()).encode()
                ids.append(found)
                sums.append(zlib.crc32(b"" if found is None else found.astype("<u4").tobytes()))
                digests.append(None if back is None else hashlib.sha256(back).hexdigest())
                same.append(back == raw)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(sums, pa.int64()),
                    pa.array(digests, pa.string()), pa.array(same, pa.bool_()),
                ],
                names=["key", "ids", "ids_crc32", "decoded_sha256", "round_trip"],
            )

    return named.mapInArrow(run, schema).withColumnRenamed("key", key)


def encode_pieces(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, ids): the piece ids of each text."""
    named = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = StructType([*named.schema.fields, StructField("ids", ArrayType(IntegerType()))])

    def run(batches):
        pieces = load(model)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                parts = [None if raw is None else pieces.encode(raw.decode()) for raw in utf8(batch.column(1))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(parts, pa.list_(pa.int32()))], names=["key", "text", "ids"]
                )

    return named.mapInArrow(run, schema).withColumnsRenamed({"key": key, "text": text})


def decode_pieces(encoded: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """Add ``decoded`` and ``ids_crc32``, the checksum of the ids as little-endian 32-bit numbers."""
    schema = StructType(
        [*encoded.schema.fields, StructField("decoded", StringType()), StructField("ids_crc32", LongType())]
    )

    def run(batches):
        pieces = load(model)
        for batch in batches:
            texts, sums = [], []
            for value in batch.column(ids):
                numbers = None if not value.is_valid else value.values.to_numpy()
                texts.append(None if numbers is None else pieces.decode(numbers.tolist()))
                sums.append(zlib.crc32(b"" if numbers is None else numbers.astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string()), pa.array(sums, pa.int64())],
                names=[*batch.schema.names, "decoded", "ids_crc32"],
            )

    return encoded.mapInArrow(run, schema)
