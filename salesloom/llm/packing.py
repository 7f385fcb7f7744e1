"""Documents as tokens, packed into sequences of one length by first-fit decreasing.

Documents are cut where a sequence ends, so a long one fills sequences by itself and only its rest
is packed. Pieces are dealt into randomised groups of bounded size and each group is packed on its
own, which needs one shuffle of lengths and no knowledge of other groups.
"""

import os
from collections.abc import Iterator
from functools import cache
from itertools import chain, repeat
from os.path import commonprefix

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel, Sequence, Split

from salesloom import scratch
from salesloom.llm.batches import small_batches

PIECES = "doc_id {id}, start bigint, length bigint, ids binary, doc_tokens bigint"
# What the vocabulary's own splitting takes as one unit.
UNIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
UNIT_OR_END = regex.compile(UNIT.pattern + r"|\n")
_BYTES = np.arange(256)
_LETTER = (_BYTES >= ord("a")) & (_BYTES <= ord("z"))
_SIGN = (_BYTES > 32) & (_BYTES < 127) & ~_LETTER & ~((_BYTES >= ord("0")) & (_BYTES <= ord("9")))


class Remembered:
    """Keys with a run of token ids each, all runs in one array."""

    def __init__(self):
        self.slot: dict = {}
        self.sizes = np.zeros(1 << 16, np.int64)
        self.places = np.zeros(1 << 16, np.int64)
        self.store = np.zeros(1 << 18, np.uint32)
        self.used = 0

    def add(self, keys: list, sizes: np.ndarray, ids: np.ndarray) -> None:
        first, last = len(self.slot), len(self.slot) + len(keys)
        while last > len(self.sizes):
            self.sizes = np.concatenate([self.sizes, np.zeros_like(self.sizes)])
            self.places = np.concatenate([self.places, np.zeros_like(self.places)])
        while self.used + len(ids) > len(self.store):
            self.store = np.concatenate([self.store, np.zeros_like(self.store)])
        self.sizes[first:last] = sizes
        self.places[first:last] = self.used + np.cumsum(sizes) - sizes
        self.store[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.slot.update(zip(keys, range(first, last)))

    def find(self, keys: list) -> np.ndarray:
        """Slots of the keys, -1 for unknown ones."""
        return np.fromiter(map(self.slot.get, keys, repeat(-1)), np.int64, len(keys))

    def runs(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sizes of the slots' runs, and the runs one after the other."""
        sizes = self.sizes[slots]
        ends = np.cumsum(sizes)
        if not len(ends):
            return sizes, np.empty(0, np.uint32)
        at = np.repeat(self.places[slots] - (ends - sizes), sizes)
        at += np.arange(len(at))
        return sizes, self.store[at]


class WordTokenizer:
    """Token ids of texts for a vocabulary that drops white space, equal to encoding them whole.

    White space never lies inside a token, so a text is the sequence of its chunks. Chunks and the
    units in them are remembered, up to ``room`` each, and a worker keeps what it remembers from one
    batch to the next. Chunks with letters beyond the Latin blocks or with special tokens go to the
    tokenizer as they are.
    """

    def __init__(self, file: str, room: int = 250_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks fill the cores already
        self.whole = Tokenizer.from_file(file)
        self.bare = Tokenizer(self.whole.model)
        as_bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        self.bare.pre_tokenizer = Sequence([Split("\n", "removed"), as_bytes])
        suffix = getattr(self.whole.model, "end_of_word_suffix", None)
        self.ends_unit = np.zeros(1 + max(self.whole.get_vocab().values()), bool)
        if suffix:
            self.ends_unit[[i for t, i in self.whole.get_vocab().items() if t.endswith(suffix)]] = True
        special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.mark = commonprefix(special)  # empty without special tokens or if they differ at once
        self.guard = bool(special)
        self.room = room
        self.units, self.chunks = Remembered(), Remembered()

    def _encoded(self, tokenizer: Tokenizer, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return sizes, np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum()))

    def _encoded_units(self, units: list[str], run: int = 1000) -> tuple[np.ndarray, np.ndarray]:
        """As ``_encoded`` by ``bare``, many units in one text. A vocabulary that marks the last token
        of a unit tells where each one ends; if the ends are not as many as the units, or it has no
        such mark, they are encoded one by one.
        """
        lines = ["\n".join(units[i : i + run]) for i in range(0, len(units), run)]
        found = [e.ids for e in self.bare.encode_batch_fast(lines, add_special_tokens=False)]
        ids = np.concatenate([np.empty(0, np.uint32), *(np.array(f, np.uint32) for f in found)])
        ends = np.flatnonzero(self.ends_unit[ids]) + 1
        if len(ends) != len(units) or (len(ends) and ends[-1] != len(ids)):
            return self._encoded(self.bare, units)
        return np.diff(ends, prepend=0), ids

    def _is_plain(self, text: str) -> bool:
        return (text.isascii() or max(text) < "ɐ") and not (self.guard and self.mark in text)

    def _learn(self, chunks: list[bytes]) -> None:
        text, odd = b"\n".join(chunks).decode("utf-8", "replace"), []
        if not self._is_plain(text):
            each = text.split("\n")
            odd = [i for i, t in enumerate(each) if not self._is_plain(t)]
            self.chunks.add([chunks[i] for i in odd], *self._encoded(self.whole, [each[i] for i in odd]))
            left = sorted(set(range(len(chunks))).difference(odd))
            chunks, text = [chunks[i] for i in left], "\n".join(each[i] for i in left)
        if not chunks:
            return
        # Line ends part the chunks; they are a unit without ids.
        units = UNIT_OR_END.findall(text.lower() + "\n")
        slots = self.units.find(units)
        if (slots < 0).any():
            new = list({units[i] for i in np.flatnonzero(slots < 0)} - {"\n"})
            if len(self.units.slot) + len(new) > self.room:
                self.units = Remembered()
                new = list(set(units) - {"\n"})
            if not self.units.slot:
                self.units.add(["\n"], np.zeros(1, np.int64), np.empty(0, np.uint32))
            self.units.add(new, *self._encoded_units(new))
            slots = self.units.find(units)
        sizes, ids = self.units.runs(slots)
        ends = np.cumsum(sizes)[slots == self.units.slot["\n"]]
        self.chunks.add(chunks, np.diff(ends, prepend=0), ids)

    def _split(self, text: bytes) -> list[bytes]:
        if self.guard and self.mark.encode() in text:
            return text.split()
        # A unit ends between a letter and a sign in any case; cut there, fewer distinct chunks are
        # left to remember.
        lower = np.frombuffer(text.lower(), np.uint8)
        ends = np.flatnonzero(_LETTER[lower[:-1]] & _SIGN[lower[1:]])
        return np.insert(lower, ends + 1, ord(" ")).tobytes().split()

    def encode(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """Ids of each text in turn."""
        for at in range(0, len(texts), 64):
            split = [self._split(t) for t in texts[at : at + 64]]
            chunks = list(chain.from_iterable(split))
            slots = self.chunks.find(chunks)
            unknown = np.flatnonzero(slots < 0)
            if len(unknown):
                new = list({chunks[i] for i in unknown})
                if len(self.chunks.slot) + len(new) > self.room:
                    self.chunks = Remembered()
                    new = list(set(chunks))
                    unknown = np.arange(len(chunks))
                self._learn(new)
                slots[unknown] = self.chunks.find([chunks[i] for i in unknown])
            sizes, ids = self.chunks.runs(slots)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            cuts = ends[np.cumsum([0, *map(len, split)])]
            yield from (ids[lo:hi] for lo, hi in zip(cuts, cuts[1:]))


@cache
def _tokenizer(file: str) -> WordTokenizer:
    return WordTokenizer(file)


def tokenize(
    docs: DataFrame,
    file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 4096,
    end_id: int = 2,
) -> DataFrame:
    """Pieces ``(doc_id, start, length, ids, doc_tokens)`` of at most ``capacity`` tokens.

    A document is its ids and ``end_id``; null is empty, so it is the end alone. ``ids`` holds
    little-endian unsigned 32-bit numbers. Repeated rows are separate documents. Other columns are
    left out. ``file`` is read on the executors.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    schema = PIECES.format(id=kind.simpleString())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(file)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                source, start, length, ids, total = [], [], [], [], []
                texts = [t or b"" for t in part.column(1).to_pylist()]
                for row, found in enumerate(tokenizer.encode(texts)):
                    tokens = np.append(found, np.uint32(end_id)).astype("<u4")
                    for first in range(0, len(tokens), capacity):
                        piece = tokens[first : first + capacity]
                        source.append(row)
                        start.append(first)
                        length.append(len(piece))
                        ids.append(piece.tobytes())
                        total.append(len(tokens))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(source, pa.int64())),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.array(total, pa.int64()),
                    ],
                    names=["doc_id", "start", "length", "ids", "doc_tokens"],
                )

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return texts.mapInArrow(cut, schema)


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length: the longest first, each into the first bin with room.

    A tournament tree over the bins holds the most room below each node, so the first bin with
    enough is found by going down from the root, left where the left side has room.
    """
    n = len(lengths)
    leaves = 1 << max(0, n - 1).bit_length()
    room = [capacity] * (2 * leaves)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for piece in np.argsort(-lengths, kind="stable").tolist():
        need, node = int(lengths[piece]), 1
        while node < leaves:
            node *= 2
            if room[node] < need:
                node += 1
        bins[piece], offsets[piece] = node - leaves, capacity - room[node]
        room[node] -= need
        node //= 2
        while node:
            most = max(room[2 * node], room[2 * node + 1])
            if room[node] == most:
                break
            room[node] = most
            node //= 2
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = 4096, group_pieces: int = 4096) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; all other columns stay.

    Needs ``doc_id``, ``start`` and ``length`` (1 to ``capacity``). A sequence has no gaps. Groups
    are as many as give ``group_pieces`` pieces each on average, so a task's memory is bounded and
    every group leaves about one sequence part full. An empty table gives an empty result.

    Rows are stored with a number first and dealt by it, so that repeated or null ids, and even rows
    equal in all columns, spread like any other.
    """
    stored = pieces.withColumn("_row", F.monotonically_increasing_id())
    pieces = scratch.materialize(stored, "pieces")
    groups = max(1, -(-pieces.count() // group_pieces))
    dealt = pieces.withColumn(
        "sequence_id", F.pmod(F.xxhash64("_row", F.lit("packing")), F.lit(groups))
    )
    fields = [f for f in dealt.schema.fields if f.name != "_row"]
    schema = T.StructType([*fields, T.StructField("offset", T.LongType())])

    def fill(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "start", "_row"], ignore_index=True)
        bins, offsets = first_fit_decreasing(group["length"].to_numpy(), capacity)
        first = group["sequence_id"].to_numpy() << 32
        return group.drop(columns="_row").assign(sequence_id=first + bins, offset=offsets)

    return dealt.groupBy("sequence_id").applyInPandas(fill, schema)


def packed_digests(docs: DataFrame, file: str) -> DataFrame:
    """Where each piece of each document lies, with a checksum of its ids in their place."""
    pieces = tokenize(docs, file).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(pieces)
