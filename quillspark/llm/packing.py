"""Bounded-space online best-fit packing of tokenized documents into sequences of fixed capacity.

A task keeps at most ``open_bins`` unfinished sequences. They are kept by free space: a bitset has one bit per amount of free space, so the
tightest sequence that still takes a piece is the lowest set bit at or above the piece's length. When a further sequence must be opened while
all places are taken, the fullest one closes.

Edge cases: a null or empty text is the end token alone. A text of more than ``capacity`` tokens is cut from its end into whole sequences, so
that only its first piece may be shorter. Rows with a null or repeated id are packed like any other row. Other columns of the input are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import as_table, small_batches, stored, tasks_for

CAPACITY = 1024
OPEN_BINS = 4096
PIECES_PER_TASK = 1_000_000
CACHED_WORDS = 400_000
BESIDE_SPACE = re.compile(r"\s | \s")


class WordIds(dict):
    """Token ids, as little-endian unsigned 32-bit bytes, of texts that begin where the tokenizer's words begin."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        stand_ins = byte_characters(pre_tokenizers)
        ranks = {bytes(stand_ins[c] for c in token): i for token, i in spec["model"]["vocab"].items()
                 if all(c in stand_ins for c in token) and token not in self.special}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.words = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, word: str) -> bytes:
        ids = np.asarray(self.words.encode_ordinary(word), dtype="<u4").tobytes()
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a whole text. A space between two other characters always begins a word, so such words are looked up one by one."""
        if any(s in text for s in self.special):
            return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if BESIDE_SPACE.search(text) or text.startswith(" ") or text.endswith(" "):
            return np.asarray(self.words.encode_ordinary(text), dtype="<u4").tobytes()
        first, *rest = text.split(" ")
        return self[first] + b"".join([self[" " + w] for w in rest])


def byte_characters(pre_tokenizers) -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1 for itself, the rest from U+0100 on in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    chars = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}
    if set(chars) != set(pre_tokenizers.ByteLevel.alphabet()):
        raise ValueError("the tokenizer's byte alphabet is not the usual one")
    return chars


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 2, id_column: str = "doc_id",
                     text_column: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row per piece; with ``keep_ids`` also its token ids."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
                       + ([("ids", pa.list_(pa.int32()))] if keep_ids else []))
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = WordIds(tokenizer_path)
        for batch in small_batches(batches, "text"):
            out = {f.name: [] for f in schema}
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = vocabulary.encode(text or "") + end
                total = len(ids) // 4
                stop = (total - 1) % capacity + 1
                start = piece = 0
                while start < total:
                    held = ids[4 * start:4 * stop]
                    out["doc_id"].append(doc)
                    out["piece"].append(piece)
                    out["start"].append(start)
                    out["length"].append(stop - start)
                    out["ids_crc32"].append(zlib.crc32(held))
                    if keep_ids:
                        out["ids"].append(np.frombuffer(held, dtype="<i4"))
                    start, stop, piece = stop, stop + capacity, piece + 1
            yield as_table(out, schema)

    wanted = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return wanted.mapInArrow(rows, PIECES + (", ids array<int>" if keep_ids else ""))


class OpenBins:
    """The open sequences of one task, kept by free space."""

    def __init__(self, capacity: int, places: int):
        self.capacity, self.places = capacity, places
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits = self.held = self.opened = 0

    def take(self, free: int) -> int:
        stack = self.by_free[free]
        bin_ = stack.pop()
        if not stack:
            self.bits &= ~(1 << free)
        self.held -= 1
        return bin_

    def place(self, length: int) -> tuple[int, int]:
        """The sequence and the offset that a piece gets."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            bin_ = self.take(free)
        else:
            free, bin_ = self.capacity, self.opened
            self.opened += 1
            if self.held == self.places:
                self.take((self.bits & -self.bits).bit_length() - 1)
        left = free - length
        if left:
            self.by_free[left].append(bin_)
            self.bits |= 1 << left
            self.held += 1
        return bin_, self.capacity - free


def best_fit(pieces: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, pieces_per_task: int = PIECES_PER_TASK) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to ``capacity``.

    The pieces are stored first: a task that is run again sees the same rows in the same order. Each packing task takes up to about
    ``pieces_per_task`` pieces, in runs of about twice ``open_bins`` pieces by hash, each run from long to short; only the last open sequences of a
    task stay partly empty.
    """
    kept = stored(pieces, "pieces")
    count = kept.count()
    tasks = tasks_for(count, pieces_per_task)
    run = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(tasks_for(count // tasks, 2 * open_bins)))
    columns = kept.columns
    schema = T.StructType([*kept.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        bins = OpenBins(capacity, open_bins)
        for batch in batches:
            places = [bins.place(n) for n in batch.column("length").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([base + b for b, _ in places], pa.int64()), pa.array([o for _, o in places], pa.int64())],
                names=[*columns, "sequence_id", "offset"])

    dealt = kept.repartition(tasks).sortWithinPartitions(run, F.desc("length"), "doc_id", "piece", "ids_crc32")
    return dealt.mapInArrow(rows, schema)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 2, open_bins: int = OPEN_BINS, keep_ids: bool = False,
         id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Tokenize and pack; one row per piece with its sequence and the offset there, gapless from 0 in every sequence."""
    return best_fit(tokenized_pieces(docs, tokenizer_path, capacity, end_id, id_column, text_column, keep_ids), capacity, open_bins)
