"""Packing of tokenized documents into sequences by shortest-pack-first over the length histogram.

A document is its token ids and one end id.  What is longer than a sequence is cut into full
sequences and a rest; each piece keeps its place, its length and a checksum of its ids.  The
pieces are counted by length.  From the longest length on, the copies of a length go to the packs
that hold least so far, as long as the length fits there; else packs are opened.  All packs of
one pattern are one entry with a count, so the work depends on the number of lengths and not on
the number of documents.  Each piece has a rank among the pieces of its length, and each pattern
takes a run of ranks of every length it holds: rank and length give sequence and offset.

Shortest packs first leaves little room in mixed lengths.  If more than `waste` of all places
would stay empty (say, if every document is a little longer than half a sequence), the rests are
cut into pieces of half the size and packed again, until they are so small that no such share
can stay empty.  Ids are never dropped or repeated.

Texts are tokenized in Arrow batches by way of their words: a task hands each distinct word to the
tokenizer once and remembers its ids.  No token of the vocabulary spans ASCII white space, or the
place where plain letters end and symbols begin, so that equals the reading of the whole text.  The vocabulary's file is read by the driver and travels with the tasks.

Ranks are counted in SALTS parts of each length, so a length that most pieces have (full ones)
meets in no single task.  What the driver holds is bounded by the number of lengths: the histogram
and the patterns' runs.

Defined results: null, empty and white texts are the end id alone; a null doc_id is packed like
any other; repeated rows are packed once each; very long texts are read in segments; an empty
table gives an empty result.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
import sys
import types
import zlib
from collections import defaultdict
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from marketweave.llm import tokens
from marketweave.session import shared_dir, stage

SIZE = 2048
END = 1
WASTE = 0.01  # share of empty places up to which the rests of documents stay whole
SALTS = 128
KNOWN = 1_000_000  # words whose ids a task remembers
_COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
_PIECE = "doc_id {}, start long, length long, ids_crc32 long, doc_tokens long"


# Letters whose lower case and composition are themselves (of ASCII, and of the two
# bytes that start with C3), then symbols that open no contraction and no name of a special token.
_MARKS = rb"([!-&(-/:-@\[-`{}~]*)"
_ASCII = re.compile(rb"([a-z]*)" + _MARKS)
_PLAIN = re.compile(rb"((?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])*)" + _MARKS)


def _visible() -> dict[int, str]:
    """The vocabulary's character for each byte: printable ones stand for themselves, the others
    are numbered from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def _remembered(key: str) -> dict[bytes, bytes]:
    """Ids of words by word.  Spark's Python workers take task after task, and what one task learns
    serves the next, so this outlives the functions that come with each task."""
    return sys.modules.setdefault("_ids_of_words", types.ModuleType("_ids_of_words")).__dict__.setdefault(key, {})


class Ids:
    """Token ids of texts, by way of their distinct words."""

    _VISIBLE = _visible()

    def __init__(self, vocabulary: str, special_text: bool = True):
        self._tokenizer = Tokenizer.from_str(vocabulary)
        self._tokenizer.encode_special_tokens = not special_text
        self._model = self._tokenizer.model
        self._known = _remembered(f"{hashlib.sha256(vocabulary.encode()).hexdigest()} {special_text}")

    def _read(self, words: list[bytes]) -> list[bytes]:
        found = self._tokenizer.encode_batch([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)
        return [struct.pack(f"<{len(r.ids)}I", *r.ids) for r in found]

    def _learn(self, words: set[bytes]) -> None:
        known, tokenize, rest = self._known, self._model.tokenize, []
        for word in words:
            plain = _ASCII.fullmatch(word) or _PLAIN.fullmatch(word)
            if not plain:
                rest.append(word)
                continue
            letters, marks = plain.groups()
            ids = known.get(letters)
            if ids is None:  # a run of plain letters is one word to the tokenizer
                shown = letters.decode() if letters.isascii() else "".join(map(self._VISIBLE.__getitem__, letters))
                found = tokenize(shown) if shown else []
                ids = known[letters] = struct.pack(f"<{len(found)}I", *[t.id for t in found])
            if marks:
                if marks not in known:
                    known[marks] = self._read([marks])[0]
                known[word] = ids + known[marks]
        known.update(zip(rest, self._read(rest)))

    def of(self, text: bytes) -> bytes:
        """The ids of a text, four bytes each."""
        # Case is no matter to the vocabulary, but it is to the names of special tokens.
        words = (text if b"<|" in text else text.lower()).split()
        found = list(map(self._known.get, words))
        if None in found:
            if len(self._known) > KNOWN:
                self._known.clear()
                found = [None] * len(words)
            self._learn({w for w, ids in zip(words, found) if ids is None})
            found = map(self._known.__getitem__, words)
        return b"".join(found)


def cuts(total: int, size: int, largest: int) -> list[int]:
    """Lengths of the pieces of a document: full sequences, then a rest in pieces of `largest` at most."""
    rest = total % size
    return [size] * (total // size) + [largest] * (rest // largest) + ([rest % largest] if rest % largest else [])


def _cut(batches, vocabulary: str, size: int, largest: int, special_text: bool):
    ids = Ids(vocabulary, special_text)
    end = struct.pack("<I", END)
    for batch in batches:
        for part in tokens.chunks(batch):
            rows = []
            for row, text in enumerate(part.column("text")):
                # Full pieces leave as they fill; the rest is carried on to the next segment.
                carry, full = b"", []
                for segment in tokens.segments((text.as_py() or "").encode()):
                    carry += ids.of(segment)
                    whole = len(carry) // (4 * size) * 4 * size
                    full += [zlib.crc32(carry[i : i + 4 * size]) for i in range(0, whole, 4 * size)]
                    carry = carry[whole:]
                carry += end
                total = len(full) * size + len(carry) // 4
                rows += [(row, i * size, size, crc, total) for i, crc in enumerate(full)]
                at = 0
                for n in cuts(len(carry) // 4, size, largest):
                    rows.append((row, len(full) * size + at, n, zlib.crc32(carry[4 * at : 4 * (at + n)]), total))
                    at += n
            rows = np.array(rows, np.int64).reshape(-1, 5)
            names = part.column("doc_id").take(pa.array(rows[:, 0]))
            yield pa.RecordBatch.from_arrays([names, *(pa.array(rows[:, i]) for i in range(1, 5))], list(_COLUMNS[:5]))


def pieces(docs: DataFrame, vocabulary: str, size: int = SIZE, largest: int | None = None, special_text: bool = True) -> DataFrame:
    """`doc_id, start, length, ids_crc32, doc_tokens` of each piece; `vocabulary` is the tokenizer's JSON text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    work = partial(_cut, vocabulary=vocabulary, size=size, largest=largest or size, special_text=special_text)
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(work, _PIECE.format(kind))


def patterns(histogram: dict[int, int], size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """Each packing pattern (lengths, longest first) and how many packs have it."""
    held: dict[int, list] = defaultdict(list)  # by total: patterns as linked lists, and counts
    totals: list[int] = []

    def put(total: int, pattern, count: int) -> None:
        if not held[total]:
            heapq.heappush(totals, total)
        held[total].append((pattern, count))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            while totals and not held[totals[0]]:
                heapq.heappop(totals)
            if totals and totals[0] + length <= size:
                total = totals[0]
                pattern, count = held[total].pop()
                taken = min(left, count)
                if count > taken:
                    held[total].append((pattern, count - taken))
                put(total + length, (length, pattern), taken)
                left -= taken
            else:
                # A new pack is the shortest one until it is full, so it takes the next copies too.
                each = min(left, size // length)
                pattern = None
                for _ in range(each):
                    pattern = (length, pattern)
                put(each * length, pattern, left // each)
                left %= each
    out = []
    for total in sorted(held, reverse=True):
        for pattern, count in held[total]:
            lengths = []
            while pattern:
                lengths.append(pattern[0])
                pattern = pattern[1]
            out.append((tuple(reversed(lengths)), count))
    return out


def runs(found: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """A row per pattern and length in it, sorted: length, first rank, first sequence, copies, offset."""
    rows, used, sequence = [], defaultdict(int), 0
    for lengths, count in found:
        offset = 0
        for length in dict.fromkeys(lengths):
            copies = lengths.count(length)
            rows.append((length, used[length], sequence, copies, offset))
            used[length] += copies * count
            offset += copies * length
        sequence += count
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _place(batches, table: np.ndarray):
    keys = (table[:, 0] << 44) + table[:, 1]
    for batch in batches:
        length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
        run = table[np.searchsorted(keys, (length << 44) + rank, side="right") - 1] if len(length) else table[:0]
        sequence, slot = np.divmod(rank - run[:, 1], np.maximum(1, run[:, 3]))
        kept = [batch.column(c) for c in _COLUMNS[:5]]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(run[:, 2] + sequence), pa.array(run[:, 4] + slot * length)], list(_COLUMNS))


def pack(docs: DataFrame, path: str, size: int = SIZE, waste: float = WASTE, special_text: bool = True) -> DataFrame:
    """The pieces of all documents with `sequence_id` and `offset`.

    `path` names the tokenizer's file on the driver.  With `special_text` the names of special
    tokens in a text are those tokens, as the tokenizer reads them by default.
    """
    root = shared_dir(docs.sparkSession)
    with open(path, encoding="utf-8") as file:
        vocabulary = file.read()
    largest = size
    while True:
        cut = stage(pieces(docs, vocabulary, size, largest, special_text), f"pieces_{largest}", root)
        # Rows of a table on disk keep their order, so a number by place stays what it is in a task that runs again.
        cut = cut.withColumn("_row", F.monotonically_increasing_id()).withColumn("_salt", F.pmod("_row", F.lit(SALTS)))
        counts = stage(cut.groupBy("length", "_salt").count(), f"counts_{largest}", root)
        histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
        found = patterns(histogram, size)
        places = size * sum(count for _, count in found)
        filled = sum(length * n for length, n in histogram.items())
        if places - filled <= max(size, waste * places) or largest <= max(1, waste * size):
            break
        largest = max(1, largest // 2)
    earlier = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    # At most `size` lengths in SALTS parts: a bounded table.
    first = counts.select("length", "_salt", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_first"))
    inside = F.row_number().over(Window.partitionBy("length", "_salt").orderBy("_row"))
    ranked = cut.withColumn("_inside", inside).join(F.broadcast(first), ["length", "_salt"])
    ranked = ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("_first") + F.col("_inside") - 1).cast("long").alias("rank"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return ranked.mapInArrow(partial(_place, table=runs(found)), _PIECE.format(kind) + ", sequence_id long, offset long")
