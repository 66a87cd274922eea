"""Packing of tokenised documents into fixed-length sequences, best fit first.

A document's ids are those of the vocabulary file without added special tokens, then one end id. Documents of
more than a window are cut into full windows, which are sequences of their own, and a rest. Rests go into groups of
bounded size; a group packs them in decreasing length, each into the fullest sequence that still has room, found by a
segment tree indexed by remaining capacity. Groups are independent tasks, so no task sees the whole table, and a lost
one repeats alone. With thousands of pieces in a group, only its last few sequences have gaps.

A null or empty text is the end id alone. Rows count one by one: repeated rows and ids are all packed. Ties in length go
by document id and start. Extra columns are dropped, so their names cannot clash. An empty table gives an empty table.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlake.llm.words import Words, slices

WINDOW = 4096
GROUP_PIECES = 4096
CACHE_ENTRIES = 1_500_000
MARK = "~"
MARKED_WORDS = 500
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
PACKED = f"{PIECES}, sequence_id bigint, offset bigint"


def split_punctuation(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word bounds with a full stop or comma after an ASCII letter as a word of its own, which it is to the vocabulary."""
    last, before = words.data[words.ends - 1], words.data[np.maximum(words.ends - 2, 0)] | 0x20
    cut = ((last == ord(".")) | (last == ord(","))) & (words.ends - words.starts > 1) & (before >= ord("a")) & (before <= ord("z"))
    at, marks = np.flatnonzero(cut) + 1, words.ends[cut] - 1
    starts = np.insert(words.starts, at, marks)
    ends = np.insert(words.ends - cut, at, marks + 1)
    return starts, ends, words.first + np.concatenate([[0], np.cumsum(cut)])[words.first]


class WordIds:
    """Ids by white-space separated word, from the library, kept for the words met before.

    The vocabulary drops white space and no token spans it, so a text's ids are those of its words in turn.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.mark_ids = self.ids(MARK)

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def learn(self, words: list[bytes]) -> None:
        """Ids of new words, many in one text with a mark between them; a word that holds the mark goes alone."""
        joined = [w for w in words if MARK.encode() not in w]
        for at in range(0, len(joined), MARKED_WORDS):
            part = joined[at : at + MARKED_WORDS]
            ids = self.ids(f" {MARK} ".join([w.decode() for w in part]))
            marks = np.flatnonzero(ids == self.mark_ids[0])
            if len(self.mark_ids) != 1 or len(marks) != len(part) - 1:
                words = [*words, *part]
                continue
            raw, bounds = ids.tobytes(), (4 * marks).tolist()
            ends = [*bounds, len(raw)]
            starts = [0, *[b + 4 for b in bounds]]
            self.known.update((w, raw[a:b]) for w, a, b in zip(part, starts, ends, strict=True))
        for w in words:
            if w not in self.known:
                self.known[w] = self.ids(w.decode()).tobytes()

    def texts(self, column: pa.Array) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text.

        The distinct words of the column, told apart by a 64-bit hash, are looked up; their ids are then laid out by array
        operations.
        """
        if len(self.known) > CACHE_ENTRIES:
            self.known.clear()
        words = Words(column)
        words.starts, words.ends, words.first = split_punctuation(words)
        raw = words.data.tobytes()
        lower = b"<|" not in raw  # special strings are matched by case, everything else in lower case
        if lower:
            raw = raw.lower()
        _, at, which = np.unique(words.hashes(lower), return_index=True, return_inverse=True)
        spans = [raw[a:b] for a, b in zip(words.starts[at].tolist(), words.ends[at].tolist(), strict=True)]
        known = self.known
        self.learn([w for w in spans if w not in known])
        encoded = [known[w] for w in spans]
        lengths = np.array([len(e) >> 2 for e in encoded], np.int64)
        vocabulary = np.frombuffer(b"".join(encoded), "<u4")
        begins = np.cumsum(lengths) - lengths
        counts = lengths[which]
        total = np.concatenate([[0], np.cumsum(counts)])
        flat = vocabulary[np.repeat(begins[which] - total[:-1], counts) + np.arange(total[-1])]
        bounds = total[words.first].tolist()
        for a, b in zip(bounds, bounds[1:], strict=False):
            yield flat[a:b].tobytes()


@cache
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def token_pieces(docs: DataFrame, vocabulary: str, end_id: int = 2, window: int = WINDOW) -> DataFrame:
    """Full windows and rests of each document, with the checksum of their ids; one pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        library = word_ids(vocabulary)
        end = np.array([end_id], "<u4").tobytes()
        row_number = 0
        for batch in slices(batches):
            rows: list[tuple] = []
            ids = library.texts(batch.column("text"))
            for doc_id, encoded in zip(batch.column("doc_id").to_pylist(), ids, strict=True):
                encoded += end
                total = len(encoded) // 4
                for start in range(0, total, window):
                    piece = encoded[4 * start : 4 * (start + window)]
                    rows.append((doc_id, start, len(piece) // 4, zlib.crc32(piece), total, row_number))
                row_number += 1
            frame = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "row_number"])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield pa.RecordBatch.from_pandas(frame, schema=schema, preserve_index=False)

    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "row_number")])
    return docs.select("doc_id", "text").mapInArrow(run, f"{PIECES}, row_number bigint")


class OpenWindows:
    """Sequences with room, in a segment tree over remaining capacity; finds the tightest that fits."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.filled = [False] * (2 * self.leaves)
        self.held: dict[int, list[int]] = {}

    def add(self, room: int, sequence: int) -> None:
        if not room:
            return
        self.held.setdefault(room, []).append(sequence)
        node = room + self.leaves
        while node and not self.filled[node]:
            self.filled[node] = True
            node >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """The least room of ``length`` or more, and its oldest-but-latest sequence; None if there is none."""
        filled = self.filled
        node = length + self.leaves
        if not filled[node]:
            while node > 1 and (node & 1 or not filled[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if filled[2 * node] else 2 * node + 1
        room = node - self.leaves
        sequence = self.held[room].pop()
        if not self.held[room]:
            filled[node] = False
            node >>= 1
            while node and not (filled[2 * node] or filled[2 * node + 1]):
                filled[node] = False
                node >>= 1
        return room, sequence


def best_fit_decreasing(lengths: Iterable[int], window: int = WINDOW) -> tuple[list[int], list[int]]:
    """Sequence and offset of each piece; ``lengths`` are in decreasing order and at most ``window``."""
    windows = OpenWindows(window)
    sequences, offsets, opened = [], [], 0
    for length in lengths:
        found = windows.take(length)
        if found is None:
            found = (window, opened)
            opened += 1
        room, sequence = found
        sequences.append(sequence)
        offsets.append(window - room)
        windows.add(room - length, sequence)
    return sequences, offsets


def pack(docs: DataFrame, vocabulary: str, end_id: int = 2, window: int = WINDOW, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """One row per piece: where it lies in its document and in which sequence, and at which offset.

    ``docs`` needs doc_id and text. Groups are dealt by a hash of the piece and its row, so neither a repeated row nor a
    long document fills a group. Sequence ids are unique over all groups: group number, then the number within the group.
    """
    groups = max(1, docs.count() // group_pieces)
    pieces = token_pieces(docs, vocabulary, end_id, window)
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("doc_id", "start", "row_number", "ids_crc32"), F.lit(groups)))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "start", "row_number"], ascending=[False, True, True, True])
        sequences, offsets = best_fit_decreasing(group["length"].tolist(), window)
        group["sequence_id"] = np.array(sequences, np.int64) + (int(group["group"].iloc[0]) << 32)
        group["offset"] = np.array(offsets, np.int64)
        return group[[part.split(" ")[0] for part in PACKED.split(", ")]]

    return dealt.groupBy("group").applyInPandas(run, PACKED)
