"""Token counts of a byte-level BPE vocabulary, merged on ragged numpy arrays.

Pre-tokens of a batch are held as one flat array of symbols with a sequence number each. A round finds
the lowest-rank pair of every sequence at once, merges all its occurrences from left to right, and
drops the sequences without a mergeable pair; the symbols that survive are the tokens. Merging
equal pairs together gives what merging one at a time gives: a symbol made by the merge of rank r
only occurs in pairs of a higher rank.

Texts are taken whole. A null text is empty; an empty text has no tokens. The file's special strings
count as one token wherever they occur, which is the library's default. Rows are counted one by one, so repeated rows
and ids, ties and extra columns need no rule; an empty table gives an empty table.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from lendlake.llm.words import slices

# The pre-token pattern of byte-level BPE files and the printable stand-ins for bytes.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]

CACHE_ENTRIES = 300_000
LONG = 1_000
RANK_BLOCK = 256
CHUNK_SYMBOLS = 1 << 20


def byte_symbols() -> list[str]:
    """The character that stands for each byte in the vocabulary file."""
    others = iter(range(256, 512))
    return [chr(b if b in PRINTABLE else next(others)) for b in range(256)]


class Merges:
    """Merge rules of one file as sorted arrays: pair of ids -> rank and new id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, rules = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [rule if isinstance(rule, list) else rule.split(" ") for rule in rules]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.none = len(pairs)
        self.byte_ids = np.array([vocab[c] for c in byte_symbols()], np.int64)
        special = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.pattern = regex.compile(PRE_TOKENS)
        self.known: dict[str, int] = {}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], self.none)

    def surviving(self, sequences: list[bytes]) -> np.ndarray:
        """Symbols left of each byte sequence once no pair of it can be merged."""
        counts = np.array([len(s) for s in sequences], np.int64)
        symbols = self.byte_ids[np.frombuffer(b"".join(sequences), np.uint8)]
        owner = np.repeat(np.arange(len(counts)), counts)
        while len(symbols) > 1:
            ranks = self.rank(symbols[:-1], symbols[1:])
            ranks[owner[:-1] != owner[1:]] = self.none
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lengths = np.diff(np.r_[first, len(owner)])
            lowest = np.minimum.reduceat(np.r_[ranks, self.none], first)
            live = np.repeat(lowest < self.none, lengths)
            if not live.all():
                symbols, owner, ranks = symbols[live], owner[live], np.r_[ranks, self.none][live][:-1]
                if not len(symbols):
                    break
            lowest = np.repeat(lowest, lengths)[live]
            hit = np.flatnonzero(ranks == lowest[:-1])
            # In a run of overlapping hits (a a a) every second one merges, from the left.
            run_start = np.r_[True, np.diff(hit) != 1]
            run = np.maximum.accumulate(np.where(run_start, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
            symbols[hit] = self.made[ranks[hit]]
            np.subtract.at(counts, owner[hit], 1)
            keep = np.ones(len(symbols), bool)
            keep[hit + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        return counts

    def surviving_long(self, sequence: bytes) -> int:
        """Symbols left of one long sequence, with work for the merged places only.

        Ranks go up in blocks. A pass over the sequence finds the pairs of a block of ranks; rank by rank, all pairs of a rank merge at
        once, and their new neighbours join the block or wait for a later one. A new pair has a higher rank than the merge that made it.
        """
        symbols = self.byte_ids[np.frombuffer(sequence, np.uint8)].astype(np.int64)
        n = len(symbols)
        after, before = np.arange(1, n + 1), np.arange(-1, n)  # before has a place for the end
        ranks = np.append(self.rank(symbols[:-1], symbols[1:]), self.none)
        left = n
        while (lowest := int(ranks.min())) < self.none:
            end = min(lowest + RANK_BLOCK, self.none)
            open_at = np.flatnonzero(ranks < end)
            while len(open_at):
                own = ranks[open_at]
                rank = int(own.min())
                if rank >= end:
                    break
                hit = open_at[own == rank]
                # In a run of overlapping hits (a a a) every second one merges, from the left.
                run_start = np.r_[True, after[hit[:-1]] != hit[1:]]
                run = np.maximum.accumulate(np.where(run_start, np.arange(len(hit)), 0))
                hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
                gone = after[hit]
                symbols[hit] = self.made[rank]
                after[hit] = after[gone]
                before[after[hit]] = hit
                ranks[gone] = self.none
                left -= len(hit)
                touched = np.unique(np.r_[before[hit], hit])
                touched = touched[touched >= 0]
                follows = after[touched]
                inside = follows < n
                ranks[touched] = self.none
                ranks[touched[inside]] = self.rank(symbols[touched[inside]], symbols[follows[inside]])
                open_at = np.union1d(open_at[own > rank], touched[ranks[touched] < end])
        return left

    def learn(self, pre_tokens: list[str]) -> None:
        """Counts of pre-tokens not met before, in chunks of bounded size."""
        long = [t for t in pre_tokens if len(t) > LONG]
        self.known.update((t, self.surviving_long(t.encode())) for t in long)
        pre_tokens = [t for t in pre_tokens if len(t) <= LONG] if long else pre_tokens
        chunk: list[str] = []
        size = 0
        for i, token in enumerate(pre_tokens):
            chunk.append(token)
            size += len(token)
            if size >= CHUNK_SYMBOLS or i == len(pre_tokens) - 1:
                counts = self.surviving([t.encode() for t in chunk])
                self.known.update(zip(chunk, counts.tolist(), strict=True))
                chunk, size = [], 0

    def split(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of a text and how many special strings stand between them."""
        if self.special is None:
            return self.pattern.findall(text), 0
        parts = self.special.split(text)
        if len(parts) == 1:
            return self.pattern.findall(text), 0
        return [t for part in parts for t in self.pattern.findall(part)], len(parts) - 1

    def count(self, texts: list[str]) -> list[int]:
        out = []
        done = 0
        while done < len(texts):
            held, size = [], 0
            for text in texts[done:]:  # pre-tokens of about a million characters at a time
                held.append(self.split(text))
                size += len(text)
                if size > CHUNK_SYMBOLS:
                    break
            done += len(held)
            known = self.known
            if len(known) > CACHE_ENTRIES:
                known.clear()
            self.learn(list({t for tokens, _ in held for t in tokens if t not in known}))
            out += [extra + sum([known[t] for t in tokens]) for tokens, extra in held]
        return out


@cache
def merges(path: str) -> Merges:
    return Merges(path)


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 1024, text: str = "text") -> DataFrame:
    """``docs`` columns other than the text, with n_bytes, n_tokens and over_limit (more than ``limit`` tokens).

    Existing columns of these names are replaced. ``vocabulary`` is the path of a byte-level BPE file that every
    executor has. One pass over the rows, no shuffle.
    """
    made = ("n_bytes", "n_tokens", "over_limit")
    kept = [f for f in docs.schema.fields if f.name not in (text, *made)]
    inner = docs.select(*[docs[f"`{f.name}`"] for f in kept], docs[f"`{text}`"].alias("__text"))
    names = [f.name for f in kept]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], "n_bytes bigint, n_tokens bigint, over_limit boolean"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = merges(vocabulary)
        for batch in slices(batches, "__text"):
            column = pc.fill_null(batch.column("__text"), "")
            tokens = np.array(rules.count(column.to_pylist()), np.int64)
            columns = [batch.column(n) for n in names]
            columns += [pc.binary_length(column).cast(pa.int64()), pa.array(tokens), pa.array(tokens > limit)]
            yield pa.RecordBatch.from_arrays(columns, [*names, *made])

    return inner.mapInArrow(run, schema)
