"""Token counts of byte-level BPE by rank-synchronous merging of arrays.

The texts of a batch are cut into pre-tokens, and the ones not seen before are merged together: their symbols lie one
after the other in a ragged array, and in every round each sequence applies its pair of lowest rank at all the places
where it stands, from left to right.  What survives is counted, so no ids are written.  A round costs the symbols of
the sequences that still have a pair; sequences are first cut between bytes that stand together in no token, as no
merge can join them, which keeps the rounds of a very long pre-token few.

This equals the queue of single merges if every merge joins symbols that are bytes or made by earlier merges; a
vocabulary file where that is not so is refused.

A null text is empty and has 0 bytes and 0 tokens.  A text of any length is counted whole, its pre-tokens by portions.
Every row is counted by itself, so repeated rows and null ids give repeated rows; an empty table gives an empty one.
Only ``doc_id`` and ``text`` are read, so further columns may have any names.
"""

from __future__ import annotations

import json
import sys
import types
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regionpulse.llm.bpe import PATTERN, byte_letters, vocabulary_path
from regionpulse.llm.common import ship, table

LIMIT = 512
#: Pre-tokens of one generation of a worker's memory; there are two generations.
MEMORY = 50_000
#: Characters of the texts, and pre-tokens of a text, that are held at a time.
PORTION = 1 << 20
PIECES = 200_000
NEVER = np.iinfo(np.int32).max


class Merger:
    """The merges of one vocabulary file, given as its text, as arrays."""

    def __init__(self, source: str):
        spec = json.loads(source)
        letters = byte_letters()
        ids = spec["model"]["vocab"]
        self.added = [x["content"] for x in spec["added_tokens"]]
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.pattern = regex.compile(PATTERN)
        self.start = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.start[byte] = ids[letter]
        self.size = max(ids.values()) + 1
        pairs, made = [], dict.fromkeys(ids[c] for c in letters)
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            if ids[a] not in made or ids[b] not in made or made.get(ids[a + b], -1) is None or ids[a + b] in made:
                raise ValueError(f"merge {rank} does not join symbols of earlier merges into a new one")
            made[ids[a + b]] = rank
            pairs.append((ids[a] * self.size + ids[b], rank, ids[a + b]))
        keys, ranks, merged = (np.array(c, np.int64) for c in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 3
        order = np.argsort(keys)
        self.keys, self.ranks = np.append(keys[order], np.iinfo(np.int64).max), np.append(ranks[order], NEVER).astype(np.int32)
        self.merged = merged
        # Ranks of pairs of bytes, and the bytes that stand side by side in some token.
        self.first = self.rank(np.repeat(self.start, 256), np.tile(self.start, 256))
        self.beside = np.zeros(1 << 16, bool)
        for token in ids:
            word = np.frombuffer(bytes(letters[c] for c in token if c in letters), np.uint8).astype(np.int64)
            self.beside[word[:-1] * 256 + word[1:]] = True

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of symbols, ``NEVER`` for those that are not merged."""
        wanted = left * self.size + right
        at = np.searchsorted(self.keys, wanted)
        return np.where(self.keys[at] == wanted, self.ranks[at], NEVER).astype(np.int32)

    def counts(self, pieces: list[bytes]) -> np.ndarray:
        """The number of symbols that survive in each of some pre-tokens."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        left = sizes.copy()
        flat = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int64)
        if len(flat) < 2:
            return left
        owner = np.repeat(np.arange(len(pieces)), sizes)
        near = np.append(flat[:-1] * 256 + flat[1:], 0)
        last = np.append(owner[:-1] != owner[1:], True) | ~self.beside[near]
        last[-1] = True
        symbols, ranks = self.start[flat], np.where(last, NEVER, self.first[near])
        while len(symbols):
            starts = np.flatnonzero(np.append(True, last[:-1]))
            lowest = np.minimum.reduceat(ranks, starts)
            lengths = np.diff(np.append(starts, len(symbols)))
            # Sequences without a pair are done.
            going = lowest < NEVER
            if not going.all():
                stay = np.repeat(going, lengths)
                symbols, ranks, last, owner = symbols[stay], ranks[stay], last[stay], owner[stay]
                lowest, lengths = lowest[going], lengths[going]
                if not len(symbols):
                    break
            at = np.flatnonzero(ranks == np.repeat(lowest, lengths))
            # In a run of one symbol, places overlap: every other one counts, from the left.
            begins = np.append(True, at[1:] != at[:-1] + 1)
            at = at[(np.arange(len(at)) - np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))) % 2 == 0]
            left -= np.bincount(owner[at], minlength=len(left))
            symbols[at] = self.merged[ranks[at]]
            last[at] = last[at + 1]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, ranks, last, owner = symbols[keep], ranks[keep], last[keep], owner[keep]
            # Only the pairs on both sides of a merged symbol have changed.
            now = at - np.arange(len(at))
            changed = np.append(now, now[now > 0] - 1)
            after = np.minimum(changed + 1, len(symbols) - 1)
            ranks[changed] = np.where(last[changed], NEVER, self.rank(symbols[changed], symbols[after]))
        return left


class Memory:
    """Counts of pre-tokens in two generations: when the young one is full, the old one is forgotten."""

    def __init__(self, merger: Merger):
        self.merger, self.young, self.old = merger, {}, {}

    def total(self, portions: list[tuple[int, list[str]]], found: np.ndarray) -> None:
        """Adds to ``found`` the tokens of the pre-tokens of each of some texts."""
        if len(self.young) > MEMORY:
            self.young, self.old = {}, self.young
        wanted = set().union(*(pieces for _, pieces in portions)).difference(self.young)
        known = {p: self.old[p] for p in wanted if p in self.old}
        new = list(wanted.difference(known))
        known.update(zip(new, self.merger.counts([p.encode() for p in new]).tolist()))
        self.young.update(known)
        for k, pieces in portions:
            found[k] += sum(map(self.young.__getitem__, pieces))


def _worker_memory(source: str) -> Memory:
    """The memory of this Python worker, kept from one task to the next."""
    state = sys.modules.setdefault("_regionpulse_counts", types.ModuleType("_regionpulse_counts"))
    kept = getattr(state, "kept", None)
    if kept is None or kept[0] != hash(source):
        state.kept = kept = (hash(source), Memory(Merger(source)))
    return kept[1]


def count_texts(texts: Iterator[str | None], memory: Memory) -> np.ndarray:
    """The number of tokens of each text."""
    merger = memory.merger
    found: list[int] = []
    portions: list[tuple[int, list[str]]] = []
    held = 0
    for k, text in enumerate(texts):
        text = text or ""
        parts = merger.cut.split(text) if merger.cut else [text]
        found.append(len(parts) - 1)
        pieces = chain.from_iterable(merger.pattern.finditer(p) for p in parts) if len(text) > PORTION else None
        if pieces is None:
            portions.append((k, list(chain.from_iterable(map(merger.pattern.findall, parts)))))
            held += len(text)
        while pieces is not None and (portion := [m[0] for m in islice(pieces, PIECES)]):
            memory.total([(k, portion)], found)
        if held > PORTION:
            memory.total(portions, found)
            portions, held = [], 0
    memory.total(portions, found)
    return np.array(found, np.int64)


def _counter(source):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _worker_memory(source.value)
        for batch in batches:
            found = count_texts((t.as_py() for t in batch.column(2)), memory)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found)], ["doc_id", "n_bytes", "n_tokens"])

    return run


def counted(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row.

    The vocabulary file (1.5 MB) is read by the driver and sent to each executor once.
    """
    with open(path or vocabulary_path(), encoding="utf-8") as file:
        source = docs.sparkSession.sparkContext.broadcast(file.read())
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = texts.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    out = rows.mapInArrow(_counter(source), "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return counted(table(spark, sf_dir, "documents"))


ship(__name__)
