"""Byte-level BPE: encoding by a priority queue of merges, decoding by concatenating vocabulary strings.

A pre-token's symbols form a doubly linked list.  The queue holds (rank, position) of every adjacent pair that can be
merged; an entry whose pair has changed since is stale and skipped.  A worker remembers the pre-tokens it has met in
two generations of ``CACHE``, some 125 MB.  A pre-token of any length takes ``n log n`` steps.

A null text is empty; a text that names an added token holds that token's id, as the vocabulary file says.  Texts of
any length are encoded whole.  Every row is encoded by itself, so repeated rows and null ids give repeated rows, and an
empty table gives an empty one.  Only ``doc_id`` and ``text`` are read, so further columns may have any names.
"""

from __future__ import annotations

import hashlib
import json
import sys
import types
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from regionpulse.llm.common import ship, table, text_batches

VOCABULARY = "byte_bpe_50k.json"
#: Fixed value: the pattern that cuts texts before the merges of byte-level files.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Distinct pre-tokens of one generation of a worker's memory.
CACHE = 250_000
BATCH_BYTES = 1 << 20


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files: visible ones themselves, the others from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """The tables of one vocabulary file, given as its text."""

    def __init__(self, source: str):
        spec = json.loads(source)
        letters = byte_letters()
        ids = spec["model"]["vocab"]
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.start = {letters[c]: ids[c] for c in letters}
        self.merges, self.merged = {}, []
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[ids[a], ids[b]] = rank
            self.merged.append(ids[a + b])
        self.bytes = {i: bytes(letters[c] for c in token) for token, i in ids.items()}
        self.bytes |= {i: token.encode() for token, i in self.added.items()}
        self.pattern = regex.compile(PATTERN)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None

    def merge(self, piece: str) -> tuple[int, ...]:
        """Ids of one pre-token."""
        symbols = list(map(self.start.__getitem__, piece.encode()))
        n, rank_of = len(symbols), self.merges.get
        # The rank of the pair that begins at each place now; an entry of the queue with another rank is stale.
        ranks = list(map(rank_of, zip(symbols, symbols[1:])))
        shift = n.bit_length()
        queue = [r << shift | i for i, r in enumerate(ranks) if r is not None]
        if not queue:
            return tuple(symbols)
        heapify(queue)
        ranks.append(None)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        mask, made = (1 << shift) - 1, self.merged
        while queue:
            entry = heappop(queue)
            rank, i = entry >> shift, entry & mask
            if ranks[i] != rank:
                continue
            j = after[i]
            k = after[i] = after[j]
            symbols[i] = merged = made[rank]
            symbols[j] = ranks[j] = ranks[i] = None
            if k < n:
                before[k] = i
                found = rank_of((merged, symbols[k]))
                if found is not None:
                    ranks[i] = found
                    heappush(queue, found << shift | i)
            h = before[i]
            if h >= 0:
                ranks[h] = found = rank_of((symbols[h], merged))
                if found is not None:
                    heappush(queue, found << shift | h)
        return tuple([s for s in symbols if s is not None])

    def encode(self, text: str, seen: Memory) -> list[int]:
        """Ids of a text; ``seen`` remembers pre-tokens."""
        parts = self.cut.split(text) if self.cut else [text]
        out: list[int] = []
        for k, part in enumerate(parts):
            if k % 2:
                out.append(self.added[part])
                continue
            seen.turn()
            out.extend(chain.from_iterable(map(seen.__getitem__, self.pattern.findall(part))))
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


class Memory(dict):
    """Pre-tokens and their ids, in two generations: what is used stays, what is not used for a generation goes."""

    def __init__(self, codec: Codec):
        self.codec, self.old = codec, {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.old.get(piece)
        self[piece] = ids = self.codec.merge(piece) if ids is None else ids
        return ids

    def turn(self) -> None:
        """Begins a generation if this one is full."""
        if len(self) > CACHE:
            self.old = dict(self)
            self.clear()


def _worker_memory(source: str) -> Memory:
    """The memory of this Python worker, kept from one task to the next."""
    state = sys.modules.setdefault("_regionpulse_bpe", types.ModuleType("_regionpulse_bpe"))
    kept = getattr(state, "kept", None)
    if kept is None or kept[0] != hash(source):
        state.kept = kept = (hash(source), Memory(Codec(source)))
    return kept[1]


def _encoder(source, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _worker_memory(source.value)
        codec = seen.codec
        decimal = {i: str(i) for i in codec.bytes}
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for batch in batches:
            keys = batch.column(0)
            names, fields, rows, size, at = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["token_ids"] * with_ids, [], [], 0, 0
            for i, text in enumerate(batch.column(1)):
                text = text.as_py() or ""
                ids = codec.encode(text, seen)
                rows.append((len(ids), sha(",".join(map(decimal.__getitem__, ids))), sha(codec.decode(ids)), ids if with_ids else None))
                size += len(text)
                if size >= BATCH_BYTES or i == len(keys) - 1:
                    fields = list(zip(*rows))
                    arrays = [keys.slice(at, len(rows)), pa.array(fields[0], pa.int64()), pa.array(fields[1]), pa.array(fields[2])]
                    if with_ids:
                        arrays.append(pa.array(fields[3], pa.list_(pa.int32())))
                    yield pa.RecordBatch.from_arrays(arrays, names)
                    rows, size, at = [], 0, i + 1

    return run


def encode(docs: DataFrame, path: str | None = None, with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, the SHA-256 of the ids and of the text decoded from them, and the ids.

    The vocabulary file (1.5 MB) is read by the driver and sent to each executor once.
    """
    text_batches(docs.sparkSession)
    with open(path or vocabulary_path(), encoding="utf-8") as file:
        source = docs.sparkSession.sparkContext.broadcast(file.read())
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", token_ids array<int>" * with_ids
    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(_encoder(source, with_ids), schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), with_ids=False)


ship(__name__)
