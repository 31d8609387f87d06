"""Exact removal of repeated passages of words, by super-k-mer partitioning.

Every window of ``WINDOW`` words has a minimiser: the smallest hash of the ``GRAM`` words sequences inside it.
Consecutive windows whose minimiser is the same occurrence travel as one packed string, a super-k-mer, to the bucket
of that minimiser.  Equal windows have equal minimisers and so meet in one bucket, where their word sequences are
sorted; of equal ones all but the first, by (doc_id, place), are repeats.  A document loses the words that its
repeated windows cover.

Strings travel only where they can be equal to another one: a first pass sends the minimisers alone, and those that
occur once in all texts need no string.

Sequences that occur very often would fill a bucket, so they are ordered after all others: a window takes one as its
minimiser only if it holds nothing else, that is, inside a common passage, where windows are equal.  Super-k-mers
equal to an earlier one in the same batch of documents are judged at once and do not travel.  Frequency is counted
over all texts in a table of hashed slots, at most ``MOST_SLOTS`` of them, of which one bit each is sent to the tasks.
It only affects how work is dealt out, never the result.

Words are runs of anything but the six ASCII white-space characters, compared unchanged.  Null and empty texts have
no words; a null id comes last.  Rows that agree in doc_id and text are one document: they do not repeat each other.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regionpulse.llm.common import id_of, release, ship, table, text_batches, text_of
from regionpulse.session import stage

WINDOW = 20
#: Long enough that few sequences occur twice by chance.
GRAM = 6
#: Occurrences of a slot's sequences from which they are ordered last.
OFTEN = 20_000
LEAST_SLOTS, MOST_SLOTS = 1 << 16, 1 << 26
#: Text that a task works on at once.
BATCH_BYTES = 4 << 20
ROWS = "key long, id long, text long, start int, stop int, packed binary"


def _grams(words: list[bytes]) -> np.ndarray:
    """63-bit hashes of the sequences of GRAM words."""
    w = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    h = np.zeros(max(0, len(w) - GRAM + 1), np.uint64)
    for k in range(GRAM):
        h = (h ^ w[k : len(w) - GRAM + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return (h ^ (h >> np.uint64(32))) >> np.uint64(1)


def _parts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Batches of at most about BATCH_BYTES of text."""
    for batch in batches:
        at, size = 0, 0
        for i, text in enumerate(batch.column(column)):
            size += len(text.as_buffer() or b"") if text.is_valid else 0
            if size >= BATCH_BYTES or i == batch.num_rows - 1:
                yield batch.slice(at, i + 1 - at)
                at, size = i + 1, 0


def _counter(slots: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches, 0):
            words = [w for text in batch.column(0) for w in text.as_buffer().to_pybytes().split()]
            found, n = np.unique(_grams(words) % np.uint64(slots), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array(n)], ["slot", "n"])

    return run


def frequent(docs: DataFrame, often: int = OFTEN) -> np.ndarray:
    """One bit per slot: whether its sequences occur very often.  ``docs`` has the binary column ``raw``."""
    size = docs.agg(F.sum(F.octet_length("raw"))).first()[0] or 0
    slots = LEAST_SLOTS
    while slots < MOST_SLOTS and slots * often < 2 * size:
        slots *= 2
    often = max(often, 2 * size // slots)
    counts = docs.select("raw").mapInArrow(_counter(slots), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    bits = np.zeros(slots, bool)
    for row in counts.where(F.col("n") > often).toLocalIterator():
        bits[row.slot] = True
    return np.packbits(bits)


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours."""
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return x if span == width else np.minimum(x[: len(x) - (width - span)], x[width - span :])


def _packed(words: list[bytes], often: np.ndarray) -> list[tuple[int, int, int]]:
    """(minimiser, first window, last window + 1) of one document's super-k-mers."""
    if len(words) < WINDOW:
        return []
    grams = _grams(words)
    order = grams | (often[(grams % np.uint64(len(often))).astype(np.int64)].astype(np.uint64) << np.uint64(63))
    least = _least(order, WINDOW - GRAM + 1)
    new = np.ones(len(least), bool)
    new[1:] = (order[: len(least) - 1] == least[:-1]) | (least[1:] != least[:-1])
    first = np.flatnonzero(new)
    return list(zip(least[first].astype(np.int64).tolist(), first.tolist(), [*first[1:].tolist(), len(least)]))


def _minimisers(sent):
    """(key, handle, start, known): the minimisers of each document, without their strings.

    Of a minimiser that a batch holds several times one row travels to its bucket; the batch itself shows that the
    others (``known``) are repeated, and these are dealt out by document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = np.unpackbits(sent.value).astype(bool)
        for batch in _parts(batches, 1):
            keys, starts, sizes = [], [], []
            for raw in batch.column(1):
                found = _packed(raw.as_buffer().to_pybytes().split(), often)
                keys += [f[0] for f in found]
                starts += [f[1] for f in found]
                sizes.append(len(found))
            key = np.array(keys, np.int64)
            handle = np.repeat(batch.column(0).to_numpy(), sizes)
            _, place, back, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
            several = count[back] > 1
            travels = np.zeros(len(key), bool)
            travels[place] = True
            route = np.where(travels, key, handle)
            yield pa.RecordBatch.from_arrays(
                [pa.array(route), pa.array(handle, pa.int64()), pa.array(starts, pa.int32()), pa.array(several), pa.array(travels)],
                ["key", "handle", "start", "known", "travels"],
            )

    return run


def _occurring_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted minimisers to (handle, start) of those that are known to be repeated or meet another one here."""
    held: list | None = None

    def chosen(key, handle, start, known, travels, last):
        """Rows to give, without those of the last key unless nothing follows."""
        edge = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (travels[1:] != travels[:-1])]))
        run = np.diff(np.concatenate([edge, [len(key)]]))
        again = known | (travels & (np.repeat(run, run) > 1))
        stop = len(key) if last else edge[-1]
        keep = again[:stop]
        rest = [x[stop:] for x in (key, handle, start, known, travels)]
        return pa.RecordBatch.from_arrays([pa.array(handle[:stop][keep]), pa.array(start[:stop][keep])], ["handle", "start"]), rest

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
        if held is not None:
            columns = [np.concatenate([h, c]) for h, c in zip(held, columns)]
        out, held = chosen(*columns, last=False)
        yield out
    if held is not None and len(held[0]):
        yield chosen(*held, last=True)[0]


def _sender(sent):
    """Super-k-mers of the places that the first pass has found, one row per different string and batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = np.unpackbits(sent.value).astype(bool)
        for batch in _parts(batches, 2):
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out: list[list] = [[], [], [], [], [], []]
            seen: dict[bytes, tuple[int, int, int]] = {}
            for i in sorted(range(len(ids)), key=lambda i: (ids[i], texts[i])):
                words = batch.column(2)[i].as_buffer().to_pybytes().split()
                wanted = set(batch.column(3)[i].as_py())
                own = (ids[i], texts[i])
                known: list[list[int]] = []
                rows = []
                for key, a, b in _packed(words, often):
                    if a not in wanted:
                        continue
                    piece, stop = b" ".join(words[a : b + WINDOW - 1]), b + WINDOW - 1
                    if seen.setdefault(piece, (*own, a)) == (*own, a):
                        rows.append((key, *own, a, stop, piece))
                    elif known and a <= known[-1][1]:
                        known[-1][1] = stop
                    else:
                        known.append([a, stop])
                # What is known to be repeated needs no bucket: it is dealt out by document.
                rows += [(own[1], *own, a, stop, None) for a, stop in known]
                for row in rows:
                    for column, value in zip(out, row):
                        column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["key", "id", "text", "start", "stop", "packed"])

    return run


def _repeats(rows: list[tuple[int, int, int, bytes]]) -> Iterator[tuple[int, int, int, int]]:
    """Intervals of the repeated windows of one minimiser's super-k-mers, which come in order."""
    windows = []
    for k, (_, _, start, packed) in enumerate(rows):
        words = packed.split(b" ")
        windows += [(b" ".join(words[i : i + WINDOW]), k, i) for i in range(len(words) - WINDOW + 1)]
    windows.sort()
    hit: dict[int, list[int]] = {}
    for (before, j, a), (window, k, i) in zip(windows, windows[1:]):
        if window == before:
            hit.setdefault(k, []).append(i)
    for k, found in hit.items():
        ident, text, start, _ = rows[k]
        found.sort()
        first = last = found[0]
        for i in [*found[1:], None]:
            if i is None or i > last + 1:
                yield ident, text, start + first, start + last + WINDOW
                first = i
            last = i


def _bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted super-k-mers to intervals (id, text, start, stop) of repeated words."""
    held: list[tuple[int, int, int, bytes]] = []
    strings: dict[bytes, tuple[int, int, int]] = {}
    current = None
    out: list[tuple[int, int, int, int]] = []

    def batch_of(rows):
        columns = list(zip(*rows)) or [[], [], [], []]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["id", "text", "start", "stop"])

    for batch in batches:
        keys = batch.column(0).to_numpy()
        n = len(keys)
        if not n:
            continue
        packed, ids, texts, starts, stops = (batch.column(c) for c in (5, 1, 2, 3, 4))
        edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
            if keys[a] != current:
                if len(held) > 1:
                    out += _repeats(held)
                held, strings, current = [], {}, keys[a]
            if b - a == 1 and b < n and not held and packed[a].is_valid:
                current = None
                continue
            for i in range(a, b):
                row = (ids[i].as_py(), texts[i].as_py(), starts[i].as_py())
                piece = packed[i].as_py()
                if piece is None or piece in strings:
                    if piece is None or strings[piece] != row:
                        out.append((*row, stops[i].as_py()))
                else:
                    strings[piece] = row
                    held.append((*row, piece))
        if len(out) > 50_000:
            yield batch_of(out)
            out = []
    if len(held) > 1:
        out += _repeats(held)
    yield batch_of(out)


def _candidates(rows: DataFrame, sent) -> DataFrame:
    """``handle`` and ``starts`` of the super-k-mers whose minimiser occurs more than once."""
    light = rows.select("handle", "raw").mapInArrow(_minimisers(sent), "key long, handle long, start int, known boolean, travels boolean")
    ordered = light.repartition("key").sortWithinPartitions("key", "travels")
    again = ordered.mapInArrow(_occurring_again, "handle long, start int")
    return stage(again.groupBy("handle").agg(F.collect_list("start").alias("starts")))


def _spans(rows: DataFrame, candidates: DataFrame, sent) -> DataFrame:
    wanted = rows.join(candidates.hint("shuffle_hash"), "handle").select("id", "text", "raw", "starts")
    ordered = wanted.mapInArrow(_sender(sent), ROWS).repartition("key").sortWithinPartitions("key", F.col("packed").isNotNull(), "id", "text", "start")
    found = ordered.mapInArrow(_bucket, "id long, text long, start int, stop int")
    return stage(found.groupBy("id", "text").agg(F.collect_set(F.struct("start", "stop")).alias("spans")))


def repeats(docs: DataFrame, often: int = OFTEN) -> DataFrame:
    """``id``, ``text`` (a hash) and ``spans``: the words that each document loses, as (start, stop)."""
    spark = docs.sparkSession
    text_batches(spark)
    keyed = docs.select(id_of().alias("id"), F.xxhash64(text_of()).alias("text"), text_of().cast("binary").alias("raw"))
    rows = keyed.withColumn("handle", F.xxhash64("id", "text"))
    sent = spark.sparkContext.broadcast(frequent(rows, often))
    candidates = _candidates(rows, sent)
    release(spark)
    spans = _spans(rows, candidates, sent)
    release(spark)
    return spans


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for raw, spans in zip(batch.column(1), batch.column(2)):
            words = raw.as_buffer().to_pybytes().split()
            gone = np.zeros(len(words) + 1, np.int64)
            for s in spans.as_py() or ():
                gone[s["start"]] += 1
                gone[s["stop"]] -= 1
            lost = np.cumsum(gone)[:-1] > 0
            kept = b" ".join([w for w, x in zip(words, lost.tolist()) if not x]) if spans.is_valid else b" ".join(words)
            rows.append((len(words), int(lost.sum()), kept))
        columns = list(zip(*rows)) or [[], [], []]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary())],
            ["doc_id", "n_words", "n_removed", "kept"],
        )


def dedup(docs: DataFrame, often: int = OFTEN) -> DataFrame:
    """doc_id, n_words, n_removed and ``kept``: the words that stay, joined by one space."""
    spans = repeats(docs, often)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), id_of().alias("id"), F.xxhash64(text_of()).alias("text"), text_of().cast("binary").alias("raw")
    )
    joined = rows.join(spans.hint("shuffle_hash"), ["id", "text"], "left").select("doc_id", "raw", "spans")
    return joined.mapInArrow(_kept, "doc_id long, n_words long, n_removed long, kept binary").withColumn("kept", F.col("kept").cast("string"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


ORACLE = f"""
WITH split AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents),
windows AS (SELECT doc_id, unnest(range(1, len(words) - {WINDOW - 2})) AS i, words FROM split WHERE len(words) >= {WINDOW}),
texts AS (SELECT doc_id, i, md5(array_to_string(words[i:i + {WINDOW - 1}], ' ')) AS w FROM windows),
again AS (SELECT doc_id, i FROM texts QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW})) AS i FROM again),
each AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM split)
SELECT s.doc_id, len(s.words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM split s LEFT JOIN (
  SELECT e.doc_id, count(g.i) AS n, string_agg(word, ' ' ORDER BY e.i) FILTER (g.i IS NULL) AS kept
  FROM each e LEFT JOIN gone g USING (doc_id, i) GROUP BY e.doc_id) k USING (doc_id)
"""

ship(__name__)
