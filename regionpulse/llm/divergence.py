"""How the words of the sources of a language differ: a token-start pointer sort counts, exact sums compare.

Counting needs no table of words.  A shard of Arrow rows (about ``SHARD`` bytes of text, whole rows) is one buffer of
bytes; an integer points at the start of every word in it.  The pointers are ordered by multikey quicksort, eight bytes
of the word being one key: slices above ``CUTOFF`` pointers are split in three around a pivot, smaller ones of all
depths are sorted together, and runs that are equal so far go on to the next eight bytes.  The pointers begin in order
of (language, source) and row and every step is stable, so in a run of equal words the changes of group and of row give
its occurrences and its documents for each group.  What leaves a shard is one row per word and group.

Sources are compared by blocks of terms and of sources, so that no task holds a language or all pairs: a task turns its
terms into a matrix of shares and adds up the differences of each pair of its columns.

Nulls in text, lang and source count as empty; a text without a word still makes its group occur.  Every row is a
document, also one that repeats another or has a null id.  A language without kept terms has pairs of value 0.  An
empty table gives an empty result.  Only ``text``, ``lang`` and ``source`` are read, so further columns may have any
names.  A text of any length is one shard at most by itself; words longer than ``DEEP`` bytes are compared whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regionpulse.llm.common import ship, table
from regionpulse.session import stage

LEAST_DOCS = 30
TOP = 50
SCALE = 1_000_000_000
SMOOTH = 5
SHARD = 4 << 20
CUTOFF = 1 << 15
DEEP = 256
#: Terms and sources of a block.
TERMS = 1024
SOURCES = 256
#: The byte that each byte counts as: lower case for A-Z, itself for a-z and beyond ASCII, 0 where no word goes on.
LETTER = np.array([b if b > 0x7F or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0 for b in range(256)], np.uint8)
#: What is kept of eight bytes of which so many belong to the word.
KEEP = np.array([((1 << 64) - 1) ^ ((1 << (64 - 8 * k)) - 1) for k in range(9)], np.uint64)


def _keys(windows: np.ndarray, starts: np.ndarray, sizes: np.ndarray, depth: int) -> np.ndarray:
    """Eight bytes of each word from ``depth`` on, as a number that orders like them; words hold no zero byte."""
    eight = np.ascontiguousarray(windows[starts + depth]).view(">u8").ravel().astype(np.uint64)
    return eight & KEEP[np.clip(sizes - depth, 0, 8)]


def _split(keys: np.ndarray, pivot: np.uint64) -> tuple[np.ndarray, tuple[int, int]]:
    """The order that puts smaller keys first, then the pivot's, then larger ones, and where the last two begin."""
    below, above = keys < pivot, keys > pivot
    parts = np.flatnonzero(below), np.flatnonzero(~(below | above)), np.flatnonzero(above)
    return np.concatenate(parts), (len(parts[0]), len(parts[0]) + len(parts[1]))


def sort_words(buffer: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stable order of the words of a buffer, and for each place in it whether another word begins there.

    ``buffer`` ends with eight bytes that belong to no word.
    """
    windows = np.lib.stride_tricks.sliding_window_view(buffer, 8)
    order = np.arange(len(starts))
    begins = np.zeros(len(starts), bool)
    if len(starts):
        begins[0] = True
    slices, depth = [(0, len(starts))], 0
    while slices and depth < DEEP:
        small = []
        while slices:
            low, high = slices.pop()
            if high - low <= CUTOFF:
                small.append((low, high))
                continue
            mine = order[low:high]
            keys = _keys(windows, starts[mine], sizes[mine], depth)
            turn, (a, b) = _split(keys, np.sort(keys[:: max(1, len(keys) // 9)])[4])
            order[low:high] = mine[turn]
            begins[[k for k in (low + a, low + b) if k < high]] = True
            slices += [s for s in ((low, low + a), (low + b, high)) if s[1] > s[0]]
            if b - a > 1:
                # One key of eight bytes: nothing to sort at this depth.
                small.append((low + a, low + b))
        bounds = np.array(small, np.int64).reshape(-1, 2)
        places = _ranges(bounds)
        number = np.repeat(np.arange(len(bounds)), bounds[:, 1] - bounds[:, 0])
        keys = _keys(windows, starts[order[places]], sizes[order[places]], depth)
        turn = np.lexsort((keys, number))
        order[places], keys = order[places][turn], keys[turn]
        other = np.append(True, (keys[1:] != keys[:-1]) | (number[1:] != number[:-1])) if len(keys) else np.zeros(0, bool)
        begins[places] |= other
        depth += 8
        # Runs of equal keys whose words go on, if they are more than one.
        run = np.flatnonzero(other)
        lengths = np.diff(np.append(run, len(keys)))
        longer = np.maximum.reduceat(sizes[order[places]], run) > depth if len(run) else np.zeros(0, bool)
        first = places[run[longer & (lengths > 1)]]
        slices = list(zip(first.tolist(), (first + lengths[longer & (lengths > 1)]).tolist()))
    for low, high in slices:
        words = [buffer[s + depth : s + n].tobytes() for s, n in zip(starts[order[low:high]], sizes[order[low:high]])]
        turn = sorted(range(len(words)), key=words.__getitem__)
        order[low:high] = order[low:high][turn]
        begins[low:high] = [k == 0 or words[turn[k]] != words[turn[k - 1]] for k in range(len(turn))]
    return order, begins


def _ranges(bounds: np.ndarray) -> np.ndarray:
    """All whole numbers of some half-open ranges, one range after the other."""
    sizes = bounds[:, 1] - bounds[:, 0]
    total = int(sizes.sum())
    return np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(bounds[:, 0], sizes)


def count_shard(texts: pa.Array, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Group, occurrences and documents of every word and group of a shard, and the word itself."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    buffer = np.append(LETTER[data], np.zeros(9, np.uint8))
    inside = buffer != 0
    # A word ends with its row as well.
    edge = np.zeros(len(buffer), bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside & (edge | ~np.append(False, inside[:-1])))
    stops = np.flatnonzero(inside[:-1] & (edge[1:] | ~inside[1:])) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    # Rows of one group stand together, in the order of the buffer.
    by_group = np.argsort(groups[rows], kind="stable")
    starts, sizes, rows = starts[by_group], (stops - starts)[by_group], rows[by_group]
    order, begins = sort_words(buffer, starts, sizes)
    rows, group = rows[order], groups[rows[order]]
    new_row = begins | np.append(True, rows[1:] != rows[:-1])[: len(rows)]
    new_group = begins | np.append(True, group[1:] != group[:-1])[: len(rows)]
    first = np.flatnonzero(new_group)
    n = np.diff(np.append(first, len(rows)))
    docs = np.add.reduceat(new_row.astype(np.int64), first) if len(first) else n
    at, sizes = starts[order[first]], sizes[order[first]]
    words = buffer[_ranges(np.stack([at, at + sizes], 1))]
    ends = np.append(0, np.cumsum(sizes)).astype(np.int64)
    terms = pa.Array.from_buffers(pa.large_string(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(words)])
    return group[first], n, docs, terms


def _shard_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    size = 0

    def flush():
        whole = pa.Table.from_batches(held).combine_chunks()
        named = whole.group_by(["lang", "source"]).aggregate([]).combine_chunks()
        place = {pair: k for k, pair in enumerate(zip(named["lang"].to_pylist(), named["source"].to_pylist()))}
        groups = np.fromiter((place[p] for p in zip(whole["lang"].to_pylist(), whole["source"].to_pylist())), np.int64, len(whole))
        texts = whole["text"].combine_chunks()
        group, n, docs, terms = count_shard(texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts, groups)
        # The empty word, without occurrences, makes every group occur.
        group = np.append(group, np.arange(len(named)))
        zeros = np.zeros(len(named), np.int64)
        columns = {
            "lang": named["lang"].take(pa.array(group)), "source": named["source"].take(pa.array(group)),
            "term": pa.concat_arrays([terms, pa.array([""] * len(named), pa.large_string())]).cast(pa.string()),
            "n": pa.array(np.append(n, zeros)), "docs": pa.array(np.append(docs, zeros)),
        }
        yield from pa.table(columns).to_batches(20_000)

    for batch in batches:
        # A large batch is cut by size; a row stays whole.
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(0)), 0).to_numpy())
        at = 0
        while at < len(sizes):
            base = sizes[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(sizes, base + SHARD - size, "right")))
            held.append(batch.slice(at, upto - at))
            size += int(sizes[upto - 1] - base)
            at = upto
            if size >= SHARD or at < len(sizes):
                yield from flush()
                held.clear()
                size = 0
    if held:
        yield from flush()


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n and docs of every term and group; the empty term stands for the group itself."""
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(plain("text").alias("text"), plain("lang").alias("lang"), plain("source").alias("source"))
    found = rows.mapInArrow(_shard_counts, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (n + SMOOTH) / (total + SMOOTH * kept)), in whole numbers of any size."""
    wide = lambda c: c.cast("decimal(19,0)")
    top, bottom = F.lit(SCALE).cast("decimal(10,0)") * (wide(n) + SMOOTH), wide(total) + SMOOTH * wide(kept)
    return F.lit(1) + F.call_function("div", top, bottom)


def _differences(group: pd.DataFrame) -> pd.DataFrame:
    """Sums of differences between the sources of two blocks over the terms of one block."""
    lang, i, j = (group[c].iloc[0] for c in ("lang", "i", "j"))
    sources, cells = group[group["term"].isna()], group[group["term"].notna()]
    number, names = sources["number"].to_numpy(np.int64), sources["source"].to_numpy(object)
    place = pd.Series(np.arange(len(number)), index=number)
    term, terms = pd.factorize(cells["term"])
    # A source without a term has its share of a term that occurs nowhere.
    nothing = sources["p"].to_numpy(np.int64)
    shares = np.repeat(nothing[:, None], len(terms), 1)
    shares[place.loc[cells["number"].to_numpy(np.int64)].to_numpy(), term] = cells["p"].to_numpy(np.int64)
    # Terms that neither block has are not here: the first block of terms adds them, the others only what differs from them.
    absent = (int(sources["kept"].iloc[0]) if group["bucket"].iloc[0] == 0 else 0) - len(terms)
    left, right = np.flatnonzero(number // SOURCES == i), np.flatnonzero(number // SOURCES == j)
    out: list[tuple] = []
    for k in left.tolist():
        others = right[number[right] > number[k]]
        sums = np.abs(shares[others] - shares[k]).sum(1) + absent * np.abs(nothing[others] - nothing[k])
        out += [(lang, names[k], names[o], int(s)) for o, s in zip(others.tolist(), sums.tolist())]
    return pd.DataFrame(out, columns=["lang", "a", "b", "value"], dtype=object)


def _pairs(sources: DataFrame, cells: DataFrame) -> DataFrame:
    """lang, source, item (the other source) and value, of every pair in both directions."""
    in_lang = Window.partitionBy("lang")
    shape = {
        "buckets": F.greatest(F.ceil(F.col("kept") / TERMS), F.lit(1)),
        "blocks": F.ceil(F.count("*").over(in_lang) / F.lit(SOURCES)),
        "mine": F.floor(F.col("number") / SOURCES),
    }
    shaped = stage(sources.withColumns(shape))
    nothing = share(F.lit(0), F.col("source_total"), F.col("kept"))
    heads = shaped.select(
        "lang", "source", "number", "kept", "blocks", "mine", F.explode(F.sequence(F.lit(0).cast("long"), F.col("buckets") - 1)).alias("bucket"),
        F.lit(None).cast("string").alias("term"), F.when(F.col("kept") > 0, nothing).otherwise(0).alias("p"),
    )
    shares = cells.select("lang", "source", "term", "p").join(shaped.select("lang", "source", "number", "kept", "blocks", "mine", "buckets"), ["lang", "source"])
    rows = heads.unionAll(shares.select("lang", "source", "number", "kept", "blocks", "mine", F.pmod(F.xxhash64("term"), F.col("buckets")).alias("bucket"), "term", "p"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.select("lang", "bucket", F.least("mine", "with").alias("i"), F.greatest("mine", "with").alias("j"), "source", "number", "kept", "term", "p")
    sums = rows.groupBy("lang", "bucket", "i", "j").applyInPandas(_differences, "lang string, a string, b string, value long")
    sums = stage(sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    return sums.selectExpr("lang", "a source", "b item", "value").unionAll(sums.selectExpr("lang", "b source", "a item", "value"))


def _ranked(rows: DataFrame, part: str, top: int | None = None) -> DataFrame:
    """Ranks from 1 in each group, by falling value and then by item."""
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return ranked.where(F.col("rank") <= top) if top else ranked


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value and rank.

    A language keeps the terms in at least ``least_docs`` of its documents.  Part ``pair`` gives for each source the
    others of its language with the sum of the differences of their shares, part ``term`` the ``top`` terms by which
    the source's share exceeds its language's.
    """
    counts = stage(word_counts(docs))
    by_lang = counts.where("term <> ''").groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"))
    kept = stage(by_lang.where(F.col("docs") >= least_docs).select("lang", "term", "total"))
    cells = stage(counts.where("term <> ''").select("lang", "source", "term", "n").join(kept, ["lang", "term"]))
    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("total").alias("lang_total"))
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("source_total"))
    zero = F.lit(0).cast("long")
    # One row per group: sources are numbered within their language.
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    sources = stage(
        counts.where("term = ''").select("lang", "source").join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
        .select("lang", "source", number.alias("number"), *[F.coalesce(c, zero).alias(c) for c in ("kept", "lang_total", "source_total")])
    )
    cells = stage(cells.join(sources, ["lang", "source"]).select(
        "lang", "source", "term", share(F.col("n"), F.col("source_total"), F.col("kept")).alias("p"),
        share(F.col("total"), F.col("lang_total"), F.col("kept")).alias("q"),
    ))
    more = cells.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return _ranked(_pairs(sources, cells), "pair").unionAll(_ranked(more, "term", top))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


ORACLE = f"""
WITH docs AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS doc,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x60\\x7B-\\x7F]+') AS words
  FROM documents),
cells AS (SELECT lang, source, term, sum(n)::BIGINT AS n, count(*) AS docs
  FROM (SELECT lang, source, doc, term, count(*) AS n FROM (SELECT lang, source, doc, unnest(words) AS term FROM docs) GROUP BY ALL) GROUP BY lang, source, term),
kept AS (SELECT lang, term, sum(n) AS total FROM cells GROUP BY lang, term HAVING sum(docs) >= {LEAST_DOCS}),
langs AS (SELECT lang, count(*) AS v, sum(total) AS lang_total FROM kept GROUP BY lang),
sources AS (SELECT lang, source, coalesce(sum(n), 0) AS source_total
  FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN (SELECT cells.* FROM cells JOIN kept USING (lang, term)) USING (lang, source) GROUP BY lang, source),
shares AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, 1 + ({SCALE}::HUGEINT * (coalesce(n, 0) + {SMOOTH})) // (source_total + {SMOOTH} * v) AS p,
         1 + ({SCALE}::HUGEINT * (total + {SMOOTH})) // (lang_total + {SMOOTH} * v) AS q
  FROM sources JOIN langs USING (lang) JOIN kept USING (lang) LEFT JOIN cells USING (lang, source, term)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM found QUALIFY part = 'pair' OR rank <= {TOP}
"""

ship(__name__)
