"""CSV and GeoJSON whose records span lines, read by many tasks for each file.

A file is read in splits of whole lines, but where a record begins cannot be told inside a split: a line break may stand
in quotes, a line may be any depth inside a document.  So the lines are read twice.  The first pass gives what each
split does to the state (the parity of its quotes, the sum of its brackets), and a running sum over the splits of a
file, one row each, gives the state at the start of each split.  In the second pass every split is cut by itself.
Pieces of a record that stand in several splits are put together by their order, two a split at most.

Both passes must see the same splits, so the session's split settings must not change between them.  A file that never
closes its last quote or bracket ends with one long record.
"""

from __future__ import annotations

import csv
import re
import sys
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regionpulse.session import stage
from regionpulse.sources.readers import SOURCE_ORDER, explode_quake_documents
from regionpulse.sources.schemas import QUAKE_GEOJSON, RAW_NEWS

WHOLE, TAIL, MIDDLE, HEAD = range(4)
_PIECES = "path string, block long, place long, kind int, text string"
_TOO_MANY = "__campo_sobrante"
# Depth of the elements of a collection: document, list, element.
ELEMENT = 3
_STRING = r'"(?:[^"\\]|\\.)*"'
_STRUCTURE = re.compile(_STRING + r"|[\[\]{}]")


def _lines(spark: SparkSession, path: str | list[str], pattern: str | None) -> DataFrame:
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value")


class CsvCutter:
    """Records of CSV lines; the state is whether a quote is open.  Lines without an odd number of quotes are whole."""

    def __init__(self, state: int):
        self.open = self.before = bool(state)
        self.held: list[str] = []
        self.place = self.count = 0

    def feed(self, lines: pa.Array) -> Iterator[tuple[int, int, str]]:
        odd = np.flatnonzero(pc.count_substring(lines, '"').to_numpy(zero_copy_only=False) % 2).tolist()
        texts, at, base = lines.to_pylist(), 0, self.count
        self.count += len(texts)
        for k in odd:
            if self.open:
                self.held += texts[at : k + 1]
                yield self.place, HEAD if self.before else WHOLE, "\n".join(self.held).removesuffix("\r")
                self.open, self.before, self.held, at = False, False, [], k + 1
            else:
                yield from ((base + i, WHOLE, texts[i].removesuffix("\r")) for i in range(at, k))
                self.open, self.place, at = True, base + k, k
        if self.open:
            self.held += texts[at:]
        else:
            yield from ((base + i, WHOLE, texts[i].removesuffix("\r")) for i in range(at, len(texts)))

    def end(self) -> Iterator[tuple[int, int, str]]:
        if self.open:
            yield self.place, MIDDLE if self.before else TAIL, "\n".join(self.held)


class JsonCutter:
    """Lines that are documents, and the elements of documents that span lines; the state is the depth of brackets."""

    def __init__(self, state: int):
        self.depth = state
        self.open = self.before = state >= ELEMENT
        self.held: list[str] = []
        self.place = self.count = 0

    def feed(self, lines: pa.Array) -> Iterator[tuple[int, int, str]]:
        for line in lines.to_pylist():
            marks = [m for m in _STRUCTURE.finditer(line) if m[0][0] != '"']
            steps = sum(1 if m[0] in "[{" else -1 for m in marks)
            if not self.depth and not steps:
                if line.strip():
                    yield self.count, WHOLE, line
                self.count += 1
                continue
            at = 0
            for m in marks:
                if m[0] in "[{":
                    self.depth += 1
                    if self.depth == ELEMENT and m[0] == "{" and not self.open:
                        self.open, self.place, at = True, self.count, m.start()
                else:
                    if self.depth == ELEMENT and self.open:
                        self.held.append(line[at : m.end()])
                        yield self.place, HEAD if self.before else WHOLE, "\n".join(self.held)
                        self.open, self.before, self.held = False, False, []
                        self.count += 1
                    self.depth -= 1
            if self.open:
                self.held.append(line[at:])
            self.count += 1

    def end(self) -> Iterator[tuple[int, int, str]]:
        if self.open:
            yield self.place, MIDDLE if self.before else TAIL, "\n".join(self.held)


def _cutting(cutter: Callable[[int], CsvCutter | JsonCutter]):
    """The lines of a task, split after split, to pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, cut = None, None

        def batch_of(pieces: Iterator[tuple[int, int, str]]) -> pa.RecordBatch:
            places, kinds, texts = zip(*found) if (found := list(pieces)) else ((), (), ())
            n = len(places)
            return pa.RecordBatch.from_arrays(
                [pa.array([now[0]] * n, pa.string()), pa.array([now[1]] * n, pa.int64()), pa.array(places, pa.int64()),
                 pa.array(kinds, pa.int32()), pa.array(texts, pa.string())], ["path", "block", "place", "kind", "text"]
            )

        for batch in batches:
            paths, blocks = batch.column(0).dictionary_encode(), batch.column(1).to_numpy(zero_copy_only=False)
            code = paths.indices.to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero((code[1:] != code[:-1]) | (blocks[1:] != blocks[:-1])) + 1).tolist(), len(batch)]
            for low, high in zip(edges, edges[1:]):
                if low == high:
                    continue
                here = (paths.dictionary[int(code[low])].as_py(), int(blocks[low]))
                if here != now:
                    if cut is not None:
                        yield batch_of(cut.end())
                    now, cut = here, cutter(batch.column(2)[low].as_py())
                yield batch_of(cut.feed(batch.column(3).slice(low, high - low)))
        if cut is not None:
            yield batch_of(cut.end())

    return run


def pieces(lines: DataFrame, step: Column, cutter: Callable[[int], CsvCutter | JsonCutter], parity: bool = False) -> DataFrame:
    """Whole records and elements of ``lines``: path, block, place and text.

    ``step`` is what a line adds to the state; ``parity`` keeps only whether the sum is odd.
    """
    total = F.sum(step).cast("long")
    splits = lines.groupBy("path", "block").agg((total % 2 if parity else total).alias("step"))
    before = F.coalesce(F.sum("step").over(W.partitionBy("path").orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    states = stage(splits.select("path", "block", (before % 2 if parity else before).alias("state")))
    # One row, about the length of its path, for each split of the text: a millionth of it.
    placed = lines.join(F.broadcast(states), ["path", "block"]).select("path", "block", "state", "value")
    found = stage(placed.mapInArrow(_cutting(cutter), _PIECES))
    # At most two pieces for each split; those of one record follow the piece that begins it.
    parts = found.where(F.col("kind") != WHOLE)
    in_order = W.partitionBy("path").orderBy("block", F.desc("kind"))
    chained = parts.withColumn("chain", F.sum(F.when(F.col("kind") == TAIL, 1).otherwise(0)).over(in_order)).where("chain > 0")
    ordered = F.array_sort(F.collect_list(F.struct("block", (-F.col("kind")).alias("turn"), "text")))
    joined = chained.groupBy("path", "chain").agg(
        F.min("block").alias("block"), F.min_by("place", "block").alias("place"), F.array_join(ordered["text"], "\n").alias("text")
    )
    return found.where(F.col("kind") == WHOLE).select("path", "block", "place", "text").unionByName(joined.drop("chain"))


def read_split_parts(spark: SparkSession, path: str | list[str], pattern: str | None = "*_part*.csv") -> DataFrame:
    """CSV parts of a folder, as :func:`regionpulse.sources.readers.read_raw_parts` gives them, but in splits.

    Line breaks inside quotes are kept.  Headers come from the records themselves, and parts are told apart by them, so
    no list of files is made; the number of different headers is the number of reads of the cut records.
    """
    lines = _lines(spark, path, pattern)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    records = pieces(lines, quotes, CsvCutter, parity=True).where(F.trim("text") != "")
    first = F.min_by("text", F.struct("block", "place"))
    heads = stage(records.where("block = 0").groupBy("path").agg(first.alias("header"), F.min("place").alias("at")))
    names = [r.header for r in heads.select("header").distinct().collect()]
    if not names:
        raise FileNotFoundError(f"no readable part file in {path!r}")
    integers = {f.name for f in RAW_NEWS if isinstance(f.dataType, T.IntegerType)}

    def clean(name: str) -> Column:
        value = F.col("fila").getField(name)
        value = F.when(~value.isin("", "nan"), value)
        return (value.try_cast("int") if name in integers else value).alias(name)

    def read(header: str) -> DataFrame:
        columns = [n.lstrip("﻿") for n in next(csv.reader([header]))]
        schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in (*columns, _TOO_MANY))
        parsed = F.from_csv("text", schema, {"quote": '"', "escape": '"'})
        mine = F.broadcast(heads.where(F.col("header") == header).select(F.col("path").alias("_path"), "at"))
        body = records.join(mine, F.col("path") == F.col("_path")).where("block > 0 OR place > at")
        position = F.struct(F.col("path").alias("archivo"), F.col("block").alias("bloque"), F.col("place").alias("fila"))
        rows = body.select(position.alias(SOURCE_ORDER), F.explode(F.array(parsed)).alias("fila"))
        return rows.where(F.col("fila").getField(_TOO_MANY).isNull()).select(*[clean(n) for n in columns], SOURCE_ORDER)

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [read(h) for h in sorted(names)])


def read_split_geojson(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    """Landed earthquakes, in files of one document a line or in collections that span lines, or both.

    A line or element that does not parse fails the read.  Elements without ``properties`` are no earthquakes.
    """
    lines = _lines(spark, path, pattern)
    bare = F.regexp_replace("value", _STRING, "")
    depth = F.length(F.regexp_replace(bare, r"[^\[{]", "")) - F.length(F.regexp_replace(bare, r"[^\]}]", ""))
    feature = QUAKE_GEOJSON["features"].dataType.elementType
    fields = T.StructType([*QUAKE_GEOJSON.fields, *feature.fields, T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json("text", fields, {"columnNameOfCorruptRecord": "_corrupt"})
    rows = pieces(lines, depth, JsonCutter).select(F.explode(F.array(parsed)).alias("d")).select("d.*")
    lost = F.col("_corrupt").isNotNull() & F.col("features").isNull() & F.col("properties").isNull()
    rows = rows.where(F.when(lost, F.raise_error(F.lit("GeoJSON that does not parse")).cast("boolean")).otherwise(True))
    alone = F.array(F.struct(*[F.col(f.name) for f in feature.fields]))
    return explode_quake_documents(rows.select(F.coalesce("features", F.when(F.col("properties").isNotNull(), alone)).alias("features")))


# The functions travel to the executors by value, so that these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
