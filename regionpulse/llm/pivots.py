"""Near-duplicate vectors by a pivot-permutation index.

Reference vectors (pivots) are drawn from the data and thinned until no two are within cosine ``APART``, so that a
dense group has one pivot, or a few, that its members share, however many were drawn from it.  Every vector is described
by its ``NEAREST`` nearest pivots, in order, and every pivot has an inverted list.

Near vectors share at least ``SHARED`` of their pivots.  With the pivots of each ordered from the shortest list to the
longest, two that share so many have one in common among the first ``NEAREST - SHARED + 1``; so only these lists hold the
vector, and that of its nearest pivot, which the members of a dense group have in common.  The longest lists, which cost
most, hold few others.  A pair is compared in the list of the first pivot that both
prefixes have; the cosine in double precision decides.  Lists are gone through in blocks of about ``BLOCK`` vectors by
block pairs, so a pivot near a third of all vectors is many tasks.  A block pair gives counts of links and links that
connect its components, not all pairs.

Equal vectors are one entry with a multiplicity.  The number of pivots grows with the square root of the number of
vectors (``pivots_for``), which keeps the lists that short; pivots are a sample bounded by that number, while every
vector is indexed.  Of pairs at a cosine of just 0.9 in random directions 0.99 are found with 256 pivots and 0.96 with
4,096; pairs above 0.95 nearly all.  Vectors that are null, zero, or hold null or non-finite components link with
nothing.  Rows with a null id are rows of their own, which come last and have no component unless they are linked to one
with an id.  Vectors of other lengths than most are compared with those of their own length only.  An empty table gives
an empty one; only ``vec_id`` and ``embedding`` are read, so further columns may have any names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regionpulse.llm.common import LAST, id_of, ship, table
from regionpulse.llm.components import components
from regionpulse.session import stage

COSINE = 0.9
NEAREST = 10
SHARED = 5
#: No two pivots are nearer than this.  Below ``COSINE``: in a group that just misses it, drawn pivots would all be kept.
APART = 0.8
BLOCK = 1000
SEED = 5


def pivots_for(vectors: int) -> int:
    """Number of pivots for a number of vectors."""
    return max(32, 1 << math.ceil(math.log2(max(1.0, math.sqrt(vectors)))))


def _unit(values) -> np.ndarray:
    x = np.asarray(values, np.float64)
    x = x / np.abs(x).max()
    return x / np.linalg.norm(x)


def _thinned(drawn: np.ndarray, apart: float = APART) -> np.ndarray:
    """The drawn pivots without those within cosine ``apart`` of an earlier one that is kept."""
    kept = np.zeros(len(drawn), bool)
    near = np.zeros(len(drawn), bool)
    for k, pivot in enumerate(drawn):
        if not near[k]:
            kept[k] = True
            near |= drawn @ pivot >= apart
    return drawn[kept]


def _packed(values: np.ndarray) -> bytes:
    """A vector's bytes, in single precision where that is exact."""
    half = values.astype(np.float32)
    return half.tobytes() if (half == values).all() else values.tobytes()


def _unpacked(data: bytes, d: int) -> np.ndarray:
    return _unit(np.frombuffer(data, np.float32 if len(data) == 4 * d else np.float64))


def _described(sent, nearest: int):
    """The pivots of each vector, nearest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = sent.value
        for batch in batches:
            near, data, sizes = [], [], []
            for vector in batch.column(2).to_pylist():
                x = np.asarray(vector, np.float64)
                own = pivots.get(len(x))
                near.append(np.argsort(-(own @ _unit(x)), kind="stable")[:nearest].tolist() if own is not None else [0])
                data.append(_packed(x))
                sizes.append(len(x))
            columns = [pa.array(sizes, pa.int32()), pa.array(near, pa.list_(pa.int32())), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["node", "n", "d", "near", "data"])

    return run


def _listed(places, shared: int):
    """One row per vector and list that holds it, for each block pair it takes part in.

    ``places`` gives for each length and pivot its place in the order from the shortest list on, and its blocks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = places.value
        for batch in batches:
            at, rows = [], [[], [], [], [], [], []]
            keys = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(5).to_pylist())
            for k, (d, near, slot) in enumerate(keys):
                order = sorted(known[d, p] for p in near)
                prefix = sorted({*order[: max(1, len(order) - shared + 1)], known[d, near[0]]})
                for place, blocks in prefix:
                    mine = slot % blocks
                    for other in range(blocks):
                        at.append(k)
                        for column, value in zip(rows, (d, place, min(mine, other), max(mine, other), mine, [q for q, _ in prefix])):
                            column.append(value)
            taken = batch.take(pa.array(at, pa.int64()))
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            arrays = [pa.array(c, t) for c, t in zip(rows, kinds)]
            yield pa.RecordBatch.from_arrays([*arrays, taken.column(0), taken.column(1), taken.column(4)], ["d", "pivot", "i", "j", "mine", "prefix", "node", "n", "data"])

    return run


def _first_shared(a: np.ndarray, b: np.ndarray, pivot: int) -> np.ndarray:
    """Whether the rows of two tables of prefixes have no pivot in common that stands before ``pivot``."""
    out = np.ones(len(a), bool)
    for k in range(0, len(a), 100_000):
        x, y = a[k : k + 100_000], b[k : k + 100_000]
        out[k : k + 100_000] = ~((x[:, :, None] == y[:, None, :]) & (x < pivot)[:, :, None]).any((1, 2))
    return out


def _compared(cosine: float):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        """Links between two blocks of one list: per node its links, and a link to another node of its component."""
        i, j, pivot, d = (int(group[c].iloc[0]) for c in ("i", "j", "pivot", "d"))
        left = group[group["mine"] == i].reset_index(drop=True)
        right = left if i == j else group[group["mine"] == j].reset_index(drop=True)
        if not len(left) or not len(right):
            return pd.DataFrame({"node": [], "links": [], "other": []}, dtype=object)

        def sides(part):
            prefixes = np.vstack([np.pad(p, (0, wide - len(p)), constant_values=1 << 30) for p in part["prefix"]])
            return prefixes, np.vstack([_unpacked(x, d) for x in part["data"]])

        wide = int(group["prefix"].map(len).max())
        a, x = sides(left)
        b, y = (a, x) if i == j else sides(right)
        near = x @ y.T >= cosine
        rows, columns = np.nonzero(np.triu(near, 1) if i == j else near)
        own = _first_shared(a[rows], b[columns], pivot)
        rows, columns = rows[own], columns[own]
        names = [*left["node"], *([] if i == j else right["node"])]
        many = np.concatenate([left["n"], [] if i == j else right["n"]]).astype(np.int64)
        columns = columns + (0 if i == j else len(left))
        links = np.zeros(len(names), np.int64)
        np.add.at(links, rows, many[columns])
        np.add.at(links, columns, many[rows])
        root = list(range(len(names)))

        def top(k):
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        for r, c in zip(rows.tolist(), columns.tolist()):
            p, q = top(r), top(c)
            if p != q:
                root[max(p, q)] = min(p, q)
        found = np.flatnonzero(links).tolist()
        return pd.DataFrame({"node": [names[k] for k in found], "links": [int(links[k]) for k in found], "other": [names[top(k)] for k in found]}, dtype=object)

    return run


def grouped(vectors: DataFrame, cosine: float = COSINE, nearest: int = NEAREST, shared: int = SHARED, n_pivots: int | None = None) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors`` (vec_id, embedding)."""
    spark = vectors.sparkSession
    x = F.transform("embedding", lambda e: e.cast("double"))
    good = F.exists("embedding", lambda e: e != 0) & ~F.exists("embedding", lambda e: e.isNull() | F.isnan(e.cast("double")) | (F.abs(e.cast("double")) == float("inf")))
    digest = F.concat(F.hex(F.xxhash64("x")), F.hex(F.hash("x")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(good, F.col("embedding")).alias("embedding"), F.when(good, x).alias("x"))
    rows = rows.select("vec_id", id_of("vec_id").alias("id"), F.when(F.col("x").isNotNull(), digest).alias("g"), "embedding")
    entries = rows.where("g IS NOT NULL").groupBy("g").agg(F.min("id").alias("id"), F.count("*").alias("n"), F.first("embedding").alias("x"))
    entries = stage(entries.select(F.struct("id", "g").alias("node"), "n", "x"))
    total = entries.count()
    n_pivots = n_pivots or pivots_for(total)
    sizes = [r.d for r in entries.select(F.size("x").alias("d")).groupBy("d").count().orderBy(F.desc("count"), "d").limit(64).collect()]
    pivots = {}
    for d in sizes:
        drawn = entries.where(F.size("x") == d).orderBy(F.xxhash64("node.g", F.lit(SEED)), "node.g").limit(n_pivots).select("x").collect()
        pivots[d] = _thinned(np.vstack([_unit(r.x) for r in drawn]))
    sent = spark.sparkContext.broadcast(pivots)
    node = entries.schema["node"].dataType.simpleString()
    described = stage(entries.mapInArrow(_described(sent, nearest), f"node {node}, n long, d int, near array<int>, data binary"))
    # Vectors of different lengths never meet: the length is part of the list.  At most as many rows as pivots.
    lengths = described.select("d", F.explode("near").alias("pivot")).groupBy("d", "pivot").count().collect()
    in_order = sorted(lengths, key=lambda r: (r["count"], r.d, r.pivot))
    places = spark.sparkContext.broadcast({(r.d, r.pivot): (k, -(-r["count"] // BLOCK)) for k, r in enumerate(in_order)})
    slotted = described.withColumn("slot", F.pmod(F.xxhash64("node"), F.lit(1 << 40)))
    listed = slotted.mapInArrow(_listed(places, shared), f"d int, pivot int, i long, j long, mine long, prefix array<int>, node {node}, n long, data binary")
    compared = stage(listed.groupBy("d", "pivot", "i", "j").applyInPandas(_compared(cosine), f"node {node}, links long, other {node}"))
    links = compared.groupBy("node").agg(F.sum("links").alias("links"))
    label = components(compared.select(F.col("node").alias("a"), F.col("other").alias("b")))
    homes = stage(
        entries.select("node", "n").join(links, "node", "left").join(label, "node", "left").select(
            F.col("node.g").alias("g"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("label", "node").getField("id").alias("home")
        )
    )
    component = F.nullif(F.coalesce("home", "vec_id"), F.lit(LAST))
    return (
        rows.select("vec_id", "g").join(homes, "g", "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


ORACLE = f"""
WITH RECURSIVE good AS (
  SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0 AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
linked AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= {COSINE}),
reach AS (SELECT vec_id, vec_id AS r FROM embeddings UNION SELECT reach.vec_id, linked.b FROM reach JOIN linked ON linked.a = reach.r)
SELECT vec_id, (SELECT count(*) FROM linked WHERE a = vec_id)::BIGINT AS n_links, min(r) AS component_id, vec_id = min(r) AS kept
FROM reach GROUP BY vec_id
"""

ship(__name__)
