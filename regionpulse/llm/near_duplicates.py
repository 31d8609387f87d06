"""Near duplicates by bottom-k sketches of one hash function.

A document is the set of its five-word shingles, hashed to 63 bits; its sketch is the ``K`` smallest values.  Equal sets
are one node.  Inverted lists of retained values generate overlaps between nodes, the union sketch (the K smallest
values of both) estimates their similarity, and the full sets confirm or refute every remaining pair.

A linked pair shares about three quarters of its retained values, and with near certainty (six standard deviations)
more than ``LEAST`` of them.  So a document may leave out up to that share of its values from the lists: those in long
lists (over ``LONG`` nodes), as passages that many documents share make them.  The bound on a pair's overlap counts the
ones left out as shared.  Documents with more long values than that ("heavy" ones: large groups of near copies, or
texts that consist of common passages) also meet in their long lists:

* each is compared with a leader of each of its ``KEYS`` smallest long lists, which joins large groups in linear work;
* lists whose members are then still in different components are gone through in blocks of ``BLOCK`` members by block
  pairs, which compare the full sets across components and give the links that join their components, not all pairs.

Links inside a component change nothing, so this loses none that counts.  Other pairs are only written when their
estimate calls for a check, first each node's best pair and then those that still connect different components.

Words are runs of anything but the six ASCII white-space characters, A to Z in lower case.  A text with one to four
words is one shingle; texts without words, and nulls, are linked with nothing.  Rows with equal ids and texts are one
node; null ids come last.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType

from regionpulse.llm.common import LAST, carried, id_of, release, restored, ship, table, text_batches, text_of
from regionpulse.llm.components import components
from regionpulse.session import sized, stage

SHINGLE = 5
K = 64
#: Similarity of linked documents in hundredths.
PERCENT = 75
#: Share of retained values that a linked pair has in common at least.
LEAST = 0.39
#: Estimates are let through from here on; at K values the deviation is 0.054.
ESTIMATE = 0.45
LONG = 32
KEYS = 10
BLOCK = 500
#: Shingles that a block comparison lays out at once.
COLUMNS = 4_096
#: A row with a sketch or a set of shingles counts as so many when files are dealt out.
WIDE = 20


def shingles(text: str | bytes | None) -> np.ndarray:
    """The sorted hashes of a text's shingles."""
    words = (text.encode() if isinstance(text, str) else text or b"").lower().split()
    if not words:
        return np.zeros(0, np.int64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(SHINGLE, len(w))
    h = np.zeros(len(w) - width + 1, np.uint64)
    for k in range(width):
        h = (h ^ w[k : len(w) - width + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(((h ^ (h >> np.uint64(32))) >> np.uint64(1)).astype(np.int64))


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingles(t.as_buffer().to_pybytes()) for t in batch.column(2)]
        groups = [hashlib.blake2b(s.tobytes(), digest_size=12).hexdigest() for s in sets]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array(groups),
                pa.array([s[:K] for s in sets], pa.list_(pa.int64())),
            ],
            ["doc_id", "text", "n", "g", "sketch"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            sets = [shingles(t.as_buffer().to_pybytes()).tobytes() for t in part.column(0)]
            groups = [hashlib.blake2b(s, digest_size=12).hexdigest() for s in sets]
            yield pa.RecordBatch.from_arrays([pa.array(groups), pa.array(sets, pa.binary())], ["g", "full"])


@F.pandas_udf(DoubleType())
def _estimate(a: pd.Series, b: pd.Series) -> pd.Series:
    def one(x, y):
        both = np.union1d(x, y)[:K]
        return float(np.isin(both, np.intersect1d(x, y, True)).mean())

    return pd.Series([one(x, y) for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(BooleanType())
def _linked(a: pd.Series, b: pd.Series) -> pd.Series:
    def one(x, y):
        x, y = np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)
        shared = len(np.intersect1d(x, y, True))
        return 100 * shared >= PERCENT * (len(x) + len(y) - shared)

    return pd.Series([one(x, y) for x, y in zip(a, b)], dtype="bool")


def _alike(a: str, b: str):
    """Sizes that allow the similarity."""
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


class _Job:
    """Tables of one run: every step is written to the shared folder and read again."""

    def __init__(self, docs: DataFrame):
        text_batches(docs.sparkSession)
        self.raw = docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("text"), text_of().cast("binary").alias("raw")
        )
        rows = stage(self.raw.mapInArrow(_sketched, "doc_id long, text long, n long, g string, sketch array<long>"))
        self.documents = rows.select("doc_id", "text", "n", "g")
        self.rows = rows.count()
        firsts = rows.where("n > 0").groupBy("g").agg(F.min(id_of()).alias("id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
        self.nodes = stage(firsts.select(F.struct("id", "g").alias("node"), "n", "sketch"), rows=WIDE * self.rows)

    def labels(self) -> DataFrame:
        """``node`` and ``label``: the smallest node of the component of every node that is linked to a smaller one."""
        spark, most = self.nodes.sparkSession, K * self.rows
        values = self.nodes.select("node", "n", F.size("sketch").alias("k"), F.explode("sketch").alias("v"))
        lists = stage(values.groupBy("v").agg(F.count("*").alias("length")).where("length > 1"), rows=most // 2)
        held = stage(values.join(lists, "v"), rows=most)
        long = held.where(F.col("length") > LONG)
        burden = stage(long.groupBy("node").agg(F.count("*").alias("n_long"), F.first("k").alias("k")).select("node", "n_long", (F.col("n_long") >= LEAST * F.col("k")).alias("heavy")), rows=self.rows)
        short = stage(
            held.where(F.col("length") <= LONG).select("v", "node", "n", "k").join(burden, "node", "left")
            .select("v", "node", "n", "k", F.coalesce("n_long", F.lit(0)).alias("n_long")),
            rows=most,
        )
        release(spark)
        a, b = (short.select("v", *[F.col(c).alias(f"{c}_{x}") for c in ("node", "n", "k", "n_long")]) for x in "ab")
        pairs = a.join(b, "v").where(F.col("node_a") < F.col("node_b")).where(_alike("n_a", "n_b"))
        counted = pairs.groupBy(F.col("node_a").alias("a"), F.col("node_b").alias("b")).agg(
            (F.count("*") + F.first(F.least("n_long_a", "n_long_b"))).alias("most"), F.first(F.least("k_a", "k_b")).alias("k")
        )
        generated = counted.where(F.col("most") >= LEAST * F.col("k")).select("a", "b")
        heavy = stage(long.join(burden.where("heavy").select("node"), "node", "left_semi").groupBy("node").agg(
            F.first("n").alias("n"), F.slice(F.array_sort(F.collect_list("v")), 1, KEYS).alias("keys")
        ), rows=WIDE * self.rows)
        n_keyed = KEYS * heavy.count()
        keyed = heavy.select("node", "n", F.explode("keys").alias("v"))
        leaders = stage(keyed.groupBy("v").agg(F.min_by("node", F.xxhash64("v", "node")).alias("leader"), F.min_by("n", F.xxhash64("v", "node")).alias("n_leader"), F.count("*").alias("c")).where("c > 1"), rows=n_keyed // 2)
        led = keyed.join(leaders, "v").where(F.col("node") != F.col("leader")).where(_alike("n", "n_leader"))
        led = led.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b"))
        candidates = self.estimated(generated.unionAll(led).distinct())
        full = self.full_sets(
            candidates.select(F.col("a").alias("node")).unionAll(candidates.select(F.col("b").alias("node"))).unionAll(heavy.select("node")).distinct()
        )
        label = self.confirmed(candidates, full)
        rest = self.blocks(keyed, leaders, label, full, n_keyed)
        return label if rest is None else _joined(label, rest)

    def estimated(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose union sketch allows the similarity, with the estimate."""
        s = self.nodes.select("node", "sketch")
        both = pairs.join(s.withColumnsRenamed({"node": "a", "sketch": "sa"}), "a").join(s.withColumnsRenamed({"node": "b", "sketch": "sb"}), "b")
        return stage(both.select("a", "b", _estimate("sa", "sb").alias("estimate")).where(F.col("estimate") >= ESTIMATE), rows=K * self.rows)

    def full_sets(self, nodes: DataFrame) -> DataFrame:
        """The shingles of the given nodes, made again from their texts."""
        wanted = stage(nodes, rows=self.rows)
        rows = self.raw.withColumn("id", id_of()).join(wanted.select(F.col("node.id").alias("id")).distinct().hint("shuffle_hash"), "id", "left_semi").select("raw")
        sets = rows.mapInArrow(_sets, "g string, full binary").join(wanted.select("node", F.col("node.g").alias("g")), "g")
        full = stage(sets.groupBy("node").agg(F.first("full").alias("full")), rows=WIDE * self.rows)
        release(nodes.sparkSession)
        return full

    def confirmed(self, pairs: DataFrame, full: DataFrame) -> DataFrame:
        """Labels by the links among the pairs: each node's best pair first, then those that still join two components."""
        best = pairs.groupBy("b").agg(F.max_by("a", F.struct("estimate", "a")).alias("a"))
        label = components(self.exact(best.select("a", "b"), full, self.rows), self.rows)
        open_ = stage(_across(pairs.join(best, ["a", "b"], "left_anti"), label), rows=pairs.count())
        return _joined(label, self.exact(open_, full, max(self.rows, open_.count())))

    def exact(self, pairs: DataFrame, full: DataFrame, rows: int) -> DataFrame:
        """The pairs whose full sets are as similar as asked."""
        both = pairs.join(full.withColumnsRenamed({"node": "a", "full": "fa"}), "a").join(full.withColumnsRenamed({"node": "b", "full": "fb"}), "b")
        out = stage(both.where(_linked("fa", "fb")).select("a", "b"), rows=WIDE * rows)
        release(pairs.sparkSession)
        return out

    def blocks(self, keyed: DataFrame, leaders: DataFrame, label: DataFrame, full: DataFrame, n_keyed: int) -> DataFrame | None:
        """Links across components in long lists that still hold several."""
        members = keyed.join(leaders.select("v"), "v").join(label, "node", "left").select("v", "node", F.coalesce("label", "node").alias("label"))
        members = stage(members, rows=n_keyed)
        open_lists = stage(members.groupBy("v").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("size")).where("low <> high").select("v", "size"), rows=n_keyed // 2)
        n = F.ceil(F.col("size") / BLOCK)
        copies = open_lists.agg(F.sum(F.col("size") * n).alias("copies")).first().copies
        if not copies:
            return None
        rows = members.join(open_lists, "v").withColumn("mine", F.pmod(F.xxhash64("node"), n))
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), n - 1))).join(full, "node")
        rows = rows.select(
            "v", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "node", F.xxhash64("label").alias("label"), "full"
        )
        node = self.nodes.schema["node"].dataType.simpleString()
        return stage(rows.groupBy("v", "i", "j").applyInPandas(_block, f"a {node}, b {node}"), rows=WIDE * copies)


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of two blocks."""
    values, counts = np.unique(np.concatenate([*left, *right]), return_counts=True)
    values = values[counts > 1]
    out = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, len(values), COLUMNS):
        part = values[at : at + COLUMNS]

        def laid_out(sets):
            flat = np.concatenate(sets)
            rows = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
            place = np.minimum(np.searchsorted(part, flat), len(part) - 1)
            ok = part[place] == flat
            x = np.zeros((len(sets), len(part)), np.float32)
            x[rows[ok], place[ok]] = 1
            return x

        out += laid_out(left) @ laid_out(right).T
    return out


def _block(group: pd.DataFrame) -> pd.DataFrame:
    """Links between two blocks of one list that join different components, enough to connect them."""
    i, j = group["i"].iloc[0], group["j"].iloc[0]
    left = group[group["mine"] == i].reset_index(drop=True)
    right = group[group["mine"] == j].reset_index(drop=True)
    found = []
    if len(left) and len(right):
        a, b = ([np.frombuffer(x, np.int64) for x in side["full"]] for side in (left, right))
        shared = _shared(a, b)
        na, nb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
        ok = 100 * shared >= PERCENT * (na[:, None] + nb[None, :] - shared)
        la, lb = left["label"].to_numpy(), right["label"].to_numpy()
        ok &= la[:, None] != lb[None, :]
        root: dict[int, int] = {}

        def top(x):
            while root.get(x, x) != x:
                x = root[x]
            return x

        for r, c in zip(*np.nonzero(ok)):
            p, q = top(la[r]), top(lb[c])
            if p != q:
                root[max(p, q)] = min(p, q)
                found.append((left["node"][r], right["node"][c]))
    return pd.DataFrame({"a": [f[0] for f in found], "b": [f[1] for f in found]}, dtype=object)


def _joined(label: DataFrame, links: DataFrame) -> DataFrame:
    """The labels when further links are known; components that are known are stars, so few rounds are left."""
    known = label.select(F.col("node").alias("a"), F.col("label").alias("b")).unionAll(links.select("a", "b"))
    return components(known, known.count())


def _across(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """Pairs whose ends have different labels."""
    for side in "ab":
        pairs = pairs.join(label.withColumnsRenamed({"node": side, "label": f"label_{side}"}), side, "left")
    return pairs.where(F.coalesce("label_a", "a") != F.coalesce("label_b", "b")).select("a", "b")


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept and ``text`` (a hash) of every row of ``docs``."""
    job = _Job(docs)
    label = job.labels()
    homes = stage(
        job.nodes.select("node").join(label, "node", "left")
        .select(F.col("node.g").alias("g"), F.coalesce("label", "node").getField("id").alias("home")),
        rows=job.rows,
    )
    out = job.documents.join(homes, "g", "left")
    component = F.nullif(F.coalesce("home", "doc_id"), F.lit(LAST))
    out = out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), "text").withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    )
    return sized(out, WIDE * job.rows)


def dedup(docs: DataFrame) -> DataFrame:
    """One document of each group, the one with the smallest id; of rows that agree in id and text one stays.

    Documents without words are in no group: all of them stay, and so do those whose group has only null ids.  The row
    travels as it is, so further columns may have any names; an empty table gives an empty one.
    """
    key = ["_id", "_text"]
    found = stage(groups(docs.select("doc_id", "text")).select(
        id_of().alias("_id"), F.col("text").alias("_text"), (~F.col("kept") & F.col("component_id").isNotNull() & (F.col("n_shingles") > 0)).alias("goes")
    ))
    n = found.count()
    rows = docs.select(*carried(docs), id_of().alias("_id"), F.xxhash64(text_of()).alias("_text"))
    left = rows.join(stage(found.where("goes").select(*key).distinct(), rows=n).hint("shuffle_hash"), key, "left_anti")
    repeated = stage(found.where("NOT goes").groupBy(*key).count().where("count > 1").select(*key), rows=n)
    if repeated.take(1):
        left = left.join(repeated, key, "left_anti").unionByName(left.join(repeated, key, "left_semi").dropDuplicates(key))
    return left.select(*restored(docs))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_shingles", "component_id", "kept")


ORACLE = f"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents),
shingled AS (
  SELECT DISTINCT doc_id, md5(s) AS s FROM (
    SELECT doc_id, unnest([array_to_string(words[i:i + {SHINGLE - 1}], ' ') for i in range(1, greatest(len(words) - {SHINGLE - 2}, 2))]) AS s
    FROM split WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingled a JOIN shingled b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
linked AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= {PERCENT} * (x.n + y.n - c)),
either AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, either.b FROM reach JOIN either ON either.a = reach.r)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, m AS component_id, d.doc_id = m AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN (SELECT doc_id, min(r) AS m FROM reach GROUP BY doc_id) USING (doc_id)
"""

ship(__name__)
