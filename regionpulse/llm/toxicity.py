"""Toxicity scores of a factorization machine over hashed terms.

A document is the set of its lower-case words and of the first letters of longer words, hashed into ``BUCKETS``.  The
score is the logistic function of  w0 + sum of w_i + sum over pairs of <v_i, v_j>:  the vectors v let two terms count
together that say little alone, such as an insult and the mention of a group.  The pair sum takes time linear in the
number of terms.  Pairs of terms that say nothing alone are found by their own counts.  The model is fitted on a bounded sample of labelled documents (``SAMPLE`` of each label, chosen by
a hash of the id) and sent to the tasks that score all documents; it has ``BUCKETS * (FACTORS + 1)`` numbers at most
and in fact only those of the buckets that tell toxic training documents from others, alone or beside another term.

A null or empty text has no terms and gets the toxic share of the labels as its score; a label without a document, or null, teaches
nothing; several labels of one id count as toxic if one is.  With no label at all, or of one kind only, every score is
the (smoothed) share of toxic ones, a quarter without any, and ``non_toxic`` keeps every document.  Null ids belong to
the held-out part.  Texts of any length are scored whole; each row is scored by itself, so repeated rows get the same
score, and an empty table gives an empty one.  Further columns may have any names.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regionpulse.llm.common import carried, restored, ship, table, text_batches
from regionpulse.session import stage

BUCKETS = 1 << 20
FACTORS = 4
#: Labelled documents of each label that the model is fitted on, at most.
SAMPLE = 5_000
#: Training documents that a bucket must occur in.
LEAST_DOCS = 3
PREFIX = 5
#: Deviations by which a bucket's share of toxic documents must differ from the share of all.
SIGNIFICANT = 4.0
#: The most frequent buckets are looked at in pairs, if they have so many documents, and by so many deviations of a pair.
PAIR_TERMS = 2048
PAIR_DOCS = 20
PAIR_SIGNIFICANT = 6.0
#: Loss, as a part of the plainer machine's, under which pairs count as better.
BETTER = 0.95
#: Toxic share before any label is seen, with the weight of one label.
PRIOR = 0.25
#: Largest weight of a toxic example where there are fewer of them.
UPWEIGHT = 4.0
EPOCHS = 15
RATE = 0.15
PAIR_RATE = 0.03
DECAY = 1e-4
SEED = 11
WORD = re.compile(r"[^\W\d_]+")


def terms(text: str | None) -> np.ndarray:
    """The distinct buckets of a text."""
    words = set(WORD.findall((text or "").lower()))
    words |= {w[:PREFIX] + "+" for w in words if len(w) > PREFIX}
    return np.unique(np.fromiter((zlib.crc32(w.encode()) % BUCKETS for w in words), np.int32, len(words)))


@dataclass
class Machine:
    """The fitted numbers; ``places`` gives a bucket's row, 0 for buckets that have none.

    ``base`` is the margin of a text without words; ``learned`` is false where the labels were missing or all alike.
    """

    constant: float
    places: np.ndarray
    weights: np.ndarray
    vectors: np.ndarray
    base: float
    learned: bool

    def margin(self, buckets: np.ndarray) -> float:
        if not len(buckets):
            return self.base
        rows = self.places[buckets]
        rows = rows[rows > 0]
        v = self.vectors[rows]
        total = v.sum(0)
        return float(self.constant + self.weights[rows].sum() + 0.5 * (total @ total - (v * v).sum()))

    def score(self, text: str | None) -> float:
        return _logistic(self.margin(terms(text)))


def _deviation(examples: list[tuple[np.ndarray, int]]) -> np.ndarray:
    """By how many deviations each bucket's toxic documents are more than its share; 0 for rare buckets."""
    every = np.bincount(np.concatenate([b for b, _ in examples]), minlength=BUCKETS)
    toxic = np.bincount(np.concatenate([b for b, y in examples if y]), minlength=BUCKETS)
    share = sum(y for _, y in examples) / len(examples)
    spread = np.sqrt(every * share * (1 - share) + 0.25)
    return np.where(every >= LEAST_DOCS, (toxic - every * share) / spread, 0.0)


def telling(examples: list[tuple[np.ndarray, int]]) -> np.ndarray:
    """Buckets that tell toxic documents from others, in all documents or among those that hold a telling one.

    The second part finds terms that say nothing by themselves and much beside another one.
    """
    alone = _deviation(examples)
    strong = alone >= SIGNIFICANT
    beside = [(b, y) for b, y in examples if strong[b].any()]
    mixed = 0 < sum(y for _, y in beside) < len(beside)
    together = _deviation(beside) if mixed else np.zeros(BUCKETS)
    return np.flatnonzero(np.maximum(np.abs(alone), np.abs(together)) >= SIGNIFICANT)


def partners(examples: list[tuple[np.ndarray, int]], machine: Machine) -> np.ndarray:
    """Buckets of pairs whose documents are toxic more, or less, often than ``machine`` says.

    Only the ``PAIR_TERMS`` most frequent buckets are looked at, the ones that can bear out a pair.
    """
    every = np.bincount(np.concatenate([b for b, _ in examples]), minlength=BUCKETS)
    common = np.argsort(-every, kind="stable")[:PAIR_TERMS]
    common = common[every[common] >= PAIR_DOCS]
    at = np.full(BUCKETS, -1)
    at[common] = np.arange(len(common))
    excess, spread = np.zeros((2, len(common), len(common)), np.float32)
    for k in range(0, len(examples), 1024):
        part = examples[k : k + 1024]
        likely = np.array([_logistic(machine.margin(b)) for b, _ in part])
        has = np.zeros((len(part), len(common)), np.float32)
        for row, (b, _) in zip(has, part):
            row[at[b][at[b] >= 0]] = 1
        excess += has.T @ (has * (np.array([y for _, y in part]) - likely)[:, None].astype(np.float32))
        spread += has.T @ (has * (likely * (1 - likely))[:, None].astype(np.float32))
    far = np.abs(excess) >= PAIR_SIGNIFICANT * np.sqrt(spread + 1)
    np.fill_diagonal(far, False)
    return common[far.any(0)]


def _logistic(margin: float) -> float:
    return 1 / (1 + math.exp(-max(-35.0, min(35.0, margin))))


def _loss(machine: Machine, examples: list[tuple[np.ndarray, int]]) -> float:
    return -sum(math.log(_logistic(machine.margin(b) * (1 if y else -1))) for b, y in examples)


def fit(examples: list[tuple[np.ndarray, int]], epochs: int = EPOCHS, share: float | None = None) -> Machine:
    """A machine over the buckets that tell alone or beside a telling one, and over those that tell only in pairs.

    The latter join if four fifths of the examples explain the last fifth better with them.  Where pairs tell, the
    constant is learned as well if that halves the loss once more: then documents with neither term tell too.
    """
    positive = sum(y for _, y in examples)
    share = (positive + PRIOR) / (len(examples) + 1) if share is None else share
    if not 0 < positive < len(examples):
        return _descent(examples, np.zeros(0, np.int64), 0, share)
    used, free = telling(examples), False
    learn, judge = [e for k, e in enumerate(examples) if k % 5], examples[::5]
    if 0 < sum(y for _, y in learn) < len(learn):
        plain = _descent(learn, used, epochs, share)
        more = np.union1d(used, partners(learn, plain))
        if len(more) > len(used):
            best = BETTER * _loss(plain, judge)
            if (loss := _loss(_descent(learn, more, epochs, share), judge)) < best:
                used, best = more, loss
            if _loss(_descent(learn, more, epochs, share, True), judge) < best / 2:
                used, free = more, True
    return _descent(examples, used, epochs, share, free)


def _descent(examples: list[tuple[np.ndarray, int]], used: np.ndarray, epochs: int, share: float, free: bool = False) -> Machine:
    """Logistic loss, one example at a time, with a rate for each number that falls with its past gradients.

    The constant starts at the odds of ``share``, the toxic part of all labelled documents.  Unless it is ``free`` it
    stays there, so that a text without a telling term gets that share however the sample was drawn.
    """
    positive = sum(y for _, y in examples)
    up = min(UPWEIGHT, (len(examples) - positive) / positive) if positive else 1.0
    constant = math.log(share / (1 - share))
    places = np.zeros(BUCKETS, np.int32)
    places[used] = np.arange(1, len(used) + 1)
    rng = np.random.default_rng(SEED)
    w = np.zeros(len(used) + 1)
    v = rng.normal(0, 0.05, (len(used) + 1, FACTORS))
    v[0] = 0
    gw, gv, gc = np.full(len(w), 1e-2), np.full(v.shape, 1e-2), 1e-2
    rows = [places[b] for b, _ in examples]
    rows = [r[r > 0] for r in rows]
    for _ in range(epochs):
        for k in rng.permutation(len(examples)):
            r, y = rows[k], examples[k][1]
            vr = v[r]
            total = vr.sum(0)
            margin = constant + w[r].sum() + 0.5 * (total @ total - (vr * vr).sum())
            slope = (_logistic(margin) - y) * (up if y else 1.0)
            step = slope + DECAY * w[r]
            gw[r] += step * step
            w[r] -= RATE * step / np.sqrt(gw[r])
            pair = slope * (total - vr) + DECAY * vr
            gv[r] += pair * pair
            v[r] -= PAIR_RATE * pair / np.sqrt(gv[r])
            if free:
                gc += slope * slope
                constant -= RATE * slope / math.sqrt(gc)
    return Machine(float(constant), places, w, v, math.log(share / (1 - share)), 0 < positive < len(examples))


def _terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = pa.array([terms(t.as_py()) for t in batch.column(2)], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), found], ["doc_id", "toxic", "terms"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """Fits on at most ``sample`` documents of each label; only their terms reach the driver."""
    text_batches(docs.sparkSession)
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    some = stage(known.where("toxic = 0").orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(sample).unionAll(
        known.where("toxic = 1").orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(sample)
    ))
    # The sample is bounded by its parameter, 12 bytes a row.
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(some), "doc_id")
    rows = chosen.select("doc_id", "toxic", "text").mapInArrow(_terms_of, "doc_id long, toxic int, terms array<int>").toArrow()
    rows = rows.sort_by([("doc_id", "ascending"), ("toxic", "ascending")])
    sizes = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = (sizes.get(1, 0) + PRIOR) / (sum(sizes.values()) + 1)
    return fit([(t.values.to_numpy(), int(y.as_py())) for y, t in zip(rows["toxic"], rows["terms"])], share=share)


def _scorer(sent):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine = Machine(*sent.value)
        for texts in batches:
            yield pd.Series([machine.score(t) for t in texts], dtype="float64")

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "double")


def scored(docs: DataFrame, machine: Machine, name: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text as a column."""
    text_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(astuple(machine))
    return docs.withColumn(name, _scorer(sent)(F.col("text").cast("string")))


def held_out(doc_id: str = "doc_id", parts: int = 5, part: int = 0) -> Column:
    """Whether the checksum of the id, as text, leaves the remainder ``part``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(parts)) == part


def non_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents with a score under a half, same columns; learns from the labels that are not held out.

    Without labels, or with labels of one kind only, nothing is known of toxic texts and every document stays.
    """
    machine = train(docs, labels.where(~held_out()))
    if not machine.learned:
        return docs
    rows = docs.select(*carried(docs), "text")
    return scored(rows, machine).where("score < 0.5").select(*restored(docs))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score, part and decision of every document."""
    docs = table(spark, sf_dir, "documents")
    machine = train(docs, table(spark, sf_dir, "labels").where(~held_out()))
    return scored(docs.select("doc_id", "text"), machine).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


ship(__name__)
