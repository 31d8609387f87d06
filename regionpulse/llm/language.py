"""Language of texts by the nearest of several centroids per language.

A text is a vector of hashed one-, two- and three-letter sequences of its words, with the square root of the count
times the inverse document frequency, scaled to length one.  Document frequencies are counted over all training
texts; the centroids are found by k-means, per language, over a bounded sample of its different texts (``SAMPLE`` per
language, ``TOTAL`` over all languages, chosen by a hash of the text).  Every language that has a text with a letter
gets a centroid, also if there are more than ``TOTAL`` languages or all its texts are copies of a few.  A text gets the language of the centroid with
the largest cosine; one with a cosine under ``least`` is rejected as ``und``.  ``least`` 0 rejects only what has no
vector at all: a null text, or one without letters.

Texts without a language, or with a null one, teach nothing.  With nothing learned every text is ``und``.  Ties go to
the language that comes first in the alphabet.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regionpulse.llm.common import carried, restored, ship, table, text_batches
from regionpulse.llm.toxicity import held_out
from regionpulse.session import stage

SLOTS = 4096
CENTROIDS = 3
#: Sampled different training texts per language, and over all languages (but one per language at least).
SAMPLE = 400
TOTAL = 4_000
ROUNDS = 8
SEED = 23
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
#: For Java, whose Unicode version may not know a letter yet.
MAYBE_LETTER = r"[\p{L}\p{Cn}]"


def letters() -> np.ndarray:
    """Whether each character of the first plane is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(1 << 16)), bool, 1 << 16)


def counts(text: str | None, known: np.ndarray) -> np.ndarray | None:
    """How often each slot's sequences occur; None without a letter."""
    if not text or not any(m.group().isalpha() for m in LETTER.finditer(text)):
        return None
    c = np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), np.uint32)
    is_letter = known[np.minimum(c, 0xFFFF)] | (c > 0xFFFF)
    c = np.where(is_letter, c, 32)
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    keep[0] = True
    c = c[keep].astype(np.uint32)
    one = c * np.uint32(2654435761)
    two = (one[:-1] ^ (c[1:] * np.uint32(2246822519))) * np.uint32(3266489917)
    three = (two[:-1] ^ (c[2:] * np.uint32(668265263))) * np.uint32(374761393)
    shift = np.uint32(32 - SLOTS.bit_length() + 1)
    return np.bincount(np.concatenate([one >> shift, two >> shift, three >> shift]), minlength=SLOTS)


def vector(found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.sqrt(found).astype(np.float32) * idf
    return x / max(float(np.linalg.norm(x)), 1e-12)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known, df, n = letters(), np.zeros(SLOTS + 1, np.int64), 0
    for batch in batches:
        for text in batch.column(0):
            found = counts(text.as_py(), known)
            if found is not None:
                df[:SLOTS] += found > 0
                df[SLOTS] += 1
    slots = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int32)), pa.array(df[slots])], ["slot", "n"])


def frequencies(training: DataFrame) -> np.ndarray:
    """Inverse document frequency of each slot over all training texts; each task sends one row a slot."""
    total = training.select("text").mapInArrow(_frequencies, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    df = np.zeros(SLOTS + 1)
    for row in total.toLocalIterator():
        df[row.slot] = row.n
    return (np.log((1 + df[SLOTS]) / (1 + df[:SLOTS])) + 1).astype(np.float32)


def _vectors(idf):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = letters()
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                found = [counts(t.as_py(), known) for t in part.column(2)]
                rows = [None if x is None else vector(x, idf).tobytes() for x in found]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(rows, pa.binary())], ["lang", "h", "vector"])

    return run


def _clustered(group: pd.DataFrame) -> pd.DataFrame:
    """k-means by cosine over one language's sample."""
    group = group.sort_values(["h", "vector"])
    x = np.vstack([np.frombuffer(v, np.float32) for v in group["vector"]])
    centres = x[:: max(1, len(x) // CENTROIDS)][:CENTROIDS].copy()
    for _ in range(ROUNDS):
        nearest = (x @ centres.T).argmax(1)
        for k in range(len(centres)):
            if (nearest == k).any():
                mean = x[nearest == k].mean(0)
                centres[k] = mean / max(float(np.linalg.norm(mean)), 1e-12)
    return pd.DataFrame({"lang": group["lang"].iloc[0], "centre": [c.tobytes() for c in centres]})


def train(docs: DataFrame, sample: int = SAMPLE, total: int = TOTAL) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Inverse document frequencies, and the language and place of each centroid, learned from ``text`` and ``lang``."""
    text_batches(docs.sparkSession)
    training = docs.where("text IS NOT NULL AND lang IS NOT NULL").select(
        F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), F.xxhash64("text", F.lit(SEED)).alias("h")
    )
    idf = frequencies(training)
    # The draw is by a hash of the text, so shares are of different texts, not of rows.
    lettered = training.where(F.col("text").rlike(MAYBE_LETTER))
    sizes = stage(lettered.select("lang", "h").distinct().groupBy("lang").count())
    n_langs = sizes.count()
    each = max(1, min(sample, total // max(1, n_langs)))
    if not n_langs:
        return idf, [], np.zeros((0, SLOTS), np.float32)
    # Hashes are uniform: those under the limit are about twice the sample, from which the first ones are taken.
    limits = sizes.select("lang", F.least(F.lit(1.0), (2.0 * each + 50.0) / F.col("count")).alias("share"))
    near = lettered.join(F.broadcast(limits), "lang").where(F.pmod("h", F.lit(1 << 40)) < F.col("share") * float(1 << 40))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    some = near.select("lang", "h", "text").dropDuplicates(["lang", "h"])
    vectors = some.mapInArrow(_vectors(idf), "lang string, h long, vector binary").where("vector IS NOT NULL")
    chosen = stage(vectors.withColumn("r", rank).where(F.col("r") <= each).drop("r"))
    found = chosen.groupBy("lang").applyInPandas(_clustered, "lang string, centre binary").orderBy("lang", "centre").collect()
    if not found:
        return idf, [], np.zeros((0, SLOTS), np.float32)
    return idf, [r.lang for r in found], np.vstack([np.frombuffer(r.centre, np.float32) for r in found])


def _predictor(sent, least: float):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        idf, langs, centres = sent.value
        known = letters()
        for texts in batches:
            names, scores = [], []
            for text in texts:
                found = counts(text, known)
                best, score = UNKNOWN, 0.0
                if found is not None and langs:
                    cosines = centres @ vector(found, idf)
                    k = int(cosines.argmax())
                    score = float(min(1.0, max(0.0, cosines[k])))
                    best = langs[k] if score >= least else UNKNOWN
                names.append(best)
                scores.append(score)
            yield pd.DataFrame({"lang_pred": names, "score": np.asarray(scores, "float64")})

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, "lang_pred string, score double")


def identify(docs: DataFrame, model, least: float = 0.0) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the cosine of the nearest centroid; columns of these names are replaced."""
    text_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop("lang_pred", "score")
    found = kept.select(*carried(kept), _predictor(sent, least)(F.col("text").cast("string")).alias("found"))
    return found.select(*restored(kept), "found.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents")
    out = held_out("doc_id", 4, 2)
    model = train(docs.where(~out).select("text", "lang"))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", out.alias("held_out"), "lang_pred", "score")


ship(__name__)
