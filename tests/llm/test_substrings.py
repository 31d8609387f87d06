from __future__ import annotations

import hashlib
import random

from pyspark.sql import functions as F

from regionpulse.llm import substrings
from regionpulse.llm.substrings import WINDOW


def brute(rows):
    """Per row: words, removed words, digest of what is kept."""
    rows = [(i, (t or "").encode().split()) for i, t in rows]
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    seen, out = {}, {}
    for k in order:
        words = rows[k][1]
        gone = set()
        for a in range(len(words) - WINDOW + 1):
            window = tuple(words[a : a + WINDOW])
            if seen.setdefault(window, (rows[k][0], a)) != (rows[k][0], a):
                gone.update(range(a, a + WINDOW))
        kept = b" ".join(w for p, w in enumerate(words) if p not in gone)
        out[k] = (rows[k][0], len(words), len(gone), hashlib.sha256(kept).hexdigest())
    return sorted(out.values(), key=str)


def run(spark, path):
    return sorted(map(tuple, substrings.query(spark, path).collect()), key=str)


def passages(rng, n, vocabulary):
    words = [f"w{k}" for k in range(vocabulary)]
    shared = [rng.choices(words, k=rng.randint(19, 60)) for _ in range(6)]
    rows = []
    for i in range(n):
        text = rng.choices(words, k=rng.randint(0, 80))
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(text))
            text[at:at] = rng.choice(shared)
        rows.append((i, rng.choice([" ", "\n", "\t ", "\x0b"]).join(text)))
    return rows


def test_like_brute_force(spark, folder):
    rng = random.Random(3)
    rows = passages(rng, 120, 500) + [(500 + i, t) for i, t in passages(rng, 30, 2)]
    rows += [(900, "again " * 300), (901, "again " * 300), (902, "a b c " * 90), (903, None), (904, ""), (905, "\x1c".join(["x"] * 40)), (None, "again " * 25)]
    assert run(spark, folder(rows)) == brute(rows)


def test_frequent_sequences_change_nothing(spark, docs):
    rows = passages(random.Random(4), 100, 40)
    a, b = (
        sorted((r.doc_id, r.n_removed, r.kept) for r in substrings.dedup(docs(rows), often).collect()) for often in (3, 10_000)
    )
    assert a == b and sum(r[1] for r in a) > 0


def test_repeated_rows_are_one_document(spark, folder):
    text = " ".join(f"v{k}" for k in range(50))
    assert [r[2] for r in run(spark, folder([(1, text), (1, text)]))] == [0, 0]
    assert [r[2] for r in run(spark, folder([(1, text), (1, text), (2, text)]))] == [0, 0, 50]


def test_long_text_and_empty_table(spark, folder):
    rng = random.Random(5)
    long = " ".join(rng.choices([f"u{k}" for k in range(20_000)], k=60_000))
    tail = " ".join(long.split()[40_000:40_100])
    assert run(spark, folder([(1, long), (2, "x " + tail)])) == brute([(1, long), (2, "x " + tail)])
    assert run(spark, folder([])) == []


def test_only_repeated_minimisers_send_strings(spark, docs):
    rows = [(i, " ".join(f"d{i}w{k}" for k in range(60))) for i in range(20)]
    keyed = docs(rows).select(F.col("doc_id").alias("handle"), F.col("text").cast("binary").alias("raw"))
    sent = spark.sparkContext.broadcast(substrings.frequent(keyed))
    assert substrings._candidates(keyed, sent).count() == 0
