from __future__ import annotations

import random
import zlib

import numpy as np

from regionpulse.llm import toxicity


def corpus(n, seed):
    """Toxic only where an insult meets the mention of a group; each alone is harmless."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = rng.choices([f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300)], k=40)
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words += ["insult"] * insult + ["group"] * group
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(insult and group)))
    return rows


def additive(machine, text):
    rows = machine.places[toxicity.terms(text)]
    return machine.constant + machine.weights[rows[rows > 0]].sum()


def test_pairs_count_beyond_single_terms():
    machine = toxicity.fit([(toxicity.terms(t), y) for _, t, y in corpus(1500, 1)], 15)
    fresh = corpus(600, 2)
    assert np.mean([(machine.score(t) >= 0.5) == y for _, t, y in fresh]) > 0.97
    pair = machine.margin(toxicity.terms("insult group")) - additive(machine, "insult group")
    assert pair > 0.5


def test_pairs_of_words_that_say_nothing_alone():
    """Toxic where both words or neither stand: no single word tells, and a sum of weights cannot."""
    def rows(n, seed):
        out = []
        for _, text, _ in corpus(n, seed):
            words = set(text.split())
            out.append((toxicity.terms(text), int(("insult" in words) == ("group" in words))))
        return out

    examples, fresh = rows(1500, 1), rows(600, 2)
    assert len(toxicity.telling(examples)) == 0
    machine = toxicity.fit(examples)
    assert np.mean([(machine.margin(b) >= 0) == y for b, y in fresh]) > 0.95


def test_pair_sum_equals_the_double_sum():
    machine = toxicity.fit([(toxicity.terms(t), y) for _, t, y in corpus(400, 3)])
    for _, text, _ in corpus(30, 4):
        rows = [r for r in machine.places[toxicity.terms(text)].tolist() if r]
        double = sum(float(machine.vectors[a] @ machine.vectors[b]) for k, a in enumerate(rows) for b in rows[:k])
        plain = machine.constant + sum(float(machine.weights[r]) for r in rows) + double
        assert abs(machine.margin(toxicity.terms(text)) - plain) < 1e-9


def test_nothing_goes_where_nothing_is_learned(spark, docs):
    df = docs([(1, "one two three"), (2, None), (3, "")])
    for labels in ([], [(1, 1, 1)], [(1, 1, 0), (2, 1, 0)], [(None, 1, 1), (3, 1, None)]):
        known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        assert toxicity.non_toxic(df, known).count() == 3
    assert toxicity.fit([]).score("word") == toxicity.PRIOR


def test_columns_of_any_name(spark, docs):
    rows = [(i, f"{'scum' if i % 3 == 0 else 'dear'} reader number {chr(97 + i % 26)}") for i in range(200)]
    names = ["score", "_score", "row", "toxic", "terms", "predicted", "found"]
    df = docs(rows).selectExpr("*", *[f"'{c}' {c}" for c in names])
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id long, toxic int").selectExpr("*", "'x' text", "1 terms")
    left = toxicity.non_toxic(df, labels)
    assert left.columns == df.columns
    assert {tuple(r[c] for c in names) for r in left.collect()} == {tuple(names)} and left.count() == 133


def test_texts_of_every_kind():
    machine = toxicity.fit([(toxicity.terms("bad thing"), 1), (toxicity.terms("good thing"), 0)] * 20)
    assert machine.score("so bad") > 0.5 > machine.score("so good")
    assert machine.score(None) == machine.score("") == machine.score("12 ... \n")
    assert 0 <= machine.score("bad " * 200_000) <= 1
    for examples in ([], [(toxicity.terms("a"), 1)] * 3, [(toxicity.terms("a"), 0)] * 3):
        assert 0 < toxicity.fit(examples).score("a b") < 1


def test_query(spark, folder, tmp_path):
    rows = [(i, f"{'scum' if i % 3 == 0 else 'dear'} reader number {chr(97 + i % 26)}") for i in range(300)]
    rows += [(None, "x"), (301, None), (302, ""), (303, "scum " * 20_000), (7, rows[7][1])]
    path = folder(rows)
    labels = [(i, 1, int(i % 3 == 0)) for i in range(300)] + [(None, 1, 1), (5, 1, None), (9999, 0, 1), (7, 1, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{path}/labels.parquet")
    out = toxicity.query(spark, path).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 0)
        assert r.predicted == int(r.score >= 0.5)
        if r.doc_id is not None and r.doc_id < 300:
            assert r.predicted == int(r.doc_id % 3 == 0)
    assert {r.doc_id: r.predicted for r in out}[303] == 1
    docs = spark.read.parquet(f"{path}/documents.parquet")
    left = toxicity.non_toxic(docs, spark.read.parquet(f"{path}/labels.parquet"))
    assert left.columns == docs.columns and left.count() == len(rows) - 101


def test_empty_tables(spark, folder):
    path = folder([])
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{path}/labels.parquet")
    assert toxicity.query(spark, path).count() == 0
