from __future__ import annotations

import random

from regionpulse.llm import near_duplicates as N


def sets(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    shingled = [(i, sets(t)) for i, t in rows]
    root = list(range(len(rows)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, (_, x) in enumerate(shingled):
        for b, (_, y) in enumerate(shingled[:a]):
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = sorted((top(a), top(b)), key=lambda k: rows[k][0])
                root[q] = p
    return sorted((i, len(s), rows[top(k)][0], i == rows[top(k)][0]) for k, (i, s) in enumerate(shingled))


def found(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect())


def copies(rng, base, n, least, most):
    """Copies of a text with some words changed."""
    out = []
    for _ in range(n):
        words = base.split()
        for _ in range(rng.randint(least, most)):
            words[rng.randrange(len(words))] = f"z{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def prose(rng, n):
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))


def test_like_brute_force(spark, folder):
    rng = random.Random(1)
    texts = [prose(rng, rng.randint(1, 120)) for _ in range(60)]
    for base in list(texts[:20]):
        texts += copies(rng, base, 3, 0, 4)
    passage = prose(rng, 60)
    texts += [f"{prose(rng, 20)} {passage}" for _ in range(60)]
    texts += [None, "", " \n", "one two", "One TWO", "one two three four", "É a b c d e", "é a b c d e", texts[0].upper(), "a b " * 3000, "a b " * 3001]
    rng.shuffle(texts)
    rows = list(enumerate(texts, 10))
    assert found(N.query(spark, folder(rows))) == brute(rows)


def test_large_group_of_near_copies(spark, folder, monkeypatch):
    """More copies than a short list takes, at every distance, in blocks."""
    monkeypatch.setattr(N, "LONG", 8)
    monkeypatch.setattr(N, "BLOCK", 20)
    rng = random.Random(2)
    rows = list(enumerate(copies(rng, prose(rng, 150), 120, 0, 9) + [prose(rng, 50) for _ in range(10)]))
    got = found(N.query(spark, folder(rows)))
    assert got == brute(rows)
    assert 5 < sum(r[3] for r in got) < 100


def test_repeated_rows_null_ids_and_empty(spark, folder, docs):
    text = prose(random.Random(3), 40)
    rows = [(5, text), (5, text), (3, text + " more"), (3, text + " more"), (None, text), (None, "lonely words here now and then"), (7, None)]
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in N.query(spark, folder(rows)).collect()}
    assert got[5, 36] == (3, False) and got[3, 37] == (3, True) and got[None, 36] == (3, False)
    assert got[None, 2] == (None, False) and got[7, 0] == (7, True)
    assert N.query(spark, folder([])).count() == 0
    left = N.dedup(docs(rows))
    assert left.columns == docs(rows).columns
    assert sorted((r.doc_id or 0, r.text) for r in left.collect()) == sorted([(3, text + " more"), (0, "lonely words here now and then"), (7, None)], key=lambda r: (r[0], r[1] or ""))


def test_block_gives_links_that_connect_its_components():
    import numpy as np
    import pandas as pd

    full = [np.arange(k, k + 100, dtype=np.int64).tobytes() for k in (0, 2, 4, 500)]
    nodes = [{"id": k, "g": str(k)} for k in range(4)]
    group = pd.DataFrame({"v": 1, "i": 0, "j": 0, "mine": 0, "node": nodes, "label": [1, 2, 3, 4], "full": full})
    assert len(N._block(group)) == 2


def test_small_tables_take_few_files(spark, folder, monkeypatch):
    """Tables that are dealt out by a shuffle have as many files as their rows need, not one for each shuffle partition."""
    from regionpulse.llm import components as C

    files, stage = [], N.stage

    def counted(df, *args, **kwargs):
        out = stage(df, *args, **kwargs)
        files.append(len(out.inputFiles()))
        return out

    for module in (N, C):
        monkeypatch.setattr(module, "stage", counted)
    monkeypatch.setattr(N, "LONG", 8)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rng = random.Random(4)
    rows = list(enumerate(copies(rng, prose(rng, 150), 40, 0, 9) + [prose(rng, 50) for _ in range(10)]))
    try:
        got = N.query(spark, folder(rows))
        assert got.rdd.getNumPartitions() == 1
        assert found(got) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    # The first table is written by the tasks that read the documents.
    assert len(files) > 15 and set(files[1:]) == {1}


def test_files_grow_with_the_rows(spark, monkeypatch):
    """With four shuffle partitions, one or two files; larger tables are written as they come."""
    from regionpulse import session

    monkeypatch.setattr(session, "TASK_ROWS", 100)
    df = spark.range(0, 1000, 1, 8)
    assert [session.sized(df, n).rdd.getNumPartitions() for n in (0, 100, 101, 201, 10**9)] == [1, 1, 2, 8, 8]
    out = session.stage(df, rows=200)
    assert len(out.inputFiles()) == 2 and out.agg({"id": "sum"}).first()[0] == 499500
