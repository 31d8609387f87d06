from __future__ import annotations

import numpy as np
import pytest

from regionpulse.llm import pivots

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    ok = {}
    for k, (_, v) in enumerate(rows):
        if v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.asarray(v, np.float32).astype(float)
            ok[k] = x / np.linalg.norm(x)
    links = {k: [j for j in ok if j != k and len(ok[j]) == len(ok[k]) and ok[j] @ ok[k] >= 0.9] if k in ok else [] for k in range(len(rows))}
    out = []
    for k, (i, _) in enumerate(rows):
        reach, todo = {k}, [k]
        while todo:
            new = set(links[todo.pop()]) - reach
            reach |= new
            todo += new
        home = min(rows[j][0] for j in reach)
        out.append((i, len(links[k]), home, home == i))
    return sorted(out)


def found(df):
    return sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect())


def vectors(seed, n=300, d=16):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, d))
    near = base[rng.integers(0, 40, n)] + rng.normal(size=(n, d)) * 0.2
    return [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate([*base, *near])]


def test_like_brute_force(spark):
    rows = vectors(1)
    rows += [(1000 + i, rows[3][1]) for i in range(5)] + [(1100, [2 * x for x in rows[7][1]])]
    rows += [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [None] * 16), (2004, [float("inf")] * 16), (2005, []), (2006, [1.0, 0.0]), (2007, [1.0, 0.1])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).repartition(3)
    got, want = found(pivots.grouped(df)), brute(rows)
    assert [r[0] for r in got] == [r[0] for r in want]
    true = sum(r[1] for r in want)
    kept = sum(min(a[1], b[1]) for a, b in zip(got, want))
    assert kept >= 0.97 * true and all(a[1] <= b[1] for a, b in zip(got, want))
    everything = found(pivots.grouped(df, nearest=16, n_pivots=16))
    assert everything == want


def test_crowded_pivots_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(pivots, "BLOCK", 30)
    rows = vectors(2, 120)
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)
    assert found(pivots.grouped(df, nearest=8, n_pivots=8)) == brute(rows)


def test_null_and_repeated_ids_and_empty(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (None, [1.0, 0.05], 0), (None, [0.0, 1.0], 0)]
    got = pivots.grouped(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in got) == [(0, 0, 0, False), (0, 2, 1, False), (1, 2, 1, True), (1, 2, 1, True)]
    assert pivots.grouped(spark.createDataFrame([], SCHEMA)).count() == 0


def dense(seed, close, members, others, d=64):
    """Vectors of which the first ``members`` have cosines of about ``close`` to each other."""
    rng = np.random.default_rng(seed)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    group = np.sqrt(close) * unit(rng.normal(size=(1, d))) + np.sqrt(1 - close) * unit(rng.normal(size=(members, d)))
    return np.vstack([group, unit(rng.normal(size=(others, d)))])


def prefixes(x, kept):
    """The pivots whose lists hold each vector, by the rule of the module."""
    near = np.argsort(-(x @ kept.T), axis=1, kind="stable")[:, : pivots.NEAREST]
    size = np.bincount(near.ravel(), minlength=len(kept))
    place = np.empty(len(kept), int)
    place[np.lexsort((np.arange(len(kept)), size))] = np.arange(len(kept))
    return np.hstack([np.sort(place[near], axis=1)[:, : pivots.NEAREST - pivots.SHARED + 1], place[near[:, :1]]])


def meet(a, b):
    return np.concatenate([(a[k : k + 50_000, :, None] == b[k : k + 50_000, None, :]).any((1, 2)) for k in range(0, len(a), 50_000)])


@pytest.mark.parametrize("n_pivots", [256, 1024, 4096])
@pytest.mark.parametrize("close", [0.97, 0.92, 0.88])
def test_members_of_a_dense_group_share_lists(n_pivots, close):
    x = dense(3, close, n_pivots // 3 + 800, n_pivots - n_pivots // 3)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    drawn, members = np.vstack([x[: n_pivots // 3], x[n_pivots // 3 + 800 :]]), x[n_pivots // 3 :][:800]
    kept = pivots._thinned(drawn[np.random.default_rng(4).permutation(n_pivots)])
    lists = prefixes(members, kept)
    rows, columns = np.nonzero(np.triu(members @ members.T >= pivots.COSINE, 1))
    assert meet(lists[rows], lists[columns]).mean() >= 0.9 and len(rows)


@pytest.mark.parametrize("n_pivots", [256, 1024, 4096])
def test_pairs_at_the_least_cosine_share_lists(n_pivots):
    """Pairs of random directions at a cosine of just 0.9, the hardest ones."""
    rng = np.random.default_rng(n_pivots)
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    kept, x = unit(rng.normal(size=(n_pivots, 64))), unit(rng.normal(size=(3000, 64)))
    away = rng.normal(size=x.shape)
    away = unit(away - (away * x).sum(1, keepdims=True) * x)
    lists = prefixes(np.vstack([x, 0.9 * x + np.sqrt(1 - 0.81) * away]), kept)
    assert meet(lists[:3000], lists[3000:]).mean() >= 0.93


def test_a_pair_belongs_to_one_list():
    rng = np.random.default_rng(1)
    a, b = (np.sort(np.array([rng.choice(12, 5, replace=False) for _ in range(500)]), axis=1) for _ in range(2))
    for pivot in range(12):
        got = pivots._first_shared(a, b, pivot)
        assert got.tolist() == [min(set(x) & set(y), default=99) >= pivot for x, y in zip(a.tolist(), b.tolist())]


def test_dense_group_of_a_third_with_many_pivots(spark):
    x = dense(3, 0.92, 400, 800, 32).astype(np.float32)
    exact = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    links = (exact @ exact.T >= 0.9).sum(1) - 1
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(x.tolist())], SCHEMA).repartition(3)
    got = {r.vec_id: r.n_links for r in pivots.grouped(df, n_pivots=1024).collect()}
    assert all(got[i] <= n for i, n in enumerate(links))
    assert sum(got.values()) >= 0.98 * links.sum() > 0
