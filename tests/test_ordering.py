"""Global places and sums against plain Python, with groups that are in many ranges."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from regionpulse.operators import dedupe as D
from regionpulse.operators import ordering as O


@pytest.fixture
def small_ranges(spark):
    """Ranges are not joined together, so a small table is in as many as a large one."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def rows(seed, n):
    """Half of the rows are in one group; groups may be null, values repeated."""
    rng = random.Random(seed)
    return [(i, rng.choice(["hot", "hot", "hot", "a", "b", None]), rng.randrange(50), rng.randrange(1, 9)) for i in range(n)]


def frame(spark, data):
    return spark.createDataFrame(data, "id long, g string, v int, size long").repartition(5)


def test_places_in_the_whole_table(spark, small_ranges):
    data = rows(1, 3000)
    df = O.numbered(frame(spark, data), [F.desc("v"), "id"], "orden")
    want = [r[0] for r in sorted(data, key=lambda r: (-r[2], r[0]))]
    assert [r.id for r in sorted(df.collect(), key=lambda r: r.orden)] == want
    assert sorted(r.orden for r in df.collect()) == list(range(len(data)))


def test_places_in_groups_over_many_ranges(spark, small_ranges):
    data = rows(2, 2000)
    sorted_rows = O.ranged(frame(spark, data), ["g", F.desc("v"), "id"])
    per_range = {(r._rango, r.g): r["count"] for r in sorted_rows.groupBy("_rango", "g").count().collect()}
    assert len([1 for (_, g) in per_range if g == "hot"]) > 2 and max(per_range.values()) < len(data) // 3
    got = O.numbered(frame(spark, data), [F.desc("v"), "id"], "orden", ["g"], start=1).collect()
    groups = defaultdict(list)
    for r in sorted(data, key=lambda r: (-r[2], r[0])):
        groups[r[1]].append(r[0])
    assert {r.id: r.orden for r in got} == {i: k + 1 for ids in groups.values() for k, i in enumerate(ids)}


def test_running_sums(spark, small_ranges):
    data = rows(3, 1500)
    got = {r.id: r.antes for r in O.running(frame(spark, data), ["g"], ["v", "id"], "size", "antes").collect()}
    sums, want = defaultdict(int), {}
    for i, g, _, size in sorted(data, key=lambda r: (r[2], r[0])):
        want[i], sums[g] = sums[g], sums[g] + size
    assert got == want


def test_tables_without_rows(spark):
    empty = frame(spark, [])
    assert O.numbered(empty, ["id"], "n").count() == 0
    assert O.running(empty, ["g"], ["id"], "size", "n").count() == 0
    assert O.likely_first(empty, ["g"], 5, F.col("v")).count() == 0


@pytest.mark.parametrize("k", [1, 7, 400, 5000])
def test_rows_that_can_be_first(spark, k):
    rng = random.Random(k)
    values = [0.0, -0.0, 1e-9, 5.0, 1e18, -3.5, float("inf"), float("-inf"), float("nan"), None]
    data = [(i, rng.choice(["hot", "hot", "x", None]), rng.gauss(0, 1) if rng.random() < 0.8 else rng.choice(values)) for i in range(4000)]
    df = spark.createDataFrame(data, "id long, g string, v double").repartition(4)
    kept = O.likely_first(df, ["g"], k, F.col("v"))
    assert kept.columns == df.columns
    ids = {r.id for r in kept.collect()}
    for g in ("hot", "x", None):
        for nulls_first in (True, False):
            mine = [r for r in data if r[1] == g]
            odd = lambda v: v is None or v != v
            mine.sort(key=lambda r: ((odd(r[2]) != nulls_first), 0 if odd(r[2]) else r[2], r[0]))
            assert {r[0] for r in mine[:k]} <= ids
    plain = [r for r in data if r[1] == "hot" and r[2] is not None and abs(r[2]) < 10]
    if k == 7:
        assert len([r for r in plain if r[0] in ids and r[2] != -3.5]) < 20


def test_large_top_of_groups(spark, small_ranges, monkeypatch):
    monkeypatch.setattr(D, "MAP_SIDE_LIMIT", 10)
    data = rows(5, 3000)
    for by in (None, -F.col("v")):
        top = D.first_per_group(frame(spark, data), ["g"], [F.desc("v"), "id"], k=300, rank="r", by=by)
        groups = defaultdict(list)
        for r in sorted(data, key=lambda r: (-r[2], r[0])):
            groups[r[1]].append(r[0])
        assert {(r.id, r.r) for r in top.collect()} == {(i, n + 1) for ids in groups.values() for n, i in enumerate(ids[:300])}
    by_column = D.first_per_group(frame(spark, data), [F.upper("g")], ["id"], k=11)
    assert by_column.columns == ["id", "g", "v", "size"] and by_column.count() == 44
