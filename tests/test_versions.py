"""Versions under failed and concurrent writers, and the ledger that is opened only where a key may be."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from regionpulse.sources import key_index as K
from regionpulse.sources import sinks
from regionpulse.sources import versions as V
from regionpulse.streaming import ledger as SL


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n long")


def values(df):
    return sorted(r.n for r in df.collect())


def test_readers_see_the_last_complete_version(spark, tmp_path):
    root, schema = str(tmp_path / "t"), numbers(spark).schema
    assert values(V.read_version(spark, root, schema)) == [] and V.latest(spark, root) == (0, {})
    assert V.commit_version(numbers(spark, 1, 2), root) == 1
    # Written, but the writer fails before it commits.
    sinks.write_version(numbers(spark, 99), root)
    assert values(V.read_version(spark, root, schema)) == [1, 2]
    assert V.commit_version(V.read_version(spark, root, schema).union(numbers(spark, 3)), root) == 2
    assert values(V.read_version(spark, root, schema)) == [1, 2, 3] and values(V.read_version(spark, root, schema, 1)) == [1, 2]


def test_one_of_two_writers_wins(spark, tmp_path):
    root, schema = str(tmp_path / "t"), numbers(spark).schema
    base = V.commit_version(numbers(spark, 1), root)
    mine, other = (V.read_version(spark, root, schema).union(numbers(spark, n)) for n in (2, 3))
    V.commit_version(other, root, base)
    with pytest.raises(V.Conflict):
        V.commit_version(mine, root, base)
    assert values(V.read_version(spark, root, schema)) == [1, 3]
    V.commit_version(V.read_version(spark, root, schema).union(numbers(spark, 2)), root)
    assert values(V.read_version(spark, root, schema)) == [1, 2, 3]
    V.drop_old_versions(spark, root, keep=1)
    assert values(V.read_version(spark, root, schema)) == [1, 2, 3]
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("version=")]) == 1
    assert not [p for p in (tmp_path / "t" / "_commits").iterdir() if not p.name.endswith((".json", ".crc"))]


def keys(spark, first, n):
    return spark.range(first, first + n).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"))


def test_lookup_equals_a_plain_anti_join(spark, tmp_path):
    root = str(tmp_path / "l")
    K.create(spark, root, 8)
    assert K.unseen(keys(spark, 0, 5), "k", root).count() == 5
    K.record(keys(spark, 0, 1000), "k", root, "a")
    K.record(keys(spark, 900, 600).unionAll(spark.createDataFrame([(None,)], "k string")), "k", root, "b")
    batch = keys(spark, 1400, 300).unionAll(keys(spark, 1690, 10)).unionAll(spark.createDataFrame([(None,)], "k string"))
    left = sorted(str(r.k) for r in K.unseen(batch, "k", root).collect())
    assert left == sorted([f"k{i}" for i in (*range(1500, 1700), *range(1690, 1700))] + ["None"])
    assert K.read_keys(spark, root).count() == 1500
    # A batch that runs again replaces what it had recorded.
    K.record(keys(spark, 2000, 3), "k", root, "b")
    assert K.read_keys(spark, root).count() == 1003
    assert K.unseen(keys(spark, 2000, 3), "k", root, without="b").count() == 3


def test_opened_partitions_stay_few_while_the_ledger_grows(spark, tmp_path):
    root = str(tmp_path / "l")
    K.create(spark, root, 16)
    opened = {}
    for n in range(10):
        K.record(keys(spark, 10_000 * n, 10_000), "k", root, f"b{n}")
        if n in (0, 9):
            fresh = K.likely_partitions(keys(spark, 500_000, 40).withColumnRenamed("k", "clave"), root)
            known = K.likely_partitions(keys(spark, 100, 5).withColumnRenamed("k", "clave"), root)
            opened[n] = (len(fresh), len(known))
    assert opened[0][1] <= 5 and opened[9][1] <= 5 + 2 and opened[9][0] <= 3
    K.compact(spark, root, lambda entry: True)
    sets = V.latest(spark, root)[1]["conjuntos"]
    assert sorted(s["generacion"] for s in sets) == [0, 0, 1]
    assert K.read_keys(spark, root).count() == 100_000
    assert len(K.likely_partitions(keys(spark, 100, 5).withColumnRenamed("k", "clave"), root)) <= 5 + 2


def test_writers_that_meet_lose_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "l")
    K.create(spark, root, 4)
    plain, met = V.commit, []

    def slow(session, where, content, base):
        if not met:
            met.append(True)
            K.record(keys(spark, 100, 5), "k", root, "other")
        return plain(session, where, content, base)

    monkeypatch.setattr(K, "commit", slow)
    K.record(keys(spark, 0, 5), "k", root, "mine")
    assert K.read_keys(spark, root).count() == 10 and met


def test_indexed_stream_sends_each_key_once(spark, tmp_path):
    folder, root, sent = str(tmp_path / "in"), str(tmp_path / "l"), []
    write = SL.indexed_batch("k", root, f"{root}/salida", ["k"], lambda rows, n: sent.append((n, sorted(r.k for r in rows.collect()))))
    write(keys(spark, 0, 3), 0)
    write(keys(spark, 1, 4), 1)
    write(keys(spark, 1, 4), 1)
    for n in range(2, 11):
        write(keys(spark, n, 4), n)
    assert sent[:3] == [(0, ["k0", "k1", "k2"]), (1, ["k3", "k4"]), (1, ["k3", "k4"])]
    assert sorted(k for _, ks in sent[1:] for k in ks) == sorted(["k3", "k4"] * 1 + [f"k{i}" for i in range(3, 14)])
    assert K.read_keys(spark, root).count() == 14
    assert max(s["generacion"] for s in V.latest(spark, root)[1]["conjuntos"]) == 1
    keys(spark, 5, 20).write.parquet(folder)
    for _ in range(2):
        stream = spark.readStream.schema("k string").parquet(folder)
        SL.start_indexed_stream(stream, "k", root, str(tmp_path / "cp"), ["k"]).awaitTermination()
    assert K.read_keys(spark, root).count() == 25
