from __future__ import annotations

import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F
from regionpulse.llm import sharding


def test_every_shard_has_the_mixture_and_its_share_of_rows(docs):
    sources = ["hot"] * 400 + ["b"] * 200 + ["c"] * 37 + [None] * 3
    rows = [(i, f"text {i}") for i in range(640)]
    out = sharding.interleave(docs(rows, sources), "source", ["doc_id"], n_shards=8, rows_per_bucket=50).collect()
    assert len(out) == 640 and out[0].lang == "en"
    by = defaultdict(list)
    for r in out:
        by[r.shard].append(r)
    assert sorted(by) == list(range(8))
    for members in by.values():
        assert len(members) == 80
        assert sorted(r.slot for r in members) == list(range(80))
        count = Counter(r.source for r in members)
        assert count["hot"] == 50 and count["b"] == 25 and 4 <= count["c"] <= 5


def test_buckets_do_not_change_the_order(docs):
    df = docs([(i, str(i)) for i in range(101)], ["a", "b"] * 50 + ["c"])
    small, large = (
        {r.doc_id: (r.shard, r.slot) for r in sharding.interleave(df, "source", ["doc_id"], 7, rows_per_bucket=n).collect()}
        for n in (9, 10_000)
    )
    counts = Counter(s for s, _ in small.values())
    assert max(counts.values()) - min(counts.values()) <= 1
    assert counts == Counter(s for s, _ in large.values())


def test_same_seed_same_shards_other_seed_others(docs):
    rows = [(i, str(i)) for i in range(200)]
    a, b, c = (
        sorted((r.doc_id, r.shard, r.slot) for r in sharding.interleave(docs(rows), "source", ["doc_id"], 4, seed=s).collect())
        for s in (1, 1, 2)
    )
    assert a == b != c


def test_query(spark, folder):
    texts = [None, "", "é", "a" * 50_000] + ["same"] * 40 + [f"t{i}" for i in range(60)]
    rows = [(None if i == 5 else i, t) for i, t in enumerate(texts)]
    out = sharding.query(spark, folder(rows)).collect()
    assert len(out) == len(rows)
    text = dict(rows)
    for r in out:
        raw = (text[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "rows", None)
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert sharding.query(spark, folder([])).count() == 0


def test_written_shards(spark, docs, tmp_path):
    df = sharding.interleave(docs([(i, str(i)) for i in range(20)]), "source", ["doc_id"], 4)
    sharding.write_shards(df, f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out/shard=2").count() == 5


def test_every_shard_and_slot_equals_a_plain_computation(spark):
    rows = [(i, ["hot", "hot", "a", None][i % 4] if i % 7 else "rare", i % 5) for i in range(230)] + [(5, "a", 1)] * 2
    df = spark.createDataFrame(rows, "doc_id long, source string, n int").repartition(4)
    got = sharding.interleave(df, "source", ["doc_id", "n"], n_shards=7, rows_per_bucket=20).collect()
    hashed = df.select("doc_id", "source", "n", F.xxhash64(F.lit(sharding.SEED), "doc_id", "n").alias("h")).collect()
    buckets, placed = -(-len(rows) // 20), []
    for stratum in {r.source for r in hashed}:
        mine = sorted((r for r in hashed if r.source == stratum), key=lambda r: (r.h % buckets, r.h, r.doc_id, r.n))
        name = "-" if stratum is None else f"+{stratum}"
        placed += [((2 * k + 1) / (2 * len(mine)), name, k, r) for k, r in enumerate(mine)]
    want, total, slots = [], len(placed), {}
    for place, (_, _, _, r) in enumerate(sorted(placed, key=lambda p: p[:3])):
        shard = place * 7 // total
        slots[shard] = slots.get(shard, -1) + 1
        want.append((r.doc_id, str(r.source), r.n, shard, slots[shard]))
    assert sorted((r.doc_id, str(r.source), r.n, r.shard, r.slot) for r in got) == sorted(want)
