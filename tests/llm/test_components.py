from __future__ import annotations

import random

from regionpulse.llm.components import components


def test_like_brute_force(spark):
    rng = random.Random(7)
    links = [(i, i + 1) for i in range(100, 140)] + [(200, k) for k in range(201, 260)]
    links += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)] + [(5, 5), (None, 3), (141, 140), (140, 141)]
    label = {n: n for link in links for n in link if n is not None}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if a is not None and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: m for n, m in label.items() if n != m}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_known_components_take_no_round(spark, monkeypatch):
    from regionpulse.llm import components as C

    def star(*_, **__):
        raise AssertionError("a round")

    monkeypatch.setattr(C, "_star", star)
    stars = [(1, k) for k in range(2, 30)] + [(50, 51)]
    assert {(r.node, r.label) for r in C.components(spark.createDataFrame(stars, "a long, b long")).collect()} == {(b, a) for a, b in stars}


def test_few_edges_take_few_files(spark, monkeypatch):
    """A step over some hundred edges is one file, not one for each shuffle partition."""
    from regionpulse.llm import components as C

    files, stage = [], C.stage

    def counted(*args, **kwargs):
        out = stage(*args, **kwargs)
        files.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(C, "stage", counted)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = C.components(spark.createDataFrame([(k, k + 1) for k in range(200)], "a long, b long"), 200)
        assert {(r.node, r.label) for r in got.collect()} == {(k, 0) for k in range(1, 201)}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(files) > 5 and set(files) == {1}
