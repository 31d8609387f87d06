from __future__ import annotations

import random

import corpus_pipeline
from regionpulse.llm import bpe


def test_stages(spark, docs, tmp_path):
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(2, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, prose(60)) for i in range(150)]
    rows += [(200 + i, f"{prose(20)} scum {prose(20)}") for i in range(40)]
    rows += [(300 + i, rows[i][1] + " tail") for i in range(10)]
    item = prose(30)
    rows += [(400 + i, f"{prose(10)} {item} {prose(10)}") for i in range(5)]
    block = "\n".join(prose(8) for _ in range(12))
    rows += [(500 + i, f"{prose(70)}\n{block}\n{prose(30)}") for i in range(4)]
    rows += [(600, None), (601, ""), (None, prose(30))]
    path = str(tmp_path)
    docs(rows).drop("shard", "slot").write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, int(200 <= i < 240)) for i, _ in rows if i is not None and i < 240]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, path).collect()}
    want = {i for i, _ in rows if i is None or i < 200 or i >= 500}
    assert set(out) == want
    codec = bpe.Codec(open(bpe.vocabulary_path(), encoding="utf-8").read())
    text = dict(rows)
    for i in range(150):
        assert codec.decode(out[i].token_ids) == text[i]
    assert out[600].n_tokens == 0
    lengths = [len(codec.decode(out[500 + i].token_ids)) for i in range(4)]
    assert lengths[0] == len(text[500]) and all(n < len(text[501 + k]) for k, n in enumerate(lengths[1:]))


def test_every_stage_but_the_last_returns_documents(spark, docs, tmp_path):
    path = str(tmp_path)
    df = docs([(1, "one two three"), (2, None)]).drop("shard", "slot")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    for _, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, df, path).dtypes == df.dtypes
        assert step(spark, df.limit(0), path).count() == 0
