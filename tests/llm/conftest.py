from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, slot int"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, in several partitions, with columns that clash with those of the operators."""

    def make(rows, sources=None):
        sources = sources or ["a"] * len(rows)
        data = [(i, t, "en", s, len(t or ""), "x", 1) for (i, t), s in zip(rows, sources)]
        return spark.createDataFrame(data, SCHEMA).repartition(3)

    return make


@pytest.fixture
def folder(tmp_path, docs):
    """A folder of test tables with the given documents."""

    def make(rows, name="documents"):
        docs(rows).drop("shard", "slot").write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return make
