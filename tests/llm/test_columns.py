"""Further columns may have the names that operators use inside: every stage hands them on, and keeps clean documents."""

from __future__ import annotations

import corpus_pipeline
import pytest
from regionpulse.llm import language, line_chunks

NAMES = """_id _text _lines _hashes _ends _spans _chunks _starts starts _left _stay _pairs _full _gone gone _ranges wanted _wanted
row id g n hash size place first first_chunk is_first chunk start end node label home kept component_id n_shingles
_score score _found found lang_pred terms toxic item_id pos item_pos length _tokens _marked _template _literal diagonal n_windows
shard slot _row""".split()
ROWS = [(1, "one two three four five six\nseven eight nine ten"), (2, None), (None, ""), (3, "eleven twelve\n\nthirteen fourteen fifteen"), (3, "a b c"), (4, "long words " * 20_000)]


@pytest.fixture
def crowded(docs):
    return docs(ROWS).drop("shard", "slot").selectExpr("*", *[f"'{c}!' {c}" for c in NAMES])


def check(out, df):
    assert out.dtypes == df.dtypes
    rows = out.collect()
    assert len(rows) == len(ROWS)
    assert all(r[c] == f"{c}!" for r in rows for c in NAMES)


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_of_the_pipeline(spark, crowded, tmp_path, name):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    check(dict(corpus_pipeline.STAGES)[name](spark, crowded, str(tmp_path)), crowded)


def test_line_chunks(crowded):
    check(line_chunks.dedup(crowded), crowded)


def test_language(crowded):
    model = language.train(crowded)
    out = language.identify(crowded, model)
    rows = out.collect()
    assert len(rows) == len(ROWS) and {r._found for r in rows} == {"_found!"} and {r.found for r in rows} == {"found!"}
    assert set(out.columns) == set(crowded.columns) and out.schema["score"].dataType.typeName() == "double"
