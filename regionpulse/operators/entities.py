"""Entity extraction with a caller-supplied model, or from term lists."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regionpulse.operators.classify import tag_text

# Batch of texts -> (places, actors) per text.
Extractor = Callable[[pd.Series], list[tuple[list[str], list[str]]]]

STRINGS = T.ArrayType(T.StringType())


def extract_entities(
    df: DataFrame, make_extractor: Callable[[], Extractor], column: str = "snippet_full_clean"
) -> DataFrame:
    """``lugares`` and ``autoridades_actores`` from a model run over batches.

    ``make_extractor`` is called once per partition, so a model is loaded once
    and then sees Arrow batches of texts.  Only the text goes through Python.
    """
    schema = T.StructType([T.StructField("lugares", STRINGS), T.StructField("autoridades_actores", STRINGS)])

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        extract = make_extractor()
        for texts in batches:
            found = extract(texts.fillna(""))
            yield pd.DataFrame({"lugares": [places for places, _ in found], "autoridades_actores": [actors for _, actors in found]})

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    found = df.withColumn("_entidades", F.pandas_udf(run, schema)(F.col(column)))
    return found.withColumns({c: F.col(f"_entidades.{c}") for c in ("lugares", "autoridades_actores")}).drop("_entidades")


def match_entities(
    df: DataFrame, places: Sequence[str], actors: Sequence[str], column: str = "snippet_full_clean"
) -> DataFrame:
    """The same columns from term lists, without a model and without Python workers."""
    return tag_text(df, {"lugares": places, "autoridades_actores": actors}, text=column)
