"""Rows in the form the output contracts expect, and checks against the choice lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regionpulse.functions.dates import iso_timestamp
from regionpulse.functions.text import choice_name
from regionpulse.functions.urls import domain

# Type and name of the fields of each output contract.
CONTRACTS: dict[str, list[tuple[str, str]]] = {
    "news": [
        ("date", "fecha"), ("text", "titulo"), ("text", "enlace"), ("select_one estados", "estado"),
        ("select_one tipos_evento", "tipo_evento"), ("text", "medio"),
        ("select_one niveles_alerta", "nivel_alerta_asociado"), ("text", "criterio_busqueda"),
        ("today", "fecha_carga"),
    ],
    "metrics": [
        ("dateTime", "fecha_calculo"), ("select_one estados", "estado"),
        ("select_one tipos_evento", "tipo_evento"), ("integer", "ventana_horas"),
        ("integer", "n_noticias"), ("integer", "n_fuentes_distintas"),
        ("select_one si_no", "tiene_victimas"), ("select_one si_no", "tiene_rescate_activo"),
        ("select_one si_no", "tiene_danios_estructurales"), ("dateTime", "fecha_mas_reciente"),
        ("select_one niveles_alerta", "nivel_alerta"), ("text", "urls_relacionadas"),
    ],
    "rain": [
        ("dateTime", "fecha_calculo"), ("select_one estados", "estado"), ("text", "capital"),
        ("decimal", "precipitacion_30dias"), ("decimal", "saturacion"),
        ("select_one niveles_alerta", "nivel_alerta"), ("decimal", "umbral_amarillo"),
        ("decimal", "umbral_naranja"), ("decimal", "umbral_rojo"),
    ],
    "quakes": [
        ("dateTime", "fecha_calculo"), ("select_one estados", "estado"), ("integer", "ventana_dias"),
        ("integer", "n_sismos"), ("decimal", "magnitud_maxima"), ("decimal", "magnitud_promedio"),
        ("decimal", "profundidad_promedio_km"), ("select_one niveles_alerta", "nivel_alerta"),
    ],
}

FIELD_TYPES = {
    "text": "string", "integer": "int", "decimal": "double", "date": "date", "today": "date",
    "dateTime": "timestamp",
}


def yes_no(c: Column) -> Column:
    """Boolean -> ``si`` / ``no``; null counts as no."""
    return F.when(c, "si").otherwise("no")


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def prepare_news(df: DataFrame, *keep: str) -> DataFrame:
    """Selected news -> the eight published columns (and ``keep``)."""
    return df.select(
        *keep,
        F.coalesce(F.date_format("fecha_dt", "yyyy-MM-dd"), F.lit("")).alias("fecha"),
        _text("title").alias("titulo"),
        _text("url").alias("enlace"),
        choice_name(F.col("estado")).alias("estado"),
        "tipo_evento",
        F.coalesce(domain(F.col("url")), F.lit("")).alias("medio"),
        F.lower("nivel_alerta_asociado").alias("nivel_alerta_asociado"),
        _text("criterio_busqueda").alias("criterio_busqueda"),
    )


def prepare_metrics(df: DataFrame, *keep: str) -> DataFrame:
    """Alert metrics -> the twelve published columns (and ``keep``)."""
    latest = F.col("fecha_mas_reciente").cast("timestamp")
    return df.select(
        *keep,
        iso_timestamp(F.col("fecha_calculo")).alias("fecha_calculo"),
        choice_name(F.col("estado")).alias("estado"),
        "tipo_evento",
        # The contract asks for integers: a count beyond them is published as the largest one.
        *[F.least(F.col(c).cast("long"), F.lit(2**31 - 1)).cast("int").alias(c) for c in ("ventana_horas", "n_noticias", "n_fuentes_distintas")],
        *[
            yes_no(F.col(c)).alias(c)
            for c in ("tiene_victimas", "tiene_rescate_activo", "tiene_danios_estructurales")
        ],
        F.coalesce(iso_timestamp(latest), F.lit("")).alias("fecha_mas_reciente"),
        F.lower("nivel_alerta").alias("nivel_alerta"),
        _text("urls_relacionadas").alias("urls_relacionadas"),
    )


def prepare_rain(df: DataFrame) -> DataFrame:
    """Rain output rows -> the nine published columns."""
    return df.select(
        iso_timestamp(F.col("fecha_calculo")).alias("fecha_calculo"),
        "estado",
        "capital",
        F.col("precipitacion_30dias").cast("double").alias("precipitacion_30dias"),
        F.col("saturacion").cast("double").alias("saturacion"),
        "nivel_alerta",
        *[F.col(f"umbral_{c}").cast("double").alias(f"umbral_{c}") for c in ("amarillo", "naranja", "rojo")],
    )


def prepare_quakes(df: DataFrame) -> DataFrame:
    """Earthquake metrics -> the eight published columns."""
    return df.select(
        iso_timestamp(F.col("fecha_calculo")).alias("fecha_calculo"),
        "estado",
        *[F.col(c).cast("int").alias(c) for c in ("ventana_dias", "n_sismos")],
        *[
            F.col(c).cast("double").alias(c)
            for c in ("magnitud_maxima", "magnitud_promedio", "profundidad_promedio_km")
        ],
        "nivel_alerta",
    )


def conform_output(df: DataFrame, contract: str) -> DataFrame:
    """Project and cast to a contract; a load-date field gets today, an empty date becomes null."""

    def field(kind: str, name: str) -> Column:
        if kind == "today":
            return F.current_date().alias(name)
        target = FIELD_TYPES.get(kind, "string")
        value = F.col(name)
        if target in ("date", "timestamp"):
            value = F.nullif(value.cast("string"), F.lit("")).try_cast(target)
        return value.cast(target).alias(name)

    return df.select(*[field(kind, name) for kind, name in CONTRACTS[contract]])


def choice_violations(df: DataFrame, contract: str, choices: DataFrame) -> DataFrame:
    """``(campo, list_name, valor, n)``: values of choice fields that are not in their list.

    All fields are checked in one pass; values are counted before the
    comparison, so only distinct values meet the lists.
    """
    fields = [(kind.split()[1], name) for kind, name in CONTRACTS[contract] if kind.startswith("select_one")]
    cells = F.array(
        *[
            F.struct(F.lit(name).alias("campo"), F.lit(listing).alias("list_name"), F.col(name).alias("valor"))
            for listing, name in fields
        ]
    )
    counted = (
        df.select(F.explode(cells).alias("c"))
        .select("c.*")
        .where(F.col("valor").isNotNull())
        .groupBy("campo", "list_name", "valor")
        .agg(F.count("*").alias("n"))
    )
    return counted.join(choices.select("list_name", F.col("name").alias("valor")), ["list_name", "valor"], "left_anti")


def _stable_uuid(df: DataFrame, form_uuid: str) -> Column:
    digest = F.md5(F.concat_ws("\u0001", F.lit(form_uuid), F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))
    return F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def submission_xml(
    df: DataFrame, form_id: str, form_uuid: str, fields: Sequence[str] | None = None, column: str = "xml"
) -> DataFrame:
    """Rows plus one XML submission each; null and empty fields are left out.

    The submission's id is a digest of the row, so that a row that is sent again has the same one.
    """
    present = [
        F.nullif(F.col(f).cast("string"), F.lit("")).alias(f) for f in (fields or df.columns)
    ]
    body = F.struct(
        F.lit(form_id).alias("_id"),
        F.struct(F.lit(form_uuid).alias("uuid")).alias("formhub"),
        *present,
        F.struct(F.concat(F.lit("uuid:"), _stable_uuid(df, form_uuid)).alias("instanceID")).alias("meta"),
    )
    return df.withColumn(column, F.to_xml(body, {"rowTag": form_id}))


def contract_fields(contract: str) -> Mapping[str, str]:
    """Field name -> Spark type of a contract."""
    return {name: FIELD_TYPES.get(kind, "string") for kind, name in CONTRACTS[contract]}
