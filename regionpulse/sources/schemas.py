"""Fixed schemas of every table the jobs read or write."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()
DATE, TS, STRINGS = T.DateType(), T.TimestampType(), T.ArrayType(T.StringType())


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# The keyword categories, in output order.
ZONE_CATEGORIES = [
    "capital", "andes", "oriente", "occidente", "llanos", "costa", "barrio", "urbanizacion",
]
IMPACT_CATEGORIES = ["daños", "victimas", "rescate"]
CATEGORIES = [*ZONE_CATEGORIES, *IMPACT_CATEGORIES, "atencion", "eventos"]

# Columns dropped because another column holds the same text, or stray ones.
REDUNDANT_COLUMNS = ["displayed_url", "snippet", "rich_type", "_collected_at;;"]

RAW_NEWS = _struct(
    ("page_number", I), ("rank", I), ("title", S), ("url", S), ("displayed_url", S), ("fecha", S),
    ("snippet", S), ("snippet_full", S), ("rich_type", S), ("criterio_busqueda", S),
)
RAW_SOCIAL = _struct(("source_url", S), ("profile_url", S), ("likes", S), ("comments", S))

PROCESSED_NEWS = _struct(
    ("page_number", I), ("rank", I), ("title", S), ("url", S), ("fecha", S), ("snippet_full", S),
    ("criterio_busqueda", S), ("title_clean", S), ("snippet_full_clean", S),
    ("texto_clasificacion", S), ("fecha_dt", DATE), ("red_social", S),
    *[(c, STRINGS) for c in CATEGORIES], ("estado", S),
)

ALERT_METRICS = _struct(
    ("estado", S), ("tipo_evento", S), ("ventana_horas", I), ("fecha_calculo", TS),
    ("n_noticias", L), ("n_fuentes_distintas", L), ("tiene_victimas", B),
    ("tiene_rescate_activo", B), ("tiene_danios_estructurales", B), ("fecha_mas_reciente", DATE),
    ("nivel_alerta", S), ("urls_relacionadas", S),
)

RAIN_JSON = _struct(
    ("estado", S),
    ("daily", _struct(("time", STRINGS), ("precipitation_sum", T.ArrayType(D)))),
)
RAIN_DAILY = _struct(("estado", S), ("fecha", DATE), ("mm", D))

QUAKE_GEOJSON = _struct(
    ("features", T.ArrayType(_struct(
        ("id", S),
        ("properties", _struct(("time", L), ("mag", D), ("place", S), ("url", S))),
        ("geometry", _struct(("coordinates", T.ArrayType(D)))),
    ))),
)
QUAKE_EVENTS = _struct(
    ("id_evento", S), ("fecha_evento", TS), ("magnitud", D), ("profundidad_km", D), ("lugar", S),
    ("lat", D), ("lon", D), ("url_detalle", S),
)

STATES_DIM = _struct(("estado", S), ("capital", S), ("lat", D), ("lon", D), ("ord", I))
QUAKE_THRESHOLDS = _struct(
    ("estado", S), ("umbral_amarillo", D), ("umbral_naranja", D), ("umbral_rojo", D)
)
LEXICON_DIM = _struct(("category", S), ("keyword", S), ("ord", I))
CANONICAL_DIM = _struct(("keyword", S), ("tipo_evento", S))
GAZETTEER_DIM = _struct(("term", S), ("kind", S))
ALIAS_DIM = _struct(("raw", S), ("clean", S))
CHOICES = _struct(("list_name", S), ("name", S), ("label", S))

LEDGER_URLS = _struct(("url", S))
LEDGER_ALERTS = _struct(("clave", S))

OUT_NEWS = _struct(
    ("fecha", S), ("titulo", S), ("enlace", S), ("estado", S), ("tipo_evento", S), ("medio", S),
    ("nivel_alerta_asociado", S), ("criterio_busqueda", S),
)
OUT_METRICS = _struct(
    ("fecha_calculo", S), ("estado", S), ("tipo_evento", S), ("ventana_horas", I),
    ("n_noticias", I), ("n_fuentes_distintas", I), ("tiene_victimas", S),
    ("tiene_rescate_activo", S), ("tiene_danios_estructurales", S), ("fecha_mas_reciente", S),
    ("nivel_alerta", S), ("urls_relacionadas", S),
)
OUT_RAIN = _struct(
    ("fecha_calculo", S), ("estado", S), ("capital", S), ("precipitacion_30dias", D),
    ("saturacion", D), ("nivel_alerta", S), ("umbral_amarillo", D), ("umbral_naranja", D),
    ("umbral_rojo", D),
)
OUT_QUAKES = _struct(
    ("fecha_calculo", S), ("estado", S), ("ventana_dias", I), ("n_sismos", I),
    ("magnitud_maxima", D), ("magnitud_promedio", D), ("profundidad_promedio_km", D),
    ("nivel_alerta", S),
)
