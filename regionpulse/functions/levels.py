"""Alert level rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Severity order of the levels, and the ranks of unknown ones.
SEVERITY = {"Rojo": 0, "Naranja": 1, "Amarillo": 2, "Verde": 3}
UNKNOWN_WHEN_SORTING = 9
UNKNOWN_WHEN_MATCHING = 99

# Rain ratios that open each level.
RAIN_RATIOS = {"amarillo": 1.25, "naranja": 1.70, "rojo": 2.20}


def severity(level: Column, unknown: int = UNKNOWN_WHEN_SORTING) -> Column:
    """Rank of a level, most severe first; unknown or null levels rank last."""
    ranks = [F.when(level == name, F.lit(rank)) for name, rank in SEVERITY.items()]
    return F.coalesce(*ranks, F.lit(unknown))


def news_level(victims: Column, victim_sources: Column, rescue: Column, damage: Column, n: Column) -> Column:
    """Red needs victims from two sources; orange rescue or damage; yellow two reports."""
    return (
        F.when(victims & (victim_sources >= 2), "Rojo")
        .when(rescue | damage, "Naranja")
        .when(n >= 2, "Amarillo")
        .otherwise("Verde")
    )


def rain_level(ratio: Column, ratios: dict[str, float] = RAIN_RATIOS) -> Column:
    """Level of a rain ratio against the normal; the bounds are inclusive."""
    return (
        F.when(ratio >= ratios["rojo"], "ROJO")
        .when(ratio >= ratios["naranja"], "NARANJA")
        .when(ratio >= ratios["amarillo"], "AMARILLO")
        .otherwise("VERDE")
    )


def rain_priority(level: Column) -> Column:
    """4 for red down to 1 for green."""
    return (
        F.when(level == "ROJO", 4).when(level == "NARANJA", 3).when(level == "AMARILLO", 2).otherwise(1)
    )


def quake_level(magnitude: Column, yellow: Column, orange: Column, red: Column) -> Column:
    """Level of the largest magnitude against a region's thresholds; null magnitude is green."""
    return (
        F.when(magnitude >= red, "ROJO")
        .when(magnitude >= orange, "NARANJA")
        .when(magnitude >= yellow, "AMARILLO")
        .otherwise("VERDE")
    )
