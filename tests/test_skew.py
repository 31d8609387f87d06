"""One key holds a third of the rows: results stay whole and no task gets the whole key."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from regionpulse.operators import alerts as A
from regionpulse.operators import dedupe as D
from regionpulse.operators import selection as S

N = 30_000
NOW = datetime(2026, 7, 10)


def reports(spark):
    """A third of the reports share one state, source and URL; a third have no URL."""
    i = F.col("id")
    none = F.array().cast("array<string>")
    url = F.when(i % 3 == 0, "https://hot.com/1").when(i % 3 == 1, F.concat(F.lit("https://s"), (i % 500).cast("string"), F.lit(".com/"), i.cast("string")))
    return spark.range(0, N, 1, 12).select(
        "id", url.alias("url"), F.lit(date(2026, 7, 9)).alias("fecha_dt"),
        F.when(i % 3 == 0, "lara").otherwise(F.concat(F.lit("e"), (i % 20).cast("string"))).alias("estado"),
        F.array(F.lit("lluvi"), F.lit("sismo")).alias("eventos"), F.when(i % 7 == 0, F.array(F.lit("v"))).otherwise(none).alias("victimas"),
        none.alias("rescate"), none.alias("daños"),
    )


def shuffled_rows(df) -> list[int]:
    """Rows written by each shuffle of the executed plan."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if name in ("ResultQueryStageExec", "ShuffleQueryStageExec", "BroadcastQueryStageExec"):
            todo.append(node.plan())
            continue
        if name == "ShuffleExchangeExec":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        todo.extend(children.apply(j) for j in range(children.size()))
    return found


def test_metrics_are_whole_and_combined_before_the_shuffle(spark):
    df = A.alert_metrics(reports(spark), 48, NOW)
    rows = {(r.estado, r.tipo_evento): r for r in df.collect()}
    assert rows["lara", "lluvias"].n_noticias == N // 3 and rows["lara", "lluvias"].n_fuentes_distintas == 1
    assert sum(r.n_noticias for r in rows.values()) == 2 * N
    # two event types per report: rows with a repeated or missing URL are combined in the tasks
    assert max(shuffled_rows(df)) < 2 * N // 3 + 2 * 12 * 50


def test_first_row_of_a_hot_key(spark):
    df = D.keep_first(reports(spark).select("url", "id"), "url", ["id"])
    got = {r.url: r.id for r in df.collect()}
    assert len(got) == N // 3 + 2 and got["https://hot.com/1"] == 0 and got[None] == 2
    assert max(shuffled_rows(df)) <= N // 3 + 2 * 12


def test_large_top_of_a_hot_group(spark):
    df = reports(spark).select("estado", "id")
    top = D.first_per_group(df, ["estado"], [F.desc("id")], k=5000, rank="r")
    hot = [r.id for r in top.where("estado = 'lara'").orderBy("r").collect()]
    assert hot == sorted((i for i in range(N) if i % 3 == 0), reverse=True)[:5000]


def test_rows_without_a_key_are_scattered(spark):
    sent = spark.createDataFrame([("https://hot.com/1",)], "url string")
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        kept = S.not_in_ledger(reports(spark), sent, "url")
        per_task = kept.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["count"] for r in per_task) == 2 * N // 3
    assert max(r["count"] for r in per_task) < 2 * (2 * N // 3) // len(per_task)
