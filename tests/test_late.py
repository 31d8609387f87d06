"""Late reports are kept, and the rest counts as before."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from regionpulse.streaming import news as SN

SCHEMA = "url string, t timestamp, estado string, tipo_evento string, victimas boolean, rescate boolean, danios boolean"
START = datetime(2026, 7, 1)


def test_late_rows_and_counts_equal_brute_force(spark, tmp_path):
    folder, path = str(tmp_path / "in"), str(tmp_path / "out")
    batches = [
        [(200, "a"), (210, "b"), (205, None)], [(209, "a"), (130, "a"), (140, "b"), (100, "b")], [(300, "a")], [(229, "a"), (210, "b"), (20, None)],
    ]
    mark, want_late, want = -(10**9), [], {}
    for rows in batches:
        for hour, site in rows:
            starts = [b for b in range(hour - hour % 24, hour - 72, -24) if b + 72 > hour]
            missed = [b for b in starts if b + 72 <= mark]
            if missed:
                want_late.append((hour, site, len(missed)))
            for b in set(starts).difference(missed):
                want[b, site] = want.get((b, site), 0) + 1
        mark = max([mark, *[hour - 24 for hour, _ in rows]])
        data = [(f"https://{s}.com/{h}" if s else None, START + timedelta(hours=h), "lara", "sismo", True, None, False) for h, s in rows]
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    for _ in range(2):  # the second run resumes and adds nothing
        steps = SN.alerts_and_late_rows(stream, hours=72, slide_hours=24, delay="24 hours", time="t")
        SN.start_late_stream(steps, path, str(tmp_path / "cp")).awaitTermination()
    hour = lambda t: int((t - START) / timedelta(hours=1))
    late = [(hour(r.momento), r.dominio and r.dominio[0], r.ventanas_perdidas) for r in SN.late_rows(spark, path).collect()]
    assert sorted(late, key=str) == sorted(want_late, key=str) and len(late) >= 3
    counts = SN.counts_on_time(spark, path).collect()
    assert {(hour(r.ventana.start), r.dominio and r.dominio[0]): r.n for r in counts} == want
    assert all(r.victimas and not r.rescate for r in counts)
    assert SN.alerts_from_sources(SN.counts_on_time(spark, path)).where(F.col("n_noticias") > 0).count() == len({b for b, _ in want})


def test_no_task_works_report_by_report(spark):
    """Nothing of the stream runs in Python, and no state is kept per source."""
    stream = spark.readStream.format("rate").load().selectExpr(
        "CAST(value AS string) AS url", "timestamp AS t", "'lara' AS estado", "'sismo' AS tipo_evento", "true AS victimas", "true AS rescate", "true AS danios"
    )
    plan = SN.alerts_and_late_rows(stream, time="t")._jdf.queryExecution().logical().toString()
    assert "Pandas" not in plan and "GroupsWithState" not in plan
