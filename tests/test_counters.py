"""Counters gathered by the run that writes the results."""

from __future__ import annotations

from pyspark.sql import functions as F

from regionpulse.operators import quality as Q


def test_counters_of_a_job(spark, tmp_path):
    counters = Q.Counters()
    df = counters.watch(spark.range(100).repartition(4), "in")
    kept = counters.watch(df.where("id % 3 = 0"), "out", [F.count(F.lit(1)).alias("filas"), F.max("id").alias("mayor")])
    kept.write.parquet(str(tmp_path / "t"))
    rows = {(r.paso, r.contador): r.valor for r in counters.table(spark).collect()}
    assert rows == {("in", "filas"): 100, ("out", "filas"): 34, ("out", "mayor"): 99}
    assert Q.Counters().table(spark).count() == 0


def test_counters_of_a_stream(spark, tmp_path):
    folder, out, path = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "counters")
    for k in range(3):
        spark.range(k + 1).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(folder)
    write = Q.counted(lambda df, n: df.write.mode("overwrite").parquet(f"{out}/lote={n}"), path, [F.count(F.lit(1)).alias("filas")])
    stream.writeStream.foreachBatch(write).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    # A batch that is repeated replaces its counters.
    write(spark.range(7), 0)
    rows = spark.read.schema("contador string, valor long, lote int").parquet(path)
    assert sorted((r.lote, r.valor) for r in rows.collect())[0] == (0, 7) and rows.where("lote > 0").agg(F.sum("valor")).first()[0] in (3, 4, 5)
