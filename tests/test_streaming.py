from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from regionpulse.operators.alerts import explode_events
from regionpulse.session import scratch_path, scratch_scope, shared_dir, spread, stage
from regionpulse.streaming import ledger as SL
from regionpulse.streaming import news as SN

SCHEMA = (
    "url string, fecha_dt date, estado string, eventos array<string>, victimas array<string>, rescate array<string>, "
    "`daños` array<string>"
)


def reports(n=60):
    rows = []
    for i in range(n):
        rows.append((
            f"https://s{i % 7}.com/{i % 20}" if i % 11 else None, date(2026, 7, 1 + i % 9) if i % 13 else None,
            ["lara", "sucre", None][i % 3], [["lluvi"], ["sismo", "lluvi"], ["zzz"]][i % 3 - 1], ["v"] if i % 5 == 0 else [],
            [], ["d"] if i % 17 == 0 else [],
        ))
    return rows


def landed(spark, tmp_path, files=4):
    path = str(tmp_path / "in")
    spark.createDataFrame(reports(), SCHEMA).repartition(files).write.parquet(path)
    return spark.read.parquet(path), spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def test_stream_dedupe_equals_batch(spark, tmp_path):
    batch, stream = landed(spark, tmp_path)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    for _ in range(2):  # the second run resumes and adds nothing
        SL.start_append_stream(SN.dedupe_stream(stream.select("url")), out, checkpoint).awaitTermination()
    got = [r.url for r in spark.read.parquet(out).collect()]
    assert sorted(map(str, got)) == sorted({str(r.url) for r in batch.collect()})


def test_bounded_dedupe_drops_repeats(spark, tmp_path):
    _, stream = landed(spark, tmp_path)
    dated = stream.select("url", F.col("fecha_dt").cast("timestamp").alias("t")).where("t IS NOT NULL")
    out = str(tmp_path / "out")
    SL.start_append_stream(SN.dedupe_stream(dated, "url", "t", "30 days"), out, str(tmp_path / "cp")).awaitTermination()
    urls = [r.url for r in spark.read.parquet(out).collect()]
    assert len(urls) == len(set(urls))


def test_sliding_alerts_equal_batch(spark, tmp_path):
    batch, stream = landed(spark, tmp_path)
    dated, undated = SN.split_undated(explode_events(stream))
    assert undated.isStreaming
    per_source = SN.sliding_alerts(dated, hours=72, slide_hours=24, delay="60 days")
    path = str(tmp_path / "out")
    query = (
        per_source.writeStream.outputMode("complete")
        .foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(path))
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    streamed = SN.alerts_from_sources(spark.read.parquet(path))
    dated_batch, _ = SN.split_undated(explode_events(batch))
    direct = SN.alerts_from_sources(SN.sliding_alerts(dated_batch, hours=72, slide_hours=24))
    assert sorted(map(str, streamed.collect())) == sorted(map(str, direct.collect()))
    assert direct.count() > 5


def test_ledger_stream_sends_each_key_once(spark, tmp_path):
    batch, stream = landed(spark, tmp_path)
    ledger, checkpoint, sent = str(tmp_path / "l"), str(tmp_path / "cp"), str(tmp_path / "sent")

    def send(rows, _):
        rows.write.mode("append").parquet(sent)

    keys = stream.select("url", "estado").where("url IS NOT NULL")
    for _ in range(2):
        SL.start_ledger_stream(keys, "url", ledger, checkpoint, ["estado"], send).awaitTermination()
    expected = sorted({r.url for r in batch.collect() if r.url})
    assert sorted(r.url for r in spark.read.parquet(ledger).collect()) == expected
    assert sorted(r.url for r in spark.read.parquet(sent).collect()) == expected


def test_repeated_batch_replaces_itself(spark, tmp_path):
    ledger = str(tmp_path / "l")
    write = SL.ledger_batch("k", ledger, ["k"])
    write(spark.createDataFrame([("a",), ("a",), ("b",)], "k string"), 0)
    write(spark.createDataFrame([("b",), ("c",)], "k string"), 1)
    write(spark.createDataFrame([("b",), ("c",)], "k string"), 1)
    assert sorted((r.k, r.batch_id) for r in spark.read.parquet(ledger).collect()) == [("a", "stream-0"), ("b", "stream-0"), ("c", "stream-1")]
    write(spark.createDataFrame([(None,), ("a",)], "k string"), 2)
    again = SL.ledger_batch("k", ledger, ["k"], stream="second")
    again(spark.createDataFrame([("a",), ("d",)], "k string"), 0)
    assert sorted(r.k for r in spark.read.parquet(ledger).collect()) == ["a", "b", "c", "d"]


def test_a_new_checkpoint_keeps_the_ledger(spark, tmp_path):
    folder, ledger, sent = str(tmp_path / "in"), str(tmp_path / "l"), []
    for n, names in enumerate((["a", "b"], ["a", "c"])):
        spark.createDataFrame([(x,) for x in names], "k string").write.mode("overwrite").parquet(folder)
        stream = spark.readStream.schema("k string").parquet(folder)
        SL.start_ledger_stream(
            stream, "k", ledger, str(tmp_path / f"cp{n}"), ["k"], lambda rows, _: sent.extend(r.k for r in rows.collect())
        ).awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(ledger).collect()) == sorted(sent) == ["a", "b", "c"]


def test_timeline_stream_appends(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.createDataFrame([("lara", datetime(2026, 7, 1, 8)), ("lara", datetime(2026, 7, 2, 8))], "estado string, fecha_calculo timestamp").write.parquet(path)
    stream = spark.readStream.schema("estado string, fecha_calculo timestamp").parquet(path)
    SL.start_timeline_stream(stream, str(tmp_path / "t"), str(tmp_path / "cp")).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "t"))
    assert rows.count() == 2 and "fecha_calculo_dia" in rows.columns


def test_shared_folder_and_staging(spark):
    assert shared_dir(spark) == shared_dir(spark)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    df = spark.range(10).repartition(2)
    assert stage(df).count() == 10
    assert spread(df).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    large = spark.range(100).repartition(16)
    assert spread(large) is large


def test_scratch_goes_with_its_scope(spark, tmp_path):
    from pathlib import Path

    kept = str(tmp_path / "kept")
    before = {p.name for p in Path(shared_dir(spark)).iterdir()}
    outside = scratch_path(spark, "outside")
    stage(spark.range(2), outside)
    with scratch_scope(spark):
        inner = stage(spark.range(5))
        with scratch_scope(spark):
            stage(spark.range(7))
        stage(inner.where("id > 1"), kept)
    left = {p.name for p in Path(shared_dir(spark)).iterdir()} - before
    assert left == {outside.rsplit("/", 1)[1]} and spark.read.parquet(kept).count() == 3
