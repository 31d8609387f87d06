"""A ledger of keys that is opened only where a key may be.

Keys are dealt out to ``buckets`` partitions by hash.  What is recorded at a time is a set of its own: its keys, and for
each partition a Bloom filter, a table of 64-bit words.  To look up a batch, its keys are joined to the words of
their places in the filters; only the partitions of sets whose filter answers are opened.  New keys open nearly none,
however large the ledger is.  ``FAN`` sets of one generation are merged into one of the next, so a ledger of n keys has
some ``FAN`` * log n sets.  The list of sets is a version (:mod:`regionpulse.sources.versions`): a set is there as a
whole or not at all, and writers that meet try again on what the other one has written.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regionpulse.session import stage
from regionpulse.sources.versions import Conflict, commit, latest

BUCKETS = 64
FAN = 8
# Places of a key in a filter, and bits of a filter for each key, at least.
PLACES = 6
BITS_PER_KEY = 16


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("cubo"), key), F.lit(buckets)).cast("int")


def _place(key: str, turn: Column, bits: Column) -> Column:
    """The place of a key in a filter at each turn: two hashes, the second odd."""
    first, step = (F.pmod(F.xxhash64(F.lit(salt), key), F.lit(1 << 40)) for salt in ("inicio", "paso"))
    return F.pmod(first + turn * step.bitwiseOR(F.lit(1)), bits)


def _bit(place: str) -> Column:
    """The bit of a place in its word of 64."""
    return F.col(place).bitwiseAND(F.lit(63)).cast("int")


def _turns(df: DataFrame) -> DataFrame:
    return df.withColumn("_turno", F.explode(F.sequence(F.lit(0), F.lit(PLACES - 1))))


def _folder(root: str) -> str:
    return f"{root}/claves/conjunto"


def _read_keys(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], "clave string, conjunto string, cubo int")
    return spark.read.option("basePath", f"{root}/claves").schema("clave string, conjunto string, cubo int").parquet(*paths)


def _write_set(keys: DataFrame, key: str, root: str, buckets: int) -> dict:
    """Keys and filters of a new set; what is written without being listed later is never read."""
    spark = keys.sparkSession
    name = uuid.uuid4().hex
    rows = keys.select(F.col(key).cast("string").alias("clave")).where("clave IS NOT NULL").distinct()
    rows = rows.withColumn("cubo", _bucket("clave", buckets))
    rows.repartition("cubo").sortWithinPartitions("cubo", "clave").write.partitionBy("cubo").parquet(f"{_folder(root)}={name}")
    rows = _read_keys(spark, root, [f"{_folder(root)}={name}"])
    # A power of two, so that every filter has whole words; at most one row for each bucket.
    sizes = rows.groupBy("cubo").agg(F.count("*").alias("n"))
    sizes = stage(sizes.withColumn("bits", F.pow(F.lit(2.0), F.ceil(F.log2(F.col("n") * BITS_PER_KEY + 64))).cast("long")))
    placed = _turns(rows.join(F.broadcast(sizes.select("cubo", "bits")), "cubo"))
    place = _place("clave", F.col("_turno"), F.col("bits"))
    words = placed.select("cubo", "bits", place.alias("_p")).select(
        "cubo", "bits", F.shiftright("_p", 6).alias("palabra"), F.call_function("shiftleft", F.lit(1).cast("long"), _bit("_p")).alias("_bit")
    )
    words.groupBy("cubo", "bits", "palabra").agg(F.bit_or("_bit").alias("marcas")).write.parquet(f"{root}/filtros/conjunto={name}")
    # Few numbers: one row for each bucket.
    counts = {r.cubo: [r.n, r.bits] for r in sizes.collect()}
    return {"nombre": name, "cubos": {str(c): v for c, v in sorted(counts.items())}}


def _changed(spark: SparkSession, root: str, change) -> None:
    """Commit ``change`` of the list of sets, again on every list that another writer puts in front of it."""
    while True:
        number, now = latest(spark, root)
        sets = change(now.get("conjuntos", []))
        try:
            commit(spark, root, {"cubos": now.get("cubos", BUCKETS), "conjuntos": sets}, number)
            return
        except Conflict:
            continue


def buckets_of(spark: SparkSession, root: str) -> int:
    return latest(spark, root)[1].get("cubos", BUCKETS)


def create(spark: SparkSession, root: str, buckets: int = BUCKETS) -> None:
    """An empty ledger with a number of partitions of its own; :class:`Conflict` if it is there already."""
    commit(spark, root, {"cubos": buckets, "conjuntos": []}, 0)


def record(keys: DataFrame, key: str, root: str, batch: str) -> None:
    """Add the keys of a batch; a batch of the same name is replaced."""
    spark = keys.sparkSession
    new = _write_set(keys, key, root, buckets_of(spark, root)) | {"lote": batch, "generacion": 0}
    _changed(spark, root, lambda sets: [s for s in sets if s.get("lote") != batch] + [new])


def read_keys(spark: SparkSession, root: str) -> DataFrame:
    """``clave`` of everything recorded, each once."""
    sets = latest(spark, root)[1].get("conjuntos", [])
    return _read_keys(spark, root, [f"{_folder(root)}={s['nombre']}" for s in sets if s["cubos"]]).select("clave").distinct()


def likely_partitions(keys: DataFrame, root: str, without: str | None = None) -> list[tuple[str, int]]:
    """Sets and buckets whose filters answer for one of the keys (``clave``, each once); ``without`` names a batch."""
    spark = keys.sparkSession
    now = latest(spark, root)[1]
    sets = [s for s in now.get("conjuntos", []) if s["cubos"] and s.get("lote") != without]
    if not sets:
        return []
    # At most the number of sets times the number of buckets.
    sizes = [(s["nombre"], int(c), v[1]) for s in sets for c, v in s["cubos"].items()]
    known = F.broadcast(spark.createDataFrame(sizes, "conjunto string, cubo int, bits long"))
    asked = keys.select("clave", _bucket("clave", now["cubos"]).alias("cubo")).join(known, "cubo")
    asked = _turns(asked).withColumn("_p", _place("clave", F.col("_turno"), F.col("bits")))
    asked = asked.select("clave", "conjunto", "cubo", F.shiftright("_p", 6).alias("palabra"), _bit("_p").alias("_b"))
    filters = spark.read.option("basePath", f"{root}/filtros").schema("cubo int, palabra long, marcas long, conjunto string")
    words = filters.parquet(*[f"{root}/filtros/conjunto={s['nombre']}" for s in sets])
    hit = F.call_function("shiftrightunsigned", F.col("marcas"), F.col("_b")).bitwiseAND(F.lit(1)) == 1
    answers = asked.join(words, ["conjunto", "cubo", "palabra"]).where(hit).groupBy("conjunto", "cubo", "clave").count()
    found = answers.where(F.col("count") == PLACES).select("conjunto", "cubo").distinct().collect()
    return sorted((r.conjunto, r.cubo) for r in found)


def unseen(rows: DataFrame, key: str, root: str, without: str | None = None) -> DataFrame:
    """Rows whose key is not recorded; rows without a key stay.  ``without`` leaves a batch out of the ledger."""
    spark = rows.sparkSession
    text = F.col(key).cast("string")
    keys = stage(rows.select(text.alias("clave")).where("clave IS NOT NULL").distinct())
    open_ = likely_partitions(keys, root, without)
    if not open_:
        return rows
    opened = _read_keys(spark, root, [f"{_folder(root)}={name}/cubo={bucket}" for name, bucket in open_])
    seen = opened.select("clave").join(keys, "clave", "left_semi").distinct()
    return rows.join(seen.withColumnRenamed("clave", "_vista"), text == F.col("_vista"), "left_anti")


def compact(spark: SparkSession, root: str, ready) -> None:
    """Merge every ``FAN`` sets of a generation into one of the next.

    ``ready`` tells of a set's entry whether its batch is done; a batch that may run again must stay a set of its own.
    """
    while True:
        sets = [s for s in latest(spark, root)[1].get("conjuntos", []) if ready(s)]
        full = next((g for g in sorted({s["generacion"] for s in sets}) if sum(s["generacion"] == g for s in sets) >= FAN), None)
        if full is None:
            return
        merged = [s for s in sets if s["generacion"] == full][:FAN]
        names = {s["nombre"] for s in merged}
        keys = _read_keys(spark, root, [f"{_folder(root)}={s['nombre']}" for s in merged if s["cubos"]])
        new = _write_set(keys, "clave", root, buckets_of(spark, root)) | {"generacion": full + 1}

        def change(now: list[dict], names=names, new=new) -> list[dict]:
            # Only while all of them are still there: another writer may have merged them.
            gone = not names <= {s["nombre"] for s in now}
            return now if gone else [s for s in now if s["nombre"] not in names] + [new]

        _changed(spark, root, change)
