"""Benchmark items found in documents, also with other numbers, names and units: template canonicalisation.

Numbers, names (capitalised words inside a sentence) and units after a number become typed placeholders.  Windows of
``WINDOW`` template tokens of the benchmark are joined by hash to those of all documents.  Windows in which fewer than
half of the tokens are words would match by chance: these, and items of ``SHORT`` to ``WINDOW`` - 1 tokens as one window,
are joined by their literal tokens instead.  Windows that match lie on diagonals (position in the document less
position in the item); on each, a value of the item must always be filled by the same value, and windows that hold a
value for which that is not so are dropped.  A document holds an item if the windows that are left cover at least
``SHARE`` of the item's windows, or if ``RUN`` tokens in a row are literally the same, however long the item is.

Only documents and items that share one of the item's rarest windows are looked at: so many that no match is without
one of them, which spares the pairs that share nothing but common phrases.

Items with fewer than ``SHORT`` tokens are not looked for.  Null and empty texts hold nothing; null ids are kept.  Texts
of any length are searched whole.  Rows that agree in doc_id and text are one document, repeated items one item.  An
empty benchmark or an empty input gives no match.  Only ``doc_id`` and ``text`` are read and ``clean`` carries the row
as it is, so further columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regionpulse.llm.common import carried, held, id_of, restored, table, text_of
from regionpulse.session import stage

WINDOW = 6
SHARE = 0.5
SHORT = 3
RUN = 13
UNITS = (
    "kg|g|mg|t|km|m|cm|mm|l|ml|s|ms|min|h|hz|kwh|kw|w|v|c|f|k|mb|gb|tb|"
    "hours?|minutes?|seconds?|days?|weeks?|months?|years?|miles?|feet|inch(?:es)?|pounds?|euros?|dollars?|percent|degrees?"
)
#: A benchmark with at most so many windows (8 bytes each) is sent to every task; a larger one is joined by a shuffle.
BROADCAST_WINDOWS = 4_000_000


def marked(text: Column) -> Column:
    """Lower-case text in which names begin with ``@``, numbers are one token and units after a number begin with ``%``."""
    names = F.regexp_replace(text, r"(?<=[\p{L}\p{N},;:]\s)(?=\p{Lu})", "@")
    low = F.lower(names)
    numbers = F.regexp_replace(low, r"(?<=\d)[.,:/](?=\d)", "_")
    units = F.regexp_replace(numbers, rf"(?<=\d)\s?(?=(?:{UNITS})(?![\p{{L}}\p{{N}}]))", " %")
    return F.when(low.rlike(r"\d"), units).otherwise(low)


def tokens(marked_text: Column) -> Column:
    return F.split(F.regexp_replace(marked_text, r"^[^\p{L}\p{N}@%]+|[^\p{L}\p{N}_@%]+$", ""), r"[^\p{L}\p{N}_@%]+")


def template(marked_text: Column) -> Column:
    """``marked`` text with the values of its placeholders taken out."""
    no_names = F.when(F.contains(marked_text, F.lit("@")), F.regexp_replace(marked_text, r"@[\p{L}\p{N}_]+", "@")).otherwise(marked_text)
    filled = F.regexp_replace(F.regexp_replace(no_names, r"%\p{L}+", "%"), r"(?<![\p{L}\p{N}_])\d[\d_]*(?![\p{L}\p{N}_])", "_0_")
    return F.when(marked_text.rlike(r"\d"), filled).otherwise(no_names)


def _windows(df: DataFrame, lengths: list[int]) -> DataFrame:
    """``df`` (with text) one row per window: ``pos``, ``length`` (0 for templates) and ``hash``; ``_tokens`` is the template of the text.

    Besides the templates, windows of the literal tokens of the given lengths.
    """
    df = held(df, "_marked", marked(text_of()))
    df = held(df.withColumn("_template", template(F.col("_marked"))).drop("text"), "_tokens", tokens(F.col("_template")))
    if lengths:
        df = held(df, "_literal", F.transform(tokens(F.col("_marked")), lambda t: F.regexp_replace(t, "^[@%](?=.)", "")))
    df = df.drop("_marked", "_template")
    rows = df.select("*", F.posexplode("_tokens").alias("pos", "_token")).drop("_token")

    def window(column: str, length: int, size: int) -> Column:
        found = F.struct(F.lit(length).alias("length"), F.xxhash64(F.lit(length), F.slice(column, F.col("pos") + 1, size)).alias("hash"))
        return F.when(F.col("pos") <= F.size("_tokens") - size, found)

    if not lengths:
        rows = rows.where(F.col("pos") <= F.size("_tokens") - WINDOW)
        return rows.select("*", F.lit(0).alias("length"), F.xxhash64(F.lit(0), F.slice("_tokens", F.col("pos") + 1, WINDOW)).alias("hash"))
    kinds = F.array(window("_tokens", 0, WINDOW), *[window("_literal", k, k) for k in lengths])
    rows = rows.select("*", F.explode(kinds).alias("_window")).where("_window IS NOT NULL")
    return rows.select("*", "_window.length", "_window.hash").drop("_window", "_literal")


def item_windows(benchmark: DataFrame) -> DataFrame:
    """item_id, pos, length (of literal windows, else 0), hash, n (windows of the item) and rank (rare ones first)."""
    texts = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    rows = _windows(texts, list(range(SHORT, WINDOW + 1)))
    words = F.filter(F.slice("_tokens", F.col("pos") + 1, WINDOW), lambda t: ~t.isin("@", "%", "_0_", ""))
    wordy, size = F.size(words) * 2 >= WINDOW, F.size("_tokens")
    template_window = wordy & (F.col("length") == 0)
    literal_window = ~wordy & (F.col("length") == WINDOW)
    rows = rows.where(F.when(size < WINDOW, (F.col("length") == size) & (F.col("pos") == 0)).otherwise(template_window | literal_window))
    rows = stage(rows.select("item_id", "pos", "length", "hash").distinct())
    often = rows.groupBy("hash").agg(F.count_distinct("item_id").alias("often"))
    sizes = rows.groupBy("item_id").agg(F.count_distinct("pos").alias("n"))
    rare_first = Window.partitionBy("item_id").orderBy("often", "pos")
    return rows.join(often, "hash").join(sizes, "item_id").withColumn("rank", F.row_number().over(rare_first)).drop("often")


def _values(df: DataFrame, at: str, into: str) -> DataFrame:
    """The placeholder values of the window at ``at``, as (offset, value)."""
    df = held(df, "_values", tokens(marked(text_of())))
    slots = F.filter(
        F.transform(F.slice("_values", F.col(at) + 1, WINDOW), lambda v, k: F.struct(k.alias("k"), v.alias("value"))),
        lambda x: x["value"].rlike(r"^[@%]|^[\d_]+$"),
    )
    return df.withColumn(into, slots).drop("_values", "text")


def matches(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """One row per document and item that it holds: doc_id, item_id, n_matched, n_windows, reparameterised (other values wherever it stands).

    Also ``_id`` and ``_text``, by which ``clean`` finds the document.
    """
    spark = docs.sparkSession
    items = stage(item_windows(benchmark))
    # At most one row for each length of a short item.
    lengths = sorted(r.length for r in items.where("length > 0").select("length").distinct().collect())
    hashes = items.select("hash").distinct()
    if items.count() <= BROADCAST_WINDOWS:
        hashes = F.broadcast(hashes)
    keyed = docs.select(F.col("doc_id"), id_of().alias("_id"), F.xxhash64(text_of()).alias("_text"), F.col("text").cast("string").alias("text"))
    found = stage(_windows(keyed, lengths).join(hashes, "hash", "left_semi").select("doc_id", "_id", "_text", "pos", "hash").distinct())
    pair, line = ["_id", "_text", "item_id"], ["_id", "_text", "item_id", "diagonal"]
    # So many windows match at least, by the share or by the run; one of them is among all but so many less one.
    run = RUN - WINDOW + 1
    least = F.least(F.ceil(share * F.col("n")), F.lit(run))
    probes = items.where(F.col("rank") <= F.col("n") - least + 1).select("hash", "item_id")
    near = stage(found.select("_id", "_text", "hash").distinct().join(probes, "hash").select(*pair).distinct())
    windows = items.select("item_id", F.col("pos").alias("item_pos"), "length", "hash", "n")
    pairs = stage(found.join(near, ["_id", "_text"]).join(windows, ["hash", "item_id"]))
    enough = pairs.groupBy(*pair).agg(F.count_distinct("item_pos").alias("c"), F.first("n").alias("n")).where(F.col("c") >= least)
    likely = stage(pairs.join(enough.select(*pair), pair).withColumn("diagonal", F.col("pos") - F.col("item_pos")))
    # The values on both sides, of the few documents and items that share enough windows.
    of_items = _values(
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
        .join(likely.where("length = 0").select("item_id", "item_pos").distinct(), "item_id"), "item_pos", "item_slots",
    )
    of_items = stage(of_items.where(F.size("item_slots") > 0))
    slotted = likely.where("length = 0").join(of_items.select("item_id", "item_pos").distinct(), ["item_id", "item_pos"], "left_semi")
    places = stage(slotted.select("_id", "_text", "pos").distinct())
    good = likely.withColumn("changed", F.lit(False))
    if places.count():
        of_docs = _values(keyed.select("_id", "_text", "text").dropDuplicates(["_id", "_text"]).join(places.hint("shuffle_hash"), ["_id", "_text"]), "pos", "doc_slots")
        both = slotted.join(of_docs, ["_id", "_text", "pos"]).join(of_items, ["item_id", "item_pos"])
        filled = stage(both.select(*line, "item_pos", F.explode(F.arrays_zip(F.col("item_slots.value").alias("a"), F.col("doc_slots.value").alias("b"))).alias("s")).select(*line, "item_pos", "s.a", "s.b"))
        torn = filled.groupBy(*line, "a").agg(F.count_distinct("b").alias("values")).where("values > 1").select(*line, "a")
        lost = filled.join(torn, [*line, "a"]).select(*line, "item_pos").distinct()
        other = filled.where("a <> b").select(*line, "item_pos").distinct().withColumn("other", F.lit(True))
        good = likely.join(lost, [*line, "item_pos"], "left_anti").join(other, [*line, "item_pos"], "left")
        good = good.withColumn("changed", F.coalesce("other", F.lit(False)))
    good = stage(good.select("doc_id", *line, "item_pos", "n", "changed"))
    # Literally equal windows that follow each other on a diagonal have the same difference of position and number.
    spot = good.where("NOT changed").select(*line, "item_pos").distinct()
    follow = spot.select(*line, (F.col("item_pos") - F.row_number().over(Window.partitionBy(*line).orderBy("item_pos"))).alias("island"))
    long = follow.groupBy(*line, "island").count().where(F.col("count") >= run).select(*pair).distinct().withColumn("verbatim", F.lit(True))
    covered = good.withColumn("moved", F.max("changed").over(Window.partitionBy(*line))).groupBy("doc_id", *pair).agg(
        F.count_distinct("item_pos").alias("n_matched"), F.first("n").alias("n_windows"), F.bool_and("moved").alias("reparameterised"),
    )
    held_by = covered.join(long, pair, "left").where((F.col("n_matched") >= share * F.col("n_windows")) | F.col("verbatim"))
    return held_by.drop("verbatim")


def clean(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """The documents that hold no item, same columns."""
    held_by = stage(matches(docs, benchmark, share).select("_id", "_text").distinct())
    keyed = docs.select(*carried(docs), id_of().alias("_id"), F.xxhash64(text_of()).alias("_text"))
    return keyed.join(held_by.hint("shuffle_hash"), ["_id", "_text"], "left_anti").select(*restored(docs))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that it holds."""
    found = matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_matched", "n_windows", "reparameterised")
