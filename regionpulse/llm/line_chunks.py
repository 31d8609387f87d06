"""Removal of repeated runs of lines, cut into chunks by their content.

A rolling hash over the hashes of the last two lines decides after which lines a chunk ends, so the same run of lines
is cut at the same places wherever it stands in a document.  Chunks with at least ``MIN_LINES`` lines that are not
blank are compared over all documents: first by hash, then byte by byte.  Of equal chunks the one that stands first,
by (doc_id, position), stays.

Rows that agree in doc_id and text are one document and get the same result.  A null text has no lines to remove and
stays null; null ids come last.  A document whose lines are all removed keeps its row with an empty text.  Extra
columns are kept as they are; ``n_chars`` follows the text.

Chunks miss what has no two boundaries of its own: short passages, and the ends of long ones.  ``dedup_passages`` has no
boundaries.  Every two lines in a row that are not blank, with the blank ones between them, are compared, first by hash,
then byte by byte, and go where they stand earlier.  So every passage of two or more such lines goes whole, and an
earlier copy of each line that goes stays.

``dedup_lines``, which the pipeline uses, removes the repeated chunks and extends them by the repeated pairs of lines
around and between them.  Both are found in the texts as they came, so that no removal hides or makes a repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regionpulse.llm.common import carried, held, id_of, release, restored, table, text_of
from regionpulse.session import stage

#: A chunk ends after one line in so many.
DIVISOR = 3
#: Weight of the line before in the rolling hash.
BASE = 31
MIN_LINES = 2


def line_hash(line: Column) -> Column:
    """28 bits of a line's MD5."""
    return F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("long")


def chunked(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``_chunks``, an array of (start, n, chunk): first line, number of lines, and the lines themselves."""
    df = held(docs, "_lines", F.split(text_of(text), "\n", -1))
    df = held(df, "_hashes", F.transform("_lines", line_hash))
    ends = F.filter(
        F.sequence(F.lit(1), F.size("_lines")),
        lambda i: (i == F.size("_lines"))
        | ((i > 1) & ((F.element_at("_hashes", i) + BASE * F.element_at("_hashes", F.greatest(i - 1, F.lit(1)))) % DIVISOR == 0)),
    )
    df = held(df, "_ends", ends)
    spans = F.transform("_ends", lambda end, k: F.struct(F.when(k == 0, 0).otherwise(F.get("_ends", k - 1)).alias("start"), end.alias("end")))
    df = held(df, "_spans", spans)
    chunks = F.transform(
        "_spans",
        lambda s: F.struct(
            s["start"].alias("start"), (s["end"] - s["start"]).alias("n"),
            F.array_join(F.slice("_lines", s["start"] + 1, s["end"] - s["start"]), "\n").alias("chunk"),
        ),
    )
    return held(df, "_chunks", chunks).drop("_lines", "_hashes", "_ends", "_spans")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(*carried(docs), "text", id_of().alias("_id"), F.xxhash64(text_of()).alias("_text"))


def _changed(docs: DataFrame, rows: DataFrame, untouched: Column) -> DataFrame:
    """``docs`` with ``_stay`` of ``rows`` as text, except where it is untouched; ``n_chars`` follows the text."""
    new = {"text": F.when(untouched, F.col("text")).otherwise(F.col("_stay"))}
    if "n_chars" in docs.columns:
        before = F.col(f"carried_{docs.columns.index('n_chars')}")
        new["n_chars"] = F.when(untouched, before).otherwise(F.char_length("_stay")).cast(docs.schema["n_chars"].dataType)
    return rows.select(*restored(docs, **new))


def _chunk_rows(df: DataFrame) -> DataFrame:
    """One row per chunk of enough lines: where it stands, and its text."""
    rows = chunked(df).select("_id", "_text", F.inline("_chunks")).where(F.col("n") >= MIN_LINES)
    return rows.where(F.size(F.filter(F.split("chunk", "\n", -1), lambda x: F.trim(x) != "")) >= MIN_LINES)


def _repeated(docs: DataFrame) -> DataFrame:
    """``_id``, ``_text``, ``start`` and ``chunk`` of the chunks that stand earlier in the corpus."""
    spark = docs.sparkSession
    light = stage(
        _chunk_rows(_keyed(docs).select("_id", "_text", "text")).select(
            "_id", "_text", "start", F.xxhash64("chunk").alias("hash"), F.octet_length("chunk").alias("size")
        )
    )
    place = F.struct("_id", "_text", "start")
    repeated = stage(
        light.groupBy("hash", "size").agg(F.min(place).alias("first"), F.count_distinct(place).alias("n")).where("n > 1").drop("n")
    )
    release(spark)
    wanted = stage(light.join(repeated, ["hash", "size"]).groupBy("_id", "_text").agg(F.collect_list(F.struct("start", "hash", "size", "first")).alias("wanted")))
    # The texts of chunks that may be repeated, to be compared byte by byte with the first of their kind.
    texts = _keyed(docs).select("_id", "_text", "text").join(wanted.hint("shuffle_hash"), ["_id", "_text"])
    texts = held(chunked(texts), "_wanted", F.transform(
        "wanted",
        lambda w: F.struct(
            w["start"].alias("start"), w["hash"].alias("hash"), w["size"].alias("size"), w["first"].alias("first"),
            F.filter("_chunks", lambda c: c["start"] == w["start"])[0]["chunk"].alias("chunk"),
        ),
    ))
    texts = texts.select("_id", "_text", F.inline("_wanted")).withColumn("is_first", F.col("first") == F.struct("_id", "_text", "start"))
    texts = stage(texts.drop("first").dropDuplicates(["_id", "_text", "start"]))
    release(spark)
    firsts = texts.where("is_first").select("hash", "size", F.col("chunk").alias("first_chunk"))
    return texts.where("not is_first").join(firsts, ["hash", "size"]).where("chunk = first_chunk").select("_id", "_text", "start", "chunk")


def removals(docs: DataFrame) -> DataFrame:
    """``_id``, ``_text`` and ``starts``: the first lines of the chunks that each document loses."""
    return stage(_repeated(docs).groupBy("_id", "_text").agg(F.collect_set("start").alias("starts")))


def _kept(df: DataFrame) -> DataFrame:
    """``docs`` joined to its removals, cut again: ``_left`` are the chunks that stay, ``_stay`` is their text."""
    df = chunked(df.withColumn("_starts", F.coalesce("starts", F.array().cast("array<int>"))))
    left = F.filter("_chunks", lambda c: ~F.array_contains(F.col("_starts"), c["start"]))
    return held(df, "_left", left).withColumn("_stay", F.array_join(F.col("_left.chunk"), "\n"))


def dedup(docs: DataFrame) -> DataFrame:
    """``docs`` without repeated chunks, same columns."""
    joined = _keyed(docs).join(removals(docs).hint("shuffle_hash"), ["_id", "_text"], "left")
    return _changed(docs, _kept(joined), F.col("starts").isNull())


def _paired(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_lines``, and ``_pairs``, an array of (start, end): each line that is not blank and the next one."""
    df = held(docs, "_lines", F.split(text_of(), "\n", -1))
    full = F.filter(F.sequence(F.lit(0), F.size("_lines") - 1), lambda i: F.trim(F.get("_lines", i)) != "")
    df = held(df, "_full", full)
    pairs = F.zip_with("_full", F.slice("_full", F.lit(2), F.size("_full")), lambda a, b: F.struct(a.alias("start"), b.alias("end")))
    return held(df, "_pairs", F.filter(pairs, lambda p: p["end"].isNotNull())).drop("_full")


def _between(pair: Column) -> Column:
    """The lines from the start of a pair to its end."""
    return F.array_join(F.slice("_lines", pair["start"] + 1, pair["end"] - pair["start"] + 1), "\n")


def passages(docs: DataFrame) -> DataFrame:
    """``_id``, ``_text`` and ``gone``: the pairs of lines, as (start, end), that stand earlier in the corpus, in order."""
    spark = docs.sparkSession
    keyed = _keyed(docs).select("_id", "_text", "text")
    marks = F.transform(
        "_pairs",
        lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"), F.xxhash64(_between(p)).alias("hash"), F.octet_length(_between(p)).alias("size")),
    )
    light = stage(_paired(keyed).select("_id", "_text", F.inline(marks)))
    place = F.struct("_id", "_text", "start")
    repeated = stage(light.groupBy("hash", "size").agg(F.min(place).alias("first"), F.count_distinct(place).alias("n")).where("n > 1").drop("n"))
    release(spark)
    found = light.join(repeated, ["hash", "size"])
    wanted = stage(found.groupBy("_id", "_text").agg(F.collect_set(F.struct("start", "end", "hash", "size", "first")).alias("wanted")))
    texts = held(keyed.join(wanted.hint("shuffle_hash"), ["_id", "_text"]), "_lines", F.split(text_of(), "\n", -1))
    texts = texts.select("_id", "_text", F.inline(F.transform(
        "wanted",
        lambda w: F.struct(
            w["start"].alias("start"), w["end"].alias("end"), w["hash"].alias("hash"), w["size"].alias("size"), w["first"].alias("first"), _between(w).alias("chunk")
        ),
    )))
    texts = texts.withColumn("is_first", F.col("first") == F.struct("_id", "_text", "start"))
    texts = stage(texts.drop("first").dropDuplicates(["_id", "_text", "start"]))
    release(spark)
    firsts = texts.where("is_first").select("hash", "size", F.col("chunk").alias("first_chunk"))
    same = texts.where("not is_first").join(firsts, ["hash", "size"]).where("chunk = first_chunk")
    return stage(same.groupBy("_id", "_text").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("gone")))


def _without_passages(docs: DataFrame) -> DataFrame:
    """``docs`` with ``gone``, ``_lines``, ``_ranges`` of lines that stay (first, and the one after the last) and ``_stay``, their text."""
    df = _keyed(docs).join(passages(docs).hint("shuffle_hash"), ["_id", "_text"], "left")
    df = held(df, "_lines", F.split(text_of(), "\n", -1))
    df = held(df, "_gone", F.coalesce("gone", F.array().cast("array<struct<start:int,end:int>>")))
    # Starts and ends both rise from pair to pair.
    ranges = F.transform(
        F.sequence(F.lit(0), F.size("_gone")),
        lambda k: F.struct(
            F.coalesce(F.get("_gone", k - 1)["end"] + 1, F.lit(0)).alias("start"), F.coalesce(F.get("_gone", k)["start"], F.size("_lines")).alias("stop")
        ),
    )
    df = held(df, "_ranges", F.filter(ranges, lambda r: r["stop"] > r["start"]))
    kept = F.transform("_ranges", lambda r: F.array_join(F.slice("_lines", r["start"] + 1, r["stop"] - r["start"]), "\n"))
    return held(df, "_stay", F.array_join(kept, "\n"))


def dedup_passages(docs: DataFrame) -> DataFrame:
    """``docs`` without repeated passages of two or more lines, same columns."""
    return _changed(docs, _without_passages(docs), F.col("gone").isNull())


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` without repeated chunks, nor the repeated passages of two or more lines that chunks miss, same columns."""
    last = F.col("start") + F.size(F.split("chunk", "\n", -1)) - 1
    chunks = stage(_repeated(docs).select("_id", "_text", "start", last.alias("end")))
    pairs = passages(docs).select("_id", "_text", F.inline("gone"))
    lost = stage(chunks.unionAll(pairs).groupBy("_id", "_text").agg(F.collect_list(F.struct("start", "end")).alias("lost")))
    df = _keyed(docs).join(lost.hint("shuffle_hash"), ["_id", "_text"], "left")
    df = held(df, "_lines", F.split(text_of(), "\n", -1))
    gone = F.flatten(F.transform(F.coalesce("lost", F.array().cast("array<struct<start:int,end:int>>")), lambda s: F.sequence(s["start"], s["end"])))
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), gone)
    return _changed(docs, held(df, "_stay", F.array_join(F.transform(left, lambda i: F.get("_lines", i)), "\n")), F.col("lost").isNull())


def passage_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document keeps of its lines when repeated passages go; a null text counts as one empty line."""
    stay = F.aggregate("_ranges", F.lit(0), lambda n, r: n + r["stop"] - r["start"])
    return _without_passages(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        F.col("carried_0").alias("doc_id"), F.size("_lines").cast("long").alias("n_lines"), (F.size("_lines") - stay).cast("long").alias("n_removed"),
        F.sha2(F.col("_stay").cast("binary"), 256).alias("kept_sha256"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document keeps; a null text counts as one empty line."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    joined = _keyed(docs).join(removals(docs).hint("shuffle_hash"), ["_id", "_text"], "left")
    lines = lambda chunks: F.aggregate(chunks, F.lit(0), lambda n, c: n + c["n"]).cast("long")
    return _kept(joined).select(
        F.col("carried_0").alias("doc_id"),
        lines("_chunks").alias("n_lines"),
        F.size("_chunks").cast("long").alias("n_chunks"),
        (lines("_chunks") - lines("_left")).alias("n_removed"),
        F.sha2(F.col("_stay").cast("binary"), 256).alias("kept_sha256"),
    )


ORACLE = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents),
hashed AS (SELECT *, ('0x' || substr(md5(line), 1, 7))::BIGINT AS h FROM lines),
rolled AS (SELECT *, coalesce((h + {BASE} * lag(h) OVER w) % {DIVISOR} = 0, FALSE) AS cut FROM hashed WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (SELECT *, coalesce(sum(cut::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c FROM rolled),
chunks AS (SELECT doc_id, c, count(*) AS n, count(*) FILTER (trim(line) <> '') AS full_lines, string_agg(line, chr(10) ORDER BY i) AS chunk FROM numbered GROUP BY ALL),
judged AS (SELECT *, n >= {MIN_LINES} AND full_lines >= {MIN_LINES} AND row_number() OVER (PARTITION BY chunk, full_lines >= {MIN_LINES} ORDER BY doc_id, c) > 1 AS gone FROM chunks)
SELECT doc_id, sum(n)::BIGINT AS n_lines, count(*)::BIGINT AS n_chunks, coalesce(sum(n) FILTER (gone), 0)::BIGINT AS n_removed,
       sha256(coalesce(string_agg(chunk, chr(10) ORDER BY c) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
