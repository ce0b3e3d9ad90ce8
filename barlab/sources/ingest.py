"""Landed vendor payloads to bars.

Pages are landed first, one JSON document per file under ``symbol=/dt=``
(:func:`land_pages`); :func:`read_landed` reads whole files, so a page may hold line
breaks, and keeps a row for every file that lies there: one that can't be read, a
cut-off archive for example, comes with a NULL body instead of ending the run.
Parsing is permissive with a fixed schema; no driver loop or network call.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlab.operators.medallion import canonical_bars
from barlab.schemas import BARS_JSON_PAGE


def land_pages(pages: DataFrame, path: str, body: str = "body", keys: Sequence[str] = ("symbol", "dt", "page"),
               compression: str = "none") -> str:
    """Writes each page as a file of its own, ``<path>/symbol=/dt=/page=/``."""
    pages.select(*keys, F.col(body)).write.mode("append").option("compression", compression).partitionBy(*keys).text(path)
    return path


def read_landed(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``file, bytes, symbol, dt, body`` of every file under ``path`` whose name
    matches ``pattern``; ``body`` is NULL for a file that can't be read.

    The listing comes from file metadata alone; texts are read whole, one file a
    row, with unreadable files skipped, and joined to the listing, so what was
    skipped is known by name."""
    part = lambda name: F.nullif(F.regexp_extract("file", f"{name}=([^/]+)", 1), F.lit(""))
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    listed = reader.format("binaryFile").load(path).select(F.col("path").alias("file"), F.col("length").alias("bytes"))
    texts = (reader.option("ignoreCorruptFiles", "true").text(path, wholetext=True)
             .select(F.col("_metadata.file_path").alias("text_file"), F.col("value").alias("body")))
    # both name a file by its last three folders and its name, however the scheme is written
    key = lambda c: F.regexp_extract(c, "([^/]*/[^/]*/[^/]*/[^/]+)$", 1)
    joined = listed.withColumn("__k", key("file")).join(texts.withColumn("__k", key("text_file")).drop("text_file"), "__k", "left")
    return joined.select("file", "bytes", part("symbol").alias("symbol"), part("dt").cast("date").alias("dt"), "body")


def day_status(landed: DataFrame, widen: int = 0, body: str = "body", schema: T.StructType = BARS_JSON_PAGE) -> DataFrame:
    """Per symbol and day from the first to the last landed one, ``widen`` days more
    on each side: files, files that failed (unreadable or not a page), bars of the
    others, and a status: ``failed`` if any file of the day did, else ``ok`` or
    ``empty`` (S2)."""
    parsed = parse_pages(landed, body, ("symbol", "dt"), schema)
    bad = F.col("_corrupt").isNotNull()
    counts = parsed.groupBy("symbol", "dt").agg(
        F.count(F.lit(1)).alias("files"), F.count_if(bad).alias("failed"),
        F.coalesce(F.sum(F.when(~bad, F.greatest(F.size(F.coalesce("p.bars", F.array().cast(schema["bars"].dataType))), F.lit(0)))),
                   F.lit(0)).alias("bars"))
    per_symbol = counts.groupBy("symbol").agg(
        F.date_sub(F.min("dt"), widen).alias("start"), F.date_add(F.max("dt"), widen).alias("end"),
        F.map_from_entries(F.collect_list(F.struct("dt", F.struct("files", "failed", "bars")))).alias("by_day"))
    days = day_range(per_symbol).withColumn("d", F.try_element_at("by_day", F.col("dt")))
    n = lambda c: F.coalesce(F.col(f"d.{c}"), F.lit(0))
    return days.select("symbol", "dt", n("files").alias("n_files"), n("failed").alias("n_failed"), n("bars").alias("n_bars"),
                       F.when(n("failed") > 0, "failed").when(n("bars") > 0, "ok").otherwise("empty").alias("status"))


def parse_pages(pages: DataFrame, body: str = "body", keep: Sequence[str] = ("symbol",),
                schema: T.StructType = BARS_JSON_PAGE) -> DataFrame:
    """``keep``, the parsed page ``p``, and ``_corrupt``: the text of a page that
    does not parse (NULL otherwise).  A NULL body is no page and is corrupt with
    an empty text."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json(F.col(body), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    out = pages.select(*keep, F.col(body).alias("_body"), parsed.alias("p"))
    return out.select(*keep, "p", F.when(F.col("_body").isNull(), F.lit("")).otherwise(F.col("p._corrupt")).alias("_corrupt"))


def flatten_pages(pages: DataFrame, body: str = "body", keep: Sequence[str] = ("symbol",),
                  schema: T.StructType = BARS_JSON_PAGE) -> DataFrame:
    """One row per bar of every page that parses; a page with ``bars: null``
    contributes nothing (S1, X16).  :func:`corrupt_pages` has the others."""
    parsed = parse_pages(pages, body, keep, schema).filter(F.col("_corrupt").isNull())
    return parsed.select(*keep, F.explode("p.bars").alias("b")).select(*keep, "b.*")


def corrupt_pages(pages: DataFrame, body: str = "body", keep: Sequence[str] = ("symbol",),
                  schema: T.StructType = BARS_JSON_PAGE) -> DataFrame:
    """Pages whose body does not parse, with their text in ``_corrupt``."""
    return parse_pages(pages, body, keep, schema).filter(F.col("_corrupt").isNotNull()).select(*keep, "_corrupt")


def ingest_bars_json(pages: DataFrame, body: str = "body") -> DataFrame:
    """Landed pages -> canonical bars ``symbol, ts, open, high, low, close,
    volume`` with ``dt`` (S1 + S3)."""
    flat = flatten_pages(pages, body)
    out = canonical_bars(flat, extra=("symbol",))
    return out.withColumn("dt", F.to_date("ts"))


def day_range(bounds: DataFrame, start: str = "start", end: str = "end", out: str = "dt") -> DataFrame:
    """Inclusive calendar days between two date columns, one row each."""
    keep = [c for c in bounds.columns if c not in (start, end)]
    return bounds.select(*keep, F.explode(F.sequence(F.col(start), F.col(end),
                                                     F.expr("INTERVAL 1 DAY"))).alias(out))


def ingest_day_range(bars: DataFrame, start: str | None = None, end: str | None = None, widen: int = 0) -> DataFrame:
    """Per symbol and requested day: bars landed and a status, days without
    data included (S2).  The range defaults to each symbol's first..last day,
    ``widen`` days more on each side.  Bars are read once: days are counted,
    collected per symbol (one entry a day) and looked up for each day."""
    counts = bars.groupBy("symbol", "dt").agg(F.count(F.lit(1)).alias("n"))
    per_symbol = counts.groupBy("symbol").agg(F.min("dt").alias("first"), F.max("dt").alias("last"),
                                              F.map_from_entries(F.collect_list(F.struct("dt", "n"))).alias("n_by_day"))
    lo = F.lit(start).cast("date") if start is not None else F.date_sub("first", widen)
    hi = F.lit(end).cast("date") if end is not None else F.date_add("last", widen)
    days = day_range(per_symbol.withColumns({"start": lo, "end": hi}))
    n = F.coalesce(F.try_element_at("n_by_day", F.col("dt")), F.lit(0))
    return days.select("symbol", "dt", n.alias("n_bars"),
                       F.when(n > 0, F.lit("ok")).otherwise(F.lit("empty")).alias("status"))


def explode_option_chain(chains: DataFrame, body: str = "body", k: int = 3,
                         contract: T.StructType | None = None, keep: Sequence[str] = ("symbol", "dt")) -> DataFrame:
    """First ``k`` contracts of each landed ``{"option_chain": [...]}``
    document (S25); the contract schema is the caller's (S26)."""
    from barlab.schemas import OPTION_CONTRACT
    schema = T.StructType([T.StructField("option_chain", T.ArrayType(contract or OPTION_CONTRACT))])
    parsed = chains.select(*keep, F.from_json(F.col(body), schema)["option_chain"].alias("chain"))
    ex = parsed.select(*keep, F.posexplode_outer("chain").alias("pos", "c")).filter(F.col("c").isNotNull())
    return ex.filter(F.col("pos") < k).select(*keep, "pos", "c.*")
