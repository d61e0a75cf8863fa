"""File layouts: the raw landing zone and the Parquet warehouse.

Landing   JSON lines, one message per line, partitioned by arrival
          ``dt=YYYY-MM-DD/hour=HH``; written by ``write_raw_landing``, by the
          streaming landing job and by a landing agent, also into one base:
          all put plain files into the same folders.
Warehouse Parquet (snappy) of decoded behavior rows, partitioned by ``dt``.

Reads of given days list only those day directories (``basePath`` keeps the
partition columns), so a nightly run does not list the whole history; a day
without a directory yields no rows instead of an error, a day whose files all
have an unknown suffix is an error instead of no rows.

Writes of many days are rebalanced by folder: one pass, adaptive execution
splits busy folders over tasks and merges small ones by measured size.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstream.functions.jsonfns import decode_messages, unreadable
from shopstream.functions.timefns import local_wall_clock
from shopstream.schema import BEHAVIOR
from shopstream.sources.tables import delete_path, list_names, path_exists

# What the batch writer (.txt), the landing agent (.log) and other tools write, plain or compressed.
LANDING_SUFFIX = "*.{txt,log,json}{,.gz,.bz2,.zst,.lz4,.snappy,.deflate}"
#: Rows for one file, so that a very busy folder gets files of bounded size.
MAX_RECORDS_PER_FILE = 5_000_000
COMMIT_LOG = "_spark_metadata"


def _day_paths(spark: SparkSession, base: str, dates: Iterable[str]) -> list[str]:
    """Existing ``base/dt=<day>`` directories for the requested days."""
    base = base.rstrip("/")
    days = list(dict.fromkeys(dates))
    if len(days) > 8:  # one listing of the day names instead of a call for each
        there = set(list_names(spark, base))
        return [f"{base}/dt={d}" for d in days if f"dt={d}" in there]
    return [p for p in (f"{base}/dt={d}" for d in days) if path_exists(spark, p)]


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def _day_filter(df: DataFrame, dates: Iterable[str] | None) -> DataFrame:
    if dates is None:
        return df
    wanted = [F.lit(d).cast("date") for d in dates]
    return df.where(F.col("dt").isin(*wanted))


def refuse_commit_log(spark: SparkSession, base: str) -> None:
    """A commit log left by a streaming file sink would hide every file that is not in it."""
    if path_exists(spark, f"{base.rstrip('/')}/{COMMIT_LOG}"):
        raise ValueError(f"{base} is governed by the commit log {COMMIT_LOG} of a streaming file sink; its reads would "
                         "not see other files. Land into another folder, or remove the log once its files are complete")


def landing_columns(value: Column, at: Column, zone: str = "UTC") -> list[Column]:
    """``value, dt, hour``: a message and the folder of its arrival instant in ``zone``."""
    wall = local_wall_clock(at, zone)
    return [value.cast("string").alias("value"), F.date_format(wall, "yyyy-MM-dd").alias("dt"),
            F.date_format(wall, "HH").alias("hour")]


def write_raw_landing(messages: DataFrame, base: str, arrival: Column | None = None, zone: str = "UTC",
                      max_records_per_file: int = MAX_RECORDS_PER_FILE) -> None:
    """Append JSON messages under ``base/dt=../hour=..`` (batch form).

    ``messages`` has a string or binary ``value``; ``arrival`` is the instant
    that picks the directory (default: now, once for the whole write). The
    directory names are the date and hour of that instant in ``zone``.
    """
    refuse_commit_log(messages.sparkSession, base)
    at = arrival if arrival is not None else F.current_timestamp()
    out = messages.select(*landing_columns(F.col("value"), at, zone))
    if arrival is not None:
        out = out.hint("rebalance", "dt", "hour")
    out.write.mode("append").option("maxRecordsPerFile", max_records_per_file).partitionBy("dt", "hour").text(base)


def _check_suffix(spark: SparkSession, df: DataFrame, folders: list[str], suffix: str) -> DataFrame:
    """Folders that hold files of which none matches the suffix are an error."""
    seen = {f.rsplit("/dt=", 1)[-1].split("/", 1)[0] for f in df.inputFiles()}
    jvm = spark.sparkContext._jvm
    for folder in folders:
        if folder.rsplit("/dt=", 1)[-1] in seen:
            continue
        p = jvm.org.apache.hadoop.fs.Path(folder)
        files = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(p, True)
        while files.hasNext():
            f = files.next()
            if f.getLen() and not f.getPath().getName().startswith(("_", ".")):
                raise ValueError(f"{folder} has files, but none matches {suffix}: {f.getPath().getName()}")
    return df


def read_raw_landing(
    spark: SparkSession,
    base: str,
    dates: Iterable[str] | None = None,
    suffix: str = LANDING_SUFFIX,
) -> DataFrame:
    """Decoded behavior rows plus ``dt`` (date) and ``hour`` (int).

    The schema is fixed (never inferred) and parsing is permissive: a field of
    the wrong type is null, a malformed line is a row of nulls.
    """
    base = base.rstrip("/")
    refuse_commit_log(spark, base)
    reader = spark.read.schema(BEHAVIOR).option("pathGlobFilter", suffix)
    days = [f"{base}/{n}" for n in list_names(spark, base) if n.startswith("dt=")] if dates is None \
        else _day_paths(spark, base, dates)
    if not days:
        return _empty(spark, T.StructType(
            BEHAVIOR.fields + [T.StructField("dt", T.DateType()), T.StructField("hour", T.IntegerType())]))
    df = reader.json(base) if dates is None else reader.option("basePath", base).json(days)
    if "dt" not in df.columns:  # no file matched: no partition column could be found
        _check_suffix(spark, df, days, suffix)
        return read_raw_landing(spark, base, [], suffix)
    return _day_filter(_check_suffix(spark, df, days, suffix), dates)


def read_unreadable(spark: SparkSession, base: str, dates: Iterable[str] | None = None,
                    suffix: str = LANDING_SUFFIX) -> DataFrame:
    """``dt, hour, message``: landed lines of which no field can be read. ``read_raw_landing`` gives rows of nulls for
    them; blank lines, which it skips, are left out here too."""
    base = base.rstrip("/")
    refuse_commit_log(spark, base)
    days = [f"{base}/{n}" for n in list_names(spark, base) if n.startswith("dt=")] if dates is None \
        else _day_paths(spark, base, dates)
    if not days:
        return spark.createDataFrame([], "dt date, hour int, message string")
    lines = _day_filter(spark.read.option("pathGlobFilter", suffix).option("basePath", base).text(days), dates)
    rows = decode_messages(lines.withColumn("message", F.col("value")).where(F.trim("value") != ""))
    return rows.where(unreadable()).select("dt", "hour", "message")


def write_warehouse(behavior: DataFrame, base: str, cluster_days: bool = False, dates: Iterable[str] | None = None,
                    max_records_per_file: int = MAX_RECORDS_PER_FILE) -> None:
    """Write behavior rows with a ``dt`` column into the warehouse.

    Dynamic partition overwrite: only the days present in ``behavior`` are
    replaced, so a backfill of one day leaves every other day untouched. Days
    named in ``dates`` that have no row any more are removed, so what was
    written for them before is not taken for theirs.

    ``cluster_days`` (for writes of many days): input splits mix days, so
    without it every task writes a file into every day. Rows are sorted by
    type inside a file, so a filter on it skips row groups.
    """
    spark = behavior.sparkSession
    if cluster_days:
        behavior = behavior.hint("rebalance", "dt")
    (
        behavior.sortWithinPartitions("dt", "behavior_type")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy("dt")
        .parquet(base)
    )
    for folder in _day_paths(spark, base, dates or []):
        day = folder.rsplit("dt=", 1)[-1]
        if behavior.where(F.col("dt").cast("string") == F.lit(day)).isEmpty():
            delete_path(spark, folder)


def write_days(rows: DataFrame, base: str, dates: Iterable[str] | None = None) -> None:
    """Put rows with a ``dt`` column into a Parquet folder by day, in place of what it has for their days and for ``dates``."""
    spark = rows.sparkSession
    there = set(_day_paths(spark, base, dates or []))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(base)
    now = {str(r[0]) for r in rows.select("dt").distinct().collect()}
    for folder in there:
        if folder.rsplit("dt=", 1)[-1] not in now:
            delete_path(spark, folder)


WAREHOUSE = T.StructType(BEHAVIOR.fields + [T.StructField("dt", T.DateType())])


def read_warehouse(spark: SparkSession, base: str, dates: Iterable[str] | None = None) -> DataFrame:
    """Warehouse rows with the declared schema (also when no file exists yet).

    With ``dates`` only those day directories are listed, not the whole
    history; the ``dt`` column is kept through ``basePath``.
    """
    reader = spark.read.schema(WAREHOUSE)
    if dates is None:
        return reader.parquet(base)
    days = _day_paths(spark, base, dates)
    if not days:
        return _empty(spark, WAREHOUSE)
    return _day_filter(reader.option("basePath", base).parquet(*days), dates)
