"""Keyed upserts into the serving tables.

Re-applying a batch, or a batch with changed values, leaves one row per key
holding the latest value, so the streaming sink can be retried safely.

``upsert_files``  a Parquet table partitioned by a coarse column (a day, a
                  month). Only the partitions the batch touches are rewritten,
                  into a new version folder; then a small pointer file that
                  names the folder of each partition is put in place by one
                  rename. Readers see the table before or after a batch,
                  never in between, and a crash leaves the old pointer.
``upsert_jdbc``   a relational table with a primary key: the batch goes to a
                  staging table of its own through Spark's JDBC writer
                  (parallel, one connection per task), then one MERGE (or
                  REPLACE for MySQL) applies it in a single statement.

Layout of a file table (one writer at a time):

    <path>/version=<id>/<partition_col>=<value>/*.parquet
    <path>/_pointer/<number>      JSON: schema, and partition folder name -> version id

Reads take the schema and the folders from the pointer: nothing is inferred from
footers, and a batch lists the folders of the partitions it touches only,
however many the table has.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Partitions one batch may touch. More means that the partition column is not
#: a coarse one, which is refused rather than cut.
MAX_TOUCHED = 10_000


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _hadoop_path(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    p, fs = _hadoop_path(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; the target's parent is made if need be."""
    goal, fs = _hadoop_path(spark, target)
    fs.mkdirs(goal.getParent())
    if not fs.rename(_hadoop_path(spark, source)[0], goal):
        raise RuntimeError(f"could not move {source} to {target}")


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none if it does not exist."""
    p, fs = _hadoop_path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(x.getPath().getName() for x in fs.listStatus(p))


# ---------------------------------------------------------------- the pointer

def _pointers(spark: SparkSession, path: str) -> list[str]:
    return [n for n in list_names(spark, f"{path}/_pointer") if n.isdigit()]


@dataclass
class _Pointer:
    """A state of the table: the version that holds each partition's folder, and the table's schema."""
    folders: dict[str, str] = field(default_factory=dict)
    schema: T.StructType | None = None

    def text(self) -> str:
        return json.dumps({"schema": self.schema.jsonValue() if self.schema else None, "folders": self.folders}, sort_keys=True)

    @classmethod
    def of(cls, text: str) -> _Pointer:
        content = json.loads(text)
        if not isinstance(content.get("folders"), dict):  # of before the schema was kept: the folders alone
            return cls(content)
        return cls(content["folders"], T.StructType.fromJson(content["schema"]) if content["schema"] else None)

    def only(self, column: str, values: Sequence[str | None]) -> _Pointer:
        """The partitions whose ``column`` has one of the values, given as text."""
        wanted = {_NO_VALUE if v is None or v == "" else v for v in values}
        return _Pointer({k: v for k, v in self.folders.items() if unquote(k.removeprefix(f"{column}=")) in wanted}, self.schema)


# Fixed value: the folder that Spark writes for a null or empty partition value.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _read_pointer(spark: SparkSession, path: str, name: str) -> _Pointer:
    p, fs = _hadoop_path(spark, f"{path}/_pointer/{name}")
    stream = fs.open(p)
    try:
        data = bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()
    return _Pointer.of(data.decode())


def _write_pointer(spark: SparkSession, path: str, name: str, content: _Pointer) -> None:
    """Write beside, then rename: the pointer is there as a whole or not at all."""
    target, fs = _hadoop_path(spark, f"{path}/_pointer/{name}")
    draft, _ = _hadoop_path(spark, f"{path}/_pointer/.{name}-{uuid.uuid4().hex}")
    stream = fs.create(draft, True)
    try:
        stream.write(content.text().encode())
    finally:
        stream.close()
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, True)
        raise RuntimeError(f"{path} was changed by another writer")


def _load(spark: SparkSession, path: str, pointer: _Pointer) -> DataFrame | None:
    """The rows of the pointer's partitions; None if it has none."""
    if not pointer.folders:
        return None
    reader = spark.read.option("basePath", path)
    if pointer.schema is not None:
        reader = reader.schema(pointer.schema)
    folders = [f"{path}/version={v}/{folder}" for folder, v in sorted(pointer.folders.items())]
    return reader.parquet(*folders).drop("version")


def read_partitions(spark: SparkSession, path: str, column: str, values: Sequence[str | None]) -> DataFrame | None:
    """The partitions of the file table whose ``column`` has one of the values (as text); the others are not listed."""
    path = path.rstrip("/")
    names = _pointers(spark, path)
    return _load(spark, path, _read_pointer(spark, path, names[-1]).only(column, values)) if names else None


def read_table(spark: SparkSession, path: str, newest: int | None = None) -> DataFrame | None:
    """The file table at ``path`` as of its last complete batch, or None while it has none.

    ``newest``: only that many partitions, the last by folder name (days and
    months sort by name); the others are not listed.
    """
    path = path.rstrip("/")
    names = _pointers(spark, path)
    if not names:
        return None
    pointer = _read_pointer(spark, path, names[-1])
    if newest is not None:
        pointer = _Pointer({k: pointer.folders[k] for k in sorted(pointer.folders)[-newest:]}, pointer.schema)
    return _load(spark, path, pointer)


def partition_names(spark: SparkSession, path: str) -> list[str]:
    """Folder names (``column=value``) of the table's partitions, in order."""
    names = _pointers(spark, path.rstrip("/"))
    return sorted(_read_pointer(spark, path.rstrip("/"), names[-1]).folders) if names else []


# ---------------------------------------------------------------- file upsert

def _one_row_per_key(updates: DataFrame, keys: Sequence[str], order_by: str | None) -> DataFrame:
    """Refuse keys that a batch holds twice, or keep the row with the largest ``order_by``."""
    if order_by is None:
        twice = updates.groupBy(*keys).count().where("count > 1").limit(1).collect()
        if twice:
            raise ValueError(f"batch holds a key twice: {twice[0].asDict()}; pass order_by to keep the last row")
        return updates
    rows = updates.groupBy(*keys).agg(F.max_by(F.struct(*updates.columns), F.col(order_by)).alias("_row"))
    return rows.select(*[F.col("_row")[c].alias(c) for c in updates.columns])


def upsert_files(
    updates: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_col: str,
    order_by: str | None = None,
    many_per_key: bool = False,
) -> None:
    """Merge ``updates`` into the file table at ``path`` by ``keys``.

    ``partition_col`` must be a column of ``updates`` and a function of the
    keys (for example the day of ``window_start``), so a key never moves
    between partitions. A batch must hold a key once, unless ``order_by``
    names the column whose largest value decides, or ``many_per_key`` lets a
    key stand for a group of rows that is replaced as a whole.

    The serving tables hold few rows per partition (one per window or per
    day), so each touched partition is written by one task. A batch that is
    applied again, also after a crash at any point, gives the same table:
    nothing is looked up from earlier attempts.
    """
    spark = updates.sparkSession
    path = path.rstrip("/")
    kept = updates.storageLevel.useMemory or updates.storageLevel.useDisk  # by the caller, who may go on using it
    given = updates if kept else updates.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        updates = given if many_per_key else _one_row_per_key(given, keys, order_by)
        touched = [r[0] for r in updates.select(F.col(partition_col).cast("string")).distinct().limit(MAX_TOUCHED + 1).collect()]
        if len(touched) > MAX_TOUCHED:
            raise ValueError(f"a batch touches more than {MAX_TOUCHED} values of {partition_col}")
        if not touched:
            return
        names = _pointers(spark, path)
        pointer = _read_pointer(spark, path, names[-1]) if names else _Pointer()
        merged = updates
        if pointer.folders:
            old = _load(spark, path, pointer.only(partition_col, touched))
            columns = pointer.schema.names if pointer.schema is not None else _load(spark, path, pointer).columns
            merged = updates.select(*columns)
            if old is not None:
                same = [old[k].eqNullSafe(updates[k]) for k in keys]
                cond = same[0]
                for c in same[1:]:
                    cond = cond & c
                merged = old.join(updates.select(*keys), cond, "left_anti").unionByName(merged)
        version = uuid.uuid4().hex
        schema = pointer.schema or _table_schema(merged, partition_col)
        merged.repartition(partition_col).write.partitionBy(partition_col).parquet(f"{path}/version={version}")
    finally:
        if not kept:
            given.unpersist()
    written = [n for n in list_names(spark, f"{path}/version={version}") if "=" in n]
    number = int(names[-1]) + 1 if names else 0
    _write_pointer(spark, path, f"{number:012d}", _Pointer({**pointer.folders, **{n: version for n in written}}, schema))
    _drop_unused(spark, path)


def _table_schema(rows: DataFrame, partition_col: str) -> T.StructType:
    """Columns in the order of a read: the partition column last."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema if f.name != partition_col]
                        + [T.StructField(partition_col, rows.schema[partition_col].dataType)])


def _drop_unused(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete partition folders that none of the last ``keep`` pointers names (readers may hold the one before)."""
    names = _pointers(spark, path)
    used = {(v, k) for n in names[-keep:] for k, v in _read_pointer(spark, path, n).folders.items()}
    for n in names[:-keep]:
        for k, v in _read_pointer(spark, path, n).folders.items():
            if (v, k) not in used:
                delete_path(spark, f"{path}/version={v}/{k}")
        delete_path(spark, f"{path}/_pointer/{n}")
    live = {v for v, _ in used}
    if len(names) > keep:
        for n in list_names(spark, path):  # folders of batches that never got a pointer, or with nothing left
            if n.startswith("version=") and n.removeprefix("version=") not in live:
                delete_path(spark, f"{path}/{n}")


# ---------------------------------------------------------------- relational upsert

def _quote(name: str, dialect: str) -> str:
    q = "`" if dialect == "mysql" else '"'
    return f"{q}{name}{q}"


def merge_statement(table: str, stage: str, columns: Sequence[str], keys: Sequence[str],
                    dialect: str = "merge") -> str:
    """SQL that applies the staging table to the target table by key.

    Column names are quoted in lower case because Spark's JDBC writer creates
    the staging columns quoted.
    """
    cols = [_quote(c, dialect) for c in columns]
    if dialect == "mysql":
        return (f"REPLACE INTO {table} ({', '.join(cols)}) "
                f"SELECT {', '.join(cols)} FROM {stage}")
    if dialect != "merge":
        raise ValueError(f"unknown dialect {dialect!r}")
    on = " AND ".join(f"t.{_quote(k, dialect)} = s.{_quote(k, dialect)}" for k in keys)
    non_keys = [c for c in columns if c not in keys]
    sets = ", ".join(f"{_quote(c, dialect)} = s.{_quote(c, dialect)}" for c in non_keys)
    values = ", ".join(f"s.{c}" for c in cols)
    return (f"MERGE INTO {table} t USING {stage} s ON {on} "
            f"WHEN MATCHED THEN UPDATE SET {sets} "
            f"WHEN NOT MATCHED THEN INSERT ({', '.join(cols)}) VALUES ({values})")


def upsert_jdbc(
    updates: DataFrame,
    url: str,
    table: str,
    keys: Sequence[str],
    properties: dict[str, str] | None = None,
    dialect: str = "merge",
    stage_table: str | None = None,
    max_connections: int = 8,
) -> None:
    """Stage ``updates`` through the JDBC writer, then MERGE into ``table``.

    The target table must exist with a primary key on ``keys`` (see
    ``shopstream.schema`` for the DDL). Credentials come in ``properties``.
    The staging write opens at most ``max_connections`` connections (Spark
    coalesces the batch to that many partitions).
    """
    props = dict(properties or {})
    # A name of its own, so that jobs and replays never share a staging table.
    stage = stage_table or f"{table}_stage_{uuid.uuid4().hex[:12]}"
    (
        updates.write.format("jdbc")
        .option("url", url)
        .option("dbtable", stage)
        .option("truncate", "true")
        .option("numPartitions", str(max_connections))
        .options(**props)
        .mode("overwrite")
        .save()
    )
    sql = merge_statement(table, stage, updates.columns, keys, dialect)
    try:
        execute_jdbc(updates.sparkSession, url, [sql], props)
    finally:
        if stage_table is None:
            execute_jdbc(updates.sparkSession, url, [f"DROP TABLE {stage}"], props)


def _connect(spark: SparkSession, url: str, properties: dict[str, str] | None):
    props = dict(properties or {})
    jvm = spark.sparkContext._jvm
    jprops = jvm.java.util.Properties()
    for k in ("user", "password"):
        if k in props:
            jprops.setProperty(k, props[k])
    if "driver" in props:
        jvm.java.lang.Class.forName(props["driver"])
    return jvm.java.sql.DriverManager.getConnection(url, jprops)


def execute_jdbc(spark: SparkSession, url: str, statements: Sequence[str],
                 properties: dict[str, str] | None = None) -> None:
    """Run statements in one transaction on a driver-side JDBC connection."""
    conn = _connect(spark, url, properties)
    try:
        conn.setAutoCommit(False)
        stmt = conn.createStatement()
        try:
            for sql in statements:
                stmt.executeUpdate(sql)
            conn.commit()
        except Exception:
            conn.rollback()
            raise
        finally:
            stmt.close()
    finally:
        conn.close()


def ensure_jdbc_table(spark: SparkSession, url: str, table: str, ddl: str,
                      properties: dict[str, str] | None = None) -> None:
    """Create a serving table from its DDL unless the database lists it.

    A failed connection or a refused user is an error, not an absent table.
    """
    conn = _connect(spark, url, properties)
    try:
        found = False
        for name in {table, table.lower(), table.upper()}:
            tables = conn.getMetaData().getTables(None, None, name, None)
            found = found or bool(tables.next())
            tables.close()
    finally:
        conn.close()
    if not found:
        execute_jdbc(spark, url, [ddl], properties)


def read_serving_jdbc(spark: SparkSession, url: str, table: str,
                      properties: dict[str, str] | None = None) -> DataFrame:
    """A serving table from a relational store, for the ``serving`` views."""
    return spark.read.format("jdbc").option("url", url).option("dbtable", table).options(
        **(properties or {})).load()


def read_serving_files(spark: SparkSession, path: str, newest: int | None = None) -> DataFrame:
    """A serving table kept by ``upsert_files``; ``newest`` limits it to the last partitions."""
    table = read_table(spark, path, newest)
    if table is None:
        raise FileNotFoundError(f"no serving table at {path}")
    return table
