"""Scans and sinks."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

_SHARED_DIR = "spark.checkpoint.dir"
LOCAL_FOLDER = "/tmp/checkpoints"


def read_table(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Scan by format name. Partition folders below ``path`` come back as columns and prune."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**(options or {})).load(path)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    files_per_partition: int = 1,
    cluster_on: Sequence[Column] = (),
    max_records_per_file: int | None = None,
    files: int | None = None,
    dynamic: bool = False,
) -> None:
    """Write a table.

    Without ``partition_by`` the rows are written where they are: no shuffle. With it they are
    clustered first, so that a task does not keep one open file per partition value.
    ``cluster_on`` spreads one partition value over ``files_per_partition`` tasks by the hash of
    those columns: a day that holds a third of all rows is then not written by one task.
    ``files`` asks for a fixed number of files at the price of a shuffle of the whole table;
    ``max_records_per_file`` bounds their size without one. ``dynamic`` overwrites only the
    partitions present in ``df``.
    """
    if files is not None:
        if partition_by:
            raise ValueError("files applies to tables without partitions")
        df = df.repartition(files)
    if partition_by:
        if files_per_partition > 1:
            if not cluster_on:
                raise ValueError("files_per_partition needs cluster_on to spread the rows by")
            piece = F.pmod(F.xxhash64(*cluster_on), F.lit(files_per_partition))
            df = df.repartition(*partition_by, piece)
        else:
            # REBALANCE lets AQE split a partition value that is too large for one task.
            df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if max_records_per_file is not None:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.save(path)


def _bucketed_name(path: str) -> str:
    return f"bucketed_{hashlib.md5(path.rstrip('/').encode()).hexdigest()[:16]}"


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Write a table in ``buckets`` files by the hash of ``keys``, sorted by them, and scan it from there.

    One shuffle at the time of writing; joins and aggregations by ``keys`` then read the table as it
    lies, however often. A null in a key is a value like others. The catalog entry belongs to the
    session; ``read_bucketed`` makes it anew in another one.
    """
    spark, name = df.sparkSession, _bucketed_name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    dealt = df.repartition(buckets, *keys)
    dealt.write.format("parquet").mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return spark.table(name)


def read_bucketed(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], buckets: int) -> DataFrame:
    """Scan a table of ``write_bucketed`` by its buckets; keys and buckets must be those it was written with."""
    name, by = _bucketed_name(path), ", ".join(f"`{k}`" for k in keys)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header. ``single_file`` is meant for results of a bounded size only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def latest_run(df: DataFrame, run_col: str = "run_id", committed: DataFrame | None = None) -> DataFrame:
    """Rows of the greatest run id, of those in ``committed`` (``run_id``) if it is given.

    On a table partitioned by the run id the scalar subquery reads partition values only
    and the outer scan prunes to one partition.
    """
    runs = df.select(run_col) if committed is None else committed.select(F.col("run_id").alias(run_col))
    newest = runs.agg(F.max(run_col).alias("newest"))
    return df.where(F.col(run_col) == newest.scalar())


# Scans pass over folders of this form, so the marks of a table lie within it.
_MARKS = "_runs"


def commit_run(spark: SparkSession, path: str, run_id: str) -> None:
    """Mark a run of the table at ``path`` as complete, once all of its rows are written.

    One row per run, below the table's folder; a run that is committed again replaces its mark.
    """
    mark = spark.range(1).select(F.lit(run_id).alias("run_id"), F.current_timestamp().alias("committed_at"), F.lit(run_id).alias("run"))
    writer = mark.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("run").parquet(f"{path.rstrip('/')}/{_MARKS}")


def revoke_run(spark: SparkSession, path: str, run_id: str) -> None:
    """Take a run's mark away, ahead of writing its rows anew."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{_MARKS}/run={run_id}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def committed_runs(spark: SparkSession, path: str) -> DataFrame:
    """(run_id, committed_at) of the complete runs of the table at ``path``; none where none was committed."""
    marks = f"{path.rstrip('/')}/{_MARKS}"
    schema = "run_id string, committed_at timestamp"
    if not path_exists(spark, marks):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(marks)


def row_audit(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """Attach counters to ``df``; they fill while the caller's own action runs."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in metrics.items()]), obs


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the session.

    A local session without the setting, where driver and executors are one process, uses
    a folder of its own below ``LOCAL_FOLDER``. A cluster must name its folder.
    """
    folder = spark.conf.get(_SHARED_DIR, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError(f"{_SHARED_DIR} must name a shared folder on a cluster")
    return f"{LOCAL_FOLDER}/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/tidewatch/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared folder and scan it from there.

    For results that several passes read. Unlike a cached block, the files survive lost executors
    and later passes read only the columns they need.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    for tables in _collecting:
        tables.append(staged)
    return staged


_collecting: list[list[DataFrame]] = []


@contextmanager
def staged_tables() -> Iterator[list[DataFrame]]:
    """Lists the tables that are staged within, for whoever writes the result to ``unstage`` them then."""
    tables: list[DataFrame] = []
    _collecting.append(tables)
    try:
        yield tables
    finally:
        _collecting.remove(tables)


def unstage(*frames: DataFrame) -> None:
    """Delete the files of staged tables that nothing reads any more; deleted ones may come again."""
    for df in frames:
        spark = df.sparkSession
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            if "/tidewatch/" not in folder:
                raise ValueError(f"not a staged table: {folder}")
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
