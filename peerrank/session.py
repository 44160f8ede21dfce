"""Session settings and lineage cuts.

The library never creates a session on its own; callers pass one in.
``local_session`` is a convenience for tests, the bench and the CLI.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings the engine relies on.  AQE re-plans joins and coalesces small
# shuffle partitions at run time; the skew-join rule splits hot partitions.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "peerrank") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in ENGINE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only in local mode.

    On a cluster the folder must be shared storage named by
    ``spark.checkpoint.dir``; a machine-local temporary folder would be lost
    with the executor that wrote it, so it is refused there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage "
            "(HDFS/object store) so iterative jobs can cut lineage"
        )
    path = tempfile.mkdtemp(prefix="peerrank-ckpt-", dir="/tmp")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


# Spark's own limit on the buckets of a table (spark.sql.sources.bucketing.maxBuckets).
MAX_BUCKETS = 100_000


def layout_partitions(spark: SparkSession, partitions: int | None = None) -> int:
    """Partitions of a layout that lineage cuts keep: ``partitions`` or the
    session's shuffle partitions, and never more than a table may have buckets,
    so that shuffles and buckets always agree."""
    return min(partitions or int(spark.conf.get("spark.sql.shuffle.partitions")), MAX_BUCKETS)


# --- scratch data of a run ------------------------------------------------------
#
# Lineage cuts are tables and files in the shared checkpoint folder.  They belong
# to a run: everything of a run lies in one folder and one database, both named
# after it, so ending a run deletes its own scratch data and nothing else.

_current_run: ContextVar[str | None] = ContextVar("peerrank_run", default=None)
_session_runs: dict[str, str] = {}


def run_id(spark: SparkSession) -> str:
    """The run that cuts made now belong to: the innermost ``scratch_run``, or
    one for the whole application."""
    return _current_run.get() or _session_runs.setdefault(spark.sparkContext.applicationId, uuid.uuid4().hex)


def run_folder(spark: SparkSession, run: str | None = None) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/peerrank-run-{run or run_id(spark)}"


def _run_database(run: str) -> str:
    return f"peerrank_run_{run}"


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[str]:
    """Cuts made inside belong to a run of their own, dropped at the end
    (also after an error).  Write results before leaving it."""
    run = uuid.uuid4().hex
    token = _current_run.set(run)
    try:
        yield run
    finally:
        _current_run.reset(token)
        drop_scratch(spark, run)


def drop_scratch(spark: SparkSession, run: str | None = None) -> None:
    """Deletes the tables and files of one run (the current one by default)."""
    run = run or run_id(spark)
    spark.sql(f"DROP DATABASE IF EXISTS {_run_database(run)} CASCADE")
    delete_path(spark, run_folder(spark, run))


def _located(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    store, target = _located(spark, path)
    return store.exists(target)


def make_folder(spark: SparkSession, path: str) -> None:
    store, target = _located(spark, path)
    store.mkdirs(target)


def delete_path(spark: SparkSession, path: str) -> None:
    store, target = _located(spark, path)
    store.delete(target, True)


def is_cut(df: DataFrame) -> bool:
    """Whether ``df`` is a lineage cut as returned (not something computed from one)."""
    return getattr(df, "_scratch", None) is not None


def discard(*cuts: DataFrame | None) -> None:
    """Deletes superseded cuts: call it once what was computed from them has
    itself been cut.  Frames that are no cuts are left alone."""
    for cut in cuts:
        where = getattr(cut, "_scratch", None)
        if where is None:
            continue
        table, path = where
        if table:
            cut.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
        delete_path(cut.sparkSession, path)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """What is planned and run inside has this setting."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shuffles_deleted(spark: SparkSession):
    """Shuffle files of what is run inside are deleted as soon as it has ended, not
    when the driver next collects garbage: meant for writes, which need them no more."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def layout_of_some_keys(spark: SparkSession):
    """Joins planned inside take both sides as they lie if they are laid out
    alike by some of the join's keys (Spark's default asks for all keys)."""
    return setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialises ``df`` as files of the run in the shared checkpoint folder
    and reads them back: computed once, and no later stage depends on the
    executors that computed it.  The planner knows the size of what it reads."""
    spark = df.sparkSession
    path = f"{run_folder(spark)}/cut-{uuid.uuid4().hex}"
    with shuffles_deleted(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = (None, path)
    return out


def cut_lineage_keyed(df: DataFrame, keys: list[str], partitions: int, prepartitioned: bool = False) -> DataFrame:
    """Lineage cut that keeps a hash layout on ``keys``.

    A plain cut forgets how its rows were partitioned, so a later join
    or window on the key would shuffle again.  A table bucketed on ``keys``
    (written under the shared checkpoint folder) is read back hash-partitioned
    on them, so co-partitioned joins and windows on the key need no exchange.
    Bucket ids use the same hash as shuffles: ``partitions`` must equal the
    partitions of the joins that consume the table (``layout_partitions``).
    ``prepartitioned``: ``df`` is already hash-partitioned on ``keys`` into
    ``partitions`` (skips one shuffle).
    """
    if partitions > MAX_BUCKETS:
        raise ValueError(f"{partitions} partitions; a bucketed table has {MAX_BUCKETS} at most")
    spark = df.sparkSession
    folder, database, name = run_folder(spark), _run_database(run_id(spark)), f"t_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{folder}/tables'")
    laid_out = df if prepartitioned else df.repartition(partitions, *keys)
    path = f"{folder}/tables/{name}"
    with shuffles_deleted(spark):
        laid_out.write.bucketBy(partitions, *keys).option("path", path).format("parquet").saveAsTable(f"{database}.{name}")
    out = spark.table(f"{database}.{name}")
    out._scratch = (f"{database}.{name}", path)
    return out


def cut_appended(cut: DataFrame, more: DataFrame, keys: list[str], partitions: int) -> DataFrame:
    """``cut``, made by ``cut_lineage_keyed`` with these keys and partitions, with
    the rows of ``more`` (same columns) added to its files."""
    table, path = cut._scratch
    laid_out = more.select(*cut.columns).repartition(partitions, *keys)
    with shuffles_deleted(cut.sparkSession):
        laid_out.write.mode("append").bucketBy(partitions, *keys).format("parquet").saveAsTable(table)
    out = cut.sparkSession.table(table)
    out._scratch = (table, path)
    return out
