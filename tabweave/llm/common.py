"""Table access, scratch space and text normalisation shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space as the contracts define it: space and U+0009 to U+000D.
SPACE = "\\x20\\x09-\\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where none is set, a temporary one does if all runs in one process (tests); a cluster has to name one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="tabweave-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path below the folder of this application in the shared folder."""
    return f"{_own_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/tabweave/{spark.sparkContext.applicationId}"


def stored(df: DataFrame, tag: str, codec: str | None = None) -> DataFrame:
    """df as a table written to the shared folder and read back: lineage ends there and survives lost executors."""
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path, compression=codec)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def bucketed(df: DataFrame, tag: str, key: str) -> DataFrame:
    """df, which is hash-partitioned by key, as a table in as many buckets: joins on the key read it in place. The table's files are in the shared folder."""
    spark, path, name = df.sparkSession, scratch(df.sparkSession, tag), f"tabweave_{tag}_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").option("path", path).bucketBy(n, key).sortBy(key).saveAsTable(name)
    out = spark.table(name)
    out.stored_at, out.table_name = path, name
    return out


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a path in whatever file system holds it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def swept(spark: SparkSession) -> None:
    """Has the driver collect its garbage, Python's first as it holds on to plans, upon which Spark deletes the shuffles that nothing refers to any more."""
    gc.collect()
    spark._jvm.System.gc()


def released(*tables: DataFrame | None) -> None:
    """Deletes tables of stored(): for those whose readers have been written themselves. Others stay (a result may be read again) until cleared()."""
    gone = [df for df in tables if df is not None and hasattr(df, "stored_at")]
    for df in gone:
        if hasattr(df, "table_name"):
            df.sparkSession.sql(f"DROP TABLE IF EXISTS {df.table_name}")
        removed(df.sparkSession, df.stored_at)
    if gone:
        swept(gone[0].sparkSession)


def cleared(spark: SparkSession) -> None:
    """Deletes all that this application has stored: to be called when its results have been written."""
    removed(spark, _own_dir(spark))


@contextlib.contextmanager
def releasing():
    """Collects tables of stored() that only serve what is written within the block, and deletes them at its end."""
    held: list[DataFrame] = []

    def keep(df: DataFrame, tag: str) -> DataFrame:
        held.append(stored(df, tag))
        return held[-1]

    try:
        yield keep
    finally:
        released(*held)


#: Rows of an id or two each that may be broadcast: 100 MB at most.
BROADCAST_ROWS = 2_000_000


def bounded(side: DataFrame, tag: str, rows: int = BROADCAST_ROWS, keep=None) -> DataFrame:
    """side, stored, to be joined with a large table: broadcast if it is known to be small, dealt out with the table if not."""
    side = (keep or stored)(side, tag)
    return F.broadcast(side) if side.count() <= rows else side.hint("merge")


@contextlib.contextmanager
def configured(spark: SparkSession, wanted: dict[str, int | str]):
    """Settings that hold for what is run within the block."""
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def small_batches(spark: SparkSession, rows: int = 1000, size: int | None = None):
    """Texts go to Python by batches of `rows` (and `size` bytes, if given) in what is run within the block: a tenth of the usual memory on both sides."""
    return configured(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": rows} | ({"spark.sql.execution.arrow.maxBytesPerBatch": size} if size else {}))


def shuffles_dropped(spark: SparkSession):
    """Spark deletes the shuffles of what is run within the block as soon as it has run. swept() may come too early for that: py4j tells the JVM up to a second later which plans Python has let go of."""
    return configured(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def trimmed(run):
    """A function over Arrow batches that gives freed memory back to the system at the end of a task: workers stay, idle, beside the JVM."""
    def wrapped(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # other C libraries do so by themselves, or not at all
            ctypes.CDLL("libc.so.6").malloc_trim(0)
    return wrapped


def freeing(of):
    """A function of two Arrow tables (a group of each side) that gives freed memory back after each group."""
    def run(one: pa.Table, other: pa.Table) -> pa.Table:
        (out,) = trimmed(lambda _: iter([of(one, other)]))(())
        return out
    return run


def sliced(batch, *columns: int, rows: int = 256):
    """Python values of these columns of an Arrow batch, row by row, of which few are held at a time."""
    for i in range(0, batch.num_rows, rows):
        yield from zip(*(batch.column(c).slice(i, rows).to_pylist() for c in columns), strict=True)


def fresh(columns: list[str], *names: str) -> list[str]:
    """These names, each lengthened until no column has it, in any case."""
    taken = {c.lower() for c in columns}
    return [next(n for k in range(len(taken) + 1) if (n := name + "_" * k).lower() not in taken) for name in names]


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else. lower() is the fast path where the text is ASCII throughout."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def split_words(text: Column, separators: str) -> Column:
    """Words between runs of the separator class; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{separators}]+"), "")


def n_words(text: Column) -> Column:
    """How many runs of non-space (ASCII white space) there are, without building them."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(f"[^{SPACE}]+")).cast("long")
