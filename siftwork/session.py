"""Session settings, lineage cuts in the shared folder, and checks before a broadcast."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes up to which a side may be broadcast. Both are checked on the data, not assumed.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20

_made: set[tuple[str, str]] = set()


def local_session(cpus: int = 8, partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir where the cluster names one, else a temporary
    folder of this machine, which only happens in local mode."""
    found = spark.conf.get("spark.checkpoint.dir", "") or spark.conf.get("spark.siftwork.shared.dir", "")
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="siftwork-")
        spark.conf.set("spark.siftwork.shared.dir", found)
    return found.rstrip("/")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder as compressed Parquet and read it back: the lineage ends there, the
    table survives the loss of any executor, and later stages read only the columns they use."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    if not _made:
        atexit.register(_purge)
    _made.add((spark.sparkContext.applicationId, path))
    return spark.read.schema(df.schema).parquet(path)


def drop_cut(df: DataFrame) -> None:
    """Delete a table written by :func:`cut` that no later plan reads."""
    for file in df.inputFiles()[:1]:
        _delete(df.sparkSession, file.rpartition("/")[0])


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    _made.difference_update({x for x in _made if x[1] == path})


def _purge() -> None:
    spark = SparkSession.getActiveSession()
    if spark is None:
        return
    for app, path in list(_made):
        try:
            if app == spark.sparkContext.applicationId:
                _delete(spark, path)
        except Exception:  # noqa: BLE001 - the session may be gone already
            return


def fits_broadcast(df: DataFrame, bytes_per_row: int, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` may be broadcast: counts at most one row more than the bound."""
    most = min(rows, size // max(1, bytes_per_row))
    return df.limit(most + 1).count() <= most


def unsized(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that must not be broadcast. Spark sizes a side before it runs by the bytes of the files
    read, as they are compressed, and takes an exploded row for one row, so a side of many times the bound may pass for a
    small one and be gathered on the driver. A sort-merge join needs no size; adaptive execution still splits its hot keys."""
    return df.hint("merge")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


class Spool:
    """Rows made on the driver. Beyond one block they are appended to a table of the shared folder, so that the driver
    holds one block at most."""

    def __init__(self, spark: SparkSession, name: str, schema: str, rows: int = 100_000) -> None:
        self.spark, self.schema, self.rows = spark, schema, rows
        self.path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
        self.held: list[tuple] = []
        self.written = False

    def add(self, rows: list[tuple]) -> None:
        self.held += rows
        if len(self.held) > self.rows:
            self.flush()

    def flush(self) -> None:
        self.spark.createDataFrame(self.held, self.schema).coalesce(1).write.mode("append").option("compression", "zstd").parquet(self.path)
        self.held, self.written = [], True

    def table(self) -> DataFrame:
        if not self.written:
            return self.spark.createDataFrame(self.held, self.schema)
        if self.held:
            self.flush()
        if not _made:
            atexit.register(_purge)
        _made.add((self.spark.sparkContext.applicationId, self.path))
        return self.spark.read.schema(self.schema).parquet(self.path)


#: A key that holds more than one row in HOT_PART is hot; there are at most HOT_PART such keys, whatever the data.
HOT_PART, SALTS = 1000, 32


def join_hot(big: DataFrame, small: DataFrame, key: str, spread: str, counts: DataFrame, how: str = "inner") -> DataFrame:
    """``big`` joined with ``small`` on ``key``, the rows of a hot key spread over 32 salts by a hash of ``spread``.
    ``small`` has a row per key and is repeated for the hot ones only. ``counts``: (key, n), the rows of each key."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = F.broadcast(counts.where(F.col("n") * HOT_PART > max(total, SALTS * HOT_PART)).select(key, F.lit(SALTS).alias("_of")))  # at most HOT_PART rows
    left = big.join(hot, key, "left").withColumn("_salt", F.pmod(F.xxhash64(spread), F.coalesce("_of", F.lit(1))).cast("int")).drop("_of")
    right = small.join(hot, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_of", F.lit(1)) - 1))).drop("_of")
    return left.join(right, [key, "_salt"], how).drop("_salt")
