"""Session settings, table access and the written tables that cut lineage."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: str = "8", memory: str = "8g", **conf: str) -> SparkSession:
    """A session for tests and single-machine runs; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("siftwell")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the session; a temporary one only where none is named and all runs on this machine."""
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"name a folder that all executors share in {CHECKPOINT_KEY}")
        root = "file://" + tempfile.mkdtemp(prefix="siftwell-")
        spark.conf.set(CHECKPOINT_KEY, root)
    return root.rstrip("/")


class Workspace:
    """Written intermediate tables in the shared checkpoint folder.

    A saved table survives the loss of executors and cuts the lineage of iterative jobs. Tables
    that a later one replaces are dropped at once; the rest go at the end of a ``with`` block, or else when
    the driver's process ends.
    """

    def __init__(self, spark: SparkSession, label: str = "work"):
        self.spark = spark
        self.root = f"{checkpoint_root(spark)}/siftwell-{label}-{uuid.uuid4().hex}"
        self._count = 0
        atexit.register(self.clear)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        self.clear()
        atexit.unregister(self.clear)

    def save(self, df: DataFrame, *partition_by: str, **metrics: Column) -> DataFrame:
        """The table as written; ``metrics`` (name=aggregate) are taken in the same job, see ``metric``."""
        self._count += 1
        path = f"{self.root}/{self._count:04d}"
        seen = Observation() if metrics else None
        if seen is not None:
            df = df.observe(seen, *(c.alias(name) for name, c in metrics.items()))
        writer = df.write
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._siftwell_path = path
        out._siftwell_metrics = seen.get if seen is not None else {}
        return out

    @staticmethod
    def metric(table: DataFrame, name: str = "rows"):
        """A metric of a saved table; a task that ran twice may have counted twice."""
        return table._siftwell_metrics[name]

    def drop(self, *tables: DataFrame | None) -> None:
        for table in tables:
            path = getattr(table, "_siftwell_path", None)
            if path:
                self._delete(path)

    def clear(self) -> None:
        try:
            self._delete(self.root)
        except Exception:  # the session may be gone already
            pass

    def _delete(self, path: str) -> None:
        context = self.spark.sparkContext
        if context._jsc is None:
            return
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)
