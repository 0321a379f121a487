"""Helpers that the training-data operators share: shared scratch tables, ordered slices, broadcasts behind a size check."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: Rows of a narrow id table (about 24 bytes each) that may be broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 1_000_000


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z and nothing else; a null text counts as empty."""
    return F.translate(F.coalesce(c.cast("string"), F.lit("")), UPPER, LOWER)


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local one is made only where none is named and the master is local, as in tests."""
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        jvm_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        if jvm_dir.isDefined():
            return jvm_dir.get()
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="tabfidelity-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return root


_TRACKED: list[list[Scratch]] = []


@contextlib.contextmanager
def tracked() -> Iterator[list[Scratch]]:
    """Collects the scratch folders that are made inside, so that a caller who has written the result can remove them."""
    made: list[Scratch] = []
    _TRACKED.append(made)
    try:
        yield made
    finally:
        _TRACKED.remove(made)


class Scratch:
    """Tables and files of one operator run, in the shared folder, removed when the application ends.

    A table written here cuts the lineage: tasks of a lost executor reread it instead of recomputing what came before.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
        path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        self._fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        whole = self._fs.makeQualified(path).toString()  # with its scheme, so that other readers find the same store
        self.root = f"file://{whole[5:]}" if whole.startswith("file:/") and not whole.startswith("file://") else whole
        self._fs.mkdirs(path)
        self._fs.deleteOnExit(path)
        for made in _TRACKED:
            made.append(self)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        """Write df as Parquet and return the table read back. Rows may hold long texts, so batches to Python are short."""
        conf, batch = self.spark.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
        before = conf.get(batch)
        try:
            conf.set(batch, str(min(int(before), 1000) if int(before) > 0 else 1000))
            df.write.options(**options).parquet(self.path(name))
        finally:
            conf.set(batch, before)
        return self.read(name, df)

    def read(self, name: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(self.path(name))

    def files(self, name: str) -> list[str]:
        """Names of the files of a table."""
        return [f.getPath().getName() for f in self._fs.listStatus(self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name)))]

    def remove(self) -> None:
        """Delete everything, once nothing lazy depends on it."""
        self._fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(self.root), True)

    def drop(self, *names: str) -> None:
        """Delete tables that nothing lazy depends on any more."""
        for name in names:
            self._fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name)), True)


_CLAIMED: dict[str, Callable[[], None]] = {}


def claim(owner: str, drop: Callable[[], None] | None = None) -> None:
    """A Python worker serves tasks of many operators and keeps the caches of one: those of others are dropped and their memory given back.

    drop empties what the owner keeps between tasks.
    """
    import ctypes

    import pyarrow as pa

    others = [k for k in _CLAIMED if k != owner]
    for k in others:
        _CLAIMED.pop(k)()
    if drop:
        _CLAIMED[owner] = drop
    pa.default_memory_pool().release_unused()
    pa.set_memory_pool(pa.system_memory_pool())  # what is freed there goes back with the trim below
    pa.set_cpu_count(1)  # a task has one core
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def maybe_broadcast(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a narrow table whose counted rows are under the limit; leave the choice to the planner beyond it."""
    return F.broadcast(df) if rows <= limit else df


def free_name(df_columns: Sequence[str], want: str) -> str:
    """A column name that no column of the input has in any case."""
    taken = {c.lower() for c in df_columns}
    while want.lower() in taken:
        want += "_"
    return want
