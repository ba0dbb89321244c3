"""What the operators share: the word pattern, checkpoints and table reads."""

from __future__ import annotations

import atexit
import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of anything but these six characters.
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, each led by as many underscores as it takes to differ from the
    columns of ``df`` in any case: for working columns beside the caller's own."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def give_back() -> None:
    """Memory that this Python process has freed but holds on to goes back to
    the system: Arrow's pool and, where the C library can, its heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def giving_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over the batches of a task, followed by ``give_back``.  Spark keeps
    a task's worker for later ones, so what it held would lie beside the JVM of
    an executor in every later stage, those without Python included."""

    @functools.wraps(run)
    def over(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return over


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the folder in ``spark.checkpoint.dir``, lineage cut.

    The folder is the cluster's; only a local session that names none (tests)
    gets a scratch folder.  Spark's cleaner removes the files when the frame
    is no longer referenced and the cluster enables that.
    """
    folder = _shared_folder(df.sparkSession)
    if df.sparkSession.sparkContext.getCheckpointDir() is None:
        df.sparkSession.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def _shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a scratch folder only for a local session that names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the cluster shares")
        folder = tempfile.mkdtemp(prefix="mktlens-llm-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def _remove(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None:  # the session is still up
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: a
    compressed checkpoint, for frames that several jobs read.  Removed when
    the driver program ends."""
    spark = df.sparkSession
    path = f"{_shared_folder(spark)}/mktlens-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)
