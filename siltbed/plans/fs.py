"""Small file-system calls through Hadoop's FileSystem (works for file:, hdfs:, s3a:)."""

from __future__ import annotations

import gc
import threading
from contextlib import contextmanager

from pyspark.sql import SparkSession

FEW_TASKS = 200  # tasks that list, or go through, many small files
_settings = threading.RLock()  # threads of one session share its settings


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct sub-folders of ``path`` (empty when it does not exist)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


def list_files(spark: SparkSession, path: str, suffix: str = ".parquet") -> list[tuple[str, int]]:
    """(path, length) of every file below ``path`` whose name ends with ``suffix``, skipping
    hidden/underscore names; bounded by what one batch or version wrote."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    out = []
    it = fs.listFiles(p, True)
    while it.hasNext():
        st = it.next()
        name = st.getPath().getName()
        if name.endswith(suffix) and not name.startswith(("_", ".")):
            out.append((st.getPath().toString(), int(st.getLen())))
    return out


def glob_names(spark: SparkSession, pattern: str) -> set[str]:
    """Names matching a Hadoop glob (``{a,b}`` alternatives allowed), in one listing call."""
    fs, p = _fs(spark, pattern)
    st = fs.globStatus(p)
    return {s.getPath().getName() for s in st} if st is not None else set()


def names_in(spark: SparkSession, folder: str) -> set[str]:
    """Names directly below ``folder`` (none when it does not exist), in one listing that comes over as one text."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return set()
    jvm = spark.sparkContext._jvm
    paths = jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(fs.listStatus(p))
    text = jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(paths).mkString("\0")  # no file name holds this character
    return {path.rpartition("/")[2] for path in text.split("\0")} if text else set()


@contextmanager
def many_folders(spark: SparkSession):
    """Reads that are made inside list their folders in few tasks (Spark's own number, up to 10,000 a read, stays in the driver's memory as
    task records), and no second copy of a listing is kept for the session. The JVM holds a frame's listing as long as Python holds the frame,
    so frames that are out of use but in reference cycles go first."""
    gc.collect()
    own = {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(FEW_TASKS), "spark.sql.hive.filesourcePartitionFileCacheSize": "0"}
    with _settings:
        before = {k: spark.conf.get(k) for k in own}
        for k, v in own.items():
            spark.conf.set(k, v)
        try:
            yield
        finally:
            for k, v in before.items():
                spark.conf.set(k, v)


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file that must not exist yet; False if it does (another writer was first).

    The text ends in a line feed, so that a reader can tell a complete file (:func:`read_text`).
    """
    fs, p = _fs(spark, path)
    try:
        out = fs.create(p, False)
    except Exception as e:  # noqa: BLE001
        if fs.exists(p):
            return False
        raise e
    out.write(bytearray(text.rstrip("\n").encode() + b"\n"))
    out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str | None:
    """Text of a small file; None if it is missing or was not completed."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return text[:-1] if text.endswith("\n") else None


def newest(spark: SparkSession, folder: str, prefix: str) -> tuple[int, str | None]:
    """Number and text of the newest complete file ``<prefix><number>`` in a folder; (0, None) without one."""
    numbers = [int(n[len(prefix):]) for n in glob_names(spark, f"{folder}/{prefix}*") if n[len(prefix):].isdigit()]
    for n in sorted(numbers, reverse=True):
        text = read_text(spark, f"{folder}/{prefix}{n:012d}")
        if text is not None:
            return n, text
    return 0, None


def publish(spark: SparkSession, folder: str, prefix: str, after: int, text: str) -> int:
    """Create the next numbered file; numbers of writers that died half-way are passed over, a complete one is a conflict."""
    n = after + 1
    while not create_text(spark, f"{folder}/{prefix}{n:012d}", text):
        if read_text(spark, f"{folder}/{prefix}{n:012d}") is not None:
            raise RuntimeError(f"{folder}/{prefix}{n:012d} was published by another writer")
        n += 1
    return n


def modified_before(spark: SparkSession, path: str, millis: int) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).getModificationTime() < millis


def rename(spark: SparkSession, path: str, target: str) -> None:
    fs, p = _fs(spark, path)
    to = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    if not fs.rename(p, to):
        raise OSError(f"could not move {path} to {target}")


def move(spark: SparkSession, path: str, target: str) -> None:
    """Move a file to a place whose folder may not be there yet."""
    fs, p = _fs(spark, target)
    fs.mkdirs(p.getParent())
    rename(spark, path, target)
