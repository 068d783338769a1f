"""Small files on any file system that Spark can reach, through Hadoop's API."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_scratch: str | None = None


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the one of the session's ``spark.checkpoint.dir``.  A temporary
    folder serves only where all of Spark runs in one process; on a cluster an unset folder is an error."""
    global _scratch
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not found and (set_ := sc._jsc.sc().getCheckpointDir()).isDefined():
        found = set_.get()
    if not found:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = _scratch = _scratch or tempfile.mkdtemp(prefix="tidemark-")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(found)
    return found


class Files:
    """JSON-sized files: listing, reading, and writing that fails where the name is taken.

    A new file is written under a temporary name and put in place in one step: by a hard link on local disks, by a
    rename elsewhere, which file systems such as HDFS refuse where the target exists.  Stores whose rename overwrites
    need ``put_if_absent(path, text) -> bool``, their own conditional write.
    """

    def __init__(self, spark: SparkSession, put_if_absent: Callable[[str, str], bool] | None = None):
        self._jvm, self._conf, self._put = spark._jvm, spark._jsc.hadoopConfiguration(), put_if_absent

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def names(self, path: str) -> list[str]:
        fs, p = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def make(self, path: str) -> None:
        fs, p = self._at(path)
        fs.mkdirs(p)

    def read(self, path: str) -> str:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, path: str, text: str) -> bool:
        """Write a whole file at once; False where ``path`` exists."""
        if self._put is not None:
            return self._put(path, text)
        fs, p = self._at(path)
        if fs.exists(p):
            return False
        tmp = self._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}")
        stream = fs.create(tmp, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        try:
            return self._place(fs, tmp, p)
        finally:
            fs.delete(tmp, False)

    def _place(self, fs, tmp, p) -> bool:
        if fs.getUri().getScheme() != "file":
            return not fs.exists(p) and fs.rename(tmp, p)
        plain = [self._jvm.java.io.File(fs.makeQualified(x).toUri().getPath()).toPath() for x in (p, tmp)]
        try:
            self._jvm.java.nio.file.Files.createLink(*plain)
            return True
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" in str(e.java_exception):
                return False
            raise

    def delete(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.delete(p, True)
