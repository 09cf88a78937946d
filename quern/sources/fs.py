"""Small files and folders through Hadoop's FileSystem: local disks, HDFS and object stores alike."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession


class Folder:
    """File operations of the driver on any path Spark can read."""

    def __init__(self, spark: SparkSession) -> None:
        self._jvm, self._conf, self._gateway = spark._jvm, spark._jsc.hadoopConfiguration(), spark.sparkContext._gateway

    def _at(self, path: str):
        where = self._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        where, fs = self._at(path)
        return fs.exists(where)

    def read_text(self, path: str) -> str:
        where, fs = self._at(path)
        stream = fs.open(where)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str = "") -> bool:
        """Writes a file that must not be there; False if it is.

        Of several that try, one succeeds, where the file system creates in one step: HDFS does, local disks here do by
        the system's own call, object stores if they have conditional writes.
        """
        where, fs = self._at(path)
        if fs.getScheme() == "file":
            local = Path(where.toUri().getPath())
            local.parent.mkdir(parents=True, exist_ok=True)
            try:
                with open(local, "x", encoding="utf-8") as f:
                    f.write(text)
            except FileExistsError:
                return False
            return True
        try:
            stream = fs.create(where, False)
        except Exception:
            if fs.exists(where):
                return False
            raise
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        return True

    def write_text(self, path: str, text: str) -> None:
        """Replaces a file by way of another name, so readers see the old text or the new."""
        where, fs = self._at(path)
        tmp, _ = self._at(path + ".tmp")
        stream = fs.create(tmp, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        rename = getattr(self._jvm, "org.apache.hadoop.fs.Options$Rename")
        how = self._gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), self._conf).rename(tmp, where, how)

    def list(self, path: str) -> list[tuple[str, int, int]]:
        """Path, size and modification time of the files under a folder, at any depth, sorted."""
        where, fs = self._at(path)
        if not fs.exists(where):
            return []
        out, walk = [], fs.listFiles(where, True)
        while walk.hasNext():
            s = walk.next()
            out.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
        return sorted(out)

    def glob(self, pattern: str) -> list[str]:
        where, fs = self._at(pattern)
        return sorted(s.getPath().toString() for s in fs.globStatus(where) or [])

    def qualified(self, path: str) -> str:
        """The path with its scheme, as Spark's file metadata has it."""
        where, fs = self._at(path)
        return fs.makeQualified(where).toString()

    def copy(self, source: str, target: str) -> None:
        (a, fa), (b, fb) = self._at(source), self._at(target)
        self._jvm.org.apache.hadoop.fs.FileUtil.copy(fa, a, fb, b, False, True, self._conf)

    def delete(self, path: str) -> None:
        where, fs = self._at(path)
        fs.delete(where, True)
