"""Small files beside the data, on whatever file system holds it."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """A few operations of Hadoop's file systems, from the driver."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        where = self._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self._conf), where

    def exists(self, path: str) -> bool:
        fs, where = self._at(path)
        return fs.exists(where)

    def names(self, folder: str) -> dict[str, float]:
        """Names in a folder and the seconds at which they were last written;
        nothing for a folder that is not there."""
        fs, where = self._at(folder)
        if not fs.exists(where):
            return {}
        return {s.getPath().getName(): s.getModificationTime() / 1000 for s in fs.listStatus(where)}

    def folders(self, folder: str) -> list[str]:
        fs, where = self._at(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory())

    def read(self, path: str) -> str:
        fs, where = self._at(path)
        stream = fs.open(where)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> None:
        """Write a new file; ``FileExistsError`` if the name is taken."""
        fs, where = self._at(path)
        try:
            out = fs.create(where, False)
        except Exception as e:
            if "AlreadyExists" in str(e):
                raise FileExistsError(path) from e
            raise
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def put(self, path: str, text: str) -> None:
        """Write a new file that is whole or not there: beside, then renamed."""
        folder, name = path.rsplit("/", 1)
        beside = f"{folder}/.{name}.tmp"
        self.delete(beside)  # of a writer that died here
        self.create(beside, text)
        fs, where = self._at(path)
        if fs.exists(where) or not fs.rename(self._at(beside)[1], where):
            raise FileExistsError(path)

    def delete(self, path: str) -> None:
        fs, where = self._at(path)
        fs.delete(where, True)
