"""Small files of the driver on any file system that Spark reaches."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _at(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def names(self, folder: str = "") -> list[str]:
        fs, path = self._at(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def exists(self, name: str) -> bool:
        fs, path = self._at(name)
        return fs.exists(path)

    def size(self, name: str) -> int:
        """Bytes below a folder."""
        fs, path = self._at(name)
        return fs.getContentSummary(path).getLength()

    def read(self, name: str) -> str:
        fs, path = self._at(name)
        stream = fs.open(path)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """Puts a new file in place in one step; FileExistsError if there is one."""
        folder, _, last = name.rpartition("/")
        draft = f"{folder}/.{last}.draft" if folder else f".{last}.draft"
        fs, path = self._at(draft)
        stream = fs.create(path, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        _, final = self._at(name)
        if fs.exists(final) or not fs.rename(path, final):
            raise FileExistsError(f"{self.path}/{name}")

    def make(self, name: str) -> None:
        """A folder, if there is none."""
        fs, path = self._at(name)
        fs.mkdirs(path)

    def move(self, name: str, to: str) -> None:
        """Puts a file or folder at another name, which must be free."""
        (fs, path), (_, final) = self._at(name), self._at(to)
        if fs.exists(final) or not fs.rename(path, final):
            raise FileExistsError(f"{self.path}/{to}")

    def delete(self, name: str) -> None:
        fs, path = self._at(name)
        fs.delete(path, True)
