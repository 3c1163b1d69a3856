"""Small files of any store that Spark reaches: existence, text, listing, moves that do not overwrite."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark import SparkContext
from pyspark.sql import SparkSession


class Store:
    """The file system of a path, as Hadoop knows it."""

    def __init__(self, spark: SparkSession, path: str):
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.conf = spark._jsparkSession.sessionState().newHadoopConf()
        self.fs = self.at(path).getFileSystem(self.conf)

    def at(self, path: str):
        return self.hadoop.Path(path)

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.at(path))

    def names(self, path: str) -> list[str]:
        """Of what lies in a folder; none where there is no folder."""
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.at(path))) if self.exists(path) else []

    def files(self, path: str) -> list[str]:
        """Names of the files in a folder, without those that Spark's readers skip."""
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.at(path)) if s.isFile() and s.getPath().getName()[0] not in "._")

    def read(self, path: str) -> str:
        stream = self.fs.open(self.at(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """A new file or none: it's written beside its place and moved there, where no file must be yet (FileExistsError)."""
        beside = f"{path}.{uuid.uuid4().hex}.tmp"
        out = self.fs.create(self.at(beside), False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        try:
            self.move(beside, path)
        except FileExistsError:
            self.delete(beside)
            raise

    def move(self, source: str, target: str) -> None:
        """Fails where target exists (FileExistsError): a plain rename may put the source inside a folder there, or replace a file."""
        context = self.hadoop.FileContext.getFileContext(self.fs.getUri(), self.conf)
        options = SparkContext._active_spark_context._gateway.new_array(self.hadoop.Options.Rename, 1)
        options[0] = getattr(self.hadoop.Options.Rename, "NONE")
        try:
            context.rename(self.at(source), self.at(target), options)
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" in str(e.java_exception):
                raise FileExistsError(target) from e
            raise

    def make(self, path: str) -> None:
        self.fs.mkdirs(self.at(path))

    def delete(self, path: str) -> bool:
        return self.fs.delete(self.at(path), True)
