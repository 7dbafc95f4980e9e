"""Small files in any store that Spark reads: whether they exist, their text, and publishing one exclusively."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Refused(RuntimeError):
    """Another writer published the same name first."""


class Store:
    """The file system of a path, through the session's Hadoop client."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.gateway = spark.sparkContext._gateway
        self.fs = self.path(path).getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def names(self, folder: str) -> list[str]:
        """Names in a folder, none if there is no such folder."""
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(folder))) if self.exists(folder) else []

    def files(self, folder: str, ending: str = ".parquet") -> list[str]:
        """Files below a folder, relative to it."""
        found, top = [], self.fs.makeQualified(self.path(folder)).toString().rstrip("/") + "/"
        if self.exists(folder):
            each = self.fs.listFiles(self.path(folder), True)
            while each.hasNext():
                name = each.next().getPath().toString()
                if name.endswith(ending):
                    found.append(name.removeprefix(top))
        return sorted(found)

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """Make a file with its whole text at once; ``Refused`` if there is one of that name.

        The text is written beside it and then renamed without overwriting, which
        is atomic where the store's rename is.
        """
        folder, _, own = name.rpartition("/")
        draft = self.path(f"{folder}/.{own}-{uuid.uuid4().hex}")
        stream = self.fs.create(draft, False)
        stream.write(text.encode())
        stream.close()
        options = self.gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        try:
            context.rename(self.fs.makeQualified(draft), self.fs.makeQualified(self.path(name)), options)
        except Py4JJavaError as e:
            self.fs.delete(draft, False)
            if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
                raise Refused(f"{name} exists") from None
            raise

    def move(self, name: str, to: str) -> None:
        """Rename, unless that has been done before."""
        if self.exists(name):
            self.fs.mkdirs(self.path(to).getParent())
            if not self.fs.rename(self.path(name), self.path(to)) and not self.exists(to):
                raise OSError(f"can't move {name} to {to}")

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)
