"""Small files of control data on any storage that Spark can reach, from the driver."""

from __future__ import annotations

import os
import uuid
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    """Names, marks and whole small texts below any path; none of it touches a table's rows."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _system(self, path: str):
        return self._path(path).getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        return self._system(path).exists(self._path(path))

    def names(self, path: str) -> list[str]:
        """Names within a folder, ascending; none if there is no folder."""
        if not self.exists(path):
            return []
        found = self._system(path).listStatus(self._path(path))
        return sorted(entry.getPath().getName() for entry in found)

    def mark(self, path: str) -> None:
        """Make an empty file, whether or not there is one."""
        self._system(path).create(self._path(path), True).close()

    def remove(self, path: str) -> None:
        self._system(path).delete(self._path(path), True)

    def read(self, path: str) -> str:
        stream = self._system(path).open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Write a whole new file; false, and nothing written, if the name is taken.

        The text lies under another name first and is then linked or renamed to its own, which
        storage does at once and for one of several writers.
        """
        draft = f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
        target = self._system(path).makeQualified(self._path(path)).toString()
        out = self._system(draft).create(self._path(draft), True)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            if urlparse(target).scheme == "file":
                local = unquote(urlparse(target).path)
                try:
                    os.link(os.path.join(os.path.dirname(local), os.path.basename(draft)), local)
                except FileExistsError:
                    return False
                return True
            options = self._jvm.org.apache.hadoop.fs.Options.Rename
            context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                self._path(path).toUri(), self._conf
            )
            none = self._gateway.new_array(options, 1)
            none[0] = options.NONE
            context.rename(self._path(draft), self._path(path), none)
            return True
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        finally:
            if self.exists(draft):
                self.remove(draft)

    def partition(self, column: str, value: str | None) -> str:
        """The folder name Spark gives to a partition."""
        utils = self._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        if value is None or value == "":
            return f"{column}={utils.DEFAULT_PARTITION_NAME()}"
        return f"{column}={utils.escapePathName(value)}"
