"""Directory operations on whatever file system holds the data (local, HDFS, object store)."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    name: str
    path: str
    is_dir: bool


def literal_path(path: str) -> str:
    """Escape glob characters, for readers that expand every path they get."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


class Storage:
    """The few Hadoop ``FileSystem`` calls that publishing a dataset needs."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _open(self, path: str):
        target = self._jvm.org.apache.hadoop.fs.Path(str(path))
        return target.getFileSystem(self._conf), target

    def qualify(self, path: str) -> str:
        fs, target = self._open(path)
        return fs.makeQualified(target).toString()

    def exists(self, path: str) -> bool:
        fs, target = self._open(path)
        return fs.exists(target)

    def is_dir(self, path: str) -> bool:
        fs, target = self._open(path)
        return fs.exists(target) and fs.getFileStatus(target).isDirectory()

    def is_file(self, path: str) -> bool:
        fs, target = self._open(path)
        return fs.exists(target) and not fs.getFileStatus(target).isDirectory()

    def children(self, directory: str, pattern: str = "*") -> list[Entry]:
        """Direct children matching a glob, by name."""
        if "/" in pattern:
            raise ValueError(f"pattern {pattern!r} must not reach into subdirectories")
        fs, target = self._open(f"{literal_path(self.qualify(directory))}/{pattern}")
        found = fs.globStatus(target) or []
        entries = [
            Entry(s.getPath().getName(), s.getPath().toString(), s.isDirectory()) for s in found
        ]
        return sorted(entries, key=lambda e: e.name)

    def make_dirs(self, path: str) -> None:
        fs, target = self._open(path)
        fs.mkdirs(target)

    def write_text(self, path: str, text: str) -> None:
        """A new small file; an existing one is an error."""
        fs, target = self._open(path)
        stream = fs.create(target, False)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()

    def read_text(self, path: str) -> str:
        fs, target = self._open(path)
        stream = fs.open(target)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def rename(self, source: str, target: str) -> None:
        fs, src = self._open(source)
        if not fs.rename(src, self._jvm.org.apache.hadoop.fs.Path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def copy(self, source: str, target: str) -> None:
        fs, src = self._open(source)
        dst = self._jvm.org.apache.hadoop.fs.Path(target)
        copied = self._jvm.org.apache.hadoop.fs.FileUtil.copy(
            fs, src, fs, dst, False, self._conf
        )
        if not copied:
            raise OSError(f"cannot copy {source} to {target}")

    def delete(self, path: str) -> None:
        fs, target = self._open(path)
        fs.delete(target, True)
