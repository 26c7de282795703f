"""Small files and renames on whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Store:
    """The file system of the session's Hadoop settings; paths may name any scheme it knows."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._fs = self._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway

    def _at(self, path: str):
        where = self._fs.Path(path)
        return where.getFileSystem(self._conf), where

    def exists(self, path: str) -> bool:
        fs, where = self._at(path)
        return fs.exists(where)

    def read(self, path: str) -> str | None:
        """The text of a file, or None where there is none."""
        fs, where = self._at(path)
        if not fs.exists(where):
            return None
        stream = fs.open(where)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """Put a file in place as a whole: readers see the old text or the new one."""
        beside = f"{path.rpartition('/')[0]}/.{path.rpartition('/')[2]}.new"
        fs, where = self._at(beside)
        out = fs.create(where, True)
        out.write(bytearray(text.encode()))
        out.close()
        options = self._gateway.new_array(self._fs.Options.Rename, 1)
        options[0] = self._fs.Options.Rename.OVERWRITE
        context = self._fs.FileContext.getFileContext(fs.getUri(), self._conf)
        context.rename(where, self._fs.Path(path), options)

    def files(self, folder: str) -> list[str]:
        """Relative paths of the data files below ``folder``; names that begin with _ or . are none."""
        fs, top = self._at(folder)
        if not fs.exists(top):
            return []
        start, found, listed = len(fs.makeQualified(top).toUri().getPath()) + 1, [], fs.listFiles(top, True)
        while listed.hasNext():
            relative = listed.next().getPath().toUri().getPath()[start:]
            if not any(part.startswith(("_", ".")) for part in relative.split("/")):
                found.append(relative)
        return sorted(found)

    def move(self, source: str, target: str) -> None:
        """Rename a file. Safe to repeat: a target that is there is whole, and its source is dropped."""
        fs, new = self._at(target)
        old = self._fs.Path(source)
        if fs.exists(new):
            fs.delete(old, False)
            return
        fs.mkdirs(new.getParent())
        if not (fs.exists(old) and fs.rename(old, new)):
            raise OSError(f"{source!r} could not be renamed to {target!r}")

    def drop(self, path: str) -> None:
        fs, where = self._at(path)
        fs.delete(where, True)
