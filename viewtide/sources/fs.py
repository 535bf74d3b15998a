"""Small wrapper over Hadoop's FileSystem: listing and renaming of table directories (metadata only)."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession, path: str):
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._io = jvm.org.apache.commons.io.IOUtils
        self.fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self.fs.exists(self._path(path))

    def is_file(self, path: str) -> bool:
        return self.exists(path) and self.fs.getFileStatus(self._path(path)).isFile()

    def delete(self, path: str) -> None:
        self.fs.delete(self._path(path), True)

    def mkdirs(self, path: str) -> None:
        self.fs.mkdirs(self._path(path))

    def rename(self, src: str, dst: str) -> None:
        target = self._path(dst)
        self.fs.mkdirs(target.getParent())
        if not self.fs.rename(self._path(src), target):
            raise OSError(f"rename failed: {src} -> {dst}")

    def children(self, path: str) -> list[tuple[str, bool, int]]:
        """(name, is directory, bytes) of the entries below ``path``."""
        if not self.exists(path):
            return []
        return [(s.getPath().getName(), s.isDirectory(), s.getLen()) for s in self.fs.listStatus(self._path(path))]

    def write_text(self, path: str, text: str) -> None:
        out = self.fs.create(self._path(path), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read_text(self, path: str) -> str:
        stream = self.fs.open(self._path(path))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def leaves(self, path: str) -> dict[str, list[int]]:
        """Partition directory (relative) -> sizes of its data files; hidden names are skipped."""
        found: dict[str, list[int]] = {}
        pending = [""]
        while pending:
            rel = pending.pop()
            sizes = []
            for name, is_dir, size in self.children(f"{path}/{rel}" if rel else path):
                if name.startswith(("_", ".")):
                    continue
                if is_dir:
                    pending.append(f"{rel}/{name}" if rel else name)
                else:
                    sizes.append(size)
            if sizes:
                found[rel] = sizes
        return found
