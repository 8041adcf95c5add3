"""Few-file operations on any file system Spark can reach.

For names of folders and files of one write or one lake hour; listings of whole lakes belong to Spark.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import SparkSession


class Folder:
    """A folder on a Hadoop file system."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self._class = spark._jvm.org.apache.hadoop.fs.Path
        self._system = self._class(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str = ""):
        return self._class(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str = "") -> bool:
        return self._system.exists(self._at(name))

    def names(self, name: str = "") -> list[str]:
        """Sorted names in a sub-folder, without those that begin with a dot; none where it doesn't exist."""
        if not self.exists(name):
            return []
        found = (status.getPath().getName() for status in self._system.listStatus(self._at(name)))
        return sorted(one for one in found if not one.startswith("."))

    def modified(self, name: str = "") -> int:
        """Milliseconds since 1970 of the last change."""
        return self._system.getFileStatus(self._at(name)).getModificationTime()

    def size(self) -> int:
        """Bytes below the folder, hidden files included; one call, nothing is listed here."""
        return self._system.getContentSummary(self._at()).getLength() if self.exists() else 0

    def files(self) -> list[tuple[str, int]]:
        """Paths below the folder, relative to it, with their bytes; hidden files are left out."""
        if not self.exists():
            return []
        found = self._system.listFiles(self._at(), True)
        root = self._system.resolvePath(self._at()).toUri().getPath()
        result = []
        while found.hasNext():
            status = found.next()
            relative = status.getPath().toUri().getPath()[len(root) :].lstrip("/")
            if not any(part[0] in "._" for part in relative.split("/")):
                result.append((relative, status.getLen()))
        return sorted(result)

    def listed(self) -> list[str]:
        """Paths of the files below the folder, relative to it, found by Spark; for folders with many."""
        if not self.exists():
            return []
        found = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(self.path)
        root = self._system.resolvePath(self._at()).toUri().getPath().rstrip("/") + "/"
        return sorted(row["path"].partition(root)[2] for row in found.select("path").collect())

    def make(self, name: str = "") -> None:
        self._system.mkdirs(self._at(name))

    def move(self, source: str, name: str) -> None:
        """Move a file given by its full path into the folder under a name."""
        if not self._system.rename(self._class(source), self._at(name)):
            raise OSError(f"can't move {source} to {self.path}/{name}")

    def delete(self, name: str = "") -> None:
        self._system.delete(self._at(name), True)

    def delete_path(self, path: str) -> None:
        """Delete a file given by its full path."""
        self._system.delete(self._class(path), True)

    def write_lines(self, name: str, lines: list[str]) -> None:
        """Write a file under another name first, so that none is seen half written."""
        folder, _, last = name.rpartition("/")
        draft = self._at(f"{folder}/.{last}-{uuid4().hex}".lstrip("/"))
        out = self._system.create(draft, True)
        out.write(bytearray("\n".join(lines).encode()))
        out.close()
        self._system.delete(self._at(name), False)
        if not self._system.rename(draft, self._at(name)):
            raise OSError(f"can't write {self.path}/{name}")

    def read_lines(self, name: str) -> list[str]:
        source = self._system.open(self._at(name))
        text = bytes(source.readAllBytes()).decode()
        source.close()
        return text.split("\n") if text else []
