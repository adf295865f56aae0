"""A data source that lists folders on the executors."""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Iterator
from datetime import datetime

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def names_of(glob: str) -> re.Pattern:
    """A pattern for a name such as *.wav or *.{jpg,png}."""
    braces = re.search(r"\{([^}]*)\}", glob)
    choices = [glob[: braces.start()] + c + glob[braces.end() :] for c in braces[1].split(",")] if braces else [glob]
    return re.compile("|".join(f"(?:{fnmatch.translate(c)})" for c in choices))


class Folder(InputPartition):
    """A folder to list, with all folders below it or, ``flat``, without."""

    def __init__(self, path: str, flat: bool):
        self.path, self.flat = path, flat


class FolderListing(DataSource):
    """Files below a path: name, path, size_bytes, modified. Options: glob, of names, and depth.

    The driver lists the folders down to ``depth`` (1), which become partitions; executors list what is below each of
    them, so no list of all files exists in one place. Any file system that Arrow knows will do.
    """

    @classmethod
    def name(cls) -> str:
        return "folder_listing"

    def schema(self) -> str:
        return "name string, path string, size_bytes long, modified timestamp"

    def reader(self, schema) -> DataSourceReader:
        return FolderReader(self.options)


class FolderReader(DataSourceReader):
    def __init__(self, options):
        self.root, self.glob, self.depth = options["path"], options.get("glob", "*"), int(options.get("depth", 1))

    def system(self):
        import pyarrow.fs

        root = re.sub(r"^file:/(?!/)", "file:///", self.root)
        system, inner = pyarrow.fs.FileSystem.from_uri(root)
        scheme = "file:" if isinstance(system, pyarrow.fs.LocalFileSystem) else root[: len(root) - len(inner)]
        return system, inner.rstrip("/"), scheme

    def partitions(self) -> list[Folder]:
        import pyarrow.fs

        system, root, _ = self.system()
        flat, level = [], [root]
        for _ in range(self.depth):
            flat += level
            level = [f.path for p in level for f in system.get_file_info(pyarrow.fs.FileSelector(p)) if f.type == pyarrow.fs.FileType.Directory]
        return [Folder(p, True) for p in flat] + [Folder(p, False) for p in level]

    def read(self, partition: Folder) -> Iterator[tuple[str, str, int, datetime]]:
        import pyarrow.fs

        system, _, scheme = self.system()
        wanted = names_of(self.glob)
        for f in system.get_file_info(pyarrow.fs.FileSelector(partition.path, recursive=not partition.flat)):
            if f.type == pyarrow.fs.FileType.File and wanted.match(f.base_name):
                yield f.base_name, scheme + f.path, f.size, f.mtime.replace(microsecond=f.mtime.microsecond // 1000 * 1000)
