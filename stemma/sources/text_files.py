"""A sink for many small text files: rows (path, value), each a file under a root, written by the tasks that have the rows."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

SCHEMA = "path string, value string"


@dataclass
class Written(WriterCommitMessage):
    files: int
    temporary: str


class _Writer(DataSourceWriter):
    """Each task writes its files into a folder of its own beside the root and moves each to its place once it is whole.

    So a place never has half a file, a task that runs again writes the same files again, and the folders of tasks that
    were broken off lie together and go when the job ends, well or not.
    """

    def __init__(self, root: str):
        self.root, self.beside = root.rstrip("/"), f"{root.rstrip('/')}-unfinished-{uuid.uuid4().hex}"

    def write(self, rows: Iterator) -> Written:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(self.root)
        _, beside = fs.FileSystem.from_uri(self.beside)
        own, made, n = f"{beside}/{uuid.uuid4().hex}", set(), 0
        store.create_dir(own, recursive=True)
        for row in rows:
            if row.path is None or not row.path.strip("/") or ".." in row.path.split("/"):
                raise ValueError(f"no place for a file: {row.path!r}")
            target, waiting = f"{root}/{row.path.lstrip('/')}", f"{own}/{n}"
            with store.open_output_stream(waiting) as file:
                file.write((row.value or "").encode())
            folder = os.path.dirname(target)
            if folder not in made:
                store.create_dir(folder, recursive=True)
                made.add(folder)
            store.move(waiting, target)
            n += 1
        store.delete_dir(own)
        return Written(n, beside)

    def _clear(self) -> None:
        from pyarrow import fs

        store, beside = fs.FileSystem.from_uri(self.beside)
        if store.get_file_info(beside).type == fs.FileType.Directory:
            store.delete_dir(beside)

    def commit(self, messages: list[WriterCommitMessage]) -> None:
        self._clear()

    def abort(self, messages: list[WriterCommitMessage]) -> None:
        self._clear()


class TextFiles(DataSource):
    """``df.write.format("text_files").mode("append").save(root)`` for a root in a store that pyarrow opens by its address."""

    @classmethod
    def name(cls) -> str:
        return "text_files"

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("files are added to a root, which is not emptied: use mode append")
        return _Writer(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TextFiles)


def write(files: DataFrame, root: str) -> None:
    """Write rows (path, value) as files under ``root``; an earlier file of the same path is replaced, a null value is an empty file.

    Of rows with one path, which one's file stays is open. A path without a name, or one that leads out of the root, raises.
    """
    register(files.sparkSession)
    files.select("path", "value").write.format("text_files").mode("append").save(root)
