"""Files that appear together or not at all: ``df.write.format("together").option("path", folder)`` of rows (name, content).

Tasks write each file beside its place, in a folder of the write; the commit moves them into place, keeping what they replace until all
are there, and puts that back if one cannot be moved. An abort deletes the folder, and nothing has changed.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow.fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

SCHEMA = "name string, content string"


def store(path: str) -> tuple[pafs.FileSystem, str]:
    """Any store that Arrow's file systems reach: file:, hdfs:, s3:, gs:."""
    if path.startswith("/"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


@dataclass
class Written(WriterCommitMessage):
    names: list[str] = field(default_factory=list)


class TogetherWriter(DataSourceWriter):
    def __init__(self, folder: str):
        self.folder, self.beside = folder.rstrip("/"), f".together-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator) -> Written:
        fs, root = store(self.folder)
        done = Written()
        for row in iterator:
            if not row["name"] or "/" in row["name"] or row["name"].startswith("."):
                raise ValueError(f"no name of a file: {row['name']!r}")
            fs.create_dir(f"{root}/{self.beside}", recursive=True)
            with fs.open_output_stream(f"{root}/{self.beside}/{row['name']}", compression=None) as out:
                out.write((row["content"] or "").encode())
            done.names.append(row["name"])
        return done

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = store(self.folder)
        names = [n for m in messages if m for n in m.names]
        if len(set(names)) < len(names):
            self.abort(messages)
            raise ValueError("a file was written twice")
        there = {i.base_name for i in fs.get_file_info([f"{root}/{n}" for n in names]) if i.type != pafs.FileType.NotFound} if names else set()
        moved: list[str] = []
        try:
            for n in names:
                if n in there:
                    fs.move(f"{root}/{n}", f"{root}/{self.beside}/{n}.before")
                moved.append(n)
                fs.move(f"{root}/{self.beside}/{n}", f"{root}/{n}")
        except Exception:
            for n in moved:
                if fs.get_file_info(f"{root}/{n}").type != pafs.FileType.NotFound:
                    fs.delete_file(f"{root}/{n}")
                if n in there:
                    fs.move(f"{root}/{self.beside}/{n}.before", f"{root}/{n}")
            self.abort(messages)
            raise
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        fs, root = store(self.folder)
        if fs.get_file_info(f"{root}/{self.beside}").type != pafs.FileType.NotFound:
            fs.delete_dir(f"{root}/{self.beside}")


class TogetherSink(DataSource):
    """Register with ``spark.dataSource.register(TogetherSink)``."""

    @classmethod
    def name(cls) -> str:
        return "together"

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return TogetherWriter(self.options["path"])
