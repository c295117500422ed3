"""A source of book pages: files read by an extractor that the caller names, one task a file.

    spark.dataSource.register(Pages)
    spark.read.format("quire_pages").option("extractor", "module:function").load(folder)

The function takes a file's path and gives (page_pdf, text) pairs; page_pdf
counts from 1. Formats that need a library of their own plug in here.
"""

from __future__ import annotations

import importlib
from collections.abc import Iterator
from pathlib import PurePosixPath

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class File(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


class Pages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "quire_pages"

    def schema(self) -> str:
        return "book_id string, page_pdf int, text string, error string"

    def reader(self, schema) -> DataSourceReader:
        return PageReader(self.options)


class PageReader(DataSourceReader):
    """A file that the extractor cannot read gives one row: its error, and no page."""

    def __init__(self, options: dict) -> None:
        self.folder, self.extractor = options["path"], options.get("extractor", "quire.sources.pages:form_feeds")
        self.suffixes = tuple(x.strip().lower() for x in options.get("suffixes", "pdf,txt").split(","))

    def partitions(self) -> list[File]:
        from pyarrow import fs

        where, root = fs.FileSystem.from_uri(self.folder if ":" in self.folder else f"file://{self.folder}")
        found = where.get_file_info(fs.FileSelector(root, recursive=False))
        return [File(x.path) for x in sorted(found, key=lambda x: x.path) if x.is_file and x.extension.lower() in self.suffixes]

    def read(self, partition: File) -> Iterator[tuple]:
        module, function = self.extractor.split(":")
        book = PurePosixPath(partition.path).stem
        try:
            for page, text in getattr(importlib.import_module(module), function)(partition.path):
                yield book, page, text, None
        except Exception as e:  # one unreadable file must not end a collection of millions
            yield book, None, None, f"{type(e).__name__}: {e}"


def form_feeds(path: str) -> Iterator[tuple[int, str]]:
    """Plain text whose pages end with form feeds."""
    with open(path, encoding="utf-8", errors="replace") as f:
        for n, text in enumerate(f.read().split("\f"), 1):
            yield n, text
