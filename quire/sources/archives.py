"""A source of the entries of archives, split by entry.

    spark.dataSource.register(Archives)
    spark.read.format("quire_archives").option("names", ".xhtml,.opf").load(folder)

The directory at an archive's end says where each entry lies. Entries are dealt
to tasks in runs of at most entry_bytes packed bytes, so an archive of any size
is read by many tasks, each of which reads its own entries only. An archive
whose directory cannot be read gives one row with an error and no entry; an
entry that cannot be unpacked gives a row with its name and an error. With
content=false nothing but directories is read. With filters=true, which needs
spark.sql.python.filterPushdown.enabled, filters on book_id and name leave out
archives and entries before any task starts.
"""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, StringEndsWith

ENTRY_BYTES, SMALL, AT_ONCE = 64 << 20, 1 << 16, 16
BROKEN = (zipfile.BadZipFile, NotImplementedError, RuntimeError, EOFError, OSError, zlib.error, ValueError)


@contextmanager
def opened(where, path: str) -> Iterator[zipfile.ZipFile]:
    """An archive of which only what is asked for is read; a small one at once, as zipfile looks for its end before its beginning."""
    with where.open_input_file(path) as f:
        small = f.size() <= SMALL
        with zipfile.ZipFile(io.BytesIO(f.read()) if small else f) as z:
            yield z


class Run(InputPartition):
    """Entries of one archive: (their places in the directory, names, sizes), or what is wrong with it."""

    def __init__(self, path: str, book: str, entries: list[tuple[int, str, int]], error: str | None) -> None:
        self.path, self.book, self.entries, self.error = path, book, entries, error


class Archives(DataSource):
    @classmethod
    def name(cls) -> str:
        return "quire_archives"

    def schema(self) -> str:
        return f"book_id string, ord int, name string, bytes long, {'content binary, ' if wants_content(self.options) else ''}error string"

    def reader(self, schema) -> DataSourceReader:
        return (FilteringReader if str(self.options.get("filters", "false")).lower() == "true" else ArchiveReader)(self.options)


def wants_content(options: dict) -> bool:
    return str(options.get("content", "true")).lower() != "false"


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        listed = lambda key, default: tuple(x.strip().lower() for x in options.get(key, default).split(",") if x.strip())
        self.folder, self.suffixes, self.names = options["path"], listed("suffixes", "epub,zip"), listed("names", "")
        self.entry_bytes, self.content, self.filters = int(options.get("entry_bytes", ENTRY_BYTES)), wants_content(options), []

    def passes(self, column: str, value: str) -> bool:
        mine = [f for f in self.filters if f.attribute == (column,)]
        return all(value.endswith(f.value) if isinstance(f, StringEndsWith) else value == f.value if isinstance(f, EqualTo) else value in f.value for f in mine)

    def place(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.folder if ":" in self.folder else f"file://{self.folder}")

    def partitions(self) -> list[Run]:
        from pyarrow import fs

        where, root = self.place()
        found = where.get_file_info(fs.FileSelector(root, recursive=False))
        files = [x.path for x in sorted(found, key=lambda x: x.path) if x.is_file and x.extension.lower() in self.suffixes and self.passes("book_id", PurePosixPath(x.path).stem)]
        with ThreadPoolExecutor(AT_ONCE) as pool:  # directories are a few bytes an entry
            return [run for runs in pool.map(lambda path: self.runs(where, path), files) for run in runs] or [Run("", "", [], None)]

    def runs(self, where, path: str) -> list[Run]:
        book = PurePosixPath(path).stem
        try:
            with opened(where, path) as z:
                infos = [(i, x) for i, x in enumerate(z.infolist()) if not x.is_dir()]
        except BROKEN as e:
            return [Run(path, book, [], f"{type(e).__name__}: {e}")] if not any(f.attribute == ("name",) for f in self.filters) else []
        out, size = [], 0
        for i, x in infos:
            if (self.names and not x.filename.lower().endswith(self.names)) or not self.passes("name", x.filename):
                continue
            if not out or size + x.compress_size > self.entry_bytes:
                out.append(Run(path, book, [], None))
                size = 0
            out[-1].entries.append((i, x.filename, x.file_size))
            size += x.compress_size
        return out

    def read(self, run: Run) -> Iterator[tuple]:
        row = lambda i, name, size, content, error: (run.book, i, name, size, content, error) if self.content else (run.book, i, name, size, error)
        if run.error:
            yield row(None, None, None, None, run.error)
        if not self.content:
            for i, name, size in run.entries:
                yield row(i, name, size, None, None)
            return
        if not run.entries:
            return
        where, _ = self.place()
        with opened(where, run.path) as z:
            infos = z.infolist()
            for i, name, size in run.entries:
                try:
                    yield row(i, name, size, z.read(infos[i]), None)
                except BROKEN as e:
                    yield row(i, name, size, None, f"{type(e).__name__}: {e}")


class FilteringReader(ArchiveReader):
    """Takes filters before it lists entries; Spark allows this only where the session enables it."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, (EqualTo, In, StringEndsWith)) and f.attribute in (("book_id",), ("name",)):
                self.filters.append(f)
            else:
                yield f


def archive_entries(spark: SparkSession, folder: str, names: tuple[str, ...] = (), content: bool = True, entry_bytes: int = ENTRY_BYTES) -> DataFrame:
    """entries(book_id, ord, name, bytes, content, error) of the archives in folder; names are endings in lower case."""
    spark.dataSource.register(Archives)
    filters = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    return spark.read.format("quire_archives").option("filters", filters).option("names", ",".join(names)).option("content", str(content).lower()).option("entry_bytes", entry_bytes).load(folder)


def text_entries(spark: SparkSession, folder: str, names: tuple[str, ...] = (".xhtml", ".html", ".htm", ".opf", ".ncx", ".xml")) -> DataFrame:
    """entries(book_id, ord, name, text) of e-books, as epub_entries() gives them, without an archive in one cell; unreadable archives and entries have none."""
    found = archive_entries(spark, folder, names).where("error is null")
    text = F.make_valid_utf8(F.col("content").cast("string"))  # bytes that are not UTF-8 are marked
    return found.select("book_id", "ord", "name", text.alias("text"))
