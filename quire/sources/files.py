"""Books as files: collections, e-book containers, Markdown and report sinks."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from ..operators.headings import nav_page_entries
from ..operators.navigation import attribute, ncx_entries, resolve

#: What counts as an image.
IMAGES = ("png", "jpg", "jpeg", "gif", "webp", "tif", "tiff", "bmp", "svg")
SUFFIXES = ("pdf", "epub")
XHTML = (".xhtml", ".html", ".htm")


def books(spark: SparkSession, folder: str, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """files(path, stem, suffix, length, content) of a folder without its subfolders; suffixes in any case. content is read only where it is selected."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    named = found.withColumns({"stem": F.regexp_replace(name, r"\.[^.]*$", ""), "suffix": F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1))})
    return named.where(F.col("suffix").isin(*suffixes)).select("path", "stem", "suffix", "length", "content")


def without_existing(files: DataFrame, done: DataFrame) -> DataFrame:
    """Files whose stem done(stem) lacks."""
    return files.join(done.select("stem"), "stem", "left_anti")


def unzip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Text entries of archives, one archive at a time; an unreadable archive has none, bytes that are not UTF-8 are marked."""
    for batch in batches:
        for book, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            try:
                with zipfile.ZipFile(io.BytesIO(content or b"")) as z:
                    rows = [(book, i, n, z.read(n).decode("utf-8", "replace")) for i, n in enumerate(z.namelist()) if n.lower().endswith((*XHTML, ".opf", ".ncx", ".xml"))]
            except (zipfile.BadZipFile, NotImplementedError, RuntimeError, EOFError):
                rows = []
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, (pa.string(), pa.int32(), pa.string(), pa.string()))], names=["book_id", "ord", "name", "text"])


def epub_entries(files: DataFrame) -> DataFrame:
    """entries(book_id, ord, name, text) of the e-books among files."""
    return files.where("suffix = 'epub'").select("stem", "content").mapInArrow(unzip, "book_id string, ord int, name string, text string")


def packages(entries: DataFrame) -> DataFrame:
    """(book_id, base, opf): each book's package document, the one its container names, else the first of the archive."""
    container = entries.where("name = 'META-INF/container.xml'")
    root = F.get(F.filter(F.transform(F.regexp_extract_all("text", F.lit("(?i)<rootfile\\b[^>]*>"), 0), lambda t: attribute(t, "full-path")), lambda p: p != ""), F.lit(0))
    named = container.select("book_id", resolve(F.lit(""), root)[0].alias("name")).where("name is not null")
    first = entries.where("lower(name) like '%.opf'").groupBy("book_id").agg(F.min_by("name", "ord").alias("first"))
    chosen = first.join(named, "book_id", "full").select("book_id", F.coalesce("name", "first").alias("name"))
    return entries.join(chosen, ["book_id", "name"]).select("book_id", F.regexp_extract("name", "^(.*)/[^/]*$", 1).alias("base"), F.col("text").alias("opf"))


def spine(entries: DataFrame) -> DataFrame:
    """docs(book_id, ord, name, markup): the pages of each book in reading order, without its navigation page."""
    opf = packages(entries)
    tag = F.col("tag")
    items = opf.select("book_id", "base", F.posexplode(F.regexp_extract_all("opf", F.lit(r"(?i)<item\b[^>]*>"), 0)).alias("at", "tag"))
    items = items.select("book_id", "at", attribute(tag, "id").alias("id"), resolve(F.col("base"), attribute(tag, "href"))[0].alias("name"), F.array_contains(F.split(F.coalesce(attribute(tag, "properties"), F.lit("")), r"\s+"), "nav").alias("is_nav"), F.lower(F.coalesce(attribute(tag, "media-type"), F.lit(""))).alias("media")).where("id is not null and name <> ''")
    items = items.groupBy("book_id", "id").agg(F.max_by(F.struct("name", "is_nav", "media"), "at").alias("i")).select("book_id", "id", "i.*")
    order = opf.select("book_id", F.posexplode(F.regexp_extract_all(F.regexp_extract("opf", r"(?is)<spine\b[^>]*>(.*?)</spine>", 1), F.lit(r"(?i)<itemref\b[^>]*>"), 0)).alias("ord", "tag")).select("book_id", "ord", attribute(tag, "idref").alias("id"))
    nav = items.where("is_nav").select("book_id", "name").distinct()
    is_page = F.col("media").contains("xhtml") | F.lower("name").rlike(r"\.(xhtml|html?)$")
    pages = order.join(items.where(is_page), ["book_id", "id"]).join(nav, ["book_id", "name"], "left_anti")
    return pages.join(entries.select("book_id", "name", F.col("text").alias("markup")), ["book_id", "name"]).select("book_id", "ord", "name", "markup")


def navigation(entries: DataFrame) -> DataFrame:
    """nav(book_id, ord, depth, label, doc, anchor) of each book: its navigation page, else its navigation map, else the first map of the archive."""
    opf = packages(entries)
    tag = F.col("tag")
    items = opf.select("book_id", "base", F.explode(F.regexp_extract_all("opf", F.lit(r"(?i)<item\b[^>]*>"), 0)).alias("tag"))
    kind = F.when(F.array_contains(F.split(F.coalesce(attribute(tag, "properties"), F.lit("")), r"\s+"), "nav"), "page").when(F.lower(F.coalesce(attribute(tag, "media-type"), F.lit(""))).contains("ncx"), "map")
    named = items.select("book_id", kind.alias("kind"), resolve(F.col("base"), attribute(tag, "href"))[0].alias("name")).where("kind is not null and name <> ''").distinct()
    stray = entries.where(F.lower("name").endswith(".ncx")).groupBy("book_id").agg(F.min_by("name", "ord").alias("name")).select("book_id", F.lit("stray").alias("kind"), "name")
    markup = entries.select("book_id", "name", F.regexp_extract("name", "^(.*)/[^/]*$", 1).alias("base"), F.col("text").alias("markup"))
    sources = named.unionByName(stray).join(markup, ["book_id", "name"])
    keyed = sources.select(F.struct("book_id", "kind").alias("source"), "kind", "base", "markup")
    found = nav_page_entries(keyed.where("kind = 'page'"), "source").unionByName(ncx_entries(keyed.where("kind <> 'page'"), "source"))
    rank = F.when(F.col("source.kind") == "page", 0).when(F.col("source.kind") == "map", 1).otherwise(2)
    ranked = found.select("source.book_id", rank.alias("rank"), "ord", "depth", "label", "doc", "anchor")
    best = ranked.groupBy("book_id").agg(F.min("rank").alias("rank"))
    return ranked.join(best, ["book_id", "rank"]).select("book_id", "ord", "depth", "label", "doc", "anchor")


def rewrite_ebooks(files: DataFrame, replacements: DataFrame) -> DataFrame:
    """files(stem, content) with the entries of replacements(book_id, name, markup) exchanged; each archive begins with its mimetype, not compressed.

    Books without a replacement and unreadable archives stay as they are.
    """
    changed = replacements.where("markup is not null").groupBy(F.col("book_id").alias("stem")).agg(F.map_from_entries(F.collect_list(F.struct("name", "markup"))).alias("new"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [exchanged(content, dict(new or ())) for content, new in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(done, pa.binary())], names=["stem", "content"])

    return files.select("stem", "content").join(changed, "stem", "left").mapInArrow(run, "stem string, content binary")


def exchanged(content: bytes | None, new: dict[str, str]) -> bytes | None:
    if not new or content is None:
        return content
    out = io.BytesIO()
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as old, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for info in sorted(old.infolist(), key=lambda i: i.filename != "mimetype"):
                data = new[info.filename].encode() if info.filename in new else old.read(info)
                z.writestr(info.filename, data, zipfile.ZIP_STORED if info.filename == "mimetype" else zipfile.ZIP_DEFLATED)
    except (zipfile.BadZipFile, NotImplementedError, RuntimeError, EOFError):
        return content
    return out.getvalue()


def assets(spark: SparkSession, folder: str) -> DataFrame:
    """files(path, bytes): the images below a folder, by their place in it; suffixes in any case. Contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    inside = F.regexp_replace("path", r"^[a-z]+:/*", "/")
    root = "/" + folder.split(":", 1)[-1].strip("/") + "/" if ":" in folder else folder.rstrip("/") + "/"
    named = found.select(F.when(inside.startswith(root), F.substring(inside, len(root) + 1, 1 << 30)).otherwise(inside).alias("path"), F.col("length").alias("bytes"))
    return named.where(F.lower(F.regexp_extract("path", r"\.([^.]*)$", 1)).isin(*IMAGES))


def write_markdown(pages: DataFrame, folder: str, method: str = "text") -> None:
    """A text file for each book under folder/stem=<book>: a header, then each page of pages(book_id, page_pdf, body) behind its locator."""
    part = F.concat(F.lit("<!-- page_pdf="), F.col("page_pdf").cast("string"), F.lit(" -->\n\n"), F.coalesce("body", F.lit("")))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("page_pdf", part.alias("part")))), lambda x: x.part)
    head = F.concat(F.lit("# "), F.col("book_id"), F.lit(f"\n\n*Converted by {method}*\n\n---\n\n"))
    text = pages.groupBy("book_id").agg(parts.alias("parts")).select(F.col("book_id").alias("stem"), F.concat(head, F.array_join("parts", "\n\n")).alias("value"))
    text.write.mode("overwrite").partitionBy("stem").text(folder)


def write_reports(reports: DataFrame, folder: str) -> None:
    """A JSON row for each book."""
    reports.write.mode("overwrite").json(folder)


class Files(DataSource):
    """A sink of whole files: rows (path, content) become files below the folder path, written by the tasks that hold them."""

    @classmethod
    def name(cls) -> str:
        return "quire_files"

    def schema(self) -> str:
        return "path string, content binary"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return FileWriter(self.options["path"])


@dataclass
class Written(WriterCommitMessage):
    paths: list[str]


def inside(path: str) -> str:
    """path, if it leads to a place below the folder that it is joined to."""
    parts = path.replace("\\", "/").split("/")
    if path.startswith("/") or ":" in parts[0] or ".." in parts or not parts[-1]:
        raise ValueError(f"a path outside the folder: {path!r}")
    return "/".join(x for x in parts if x not in ("", "."))


class FileWriter(DataSourceWriter):
    """Tasks write to a folder of the job; files go to their places when all tasks are done, and a job that fails publishes none.

    A task that still runs when its job is given up may leave its part of that
    folder, _staging-<job>, behind.
    """

    def __init__(self, folder: str) -> None:
        self.folder, self.staging = folder, f"_staging-{uuid.uuid4().hex[:12]}"

    def place(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.folder if ":" in self.folder else f"file://{self.folder}")

    def write(self, iterator: Iterator) -> Written:
        (where, root), paths = self.place(), []
        attempt = f"{root}/{self.staging}/{uuid.uuid4().hex}"  # a task that runs twice writes to two
        for row in iterator:
            path = inside(row["path"])
            where.create_dir(f"{attempt}/{path}".rsplit("/", 1)[0], recursive=True)
            with where.open_output_stream(f"{attempt}/{path}") as out:
                out.write(row["content"] or b"")
            paths.append(path)
        return Written([attempt, *dict.fromkeys(paths)])

    def commit(self, messages: list[Written | None]) -> None:
        where, root = self.place()
        for message in messages:
            attempt, *paths = message.paths if message else [""]
            for path in paths:
                where.create_dir(f"{root}/{path}".rsplit("/", 1)[0], recursive=True)
                where.move(f"{attempt}/{path}", f"{root}/{path}")
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        where, root = self.place()
        if where.get_file_info(f"{root}/{self.staging}").type != fs.FileType.NotFound:
            where.delete_dir(f"{root}/{self.staging}")


def write_files(rows: DataFrame, folder: str) -> None:
    """Images, archives and rewritten e-books, rows (path, content), as files below folder, all or none; paths that lead out of it are refused."""
    rows.sparkSession.dataSource.register(Files)
    rows.select("path", "content").write.format("quire_files").mode("append").save(folder)
