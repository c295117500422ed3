"""python -m quire INPUT -o OUTPUT: books of a folder to Markdown with a report each."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from .functions import text as T
from .plans import incremental
from .plans.convert import Backend, Backends, convert_ebooks, convert_pages
from .session import settled
from .sources import files as sources
from .sources.pages import Pages


def text_pages(files: DataFrame) -> DataFrame:
    """pages of plain text files, cut at form feeds."""
    return files.where("suffix = 'txt'").select(F.col("stem").alias("book_id"), F.posexplode(F.split(F.decode("content", "UTF-8"), "\f")).alias("at", "text")).select("book_id", (F.col("at") + 1).alias("page_pdf"), "text")


def paginated_pages(files: DataFrame) -> DataFrame:
    """pages of paginated text files, cut at their separators."""
    from .operators.structure import split_pages

    return split_pages(files.where("suffix = 'txt'").select(F.col("stem").alias("book_id"), F.decode("content", "UTF-8").alias("text"))).select("book_id", "page_pdf", "text")


BACKENDS = Backends(Backend("text", text_pages), Backend("paginated", paginated_pages, shared_lines=True))


def reported(books: DataFrame) -> DataFrame:
    """(book_id, status, text, report): the report is what else there is, as JSON."""
    return books.select("book_id", "status", "text", F.to_json(F.struct(*(c for c in books.columns if c != "text")), {"ignoreNullFields": "false"}).alias("report"))


def existing(spark: SparkSession, folder: str) -> DataFrame:
    """names(name, taken) of the files of a folder; a folder that isn't there has none."""
    try:
        found = spark.read.format("binaryFile").load(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "name string, taken boolean")
    return found.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.lit(True).alias("taken"))


def archived(spark: SparkSession, books: DataFrame, folder: str) -> DataFrame:
    """files(path, content) for an archive: names that it has get the time before their suffix."""
    name, stamp = F.element_at(F.split("path", "/"), -1), F.date_format(F.current_timestamp(), "yyyyMMdd-HHmmss")
    stamped = F.concat("stem", F.lit("."), stamp, F.regexp_extract("name", r"(\.[^.]*)$", 1))
    named = books.withColumn("name", name).join(settled(existing(spark, folder)), "name", "left")
    return named.select(F.when(F.col("taken"), stamped).otherwise(F.col("name")).alias("path"), "content")


def arguments() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quire", description=__doc__)
    p.add_argument("input", help="a folder of books, or of pages for --extractor")
    p.add_argument("-o", "--output", default="markdown", help="the folder for results")
    p.add_argument("-m", "--method", default="text", choices=sorted(BACKENDS.by_name))
    p.add_argument("--extractor", help="module:function that reads the pages of a file")
    which = p.add_mutually_exclusive_group()
    which.add_argument("--skip-existing", action="store_true", help="leave out books that the output has")
    which.add_argument("--incremental", action="store_true", help="leave out books whose contents and method are as they were when the output took them")
    p.add_argument("--no-retry", action="store_true", help="do not try books that fail with another backend")
    p.add_argument("--clean", action="store_true", help="only apply the text rules to the Markdown files of the input")
    p.add_argument("--no-clean", action="store_true", help="kept for scripts; conversions always repair")
    p.add_argument("--archive-dir", help="a folder that takes copies of the books that were converted; one that has the name already stays, the copy has the time in its name")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """0 if every book came out, 1 if one failed or there were none; 0 as well if nothing has changed."""
    a = arguments().parse_args(argv)
    spark = spark or SparkSession.builder.appName("quire").getOrCreate()
    if a.clean:
        texts = spark.read.text(a.input, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.md").select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]*)\.md$", 1).alias("doc_id"), F.col("value").alias("text"))
        sources.write_files(texts.select(F.concat("doc_id", F.lit(".md")).alias("path"), F.encode(T.clean_text(F.col("text")), "UTF-8").alias("content")), a.output)
        return 0
    delta = None
    if a.extractor:
        spark.dataSource.register(Pages)
        pages = spark.read.format("quire_pages").option("extractor", a.extractor).load(a.input).where("page_pdf is not null")
        done = reported(convert_pages(pages.select("book_id", "page_pdf", "text"), method=a.extractor))
        files = None
    else:
        files = sources.books(spark, a.input, ("txt", "epub"))
        if a.skip_existing:
            try:
                files = sources.without_existing(files, sources.books(spark, a.output, ("md",)))
            except Exception as e:  # no output yet
                if "PATH_NOT_FOUND" not in str(e):
                    raise
        if a.incremental:
            named = files.withColumn("name", F.element_at(F.split("path", "/"), -1))
            delta = settled(incremental.compared(incremental.hashes(named, a.method), incremental.last(spark, f"{a.output}/{incremental.LOG}")))
            stale = named.join(delta.where("state in ('new', 'changed')").select("name"), "name", "left_semi").select("stem").distinct()
            if stale.isEmpty():
                incremental.record(delta, f"{a.output}/{incremental.LOG}")
                print("nothing has changed")
                return 0
            files = files.join(stale, "stem", "left_semi")  # all files of a stem, as they make one book
        done = reported(BACKENDS.convert(files, a.method, not a.no_retry))
        entries = settled(sources.epub_entries(files))
        ebooks = convert_ebooks(sources.spine(entries), sources.navigation(entries))
        done = done.unionByName(reported(ebooks))
    done = settled(done)
    ok = done.where("status = 'ok'")
    sources.write_files(ok.select(F.concat("book_id", F.lit(".md")).alias("path"), F.encode("text", "UTF-8").alias("content")), a.output)
    sources.write_files(done.select(F.concat("book_id", F.lit(".report.json")).alias("path"), F.encode("report", "UTF-8").alias("content")), a.output)
    if a.archive_dir and files is not None:
        kept = files.join(ok.select(F.col("book_id").alias("stem")), "stem", "left_semi")
        sources.write_files(archived(spark, kept, a.archive_dir), a.archive_dir)
    if delta is not None:
        incremental.record(delta, f"{a.output}/{incremental.LOG}")
    n, good = done.count(), ok.count()
    print(f"{good} of {n} books converted")
    return 0 if n and good == n else 1


if __name__ == "__main__":
    raise SystemExit(main())
