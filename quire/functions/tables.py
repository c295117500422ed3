"""Table functions for SQL: SELECT * FROM quire_pages_of(TABLE(lines))."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn, udtf
from pyspark.sql.types import IntegerType, LongType, StringType, StructType

#: As in operators.structure.
PAGE = re.compile(r"\{(\d+)\}-{2,}\s*", re.ASCII)
#: The columns that lines of text have, in the order of a row.
BOOK, AT, LINE = "book_id", "at", "line"


@udtf
class PagesOf:
    """pages(book_id, ord, page_pdf, text) of lines(book_id, at, line) of paginated text, as split_pages() gives them.

    analyze() asks for the lines of a book together and in order, so that a call
    needs neither PARTITION BY nor ORDER BY; books are read as a stream, and
    one page is held at a time. Further columns are not read. What stands before
    the first separator is left out, a null line is none, an empty table gives
    no rows. Columns that are missing are named before anything runs.
    """

    def __init__(self) -> None:
        self.book, self.ord, self.page, self.lines = None, 0, 0, []

    @staticmethod
    def analyze(lines: AnalyzeArgument) -> AnalyzeResult:
        if not lines.isTable:
            raise ValueError("quire_pages_of takes a table: quire_pages_of(TABLE(lines))")
        if lacks := [c for c in (BOOK, AT, LINE) if c not in lines.dataType.fieldNames()]:
            raise ValueError(f"quire_pages_of needs the columns {', '.join(lacks)}")
        schema = StructType().add(BOOK, lines.dataType[BOOK].dataType).add("ord", LongType()).add("page_pdf", IntegerType()).add("text", StringType())
        return AnalyzeResult(schema, partitionBy=[PartitioningColumn(BOOK)], orderBy=[OrderingColumn(AT)])

    def eval(self, row: Row) -> Iterator[tuple]:
        line = row[LINE]
        if line is None:
            return
        if found := PAGE.fullmatch(line):
            yield from self.terminate()
            self.book, self.ord, self.page, self.lines = row[BOOK], self.ord + 1, int(found[1]), []
        elif self.ord:
            self.lines.append(line)

    def terminate(self) -> Iterator[tuple]:
        if self.ord:
            yield self.book, self.ord, self.page, "\n".join(self.lines)


def register(spark: SparkSession) -> None:
    """Makes the functions known to the session's SQL."""
    spark.udtf.register("quire_pages_of", PagesOf)
