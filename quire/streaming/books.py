"""Books put together from pages that arrive one by one, in any order.

The state of a book is its pages and how often each normalised edge line stood
on them, so that a running head is known as soon as the last page is there. A
book leaves when it has as many pages as it should, or when the watermark has
passed its newest page by a while; its pages then go through the same rules as
those of a batch. What comes after that is handed on as late, unchanged.

State lies in RocksDB, a row a page: no book needs to fit into memory.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators import furniture
from ..session import settled

SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
}
COMPLETE, TIMED_OUT, LATE = "complete", "timed out", "late"
OUT = "book_id string, page_pdf int, text string, status string, n_pages long, heads array<string>, feet array<string>, prefixes array<string>"


class Assembly(StatefulProcessor):
    """A book's pages until it leaves; of a page that comes twice the first counts."""

    def __init__(self, wait_ms: int) -> None:
        self.wait_ms = wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pages = handle.getMapState("pages", "page_pdf int", "text string")
        self.counts = handle.getMapState("counts", "key string", "n long")
        self.book = handle.getValueState("book", "n long, expected long, newest long, left boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        n, expected, newest, left = self.book.get() if self.book.exists() else (0, None, 0, False)
        for row in rows:
            if left:
                yield Row(book_id=key[0], page_pdf=row.page_pdf, text=row.text, status=LATE, n_pages=n, heads=[], feet=[], prefixes=[])
                continue
            newest = max(newest, int(row.arrived.timestamp() * 1000))
            expected = row.expected if expected is None else expected
            if row.page_pdf is None or self.pages.containsKey((row.page_pdf,)):
                continue
            self.pages.updateValue((row.page_pdf,), (row.text,))
            n += 1
            for k in row.keys:
                seen = self.counts.getValue((k,))[0] if self.counts.containsKey((k,)) else 0
                self.counts.updateValue((k,), (seen + 1,))
        if not left and expected is not None and n >= expected:
            yield from self.leave(key, n, COMPLETE)
            left = True
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if not left:
            self.handle.registerTimer(newest + self.wait_ms)
        self.book.update((n, expected, newest, left))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        n, expected, newest, left = self.book.get()
        if not left:
            yield from self.leave(key, n, TIMED_OUT)
            self.book.update((n, expected, newest, True))

    def leave(self, key, n: int, status: str) -> Iterator[Row]:
        """The book's pages with what recurs on them; of its state only the counts of pages stay."""
        least = max(furniture.LEAST_LINES, furniture.SHARE * n)
        often = [k.split(" ", 1) for (k,), (m,) in self.counts.iterator() if m >= least]
        sets = {kind: sorted(k for x, k in often if x == kind) for kind in furniture.KINDS}
        for (page,), (text,) in self.pages.iterator():
            yield Row(book_id=key[0], page_pdf=page, text=text, status=status, n_pages=n, **sets)
        self.pages.clear()
        self.counts.clear()

    def close(self) -> None:
        pass


def assembled(pages: DataFrame, wait: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Rows of OUT of a stream pages(book_id, page_pdf, text, expected, arrived): all pages of each book that leaves, and late pages.

    expected is the number of the book's pages, null where nobody knows it;
    arrived the page's event time. A book without a page for as long as wait
    leaves as it is. Pages without a number or a book are dropped; null texts
    are empty. Pages older than the watermark (delay behind the newest page of
    all) are dropped before they get here, as Spark's stateful operators do: a
    book that misses one leaves by its timer.
    """
    seconds = pages.sparkSession.sql(f"select cast(interval {wait} as interval day to second) as w").first()["w"].total_seconds()
    keyed = furniture.with_lines(pages.where("book_id is not null").withColumn("text", F.coalesce("text", F.lit(""))))
    rows = keyed.select("book_id", "page_pdf", "text", "expected", "arrived", F.transform(furniture.edge_keys(), lambda k: F.concat(k.kind, F.lit(" "), k.key)).alias("keys")).withWatermark("arrived", delay)
    return rows.groupBy("book_id").transformWithState(statefulProcessor=Assembly(int(seconds * 1000)), outputStructType=OUT, outputMode="Append", timeMode="EventTime")


def cleaned(books: DataFrame, of_body: Callable[[Column], Column] = lambda body: body) -> DataFrame:
    """pages_clean(book_id, page_pdf, body, page_printed, status) of whole books of OUT; late pages keep their text. books is read once; of_body says what is kept of a body."""
    known = books.withColumn("n_pages", F.when(F.col("status") == LATE, 0).otherwise(F.col("n_pages")))  # like pages of books too short for furniture
    return furniture.strip_known(known, keep=("status",), of_body=of_body)


def assemble(pages: DataFrame, out: str, checkpoint: str, wait: str = "1 hour", delay: str = "10 minutes", then: Callable[[DataFrame], DataFrame] | None = None, of_body: Callable[[Column], Column] = lambda body: body) -> StreamingQuery:
    """Write each batch's books to Parquet under out/batch=<n>, take all there is, and stop; started again it goes on with the open books. A batch that runs again replaces what it wrote.

    Without then, books are cleaned, and of_body says what is kept of a body;
    then gets a batch that has been written, and may read it more than once.
    """

    def write(batch: DataFrame, n: int) -> None:
        done = cleaned(batch, of_body) if then is None else then(settled(batch))
        done.write.mode("overwrite").option("compression", "zstd").parquet(f"{out}/batch={n}")

    with _rocks(pages.sparkSession):
        return assembled(pages, wait, delay).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class _rocks:
    """The state store that the processor needs, its tables well compressed, for a query that starts meanwhile; the session's own settings come back."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark

    def __enter__(self) -> None:
        self.was = {k: self.spark.conf.get(k, None) for k in SETTINGS}
        for k, v in SETTINGS.items():
            self.spark.conf.set(k, v)

    def __exit__(self, *_) -> None:
        for k, v in self.was.items():
            self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)
