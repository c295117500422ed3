"""Archives read entry by entry, text files split by blocks, the sink of files, boxes that meet."""

import random
import zipfile

import pytest
from pyspark.sql import functions as F

from quire.operators import spatial, structure
from quire.sources import files
from quire.sources.archives import FilteringReader, archive_entries, text_entries


@pytest.fixture()
def archives(tmp_path):
    rng = random.Random(1)
    with zipfile.ZipFile(tmp_path / "big.zip", "w") as z:
        for i in range(40):
            z.writestr(f"a/{i}.xhtml", rng.randbytes(20_000).hex(), zipfile.ZIP_DEFLATED if i % 2 else zipfile.ZIP_STORED)
        z.writestr("a/", "")
        z.writestr("a/1.xhtml", "again")
        z.writestr("img.PNG", b"\x89\xff")
    with zipfile.ZipFile(tmp_path / "small.EPUB", "w") as z:
        z.writestr("x.opf", b"caf\xe9 \xf0\x9f\x98\x80")
    (tmp_path / "broken.epub").write_bytes(b"no archive")
    with zipfile.ZipFile(tmp_path / "hurt.zip", "w") as z:
        z.writestr("ok.xml", "fine")
        z.writestr("bad.xml", "b" * 1000)
    raw = (tmp_path / "hurt.zip").read_bytes()
    (tmp_path / "hurt.zip").write_bytes(raw.replace(b"b" * 1000, b"c" * 1000))
    (tmp_path / "empty.zip").write_bytes(b"PK\x05\x06" + bytes(18))
    (tmp_path / "other.txt").write_text("x")
    return tmp_path


def test_entries(spark, archives):
    read = archive_entries(spark, str(archives), entry_bytes=100_000)
    rows = read.collect()
    assert read.rdd.getNumPartitions() > 8  # the large archive alone is several
    with zipfile.ZipFile(archives / "big.zip") as z:
        want = [(i, x.filename, z.read(x)) for i, x in enumerate(z.infolist()) if not x.is_dir()]
    assert sorted((r["ord"], r["name"], bytes(r["content"])) for r in rows if r["book_id"] == "big") == want
    errors = {(r["book_id"], r["name"]): r["error"] for r in rows if r["error"]}
    assert errors.keys() == {("broken", None), ("hurt", "bad.xml")} and errors["broken", None].startswith("BadZipFile")
    assert {r["name"] for r in rows if r["book_id"] == "hurt"} == {"ok.xml", "bad.xml"}
    light = archive_entries(spark, str(archives), (".png", ".opf"), content=False)
    assert light.columns == ["book_id", "ord", "name", "bytes", "error"] and {(r["book_id"], r["name"], r["bytes"]) for r in light.where("error is null").collect()} == {("big", "img.PNG", 2), ("small", "x.opf", 9)}
    texts = {(r["book_id"], r["ord"]): r["text"] for r in text_entries(spark, str(archives)).collect()}
    assert texts["small", 0] == "caf� 😀" and texts["big", 41] == "again" and len(texts) == 43


def test_filters_leave_out_archives(spark, archives):
    from pyspark.sql.datasource import EqualTo, GreaterThan, StringEndsWith

    reader = FilteringReader({"path": str(archives), "entry_bytes": "100000"})
    left = GreaterThan(("bytes",), 3)
    assert list(reader.pushFilters([EqualTo(("book_id",), "big"), left, StringEndsWith(("name",), ".PNG")])) == [left]
    (run,) = reader.partitions()
    assert run.book == "big" and [n for _, n, _ in run.entries] == ["img.PNG"]
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        assert archive_entries(spark, str(archives)).where("book_id = 'small' and bytes > 3").count() == 1
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_no_archives(spark, tmp_path):
    assert archive_entries(spark, str(tmp_path)).count() == 0


def test_pages_over_the_borders_of_blocks(spark, tmp_path):
    rng = random.Random(3)
    pages = [(n, "\n".join("".join(rng.choices("ab \r", k=rng.randrange(0, 60))) for _ in range(rng.randrange(0, 30)))) for n in range(1, 120)]
    text = "before the first\n" + "".join("{%d}%s\n%s\n" % (n, "-" * 48, t) for n, t in pages)
    (tmp_path / "one.txt").write_text(text, newline="")
    (tmp_path / "none.txt").write_text("no separator\n")
    (tmp_path / "empty.txt").write_text("")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        lines = structure.lines_of_files(spark, str(tmp_path), F.regexp_extract("path", r"([^/]*)\.txt$", 1))
        assert lines.select("block").distinct().count() > 10
        got = {r["ord"]: (r["page_pdf"], r["text"]) for r in structure.split_lines(lines).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {i: (n, t) for i, (n, t) in enumerate(pages, 1)}
    whole = structure.split_pages(spark.createDataFrame([("one", text), ("null", None)], "book_id string, text string"))
    assert {r["ord"]: (r["page_pdf"], r["text"].removesuffix("\n")) for r in whole.collect()} == {i: (n, t.removesuffix("\n")) for i, (n, t) in got.items()}


def test_sink_of_files_is_all_or_none(spark, tmp_path):
    out = tmp_path / "out"
    files.write_files(spark.createDataFrame([("a/b.bin", b"1"), ("c.bin", b"2"), ("./d.bin", None)], "path string, content binary"), str(out))
    assert {str(p.relative_to(out)): p.read_bytes() for p in out.rglob("*") if p.is_file()} == {"a/b.bin": b"1", "c.bin": b"2", "d.bin": b""}
    for bad in ("../up.bin", "/root.bin", "a/../../x", "c:/x", "a\\..\\..\\x"):
        with pytest.raises(Exception, match="outside"):
            files.write_files(spark.createDataFrame([("good.bin", b"1"), (bad, b"2")], "path string, content binary").repartition(2), str(out))
    assert not [x for x in out.rglob("good.bin") if "_staging" not in str(x)]
    files.write_files(spark.createDataFrame([("c.bin", b"3")], "path string, content binary"), str(out))
    assert (out / "c.bin").read_bytes() == b"3"


def test_boxes_that_meet(spark):
    rng = random.Random(5)
    box = lambda: (x := rng.uniform(-300, 600), y := rng.uniform(-300, 600), x + rng.choice([0.0, 1.0, 200.0, 700.0]), y + rng.choice([0.0, 5.0, 128.0, 300.0]))
    a, b = ([(rng.choice(["p", "q", None]), i, *box()) for i in range(150)] for _ in range(2))
    a += [("p", 900, 0.0, 0.0, 128.0, 128.0), ("p", 901, None, 0.0, 1.0, 1.0), ("p", 902, 5.0, 5.0, 1.0, 9.0), a[0]]
    b += [("p", 900, 128.0, 128.0, 256.0, 256.0), ("p", 901, 128.0, 0.0, 256.0, 128.0)]
    schema = "page string, id int, x0 double, y0 double, x1 double, y1 double"
    left, right = spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)
    ok = lambda r: None not in r[:1] + r[2:] and r[2] <= r[4] and r[3] <= r[5]
    want = sorted((p[1], q[1]) for p in a for q in b if ok(p) and ok(q) and p[0] == q[0] and p[2] <= q[4] and q[2] <= p[4] and p[3] <= q[5] and q[3] <= p[5])
    for cell in (30.0, 128.0, 5000.0):
        assert sorted((r["id"], r["__r_id"]) for r in spatial.meeting(left, right, ["page"], cell).collect()) == want
    centre = lambda p: ((p[2] + p[4]) / 2, (p[3] + p[5]) / 2)
    inside = sorted((p[1], q[1]) for p in a for q in b if ok(p) and ok(q) and p[0] == q[0] and q[2] <= centre(p)[0] < q[4] and q[3] <= centre(p)[1] < q[5])
    assert sorted((r["id"], r["__r_id"]) for r in spatial.within(left, right, ["page"]).collect()) == inside
    assert spatial.meeting(left.limit(0), right, ["page"]).count() == 0
