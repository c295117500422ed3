"""Regions of figures on pages, their captions, and references to images."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_local, link_target
from ..session import settled
from .cleanup import rebuild
from .ordering import number_rows
from .spatial import BOX, meeting
from .structure import IMAGE

# Fixed values.
CAPTION = r"(?i)^\s*(figure|fig\.?|exhibit|diagram|chart)\s+\d+([.\-]\d+)?\b"
RASTER_AREA, VECTOR_AREA, MERGE_GAP, CAPTION_DISTANCE = 2000, 2500, 30, 40
#: Boxes that a task merges at a time.
AT_ONCE = 200_000


def area() -> Column:
    return (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))


def raster_regions(images: DataFrame) -> DataFrame:
    """images(..., x0, y0, x1, y1) large enough to be figures; boxes with a null side are none."""
    return images.where(area() >= RASTER_AREA)


def _pass(boxes: list[tuple], gap: float) -> tuple[list[tuple], bool]:
    """Boxes met from left to right, and whether any were joined.

    Of the boxes held, no two lie within gap of each other from top to bottom:
    their upper and lower edges have one order, and those that a new box may
    join are a run, found by bisection. What a run holds beside those that join
    lies too far to the left for any box to come.
    """
    lows: list[float] = []
    highs: list[float] = []
    held: list[tuple] = []
    done: list[tuple] = []
    joined = False
    for x0, y0, x1, y1 in sorted(boxes):
        while True:
            a, b = bisect_right(highs, y0 - gap), bisect_left(lows, y1 + gap)
            if a >= b:
                break
            near = [d for d in held[a:b] if d[2] + gap > x0 and d[0] < x1 + gap]
            if not near:
                break
            joined = True
            rest = [d for d in held[a:b] if not (d[2] + gap > x0 and d[0] < x1 + gap)]
            held[a:b], lows[a:b], highs[a:b] = rest, [d[1] for d in rest], [d[3] for d in rest]
            x0, y0 = min(x0, *(d[0] for d in near)), min(y0, *(d[1] for d in near))
            x1, y1 = max(x1, *(d[2] for d in near)), max(y1, *(d[3] for d in near))
        if a >= b:
            held.insert(a, (x0, y0, x1, y1))
            lows.insert(a, y0)
            highs.insert(a, y1)
            continue
        if any(d[2] + gap > x0 for d in held[a:b]):  # without a gap, a box without width beside one that begins there: nothing to come is near it
            done.append((x0, y0, x1, y1))
            continue
        done += held[a:b]
        held[a:b], lows[a:b], highs[a:b] = [(x0, y0, x1, y1)], [y0], [y1]
    return done + held, joined


def merged_boxes(boxes: Iterable[tuple], gap: float) -> list[tuple]:
    """Boxes joined while any two lie within gap of each other; joined boxes grow, so components of the first ones aren't enough.

    Passes from left to right and from top to bottom take turns until one joins
    nothing. Which boxes come out depends neither on their order nor on what
    was joined beforehand.
    """
    found, upright = list(boxes), True
    while True:
        found, joined = _pass(found, gap)
        if not joined:
            return sorted(found if upright else [(x0, y0, x1, y1) for y0, x0, y1, x1 in found])
        found, upright = [(y0, x0, y1, x1) for x0, y0, x1, y1 in found], not upright


def merge_regions(drawings: DataFrame, keys: tuple[str, ...] = ("book_id", "page_pdf"), gap: float = MERGE_GAP, least: float = VECTOR_AREA) -> DataFrame:
    """regions(keys, x0, y0, x1, y1): the drawings of each page merged, those of at least that area.

    Every task first merges what it has of a page, which changes nothing in the
    end, and only what is left is brought together: boxes further than gap from
    each other, of which a page has room for a bounded number. Boxes with a
    side that is null or no number are none, ends the wrong way round are
    exchanged. Null keys are a key; an empty table gives no rows.
    """
    low = [F.least("x0", "x1"), F.least("y0", "y1"), F.greatest("x0", "x1"), F.greatest("y0", "y1")]
    sides = " and ".join(f"{c} is not null and not isnan({c})" for c in BOX)
    whole = drawings.select(F.struct(*keys).alias("key"), *(F.col(c).cast("double").alias(c) for c in BOX)).where(sides).select("key", *(x.alias(c) for x, c in zip(low, BOX)))
    key_type = drawings.sparkSession.createDataFrame([], whole.schema).toArrow().schema.field("key").type

    def table_of(found: dict[tuple, list[tuple]]) -> pa.Table:
        names = [f.name for f in key_type]
        keyed = [dict(zip(names, k)) for k, mine in found.items() for _ in mine]
        sides = [[box[i] for mine in found.values() for box in mine] for i in range(4)]
        return pa.table([pa.array(keyed, key_type), *(pa.array(x, pa.float64()) for x in sides)], names=["key", *BOX])

    def in_hand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list[tuple]] = {}
        n = 0
        for batch in batches:
            for key, *box in zip(*(batch.column(i).to_pylist() for i in range(5))):
                held.setdefault(tuple(key.values()), []).append(tuple(box))
            n += batch.num_rows
            if n >= AT_ONCE:
                held = {k: merged_boxes(mine, gap) for k, mine in held.items()}
                n = sum(map(len, held.values()))
                if 2 * n >= AT_ONCE:
                    yield from table_of(held).to_batches()
                    held, n = {}, 0
        yield from table_of({k: merged_boxes(mine, gap) for k, mine in held.items()}).to_batches()

    def run(key, rows):
        found = merged_boxes(zip(*(rows[c].to_pylist() for c in BOX)), gap)
        large = [x for x in found if (x[2] - x[0]) * (x[3] - x[1]) >= least]
        return table_of({tuple(rows["key"][0].as_py().values()): large})

    merged = whole.mapInArrow(in_hand, whole.schema).groupBy("key").applyInArrow(run, whole.schema)
    return merged.select("key.*", *BOX)


def match_captions(regions: DataFrame, lines: DataFrame, keys: tuple[str, ...] = ("book_id", "page_pdf"), region: str = "region_id") -> DataFrame:
    """regions with caption: the caption line nearest below each region within its width; ties take the first by ord, none is null.

    lines(keys, ord, x0, y0, x1, y1, text). A region, reaching as far down as a
    caption may stand, meets the upper edges of caption lines on a grid of the
    page, not all lines of it.
    """
    captions = lines.where(F.col("text").rlike(CAPTION)).select(*keys, "ord", F.trim("text").alias("caption"), *(F.col(c).cast("double") for c in ("x0", "x1", "y0")), F.col("y0").cast("double").alias("y1"))
    reach = regions.select(*keys, region, F.col("y1").alias("__end"), *(F.col(c).cast("double").alias(c) for c in BOX)).withColumn("y1", F.col("y1") + CAPTION_DISTANCE)
    hit = meeting(reach, captions, list(keys))
    best = hit.groupBy(*keys, region).agg(F.min_by("__r_caption", F.struct(F.col("__r_y0") - F.col("__end"), "__r_ord")).alias("caption"))
    return regions.join(best, [*keys, region], "left")


def base_and_folder() -> tuple[Column, Column]:
    """Of path: the last part, and the one before it or nothing."""
    return F.element_at(F.split("path", "/"), -1), F.coalesce(F.get(F.reverse(F.split("path", "/")), F.lit(1)), F.lit(""))


def harvest_names(files: DataFrame, key: str = "doc_id") -> DataFrame:
    """files(key, path) with name: the base name, and for further files of that name the folder's name before it, then a number.

    Files are taken in the order of their paths. A made name that a file has of
    its own, or that an earlier file has got, goes to the next number too. A
    null path is no file, a path that comes twice is one; a null key is a key.

    A made name joins folder, number and base name by dashes. Where none of a
    key's folders and base names has a dash of its own, it can be read in one
    way only and is no base name, so that no two files ask for the same: a place
    in the order says all. Only keys with such a dash need rounds of asking.
    """
    given = files.where("path is not null").select(key, "path")
    base, folder = base_and_folder()
    dashed = settled(given.where(base.contains("-") | folder.contains("-")).select(F.struct(key).alias("k")).distinct())
    if dashed.isEmpty():
        return names_in_order(given, key)
    keyed = given.withColumn("k", F.struct(key))
    plain, others = keyed.join(dashed, "k", "left_anti").select(key, "path"), keyed.join(dashed, "k", "left_semi").select(key, "path")
    return names_in_order(plain, key).unionByName(names_by_rounds(others, key))


def names_in_order(given: DataFrame, key: str) -> DataFrame:
    """harvest_names of given(key, path) of keys where no two files ask for one name. The paths of a key and base name are sorted by one task."""
    base, folder = base_and_folder()
    together = given.repartition(key, base).withColumns({"__base": base, "__folder": folder})
    order = Window.partitionBy(key, "__base").orderBy("path")
    once = together.withColumns({"__n": F.row_number().over(order), "__before": F.lag("path").over(order)}).where("__before is null or __before <> path")
    once = once.withColumn("__first", F.col("__n") == 1)
    r = F.row_number().over(Window.partitionBy(key, "__base", "__folder", "__first").orderBy("path"))
    name = F.when(F.col("__first"), F.col("__base")).when(F.col("__r") == 1, F.concat_ws("-", "__folder", "__base")).otherwise(F.concat_ws("-", "__folder", F.col("__r").cast("string"), "__base"))
    return once.withColumn("__r", r).select(key, "path", name.alias("name"))


def names_by_rounds(files: DataFrame, key: str) -> DataFrame:
    """harvest_names of any files(key, path).

    All files ask for a name at once. Who asks for a base name that there is,
    or for a name that an earlier path also asks for, asks for the next; files
    of one folder and base name keep their order, so that whoever stands behind
    moves on as well. Numbers only grow, and none passes what taking the files
    one by one would give, so the rounds end, and end there.
    """
    base, folder = base_and_folder()
    given = files.select(F.struct(key).alias("k"), "path").distinct().withColumns({"base": base, "folder": folder})
    bases = settled(given.groupBy("k", "base").agg(F.min("path").alias("path")))
    further = given.join(bases, ["k", "base", "path"], "left_anti")
    asked = number_rows(further, ["k", "folder", "base"], ["path"], "r").withColumn("n", F.col("r"))
    name = F.when(F.col("n") == 1, F.concat_ws("-", "folder", "base")).otherwise(F.concat_ws("-", "folder", F.col("n").cast("string"), "base"))
    while True:
        asked = asked.withColumn("name", name)
        best = asked.groupBy("k", "name").agg(F.min("path").alias("best"))
        own = bases.select("k", F.col("base").alias("name"), F.lit(True).alias("own"))
        judged = asked.join(best, ["k", "name"]).join(own, ["k", "name"], "left")
        asked = settled(judged.withColumn("lost", F.col("own").isNotNull() | (F.col("best") < F.col("path"))).select(*asked.columns, "lost"))
        losers = asked.where("lost").select("k", "folder", "base").distinct()
        if losers.isEmpty():
            break
        group = ["k", "folder", "base"]
        ahead = F.max(F.col("n") + F.col("lost").cast("long") - F.col("r")).over(Window.partitionBy(*group).orderBy("r"))
        moved = asked.join(losers, group, "left_semi").withColumn("n", F.col("r") + ahead)
        asked = moved.unionByName(asked.join(losers, group, "left_anti")).drop("name", "lost")
    return bases.select("k.*", "path", F.col("base").alias("name")).unionByName(asked.select("k.*", "path", "name"))


def rewrite_refs(texts: DataFrame, names: DataFrame, folder: str, key: str = "doc_id") -> DataFrame:
    """texts with local references moved to folder where names(key, base, name) has their base name, and n_rewritten."""
    by_key = names.groupBy(key, "base").agg(F.min("name").alias("name")).groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("base", "name"))).alias("__names"))
    target = lambda m: link_target(F.regexp_extract(m, IMAGE, 2))
    plain = lambda m: F.coalesce(F.try_url_decode(F.replace(target(m), F.lit("+"), F.lit("%2B"))), target(m))
    name = lambda m: F.when(is_local(target(m)), F.col("__names")[F.element_at(F.split(plain(m), "/"), -1)])
    moved = lambda m: F.coalesce(F.concat(F.lit("!["), F.regexp_extract(m, IMAGE, 1), F.lit(f"]({folder}/"), name(m), F.lit(")")), m)
    joined, has = texts.join(by_key, key, "left"), F.col("__names").isNotNull() & F.col("text").isNotNull()
    n = F.size(F.filter(F.regexp_extract_all("text", F.lit(IMAGE), 0), lambda m: name(m).isNotNull()))
    return joined.select(*(c for c in texts.columns if c != "text"), F.when(has, rebuild(F.col("text"), IMAGE, moved)).otherwise(F.col("text")).alias("text"), F.when(has, n).otherwise(0).alias("n_rewritten"))
