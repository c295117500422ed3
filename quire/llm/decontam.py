"""Benchmark passages in documents, also with other numbers, names and units.

Tokens are words without punctuation at their ends. Their template form
replaces numbers, units after numbers, and names (capitalised words) by typed
placeholders. A capitalised word that opens a sentence may be a name or not, so
there are two template forms: one leaves all openers as words, the other takes
them for names. Within a sentence a run of names is one placeholder, and
so is a run of numbers and units: a value may have another number of tokens.
Windows of WINDOW tokens of the benchmark are hashed three times, as words and
in either form; documents look their windows up.
A document holds an item

* verbatim if SHARE of the item's word windows stand in it, or
* re-parameterised if SHARE of the item's template windows of one form do along
  one alignment, whose offset may change by SHIFT at a time, and the slots agree: each value of the item's slots stands for one
  value of the document's, and the other way round.

Values of equally many words agree word by word, others as a whole.
Items of fewer than WINDOW tokens are one window of their own length; items of
fewer than SHORTEST tokens match nothing, since passages of so few words stand
in clean texts. Template windows with fewer than SOLID tokens that are no slots
are not looked up.

Windows meet by a hash join. The benchmark's windows are a table of hashes, and
a Bloom filter of them of fixed size goes to all tasks; the windows of
documents that pass it, some in a thousand of clean text, are joined to the
table by a shuffle, and summed for each document and item. Only documents that
hold SHARE of an item's windows are read again, with that item's text, for
alignment and slots. Texts of documents are never shuffled for the look-up, and
nothing that goes to all tasks grows with either table.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, free_names, mix64, small_side, tidy, utf8

WINDOW, SHORTEST, SOLID, SHARE, SHIFT = 8, 5, 4, 0.6, 8
#: Bits of the filter, as a power of two, and text that is cut into windows at once.
FILTER_BITS, READ_AT_ONCE, ITEMS_REMEMBERED = 24, 1 << 18, 2_000
REMEMBERED = 300_000
EDGES = re.compile(r"^[^\w<>]+|[^\w<>%°]+$")
NUMBER = re.compile(r"^[+-]?\d[\d.,:/]*%?$")
MEASURE = re.compile(r"^([+-]?\d[\d.,]*)([A-Za-zµ°]{1,4})$")
#: Unit words that are slots after a number.
UNITS = frozenset("mm cm m km in ft yd mi mg g kg t lb oz ml l s ms min h hr hrs hour hours minute minutes second seconds day days week weeks month months year years km/h mph meter meters metre metres gram grams liter liters litre litres dollar dollars euro euros cent cents percent inch inches foot feet mile miles".split())
WORD, SLOT, UNIT, NAME = 0, 1, 2, 4
ENDS, EMPTY = 8, 16
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_POWERS = np.r_[np.uint64(1), np.full(63, BASE)].cumprod(dtype=np.uint64)


def token_hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text)


NAMED, NUMBERED = token_hash("<name>"), token_hash("<number>")
#: Stops that a word of letters may have one of after it, or nothing.
STOPS = frozenset(".,;:!?")


def describe(raw: bytes) -> tuple[int, int, int]:
    """Hash as a word, hash as a template token, flags."""
    text = raw.decode("utf-8", "replace")
    letters = text[:-1] if text[-1:] in STOPS else text
    if letters.isalpha() and (low := letters.lower()) not in UNITS:  # most words; the rules below say the same of them
        plain, flags = token_hash(low), ENDS if text[-1] in ".!?:" else 0
        if len(letters) > 1 and letters[0].isupper() and letters[1:].islower():
            return plain, NAMED, NAME | flags
        return plain, plain, WORD | flags
    flags = ENDS if text.rstrip("\"')]»”")[-1:] in ".!?:" else 0
    word = EDGES.sub("", text)
    if not word:
        return 0, 0, EMPTY | flags
    plain = token_hash(word.lower())
    if NUMBER.match(word):
        return plain, NUMBERED, SLOT | flags
    if MEASURE.match(word):
        return plain, NUMBERED, SLOT | flags
    if word.lower() in UNITS:
        return plain, NUMBERED, UNIT | flags
    if word[0].isupper() and word[1:].islower() and len(word) > 1:
        return plain, NAMED, NAME | flags
    return plain, plain, WORD | flags


def clean(raw: bytes) -> str:
    return EDGES.sub("", raw.decode("utf-8", "replace")).lower()


def values(words: list[str]) -> tuple[list[str], list[str]]:
    """The numbers or names of a slot, and its units."""
    if not (NUMBER.match(words[0]) or MEASURE.match(words[0])):
        return words, []
    numbers, units = [], []
    for word in words:
        if m := MEASURE.match(word):
            numbers.append(m[1])
            units.append(m[2])
        elif NUMBER.match(word):
            numbers.append(word.rstrip("%"))
            units += ["%"] * word.endswith("%")
        else:
            units.append(word)
    return numbers, units


def chains(by_offset: dict[int, set[int]]) -> list[tuple[int, list[tuple[int, range]]]]:
    """Alignments of growing places in item and document: for each end of one the most windows it may have, and its pieces (offset, windows)."""
    pieces = []
    for offset, js in by_offset.items():
        js = np.array(sorted(js))
        cuts = np.flatnonzero(np.diff(js) > 1) + 1
        pieces += [(int(x[-1]) + offset, offset, int(x[0]), int(x[-1])) for x in np.split(js, cuts)]
    pieces.sort()
    best: list[tuple[int, int, int]] = []  # windows, the piece before or -1, first window used
    for k, (_, offset, first, last) in enumerate(pieces):
        top = last - first + 1, -1, first
        for b in range(k - 1, -1, -1):
            end, other, _, before = pieces[b]
            if end < offset - SHIFT:
                break  # so are all earlier ones
            begin = max(first, before + 1, end - offset + 1)
            if abs(other - offset) <= SHIFT and begin <= last and best[b][0] + last - begin + 1 > top[0]:
                top = best[b][0] + last - begin + 1, b, begin
        best.append(top)
    out = []
    for k, (count, _, _) in enumerate(best):
        path = []
        while k >= 0:
            path.append((pieces[k][1], range(best[k][2], pieces[k][3] + 1)))
            k = best[k][1]
        out.append((count, path))
    return out


class Reader:
    """Tokens of a text as arrays; each distinct word is described once."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}
        self.plain, self.template, self.flags = np.zeros(1024, np.uint64), np.zeros(1024, np.uint64), np.zeros(1024, np.uint8)

    def read(self, text: bytes) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]], list[bytes]]:
        """Word hashes; for either form the template hashes, whether a token is a slot and at which word it begins; the words."""
        raw = text.split()
        plain, forms, _, full = self.read_all(self.places(raw), np.zeros(len(raw), np.int64))
        return plain, forms, raw if full.all() else [w for w, f in zip(raw, full.tolist()) if f]

    def places(self, raw: list[bytes]) -> np.ndarray:
        """Where words are described; until the next call."""
        at = list(map(self.known.get, raw))
        if None in at:
            new = list({w for w, i in zip(raw, at) if i is None})
            if len(self.known) + len(new) > REMEMBERED:
                self.known, new = {}, list(set(raw))
            n = len(self.known)
            while n + len(new) > len(self.plain):  # doubled, so that words are copied few times
                self.plain, self.template, self.flags = (np.concatenate([x, np.zeros_like(x)]) for x in (self.plain, self.template, self.flags))
            for i, w in enumerate(new, n):
                self.plain[i], self.template[i], self.flags[i] = describe(w)
                self.known[w] = i
            at = list(map(self.known.__getitem__, raw))
        return np.array(at, np.int64)

    def read_all(self, at: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]], np.ndarray, np.ndarray]:
        """The same for the words of several texts by their places; the texts that words belong to, and which words are more than punctuation."""
        plain, template, flags = self.plain[at], self.template[at], self.flags[at]
        begins = np.r_[True, (flags[:-1] & ENDS) > 0] if len(at) else np.zeros(0, bool)
        full = (flags & EMPTY) == 0
        plain, template, flags, begins, owner = plain[full], template[full], flags[full], begins[full], owner[full]
        first = np.r_[True, owner[1:] != owner[:-1]] if len(owner) else np.zeros(0, bool)
        begins = begins | first
        after = lambda x: np.r_[False, x[:-1]] & ~begins if len(x) else x
        number = flags & SLOT > 0
        numeric = number | (flags & UNIT > 0) & (np.r_[False, number[:-1]] & ~first if len(number) else number)
        name = flags & NAME > 0
        forms = []
        for names in (name & ~begins, name):
            slot = numeric | names
            starts = np.flatnonzero(~(numeric & after(numeric) | names & after(names)))
            forms.append((np.where(slot, template, plain)[starts], slot[starts], starts))
        return plain, forms, owner, full


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of size tokens."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, done = None, 0
    run, length = hashes, 1  # the sums of runs of 1, 2, 4 ... tokens make up those of size
    while True:
        if size & length:
            out = run[size - length :] if out is None else run[size - done - length :][:n] * BASE_POWERS[done] + out
            done += length
        if 2 * length > size:
            return mix64(out)
        run, length = run[:-length] * BASE_POWERS[length] + run[length:], 2 * length


def tagged(hashes: np.ndarray, kind: int, size: int) -> np.ndarray:
    """Hashes of windows of a kind (0: words, 1 and 2: the template forms) and size."""
    return mix64(hashes + np.uint64((kind * 64 + size + 1) * 0xA24BAED4963EE407 & 0xFFFFFFFFFFFFFFFF))


def windows_of_item(forms: list, plain: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(kind, size, tagged hashes, which are looked up) of an item."""
    size = min(WINDOW, len(plain))
    yield 0, size, tagged(windows(plain, size), 0, size), np.ones(len(plain) - size + 1, bool)
    for kind, (template, slot, _) in enumerate(forms, 1):
        size = min(WINDOW, len(template))
        solid = np.convolve(~slot, np.ones(size, int), "valid") >= SOLID
        yield kind, size, tagged(windows(template, size), kind, size), solid


class Item:
    """The windows of an item."""

    def __init__(self, text: bytes, reader: Reader) -> None:
        plain, forms, words = reader.read(text)
        self.words, self.kinds = [clean(w) for w in words], []
        self.forms = [(slot, np.r_[starts, len(plain)]) for _, slot, starts in forms]
        if len(plain) >= SHORTEST:
            for kind, size, hashes, used in windows_of_item(forms, plain):
                places = defaultdict(list)
                for j in np.flatnonzero(used).tolist():
                    places[int(hashes[j])].append(j)
                self.kinds.append((kind, size, dict(places), int(used.sum())))

    def held_by(self, read: tuple) -> tuple[float, str] | None:
        """The share of the item's windows that a text (as a Reader gives it) holds, and how, if it holds the item."""
        plain, forms, words = read
        for kind, size, places, n in self.kinds:
            tokens = plain if kind == 0 else forms[kind - 1][0]
            hashes = tagged(windows(tokens, size), kind, size)
            by_offset = defaultdict(set)
            for p in np.flatnonzero(np.isin(hashes, np.array(list(places), np.uint64))).tolist():
                for j in places[int(hashes[p])]:
                    by_offset[p - j].add(j)
            found = len(set().union(*by_offset.values())) if by_offset else 0
            if not found or found < SHARE * n:
                continue
            if kind == 0:
                return found / n, "verbatim"
            best = self.aligned(kind - 1, size, by_offset, n, forms[kind - 1][2], words)
            if best and (kind == 2 or (other := self.only(2).held_by(read)) is None or other[0] <= best):
                return best, "re-parameterised"
            if best:
                return other
        return None

    def only(self, kind: int) -> Item:
        out = object.__new__(Item)
        out.words, out.forms, out.kinds = self.words, self.forms, [x for x in self.kinds if x[0] == kind]
        return out

    def aligned(self, form: int, size: int, by_offset: dict[int, set[int]], n: int, starts: np.ndarray, words: list[bytes]) -> float | None:
        """The largest share along one alignment whose slots agree."""
        paths = [(len(js), [(offset, js)]) for offset, js in by_offset.items()] + (chains(by_offset) if len(by_offset) > 1 else [])
        for count, path in sorted((x for x in paths if x[0] >= SHARE * n), key=lambda x: -x[0]):
            if self.consistent(form, size, path, starts, words):
                return count / n
        return None

    def consistent(self, form: int, size: int, path: list, starts: np.ndarray, words: list[bytes]) -> bool:
        """Whether the slots agree along the path's pieces (offset, windows); a slot where two pieces meet stands for all from one to the other."""
        slot, item_starts = self.forms[form]
        to, back, place = {}, {}, {}
        ends = np.r_[starts, len(words)]
        for offset, js in path:
            for k in {j + d for j in js for d in range(size)}:
                if slot[k]:
                    low, high = place.get(k, (k + offset, k + offset))
                    place[k] = min(low, k + offset), max(high, k + offset)
        for k, (low, high) in sorted(place.items()):
            mine, mine_units = values(self.words[item_starts[k] : item_starts[k + 1]])
            theirs, their_units = values([clean(w) for w in words[ends[low] : ends[high + 1]]])
            pairs = list(zip(mine, theirs)) if len(mine) == len(theirs) else [(" ".join(mine), " ".join(theirs))]
            pairs += zip(mine_units, their_units) if len(mine_units) == len(their_units) else ()
            if any(to.setdefault(a, b) != b or back.setdefault(b, a) != a for a, b in pairs):
                return False
        return True


WINDOWS = "uid long, hash long, kind int, size int, n long"


def cut_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of items (uid, text) that are looked up; n: how many the item has of the kind."""
    reader = Reader()
    for batch in batches:
        rows = []
        for uid, text in zip(batch.column(0).to_pylist(), utf8(batch, "text")):
            plain, forms, _ = reader.read(text)
            if len(plain) >= SHORTEST:
                for kind, size, hashes, used in windows_of_item(forms, plain):
                    n = int(used.sum())
                    rows += [(uid, h, kind, size, n) for h in hashes[used].view(np.int64).tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()))], names=["uid", "hash", "kind", "size", "n"])


def bits_of(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return hashes >> np.uint64(64 - FILTER_BITS), hashes & np.uint64((1 << FILTER_BITS) - 1)


def filter_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hit = np.zeros(1 << FILTER_BITS, bool)
    for batch in batches:
        for at in bits_of(batch.column(0).to_numpy().view(np.uint64)):
            hit[at] = True
    yield pa.RecordBatch.from_arrays([pa.array([np.packbits(hit).tobytes()], pa.binary())], names=["bits"])


def look_up(shared, sizes: list[tuple[int, int]]):
    """(doc_id, t, hashes): the distinct windows of each document that pass the filter; documents without any give no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hit, reader = np.unpackbits(np.frombuffer(shared.value, np.uint8)).view(bool), Reader()
        for batch in batches:
            docs, ts = batch.column(0), batch.column("t")
            texts = pc.fill_null(batch.column("text").cast(pa.large_string()), "")
            sizes_of = pc.binary_length(texts).to_pylist()
            cut = pc.ascii_split_whitespace(texts)
            words, ends = cut.flatten().dictionary_encode(), cut.offsets.to_numpy()
            # distinct words are looked up; an empty one, at a text's ends, counts as punctuation
            placed = reader.places(words.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist())[words.indices.to_numpy()]
            begin = 0
            while begin < len(texts):
                stop, size = begin, 0
                while stop < len(texts) and size < READ_AT_ONCE:
                    size += sizes_of[stop]
                    stop += 1
                owner = np.repeat(np.arange(begin, stop), np.diff(ends[begin : stop + 1]))
                plain, forms, owner, _ = reader.read_all(placed[ends[begin] : ends[stop]], owner)
                found, owners = [], []
                for kind, n in sizes:
                    tokens, of = (plain, owner) if kind == 0 else (forms[kind - 1][0], owner[forms[kind - 1][2]])
                    if len(tokens) < n:
                        continue
                    hashes = tagged(windows(tokens, n), kind, n)
                    high, low = bits_of(hashes)
                    at = np.flatnonzero(hit[high])
                    at = at[hit[low[at]] & (of[at] == of[at + n - 1])]
                    found.append(hashes[at])
                    owners.append(of[at])
                hashes, of = (np.concatenate(found), np.concatenate(owners)) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
                order = np.lexsort((hashes, of))
                hashes, of = hashes[order], of[order]
                new = np.r_[True, (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])] if len(of) else np.zeros(0, bool)
                hashes, of = hashes[new], of[new]
                mine, edges = np.unique(of, return_index=True)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[edges, len(of)].astype(np.int32)), pa.array(hashes.view(np.int64)))
                if len(mine):
                    yield pa.RecordBatch.from_arrays([docs.take(pa.array(mine)), ts.take(pa.array(mine)), lists], names=["doc_id", "t", "hashes"])
                begin = stop

    return run


FOUND = "doc_id long, t long, contaminated boolean, item_id long, coverage double, kind string"


def check_candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best item that each document (doc_id, t, text, items) holds: verbatim before re-parameterised, then by share, then the first by id and text."""
    reader, known = Reader(), {}
    for batch in batches:
        rows = []
        for doc, t, text, items in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch, "text"), batch.column("items").to_pylist()):
            read, best = reader.read(text), None
            for x in sorted(items, key=lambda x: (x["item_id"] is None, x["item_id"] or 0, x["item_text"])):
                if (item := known.get(x["item_text"])) is None:
                    if len(known) > ITEMS_REMEMBERED:
                        known.clear()
                    item = known[x["item_text"]] = Item(x["item_text"].encode(), reader)
                held = item.held_by(read)
                if held and (best is None or (held[1] == "verbatim", held[0]) > (best[2] == "verbatim", best[1])):
                    best = x["item_id"], *held
            if best:
                rows.append((doc, t, True, best[0], float(best[1]), best[2]))
        types = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.float64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 6, types)], names=["doc_id", "t", "contaminated", "item_id", "coverage", "kind"])


def mark_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs with contaminated, item_id (the best covered item), coverage and kind (verbatim or re-parameterised).

    Null or empty texts, and all documents where the benchmark is empty, are
    clean: false, nulls. Ties go to the item that comes first by item_id and
    text. Columns of these names are replaced; rows stay as many as they were,
    and rows that are equal in doc_id and text get equal results.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontam")
    docs = docs.drop("contaminated", "item_id", "coverage", "kind")
    texts = docs.select("doc_id", "text").withColumn("t", F.xxhash64("text"))
    items = scratch.keep("items", benchmark.select("item_id", "text").where(F.length("text") > 0).distinct().withColumn("uid", F.xxhash64("item_id", "text")))
    cut = scratch.keep("windows", items.select("uid", "text").mapInArrow(tidy(cut_items), WINDOWS).groupBy("uid", "hash", "kind", "size", "n").agg(F.count("*").alias("m")))
    bits = np.zeros(1 << FILTER_BITS - 3, np.uint8)
    for row in cut.select("hash").mapInArrow(tidy(filter_bits), "bits binary").toLocalIterator():  # one of fixed size a task
        bits |= np.frombuffer(row["bits"], np.uint8)
    sizes = sorted((r["kind"], r["size"]) for r in cut.select("kind", "size").distinct().collect())  # 3 * WINDOW at most
    shared = spark.sparkContext.broadcast(bits.tobytes())
    hits = scratch.keep("hits", texts.where(F.length("text") > 0).mapInArrow(tidy(look_up(shared, sizes)), "doc_id long, t long, hashes array<long>"))
    met = hits.select("doc_id", "t", F.explode("hashes").alias("hash")).distinct().join(cut, "hash")
    sums = met.groupBy("doc_id", "t", "uid", "kind").agg(F.sum("m").alias("m"), F.first("n").alias("n")).where(F.col("m") >= SHARE * F.col("n"))
    named = sums.select("doc_id", "t", "uid").distinct().join(items.withColumnRenamed("text", "item_text"), "uid")
    asked = scratch.keep("asked", named.groupBy("doc_id", "t").agg(F.collect_list(F.struct("item_id", "item_text")).alias("items")))
    key = lambda a, b: a[0].eqNullSafe(b[0]) & (a[1] == b[1])
    d, k, t = free_names(docs, "d", "k", "t")
    again = texts.join(small_side(asked.select(F.col("doc_id").alias("d"), F.col("t").alias("k"), "items")), key((F.col("doc_id"), F.col("t")), (F.col("d"), F.col("k"))))
    found = scratch.keep("found", again.select("doc_id", "t", "text", "items").mapInArrow(tidy(check_candidates), FOUND).dropDuplicates(["doc_id", "t"]))
    found = found.withColumnsRenamed({"doc_id": d, "t": k})
    joined = docs.withColumn(t, F.xxhash64("text")).join(small_side(found), key((F.col("doc_id"), F.col(t)), (F.col(d), F.col(k))), "left")
    return joined.select(*docs.columns, F.coalesce("contaminated", F.lit(False)).alias("contaminated"), "item_id", "coverage", "kind")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return mark_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("text")
