"""Token counts that follow edits without encoding a text again.

A text is cut into segments at single spaces between two characters that are
not white space: there the byte-level pre-tokenizer always starts a new
pre-token, so segments are encoded alone and their counts add up. A document
keeps a sum tree over its segments. An edit encodes again only the segments
it touches and one whole segment of context at either side, which stay cut
whatever stands between them, and changes the sums on the way to the root.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import Scratch, utf8
from .tokens import Encoder, double_space, encoder

WHITE = "\t-\r \x85\xa0  -     　"
CUT = re.compile(f"(?<=[^{WHITE}]) (?=[^{WHITE}])")
DIGITS = re.compile("[0-9]+")
COUNTS = "doc_id long, n_tokens long, n_edits long, n_tokens_after long, n_segments long, n_encoded_again long"

TOKENS, CHARS, LEAF = 0, 1, 256

Edit = tuple[int, int, str]  # first character, characters replaced, replacement


def segments(text: str) -> list[str]:
    raw = text.encode()
    if raw and not double_space(raw) and not text.startswith(" ") and not text.endswith(" "):
        first, *others = text.split(" ")
        return [first, *(f" {x}" for x in others)]
    at = [0, *(m.start() for m in CUT.finditer(text)), len(text)]
    return [text[a:b] for a, b in zip(at, at[1:]) if b > a]


class SumTree:
    """Sums of tokens, characters and segments over fixed leaves; a change costs as many steps as the tree is deep."""

    def __init__(self, leaves: np.ndarray) -> None:
        self.n = 1 << max(0, len(leaves) - 1).bit_length()
        self.nodes = np.zeros((2 * self.n, leaves.shape[1]), np.int64)
        self.nodes[self.n : self.n + len(leaves)] = leaves
        a = self.n
        while a > 1:
            self.nodes[a // 2 : a] = self.nodes[a : 2 * a : 2] + self.nodes[a + 1 : 2 * a : 2]
            a //= 2

    def set(self, leaf: int, values: tuple[int, ...]) -> None:
        i = leaf + self.n
        change = np.array(values) - self.nodes[i]
        while i and change.any():
            self.nodes[i] += change
            i >>= 1

    def find(self, at: int) -> int:
        """The leaf that holds a character."""
        i = 1
        while i < self.n:
            left = int(self.nodes[2 * i, CHARS])
            i, at = (2 * i, at) if at < left else (2 * i + 1, at - left)
        return i - self.n

    def before(self, leaf: int) -> int:
        """Characters before a leaf."""
        i, out = leaf + self.n, 0
        while i > 1:
            out += int(self.nodes[i - 1, CHARS]) if i & 1 else 0
            i >>= 1
        return out

    @property
    def total(self) -> int:
        return int(self.nodes[1, TOKENS])


class CountedText:
    """A text as a tree of segments with their counts; batches of edits may follow one another.

    An edit puts the new segments of the region it touches into the region's
    first leaf and empties the others; a leaf of more than LEAF segments makes
    the tree anew from the counts at hand.
    """

    def __init__(self, text: str, enc: Encoder, counts: list[int] | None = None) -> None:
        self.enc, self.encoded_again = enc, 0
        cut = segments(text)
        self.plant(cut, counts if counts is not None else [self.count(x) for x in cut])

    def plant(self, cut: list[str], counts: list[int]) -> None:
        self.leaves = [([x], [n]) for x, n in zip(cut, counts)] or [([], [])]
        self.tree = SumTree(np.stack([counts, list(map(len, cut)), np.ones(len(cut), np.int64)], 1) if cut else np.zeros((1, 3), np.int64))

    def count(self, segment: str) -> int:
        if segment.startswith(" ") and (known := self.enc.known.get(segment[1:].encode())) is not None:
            return len(known) // 2
        return len(self.enc.text(segment.encode())) // 2

    @property
    def segments(self) -> list[str]:
        return [x for leaf, _ in self.leaves for x in leaf]

    @property
    def counts(self) -> list[int]:
        return [n for _, leaf in self.leaves for n in leaf]

    @property
    def text(self) -> str:
        return "".join(self.segments)

    def beside(self, leaf: int, step: int) -> int:
        """The next leaf that is not empty on one side, or the last there is."""
        leaf += step
        while 0 < leaf < len(self.leaves) - 1 and not self.leaves[leaf][0]:
            leaf += step
        return min(max(leaf, 0), len(self.leaves) - 1)

    def apply(self, edits: list[Edit]) -> int:
        """Apply edits, given in characters of the text as it is (one that overlaps the one before it is left out); how many were applied."""
        done, last, total = 0, 0, int(self.tree.nodes[1, CHARS])
        groups: list[tuple[int, int, list[Edit]]] = []
        for at, length, new in sorted(edits, key=lambda e: (e[0], e[1])):
            if at < last or at < 0 or length < 0 or at + length > total:
                continue
            last, done = at + length, done + 1
            first = self.beside(self.tree.find(max(at - 1, 0)), -1)
            stop = self.beside(self.tree.find(max(min(at + length, total - 1), 0)), 1) + 1
            if groups and first < groups[-1][1]:  # contexts that meet are encoded together
                groups[-1] = (groups[-1][0], max(stop, groups[-1][1]), [*groups[-1][2], (at, length, new)])
            else:
                groups.append((first, stop, [(at, length, new)]))
        begins = [self.tree.before(first) for first, _, _ in groups]
        for begin, (first, stop, some) in zip(begins, groups):
            old, parts, pos = "".join(x for leaf, _ in self.leaves[first:stop] for x in leaf), [], 0
            for at, length, new in some:
                parts += [old[pos : at - begin], new]
                pos = at - begin + length
            cut = segments("".join([*parts, old[pos:]]))
            counts = [self.count(x) for x in cut]
            self.encoded_again += len(cut)
            for i in range(first, stop):
                mine = (cut, counts) if i == first else ([], [])
                self.leaves[i] = mine
                self.tree.set(i, (sum(mine[1]), sum(map(len, mine[0])), len(mine[0])))
        if any(len(self.leaves[first][0]) > LEAF for first, _, _ in groups):
            self.plant(self.segments, self.counts)
        return done


def digit_runs(text: str) -> list[Edit]:
    """Every run of ASCII digits becomes one zero, as a scrubber of numbers does it."""
    return [(m.start(), m.end() - m.start(), "0") for m in DIGITS.finditer(text)]


TREES = "doc_id long, text string, counts binary"


def leaves_of(enc: Encoder, texts: list[bytes]) -> list[np.ndarray]:
    """Tokens of each segment of each text: texts that are cut at every space are looked up together."""
    cut = [bool(enc.spaced and x and not x.startswith(b" ") and not x.endswith(b" ") and not any(s in x for s in enc.specials) and not double_space(x)) for x in texts]
    together = iter(enc.counts([x for x, c in zip(texts, cut) if c]) if any(cut) else ())
    return [next(together) if c else np.array([len(enc.text(y.encode())) // 2 for y in segments(x.decode())]) for x, c in zip(texts, cut)]


def count_leaves(enc: Encoder, raw: bytes) -> list[int]:
    """Tokens of each segment of a text."""
    return leaves_of(enc, [raw])[0].tolist()


def build_trees(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", extra: tuple[str, ...] = ()) -> DataFrame:
    """trees(doc_id, text, counts) of docs (doc_id, text): a tree by its leaves, little-endian unsigned 32-bit counts of the text's segments.

    A null text is empty and has no leaf. Rows with equal or null doc_id have
    a tree each. Columns named in extra go along.
    """
    Scratch(docs.sparkSession, "edits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            texts = utf8(batch, "text")
            counts = [x.astype("<u4").tobytes() for x in leaves_of(enc, texts)]
            columns = [batch.column(0), pa.array([x.decode() for x in texts]), pa.array(counts, pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, *batch.columns[2:]], names=["doc_id", "text", "counts", *extra])

    docs = docs.select("doc_id", "text", *extra)
    return docs.mapInArrow(run, ", ".join([TREES, *(f"{c} {docs.schema[c].dataType.simpleString()}" for c in extra)]))


def edit_trees(trees: DataFrame, editor: Callable[[str], list[Edit]] | None = None, vocabulary: str = "byte_bpe_50k.json", keep: bool = True) -> DataFrame:
    """Trees after edits, and the counts: doc_id, n_tokens, n_edits, n_tokens_after, n_segments, n_encoded_again; with keep also text and counts, so that more edits may follow.

    Edits come from the column edits (array<struct<at int, length int, new
    string>>) or from editor. Null edits are none; edits outside the text or
    overlapping an earlier one are left out. Only the segments that edits
    touch, and one either side, are encoded; other trees are summed.
    """
    columns = ["doc_id", "text", "counts"] + ["edits"] * (editor is None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            rows, given = [], batch.column(3).to_pylist() if editor is None else None
            for i, (doc, raw, leaves) in enumerate(zip(batch.column(0).to_pylist(), utf8(batch, "text"), batch.column(2).to_pylist())):
                text, counts = raw.decode(), np.frombuffer(leaves, "<u4")
                edits = editor(text) if editor else [(e["at"], e["length"], e["new"] or "") for e in given[i] or [] if e]
                before = int(counts.sum())
                row = (doc, before, 0, before, len(counts), 0, text, leaves)
                if edits:
                    tree = CountedText(text, enc, counts.tolist())
                    n = tree.apply(edits)
                    row = (doc, before, n, tree.tree.total, len(counts), tree.encoded_again, tree.text if keep else None, np.array(tree.counts, "<u4").tobytes() if keep else None)
                rows.append(row)
            types = [*[pa.int64()] * 6, pa.string(), pa.binary()]
            names = [*(x.split()[0] for x in COUNTS.split(", ")), "text", "counts"]
            arrays = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 8, types)]
            yield pa.RecordBatch.from_arrays(arrays if keep else arrays[:6], names=names if keep else names[:6])

    return trees.select(*columns).mapInArrow(run, f"{COUNTS}, text string, counts binary" if keep else COUNTS)


def count_with_edits(docs: DataFrame, editor: Callable[[str], list[Edit]] | None = None, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """Token counts of docs before and after edits, through stored trees; see build_trees and edit_trees. An empty table gives no rows."""
    scratch = Scratch(docs.sparkSession, "edits")
    trees = scratch.keep("trees", build_trees(docs, vocabulary, () if editor else ("edits",)))
    return edit_trees(trees, editor, vocabulary, keep=False)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_with_edits(spark.read.parquet(f"{sf_dir}/documents.parquet"), digit_runs)
