"""Encoding whole texts with the tokenizers library, each distinct chunk once for a worker's memory.

The texts of a batch are cut by Arrow, which also finds the distinct chunks; only
these are looked up one by one, and their ids are dealt to all places at once.

Both encoders cut a text only where the tokenizer itself must cut it, so the
ids of the chunks, joined, are the ids of the text:

* word_bpe_49k drops white space and works on what stands between;
* byte_bpe_50k starts a new pre-token at a single space, which belongs to the
  word that follows. Texts with two white-space characters in a row, where the
  pre-tokenizer looks ahead, are encoded whole.

Texts that hold the string of a special token are encoded whole too.

A chunk that is a run of plain letters, with or without a few stops after it,
is one or two pre-tokens whatever stands around it. It goes to the library's
model at once, without the making of an encoding; the letters' normal forms are
asked of the library, one by one, when an encoder is built.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Chunks remembered by a worker (about 200 bytes each), in two halves: a full one takes the place of the older one.
REMEMBERED = 700_000
#: Longer chunks are not remembered.
LONGEST = 64
#: Two white-space characters in a row, as the Unicode property White_Space has them.
DOUBLE_SPACE = re.compile("[\t-\r \x85\xa0  -     　]{2}")
#: Letters whose normal form does not depend on their neighbours, and stops that stand together in one pre-token.
LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
PLAIN = re.compile(f"([{LETTERS}]+)([,.;:!?]*)")
#: All of ASCII's marks but the apostrophe, which may begin a pre-token with the letters after it.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
MARKED = re.compile(f"([{LETTERS}]+)([{re.escape(MARKS)}]*)")
#: Bytes that may belong to white space other than a space or a line feed.
ODD_SPACE = (b"\t", b"\r", b"\x0b", b"\x0c", b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a", b"\xe2\x80", b"\xe2\x81", b"\xe3\x80")
DOUBLE_ASCII = (b"  ", b"\n\n", b" \n", b"\n ")


def double_space(text: bytes) -> bool:
    return any(x in text for x in DOUBLE_ASCII) or any(x in text for x in ODD_SPACE) and bool(DOUBLE_SPACE.search(text.decode()))


class Known(dict):
    """Ids of chunks; a chunk that is not in hand comes from the older memory or is encoded."""

    def __init__(self, enc: Encoder) -> None:
        self.enc, self.old = enc, {}

    def __missing__(self, chunk: bytes) -> bytes:
        (ids,) = self.of([chunk])
        self.keep([chunk], [ids])
        return ids

    def keep(self, chunks: list[bytes], ids: list[bytes]) -> None:
        if len(self) >= REMEMBERED // 2:  # what is used again soon comes back from the older memory
            self.old = dict(self)
            self.clear()
        self.update((c, x) for c, x in zip(chunks, ids) if len(c) <= LONGEST)

    def of(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of chunks, those of one kind together. A word with a stop after it is not remembered, the word is."""
        out = list(map(self.get, chunks))
        if not (left := [i for i, x in enumerate(out) if x is None]):
            return out
        asked = [chunks[i] for i in left]
        back, words, stopped, stops, others = [], [], [], [], []
        for i, chunk, ids in zip(left, asked, map(self.old.get, asked)):
            if ids is not None:
                out[i] = ids
                back.append(i)
            elif chunk.isalpha():  # ASCII
                words.append(i)
            elif plain := self.enc.plain(chunk.decode()):
                if plain[2]:
                    stopped.append(i)
                    stops.append(plain[2])
                else:
                    words.append(i)
            else:
                others.append(i)
        for found, ask in ((words, self.enc.words), (others, self.enc.others)):
            for i, ids in zip(found, ask([chunks[i] for i in found]) if found else ()):
                out[i] = ids
        kept = back + words + others
        self.keep([chunks[i] for i in kept], [out[i] for i in kept])
        for i, stop, ids in zip(stopped, stops, self.of([chunks[i][: -len(x)] for i, x in zip(stopped, stops)]) if stopped else ()):
            out[i] = ids + self.enc.stop(stop)
        return out


class Encoder:
    """Ids of whole UTF-8 texts as little-endian unsigned 16-bit integers."""

    def __init__(self, file: str) -> None:
        self.tokenizer = Tokenizer.from_file(file)
        if self.tokenizer.get_vocab_size(with_added_tokens=True) > 1 << 16:
            raise ValueError("ids of this vocabulary need more than 16 bits")
        self.specials = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.spaced = self.tokenizer.normalizer is None  # a space belongs to the word after it
        self.forms = {ord(c): self.form(c) for c in map(chr, range(256)) if PLAIN.match(c)}
        self.before = self.form(" ") if self.spaced else ""
        self.stops: dict[str, bytes] = {}
        parts = self.tokenizer.pre_tokenizer.pre_tokenize_str("a\nb.\nC1\n2-\né'\n('s\nx") if self.spaced else []
        marked = [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(f"a{MARKS}")] == ["a", MARKS] and all(self.form(c) == c for c in MARKS)
        self.plain = (MARKED if marked else PLAIN).fullmatch
        #: Whether a line feed is a pre-token of its own wherever no other white space stands beside it.
        self.lines = [p for p, _ in parts] == [self.form(c) if len(c) == 1 else c for c in ("a", "\n", "b", ".", "\n", "C", "1", "\n", "2", "-", "\n", "é", "'", "\n", "('", "s", "\n", "x")]
        self.feed = self.one(b"\n") if self.lines else b""
        self.known = Known(self)

    def form(self, letter: str) -> str:
        """What the model is given for a character."""
        normal = self.tokenizer.normalizer.normalize_str(letter) if self.tokenizer.normalizer else letter
        return "".join(piece for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal))

    def others(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of chunks that are no plain words and stand between white space; with a space before them where that belongs to the word."""
        fed = [self.lines and c.startswith(b"\n") for c in chunks]
        rest = iter(self.whole([f" {c.decode()}" if self.spaced else c.decode() for c, f in zip(chunks, fed) if not f]))
        bare = iter(self.bare([c[1:] for c, f in zip(chunks, fed) if f]))
        return [self.feed + next(bare) if f else next(rest) for f in fed]

    def stop(self, stop: str) -> bytes:
        if (ids := self.stops.get(stop)) is None:
            if len(self.stops) > 4096:
                self.stops.clear()
            ids = self.stops[stop] = array("H", [t.id for t in self.tokenizer.model.tokenize(stop)]).tobytes()
        return ids

    def words(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of plain letters."""
        tokenize, before, forms = self.tokenizer.model.tokenize, self.before, self.forms
        texts = [before + (w.decode() if w.islower() and w.isascii() else w.decode().translate(forms)) for w in words]
        return [array("H", [t.id for t in tokenize(x)]).tobytes() for x in texts]

    def bare(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of chunks without a space before them."""
        texts = [c.decode() for c in chunks]
        plain = [self.plain(x) for x in texts]
        rest = iter(self.whole([x for x, p in zip(texts, plain) if not p]))
        tokenize, forms = self.tokenizer.model.tokenize, self.forms
        return [array("H", [t.id for t in tokenize(p[1].translate(forms))]).tobytes() + (self.stop(p[2]) if p[2] else b"") if p else next(rest) for p in plain]

    def whole(self, texts: list[str]) -> list[bytes]:
        return [array("H", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def one(self, text: bytes) -> bytes:
        return self.whole([text.decode()])[0]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text, which is cut between single spaces (or, where white space is dropped, at any white space) unless it must be encoded whole."""
        cut = [not (any(s in x for s in self.specials) or self.spaced and double_space(x)) for x in texts]
        if not all(cut):
            done = iter(self.encode([x for x, c in zip(texts, cut) if c]))
            return [next(done) if c else self.one(x) for x, c in zip(texts, cut)]
        if not any(texts):
            return [b""] * len(texts)
        known, at, ends, _ = self.looked_up(texts)
        _, offsets, ids = known.take(pa.array(at)).buffers()
        places, ids = np.frombuffer(offsets, np.int64)[ends].tolist(), ids.to_pybytes() if ids else b""
        return [ids[a:b] for a, b in zip(places, places[1:])]

    def looked_up(self, texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray, pa.Array]:
        """Texts that can be cut: the ids of their distinct chunks, the place among these of each chunk of all texts, where each text's chunks start and end, and the chunks themselves, of which those after the last are first chunks."""
        if self.lines:  # a line feed begins a chunk of its own
            texts = [x.replace(b"\n", b" \n") for x in texts]
        joined = pa.array(texts, pa.large_binary())
        cuts = pc.split_pattern(joined, b" ") if self.spaced else pc.ascii_split_whitespace(joined.view(pa.large_string()))
        chunks, ends = cuts.flatten().dictionary_encode(), cuts.offsets.to_numpy().astype(np.int64)
        distinct = chunks.dictionary.cast(pa.large_binary())
        known, at = pa.array(self.known.of(distinct.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()), chunks.indices.to_numpy()
        if self.spaced:  # a text's first chunk has no space before it
            heads = self.bare([x for x in cuts.flatten().take(pa.array(ends[:-1])).to_pylist()])
            known, at = pa.concat_arrays([known, pa.array(heads, pa.large_binary())]), at.copy()
            at[ends[:-1]] = len(distinct) + np.arange(len(texts))
        return known, at, ends, distinct

    def counts(self, texts: list[bytes]) -> list[np.ndarray]:
        """Numbers of ids of what stands between single spaces in each text; texts are not empty, and none must be encoded whole."""
        known, at, ends, distinct = self.looked_up(texts)
        n = np.diff(np.frombuffer(known.buffers()[1], np.int64)[: len(known) + 1]) // 2
        if self.lines:  # these chunks belong to what stands before them
            fed = np.r_[pc.equal(pc.binary_slice(distinct, 0, 1), b"\n").to_numpy(zero_copy_only=False), np.zeros(len(texts), bool)]
            starts = np.flatnonzero(~fed[at])
            found, ends = np.add.reduceat(n[at], starts), np.searchsorted(starts, ends)
        else:
            found = n[at]
        return [found[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist())]

    def text(self, text: bytes) -> bytes:
        """Ids of one text, without Arrow: for short ones."""
        if not text:
            return b""
        found = self.chunks(text)
        return self.one(text) if found is None else b"".join(found)

    def chunks(self, text: bytes) -> list[bytes] | None:
        """Ids of what stands between single spaces (or, where white space is dropped, any white space); None where a text must be encoded whole."""
        if any(s in text for s in self.specials) or self.spaced and double_space(text):
            return None
        if self.spaced:
            head, *chunks = text.split(b" ")
            first = [self.one(head) if head else b""]
        else:
            chunks, first = text.split(), []
        return first + list(map(self.known.__getitem__, chunks))


@lru_cache(4)
def encoder(name: str) -> Encoder:
    """name: a file of public_tokenizers, or a path."""
    return Encoder(name if os.sep in name else public_tokenizers.path(name))
