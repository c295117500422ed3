"""Batches of texts are read by their distinct words, with the results of reading word by word."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from quire.llm import decontam
from quire.llm.tokens import Encoder

PIECES = ["a", "B", "é", "É", "\n", " ", " ", ".", ",", "'", "'s", "s", "1", "-", "$", "<", "\\", "日", "\t", "(", "́", "ß", "\x00", "​", "</s>", "<|endoftext|>"]


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_batches_encode_as_whole_texts(file):
    enc, rng = Encoder(public_tokenizers.path(file)), random.Random(3)
    texts = ["", " ", "\n", "\nx", "x\n", "x\nÉé b\n-3,5%\n(a) it's\n's y\n1.\nAb,", "日本語 テキスト"] + ["".join(rng.choices(PIECES, k=rng.randrange(14))) for _ in range(4000)]
    for _ in range(2):  # the second time from memory
        got = enc.encode([x.encode() for x in texts])
        assert all(np.frombuffer(ids, np.uint16).tolist() == enc.tokenizer.encode(x, add_special_tokens=False).ids for x, ids in zip(texts, got))
    assert enc.encode([]) == [] and enc.encode([b"", b""]) == [b"", b""]


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_a_batch_asks_for_each_distinct_word_once(file, monkeypatch):
    enc, asked = Encoder(public_tokenizers.path(file)), []
    words = enc.words
    monkeypatch.setattr(enc, "words", lambda x: asked.extend(x) or words(x))
    enc.encode([b"x word, word. word word! word$$$ words\nword, words"] * 50)
    assert sorted(set(asked)) == sorted(asked) and {b"word", b"words"} <= set(asked)


def test_windows_of_a_batch_by_its_distinct_words(monkeypatch):
    asked = []
    places = decontam.Reader.places
    monkeypatch.setattr(decontam.Reader, "places", lambda self, raw: asked.append(len(raw)) or places(self, raw))
    monkeypatch.setattr(decontam, "READ_AT_ONCE", 100)
    words = "one Two three. 4 km Five six, seven eight (nine) ten".split()
    texts = [" ".join(words[i % 3 :]) for i in range(60)] + ["", None, " \n", " one  Two\n"]
    every = np.full(1 << decontam.FILTER_BITS - 3, 255, np.uint8)
    shared = type("Shared", (), {"value": every.tobytes()})
    batch = pa.RecordBatch.from_pydict({"doc_id": range(len(texts)), "text": texts, "t": range(len(texts))})
    got = {d: h for b in decontam.look_up(shared, [(0, 8), (1, 5), (2, 5)])(iter([batch])) for d, h in zip(b.column("doc_id").to_pylist(), b.column("hashes").to_pylist())}
    assert asked[0] <= len(words) + 1 and len(asked) == 1
    for d, text in enumerate(texts):
        plain, forms, _ = decontam.Reader().read((text or "").encode())
        mine = {int(x) for kind, n, tokens in ((0, 8, plain), (1, 5, forms[0][0]), (2, 5, forms[1][0])) for x in decontam.tagged(decontam.windows(tokens, n), kind, n).view(np.int64)}
        assert set(got.get(d, [])) == mine


@pytest.mark.parametrize("size", range(1, 12))
def test_windows_are_sums_of_their_tokens(size):
    rng = np.random.default_rng(size)
    for n in (0, size - 1, size, 40):
        tokens = rng.integers(0, 1 << 63, n, np.uint64)
        sums = [sum(int(x) * pow(int(decontam.BASE), size - 1 - k, 1 << 64) for k, x in enumerate(tokens[i : i + size])) % (1 << 64) for i in range(n - size + 1)]
        assert decontam.windows(tokens, size).tolist() == decontam.mix64(np.array(sums, np.uint64)).tolist()
