"""Each operator against brute force on small planted tables: copies, ties, nulls, empty texts and tables."""

import hashlib
import math
import zlib
from collections import Counter
from time import process_time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quire.llm import decontam, edits, jaccard, lattice, linededup, packing, repair, suffix, topk, toxicity
from quire.llm.common import Scratch, fits_broadcast, text_bytes
from quire.llm.tokens import encoder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, of=400):
    return " ".join(f"w{int(x)}" for x in rng.integers(0, of, n))


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(7)
    texts = [words(rng, int(n)) for n in rng.integers(1, 300, 40)]
    near = texts[3].split() + words(rng, 80, 5000).split()
    texts += [texts[0], texts[0] + " tail", " ".join(near), " ".join(near[:-1]), "", "  \n ", None, "one", "one", "ONE", "a b c d", "A b c d", texts[5] + "\n" + texts[6], "x" * 500, "naïve ﬁ 東京  <|endoftext|> \t tab\n\nend", words(rng, 5000)]
    return [(i * 3, x, "en", f"s{i % 4}", 0) for i, x in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_token_ids_round_trip(spark, docs, rows, empty):
    from public_tokenizers import path

    shards = repair.write_ids(docs, Scratch(spark, "t"), shard_tokens=2000)
    got = {r["doc_id"]: r for r in repair.read_ids(shards).collect()}
    t, start = Tokenizer.from_file(path("word_bpe_49k.json")), 0
    for doc, text, *_ in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        r = got[doc]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    s = shards.collect()[0]
    whole = repair.Shard(s["base"], s["rules"], s["lengths"], s["symbols"], 2)
    every = whole.expand(whole.symbols)
    assert len(every) == s["n_tokens"] and (whole.read(17, 90) == every[17:90]).all()
    assert repair.read_ids(repair.write_ids(empty, Scratch(spark, "t"))).count() == 0


@pytest.mark.parametrize("bits", [20, 3])
def test_ranks_of_pairs_that_share_slots(monkeypatch, bits):
    monkeypatch.setattr(repair, "SLOT_BITS", bits)
    keys = np.random.default_rng(3).integers(0, 400, 5000).astype(np.uint32)
    for chosen in (np.arange(0, 400, 7, dtype=np.uint32)[::-1], np.zeros(0, np.uint32)):
        place = {int(k): i for i, k in enumerate(chosen)}
        got = repair.ranks_of(keys, repair.slots(keys), chosen)
        assert got.tolist() == [place.get(int(k), repair.NONE) for k in keys]


def test_rules_expand_to_what_was_compressed():
    ids = np.random.default_rng(5).choice([1, 2, 3, 4, repair.END], 20_000, p=[0.4, 0.3, 0.2, 0.09, 0.01]).astype(np.uint16)
    symbols, rules, lengths = repair.compress(ids, 10)
    pairs = np.stack([rules >> np.uint32(16), rules & np.uint32(0xFFFF)], 1).astype("<u2")
    shard = repair.Shard(10, pairs.tobytes(), lengths.astype("<u4").tobytes(), symbols.astype("<u2").tobytes(), 9)
    plain = {s: [9 if s == repair.END else s] for s in (1, 2, 3, 4, repair.END)}
    for r, (left, right) in enumerate(pairs.tolist()):
        plain[10 + r] = plain[left] + plain[right]
    assert len(symbols) < len(ids) / 2 and lengths.tolist() == [len(plain[10 + r]) for r in range(len(rules))]
    want = np.where(ids == repair.END, 9, ids)
    assert np.array_equal([x for s in symbols.tolist() for x in plain[s]], want)
    assert np.array_equal(shard.expand(shard.symbols), want) and np.array_equal(shard.read(777, 4321), want[777:4321])


@pytest.mark.parametrize("file", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_chunks_encode_as_the_whole_text(file):
    e = encoder(file)
    odd = ["It's we'll I'M NAÏVE Straße,,, Über... what?! a,b x'ſ Ĳ ǅ ﬁ cafe\u0301 é N° ª º µ ß ÿ. Ÿ 12a a12 a. 'tis can't! İstanbul", "ab" * 5000, " Ab, cd.. EF! gh?? 'll' ;;", "a\u00a0b", "<|endoftext|> x", "ÀÉ,\n\nb"]
    letters = np.array(list("aZéÉßøÿ,.!?'1 \n°\u0301ſ"))
    rng = np.random.default_rng(3)
    for text in [*odd, *("".join(rng.choice(letters, 60)) for _ in range(300))]:
        assert e.text(text.encode()) == e.one(text.encode()), text


def test_repeats(spark, docs, rows, empty):
    seen = set()
    got = {r["doc_id"]: r for r in suffix.remove_repeats(docs).collect()}
    for doc, text, *_ in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - 99):
            if raw[p : p + 100] in seen:
                gone[p : p + 100] = True
            seen.add(raw[p : p + 100])
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        r = got[doc]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    assert suffix.remove_repeats(empty).count() == 0
    twice = spark.createDataFrame([(1, "y" * 90 + "z" * 60), (1, "y" * 90 + "z" * 60), (None, "q" * 120)], "doc_id long, text string")
    assert sorted(r["n_removed"] for r in suffix.remove_repeats(twice).collect()) == [0, 0, 119]  # the run of q repeats itself one byte later


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


@pytest.mark.parametrize("small", [16, 1])
def test_jaccard(docs, rows, empty, monkeypatch, small):
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard, "BLOCK", 2)
    sets, up = {r[0]: shingles(r[1]) for r in rows}, {r[0]: r[0] for r in rows}

    def top(x):
        return x if up[x] == x else top(up[x])

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    got = jaccard.jaccard_components(docs).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {d: (len(s), top(d)) for d, s in sets.items()}
    kept = jaccard.keep_one(docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(d for d in sets if top(d) == d) and kept.columns == docs.columns
    assert jaccard.jaccard_components(empty).count() == 0


def test_star_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 40) if i % 10 != 9], "a long, b long").repartition(6)
    got = {r["node"]: r["component"] for r in jaccard.components(edges, Scratch(spark, "t"), "c", in_one_task=5).collect()}
    assert got == {i: i // 10 * 10 for i in range(40) if i % 10}


def test_edits(docs, rows, empty):
    e = encoder("byte_bpe_50k.json")
    got = {r["doc_id"]: r for r in edits.count_with_edits(docs, edits.digit_runs).collect()}
    for doc, text, *_ in rows:
        text = text or ""
        assert got[doc]["n_tokens"] == len(e.tokenizer.encode(text, add_special_tokens=False).ids)
        assert got[doc]["n_tokens_after"] == len(e.tokenizer.encode(edits.DIGITS.sub("0", text), add_special_tokens=False).ids)
    for text in (" ", "a", " a", "a ", " a b ", "a b\nc d", "a  b c", "a\n b c", "", "é\u2003b c", "x\u2003 y z"):
        at = [0, *(m.start() for m in edits.CUT.finditer(text)), len(text)]
        cut = [text[a:b] for a, b in zip(at, at[1:]) if b > a]
        assert edits.segments(text) == cut and len(edits.count_leaves(e, text.encode())) == len(cut), repr(text)
    text = "the cat  sat on\n the mat"
    some = edits.CountedText(text, e)
    assert some.apply([(4, 3, ""), (20, 3, "big  mat"), (5, 1, "no")]) == 2
    assert some.tree.total == len(e.tokenizer.encode(text[:4] + text[7:20] + "big  mat" + text[23:], add_special_tokens=False).ids)
    assert edits.count_with_edits(empty, edits.digit_runs).count() == 0


def test_batches_of_edits_follow_one_another():
    e, rng = encoder("byte_bpe_50k.json"), np.random.default_rng(11)
    letters = list("ab c \n  1é")
    for _ in range(60):
        text = "".join(rng.choice(letters, int(rng.integers(0, 60))))
        tree = edits.CountedText(text, e)
        for _ in range(6):
            some, at = [], 0
            while at <= len(text) and len(some) < 3:
                at += int(rng.integers(0, 12))
                n = int(rng.integers(0, 4))
                if at + n <= len(text):
                    some.append((at, n, "".join(rng.choice(letters, int(rng.integers(0, 7))))))
                at += n
            assert tree.apply(some) == len(some)
            for a, n, new in reversed(some):
                text = text[:a] + new + text[a + n :]
            assert tree.text == text and tree.counts == edits.count_leaves(e, text.encode())
            assert tree.tree.total == len(e.tokenizer.encode(text, add_special_tokens=False).ids) == sum(tree.counts)


def test_top_k(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(101)] + [(200, None), (201, [1.0] * 5 + [float("nan")]), (None, [9.0] * 6), (150, [0.5] * 6), (151, [0.5] * 6)]
    got = {}
    for r in topk.top_k(spark.createDataFrame(vectors, "vec_id long, embedding array<double>"), block_rows=20).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    ints = {i: [math.floor(256 * x) for x in v] for i, v in vectors if i is not None and v and all(map(math.isfinite, v))}
    for q in (0, 50, 100, 150):
        best = sorted(((-sum(a * b for a, b in zip(ints[q], v)), i) for i, v in ints.items() if i != q))[:5]
        assert sorted(got[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert len(got) == 4
    huge = [(0, [1e12, -3.0, 0.5]), (1, [2.0, 1.0, 1.0]), (2, [1e12, 1.0, 1.0]), (3, [1e300, 0.0, 0.0]), (4, [0.1, 0.2, 0.3])]  # scores that pass 64 bits are given as the nearest long
    got = [(r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(spark.createDataFrame(huge, "vec_id long, embedding array<double>")).collect()]
    q = [256 * 10**12, -768, 128]
    assert sorted(got) == [(1, 3, 2**63 - 1), (2, 2, 2**63 - 1), (3, 1, q[0] * 512 - 768 * 256 + 128 * 256), (4, 4, q[0] * 25 - 768 * 51 + 128 * 76)]
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


def test_segments():
    rng = np.random.default_rng(3)
    for _ in range(200):
        s = rng.integers(-3, 4, 12).astype(float)
        best = max([0.0, *(s[a:b].sum() for a in range(12) for b in range(a + 1, 13))])
        found = toxicity.maximal_segments(s)
        assert max([0.0, *(x for x, _, _ in found)]) == best and all(abs(s[a:b].sum() - x) < 1e-9 for x, a, b in found)
        assert all(b <= c for (_, _, b), (_, c, _) in zip(sorted(found, key=lambda x: x[1]), sorted(found, key=lambda x: x[1])[1:]))


def test_all_maximal_segments():
    """Against the definition: the best segment, then the same left and right of it."""

    def brute(s, at):
        best = max(((s[a:b].sum(), a, b) for a in range(len(s)) for b in range(a + 1, len(s) + 1)), default=(0, 0, 0))
        if best[0] <= 0:
            return []
        _, a, b = best
        return [*brute(s[:a], at), (at + a, at + b), *brute(s[b:], at + b)]

    rng = np.random.default_rng(8)
    for _ in range(300):
        s = rng.normal(size=int(rng.integers(0, 14)))
        assert sorted((a, b) for _, a, b in toxicity.maximal_segments(s)) == brute(s, 0)


def test_bins_of_plain_best_fit_decreasing():
    rng = np.random.default_rng(9)
    for _ in range(120):
        capacity = int(rng.integers(1, 30))
        lengths = rng.integers(1, capacity + 1, int(rng.integers(0, 60))).tolist()
        rooms: list[int] = []
        for x in sorted(lengths, reverse=True):
            fits = [r for r in rooms if r >= x]
            if fits:
                rooms[rooms.index(min(fits))] -= x
            else:
                rooms.append(capacity - x)
        plan = packing.best_fit_decreasing(dict(Counter(lengths)), capacity)
        made, ends = {}, sorted(plan)
        for i, (length, nth, first, offset) in enumerate(ends):
            stop = ends[i + 1][1] if i + 1 < len(ends) and ends[i + 1][0] == length else Counter(lengths)[length]
            for k in range(stop - nth):
                made.setdefault(first + k, []).append((offset, length))
        assert len(made) == len(rooms) and sum(map(len, made.values())) == len(lengths)
        for x in made.values():
            at = 0
            for offset, length in sorted(x):
                assert offset == at
                at += length
            assert at <= capacity


def test_toxicity(spark):
    rng = np.random.default_rng(4)
    rows = [(i, words(rng, 60) + (" vile filth scum" if i % 5 == 0 else ""), int(i % 5 == 0)) for i in range(400)] + [(900, None, 0), (901, "", 0)]
    docs = spark.createDataFrame([(a, b) for a, b, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(a, c) for a, _, c in rows] + [(None, 1), (3000, 1)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["toxic_score"] for r in toxicity.score_documents(docs, toxicity.train(docs, labels)).collect()}
    assert all((got[a] >= 0.5) == bool(c) for a, _, c in rows)
    none = toxicity.train(docs, labels.where("toxic = 0"))
    assert max(r["toxic_score"] for r in toxicity.score_documents(docs, none).collect()) < 0.5


def test_curve_is_fitted_on_the_evidence_that_is_scored():
    model = toxicity.Model({"vile": 2.0}, set(), lam=1.0, k=1.0)
    apart = " ".join(["vile " + "x " * 60] * 20)
    assert len(toxicity.maximal_segments(model.scores(apart.encode().split()))) == 20 and model.evidence(apart.encode())[1] == []
    texts = [apart, "vile " * 9 + apart, "x", "", None]
    batch = pa.RecordBatch.from_pydict({"toxic": [0, 1, 0, 0, 0], "text": texts})
    (out,) = toxicity.weigh_texts(model)(iter([batch]))
    assert out.column(1).to_pylist() == [model.evidence((x or "").encode())[0] for x in texts] and out.column(1)[0].as_py() < 0.1


def test_line_spread(spark):
    line = "the same boilerplate line"
    rows = [(i, f"own text of {i}\n {line}\nshort\n", f"site{i % 12}") for i in range(30)] + [(99, None, "site0"), (100, "", None), (101, line, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    every = {r["doc_id"]: r for r in linededup.drop_spread_lines(docs).collect()}
    assert all(every[i]["text"] == f"own text of {i}\n" and every[i]["n_removed"] == 2 for i in range(30))  # the short line too
    clashing = docs.withColumns({c: F.lit(5) for c in ("t", "d", "k", "where", "__t", "n_lines")})
    kept = linededup.drop_spread_lines(clashing).where("doc_id = 3").first()
    assert (kept["text"], kept["t"], kept["__t"], kept["where"], kept["n_lines"]) == (every[3]["text"], 5, 5, 5, 4)
    got = {r["doc_id"]: r for r in linededup.drop_spread_lines(docs, min_chars=10).collect()}
    assert all(got[i]["text"] == f"own text of {i}\nshort\n" and got[i]["n_removed"] == 1 for i in range(30))
    assert got[99]["text"] is None and got[99]["n_lines"] == 0 and got[100]["n_lines"] == 1 and got[101]["text"] == ""


def held(item, text):
    reader = decontam.Reader()
    return decontam.Item(item.encode(), reader).held_by(reader.read(text.encode()))


def test_leaks(spark):
    item = "A train leaves the town of Ulm at 9 and covers 120 km in 3 hours before the train from Ulm stops for 9 minutes"
    other = item.replace("Ulm", "Bonn").replace("120", "250").replace("9", "7").replace(" 3 ", " 4 ")
    wrong = item.replace("of Ulm", "of Bonn", 1).replace("120", "250")
    rng = np.random.default_rng(5)
    rows = [(1, f"{words(rng, 50)} {item} {words(rng, 20)}"), (2, f"{words(rng, 50)}. {other} {words(rng, 9)}"), (3, words(rng, 90)), (4, None), (5, ""), (6, item.lower())]
    got = {r["doc_id"]: r for r in decontam.mark_leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(7, item), (8, None), (9, "short one")], "item_id long, text string")).collect()}
    assert [got[i]["contaminated"] for i in range(1, 7)] == [True, True, False, False, False, True]
    assert got[1]["kind"] == "verbatim" and got[2]["kind"] == "re-parameterised" and got[1]["item_id"] == 7
    assert held(item, wrong) is None  # one value of a slot would stand for two


def test_leaks_of_odd_tables(spark):
    item = "the quick brown fox jumps over the lazy dog near a river bank in spring"
    docs = spark.createDataFrame([(1, item, 7), (1, item, 8), (None, item, 9), (2, "x y z", 1)], "doc_id long, text string, t long").withColumn("kind", F.lit("old"))
    bench = spark.createDataFrame([(5, item), (5, item), (None, item)], "item_id long, text string")
    got = decontam.mark_leaks(docs, bench)
    assert got.columns == ["doc_id", "text", "t", "contaminated", "item_id", "coverage", "kind"]
    assert sorted((r["t"], r["contaminated"], r["item_id"], r["kind"]) for r in got.collect()) == [(1, False, None, None), (7, True, 5, "verbatim"), (8, True, 5, "verbatim"), (9, True, 5, "verbatim")]
    assert decontam.mark_leaks(docs.limit(0), bench).count() == 0
    assert {r["contaminated"] for r in decontam.mark_leaks(docs, bench.limit(0)).collect()} == {False}


def test_leaks_against_every_pair(spark):
    """The windows' join finds what reading every item against every document finds."""
    rng = np.random.default_rng(12)
    items = [words(rng, int(n), 60) for n in rng.integers(3, 40, 25)]
    texts = [words(rng, int(n), 60) for n in rng.integers(0, 120, 40)]
    for i in range(0, 40, 3):
        piece = items[i % 25].split()
        texts[i] = " ".join([*texts[i].split()[:20], *piece[: max(1, len(piece) * int(rng.integers(5, 11)) // 10)], *texts[i].split()[20:]])
    reader, want = decontam.Reader(), {}
    for d, text in enumerate(texts):
        found = [(h[1] == "verbatim", h[0], -i) for i, item in enumerate(items) if (h := decontam.Item(item.encode(), reader).held_by(reader.read(text.encode())))]
        want[d] = (-max(found)[2], round(max(found)[1], 9)) if found else None
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = decontam.mark_leaks(docs, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()
    assert {r["doc_id"]: (r["item_id"], round(r["coverage"], 9)) if r["contaminated"] else None for r in got} == want
    assert sum(x is not None for x in want.values()) >= 4


def test_leaks_by_sentence_openers():
    item = "Alice buys 12 pens at 3 dollars each. Alice then sells 5 pens to Bob. How many pens are left with Alice now?"
    other = item.replace("Alice", "Mary").replace("Bob", "Tom").replace("12", "40").replace("3", "7").replace("5", "9")
    assert held(item, f"Some words before. {other} And some behind.") == (1.0, "re-parameterised")
    assert held(item, other.replace("Mary then", "Eve then")) is None  # Alice would stand for two


def test_leaks_by_values_of_other_lengths():
    item = "we know that in the year 1990 a man called Anna walked 5 km from the old city of Paris to the next town and then he came back with some bread for his wife and their young children at home"
    one = item.replace("Paris", "New York").replace("1990", "1812")
    more = one.replace("Anna", "Anna Maria").replace("5 km", "6km")
    for text in (one, more, more.replace("6km", "6")):
        assert held(item, f"a b {text} c d") == (1.0, "re-parameterised"), text
    longer = one.replace("New York", "Bad van der Berg").replace("1812", "1 812")  # no run of names: two offsets
    assert held(item, longer)[1] == "re-parameterised"
    twice = "the town of Ulm lies by a river and people in Ulm like to swim there"
    assert held(twice, twice.replace("Ulm", "New York"))[1] == "re-parameterised"
    assert held(twice, twice.replace("Ulm", "New York", 1).replace("Ulm", "Rome")) is None
    split = twice.replace("Ulm", "12 000")
    assert held(split, split.replace("12 000", "7500"))[1] == "re-parameterised"


def test_packing(docs, rows, empty):
    e = encoder("byte_bpe_50k.json")
    got = packing.pack(docs, capacity=256).toPandas()
    for doc, text, *_ in rows:
        ids = [*e.tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        mine = got[got.doc_id == doc].sort_values("piece")
        assert mine.length.sum() == len(ids) and mine.start.tolist() == [0, *mine.length.cumsum().tolist()[:-1]]
        assert all(zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes()) == c for s, n, c in zip(mine.start, mine.length, mine.ids_crc32))
        assert (mine.length.iloc[1:] == 256).all()
    for _, x in got.sort_values("offset").groupby("sequence_id"):
        assert x.offset.tolist() == [0, *x.length.cumsum().tolist()[:-1]] and x.length.sum() <= 256
    assert got.sequence_id.nunique() <= math.ceil(got.length.sum() / 256) + 1
    assert packing.pack(empty).count() == 0


def test_lattice(spark, docs, rows, empty):
    held = lattice.held_out("doc_id", 7, 2)
    got = {r["doc_id"]: r for r in lattice.score_corpus(docs, held, "lang").collect()}
    c = Counter()
    for doc, text, *_ in rows:
        if zlib.crc32(str(doc).encode()) % 7 != 2:
            c.update([*(text or "").encode().lower().split(), None])
    n, v = sum(c.values()), len(c)
    for doc, text, *_ in rows:
        tokens, r = [*(text or "").encode().lower().split(), None], got[doc]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(c[t] > 0 for t in tokens), n)
        assert math.isclose(r["base_score"], sum(math.log10((c[t] + 1) / (n + v + 1)) for t in tokens), rel_tol=1e-9)
        assert math.isfinite(r["score"]) and r["score"] < 0
    assert lattice.score_corpus(empty, held, "lang").count() == 0
    p = lattice.pieces("piece_bpe_32k.model")
    word = np.frombuffer(b"other", np.uint8).reshape(1, -1).astype(np.uint64)

    def spell(at, begins):
        if at == 5:
            return 1.0
        total = 0.0
        for j in range(at + 1, 6):
            raw = b"other"[at:j]
            h = np.array([lattice.hash_bytes(raw)], np.uint64)
            for index, ok, extra in ((p.begin, begins, 1.0), (p.go_on, True, math.exp(p.first[p.alone]) if begins else 1.0)):
                i = int(lattice.look_up(index, h)[0]) if ok else -1
                if i >= 0:
                    total += math.exp(p.first[i]) * extra * spell(j, False)
        return total

    assert math.isclose(lattice.forward(p, p.first[None], word)[0, 0], math.log(spell(0, True)), rel_tol=1e-9)


@pytest.mark.parametrize("text", ["international", "understanding", "населения", "internationalx", "reconfiguration"])
def test_lattice_holds_the_longest_pieces(text):
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    p, raw = lattice.pieces("piece_bpe_32k.model"), text.encode()
    known = {sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not sp.is_byte(i)}
    want = set()
    for i in range(len(raw)):
        for j in range(i + 1, len(raw) + 1):
            part = raw[i:j].decode("utf-8", "replace")
            want |= {(i, j, False)} if part in known and part.encode() == raw[i:j] or j == i + 1 else set()
            want |= {(i, j, True)} if i == 0 and f"▁{part}" in known else set()
    words = np.frombuffer(raw + b"z" * len(raw), np.uint8).reshape(2, -1).astype(np.uint64)
    got = [(i, j, begins) for i, j, ids, begins in lattice.arcs(p, words) if ids[0] >= 0]
    assert len(got) == len(set(got)) and set(got) == want and max(j - i for i, j, _ in got) > 12


def test_long_words_sum_as_short_ones(monkeypatch):
    p, rng = lattice.pieces("piece_bpe_32k.model"), np.random.default_rng(6)
    weights = np.stack([p.first, np.log(rng.dirichlet(np.ones(p.n)))])
    for raw in (b"internationalisation-of-understanding", bytes(rng.integers(97, 123, 150).astype(np.uint8)), b"a", "naseleniye населения".replace(" ", "").encode()):
        word = np.frombuffer(raw, np.uint8).reshape(1, -1).astype(np.uint64)
        times = np.array([[2.0], [3.0]])
        short = lattice.forward(p, weights, word), lattice.expected(p, weights, word, times)
        monkeypatch.setattr(lattice, "LONG", 0)
        long = lattice.forward(p, weights, word), lattice.expected(p, weights, word, times)
        monkeypatch.undo()
        assert np.allclose(short[0], long[0], rtol=1e-9) and np.allclose(short[1], long[1], rtol=1e-6, atol=1e-12)
    began = process_time()
    lattice.forward(p, weights, rng.integers(97, 123, (1, 20_000)).astype(np.uint64))
    assert process_time() - began < 10


def test_tasks_follow_counted_bytes(spark, docs, rows):
    """Neither rows made on the driver nor a join have statistics; a table of a few rows gets a few tasks all the same."""
    joined = docs.join(spark.range(1000).toDF("doc_id"), "doc_id")
    for d in (docs, joined):
        assert text_bytes(d) == sum(len((x or "").encode()) for _, x, *_ in rows)
        assert jaccard.buckets_for(d) == 4
    assert repair.write_ids(joined, Scratch(spark, "t")).select("part").distinct().count() == 1
    assert fits_broadcast(docs) and not fits_broadcast(docs, size=1000) and not fits_broadcast(docs, rows=3)


def test_line_rebuild_is_linear(spark):
    rows = [(i, "\n".join(["boiler"] + [f"line {j}" for j in range(n)]), f"s{i}") for i, n in enumerate([40_000, *[3] * 11])]
    got = linededup.drop_spread_lines(spark.createDataFrame(rows, "doc_id long, text string, source string"), min_sites=12).orderBy("doc_id").collect()
    assert got[0]["n_removed"] == 4 and got[0]["text"] == "\n".join(f"line {j}" for j in range(3, 40_000))
