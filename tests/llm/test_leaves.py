"""Leaves of a batch of texts, looked up together, against each segment encoded by itself."""

from quire.llm import edits, tokens


def test_leaves_of_a_batch():
    enc = tokens.encoder("byte_bpe_50k.json")
    texts = ["", " ", "\n", "a", "\na b\n", " a b", "a  b", "a b ", "é b c", "a\nb c's\n(x 12\n3", "<|endoftext|> a b", "a \n b", "12 34 '\n's", "a\n\nb", "a  b", "Zürich, Ärger! a.b a\nb a\nb"]
    want = [[len(enc.one(x.encode())) // 2 for x in edits.segments(t)] for t in texts]
    assert [x.tolist() for x in edits.leaves_of(enc, [t.encode() for t in texts])] == want
    assert [edits.count_leaves(enc, t.encode()) for t in texts] == want and edits.leaves_of(enc, []) == []
    assert [sum(x) for x in want] == [len(x) // 2 for x in enc.encode([t.encode() for t in texts])]
