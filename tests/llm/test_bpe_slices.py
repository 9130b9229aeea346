"""Encoding takes small slices of a batch, and its ids are never Python numbers."""

import pyarrow as pa

from emporia.llm import bpe


def test_a_batch_is_encoded_in_small_slices():
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(64)), "text": ["word " * 20_000] * 64})
    parts = list(bpe._slices(batch))
    assert sum(p.num_rows for p in parts) == 64 and max(p.nbytes for p in parts) <= 2 << 20


def test_id_lists_of_entries():
    entries = [[("7 12", "a b", 2), ("", "", 0), ("3", "c", 1)], [], [("", "", 0)], [("40000", "d", 1)]]
    got = bpe._id_lists(entries)
    assert got.type == pa.list_(pa.int32()) and got.to_pylist() == [[7, 12, 3], [], [], [40000]]
    assert bpe._id_lists([]).to_pylist() == []


def test_a_full_memo_keeps_what_is_met_again(monkeypatch):
    learned, v = [], bpe.Vocabulary.load(bpe.default_path())
    monkeypatch.setattr(bpe, "MEMO_BYTES", 20_000)
    encoder = bpe.Encoder(v)
    learn = encoder.learn
    monkeypatch.setattr(encoder, "learn", lambda new: (learned.extend(new), learn(new)))
    for i in range(40):
        encoder.encode(["often often " + " ".join(f"w{chr(97 + i // 26)}{chr(97 + i % 26)}x{chr(97 + k)}" for k in range(20))])
    assert learned.count("often") == 1 and len(learned) == 801
    assert len(encoder.memo) + len(encoder.older) < 300


def test_words_are_merged_in_small_arrays(monkeypatch):
    sizes, merge = [], bpe.merge_rows
    monkeypatch.setattr(bpe, "merge_rows", lambda sym, v: (sizes.append(sym.size), merge(sym, v))[1])
    encoder = bpe.Encoder(bpe.Vocabulary.load(bpe.default_path()))
    encoder.encode([" ".join(f"{'ab' * 20}{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)}" for k in range(3000))])
    assert 0 < max(sizes) <= 1 << 17
