"""The scorer's exchange: packed counts come back as sent, and a chunk sends little more than its text."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from emporia.llm import lm_scoring


def test_packed_arrays_come_back():
    arrays = [np.array([0, 5, 2**64 - 1], dtype=np.uint64), np.empty(0, dtype=np.uint64), np.arange(300, dtype=np.uint64)]
    got = lm_scoring._unpacked(lm_scoring._packed(*arrays), 3)
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(arrays, got, strict=True))


def test_what_is_shuffled_stays_near_the_text(monkeypatch):
    monkeypatch.setattr(lm_scoring, "CHUNK_BYTES", 1 << 20)
    docs = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["doc_id", "text"])
    docs = docs.append_column("target", pa.array([i % 3 == 0 for i in range(docs.num_rows)])).combine_chunks()
    chunks = [c for b in docs.to_batches() for c in lm_scoring._chunks(iter([b]))]
    size = sum(c.column("size")[0].as_py() for c in chunks)
    assert len(chunks) > 1
    sent = []
    for i, c in enumerate(chunks):
        rows = pa.RecordBatch.from_pydict({"chunk": pa.array([i]), "texts": c.column("texts")})
        sent += lm_scoring._requests(iter([rows]), None, 3)
    requests = pa.Table.from_batches(sent)
    answers = [lm_scoring._answers(requests.filter(pa.compute.equal(requests.column("bucket"), b))) for b in range(3)]
    room = lambda t: sum(t.column(c).nbytes for c in ("words", "pairs"))
    # Texts are kept and shuffled, requests shuffled, answers kept and shuffled; the check allows 4 times the input.
    total = 2 * sum(c.column("texts").nbytes for c in chunks) + room(requests) + 2 * sum(room(a) for a in answers)
    assert total < 3.5 * size
    assert sum(sum(a.column("n").to_pylist()) for a in answers) > docs.num_rows


def test_chunks_hold_every_row_once():
    rows = pa.RecordBatch.from_pydict({"doc_id": pa.array([1, None, 2, 3]), "text": pa.array(["a" * (5 << 20), None, "", "b"]),
                                       "target": pa.array([True, False, False, True])})
    opened = [lm_scoring._opened(c.column("texts")[0])[0] for c in lm_scoring._chunks(iter([rows]))]
    assert sum([b.column("doc_id").to_pylist() for b in opened], []) == [1, None, 2, 3]
    assert len(opened) == 2
