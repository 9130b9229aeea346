"""Language-model scoring by cross-entropy difference.

Two bigram models, one of target documents and one of all documents, share one
vocabulary and one smoothing rule. A document's score is its mean loss per
token under the target model minus that under the background model: the lower,
the more it resembles the target.

Tokens are the words, A-Z in lower case and punctuation included, with a mark
before the first and behind the last. The vocabulary holds every word, known
by its 64-bit hash, as is every bigram; only a finite ``vocab_share`` makes the
words whose share of all tokens is below ``1 / vocab_share`` one unknown word.
With counts c and unigram estimates p1 (add-one over the vocabulary),
p(w | v) = (c(v, w) + mu p1(w)) / (c(v) + mu).

Texts are packed in chunks, kept as Parquet. A chunk sends each of its distinct
words and bigrams once, with its counts, to the bucket of its hash: hashes in
order, as differences in byte planes, compressed. A bucket sums the counts and
answers each chunk in the order of its request, so the answer names no key; the
chunk meets its answers and is scored. A frequent word is sent once by a chunk,
so no bucket grows with it. Losses are kept in whole micronats, so sums do not
depend on the order of rows.

Defined results: a null text or one without a token has no score (null); rows
that repeat an id are scored together as one document, rows without an id
likewise; with no target documents the target model is its smoothing prior;
target ids may repeat or be unknown; only the key and text columns are read;
an empty table gives an empty table. Texts of any length are scored whole.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm import words
from emporia.operators.joins import broadcast_if_small
from emporia.plans.session import ensure_checkpoint_dir

_TABLE = words.LOWER

# Reserved hashes: the unknown word, which is the row of the totals in the table of words, and the mark.
UNKNOWN, MARK = 0, 1
MICRO = 1_000_000
CHUNK_BYTES = 4 << 20     # text of a chunk
BUCKET_BYTES = 8 << 20    # text whose words and bigrams a bucket sums


@dataclass(frozen=True)
class ModelSpec:
    vocab_share: float = math.inf
    hot_share: int = 1 << 19     # without effect: frequent bigrams are counted like all others
    mu: float = 10.0
    alpha: float = 1.0


@dataclass
class Totals:
    """The number of different words, mark and unknown word included, and the (2,) numbers of tokens and marks: background,
    target."""

    size: int
    total: np.ndarray

    def losses(self, counts: np.ndarray, left: np.ndarray, right: np.ndarray, spec: ModelSpec) -> np.ndarray:
        """(2, n) micronats under both models, by (2, n) counts of the bigrams, their first and their second words."""
        p1 = (right + spec.alpha) / (self.total[:, None] + spec.alpha * self.size)
        p = (counts + spec.mu * p1) / (left + spec.mu)
        return np.rint(-np.log(p) * MICRO).astype(np.int64)


@dataclass
class Bigrams:
    """The distinct words and bigrams of a chunk's texts, by hash; texts without a word have none.

    ``left`` and ``right`` are places in ``known``; ``place[begin[i]:begin[i + 1]]`` are the bigrams of text ``i``.
    """

    known: np.ndarray
    tokens: np.ndarray
    keys: np.ndarray
    left: np.ndarray
    right: np.ndarray
    begin: np.ndarray
    place: np.ndarray


def _bigrams(w: words.Words, vocab: np.ndarray | None) -> Bigrams:
    """``vocab`` holds the sorted hashes of the words that are not the unknown one; without it all are known."""
    h, some = w.hashes(), w.counts > 0
    if vocab is not None:
        found = vocab[np.minimum(np.searchsorted(vocab, h), len(vocab) - 1)] == h if len(vocab) else np.zeros(len(h), dtype=bool)
        h = np.where(found, h, np.uint64(UNKNOWN))
    known, ids = np.unique(np.append(h, np.uint64(MARK)), return_inverse=True)
    mark = ids[-1]
    n = np.where(some, w.counts + 1, 0)
    begin = np.concatenate(([0], np.cumsum(n)))
    at = np.arange(begin[-1]) + np.repeat(w.first[:-1] - begin[:-1], n)       # token behind the pair's first
    is_first = np.zeros(begin[-1], dtype=bool)
    is_first[begin[:-1][some]] = True
    is_last = np.zeros(begin[-1], dtype=bool)
    is_last[begin[1:][some] - 1] = True
    left = np.where(is_first, mark, ids[at - 1])
    right = np.where(is_last, mark, ids[at])
    codes, place = np.unique(left * len(known) + right, return_inverse=True)
    left, right = np.divmod(codes, len(known))
    keys = _pair(known[left], known[right])
    order = np.argsort(keys)
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    return Bigrams(known, ids[:-1], keys[order], left[order], right[order], begin, rank[place])


def _pair(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """A hash of two words."""
    return words.mix(words.mix(v) + w)


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of 64-bit numbers; equal bytes of all numbers stand together, so small numbers take little room."""
    planes = [a.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes() for a in arrays]
    raw = np.array([len(a) for a in arrays], dtype="<i8").tobytes() + b"".join(planes)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(data: bytes, arrays: int) -> list[np.ndarray]:
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    out, at = [], 8 * arrays
    for n in np.frombuffer(raw, dtype="<i8", count=arrays).tolist():
        planes = np.frombuffer(raw, dtype=np.uint8, count=8 * n, offset=at).reshape(8, n)
        out.append(planes.T.reshape(-1).view("<u8"))
        at += 8 * n
    return out


_CHUNK = "size long, texts binary"


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of texts as compressed Arrow streams of ``CHUNK_BYTES``, one text at least."""
    for b in words.freed(batches):
        sizes = pc.fill_null(pc.binary_length(b.column("text")), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < b.num_rows:
            begin = int(ends[at - 1]) if at else 0
            end = max(at + 1, int(np.searchsorted(ends, begin + CHUNK_BYTES, "right")))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, b.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(b.slice(at, end - at))
            yield pa.RecordBatch.from_pydict({"size": pa.array([int(ends[end - 1]) - begin], pa.int64()),
                                              "texts": pa.array([sink.getvalue().to_pybytes()], pa.binary())})
            at = end


def _opened(texts: pa.Scalar) -> tuple[pa.RecordBatch, words.Words]:
    """The rows of a chunk and their words."""
    b = pa.ipc.open_stream(texts.as_buffer()).read_next_batch()
    _, _, w = next(words.chunks(b.column("text"), 1 << 62, table=_TABLE))
    return b, w


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in words.freed(batches):
        for x in b.column("texts"):
            _, w = _opened(x)
            h, n = np.unique(w.hashes(), return_counts=True)
            yield pa.RecordBatch.from_pydict({"h": pa.array(np.append(h, np.uint64(UNKNOWN)).view(np.int64)),
                                              "n": pa.array(np.append(n, len(w.starts)))})


def _bounds(keys: np.ndarray, buckets: int) -> list[int]:
    """Where the buckets of sorted hashes begin, and their end."""
    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    return np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64)).tolist()


_REQUEST = "bucket int, chunk long, words binary, pairs binary"


def _requests(batches: Iterator[pa.RecordBatch], vocab: np.ndarray | None, buckets: int) -> Iterator[pa.RecordBatch]:
    """A row per chunk and bucket: the distinct words and bigrams with their counts, and their counts in target texts."""
    for b in words.freed(batches):
        for chunk, texts in zip(b.column("chunk"), b.column("texts"), strict=True):
            rows, w = _opened(texts)
            target, some = rows.column("target").to_numpy(zero_copy_only=False).astype(bool), w.counts > 0
            found = _bigrams(w, vocab)
            mark = np.searchsorted(found.known, np.uint64(MARK))
            out = {"bucket": pa.array(range(buckets), pa.int32()), "chunk": pa.array([chunk.as_py()] * buckets, pa.int64())}
            for name, keys, at, flags in (("words", found.known, found.tokens, np.repeat(target, w.counts)),
                                          ("pairs", found.keys, found.place, np.repeat(target, np.diff(found.begin)))):
                n, t = np.bincount(at, minlength=len(keys)), np.bincount(at[flags], minlength=len(keys))
                if name == "words":
                    n[mark], t[mark] = some.sum(), (some & target).sum()
                ends = _bounds(keys, buckets)
                out[name] = pa.array([_packed(np.diff(keys[lo:hi], prepend=np.uint64(0)), n[lo:hi], t[lo:hi])
                                      for lo, hi in zip(ends, ends[1:], strict=False)], pa.binary())
            yield pa.RecordBatch.from_pydict(out)


_ANSWER = "bucket int, chunk long, words binary, pairs binary, size long, n long, t long"


def _summed(requests: pa.ChunkedArray) -> tuple[np.ndarray, list[np.ndarray], list[bytes]]:
    """Distinct keys of a bucket, their two counts, and for each request the counts of its keys."""
    parts = [_unpacked(x.as_py(), 3) for x in requests]
    some, at = np.unique(np.concatenate([np.cumsum(d, dtype=np.uint64) for d, _, _ in parts]), return_inverse=True)
    sums = [np.bincount(at, weights=np.concatenate([p[k] for p in parts]), minlength=len(some)).astype(np.int64) for k in (1, 2)]
    ends = np.cumsum([0, *(len(d) for d, _, _ in parts)]).tolist()
    del parts
    return some, sums, [_packed(*(s[at[lo:hi]] for s in sums)) for lo, hi in zip(ends, ends[1:], strict=False)]


def _answers(requests: pa.Table) -> pa.Table:
    """The requests of a bucket answered; its first row has the number of its words and of their occurrences, marks included."""
    _, _, pairs = _summed(requests.column("pairs"))
    known, (n, t), found = _summed(requests.column("words"))
    once = lambda x: pa.array([int(x), *[0] * (requests.num_rows - 1)], pa.int64())
    return pa.table({"bucket": requests.column("bucket"), "chunk": requests.column("chunk"),
                     "words": pa.array(found, pa.binary()), "pairs": pa.array(pairs, pa.binary()),
                     "size": once((~np.isin(known, [UNKNOWN, MARK])).sum()), "n": once(n.sum()), "t": once(t.sum())})


_SCORED = "doc_id long, n long, loss_b long, loss_t long"


def _score(chunk: pa.Table, answers: pa.Table, vocab: np.ndarray | None, totals: Totals, spec: ModelSpec) -> pa.Table:
    """Per text of a chunk the number of its bigrams and the sums of their losses."""
    rows, w = _opened(chunk.column("texts")[0])
    found = _bigrams(w, vocab)
    answers = answers.sort_by("bucket")
    counts = {}
    for name in ("words", "pairs"):
        parts = [_unpacked(x.as_py(), 2) for x in answers.column(name)]
        counts[name] = np.stack([np.concatenate([p[k] for p in parts]) for k in range(2)]).astype(np.int64)
    loss = totals.losses(counts["pairs"], counts["words"][:, found.left], counts["words"][:, found.right], spec)
    sums = []
    for m in range(2):
        total = np.concatenate(([0], np.cumsum(loss[m][found.place])))
        sums.append(total[found.begin[1:]] - total[found.begin[:-1]])
    return pa.table({"doc_id": rows.column("doc_id"), "n": pa.array(np.diff(found.begin), pa.int64()),
                     "loss_b": pa.array(sums[0], pa.int64()), "loss_t": pa.array(sums[1], pa.int64())})


def score(docs: DataFrame, target_ids: DataFrame, spec: ModelSpec = ModelSpec()) -> DataFrame:
    """doc_id, n_tokens (marks not counted), loss_target, loss_background (nats per token) and score for every document.

    ``target_ids`` has a column doc_id. The losses are means over the document's tokens and its end mark.
    """
    spark = docs.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/lm-{uuid.uuid4().hex}"
    target = target_ids.select(F.col("doc_id").cast("bigint").alias("_id")).filter("_id is not null").distinct()
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marked = (rows.join(broadcast_if_small(target, 1 << 20), F.col("doc_id") == F.col("_id"), "left")
              .select("doc_id", "text", F.col("_id").isNotNull().alias("target")))

    def saved(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    chunks = saved(marked.mapInArrow(_chunks, _CHUNK).withColumn("chunk", F.monotonically_increasing_id()), "chunks")
    vocab = None
    if math.isfinite(spec.vocab_share):
        counted = saved(chunks.select("texts").mapInArrow(_count_words, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")),
                        "words")
        tokens = counted.filter(F.col("h") == UNKNOWN).agg(F.sum("n")).first()[0] or 0
        frequent = counted.filter((F.col("h") != UNKNOWN) & (F.col("n") * spec.vocab_share >= tokens))
        vocab = np.sort(frequent.select("h").toPandas()["h"].to_numpy(dtype=np.int64).view(np.uint64))  # vocab_share rows at most
    known = spark.sparkContext.broadcast(vocab)
    buckets = max(1, math.ceil((chunks.agg(F.sum("size")).first()[0] or 0) / BUCKET_BYTES))
    requests = chunks.select("chunk", "texts").mapInArrow(lambda it: _requests(it, known.value, buckets), _REQUEST)
    answers = saved(requests.groupBy("bucket").applyInArrow(_answers, _ANSWER), "answers")
    size, n, t = (x or 0 for x in answers.agg(F.sum("size"), F.sum("n"), F.sum("t")).first())
    totals = Totals(size + 2, np.array([n, t]))
    scored = chunks.select("chunk", "texts").groupBy("chunk").cogroup(
        answers.select("chunk", "bucket", "words", "pairs").groupBy("chunk")).applyInArrow(
        lambda a, b: _score(a, b, known.value, totals, spec), _SCORED)
    summed = scored.groupBy("doc_id").agg(
        F.sum("n").alias("_n"), F.sum("loss_b").alias("loss_b"), F.sum("loss_t").alias("loss_t"),
        F.sum((F.col("n") > 0).cast("long")).alias("_texts"))
    mean = lambda c: F.when(F.col("_n") > 0, F.col(c) / F.col("_n") / float(MICRO))
    return summed.select("doc_id", (F.col("_n") - F.col("_texts")).alias("n_tokens"), mean("loss_t").alias("loss_target"),
                         mean("loss_b").alias("loss_background"),
                         F.when(F.col("_n") > 0, (F.col("loss_t") - F.col("loss_b")) / F.col("_n") / float(MICRO)).alias("score"))
