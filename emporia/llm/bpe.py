"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

The leaves of a word's tree hold the merge rank of each adjacent symbol pair,
joined with its position, so the root yields the leftmost pair of lowest rank.
A merge changes three leaves; each change climbs to the root in a logarithmic
number of steps; a word is done when its root is empty. Short words are merged
many at a time (one tree per row of a numpy array), long ones one by one with
the same tree in a list.

The vocabulary file is read on the driver (its size is fixed) and broadcast.
Words recur, so each task keeps a bounded memo of encoded words. Batches are
encoded in small slices, and what a slice has freed is given back at once.

Defined results: a null text is an empty text and has no tokens; only the key
and text columns are read, so other columns may have any names; equal rows get
equal results; an empty table gives an empty table; a text or word of any
length is encoded whole.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm import words

NONE = np.iinfo(np.int64).max
MEMO_WORDS = 1 << 19
MEMO_BYTES = 24 << 20     # of the memo's newer words, by estimate; the older ones take as much at most
ROW_SYMBOLS = 64     # longer words take the one-by-one path
MERGED_SYMBOLS = 1 << 17  # symbols of the words merged at once
SLICE_BYTES = 1 << 19     # text encoded at once: its words are objects, many times the size of the text


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    at = set(shown)
    return [chr(b) if b in at else chr(next(hidden)) for b in range(256)]


@dataclass
class Vocabulary:
    """A word-level BPE vocabulary: ids, merge ranks, the splitting pattern and the special tokens."""

    tokens: list[str]
    inner: np.ndarray          # id of each byte inside a word
    final: np.ndarray          # id of each byte that ends a word
    pair_keys: np.ndarray      # sorted left * size + right
    pair_ranks: np.ndarray
    merged: np.ndarray         # rank -> id of the merged symbol
    specials: dict[str, int]
    pattern: str

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """Read a tokenizer file with NFC, lower case, pattern split and byte-level symbols."""
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, vocab = spec["model"], spec["model"]["vocab"]
        specials = {x["content"]: x["id"] for x in spec["added_tokens"]}
        size = max([*vocab.values(), *specials.values()]) + 1
        tokens = [""] * size
        for token, i in [*vocab.items(), *specials.items()]:
            tokens[i] = token
        end, symbols = model["end_of_word_suffix"] or "", byte_symbols()
        merges = [x if isinstance(x, list) else x.split(" ") for x in model["merges"]]
        keys = np.array([vocab[a] * size + vocab[b] for a, b in merges], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        pattern = next(x["pattern"]["Regex"] for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        return cls(tokens, np.array([vocab[s] for s in symbols]), np.array([vocab[s + end] for s in symbols]),
                   keys[order], order.astype(np.int64), np.array([vocab[a + b] for a, b in merges], dtype=np.int64),
                   specials, pattern.replace(r"\s", r"\p{White_Space}"))

    @property
    def size(self) -> int:
        return len(self.tokens)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, NONE where there is no merge (or a side is missing, id < 0)."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        ok = (self.pair_keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(ok, self.pair_ranks[at], NONE)


def merge_rows(sym: np.ndarray, vocab: Vocabulary) -> np.ndarray:
    """Merge many words at once; ``sym`` is (words, leaves), -1 after a word's end and for symbols merged away."""
    n, leaves = sym.shape
    width = leaves.bit_length() - 1
    sym = np.concatenate([sym, np.full((n, 1), -1)], axis=1)      # one missing symbol behind the last
    after = np.tile(np.arange(1, leaves + 2), (n, 1))
    after[:, -1] = leaves
    before = np.tile(np.arange(-1, leaves), (n, 1))
    before[:, 0] = leaves
    tree = np.full((n, 2 * leaves), NONE, dtype=np.int64)
    rank = vocab.ranks(sym[:, :-1], sym[:, 1:])
    tree[:, leaves:] = np.where(rank == NONE, NONE, (rank << width) | np.arange(leaves))
    for level in range(width - 1, -1, -1):
        a = tree[:, 2 << level:4 << level]
        tree[:, 1 << level:2 << level] = np.minimum(a[:, ::2], a[:, 1::2])
    rows = np.arange(n)
    while True:
        root = tree[rows, 1]
        rows, root = rows[root != NONE], root[root != NONE]
        if not len(rows):
            return sym[:, :-1]
        i, new = root & (leaves - 1), vocab.merged[root >> width]
        j = after[rows, i]
        k, p = after[rows, j], before[rows, i]
        sym[rows, i], sym[rows, j] = new, -1
        after[rows, i] = k
        before[rows, k] = np.where(k < leaves, i, before[rows, k])
        right = vocab.ranks(new, sym[rows, k])
        left = np.where(p < leaves, vocab.ranks(sym[rows, p], new), NONE)
        p = np.where(p < leaves, p, i)                               # no left neighbour: the same leaf again
        left = np.where(p == i, right, left)
        for leaf, value in ((j, np.full(len(rows), NONE)), (i, right), (p, left)):
            at = leaves + leaf
            tree[rows, at] = np.where(value == NONE, NONE, (value << width) | leaf)
            for _ in range(width):
                at >>= 1
                tree[rows, at] = np.minimum(tree[rows, 2 * at], tree[rows, 2 * at + 1])


def merge_long(symbols: list[int], vocab: Vocabulary) -> list[int]:
    """Merge one word of any length."""
    n = len(symbols)
    leaves = 1 << max(1, (n - 1).bit_length())
    sym, width = list(symbols), leaves.bit_length() - 1
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    keys, ranks, size = vocab.pair_keys, vocab.pair_ranks, vocab.size
    known: dict[int, int] = {}

    def leaf(i: int, j: int) -> int:
        if i < 0 or j >= n:
            return NONE
        key = sym[i] * size + sym[j]
        rank = known.get(key)
        if rank is None:
            at = int(np.searchsorted(keys, key))
            rank = known[key] = int(ranks[at]) if at < len(keys) and keys[at] == key else -1
        return NONE if rank < 0 else rank << width | i

    tree = [NONE] * (2 * leaves)
    for i in range(n - 1):
        tree[leaves + i] = leaf(i, i + 1)
    for at in range(leaves - 1, 0, -1):
        tree[at] = min(tree[2 * at], tree[2 * at + 1])

    def put(i: int, value: int) -> None:
        at = leaves + i
        tree[at] = value
        while at > 1:
            at >>= 1
            low = min(tree[2 * at], tree[2 * at + 1])
            if tree[at] == low:
                return
            tree[at] = low

    while tree[1] != NONE:
        i, rank = tree[1] & (leaves - 1), tree[1] >> width
        j = after[i]
        sym[i], sym[j] = int(vocab.merged[rank]), -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        put(j, NONE)
        put(i, leaf(i, after[i]))
        if before[i] >= 0:
            put(before[i], leaf(before[i], i))
    return [x for x in sym if x >= 0]


LATIN = 0x250


def latin_pattern(pattern: str) -> str:
    """The splitting pattern with its character classes spelled out for characters below ``LATIN``.

    The plain regular expression module then takes texts that hold no others,
    several times faster than the one with Unicode properties.
    """
    def spelled(test) -> str:
        return "".join(rf"\u{c:04x}" for c in range(LATIN) if test(chr(c)))

    letters = spelled(lambda c: unicodedata.category(c)[0] == "L")
    numbers = spelled(lambda c: unicodedata.category(c)[0] == "N")
    blanks = spelled(lambda c: regex.match(r"\p{White_Space}", c))
    return (pattern.replace(r"\p{L}", letters).replace(r"[\p{N}]", f"[{numbers}]").replace(r"\p{N}", numbers)
            .replace(r"\p{White_Space}", blanks))


class Encoder:
    """Encodes texts in a task; keeps the words seen, up to a bound.

    When ``memo`` is full it becomes ``older``, whose words come back as they
    are met again; so frequent words are encoded once, rare ones are dropped.
    """

    def __init__(self, vocab: Vocabulary, memo_words: int = MEMO_WORDS):
        self.vocab, self.bound = vocab, memo_words
        self.decimal = [str(i) for i in range(vocab.size)]
        self.find = regex.compile(vocab.pattern).findall
        self.find_latin = re.compile(latin_pattern(vocab.pattern)).findall
        self.beyond_latin = re.compile(rf"[^\x00-\u{LATIN - 1:04x}]").search
        marks = "|".join(regex.escape(x) for x in sorted(vocab.specials, key=len, reverse=True))
        self.cut = regex.compile(f"({marks})").split if marks else None
        self.special = {x: self._entry([i]) for x, i in vocab.specials.items()}
        self.memo: dict[str, tuple] = {}
        self.older: dict[str, tuple] = {}
        self.memo_bytes = 0

    def _entry(self, ids: list[int]) -> tuple:
        """(decimal ids, decoded tokens, number of ids): what a word adds to a text."""
        names, tokens = self.decimal, self.vocab.tokens
        return " ".join([names[i] for i in ids]), " ".join([tokens[i] for i in ids]), len(ids)

    def words(self, text: str) -> list[str]:
        """The words of a text after NFC and lower case; special tokens stay as they are."""
        parts = self.cut(text) if self.cut and "<" in text else [text]
        out: list[str] = []
        for i, part in enumerate(parts):
            if i % 2:
                out.append(part)
            elif part:
                part = part if part.isascii() else unicodedata.normalize("NFC", part)
                if "Σ" in part:       # lower-cased by character, without the final form
                    part = part.replace("Σ", "σ")
                part = part.lower()
                out += self.find(part) if self.beyond_latin(part) else self.find_latin(part)
        return out

    def learn(self, new: list[str]) -> None:
        """Encode words that the memo lacks."""
        v = self.vocab
        raw = [w.encode("utf-8", "surrogatepass") for w in new]
        size = np.array([len(x) for x in raw])
        for leaves in (2, 4, 8, 16, 32, ROW_SYMBOLS):
            group = np.flatnonzero((size <= leaves) & (size > (leaves // 2 if leaves > 2 else 0)))
            for lo in range(0, len(group), MERGED_SYMBOLS // leaves):
                part = group[lo:lo + MERGED_SYMBOLS // leaves]
                lens = size[part]
                flat = np.frombuffer(b"".join([raw[i] for i in part]), dtype=np.uint8)
                at = np.arange(leaves) < lens[:, None]
                sym = np.full(at.shape, -1, dtype=np.int64)
                sym[at] = v.inner[flat]
                last = np.cumsum(lens) - 1
                sym[np.arange(len(part)), lens - 1] = v.final[flat[last]]
                done = merge_rows(sym, v)
                alive = done >= 0
                ids, counts = done[alive].tolist(), alive.sum(axis=1).tolist()
                at = 0
                for i, k in zip(part.tolist(), counts, strict=True):
                    self.memo[new[i]] = self._entry(ids[at:at + k])
                    at += k
        for i in np.flatnonzero(size > ROW_SYMBOLS).tolist():
            symbols = v.inner[list(raw[i])].tolist()
            symbols[-1] = int(v.final[raw[i][-1]])
            self.memo[new[i]] = self._entry(merge_long(symbols, v))

    def encode(self, texts: list[str | None]) -> list[list[tuple]]:
        """The entries of each text's words."""
        split = [self.words(x) if x else [] for x in texts]
        new = set().union(*split) - self.memo.keys()
        if len(self.memo) + len(new) > self.bound or self.memo_bytes > MEMO_BYTES:
            self.memo, self.older, self.memo_bytes = dict(self.special), self.memo, 0
            new = set().union(*split) - self.memo.keys()
        self.memo.update(self.special)
        new -= self.special.keys()
        # A word, its ids and its tokens, each an object with a head.
        self.memo_bytes += sum([320 + 4 * len(w) for w in new])
        known = new & self.older.keys()
        self.memo.update([(w, self.older.pop(w)) for w in known])
        new -= known
        if new:
            self.learn(sorted(new))
        get = self.memo.__getitem__
        return [[get(w) for w in x] for x in split]


_COLUMNS = {"n_tokens": "bigint", "ids": "array<int>", "decoded": "string", "ids_sha256": "string",
            "decoded_sha256": "string"}


def encode_decode(docs: DataFrame, path: str, outputs: tuple[str, ...] = ("n_tokens", "ids", "decoded"),
                  key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode each text and decode its ids again: ``key`` and the asked outputs.

    ``ids`` are the token ids, ``decoded`` the tokens of the ids joined by one
    space (the vocabulary names no decoder); the digests are lower-case hex
    SHA-256 of the decimal ids joined by one space, and of ``decoded``.
    """
    unknown = set(outputs) - set(_COLUMNS)
    if unknown:
        raise ValueError(f"no such outputs: {sorted(unknown)}")
    tables = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(path))
    names = list(outputs)

    def encoded(part: pa.RecordBatch, encoder: Encoder) -> pa.RecordBatch:
        rows = encoder.encode(part.column(1).to_pylist())
        out = {key: part.column(0)}
        if "n_tokens" in names:
            out["n_tokens"] = pa.array([sum([e[2] for e in r]) for r in rows], pa.int64())
        if "ids" in names:
            out["ids"] = _id_lists(rows)
        if "ids_sha256" in names:
            out["ids_sha256"] = pa.array([_sha([e[0] for e in r]) for r in rows], pa.string())
        if "decoded" in names:
            out["decoded"] = pa.array([" ".join([e[1] for e in r]) for r in rows], pa.string())
        if "decoded_sha256" in names:
            out["decoded_sha256"] = pa.array([_sha([e[1] for e in r]) for r in rows], pa.string())
        return pa.RecordBatch.from_pydict({k: out[k] for k in [key, *names]})

    def run(batches):
        encoder = Encoder(tables.value)
        for part in words.freed(part for b in batches for part in _slices(b)):
            yield encoded(part, encoder)

    kind = dict(docs.dtypes)[key]
    schema = ", ".join([f"`{key}` {kind}", *(f"{x} {_COLUMNS[x]}" for x in names)])
    return docs.select(F.col(key), F.col(text).cast("string")).mapInArrow(run, schema)


def decode(frame: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Token ids back to text, as ``encode_decode`` does it; null ids give null, unknown ids an error."""
    tables = frame.sparkSession.sparkContext.broadcast(Vocabulary.load(path))

    def run(batches):
        tokens = tables.value.tokens
        for b in words.freed(batches):
            text = [None if x is None else " ".join([tokens[i] for i in x]) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({key: b.column(0), "decoded": pa.array(text, pa.string())})

    return frame.select(key, ids).mapInArrow(run, f"`{key}` {dict(frame.dtypes)[key]}, decoded string")


def _sha(parts: list[str]) -> str:
    return hashlib.sha256(" ".join(parts).encode("utf-8", "surrogatepass")).hexdigest()


def _id_lists(rows: list[list[tuple]]) -> pa.Array:
    """The ids of each text, from its words' entries; no number becomes a Python object."""
    counts = [sum([e[2] for e in r]) for r in rows]
    ends = np.cumsum([0, *counts], dtype=np.int32)
    parts = [np.fromstring(" ".join([e[0] for e in r]), dtype=np.int32, sep=" ") for r, n in zip(rows, counts, strict=True) if n]
    ids = np.concatenate(parts) if parts else np.empty(0, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))


def _slices(b: pa.RecordBatch, target: int = SLICE_BYTES):
    """Parts of a batch with about ``target`` bytes of text, one row at least."""
    rows = max(1, int(b.num_rows * target / max(b.nbytes, 1)))
    for at in range(0, b.num_rows, rows):
        yield b.slice(at, rows)


def default_path() -> str:
    """The place of the word-level vocabulary among the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")

