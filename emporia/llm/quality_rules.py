"""Quality rules, line first.

Every line is judged on its own: punctuation, navigation and boilerplate rules.
Failing lines are removed, and a document that loses too much of its text in
this way is rejected. Five document measures (the base rules) are returned
beside the verdict.

Defined results: a null or empty text has no words and fails the base rules;
equal rows get equal results; only ``doc_id`` and ``text`` are read (other
columns, whatever their names, are ignored or passed through); an empty table
gives an empty table. Texts of any length are handled whole.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm import words

SCHEMA = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
          "n_repeat_words bigint, base_failed boolean, kept boolean, n_lines bigint, n_bad_lines bigint, "
          "n_lost_words bigint")

WINDOW = 5
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True

# Phrases of page furniture, lower case.
BOILERPLATE = (
    "all rights reserved", "copyright", "cookie", "terms of use", "terms of service", "privacy policy", "javascript",
    "lorem ipsum", "sign in", "log in", "subscribe to", "click here", "powered by")

# Ends of other scripts need no space behind them.
_WIDE_ENDS = "\u2026\u3002\uff01\uff1f\uff1a\uff1b\uff0e\uff61\u0964\u0965\u061f\u06d4"
_CLOSING = "\"')]\u201d\u2019\u00bb\u203a\u300d\u300f\uff09"
_SENTENCE_END = re.compile(rb"[.!?:;](?:%s)*(?=[\x20\x09-\x0D]|$)|%s" % tuple(
    b"|".join(re.escape(c.encode()) for c in x) for x in (_CLOSING, _WIDE_ENDS)))
_INSIDE = rb"[A-Za-z0-9\x80-\xff]"
_BOILERPLATE = re.compile(rb"(?<!%s)(?:%s)s?(?!%s)" % (_INSIDE, b"|".join(re.escape(x.encode()) for x in BOILERPLATE), _INSIDE))


@dataclass(frozen=True)
class LineRules:
    """Thresholds; shares are of a line's words (of a document's for ``max_lost``)."""

    sentence_end: bool = True        # a line without any sentence end fails
    max_shout: float = 0.5           # share of words ending in ! or ?
    min_shout_words: int = 6
    max_bare: float = 0.25           # share of words without a letter or digit (menu separators, ornaments)
    min_bare_words: int = 4
    max_symbols: float = 0.1         # share of symbol bytes in the line's bytes
    max_furniture: float = 0.1       # share of words in phrases of page furniture
    max_lost: float = 0.5            # share of a document's words that may go


def bad_line(line: bytes, n: int, rules: LineRules, seen: set) -> bool:
    """Does a line with ``n`` > 0 words fail? Punctuation, navigation, boilerplate, in this order."""
    if rules.sentence_end and not _SENTENCE_END.search(line):
        return True
    marks = line.count(b"!") + line.count(b"?")
    if n >= rules.min_shout_words and marks > rules.max_shout * n:
        parts = line.split()
        if sum(w.endswith((b"!", b"?")) for w in parts) > rules.max_shout * n:
            return True
    symbols = len(line) - len(line.translate(None, b"#*$%&|<>"))
    if symbols > rules.max_symbols * len(line):
        return True
    if symbols and n >= rules.min_bare_words:
        parts = line.split()
        if sum(not w.strip(b"#*$%&|<>-+=~_/\\.,:;") for w in parts) > rules.max_bare * n:
            return True
    if line in seen:
        return True
    return sum(len(x.split()) for x in _BOILERPLATE.findall(line.lower())) > rules.max_furniture * n


def _judge(column, rules: LineRules, with_text: bool):
    """Measures of a batch's texts, in order; cleaned texts too if asked for."""
    cols: dict[str, list] = {k: [] for k in ("n_words", "word_chars", "n_symbols", "n_repeat_words", "n_dup_lines",
                                            "n_lines", "n_bad_lines", "n_lost_words")}
    texts: list[bytes] = []
    for at, end, w in words.chunks(column):
        n = end - at
        cols["n_words"].append(w.counts)
        cols["word_chars"].append(w.per_text(w.inside & ((w.data & 0xC0) != 0x80)))
        cols["n_symbols"].append(w.per_text(_SYMBOL[w.data]))
        cols["n_repeat_words"].append(_repeat_words(w))
        rows = np.zeros((4, n), dtype=np.int64)
        for i in range(n):
            text = w.text(i)
            seen: set[bytes] = set()
            kept = []
            for line in text.split(b"\n"):
                k = len(line.split())
                if not k:
                    kept.append(line)
                    continue
                bad = bad_line(line, k, rules, seen)
                rows[:, i] += (line in seen, 1, bad, k if bad else 0)
                seen.add(line)
                if not bad:
                    kept.append(line)
            if with_text:
                texts.append(b"\n".join(kept))
        for name, row in zip(("n_dup_lines", "n_lines", "n_bad_lines", "n_lost_words"), rows, strict=True):
            cols[name].append(row)
    out = {k: np.concatenate(v).astype(np.int64) if v else np.empty(0, dtype=np.int64) for k, v in cols.items()}
    out["base_failed"] = (out["n_words"] < 10) | (100 * out["n_repeat_words"] > 20 * out["n_words"])
    out["kept"] = ~out["base_failed"] & (out["n_lost_words"] <= rules.max_lost * out["n_words"])
    return out, texts


def _repeat_words(w: words.Words) -> np.ndarray:
    """Per text, the words covered by 5-word windows that it holds at least twice."""
    at, h = w.windows(w.hashes(), WINDOW)
    cover = np.zeros(len(w.starts) + 1, dtype=np.int64)
    if len(at):
        owner = w.owner()[at].astype(np.uint64)
        key = h ^ words.mix(owner + np.uint64(1))
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(at), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        hit = at[twice]
        cover[hit] += 1
        np.subtract.at(cover, hit + WINDOW, 1)
    covered = np.concatenate(([0], np.cumsum(np.cumsum(cover[:-1]) > 0)))
    return covered[w.first[1:]] - covered[w.first[:-1]]


def judge(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """One row per document: its measures, the line counts and the verdict."""

    def run(batches):
        for b in words.freed(batches):
            out, _ = _judge(b.column("text"), rules, False)
            out["doc_id"] = b.column("doc_id")
            yield pa.RecordBatch.from_pydict({k: out[k] for k in names})

    names = [x.split()[0] for x in SCHEMA.split(", ")]
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)


def clean(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """The kept documents without their failing lines, all other columns as they were.

    ``n_chars``, if there is such a column, is counted anew.
    """

    def run(batches):
        for b in words.freed(batches):
            out, texts = _judge(b.column("text"), rules, True)
            at = b.schema.get_field_index("text")
            b = b.set_column(at, "text", pa.array([x.decode("utf-8", "replace") for x in texts], type=b.schema.field(at).type))
            at = b.schema.get_field_index("n_chars")
            if at >= 0:
                import pyarrow.compute as pc

                b = b.set_column(at, "n_chars", pc.utf8_length(b.column("text")).cast(b.schema.field(at).type))
            yield b.filter(pa.array(out["kept"]))

    return docs.mapInArrow(run, docs.schema)
