"""Information-theoretic sanitisation of personal data.

Four kinds of personal data are found by pattern (email, ip, card, phone).
Beyond them, corpus co-occurrence estimates how strongly the terms around a
protected entity reveal it: with document counts n, the pointwise mutual
information of entity c and term t is log2(n(c,t) N / (n(c) n(t))), and its
share of the entity's information content log2(N / n(c)) is the disclosure of
c by t: 1 if t occurs with c only. Terms whose disclosure reaches a threshold
are generalised, above a higher one removed, wherever they stand in a text that
holds the entity; a term's occurrences are those in whole texts. An entity is a
value, and what it shares with near ones: a domain, network or prefix, so the
texts of values that occur once are evidence together. A pair counts as
evidence only if it occurs in ``min_texts`` different texts, so copies of one
text prove nothing, and in so many more than the ``n(c) n(t) / N`` that chance
would give that among all pairs of a corpus of this size none is expected to
reach it by chance (a Chernoff bound, by the number of pairs).

All counts cover the whole corpus and are aggregated before they are shuffled.
Only DataFrame functions are used. The patterns are written so that matching
takes linear time on any text.

Defined results: a null text is an empty text without spans; equal rows get
equal results; only the key and text columns are read (``sanitize`` passes the
others through); an empty table gives an empty table.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emporia.operators.joins import broadcast_if_small
from emporia.plans.session import ensure_checkpoint_dir

# The kinds in their order.
KINDS = ("email", "ip", "card", "phone")
TERM = "term"
BROADCAST_TEXTS = 1 << 20     # texts with disclosing terms, 8 bytes each

_LOCAL = "A-Za-z0-9._%+-"
# Each pattern finds what the plain one finds, leftmost and non-overlapping, without retries inside a run of
# characters that has failed once: a match can begin only where a run begins or the match before ended.
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # whole chains of 14 to 19 digits; shorter and longer chains would be dropped anyway
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
WORD = r"[\p{L}\p{N}]{3,}+"
SPAN_TYPE = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"


@dataclass(frozen=True)
class Disclosure:
    """Thresholds, and the evidence that a pair needs; ``chance`` is the expected number of pairs that pass without a cause."""

    generalise: float = 0.5
    remove: float = 0.8
    min_texts: int = 3
    chance: float = 0.5


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start,end,value>> of all matches; code points, end exclusive."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    parts = F.zip_with(gaps, found, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("len"), m.alias("value")))
    none = F.struct(F.lit(0).alias("pos"), F.expr("cast(array() as array<struct<start:int,end:int,value:string>>)").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["pos"] + x["gap"]
        span = F.struct(start.alias("start"), (start + x["len"]).alias("end"), x["value"].alias("value"))
        return F.struct((start + x["len"]).alias("pos"), F.concat(acc["out"], F.array(span)).alias("out"))

    return F.aggregate(parts, none, step)["out"]


def _luhn(value: Column) -> Column:
    digits = F.split(F.reverse(F.regexp_replace(value, "[^0-9]", "")), "")
    doubled = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        F.get(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), d.cast("int"))))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return _luhn(value)
    if kind == "phone":
        return F.length(F.regexp_replace(value, "[^0-9]", "")).between(10, 15)
    return F.lit(True)


# Texts without a match of these hold none of the kind.
_NEEDS = {"email": "@", "phone": "+"}


def with_base_spans(docs: DataFrame, text: str, out: str) -> DataFrame:
    """``docs`` with the base spans of column ``text`` as column ``out``, by start, then kind."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    none = F.expr(f"cast(array() as {SPAN_TYPE})")
    for kind in KINDS:
        some = F.contains(t, F.lit(_NEEDS[kind])) if kind in _NEEDS else t.rlike(PATTERNS[kind])
        docs = docs.withColumn(f"_{out}_{kind}", F.when(some, _spans(t, kind)).otherwise(none))
    parts = [f"_{out}_{kind}" for kind in KINDS]
    return docs.withColumn(out, F.array_sort(F.concat(*parts))).drop(*parts)


def _spans(text: Column, kind: str) -> Column:
    """The valid matches of one kind as spans."""
    valid = F.filter(matches(text, PATTERNS[kind]), lambda m: _valid(kind, m["value"]))
    return F.transform(valid, lambda m: F.struct(
        m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind"),
        m["value"].alias("value")))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _entities(spans: Column) -> Column:
    """The distinct entities of a text's spans: each value, and its domain or prefix."""
    def one(s: Column) -> Column:
        value = F.lower(s["value"])
        digits = F.regexp_replace(value, "[^0-9]", "")
        part = (F.when(s["kind"] == "email", F.substring_index(value, "@", -1))
                .when(s["kind"] == "ip", F.substring_index(value, ".", 2))
                .when(s["kind"] == "card", F.substring(digits, 1, 6)).otherwise(F.substring(digits, 1, 4)))
        return F.array(F.concat_ws(":", s["kind"], value), F.concat_ws("|", s["kind"], part))

    return F.array_distinct(F.flatten(F.transform(spans, one)))


def _blanked(text: Column, spans: Column) -> Column:
    """The text with spaces in place of its spans, as long as before."""
    start = F.struct(F.lit(0).alias("pos"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        begin = F.greatest(s["start"], acc["pos"])
        out = F.concat(acc["out"], F.substring(text, acc["pos"] + 1, begin - acc["pos"]),
                       F.repeat(F.lit(" "), F.greatest(s["end"] - begin, F.lit(0))))
        return F.struct(F.greatest(acc["pos"], s["end"]).alias("pos"), out.alias("out"))

    done = F.aggregate(spans, start, step)
    return F.concat(done["out"], F.substring(text, done["pos"] + 1, F.length(text)))


def _words(text: Column) -> Column:
    """The distinct words, in lower case."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lower))


def _places(texts: DataFrame) -> DataFrame:
    """(_text_id, term, start, end) of all words of column ``_t``; positions are summed up word by word."""
    found = F.regexp_extract_all("_t", F.lit(WORD), F.lit(0))
    parts = F.arrays_zip(F.slice(F.split("_t", WORD, -1), F.lit(1), F.size(found)).alias("gap"), found.alias("word"))
    rows = texts.select("_text_id", F.posexplode(parts).alias("_i", "_p"))
    length = F.length("_p.word")
    rows = rows.select("_text_id", "_i", F.lower("_p.word").alias("term"), length.alias("_len"),
                       (F.length("_p.gap") + length).alias("_step"))
    end = F.sum("_step").over(Window.partitionBy("_text_id").orderBy("_i").rowsBetween(Window.unboundedPreceding, 0))
    return rows.select("_text_id", "term", (end - F.col("_len")).alias("start"), end.alias("end"))


def _surprise(seen: Column, expected: Column) -> Column:
    """Minus the logarithm of a bound of the chance that a Poisson count reaches ``seen``; 0 if it is no more than expected."""
    return F.when(seen > expected, seen * F.log(seen / expected) - seen + expected).otherwise(0.0)


@dataclass
class Findings:
    """Base spans per row, and the disclosing terms' spans per text."""

    base: DataFrame       # _key, _text_id, _spans
    terms: DataFrame      # _text_id, _terms (spans of kind term, value: generalise or remove)


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", rule: Disclosure = Disclosure()) -> Findings:
    """Base spans and disclosing terms. Intermediate tables go to the checkpoint folder."""
    spark = docs.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/pii-{uuid.uuid4().hex}"
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).alias("_key"), t.alias("_t"), F.xxhash64(t, F.lit("text")).alias("_text_id"))
    with_base_spans(rows, "_t", "_spans").select("_key", "_text_id", "_spans", F.when(F.size("_spans") > 0, F.col("_t")).alias(
        "_t")).write.parquet(f"{folder}/base")
    base = spark.read.parquet(f"{folder}/base")
    # One row for each text with base spans.
    some = base.filter(F.size("_spans") > 0)
    copies = some.groupBy("_text_id").agg(F.count(F.lit(1)).alias("_copies"))
    texts = (some.select("_text_id", _blanked(F.col("_t"), F.col("_spans")).alias("_t"), _entities(F.col("_spans")).alias("_entities"))
             .dropDuplicates(["_text_id"]).join(copies, "_text_id"))
    texts.write.parquet(f"{folder}/texts")
    texts = spark.read.parquet(f"{folder}/texts")

    n = base.count()
    held = texts.select("_text_id", "_copies", "_t", F.explode("_entities").alias("entity"))
    # An entity of fewer texts has no pair with enough.
    entities = (held.groupBy("entity").agg(F.sum("_copies").alias("n_c"), F.count(F.lit(1)).alias("n_texts"))
                .filter(F.col("n_texts") >= rule.min_texts).select("entity", "n_c"))
    held = (held.join(broadcast_if_small(entities, 1 << 20), "entity")
            .select("_text_id", "_copies", "entity", "n_c", F.explode(_words(F.col("_t"))).alias("term")))
    tested = held.agg(F.approx_count_distinct(F.struct("entity", "term"))).first()[0] or 1
    # An entity's own count goes along with its pairs.
    pairs = (held.groupBy("entity", "n_c", "term").agg(F.sum("_copies").alias("n_ct"), F.count(F.lit(1)).alias("n_texts"))
             .filter(F.col("n_texts") >= rule.min_texts))
    counts = docs.select(F.explode(_words(t)).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    # A word that a span cuts off is none of the whole text.
    n_t = F.greatest("n_t", "n_ct")
    pmi = F.log2(F.col("n_ct") * F.lit(float(n)) / (F.col("n_c") * n_t))
    content = F.log2(F.lit(float(max(n, 1))) / F.col("n_c"))
    known = (pairs.join(counts, "term", "left")
             .withColumn("disclosure", F.when(content > 0, pmi / content).otherwise(0.0))
             .filter((F.col("disclosure") >= rule.generalise) & (_surprise(F.col("n_texts"), F.col("n_c") * n_t / float(max(n, 1)))
                                                                 >= math.log(tested / rule.chance)))
             .select("entity", "term", "disclosure"))
    known.write.parquet(f"{folder}/known")
    known = spark.read.parquet(f"{folder}/known")
    action = F.when(F.col("disclosure") >= rule.remove, F.lit("remove")).otherwise(F.lit("generalise"))
    told = (held.join(broadcast_if_small(known, 1 << 18), ["entity", "term"])
            .groupBy("_text_id", "term").agg(F.max("disclosure").alias("disclosure")))
    told.write.parquet(f"{folder}/told")
    told = spark.read.parquet(f"{folder}/told")
    found = (_places(texts.join(told.select("_text_id").distinct(), "_text_id", "left_semi")).join(told, ["_text_id", "term"])
             .select("_text_id", F.struct(F.col("start").cast("int").alias("start"), F.lit(len(KINDS)).alias("rank"),
                                          F.col("end").cast("int").alias("end"), F.lit(TERM).alias("kind"),
                                          action.alias("value")).alias("_span")))
    found.groupBy("_text_id").agg(F.array_sort(F.collect_list("_span")).alias("_terms")).write.parquet(f"{folder}/terms")
    return Findings(base.select("_key", "_text_id", "_spans"), spark.read.parquet(f"{folder}/terms"))


def _with_terms(rows: DataFrame, terms: DataFrame, spans=lambda df: df) -> DataFrame:
    """``rows`` (with _key, _text_id and _spans, which ``spans`` may add) with all spans, sorted, as ``_all``."""
    t = terms.withColumnRenamed("_text_id", "_text_id2")
    match, none = F.col("_text_id") == F.col("_text_id2"), F.expr(f"cast(array() as {SPAN_TYPE})")

    def merged(df: DataFrame) -> DataFrame:
        return df.withColumn("_all", F.array_sort(F.concat("_spans", F.coalesce("_terms", none)))).drop("_text_id2", "_terms")

    if t.limit(BROADCAST_TEXTS + 1).count() > BROADCAST_TEXTS:
        return merged(spans(rows).join(t, match, "left"))
    # Only texts with disclosing terms are shuffled.
    ids = F.broadcast(t.select("_text_id2"))
    some = merged(spans(rows.join(ids, match, "left_semi")).join(t, match))
    return some.unionByName(spans(rows.join(ids, match, "left_anti")).withColumn("_all", F.col("_spans")))


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", rule: Disclosure = Disclosure()) -> DataFrame:
    """Per row: counts of each base kind, ``base`` and ``spans`` as text, and the number of disclosing terms."""
    found = find(docs, key, text, rule)
    rows = _with_terms(found.base, found.terms)
    counts = [F.size(F.expr(f"filter(_spans, s -> s.kind = '{kind}')")).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return rows.select(F.col("_key").alias(key), *counts, span_text(F.col("_spans")).alias("base"),
                       span_text(F.col("_all")).alias("spans"),
                       (F.size("_all") - F.size("_spans")).cast("long").alias("n_term"))


def _replaced(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind; of overlapping spans the first names the kind."""
    start = F.struct(F.lit(0).alias("pos"), F.lit("").alias("out"))

    def token(s: Column) -> Column:
        return F.when(s["kind"] != TERM, F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))).when(
            s["value"] == "remove", F.lit("[REMOVED]")).otherwise(F.lit("[WORD]"))

    def step(acc: Column, s: Column) -> Column:
        ahead = s["start"] >= acc["pos"]
        out = F.concat(acc["out"], F.substring(text, acc["pos"] + 1, s["start"] - acc["pos"]), token(s))
        return F.struct(F.when(ahead, s["end"]).otherwise(F.greatest(acc["pos"], s["end"])).alias("pos"),
                        F.when(ahead, out).otherwise(acc["out"]).alias("out"))

    done = F.aggregate(spans, start, step)
    return F.concat(done["out"], F.substring(text, done["pos"] + 1, F.length(text)))


def sanitize(docs: DataFrame, key: str = "doc_id", text: str = "text", rule: Disclosure = Disclosure()) -> DataFrame:
    """``docs`` with base spans and disclosing terms replaced in the text; ``n_chars``, if there, is counted anew."""
    found = find(docs, key, text, rule)
    columns = docs.columns
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.struct(*[docs[c] for c in columns]).alias("_row"), docs[key].alias("_key"), t.alias("_t"),
                       F.xxhash64(t, F.lit("text")).alias("_text_id"))
    rows = _with_terms(rows, found.terms, lambda df: with_base_spans(df, "_t", "_spans"))
    rows = rows.withColumn("_new", F.when(F.size("_all") > 0, _replaced(F.col("_t"), F.col("_all")))
                           .otherwise(F.col(f"_row.{text}")))
    kinds = dict(docs.dtypes)
    new = {text: F.col("_new")} | ({"n_chars": F.length("_new").cast(kinds["n_chars"])} if "n_chars" in columns else {})
    return rows.select(*[new.get(c, F.col("_row").getField(c)).alias(c) for c in columns])
