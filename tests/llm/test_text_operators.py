"""Operators that work text by text: quality rules, BPE, personal data, sharding."""

import math
import random
import re
import zlib
from collections import Counter

import pytest
import regex
from llm_brute import base_spans, by_id, quality, sha256
from pyspark.sql import functions as F

from emporia.llm import bpe, pii, quality_rules, sharding

SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "\n\n", "a", "a\n\na\na", "x " * 30, "word\x1cword\u0085end. ", "é" * 3000, "no end", "1 2 3 4 5 1 2 3 4 5 1"]


def table(spark, texts, extra=""):
    """A documents table with columns that clash with the operators' own names."""
    rows = [(i, t, 1, "k", -1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words int, kept string, shard int").repartition(3)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_quality_measures_equal_the_plain_ones(spark, documents):
    texts = [r.text for r in documents.collect()] + ODD
    got = {r.doc_id: r for r in quality_rules.judge(table(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        r, want = got[i], quality(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)


def test_quality_lines(spark):
    prose = "This line holds a sentence with enough words to pass."
    bad = ["Home | About | Contact | Help", "no sentence end in here", "# # # # $ $ words.", "Copyright 2020 by us.",
           "BUY! NOW! IT! IS! VERY! CHEAP!"]
    docs = table(spark, ["\n".join([prose, "And here is a second line of it.", b]) for b in bad] + [prose + "\n" + "\n".join(bad * 2)])
    rows = {r.doc_id: r for r in quality_rules.judge(docs).collect()}
    assert all(rows[i].n_bad_lines == 1 and rows[i].kept for i in range(len(bad)))
    assert not rows[len(bad)].kept
    kept = {r.doc_id: r for r in quality_rules.clean(docs).collect()}
    assert set(kept) == set(range(len(bad)))
    assert all(kept[i].text == prose + "\nAnd here is a second line of it." and kept[i].shard == -1 for i in kept)


def test_quality_keeps_documents_labelled_good(spark, documents):
    good = spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1")
    rows = quality_rules.judge(documents).join(good, "doc_id").filter("not base_failed").collect()
    assert rows and all(r.kept for r in rows)


def test_quality_of_empty_table(spark):
    empty = table(spark, ["x"]).limit(0)
    assert quality_rules.judge(empty).collect() == [] and quality_rules.clean(empty).collect() == []


@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(bpe.default_path())


def test_bpe_equals_the_library(spark, documents, library):
    rng = random.Random(3)
    pools = [range(32, 127), range(0xA0, 0x250), range(0x391, 0x3CA), range(0x4E00, 0x4F00), range(0x1F600, 0x1F640), [9, 10, 13, 0x1C, 0x85]]
    texts = [r.text for r in documents.collect()] + ODD + [
        "don't I'LL we're İSTANBUL ΟΔΥΣΣΕΥΣ e\u0301", "<|endoftext|>x<|startoftext|> <|endoftext|", "ab" * 400 + " " + "z" * 2000]
    texts += ["".join(chr(rng.choice(rng.choice(pools))) for _ in range(rng.randrange(80))) for _ in range(200)]
    out = bpe.encode_decode(table(spark, texts), bpe.default_path(), ("n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256"))
    again = {r.doc_id: r.decoded for r in bpe.decode(out.select("doc_id", "ids"), bpe.default_path()).collect()}
    for r in out.collect():
        want = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.ids == want and r.n_tokens == len(want)
        assert r.decoded == library.decode(want, skip_special_tokens=False) == again[r.doc_id]
        assert r.ids_sha256 == sha256(" ".join(map(str, want))) and r.decoded_sha256 == sha256(r.decoded)


def test_quality_rules_keep_mentions_and_other_scripts():
    rules = quality_rules.LineRules()
    bad = lambda x: quality_rules.bad_line(x.encode(), len(x.split()), rules, set())
    plain = " ".join(f"word{i}" for i in range(30))
    assert not any(map(bad, ("A new design in the blog inside the catalog in print.", f"The law of copyright {plain}.",
                             "\u4eca\u65e5\u306f\u3044\u3044\u5929\u6c17\u3067\u3059\u3002", "\u4f60\u597d\uff01\u5417\uff1f",
                             "\u092f\u0939 \u0915\u093f\u0924\u093e\u092c \u0939\u0948\u0964", "\u06a9\u06cc\u0627\u061f", "\u06c1\u06d2\u06d4")))
    assert all(map(bad, ("Please sign in.", "We use cookies.", "Copyright 2020 by us. All rights reserved.", "no end")))


def test_bpe_trees_agree_and_memo_is_bounded():
    v = bpe.Vocabulary.load(bpe.default_path())
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("thendrs") for _ in range(rng.randrange(1, 60))) for _ in range(400)})
    rows = bpe.Encoder(v)
    rows.learn(words)
    for w in words:
        raw = list(w.encode())
        symbols = [*v.inner[raw[:-1]].tolist(), int(v.final[raw[-1]])]
        assert " ".join(map(str, bpe.merge_long(symbols, v))) == rows.memo[w][0]
    small = bpe.Encoder(v, memo_words=50)
    for w in words:
        assert small.encode([w])[0][0] == rows.memo[w]
        assert len(small.memo) <= 50 + len(v.specials) + 1


def test_bpe_of_empty_table(spark):
    assert bpe.encode_decode(table(spark, ["x"]).limit(0), bpe.default_path()).collect() == []


def test_base_spans_equal_the_plain_patterns(spark, documents):
    rng = random.Random(5)
    parts = ["a", "b", "@", ".", "-", "+", "1", "2", "9", " ", "(", ")", "4111111111111111", "é", "%", "_", "0", "255", "256",
             "+1 ", "\n", "x@y.zz", "1.2.3.4", "😀"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(1500)] + ODD
    texts += ["a" * 30000, "1" * 30000, "a." * 20000 + "@", "+" + "1 " * 20000, "1.1." * 1500] + [r.text for r in documents.collect()]
    rows = pii.report(table(spark, texts)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = base_spans(texts[r.doc_id])
        assert r.base == want
        assert [r[f"n_{k}"] for k in pii.KINDS] == [want.count(f"{k}:") for k in pii.KINDS]


def test_disclosing_terms(spark):
    """A term that occurs with one address only goes in its context; copies and common terms prove nothing."""
    texts = [f"note {c} from zanzibar ann@mail.example the {c}{c}" for c in "abc"]
    texts += ["copy of kilimanjaro bob@mail.example the"] * 5
    texts += [f"the note of {i} the" for i in range(40)]
    rows = {r.doc_id: r for r in pii.report(table(spark, texts)).collect()}
    clean = {r.doc_id: r.text for r in pii.sanitize(table(spark, texts)).collect()}
    for i in range(3):
        assert "term:12:20" in rows[i].spans.split(",") and "email:21:37" in rows[i].spans
        assert clean[i].startswith(texts[i][:12] + "[REMOVED] [EMAIL] the") or "[REMOVED] [EMAIL] the" in clean[i]
        assert "the" in clean[i]
    assert all(rows[i].n_term == 0 and clean[i] == "copy of kilimanjaro [EMAIL] the" for i in range(3, 8))
    assert all(clean[i] == texts[i] for i in range(8, len(texts)))


def test_disclosing_terms_of_single_texts_and_far_away(spark):
    """Addresses that occur in one text each share a domain; a term tells them however far it stands."""
    filler = " ".join(["the"] * 60)
    texts = [f"Zanzibar İ {filler} person{c}@mail.example {filler} zanzibar" for c in "abc"]
    texts += [f"the note {i} the" for i in range(40)]
    rows = {r.doc_id: r for r in pii.report(table(spark, texts)).collect()}
    clean = {r.doc_id: r.text for r in pii.sanitize(table(spark, texts)).collect()}
    assert all(rows[i].n_term == 2 and clean[i] == f"[REMOVED] İ {filler} [EMAIL] {filler} [REMOVED]" for i in range(3))
    assert all(clean[i] == texts[i] for i in range(3, len(texts)))


def plain_terms(texts, rule):
    """(text number, start, end) of the disclosing terms, and the pairs (entity, term) behind them."""
    word = regex.compile(pii.WORD)
    spans = {t: [s.split(":") for s in base_spans(t).split(",") if s] for t in set(texts)}
    held, n_c, n_texts, n_ct, seen, n_t = {}, Counter(), Counter(), Counter(), Counter(), Counter()
    for t in texts:
        n_t.update({w.lower() for w in word.findall(t)})
    for t, found in spans.items():
        if not found:
            continue
        entities, blank = set(), t
        for kind, a, z in found:
            v = t[int(a):int(z)].lower()
            digits = re.sub("[^0-9]", "", v)
            shared = {"email": v.rsplit("@", 1)[-1], "ip": ".".join(v.split(".")[:2]), "card": digits[:6], "phone": digits[:4]}[kind]
            entities |= {f"{kind}:{v}", f"{kind}|{shared}"}
            blank = blank[:int(a)] + " " * (int(z) - int(a)) + blank[int(z):]
        held[t] = entities, {w.lower() for w in word.findall(blank)}, texts.count(t)
        for e in entities:
            n_c[e] += texts.count(t)
            n_texts[e] += 1
    for entities, terms, copies in held.values():
        for e in entities:
            if n_texts[e] >= rule.min_texts:
                for w in terms:
                    n_ct[e, w] += copies
                    seen[e, w] += 1
    known = {}
    for (e, w), k in n_ct.items():
        n_w, m = max(n_t[w], k), seen[e, w]
        content, expected = math.log2(len(texts) / n_c[e]), n_c[e] * n_w / len(texts)
        share = math.log2(k * len(texts) / (n_c[e] * n_w)) / content if content > 0 else 0
        surprise = m * math.log(m / expected) - m + expected if m > expected else 0
        if m >= rule.min_texts and share >= rule.generalise and surprise >= math.log(len(n_ct) / rule.chance):
            known[e, w] = share
    out = set()
    for i, t in enumerate(texts):
        told = {w for e, w in known if t in held and e in held[t][0] and w in held[t][1]}
        out |= {(i, m.start(), m.end()) for m in word.finditer(t) if m.group().lower() in told}
    return out, known


def test_planted_disclosures_are_found_and_chance_pairs_are_not(spark):
    rng = random.Random(11)
    vocabulary = [f"word{i}x" for i in range(400)]
    prose = lambda: [rng.choice(vocabulary) for _ in range(40)]
    texts, planted = [" ".join(prose()) for _ in range(500)], set()
    for g in range(15):
        code = f"codename{chr(97 + g)}"
        planted |= {(f"email|firm{g}.example", code)}
        for j in range(5):
            w = prose()
            w[rng.randrange(20)] = code
            texts.append(" ".join(w) + f" person{j}@firm{g}.example " + " ".join(prose()))
    texts += [" ".join(prose()) + f" 10.0.{i}.{rng.randrange(255)} " + " ".join(prose()) for i in range(200)]
    texts += [texts[505]] * 4
    want, known = plain_terms(texts, pii.Disclosure())
    found = {p for p in known if p[0].startswith("email|")}
    assert len(found & planted) >= 0.9 * len(planted) and len(known.keys() - planted) <= 0.1 * len(known)
    rows = pii.report(table(spark, texts)).collect()
    got = {(r.doc_id, int(a), int(z)) for r in rows for kind, a, z in (x.split(":") for x in r.spans.split(",") if x) if kind == "term"}
    assert got == want


def test_sanitize_overlaps_nulls_and_other_columns(spark):
    texts = ["call +1 (988) 555-2485 or 4111-1111-1111-1111, 1.2.3.4@x.org", None, "", "plain"]
    got = {r.doc_id: r for r in pii.sanitize(table(spark, texts)).collect()}
    assert got[0].text == "call [PHONE] or [CARD], [EMAIL]"      # the address outlasts the ip inside it
    assert got[1].text is None and got[2].text == "" and got[3].text == "plain" and got[3].kept == "k"
    assert pii.sanitize(table(spark, ["x"]).limit(0)).collect() == []


def test_sharding_law_and_slots(spark, documents):
    tree = sharding.Tree.even(2, 3, 4)
    texts = [r.text for r in documents.collect()] + ODD
    rows = sharding.assign(table(spark, texts), tree, rows_per_bucket=3).collect()
    assert len(rows) == len(texts)
    slots = {}
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 8, zlib.crc32(raw)) and r.law == "key"
        assert r.grown_shard in (r.shard, 24) and 0 <= r.shard < 24
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = {r.doc_id: r.shard for r in sharding.assign(table(spark, texts).filter("doc_id % 2 = 0"), tree).collect()}
    assert all(again[r.doc_id] == r.shard for r in rows if r.doc_id in again)


def test_sharding_confines_movement_to_changed_subtrees(spark):
    keys = spark.range(4000).withColumnRenamed("id", "doc_id")
    tree = sharding.Tree.even(2, 2, 3)
    heavier = sharding.Tree((tree.regions[0], (tree.regions[1][0], ((9, 1.0), (10, 3.0), (11, 1.0)))))
    before = sharding.place(keys, tree, "doc_id", "old")
    rows = sharding.place(before, heavier, "doc_id", "new").collect()
    counts = [sum(r.old == s for r in rows) for s in range(12)]
    assert min(counts) > 200 and max(counts) < 480
    moved = [r for r in rows if r.old != r.new]
    assert moved
    for r in moved:
        assert r.new >= 6                       # only the region whose weight grew takes rows
        if r.old >= 6:
            assert r.new >= 9                   # inside it, only the rack whose weight grew
        if r.old >= 9:
            assert r.new == 10                  # inside that, only the shard
    share = sum(r.new == 10 for r in rows) / len(rows)
    assert 0.16 < share < 0.27                  # 3 of 14


def test_sharding_nulls_and_repeats(spark):
    docs = spark.createDataFrame([(None, "a"), (None, None), (1, "x"), (1, "x"), (1, "y")], "doc_id long, text string")
    rows = sharding.assign(docs, sharding.Tree.even(1, 1, 2)).collect()
    assert len({r.shard for r in rows if r.doc_id is None}) == 1 and len({r.shard for r in rows if r.doc_id == 1}) == 1
    assert sorted((r.shard, r.slot) for r in rows) == sorted(set((r.shard, r.slot) for r in rows))
    assert sharding.assign(docs.limit(0), sharding.Tree.even(1, 1, 2)).collect() == []


def test_rows_are_not_reordered_by_partitioning(spark, documents):
    a = quality_rules.judge(documents).collect()
    b = quality_rules.judge(documents.repartition(7).select(F.lit(0).alias("n_lines"), "*")).collect()
    assert by_id(map(tuple, a)) == by_id(map(tuple, b))
