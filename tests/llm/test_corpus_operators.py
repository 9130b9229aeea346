"""Operators over the whole corpus: similarity join, substring dedup, decontamination, language models."""

import itertools
import math
import random
import re
import time

import pytest
from llm_brute import bigram_losses, by_id, jaccard_components, sha256, window_dedup
from pyspark.sql import functions as F

from emporia.llm import decontaminate, lm_scoring, ngram_join, substring_dedup, words

SF = "/root/testdata/sf0.001"


def table(spark, rows):
    rows = [(i, t, 7, "z") for i, t in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, n int, component_id string").repartition(4)


@pytest.fixture(scope="module")
def real(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def near_rows(seed, count):
    """Groups of near copies around the threshold, with nulls, empty and short texts."""
    rng = random.Random(seed)
    base = [[rng.choice("abcdefghijkl") + rng.choice("xyz") for _ in range(rng.randrange(1, 80))] for _ in range(10)]
    rows = []
    for i in range(count):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            w[rng.randrange(len(w))] = rng.choice("QRSTU")
        text = None if rng.random() < 0.03 else rng.choice([" ", "\n "]).join(w)
        rows.append((i if rng.random() > 0.03 else None, text))
    return rows + [(1000, ""), (1001, "a"), (1002, "A"), (1003, "a b c"), (1004, "a  b C"), (1005, " \t")]


@pytest.mark.parametrize("sim", [ngram_join.Similarity(), ngram_join.Similarity(5, 80)])
def test_components_equal_all_pairs(spark, monkeypatch, sim):
    monkeypatch.setattr(ngram_join, "TILE", 7)
    monkeypatch.setattr(ngram_join, "SAMPLE", 2)
    rows = near_rows(4, 300)
    got = ngram_join.components(table(spark, rows), sim).select("doc_id", "n_shingles", "component_id").collect()
    assert by_id(map(tuple, got)) == by_id(jaccard_components(rows, sim.n, sim.percent))


def test_components_of_documents(spark, real):
    got = ngram_join.components(table(spark, real)).collect()
    assert by_id(map(tuple, got)) == by_id(jaccard_components(real))


def test_keep_one_keeps_the_smallest_of_each(spark):
    rows = near_rows(9, 60)
    want = [(i, t) for (i, t), (_, _, c) in zip(rows, jaccard_components(rows, 5, 80), strict=True) if i is None or c == i]
    got = ngram_join.keep_one(table(spark, rows), ngram_join.Similarity(5, 80))
    assert got.columns == ["doc_id", "text", "n", "component_id"]
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=key) == sorted(want, key=key)


def test_chain_of_links_is_one_component(spark):
    """Neighbours link, the ends do not: the label has to travel along the chain."""
    base = [f"w{j}" for j in range(120)]
    rows = []
    for i in range(12):
        w = list(base)
        for j in range(i):
            w[5 + j * 9] = f"v{j}"
        rows.append((100 - i, " ".join(w)))
    want = jaccard_components(rows)
    assert len({c for _, _, c in want}) == 1
    assert by_id(map(tuple, ngram_join.components(table(spark, rows)).collect())) == by_id(want)


def test_components_repeated_rows_and_empty_table(spark):
    rows = [(1, "a b c d e"), (1, "a b c d e"), (2, "a b c d e"), (3, None)]
    got = ngram_join.components(table(spark, rows)).collect()
    assert by_id(map(tuple, got)) == [(1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 0, 3)]
    assert ngram_join.components(table(spark, rows).limit(0)).collect() == []


def test_components_of_an_id_with_a_copy_and_a_near_copy(spark):
    x, y = (" ".join(f"{c}{j}" for j in range(60)) for c in "xy")
    rows = [(5, x), (7, x), (7, y), (9, y + " z")]
    got = ngram_join.components(table(spark, rows)).collect()
    assert by_id(map(tuple, got)) == by_id(jaccard_components(rows))
    assert {(r.doc_id, r.component_id) for r in got} == {(5, 5), (7, 5), (7, 7), (9, 7)}


def test_keep_one_keeps_one_copy_of_each_text(spark):
    """Rows are dropped, not ids: an id that repeats another's text keeps its own."""
    x, y = " ".join(f"x{i}" for i in range(40)), " ".join(f"y{i}" for i in range(40))
    other = " ".join(f"o{i}" for i in range(30))
    rows = [(5, x), (7, x), (7, y), (9, y + " z"), (5, x), (5, x.upper()), (8, other), (8, other), (None, x), (None, x), (3, None), (3, "")]
    got = ngram_join.keep_one(table(spark, rows)).collect()
    texts = sorted((r.doc_id, (r.text or "").lower()) for r in got if r.doc_id is not None)
    assert texts == [(3, ""), (3, ""), (5, x), (7, y), (8, other)]
    assert sum(r.doc_id is None for r in got) == 2


def test_hot_blocks_and_settled_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "HOT_BLOCK", 2)
    monkeypatch.setattr(ngram_join, "SAMPLE", 1)
    monkeypatch.setattr(ngram_join, "SAMPLE_COUNT", 2)
    monkeypatch.setattr(ngram_join, "BROADCAST_NODES", 3)
    rows = near_rows(12, 200)
    assert by_id(map(tuple, ngram_join.components(table(spark, rows)).collect())) == by_id(jaccard_components(rows))


def test_bound_is_never_below_the_overlap():
    import numpy as np

    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = (np.unique(rng.integers(0, 1 << 63, 200, dtype=np.uint64)[:rng.integers(1, 200)]) for _ in range(2))
        b = np.unique(np.concatenate([b, a[:len(a) // 2]]))
        bins = [np.bincount((x >> np.uint64(58)).astype(int), minlength=64) for x in (a, b)]
        assert np.minimum(*bins).sum() >= len(np.intersect1d(a, b))


def dedup_rows(spark, rows, **options):
    out = substring_dedup.dedup(table(spark, rows), **options)
    return by_id(map(tuple, out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256)).collect()))


def test_substring_dedup_of_texts_that_repeat_an_id(spark):
    """A span found in one text is not removed from another of the same id."""
    p = " ".join(f"p{i}" for i in range(20))
    rows = [(1, p), (2, p + " tail"), (2, " ".join(f"u{i}" for i in range(30))), (2, p + " tail"), (3, "x " + p)]
    assert dedup_rows(spark, rows) == by_id(window_dedup(rows))


def test_substring_dedup_equals_all_windows(spark, real):
    assert dedup_rows(spark, real) == by_id(window_dedup(real))


@pytest.mark.parametrize("seed", [2, 3])
def test_substring_dedup_small_buckets(spark, seed):
    rng = random.Random(seed)
    pool = [*"abcdé", " ", "x y", "\x1c"]
    rows = [(i if rng.random() > 0.05 else None, None if rng.random() < 0.05 else rng.choice([" ", "\n", "  \t"]).join(
        rng.choice(pool[:rng.choice([1, 2, 8])]) for _ in range(rng.randrange(60)))) for i in range(300)]
    assert dedup_rows(spark, rows, bucket_bytes=500, chunk_bytes=700) == by_id(window_dedup(rows))


def test_substring_dedup_settles_equal_hashes_by_the_words():
    """Windows whose hashes collide are told apart by their words."""
    import numpy as np

    data = b"a b c d e f\nx y z d e f\na b c q r s"
    raw = np.frombuffer(data, dtype=np.uint8)
    ends = np.flatnonzero(raw == 0x0A)
    w = words.split(raw, np.concatenate(([0], ends + 1, [len(raw)])))
    at, _ = w.windows(w.hashes(), 3)
    owner = np.searchsorted(w.first, at, "right") - 1
    doc = np.array([5, 3, 9])[owner]
    same = np.zeros(len(at), dtype=np.uint64)        # all hashes equal
    hit = substring_dedup.later_windows(data, at, w, doc, 3, same)
    texts = [data[w.starts[i]:w.ends[i + 2]] for i in at]
    want = [any(t == u and e < d for u, e in zip(texts, doc, strict=True)) for t, d in zip(texts, doc, strict=True)]
    assert hit.tolist() == want and sum(want) == 2


def test_substring_dedup_repeated_ids_and_empty_table(spark):
    passage = " ".join(f"p{i}" for i in range(13))
    got = dedup_rows(spark, [(1, passage), (1, passage), (2, f"x {passage} y"), (3, None)])
    assert got == by_id([(1, 13, 0, sha256(passage)), (1, 13, 0, sha256(passage)), (2, 15, 13, sha256("x y")), (3, 0, 0, sha256(""))])
    assert substring_dedup.dedup(table(spark, [(1, "a")]).limit(0)).collect() == []


def plain_tokens(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def plain_overlaps(docs, bench, window=13, min_equal=0.8):
    """All alignments of every document and item that contain a seed hit."""
    out = set()
    for i, t in docs:
        d = plain_tokens(t)
        for k, u in bench:
            b = plain_tokens(u)
            for diagonal in range(-len(b) + 1, len(d)):
                lo, hi = max(0, -diagonal), min(len(b), len(d) - diagonal)
                size = min(window, len(b))
                if hi - lo < size or len(b) < decontaminate.SPAN:
                    continue
                equal = [d[j + diagonal] == b[j] for j in range(lo, hi)]
                seed = any(all(equal[s + o] for o, bit in enumerate(m) if bit == "1")
                           for m in decontaminate.MASKS for s in range(len(equal) - decontaminate.SPAN + 1))
                if seed and max(sum(equal[s:s + size]) for s in range(len(equal) - size + 1)) >= min_equal * size:
                    out.add((i, k))
    return out


def test_decontamination_equals_all_alignments(spark):
    rng = random.Random(8)
    vocab = [f"t{j}" for j in range(12)]
    bench = [(k, " ".join(rng.choice(vocab) for _ in range(rng.choice([5, 9, 11, 13, 20, 40])))) for k in range(12)]
    docs = []
    for i in range(60):
        w = [rng.choice(vocab) for _ in range(rng.randrange(0, 50))]
        if i % 2:
            passage = rng.choice(bench)[1].split()
            for _ in range(rng.randrange(5)):
                passage[rng.randrange(len(passage))] = "other"
            at = rng.randrange(len(w) + 1)
            w[at:at] = passage
        docs.append((i, " ".join(w).upper() if i % 3 else ", ".join(w)))
    docs += [(None, bench[5][1]), (900, None), (901, "")]
    items = spark.createDataFrame([*bench, (None, "x " * 20), (99, None)], "item_id long, text string")
    for block in (decontaminate.BLOCK_SEEDS, 40):
        got = decontaminate.overlaps(table(spark, docs), items, block_seeds=block)
        assert {(r.doc_id, r.item_id) for r in got.collect()} == plain_overlaps(docs, bench)


def test_decontamination_masks_hit_all_that_verification_accepts():
    for n in range(1, 17):
        others = n - math.ceil(n * 0.8) if n <= 13 else 2
        family = decontaminate.masks(n, others)
        for gone in itertools.combinations(range(n), others):
            assert any(all(bit == "0" or at + o not in gone for o, bit in enumerate(m))
                       for m in family for at in range(n - len(m) + 1)), (n, gone)


def test_decontamination_of_short_items_and_replaced_ends(spark):
    texts = {n: [f"n{n}x{j}" for j in range(n)] for n in (1, 3, 9, 10, 11, 12, 13)}
    gone = {1: [], 3: [], 9: [0], 10: [0, 5], 11: [0, 10], 12: [0, 11], 13: [3, 4]}
    items = spark.createDataFrame([(n, " ".join(w)) for n, w in texts.items()], "item_id long, text string")
    docs = [(n, " ".join("other" if j in gone[n] else x for j, x in enumerate(w))) for n, w in texts.items()]
    got = decontaminate.overlaps(table(spark, docs), items).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(n, n) for n in texts]


def test_decontamination_of_items_that_repeat_an_id(spark):
    """Each text of an id is aligned on its own, a long one beside a short one."""
    long, short = (" ".join(f"{c}{j}" for j in range(n)) for c, n in (("a", 40), ("b", 10)))
    items = spark.createDataFrame([(1, long), (1, short), (1, long), (2, short)], "item_id long, text string")
    docs = [(1, long), (2, f"x {short} y"), (3, " ".join(long.split()[25:])), (4, "nothing " * 20)]
    got = decontaminate.overlaps(table(spark, docs), items).collect()
    assert sorted((r.doc_id, r.item_id, r.n_equal) for r in got) == [(1, 1, 40), (2, 1, 10), (2, 2, 10), (3, 1, 15)]


def test_decontamination_finds_whole_passages(spark, real):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    bench = {r.item_id: " " + " ".join(plain_tokens(r.text)) + " " for r in items.collect()}
    want = {(i, k) for i, t in real for k, b in bench.items() if b in " " + " ".join(plain_tokens(t)) + " "}
    got = {(r.doc_id, r.item_id) for r in decontaminate.overlaps(table(spark, real), items).collect()}
    assert want and want <= got
    kept = {r.doc_id for r in decontaminate.clean(table(spark, real), items).collect()}
    assert kept == {i for i, _ in real} - {i for i, _ in got}


def test_decontamination_of_long_copies_is_linear(spark):
    """A copy of 4,000 tokens with some replaced is verified a few times, not once per hit."""
    rng = random.Random(5)
    w = [f"w{rng.randrange(900)}" for _ in range(4000)]
    changed = ["new" if rng.random() < 0.05 else x for x in w]
    items = spark.createDataFrame([(1, " ".join(w))], "item_id long, text string")
    began = time.monotonic()
    got = decontaminate.overlaps(table(spark, [(1, " ".join(w)), (2, "x " * 50 + " ".join(changed)), (3, "x y " * 3000)]), items)
    found = {r.doc_id: (r.n_equal, r.best_window, r.n_item, r.whole) for r in got.collect()}
    assert found == {1: (4000, 13, 4000, True), 2: (sum(a == b for a, b in zip(w, changed, strict=True)), 13, 4000, False)}
    assert time.monotonic() - began < 60


def test_short_items_take_out_their_own_text_only(spark):
    items = spark.createDataFrame([(1, "yes"), (2, "the answer is no"), (3, " ".join(f"w{i}" for i in range(13)))],
                                  "item_id long, text string")
    docs = [(1, "Yes!"), (2, "she said yes to the offer"), (3, "The answer is: no"), (4, "so the answer is no then"),
            (5, "see " + " ".join(f"w{i}" for i in range(13))), (6, "clean")]
    assert {r.doc_id for r in decontaminate.clean(table(spark, docs), items).collect()} == {2, 4, 6}
    assert {r.doc_id for r in decontaminate.clean(table(spark, docs), items, least_tokens=1).collect()} == {6}


def test_decontamination_empty_tables_and_masks(spark):
    assert all(len(m) == decontaminate.SPAN and m[0] == m[-1] == "1" for m in decontaminate.MASKS)
    docs = table(spark, [(1, "a " * 30)])
    items = spark.createDataFrame([(1, "a " * 30)], "item_id long, text string")
    assert decontaminate.overlaps(docs, items.limit(0)).collect() == []
    assert decontaminate.overlaps(docs.limit(0), items).collect() == []
    assert decontaminate.clean(docs, items.limit(0)).count() == 1


def check_scores(spark, rows, target, spec):
    ids = spark.createDataFrame([(i,) for i in target] + [(None,)], "doc_id long")
    got = lm_scoring.score(table(spark, rows), ids, spec).collect()
    want = bigram_losses(rows, set(target), spec, bytes(lm_scoring._TABLE.tolist()))
    assert len(got) == len(want)
    for r in got:
        n, t, b = want[r.doc_id]
        assert r.n_tokens == n
        if t is None:
            assert r.score is None and r.loss_target is None
        else:
            assert r.loss_target == pytest.approx(t, abs=1e-9) and r.loss_background == pytest.approx(b, abs=1e-9)
            assert r.score == pytest.approx(t - b, abs=1e-9)


def test_scores_equal_the_plain_models(spark, real):
    rows = real + [(5, "again A b!"), (None, "x y"), (None, None), (5000, ""), (5001, None)]
    check_scores(spark, rows, list(range(0, 100, 3)) + [99999, 3], lm_scoring.ModelSpec(vocab_share=3000, hot_share=2000))


def test_scores_know_rare_words(spark, real):
    """No word is cut, however large the corpus: two rare words with different counts get different scores."""
    rows = [(1, "common " * 140000), (2, "alpha beta"), (3, "gamma delta"), (4, "alpha beta"), (5, "gamma delta")]
    check_scores(spark, rows, [2], lm_scoring.ModelSpec())
    ids = spark.createDataFrame([(2,)], "doc_id long")
    got = {r.doc_id: r.score for r in lm_scoring.score(table(spark, rows), ids).collect()}
    assert got[4] < got[5] - 0.01
    check_scores(spark, real, list(range(0, 100, 3)), lm_scoring.ModelSpec(hot_share=500))


def test_scores_tell_good_documents_from_others(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    train = labels.filter("quality = 1 and doc_id % 2 = 0").select("doc_id")
    scores = lm_scoring.score(docs, train).join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    good, bad = ([r.score for r in scores if r.quality == q] for q in (1, 0))
    wins = sum(g < b for g in good for b in bad) / (len(good) * len(bad))
    assert wins > 0.9                                    # held out; area under the curve


def test_scores_without_target_or_documents(spark):
    none = spark.createDataFrame([], "doc_id long")
    check_scores(spark, [(1, "a b a"), (2, "c")], [], lm_scoring.ModelSpec())
    assert lm_scoring.score(table(spark, [(1, "a")]).limit(0), none).collect() == []
