"""Long documents in the decontamination: pieces of bounded size, the same overlaps."""

from pyspark.sql import functions as F

from emporia.llm import decontaminate

ITEM = " ".join(f"w{i}" for i in range(59))


def test_a_long_document_full_of_one_item(spark):
    """Each of its 20,060 positions is a hit under several masks; no hit's row may hold the whole document."""
    docs = spark.createDataFrame([(1, " ".join([ITEM] * 340))], "doc_id long, text string")
    items = spark.createDataFrame([(7, ITEM)], "item_id long, text string")
    (got,) = decontaminate.overlaps(docs, items).collect()
    assert (got.n_equal, got.best_window, got.start_token, got.end_token, got.whole) == (59, 13, 0, 20060, False)


def test_pieces_hold_every_position_once_and_few_tokens(spark):
    rows = spark.range(1).select(F.col("id").alias("_key"), F.sequence(F.lit(0), F.lit(4999)).alias("t"), F.lit(5000).alias("_n"),
                                 F.lit(0).alias("_lo"), F.lit(0).alias("_at"), F.lit(4992).alias("_own"))
    for size in (512, 64):
        rows = decontaminate.pieces(rows, size, 59)
    got = rows.collect()
    assert sorted(r._lo + r._at + i for r in got for i in range(r._own)) == list(range(4992))
    assert all(r.t == list(range(r._lo, r._lo + len(r.t))) and len(r.t) <= 64 + 2 * 59 for r in got)
    # What lies around a position is there, up to the document's ends.
    assert all(r._at == min(59, r._lo + r._at) and r._lo + len(r.t) == min(5000, r._lo + r._at + 64 + 59) for r in got)


def test_pieces_of_any_size_give_the_same_overlaps(spark, monkeypatch):
    other = " ".join(f"v{i}" for i in range(200))
    docs = spark.createDataFrame([(1, f"{other} {ITEM} {other}"), (2, ITEM), (3, f"{ITEM} {other}"), (4, "a w0 w1"), (5, None), (None, other)],
                                 "doc_id long, text string")
    items = spark.createDataFrame([(7, ITEM), (8, "v3 v4 v5"), (9, other)], "item_id long, text string")
    whole = sorted(map(str, decontaminate.overlaps(docs, items).collect()))
    assert len(whole) == 9
    for sizes in ((50, 3), (7, 7), (1, 1)):
        monkeypatch.setattr(decontaminate, "PIECES", sizes)
        assert sorted(map(str, decontaminate.overlaps(docs, items).collect())) == whole
