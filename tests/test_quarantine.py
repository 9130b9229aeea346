"""Malformed CSV records are set aside with file and reason; all other rows are kept whole."""

import pytest

from emporia.plans.tables import from_csv
from emporia.sources import schemas
from emporia.sources.files import BAD_QUOTES, TOO_FEW, TOO_MANY, load_sound_csv
from emporia.sources.schemas import CATALOGUE

ITEMS = """order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value
o1,1,p,s,2017-01-01 00:00:00,5.0,1.0
o2,1,p,s
o3,1,p,s,2017-01-01 00:00:00,5.0,1.0,extra
o4,x,p,s,2017-01-01 00:00:00,abc,
o5,1,"p ""q"", r",s,,5.0,1.0
o6,1,"p,s,2017-01-01 00:00:00,5.0,1.0
o7,1,,,,,
o8,1,p,s,,5.0,1.0,,
,,,,,,
"""


def test_short_long_and_badly_quoted_rows(spark, tmp_path):
    (tmp_path / "items.csv").write_text(ITEMS)
    sound, aside = load_sound_csv(spark, str(tmp_path / "items.csv"), schemas.ORDER_ITEMS, str(tmp_path / "out"))
    assert sound.schema == schemas.ORDER_ITEMS
    kept = {r.order_id: tuple(r)[1:] for r in sound.collect()}
    assert kept == {"o1": (1, "p", "s", "2017-01-01 00:00:00", 5.0, 1.0), "o4": (None, "p", "s", "2017-01-01 00:00:00", None, None),
                    "o5": (1, 'p "q", r', "s", None, 5.0, 1.0), "o7": (1, None, None, None, None, None),
                    None: (None, None, None, None, None, None)}
    found = aside.collect()
    assert {(r.reason, r.record.split(",")[0]) for r in found} == {
        (TOO_FEW, "o2"), (TOO_MANY, "o3"), (BAD_QUOTES, "o6"), (TOO_MANY, "o8")}
    assert all(r.file.endswith("/items.csv") and r.record in ITEMS for r in found)


def test_multi_line_records(spark, tmp_path):
    head = ",".join(f.name for f in schemas.REVIEWS.fields)
    (tmp_path / "r.csv").write_text(f'{head}\nr1,o1,5,"Good","one\ntwo, ""three""",,\nr2,o2,4,"a\nb"\nr3,o3,3,,,,\n')
    sound, aside = load_sound_csv(spark, str(tmp_path / "r.csv"), schemas.REVIEWS, str(tmp_path / "out"))
    assert {r.review_id: r.review_comment_message for r in sound.collect()} == {"r1": 'one\ntwo, "three"', "r3": None}
    assert [(r.reason, r.record.strip()) for r in aside.collect()] == [(TOO_FEW, 'r2,o2,4,"a\nb"')]


@pytest.mark.parametrize("text", ["", "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"])
def test_files_without_rows(spark, tmp_path, text):
    (tmp_path / "s.csv").write_text(text)
    sound, aside = load_sound_csv(spark, str(tmp_path / "s.csv"), schemas.SELLERS, str(tmp_path / "out"))
    assert sound.count() == aside.count() == 0 and aside.columns == ["file", "reason", "record"]


def test_quarantine_is_counted_with_the_rejected_rows(spark, tmp_path):
    for name, (file_name, schema) in CATALOGUE.items():
        (tmp_path / file_name).write_text(",".join(f.name for f in schema.fields) + "\n")
    (tmp_path / CATALOGUE["order_items"][0]).write_text(ITEMS)
    t = from_csv(spark, str(tmp_path), quarantine=str(tmp_path / "staged"))
    counts = {(r.table_name, r.rule): r.rejected for r in t.rejected_rows().collect() if r.rejected}
    assert counts == {("order_items", TOO_FEW): 1, ("order_items", TOO_MANY): 2, ("order_items", BAD_QUOTES): 1,
                      ("order_items", "order_id present"): 1, ("order_items", "product_id present"): 1,
                      ("order_items", "price present"): 1}
    assert t.items_clean.count() == 2
