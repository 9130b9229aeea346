"""Customer scores from a folded state equal those of a full build."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from emporia.operators import rfm as R
from emporia.operators.rfm_state import RfmState, Scored
from tests.conftest import rows

SCORED = Scored("c", "o", "ts", "v", "ok")


def _lines(seed, n):
    rng = random.Random(seed)
    start = datetime(2020, 1, 1)
    return [(rng.choice(["a", "a", "a", "b", "c", None]), f"o{rng.randrange(n // 3)}" if rng.random() > 0.02 else None,
             start + timedelta(hours=rng.randrange(9000)) if rng.random() > 0.05 else None,
             Decimal(rng.randrange(-500, 9000)) / 100 if rng.random() > 0.1 else None, rng.random() > 0.2) for _ in range(n)]


def _frame(spark, lines):
    return spark.createDataFrame(lines, "c string, o string, ts timestamp_ntz, v decimal(18,4), ok boolean").repartition(3)


def _full(spark, lines):
    df = _frame(spark, lines)
    ref = R.max_timestamp(df, "ts")
    return R.rfm(df.filter("ok"), "c", "ts", "o", "v", distinct=True, ref_date=ref)


@pytest.mark.parametrize("k", [1, 4])
def test_state_after_k_batches_equals_the_full_build(spark, tmp_path, k):
    lines = _lines(k, 400)
    state = RfmState(spark, str(tmp_path / "s"), SCORED)
    for i in range(k):
        state.fold(_frame(spark, lines[i::k]), f"b{i}")
    assert rows(state.rfm()) == rows(_full(spark, lines))
    assert state.batches() == [f"b{i}" for i in range(k)]


def test_folding_a_batch_again_replaces_it_and_compaction_keeps_the_state(spark, tmp_path):
    lines = _lines(7, 300)
    state = RfmState(spark, str(tmp_path / "s"), SCORED)
    state.fold(_frame(spark, lines[:150]), "one")
    state.fold(_frame(spark, lines[:100]), "two")
    state.fold(_frame(spark, lines[150:]), "two")
    want = rows(_full(spark, lines))
    assert rows(state.rfm()) == want
    small = state.compact()
    assert rows(small.rfm()) == want and small.purchases().count() == state.purchases().count()
    more = _lines(8, 60)
    small.fold(_frame(spark, more), "three")
    assert rows(small.rfm()) == rows(_full(spark, lines + more)) and rows(state.rfm()) == want


def test_empty_batches_and_names(spark, tmp_path):
    state = RfmState(spark, str(tmp_path / "s"), SCORED)
    state.fold(_frame(spark, []), "none")
    assert state.rfm().count() == 0 and state.reference_date() is None
    state.fold(_frame(spark, [("a", "o", None, None, True), (None, "p", datetime(2020, 5, 5), None, True)]), "one")
    assert {tuple(r) for r in state.rfm().collect()} == {("a", None, 1, Decimal(0)), (None, 0, 1, Decimal(0))}
    for name in ("", "a/b", "compacted-1"):
        with pytest.raises(ValueError):
            state.fold(_frame(spark, []), name)
