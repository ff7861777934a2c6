"""The gap state kept per batch, against gap detection over all committed rows."""

import datetime as dt
import random

import pytest

from gridledger.operators import quality
from gridledger.operators.commits import create_if_absent
from gridledger.operators.gap_state import GapState
from gridledger.operators.upsert import ATTEMPT, BATCH_SEQ

T0 = dt.datetime(2026, 7, 14, 4)
SCHEMA = "k string, ts timestamp, extra int, _bucket_id int"


def _rows(spark, hours):
    return spark.createDataFrame([(k, None if h is None else T0 + dt.timedelta(hours=h), 1, 2) for k, h in hours], SCHEMA)


def _committed(spark, pairs):
    return spark.createDataFrame(list(pairs), f"{BATCH_SEQ} bigint, {ATTEMPT} bigint")


def _found(df):
    return sorted((str(r[0]), r[1], r[2], r[3]) for r in df.collect())


@pytest.mark.parametrize("seed, fold", [(1, False), (2, True)])
def test_equals_detection_over_all_rows_whatever_the_order(spark, tmp_path, seed, fold):
    rng = random.Random(seed)
    state = GapState(spark, str(tmp_path / "s"), ["k"], "ts", 3600, fanout=8)
    state.seed(None)
    batches = {n: [(rng.choice(["a", "b", None]), rng.choice([None, rng.uniform(-60, 60)])) for _ in range(40)] for n in range(1, 4)}
    order, done, rows = rng.sample(sorted(batches), 3), [], []
    for n in order:
        state.append(_rows(spark, batches[n]), n)                       # dies: it is in no list
        state.append(_rows(spark, batches[n][5:]), n, 1)
        done.append((n, 1))
        rows += batches[n][5:]
        committed = _committed(spark, done)
        assert _found(state.gaps(committed)) == _found(quality.detect_gaps(_rows(spark, rows), ["k"], "ts"))
        if fold:
            assert state.fold(committed) and not state.fold(committed)
            assert _found(state.gaps(committed)) == _found(quality.detect_gaps(_rows(spark, rows), ["k"], "ts"))


def test_late_batch_closes_a_gap_between_two_folded_groups(spark, tmp_path):
    state = GapState(spark, str(tmp_path / "s"), ["k"], "ts", 3600, fanout=4)
    state.seed(None)
    state.append(_rows(spark, [("a", h) for h in (0, 1, 20, 21)]), 2)
    state.fold(_committed(spark, [(2, 0)]))
    assert len(_found(state.gaps(_committed(spark, [(2, 0)])))) == 1
    state.append(_rows(spark, [("a", h) for h in range(2, 20)]), 1)
    both = _committed(spark, [(1, 0), (2, 0)])
    assert _found(state.gaps(both)) == []
    state.fold(both)
    assert _found(state.gaps(both)) == []


def test_a_fold_that_died_is_not_read_and_can_be_taken_over(spark, tmp_path):
    state = GapState(spark, str(tmp_path / "s"), ["k"], "ts", 3600)
    state.seed(None)
    state.append(_rows(spark, [("a", 0), ("a", 5)]), 1)
    one = _committed(spark, [(1, 0)])
    state.append(_rows(spark, []), 2)
    state.fold(one)
    state.append(_rows(spark, [("a", 2)]), 3)
    all_ = _committed(spark, [(1, 0), (2, 0), (3, 0)])
    create_if_absent(spark, f"{state.root}/claims/1", "")
    state._summaries(state._read("buckets")).limit(0).write.parquet(f"{state.root}/groups/_fold=1")
    want = [("a", T0, T0 + dt.timedelta(hours=2), 7200.0), ("a", T0 + dt.timedelta(hours=2), T0 + dt.timedelta(hours=5), 10800.0)]
    assert _found(state.gaps(all_)) == want
    assert not state.fold(all_)
    assert state.fold(all_, take_over=True)
    assert _found(state.gaps(all_)) == want


def test_empty_states_and_batches_have_no_gaps(spark, tmp_path):
    state = GapState(spark, str(tmp_path / "s"), ["k"], "ts", 3600)
    assert state.gaps(_committed(spark, [])).count() == 0
    state.seed(None)
    state.append(_rows(spark, [("a", None)]), 1)
    one = _committed(spark, [(1, 0)])
    assert state.gaps(one).count() == 0
    assert state.fold(one) and state.gaps(one).count() == 0


def test_an_older_fact_is_seeded_once(spark, tmp_path):
    state = GapState(spark, str(tmp_path / "s"), ["k"], "ts", 3600)
    state.seed(_rows(spark, [("a", 0), ("a", 3)]))
    state.seed(_rows(spark, [("b", 0), ("b", 3)]))
    state.append(_rows(spark, [("a", 4)]), 9)
    one = _committed(spark, [(9, 0)])
    want = [("a", T0, T0 + dt.timedelta(hours=3), 10800.0)]
    assert _found(state.gaps(one)) == want
    state.fold(one)
    assert _found(state.gaps(one)) == want


def test_check_reads_only_groups_that_new_batches_touch(spark, tmp_path):
    state = GapState(spark, str(tmp_path / "s"), ["k"], "ts", 3600, fanout=4)
    state.seed(None)
    state.append(_rows(spark, [("a", h) for h in range(0, 400, 2)]), 1)
    one = _committed(spark, [(1, 0)])
    state.fold(one)
    state.append(_rows(spark, [("a", 1)]), 2)
    both = _committed(spark, [(1, 0), (2, 0)])
    touched = state._touched(both)
    assert touched.count() == 1
    assert state.gaps(both).count() == state.gaps(one).count() - 1
