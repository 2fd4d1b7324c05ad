"""State machines split into blocks must equal one sequential pass."""

import random

import pytest

from logflow.operators import statemachines as sm

T0 = 1_700_000_000_000


def fold(machine, rows):
    state, out = machine.initial, []
    for row in rows:
        state, outputs = machine.step(state, *row)
        out.append(outputs)
    return out


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("block", [8, 1000])
def test_sequences_equal_one_pass(spark, seed, block):
    rng = random.Random(seed)
    rows, want, arrival = [], {}, 0
    for producer, size in ((1, 80), (2, 20), (3, 1)):
        # Few distinct numbers, and long runs of one number, keep memory of the far past alive.
        sequences = []
        while len(sequences) < size:
            sequences += [rng.randrange(9)] * rng.choice([1, 1, 2, 15])
        for seq, (dup,) in zip(sequences, fold(sm.SEQUENCES, [(s,) for s in sequences]), strict=True):
            arrival += rng.randrange(1, 4)
            rows.append((producer, 0, seq, arrival))
            want[arrival] = dup
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "producer_id BIGINT, partition INT, sequence BIGINT, arrival BIGINT")
    got = sm.mark_duplicate_sequences(df, block=block, width=13).collect()
    assert {r.arrival: r.duplicate for r in got} == want
    assert len(got) == len(rows)


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("block", [9, 1000])
def test_breaker_equals_one_pass(spark, seed, block):
    rng = random.Random(seed)
    rows, want, seq = [], {}, 0
    for dependency, size in (("hot", 90), ("cold", 20)):
        ts, calls = T0, []
        for _ in range(size):
            ts += rng.choice([10, 500, 9_000, 31_000])
            calls.append((ts, rng.random() < 0.55))
        for (at, failed), (allowed, state) in zip(calls, fold(sm.BREAKER, calls), strict=True):
            seq += 1
            rows.append((dependency, seq, at, failed))
            want[seq] = (allowed, state)
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "dependency STRING, seq BIGINT, ts_ms BIGINT, failed BOOLEAN")
    got = sm.circuit_breaker(df, block=block, width=11).collect()
    assert {r.seq: (r.allowed, r.state) for r in got} == want
    assert {s for _, s in want.values()} == {"CLOSED", "OPEN", "HALF_OPEN"}


def test_resend_is_dropped_and_old_repeat_passes():
    sent = [0, 0, 1, 2, 3, 4, 5, 0]
    assert [d for (d,) in fold(sm.SEQUENCES, [(s,) for s in sent])] == [False, True] + [False] * 6


def test_breaker_cycle():
    calls = [(T0 + i, i % 2 == 0) for i in range(10)]  # five of ten fail
    calls += [(T0 + 100, False)]  # refused while open
    calls += [(T0 + 40_000, False), (T0 + 40_001, False)]  # probes succeed
    states = fold(sm.BREAKER, calls)
    assert [s for _, s in states] == ["CLOSED"] * 9 + ["OPEN", "OPEN", "HALF_OPEN", "CLOSED"]
    assert [a for a, _ in states] == [True] * 10 + [False, True, True]


def test_failed_probe_opens_again():
    calls = [(T0, True)] * 10 + [(T0 + 30_000, True), (T0 + 30_001, False)]
    assert [s for _, s in fold(sm.BREAKER, calls)][-2:] == ["OPEN", "OPEN"]


def test_breaker_needs_ten_outcomes():
    assert {s for _, s in fold(sm.BREAKER, [(T0, True)] * 9)} == {"CLOSED"}


def test_endless_resends_settle(spark):
    """Memory that never fades: every block passes the state of the first one on."""
    sequences = [1, 2, 3] + [1, 2, 3, 1] * 40
    rows = [(1, 0, s, i) for i, s in enumerate(sequences)]
    df = spark.createDataFrame(rows, "producer_id BIGINT, partition INT, sequence BIGINT, arrival BIGINT")
    got = sm.mark_duplicate_sequences(df, block=5, width=17).orderBy("arrival").collect()
    assert [r.duplicate for r in got] == [False] * 3 + [True] * 160
