"""Periodic runs against a plain search of every period, and the planting of runs against its definition."""

import hashlib
import random
import zlib

import pytest

from logflow.llm.queries import with_planted_runs
from logflow.llm.runs import find_runs, runs_of

DOCS = "doc_id long, text string, start string, runs int, n_runs int, `row` int"


def plain_runs(words):
    """Every maximal stretch with each period up to a quarter of the text; of equal stretches, the smallest period."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        at = 0
        while at + q < len(words):
            end = at
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            if end > at and end + q - at >= max(6, 4 * q):
                found.setdefault((at, end + q - at), q)
            at = end + 1
    return sorted(([s, n, q] for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def planted(doc_id, text):
    if text is None or doc_id is None:
        return text
    words, h = text.encode().split(), zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return text
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return b" ".join(words[: a] + [words[a + (i - a) % p] for i in range(a, n)]).decode()


def expected(doc_id, text):
    words = (text or "").encode().split()
    runs, gone = plain_runs(words), set()
    for start, length, period in runs:
        gone.update(range(start + period, start + length))
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    lines = "".join("%d,%d,%d\n" % tuple(r) for r in runs)
    left = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (len(words), len(runs), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left).hexdigest()), runs, left.decode()


def made_up_texts(rng, n=250):
    texts = [None, "", " \n\t", "a", "a a a a a", "a a a a a a", "é é é é é é é é é é é é", "ab " * 700, "a b c d " * 4, "x y " * 3 + "x", "w " * 5000]
    for _ in range(n):
        letters = rng.choice([1, 2, 3, 6, 400])
        words = [f"w{rng.randrange(letters)}" for _ in range(rng.randrange(90))]
        for _ in range(rng.randrange(3)):
            unit, at = [f"w{rng.randrange(3)}" for _ in range(rng.randrange(1, 9))], rng.randrange(len(words) + 1)
            words[at:at] = (unit * 12)[: rng.randrange(3 * len(unit), 8 * len(unit) + 1)]
        texts.append(rng.choice([" ", "\n", "\t "]).join(words))
    return texts


@pytest.mark.parametrize("seed", range(4))
def test_all_runs_of_every_text(seed):
    texts = [(t or "").encode().split() for t in made_up_texts(random.Random(seed))]
    for words, runs in zip(texts, runs_of(texts), strict=True):
        assert runs.tolist() == plain_runs(words)


def test_very_long_texts():
    rng = random.Random(3)
    unit = [b"%d" % rng.randrange(10**6) for _ in range(40_000)]
    one, many, none = runs_of([[b"x"] * 300_000, unit * 5 + [b"end"], unit])
    assert one.tolist() == [[0, 300_000, 1]]
    assert many.tolist() == [[0, 200_000, 40_000]]
    assert none.tolist() == []


def test_rows(spark):
    texts = made_up_texts(random.Random(9), 60)
    rows = [(i, t, "s", 1, 2, 3) for i, t in enumerate(texts)] + [(None, texts[-1], None, None, None, None), (20, texts[20], "s", 1, 2, 3)]
    found = find_runs(spark.createDataFrame(rows, DOCS).repartition(3))
    assert found.columns[:2] == ["doc_id", "text"] and found.columns.count("runs") == 1
    got = found.collect()
    assert len(got) == len(rows)
    for r in got:
        digests, runs, left = expected(r.doc_id, r.text)
        assert (r.n_words, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) == digests
        assert [list(x) for x in r.runs] == runs and r.collapsed == (None if r.text is None else left)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert find_runs(empty).collect() == []


def test_planted_runs(spark):
    texts = made_up_texts(random.Random(4), 300)
    rows = [(i * 7 - 100, t) for i, t in enumerate(texts)] + [(None, "a b c")]
    got = with_planted_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.text) for r in got} == {(i, planted(i, t)) for i, t in rows}
    assert sum(a.text != b[1] for a, b in zip(got, rows, strict=True)) > 10
