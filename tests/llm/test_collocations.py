"""Collocations against plain counting, SQL, and compacted paths against the phrases they stand for."""

import random
import re
from collections import Counter

import pytest

from check import compare, connect
from logflow.llm import collocations
from logflow.llm.queries import ORACLES, QUERIES

DOCS = "doc_id long, text string, lang string, gram string, a string, n int, `row` int"


def pieces(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall("[^\x20\x09]+", p) for p in re.split("[.,;:!?\x0a-\x0d]", lower)]


def counted(rows, longest):
    counts, totals = {}, Counter()
    for _, text, lang, *_ in rows:
        own = counts.setdefault(lang or "und", Counter())
        for words in pieces(text):
            totals[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                own.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return counts, totals


def plain(rows, longest, least, most):
    out, (counts, totals) = [], counted(rows, longest)
    for lang, f in counts.items():
        frequent = {g: n for g, n in f.items() if n >= least}
        own = []
        for g, a in frequent.items():
            if len(g) == 1:
                continue
            inside = any(
                len(t) > len(g) and 100 * n >= 50 * a and any(t[i : i + len(g)] == g for i in range(len(t) - len(g) + 1))
                for t, n in frequent.items()
            )
            if not inside:
                score, _, left, right = min((10**6 * a * a // (f[g[:k]] * f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
                own.append((-score, -a, " ".join(g).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(own)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    common = [f"W{i}é" for i in range(12)]
    passage = " ".join(f"p{i}" for i in range(90))  # one unary path
    texts = [None, "", " \t", "...", "one", "One two", "a b c d, a b c d; A B c\x0bd", "x  \t y\ry x"]
    texts += ["the the the the the the the the the the the the"] + [passage] * 6 + [passage.replace("p40", "other")] * 5
    texts += [rng.choice([" ", ". "]).join(rng.choices(common, range(1, 13), k=rng.randrange(60))) + "\n" + "end of line" for _ in range(60)]
    return [(i, t, [None, "en", "de", "und"][i % 4], "g", "a", 1, 2) for i, t in enumerate(texts)] + [(3, passage, "de", None, None, None, None)] * 3


@pytest.mark.parametrize(("longest", "least", "most"), [(3, 4, 40), (3, 2, 10_000), (2, 3, 50), (4, 3, 500)])
def test_against_plain_counts(spark, rows, monkeypatch, longest, least, most):
    monkeypatch.setattr(collocations, "OUT_ROWS", 7)
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    got = collocations.strongest_collocations(df, longest, least, most=most).collect()
    assert sorted(map(tuple, got)) == plain(rows, longest, least, most)


def test_paths_stand_for_their_edges(spark, rows):
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    graph = collocations.phrase_graph(df, 3, 3)
    counts, totals = counted(rows, 3)
    seen = Counter()
    longest = 0
    for r in graph.paths.collect():
        longest = max(longest, len(r.path))
        for i in range(len(r.path) - 2):
            seen[r.lang, tuple(r.path[i : i + 3])] += 1
            assert counts[r.lang][tuple(r.path[i : i + 3])] == r.a
        for i in range(1, len(r.path) - 2):  # inner nodes carry the path's flow
            assert counts[r.lang][tuple(r.path[i : i + 2])] == r.a
    edges = {(lang, g) for lang, f in counts.items() for g, n in f.items() if len(g) == 3 and n >= 3}
    assert set(seen) == edges and set(seen.values()) == {1}
    assert longest > 40
    assert {r.lang: r.n for r in graph.totals.collect()} == {k: n for k, n in totals.items() if n}


def test_many_words_in_one_block():
    """Phrase numbers fit 64 bits even where the number of words to the third power does not."""
    block = collocations.Block()
    block.number |= {b"#%d" % i: i for i in range(1, 1 << 21)}
    block.add(b"a b c a b c, a b")
    got = {(g.as_py(), k): c.as_py() for grams, k, n in block.counted(3) for g, c in zip(grams, n, strict=True)}
    assert got == {(b"a b c", 3): 2, (b"b c a", 3): 1, (b"c a b", 3): 1, (b"b c", 2): 1, (b"c", 1): 1, (b"a b", 2): 1, (b"b", 1): 1}


def test_scores_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    a, left, right = 4 * 10**12, 4 * 10**12 + 7, 9 * 10**12 + 1
    got = spark.range(1).select(collocations.score(F.lit(a), F.lit(left), F.lit(right)).alias("s")).first().s
    assert got == 10**6 * a * a // (left * right)


def test_no_words(spark):
    df = spark.createDataFrame([(1, None, "en"), (2, " . ", None)], "doc_id long, text string, lang string")
    assert collocations.strongest_collocations(df).collect() == []
    assert collocations.strongest_collocations(df.limit(0)).collect() == []


def test_query_matches_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    got = QUERIES["op13_phrase_graph"](spark, sf_dir).toPandas()
    assert compare(got, connect(sf_dir).execute(ORACLES["op13_phrase_graph"]).df()) == "ok"
