"""The training-data operators against plain Python on small tables with nulls, ties, repeats and odd columns."""

import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from logflow.llm import chunks, licenses, mixing, neardup, packing, passages, perplexity, topk, toxicity, vptree, warc
from logflow.llm.components import components
from logflow.llm.queries import tokenizer_path
from logflow.scratch import fresh_dir

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int, component_id string, n_words int"


def words_of(text):
    return (text or "").encode().split()


def made_up(rng, n):
    return " ".join(f"w{rng.randrange(4000)}" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    base, shared = made_up(rng, 150), made_up(rng, 70)
    texts = [None, "", " \t\n ", "one", "ONE", base, base, base.upper() + "\n", made_up(rng, 3000)]
    for i in range(12):  # near copies with more and more words replaced
        own = base.split()
        for j in rng.sample(range(150), i):
            own[j] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(own))
    texts += [made_up(rng, 20) + "\n" + shared + "  " + made_up(rng, 30) for _ in range(5)]
    texts += [made_up(rng, rng.randrange(1, 200)) for _ in range(20)]
    out = [(i, t, None if i % 7 == 3 else "en", [None, "a", "b", "é"][i % 4], len(t or ""), i, "x", 0) for i, t in enumerate(texts)]
    return out + [(None, base, "en", "a", 1, 1, "x", 0), out[20]]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


def test_warc_round_trip(spark):
    pages = [(i, f"http://h/{i} \r\nX", "same" * (i % 3) if i % 2 else f"<p>{i}é</p>" * 40) for i in range(40)]
    pages += [(50, None, None), (51, "u", ""), (None, "u", "same"), (1, "http://h/1", pages[1][2])]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    df = df.selectExpr("*", "1 AS salt", "'q' AS sha1")
    read = warc.read_archives(warc.write_archives(df, fresh_dir(spark, "warc"), archive_bytes=20_000), with_payload=True)
    got = read.collect()
    assert len(got) == len(pages)
    first = {}
    for page, _, html in pages:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    by_page = {}
    for r in got:
        by_page.setdefault(r.page_id, []).append(r)
    for page, _, html in pages:
        data = (html or "").encode()
        for r in by_page[page]:
            original = first.get(html or "")
            assert r.payload_bytes == len(data)
            import base64

            assert r.payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
            assert (r.record_type, r.refers_to) == (("response", None) if page == original else ("revisit", original))
            assert r.payload is None if page != original else bytes(r.payload) == data
    assert warc.read_archives(warc.write_archives(df.limit(0), fresh_dir(spark, "warc"))).count() == 0


def vectors(spark, n=400):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(n, 6)).round(2)
    v[50:120] = v[7]  # a common vector
    rows = [(i, [float(x) for x in v[i]], 1.0) for i in range(n)]
    rows += [(1000, None, 1.0), (1050, [1.0, None], 1.0), (1100, [float("nan")], 1.0), (1150, [float("inf")] * 6, 1.0)]
    rows += [(1200, [0.0] * 6, 1.0), (1250, [], 1.0), (None, [1.0] * 6, 1.0), (3, [1e9] * 6, 1.0)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>, score double").repartition(3)


def best(rows, every, k, change, usable):
    good = [(i, change(v)) for i, v, _ in rows if i is not None and v is not None and usable(v)]
    asked = {}
    for i, v in good:
        if i % every == 0:
            asked[i] = min(v, asked.get(i, v))
    out = {}
    for q, v in asked.items():
        found = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in good if i != q)
        out[q] = [(i, -s) for s, i in found[:k]]
    return out


def finite(v):
    return all(x is not None and math.isfinite(x) for x in v)


def test_top_k_is_exact(spark):
    rows, df = vectors(spark)
    got = {}
    for r in topk.top_k(df, shard_rows=100, query_rows=4, block_rows=8).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == best(rows, 50, 5, lambda v: [math.floor(256 * x) for x in v], finite)
    assert topk.top_k(df.limit(0)).count() == 0


def test_vantage_point_trees(spark):
    rows, df = vectors(spark)
    want = best(rows, 20, 20, lambda v: v, lambda v: finite(v) and any(v))
    exact, loose = {}, {}
    for options, out in (({"factor": 1.0}, exact), ({}, loose)):
        for r in vptree.nearest(df, **options, shard_rows=100, query_rows=8, leaf_rows=8).orderBy("query_id", "rank").collect():
            out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(exact) == set(want)
    for q, hits in want.items():
        assert np.allclose([s for _, s in exact[q]], [s for _, s in hits], rtol=1e-9, atol=1e-9)
    hits = sum(len({i for i, _ in loose[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_patience_alignment_and_scan(spark, docs):
    assert licenses.align("a b c d".split(), "x b d".split()) == [(1, 1), (3, 2)]
    assert [licenses.longest_increasing(list(p)) for p in ([3, 1, 2], [1, 2, 3])] == [[1, 2], [0, 1, 2]]
    for p in itertools.permutations(range(5)):
        longest = max(len(c) for n in range(6) for c in itertools.combinations(p, n) if list(c) == sorted(c))
        assert len(licenses.longest_increasing(list(p))) == longest
    text = "Some words.\nReleased under the MIT License.\n" + licenses.TEMPLATES["ISC"].replace("hereby", "now")
    found = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")
    got = {r.license: r for r in licenses.scan_licenses(found).collect()}
    assert set(got) == {"ISC", "MIT-notice"} and got["MIT-notice"].coverage == 1.0 and got["MIT-notice"].first_word == 2
    assert 0.9 < got["ISC"].coverage < 1 and licenses.scan_licenses(docs).count() == 0


def test_scan_is_the_best_of_all_windows():
    text = "Released under the MIT License. This notice is under the License or under the License. The License, under the terms of the License."
    found = list(licenses.Scanner(licenses.TEMPLATES, 0.8, 1.5).scan(text))
    assert [(f[0], f[1], f[4], f[5]) for f in found] == [("MIT-notice", 1.0, 0, 4)]
    rng, some, several = random.Random(9), 0, 0
    templates = {"five": "a b c d e", "fixed": "x y {z q} x", "twelve": "a b a c d e a b f g h a", "one": "q"}
    scanner = licenses.Scanner(templates, 0.8, 1.5)
    for _ in range(400):
        words = [rng.choice("aabbcdefgh" + "xyzq" * rng.randrange(2)) for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(words) + 1)
            parts = ["a b c d e".split(), "x y z q x".split(), "x y z a q x".split(), "a b a c d e a b f g h".split()]
            words[at:at] = rng.choice(parts)
        claims = []
        for name, t in templates.items():
            t, need = t.replace("{", "").replace("}", "").split(), t.split("}")[0].split("{")[1:]
            free = [(0, len(words))]
            while free:
                a, b = free.pop()
                best = None
                for s in range(a, b):
                    window = words[s : min(b, s + int(len(t) * 1.5) + 2)]
                    pairs = licenses.align(window, t)
                    at = {j: i for i, j in pairs}
                    whole = not need or (2 in at and at.get(3) == at[2] + 1)
                    if len(pairs) >= 0.8 * len(t) and whole and (best is None or len(pairs) > best[0]):
                        best = (len(pairs), s + pairs[0][0], s + pairs[-1][0])
                if best:
                    claims.append((-best[0], -best[0] / len(t), best[1], name, best[2], len(t)))
                    free += [(a, best[1]), (best[2] + 1, b)]
        want = []
        for n, _, first, name, last, length in sorted(claims):
            if all(last < w[3] or first > w[4] for w in want):
                want.append((name, -n, length, first, last))
        got = [(f[0], *f[2:]) for f in scanner.scan(" ".join(words))]
        assert got == sorted(want, key=lambda w: w[3])
        some += len(want)
        several += len(want) > len({w[0] for w in want})
    assert some > 200 and several > 20


@pytest.mark.parametrize(
    "text,names",
    [
        ("Released under the BSD License.", ["BSD-notice"]),
        ("Released under the Apache License.", []),
        ("Licensed under the Mozilla License, Version 2.0.", []),
        ("Licensed under CC BY 4.0.", ["CC-BY-4.0-notice"]),
        ("Licensed under CC BY-ND 4.0.", ["CC-BY-ND-4.0-notice"]),
        ("This work is licensed under the GNU General Public License, version 2.", ["GPL-2.0-notice"]),
        ("This work is licensed under the GNU Lesser General Public License, version 2.1.", ["LGPL-2.1-notice"]),
        ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0-notice"]),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", ["CC-BY-SA-4.0-deed"]),
        (" and ".join(["Released under the MIT License."] * 3), ["MIT-notice"] * 3),
        ("Released under the MIT License. " * 500, ["MIT-notice"] * 500),
        (licenses.TEMPLATES["BSD-3-Clause"].replace("{", "").replace("}", ""), ["BSD-3-Clause"]),
        (licenses.TEMPLATES["BSD-2-Clause"], ["BSD-2-Clause"]),
        (licenses.TEMPLATES["Apache-2.0-header"], ["Apache-2.0-header"]),
        (licenses.TEMPLATES["MIT"] + " Released under the MIT License. " + licenses.TEMPLATES["ISC"], ["MIT", "MIT-notice", "ISC"]),
        ("", []),
        (None, []),
    ],
)
def test_license_names(text, names):
    assert [f[0] for f in licenses.Scanner(licenses.TEMPLATES, 0.8, 1.5).scan(text)] == names


def test_every_template_is_found_as_itself(spark):
    rows = [(i, t.replace("{", "").replace("}", ""), name) for i, (name, t) in enumerate(licenses.TEMPLATES.items())]
    frame = spark.createDataFrame(rows, "doc_id long, text string, license string")
    got = {r.doc_id: (r.license, r.coverage) for r in licenses.scan_licenses(frame).collect()}
    assert got == {i: (name, 1.0) for i, _, name in rows}
    assert licenses.scan_licenses(frame.limit(0)).count() == 0


def test_mix(docs, rows):
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows) and sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix(docs).collect()), key=str)
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(words_of(r[1]))
    order = sorted(s for s in sizes if s) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, open_ = {}, set(order)
    while open_:
        rate = (1.5 * sum(sizes.values()) - sum(target.values())) / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * rate >= 2 * sizes[s]}
        target |= {s: 2 * sizes[s] for s in full} if full else {s: weight[s] * rate for s in open_}
        open_ = open_ - full if full else set()
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6 and r.taken <= 2 * r.size
    for s in order:
        assert abs(sum(r.taken for r in got if r.source == s) - target[s]) <= 1
    taken = mixing.take(docs)
    assert taken.columns == docs.columns
    assert sum(len(words_of(r.text)) for r in taken.collect()) == sum(r.taken for r in got)
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.take(docs.limit(0)).count() == 0


def test_passages(docs, rows):
    first = {}
    for r in rows:
        w = words_of(r[1])
        for s in range(len(w) - 49):
            key = tuple(w[s : s + 50])
            if r[0] is not None:
                first[key] = min(r[0], first.get(key, r[0]))
    want = []
    for r in rows:
        w, gone = words_of(r[1]), set()
        for s in range(len(w) - 49):
            if r[0] is not None and first[tuple(w[s : s + 50])] < r[0]:
                gone.update(range(s, s + 50))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        want.append((r[0], len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    cut = passages.remove_repeats(docs)
    assert [c for c in docs.columns if c != "n_words"] == cut.columns[:-3]
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in cut.collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and sum(r[2] for r in got) > 500
    assert passages.remove_repeats(docs.limit(0)).count() == 0


def test_near_copies_around_the_threshold_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 9)
    rng = random.Random(11)
    base, texts = made_up(rng, 120).split(), []
    for i in range(90):
        own = list(base)
        for j in rng.sample(range(120), 2 + i % 16):
            own[j] = f"x{rng.randrange(3)}"  # edits that others have too
        texts.append(" ".join(own))
    sets = [set(zip(t.split(), t.split()[1:], strict=False)) for t in texts]
    root = list(range(90))
    for _ in root:
        for a, b in itertools.combinations(range(90), 2):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                root[a] = root[b] = min(root[a], root[b])
    blocks, inside = [], neardup.Verifier.links_between
    monkeypatch.setattr(neardup.Verifier, "links_between", lambda self, b: blocks.append(b.count()) or inside(self, b))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(df, k=2).collect()}
    assert got == dict(enumerate(root)) and blocks[0] > 9 and len(set(root)) > 1


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates(docs, rows, k):
    sets = {}
    for r in rows:
        w = [x.lower() for x in words_of(r[1])]
        sets.setdefault(r[0], frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset())
    ids = [i for i in sets if i is not None]
    root = {i: i for i in ids}
    for _ in ids:
        for a, b in itertools.combinations(ids, 2):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                root[a] = root[b] = min(root[a], root[b])
    got = neardup.near_duplicates(docs, k=k).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.n_shingles == len(sets[r.doc_id])
        assert r.component_id == (root[r.doc_id] if r.doc_id is not None else root[5])
        assert r.kept == (r.doc_id == r.component_id)
    assert neardup.near_duplicates(docs.limit(0), k=k).count() == 0


def test_one_row_of_each_group_stays(spark):
    rng = random.Random(12)
    a, b, c = (made_up(rng, 80) for _ in range(3))
    near = a.rsplit(" ", 2)[0] + " other end"
    rows = [(4, a, "p"), (3, near, "q"), (3, near, "r"), (None, a, "s"), (None, b, "t"), (None, b, "u"), (7, c, "v"), (7, "own", "w")]
    rows += [(8, None, "x"), (9, "", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, rid string").repartition(3)
    got = corpus_pipeline.near_duplicates(spark, df, "")
    assert got.columns == df.columns
    got = sorted([(r.doc_id, r.text) for r in got.collect()], key=str)
    assert got == sorted([(3, near), (None, b), (7, c), (7, "own"), (8, None), (9, "")], key=str)
    assert corpus_pipeline.near_duplicates(spark, df.limit(0), "").count() == 0


def test_components_of_a_chain(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_packing(docs, rows):
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    tokens = Tokenizer.from_file(path)
    texts = [r[1] or "" for r in rows] + ["<|endoftext|> a<|endoftext|>", " \n\n x\t\tzé 12345 don't 漢字🙂\x00"]
    encode = packing.byte_level_encoder(path)
    assert all(tokens.encode(t, add_special_tokens=False).ids == encode(t).tolist() for t in texts)
    got = packing.pack_documents(docs, path).collect()
    ids = {r[0]: [*tokens.encode(r[1] or "", add_special_tokens=False).ids, 0] for r in rows}
    assert sum(r.length for r in got) == sum(len(ids[r[0]]) for r in rows)
    fill = {}
    for r in got:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in fill.values():
        parts.sort()
        assert all(o == sum(n for _, n in parts[:i]) for i, (o, _) in enumerate(parts)) and sum(n for _, n in parts) <= 1024
    assert packing.pack_documents(docs.limit(0), path).count() == 0


def test_last_stage_gives_the_sequences(spark, rows):
    encode = packing.byte_level_encoder(tokenizer_path("byte_bpe_50k.json"))
    texts = [(r[0], r[1]) for r in rows] + [(3, "one two"), (3, "one")]  # a document again, whole and cut
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    left, sequences = {}, {}
    for i, t in texts:
        whole = (i, tuple([*encode(t or "").tolist(), 0]))
        left[whole] = left.get(whole, 0) + 1
    want = sum(n * len(ids) for (_, ids), n in left.items())
    got = corpus_pipeline.pack(spark, df, "").collect()
    for r in sorted(got, key=lambda r: r.offset):
        assert r.length == len(r.ids) and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        assert any(i == r.doc_id and list(ids[r.start : r.start + r.length]) == r.ids for i, ids in left)
        sequences.setdefault(r.sequence_id, []).extend(r.ids)
        assert len(sequences[r.sequence_id]) == r.offset + r.length <= 1024
    assert sum(map(len, sequences.values())) == want
    assert sum(s.count(0) for s in sequences.values()) == sum(n * ids.count(0) for (_, ids), n in left.items())


def test_kneser_ney_is_a_distribution(spark):
    texts = ["abcabcabd", "abd", "cab", None, ""] * 3
    names, counts = perplexity.count_grams(texts, np.ones(len(texts)), 3)
    have = dict(zip(names, counts.tolist(), strict=True))
    lines = [perplexity.START * 2 + (t or "") for t in texts]
    want = {}
    for line in lines:
        for i in range(len(line) - 2):
            want[line[i : i + 3]] = want.get(line[i : i + 3], 0) + 1
    assert have == want
    table = spark.createDataFrame([("x", g, c) for g, c in have.items()], "lang string, gram string, c long")
    letters = "abcdz"
    asked = spark.createDataFrame([("x", "ab" + w) for w in letters] + [("x", "zz" + w) for w in letters], "lang string, gram string")
    p = {r.gram: math.exp(r.logp) for r in perplexity.probabilities(asked, table, 3).collect()}
    for context in ("ab", "zz"):  # the alphabet's other characters share what the base distribution gives them
        rest = (perplexity.ALPHABET - len(letters)) * p[context + "z"]
        assert abs(sum(p[context + w] for w in letters) + rest - 1) < 1e-9
    assert p["abc"] > p["abz"]


def test_quality_keeps_clean_text(spark):
    rng = random.Random(2)
    clean = lambda: " ".join(rng.choice(["the", "house", "stands", "near", "water"]) for _ in range(60))
    rows = [(i, clean() if i % 10 else "%%% " + clean().upper() + " $$$ !!", "en" if i % 3 else None) for i in range(120)]
    rows += [(200, None, "en"), (201, "", "fr"), (202, "texte", "fr")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS rid", "'c' AS chunk")
    labels = spark.createDataFrame([(i, int(i % 10 > 0), 0) for i in range(0, 120)], "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in perplexity.filter_quality(df, labels).collect()}
    assert kept == {i for i in range(120) if i % 10} | {202}
    assert perplexity.filter_quality(df, labels.limit(0)).count() == 121
    assert perplexity.filter_quality(df.limit(0), labels).count() == 0


def test_thresholds_part_clean_from_junk(spark):
    rng = random.Random(6)
    rows = [("a", rng.uniform(4, 5), "clean") for _ in range(50)] + [("a", 30.0, "clean")]  # an outlier
    rows += [("a", rng.uniform(6, 40), "junk") for _ in range(40)] + [("a", 4.5, "junk"), ("a", 4.0, "learnt")]
    rows += [("b", rng.uniform(8, 9), "clean") for _ in range(200)] + [("b", 4.0, "learnt")]  # without junk
    rows += [("c", 4.8, "clean"), ("c", 7.0, "learnt"), ("d", 3.0, "learnt"), ("e", 2.0, "junk"), ("f", 2.0, "clean")]
    of = lambda kind, langs: [p for l, p, k in rows if k == kind and l in langs]

    def cost(limit, langs):
        clean, junk = of("clean", langs), of("junk", langs)
        return sum(p > limit for p in clean) / len(clean) + sum(p <= limit for p in junk) / len(junk)

    df = spark.createDataFrame(rows, "lang string, perplexity double, kind string").repartition(3)
    got = dict(map(tuple, perplexity.thresholds(df, 0.99).collect()))
    assert set(got) == set("abcd")
    assert cost(got["a"], "a") == min(cost(p, "a") for _, p, _ in rows) and 5 < got["a"] < 6.5
    assert abs(got["b"] / sorted(of("clean", "b"))[197] - 1) <= 1 / perplexity.STEPS
    assert got["c"] == got["d"] and abs(cost(got["c"], "abcdef") - min(cost(p, "abcdef") for _, p, _ in rows)) < 0.02
    assert {r.threshold for r in perplexity.thresholds(df.where("kind <> 'clean'"), 0.99).collect()} == {None}
    assert perplexity.thresholds(df.limit(0), 0.99).count() == 0


def test_chunks_and_rejects_of_rows_without_text(spark, monkeypatch):
    monkeypatch.setattr(chunks, "CHUNK_ROWS", 50)
    rows = [(i, None if i % 2 else "", "en") for i in range(400)] + [(i, "text " * 9, "en") for i in range(400, 420)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    store = chunks.store_chunks(df, 1000)
    got = [tuple(r) for r in store.selectExpr("chunk", "rid", "row.doc_id").collect()]
    sizes = {}
    for chunk, *_ in got:
        sizes[chunk] = sizes.get(chunk, 0) + 1
    assert max(sizes.values()) <= 50 and len({r for _, r, _ in got}) == len(got) == 420
    kept = perplexity.filter_quality(df, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert {r.doc_id for r in kept.collect()} == set(range(400, 420)) and kept.columns == df.columns
    assert "collect_list" not in kept._jdf.queryExecution().toString()


def test_quality_rejects_junk_below_clean_outliers(spark):
    rng = random.Random(8)
    clean = lambda: " ".join(rng.choice(["the", "house", "stands", "near", "water"]) for _ in range(60))
    junk = lambda: " ".join("".join(rng.sample(w, len(w))) for w in clean().split())
    rows = [(i, clean() if i % 3 else junk(), "en") for i in range(300)]
    odd = [i for i in range(300, 400) if zlib.crc32(str(i).encode()) % 5 == 0][:3]  # trusted, held out, and worse than junk
    rows += [(i, "漢字🙂" * 40, "en") for i in odd]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0 or i in odd), 0) for i, *_ in rows], "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in perplexity.filter_quality(df, labels).collect()}
    assert kept == {i for i in range(300) if i % 3}


def test_toxicity(spark):
    rng = random.Random(4)
    bad = lambda i: i % 3 == 0
    text = lambda i: made_up(rng, 40) + (" you nastyword1 foulword" if bad(i) else "") + made_up(rng, 5)
    rows = [(i, text(i)) for i in range(300)] + [(400, None), (401, ""), (None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS toxic", "2 AS part")
    labels = spark.createDataFrame([(i, 1, int(bad(i))) for i in range(300)] + [(5, 1, None)], "doc_id long, quality int, toxic int")
    got = toxicity.score(df, labels).collect()
    assert len(got) == len(rows)
    for r in got:
        held = r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0
        assert r.held_out == held and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    own = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 300]
    assert sum(r.predicted == bad(r.doc_id) for r in own) >= 0.9 * len(own)
    assert {r.score for r in toxicity.score(df, labels.limit(0)).collect()} == {0.0}
