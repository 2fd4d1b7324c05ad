"""Long words that a polynomial hash confuses, long runs of white space, and working tables of the pipeline."""

import random
from pathlib import Path

import numpy as np

import corpus_pipeline
from logflow.llm import neardup, packing, passages
from logflow.llm.common import word_hashes
from logflow.llm.queries import tokenizer_path


def thue_morse(letters):
    """1,024 letters in an order that sums to the same modulo 2**64 for every multiplier, whichever letter is first."""
    return "".join(letters[bin(i).count("1") % 2] for i in range(1024))


ONE, OTHER = thue_morse("ab"), thue_morse("ba")


def test_words_have_their_own_hashes():
    assert len(set(word_hashes([ONE.encode(), OTHER.encode(), b"", b"a"]).tolist())) == 4
    assert word_hashes([b"a"])[0] != word_hashes([b"a"], seed=1)[0]


def test_texts_that_differ_in_such_a_word_are_no_copies(spark):
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join([*words[:25], w, *words[25:]]) for w in (ONE, OTHER, OTHER)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in passages.remove_repeats(docs).collect()}
    assert got == {0: 0, 1: 0, 2: 61}
    short = spark.createDataFrame([(0, f"{ONE} x"), (1, f"{OTHER} x"), (2, f"{OTHER} x")], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(short, k=2).collect()}
    assert got == {0: 0, 1: 1, 2: 1}


def test_long_runs_have_the_ids_of_the_tokenizer(spark, monkeypatch):
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    want, encode = Tokenizer.from_file(path), packing.byte_level_encoder(path)
    texts = [" " * 1_500_000, "a" + "\n " * 600_000 + "word", "x" * 400_000, "!?" * 200_000, " " * 20_000 + "<|endoftext|>"]
    for text in texts:
        assert np.array_equal(encode(text), want.encode(text, add_special_tokens=False).ids)
    monkeypatch.setattr(packing, "LONG_RUN", 3)
    rng, short = random.Random(2), packing.byte_level_encoder(path)
    for _ in range(3000):
        parts = [" ", "  ", "\n", "\t", "a", "Bc", "!", "1", "\xa0", "é", "\x1c", " ", "<|endoftext|>", "'s"]
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(20)))
        assert np.array_equal(short(text), want.encode(text, add_special_tokens=False).ids)
    docs = spark.createDataFrame([(1, texts[0]), (2, texts[1])], "doc_id long, text string")
    packed = packing.pack_documents(docs, path).drop("ids").collect()
    assert sum(r.length for r in packed if r.doc_id == 1) == len(want.encode(texts[0], add_special_tokens=False).ids) + 1


def test_stages_delete_what_the_one_before_left(spark, shared_dir):
    rng = random.Random(1)
    rows = [(i, " ".join(f"w{rng.randrange(300)}" for _ in range(80)), "en", "s") for i in range(30)] + [(30, None, "en", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")

    def folders():
        return {p.name for p in Path(shared_dir).iterdir() if p.is_dir()}

    at_first = folders()
    first = corpus_pipeline.near_duplicates(spark, docs, "")
    made = folders() - at_first
    assert any(name.startswith("chunks-") for name in made)
    second = corpus_pipeline.repeated_passages(spark, first, "")  # reads tables of the first, which therefore stay
    assert second.count() == 31 and any(name.startswith("chunks-") for name in folders() & made)
    stored = f"{shared_dir}/stored-by-a-test"
    second.write.parquet(stored)
    third = corpus_pipeline.mix(spark, spark.read.parquet(stored), "")
    assert not folders() & made
    assert not [t.name for t in spark.catalog.listTables() if t.name.replace("_", "-") in made]
    assert third.count() >= 31
