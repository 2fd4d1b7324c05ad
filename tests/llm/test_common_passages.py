"""Segments that occur very often: one row for each document, and no meeting of all their places."""

import hashlib

from logflow.llm import passages


def joined_rows(df):
    """Rows out of each join of a frame and the names of its keys, after it has run."""
    df.collect()
    nodes, out = [df._jdf.queryExecution().executedPlan()], {}
    while nodes:
        node = nodes.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            nodes.append(node.executedPlan())
        elif "QueryStage" in name:
            nodes.append(node.plan())
        else:
            if "Join" in name:
                keys = [node.leftKeys().apply(i).name() for i in range(node.leftKeys().size())]
                out[tuple(keys)] = node.metrics().apply("numOutputRows").value()
            nodes += [node.children().apply(i) for i in range(node.children().size())]
    return out


def test_a_common_line_meets_its_first_document_once_for_each_chunk(spark, monkeypatch):
    line, texts = [f"w{i}" for i in range(30)], []
    for i in range(200):
        texts.append([*(f"a{i}-{j}" for j in range(i % 7)), *line * 20, f"end{i}", *line[: i % 30], *line * 2])
    texts[120] = texts[90]  # a copy; and one document without the line
    texts[3] = [f"b{j}" for j in range(200)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, (None, rows[0][1]), (500, None)], "doc_id long, text string").repartition(2)
    made, inside = {}, passages.materialize
    monkeypatch.setattr(passages, "materialize", lambda df, label: made.update({label: (df, inside(df, label))}) or made[label][1])
    got = {r.doc_id: r for r in passages.remove_repeats(docs).collect() if r.doc_id is not None}

    first = {}
    for i, t in enumerate(texts):
        for s in range(len(t) - 49):
            first.setdefault(tuple(t[s : s + 50]), i)
    for i, t in enumerate(texts):
        gone = {j for s in range(len(t) - 49) if first[tuple(t[s : s + 50])] < i for j in range(s, s + 50)}
        kept = " ".join(w for j, w in enumerate(t) if j not in gone)
        assert (got[i].n_removed, got[i].kept_sha256) == (len(gone), hashlib.sha256(kept.encode()).hexdigest())
    assert got[120].n_removed == len(texts[120]) and got[3].n_removed == 0 and len(got) == 201

    segments = made["segments"][1]
    places = segments.count()
    assert places == segments.select("rid", "seg_a", "seg_b").distinct().count()
    joins = joined_rows(made["judged"][0])
    assert joins[("chunk", "seg_a", "seg_b")] == places
    assert joins[("seg_a", "seg_b")] == segments.select("chunk", "seg_a", "seg_b").distinct().count() < places
