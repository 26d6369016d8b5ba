"""Every pipeline stage against a plain version of it, on a small table with hard rows added."""

import numpy as np
import pytest
from test_order_minhash import brute_classes
from test_quality import plain
from test_suffix_dedup import brute
from tokenizers import Tokenizer

import corpus_pipeline as cp
from custlens.llm import quality_classifier as qc
from custlens.llm import quality_rules as qr
from custlens.llm import queries as q
from custlens.llm import text_stats
from custlens.runtime import materialize

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def documents(spark):
    rows = [tuple(r[c] for c in cp.COLUMNS) for r in q.table(spark, FOLDER, "documents").collect()]
    clean = max((r for r in rows if r[2] == "en"), key=lambda r: len(r[1]))
    # a passage of 700 bytes, accents included, inside documents that are otherwise their own
    good = sorted((r for r in rows if r[2] == "en" and 1500 < len(r[1]) < 6000), key=lambda r: r[0])
    passage = " é".join(clean[1].split()[20:140])[:700]
    shared = [(910_000 + i, f"{r[1][:700]} {passage} {r[1][700:1400]}", "en", "x", 1) for i, r in enumerate(good[:40:4])]
    shared = [(i, " ".join(w if (k + i) % 9 else w + "ly" for k, w in enumerate(t.split())) if i % 2 else t, *rest) for i, t, *rest in shared]
    hard = [(None, clean[1], "en", "x", 1), (900_001, None, None, None, None), (900_002, "", "en", "x", 0), (900_003, clean[1] + " é tail", "en", "x", 1), clean]
    return rows + hard + shared


@pytest.fixture(scope="module")
def stages(spark, documents):
    docs, out = materialize(spark.createDataFrame(documents, SCHEMA)), []
    for name, stage in cp.STAGES:
        before, docs = docs, materialize(stage(spark, docs, FOLDER))
        out.append((name, [tuple(r[c] for c in cp.COLUMNS) for r in before.collect()], docs))
    return out


def rows_of(df):
    return sorted(map(repr, (tuple(r[c] for c in cp.COLUMNS) for r in df.collect())))


def test_order_and_columns(stages):
    assert [n for n, _, _ in stages] == ["quality rules", "quality classifier", "near duplicates", "repeated strings", "packing"]
    assert all(df.columns == cp.COLUMNS for _, _, df in stages[:4])


def test_rules(spark, stages, documents):
    _, before, after = stages[0]
    # so few labels certify no cutoff: what stays is what passes the base rules
    stats = qr.with_statistics(spark.createDataFrame(documents, SCHEMA).select("doc_id", "lang", "text"))
    assert qr.fit_cutoffs(stats, q.table(spark, FOLDER, "labels")).count() == 0
    want = [r for r in before if (s := plain(r[1]))["n_words"] >= 10 and 100 * s["n_repeat_words"] <= 20 * s["n_words"]]
    assert rows_of(after) == sorted(map(repr, want)) and len(want) < len(before)


def test_classifier(spark, stages):
    _, before, after = stages[1]
    labels = {}
    for r in q.table(spark, FOLDER, "labels").collect():
        labels.setdefault(r.doc_id, set()).add(r.quality)
    frame = qc.pd.DataFrame(text_stats.measure([r[1] for r in before], more=True))
    docs = spark.createDataFrame(before, SCHEMA)
    model = qc.fit_on(qc.with_statistics(docs.select("doc_id", "text")), q.table(spark, FOLDER, "labels"))
    score = model.score(qc.features(frame))
    assert rows_of(after) == sorted(repr(r) for r, s in zip(before, score) if s >= 0.7)


def test_repeated_strings(stages):
    _, before, after = stages[3]
    assert sum(r[0] is not None and r[0] >= 910_000 for r in before) > 2  # some of the planted documents got here
    got = {r.doc_id: r for r in after.collect()}
    for r, spans in zip(before, brute([r[1] for r in before], 400)):
        raw = (r[1] or "").encode()
        keep = np.ones(len(raw), bool)
        for a, b in spans:
            keep[a:b] = False
        whole = "".join(c for c, k in _characters(raw, keep) if k)
        assert got[r[0]].text == (r[1] if not spans else whole)
        assert got[r[0]].n_chars == (r[4] if not spans else len(whole))
    assert any(brute([r[1] for r in before], 400))


def _characters(raw, keep):
    at = 0
    for c in raw.decode():
        n = len(c.encode())
        yield c, keep[at : at + n].all()
        at += n


def test_packing(stages):
    _, before, after = stages[4]
    tok = Tokenizer.from_file(q.WORD_BPE)
    pieces = after.collect()
    want = sorted(len(tok.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in before)
    assert sum(p.length for p in pieces) == sum(want)
    assert sorted({(p.doc_id, p.doc_tokens) for p in pieces}, key=str) == sorted({(r[0], len(tok.encode(r[1] or "", add_special_tokens=False).ids) + 1) for r in before}, key=str)


def test_run_and_empty_input(spark, stages):
    assert cp.run(spark, FOLDER).count() > 0
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in cp.STAGES:
        docs = materialize(stage(spark, docs, FOLDER))
    assert docs.count() == 0


def test_one_row_of_each_group_keeps_its_text(spark):
    """Repeated rows, and rows with and without an id: the text of each group survives once through the repeated strings."""
    one, two, three = (" ".join(f"{x}{i * i}" for i in range(120)) for x in "abc")
    rows = [(5, one), (5, one), (None, one), (7, one + " tail"), (None, two), (None, two), (3, three)]
    docs = materialize(spark.createDataFrame([(i, t, "en", "x", len(t)) for i, t in rows], SCHEMA).repartition(3))
    for stage in (cp.near_duplicates_stage, cp.repeated_strings_stage):
        docs = materialize(stage(spark, docs, FOLDER))
        assert sorted(((r.doc_id, r.text) for r in docs.collect()), key=str) == sorted([(5, one), (None, two), (3, three)], key=str)


def test_near_duplicates_by_row(stages):
    """Every row of the stage's input is a document of its own, whatever its id; of each class one stays."""
    _, before, after = stages[2]
    rows = sorted(before, key=lambda r: (r[0] is None, r[0] or 0))
    classes = brute_classes(dict(enumerate(r[1] for r in rows)))
    assert rows_of(after) == sorted(repr(r) for i, r in enumerate(rows) if classes[i] == i)
