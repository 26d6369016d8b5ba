"""The conditional random field against sums over all state sequences; held-out accuracy; odd rows."""

import itertools
import math
import random
import zlib

import numpy as np
import pytest

from custlens.llm import queries as q
from custlens.llm import toxicity as tx


def all_sequences(model, emissions):
    """Marginals and expected steps of one chain, by every sequence of states."""
    n = len(emissions)
    total, chance, pairs = 0.0, np.zeros(n), np.zeros((2, 2))
    for states in itertools.product((0, 1), repeat=n):
        weight = math.exp(sum(e for e, s in zip(emissions, states) if s) + model.start * states[0] + sum(model.step[a, b] for a, b in zip(states, states[1:])))
        total += weight
        chance += weight * np.array(states)
        for a, b in zip(states, states[1:]):
            pairs[a, b] += weight
    return chance / total, pairs / total


def test_forward_backward_equals_all_sequences():
    rng = np.random.default_rng(3)
    model = tx.Field(start=0.7, step=rng.normal(size=(2, 2)))
    lengths = np.array([1, 7, 3, 3, 10, 2, 1])
    emissions = rng.normal(size=lengths.sum()) * 2
    chance, pairs = model.marginals(emissions, lengths)
    parts = [all_sequences(model, e) for e in np.split(emissions, np.cumsum(lengths)[:-1])]
    assert np.allclose(chance, np.concatenate([c for c, _ in parts])) and np.allclose(pairs, sum(p for _, p in parts))
    assert model.marginals(np.zeros(0), np.zeros(0, np.int64))[0].shape == (0,)
    extreme, _ = model.marginals(np.array([40.0, -40.0] * 5000), np.array([10_000]))
    assert np.isfinite(extreme).all() and extreme[0] > 0.99 and extreme[1] < 0.01


def test_chains_end_at_stops_lines_and_texts():
    features, owner, lengths = tx.Encoder()(["One two. three\nfour  five", None, "", "\n\n", "six.\nseven"])
    assert lengths.tolist() == [2, 1, 2, 1, 1] and owner.tolist() == [0] * 5 + [4] * 2
    own = tx.Encoder()(["TWO%%% two. two"])[0]
    assert (own == own[0]).all() and own[0].tolist() == features[1].tolist()
    assert all(len(x) == 0 for x in tx.Encoder()([]))


def test_copies_of_one_text_mark_no_word():
    letters, lengths, toxic = [], [], []
    for i in range(300):
        bad = i % 3 == 0
        own = [1000 + i * 10 + k for k in range(8)]
        if bad and i % 2:
            own[3] = 7  # the toxic word, in ever other surroundings
        elif bad:
            own = [50, 51, 52, 53, 54, 55, 56, 57]  # copies of one text
        letters += own
        lengths.append(8)
        toxic += [bad] * 8
    assert tx.toxic_buckets(np.array(letters), np.array(lengths), np.array(toxic)).tolist() == [7]


def corpus(spark, n=1500):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(n):
        words = ["w%s" % "".join(rng.choice("abcdefgh") for _ in range(3)) for _ in range(rng.randint(4, 120))]
        bad = rng.random() < 0.2
        for _ in range(rng.randint(1, 4) if bad else 0):
            words.insert(rng.randint(0, len(words)), rng.choice(["Grobian", "lump,", "SCHUFT!"]))
        rows.append((i, " ".join(w + "." * (rng.random() < 0.1) for w in words)))
        labels.append((i, int(bad) if rng.random() > 0.03 else int(not bad)))
    return rows, labels


def test_spans_and_scores_of_a_small_corpus(spark):
    rows, labels = corpus(spark)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, score string, _id int")
    model = tx.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r.doc_id: r for r in tx.with_score(docs, model, keep_text=True).collect()}
    assert len(got) == len(rows) and got[0]._id == 1
    for i, text in rows:
        bad = {(m.start(), m.end()) for w in ("Grobian", "lump", "SCHUFT") for m in tx.re.finditer(rf"{w}\S*", text)}
        covered = {(m.start(), m.end()) for m in tx.re.finditer(r"\S+", text) if any(s["start"] <= m.start() and m.end() <= s["end"] for s in got[i].spans)}
        assert covered == bad and (got[i].score >= tx.ACCEPT) == bool(bad)


def test_op13_held_out(spark):
    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in q.QUERIES["op13_toxic_spans"](spark, folder).collect()}
    texts = {r.doc_id: r.text for r in q.table(spark, folder, "documents").collect()}
    assert got.keys() == texts.keys()
    words = "idiot clown worthless disgusting trash scum moron loser pathetic stupid".split()
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
        assert r.predicted == any(w in texts[i].lower() for w in words), i
    labelled = [(got[r.doc_id], r.toxic) for r in q.table(spark, folder, "labels").collect()]
    held = [(r.predicted, y) for r, y in labelled if r.held_out]
    assert np.mean([p == y for p, y in held]) > 0.93


def test_odd_rows(spark):
    odd = [None, "", " \n ", ".", "%%% !!! 12", "é" * 3000, "word " * 20_000, "no\u0000nul \U0001f600 smile."]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(odd)] + [(None, "a b"), (0, "c d")], "doc_id long, text string")
    for labels in ([(None, 1), (0, 1), (0, 0), (1, None)], [(4, 1)], [(1, 0), (2, 0)], [(3, 1), (6, 0), (0, 1), (0, 1)]):
        model = tx.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        scored = tx.with_score(docs, model).collect()
        assert len(scored) == len(odd) + 2 and all(0 <= r.score <= 1 for r in scored)
    assert [r.n_words for r in tx.with_marginals(docs, tx.Field()).where("doc_id is not null").orderBy("doc_id", "n_words").collect()][-1] == 3
    none = docs.where("false")
    assert tx.with_score(none, tx.fit(none, spark.createDataFrame([], "doc_id long, toxic int"))).count() == 0


def test_fit_sample_is_bounded(spark):
    rows, labels = corpus(spark, 400)
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    few = tx._draw(known, tx.F.xxhash64("doc_id"), 30, known.count())
    assert few.count() == 30
    model = tx.fit(docs, known, fit_rows=200, fit_pieces=600)
    assert tx.with_score(docs, model).where(f"score >= {tx.ACCEPT}").count() == pytest.approx(sum("Grobian" in t or "lump" in t or "SCHUFT" in t for _, t in rows), abs=4)


def test_rare_toxic_words_of_short_texts_are_learnt(spark):
    """One toxic text in ten is short and has a word of its own, whose sentences a plain draw of pieces hardly meets."""
    rng = random.Random(3)
    word = lambda: "w" + "".join(rng.choice("abcdefgh") for _ in range(3))
    rows, labels = [], []
    for i in range(1200):
        bad, short = i % 2 == 1, i % 20 in (0, 1)
        sentences = [" ".join(word() for _ in range(6)) + "." for _ in range(1 if short else 25)]
        if bad:
            sentences[0] = f"{word()} {'qrrt' if short else 'xnasty'} " + sentences[0]
        rows.append((i, " ".join(sentences)))
        labels.append((i, int(bad)))
    docs, truth = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = tx.fit(docs, truth, fit_pieces=600)
    scored = tx.with_score(docs, model).join(truth, "doc_id").where(tx.held_out()).toPandas()
    clean = scored[scored.toxic == 0]["score"].max()
    rare = scored[(scored.toxic == 1) & (scored.doc_id % 20 == 1)]["score"]
    assert len(rare) > 10 and (rare > clean).all()
