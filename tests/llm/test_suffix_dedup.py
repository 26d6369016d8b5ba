"""Removed bytes against a table of all windows."""

import hashlib
import random

import numpy as np
import pytest

from custlens.llm import queries as q
from custlens.llm import suffix_dedup as sd
from custlens.runtime import materialize

FOLDER = "/root/testdata/sf0.001"


def brute(texts, length):
    """Per text the maximal runs of bytes that a repeated window covers."""
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for d, r in enumerate(raw):
        for i in range(len(r) - length + 1):
            seen.setdefault(r[i : i + length], []).append((d, i))
    hit = [bytearray(len(r)) for r in raw]
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                hit[d][i : i + length] = b"\1" * length
    out = []
    for h in hit:
        edges = [i for i in range(len(h) + 1) if (h[i] if i < len(h) else 0) != (h[i - 1] if i else 0)]
        out.append(list(zip(edges[::2], edges[1::2])))
    return out


def corpus(rng, n=60, length=40):
    """Random texts with shared passages at random places, repeats inside a text, runs of one letter, and copies."""
    letters = "abcé "
    word = lambda k: "".join(rng.choice(letters) for _ in range(k))
    passages = [word(k) for k in (length - 5, length, length + 3, 3 * length, 8 * length)]
    out = []
    for _ in range(n):
        t = word(rng.randrange(150))
        for _ in range(rng.randrange(4)):
            t += rng.choice([*passages, "z" * rng.randrange(90), "xy" * rng.randrange(60)]) + word(rng.randrange(60))
        out.append(t)
    return [*out, *out[:8], None, None, "", "", "z" * length, "z" * length, "q" * (length + 1), "short", "short"]


@pytest.mark.parametrize("hot", [sd.HOT, 5, 1])
def test_spans_equal_brute_force(spark, hot):
    texts = corpus(random.Random(hot))
    rows = [(i if i % 7 else None, t, i, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int, row string")
    got = sd.without_spans(sd.repeated_spans(df, length=40, gram=16, hot=hot)).orderBy("n").collect()
    want = brute(texts, 40)
    for r, t, spans in zip(got, texts, want):
        assert [(s.start, s.end) for s in r.spans] == spans
        raw = (t or "").encode()
        assert bytes(r.kept) == b"".join(raw[a:b] for a, b in zip([0, *[e for _, e in spans]], [*[s for s, _ in spans], len(raw)]))


def test_long_texts_are_sampled_in_stretches(spark, monkeypatch):
    rng = random.Random(9)
    text = "".join(rng.choice("abcdef") for _ in range(9000)).encode()
    whole = sd.anchors(text, 40, 16)
    monkeypatch.setattr(sd, "STRETCH", 512)
    parts = sd.anchors(text, 40, 16)
    covered = sorted((a, f, l) for _, a, f, l in zip(*(c.tolist() for c in parts)))
    assert [s for _, f, l in covered for s in range(f, l + 1)] == list(range(len(text) - 39))
    own = lambda p: {s: a for _, a, f, l in zip(*(c.tolist() for c in p)) for s in range(f, l + 1)}
    assert len({a for _, a, _, _ in zip(*(c.tolist() for c in parts))}) == len(parts[1])
    # the sample's low bits are wider than the patched stretch, so anchors stay the same
    assert own(parts).keys() == own(whole).keys()


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert sd.without_spans(sd.repeated_spans(df)).count() == 0


def test_op5_equals_brute_force(spark):
    docs = q.table(spark, FOLDER, "documents").select("doc_id", "text").collect()
    want = dict(zip([d.doc_id for d in docs], brute([d.text for d in docs], 400)))
    texts = {d.doc_id: (d.text or "").encode() for d in docs}
    rows = q.QUERIES["op5_suffix_dedup"](spark, FOLDER).collect()
    assert len(rows) == len(docs) and sum(r.n_removed for r in rows) > 0
    for r in rows:
        raw, spans = texts[r.doc_id], want[r.doc_id]
        kept = b"".join(raw[a:b] for a, b in zip([0, *[e for _, e in spans]], [*[s for s, _ in spans], len(raw)]))
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest())


def test_columns_with_inner_names_are_carried(spark):
    rng = random.Random(12)
    passage = "".join(rng.choice("abcdefg ") for _ in range(500))
    rows = [(i, passage * (i < 2) + "".join(rng.choice("hijk ") for _ in range(50)), f"r{i}", i * 2, f"c{i}", f"d{i}") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string, code int, _input string, data string").repartition(2)
    got = sd.repeated_spans(materialize(df))
    assert got.columns == ["doc_id", "text", "row", "code", "_input", "data", "spans"]
    for r in got.collect():
        assert (r.row, r.code, r._input, bytes(r.data).decode()) == (f"r{r.doc_id}", r.doc_id * 2, f"c{r.doc_id}", r.text) and bool(r.spans) == (r.doc_id < 2)


def test_windows_of_many_parts_are_decided_on_bytes(spark, monkeypatch):
    """Fingerprints that clash everywhere: the bytes still decide."""
    monkeypatch.setattr(sd, "_fingerprints", lambda text, length: [np.zeros(max(0, len(text) - length + 1), np.int64)] * 2)
    rng = random.Random(13)
    common = "".join(rng.choice("ab") for _ in range(40))
    texts = ["".join(rng.choice("cdef") for _ in range(rng.randint(0, 90))) + common + "".join(rng.choice("gh") for _ in range(30)) for _ in range(40)]
    df = materialize(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in sd.repeated_spans(df, length=30, gram=12, hot=4).collect()}
    assert got == dict(enumerate(brute(texts, 30)))
