"""Periodic runs against a plain search over all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from custlens.llm import periodic_runs as pr
from custlens.llm import queries as q


def plain(words):
    """(start, length, period) of all runs, by start, then period."""
    out = []
    for p in range(1, len(words) // 4 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            length = j + p - i
            if j > i and length >= max(6, 4 * p):
                own = words[i : j + p]
                if not any(own[d:] == own[:-d] for d in range(1, p)):
                    out.append((i, length, p))
            i = max(j, i) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def stitched(texts):
    """Runs per list of words, by the module's fragments, joined here on the driver."""
    out = []
    for found in pr.fragments_of(texts):
        whole = []
        for p, a, b in sorted(found):
            if whole and whole[-1][0] == p and a <= whole[-1][2]:
                whole[-1][2] = max(b, whole[-1][2])
            else:
                whole.append([p, a, b])
        out.append(sorted([(a, b + p - a, p) for p, a, b in whole if b + p - a >= max(6, 4 * p)], key=lambda r: (r[0], r[2])))
    return out


def some_texts(rng, n, most):
    for _ in range(n):
        letters = "abcd"[: rng.choice([1, 2, 2, 3, 4])]
        words = []
        while len(words) < rng.randint(0, most):
            unit = [rng.choice(letters) for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 13, 40]))]
            words += (unit * rng.choice([1, 1, 2, 4, 5, 9]))[: rng.randint(1, 200)]
        yield words


def test_fragments_equal_plain_search():
    rng = random.Random(5)
    texts = list(some_texts(rng, 250, 300))
    assert stitched(texts) == [plain(t) for t in texts]
    assert sum(map(len, map(plain, texts))) > 500


@pytest.mark.parametrize("cells", [1, 7, 64])
def test_pieces_of_any_size(monkeypatch, cells):
    monkeypatch.setattr(pr, "CELLS", cells)
    texts = list(some_texts(random.Random(cells), 30, 120))
    assert stitched(texts) == [plain(t) for t in texts]


def test_long_and_hard_texts():
    unary, fibonacci, thue = ["a"] * 5000, ["a"], ["a"]
    older = ["b"]
    while len(fibonacci) < 2000:
        fibonacci, older = fibonacci + older, fibonacci
    while len(thue) < 4096:
        thue = thue + ["b" if w == "a" else "a" for w in thue]
    nested = (["a"] * 7 + ["b"]) * 50 + ["c"] + (["a"] * 7 + ["b"]) * 50 + ["c"]
    unit = [str(i) for i in range(999)]
    texts = [unary, fibonacci, thue, nested * 5, unit * 4, unit * 4 + ["0"], unit * 3 + unit[:-1], [str(i) for i in range(3000)], []]
    found = stitched(texts)
    assert found[0] == [(0, 5000, 1)] and found[2] == [] and found[4] == [(0, 3996, 999)] and found[5] == [(0, 3997, 999)] and found[6] == []
    assert found[1] == plain(fibonacci) and found[3] == plain(nested * 5)
    big = [*map(str, range(100)), *(unit * 40), *(["x"] * 100_000)]
    assert stitched([big]) == [[(100, 39960, 999), (40060, 100_000, 1)]]


def test_hash_clash_is_seen_and_hashed_anew(monkeypatch):
    real = pr._Hashes.equal
    monkeypatch.setattr(pr._Hashes, "equal", lambda self, a, b, n: real(self, a, b, n) | (self.seed == 0))
    init = pr._Hashes.__init__
    monkeypatch.setattr(pr._Hashes, "__init__", lambda self, codes, seed: (init(self, codes, seed), setattr(self, "seed", seed))[0])
    texts = list(some_texts(random.Random(9), 20, 100))
    assert stitched(texts) == [plain(t) for t in texts]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def want(doc_id, text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    if doc_id is not None and words:
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain(words)
    gone = {i for s, m, p in runs for i in range(s + p, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    exponent = best[0] is not None and 1000 * best[1] // best[2]
    return (doc_id, len(runs), *best, exponent if best[0] is not None else None, sha("".join("%d,%d,%d\n" % r for r in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_op12_equals_plain_search(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in q.table(spark, folder, "documents").collect()]
    got = q.QUERIES["op12_periodic_runs"](spark, folder)
    assert got.dtypes == [("doc_id", "bigint"), *[(c, "bigint") for c in ("n_runs", "start", "length", "period", "exponent_milli")], ("runs_sha256", "string"), ("collapsed_sha256", "string")]
    found = sorted(map(tuple, got.collect()))
    assert found == sorted(want(*r) for r in rows) and sum(r[1] > 0 for r in found) > 5


def test_odd_rows_and_clashing_names(spark):
    rng = random.Random(1)
    texts = [None, "", " \n ", "a", "a " * 5, "a " * 6, "\ta\x0ba\x0ca\ra\na a", "é ü " * 9, "a b " * 8] + ["".join(rng.choice(["a ", "b ", "a a ", "\n"]) for _ in range(rng.randint(1, 90))) for _ in range(60)]
    rows = [(i, t, "mine", i) for i, t in enumerate(texts)] + [(None, "a " * 8, "n", 0)] * 2 + [(3, "b " * 4000, "big", 7)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string, _row int")
    got = pr.periodic_runs(df)
    assert got.columns == ["doc_id", "text", "_row", "n_words", "runs", "collapsed"]
    found = sorted((str(r.doc_id), r.text or "", r.n_words, str([tuple(x) for x in r.runs]), r.collapsed) for r in got.collect())
    expect = []
    for i, t, _, _ in rows:
        words = re.findall("[^\x20\x09-\x0d]+", t or "")
        runs = plain(words)
        gone = {k for s, m, p in runs for k in range(s + p, s + m)}
        expect.append((str(i), t or "", len(words), str(runs), " ".join(w for k, w in enumerate(words) if k not in gone)))
    assert found == sorted(expect)
    assert pr.periodic_runs(df.where("false")).count() == 0 and pr.periodic_runs(df.select("text"), keep_text=False).columns == ["n_words", "runs", "collapsed"]


def test_fragments_of_one_run_from_several_tasks_are_stitched(spark):
    rows = [(0, 2, 0, 10), (0, 2, 10, 20), (0, 2, 21, 25), (0, 3, 0, 12), (1, 2, 15, 24), (1, 2, 0, 3), (0, 2, 5, 8)]
    got = pr.stitch(spark.createDataFrame(rows, "_row long, period long, first long, last long")).collect()
    assert sorted(map(tuple, got)) == [(0, 0, 15, 3), (0, 0, 22, 2), (1, 15, 11, 2)]
    assert np.array_equal(pr._least_factors(12), [0, 1, 2, 3, 2, 5, 2, 7, 2, 3, 2, 11, 2])
