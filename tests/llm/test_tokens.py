"""Token counts, codec and packing against the tokenizers library, on whole small tables and on odd texts."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from custlens.llm import bpe, bpe_codec, packing, token_counts
from custlens.llm import queries as q

FOLDER = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "  a", "a  ", "\n\n's\t'd a'm'm  'é", "don't  'll 's 'start I'rex '' 's'!", "x<|endoftext|>y  <|endoftext|>", "<|startoftext|> ΣΑΣ İ ﬁ",
    "éä ṩ", "aaaaaaaaa ab aaab", "1234 12a3 ²Ⅷ", "\x1c\x1d \x85 \xa0 　a", "日本語 한국어 🙂🙂", "same", "same", "word " * 400_000,
]


def library(path):
    return Tokenizer.from_file(path)


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, 9, "x") for i, t in enumerate(ODD)], "doc_id long, text string, n_tokens int, `extra col` string")


def random_texts(n=4000):
    rng = random.Random(5)
    return ["".join(rng.choice("ab 's\n\t!t1é É rvl<|m") for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("path", [q.BYTE_BPE, q.WORD_BPE])
def test_batches_equal_the_library(path):
    voc, texts = bpe.vocabulary(path), random_texts() + [t or "" for t in ODD[:-1]]
    want = [e.ids for e in library(path).encode_batch(texts, add_special_tokens=False)]
    assert token_counts.counts(voc, texts).tolist() == [len(w) for w in want]
    flat, count = bpe_codec.encode_batch(voc, texts)
    assert [x.tolist() for x in np.split(flat, np.cumsum(count)[:-1])] == want


def test_long_text_is_cut_where_nothing_crosses():
    voc, text = bpe.vocabulary(q.WORD_BPE), "abc def!  ghi 12 " * 200
    pieces = bpe.pieces_at_blanks(text, 300)
    assert "".join(pieces) == text and len(pieces) > 5
    assert sum(len(bpe_codec.encode_batch(voc, [p])[0]) for p in pieces) == len(library(q.WORD_BPE).encode(text, add_special_tokens=False).ids)


def test_forced_cuts_never_lie_inside_a_token():
    voc = bpe.vocabulary(q.WORD_BPE)
    assert not voc.joinable.all() and voc.joinable.any()
    words = [b"the", b"xqzj", b"\xff\xfe\x00"]
    ids, count = bpe_codec.cut_and_encode(voc, words)
    plain, plain_count = token_counts.merged(voc, words)
    assert ids.tolist() == plain.tolist() and count.tolist() == plain_count.tolist()


def test_op8_equals_library(spark):
    tok = library(q.BYTE_BPE)
    texts = {r.doc_id: r.text or "" for r in q.table(spark, FOLDER, "documents").collect()}
    for r in q.QUERIES["op8_token_counts"](spark, FOLDER).collect():
        n = len(tok.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(texts.pop(r.doc_id).encode()), n > 512)
    assert not texts


def test_op10_equals_library(spark):
    tok = library(q.WORD_BPE)
    texts = {r.doc_id: r.text or "" for r in q.table(spark, FOLDER, "documents").collect()}
    for r in q.QUERIES["op10_bpe_codec"](spark, FOLDER).collect():
        ids = tok.encode(texts.pop(r.doc_id), add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert not texts


def test_odd_rows(spark, odd):
    for path in (q.BYTE_BPE, q.WORD_BPE):
        tok = library(path)
        want = [len(tok.encode(t or "", add_special_tokens=False).ids) for t in ODD]
        rows = token_counts.count_tokens(odd, path).orderBy("doc_id").collect()
        assert [r.n_tokens for r in rows] == want and rows[0]["extra col"] == "x"
    rows = bpe_codec.encode(odd, q.WORD_BPE, decoded="text").orderBy("doc_id").collect()
    assert [len(r.ids) for r in rows] == want
    assert [r.text for r in rows] == [tok.decode(tok.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False) for t in ODD]


def test_empty_tables(spark, odd):
    none = odd.where("false")
    assert token_counts.count_tokens(none, q.BYTE_BPE).count() == 0
    assert bpe_codec.encode(none, q.WORD_BPE, decoded="d").count() == 0
    assert packing.pack(none.select("doc_id", packing.document_parts().alias("parts")), q.WORD_BPE, 2).count() == 0


def check_pieces(rows, want, limits):
    """Every token in exactly one piece, sequences gapless and within limits."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert by_doc.keys() == want.keys()
    for d, pieces in by_doc.items():
        pieces.sort(key=lambda r: r.start)
        ids = b"".join(bytes(p.ids) for p in pieces)
        assert np.frombuffer(ids, "<u4").tolist() == want[d]
        assert [p.start for p in pieces] == np.cumsum([0] + [p.length for p in pieces[:-1]]).tolist()
        assert {p.doc_tokens for p in pieces} == {len(want[d])}
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [p.offset for p in pieces] == np.cumsum([0] + [p.length for p in pieces[:-1]]).tolist()
        assert sum(p.length for p in pieces) <= limits.tokens and len(pieces) <= limits.segments and sum(p.loss_tokens for p in pieces) <= limits.loss
    return by_sequence


def test_packing_documents(spark):
    tok = library(q.WORD_BPE)
    docs = q.table(spark, FOLDER, "documents").select("doc_id", "text").union(spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string"))
    want = {r.doc_id: tok.encode(r.text or "", add_special_tokens=False).ids + [2] for r in docs.collect()}
    limits = packing.Limits()
    rows = packing.pack(docs.select("doc_id", packing.document_parts().alias("parts")), q.WORD_BPE, 2).collect()
    sequences = check_pieces(rows, want, limits)
    total = sum(map(len, want.values()))
    assert len(sequences) <= total / 4096 * 1.002 + docs.rdd.getNumPartitions() + 1
    got = {(r.doc_id, r.start): r.ids_crc32 for r in q.QUERIES["op1_vector_packing"](spark, FOLDER).collect()}
    for (d, start), crc in got.items():
        ends = [s for e, s in got if e == d and s > start]
        part = want[d][start : min(ends)] if ends else want[d][start:]
        assert crc == zlib.crc32(np.array(part, "<u4").tobytes())


def test_packing_holds_all_three_limits(spark):
    turns = q.table(spark, FOLDER, "conversations")
    limits = packing.Limits(tokens=512, segments=3, loss=200)
    examples = packing.conversation_examples(turns).withColumnRenamed("conv_id", "doc_id")
    tok = library(q.WORD_BPE)
    want = {r.doc_id: [i for p in r.parts for i in tok.encode(p.text or "", add_special_tokens=False).ids] + [2] for r in examples.collect()}
    rows = packing.pack(examples, q.WORD_BPE, 2, limits=limits).collect()
    check_pieces(rows, want, limits)
    assert sum(r.loss_tokens for r in rows) < sum(map(len, want.values()))


def test_packing_null_parts_and_ids(spark):
    df = spark.createDataFrame([(None, None), (1, []), (None, [(None, None)]), (2, [("a b", False), ("c", True)])], "doc_id long, parts array<struct<text string, loss boolean>>")
    rows = packing.pack(df, q.WORD_BPE, 2).orderBy("offset").collect()
    assert sum(r.length for r in rows) == 1 + 1 + 1 + 4 and [r.loss_tokens for r in rows if r.doc_id == 2] == [2]


def test_conversation_without_roles(spark):
    df = spark.createDataFrame([(1, 2, None, "b"), (1, 1, "Assistant", None)], "conv_id long, turn int, role string, text string")
    (row,) = packing.conversation_examples(df).collect()
    assert [(p.text, p.loss) for p in row.parts] == [(None, True), ("b", False)]
    assert packing.conversation_examples(df.where(F.lit(False))).count() == 0


def test_hash_tables_of_a_worker_do_not_pile_up():
    """A worker keeps one pair of tables for each of the seeds used last, whatever sizes and seeds it met."""
    table, powers, inverse = (x.copy() for x in bpe.hash_tables(1 << 20, 5))
    for n in (1 << 19, 1 << 21, 1 << 20):
        for seed in (3, 4, 5):
            t, p, i = bpe.hash_tables(n, seed)
            assert len(p) > n and len(i) > n
    assert (t == table).all() and (p[: len(powers)] == powers).all() and (i[: len(inverse)] == inverse).all()
    assert sum(len(x[1]) for x in bpe._hash_tables.values()) <= bpe.KEPT_TABLES * ((1 << 22) + 1)
