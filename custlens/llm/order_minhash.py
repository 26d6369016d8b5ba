"""Near-duplicate classes by order min-hash (Marçais, DeBlasio, Pandey and Kingsford, 2019) and banded alignment.

The k-mers of a text are its runs of five words, labelled by how often they occurred before. Each of `sketches` hash
functions takes the `LEAST` labelled k-mers with the smallest hashes and keeps them in text order; their hash is the entry of
the sketch. Texts with an equal entry are candidates, which grows with edit similarity: words that moved elsewhere change
the order. Sketches find a pair with a probability only, too small a one for short texts: texts of up to `SHORT` words also get
entries that miss no pair (`_exact_entries`), beside the first `SHORT_SKETCHES` sketches; texts that can be near a longer one have
all of them. A candidate pair is a link if a banded alignment of the words has an edit similarity of at least `SIMILAR`.
Classes are the connected components of the links.

Equal texts are one node. Sketches are worked off in layers, few first. In a layer each class found so far is listed once per
entry, so a group of copies, however large, costs a row per entry and not one per member. Entries that hold several classes
have all of them meet the smallest id first. Where classes then still differ, all members of the entry are listed; a member
outside the entry's largest class meets those of other classes, first one member of each entry, then all of them, and only if
two bounds on the edit distance (lengths, and counts of words in 256 cells) let them. Of entries with the same members, by a
128-bit fingerprint, one is settled, in whatever layer. No entry is one task and no member is left out: a pair inside one
class already needs no comparison, any other is compared.

Defined cases: a null text is an empty one. Texts without words are near only to equal texts. Rows that share an id are one document. `near_duplicates` leaves rows with a null id out,
`near_duplicates_of_all` does not. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custlens.functions.ordering import global_rank
from custlens.llm import alignment
from custlens.llm.batches import add_columns
from custlens.llm.bpe import hash_tables
from custlens.llm.text_stats import BLANK
from custlens.operators.dbscan import components
from custlens.runtime import materialize, ship_package, stage_tables

WORDS = 5
LEAST = 2
# With words replaced at random places, 192 entries find 99.5 % of the pairs of 129 words at edit similarity 0.8, more of longer ones.
SKETCHES = 192
# Sketches of each layer; the exact entries of short texts join the second one.
LAYERS = (2, 22, 84, 84)
SIMILAR = 0.8
# Pairs of texts of up to SHORT words are found exactly: up to DELETED words by what some deletions leave, beyond by runs of RUN words.
SHORT = 128
DELETED = 15
RUN = 4
SHORT_SKETCHES = 8
CELLS = 256
# Members of an entry that one matrix of comparisons holds on each side.
BLOCK_MEMBERS = 512

SETTLED = "n long, mark0 long, mark1 long"

_MIX = np.uint64(0xBF58476D1CE4E5B9)
_NEXT = np.uint64(0x9FB21C651E98DF25)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def _edits(words: int) -> int:
    """Most edits of a near pair whose longer text has `words` words."""
    return int(np.floor((1 - SIMILAR) * words + 1e-9))


# A text of fewer words is near no text of more than SHORT words: it needs no sketch beside its exact entries.
SKETCHED = SHORT + 1 - _edits(SHORT + 1)


Ragged = tuple[np.ndarray, np.ndarray]


def sketch(texts: list[str | None], sketches: int = SKETCHES) -> tuple[np.ndarray, np.ndarray, Ragged, Ragged]:
    """Per text: its words, and its words per cell, at most 255 each; its sketches and its exact entries, each as the texts' places, in order, and values."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
    end = np.cumsum([len(r) + 1 for r in raw])
    blank = BLANK[data]
    was_blank = np.concatenate([[True], blank[:-1]])
    lo, hi = np.flatnonzero(~blank & was_blank), np.flatnonzero(blank & ~was_blank)
    doc = np.searchsorted(end, lo, "right")
    n = len(texts)
    words = np.bincount(doc, minlength=n)
    cells = np.zeros((n, CELLS), np.uint8)
    none = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if not len(lo):
        return words, cells, none, none
    table, powers, inverse = hash_tables(len(data), 3)
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(table[data] * powers[: len(data)])])
    word = _mix((prefix[hi] - prefix[lo]) * inverse[lo])
    for a in range(0, n, 512):
        part = (doc >= a) & (doc < a + 512)
        count = np.bincount((doc[part] - a) * CELLS + (word[part] >> np.uint64(56)).astype(np.int64), minlength=512 * CELLS)
        cells[a : a + 512] = np.minimum(count, 255).reshape(512, CELLS)[: n - a]

    first = np.cumsum(words) - words
    place = np.arange(len(word)) - first[doc]
    owners, keys = [], []
    for some, count in ((words >= SKETCHED, sketches), ((words >= WORDS + LEAST - 1) & (words < SKETCHED), min(sketches, SHORT_SKETCHES))):
        found = _sketches(word, doc, words, place, some, count)
        owners.append(np.repeat(np.flatnonzero(some), count))
        keys.append(found.ravel())
    owner, key = np.concatenate(owners), np.concatenate(keys)
    order = np.argsort(owner, kind="stable")
    return words, cells, (owner[order], key[order]), _exact_entries(word, doc, words, place, first)


def _sketches(word: np.ndarray, doc: np.ndarray, words: np.ndarray, place: np.ndarray, chosen: np.ndarray, sketches: int) -> np.ndarray:
    """The first `sketches` entries of each chosen text."""
    some = np.flatnonzero(chosen)
    keys = np.zeros((len(some), sketches), np.uint64)
    if not len(some):
        return keys
    at = np.flatnonzero(chosen[doc] & (place <= words[doc] - WORDS))
    gram = np.zeros(len(at), np.uint64)
    for k in range(WORDS):
        gram = gram * _NEXT + word[at + k]
    gram, owner = _mix(gram), doc[at]
    label = _occurrence(gram ^ _mix(owner.astype(np.uint64) + np.uint64(1)))
    gram = _mix(gram + label.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
    each = np.bincount(owner, minlength=len(words))[some]
    rank = np.repeat(np.arange(len(some)), each)
    # the two smallest of many hashes are sought among those below about 24 / their number; should they not be there, among all
    limit = np.repeat(np.where(each > 48, 24 / np.maximum(each, 1) * 2.0**64, 2.0**64 - 2**12).astype(np.uint64), each)
    everywhere = np.arange(len(gram))
    highest = np.iinfo(np.uint64).max
    factors = np.random.default_rng(11).integers(1, 2**63, max(sketches, SKETCHES), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    turned = gram ^ (gram >> np.uint64(32))
    for s in range(sketches):
        hashes = turned * factors[s]
        low = np.flatnonzero(hashes < limit)
        count = np.bincount(rank[low], minlength=len(some))
        if count.min() < LEAST:
            low, count = everywhere, each
        h, start = hashes[low], np.cumsum(count) - count
        taken = []
        for _ in range(LEAST):
            best = np.flatnonzero(h == np.repeat(np.minimum.reduceat(h, start), count))
            best = best[np.concatenate([[True], np.diff(rank[low[best]]) > 0])]
            taken.append(low[best])
            h[best] = highest
        entry = np.full(len(some), np.uint64(s + 1))
        for best in np.sort(np.array(taken), axis=0):
            entry = _mix(entry * _NEXT + gram[best])
        keys[:, s] = entry
    return keys


def _exact_entries(word: np.ndarray, doc: np.ndarray, words: np.ndarray, place: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of texts and entries of which any two near texts of up to SHORT words share one.

    Let the longer text have n words, so that the pair has e = `_edits(n)` edits at most. From 16 words on it holds e + 1 runs
    of RUN words that do not overlap, one of which no edit touches, and the other text has that run too. Up to DELETED words
    both leave the same words after at most e deletions in the longer and no more than `_edits` of its own words in the shorter.
    """
    # the shorter of two texts, the longer of which has more than DELETED words
    least = DELETED + 1 - _edits(DELETED + 1)
    at = np.flatnonzero((words[doc] >= least) & (words[doc] <= SHORT) & (place <= words[doc] - RUN))
    run = np.full(len(at), np.uint64(0x51ED27))
    for k in range(RUN):
        run = run * _NEXT + word[at + k]
    owners, entries = [doc[at]], [_mix(run)]
    for n in range(1, DELETED + 1):
        texts = np.flatnonzero(words == n)
        if not len(texts):
            continue
        own = word[first[texts][:, None] + np.arange(n)]
        for left in range(n - _edits(n), n + 1):
            kept = np.array(list(combinations(range(n), left)))
            code = np.full((len(texts), len(kept)), np.uint64(0x2545F4 + left))
            for k in range(left):
                code = code * _NEXT + own[:, kept[:, k]]
            owners.append(np.repeat(texts, len(kept)))
            entries.append(_mix(code).ravel())
    owner, entry = np.concatenate(owners), np.concatenate(entries)
    order = np.lexsort((entry, owner))
    owner, entry = owner[order], entry[order]
    fresh = np.ones(len(owner), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (entry[1:] != entry[:-1])
    return owner[fresh], entry[fresh]


def _occurrence(code: np.ndarray) -> np.ndarray:
    """How many equal codes stand before each."""
    order = np.argsort(code, kind="stable")
    ranked = code[order]
    fresh = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    out = np.empty(len(code), np.int64)
    out[order] = np.arange(len(code)) - np.maximum.accumulate(np.where(fresh, np.arange(len(code)), 0))
    return out


def with_sketches(df: DataFrame, text: str) -> DataFrame:
    """`df` without its text, with `_words`, `_sketches`, `_exact` (both empty for a text without words) and `_cells`."""

    def compute(texts: list) -> list[pa.Array]:
        words, cells, *ragged = sketch(texts)
        lists = [pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.bincount(o, minlength=len(texts)))).astype(np.int32)), pa.array(e.view(np.int64))) for o, e in ragged]
        counts = pa.array([c.tobytes() for c in cells], pa.binary())
        return [pa.array(words, pa.int64()), *lists, counts]

    longs = T.ArrayType(T.LongType(), False)
    fields = [T.StructField("_words", T.LongType()), T.StructField("_sketches", longs), T.StructField("_exact", longs), T.StructField("_cells", T.BinaryType())]
    return add_columns(df, text, fields, compute, keep_text=False)


def _lengths_allow(a: str, b: str) -> Column:
    return F.least(a, b) >= F.lit(SIMILAR) * F.greatest(a, b) - F.lit(1e-9)


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs `u`, `v` whose texts (`id`, `text`) align well enough, with their `similarity`."""
    ship_package(pairs.sparkSession)
    sides = [texts.select(F.col("id").alias(c), F.col("text").alias(f"{c}_text")) for c in "uv"]
    joined = pairs.select("u", "v").join(sides[0], "u").join(sides[1], "v")

    @F.pandas_udf("double")
    def score(columns: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in columns:
            yield pd.Series([alignment.similarity(_split(x), _split(y), SIMILAR) for x, y in zip(a, b)], dtype=float)

    return joined.select("u", "v", score("u_text", "v_text").alias("similarity")).where(F.col("similarity") >= SIMILAR)


def _split(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()


def contracted_components(found: DataFrame) -> DataFrame:
    """(node, root): the smallest reachable id of each linked node.

    Every node is first drawn into its smallest neighbour; only links between such neighbours, a small graph of hubs,
    go through the rounds of the general algorithm.
    """
    edges = found.select(F.least("u", "v").alias("hub"), F.greatest("u", "v").alias("node")).where("hub <> node")
    drawn = materialize(edges.groupBy("node").agg(F.min("hub").alias("into"), F.max("hub").alias("_last"), F.array_sort(F.collect_set("hub")).alias("hubs")))
    between = drawn.where("into <> _last").select(F.col("into").alias("u"), F.explode("hubs").alias("v")).where("u <> v")
    # a hub that was drawn into another one hands its nodes on
    between = materialize(between.unionByName(drawn.select(F.col("into").alias("u"), F.col("node").alias("v")).join(edges.select(F.col("hub").alias("v")).distinct(), "v", "left_semi").select("u", "v")).distinct())
    hubs = edges.select(F.col("hub").alias("node"), F.col("hub").alias("into")).distinct()
    ends = drawn.select("node", "into").unionByName(hubs)
    if between.isEmpty():
        return ends.groupBy("node").agg(F.min("into").alias("root"))
    roots = components(between).withColumnRenamed("node", "into")
    return ends.join(roots, "into", "left").groupBy("node").agg(F.min(F.coalesce("root", "into")).alias("root"))


def links(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Classes (node, root) of distinct texts that have links. `nodes`: `id` and the columns of `with_sketches`, `texts`: `id`, `text`; both written tables.

    Every candidate pair is either verified, or its two texts are in one class through other links.
    """
    spark, begin = nodes.sparkSession, 0
    classes, settled = spark.createDataFrame([], "node long, root long"), spark.createDataFrame([], SETTLED)
    for layer, count in enumerate(LAYERS):
        part = F.slice("_sketches", begin + 1, count)
        entries = nodes.select("id", (F.concat(part, "_exact") if layer == 1 else part).alias("entries")).where("size(entries) > 0")
        with stage_tables(spark) as keep:
            classes, now = _layer(entries, nodes, texts, classes, settled, first=layer == 0)
            classes, settled = keep(classes), settled if now is None else keep(settled.unionByName(now))
        begin += count
    return classes


def _layer(entries: DataFrame, nodes: DataFrame, texts: DataFrame, classes: DataFrame, settled: DataFrame, first: bool) -> tuple[DataFrame, DataFrame | None]:
    """`classes` after all candidate pairs of the `entries` (`id`, `entries`) of a layer, and fingerprints of the entries settled member by member."""
    if first:
        listed = entries.select(F.explode("entries").alias("entry"), "id", F.col("id").alias("root"))
    else:
        placed = entries.join(classes.withColumnRenamed("node", "id"), "id", "left")
        linked = placed.where("root is not null").select(F.explode("entries").alias("entry"), "id", "root")
        single = placed.where("root is null").select(F.explode("entries").alias("entry"), "id", F.col("id").alias("root"))
        listed = linked.groupBy("entry", "root").agg(F.min("id").alias("id")).select("entry", "id", "root").unionByName(single)
    several = listed.groupBy("entry").agg(F.min("root").alias("first_root"), F.max("root").alias("_high")).where("first_root < _high")
    # written, so that Spark knows its size and need not deal out all entries if it is small
    several = materialize(several.select("entry", "first_root"))
    crossing = materialize(listed.join(several, "entry"))
    # a class is listed once per entry: one row has the smallest root
    crossing = crossing.join(crossing.where("root = first_root").select("entry", F.col("id").alias("first")), "entry")
    sizes = nodes.select("id", "_words")
    star = crossing.where("root <> first_root").select(F.col("first").alias("u"), F.col("id").alias("v"), F.col("first_root").alias("uroot"), F.col("root").alias("vroot")).distinct()
    star = star.join(sizes.select(F.col("id").alias("u"), F.col("_words").alias("_u")), "u").join(sizes.select(F.col("id").alias("v"), F.col("_words").alias("_v")), "v")
    star = materialize(star.where(_lengths_allow("_u", "_v")).select("u", "v", "uroot", "vroot"))
    classes = _joined(star, texts, classes)

    # entries whose classes still differ: all their members
    still = crossing.join(classes.withColumnRenamed("node", "id"), "id", "left").groupBy("entry", "first").agg(F.min(F.coalesce(classes["root"], "id")).alias("_low"), F.max(F.coalesce(classes["root"], "id")).alias("_high"))
    still = materialize(still.where("_low < _high").select("entry", "first"))
    if still.isEmpty():
        return classes, None
    members = crossing.select("entry", "id") if first else crossing.select("entry", "id").unionByName(linked.select("entry", "id")).distinct()
    members = materialize(members.join(still, "entry").join(sizes, "id").select("entry", "id", "first", "_words"))
    marks = [F.bit_xor(F.xxhash64("id", F.lit(k))).alias(f"mark{k}") for k in range(2)]
    alike = members.groupBy("entry").agg(F.count("*").alias("n"), *marks).join(settled, ["n", "mark0", "mark1"], "left_anti")
    alike = materialize(alike.groupBy("n", "mark0", "mark1").agg(F.min("entry").alias("entry")))
    members = materialize(members.join(alike.select("entry"), "entry", "left_semi"))
    # one member of each entry first: most classes that belong together meet by it
    for meet in (_first_apart, _all_apart):
        pairs = materialize(meet(_mixed(members, classes, nodes)))
        classes = _joined(pairs, texts, classes)
    return classes, alike.drop("entry")


def _joined(pairs: DataFrame, texts: DataFrame, classes: DataFrame) -> DataFrame:
    """`classes` after verifying `pairs` (`u`, `v`, in classes `uroot`, `vroot`; a written table)."""
    if pairs.isEmpty():
        return classes
    asked = pairs.select(F.col("u").alias("id")).unionByName(pairs.select(F.col("v").alias("id"))).distinct()
    used = materialize(texts.join(asked, "id", "left_semi"))
    near = materialize(verified(pairs, used).select("u", "v"))
    return _merged(classes, materialize(near.join(pairs, ["u", "v"]).select(F.col("uroot").alias("u"), F.col("vroot").alias("v")).distinct()))


def _mixed(several: DataFrame, classes: DataFrame, nodes: DataFrame) -> DataFrame:
    """Members of buckets that hold several classes, with their class `root`, the bucket's `largest` class and their cells."""
    placed = several.join(classes.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    sizes = placed.groupBy("entry", "root").agg(F.count("*").alias("_n"))
    largest = sizes.groupBy("entry").agg(F.max_by("root", F.struct("_n", "root")).alias("largest"), F.count("*").alias("_classes")).where("_classes > 1")
    mixed = materialize(placed.join(largest.select("entry", "largest"), "entry"))
    return mixed.join(nodes.select("id", "_cells"), "id")


def _first_apart(mixed: DataFrame) -> DataFrame:
    """Pairs `u`, `v` of one entry in different classes `uroot`, `vroot`, where bounds let them be near; `u` is the smallest member outside the entry's largest class."""
    asking = mixed.where("root <> largest and id <> first")
    asking = asking.join(asking.groupBy("entry").agg(F.min("id").alias("id")), ["entry", "id"], "left_semi")
    left = asking.select("entry", *[F.col(c).alias(f"u{c}") for c in ("id", "root", "_words", "_cells")])
    right = mixed.where("id <> first").select("entry", *[F.col(c).alias(f"v{c}") for c in ("id", "root", "_words", "_cells")])
    near = (F.col("uroot") != F.col("vroot")) & _lengths_allow("u_words", "v_words")
    joined = left.join(right, (left["entry"] == right["entry"]) & near).where(_cells_allow("u_cells", "v_cells", "u_words", "v_words"))
    return joined.select(F.col("uid").alias("u"), F.col("vid").alias("v"), "uroot", "vroot").distinct()


def _all_apart(mixed: DataFrame) -> DataFrame:
    """All such pairs. Members of an entry are cut into blocks of about `BLOCK_MEMBERS`; each pair of blocks is one task's matrix, and only pairs within the bounds leave it."""
    ship_package(mixed.sparkSession)
    blocks = mixed.groupBy("entry").agg(F.ceil(F.count("*") / F.lit(BLOCK_MEMBERS)).cast("int").alias("blocks"))
    dealt = mixed.join(blocks, "entry").withColumn("block", F.pmod(F.xxhash64("id", F.lit(9)), F.col("blocks")).cast("int"))
    packed = dealt.groupBy("entry", "block", "blocks").agg(F.collect_list(F.struct("id", "root", "_words", "_cells")).alias("m"))
    sides = [[F.col(f"m.{c}").alias(f"{side}{c}") for c in ("id", "root", "_words", "_cells")] for side in "uv"]
    left = packed.select("entry", "block", F.explode(F.sequence("block", F.col("blocks") - 1)).alias("other"), *sides[0])
    right = packed.select("entry", F.col("block").alias("other"), *sides[1])

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                u, v, uroot, vroot, n, m = (np.asarray(c) for c in (r.uid, r.vid, r.uroot, r.vroot, r.u_words, r.v_words))
                a, b = (np.frombuffer(b"".join(c), np.uint8).reshape(-1, CELLS).astype(np.int16) for c in (r.u_cells, r.v_cells))
                for i in range(len(u)):
                    longer, shorter = np.maximum(n[i], m), np.minimum(n[i], m)
                    asked = np.flatnonzero((vroot != uroot[i]) & (shorter >= SIMILAR * longer - 1e-9) & ((v > u[i]) | (r.block != r.other)))
                    if len(asked):
                        gap = np.abs(b[asked] - a[i]).sum(axis=1, dtype=np.int32)
                        near = asked[gap <= 2 * np.floor((1 - SIMILAR) * longer[asked] + 1e-9)]
                        if len(near):
                            yield pd.DataFrame({"u": u[i], "v": v[near], "uroot": uroot[i], "vroot": vroot[near]})

    # one pair of blocks is a few hundred kilobytes: few of them at a time
    return left.join(right, ["entry", "other"]).drop("entry").mapInPandas(compare, "u long, v long, uroot long, vroot long").distinct()


def _merged(classes: DataFrame, joined: DataFrame) -> DataFrame:
    """`classes` after links `u`, `v` between roots."""
    if joined.isEmpty():
        return classes
    merged = contracted_components(joined).select(F.col("node").alias("root"), F.col("root").alias("whole"))
    alone = joined.select(F.col("u").alias("node")).unionByName(joined.select(F.col("v").alias("node"))).select("node", F.col("node").alias("root"))
    before = classes.unionByName(alone).distinct()
    return materialize(before.join(merged, "root", "left").select("node", F.coalesce("whole", "root").alias("root")))


@F.pandas_udf(T.BooleanType())
def _cells_allow(u: pd.Series, v: pd.Series, u_words: pd.Series, v_words: pd.Series) -> pd.Series:
    """One edit changes the counts of two cells by one each at most; counts stop at 255, which only lowers the difference."""
    a, b = (np.frombuffer(b"".join(c), np.uint8).reshape(-1, CELLS).astype(np.int16) for c in (u, v))
    return pd.Series(np.abs(a - b).sum(axis=1) <= 2 * np.floor((1 - SIMILAR) * np.maximum(u_words, v_words).to_numpy() + 1e-9))


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per id: `id`, `class_id` (the smallest id of its class), `text_id` (the smallest id with an equal text), `n_words`."""
    rows = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text")).where("id is not null")
    with stage_tables(df.sparkSession) as keep:
        return keep(_classes_per_id(rows))


def _classes_per_id(rows: DataFrame) -> DataFrame:
    """`near_duplicates` of `id`, `text`."""
    rows = rows.withColumn("code", F.unhex(F.sha2("text", 256)))
    named = materialize(rows.select("id", "code").distinct())
    equal = named.groupBy("code").agg(F.min("id").alias("text_id"))
    same = materialize(named.join(equal, "code").select("id", "code", "text_id"))
    # one row for each node; an id that stands for several texts has the sketches of one
    chosen = same.where("id = text_id").groupBy("id").agg(F.min("code").alias("code"))
    texts = materialize(rows.join(chosen, ["id", "code"], "left_semi").groupBy("id").agg(F.min("text").alias("text")))
    nodes = materialize(with_sketches(texts, "text"))
    classes = links(nodes, texts)
    sized = same.join(nodes.select(F.col("id").alias("text_id"), F.col("_words").alias("n_words")), "text_id")
    per_id = sized.groupBy("id").agg(F.min("text_id").alias("text_id"), F.max("text_id").alias("_last"), F.max("n_words").alias("n_words"))
    # an id with several texts ties them together
    several = per_id.where("text_id <> _last").select("id", F.col("text_id").alias("u"))
    if not several.isEmpty():
        tied = several.join(same.select("id", F.col("text_id").alias("v")), "id").where("u <> v").select("u", "v")
        classes = contracted_components(tied.unionByName(classes.select(F.col("root").alias("u"), F.col("node").alias("v"))))
    classes = classes.withColumnRenamed("node", "text_id")
    return per_id.join(classes, "text_id", "left").select("id", F.coalesce("root", "text_id").alias("class_id"), "text_id", "n_words")


def near_duplicates_of_all(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`near_duplicates`, and a row with a null `id` for each row with a null id.

    Each distinct text of such rows has a number of its own above all ids, which stands as `text_id` or `class_id` where no id does.
    """
    rows = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    nameless = materialize(rows.where("id is null").select("text", F.sha2("text", 256).alias("code")))
    if nameless.isEmpty():
        return near_duplicates(df, key, text)
    top = rows.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    numbers = global_rank(nameless.select("code").distinct(), [F.asc("code")], "_r").select("code", (F.col("_r") + top).alias("id"))
    numbers = materialize(numbers)
    named = nameless.dropDuplicates(["code"]).join(numbers, "code").select("id", "text")
    found = materialize(near_duplicates(rows.where("id is not null").unionByName(named), "id"))
    again = nameless.select("code").join(numbers, "code").join(found, "id").select(F.lit(None).cast("long").alias("id"), "class_id", "text_id", "n_words")
    return found.where(F.col("id") <= top).unionByName(again)
