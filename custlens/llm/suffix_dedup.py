"""Removal of byte strings of `length` that start more than once in a corpus, by induced sorting of suffixes.

Sample. Of all k-grams inside a window of `length` bytes the one with the smallest hash (the leftmost, if tied) is its
anchor. Equal windows have equal anchors at equal offsets, so a window needs to be compared only with windows that share the
k-gram of its anchor, and an anchor whose k-gram occurs once leaves before any text is moved.

Sort. Suffixes that start at the anchors are sorted by Spark (k-gram, then the bytes that follow), which spills to disk: this
is the external queue of suffix tuples, and its runs are taken in batches of whole k-grams. From the order of the suffixes
at a - x + 1, that at a - x is induced as in suffix-array construction: tuples (preceding byte, rank of the successor) leave
in that order, and the common prefix of two neighbours is one more than the smallest one between their successors, or none
if their bytes differ. After at most length - k such steps every window of the batch has met its neighbours in suffix order;
it occurs again if and only if its common prefix with one of them is `length` or more. Nothing is decided by a hash here.

A k-gram with more than `hot` occurrences would make one large batch, so its occurrences are dealt by a hash into parts of
about `hot`, and each part is sorted as above. What is left are windows with no equal in their part: these, and one window
of each class of equal ones, meet those of the other parts: a 128-bit fingerprint finds which may be equal, their bytes
decide. Equal texts are one text; one of at least `length` bytes with a copy goes whole.

Defined cases: a null text is empty; texts shorter than `length` stay whole, copies or not; overlapping hits count, in one
text too; matches never cross texts; strings are judged on the input. Ids may repeat or be null (rows are told apart by
their place). Extra columns are carried over, but for those named `data` or `spans`, which are replaced.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custlens.llm.bpe import hash_tables
from custlens.runtime import materialize, ship_package

LENGTH = 400
GRAM = 160
HOT = 16_384
# Long texts are sampled in overlapping stretches, so that a place fits into the low bits of a sample key.
PLACE_BITS = 20
STRETCH = 1 << PLACE_BITS
BATCH_ROWS = 4096


def anchors(text: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per anchor: the hash of its k-gram, its place, and the first and last start of the windows it stands for."""
    parts: list[list[np.ndarray]] = []
    for lo in range(0, len(text) - length + 1, STRETCH - length + 1):
        piece = np.frombuffer(text, np.uint8, min(STRETCH, len(text) - lo), lo)
        found = [c if i == 0 else c + lo for i, c in enumerate(_anchors(piece, length, gram))]
        if parts and parts[-1][1][-1] == found[1][0]:  # one anchor on both sides of the border
            parts[-1][3][-1] = found[3][0]
            found = [c[1:] for c in found]
        if len(found[0]):
            parts.append(found)
    if not parts:
        return np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3
    return tuple(np.concatenate(c) for c in zip(*parts))


def _anchors(piece: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    table, powers, inverse = hash_tables(len(piece), 5)
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(table[piece] * powers[: len(piece)])])
    code = (prefix[gram:] - prefix[:-gram]) * inverse[: len(piece) - gram + 1]
    code = (code ^ (code >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    mask = np.uint64(STRETCH - 1)
    low = (code & ~mask) | np.arange(len(code), dtype=np.uint64)
    wide, width = length - gram + 1, 1
    while 2 * width <= wide:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if wide > width:
        low = np.minimum(low[: len(low) - (wide - width)], low[wide - width :])
    at = (low & mask).astype(np.int64)
    edge = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.append(edge[1:], len(at)) - 1
    return code[at[edge]], at[edge], edge, last


def _range_min(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Minimum of `values[lo : hi + 1]` for each pair, lo <= hi."""
    span = hi - lo + 1
    level = np.zeros(len(span), np.int64)
    level[span > 1] = np.log2(span[span > 1]).astype(np.int64)
    out, table = np.empty(len(lo), values.dtype), values
    for k in range(int(level.max(initial=0)) + 1):
        if k:
            half = 1 << (k - 1)
            table = np.minimum(table[:-half], table[half:])
        own = level == k
        out[own] = np.minimum(table[lo[own]], table[hi[own] - (1 << k) + 1])
    return out


def induce(group: np.ndarray, left: list[bytes], right: list[bytes], nearest: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Two flags `[row, x]` for the window that starts x bytes before the anchor of a row: it occurs again, and it leads the windows equal to it.

    Rows come sorted by `group` and `right` (the bytes from the anchor on); `left`: the bytes before it that windows of the
    row cover; `nearest`: the smallest x that is a window of the row.
    """
    n = len(group)
    reach = np.fromiter(map(len, left), np.int64, n)
    deepest = int(reach.max(initial=0))
    before = np.zeros((n, deepest), np.uint8)  # [row, x - 1]: the byte x places before the anchor
    follow = np.zeros((n, length), np.uint8)
    size = np.minimum(np.fromiter(map(len, right), np.int64, n), length)
    for i in range(n):
        before[i, : reach[i]] = np.frombuffer(left[i], np.uint8)[::-1]
        follow[i, : size[i]] = np.frombuffer(right[i], np.uint8, size[i])
    differ = follow[1:] != follow[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), length) if n > 1 else np.zeros(0, np.int64)
    order = np.arange(n)
    prefix = np.zeros(n, np.int64)  # with the row before it in the order
    prefix[1:] = np.where(group[1:] == group[:-1], np.minimum(common, np.minimum(size[1:], size[:-1])), 0)
    again, leads = np.zeros((n, deepest + 2), bool), np.zeros((n, deepest + 2), bool)
    for x in range(deepest + 1):
        if x:
            stay = np.flatnonzero(reach[order] >= x)
            if len(stay) < len(order):
                if not len(stay):
                    break
                prefix = np.minimum.reduceat(prefix[: stay[-1] + 1], np.concatenate([[0], stay[:-1] + 1]))
                order = order[stay]
            byte = before[order, x - 1]
            leave = np.argsort(group[order] * 256 + byte, kind="stable")
            moved = np.zeros(len(order), np.int64)
            if len(order) > 1:
                a, b = leave[:-1], leave[1:]
                same = (group[order[a]] == group[order[b]]) & (byte[a] == byte[b])
                moved[1:][same] = 1 + _range_min(prefix, a[same] + 1, b[same])
            order, prefix = order[leave], moved
        hit = prefix >= length
        leads[order[~hit], x] = True
        hit[:-1] |= hit[1:]
        again[order[hit], x] = True
    places = np.arange(deepest + 2)[None, :]
    owned = (places >= nearest[:, None]) & (places <= reach[:, None])
    return again & owned, leads & owned


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of true flags as (row, first, last)."""
    padded = np.concatenate([np.zeros((len(flags), 1), bool), flags], axis=1)
    row, first = np.nonzero(padded[:, 1:] & ~padded[:, :-1])
    _, end = np.nonzero(padded[:, :-1] & ~padded[:, 1:])
    return row, first, end - 1


def _samples(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """One row per anchor: `gram`, `code`, `row`, `at`, `first`, `last`."""
    ship_package(docs.sparkSession)
    schema = "gram long, code long, row long, at int, first int, last int"
    arrow = pa.schema([("gram", pa.int64()), ("code", pa.int64()), ("row", pa.int64()), ("at", pa.int32()), ("first", pa.int32()), ("last", pa.int32())])

    def run(batches):
        for batch in batches:
            rows, codes, texts = (batch.column(i) for i in range(3))
            found, held = [], 0
            for row, code, text in zip(rows.to_pylist(), codes.to_pylist(), texts):
                data = text.as_buffer().to_pybytes()
                if len(data) < length:
                    continue
                h, at, first, last = anchors(data, length, gram)
                found.append((h.view(np.int64), np.full(len(h), code), np.full(len(h), row), at, first, last))
                held += len(h)
                if held > 100_000:
                    yield pack(found)
                    found, held = [], 0
            if found:
                yield pack(found)

    def pack(found):
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), f.type) for c, f in zip(zip(*found), arrow)], schema=arrow)

    return docs.where(F.length("data") >= length).select("row", "code", "data").mapInArrow(run, schema)


def _induced(contexts: DataFrame, length: int) -> DataFrame:
    """`row`, `start`, `end` of bytes to remove, from `gram`, `part`, `parts`, `row`, `at`, `first`, `last`, `left`, `right` sorted within partitions.

    Where a k-gram has several parts, there are also rows with a fingerprint (`one`, `two`): windows that lead their equals
    in the part. `lonely` marks those that occur there once.
    """
    schema = "row long, start long, end long, one long, two long, lonely boolean"
    types = [pa.int64()] * 5 + [pa.bool_()]
    names = ["row", "start", "end", "one", "two", "lonely"]

    def run(batches):
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < BATCH_ROWS:
                continue
            whole = pa.Table.from_batches(held).combine_chunks()
            cuts = np.flatnonzero(fresh(whole)) + 1
            lo = 0
            while len(ready := cuts[cuts > lo]) and rows - lo >= BATCH_ROWS:
                hi = int(ready[min(np.searchsorted(ready, lo + BATCH_ROWS), len(ready) - 1)])
                yield from solve(whole.slice(lo, hi - lo))
                lo = hi
            held = whole.slice(lo).combine_chunks().to_batches()
            rows -= lo
        if rows:
            yield from solve(pa.Table.from_batches(held).combine_chunks())

    def fresh(part: pa.Table) -> np.ndarray:
        gram, number = part["gram"].to_numpy(), part["part"].to_numpy()
        return (gram[1:] != gram[:-1]) | (number[1:] != number[:-1])

    def solve(part: pa.Table):
        row, at, last, parts = (part[c].to_numpy() for c in ("row", "at", "last", "parts"))
        left, right = part["left"].to_pylist(), part["right"].to_pylist()
        again, leads = induce(np.concatenate([[0], np.cumsum(fresh(part))]), left, right, at - last, length)
        mine, near, far = _runs(again)
        none = np.zeros(len(mine), bool)
        if len(mine):
            yield pack(row[mine], at[mine].astype(np.int64) - far, at[mine].astype(np.int64) - near + length, None, None, none)
        for i in np.flatnonzero(parts > 1).tolist():
            x = np.flatnonzero(leads[i])
            if len(x):
                place, marks = len(left[i]) - x, _fingerprints(left[i] + right[i], length)
                yield pack(np.full(len(x), row[i]), at[i] - x.astype(np.int64), None, *(m[place] for m in marks), ~again[i, x])

    def pack(*columns):
        n = len(columns[0])
        return pa.RecordBatch.from_arrays([pa.nulls(n, t) if c is None else pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return contexts.mapInArrow(run, schema)


def _fingerprints(text: bytes, length: int) -> list[np.ndarray]:
    data, out = np.frombuffer(text, np.uint8), []
    for seed in (21, 22):
        table, powers, inverse = hash_tables(len(data), seed)
        prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(table[data] * powers[: len(data)])])
        out.append(((prefix[length:] - prefix[:-length]) * inverse[: len(data) - length + 1]).view(np.int64))
    return out


def _across_parts(found: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """`row`, `start`, `end` of lonely windows that equal a window of another part."""
    marks = found.where("one is not null")
    several = marks.groupBy("one", "two").agg(F.count("*").alias("_n"), F.max("lonely").alias("_any")).where("_n > 1 and _any").select("one", "two")
    asked = materialize(marks.join(several, ["one", "two"], "left_semi").select("row", "start", "lonely"))
    window = F.expr(f"substring(data, cast(start + 1 as int), {length})")
    seen = asked.join(docs.select("row", "data"), "row").select("row", "start", "lonely", window.alias("window"))
    again = seen.groupBy("window").agg(F.count("*").alias("_n")).where("_n > 1").select("window")
    hits = seen.where("lonely").join(again, "window", "left_semi")
    return hits.select("row", "start", (F.col("start") + length).alias("end"))


def repeated_spans(df: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """`df` with `data` (the text's bytes) and `spans` (array of start, end: the maximal runs of bytes to remove, in order).

    `df` must give the same rows in the same partitions whenever it is read (a scan of files, or a written table): rows
    are told apart by their place.
    """
    kept = [c for c in df.columns if c.lower() not in ("data", "spans")]
    whole_row = F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)]).alias("_input")
    back = [F.col(f"_input.c{i}").alias(c) for i, c in enumerate(kept)]
    data = F.encode(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), "UTF-8")
    docs = df.select(whole_row, F.monotonically_increasing_id().alias("row"), data.alias("data")).withColumn("code", F.xxhash64("data"))
    marks = materialize(docs.where(F.length("data") >= length).select("row", F.unhex(F.sha2("data", 256)).alias("mark")))
    copies = materialize(marks.groupBy("mark").agg(F.min("row").alias("row"), F.count("*").alias("n")))
    samples = materialize(_samples(docs, length, gram))
    place = F.struct("code", "at")
    repeated = samples.groupBy("gram").agg(F.min(place).alias("_lo"), F.max(place).alias("_hi")).where("_lo <> _hi").select("gram")
    wanted = materialize(samples.join(repeated, "gram", "left_semi").join(copies.select("row"), "row", "left_semi").select("gram", "row", "at", "first", "last"))
    common = wanted.groupBy("gram").count().where(F.col("count") > hot).select("gram", F.ceil(F.col("count") / max(hot, 1)).cast("int").alias("parts"))
    contexts = (
        wanted.join(common, "gram", "left")
        .join(docs.select("row", "data"), "row")
        .select(
            "gram", F.coalesce("parts", F.lit(1)).alias("parts"), "row", "at", "first", "last",
            F.expr("substring(data, first + 1, at - first)").alias("left"), F.expr(f"substring(data, at + 1, last + {length} - at)").alias("right"),
        )
        .withColumn("part", F.pmod(F.xxhash64("row", "at"), F.col("parts")).cast("int"))
    )
    found = materialize(_induced(contexts.repartition("gram", "part").sortWithinPartitions("gram", "part", "right"), length))
    pieces = found.where("one is null").select("row", "start", "end").unionByName(_across_parts(found, docs, length))
    spans = pieces.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("_found"))
    # every row that has a copy goes whole
    whole = marks.join(copies.where("n > 1").select("mark"), "mark", "left_semi").select("row", F.lit(True).alias("_whole"))
    verdict = spans.join(whole, "row", "full")
    joined = docs.drop("code").join(verdict, "row", "left")
    merged = F.aggregate("_found", F.array().cast("array<struct<start:bigint,end:bigint>>"), _extend)
    all_ = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.length("data").cast("long").alias("end")))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return joined.select(*back, "data", F.when(F.col("_whole"), all_).when(F.col("_found").isNull(), none).otherwise(merged).alias("spans"))


def _extend(runs, one):
    """Join a span to the last run if it touches it."""
    last = F.try_element_at(runs, F.lit(-1))
    longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], one["end"]).alias("end"))
    touching = (F.size(runs) > 0) & (last["end"] >= one["start"])
    return F.when(touching, F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(longer))).otherwise(F.concat(runs, F.array(one)))


def without_spans(df: DataFrame, out: str = "kept") -> DataFrame:
    """`df` of `repeated_spans` with the bytes that remain of each text, in one binary column."""
    edges = F.concat(F.array(F.struct(F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end"))), "spans", F.array(F.struct(F.length("data").cast("long").alias("start"), F.length("data").cast("long").alias("end"))))
    gaps = F.transform(F.sequence(F.lit(1), F.size("spans") + 1), lambda i: F.hex(F.substring(F.col("data"), (F.element_at("_edges", i)["end"] + 1).cast("int"), (F.element_at("_edges", i + 1)["start"] - F.element_at("_edges", i)["end"]).cast("int"))))
    return df.withColumn("_edges", edges).withColumn(out, F.when(F.size("spans") == 0, F.col("data")).otherwise(F.unhex(F.array_join(gaps, "")))).drop("_edges")


def at_characters(df: DataFrame) -> DataFrame:
    """`df` of `repeated_spans` with spans widened to whole characters, so that what remains is valid UTF-8."""
    inside = lambda place: F.hex(F.substring(F.col("data"), (place + 1).cast("int"), F.lit(1))).between("80", "BF")

    def lower(s):
        return F.when(~inside(s), s).when(~inside(s - 1), s - 1).when(~inside(s - 2), s - 2).otherwise(s - 3)

    def upper(e):
        return F.when(~inside(e), e).when(~inside(e + 1), e + 1).when(~inside(e + 2), e + 2).otherwise(e + 3)

    return df.withColumn("spans", F.transform("spans", lambda s: F.struct(lower(s["start"]).alias("start"), upper(s["end"]).alias("end"))))
