"""MinHash near-duplicates by a multi-index Hamming join.

A document is the set of its distinct word shingles. Its signature holds
``slots`` MinHash values of ``16`` bits each; the signature distance of two
documents is the number of slots that differ. For a pair at Jaccard similarity
J that distance is binomial(slots, 1 - J), so a distance bound ``radius`` is
chosen from the exact binomial tail: a pair exactly at the threshold exceeds it
with a probability of at most ``miss``.

All pairs within ``radius`` are then found for certain: the slots are cut into
``radius // (errors + 1) + 1`` chunks, so some chunk has at most ``errors``
differing slots (pigeonhole), and every chunk is indexed once for each choice of
``errors`` slots left out. Two documents within the radius share a key. Pairs
are confirmed by their distance, then on the full shingle sets.

Copies and hot groups. Documents with equal sets form one class (pre-aggregated
before the shuffle) and only classes are indexed. Within a key no pairs are
listed at first: each class is compared with the key's most connected class
only (a star, linear in the key's rows). A second round takes the classes of
keys whose members the stars left in different components. Listing those pairs
would square a large family of copies that drifted apart, so a pair is listed
only where it passes filters that no pair at the threshold fails: its sizes allow it; it
shares a shingle among the rarest of both (prefix filter, with the shorter prefix on
the side of the smaller set); behind the first one it shares, both sets have enough left
(positional filter); and the parity sketches of the sets differ in no more bits than the
sets may differ in shingles. A copy too far from all others has a prefix of its own and
is listed with none. After that round every pair within the radius is in one
component, was tested, or is below the threshold.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partweave.operators.broadcast import checked_broadcast

from .common import (
    COUNT_SCHEMA,
    RARITY_SIZE,
    U64,
    as_long,
    connected_components,
    count_slices,
    hashed_words,
    in_arrow,
    mix64,
    rarity_of,
    rows_of,
    stage,
    tally,
)

_SLOT = np.uint16
_PART = 8192  # shingles hashed at a time, which bounds a task's memory


def radius_for(slots: int, similarity: float, miss: float = 1e-6) -> int:
    """Smallest r with P(binomial(slots, 1 - similarity) > r) <= miss."""
    p, tail, r = 1 - similarity, 1.0, -1
    while tail > miss and r < slots:
        r += 1
        tail -= math.comb(slots, r) * p**r * (1 - p) ** (slots - r)
    return r


def chunks_for(slots: int, radius: int, errors: int) -> list[list[int]]:
    """The slots in as many even chunks as the pigeonhole needs."""
    n = min(slots, radius // (errors + 1) + 1)
    return [list(map(int, x)) for x in np.array_split(np.arange(slots), n)]


def _multipliers(slots: int) -> tuple[np.ndarray, np.ndarray]:
    x = mix64(np.arange(1, 2 * slots + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))
    return (x[:slots] >> U64(32)).astype(np.uint32) | np.uint32(1), (x[slots:] >> U64(32)).astype(np.uint32)


def shingle_set(text: bytes | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit ids of a text's shingles: A-Z lower-cased, words
    between ASCII white space, ``words`` words to a shingle; a shorter text is
    one shingle, a text without words the empty set."""
    _, h = hashed_words(np.frombuffer(text or b"", np.uint8))
    if not len(h):
        return h
    k = min(words, len(h))
    s, n = np.zeros(len(h) - k + 1, U64), len(h) - k + 1
    for i in range(k):
        s += mix64(h[i : i + n] + U64(i + 1)) * U64(2 * i + 0x9E3779B97F4A7C15)
    return np.unique(mix64(s))


def signature(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (ids >> U64(32)).astype(np.uint32)
    low = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), _PART):
        low = np.minimum(low, (np.multiply.outer(a, x[i : i + _PART]) + b[:, None]).min(axis=1))
    return (mix64(low.astype(U64)) & U64(0xFFFF)).astype(_SLOT)


def _digest(ids: np.ndarray) -> bytes:
    return hashlib.blake2b(ids.tobytes(), digest_size=16).digest()


def _sketch(batches: Iterator[pa.RecordBatch], words: int, slots: int) -> Iterator[pa.RecordBatch]:
    a, b = _multipliers(slots)
    for batch in batches:
        n, sets, sigs = [], [], []
        for text in batch.column(2).to_pylist():
            ids = shingle_set(text, words)
            n.append(len(ids))
            sets.append(_digest(ids) if len(ids) else None)
            sigs.append(signature(ids, a, b).tobytes() if len(ids) else None)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:2], pa.array(n, pa.int64()), pa.array(sets, pa.binary()), pa.array(sigs, pa.binary())],
            ["doc_id", "text_hash", "n_shingles", "set_id", "sig"],
        )


def _index(batches: Iterator[pa.RecordBatch], chunks: list[list[int]], errors: int, slots: int):
    for batch in batches:
        sig, cid = rows_of(batch.column(1), _SLOT, slots).astype(U64), batch.column(0).to_numpy(zero_copy_only=False)
        seen = 0
        for chunk in chunks:
            for keep in combinations(chunk, max(1, len(chunk) - errors)):
                seen += 1
                key = np.full(len(cid), seen, U64)
                for slot in keep:
                    key = mix64(key * U64(0x100000001B3) + sig[:, slot])
                yield pa.RecordBatch.from_arrays([as_long(key), as_long(cid)], ["key", "cid"])


def _close(batches: Iterator[pa.RecordBatch], radius: int, slots: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        far = (rows_of(batch.column(2), _SLOT, slots) != rows_of(batch.column(3), _SLOT, slots)).sum(axis=1)
        yield batch.select([0, 1]).filter(pa.array(far <= radius))


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = [shingle_set(t, words).tobytes() for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["cid", "ids"])


def _count_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(RARITY_SIZE, np.uint64)
    for batch in batches:
        found = []
        for ids in batch.column(0).to_pylist():
            found.append((np.frombuffer(ids, U64) % U64(RARITY_SIZE)).astype(np.int32))
        if found:
            tally(counts, np.concatenate(found))
    yield count_slices(counts)


def _parity(ids: np.ndarray) -> list[int]:
    """256 bits, each the parity of the shingles that fall on it: two sets differ in at least as many shingles as bits."""
    bits = np.bincount((mix64(ids) >> U64(56)).astype(np.int64), minlength=256) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64).tolist()


def _prefixes(batches: Iterator[pa.RecordBatch], rarity, num: int, den: int) -> Iterator[pa.RecordBatch]:
    """The rarest shingles of each set in their order, as many as the threshold needs, with the set's size and sketch."""
    rarity = np.frombuffer(rarity.value, np.uint8)
    for batch in batches:
        size, prefix, parity = [], [], []
        for ids in batch.column(1).to_pylist():
            x = np.frombuffer(ids, U64)
            order = np.lexsort((x, rarity[(x % U64(RARITY_SIZE)).astype(np.int64)]))
            size.append(len(x))
            prefix.append(x[order[: len(x) - (num * len(x) + den - 1) // den + 1]].view(np.int64))
            parity.append(_parity(x))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(size, pa.int64()), pa.array(prefix, pa.list_(pa.int64())), *(pa.array([p[k] for p in parity], pa.int64()) for k in range(4))],
            ["cid", "n", "prefix", *_SKETCH],
        )


_SKETCH = ("s0", "s1", "s2", "s3")


def _listed(prefix: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs ``(u, v)`` of ``prefix(shingle, pos, cid, root, n, s0..)`` that may reach the threshold, from
    different components; ``u`` is the smaller set. Every pair that does is listed at the first shingle it shares."""
    u = prefix.where(f"pos <= n - ceil({2 * num} * n / {num + den})").toDF(*(f"{c}_u" if c != "shingle" else c for c in prefix.columns))
    v = prefix.toDF(*(f"{c}_v" if c != "shingle" else c for c in prefix.columns))
    shared = f"ceil({num} * (n_u + n_v) / {num + den})"  # what sets at the threshold share at least
    apart = " + ".join(f"bit_count({c}_u ^ {c}_v)" for c in _SKETCH)
    ok = [
        "root_u <> root_v",
        "(n_u < n_v or n_u = n_v and cid_u < cid_v)",
        f"{num} * n_v <= {den} * n_u",
        f"least(n_u - pos_u, n_v - pos_v) >= {shared}",
        f"{apart} <= n_u + n_v - 2 * {shared}",
    ]
    return u.join(v, "shingle").where(" and ".join(ok)).select(F.col("cid_u").alias("u"), F.col("cid_v").alias("v"))


def _confirm(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            p, q = np.frombuffer(x.as_py(), U64), np.frombuffer(y.as_py(), U64)
            both = len(np.intersect1d(p, q, assume_unique=True))
            keep.append(den * both >= num * (len(p) + len(q) - both))
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def _components(
    docs: DataFrame, words: int, num: int, den: int, slots: int, errors: int, miss: float, id_col: str, text_col: str
) -> DataFrame:
    """``near_duplicates`` with the row's text hash."""
    radius = radius_for(slots, num / den, miss)
    chunks = chunks_for(slots, radius, errors)
    body = F.col(text_col).cast("binary")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(body).alias("text_hash"), body.alias("body"))

    rows = stage(
        in_arrow(
            docs,
            _sketch,
            "doc_id long, text_hash long, n_shingles long, set_id binary, sig binary",
            words=words,
            slots=slots,
        ),
        "nd-rows",
    )
    # One class for each distinct set; its first document stands for it.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash"))
    classes = rows.where("set_id is not null").groupBy("set_id").agg(first.alias("first"), F.max("sig").alias("sig"))
    classes = stage(classes.withColumn("cid", F.monotonically_increasing_id()), "nd-classes")

    keys = classes.select("cid", "sig")
    keys = in_arrow(keys, _index, "key long, cid long", chunks=chunks, errors=errors, slots=slots)
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    live = stage(keys.join(shared, "key"), "nd-live")

    # Whole texts are read once more, so that only the sets of classes that share a key are ever written.
    wanted = classes.join(live.select("cid").distinct(), "cid").select("cid", "first.doc_id", "first.text_hash")
    wanted = stage(wanted.withColumnsRenamed({"doc_id": "d", "text_hash": "h"}), "nd-wanted")
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h"))
    sets = docs.join(checked_broadcast(wanted), same).dropDuplicates(["cid"]).select("cid", "body")
    sets = stage(in_arrow(sets, _sets, "cid long, ids binary", words=words), "nd-sets")

    def linked(pairs: DataFrame, tag: str) -> DataFrame:
        """The distinct pairs that are near by signature, then linked on their full sets."""
        one = pairs.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
        sig = classes.select("cid", "sig")
        near = one.join(sig.toDF("u", "sig_u"), "u").join(sig.toDF("v", "sig_v"), "v")
        near = near.select("u", "v", "sig_u", "sig_v")
        near = stage(in_arrow(near, _close, "u long, v long", radius=radius, slots=slots), f"{tag}-near")
        both = near.join(sets.toDF("u", "ids_u"), "u").join(sets.toDF("v", "ids_v"), "v")
        both = both.select("u", "v", "ids_u", "ids_v")
        return stage(in_arrow(both, _confirm, "u long, v long", num=num, den=den), f"{tag}-links")

    def parts_of(links: DataFrame, tag: str) -> DataFrame:
        return stage(connected_components(links, f"{tag}-cc"), f"{tag}-parts").withColumnRenamed("node", "cid")

    root = F.coalesce("root", "cid").alias("root")

    # First round: stars around the class that meets most others.
    degree = live.groupBy("cid").agg(F.sum("n").alias("degree"))
    ranked = live.select("key", "cid").join(degree, "cid")
    hub = ranked.groupBy("key").agg(F.min(F.struct((-F.col("degree")).alias("d"), "cid")).alias("h"))
    star = live.select("key", F.col("cid").alias("u")).join(hub.select("key", F.col("h.cid").alias("v")), "key")
    links = linked(star.select("u", "v"), "nd-star")

    # Second round: classes of one key that the stars left apart.
    placed = live.select("key", "cid").join(parts_of(links, "nd-star"), "cid", "left")
    placed = stage(placed.select("key", "cid", root), "nd-placed")
    apart = placed.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("key")
    apart = stage(placed.join(apart, "key").select("cid", "root").distinct(), "nd-apart")
    apart_sets = sets.join(apart, "cid").select("cid", "ids")
    rarity = docs.sparkSession.sparkContext.broadcast(rarity_of(in_arrow(apart_sets.select("ids"), _count_ids, COUNT_SCHEMA)))
    kinds = "cid long, n long, prefix array<long>, " + ", ".join(f"{c} long" for c in _SKETCH)
    prefix = in_arrow(apart_sets, _prefixes, kinds, rarity=rarity, num=num, den=den).join(apart, "cid")
    prefix = prefix.select(F.posexplode("prefix").alias("pos", "shingle"), "cid", "root", "n", *_SKETCH)
    pairs = _listed(stage(prefix, "nd-prefix"), num, den)
    links = links.unionAll(linked(pairs, "nd-rest"))

    named = classes.select("cid", "set_id", "first.doc_id").join(parts_of(links, "nd-all"), "cid", "left")
    named = named.select("set_id", "doc_id", root)
    lowest = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = named.join(lowest, "root").select("set_id", "component_id")
    out = rows.select("doc_id", "text_hash", "n_shingles", "set_id").join(named, "set_id", "left")
    cid = F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    return out.select(
        "doc_id", "text_hash", "n_shingles", cid, F.col("doc_id").eqNullSafe(cid).alias("kept")
    )


def near_duplicates(
    docs: DataFrame,
    words: int = 5,
    num: int = 80,
    den: int = 100,
    slots: int = 64,
    errors: int = 1,
    miss: float = 1e-6,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked where ``den * |A & B| >= num * |A | B|`` on their full
    sets of ``words``-word shingles; ``component_id`` is the smallest doc_id that
    links reach, ``kept`` marks the document that carries it.

    Null or wordless texts have the empty set: linked with nothing, their own
    component, kept. A null doc_id never names a component unless its whole
    component has none; such a row is kept only then. Rows that repeat a doc_id
    inside a component are one document: they stay or go together. Other
    columns are ignored; an empty table gives no rows."""
    return _components(docs, words, num, den, slots, errors, miss, id_col, text_col).drop("text_hash")


def drop_near_duplicates(
    docs: DataFrame,
    words: int = 5,
    num: int = 80,
    den: int = 100,
    slots: int = 64,
    errors: int = 1,
    miss: float = 1e-6,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with all their columns."""
    rows = _components(docs, words, num, den, slots, errors, miss, id_col, text_col)
    gone = stage(rows.where("not kept").select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h")).distinct(), "nd-gone")
    same = docs[id_col].cast("long").eqNullSafe(gone["d"]) & (F.xxhash64(docs[text_col].cast("binary")) == gone["h"])
    return docs.join(checked_broadcast(gone), same, "left_anti")
