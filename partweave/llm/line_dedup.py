"""Line dedup by an exact set-similarity join.

A line is the set of its words. A line is removed when an earlier line, by
(doc_id, line number) and then a hash of the text where rows of other texts repeat a doc_id, has Jaccard similarity ``num / den`` or more with it;
that the earlier line may itself be removed doesn't matter.

Words are ordered by rarity over the whole table: a fixed table of
``RARITY_SIZE`` counters, added up over all texts, ranks a word by its
counter (any one order common to all lines keeps the prefix filter exact, so
words that share a counter cost time only). Two similar lines share a word
among their first ``n - ceil(t * n) + 1`` words. Equal sets are one class, found
by pre-aggregation, and only classes are indexed. Their prefix entries travel
packed, in buckets by word; inside a bucket, lines of one word meet by classes of
their length, and the pairs pass the length, positional and parity-sketch filters
(each drops only pairs below the threshold).
Prefix entries are counted by word first: those of a word with more than
``PIECE_ENTRIES`` are dealt by line into pieces, and each pair of pieces meets in
a group of its own.

A word shared by a long run of similar lines would list the run's square, so a
line lists ``LISTED`` earlier candidates a word at first. All listed pairs are
verified on the full sets. Lines with more candidates that none of the listed
ones removed then meet all their earlier candidates in a second join, so nothing
is lost to that limit.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

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
    binary_runs,
    broadcast_lists,
    count_slices,
    fresh_name,
    in_arrow,
    mix64,
    piece_hashed_words,
    rarity_of,
    stage,
    stage_counted,
    tally,
)

LISTED = 2
BUCKET_ENTRIES = 300_000  # prefix entries a bucket should have
PIECE_ENTRIES = 100_000  # prefix entries of one word that stay together
_LINES = 4096  # lines worked on at a time: their index takes 12 bits of a sort key
_WORD_BITS = 46
_BYTES = 1 << 19  # of text worked on at a time
PACKED_ENTRIES = 250_000  # prefix entries that a task holds before it deals them out
_ENTRY = np.dtype([("word", "<u4"), ("n", "<u2"), ("pos", "u1"), ("sketch", "<u8", 2), ("doc", "<i8"), ("line", "<u4"), ("key", "<i8")])


def _groups(texts: list[bytes | None]) -> Iterator[list[int]]:
    """Indices of the non-null texts, in groups of about ``_BYTES`` bytes."""
    group, size = [], 0
    for i, text in enumerate(texts):
        if text is not None:
            group.append(i)
            size += len(text)
            if size >= _BYTES:
                yield group
                group, size = [], 0
    if group:
        yield group


def _counted(found: Iterator[np.ndarray]) -> pa.RecordBatch:
    """How often each of ``RARITY_SIZE`` counters is found, added up for many at a time."""
    counts, held, size = np.zeros(RARITY_SIZE, np.uint64), [], 0
    for at in found:
        held.append(at)
        size += len(at)
        if size >= 2 * RARITY_SIZE:
            tally(counts, np.concatenate(held))
            held, size = [], 0
    if size:
        tally(counts, np.concatenate(held))
    return count_slices(counts)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def found() -> Iterator[np.ndarray]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for group in _groups(texts):
                _, h = piece_hashed_words(np.frombuffer(b"\n".join(texts[i] for i in group), np.uint8))
                yield (h & U64(RARITY_SIZE - 1)).astype(np.int32)

    yield _counted(found())


def rarity_classes(texts: DataFrame) -> bytes:
    """One byte for each counter: twice the binary logarithm of how often its
    words occur in ``texts`` (one binary column). ``RARITY_SIZE`` bytes at any input size."""
    return rarity_of(in_arrow(texts, _count_words, COUNT_SCHEMA))


def _line_words(texts: list[bytes | None], rarity: np.ndarray):
    """Yields (text index, line number, n, start, words) for the lines of some texts at
    a time; ``words`` holds each line's distinct words, rarest first."""
    for group in _groups(texts):
        text = np.frombuffer(b"\n".join(texts[i] for i in group), np.uint8)
        lines = np.fromiter((texts[i].count(b"\n") + 1 for i in group), np.int64, len(group))
        doc = np.repeat(np.array(group), lines)
        number = np.arange(len(doc)) - np.repeat(np.cumsum(lines) - lines, lines)
        at, h = piece_hashed_words(text)
        line = np.searchsorted(np.flatnonzero(text == 10), at)
        rare = rarity[(h & U64(RARITY_SIZE - 1)).astype(np.int64)].astype(U64)
        word = (rare << U64(_WORD_BITS)) | (h >> U64(64 - _WORD_BITS))
        for a in range(0, len(doc), _LINES):
            b = min(len(doc), a + _LINES)
            i, j = np.searchsorted(line, [a, b])
            key = ((line[i:j] - a).astype(U64) << U64(52)) | word[i:j]
            key.sort()
            if len(key):
                key = key[np.concatenate([[True], key[1:] != key[:-1]])]
            n = np.bincount((key >> U64(52)).astype(np.int64), minlength=b - a)
            start = np.concatenate([[0], np.cumsum(n)])[:-1]
            yield doc[a:b], number[a:b], n, start, key & U64((1 << 52) - 1)


def _reduced(op: np.ufunc, x: np.ndarray, n: np.ndarray, start: np.ndarray) -> np.ndarray:
    out = np.zeros(len(n), U64)
    if len(x):
        out[n > 0] = op.reduceat(x, start[n > 0])
    return out


def _hashes(words: np.ndarray, mixed: np.ndarray, n: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each line's set; ``mixed`` is ``mix64(words)``."""
    b = mix64(words ^ U64(0x5851F42D4C957F2D))
    return _reduced(np.add, mixed, n, start), _reduced(np.add, b, n, start) ^ n.astype(U64)


def _leads(h1: np.ndarray, h2: np.ndarray, doc: np.ndarray, line: np.ndarray, key: np.ndarray) -> np.ndarray:
    """For the earliest of equal lines how many there are, for the others 0."""
    order = np.lexsort((key, line, doc, h2, h1))
    new = np.flatnonzero(np.concatenate([[True], (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])]))
    times = np.zeros(len(h1), np.int32)
    times[order[new]] = np.diff(np.append(new, len(h1)))
    return times


def _lines(batches: Iterator[pa.RecordBatch], rarity, num: int, den: int) -> Iterator[pa.RecordBatch]:
    rarity = np.frombuffer(rarity.value, np.uint8)
    for batch in batches:
        docs, keys = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        for doc, number, n, start, words in _line_words(batch.column(2).to_pylist(), rarity):
            mixed = mix64(words)
            h1, h2 = _hashes(words, mixed, n, start)
            at = mixed >> U64(57)  # of 128 bits: the parity of the words that fall on it
            low, high = (np.where(at >> U64(6) == U64(i), U64(1) << (at & U64(63)), U64(0)) for i in (0, 1))
            low, high = (_reduced(np.bitwise_xor, x, n, start) for x in (low, high))
            first = np.where(n > 0, n - (num * n + den - 1) // den + 1, 0)
            place = np.arange(len(words)) - np.repeat(start, n)
            prefix = (mixed[place < np.repeat(first, n)] & U64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)
            offsets = np.concatenate([[0], np.cumsum(first)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    as_long(docs[doc]),
                    pa.array(number.astype(np.int32)),
                    as_long(keys[doc]),
                    pa.array(n.astype(np.int32)),
                    as_long(h1),
                    as_long(h2),
                    as_long(low),
                    as_long(high),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(prefix)),
                    pa.array(_leads(h1, h2, docs[doc], number, keys[doc])),
                ],
                ["doc", "line", "key", "n", "h1", "h2", "low", "high", "prefix", "times"],
            )


def _count_prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = (batch.column(0).flatten().to_numpy(zero_copy_only=False).view(np.uint32) for batch in batches)
    yield _counted((x & np.uint32(RARITY_SIZE - 1)).astype(np.int32) for x in words)


def _taken(entries: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``entries[at]``, copied as rows of bytes: several times faster than field by field."""
    rows = entries.view(np.uint8).reshape(-1, _ENTRY.itemsize)
    return np.take(rows, at, axis=0).reshape(-1).view(_ENTRY)


def _pack(batches: Iterator[pa.RecordBatch], often, buckets: int, piece: int) -> Iterator[pa.RecordBatch]:
    """Prefix entries of the classes, packed by the bucket of their word, or by word and piece."""
    held: list[np.ndarray] = []
    most = 2 ** ((np.frombuffer(often.value, np.uint8) + 1) / 2)  # no fewer than were counted
    pieces_of = np.ceil(most / piece).astype(np.int64)

    def packed() -> pa.RecordBatch:
        every = np.concatenate(held)
        pieces = pieces_of[every["word"] % np.uint32(RARITY_SIZE)]
        word = every["word"].astype(np.int64)
        bucket, own = word % buckets, np.zeros(len(word), np.int64)
        hot = np.flatnonzero(pieces > 1)
        bucket[hot] = -1 - word[hot]
        doc, key, line = (np.ascontiguousarray(every[c][hot]) for c in ("doc", "key", "line"))
        spread = mix64(mix64(doc.view(U64) ^ mix64(key.view(U64))) ^ line.astype(U64))
        own[hot] = (spread % pieces[hot].astype(U64)).astype(np.int64)
        order = np.lexsort((own, bucket)) if len(hot) else np.argsort(bucket)
        every, bucket, own, pieces = _taken(every, order), bucket[order], own[order], np.where(bucket < 0, pieces, 1)[order]
        at = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (own[1:] != own[:-1])]))
        parts = [x.tobytes() for x in np.split(every, at[1:])]
        held.clear()
        return pa.RecordBatch.from_arrays(
            [as_long(bucket[at]), as_long(own[at]), as_long(pieces[at]), pa.array(parts, pa.binary())],
            ["bucket", "own", "pieces", "entries"],
        )

    for batch in batches:
        doc, line, key, n, low, high = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(6))
        prefix = batch.column(6)
        count = np.diff(prefix.offsets.to_numpy())
        out = np.empty(int(count.sum()), _ENTRY)
        out["word"] = prefix.flatten().to_numpy(zero_copy_only=False).view(np.uint32)
        out["n"] = np.repeat(np.minimum(n, 0xFFFF), count)
        out["pos"] = np.minimum(np.arange(len(out)) - np.repeat(np.cumsum(count) - count, count), 255)
        out["sketch"] = np.repeat(np.stack([low, high], axis=1).view(U64), count, axis=0)
        out["doc"], out["line"], out["key"] = (np.repeat(x, count) for x in (doc, line, key))
        held.append(out)
        if sum(map(len, held)) >= PACKED_ENTRIES:
            yield packed()
    if sum(map(len, held)):
        yield packed()


def _dealt(classes: DataFrame, total: int) -> DataFrame:
    """``own, entries`` in groups by ``bucket, i, j``: the entries of a bucket's words, or
    of the pieces ``i`` and ``j`` of one word."""
    counted = rarity_of(in_arrow(classes.select("prefix"), _count_prefixes, COUNT_SCHEMA))
    packed = in_arrow(
        classes,
        _pack,
        "bucket long, own long, pieces long, entries binary",
        often=classes.sparkSession.sparkContext.broadcast(counted),
        buckets=max(1, 10 * total // BUCKET_ENTRIES),
        piece=PIECE_ENTRIES,
    )
    met = packed.select("bucket", "own", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("other"), "entries")
    return met.select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "entries")


_FOUND = pa.schema(
    [(f"{end}{name}", kind) for end in "xy" for name, kind in (("doc", pa.int64()), ("line", pa.int32()), ("key", pa.int64()))]
    + [("more", pa.bool_())]
)


def _places(doc: np.ndarray, line: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Ranks of lines by doc, line and key, the same for entries of one line; by one 64-bit
    number a line where the docs' range allows it."""
    low = doc.min()
    order = None
    if float(doc.max()) - float(low) < 2.0**32 and line.max() < 1 << 31:
        place = ((doc - low).astype(U64) << U64(31)) | line.astype(U64)
        order = np.argsort(place)
        place, by = place[order], key[order]
        new = place[1:] != place[:-1]
        if (~new & (by[1:] != by[:-1])).any():
            order = None
    if order is None:
        order = np.lexsort((key, line, doc))
        new = np.any([x[order][1:] != x[order][:-1] for x in (doc, line, key)], axis=0)
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(np.concatenate([[False], new]))
    return ranks


@lru_cache(maxsize=4)
def _length_classes(num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """The class of each line length to 0xFFFF, and where each class begins: lengths of lines that
    can be similar are in the same class or in neighbouring ones."""
    begins = [0, 1]
    while begins[-1] <= 0xFFFF:
        begins.append(begins[-1] * max(num, den) // num + 1 if num else 0x10000)
    begins = np.array(begins)
    return np.searchsorted(begins, np.arange(0x10000), "right") - 1, begins


def _pairs(table: pa.Table, num: int, den: int) -> pa.Table:
    """Earlier candidates of each line of one bucket, word by word, or of each line of a
    piece in the other piece: the pairs that pass the filters, at most ``LISTED`` for a
    line and word; ``more`` where there are others. A word's lines meet by classes of their
    length, the same class first and then its neighbours, and in a class from the nearest one back;
    lines whose word comes too late in them for any partner of a class don't meet it.
    Two words of a line may share their 32 bits: the line is no candidate of itself."""
    parts = table.column("entries").to_pylist()
    owns = table.column("own").to_numpy()
    e = np.frombuffer(b"".join(parts), _ENTRY)
    # Words that stand here once pair with nothing.
    word = np.ascontiguousarray(e["word"])
    order = np.argsort(word)
    word = word[order]
    twice = word[1:] == word[:-1]
    some = np.concatenate([twice, [False]]) | np.concatenate([[False], twice])
    order, word = order[some], word[some]
    if not len(order):
        return _FOUND.empty_table()
    e, at = _taken(e, order), order
    group = np.cumsum(np.concatenate([[False], word[1:] != word[:-1]]))
    place = _places(*(np.ascontiguousarray(e[c]) for c in ("doc", "line", "key")))
    class_of, begins = _length_classes(num, den)
    kind = class_of[e["n"]]
    classes, places = len(begins) + 1, int(place.max()) + 1
    run = (group * classes + kind + 1) * places  # of a word and class; a place in it is added
    order = np.argsort(run + place)
    own = np.repeat(owns, [len(x) // _ENTRY.itemsize for x in parts])[at[order]]
    e, run, place, kind = _taken(e, order), run[order], place[order], kind[order]
    n = e["n"].astype(np.int32)
    low, high = (np.ascontiguousarray(e["sketch"][:, i]) for i in (0, 1))
    # The longest partner of a line that shares this word first: the words from here on must suffice.
    reach = (n.astype(np.int64) - e["pos"]) * (num + den) // num - n if num else np.full(len(e), 1 << 30)
    reach = np.where(n == 0xFFFF, 1 << 30, np.minimum(reach, 1 << 30)).astype(np.int32)  # n is cut: only verification decides
    every = np.ones(len(e), bool)
    own_class, next_class = reach >= begins[kind], reach >= begins[kind + 1]
    listed = np.zeros(len(e), np.int64)
    more = np.zeros(len(e), bool)
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def meet(xs: np.ndarray, ys: np.ndarray, step: int) -> None:
        """Lists candidates among ``xs`` of each of ``ys``, in the class ``step`` from its own."""
        xs, y = np.flatnonzero(xs), np.flatnonzero(ys & ~more)
        there, first = (run + place)[xs], run[y] + step * places
        end = np.searchsorted(there, first + place[y])
        depth = end - np.searchsorted(there, first)
        order = np.argsort(-depth)[: np.count_nonzero(depth)]
        y, end, depth = y[order], end[order], depth[order]
        nx, reach_x, ny, reach_y, back = n[xs], reach[xs], n[y], reach[y], 1
        while len(y):
            x = end - back
            fit = np.flatnonzero((reach_x[x] >= ny) & (nx[x] <= reach_y))
            x, hit = xs[x[fit]], y[fit]
            apart = np.bitwise_count(low[x] ^ low[hit]) + np.bitwise_count(high[x] ^ high[hit])
            near = apart.astype(np.int64) * (num + den) <= (den - num) * (n[x] + n[hit]).astype(np.int64)
            near |= (n[x] == 0xFFFF) | (n[hit] == 0xFFFF)
            x, hit = x[near], hit[near]
            full = listed[hit] >= LISTED
            more[hit[full]] = True
            x, hit = x[~full], hit[~full]
            listed[hit] += 1
            found.append((x, hit))
            back += 1
            left = slice(np.searchsorted(-depth, -back, "right"))  # the deepest come first
            if full.any():
                left = np.flatnonzero(~more[y[left]])
            y, end, depth, ny, reach_y = (z[left] for z in (y, end, depth, ny, reach_y))

    one = own == own[0]
    sides = [(every, every)] if len(np.unique(owns)) == 1 else [(one, ~one), (~one, one)]
    for step, can_x, can_y in ((0, own_class, own_class), (-1, next_class, every), (1, every, next_class)):
        for xs, ys in sides:
            meet(xs & can_x, ys & can_y, step)
    x = np.concatenate([p for p, _ in found]) if found else np.empty(0, np.int64)
    y = np.concatenate([q for _, q in found]) if found else np.empty(0, np.int64)
    return pa.table(
        {
            "xdoc": e["doc"][x],
            "xline": e["line"][x].astype(np.int32),
            "xkey": e["key"][x],
            "ydoc": e["doc"][y],
            "yline": e["line"][y].astype(np.int32),
            "ykey": e["key"][y],
            "more": more[y],
        }
    )


def _line_sets(batches: Iterator[pa.RecordBatch], rarity) -> Iterator[pa.RecordBatch]:
    """The word sets of each document's wanted lines."""
    rarity = np.frombuffer(rarity.value, np.uint8)
    for batch in batches:
        docs, keys = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        if not batch.num_rows:
            continue
        texts, asked = [], []
        for text, wanted in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            ends = np.append(np.flatnonzero(np.frombuffer(text, np.uint8) == 10), len(text))
            wanted = np.array(wanted)
            begins = np.where(wanted > 0, ends[wanted - 1] + 1, 0)
            texts.append(b"\n".join(text[a:b] for a, b in zip(begins.tolist(), ends[wanted].tolist(), strict=True)))
            asked.append(wanted)
        first = np.cumsum([0, *map(len, asked)])
        asked = np.concatenate(asked)
        for doc, number, n, start, words in _line_words(texts, rarity):
            h1, h2 = _hashes(words, mix64(words), n, start)
            yield pa.RecordBatch.from_arrays(
                [
                    as_long(docs[doc]),
                    as_long(keys[doc]),
                    pa.array(asked[first[doc] + number].astype(np.int32)),
                    as_long(h1),
                    as_long(h2),
                    binary_runs(words, n),
                ],
                ["doc", "key", "line", "h1", "h2", "words"],
            )


def _verify(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Keeps the rows whose two word sets (of 52-bit words) are similar; 4096 pairs at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, _LINES):
            part = batch.slice(at, _LINES)
            size, keys = [], []
            for column in part.columns[2:4]:
                words = column.to_pylist()
                size.append(np.fromiter(map(len, words), np.int64, len(words)) // 8)
                pair = np.repeat(np.arange(len(words), dtype=U64), size[-1])
                keys.append((pair << U64(52)) | np.frombuffer(b"".join(words), U64))
            both = np.sort(np.concatenate(keys))
            both = both[1:][both[1:] == both[:-1]]
            shared = np.bincount((both >> U64(52)).astype(np.int64), minlength=part.num_rows)
            yield part.select([0, 1]).filter(pa.array(den * shared >= num * (size[0] + size[1] - shared)))


def _doc_key(id_col: str, text_col: str):
    """A null doc_id comes after all others, ordered by a hash of the text."""
    return F.coalesce(
        F.col(id_col).cast("long"), F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64(F.col(text_col)), 2)
    ).alias("doc")


def _text_key(text_col: str):
    """Tells texts of one doc_id apart."""
    return F.xxhash64(F.col(text_col)).alias("key")


def removed_lines(
    docs: DataFrame, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc, key, line)`` of the lines of ``docs`` to remove: ``line`` counts from 0,
    ``doc`` is the doc_id or, for a null one, a key made from the text; ``key`` is a
    hash of the text, as rows may repeat a doc_id with other texts.

    A line is what stands between newlines; its words stand between ASCII white
    space, A-Z lower-cased. Lines without words are never removed. Rows that
    repeat a doc_id and text are one document. Null texts have no lines."""
    texts = docs.select(_doc_key(id_col, text_col), _text_key(text_col), F.col(text_col).cast("binary").alias("body"))
    spark = docs.sparkSession
    rarity = spark.sparkContext.broadcast(rarity_classes(texts.select("body")))
    lines, total = stage_counted(
        in_arrow(
            texts,
            _lines,
            "doc long, line int, key long, n int, h1 long, h2 long, low long, high long, prefix array<int>, times int",
            rarity=rarity,
            num=num,
            den=den,
        ),
        "ld-lines",
    )
    worded = lines.where("n > 0")
    # Equal lines of a batch are one row already, so a line that very many texts hold is a row a batch;
    # most others are alone, and combining them before the shuffle would sort them twice.
    leads = worded.where("times > 0").repartition("h1", "h2").groupBy("h1", "h2")
    first = leads.agg(F.min(F.struct("doc", "line", "key", "n", "low", "high", "prefix")).alias("f"), F.sum("times").alias("times"))
    first = stage(first.select("h1", "h2", "f.*", "times"), "ld-classes")
    classes = first.select("doc", "line", "key", "n", "low", "high", "prefix")
    pairs = stage(
        _dealt(classes, total)
        .groupBy("bucket", "i", "j")
        .applyInArrow(
            lambda t: _pairs(t, num, den), "xdoc long, xline int, xkey long, ydoc long, yline int, ykey long, more boolean"
        )
        .groupBy("xdoc", "xline", "xkey", "ydoc", "yline", "ykey")
        .agg(F.max("more").alias("more")),
        "ld-pairs",
    )

    def similar(pairs: DataFrame, tag: str) -> DataFrame:
        """Keys (h1, h2, ydoc, ykey, yline) of lines that have a verified earlier match among ``pairs``."""
        wanted = pairs.select(F.col("xdoc").alias("wdoc"), F.col("xkey").alias("wkey"), F.col("xline").alias("wline"))
        wanted = stage(wanted.unionAll(pairs.select("ydoc", "ykey", "yline")).distinct(), f"{tag}-wanted")
        owners = wanted.groupBy("wdoc", "wkey").agg(F.collect_list("wline").alias("wlines"))  # a text's own lines
        owners = broadcast_lists(stage(owners, f"{tag}-owners"), "wlines")
        own = (F.col("doc") == F.col("wdoc")) & (F.col("key") == F.col("wkey"))
        sets = texts.join(owners, own).select("doc", "key", "body", "wlines")
        kind = "doc long, key long, line int, h1 long, h2 long, words binary"
        sets = in_arrow(sets, _line_sets, kind, rarity=rarity)
        sets = stage(sets.dropDuplicates(["doc", "key", "line", "h1", "h2"]), f"{tag}-sets")
        x = sets.select("doc", "key", "line", "words").toDF("xdoc", "xkey", "xline", "xwords")
        y = sets.toDF("ydoc", "ykey", "yline", "h1", "h2", "ywords")
        both = pairs.drop("more").join(x, ["xdoc", "xkey", "xline"]).join(y, ["ydoc", "ykey", "yline"])
        both = both.select(F.struct("h1", "h2").alias("h"), F.struct("ydoc", "ykey", "yline").alias("y"), "xwords", "ywords")
        kind = "h struct<h1:long,h2:long>, y struct<ydoc:long,ykey:long,yline:int>"
        same = in_arrow(both, _verify, kind, num=num, den=den)
        return stage(same.select("h.h1", "h.h2", "y.ydoc", "y.ykey", "y.yline").distinct(), f"{tag}-similar")

    gone = similar(pairs, "ld-first")
    line = ["ydoc", "ykey", "yline"]
    rest = pairs.where("more").select(*line).distinct().join(gone, line, "left_anti")
    rest = stage(rest, "ld-rest")
    if not rest.isEmpty():
        entry = [F.col(c) for c in ("doc", "line", "key", "n", "low", "high")]
        entries = classes.select(*entry, F.posexplode("prefix").alias("pos", "word"))
        names = ["doc", "line", "key", "n", "low", "high", "pos"]
        here = (F.col("doc") == F.col("ydoc")) & (F.col("line") == F.col("yline")) & (F.col("key") == F.col("ykey"))
        y = entries.join(checked_broadcast(rest), here, "left_semi")
        y = checked_broadcast(stage(y.select("word", *(F.col(c).alias(f"y{c}") for c in names)), "ld-rest-words"))
        x = entries.select("word", *(F.col(c).alias(f"x{c}") for c in names))
        need = f"ceil({num} * (xn + yn) / {num + den})"
        more = x.join(y, "word").where(
            f"struct(xdoc, xline, xkey) < struct(ydoc, yline, ykey) and {den} * xn >= {num} * yn and {den} * yn >= {num} * xn"
            f" and least(xn - xpos, yn - ypos) >= {need} and bit_count(xlow ^ ylow) + bit_count(xhigh ^ yhigh) <= xn + yn - 2 * {need}"
        )
        more = stage(more.select("xdoc", "xline", "xkey", "ydoc", "yline", "ykey").distinct(), "ld-more")
        gone = gone.unionAll(similar(more, "ld-second"))

    gone = stage(gone.select("h1", "h2").distinct().withColumn("all", F.lit(True)), "ld-similar")
    # A class of one line goes by itself; only the lines of larger classes are looked up among all.
    alone = first.where("times = 1").join(checked_broadcast(gone), ["h1", "h2"]).select("doc", "key", "line")
    several = first.where("times > 1").select("h1", "h2", "doc", "line", "key").toDF("h1", "h2", "fdoc", "fline", "fkey")
    several = checked_broadcast(stage(several.join(gone, ["h1", "h2"], "left"), "ld-several"))
    seen = worded.select("doc", "line", "key", "h1", "h2").join(several, ["h1", "h2"])
    later = "all is not null or struct(fdoc, fline, fkey) < struct(doc, line, key)"
    return seen.where(later).select("doc", "key", "line").unionAll(alone).distinct()


def drop_repeated_lines(
    docs: DataFrame, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with their texts cut to the lines that stay, in the same columns.
    A document that had words and has none left is a copy of earlier ones and
    goes; one that had none stays, null and empty texts with it."""
    out, (_, removed, left) = line_counts(docs, num, den, id_col, text_col)
    return out.where((F.col(removed) == 0) | (F.col(left) > 0)).select(*docs.columns)


def line_counts(
    docs: DataFrame, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, list[str]]:
    """``drop_repeated_lines`` with its three counts a document, and their column
    names: lines, lines removed, worded lines left."""
    key, body, which, cut = (fresh_name(docs.columns, x) for x in ("line_doc", "line_text", "line_gone", "line_cut"))
    gone = removed_lines(docs, num, den, id_col, text_col)
    gone = gone.groupBy(F.col("doc").alias(key), F.col("key").alias(body)).agg(F.collect_list("line").alias(which))
    gone = broadcast_lists(stage(gone, "ld-gone"), which)
    names = [fresh_name(docs.columns, x) for x in ("n_lines", "n_removed", "n_left")]
    out = docs.withColumns({key: _doc_key(id_col, text_col), body: _text_key(text_col)})
    out = out.join(gone, [key, body], "left")
    parts = F.split(F.col(text_col), "\n", -1)
    # By a set of line numbers: linear however many of a text's lines go.
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(which))
    left = F.transform(stay, lambda i: F.get(F.col(cut), i))
    out = out.withColumn(cut, parts)
    out = out.withColumn(names[0], F.coalesce(F.size(cut), F.lit(0)).cast("long"))
    out = out.withColumn(cut, F.when(F.col(which).isNull(), F.col(cut)).otherwise(left))
    out = out.withColumn(names[1], F.coalesce(F.size(which), F.lit(0)).cast("long"))
    out = out.withColumn(names[2], F.size(F.filter(cut, lambda x: x.rlike("[^ \\t-\\r]"))).cast("long"))
    text = F.when(F.col(which).isNull(), F.col(text_col)).otherwise(F.array_join(cut, "\n"))
    return out.withColumn(text_col, text).select(*docs.columns, *names), names
