"""Removal of repeated substrings with suffix arrays over shards made by content.

A byte goes if a ``width``-byte string covers it that also starts earlier, in a
document with a smaller id or further left in its own. Suffix arrays of shards
find these strings exactly, if all places of a string are in one shard:

1. Each window of ``width`` bytes is known by the least hash among its
   ``SEED_BYTES``-byte strings. Equal windows have equal least hashes, and
   neighbouring windows mostly share theirs, so a text falls into *segments*:
   runs of windows with one key (some 40 windows on plain text). A segment is a
   row of a few numbers; its bytes stay where they are.
2. Segments are dealt out by key and sorted. A key that occurs once cannot hold
   a repeat and is dropped. Of segments with equal content the first stays; all
   windows of the others repeat it. A batch drops its own copies before the
   shuffle, so a group of copies sends a row a batch.
3. The bytes of first segments whose key has several are cut from the texts and
   dealt out by key again. Shards of about ``SHARD_BYTES``, always whole keys, get
   a suffix array by induced sorting and permuted common prefixes; in each run of
   suffixes that share ``width`` bytes all but the earliest are repeats.
4. Each document's repeats are merged and cut from its text.

A passage in very many documents gives its border segments a common key with
ever other content. Keys with more than ``KEY_BYTES`` of segments do not go to a
shard: their windows are compared by 128-bit hash in an aggregation, which
combines before the shuffle."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import _BYTE_TERMS, _POWERS, U64, as_long, binary_runs, in_arrow, mix64, stage
from .suffixes import SEPARATOR, common_prefixes, suffix_array

WIDTH = 100
SEED_BYTES = 24
SLICE_BYTES = 1 << 18
SHARD_BYTES = 1 << 16  # its lists stay in a core's cache
KEY_BYTES = 1 << 22
MOST_WINDOWS = (1 << 12) - 1
NO_ID = -(1 << 63)

# Letters hash in their own case here, unlike in the word hashes.
_TERMS = _BYTE_TERMS.copy()
_TERMS[ord("A") : ord("Z") + 1] = mix64(np.arange(1, 27, dtype=U64) * U64(0xA24BAED4963EE407))
_PLACE = "doc long, tie long"
_SEGMENT = "sure boolean, key long, hash long, " + _PLACE + ", at long"
_SPAN = _PLACE + ", start long, end long"


def _at(start: np.ndarray, windows: np.ndarray, again: np.ndarray) -> np.ndarray:
    """Start, number of windows and whether the key comes twice, in an integer ordered like the start."""
    return (start.astype(np.int64) << 13) | (windows.astype(np.int64) << 1) | again


def _unpack(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return at >> 13, (at >> 1) & MOST_WINDOWS, (at & 1).astype(bool)


def _prefix_sums(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    up, down = _POWERS.upto(len(part) + 1)
    return np.concatenate([np.zeros(1, U64), np.cumsum(_TERMS[part] * up[: len(part)])]), down


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    least, step, n = values, 1, len(values) - width + 1
    while 2 * step <= width:
        least, step = np.minimum(least[:-step], least[step:]), 2 * step
    return np.minimum(least[:n], least[width - step : width - step + n])


def segments_of(data: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Segments of texts that lie one behind the other: start in ``data``, windows, key, hash of the
    content, and whether the key's string occurs more than once in it. Works on slices,
    so its arrays stay small beside a very long text."""
    found = []
    seed = min(SEED_BYTES, width)
    for begin in range(0, len(data) - width + 1, SLICE_BYTES):
        part = data[begin : begin + SLICE_BYTES + width - 1]
        sums, down = _prefix_sums(part)
        grams = mix64((sums[seed:] - sums[:-seed]) * down[: len(part) - seed + 1])
        place = np.arange(len(grams), dtype=U64) & U64(0xFFFF)  # leftmost of equal ones; sure within a window
        best = _least((grams & ~U64(0xFFFF)) | place, width - seed + 1)
        key = best >> U64(16)
        here = np.arange(begin, begin + len(best))
        doc = np.searchsorted(ends, here, "right")
        whole = here + width <= ends[doc]
        new = np.ones(len(best), bool)
        new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
        edge = np.flatnonzero(new | ~whole)
        length = np.diff(np.append(edge, len(best)))
        edge, length = edge[whole[edge]], length[whole[edge]]
        pieces = -(-length // MOST_WINDOWS)  # very long runs of one key, as in periodic texts
        first = np.repeat(edge, pieces) + MOST_WINDOWS * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        n = np.minimum(np.repeat(edge + length, pieces) - first, MOST_WINDOWS)
        content = mix64((sums[first + n + width - 1] - sums[first]) * down[first] + n.astype(U64))
        # Windows of one run repeat each other only if its least string moves; where places wrap round, that isn't seen.
        moved = np.concatenate([[0], np.cumsum(best[1:] != best[:-1])])
        again = (moved[first + n - 1] > moved[first]) | (first >> 16 != (first + n + width) >> 16)
        found.append((first + begin, n, key[first], content, again))
    if not found:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, U64, U64, bool))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a batch's texts."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _segments(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = _texts(batch.column(2))
        start, n, key, content, again = segments_of(data, offsets[1:], width)
        row = np.searchsorted(offsets[1:], start, "right")
        doc, tie = (batch.column(i).to_numpy()[row] for i in (0, 1))
        at = _at(start - offsets[row], n, again)
        order = np.lexsort((at, tie, doc, content, key))
        key, content, doc, tie, at = (x[order] for x in (key, content, doc, tie, at))
        sure = np.zeros(len(key), bool)
        sure[1:] = (key[1:] == key[:-1]) & (content[1:] == content[:-1])
        place = mix64(doc.view(U64) ^ mix64(at.view(U64)))  # sure repeats need no partner: dealt out evenly
        yield pa.RecordBatch.from_arrays(
            [pa.array(sure), as_long(np.where(sure, place, key)), as_long(content), as_long(doc), as_long(tie), as_long(at)],
            ["sure", "key", "hash", "doc", "tie", "at"],
        )


def _repeated_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by all columns: repeats of an equal segment, and the first segments of
    keys with several. Holds a batch and two rows."""
    waiting, last = None, None  # the first segment of the running key, while it has no second; the row before this batch

    def rows(x: np.ndarray, repeat: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(repeat), *(as_long(c) for c in x)], ["repeat", "key", "doc", "tie", "at"])

    for batch in batches:
        sure = batch.column(0).to_numpy(zero_copy_only=False)
        key, content, doc, tie, at = (batch.column(i).to_numpy() for i in range(1, 6))
        if sure.any():
            own = np.stack([key, doc, tie, at])[:, sure]
            yield rows(own, np.ones(own.shape[1], bool))
            key, content, doc, tie, at = (x[~sure] for x in (key, content, doc, tie, at))
        if not len(key):
            continue
        table = np.stack([key, content, doc, tie, at])
        if last is None:
            last = table[:, :1] - 1
        both = np.concatenate([last, table], axis=1)
        new_key = both[0, 1:] != both[0, :-1]
        first = new_key | (both[1, 1:] != both[1, :-1])
        same_row = (both[:, 1:] == both[:, :-1]).all(axis=0) & ~first  # a repeated row: the same document
        last = table[:, -1:]
        lead = np.flatnonzero(first)
        opens = new_key[lead]
        alone = (at[lead] & 1).astype(bool)  # holds repeats by itself
        goes_on = np.append(~opens[1:], False)  # a second first segment of its key follows in this batch
        keep = ~opens | goes_on | alone
        found = lead[keep]
        out = [table[[0, 2, 3, 4]][:, found], table[[0, 2, 3, 4]][:, ~first & ~same_row]]
        if waiting is not None and len(lead) and not opens[0]:
            out[0] = np.concatenate([waiting, out[0]], axis=1)
        if len(lead):
            tip = lead[-1]
            waiting = table[[0, 2, 3, 4]][:, tip : tip + 1] if opens[-1] and not alone[-1] else None
        # A key that went on in this batch without a first segment keeps what waits.
        yield rows(np.concatenate(out, axis=1), np.repeat([False, True], [out[0].shape[1], out[1].shape[1]]))


def _cut_segments(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Bytes of the wanted segments of each text."""
    for batch in batches:
        data, offsets = _texts(batch.column(2))
        wanted = batch.column(3)
        row = np.repeat(np.arange(len(wanted)), wanted.value_lengths().to_numpy())
        items = wanted.flatten()
        key, at = (items.field(i).to_numpy() for i in (0, 1))
        start, n, _ = _unpack(at)
        begin, size = offsets[row] + start, n + width - 1
        for lo in range(0, len(key), 1 << 14):
            some = slice(lo, lo + (1 << 14))
            ends = np.cumsum(size[some])
            take = np.arange(ends[-1]) + np.repeat(begin[some] - (ends - size[some]), size[some])
            yield pa.RecordBatch.from_arrays(
                [
                    as_long(key[some]),
                    pa.array(batch.column(0).to_numpy()[row[some]]),
                    pa.array(batch.column(1).to_numpy()[row[some]]),
                    as_long(start[some]),
                    binary_runs(data[take], size[some]),
                ],
                ["key", "doc", "tie", "start", "content"],
            )


def repeats_of(doc: np.ndarray, tie: np.ndarray, start: np.ndarray, contents: list[bytes], width: int) -> tuple[np.ndarray, ...]:
    """(segment, start, end) of the byte ranges in a shard whose windows start earlier, too. Segments hold
    no window in common; their order is that of their places."""
    order = np.lexsort((start, tie, doc))
    text = np.frombuffer(bytes(1).join(contents[i] for i in order) + bytes(1), np.uint8).astype(np.int64)
    size = np.array([len(contents[i]) + 1 for i in order])
    ends = np.cumsum(size)
    inside = np.ones(len(text), bool)
    inside[ends - 1] = False
    text = np.where(inside, text + 1, SEPARATOR)
    left = np.repeat(ends - 1, size) - np.arange(len(text))
    sa = suffix_array(text, 257)
    shared = common_prefixes(text, sa, left)[sa]
    begins = np.flatnonzero(shared < width)
    earliest = np.minimum.reduceat(sa, begins)
    repeat = np.zeros(len(text) + 1, np.int8)
    repeat[sa[sa != np.repeat(earliest, np.diff(np.append(begins, len(sa))))]] = 1
    turn = np.diff(repeat, prepend=0)
    first, stop = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
    at = np.searchsorted(ends, first, "right")
    shift = start[order][at] - (ends[at] - size[at])
    return order[at], first + shift, stop - 1 + width + shift


def _shards(batches: Iterator[pa.RecordBatch], width: int, shard_bytes: int) -> Iterator[pa.RecordBatch]:
    """Reads rows sorted by key; each shard is some whole keys."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]] = []
    size = 0

    def solve() -> pa.RecordBatch:
        doc, tie, start = (np.concatenate([h[i] for h in held]) for i in (1, 2, 3))
        row, first, end = repeats_of(doc, tie, start, [x for h in held for x in h[4]], width)
        return pa.RecordBatch.from_arrays([as_long(x) for x in (doc[row], tie[row], first, end)], ["doc", "tie", "start", "end"])

    for batch in batches:
        key, doc, tie, start = (batch.column(i).to_numpy() for i in range(4))
        content = batch.column(4).to_pylist()
        edges = np.flatnonzero(np.diff(key, prepend=key[:1])).tolist() if len(key) else []
        if held and len(key) and key[0] != held[-1][0][-1]:
            edges = [0, *edges]
        lo = 0
        for edge in [*edges, len(key)]:
            if edge > lo:
                held.append((key[lo:edge], doc[lo:edge], tie[lo:edge], start[lo:edge], content[lo:edge]))
                size += sum(map(len, content[lo:edge]))
                lo = edge
            if edge < len(key) and size >= shard_bytes:
                yield solve()
                held, size = [], 0
    if held:
        yield solve()


def _windows(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """A 128-bit hash of each window of segments."""
    for batch in batches:
        for doc, tie, start, text in zip(*(batch.column(i).to_pylist() for i in range(1, 5)), strict=True):
            each = [hashlib.blake2b(text[i : i + width], digest_size=16).digest() for i in range(len(text) - width + 1)]
            high = np.frombuffer(b"".join(each), np.int64).reshape(-1, 2)
            n = len(each)
            yield pa.RecordBatch.from_arrays(
                [as_long(high[:, 0].copy()), as_long(high[:, 1].copy()), pa.array([doc] * n, pa.int64()), pa.array([tie] * n, pa.int64()), as_long(start + np.arange(n))],
                ["h1", "h2", "doc", "tie", "start"],
            )


def _crowded(segments: DataFrame, width: int) -> DataFrame:
    """Spans of the segments of crowded keys, window by window: every place but the first of a window goes."""
    windows = stage(in_arrow(segments, _windows, "h1 long, h2 long, " + _PLACE + ", start long", width=width), "substring-windows")
    first = windows.groupBy("h1", "h2").agg(F.min(F.struct("doc", "tie", "start")).alias("first"), F.count(F.lit(1)).alias("n"))
    met = windows.join(first.where("n > 1"), ["h1", "h2"])
    met = met.where(F.struct("doc", "tie", "start") != F.col("first"))
    return met.select("doc", "tie", "start", (F.col("start") + width).alias("end"))


def _merged(spans: pa.Array) -> list[tuple[int, int]]:
    """Maximal runs of bytes under some spans."""
    out: list[tuple[int, int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, spans = batch.column(2).cast(pa.large_binary()), batch.column(3)
        size, gone, runs, kept = [], [], [], []
        for text, found in zip(texts.to_pylist(), spans.to_pylist(), strict=True):
            merged = _merged(found or [])
            ends = [0, *(e for _, e in merged)]
            kept.append(b"".join(text[a:b] for a, b in zip(ends, [*(s for s, _ in merged), len(text)], strict=True)))
            size.append(len(text))
            gone.append(sum(e - s for s, e in merged))
            runs.append(len(merged))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *(pa.array(x, pa.int64()) for x in (size, gone, runs)), pa.array(kept, pa.binary())],
            ["doc", "tie", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def _rows(docs: DataFrame, id_col: str, text_col: str, tie: Column) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), text).select("doc", tie.alias("tie"), "text")


def repeated_spans(rows: DataFrame, width: int = WIDTH, shard_bytes: int = SHARD_BYTES, key_bytes: int = KEY_BYTES) -> DataFrame:
    """``(doc, tie, start, end)``: byte ranges, overlapping ones too, that cover every repeat in ``rows(doc, tie, text)``."""
    segments = in_arrow(rows, _segments, _SEGMENT, width=width)
    dealt = segments.repartition("key").sortWithinPartitions("sure", "key", "hash", "doc", "tie", "at")
    found = stage(in_arrow(dealt, _repeated_keys, "repeat boolean, key long, " + _PLACE + ", at long"), "substring-segments")
    start, windows = F.shiftright("at", 13), F.shiftright("at", 1).bitwiseAND(MOST_WINDOWS)
    copies = found.where("repeat").select("doc", "tie", start.alias("start"), (start + windows + width - 1).alias("end"))
    firsts = found.where("not repeat")
    wanted = firsts.groupBy("doc", "tie").agg(F.collect_list(F.struct("key", "at")).alias("wanted"))
    # Two rows with one id and text are one text here.
    texts = rows.join(wanted, ["doc", "tie"]).select("doc", "tie", "text", "wanted")
    cut = in_arrow(texts, _cut_segments, "key long, " + _PLACE + ", start long, content binary", width=width)
    crowd = firsts.groupBy("key").agg(F.sum(windows + width - 1).alias("size")).where(F.col("size") > key_bytes).select("key")
    crowd = stage(crowd, "substring-crowd")
    parts = [copies]
    if not crowd.isEmpty():
        cut = stage(cut, "substring-cut")
        parts.append(_crowded(cut.join(crowd, "key"), width))
        cut = cut.join(crowd, "key", "left_anti")
    sharded = cut.repartition("key").sortWithinPartitions("key", "doc", "tie", "start")
    parts.append(in_arrow(sharded, _shards, _SPAN, width=width, shard_bytes=shard_bytes))
    return functools.reduce(DataFrame.unionAll, parts)


def drop_repeated_substrings(
    docs: DataFrame,
    width: int = WIDTH,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_bytes: int = SHARD_BYTES,
    key_bytes: int = KEY_BYTES,
) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept)`` of each row: its bytes, those removed, their
    maximal runs, and the remaining bytes (binary: a cut may part a character).

    * null text is an empty one; texts shorter than ``width`` stay whole;
    * rows without an id come before all others. Rows that share an id are ordered by a hash of
      their texts; of rows with id and text alike one counts as the first, the others repeat it;
    * a very long text is read in slices; its segments are rows like any others. Its text and the
      ranges to remove meet in one task at the end;
    * only the two named columns are read, so other columns and their names play no part;
    * an empty table gives an empty table."""
    ids = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"))
    unique = ids.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc = " + str(NO_ID)).isEmpty()
    rows = _rows(docs, id_col, text_col, F.lit(0).cast("long") if unique else F.xxhash64("text"))
    one = rows
    if not unique:
        again = rows.select("doc", "tie", F.octet_length("text").cast("long").alias("n_bytes")).groupBy("doc", "tie")
        again = stage(again.agg(F.count(F.lit(1)).alias("n"), F.first("n_bytes").alias("n_bytes")).where("n > 1"), "substring-again")
        one = stage(rows.dropDuplicates(["doc", "tie"]), "substring-rows")
    spans = stage(repeated_spans(one, width, shard_bytes, key_bytes), "substring-spans")
    gone = spans.groupBy("doc", "tie").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    texts = one.join(gone, ["doc", "tie"], "left").select("doc", "tie", "text", "spans")
    out = in_arrow(texts, _kept, _PLACE + ", n_bytes long, n_removed long, n_spans long, kept binary")
    if not unique:
        more = again.select("*", F.explode(F.sequence(F.lit(2), "n"))).withColumn("long", F.col("n_bytes") >= width)
        none = F.lit(b"")
        text = one.join(again.where(F.col("n_bytes") < width).select("doc", "tie"), ["doc", "tie"]).select("doc", "tie", F.col("text").cast("binary").alias("short"))
        more = more.join(text, ["doc", "tie"], "left").select(
            "doc", "tie", "n_bytes",
            F.when(F.col("long"), F.col("n_bytes")).otherwise(0).alias("n_removed"),
            F.col("long").cast("long").alias("n_spans"),
            F.coalesce("short", none).alias("kept"),
        )
        out = out.unionByName(more)
    doc = F.when(F.col("doc") != NO_ID, F.col("doc"))
    return out.select(doc.alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept")
