"""Best-fit packing of token sequences by large-item matching.

A document is its token ids and an end id; one above the capacity is cut into
pieces of the capacity. Pieces are packed by their lengths alone, and lengths
lie between 1 and the capacity, so the plan is made from a histogram of at most
``capacity`` counts, whatever the number of documents:

* pieces above a third of the capacity: at most two of them fit a bin. From the
  largest down, each opens a bin and is matched with the largest remaining one
  that still fits;
* smaller pieces, from the largest down, go to the fullest bins with room for
  them (best fit), else to new bins.

All bins with one history are one run of the plan: a run is a stretch of bin
numbers with the same gap. Steps take whole runs, so the plan has a few runs for
each length, not one entry a document. A piece's place follows from its length
and its rank among the pieces of that length. Ranks come from running counts
inside hash ranges of a length and the ranges' totals, so a length that very
many documents share is no single task.
"""

from __future__ import annotations

import bisect
import itertools
import json
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORKER_CACHES, as_long, broadcast_within, in_arrow, stage

CAPACITY = 4096
END_ID = 1
RANGE_ROWS = 1_000
AHEAD_ROWS = 1_000_000  # range totals that may be broadcast, 24 bytes each
_CACHE = 300_000  # entries of a generation; a cache keeps two


# How a vocabulary file that drops white space says so, and its own split.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SPLITS = [
    {"type": "Split", "pattern": {"Regex": _PARTS}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
_PLAIN = "^[!-~\u00a1-\u00ff]*$"


class _Cache(dict):
    """key -> ids (unsigned 32 bit, little-endian) made by ``make``; two generations of ``_CACHE`` entries."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key: str) -> bytes:
        ids = self.old.get(key)
        if ids is None:
            ids = self.make(key)
        if len(self) >= _CACHE:  # the older generation goes, entries in use come back from it one by one
            self.old = dict(self)
            self.clear()
        self[key] = ids
        return ids


def _gather(flat: np.ndarray, size: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``at`` of ``flat`` (runs of ``size``, one behind the other) in turn, and where each begins (and the last ends)."""
    n = size[at]
    upto = np.concatenate([[0], np.cumsum(n)])
    start = np.cumsum(size) - size
    return flat[np.arange(upto[-1]) + np.repeat(start[at] - upto[:-1], n)], upto


def _looked_up(cache: _Cache, keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    known = [cache[k] for k in keys.to_pylist()]
    return np.frombuffer(b"".join(known), "<u4"), np.fromiter(map(len, known), np.int64, len(known)) // 4


class _Tokens:
    """Ids of texts by a tokenizer file.

    A vocabulary that drops white space splits what stands between into parts, so a
    text's ids are those of its parts in turn (``by_parts``: whether the file says so; with
    other rules every text is encoded whole). Distinct white-space chunks of a batch are split and
    lower-cased once, their distinct parts looked up once, and ids gathered by array
    operations. A chunk beyond ASCII and Latin-1, or one that may hold a special token, goes
    through the whole tokenizer."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        normal, split = ((rules[k] or {}) for k in ("normalizer", "pre_tokenizer"))
        self.by_parts = normal.get("normalizers") == _NORMALIZERS and split.get("pretokenizers") == _SPLITS
        self.parts, self.chunks = _Cache(self._merged), _Cache(self._encoded)
        # Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from 256 on.
        own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        rest = [b for b in range(256) if b not in set(own)]
        self.byte_chars = {b: b for b in own} | {b: 256 + i for i, b in enumerate(rest)}

    def _encoded(self, text: str) -> bytes:
        return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()

    def _merged(self, part: str) -> bytes:
        shown = part if part.isascii() else part.encode().decode("latin-1").translate(self.byte_chars)
        return array("I", [t.id for t in self.whole.model.tokenize(shown)]).tobytes()

    def _of_chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        plain = pc.and_(pc.match_substring_regex(chunks, _PLAIN), pc.invert(pc.match_substring(chunks, "<|")))
        lists = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.utf8_lower(pc.if_else(plain, chunks, "")), _PARTS, "\\0 "))
        parts = lists.flatten().dictionary_encode()
        ids, upto = _gather(*_looked_up(self.parts, parts.dictionary), parts.indices.to_numpy())
        size = np.diff(upto[np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])])
        other = np.flatnonzero(~plain.to_numpy(zero_copy_only=False))
        if len(other):
            more, each = _looked_up(self.chunks, chunks.take(pa.array(other)))
            ids = np.insert(ids, np.repeat((np.cumsum(size) - size)[other], each), more)
            size[other] = each
        return ids, size

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one behind the other, and how many each has."""
        if not self.by_parts:
            own = [x.ids for x in self.whole.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            size = np.fromiter(map(len, own), np.int64, len(own))
            return np.fromiter(itertools.chain.from_iterable(own), "<u4", size.sum()), size
        lists = pc.utf8_split_whitespace(texts)
        chunks = lists.flatten().dictionary_encode()
        ids, upto = _gather(*self._of_chunks(chunks.dictionary), chunks.indices.to_numpy())
        each = np.diff(upto[np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])])
        # White space to the splitter, but not to the tokenizer.
        odd = np.flatnonzero(pc.match_substring_regex(texts, "[\x1c-\x1f]").to_numpy(zero_copy_only=False))
        if len(odd):
            parts = np.split(ids, np.cumsum(each)[:-1])
            for i in odd:
                parts[i] = np.frombuffer(self._encoded(texts[i].as_py()), "<u4")
            ids, each = np.concatenate(parts), np.array([len(x) for x in parts])
        return ids, each


_TOKENS: dict[str, _Tokens] = {}
WORKER_CACHES[__name__] = _TOKENS.clear


def token_ids(path: str, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts by the tokenizer file, and how many each text has."""
    if path not in _TOKENS:
        _TOKENS.clear()
        _TOKENS[path] = _Tokens(path)
    return _TOKENS[path].ids(texts)


def _cut(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end_id: int, keep: bool):
    for batch in batches:
        texts = pc.fill_null(batch.column(1), "")
        ids, each = token_ids(path, texts)
        stop = np.cumsum(each)
        ids = np.insert(ids, stop, end_id).astype("<u4")
        each, pieces = each + 1, -(-(each + 1) // capacity)
        row = np.repeat(np.arange(len(each)), pieces)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        size = np.minimum(each[row] - piece * capacity, capacity)
        ends = np.cumsum(size)
        data = memoryview(ids.view(np.uint8))
        crc = np.fromiter((zlib.crc32(data[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), size.tolist(), strict=True)), np.int64, len(ends))
        columns = [batch.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)), as_long(piece * capacity), as_long(size), as_long(crc)]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        if keep:
            columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids.astype(np.int32))))
            names.append("ids")
        yield pa.RecordBatch.from_arrays(columns, names)


class PackingPlan:
    """Where the pieces of each length go. ``counts``: pieces by length. An entry
    says that the pieces of ``length`` from rank ``first`` on go into the bins from
    ``bin`` on, ``each`` to a bin, at ``offset``."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.bins = capacity, 0
        self.entries: list[tuple[int, int, int, int, int]] = []
        self._used = dict.fromkeys(counts, 0)
        self._gaps: dict[int, list[tuple[int, int]]] = {}
        self._sorted: list[int] = []
        left = {s: n for s, n in counts.items() if n}
        self._match([s for s in sorted(left, reverse=True) if 3 * s > capacity], left)
        for s in sorted((s for s in left if 3 * s <= capacity), reverse=True):
            self._fill(s, left[s])

    def _put(self, length: int, bin_: int, bins: int, each: int, offset: int) -> None:
        self.entries.append((length, self._used[length], bin_, each, offset))
        self._used[length] += bins * each

    def _leave(self, gap: int, bin_: int, bins: int) -> None:
        if gap and bins:
            if gap not in self._gaps:
                bisect.insort(self._sorted, gap)
                self._gaps[gap] = []
            self._gaps[gap].append((bin_, bins))

    def _open(self, bins: int) -> int:
        self.bins += bins
        return self.bins - bins

    def _match(self, large: list[int], left: dict[int, int]) -> None:
        """Pairs of pieces above a third of the capacity, the largest first, each with the largest that fits."""
        ascending = sorted(large)
        for s in large:
            while left[s]:
                at = bisect.bisect_right(ascending, min(s, self.capacity - s)) - 1
                while at >= 0 and (not left[ascending[at]] or ascending[at] == s and left[s] == 1):
                    at -= 1
                t = ascending[at] if at >= 0 else None
                n = left[s] if t is None else left[s] // 2 if t == s else min(left[s], left[t])
                first = self._open(n)
                left[s] -= n
                self._put(s, first, n, 1, 0)
                if t is not None:
                    left[t] -= n
                    self._put(t, first, n, 1, s)
                self._leave(self.capacity - s - (t or 0), first, n)

    def _fill(self, s: int, n: int) -> None:
        """Best fit: the fullest bins with room first, then new ones; a bin takes pieces of ``s`` while it can."""
        while n:
            at = bisect.bisect_left(self._sorted, s)
            if at < len(self._sorted):
                gap = self._sorted[at]
                first, bins = self._gaps[gap].pop()
                if not self._gaps[gap]:
                    del self._gaps[gap], self._sorted[at]
            else:
                gap, bins = self.capacity, -(-n // (self.capacity // s))
                first = self._open(bins)
            each = gap // s
            full = min(bins, n // each)
            if full:
                self._put(s, first, full, each, self.capacity - gap)
                self._leave(gap - each * s, first, full)
                n -= full * each
            if full < bins:
                rest = n  # below `each`: the bins left over outnumber what is left to place
                if rest:
                    self._put(s, first + full, 1, rest, self.capacity - gap)
                    self._leave(gap - rest * s, first + full, 1)
                    n -= rest
                self._leave(gap, first + full + bool(rest), bins - full - bool(rest))

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys ``length << 44 | first`` and the entries in that order."""
        e = np.array(self.entries, np.int64).reshape(-1, 5)
        key = (e[:, 0] << 44) | e[:, 1]
        order = np.argsort(key)
        return key[order], e[order]


def _place(batches: Iterator[pa.RecordBatch], plan) -> Iterator[pa.RecordBatch]:
    key, entries = plan.value
    for batch in batches:
        length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
        rank = batch.column("rank").to_numpy(zero_copy_only=False)
        e = entries[np.searchsorted(key, (length << 44) | rank, side="right") - 1]
        nth = rank - e[:, 1]
        names = [c for c in batch.schema.names if c != "rank"]
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in names),
                as_long(e[:, 2] + nth // np.maximum(e[:, 3], 1)),
                as_long(e[:, 4] + nth % np.maximum(e[:, 3], 1) * length),
            ],
            [*names, "sequence_id", "offset"],
        )


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    keep_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``
    (and ``ids`` with ``keep_ids``): where the piece stands in its document and in
    its sequence of at most ``capacity`` tokens, and the crc32 of its ids.

    Null and empty texts are the end id alone. Rows that repeat a document are
    packed as often as they stand there; a null doc_id stays null. Columns other
    than the id and the text are ignored, whatever their names; an empty table gives
    no rows. A very long text is tokenized in one task and cut into pieces like any other.
    The tokenizer file, of any rules, is read on the executors at ``tokenizer_path``;
    where it drops white space, words are looked up one by one, else texts are encoded whole."""
    kind = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    cut = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    cut = in_arrow(cut, _cut, kind, path=tokenizer_path, capacity=capacity, end_id=end_id, keep=keep_ids)
    pieces = stage(cut, "pack-pieces")
    sizes = stage(pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")), "pack-sizes")  # `capacity` rows at most
    plan = PackingPlan({r["length"]: r["n"] for r in sizes.collect()}, capacity)

    own = sizes.select("length", F.ceil(F.col("n") / RANGE_ROWS).alias("ranges"))
    at = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("ranges")).cast("int")
    pieces = pieces.join(F.broadcast(own), "length").withColumn("range", at).drop("ranges")
    before = Window.partitionBy("length").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ahead = pieces.groupBy("length", "range").agg(F.count(F.lit(1)).alias("n"))
    ahead = stage(ahead.select("length", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead")), "pack-ahead")
    inside = Window.partitionBy("length", "range").orderBy("doc_id", "piece", "ids_crc32")
    ranked = pieces.withColumn("nth", F.row_number().over(inside))
    ranked = ranked.join(broadcast_within(ahead, AHEAD_ROWS), ["length", "range"])
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids]
    ranked = ranked.select(*names, (F.col("ahead") + F.col("nth") - 1).alias("rank"))
    shared = docs.sparkSession.sparkContext.broadcast(plan.tables())
    return in_arrow(ranked, _place, f"{kind}, sequence_id long, offset long", plan=shared)
