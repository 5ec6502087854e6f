"""Fill-in-middle transformation with a compressed set of unit boundaries.

A text is cut only between units (a run of letters, or any other code point).
The offsets behind its units are kept as a ``BoundarySet``: containers of 2^16
offsets each, held as an array, a bitmap or runs - whichever is smallest - with
cumulative cardinalities. Offset ``k`` is found by a search for its container
and a select inside it, so both cuts cost two look-ups however long the text.

A document's cuts, its form and whether it is changed at all come from a hash of
its id: they don't depend on the partitioning, and a task that runs again gives
the same rows. The step is one pass without a shuffle."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import fresh_name, workers_import

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = "1"
CHANGED_PERCENT = 90
SPM_PERCENT = 20

_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
_CHUNK = 1 << 16
_BITMAP_BYTES = _CHUNK // 8


class _Array:
    """Sorted 16-bit offsets."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])


class _Runs:
    """Starts of runs of consecutive offsets, and how many offsets lie before each."""

    def __init__(self, low: np.ndarray, first: np.ndarray):
        self.start, self.before = low[first].astype(np.uint16), first

    def select(self, k: int) -> int:
        i = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.start[i]) + k - int(self.before[i])


class _Bitmap:
    """One bit an offset, with the running cardinality of its 64-bit words."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(_CHUNK, bool)
        bits[low] = True
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.upto = np.cumsum(np.bitwise_count(self.words), dtype=np.int64)

    def select(self, k: int) -> int:
        i = int(np.searchsorted(self.upto, k, "right"))
        word, k = int(self.words[i]), k - (int(self.upto[i - 1]) if i else 0)
        for _ in range(k):
            word &= word - 1
        return 64 * i + (word & -word).bit_length() - 1


class BoundarySet:
    """A sorted set of offsets in containers of 2^16, with ``select``."""

    def __init__(self, offsets: np.ndarray):
        high = offsets >> 16
        at = np.flatnonzero(np.diff(high, prepend=-1))
        self.keys = high[at]
        sizes = np.diff(np.append(at, len(offsets)))
        self.upto = np.cumsum(sizes)
        self.containers = [self._pack(offsets[i : i + n] & (_CHUNK - 1)) for i, n in zip(at, sizes, strict=True)]

    @staticmethod
    def _pack(low: np.ndarray) -> _Array | _Runs | _Bitmap:
        first = np.flatnonzero(np.diff(low, prepend=-2) != 1)
        if 4 * len(first) < min(2 * len(low), _BITMAP_BYTES):
            return _Runs(low, first)
        return _Array(low) if 2 * len(low) <= _BITMAP_BYTES else _Bitmap(low)

    def __len__(self) -> int:
        return int(self.upto[-1]) if len(self.upto) else 0

    def select(self, k: int) -> int:
        """The offset of rank ``k``, from 0."""
        i = int(np.searchsorted(self.upto, k, "right"))
        return (int(self.keys[i]) << 16) + self.containers[i].select(k - (int(self.upto[i - 1]) if i else 0))


def boundaries(text: np.ndarray) -> BoundarySet:
    """The offsets, in code points, behind the units of a text (its UTF-8 bytes)."""
    letter = _LETTER[text[(text & 0xC0) != 0x80]]
    inside = letter[:-1] & letter[1:]
    return BoundarySet(np.flatnonzero(~np.append(inside, False)) + 1 if len(letter) else np.empty(0, np.int64))


def _cuts(ids: pa.Array, texts: pa.Array, seed: str, changed: int, spm: int, marks: tuple[str, ...]) -> pa.Array:
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    marks = [m.encode() for m in marks]
    out = []
    for i, doc_id in enumerate(ids.to_pylist()):
        text = data[offsets[i] : offsets[i + 1]]
        ends = boundaries(text)
        n = len(ends)
        digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in (0, 8, 16, 24))
        whole = text.tobytes()
        if not n or h3 % 100 >= changed or any(m in whole for m in marks):
            out.append({"n": n, "form": "plain", "first": None, "second": None})
            continue
        cuts = [ends.select(k - 1) if k else 0 for k in sorted((h1 % (n + 1), h2 % (n + 1)))]
        out.append({"n": n, "form": "spm" if h4 % 100 < spm else "psm", "first": cuts[0], "second": cuts[1]})
    return pa.array(out, pa.struct([("n", pa.int64()), ("form", pa.string()), ("first", pa.int64()), ("second", pa.int64())]))


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: str = SEED,
    changed_percent: int = CHANGED_PERCENT,
    spm_percent: int = SPM_PERCENT,
) -> tuple[DataFrame, dict[str, str]]:
    """Every row with its transformed text: ``n`` units, ``form`` (plain, psm or spm),
    ``prefix_chars``, ``middle_chars`` (null where plain) and ``output``. The names that
    these columns got beside those of ``docs`` are returned with the frame.

    * null text is an empty one, and an empty text is plain;
    * a text that holds a marker is plain, so an output is always readable again;
    * a null id hashes like an empty one; rows that repeat an id share its draws, rows
      that repeat id and text are equal in the output too;
    * a very long text needs some bytes of memory a code point while its boundaries are found;
    * an empty table gives an empty table; columns whose names clash keep theirs, the new ones get
      underscores in front."""
    workers_import(docs.sparkSession)
    names = {c: fresh_name(docs.columns, c) for c in ("n", "form", "prefix_chars", "middle_chars", "output")}
    cut = fresh_name(docs.columns, "fim_cut")

    @arrow_udf("n long, form string, first long, second long")
    def find(ids: pa.Array, texts: pa.Array) -> pa.Array:
        return _cuts(ids, texts, seed, changed_percent, spm_percent, (PREFIX, SUFFIX, MIDDLE))

    text = F.coalesce(F.col(text_col), F.lit(""))
    first, second = F.col(f"{cut}.first").cast("int"), F.col(f"{cut}.second").cast("int")
    prefix, suffix = F.substring(text, F.lit(1), first), F.substring(text, second + 1, F.length(text))
    middle = F.substring(text, first + 1, second - first)
    form = F.col(f"{cut}.form")
    output = (
        F.when(form == "plain", text)
        .when(form == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
    )
    out = docs.withColumn(cut, find(F.col(id_col), text)).select(
        *(F.col(c) for c in docs.columns),
        F.col(f"{cut}.n").alias(names["n"]),
        form.alias(names["form"]),
        F.col(f"{cut}.first").alias(names["prefix_chars"]),
        (F.col(f"{cut}.second") - F.col(f"{cut}.first")).alias(names["middle_chars"]),
        output.alias(names["output"]),
    )
    return out, names


def restored(output: Column, form: Column) -> Column:
    """The text of a ``fill_in_middle`` output, read from the output and its form alone."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    psm, spm = F.concat(parts[1], parts[3], parts[2]), F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
