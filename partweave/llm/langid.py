"""Language identification with language-bitmask n-gram filters.

Fitting finds, for each language, its typical character n-grams: those at least
``LEAST_COUNT`` times in the language's sample whose share of the language's
n-grams is no less than half the largest share in any language, the ``grams`` most
frequent ones of them. A bit-sliced Bloom filter holds all languages at once: a
row is a bitmask of languages, in as many 64-bit words as they need; an n-gram sets its
language's bit in ``HASHES`` rows, and the AND of its rows gives every language that has it.
A filter has at most ``MOST_WORDS`` words a row (64 MB in a task, less in the broadcast, which is
compressed); more languages are further filters, read one after the other.

A text's n-grams are looked up; each language's popcount is corrected for the
filter's false positives of that language, ``(hits / n - f) / (1 - f)`` with f
the share of rows that have its bit, to the power of ``HASHES``. The language
with the largest corrected share wins; that share is the score.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import U64, WORKER_CACHES, as_long, fresh_name, in_arrow, mix64, stage

UNDETERMINED = "und"
LENGTHS = (1, 2, 3, 4)
GRAMS = 20_000  # kept of a language; see README for what fewer and more do to accuracy
LEAST_COUNT = 3
FIT_DOCS = 4_000  # labelled documents a language is fitted on, in expectation
ROWS = 1 << 20
HASHES = 3
WORD = 64  # languages a word of a row holds
MOST_WORDS = 8

_WORDS = re.compile(r"[^\W\d_]+")
_CACHE_WORDS = 200_000


def words_of(text: str) -> list[str]:
    """The runs of letters of a text, lower-cased. Fractions, superscripts and such are word characters, but no letters."""
    words = _WORDS.findall(text.lower())
    if all(map(str.isalpha, words)):
        return words
    return "".join(c if c.isalpha() else " " for c in " ".join(words)).split()


@dataclass(frozen=True)
class Filter:
    """``rows`` are bitmasks: ``ROWS`` 64-bit words for the first ``WORD`` of its languages, then for the next; compressed."""

    languages: tuple[str, ...]
    rows: bytes

    def words(self) -> np.ndarray:
        return np.frombuffer(zlib.decompress(self.rows), U64).reshape(-1, ROWS)


@dataclass(frozen=True)
class LanguageModel:
    """Filters of up to ``MOST_WORDS * WORD`` languages each, which stand in the order of their names."""

    filters: tuple[Filter, ...]

    @property
    def languages(self) -> tuple[str, ...]:
        return tuple(name for f in self.filters for name in f.languages)


def grams_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of the words, each word between blanks, and the index of each one's word."""
    code = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le"), "<u4").astype(U64)
    blank = code == 32
    word = np.cumsum(blank) - 1  # at a blank: of the word that follows
    hashes, owners = [], []
    for n in LENGTHS:
        size = len(code) - n + 1
        if size <= 0:
            continue
        h, ok = np.full(size, n, U64), np.ones(size, bool)
        for j in range(n):
            h = h * U64(0x100000001B3) + code[j : j + size] * U64(0x9E3779B97F4A7C15)
            if n == 1 or 0 < j < n - 1:
                ok &= ~blank[j : j + size]
        hashes.append(mix64(h[ok]))
        owners.append(word[:size][ok])
    return np.concatenate(hashes), np.concatenate(owners)


def _rows_for(h: np.ndarray) -> Iterator[np.ndarray]:
    step = (h >> U64(32)) | U64(1)
    for i in range(HASHES):
        yield ((h + U64(i) * step) % U64(ROWS)).astype(np.int64)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words: dict[str, Counter] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words.setdefault(lang, Counter()).update(words_of(text))
    for lang, seen in words.items():
        if not seen:
            continue
        h, owner = grams_of(list(seen))
        order = np.argsort(h, kind="stable")
        h, times = h[order], np.fromiter(seen.values(), np.int64, len(seen))[owner[order]]
        at = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at)), as_long(h[at]), as_long(np.add.reduceat(times, at))], ["lang", "gram", "n"]
        )


def fit_languages(
    docs: DataFrame,
    train,
    fit_docs: int = FIT_DOCS,
    grams: int = GRAMS,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> LanguageModel:
    """A model of the languages of ``docs`` where ``train`` (a boolean Column) holds.

    Rows without text or language are left out. About ``fit_docs`` documents of
    each language are read, all if it has fewer, chosen by a hash of the id;
    up to ``grams`` n-grams of each are kept, for any number of languages."""
    known = docs.where(train & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    known = known.select(F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sizes = dict(known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect())
    languages = tuple(sorted(sizes))
    filters = []
    if languages:
        shares = [(k, min(1.0, fit_docs / sizes[k])) for k in languages]
        shares = F.broadcast(docs.sparkSession.createDataFrame(shares, "lang string, drawn double"))
        drawn = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < F.col("drawn") * (1 << 30)
        counts = in_arrow(known.join(shares, "lang").where(drawn).select("lang", "text"), _count_grams, "lang string, gram long, n long")
        counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
        by_lang, by_gram = Window.partitionBy("lang"), Window.partitionBy("gram")
        share = counts.withColumn("share", F.col("n") / F.sum("n").over(by_lang))
        typical = share.withColumn("top", F.max("share").over(by_gram)).where(
            (F.col("share") * 2 >= F.col("top")) & (F.col("n") >= LEAST_COUNT)
        )
        place = F.row_number().over(by_lang.orderBy(F.desc("n"), "gram"))
        kept = stage(typical.withColumn("place", place).where(F.col("place") <= grams).select("lang", "gram"), "langid-grams")
        size = MOST_WORDS * WORD
        for a in range(0, len(languages), size):
            some = languages[a : a + size]
            table = np.zeros((-(-len(some) // WORD), ROWS), U64)
            own = kept.where((F.col("lang") >= some[0]) & (F.col("lang") <= some[-1])).toPandas()  # `grams` a language at most
            for lang, found in own.groupby("lang")["gram"]:
                word, bit = divmod(some.index(lang), WORD)
                for at in _rows_for(found.to_numpy().astype(np.int64).view(U64)):
                    table[word, at] |= U64(1 << bit)
            filters.append(Filter(some, zlib.compress(table.tobytes(), 1)))
    return LanguageModel(tuple(filters))


class _Reader:
    """Looks words up in the filter and remembers their popcounts."""

    def __init__(self, model: Filter):
        self.languages = model.languages
        self.words = model.words()
        share = [float(((self.words[i // WORD] >> U64(i % WORD)) & U64(1)).mean()) for i in range(len(self.languages))]
        self.wrong = np.array(share) ** HASHES
        self.most = _CACHE_WORDS * WORD // max(WORD, len(self.languages))
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.hits = np.zeros((1024, len(self.languages) + 1), np.int64)

    def learn(self, words: list[str]) -> None:
        h, owner = grams_of(words)
        rows = list(_rows_for(h))
        n, start = len(words), len(self.place)
        while start + n > len(self.hits):
            self.hits = np.concatenate([self.hits, np.zeros_like(self.hits)])
        for i in range(len(self.languages)):
            if i % WORD == 0:
                mask = np.bitwise_and.reduce([self.words[i // WORD, at] for at in rows])
            bit = ((mask >> U64(i % WORD)) & U64(1)).astype(bool)
            self.hits[start : start + n, i] = np.bincount(owner[bit], minlength=n)
        self.hits[start : start + n, -1] = np.bincount(owner, minlength=n)
        self.place.update(zip(words, range(start, start + n), strict=True))

    def read(self, text: str | None) -> tuple[str, float]:
        words = words_of(text or "")
        if not words or not self.languages:
            return UNDETERMINED, 0.0
        if len(self.place) > self.most:
            self.clear()
        new = [w for w in dict.fromkeys(words) if w not in self.place]
        if new:
            self.learn(new)
        total = self.hits[np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))].sum(axis=0)
        share = np.clip((total[:-1] / total[-1] - self.wrong) / np.maximum(1 - self.wrong, 1e-9), 0, 1)
        best = int(share.argmax())
        return self.languages[best], float(share[best])


_READERS: dict[Filter, _Reader] = {}
WORKER_CACHES[__name__] = _READERS.clear


def _identify(batches: Iterator[pa.RecordBatch], model, at: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Adds language and score, or, where an earlier filter has added them, raises them."""
    if model.value not in _READERS:  # a worker keeps the words of its last filter
        _READERS.clear()
        _READERS[model.value] = _Reader(model.value)
    reader = _READERS[model.value]
    for batch in batches:
        found = [reader.read(t) for t in batch.column(at).to_pylist()]
        columns = batch.columns
        if len(columns) == len(names):
            before = zip(columns[-2].to_pylist(), columns[-1].to_pylist(), strict=True)
            found = [x if x[1] > y[1] or y[0] == UNDETERMINED else y for x, y in zip(found, before, strict=True)]
            columns = columns[:-2]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
            names,
        )


def identify_languages(
    docs: DataFrame, model: LanguageModel, text_col: str = "text", pred_col: str = "lang_pred", score_col: str = "score"
) -> DataFrame:
    """``docs`` with the predicted language of each whole text and its score (0 to 1).

    ``und`` with score 0 where the text is null or has no letter (digits, fractions and other
    numbers are none), or the model knows no language. Equal shares go to the first language by
    name. Rows that repeat a document are read as often and get the same answer; an empty
    table gives an empty table. A very long text is read in one task, a word at a time.
    Where ``docs`` has a column of a new one's name, the new one gets underscores in front."""
    pred, score = fresh_name(docs.columns, pred_col), fresh_name(docs.columns, score_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(pred, T.StringType()), T.StructField(score, T.DoubleType())])
    at, spark = docs.columns.index(text_col), docs.sparkSession
    for part in model.filters or (Filter((), zlib.compress(b"")),):
        docs = in_arrow(docs, _identify, schema, model=spark.sparkContext.broadcast(part), at=at, names=schema.names)
    return docs


def held_out(id_col: str = "doc_id"):
    """True for the documents that fitting must not see: crc32 of the id as text leaves 2 by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))
