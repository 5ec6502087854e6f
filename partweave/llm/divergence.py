"""Source divergence audit: how far the term shares of a language's sources lie apart.

Documents become exact sparse count vectors; a language's vocabulary holds the
terms of at least ``min_df`` of its documents, up to ``vocab_size`` of them (the
largest integer: all). This is what CountVectorizer does for each language, as
an aggregation: the vocabulary is a table with an index, never an array on the
driver or in a broadcast. Vectors are summed by (language, source) group.

The measure of two groups sums a floored term over the whole vocabulary, so it
does not come apart into one sum a group. But most counts are zero, and a zero
count has the same share in all terms of a group. With F the term's value, n a
count and 0 the share of a zero count, the sum over all V terms is

    V F(0,0) + sum over terms of s [F(n,0) - F(0,0)] + sum over terms of t [F(0,n) - F(0,0)]
             + sum over terms of both [F(n,m) - F(0,m) - F(n,0) + F(0,0)].

The second and third sums need only how many terms have each count; the last
one runs over what two groups share. All in integers, so it is exact."""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partweave.operators.broadcast import checked_broadcast

from .common import in_arrow, stage

MIN_DF = 3
MAX_VOCABULARY = 2**31 - 1
SCALE = 1_000_000_000
MOST_TERMS = 200

# Bytes that belong to a term: ASCII letters, lower-cased, and all of a character beyond ASCII.
_TERM_BYTES = bytes(
    b + 32 if ord("A") <= b <= ord("Z") else b if b >= 0x80 or ord("a") <= b <= ord("z") else 0x20 for b in range(256)
)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ends, terms, counts = [0], [], []
        for text in batch.column(2).cast(pa.large_binary()).to_pylist():
            seen = Counter(text.translate(_TERM_BYTES).split())
            terms += seen.keys()
            counts += seen.values()
            ends.append(len(terms))
        ends = pa.array(np.array(ends, np.int32))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.ListArray.from_arrays(ends, pa.array(terms, pa.binary()).cast(pa.string())),
                pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64())),
            ],
            ["lang", "source", "terms", "counts"],
        )


def document_vectors(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``(lang, source, terms, counts)`` of each document: its exact sparse vector. Nulls are ''."""
    read = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))]
    return in_arrow(docs.select(*read), _count, "lang string, source string, terms array<string>, counts array<bigint>")


def group_sums(vectors: DataFrame) -> DataFrame:
    """``(lang, source, term, n, df)``: vectors summed by group, and how many of its documents hold the term."""
    entries = vectors.select("lang", "source", F.explode(F.arrays_zip("terms", "counts")).alias("e"))
    entries = entries.select("lang", "source", F.col("e.terms").alias("term"), F.col("e.counts").alias("n"))
    return entries.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("df"))


def vocabulary_of(sums: DataFrame, min_df: int = MIN_DF, vocab_size: int = MAX_VOCABULARY) -> DataFrame:
    """``(lang, term, total)``: the terms that each language keeps; beyond ``vocab_size``, its most frequent ones."""
    kept = sums.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("df").alias("df")).where(F.col("df") >= min_df)
    if vocab_size < MAX_VOCABULARY:
        first = Window.partitionBy("lang").orderBy(F.desc("total"), "term")
        kept = kept.withColumn("at", F.row_number().over(first)).where(F.col("at") <= vocab_size)
    return kept.select("lang", "term", "total")


def _share(n: Column, size: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / size), with a product that no count overflows."""
    return 1 + F.call_function("div", F.lit(SCALE).cast("decimal(18,0)") * (n + 1).cast("decimal(20,0)"), size.cast("decimal(20,0)"))


def _apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def source_divergence(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_df: int = MIN_DF,
    vocab_size: int = MAX_VOCABULARY,
    most_terms: int = MOST_TERMS,
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``. Part ``pair``: each other source of the
    language and how far the group lies from it; part ``term``: the terms that the group uses
    more than its language, the first ``most_terms``.

    * null text, language and source are ''; empty texts have no terms, and a group without
      terms still has its pairs; a language that keeps no term has pairs of value 0;
    * repeated rows count as often as they occur; ids and other columns play no part, whatever their names;
    * equal values rank by the item's UTF-8 bytes;
    * a very long text is counted in one task's memory, as its distinct terms;
    * an empty table gives an empty table."""
    sums = stage(group_sums(document_vectors(docs, text_col, lang_col, source_col)), "divergence-sums")
    words = stage(vocabulary_of(sums, min_df, vocab_size).withColumn("at", F.monotonically_increasing_id()), "divergence-words")
    kept = stage(sums.join(words, ["lang", "term"]).select("lang", "source", "term", "at", "n", "total"), "divergence-kept")

    langs = words.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("lang_n"))
    every = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source")))).distinct()
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("own_n"))
    none = {"v": 0, "lang_n": 0, "own_n": 0}
    groups = every.join(own, ["lang", "source"], "left").join(langs, "lang", "left").fillna(none)
    size = F.greatest(F.col("own_n") + F.col("v"), F.lit(1))  # 0 only without a vocabulary: no share is used then
    groups = stage(groups.withColumn("size", size).withColumn("p0", _share(F.lit(0), F.col("size"))), "divergence-groups")

    known = checked_broadcast(groups)
    shares = kept.join(known, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("size")))
    shares = stage(shares.select("lang", "source", "term", "at", "total", "lang_n", "v", "p", "p0"), "divergence-shares")
    shared = _shared_terms(shares)
    # How many terms of a group have each share: these meet the zero counts of every other group.
    spread = shares.groupBy("lang", "source", "p", "p0").agg(F.count(F.lit(1)).alias("terms"))
    spread, known = stage(spread, "divergence-spread"), known.select("lang", "source", "p0", "v")
    p, zero, p_t, zero_t = (F.col(c) for c in ("p", "p0", "p_t", "p0_t"))
    parts = [
        _met(known, known, F.col("v") * _apart(zero, zero_t)),
        _met(spread, known, F.col("terms") * (_apart(p, zero_t) - _apart(zero, zero_t))),
        _met(known, spread, F.col("terms_t") * (_apart(zero, p_t) - _apart(zero, zero_t))),
        shared,
    ]
    pairs = functools.reduce(DataFrame.unionAll, parts).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("part", F.lit("pair"))

    q = _share(F.col("total"), F.col("lang_n") + F.col("v"))
    terms = shares.withColumn("q", q).where("p > q").withColumn("value", _apart(F.col("p"), F.col("q")))
    terms = terms.select("lang", "source", F.col("term").alias("item"), "value", F.lit("term").alias("part"))
    terms = terms.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= most_terms)
    out = pairs.withColumn("rank", F.row_number().over(first)).unionByName(terms)
    return out.select("lang", "source", "part", "item", "value", "rank")


def _met(groups: DataFrame, others: DataFrame, value: Column) -> DataFrame:
    """``value`` of each row of ``groups`` with each row of another source of its language; the others' columns end in ``_t``."""
    others = others.select("lang", *(F.col(c).alias(f"{c}_t") for c in others.columns if c != "lang"))
    met = groups.join(others, "lang").where("source <> source_t")
    return met.select("lang", "source", F.col("source_t").alias("item"), value.alias("value"))


def _shared_terms(shares: DataFrame) -> DataFrame:
    """What the terms that two groups share add to the sums of their zero counts. ``at`` numbers the
    terms of all languages, so a term's rows meet in an equi-join and are summed by pair before the next shuffle."""
    one = shares.select("at", "lang", "source", "p", "p0")
    two = shares.select("at", *(F.col(c).alias(f"{c}_t") for c in ("source", "p", "p0")))
    p, zero, p_t, zero_t = (F.col(c) for c in ("p", "p0", "p_t", "p0_t"))
    value = _apart(p, p_t) - _apart(zero, p_t) - _apart(p, zero_t) + _apart(zero, zero_t)
    met = one.join(two, "at").where("source <> source_t").select("lang", "source", F.col("source_t").alias("item"), value.alias("value"))
    return met.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
