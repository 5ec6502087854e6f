"""Secret scan with corpus-wide ownership frequency.

Base spans are found by fixed patterns and always stay. A wider net of candidates
(provider token formats, private key blocks, other assignment keys, upper-case
hex) is too loose to report by itself, so it is judged by how the corpus uses each
value: values are hashed, and for each hash the distinct repositories (documents)
and owners (sources) that hold it are counted; documents of one text are one
repository. A value that many owners share, or many repositories of few owners, is
a copied example; one that few of both hold and that looks random is taken for a
live credential. Live candidates are added to the spans, examples are not; base
spans get the same verdict beside them.

Counting is done on distinct (hash, owner), (hash, text) and (hash, repository) pairs, each
pre-aggregated before its shuffle, so a value that a third of all documents hold
is spread over its documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, stage

KINDS = ("assign", "access", "hex")
MOST_OWNERS = 2  # owners of a live-looking value
MOST_REPOSITORIES = 4  # repositories that hold it, equal texts counted once
LEAST_BITS = 3.0  # Shannon entropy a character of a live-looking value

_ASSIGN = re.compile(r"(?:password|passwd|secret|token|api_?key)[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")

# Formats of providers' tokens, by the prefixes they document.
_PROVIDER = re.compile(
    r"(?<![A-Za-z0-9_-])(?:gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{22,}|glpat-[A-Za-z0-9_-]{20,}"
    r"|xox[abprs]-[A-Za-z0-9-]{10,}|sk_(?:live|test)_[A-Za-z0-9]{16,}|rk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}"
    r"|ya29\.[A-Za-z0-9_-]{20,}|ASIA[A-Z0-9]{16}|SG\.[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{16,}|npm_[A-Za-z0-9]{36}"
    r"|eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})"
)
_KEY_BLOCK = re.compile(r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]{0,32}PRIVATE KEY-----")
_OTHER_ASSIGN = re.compile(
    r"(?<![A-Za-z0-9])(?:pwd|passphrase|credentials?|private_?key|access_?key|client_?key|auth(?:orization)?|bearer)"
    r"[\"']? *[:=] *[\"']?(?:bearer +|basic +)?([A-Za-z0-9+/_.=-]{12,})",
    re.I | re.A,
)
_UPPER_HEX = re.compile(r"(?<![0-9A-Fa-f])(?=[0-9A-F]*[A-F])(?=[0-9A-F]*[0-9])[0-9A-F]{24,}(?![0-9A-Fa-f])")


def base_secrets(text: str) -> list[tuple[str, int, int, str]]:
    """``(kind, start, end, value)``, leftmost and not overlapping within a kind; a
    match that is too short is dropped without another try."""
    out = [("assign", *m.span(), m[1]) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        out += [("access", *m.span(), m[0]) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return out + [("hex", *m.span(), m[0]) for m in _HEX.finditer(text)]


def wider_candidates(text: str) -> list[tuple[str, int, int, str]]:
    out = [("access", *m.span(), m[0]) for m in _PROVIDER.finditer(text)]
    if "-----BEGIN" in text:
        out += [("access", *m.span(), m[0]) for m in _KEY_BLOCK.finditer(text)]
    out += [("assign", *m.span(), m[1]) for m in _OTHER_ASSIGN.finditer(text)]
    return out + [("hex", *m.span(), m[0]) for m in _UPPER_HEX.finditer(text)]


def bits(value: str) -> float:
    """Shannon entropy a character."""
    return sum(n / len(value) * math.log2(len(value) / n) for n in Counter(value).values()) if value else 0.0


_FOUND = pa.list_(
    pa.struct(
        [
            ("start", pa.int64()),
            ("place", pa.int32()),
            ("kind", pa.string()),
            ("end", pa.int64()),
            ("added", pa.bool_()),
            ("hash", pa.int64()),
            ("random", pa.bool_()),
        ]
    )
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, texts = [], []
        for text in batch.column(2).to_pylist():
            text = text or ""
            texts.append(xxhash.xxh3_128_digest(text.encode()))
            base = base_secrets(text)
            taken = {(k, a, b) for k, a, b, _ in base}
            own: dict[str, list[tuple[int, int]]] = {k: [(a, b) for kind, a, b, _ in base if kind == k] for k in KINDS}
            found = [(k, a, b, False, v) for k, a, b, v in base]
            for k, a, b, v in wider_candidates(text):
                if (k, a, b) not in taken and all(b <= x or y <= a for x, y in own[k]):
                    own[k].append((a, b))
                    found.append((k, a, b, True, v))
            found.sort(key=lambda x: (x[1], KINDS.index(x[0])))
            rows.append(
                [
                    {
                        "start": a, "place": KINDS.index(k), "kind": k, "end": b, "added": new,
                        "hash": xxhash.xxh64_intdigest(v.encode()) - (1 << 63), "random": bits(v) >= LEAST_BITS,
                    }
                    for k, a, b, new, v in found
                ]
            )
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.binary()), pa.array(rows, _FOUND)], ["doc_id", "owner", "body", "found"])


def find_secrets(
    docs: DataFrame,
    most_owners: int = MOST_OWNERS,
    id_col: str = "doc_id",
    owner_col: str = "source",
    text_col: str = "text",
    most_repositories: int = MOST_REPOSITORIES,
) -> DataFrame:
    """``doc_id, found`` for each row: ``found`` lists ``start, place, kind, end, added,
    owners, repositories, live`` by start, then kind (assign, access, hex).

    Base spans are all there; added ones are wider candidates that look live: at
    least ``LEAST_BITS`` bits a character, at most ``most_owners`` owners and at most
    ``most_repositories`` repositories. ``owners`` and ``repositories`` count the
    distinct owners and doc_ids whose texts hold the value; for ``repositories``,
    doc_ids of one text count as the smallest of them. A null owner is one owner, a null doc_id one
    repository; null texts count as empty; repeated rows are scanned each. Other columns,
    whatever their names, are ignored. A very long text is scanned in one task. An empty table gives no rows."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(owner_col).cast("string").alias("owner"), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    found = "struct<start:long,place:int,kind:string,end:long,added:boolean,hash:long,random:boolean>"
    rows = in_arrow(rows, _scan, f"doc_id {id_type}, owner string, body binary, found array<{found}>")
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "secret-rows")

    each = rows.select("row", "doc_id", "owner", "body", F.explode("found").alias("f"))
    each = each.select("row", "doc_id", "owner", "body", "f.*")
    owners = each.select("hash", "owner").distinct().groupBy("hash").agg(F.count(F.lit(1)).alias("owners"))
    repos = each.groupBy("hash", "body").agg(F.min("doc_id").alias("doc_id"))
    repos = repos.select("hash", "doc_id").distinct().groupBy("hash").agg(F.count(F.lit(1)).alias("repositories"))
    judged = each.drop("body").join(owners, "hash").join(repos, "hash")
    few = (F.col("owners") <= most_owners) & (F.col("repositories") <= most_repositories)
    judged = judged.withColumn("live", F.col("random") & few).where("not added or live")
    kept = F.struct("start", "place", "kind", "end", "added", "owners", "repositories", "live")
    judged = judged.groupBy("row").agg(F.array_sort(F.collect_list(kept)).alias("found"))
    none = F.array().cast("array<struct<start:long,place:int,kind:string,end:long,added:boolean,owners:long,repositories:long,live:boolean>>")
    out = rows.select("row", "doc_id").join(judged, "row", "left")
    return out.select("doc_id", F.coalesce("found", none).alias("found"))
