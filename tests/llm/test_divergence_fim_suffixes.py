"""Source divergence, fill-in-middle and suffix-array dedup: brute force, awkward rows, empty tables."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from partweave.llm import substring_dedup
from partweave.llm.divergence import document_vectors, source_divergence
from partweave.llm.fim import BoundarySet, boundaries, fill_in_middle, restored
from partweave.llm.substring_dedup import drop_repeated_substrings, segments_of
from partweave.llm.suffixes import common_prefixes, suffix_array

from .conftest import ROWS

# -- op11 --------------------------------------------------------------------

_TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def divergence(rows, min_df=3, most_terms=200):
    """The contract's arithmetic over (text, lang, source) rows."""
    groups, df = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = _TERM.findall((text or "").translate(_LOWER))
        groups[lang or "", source or ""].update(terms)
        df[lang or ""].update(set(terms))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in df[lang].items() if n >= min_df]
        total = Counter()
        share = {}

        def shares(counts):
            size = sum(counts[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // size for t in kept}

        for (owner, source), counts in groups.items():
            if owner == lang:
                share[source] = shares(counts)
                total.update(counts)
        q = shares(total)
        for s, p in share.items():
            found = {"pair": [], "term": []}
            for t in share:
                if t != s:
                    found["pair"].append((t, sum((p[w] - share[t][w]) ** 2 // share[t][w] for w in kept)))
            found["term"] = [(w, (p[w] - q[w]) ** 2 // q[w]) for w in kept if groups[lang, s][w] and p[w] > q[w]]
            for part, items in found.items():
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                for rank, (item, value) in enumerate(items[: most_terms if part == "term" else None], 1):
                    out.add((lang, s, part, item, value, rank))
    return out


def test_divergence_matches_brute_force(spark):
    rng = random.Random(5)
    words = [f"w{chr(97 + i)}" for i in range(20)] + ["Straße", "straße", "née", "naïve", "rare"]
    rows = [
        (" ".join(rng.choices(words, k=rng.randint(0, 30))) + rng.choice(["", " 12-x", "\tTab", "_u"]), rng.choice(["en", "de", None]), rng.choice("abcd"))
        for _ in range(120)
    ]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    for options in ({}, {"most_terms": 2}, {"min_df": 1}):
        got = {tuple(r) for r in source_divergence(docs, **options).collect()}
        assert got == divergence(rows, **options)


def test_divergence_keeps_the_most_frequent_terms_within_a_vocabulary_size(spark):
    rows = [("a a a b b c", "en", s) for s in "xyz"] + [("c b", "en", "x")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    got = {tuple(r) for r in source_divergence(docs, vocab_size=2).collect()}
    assert got == divergence([(t.replace("c", ""), lang, s) for t, lang, s in rows])
    assert "c" in {r.item for r in source_divergence(docs).where("part = 'term'").collect()}


def test_divergence_takes_awkward_rows(awkward, nothing):
    got = {tuple(r) for r in source_divergence(awkward).collect()}
    assert got == divergence([(r[1], r[2], r[3]) for r in ROWS])
    assert any(r[0] == "" and r[1] == "c" and r[4] == 0 for r in got)  # a language that keeps no term
    assert source_divergence(nothing).count() == 0 and document_vectors(nothing).count() == 0
    clash = awkward.withColumnsRenamed({"n_chars": "term", "doc_id": "value"})
    assert {tuple(r) for r in source_divergence(clash).collect()} == got


# -- op12 --------------------------------------------------------------------


def fim(doc_id, text):
    """The contract's arithmetic: n, form, prefix_chars, middle_chars, output."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_matches_brute_force(spark):
    rng = random.Random(3)
    letters = "abc XY\n,.é漢𝄞ß0"
    rows = [(i, "".join(rng.choices(letters, k=rng.randint(0, 40)))) for i in range(400)]
    rows += [(500 + i, f"text with {m} inside") for i, m in enumerate(("<P>", "<S>", "<M>", "<p>"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out, names = fill_in_middle(docs)
    assert names["n"] == "n"
    back = restored(F.col("output"), F.col("form")).alias("back")
    forms = Counter()
    for r in out.select("*", back).collect():
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == fim(r.doc_id, r.text)
        assert r.back == r.text
        forms[r.form] += 1
    assert forms["psm"] > forms["spm"] > 20 and forms["plain"] > 20


def test_fill_in_middle_takes_awkward_rows(awkward, nothing):
    clash = awkward.withColumnsRenamed({"lang": "n", "source": "Form", "n_chars": "fim_cut"})
    out, names = fill_in_middle(clash)
    assert names["n"] == "_n" and names["form"] == "_form" and out.columns[: len(clash.columns)] == clash.columns
    got = sorted((str(r.doc_id), r._n, r._form, r.output) for r in out.collect())
    want = sorted((str(i), *(fim(i, t)[k] for k in (0, 1, 4))) for i, t, *_ in ROWS)
    assert got == want
    assert fill_in_middle(nothing)[0].count() == 0


@pytest.mark.parametrize("kind", ["array", "runs", "bitmap", "mixed"])
def test_boundary_set_selects_as_a_sorted_array(kind):
    rng = np.random.default_rng(2)
    n = 300_000
    keep = {"array": rng.random(n) < 0.01, "runs": np.arange(n) % 5000 < 3000, "bitmap": rng.random(n) < 0.4}
    keep["mixed"] = np.where(np.arange(n) < 1 << 16, keep["array"], np.where(np.arange(n) < 1 << 17, keep["runs"], keep["bitmap"]))
    offsets = np.flatnonzero(keep[kind])
    found = BoundarySet(offsets)
    kinds = {type(c).__name__ for c in found.containers}
    assert kinds == ({"_Array", "_Runs", "_Bitmap"} if kind == "mixed" else {"_" + kind.capitalize()})
    assert len(found) == len(offsets)
    for k in [0, len(offsets) - 1, *rng.integers(0, len(offsets), 500).tolist()]:
        assert found.select(k) == offsets[k]
    assert len(boundaries(np.empty(0, np.uint8))) == 0


# -- op13 --------------------------------------------------------------------


def without_repeats(rows, width):
    """(n_bytes, n_removed, n_spans, kept) of (order, text) rows that are in order."""
    seen, out = set(), []
    for text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, np.int8)
        for i in range(len(raw) - width + 1):
            window = raw[i : i + width]
            if window in seen:
                gone[i : i + width] = 1
            seen.add(window)
        runs = int((np.diff(gone, prepend=0) == 1).sum())
        kept = bytes(b for b, g in zip(raw, gone, strict=False) if not g)
        out.append((len(raw), int(gone.sum()), runs, kept))
    return out


def planted(seed, docs=60, letters="abé 1"):
    """Texts with shared passages, copies, near copies and periodic stretches."""
    rng = random.Random(seed)
    noise = lambda n: "".join(rng.choices(letters, k=n))
    passages = [noise(rng.randint(20, 80)) for _ in range(5)]
    out = []
    for i in range(docs):
        text = noise(rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            text += rng.choice([*passages, "x" * rng.randint(1, 60), "xyz" * rng.randint(1, 25)]) + noise(rng.randint(0, 15))
        if i % 7 == 6:
            copy = list(rng.choice(out))
            if copy and i % 2:
                copy[rng.randrange(len(copy))] = "#"
            text = "".join(copy)
        out.append(text)
    return out


@pytest.mark.parametrize(("width", "options"), [(12, {}), (30, {}), (30, {"shard_bytes": 1}), (30, {"key_bytes": 60}), (100, {})])
def test_substring_dedup_matches_brute_force(spark, width, options):
    texts = planted(width)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5, "text")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in drop_repeated_substrings(docs, width, **options).collect()}
    assert got == dict(enumerate(without_repeats(texts, width)))


def test_substring_dedup_of_one_long_text(spark, monkeypatch):
    """Segments cut at slices, and long runs of one key, still find each other."""
    monkeypatch.setattr(substring_dedup, "SLICE_BYTES", 700)
    rng = random.Random(8)
    block = "".join(rng.choices("abcdefgh", k=900))
    text = "".join(rng.choices("abcdefgh", k=1500)) + block + "q" * 9000 + block + "pq" * 3000
    raw = text.encode()
    data = np.frombuffer(raw, np.uint8)
    start, n, key, content, _ = segments_of(data, np.array([len(data)]), 100)
    assert n.sum() == len(data) - 99 and n.max() <= substring_dedup.MOST_WINDOWS
    docs = spark.createDataFrame([(1, text), (2, text[5:])], "doc_id long, text string")
    got = [(r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in drop_repeated_substrings(docs).orderBy("doc_id").collect()]
    assert got == without_repeats([text, text[5:]], 100)


def test_substring_dedup_takes_awkward_rows(awkward, nothing):
    out = drop_repeated_substrings(awkward.withColumnsRenamed({"lang": "doc", "source": "kept"}), width=20)
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out.collect())
    assert len(got) == len(ROWS)
    # Rows without an id come first, in either order (no window is in both), then by id.
    rows = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    assert got == sorted((str(r[0]), *x) for r, x in zip(rows, without_repeats([r[1] for r in rows], 20), strict=True))
    assert drop_repeated_substrings(nothing).count() == 0


def test_substring_dedup_keeps_one_of_repeated_rows(spark):
    long, short = "a longer text that is over the width of the windows", "short"
    docs = spark.createDataFrame([(1, long), (1, long), (1, long), (2, short), (2, short), (2, None), (2, "")], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_removed, r.n_spans, bytes(r.kept)) for r in drop_repeated_substrings(docs, 20).collect())
    n = len(long)
    assert got == [(1, 0, 0, long.encode()), (1, n, 1, b""), (1, n, 1, b""), (2, 0, 0, b""), (2, 0, 0, b""), (2, 0, 0, b"short"), (2, 0, 0, b"short")]


def test_suffix_array_and_common_prefixes_are_exact():
    rng = random.Random(1)
    for _ in range(400):
        n, k = rng.randint(1, 60), rng.choice([1, 2, 3, 5, 200])
        text = np.array([rng.randint(1, k) for _ in range(n)], np.int64)
        text[[rng.randrange(n) for _ in range(rng.randint(0, 3))]] = 0
        order = suffix_array(text, k + 1)
        assert order.tolist() == sorted(range(n), key=lambda i: text[i:].tolist())
        left = np.array([next((j for j in range(n - i) if text[i + j] == 0), n - i) for i in range(n)])
        shared = common_prefixes(text, order, left)
        for a, b in zip(order[:-1], order[1:], strict=True):
            same = 0
            while same < min(left[a], left[b]) and text[a + same] == text[b + same]:
                same += 1
            assert shared[b] == same
