"""Operators over documents: brute force on small tables, awkward rows, empty tables."""

import hashlib
import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from partweave.llm import common, langid, line_dedup, near_dup
from partweave.llm.langid import fit_languages, held_out, identify_languages
from partweave.llm.line_dedup import drop_repeated_lines, line_counts, removed_lines
from partweave.llm.mixing import mix_sources
from partweave.llm.near_dup import drop_near_duplicates, near_duplicates, radius_for
from partweave.llm.packing import PackingPlan, pack_documents, token_ids
from partweave.llm.pii import find_personal_data, hidden_identifiers, identifiers
from partweave.llm.queries import vocabulary
from partweave.llm.secret_scan import base_secrets, find_secrets
from partweave.llm.sharding import assign_shards, lookup_table


def words_of(text):
    return (text or "").encode().lower().split()


# -- op8 ---------------------------------------------------------------------


def shingles(text, k):
    w = words_of(text)
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def components(rows, k, num, den):
    """Brute force over (id, text) rows with ids: smallest id reachable."""
    sets = {i: shingles(t, k) for i, t in rows}
    best = {i: i for i in sets}
    pairs = [
        (a, b)
        for a, b in itertools.combinations(sets, 2)
        if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])
    ]
    while any(best[a] != best[b] for a, b in pairs):
        for a, b in pairs:
            best[a] = best[b] = min(best[a], best[b])
    return {i: (len(sets[i]), best[i]) for i in sets}


def drifting(n=60):
    """Copies that drift apart: each changes a word or two of an earlier one."""
    base = [f"w{i}" for i in range(60)]
    out = [list(base)]
    for i in range(1, n):
        copy = list(out[i * 7 % len(out)])
        copy[i * 13 % 60] = f"x{i}"
        if i % 3 == 0:
            copy[i * 29 % 60] = f"y{i}"
        out.append(copy)
    return [(i, " ".join(c)) for i, c in enumerate(out)]


def test_near_duplicates_match_brute_force(spark):
    rows = drifting() + [(100 + i, t) for i, t in drifting()[:10]] + [(200, "two words"), (201, "Two  WORDS"), (202, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs, words=3, num=85, den=100).collect()}
    want = components(rows, 3, 85, 100)
    assert got == want and len({c for _, c in want.values()}) > 3


def test_near_duplicates_take_awkward_rows(awkward, nothing):
    out = near_duplicates(awkward, words=3, num=85, den=100).collect()
    assert len(out) == awkward.count()
    by = {r.doc_id: r for r in out if r.doc_id is not None}
    assert {i for i in by if by[i].component_id == 1} == {1, 2, 3, 4}
    assert all(by[i].n_shingles == 0 and by[i].kept for i in (6, 7, 8))
    alone = [r for r in out if r.doc_id is None]
    assert sorted((r.component_id is None, r.kept) for r in alone) == [(False, False), (True, True)]
    assert near_duplicates(nothing).count() == 0
    clash = awkward.withColumnsRenamed({"lang": "cid", "source": "text_hash"})
    kept = drop_near_duplicates(clash, words=3, num=85, den=100)
    assert kept.columns == clash.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted([0, 1, 5, 6, 7, 8, 9, 10, 11, 11, 12, 13])


def test_signature_index_is_exact_within_its_radius():
    """Every pair of signatures within the radius shares a key."""
    import numpy as np
    import pyarrow as pa

    slots, errors = 64, 1
    radius = radius_for(slots, 0.85)
    chunks = near_dup.chunks_for(slots, radius, errors)
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 16, slots, dtype=np.uint16)
    for _ in range(50):
        b = a.copy()
        at = rng.choice(slots, radius, replace=False)
        b[at] += 1
        sig = pa.array([a.tobytes(), b.tobytes()], pa.binary())
        batch = pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int64()), sig], ["cid", "sig"])
        keys = [x.column(0).to_pylist() for x in near_dup._index(iter([batch]), chunks, errors, slots)]
        assert any(p == q for p, q in keys)
    assert radius_for(64, 0.85) < radius_for(64, 0.8) < 40


# -- op2 ---------------------------------------------------------------------


def kept_lines(rows, num=80, den=100):
    sets = [(d, i, x, frozenset(words_of(x))) for d, t in rows if t is not None for i, x in enumerate(t.split("\n"))]
    out = {d: [] for d, _ in rows}
    for d, i, line, s in sets:
        gone = s and any((e, j) < (d, i) and x and den * len(s & x) >= num * len(s | x) for e, j, _, x in sets)
        if not gone:
            out[d].append(line)
    return {d: ("\n".join(out[d]) if t is not None else None) for d, t in rows}


def test_lines_match_brute_force(spark):
    family = [" ".join(f"t{j}" if (i * 5 + j) % 11 else f"z{i}" for j in range(24)) for i in range(42)]
    rows = [(i, "\n".join([*family[i : i + 2], "", "short line", f"own line {i} of words"])) for i in range(40)]
    rows += [(50, None), (51, ""), (52, "short  LINE")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out, _ = line_counts(docs)
    assert {r.doc_id: r.text for r in out.collect()} == kept_lines(rows)


def test_lines_take_awkward_rows(awkward, nothing):
    out, names = line_counts(awkward.withColumnRenamed("lang", "n_lines"))
    assert names[0] == "_n_lines" and out.count() == awkward.count()
    kept = drop_repeated_lines(awkward)
    assert kept.columns == awkward.columns
    ids = [r.doc_id for r in kept.collect()]
    assert {2, 3, 4}.isdisjoint(ids) and ids.count(11) == 2 and {5, 6, 7, 8} <= set(ids)
    assert kept.where("doc_id = 5").first().text.endswith("schläft\n")
    assert drop_repeated_lines(nothing).count() == 0
    gone = {(r.doc, r.line) for r in removed_lines(awkward).where("doc < 100").collect()}
    assert gone == {(2, 0), (3, 0), (4, 0), (5, 2)}


def test_line_whose_prefix_words_share_their_bits_stays():
    entries = np.zeros(2, line_dedup._ENTRY)
    entries["word"], entries["n"], entries["doc"], entries["line"], entries["pos"] = 7, 10, 3, 0, [0, 1]
    other = np.zeros(1, line_dedup._ENTRY)
    other["word"], other["n"], other["doc"], other["line"] = 7, 10, 9, 4
    table = pa.table({"own": [0, 0], "entries": [entries.tobytes(), other.tobytes()]})
    found = line_dedup._pairs(table, 80, 100).to_pylist()
    assert {(r["xdoc"], r["xline"], r["ydoc"], r["yline"]) for r in found} == {(3, 0, 9, 4)}


def _some_entries(rng, size, words, lengths, docs):
    e = np.zeros(size, line_dedup._ENTRY)
    e["word"], e["n"], e["pos"] = rng.integers(0, words, size), rng.choice(lengths, size), rng.integers(0, 12, size)
    e["doc"], e["line"], e["key"] = rng.choice(docs, size), rng.integers(0, 3, size), rng.integers(0, 2, size)
    e["sketch"] = rng.integers(0, 64, (size, 2))
    return e


def _fitting_pairs(e, own, num, den):
    """Every pair of one word that passes the length, position and sketch filters."""
    out = set()
    for i, j in np.argwhere(e["word"][:, None] == e["word"][None, :]):
        x, y = e[i], e[j]
        at = [(int(z["doc"]), int(z["line"]), int(z["key"])) for z in (x, y)]
        nx, ny = int(x["n"]), int(y["n"])
        if at[0] >= at[1] or (len(set(own)) > 1 and own[i] == own[j]) or den * nx < num * ny or den * ny < num * nx:
            continue
        need = -(-num * (nx + ny) // (num + den))
        apart = sum(int(a ^ b).bit_count() for a, b in zip(x["sketch"], y["sketch"], strict=True))
        if nx < 0xFFFF and ny < 0xFFFF and (min(nx - int(x["pos"]), ny - int(y["pos"])) < need or apart * (num + den) > (den - num) * (nx + ny)):
            continue
        out.add((*at[0], *at[1]))
    return out


def _met(e, own, num, den):
    table = pa.table({"own": own, "entries": [x.tobytes() for x in e]})
    names = ["xdoc", "xline", "xkey", "ydoc", "yline", "ykey"]
    return {tuple(r[c] for c in names) for r in line_dedup._pairs(table, num, den).to_pylist()}


@pytest.mark.parametrize("num, den", [(80, 100), (1, 2), (9, 10), (1, 1)])
def test_lines_meet_every_earlier_line_that_passes_the_filters(monkeypatch, num, den):
    monkeypatch.setattr(line_dedup, "LISTED", 10**9)
    rng = np.random.default_rng(5)
    near, far = np.arange(-20, 20), np.array([-(2**62), -1, 0, 7, 2**62])
    for docs in (near, far):
        for lengths in (np.arange(1, 60), np.array([40_000, 60_000, 0xFFFF])):
            e = _some_entries(rng, 200, 4, lengths, docs)
            assert _met(e, [0] * 200, num, den) == _fitting_pairs(e, [0] * 200, num, den)
            e = _some_entries(rng, 120, 1, lengths, docs)
            own = rng.integers(3, 5, 120).tolist()
            assert _met(e, own, num, den) == _fitting_pairs(e, own, num, den)


def test_lines_of_other_lengths_are_not_compared(monkeypatch):
    e = np.zeros(120, line_dedup._ENTRY)
    e["n"], e["doc"], e["word"] = np.arange(120) + 1, np.random.default_rng(0).permutation(120), 7
    e["sketch"] = np.random.default_rng(1).integers(0, 1 << 63, (120, 2))
    compared, count = [], np.bitwise_count
    monkeypatch.setattr(np, "bitwise_count", lambda x: compared.append(x.size) or count(x))
    assert not _met(e, [0] * 120, 80, 100)
    fit = sum(100 * x >= 80 * y for y in range(1, 121) for x in range(1, y))
    assert 0 < sum(compared) <= 2 * fit < 120 * 119 / 4  # two numbers a sketch


def test_piece_hashes_tell_the_same_words_apart(monkeypatch):
    rng = np.random.default_rng(2)
    long = ["x" * n for n in (7, 8, 9, 16, 17, 64, 65, 255, 256, 257, 264, 300)] + ["x" * 64 + "y", "x" * 299 + "z", "y" + "x" * 299]
    odd = ["ä", "Ä", "a\0", "a", "A", "\0", "\0\0", "[", "{", "@", "`", "aB" * 40, "Ab" * 40, "ÉCOLE", "École"]
    words = np.array([*long, *odd, *(f"W{i}" for i in range(50))])
    text = "".join(w + s for w, s in zip(rng.choice(words, 3000), rng.choice([" ", "\n", "\t\r", " \x0b\x0c "], 3000), strict=True))
    text = np.frombuffer(text.encode(), np.uint8)
    whole = common.piece_hashed_words(text)
    start, other = common.hashed_words(text)
    assert (whole[0] == start).all()
    pairs = np.unique(np.stack([whole[1], other]), axis=1).shape[1]
    assert len(np.unique(whole[1])) == len(np.unique(other)) == pairs
    monkeypatch.setattr(common, "_SLICE_BYTES", 64)
    for a, b in zip(whole, common.piece_hashed_words(text), strict=True):
        assert (a == b).all()
    assert [len(x) for x in common.piece_hashed_words(np.empty(0, np.uint8))] == [0, 0]


def test_lines_of_texts_that_repeat_a_doc_id(spark):
    words = [f"w{i}" for i in range(20)]
    texts = [" ".join(words), " ".join([*words[:-1], "changed"]) + "\nonly in the second text", "wholly other words stand here\nonly in the third one"]
    docs = spark.createDataFrame([(1, t) for t in texts], "doc_id long, text string")
    left = [line for r in line_counts(docs)[0].collect() for line in r.text.split("\n")]
    assert sum("w3" in line for line in left) == 1
    assert {"only in the second text", *texts[2].split("\n")} <= set(left)


def test_words_of_many_lines_are_dealt_into_pieces(spark, monkeypatch):
    rows = [(i, f"the value of item number is set to v{i % 90} now") for i in range(100)]
    rows += [(200 + i, f"number set q{i} r{i} s{i}") for i in range(60)] + [(300, "of number set q1 r1 s1 t1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    sizes = []

    def dealt(classes, total, whole=line_dedup._dealt):
        out = whole(classes, total)
        one = out.groupBy("bucket", "i", "j").agg(F.sum(F.length("entries")).alias("n"))
        sizes.extend(r.n // line_dedup._ENTRY.itemsize for r in one.where("bucket < 0").collect())
        return out

    monkeypatch.setattr(line_dedup, "PIECE_ENTRIES", 8)
    monkeypatch.setattr(line_dedup, "_dealt", dealt)
    assert {r.doc_id: r.text for r in line_counts(docs)[0].collect()} == kept_lines(rows)
    assert len(sizes) > 50 and max(sizes) < 50


# -- op6 ---------------------------------------------------------------------


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = fit_languages(docs, F.crc32(F.col("doc_id").cast("string")) % 4 != 2)
    read = identify_languages(docs.withColumn("h", held_out()), model).where("h")
    right, n = read.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count(F.lit(1))).first()
    assert n > 200 and right / n > 0.97
    assert read.where("score < 0 or score > 1").count() == 0


def test_language_of_awkward_rows(awkward, nothing):
    model = fit_languages(awkward, F.lit(True))
    assert model.languages == ("de", "en")
    out = identify_languages(awkward.withColumnRenamed("source", "score"), model)
    assert out.columns[-2:] == ["lang_pred", "_score"]
    got = {r.doc_id: (r.lang_pred, r._score) for r in out.collect()}
    assert all(got[i] == ("und", 0.0) for i in (6, 7, 8, 9))
    assert got[12][0] == "en" and got[13][0] == "de"
    empty = fit_languages(nothing, F.lit(True))
    assert {r.lang_pred for r in identify_languages(awkward, empty).collect()} == {"und"}
    assert identify_languages(nothing, model).count() == 0


def test_language_of_numbers_is_undetermined(spark):
    docs = spark.createDataFrame([(1, "½ ² 12 ④ Ⅷ _"), (2, "²x"), (3, "mot")], "doc_id long, text string").withColumn("lang", F.lit("xx"))
    got = {r.doc_id: r.lang_pred for r in identify_languages(docs, fit_languages(docs, F.lit(True))).collect()}
    assert got == {1: "und", 2: "xx", 3: "xx"}


def test_language_filters_agree_with_plain_sets(spark):
    """The same n-grams in Python sets: the same language, and a score as near as the filter's size allows."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    rows = docs.collect()
    counts = {}
    for r in rows:
        words = langid.words_of(r.text)
        if words:
            counts.setdefault(r.lang, Counter()).update(langid.grams_of(words)[0].tolist())
    share = {k: {g: n / sum(c.values()) for g, n in c.items()} for k, c in counts.items()}
    top = {}
    for s in share.values():
        for g, x in s.items():
            top[g] = max(top.get(g, 0), x)
    sets = {k: {g for g, n in c.items() if n >= langid.LEAST_COUNT and 2 * share[k][g] >= top[g]} for k, c in counts.items()}
    assert max(map(len, sets.values())) < langid.GRAMS
    got = {r.doc_id: (r.lang_pred, r.score) for r in identify_languages(docs, fit_languages(docs, F.lit(True))).collect()}
    for r in rows:
        words = langid.words_of(r.text)
        grams = langid.grams_of(words)[0].tolist() if words else []
        plain = {k: sum(g in s for g in grams) / len(grams) for k, s in sets.items()} if grams else {"und": 0.0}
        lang, score = got[r.doc_id]
        assert abs(score - max(plain.values())) < 0.01 and plain[lang] > max(plain.values()) - 0.01


def test_more_languages_than_a_word_has_bits(spark, monkeypatch):
    monkeypatch.setattr(langid, "MOST_WORDS", 1)  # three filters, one after the other
    def text(i, j):
        return " ".join(f"{chr(0x4E00 + 8 * i + (j * 3 + w) % 8)}{chr(0x4E00 + 8 * i + w % 8)}" for w in range(12))

    rows = [(i * 10 + j, text(i, j), f"l{i:03}") for i in range(150) for j in range(6)]
    rows += [(10_000 + i, f"stray {i}", f"stray{i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = fit_languages(docs, F.lit(True))
    assert len(model.languages) == 190 and len(model.filters) == 3
    read = identify_languages(docs, model).where("doc_id < 10000").collect()
    assert len(read) == 900 and all(r.lang_pred == r.lang for r in read)


# -- op1 ---------------------------------------------------------------------


def test_mixing_keeps_every_row_and_its_weights(spark):
    rows = [(i, "w " * (1 + i % 7), "en", "big" if i % 10 else "small") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out, names = mix_sources(docs, entropy=0.99, max_epochs=4.0, block_tokens=500)
    got = out.toPandas()
    assert set(got.doc_id) == set(range(2000))
    copies = got.groupby(["source", "doc_id"]).size().groupby("source").agg(["min", "max"])
    assert copies.loc["big"].tolist() == [1, 1] and copies.loc["small"]["max"] <= 4 and copies.loc["small"]["min"] >= 3
    share = got.groupby("source")[names["tokens"]].sum() / got[names["tokens"]].sum()
    weight = got.groupby("source")[names["weight"]].first()
    assert (share - weight).abs().max() < 0.01
    sizes = got.groupby(names["block"])[names["tokens"]].sum()
    assert sizes.min() > 400 and sizes.max() < 600
    assert (got.groupby(names["block"])[names["place"]].max() == got.groupby(names["block"]).size()).all()


def test_mixing_takes_awkward_rows(awkward, nothing):
    out, names = mix_sources(awkward.withColumnRenamed("lang", "epoch"), entropy=0.0, max_epochs=1e9)
    assert names["epoch"] == "_epoch" and out.count() == awkward.count()
    assert mix_sources(nothing)[0].count() == 0


def test_very_many_repeated_lines_in_one_text(spark):
    """Linear in the removed lines, and in the lines that stay."""
    import time

    def seconds(n):
        text = "\n".join(["some words that are said again"] * n + [f"line number{i} of{i} its{i} own{i}" for i in range(n)])
        docs = spark.createDataFrame([(1, text), (2, "other words here")], "doc_id long, text string")
        began = time.time()
        out, (_, removed, left) = line_counts(docs)
        got = {r.doc_id: (r[removed], r[left], len(r.text)) for r in out.collect()}
        assert got[1][:2] == (n - 1, n + 1) and got[2][:2] == (0, 1)
        return time.time() - began

    few, many = seconds(10_000), seconds(200_000)
    assert many < 20 * few + 30


# -- op4 ---------------------------------------------------------------------


def test_packing_covers_every_token_once(awkward, nothing):
    import numpy as np
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(vocabulary())
    got = pack_documents(awkward, vocabulary(), keep_ids=True).toPandas()
    for doc_id, text in {(r.doc_id, r.text) for r in awkward.where("doc_id is not null").collect()}:
        want = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        own = got[got.doc_id == doc_id].sort_values(["piece", "sequence_id", "offset"]).drop_duplicates("piece")
        assert np.concatenate(own.ids.to_list()).astype("<u4").tolist() == want.tolist()
        assert own.ids_crc32.tolist() == [zlib.crc32(want[a : a + n].tobytes()) for a, n in zip(own.start, own.length)]
    for _, one in got.sort_values("offset").groupby("sequence_id"):
        ends = (one.offset + one.length).tolist()
        assert one.offset.tolist() == [0, *ends[:-1]] and ends[-1] <= 4096
    assert len(got[got.doc_id == 11]) == 2 and got.doc_id.isna().sum() == 2
    assert pack_documents(nothing, vocabulary()).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_tokens_equal_the_tokenizers(name):
    """Of a vocabulary whose words are looked up one by one, and of one that needs whole texts."""
    import pyarrow as pa
    from tokenizers import Tokenizer

    texts = ["a\x1cb c", "İstanbul ΣΑΣ o'clock <|endoftext|> x", "", "tab\tline nbsp\xa0end ", "é ﬁ 12½ ²", "x" * 3000, " \n ", "e\u0301 don't we'll U.S."]
    whole = Tokenizer.from_file(vocabulary(name))
    want = [whole.encode(t, add_special_tokens=False).ids for t in texts]
    for some in (texts, texts[1:2], texts[2:3], []):
        ids, each = token_ids(vocabulary(name), pa.array(some, pa.string()))
        own = want[texts.index(some[0]) :][: len(some)] if some else []
        assert each.tolist() == [len(x) for x in own] and ids.tolist() == [i for x in own for i in x]


def test_packing_needs_no_more_sequences_than_plain_best_fit(spark):
    """Against the least possible and against best fit over all pieces, the largest first."""
    import bisect

    rows = [(i, "word " * (1 + i * i * 7919 % 5000)) for i in range(300)]
    out = pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), vocabulary()).toPandas()
    gaps = []
    for n in sorted(out.length, reverse=True):
        at = bisect.bisect_left(gaps, n)
        bisect.insort(gaps, (gaps.pop(at) if at < len(gaps) else 4096) - n)
    used = out.sequence_id.nunique()
    assert -(-out.length.sum() // 4096) <= used <= len(gaps)


def test_packing_takes_clashing_names(awkward):
    clash = awkward.withColumnsRenamed({"lang": "length", "source": "rank", "n_chars": "ids"})
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    rows = [sorted(map(str, pack_documents(d, vocabulary()).select(key).collect())) for d in (awkward, clash)]
    assert rows[0] == rows[1]


@pytest.mark.parametrize(
    "counts",
    [{4096: 3}, {1: 10_000}, {1400: 7, 2696: 7, 100: 5}, {2048: 5}, {3000: 2, 1366: 9, 1365: 9, 7: 1000}, {}],
)
def test_plan_places_each_rank_once(counts):
    plan = PackingPlan(counts, 4096)
    key, entries = plan.tables()
    bins = {}
    for length, n in counts.items():
        for rank in range(n):
            i = key.searchsorted((length << 44) | rank, side="right") - 1
            _, first, bin_, each, offset = entries[i].tolist()
            place = (offset + (rank - first) % each * length, length)
            bins.setdefault(bin_ + (rank - first) // each, []).append(place)
    assert len(bins) == plan.bins
    for placed in bins.values():
        placed.sort()
        assert [a for a, _ in placed] == [sum(n for _, n in placed[:i]) for i in range(len(placed))]
        assert sum(n for _, n in placed) <= 4096 and sum(3 * n > 4096 for _, n in placed) <= 2


# -- op3, op9 ----------------------------------------------------------------

_PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain_identifiers(text):
    def good(kind, found):
        digits = re.sub("[^0-9]", "", found)
        if kind == "ip":
            return all(int(p) <= 255 for p in found.split("."))
        if kind == "card":
            total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits)))
            return 13 <= len(digits) <= 19 and total % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    return [(k, *m.span()) for k, p in _PATTERNS.items() for m in p.finditer(text) if good(k, m.group())]


def test_base_identifiers_match_the_plain_patterns():
    import random

    r = random.Random(3)
    pieces = ["a@b.co", "@", ".", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "+1 (017) 555-7713", "0", "-", " ", "x.y", "+", "é"]
    for _ in range(3000):
        text = "".join(r.choice(pieces) for _ in range(r.randint(0, 14)))
        assert identifiers(text) == plain_identifiers(text), text


DISGUISED = [
    ("mail john dot smith at example dot com now", "email", "john dot smith at example dot com"),
    ("write a.b (at) ex-ample [dot] co.uk", "email", "a.b (at) ex-ample [dot] co.uk"),
    ("write to john[at]example.com", "email", "john[at]example.com"),
    ("jоhn@exаmple.cоm wrote", "email", "jоhn@exаmple.cоm"),
    ("user＠example．com", "email", "user＠example．com"),
    ("user&#64;example&#46;com", "email", "user&#64;example&#46;com"),
    ("４１１１ １１１１ １１１１ １１１１", "card", "４１１１ １１１１ １１１１ １１１１"),
    ("4111 1111 1111 111l", "card", "4111 1111 1111 111l"),
    ("one nine two dot one six eight dot zero dot one.", "ip", "one nine two dot one six eight dot zero dot one"),
    ("plus four nine one seven zero one two three four five", "phone", "plus four nine one seven zero one two three four five"),
    ("+1 (four one five) five five five - zero one zero zero", "phone", "+1 (four one five) five five five - zero one zero zero"),
]


@pytest.mark.parametrize("text,kind,span", DISGUISED)
def test_disguised_identifiers_map_back(text, kind, span):
    assert [(k, text[a:b]) for k, a, b in hidden_identifiers(text, identifiers(text))] == [(kind, span)]


@pytest.mark.parametrize(
    "text",
    ["look at this. dot com", "visit us at example.com today", "eins zwei drei vier", "one of two at three", "née à l'été"],
)
def test_clean_text_gains_nothing(text):
    assert hidden_identifiers(text, identifiers(text)) == []


def test_personal_data_of_awkward_rows(spark, awkward, nothing):
    text = "a@b.co 10.0.0.1 é und x at y dot org"
    more = spark.createDataFrame([(20, text, "en", "a", 1)], awkward.schema)
    out = find_personal_data(awkward.unionAll(more))
    assert out.count() == awkward.count() + 1
    found = out.where("doc_id = 20").first().found
    assert [(f.kind, f.start, f.end, f.added, f.value) for f in found] == [
        ("email", 0, 6, False, "a@b.co"),
        ("email", 22, 36, True, "x at y dot org"),
        ("ip", 7, 15, False, "10.0.0.1"),
    ]
    assert find_personal_data(nothing).count() == 0


@pytest.mark.parametrize("text", ["a" * 200_000, "1" * 200_000, "1." * 100_000, "@" * 100_000, "+1 " * 60_000, "one " * 50_000])
def test_long_runs_stay_linear(text):
    hidden_identifiers(text, identifiers(text))


_SECRETS = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII),
    "access": re.compile("AKIA[A-Z0-9]+"),
    "hex": re.compile("[0-9a-f]+"),
}


def plain_secrets(text):
    def good(kind, m):
        return len(m[2]) >= 6 if kind == "assign" else len(m[0]) >= {"access": 20, "hex": 24}[kind]

    found = [(m.start(), i, k, m.end()) for i, (k, p) in enumerate(_SECRETS.items()) for m in p.finditer(text) if good(k, m)]
    return [(k, a, b) for a, _, k, b in sorted(found)]


def test_base_secrets_match_the_plain_patterns():
    import random

    r = random.Random(4)
    pieces = ["password", "Api_Key", "apikey", "token", "secret", '"', "'", " ", ":", "=", "abc", "AKIA", "Z" * 8, "0f" * 6, "x9/+_.", "é", "\n", "AKIA" + "Q7" * 9, "ſecret", "toKen="]
    for _ in range(4000):
        text = "".join(r.choice(pieces) for _ in range(r.randint(0, 14)))
        assert [x[:3] for x in sorted(base_secrets(text), key=lambda x: (x[1], list(_SECRETS).index(x[0])))] == plain_secrets(text), text


def test_secrets_of_awkward_rows(spark, awkward, nothing):
    text = 'token = "abcdef123456" é AKIA' + "Z" * 16
    more = spark.createDataFrame([(20, text, None, None, 1), (20, text, None, None, 1), (21, "w " * 50_000 + text, "en", "a", 1)], awkward.schema)
    docs = awkward.unionAll(more)
    want = sorted((str(r.doc_id), [(k, a, b) for k, a, b in plain_secrets(r.text or "")]) for r in docs.collect())
    for some in (docs, docs.withColumnsRenamed({"lang": "hash", "n_chars": "row"})):
        got = find_secrets(some).collect()
        assert sorted((str(r.doc_id), [(f.kind, f.start, f.end) for f in r.found if not f.added]) for r in got) == want
        assert {(f.owners, f.repositories) for r in got if r.doc_id == 20 for f in r.found} == {(2, 2)}


def test_personal_data_with_clashing_names(awkward):
    plain, clash = (sorted(map(str, find_personal_data(d).select("doc_id", "found").collect())) for d in (awkward, awkward.withColumnsRenamed({"lang": "kind", "source": "body"})))
    assert plain == clash


def test_secrets_by_ownership(spark, nothing):
    live, copied = "ghp_aB3dE5fG7hJ9kL1mN3pQ5rS7tU9vW1xY3zA5", "ghp_Zy9Xw7Vu5Ts3Rq1Po9Nm7Lk5Ji3Hg1Fe9Dc7"
    rows = [(i, f"use {copied} as shown", f"s{i % 5}") for i in range(20)]
    rows += [(100, f"mine {live} here", "s1"), (101, 'TOKEN = "abcdef123456" and AKIA' + "Z" * 16 + " " + "0f" * 12, "s2")]
    rows += [(102, None, None), (103, 'secret: "short"', "s1"), (None, "password=hunter22", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.found for r in find_secrets(docs).collect()}
    assert len(got) == len(rows) and all(not got[i] for i in range(20))
    assert [(f.kind, f.added, f.live, f.owners, f.repositories) for f in got[100]] == [("access", True, True, 1, 1)]
    assert [(f.kind, f.start, f.added) for f in got[101]] == [("assign", 0, False), ("access", 27, False), ("hex", 48, False)]
    assert not got[102] and not got[103] and [f.kind for f in got[None]] == ["assign"]
    assert find_secrets(nothing).count() == 0


def test_secrets_copied_inside_one_source_are_examples(spark):
    live, copied = "ghp_aB3dE5fG7hJ9kL1mN3pQ5rS7tU9vW1xY3zA5", "ghp_Zy9Xw7Vu5Ts3Rq1Po9Nm7Lk5Ji3Hg1Fe9Dc7"
    rows = [(i, f"page {i}: use {copied} as shown", "s1") for i in range(30)]
    rows += [(100 + i, f"mine {live} here", "s1") for i in range(30)] + [(200, f"again {live}", "s1")]
    got = {r.doc_id: r.found for r in find_secrets(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(not got[i] for i in range(30))
    assert all([(f.live, f.owners, f.repositories) for f in got[i]] == [(True, 1, 2)] for i in [*range(100, 130), 200])


# -- op5 ---------------------------------------------------------------------


def filled(names, size):
    """The table by the plain turn-taking loop."""

    def number(text, modulus):
        return int(hashlib.md5(text.encode()).hexdigest()[:8], 16) % modulus

    start = [(number("offset|" + s, size), number("skip|" + s, size - 1) + 1) for s in names]
    owner, at = [None] * size, [0] * len(names)
    for turn in range(size):
        i = turn % len(names)
        while owner[(start[i][0] + at[i] * start[i][1]) % size] is not None:
            at[i] += 1
        owner[(start[i][0] + at[i] * start[i][1]) % size] = names[i]
    return owner


def test_lookup_table_and_small_moves(spark, awkward, nothing):
    names = [f"n{i}" for i in range(7)]
    table = {r.slot: r.shard for r in lookup_table(spark, names, 211).collect()}
    assert [table[i] for i in range(211)] == filled(names, 211)
    fewer = {r.slot: r.shard for r in lookup_table(spark, names[:-1], 211).collect()}
    moved = sum(table[i] != fewer[i] for i in table if table[i] != "n6")
    assert moved < 0.25 * 211
    out, slot, shard = assign_shards(awkward.withColumnRenamed("lang", "slot"), names, 211)
    assert slot == "_slot" and out.count() == awkward.count() and out.where(F.col(shard).isNull()).count() == 0
    assert assign_shards(nothing, names, 211)[0].count() == 0
    with pytest.raises(ValueError):
        lookup_table(spark, names, 210)
