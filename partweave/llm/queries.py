"""The registered queries of the training-data operators.

Each takes ``(spark, sf_dir)``, applies one operator with its production
parameters to a whole table and returns the whole result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ann import nearest
from .divergence import source_divergence
from .fim import fill_in_middle, restored
from .langid import fit_languages, held_out, identify_languages
from .line_dedup import line_counts
from .mixing import mix_sources
from .near_dup import near_duplicates
from .packing import pack_documents
from .pii import KINDS, find_personal_data
from .secret_scan import KINDS as SECRET_KINDS
from .secret_scan import MOST_OWNERS, MOST_REPOSITORIES, find_secrets

from .sharding import SHARDS, SIZE, assign_shards
from .substring_dedup import drop_repeated_substrings
from .topk import exact_top_k


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, names = mix_sources(_documents(spark, sf_dir))
    picked = [F.col(names[c]).alias(c) for c in ("tokens", "epoch", "block", "place")]
    return out.select("doc_id", "source", *picked, F.round(F.col(names["weight"]), 6).alias("weight"))


_OP1_SQL = """
WITH RECURSIVE base AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+')) + 1 AS tokens,
         md5('0|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')) AS perm
  FROM documents),
sizes AS (SELECT source, CAST(sum(tokens) AS BIGINT) AS tokens FROM base GROUP BY source),
tot AS (SELECT CAST(sum(tokens) AS DOUBLE) AS t, count(*) AS k, min(tokens) AS low, max(tokens) AS high FROM sizes),
p AS (SELECT tokens / t AS p FROM sizes, tot),
flat(i, a, b) AS (
  SELECT 0, CAST(0 AS DOUBLE), CAST(1 AS DOUBLE)
  UNION ALL
  SELECT i + 1, CASE WHEN h >= 0.9 * ln(k) THEN m ELSE a END, CASE WHEN h >= 0.9 * ln(k) THEN b ELSE m END
  FROM (SELECT i, a, b, m, ln(sum(pow(p, m))) - m * sum(pow(p, m) * ln(p)) / sum(pow(p, m)) AS h
        FROM (SELECT i, a, b, (a + b) / 2 AS m FROM flat WHERE i < 54), p GROUP BY i, a, b, m), tot),
reps(i, a, b) AS (
  SELECT 0, CAST(0 AS DOUBLE), CAST(1 AS DOUBLE)
  UNION ALL
  SELECT i + 1, CASE WHEN pow(high / low, 1 - (a + b) / 2) <= 4 THEN a ELSE (a + b) / 2 END,
         CASE WHEN pow(high / low, 1 - (a + b) / 2) <= 4 THEN (a + b) / 2 ELSE b END
  FROM reps, tot WHERE i < 54),
mixed AS (
  SELECT CASE WHEN low = high OR -(SELECT sum(p * ln(p)) FROM p) >= 0.9 * ln(k) THEN 1
              ELSE (SELECT a FROM flat WHERE i = 54) END AS alpha, low, high FROM tot),
exponent AS (
  SELECT CASE WHEN pow(high / low, 1 - alpha) > 4 THEN (SELECT b FROM reps WHERE i = 54) ELSE alpha END AS alpha
  FROM mixed),
raw AS (SELECT source, tokens, pow(CAST(tokens AS DOUBLE), alpha) AS r FROM sizes, exponent),
goals AS (
  SELECT source, tokens AS every, r / (SELECT sum(r) FROM raw) AS weight,
         greatest(tokens, CAST(round(r * (SELECT max(tokens / r) FROM raw)) AS BIGINT)) AS goal
  FROM raw),
run AS (SELECT greatest(1, ceil(sum(goal) / 262144)) AS blocks FROM goals),
pos AS (
  SELECT doc_id, b.source, tokens, perm, every, weight, goal,
         CAST(sum(tokens) OVER (PARTITION BY b.source ORDER BY perm ROWS UNBOUNDED PRECEDING) AS BIGINT) - tokens AS start
  FROM base b JOIN goals g ON b.source IS NOT DISTINCT FROM g.source),
used AS (SELECT *, unnest(range(0, (goal - start - 1) // every + 1)) AS epoch FROM pos),
placed AS (
  SELECT doc_id, source, tokens, epoch, perm, weight,
         CAST(least(floor(CAST(start + epoch * every AS DOUBLE) / CAST(goal AS DOUBLE) * CAST(blocks AS DOUBLE)),
                    blocks - 1) AS BIGINT) AS block
  FROM used, run)
SELECT doc_id, source, CAST(tokens AS BIGINT) AS tokens, CAST(epoch AS INTEGER) AS epoch, block,
       CAST(row_number() OVER (PARTITION BY block ORDER BY md5(block || '|' || epoch || '|' || perm)) AS INTEGER) AS place,
       round(weight, 6) AS weight
FROM placed
"""


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = line_counts(_documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_removed", F.md5("text").alias("text_md5"))


_OP2_SQL = """
WITH lines AS (
  SELECT doc_id, i - 1 AS line_no, parts[i] AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL),
       unnest(range(1, len(parts) + 1)) AS t(i)),
tok AS (
  SELECT doc_id, line_no, line, list_sort(list_distinct(regexp_extract_all(
    translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \\t\\n\\x0B\\f\\r]+'))) AS ts
  FROM lines),
cls AS (
  SELECT ts, len(ts) AS n, min(struct_pack(d := doc_id, l := line_no)) AS f,
         row_number() OVER (ORDER BY min(struct_pack(d := doc_id, l := line_no))) AS id
  FROM tok WHERE len(ts) > 0 GROUP BY ts),
w AS (SELECT id, n, unnest(ts) AS t FROM cls),
df AS (SELECT t, count(*) AS c FROM w GROUP BY t),
r AS (SELECT id, n, t, row_number() OVER (PARTITION BY id ORDER BY c, t) AS pos FROM w JOIN df USING (t)),
pre AS (SELECT * FROM r WHERE pos <= n - (4 * n + 4) // 5 + 1),
cand AS (
  SELECT DISTINCT a.id AS x, b.id AS y FROM pre a JOIN pre b ON a.t = b.t
  WHERE a.id < b.id AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n),
gone AS (
  SELECT DISTINCT y FROM (
    SELECT y, a.n AS na, b.n AS nb, len(list_intersect(a.ts, b.ts)) AS shared
    FROM cand JOIN cls a ON a.id = x JOIN cls b ON b.id = y)
  WHERE 100 * shared >= 80 * (na + nb - shared)),
marked AS (
  SELECT tok.doc_id, line_no, line,
         cls.id IS NOT NULL AND (gone.y IS NOT NULL OR cls.f < struct_pack(d := tok.doc_id, l := line_no)) AS removed
  FROM tok LEFT JOIN cls USING (ts) LEFT JOIN gone ON gone.y = cls.id),
sums AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (removed) AS n_removed,
         md5(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT removed), '')) AS text_md5
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, text_md5
FROM documents d LEFT JOIN sums USING (doc_id)
"""


def _joined(found: str, where: str = "true") -> str:
    """SQL for kind:start:end of the spans in an array of structs, comma-joined in its order."""
    spans = f"transform(filter({found}, x -> {where}), x -> concat_ws(':', x.kind, x.start, x.`end`))"
    return f"array_join({spans}, ',')"


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(_documents(spark, sf_dir))
    count = "cast(size(filter(found, x -> x.kind = '{}' and x.added = {})) as bigint)"
    return found.select(
        "doc_id",
        *(F.expr(count.format(k, "false")).alias(f"n_{k}") for k in KINDS),
        F.expr(f"sha2({_joined('found', 'not x.added')}, 256)").alias("base_sha256"),
        F.expr(_joined("found")).alias("spans"),
        *(F.expr(count.format(k, "true")).alias(f"added_{k}") for k in KINDS),
    )


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_documents(spark, sf_dir), vocabulary())


def shard_names() -> list[str]:
    return [f"shard-{i:04d}" for i in range(SHARDS)]


def op5_lookup_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, slot, shard = assign_shards(_documents(spark, sf_dir), shard_names())
    return out.select("doc_id", F.col(slot).alias("slot"), F.col(shard).alias("shard"))


_OP5_SQL = f"""
WITH RECURSIVE names AS (SELECT i, printf('shard-%04d', i) AS name FROM range({SHARDS}) t(i)),
start AS (
  SELECT i, name, CAST('0x' || substr(md5('offset|' || name), 1, 8) AS BIGINT) % {SIZE} AS o,
         CAST('0x' || substr(md5('skip|' || name), 1, 8) AS BIGINT) % ({SIZE} - 1) + 1 AS s
  FROM names),
orders AS (
  SELECT list(prefs ORDER BY i) AS orders
  FROM (SELECT i, list_transform(range({SIZE}), lambda j: (o + j * s) % {SIZE}) AS prefs FROM start)),
fill(turn, owner) AS (
  SELECT 0, list_transform(range({SIZE}), lambda x: -1)
  UNION ALL
  SELECT turn + 1, list_concat(list_concat(owner[1:slot], [turn % {SHARDS}]), owner[slot + 2:])
  FROM (SELECT turn, owner,
               list_filter(orders[turn % {SHARDS} + 1], lambda p: owner[p + 1] < 0)[1] AS slot
        FROM fill, orders WHERE turn < {SIZE})),
slots AS (
  SELECT slot, name AS shard
  FROM (SELECT unnest(range({SIZE})) AS slot, unnest(owner) AS at FROM fill WHERE turn = {SIZE}) f
  JOIN names ON names.i = f.at)
SELECT doc_id, CAST(slot AS INTEGER) AS slot, shard
FROM (SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) % {SIZE} AS slot
      FROM documents) d
JOIN slots USING (slot)
"""


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    unseen = F.crc32(F.col("doc_id").cast("string")) % 4 != 2
    model = fit_languages(docs, unseen)
    return identify_languages(docs.select("doc_id", held_out().alias("held_out"), "text"), model).drop("text")


def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(_embeddings(spark, sf_dir), F.col("id") % 50 == 0)


_OP7_SQL = """
WITH rows AS (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings WHERE vec_id IS NOT NULL),
parts AS (
  SELECT r, vec_id, unnest(range(len(embedding))) AS t, unnest(embedding) AS x FROM rows
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
w AS (SELECT r, vec_id, t, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS w FROM parts),
scored AS (
  SELECT q.r AS q, c.r AS c, q.vec_id AS query_id, c.vec_id, CAST(sum(q.w * c.w) AS BIGINT) AS score
  FROM w q JOIN w c ON q.t = c.t AND q.r <> c.r WHERE q.vec_id % 50 = 0 GROUP BY ALL),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id, c) AS INTEGER) AS rank, vec_id, score
  FROM scored)
SELECT * FROM ranked WHERE rank <= 5
"""


def op10_multiprobe_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_embeddings(spark, sf_dir), F.col("id") % 50 == 0)


def op8_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(_documents(spark, sf_dir), words=3, num=85, den=100)
    return out.select("doc_id", "n_shingles", "component_id", "kept")


_OP8_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN []
    ELSE list_distinct(list_transform(range(1, greatest(len(ws) - 2, 1) + 1), lambda i: array_to_string(ws[i:i + 2], ' '))) END AS s
  FROM words),
entry AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v
  FROM entry a JOIN entry b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach(u, v) AS (
  SELECT doc_id, doc_id FROM sets
  UNION
  SELECT reach.u, links.v FROM reach JOIN links ON links.u = reach.v),
component AS (SELECT u AS doc_id, min(v) AS component_id FROM reach GROUP BY u)
SELECT sets.doc_id, len(s) AS n_shingles, component_id, sets.doc_id = component_id AS kept
FROM sets JOIN component ON component.doc_id = sets.doc_id
"""


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(_documents(spark, sf_dir))
    count = "cast(size(filter(found, x -> {})) as bigint)"
    return found.select(
        "doc_id",
        *(F.expr(count.format(f"x.kind = '{k}' and not x.added")).alias(f"n_{k}") for k in SECRET_KINDS),
        F.expr(f"sha2({_joined('found', 'not x.added')}, 256)").alias("base_sha256"),
        F.expr(_joined("found")).alias("spans"),
        F.expr(count.format("x.added")).alias("n_added"),
        F.expr(count.format("x.live")).alias("n_live"),
        F.expr(count.format(f"x.owners > {MOST_OWNERS} or x.repositories > {MOST_REPOSITORIES}")).alias("n_example"),
    )


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(_documents(spark, sf_dir))


_OP11_SQL = """
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts
  FROM documents),
entry AS (SELECT r, lang, source, unnest(ts) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS total FROM entry GROUP BY ALL HAVING count(DISTINCT r) >= 3),
grp AS (SELECT DISTINCT lang, source FROM docs),
cell AS (
  SELECT g.lang, g.source, k.term, k.total, coalesce(c.n, 0) AS n
  FROM grp g JOIN kept k ON g.lang = k.lang
  LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM entry GROUP BY ALL) c
    ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sized AS (
  SELECT *, count(*) OVER (PARTITION BY lang, source) AS v, sum(n) OVER (PARTITION BY lang, source) AS own,
         sum(total) OVER (PARTITION BY lang, source) AS every FROM cell),
shares AS (
  SELECT lang, source, term, n, 1 + (1000000000 * CAST(n + 1 AS HUGEINT)) // (own + v) AS p,
         1 + (1000000000 * CAST(total + 1 AS HUGEINT)) // (every + v) AS q
  FROM sized),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
         coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL),
term AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value
  FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
  FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
"""


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, names = fill_in_middle(_documents(spark, sf_dir).select("doc_id", "text"))
    output, form = F.col(names["output"]), F.col(names["form"])
    return out.select(
        "doc_id",
        *(F.col(names[c]).alias(c) for c in ("n", "form", "prefix_chars", "middle_chars")),
        F.sha2(output, 256).alias("output_sha256"),
        F.sha2(restored(output, form), 256).alias("restored_sha256"),
    )


_OP12_SQL = """
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
drawn AS (
  SELECT doc_id, text, units, len(units) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(units) + 1) AS a,
         CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(units) + 1) AS b,
         text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
           OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 AS plain,
         CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 AS spm
  FROM base),
cut AS (
  SELECT doc_id, n, text, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(units[1:least(a, b)], '') AS p, array_to_string(units[least(a, b) + 1:greatest(a, b)], '') AS m,
         array_to_string(units[greatest(a, b) + 1:], '') AS s
  FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_repeated_substrings(_documents(spark, sf_dir))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


_OP13_SQL = """
WITH base AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
found AS (
  SELECT doc_id, range(0, greatest(0, len(x) // 2 - 99)) AS starts,
         list_transform(range(0, greatest(0, len(x) // 2 - 99)), lambda i: md5(substr(x, 2 * i + 1, 200))) AS hs
  FROM base),
win AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS turn
  FROM (SELECT doc_id, unnest(starts) AS i, unnest(hs) AS h FROM found)),
marked AS (
  SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS opens
  FROM win WHERE turn > 1),
spans AS (
  SELECT doc_id, run, min(i) AS a, max(i) + 100 AS b
  FROM (SELECT doc_id, i, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked) GROUP BY ALL),
ends AS (
  SELECT doc_id, a, b FROM spans
  UNION ALL SELECT doc_id, len(x) // 2, len(x) // 2 FROM base),
pieces AS (
  SELECT e.doc_id, a, b, substr(x, 2 * p + 1, 2 * (a - p)) AS piece
  FROM (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a, b), 0) AS p FROM ends) e
  JOIN base ON base.doc_id = e.doc_id)
SELECT doc_id, CAST(sum(len(piece)) // 2 + sum(b - a) AS BIGINT) AS n_bytes, CAST(sum(b - a) AS BIGINT) AS n_removed,
       count(*) - 1 AS n_spans, sha256(unhex(string_agg(piece, '' ORDER BY a, b))) AS kept_sha256
FROM pieces GROUP BY doc_id
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_source_mixing": op1_source_mixing,
    "op2_line_dedup": op2_line_dedup,
    "op3_pii": op3_pii,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_lookup_sharding": op5_lookup_sharding,
    "op6_language_id": op6_language_id,
    "op7_exact_top_k": op7_exact_top_k,
    "op8_minhash_near_dup": op8_minhash_near_dup,
    "op9_secret_scan": op9_secret_scan,
    "op10_multiprobe_ann": op10_multiprobe_ann,
    "op11_source_divergence": op11_source_divergence,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_suffix_dedup": op13_suffix_dedup,
}

ORACLES: dict[str, str] = {
    "op1_source_mixing": _OP1_SQL,
    "op2_line_dedup": _OP2_SQL,
    "op5_lookup_sharding": _OP5_SQL,
    "op7_exact_top_k": _OP7_SQL,
    "op8_minhash_near_dup": _OP8_SQL,
    "op11_source_divergence": _OP11_SQL,
    "op12_fill_in_middle": _OP12_SQL,
    "op13_suffix_dedup": _OP13_SQL,
}
