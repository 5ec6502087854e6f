"""Mixing sources to target weights, in DataFrame operations only.

Temperature mixing raises each source's token share to an exponent between 0
(uniform) and 1 (in proportion) and normalises. The exponent is bisected: it is
the largest that reaches a target entropy, unless that repeats some source more
than ``max_epochs`` times, then the smallest that doesn't. Every round halves
the interval ``STEPS`` times at once, by one aggregate over the small table of
sources.

The run is as long as it takes for every document to be used at least once:
source i gets ``goal_i >= tokens_i`` tokens, in proportion to its weight. A
seeded permutation orders each source's documents; repeating it fills the
goal. Token position p of a source's stream belongs to block
``p * blocks // goal_i``, so each block of about ``block_tokens`` tokens gets
each source by its weight, up to one document; inside a block a second
permutation orders the documents.

Scale. Positions are running sums along a source's permutation, and a source may
hold a third of all rows: a source is cut into hash ranges of about
``RANGE_ROWS`` documents, sums run inside a range, and the ranges' totals (a few
rows for each million documents) are summed ahead and joined back.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_within, fresh_name, stage

STEPS = 6  # halvings of the exponent's interval in one pass over the sources
ROUNDS = 9  # 54 halvings: as fine as a double is between 0 and 1
RANGE_ROWS = 1_000
AHEAD_ROWS = 400_000  # range totals that may be broadcast, of about 120 bytes each: 48 MB
FINE_BITS = 20  # a source has at most so many hash ranges, as a power of two
WORD = "[^ \\t\\n\\x0B\\f\\r]+"


def tokens_of(text_col: str = "text"):
    """White-space words of a text and one more for its end, so no document is free."""
    return (F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)) + 1).cast("long")


def _source_key(source_col: str):
    """A fixed-width key, never null, so that windows and joins on it share one partitioning."""
    return F.coalesce(F.md5(F.col(source_col).cast("string")), F.lit(""))


def _bisect(shares: DataFrame, holds, largest: bool) -> float:
    """The largest (or smallest) exponent in [0, 1] for which ``holds`` - a Column over
    ``z = sum(p ** a)``, ``e = sum(p ** a * ln p)``, ``a``, ``low``, ``high`` - is true,
    where it is true below (or above) some point and false beyond it."""
    n = 1 << STEPS
    a, b = 0.0, 1.0
    for _ in range(ROUNDS):
        step = (b - a) / n
        if step <= 0 or a + step == a:
            break
        at = F.explode(F.array(*(F.lit(a + i * step) for i in range(1, n)))).alias("a")
        tried = shares.select("p", at).groupBy("a").agg(
            F.sum(F.pow("p", "a")).alias("z"),
            F.sum(F.pow("p", "a") * F.log("p")).alias("e"),
            F.min("p").alias("low"),
            F.max("p").alias("high"),
        )
        true = tried.agg(F.count_if(holds).alias("n")).first()["n"]
        k = true if largest else n - 1 - true
        a, b = a + k * step, a + (k + 1) * step
    return a if largest else b


def mixing_exponent(sizes: DataFrame, entropy: float = 0.9, max_epochs: float = 4.0) -> float:
    """The exponent for ``sizes(tokens)``: the largest whose weights have at least
    ``entropy`` times the entropy of uniform weights, or the smallest above it that
    repeats no source more than ``max_epochs`` times while each is used once."""
    top = sizes.agg(
        F.sum("tokens").alias("t"),
        F.count(F.lit(1)).alias("k"),
        F.min("tokens").alias("low"),
        F.max("tokens").alias("high"),
    ).first()
    if not top["k"] or top["low"] == top["high"]:
        return 1.0
    shares = sizes.select((F.col("tokens") / F.lit(float(top["t"]))).alias("p"))
    goal = entropy * math.log(top["k"])
    own = shares.agg(F.sum(-F.col("p") * F.log("p")).alias("h")).first()["h"]
    alpha = 1.0
    if own < goal:
        alpha = _bisect(shares, F.log("z") - F.col("a") * F.col("e") / F.col("z") >= goal, largest=True)
    few = F.pow(F.col("high") / F.col("low"), 1 - F.col("a")) <= max_epochs
    if (top["high"] / top["low"]) ** (1 - alpha) > max_epochs:
        alpha = _bisect(shares, few, largest=False)
    return alpha


def mixing_goals(sizes: DataFrame, alpha: float) -> DataFrame:
    """``sizes`` with each source's ``weight`` (they add up to 1) and ``goal`` in tokens.
    The source with most tokens for its weight has its own tokens as its goal."""
    raw = F.pow(F.col("tokens").cast("double"), F.lit(alpha))
    top = sizes.agg(F.sum(raw).alias("z"), F.max(F.col("tokens") / raw).alias("run")).first()
    if top["z"] is None:
        return sizes.select("*", F.lit(0.0).alias("weight"), F.lit(0).cast("long").alias("goal"))
    goal = F.greatest("tokens", F.round(raw * F.lit(top["run"])).cast("long"))
    return sizes.select("*", (raw / F.lit(top["z"])).alias("weight"), goal.alias("goal"))


def mix_sources(
    docs: DataFrame,
    entropy: float = 0.9,
    max_epochs: float = 4.0,
    block_tokens: int = 1 << 18,
    seed: int = 0,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> tuple[DataFrame, dict[str, str]]:
    """Every row of ``docs`` as often as its source's weight asks for (once at least),
    all columns, with five more: tokens, epoch (from 0), block, place (the order
    inside a block, from 1) and weight of the source; the second value gives
    their names (underscores in front where ``docs`` has such a column).

    A null source is a source; null and empty texts count one token. Rows with
    equal id and text are interchangeable; other columns don't order anything.
    An empty table gives no rows. One source, or equal ones: each row once. A very
    long text is one document: it lies in the block where it begins, past whose tokens it may reach."""
    names = {k: fresh_name(docs.columns, k) for k in ("tokens", "epoch", "block", "place", "weight")}
    own = {k: fresh_name(docs.columns, f"mix_{k}") for k in ("key", "perm", "range", "end")}
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    perm = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("|"), text))
    fine = F.conv(F.substring(perm, 1, FINE_BITS // 4), 16, 10).cast("int")

    sums = [F.sum("tokens").alias("tokens"), F.sum("docs").alias("docs")]
    totals = docs.select(_source_key(source_col).alias("k"), fine.alias("fine"), tokens_of(text_col).alias("tokens"))
    totals = stage(totals.withColumn("docs", F.lit(1)).groupBy("k", "fine").agg(*sums), "mix-totals")
    sizes = stage(totals.groupBy("k").agg(*sums), "mix-sizes")
    goals = mixing_goals(sizes, mixing_exponent(sizes, entropy, max_epochs))
    whole = goals.agg(F.sum("goal").alias("goal"), F.max("docs").alias("docs")).first()
    blocks = max(1, math.ceil((whole["goal"] or 0) / block_tokens))
    ranges = max(0, math.ceil(math.log2(max(1.0, (whole["docs"] or 0) / RANGE_ROWS))))
    shift = max(0, FINE_BITS - ranges)

    # Token positions: a running sum inside a range, and the totals of the ranges before it.
    before = Window.partitionBy("k").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    ahead = totals.groupBy("k", F.shiftright("fine", shift).alias("r")).agg(sums[0])
    ahead = ahead.select("k", "r", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("mix_ahead"))
    goals = goals.select("k", *(F.col(c).alias(f"mix_{n}") for c, n in (("tokens", "all"), ("goal", "goal"), ("weight", "weight"))))
    ahead = ahead.join(goals, "k")
    taken = [*docs.columns, *names.values(), *own.values()]
    there = {c: fresh_name(taken, c) for c in ("mix_ahead", "mix_all", "mix_goal", "mix_weight")}
    ahead = stage(ahead.withColumnsRenamed({"k": own["key"], "r": own["range"]} | there), "mix-ahead")

    rows = docs.withColumns({own["key"]: _source_key(source_col), names["tokens"]: tokens_of(text_col), own["perm"]: perm})
    rows = rows.withColumn(own["range"], F.shiftright(fine, shift))
    inside = Window.partitionBy(own["key"], own["range"]).orderBy(own["perm"]).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn(own["end"], F.sum(names["tokens"]).over(inside))
    rows = rows.join(broadcast_within(ahead, AHEAD_ROWS), [own["key"], own["range"]])
    start = F.col(there["mix_ahead"]) + F.col(own["end"]) - F.col(names["tokens"])
    goal, every, epoch = F.col(there["mix_goal"]), F.col(there["mix_all"]), F.col(names["epoch"])
    last = F.floor((goal - start - 1) / every).cast("int")  # its position last * every + start is below the goal
    rows = rows.withColumn(names["epoch"], F.explode(F.sequence(F.lit(0), F.greatest(last, F.lit(0)))))
    block = F.floor((start + epoch * every).cast("double") / goal.cast("double") * F.lit(float(blocks)))
    rows = rows.withColumn(names["block"], F.least(block, F.lit(blocks - 1)).cast("long"))
    order = F.md5(F.concat_ws("|", names["block"], names["epoch"], own["perm"]))
    place = F.row_number().over(Window.partitionBy(names["block"]).orderBy(order))
    rows = rows.withColumns({names["place"]: place, names["weight"]: F.col(there["mix_weight"])})
    return rows.select(*docs.columns, *names.values()), names
