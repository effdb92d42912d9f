"""Mixing sources to target weights by temperature, realised as budgeted block permutations.

Tokens are white-space words unless ``count_col`` names a column of counts (of
``tokens.count_tokens``, say): a text without spaces counts as one word, so
sources in such scripts or encodings get almost no natural share without it.

1. Token counts per source give its natural share p.  The weights are p^a,
   normalised; a in [0, 1] is the inverse temperature (1: natural, 0: uniform).
2. The exponent is found by narrowing its interval (``SECTIONS``-fold bisection,
   one small aggregate over the sources per step): the largest a whose weights
   have the target entropy, raised until no source repeats more often than
   ``max_epochs`` within the token budget.
3. Each source's documents are dealt into blocks by hash.  A source of weight w
   gets w * budget tokens: whole epochs first, then blocks of one more epoch in
   hashed order until the budget is reached, the last block cut by documents in
   hashed order, never over the budget.  Every epoch orders blocks and documents
   anew.

Prefix sums run over a source's blocks (at most ``MAX_BLOCKS``) and over the
documents of one block, never over a source's documents.

Texts are read twice: once for their counts, which are written, once to be
drawn.  Defined cases: a null text has no tokens, a null or negative count is 0; a null source is a source of its own;
sources without tokens get no weight and their documents are not drawn; an
empty table gives an empty result; repeated rows are drawn each for itself.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from .common import materialise

SECTIONS, STEPS = 32, 5
BLOCK_TOKENS, MAX_BLOCKS = 50_000, 100_000
_WORDS = r"[^\x20\x09-\x0D]+"


def _unhashable(kind: DataType) -> bool:
    return any(name in kind.simpleString() for name in ("map<", "variant"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORDS)).cast("long"), F.lit(0).cast("long"))


def source_shares(counted: DataFrame) -> DataFrame:
    """``source, tokens, docs, share`` of each source that has tokens."""
    per = counted.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs")).filter("tokens > 0")
    total = per.agg(F.sum("tokens").alias("all_tokens"))
    return per.crossJoin(F.broadcast(total)).withColumn("share", F.col("tokens") / F.col("all_tokens"))


def solve_exponent(shares: DataFrame, target_entropy: float | None, max_epochs: float | None, budget_ratio: float = 1.0) -> float:
    """The exponent for ``share`` columns.

    ``target_entropy`` is a fraction of the entropy of equal weights;
    ``max_epochs`` bounds weight * budget / tokens, ``budget_ratio`` is budget / tokens of all sources.
    """
    bounds = shares.agg(F.count("*"), F.min("share")).first()
    n, least = bounds[0], bounds[1]
    if n < 2 or target_entropy is None and max_epochs is None:
        return 1.0

    def at(exponents: list[float]) -> list[tuple[float, float]]:
        """Entropy and repetitions of the rarest source at each exponent."""
        log = F.log("share")
        row = shares.agg(*[x for a in exponents for x in (F.sum(F.exp(a * log)), F.sum(F.exp(a * log) * log))]).first()
        out = []
        for k, a in enumerate(exponents):
            z, zl = row[2 * k], row[2 * k + 1]
            out.append((math.log(z) - a * zl / z, budget_ratio * least ** (a - 1) / z))
        return out

    def largest(ok) -> float:
        """The largest exponent in [0, 1] for which ``ok`` holds, if it holds below some point; else 0."""
        low, high = 0.0, 1.0
        if ok(at([1.0])[0]):
            return 1.0
        for _ in range(STEPS):
            grid = [low + (high - low) * k / SECTIONS for k in range(SECTIONS + 1)]
            good = [k for k, x in enumerate(at(grid)) if ok(x)]
            k = max(good, default=0)
            low, high = grid[k], grid[min(k + 1, SECTIONS)]
        return low

    exponent = 0.0
    if target_entropy is not None:
        exponent = largest(lambda x: x[0] >= target_entropy * math.log(n) - 1e-12)
    if max_epochs is not None and at([exponent])[0][1] > max_epochs:
        low, high = exponent, 1.0  # repetitions of the rarest fall as the exponent rises
        for _ in range(STEPS):
            grid = [low + (high - low) * k / SECTIONS for k in range(SECTIONS + 1)]
            bad = [k for k, x in enumerate(at(grid)) if x[1] > max_epochs]
            k = max(bad, default=-1)
            low, high = grid[max(k, 0)], grid[min(k + 1, SECTIONS)]
        exponent = high
    return exponent


def target_weights(shares: DataFrame, exponent: float, budget: float) -> DataFrame:
    """Adds ``weight`` and ``source_budget`` (tokens)."""
    raw = shares.withColumn("raw", F.pow("share", F.lit(exponent)))
    total = raw.agg(F.sum("raw").alias("raw_total"))
    return raw.crossJoin(F.broadcast(total)).withColumn("weight", F.col("raw") / F.col("raw_total")) \
        .withColumn("source_budget", F.floor(F.col("weight") * budget).cast("long")).drop("raw", "raw_total")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        target_entropy: float | None = 0.95, max_epochs: float | None = 4.0, budget: int | None = None, seed: int = 17,
        block_tokens: int = BLOCK_TOKENS, count_col: str | None = None) -> DataFrame:
    """The drawn rows of ``docs`` with ``n_tokens, weight, epoch, block, block_order, doc_order`` added.

    Sorting by epoch, block_order, doc_order gives the training order.  Without
    ``budget`` as many tokens are drawn as the table holds.  Columns of the
    added names are replaced.
    """
    count = word_count(F.col(f"`{text_col}`")) if count_col is None else \
        F.greatest(F.coalesce(F.col(f"`{count_col}`").cast("long"), F.lit(0)), F.lit(0))
    added = ["n_tokens", "weight", "epoch", "block", "block_order", "doc_order"]
    names = [c for c in docs.columns if c not in added]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), count.alias("n_tokens"))
    rows = rows.withColumn("source", F.coalesce(F.concat(F.lit("="), F.col(f"row.`{source_col}`").cast("string")), F.lit("null"))) \
        .withColumn("mark", F.xxhash64(F.lit(seed), F.col(f"row.`{id_col}`"), F.col(f"row.`{text_col}`")))
    counted = materialise(rows.select("source", "mark", "n_tokens"), "mix_counts")
    per = materialise(source_shares(counted), "mix_sources")
    total = per.agg(F.max("all_tokens")).first()[0] or 0
    budget = total if budget is None else budget
    exponent = solve_exponent(per, target_entropy, max_epochs, budget / total) if total else 1.0
    blocks_of = F.least(F.ceil(F.col("tokens") / block_tokens), F.lit(MAX_BLOCKS)).cast("int")
    plan = target_weights(per, exponent, float(budget)).select("source", "weight", "source_budget", "tokens", blocks_of.alias("n_blocks"))
    plan = materialise(plan, "mix_plan")

    block = F.pmod(F.xxhash64(F.lit(seed + 1), "mark"), F.col("n_blocks")).cast("int")
    sized = counted.join(plan, "source").withColumn("block", block) \
        .groupBy("source", "block").agg(F.sum("n_tokens").alias("held"), F.first("weight").alias("weight"),
                                         F.first("source_budget").alias("source_budget"), F.first("tokens").alias("tokens"))
    full = F.floor(F.col("source_budget") / F.col("tokens")).cast("int")
    sized = sized.withColumn("full_epochs", full).withColumn("left", F.col("source_budget") - F.col("full_epochs") * F.col("tokens")) \
        .withColumn("order", F.xxhash64(F.lit(seed + 2), "full_epochs", "source", "block"))
    before = F.coalesce(F.sum("held").over(Window.partitionBy("source").orderBy("order", "block")
                                           .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    dealt = sized.withColumn("room", F.col("left") - before).select(
        "source", "block", "weight", "full_epochs", F.when(F.col("room") >= F.col("held"), F.lit(-1)).otherwise(
            F.greatest(F.col("room"), F.lit(0))).cast("long").alias("room"))  # -1: the whole block fits
    dealt = materialise(dealt, "mix_blocks")

    placed = rows.join(plan.select("source", "n_blocks"), "source").withColumn("block", block).drop("n_blocks") \
        .join(dealt, ["source", "block"])
    # only the block where a budget ends is cut by documents
    cut = placed.filter("room > 0")
    # rows equal in id and text are told apart by their other columns, so a retried task cuts the same ones
    other = [F.col(f"row.`{f.name}`") for f in docs.schema if f.name in names and not _unhashable(f.dataType)]
    inside = Window.partitionBy("source", "block").orderBy(F.xxhash64(F.lit(seed + 3), "mark"), "mark", F.xxhash64(F.lit(seed), *other)) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = cut.withColumn("more", (F.sum("n_tokens").over(inside) <= F.col("room")).cast("int"))
    whole = placed.filter("room <= 0").withColumn("more", (F.col("room") == -1).cast("int"))
    drawn = whole.unionByName(cut).withColumn("copies", F.col("full_epochs") + F.col("more")).filter("copies > 0") \
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    return drawn.select(*[F.col(f"row.`{c}`").alias(c) for c in names], "n_tokens", "weight", "epoch", "block",
                        F.xxhash64(F.lit(seed + 2), "epoch", "source", "block").alias("block_order"),
                        F.xxhash64(F.lit(seed + 3), "epoch", "mark").alias("doc_order"))
