"""Mixing sources to target weights by temperature (operator 10, native).

A source's weight is its token share raised to an exponent and normalised:
exponent 1 keeps the natural mix, 0 gives every source the same weight. The
exponent is bisected on [0, 1] to the largest value whose weights still reach
the target entropy, but not below the smallest one at which no source must be
repeated more often than the limit. Five bisection steps are answered by one
small job that evaluates 31 exponents at once.

The weights are realised as budgeted permutations: with ``b`` tokens of budget
for a source of ``t`` tokens, every document gets ``b div t`` whole epochs, and
the last, partial epoch takes documents in a keyed random order while the sum of
their tokens stays within the rest. The order is a hash, its leading bits are
the block, so the cut is found by summing blocks: first 4,096 blocks per source,
then 4,096 parts of the one block that holds the cut, then the documents of
that part. No window ever holds more than that, however large a source is.

Only SQL functions; the sources themselves stay a table (their number is not
bounded), the driver sees at most 33 sums per bisection round.

Defined results: a null source is a source of its own; documents without words
(null or empty text) hold no tokens and are not drawn; repeated rows are drawn
on their own, those equal in id and length together; extra columns are not read. A table
without tokens gives an empty plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldreports.llm.shared import settled

WORD = r"[^\x20\x09-\x0D]+"
ENTROPY_SHARE = 0.98
MAX_REPEATS = 4.0
BUDGET_SHARE = 1.0
SEED = "mix-1"
BISECTIONS, STEPS = 6, 32  # six rounds of 32 parts: the exponent to 2^-30
BLOCK_BITS = 12
# Tables of one row per source are broadcast up to this many sources (a row
# takes tens of bytes); beyond it Spark chooses the join.
BROADCAST_SOURCES = 100_000
_HASH_BITS = 60


def order_hash(seed: str, epoch: Column, doc_id: Column) -> Column:
    """60-bit hash that orders the documents of a source within an epoch."""
    text = F.concat_ws(":", F.lit(seed), epoch.cast("string"), doc_id.cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, _HASH_BITS // 4), 16, 10).cast("long")


def token_table(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """doc_id, source, n_tokens (words) of each document that has any."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"),
        F.regexp_count(F.col(text_col), F.lit(WORD)).cast("long").alias("n_tokens"),
    ).where(F.col("n_tokens") > 0)


def solve_exponent(shares: DataFrame, entropy_share: float, max_repeats: float, budget_share: float) -> float:
    """The exponent; ``shares`` has one row per source (tokens, share)."""

    def measures(low: float, high: float) -> list:
        grid = F.explode(F.transform(F.sequence(F.lit(0), F.lit(STEPS)), lambda i: F.struct(
            i.alias("i"), (F.lit(low) + F.lit(high - low) * i / STEPS).alias("x"))))
        rows = shares.select("share", grid.alias("g")).select("share", "g.i", F.pow("share", F.col("g.x")).alias("u"))
        # with z = sum(u): entropy = ln z - sum(u ln u) / z; repeats = budget * u / (z * share)
        return rows.groupBy("i").agg(
            F.sum("u").alias("z"), F.sum(F.col("u") * F.ln("u")).alias("ulnu"),
            F.max(F.col("u") / F.col("share")).alias("most"), F.count(F.lit(1)).alias("n"),
        ).select(
            "i", (F.ln("z") - F.col("ulnu") / F.col("z") >= F.lit(entropy_share) * F.ln("n")).alias("even"),
            (F.lit(budget_share) * F.col("most") / F.col("z") <= F.lit(max_repeats)).alias("rare"),
        ).collect()

    def last(test: str, wanted: bool) -> tuple[float, float]:
        """Bracket of the point up to which ``test`` is ``wanted`` (it changes once)."""
        low, high = 0.0, 1.0
        for _ in range(BISECTIONS):
            rows = {r["i"]: r[test] for r in measures(low, high)}
            ok = [i for i in range(STEPS + 1) if rows.get(i) == wanted]
            at = max(ok, default=-1)
            if at < 0:
                return low, low
            if at == STEPS:
                return high, high
            low, high = low + (high - low) * at / STEPS, low + (high - low) * (at + 1) / STEPS
        return low, high

    # entropy falls with the exponent, the most repeated source's count falls too
    return max(last("even", True)[0], last("rare", False)[1])


def weights(docs_tokens: DataFrame, entropy_share: float, max_repeats: float, budget_share: float) -> DataFrame:
    """Per source: tokens, share, weight, budget, whole epochs and the rest of the last one."""
    # one small row per source, read by every bisection round
    sources = settled(docs_tokens.groupBy("source").agg(F.sum("n_tokens").alias("tokens")))
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    shares = sources.withColumn("share", F.col("tokens") / F.lit(total))
    x = solve_exponent(shares, entropy_share, max_repeats, budget_share)
    raised = shares.withColumn("u", F.pow("share", F.lit(x)))
    z = raised.agg(F.sum("u")).first()[0] or 1.0
    budget = F.floor(F.lit(budget_share) * F.lit(total) * F.col("weight")).cast("long")
    return (
        raised.withColumn("weight", F.col("u") / F.lit(z)).withColumn("budget", budget)
        .select(
            "source", "tokens", "share", "weight", "budget",
            F.expr("budget div tokens").cast("int").alias("epochs"),
            (F.col("budget") % F.col("tokens")).alias("rest"),
        )
    )


def _cut(rows: DataFrame, key: Column, rest: str, name: str) -> DataFrame:
    """Per source the block ``name`` that holds the cut, and what is left of the rest before it."""
    blocks = rows.groupBy("source", key.alias(name)).agg(F.sum("n_tokens").alias("_sum"), F.first(rest).alias("_rest"))
    order = Window.partitionBy("source").orderBy(name)
    before = F.coalesce(F.sum("_sum").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return blocks.withColumn("_before", before).where(
        (F.col("_before") <= F.col("_rest")) & (F.col("_rest") < F.col("_before") + F.col("_sum"))
    ).select(F.col("source").alias("_source"), F.col(name), (F.col("_rest") - F.col("_before")).alias(f"{name}_rest"))


def mix(
    docs: DataFrame, entropy_share: float = ENTROPY_SHARE, max_repeats: float = MAX_REPEATS,
    budget_share: float = BUDGET_SHARE, seed: str = SEED,
) -> DataFrame:
    """The drawn documents, one row per document and epoch.

    Columns: doc_id, source, n_tokens, epoch, block, order_key. Reading an
    epoch by ``block`` and then ``order_key`` gives its block permutation.
    """
    tokens = settled(token_table(docs))  # three narrow columns, read by every later step
    plan = settled(weights(tokens, entropy_share, max_repeats, budget_share).select(
        F.col("source").alias("_of"), "epochs", "rest"))
    small = F.broadcast if plan.count() <= BROADCAST_SOURCES else (lambda per_source: per_source)
    rows = tokens.join(small(plan), F.col("source").eqNullSafe(F.col("_of")), "inner").drop("_of").withColumn(
        "u", order_hash(seed, F.col("epochs"), F.col("doc_id")))

    shift = lambda c, bits: F.shiftright(c, _HASH_BITS - bits)
    first = _cut(rows, shift(F.col("u"), BLOCK_BITS), "rest", "cut1")
    inside = rows.join(small(first), F.col("source").eqNullSafe(F.col("_source")) & (shift(F.col("u"), BLOCK_BITS) == F.col("cut1")), "inner").drop("_source")
    second = _cut(inside, shift(F.col("u"), 2 * BLOCK_BITS), "cut1_rest", "cut2")
    part = inside.join(small(second), F.col("source").eqNullSafe(F.col("_source")) & (shift(F.col("u"), 2 * BLOCK_BITS) == F.col("cut2")), "inner").drop("_source")
    # the few documents that share the leading 24 bits of the cut
    # (equal rows are summed together, so they are drawn together)
    running = F.sum("n_tokens").over(Window.partitionBy("source").orderBy("u", "doc_id", "n_tokens"))
    # the cut as one key per source: documents up to (u, doc_id) are in
    cut = part.withColumn("_running", running).groupBy("source").agg(
        F.min("cut2").alias("_cut2"),
        F.max(F.when(F.col("_running") <= F.col("cut2_rest"), F.struct("u", "doc_id", "n_tokens"))).alias("_last"),
    ).withColumnRenamed("source", "_source")
    before = F.coalesce(
        (shift(F.col("u"), 2 * BLOCK_BITS) < F.col("_cut2")) | (F.struct("u", "doc_id", "n_tokens") <= F.col("_last")),
        shift(F.col("u"), 2 * BLOCK_BITS) < F.col("_cut2"), F.lit(False),
    )
    drawn = rows.join(small(cut), F.col("source").eqNullSafe(F.col("_source")), "left").withColumn(
        "copies", F.col("epochs") + F.when(before, 1).otherwise(0)
    ).where(F.col("copies") > 0)
    out = drawn.select("doc_id", "source", "n_tokens", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("epoch"))
    key = order_hash(seed, F.col("epoch"), F.col("doc_id"))
    return out.withColumn("order_key", key).withColumn("block", shift(F.col("order_key"), BLOCK_BITS).cast("int"))
