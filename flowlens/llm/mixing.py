"""Temperature mixing of sources to target weights.

A source's share p of all tokens becomes the weight p**a / sum of p**a.  The
exponent a (1: as found, 0: all sources equal) is bisected until the weights'
entropy reaches a target share of its maximum, or until the most repeated
source is repeated ``repetition`` times (as often as budget * weight / tokens of the source, on average); with both, the exponent that keeps to both.
Measuring is an aggregate over the table of sources; no list of sources
comes to the driver.

The budget is in tokens.  Without one it is the smallest at which every
source is used whole at least once, so no document is lost, and the limit is 2 by default.  A budget that repeats
even the corpus as it is more often than a given limit is an error: both cannot hold.

Documents fall into blocks by hash.  In each epoch a source's blocks are
permuted by a hash of (seed, epoch, block).  A source spends its budget on
whole epochs, then on blocks in the permuted order; the one block that the
budget cuts is ordered by document hash and filled as far as it reaches.
So the schedule is a table of a row per (source, epoch, block), and a
document is taken if its block is, up to the cut.  Running sums over
blocks (of about ``BLOCK`` documents over all sources) and within cut blocks go by 64 ranges of the order's hash,
so no window holds all of a source's blocks.

Tokens are runs of non-blank characters.  Defined results: null source is a
source of its own; null text has no tokens; documents of sources without
tokens are used exactly once; documents that share id and text are taken
or left together; an empty table gives an empty result; other
columns are kept by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.common import column, free_name, store

BLOCK = 4096
SEED = 7
POINTS = 31  # exponents measured in one pass: five halvings
ROUNDS = 8
PART_BITS = 6  # 64 ranges of a hash
REPETITION = 2.0


def tokens(text):
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def _measure(shares: DataFrame, exponents: list[float]) -> list[tuple[float, float, float]]:
    """(share of the largest entropy, repetitions of the most against the least repeated source, and of the most
    if the budget is the corpus) at each exponent."""
    p = F.col("p")
    out = []
    for a in exponents:
        w = F.pow(p, F.lit(a))
        out += [F.sum(w), F.sum(w * F.log(w)), F.max(F.pow(p, F.lit(a - 1))), F.min(F.pow(p, F.lit(a - 1)))]
    row = shares.agg(F.count("*"), *out).first()
    import math

    n, got = row[0], []
    for i in range(len(exponents)):
        z, wl, most, least = row[1 + 4 * i:5 + 4 * i]
        entropy = (math.log(z) - wl / z) / math.log(n) if n > 1 else 1.0
        got.append((entropy, most / least, most / z))
    return got


def bisect(shares: DataFrame, entropy: float | None, repetition: float | None, turns: float | None = None) -> float:
    """The smallest exponent in [0, 1] that keeps to the repetition limit, but no smaller than the entropy needs.

    Entropy falls and repetition falls as the exponent grows.  With an
    entropy target alone: the largest exponent that reaches it.  ``turns``: the budget in corpora, if it is fixed.
    """
    if shares.isEmpty():
        return 1.0

    def search(good, upward: bool) -> float:
        """End of the range of good exponents: the largest if ``upward`` (1 falls short), else the smallest."""
        low, high = 0.0, 1.0
        first = _measure(shares, [low, high])
        if upward and good(first[1]):
            return 1.0
        if not upward and good(first[0]):
            return 0.0
        for _ in range(ROUNDS):
            points = [low + (high - low) * i / (POINTS + 1) for i in range(POINTS + 2)]
            ok = [upward, *(good(m) for m in _measure(shares, points[1:-1])), not upward]
            at = next(i for i in range(1, len(ok)) if ok[i] != ok[0])
            low, high = points[at - 1], points[at]
        return low if upward else high

    wanted = 0.0 if entropy is None else search(lambda m: m[0] >= entropy, True)
    if repetition is not None and turns is not None and turns > repetition * (1 + 1e-9):
        raise ValueError(f"a budget of {turns:g} times the corpus repeats sources more than {repetition:g} times")
    allowed = 0.0 if repetition is None else search(lambda m: (m[1] if turns is None else m[2] * turns) <= repetition, False)
    return max(wanted, allowed)


def _rows(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    key = F.xxhash64(column(id_col).cast("string"), column(text_col))
    return docs.select(column(id_col).alias("doc_id"), column(source_col).alias("source"),
                       tokens(column(text_col)).alias("n_tokens"), key.alias("key"))


def _block(key, blocks: int):
    return F.pmod(F.xxhash64(key, F.lit(SEED)), F.lit(blocks))


def _order(key, epoch):
    return F.xxhash64(key, epoch, F.lit(SEED))


def _running(rows: DataFrame, by: list[str], order: str, value: str, out: str) -> DataFrame:
    """``rows`` with ``out``: the sum of ``value`` over the rows of the same ``by`` whose ``order``, a hash, is not above theirs."""
    rows = rows.withColumn("part", F.shiftright(order, 64 - PART_BITS))
    before = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # at most 64 rows a group
    parts = rows.groupBy(*by, "part").agg(F.sum(value).alias("sum")).select(
        *(F.col(c).alias(f"{c}_") for c in by), F.col("part").alias("part_"), F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("ahead"))
    same = F.col("part") == F.col("part_")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_"))
    inside = Window.partitionBy(*by, "part").orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return (rows.join(parts, same).withColumn(out, F.col("ahead") + F.sum(value).over(inside))
            .drop("part", "part_", "ahead", *(f"{c}_" for c in by)))


def schedule(rows: DataFrame, blocks: int, entropy: float | None = None, repetition: float | str | None = "default",
             budget: float | None = None) -> DataFrame:
    """(source, epoch, block, at, cut, weight): the blocks used, in order of ``at`` (0 to 1); of a block with ``cut``
    only documents whose order is not above it.  ``rows``: stored (key, source, n_tokens)."""
    dealt = rows.withColumn("block", _block(F.col("key"), blocks))
    per_block = store(dealt.groupBy("source", "block").agg(F.sum("n_tokens").alias("t")), "mix-blocks")
    sources = per_block.groupBy("source").agg(F.sum("t").alias("total"))
    corpus = sources.agg(F.sum("total")).first()[0] or 0
    shares = store(sources.withColumn("p", F.col("total") / F.lit(float(max(corpus, 1)))), "mix-shares")
    spoken = shares.where("total > 0")
    if repetition == "default":
        repetition = REPETITION if budget is None else None
    a = bisect(spoken, entropy, repetition, None if budget is None else budget / max(corpus, 1))
    z, least = spoken.agg(F.sum(F.pow("p", F.lit(a))), F.min(F.pow("p", F.lit(a - 1)))).first()
    whole = corpus * (z or 1.0) / (least or 1.0) if budget is None else budget
    weight = F.when(F.col("total") > 0, F.pow("p", F.lit(a)) / F.lit(z or 1.0)).otherwise(0.0)
    spent = shares.withColumn("weight", weight).withColumn(
        "spend", F.when(F.col("total") > 0, F.col("weight") * F.lit(float(whole))).otherwise(0.0))
    full = F.when(F.col("total") > 0, F.floor(F.col("spend") / F.col("total") + 1e-9)).otherwise(1).cast("int")
    spent = spent.withColumn("full", full).withColumn("rest", F.greatest(F.lit(0.0), F.col("spend") - F.col("full") * F.col("total")))
    epochs = spent.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("full"))))
    laid = (
        per_block.join(epochs.select(F.col("source").alias("s"), "epoch", "full", "rest", "spend", "total", "weight"), F.col("source").eqNullSafe(F.col("s")))
        .withColumn("place", F.xxhash64(F.lit(SEED), "epoch", "block"))
    )
    laid = _running(laid, ["source", "epoch"], "place", "t", "upto").withColumn("before", F.col("upto") - F.col("t"))
    last = F.col("epoch") == F.col("full")
    room = F.when(last, F.col("rest") + 1e-6).otherwise(F.lit(float("inf")))
    laid = laid.withColumn("room", room).where(~last | ((F.col("total") > 0) & (F.col("before") < F.col("room"))))
    at = F.when(F.col("spend") > 0, (F.col("epoch") * F.col("total") + F.col("before")) / F.col("spend")).otherwise(0.0)
    laid = store(laid.select("source", "epoch", "block", "t", "before", "room", at.alias("at"), "weight"), "mix-laid")
    fits = F.col("before") + F.col("t") <= F.col("room")
    cut = laid.where(~fits).select(F.col("source").alias("s"), "epoch", F.col("block").alias("k"), "before", "room", "at", "weight")
    inside = dealt.join(cut, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("k"))).withColumn(
        "order", _order(F.col("key"), F.col("epoch")))
    partly = (
        _running(store(inside, "mix-cut"), ["source", "block", "epoch"], "order", "n_tokens", "sum")
        .where(F.col("before") + F.col("sum") <= F.col("room"))
        .groupBy("source", "epoch", "block").agg(F.max("order").alias("cut"), F.first("at").alias("at"), F.first("weight").alias("weight"))
    )
    names = ["source", "epoch", "block", "at", "cut", "weight"]
    return laid.where(fits).withColumn("cut", F.lit(None).cast("long")).select(names).unionByName(partly.select(names))


def _taken(rows: DataFrame, plan: DataFrame, blocks: int, source: str, key: str) -> DataFrame:
    """``rows`` once for each time that the plan takes them, with the plan's columns under mix_*."""
    plan = plan.select(*(F.col(c).alias(f"mix_{c}") for c in plan.columns))
    hit = column(source).eqNullSafe(F.col("mix_source")) & (_block(F.col(key), blocks) == F.col("mix_block"))
    open_ = F.col("mix_cut").isNull() | (_order(F.col(key), F.col("mix_epoch")) <= F.col("mix_cut"))
    return rows.join(plan, hit & open_)


def _plan(docs, id_col, text_col, source_col, targets):
    rows = store(_rows(docs, id_col, text_col, source_col), "mix-rows")
    blocks = max(1, -(-rows.count() // BLOCK))
    return rows, store(schedule(rows, blocks, **targets), "mix-plan"), blocks


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **targets) -> DataFrame:
    """doc_id, source, n_tokens, epoch, block, at, weight: a row for each time a document is used."""
    rows, plan, blocks = _plan(docs, id_col, text_col, source_col, targets)
    return _taken(rows, plan, blocks, "source", "key").select(
        "doc_id", "source", "n_tokens", F.col("mix_epoch").alias("epoch"), F.col("mix_block").alias("block"),
        F.col("mix_at").alias("at"), F.col("mix_weight").alias("weight"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **targets) -> DataFrame:
    """The rows of ``docs``, each as often as the mixture uses it."""
    _, plan, blocks = _plan(docs, id_col, text_col, source_col, targets)
    key = free_name(docs, "mix_key")
    rows = docs.withColumn(key, F.xxhash64(column(id_col).cast("string"), column(text_col)))
    return _taken(rows, plan, blocks, source_col, key).select(*(column(c) for c in docs.columns))
