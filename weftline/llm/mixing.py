"""Temperature mixing of sources to target weights.

A source's weight is its share of the tokens to the power of an exponent, normalised. The exponent is bisected until
the weights have a target entropy, or until no source is repeated more often than a limit. The weights are then
realised within a budget of tokens: each source runs through whole epochs, and one last epoch in part. An epoch is a
permutation of the source's blocks, and of the documents in each block, seeded by source and epoch.

Selection in the last epoch is a cut in that order: whole blocks, and one block up to a document. The cut of a source
comes from sums per block, then per stretch of the one block where the budget ends, then from the rows of the one stretch
where it does (about a millionth of the source), so a source of any size is handled in parallel, and each document is placed by its own row and its source's one row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import staging
from . import textkernel as K

BLOCKS = 1024
#: Stretches of a block's order, a power of two.
PARTS = 1024


def words_of(text_col: str) -> Column:
    """A document's tokens: its runs of visible characters, at least one so that no document is free."""
    return F.greatest(F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"\S+")), F.lit(1)).cast("long")


def _grid(shares: DataFrame, exponents: list[float]) -> list:
    """Entropy of the weights and the ratio of the most to the least repeated source, for each exponent."""
    tried = shares.select("share", F.explode(F.array(*map(F.lit, exponents))).alias("a"))
    p = F.pow("share", F.col("a"))
    sums = tried.groupBy("a").agg(F.sum(p).alias("z"), F.sum(p * F.col("a") * F.log("share")).alias("e"), F.max(p / F.col("share")).alias("high"), F.min(p / F.col("share")).alias("low"))
    return sums.select("a", (F.log("z") - F.col("e") / F.col("z")).alias("entropy"), (F.col("high") / F.col("low")).alias("repeats")).orderBy("a").collect()


def exponent(shares: DataFrame, entropy: float | None = None, repeats: float | None = None, passes: int = 8, width: int = 16) -> float:
    """The exponent in [0, 1]: 1 leaves the shares as they are, 0 makes sources equal.

    With entropy (nats): the one that meets it, or the nearer end. With repeats: the smallest one at which no source
    is repeated more than so many times as often as the least repeated one. Each pass narrows the interval to one of
    ``width`` parts by one aggregate, so nothing of the sources reaches the driver but sums.
    """
    if (entropy is None) == (repeats is None):
        raise ValueError("give an entropy or a limit of repeats")
    low, high = 0.0, 1.0
    for _ in range(passes):
        at = [low + (high - low) * i / width for i in range(width + 1)]
        rows = _grid(shares, at)
        if not rows:
            return 1.0
        # Both fall as the exponent grows.
        fits = [r.a for r in rows if (r.entropy <= entropy if entropy is not None else r.repeats <= repeats)]
        if not fits:
            return high
        first = min(fits)
        if first == low:
            return low
        low, high = max(a for a in at if a < first), first
    return high


def _key(*parts) -> Column:
    return F.xxhash64(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def plan(rows: DataFrame, entropy: float | None = None, repeats: float | None = None, budget: int | None = None, seed: int = 0) -> DataFrame:
    """One row per source: weight, target, epochs, and the cut (block, document) in the last epoch's order.

    rows: (source, tokens, doc, block). budget None: the least at which every source runs through once.
    """
    totals = staging.put(rows.groupBy("source").agg(F.sum("tokens").alias("own"), F.count("*").alias("documents")), "sources")
    whole = totals.agg(F.sum("own")).first()[0] or 1
    shares = totals.withColumn("share", F.col("own") / whole)
    a = exponent(shares.select("share"), entropy, repeats)
    power = F.pow("share", F.lit(a))
    z, low = shares.agg(F.sum(power), F.min(power / F.col("share"))).first()
    z, low = z or 1.0, low or 1.0
    # At the least budget the least repeated source has exactly one epoch.
    least = whole * z / low
    spend = float(budget) if budget is not None else least
    repeat = F.lit(spend / whole) * (power / F.lit(z)) / F.col("share")
    repeat = F.when(F.abs(repeat - F.round(repeat)) < 1e-9, F.round(repeat)).otherwise(repeat)
    out = shares.select("source", "own", "documents", "share", (power / F.lit(z)).alias("weight"), F.lit(a).alias("exponent"), repeat.alias("repeats"))
    out = out.withColumn("epochs", F.floor("repeats").cast("int")).withColumn("left", F.round((F.col("repeats") - F.col("epochs")) * F.col("own")).cast("long"))
    # The order of blocks in the last epoch; a source has at most BLOCKS of them.
    blocks = rows.groupBy("source", "block").agg(F.sum("tokens").alias("tokens")).join(out.select("source", "epochs", "left"), "source")
    blocks = blocks.withColumn("place", _block_key("source", "epochs", "block", seed))
    order = Window.partitionBy("source").orderBy("place", "block")
    run = blocks.withColumn("before", F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("tokens"))
    edge = run.where((F.col("before") < F.col("left")) & (F.col("before") + F.col("tokens") >= F.col("left"))).select("source", "block", "epochs", F.col("place").alias("cut_block"), (F.col("left") - F.col("before")).alias("room"))
    inside = rows.join(edge, ["source", "block"]).withColumn("at", _doc_key("doc", "epochs", seed))
    # Within the one block the budget ends in one of PARTS stretches of the order, and only that is ordered by row.
    inside = inside.withColumn("part", F.shiftright("at", 64 - int(math.log2(PARTS))))
    parts = inside.groupBy("source", "cut_block", "room", "part").agg(F.sum("tokens").alias("tokens"))
    order = Window.partitionBy("source").orderBy("part")
    run = parts.withColumn("before", F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("tokens"))
    edge = run.where("before < room AND before + tokens >= room").select("source", "part", (F.col("room") - F.col("before")).alias("left"))
    # Equal rows meet as one.
    steps = inside.join(edge, ["source", "part"]).groupBy("source", "cut_block", "left", "at").agg(F.sum("tokens").alias("tokens"))
    within = Window.partitionBy("source").orderBy("at")
    cut = steps.withColumn("before", F.sum("tokens").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("tokens"))
    cut = cut.where("before < left").groupBy("source", "cut_block").agg(F.max("at").alias("cut_doc"))
    return staging.put(out.join(cut, "source", "left"), "mixing-plan")


def _block_key(source: str, epoch: str, block: str, seed: int) -> Column:
    return _key(seed, "block", F.col(source), F.col(epoch).cast("int"), F.col(block))


def _doc_key(doc: str, epoch: str, seed: int) -> Column:
    return _key(seed, "doc", F.col(doc), F.col(epoch).cast("int"))


def mix(docs: DataFrame, entropy: float | None = None, repeats: float | None = 2.0, budget: int | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", tokens: Column | None = None, seed: int = 0) -> DataFrame:
    """A row of docs for each of its copies in the mixture, with mix_epoch, mix_weight, mix_block and mix_position.

    mix_position in [0, 1) orders the mixture: sorted by it, every stretch holds the sources in about their weights.
    A source's copies are as even as can be: every document has the whole epochs, and those before the cut one more.
    Null and empty sources count as one source. Null texts have one token. Rows that repeat id and text are placed
    alike; ties of place don't matter, as equal places are equal rows. An empty table gives none. Columns of docs named
    like the four added ones are replaced, all others are kept.
    """
    added = ["mix_epoch", "mix_weight", "mix_block", "mix_position"]
    base = docs.drop(*added)
    doc = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))
    light = base.select(F.coalesce(F.col(source_col), F.lit("")).alias("source"), (tokens if tokens is not None else words_of(text_col)).alias("tokens"), doc.alias("doc"), F.pmod(doc, F.lit(BLOCKS)).cast("int").alias("block"))
    chosen = plan(staging.put(light, "mixing-rows"), entropy, repeats, budget, seed)
    # Inner columns have names that docs has not.
    source, doc_, block, epochs, again, cut_block, cut_doc, copies_ = (K.fresh([*docs.columns, *added], c) for c in ("of", "doc", "block", "epochs", "repeats", "cut_block", "cut_doc", "copies"))
    # One row per source; the optimizer broadcasts it where its size is below the session's limit.
    placed = base.withColumns({source: F.coalesce(F.col(source_col), F.lit("")), doc_: doc, block: F.pmod(doc, F.lit(BLOCKS)).cast("int")}).join(chosen.select(F.col("source").alias(source), F.col("epochs").alias(epochs), F.col("weight").alias("mix_weight"), F.col("repeats").alias(again), F.col("cut_block").alias(cut_block), F.col("cut_doc").alias(cut_doc)), source)
    place = _block_key(source, epochs, block, seed)
    in_last = (place < F.col(cut_block)) | ((place == F.col(cut_block)) & (_doc_key(doc_, epochs, seed) <= F.col(cut_doc)))
    copies = F.col(epochs) + F.coalesce(in_last, F.lit(False)).cast("int")
    out = placed.withColumn(copies_, copies).where(F.col(copies_) > 0).withColumn("mix_epoch", F.explode(F.sequence(F.lit(0), F.col(copies_) - 1)))
    # The place in an epoch: the block's, then the document's within it, each by the epoch's own order.
    to_unit = lambda k: (F.shiftrightunsigned(k, 12).cast("double") / float(1 << 52))
    spot = to_unit(_block_key(source, "mix_epoch", block, seed).bitwiseXOR(F.lit(-(1 << 63))))
    jitter = to_unit(_doc_key(doc_, "mix_epoch", seed)) / BLOCKS
    within = F.least(spot + jitter * F.lit(1e-3), F.lit(math.nextafter(1.0, 0.0)))
    length = F.greatest(F.col(again), F.col("mix_epoch") + 1)
    out = out.withColumn("mix_block", F.col(block)).withColumn("mix_position", (F.col("mix_epoch") + within) / length)
    return out.select(*base.columns, *added)
