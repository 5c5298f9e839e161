"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sources share a number of words by weight; none gets more than ``EPOCHS`` times
its own words, what is beyond goes to the others by weight. Of its target a
source gives complete epochs, every document once for each, and what is left
from a weighted sample without replacement: each document draws an exponential
key divided by its quality weight, and documents are taken in the order of their
keys until the prefix sum of their words reaches the rest of the target. The
document at that place gives its first words only, so a source meets its target
to the word.

Only DataFrame functions are used. Draws are digests of seed, key and text: they
do not depend on partitions, so every run takes the same documents. Prefix sums
are made over ranges of (source, key), so a source of any size spreads over the
partitions, and only an offset for each partition is broadcast. The common
multiple of words and weight at which no source is above its bound is found by
one sorted prefix sum over the sources, not by rounds.

Cases: a null text has no words and is never taken; a source without words has
the target 0. Null is a source of its own, the last. Rows with one key draw by
their texts; repeated rows agree in their draw, and stand in any order, so each
multiple of rows is the same in every run. A document without a weight has
``UNKNOWN``. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precinct.llm.scans import ranked, running
from precinct.llm.tables import dropped, written

#: Weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
EPOCHS = 3
#: Sampling weights of documents: by their quality label, and without one.
QUALITY = {0: 1.0, 1: 4.0}
UNKNOWN = 2.0
SEED = "mix"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def drawn(seed: str, key: Column, text: Column) -> Column:
    """A number between 0 and 1, exclusive, for a key and a text."""
    told = F.concat(
        F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text.cast("string"), F.lit(""))
    )
    bits = F.conv(F.substring(F.sha2(told, 256), 1, 13), 16, 10).cast("bigint")
    return (bits.cast("double") + 0.5) / F.lit(float(1 << 52))


def _targets(sources: DataFrame, weights: tuple[int, ...], epochs: int) -> DataFrame:
    """(source, source_size, target): the total shared by weight, no source
    above ``epochs`` times its size."""
    common = 1
    for w in weights:
        common *= w
    of = F.element_at(F.array(*[F.lit(w).cast("bigint") for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    last = sources.withColumn("none", F.col("source").isNull())
    shares = (
        ranked(last, [], ["none", "source"], "mix-order")
        .withColumn("weight", of)
        .withColumn("most", F.col("source_size") * epochs)
        # The multiple of its weight at which a source is full, as an integer.
        .withColumn("full_at", F.col("most") * (F.lit(common).cast("bigint") / F.col("weight")).cast("bigint"))
        .select("source", "source_size", "weight", "most", "full_at")
    )
    shares = written(shares, "mix-shares")
    total, weight = shares.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    # Sources before the first that stays below its bound are full.
    both = running(shares, [], ["full_at", "source"], ["weight", "most"], "mix-sums")
    wide = "decimal(38,0)"
    left, rest = F.lit(total) - F.col("before_most"), F.lit(weight) - F.col("before_weight")
    open_ = both.where(left.cast(wide) * F.col("weight") <= F.col("most").cast(wide) * rest)
    first = open_.orderBy("full_at").select("full_at", left.alias("left"), rest.alias("rest")).first()
    full_at, left, rest = first or (1 << 62, 0, 1)
    share = (F.col("weight") * F.lit(left)).cast("double") / F.lit(float(rest))
    target = F.when(F.col("full_at") < full_at, F.col("most").cast("double")).otherwise(share)
    return shares.select("source", "source_size", target.alias("target"))


def mixed(
    docs: DataFrame,
    labels: DataFrame | None = None,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    epochs: int = EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """Per row: doc_id, size (words), source, source_size, target and taken,
    the words that the mix takes of it. ``labels``: (doc_id, quality)."""
    rows = written(
        docs.select(
            docs[key].alias("doc_id"),
            docs[source].cast("string").alias("source"),
            words(docs[text]).alias("size"),
            (-F.log(drawn(seed, docs[key], docs[text]))).alias("draw"),
        ),
        "mix-documents",
    )
    if labels is not None:
        known = labels.groupBy(F.col("doc_id").alias("_id")).agg(F.max("quality").alias("quality"))
        found = rows.where("doc_id is not null").join(known, F.col("doc_id") == F.col("_id"), "left").drop("_id")
        none = rows.where("doc_id is null").withColumn("quality", F.lit(None).cast("int"))
        weight = F.lit(UNKNOWN)
        for quality, heavy in QUALITY.items():
            weight = F.when(F.col("quality") == quality, heavy).otherwise(weight)
        weighed = found.unionByName(none).withColumn("draw", F.col("draw") / weight).drop("quality")
        weighed = written(weighed, "mix-weighed")
        dropped(rows)
        rows = weighed
    sources = written(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    targets = _targets(sources, weights, epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = targets.withColumn("whole", whole).withColumn(
        "budget", F.floor(F.col("target") - F.col("whole") * F.col("source_size") + 0.5)
    )
    plan = written(plan.withColumnRenamed("source", "_source"), "mix-plan")
    placed = running(rows, ["source"], ["draw", "doc_id", "size"], ["size"], "mix-ranks")
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("budget") - F.col("before_size")))
    return placed.join(plan, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("whole") * F.col("size") + part).cast("bigint").alias("taken"),
    )
