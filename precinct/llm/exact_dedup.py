"""Exact deduplication by deterministic block naming.

Each normalised text is cut into blocks of a fixed number of characters. The
distinct blocks are sorted and numbered; a document is then a sequence of
integers. Adjacent pairs of integers are sorted and numbered in turn, which
halves the sequences, until every document is one integer. Two documents got
the same integer in the same round exactly when their texts are equal: names
are given to blocks and pairs themselves, so no hash can collide.

Only DataFrame functions are used. What keeps it cheap:

* Block text crosses the network once, after a map-side distinct, so a text
  that a third of all rows share is sent once per task.
* The sort order of blocks is (64-bit hash, text). Almost always one block has
  a hash, its name then follows from the hash, and rows meet their names on a
  long instead of the block. Where several blocks share a hash, the rows of
  these blocks meet them on the text itself.
* Numbers are given within hash buckets (``row_number`` over distinct values
  only), so there is no global sort in one task and no skewed window.

Cases: a null text is an empty one, and empty texts are equal to each other.
Rows with equal texts and the same ``doc_id`` (repeated rows) form one group
and exactly one of them is kept. A null ``doc_id`` is kept only when no row of
the group has one. An empty table gives an empty result. Other columns of the
input are neither read nor returned by :func:`groups`; :func:`dedup` returns
the input's columns unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from precinct.llm.tables import dropped, row_id, text_of, without, written
from precinct.llm.tables import numbered as numbered_rows

BLOCK_CHARS = 2048
NAME_BUCKETS = 4096


def normalised(text: Column) -> Column:
    """Each run of white space (space, tab to carriage return) as one space."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def blocks_of(text: Column, size: int) -> Column:
    """The text's blocks of ``size`` code points, in one pass; [''] if empty."""
    return F.when(text == "", F.array(F.lit(""))).otherwise(
        F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    )


def block_hash(block: Column) -> Column:
    return F.xxhash64(block)


def numbered(distinct: DataFrame, by: list[str], weight: Column, buckets: int) -> DataFrame:
    """``distinct`` with ``name``: integers in sort order within hash buckets,
    ``weight`` of them reserved for each row."""
    bucket = F.pmod(F.xxhash64(*by), F.lit(buckets))
    before = Window.partitionBy("_bucket").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    return (
        distinct.withColumn("_bucket", bucket)
        .withColumn("name", F.coalesce(F.sum(weight).over(before), F.lit(0)) * buckets + F.col("_bucket"))
        .drop("_bucket")
    )


def _first_names(
    rows: DataFrame, docs: DataFrame, texts: Column, size: int, hashed: Callable[[Column], Column], buckets: int
) -> DataFrame:
    """(uid, doc_id, n, pos, name) of every block."""
    pieces = docs.select(F.explode(blocks_of(texts, size)).alias("block")).select(
        hashed(F.col("block")).alias("h"), "block"
    )
    classes = written(
        numbered(pieces.distinct().groupBy("h").agg(F.count(F.lit(1)).alias("size")), ["h"], F.col("size"), buckets),
        "block-names",
    )
    seen = rows.select("uid", "doc_id", F.size("hs").alias("n"), F.posexplode("hs").alias("pos", "h"))
    shared = classes.where("size > 1")
    if shared.isEmpty():
        return seen.join(classes, "h").select("uid", "doc_id", "n", "pos", "name")
    alone = seen.join(classes.where("size = 1"), "h").select("uid", "doc_id", "n", "pos", "name")
    # Hashes that several blocks share: number their texts, and meet on the text.
    in_class = Window.partitionBy("h").orderBy("block")
    exact = (
        pieces.distinct()
        .join(shared, "h")
        .select("h", "block", (F.col("name") + (F.row_number().over(in_class) - 1) * buckets).alias("name"))
    )
    again = docs.select(
        "uid", "doc_id", F.posexplode(blocks_of(texts, size)).alias("pos", "block")
    ).withColumn("h", hashed(F.col("block")))
    met = again.join(exact, ["h", "block"]).join(rows.select("uid", F.size("hs").alias("n")), "uid")
    return alone.unionByName(met.select("uid", "doc_id", "n", "pos", "name"))


def _halved(named: DataFrame, buckets: int) -> DataFrame:
    """Sequences of names to sequences of half the length: names of pairs."""
    even = F.col("pos") % 2 == 0
    pairs = named.groupBy("uid", "doc_id", "n", F.floor(F.col("pos") / 2).cast("int").alias("pos")).agg(
        F.max(F.when(even, F.col("name"))).alias("a"),
        F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("b"),
    )
    names = numbered(pairs.select("a", "b").distinct(), ["a", "b"], F.lit(1), buckets)
    return pairs.join(names, ["a", "b"]).select(
        "uid", "doc_id", F.ceil(F.col("n") / 2).cast("int").alias("n"), "pos", "name"
    )


def groups(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    block_chars: int = BLOCK_CHARS,
    hashed: Callable[[Column], Column] = block_hash,
    buckets: int = NAME_BUCKETS,
) -> DataFrame:
    """Per row: ``uid`` (its number in ``docs``), ``doc_id``, ``keep_id``,
    ``group_size``, ``kept`` and ``text_sha256`` of the normalised text."""
    docs = docs.select(
        row_id(docs).alias("uid"),
        F.col(key).alias("doc_id"),
        normalised(text_of(docs, text)).alias("text"),
    )
    texts = F.col("text")
    rows = written(
        docs.select(
            "uid",
            "doc_id",
            F.sha2(texts, 256).alias("text_sha256"),
            F.transform(blocks_of(texts, block_chars), hashed).alias("hs"),
        ),
        "document-blocks",
    )
    named = written(_first_names(rows, docs, texts, block_chars, hashed, buckets), "names")
    longest = rows.agg(F.max(F.size("hs"))).first()[0] or 0
    identities, level = [], 0
    while True:
        identities.append(
            named.where("n = 1").select("uid", "doc_id", F.lit(level).alias("level"), "name")
        )
        if longest <= 1:
            break
        # Only documents that are not one integer yet go on.
        named = written(_halved(named.where("n > 1"), buckets), "names")
        longest, level = (longest + 1) // 2, level + 1
    identity = identities[0]
    for more in identities[1:]:
        identity = identity.unionByName(more)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")
    found = identity.groupBy("level", "name").agg(
        F.min(order).alias("first"), F.count(F.lit(1)).alias("group_size")
    )
    return (
        identity.join(found, ["level", "name"])
        .select(
            "uid",
            F.col("first.doc_id").alias("keep_id"),
            "group_size",
            (F.col("uid") == F.col("first.uid")).alias("kept"),
        )
        .join(rows.select("uid", "doc_id", "text_sha256"), "uid")
        .select("uid", "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    )


def dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that stay, with its columns. ``docs`` must give its
    rows in the same order when read again, as a table does."""
    rows, row = numbered_rows(docs)
    lost = groups(docs, text, key, **options).where("not kept").select(F.col("uid").alias(row))
    return without(rows, written(lost, "lost"), row)


__all__ = ["BLOCK_CHARS", "NAME_BUCKETS", "block_hash", "blocks_of", "dedup", "dropped", "groups", "normalised"]
