"""Prefix trie of conversations, with totals of each node's subtree.

A node is a distinct sequence of first turns. Its key is a digest made in bands
of ``BAND`` turns: within a band, of the key that the band starts from and the
turns since; at a band's end, the key of as many whole bands one level up, where
a band counts as a turn. So a key needs one pass a level, and levels grow with
the logarithm of the longest conversation.

Totals are rolled up in the same bands (depths 1 to ``BAND``, and so on):

1. what the nodes of a band add is summed at the band's root,
2. the band roots are the nodes of a trie ``BAND`` times lower, whose totals are
   found in the same way,
3. the completed totals of band roots go to their parents, the last nodes of the
   band above, and every node is exploded to its ancestors within the band only.

No node is exploded to more than ``BAND`` rows, and rounds grow with the logarithm
of the depth. Rows of one conversation are spread by (conversation, band), those
of a common first turn meet in partial sums.

Cases: turns are ordered by ``turn``, null first, equal ones by the digest of
role and text, so in the same order in every run; null role or text is empty. Rows without conv_id belong to no conversation and
are left out. Repeated rows are turns of their own. An empty table has no trie,
not even a root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precinct.llm.arrow import Batches, arrow_schema, map_arrow, rows_of
from precinct.llm.scans import ranked
from precinct.llm.tables import dropped, text_of, written

BAND = 8
#: Turns of a conversation that meet its facts as one row of a join.
CHUNK = 1024
#: Characters of a piece of a list of ids.
PIECE = 1 << 16
#: The key of the textless root.
ROOT = b""
SUMS = ("n_leaves", "saved_tokens")


def digest(*parts: Column) -> Column:
    """128 bits of SHA-256."""
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, 16)


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, rank, t, chars): each conversation's turns in order, as a
    digest of role and text and the text's length."""
    role, text = text_of(conversations, "role"), text_of(conversations, "text")
    turns = written(
        conversations.where(conversations["conv_id"].isNotNull()).select(
            conversations["conv_id"].cast("bigint").alias("conv_id"),
            conversations["turn"].alias("turn"),
            digest(F.octet_length(role).cast("string"), F.lit(":"), role, text).alias("t"),
            F.length(text).cast("bigint").alias("chars"),
        ),
        "trie-turns",
    )
    found = written(ranked(turns, ["conv_id"], ["turn", "t"], "trie-order").drop("turn"), "trie-numbered")
    dropped(turns)
    return found


def spliced(turns: DataFrame, donor: Column, first: Column, most: int) -> DataFrame:
    """(conv_id, p, t, chars) of every conversation rebuilt: the first turns of
    another, then its own after as many. ``donor`` and ``first`` (at most
    ``most``) are columns of conv_id; many conversations may share a donor, each
    then gets rows of at most ``most`` of its turns."""
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("size"))
    convs = sizes.select("conv_id", "size", donor.alias("donor"), first.cast("bigint").alias("first"))
    given = sizes.select(F.col("conv_id").alias("donor"), F.col("size").alias("given"))
    convs = written(
        convs.join(given, "donor", "left")
        .withColumn("shift", F.least("first", F.coalesce("given", F.lit(0))) - F.col("first"))
        .drop("given"),
        "trie-conversations",
    )
    last = F.floor((F.col("size") - 1) / CHUNK)
    chunks = convs.select("conv_id", "first", "shift", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("chunk"))
    own = (
        turns.withColumn("chunk", F.floor(F.col("rank") / CHUNK))
        .join(chunks, ["conv_id", "chunk"])
        .where("rank >= first")
        .select("conv_id", (F.col("rank") + F.col("shift")).alias("p"), "t", "chars")
    )
    heads = turns.where(F.col("rank") < most).withColumnRenamed("conv_id", "donor")
    taken = convs.select("conv_id", "donor", "first").join(heads, "donor").where("rank < first")
    return own.unionByName(taken.select("conv_id", F.col("rank").alias("p"), "t", "chars"))


def _banded(elements: DataFrame, band: int) -> DataFrame:
    """Of (conv_id, p, ...): rows (conv_id, k, items) of at most ``band``."""
    rest = [c for c in elements.columns if c not in ("conv_id", "p")]
    items = F.sort_array(F.collect_list(F.struct("p", *rest)))
    return elements.groupBy("conv_id", F.floor(F.col("p") / band).alias("k")).agg(items.alias("items"))


def _keyed(bands: DataFrame, longest: int, band: int, level: int = 0) -> DataFrame:
    """``bands`` with ``before``, the key that the band starts from, and
    ``keys`` of its items."""
    joined = lambda items: F.aggregate(items, F.lit(b""), lambda a, x: F.concat(a, x["t"]))
    mark = F.lit(f"{level}:".encode())
    if longest >= band:  # there are whole bands: they are the items one level up
        whole = bands.where(F.size("items") == band)
        above = written(
            _banded(
                whole.select("conv_id", F.col("k").alias("p"), digest(F.lit(f"{level}=".encode()), joined(F.col("items"))).alias("t")),
                band,
            ),
            "trie-bands",
        )
        upper = _keyed(above, longest // band, band, level + 1)
        upper = written(
            upper.select("conv_id", "k", F.posexplode("keys").alias("i", "key")).select(
                "conv_id", (F.col("k") * band + F.col("i") + 1).alias("k"), "key"
            ),
            "trie-upper",
        )
        bands = bands.join(upper.withColumnRenamed("key", "before"), ["conv_id", "k"], "left").join(
            upper.select("conv_id", (F.col("k") - 1).alias("k"), F.col("key").alias("after")), ["conv_id", "k"], "left"
        )
    else:
        bands = bands.withColumn("before", F.lit(None).cast("binary")).withColumn("after", F.lit(None).cast("binary"))
    bands = bands.withColumn("before", F.coalesce("before", F.lit(ROOT)))
    within = lambda _, i: F.coalesce(
        F.when(i == band - 1, F.col("after")),
        digest(mark, F.col("before"), joined(F.slice("items", F.lit(1), i + 1))),
    )
    return bands.withColumn("keys", F.transform("items", within)).drop("after")


def _listed(paths: DataFrame, *more: Column) -> DataFrame:
    """Of bands (before, keys): a row (key, parent, up) for each item, with its
    ancestors within the band, itself last."""
    each = paths.select("keys", "before", *more, F.posexplode("keys").alias("i", "key"))
    return each.withColumn(
        "parent", F.when(F.col("i") == 0, F.col("before")).otherwise(F.get("keys", F.col("i") - 1))
    ).withColumn("up", F.slice("keys", F.lit(1), F.col("i") + 1))


def _totals(nodes: DataFrame, paths: DataFrame, longest: int, band: int) -> DataFrame:
    """(key, sums) over each node's subtree. ``nodes``: (key, parent, up, sums)
    of the trie; ``paths``: its bands (conv_id, k, before, keys)."""
    add = [F.sum(c).alias(c) for c in SUMS]
    if longest > band:
        roots = nodes.groupBy(F.get("up", F.lit(0)).alias("key")).agg(*add)
        # Band roots are the items of the trie above; each one's parent there is
        # the root of the band before.
        own = paths.select("conv_id", "k", F.get("keys", F.lit(0)).alias("key"))
        prior = own.select("conv_id", (F.col("k") + 1).alias("k"), F.col("key").alias("prior"))
        elements = own.join(prior, ["conv_id", "k"], "left").select("conv_id", F.col("k").alias("p"), "key", "prior")
        higher = written(
            _banded(elements, band).select(
                "conv_id",
                "k",
                F.coalesce(F.get("items", F.lit(0))["prior"], F.lit(ROOT)).alias("before"),
                F.transform("items", lambda x: x["key"]).alias("keys"),
            ),
            "trie-paths",
        )
        links = _listed(higher).groupBy("key").agg(F.first("parent").alias("parent"), F.first("up").alias("up"))
        above = written(links.join(roots, "key"), "trie-roots")
        done = _totals(above, higher, -(-longest // band), band)
        below = (
            nodes.where((F.size("up") == 1) & (F.col("parent") != F.lit(ROOT)))
            .select("key", "parent")
            .join(done, "key")
            .groupBy(F.col("parent").alias("key"))
            .agg(*[F.sum(c).alias(f"_{c}") for c in SUMS])
        )
        nodes = nodes.join(below, "key", "left").select(
            "key", "up", *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in SUMS]
        )
    return written(nodes.select(F.explode("up").alias("key"), *SUMS).groupBy("key").agg(*add), "trie-totals")


def _list_digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256): digest of each key's conv_ids, in order and joined by
    commas. Ids are dealt by ranges, so lists are made of pieces in parallel; a
    digest is sequential, so a list's pieces stream through one task."""
    pieces_schema, digest_schema = "key binary, first bigint, ids string", "key binary, ends_sha256 string"
    pieces_fields, digest_fields = arrow_schema(pieces_schema), arrow_schema(digest_schema)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, key, ids, size = Batches(pieces_fields), None, [], 0
        for k, conv_id in rows_of(batches):
            if k != key or size >= PIECE:
                if ids:
                    yield from out.add((key, int(ids[0]), ",".join(ids)), size)
                key, ids, size = k, [], 0
            ids.append(str(conv_id))
            size += len(ids[-1]) + 1
        if ids:
            yield from out.add((key, int(ids[0]), ",".join(ids)), size)
        yield from out.flush()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, key, state = Batches(digest_fields), None, None
        for k, _, ids in rows_of(batches, 64):
            if k != key:
                if state:
                    yield from out.add((key, state.hexdigest()))
                key, state = k, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if state:
            yield from out.add((key, state.hexdigest()))
        yield from out.flush()

    dealt = ends.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    made = map_arrow(dealt, pieces, pieces_schema)
    return map_arrow(made.repartition("key").sortWithinPartitions("key", "first"), digests, digest_schema)


def nodes(elements: DataFrame, members: DataFrame, band: int = BAND) -> DataFrame:
    """The trie of conversations given as turns (conv_id, p, t, chars), p from
    0; ``members`` has the conv_id of each, also of those without turns."""
    bands = written(_banded(elements, band), "trie-bands")
    count, smallest, longest = members.join(
        bands.groupBy("conv_id").agg(F.max(F.col("k") * band + F.size("items")).alias("n")), "conv_id", "left"
    ).agg(F.count(F.lit(1)), F.min("conv_id"), F.coalesce(F.max("n"), F.lit(0))).first()
    paths = written(
        _keyed(bands, longest, band).select(
            "conv_id", "k", "before", "keys", F.transform("items", lambda x: x["chars"]).alias("chars")
        ),
        "trie-paths",
    )
    dropped(bands)
    each = _listed(paths, F.col("conv_id"), F.col("k"), F.col("chars").alias("lengths"))
    found = written(
        each.withColumn("chars", F.get("lengths", F.col("i")))
        .groupBy("key")
        .agg(
            F.min("conv_id").alias("conv_id"),
            F.count(F.lit(1)).alias("n_convs"),
            F.first((F.col("k") * band + F.col("i") + 1)).alias("depth"),
            F.first("chars").alias("chars"),
            F.first("parent").alias("parent"),
            F.first("up").alias("up"),
        ),
        "trie-nodes",
    )
    children = written(found.groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children")), "trie-children")
    valued = written(
        found.join(children, "key", "left").select(
            "key",
            "parent",
            "up",
            F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("bigint").alias("n_leaves"),
            ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
        ),
        "trie-values",
    )
    totals = _totals(valued, paths, longest, band)
    last = paths.groupBy("conv_id").agg(F.max(F.struct("k", F.element_at("keys", -1).alias("key")))["key"].alias("key"))
    ends = written(
        members.join(last, "conv_id", "left").select(F.coalesce("key", F.lit(ROOT)).alias("key"), "conv_id"), "trie-ends"
    )
    # The root: all conversations are its members.
    tops = found.where(F.col("parent") == F.lit(ROOT)).select("key").join(totals, "key")
    leaves, saved, n_children = tops.agg(*[F.sum(c) for c in SUMS], F.count(F.lit(1))).first()
    spark = elements.sparkSession
    top = [(ROOT, smallest, 0, None, count, n_children, leaves or 1, saved or 0)] if count else []
    names = "key binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"
    root = spark.createDataFrame(top, names)
    parents = found.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    below = (
        found.join(parents, "parent", "left")
        .join(children, "key", "left")
        .join(totals, "key")
        .select(
            "key",
            "conv_id",
            "depth",
            # A node of depth 1 has the root as its parent.
            F.coalesce("parent_conv_id", F.lit(smallest).cast("bigint")).alias("parent_conv_id"),
            "n_convs",
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
            *SUMS,
        )
    )
    nothing = hashlib.sha256(b"").hexdigest()
    return (
        root.unionByName(below)
        .join(_list_digests(ends), "key", "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(nothing)))
    )
