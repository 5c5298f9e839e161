"""Merkle manifest of a dataset, with a proof for each row.

Rows are leaves, three nodes make one of the next level, per source up to a
subroot and over the subroots, in the order of their sources, up to the root.

*Levels.* Nodes are gathered in blocks of 81 neighbours, and each block makes
its next four levels in arrays, so the tree takes a quarter as many shuffles as
it has levels, and no group is larger than a block.

*Proofs* are found by pointer jumping. Every node starts with a segment, the
digests left and right of it in its run, that takes it to its parent. A round
joins the nodes to their ancestors and appends the ancestor's segment: the
distance doubles, so a tree of height h takes log2(h) rounds. A node's ancestor
at a distance follows from its number, so no pointer is stored; only nodes that
can be an ancestor in a later round are kept. The nearer the root, the more rows
share an ancestor: a segment is first given to one row for each ``CHUNK`` of
neighbours, then handed to the rows on (ancestor, chunk), so no key of the large
join has more than ``CHUNK`` rows.

*Checks.* :func:`verified` folds a leaf with its segment up to a root, and so
tells whether the row is the one that the manifest was made of.

Cases: a null field is `-` in its leaf. A null source is a source, the first. In
a source leaves ascend by key, null first, rows with one key by their digest;
repeated rows are leaves of their own. A lone leaf is its source's subroot, a
lone subroot the root. An empty table has no leaves and no root: an empty
result. Columns other than the fields are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precinct.llm.scans import ranked
from precinct.llm.tables import dropped, written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 3
#: Levels that a block makes; its nodes.
BAND = 4
BLOCK = ARITY**BAND
#: Neighbours that get an ancestor's segment as one row.
CHUNK = ARITY**6
#: The tree over the subroots.
TOP = -1


def digest(text: Column) -> Column:
    """SHA-256 of a text's UTF-8, 32 bytes."""
    return F.unhex(F.sha2(text, 256))


def shown(value: Column) -> Column:
    """A digest as lowercase hex."""
    return F.lower(F.hex(value))


def field(value: Column) -> Column:
    """`-` for null, else the number of bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**columns: Column) -> Column:
    """Digest of a row's fields, in the order given."""
    return digest(F.concat(*[field(c) for c in columns.values()]))


def _height(n: Column) -> Column:
    """The least h with ARITY ** h >= n."""
    powers = F.array(*[F.lit(ARITY**k).cast("bigint") for k in range(39)])
    return F.size(F.filter(powers, lambda p: p < n))


def _next_level(nodes: Column) -> Column:
    run = lambda j: F.concat(*[F.coalesce(F.get(nodes, j * ARITY + k), F.lit(b"")) for k in range(ARITY)])
    last = F.floor((F.size(nodes) - 1) / ARITY).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda j: digest(shown(run(j))))


def _siblings(nodes: Column, first: Column, level: Column) -> Column:
    """Structs (level, i, left, right) of a level's nodes; ``first`` is the
    number of the first, at the start of a run."""

    def beside(i: Column, side: str) -> Column:
        run, place = i - i % ARITY, i % ARITY
        others = [
            F.when(place > k if side == "left" else place < k, F.coalesce(F.get(nodes, run + k), F.lit(b""))).otherwise(F.lit(b""))
            for k in range(ARITY)
        ]
        return F.concat(*others)

    return F.transform(
        nodes,
        lambda _, i: F.struct(
            level.alias("level"), (first + i).alias("i"), beside(i, "left").alias("left"), beside(i, "right").alias("right")
        ),
    )


STEPS = "array<struct<level:int,i:bigint,left:binary,right:binary>>"


def _tree(nodes: DataFrame, height: int) -> tuple[list[DataFrame], DataFrame]:
    """Of level 0 (tree, height, i, digest), and the height of the highest tree:
    the tables of blocks, and (tree, digest) of the trees' tops."""
    blocks, tops, level = [], nodes.where("height = 0").select("tree", "digest"), 0
    current = nodes.where("height > 0")
    while level < height:
        rows = current.groupBy("tree", "height", F.floor(F.col("i") / BLOCK).alias("block")).agg(
            F.transform(F.sort_array(F.collect_list(F.struct("i", "digest"))), lambda x: x["digest"]).alias("n0")
        )
        # A tree ends at its height: beyond it a block has no nodes.
        for k in range(BAND):
            rows = rows.withColumn(f"n{k + 1}", F.when(F.col("height") > level + k, _next_level(F.col(f"n{k}"))))
        block = written(rows.withColumn("base", F.lit(level)), "merkle-blocks")
        blocks.append(block)
        for k in range(1, BAND + 1):
            ended = block.where(F.col("height") == level + k)
            tops = tops.unionByName(ended.select("tree", F.get(f"n{k}", F.lit(0)).alias("digest")))
        level += BAND
        current = block.where(F.col("height") > level).select(
            "tree", "height", F.col("block").alias("i"), F.get(f"n{BAND}", F.lit(0)).alias("digest")
        )
    return blocks, tops


def _steps(block: DataFrame) -> DataFrame:
    """(tree, height, level, i, segment): the first segment of a block's nodes."""
    own = [
        F.when(
            F.col("height") > F.col("base") + k,
            _siblings(F.col(f"n{k}"), F.col("block") * ARITY ** (BAND - k), F.col("base") + k),
        )
        for k in range(BAND)
    ]
    each = F.concat(*[F.coalesce(b, F.array().cast(STEPS)) for b in own])
    return block.select("tree", "height", F.inline(each)).select(
        "tree", "height", "level", "i", F.array(F.struct("left", "right")).alias("segment")
    )


def _power(e: Column) -> Column:
    return F.element_at(F.array(*[F.lit(ARITY**k).cast("bigint") for k in range(39)]), (F.least(e, F.lit(38)) + 1).cast("int"))


def _ancestor(distance: int, top: int) -> list[Column]:
    """(at_tree, at_level, at_i) of a node's ancestor, at_tree null if the way
    to it ends at the root before."""
    beyond = F.col("level") + distance - F.when(F.col("tree") == TOP, F.lit(0)).otherwise(F.col("height"))
    lone = F.col("tree") == TOP
    inside = ~lone & (beyond < 0)
    number = F.when(lone | inside, F.col("i")).otherwise(F.col("tree"))
    steps = F.when(lone | inside, F.lit(distance)).otherwise(beyond)
    return [
        F.when(inside, F.col("tree")).when(beyond < top, F.lit(TOP).cast("bigint")).alias("at_tree"),
        F.when(inside, F.col("level") + distance).otherwise(beyond).alias("at_level"),
        F.floor(number / _power(steps)).cast("bigint").alias("at_i"),
    ]


AT = ["at_tree", "at_level", "at_i"]
SEGMENT = "array<struct<left:binary,right:binary>>"


def _doubled(rows: DataFrame, right: DataFrame, distance: int, top: int) -> DataFrame:
    """``rows`` with their ancestors' segments appended."""
    at = rows.select("*", *_ancestor(distance, top), F.floor(F.col("i") / CHUNK).alias("chunk"))
    going = at.where("at_tree is not null")
    # A row for each ancestor and chunk fetches the segment, for all its rows.
    own = [*AT, "home", "chunk"]
    going = going.withColumn("home", F.col("tree"))
    fetched = going.select(own).distinct().join(right, AT).select(*own, F.col("segment").alias("more"))
    after = going.join(fetched, own).withColumn("segment", F.concat("segment", "more"))
    return after.select(rows.columns).unionByName(at.where("at_tree is null").select(rows.columns))


def manifest(docs: DataFrame, altered: dict[str, Column] | None = None, fields=FIELDS) -> DataFrame:
    """Per row: ``key``, ``leaf``, ``subroot``, ``root`` and ``segment``, the
    digests (left, right) of the way to the root, all as bytes. ``altered``
    fields make a second leaf, ``other``, of a row that was changed after. The
    key is the first of ``fields``, the source the second."""
    columns = {f: docs[f] for f in fields}
    leaves = written(
        docs.select(
            docs[fields[0]].alias("key"),
            docs[fields[1]].alias("source"),
            leaf(**columns).alias("leaf"),
            leaf(**(columns | (altered or {}))).alias("other"),
        ),
        "merkle-leaves",
    )
    # Sources in order, with their heights.
    counts = written(leaves.groupBy("source").agg(F.count(F.lit(1)).alias("size")), "merkle-sources")
    trees = written(
        ranked(counts, [], ["source"], "merkle-order").select(
            F.col("source").alias("_source"), F.col("rank").alias("tree"), _height(F.col("size")).alias("height")
        ),
        "merkle-trees",
    )
    n_trees, highest = trees.agg(F.count(F.lit(1)), F.coalesce(F.max("height"), F.lit(0))).first()
    top = next(h for h in range(39) if ARITY**h >= n_trees)
    numbered = written(
        ranked(leaves, ["source"], ["key", "leaf"], "merkle-ranks")
        .withColumnRenamed("rank", "i")
        .join(trees, F.col("source").eqNullSafe(F.col("_source")))
        .select("tree", "height", F.lit(0).alias("level"), "i", "key", "leaf", "other"),
        "merkle-numbered",
    )
    blocks, tops = _tree(numbered.select("tree", "height", "i", F.col("leaf").alias("digest")), highest)
    subroots = written(tops.withColumnRenamed("digest", "subroot"), "merkle-subroots")
    level0 = subroots.select(
        F.lit(TOP).cast("bigint").alias("tree"),
        F.lit(top).alias("height"),
        F.col("tree").alias("i"),
        F.col("subroot").alias("digest"),
    )
    above, ends = _tree(level0, top)
    root = ends.select("digest").first()
    nodes = docs.sparkSession.createDataFrame([], "tree bigint, height int, level int, i bigint, segment " + SEGMENT)
    for block in [*blocks, *above]:
        nodes = nodes.unionByName(_steps(block))
    nodes = written(nodes, "merkle-nodes")
    # A leaf starts with its own step; a lone leaf is a subroot, with that one's.
    first = nodes.where("level = 0").select(
        F.when(F.col("tree") == TOP, F.col("i")).otherwise(F.col("tree")).alias("tree"),
        F.when(F.col("tree") == TOP, F.lit(None)).otherwise(F.col("i")).alias("at"),
        "segment",
    )
    at = F.when(F.col("height") > 0, F.col("i")).alias("at")
    rows = numbered.select("*", at).join(
        first.withColumnsRenamed({"tree": "_tree", "at": "_at"}),
        (F.col("tree") == F.col("_tree")) & F.col("at").eqNullSafe(F.col("_at")),
        "left",
    )
    rows = written(
        rows.select(*numbered.columns, F.coalesce("segment", F.array().cast(SEGMENT)).alias("segment")), "merkle-paths"
    )
    dropped(leaves, counts, numbered, *blocks, *above)
    distance = 1
    while distance < highest + top:
        is_top = F.col("tree") == TOP
        right = nodes.where(is_top | (F.col("level") >= distance)).select(
            F.col("tree").alias("at_tree"), F.col("level").alias("at_level"), F.col("i").alias("at_i"), "segment"
        )
        further = written(_doubled(rows, right, distance, top), "merkle-paths")
        # Nodes that a later round can meet.
        later = nodes.where(is_top | ((F.col("level") > 0) & (F.col("level") % (2 * distance) == 0)))
        onward = written(_doubled(later, right, distance, top), "merkle-nodes")
        dropped(rows, nodes)
        rows, nodes, distance = further, onward, 2 * distance
    return rows.join(subroots, "tree").select(
        "key",
        "leaf",
        "other",
        "subroot",
        F.lit(bytes(root[0]) if root else None).cast("binary").alias("root"),
        "segment",
    )


def proof(segment: Column) -> Column:
    """The siblings of a way to the root as hex, left to right, level by level."""
    return F.array_join(F.transform(segment, lambda s: F.concat(shown(s["left"]), shown(s["right"]))), "")


def folded(start: Column, segment: Column) -> Column:
    """The root, as hex, that a leaf and its siblings make."""
    up = lambda h, s: F.sha2(F.concat(shown(s["left"]), h, shown(s["right"])), 256)
    return F.aggregate(segment, shown(start), up)


def verified(rows: DataFrame) -> DataFrame:
    """Rows of :func:`manifest` with ``folded_root``, made of ``other``, and
    whether it is the root."""
    found = rows.withColumn("folded_root", folded(F.col("other"), F.col("segment")))
    return found.withColumn("verified", F.col("folded_root") == shown(F.col("root")))
