"""Benchmark decontamination through an FM-index of each training shard.

A shard is a batch of documents. Its words become numbers: those of the
benchmark's words, 0 for any other. No test phrase crosses a 0, so only runs of
benchmark words at least as long as the shortest phrase are indexed; the rest
of the text cannot match. Over these runs the shard builds a suffix array, its
Burrows-Wheeler transform and a wavelet tree for ranks. All test phrases are
searched backward at once, one word a step; occurrences are located by walking
to the nearest sampled suffix position. Occurrences become spans of words,
which are merged per document.

A phrase is ``window`` consecutive words of an item, or the whole item if it
has fewer. The benchmark goes to the tasks in blocks of bounded size
(``BLOCK_ITEMS`` items, ``MAX_BLOCK_BYTES`` of text); with more than one block
each passes over all documents and their spans are merged by row.

Cases: null and empty texts have no words, are never hit and not contaminated;
items without words have no phrases. Items with the same item_id count once;
those without item_id count as one item too, null, the last of a list.
Repeated rows are reported once per row, null ids too; an empty table or
benchmark gives a result without hits. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precinct.llm.arrow import Batches, arrow_column, arrow_schema, map_arrow, rows_of, values_of
from precinct.llm.tables import numbered, row_id, text_of, without, written

WINDOW = 13
BLOCK_ITEMS = 20_000
MAX_BLOCK_BYTES = 64 << 20
#: A shard: so many characters of text at most, unless one text is longer.
SHARD_CHARS = 16 << 20
#: Every such suffix position is sampled.
SAMPLE = 8
#: Bytes that are not part of a word become spaces, capitals small letters.
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
HITS = "n_words bigint, spans array<struct<start:int,stop:int>>, items array<bigint>"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(WORDS).split()


def phrases(items: list[tuple[int, str | None]], window: int) -> dict[tuple[bytes, ...], list[int]]:
    """Phrase -> the items that hold it."""
    found: dict[tuple[bytes, ...], set[int]] = {}
    for item_id, text in items:
        words = words_of(text)
        for at in range(max(1, len(words) - window + 1) if words else 0):
            found.setdefault(tuple(words[at : at + window]), set()).add(item_id)
    return {phrase: in_order(ids) for phrase, ids in found.items()}


def in_order(ids: set[int | None]) -> list[int | None]:
    """Items in order, null last."""
    return sorted(ids, key=lambda i: (i is None, i or 0))


class WaveletTree:
    """Ranks over an integer sequence: a level for each bit, highest first,
    zeros before ones."""

    def __init__(self, sequence: np.ndarray, bits: int):
        self.levels = []
        for bit in range(bits - 1, -1, -1):
            ones = (sequence >> bit) & 1
            before = np.concatenate([[0], np.cumsum(ones, dtype=np.int32)])
            self.levels.append((bit, before, len(sequence) - int(before[-1])))
            sequence = sequence[np.argsort(ones, kind="stable")]
        self.start = None

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each ``symbol`` occurs before place ``at``."""
        low, at = np.zeros_like(at), at.copy()
        for bit, before, zeros in self.levels:
            one = ((symbol >> bit) & 1).astype(bool)
            low, at = (np.where(one, zeros + before[x], x - before[x]) for x in (low, at))
        return at - low


class FmIndex:
    """Over a sequence of words (1 and up) with 0 between its runs."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        n = len(sequence)
        # Ends of runs are told apart by their place, so that ranks settle as
        # soon as the longest run is covered.
        ends = np.flatnonzero(sequence == 0)
        rank = sequence.astype(np.int64) + len(ends)
        rank[ends] = np.arange(len(ends))
        rank = np.unique(rank, return_inverse=True)[1]
        reach = 1
        while True:
            follow = np.full(n, -1, np.int64)
            follow[: n - reach] = rank[reach:]
            key = rank * (n + 1) + follow + 1
            order = np.argsort(key, kind="stable")
            new = np.empty(n, np.int64)
            new[order] = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
            rank, reach = new, 2 * reach
            if reach >= n or rank[order[-1]] == n - 1:
                break
        self.n, self.bwt = n, sequence[order - 1]
        self.counts = np.concatenate([[0], np.cumsum(np.bincount(sequence, minlength=symbols + 1))])
        self.tree = WaveletTree(self.bwt, max(1, int(symbols).bit_length()))
        # Starts of runs are sampled too, so no walk steps over an end, whose
        # order is not that of what follows it.
        self.sampled = (order % SAMPLE == 0) | (self.bwt == 0)
        self.place = np.cumsum(self.sampled) - 1
        self.samples = order[self.sampled]

    def search(self, words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of the suffix array of the phrases (rows of ``words``)."""
        low, high = np.zeros(len(words), np.int64), np.full(len(words), self.n, np.int64)
        for step in range(int(sizes.max(initial=0))):
            live = np.flatnonzero((sizes > step) & (low < high))
            if not len(live):
                break
            symbol = words[live, sizes[live] - 1 - step]
            low[live] = self.counts[symbol] + self.tree.rank(symbol, low[live])
            high[live] = self.counts[symbol] + self.tree.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, at: np.ndarray) -> np.ndarray:
        """Places in the sequence of suffix array entries: steps back through
        the text to the nearest sampled suffix."""
        at, out, steps = at.copy(), np.empty(len(at), np.int64), 0
        todo = np.arange(len(at))
        while len(todo):
            known = self.sampled[at[todo]]
            done = todo[known]
            out[done] = self.samples[self.place[at[done]]] + steps
            todo = todo[~known]
            symbol = self.bwt[at[todo]]
            at[todo] = self.counts[symbol] + self.tree.rank(symbol, at[todo])
            steps += 1
        return out


class Phrases:
    """The test phrases of a block of items, as numbers."""

    def __init__(self, items: list[tuple[int, str | None]], window: int):
        found = phrases(items, window)
        self.items = list(found.values())
        self.ids = {w: i for i, w in enumerate(sorted({w for p in found for w in p}), 1)}
        self.sizes = np.array([len(p) for p in found], np.int64)
        self.shortest = int(self.sizes.min(initial=window))
        self.words = np.zeros((len(found), window), np.int64)
        for row, phrase in zip(self.words, found, strict=True):
            row[: len(phrase)] = [self.ids[w] for w in phrase]

    def hits(self, texts: list[str | None]) -> list[tuple[int, list[tuple[int, int]], list[int]]]:
        """Words, merged spans of words and items of each text of a shard."""
        get, sizes, runs, places = self.ids.get, [], [], []
        for k, text in enumerate(texts):
            words = words_of(text)
            sizes.append(len(words))
            ids = np.array([get(w, 0) for w in words], np.int64)
            edges = np.flatnonzero(np.diff(np.concatenate([[0], ids > 0, [0]])))
            for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                if b - a >= self.shortest:
                    runs += [ids[a:b], np.zeros(1, np.int64)]
                    places.append((k, a, b - a))
        spans: list[list[tuple[int, int]]] = [[] for _ in texts]
        items: list[set[int]] = [set() for _ in texts]
        if runs and len(self.sizes):
            index = FmIndex(np.concatenate(runs), len(self.ids))
            low, high = index.search(self.words, self.sizes)
            phrase = np.repeat(np.arange(len(low)), high - low)
            first = np.repeat(high - np.cumsum(high - low), high - low)
            at = index.locate(first + np.arange(len(phrase)))
            starts = np.cumsum([0] + [size + 1 for _, _, size in places])
            run = np.searchsorted(starts, at, "right") - 1
            for p, r, begin in zip(phrase.tolist(), run.tolist(), (at - starts[run]).tolist(), strict=True):
                k, a, _ = places[r]
                spans[k].append((a + begin, a + begin + int(self.sizes[p])))
                items[k].update(self.items[p])
        return [(n, merged(s), in_order(i)) for n, s, i in zip(sizes, spans, items, strict=True)]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that touch or overlap as one."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def _blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[list[tuple[int, str | None]]]:
    """The benchmark's items in blocks, an item never cut."""
    block, size = [], 0
    rows = benchmark.select(F.col(item).cast("bigint").alias("item"), text_of(benchmark, text).alias("text"))
    for row in rows.distinct().orderBy("item", "text").toLocalIterator():
        block.append((row["item"], row["text"]))
        size += len(row["text"])
        if len(block) >= BLOCK_ITEMS or size >= MAX_BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def hits(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", window: int = WINDOW,
) -> DataFrame:
    """Per row: doc_id, n_words, spans (merged spans of words that occurrences
    cover) and items (those with an occurrence)."""
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    schema = f"uid bigint, doc_id {kind}, {HITS}"
    fields = arrow_schema(schema)
    rows = docs.select(
        row_id(docs).alias("uid"), F.col(key).alias("doc_id"), text_of(docs, text).alias("text")
    )

    def found(block) -> DataFrame:
        sent = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            search, out, shard, size = Phrases(sent.value, window), Batches(fields), [], 0

            def searched():
                texts = search.hits([t for _, _, t in shard])
                for (uid, doc_id, _), (n, spans, items) in zip(shard, texts, strict=True):
                    cells = [{"start": a, "stop": b} for a, b in spans]
                    yield from out.add((uid, doc_id, n, cells, items), 64 + 16 * len(spans) + 8 * len(items))

            for row in rows_of(batches):
                shard.append(row)
                size += len(row[2])
                if size >= SHARD_CHARS:
                    yield from searched()
                    shard, size = [], 0
            yield from searched()
            yield from out.flush()

        return map_arrow(rows, run, schema)

    blocks = _blocks(benchmark, item, item_text)
    first, second = next(blocks, []), next(blocks, None)
    if second is None:
        return found(first).drop("uid")
    # Each block's result is a table before the next block comes, so the
    # driver and the tasks hold one block at a time.
    passes = [written(found(b), "hits") for b in (first, second)] + [written(found(b), "hits") for b in blocks]
    together = passes[0]
    for more in passes[1:]:
        together = together.unionByName(more)
    lists = together.groupBy("uid", "doc_id", "n_words").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return lists.select("doc_id", "n_words", _merged(F.col("spans")).alias("spans"), "items")


def _merged(spans):
    """:func:`merged` of a sorted array column."""
    none = F.array().cast("array<struct<start:int,stop:int>>")

    def step(out, x):
        last = F.element_at(out, -1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["stop"], x["stop"]).alias("stop"))
        touch = (F.size(out) > 0) & (x["start"] <= F.try_element_at(out, F.lit(-1))["stop"])
        return F.when(touch, F.concat(F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0))), F.array(longer))).otherwise(
            F.concat(out, F.array(x))
        )

    return F.aggregate(spans, none, step)


def judged(found: DataFrame) -> DataFrame:
    """``found`` with ``n_hit`` words and ``contaminated``: hit in at least a
    twentieth of the words."""
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"])
    return found.withColumn("n_hit", hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    )


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the benchmark does not contaminate, with their
    columns. Where the benchmark is one block, a row is judged in the pass that
    keeps it; with more blocks, rows are judged block by block first."""
    blocks = _blocks(benchmark, item, item_text)
    first, more = next(blocks, []), next(blocks, None)
    if more is None:
        return docs.where(~_dirty(text_of(docs, text), first, WINDOW))
    rows, row = numbered(docs)
    found = judged(hits(rows, benchmark, row, text, item, item_text))
    dirty = written(found.where("contaminated").select(F.col("doc_id").alias(row)), "contaminated")
    return without(rows, dirty, row)


def _dirty(text: Column, items: list[tuple[int, str | None]], window: int) -> Column:
    """:func:`judged` of one block of items, as a column."""

    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        search = Phrases(items, window)
        for array in arrays:
            found: list[bool] = []
            shard, size = [], 0
            for texts in values_of(iter([array])):
                shard += texts
                size += sum(map(len, texts))
                if size >= SHARD_CHARS:
                    found += [_judge(*h) for h in search.hits(shard)]
                    shard, size = [], 0
            found += [_judge(*h) for h in search.hits(shard)]
            yield pa.array(found, pa.bool_())

    return arrow_column(run, "boolean", text)


def _judge(n: int, spans: list[tuple[int, int]], items: list) -> bool:
    hit = sum(stop - start for start, stop in spans)
    return hit > 0 and 20 * hit >= n
