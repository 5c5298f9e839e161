"""Removal of byte strings that occur more than once (suffix-array dedup).

Every byte covered by a string of ``size`` bytes that also starts anywhere
else, in the same document or another, is removed.

Inserting the last symbol of every document, then the one before it, and so on
updates the order of all suffixes and their common prefixes column by column;
as one sequential construction over whole documents it would take as many
rounds as the longest document has bytes. So the collection is cut into
contexts that are inserted together:

1. *Anchors.* Of the hashes of all ``GRAM``-byte strings within ``size`` bytes
   the smallest, leftmost, is the anchor. Equal strings have their anchor at
   the same place, so equal strings meet in the group of an anchor's hash.
   Starts that share an anchor are one row; rows whose hash occurs once drop
   out.
2. *Contexts.* A row's bytes from its first start to the end of its last string
   are laid out with the anchors of its group in one column. Equal contexts are
   one row with several places; a task sends each once per batch.
3. *Columns.* From the last column to the first, one symbol of each context is
   inserted: a stable sort by symbol of the previous order gives the order of
   the suffixes that begin at this column (the column of the Burrows-Wheeler
   transform is what is inserted next), and the common prefix with the
   neighbour is one more than the least of those it skips. A start whose common
   prefix with a neighbour reaches ``size`` is repeated. Many groups go through
   the columns together, as arrays of bounded size.
4. *Hot anchors.* Where an anchor has more than ``HOT`` places, its strings
   meet by the BLAKE2 digest (256 bits) of their bytes instead, equal ones of a
   batch as one row, so no group has to be in one task.

The join that tells rows of repeated anchors is between two tables, so that
Spark can split the rows of an anchor that holds many.

Cases: null and empty texts are kept as they are. Repeated rows repeat all
their strings. Null ids stay, an empty table gives an empty result, other
columns are not read. Offsets are bytes; what remains need not be valid UTF-8.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precinct.llm.arrow import Batches, arrow_schema, map_arrow, rows_of
from precinct.llm.tables import dropped, row_id, text_of, written

SIZE, GRAM = 400, 48
#: Places of an anchor from which its starts are counted by hash.
HOT = 32_768
#: Contexts that go through the columns together.
TOGETHER = 2048
#: Starts of a document that are looked at together; places fit 20 bits.
STEP = 1 << 19
#: Bytes of contexts, and starts of hot anchors, that a task collapses.
COLLAPSE_BYTES, COLLAPSE_STARTS = 8 << 20, 1 << 18

ANCHORS = "uid bigint, lo int, hi int, at int, h bigint"
PLACES = "h bigint, place int, context binary, uids array<bigint>, los array<int>"
FOUND = "uid bigint, starts array<struct<lo:int,hi:int>>"
#: Starts that a task gathers by document before it gives them out.
GATHER = 1 << 18


class Rolling:
    """Hashes of all strings of a length, from sums of byte values times
    powers of an odd base (mod 2**64)."""

    def __init__(self, base: int, seed: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.values = np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.inverse, k, 1 << 64))])

    def hashes(self, data: np.ndarray, length: int) -> np.ndarray:
        self._powers(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.down[: len(data)], out=sums[1:])
        out = sums[length:] - sums[:-length]
        out *= self.up[: len(out)]
        out ^= out >> np.uint64(31)
        out *= np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(29)
        return out


# An odd base, and the seed of the byte values.
BASE = (0x5851F42D4C957F2D, 1)


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    cells = padded.reshape(-1, width)
    after = np.minimum.accumulate(cells[:, ::-1], axis=1)[:, ::-1].ravel()
    before = np.minimum.accumulate(cells, axis=1).ravel()
    return np.minimum(after[: n - width + 1], before[width - 1 : n])


def anchors(data: np.ndarray, rolling: Rolling, size: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(lo, hi, at, h) arrays: the starts lo..hi have their anchor at ``at``."""
    places = np.uint64((1 << 20) - 1)
    for begin in range(0, len(data) - size + 1, STEP):
        part = data[begin : begin + STEP + size - 1]
        h = rolling.hashes(part, gram)
        keys = (h & ~places) | np.arange(len(h), dtype=np.uint64)
        at = (smallest(keys, size - gram + 1) & places).astype(np.int64)
        lo = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
        hi = np.concatenate([lo[1:] - 1, [len(at) - 1]])
        yield lo + begin, hi + begin, at[lo] + begin, h[at[lo]].view(np.int64)


def _anchors(docs: DataFrame, size: int, gram: int) -> DataFrame:
    fields = arrow_schema(ANCHORS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling, held, count = Rolling(*BASE), [], 0

        def flush():
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.astype(f.type.to_pandas_dtype()), f.type) for c, f in zip(columns, fields, strict=True)], schema=fields
            )

        for uid, text in rows_of(batches, 256):
            for found in anchors(np.frombuffer(text, np.uint8), rolling, size, gram):
                held.append((np.full(len(found[0]), uid), *found))
                count += len(found[0])
            if count >= 1 << 17:
                yield from flush()
                held, count = [], 0
        if held:
            yield from flush()

    return map_arrow(docs.select("uid", "text"), run, ANCHORS)


def _contexts(rows: DataFrame, size: int) -> DataFrame:
    """From (text, own: the document's anchors that others have too) the
    contexts of anchors (place: the anchor in it) and, for hot anchors, the
    digests of their strings (no place), with their places."""
    fields = arrow_schema(PLACES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Batches(fields)
        contexts: dict[tuple, tuple[list, list]] = {}
        strings: dict[bytes, tuple[list, list]] = {}
        held = starts = 0

        def flush_contexts():
            for (h, place, context), (uids, los) in contexts.items():
                yield from out.add((h, place, context, uids, los), len(context) + 12 * len(uids))

        def flush_strings():
            for digest, (uids, los) in strings.items():
                h = int.from_bytes(digest[:8], "little", signed=True)
                yield from out.add((h, None, digest, uids, los), 48 + 12 * len(uids))

        for uid, text, own in rows_of(batches, 64):
            whole = memoryview(text)
            for row in own:
                lo, hi, at = row["lo"], row["hi"], row["at"]
                if row["hot"]:
                    for start in range(lo, hi + 1):
                        digest = hashlib.blake2b(whole[start : start + size], digest_size=32).digest()
                        uids, los = strings.setdefault(digest, ([], []))
                        uids.append(uid)
                        los.append(start)
                    starts += hi + 1 - lo
                else:
                    key = (row["h"], at - lo, text[lo : hi + size])
                    uids, los = contexts.setdefault(key, ([], []))
                    if not uids:
                        held += len(key[2])
                    uids.append(uid)
                    los.append(lo)
            if held >= COLLAPSE_BYTES:
                yield from flush_contexts()
                contexts, held = {}, 0
            if starts >= COLLAPSE_STARTS:
                yield from flush_strings()
                strings, starts = {}, 0
        yield from flush_contexts()
        yield from flush_strings()
        yield from out.flush()

    return map_arrow(rows, run, PLACES)


def repeated(groups: np.ndarray, contexts: list[bytes], places: np.ndarray, size: int, gram: int) -> list[np.ndarray]:
    """For each context, which of its starts have a string that another context
    of its group has at the same place. ``groups`` ascend."""
    m, reach = len(contexts), size - gram
    lengths = np.array([len(c) for c in contexts])
    begin = reach - places  # the column of a context's first byte
    cells = np.zeros((m, reach + size), np.uint16)
    for k, context in enumerate(contexts):
        cells[k, begin[k] : begin[k] + lengths[k]] = np.frombuffer(context, np.uint8)
        cells[k, begin[k] : begin[k] + lengths[k]] += 1
    columns = np.ascontiguousarray(cells.T)
    found = np.zeros((reach + 1, m), bool)
    order, common = np.arange(m), np.zeros(m + 1, np.int32)
    base = groups.astype(np.int64) * 512
    for c in range(reach + size - 1, -1, -1):
        # Insert the symbols of column c in front of the suffixes behind it.
        symbol = columns[c][order]
        key = base[order] + symbol
        moved = np.argsort(key, kind="stable")
        order, key = order[moved], key[moved]
        same = np.flatnonzero((key[1:] == key[:-1]) & (symbol[moved[1:]] > 0)) + 1
        new = np.zeros(m + 1, np.int32)
        if len(same):
            low, high = moved[same - 1] + 1, moved[same]
            least = common[high]
            far = np.flatnonzero(low < high)
            if len(far):
                spans = np.stack([low[far], high[far] + 1], 1).ravel()
                least[far] = np.minimum.reduceat(common, spans)[::2]
            new[same] = least + 1
        common = new
        if c <= reach:
            found[c, order] = np.maximum(common[:-1], common[1:]) >= size
    return [found[b : b + n - size + 1, k] for k, (b, n) in enumerate(zip(begin.tolist(), lengths.tolist(), strict=True))]


def runs(mask: np.ndarray) -> list[tuple[int, int]]:
    """First and last place of each run of true."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist(), strict=True))


def _starts(places: DataFrame, length: int, gram: int) -> DataFrame:
    """(uid, starts): starts of strings that occur more than once, those that a
    task finds for a document together."""
    fields = arrow_schema(FOUND)
    ordered = places.repartition("h").sortWithinPartitions("h", "place", "context")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, found, size = Batches(fields), {}, 0

        def gathered():
            for uid, starts in found.items():
                yield from out.add((uid, [{"lo": a, "hi": b} for a, b in starts]), 16 * len(starts))
            found.clear()

        held: list[list] = []  # [h, place, context, uids, los], equal contexts as one

        def settled(rows: list[list]) -> int:
            count = 0
            groups = np.cumsum([0] + [a[0] != b[0] for a, b in zip(rows, rows[1:], strict=False)])
            masks = repeated(groups, [r[2] for r in rows], np.array([r[1] for r in rows]), length, gram)
            for (_, _, _, uids, los), mask in zip(rows, masks, strict=True):
                if len(uids) > 1:
                    mask[:] = True
                for a, b in runs(mask):
                    count += len(uids)
                    for uid, lo in zip(uids, los, strict=True):
                        found.setdefault(uid, []).append((lo + a, lo + b))
            return count

        last = None  # of a hot anchor's strings: digest, and places not yet given out
        for h, place, context, uids, los in rows_of(batches, 256):
            if place is None:
                if last is not None and last[0] == context:
                    uids, los = last[1] + uids, last[2] + los
                    again = True
                else:
                    again = len(uids) > 1
                if again:
                    size += len(uids)
                    for uid, lo in zip(uids, los, strict=True):
                        found.setdefault(uid, []).append((lo, lo))
                last = (context, [], []) if again else (context, uids, los)
            elif held and held[-1][:3] == [h, place, context]:
                held[-1][3] += uids
                held[-1][4] += los
            else:
                if len(held) >= TOGETHER and held[-1][0] != h:
                    size += settled(held)
                    held = []
                held.append([h, place, context, uids, los])
            if size >= GATHER:
                yield from gathered()
                size = 0
        if held:
            settled(held)
        yield from gathered()
        yield from out.flush()

    return map_arrow(ordered, run, FOUND)


def removed(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """Per row: doc_id, n_bytes, spans (start, stop: maximal removed runs) and
    kept, the bytes that remain."""
    source = docs.select(
        row_id(docs).alias("uid"), F.col(key).alias("doc_id"), text_of(docs, text).cast("binary").alias("text")
    )
    rows = source.select("uid", "text").where(F.length("text") >= size)
    found = written(_anchors(rows, size, gram), "anchors")
    counts = written(found.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "anchor-counts")
    own = (
        found.join(counts, "h")
        .groupBy("uid")
        .agg(F.collect_list(F.struct("lo", "hi", "at", "h", (F.col("n") > hot).alias("hot"))).alias("own"))
    )
    contexts = _contexts(rows.join(own, "uid").select("uid", "text", "own"), size)
    starts = written(_starts(contexts, size, gram), "repeated-starts")
    dropped(found, counts)
    spans = starts.groupBy("uid").agg(F.flatten(F.collect_list("starts")).alias("starts"))
    schema = f"doc_id {docs.schema[key].dataType.simpleString()}, n_bytes bigint, spans array<struct<start:int,stop:int>>, kept binary"
    fields = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Batches(fields)
        for doc_id, data, own in rows_of(batches, 64):
            cut, kept, at = [], [], 0
            for lo, hi in sorted((s["lo"], s["hi"] + size) for s in own or ()):
                if cut and lo <= cut[-1][1]:
                    cut[-1][1] = max(hi, cut[-1][1])
                else:
                    cut.append([lo, hi])
            for lo, hi in cut:
                kept.append(data[at:lo])
                at = hi
            kept.append(data[at:])
            left = b"".join(kept)
            yield from out.add((doc_id, len(data), [{"start": a, "stop": b} for a, b in cut], left), len(left) + 16 * len(cut))
        yield from out.flush()

    return map_arrow(source.join(spans, "uid", "left").select("doc_id", "text", "starts"), run, schema)
