"""Byte-level BPE encoding and decoding with forced boundaries.

A merge never reaches across a byte pair that occurs inside no vocabulary
token: the merged token would contain the pair. Such pairs are certain cuts.
Each piece that the pre-tokenizer's pattern gives is cut there, the fragments
are merged independently (and remembered), and their ids are concatenated.

The tokenizer is a JSON file of the ``tokenizers`` format with a ``ByteLevel``
pre-tokenizer; its path is a parameter, its content (bounded by
``MAX_MODEL_BYTES``) is broadcast. Added tokens are found in the text first,
as that library does; special tokens are not added. Merging uses a heap and
linked neighbours, so a piece of n bytes takes n log n steps.

Cases: a null text is an empty one (no ids). Repeated rows and null ids stay
as they are, an empty table gives an empty result, other columns are not read.
"""

from __future__ import annotations

import functools
import itertools
import json
import re
import struct
import sys
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precinct.llm.arrow import Batches, arrow_schema, map_arrow, rows_of, worker_wide
from precinct.llm.tables import text_of

MAX_MODEL_BYTES = 64 << 20
#: Remembered chunks per Python worker, in two generations: when the younger is
#: full it becomes the older one, and what is met again goes on. Remembered pieces.
MAX_CHUNKS, MAX_PIECES = 110_000, 30_000
#: Whether this machine's integers start with the highest byte.
BIG = sys.byteorder == "big"
#: Fragments of up to so many bytes are merged by scanning their pairs.
SHORT = 48
#: Characters of the texts whose new chunks are looked for together; chunks that
#: are merged together.
TOGETHER, MERGED = 1 << 19, 8192
#: Stands for the rank of a byte pair that is a certain cut.
CUT = -1

# Fixed value: the pre-tokenizer's pattern; L, N and S stand for the classes of
# letters, numbers and white space.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[L]+| ?[N]+| ?[^SLN]+|[S]+(?![^S])|[S]+"


UNICODE = {"L": r"\p{L}", "N": r"\p{N}", "S": r"\p{White_Space}"}
#: The same classes below U+0100.
LATIN = {"L": "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "N": "0-9\xb2\xb3\xb9\xbc-\xbe", "S": "\t-\r \x85\xa0"}


def pattern(classes: dict[str, str]) -> str:
    out = PATTERN.replace("[^SLN]", f"[^{classes['S']}{classes['L']}{classes['N']}]").replace("[^S]", f"[^{classes['S']}]")
    for name, members in classes.items():
        out = out.replace(f"[{name}]", f"[{members}]")
    return out


@functools.cache
def character_classes() -> tuple[dict[str, str], str]:
    """The classes as the tokenizers library has them, and the characters whose
    class differs from ``UNICODE`` (the Unicode versions may differ). The
    characters of a class form one piece in the library, so pieces that should
    not be there show characters that it sorts elsewhere."""
    from tokenizers import pre_tokenizers

    library = pre_tokenizers.ByteLevel(add_prefix_space=False)
    own = regex.compile("|".join(f"(?P<{k}>{v})" for k, v in UNICODE.items()))
    members: dict[str, list[str]] = {"L": [], "N": [], "": []}
    for c in map(chr, [*range(0xD800), *range(0xE000, 0x110000)]):
        kind = m.lastgroup if (m := own.match(c)) else ""
        if kind != "S":
            members[kind].append(c)
    lost: dict[str, str] = {"L": "", "N": "", "S": ""}
    more: dict[str, str] = {"L": "", "N": "", "S": ""}
    lead, odd = {"L": "a", "N": "1"}, ""
    for kind, chars in members.items():
        text = "".join(chars)
        for _, (a, b) in library.pre_tokenize_str(text):
            there = next((k for k, c in lead.items() if len(library.pre_tokenize_str(c + text[a])) == 1), "")
            if there != kind:
                odd += text[a:b]
                if kind:
                    lost[kind] += text[a:b]
                if there:
                    more[there] += text[a:b]
    quoted = {k: regex.escape(v, special_only=True) for k, v in lost.items()}
    added = {k: regex.escape(v, special_only=True) for k, v in more.items()}
    exact = {
        k: f"[[{v}]--[{quoted[k]}]{added[k]}]" if lost[k] else f"[{v}{added[k]}]" for k, v in UNICODE.items()
    }
    return exact, odd


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in such vocabularies:
    printable Latin-1 for itself, the others counted on from 256."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    letters = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return letters | {chr(256 + i): b for i, b in enumerate(rest)}


def is_word(text: str) -> bool:
    """Letters below U+0100 only: one piece, also with a space before it."""
    return text.isalpha() and (text.isascii() or max(text) < "\u0100")


class Bpe(dict):
    """Chunk of text after a space -> the ids of both, as bytes; filled as
    chunks are met."""

    def __init__(self, model: bytes, classes: dict[str, str], odd: str):
        super().__init__()
        spec = json.loads(model)
        letters = byte_letters()
        vocab = spec["model"]["vocab"]
        whole = {bytes(letters[c] for c in token): i for token, i in vocab.items() if set(token) <= letters.keys()}
        self.first = [whole.get(bytes([b])) for b in range(256)]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.rank = {vocab[a] << 20 | vocab[b]: rank for rank, (a, b) in enumerate(merges)}
        self.result = [vocab[a + b] for a, b in merges]
        never = len(self.result)
        inside = {pair for token in whole for pair in zip(token, token[1:], strict=False)}

        def start(a: int, b: int) -> int:
            if (a, b) not in inside:
                return CUT
            x, y = self.first[a], self.first[b]
            return never if x is None or y is None else self.rank.get(x << 20 | y, never)

        #: Ranks of the pairs of single bytes by the first byte; ``CUT`` for those
        #: that no vocabulary token holds.
        self.bytes_rank = [[start(a, b) for b in range(256)] for a in range(256)]
        #: The same as arrays; ranks of pairs are in the order of their keys.
        self.first_ids = np.array([-1 if i is None else i for i in self.first])
        self.first_ranks, self.results = np.array(self.bytes_rank), np.array(self.result, np.int64)
        self.pairs = np.array(sorted(self.rank), np.int64)
        self.pair_ranks = np.array([self.rank[p] for p in self.pairs.tolist()], np.int64)
        self.text = texts(spec)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        if len(vocab) > 1 << 20:
            raise ValueError("ids of more than 20 bits")
        # The three forms agree wherever they are used; the plain ones are faster.
        self.latin = re.compile(pattern(LATIN))
        self.plain = regex.compile(pattern(UNICODE))
        self.exact = regex.compile(pattern(classes), regex.V1)
        self.odd = frozenset(odd)
        self.spaces = regex.compile(r"\p{White_Space} | \p{White_Space}| \Z")
        #: White space but spaces and line ends.
        self.rare = re.compile("[\t\x0b-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
        self.older: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}

    def __missing__(self, chunk: str) -> bytes:
        """The ids of a space and ``chunk``."""
        if len(self) >= MAX_CHUNKS:
            self.older = dict(self)
            self.clear()
        out = self.older.pop(chunk, None)
        if out is None:
            out = self.ids(f" {chunk}") if is_word(chunk) else self.whole(f" {chunk}")
        self[chunk] = out
        return out

    def learn(self, texts: list[str]) -> None:
        """Remembers the chunks of the texts; those that are new are merged
        together. What is left out here is found by :meth:`encode` itself."""
        if None in self.first or not len(self.pairs):
            return
        met: set[str] = set()
        for text in texts:
            met.update(text.split(" "))
            if len(met) > MAX_CHUNKS:
                break
        if len(self) + len(met) > MAX_CHUNKS:
            self.older = dict(self)
            self.clear()
        plain, latin, other = [], [], []
        for chunk in itertools.islice(met, MAX_CHUNKS):
            if chunk in self:
                continue
            ids = self.older.pop(chunk, None)
            if ids is not None:
                self[chunk] = ids
            elif 0 < len(chunk) <= SHORT and chunk == chunk.strip():
                (plain if chunk.isascii() else latin if max(chunk) < "\u0100" else other).append(chunk)
        for chunks in (plain, latin, other):
            for at in range(0, len(chunks), MERGED):
                part = chunks[at : at + MERGED]
                self.update(zip(part, self._merged_together(part), strict=True))

    def _merged_together(self, chunks: list[str]) -> Iterator[bytes]:
        """The ids of a space and each chunk; none is empty or has white space at
        its ends. As one text they are cut into pieces, and those at the byte pairs
        that no token spans; of each fragment the lowest-ranked pair, of equal ones
        the leftmost, is merged in each round, until none has a rank."""
        text = " " + " ".join(chunks)
        data = np.frombuffer(text.encode(), np.uint8)
        starts = np.append(np.flatnonzero(data & 0xC0 != 0x80), len(data))  # of the characters
        never = len(self.result)
        pieces = self.pieces(text)
        piece = starts[np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))]
        ids, left = self.first_ids[data], np.ones(len(data), bool)
        rank = np.full(len(data), never, np.int64)  # of each byte and the next
        rank[:-1] = self.first_ranks[data[:-1], data[1:]]
        rank[piece - 1] = CUT
        # Of the fragments that still merge: their ids' places, and where each starts.
        place, start = np.arange(len(data)), np.flatnonzero(np.append(True, rank[:-1] == CUT))
        rank[rank == CUT] = never
        while len(start):
            low = np.minimum.reduceat(rank << 32 | np.arange(len(rank)), start)
            merging = low >> 32 < never
            size = np.diff(start, append=len(rank))
            stays = np.repeat(merging, size)
            now = np.cumsum(stays) - 1
            place, rank, size, low = place[stays], rank[stays], size[merging], low[merging]
            at, new = now[low & 0xFFFFFFFF], self.results[low >> 32]
            ids[place[at]] = new
            left[place[at + 1]] = False
            rank[at] = rank[at + 1]  # never, if that was the last
            stays = np.ones(len(place), bool)
            stays[at + 1] = False
            place, rank = place[stays], rank[stays]
            at -= np.arange(len(at))  # each fragment before has one id less
            size -= 1
            start = np.cumsum(size) - size
            inner = at > start
            rank[at[inner] - 1] = self._pair_ranks(ids[place[at[inner] - 1]], new[inner])
            inner = at < start + size - 1
            rank[at[inner]] = self._pair_ranks(new[inner], ids[place[at[inner] + 1]])
        out = ids[left].astype("<u4").tobytes()
        first = starts[np.cumsum([0, *[len(chunk) + 1 for chunk in chunks]])]
        ends = (4 * np.append(0, np.cumsum(left))[first]).tolist()
        return (out[i:j] for i, j in itertools.pairwise(ends))

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pair = left << 20 | right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pair, self.pair_ranks[at], len(self.result))

    def rest(self) -> None:
        """Between tasks the older generation goes."""
        self.older = {}

    def whole(self, text: str) -> bytes:
        known = self.known
        if len(known) >= MAX_PIECES:
            known.clear()
        out = []
        for piece in self.pieces(text):
            if piece[0] == " " and is_word(word := piece[1:]):
                out.append(self[word])  # remembered with the chunks
                continue
            ids = known.get(piece)
            if ids is None:
                known[piece] = ids = self.ids(piece)
            out.append(ids)
        return b"".join(out) if len(out) > 1 else out[0] if out else b""

    def ids(self, piece: str) -> bytes:
        """``piece`` is cut at the byte pairs that no token spans, its fragments
        are merged."""
        own = piece.encode()
        table, first = self.bytes_rank, self.first
        ids = list(map(first.__getitem__, own))
        ranks = [row[b] for row, b in zip(map(table.__getitem__, own), own[1:], strict=False)]
        if CUT in ranks:
            at = [i for i, rank in enumerate(ranks, 1) if rank == CUT]
            merged = []
            for i, j in zip([0, *at], [*at, len(own)], strict=True):
                merged += self.merged(ids[i:j], ranks[i : j - 1])
        else:
            merged = self.merged(ids, ranks)
        out = array("I", merged)
        if BIG:
            out.byteswap()
        return out.tobytes()

    def merged(self, ids: list[int | None], ranks: list[int]) -> list[int]:
        """Ids of a fragment from those of its bytes and the ranks of their
        pairs: the lowest-ranked pair merges first, of equal ones the leftmost."""
        if len(ids) > SHORT:
            return self._merged_long(ids)
        rank, result = self.rank.get, self.result
        never = len(result)
        # The end is an id that pairs with nothing; it also stands before the first.
        ids.append(-1)
        ranks.append(never)
        while (low := min(ranks)) != never:
            at = ranks.index(low)
            new = result[low]
            del ids[at], ranks[at]
            ids[at] = new
            ranks[at - 1] = rank(ids[at - 1] << 20 | new, never)
            ranks[at] = rank(new << 20 | ids[at + 1], never)
        ids.pop()
        return ids

    def _merged_long(self, ids: list[int | None]) -> list[int]:
        """The same with a heap and linked neighbours, for long fragments."""
        n, rank = len(ids), self.rank
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(rank[p], i, p) for i in range(n - 1) if (p := ids[i] << 20 | ids[i + 1]) in rank]
        heapify(heap)
        while heap:
            low, i, pair = heappop(heap)
            j = after[i]
            if j >= n or ids[i] is None or ids[i] << 20 | ids[j] != pair:
                continue
            ids[i], ids[j] = self.result[low], None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for x, y in ((before[i], i), (i, k)):
                if x >= 0 and y < n and (p := ids[x] << 20 | ids[y]) in rank:
                    heappush(heap, (rank[p], x, p))
        return [i for i in ids if i is not None]

    def pieces(self, text: str) -> list[str]:
        if max(text, default="") < "\u0100":
            return self.latin.findall(text)
        return (self.plain if self.odd.isdisjoint(text) else self.exact).findall(text)

    def part(self, text: str) -> bytes:
        """A space between characters that are not white space is a certain
        cut too: no piece reaches across its front, and it begins a piece. The
        chunks between such spaces repeat, so their ids are remembered."""
        if "  " in text or "\n " in text or " \n" in text or text.endswith(" "):
            return self.whole(text)
        if self.rare.search(text) and self.spaces.search(text):
            return self.whole(text)
        first, *rest = text.split(" ")
        return self.whole(first) + b"".join(map(self.__getitem__, rest))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        parts = self.special.split(text) if self.special else [text]
        out = []
        for part in parts:
            if part in self.added:
                out.append(struct.pack("<I", self.added[part]))
            else:
                out.append(self.part(part))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        return decoded(ids, self.text)


def texts(spec: dict) -> dict[int, bytes]:
    """Id -> the bytes of its token."""
    letters = byte_letters()
    own = {i: bytes(letters[c] for c in t) for t, i in spec["model"]["vocab"].items() if set(t) <= letters.keys()}
    return own | {t["id"]: t["content"].encode() for t in spec["added_tokens"]}


def decoded(ids: bytes, text: dict[int, bytes]) -> str:
    return b"".join(map(text.__getitem__, array("I", ids))).decode("utf-8", "replace")


def decoder(model: bytes) -> dict[int, bytes]:
    """What decoding needs of a model: a worker that only decodes has no memory
    of pieces, ranks and patterns."""
    return texts(json.loads(model))


def _model(docs: DataFrame, path: str):
    with open(path, "rb") as f:
        model = f.read(MAX_MODEL_BYTES + 1)
    if len(model) > MAX_MODEL_BYTES:
        raise ValueError(f"{path} is larger than {MAX_MODEL_BYTES} bytes")
    return docs.sparkSession.sparkContext.broadcast((model, *character_classes()))


def together(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Rows (id, text) in groups of at least ``TOGETHER`` characters."""
    group, size = [], 0
    for row in rows:
        group.append(row)
        size += len(row[1])
        if size >= TOGETHER:
            yield group
            group, size = [], 0
    if group:
        yield group


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", back: bool = False) -> DataFrame:
    """(doc_id, ids): ids as little-endian unsigned 32-bit integers. With
    ``back`` also ``decoded``, the text that is read back from the ids, as
    :func:`decode` does, in the task that made them."""
    model = _model(docs, path)
    kind = docs.schema[key].dataType.simpleString()
    schema = f"doc_id {kind}, ids binary" + ", decoded string" * back
    fields = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, out = worker_wide(Bpe, *model.value), Batches(fields)
        for rows in together(rows_of(batches)):
            bpe.learn([t for _, t in rows])
            for doc_id, t in rows:
                ids = bpe.encode(t)
                yield from out.add((doc_id, ids, bpe.decode(ids)) if back else (doc_id, ids), (1 + back) * len(ids))
        yield from out.flush()

    return map_arrow(docs.select(F.col(key).alias("doc_id"), text_of(docs, text).alias("text")), run, schema, keeps=True)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with ``decoded``, the text of the ids."""
    model = _model(encoded, path)
    kind = encoded.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, ids binary, decoded string"
    fields = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text, out = worker_wide(decoder, model.value[0]), Batches(fields)
        for doc_id, ids in rows_of(batches):
            yield from out.add((doc_id, ids, decoded(ids, text)), 2 * len(ids))
        yield from out.flush()

    return map_arrow(encoded.select("doc_id", "ids"), run, schema, keeps=True)
