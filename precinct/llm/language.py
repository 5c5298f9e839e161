"""Language identification with a convolutional network over bytes.

Filters of several widths run over the bytes of a window, their largest
activation in the window goes through a rectifier into a softmax. The network
is trained in numpy on the driver, on a bounded sample of labelled windows
(``windows`` windows of a document, ``per_lang`` documents of a language and
``total`` in all: documented parameters), drawn over whole texts. Every label
that occurs is learned: with many, each has fewer documents, down to one, so
``total`` is passed only where there are more labels than that.

A prediction reads the whole text: it is cut into windows of fixed length that
overlap by the widest filter less one, all windows of a batch go through the
network together, and a document's probabilities are the mean over its windows,
weighted by their bytes. Only the text goes into it.

Cases: null texts and texts without a letter are ``und`` with score 0. With no
labelled text to learn from every document is ``und``. Repeated rows and null
ids stay as they are; an empty table gives an empty result; other columns than
key, text and label are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from precinct.llm.arrow import Batches, arrow_column, arrow_schema, map_arrow, rows_of, values_of
from precinct.llm.tables import text_of

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
#: The bound of the training sample.
PER_LANG, WINDOWS, TOTAL = 300, 4, 19_200
#: Windows that go through the network at once: their activations stay in cache.
BLOCK = 64
#: ASCII capitals count as small letters.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def windows_of(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The text's bytes as overlapping windows, zero at the end, and how many
    bytes of each are new."""
    data = np.frombuffer((text or "").encode().translate(FOLD), np.uint8)
    step = WINDOW - max(WIDTHS) + 1
    n = max(1, -(-(len(data) - WINDOW + step) // step))
    padded = np.zeros(step * (n - 1) + WINDOW, np.uint8)
    padded[: len(data)] = data
    cut = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::step]
    return cut, np.clip(len(data) - step * np.arange(n), 1, step).astype(np.float32)


class Network:
    """``tables[k][j]``: what each byte at place j adds to the filters of the
    k-th width."""

    def __init__(self, classes: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.classes = classes
        self.tables = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.out = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(classes))).astype(np.float32)
        self.out_bias = np.zeros(len(classes), np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [*self.tables, self.bias, self.out, self.out_bias]

    @staticmethod
    def softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def step(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        """Gradients of the cross entropy of a batch."""
        n, pooled, where = len(x), [], []
        for table in self.tables:
            w = len(table)
            conv = sum(table[j][x[:, j : WINDOW - w + 1 + j]] for j in range(w))
            where.append(conv.argmax(1))
            pooled.append(np.take_along_axis(conv, where[-1][:, None], 1)[:, 0])
        raw = np.concatenate(pooled, 1) + self.bias
        hidden = np.maximum(raw, 0)
        p = self.softmax(hidden @ self.out + self.out_bias)
        p[np.arange(n), y] -= 1
        p /= n
        back = (p @ self.out.T) * (raw > 0)
        grads = []
        for k, table in enumerate(self.tables):
            g, mine = np.zeros_like(table), back[:, k * FILTERS : (k + 1) * FILTERS]
            for j in range(len(table)):
                at = np.take_along_axis(x, where[k] + j, 1)
                np.add.at(g[j], (at, np.arange(FILTERS)[None]), mine)
            grads.append(g)
        return [*grads, back.sum(0), hidden.T @ p, p.sum(0)]

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.01) -> None:
        """Adam over shuffled batches."""
        rng = np.random.default_rng(11)
        first = [np.zeros_like(p) for p in self.parameters()]
        second = [np.zeros_like(p) for p in self.parameters()]
        t = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), batch):
                pick, t = order[at : at + batch], t + 1
                for p, g, m, v in zip(self.parameters(), self.step(x[pick], y[pick]), first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)

    def pairs(self) -> list[list[np.ndarray]]:
        """The tables for two neighbouring bytes at once (and a last one)."""
        out = []
        for table in self.tables:
            parts = [(table[j][:, None] + table[j + 1][None]).reshape(65536, -1) for j in range(0, len(table) - 1, 2)]
            out.append(parts + ([table[-1]] if len(table) % 2 else []))
        return out

    def predict(self, x: np.ndarray, pairs: list[list[np.ndarray]]) -> np.ndarray:
        """Class probabilities of each window."""
        out = []
        for at in range(0, len(x), BLOCK):
            # Places first, so that the maximum runs over whole rows.
            one = np.ascontiguousarray(x[at : at + BLOCK].T)
            two = one[:-1].astype(np.int32) * 256 + one[1:]
            pooled = []
            for table, parts in zip(self.tables, pairs, strict=True):
                span = WINDOW - len(table) + 1
                conv = np.take(parts[0], two[:span], axis=0)
                for k, part in enumerate(parts[1:], 1):
                    conv += np.take(part, (two if len(part) == 65536 else one)[2 * k : 2 * k + span], axis=0)
                pooled.append(conv.max(0))
            hidden = np.maximum(np.concatenate(pooled, 1) + self.bias, 0)
            out.append(self.softmax(hidden @ self.out + self.out_bias))
        return np.concatenate(out) if out else np.zeros((0, len(self.classes)), np.float32)


def sample(
    docs: DataFrame, label: str = "lang", key: str = "doc_id", text: str = "text",
    per_lang: int = PER_LANG, windows: int = WINDOWS, total: int = TOTAL,
) -> list:
    """At most per_lang rows (lang, parts) of each label and total of all, one
    of each at least: windows at places that a hash of the row draws over the
    whole text."""
    rows = docs.select(
        F.col(label).cast("string").alias("lang"),
        text_of(docs, text).alias("text"),
        F.xxhash64(F.col(key).cast("string")).alias("h"),
    ).where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    labels = rows.select("lang").distinct().count()
    each = min(per_lang, max(1, total // max(1, labels)))
    room = F.greatest(F.char_length("text") - WINDOW + 1, F.lit(1))
    parts = F.array(
        *[F.substring(F.col("text"), F.pmod(F.xxhash64("h", F.lit(i)), room).cast("int") + 1, F.lit(WINDOW)) for i in range(windows)]
    )
    picked = Window.partitionBy("lang").orderBy("h", "parts")
    return (
        rows.select("lang", "h", parts.alias("parts"))
        .withColumn("n", F.row_number().over(picked))
        .where(F.col("n") <= each)
        .orderBy("lang", "n")
        .select("lang", "parts")
        .collect()
    )


def trained(rows: list) -> Network | None:
    """A network for the sampled rows; None if there are none."""
    classes = sorted({r["lang"] for r in rows})
    if not classes:
        return None
    number = {lang: i for i, lang in enumerate(classes)}
    pairs = [(windows_of(p)[0][0], number[r["lang"]]) for r in rows for p in r["parts"]]
    network = Network(classes)
    network.fit(np.array([x for x, _ in pairs]), np.array([y for _, y in pairs]))
    return network


def lettered(text: Column) -> Column:
    """Whether a text has a letter; null if it is null."""
    return text.cast("string").rlike(r"\p{L}")


def _judged(texts: list[str | None], network: Network, pairs: list) -> list[tuple[str, float]]:
    """(label, score) of each text, their windows through the network together."""
    cut = [windows_of(t) if t is not None else (None, None) for t in texts]
    x = [c for c, _ in cut if c is not None]
    p, at, out = network.predict(np.concatenate(x), pairs) if x else None, 0, []
    for own, size in cut:
        if own is None:
            out.append(("und", 0.0))
            continue
        mean = np.average(p[at : at + len(own)].astype(np.float64), axis=0, weights=size)
        at += len(own)
        best = int(mean.argmax())
        out.append((network.classes[best], float(min(1.0, mean[best]))))
    return out


def _together(texts: Iterator[tuple], at: int) -> Iterator[list[tuple]]:
    """Rows in lists of about as many windows as go through the network at once;
    ``at``: the place of the text in a row."""
    waiting, size = [], 0
    for row in texts:
        waiting.append(row)
        size += len(row[at] or "")
        if size >= 16 * BLOCK * WINDOW or len(waiting) >= 16 * BLOCK:
            yield waiting
            waiting, size = [], 0
    if waiting:
        yield waiting


def identify(docs: DataFrame, network: Network | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of each row."""
    kind = docs.schema[key].dataType.simpleString()
    schema = f"doc_id {kind}, lang_pred string, score double"
    rows = docs.select(F.col(key).alias("doc_id"), F.when(lettered(F.col(text)), F.col(text).cast("string")).alias("text"))
    if network is None:
        return rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    fields = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, pairs = Batches(fields), network.pairs()
        for rows in _together(rows_of(batches), 1):
            for (doc_id, _), found in zip(rows, _judged([t for _, t in rows], network, pairs), strict=True):
                yield from out.add((doc_id, *found))
        yield from out.flush()

    return map_arrow(rows, run, schema)


def predicted(text: Column, network: Network) -> Column:
    """The label of a text, ``und`` if it is null or has no letter: as a column,
    for stages that judge rows where they are."""

    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pairs = network.pairs()
        for array in arrays:
            found: list[str] = []
            for part in _together(((t,) for texts in values_of(iter([array])) for t in texts), 0):
                found += [label for label, _ in _judged([t for (t,) in part], network, pairs)]
            yield pa.array(found, pa.string())

    return arrow_column(run, "string", F.when(lettered(text), text.cast("string")))
