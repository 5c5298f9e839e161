"""Secret scans through a trigram inverted index.

For every rule a Boolean query over trigrams is derived from its regular
expression: each match must contain, for at least one alternative, all
trigrams of the literals that the alternative cannot do without. The index
holds postings (trigram, document) for the trigrams that the rules ask for;
the postings are intersected per document, and only documents that satisfy a
rule's query are verified with its regular expression. Rules from which no
mandatory trigram follows (a character class alone) scan every document.

Only DataFrame functions are used. Offsets are code points, end exclusive. A
match's start is found by cutting the text at the matches: the pieces between
them and the matches alternate, so their lengths add up to the offsets.

Trigrams are folded to lower case, which can only add candidates. Postings
hold at most one row per document and trigram, and there are as many trigrams
as the rules have, so no list grows into one task: the intersection is a
map-side combined ``bit_or`` per document.

Cases: null and empty texts have no spans (``base_sha256`` is the digest of
the empty string). Repeated rows are reported once per row, null ids too. An
empty table gives an empty result; columns other than the key and the text
are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precinct.llm.tables import text_of, written

#: Exact literal sets beyond this size are not enumerated any further.
MAX_LITERALS = 64


@dataclass(frozen=True)
class Rule:
    """``pattern`` with ``least`` characters in ``group`` (0: the match)."""

    kind: str
    pattern: str
    group: int
    least: int


# The patterns of the contract. The patterns of access and hex
# state the least length themselves; their shorter matches could not hide a
# longer one, as a match always takes in all that follows of its class.
RULES = (
    Rule(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    Rule("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)

Query = list[frozenset[str]]  # any of these sets of trigrams, all of the set


def trigram_query(pattern: str) -> Query | None:
    """The trigrams that every match contains, or None where none is sure."""
    from re import _parser as parser  # the parse tree of the standard library

    def literals(nodes) -> list[set[str] | None]:
        """Parts of a match, in order: all strings a part can be, or None for
        a part that is not enumerated."""
        parts: list[set[str] | None] = []
        for op, arg in nodes:
            name = str(op)
            if name == "LITERAL":
                parts.append({chr(arg).lower()})
            elif name == "SUBPATTERN":
                parts.extend(literals(arg[3]))
            elif name == "BRANCH":
                options = [joined(literals(branch)) for branch in arg[1]]
                whole = [x[0] for x in options if len(x) == 1 and x[0] is not None]
                parts.append(set().union(*whole) if len(whole) == len(options) else None)
            elif name == "MAX_REPEAT" and arg[1] == 1 and arg[0] == 0:
                option = joined(literals(arg[2]))
                known = len(option) == 1 and option[0] is not None
                parts.append({""} | option[0] if known else None)
            elif name == "IN" and all(str(kind) == "LITERAL" for kind, _ in arg):
                parts.append({chr(code).lower() for _, code in arg})
            else:
                parts.append(None)
        return parts

    def joined(parts: list[set[str] | None]) -> list[set[str] | None]:
        """Neighbouring enumerated parts as one."""
        out: list[set[str] | None] = []
        for part in parts:
            if out and part is not None and out[-1] is not None and len(out[-1]) * len(part) <= MAX_LITERALS:
                out[-1] = {a + b for a, b in product(out[-1], part)}
            else:
                out.append(part)
        return out

    query: Query | None = None
    for part in joined(literals(parser.parse(pattern))):
        if part is None or min(map(len, part)) < 3:
            continue
        sets = [frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in sorted(part)]
        query = sets if query is None else [a | b for a in query for b in sets]
    # A set that holds another one is implied by it.
    return query and [a for a in query if not any(b < a for b in query)]


def postings(docs: DataFrame, trigrams: list[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, trigram): a row for each listed trigram of each document;
    ``trigram`` is its place in the list."""
    folded = F.lower(text_of(docs, text))
    found = F.filter(
        F.array(*[F.when(F.contains(folded, F.lit(t)), F.lit(i)) for i, t in enumerate(trigrams)]),
        lambda x: x.isNotNull(),
    )
    return docs.select(F.col(key).alias("doc_id"), F.explode(found).alias("trigram"))


def candidates(index: DataFrame, trigrams: list[str], queries: dict[str, Query]) -> DataFrame:
    """(doc_id, rules): the kinds whose queries the document's postings meet."""
    bit = {t: F.lit(1 << i % 62).cast("long") for i, t in enumerate(trigrams)}
    words = range(0, len(trigrams), 62)
    one = F.expr("shiftleft(1L, trigram % 62)")
    masks = index.groupBy("doc_id").agg(
        *[F.bit_or(F.when(F.floor(F.col("trigram") / 62) == w // 62, one).otherwise(F.lit(0).cast("long"))).alias(f"m{w}") for w in words]
    )

    def holds(trigram: str) -> Column:
        return F.col(f"m{trigrams.index(trigram) // 62 * 62}").bitwiseAND(bit[trigram]) != 0

    def meets(query: Query) -> Column:
        ways = [reduce(Column.__and__, [holds(t) for t in sorted(way)]) for way in query]
        return reduce(Column.__or__, ways)

    kinds = F.filter(
        F.array(*[F.when(meets(q), F.lit(kind)) for kind, q in queries.items()]), lambda x: x.isNotNull()
    )
    return masks.select("doc_id", kinds.alias("rules")).where(F.size("rules") > 0)


def spans_of(text: Column, rule: Rule) -> Column:
    """Array of (start, stop, kind) of the rule's matches that are long enough."""
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    sizes = F.transform(matches, F.char_length)
    heads = F.transform(F.split(text, rule.pattern, -1), F.char_length)
    counted = matches if rule.group == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.group))
    each = F.arrays_zip(
        heads.alias("head"), sizes.alias("size"), F.transform(counted, F.char_length).alias("counted")
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int,keep:boolean>>").alias("out"))

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + x["head"]
        end = begin + F.coalesce(x["size"], F.lit(0))
        span = F.struct(begin.alias("start"), end.alias("stop"), (x["counted"] >= rule.least).alias("keep"))
        return F.struct(
            end.alias("at"),
            F.when(x["size"].isNull(), state["out"]).otherwise(F.concat(state["out"], F.array(span))).alias("out"),
        )

    found = F.filter(F.aggregate(each, start, step)["out"], lambda x: x["keep"])
    return F.transform(found, lambda x: F.struct(x["start"], x["stop"], F.lit(rule.kind).alias("kind")))


def scan(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs``' key (as ``doc_id``), text and ``spans``: array of (start,
    stop, kind), ordered by start, then by the rules' order."""
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern))}
    trigrams = sorted({t for q in queries.values() for way in q for t in way})
    rows = docs.select(F.col(key).alias("doc_id"), text_of(docs, text).alias("text"))
    if trigrams:
        index = postings(docs, trigrams, key, text)
        # Read again from a table, so the planner knows its size: a small one
        # is broadcast, a large one is met by a shuffle on the document.
        found = written(candidates(index, trigrams, queries), "secret-candidates")
        rows = rows.join(
            found.withColumnRenamed("doc_id", "_id"), F.col("doc_id").eqNullSafe(F.col("_id")), "left"
        ).drop("_id")
    else:
        rows = rows.withColumn("rules", F.array().cast("array<string>"))
    none = F.array().cast("array<struct<start:int,stop:int,kind:string>>")
    each = []
    for rule in rules:
        asked = F.array_contains("rules", rule.kind) if rule.kind in queries else F.lit(True)
        each.append(
            F.when(asked & F.col("text").rlike(rule.pattern), spans_of(F.col("text"), rule)).otherwise(none)
        )
    place = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)])
    ordered = F.array_sort(
        F.transform(
            F.concat(*each),
            lambda x: F.struct(x["start"], place[x["kind"]].alias("place"), x["stop"], x["kind"]),
        )
    )
    return rows.select(
        "doc_id",
        "text",
        F.transform(ordered, lambda x: F.struct(x["start"], x["stop"], x["kind"])).alias("spans"),
    )


def listed(spans: Column) -> Column:
    """kind:start:stop of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ",")


def redacted(text: str, spans: list[tuple[int, int, str]]) -> str:
    """``text`` with each span replaced by its kind in brackets."""
    out, at = [], 0
    for start, stop, kind in spans:
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
            at = stop
    return "".join([*out, text[at:]])


def reference_spans(text: str | None, rules: tuple[Rule, ...] = RULES) -> list[tuple[int, int, str]]:
    """The spans of one text without an index, for tests."""
    out = []
    for place, rule in enumerate(rules):
        for m in re.finditer(rule.pattern, text or ""):
            if len(m[rule.group]) >= rule.least:
                out.append((m.start(), place, m.end(), rule.kind))
    return [(start, stop, kind) for start, _, stop, kind in sorted(out)]
