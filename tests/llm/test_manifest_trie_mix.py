"""Merkle manifest, prefix trie and source mix against brute force, with nulls,
empty texts, ties, repeated rows, empty tables and columns of clashing names."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from precinct.llm import merkle, mixing, scans, trie


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# ------------------------------------------------------------------ sums


def test_running_sums_over_ranges(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "a", "a", "b", None]), k, rng.randrange(5)) for k in range(500)]
    df = spark.createDataFrame(rows, "g string, k int, v bigint").repartition(7)
    got = {r.k: r.before_v for r in scans.running(df, ["g"], ["k"], ["v"], "sums").collect()}
    for g in ("a", "b", None):
        total = 0
        for _, k, v in [r for r in rows if r[0] == g]:
            assert got[k] == total
            total += v
    ranks = scans.ranked(df, [], ["k"], "ranks").collect()
    assert all(r["rank"] == r.k for r in ranks)


# ------------------------------------------------------------------ 11

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, tree string, level int, i int, segment string"


def told(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row):
    return sha(*[told(row[c]) for c in merkle.FIELDS])


def reduced(digests):
    """The top of a tree and, for each leaf, (left, right) a level."""
    paths, members = [[] for _ in digests], [[k] for k in range(len(digests))]
    while len(digests) > 1:
        runs = [range(j, min(j + 3, len(digests))) for j in range(0, len(digests), 3)]
        for run in runs:
            for k in run:
                for m in members[k]:
                    paths[m].append((
                        "".join(digests[j] for j in run if j < k), "".join(digests[j] for j in run if j > k)
                    ))
        members = [sum((members[k] for k in run), []) for run in runs]
        digests = [sha(*[digests[k] for k in run]) for run in runs]
    return digests[0], paths


def manifest_of(rows):
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    own = {s: sorted(by[s], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r))) for s in sources}
    low = {s: reduced([leaf_of(r) for r in own[s]]) for s in sources}
    root, above = reduced([low[s][0] for s in sources]) if sources else (None, [])
    for s, high in zip(sources, above, strict=True):
        for r, path in zip(own[s], low[s][1], strict=True):
            node = leaf_of(r | {"text": changed(r)})
            for left, right in path + high:
                node = sha(left, node, right)
            yield (r["doc_id"], leaf_of(r), low[s][0], root, sha(*[a + b for a, b in path + high]), node, node == root)


def changed(row):
    if row["doc_id"] is None or row["text"] is None or zlib.crc32(str(row["doc_id"]).encode()) % 2:
        return row["text"]
    return row["text"].replace("\n", "")


def manifest_query(docs):
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    text = F.when(even, F.translate("text", "\n", "")).otherwise(F.col("text"))
    found = merkle.verified(merkle.manifest(docs, {"text": text}))
    shown = [merkle.shown(F.col(c)) for c in ("leaf", "subroot", "root")]
    return found.select("key", *shown, F.sha2(merkle.proof(F.col("segment")), 256), "folded_root", "verified")


def documents(sizes, rng):
    """Rows of sources with the given sizes; ids repeat, fields are null or odd."""
    for source, size in sizes.items():
        for _ in range(size):
            text = rng.choice([None, "", "a\nb", "é\n", "x" * rng.randrange(50), "\n" * rng.randrange(3)])
            yield {
                "doc_id": rng.choice([None, *range(60)]), "text": text, "lang": rng.choice([None, "en", ""]),
                "source": source, "n_chars": rng.choice([None, 0, 12]),
                "tree": "t", "level": 1, "i": 2, "segment": "s",
            }


SIZES = [
    {}, {"a": 1}, {None: 1, "b": 1}, {"a": 2, "": 3, None: 4}, {"a": 250},
    {None: 85, "z": 81, "é": 82, "b": 1, "c": 9}, {chr(97 + k): k % 5 + 1 for k in range(20)},
]


@pytest.mark.parametrize("sizes", SIZES, ids=str)
def test_merkle_manifest(spark, sizes):
    rows = list(documents(sizes, random.Random(3)))
    docs = spark.createDataFrame([tuple(r[c] for c in [f.split()[0] for f in DOCS.split(", ")]) for r in rows], DOCS)
    got = Counter(map(tuple, manifest_query(docs.repartition(5)).collect()))
    want = Counter(manifest_of(rows))
    # Equal leaves may stand in either order: what does not depend on it agrees,
    # and so do the folds of all.
    assert got == want


def test_merkle_tells_any_change(spark):
    docs = spark.createDataFrame([(k, f"s{k % 4}", "en", k, f"text {k}") for k in range(40)], "doc_id bigint, source string, lang string, n_chars bigint, text string")
    changes = {"text": F.concat("text", F.lit("")), "lang": F.lit("fr"), "n_chars": F.col("n_chars") + 1}
    for name, change in changes.items():
        found = merkle.verified(merkle.manifest(docs, {name: change}))
        assert {r.verified for r in found.collect()} == {name == "text"}


# ------------------------------------------------------------------ 12

TURNS = "conv_id bigint, turn bigint, role string, text string, key string, p int, k int, up string"


def rebuilt_of(rows):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            own[conv_id].append((turn is not None, turn or 0, sha(f"{len(role.encode())}:", role, text), role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        yield c, own.get(c - c % 100, [])[:h] + turns[h:]


def trie_of(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs:
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = Counter(n[:-1] for n in members if n)
    leaves, saved = Counter(), Counter()
    for n in members:
        for d in range(len(n) + 1):
            leaves[n[:d]] += not children[n]
            saved[n[:d]] += (len(members[n]) - 1) * (len(n[-1][1]) if n else 0)
    for n, own in members.items():
        yield (
            min(own), len(n), min(members[n[:-1]]) if n else None, len(own), children[n], leaves[n], saved[n],
            sha(",".join(map(str, sorted(ends[n])))),
        )


def trie_query(df, band):
    turns = trie.numbered_turns(df)
    c = F.col("conv_id")
    rebuilt = trie.spliced(turns, c - c % 100, F.crc32(c.cast("string")) % 6, 5)
    return trie.nodes(rebuilt, turns.select("conv_id").distinct(), band).drop("key")


def conversations(seed, n, most):
    rng = random.Random(seed)
    for c in rng.sample(range(350), n):
        for turn in range(rng.randrange(1, most)):
            yield c, rng.choice([turn, turn, None]), rng.choice(["user", "user", None]), rng.choice(["é", "yes", "", None])


@pytest.mark.parametrize("band", [2, 3, 8])
@pytest.mark.parametrize("case", [(1, 60, 9), (2, 5, 70), (3, 1, 3), (4, 0, 1)], ids=str)
def test_prefix_trie(spark, case, band):
    rows = list(conversations(*case))
    rows += [(100, 0, "user", "a"), (100, 0, "user", "a"), (None, 0, "user", "lost")] if rows else []
    df = spark.createDataFrame([(*r, "k", 1, 2, "u") for r in rows], TURNS)
    got = trie_query(df, band)
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert Counter(map(tuple, got.select(names).collect())) == Counter(trie_of(rebuilt_of(rows)))


def test_trie_with_turnless_conversations(spark):
    """Conversations shorter than what they take from an absent one are turnless."""
    short = [c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 2][:4]
    rows = [(c, 0, "user", "a", "k", 1, 2, "u") for c in short]
    got = trie_query(spark.createDataFrame(rows, TURNS), 8).collect()
    assert [(r.conv_id, r.depth, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens) for r in got] == [(short[0], 0, 4, 0, 1, 0)]
    assert got[0].ends_sha256 == sha(",".join(map(str, short)))


def test_trie_lists_are_made_of_pieces(spark, monkeypatch):
    ends = spark.range(0, 5000).select(F.lit(b"k").alias("key"), (F.col("id") * 7 % 5000).alias("conv_id")).repartition(9)
    monkeypatch.setattr(trie, "PIECE", 100)
    got = trie._list_digests(ends.unionByName(spark.createDataFrame([(b"l", -3)], "key binary, conv_id bigint"))).collect()
    want = {b"k": sha(",".join(map(str, range(5000)))), b"l": sha("-3")}
    assert {bytes(r.key): r.ends_sha256 for r in got} == want


# ------------------------------------------------------------------ 13

MIX = "doc_id bigint, text string, source string, size int, draw string, budget int, rank int, part int"


def targets_of(sizes):
    """Shares by weight; what is above three times a source's size goes to the others."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    full = {}
    while True:
        rest = sum(sizes.values()) - sum(full.values())
        heavy = sum(w for s, w in weight.items() if s not in full)
        share = {s: rest * w / heavy for s, w in weight.items() if s not in full}
        above = [s for s in share if share[s] > 3 * sizes[s]]
        if not above:
            return share | full
        full |= {s: 3 * sizes[s] for s in above}


def mix_rows(rng, sizes):
    for source, n in sizes.items():
        for _ in range(n):
            text = rng.choice([None, "", " \n", "a", "b c", "w " * rng.randrange(40), "x\ty\x0bz"])
            yield rng.choice([None, *range(50)]), text, source


@pytest.mark.parametrize("sizes", [{}, {"a": 3}, {"a": 1, "b": 300, "c": 5, None: 40, "é": 90}, {None: 9, "a": 9, "b": 0}], ids=str)
def test_mix(spark, sizes):
    rows = list(mix_rows(random.Random(7), sizes))
    docs = spark.createDataFrame([(*r, 1, "d", 1, 1, 1) for r in rows], MIX)
    labels = spark.createDataFrame([(k, k % 2) for k in range(30)] + [(3, 0), (None, 1)], "doc_id bigint, quality int")
    got = mixing.mixed(docs.repartition(4), labels).collect()
    again = mixing.mixed(docs.repartition(3).orderBy(F.desc("doc_id")), labels).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter((i, s, len((t or "").split())) for i, t, s in rows)
    words = Counter()
    for r in got:
        words[r.source] += r.size
    want = targets_of({r.source: words[r.source] for r in got}) if sum(words.values()) else defaultdict(float)
    taken = Counter()
    for r in got:
        assert 0 <= r.taken <= 3 * r.size and r.source_size == words[r.source]
        assert r.target == pytest.approx(want[r.source])
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.5 + 1e-9 for s in words)


def test_mix_prefers_heavy_documents(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b c d").alias("text"), F.when(F.col("id") < 2000, "a").otherwise("b").alias("source"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    # Source a is to give 1.43 times its words, source b 0.57 times: part of it.
    got = mixing.mixed(docs, labels).where("source = 'b'").groupBy((F.col("doc_id") % 2).alias("good")).agg(F.sum("taken").alias("n"))
    n = {r.good: r.n for r in got.collect()}
    assert n[1] > 1.5 * n[0]
    plain = mixing.mixed(docs).where("source = 'b'").groupBy((F.col("doc_id") % 2).alias("good")).agg(F.sum("taken").alias("n"))
    n = {r.good: r.n for r in plain.collect()}
    assert 0.8 < n[1] / n[0] < 1.25
