"""The training-data operators against brute force, exact round trips and
held-out accuracy, with nulls, empty texts, ties, repeated rows, empty tables
and columns of clashing names."""

import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from precinct.llm import bpe, chat, decontaminate, exact_dedup, jaccard, language, repeats, secrets, unigram, warc
from precinct.llm.queries import ORACLE, tokenizer
from tests.conftest import SF0001
from tests.oracle_compare import compare, duck

DOCS = "doc_id bigint, text string, uid string, name string, h string"


def table(spark, rows):
    """Documents with other columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "u", "n", "h") for i, t in rows], DOCS)


EDGE = [(0, None), (1, ""), (2, " \n\t"), (3, "a"), (3, "a"), (4, "x " * 3000), (None, "lost"), (5, "a b"), (6, "a\tb")]
OPERATORS = {
    "exact": lambda d: exact_dedup.groups(d),
    "secrets": lambda d: secrets.scan(d),
    "language": lambda d: language.identify(d, language.trained([])),
    "bpe": lambda d: bpe.decode(bpe.encode(d, tokenizer("byte_bpe_50k.json")), tokenizer("byte_bpe_50k.json")),
    "unigram": lambda d: unigram.count_tokens(d, tokenizer("piece_bpe_32k.model")),
    "repeats": lambda d: repeats.removed(d),
    "jaccard": lambda d: jaccard.groups(d),
    "decontaminate": lambda d: decontaminate.hits(
        d, d.sparkSession.createDataFrame([(1, "a b"), (2, None), (2, "")], "item_id bigint, text string")
    ),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_comes_back_and_empty_tables_give_none(spark, name):
    found = OPERATORS[name](table(spark, EDGE)).select("doc_id").collect()
    assert Counter(r[0] for r in found) == Counter(i for i, _ in EDGE)
    assert OPERATORS[name](table(spark, [])).count() == 0


@pytest.mark.parametrize("key", list(ORACLE))
def test_queries_match_their_sql(spark, key):
    ok, message = compare(spark, key, SF0001, duck(SF0001))
    assert ok, message


def texts(rng, alphabet, n):
    base = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(10, 120))) for _ in range(8)]
    for i in range(n):
        yield i, "".join(rng.choice([rng.choice(base), rng.choice(alphabet) * 3]) for _ in range(rng.randrange(6)))


# ------------------------------------------------------------------ 1


@pytest.mark.parametrize("hashed", [exact_dedup.block_hash, lambda b: F.length(b).cast("long")])
def test_exact_dedup(spark, hashed):
    rows = list(texts(random.Random(1), "ab \n", 60)) + EDGE[:4]
    got = exact_dedup.groups(table(spark, rows), block_chars=7, hashed=hashed).collect()
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    by = defaultdict(list)
    for (i, _), t in zip(rows, norm, strict=True):
        by[t].append(i)
    want = Counter((i, min(by[t]), len(by[t]), hashlib.sha256(t.encode()).hexdigest()) for (i, _), t in zip(rows, norm, strict=True))
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == len(by)


# ------------------------------------------------------------------ 2

HOSTILE = ["", "<|im_end|>", "<|im_start|>user\n", "<\\|", "a<", "<|im_end|><|im_start|>assistant ok", "\n<\\\\|im_end|>"]


@pytest.mark.parametrize("role", ["user", "a%0Ab", "x\n<|im_start|>"])
def test_chat_round_trip(role):
    whole = ""
    for text in HOSTILE:
        out, start, stop = chat.rendered(role, text)
        assert chat.unescaped(out[start:stop]) == text
        whole += out
    assert [t[:2] for t in chat.parse(whole)] == [(role, t) for t in HOSTILE]


def test_chat_digests(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (2, None, None, "<|im_end|>"), (None, 0, "assistant", "c")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r.conv_id: r for r in chat.digests(chat.formatted(df)).collect()}
    assert got[1].turns_sha256 == hashlib.sha256(b"user\n\nassistant\nb\n").hexdigest()
    assert (got[1].n_turns, got[1].loss_chars, got[2].loss_chars, got[None].loss_chars) == (2, 1, 0, 1)


# ------------------------------------------------------------------ 3


def test_secret_scan(spark):
    rng = random.Random(2)
    words = ["password", "API-KEY", "apikey", "api_key", "ToKeN", "secret", "=", ": ", '"', "AKIA", "é", "deadbeef0123456789",
             "Ab1+/_.=-", "AKIAABCDEFGHIJKLMN", " "]
    rows = [(i, "".join(rng.choice(words) for _ in range(rng.randrange(30)))) for i in range(300)] + EDGE[:4]
    got = Counter((r.doc_id, tuple(map(tuple, r.spans))) for r in secrets.scan(table(spark, rows)).collect())
    assert got == Counter((i, tuple(secrets.reference_spans(t))) for i, t in rows)


def test_trigram_queries_hold_for_every_match():
    assert secrets.trigram_query(r"[0-9a-f]{16,}") is None
    query = secrets.trigram_query(secrets.RULES[0].pattern)
    for text in ("PASSWORD = x", "api_key:y", "ApiKey=z", "passwd=q", "secret:1", "token=2"):
        assert any(all(t in text.lower() for t in way) for way in query)


# ------------------------------------------------------------------ 4


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    network = language.trained(language.sample(docs.where(~out)))
    found = language.identify(docs.where(out), network).join(docs.select("doc_id", "lang"), "doc_id").where("lang is not null")
    rows = found.collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    odd = language.identify(spark.createDataFrame([(1, None), (2, "12 !"), (3, "")], "doc_id bigint, text string"), network)
    assert {(r.lang_pred, r.score) for r in odd.collect()} == {("und", 0.0)}


def test_language_learns_every_label(spark):
    """70 labels, each a pair of letters; the last ones are the rarest."""
    name = lambda k: chr(97 + k // 10) + chr(107 + k % 10)
    rows = [(100 * k + j, (name(k) + " ") * 40, name(k)) for k in range(70) for j in range(6 if k < 64 else 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    network = language.trained(language.sample(docs))
    right = language.identify(docs, network).join(docs.select("doc_id", "lang"), "doc_id").where("lang_pred = lang")
    rare = {name(k) for k in range(64, 70)}
    assert {r["lang"] for r in right.collect()} >= rare
    for total, each in ((140, 2), (10, 1)):
        assert Counter(r["lang"] for r in language.sample(docs, total=total)) == {name(k): each for k in range(70)}


# ------------------------------------------------------------------ 5


def test_warc_round_trip(spark):
    payloads = [None, "", "a", "a", "é" * 5000, "x" * 200_000, "\r\n\r\nWARC/1.1"]
    rows = [(10 - i, None if i % 2 else "http://a b\n/", p, "r") for i, p in enumerate(payloads)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, record string")
    manifest = warc.write(pages, size=1000)
    chunks = defaultdict(list)
    for r in warc.read(manifest, size=700).collect():
        chunks[r.page_id].append(r)
    first = {}
    for page_id, _, p, _ in sorted(rows):
        first.setdefault(p or "", page_id)
    for page_id, _, p, _ in rows:
        own = sorted(chunks[page_id], key=lambda r: r.chunk)
        kind = "response" if first[p or ""] == page_id else "revisit"
        assert own[-1].record_type == kind and own[-1].bytes == len((p or "").encode())
        assert own[-1].sha1 == warc.base32(hashlib.sha1((p or "").encode()).digest())
        assert own[-1].refers_to == (None if kind == "response" else first[p or ""])
        if kind == "response":
            assert b"".join(bytes(r.data) for r in own) == (p or "").encode()
    assert warc.read(warc.write(pages.limit(0))).count() == 0


def test_warc_is_read_in_ranges(spark, monkeypatch):
    """Many members of one archive are many tasks; whole files give the same."""
    monkeypatch.setattr(warc, "RANGE_BYTES", 2000)
    rng = random.Random(12)
    rows = [(i, None, "".join(chr(rng.randrange(32, 999)) for _ in range(rng.randrange(900)))) for i in range(80)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1)
    manifest = warc.write(pages, size=100)
    found = warc.read(manifest, size=64)
    assert manifest.select("file").distinct().count() < 9 and found.rdd.getNumPartitions() > 15
    whole = warc.read(manifest.select("file"), size=64)
    texts = defaultdict(bytes)
    for r in sorted(found.collect(), key=lambda r: (r.page_id, r.chunk)):
        texts[r.page_id] += bytes(r.data)
    assert texts == {i: t.encode() for i, _, t in rows}
    assert Counter(map(str, found.collect())) == Counter(map(str, whole.collect()))


def test_warc_folders_of_any_scheme():
    names = {
        "s3a://b/k": "s3://b/k", "s3n://b/k": "s3://b/k", "s3://b/k": "s3://b/k", "gs://b/k": "gs://b/k", "hdfs://n:8020/k": "hdfs://n:8020/k",
        "abfss://c@a.x/k": "abfss://c@a.x/k", "wasbs://c@a.x/k": "abfss://c@a.x/k", "wasb://c@a.x/k": "abfs://c@a.x/k",
        "file:/k/l": "file:///k/l", "file:///k": "file:///k", "/k/a:b": "/k/a:b",
    }
    assert {u: warc.arrow_uri(u) for u in names} == names
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        warc._file_system("oss://store/k")


def test_warc_payloads_are_cut_before_python_sees_them(spark):
    pages = spark.createDataFrame([(1, "é" * 700_000), (2, None)], "record bigint, payload string")
    chunks = warc.chunked(pages, 1000)
    plan = chunks._jdf.queryExecution().executedPlan().toString()
    assert plan.index("MapInArrow") < plan.index("Generate explode")
    rows = chunks.collect()
    assert max(len(r.data) for r in rows) == 1000 and [r.bytes for r in rows if r["last"]] == [1_400_000, 0]


# ------------------------------------------------------------------ 6, 7


def hostile_texts(seed):
    rng = random.Random(seed)
    letters = "ab 'sSt \x1c\x1f\x85 \n\r\té日本१२ⅷ😀́࢏0123<"
    for _ in range(1500):
        yield "".join(rng.choice([rng.choice(letters), rng.choice(letters), "<|endoftext|>", "'ll", "  ", "<0x0A>", chr(rng.randrange(32, 0x3000))])
                      for _ in range(rng.randrange(40)))


def test_bpe_equals_the_library():
    from tokenizers import Tokenizer

    path = tokenizer("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    with open(path, "rb") as f:
        own = bpe.Bpe(f.read(), *bpe.character_classes())
    for text in [*hostile_texts(3), "a" * 500 + " " * 99, "z" * 60 + "é" * 60]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.encode(text), "<u4").tolist() == ids
        assert own.decode(own.encode(text)) == library.decode(ids, skip_special_tokens=False)


def test_bpe_words_are_merged_once_whatever_follows_them(monkeypatch):
    """Also when the memory of pieces is full."""
    from tokenizers import Tokenizer

    monkeypatch.setattr(bpe, "MAX_PIECES", 1)
    path = tokenizer("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    with open(path, "rb") as f:
        own = bpe.Bpe(f.read(), *bpe.character_classes())
    done, merged = [], own.merged

    def spied(*args):
        done.append(1)
        return merged(*args)

    monkeypatch.setattr(own, "merged", spied)
    for text in ("x Thwhing", "x Thwhing, Thwhing. Thwhing", "x Thwhing.\nThe Thwhing"):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    once = len(done)
    own.encode("Thwhing,"), own.encode("x Thwhing%")
    done.clear()
    own.whole(" Thwhing")
    assert not done and once < 16
    for text in ("a ªº µß ÿ×÷ ĀāĂ naïve, naïve\x85 b", "a\u2003 b \u3000c", "a\n b", "a \nb", "a  b ", "a\x0b b"):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_bpe_merges_the_new_chunks_of_texts_together(monkeypatch):
    """Encoding finds the learned chunks; whatever is learned, the ids are the library's."""
    from tokenizers import Tokenizer

    path = tokenizer("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    with open(path, "rb") as f:
        own = bpe.Bpe(f.read(), *bpe.character_classes())
    done, merged = [], own.merged

    def spied(*args):
        done.append(1)
        return merged(*args)

    monkeypatch.setattr(own, "merged", spied)
    texts = ["x Thwhing, ndthreor.\nThe aaaaaaaaaaa 's 84.251.36.42 naïve, 日本१२ⅷ Ā 's't'll x\u2003y " + "z" * 60 + " end", *hostile_texts(5)]
    own.learn(texts[:1])
    assert not done and "z" * 60 not in own
    for chunk in texts[0].split(" ")[1:]:
        own.older.clear()
        want = library.encode(f" {chunk}", add_special_tokens=False).ids
        assert np.frombuffer(own[chunk], "<u4").tolist() == want
    assert len(done) <= 2  # only the long one, in its fragments
    for chunks, at_once in ((110_000, 8192), (50, 7), (1, 1)):
        monkeypatch.setattr(bpe, "MAX_CHUNKS", chunks)
        monkeypatch.setattr(bpe, "MERGED", at_once)
        own.clear(), own.older.clear(), own.known.clear()
        for rows in bpe.together(iter(enumerate(texts))):
            own.learn([t for _, t in rows])
            for _, text in rows:
                ids = library.encode(text, add_special_tokens=False).ids
                assert np.frombuffer(own.encode(text), "<u4").tolist() == ids
    own.learn([]), own.learn(["", " ", "  "])


def test_bpe_groups_hold_every_row(monkeypatch):
    monkeypatch.setattr(bpe, "TOGETHER", 5)
    rows = [(i, "ab" * (i % 4)) for i in range(20)]
    groups = list(bpe.together(iter(rows)))
    assert [r for g in groups for r in g] == rows and len(groups) > 5
    assert list(bpe.together(iter([]))) == []


def test_unigram_counts_equal_the_library():
    from tokenizers import Tokenizer, models, pre_tokenizers

    with open(tokenizer("piece_bpe_32k.model"), "rb") as f:
        pieces = unigram.vocabulary(f.read())
    library = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=True))
    library.pre_tokenizer = pre_tokenizers.Metaspace(replacement=unigram.SPACE, prepend_scheme="always", split=True)
    own = unigram.Counter(pieces)
    for text in hostile_texts(4):
        assert own.text(text)[0] == len(library.encode(text, add_special_tokens=False).ids)


# ------------------------------------------------ 4, 6, 7: the queries' columns


def rows_by_id(spark, key):
    return {r.doc_id: r for r in entry.queries()[key](spark, SF0001).collect()}


@pytest.fixture(scope="module")
def some_documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}


def test_language_query(spark, some_documents):
    import zlib

    got = rows_by_id(spark, "op4_language_id")
    assert got.keys() == some_documents.keys()
    labels = {d.lang for i, d in some_documents.items() if d.lang is not None and zlib.crc32(str(i).encode()) % 4 != 2}
    for i, r in got.items():
        text = some_documents[i].text
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        if any(c.isalpha() for c in text or ""):
            assert r.lang_pred in labels and 0 <= r.score <= 1
        else:
            assert (r.lang_pred, r.score) == ("und", 0.0)
    judged = [(some_documents[i].lang, r.lang_pred) for i, r in got.items() if r.held_out and r.lang_pred != "und"]
    assert np.mean([a == b for a, b in judged]) > 0.9


def test_bpe_query(spark, some_documents):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    library.no_truncation()
    library.no_padding()
    got = rows_by_id(spark, "op6_bpe")
    assert got.keys() == some_documents.keys()
    for i, r in got.items():
        ids = library.encode(some_documents[i].text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == want


def test_bpe_decodes_the_same_apart(spark):
    path = tokenizer("byte_bpe_50k.json")
    docs = table(spark, list(enumerate([None, *hostile_texts(8)][:300])))
    together = bpe.encode(docs, path, back=True).collect()
    apart = bpe.decode(bpe.encode(docs, path), path).collect()
    assert Counter(map(str, together)) == Counter(map(str, apart))


def test_unigram_query(spark, some_documents):
    from tokenizers import Tokenizer, models, pre_tokenizers

    with open(tokenizer("piece_bpe_32k.model"), "rb") as f:
        library = Tokenizer(models.Unigram(unigram.vocabulary(f.read()), unk_id=0, byte_fallback=True))
    library.pre_tokenizer = pre_tokenizers.Metaspace(replacement=unigram.SPACE, prepend_scheme="always", split=True)
    got = rows_by_id(spark, "op7_token_count")
    assert {i: r.n_tokens for i, r in got.items()} == {
        i: len(library.encode(d.text or "", add_special_tokens=False).ids) for i, d in some_documents.items()
    }


# ------------------------------------------------------------------ 8


def repeats_of(rows, size):
    """doc_id -> the bytes that remain."""
    data = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(b[k : k + size] for _, b in data for k in range(len(b) - size + 1))
    for i, b in data:
        gone, reach = bytearray(len(b)), 0
        for k in range(len(b) - size + 1):
            if count[b[k : k + size]] > 1:
                gone[max(k, reach) : k + size] = b"\1" * (k + size - max(k, reach))
                reach = k + size
        yield i, bytes(x for x, g in zip(b, gone, strict=True) if not g)


def passages(rng, n):
    """Texts of random words that share passages of about 400 bytes, some a byte
    shorter or longer, some within one text, some in a long run of one letter."""
    word = lambda: "".join(rng.choice("abcdefgé") for _ in range(rng.randrange(1, 9)))
    shared = [" ".join(word() for _ in range(120)).encode()[:k].decode(errors="ignore") for k in (380, 398, 399, 400, 401, 402, 460)]
    shared += ["z" * 420, "ab" * 260]
    for i in range(n):
        parts = [" ".join(word() for _ in range(rng.randrange(60))) for _ in range(3)]
        for p in rng.sample(shared, rng.randrange(3)):
            parts.insert(rng.randrange(3), p * rng.choice([1, 1, 2]))
        yield i, "|".join(parts)


@pytest.mark.parametrize("hot", [repeats.HOT, 3, 0])
@pytest.mark.parametrize("split", ["1g", "8k"])
def test_repeats_at_full_size(spark, tmp_path, hot, split):
    """400 bytes and 48, from files cut into few or many splits."""
    rows = [*passages(random.Random(11), 120), (900, None), (901, ""), (902, "x" * 399)]
    rows += rows[:3]
    path = str(tmp_path / "docs")
    table(spark, rows).repartition(3).write.option("parquet.block.size", 4096).parquet(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = repeats.removed(spark.read.parquet(path), hot=hot).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert Counter((r.doc_id, bytes(r.kept)) for r in got) == Counter(repeats_of(rows, 400))


@pytest.mark.parametrize("hot", [4096, 0])
def test_repeats(spark, hot):
    rows = [*texts(random.Random(5), "abé", 60), (90, None), (91, "a" * 60), (92, "")]
    data = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(b[k : k + 40] for _, b in data for k in range(len(b) - 39))
    want = {}
    for i, b in data:
        gone = {j for k in range(len(b) - 39) if count[b[k : k + 40]] > 1 for j in range(k, k + 40)}
        want[i] = bytes(x for j, x in enumerate(b) if j not in gone)
    got = repeats.removed(table(spark, rows), size=40, gram=8, hot=hot).collect()
    assert {r.doc_id: bytes(r.kept) for r in got} == want
    assert all(r.n_bytes - sum(s.stop - s.start for s in r.spans) == len(r.kept) for r in got)


# ------------------------------------------------------------------ 9


def linked(sets, percent=80):
    """Set by id -> the smallest id that links reach."""
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in sets.items():
        for j, b in sets.items():
            if j < i and a and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


@pytest.mark.parametrize("hot", [8192, 1])
@pytest.mark.parametrize("tile,seed", [(500_000, 21), (4000, 22), (300, 23)])
def test_jaccard_families(spark, monkeypatch, hot, tile, seed):
    """A third of all documents is one family whose members differ; others share
    its shingles and link with few or none. Sizes vary, copies repeat."""
    monkeypatch.setattr(jaccard, "HOT", hot)
    monkeypatch.setattr(jaccard, "HEAVY_COUNT", 2)
    rng = random.Random(seed)
    body = [f"b{k}" for k in range(100)]
    rows = []
    for i in range(240):
        if i % 3 == 0:
            own = body[: rng.randrange(85, 101)] + [f"x{i}_{k}" for k in range(rng.randrange(8))]
        elif i % 3 == 1:
            own = body[: rng.randrange(30, 90)] + [f"y{i // 9}_{k}" for k in range(rng.randrange(60))]
        else:
            own = [f"z{i // 12}_{k}" for k in range(rng.randrange(20, 30))] + [f"z{i}"] * (i % 2)
        rows.append((i, " ".join(own)))
    rows += [(1000 + i, t) for i, t in rows[:6]]
    got = jaccard.groups(table(spark, rows).repartition(5), words=1, tile=tile).collect()
    assert {r.doc_id: r.component_id for r in got} == linked({i: set(t.split()) for i, t in rows})


def test_a_family_is_not_compared_with_itself(spark, monkeypatch):
    """Tiles of a family meet the first tile only: texts grow with the family."""
    seen = []
    original = jaccard._products

    def spied(texts, *rest):
        seen.append(texts.count())
        return original(texts, *rest)

    monkeypatch.setattr(jaccard, "_products", spied)
    rows = [(i, " ".join([f"b{k}" for k in range(95)] + [f"x{i}"])) for i in range(400)]
    got = jaccard.groups(table(spark, rows), words=1, tile=1000).collect()
    assert {r.component_id for r in got} == {0}
    tiles = 400 * 96 // 1000 + 1
    assert seen[0] < 3 * 400 + tiles and seen[1:] == [0]


@pytest.mark.parametrize("few,tile", [(64, 1_200_000), (2, 300)])
def test_jaccard(spark, monkeypatch, few, tile):
    monkeypatch.setattr(jaccard, "FEW", few)
    rng = random.Random(6)
    rows = [(0, None), (1, ""), (2, "A b"), (3, "a B")]
    for _ in range(25):
        base = [f"w{rng.randrange(999)}" for _ in range(rng.randrange(3, 90))]
        for _ in range(rng.choice([1, 2, 9])):
            own = list(base)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(len(own))] = f"z{rng.randrange(999)}"
            rows.append((len(rows), " ".join(own[: rng.randrange(len(own) * 3 // 4, len(own) + 1)])))
    sets, root = {}, {}
    for i, t in rows:
        w = (t or "").lower().split()
        sets[i], root[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set(), i

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in sets.items():
        for j, b in sets.items():
            if j < i and a and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    got = jaccard.groups(table(spark, rows), tile=tile).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("size", [70, 60])
def test_jaccard_of_texts_that_are_mostly_a_body_of_many(spark, size):
    """Two of ``size`` texts share 8 words besides the body, which alone links none."""
    body, both = [f"b{k}" for k in range(87)], [f"s{k}" for k in range(8)]
    own = [[f"o{i}_{k}" for k in range(13)] for i in range(size)]
    own[5], own[41] = own[5][8:] + both, own[41][8:] + both
    rows = [(i, " ".join(body + own[i])) for i in range(size)]
    sets = [set(t.split()) for _, t in rows]
    links = [(i, j) for i in range(size) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    assert links == [(41, 5)]
    got = jaccard.groups(table(spark, rows), words=1).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: 5 if i == 41 else i for i in range(size)}


def test_pairs_of_near_copies_are_not_counted(spark, monkeypatch):
    """Of 40 near copies (780 pairs) rows are handed on, and 20 more without doc_id
    leave no gap between them."""
    handed = []
    original = jaccard.map_arrow

    def spied(df, run, schema, **options):
        handed.append((schema, original(df, run, schema, **options)))
        return handed[-1][1]

    monkeypatch.setattr(jaccard, "map_arrow", spied)
    rows = []
    for i in range(60):
        own = [f"b{k}" for k in range(200)]
        own[3 * i] = f"x{i}"
        rows.append((None if i % 3 == 1 else i, " ".join(own)))
    got = jaccard.groups(table(spark, rows)).collect()
    assert Counter((r.doc_id, r.component_id) for r in got) == Counter((i, None if i is None else 0) for i, _ in rows)
    edges = [df for schema, df in handed if schema == jaccard.EDGE]
    assert len(edges) == 1 and edges[0].count() < 4 * len(rows)


@pytest.mark.parametrize("name", ["groups", "dedup"])
def test_shuffle_files_go_with_the_step_that_wrote_them(spark, name):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {name for name in blocks.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in name}

    before = files()
    setting = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    rows = [(i, " ".join([f"b{k}" for k in range(95)] + [f"x{i}"])) for i in range(40)]
    found = getattr(jaccard, name)(table(spark, rows).coalesce(1), words=1)
    end = time.time() + 20
    while files() - before and time.time() < end:
        time.sleep(0.2)
    assert not files() - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting
    assert {r["doc_id"] if name == "dedup" else r["component_id"] for r in found.collect()} == {0}


def test_near_dedup_goes_by_rows(spark):
    """Near copies (of 30 words one differs) with null, repeated and mixed ids."""
    near = lambda kind, k: " ".join([f"{kind}{j}" for j in range(29)] + [f"{kind}_own{k}"])
    rows = [
        (None, near("a", 0)), (None, near("a", 1)),  # one of two without id stays
        (None, near("b", 0)), (9, near("b", 1)), (8, near("b", 2)),  # 8 stays
        (5, near("c", 0)), (5, near("d", 0)), (4, near("d", 1)),  # both groups keep one: c's 5 and d's 4
        (6, near("e", 0)), (6, near("e", 1)),  # one of two of the same id stays
        (None, None), (None, ""), (7, " "),  # nothing to compare
    ]
    kept = jaccard.dedup(table(spark, rows).coalesce(1)).select("doc_id", "text").collect()
    want = [rows[k] for k in (0, 4, 5, 7, 8, 10, 11, 12)]
    assert Counter(map(tuple, kept)) == Counter(want)


@pytest.mark.parametrize("edges", [[], [(2, 1), (3, 1), (3, 1), (9, 9)], [(i, i + 1) for i in range(40)], [(5, 4), (4, 9), (9, 1), (7, 6)]])
def test_components(spark, edges):
    root = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in root:
        for x, y in edges:
            if x != y:
                root[x] = root[y] = min(root[x], root[y])
    found = jaccard.components(spark.createDataFrame(edges, "x bigint, y bigint"), "test").collect()
    assert sorted(map(tuple, found)) == sorted((x, y) for x, y in root.items() if x != y)


# ------------------------------------------------------------------ 10


def hits(docs, items, window):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    phrases = [(i, tuple(w[k : k + window])) for i, t in items if (w := words(t)) for k in range(max(1, len(w) - window + 1))]
    for doc_id, t in docs:
        w = words(t)
        hit, found = set(), set()
        for i, p in phrases:
            for k in range(len(w) - len(p) + 1):
                if tuple(w[k : k + len(p)]) == p:
                    found.add(i)
                    hit.update(range(k, k + len(p)))
        yield doc_id, len(w), len(hit), sorted(found)


@pytest.mark.parametrize("block", [20_000, 2])
def test_decontamination(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", block)
    rng = random.Random(7)
    make = lambda n: "".join(rng.choice(["a", "B", "é", "d9"]) + rng.choice([" ", "-"]) for _ in range(rng.randrange(n)))
    items = [(i, make(8)) for i in range(5)]
    docs = [(i, make(30)) for i in range(40)] + [(90, None), (91, "")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.judged(decontaminate.hits(table(spark, docs), benchmark, window=3)).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found) == sorted(hits(docs, items, 3))


@pytest.mark.parametrize("block", [20_000, 1])
def test_decontamination_by_items_without_id(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", block)
    items = [(3, "a b c d"), (-2, "b c d"), (None, "a b c x"), (None, "e f g")]
    docs = [(1, "a b c"), (2, "b c d e f g"), (3, "e f g"), (4, "b c")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.judged(decontaminate.hits(table(spark, docs), benchmark, window=3)).collect()
    want = [(1, 3, [3, None], True), (2, 6, [-2, 3, None], True), (3, 3, [None], True), (4, 0, [], False)]
    assert sorted((r.doc_id, r.n_hit, r["items"], r.contaminated) for r in found) == want


# ------------------------------------------------------------------ pipeline


def shingles_of(text, size=5):
    """Words lower-cased in ASCII; a shorter text is one shingle."""
    words = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", words)
    return {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()


def test_pipeline_against_the_stages_by_hand(spark):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    left = [i for i, t in sorted(rows.items()) if t and any(c.isalpha() for c in t)]
    norm = {}
    for i in left:
        norm.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", rows[i]), i)
    kept = docs.where(F.col("doc_id").isin(list(norm.values())))
    near = {i for i, r in linked({r.doc_id: shingles_of(r.text) for r in kept.collect()}).items() if i == r}
    benchmark = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()]
    want = {i for i, n, hit, _ in hits([(i, rows[i]) for i in near], benchmark, 13) if not hit or 20 * hit < n}
    got = pipeline.run(spark, SF0001)
    assert {r.doc_id for r in got.collect()} == want
    for name, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF0001).columns == docs.columns, name


@pytest.mark.parametrize("doc_id,lang", [(1, None), (None, "en")])
def test_pipeline_keeps_clean_documents_without_labels(spark, doc_id, lang):
    import corpus_pipeline as pipeline

    texts = ["clean words", "12 !", None, "", "é"]
    docs = spark.createDataFrame([(doc_id, t, lang) for t in texts], "doc_id bigint, text string, lang string")
    got = pipeline.language_id(spark, docs, SF0001)
    assert got.columns == docs.columns
    assert sorted(r.text for r in got.collect()) == ["clean words", "é"]


def test_registration():
    names = list(entry.queries())
    assert [n for n in names if n.startswith("op")] and "pipeline" in names
