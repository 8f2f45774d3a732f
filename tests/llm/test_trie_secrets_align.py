"""Prefix trie, secret scan and token alignment against brute force and on awkward inputs."""

from __future__ import annotations

import hashlib
import math
import random
import string
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barloom.llm import prefix_trie, queries, secret_scan, token_align

CONV = "conv_id long, turn long, role string, text string"


# ---- 11 trie -----------------------------------------------------------------------------------------------------

def brute_trie(rows, shared):
    """Nodes of all prefixes, by plain sets."""
    by = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            by[c].append((t is not None, t or 0, r or "", x or ""))
    seq = {c: [e[2:] for e in sorted(v)] for c, v in by.items()}
    if shared:
        head = {c: zlib.crc32(str(c).encode()) % 6 for c in seq}
        seq = {c: seq.get(c - int(math.fmod(c, 100)), [])[:head[c]] + s[head[c]:] for c, s in seq.items()}
    members, ends, below = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, s in seq.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
            if d:
                below[tuple(s[:d - 1])].add(tuple(s[:d]))
        ends[tuple(s)].append(c)
    leaves, saved, out = {}, {}, []
    for v in sorted(members, key=len, reverse=True):
        leaves[v] = sum(leaves[x] for x in below[v]) or 1
        saved[v] = sum(saved[x] for x in below[v]) + ((len(members[v]) - 1) * len(v[-1][1]) if v else 0)
        out.append((min(members[v]), len(v), min(members[v[:-1]]) if v else None, len(members[v]), len(below[v]), leaves[v],
                    saved[v], hashlib.sha256(",".join(map(str, sorted(ends[v]))).encode()).hexdigest()))
    return Counter(out)


def digested(trie):
    return (trie.nodes.join(prefix_trie.joined_sha256(trie.ends), "node", "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))


@pytest.fixture(scope="module")
def talks():
    """Shared beginnings, many equal conversations, ties, nulls, repeated rows, turnless conversations."""
    rng = random.Random(5)
    rows = []
    for c in [*range(14), 100, 101, 150, 200, 205, 303, -5, 777]:
        for t in range(rng.choice([1, 2, 3, 5, 8, 9, 12])):
            rows.append((c, rng.choice([t, t, None]), rng.choice(["user", None]), rng.choice(["a", "bé", "ccc", None])))
        if c % 3 == 0:
            rows.append(rows[-1])
    rows += [(c, t, "u", f"same{t}") for c in range(400, 425) for t in range(11)]
    return [*rows, (None, 1, "u", "x"), (1000, None, None, None)]


@pytest.mark.parametrize("band, room, shared", [(64, 4096, True), (2, 3, True), (3, 1, False), (1, 1, True)])
def test_trie_against_all_prefixes(spark, talks, band, room, shared):
    df = spark.createDataFrame(talks, CONV).repartition(3)
    trie = prefix_trie.prefix_trie(df.withColumns({"rn": F.lit(1), "conv": F.lit("x"), "blk": F.lit(0)}),
                                   share=(100, 6) if shared else None, band=band, room=room)
    assert Counter(map(tuple, digested(trie).collect())) == brute_trie(talks, shared)


def test_trie_long_conversations_over_bands(spark, monkeypatch):
    """Copies and near copies of a conversation of many bands, with ranges and carried heads."""
    monkeypatch.setattr(prefix_trie, "GROUP_BANDS", 3)
    monkeypatch.setattr(prefix_trie, "LIST_IDS", 2)
    monkeypatch.setattr(prefix_trie, "BROADCAST_HEADS", 0)
    lengths = {1: 90, 2: 90, 3: 90, 4: 45, 5: 46, 6: 90, 7: 4, 8: 8}
    rows = [(c, t, "u", f"t{t}" if c != 6 or t < 70 else f"other{t}") for c, n in lengths.items() for t in range(n)]
    trie = prefix_trie.prefix_trie(spark.createDataFrame(rows, CONV), band=4, room=2)
    assert Counter(map(tuple, digested(trie).collect())) == brute_trie(rows, False)


def test_trie_empty_and_query(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], CONV)).nodes.count() == 0
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op11_prefix_trie(spark, "/root/testdata/sf0.01")
    assert Counter(map(tuple, got.collect())) == brute_trie(rows, True)


# ---- 12 secrets --------------------------------------------------------------------------------------------------

def brute_base(text):
    """The pattern rules by their definition: greedy scanning by hand."""
    out, low = [], text.lower() if text.isascii() else "".join(c.lower() if c.isascii() else c for c in text)
    value = set(string.ascii_letters + string.digits + "+/_.=-")
    i = 0
    while i < len(text):
        word = next((w for w in ("password", "passwd", "secret", "token", "api_key", "apikey") if low.startswith(w, i)), None)
        if word:
            best = None
            j = i + len(word)
            for quote in ((j + 1, j) if text[j:j + 1] in ("'", '"') and text[j:j + 1] else (j,)):
                k = quote
                while text[k:k + 1] == " ":
                    k += 1
                if text[k:k + 1] in (":", "=") and text[k:k + 1]:
                    k += 1
                    while text[k:k + 1] == " ":
                        k += 1
                    k += text[k:k + 1] in ("'", '"') and bool(text[k:k + 1])
                    e = k
                    while e < len(text) and text[e] in value:
                        e += 1
                    if e > k:
                        best = (k, e)
                        break
            if best:
                if best[1] - best[0] >= 6:
                    out.append((i, 0, best[1]))
                i = best[1]
                continue
        i += 1
    for start, chars, least, kind in (("AKIA", string.ascii_uppercase + string.digits, 20, 1), ("", "0123456789abcdef", 24, 2)):
        i = 0
        while i < len(text):
            e = i + len(start)
            if text.startswith(start, i):
                while e < len(text) and text[e] in chars:
                    e += 1
                if e > i + len(start):
                    if e - i >= least:
                        out.append((i, kind, e))
                    i = e
                    continue
            i += 1
    return sorted(out)


PARTS = st.sampled_from(["token", "TOKEN", "Api_Key", "apikey", "secret=", "passwd", " ", "  ", "=", ":", '"', "'", "AKIA", "AKIAAKIA",
                         "ABCDEFGH12345678", "deadbeef", "0123456789abcdef01234567", "x.y", "é", "ſecret=abcdefgh", "\n", "abc"])


@settings(max_examples=400, deadline=None)
@given(st.lists(PARTS, max_size=14).map("".join))
def test_rule_spans_against_scanning(text):
    assert secret_scan.rule_spans(text) == brute_base(text)


def brute_windows(s, window, least):
    """Entropy of every window from scratch."""
    hit = [False] * len(s)
    for lo in range(len(s) - window + 1):
        w = s[lo:lo + window]
        bits = -sum(n / window * math.log2(n / window) for n in Counter(w).values())
        digit, lower, upper = (any(c in x for c in w) for x in (string.digits, string.ascii_lowercase, string.ascii_uppercase))
        sign = any(not c.isalnum() for c in w)
        if not (lower or upper) or (sign and not (digit and lower and upper)):
            continue
        kind = ("base64" if sign else ("two_case" if lower and upper else "one_case") if not digit else
                "alnum" if (lower and upper) or any(c.lower() > "f" for c in w if c.isalpha()) else "hex")
        if bits >= least[kind] - 1e-9:
            hit[lo:lo + window] = [True] * window
    return hit


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10 ** 6), st.integers(4, 20))
def test_entropy_windows_against_recounting(seed, window):
    rng = random.Random(seed)
    sets = ["0123456789abcdef", "0123456789ABCDEF", string.ascii_letters, string.ascii_letters + string.digits + "+/=_-", "aab1", "abcdefgh"]
    s = "".join("".join(rng.choices(rng.choice(sets), k=rng.randrange(30))) for _ in range(4))
    least = {k: v * math.log2(window) / math.log2(20) for k, v in secret_scan.LEAST_BITS.items()}
    got = [False] * len(s)
    for lo, hi in secret_scan.window_spans(s, window, least):
        got[lo:hi] = [True] * (hi - lo)
    assert got == brute_windows(s, window, least)


def test_entropy_finds_keys_and_lets_others_be():
    scan = secret_scan.Scanner()
    rng = random.Random(2)
    for chars in (string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/", "0123456789ABCDEF",
                  string.ascii_lowercase + string.digits):
        keys = ["".join(rng.choices(chars, k=40)) for _ in range(100)]
        assert sum(any(k == 3 for _, k, _ in scan.spans(f"the key {x} here")) for x in keys) >= 98
    for text in ("123e4567-e89b-12d3-a456-426614174000", "2024-01-31T12_00-00Z and 12345678901234567890123456",
                 "abcdefghijklmnopqrstuvwxyz0123456789", "sha256-Zm9vYmFyYmF6cXV4MTIzNDU2Nzg5MA", "my-very-long-file-name-with-words_2023",
                 "Donaudampfschifffahrtsgesellschaft", "key=EXAMPLE9aB3dE5fG7hJ8kL0", "a" * 300, "=" * 80, "x1" * 40):
        assert not [s for s in scan.spans(text) if s[1] == 3], text
    key = "".join(rng.choices(string.ascii_letters + string.digits, k=40))
    assert scan.spans(f"token={key}") == [(0, 0, 46)]  # lies in a span of another rule
    assert secret_scan.Scanner(allow=[".*"]).spans(key + " token=abcdef") == [(41, 0, 53)]


def test_find_secrets_awkward(spark):
    long = "wort " * 200_000 + "token: 0123456789abcdef01234567 é"
    rows = [(1, None, 1), (2, "", 1), (2, "", 1), (None, "passwd=abcdef", 0), (4, "é password = 'abc' secret:abcdef token=abc", 2), (5, long, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    out = secret_scan.find_secrets(df, keep_cols=["doc_id", "spans"], redacted=True)
    assert out.columns == ["doc_id", "spans", "spans_", "redacted"]
    got = sorted(out.select("doc_id", secret_scan.listed(F.col("spans_")), "redacted").collect(), key=str)
    assert [(r[0], r[1]) for r in got] == [
        (1, ""), (2, ""), (2, ""), (4, "assign:19:32"), (5, f"assign:1000000:1000031,hex:1000007:1000031"), (None, "assign:0:13")]
    assert got[0][2] is None and got[3][2] == "é password = 'abc' [SECRET] token=abc" and got[4][2].endswith("wort [SECRET] é")
    assert secret_scan.find_secrets(df.limit(0)).count() == 0


def test_secret_query(spark):
    got = {r["doc_id"]: r for r in queries.op12_secret_scan(spark, "/root/testdata/sf0.01").collect()}
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for d, text in rows:
        base = brute_base(text or "")
        said = ",".join(f"{secret_scan.KINDS[k]}:{lo}:{hi}" for lo, k, hi in base)
        r = got[d]
        assert r["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == i for _, k, _ in base) for i in range(3)]
        assert set(filter(None, said.split(","))) <= set(r["spans"].split(","))


# ---- 13 alignment ------------------------------------------------------------------------------------------------

A_PATH, B_PATH = (public_tokenizers.path(p) for p in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def brute_align(rows):
    """Per row, by the library's tokenizers and all pairs of tokens."""
    a, b = token_align.ByteSide(A_PATH), token_align.PieceSide(B_PATH)
    a.fast = None
    per, docs = [], Counter()
    for d, x in rows:
        sides = []
        for s in (a, b):
            ids, at = s.encode([x])[0] if x else [], 0
            spans = []
            for i in ids:
                spans.append((i, at, at + len(s.bytes[i])))
                at += len(s.bytes[i])
            sides.append(spans if x and b"".join(s.bytes[i] for i in ids) == b" " + x.encode() else None)
        ta, tb = sides if None not in sides else ([], [])
        links = [(p[0], q[0]) for p in ta for q in tb if p[1] < q[2] and q[1] < p[2]]
        groups, lo = [], 0
        for e in sorted({p[2] for p in ta} & {q[2] for q in tb}):
            groups.append(([p[0] for p in ta if lo <= p[1] and p[2] <= e], [q[0] for q in tb if lo <= q[1] and q[2] <= e]))
            lo = e
        per.append((d, len(ta), len(tb), groups, links))
        docs.update(set(links))
    best = defaultdict(int)
    for (i, _), n in docs.items():
        best[i] = max(best[i], n)
    return [(d, na, nb, len(g), len(l), sum(docs[x] == best[x[0]] for x in l), sum(docs[x] for x in l), g) for d, na, nb, g, l in per]


@pytest.fixture(scope="module")
def mixed():
    rng = random.Random(8)
    pool = ["the", " Haus", "naïve", "日本語", "🙂🙂", "▁", "x1y2", "  ", "\n\n", "\t", "don't", "<|endoftext|>", "</s>", "<0x41>", "é", "ﬁ", "\x00",
            "Ünï", "cœur", "1234567", "!!!", "​", "　", "\xa0"]
    texts = [None, "", " ", "a", *("".join(rng.choices(pool, k=rng.randrange(1, 25))) for _ in range(60)), *(["the same text"] * 5)]
    return [(i if i % 9 else None, t) for i, t in enumerate(texts)]


def test_align_against_all_pairs(spark, mixed, monkeypatch):
    monkeypatch.setattr(token_align, "CHUNK_BYTES", 400)  # in this process only: the tasks keep theirs
    df = spark.createDataFrame([(*r, 1, "x", None) for r in mixed], "doc_id long, text string, id int, chunk string, pairs string").repartition(4)
    want = brute_align(mixed)
    got = token_align.align(df, A_PATH, B_PATH).collect()
    plain = [(*r[:7], [(list(g["a"]), list(g["b"])) for g in r[7]]) for r in map(tuple, got)]
    assert sorted(plain, key=str) == sorted(want, key=str)
    said = [(*r[:7], hashlib.sha256(";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in r[7]).encode()).hexdigest()
             if r[1] else "") for r in want]
    digests = token_align.align(df, A_PATH, B_PATH, lists=False).collect()
    assert sorted(map(tuple, digests), key=str) == sorted(said, key=str)
    assert any(r[1] == 0 and t and "▁" in t for r, (_, t) in zip(want, mixed))  # a piece mark in the text is no space


def test_align_long_text_and_empty(spark):
    text = "ein langer Text, who would read it all? " * 40_000
    df = spark.createDataFrame([(1, text), (2, "ein langer Text")], "doc_id long, text string")
    r = {x["doc_id"]: x for x in token_align.align(df, A_PATH, B_PATH, lists=False).collect()}
    assert r[1]["n_a"] > 300_000 and r[1]["n_links"] >= max(r[1]["n_a"], r[1]["n_b"]) and r[2]["n_best"] <= r[2]["n_links"]
    assert token_align.align(df.limit(0), A_PATH, B_PATH).count() == 0


def test_rank_table_equals_library():
    side = token_align.ByteSide(A_PATH)
    assert side.fast is not None
    rng = random.Random(4)
    texts = ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x2FF), rng.randrange(0x300, 0xD7FF), 0x1F600, 10, 32, 39]))
                     for _ in range(rng.randrange(60))) for _ in range(3000)]
    fast, side.fast = side.encode(texts), None
    assert fast == side.encode(texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=12), st.lists(st.integers(1, 4), min_size=1, max_size=12))
def test_overlaps_of_two_cuts(a, b):
    """merge_asof in both directions gives exactly the overlapping pairs."""
    import numpy as np

    short, long = sorted((a, b), key=sum)
    short[-1] += sum(long) - sum(short)
    sizes = np.arange(64)
    x, y = (token_align.Side([c], [0], sizes) for c in (a, b))
    i, j = token_align.overlaps(x, y)
    want = {(p, q) for p in range(len(a)) for q in range(len(b)) if x.start[p] < y.end[q] and y.start[q] < x.end[p]}
    assert len(i) == len(want) and set(zip(i.tolist(), j.tolist())) == want
