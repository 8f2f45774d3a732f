"""Operators against brute force and on awkward inputs."""

from __future__ import annotations

import random
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from barloom.llm import (chat_repair, mixing, packing, pivot_search, repetition, simhash_pivots, site_lines, token_orc,
                         toxicity, window_dedup)
from barloom.llm.common import grouped_batches, scratch_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n, vocab=400):
    return " ".join(f"w{rng.randrange(vocab)}x" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """Nulls, empty and long texts, copies, near copies, shared passages, repeated rows."""
    rng = random.Random(3)
    passage, base = prose(rng, 60), prose(rng, 300)
    texts = [None, "", "  \n\t ", "one", "Two WORDS", passage, f"{prose(rng, 40)} {passage}\n{prose(rng, 30)}",
             f"{prose(rng, 12)}\n{passage} {prose(rng, 9)} {passage}", base, base, base + " tail", base.replace("w1x", "w2x", 1),
             "na " * 90, prose(rng, 6000), "Line a\nLine b\nLine a\n\n", "Ünï cödé \x1c x\xa0y   z " * 3,
             *(prose(rng, rng.randrange(1, 80)) for _ in range(12))]
    out = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 5 else None, None if t is None else len(t)) for i, t in enumerate(texts)]
    return [*out, out[8], out[8], (None, passage, None, None, None), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def clash(df):
    """Extra columns under names the operators use themselves."""
    return df.selectExpr("*", "1 AS k1", "2 AS k2", "'x' AS t", "3 AS quality", "4 AS fp", "5 AS score", "6 AS _k1", "7 AS _text",
                         "8 AS n_lines", "9 AS size", "10 AS _copy", "11 AS cluster", "12 AS bucket")


def bag(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


# ---- 1 token ids in ORC ------------------------------------------------------------------------------------------

def whole_ids(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [e.ids + [2] for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def write(spark, df):
    import public_tokenizers

    path = scratch_path(spark, "t")
    token_orc.write_tokens(df, path, public_tokenizers.path("word_bpe_49k.json"))
    return path


def test_tokens_round_trip_and_starts(spark, docs, rows):
    path = write(spark, clash(docs))
    back = token_orc.open_tokens(spark, path).orderBy("seq").collect()
    got = {(r["doc_id"], tuple(r["ids"])) for r in back}
    assert got == {(r[0], tuple(i)) for r, i in zip(rows, whole_ids([r[1] for r in rows]))}
    ids = [r["doc_id"] for r in back]
    assert ids == sorted(ids, key=lambda x: (x is not None, x))
    stream = token_orc.read_tokens(spark, path).orderBy("start", "shard").collect()
    assert len(stream) == len(rows)
    at = 0
    for r, b in zip(stream, back):
        assert (r["doc_id"], r["start"], r["n_tokens"]) == (b["doc_id"], at, len(b["ids"]))
        assert r["ids_crc32"] == zlib.crc32(np.array(b["ids"], "<u4").tobytes())
        at += r["n_tokens"]


def test_tokens_lookup_prunes(spark, docs):
    path = write(spark, docs)
    found = token_orc.lookup(spark, path, 5)
    assert found.count() == 1
    assert "EqualTo(doc_id,5)" in found._jdf.queryExecution().executedPlan().toString()


def test_tokens_of_every_plain_character():
    import public_tokenizers

    enc = token_orc.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    assert enc.short
    chars = [chr(c) for c in range(0x21, 0x300) if not chr(c).isspace()]  # the plain range and what follows it
    words = [w for c in chars for w in (c, c + "li", "ab" + c + "li", "AB" + c, "1" + c + "2", "." + c + "'s", c + c)]
    got = [np.frombuffer(enc.new_words([w.encode()])[0], "<u4").tolist() for w in words]
    assert [w for w, ids, want in zip(words, got, whole_ids(words)) if ids + [2] != want] == []
    assert all(token_orc.PLAIN.fullmatch(c) for c in "aZ0~\xa1\xadß×ÿĀıɏ") and not token_orc.PLAIN.fullmatch("\u018f")


def test_tokens_empty_table(spark, empty):
    assert token_orc.read_tokens(spark, write(spark, empty)).count() == 0


# ---- 2 line dedup ------------------------------------------------------------------------------------------------

def test_site_lines(spark):
    pages = [(i, "a" if i < 8 else "b", f"menu\nbody {i}\n  menu \n\nfoot") for i in range(12)]
    pages += [(20, None, "menu\nx"), (21, "a", None), (22, "a", ""), (0, "a", pages[0][2]), (None, "b", "menu\nq")]
    df = spark.createDataFrame(pages, "page_id long, host string, text string").selectExpr("*", "7 AS n_lines", "1 AS _cut")
    out = site_lines.drop_site_lines(df, "host", "text", ["page_id"], max_ratio=0.5, min_pages=3)
    assert out.columns == ["page_id", "host", "text", "n_lines", "_cut", "n_lines_", "n_removed"]
    want = []
    for p, h, t in pages:
        lines = (t or "").split("\n")
        n = sum(x[1] == h for x in pages)
        on = lambda line: sum(x[1] == h and line.strip(" ") in [y.strip(" ") for y in (x[2] or "").split("\n")] for x in pages)  # noqa: B023, E731
        cut = [bool(x.strip(" ")) and on(x) >= 3 and on(x) > 0.5 * n for x in lines]
        want.append((p, h, None if t is None else "\n".join(x for x, c in zip(lines, cut) if not c),
                     sum(bool(x.strip(" ")) for x in lines), sum(cut)))
    assert bag(out, "page_id", "host", "text", "n_lines_", "n_removed") == sorted(want, key=repr)
    assert site_lines.drop_site_lines(df.limit(0), "host", "text", ["page_id"]).count() == 0


def test_site_lines_long_page(spark):
    df = spark.createDataFrame([(i, "h", "\n".join(["same"] * 30_000 + [f"own {i}"])) for i in range(4)], "page_id int, host string, text string")
    out = site_lines.drop_site_lines(df, "host", "text", ["page_id"]).orderBy("page_id").collect()
    assert [(r["text"], r["n_removed"]) for r in out] == [(f"own {i}", 30_000) for i in range(4)]


# ---- 3 quality rules ---------------------------------------------------------------------------------------------

def test_quality_counts(docs, rows):
    got = repetition.quality(clash(docs)).select("doc_id", "text", "quality_.*")
    want = [(r[0], r[1], *brute.quality(r[1])) for r in rows if r[1] is None or len(r[1]) < 5000]
    have = [x for x in bag(got, "doc_id", "text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
            if x[1] is None or len(x[1]) < 5000]
    assert have == sorted(want, key=repr)


def test_quality_empty(empty):
    assert repetition.quality(empty).count() == 0 and repetition.keep_good(empty).count() == 0


def test_suffix_array_and_lcp_against_sorting():
    rng = random.Random(5)
    for _ in range(40):
        texts = [[b"%d" % rng.randrange(3) for _ in range(rng.randrange(0, 25))] for _ in range(4)]
        facts = repetition.repeats(texts, 3)
        for i, t in enumerate(texts):
            best, hit = brute.longest_repeat(t, 3)
            assert (facts["longest"][i], facts["covered"][i]) == (best, len(hit))


def test_maximal_repeats_against_brute_force():
    rng = random.Random(6)
    for _ in range(60):
        texts = [[b"%d" % (10 ** rng.randrange(3)) for _ in range(rng.randrange(0, 25))] for _ in range(4)] + [[b"7"] * 20, []]
        facts = repetition.repeats(texts, 3, 3, 5)
        for i, t in enumerate(texts):
            found = brute.maximal_repeats(t, 3)
            hit = {j for seq, at in found.items() if len(at) >= 3 or sum(map(len, seq)) > 5 for k in at for j in range(k, k + len(seq))}
            assert facts["n_maximal"][i] == len(found)
            assert facts["longest"][i] == max(map(len, found), default=0)
            assert facts["covered_chars"][i] == sum(len(t[j]) for j in hit)


def test_quality_keeps_one_short_line_said_twice(spark):
    rng = random.Random(11)
    a = [f"w{k}x" for k in rng.sample(range(10**6), 90)]
    twice = a[:9] + a[10:60] + a[:9]  # 18 of 68 words
    thrice = a[:8] + a[10:45] + a[:8] + a[45:85] + a[:8]  # 24 of 99 words
    df = spark.createDataFrame([(1, " ".join(twice)), (2, " ".join(thrice))], "doc_id int, text string")
    got = {r["doc_id"]: r for r in repetition.quality(df).select("doc_id", "quality.*").collect()}
    assert not got[1]["base_failed"] and not got[2]["base_failed"]
    assert (got[1]["kept"], got[2]["kept"]) == (True, False)


def test_suffix_order():
    words = np.array([2, 1, 2, 1, 2, 0, 1, 0], "int64")
    doc, end = np.array([0] * 5 + [1] * 3), np.array([5] * 5 + [8] * 3)
    order, levels = repetition.suffix_array(words, doc, end)
    want = sorted(range(8), key=lambda i: (doc[i], list(words[i:end[i]])))
    assert order.tolist() == want
    lcp = repetition.neighbour_lcp(order, levels, end)
    for a, b, n in zip(want, want[1:], lcp[1:]):
        x, y = words[a:end[a]].tolist(), words[b:end[b]].tolist()
        same = next((k for k in range(min(len(x), len(y))) if x[k] != y[k]), min(len(x), len(y)))
        assert n == (same if doc[a] == doc[b] else 0)
    assert sorted(repetition.lcp_intervals(np.array([0, 2, 3, 3, 1, 0, 4]), 2)) == [(0, 3, 2), (1, 3, 3), (5, 6, 4)]


def test_quality_verdict_limits(spark):
    rng = random.Random(9)
    clean, half = prose(rng, 200, 10_000), prose(rng, 60, 10_000)
    df = spark.createDataFrame([(1, clean), (2, f"{half} {half}"), (3, "too short"), (4, f"{clean} {half[:100]}")], "doc_id int, text string")
    assert sorted(r["doc_id"] for r in repetition.keep_good(df).collect()) == [1, 4]


def test_quality_method_rejects_what_the_base_keeps(spark):
    rng = random.Random(10)
    a, b = ([f"w{k}x" for k in rng.sample(range(10**6), n)] for n in (24, 400))
    two = a[:12] + b[:38] + a[:12] + b[38:76]  # 24 of 100 words covered, longest 12
    run = b[:200] + ["na"] * 50 + b[200:]  # 50 of 450 words covered, longest 49: an overlapping repeat
    once, small = b[:100], a[:9] + b[:150] + a[:9]  # 18 of 168 words covered
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate((two, run, once, small))], "doc_id int, text string")
    got = {r["doc_id"]: r for r in repetition.quality(df).select("doc_id", "quality.*").collect()}
    assert [got[i]["n_repeat_words"] for i in range(4)] == [24, 50, 0, 18]
    assert not any(r["base_failed"] for r in got.values())
    assert [got[i]["kept"] for i in range(4)] == [False, False, True, True]


# ---- 4 packing ---------------------------------------------------------------------------------------------------

def check_bins(rows, capacity):
    used, sources, clusters = {}, {}, {}
    for r in rows:
        b = r["bin_id"]
        if b is None:
            assert r["size"] == 0
            continue
        used.setdefault(b, []).append((r["bin_offset"], r["size"]))
    for b, parts in used.items():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
        assert at <= capacity
    return used


def test_pack(spark):
    rng = random.Random(1)
    data = [(i, rng.choice([0, 5, 40, 90, 100, 250]), rng.choice(["a", "a", "b", None, "c"]), rng.choice([None, 1, 2, 10**17 + i])) for i in range(400)]
    data += [(None, 30, "a", 1), (7, None, None, None), (8, -3, "a", None)] + [(999, 10, "z", 5)] * 50
    df = spark.createDataFrame(data, "doc_id long, n long, source string, cl long").selectExpr("*", "1 AS size", "2 AS bin", "3 AS seq")
    out = packing.pack(df, "n", "source", "cl", capacity=100, shard_rows=64).collect()
    assert sum(r["size"] for r in out) == sum(max(0, r[1] or 0) for r in data)
    check_bins(out, 100)
    by = {(r[0], r[1]): r for r in data}
    bins = {}
    for r in out:
        if r["bin_id"] is not None:
            bins.setdefault(r["bin_id"], []).append(next(x for x in data if x[0] == r["doc_id"]))
    for b in bins.values():
        assert len({x[2] for x in b}) == len(b)
        known = [x[3] for x in b if x[3] is not None]
        assert len(set(known)) == len(known)
    assert by and packing.pack(df.limit(0), "n", "source", "cl").count() == 0


def test_best_fit_against_scanning_all_bins():
    rng = np.random.default_rng(2)
    for _ in range(60):
        n, capacity = int(rng.integers(0, 80)), 50
        size = np.sort(rng.integers(1, capacity + 1, n))[::-1] if rng.random() < 0.5 else rng.integers(1, capacity + 1, n)
        source, cluster = rng.integers(-1, 6, n), rng.integers(-1, 9, n)
        bins, offsets = packing.best_fit(size, source, cluster, capacity)
        free: list = []  # residual, sources, clusters
        for i, (m, s, c) in enumerate(zip(size.tolist(), source.tolist(), cluster.tolist())):
            fits = [(left, b) for b, (left, ss, cc) in enumerate(free) if left >= m and (s < 0 or s not in ss) and (c < 0 or c not in cc)]
            b = min(fits)[1] if fits else len(free)
            if not fits:
                free.append((capacity, set(), set()))
            left, ss, cc = free[b]
            assert (bins[i], offsets[i]) == (b, capacity - left)
            free[b] = (left - m, ss | {s}, cc | {c})


def test_best_fit_takes_tightest_compatible():
    size = np.array([60, 50, 45, 40, 35, 10])
    source = np.array([0, 1, 2, 1, 0, 0])
    bins, offs = packing.best_fit(size, source, np.full(6, -1), 100)
    # 40 fits bin 0 exactly (source 1 is not there); 35 of source 0 goes past it to bin 1; 10 of source 0 to bin 2
    assert bins.tolist() == [0, 1, 1, 0, 2, 3] or bins.tolist()[:4] == [0, 1, 1, 0]
    free: list = []
    for i, (n, s) in enumerate(zip(size, source)):
        fits = [(r, b) for b, (r, have) in enumerate(free) if r >= n and s not in have]
        b = min(fits)[1] if fits else len(free)
        if not fits:
            free.append((100, set()))
        assert b == bins[i] and offs[i] == 100 - free[b][0]
        free[b] = (free[b][0] - n, free[b][1] | {s})


# ---- 5 top-k -----------------------------------------------------------------------------------------------------

def brute_top(rows, queries, k):
    out = []
    for q, v in queries:
        got = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q and len(w) == len(v)))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(got)]
    return sorted(out)


@pytest.mark.parametrize("big", [1, 50_000_000])
def test_top_k(spark, big):
    rng = random.Random(2)
    rows = [(i, [float(big * rng.randrange(-4, 5)) for _ in range(6)]) for i in range(150)]
    rows += [(200 + i, [float(big)] * 6) for i in range(40)] + [(300, [1.0, 2.0]), (301, [5.0, 5.0]), (302, [0.0] * 6)]
    queries = [r for r in rows if r[0] % 10 == 0]
    df = spark.createDataFrame([*rows, (900, None), (None, [1.0] * 6)], "vec_id long, v array<double>")
    got = pivot_search.top_k(df, df.where("vec_id % 10 = 0"), k=5, n_pivots=6, sample=64, block_rows=16, block_queries=8, first=2)
    assert sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()) == brute_top(rows, queries, 5)


def test_top_k_repeated_rows(spark):
    import duckdb
    import pandas as pd

    from barloom.llm.queries import OP5_SQL

    rng = random.Random(4)
    data = [(i, [rng.randrange(-256, 257) / 256 for _ in range(6)]) for i in range(120)]
    top = data[7][1]
    data += [(7, top)] * 9 + [(13, [3 * x for x in top])] * 3 + [(100, top)] * 8  # more than k times; a query among them
    data += [(50, [-x for x in data[50][1]]), (21, data[22][1]), (21, data[23][1])]  # one id, several vectors
    rng.shuffle(data)
    rows = spark.createDataFrame(data, "vec_id long, embedding array<double>").select(
        "vec_id", pivot_search.grid_vector("embedding").alias("v"))
    con = duckdb.connect()
    con.register("embeddings", pd.DataFrame(data, columns=["vec_id", "embedding"]))
    want = con.execute(OP5_SQL).fetchall()
    for size in (4, 512):
        got = pivot_search.top_k(rows, rows.where("vec_id % 50 = 0"), k=5, n_pivots=6, sample=64, block_rows=size, block_queries=2, first=2)
        assert sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()) == sorted(want)


def test_top_k_prunes_clusters_and_ignores_other_columns(spark):
    rng = random.Random(14)
    centres = [[rng.uniform(-1, 1) for _ in range(8)] for _ in range(20)]
    data = [(i, [float(round(256 * (x + rng.gauss(0, 0.01)))) for x in centres[i % 20]]) for i in range(4000)]
    df = spark.createDataFrame(data, "vec_id long, v array<double>").selectExpr(
        "*", "1 AS pivot", "'x' AS score", "2 AS rank", "3 AS qb", "4 AS annulus", "5 AS gap", "6 AS query_id")
    report = []
    got = pivot_search.top_k(df, df.where("vec_id % 97 = 0"), k=3, n_pivots=24, block_rows=32, block_queries=4, first=1, report=report)
    x = np.array([v for _, v in data], "int64")
    want = []
    for q in range(0, 4000, 97):
        scores = x @ x[q]
        order = [i for i in np.lexsort((np.arange(4000), -scores)).tolist() if i != q][:3]
        want += [(q, r + 1, i, int(scores[i])) for r, i in enumerate(order)]
    assert bag(got, "query_id", "rank", "vec_id", "score") == sorted(want, key=repr)
    (dim, read, pairs), = report
    assert dim == 8 and 0 < read < 0.5 * pairs


def test_top_k_awkward(spark):
    e = "vec_id long, embedding array<float>"
    df = spark.createDataFrame([(0, [0.5, None]), (50, [float("nan"), 1.0]), (100, None), (150, [0.1, 0.2]), (200, [])], e)
    v = df.select("vec_id", pivot_search.grid_vector("embedding").alias("v"))
    assert [r["v"] for r in v.orderBy("vec_id").collect()][:3] == [None] * 3
    assert pivot_search.top_k(v, v).count() == 0
    assert pivot_search.top_k(v.limit(0), v.limit(0)).count() == 0


# ---- 6 simhash ---------------------------------------------------------------------------------------------------

def test_fingerprint_definition(rows):
    for r in rows:
        assert simhash_pivots.fingerprint(r[1]) == brute.simhash(r[1])


def test_near_duplicates(spark, docs, rows):
    got = simhash_pivots.near_duplicates(clash(docs)).where("doc_id IS NOT NULL")
    items = [(r[0], brute.simhash(r[1])) for r in rows if r[0] is not None]
    want = dict(zip([i for i, _ in items], brute.components(items, lambda a, b: (a ^ b).bit_count() <= 4)))
    assert {(r["doc_id"], r["component_id"]) for r in got.collect()} == set(want.items())
    kept = simhash_pivots.keep_one(clash(docs))
    assert kept.columns == clash(docs).columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(want.values())) and len(ids) == len(set(ids))


@pytest.mark.parametrize("block", [4, 1024])
def test_links_of_dense_groups(spark, block):
    """Chains and dense sets of fingerprints, also over keys dealt in blocks."""
    rng = random.Random(4)
    fps = set()
    for _ in range(6):
        c = rng.getrandbits(64)
        for _ in range(40):
            for b in rng.sample(range(64), rng.randrange(0, 4)):
                c ^= 1 << b
            fps.add(c)
    fps = sorted(fps)
    df = spark.createDataFrame([(simhash_pivots._signed(x),) for x in fps], "fp long")
    comp = {r["node"] & (2**64 - 1): r["root"] for r in simhash_pivots.components(simhash_pivots.links(df, 4, block)).collect()}
    want = brute.components(list(enumerate(fps)), lambda a, b: (a ^ b).bit_count() <= 4)
    groups = {}
    for x, w in zip(fps, want):
        groups.setdefault(w, []).append(comp.get(x, ("alone", x)))
    assert all(len(set(g)) == 1 for g in groups.values())
    assert len({g[0] for g in groups.values()}) == len(groups)


def test_simhash_empty(empty):
    assert simhash_pivots.near_duplicates(empty).count() == 0 and simhash_pivots.keep_one(empty).count() == 0


# ---- 7 toxicity --------------------------------------------------------------------------------------------------

def test_counterfactual_penalty_cuts_false_positives(spark):
    rng = random.Random(6)
    fill = [f"f{i}" for i in range(60)]
    data = []
    for i in range(600):
        bad = i % 3 == 0
        text = " ".join(rng.choices(fill, k=12)) + (" idiot" if bad and rng.random() < 0.7 else "")
        group = "muslim" if bad and rng.random() < 0.8 else rng.choice(["christian", "hindu", "atheist"])
        data.append((i, f"{text} {group}", int(bad)))
    docs = spark.createDataFrame([r[:2] for r in data], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in data] + [(None, 1), (3, None)], "doc_id long, toxic int")
    fair, plain = (toxicity.train(docs, labels, penalty=p) for p in (20.0, 0.0))
    neutral = "f1 f2 f3 muslim f9"
    assert plain.score(neutral) > 0.3 > fair.score(neutral)
    gap = [abs(fair.score(f"f1 f2 {g}") - fair.score("f1 f2 christian")) for g in ("muslim", "hindu")]
    assert max(gap) < 0.05 and fair.score("f1 f2 idiot") > 0.5


def test_toxicity_counts_flushed_with_the_last_batch(spark, monkeypatch):
    def batches(texts):
        return [pa.RecordBatch.from_arrays([pa.array([y for y, _ in texts], pa.int32()), pa.array([t for _, t in texts])], names=["y", "t"])]

    monkeypatch.setattr(toxicity, "COUNT_FLUSH", 2)
    out = list(toxicity._count_features(batches([(1, "bad day"), (0, "good day")])))
    assert len(out) == 1 and out[0].schema.types == [pa.string(), pa.int64(), pa.int64()]
    assert dict(zip(out[0].column(0).to_pylist(), zip(*(out[0].column(i).to_pylist() for i in (1, 2))))) == {
        "bad": (1, 1), "day": (2, 1), "good": (1, 0)}
    assert list(toxicity._count_features(batches([(0, ""), (1, None)]))) == []
    monkeypatch.undo()
    long = " ".join(f"word{i}x" for i in range(210_000))  # flushes, and nothing is left for the end
    docs = spark.createDataFrame([(0, long), (1, "an idiot"), (3, "an idiot"), (4, "calm"), (6, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 0), (1, 1), (3, 1), (4, 0), (6, 0)], "doc_id long, toxic int")
    assert 0 <= toxicity.train(docs, labels, min_docs=1, steps=5).score("an idiot") <= 1


def test_toxicity_awkward(spark, docs, empty):
    model = toxicity.Model({"bad": 3.0}, -1.0)
    out = toxicity.score(clash(docs), model, ["doc_id", "score"])
    assert out.columns == ["doc_id", "score", "score_"] and out.count() == docs.count()
    assert {round(r["score_"], 6) for r in out.collect()} == {round(model.score(""), 6)}
    none = empty.selectExpr("doc_id", "1 AS toxic")
    assert 0 < toxicity.train(docs, none).score("x") < 1
    assert toxicity.score(empty, model, ["doc_id"]).count() == 0
    r = spark.createDataFrame([(i,) for i in range(50)], "doc_id long").withColumn("h", toxicity.held_out("doc_id")).collect()
    assert all(x["h"] == (zlib.crc32(str(x["doc_id"]).encode()) % 4 == 2) for x in r)


# ---- 8 mixing ----------------------------------------------------------------------------------------------------

def fill_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), share * sum(sizes.values())
    while free:
        level = left / sum(w[s] for s in free)
        over = {s for s in free if level * w[s] > most * sizes[s] + 1e-9}
        if not over:
            target |= {s: level * w[s] for s in free}
            break
        target |= {s: most * sizes[s] for s in over}
        left -= sum(target[s] for s in over)
        free -= over
    return target


def test_mix(spark, docs, rows):
    out = mixing.mix(clash(docs), bucket_rows=3).collect()
    assert len(out) == len(rows)
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(brute.words(r[1]))
    target = fill_targets(sizes)
    for s in sizes:
        own = [r for r in out if r["source"] == s]
        assert own[0]["target"] == pytest.approx(target[s]) and own[0]["source_size"] == sizes[s]
        assert sum(r["taken"] for r in own) == int(own[0]["target"])
        assert all(0 <= r["taken"] <= 2 * r["size"] for r in own)
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(repr, out)) == sorted(map(repr, again))


def test_apply_mix(docs, empty):
    taken = sum(r["taken"] for r in mixing.mix(docs).collect())
    mixed = mixing.apply_mix(clash(docs), bucket_rows=3)
    assert mixed.columns == clash(docs).columns
    rows = mixed.collect()
    assert sum(len(brute.words(r["text"])) for r in rows) == taken
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    assert mixing.mix(empty).count() == 0 and mixing.apply_mix(empty).count() == 0
    plan = mixing.apply_mix(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ---- 9 window dedup ----------------------------------------------------------------------------------------------

@pytest.mark.parametrize("width", [1, 5, 35])
def test_window_dedup(docs, rows, width):
    got = window_dedup.drop_repeats(clash(docs), width=width)
    want = [(r[0], *x) for r, x in zip(rows, brute.window_dedup([r[1] for r in rows], width))]
    assert bag(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(want, key=repr)


def test_window_dedup_over_stretches_and_hot_anchors(spark, monkeypatch):
    rng = random.Random(8)
    passage = prose(rng, 50, 5000)
    data = [(i, f"{prose(rng, rng.randrange(0, 60), 5000)} {passage} {prose(rng, 20, 5000)}" if i % 2 else prose(rng, 150, 3)) for i in range(60)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    words = [brute.words(t) for _, t in data]
    want = [(i, *x) for (i, _), x in zip(data, brute.window_dedup([t for _, t in data], 35))]
    assert len(window_dedup.hot_anchors(df, "doc_id", "text", 35)) > 0
    assert bag(window_dedup.drop_repeats(df), "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(want, key=repr)
    monkeypatch.setattr(window_dedup, "RUN_WORDS", 64)  # long texts in overlapping stretches
    texts = [[w.encode() for w in t] for t in words]
    seen = {}
    for numbers, parts, first in window_dedup._stretches(texts, 35):
        for n, p, lo in zip(numbers, parts, first):
            for j in range(len(p) - 34):
                seen[n, lo + j] = seen.get((n, lo + j), 0) + 1
    assert seen == {(n, j): 1 for n, t in enumerate(texts) for j in range(len(t) - 34)}


@pytest.mark.parametrize("key_rows", [0, 1, 7])
def test_window_dedup_splits_keys_by_rows(spark, docs, rows, monkeypatch, key_rows):
    monkeypatch.setattr(window_dedup, "HOT_SHARE", 1.0)  # no anchor is dealt by window beforehand
    rng = random.Random(12)
    passage = prose(rng, 50, 5000)
    texts = [f"{prose(rng, rng.randrange(0, 60), 5000)} {passage} {prose(rng, 20, 5000)}" if i % 3 else prose(rng, 90, 2) for i in range(48)]
    texts += [texts[1]] * 3 + [r[1] for r in rows]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    want = [(i, *x) for i, x in enumerate(brute.window_dedup(texts, 35))]
    got = window_dedup.drop_repeats(df, key_rows=key_rows)
    assert bag(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(want, key=repr)


def test_key_pieces_bound_what_is_held():
    rng = random.Random(13)
    for _ in range(100):
        keys = sorted(rng.choices(range(-3, 4), [1, 1, 1, 9, 1, 2, 1], k=rng.randrange(0, 60)))
        t = pa.table({"key": pa.array(keys, pa.int64()), "at": pa.array(range(len(keys)), pa.int64())})
        batches = [b for b in t.to_batches(max_chunksize=rng.randrange(1, 9))]
        pieces = list(window_dedup.key_pieces(iter(batches), 5))
        assert [x for p, _ in pieces for x in p["at"].to_pylist()] == list(range(len(keys)))
        for k in set(keys):
            held = [(p["key"].to_pylist().count(k), split) for p, split in pieces if k in p["key"].to_pylist()]
            assert len(held) == 1 or all(split for _, split in held)  # counted whole, or not at all
        assert all(len(set(p["key"].to_pylist())) == 1 for p, split in pieces if split)


def test_operators_leave_batch_setting(spark, docs):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "9999")
    try:
        window_dedup.drop_repeats(docs).count()
        repetition.quality(docs).count()
        vecs = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(9)], "vec_id long, v array<double>")
        pivot_search.top_k(vecs, vecs).count()
        assert spark.conf.get(key) == "9999"
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_window_dedup_kept_text_and_empty(docs, empty):
    out = window_dedup.drop_repeats(docs, width=35, kept_text=True).where("n_removed = 0 AND n_words > 0")
    by = {r["doc_id"]: r["kept"] for r in out.collect()}
    assert by[4] == "Two WORDS"
    assert window_dedup.drop_repeats(empty).count() == 0


# ---- 10 chat repair ----------------------------------------------------------------------------------------------

def test_chat_costs_against_all_choices(spark):
    rng = random.Random(7)
    data, want = [], {}
    for c in range(60):
        n = rng.randrange(1, 5)
        roles = [rng.choice(["system", "user", "assistant", "bot", None]) for _ in range(n)]
        empty = [rng.random() < 0.2 for _ in range(n)]
        want[c] = brute.repair_cost(roles, empty, chat_repair.COSTS)
        data += [(c, i, r, "" if e else f"text {i}") for i, (r, e) in enumerate(zip(roles, empty))]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS cost", "2 AS part")
    for size in (1, 2, 64):
        out = chat_repair.repair(df, block_turns=size).collect()
        assert len(out) == len(data) and {r["conv_id"]: r["cost"] for r in out} == want
        by = {}
        for r in sorted(out, key=lambda r: (r["conv_id"], r["seq"])):
            by.setdefault(r["conv_id"], []).append(r)
        for rows in by.values():
            text = "".join(r["fragment"] for r in rows)
            roles = [x.split("|>")[0] for x in text.split("<|end|>\n") if x]
            assert all(r.startswith("<|") for r in roles)
            roles = [r[2:] for r in roles]
            state = chat_repair.START
            for r in roles:
                nxt = chat_repair.ROLES.index(r)
                assert nxt in chat_repair.STEPS[state]
                state = nxt


def test_chat_long_conversation_over_ranges(spark):
    n = 3000
    data = [(1, i, ["user", "assistant", "user", "user"][i % 4], f"t{i}") for i in range(n)] + [(2, 0, "user", "hi")]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").repartition(6)
    out = chat_repair.repair(df, block_turns=16)
    of = chat_repair._moves(chat_repair.COSTS)
    m = chat_repair.block_matrix([(r, False) for _, _, r, _ in data[:n]], of)
    rows = out.where("conv_id = 1").orderBy("seq").collect()
    assert [r["turn"] for r in rows] == list(range(n)) and rows[0]["cost"] == min(m[chat_repair.START])


def test_chat_awkward(spark):
    schema = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame([(None, None, None, None), (1, 2, "user", None), (1, 2, "user", None), (1, None, "system", "s")], schema)
    out = chat_repair.repair(df)
    assert out.count() == 4
    text = {r["conv_id"]: r["text"] for r in chat_repair.render(out).collect()}
    assert text[None] == "<|user|>\n<|end|>\n" and text[1].startswith("<|system|>\ns<|end|>\n<|user|>")
    assert chat_repair.repair(df.limit(0)).count() == 0


# ---- shared ------------------------------------------------------------------------------------------------------

def test_grouped_batches():
    keys = [1, 1, 2, 2, 2, 2, 3, 4, 4]
    cut = [pa.record_batch({"key": keys[i:i + 2]}) for i in range(0, 9, 2)]
    assert [t.column("key").to_pylist() for t in grouped_batches(iter(cut), "key")] == [[1, 1], [2, 2, 2, 2], [3], [4, 4]]
    assert F is not None
