"""The pipeline stage by stage against brute force, and as a whole."""

from __future__ import annotations

import sys
from collections import Counter

import brute
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of every stage on the small documents plus awkward ones."""
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(10**6, None, None, None, None), (10**6 + 1, "", "en", "src0", 0), (None, "w " * 3, "en", "src1", 6)], docs.schema)
    cur, out = docs.unionByName(extra).cache(), []
    for name, f in P.STAGES:
        new = f(spark, cur, SF).cache()
        out.append((name, cur.collect(), new.collect(), cur.columns, new.columns))
        cur = new
    return out


def test_names_and_columns(stages):
    assert [s[0] for s in stages] == ["quality rules", "line dedup", "simhash near-dedup", "mix sources", "best-fit packing"]
    for s in stages[:-1]:
        assert s[3] == s[4] == ["doc_id", "text", "lang", "source", "n_chars"]


def test_quality_stage(stages):
    _, before, after, *_ = stages[0]
    kept = {r["doc_id"] for r in after}
    for r in before:
        n, _, _, _, rep = brute.quality(r["text"])
        if n < 20 or 100 * rep > 30 * n:
            assert r["doc_id"] not in kept
        elif rep == 0:
            assert r["doc_id"] in kept


def test_line_stage(stages):
    import corpus_pipeline as P

    _, before, after, *_ = stages[1]
    per, hosts = Counter(), Counter(r["source"] for r in before)
    for r in before:
        per.update({(r["source"], x.strip(" ")) for x in r["text"].split("\n") if x.strip(" ")})
    bad = {k for k, n in per.items() if n >= 3 and n > P.LINE_RATIO * hosts[k[0]]}
    want = {r["doc_id"]: "\n".join(x for x in r["text"].split("\n") if (r["source"], x.strip(" ")) not in bad) for r in before}
    assert {r["doc_id"]: r["text"] for r in after} == want
    assert all(r["n_chars"] == len(r["text"]) for r in after)


def test_line_stage_cuts_lines_shared_by_under_a_tenth(spark):
    import corpus_pipeline as P

    rows = [(i, f"own {i}" + "\nshared" * (i < 8) + "\nrare" * (i < 4), "en", "src", None) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r["text"] for r in P.line_dedup(spark, docs, SF).collect()}
    assert got == {i: f"own {i}" + "\nrare" * (i < 4) for i in range(100)}


def test_dedup_stage(stages):
    _, before, after, *_ = stages[2]
    items = [(r["doc_id"], brute.simhash(r["text"])) for r in before]
    want = set(brute.components(items, lambda a, b: (a ^ b).bit_count() <= 4))
    assert sorted(r["doc_id"] for r in after) == sorted(want)


def test_mix_and_pack_stages(stages):
    from test_llm_ops import fill_targets
    _, before, after, *_ = stages[3]
    size = lambda rows: Counter({s: sum(len(brute.words(r["text"])) for r in rows if r["source"] == s) for s in {r["source"] for r in rows}})
    have, got = size(before), size(after)
    for s, t in fill_targets(dict(have)).items():
        assert got[s] == pytest.approx(t, abs=1)
    _, before, after, *_ = stages[4]
    assert sum(r["size"] for r in after) == sum(len(brute.words(r["text"])) for r in before)
    source = {r["doc_id"]: r["source"] for r in before}
    bins = {}
    for r in after:
        bins.setdefault(r["bin_id"], []).append(r)
    for b in bins.values():
        assert sum(r["size"] for r in b) <= 2048
        assert len({r["doc_id"] for r in b}) == len({source[r["doc_id"]] for r in b}) == len(b)


def test_stages_on_empty_tables_and_other_columns(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, f in P.STAGES:
        assert f(spark, docs.limit(0), SF).count() == 0
    more = docs.where("doc_id <= 60").selectExpr("*", "1 AS fp", "2 AS k1", "3 AS quality", "4 AS size", "5 AS bin_id", "6 AS n_words",
                                                 "7 AS root", "8 AS host", "9 AS taken", "10 AS line")
    long = spark.createDataFrame([(10**7, "\n".join(f"word{i} own{i * 7 % 50021}" for i in range(60_000)), "en", "src0", None)] * 2, docs.schema)
    more = more.unionByName(long, allowMissingColumns=True)
    for name, f in P.STAGES[:-1]:
        out = f(spark, more, SF).cache()
        assert out.columns == more.columns and out.count() > 0, name
        assert out.where("doc_id <= 60 AND (fp <> 1 OR root <> 7 OR line <> 10)").count() == 0
        assert out.where("doc_id > 60").count() >= 1
        if name == "simhash near-dedup":
            assert out.where("doc_id > 60").count() == 1
    packed = P.pack_bins(spark, more, SF)
    assert packed.where("doc_id > 60").agg(F.sum("size")).first()[0] == 2 * 120_000


def test_run_writes_every_stage(spark):
    import corpus_pipeline as P

    out = P.run(spark, SF)
    assert out.count() > 0 and P.ORACLE_SQL is None
    assert out.where(F.col("size") > 2048).count() == 0


def test_rest_of_the_library_does_not_import_llm():
    import subprocess

    code = ("import sys; sys.modules['barloom.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; "
            "names = e.queries(); assert 'pipeline' not in names and len(names) > 200, len(names)")
    root = next(p for p in sys.path if p.endswith("/repo") or p == "")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root or None)
