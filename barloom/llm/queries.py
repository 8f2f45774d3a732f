"""Registered queries of the training-data operators and their DuckDB SQL.

``SPARK`` and ``SQL`` map query names to callables and oracle texts.  Operators
that SQL cannot express are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import (chat_repair, mixing, packing, pivot_search, prefix_trie, repetition, secret_scan, simhash_pivots,
                         site_lines, token_align, token_orc, toxicity, window_dedup)
from barloom.llm.common import scratch_path, staged

TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER, PIECE_TOKENIZER = "byte_bpe_50k.json", "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "tokens")
    token_orc.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER))
    return token_orc.read_tokens(spark, path)


def op2_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = staged(table(spark, sf_dir, "pages").select(  # the texts are read several times: strip the markup once
        "page_id", site_lines.url_host("url").alias("host"), site_lines.html_lines("html").alias("text")), "pages")
    out = site_lines.drop_site_lines(pages, "host", "text", ["page_id"])
    return out.select("page_id", "host", "n_lines", "n_removed", F.md5(F.coalesce("text", F.lit(""))).alias("kept_md5"))


def op3_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = repetition.quality(table(spark, sf_dir, "documents"), keep_cols=["doc_id"])
    return q.select("doc_id", "quality.*")


def op4_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", mixing.n_words("text").alias("n_words"), F.xxhash64("text").alias("cluster"))
    return packing.pack(docs, "n_words", "source", "cluster")


def op5_pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", pivot_search.grid_vector("embedding").alias("v"))
    return pivot_search.top_k(rows, rows.where(F.col("vec_id") % 50 == 0), k=5)


def hex_word(c: str) -> Column:
    """A long as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(F.col(c)), 16, "0"))


def op6_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash_pivots.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, limit=4)
    return got.select("doc_id", hex_word("fp").alias("fingerprint"), "component_id")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return (toxicity.score(docs, model, ["doc_id"])
            .select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score",
                    F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted")))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_dedup.drop_repeats(table(spark, sf_dir, "documents"), width=35)


def op10_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_repair.repair(table(spark, sf_dir, "conversations"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    trie = prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"), share=(100, 6))
    none = F.sha2(F.lit(""), 256)
    return (trie.nodes.join(prefix_trie.joined_sha256(trie.ends), "node", "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", none).alias("ends_sha256")))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "entropy")
    return found.select("doc_id", *[secret_scan.count_kind(F.col("spans"), k).alias(f"n_{k}") for k in secret_scan.KINDS],
                        F.sha2(secret_scan.listed(base), 256).alias("base_sha256"), secret_scan.listed(F.col("spans")).alias("spans"))


def op13_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    got = token_align.align(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_TOKENIZER),
                            public_tokenizers.path(PIECE_TOKENIZER), lists=False)
    return got.withColumnRenamed("groups", "groups_sha256")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


SPARK = {f.__name__: f for f in (
    op1_token_orc, op2_site_lines, op3_suffix_repeats, op4_best_fit, op5_pivot_top_k, op6_simhash_pivots, op7_toxicity,
    op8_mix_sources, op9_window_dedup, op10_chat_repair, op11_prefix_trie, op12_secret_scan, op13_token_align, pipeline)}

OP2_SQL = r"""
WITH t AS (
  SELECT page_id, lower(regexp_extract(url, '://([^/:?#]+)', 1)) AS host,
    regexp_replace(regexp_replace(regexp_replace(html,
      '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->|<!doctype[^>]*>', chr(10), 'g'),
      '(?i)</?(p|div|li|ul|ol|h1|h2|h3|h4|h5|h6|br|tr|td|th|table|nav|article|section|header|footer|aside|main|title|head|body|html|blockquote|pre|form|meta|link)(\s[^>]*)?/?>', chr(10), 'g'),
      '<[^>]*>', '', 'g') AS text
  FROM pages),
l AS (SELECT page_id, host, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM t),
h AS (SELECT host, count(*) AS host_pages FROM t GROUP BY host),
f AS (SELECT host, trim(line) AS line, count(DISTINCT page_id) AS n FROM l WHERE trim(line) <> '' GROUP BY host, trim(line)),
b AS (SELECT f.host, f.line FROM f JOIN h USING (host) WHERE n >= 3 AND n > 0.1 * host_pages),
k AS (SELECT l.*, b.line IS NOT NULL AS cut FROM l LEFT JOIN b ON b.host = l.host AND b.line = trim(l.line))
SELECT page_id, any_value(host) AS host, count(*) FILTER (WHERE trim(line) <> '') AS n_lines,
  count(*) FILTER (WHERE cut) AS n_removed,
  md5(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT cut), '')) AS kept_md5
FROM k GROUP BY page_id
"""

OP5_SQL = """
WITH v AS (SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

OP8_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
             CAST('0x' || substr(md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS key FROM documents),
p AS (SELECT source, sum(size) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight, 2.0::DOUBLE * source_size AS cap FROM p),
o AS (SELECT *, 1.5::DOUBLE * sum(source_size) OVER () AS total,
        coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
        sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
        row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS place FROM w),
c AS (SELECT arg_min((total - before) / rest, place) AS level FROM o WHERE (total - before) / rest * weight <= cap),
t AS (SELECT o.source, source_size, least(coalesce(level * weight, cap), cap) AS target FROM o, c),
x AS (SELECT d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
        sum(d.size) OVER (PARTITION BY d.source ORDER BY key, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS start
      FROM d JOIN t ON t.source IS NOT DISTINCT FROM d.source),
e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(budget / source_size) AS BIGINT) ELSE 0 END AS epochs FROM x)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
  CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - start)) AS BIGINT) AS taken FROM e
"""

SQL = {"op2_site_lines": OP2_SQL, "op5_pivot_top_k": OP5_SQL, "op8_mix_sources": OP8_SQL}
