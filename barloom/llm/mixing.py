"""Mixing sources to target weights, in DataFrame operations alone.

Every document gets a hash-random key; inside its source, documents are ordered
by key, and distributed prefix sums of their sizes cut the order at the source's
exact budget.  A budget above the source's size repeats whole epochs first.

The prefix sums have three levels: equal ranges of the key space are buckets of about
``bucket_rows`` documents of the largest source, as many neighbouring buckets as
their root make a group; group sums are chained per source, bucket sums per group,
and a window inside each bucket adds the rest.  A source with a third of all rows is
many buckets, never one window, and the chain over its groups grows with the root.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import content_key, free_name, staged

#: Word rule shared by the sizes.
WORDS = r"[^\x20\x09-\x0D]+"

#: Bits of the random key.
KEY_BITS = 60


def n_words(text: str) -> Column:
    """Words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("long")


def random_key(id_col: str, seed: str) -> Column:
    """60 hash bits of the id as a long (a null id counts as the empty text)."""
    text = F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 10).cast("long")


def source_targets(per_source: DataFrame, weights: list[int], share: float, most: float) -> DataFrame:
    """(source, source_size, target, budget) from (source, source_size).

    Sources by code point, null last, weigh ``weights`` in turn and share
    ``share`` of all sizes; none gets above ``most`` times its size, the excess is
    shared anew by weight.  With sources ordered by cap per weight, the first k
    are capped and the others get ``(total - caps of those k) / (weights of the rest)``
    per weight, for the smallest k at which nobody else exceeds its cap.  The
    windows run over one row per source.
    """
    place = Window.orderBy(F.isnull("source"), "source")
    each = (per_source
            .withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]),
                                               ((F.row_number().over(place) - 1) % len(weights)) + 1).cast("long"))
            .withColumn("cap", F.lit(float(most)) * F.col("source_size")))
    everyone = Window.partitionBy()
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.isnull("source"), "source")
    upto = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    each = (each
            .withColumn("total", F.lit(float(share)) * F.sum("source_size").over(everyone))
            .withColumn("before", F.coalesce(F.sum("cap").over(upto), F.lit(0.0)))
            .withColumn("rest", F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(upto), F.lit(0)))
            # this source's share if all before it, and none from it on, are capped
            .withColumn("level", (F.col("total") - F.col("before")) / F.col("rest"))
            .withColumn("fits", F.col("level") * F.col("weight") <= F.col("cap")))
    level = F.min(F.when(F.col("fits"), F.struct(F.col("cap") / F.col("weight"), F.isnull("source"), "source", "level"))).over(everyone)["level"]
    target = F.least(F.coalesce(level * F.col("weight"), F.col("cap")), F.col("cap"))
    return (each.withColumn("target", target)
            .withColumn("budget", F.floor("target").cast("long"))
            .select("source", "source_size", "target", "budget"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: str = "mix",
        bucket_rows: int = 128) -> DataFrame:
    """Per row: doc_id, source, size, source_size, target, taken, epochs, part and the row's content key.

    ``taken`` words = ``epochs`` whole copies and, where the source's budget cuts
    inside an epoch, ``part`` words more (the whole document before the cut, some
    words of the one at the cut, 0 after it).  A source's taken words are its
    target rounded down.  Empty and null texts have size 0 and take nothing.
    Repeated rows have equal keys; which of them comes first does not change the
    rows returned.  Extra columns are ignored; a table without rows gives none.
    """
    sized = staged(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                               n_words(text_col).alias("size"), random_key(id_col, seed).alias("key"),
                               *content_key(id_col, source_col, text_col)), "sizes")
    most_docs = sized.groupBy("source").count().agg(F.max("count")).first()[0] or 1
    buckets = max(1, -(-most_docs // bucket_rows))
    half = KEY_BITS // 2
    bucket = F.shiftright(F.shiftright("key", half) * F.lit(buckets), half)  # monotone in the key
    sized = sized.withColumns({"bucket": bucket, "none": F.isnull("source"), "name": F.coalesce("source", F.lit(""))})
    per_bucket = sized.groupBy("none", "name", "source", "bucket").agg(F.sum("size").alias("bucket_size"))
    per_source = per_bucket.groupBy("source").agg(F.sum("bucket_size").alias("source_size"))
    targets = source_targets(per_source, list(weights), share, most).select(
        F.isnull("source").alias("none"), F.coalesce("source", F.lit("")).alias("name"), "source_size", "target", "budget")
    per_bucket = per_bucket.withColumn("group", F.floor(F.col("bucket") / math.isqrt(buckets)).cast("long"))
    per_group = per_bucket.groupBy("none", "name", "group").agg(F.sum("bucket_size").alias("group_size"))
    chain = Window.partitionBy("none", "name").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    before = per_group.select("none", "name", "group", F.coalesce(F.sum("group_size").over(chain), F.lit(0)).alias("before"))
    in_group = Window.partitionBy("none", "name", "group").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (per_bucket.withColumn("inner", F.coalesce(F.sum("bucket_size").over(in_group), F.lit(0)))
              .join(before, ["none", "name", "group"])
              .select("none", "name", "bucket", (F.col("before") + F.col("inner")).alias("base"))
              .join(targets, ["none", "name"]))
    inside = (Window.partitionBy("none", "name", "bucket").orderBy("key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    rest = F.greatest(F.lit(0).cast("long"), F.col("budget") - F.col("epochs") * F.col("source_size"))
    return (sized.join(starts, ["none", "name", "bucket"])
            .withColumn("start", F.col("base") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(0).cast("long"))
            .withColumn("part", F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest - F.col("start"))))
            .withColumn("taken", F.col("epochs") * F.col("size") + F.col("part"))
            .select("doc_id", "source", "size", "source_size", "target", "taken", "epochs", "part", "k1", "k2"))


def apply_mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
              chars_col: str = "n_chars", **options) -> DataFrame:
    """``docs`` mixed: every row as often as the mix takes it, with its own columns.

    The document at a source's cut comes once more with its first words up to the
    budget, joined by one space (``chars_col``, if present, follows the text).
    Documents that take nothing go.  Repeated rows are taken together.
    """
    plan = mix(docs, id_col, source_col, text_col, **options).where("taken > 0")
    whole = F.col("epochs") + (F.col("part") == F.col("size")).cast("long")
    copies = plan.groupBy("k1", "k2").agg(
        F.sum(whole).alias("w"), F.max(F.when(F.col("part") < F.col("size"), F.col("part")).otherwise(0)).alias("p"))
    n1, n2, w, p, i = (free_name(docs, x) for x in ("_k1", "_k2", "_whole", "_part", "_copy"))
    k1, k2 = content_key(id_col, source_col, text_col)
    each = (docs.withColumns({n1: k1, n2: k2}).dropDuplicates([n1, n2])
            .join(copies.toDF(n1, n2, w, p), [n1, n2])
            .withColumn(i, F.explode(F.sequence(F.lit(1).cast("long"), F.col(w) + (F.col(p) > 0).cast("long")))))
    words = F.regexp_extract_all(F.col(text_col), F.lit("(" + WORDS + ")"), F.lit(1))
    cut = F.array_join(F.slice(words, F.lit(1), F.col(p).cast("int")), " ")
    each = each.withColumn(text_col, F.when(F.col(i) > F.col(w), cut).otherwise(F.col(text_col)))
    if chars_col in docs.columns:
        each = each.withColumn(chars_col, F.length(text_col).cast(docs.schema[chars_col].dataType))
    return each.select(*docs.columns)
