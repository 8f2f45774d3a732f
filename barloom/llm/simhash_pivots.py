"""SimHash near-duplicates through pivot distance tables.

Each text gets a 64-bit SimHash of its word shingles.  The table of a
fingerprint x holds its Hamming distances to many reference fingerprints: for
each of ``BASES`` random words b, the distance to b and to b with one of six bit
segments inverted.  By the triangle inequality no table entry of two
fingerprints can differ by more than their distance, so a pair whose largest
difference exceeds the limit is discarded; the survivors are verified on the
fingerprints themselves.

Which pairs meet at all also follows from the table.  The distance to b and to b
with segment S inverted give the distance inside S:
d_S(x, b) = (d(x, b) - d(x, b ^ S) + |S|) / 2.  Two fingerprints that differ in at
most four bits agree on at least two of the six segments, hence in all table
entries derived from them: these entries, for each pair of segments, form a join
key.  Rows sorted by key are compared inside a key only; keys with very many
rows are dealt over pairs of blocks.  A task returns a spanning forest of the
links it finds (never all pairs of a group), and the components follow from
large-star/small-star rounds on those links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import content_key, drop_staged, free_name, grouped_batches, small_batches, staged, words_of

#: Six disjoint bit segments (widths 11, 11, 11, 11, 10, 10).
WIDTHS = (11, 11, 11, 11, 10, 10)
SEGMENTS = [((1 << w) - 1) << sum(WIDTHS[:i]) for i, w in enumerate(WIDTHS)]

#: Random base words: XXH64 of 0..7.
BASES = [xxhash.xxh64_intdigest(str(i).encode(), 7) for i in range(8)]

#: Reference fingerprints: every base, and every base with one segment inverted.
REFERENCES = [b ^ s for b in BASES for s in (0, *SEGMENTS)]

#: Rows of one key compared in one task; a larger key is dealt over pairs of blocks.
BLOCK = 1024


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """SimHash: a bit is set if it is set in over half of the shingles' XXH64 (seed 42)."""
    words = words_of(text)
    if not words:
        return 0
    words = [w.lower() for w in words]  # bytes.lower(): A-Z only
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - shingle + 1)
    starts = np.r_[0, ends[:-1] + 1][:n].tolist()
    stops = ends[min(shingle, len(words)) - 1:].tolist()
    count = np.zeros(64, "int64")
    for lo in range(0, n, 65_536):
        h = np.array([xxhash.xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts[lo:lo + 65_536], stops[lo:lo + 65_536])], "<u8")
        count += np.unpackbits(h.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype="int64")
    return int((1 << np.flatnonzero(2 * count > n).astype(object)).sum()) if (2 * count > n).any() else 0


def fingerprints(docs: DataFrame, cols: list[str], text_col: str = "text", shingle: int = 4) -> DataFrame:
    """``cols`` of ``docs`` and ``fp``, the fingerprint as a signed long (name freed of clashes)."""
    small_batches(docs.sparkSession)
    name = "fp"
    while name in cols:
        name += "_"
    n = len(cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = [_signed(fingerprint(t, shingle)) for t in b.column(n).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(n)), pa.array(fp, pa.int64())],
                                             names=[*cols, name])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*cols).schema)
    return docs.select(*cols, F.col(text_col).alias(free_name(docs, "_text"))).mapInArrow(run, f"{kinds}{name} long")


def _table(fp: Column) -> list[Column]:
    """Distances of a fingerprint to all references."""
    return [F.bit_count(fp.bitwiseXOR(F.lit(_signed(r)))) for r in REFERENCES]


def segment_keys(fp: str, agree: int = 2) -> Column:
    """One key per pair of segments, from the table's distances inside them."""
    table, per = _table(F.col(fp)), len(SEGMENTS) + 1
    inside = [F.xxhash64(*[table[b * per] - table[b * per + 1 + s] for b in range(len(BASES))]) for s in range(len(SEGMENTS))]
    return F.array(*[F.xxhash64(F.lit(i), *[inside[s] for s in group])
                     for i, group in enumerate(combinations(range(len(SEGMENTS)), agree))])


def _near_pairs(key: np.ndarray, fp: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked rows (places) among rows sorted by key; links inside an already linked set may be left out."""
    n = len(fp)
    label = np.arange(n)
    table = np.stack([np.bitwise_count(fp ^ np.uint64(r)) for r in REFERENCES]).astype("int8")
    a_out, b_out = [], []
    live = np.arange(n - 1)
    shift = 1
    while len(live):
        live = live[live + shift < n]
        live = live[key[live] == key[live + shift]]
        a, b = live, live + shift
        a, b = a[label[a] != label[b]], b[label[a] != label[b]]
        for row in table:  # discard by the largest difference of a table entry
            if not len(a):
                break
            near = np.abs(row[a] - row[b]) <= limit
            a, b = a[near], b[near]
        ok = np.bitwise_count(fp[a] ^ fp[b]) <= limit
        a, b = a[ok], b[ok]
        if len(a):
            a_out.append(a)
            b_out.append(b)
            label = _spread(label, a, b)
        shift += 1
    return (np.concatenate(a_out), np.concatenate(b_out)) if a_out else (live, live)


def _spread(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest label over links, with pointer jumping."""
    label = label.copy()
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
        if (label == before).all():
            return label


def _link_groups(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in grouped_batches(batches, "key"):
            key, fp = t.column("key").to_numpy(), t.column("fp").to_numpy().view("uint64")
            many = np.r_[False, key[1:] == key[:-1]] | np.r_[key[1:] == key[:-1], False]
            key, fp = key[many], fp[many]
            if not len(fp):
                continue
            a, b = _near_pairs(key, fp, limit)
            if not len(a):
                continue
            # one node per fingerprint, then a star per linked set
            nodes, at = np.unique(fp, return_inverse=True)
            label = _spread(np.arange(len(nodes)), at[a], at[b])
            leaf = np.flatnonzero(label != np.arange(len(nodes)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[leaf].view("int64")), pa.array(nodes[label[leaf]].view("int64"))], names=["a", "b"])

    return run


def links(fps: DataFrame, limit: int = 4, block: int = BLOCK) -> DataFrame:
    """Distinct links (a, b) whose components are those of all pairs within ``limit`` bits (at most 4)."""
    if not 0 <= limit <= 4:
        raise ValueError("six segments prove links of up to 4 bits")
    small_batches(fps.sparkSession)
    keyed = fps.select("fp", F.explode(segment_keys("fp")).alias("key"))
    big = (keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
           .select("key", F.ceil(F.col("n") / (block // 2)).cast("int").alias("n_blocks")))
    home = F.pmod(F.xxhash64("fp"), F.col("n_blocks")).cast("int")
    other = F.sequence(F.lit(0), F.col("n_blocks") - 1)
    # a row of a large key meets every block once: groups (i, j) with i < j hold blocks i and j whole
    groups = F.when(F.col("n_blocks").isNull(), F.array(F.col("key"))).otherwise(F.transform(
        F.filter(other, lambda j: j != home),
        lambda j: F.xxhash64("key", F.least(home, j), F.greatest(home, j))))
    dealt = keyed.join(big, "key", "left").select("fp", F.explode(groups).alias("key"))
    return (dealt.repartition("key").sortWithinPartitions("key")
            .mapInArrow(_link_groups(limit), "a long, b long").distinct())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the component's smallest node.

    Alternates large-star and small-star until the links are stars.  Each round
    is written to the shared folder; a node with very many links is summed
    map-side and its joins are split at run time.
    """
    spark = edges.sparkSession

    def ordered(e: DataFrame) -> DataFrame:
        return e.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    now = staged(ordered(edges), "links")
    mark = _mark(now)
    for _ in range(max_rounds):
        # large-star: every larger neighbour of u points to the smallest node around u
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = ordered(both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        # small-star: u and its smaller neighbours point to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("a", F.col("m").alias("b")))
        new = staged(ordered(small), "links")
        drop_staged(spark, now)
        now, old = new, mark
        mark = _mark(now)
        if mark == old:
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _mark(e: DataFrame):
    return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    limit: int = 4) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs``.

    Texts link when their fingerprints differ in at most ``limit`` bits; the
    component is named by the smallest id reachable (null ids never name one
    unless there is no other).  A null or empty text has fingerprint 0 and links
    like any other.  Repeated rows and equal fingerprints are one node; their
    number never enters the search.  Extra columns are ignored.
    """
    rows, by_fp = _classes(docs, id_col, text_col, shingle, limit)
    return rows.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def _classes(docs: DataFrame, id_col: str, text_col: str, shingle: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, k1, k2, fp) and the classes (fp, root, component_id)."""
    src = docs.select(F.col(id_col).alias("doc_id"), *content_key(id_col, text_col), F.col(text_col).alias("t"))
    rows = staged(fingerprints(src, ["doc_id", "k1", "k2"], "t", shingle), "fps")
    classes = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "classes")
    comp = components(links(classes, limit))
    named = classes.join(comp.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    low = named.groupBy("root").agg(F.min("low").alias("component_id"))
    return rows, staged(named.select("fp", "root").join(low, "root").select("fp", "root", "component_id"), "names")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, limit: int = 4) -> DataFrame:
    """One row of ``docs`` per component: that with the smallest id (null last; ties: the smallest content key)."""
    rows, by_fp = _classes(docs, id_col, text_col, shingle, limit)
    # the smallest row per fingerprint first, so a large group of copies is summed map-side
    first = F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "k1", "k2")).alias("r")
    per_fp = rows.groupBy("fp").agg(first)
    chosen = (per_fp.join(by_fp.select("fp", "root"), "fp").groupBy("root").agg(F.min("r").alias("r"))
              .select("r.k1", "r.k2"))
    n1, n2 = free_name(docs, "_k1"), free_name(docs, "_k2")
    k1, k2 = content_key(id_col, text_col)
    return (docs.withColumns({n1: k1, n2: k2})
            .join(chosen.select(F.col("k1").alias(n1), F.col("k2").alias(n2)), [n1, n2], "left_semi")
            .dropDuplicates([n1, n2]).select(*docs.columns))
