"""Conflict-constrained best-fit packing.

Documents are cut into pieces of at most the bin's capacity; full pieces fill a
bin alone, the rest are packed best-fit, longest first.  Open bins are kept
ordered by residual capacity and carry two bitmaps: the sources and the
duplicate clusters they hold.  A piece looks up the first bin whose residual
suffices and goes on to its successors until the tightest compatible bin is
found; if none is left it opens a new bin.

Packing is sequential, so rows are dealt by a hash of their content into shards
of about ``shard_rows`` pieces; the number of shards grows with the input, a
task holds one shard's narrow rows (no texts), and bins never span shards.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import staged


def best_fit(size: np.ndarray, source: np.ndarray, cluster: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of each piece (sizes in 1..capacity, in packing order).

    ``source`` and ``cluster`` are small integers: bit positions in the bins'
    bitmaps; -1 means no constraint.  Bins of equal residual are tried oldest
    first.
    """
    bins, offsets = np.empty(len(size), "int64"), np.empty(len(size), "int64")
    order: list[tuple[int, int]] = []  # (residual, bin), ascending: successor search is a walk to the right
    sources: list[int] = []
    clusters: list[int] = []
    for i, (n, s, c) in enumerate(zip(size.tolist(), source.tolist(), cluster.tolist())):
        s_bit, c_bit = (1 << s if s >= 0 else 0), (1 << c if c >= 0 else 0)
        at = bisect_left(order, (n, -1))
        while at < len(order):
            b = order[at][1]
            if not (sources[b] & s_bit or clusters[b] & c_bit):
                break
            at += 1
        if at < len(order):
            residual, b = order.pop(at)
            sources[b] |= s_bit
            clusters[b] |= c_bit
        else:
            residual, b = capacity, len(sources)
            sources.append(s_bit)
            clusters.append(c_bit)
        bins[i], offsets[i] = b, capacity - residual
        if residual > n:
            insort(order, (residual - n, b))
    return bins, offsets


def _codes(column: pa.ChunkedArray) -> np.ndarray:
    """Small integers for the values of a column; nulls -1."""
    codes = column.combine_chunks().dictionary_encode().indices
    return codes.fill_null(-1).to_numpy(zero_copy_only=False).astype("int64")


def _pack_shard(capacity: int, spread_sources: bool):
    def run(rows: pa.Table) -> pa.Table:
        num = {c: rows.column(c).to_numpy() for c in ("size", "k1", "k2", "piece", "seq")}
        rows = rows.take(np.lexsort((num["seq"], num["piece"], num["k2"], num["k1"], -num["size"])))
        # null is a source of its own
        source = _codes(rows.column("source")) + 1 if spread_sources else np.full(len(rows), -1)
        # only clusters met twice in the shard can conflict: they alone get a bit
        cluster = _codes(rows.column("cluster"))
        known = cluster >= 0
        times = np.bincount(cluster[known], minlength=1)
        dense = np.cumsum(times > 1) - 1
        bit = np.full(len(rows), -1)
        bit[known] = np.where(times[cluster[known]] > 1, dense[cluster[known]], -1)
        bins, offsets = best_fit(rows.column("size").to_numpy(), source, bit, capacity)
        keep = rows.select(["shard", "doc_id", "piece", "piece_start", "size"])
        return keep.append_column("bin", pa.array(bins)).append_column("bin_offset", pa.array(offsets))

    return run


def pack(docs: DataFrame, size_col: str, source_col: str, cluster_col: str, id_col: str = "doc_id",
         capacity: int = 2048, shard_rows: int = 4096, spread_sources: bool = True) -> DataFrame:
    """One row per piece: doc_id, piece, piece_start, size, bin_id, bin_offset.

    No bin holds two pieces of one duplicate cluster (null cluster: free) nor, with
    ``spread_sources``, of one source (null is a source of its own).  Full
    pieces of a long document fill a bin each, so its parts never meet a
    conflict.  Documents of null, zero or negative size carry nothing: one row with
    size 0 and a null bin.  Repeated rows are packed each; rows that agree in
    everything go to one shard, salted by size class beyond ``shard_rows``.
    Extra columns are ignored.  ``bin_id`` is unique over shards.
    """
    size = F.greatest(F.coalesce(F.col(size_col).cast("long"), F.lit(0)), F.lit(0))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), size.alias("n"),
        F.when(F.col(source_col).isNotNull(), F.col(source_col).cast("string")).alias("source"),
        F.col(cluster_col).cast("string").alias("cluster"))
    pieces = rows.withColumn("piece", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("n") / capacity) - 1, F.lit(0)).cast("int"))))
    start = F.col("piece").cast("long") * capacity
    pieces = staged(pieces.select(
        "doc_id", "piece", start.alias("piece_start"),
        F.least(F.col("n") - start, F.lit(capacity)).cast("int").alias("size"), "source", "cluster",
        F.monotonically_increasing_id().alias("seq"),  # fixed by being written
        F.xxhash64(F.isnull("doc_id"), "doc_id", F.isnull("cluster"), "cluster", "n", "piece").alias("k1"),
        F.xxhash64(F.lit(11), F.isnull("doc_id"), "doc_id", F.isnull("cluster"), "cluster", "n", "piece").alias("k2")), "pieces")
    open_pieces = pieces.where((F.col("size") > 0) & (F.col("size") < capacity))
    n = open_pieces.count()
    shards = max(1, -(-n // shard_rows))
    # a row repeated so often that its copies alone would fill shards is dealt over more of them
    same = (open_pieces.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("same")).where(F.col("same") > shard_rows // 4))
    dealt = (open_pieces.join(same, ["k1", "k2"], "left")
             .withColumn("salt", F.when(F.col("same").isNotNull(), F.col("seq")).otherwise(F.lit(0).cast("long")))
             .withColumn("shard", F.pmod(F.xxhash64("k1", "salt"), F.lit(shards)).cast("int"))
             .select("shard", "doc_id", "piece", "piece_start", "size", "source", "cluster", "k1", "k2", "seq"))
    kind = docs.schema[id_col].dataType.simpleString()
    packed = dealt.groupBy("shard").applyInArrow(
        _pack_shard(capacity, spread_sources),
        f"shard int, doc_id {kind}, piece int, piece_start long, size int, bin long, bin_offset long")
    cols = ["doc_id", "piece", "piece_start", F.col("size").cast("long").alias("size")]
    full = pieces.where(F.col("size") == capacity).select(
        *cols, F.concat_ws("-", F.lit("full"), "seq").alias("bin_id"),
        F.lit(0).cast("long").alias("bin_offset"))
    none = pieces.where(F.col("size") == 0).select(*cols, F.lit(None).cast("string").alias("bin_id"),
                                                  F.lit(None).cast("long").alias("bin_offset"))
    shared = packed.select(*cols, F.concat_ws("-", F.lit("mix"), "shard", "bin").alias("bin_id"), "bin_offset")
    return shared.unionByName(full).unionByName(none)
