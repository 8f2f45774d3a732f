"""Cross-tokenizer alignment: which tokens of one vocabulary cover which of another.

Side A is a byte-level BPE file of the tokenizers library (it sees a space and the
text), side B a sentencepiece model (it adds that space itself).  Both token
sequences cut the same bytes.  Texts go through Python in chunks of about
``CHUNK_BYTES``; in a chunk ``pandas.merge_asof``, keyed by document, finds for each
A start the B token that covers it and for each B start the A token that covers
it.  The union of both directions is the set of overlapping pairs; byte offsets
where tokens of both sides end cut them into groups.

Corpus-wide counts never move a document's pairs through a shuffle: each chunk has
a dictionary of its distinct pairs with their number of documents, and documents
hold places in it.  Spark sums the dictionaries, finds every A id's highest count,
joins the sums back to the dictionaries and brings these to their chunk.  A pair
that stands in every document so has one row a chunk, not one a document.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import free_name, staged

#: Text bytes of a chunk (one text at least), and pairs so numbered that they fit into a long.
CHUNK_BYTES = 1 << 20

#: The split pattern of byte-level files without one of their own; a fixed value.
BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Byte-level alphabet: printable Latin-1 stands for itself, the other bytes for U+0100 on.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_OF = {chr(b): b for b in _SHOWN} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in _SHOWN)}


class ByteSide:
    """A byte-level BPE file: ids of whole texts and the bytes of each id.

    Files whose merges stand in the order of their ids are plain rank tables, which
    tiktoken encodes several times faster; tests hold both ways together.  Others go
    through the tokenizers library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        spec = json.loads(self.tok.to_str())
        vocab = spec["model"]["vocab"]
        added = {t["content"] for t in spec["added_tokens"]}
        plain = {t: i for t, i in vocab.items() if t not in added}
        size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.bytes = [b""] * size
        for t in spec["added_tokens"]:
            self.bytes[t["id"]] = t["content"].encode()
        for t, i in plain.items():
            self.bytes[i] = bytes(BYTE_OF[c] for c in t)
        self.fast = None
        if _is_rank_table(spec, plain):
            import tiktoken

            self.fast = tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL_SPLIT, special_tokens={},
                                          mergeable_ranks={self.bytes[i]: i for i in plain.values()})

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.fast is not None:
            return [self.fast.encode_ordinary(" " + t) for t in texts]
        return [e.ids for e in self.tok.encode_batch([" " + t for t in texts], add_special_tokens=False)]


def _is_rank_table(spec: dict, plain: dict[str, int]) -> bool:
    pre, model = spec["pre_tokenizer"] or {}, spec["model"]
    if spec["normalizer"] is not None or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex"):
        return False
    if any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
        return False
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    made = [plain.get(a + b, -1) for a, b in merges]
    return all(x < y for x, y in zip(made, made[1:])) and set(made) == {i for t, i in plain.items() if len(t) > 1}


class PieceSide:
    """A sentencepiece model with byte fallback: ids of whole texts and the bytes of each id."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.tok = SentencePieceProcessor(model_file=path)
        self.bytes = [bytes([int(p[3:5], 16)]) if self.tok.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in ((i, self.tok.id_to_piece(i)) for i in range(self.tok.get_piece_size()))]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.tok.encode(texts, out_type=int, num_threads=1)


class Side:
    """Tokens of one side of a chunk, all documents in a row: id, document, first byte, end byte."""

    def __init__(self, lists: list[list[int]], docs: list[int], sizes: np.ndarray):
        self.ids = np.fromiter((i for x in lists for i in x), "int64", sum(map(len, lists)))
        self.doc = np.repeat(np.array(docs, "int64"), [len(x) for x in lists])
        self.end = np.cumsum(sizes[self.ids])
        self.start = self.end - sizes[self.ids]

    def frame(self) -> pd.DataFrame:
        return pd.DataFrame({"doc": self.doc, "start": self.start})


def covering(of: Side, by: Side) -> np.ndarray:
    """For each token of ``of`` the place of the ``by`` token of its document that covers its first byte."""
    got = pd.merge_asof(of.frame(), by.frame().assign(at=np.arange(len(by.ids))), on="start", by="doc")
    return got["at"].to_numpy("int64")


def overlaps(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """Places (in A, in B) of all overlapping pairs: both directions, pairs with equal starts once."""
    to_b, to_a = covering(a, b), covering(b, a)
    new = a.start[to_a] != b.start
    return np.r_[np.arange(len(a.ids)), to_a[new]], np.r_[to_b, np.flatnonzero(new)]


def common_ends(x: Side, y: Side) -> np.ndarray:
    """Whether each token of ``x`` ends where one of ``y`` does."""
    return y.end[np.minimum(np.searchsorted(y.end, x.end), len(y.end) - 1)] == x.end


class Aligner:
    """Both sides with the tables that write groups out."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteSide(a_path), PieceSide(b_path)
        self.n_b = len(self.b.bytes)
        self.a_size = np.array([len(x) for x in self.a.bytes], "int64")
        self.b_size = np.array([len(x) for x in self.b.bytes], "int64")
        self.width = max(len(self.a.bytes), self.n_b)
        self.written = np.array([b"%d%s" % (i, s) for s in (b",", b"|", b";") for i in range(self.width)], object)

    def encode(self, texts: list[str | None]) -> tuple[list[int], Side, Side]:
        """Documents with tokens, and their tokens (none: null, empty, or bytes that do not join to the text)."""
        docs = [i for i, t in enumerate(texts) if t]
        a = self.a.encode([texts[i] for i in docs])
        b = self.b.encode([texts[i] for i in docs])
        raw = [b" " + texts[i].encode() for i in docs]
        good = [k for k, r in enumerate(raw) if b"".join(map(self.a.bytes.__getitem__, a[k])) == r
                and b"".join(map(self.b.bytes.__getitem__, b[k])) == r]
        docs = [docs[k] for k in good]
        return docs, Side([a[k] for k in good], docs, self.a_size), Side([b[k] for k in good], docs, self.b_size)

    def digests(self, n: int, a: Side, b: Side, a_cut: np.ndarray, b_cut: np.ndarray) -> list[str]:
        """SHA-256 of ``a1,a2|b1;a3|b2`` per document: tokens of both sides in the order in which they are written."""
        a_group, b_group = np.cumsum(a_cut) - a_cut, np.cumsum(b_cut) - b_cut
        a_upto = np.r_[0, np.flatnonzero(a_cut) + 1]
        b_upto = np.r_[0, np.flatnonzero(b_cut) + 1]
        code = np.empty(len(a.ids) + len(b.ids), "int64")
        code[np.arange(len(a.ids)) + b_upto[a_group]] = a.ids + a_cut * self.width
        code[np.arange(len(b.ids)) + a_upto[b_group + 1]] = b.ids + b_cut * (2 * self.width)
        parts = self.written[code].tolist()
        ends = np.cumsum(np.bincount(a.doc, minlength=n) + np.bincount(b.doc, minlength=n)).tolist()
        return [hashlib.sha256(b"".join(parts[lo:hi])[:-1]).hexdigest() if hi > lo else "" for lo, hi in zip([0, *ends], ends)]

    def chunk(self, texts: list[str | None], lists: bool) -> dict[str, pa.Array]:
        """Columns of a chunk's documents; the first row holds the chunk's dictionary."""
        n = len(texts)
        docs, a, b = self.encode(texts)
        if docs:
            a_cut, b_cut = common_ends(a, b), common_ends(b, a)
            i, j = overlaps(a, b)
        else:
            a_cut = b_cut = np.empty(0, bool)
            i = j = np.empty(0, "int64")
        pair, doc = a.ids[i] * self.n_b + b.ids[j], a.doc[i]
        wide = len(self.a.bytes) * self.n_b
        both, times = np.unique(doc * wide + pair, return_counts=True)
        codes, place, n_docs = np.unique(both % wide, return_inverse=True, return_counts=True)
        off = np.r_[0, np.cumsum(np.bincount(both // wide, minlength=n))].astype("int32")
        out = {
            "n_a": np.bincount(a.doc, minlength=n), "n_b": np.bincount(b.doc, minlength=n),
            "n_groups": np.bincount(a.doc[a_cut], minlength=n), "n_links": np.bincount(doc, minlength=n)}
        cols = {k: pa.array(v.astype("int64")) for k, v in out.items()}
        if lists:
            g = [pa.ListArray.from_arrays(pa.array(np.r_[0, np.flatnonzero(cut) + 1].astype("int32")), pa.array(s.ids.astype("int32")))
                 for s, cut in ((a, a_cut), (b, b_cut))]
            cols["groups"] = pa.ListArray.from_arrays(
                pa.array(np.r_[0, np.cumsum(out["n_groups"])].astype("int32")), pa.StructArray.from_arrays(g, names=["a", "b"]))
        else:
            cols["groups"] = pa.array(self.digests(n, a, b, a_cut, b_cut) if docs else [""] * n, pa.string())
        cols["chunk"] = pa.array([uuid.uuid4().hex] * n, pa.string())
        cols["place"] = pa.ListArray.from_arrays(pa.array(off), pa.array(place.astype("int32")))
        cols["times"] = pa.ListArray.from_arrays(pa.array(off), pa.array(times.astype("int32")))
        first = [None] * (n - 1)
        cols["pairs"] = pa.array([codes, *first], pa.list_(pa.int64()))
        cols["pair_docs"] = pa.array([n_docs, *first], pa.list_(pa.int64()))
        return cols


def _chunks(batch: pa.RecordBatch, text_at: int) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Slices of a batch of about ``CHUNK_BYTES`` of text, with their texts."""
    size = pa.compute.fill_null(pa.compute.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False)
    lo, held = 0, 0
    for hi in range(batch.num_rows):
        held += int(size[hi])
        if held >= CHUNK_BYTES or hi + 1 == batch.num_rows:
            part = batch.slice(lo, hi + 1 - lo)
            yield part, part.column(text_at).to_pylist()
            lo, held = hi + 1, 0


DOC_FACTS = "n_a long, n_b long, n_groups long, n_links long, "


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
          lists: bool = True) -> DataFrame:
    """Per row of ``docs``: the id, n_a, n_b, n_groups, n_links, n_best, count_sum and ``groups``.

    ``groups`` is an array of (a, b) id lists; with ``lists=False`` the SHA-256 of
    ``a1,a2|b1;a3|b2,b3`` (no tokens: empty), which is far smaller than the lists.  A pair's count is
    the number of rows of ``docs`` that hold it linked; ``n_best`` are the links whose
    pair has its A id's highest count (ties included), ``count_sum`` sums the counts
    over the links.

    Null and empty texts, and texts whose tokens' bytes differ from a space and the
    text on either side, have no tokens: zeros.  A very long text is one chunk.
    Repeated rows count each; null ids are kept; only the id and the text are
    read, so other columns cannot clash; an empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    groups = "groups array<struct<a:array<int>,b:array<int>>>" if lists else "groups string"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = None
        for batch in batches:
            for part, texts in _chunks(batch, 1):
                both = both or Aligner(a_path, b_path)
                cols = both.chunk(texts, lists)
                yield pa.RecordBatch.from_arrays([part.column(0), *cols.values()], names=["id", *cols])

    rows = staged(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInArrow(
        encode, f"id {kind}, {DOC_FACTS}{groups}, chunk string, place array<int>, times array<int>, "
                "pairs array<long>, pair_docs array<long>"), "aligned")

    n_b = _pieces(b_path)
    words = (rows.where(F.col("pairs").isNotNull())
             .select("chunk", F.posexplode(F.arrays_zip("pairs", "pair_docs")).alias("at", "p"))
             .select("chunk", "at", F.col("p.pairs").alias("pair"), F.col("p.pair_docs").alias("n")))
    total = words.groupBy("pair").agg(F.sum("n").alias("count"))
    # the rows of one A id are its B ids: at most as many as B has pieces
    best = F.max("count").over(Window.partitionBy(F.floor(F.col("pair") / n_b)))
    facts = (words.join(total.withColumn("best", F.col("count") == best), "pair")
             .select("chunk", "at", "count", "best"))

    def finish(part: pa.Table, known: pa.Table) -> pa.Table:
        at = known.column("at").to_numpy()
        count, best = np.zeros(len(at), "int64"), np.zeros(len(at), "int64")
        count[at], best[at] = known.column("count").to_numpy(), known.column("best").to_numpy(zero_copy_only=False)
        part = part.combine_chunks()
        place, times = (part.column(k).combine_chunks() for k in ("place", "times"))
        off, at, n = place.offsets.to_numpy(), place.values.to_numpy(), times.values.to_numpy().astype("int64")

        def per_doc(x: np.ndarray) -> pa.Array:
            run = np.r_[0, np.cumsum(n * x[at])]
            return pa.array(run[off[1:]] - run[off[:-1]], pa.int64())

        keep = part.select(["id", "n_a", "n_b", "n_groups", "n_links"])
        return (keep.append_column("n_best", per_doc(best)).append_column("count_sum", per_doc(count))
                .append_column("groups", part.column("groups")))

    done = (rows.drop("pairs", "pair_docs").withColumnRenamed("chunk", "of").groupBy("of").cogroup(facts.groupBy("chunk"))
            .applyInArrow(finish, f"id {kind}, {DOC_FACTS}n_best long, count_sum long, {groups}"))
    return done.withColumnRenamed("id", free_name(done.drop("id"), id_col))


def _pieces(path: str) -> int:
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path).get_piece_size()
