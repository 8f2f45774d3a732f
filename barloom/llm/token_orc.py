"""Token-ID output in ORC: run-length coded ids, row indexes, Bloom filters.

``write_tokens`` encodes whole texts with a public tokenizer and writes one row
per document to ORC in ascending id order.  ORC codes the id lists with its
integer run-length encoding, keeps min/max row indexes per ``row_index_stride``
rows and a Bloom filter on the document id, so stripes are read in parallel and
a lookup by id prunes stripes and row groups from metadata alone.
``read_tokens`` reads the files back and gives every document its place in the
whole token stream by prefix sums over shards.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.llm.common import small_batches

#: Words and pieces whose ids a Python worker remembers (the first met, hence the frequent ones).
CACHE_WORDS = 300_000
CACHE_PIECES = 300_000

#: Words encoded together, and bytes of a very long text taken at once.
RUN_WORDS = 200_000
RUN_BYTES = 1 << 20

#: Characters of the short way: visible ASCII and precomposed Latin letters and signs
#: (line feeds part the words).  Lower case and composition of these are the same in every library.
#: Capitals whose lower case lies beyond U+024F (U+0181, U+018F, ...) are not among them: PIECES has no class for it.
_LATIN = [chr(c) for c in (*range(0x21, 0x7F), *range(0xA1, 0x130), *range(0x131, 0x250))]
PLAIN = re.compile(f"[\n{re.escape(''.join(c for c in _LATIN if c.lower() <= chr(0x24F)))}]*")

#: The split pattern of the tokenizers that take the short way, and the same for lower-case plain
#: text with its letters and numbers spelled out (line feeds kept); fixed values.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ɏ]+|[0-9²³¹¼-¾]|\n|[^\na-zªµºß-öø-ɏ0-9²³¹¼-¾]+")

#: Between two words' ids; no id has these bytes, nor do two neighbours.
BREAK = b"\xff\xff\xff\xff"

#: Byte-level alphabet: printable Latin-1 stands for itself, the other bytes for U+0100 on.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_CHARS = {b: chr(b) for b in _SHOWN} | {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in _SHOWN)}


class WordEncoder:
    """Whole-text encoding through the memory of a Python worker.

    Sound for tokenizers whose normaliser and pre-tokenizer drop white space and
    never join text across it: the ids of a text are those of its words in turn.
    Where the tokenizer lower-cases, splits by ``SPLIT`` and maps bytes (as its file
    says), plain words are split here and only pieces never met go to the
    library's model; every other word goes through the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        spec = json.loads(self.tok.to_str())
        self.short = _short_way(spec)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.model = self.tok.model
        self.words: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {"\n": BREAK}

    def piece(self, p: str) -> bytes:
        shown = p if p.isascii() else "".join(map(BYTE_CHARS.__getitem__, p.encode()))
        got = np.array([t.id for t in self.model.tokenize(shown)], "<u4").tobytes()
        if len(self.pieces) < CACHE_PIECES:
            self.pieces[p] = got
        return got

    def new_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of words that are not remembered."""
        text = b"\n".join(words).decode("utf-8", "replace")
        if self.short and PLAIN.fullmatch(text) and not any(t in text for t in self.special):
            known = self.pieces.get
            ids = b"".join([known(p) or self.piece(p) for p in PIECES.findall(text.lower())]).split(BREAK)
        elif len(words) > 1:  # only some of them need the long way
            half = len(words) // 2
            return self.new_words(words[:half]) + self.new_words(words[half:])
        else:
            ids = [np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()]
        room = CACHE_WORDS - len(self.words)
        if room > 0:
            self.words.update(zip(words[:room], ids[:room]))
        return ids

    def word_ids(self, words: list[bytes]) -> list[bytes]:
        ids = list(map(self.words.get, words))
        new = [i for i, x in enumerate(ids) if x is None]
        if new:
            for i, x in zip(new, self.new_words([words[i] for i in new])):
                ids[i] = x
        return ids

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out = [[] for _ in texts]
        run, owners = [], []
        for i, t in enumerate(texts):
            for words in _runs(t):
                run += words
                owners.append((i, len(words)))
                if len(run) >= RUN_WORDS:
                    self._deal(run, owners, out)
                    run, owners = [], []
        self._deal(run, owners, out)
        return [b"".join(x) for x in out]

    def _deal(self, run: list[bytes], owners: list[tuple[int, int]], out: list[list[bytes]]) -> None:
        ids, at = self.word_ids(run), 0
        for i, n in owners:
            out[i].append(b"".join(ids[at:at + n]))
            at += n


def _runs(text: str | None) -> Iterator[list[bytes]]:
    """Words of a text, a stretch of about ``RUN_BYTES`` bytes at a time."""
    raw, lo = b"" if text is None else text.encode("utf-8", "surrogatepass"), 0
    while lo < len(raw):
        space = SPACE.search(raw, lo + RUN_BYTES) if lo + RUN_BYTES < len(raw) else None
        hi = space.start() if space else len(raw)
        yield raw[lo:hi].split()
        lo = hi


SPACE = re.compile(rb"[\x20\x09-\x0d]")


def _short_way(spec: dict) -> bool:
    """Whether the tokenizer's file names the steps that the short way repeats."""
    norm, pre = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
    kinds = [x["type"] for x in norm.get("normalizers", [])], [x["type"] for x in pre.get("pretokenizers", [])]
    if kinds != (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]) or spec["model"]["type"] != "BPE":
        return False
    split, level = pre["pretokenizers"]
    return (split["behavior"] == "Removed" and split["invert"] and split["pattern"].get("Regex") == SPLIT
            and not level["add_prefix_space"] and not level["use_regex"])


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's encoder of a tokenizer file (workers serve many tasks)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def encode_batches(path: str, eos_id: int | None):
    """Arrow mapper: (doc_id, text) in, (doc_id, ids) out, order kept."""
    end = b"" if eos_id is None else np.array([eos_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            raw = [ids + end for ids in enc.encode_all(b.column(1).to_pylist())]
            offs = np.zeros(len(raw) + 1, "int32")
            np.cumsum([len(r) // 4 for r in raw], out=offs[1:])
            ids = pa.ListArray.from_arrays(pa.array(offs), pa.array(np.frombuffer(b"".join(raw), "<i4")))
            yield pa.RecordBatch.from_arrays([b.column(0), ids], names=["doc_id", "ids"])

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 eos_id: int | None = 2, stripe_mb: int = 16, row_index_stride: int = 2000,
                 compression: str = "zstd") -> None:
    """Encode ``docs`` and write ``(shard, doc_id, ids)`` as ORC under ``path``.

    Files follow ascending ``doc_id`` (nulls first): documents are cut into
    ranges, sorted inside each range, and range ``i`` is shard ``i``.  Rows that
    share an id are ordered by their text, so a repeated id may spread over
    several ranges.  A null or empty text gives the end id alone; extra columns
    are ignored.  Only raw text is shuffled, once; encoding follows the sort.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    ranges = (rows.withColumn("tie", F.xxhash64("text"))
              .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
              .select("doc_id", "text"))
    kind = docs.schema[id_col].dataType.simpleString()
    ids = ranges.mapInArrow(encode_batches(tokenizer, eos_id), f"doc_id {kind}, ids array<int>")
    (ids.select(F.monotonically_increasing_id().alias("seq"), "doc_id", "ids")
        .write.mode("error")
        .option("compression", compression)
        .option("orc.stripe.size", stripe_mb << 20)
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", row_index_stride)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", 0.01)
        .orc(path))


def open_tokens(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """The files as rows ``(seq, doc_id, ids)``; an output without rows reads as empty."""
    return spark.read.schema(f"seq bigint, doc_id {id_type}, ids array<int>").orc(path)


def crc_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lists = b.column(2)
        flat, offs = lists.values.to_numpy(), lists.offsets.to_numpy()
        crc = [zlib.crc32(flat[lo:hi].astype("<i4").tobytes()) for lo, hi in zip(offs[:-1], offs[1:])]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(np.diff(offs).astype("int64")), pa.array(crc, pa.int64())],
            names=["seq", "doc_id", "n_tokens", "ids_crc32"])


def read_tokens(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32, shard.

    ``start`` counts the ids of all documents before it in file order (``seq``:
    the shard in its high bits, the row in the shard below).  Sums per shard are
    chained over the table of shards (one row a file), then added to a running
    sum inside each shard, so no task holds more than one shard's counts.
    """
    small_batches(spark)
    orc = open_tokens(spark, path, id_type)
    rows = (orc.mapInArrow(crc_batches, f"seq long, doc_id {id_type}, n_tokens long, ids_crc32 long")
            .withColumn("shard", F.shiftright("seq", 33).cast("int")))
    per = (orc.groupBy(F.shiftright("seq", 33).cast("int").alias("shard"))
           .agg(F.sum(F.size("ids").cast("long")).alias("shard_tokens")))
    base = F.sum("shard_tokens").over(Window.orderBy("shard")) - F.col("shard_tokens")
    inside = Window.partitionBy("shard").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.join(per.select("shard", base.alias("base")), "shard")
            .select("doc_id",
                    (F.col("base") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).cast("long").alias("start"),
                    "n_tokens", "ids_crc32", "shard"))


def lookup(spark: SparkSession, path: str, doc_id, id_type: str = "bigint") -> DataFrame:
    """Ids of one document; the predicate reaches ORC's stripe indexes and Bloom filters."""
    return open_tokens(spark, path, id_type).where(F.col("doc_id") == doc_id).select("doc_id", "ids")
