"""Substring dedup by Rabin-Karp hashes of every fixed-length token window.

Every window of ``width`` words gets a rolling polynomial hash; windows are
counted over the corpus, and the repeated ones merge into maximal intervals of
words to remove.

A hash per word would be the whole cost of the shuffle, so windows travel in
runs.  Inside each window the ``GRAM``-word sequence with the smallest hash
(leftmost on ties) is its anchor; equal windows have equal anchors, and
neighbouring windows share theirs, so a run is the consecutive windows of one
anchor.  Runs are dealt by their anchor's 64-bit hash and carry 48 hash bits of
each window: every window hash is shipped and counted, with 112 bits compared.

Each task first counts its own rows, a stretch of ``RUN_WORDS`` words at a time:
windows repeated in a stretch are decided at once, and a decided run is sent only
once by a task.  The inside of a passage on a third of all documents therefore
costs a few rows a task.  Windows across its edges are all different but share
its anchors.  Two ways keep such an anchor from filling a task:

* anchors on more than ``HOT_SHARE`` of the documents are found on a bounded sample
  beforehand, and their windows are dealt by the window's own hash; the runs of any
  other anchor are then less than that share of the documents, a few runs each;
* a task holds at most ``KEY_ROWS`` runs of one anchor (and a batch).  The windows
  of an anchor with more are not counted there: each goes on alone, dealt once more
  by anchor and window hash, and is counted from the sorted rows as they pass.

Both change where windows meet, never whether.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import content_key, free_name, sliced, words_of

#: Words of an anchor.
GRAM = 8

#: Odd base of the polynomial hash modulo 2**64 (its inverse turns prefix sums into window hashes).
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

#: Words worked on together in a task; a longer text goes in overlapping stretches.
RUN_WORDS = 400_000

#: Bits of a position inside a run of words.
POS_BITS = 20

#: Hash bits sent of each window, beside the anchor's 64.
LOW48 = (1 << 48) - 1

#: Documents of the sample that finds hot anchors, and the share of them that makes an anchor hot.
SAMPLE_DOCS = 20_000
HOT_SHARE = 1 / 400

#: Runs of one anchor that a task holds at once.
KEY_ROWS = 20_000

RUNS = "key long, k1 long, k2 long, at int, seen binary, hashes binary"


def _powers(n: int, base: int) -> np.ndarray:
    p = np.full(n, base, "uint64")
    p[:1] = 1
    return np.cumprod(p, dtype="uint64")


def rolling(word: np.ndarray, width: int, up: np.ndarray, down: np.ndarray) -> np.ndarray:
    """Rabin-Karp hash of every ``width``-word window."""
    if len(word) < width:
        return np.empty(0, "uint64")
    sums = np.r_[np.uint64(0), np.cumsum(word * up[:len(word)], dtype="uint64")]
    return (sums[width:] - sums[:-width]) * down[:len(word) - width + 1]


def _mix(h: np.ndarray) -> np.ndarray:
    """Spread a polynomial hash over all 64 bits."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def anchors(gram: np.ndarray, span: int) -> np.ndarray:
    """Place of the smallest of each ``span`` consecutive gram hashes (leftmost on ties)."""
    low = (gram >> np.uint64(POS_BITS) << np.uint64(POS_BITS)) | np.arange(len(gram), dtype="uint64")
    size, best = 1, low
    while 2 * size <= span:
        best = np.minimum(best[:-size], best[size:])
        size *= 2
    if size < span:
        best = np.minimum(best[:len(best) - (span - size)], best[span - size:])
    return (best & np.uint64((1 << POS_BITS) - 1)).astype("int64")


class Windows:
    """Windows of a run of texts: hash, anchor hash, text number and word number."""

    def __init__(self, texts: list[list[bytes]], first: list[int], width: int, up: np.ndarray, down: np.ndarray):
        count = np.array([len(t) for t in texts], "int64")
        word = np.fromiter((xxhash.xxh64_intdigest(w) for t in texts for w in t), "uint64", int(count.sum()))
        begin = np.r_[0, np.cumsum(count)[:-1]]
        text = np.repeat(np.arange(len(texts)), count)
        h = _mix(rolling(word, width, up, down))
        gram = min(GRAM, width)
        g = _mix(rolling(word, gram, up, down))
        place = anchors(g, width - gram + 1) if len(h) else np.empty(0, "int64")
        inside = text[:len(h)] == text[width - 1:] if len(h) else np.empty(0, bool)
        self.hash, self.anchor = h[inside], g[place[inside]]
        self.text = text[:len(h)][inside]
        at = np.flatnonzero(inside)
        self.word = at - begin[self.text] + np.array(first, "int64")[self.text]
        self.place = place[inside]


def _stretches(texts: list[list[bytes]], width: int) -> Iterator[tuple[list[int], list[list[bytes]], list[int]]]:
    """Runs of (text number, words, first word), each of about ``RUN_WORDS`` words; every window occurs once."""
    step = RUN_WORDS - width + 1
    numbers, parts, first, total = [], [], [], 0
    for i, t in enumerate(texts):
        for lo in range(0, max(1, len(t) - width + 1), step):
            part = t[lo:lo + step + width - 1] if len(t) > RUN_WORDS else t
            if len(part) < width:
                continue
            if total + len(part) > RUN_WORDS and parts:
                yield numbers, parts, first
                numbers, parts, first, total = [], [], [], 0
            numbers.append(i)
            parts.append(part)
            first.append(lo)
            total += len(part)
            if len(t) <= RUN_WORDS:
                break
    if parts:
        yield numbers, parts, first


def _pack48(h: np.ndarray) -> np.ndarray:
    """48 low bits of each hash as six bytes a row."""
    return (h & np.uint64(LOW48)).astype("<u8").view("u1").reshape(-1, 8)[:, :6]


def _unpack48(raw: bytes) -> np.ndarray:
    six = np.frombuffer(raw, "u1").reshape(-1, 6)
    out = np.zeros((len(six), 8), "u1")
    out[:, :6] = six
    return out.view("<u8").ravel()


def _repeated(*keys: np.ndarray) -> np.ndarray:
    """Which rows occur more than once."""
    order = np.lexsort(keys)
    same = np.ones(len(order), bool)
    for k in keys:
        s = k[order]
        same[1:] &= s[1:] == s[:-1]
    same[:1] = False
    twice = np.zeros(len(order), bool)
    twice[order] = same | np.r_[same[1:], False]
    return twice


def _text_anchors(width: int):
    """Texts to the distinct anchors of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up, down = _powers(RUN_WORDS + 1, BASE), _powers(RUN_WORDS + 1, INVERSE)
        for b in batches:
            texts = [words_of(t) for t in b.column(0).to_pylist()]
            for numbers, parts, first in _stretches(texts, width):
                w = Windows(parts, first, width, up, down)
                both = np.unique(np.stack([w.anchor, np.array(numbers, "uint64")[w.text]], 1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0].view("int64"))], names=["anchor"])

    return run


def hot_anchors(docs: DataFrame, id_col: str, text_col: str, width: int) -> np.ndarray:
    """Anchors on more than ``HOT_SHARE`` of a sample of about ``SAMPLE_DOCS`` texts.

    A text has a bounded number of words on average, so the share bounds how
    many there are; the list is what every task gets.
    """
    n = docs.count()
    key = F.xxhash64(F.lit("sample"), id_col, text_col)
    some = docs.where(F.pmod(key, F.lit(max(1, n // SAMPLE_DOCS))) == 0)
    often = (some.select(text_col).mapInArrow(sliced(_text_anchors(width)), "anchor long")
             .groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max(8, HOT_SHARE * min(n, SAMPLE_DOCS))))
    return np.array(sorted(r["anchor"] for r in often.select("anchor").collect()), "int64").view("uint64")


def _send(width: int, hot: np.ndarray):
    """(k1, k2, text) to runs; ``seen`` has a byte per window: already known to repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up, down = _powers(RUN_WORDS + 1, BASE), _powers(RUN_WORDS + 1, INVERSE)
        sent: set[bytes] = set()
        for b in batches:
            k1, k2 = b.column(0).to_numpy(), b.column(1).to_numpy()
            texts = [words_of(t) for t in b.column(2).to_pylist()]
            for numbers, parts, first in _stretches(texts, width):
                w = Windows(parts, first, width, up, down)
                if not len(w.hash):
                    continue
                twice = _repeated(w.hash, w.anchor)
                alone = np.isin(w.anchor, hot)
                w.anchor = np.where(alone, _mix(w.anchor ^ w.hash), w.anchor)
                head = np.flatnonzero(np.r_[True, (w.place[1:] != w.place[:-1]) | (w.text[1:] != w.text[:-1]) | alone[1:]])
                tail = np.r_[head[1:], len(w.hash)]
                six, known = _pack48(w.hash), twice.astype("u1")
                number = np.array(numbers, "int64")[w.text[head]]
                rows = []
                for i, (lo, hi) in enumerate(zip(head.tolist(), tail.tolist())):
                    hashes, seen = six[lo:hi].tobytes(), known[lo:hi].tobytes()
                    if 0 not in seen:
                        # decided here; the others need to hear of it only once from this task
                        mark = w.anchor[lo].tobytes() + hashes
                        rows.append((i, lo, seen, None))
                        if mark in sent:
                            continue
                        if len(sent) < 1_000_000:
                            sent.add(mark)
                        rows.append((i, lo, seen, hashes))
                    else:
                        rows.append((i, lo, seen, hashes))
                yield _merge_decided(rows, w, k1, k2, number)

    return run


def _merge_decided(rows, w: Windows, k1: np.ndarray, k2: np.ndarray, number: np.ndarray) -> pa.RecordBatch:
    """Rows to Arrow.  Decided runs carry no hashes; those that touch become one row with a random-like key."""
    key, a, b, at, seen, hashes = [], [], [], [], [], []
    held = None  # (number, first word, bytes)

    def flush():
        if held is not None:
            n, first, s = held
            key.append(int(np.int64(k1[n]) ^ np.int64(first)))
            a.append(int(k1[n])), b.append(int(k2[n])), at.append(first), seen.append(s), hashes.append(None)

    for i, lo, s, h in rows:
        n, first = int(number[i]), int(w.word[lo])
        if h is None:
            if held is not None and held[0] == n and held[1] + len(held[2]) == first:
                held = (n, held[1], held[2] + s)
            else:
                flush()
                held = (n, first, s)
        else:
            key.append(int(w.anchor[lo].view("int64")))
            a.append(int(k1[n])), b.append(int(k2[n])), at.append(first), seen.append(s), hashes.append(h)
    flush()
    return pa.RecordBatch.from_arrays(
        [pa.array(key, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(at, pa.int32()),
         pa.array(seen, pa.binary()), pa.array(hashes, pa.binary())], names=["key", "k1", "k2", "at", "seen", "hashes"])


def key_pieces(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[pa.Table, bool]]:
    """Rows sorted by ``key``: tables of whole keys (False), and pieces of a key with over ``limit`` rows (True).

    Holds at most ``limit`` rows of a key and two batches.
    """
    held: list[pa.RecordBatch] = []
    n_held, last, split = 0, None, False
    for b in batches:
        key = b.column(0).to_numpy()
        if split and len(key):
            more = int(np.searchsorted(key, last, "right"))
            if more:
                yield pa.Table.from_batches([b.slice(0, more)]), True
            b, key = b.slice(more), key[more:]
        if not len(key):
            continue
        split = False
        if held and last != key[0]:
            yield pa.Table.from_batches(held), False
            held, n_held = [], 0
        last = key[-1]
        cut = int(np.searchsorted(key, last))  # first row of the last key
        if cut:
            yield pa.Table.from_batches([*held, b.slice(0, cut)]), False
            held, n_held = [], 0
        held.append(b.slice(cut))
        n_held += b.num_rows - cut
        if n_held > limit:
            yield pa.Table.from_batches(held), True
            held, n_held, split = [], 0, True
    if held:
        yield pa.Table.from_batches(held), False


FOUND = "k1 long, k2 long, first int, last int, alone long, low long"


def _count(width: int, key_rows: int):
    """Runs sorted by anchor to (k1, k2, first, last) intervals of repeated windows' words.

    Rows with ``alone`` are single windows of a key with too many runs, not counted yet.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, split in key_pieces(batches, key_rows):
            key = t.column("key").to_numpy()
            k1, k2, at = (t.column(c).to_numpy() for c in ("k1", "k2", "at"))
            seen = [np.frombuffer(s, "u1") for s in t.column("seen").to_pylist()]
            raw = t.column("hashes").to_pylist()
            size = np.array([len(s) for s in seen], "int64")
            row = np.repeat(np.arange(len(key)), size)
            begin = np.cumsum(size) - size
            flag = np.concatenate(seen) > 0
            counted = np.repeat(np.array([r is not None for r in raw]), size)
            h = np.zeros(len(row), "uint64")
            h[counted] = np.concatenate([_unpack48(r) for r in raw if r is not None] or [np.empty(0, "uint64")])
            if split:
                look = np.flatnonzero(counted)
                r, word = row[look], at[row[look]] + (look - begin[row[look]])
                alone = _mix(key[r].view("uint64") ^ h[look]).view("int64")
                yield _found(k1[r], k2[r], word, word + width, alone, h[look].view("int64"))
            else:
                # only anchors met in two rows, or windows marked, can repeat
                often = np.r_[False, key[1:] == key[:-1]]
                often = often | np.r_[often[1:], False]
                look = np.flatnonzero(counted & often[row])
                flag[look] |= _repeated(h[look], key[row[look]].view("uint64"))
            hit = np.flatnonzero(flag)
            if not len(hit):
                continue
            word = at[row[hit]] + (hit - begin[row[hit]])
            cut = np.flatnonzero(np.r_[True, (row[hit][1:] != row[hit][:-1]) | (word[1:] > word[:-1] + 1)])
            last = np.r_[cut[1:], len(hit)] - 1
            r = row[hit[cut]]
            yield _found(k1[r], k2[r], word[cut], word[last] + width)

    return run


def _found(k1, k2, first, last, alone=None, low=None) -> pa.RecordBatch:
    none = pa.nulls(len(k1), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(first.astype("int32")), pa.array(last.astype("int32")),
         none if alone is None else pa.array(alone), none if low is None else pa.array(low)],
        names=["k1", "k2", "first", "last", "alone", "low"])


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Intervals, and of the single windows (sorted by ``alone``, ``low``) those that occur twice; holds one row."""
    tail, sent = None, False
    for b in batches:
        keep = ["k1", "k2", "first", "last"]
        single = b.filter(b.column("alone").is_valid())
        if single.num_rows < b.num_rows:
            yield b.filter(b.column("alone").is_null()).select(keep)
        if not single.num_rows:
            continue
        t = pa.Table.from_batches([single] if tail is None else [tail, single]).combine_chunks()
        alone, low = t.column("alone").to_numpy(), t.column("low").to_numpy()
        same = (alone[1:] == alone[:-1]) & (low[1:] == low[:-1])
        twice = np.r_[same, False] | np.r_[False, same]
        out = twice.copy()
        out[0] &= tail is None or not sent
        yield from t.filter(pa.array(out)).select(keep).to_batches()
        tail, sent = t.slice(len(t) - 1).to_batches()[0], bool(twice[-1])


def repeated_intervals(docs: DataFrame, id_col: str, text_col: str, width: int, key_rows: int = KEY_ROWS) -> DataFrame:
    """(k1, k2, spans): per text with repeats, intervals [first, last) of words; their union is what goes."""
    rows = docs.select(*content_key(id_col, text_col), F.col(text_col).alias("t")).mapInArrow(
        sliced(_send(width, hot_anchors(docs, id_col, text_col, width))), RUNS)
    found = rows.repartition("key").sortWithinPartitions("key").mapInArrow(_count(width, key_rows), FOUND)
    met = (found.repartition(F.coalesce("alone", F.xxhash64("k1", "k2"))).sortWithinPartitions("alone", "low")
           .mapInArrow(_settle, "k1 long, k2 long, first int, last int"))
    spans = F.collect_set(F.struct("first", "last"))
    return met.groupBy("k1", "k2").agg(spans.alias("spans"))


def _cut(kept_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_columns - 2
            total, removed, digest, kept = [], [], [], []
            spans = b.column(n + 1)
            for i, text in enumerate(b.column(n).to_pylist()):
                words = words_of(text)
                total.append(len(words))
                if spans[i].is_valid and len(spans[i]):
                    v = spans[i].values
                    keep = np.zeros(len(words) + 1, "int64")
                    np.add.at(keep, v.field(0).to_numpy(), 1)
                    np.add.at(keep, v.field(1).to_numpy(), -1)
                    words = [words[j] for j in np.flatnonzero(np.cumsum(keep[:-1]) == 0).tolist()]
                removed.append(total[-1] - len(words))
                joined = b" ".join(words)
                digest.append(hashlib.sha256(joined).hexdigest())
                if kept_text:
                    kept.append(joined.decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(n)), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string()),
                 *([pa.array(kept, pa.string())] if kept_text else [])],
                names=[*b.schema.names[:n], "n_words", "n_removed", "kept_sha256", *(["kept"] if kept_text else [])])

    return run


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 35,
                 kept_text: bool = False, key_rows: int = KEY_ROWS) -> DataFrame:
    """Per row: the id, n_words, n_removed, kept_sha256 and, on request, the kept text.

    A word goes if a ``width``-word window that covers it also starts somewhere else
    (same text included; judged on the input).  Kept words are joined by one
    space.  Null and empty texts have no words.  Repeated rows are texts of
    their own: from ``width`` words on they remove each other.  Extra columns are ignored.
    ``key_rows`` bounds the runs of one anchor that a task holds, not the result.
    """
    if width < 1:
        raise ValueError("a window has at least one word")
    spans = repeated_intervals(docs, id_col, text_col, width, key_rows)
    k1, k2 = content_key(id_col, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), k1, k2, F.col(text_col).alias("t"))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string" + ", kept string" * kept_text
    return (rows.join(spans, ["k1", "k2"], "left").select("doc_id", "t", "spans")
            .mapInArrow(sliced(_cut(kept_text)), schema))
