"""Quality rules with suffix-array repetition.

Every text's words get a suffix array (prefix doubling, vectorised over a run of
whole documents).  Neighbouring suffixes' longest common prefixes form LCP
intervals; an interval of ``window`` or more words is a repeated substring, maximal
where the words before its occurrences differ.  The verdict limits two figures of
the maximal ones: the share of the text that the union of their occurrences covers
(those with ``least_times`` occurrences, or of more than ``twice_chars`` characters: a
line said twice is no boilerplate) and the longest.  No shuffle: a document is judged alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import SPACE_CHARS, free_name, sliced, words_of

#: Characters counted as symbols (fixed values).
SYMBOLS = "#*$%&|<>"

#: Words of whole documents worked on together in a task (a longer text alone).
RUN_WORDS = 150_000


@dataclass(frozen=True)
class Rules:
    """Limits of the verdict.

    base: fewer than ``min_words`` words, or more than ``max_repeat_pct`` % of the
    words in repeated ``window``-word windows.  Method: the union of the maximal
    repeats with ``least_times`` or more occurrences, or of more than ``twice_chars``
    characters of words (a line of text), may cover at most ``max_covered`` of the words' characters, and the longest
    maximal repeat of ``long_words`` words or more may have at most ``max_longest``
    of the words: one short echo never rejects a text.  Both lie below what a text
    at the base limit has (30 % covered, so 15 % the longest of two separate
    occurrences): the method rejects texts that the base keeps.
    """

    min_words: int = 20
    window: int = 8
    max_repeat_pct: int = 30
    max_covered: float = 0.2
    max_longest: float = 0.1
    long_words: int = 16
    least_times: int = 3
    twice_chars: int = 80


def suffix_array(words: np.ndarray, doc: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix order of several documents at once, and the rank levels.

    ``words``: integer codes; ``doc``: document of each position; ``end``: first
    position after that document.  Level ``k`` ranks suffixes by document and
    their first ``2**k`` words; equal ranks mean equal words, all inside the
    document.  Only suffixes that still tie are sorted again.
    """
    n = len(words)
    key = doc.astype("int64") * (int(words.max(initial=0)) + 1) + words
    order = np.argsort(key, kind="stable")
    rank = _ranks(order, key)
    levels, h = [rank], 1
    at = np.arange(n)
    while True:
        size = np.bincount(rank, minlength=n)
        tied = np.flatnonzero(size[rank] > 1)
        if not len(tied):
            return order, levels
        nxt = np.where(at[tied] + h < end[tied], rank[np.minimum(tied + h, n - 1)] + 1, 0)
        by = np.lexsort((nxt, rank[tied]))
        tied, nxt = tied[by], nxt[by]
        first = rank[tied]
        new_group = np.r_[True, first[1:] != first[:-1]]
        new_key = new_group | np.r_[True, nxt[1:] != nxt[:-1]]
        start = np.maximum.accumulate(np.where(new_group, np.arange(len(tied)), 0))
        step = np.maximum.accumulate(np.where(new_key, np.arange(len(tied)), 0))
        place = first + np.arange(len(tied)) - start
        order[place] = tied
        rank = rank.copy()
        rank[tied] = first + step - start
        levels.append(rank)
        h *= 2


def _ranks(order: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Rank of each suffix: the place of the first suffix with its key."""
    k = key[order]
    head = np.r_[True, k[1:] != k[:-1]]
    rank = np.empty(len(order), "int64")
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))
    return rank


def neighbour_lcp(order: np.ndarray, levels: list[np.ndarray], end: np.ndarray) -> np.ndarray:
    """LCP of each suffix with the one before it in the order (first: 0)."""
    n = len(order)
    lcp = np.zeros(n, "int64")
    live = np.flatnonzero(np.r_[False, levels[0][order[1:]] == levels[0][order[:-1]]]) if n else np.empty(0, "int64")
    a, b = order[live - 1].copy(), order[live].copy()
    for k in range(len(levels) - 1, -1, -1):
        inside = (a < end[order[live - 1]]) & (b < end[order[live]])
        same = inside & (levels[k][np.minimum(a, n - 1)] == levels[k][np.minimum(b, n - 1)])
        lcp[live[same]] += 1 << k
        a[same] += 1 << k
        b[same] += 1 << k
    return lcp


def lcp_intervals(lcp: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(first, last, length) of the LCP intervals of at least ``least`` words."""
    found, stack = [], []
    for i in np.flatnonzero(np.r_[lcp >= least, False] | np.r_[False, lcp >= least]).tolist():
        v = int(lcp[i]) if i < len(lcp) else 0
        v = v if v >= least else 0
        left = i - 1
        while stack and stack[-1][1] > v:
            left, length = stack.pop()
            found.append((left, i - 1, length))
        if v and (not stack or stack[-1][1] < v):
            stack.append((left, v))
    return found


def innermost(intervals: list[tuple[int, int, int]], n: int) -> np.ndarray:
    """Length of the innermost interval around each of ``n`` suffixes (none: 0).

    ``intervals`` are nested or apart, inner ones first.  Every suffix is set once:
    an outer interval jumps over those inside it.
    """
    reach = np.zeros(n, "int64")
    after = {}
    for lo, hi, length in intervals:
        i = lo
        while i <= hi:
            j = after.get(i)
            if j is None:
                reach[i] = length
                i += 1
            else:
                i = j
        after[lo] = hi + 1
    return reach


def _covered(reach: np.ndarray) -> np.ndarray:
    """Words in the union of the spans [i, i + reach[i])."""
    edge = np.zeros(len(reach) + 1, "int64")
    starts = np.flatnonzero(reach)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + reach[starts], -1)
    return np.flatnonzero(np.cumsum(edge[:-1]) > 0)


def _longer(words: list[bytes], limit: int) -> bool:
    """Whether words have more than ``limit`` characters together (each has one at least)."""
    return len(words) > limit or sum(len(w.decode("utf-8", "replace")) for w in words) > limit


def repeats(texts: list[list[bytes]], window: int, least_times: int = 3, twice_chars: int = 80) -> pd.DataFrame:
    """Per text: words in repeated windows, characters the counted repeats cover, longest and number of maximal repeats."""
    count = np.array([len(t) for t in texts], "int64")
    out = {k: np.zeros(len(texts), "int64") for k in ("covered", "covered_chars", "longest", "n_maximal")}
    flat = [w for t in texts for w in t]
    if not flat:
        return pd.DataFrame(out)
    codes = pd.factorize(np.array(flat, dtype=object))[0].astype("int64")
    doc = np.repeat(np.arange(len(texts)), count)
    end = np.repeat(np.cumsum(count), count)
    order, levels = suffix_array(codes, doc, end)
    found = lcp_intervals(neighbour_lcp(order, levels, end), window)
    if not found:
        return pd.DataFrame(out)
    reach = np.zeros(len(flat), "int64")
    reach[order] = innermost(found, len(flat))
    np.add.at(out["covered"], doc[_covered(reach)], 1)
    # maximal: some occurrence has another word before it, so the repeat cannot be widened to the left
    before = np.where((order > 0) & (doc[order] == doc[order - 1]), codes[order - 1], -1)
    change = np.cumsum(np.r_[0, (before[1:] != before[:-1]) | (before[1:] < 0)])
    counted = []
    for lo, hi, length in found:
        if change[hi] > change[lo]:
            d = doc[order[lo]]
            out["n_maximal"][d] += 1
            out["longest"][d] = max(out["longest"][d], length)
            if hi - lo + 1 >= least_times or _longer(flat[order[lo]:order[lo] + length], twice_chars):
                counted.append((lo, hi, length))
    reach[order] = innermost(counted, len(flat))
    hit = _covered(reach)
    chars = np.array([len(flat[i].decode("utf-8", "replace")) for i in hit.tolist()], "int64")
    np.add.at(out["covered_chars"], doc[hit], chars)
    return pd.DataFrame(out)


def text_facts(texts: list[str | None], rules: Rules) -> pd.DataFrame:
    """Counts of every text: words, characters, symbols, lines and repeats."""
    words = [words_of(t) for t in texts]
    size = [len(w) for w in words]
    got, lo = [], 0
    while lo < len(texts):
        hi, total = lo + 1, size[lo]
        while hi < len(texts) and total + size[hi] <= RUN_WORDS:
            total += size[hi]
            hi += 1
        got.append(repeats(words[lo:hi], rules.window, rules.least_times, rules.twice_chars))
        lo = hi
    facts = pd.concat(got, ignore_index=True) if got else repeats([], rules.window)
    facts["n_words"] = np.array(size, "int64")
    facts["word_chars"] = np.array([0 if t is None else len(t) - sum(map(t.count, SPACE_CHARS)) for t in texts], "int64")
    facts["n_symbols"] = np.array([0 if t is None else sum(map(t.count, SYMBOLS)) for t in texts], "int64")
    facts["n_dup_lines"] = np.array([_dup_lines(t) for t in texts], "int64")
    return facts


def _dup_lines(text: str | None) -> int:
    if text is None or "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(SPACE_CHARS)]
    return len(lines) - len(set(lines))


def verdict(facts: pd.DataFrame, rules: Rules) -> pd.DataFrame:
    """Adds base_failed and kept."""
    n = facts["n_words"]
    base = (n < rules.min_words) | (100 * facts["covered"] > rules.max_repeat_pct * n)
    spread = facts["covered_chars"] > rules.max_covered * facts["word_chars"]
    longest = (facts["longest"] >= rules.long_words) & (facts["longest"] > rules.max_longest * n)
    return facts.assign(base_failed=base, kept=~(base | spread | longest))


#: Output columns beside the row's own (after n_words ... n_repeat_words).
FACTS = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long",
         "n_repeat_words": "long", "repeat_chars": "long", "longest_repeat": "long", "n_maximal_repeats": "long",
         "base_failed": "boolean", "kept": "boolean"}


def quality(docs: DataFrame, text_col: str = "text", rules: Rules = Rules(),
            keep_cols: list[str] | None = None) -> DataFrame:
    """``keep_cols`` of ``docs`` (default: all) with the facts and the verdict in a struct ``quality``.

    A null or empty text has no words and fails the base rule.  Repeated rows
    are judged alike; nothing is dropped here.  The struct's name gets
    underscores when the input has that column.
    """
    cols = docs.columns if keep_cols is None else keep_cols
    name = free_name(docs, "quality")
    at = docs.columns.index(text_col)
    inner = ", ".join(f"{k}: {v}" for k, v in FACTS.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            facts = verdict(text_facts(b.column(len(cols)).to_pylist(), rules), rules)
            facts = facts.rename(columns={"covered": "n_repeat_words", "covered_chars": "repeat_chars",
                                          "longest": "longest_repeat", "n_maximal": "n_maximal_repeats"})
            q = pa.StructArray.from_arrays([pa.array(facts[k].values) for k in FACTS], names=list(FACTS))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(cols))), q], names=[*cols, name])

    src = docs.select(*cols, F.col(docs.columns[at]).alias(free_name(docs, "_text")))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*cols).schema)
    return src.mapInArrow(sliced(run), f"{kinds}, {name} struct<{inner}>")


def keep_good(docs: DataFrame, text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with its own columns."""
    q = quality(docs, text_col, rules)
    return q.where(F.col(f"{q.columns[-1]}.kept")).select(*docs.columns)
