"""Secret scan: keyword, key-id and hex rules, and sliding-window entropy.

``find_secrets`` lists the spans of every whole text.  Three pattern rules come
first (``assign``, ``access``, ``hex``).  The entropy rule then takes candidate
strings (runs of key characters), slides a window over each and keeps the count
of every character in it: a step changes two counts, so the sum of c*log2(c) and
with it the Shannon entropy follow in constant time.  The characters in the window
decide its class; windows that reach the class's entropy are merged into spans.
Candidates that the allow list knows (ids, digests, alphabets, placeholders) give
no entropy span; spans of the pattern rules are never suppressed.

Rows are independent: no shuffle, one text at a time in a Python task.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from math import log2

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import free_name

#: The pattern rules, in the order in which spans of one start are listed; fixed values.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run is found whole, so the length may stand in the pattern

#: Candidate strings of the entropy rule: as long as a window at least.
KEY_CHARS = "A-Za-z0-9+/_=-"

#: Least entropy in bits by the class of a window of 20 characters (at most log2(20) = 4.32).
#: Digits alone and words (letters with dashes or slashes, no digit) are no class.
LEAST_BITS = {"hex": 3.0, "one_case": 4.1, "two_case": 4.1, "alnum": 3.7, "base64": 3.9}

#: Candidates that are no secrets: UUIDs, dates and times, named digests, placeholders, paths of words.
ALLOW = (
    r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}",
    r"\d{4}-\d\d-\d\d(?:[T_ -][0-9-]*Z?)?",
    r"(?i:sha(?:1|224|256|384|512)|md5)[-=_].*",
    r"(?i:.*(?:example|sample|placeholder|changeme|dummy|redacted|your[_-]).*)",
    r"(?:[A-Za-z]+\d{0,4}[/_=+-]+)+[A-Za-z]*\d{0,4}",
)

Span = tuple[int, int, int]  # start, place in KINDS, end


def rule_spans(text: str) -> list[Span]:
    """Spans of the pattern rules: leftmost and non-overlapping per kind, too short matches dropped."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def in_sequence(s: str) -> bool:
    """Whether most neighbours are consecutive characters or equal (alphabets, counters, fillers)."""
    return sum(0 <= ord(b) - ord(a) <= 1 for a, b in zip(s, s[1:])) * 2 > len(s) - 1


def _kind(digits: int, lower: int, upper: int, signs: int, beyond_f: int) -> str | None:
    """Class of a window from its counts of digits, letters by case, signs and letters after f."""
    letters = lower + upper
    if not letters:
        return None
    if signs:
        return "base64" if digits and lower and upper else None
    if not digits:
        return "two_case" if lower and upper else "one_case"
    if not beyond_f and not (lower and upper):
        return "hex"
    return "alnum"


def window_spans(s: str, window: int, least: dict[str, float]) -> list[tuple[int, int]]:
    """Merged windows of ``s`` whose entropy reaches the bits of their class."""
    if len(s) < window:
        return []
    term = [0.0] + [c * log2(c) for c in range(1, window + 1)]
    count: dict[str, int] = {}
    held = [0, 0, 0, 0, 0]  # digits, lower, upper, signs, letters after f
    total, out = 0.0, []

    def groups(c: str) -> tuple[int, ...]:
        if c.isdigit():
            return (0,)
        if not c.isalpha():
            return (3,)
        return (1 if c >= "a" else 2, 4) if c.lower() > "f" else (1 if c >= "a" else 2,)

    where = {c: groups(c) for c in set(s)}
    for i, c in enumerate(s):
        if i >= window:  # the character that leaves
            old = s[i - window]
            n = count[old]
            count[old] = n - 1
            total += term[n - 1] - term[n]
            for g in where[old]:
                held[g] -= 1
        n = count.get(c, 0)
        count[c] = n + 1
        total += term[n + 1] - term[n]
        for g in where[c]:
            held[g] += 1
        if i >= window - 1:
            kind = _kind(*held)
            if kind is not None and log2(window) - total / window >= least[kind] - 1e-9:
                lo = i - window + 1
                if out and lo <= out[-1][1]:
                    out[-1] = (out[-1][0], i + 1)
                else:
                    out.append((lo, i + 1))
    return out


class Scanner:
    """The rules with their parameters, compiled once per task."""

    def __init__(self, window: int = 20, least: dict[str, float] | None = None, allow: Sequence[str] = ALLOW):
        if window < 2:
            raise ValueError("a window has at least two characters")
        self.window = window
        self.least = {**LEAST_BITS, **(least or {})}
        self.candidate = re.compile(f"[{KEY_CHARS}]{{{window},}}")
        self.allow = [re.compile(a) for a in allow]

    def entropy_spans(self, text: str) -> Iterable[Span]:
        for m in self.candidate.finditer(text):
            s = m.group()
            got = window_spans(s, self.window, self.least)
            if got and not any(a.fullmatch(s) for a in self.allow):
                for lo, hi in got:
                    if not in_sequence(s[lo:hi]):
                        yield m.start() + lo, 3, m.start() + hi

    def spans(self, text: str | None) -> list[Span]:
        """All spans by start, then kind; entropy spans inside a span of another rule are left out."""
        if not text:
            return []
        found = rule_spans(text)
        more = [e for e in self.entropy_spans(text) if not any(r[0] <= e[0] and e[2] <= r[2] for r in found)]
        return sorted(found + more)


def redact(text: str | None, spans: list[Span], mark: str = "[SECRET]") -> str | None:
    """``text`` with every maximal run of overlapping spans replaced by ``mark``."""
    if text is None or not spans:
        return text
    out, at = [], 0
    for lo, _, hi in spans:
        if lo >= at:
            out += [text[at:lo], mark]
        at = max(at, hi)
    return "".join([*out, text[at:]])


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def find_secrets(docs: DataFrame, text_col: str = "text", keep_cols: Sequence[str] = ("doc_id",), window: int = 20,
                 least: dict[str, float] | None = None, allow: Sequence[str] = ALLOW,
                 redacted: bool = False) -> DataFrame:
    """``keep_cols`` and ``spans`` (array of kind, start, end: code points, end exclusive) of every row.

    With ``redacted`` also the text with its spans replaced.  Names that clash with
    ``keep_cols`` get underscores.  Null and empty texts have no spans (a null stays
    null when redacted); repeated rows each get their spans; very long texts are
    scanned whole, one at a time; an empty table gives an empty result.
    """
    kept = docs.select(*keep_cols)
    name, clear = free_name(kept, "spans"), free_name(kept, "redacted")
    n = len(keep_cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scanner(window, least, allow)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                b = batch.slice(at, 512)
                texts = b.column(n).to_pylist()
                spans = [scan.spans(t) for t in texts]
                cols = [pa.array([[{"kind": KINDS[k], "start": lo, "end": hi} for lo, k, hi in x] for x in spans], SPANS)]
                if redacted:
                    cols.append(pa.array([redact(t, x) for t, x in zip(texts, spans)], pa.string()))
                yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(n)), *cols],
                                                 names=[*keep_cols, name, *([clear] if redacted else [])])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema)
    out = f"{kinds}`{name}` array<struct<kind:string,start:int,end:int>>" + f", `{clear}` string" * redacted
    return docs.select(*keep_cols, F.col(text_col).alias(free_name(kept, "_text"))).mapInArrow(run, out)


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined (none: empty text)."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
