"""Plain single-machine versions of the operators, for comparison on small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from itertools import combinations, product

import xxhash

WORD = re.compile("[^\x20\x09-\x0D]+")


def words(text):
    return [] if text is None else WORD.findall(text)


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words by the definitions."""
    w = words(text)
    windows = defaultdict(list)
    for i in range(len(w) - 7):
        windows[tuple(w[i:i + 8])].append(i)
    hit = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(hit)


def longest_repeat(w, least):
    """Longest word sequence that starts at two places (0 below ``least``), words covered by such sequences."""
    best, hit = 0, set()
    for i in range(len(w)):
        for j in range(i):
            n = 0
            while i + n < len(w) and w[i + n] == w[j + n]:
                n += 1
            if n >= least:
                best = max(best, n)
                hit |= set(range(i, i + n)) | set(range(j, j + n))
    return best, hit


def maximal_repeats(w, least):
    """Word sequences of ``least`` or more words at two or more places that no word before or after all of them widens: {sequence: places}."""
    found = {}
    for n in range(least, len(w)):
        places = {}
        for i in range(len(w) - n + 1):
            places.setdefault(tuple(w[i:i + n]), []).append(i)
        for seq, at in places.items():
            before = {w[i - 1] if i else (i,) for i in at}
            after = {w[i + n] if i + n < len(w) else (i,) for i in at}
            if len(at) > 1 and len(before) > 1 and len(after) > 1:
                found[seq] = at
    return found


def simhash(text, shingle=4):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text)) if text is not None else []
    if not w:
        return 0
    parts = [" ".join(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1))]
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(items, linked):
    """items: (id, value); the smallest id reachable over linked values."""
    items = list(items)
    root = list(range(len(items)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in combinations(range(len(items)), 2):
        if linked(items[i][1], items[j][1]):
            root[find(i)] = find(j)
    low = {}
    for i, (k, _) in enumerate(items):
        low[find(i)] = min(low.get(find(i), k), k)
    return [low[find(i)] for i in range(len(items))]


def window_dedup(texts, width):
    """(n_words, n_removed, kept_sha256) of each text."""
    split = [words(t) for t in texts]
    count = Counter(tuple(w[i:i + width]) for w in split for i in range(len(w) - width + 1))
    out = []
    for w in split:
        gone = {j for i in range(len(w) - width + 1) if count[tuple(w[i:i + width])] > 1 for j in range(i, i + width)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def repair_cost(roles, empty, costs):
    """Least cost over every choice of moves (exhaustive)."""
    steps = {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    best = None
    for choice in product(("system", "user", "assistant", "merge"), (0, 1), repeat=len(roles)):
        cost, state, ok = 0, "", True
        for i, role in enumerate(roles):
            what, insert = choice[2 * i], choice[2 * i + 1]
            change = lambda to: 0 if to == role else (costs["relabel" if role in steps and role else "relabel_unknown"]
                                                      + costs["to_system"] * (to == "system"))
            if what == "merge":
                ok &= state != "" and not insert
                if not ok:
                    break
                cost += costs["merge_system"] if state == "system" and role != "system" else costs["merge"]
                cost += 0 if empty[i] else change(state)
                continue
            if insert:
                via = [s for s in steps[state] if s != "system" and what in steps[s]]
                ok &= bool(via)
                cost += costs["insert"]
            else:
                ok &= what in steps[state]
            if not ok:
                break
            cost, state = cost + change(what), what
        if ok and (best is None or cost < best):
            best = cost
    return best
