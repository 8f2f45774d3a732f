"""Conversation prefix trie by burst containers.

Conversations are sequences of turns (role, text); every distinct prefix is a node,
from the textless root.  ``prefix_trie`` gives the nodes with their members, children,
leaves and the code points that sharing saves, and which conversations end where.

Method.  A turn becomes a hash of its place and content, a prefix the XOR of its turns'
hashes (128 bits), so prefixes of one conversation are a running XOR and a long
conversation is cut into bands of ``band`` turns that no task has to hold together.
Conversations that agree in a band under the same head become one entry with a weight.
Entries are suffixes in a container under a trie head (first the band's own head).
A container of over ``room`` entries bursts: its head becomes a node of its own, and
its entries go on by their next turn id into containers under the child heads.  The
other containers are sorted and swept into nodes with a stack of one path.

Saved code points of a subtree without walking it: a node's smallest member owns it, and a
conversation owns a lower stretch of its path.  With A(c) = the code points on c's path
above that stretch, the sum over a node's members of A(c), less that of the smallest
member and less (members - 1) times the code points before the node, is what its
subtree saves.  A leaf likewise counts for the one conversation that owns it.  So every
figure of a node is a sum over its members, and entries carry them as totals.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import grouped_batches, staged
from barloom.plans.frame import sequence

#: Bands of a conversation whose running XOR is one window; more are carried from group to group.
GROUP_BANDS = 1024
#: Broadcast the burst heads up to so many rows (some 100 bytes each), else join them salted.
BROADCAST_HEADS = 100_000
SALTS = 16
#: Ids joined into one piece of a node's list before it is hashed.
LIST_IDS = 50_000

NONE = 1 << 62


@dataclass(frozen=True)
class Trie:
    """``nodes``: node (depth and 128-bit key as text), depth, conv_id, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens.  ``ends``: node, conv_id of each conversation that ends there."""

    nodes: DataFrame
    ends: DataFrame


# ------------------------------------------------------------------------ turns
def number_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """(conv, rn, t1, t2, cp): turns in order of turn (null first), equal turns by role and text.

    Rows without a conversation id belong to none and are left out; repeated rows are
    turns of their own; a null role or text is the empty one.  ``t1, t2`` identify role
    and text, ``cp`` are the text's code points.  No task holds a long conversation.
    """
    rows = conversations.select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    frame = sequence(rows.where(F.col("conv").isNotNull()), key="conv", order=("turn", "role", "text"))
    return frame.df.select("conv", "rn", F.xxhash64("role", "text").alias("t1"),
                           F.xxhash64(F.lit(0x5EED), "role", "text").alias("t2"), F.length("text").cast("long").alias("cp"))


def share_heads(turns: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """Rebuild every conversation c: the first h turns of c - c % every, then its own after its first h.

    h is the unsigned crc32 of c's decimals modulo ``most``.  Fewer or no turns there give
    fewer; ``%`` keeps the sign of c.  Rows are (conv, part, at, t1, t2, cp): part 0 the head, 1 its own
    turns, 2 one end mark (null ids), so a conversation without turns still has a row.
    """
    own = F.crc32(F.col("conv").cast("string")) % most
    convs = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).select(
        "conv", own.alias("h"), (F.col("conv") - F.col("conv") % every).alias("base"))
    heads = (turns.where((F.col("conv") % every == 0) & (F.col("rn") < most)).groupBy(F.col("conv").alias("base"))
             .agg(F.array_sort(F.collect_list(F.struct("rn", "t1", "t2", "cp"))).alias("head")))
    head = (convs.join(heads, "base").select("conv", F.explode(F.slice("head", F.lit(1), F.col("h").cast("int"))).alias("e"))
            .select("conv", F.lit(0).alias("part"), F.col("e.rn").alias("at"), "e.t1", "e.t2", "e.cp"))
    rest = turns.where(F.col("rn") > own).select("conv", F.lit(1).alias("part"), F.col("rn").alias("at"), "t1", "t2", "cp")
    return head.union(rest).union(_end_marks(convs))


def _end_marks(convs: DataFrame) -> DataFrame:
    none = F.lit(None).cast("long")
    return convs.select("conv", F.lit(2).alias("part"), F.lit(0).cast("long").alias("at"), none.alias("t1"),
                        none.alias("t2"), none.alias("cp"))


def whole_turns(turns: DataFrame) -> DataFrame:
    """The conversations as they are, in the form of :func:`share_heads`."""
    return turns.select("conv", F.lit(1).alias("part"), F.col("rn").alias("at"), "t1", "t2", "cp").union(
        _end_marks(turns.select("conv").distinct()))


# ------------------------------------------------------------------------ bands
def cut_bands(steps: DataFrame, band: int) -> DataFrame:
    """(conv, band, elems, y1, y2, h1, h2, p, seg): a row per conversation and band.

    ``elems`` are up to ``band`` + 1 turns (pos, e1, e2, cp; an end mark has cp -1): the last may be
    the next band's first, so a band's deepest nodes see their children.  ``h`` is the
    key of the prefix before the band, ``p`` its code points, ``y`` the key with all
    elements, ``seg`` the code points of the band's own turns.
    """
    rows = sequence(steps, key="conv", order=("part", "at")).df
    pos, end = F.col("rn"), F.col("t1").isNull()
    home = F.floor((pos - 1) / band).cast("long")
    first = (pos > 1) & ((pos - 1) % band == 0)
    e = rows.select(
        "conv", pos.alias("pos"), F.xxhash64(pos, end, "t1", "t2").alias("e1"),
        F.xxhash64(F.lit(0x5EED), pos, end, "t1", "t2").alias("e2"), F.when(end, F.lit(-1)).otherwise(F.col("cp")).alias("cp"),
        home.alias("home"), F.explode(F.when(first, F.array(home, home - 1)).otherwise(F.array(home))).alias("band"))
    core = F.col("home") == F.col("band")
    pieces = e.groupBy("conv", "band").agg(
        F.array_sort(F.collect_list(F.struct("pos", "e1", "e2", "cp"))).alias("elems"),
        F.bit_xor("e1").alias("y1"), F.bit_xor("e2").alias("y2"),
        F.bit_xor(F.when(core, F.col("e1"))).alias("x1"), F.bit_xor(F.when(core, F.col("e2"))).alias("x2"),
        F.sum(F.when(core & (F.col("cp") > 0), F.col("cp")).otherwise(0)).alias("seg"))
    pieces = staged(pieces, "bands")
    # heads: the running XOR over the earlier bands of conversations that go on
    on = (pieces.where((F.size("elems") == band + 1)).select("conv", "band", "x1", "x2", "seg")
          .withColumn("g", F.floor(F.col("band") / GROUP_BANDS)))
    inside = Window.partitionBy("conv", "g").orderBy("band").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv").orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    totals = (on.groupBy("conv", "g").agg(F.bit_xor("x1").alias("g1"), F.bit_xor("x2").alias("g2"), F.sum("seg").alias("gs"))
              .select("conv", "g", *[F.coalesce(f(c).over(before), F.lit(0)).alias(c)
                                     for f, c in ((F.bit_xor, "g1"), (F.bit_xor, "g2"), (F.sum, "gs"))]))
    heads = on.join(totals, ["conv", "g"]).select(
        "conv", (F.col("band") + 1).alias("band"),
        F.bit_xor("x1").over(inside).bitwiseXOR(F.col("g1")).alias("h1"),
        F.bit_xor("x2").over(inside).bitwiseXOR(F.col("g2")).alias("h2"), (F.sum("seg").over(inside) + F.col("gs")).alias("p"))
    zero = F.lit(0).cast("long")
    return (pieces.drop("x1", "x2").join(heads, ["conv", "band"], "left")
            .withColumns({c: F.coalesce(c, zero) for c in ("h1", "h2", "p")})
            .withColumns({"y1": F.col("y1").bitwiseXOR(F.col("h1")), "y2": F.col("y2").bitwiseXOR(F.col("h2"))}))


ENTRY = ["band", "y1", "y2"]
HEAD = ["band", "k1", "k2"]


def collapse(pieces: DataFrame) -> DataFrame:
    """One entry per head and content, with its members' number ``n`` and smallest id ``rep``, under the band's head."""
    return (pieces.groupBy(*ENTRY).agg(
        F.count(F.lit(1)).alias("n"), F.min("conv").alias("rep"), F.first("elems").alias("elems"),
        F.first("h1").alias("k1"), F.first("h2").alias("k2"), F.first("p").alias("p"), F.first("seg").alias("seg"))
        .withColumns({"own": F.col("band") == 0, "up": F.lit(None).cast("long"), "head_cp": F.lit(0).cast("long"),
                      "acc": F.lit(0).cast("long")}))


# ------------------------------------------------------------------------ burst
def _attach(live: DataFrame, big: DataFrame, n_big: int) -> DataFrame:
    """Join the burst heads to their entries; a head holds many entries, so beyond the broadcast it is salted."""
    if n_big <= BROADCAST_HEADS:
        return live.join(F.broadcast(big), HEAD, "left")
    salted = big.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    return (live.withColumn("salt", F.pmod(F.xxhash64(*ENTRY), F.lit(SALTS)).cast("int"))
            .join(salted, [*HEAD, "salt"], "left").drop("salt"))


@dataclass
class Burst:
    """What bursting leaves: containers to sweep, entries that end at a burst head, burst nodes' entries and children."""

    containers: DataFrame
    ended: DataFrame | None
    members: DataFrame | None
    children: DataFrame | None


def _all(parts: list[DataFrame]) -> DataFrame | None:
    out = parts[0] if parts else None
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def burst(entries: DataFrame, band: int, room: int) -> Burst:
    """Burst containers of over ``room`` entries by the next turn id until none is left.

    A round moves the oversized containers' entries one turn down and is written out, so
    at most ``band`` + 1 rounds follow each other, on ever fewer rows.
    """
    kept, ended, members, children = [], [], [], []
    live = entries
    while True:
        big = staged(live.groupBy(*HEAD).agg(F.count(F.lit(1)).alias("m"), F.min("rep").alias("low"))
                     .where(F.col("m") > room).drop("m"), "burst-heads")
        n_big = big.count()
        if n_big == 0:
            return Burst(_all([*kept, live]), _all(ended), _all(members), _all(children))
        seen = staged(_attach(live, big, n_big), "burst")
        kept.append(seen.where(F.col("low").isNull()).drop("low"))
        head_depth = F.col("elems")[0]["pos"] - 1
        down = (seen.where(F.col("low").isNotNull()).withColumn("next", F.col("elems")[0])
                .withColumn("acc", F.col("acc") + F.when(F.col("own") & (F.col("rep") != F.col("low")), F.col("head_cp")).otherwise(0)))
        members.append(down.where("own").select(
            *HEAD, "up", "low", (F.col("p") - F.col("head_cp")).alias("before"), head_depth.alias("depth"), *ENTRY[1:], "rep"))
        children.append(down.where(F.col("own") & (F.col("next.cp") >= 0)).groupBy(*HEAD, "next.e1", "next.e2").agg(F.lit(1).alias("one"))
                        .groupBy(*HEAD).agg(F.count("one").alias("n_children")))
        # an entry stops at its end mark, and at the band's deepest node: what follows is the next band's
        stops = (F.col("next.cp") < 0) | (head_depth >= (F.col("band") + 1) * band)
        ended.append(down.where(stops).select(*ENTRY, "rep", "acc", "seg", F.lit(0).cast("long").alias("leaf"),
                                              _closed().alias("closed"), "n"))
        live = down.where(~stops).withColumns({
            "k1": F.col("k1").bitwiseXOR(F.col("next.e1")), "k2": F.col("k2").bitwiseXOR(F.col("next.e2")),
            "elems": F.slice("elems", 2, band + 1), "head_cp": F.col("next.cp"), "p": F.col("p") + F.col("next.cp"),
            "own": F.lit(True), "up": F.col("low")}).drop("next", "low")


def _closed() -> Column:
    """Whether an entry of band 0 holds its conversations' end, so that they have no other entry that counts."""
    return (F.col("band") == 0) & (F.element_at("elems", -1)["cp"] < 0)


# ------------------------------------------------------------------------ sweep
class Container:
    """The nodes of one container, from its sorted suffixes: node 0 is the head.

    Lists per node: ``parent``, ``depth``, ``cp``, ``key``; per entry: ``at`` (its deepest node) and ``ends``.
    Nodes below the band's last depth only stand for children (cp 0, not ``shown``).
    """

    def __init__(self, suffixes: list[list[tuple]], own: bool, head_cp: int, key: tuple[int, int], last_depth: int):
        depth0 = suffixes[0][0][0] - 1
        self.own = own
        self.parent, self.depth, self.cp, self.key = [-1], [depth0], [head_cp if own else 0], [key]
        self.n_children = [0]
        self.at, self.ends = [], []
        path, last = [0], []
        for s in suffixes:
            same = 0
            while same < len(last) and same < len(s) and last[same] == s[same] and s[same][3] >= 0:
                same += 1
            del path[same + 1:]
            for pos, e1, e2, cp in s[same:]:
                if cp < 0:
                    break
                up = path[-1]
                self.n_children[up] += 1
                path.append(len(self.parent))
                self.parent.append(up)
                self.depth.append(pos)
                self.cp.append(cp if pos <= last_depth else 0)
                self.key.append((self.key[up][0] ^ e1, self.key[up][1] ^ e2))
                self.n_children.append(0)
            self.at.append(path[-1])
            self.ends.append(s[-1][3] < 0)
            last = s
        self.shown = [d <= last_depth for d in self.depth]
        self.shown[0] = own
        self.before = [0] * len(self.parent)
        for v in range(1, len(self.parent)):
            self.before[v] = self.before[self.parent[v]] + self.cp[self.parent[v]]

    def total(self, per_entry: list[int]) -> list[int]:
        """Sum over each node's entries."""
        out = [0] * len(self.parent)
        for v, x in zip(self.at, per_entry):
            out[v] += x
        for v in range(len(out) - 1, 0, -1):
            out[self.parent[v]] += out[v]
        return out

    def lowest(self, rep: list[int]) -> tuple[list[int], list[int]]:
        """Each node's smallest ``rep`` and the entry that has it."""
        low, who = [NONE] * len(self.parent), [-1] * len(self.parent)
        for i, (v, r) in enumerate(zip(self.at, rep)):
            if who[v] < 0 or r < low[v]:
                low[v], who[v] = r, i
        for v in range(len(low) - 1, 0, -1):
            u = self.parent[v]
            if who[v] >= 0 and (who[u] < 0 or low[v] < low[u]):
                low[u], who[u] = low[v], who[v]
        return low, who

    def not_owned(self, rep: list[int]) -> tuple[list[int], list[int]]:
        """Per entry: code points of its nodes that ``rep`` does not own, and whether ``rep`` owns a leaf at its end."""
        low, _ = self.lowest(rep)
        above = [0] * len(low)
        for v in range(1, len(low)):
            u = self.parent[v]
            above[v] = above[u] if low[u] == low[v] else self.before[v]
        acc = [above[v] if low[v] == r else self.before[v] + self.cp[v] for v, r in zip(self.at, rep)]
        leaf = [int(e and self.shown[v] and not self.n_children[v]) for v, e in zip(self.at, self.ends)]
        return acc, leaf


def _containers(batches: Iterator[pa.RecordBatch], band: int) -> Iterator[tuple[Container, pa.Table]]:
    """Containers of batches sorted by (k1, k2, band, elems); a batch holds whole containers."""
    for t in grouped_batches(batches, "k1"):
        t = t.combine_chunks()
        k1, k2, b = (t.column(c).to_numpy() for c in ("k1", "k2", "band"))
        new = np.flatnonzero((k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]) | (b[1:] != b[:-1])) + 1
        elems = t.column("elems").combine_chunks()
        off = elems.offsets.to_numpy()
        flat = list(zip(*(elems.values.field(c).to_pylist() for c in ("pos", "e1", "e2", "cp"))))
        own, head_cp = t.column("own").to_pylist(), t.column("head_cp").to_pylist()
        cuts = [0, *new.tolist(), t.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            suffixes = [flat[off[i]:off[i + 1]] for i in range(lo, hi)]
            c = Container(suffixes, own[lo], head_cp[lo], (int(k1[lo]), int(k2[lo])), (int(b[lo]) + 1) * band)
            yield c, t.slice(lo, hi - lo)


def _sorted_containers(rows: DataFrame) -> DataFrame:
    return rows.repartition("k1", "k2", "band").sortWithinPartitions("k1", "k2", "band", "elems")


def sweep_owners(containers: DataFrame, band: int) -> DataFrame:
    """Per entry: ``acc`` (code points of its band that its smallest member does not own) and ``leaf``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c, t in _containers(batches, band):
            rep = t.column("rep").to_pylist()
            acc, leaf = c.not_owned(rep)
            acc = [a + x for a, x in zip(t.column("acc").to_pylist(), acc)]
            cols = [*(t.column(k).combine_chunks() for k in (*ENTRY, "rep")), pa.array(acc, pa.int64()), t.column("seg").combine_chunks(),
                    pa.array(leaf, pa.int64()), t.column("closed").combine_chunks(), t.column("n").combine_chunks()]
            yield pa.RecordBatch.from_arrays(cols, names=[*ENTRY, "rep", "acc", "seg", "leaf", "closed", "n"])

    rows = containers.withColumn("closed", _closed())
    return _sorted_containers(rows).mapInArrow(
        run, "band long, y1 long, y2 long, rep long, acc long, seg long, leaf long, closed boolean, n long")


def sweep_nodes(containers: DataFrame, band: int) -> DataFrame:
    """The nodes of containers whose entries carry their members' totals (n, rep, total, mine, leaves)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["k1", "k2", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
        kinds = [pa.int64()] * len(names)
        out: list[tuple] = []

        def batch() -> pa.RecordBatch:
            cols = zip(*out) if out else [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(cols, kinds)], names=names)

        for c, t in _containers(batches, band):
            low, who = c.lowest(t.column("rep").to_pylist())
            n, total, leaves = (c.total(t.column(k).to_pylist()) for k in ("n", "total", "leaves"))
            mine = t.column("mine").to_pylist()
            above = t.column("p")[0].as_py() - (c.cp[0] if c.own else 0)  # code points before the head, or through a band's head
            up = t.column("up")[0].as_py()
            for v, shown in enumerate(c.shown):
                if shown:
                    parent = up if v == 0 else low[c.parent[v]]
                    out.append((*c.key[v], c.depth[v], low[v], parent, n[v], c.n_children[v], leaves[v],
                                total[v] - mine[who[v]] - (n[v] - 1) * (above + c.before[v])))
            if len(out) > 20_000:
                yield batch()
                out = []
        if out:
            yield batch()

    return _sorted_containers(containers).mapInArrow(
        run, "k1 long, k2 long, depth long, conv_id long, parent_conv_id long, n_convs long, "
             "n_children long, n_leaves long, saved_tokens long")


# ------------------------------------------------------------------------ whole
def member_totals(pieces: DataFrame, owners: DataFrame) -> DataFrame:
    """Per entry: ``total`` (sum of its members' A), ``mine`` (that of the smallest), ``leaves``.

    A conversation within one band has its A in its entry alone.  Longer ones add up theirs over
    their entries (partial sums first) and bring the sum back to each entry.
    """
    closed = owners.where("closed").select(
        *ENTRY, (F.col("acc") + (F.col("n") - 1) * F.col("seg")).alias("total"), F.col("acc").alias("mine"), F.col("leaf").alias("leaves"))
    long = pieces.where(~_closed()).select("conv", *ENTRY)
    smallest = F.col("conv") == F.col("rep")
    parts = (long.join(owners.select(*ENTRY, "rep", "acc", "seg", "leaf"), ENTRY)
             .groupBy("conv").agg(F.sum(F.when(smallest, F.col("acc")).otherwise(F.col("seg"))).alias("a"),
                                  F.sum(F.when(smallest, F.col("leaf")).otherwise(0)).alias("leaf")))
    spread = (long.join(parts, "conv").groupBy(*ENTRY)
              .agg(F.sum("a").alias("total"), F.min_by("a", "conv").alias("mine"), F.sum("leaf").alias("leaves")))
    return closed.unionByName(spread)


def build(steps: DataFrame, band: int = 64, room: int = 4096) -> Trie:
    """The trie of conversations given as (conv, part, at, t1, t2, cp) rows with end marks."""
    if band < 1 or room < 1:
        raise ValueError("band and room are at least 1")
    pieces = staged(cut_bands(steps, band), "pieces")
    entries = staged(collapse(pieces), "entries")
    b = burst(entries, band, room)
    owners = sweep_owners(b.containers, band)
    owners = staged(owners if b.ended is None else owners.unionByName(b.ended), "owners")
    totals = staged(member_totals(pieces, owners), "totals")
    nodes = sweep_nodes(b.containers.join(totals, ENTRY), band)
    if b.members is not None:
        heads = (b.members.join(totals, ENTRY).join(entries.select(*ENTRY, "n"), ENTRY)
                 .groupBy(*HEAD, "up", "low", "before", "depth")
                 .agg(F.sum("n").alias("n_convs"), F.sum("total").alias("total"), F.sum("leaves").alias("n_leaves"),
                      F.min_by("mine", "rep").alias("mine"))
                 .join(b.children, HEAD, "left"))
        nodes = nodes.unionByName(heads.select(
            "k1", "k2", "depth", F.col("low").alias("conv_id"), F.col("up").alias("parent_conv_id"), "n_convs",
            F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves",
            (F.col("total") - F.col("mine") - (F.col("n_convs") - 1) * F.col("before")).alias("saved_tokens")))
    last = F.element_at("elems", -1)
    depth = last["pos"] - 1
    ends = (pieces.where((last["cp"] < 0) & ((depth > F.col("band") * band) | (F.col("band") == 0)))
            .select(_node(F.col("y1").bitwiseXOR(last["e1"]), F.col("y2").bitwiseXOR(last["e2"]), depth).alias("node"),
                    F.col("conv").alias("conv_id")))
    nodes = nodes.select(_node(F.col("k1"), F.col("k2"), F.col("depth")).alias("node"), "depth", "conv_id", "parent_conv_id",
                         "n_convs", "n_children", "n_leaves", "saved_tokens")
    return Trie(nodes, ends)


def _node(k1: Column, k2: Column, depth: Column) -> Column:
    """A node's key as text: depth and 128 bits."""
    return F.concat_ws("-", depth, F.lpad(F.hex(k1), 16, "0"), F.lpad(F.hex(k2), 16, "0"))


def prefix_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", share: tuple[int, int] | None = None, band: int = 64, room: int = 4096) -> Trie:
    """The trie of the conversations of a table; ``share`` (every, most) first rebuilds them by :func:`share_heads`.

    Rows without an id are left out, a null role or text is the empty one, a null turn
    comes first, equal turns follow by role and text, repeated rows are turns of their own.
    Very long conversations are cut into bands, very long texts only count by hash and length.  Other columns are
    not read.  An empty table gives no node, not even a root.
    """
    turns = staged(number_turns(conversations, conv_col, turn_col, role_col, text_col), "turns")
    return build(share_heads(turns, *share) if share else whole_turns(turns), band, room)


def joined_sha256(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256): SHA-256 of a node's conversation ids, ascending, as decimals joined by commas.

    Ids are sorted over ranges of (node, id) and joined into pieces of ``LIST_IDS``; a node's pieces then pass
    one hash in order, so no task sorts or holds a node's ids.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []

        def piece() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([node], pa.string()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))], pa.string())],
                names=["node", "first", "ids"])

        for b in batches:
            for n, i in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if ids and (n != node or len(ids) >= LIST_IDS):
                    yield piece()
                    ids = []
                node = n
                ids.append(i)
        if ids:
            yield piece()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, h = None, None
        for b in batches:
            nodes, out = [], []
            for n, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if n == node:
                    h.update(b"," + ids.encode())
                    continue
                if h is not None:
                    nodes.append(node)
                    out.append(h.hexdigest())
                node, h = n, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.string()), pa.array(out, pa.string())], names=["node", "ends_sha256"])
        if h is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.string()), pa.array([h.hexdigest()], pa.string())],
                                             names=["node", "ends_sha256"])

    pieces = (ends.select("node", "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
              .mapInArrow(pack, "node string, first long, ids string"))
    return pieces.repartition("node").sortWithinPartitions("node", "first").mapInArrow(digest, "node string, ends_sha256 string")
