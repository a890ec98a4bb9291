"""Operator 13, a prefix trie of conversations: ternary search trees over ranges of the sorted turn sequences.

A conversation is a sequence of turns; a turn is known by the digest of its role and
text. Sequences are cut into blocks of at most 64 turns, and each block's row carries
the digest of everything before it (an exclusive-or of one digest per turn and place,
128 bits, so that it can be totalled in parts), under which it enters the trie. So no
row grows with a conversation. The block rows are sorted and dealt into ranges; each range
encodes its turns by a dictionary of its own and inserts its sequences into a ternary
search tree, the median first, which keeps the siblings balanced. Nodes are made
parent first; one loop backwards accumulates members, leaves and savings.

Every sum is over members, so ranges can be added: a member counts a node's bytes as
saved unless it is the first one there, and counts a leaf if it ends there, is the last one
and nothing goes on. Each range is given the last row before it and the first one
behind it; with them it knows which nodes on its two edges others share. Only
those, and nodes at the foot of a block, are merged by their digests; all others are final.
What later blocks of a conversation save is totalled per conversation and handed to its
earlier blocks. The ids that end at a shared node are hashed as a stream of small
chunks in their order: SHA-256 is sequential, and no list of them is held.

Defined results: rows without a conversation id belong to none and give nothing; null
role or text counts as empty; turns go by number, null first, ties and repeated rows by
their digest; very long conversations are cut into blocks and their nodes counted
whole; a conversation without turns is a member of the root alone; an empty table gives
no nodes; columns other than the four are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerlake.llm.common import range_dealt, running_before, stored

#: Turns of one block; block rows of one range; ids of one chunk to hash.
BLOCK, ROWS_PER_RANGE, CHUNK = 64, 20_000, 1024
#: Turns of one conversation that look their head up under one key.
STRIDE = 4096
DIGEST = 32
EMPTY = hashlib.sha256(b"").hexdigest()
SORT = ["block", "e1", "e2", "seq", "more", "conv_id"]
NODE = ("depth long, k1 long, k2 long, p1 long, p2 long, parent_conv long, parent_open boolean, open boolean, conv_id long, n_convs long, "
        "n_children long, n_leaves long, saved_tokens long, ends_sha256 string, part int, chunks array<string>")


# --- conversations as positioned turns ------------------------------------------------------------------------------

def positioned_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, turn, n_bytes): turns by number, ``turn`` being the digest of role and text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("at"),
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("turn"),
        F.octet_length(text).cast("long").alias("n_bytes"), F.monotonically_increasing_id().alias("row"))
    kept = stored(rows, "turns")
    return running_before(kept, ["conv_id"], ["at", "turn", "row"], {"pos": None}).select("conv_id", "pos", "turn", "n_bytes")


def with_shared_heads(turns: DataFrame, family: int = 5, longest: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on the head of their family's first: (turns, lengths).

    ``c`` takes the first ``h`` turns of conversation ``c - c mod family`` (all if fewer, none
    if that is absent), then its own behind its first ``h``; ``h`` is CRC-32 of the decimal id mod ``longest``.
    """
    turns = stored(turns, "positioned")
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % longest
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).withColumn("h", head)
    convs = convs.withColumn("first", F.col("conv_id") - F.pmod("conv_id", F.lit(family)))
    heads = turns.where((F.pmod("conv_id", F.lit(family)) == 0) & (F.col("pos") < longest - 1)).withColumnRenamed("conv_id", "first")
    there = heads.groupBy("first").agg(F.count(F.lit(1)).alias("there"))
    convs = stored(convs.join(there, "first", "left").withColumn("taken", F.least("h", F.coalesce("there", F.lit(0)))), "conversations")
    taken = convs.select("conv_id", "h", "first").join(heads, "first").where("pos < h").select("conv_id", "pos", "turn", "n_bytes")
    # One key per conversation and stride of turns, so that a very long one meets its head in many tasks.
    own = convs.select("conv_id", "h", "taken", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / F.lit(STRIDE)))).alias("stride"))
    rest = turns.withColumn("stride", F.floor(F.col("pos") / F.lit(STRIDE))).join(own, ["conv_id", "stride"]).where("pos >= h")
    rest = rest.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "turn", "n_bytes")
    lengths = convs.select("conv_id", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    return taken.unionByName(rest), lengths


# --- block rows -----------------------------------------------------------------------------------------------------

def _half(hex_: Column, from_: int) -> Column:
    return F.conv(F.substring(hex_, from_, 16), 16, -10).cast("long")


def place_digest(place: int, turn: str) -> tuple[int, int]:
    """The 128 bits of one turn at one place, as two signed 64-bit integers; as ``_blocks`` takes them."""
    d = hashlib.md5(f"{place}:{turn}".encode()).digest()
    return int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)


def _blocks(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row per conversation and block: its turns' digests joined, their bytes, and the digest of all before it."""
    place = F.md5(F.concat(F.col("pos").cast("string"), F.lit(":"), F.col("turn")))
    rows = turns.select("conv_id", F.floor(F.col("pos") / F.lit(BLOCK)).cast("long").alias("block"), F.struct("pos", "turn", "n_bytes").alias("t"), place.alias("z"))
    rows = rows.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list("t")).alias("t"), F.bit_xor(_half(F.col("z"), 1)).alias("x1"),
                                                F.bit_xor(_half(F.col("z"), 17)).alias("x2"))
    rows = rows.select("conv_id", "block", F.array_join(F.transform("t", lambda t: t["turn"]), "").alias("seq"),
                       F.transform("t", lambda t: t["n_bytes"]).alias("sizes"), "x1", "x2")
    last = lengths.select("conv_id", F.greatest(F.floor((F.col("length") - 1) / F.lit(BLOCK)), F.lit(0)).cast("long").alias("last"))
    # A conversation's rows are one per 64 turns here; it has one row of its own for each (conv_id, block).
    ends = last.select("conv_id", "last", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))).alias("block"))
    rows = stored(ends.join(rows, ["conv_id", "block"], "left").select(
        "conv_id", "block", F.coalesce("seq", F.lit("")).alias("seq"), F.coalesce("sizes", F.array().cast("array<long>")).alias("sizes"), "x1", "x2",
        (F.col("block") < F.col("last")).cast("int").alias("more"), (F.col("last") > 0).alias("several")), "trie-blocks")
    zero = F.lit(0).cast("long")
    one = rows.where("not several").select("conv_id", "block", "seq", "sizes", "more", zero.alias("e1"), zero.alias("e2"))
    long_ = rows.where("several")
    entry = running_before(long_.select("conv_id", "block", "x1", "x2"), ["conv_id"], ["block"], {"e1": "x1", "e2": "x2"}, how="xor")
    many = long_.join(entry.select("conv_id", "block", "e1", "e2"), ["conv_id", "block"])
    return one.unionByName(many.select(*one.columns))


def _neighbours(dealt: DataFrame) -> DataFrame:
    """(part, side, block, e1, e2, seq): the last row before each range (side -1) and the first one behind it (1)."""
    key = F.struct(*SORT)
    ends = dealt.groupBy("__part").agg(F.min(key).alias("first"), F.max(key).alias("last"))
    order = Window.partitionBy(F.lit(0)).orderBy("__part")
    ends = ends.select("__part", F.lag("last").over(order).alias("before"), F.lead("first").over(order).alias("behind"))
    sides = [ends.where(F.col(c).isNotNull()).select("__part", F.lit(side).alias("side"), *[F.col(f"{c}.{k}").alias(k) for k in ("block", "e1", "e2", "seq")])
             for c, side in (("before", -1), ("behind", 1))]
    return sides[0].unionByName(sides[1])


def _ranges(dealt: DataFrame, neighbours: DataFrame, fn, schema: str) -> DataFrame:
    """``fn(part, rows, row before, row behind)`` for each range; rows are sorted tuples, its result a RecordBatch iterator."""
    rows = dealt.withColumn("side", F.lit(0)).unionByName(neighbours, allowMissingColumns=True)

    def run(table):
        cols = {c: table.column(c).to_pylist() for c in table.column_names}
        side = cols["side"]
        sort = list(zip(*(cols[c] for c in ("block", "e1", "e2", "seq"))))
        by = {s: sort[i] for i, s in enumerate(side) if s}
        own = sorted((i for i, s in enumerate(side) if s == 0), key=lambda i: (*sort[i], cols["more"][i], cols["conv_id"][i]))
        rows = [(sort[i][:3], sort[i][3], cols["more"][i], cols["conv_id"][i], cols["sizes"][i], cols["later_saved"][i], cols["later_leaves"][i]) for i in own]
        return fn(cols["__part"][0], rows, by.get(-1), by.get(1))

    return rows.groupBy("__part").applyInArrow(run, schema)


def common_turns(a: str, b: str) -> int:
    """Turns that two sequences of digests share at their start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // DIGEST
    lo, hi = 0, n // DIGEST
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if a[:mid * DIGEST] == b[:mid * DIGEST] else (lo, mid)
    return lo


def _shared(row, other) -> int:
    """Turns shared with a neighbouring row; -1 if that enters the trie elsewhere."""
    return common_turns(row[1], other[3]) if other is not None and row[0] == other[:3] else -1


def _repeated_bytes(part: int, rows: list, before, behind) -> pa.Table:
    """Per block row the bytes of the nodes at which it is not the first, and whether it counts a leaf."""
    keys, blocks, saved, leaves = [], [], [], []
    last = before
    for i, (entry, seq, more, conv, sizes, *_) in enumerate(rows):
        after = (*rows[i + 1][0], rows[i + 1][1]) if i + 1 < len(rows) else behind
        keys.append(conv)
        blocks.append(entry[0])
        saved.append(sum(sizes[:max(0, _shared((entry, seq), last))]))
        leaves.append(int(not more and not (after is not None and after[:3] == entry and after[3].startswith(seq))))
        last = (*entry, seq)
    return pa.table([pa.array(keys, pa.int64()), pa.array(blocks, pa.int64()), pa.array(saved, pa.int64()), pa.array(leaves, pa.int64())],
                    ["conv_id", "block", "saved", "leaves"])


# --- ternary search trees -------------------------------------------------------------------------------------------

class TernaryTree:
    """A ternary search tree over integer symbols: one node per distinct prefix, made parent first."""

    def __init__(self):
        self.symbol, self.less, self.down, self.more = [], [], [], []
        self.parent, self.depth = [], []
        self.top = -1

    def _new(self, symbol: int, parent: int) -> int:
        self.symbol.append(symbol)
        self.less.append(-1)
        self.down.append(-1)
        self.more.append(-1)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 1)
        return len(self.symbol) - 1

    def insert(self, symbols: list[int]) -> list[int]:
        """The nodes along ``symbols``, made where they are missing."""
        path, parent = [], -1
        for s in symbols:
            at = self.top if parent < 0 else self.down[parent]
            if at < 0:
                at = self._new(s, parent)
                if parent < 0:
                    self.top = at
                else:
                    self.down[parent] = at
            while self.symbol[at] != s:
                side = self.less if s < self.symbol[at] else self.more
                if side[at] < 0:
                    side[at] = self._new(s, parent)
                at = side[at]
            path.append(at)
            parent = at
        return path


def medians_first(n: int):
    """0 .. n-1, each interval's middle before its halves."""
    todo = [(0, n)]
    while todo:
        a, b = todo.pop()
        if a < b:
            mid = (a + b) // 2
            yield mid
            todo += [(mid + 1, b), (a, mid)]


def _nodes(part: int, rows: list, before, behind) -> pa.Table:
    """The nodes of one range; those that other ranges or blocks share are open."""
    code = {t: i for i, t in enumerate(sorted({seq[i:i + DIGEST] for _, seq, *_ in rows for i in range(0, len(seq), DIGEST)}))}
    turn = list(code)
    out: list[tuple] = []
    at = 0
    while at < len(rows):
        stop = at
        while stop < len(rows) and rows[stop][0] == rows[at][0]:
            stop += 1
        group = rows[at:stop]
        prev = _shared(group[0], before) if at == 0 else -1
        next_ = _shared(group[-1], behind) if stop == len(rows) else -1
        out += _group_nodes(part, group, prev, next_, behind if stop == len(rows) else None, code, turn)
        at = stop
    kinds = [pa.int64()] * 6 + [pa.bool_()] * 2 + [pa.int64()] * 5 + [pa.string(), pa.int32(), pa.list_(pa.string())]
    names = [c.split()[0] for c in NODE.split(", ")]
    return pa.table([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * len(names), kinds)], names)


def _group_nodes(part: int, group: list, prev: int, next_: int, behind, code: dict, turn: list) -> list[tuple]:
    """Nodes below one entry. ``prev`` and ``next_``: turns shared with the rows of the ranges beside this one."""
    (block, e1, e2), tree = group[0][0], TernaryTree()
    # Distinct sequences, in order, with the rows [from, to) that hold them.
    spans, i = [], 0
    while i < len(group):
        j = i
        while j < len(group) and group[j][1] == group[i][1]:
            j += 1
        spans.append((group[i][1], i, j))
        i = j
    paths: list = [None] * len(spans)
    for k in medians_first(len(spans)):
        seq = spans[k][0]
        paths[k] = tree.insert([code[seq[i:i + DIGEST]] for i in range(0, len(seq), DIGEST)])
    n = len(tree.symbol)
    # Index n stands for the entry itself.
    members, smallest, leaves, saved = [0] * (n + 1), [None] * (n + 1), [0] * (n + 1), [0] * (n + 1)
    children, size, own, open_ = [0] * (n + 1), [0] * (n + 1), [1] * (n + 1), [False] * (n + 1)
    ends: list = [None] * (n + 1)
    for k, (seq, i, j) in enumerate(spans):
        path, held = paths[k], group[i:j]
        foot = path[-1] if path else n
        members[foot] += j - i
        smallest[foot] = min(r[3] for r in held)
        saved[foot] += sum(r[5] for r in held)
        leaves[foot] += sum(r[6] for r in held)
        done = [r[3] for r in held if not r[2]]
        ends[foot] = done or None
        if len(done) < len(held):
            open_[foot] = True  # its children stand in the next block
        after = spans[k + 1][0] if k + 1 < len(spans) else behind[3] if behind is not None and behind[:3] == (block, e1, e2) else None
        if done and len(done) == len(held) and not (after is not None and after.startswith(seq)):
            leaves[foot] += 1
        for node, b in zip(path, held[0][4]):
            size[node] = b
    for node in paths[0][:max(0, prev)]:
        own[node] = 0
        open_[node] = True
    for node in paths[-1][:max(0, next_)]:
        open_[node] = True
    open_[n] = prev >= 0 or next_ >= 0 or block > 0
    for v in range(n - 1, -1, -1):  # children stand behind their parents
        up = tree.parent[v] if tree.parent[v] >= 0 else n
        saved[v] += size[v] * (members[v] - own[v])
        members[up] += members[v]
        leaves[up] += leaves[v]
        saved[up] += saved[v]
        children[up] += own[v]
        if smallest[up] is None or smallest[v] < smallest[up]:
            smallest[up] = smallest[v]
    first = block * BLOCK
    out, key = [], [(0, 0)] * n + [(e1, e2)]

    def row(v: int, depth: int, up: int) -> tuple:
        ids = ends[v]
        sha = None if open_[v] else hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() if ids else EMPTY
        chunks = [",".join(map(str, ids[i:i + CHUNK])) for i in range(0, len(ids), CHUNK)] if ids and open_[v] else None
        p = key[up] if up >= 0 else (None, None)
        return (depth, *key[v], *p, smallest[up] if up >= 0 else None, open_[up] if up >= 0 else None, open_[v], smallest[v], members[v],
                children[v], leaves[v], saved[v], sha, part, chunks)

    if block == 0:
        out.append(row(n, 0, -1))
    else:  # the entry is the foot of the block before: only its children are told from here
        out.append((first, e1, e2, None, None, None, None, True, None, 0, children[n], 0, 0, None, part, None))
    for v in range(n):
        up = tree.parent[v] if tree.parent[v] >= 0 else n
        a, b = key[up]
        x, y = place_digest(first + tree.depth[v] - 1, turn[tree.symbol[v]])
        key[v] = (a ^ x, b ^ y)
        out.append(row(v, first + tree.depth[v], up))
    return out


# --- the trie -------------------------------------------------------------------------------------------------------

def _hashed_ends(chunks: DataFrame) -> DataFrame:
    """(depth, k1, k2, sha): SHA-256 of each node's chunks joined by commas, streamed in their order."""
    key = ["depth", "k1", "k2"]

    def run(batches):
        held, sha = None, None
        for b in batches:
            done = []
            for *k, text in zip(*(b.column(i).to_pylist() for i in range(4))):
                if k != held:
                    if held is not None:
                        done.append((*held, sha.hexdigest()))
                    held, sha = k, hashlib.sha256()
                    sha.update(text.encode())
                else:
                    sha.update(b"," + text.encode())
            if done:
                yield batch(done)
        if held is not None:
            yield batch([(*held, sha.hexdigest())])

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), [pa.int64()] * 3 + [pa.string()])], [*key, "sha"])

    ordered = chunks.select(*key, "part", F.posexplode("chunks").alias("nr", "ids")).repartition(*key).sortWithinPartitions(*key, "part", "nr")
    return ordered.select(*key, "ids").mapInArrow(run, "depth long, k1 long, k2 long, sha string")


def prefix_trie(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row per node of the trie over ``turns`` (conv_id, pos from 0, turn, n_bytes) and ``lengths`` (conv_id, length)."""
    blocks = stored(_blocks(turns, lengths), "trie-rows")
    dealt = range_dealt(blocks, SORT, blocks.count(), ROWS_PER_RANGE, "trie-ranges")
    beside = stored(_neighbours(dealt), "trie-neighbours")
    zero = F.lit(0).cast("long")
    plain = dealt.withColumns({"later_saved": zero, "later_leaves": zero})
    # What the later blocks of a conversation save, for its earlier ones.
    told = _ranges(plain.where("block > 0"), beside, _repeated_bytes, "conv_id long, block long, saved long, leaves long")
    told = stored(told.unionByName(dealt.where("block = 0 and more = 1").select("conv_id", "block", zero.alias("saved"), zero.alias("leaves"))), "trie-later")
    later = running_before(told.withColumn("back", -F.col("block")), ["conv_id"], ["back"], {"later_saved": "saved", "later_leaves": "leaves"})
    rows = dealt.join(later.select("conv_id", "block", "later_saved", "later_leaves"), ["conv_id", "block"], "left")
    rows = rows.withColumns({c: F.coalesce(c, zero) for c in ("later_saved", "later_leaves")})
    nodes = stored(_ranges(rows, beside, _nodes, NODE), "trie-nodes")

    key = ["depth", "k1", "k2"]
    opened = nodes.where("open")
    merged = opened.groupBy(*key).agg(
        F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.min("parent_conv").alias("parent_conv"), F.bool_or("parent_open").alias("parent_open"),
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    sha = _hashed_ends(opened.where(F.col("chunks").isNotNull()))
    merged = stored(merged.join(sha, key, "left").withColumn("ends_sha256", F.coalesce("sha", F.lit(EMPTY))).drop("sha"), "trie-merged")
    out = nodes.where("not open").select(*merged.columns).unionByName(merged)
    # A child of a shared node has its parent's smallest member from the merged rows; very many children meet it under 16 keys.
    parents = merged.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("shared"),
                            F.explode(F.sequence(F.lit(0), F.lit(15))).alias("salt"))
    below = out.where("parent_open").withColumn("salt", F.pmod(F.xxhash64("k1", "k2"), F.lit(16)).cast("int"))
    below = below.join(parents, ["depth", "p1", "p2", "salt"], "left").withColumn("parent_conv", F.col("shared"))
    cols = ["conv_id", "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return below.select(*cols).unionByName(out.where("parent_open is null or not parent_open").select(*cols))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of all conversations rebuilt on their shared heads."""
    turns, lengths = with_shared_heads(positioned_turns(conversations))
    return prefix_trie(turns, lengths)
