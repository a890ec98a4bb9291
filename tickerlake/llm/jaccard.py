"""Operator 6, n-gram Jaccard join by vertical partitioning.

The global order of the word n-grams (by hash) is cut into fragments, and every
document into its segments, one per fragment.

1. Candidates. Two linked documents differ in at most D n-grams, D following from
   their sizes and the threshold. With more than D fragments, at least one pair of
   segments must be equal: documents are grouped by (size class, fragment,
   segment). A frequent n-gram makes no large group, since the whole segment must agree.
   Segments without n-grams do not count; documents with so many of them that the
   argument would fail also emit their empty segments.
2. Pruning. Each set has a parity sketch; the number of differing bits never
   exceeds the number of differing n-grams, so the test loses no link. Inside a
   group of candidates a minimum spanning forest of the passing pairs is verified
   first (linear in the group), and afterwards only pairs that still lie in
   different components, and that a sharper sketch lets through.
3. Verification. The sets of the candidates are cut into a few fragments; partial
   overlaps are counted per pair and fragment and summed per pair.
4. Links, with equal sets as one node, give components.

Equal sets are one node throughout, so copies are never paired. Hashes have 64 bits.

Defined results: a null or empty text, or one without words, has no n-grams and is
linked with nothing, not even with another such text; a text of fewer than five
words is one n-gram; repeated rows are equal sets; a null id never is the smallest
of a component unless all are null; an empty table gives an empty result; only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerlake.llm import textvec as V
from tickerlake.llm.common import giving_back, stored, texts
from tickerlake.llm.components import components

U64 = np.uint64
SHINGLE, PERCENT = 5, 80
#: Fragments of the verification, entries per bucket of candidate keys, and entries a task gathers before it sends them on.
VERIFY_FRAGMENTS, BUCKET_ENTRIES, FLUSH_ENTRIES = 4, 1_000_000, 1_500_000
LEAST_BITS = 128
#: Sketch bits per n-gram where the first sketch left pairs in doubt.
SHARP = 8
#: Pairs that a task holds before it passes them on.
BLOCK_PAIRS = 200_000
PIECE_BYTES = 1 << 20


def most_different(n: np.ndarray, m: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Most n-grams in exactly one of two linked sets of sizes n and m."""
    return (n + m) * (100 - percent) // (100 + percent)


def linked(overlap, n, m, percent: int = PERCENT):
    return 100 * overlap >= percent * (n + m - overlap)


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes sorted and distinct per document, offsets) of lower-cased texts."""
    raw, off = V.column_bytes(column)
    data = V.LOWER[raw]
    start, end, first = V.words(data, off)
    h, so = V.shingle_hashes(V.word_hashes(data, start, end), first, SHINGLE)
    for a, b in zip(so[:-1], so[1:]):
        h[a:b].sort()
    keep = np.ones(len(h), bool)
    if len(h):
        keep[1:] = h[1:] != h[:-1]
        keep[so[:-1][so[:-1] < len(h)]] = True
    before = np.concatenate([[0], np.cumsum(keep)])
    return h[keep], before[so]


def signatures(h: np.ndarray, off: np.ndarray) -> np.ndarray:
    """64-bit identity of each set."""
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(V.mix(h, 77), dtype=np.uint64)])
        return V.mix(total[off[1:]] - total[off[:-1]] + np.diff(off).astype(np.uint64) * V._MIX2, 7)


def sketch(h: np.ndarray, per_gram: int = 1) -> bytes:
    """Parity sketch: bit i is the parity of the n-grams that fall on it; ``per_gram`` to twice as many bits per n-gram."""
    bits = LEAST_BITS
    while bits < len(h) * per_gram:
        bits *= 2
    at = (V.mix(h, 99) & U64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def fold(words: np.ndarray, size: int) -> np.ndarray:
    """A sketch (rows of 64-bit words) folded to fewer words; the test stays a lower bound."""
    while words.shape[-1] > size:
        half = words.shape[-1] // 2
        words = words[..., :half] ^ words[..., half:]
    return words


def document_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, sig, sketch), one row per input row."""

    def run(batches):
        for batch in batches:
            for piece in V.pieces_of(batch, "text", PIECE_BYTES):
                h, off = shingle_sets(piece.column(1))
                body = [sketch(h[a:b]) for a, b in zip(off[:-1], off[1:])]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0).cast(pa.int64()), pa.array(np.diff(off), pa.int64()),
                     pa.array(signatures(h, off).view(np.int64)), pa.array(body, pa.binary())],
                    ["doc_id", "n_shingles", "sig", "sketch"])

    return texts(docs).mapInArrow(giving_back(run), "doc_id long, n_shingles long, sig long, sketch binary")


def classes(n: np.ndarray) -> np.ndarray:
    """Size class: sizes from 2**c up to below 2**(c + 1)."""
    return np.floor(np.log2(np.maximum(n, 1) + 0.5)).astype(np.int64)


def fragment_count(c: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """(fragments, largest size) of a size class: more fragments than differences, and some to spare for empty ones."""
    largest = (1 << (c + 1)) - 1
    return most_different(largest, largest, percent) * 21 // 20 + 3, largest


def candidate_keys(h: np.ndarray, off: np.ndarray, sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, sig) of every segment under which a document can meet its partners."""
    n = np.diff(off)
    own = classes(n)
    keys, owners = [], []
    for step in (0, 1):
        c = own + step
        count, largest = fragment_count(c)
        partner = np.minimum(largest, n * 100 // PERCENT)
        differ = most_different(n, partner)
        use = differ > 0 if step == 0 else (differ > 0) & (n * 100 // PERCENT >= (1 << c))
        pick = np.flatnonzero(use)
        if len(pick) == 0:
            continue
        size = n[pick]
        at = np.concatenate([[0], np.cumsum(size)])
        into = np.arange(at[-1]) + np.repeat(off[pick] - at[:-1], size)
        u, doc = h[into], np.repeat(np.arange(len(pick)), size)
        frag = ((u >> U64(32)) * count[pick].astype(np.uint64)[doc]) >> U64(32)
        new = np.ones(len(u), bool)
        new[1:] = (frag[1:] != frag[:-1]) | (doc[1:] != doc[:-1])
        begin = np.flatnonzero(new)
        with np.errstate(over="ignore"):
            body = np.add.reduceat(V.mix(u, 5), begin)
            cls = c[pick].astype(np.uint64)[doc[begin]]
            keys.append(V.mix(body + V.mix(frag[begin] + (cls << U64(48)), 11)))
        owners.append(sig[pick][doc[begin]])
        # Too many empty segments for the argument: these documents emit them as well.
        filled = np.bincount(doc[begin], minlength=len(pick))
        for i in np.flatnonzero(count[pick] - filled >= count[pick] - differ[pick]):
            total = int(count[pick][i])
            has = np.zeros(total, bool)
            has[frag[begin][doc[begin] == i].astype(np.int64)] = True
            empty = np.flatnonzero(~has).astype(np.uint64)
            keys.append(V.mix(V.mix(empty + U64(int(c[pick][i]) << 48), 11), 13))
            owners.append(np.full(len(empty), sig[pick][i]))
    if not keys:
        z = np.zeros(0, np.uint64)
        return z, z
    return np.concatenate(keys), np.concatenate(owners)


def candidate_lists(docs: DataFrame, buckets: int) -> DataFrame:
    """(list_id, sig): the distinct groups of two or more sets that share a segment.

    Keys and signatures travel as packed arrays, one row per task flush and bucket.
    """

    def pack(keys, owners):
        order = np.argsort(keys % U64(buckets), kind="stable")
        keys, owners = keys[order], owners[order]
        cut = np.searchsorted(keys % U64(buckets), np.arange(buckets + 1, dtype=np.uint64))
        used = np.flatnonzero(np.diff(cut))
        return pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array([keys[cut[b]:cut[b + 1]].tobytes() for b in used], pa.binary()),
             pa.array([owners[cut[b]:cut[b + 1]].tobytes() for b in used], pa.binary())], ["bucket", "keys", "sigs"])

    def emit(batches):
        held, seen = [], 0
        for batch in batches:
            for piece in V.pieces_of(batch, "text", PIECE_BYTES):
                h, off = shingle_sets(piece.column(1))
                sig = signatures(h, off)
                _, once = np.unique(sig, return_index=True)  # copies in one piece emit once
                if len(once) < len(sig):
                    size = np.diff(off)[once]
                    at = np.concatenate([[0], np.cumsum(size)])
                    h = h[np.arange(at[-1]) + np.repeat(off[once] - at[:-1], size)]
                    off, sig = at, sig[once]
                held.append(candidate_keys(h, off, sig))
                seen += len(held[-1][0])
                if seen >= FLUSH_ENTRIES:
                    yield pack(*map(np.concatenate, zip(*held)))
                    held, seen = [], 0
        if seen:
            yield pack(*map(np.concatenate, zip(*held)))

    def group(table: pa.Table) -> pa.Table:
        keys = np.concatenate([np.frombuffer(x, np.uint64) for x in table.column("keys").to_pylist()])
        sigs = np.concatenate([np.frombuffer(x, np.uint64) for x in table.column("sigs").to_pylist()])
        order = np.argsort(keys)
        keys, sigs = keys[order], sigs[order]
        twice = np.zeros(len(keys) + 1, bool)
        twice[1:-1] = keys[1:] == keys[:-1]
        many = twice[:-1] | twice[1:]
        keys, sigs = keys[many], sigs[many]
        order = np.lexsort((sigs, keys))
        keys, sigs = keys[order], sigs[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (sigs[1:] != sigs[:-1])
        keys, sigs = keys[new], sigs[new]
        begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        size = np.diff(np.concatenate([begin, [len(keys)]]))
        with np.errstate(over="ignore"):
            ids = V.mix(np.add.reduceat(V.mix(sigs, 21), begin) + size.astype(np.uint64)) if len(begin) else np.zeros(0, np.uint64)
        _, one = np.unique(ids, return_index=True)
        one = one[size[one] > 1]
        at = np.concatenate([[0], np.cumsum(size[one])]).astype(np.int64)
        pick = np.arange(at[-1]) + np.repeat(begin[one] - at[:-1], size[one])
        out = pa.table({"list_id": pa.array(np.repeat(ids[one], size[one]).view(np.int64)), "sig": pa.array(sigs[pick].view(np.int64))})
        pa.default_memory_pool().release_unused()
        return out

    rows = texts(docs).mapInArrow(giving_back(emit), "bucket int, keys binary, sigs binary")
    return rows.groupBy("bucket").applyInArrow(group, "list_id long, sig long").distinct()


def distances(words: np.ndarray, n: np.ndarray, i: int, others: np.ndarray) -> np.ndarray:
    """Sketch distance of member i to others where a link is possible, else a large number."""
    m = n[others]
    d = np.bitwise_count(words[others] ^ words[i]).sum(axis=1).astype(np.int64)
    return np.where(d <= most_different(m, n[i]), d, 1 << 40)


def forest(words: np.ndarray, n: np.ndarray) -> list[tuple[int, int]]:
    """Minimum spanning forest of the possible links: memory linear in the members (Prim)."""
    left = np.arange(len(n))
    best = np.full(len(n), 1 << 40, np.int64)
    via = np.full(len(n), -1, np.int64)
    edges = []
    while len(left):
        k = int(np.argmin(best[left]))
        i = int(left[k])
        if via[i] >= 0 and best[i] < 1 << 40:
            edges.append((int(via[i]), i))
        left = np.delete(left, k)
        if len(left):
            d = distances(words, n, i, left)
            closer = d < best[left]
            best[left[closer]] = d[closer]
            via[left[closer]] = i
    return edges


def _members(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sig = table.column("sig").to_numpy()
    n = table.column("n").to_numpy()
    body = [np.frombuffer(x, np.uint64) for x in table.column("sketch").to_pylist()]
    # A difference test is sharpest on the longest sketches all can be folded to.
    size = min(len(b) for b in body)
    return sig, n, np.stack([fold(b, size) for b in body])


def _pairs(a, b) -> pa.Table:
    a, b = np.asarray(a, np.int64), np.asarray(b, np.int64)
    return pa.table({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))})


def likely_pairs(members: DataFrame) -> DataFrame:
    """(a, b): the spanning forest of every list; covers every set that has a possible partner in it."""

    def run(table: pa.Table) -> pa.Table:
        sig, n, words = _members(table)
        edges = np.array(forest(words, n), np.int64).reshape(-1, 2)
        return _pairs(sig[edges[:, 0]], sig[edges[:, 1]])

    return members.groupBy("list_id").applyInArrow(run, "a long, b long").distinct()


def remaining_pairs(members: DataFrame) -> DataFrame:
    """(a, b): every possible link between two components of a list (column ``component``).

    Pairs leave in blocks as they are found: a task holds a list's members and one block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        comp = table.column("component").to_numpy()
        sig, n, words = _members(table)
        a, b, held = [], [], 0
        for i in range(len(sig) - 1):
            others = np.flatnonzero(comp[i + 1:] != comp[i]) + i + 1
            hit = others[distances(words, n, i, others) < 1 << 40]
            a.append(np.full(len(hit), sig[i]))
            b.append(sig[hit])
            held += len(hit)
            if held >= BLOCK_PAIRS:
                yield from _pairs(np.concatenate(a), np.concatenate(b)).to_batches(BLOCK_PAIRS)
                a, b, held = [], [], 0
        if held:
            yield from _pairs(np.concatenate(a), np.concatenate(b)).to_batches(BLOCK_PAIRS)

    return members.groupBy("list_id").applyInArrow(run, "a long, b long").distinct()


def fragments(docs: DataFrame, sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """(sig, fragment, n, grams, sketch): the n-grams of the wanted sets, cut along the global order.

    Fragment 0 also carries the set's sharper sketch.
    """
    one = sets.join(wanted, "sig", "left_semi").groupBy("sig").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id")).alias("id"))
    ids = one.select(F.col("id.doc_id").alias("__id")).distinct()
    body = texts(docs).join(ids, F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")

    def run(batches):
        for batch in batches:
            for piece in V.pieces_of(batch, "text", PIECE_BYTES):
                h, off = shingle_sets(piece.column(0))
                sig = signatures(h, off).view(np.int64)
                rows = []
                for s, a, b in zip(sig, off[:-1], off[1:]):
                    cut = a + np.searchsorted(h[a:b], np.arange(1, VERIFY_FRAGMENTS, dtype=np.uint64) << U64(64 - VERIFY_FRAGMENTS.bit_length() + 1))
                    cut = [a, *cut, b]
                    sharp = sketch(h[a:b], SHARP)
                    rows += [(int(s), f, int(b - a), h[x:y].tobytes(), None if f else sharp) for f, (x, y) in enumerate(zip(cut, cut[1:]))]
                cols = list(zip(*rows)) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()),
                                                  pa.array(cols[3], pa.binary()), pa.array(cols[4], pa.binary())],
                                                 ["sig", "fragment", "n", "grams", "sketch"])

    cut = body.select("text").mapInArrow(giving_back(run), "sig long, fragment int, n long, grams binary, sketch binary")
    # Repeated rows and repeated ids may bring a set twice; equal sets have equal rows.
    return cut.join(wanted, "sig", "left_semi").groupBy("sig", "fragment").agg(
        F.first("n").alias("n"), F.first("grams").alias("grams"), F.first("sketch").alias("sketch"))


@F.arrow_udf(T.LongType())
def _overlap(a: pa.Array, b: pa.Array) -> pa.Array:
    out = np.zeros(len(a), np.int64)
    for i, (x, y) in enumerate(zip(a, b)):
        p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
        if len(p) and len(q):
            at = np.searchsorted(q, p)
            out[i] = int(np.count_nonzero(q[np.minimum(at, len(q) - 1)] == p))
    pa.default_memory_pool().release_unused()
    return pa.array(out)


def verified(pairs: DataFrame, frags: DataFrame) -> DataFrame:
    """The pairs that are linked: partial overlaps per fragment, summed per pair."""
    left = frags.select(F.col("sig").alias("a"), "fragment", F.col("n").alias("n_a"), F.col("grams").alias("grams_a"))
    right = frags.select(F.col("sig").alias("b"), "fragment", F.col("n").alias("n_b"), F.col("grams").alias("grams_b"))
    parts = pairs.join(left, "a").join(right, ["b", "fragment"])
    parts = parts.select("a", "b", "n_a", "n_b", _overlap("grams_a", "grams_b").alias("part"))
    whole = parts.groupBy("a", "b", "n_a", "n_b").agg(F.sum("part").alias("overlap"))
    return whole.filter(linked(F.col("overlap"), F.col("n_a"), F.col("n_b"))).select("a", "b", "overlap")


def links(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): verified links between different sets that connect every component of the join."""
    entries = sets.agg(F.sum("n_shingles")).first()[0] or 0
    lists = stored(candidate_lists(docs, max(1, -(-entries // (2 * BUCKET_ENTRIES)))), "jaccard-lists")
    kinds = sets.groupBy("sig").agg(F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
    members = stored(lists.join(kinds, "sig"), "jaccard-members")
    first = stored(likely_pairs(members), "jaccard-pairs")
    wanted = first.select(F.col("a").alias("sig")).union(first.select(F.col("b").alias("sig"))).distinct()
    frags = stored(fragments(docs, sets, wanted), "jaccard-fragments")
    found = stored(verified(first, frags).select("a", "b"), "jaccard-links")
    label = components(found)
    # Sets outside the forests have no possible partner, and lists inside one component no open question.
    again = lists.join(wanted, "sig", "left_semi").join(label, F.col("sig") == F.col("node"), "left")
    again = again.select("list_id", "sig", F.coalesce("component", "sig").alias("component"))
    mixed = again.groupBy("list_id").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi")
    again = again.join(mixed.select("list_id"), "list_id", "left_semi")
    again = again.join(frags.filter("fragment = 0").select("sig", "n", "sketch"), "sig")
    rest = remaining_pairs(again).join(first, ["a", "b"], "left_anti")
    return found.union(verified(rest, frags).select("a", "b"))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, sig, component, component_id), one row per input row; ``component`` is a set's identity."""
    sets = stored(document_sets(docs), "jaccard-sets")
    label = components(links(docs, sets))
    rows = sets.select("doc_id", "n_shingles", "sig").join(label, F.col("sig") == F.col("node"), "left")
    rows = rows.withColumn("component", F.coalesce("component", "sig")).drop("node")
    low = rows.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    out = rows.join(low, "component")
    alone = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", "sig", "component", alone.alias("component_id"))


def signature(text) -> F.Column:
    """Column expression: the 64-bit identity of a text's n-gram set."""

    @F.arrow_udf(T.LongType())
    def sig(column: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([column], ["text"])
        parts = [signatures(*shingle_sets(p.column(0))).view(np.int64) for p in V.pieces_of(batch, "text", PIECE_BYTES)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64))

    return sig(F.coalesce(text, F.lit("")))


def one_per_component(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) that stay: of each component the one with the smallest id.

    Texts without n-grams are in no group and all stay; of rows equal in id and n-grams one stays.
    """
    columns = docs.columns
    none = int(signatures(np.zeros(0, np.uint64), np.zeros(2, np.int64)).view(np.int64)[0])
    comp = jaccard_components(docs).filter(F.col("n_shingles") > 0)
    stay = comp.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "sig")).alias("s"))
    stay = stay.select(F.col("s.doc_id").alias("__id"), F.col("s.sig").alias("__sig"))
    rows = docs.withColumn("__own", signature(F.col("text")))
    rows = rows.join(stay, rows["doc_id"].eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__sig")), "left")
    rank = F.row_number().over(Window.partitionBy("doc_id", "__own").orderBy(F.lit(1)))
    out = rows.withColumn("__rank", rank)
    return out.filter((F.col("__own") == none) | (F.col("__sig").isNotNull() & (F.col("__rank") == 1))).select(*columns)
