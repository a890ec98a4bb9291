import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tickerlake.llm import (classifier, components, fingerprints, jaccard, licenses, mixing, packing, repeats, rules, sharding, tokencount)

WORDS, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")


def key(r):
    return tuple((v is not None, v) if not isinstance(v, float) else (True, round(v, 9)) for v in r)


def same(got, want):
    return sorted(got, key=key) == sorted(want, key=key)


# --- 1 packing -------------------------------------------------------------------------------------------------------

def check_packing(placed, capacity):
    used = defaultdict(list)
    for length, seq, offset in placed:
        used[seq].append((offset, length))
    for items in used.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    return len(used)


def test_packing_edges(edge, nothing):
    df, rows = edge
    got = packing.packed_documents(df, WORDS, 256).collect()
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(WORDS)
    want = []
    for r in rows:
        ids = np.array(lib.encode(r[1] or "", add_special_tokens=False).ids + [0], "<u4")
        want += [(r[0], n, a, len(ids[a:a + 256]), zlib.crc32(ids[a:a + 256].tobytes())) for n, a in enumerate(range(0, len(ids), 256))]
    assert same([tuple(g)[:5] for g in got], want)
    n = check_packing([(g["length"], g["sequence_id"], g["offset"]) for g in got], 256)
    assert n <= math.ceil(sum(g["length"] for g in got) / 256) * 1.05 + 1
    assert packing.packed_documents(nothing, WORDS).count() == 0


@pytest.mark.parametrize("seed", range(12))
def test_planner_is_valid_and_near_optimal(seed):
    rng = random.Random(seed)
    cap = rng.choice([10, 50, 100])
    counts = Counter(rng.randint(1, cap if seed % 2 else cap // 2) for _ in range(rng.choice([1, 20, 300])))
    plan = packing.Planner(dict(counts), cap).plan()
    lengths = np.repeat(list(counts), list(counts.values()))
    ranks = np.concatenate([np.arange(n) for n in counts.values()])
    seq, offset = packing.look_up(plan, lengths, ranks)
    n = check_packing(list(zip(lengths.tolist(), seq.tolist(), offset.tolist())), cap)
    assert n <= math.ceil(11 / 9 * math.ceil(lengths.sum() / cap)) + 1


def test_reduction_fixes_only_dominating_sets():
    p = packing.Planner({6: 3, 4: 3, 10: 2, 9: 1}, 10)
    p.reduce()
    assert p.fixed == 9 and p.sequences == 6 and p.count.sum() == 0  # 6+4 three times, 10 alone twice, 9 alone


def exact_bins(items, cap):
    best = len(items)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for b in range(len(bins)):
            if bins[b] + items[i] <= cap and bins[b] not in bins[:b]:
                bins[b] += items[i]
                go(i + 1, bins)
                bins[b] -= items[i]
        go(i + 1, [*bins, items[i]])

    go(0, [])
    return best


@pytest.mark.parametrize("seed", range(30))
def test_reduction_keeps_an_optimum(seed):
    rng = random.Random(seed)
    cap = 20
    items = sorted((rng.randint(3, 18) for _ in range(9)), reverse=True)
    p = packing.Planner(dict(Counter(items)), cap)
    p.reduce()
    rest = [x for x in range(cap, 0, -1) for _ in range(int(p.count[x]))]
    assert p.sequences + exact_bins(rest, cap) == exact_bins(items, cap)


def test_word_ids_equal_the_library():
    from tickerlake.llm.wordbpe import WordIds
    w = WordIds(WORDS)
    lib = lambda t: np.array(w.lib.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
    for c in map(chr, [*range(0x3000), 0x212A, 0x212B, 0x1E9E, 0xFB01, 0xAC00, 0x1F600]):
        for t in (c, f"a{c}b", f"1{c} {c}'s"):
            assert w.ids(t) == lib(t), (hex(ord(c)), t)
    rng = random.Random(3)
    pools = [[chr(c) for c in range(1, 0x250)], [chr(c) for c in range(0x20, 0x7F)], [chr(c) for c in range(0xA1, 0x250)] + list("  abXY'12"), list("'sStTrReEvVmMlLdD ")]
    for i in range(20_000):
        t = "".join(rng.choices(pools[i % 4], k=rng.randint(0, 30)))
        assert w.ids(t) == lib(t), t
    w.ids("x" * 100_000)
    assert max(map(len, w.words)) <= 32
    for t in ["", "Don't STOP!!  it's 12½ <|endoftext|> ok", "Grüße, ÀÉÎ ß ªº x²", "İstanbul é 日本", "a\x1cb\x85c\xa0d", "''s'' -- ...", "we'll we'LL"]:
        assert w.ids(t) == np.array(w.lib.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t


# --- 2 sharding ------------------------------------------------------------------------------------------------------

def plain_jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * sharding.STEP + 1) & ((1 << 64) - 1)
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_hash_moves_rows_only_into_the_new_shard():
    keys = np.random.default_rng(1).integers(0, 1 << 63, 20_000, dtype=np.uint64)
    a, b = sharding.jump_hash(keys, 40), sharding.jump_hash(keys, 41)
    assert a[:300].tolist() == [plain_jump(int(k), 40) for k in keys[:300]]
    assert set(b[a != b]) == {40} and abs((a != b).mean() - 1 / 41) < 0.005
    assert np.bincount(a).max() < 1.2 * len(keys) / 40


def test_sharding_edges(edge, nothing):
    df, rows = edge
    got = sharding.assign_shards(df, 5).collect()
    assert same([(g["doc_id"], g["size"], g["text_crc32"]) for g in got],
                [(r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows])
    slots, by_id = defaultdict(list), defaultdict(set)
    for g in got:
        slots[g["shard"]].append(g["slot"])
        by_id[g["doc_id"]].add(g["shard"])
        assert g["grown_shard"] in (g["shard"], 5)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(len(s) == 1 for s in by_id.values())
    assert sharding.assign_shards(nothing, 5).count() == 0


# --- 3 mixing --------------------------------------------------------------------------------------------------------

def test_mixing_edges(edge, nothing):
    df, rows = edge
    got = mixing.mix(df, seed=3).collect()
    assert same([(g["doc_id"], g["size"]) for g in got], [(r[0], len(brute.WORD.findall(r[1] or ""))) for r in rows])
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for g in got:
        sizes[g["source"]] += g["size"]
        taken[g["source"]] += g["taken"]
        target[g["source"]] = g["target"]
        assert 0 <= g["taken"] <= 3 * g["size"] and g["taken"] >= g["epochs"] * g["size"]
    want = brute.mixture_targets(dict(sizes))
    assert target == pytest.approx(want)
    assert all(abs(taken[s] - want[s]) <= 2 for s in want)
    assert same([tuple(g) for g in got], [tuple(g) for g in mixing.mix(df.repartition(7), seed=3).collect()])
    assert mixing.mix(nothing).count() == 0


def test_mixed_documents_hold_the_taken_words(edge, nothing):
    df, rows = edge
    want = Counter()
    for g in mixing.mix(df).collect():
        want[g["doc_id"]] += g["taken"]
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    got = Counter()
    texts = defaultdict(set)
    for r in rows:
        texts[r[0]].add(r[1])
    for g in out.collect():
        got[g["doc_id"]] += len(brute.WORD.findall(g["text"]))
        assert any(t is not None and t.startswith(g["text"]) for t in texts[g["doc_id"]])
    assert got == +want
    assert mixing.mixed_documents(nothing).count() == 0
    # Without a cut, texts stay whole.
    whole = mixing.mixed_documents(df, cut_last=False)
    assert whole.columns == df.columns
    assert same([(g["doc_id"], g["text"], g["source"]) for g in whole.collect()], brute.mixed([(r[0], r[1], r[3]) for r in rows], False))
    assert mixing.mixed_documents(nothing, cut_last=False).count() == 0


def test_key_buckets_follow_the_keys_and_none_is_hot(spark):
    """Buckets never fall as keys grow, and at every quality hold at most three times an even share."""
    keys = [k / 500 for k in range(30_000)]
    df = spark.createDataFrame([(k,) for k in keys], "k double").select("k", mixing.key_bucket(F.col("k")).alias("b"))
    got = [r["b"] for r in df.sort("k").collect()]
    assert got == sorted(got) and got[0] == 0 and got[-1] == mixing.BUCKETS - 1
    for quality in (1 / 3, 0.5, 2 / 3, 0.9, 1.0):
        share = [math.exp(-quality * a) - math.exp(-quality * b) for a, b in zip(keys, keys[1:])]
        steps = [b - a for a, b in zip(got, got[1:])]
        assert all(s <= 3.01 * (n + 1) / mixing.BUCKETS for s, n in zip(share, steps))
        assert math.exp(-quality * keys[got.index(mixing.BUCKETS - 1)]) <= 3.01 / mixing.BUCKETS * 1.5


def test_sampling_follows_the_exponential_keys(spark):
    rows = [(i, "w " * (1 + i % 7), "s" if i % 2 else "t") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    whole = {r["doc_id"]: r for r in mixing.mix(df, seed=5).collect()}
    keys = {r["doc_id"]: r["__key"] for r in mixing.keyed(df, 5).collect()}
    for source in "st":
        order = sorted((i for i, _, s in rows if s == source), key=keys.get)
        parts = [whole[i]["part"] for i in order]
        full = [p == whole[i]["size"] for p, i in zip(parts, order)]
        end = full.index(False) if False in full else len(full)
        assert all(p == 0 for p in parts[end + 1:])


# --- 4 fingerprints --------------------------------------------------------------------------------------------------

def test_fingerprint_edges(edge, nothing):
    df, rows = edge
    one = {}
    for r in rows:  # distinct ids, as the next document is then plain
        one.setdefault(r[0], r)
    small = df.sparkSession.createDataFrame(list(one.values()), df.schema)
    got = {g["doc_id"]: g for g in fingerprints.edited_fingerprints(small).collect()}
    order = sorted((k for k in one if k is not None), reverse=True) + [None]
    after = dict(zip(order, order[1:] + order[:1]))
    errors, by_text = [], {}
    for k, r in one.items():
        t, nxt = r[1] or "", one[after[k]][1] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        g = got[k]
        assert (g["n_chars"], g["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        errors += [g["near_edited"] - brute.jaccard(brute.shingles(t, False), brute.shingles(edited, False)),
                   g["near_next"] - brute.jaccard(brute.shingles(t, False), brute.shingles(nxt, False))]
        assert by_text.setdefault(t, g["fingerprint"]) == g["fingerprint"]
    assert np.abs(errors).mean() < 0.02 and np.abs(errors).max() < 0.15
    assert fingerprints.edited_fingerprints(df).count() == len(rows)  # repeated ids too
    assert fingerprints.edited_fingerprints(nothing).count() == 0


@pytest.mark.parametrize("share", [0.2, 0.5, 0.8, 0.95])
def test_likeness_is_nearly_unbiased(spark, share):
    rng = random.Random(int(share * 100))
    rows = []
    for i in range(60):
        n = rng.choice([30, 120, 600])
        a = [f"w{rng.random()}" for _ in range(n)]
        b = a[:int(n * share)] + [f"v{rng.random()}" for _ in range(n - int(n * share))]
        rows.append((" ".join(a), " ".join(b)))
    df = spark.createDataFrame(rows, "a string, b string")
    df = fingerprints.with_codes(fingerprints.with_codes(df, "a", "ca"), "b", "cb")
    got = [r[0] for r in df.select(fingerprints.likeness(df["ca"], df["cb"])).collect()]
    want = [brute.jaccard(brute.shingles(a, False), brute.shingles(b, False)) for a, b in rows]
    assert abs(np.mean(got) - np.mean(want)) < 0.02 and np.abs(np.array(got) - want).max() < 0.17


# --- 5 classifier ----------------------------------------------------------------------------------------------------

def test_classifier_edges(spark, edge, nothing):
    df, rows = edge
    labels = spark.createDataFrame([(10, 1, 0), (13, 1, 0), (20, 1, 0), (41, 0, 1), (41, None, 1), (999, 0, 0), (None, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    got = classifier.classified(df, labels).collect()
    assert len(got) == len(rows) and all(g["kept"] is not None and 0 <= g["bad_probability"] <= 1 for g in got)
    none = spark.createDataFrame([], labels.schema)
    assert all(g["kept"] for g in classifier.classified(df, none).collect())
    kept = classifier.kept_documents(df, none)
    assert kept.columns == df.columns and kept.count() == len(rows)
    assert classifier.classified(nothing, labels).count() == 0 and classifier.kept_documents(nothing, labels).count() == 0


def test_classifier_holds_out(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    rows = labels.collect()
    train = [tuple(r) for r in rows if r["doc_id"] % 4]
    got = {r["doc_id"]: r["kept"] for r in classifier.classified(docs, spark.createDataFrame(train, labels.schema)).collect()}
    held = [r for r in rows if r["doc_id"] % 4 == 0]
    clean = [got[r["doc_id"]] for r in held if r["quality"] == 1 and r["toxic"] == 0]
    bad = [got[r["doc_id"]] for r in held if r["quality"] == 0 or r["toxic"] == 1]
    assert np.mean(clean) > 0.95 and np.mean(bad) < 0.3


def test_sparse_sites_shrink_to_their_prior(spark):
    rows = [("big", "x", -4.0)] * 300 + [("bad", "y", 4.0)] * 300 + [("tiny", "z", 4.0)]
    post = {r["__host"]: r for r in classifier.posteriors(spark.createDataFrame(rows, "host string, path string, evidence double")).collect()}
    assert post["big"]["path_rate"] < 0.1 < 0.9 < post["bad"]["path_rate"]
    assert post["big"]["path_rate"] < post["tiny"]["path_rate"] < post["bad"]["path_rate"]


# --- 6 n-gram Jaccard join -------------------------------------------------------------------------------------------

def test_remaining_pairs_leave_in_blocks_and_whole(spark, monkeypatch):
    """Members that no sketch tells apart: every pair between two components of a list, and none inside one."""
    monkeypatch.setattr(jaccard, "BLOCK_PAIRS", 700)
    body = jaccard.sketch(np.arange(100, dtype=np.uint64), 1)
    rows = [(g, g * 1000 + i, 100, body, i % 5 if g else i) for g in (0, 1) for i in range(60)]
    df = spark.createDataFrame(rows, "list_id long, sig long, n long, sketch binary, component long")
    got = {(r["a"], r["b"]) for r in jaccard.remaining_pairs(df).collect()}
    assert got == {(x[1], y[1]) for x in rows for y in rows if x[0] == y[0] and x[1] < y[1] and x[4] != y[4]}


def test_jaccard_edges(edge, nothing):
    df, rows = edge
    got = [(g["doc_id"], g["n_shingles"], g["component_id"]) for g in jaccard.jaccard_components(df).collect()]
    assert same(got, brute.jaccard_components([(r[0], r[1]) for r in rows]))
    assert jaccard.jaccard_components(nothing).count() == 0
    left = jaccard.one_per_component(df)
    assert left.columns == df.columns
    want = Counter()
    for k, n, c in set(got):
        if n and k == c:
            want[c] += 1
    kept = left.collect()
    empty = sum(1 for r in rows if not brute.shingles(r[1]))
    assert len(kept) == len({(c) for _, n, c in got if n}) + empty
    assert jaccard.one_per_component(nothing).count() == 0


def near(rng, words, n):
    w = list(words)
    for _ in range(n):
        w[rng.randrange(len(w))] = f"e{rng.random()}"
    return " ".join(w)


@pytest.mark.parametrize("seed", range(3))
def test_jaccard_finds_every_link(spark, seed):
    rng = random.Random(seed)
    rows, line = [], "one very common line that many texts hold in the same way"
    for group in range(25):
        words = [f"w{rng.randint(0, 3000)}" for _ in range(rng.choice([6, 9, 15, 30, 60, 150, 400]))]
        for _ in range(rng.choice([1, 2, 4, 8])):
            rows.append((len(rows), near(rng, words, rng.choice([0, 1, 2, len(words) // 40 + 1])) + (f"\n{line}" if rng.random() < 0.5 else "")))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = [(g["doc_id"], g["n_shingles"], g["component_id"]) for g in jaccard.jaccard_components(df).collect()]
    assert same(got, brute.jaccard_components(rows))


@pytest.mark.parametrize("seed", range(4))
def test_linked_sets_always_share_a_key(seed):
    """The pigeonhole argument, at the threshold itself and on sets of every size."""
    rng = np.random.default_rng(seed)
    for n in [*range(5, 60), 100, 255, 256, 257, 1000]:
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
        most = int(jaccard.most_different(np.int64(n), np.int64(n)))
        for drop in {0, most // 2, most}:
            out = drop // 2
            b = np.concatenate([a[out:], rng.integers(0, 1 << 63, drop - out, dtype=np.uint64)])
            if not jaccard.linked(len(np.intersect1d(a, b)), len(a), len(b)) or set(a) == set(b):
                continue
            h, off = np.concatenate([np.sort(a), np.sort(b)]), np.array([0, len(a), len(a) + len(b)])
            keys, owner = jaccard.candidate_keys(h, off, np.array([1, 2], np.uint64))
            assert set(keys[owner == 1]) & set(keys[owner == 2]), (n, drop)


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, 9), (9, 7), (300, 301), (8, 8)]
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 100 for i in range(100, 161)}, 5: 5, 9: 5, 7: 5, 300: 300, 301: 300}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 7 token counts --------------------------------------------------------------------------------------------------

def test_token_counts_edges(edge, nothing):
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    df, rows = edge
    got = [tuple(g) for g in tokencount.token_counts(df, PIECES, limit=100).collect()]
    want = []
    for r in rows:
        n = len(lib.encode(r[1] or ""))
        want.append((r[0], len((r[1] or "").encode()), n, n > 100))
    assert same(got, want)
    assert tokencount.token_counts(nothing, PIECES).count() == 0


def test_merging_equals_the_library():
    import sentencepiece
    lib, m = sentencepiece.SentencePieceProcessor(model_file=PIECES), tokencount.merger(PIECES)
    rng = random.Random(4)
    chars = "aaabcdeeehilnorst   \n\n\t.,!?'\"éßñ日本😀▁<>/s_0123456789\x00́"
    texts = ["".join(rng.choice(chars) for _ in range(rng.randint(0, 60))) for _ in range(600)]
    texts += ["<s> </s> <unk> <0x0A> <pad>", " " * 40, "a" * 3000, "\n" * 20, "▁▁ ▁", "https://www.example.org/a_b?c=1&d=e"]
    for t in texts:
        assert m.tokens(t) == len(lib.encode(t)), repr(t)


# --- 8 licence scans -------------------------------------------------------------------------------------------------

def test_license_edges(edge, nothing):
    df, rows = edge
    got = [tuple(g)[:6] for g in licenses.license_scan(df).collect()]
    assert same(got, [(r[0], *brute.license_base(r[1])) for r in rows])
    assert licenses.license_scan(nothing).count() == 0


def test_license_finds_edited_notices():
    s = licenses.scanner()
    noise = "thing of the other ".split()
    rng = random.Random(2)
    for notice, label in licenses.NOTICES.items():
        k = max(1, len(notice) // licenses.CHARS_PER_EDIT)
        for _ in range(5):
            t = list(notice)
            for _ in range(rng.randint(0, k)):
                i = rng.choice([j for j, c in enumerate(t) if c.isalpha()])
                t[i] = rng.choice("abcdefgh")
            text = " ".join(rng.choices(noise, k=50)) + " " + "".join(t) + " " + " ".join(rng.choices(noise, k=50))
            labels = s.scan(text)[5].split(",")
            assert label in labels, (notice, "".join(t))
    assert s.scan(" ".join(noise * 20))[5] == "" and s.scan("")[0] == 0


@pytest.mark.parametrize("seed", range(3))
def test_seeds_lose_no_match(seed):
    """Every match that scanning the whole text finds lies in a seeded window."""
    import regex
    s, rng = licenses.scanner(), random.Random(seed)
    pieces = list(licenses.NOTICES) + ["the", "license", "under", "rights", "public", "free of charge"]
    for _ in range(30):
        words = " ".join(rng.choice(pieces) for _ in range(12)).split()
        words = [w if rng.random() < 0.9 else w[:-1] + "q" for w in words]
        body = f" {' '.join(words)} "
        for text, _, k, seeds, pattern in s.notices:
            windows = s.candidates(body, len(text), k, seeds)
            for m in regex.finditer(rf"(?<= )(?:{regex.escape(text)}){{e<={k}}}(?= )", body):
                assert any(a <= m.start() and m.end() <= b for a, b in windows)


@pytest.mark.parametrize("seed", range(3))
def test_adjacent_notices_all_have_spans(seed):
    """Weaker notices before a better one count too: scan() gives the spans of a scan of the whole text, each planted one among them."""
    import regex
    s, rng = licenses.scanner(), random.Random(seed)
    spans = s.scan("relased undr the mit license released under the mit license")[7]
    assert [(x["first_word"], x["last_word"], x["edits"]) for x in spans if x["label"] == "mit"] == [(0, 4, 2), (5, 9, 0)]

    def whole(body, a, b, text, k):
        m = regex.compile(rf"(?b)(?<= )(?:{regex.escape(text)}){{e<={k}}}(?= )").search(body, a, b)
        return [*whole(body, a, m.start(), text, k), (m.start(), m.end(), sum(m.fuzzy_counts)), *whole(body, m.end(), b, text, k)] if m else []

    for notice, label in licenses.NOTICES.items():
        k, planted = max(1, len(notice) // licenses.CHARS_PER_EDIT), []
        for n in [k, *[rng.randint(0, k) for _ in range(4)], 0]:
            t = list(notice)
            for i in rng.sample([j for j, c in enumerate(t) if c != " "], n):
                t[i] = "0"
            planted.append(("".join(t), n))
        body = f" some words {' '.join(t for t, _ in planted)} and more "
        want = sorted((lab, *m) for text, lab, k, _, _ in s.notices for m in whole(body, 0, len(body), text, k))
        got = s.fuzzy(body)
        assert sorted(g[:4] for g in got) == want
        at = len(" some words ")
        for t, n in planted:
            assert (label, at, at + len(t), n) in want
            at += len(t) + 1
        assert len(s.scan(body)[7]) == len(want)


def test_thick_notices_take_linear_time():
    """Long runs of exact, edited and touching notices: the time follows the length, and the spans those of a plain scan."""
    import time
    s = licenses.scanner()
    for piece, count in (("all rights reserved ", 1), ("all rights reservd ", 1), ("relased undr the mit license ", 1)):
        took = []
        for n in (2_000, 16_000):
            t0 = time.process_time()
            found = s.scan(piece * n)[7]
            took.append(time.process_time() - t0)
            assert len(found) >= count * n and found[-1]["last_word"] == len(piece.split()) * n - 1
        assert took[1] < 24 * max(took[0], 0.02), (piece, took)


@pytest.mark.parametrize("seed", range(3))
def test_scores_and_labels_follow_from_the_spans(spark, seed):
    """Labels and score of whole texts, from the base phrases and the verified notices."""
    rng = random.Random(seed)
    texts = [" ".join(rng.choice([*licenses.NOTICES, *licenses.BASE, "the", "x y", "free Of charge", "relased under the mit licence"]) for _ in range(rng.randint(0, 6)))
             for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in licenses.license_scan(df).collect():
        base = {b for b in (r["base_labels"] or "").split(",") if b}
        assert r["base_labels"] == brute.license_base(texts[r["doc_id"]])[4]
        assert r["labels"] == ",".join(sorted(base | {x["label"] for x in r["spans"]}))
        lengths = {}
        for notice, label in licenses.NOTICES.items():
            lengths.setdefault(label, []).append(len(notice))
        best = max((max(1 - x["edits"] / n for n in lengths[x["label"]]) for x in r["spans"]), default=0.0)
        assert r["score"] == 1.0 if base else r["score"] <= best + 1e-12 and (r["score"] > 0) == bool(r["spans"])


# --- 9 repeated passages ---------------------------------------------------------------------------------------------

def test_repeats_edges(edge, nothing):
    df, rows = edge
    got = [tuple(g) for g in repeats.removed_repeats(df).collect()]
    assert same(got, brute.repeats([(r[0], r[1]) for r in rows]))
    assert repeats.removed_repeats(nothing).count() == 0
    out = repeats.without_repeats(df)
    assert out.columns == df.columns and out.count() == len(rows)
    assert repeats.without_repeats(nothing).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_repeats_at_every_offset_and_length(spark, seed):
    rng = random.Random(seed)
    letter = lambda n: "".join(rng.choice("abcd é\n") for _ in range(n))
    shared = [letter(n) for n in (30, 48, 49, 50, 51, 70, 200)]
    rows = [(rng.choice([i, i, i, 3]), letter(rng.randint(0, 90)).join(rng.choices(shared, k=rng.randint(1, 4))) + letter(rng.randint(0, 40))) for i in range(60)]
    rows += [(100, "a" * 200), (101, "a" * 120), (102, "ab" * 100), (103, "ab" * 90 + "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert same([tuple(g) for g in repeats.removed_repeats(df).collect()], brute.repeats(rows))


@pytest.mark.parametrize("least", [3, 9, 20])
def test_repeat_classes_equal_sorted_substrings(least):
    rng = random.Random(least)
    text = np.array([rng.choice([1, 2, 2, 3]) for _ in range(700)] + [0], np.uint8)
    order, cls = repeats.repeat_classes(text, least)
    assert sorted(order) == list(range(len(text)))
    body = text.tobytes()
    for a, b, x, y in zip(order, order[1:], cls, cls[1:]):
        p, q = body[a:a + least], body[b:b + least]
        if len(p) == len(q) == least:
            assert (x == y) == (p == q)


def test_a_common_string_with_different_surroundings_spreads(spark, monkeypatch):
    """No bucket holds all contexts of one anchor, and each repeat is still found."""
    from pyspark.sql import functions as F
    rng = random.Random(5)
    letter = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    tries = [letter(repeats.GRAM) for _ in range(20_000)]
    low = [int(repeats.gram_hashes(np.frombuffer(t.encode(), np.uint8))[0]) for t in tries]
    common = tries[int(np.argmin(low))]
    sides = [(letter(40), letter(40)) for _ in range(1500)]
    rows = [(i, a + common + b) for i, (a, b) in enumerate(sides)]
    rows += [(rng.choice([2000 + i, i]), letter(9) + sides[i][0][rng.randint(0, 9):] + common + letter(30)) for i in range(300)]
    rows += [(5000, f"{letter(60)}{common}{letter(5)}" * 3), (5000, f"{letter(70)}{common}{sides[7][1]}"), (None, letter(3) + rows[9][1])]
    for name, value in {"MOST_CONTEXTS": 100, "BUCKET_WINDOWS": 500, "BUCKET_BYTES": 10_000}.items():
        monkeypatch.setattr(repeats, name, value, raising=False)
    largest, kind = [], type(spark.range(0))
    group = kind.groupBy

    def watched(df, *by):
        if by == ("bucket",) and "body" in df.columns:
            sizes = group(df.select("bucket", F.expr("octet_length(ids) div 8").alias("n")), "bucket").agg(F.sum("n").alias("n"))
            largest.append(sizes.agg(F.max("n")).first()[0])
        return group(df, *by)

    monkeypatch.setattr(kind, "groupBy", watched)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert same([tuple(g) for g in repeats.removed_repeats(df).collect()], brute.repeats(rows))
    assert largest and max(largest) < 1000


def test_anchor_above_the_real_limit(spark):
    """More places than ``MOST_CONTEXTS`` of one anchor, all around it different, with a few repeats among them."""
    rng = random.Random(8)
    letter = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    tries = [letter(repeats.GRAM) for _ in range(20_000)]
    common = tries[int(np.argmin([int(repeats.gram_hashes(np.frombuffer(t.encode(), np.uint8))[0]) for t in tries]))]
    rows = [(i, letter(36) + common + letter(12)) for i in range(repeats.MOST_CONTEXTS + 500)]
    rows += [(100_000 + i, letter(3) + rows[7 * i][1][5:] + letter(4)) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = [tuple(g) for g in repeats.removed_repeats(df).collect()]
    assert same(got, brute.repeats(rows)) and sum(g[2] > 0 for g in got) >= 200
    assert not spark.catalog.listTables()


def test_anchors_depend_on_the_window_alone():
    rng = random.Random(1)
    part = bytes(rng.choice(b"abc ") for _ in range(300))
    seen = []
    for pad in (0, 7, repeats.CHUNK - 150):
        data = np.frombuffer(bytes(rng.choice(b"xyz") for _ in range(pad)) + part, np.uint8)
        keys, first, last = repeats.anchors(data, np.array([0, len(data)]))
        cover = {}
        for k, a, b in zip(keys, first, last):
            cover.update({w - pad: k for w in range(a, b + 1)})
        seen.append([cover[w] for w in range(251)])
    assert seen[0] == seen[1] == seen[2]


# --- 10 quality rules ------------------------------------------------------------------------------------------------

def test_rules_edges(edge, nothing):
    df, rows = edge
    got = rules.quality_rules(df).collect()
    assert same([tuple(g)[:7] for g in got], [(r[0], *brute.rules(r[1])) for r in rows])
    assert not any(g["kept"] for g in got if g["base_failed"])
    by_id = {g["doc_id"]: g for g in got}
    assert by_id[40]["kept"] and by_id[10]["kept"] and not by_id[42]["kept"] and by_id[42]["covered_10"] == 1.0
    assert rules.quality_rules(nothing).count() == 0


@pytest.mark.parametrize("size", [2, 5, 7])
def test_covered_words(size):
    rng = random.Random(size)
    docs = [" ".join(rng.choice("abcd") for _ in range(rng.randint(0, 60))) for _ in range(30)]
    import pyarrow as pa

    from tickerlake.llm import textvec as V
    data, off = V.column_bytes(pa.array(docs))
    start, end, first = V.words(data, off)
    hit = rules.covered_words(V.word_hashes(data, start, end), first, size)
    for i, d in enumerate(docs):
        w = d.split()
        grams = Counter(tuple(w[k:k + size]) for k in range(len(w) - size + 1))
        want = {k + j for k in range(len(w) - size + 1) if grams[tuple(w[k:k + size])] > 1 for j in range(size)}
        assert set(np.flatnonzero(hit[first[i]:first[i + 1]])) == want


# --- 5 quality classifier: plain versions -----------------------------------------------------------------------------

def plain_verdicts(rows):
    """{id: (host rate, path rate, kept)} of (id, host, path, evidence) rows by the empirical Bayes rule, in plain Python."""
    bad = lambda e: 1 / (1 + math.exp(-e))
    logit = lambda p: math.log(min(max(p, 1e-6), 1 - 1e-6) / (1 - min(max(p, 1e-6), 1 - 1e-6)))

    def strength(sites):  # (n, bad documents, prior) of each site
        whole = sum(n * q * (1 - q) for n, _, q in sites)
        if not whole:
            return 1e6
        spread, chance = sum(n * (b / n - q) ** 2 for n, b, q in sites), sum(q * (1 - q) for _, _, q in sites)
        return min(max(1 / max((spread - chance) / whole, 1e-6) - 1, 1.0), 1e6)

    hosts, paths = defaultdict(lambda: [0, 0.0]), defaultdict(lambda: [0, 0.0])
    for _, host, path, e in rows:
        for site in (hosts[host], paths[host, path]):
            site[0] += 1
            site[1] += bad(e)
    overall = sum(b for _, b in hosts.values()) / len(rows)
    k = strength([(n, b, overall) for n, b in hosts.values()])
    host_rate = {h: (b + k * overall) / (n + k) for h, (n, b) in hosts.items()}
    k = strength([(n, b, host_rate[h]) for (h, _), (n, b) in paths.items()])
    path_rate = {s: (b + k * host_rate[s[0]]) / (n + k) for s, (n, b) in paths.items()}
    return {i: (host_rate[h], path_rate[h, p], e + logit(path_rate[h, p]) - logit(overall) <= 0) for i, h, p, e in rows}


@pytest.mark.parametrize("seed", range(2))
def test_posteriors_and_verdicts_equal_plain_ones(spark, seed):
    rng = random.Random(seed)
    rows = [(i, h := rng.choice(["a", "b", None, f"rare{i % 37}"]), rng.choice(["p", "q", None]), rng.gauss(3 if h == "b" else -2, 2)) for i in range(400)]
    scored = spark.createDataFrame(rows, "id long, host string, path string, evidence double")
    sites = {(r["__host"], r["__path"]): r for r in classifier.posteriors(scored).collect()}
    for i, (host_rate, path_rate, kept) in plain_verdicts(rows).items():
        _, h, p, e = rows[i]
        got = sites[h, p]
        assert math.isclose(got["host_rate"], host_rate, rel_tol=1e-9) and math.isclose(got["path_rate"], path_rate, rel_tol=1e-9)
        assert (e + got["shift"] <= 0) == kept


def test_screening_on_the_executors_equals_a_plain_one(spark):
    """The models are those of a plain chi-square over all features of the sample, on one row per id."""
    rng = random.Random(4)
    word = lambda bad: rng.choice(["spam", "win", "click"] if bad and rng.random() < 0.5 else ["tree", "house", "road", "water", "light"])
    docs = [(i, " ".join(word(i % 3 == 0) for _ in range(30))) for i in range(300)]
    labels = [(i, 0 if i % 3 == 0 else 1, 1 if i % 5 == 0 else 0) for i, _ in docs]
    body = spark.createDataFrame([*docs, *([docs[5]] * 2000), (7, "zzz other text"), (7, None)], "doc_id long, text string").repartition(6)
    kept = spark.createDataFrame(labels, "doc_id long, quality long, toxic long")
    sample = classifier.labelled_sample(body, kept, 250).collect()
    assert len(sample) == 250                                # one row per id, however many rows hold it
    import pyarrow as pa
    doc, feature = classifier.features(pa.array([r["text"] for r in sample]))
    for model, name in zip(classifier.train(body, kept, 250), ("poor", "toxic")):
        y = np.array([float(r[name]) for r in sample])
        n, bad = len(y), y.sum()
        df, hit = np.bincount(feature, minlength=classifier.SIZE).astype(float), np.bincount(feature, y[doc], classifier.SIZE)
        expected = df * bad / n
        chi = (hit - expected) ** 2 / np.maximum(expected * (1 - bad / n) * (1 - df / (n + 1)), 1e-9)
        chi[df < classifier.LEAST_DOCS] = 0
        assert set(model.feature) == set(np.flatnonzero(chi > 4))
        again = classifier.fit(doc, feature, y, model.feature)
        assert np.allclose(sorted(again.weight), sorted(model.weight), atol=1e-6)
