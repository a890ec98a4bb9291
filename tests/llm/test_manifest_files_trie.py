"""The manifest, the token files and the conversation trie against plain versions."""

import random
import sys
import zlib
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

import brute
import numpy as np
import public_tokenizers
from conftest import SCHEMA, row
from pyspark.sql import types as T

from tickerlake.llm import common, manifest, tokenfiles, trie

WORDS = public_tokenizers.path("word_bpe_49k.json")
FIXED = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


# --- ordered totals -------------------------------------------------------------------------------------------------

def test_running_totals_over_split_groups(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None, "a", "a"]), rng.randint(0, 4), i, rng.randint(-50, 50)) for i in range(400)]
    df = common.stored(spark.createDataFrame(rows, "g string, o int, row int, v long").repartition(5), "t")
    got = common.running_before(df, ["g"], ["o", "row"], {"nr": None, "s": "v"}, total="n", per_part=40).collect()
    xor = {r["row"]: r["x"] for r in common.running_before(df, ["g"], ["o", "row"], {"x": "v"}, how="xor", per_part=40).collect()}
    groups = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        groups.setdefault(r[0], []).append(r)
    want, want_x = set(), {}
    for g, rs in groups.items():
        total = x = 0
        for i, r in enumerate(rs):
            want.add((g, r[2], i, total, len(rs)))
            want_x[r[2]] = x
            total, x = total + r[3], x ^ r[3]
    assert {(r["g"], r["row"], r["nr"], r["s"], r["n"]) for r in got} == want and len(got) == 400
    assert xor == want_x


# --- 11 manifest ----------------------------------------------------------------------------------------------------

def plain_manifest(rows):
    return brute.manifest(rows)


def test_manifest_of_edge_rows(edge):
    df, rows = edge
    got = Counter(tuple(r) for r in manifest.document_manifest(df).select(*FIXED).collect())
    assert got == plain_manifest(rows)


@pytest.mark.parametrize("sizes", [{"x": 1}, {"x": 8, None: 1}, {"x": 9, "y": 64, "z": 65}, {f"g{i:02}": 1 for i in range(11)}])
def test_manifest_of_group_sizes(spark, sizes, monkeypatch):
    monkeypatch.setattr(common, "ROWS_PER_RANK_PART", 10)
    rows = [row(i * 100 + j, f"Text {j}", lang=g) for i, (g, n) in enumerate(sizes.items()) for j in range(n)]
    random.Random(1).shuffle(rows)
    got = Counter(tuple(r) for r in manifest.document_manifest(spark.createDataFrame(rows, SCHEMA).repartition(3)).select(*FIXED).collect())
    assert got == plain_manifest(rows)
    assert len(rows) < 20 or {r[-1] for r in got} == {True, False}


def test_manifest_of_nothing(nothing):
    assert manifest.document_manifest(nothing).count() == 0


# --- 12 token files -------------------------------------------------------------------------------------------------

def library_ids(text):
    from tokenizers import Tokenizer
    return [*Tokenizer.from_file(WORDS).encode(text or "", add_special_tokens=False).ids, 2]


def test_runs_between_white_space_are_cut_once(monkeypatch):
    from tickerlake.llm import wordbpe
    w, rng = wordbpe.WordIds(WORDS), random.Random(11)
    signs = [*w.beyond, *"abcdeABC019 '._-(\n\t" * 6]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 90))) for _ in range(400)] + ["It's the End, isn't IT? (1985) déjà-vu, déjà vu"]
    texts = [t for t in texts if w.plain(t)]
    want = [np.asarray(w.lib.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    monkeypatch.setattr(w, "_library", None)  # words beyond ASCII are merged without it
    assert len(texts) > 300 and [w.ids(t) for t in texts] == want
    short = [t for t in texts if all(len(run) <= wordbpe.LONGEST_REMEMBERED for run in t.split())]
    monkeypatch.setattr(w, "cut", None)
    assert short and [w.ids(t) for t in short] == [want[texts.index(t)] for t in short]


@pytest.fixture(scope="module")
def written(edge):
    return tokenfiles.write_tokens(edge[0], WORDS, 2)


def test_token_files_hold_every_document_in_order(edge, written):
    rows = edge[1]
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in written.checksums().collect())
    want = Counter((r[0], len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())) for r in rows for ids in [library_ids(r[1])])
    assert Counter(g[1:] for g in got) == want
    assert [g[0] for g in got] == [sum(n for *_, n, _ in got[:i]) for i in range(len(got))]
    assert [g[1] for g in got] == sorted((r[0] for r in rows), key=lambda k: (k is not None, k or 0))


def test_token_files_are_encoded_as_asked(edge, written):
    import pyarrow.parquet as pq
    files = sorted(Path(written.path.removeprefix("file:")).glob("*.parquet"))
    assert len(files) >= 1
    for f in files:
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            for c in range(meta.num_columns):
                col = meta.row_group(g).column(c)
                assert col.has_offset_index and col.has_column_index
                if col.path_in_schema in tokenfiles.NUMBERS:
                    assert "DELTA_BINARY_PACKED" in col.encodings, (col.path_in_schema, col.encodings)
                else:
                    assert "RLE_DICTIONARY" in col.encodings


def test_token_files_read_selectively(edge, written):
    rows = [r for r in edge[1] if r[0] is not None and 13 <= r[0] <= 18]
    got = written.documents(13, 18)
    plan = got._jdf.queryExecution().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(doc_id,13)" in plan
    assert sorted((r["doc_id"], tuple(r["ids"])) for r in got.collect()) == sorted((r[0], tuple(library_ids(r[1]))) for r in rows)
    assert "ids:array" not in written.metadata()._jdf.queryExecution().toString().split("ReadSchema")[-1]
    all_ids = [i for r in sorted(((r["start"], r["ids"]) for r in written.with_starts(written.rows()).collect())) for i in r[1]]
    for a, b in ((0, 7), (1000, 40_000), (len(all_ids) - 3, len(all_ids) + 9), (5, 5)):
        part = sorted((r["start"], r["ids"]) for r in written.tokens(a, b).collect())
        assert [i for _, ids in part for i in ids] == all_ids[a:b]
        assert not part or part[0][0] == a


def test_token_files_of_nothing(nothing):
    assert tokenfiles.write_tokens(nothing, WORDS, 2).checksums().count() == 0


# --- 13 trie --------------------------------------------------------------------------------------------------------

TURNS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                      T.StructField("text", T.StringType()), *[T.StructField(c, T.StringType()) for c in ("block", "seq", "more", "n", "h", "first", "pos", "row")]])


def plain_rows(out):
    return sorted((r["conv_id"], r["depth"], -1 if r["parent_conv_id"] is None else r["parent_conv_id"], r["n_convs"], r["n_children"],
                   r["n_leaves"], r["saved_tokens"], r["ends_sha256"]) for r in out.collect())


def conversations(rng):
    rows, say = [], lambda: rng.choice(["hello", "yes", "no", "why?", "é" * 3, "", None, "tell me more"])
    shared = [("user", say()) for _ in range(200)]
    for c in range(60):
        n = rng.choice([1, 2, 3, 5, 8, 12])
        turns = [(rng.choice(["user", "bot", None]), say()) for _ in range(n)]
        if c % 7 == 0:  # long ones that leave a common path at various depths, block edges among them
            turns = shared[:rng.choice([63, 64, 65, 127, 128, 129, 200])] + [("user", "end")] * rng.choice([0, 0, 1, 3])
        if c % 4 == 1:
            turns = shared[:9]
        rows += [(c, None if rng.random() < 0.02 else i, *t) for i, t in enumerate(turns)]
    rows += [(7, 3, "user", "again"), (7, 3, "user", "again"), (1003, 0, "user", "alone"), (None, 0, "user", "nobody's"), (-4, 1, "user", None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,per_range", [(1, 20_000), (2, 3), (3, 7), (4, 1)])
def test_trie_equals_plain_version(spark, monkeypatch, seed, per_range):
    monkeypatch.setattr(trie, "ROWS_PER_RANGE", per_range)
    monkeypatch.setattr(common, "ROWS_PER_RANK_PART", 50)
    rows = conversations(random.Random(seed))
    df = spark.createDataFrame([(*r, *("x",) * 8) for r in rows], TURNS).repartition(4)
    assert plain_rows(trie.conversation_trie(df)) == brute.trie(rows)


def test_trie_of_copies_spread_over_ranges(spark, monkeypatch):
    monkeypatch.setattr(trie, "ROWS_PER_RANGE", 9)
    rows = [(5 * c, i, "user", t) for c in range(200) for i, t in enumerate(["a", "b", "c", "d"][:4 if c % 3 else 2])]
    df = spark.createDataFrame([(*r, *("x",) * 8) for r in rows], TURNS)
    assert plain_rows(trie.conversation_trie(df)) == brute.trie(rows)


def test_trie_of_nothing(spark):
    assert trie.conversation_trie(spark.createDataFrame([], TURNS)).count() == 0


def test_place_digest_is_the_column_digest(spark):
    from pyspark.sql import functions as F
    z = F.md5(F.lit("12:abc"))
    assert tuple(spark.range(1).select(trie._half(z, 1), trie._half(z, 17)).first()) == trie.place_digest(12, "abc")


def test_ternary_tree_is_balanced_by_medians():
    tree = trie.TernaryTree()
    for i in trie.medians_first(1000):
        tree.insert([i, 0])

    def height(at):
        return 0 if at < 0 else 1 + max(height(tree.less[at]), height(tree.more[at]))
    assert height(tree.top) <= 10 and sorted(trie.medians_first(10)) == list(range(10))
