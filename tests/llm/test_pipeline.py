import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))


def test_pipeline_stages(spark, edge):
    import corpus_pipeline as p

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    from tickerlake.llm.common import stored
    for name, stage in p.STAGES:
        docs = stored(stage(spark, docs, sf), "test-pipeline")
        counts.append(docs.count())
        if name != p.STAGES[-1][0]:
            assert docs.columns == columns, name
    assert [n for n, _ in p.STAGES] == ["quality", "near_duplicates", "repeated_passages", "mixture", "packing"]
    assert counts[0] > counts[1] > counts[2] == counts[3] and counts[-1] >= counts[-2]


def test_pipeline_edges(spark, edge, nothing):
    import corpus_pipeline as p

    for docs in (edge[0], nothing):
        for name, stage in p.STAGES:
            docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.count() >= 0


def test_stages_equal_plain_versions(spark, edge, tmp_path):
    """Survivors, cut texts and packed pieces on the edge rows against brute force, stage by stage and for the whole of run()."""
    import zlib

    import brute
    import corpus_pipeline as p
    import numpy as np
    import public_tokenizers
    from tickerlake.llm import jaccard, repeats
    from tokenizers import Tokenizer

    key = lambda r: tuple((v is not None, v) for v in r)
    ordered = lambda rows: sorted(map(tuple, rows), key=key)
    df = edge[0]
    rows = [(r[0], r[1], r[3]) for r in edge[1]]
    assert ordered(jaccard.one_per_component(df).select("doc_id", "text").collect()) == ordered(r[:2] for r in brute.survivors(rows))
    assert ordered(repeats.without_repeats(df).select("doc_id", "text").collect()) == ordered(r[:2] for r in brute.cut_text(rows))
    # Without labels the classifier keeps every row.
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    lib, want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), []
    for k, text, _ in brute.mixed(brute.cut_text(brute.survivors(rows)), cut_last=False):
        ids = np.array(lib.encode(text, add_special_tokens=False).ids + [0], "<u4")
        size = p.SEQUENCE_TOKENS
        want += [(k, n, a, len(ids[a:a + size]), zlib.crc32(ids[a:a + size].tobytes())) for n, a in enumerate(range(0, len(ids), size))]
    assert ordered(tuple(g)[:5] for g in p.run(spark, str(tmp_path)).collect()) == ordered(want)
