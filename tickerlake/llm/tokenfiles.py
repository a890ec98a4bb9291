"""Operator 12, token files: Parquet list columns of token ids with controlled encodings, row groups and page indexes.

One row is one document: ``doc_id``, ``n_tokens``, the number ``before`` of tokens of
its file that stand before it, the file's number ``part``, and the list ``ids``.
Documents ascend by id through the files, which are written from ranges of the id, so
no order is made in one task. Ids are dictionary-encoded (16 bits or fewer for a
vocabulary of 50,000), the numbers delta-encoded; small pages with their page index let
a reader skip to some documents' ids, and a reader of ``metadata`` never touches the ids' pages.

A file's first token has the number of all tokens in lower files: one small sum per
file, taken from the metadata columns alone.

Defined results: a null or empty text is the end id alone; very long texts are written
whole, in one row; rows that share an id are ordered as dealt and all written; a null id
comes first; an empty table gives no rows; only id and text are read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickerlake.llm.common import map_arrow, texts
from tickerlake.llm.wordbpe import word_ids
from tickerlake.session import shared_dir

SCHEMA = "doc_id long, part int, before long, n_tokens long, ids array<int>"
NUMBERS = ("doc_id", "part", "before", "n_tokens")
#: Bytes of ids gathered before a batch is handed on.
FLUSH = 16 << 20
#: Row groups of 32 MB, pages of 64 kB or 2,000 documents; delta encoding (format 2 without a dictionary) for the numbers.
OPTIONS = {"parquet.writer.version": "PARQUET_2_0", "parquet.block.size": str(32 << 20), "parquet.page.size": str(64 << 10),
           "parquet.page.row.count.limit": "2000", "parquet.enable.dictionary": "true", "parquet.dictionary.page.size": str(1 << 20),
           **{f"parquet.enable.dictionary#{c}": "false" for c in NUMBERS}, "compression": "zstd"}


def encoded(docs: DataFrame, tokenizer: str, end: int) -> DataFrame:
    """The rows of ``SCHEMA`` in ascending order of the id, one range of ids per partition."""
    last = np.asarray([end], "<u4").tobytes()
    ordered = texts(docs).withColumn("row", F.monotonically_increasing_id())
    ordered = ordered.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row")
    ordered = ordered.select("doc_id", "text", F.spark_partition_id().alias("part"))

    def batch(keys, parts, before, ids):
        sizes = np.array([len(b) // 4 for b in ids], np.int64)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<i4"), pa.int32()))
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(parts, pa.int32()), pa.array(before, pa.int64()),
                                           pa.array(sizes, pa.int64()), lists], ["doc_id", "part", "before", "n_tokens", "ids"])

    def run(batches):
        t, reached = word_ids(tokenizer), 0
        for b in batches:
            held: tuple[list, list, list, list] = ([], [], [], [])
            room = FLUSH
            for key, text, part in zip(*(c.to_pylist() for c in b.columns)):
                ids = t.ids(text) + last
                for col, v in zip(held, (key, part, reached, ids)):
                    col.append(v)
                reached += len(ids) // 4
                room -= len(ids)
                if room < 0:
                    yield batch(*held)
                    held, room = ([], [], [], []), FLUSH
            if held[0]:
                yield batch(*held)

    return ordered.mapInArrow(run, SCHEMA)


@dataclass(frozen=True)
class TokenFiles:
    """Token files below one folder."""

    spark: SparkSession
    path: str

    def rows(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def metadata(self) -> DataFrame:
        """(doc_id, part, before, n_tokens): the ids' pages are not read."""
        return self.rows().select(*NUMBERS)

    def file_starts(self) -> DataFrame:
        """(part, base): the number of all tokens in lower files; one row per file."""
        sums = self.metadata().groupBy("part").agg(F.sum("n_tokens").alias("__n"))
        lower = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        return sums.select(F.col("part").alias("__part"), F.coalesce(F.sum("__n").over(lower), F.lit(0).cast("long")).alias("base"))

    def with_starts(self, rows: DataFrame) -> DataFrame:
        """``rows`` of these files with ``start``, the number of all tokens before the document."""
        at = self.file_starts()
        out = rows.join(at, rows["part"] == at["__part"])
        return out.withColumn("start", F.col("base") + F.col("before")).drop("base", "__part")

    def documents(self, lowest: int, highest: int) -> DataFrame:
        """Rows of the documents with ids in the range; other pages are skipped by the page index."""
        return self.rows().where(F.col("doc_id").between(lowest, highest))

    def tokens(self, start: int, stop: int) -> DataFrame:
        """(start, ids): the pieces of tokens ``start`` up to ``stop`` of the whole order, one row per document touched."""
        hit = self.with_starts(self.rows()).where((F.col("start") < stop) & (F.col("start") + F.col("n_tokens") > start))
        a = F.greatest(F.lit(start) - F.col("start"), F.lit(0))
        b = F.least(F.lit(stop) - F.col("start"), F.col("n_tokens"))
        return hit.select((F.col("start") + a).alias("start"), F.slice("ids", (a + 1).cast("int"), (b - a).cast("int")).alias("ids"))

    def checksums(self) -> DataFrame:
        """(doc_id, start, n_tokens, ids_crc32) of every document, read back from the files."""
        def run(batch):
            lists = batch.column(3)
            body = np.asarray(lists.values.to_numpy(zero_copy_only=False), "<i4").tobytes()
            at = lists.offsets.to_numpy()
            crc = [zlib.crc32(memoryview(body)[4 * a:4 * b]) for a, b in zip(at, at[1:])]
            sizes = pa.array(np.diff(at), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], sizes, pa.array(crc, pa.int64())],
                                             ["doc_id", "part", "before", "n_tokens", "ids_crc32"])

        rows = map_arrow(self.rows().select("doc_id", "part", "before", "ids"), run, "doc_id long, part int, before long, n_tokens long, ids_crc32 long")
        return self.with_starts(rows).select("doc_id", "start", "n_tokens", "ids_crc32")


def write_tokens(docs: DataFrame, tokenizer: str, end: int, path: str | None = None) -> TokenFiles:
    """Write every document's ids, ``end`` behind each, below ``path`` (a new shared folder by default)."""
    spark = docs.sparkSession
    path = path or shared_dir(spark, "token-files")
    encoded(docs, tokenizer, end).write.options(**OPTIONS).parquet(path)
    return TokenFiles(spark, path)
