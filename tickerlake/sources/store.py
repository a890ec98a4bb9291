"""Parquet tables under one root folder (a shared filesystem on a cluster).

A run writes every table it changes into folders named by its run id and commits
them all at once: a manifest file, made visible by a single rename, lists the
folders that make up each table. Until then nothing of the run is visible, so a
run that stops anywhere can be repeated under the same id: it starts from the
committed state and overwrites its own folders. A run that is already committed
is not applied again.

The large tables are laid out in ``bucket=`` folders by a hash of Symbol. A
ticker rename rewrites only the buckets its symbols live in: the new folder holds
them, and the manifest no longer lists them for the older folders. Folders of about
the same size are merged when there are eight of them, so daily runs leave few
folders and each byte is rewritten about once per power of eight. The schema of a table that
gains columns is kept in the manifest. One writer at a time; readers see the last
committed manifest.
"""

from __future__ import annotations

import copy
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Stored table names (the key table keeps its historic name).
KEY_TABLE = "AllStocksKey"
PRICES = "TenYrPrices"
SHEETS = "Sheets"
DIVIDENDS = "Dividends"
LATEST = "LatestPrice"
STATUS = "Status"

BUCKET = "bucket"
MANIFESTS = "_manifests"
# Folders of one size class that a run merges into one; a class spans sizes up to this factor.
FOLDERS_PER_MERGE = 8
# Smallest size class: folders below it count alike.
LEAST_FOLDER_BYTES = 1 << 20
# Folder of rows that were written beside a table's own, to be counted.
ASIDE = -1

KEY_SCHEMA = T.StructType([T.StructField("Symbol", T.StringType()), T.StructField("Market", T.StringType())])
PRICE_SCHEMA = T.StructType([
    T.StructField("Symbol", T.StringType()), T.StructField("Reference", T.DateType()),
    T.StructField("Open", T.DoubleType()), T.StructField("High", T.DoubleType()),
    T.StructField("Low", T.DoubleType()), T.StructField("Close", T.DoubleType()),
    T.StructField("Volume", T.DoubleType())])
LATEST_SCHEMA = T.StructType([T.StructField("Symbol", T.StringType()),
                              T.StructField("last_reference", T.DateType())])
SHEET_SCHEMA = T.StructType([
    T.StructField("Symbol", T.StringType()), T.StructField("pos", T.LongType()),
    T.StructField("item", T.StringType()), T.StructField("label", T.StringType()),
    T.StructField("period", T.StringType()), T.StructField("value", T.DoubleType()),
    T.StructField("report", T.StringType()), T.StructField("freq", T.IntegerType())])
STATUS_SCHEMA = T.StructType([
    T.StructField("job", T.StringType()), T.StructField("step", T.StringType()),
    T.StructField("Symbol", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("n_rows", T.LongType()), T.StructField("run_id", T.StringType()),
    T.StructField("run_ts", T.TimestampType())])
# Tables with a fixed schema are read with it; others (dividends) may gain columns, and their schema is kept in the manifest.
SCHEMAS = {KEY_TABLE: KEY_SCHEMA, PRICES: PRICE_SCHEMA, LATEST: LATEST_SCHEMA, SHEETS: SHEET_SCHEMA, STATUS: STATUS_SCHEMA}


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


def symbol_bucket(symbol, buckets: int) -> Column:
    col = F.col(symbol) if isinstance(symbol, str) else symbol
    return F.pmod(F.xxhash64(col), F.lit(buckets)).cast("int")


@dataclass
class Store:
    spark: SparkSession
    root: str
    # Symbol buckets per table (folder layout). Size so one bucket holds a few
    # GB at the target scale, e.g. 1024-4096 for a multi-TB price history.
    buckets: dict = field(default_factory=lambda: {PRICES: 16, SHEETS: 16, DIVIDENDS: 16})

    def manifest(self) -> tuple[int, dict]:
        """Number and content of the last committed manifest (0 and empty before the first run)."""
        done = [n for n in _names(self.spark, f"{self.root}/{MANIFESTS}") if n.endswith(".json") and n[0] != "."]
        if not done:
            return 0, {"runs": [], "tables": {}, "schemas": {}}
        text = self.spark.read.option("wholetext", "true").text(f"{self.root}/{MANIFESTS}/{done[-1]}").first()[0]
        return int(done[-1].split(".")[0]), json.loads(text)

    def run(self, run_id: str) -> Run:
        return Run(self, run_id)

    def view(self) -> Run:
        """The committed tables, to read."""
        return Run(self, "")

    def read(self, name: str) -> DataFrame:
        return self.view().read(name)

    def exists(self, name: str) -> bool:
        return self.view().exists(name)

    def tables(self) -> list[str]:
        return self.view().names()

    def sweep(self) -> list[str]:
        """Delete folders that no table lists: those of stopped runs and of replaced data. No run may be under way."""
        _, state = self.manifest()
        live = {e["path"] for entries in state["tables"].values() for e in entries}
        gone = []
        for table in _names(self.spark, self.root):
            if table == MANIFESTS:
                continue
            for name in _names(self.spark, f"{self.root}/{table}"):
                if f"{table}/{name}" not in live:
                    fs, p = _fs(self.spark, f"{self.root}/{table}/{name}")
                    fs.delete(p, True)
                    gone.append(f"{table}/{name}")
        return gone


class Run:
    """One run's view of the tables: the committed state plus its own changes, which ``commit`` publishes together."""

    def __init__(self, store: Store, run_id: str):
        self.store, self.spark, self.run_id = store, store.spark, run_id
        self.number, state = store.manifest()
        self.state = copy.deepcopy(state)
        self.entries: dict[str, list[dict]] = self.state["tables"]
        self.schemas: dict[str, dict] = self.state.setdefault("schemas", {})
        self.done = run_id in self.state["runs"]
        self.writes = 0

    def names(self) -> list[str]:
        return sorted(self.entries)

    def exists(self, name: str) -> bool:
        return name in self.entries

    def read(self, name: str, only: list[int] | None = None) -> DataFrame:
        """The table's rows; ``only`` reads just those buckets."""
        if name not in self.entries:
            raise ValueError(f"table {name} does not exist")
        return self._rows(name, self.entries[name], only)

    def read_or_empty(self, name: str, schema=None) -> DataFrame:
        if name in self.entries:
            return self.read(name)
        return self.spark.createDataFrame([], schema or SCHEMAS[name])

    def schema(self, name: str) -> T.StructType:
        return SCHEMAS[name] if name in SCHEMAS else T.StructType.fromJson(self.schemas[name])

    def append(self, name: str, df: DataFrame) -> DataFrame:
        """Add rows (a table without a fixed schema may gain columns); returns them as stored."""
        entry = self._write(name, df)
        self.entries.setdefault(name, []).append(entry)
        return self._rows(name, [entry])

    def append_counted(self, name: str, df: DataFrame, aside: Column, extra: list[str]) -> tuple[DataFrame, DataFrame]:
        """Add the rows for which ``aside`` is false, in one pass over ``df``.

        The others go to a folder of their own, which the table does not list. Returns the stored rows, and all
        written rows as (Symbol, ``extra``) to be counted from those columns alone.
        """
        kinds = [f for f in df.schema.fields if f.name in extra]
        entry = self._write(name, df, aside, extra)
        self.entries.setdefault(name, []).append(entry)
        told = T.StructType([T.StructField("Symbol", T.StringType()), *kinds])
        whole = self.spark.read.schema(told).option("recursiveFileLookup", "true").parquet(f"{self.store.root}/{entry['path']}")
        return self._rows(name, [entry]), whole

    def replace(self, name: str, df: DataFrame) -> DataFrame:
        """Make ``df`` the whole table; it may read the table's present rows."""
        entry = self._write(name, df)
        self.entries[name] = [entry]
        return self._rows(name, [entry])

    def rename_symbols(self, name: str, mapping: DataFrame, apply: Callable[[DataFrame, DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
        """Apply a rename map (Old -> New): only the buckets of its Old and New symbols are rewritten.

        Tables without buckets hold one row per symbol and are replaced. An empty map changes nothing.
        Returns the rows of the touched part (all buckets the map names) before and after.
        """
        n = self.store.buckets.get(name)
        before = self.read(name)
        if n is None:
            return before, before if mapping.isEmpty() else self.replace(name, apply(before, mapping))
        moved = mapping.select(F.explode(F.array("Old", "New")).alias("s")).select(symbol_bucket("s", n).alias("b")).distinct()
        touched = sorted(r.b for r in moved.collect())  # at most n small ints
        if not touched:
            return before.limit(0), before.limit(0)
        before = self.read(name, touched)
        entry = self._write(name, apply(before, mapping))
        kept = [{**e, "buckets": [b for b in e["buckets"] if b not in touched]} for e in self.entries[name]]
        self.entries[name] = [e for e in kept if e["buckets"]] + [entry]
        return before, self._rows(name, [entry])

    def compact(self, name: str, most: int = FOLDERS_PER_MERGE) -> int:
        """Merge a table's folders of one size class once there are ``most`` of them; its rows stay the same.

        The class of a merged folder is a higher one, so large folders are seldom read. Returns the bytes rewritten.
        """
        rewritten = 0
        while True:
            classes: dict[int, list[dict]] = {}
            for e in self.entries.get(name, []):
                classes.setdefault(max(size_class(e["bytes"], most), e.get("least", 0)), []).append(e)
            full = min((n for n, entries in classes.items() if len(entries) >= most), default=None)
            if full is None:
                return rewritten
            merged = classes[full]
            # A merged folder is of a higher class, however small, or it would be merged again with each few new ones.
            entry = {**self._write(name, self._rows(name, merged)), "least": full + 1}
            rewritten += sum(e["bytes"] for e in merged)
            self.entries[name] = [e for e in self.entries[name] if e not in merged] + [entry]

    def commit(self) -> None:
        """Publish all changes of the run by one rename."""
        self.state["runs"].append(self.run_id)
        root = f"{self.store.root}/{MANIFESTS}"
        fs, tmp = _fs(self.spark, f"{root}/.{uuid.uuid4().hex}")
        out = fs.create(tmp)
        out.write(bytearray(json.dumps(self.state).encode()))
        out.close()
        final = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{self.number + 1:012d}.json")
        if fs.exists(final) or not fs.rename(tmp, final):
            raise RuntimeError(f"another run committed manifest {self.number + 1} meanwhile; repeat run {self.run_id}")
        self.done = True

    def _rows(self, name: str, entries: list[dict], only: list[int] | None = None) -> DataFrame:
        """A bucket list is one glob, so the paths are as many as the folders."""
        root = self.store.root
        paths = []
        for e in entries:
            if e["buckets"] is None:
                paths.append(f"{root}/{e['path']}")
            else:
                take = [str(b) for b in e["buckets"] if only is None or b in only]
                paths += [f"{root}/{e['path']}/{BUCKET}={{{','.join(take)}}}"] if take else []
        schema = self.schema(name)
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*paths)

    def _write(self, name: str, df: DataFrame, aside: Column | None = None, extra: list[str] = ()) -> dict:
        if not self.run_id:
            raise ValueError("this view only reads; changes need a run id")
        if name in SCHEMAS:
            df = df.select(*SCHEMAS[name].fieldNames(), *extra)
        else:  # columns that the table has not yet seen come last
            known = self.schemas.get(name, {"type": "struct", "fields": []})
            have = {f["name"]: f["type"] for f in known["fields"]}
            fields = [f.jsonValue() for f in df.schema.fields]
            other = [f["name"] for f in fields if f["name"] in have and f["type"] != have[f["name"]]]
            if other:
                raise ValueError(f"table {name} holds columns {other} with another type")
            self.schemas[name] = {**known, "fields": known["fields"] + [{**f, "nullable": True} for f in fields if f["name"] not in have]}
        self.writes += 1
        path = f"{name}/{self.run_id}-{self.writes:03d}"
        target = f"{self.store.root}/{path}"
        n = self.store.buckets.get(name)
        if n is None:
            df.write.mode("overwrite").parquet(target)
            return {"path": path, "buckets": None, "bytes": self._bytes(target)}
        # Rebalance by bucket: one file per bucket and write, while AQE splits a
        # bucket that holds a hot symbol over several tasks.
        bucket = symbol_bucket("Symbol", n)
        df = df.withColumn(BUCKET, bucket if aside is None else F.when(aside, F.lit(ASIDE)).otherwise(bucket)).hint("rebalance", BUCKET)
        df.write.mode("overwrite").partitionBy(BUCKET).parquet(target)
        found = [int(x.split("=")[1]) for x in _names(self.spark, target) if x.startswith(f"{BUCKET}=")]
        return {"path": path, "buckets": sorted(b for b in found if b != ASIDE), "bytes": self._bytes(target)}

    def _bytes(self, path: str) -> int:
        fs, p = _fs(self.spark, path)
        return int(fs.getContentSummary(p).getLength())


def size_class(size: int, factor: int = FOLDERS_PER_MERGE) -> int:
    """0 for folders up to ``LEAST_FOLDER_BYTES``, then one class more per ``factor``."""
    n = 0
    while size > LEAST_FOLDER_BYTES * factor ** n:
        n += 1
    return n
