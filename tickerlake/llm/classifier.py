"""Operator 5, quality classifier: hierarchical empirical Bayes over a document classifier.

1. Two logistic models (poor quality, toxic) on hashed words, word beginnings and
   style measures are fitted on a bounded sample of labelled rows (``MOST_LABELLED``), one
   text per id. Features are counted by class and screened by chi-square on the
   executors; the driver gets the kept features of the sample alone, whatever its texts' length.
2. Every document is scored in Arrow batches.
3. Scores are summed per path and host by grouped aggregation. A host's rate of bad
   documents is shrunk toward the global rate, a path's toward its host's, with
   prior strengths estimated from the spread between sites (method of moments): a
   site with few documents stays near its prior.
4. A document's evidence (log-odds) is moved by how far its path's posterior lies
   from the global rate, and it is rejected when bad is the likelier.

Defined results: a null or empty text has no evidence of words and gets the model's
intercept; labels that are null, or of unknown documents, are not used, of several
labels of one id the worse counts, of several texts of one id the one with the smallest digest is learnt from;
very long texts are scored, and learnt from, whole; without labelled rows every document has the
neutral score and is kept; null hosts and paths are sites of their own; repeated
rows score alike; an empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerlake.llm import textvec as V
from tickerlake.llm.common import map_arrow, stored

#: Labelled rows that the models are fitted on, at most: those with the smallest hash of their id.
MOST_LABELLED = 12_000
HASH_BITS = 20
#: Hashed features kept after screening.
MOST_FEATURES = 6_000
LEAST_DOCS = 4
HEAD_BYTES = (4, 5)
#: Upper ends of the style measures' steps.
STEPS = np.array([0.0, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.8])
STYLES = 5


def _not_word() -> np.ndarray:
    t = np.zeros(256, bool)
    t[:128] = True
    t[[*range(48, 58), *range(97, 123)]] = False
    return t


NOT_WORD = _not_word()
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True
MARKS = [np.isin(np.arange(256), [ord(c) for c in s]) for s in ("#*$%&<>", "|", "!")]


def _per_doc(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[off[1:]] - total[off[:-1]]


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature) pairs, each once, sorted by document."""
    raw, off = V.column_bytes(column)
    docs = len(off) - 1
    data = V.LOWER[raw]
    start, end, first = V.words(data, off, NOT_WORD)
    doc = np.repeat(np.arange(docs, dtype=np.int64), np.diff(first))
    parts = []
    for n in (0, *HEAD_BYTES):
        pick = slice(None) if n == 0 else np.flatnonzero(end - start > n)
        h = V.word_hashes(data, start[pick], end[pick] if n == 0 else start[pick] + n)
        parts.append((doc[pick] << 32) | (V.mix(h, n + 1) >> np.uint64(64 - HASH_BITS)).astype(np.int64))
    words = np.maximum(np.diff(first), 1)
    measures = [_per_doc(m[raw], off) / words for m in MARKS]
    measures.append(_per_doc(UPPER[raw], off) / np.maximum(_per_doc(LETTER[raw], off), 1))
    distinct = np.unique(parts[0])
    measures.append(1 - np.bincount(distinct >> 32, minlength=docs) / words)
    for k, m in enumerate(measures):
        step = np.searchsorted(STEPS, m, "left")
        parts.append((np.arange(docs) << 32) | ((1 << HASH_BITS) + k * (len(STEPS) + 1) + step))
    pairs = np.unique(np.concatenate(parts))
    return pairs >> 32, pairs & 0xFFFFFFFF


SIZE = (1 << HASH_BITS) + STYLES * (len(STEPS) + 1)


@dataclass
class Linear:
    """Sparse weights of one logistic model."""

    feature: np.ndarray
    weight: np.ndarray
    intercept: float

    def dense(self) -> np.ndarray:
        w = np.zeros(SIZE, np.float32)
        w[self.feature] = self.weight
        return w


def screened(counts: DataFrame, n: int, bad: int, hit: str) -> np.ndarray:
    """The features (at most ``MOST_FEATURES``) that tell the classes apart most, by chi-square.

    ``counts`` has (feature, df, ``hit``): documents with the feature, and bad ones among them.
    """
    df, rate = F.col("df").cast("double"), bad / n
    expected = df * rate
    chi = (F.col(hit) - expected) * (F.col(hit) - expected) / F.greatest(expected * (1 - rate) * (1 - df / (n + 1)), F.lit(1e-9))
    rows = counts.where(F.col("df") >= LEAST_DOCS).select("feature", chi.alias("chi")).where("chi > 4")
    best = rows.orderBy(F.desc("chi"), "feature").limit(MOST_FEATURES).select("feature").collect()
    return np.sort(np.array([r["feature"] for r in best], np.int64))


def fit(doc: np.ndarray, feature: np.ndarray, y: np.ndarray, kept: np.ndarray, rounds: int = 300, l2: float = 1.0) -> Linear:
    """Logistic regression on the features ``kept``; (doc, feature) are the pairs of the sample."""
    n, bad = len(y), float(y.sum())
    if n == 0 or bad in (0.0, float(n)):
        return Linear(np.zeros(0, np.int64), np.zeros(0), -4.0 if bad == 0 else 4.0)
    back = np.full(SIZE, -1, np.int64)
    back[kept] = np.arange(len(kept))
    col = back[feature]
    row, col = doc[col >= 0], col[col >= 0]
    w, b = np.zeros(len(kept)), np.log(bad / (n - bad))
    grad_w, grad_b = np.full(len(kept), 1e-6), 1e-6
    for _ in range(rounds):  # full-batch Adagrad
        p = 1 / (1 + np.exp(-np.clip(b + np.bincount(row, w[col], n), -30, 30)))
        gw = np.bincount(col, (p - y)[row], len(kept)) + l2 * w * 0.1
        gb = float((p - y).sum())
        grad_w += gw * gw
        grad_b += gb * gb
        w -= 0.3 * gw / np.sqrt(grad_w)
        b -= 0.1 * gb / np.sqrt(grad_b)
    return Linear(kept, w, float(b))


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """(text, poor, toxic) of at most ``most`` labelled documents, one row per id.

    The sample is at most ``most`` rows of a few bytes, a bound that does not grow
    with the data, so it is broadcast to the documents. Rows of one id are reduced to the text with the smallest
    digest, by their digests first: an id that stands on a third of all rows sends one digest per task.
    """
    worst = labels.select("doc_id", "quality", "toxic").dropna().groupBy("doc_id").agg(
        F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    few = worst.orderBy(F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id").limit(most)
    few = F.broadcast(few.select(F.col("doc_id").alias("__id"), (F.col("quality") == 0).alias("poor"), (F.col("toxic") == 1).alias("toxic")))
    body = docs.select(F.col("doc_id").alias("__doc"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    body = body.join(few, F.col("__doc") == F.col("__id")).withColumn("digest", F.md5(F.col("text").cast("binary")))
    one = F.broadcast(body.groupBy("__id").agg(F.min("digest").alias("__least")).withColumnRenamed("__id", "__one"))
    body = body.join(one, (F.col("__id") == F.col("__one")) & (F.col("digest") == F.col("__least")))
    # Equal rows of one id are left: one of each, folded before they move.
    return body.dropDuplicates(["__id", "digest", "text", "poor", "toxic"]).select("text", "poor", "toxic")


def train(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> list[Linear]:
    """[poor-quality model, toxic model]; features are extracted, counted and screened on the executors.

    At most ``most`` rows of at most 2 x ``MOST_FEATURES`` features come to the driver.
    """

    def run(batches):
        for batch in batches:
            doc, feature = features(batch.column(0))
            cut = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            body = [feature[a:b].astype("<u4").tobytes() for a, b in zip(cut, cut[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(body, pa.binary()), batch.column(1), batch.column(2)], ["body", "poor", "toxic"])

    rows = stored(labelled_sample(docs, labels, most).mapInArrow(run, "body binary, poor boolean, toxic boolean"), "labelled-features")
    total = rows.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col(c).cast("long")).alias(c) for c in ("poor", "toxic")]).first()

    def counted(batches):
        """Counts per feature of a task's rows, summed before they are sent."""
        df, hits = np.zeros(SIZE, np.int32), np.zeros((2, SIZE), np.int32)
        for batch in batches:
            for body, *flags in zip(*(batch.column(i).to_pylist() for i in range(3))):
                f = np.frombuffer(body, "<u4")
                df[f] += 1
                for k, flag in enumerate(flags):
                    if flag:
                        hits[k][f] += 1
        used = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), *[pa.array(c[used].astype(np.int64)) for c in (df, *hits)]],
                                         ["feature", "df", "poor", "toxic"])

    counts = rows.mapInArrow(counted, "feature long, df long, poor long, toxic long").groupBy("feature").agg(
        *[F.sum(c).alias(c) for c in ("df", "poor", "toxic")])
    counts = stored(counts, "labelled-counts")
    kept = {c: screened(counts, total["n"], total[c], c) if total["n"] and 0 < total[c] < total["n"] else np.zeros(0, np.int64) for c in ("poor", "toxic")}
    either = np.union1d(kept["poor"], kept["toxic"]).astype("<u4")

    def reduced(batch):
        body = [np.intersect1d(np.frombuffer(x, "<u4"), either).astype("<u4").tobytes() for x in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(body, pa.binary()), batch.column(1), batch.column(2)], ["body", "poor", "toxic"])

    sample = map_arrow(rows, reduced, "body binary, poor boolean, toxic boolean").collect()
    sample.sort(key=lambda r: (bytes(r["body"]), r["poor"], r["toxic"]))  # the fit does not depend on the rows' arrival
    body = [bytes(r["body"]) for r in sample]
    doc = np.repeat(np.arange(len(body), dtype=np.int32), [len(b) // 4 for b in body])
    feature = np.frombuffer(b"".join(body), "<i4")
    return [fit(doc, feature, np.array([float(r[c]) for r in sample]), kept[c]) for c in ("poor", "toxic")]


def evidence(models: list[Linear], text: Column) -> Column:
    """Log-odds that a text is bad (poor or toxic), from its words and style alone."""
    sparse = [(m.feature.astype(np.int32), m.weight.astype(np.float32), m.intercept) for m in models]

    @F.arrow_udf(T.DoubleType())
    def score(column: pa.Array) -> pa.Array:
        dense = [(Linear(f, w, b).dense(), b) for f, w, b in sparse]
        batch = pa.RecordBatch.from_arrays([column], ["text"])
        out = []
        for piece in V.pieces_of(batch, "text", 1 << 20):
            doc, feature = features(piece.column(0))
            good = np.ones(piece.num_rows)
            for w, b in dense:
                z = b + np.bincount(doc, w[feature], piece.num_rows)
                good *= 1 / (1 + np.exp(np.clip(z, -30, 30)))
            good = np.clip(good, 1e-9, 1 - 1e-9)
            out.append(np.log((1 - good) / good))
        return pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())

    return score(text)


def _logit(p: Column) -> Column:
    q = F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
    return F.log(q / (1 - q))


def strength(sites: DataFrame, rate: Column, prior: Column) -> float:
    """Prior strength (in documents) by the method of moments: spread between sites beyond chance.

    One row comes to the driver.
    """
    r = sites.agg(
        F.sum(F.col("n") * (rate - prior) * (rate - prior)).alias("spread"), F.sum(prior * (1 - prior)).alias("chance"),
        F.sum(F.col("n") * prior * (1 - prior)).alias("whole")).first()
    if r is None or not r["whole"]:
        return 1e6
    # E[sum n (rate - prior)^2] = chance + whole / (strength + 1), about.
    beyond = max((r["spread"] - r["chance"]) / r["whole"], 1e-6)
    return float(min(max(1 / beyond - 1, 1.0), 1e6))


def posteriors(scored: DataFrame) -> DataFrame:
    """(host, path, shift): what a site's posterior adds to the log-odds of its documents."""
    p = 1 / (1 + F.exp(-F.col("evidence")))
    paths = stored(scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum(p).alias("bad")), "eb-paths")
    total = paths.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    overall = F.lit(float(total["bad"] / total["n"]) if total["n"] else 0.0)
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    k = strength(hosts, F.col("bad") / F.col("n"), overall)
    hosts = hosts.select(F.col("host").alias("__h"), ((F.col("bad") + k * overall) / (F.col("n") + k)).alias("host_rate"))
    both = paths.join(hosts, F.col("host").eqNullSafe(F.col("__h"))).drop("__h")
    k = strength(both, F.col("bad") / F.col("n"), F.col("host_rate"))
    rate = (F.col("bad") + k * F.col("host_rate")) / (F.col("n") + k)
    return both.select(F.col("host").alias("__host"), F.col("path").alias("__path"), "host_rate", rate.alias("path_rate"),
                       (_logit(rate) - _logit(overall)).alias("shift"))


def classified(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang") -> DataFrame:
    """One row per document: evidence, site rates, probability of being bad, and the verdict ``kept``."""
    models = train(docs, labels)
    scored = docs.select(F.col("doc_id"), F.col(host).alias("host"), F.col(path).alias("path"),
                         evidence(models, F.coalesce(F.col("text"), F.lit(""))).alias("evidence"))
    scored = stored(scored, "eb-scores")
    out = scored.join(posteriors(scored), F.col("host").eqNullSafe(F.col("__host")) & F.col("path").eqNullSafe(F.col("__path")))
    odds = F.col("evidence") + F.col("shift")
    return out.select("doc_id", "host", "path", "evidence", "host_rate", "path_rate",
                      (1 / (1 + F.exp(-odds))).alias("bad_probability"), (odds <= 0).alias("kept"))


def kept_documents(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang") -> DataFrame:
    """The rows of ``docs`` (all its columns) that the classifier keeps.

    Site rates need every score before the first verdict: the rows are stored with
    their evidence, so that each text is scored once.
    """
    columns = docs.columns
    models = train(docs, labels)
    scored = stored(docs.withColumn("__evidence", evidence(models, F.coalesce(F.col("text"), F.lit("")))), "eb-rows")
    sites = posteriors(scored.select(F.col(host).alias("host"), F.col(path).alias("path"), F.col("__evidence").alias("evidence")))
    sites = sites.select("__host", "__path", F.col("shift").alias("__shift"))
    out = scored.join(sites, scored[host].eqNullSafe(F.col("__host")) & scored[path].eqNullSafe(F.col("__path")))
    return out.filter(F.col("__evidence") + F.col("__shift") <= 0).select(*[scored[f"`{c}`"] for c in columns])
