"""Quality classifier by importance resampling: hashed n-gram models of target and of raw text, and Gumbel top-k."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.llm.store import stored
from stratiform.llm.words import BY_KIND, mix, slices, words_of


@dataclass(frozen=True)
class ResampleRules:
    """buckets: of hashed unigrams and bigrams. examples: the bound on labelled texts the target model learns from.
    smoothing: added to each bucket's count. noise: scale of the Gumbel noise (0: plain top-k). seed: of the noise.
    keep_share: share of rows kept; None estimates it from all labels. spare: share of the rows thought bad that may stay, because a
    short good text weighs little and would go before a bad one that looks good."""

    buckets: int = 10_000
    examples: int = 20_000
    smoothing: float = 1.0
    noise: float = 0.5
    seed: int = 11
    keep_share: float | None = None
    spare: float = 0.12


@dataclass(frozen=True)
class ResampleModel:
    """Log ratio of target to raw probability for each bucket, and the share of rows to keep."""

    ratio: np.ndarray
    keep_share: float


def _features(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number and bucket of each unigram and bigram of words and runs of punctuation, A-Z lowered."""
    w = words_of(texts, lower=True, classes=BY_KIND)
    first, pair = w.windows(2)
    value = np.concatenate([mix(w.hash + np.uint64(1)), mix(pair + np.uint64(2))])
    return np.concatenate([w.row, w.row[first]]), (value % np.uint64(buckets)).astype(np.int64)


def bucket_counts(docs: DataFrame, rules: ResampleRules, text_col: str = "text", target_col: str = "target") -> DataFrame:
    """(bucket, raw, target) over all rows: a task adds up its own rows first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(rules.buckets, np.int64), np.zeros(rules.buckets, np.int64)
        for batch in slices(batches, text_col):
            row, bucket = _features(batch.column(text_col), rules.buckets)
            raw += np.bincount(bucket, minlength=rules.buckets)
            chosen = batch.column(target_col).to_numpy(zero_copy_only=False).astype(bool)
            target += np.bincount(bucket[chosen[row]], minlength=rules.buckets)
        found = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(raw[found]), pa.array(target[found])], names=["bucket", "raw", "target"])

    parts = docs.select(F.col(text_col), F.col(target_col)).mapInArrow(run, "bucket long, raw long, target long")
    return parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def fit_resampler(docs: DataFrame, labels: DataFrame, rules: ResampleRules = ResampleRules()) -> ResampleModel:
    """Target model from at most ``examples`` rows labelled good and not toxic (the first by a hash of the id), raw model from all rows.

    The model is one number a bucket, so it may pass through the driver. The kept share is that of good rows among the labelled
    ones of docs, and of the spared bad ones; without labels nothing is known and all rows are kept.
    """
    good = labels.where((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)).select("doc_id")
    examples = good.where(F.col("doc_id").isNotNull()).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rules.examples)
    marked = docs.select("doc_id", "text").join(F.broadcast(examples.withColumn("target", F.lit(True))), "doc_id", "left")
    counts = bucket_counts(marked.select("text", F.coalesce("target", F.lit(False)).alias("target")), rules).collect()
    raw, target = np.zeros(rules.buckets), np.zeros(rules.buckets)
    for bucket, r, t in counts:
        raw[bucket], target[bucket] = r, t
    share = rules.keep_share
    if share is None:
        # Of the rows that are here: an earlier stage may have rejected bad ones already.
        here = labels.where(F.col("quality").isNotNull()).join(docs.select("doc_id").where(F.col("doc_id").isNotNull()).distinct(), "doc_id", "left_semi")
        n, ok = here.agg(F.count("*"), F.coalesce(F.sum((F.col("quality") == 1).cast("long")), F.lit(0))).first()
        share = 1 - (1 - rules.spare) * (1 - ok / n) if n else 1.0
    if not target.sum():
        return ResampleModel(np.zeros(rules.buckets), 1.0)
    ratio = np.log((target + rules.smoothing) / (target + rules.smoothing).sum()) - np.log((raw + rules.smoothing) / (raw + rules.smoothing).sum())
    return ResampleModel(ratio, share)


def log_weights(docs: DataFrame, model: ResampleModel, rules: ResampleRules = ResampleRules(), text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``log_weight``, the log of the text's target over raw probability, and ``n_features`` to every row. Null and empty: 0."""
    names = list(docs.columns if keep is None else keep)
    added = T.StructType([T.StructField("log_weight", T.DoubleType()), T.StructField("n_features", T.LongType())])
    if clash := set(names) & set(added.names):
        raise ValueError(f"columns {sorted(clash)} exist; rename them first")
    held = docs.sparkSession.sparkContext.broadcast(model.ratio)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            row, bucket = _features(batch.column(text_col), rules.buckets)
            weight = np.bincount(row, held.value[bucket], minlength=batch.num_rows)
            made = [pa.array(weight, pa.float64()), pa.array(np.bincount(row, minlength=batch.num_rows), pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + made, names=[*names, *added.names])

    read = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*names, text_col])])
    return read.mapInArrow(run, T.StructType([docs.schema[c] for c in names] + list(added)))


def noisy(rules: ResampleRules, id_col: str = "doc_id") -> Column:
    """Log weight plus Gumbel noise drawn from a hash of the id, so that reruns and repeated rows draw alike."""
    unit = (F.pmod(F.xxhash64(F.lit(rules.seed), F.col(id_col)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return F.col("log_weight") - rules.noise * F.log(-F.log(unit))


def kth_largest(scores: DataFrame, column: str, k: int, bins: int = 1024) -> float:
    """The k-th largest value, exactly, from a few histograms of ``bins`` rows each. 1 <= k <= rows."""
    low, high = scores.agg(F.min(column), F.max(column)).first()
    while True:
        width = (high - low) / bins
        if not width or low + width <= low or high - width >= high:
            break
        spot = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1)).alias("b")
        found = scores.where(F.col(column).between(low, high)).groupBy(spot).agg(F.count("*").alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi")).collect()
        for r in sorted(found, key=lambda r: -r.b):
            if k <= r.n:
                low, high = r.lo, r.hi
                break
            k -= r.n
        if low == high:
            return low
    rest = [r[0] for r in scores.where(F.col(column).between(low, high)).groupBy(column).count().select(F.struct(column, "count")).collect()]
    for value, n in sorted(rest, reverse=True):
        if k <= n:
            return value
        k -= n
    return low


def gumbel_cut(docs: DataFrame, model: ResampleModel, rules: ResampleRules = ResampleRules()) -> tuple[DataFrame, float]:
    """Noisy scores of all rows (stored), and the score of the last one that is taken."""
    scores = stored(log_weights(docs, model, rules, keep=["doc_id"]).withColumn("score", noisy(rules)))
    n = scores.count()
    k = min(n, max(1, round(n * model.keep_share)))
    return scores, kth_largest(scores, "score", k) if n else 0.0


def resample_decisions(docs: DataFrame, labels: DataFrame, rules: ResampleRules = ResampleRules()) -> DataFrame:
    """doc_id, log_weight, n_features, score, kept for every row: the k rows of greatest score are kept, and all tied with the last.

    Null ids draw the noise of one id; repeated rows share their verdict; an empty table gives an empty result; without labels
    all rows stay.
    """
    scores, cut = gumbel_cut(docs, fit_resampler(docs, labels, rules), rules)
    return scores.withColumn("kept", F.col("score") >= cut)


def resample(docs: DataFrame, labels: DataFrame, rules: ResampleRules = ResampleRules()) -> DataFrame:
    """The rows of docs that are kept, with docs' columns. The last pass scores again, which moves less than joining verdicts to texts."""
    model = fit_resampler(docs, labels, rules)
    _, cut = gumbel_cut(docs, model, rules)
    names = docs.columns
    again = log_weights(docs.toDF(*[f"c_{i}" for i in range(len(names))]), model, rules, text_col=f"c_{names.index('text')}")
    kept = again.where(noisy(rules, f"c_{names.index('doc_id')}") >= cut)
    return kept.select(*[F.col(f"c_{i}").alias(c) for i, c in enumerate(names)])
