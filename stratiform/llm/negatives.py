"""Hard negatives by exact integer inner products: Strassen multiplication of anchor and candidate tiles, and mergeable heaps.

Anchors and candidates are dealt by hash into groups of bounded size; one job multiplies a group of anchors by one of candidates, tile
by tile. A first round within each label fills the anchors' heaps of positives; a second round over all candidates fills, for every
anchor and positive, a heap of the negatives whose scores lie in that positive's window. A job merges the heaps of its tiles and Spark
those of the jobs, so rows and heaps are shuffled, never scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratiform.llm.store import stored


JOB = ["a", "c", "vec_id", "label", "vector"]


@dataclass(frozen=True)
class NegativeRules:
    """positives, negatives: kept for each anchor, and for each of its positives. low, high: the window of a negative's score, in
    percent of the positive's. anchor_rows, candidate_rows: what one job holds of either side, on average. tile: rows of the matrices
    that are multiplied at a time. leaf: a side at which Strassen's recursion ends."""

    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95
    anchor_rows: int = 4096
    candidate_rows: int = 4096
    tile: int = 1024
    leaf: int = 32


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = 32) -> np.ndarray:
    """a @ b for int64 matrices with seven half-size products a level.

    Odd sides are padded with a zero row or column. Sums and products are those of 64-bit integers modulo 2**64, a ring, so the
    result is exact wherever the true entries fit 64 bits, even if a sum on the way did not.
    """
    (m, d), n = a.shape, b.shape[1]
    if min(m, d, n) <= leaf:
        return np.einsum("ik,kj->ij", a, b)
    if m % 2 or d % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, d % 2)))
        b = np.pad(b, ((0, d % 2), (0, n % 2)))
        return strassen(a, b, leaf)[:m, :n]
    m, d, n = m // 2, d // 2, n // 2
    a11, a12, a21, a22 = a[:m, :d], a[:m, d:], a[m:, :d], a[m:, d:]
    b11, b12, b21, b22 = b[:d, :n], b[:d, n:], b[d:, :n], b[d:, n:]
    out = np.empty((2 * m, 2 * n), np.int64)
    c11, c12, c21, c22 = out[:m, :n], out[:m, n:], out[m:, :n], out[m:, n:]
    p = strassen(a11 + a22, b11 + b22, leaf)
    c11[:] = p
    c22[:] = p
    p = strassen(a21 + a22, b11, leaf)
    c21[:] = p
    c22 -= p
    p = strassen(a11, b12 - b22, leaf)
    c12[:] = p
    c22 += p
    p = strassen(a22, b21 - b11, leaf)
    c11 += p
    c21 += p
    p = strassen(a11 + a12, b22, leaf)
    c11 -= p
    c12 += p
    c22 += strassen(a21 - a11, b11 + b12, leaf)
    c11 += strassen(a12 - a22, b21 + b22, leaf)
    return out


class Heaps:
    """The ``size`` best (score, id) of each of ``rows`` rows; higher scores first, ties by smaller id. ``merge`` takes more entries."""

    def __init__(self, rows: int, size: int) -> None:
        self.size = size
        self.row, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.full(rows, np.iinfo(np.int64).min)  # below this score an entry can't enter its row's heap

    def merge(self, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(row):
            return
        row, score, ids = np.concatenate([self.row, row]), np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        order = np.lexsort((ids, ~score, row))
        row, score, ids = row[order], score[order], ids[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        keep = place < self.size
        self.row, self.score, self.id, place = row[keep], score[keep], ids[keep], place[keep]
        full = place == self.size - 1
        self.least[self.row[full]] = self.score[full]


class Side:
    """One side of a job as arrays, in ascending order of ids: ids, labels, and integer vectors padded with zeros to the longest."""

    def __init__(self, table: pa.Table) -> None:
        table = table.sort_by("vec_id").combine_chunks()
        self.table = table
        self.ids = table.column("vec_id").to_numpy().astype(np.int64)
        self.labels = table.column("label").to_numpy().astype(np.int64)
        lists = table.column("vector")
        lengths = pc.list_value_length(lists).to_numpy().astype(np.int64)
        self.matrix = np.zeros((len(lengths), int(lengths.max(initial=0))), np.int64)
        self.matrix[np.arange(self.matrix.shape[1]) < lengths[:, None]] = pc.list_flatten(lists).to_numpy()

    def most(self) -> int:
        return max(int(self.matrix.max(initial=0)), -int(self.matrix.min(initial=0)))


def tiles(anchors: Side, candidates: Side, rules: NegativeRules) -> Iterator[tuple[slice, slice, np.ndarray]]:
    """All inner products of two sides, tile by tile. The first tile of each anchor is narrow: it fills the heaps, whose least scores
    then spare most of the rest. An error where 64 bits might not hold a score, never a wrong one."""
    width = max(anchors.matrix.shape[1], candidates.matrix.shape[1])
    if anchors.most() * candidates.most() * width >= 1 << 63:
        raise ArithmeticError("components are too large for exact 64-bit scores")
    a, b = (np.pad(x.matrix, ((0, 0), (0, width - x.matrix.shape[1]))) for x in (anchors, candidates))
    for i in range(0, len(a), rules.tile):
        j, step = 0, max(rules.tile // 8, 1)
        while j < len(b):
            rows, columns = slice(i, i + rules.tile), slice(j, j + step)
            yield rows, columns, strassen(a[rows], np.ascontiguousarray(b[columns].T), rules.leaf)
            j, step = j + step, rules.tile


def positive_heaps(anchors: Side, candidates: Side, rules: NegativeRules) -> Heaps:
    """Best rows other than the anchor itself; both sides have one label."""
    heaps = Heaps(len(anchors.ids), rules.positives)
    for rows, columns, score in tiles(anchors, candidates, rules):
        fit = (score >= heaps.least[rows, None]) & (anchors.ids[rows, None] != candidates.ids[columns])
        r, c = np.nonzero(fit)
        heaps.merge(r + rows.start, score[r, c], candidates.ids[columns][c])
    return heaps


def negative_heaps(anchors: Side, candidates: Side, rules: NegativeRules, low: np.ndarray, high: np.ndarray) -> Heaps:
    """Best rows of other labels for each anchor and positive; low and high are the bounds of scores, a column for each positive."""
    heaps = Heaps(low.size, rules.negatives)
    least = heaps.least.reshape(low.shape)
    for rows, columns, score in tiles(anchors, candidates, rules):
        other = anchors.labels[rows, None] != candidates.labels[columns]
        for k in range(low.shape[1]):
            fit = (score >= np.maximum(low[rows, k], least[rows, k])[:, None]) & (score <= high[rows, k, None]) & other
            r, c = np.nonzero(fit)
            heaps.merge((r + rows.start) * low.shape[1] + k, score[r, c], candidates.ids[columns][c])
    return heaps


def _parts(rows: Column, size: int) -> Column:
    return F.greatest(F.ceil(rows / size), F.lit(1)).cast("int")


def _dealt(id_: str, parts: Column) -> Column:
    return F.pmod(F.xxhash64(id_), parts).cast("int")


def _jobs(anchors: DataFrame, candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every anchor once for each part of the candidates of its key and the other way round; ``a_parts``, ``c_parts`` say how many."""
    all_parts = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1))
    left = anchors.withColumn("a", _dealt("vec_id", F.col("a_parts"))).withColumn("c", all_parts("c_parts"))
    right = candidates.withColumn("c", _dealt("vec_id", F.col("c_parts"))).withColumn("a", all_parts("a_parts"))
    fresh = lambda names: [F.col(n).alias(n) for n in names]  # noqa: E731  so that no column is one of both sides
    more = [c for c in ("positives",) if c in anchors.columns]
    return left.select(*fresh([*JOB, *more])), right.select(*fresh(JOB))


def _best(entries: DataFrame, key: list[str], id_: str, score: str, n: int) -> DataFrame:
    """Merge the heaps of all jobs: the n best entries of each key, numbered from 1."""
    order = Window.partitionBy(*key).orderBy(F.desc(score), F.asc(id_))
    return entries.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def rows_that_count(rows: DataFrame) -> DataFrame:
    """vec_id, label, vector, anchor of the rows that take part, one for each vec_id."""
    whole = F.forall("vector", lambda x: x.isNotNull())
    valid = rows.select("vec_id", "label", "vector", "anchor").where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & whole)
    one = valid.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row"), F.max("anchor").alias("anchor"))
    return one.select("vec_id", "row.label", "row.vector", F.coalesce("anchor", F.lit(False)).alias("anchor"))


def positives(rows: DataFrame, rules: NegativeRules) -> DataFrame:
    """anchor_id, positive_id, positive_score, rank of each anchor's best rows of its own label. Labels are cut into parts, so a label
    with a third of all rows is many jobs."""
    sizes = rows.groupBy("label").agg(F.count("*").alias("n"), F.count_if("anchor").alias("m")).where("m > 0")
    sizes = sizes.select("label", _parts(F.col("m"), rules.anchor_rows).alias("a_parts"), _parts(F.col("n"), rules.candidate_rows).alias("c_parts"))
    told = rows.join(sizes, "label")
    left, right = _jobs(told.where("anchor"), told)

    def run(a: pa.Table, c: pa.Table) -> pa.Table:
        a, c = Side(a), Side(c)
        heaps = positive_heaps(a, c, rules)
        return pa.table({"anchor_id": a.ids[heaps.row], "positive_id": heaps.id, "positive_score": heaps.score})

    key = ["label", "a", "c"]
    made = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(run, "anchor_id long, positive_id long, positive_score long")
    return _best(made, ["anchor_id"], "positive_id", "positive_score", rules.positives)


def negatives(rows: DataFrame, found: DataFrame, rules: NegativeRules) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: the best rows of other labels in each window."""
    held = found.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    anchors = rows.where("anchor").join(held.withColumnRenamed("anchor_id", "vec_id"), "vec_id")
    sizes = rows.agg(_parts(F.count_if("anchor"), rules.anchor_rows), _parts(F.count("*"), rules.candidate_rows)).first()
    parts = {"a_parts": F.lit(sizes[0]), "c_parts": F.lit(sizes[1])}
    left, right = _jobs(anchors.withColumns(parts), rows.withColumns(parts))

    def run(a: pa.Table, c: pa.Table) -> pa.Table:
        a, c = Side(a), Side(c)
        listed = a.table.column("positives").to_pylist()
        many = max(map(len, listed), default=1)
        low, high = np.full((len(listed), many), 1, np.int64), np.zeros((len(listed), many), np.int64)  # an empty window
        for r, entries in enumerate(listed):
            for k, e in enumerate(entries):
                low[r, k], high[r, k] = -(-rules.low * e["positive_score"] // 100), rules.high * e["positive_score"] // 100
        heaps = negative_heaps(a, c, rules, low, high)
        r, k = np.divmod(heaps.row, many)
        pairs = [listed[x][y] for x, y in zip(r.tolist(), k.tolist(), strict=True)]
        columns = [a.ids[r], [p["positive_id"] for p in pairs], heaps.id, [p["positive_score"] for p in pairs], heaps.score]
        return pa.table([pa.array(x, pa.int64()) for x in columns], ["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"])

    schema = "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"
    made = left.groupBy("a", "c").cogroup(right.groupBy("a", "c")).applyInArrow(run, schema)
    best = _best(made, ["anchor_id", "positive_id"], "negative_id", "negative_score", rules.negatives)
    return best.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def mine_negatives(rows: DataFrame, rules: NegativeRules = NegativeRules()) -> DataFrame:
    """Hard negatives of the rows of ``vec_id``, ``label``, integer ``vector`` and ``anchor`` that are anchors.

    Scores are integer inner products, shorter vectors padded with zeros. Of rows with one vec_id only that of the smallest label,
    then vector, counts, and it is an anchor if any of them is; rows with a null id, label, vector or component take no part. An
    anchor without positives, or a positive without negatives in its window, gives no rows. Other columns are not read. Components so
    large that a score might leave 64 bits are an error.
    """
    rows = stored(rows_that_count(rows))
    return negatives(rows, stored(positives(rows, rules)), rules)
