"""Embedding near-dedup by an epsilon grid order join.

Vectors of length one within a cosine of each other lie within a distance epsilon. They are sorted by the cells that a grid of that
width has on the leading principal dimensions, cut to intervals of the sequence, and intervals are joined recursively: a pair of
intervals whose bounding boxes lie further apart than epsilon holds no link and is skipped with all that it contains. Within a pair of
intervals the recursion ends at single vectors, of which those further apart than epsilon on some more leading dimensions are skipped.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratiform.llm.components import components
from stratiform.llm.store import stored


@dataclass(frozen=True)
class GridRules:
    """cosine: of a link, at least. dims: leading principal dimensions of the grid. lead: those on which single vectors are told apart.
    sample: vectors that these are fitted on (they decide what can be skipped, never what is linked). block: vectors of an interval.
    fan: intervals joined to one on each level. tile: intervals on a side that go to a task together."""

    cosine: float = 0.95
    dims: int = 6
    sample: int = 4096
    block: int = 1024
    fan: int = 8
    lead: int = 16
    tile: int = 8


#: Of an interval's vectors: ids, hashes and how many rows are equal as packed longs, the vectors as packed numbers of their own type.
PACKED = ("ids", "cls", "copies", "vectors")


def usable(vector: Column) -> Column:
    """True for vectors that are not null, empty or zero and hold only finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _units(column: pa.ListArray, rows: np.ndarray, dim: int) -> np.ndarray:
    flat = np.asarray(column.flatten(), np.float64)
    at = np.asarray(column.offsets, np.int64)[rows] - column.offsets[0].as_py()
    return _unit(flat[at[:, None] + np.arange(dim)])


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # keeps very large and very small ones in range
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _principal(vectors: DataFrame, rules: GridRules) -> dict[int, np.ndarray]:
    """By vector length, the directions of the grid, fitted on a bounded sample: the first vectors by a hash of the id."""
    sample = vectors.orderBy(F.xxhash64("id"), "id").limit(rules.sample).select("vector").collect()
    by_dim: dict[int, list] = {}
    for (v,) in sample:
        by_dim.setdefault(len(v), []).append(v)
    out = {}
    for dim, rows in by_dim.items():
        x = np.array(rows, np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        values, axes = np.linalg.eigh(np.cov(x, rowvar=False, bias=True).reshape(dim, dim))
        out[dim] = axes[:, np.argsort(values)[::-1][: max(rules.dims, rules.lead)]]
    return out


def _intervals(vectors: DataFrame, rules: GridRules, width: float, axes) -> DataFrame:
    """Stored intervals of the grid order: part, place, dim, what PACKED names as packed numbers, and the box lo_k, hi_k."""
    carried = ("id", "cls", "copies", "vector")
    dims = range(rules.dims)

    def spots(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = np.diff(np.asarray(column.offsets, np.int64))
        out = np.zeros((len(column), rules.dims))
        for dim in np.unique(size):
            rows = np.flatnonzero(size == dim)
            # Lengths that the sample lacks use their first coordinates.
            basis = axes.value.get(int(dim), np.eye(int(dim)))[:, : rules.dims]
            out[rows[:, None], np.arange(basis.shape[1])] = _units(column, rows, int(dim)) @ basis
        return size, out, np.floor(out / width).astype(np.int32)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, _, cells = spots(batch.column("vector"))
            columns = [*(batch.column(c) for c in carried), pa.array(size, pa.int32()), *(pa.array(cells[:, k]) for k in dims)]
            yield pa.RecordBatch.from_arrays(columns, names=[*carried, "dim", *(f"c{k}" for k in dims)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, count = None, 0

        def intervals(table: pa.Table, last: bool) -> tuple[list, pa.Table | None]:
            out = []
            size = table.column("dim").to_numpy()
            at = 0
            while at < len(size):
                to = at + min(rules.block, int(np.argmax(np.append(size[at:], -1) != size[at])))
                if to == len(size) and to - at < rules.block and not last:
                    break
                out.append(table.slice(at, to - at).combine_chunks())
                at = to
            return out, table.slice(at) if at < len(size) else None

        def packed(table: pa.Table, number: int) -> pa.RecordBatch:
            column = table.column("vector").combine_chunks()
            dim = int(table.column("dim")[0].as_py())
            _, spot, _ = spots(column)
            lo, hi = spot.min(axis=0), spot.max(axis=0)
            longs = [table.column(c).to_numpy().tobytes() for c in carried[:3]]
            values = [number, dim, *longs, np.asarray(column.flatten()).tobytes(), *lo.tolist(), *hi.tolist()]
            kinds = [pa.int64(), pa.int32()] + [pa.binary()] * 4 + [pa.float64()] * (2 * rules.dims)
            names = ["place", "dim", *PACKED, *(f"lo{k}" for k in dims), *(f"hi{k}" for k in dims)]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names=names)

        for batch in batches:
            table = pa.Table.from_batches([batch])
            done, rest = intervals(pa.concat_tables([rest, table]) if rest is not None else table, False)
            for x in done:
                yield packed(x, count)
                count += 1
        for x in intervals(rest, True)[0] if rest is not None else []:
            yield packed(x, count)
            count += 1

    boxes = ", ".join(f"{side}{k} double" for side in ("lo", "hi") for k in dims)
    cells = ", ".join(f"c{k} int" for k in dims)
    order = ["dim", *(f"c{k}" for k in dims), "id"]
    ordered = vectors.mapInArrow(place, f"id long, cls long, copies long, vector {vectors.schema['vector'].dataType.simpleString()}, dim int, {cells}")
    ordered = ordered.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(ordered.mapInArrow(cut, f"place long, dim int, ids binary, cls binary, copies binary, vectors binary, {boxes}").withColumn("part", F.spark_partition_id()))


def _joined(intervals: DataFrame, rules: GridRules, width: float) -> DataFrame:
    """Pairs (x, y), x <= y, of interval numbers that may hold links, by recursive joins from the whole sequence downwards."""
    dims = range(rules.dims)
    boxes = [c for k in dims for c in (f"lo{k}", f"hi{k}")]
    level = intervals.select("node", "dim", F.col("dim").alias("dim_to"), *boxes)
    levels = [level]
    while level.count() > 1:
        level = level.groupBy(F.floor(F.col("node") / rules.fan).alias("node")).agg(
            F.min("dim").alias("dim"), F.max("dim_to").alias("dim_to"), *[(F.min if c[:2] == "lo" else F.max)(c).alias(c) for c in boxes]
        )
        level = stored(level)
        levels.append(level)
    pairs = levels[-1].select(F.col("node").alias("x"), F.col("node").alias("y"))
    for level in levels[-2::-1]:
        half = level.withColumn("up", F.floor(F.col("node") / rules.fan))
        left = half.select(F.col("up").alias("x"), *[F.col(c).alias(f"x_{c}") for c in half.columns if c != "up"])
        right = half.select(F.col("up").alias("y"), *[F.col(c).alias(f"y_{c}") for c in half.columns if c != "up"])
        gap = sum((F.pow(F.greatest(F.lit(0.0), F.col(f"x_lo{k}") - F.col(f"y_hi{k}"), F.col(f"y_lo{k}") - F.col(f"x_hi{k}")), 2) for k in dims), F.lit(0.0))
        met = pairs.join(left, "x").join(right, "y").where((F.col("x_node") <= F.col("y_node")) & (F.col("x_dim") <= F.col("y_dim_to")) & (F.col("y_dim") <= F.col("x_dim_to")))
        pairs = met.where(gap <= (width + 1e-9) ** 2).select(F.col("x_node").alias("x"), F.col("y_node").alias("y"))
        pairs = stored(pairs)
    return pairs


def _linked(a: np.ndarray, b: np.ndarray, cosine: float, basis: np.ndarray) -> np.ndarray:
    """Which rows of a and b link. Those further apart than epsilon in the leading dimensions do not; what is left is compared in
    double, or where that is much, in single precision first and again in double if close to the limit."""
    x, y = (v.astype(np.float32) @ basis.astype(np.float32) for v in (a, b))
    apart = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1) - 2 * (x @ y.T)
    near = apart <= 2 - 2 * cosine + 1e-4
    if 8 * np.count_nonzero(near) < near.size:
        out = np.zeros(near.shape, bool)
        i, j = np.nonzero(near)
    else:
        rough = a.astype(np.float32) @ b.astype(np.float32).T
        out = rough >= cosine
        i, j = np.nonzero(np.abs(rough - cosine) < 1e-4)
    for at in range(0, len(i), 1 << 16):
        x, y = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
        out[x, y] = np.einsum("ij,ij->i", a[x], b[y]) >= cosine
    return out


def _groups(link: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the rows and columns of a link table without empty ones, a row of the connected group that each lies in."""
    rows, columns = link.shape
    group, other = np.arange(rows), np.zeros(columns, np.int64)
    while rows:
        other = np.where(link, group[:, None], rows).min(axis=0)
        least = np.minimum(group, np.where(link, other[None, :], rows).min(axis=1))
        if (least == group).all():
            break
        group = least
    return group, other


@dataclass(frozen=True)
class Interval:
    """Vectors of one interval: ids, hashes, how many rows are equal, units."""

    ids: np.ndarray
    cls: np.ndarray
    copies: np.ndarray
    units: np.ndarray

    @staticmethod
    def of(row: dict[str, bytes], kind: str) -> Interval:
        ids, cls, copies = (np.frombuffer(row[c], np.int64) for c in PACKED[:3])
        return Interval(ids, cls, copies, _unit(np.frombuffer(row["vectors"], kind).astype(np.float64).reshape(len(ids), -1)))


def _compare(x: Interval, y: Interval, cosine: float, basis: np.ndarray, same: bool) -> tuple[np.ndarray, ...]:
    """Of one pair of intervals: ids and hashes of vectors with a link, the rows they link with, and a member of their group."""
    ids, cls, copies = ((getattr(x, c), getattr(y, c)) for c in PACKED[:3])
    link = _linked(x.units, y.units, cosine, basis)
    if same:
        np.fill_diagonal(link, False)
    left, right = np.flatnonzero(link.any(axis=1)), np.flatnonzero(link.any(axis=0))
    link = link[np.ix_(left, right)]
    n, m = link @ copies[1][right], link.T @ copies[0][left]
    if same:
        np.fill_diagonal(link, True)
    group, other = _groups(link)
    names = ids[0][left]
    if same:
        return names, cls[0][left], n, names[group]
    return np.concatenate([names, ids[1][right]]), np.concatenate([cls[0][left], cls[1][right]]), np.concatenate([n, m]), np.concatenate([names[group], names[other]])


def near_vectors(table: DataFrame, rules: GridRules = GridRules(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id_col, n_links, component_id, kept for every row of the table.

    Equal vectors are one, with a weight, so copies cost one row; pairs of intervals report counts and a group for each vector,
    never pairs of vectors. Vectors of different lengths do not link. Null, empty, zero and non-finite vectors link with nothing;
    rows that repeat an id count as vectors of their own but share a component; a null id has no component and is not kept.
    """
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    good = rows.where(usable(F.col("vector")))
    classes = stored(good.groupBy("vector").agg(F.min("id").alias("id"), F.count("*").alias("copies")).withColumn("cls", F.xxhash64("vector")))
    named = classes.where("id is not null")
    width = float(np.sqrt(2 - 2 * rules.cosine))
    axes = table.sparkSession.sparkContext.broadcast(_principal(named.select("id", "vector"), rules))
    intervals = _intervals(named.select("id", "cls", "copies", "vector"), rules, width, axes)

    # Numbers without gaps: the rows counted before each part, one row a part.
    parts = intervals.groupBy("part").agg(F.count("*").alias("n"))
    before = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    numbered = stored(intervals.join(before, "part").withColumn("node", F.col("before") + F.col("place")).drop("before", "part", "place"))
    pairs = _joined(numbered.drop(*PACKED), rules, width)

    # A task joins up to tile intervals with up to tile others, so that an interval goes to as many tasks as there are tiles.
    tile = lambda side: F.floor(F.col(side) / rules.tile)
    told = pairs.select("x", "y", tile("x").alias("tx"), tile("y").alias("ty"))
    wanted = told.groupBy("tx", "ty", F.col("x").alias("node")).agg(F.collect_list("y").alias("to"))
    given = told.groupBy("tx", "ty", F.col("y").alias("node")).agg(F.lit(None).cast("array<long>").alias("to"))
    left, right = (
        numbered.select("node", *PACKED).join(side, "node").select(*[F.col(c).alias(c) for c in ("tx", "ty", "node", "to", *PACKED)]) for side in (wanted, given)
    )
    kind = "<f4" if named.schema["vector"].dataType.elementType.simpleString() == "float" else "<f8"

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        others = {row["node"]: Interval.of(row, kind) for row in right.to_pylist()}
        out = []
        for row in left.to_pylist():
            mine = Interval.of(row, kind)
            dim = mine.units.shape[1]
            basis = axes.value.get(dim, np.eye(dim))[:, : rules.lead]
            out += [_compare(mine, others[node], rules.cosine, basis, node == row["node"]) for node in row["to"]]
        return pa.table([np.concatenate(c) for c in zip(*out, strict=True)], ["id", "cls", "n", "to"])

    met = left.groupBy("tx", "ty").cogroup(right.groupBy("tx", "ty"))
    found = stored(met.applyInArrow(run, "id long, cls long, n long, to long"))
    counts = found.groupBy("id", "cls").agg(F.sum("n").alias("n"))
    groups = components(found.select(F.col("id").alias("a"), F.col("to").alias("b")))
    linked = classes.join(counts, ["id", "cls"], "left").join(groups.withColumnRenamed("node", "id"), "id", "left")
    linked = linked.select("vector", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    out = good.join(linked, "vector").select("id", "n_links", "component_id")
    rest = rows.where(~usable(F.col("vector"))).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    whole = out.union(rest)
    return whole.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
