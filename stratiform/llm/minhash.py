"""Near duplicates by a signature-coordinate inverted join.

Every distinct shingle set is posted under its MinHash coordinate-value pairs. Two sets whose signatures agree in enough coordinates
share a pair among the rarest of either (the prefix), so only those are merged; texts with too few pairs that occur twice are
skipped outright. Links are confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratiform.llm.components import components
from stratiform.llm.store import stored
from stratiform.llm.words import distinct_per_row, mix, slices, words_of


@dataclass(frozen=True)
class MinHashRules:
    """shingle: words of a shingle. percent: links need 100 * common >= percent * all shingles of both.
    coordinates: of a signature. matches: equal coordinates that a candidate pair needs; at a similarity of 0.8, 27 of 48 are missed
    by about 3 pairs in 100,000. block: sets that are compared as one block where a list holds many."""

    shingle: int = 5
    percent: int = 80
    coordinates: int = 48
    matches: int = 27
    block: int = 512


_SEEDS = np.random.default_rng(77).integers(1, 1 << 63, 512, dtype=np.uint64) | np.uint64(1)


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text and their bounds. A text of fewer words is one shingle; of none, empty."""
    w = words_of(texts)
    rows = len(texts)
    first, value = w.windows(size)
    row = w.row[first]
    count = w.per_row()
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        start = np.searchsorted(w.row, short)
        whole = np.array([int(np.bitwise_xor.reduce(mix(w.hash[s : s + n] + np.arange(1, n + 1, dtype=np.uint64)))) for s, n in zip(start, count[short], strict=True)], np.uint64)
        row, value = np.concatenate([row, short]), np.concatenate([value, mix(whole + count[short].astype(np.uint64))])
        order = np.argsort(row, kind="stable")
        row, value = row[order], value[order]
    return distinct_per_row(row, value, rows)


def signatures(docs: DataFrame, rules: MinHashRules, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, key1, key2, signature) for every row; key1 and key2 name the shingle set, signature has 32-bit coordinates."""
    seeds = _SEEDS[: rules.coordinates]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            value, bounds = shingle_sets(batch.column("text"), rules.shingle)
            size = np.diff(bounds)
            full = np.flatnonzero(size)
            sig = np.zeros((batch.num_rows, rules.coordinates), np.int32)
            keys = np.zeros((2, batch.num_rows), np.uint64)
            if len(full):
                at = bounds[:-1][full]
                for k, seed in enumerate(seeds):
                    sig[full, k] = (np.minimum.reduceat(value * seed, at) >> np.uint64(32)).astype(np.uint32).view(np.int32)
                keys[0, full] = np.add.reduceat(mix(value), at)
                keys[1, full] = np.bitwise_xor.reduceat(mix(value + np.uint64(7)), at)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * rules.coordinates, pa.int32()), pa.array(sig.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(size), pa.array(keys[0].view(np.int64)), pa.array(keys[1].view(np.int64)), flat], names=["id", "n_shingles", "key1", "key2", "signature"])

    read = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return read.mapInArrow(run, "id long, n_shingles long, key1 long, key2 long, signature array<int>")


def prefix_postings(sets: DataFrame, rules: MinHashRules) -> DataFrame:
    """(key, id): each set under the rarest coordinate-value pairs that two agreeing sets must share one of.

    A pair of sets that agrees in ``matches`` of its coordinates shares one of the first ``coordinates - matches + 1`` of either in
    any order common to all; the order is from rare to frequent. Pairs that occur once come first and lead nowhere, so a set with
    r pairs that occur twice or more posts the rarest r - matches + 1 of these, and none if r is smaller.
    """
    every = sets.select("id", F.posexplode("signature").alias("k", "v")).select("id", F.xxhash64("k", "v").alias("key"))
    often = every.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    found = every.join(often, "key")
    by_set = Window.partitionBy("id")
    ranked = found.withColumn("place", F.row_number().over(by_set.orderBy("n", "key"))).withColumn("r", F.count("*").over(by_set))
    return ranked.where(F.col("place") <= F.col("r") - rules.matches + 1).select("key", "id")


def confirm(pairs: DataFrame, texts: DataFrame, rules: MinHashRules) -> DataFrame:
    """The (a, b) of pairs whose full shingle sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                (x, xb), (y, yb) = (shingle_sets(part.column(c), rules.shingle) for c in ("ta", "tb"))
                for i in range(part.num_rows):
                    p, q = x[xb[i] : xb[i + 1]], y[yb[i] : yb[i + 1]]
                    common = len(np.intersect1d(p, q, assume_unique=True))
                    good[at + i] = common > 0 and 100 * common >= rules.percent * (len(p) + len(q) - common)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(good))

    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


@dataclass
class _Block:
    """Members of one block pair of a list: ids, components, sides, signatures, the keys of their lists, and full shingle sets."""

    ids: np.ndarray
    comp: np.ndarray
    side: np.ndarray
    sig: np.ndarray
    keys: np.ndarray
    sets: np.ndarray
    bounds: np.ndarray

    def links(self, key: int, rules: MinHashRules) -> list[tuple[int, int]]:
        """Links between members whose components differ, no more than join these components.

        A pair that shares several lists is compared in the one of the least key. What a link has joined is not compared again.
        """
        lead = {c: c for c in self.comp.tolist()}

        def root(c: int) -> int:
            while lead[c] != c:
                lead[c] = lead[lead[c]]
                c = lead[c]
            return c

        found = []
        now = self.comp.copy()
        right = np.flatnonzero(self.side == 1)
        for i in np.flatnonzero(self.side != 1):
            other = np.arange(i + 1, len(self.ids)) if self.side[i] == 2 else right
            other = other[now[other] != now[i]]
            other = other[(self.sig[other] == self.sig[i]).sum(axis=1) >= rules.matches] if len(other) else other
            if not len(other):
                continue
            shared = (self.keys[other][:, :, None] == self.keys[i][self.keys[i] < key]).any(axis=(1, 2))
            own = self.sets[self.bounds[i] : self.bounds[i + 1]]
            for j in other[~shared]:
                if now[j] == now[i]:
                    continue
                its = self.sets[self.bounds[j] : self.bounds[j + 1]]
                if 100 * min(len(own), len(its)) < rules.percent * max(len(own), len(its)):
                    continue
                common = int((own[np.searchsorted(own, its).clip(max=len(own) - 1)] == its).sum())
                if 100 * common >= rules.percent * (len(own) + len(its) - common):
                    found.append((int(self.ids[i]), int(self.ids[j])))
                    x, y = sorted((root(now[i]), root(now[j])))
                    lead[y] = x
                    now[(now == now[i]) | (now == now[j])] = x
        return found


def full_sets(texts: DataFrame, rules: MinHashRules) -> DataFrame:
    """(id, shingles): the full sets of stored texts, as packed sorted 64-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            value, bounds = shingle_sets(batch.column("text"), rules.shingle)
            packed = [value[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(packed, pa.binary())], names=["id", "shingles"])

    return texts.select("id", "text").mapInArrow(run, "id long, shingles binary")


def _remaining(posts: DataFrame, sets: DataFrame, texts: DataFrame, labels: DataFrame, rules: MinHashRules) -> DataFrame:
    """Links (a, b) between sets that share a list but no component yet, compared block against block of their list.

    A task holds two blocks with their full sets, and gives no more links than join the components it has met.
    """
    known = posts.join(labels, posts.id == labels.node, "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    open_lists = known.groupBy("key").agg(F.count("*").alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key", "n")
    member = stored(known.join(open_lists, "key"))
    lists = member.groupBy("id").agg(F.array_sort(F.collect_set("key")).alias("keys"))
    member = member.join(sets.join(lists, "id").join(full_sets(texts, rules), "id"), "id")
    blocks = F.ceil(F.col("n") / rules.block).cast("int")
    own = F.pmod(F.xxhash64("id"), blocks).cast("int")
    dealt = member.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.withColumn("p", F.least("own", "other")).withColumn("q", F.greatest("own", "other"))
    dealt = dealt.withColumn("side", F.when(F.col("p") == F.col("q"), 2).when(F.col("own") == F.col("p"), 0).otherwise(1))
    columns = ["key", "p", "q", "id", "component", "side", "signature", "keys", "shingles"]

    def blocks_of(now: pa.Table, last: bool) -> tuple[list[tuple[int, _Block]], pa.Table | None]:
        key, p, q, ids, comp, side = (now.column(c).to_numpy() for c in columns[:6])
        starts = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1])) + 1, [len(key)]])
        out = []
        for x, y in zip(starts[:-1] if last else starts[:-2], starts[1:], strict=False):
            if comp[x:y].min() == comp[x:y].max():
                continue
            part = now.slice(int(x), int(y - x)).combine_chunks()
            sig = np.asarray(part.column("signature").combine_chunks().flatten()).reshape(-1, rules.coordinates)
            lists = part.column("keys").to_pylist()
            keys = np.full((y - x, max(map(len, lists))), np.iinfo(np.int64).max)
            for k, own_keys in enumerate(lists):
                keys[k, : len(own_keys)] = own_keys
            raw = [np.frombuffer(v, np.uint64) for v in part.column("shingles").to_pylist()]
            out.append((int(key[x]), _Block(ids[x:y], comp[x:y], side[x:y], sig, keys, np.concatenate(raw), np.concatenate([[0], np.cumsum([len(v) for v in raw])]))))
        return out, None if last else now.slice(int(starts[-2]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by block pair; one that may go on in the next batch waits for it."""
        rest: pa.Table | None = None
        for batch in _ending(batches):
            parts = [] if batch is None else [pa.Table.from_batches([batch])]
            now = pa.concat_tables(([rest] if rest is not None else []) + parts) if rest is not None or parts else None
            if now is None or not now.num_rows:
                continue
            full, rest = blocks_of(now.combine_chunks(), batch is None)
            links = [x for key, block in full for x in block.links(key, rules)]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    sorted_blocks = dealt.select(*columns).repartition("key", "p", "q").sortWithinPartitions("key", "p", "q", "id")
    return sorted_blocks.mapInArrow(run, "a long, b long").distinct()


def _ending(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def near_duplicates(docs: DataFrame, rules: MinHashRules = MinHashRules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_shingles, component_id, kept for every row of docs.

    Equal sets are one class first, so exact copies cost one row each. Then each set is confirmed against the best of the first
    members of its lists, which joins large groups in a linear number of pairs; only lists that still hold several components have
    the rest compared, in blocks, so no link between different sets is lost. A null id is not kept, and has a component
    only where a row with an id has the same set; rows that repeat an id are one document, linked by any of their texts. Null and empty texts have no shingles and stand alone.
    """
    marks = stored(signatures(docs, rules, id_col, text_col))
    classes = stored(
        marks.where("n_shingles > 0 and id is not null").groupBy("key1", "key2").agg(F.min("id").alias("id"), F.first("signature").alias("signature"))
    )
    sets = classes.select("id", "signature")
    posts = stored(prefix_postings(sets, rules))

    lists = posts.groupBy("key").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    merged = posts.join(lists, "key").where("id <> first").groupBy("id", "first").agg(F.count("*").alias("hits"))
    best = merged.groupBy("id").agg(F.max(F.struct("hits", -F.col("first"))).alias("m")).select(F.col("id").alias("a"), (-F.col("m.col2")).alias("b"))
    star = stored(best)
    wanted = posts.join(lists, "key", "left_semi").select("id").distinct()
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(wanted, "id", "left_semi")
    texts = stored(texts.withColumn("h", F.xxhash64("text")).dropDuplicates(["id", "h"]).drop("h"))

    links = stored(confirm(star, texts, rules).distinct())
    labels = components(links)
    more = stored(_remaining(posts, sets, texts, labels, rules))
    if more.limit(1).count():
        joined = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
        labels = components(joined.union(more))
    grouped = classes.join(labels, classes.id == labels.node, "left").select("key1", "key2", F.coalesce("component", "id").alias("component_id"))
    out = marks.select("id", "n_shingles", "key1", "key2").join(grouped, ["key1", "key2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
