"""Mixing sources to target weights: fixed-length blocks, multinomial draws by shard, pseudorandom index permutations.

Built-in functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratiform.llm.store import stored


@dataclass(frozen=True)
class MixRules:
    """weights: of the sources in code point order, null last, repeating. budget: words of the mix per word of the corpus.
    most: times a source may be taken. block: words of a block. shard: least slots of an output shard; shards: their greatest
    number. rows: documents in a bucket of the running sums. unfold: slots that a task unfolds. seed: of draws and permutations."""

    weights: tuple[int, ...] = (3, 1, 2)
    budget: float = 1.5
    most: int = 2
    block: int = 64
    shard: int = 4096
    shards: int = 50_000
    rows: int = 50_000
    unfold: int = 500_000
    seed: int = 5


WORD = r"[^\x20\x09-\x0D]+"

ROUNDS = 4  # of the permutation
WALK = 64  # steps back into range; more than 2 * sqrt(blocks) + 1, the most there can be, up to 992 blocks, and beyond all chance above


def source_targets(sizes: DataFrame, rules: MixRules) -> DataFrame:
    """(source, sid, source_size, target): targets by weight, none above ``most`` times its source, the excess reshared by weight.

    One row a source. Sources whose limit per weight is lowest fill up first; what is left is shared by the rest, which is where
    repeated resharing ends.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = by_source.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in rules.weights]), (F.col("sid") % len(rules.weights) + 1).cast("int"))
    limit = F.col("source_size").cast("double") * rules.most
    order = Window.orderBy(F.col("limit") / F.col("weight"), "sid")
    whole = Window.partitionBy()
    filled = ranked.withColumn("weight", weight).withColumn("limit", limit)
    before = F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    filled = filled.withColumn("level", (F.sum("source_size").over(whole) * rules.budget - before) / left).withColumn("at", F.row_number().over(order))
    is_open = F.col("limit") / F.col("weight") > F.col("level")
    level = F.min_by(F.when(is_open, F.col("level")), F.when(is_open, F.col("at"))).over(whole)
    target = F.least(F.col("limit"), F.coalesce(level * F.col("weight"), F.col("limit")))
    return filled.select("source", "sid", "source_size", target.alias("target"))


def _positions(sizes: DataFrame, rules: MixRules, rows: int) -> DataFrame:
    """sizes with ``start``, the words of its source before a document, in an order by hash bucket, id, size and hash of the text.

    Buckets are summed first, so neither a large source nor the whole table is ranked in one task; rows without an id are parted by
    their texts.
    """
    buckets = max(1, -(-rows // rules.rows))
    placed = sizes.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size", "hash"), F.lit(buckets)))
    sums = placed.groupBy("sid", "bucket").agg(F.sum("size").alias("n"))
    ahead = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("sid").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    inner = Window.partitionBy("sid", "bucket").orderBy("doc_id", "size", "hash").rowsBetween(Window.unboundedPreceding, -1)
    inside = placed.withColumn("inside", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    return inside.join(sums, (F.col("sid") == F.col("s")) & (F.col("bucket") == F.col("b"))).withColumn("start", F.col("base") + F.col("inside")).drop("s", "b", "base", "inside", "bucket")


def _permuted(index: Column, blocks: Column, sid: Column, seed: int) -> Column:
    """A pseudorandom permutation of 0..blocks-1 for each source: a Feistel network on pairs of numbers below the root of the count,
    rounded up, repeated from where it lands outside (cycle walking)."""
    side = F.ceil(F.sqrt(blocks.cast("double"))).cast("long")

    def network(x: Column) -> Column:
        start = F.struct(F.floor(x / side).alias("l"), (x % side).alias("r"))
        mixed = lambda s, k: (s["l"] + F.pmod(F.xxhash64(F.lit(seed), sid, k, s["r"]), side)) % side
        rounds = F.array(*[F.lit(k) for k in range(ROUNDS)])
        return F.aggregate(rounds, start, lambda s, k: F.struct(s["r"].alias("l"), mixed(s, k).alias("r")), lambda s: s["l"] * side + s["r"])

    first = network(index)
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), network(index), lambda x, _: F.when(x < blocks, x).otherwise(network(x)))
    return F.when(first < blocks, first).otherwise(walked)


def _block_takes(plan: DataFrame, rules: MixRules) -> DataFrame:
    """(sid, block, times): how often each block is taken; blocks never taken have no row. plan: (sid, blocks, slots) of a source.

    Each output shard draws its slots' sources independently, which gives multinomial counts; running sums over shards number the
    slots of a source. Draws beyond a source's slots are void and what it lacks is added as a last shard, so that every source gets
    its slots exactly. Slot j of a source takes the block that the source's permutation puts at j modulo its blocks.
    """
    spark = plan.sparkSession
    total = plan.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    shard = max(rules.shard, -(-total // rules.shards))
    cells = 1024
    whole = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, 0)
    shares = plan.where("slots > 0").withColumn("hi", F.sum("slots").over(whole)).withColumn("lo", F.col("hi") - F.col("slots"))
    # A draw is a slot number below the total; equal cells of it lead to the few sources that lie there.
    width = max(1, -(-total // cells))
    spread = shares.select("sid", "lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor((F.col("hi") - 1) / width))).alias("cell"))
    draws = spark.range(total).select(F.floor(F.col("id") / shard).alias("shard"), F.pmod(F.xxhash64(F.lit(rules.seed), "id"), F.lit(max(1, total))).alias("u"))
    drawn = draws.withColumn("cell", F.floor(F.col("u") / width)).join(spread, "cell").where("u >= lo and u < hi")
    counts = drawn.groupBy("sid", "shard").agg(F.count("*").alias("n"))
    lacking = plan.where("slots > 0").join(counts.groupBy("sid").agg(F.sum("n").alias("got")), "sid", "left")
    lacking = lacking.select("sid", F.lit(total).alias("shard"), (F.col("slots") - F.coalesce("got", F.lit(0))).alias("n")).where("n > 0")
    running = Window.partitionBy("sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    runs = counts.union(lacking).withColumn("to", F.sum("n").over(running)).withColumn("from", F.col("to") - F.col("n")).join(plan, "sid")
    runs = runs.withColumn("to", F.least("to", "slots")).where("from < to")
    # A run is cut to parts of at most a shard's slots, which are dealt out before they are unfolded: few rows become many here.
    parts = runs.select("sid", "blocks", "to", F.explode(F.sequence("from", F.col("to") - 1, F.lit(shard))).alias("part"))
    parts = parts.repartition(total // rules.unfold + 1, "sid", "part")
    slots = parts.select("sid", "blocks", F.explode(F.sequence("part", F.least(F.col("part") + shard, F.col("to")) - 1)).alias("j"))
    taken = slots.select("sid", _permuted(F.col("j") % F.col("blocks"), F.col("blocks"), F.col("sid"), rules.seed).alias("block"))
    return taken.groupBy("sid", "block").agg(F.count("*").alias("times"))


def mix_sources(docs: DataFrame, rules: MixRules = MixRules(), text_col: str = "text") -> DataFrame:
    """doc_id, source, size, source_size, target, taken for every row of docs.

    Null and empty texts have size 0 and nothing is taken of them; a null source is a source of its own, last in order; null and
    repeated ids are counted like others (equal rows lie in one bucket of the running sums). A long text spans many blocks.
    An empty table gives an empty result. A block's words count as often as its slot was drawn, at most ``most`` times.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    sizes = stored(docs.select("doc_id", "source", size.alias("size"), F.xxhash64(text_col).alias("hash")))
    targets = stored(source_targets(sizes, rules))
    named = sizes.alias("d").join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source"))).select("doc_id", "d.source", "size", "hash", "sid", "source_size", "target")
    rows = stored(_positions(named.where("size > 0"), rules, sizes.count()))

    blocks = F.ceil(F.col("source_size") / rules.block)
    plan = targets.where("source_size > 0").select("sid", blocks.alias("blocks"), F.least(F.round(F.col("target") * blocks / F.col("source_size")).cast("long"), blocks * rules.most).alias("slots"))
    takes = _block_takes(stored(plan), rules)

    spans = rows.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / rules.block), F.floor((F.col("start") + F.col("size") - 1) / rules.block))))
    words = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * rules.block) - F.greatest(F.col("start"), F.col("block") * rules.block)
    met = spans.withColumn("words", words).join(takes, ["sid", "block"], "left")
    key = ["doc_id", "source", "size", "source_size", "target", "start"]
    summed = met.groupBy(*key).agg(F.sum(F.col("words") * F.coalesce("times", F.lit(0))).alias("taken")).drop("start")
    empty = named.where("size = 0").select("doc_id", "source", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"))
    return summed.unionByName(empty)


def _whole_copies(takes: DataFrame, rules: MixRules) -> DataFrame:
    """(doc_id, _copies): whole copies of each document, without bias and near each source's taken words. takes: of ``mix_sources``.

    Documents of a bucket of a source are sorted by size and their takes per word summed up from a hash of the bucket; a document gets
    as many copies as whole numbers are passed, which is floor(taken / size + u) with u in [0, 1). So each document's chance is exact,
    and a bucket's words miss what was taken by its longest document at most. Rows that share an id share the mean of their takes and
    count with their first source; rows without words stay.
    """
    by_id = takes.groupBy("doc_id").agg(F.min("source").alias("source"), F.sum("size").alias("size"), F.sum("taken").alias("taken"))
    by_id = stored(by_id)
    buckets = max(1, -(-by_id.count() // rules.rows))
    placed = by_id.where("size > 0").withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)))
    # Whole numbers of 2^-32 copies, so that sums are exact.
    unit = 1 << 32
    part = F.round(F.col("taken") / F.col("size") * unit).cast("long")
    draw = F.pmod(F.xxhash64(F.lit(rules.seed + 2), "source", "bucket"), F.lit(unit))
    order = Window.partitionBy("source", "bucket").orderBy("size", F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    summed = placed.withColumn("part", part).withColumn("upto", F.sum("part").over(order) + draw)
    copies = F.shiftright("upto", 32) - F.shiftright(F.col("upto") - F.col("part"), 32)
    some = summed.select("doc_id", F.least(copies, F.lit(rules.most)).cast("int").alias("_copies"))
    return some.unionByName(by_id.where("size = 0").select("doc_id", F.lit(1).alias("_copies"))).where("_copies > 0")


def mixed_documents(docs: DataFrame, rules: MixRules = MixRules()) -> DataFrame:
    """docs as the mix takes them: each row as often as its taken words make whole copies, rounded without bias, columns unchanged."""
    names = docs.columns
    copies = _whole_copies(mix_sources(docs.select("doc_id", "source", "text"), rules), rules)
    held = docs.toDF(*[f"c{k}" for k in range(len(names))])  # names of our own, so that none of the caller's clash
    joined = held.join(copies, F.col(f"c{names.index('doc_id')}").eqNullSafe(F.col("doc_id")))
    taken = joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies")))
    return taken.select(*[F.col(f"c{k}").alias(name) for k, name in enumerate(names)])
