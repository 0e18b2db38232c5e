"""Language-model scoring by a weighted backoff automaton.

The model is a smoothed bigram model in backoff form. A state stands for the last word, or for the start of a text. A state has an arc
for each word seen after it, with its probability, and a failure arc to the root with the weight left over; the root has an arc for
every word of the corpus and one for unknown words. Reading a text from left to right carries the state and adds up the logarithms.

States and arcs grow with the corpus, so the automaton is never in one place. Texts are scored in blocks of some MB. Each block sends
one packed list of its arcs to every range of states: the states in order, and for each its arcs, about 6 bytes an arc. A range adds up
the lists of all blocks and answers each block with the counts of its states, and with those of its arcs that other blocks have
counted too, by their place in the list. The block then counts its own texts again and reads them with the model's true counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform.llm.store import stored
from stratiform.llm.words import mix, slices, words_of


@dataclass(frozen=True)
class BackoffRules:
    """block: bytes of text in a block, though a longer text is one. range_bytes: bytes of all texts for each range of states. parts,
    part: rows whose CRC-32 of the id modulo parts is part do not train."""

    block: int = 16 << 20
    range_bytes: int = 8 << 20
    parts: int = 7
    part: int = 2


END, START = np.uint64(0x1D8AF066B5F5F7A1), np.uint64(0x5C2E0D3A9B64C117)

MOVED = "a block is not what it was: the rows changed their order between two readings of the table; store it first"


def held_out(rules: BackoffRules, id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % rules.parts == rules.part, F.lit(False))


@dataclass(frozen=True)
class Tokens:
    """Words of some texts with an end after each: hashes, text number, and where each text begins."""

    hash: np.ndarray
    row: np.ndarray
    first: np.ndarray


def tokens_of(texts: pa.Array) -> Tokens:
    w = words_of(texts)
    n = w.per_row()
    ends = np.cumsum(n)
    return Tokens(np.insert(w.hash, ends, END), np.insert(w.row, ends, np.arange(len(n))), ends - n + np.arange(len(n)))


@dataclass(frozen=True)
class Arcs:
    """Distinct arcs of some texts: the state before, the arc's hash, and how often training rows take it."""

    state: np.ndarray
    hash: np.ndarray
    n: np.ndarray

    @staticmethod
    def merged(parts: list[Arcs]) -> Arcs:
        """In the order of their hashes."""
        state, hash_, n = (np.concatenate([getattr(p, f) for p in parts]) for f in ("state", "hash", "n"))
        order = np.argsort(hash_)
        hash_ = hash_[order]
        first = np.flatnonzero(np.concatenate([[True], hash_[1:] != hash_[:-1]])) if len(hash_) else np.zeros(0, np.int64)
        return Arcs(state[order[first]], hash_[first], np.add.reduceat(n[order], first) if len(first) else n)

    def by_state(self) -> Arcs:
        """Arcs in the order of their hashes, by state and then by hash."""
        order = np.argsort(self.state, kind="stable")
        return Arcs(self.state[order], self.hash[order], self.n[order])


def _before(t: Tokens) -> np.ndarray:
    """The state in which each token is read."""
    out = np.concatenate([t.hash[:1], t.hash[:-1]])
    out[t.first] = START
    return out


def _arc_hash(state: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(state * np.uint64(0xC2B2AE3D27D4EB4F) + word)


class Counter:
    """Adds up the arcs of batches of rows."""

    def __init__(self) -> None:
        self.parts: list[Arcs] = []

    def add(self, part: pa.RecordBatch) -> None:
        t = tokens_of(part.column("text"))
        state = _before(t)
        trains = ~part.column("held_out").to_numpy(zero_copy_only=False)
        self.parts.append(Arcs.merged([Arcs(state, _arc_hash(state, t.hash), trains[t.row].astype(np.int64))]))
        if len(self.parts) > 16:
            self.parts = [Arcs.merged(self.parts)]

    def all(self) -> Arcs:
        return Arcs.merged(self.parts).by_state()


# ---- packed lists ----


def _pack(x: np.ndarray, size: int) -> bytes:
    """Whole numbers of ``size`` bytes, like bytes side by side, compressed."""
    planes = np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(data: bytes, size: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(size, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :size] = planes.T
    return out.reshape(-1).view("<u8")


LIST = "block long, range long, states binary, runs binary, arcs binary, counts binary, sum long"
ANSWER = "block long, range long, seen binary, kinds binary, places binary, totals binary, sum long, stats array<long>"


def _range_of(state: np.ndarray, bits: int) -> np.ndarray:
    return (state >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(state), np.int64)


def _ranges(arcs: Arcs, bits: int) -> Iterator[tuple[int, slice]]:
    """Ranges of states that the arcs have, and where each one's arcs lie."""
    of = _range_of(arcs.state, bits)
    cuts = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(of)]
    for at, to in zip(cuts[:-1], cuts[1:], strict=True):
        if to > at:
            yield int(of[at]), slice(at, to)


def _sum(arcs: Arcs, at: slice) -> int:
    """Tells lists apart."""
    x = mix(arcs.state[at]) ^ arcs.hash[at]
    return int((x.sum(dtype=np.uint64) + np.uint64(at.stop - at.start)).view(np.int64))


def _listed(block: int, arcs: Arcs, bits: int) -> Iterator[dict]:
    for range_, at in _ranges(arcs, bits):
        state = arcs.state[at]
        first = np.flatnonzero(np.concatenate([[True], state[1:] != state[:-1]]))
        runs = np.diff(np.append(first, len(state)))
        gaps = np.diff(state[first], prepend=np.uint64(0))
        yield {
            "block": block, "range": range_, "states": _pack(gaps, 8), "runs": _pack(runs, 4),
            "arcs": _pack(arcs.hash[at] >> np.uint64(16), 6), "counts": _pack(arcs.n[at], 8), "sum": _sum(arcs, at),
        }


def _blocks(batches: Iterator[pa.RecordBatch], rules: BackoffRules) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Slices of a task's rows with the block they are in: rows in the order they are read, until a block is full."""
    block, size = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at, done = 0, 0
        while at < batch.num_rows:
            to = max(int(np.searchsorted(sizes, done + rules.block - size, "right")), at + (size == 0))
            if to > at:
                yield block, batch.slice(at, to - at)
                size += int(sizes[to - 1]) - done
                done, at = int(sizes[to - 1]), to
            if at < batch.num_rows:
                block, size = block + 1, 0


def _block_lists(rows: DataFrame, rules: BackoffRules, bits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, current = Counter(), None

        def flush() -> Iterator[pa.RecordBatch]:
            made: list[dict] = []
            for row in _listed(current, counter.all(), bits):
                made.append(row)
                if len(made) == 64:
                    yield _batch(made, LIST)
                    made = []
            if made:
                yield _batch(made, LIST)

        for block, part in _blocks(batches, rules):
            if block != current and current is not None:
                yield from flush()
                counter = Counter()
            current = block
            for piece in slices(iter([part])):
                counter.add(piece)
        if current is not None:
            yield from flush()

    return rows.select("held_out", "text").mapInArrow(run, LIST)


_KINDS = {"long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}


def _batch(rows: list[dict], schema: str) -> pa.RecordBatch:
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema([(n, _KINDS[t]) for n, t in fields]))


def _answered(lists: pa.Table) -> pa.Table:
    """Answers of one range of states to the lists of all blocks. The first row has what the range adds to the whole: its words'
    tokens, how many words have trained, once and twice; arcs that have once and twice; and count and arcs of the start."""
    held = lists.to_pylist()
    runs = [_unpack(r["runs"], 4).astype(np.int64) for r in held]
    states = [np.cumsum(_unpack(r["states"], 8), dtype=np.uint64) for r in held]
    state = np.concatenate([np.repeat(s, n) for s, n in zip(states, runs, strict=True)])
    arc = np.concatenate([_unpack(r["arcs"], 6) for r in held])
    own = np.concatenate([_unpack(r["counts"], 8).astype(np.int64) for r in held])
    order = np.lexsort((arc, state))
    s, a = state[order], arc[order]
    new_state = np.concatenate([[True], s[1:] != s[:-1]])
    new = new_state | np.concatenate([[True], a[1:] != a[:-1]])
    first = np.flatnonzero(new)
    total = np.add.reduceat(own[order], first)
    back = np.empty(len(order), np.int64)
    back[order] = np.cumsum(new) - 1
    begin = np.flatnonzero(new_state[first])
    distinct = s[first][begin]
    seen, kinds = np.add.reduceat(total, begin), np.add.reduceat((total > 0).astype(np.int64), begin)
    words = distinct != START
    start = (int(seen[~words].sum()), int(kinds[~words].sum()))
    count = lambda x, k: int((x == k).sum())
    stats = [int(seen[words].sum()), int((seen[words] > 0).sum()), count(seen[words], 1), count(seen[words], 2), count(total, 1), count(total, 2), *start]
    out, at = [], 0
    for row, mine, n in zip(held, states, runs, strict=True):
        to = at + int(n.sum())
        totals = total[back[at:to]]
        shared = np.flatnonzero(totals != own[at:to])
        spot = np.searchsorted(distinct, mine)
        out.append({
            "block": row["block"], "range": row["range"], "seen": _pack(seen[spot], 8), "kinds": _pack(kinds[spot], 8),
            "places": _pack(np.diff(shared, prepend=0), 8), "totals": _pack(totals[shared], 8), "sum": row["sum"], "stats": None if out else stats,
        })
        at = to
    return pa.Table.from_batches([_batch(out, ANSWER)])


# ---- scores ----


@dataclass(frozen=True)
class Root:
    """Of the training tokens: their number, that of distinct ones, and the discount; how often the start and so the end trained, and
    how many arcs the start has; the discount of arcs."""

    tokens: int
    known: int
    discount: float
    ends: int
    start_kinds: int
    arc_discount: float

    @staticmethod
    def of(stats: list[int]) -> Root:
        """The end of a text counts as a word, as often as texts train."""
        tokens, known, one, two, arc_one, arc_two, ends, kinds = stats
        discount = _discount(one + (ends == 1), two + (ends == 2))
        return Root(tokens + ends, known + (ends > 0), discount, ends, kinds, _discount(arc_one, arc_two))

    def unigram(self, count: np.ndarray) -> np.ndarray:
        """Probability at the root by count; that of all unknown words together for 0."""
        if not self.tokens:
            return np.ones(len(count))
        return np.where(count > 0, (count - self.discount) / self.tokens, self.discount * self.known / self.tokens)


def _discount(one: int, two: int) -> float:
    """Absolute discount from how many counts are one and two, kept off 0 and 1."""
    return min(max(one / (one + 2 * two), 0.1), 0.9) if one + two else 0.5


@dataclass(frozen=True)
class Model:
    """The part of the automaton that a block can take: states in order with count and number of arcs, arcs by hash with count."""

    states: np.ndarray
    seen: np.ndarray
    kinds: np.ndarray
    arcs: np.ndarray
    counts: np.ndarray

    @staticmethod
    def of(own: Arcs, answers: list[dict], root: Root, bits: int) -> Model:
        told = {r["range"]: r for r in answers}
        states, seen, kinds, counts = [np.array([END])], [np.array([root.ends])], [np.array([0])], own.n.copy()
        for range_, at in _ranges(own, bits):
            row = told.get(range_)
            if row is None or row["sum"] != _sum(own, at):
                raise RuntimeError(MOVED)
            states.append(np.unique(own.state[at]))
            seen.append(_unpack(row["seen"], 8).astype(np.int64))
            kinds.append(_unpack(row["kinds"], 8).astype(np.int64))
            counts[at.start + np.cumsum(_unpack(row["places"], 8)).astype(np.int64)] = _unpack(row["totals"], 8).astype(np.int64)
        if len(told) != len(states) - 1:
            raise RuntimeError(MOVED)
        states, seen, kinds = (np.concatenate(x) for x in (states, seen, kinds))
        by_state, by_hash = np.argsort(states), np.argsort(own.hash)
        return Model(states[by_state], seen[by_state], kinds[by_state], own.hash[by_hash], counts[by_hash])

    def score(self, part: pa.RecordBatch, root: Root) -> pa.RecordBatch:
        t = tokens_of(part.column("text"))
        n = part.num_rows
        # A text's last word is a state as well, for the end is read in it; so every token is among the states.
        words, which = np.unique(t.hash, return_inverse=True)
        spot = np.searchsorted(self.states, words)[which]
        at = np.concatenate([spot[:1], spot[:-1]])
        at[t.first] = np.searchsorted(self.states, START)
        c, history, kinds = self.seen[spot], self.seen[at], self.kinds[at]
        base = np.log10((c + 1) / (root.tokens + root.known + 1))
        # The failure arc leads to the root, whose probability counts by the weight left over; an own arc adds its share.
        left = np.where(history > 0, root.arc_discount * kinds / np.maximum(history, 1), 1.0)
        taken, which = np.unique(_arc_hash(_before(t), t.hash), return_inverse=True)
        arc = self.counts[np.searchsorted(self.arcs, taken)][which]
        score = np.log10(root.unigram(c) * left + np.maximum(arc - root.arc_discount, 0) / np.maximum(history, 1))

        def total(x: np.ndarray) -> pa.Array:
            return pa.array(np.bincount(t.row, x, n), pa.float64())

        tokens, known = np.bincount(t.row, minlength=n), np.bincount(t.row[c > 0], minlength=n)
        columns = [part.column("doc_id"), part.column("held_out"), pa.array(tokens), pa.array(known), pa.array(np.full(n, root.tokens)), total(base), total(score)]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def score_texts(docs: DataFrame, rules: BackoffRules = BackoffRules(), text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of docs.

    docs must give its rows in the same order whenever it is read, as a table does; a block that is not what it was raises. Null and
    empty texts are one end token. Unknown words share one probability, as in the base score. Rows with a null id train; repeated
    rows each count. Without training tokens every probability is 1. An empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(rules).alias("held_out"), text.alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(size // rules.range_bytes, 1).bit_length()
    lists = _block_lists(rows, rules, bits)
    answers = stored(lists.groupBy("range").applyInArrow(_answered, ANSWER))
    stats = answers.where(F.col("stats").isNotNull()).agg(*[F.coalesce(F.sum(F.col("stats")[k]), F.lit(0)) for k in range(8)]).first()
    root = Root.of(list(stats))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, part in _blocks(batches, rules):
            yield part.append_column("block", pa.array(np.full(part.num_rows, block)))

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        counter = Counter()
        batches = texts.combine_chunks().to_batches()
        for part in slices(iter(batches)):
            counter.add(part)
        model = Model.of(counter.all(), answers.to_pylist(), root, bits)
        return pa.Table.from_batches([model.score(part, root) for part in slices(iter(batches))])

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    left = rows.mapInArrow(placed, "doc_id long, held_out boolean, text string, block long")
    return left.groupBy("block").cogroup(answers.drop("stats").groupBy("block")).applyInArrow(run, schema)
