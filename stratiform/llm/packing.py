"""Best-fit packing of token pieces by exact-complement hashing.

Texts become token ids and pieces; only the counts of each length, at most as many as a sequence is long, go to the driver, where
combinations that exactly fill a gap are matched and the rest is packed best-fit; then every piece finds its place by its rank.
"""

from __future__ import annotations

import os
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.llm.store import stored
from stratiform.llm.words import slices, text_buffers, words_of, worker_memory


@dataclass(frozen=True)
class PackRules:
    """length: of a sequence. tokenizer: file of a word BPE that lowers case, drops white space and ends words; None: the public
    one's place. end: id after each text. rows: pieces in a bucket of the ranking. cache: words whose ids a worker remembers."""

    length: int = 2048
    tokenizer: str | None = None
    end: int = 0
    rows: int = 50_000
    cache: int = 2_000_000


# Byte classes of parts that the tokenizer also parts: 1 letters, digits, apostrophe, other scripts; 2 punctuation; 3 control signs.
_KIND = np.full(256, 1, np.uint8)
_KIND[:32] = 3
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) != "'"]] = 2
_KIND[127] = 3
_LETTER = np.array([chr(c).isalpha() and chr(c).lower().isalpha() for c in range(2048)])
_SPECIAL = ("<|startoftext|>", "<|endoftext|>")


class WordIds:
    """Token ids of words by hash: sorted hashes, and where each word's ids lie in one flat array."""

    def __init__(self, tokenizer: str | None, limit: int) -> None:
        from tokenizers import Tokenizer

        if tokenizer is None:
            import public_tokenizers

            tokenizer = public_tokenizers.path("word_bpe_49k.json")
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.model = Tokenizer.from_file(tokenizer)
        self.mark = self.model.token_to_id(_SPECIAL[0])
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.key, self.at, self.n, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def find(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        spot = np.searchsorted(self.key, key).clip(max=max(len(self.key) - 1, 0))
        return spot, (self.key[spot] == key) if len(self.key) else np.zeros(len(key), bool)

    def learn(self, key: np.ndarray, words: list[str]) -> None:
        made = []
        for at in range(0, len(words), 256):
            # A special token parts the words, so that one call encodes many of them; words never hold its name.
            ids = np.array(self.encode([_SPECIAL[0].join(words[at : at + 256])])[0], np.uint32)
            cuts = np.flatnonzero(ids == self.mark)
            made += np.split(ids, cuts)
            made[len(made) - len(cuts) :] = [x[1:] for x in made[len(made) - len(cuts) :]]
        n = np.fromiter(map(len, made), np.int64, len(made))
        at = np.cumsum(n) - n + len(self.ids)
        self.ids = np.concatenate([self.ids, *made])
        keys = np.concatenate([self.key, key])
        order = np.argsort(keys, kind="stable")
        self.key, self.at, self.n = keys[order], np.concatenate([self.at, at])[order], np.concatenate([self.n, n])[order]


def _plain_rows(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray, texts: pa.Array) -> np.ndarray:
    """False for texts whose parts may not be the tokenizer's own: signs of other scripts that are no letters, apostrophes beside
    punctuation, control signs, and names of special tokens. Those are encoded as a whole."""
    odd = (kind == 3) | (data >= 0xE0)
    lead = np.flatnonzero((data >= 0xC2) & (data < 0xE0))
    lead = lead[lead + 1 < len(data)]
    odd[lead] |= ~_LETTER[((data[lead].astype(np.int64) & 31) << 6) | (data[lead + 1] & 63)]
    quote = np.flatnonzero(data == 39)
    odd[quote] |= kind[np.maximum(quote - 1, 0)] == 2
    odd[quote] |= kind[np.minimum(quote + 1, len(data) - 1)] == 2
    sums = np.concatenate([[0], np.cumsum(odd)])
    plain = sums[offsets[1:]] == sums[offsets[:-1]]
    bar = np.flatnonzero((data[:-1] == 60) & (data[1:] == 124)) if len(data) > 1 else np.zeros(0, np.int64)
    for row in np.unique(np.searchsorted(offsets, bar, "right") - 1):
        if any(s in (texts[int(row)].as_py() or "").lower() for s in _SPECIAL):
            plain[row] = False
    return plain


def token_ids(texts: pa.Array, words: WordIds) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts one after the other, and their bounds. Equal to encoding each text, but each distinct word is encoded once."""
    data, offsets = text_buffers(texts)
    rows = len(texts)
    plain = _plain_rows(data, offsets, _KIND[data], texts)
    w = words_of(texts, lower=True, classes=_KIND)
    use = plain[w.row]
    key, index, inverse = np.unique(w.hash[use], return_index=True, return_inverse=True)
    if len(words.key) > words.limit:
        words.clear()
    spot, known = words.find(key)
    if not known.all():
        new = np.flatnonzero(~known)
        start, end = w.start[use][index[new]], w.end[use][index[new]]
        raw = w.data.tobytes()
        words.learn(key[new], [raw[a:b].decode("utf-8", "replace") for a, b in zip(start, end, strict=True)])
        spot, _ = words.find(key)
    n = words.n[spot][inverse] if len(key) else np.zeros(0, np.int64)
    first = words.at[spot][inverse] if len(key) else np.zeros(0, np.int64)
    ends = np.cumsum(n)
    flat = words.ids[np.repeat(first - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)]
    sums = np.concatenate([[0], ends])
    bounds = sums[np.searchsorted(w.row[use], np.arange(rows + 1))]
    if plain.all():
        return flat, bounds
    odd = np.flatnonzero(~plain)
    whole = dict(zip(odd.tolist(), words.encode([texts[int(i)].as_py() for i in odd]), strict=True))
    parts = [np.array(whole[i], np.uint32) if i in whole else flat[bounds[i] : bounds[i + 1]] for i in range(rows)]
    return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


def token_pieces(docs: DataFrame, rules: PackRules = PackRules(), text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every piece, with the ids themselves on request. A null text is only the end id."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = worker_memory(f"words of {rules.tokenizer}", lambda: WordIds(rules.tokenizer, rules.cache))
        for batch in slices(batches, "text"):
            flat, bounds = token_ids(batch.column("text"), words)
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i in range(batch.num_rows):
                own = np.empty(bounds[i + 1] - bounds[i] + 1, "<u4")
                own[:-1] = flat[bounds[i] : bounds[i + 1]]
                own[-1] = rules.end
                for k, at in enumerate(range(0, len(own), rules.length)):
                    part = own[at : at + rules.length]
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    if with_ids:
                        ids.append(part)
            columns = [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            if with_ids:
                columns.append(pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def plan_sequences(counts: dict[int, int], full: int) -> list[tuple[tuple[int, ...], int]]:
    """Sequences as (lengths, how many alike) that hold each length as often as counted, none longer than ``full``.

    From long to short, the gap a piece leaves is looked up among the lengths at hand, their pair sums and triple sums; a match is
    used as often as the counts allow. What finds no match is packed best-fit, long pieces first. The work depends on the number
    of different lengths, not of pieces.
    """
    have = np.zeros(full + 1, np.int64)
    for length, n in counts.items():
        have[length] = n
    there = (have > 0).astype(np.int64)
    pairs = np.convolve(there, there)  # by sum: ordered pairs of lengths at hand

    def use(lengths: tuple[int, ...]) -> int:
        """Consume a combination as often as it is available; 0 if it is not."""
        need = Counter(lengths)
        times = min(int(have[x]) // k for x, k in need.items())
        if times:
            for x, k in need.items():
                have[x] -= times * k
                if not have[x]:
                    pairs[x : x + full + 1] -= 2 * there
                    pairs[2 * x] += 1
                    there[x] = 0
        return times

    def fillers(gap: int) -> Iterator[tuple[int, ...]]:
        if there[gap]:
            yield (gap,)
        if pairs[gap]:
            for a in range(gap - 1, (gap - 1) // 2, -1):
                if there[a] and there[gap - a]:
                    yield (a, gap - a)
        if gap > 2:
            thirds = np.flatnonzero(there[1 : gap - 1] * (pairs[gap - 1 : 1 : -1] > 0)) + 1
            for a in thirds[::-1].tolist():
                if 3 * a < gap:
                    break
                rest = gap - a
                for b in range(min(a, rest - 1), (rest - 1) // 2, -1):
                    if there[b] and there[rest - b]:
                        yield (a, b, rest - b)
                        break

    plan: list[tuple[tuple[int, ...], int]] = []
    if have[full]:
        plan.append(((full,), int(have[full])))
        use((full,))
    for length in range(full - 1, 0, -1):
        found = True
        while have[length] and found:
            found = False
            for rest in fillers(full - length):
                if times := use((length, *rest)):
                    plan.append(((length, *rest), times))
                    found = True
                    break
    # Best fit of the rest: open sequences by gap; pieces of one length go on filling the sequence they were put in.
    by_gap: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for length in range(full, 0, -1):
        n = int(have[length])
        while n:
            gap = min((g for g in by_gap if g >= length), default=full)
            held, many = by_gap[gap].pop() if gap in by_gap else ((), n)
            if gap in by_gap and not by_gap[gap]:
                del by_gap[gap]
            each = min(gap // length, n)
            times = min(many, n // each)
            n -= times * each
            by_gap.setdefault(gap - each * length, []).append(((*held, *[length] * each), times))
            if held and many > times:
                by_gap.setdefault(gap, []).append((held, many - times))
    plan += [x for group in by_gap.values() for x in group]
    return plan


def _runs(plan: list[tuple[tuple[int, ...], int]], full: int) -> dict[int, np.ndarray]:
    """By length: rows (first rank, first sequence, offset) of the runs of pieces that lie alike in sequences that follow each other."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    ranks = [0] * (full + 1)
    base = 0
    for lengths, times in plan:
        offset = 0
        for x in lengths:
            runs.setdefault(x, []).append((ranks[x], base, offset))
            ranks[x] += times
            offset += x
        base += times
    return {x: np.array(rows, np.int64) for x, rows in runs.items()}


def pack_pieces(pieces: DataFrame, rules: PackRules = PackRules()) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with doc_id, piece and length (1 to ``rules.length``). pieces: a stored table."""
    spark = pieces.sparkSession
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = spark.sparkContext.broadcast(_runs(plan_sequences(counts, rules.length), rules.length))
    buckets = max(1, -(-sum(counts.values()) // rules.rows))
    names = pieces.columns
    placed = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", *[c for c in ("ids_crc32",) if c in names]), F.lit(buckets)))
    sums = placed.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("length", "bucket", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    rank = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece")) - 1
    ranked = placed.withColumn("rank", rank).join(sums, ["length", "bucket"]).withColumn("rank", F.col("rank") + F.col("base")).select(*names, "rank")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, place = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.diff(length[order])) + 1
            for rows in np.split(order, cuts) if len(order) else []:
                table = runs.value[int(length[rows[0]])]
                at = np.searchsorted(table[:, 0], place[rows], "right") - 1
                sequence[rows] = table[at, 1] + place[rows] - table[at, 0]
                offset[rows] = table[at, 2]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    schema = T.StructType([*pieces.schema, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, rules: PackRules = PackRules(), text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids), sequence_id, offset of every piece of every row of docs.

    Null and empty texts are one piece of the end id; only texts longer than a sequence are cut. Rows that repeat an id are packed
    each for itself; which of two equal pieces lies where is the hash's choice. An empty table packs to none.
    """
    return pack_pieces(stored(token_pieces(docs, rules, text_col, with_ids)), rules)
