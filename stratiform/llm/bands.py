"""Quality rules by compression: zstandard ratios of whole texts and of fixed chunks, with limits by length."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.llm.store import stored
from stratiform.llm.words import BY_SPACE, slices, words_of

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


@dataclass(frozen=True)
class BandRules:
    """A ratio is compressed bytes over bytes. Bands: (shorter than so many bytes, least ratio, greatest ratio); the last holds for
    all longer texts. A text is repetitive below the least and incompressible above the greatest. Texts of two chunks or more are also
    judged by their chunks, each by the limits of its own length, widened by ``chunk_slack``: rejected where chunks outside hold more
    than ``bad_share`` of the bytes. The last chunk takes in a rest of less than half a chunk, so every byte is judged."""

    level: int = 3
    bands: tuple[tuple[int, float, float], ...] = (
        (512, 0.45, 1.20), (1024, 0.44, 0.90), (2048, 0.42, 0.82), (4096, 0.40, 0.76),
        (8192, 0.38, 0.72), (16384, 0.36, 0.70), (65536, 0.34, 0.68), (1 << 62, 0.30, 0.66),
    )
    chunk: int = 4096
    chunk_slack: float = 0.03
    bad_share: float = 0.3
    least_words: int = 50
    repeat_percent: int = 50

    def limits(self, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest ratio of texts of these sizes."""
        band = np.searchsorted([b[0] for b in self.bands], size, "right").clip(max=len(self.bands) - 1)
        return np.array([b[1] for b in self.bands])[band], np.array([b[2] for b in self.bands])[band]


@dataclass(frozen=True)
class FitRules:
    """How limits are learned from texts known to be good. steps: bands to an octave of lengths.
    near: a band learns from at least so many texts of at most half an octave shorter or longer. share: of good texts that may lie
    beyond a limit, on either side; slack is left besides. fall: of the least ratio for each octave beyond the longest learned
    band, rise: of the greatest for each octave below the shortest; long texts compress better, and short ones worse."""

    steps: int = 4
    near: int = 100
    share: float = 0.005
    slack: float = 0.004
    fall: float = 0.03
    rise: float = 0.1


ADDED = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField("ratio", T.DoubleType()), T.StructField("chunk_share", T.DoubleType()), T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())]
)

_COUNTS = ADDED.names[:5]
# What a text's verdict rests on, whatever the limits.
MEASURED = T.StructType([*ADDED.fields[:5], T.StructField("size", T.LongType()), ADDED["ratio"], T.StructField("chunk_ratios", T.ArrayType(T.DoubleType()))])


def _earlier(row: np.ndarray, value: np.ndarray) -> np.ndarray:
    """True where the same value stands earlier in the same row. Rows do not fall."""
    order = np.lexsort((value, row))
    same = np.zeros(len(row), bool)
    same[1:] = (row[order][1:] == row[order][:-1]) & (value[order][1:] == value[order][:-1])
    out = np.zeros(len(row), bool)
    out[order] = same
    return out


def _repeated(row: np.ndarray, value: np.ndarray) -> np.ndarray:
    """True where the value stands twice or more in its row."""
    order = np.lexsort((value, row))
    r, v = row[order], value[order]
    same = (r[1:] == r[:-1]) & (v[1:] == v[:-1])
    twice = np.zeros(len(row), bool)
    twice[1:] |= same
    twice[:-1] |= same
    out = np.zeros(len(row), bool)
    out[order] = twice
    return out


_LINES = np.ones(256, np.uint8)
_LINES[10] = 0


def text_counts(texts: pa.Array) -> tuple[np.ndarray, ...]:
    """Words, their code points, symbols, repeated lines and words in repeated 3-word windows, for each text."""
    rows = len(texts)
    w = words_of(texts, lower=False)
    space = BY_SPACE[w.data] == 0
    points = ((w.data & 0xC0) != 0x80) & ~space
    symbols = _SYMBOL[w.data]

    def per_text(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[w.offsets[1:]] - sums[w.offsets[:-1]]

    lines = words_of(texts, lower=False, classes=_LINES)
    inside = np.concatenate([[0], np.cumsum(~space)])
    spoken = inside[lines.end] > inside[lines.start]
    row, value = lines.row[spoken], lines.hash[spoken]
    dup = np.bincount(row[_earlier(row, value)], minlength=rows)

    first, value = w.windows(3)
    covered = np.zeros(len(w) + 3, bool)
    again = first[_repeated(w.row[first], value)]
    for k in range(3):
        covered[again + k] = True
    repeat = np.bincount(w.row[covered[: len(w)]], minlength=rows)
    return w.per_row(), per_text(points), per_text(symbols), dup, repeat


def _compressed(texts: pa.Array, rules: BandRules) -> tuple[np.ndarray, list[list[float]]]:
    """Whole-text ratio, 1 for an empty text, and the ratios of the chunks of texts of two chunks or more."""
    packer = zstandard.ZstdCompressor(level=rules.level, write_content_size=False, write_checksum=False)
    ratio, chunks = np.ones(len(texts)), [[] for _ in range(len(texts))]
    for k, text in enumerate(texts):
        data = (text.as_py() or "").encode("utf-8", "replace")
        if not data:
            continue
        ratio[k] = len(packer.compress(data)) / len(data)
        if len(data) >= 2 * rules.chunk:
            ends = np.cumsum(_chunk_sizes(len(data), rules)).tolist()
            chunks[k] = [len(packer.compress(data[a:b])) / (b - a) for a, b in zip([0, *ends], ends, strict=False)]
    return ratio, chunks


def _chunk_sizes(size: int, rules: BandRules) -> np.ndarray:
    return np.diff(np.append(np.arange(0, size - rules.chunk // 2, rules.chunk), size))


def _shares(size: np.ndarray, chunks: list[list[float]], rules: BandRules) -> np.ndarray:
    """The share of bytes in chunks outside their limits; 0 where there are no chunks."""
    share = np.zeros(len(size))
    for k, ratios in enumerate(chunks):
        if ratios:
            sizes, found = _chunk_sizes(int(size[k]), rules), np.array(ratios)
            low, high = rules.limits(sizes)
            outside = (found < low - rules.chunk_slack) | (found > high + rules.chunk_slack)
            share[k] = sizes[outside].sum() / size[k]
    return share


def _ratios(texts: pa.Array, rules: BandRules) -> tuple[np.ndarray, np.ndarray]:
    """Whole-text ratio, and the share of bytes in chunks outside their limits; 1 and 0 for an empty text."""
    ratio, chunks = _compressed(texts, rules)
    return ratio, _shares(_sizes(texts), chunks, rules)


def _sizes(texts: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(texts.cast(pa.large_binary())), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _base_failed(n: np.ndarray, repeat: np.ndarray, rules: BandRules) -> np.ndarray:
    return (n < rules.least_words) | (100 * repeat > rules.repeat_percent * n)


def _edges(fit: FitRules) -> np.ndarray:
    """Where bands begin, in octaves."""
    return np.arange(6 * fit.steps, 24 * fit.steps) / fit.steps


def _bands(low: np.ndarray, high: np.ndarray, fit: FitRules) -> tuple[tuple[int, float, float], ...]:
    """Limits of all bands from those of the learned ones, the others being NaN; () if there are none."""
    edges, known = _edges(fit), np.flatnonzero(~np.isnan(low))
    if not len(known):
        return ()
    place = np.arange(len(edges))
    shorter, longer = np.maximum(known[0] - place, 0) / fit.steps, np.maximum(place - known[-1], 0) / fit.steps
    low = np.maximum(np.interp(place, known, low[known]) - fit.fall * longer, 0)
    high = np.interp(place, known, high[known]) + fit.rise * shorter
    ends = [*(2.0 ** edges[1:]).astype(int).tolist(), 1 << 62]
    return tuple(zip(ends, low.tolist(), high.tolist(), strict=True))


def bands_from(size: np.ndarray, ratio: np.ndarray, fit: FitRules = FitRules()) -> tuple[tuple[int, float, float], ...]:
    """Limits by length from good texts at hand: in each band the trend of ratios by length, and how far the outermost good texts lie
    from it. () where no band has enough texts to learn from. ``fit_measured`` does the same over a table."""
    x = np.log2(np.maximum(size, 1))
    edges = _edges(fit)
    low, high = np.full(len(edges), np.nan), np.full(len(edges), np.nan)
    for k, edge in enumerate(edges):
        middle = edge + 0.5 / fit.steps
        near = np.abs(x - middle) <= 0.5
        if near.sum() < fit.near or np.ptp(x[near]) == 0:
            continue
        slope, start = np.polyfit(x[near], ratio[near], 1)
        rest = ratio[near] - (start + slope * x[near])
        low[k], high[k] = start + slope * middle + np.quantile(rest, [fit.share, 1 - fit.share]) + [-fit.slack, fit.slack]
    return _bands(low, high, fit)


def measure_texts(docs: DataFrame, rules: BandRules = BandRules(), text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Counts, size in bytes, and compression ratios of every whole text and its chunks, in one pass without a shuffle."""
    return _add(docs, MEASURED, text_col, keep, lambda batch: _measure(batch.column(text_col), rules))


def fit_measured(measured: DataFrame, labels: DataFrame, rules: BandRules = BandRules(), fit: FitRules = FitRules()) -> BandRules:
    """rules with bands learned from all texts of measured that labels (doc_id, quality) call good (1) and the base rule passes.

    Trends and outermost texts of bands are aggregates; one row a band comes to the driver. Distances from the trend count in steps of
    0.00001, which bounds what the exact quantiles hold. Where there are too few texts of any length, rules stay as they are.
    """
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    failed = (F.col("n_words") < rules.least_words) | (100 * F.col("n_repeat_words") > rules.repeat_percent * F.col("n_words"))
    texts = measured.where(~failed).select("doc_id", F.log2(F.col("size").cast("double")).alias("x"), "ratio").join(good, "doc_id", "left_semi")
    edges = _edges(fit)
    first, last = int(edges[0] * fit.steps), int(edges[-1] * fit.steps)
    within = lambda c: F.least(F.greatest(F.floor(c * fit.steps), F.lit(first)), F.lit(last))
    middle = (F.col("edge") + 0.5) / fit.steps
    near = texts.select("x", "ratio", F.explode(F.sequence(within(F.col("x") - 0.5) - 1, within(F.col("x") + 0.5))).alias("edge"))
    near = near.where(F.col("edge").between(first, last) & (F.abs(F.col("x") - middle) <= 0.5))
    trend = near.groupBy("edge").agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("least"), F.max("x").alias("most"), F.regr_slope("ratio", "x").alias("slope"), F.regr_intercept("ratio", "x").alias("start")
    )
    trend = trend.where((F.col("n") >= fit.near) & (F.col("least") < F.col("most"))).select("edge", "slope", "start")
    rest = F.round(F.col("ratio") - (F.col("start") + F.col("slope") * F.col("x")), 5)
    outermost = near.join(trend, "edge").groupBy("edge", "slope", "start").agg(F.percentile(rest, [fit.share, 1 - fit.share]).alias("rest"))
    low, high = np.full(len(edges), np.nan), np.full(len(edges), np.nan)
    for r in outermost.collect():
        at = r.start + r.slope * (r.edge + 0.5) / fit.steps
        low[r.edge - first], high[r.edge - first] = at + r.rest[0] - fit.slack, at + r.rest[1] + fit.slack
    learned = _bands(low, high, fit)
    return replace(rules, bands=learned) if learned else rules


def fit_bands(docs: DataFrame, labels: DataFrame, rules: BandRules = BandRules(), fit: FitRules = FitRules(), text_col: str = "text") -> BandRules:
    """rules with bands learned from all docs that labels call good; see ``fit_measured``."""
    return fit_measured(stored(measure_texts(docs, rules, text_col, ["doc_id"])), labels, rules, fit)


def judge(measured: DataFrame, rules: BandRules = BandRules()) -> DataFrame:
    """The verdict on every measured text."""
    names = [c for c in measured.columns if c not in MEASURED.names]
    return _add(measured, ADDED, None, names, lambda batch: _judge([batch.column(c) for c in MEASURED.names], rules))


def compression_bands(docs: DataFrame, rules: BandRules = BandRules(), text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add counts, ratios and the verdict to every row, in one pass without a shuffle.

    Null and empty texts have no words, ratio 1 and fail the base rule. Long texts are counted in windows and compressed in full.
    Each row is judged by itself, so repeated rows and ids get equal verdicts. Columns named like an added one raise.
    """
    return _add(docs, ADDED, text_col, keep, lambda batch: _judge(_measure(batch.column(text_col), rules), rules))


def _measure(texts: pa.Array, rules: BandRules) -> list[pa.Array]:
    ratio, chunks = _compressed(texts, rules)
    return [pa.array(x, pa.int64()) for x in (*text_counts(texts), _sizes(texts))] + [pa.array(ratio), pa.array(chunks, pa.list_(pa.float64()))]


def _judge(measured: list[pa.Array], rules: BandRules) -> list[pa.Array]:
    n, _, _, _, repeat, size, ratio = (x.to_numpy(zero_copy_only=False) for x in measured[:-1])
    share = _shares(size, measured[-1].to_pylist(), rules)
    low, high = rules.limits(size)
    failed = _base_failed(n, repeat, rules)
    kept = ~failed & (ratio >= low) & (ratio <= high) & (share <= rules.bad_share)
    return [*measured[: len(_COUNTS)], measured[-2], pa.array(share), pa.array(failed), pa.array(kept)]


def _add(df: DataFrame, added: T.StructType, text_col: str | None, keep: list[str] | None, make: Callable[[pa.RecordBatch], list[pa.Array]]) -> DataFrame:
    """The columns ``keep`` of df, all by default, and those made of each batch."""
    names = list(df.columns if keep is None else keep)
    if clash := set(names) & set(added.names):
        raise ValueError(f"columns {sorted(clash)} exist; rename them first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col) if text_col else batches:
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + make(batch), names=[*names, *added.names])

    read = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*names, text_col])]) if text_col else df
    return read.mapInArrow(run, T.StructType([df.schema[c] for c in names] + list(added)))
