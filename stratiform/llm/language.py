"""Language by compression: the language whose raw-content zstandard dictionary makes a text smallest."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.llm.store import stored

UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageRules:
    """samples, sample_chars: the bound on what is learned, a slice of so many characters from so many texts of a language.
    piece: texts are compressed in pieces of so many bytes, so that a long text meets the dictionary throughout.
    level, min_match: the compressor's; matches of four bytes catch syllables.
    margin: a text is rejected where the second-best language is less than this share larger than the best."""

    samples: int = 128
    sample_chars: int = 1000
    piece: int = 4096
    level: int = 5
    min_match: int = 4
    margin: float = 0.004
    sharpness: float = 0.25


_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[:128] = 32
_PLAIN[97:123] = np.arange(97, 123)


def plain(text: str) -> bytes:
    """Lower case; ASCII signs and digits become spaces, as they tell nothing of the language."""
    return _PLAIN[np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)].tobytes()


def learn_languages(docs: DataFrame, rules: LanguageRules = LanguageRules(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    """One dictionary a language from at most ``samples`` slices of its texts, those first by a hash of id and text.

    The sample comes in two steps, so that a language with most rows is never ranked in one task: a share of each language's
    rows by hash, about four times what is needed, then the exact first ones. Rows without text or language teach nothing.
    """
    rows = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(1 << 20)).alias("h")
    )
    # Stored, so that its size is known before the join and no text is shuffled to it: one row a language.
    counts = stored(rows.groupBy("lang").agg(F.count("*").alias("n")))
    # The slice sits in the middle of long texts: openings are often shared lines.
    middle = F.greatest(F.lit(1), ((F.length("text") - rules.sample_chars) / 2).cast("int") + 1)
    near = rows.join(counts, "lang").where(F.col("h") * F.col("n") <= F.lit(4 * rules.samples * (1 << 20)))
    near = near.select("lang", "h", "id", F.substring(F.col("text"), middle, F.lit(rules.sample_chars)).alias("part"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "id", "part"))
    chosen = near.withColumn("k", rank).where(F.col("k") <= rules.samples).orderBy("lang", "k").select("lang", "part").collect()
    parts: dict[str, list[bytes]] = {}
    for lang, part in chosen:
        parts.setdefault(lang, []).append(plain(part))
    return {lang: b" ".join(x) for lang, x in parts.items() if any(y.strip() for y in x)}


def _compressors(model: tuple[tuple[str, bytes], ...], rules: LanguageRules) -> list:
    out = []
    for _, data in model:
        made = zstandard.ZstdCompressionParameters.from_level(rules.level, min_match=rules.min_match, write_content_size=False, write_checksum=False, write_dict_id=False)
        out.append(zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=made))
    return out


def _classify(text: str | None, langs: list[str], compressors: list, rules: LanguageRules) -> tuple[str, float, bool, int, int]:
    """Language, score, rejected, and the best and second-best sizes."""
    if text is None or not any(map(str.isalpha, text)) or not langs:
        return UNKNOWN, 0.0, True, 0, 0
    data = plain(text)
    sizes = [0] * len(langs)
    for at in range(0, len(data), rules.piece):
        part = data[at : at + rules.piece]
        for k, c in enumerate(compressors):
            sizes[k] += len(c.compress(part))
    best = min(sizes)
    rest = sorted(sizes)
    second = rest[1] if len(rest) > 1 else best * 2
    score = 1.0 / float(np.exp2(-rules.sharpness * np.minimum(np.array(sizes) - best, 4000)).sum())
    return langs[sizes.index(best)], score, (second - best) < rules.margin * best, best, second


RESULT = T.StructType(
    [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType()), T.StructField("best_size", T.LongType()), T.StructField("second_size", T.LongType())]
)


def classify_languages(docs: DataFrame, model: dict[str, bytes], rules: LanguageRules = LanguageRules(), text_col: str = "text", prefix: str = "", keep: list[str] | None = None) -> DataFrame:
    """Add ``lang_pred``, ``score``, ``rejected``, ``best_size``, ``second_size`` (with ``prefix`` before their names) to every row.

    Whole texts are compressed, piece by piece. A null text or one without a letter is ``und``, score 0 and rejected. Ties go to
    the language first by name, and a tie is a narrow margin. With no learned language every row is ``und``. Other columns pass
    through unread; ``keep`` narrows them.
    """
    names = list(docs.columns if keep is None else keep)
    given = tuple(sorted(model.items()))
    langs = [x[0] for x in given]
    added = T.StructType([T.StructField(prefix + f.name, f.dataType) for f in RESULT])
    if clash := set(names) & set(added.names):
        raise ValueError(f"columns {sorted(clash)} exist; give a prefix")
    held = docs.sparkSession.sparkContext.broadcast(given)
    rows = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*names, text_col])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = _compressors(held.value, rules)
        for batch in batches:
            got = [_classify(x.as_py(), langs, compressors, rules) for x in batch.column(text_col)]
            columns = [batch.column(c) for c in names]
            for k, kind in enumerate((pa.string(), pa.float64(), pa.bool_(), pa.int64(), pa.int64())):
                columns.append(pa.array([x[k] for x in got], kind))
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *added.names])

    schema = T.StructType([docs.schema[c] for c in names] + list(added))
    return rows.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id", parts: int = 4, part: int = 2):
    """True for the rows kept from learning: CRC-32 of the id as text, modulo parts."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % parts == part, F.lit(False))


def predict_languages(docs: DataFrame, rules: LanguageRules = LanguageRules()) -> DataFrame:
    """Learn from the rows that are not held out and predict every row."""
    model = learn_languages(docs.where(~held_out()), rules)
    marked = docs.select("doc_id", held_out().alias("held_out"), "text")
    return classify_languages(marked, model, rules, keep=["doc_id", "held_out"])
