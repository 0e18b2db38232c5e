"""Preference formatting: the turns that a chosen and a rejected conversation share are the prompt, the rest two masked completions."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """A turn is ``before``, its role, ``between``, its text, ``after``. trained: the roles whose text and ``after`` count in the mask."""

    before: str = "<|"
    between: str = "|>\n"
    after: str = "\n"
    trained: tuple[str, ...] = ("assistant",)


def render_turns(turns: list[tuple[str, str]], template: ChatTemplate) -> tuple[str, list[tuple[int, int]]]:
    """The rendered turns and the spans, in code points, that training counts."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = template.before + role + template.between, text + template.after
        if role in template.trained:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body]
        at += len(head) + len(body)
    return "".join(parts), spans


def shared_turns(chosen: list[tuple[str, str]], rejected: list[tuple[str, str]]) -> int:
    """Length of the longest common prefix of turns, compared by role and text."""
    n = 0
    while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
        n += 1
    return n


_MASK = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def format_preferences(turns: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """(pair_id, n_shared, prompt, chosen, rejected, chosen_mask, rejected_mask) of every pair with both sides.

    turns: pair_id, side ("chosen" or "rejected"), turn, role, text, in any order; other columns are not read. Turns sort by turn
    (nulls first), then role and text; repeated rows are turns of their own. A null role or text is empty. The prompt is rendered
    once and never trained on; equal conversations leave two empty completions. A pair without one side, a null pair and other
    sides give no row. A pair's turns meet in one task, as its row holds them all; hot pairs are as large as their own output.
    """
    kept = turns.where(F.col("pair_id").isNotNull() & F.col("side").isin("chosen", "rejected"))
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    sides = [F.array_sort(F.collect_list(F.when(F.col("side") == s, turn))).alias(s) for s in ("chosen", "rejected")]
    paired = kept.groupBy("pair_id").agg(*sides).where((F.size("chosen") > 0) & (F.size("rejected") > 0))
    spans = "array<struct<start:int,end:int>>"
    schema = f"pair_id long, n_shared int, prompt string, chosen string, rejected string, chosen_mask {spans}, rejected_mask {spans}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for k in range(batch.num_rows):
                a, b = ([(t["role"], t["text"]) for t in batch.column(s)[k].as_py()] for s in ("chosen", "rejected"))
                n = shared_turns(a, b)
                (x, mx), (y, my) = render_turns(a[n:], template), render_turns(b[n:], template)
                for column, value in zip(out, (batch.column("pair_id")[k].as_py(), n, render_turns(a[:n], template)[0], x, y, mx, my), strict=True):
                    column.append(value)
            masks = [pa.array([[{"start": s, "end": e} for s, e in m] for m in out[k]], _MASK) for k in (5, 6)]
            plain = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), *(pa.array(out[k], pa.string()) for k in (2, 3, 4))]
            yield pa.RecordBatch.from_arrays([*plain, *masks], names=["pair_id", "n_shared", "prompt", "chosen", "rejected", "chosen_mask", "rejected_mask"])

    return paired.select(F.col("pair_id").cast("long").alias("pair_id"), "chosen", "rejected").mapInArrow(run, schema)
