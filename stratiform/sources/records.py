"""Cut files into records where a separator may also lie inside a record: delimited files whose cells hold line breaks, JSON arrays.

Spark reads the file in byte ranges, as pieces between separators (line ends; closing braces). Whether a piece begins a record depends
on all bytes before it, so each range is first summed up as a transition table: for every state it may begin in, the state it ends
in. The tables of a file's ranges, one row a range, are composed in order, which gives each range's true beginning. Then all ranges
are cut on their own; what a range holds of records that began before it or end after it is put together from the few fragments
at the borders. No range is read by a task that does not own it, and a record may span any number of ranges.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratiform.session import shared_folder

# Functions of this module travel with the job, so executors need no copy of it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Ranges whose states are broadcast (about 200 bytes each); beyond, pieces are shuffled to their range's state and sorted again.
MOST_STATES = 200_000

RANGES = "path string, block long, pieces long, bytes long, size long, base int, end0 int, end1 int, depth0 long, depth1 long"
STATES = "path string, block long, pieces long, state int, depth long, base int, last boolean, inside boolean"
CUTS = "path string, block long, piece long, record string, edge int, first boolean, base int"

WHOLE, ENDS, BEGINS, MIDDLE = range(4)  # what a row of CUTS holds of its record


#: State and depth before each piece, and after the last.
Walk = tuple[np.ndarray, np.ndarray, int, int]


def _bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column one after the other, and where each text begins and the last ends."""
    values = values.cast(pa.large_string())
    _, offsets, data = values.buffers()
    offsets = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


class CsvPieces:
    """Lines. State 1: inside a quoted cell. A quote opens a cell only at its start; a doubled one is a quote of the text; what follows
    a closing quote up to the next delimiter is taken as it is."""

    separator = "\n"
    closes = False

    def __init__(self, delimiter: str = ",") -> None:
        self.delimiter = delimiter

    def walk(self, values: pa.Array, state: int, depth: int) -> Walk:
        """Where quotes lie as the format has them, each one changes the state. Lines with others are gone through one by one."""
        data, offsets = _bytes(values)
        quote = np.flatnonzero(data == 34)
        if not len(quote):
            return np.full(len(values), state), np.full(len(values), depth), state, depth
        inside = (state + np.arange(len(quote))) & 1 == 1
        line = np.searchsorted(offsets, quote, "right") - 1
        before, after = data[np.maximum(quote - 1, 0)], data[np.minimum(quote + 1, len(data) - 1)]
        first, rest = quote == offsets[line], offsets[line + 1] - quote
        opens = first | (before == ord(self.delimiter)) | (before == 34)
        closes = (rest == 1) | (after == ord(self.delimiter)) | (after == 34) | ((after == 13) & (rest == 2))
        if np.where(inside, closes, opens).all():
            states = (state + np.searchsorted(quote, offsets)) & 1
        else:
            texts = values.to_pylist()
            states = np.full(len(values) + 1, state)
            at = 0
            for k in np.unique(line).tolist():
                states[at : k + 1] = state
                state, at = self._end(texts[k], state), k + 1
            states[at:] = state
        return states[:-1], np.full(len(values), depth), int(states[-1]), depth

    def base(self, first: str) -> int:
        return 0

    def _end(self, line: str, inside: int) -> int:
        at = 0
        while True:
            if inside:
                at = line.find('"', at)
                if at < 0:
                    return 1
                if line.startswith('"', at + 1):
                    at += 2
                    continue
                inside = 0
            elif line.startswith('"', at):
                inside, at = 1, at + 1
                continue
            at = line.find(self.delimiter, at)
            if at < 0:
                return 0
            at += 1

    def check(self, record: str) -> None:
        """A carriage return outside quotes that ends no line could end a record or be part of a cell: an error."""
        at = record.find("\r", 0, len(record) - 1)
        while at >= 0:
            if not self._end(record[:at], 0):
                raise ValueError(f"a bare carriage return outside quotes: {record[:200]!r}")
            at = record.find("\r", at + 1, len(record) - 1)

    def doubtful(self, values: pa.Array) -> bool:
        return bool(pc.any(pc.match_substring(values, "\r")).as_py())


class JsonPieces:
    """Text up to each closing brace. State 1: inside a string; depth counts open brackets and braces outside strings."""

    separator = "}"
    closes = True
    def walk(self, values: pa.Array, state: int, depth: int) -> Walk:
        data, offsets = _bytes(values)
        quote = data == 34
        slash = data == 92
        if slash.any():  # a quote after an odd number of backslashes is of the text
            edge = np.diff(np.concatenate([[0], slash.view(np.int8), [0]]))
            begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            hidden = end[((end - begin) & 1 == 1) & (end < len(data))]
            quote[hidden[~np.isin(hidden, offsets)]] = False
        turns = np.concatenate([[0], np.cumsum(quote)])
        outside = (turns[:-1] + state) & 1 == 0
        deeper = ((data == 123) | (data == 91)).astype(np.int64) - ((data == 125) | (data == 93))
        deeper = np.concatenate([[0], np.cumsum(deeper * outside)])
        states = (turns[offsets] + state) & 1
        depths = depth + deeper[offsets]
        depths[1:] -= np.cumsum(states[1:] == 0)  # the brace that ends each piece
        return states[:-1], depths[:-1], int(states[-1]), int(depths[-1])

    def base(self, first: str) -> int:
        """Depth between records: 1 in an array, 0 among plain objects."""
        return int(first.lstrip("\ufeff \t\r\n").startswith("["))

    def check(self, record: str) -> None:
        pass

    def check_end(self, text: str) -> None:
        if not re.fullmatch(r"\ufeff?\s*\[?\s*\]?\s*", text):
            raise ValueError(f"not part of any record: {text[:200]!r}")

    def doubtful(self, values: pa.Array) -> bool:
        return False


Pieces = CsvPieces | JsonPieces


def open_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Beginnings of lines (``value``) that end inside a quoted cell."""
    pieces = CsvPieces()
    for batch in batches:
        found = [line[:200] for line in batch.column("value").to_pylist() if pieces._end(line, 0)]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["value"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, dict, pa.RecordBatch]]:
    """Runs of rows of one range, with whether it begins here. Rows of a range come together and in order."""
    known = None
    for batch in batches:
        if not batch.num_rows:
            continue
        path = batch.column("path").dictionary_encode().indices.to_numpy()
        block = batch.column("block").to_numpy()
        cuts = np.flatnonzero((path[1:] != path[:-1]) | (block[1:] != block[:-1])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            part = batch.slice(a, b - a)
            key = part.column("path")[0].as_py(), part.column("block")[0].as_py()
            yield key != known, {"path": key[0], "block": key[1]}, part
            known = key


def _summed(batches: Iterator[pa.RecordBatch], pieces: Pieces) -> Iterator[pa.RecordBatch]:
    """One row of RANGES for each range."""
    held: dict | None = None
    for fresh, key, part in _blocks(batches):
        values = part.column("value")
        if fresh:
            if held:
                yield pa.RecordBatch.from_pylist([held], schema=_arrow(RANGES))
            base = pieces.base(values[0].as_py()) if key["block"] == 0 else 0
            held = key | {"pieces": 0, "bytes": 0, "size": part.column("size")[0].as_py(), "base": base, "end0": 0, "end1": 1, "depth0": 0, "depth1": 0}
        held["pieces"] += part.num_rows
        held["bytes"] += pc.sum(part.column("bytes")).as_py() + part.num_rows
        now = [(held["end0"], held["depth0"]), (held["end1"], held["depth1"])]
        after = {x: pieces.walk(values, *x)[2:] for x in set(now)}  # often one: quoted cells end, whatever came before
        (held["end0"], held["depth0"]), (held["end1"], held["depth1"]) = (after[x] for x in now)
    if held:
        yield pa.RecordBatch.from_pylist([held], schema=_arrow(RANGES))


def _arrow(schema: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    return pa.schema([(n, kinds[t]) for n, t in (x.split() for x in schema.split(", "))])


def _composed(ranges: pa.Table, closes: bool) -> pa.Table:
    """States in which the ranges of one file begin, and whether that is inside a record. A file that ends inside one is an error."""
    state, depth, size, out = 0, 0, 0, []
    rows = ranges.sort_by("block").to_pylist()
    base = rows[0]["base"]
    for k, row in enumerate(rows):
        inside = k > 0 and (state, depth) != (0, base)
        out.append({n: row[n] for n in ("path", "block", "pieces")} | {"state": state, "depth": depth, "base": base, "last": False, "inside": inside})
        state, depth = row[f"end{state}"], depth + row[f"depth{state}"]
        size += row["bytes"]
    out[-1]["last"] = True
    missing = size > rows[-1]["size"]  # the last piece has no separator after it
    if state or depth + (missing and closes):
        raise ValueError(f"{rows[0]['path']} ends inside a record")
    return pa.Table.from_pylist(out, schema=_arrow(STATES))


class Range:
    """Cuts the pieces of one range, batch by batch, into rows of CUTS."""

    def __init__(self, path: str, block: int, told: dict, pieces: Pieces) -> None:
        if told["state"] is None:
            raise self.moved(path)
        self.path, self.block, self.told, self.pieces = path, block, told, pieces
        self.state, self.depth, self.base = told["state"], told["depth"], told["base"]
        self.seen = 0
        self.fresh = block == 0  # no record of the file has been met yet
        self.open: list[str] = []  # pieces of a record that has not ended
        self.at = 0  # where it began
        self.began = block == 0 or self.between()  # whether it began in this range

    @staticmethod
    def moved(path: str) -> ValueError:
        return ValueError(f"{path} is read in other ranges than before: were files or settings changed?")

    def between(self) -> bool:
        return self.state == 0 and self.depth == self.base

    def feed(self, values: pa.Array) -> Iterator[pa.RecordBatch]:
        states, depths, self.state, self.depth = self.pieces.walk(values, self.state, self.depth)
        starts = (states == 0) & (depths == self.base)
        if self.block == 0 and not self.seen:
            starts[0] = True
        begin = np.flatnonzero(starts)
        self.open += values.slice(0, int(begin[0]) if len(begin) else len(values)).to_pylist()
        if self.open and (len(begin) or self.between()):
            yield _batch([self.row(self.open, self.at, WHOLE if self.began else ENDS)])
            self.open, self.began = [], True
        if len(begin):
            bounds = np.append(begin, len(values))
            self.began = True
            if not self.between():  # the last record goes on
                bounds = bounds[:-1]
                self.open, self.at = values.slice(int(bounds[-1])).to_pylist(), self.seen + int(bounds[-1])
            if len(bounds) > 1:
                yield self.whole(values, bounds)
        self.seen += len(values)

    def whole(self, values: pa.Array, bounds: np.ndarray) -> pa.RecordBatch:
        """Records that lie between these places of the batch."""
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values.cast(pa.string())), self.pieces.separator)
        if self.pieces.closes:
            texts = pc.binary_join_element_wise(texts, self.pieces.separator, "")
        if self.pieces.doubtful(texts):
            for text in texts.to_pylist():
                self.pieces.check(text)
        n = len(texts)
        first = np.zeros(n, bool)
        for k in range(n if self.fresh else 0):
            if texts[k].as_py().strip():
                first[k], self.fresh = True, False
                break
        columns = [[self.path] * n, np.full(n, self.block), self.seen + bounds[:-1], texts, np.full(n, WHOLE), first, np.full(n, self.base)]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _arrow(CUTS), strict=True)], schema=_arrow(CUTS))

    def row(self, parts: list[str], piece: int, edge: int) -> tuple:
        text = self.pieces.separator.join(parts)
        if edge in (WHOLE, ENDS) and self.pieces.closes:
            text += self.pieces.separator
        if edge == WHOLE:
            self.pieces.check(text)
        first = self.fresh and edge in (WHOLE, BEGINS) and bool(text.strip())
        self.fresh = self.fresh and not first
        return self.path, self.block, piece, text, edge, first, self.base

    def close(self) -> Iterator[pa.RecordBatch]:
        """What the range leaves open. After a file's last record there may only be its end."""
        if self.seen != self.told["pieces"]:
            raise self.moved(self.path)
        if not self.open:
            return
        if self.told["last"] and self.pieces.closes:
            self.pieces.check_end(self.pieces.separator.join(self.open))
            return
        yield _batch([self.row(self.open, self.at, BEGINS if self.began else MIDDLE)])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _arrow(CUTS), strict=True)], schema=_arrow(CUTS))


def _cut(batches: Iterator[pa.RecordBatch], pieces: Pieces) -> Iterator[pa.RecordBatch]:
    now = None
    for fresh, key, part in _blocks(batches):
        if fresh:
            if now:
                yield from now.close()
            told = {n: part.column(n)[0].as_py() for n in ("state", "depth", "base", "last", "pieces")}
            now = Range(key["path"], key["block"], told, pieces)
        yield from now.feed(part.column("value"))
    if now:
        yield from now.close()


def file_records(spark: SparkSession, path: str | Sequence[str], pieces: Pieces, most_states: int = MOST_STATES) -> DataFrame:
    """Records of the files as rows path, block, piece (their place: byte range, and first piece there), record, first (of its file),
    base.

    Reads the files once at the call, for the state in which each range begins; these states go to the shared folder. The ranges
    must be the same when the rows are computed, else there is an error: on a cluster whose number of cores changes, set
    ``spark.sql.files.minPartitionNum``.
    """
    read = spark.read.option("lineSep", pieces.separator).text(path)
    place = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block")]
    sized = read.select(*place, F.col("_metadata.file_size").alias("size"), F.octet_length("value").cast("long").alias("bytes"), "value")
    ranges, closes = sized.mapInArrow(lambda x: _summed(x, pieces), RANGES), pieces.closes
    folder = shared_folder(spark)
    ranges.groupBy("path").applyInArrow(lambda x: _composed(x, closes), STATES).write.parquet(folder)
    states = spark.read.schema(STATES).parquet(folder)
    many, inside = states.agg(F.count("*"), F.coalesce(F.bool_or("inside"), F.lit(False))).first()

    told = read.select(*place, F.monotonically_increasing_id().alias("n"), "value")
    if many <= most_states:  # rows keep the order in which they are read
        ready = told.join(F.broadcast(states), ["path", "block"], "left")
    else:
        ready = told.join(states, ["path", "block"], "left").repartition("path", "block").sortWithinPartitions("path", "block", "n")
    cuts = ready.drop("n", "inside").mapInArrow(lambda x: _cut(x, pieces), CUTS)
    whole = cuts.where(F.col("edge") == WHOLE).drop("edge")
    return whole.unionByName(_joined(cuts.where(F.col("edge") != WHOLE), pieces)) if inside else whole


def _joined(edges: DataFrame, pieces: Pieces) -> DataFrame:
    """Records that span ranges, from at most two fragments a range."""
    order = Window.partitionBy("path").orderBy("block", "piece")
    began = F.last(F.when(F.col("edge") == BEGINS, F.struct("block", "piece", "first", "base")), ignorenulls=True).over(order)
    parts = F.array_sort(F.collect_list(F.struct("block", "piece", "record")))
    text = F.array_join(F.transform(parts, lambda x: x["record"]), pieces.separator)
    made = edges.withColumn("began", began).groupBy("path", "began").agg(text.alias("record"))
    return made.select("path", "began.block", "began.piece", "record", "began.first", "began.base")
