"""Token ids of texts in binary files: every id takes the fewest bits that hold the vocabulary's largest.

A file holds one run of documents in ascending order of their ids:

    header   magic, format version, bits an id, ids a block                     (8 bytes, then 3 unsigned 32-bit numbers)
    blocks   the ids one after the other, ``block`` of them in each but the last; a block starts at a byte
    index    where each block starts and where the last ends (unsigned 64-bit), doc_ids (signed 64-bit), which of them are null
             (1 byte each), and for each document how many ids end with it (unsigned 64-bit)
    trailer  number of documents, blocks and ids, where the index starts (unsigned 64-bit), magic

All numbers are little-endian. Any span of ids is found by its block's offset and unpacked by numpy alone, see ``PackedFile``.
Files lie in the shared folder; tasks write each under a name of its own and report it, and only reported files count, so a task
that is run again leaves no double.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratiform.llm.store import stored
from stratiform.llm.words import BY_SPACE, WINDOW, mix, words_of, worker_memory
from stratiform.session import shared_folder

MAGIC = b"\x89idbits\n"
HEAD, TAIL = "<8sIII", "<QQQQ8s"


@dataclass(frozen=True)
class BitRules:
    """tokenizer: file of a byte-level BPE, None for the public one's place. end: id after each text. block: ids in a block, a
    multiple of 8. file_ids: ids after which a file is closed. part_ids: ids that one task reads back at a time. cache: segments whose
    ids a worker remembers."""

    tokenizer: str | None = None
    end: int = 0
    block: int = 4096
    file_ids: int = 1 << 26
    part_ids: int = 1 << 23
    cache: int = 1_000_000


def bits_for(vocabulary: int) -> int:
    """Bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """ids in ``width`` bits each, lowest bit first; 8 ids fill ``width`` bytes, so each of the 8 lanes is one vector operation."""
    rows = -(-len(ids) // 8)
    lanes = np.zeros((rows, 8), np.uint64)
    lanes.reshape(-1)[: len(ids)] = ids
    if len(ids) and int(lanes.max()) >> width:
        raise ValueError(f"an id does not fit {width} bits")
    out = np.zeros((rows, width + 8), np.uint8)
    for lane in range(8):
        byte, shift = divmod(lane * width, 8)
        value = lanes[:, lane] << np.uint64(shift)
        for k in range((shift + width + 7) // 8):
            out[:, byte + k] |= ((value >> np.uint64(8 * k)) & np.uint64(255)).astype(np.uint8)
    return out[:, :width].tobytes()[: (len(ids) * width + 7) // 8]


def unpack(data: bytes, n: int, width: int) -> np.ndarray:
    """The first ``n`` ids of a packed run."""
    rows = -(-n // 8)
    flat = np.zeros(rows * width, np.uint8)
    given = np.frombuffer(data, np.uint8)[: rows * width]
    flat[: len(given)] = given
    flat = flat.reshape(rows, width)
    out = np.empty((rows, 8), np.uint32)
    for lane in range(8):
        byte, shift = divmod(lane * width, 8)
        value = np.zeros(rows, np.uint64)
        for k in range((shift + width + 7) // 8):
            value |= flat[:, byte + k].astype(np.uint64) << np.uint64(8 * k)
        out[:, lane] = (value >> np.uint64(shift)) & np.uint64((1 << width) - 1)
    return out.reshape(-1)[:n]


def file_system(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a path or URI and the path there; ``file:/x`` is taken as ``file:///x``."""
    import pyarrow.fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(path)


class PackedWriter:
    """Writes one file front to back; memory holds a block of ids and the index of documents."""

    def __init__(self, path: str, width: int, block: int) -> None:
        if block % 8 or block < 8 or not 1 <= width <= 32:
            raise ValueError("blocks hold a multiple of 8 ids of 1 to 32 bits")
        system, place = file_system(path)
        system.create_dir(place.rsplit("/", 1)[0], recursive=True)
        self.out, self.width, self.block = system.open_output_stream(place), width, block
        self.out.write(struct.pack(HEAD, MAGIC, 1, width, block))
        self.at, self.ids, self.docs, self.null, self.ends = struct.calcsize(HEAD), 0, [], [], []
        self.rest: list[np.ndarray] = []
        self.waiting = 0

    def add(self, ids: np.ndarray) -> None:
        """Some more ids of the present document."""
        self.rest.append(ids)
        self.waiting += len(ids)
        if self.waiting >= 64 * self.block:
            self._put(self.waiting // self.block * self.block)

    def end(self, doc_id: int | None) -> None:
        """The present document is whole."""
        self.docs.append(doc_id or 0)
        self.null.append(doc_id is None)
        self.ends.append(self.ids + self.waiting)

    def _put(self, n: int) -> None:
        ids = np.concatenate(self.rest) if self.rest else np.zeros(0, np.uint32)
        data = pack(ids[:n], self.width)
        self.out.write(data)
        self.at += len(data)
        self.ids += n
        self.rest = [ids[n:]]
        self.waiting = len(ids) - n

    def close(self) -> None:
        self._put(self.waiting)
        blocks = -(-self.ids // self.block)
        offsets = struct.calcsize(HEAD) + np.arange(blocks + 1, dtype="<u8") * np.uint64(self.block * self.width // 8)
        offsets[-1] = self.at
        for part in (offsets, np.array(self.docs, "<i8"), np.array(self.null, "u1"), np.array(self.ends, "<u8")):
            self.out.write(part.tobytes())
        self.out.write(struct.pack(TAIL, len(self.docs), blocks, self.ids, self.at, MAGIC))
        self.out.close()


class PackedFile:
    """Random access to a written file: ``doc_ids``, ``ends``, and ``ids`` of any span."""

    def __init__(self, path: str) -> None:
        system, place = file_system(path)
        self.data = system.open_input_file(place)
        self.data.seek(0)
        head, version, self.width, self.block = struct.unpack(HEAD, self.data.read(struct.calcsize(HEAD)))
        self.data.seek(self.data.size() - struct.calcsize(TAIL))
        docs, blocks, self.n_ids, index, tail = struct.unpack(TAIL, self.data.read(struct.calcsize(TAIL)))
        if head != MAGIC or tail != MAGIC or version != 1:
            raise ValueError(f"{path} is no file of packed ids, or not a whole one")
        self.data.seek(index)
        self.offsets = self._numbers("<u8", blocks + 1)
        self.doc_ids = self._numbers("<i8", docs)
        self.null = self._numbers("u1", docs).astype(bool)
        self.ends = self._numbers("<u8", docs).astype(np.int64)

    def _numbers(self, kind: str, n: int) -> np.ndarray:
        return np.frombuffer(self.data.read(n * np.dtype(kind).itemsize), kind)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the file; only their blocks are read."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (stop - 1) // self.block
        self.data.seek(int(self.offsets[first]))
        read = self.data.read(int(self.offsets[last + 1] - self.offsets[first]))
        at = first * self.block
        return unpack(read, stop - at, self.width)[start - at :]

    def document(self, k: int) -> np.ndarray:
        """Ids of the k-th document of the file."""
        return self.ids(int(self.ends[k - 1]) if k else 0, int(self.ends[k]))

    def close(self) -> None:
        self.data.close()


def pieces(text: str, size: int = WINDOW) -> Iterator[str]:
    """A text in pieces of about ``size`` characters whose ids, one after the other, are those of the text: cuts lie before a space
    between two ASCII letters, where a byte-level BPE always parts words. A text without such a place stays whole."""
    at = 0
    while len(text) - at > size:
        cut = at + size
        while True:
            cut = text.find(" ", cut)
            if cut < 0 or cut + 1 >= len(text):
                cut = len(text)
                break
            before, after = text[cut - 1], text[cut + 1]
            if before.isascii() and before.isalpha() and after.isascii() and after.isalpha():
                break
            cut += 1
        yield text[at:cut]
        at = cut
    yield text[at:]


class SegmentIds:
    """Ids of texts by their segments: white space and the word after it, which a byte-level BPE never joins with what is beside them.
    Each distinct segment is encoded once by a worker and then found by its hash; after ``limit`` of them it starts anew."""

    def __init__(self, path: str | None, limit: int) -> None:
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("byte_bpe_50k.json")
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.model, self.limit = Tokenizer.from_file(path), limit
        marks = [(k, t.content) for k, t in self.model.get_added_tokens_decoder().items() if t.special and not (t.lstrip or t.rstrip or t.single_word)]
        self.mark = marks[0] if marks else None  # parts segments, so that one call encodes many
        self.clear()

    def clear(self) -> None:
        # Segments by key, most of them in the first table; new ones go to the second, which is merged into the first once it is large.
        none = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.tables, self.ids = [none, none], np.zeros(0, np.uint32)

    def __len__(self) -> int:
        return sum(len(key) for key, _, _ in self.tables)

    def plain(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, np.uint32) for x in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, key: np.ndarray, texts: list[str]) -> None:
        made: list[np.ndarray] = []
        if self.mark is None or any(self.mark[1] in t for t in texts):
            made = self.plain(texts)
        else:
            for at in range(0, len(texts), 256):
                ids = self.plain([self.mark[1].join(texts[at : at + 256])])[0]
                cuts = np.flatnonzero(ids == self.mark[0])
                made += [ids[a:b] for a, b in zip([0, *(cuts + 1)], [*cuts, len(ids)], strict=True)]
        n = np.fromiter(map(len, made), np.int64, len(made))
        at = len(self.ids) + np.cumsum(n) - n
        self.ids = np.concatenate([self.ids, *made])
        self.tables[1] = _joined(self.tables[1], (key, at, n))
        if len(self.tables[1][0]) > max(50_000, len(self.tables[0][0]) // 4):
            self.tables = [_joined(*self.tables), tuple(x[:0] for x in self.tables[1])]

    def find(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each key begin, -1 for one that is not known, and how many they are."""
        at, n = np.full(len(key), -1), np.zeros(len(key), np.int64)
        for keys, begin, size in self.tables:
            if len(keys):
                spot = np.searchsorted(keys, key).clip(max=len(keys) - 1)
                hit = keys[spot] == key
                at[hit], n[hit] = begin[spot[hit]], size[spot[hit]]
        return at, n

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text, equal to those of encoding it as a whole."""
        runs = words_of(texts, lower=False, classes=_RUNS)
        data, offsets = runs.data, runs.offsets
        if not len(runs):
            return [np.zeros(0, np.uint32)] * len(texts)
        space = _RUNS[data[runs.start]] == 2
        joined = np.zeros(len(runs), bool)  # a word that belongs to the white space before it
        joined[1:] = space[:-1] & ~space[1:] & (runs.row[1:] == runs.row[:-1])
        first = np.flatnonzero(~joined)
        last = np.append(first[1:], len(runs)) - 1
        key = runs.hash[first].copy()
        pair = last > first
        key[pair] = mix(key[pair] * np.uint64(0xC2B2AE3D27D4EB4F) + runs.hash[last[pair]])
        start, stop = runs.start[first], runs.end[last]
        distinct, example, which = np.unique(key, return_index=True, return_inverse=True)
        if len(self) + len(distinct) > self.limit:
            self.clear()
        new = self.find(distinct)[0] < 0
        if new.any():
            told = data.tobytes()
            self.learn(distinct[new], [told[start[k] : stop[k]].decode() for k in example[new].tolist()])
        at, n = (x[which] for x in self.find(distinct))
        ends = np.cumsum(n)
        ids = self.ids[np.repeat(at - ends + n, n) + np.arange(ends[-1])]
        bounds = np.concatenate([[0], ends])[np.searchsorted(start, offsets)]
        out = [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        odd = _other_spaces(data, offsets)
        for k, whole in zip(odd.tolist(), self.plain([texts[k].as_py() for k in odd.tolist()]), strict=True):
            out[k] = whole
        return out


Table = tuple[np.ndarray, np.ndarray, np.ndarray]


def _joined(a: Table, b: Table) -> Table:
    key, at, n = (np.concatenate(x) for x in zip(a, b, strict=True))
    order = np.argsort(key)
    return key[order], at[order], n[order]


_RUNS = np.where(BY_SPACE, 1, 2).astype(np.uint8)
# White space beyond ASCII, and control signs that some count as such. Texts that hold any are encoded as a whole.
_OTHER_SPACE = [chr(c).encode() for c in (*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


def _other_spaces(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Numbers of the texts that hold white space beyond ASCII."""
    found = np.zeros(len(data), bool)
    for lead in sorted({s[0] for s in _OTHER_SPACE}):
        at = np.flatnonzero(data == lead)
        for space in (s for s in _OTHER_SPACE if s[0] == lead and len(at)):
            fits = at[at + len(space) <= len(data)]
            for k in range(1, len(space)):
                fits = fits[data[fits + k] == space[k]]
            found[fits] = True
    return np.unique(np.searchsorted(offsets, np.flatnonzero(found), "right") - 1)


def _segments(rules: "BitRules") -> SegmentIds:
    return worker_memory(f"bits:{rules.tokenizer}", lambda: SegmentIds(rules.tokenizer, rules.cache))


def write_token_files(docs: DataFrame, folder: str, rules: BitRules = BitRules()) -> DataFrame:
    """Encode ``doc_id`` and ``text`` of docs into files below folder and list them: file, part, number, n_docs, n_ids, and
    start, the ids in files before it.

    Files and the documents in them ascend by doc_id (null first), equal ids by a hash of the text; null text is empty. Documents
    are dealt out in ranges of (doc_id, hash, row), so a repeated id is split as well. Other columns of docs are not read.
    """
    row = F.monotonically_increasing_id()
    text = F.col("text")
    told = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.cast("string").alias("text"), F.xxhash64(text).alias("hash"), row.alias("row"))
    order = ["doc_id", "hash", "row"]
    dealt = told.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _segments(rules)
        width = bits_for(max(model.model.get_vocab_size(with_added_tokens=True), rules.end + 1))
        part, out, name, made = TaskContext.get().partitionId(), None, "", []
        end = np.array([rules.end], np.uint32)

        def close() -> None:
            out.close()
            made.append((name, part, len(made), len(out.docs), out.ids))

        for batch in batches:
            doc_ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for ids, last in _encoded(model, (texts[k].as_py() or "" for k in range(len(texts)))):
                if out is None:
                    name = f"{folder}/{part:06d}-{len(made):05d}-{uuid.uuid4().hex}.idbits"
                    out = PackedWriter(name, width, rules.block)
                out.add(ids)
                if last is not None:
                    out.add(end)
                    out.end(doc_ids[last])
                    if out.ids + out.waiting >= rules.file_ids:
                        close()
                        out = None
        if out is not None:
            close()
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        columns = list(zip(*made, strict=True)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["file", "part", "number", "n_docs", "n_ids"])

    files = stored(dealt.mapInArrow(write, "file string, part long, number long, n_docs long, n_ids long"))
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)  # one row for each closed file
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _encoded(model: SegmentIds, texts: Iterator[str]) -> Iterator[tuple[np.ndarray, int | None]]:
    """Ids of pieces of texts in order; with a text's last piece comes the text's number. Calls hold about half a million characters."""
    held: list[str] = []
    ends: list[int | None] = []
    size = 0
    for k, text in enumerate(texts):
        for piece in pieces(text):
            held.append(piece)
            ends.append(None)
            size += len(piece)
            if size >= WINDOW // 4:
                yield from zip(model.encode(pa.array(held, pa.large_string())), ends, strict=True)
                held, ends, size = [], [], 0
        if held:
            ends[-1] = k
        else:  # the text's last piece has gone out already
            yield np.zeros(0, np.uint32), k
    if held:
        yield from zip(model.encode(pa.array(held, pa.large_string())), ends, strict=True)


def read_token_files(files: DataFrame, rules: BitRules = BitRules()) -> DataFrame:
    """Every document of listed files: doc_id, start (ids before it in all files), n_tokens, ids_crc32 (of its ids as little-endian
    unsigned 32-bit numbers), file, place (its number in the file). A file is read in spans by several tasks."""
    last = F.floor(F.greatest(F.col("n_ids") - 1, F.lit(0)) / rules.part_ids)
    spans = files.select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("span"))
    tasks = files.agg(F.sum(last + 1)).first()[0] or 1
    dealt = spans.select("file", "start", "span").repartition(min(tasks, 20_000), "file", "span")  # by number, as so small rows would be joined in one task
    step = rules.part_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                held = PackedFile(row["file"])
                # A document belongs to the span in which its last id lies.
                a, b = np.searchsorted(held.ends, [row["span"] * step + 1, (row["span"] + 1) * step + 1])
                begin = np.concatenate([[0], held.ends])[a : b + 1]
                for at in range(int(a), int(b), 65_536):
                    yield _documents(held, row, np.arange(at, min(at + 65_536, int(b))), begin[at - int(a) :], step)
                held.close()

    return dealt.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, file string, place long")


def _documents(held: PackedFile, row: dict, places: np.ndarray, begin: np.ndarray, step: int) -> pa.RecordBatch:
    begin = begin[: len(places) + 1]
    sums, at, loaded = [], 0, np.zeros(0, np.uint32)
    for start, stop in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
        crc = 0
        while start < stop:
            if not at <= start < at + len(loaded):
                at, loaded = start, held.ids(start, min(start + step, int(begin[-1])))
            part = loaded[start - at : stop - at]
            crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
            start += len(part)
        sums.append(crc)
    ids = pa.array(held.doc_ids[places], pa.int64(), mask=held.null[places])
    arrays = [ids, pa.array(begin[:-1] + row["start"], pa.int64()), pa.array(np.diff(begin), pa.int64()), pa.array(sums, pa.int64())]
    arrays += [pa.array([row["file"]] * len(places), pa.string()), pa.array(places, pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "n_tokens", "ids_crc32", "file", "place"])


def token_index(docs: DataFrame, rules: BitRules = BitRules()) -> DataFrame:
    """Write docs as token files in a fresh shared folder and read every document back from them, see ``read_token_files``.

    Every row is one document, repeated ids and rows included; an empty table gives no files and no rows.
    """
    folder = shared_folder(docs.sparkSession)
    return read_token_files(write_token_files(docs, folder, rules), rules)
