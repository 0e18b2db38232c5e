"""Main text of web pages by nearest-URL page differencing.

Pages are cut into text lines, one for each block. Within a host every page is paired with the page next to it in path order, their
lines are aligned by longest common subsequence, and lines that both have are deleted. Markup then checks each page: elements that
are never main text are dropped, and where a page marks its article, lines in it that differencing deleted come back and the others go.
"""

from __future__ import annotations

import html
import pickle
import re
import tempfile
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.llm.store import stored

# Element and attribute names by role.
RAW = frozenset("script style noscript template iframe textarea svg math select object title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("nav footer aside form button dialog menu".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
MAIN_TAGS = frozenset(("article", "main"))
MAIN_WORDS = frozenset("article main story".split())
DROPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice alert popup modal overlay"
    " newsletter subscribe subscription sidebar widget related recommended share sharing social menu nav navbar navigation breadcrumb breadcrumbs"
    " comment comments disqus footer masthead topbar pagination pager toolbar login signup disclaimer".split()
)
HEADER_WORDS = frozenset(("header",))
# Parts of a class or id that say where or what kind of box, not what it holds; "has-sidebar" or "share-price" has others and names no role.
NEUTRAL_WORDS = MAIN_WORDS | frozenset(
    "site page global primary secondary top bottom left right container wrapper wrap box list section block area bar inner outer image images link links"
    " item items button buttons icon icons unit slot zone region panel row col column form header content post posts articles stories notice".split()
)
# Parts of a class or id of main text, one of which is a main word; "article-tools" or "story-list" has others and is something else.
MAIN_PARTS = MAIN_WORDS | frozenset("site page primary container wrapper wrap section block area inner column content post body text".split())
# Articles that are no main text: of readers, which are dropped, and pointers to other pages.
COMMENT_WORDS = frozenset("comment comments disqus".split())
TEASER_WORDS = frozenset("teaser teasers card cards preview previews".split())
KEPT_TAGS = frozenset("html body main article".split())
# What is dropped inside marked main text: adverts, comments, forms and navigation.
INNER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising comment comments disqus nav navbar navigation menu breadcrumb breadcrumbs pagination pager"
    " newsletter subscribe login signup sidebar cookie cookies consent related recommended sponsor sponsored promo promotion".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
INNER_ROLES = frozenset("navigation search dialog alertdialog form menu menubar toolbar".split())

_TAG = re.compile(
    r"""<!--|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^"'<>]++|"[^"<]*+"|'[^'<]*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)"""
)
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|aria-hidden|hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+")
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*>?", re.IGNORECASE) for name in RAW}

# What a line is to the page.
OPEN, MAIN = 0, 1


def _named(value: str, roles: frozenset[str]) -> bool:
    """Whether a token of a class or id names a role: one of its parts does, and the others are neutral."""
    for token in value.split():
        parts = set(_WORD.findall(token))
        if parts & roles and parts <= roles | NEUTRAL_WORDS:
            return True
    return False


def _roles(name: str, attributes: str, inside: bool) -> tuple[bool, bool, bool]:
    """Whether an element's attributes make it dropped, dropped outside main text, or main text. inside: it lies in main text."""
    drop = header = main = teaser = False
    words, roles = (INNER_WORDS, INNER_ROLES) if inside else (DROPPED_WORDS, DROPPED_ROLES)
    for attribute, value in _ATTRIBUTE.findall(attributes):
        attribute, value = attribute.lower(), value.strip("\"'").lower()
        if attribute == "hidden" or (attribute == "aria-hidden" and value == "true"):
            drop = True
        elif attribute == "role":
            drop, main = drop or value in roles, main or value in ("main", "article")
        elif attribute in ("class", "id"):
            if name not in KEPT_TAGS:
                drop, header = drop or _named(value, words), header or _named(value, HEADER_WORDS)
            elif name == "article":
                drop, teaser = drop or _named(value, COMMENT_WORDS), teaser or _named(value, TEASER_WORDS)
            main = main or (name not in ("html", "body") and any(_is_main(token) for token in value.split()))
    return drop, header, (main or name in MAIN_TAGS) and not teaser


def _is_main(token: str) -> bool:
    parts = set(_WORD.findall(token))
    return bool(parts & MAIN_WORDS) and parts <= MAIN_PARTS


def page_lines(page: str) -> tuple[list[str], list[int]]:
    """Text of each block in page order, with white space made one space, and what it is (OPEN or MAIN). Empty blocks give no line.

    Character references are decoded. Comments, scripts, styles and dropped elements give nothing. Unclosed elements end with what
    holds them; a comment or script that never ends takes the rest of the page.
    """
    lines, kinds = [], []
    parts: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # name, drops, is main
    drops = mains = 0

    def flush() -> None:
        if parts:
            if text := " ".join(html.unescape("".join(parts)).split()):
                lines.append(text)
                kinds.append(MAIN if mains else OPEN)
            parts.clear()

    at, end = 0, len(page)
    while at < end:
        found = _TAG.search(page, at)
        if not drops and (found is None or found.start() > at):
            parts.append(page[at : found.start() if found else end])
        if found is None:
            break
        at = found.end()
        if found[0] == "<!--":
            close = page.find("-->", at)
            at = close + 3 if close >= 0 else end
            continue
        name = (found[2] or found[5] or "").lower()
        if not name:
            continue
        closing = bool(found[1] or found[4])
        if name in RAW:
            if not closing:
                close = _RAW_END[name].search(page, at)
                at = close.end() if close else end
            continue
        block = name in BLOCKS
        if block:
            flush()
        if name in VOID:
            continue
        if closing:
            place = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), -1)
            if place >= 0:
                for _, d, m in stack[place:]:
                    drops -= d
                    mains -= m
                del stack[place:]
            continue
        while block and stack and (stack[-1][0] == "p" or stack[-1][0] == name == "li"):
            _, d, m = stack.pop()
            drops -= d
            mains -= m
        attributes = found[3] or found[6] or ""
        drop, header, main = _roles(name, attributes, mains > 0) if "=" in attributes or "hidden" in attributes else (False, False, name in MAIN_TAGS)
        drop = drop or name in DROPPED or ((header or name == "header") and not mains)
        main = block and not drop and main
        if attributes.endswith("/") and not block:
            continue
        if drop or main or (block and name not in ("p", "li")) or (drops and any(s[0] == name for s in stack)):
            stack.append((name, drop, main))
            drops += drop
            mains += main
    flush()
    return lines, kinds


def _rows(a: list[int], b: list[int]) -> Iterator[int]:
    """For each leading part of a, a number whose bit j is 0 where the longest common subsequence with b grows at place j."""
    places: dict[int, int] = defaultdict(int)
    for j, x in enumerate(b):
        places[x] |= 1 << j
    every = row = (1 << len(b)) - 1
    yield row
    for x in a:
        met = row & places.get(x, 0)
        row = ((row + met) | (row - met)) & every
        yield row


def _aligned(a: list[int], b: list[int], bits: int) -> list[int]:
    if not a or not b:
        return []
    if len(a) * len(b) > bits and len(a) > 1:
        # Too long to keep every row: cut a in half and b where the two halves' lengths sum up highest.
        half = len(a) // 2
        for head in _rows(a[:half], b):
            pass
        for tail in _rows(a[half:][::-1], b[::-1]):
            pass
        ahead = np.concatenate([[0], np.cumsum([c == "0" for c in f"{head:0{len(b)}b}"[::-1]])])
        behind = np.concatenate([[0], np.cumsum([c == "0" for c in f"{tail:0{len(b)}b}"[::-1]])])[::-1]
        cut = int(np.argmax(ahead + behind))
        return _aligned(a[:half], b[:cut], bits) + [half + i for i in _aligned(a[half:], b[cut:], bits)]
    rows = list(_rows(a, b))
    out, i, j = [], len(a), len(b)
    while i and j:
        if rows[i] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if rows[i] >> (j - 1) & 1:
                out.append(i)
                j -= 1
    return out[::-1]


def common_lines(a: list[int], b: list[int], bits: int = 1 << 26) -> list[int]:
    """Places in a of a longest common subsequence of a and b, by bit-parallel rows of which at most about ``bits`` bits are held."""
    head, most = 0, min(len(a), len(b))
    while head < most and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < most - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    end = len(a) - tail
    in_a, in_b = set(a[head:end]), set(b[head : len(b) - tail])
    kept = [i for i in range(head, end) if a[i] in in_b]
    inner = _aligned([a[i] for i in kept], [x for x in b[head : len(b) - tail] if x in in_a], bits)
    return [*range(head), *[kept[i] for i in inner], *range(end, len(a))]


def _line_hashes(lines: list[str]) -> list[int]:
    import xxhash

    return [xxhash.xxh3_64_intdigest(x.encode("utf-8", "replace")) - (1 << 63) for x in lines]


def _path_prefix(a: str, b: str) -> int:
    """Leading path parts that two paths share."""
    n = 0
    for x, y in zip(a.split("/"), b.split("/"), strict=False):
        if x != y:
            break
        n += 1
    return n


Page = tuple  # host, path, row_key, lines, sizes


def is_copy(a: Page, b: Page, alike: float = 0.75, same_path: float = 0.5) -> bool:
    """Whether two pages of a host are one page: of the characters in the lines of the larger, both have the share ``alike``, or
    ``same_path`` where only query, fragment or a last slash part their URLs."""
    x, y = (dict(zip(p[3], p[4], strict=True)) for p in (a, b))
    both, most = sum(n for line, n in x.items() if line in y), max(sum(x.values()), sum(y.values()))
    return a[0] == b[0] and both >= (same_path if a[1] == b[1] else alike) * most


def _nearest(page: Page, before: Page | None, after: Page | None) -> list[int]:
    """Numbers of the page's lines that the nearer of two pages of its host has too."""
    near = [x for x in (before, after) if x is not None and x[0] == page[0]]
    return common_lines(page[3], max(near, key=lambda x: _path_prefix(page[1], x[1]))[3]) if near else []


PAGE = pa.struct([("host", pa.string()), ("path", pa.string()), ("row_key", pa.int64()), ("lines", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32()))])
_PAGE = "struct<host: string, path: string, row_key: bigint, lines: array<bigint>, sizes: array<int>>"
_WALKED = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("row_key", pa.int64()), ("shared", pa.list_(pa.int32())), *[(c, PAGE) for c in ("page", "before", "after", "last")]])
DONE, FIRST, LAST, ONLY, EDGE = range(5)


def _plain(page: dict | None) -> Page | None:
    return None if page is None else tuple(page[c] for c in ("host", "path", "row_key", "lines", "sizes"))


class _Run:
    """The pages of a run of copies, in order; those beyond the first ``held`` lie in a file, so a run of any length fits a task."""

    def __init__(self, held: int = 2000) -> None:
        self.held, self.pages, self.file = held, [], None

    def append(self, page: Page) -> None:
        if len(self.pages) < self.held:
            self.pages.append(page)
            return
        self.file = self.file or tempfile.TemporaryFile()
        pickle.dump(page, self.file)

    def taken(self) -> Iterator[Page]:
        """All pages, after which the run is empty."""
        yield from self.pages
        if self.file:
            end = self.file.tell()
            self.file.seek(0)
            while self.file.tell() < end:
                yield pickle.load(self.file)
            self.file.close()
        self.pages, self.file = [], None


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Align the sorted pages of a task. Runs of copies have one page before and one after them; the first and the last run of the task
    wait for other tasks' pages (FIRST, LAST, ONLY), for which an EDGE row tells its first and last page and the ones beside their runs."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    names = [f.name for f in PAGE]
    out: list[dict] = []

    def row(kind: int, **values) -> dict:
        return {"part": part, "kind": kind} | {k: dict(zip(names, v, strict=True)) if isinstance(v, tuple) else v for k, v in values.items()}

    def batch_of_rows(least: int = 1) -> Iterator[pa.RecordBatch]:
        if len(out) >= least:
            yield pa.RecordBatch.from_pylist(out, schema=_WALKED)
            out.clear()

    def close(after: Page | None) -> Iterator[pa.RecordBatch]:
        for page in run.taken():
            if first_run or after is None:
                out.append(row(ONLY if first_run and after is None else FIRST if first_run else LAST, row_key=page[2], page=page, before=before, after=after))
            elif found := _nearest(page, before, after):
                out.append(row(DONE, row_key=page[2], shared=found))
            yield from batch_of_rows(1000)

    run = _Run()
    before = now = first = second = None
    first_run = True
    for batch in batches:
        for page in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            if now is not None and not is_copy(now, page):
                yield from close(page)
                second = page if first_run else second
                before, first_run = now, False
            first = first or page
            now = page
            run.append(page)
        yield from batch_of_rows()
    if now is not None:
        yield from close(None)
        out.append(row(EDGE, page=first, last=now, before=before, after=second))
        yield from batch_of_rows()


def _beside(edges: list[tuple]) -> dict[int, tuple[Page | None, Page | None]]:
    """By task, the page before its first run and the one after its last. edges: (part, first, last, before its last run, after its
    first run), in order of tasks."""
    before, after = {}, {}
    at = None
    for k, (part, first, *_) in enumerate(edges):
        if k:
            _, _, last, ahead, _ = edges[k - 1]
            at = last if not is_copy(last, first) else ahead if ahead is not None else at
        before[part] = at
    at = None
    for k in reversed(range(len(edges))):
        part, _, last, *_ = edges[k]
        if k + 1 < len(edges):
            _, first, _, _, beyond = edges[k + 1]
            at = first if not is_copy(last, first) else beyond if beyond is not None else at
        after[part] = at
    return {part: (before[part], after[part]) for part in before}


def shared_lines(pages: DataFrame) -> DataFrame:
    """(row_key, shared): the numbers of the lines that the nearest page of the host has too, for every page that shares any.

    Pages are range-partitioned and sorted by host, path and key, so a host with a third of all pages lies in many tasks. Neighbours
    that are copies of each other form a run. Of the pages before and after its run a page takes the one that shares more of its path,
    the one before on a tie. Runs at the ends of a task are aligned in a second pass, for which one row a task passes through the
    driver, so that results do not depend on how pages are dealt out. Only hashes and lengths of lines move.
    """
    spark = pages.sparkSession
    schema = "host string, path string, row_key long, lines array<long>, sizes array<int>"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [page_lines(x.as_py() or "") for x in batch.column("html")]
            columns = [batch.column(c) for c in ("host", "path", "row_key")]
            hashes = pa.array([_line_hashes(m[0]) for m in made], pa.list_(pa.int64()))
            sizes = pa.array([[len(x) for x in m[0]] for m in made], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*columns, hashes, sizes], names=["host", "path", "row_key", "lines", "sizes"])

    rest = F.regexp_replace(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    rest = F.regexp_replace(rest, r"[?#].*$", "")
    path = F.regexp_replace(F.regexp_replace(rest, r"^[^/]*", ""), r"/+$", "")
    keyed = pages.select("row_key", "html", F.lower(F.substring_index(rest, "/", 1)).alias("host"), path.alias("path"))
    cuts = keyed.mapInArrow(cut, schema).dropDuplicates(["row_key"])
    ordered = cuts.repartitionByRange("host", "path", "row_key").sortWithinPartitions("host", "path", "row_key")
    walked = stored(ordered.mapInArrow(_walk, f"part int, kind int, row_key long, shared array<int>, page {_PAGE}, before {_PAGE}, after {_PAGE}, last {_PAGE}"))

    edges = walked.where(F.col("kind") == EDGE).select("part", "page", "last", "before", "after").orderBy("part").collect()
    beside = _beside([(e.part, *[_plain(x) for x in (e.page, e.last, e.before, e.after)]) for e in edges])
    around = spark.createDataFrame([(k, *v) for k, v in beside.items()], f"part int, earlier {_PAGE}, later {_PAGE}")
    waiting = walked.where(F.col("kind").isin(FIRST, LAST, ONLY)).join(around, "part")
    # The page before is known but in a task's first run, the one after but in its last.
    ends = waiting.select(
        "row_key", "page", F.when(F.col("kind") == LAST, F.col("before")).otherwise(F.col("earlier")).alias("before"), F.when(F.col("kind") == FIRST, F.col("after")).otherwise(F.col("later")).alias("after")
    )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_nearest(*(_plain(x) for x in pages)) for pages in zip(*(batch.column(c).to_pylist() for c in ("page", "before", "after")), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("row_key"), pa.array(found, pa.list_(pa.int32()))], names=["row_key", "shared"])

    done = walked.where(F.col("kind") == DONE).select("row_key", "shared")
    return done.unionByName(ends.mapInArrow(finish, "row_key long, shared array<int>"))


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of pages, and n_shared: how many of its lines the nearest page has too.

    Differencing deletes the lines outside dropped elements that the nearest page shares. A page that marks its article is then
    checked against the mark, which is exact: shared lines of the article come back, as unlike pages may hold equal sentences, and
    lines outside it go, as menus may differ from page to page. Null and empty html give an empty text; a null url belongs to the host without a name; rows that repeat a page
    are each cut alike, and a copy of a page (``is_copy``) is never what it is compared with; a very long page is handled whole in its row.
    """
    keyed = pages.select("page_id", "url", "html", F.xxhash64("url", "html").alias("row_key"))
    shared = stored(shared_lines(keyed))
    joined = keyed.join(shared, "row_key", "left").select("page_id", "url", "html", "shared")
    schema = T.StructType([pages.schema["page_id"], pages.schema["url"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("n_shared", T.LongType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, shared = [], []
            for page, gone in zip(batch.column("html"), batch.column("shared"), strict=True):
                lines, kinds = page_lines(page.as_py() or "")
                drop = set(gone.as_py() or ())
                kept = [i not in drop for i in range(len(lines))]
                if MAIN in kinds:
                    kept = [k == MAIN for k in kinds]
                texts.append("\n".join(x for x, stays in zip(lines, kept, strict=True) if stays))
                shared.append(len(drop))
            n = np.fromiter(map(len, texts), np.int64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(n), pa.array(shared, pa.int64())], names=["page_id", "url", "text", "n_chars", "n_shared"])

    return joined.mapInArrow(cut, schema)
