"""Batch readers for files whose lines or elements need their place in the file.

Three Python data sources. ``statmart_lines`` plans byte ranges of text files: a line belongs
to the range its first byte lies in, and the lines to leave out (a header, filler lines)
are left out while reading, so no line is numbered and nothing is joined. Where the lines
to leave out start is found by each task from the beginning of the file, no further than
the last of them.

``statmart_json_elements`` walks through JSON documents of any size and gives the elements
of one of their arrays, in Arrow batches; a task holds a piece of the file and the element
it is in. A file is one range, small files share a task.

``statmart_xml_records`` plans byte ranges of XML files: an element with the record tag
belongs to the range its first byte lies in, and is read to its end. So a document of one
line, or one document of any size, is read by many tasks.
"""

from __future__ import annotations

import codecs
import io
import json
import re
from collections.abc import Iterator, Sequence
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from statmart.sources.files import as_list, charset, filesystem

CHUNK = 1 << 20  # bytes read at once
LINES_PER_BATCH = 10_000
BATCH_BYTES = 4 << 20
# Encodings whose line ends are not single ASCII bytes are read in one piece.
_WIDE = ("utf-16", "utf-32")
BOM = codecs.BOM_UTF8
_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}


class Ranges(InputPartition):
    """Byte ranges (path, start, end, size) that one task reads."""

    def __init__(self, parts: list[tuple[str, int, int, int]]):
        super().__init__(None)
        self.parts = parts


def plan_ranges(files: Sequence[tuple[str, int]], most: int, open_cost: int, whole: bool = False) -> list[Ranges]:
    """Ranges of at most ``most`` bytes; short ones share a task, each counted with ``open_cost``."""
    pieces = []
    for path, size in files:
        step = size if whole else most
        pieces += [(path, at, min(size, at + step), size) for at in range(0, size, max(1, step))]
    out, now, load = [], [], 0
    for p in sorted(pieces, key=lambda p: p[1] - p[2]):
        cost = p[2] - p[1] + open_cost
        if now and load + cost > most:
            out.append(Ranges(now))
            now, load = [], 0
        now.append(p)
        load += cost
    return out + [Ranges(now)] if now else out


def _line_start(f, start: int) -> int | None:
    """Where the first line at or behind ``start`` begins; none before the file's end."""
    if start == 0:
        return 0
    f.seek(start - 1)
    near = f.read(2)
    if near[:1] == b"\n" or near[:1] == b"\r" and near[1:] != b"\n":
        return start
    f.seek(start)
    at = start
    while data := f.read(CHUNK):
        found = re.search(rb"[\r\n]", data)
        if found:
            end = found.end()
            if data[end - 1:end] == b"\r" and (data[end:end + 1] or f.read(1)) == b"\n":
                end += 1
            return at + end
        at += len(data)
    return None


def lines_between(f, start: int, end: int, size: int) -> Iterator[tuple[int, list[bytes]]]:
    """(place of the first one, lines) of the lines that begin in ``[start, end)``, some at a time.

    Lines end at a line feed, a carriage return or both; the last one may have no end.
    """
    at = _line_start(f, start)
    if at is None or at >= end:
        return
    f.seek(at)
    held, step = b"", min(CHUNK, max(4096, end - at))
    while at < end:
        data = f.read(step)
        held += data
        last = not data or f.tell() >= size
        if last:
            cut = len(held)
        else:
            known = len(held) - held.endswith(b"\r")  # a carriage return may have its line feed in the next piece
            cut = max(held.rfind(b"\n", 0, known), held.rfind(b"\r", 0, known)) + 1
        part, held = held[:cut], held[cut:]
        if part:
            if at + len(part) <= end:
                yield at, part.splitlines()
            else:
                own, place = [], at
                for line in part.splitlines(keepends=True):
                    if place >= end:
                        break
                    own.append(line.rstrip(b"\r\n"))
                    place += len(line)
                yield at, own
                return
        at += len(part)
        if last:
            return


def places_of(f, numbers: set[int], size: int) -> set[int]:
    """Where the lines of these numbers (from 0) begin."""
    out, number, most, at, held = set(), 0, max(numbers, default=-1), 0, b""
    f.seek(0)
    while number <= most:
        data = f.read(1 << 16)
        held += data
        last = not data or f.tell() >= size
        lines = held.splitlines(keepends=True)
        if not last and lines:
            lines = lines[:-1]  # it may go on in the next piece
        for line in lines:
            if number in numbers:
                out.add(at)
            number += 1
            at += len(line)
            if number > most:
                return out
        held = held[sum(map(len, lines)):]
        if last:
            return out
    return out


def _kept(f, start: int, end: int, size: int, skipped: set[int]) -> Iterator[list[bytes]]:
    for at, lines in lines_between(f, start, end, size):
        if any(at <= s for s in skipped):
            f_at, places = f.tell(), []
            f.seek(at)
            raw = f.read(sum(map(len, lines)) + 2 * len(lines))
            place = at
            for line in raw.splitlines(keepends=True)[:len(lines)]:
                places.append(place)
                place += len(line)
            f.seek(f_at)
            lines = [x for x, p in zip(lines, places) if p not in skipped]
        yield lines


def _text(lines: list[bytes], encoding: str) -> pa.Array:
    if encoding.upper() == "UTF-8":
        try:
            return pa.array(lines, pa.binary()).cast(pa.string())
        except pa.ArrowInvalid:
            pass
    return pa.array([x.decode(encoding, "replace") for x in lines], pa.string())


def as_uri(path: str) -> str:
    """A plain path in the spelling of Spark's file metadata."""
    if not re.match(r"[a-zA-Z][\w+.-]*:", path):
        path = "file:" + path
    path = re.sub(r"^file:/+", "file:/", path)
    return re.sub(r'[%\x00-\x20"<>\\^`{|}#?\[\]\x7f]', lambda m: quote(m.group(), safe=""), path)


class LineReader(DataSourceReader):
    def __init__(self, options: dict):
        self.files = [tuple(f) for f in json.loads(options["files"])]
        self.encoding = options["encoding"]
        self.skip = [(pattern, set(numbers)) for pattern, numbers in json.loads(options["skip"])]
        self.most, self.cost = int(options["rangebytes"]), int(options["opencost"])
        self.wide = self.encoding.lower().replace("_", "-").startswith(_WIDE)

    def partitions(self) -> list[Ranges]:
        return plan_ranges(self.files, self.most, self.cost, whole=self.wide)

    def _numbers(self, path: str) -> set[int]:
        name = path.rstrip("/").rsplit("/", 1)[-1]
        return set().union(*(n for pattern, n in self.skip if pattern is None or pattern in name))

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        for path, start, end, size in partition.parts:
            fs, p = filesystem(path)
            uri, numbers = as_uri(path), self._numbers(path)
            with fs.open_input_file(p) as f:
                if self.wide:
                    text = io.TextIOWrapper(f, encoding=self.encoding, newline=None)
                    kept = ([line.rstrip("\n")] for i, line in enumerate(text) if i not in numbers)
                    batches = (pa.array(x, pa.string()) for x in kept)
                else:
                    skipped, first = places_of(f, numbers, size), start == 0
                    batches = (_text(x, self.encoding) for x in
                               self._without_mark(_kept(f, start, end, size, skipped), first and 0 not in skipped))
                for values in batches:
                    for at in range(0, len(values), LINES_PER_BATCH):
                        part = values.slice(at, LINES_PER_BATCH)
                        yield pa.RecordBatch.from_arrays([part, pa.array([uri] * len(part), pa.string())],
                                                         names=["value", "file"])

    def _without_mark(self, lines: Iterator[list[bytes]], first: bool) -> Iterator[list[bytes]]:
        for own in lines:
            if first and own and self.encoding.upper() == "UTF-8" and own[0].startswith(BOM):
                own = [own[0][len(BOM):], *own[1:]]
            first = False
            yield own


class LineSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "statmart_lines"

    def schema(self) -> str:
        return "value string, file string"

    def reader(self, schema) -> DataSourceReader:
        return LineReader(self.options)


# ---- elements of JSON documents --------------------------------------------------------------

# a whole string, the beginning of one that the piece does not end, or a sign of structure
_TOKEN = re.compile(rb'"[^"\\]*(?:\\.[^"\\]*)*("|\\?\Z)|[{}\[\],:]', re.S)


def json_elements(f, key: str, chunk: int = CHUNK) -> Iterator[bytes]:
    """The elements of the array ``key`` of every document of a file, as their own text.

    Documents follow one another with or without line ends, or are the elements of one
    array. A value of ``key`` that is no array has no elements.
    """
    held, base, depth = b"", 0, 0
    name: bytes | None = None   # the last string at the document's level, which a colon makes a key
    wanted = False              # the value that comes belongs to ``key``
    inside, begin = False, 0    # in the array, and where its current element begins
    target, last, at = key, False, 0
    while not last:
        data = f.read(chunk)
        last = not data
        held += data
        while m := _TOKEN.search(held, at):
            token, sign = m.group(), held[m.start():m.start() + 1]
            if sign == b'"':
                if m.group(1) != b'"' or len(token) == 1:
                    if last:
                        raise ValueError("a JSON document ends inside a string")
                    break  # the string goes on in the next piece
                if depth == base + 1 and not inside:
                    name = token
            elif sign in b"{[":
                if depth == 0 and sign == b"[":
                    base = 1
                if sign == b"[" and wanted and depth == base + 1:
                    inside, begin = True, m.end()
                wanted, depth = False, depth + 1
            elif sign in b"}]":
                depth -= 1
                if depth < 0:
                    raise ValueError("a JSON document closes more than it opens")
                if inside and depth == base + 1:
                    element = held[begin:m.start()].strip()
                    if element:
                        yield element
                    inside = False
                if depth == 0:
                    base = 0
                wanted = False
            elif sign == b":" and depth == base + 1 and not inside:
                wanted = name is not None and json.loads(name) == target
            elif sign == b",":
                if inside and depth == base + 2:
                    yield held[begin:m.start()].strip()
                    begin = m.end()
                wanted = wanted and depth != base + 1
            at = m.end()
        else:
            at = len(held)
        done = begin if inside else at
        held, at, begin = held[done:], at - done, 0
    if depth:
        raise ValueError("a JSON document is not closed")


class ElementReader(DataSourceReader):
    def __init__(self, options: dict):
        self.files = [tuple(f) for f in json.loads(options["files"])]
        self.key = options["key"]
        self.most, self.cost = int(options["rangebytes"]), int(options["opencost"])

    def partitions(self) -> list[Ranges]:
        return plan_ranges(self.files, self.most, self.cost, whole=True)

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        own, size = [], 0
        for path, *_ in partition.parts:
            fs, p = filesystem(path)
            with fs.open_input_stream(p) as f:
                for element in json_elements(f, self.key):
                    own.append(element.replace(b"\r", b" ").replace(b"\n", b" "))  # strings hold none of these
                    size += len(element)
                    if size >= BATCH_BYTES or len(own) >= LINES_PER_BATCH:
                        yield pa.RecordBatch.from_arrays([_text(own, "UTF-8")], names=["value"])
                        own, size = [], 0
        if own:
            yield pa.RecordBatch.from_arrays([_text(own, "UTF-8")], names=["value"])


class ElementSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "statmart_json_elements"

    def schema(self) -> str:
        return "value string"

    def reader(self, schema) -> DataSourceReader:
        return ElementReader(self.options)


# ---- records of XML documents ----------------------------------------------------------------

# Files that have no byte ranges of their own are read in one piece.
_PACKED = (".gz", ".bz2", ".zst", ".lz4")


def xml_elements(f, tag: str, start: int, end: int | None, chunk: int = CHUNK) -> Iterator[bytes]:
    """The elements with the local name ``tag`` that begin in ``[start, end)`` of a file, as their own text.

    Elements within an element of that name are a part of it. ``f`` stands at ``start``;
    without ``end`` everything is read.
    """
    name = rb"(?:[^\s<>/:'\"=]+:)?" + re.escape(tag.encode())
    sign = re.compile(rb"<!--|<!\[CDATA\[|<" + name + rb"(?=[\s/>])|</" + name + rb"\s*>")
    rest = re.compile(rb"(?:[^>'\"]|'[^']*'|\"[^\"]*\")*>")  # of an opening tag, behind its name
    held, base, at, begin, depth, last = b"", start, 0, -1, 0, False
    while True:
        while m := sign.search(held, at):
            token = m.group()
            if token.startswith(b"<!"):
                close = b"-->" if token == b"<!--" else b"]]>"
                stop = held.find(close, m.end())
                if stop < 0:
                    break
                at = stop + 3
            elif token.startswith(b"</"):
                at = m.end()
                depth = max(0, depth - 1)
                if begin >= 0 and not depth:
                    yield held[begin:at]
                    begin = -1
            else:
                if not depth and end is not None and base + m.start() >= end:
                    return
                opened = rest.match(held, m.end())
                if not opened:
                    break
                if not depth:
                    begin = m.start()
                at = opened.end()
                if opened.group().endswith(b"/>"):
                    if not depth:
                        yield held[begin:at]
                        begin = -1
                else:
                    depth += 1
        else:  # what may be the beginning of a sign stays
            at = max(at, held.rfind(b"<", at)) if held.find(b"<", at) >= 0 else len(held)
        if last:
            if depth:
                raise ValueError(f"an XML document ends inside an element {tag}")
            return
        if begin < 0 and end is not None and base + at >= end:
            return
        done = begin if begin >= 0 else at
        held, base, at = held[done:], base + done, at - done
        begin = 0 if begin >= 0 else -1
        data = f.read(chunk)
        last = not data
        held += data


class XmlReader(DataSourceReader):
    def __init__(self, options: dict):
        self.files = [tuple(f) for f in json.loads(options["files"])]
        self.tag, self.whole = options["tag"], options["whole"] == "true"
        self.most, self.cost = int(options["rangebytes"]), int(options["opencost"])

    def partitions(self) -> list[Ranges]:
        packed = [f for f in self.files if f[0].endswith(_PACKED)]
        plain = [f for f in self.files if not f[0].endswith(_PACKED)]
        return plan_ranges(plain, self.most, self.cost, whole=self.whole) \
            + plan_ranges(packed, self.most, self.cost, whole=True)

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        own, size = [], 0
        for path, start, end, _ in partition.parts:
            fs, p = filesystem(path)
            packed = path.endswith(_PACKED)
            with (fs.open_input_stream(p) if packed else fs.open_input_file(p)) as f:
                if start:
                    f.seek(start)
                for element in xml_elements(f, self.tag, start, None if packed else end):
                    own.append(element)
                    size += len(element)
                    if size >= BATCH_BYTES or len(own) >= LINES_PER_BATCH:
                        yield pa.RecordBatch.from_arrays([_text(own, "UTF-8")], names=["value"])
                        own, size = [], 0
        if own:
            yield pa.RecordBatch.from_arrays([_text(own, "UTF-8")], names=["value"])


class XmlSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "statmart_xml_records"

    def schema(self) -> str:
        return "value string"

    def reader(self, schema) -> DataSourceReader:
        return XmlReader(self.options)


# ---- DataFrames ------------------------------------------------------------------------------

def _bytes(setting: str) -> int:
    number, unit = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]*)\s*", setting).groups()
    return int(number) * _UNITS[unit.lower()]


def sized_files(spark: SparkSession, paths: str | Sequence[str]) -> list[tuple[str, int]]:
    """(plain path, bytes) of the data files behind ``paths``; folders are expanded, hidden files skipped."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(as_list(paths)) \
        .select("path", "length").collect()  # one row per file, as a scan's own file index
    return sorted((r["path"], r["length"]) for r in found)


def _load(spark: SparkSession, source: type[DataSource], files: Sequence[tuple[str, int]], **options: str) -> DataFrame:
    spark.dataSource.register(source)
    conf = {"files": json.dumps(list(files)), "rangebytes": str(_bytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))),
            "opencost": str(_bytes(spark.conf.get("spark.sql.files.openCostInBytes"))), **options}
    return spark.read.format(source.name()).options(**conf).load()


def lines(spark: SparkSession, files: Sequence[tuple[str, int]], encoding: str = "utf-8",
          skip: Sequence[tuple[str | None, Sequence[int]]] = ()) -> DataFrame:
    """``value, file`` of every line of ``files`` (see :func:`sized_files`) but the skipped ones.

    ``skip`` holds (part of a file's own name, or None for all; 0-based line numbers).
    ``file`` is the URI that Spark's file metadata shows.
    """
    return _load(spark, LineSource, files, encoding=charset(encoding),
                 skip=json.dumps([(p, sorted(n)) for p, n in skip]))


def elements(spark: SparkSession, files: Sequence[tuple[str, int]], key: str) -> DataFrame:
    """``value``: the text of each element of the array ``key`` of the JSON documents in ``files``."""
    return _load(spark, ElementSource, files, key=key)



def xml_texts(spark: SparkSession, files: Sequence[tuple[str, int]], tag: str, whole: bool = False) -> DataFrame:
    """``value``: the text of each element with the local name ``tag`` of the XML files ``files``.

    Files are cut at any byte, so a tag that stands in a comment or a CDATA section is told
    from an element only if the section begins in the same range, and elements that hold
    others of their name need ``whole`` (a file is one range).
    """
    return _load(spark, XmlSource, files, tag=tag, whole=str(whole).lower())
