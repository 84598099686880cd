"""S1. FASTA and FASTQ files as a Spark data source: planned splits, records of any number of lines, plain, gzip or block-gzip.

    spark.dataSource.register(SequenceSource)
    spark.read.format("sequences").option("path", "file:///reads/*.fq.gz").load()

Columns are file, place, header, seq, qual (null for FASTA) and n, the letters of seq; a schema with some of them reads no more than
those need. Plain files and those of block-gzip (gzip members of 64 KiB at most that say how long they are) are cut into splits of ``split_bytes``;
other gzip files are one split each and are decompressed as a stream. A record belongs to the split that holds the line end before it, so every
record is read once, wherever cuts fall, and no task holds more than a record.

Files are opened by Arrow's file systems (local, hdfs, s3, gs), on the executors themselves.
"""

from __future__ import annotations

import fnmatch
import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

SCHEMA = "file string, place long, header string, seq string, qual string, n long"
KINDS = {"file": pa.string(), "place": pa.int64(), "header": pa.string(), "seq": pa.string(), "qual": pa.string(), "n": pa.int64()}
PIECE = 1 << 20
#: Records that must follow one another for a line to count as a FASTQ record's begin in the middle of a file, and the bytes of a batch.
CHAIN, BATCH_BYTES = 4, 8 << 20
#: Quality can look like a record's begin, for a line or two. So a split of FASTQ is read from so many bytes before it, and what begins there is left out.
LOOK_BACK = 1 << 17
BEFORE, INSIDE, BEHIND = -1, 0, 1
#: The first bytes of a block-gzip block, up to its length: gzip with an extra field of six bytes, BC of two.
_BLOCK, _EXTRA = b"\x1f\x8b\x08\x04", b"\x06\x00BC\x02\x00"


@dataclass
class Split(InputPartition):
    file: str
    kind: str
    begin: int
    end: int


@dataclass
class Line:
    text: bytes
    place: int
    #: Where the line end before it lies: before the split, inside or behind.
    where: int


# --- bytes -----------------------------------------------------------------------------------------------------------


def _opened(path: str):
    system, inner = arrow_fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    return system, inner


def files_of(path: str) -> list[tuple[str, int]]:
    """(path, bytes) of a file, of a folder's files or of those that a pattern in the last part of a path names; hidden files don't count."""
    folder, _, last = path.rpartition("/")
    if any(c in last for c in "*?["):
        system, inner = _opened(folder)
        found = [f for f in system.get_file_info(arrow_fs.FileSelector(inner)) if fnmatch.fnmatchcase(f.base_name, last)]
        base = folder
    else:
        system, inner = _opened(path)
        info = system.get_file_info(inner)
        if info.type == arrow_fs.FileType.NotFound:
            raise FileNotFoundError(path)
        if info.type == arrow_fs.FileType.File:
            return [(path, info.size)]
        found, base = system.get_file_info(arrow_fs.FileSelector(inner)), path.rstrip("/")
    return sorted((f"{base}/{f.base_name}", f.size) for f in found if f.type == arrow_fs.FileType.File and f.base_name[0] not in "._")


def compression(head: bytes) -> str:
    if head.startswith(_BLOCK) and head[10:16] == _EXTRA:
        return "blocks"
    return "gzip" if head.startswith(b"\x1f\x8b") else "plain"


def _block_begins(data: bytes, at: int) -> bool:
    return data.startswith(_BLOCK, at) and data[at + 10 : at + 16] == _EXTRA


def chunks(source, split: Split, back: int = 0) -> Iterator[tuple[bytes, int, int]]:
    """(bytes, place, where) from ``back`` bytes before the split's begin to the file's end: decompressed pieces, each before the split, inside or
    behind. A place in block-gzip is the block's begin times 2^16 and the place in it."""
    where = lambda at: BEFORE if at < split.begin else INSIDE if at < split.end else BEHIND
    if split.kind == "plain":
        at = max(0, split.begin - back)
        source.seek(at)
        while data := source.read(min([PIECE, *(edge - at for edge in (split.begin, split.end) if edge > at)])):
            yield data, at, where(at)
            at += len(data)
    elif split.kind == "gzip":
        source.seek(0)
        at, machine = 0, zlib.decompressobj(31)
        while data := source.read(PIECE):
            while data:
                out = machine.decompress(data, PIECE)
                if out:
                    yield out, at, INSIDE
                    at += len(out)
                data = machine.unconsumed_tail
                if machine.eof:
                    data, machine = machine.unused_data, zlib.decompressobj(31)
                    data = b"" if not data.strip(b"\0") else data  # padding
    else:
        at = _first_block(source, max(0, split.begin - back))
        while at is not None:
            source.seek(at)
            head = source.read(18)
            if len(head) < 18:
                return
            size = int.from_bytes(head[16:18], "little") + 1
            out = zlib.decompress(head + source.read(size - 18), 31)
            if out:
                yield out, at << 16, where(at)
            at += size


def _first_block(source, begin: int) -> int | None:
    """The first block from a place on: what looks like one and is followed by another, or by the file's end."""
    if begin == 0:
        return 0
    source.seek(begin)
    data = source.read(1 << 18)  # a block and what it may be sought behind are shorter
    at = data.find(_BLOCK)
    while at >= 0:
        if _block_begins(data, at) and len(data) >= at + 18:
            after = at + int.from_bytes(data[at + 16 : at + 18], "little") + 1
            if after == len(data) or _block_begins(data, after):
                return begin + at
        at = data.find(_BLOCK, at + 1)
    return None


def lines(parts: Iterator[tuple[bytes, int, int]], first: bool) -> Iterator[Line]:
    """Lines without their ends; ``first``: the file begins here, so its first line has one before it. Else the first, cut line is left out."""
    rest: list[bytes] = []
    begin, where, known = None, None, first
    for data, place, own in parts:
        at = 0
        if begin is None:
            begin = place
        where = own if where is None else where
        while (to := data.find(b"\n", at)) >= 0:
            if known:
                yield Line(b"".join([*rest, data[at:to]]).rstrip(b"\r"), begin, where)
            rest, known, where, at = [], True, own, to + 1
            begin = place + at if at < len(data) else None
        if at < len(data) and known:
            rest.append(data[at:])
    if rest and known:
        yield Line(b"".join(rest).rstrip(b"\r"), begin, where)


# --- records ---------------------------------------------------------------------------------------------------------


def fasta_records(source: Iterator[Line]) -> Iterator[tuple]:
    """(place, header, parts of seq, None). Text before the first header of a file is no record."""
    now = None
    for line in source:
        if line.text.startswith(b">"):
            if now:
                yield now
            if line.where == BEHIND:
                return
            now = line.place, line.text[1:].strip(), [], None
        elif now:
            now[2].append(b"".join(line.text.split()))
    if now:
        yield now


class Ahead:
    """Lines that can be read before they are taken."""

    def __init__(self, source: Iterator[Line]):
        self.source, self.held = source, deque()

    def get(self, k: int) -> Line | None:
        while len(self.held) <= k:
            line = next(self.source, None)
            if line is None:
                return None
            self.held.append(line)
        return self.held[k]

    def drop(self, n: int) -> None:
        for _ in range(n):
            self.held.popleft()


_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + b"*-.~"


def fastq_record(ahead: Ahead, at: int) -> tuple[int, list[bytes], list[bytes]] | str:
    """(lines, parts of seq, parts of qual) of the record that begins at the line ``at``, or what is wrong with it.

    The quality has as many characters as the sequence, over as many lines as that takes; blank lines end a file only."""
    head = ahead.get(at)
    if head is None or not head.text.startswith(b"@"):
        return "a record begins with @"
    k, seq, qual, n, m = at + 1, [], [], 0, 0
    while (line := ahead.get(k)) is not None and not line.text.startswith(b"+"):
        if line.text.strip(_LETTERS):
            return "a sequence has letters only"
        seq.append(line.text)
        n += len(line.text)
        k += 1
    if line is None:
        return "a sequence is followed by +"
    if line.text not in (b"+", b"+" + head.text[1:]):
        return "the + line has the record's name or none"
    k += 1
    while m < n or not qual:
        line = ahead.get(k)
        if line is None:
            if n == 0:
                break
            return "the quality is shorter than the sequence"
        if n == 0 and line.text:
            break
        qual.append(line.text)
        m += len(line.text)
        k += 1
    if m != n:
        return "the quality is longer than the sequence"
    return k - at, seq, qual


def _follows(ahead: Ahead, at: int) -> bool:
    """Do CHAIN records, or all to the file's end, begin at a line?"""
    for _ in range(CHAIN):
        found = fastq_record(ahead, at)
        if isinstance(found, str):
            return False
        at += found[0]
        if ahead.get(at) is None:
            return True
    return True


def fastq_records(source: Iterator[Line], first: bool, file: str) -> Iterator[tuple]:
    """(place, header, parts of seq, parts of qual). A record that doesn't follow the format is an error, not a loss."""
    ahead = Ahead(source)
    if not first:
        while (line := ahead.get(0)) is not None and line.where != BEHIND and not (line.text.startswith(b"@") and _follows(ahead, 0)):
            ahead.drop(1)
    while (line := ahead.get(0)) is not None and line.where != BEHIND:
        if not line.text:
            ahead.drop(1)
            continue
        found = fastq_record(ahead, 0)
        if isinstance(found, str):
            raise ValueError(f"{file}, place {line.place}: {found}")
        if line.where == INSIDE:
            yield line.place, line.text[1:].strip(), found[1], found[2]
        ahead.drop(found[0])


# --- the source ------------------------------------------------------------------------------------------------------


class SequenceReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.columns = [f.name for f in schema.fields]
        if unknown := set(self.columns) - set(KINDS):
            raise ValueError(f"no such columns: {', '.join(sorted(unknown))}")
        self.path, self.split_bytes = options["path"], int(options.get("split_bytes", 32 << 20))
        self.format = options.get("kind")

    def partitions(self) -> list[Split]:
        out = []
        for path, size in files_of(self.path):
            system, inner = _opened(path)
            with system.open_input_file(inner) as f:
                kind = compression(f.read(18))
            step = self.split_bytes if kind != "gzip" else max(size, 1)
            out += [Split(path, kind, k, min(size, k + step)) for k in range(0, size, step)]
        return out or [Split("", "plain", 0, 0)]

    def read(self, split: Split) -> Iterator[pa.RecordBatch]:
        if not split.file:
            return
        system, inner = _opened(split.file)
        whole, quals = "seq" in self.columns, "qual" in self.columns
        with system.open_input_file(inner) as f:
            fastq = self._is_fastq(f, split)
            back = LOOK_BACK if fastq else 0
            first = split.begin <= back
            source = lines(chunks(f, split, back), first)
            records = fastq_records(source, first, split.file) if fastq else fasta_records(source)
            rows, size = [], 0
            for place, header, seq, qual in records:
                n = sum(map(len, seq))
                row = {"file": split.file, "place": place, "header": header.decode("utf-8", "replace"), "n": n}
                row |= {"seq": b"".join(seq).decode("utf-8", "replace")} if whole else {}
                row |= {"qual": b"".join(qual).decode("latin-1") if qual is not None else None} if quals else {}
                rows.append(row)
                size += 100 + (n if whole else 0) + (n if quals else 0)
                if size >= BATCH_BYTES:
                    yield self._batch(rows)
                    rows, size = [], 0
            if rows:
                yield self._batch(rows)

    def _batch(self, rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], KINDS[c]) for c in self.columns], self.columns)

    def _is_fastq(self, source, split: Split) -> bool:
        """By the option ``kind`` (fasta or fastq), else by the file's first letter."""
        if self.format:
            return self.format == "fastq"
        for data, _, _ in chunks(source, Split(split.file, split.kind, 0, 1)):
            if text := data.lstrip():
                return text.startswith(b"@")
        return False


class SequenceSource(DataSource):
    """Options: path (a file, a folder or a pattern), split_bytes, kind (fasta or fastq; else each file's first letter says it)."""

    @classmethod
    def name(cls) -> str:
        return "sequences"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> SequenceReader:
        return SequenceReader(schema, self.options)
