"""Block-compressed text (gzip members of at most 64 KB, each with its own size in its header) as a data source that many
tasks read and write, and headers of files read up to where they end."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import reduce
from typing import BinaryIO, NamedTuple

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from .records import read_lines

#: Fixed values of the format: how a member begins (gzip, deflate, with extra fields), the subfield that holds its size less
#: one, bytes of text in a member at most, and the empty member at the end of a file.
MAGIC, SUBFIELD, TEXT = b"\x1f\x8b\x08\x04", b"BC\x02\x00", 0xFF00
END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
#: Bytes of a file that a task takes.
SPLIT = 64 << 20


class Block(NamedTuple):
    at: int
    size: int


def _open(path: str) -> BinaryIO:
    """A file by path or URI, of any store that Arrow knows; seekable."""
    fs, inner = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)
    return fs.open_input_file(inner)


def block_at(head: bytes, at: int) -> Block | None:
    """The member whose first bytes are given, if they begin one that names its size."""
    if len(head) < 18 or head[:4] != MAGIC:
        return None
    extra, i = struct.unpack("<H", head[10:12])[0], 12
    while i + 4 <= min(12 + extra, len(head)):
        size = struct.unpack("<H", head[i + 2 : i + 4])[0]
        if head[i : i + 4] == SUBFIELD and i + 6 <= len(head):
            return Block(at, struct.unpack("<H", head[i + 4 : i + 6])[0] + 1)
        i += 4 + size
    return None


def blocks(source: BinaryIO, at: int) -> Iterator[Block]:
    """Members from a place where one begins on, to the end of the file."""
    while True:
        source.seek(at)
        head = source.read(256)
        if not head:
            return
        found = block_at(head, at)
        if found is None:
            raise ValueError(f"no block at byte {at}")
        yield found
        at += found.size


def first_block(source: BinaryIO, at: int, length: int) -> int:
    """Where the first member at or after a byte begins: its header is there and so is that of the next one, or the end."""
    while at < length:
        source.seek(at)
        window = source.read(1 << 17)
        i = window.find(MAGIC)
        while i >= 0:
            source.seek(at + i)
            found = block_at(source.read(256), at + i)
            if found:
                after = at + i + found.size
                source.seek(after)
                if after == length or block_at(source.read(256), after):
                    return at + i
            i = window.find(MAGIC, i + 1)
        at += max(1, len(window) - len(MAGIC))
    return length


def unpacked(source: BinaryIO, block: Block) -> bytes:
    source.seek(block.at)
    return zlib.decompress(source.read(block.size), 31)


def lines_between(source: BinaryIO, begin: int, end: int, length: int) -> Iterator[tuple[int, int, bytes]]:
    """(block, number within it, line) of lines that begin in members of a range of bytes; the first line of a range is
    the one after its first line end, so that each range reads on to the end of the line that the next one leaves out."""
    held, skip, place = b"", begin > 0, (0, 0)
    start = first_block(source, begin, length) if begin else 0
    if start >= end:
        return
    for block in blocks(source, start):
        if skip and block.at >= end:
            return
        text, number = unpacked(source, block), 0
        at = 0
        while (stop := text.find(b"\n", at)) >= 0:
            if not held:
                place = (block.at, number)
            if skip:
                skip = False
            else:
                yield *place, held + text[at:stop]
                if block.at >= end:
                    return
            held, at, number = b"", stop + 1, number + 1
        if at < len(text):
            if not held:
                place = (block.at, number)
            held = b"" if skip else held + text[at:]
    if held and not skip:
        yield *place, held


class _Range(InputPartition):
    def __init__(self, path: str, begin: int, end: int, length: int):
        self.path, self.begin, self.end, self.length = path, begin, end, length


class _Reader(DataSourceReader):
    def __init__(self, files: list[tuple[str, int]], split: int):
        self.files, self.split = files, split

    def partitions(self):
        return [_Range(p, b, min(b + self.split, n), n) for p, n in self.files for b in range(0, n, self.split)] or [_Range("", 0, 0, 0)]

    def read(self, partition):
        if partition.path:
            with _open(partition.path) as source:
                for block, number, line in lines_between(source, partition.begin, partition.end, partition.length):
                    yield partition.path, (block, number), line.rstrip(b"\r").decode("utf-8", "replace")


class _Written(WriterCommitMessage):
    def __init__(self, staged: str, final: str):
        self.staged, self.final = staged, final


def packed(text: bytes) -> bytes:
    """One member."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(text) + deflate.flush()
    head = MAGIC + struct.pack("<IBBH", 0, 0, 255, 6) + SUBFIELD + struct.pack("<H", len(body) + 25)
    return head + body + struct.pack("<II", zlib.crc32(text), len(text))


class _Writer(DataSourceWriter):
    def __init__(self, path: str, size: int):
        self.path, self.size = path, size

    def write(self, iterator):
        fs, inner = pafs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (pafs.LocalFileSystem(), self.path)
        fs.create_dir(inner, recursive=True)
        name = f"part-{uuid.uuid4().hex}.gz"
        held = b""
        with fs.open_output_stream(f"{inner}/_{name}", compression=None) as out:
            for row in iterator:
                held += row[0].encode() + b"\n"
                while len(held) >= self.size:
                    out.write(packed(held[: self.size]))
                    held = held[self.size :]
            out.write(packed(held) + END if held else END)
        return _Written(f"{inner}/_{name}", f"{inner}/{name}")

    def _fs(self):
        return pafs.FileSystem.from_uri(self.path)[0] if "://" in self.path or self.path.startswith("file:") else pafs.LocalFileSystem()

    def commit(self, messages):
        for m in messages:
            if m:
                self._fs().move(m.staged, m.final)

    def abort(self, messages):
        for m in messages:
            if m:
                self._fs().delete_file(m.staged)


class BlockText(DataSource):
    """Format blocks: rows (file, seq, value) of lines; seq (block, line) rises with them. Options: files (paths, a line
    each, with their lengths after a tab), split (bytes of a task). Writes a column of lines; block is the bytes of text in
    a member. Tasks write beside and rename at the end."""

    @classmethod
    def name(cls):
        return "blocks"

    def schema(self):
        return "file string, seq struct<block: bigint, line: bigint>, value string"

    def reader(self, schema):
        files = [(p, int(n)) for p, n in (x.rsplit("\t", 1) for x in self.options["files"].split("\n") if x)]
        return _Reader(files, int(self.options.get("split", SPLIT)))

    def writer(self, schema, overwrite):
        return _Writer(self.options["path"], int(self.options.get("block", TEXT)))


def _listed(spark: SparkSession, path: str | list[str]) -> list[tuple[str, int]]:
    """Files and their lengths, by Spark's own listing; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    return sorted((r["path"], r["length"]) for r in files.collect())


def read_blocks(spark: SparkSession, path: str | list[str], split: int = SPLIT) -> DataFrame:
    """(file, seq, value) of block-compressed files, as records.read_lines() gives it, but a file is read by as many tasks
    as it has ranges of split bytes. Files of other gzip members than blocks are refused when they are read."""
    spark.dataSource.register(BlockText)
    files = "\n".join(f"{p}\t{n}" for p, n in _listed(spark, path))
    return spark.read.format("blocks").option("files", files).option("split", split).load()


def _are_blocks(batches):
    for batch in batches:
        found = []
        for path in batch.column("path").to_pylist():
            with _open(path) as source:
                found.append(block_at(source.read(256), 0) is not None)
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(found, pa.bool_())], ["path", "blocks"])


def read_text(spark: SparkSession, path: str | list[str], split: int = SPLIT) -> DataFrame:
    """(file, seq, value) of plain, gzip and block-compressed files alike: those of blocks by ranges, others as
    records.read_lines() does. How compressed files begin is looked at in tasks."""
    spark.dataSource.register(BlockText)
    files = _listed(spark, path)
    packed_ = [(p,) for p, n in files if p.endswith(".gz") and n]
    kinds = spark.createDataFrame(packed_, "path string").mapInArrow(_are_blocks, "path string, blocks boolean").where("blocks").collect() if packed_ else []
    blocked = {r["path"] for r in kinds}
    parts = [read_lines(spark, others)] if (others := [p for p, _ in files if p not in blocked]) else []
    if blocked or not parts:
        listed = "\n".join(f"{p}\t{n}" for p, n in files if p in blocked)
        parts.append(spark.read.format("blocks").option("files", listed).option("split", split).load())
    return reduce(DataFrame.union, parts)


def write_blocks(lines: DataFrame, path: str, size: int = TEXT) -> None:
    """A block-compressed file for each partition of lines (one column of text)."""
    if not 0 < size <= TEXT:
        raise ValueError(f"a block holds 1 to {TEXT} bytes of text")
    lines.sparkSession.dataSource.register(BlockText)
    lines.write.format("blocks").option("path", path).option("block", size).mode("append").save()


def header_lines(source: BinaryIO, size: int = 1 << 16) -> Iterator[str]:
    """Lines of plain or gzip text from the first on, as long as they begin with ##. Reads on by size bytes only while
    these last."""
    head = source.read(size)
    inflate, held = zlib.decompressobj(31) if head[:2] == MAGIC[:2] else None, b""
    while head:
        while head:
            held += inflate.decompress(head) if inflate else head
            head = inflate.unused_data if inflate and inflate.eof else b""
            if head:
                inflate = zlib.decompressobj(31)
        *whole, held = held.split(b"\n")
        for line in whole:
            if not line.startswith(b"##"):
                return
            yield line.rstrip(b"\r").decode("utf-8", "replace")
        if held and not b"##".startswith(held[:2]):
            return
        head = source.read(size)
    if held.startswith(b"##"):
        yield held.rstrip(b"\r").decode("utf-8", "replace")


class _HeaderReader(DataSourceReader):
    def __init__(self, files: list[tuple[str, int]]):
        self.files = files

    def partitions(self):
        return [_Range(p, 0, n, n) for p, n in self.files] or [_Range("", 0, 0, 0)]

    def read(self, partition):
        if partition.path and partition.length:
            with _open(partition.path) as source:
                for i, line in enumerate(header_lines(source)):
                    yield partition.path, (0, i), line


class HeaderText(BlockText):
    """Format headers: lines of the headers of files, a task for each file."""

    @classmethod
    def name(cls):
        return "headers"

    def reader(self, schema):
        return _HeaderReader([(p, int(n)) for p, n in (x.rsplit("\t", 1) for x in self.options["files"].split("\n") if x)])


def read_headers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, seq, value) of the lines before the first that doesn't begin with ##, of each file. What follows is neither
    read nor looked at."""
    spark.dataSource.register(HeaderText)
    return spark.read.format("headers").option("files", "\n".join(f"{p}\t{n}" for p, n in _listed(spark, path))).load().select("file", F.col("seq"), "value")
