"""Python data sources that read the beginning of CSV files: headers and leading rows.

Every file is one input partition, planned from the listing alone.  A partition is read a block
at a time and only until the header ends, or the cap is reached, so the bytes read follow what
is asked and not the file.  Files are opened in the tasks: local paths directly, others
through pyarrow's file systems; :func:`reachable` tells whether that works for a path.
"""

from __future__ import annotations

import csv
import io
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

BLOCK = 64 * 1024                # bytes read at once
LONGEST_RECORD = 64 * 1024 * 1024   # an unclosed quote would otherwise take the rest of a file
BOM = b"\xef\xbb\xbf"
QUOTE, LF = b'"', b"\n"


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


def open_file(path: str):
    """A binary file by its URI; a path without a scheme is local."""
    if path.startswith("file:"):
        return open("/" + path[5:].lstrip("/"), "rb")
    if "://" not in path:
        return open(path, "rb")
    from pyarrow import fs
    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_stream(inner)


def reachable(path: str) -> bool:
    """Whether tasks can open a path without Spark (a viewfs path, say, only Spark can read)."""
    if path.startswith("file:") or "://" not in path:
        return True
    from pyarrow import fs
    try:
        fs.FileSystem.from_uri(path)
    except Exception:                            # an unknown scheme, or its library is missing
        return False
    return True


class Blocks:
    """The bytes of an open file, without a byte-order mark; ``read`` counts those taken."""

    def __init__(self, f, size: int = BLOCK):
        self.f, self.size, self.read = f, size, 0

    def __iter__(self):
        while b := self.f.read(self.size):
            first = self.read == 0
            self.read += len(b)
            yield b[len(BOM):] if first and b.startswith(BOM) else b


def raw_records(stream):
    """Whole records (bytes) of consecutive blocks: a line break inside quotes ends none, a doubled
    quote inside quotes closes and opens them."""
    held, start, at, inside = b"", 0, 0, False
    for b in stream:
        held, at, start = held[start:] + b, at - start, 0
        if len(held) > LONGEST_RECORD + len(b):
            raise ValueError(f"a record of more than {LONGEST_RECORD} bytes: is a quote not closed?")
        while True:
            if inside:
                q = held.find(QUOTE, at)
                if q < 0:
                    at = len(held)
                    break
                inside, at = False, q + 1
                continue
            n = held.find(LF, at)
            q = held.find(QUOTE, at, n if n >= 0 else len(held))
            if q >= 0:
                inside, at = True, q + 1
            elif n >= 0:
                yield held[start:n]
                start = at = n + 1
            else:
                at = len(held)
                break
    if len(held) > start:
        yield held[start:]


def fields(record: bytes) -> list[str]:
    """The fields of one record: quotes around a field go, a doubled quote inside is one."""
    text = record.decode("utf-8", "replace").removesuffix("\r")
    return next(csv.reader(io.StringIO(text, newline="")), [])


def blank(record: bytes) -> bool:
    return not record.strip(b"\r")


def fitted(row: list[str], width: int) -> list | None:
    """A record's fields as ``width`` columns: missing and empty ones null; None where a surplus field
    holds something."""
    if any(row[width:]):
        return None
    return [x if x != "" else None for x in row[:width]] + [None] * (width - len(row))


class HeadsSource(DataSource):
    """``path, header, bytes_read``: the fields of the first record of every file (null without one)."""

    @classmethod
    def name(cls):
        return "netsieve_heads"

    def schema(self):
        return "path string, header array<string>, bytes_read long"

    def reader(self, schema):
        return _Heads(json.loads(self.options["files"]))


class _Heads(DataSourceReader):
    def __init__(self, files):
        self.files = files

    def partitions(self):
        return [_File(p) for p in self.files]

    def read(self, part):
        with open_file(part.path) as f:
            stream = Blocks(f)
            head = next((r for r in raw_records(stream) if not blank(r)), None)
            yield part.path, None if head is None else fields(head), stream.read


class LeadingSource(DataSource):
    """``path, line, bytes_read, _c0 ...``: the first ``cap`` records of every file (behind its
    header with ``header``), ``line`` from 0.  Blank lines and records with more than ``width``
    fields are skipped and do not count, as in a scan."""

    @classmethod
    def name(cls):
        return "netsieve_leading"

    def schema(self):
        return "path string, line long, bytes_read long, " + ", ".join(f"_c{i} string" for i in range(int(self.options["width"])))

    def reader(self, schema):
        return _Leading(json.loads(self.options["files"]), int(self.options["width"]), int(self.options["cap"]), self.options["header"] == "true")


class _Leading(DataSourceReader):
    def __init__(self, files, width, cap, header):
        self.files, self.width, self.cap, self.header = files, width, cap, header

    def partitions(self):
        return [_File(p) for p in self.files] if self.cap > 0 else []

    def read(self, part):
        if part is None:                         # a cap of 0: nothing was planned
            return
        n, skip = 0, self.header
        with open_file(part.path) as f:
            stream = Blocks(f)
            for r in raw_records(stream):
                if blank(r):
                    continue
                if skip:
                    skip = False
                    continue
                row = fitted(fields(r), self.width)
                if row is not None:
                    yield (part.path, n, stream.read, *row)
                    n += 1
                    if n == self.cap:
                        return


def reader(spark: SparkSession, source: type[DataSource], files, **options) -> DataFrame:
    """A frame of one of the sources above over ``files``."""
    spark.dataSource.register(source)
    r = spark.read.format(source.name()).option("files", json.dumps(list(files)))
    for k, v in options.items():
        r = r.option(k, str(v).lower())
    return r.load()
