"""WARC records as a Python data source, and the predicates that keep web pages."""

from __future__ import annotations

import base64
import gzip
import io

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "url string, kind string, status int, content_type string, date string, html string, charset string"


def keep_pages(kind: Column, content_type: Column, status: Column) -> Column:
    """Responses with HTML and a status below 400."""
    return (kind == "response") & F.lower(content_type).contains("html") & (status < 400)


def decode(body: bytes, charset: str | None) -> tuple[str, str]:
    """By the named charset, then UTF-8, then GB18030; base64 if none fits."""
    names = [charset] if charset else []
    for name in [*("gb18030" if n.lower() in ("gbk", "gb2312") else n for n in names), "utf-8", "gb18030"]:
        try:
            return body.decode(name), name
        except (LookupError, UnicodeDecodeError):
            continue
    return base64.b64encode(body).decode(), "base64"


def records(data: bytes):
    """(WARC headers, body) of each record; compressed archives are opened member by member, never as a whole."""
    stream = io.BytesIO(data)
    if data[:2] == b"\x1f\x8b":
        stream = io.BufferedReader(gzip.GzipFile(fileobj=stream))
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        headers = {}
        while (line := stream.readline().strip()):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.lower()] = value.strip()
        yield headers, stream.read(int(headers.get("content-length", 0)))


def parse(data: bytes):
    for headers, body in records(data):
        status, kind_of, charset, page = None, "", None, body
        if headers.get("warc-type") == "response":
            head, _, page = body.partition(b"\r\n\r\n")
            lines = head.decode("latin-1").split("\r\n")
            status = int(lines[0].split(" ")[1]) if len(lines[0].split(" ")) > 1 and lines[0].split(" ")[1].isdigit() else None
            http = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
            kind_of = headers.get("warc-identified-payload-type") or http.get("content-type", "")
            charset = http.get("content-type", "").partition("charset=")[2].strip(" ;\"'") or None
        html, used = decode(page, charset)
        yield headers.get("warc-target-uri"), headers.get("warc-type"), status, kind_of, headers.get("warc-date"), html, used


class WarcSource(DataSource):
    """``spark.dataSource.register(WarcSource)`` then ``spark.read.format("warc").load(paths)``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> "WarcReader":
        return WarcReader(self.options["path"])


class WarcReader(DataSourceReader):
    def __init__(self, path: str):
        self.paths = path.split(",")

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.paths]

    def read(self, partition: InputPartition):
        with open(partition.value.removeprefix("file://"), "rb") as f:
            yield from parse(f.read())


def read_warc(spark, path: str):
    """WARC files on any file system that Spark reads: bytes by ``binaryFile``, records by Arrow batches."""
    import pyarrow as pa

    names = [x.split()[0] for x in SCHEMA.split(", ")]
    types = [pa.string(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string()]

    def run(batches):
        for b in batches:
            for content in b.column("content"):
                rows, held = [], 0
                for row in parse(content.as_py()):
                    rows.append(row)
                    held += len(row[5])
                    if held > 16 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names=names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names=names)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, SCHEMA)
