"""WARC derivatives: linked metadata and plain-text conversion records of responses.

Each response record yields a ``metadata`` record (JSON: the source's WARC headers,
HTTP status and headers, digests, title, links) and a ``conversion`` record (the page's
text). Both name the response in WARC-Refers-To, keep its target URI and date, and carry
block digests of their own; the metadata record names the conversion as concurrent.
Identifiers are name-based on the response's identifier and the derivative's kind, so a
task that runs again writes the same records. Row by row work: nothing is shuffled.

Defined results: null and empty bodies give an empty conversion; a null URL gives records
without a target URI. Damaged records (no WARC or HTTP head) give one metadata record with
``error`` and no conversion. Repeated rows give repeated records with equal identifiers.
Payload text that isn't UTF-8 is read as declared, else with replacement characters.
``key`` is one column or several, which pass through; other columns don't. Empty tables
give empty results.

Files are a data source of their own: ``write_warc`` gives each record a gzip member, as
the format asks for, and names files when the job commits, so a task that runs again
leaves nothing behind; ``read_warc`` reads record after record, so a task holds one record
and one Arrow batch, however large the file is.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import json
import re
import uuid
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from quarrystone.llm._base import SLICE_BYTES, table, text_slices

NAMESPACE = uuid.UUID("6f1c1f2e-7f43-5d0b-9a55-3a8f6c1d2b10")
DATE = "2000-01-01T00:00:00Z"
#: Bytes of a record's head at most, when files are read.
MAX_HEAD = 1 << 20
_DROP = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|title)\b[^>]*>.*?(?:</\1\s*>|\Z)", re.S | re.I)
_BLOCK = re.compile(r"</?(?:p|div|br|li|ul|ol|h[1-6]|tr|table|section|article|header|footer|nav|blockquote|pre|hr|dd|dt|title)\b[^>]*>", re.I)
_TAG = re.compile(r"<[/!?a-zA-Z][^>]*>")
_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)
_LINK = re.compile(r"""<a\b[^>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_BLANKS = re.compile(r"[ \t\r\f\v]+")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*names: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, json.dumps([str(n) for n in names]))}>"


def build_record(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """A record without the two line ends that close it; headers without a value are left out."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers if v is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def build_response(url: str | None, body: str | None, *key: object) -> bytes:
    """A response record for a page that was stored without its headers."""
    payload = (body or "").encode()
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + payload
    head = [
        ("WARC-Type", "response"), ("WARC-Record-ID", record_id("response", *key, url, digest(payload))), ("WARC-Date", DATE), ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", digest(payload)), ("WARC-Block-Digest", digest(block)), ("Content-Type", "application/http; msgtype=response"),
    ]
    return build_record(head, block)


def parse_head(data: bytes) -> tuple[str, list[tuple[str, str]], bytes] | None:
    """First line, headers in order, and what follows; None if there's no head."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    if not gap:
        return None
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    headers: list[tuple[str, str]] = []
    for line in lines:
        if line[:1] in " \t" and headers:
            headers[-1] = (headers[-1][0], f"{headers[-1][1]} {line.strip()}")
        elif ":" in line:
            name, _, value = line.partition(":")
            headers.append((name.strip(), value.strip()))
    return first, headers, rest


def _get(headers: list[tuple[str, str]], name: str) -> str | None:
    return next((v for k, v in headers if k.lower() == name.lower()), None)


def decode_payload(headers: list[tuple[str, str]], data: bytes) -> bytes:
    """Undo chunked transfer and gzip or deflate coding; data that doesn't follow its header stays."""
    if "chunked" in (_get(headers, "Transfer-Encoding") or "").lower():
        out, rest = [], data
        while True:
            size, gap, rest = rest.partition(b"\r\n")
            try:
                n = int(size.split(b";")[0], 16)
            except ValueError:
                break
            if not gap or not n:
                data = b"".join(out)
                break
            out.append(rest[:n])
            rest = rest[n + 2 :]
    coding = (_get(headers, "Content-Encoding") or "").lower()
    try:
        return gzip.decompress(data) if coding in ("gzip", "x-gzip") else zlib.decompress(data) if coding == "deflate" else data
    except (OSError, EOFError, zlib.error):
        return data


def plain_text(page: str) -> str:
    """The page's text: one line for each block, blanks collapsed, empty lines left out."""
    page = _BLOCK.sub("\n", _DROP.sub(" ", page).replace("\n", " "))
    page = html.unescape(_TAG.sub("", page))
    return "\n".join(x for line in page.split("\n") if (x := _BLANKS.sub(" ", line.replace("\xa0", " ")).strip()))


def derive(response: bytes | None) -> list[dict]:
    """The derivative records of one response record, as rows."""
    parsed = parse_head(response or b"")
    if parsed is None or not parsed[0].startswith("WARC/"):
        source, headers, block = digest(response or b""), [], response or b""
        parsed_http, error = None, "no WARC head"
    else:
        _, headers, block = parsed
        length = _get(headers, "Content-Length")
        block = block[: int(length)] if length and length.isdigit() else block
        source = _get(headers, "WARC-Record-ID") or digest(response)
        parsed_http = parse_head(block)
        error = None if parsed_http and parsed_http[0].startswith("HTTP/") else "no HTTP head"
    uri, date = _get(headers, "WARC-Target-URI"), _get(headers, "WARC-Date") or DATE
    meta_id, text_id = record_id("metadata", source), record_id("conversion", source)
    body: dict = {"Source": {"WARC-Headers": headers, "Block-Digest": digest(block), "Block-Length": len(block)}}
    text = None
    if error:
        body["error"] = error
    else:
        status, http, raw = parsed_http
        payload = decode_payload(http, raw)
        charset = re.search(r"charset=[\"']?([\w.:-]+)", _get(http, "Content-Type") or "", re.I)
        try:
            page = payload.decode(charset[1] if charset else "utf-8", "replace")
        except LookupError:
            page = payload.decode("utf-8", "replace")
        text = plain_text(page)
        title = _TITLE.search(page)
        links = [html.unescape(next(x for x in m if x) if any(m) else "") for m in _LINK.findall(page)]
        body |= {
            "HTTP": {"Status": status, "Headers": http}, "Payload": {"Digest": digest(raw), "Declared-Digest": _get(headers, "WARC-Payload-Digest"), "Length": len(raw)},
            "HTML": {"Title": html.unescape(title[1]).strip() if title else None, "Links": links},
        }
    rows = []
    for kind, own, other, content_type, data in (
        ("metadata", meta_id, text_id if text is not None else None, "application/json", json.dumps(body, ensure_ascii=False).encode()),
        ("conversion", text_id, meta_id, "text/plain", None if text is None else text.encode()),
    ):
        if data is not None:
            head = [
                ("WARC-Type", kind), ("WARC-Record-ID", own), ("WARC-Date", date), ("WARC-Target-URI", uri), ("WARC-Refers-To", source),
                ("WARC-Concurrent-To", other), ("WARC-Block-Digest", digest(data)), ("Content-Type", content_type),
            ]
            rows.append({"warc_type": kind, "record_id": own, "refers_to": source, "concurrent_to": other, "target_uri": uri, "block_digest": digest(data), "content_length": len(data), "source_payload_digest": _get(headers, "WARC-Payload-Digest"), "record": build_record(head, data)})
    return rows


_FIELDS = pa.schema([(n, pa.int64() if n == "content_length" else pa.binary() if n == "record" else pa.string()) for n in ("warc_type", "record_id", "refers_to", "concurrent_to", "target_uri", "block_digest", "content_length", "source_payload_digest", "record")])
_TYPES = StructType([StructField(f.name, LongType() if f.type == pa.int64() else BinaryType() if f.type == pa.binary() else StringType()) for f in _FIELDS])


def _keys(df: DataFrame, key: str | list[str]) -> tuple[list[str], list]:
    names = [key] if isinstance(key, str) else list(key)
    clash = {n.lower() for n in names} & {"response", *_FIELDS.names}
    if clash:
        raise ValueError(f"key columns are named like outputs: {sorted(clash)}")
    return names, [df.schema[n] for n in names]


def responses(pages: DataFrame, key: str | list[str] = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """The key columns and ``response``, a WARC response record for each stored page."""
    names, fields = _keys(pages, key)
    url_at, body_at = len(names), len(names) + 1

    def run(batches):
        for whole in batches:
            for b in text_slices([whole], "body"):
                ids = zip(*(b.column(i).to_pylist() for i in range(len(names))))
                rows = [build_response(u, x, *k) for k, u, x in zip(ids, b.column(url_at).to_pylist(), b.column(body_at).to_pylist())]
                yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(names))), pa.array(rows, pa.binary())], names=[*names, "response"])

    found = pages.select(*(F.col(n).alias(f"key{i}") for i, n in enumerate(names)), F.col(url).alias("url"), F.col(body).alias("body"))
    return found.mapInArrow(run, StructType([*fields]).add("response", "binary"))


def derivatives(df: DataFrame, key: str | list[str] = "page_id", response: str = "response") -> DataFrame:
    """The key columns with one row for each derivative record: its fields and the record itself."""
    names, fields = _keys(df, key)

    def run(batches):
        for whole in batches:
            for b in text_slices([whole], "response"):
                at, cols = [], {n: [] for n in _FIELDS.names}
                for i, r in enumerate(b.column("response").to_pylist()):
                    for row in derive(r):
                        at.append(i)
                        for n in cols:
                            cols[n].append(row[n])
                keys = [b.column(i).take(pa.array(at, pa.int64())) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays([*keys, *(pa.array(cols[f.name], f.type) for f in _FIELDS)], names=[*names, *_FIELDS.names])

    found = df.select(*(F.col(n).alias(f"key{i}") for i, n in enumerate(names)), F.col(response).cast("binary").alias("response"))
    return found.mapInArrow(run, StructType([*fields, *_TYPES.fields]))


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    """Of a folder that all executors share: a URI, or a path of mounted storage."""
    return fs.FileSystem.from_uri(path) if re.match(r"[a-z][a-z0-9+.-]*://|file:", path) else (fs.LocalFileSystem(), path)


def read_records(stream):
    """The records of an open WARC file, plain or gzipped, one by one and without their closing line ends.

    What is held is the record and a megabyte: gzip members go through a decoder of a bounded output, and a
    search for the end of a head goes on where the last one stopped. A head of more than MAX_HEAD bytes, a
    damaged member or a record that the file cuts short is an error that names the place in the data.
    """
    unzip, packed, held, searched, passed, size = None, b"", bytearray(), 0, 0, 1 << 20

    def more() -> bool:
        """Up to a megabyte more of the data, or false at its end; several gzip members follow one another."""
        nonlocal unzip, packed
        while True:
            packed = packed or stream.read(size)
            if unzip is None:
                unzip = zlib.decompressobj(31) if packed[:2] == b"\x1f\x8b" else False
            if not unzip:
                held.extend(packed)
                found, packed = bool(packed), b""
                return found
            if unzip.eof and packed:
                unzip = zlib.decompressobj(31)
            if not packed:
                if not unzip.eof:
                    raise ValueError(f"the gzip member ends early after {passed + len(held)} bytes")
                return False
            try:
                made = unzip.decompress(packed, size)
            except zlib.error as e:
                raise ValueError(f"damaged gzip member after {passed + len(held)} bytes: {e}") from e
            packed = unzip.unconsumed_tail or unzip.unused_data
            if made:
                held.extend(made)
                return True

    while True:
        while (end := held.find(b"\r\n\r\n", searched)) < 0:
            searched = max(0, len(held) - 3)
            if searched > MAX_HEAD:
                raise ValueError(f"no end of a head within {MAX_HEAD} bytes from {passed} on")
            if not more():
                break
        if end < 0:
            if held.strip():
                raise ValueError(f"a head without an end from {passed} on")
            return
        n = re.search(rb"(?i)\r\ncontent-length:[ \t]*(\d+)", bytes(held[:end]))
        stop = end + 4 + (int(n[1]) if n else 0)
        while len(held) < stop + 4 and more():
            pass
        if len(held) < stop:
            raise ValueError(f"the record from {passed} on is cut short")
        yield bytes(held[:stop])
        passed += min(stop + 4, len(held))
        del held[: stop + 4]
        searched = 0


class WarcFile(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)


class WarcReader(DataSourceReader):
    """A partition for each file, since gzip can't be entered in the middle."""

    def __init__(self, path: str):
        self.path = path

    def partitions(self):
        system, at = _file_system(self.path)
        found = system.get_file_info(at)
        files = [found] if found.is_file else system.get_file_info(fs.FileSelector(at, recursive=True))
        return [WarcFile(f.path) for f in files if f.is_file and not f.base_name.startswith(("_", "."))]

    def read(self, partition):
        system, _ = _file_system(self.path)
        with system.open_input_stream(partition.value, compression=None) as stream:
            rows, held = [], 0
            for record in read_records(stream):
                rows.append(record)
                held += len(record)
                if held > SLICE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["record"])
                    rows, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["record"])


@dataclass
class Written(WriterCommitMessage):
    name: str


class WarcWriter(DataSourceArrowWriter):
    """A file for each partition, one gzip member for each record; files get their names on commit."""

    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite, self.job = path, overwrite, uuid.uuid4().hex

    def write(self, batches):
        from pyspark import TaskContext

        task = TaskContext.get()
        system, at = _file_system(self.path)
        system.create_dir(f"{at}/_{self.job}", recursive=True)
        name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}.warc.gz"
        with system.open_output_stream(f"{at}/_{self.job}/{name}", compression=None) as out:
            for b in batches:
                for i in range(b.num_rows):
                    out.write(gzip.compress(b.column(0)[i].as_py() + b"\r\n\r\n", 6, mtime=0))
        return Written(name)

    def commit(self, messages):
        system, at = _file_system(self.path)
        old = [f.path for f in system.get_file_info(fs.FileSelector(at, allow_not_found=True)) if f.is_file] if self.overwrite else []
        for m in messages:
            if m is not None:
                system.move(f"{at}/_{self.job}/{m.name}", f"{at}/{m.name}")
        for path in old:
            system.delete_file(path)
        self.abort(messages)

    def abort(self, messages):
        system, at = _file_system(self.path)
        if system.get_file_info(f"{at}/_{self.job}").type != fs.FileType.NotFound:
            system.delete_dir(f"{at}/_{self.job}")


class WarcSource(DataSource):
    """``spark.read.format("warc")`` and ``df.write.format("warc")``: one binary column, record."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return "record binary"

    def reader(self, schema):
        return WarcReader(self.options["path"])

    def writer(self, schema, overwrite):
        return WarcWriter(self.options["path"], overwrite)


def write_warc(records: DataFrame, path: str) -> None:
    """Append the records as WARC files to a folder, one file for each partition."""
    records.sparkSession.dataSource.register(WarcSource)
    records.select(F.col("record").cast("binary").alias("record")).write.format("warc").mode("append").save(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``record`` rows of the WARC files in a folder, or of one file."""
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").load(path)


def query(spark, sf_dir: str) -> DataFrame:
    found = derivatives(responses(table(spark, sf_dir, "pages")))
    return found.withColumn("record_sha256", F.sha2("record", 256)).drop("record")
