"""WARC archives as a PySpark Python data source, read and written.

Reading plans whole files into partitions of about `splitBytes`, parses the header block of a record first and
touches its payload only if a row asks for it: filters on record_type and target_uri, and the options
`recordTypes` and `payload`, turn into skips. In plain archives a skip is a seek; in compressed ones the bytes
are inflated and dropped. Payloads are read in bounded pieces unless they are returned.

Writing gives one archive per task, each record a gzip member of its own. A task writes to a staging name and
the driver renames what succeeded, so that a lost or repeated task leaves no records behind.

Paths are URIs that pyarrow.fs opens, in storage that all executors share.

Cases: null payloads are empty; header values lose line breaks; null record ids get a random one; an archive
without records gives no rows; a cut-off record raises, or with mode=PERMISSIVE ends its file.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, StringStartsWith, WriterCommitMessage
from pyspark.sql.types import StructType

from scanloom.llm.common import fresh_path, materialise, text_of

SCHEMA = (
    "record_id string, record_type string, target_uri string, warc_date string, content_length long, "
    "payload_digest string, refers_to string, headers map<string,string>, payload binary, payload_sha1 string, file string, position long"
)
_ARROW = pa.schema(
    [
        ("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("warc_date", pa.string()),
        ("content_length", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string()), ("headers", pa.map_(pa.string(), pa.string())),
        ("payload", pa.binary()), ("payload_sha1", pa.string()), ("file", pa.string()), ("position", pa.int64()),
    ]
)
_PIECE = 1 << 20


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


class _Feed:
    """Decompressed bytes of one archive, with look-ahead of a bounded size."""

    def __init__(self, fs: pafs.FileSystem, path: str) -> None:
        self.plain = not path.endswith(".gz")
        self.file = fs.open_input_file(path) if self.plain else fs.open_input_stream(path, compression=None)
        self.inflater = zlib.decompressobj(31)
        self.held, self.raw, self.at, self.ended = bytearray(), b"", 0, False

    def _more(self) -> bool:
        if self.plain:
            piece = self.file.read(_PIECE)
            self.held += piece
            self.ended = not piece
            return bool(piece)
        while not self.ended:
            raw = self.raw or self.file.read(_PIECE)
            self.raw = b""
            if not raw:
                self.ended = True
                break
            if self.inflater.eof:
                self.inflater = zlib.decompressobj(31)
            piece = self.inflater.decompress(raw, _PIECE)
            self.raw = self.inflater.unused_data if self.inflater.eof else self.inflater.unconsumed_tail
            if piece:
                self.held += piece
                return True
        return False

    def header(self) -> bytes | None:
        """The next header block, or None at the end. Blank lines before it are passed over."""
        while True:
            blank = len(self.held) - len(self.held.lstrip(b"\r\n"))
            if blank:
                del self.held[:blank]
                self.at += blank
            if (end := self.held.find(b"\r\n\r\n")) >= 0:
                block = bytes(self.held[:end])
                del self.held[: end + 4]
                self.start, self.at = self.at, self.at + end + 4
                return block
            if not self._more():
                if self.held.strip():
                    raise EOFError("archive ends inside a header")
                return None

    def pieces(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.held and not self._more():
                raise EOFError("archive ends inside a payload")
            piece = bytes(self.held[:n])
            del self.held[: len(piece)]
            self.at += len(piece)
            n -= len(piece)
            yield piece

    def skip(self, n: int) -> None:
        if self.plain and n > len(self.held):
            self.at += n
            n -= len(self.held)
            self.held.clear()
            self.file.seek(self.file.tell() + n)
            return
        for _ in self.pieces(n):
            pass


def parse_header(block: bytes) -> dict[str, str]:
    """Header names in lower case with their values; continuation lines are joined. The version line goes."""
    out: dict[str, str] = {}
    last = ""
    first, *lines = block.decode("utf-8", "replace").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {first[:40]!r}")
    for line in lines:
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
        elif ":" in line:
            last, _, value = line.partition(":")
            last = last.strip().lower()
            out[last] = value.strip()
    return out


@dataclass
class _Files(InputPartition):
    paths: tuple[str, ...]


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]
        self.types = {x.strip() for x in options.get("recordtypes", "").split(",") if x.strip()} or None
        self.payload = options.get("payload", "true").lower() == "true"
        self.digest = options.get("digest", "false").lower() == "true"
        self.strict = options.get("mode", "FAILFAST").upper() != "PERMISSIVE"
        self.split = int(options.get("splitbytes", 128 << 20))
        self.pushdown = options.get("pushdown", "false").lower() == "true"
        self.headers = {k: set(v) for k, v in json.loads(options.get("headers", "{}")).items()}
        self.uris: set[str] | None = None
        self.prefixes: tuple[str, ...] = (options["uriprefix"],) if "uriprefix" in options else ()

    def pushFilters(self, filters):  # noqa: N802
        for f in filters:
            if not self.pushdown:
                yield f
            elif isinstance(f, EqualTo | In) and f.attribute in (("record_type",), ("target_uri",)):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                name = "types" if f.attribute == ("record_type",) else "uris"
                setattr(self, name, values & have if (have := getattr(self, name)) is not None else values)
            elif isinstance(f, StringStartsWith) and f.attribute == ("target_uri",):
                self.prefixes += (f.value,)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        fs, path = _open(self.path)
        info = fs.get_file_info(path)
        found = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(path, recursive=True))
        scheme = self.path.split("://")[0] + "://" if "://" in self.path else ""
        parts, held, size = [], [], 0
        for x in sorted(found, key=lambda x: x.path):
            if x.type != pafs.FileType.File or any(p[:1] in "._" for p in x.path[len(path) :].split("/") if p) or not x.path.endswith((".warc", ".warc.gz")):
                continue
            if held and size + x.size > self.split:
                parts.append(_Files(tuple(held)))
                held, size = [], 0
            held.append(scheme + x.path)
            size += x.size
        return [*parts, _Files(tuple(held))] if held or not parts else parts

    def _wanted(self, head: dict[str, str]) -> bool:
        uri = head.get("warc-target-uri")
        return (
            (self.types is None or head.get("warc-type") in self.types)
            and (self.uris is None or uri in self.uris)
            and all(uri is not None and uri.startswith(p) for p in self.prefixes)
            and all(head.get(name) in values for name, values in self.headers.items())
        )

    def _rows(self, path: str) -> Iterator[tuple]:
        fs, at = _open(path)
        feed = _Feed(fs, at)
        try:
            while (block := feed.header()) is not None:
                head, start = parse_header(block), feed.start
                n = int(head.get("content-length", 0))
                if not self._wanted(head):
                    feed.skip(n)
                    continue
                payload = sha = None
                if self.payload or self.digest:
                    made, kept = hashlib.sha1(), []
                    for piece in feed.pieces(n):
                        if self.digest:
                            made.update(piece)
                        if self.payload:
                            kept.append(piece)
                    payload, sha = b"".join(kept) if self.payload else None, made.hexdigest() if self.digest else None
                else:
                    feed.skip(n)
                yield (
                    head.get("warc-record-id"), head.get("warc-type"), head.get("warc-target-uri"), head.get("warc-date"), n,
                    head.get("warc-payload-digest"), head.get("warc-refers-to"), list(head.items()), payload, sha, path, start,
                )
        except (EOFError, ValueError, zlib.error):
            if self.strict:
                raise

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for path in partition.paths:
            for row in self._rows(path):
                held.append(row)
                size += 500 + len(row[8] or b"")
                if size > 8 * _PIECE:
                    yield self._batch(held)
                    held, size = [], 0
        if held:
            yield self._batch(held)

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, t.type) for c, t in zip(zip(*rows), _ARROW)], schema=_ARROW)


@dataclass
class _Written(WriterCommitMessage):
    staged: str | None
    final: str | None


class _Writer(DataSourceArrowWriter):
    """Rows of (record_id, record_type, target_uri, warc_date, payload_digest, refers_to, payload_bytes, payload)."""

    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]
        self.level = int(options.get("level", 4))
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        fs, path = _open(self.path)
        name, out = f"part-{uuid.uuid4().hex}.warc.gz", None
        staged, final = f"{path}/_staging-{self.job}/{name}", f"{path}/{name}"
        for batch in iterator:
            if out is None and batch.num_rows:
                fs.create_dir(staged.rpartition("/")[0], recursive=True)
                out = fs.open_output_stream(staged, compression=None)
            cols = [
                batch.column(n) for n in (
                    "record_id", "record_type", "target_uri", "warc_date", "payload_digest", "refers_to", "payload_bytes",
                    "payload"
                )
            ]
            for i in range(batch.num_rows):
                rid, kind, uri, date, digest, refers, n_bytes, payload = (c[i] for c in cols)
                out.write(
                    _record(
                        rid.as_py(), kind.as_py(), uri.as_py(), date.as_py(), digest.as_py(), refers.as_py(), n_bytes.as_py(),
                        payload.as_py() or b"", self.level
                    )
                )
        if out is None:
            return _Written(None, None)
        out.close()
        return _Written(staged, final)

    def commit(self, messages) -> None:
        fs, path = _open(self.path)
        fs.create_dir(path, recursive=True)
        for m in messages:
            if m is not None and m.staged:
                fs.move(m.staged, m.final)
        self._clear(fs, path)

    def abort(self, messages) -> None:
        self._clear(*_open(self.path))

    def _clear(self, fs: pafs.FileSystem, path: str) -> None:
        staging = f"{path}/_staging-{self.job}"
        if fs.get_file_info(staging).type == pafs.FileType.Directory:
            fs.delete_dir(staging)


def _record(rid, kind, uri, date, digest, refers, n_bytes, payload: bytes, level: int) -> bytes:
    fields = [
        ("WARC-Type", kind), ("WARC-Record-ID", rid or f"<urn:uuid:{uuid.uuid4()}>"),
        ("WARC-Date", date or "1970-01-01T00:00:00Z"), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", digest),
        ("WARC-Refers-To", refers)
    ]
    if kind == "revisit":
        fields.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    fields += [("X-Payload-Bytes", n_bytes), ("Content-Type", "text/html"), ("Content-Length", len(payload))]
    head = "".join(f"{k}: {' '.join(str(v).splitlines())}\r\n" for k, v in fields if v is not None)
    squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
    return squeeze.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + payload + b"\r\n\r\n") + squeeze.flush()


class WarcDataSource(DataSource):
    """spark.dataSource.register(WarcDataSource); spark.read.format("warc").load(path)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def _plain(self) -> dict[str, str]:
        return {k.lower(): v for k, v in self.options.items()}

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self._plain())

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self._plain())


def read_warc(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Records below path. Predicates that are decided on a record's header, before its payload is touched, are options: recordTypes
    (comma-separated), uriPrefix, headers (JSON of lower-case header names to lists of values). payload="false" skips
    payloads, digest="true" gives their SHA-1.

    pushdown="true" takes the same predicates from filters of the frame as well. Spark 4.1 keeps one reader for a frame, so such
    a frame must serve one query only: a second one with another filter, or a union of two, would get the first's rows."""
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").options(**options).load(path)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, a path without one being in Spark's default file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(where).toString()
    return "file://" + found[5:] if found.startswith("file:/") and not found.startswith("file://") else found


def record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), page_id.cast("string"), F.lit(">"))


def page_of(rid: Column) -> Column:
    return F.regexp_extract(rid, r"<urn:page:(-?\d+)>", 1).try_cast("long")


def archive_pages(
    pages: DataFrame, path: str, min_revisit_bytes: int = 1000, id_col: str = "page_id", url_col: str = "url",
    html_col: str = "html"
) -> None:
    """Write one record per page. Of pages with the same payload of at least `min_revisit_bytes`, that with the
    largest id is the response and the others are revisits without a payload. A page without id, and repeats of
    the response's own id, are responses.

    Only (digest, largest id) of payloads that do occur twice are joined back, so that payloads are shuffled
    only where that table is too large for Spark to broadcast; a payload that very many pages share is one row
    of it."""
    pages.sparkSession.dataSource.register(WarcDataSource)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("uri"), F.encode(text_of(html_col), "UTF-8").alias("payload"))
    rows = rows.withColumns({"sha1": F.sha1("payload"), "payload_bytes": F.octet_length("payload").cast("long")})
    shared = rows.filter(F.col("payload_bytes") >= min_revisit_bytes).groupBy("sha1", "payload_bytes").agg(
        F.max("id").alias("first"), F.count("*").alias("n")
    )
    shared = materialise(shared.filter("n > 1 AND first IS NOT NULL").drop("n"), "warc-shared")
    again = F.col("first").isNotNull() & F.col("id").isNotNull() & (F.col("id") < F.col("first"))
    (
        rows.join(shared, ["sha1", "payload_bytes"], "left")
        .select(
            record_id(F.col("id")).alias("record_id"),
            F.when(again, "revisit").otherwise("response").alias("record_type"),
            F.col("uri").alias("target_uri"),
            F.lit("1970-01-01T00:00:00Z").alias("warc_date"),
            F.concat(F.lit("sha1:"), "sha1").alias("payload_digest"),
            F.when(again, record_id(F.col("first"))).alias("refers_to"),
            "payload_bytes",
            F.when(~again, F.col("payload")).alias("payload"),
        )
        .write.format("warc").mode("append").option("path", path).save()
    )


def archived_pages(pages: DataFrame) -> DataFrame:
    """Write the pages to archives in the shared folder and read the archives back: per record page_id,
    payload_bytes, payload_digest, record_type, refers_to. Of responses length and digest are those of the bytes
    in the archive, of revisits those that the header states of the payload left out."""
    spark = pages.sparkSession
    path = qualified(spark, fresh_path(spark, "warc"))
    archive_pages(pages, path)
    got = read_warc(spark, path, payload="false", digest="true")
    response = F.col("record_type") == "response"
    return got.select(
        page_of(F.col("record_id")).alias("page_id"),
        F.when(response, F.col("content_length")).otherwise(F.col("headers")["x-payload-bytes"].cast("long")).alias("payload_bytes"),
        F.when(response, F.col("payload_sha1")).otherwise(F.regexp_replace("payload_digest", "^sha1:", "")).alias("payload_digest"),
        "record_type",
        page_of(F.col("refers_to")).alias("refers_to"),
    )
