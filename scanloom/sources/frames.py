"""PNG files of frames and renders, written and read by tasks.

Writing: pixels of a file meet in bands of rows, each of which is deflated by a task of its own; a file's bands are joined without
inflating them again, as a deflate stream may end at a byte and its checksum follows from the bands'. Whole files are written under
another name and get their own when the job commits, so that a failed job leaves none. Reading: 8-bit grey and colour, not
interlaced; other files are rows that aren't ok."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from scanloom.shared import materialise

MAGIC = b"\x89PNG\r\n\x1a\n"
BAND_ROWS = 64
#: Colour type of the file format to channels. Fixed values.
CHANNELS = {0: 1, 2: 3, 4: 2, 6: 4}
ADLER = 65521


def chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def deflated(rows: np.ndarray) -> tuple[bytes, int, int]:
    """(deflate blocks that end at a byte, Adler-32, length) of rows (h, w, 3) in red, green, blue, each after its filter byte."""
    raw = np.concatenate((np.zeros((len(rows), 1), np.uint8), rows.reshape(len(rows), -1)), axis=1).tobytes()
    press = zlib.compressobj(6, zlib.DEFLATED, -15)
    return press.compress(raw) + press.flush(zlib.Z_FULL_FLUSH), zlib.adler32(raw), len(raw)


def joined_adler(first: int, second: int, second_length: int) -> int:
    """The checksum of two texts, one after the other, from those of each."""
    a1, b1, a2, b2 = first & 0xFFFF, first >> 16, second & 0xFFFF, second >> 16
    a = (a1 + a2 - 1) % ADLER
    b = (b1 + b2 + second_length * (a1 - 1)) % ADLER
    return b << 16 | a


def png_of(bands: list[tuple[bytes, int, int]], width: int, height: int) -> bytes:
    """A file from its bands, top first."""
    check = 1
    for _, adler, length in bands:
        check = joined_adler(check, adler, length)
    # an empty last block, then the checksum
    parts = [b"\x78\x9c", *[data for data, _, _ in bands], b"\x03\x00" + struct.pack(">I", check)]
    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return MAGIC + chunk(b"IHDR", head) + b"".join(chunk(b"IDAT", x) for x in parts) + chunk(b"IEND", b"")


def images_of(pixels: DataFrame, width: int, height: int, band_rows: int = BAND_ROWS) -> DataFrame:
    """(file, content): PNG files from pixels (file, yy, xx, b, g, r); those that aren't there are black. Pixels outside of the image fail."""
    band = F.floor(F.col("yy") / band_rows).cast("int")
    ok = F.col("yy").between(0, height - 1) & F.col("xx").between(0, width - 1)
    named = pixels.select("file", F.when(ok, band).otherwise(F.raise_error(F.lit("a pixel outside of the image")).cast("int")).alias("band"), "yy", "xx", "b", "g", "r")
    # black bands are there, too
    every = pixels.select("file").distinct().withColumn("band", F.explode(F.sequence(F.lit(0), F.lit(-(-height // band_rows) - 1))))
    rows = named.unionByName(every, allowMissingColumns=True)

    def press(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        file, band = key
        dense = np.zeros((min(band_rows, height - band * band_rows), width, 3), np.uint8)
        part = part[part["yy"].notna()]
        dense[part["yy"].astype(int) - band * band_rows, part["xx"].astype(int)] = part[["r", "g", "b"]].to_numpy(np.uint8)
        return pd.DataFrame([(file, band, *deflated(dense))], columns=["file", "band", "data", "adler", "length"])

    pressed = rows.groupBy("file", "band").applyInPandas(press, "file string, band int, data binary, adler long, length long")

    def join(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("band")
        bands = [(bytes(d), int(a), int(n)) for d, a, n in zip(part["data"], part["adler"], part["length"])]
        return pd.DataFrame([(key[0], png_of(bands, width, height))], columns=["file", "content"])

    return pressed.groupBy("file").applyInPandas(join, "file string, content binary")


def rendered(pixels: DataFrame, file: str, width: int, height: int) -> DataFrame:
    """The file of a render's coloured pixels (yy, xx, b, g, r)."""
    return images_of(pixels.select(F.lit(file).alias("file"), "yy", "xx", "b", "g", "r"), width, height)


@dataclass
class Written(WriterCommitMessage):
    names: list[tuple[str, str]]


class _Writer(DataSourceWriter):
    def __init__(self, path: str) -> None:
        self.path = path

    def place(self) -> tuple[fs.FileSystem, str]:
        where, path = fs.FileSystem.from_uri(self.path if "://" in self.path else "file://" + self.path)
        return where, path.rstrip("/")

    def write(self, rows: Iterator) -> Written:
        where, path = self.place()
        where.create_dir(path, recursive=True)
        names = []
        for row in rows:
            hidden = f"{path}/.{row.file}-{uuid.uuid4().hex}"
            with where.open_output_stream(hidden) as out:
                out.write(bytes(row.content))
            names.append((hidden, f"{path}/{row.file}"))
        return Written(names)

    def commit(self, messages: list) -> None:
        """Only names reach the driver."""
        where, _ = self.place()
        for message in messages:
            for hidden, name in message.names if message else []:
                where.move(hidden, name)

    def abort(self, messages: list) -> None:
        where, path = self.place()
        if where.get_file_info(path).type == fs.FileType.Directory:
            for info in where.get_file_info(fs.FileSelector(path)):
                if info.base_name.startswith(".") and info.type == fs.FileType.File:
                    where.delete_file(info.path)


class FileSink(DataSource):
    """df.write.format("whole_files").mode("append").save(path): a file for each row (file, content)."""

    @classmethod
    def name(cls) -> str:
        return "whole_files"

    def schema(self) -> str:
        return "file string, content binary"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options["path"])


def write_files(files: DataFrame, path: str) -> None:
    """Rows (file, content) as files below path, a new folder."""
    files.sparkSession.dataSource.register(FileSink)
    files.select("file", "content").write.format("whole_files").mode("append").save(path)


def frame_name(idx: str) -> Column:
    return F.format_string("img_%05d.png", F.col(idx))


def decode_png(content: bytes) -> np.ndarray:
    """(height, width, 3) in blue, green, red; ValueError for what isn't a whole file of a kind that is read."""
    if content[:8] != MAGIC:
        raise ValueError("no PNG")
    at, head, data = 8, None, []
    while at + 12 <= len(content):
        size, kind = struct.unpack_from(">I4s", content, at)
        body = content[at + 8 : at + 8 + size]
        if len(body) < size or struct.unpack_from(">I", content, at + 8 + size)[0] != zlib.crc32(kind + body):
            raise ValueError("damaged chunk")
        head = struct.unpack(">IIBBBBB", body) if kind == b"IHDR" else head
        data += [body] if kind == b"IDAT" else []
        at += 12 + size
        if kind == b"IEND":
            break
    else:
        raise ValueError("cut off")
    if not head or head[2] != 8 or head[3] not in CHANNELS or head[6]:
        raise ValueError("not 8-bit grey or colour, or interlaced")
    width, height, n = head[0], head[1], CHANNELS[head[3]]
    try:
        raw = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8)
    except zlib.error as e:
        raise ValueError("damaged data") from e
    if len(raw) != height * (width * n + 1):
        raise ValueError("wrong length")
    raw = raw.reshape(height, width * n + 1)
    out, above = np.zeros((height, width * n), np.uint8), np.zeros(width * n, np.uint8)
    for y in range(height):
        above = out[y] = unfiltered(int(raw[y, 0]), raw[y, 1:], above, n)
    image = out.reshape(height, width, n)
    return image[:, :, [0, 0, 0]] if n < 3 else image[:, :, [2, 1, 0]]


def unfiltered(kind: int, row: np.ndarray, above: np.ndarray, n: int) -> np.ndarray:
    """A row without its filter: none, sub, up, average or Paeth."""
    if kind == 0:
        return row
    if kind == 2:
        return row + above
    if kind == 1:
        return np.cumsum(row.reshape(-1, n), axis=0, dtype=np.uint64).astype(np.uint8).reshape(-1)
    if kind not in (3, 4):
        raise ValueError("unknown filter")
    out, left, corner = np.zeros((len(row) // n, n), int), np.zeros(n, int), np.zeros(n, int)
    for x, (r, up) in enumerate(zip(row.reshape(-1, n).astype(int), above.reshape(-1, n).astype(int))):
        if kind == 3:
            guess = (left + up) >> 1
        else:
            far = np.abs(np.stack((up - corner, left - corner, left + up - 2 * corner)))
            guess = np.where((far[0] <= far[1]) & (far[0] <= far[2]), left, np.where(far[1] <= far[2], up, corner))
        left, corner = (r + guess) & 255, up
        out[x] = left
    return out.astype(np.uint8).reshape(-1)


def numbered_files(spark: SparkSession, path: str, pattern: str = r"\.(png|jpe?g)$") -> DataFrame:
    """(idx, file, content) of a folder's images, numbered from 0 by name across both kinds. Names are sorted in ranges; contents
    aren't sorted."""
    files = spark.read.format("binaryFile").load(path).filter(F.col("path").rlike(pattern)).select(F.col("path").alias("file"), "content")
    names = files.select("file").repartitionByRange("file").sortWithinPartitions("file").withColumn("id", F.monotonically_increasing_id())
    names = materialise(names, "frame-names")
    part = F.shiftright("id", 33)
    sizes = names.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    # a row for each task that sorted names
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    before = sizes.select("part", F.coalesce(before, F.lit(0)).alias("start"))
    held = names.withColumn("part", part).join(F.broadcast(before), "part")
    return files.join(held.select("file", (F.col("start") + F.col("id") - F.shiftleft(F.col("part"), 33)).alias("idx")), "file").select("idx", "file", "content")


def read_frames(spark: SparkSession, path: str) -> DataFrame:
    """(idx, file, ok, data, height, width, encoding) of a folder's images by name; files that can't be read, JPEG among them, keep
    their number and are not ok."""

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                try:
                    image = decode_png(bytes(r.content))
                    row = (r.idx, r.file, True, image.tobytes(), *image.shape[:2], "bgr8")
                except ValueError:
                    row = (r.idx, r.file, False, None, None, None, None)
                yield pd.DataFrame([row], columns=["idx", "file", "ok", "data", "height", "width", "encoding"]).astype({"height": "Int32", "width": "Int32"})

    return numbered_files(spark, path).mapInPandas(decode, "idx long, file string, ok boolean, data binary, height int, width int, encoding string")


def posed_frames(frames: DataFrame, matched: DataFrame) -> DataFrame:
    """Frames that can be read beside their match (idx, ok, ..) of the same number; others are left out, as are numbers that only one
    side has."""
    return frames.filter("ok").drop("ok", "file").join(matched.filter("ok").drop("ok"), "idx")
