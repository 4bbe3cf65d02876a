"""Zip archive scan (S3) and incremental ingest.

Archives can be several GB, beyond what one ``binaryFile`` row may hold, so
the scan never ships archive bytes through Spark rows. Phase 1 lists each
archive's members and their places (one small task per archive reads only the zip's central
directory, in blocks). Phase 2 spreads the member rows over many tasks; each task opens
the archive from shared storage, goes to the places of its own members and inflates those; the directory, which
has millions of entries where members are small, is not read again. A huge
archive is thereby read by many tasks in parallel.
"""

from __future__ import annotations

import re
import struct
import zipfile
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .fs import path_exists

_ENCODING = re.compile(rb'<\?xml[^>]*encoding=["\']([A-Za-z0-9_\-]+)["\']')
_DECL = re.compile(r"^\s*<\?xml[^>]*\?>")


#: Starts the text of a member that could not be decoded; no parser takes it.
UNDECODABLE = "<undecodable <"


def _store(uri: str):
    """The pyarrow file system of a URI, and the path in its terms."""
    from pyarrow import fs
    # Hadoop's names of the S3 connector; pyarrow knows the plain one.
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))


def _open(uri: str):
    """Open a file URI (local or any pyarrow filesystem) for random access."""
    if uri.startswith("file:") or uri.startswith("/"):
        return open(re.sub(r"^file:(//)?", "", uri), "rb")
    filesystem, path = _store(uri)
    return filesystem.open_input_file(path)


@contextmanager
def created(uri: str, attempt: int):
    """A file of a task, written under a name of the attempt and renamed when complete, so a
    retried or speculative attempt never leaves half a file. Any store that ``_open`` reads."""
    import os
    if uri.startswith("file:") or uri.startswith("/"):
        path = re.sub(r"^file:(//)?", "", uri)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(f"{path}.{attempt}.tmp", "wb") as out:
            yield out
        os.replace(f"{path}.{attempt}.tmp", path)
        return
    filesystem, path = _store(uri)
    filesystem.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with filesystem.open_output_stream(f"{path}.{attempt}.tmp") as out:
        yield out
    filesystem.move(f"{path}.{attempt}.tmp", path)


def decode_xml(raw: bytes) -> str:
    """Decode by the XML declaration (UTF-8 when absent) and drop the
    declaration, so the text parses as an already-decoded string. Bytes that
    their encoding does not know (or an unknown encoding) give a text that is no
    XML, so the member lands in quarantine instead of being altered silently."""
    m = _ENCODING.search(raw[:200])
    enc = m.group(1).decode("ascii") if m else "utf-8"
    try:
        text = raw.decode(enc)
    except (LookupError, UnicodeDecodeError):
        return UNDECODABLE + raw.decode("latin-1")
    return _DECL.sub("", text, count=1)


def list_archives(spark: SparkSession, path: str, glob: str = "*.zip",
                  recursive: bool = False) -> DataFrame:
    """Archive files under ``path`` as ``archive (uri), name, length``.
    Only file metadata is read (the content column is never selected)."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    files = reader.load(path).select("path", "length")
    return files.select(F.col("path").alias("archive"),
                        F.substring_index("path", "/", -1).alias("name"), "length")


#: What places a member in its archive, beside ``archive`` and ``member``.
PLACE = ("header", "packed", "size", "method", "flags", "crc")
# The records of a zip file (texts: compiled formats do not travel to tasks).
_ENTRY, _LOCAL, _END, _END64, _LOCATOR = "<4s6H3L5H2L", "<4s5H3L2H", "<4s4H2LH", "<4sQ2H2L4Q", "<4sLQL"
_ENTRY_SIZE, _LOCAL_SIZE, _END_SIZE, _END64_SIZE, _LOCATOR_SIZE = map(struct.calcsize, (_ENTRY, _LOCAL, _END, _END64, _LOCATOR))
#: Bytes that are read of an archive at a time.
_BLOCK = 1 << 20


def _directory_at(fh) -> tuple[int, int, int]:
    """Start and size of an archive's central directory, and the bytes that stand before the archive in its file."""
    length = fh.seek(0, 2)
    tail_at = max(0, length - (1 << 16) - _END_SIZE - _LOCATOR_SIZE)
    fh.seek(tail_at)
    tail = fh.read(length - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    if at < 0 or len(tail) - at < _END_SIZE:
        raise zipfile.BadZipFile("File is not a zip file")
    end = struct.unpack_from(_END, tail, at)
    size, start, above = end[5], end[6], tail_at + at
    if at >= _LOCATOR_SIZE and tail[at - _LOCATOR_SIZE:at - _LOCATOR_SIZE + 4] == b"PK\x06\x07":
        above -= _LOCATOR_SIZE + _END64_SIZE
        fh.seek(above)
        end = struct.unpack(_END64, fh.read(_END64_SIZE))
        if end[0] != b"PK\x06\x06":
            raise zipfile.BadZipFile("Bad zip64 end of central directory")
        size, start = end[8], end[9]
    before = above - size - start
    if before < 0:
        raise zipfile.BadZipFile("Bad offset for central directory")
    return start + before, size, before


def _entries(fh) -> Iterator[tuple]:
    """Names and places (``PLACE``) of an archive's members in the order of its central directory, which is
    read block by block: an archive may hold millions of members."""
    at, left, before = _directory_at(fh)
    fh.seek(at)
    data, pos = b"", 0
    while True:
        if len(data) - pos < (1 << 18) and left:   # more than any entry has
            more = fh.read(min(left, _BLOCK))
            if not more:
                raise zipfile.BadZipFile("Truncated central directory")
            data, pos, left = data[pos:] + more, 0, left - len(more)
        if pos >= len(data):
            return
        if len(data) - pos < _ENTRY_SIZE:
            raise zipfile.BadZipFile("Truncated central directory")
        magic, _, _, flags, method, _, _, crc, packed, size, n, extra, comment, _, _, _, header = struct.unpack_from(_ENTRY, data, pos)
        if magic != b"PK\x01\x02":
            raise zipfile.BadZipFile("Bad magic number for central directory")
        pos += _ENTRY_SIZE
        raw = data[pos:pos + n]
        name = raw.decode("utf-8" if flags & 0x800 else "cp437")
        if extra:
            # Sizes beyond 32 bits, and names in Unicode.
            field, stop = pos + n, pos + n + extra
            while field + 4 <= stop:
                kind, length = struct.unpack_from("<HH", data, field)
                if kind == 1:
                    wide = iter(struct.unpack_from(f"<{min(length, stop - field - 4) // 8}Q", data, field + 4))
                    size, packed, header = (next(wide, v) if v == 0xFFFFFFFF else v for v in (size, packed, header))
                elif kind == 0x7075 and length > 5 and struct.unpack_from("<BL", data, field + 4) == (1, zlib.crc32(raw)):
                    name = data[field + 9:field + 4 + length].decode("utf-8")
                field += 4 + length
        pos += n + extra + comment
        yield name.split("\0", 1)[0], header + before, packed, size, method, flags, crc


def list_members(archives: DataFrame, name_contains: str = "xml",
                 start: int | None = None, stop: int | None = None,
                 step: int | None = None) -> DataFrame:
    """S3 phase 1: ``archive, member`` and the member's place in the archive (``PLACE``) for members whose name contains
    ``name_contains``, optionally sliced ``[start:stop:step]`` per archive, as Python slices a list.

    Every member carries its ordinal among those of its archive and their number; the slice is a
    filter on the two, in the plan. (A negative step selects members, it cannot order them.)
    """
    if step == 0:
        raise ValueError("slice step cannot be zero")
    sliced = (start, stop, step) != (None, None, None)
    fields = ("member", *PLACE, "ordinal", "total")

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                with _open(uri) as fh:
                    total = sum(name_contains in e[0] for e in _entries(fh)) if sliced else 0
                    found = ((*e, i, total) for i, e in enumerate(e for e in _entries(fh) if name_contains in e[0]))
                    while rows := list(islice(found, 20_000)):
                        columns = dict(zip(fields, map(list, zip(*rows))))
                        yield pa.RecordBatch.from_arrays([pa.array([uri] * len(rows)), pa.array(columns.pop("member")),
                                                          *[pa.array(c, pa.int64()) for c in columns.values()]], ["archive", *fields])

    listed = archives.select("archive").mapInArrow(members, "archive string, member string, " + ", ".join(f"{c} long" for c in fields[1:]))
    if sliced:
        listed = listed.where(in_slice(F.col("ordinal"), F.col("total"), start, stop, step))
    return listed.select("archive", "member", *PLACE)


def in_slice(ordinal: Column, total: Column, start: int | None, stop: int | None, step: int | None) -> Column:
    """Whether ``list(range(total))[start:stop:step]`` holds ``ordinal``."""
    step = step or 1
    low, high = (F.lit(0), total) if step > 0 else (F.lit(-1), total - 1)

    def place(bound: int | None, default: Column) -> Column:
        if bound is None:
            return default
        at = F.lit(bound) if bound >= 0 else total + bound
        return F.greatest(low, F.least(high, at))

    if step > 0:
        first, last = place(start, low), place(stop, high)
        return (ordinal >= first) & (ordinal < last) & ((ordinal - first) % step == 0)
    first, last = place(start, high), place(stop, low)
    return (ordinal <= first) & (ordinal > last) & ((first - ordinal) % -step == 0)


class _Members:
    """The members of one archive by their places, read in blocks: neighbours share a read, and the
    central directory is not read again."""

    def __init__(self, uri: str):
        self.uri, self.fh, self.data, self.at = uri, _open(uri), b"", 0

    def close(self) -> None:
        self.fh.close()

    def _bytes(self, at: int, n: int) -> bytes:
        if not self.at <= at <= at + n <= self.at + len(self.data):
            self.fh.seek(at)
            self.data, self.at = self.fh.read(max(n, _BLOCK)), at
            if len(self.data) < n:
                raise zipfile.BadZipFile(f"Truncated member in {self.uri}")
        return self.data[at - self.at:at - self.at + n]

    def read(self, name: str, header: int, packed: int, size: int, method: int, flags: int, crc: int) -> bytes:
        if flags & 1 or method not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
            with zipfile.ZipFile(self.fh) as z:   # the rarer methods, and what it refuses
                self.data = b""
                return z.read(name)
        local = struct.unpack(_LOCAL, self._bytes(header, _LOCAL_SIZE))
        if local[0] != b"PK\x03\x04":
            raise zipfile.BadZipFile(f"Bad magic number for file header of {name!r} in {self.uri}")
        data = self._bytes(header + _LOCAL_SIZE + local[9] + local[10], packed)
        if method == zipfile.ZIP_DEFLATED:
            data = zlib.decompress(data, -15, size or 1)
        if zlib.crc32(data) != crc:
            raise zipfile.BadZipFile(f"Bad CRC-32 for file {name!r} in {self.uri}")
        return data


def _placed(members: DataFrame) -> DataFrame:
    """Members named without their places: looked up in the directories of their archives."""
    if set(PLACE) <= set(members.columns):
        return members
    places = list_members(members.select("archive").distinct(), "")
    # As the archive gives them by name: of equal names, the last one.
    last = places.groupBy("archive", "member").agg(F.max(F.struct(*PLACE)).alias("_place"))
    return members.join(last, ["archive", "member"]).select("archive", "member", "_place.*")


def read_members(members: DataFrame, num_partitions: int | None = None,
                 chunk_bytes: int = 64 << 20) -> DataFrame:
    """S3 phase 2: inflate each member -> ``archive, member, xml``.

    Members are range-spread over ``num_partitions`` tasks (default: the
    shuffle partition count), so one big archive is read in parallel.
    """
    spark = members.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def inflate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Emit bounded chunks: members are MBs each, and one Arrow string
        # column must stay far below 2 GB.
        def chunk():
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in (uris, names, texts)], ["archive", "member", "xml"])

        archive, (uris, names, texts), size = None, ([], [], []), 0
        try:
            for batch in batches:
                for uri, name, *place in zip(*(c.to_pylist() for c in batch.columns[:2]), *(c.to_numpy().tolist() for c in batch.columns[2:])):
                    if archive is None or archive.uri != uri:
                        if archive is not None:
                            archive.close()
                        archive = _Members(uri)
                    text = decode_xml(archive.read(name, *place))
                    uris.append(uri)
                    names.append(name)
                    texts.append(text)
                    size += len(text)
                    if size >= chunk_bytes or len(texts) >= 20_000:
                        yield chunk()
                        (uris, names, texts), size = ([], [], []), 0
        finally:
            if archive is not None:
                archive.close()
        if texts:
            yield chunk()

    # Range, not hash: each task gets a contiguous run of members -- a big
    # archive is split over several tasks, yet each task opens only one or
    # two archives -- in the order of their bytes.
    spread = _placed(members).select("archive", "member", *PLACE).repartitionByRange(n, "archive", "header")
    return spread.sortWithinPartitions("archive", "header").mapInArrow(inflate, "archive string, member string, xml string")


def scan_archives(spark: SparkSession, path: str, glob: str = "*.zip",
                  name_contains: str = "xml", num_partitions: int | None = None) -> DataFrame:
    """S3: zip archives -> one row per XML member with its decoded text."""
    return read_members(list_members(list_archives(spark, path, glob), name_contains),
                        num_partitions)


# ------------------------------------------------------------------ S4
def new_archives(archives: DataFrame, manifest_path: str | None) -> DataFrame:
    """Archives not yet named in the ingest manifest (anti join)."""
    if manifest_path is None:
        return archives
    spark = archives.sparkSession
    if not path_exists(spark, manifest_path):   # no manifest yet: everything is new
        return archives
    done = spark.read.parquet(manifest_path).select("name")
    return archives.join(done, "name", "left_anti")


def record_ingested(archives: DataFrame, manifest_path: str) -> None:
    """Append the processed archive names to the manifest; call after
    the outputs of those archives were written."""
    (archives.select("name").withColumn("ingested_at", F.current_timestamp())
             .write.mode("append").parquet(manifest_path))


def reset_manifest(spark: SparkSession, manifest_path: str) -> None:
    """Clearing outputs also clears the manifest (else cleared archives
    would still be skipped)."""
    spark.createDataFrame([], "name string, ingested_at timestamp") \
         .write.mode("overwrite").parquet(manifest_path)


# ------------------------------------------------------------------ fixtures
class _Writer:
    """A zip archive written member by member; of the members written only their directory entries are kept, as bytes."""

    def __init__(self, out):
        self.out, self.at, self.n, self.directory = out, 0, 0, bytearray()

    def add(self, name: str, text: str) -> None:
        raw, data = name.encode(), text.encode("utf-8")
        packed = zlib.compress(data, 1, -15)
        crc, flags = zlib.crc32(data), 0 if raw.isascii() else 0x800
        sizes = (len(packed), len(data))
        if max(sizes) >= 0xFFFFFFFF:
            raise ValueError(f"{name!r} is too large for one member")
        # Offsets beyond 32 bits go into an extra field.
        extra = struct.pack("<HHQ", 1, 8, self.at) if self.at >= 0xFFFFFFFF else b""
        self.directory += struct.pack(_ENTRY, b"PK\x01\x02", 0x32D, 45 if extra else 20, flags, 8, 0, 33, crc, *sizes, len(raw), len(extra), 0, 0, 0,
                                      0o600 << 16, 0xFFFFFFFF if extra else self.at) + raw + extra
        self.out.write(struct.pack(_LOCAL, b"PK\x03\x04", 20, flags, 8, 0, 33, crc, *sizes, len(raw), 0) + raw + packed)
        self.at += _LOCAL_SIZE + len(raw) + len(packed)
        self.n += 1

    def close(self) -> None:
        size, n, at = len(self.directory), self.n, self.at
        self.out.write(self.directory)
        if n >= 0xFFFF or size >= 0xFFFFFFFF or at >= 0xFFFFFFFF:
            self.out.write(struct.pack(_END64, b"PK\x06\x06", _END64_SIZE - 12, 45, 45, 0, 0, n, n, size, at))
            self.out.write(struct.pack(_LOCATOR, b"PK\x06\x07", 0, at + size, 1))
            n, size, at = min(n, 0xFFFF), min(size, 0xFFFFFFFF), min(at, 0xFFFFFFFF)
        self.out.write(struct.pack(_END, b"PK\x05\x06", 0, 0, n, n, size, at, 0))


def _made(done: list[tuple[str, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([a for a, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], ["archive", "members"])


def write_archives(files: DataFrame, out_dir: str, num_archives: int,
                   prefix: str = "part") -> DataFrame:
    """Pack ``member, xml`` rows into ``num_archives`` zip files in
    ``out_dir`` (shared storage, any store that the scan reads), one archive per task. Returns
    ``archive, members`` (an action runs when the result is consumed)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task = TaskContext.get()
        target = f"{out_dir}/{prefix}-{task.partitionId():05d}.zip"
        with created(target, task.taskAttemptId()) as out:
            z = _Writer(out)
            for batch in batches:
                for m, x in zip(batch.column("member").to_pylist(), batch.column("xml").to_pylist()):
                    z.add(m, x)
            z.close()
        yield _made([(target, z.n)])

    return (files.select("member", "xml").repartition(num_archives, "member")
                 .mapInArrow(pack, "archive string, members long"))


def write_named_archives(files: DataFrame, out_dir: str) -> DataFrame:
    """Pack ``name, member, xml`` rows into one zip file per ``name``, members in order of their
    names. An archive is one file and so has one writer; its rows stream through the task. Returns ``archive,
    members`` (an action runs when the result is consumed)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from contextlib import ExitStack

        from pyspark import TaskContext
        attempt, done, name, z = TaskContext.get().taskAttemptId(), [], None, None

        def finish():
            z.close()
            stack.pop_all().close()
            done.append((f"{out_dir}/{name}", z.n))

        with ExitStack() as stack:
            for batch in batches:
                for own, m, x in zip(*(batch.column(c).to_pylist() for c in ("name", "member", "xml"))):
                    if own != name:
                        if name is not None:
                            finish()
                        name = own
                        z = _Writer(stack.enter_context(created(f"{out_dir}/{name}", attempt)))
                    z.add(m, x)
            if name is not None:
                finish()
        yield _made(done)

    dealt = files.select("name", "member", "xml").repartition("name").sortWithinPartitions("name", "member")
    return dealt.mapInArrow(pack, "archive string, members long")
