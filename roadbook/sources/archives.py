"""Yearly ZIP archives expanded into CSV lines.

Archives of any size: ``archive_index`` reads the central directory at the end
of each archive, one row per member, and ``expand_members`` deals the members
to tasks of their own, which read no more of the archive than the member. A
member is not splittable, so it is one task; its lines are streamed out in
bounded batches, and everything after that is ordinary DataFrame work.
``expand_content`` does the same for archives that are held in rows. A corrupt
archive or member becomes one error row instead of failing the job. A file
without a byte isn't listed by Spark's file sources; S9 finds its year missing.

Tasks open archives by ``pyarrow.fs``, by the URI that Spark lists them under
(local and shared folders, S3, GCS, HDFS).
"""

from __future__ import annotations

import csv
import io
import struct
import zipfile
import zlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadbook.sources.stores import located

LINES_SCHEMA = "archive string, member string, line_no long, line string, error string"
INDEX_SCHEMA = ("archive string, member string, header_offset long, compressed long, size long, method int, crc long, flags int, "
                "error string")
#: Bytes of a member held at a time; compressed bytes that one task should read.
CHUNK, TASK_BYTES = 1 << 20, 1 << 27


def _records(fh):
    """Logical CSV records: a line break inside quotes stays in its record."""
    held = ""
    for raw in io.TextIOWrapper(fh, encoding="utf-8", errors="replace", newline=""):
        held += raw
        if held.count('"') % 2 == 0:
            yield held.rstrip("\r\n")
            held = ""
    if held:
        yield held.rstrip("\r\n")


def _expand(batches, batch_lines: int = 50_000):
    cols = ["archive", "member", "line_no", "line", "error"]
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"]):
            try:
                zf = zipfile.ZipFile(io.BytesIO(content))
                members = [m for m in zf.namelist() if m.lower().endswith(".csv")]
            except zipfile.BadZipFile as e:
                yield pd.DataFrame([[path, None, None, None, f"bad zip: {e}"]], columns=cols)
                continue
            for m in members:
                buf = []
                try:
                    with zf.open(m) as fh:
                        for i, line in enumerate(_records(fh)):
                            buf.append((path, m, i, line, None))
                            if len(buf) >= batch_lines:
                                yield pd.DataFrame(buf, columns=cols)
                                buf = []
                except (zipfile.BadZipFile, zlib.error, RuntimeError, NotImplementedError, EOFError) as e:
                    # a damaged, encrypted or unsupported member: one error row; member_frames leaves its lines out
                    buf = [(path, m, None, None, f"bad member: {e}")]
                if buf:
                    yield pd.DataFrame(buf, columns=cols)


def expand_content(archives: DataFrame) -> DataFrame:
    """(archive, member, line_no, line, error) for every CSV member of every archive in (path, content)."""
    return archives.select("path", "content").mapInPandas(_expand, LINES_SCHEMA)


def opened(path: str):
    """A file of any supported store, for ranged reads."""
    system, own = located(path)
    return system.open_input_file(own)


def _indexed(batches):
    cols = INDEX_SCHEMA.replace(",", "").split()[::2]
    for pdf in batches:
        for path in pdf["path"]:
            try:
                with opened(path) as f, zipfile.ZipFile(f) as z:       # reads the directory at the end only
                    rows = [(path, m.filename, m.header_offset, m.compress_size, m.file_size, m.compress_type, m.CRC, m.flag_bits, None)
                            for m in z.infolist() if m.filename.lower().endswith(".csv")]
            except (zipfile.BadZipFile, OSError, ValueError) as e:     # a seek before the start is a ValueError here
                rows = [(path, None, None, None, None, None, None, None, f"bad zip: {e}")]
            yield pd.DataFrame(rows, columns=cols)


def archive_index(files: DataFrame) -> DataFrame:
    """Members of the archives in ``files`` (path): where they lie, their sizes and checksums; or an error per archive."""
    return files.select("path").mapInPandas(_indexed, INDEX_SCHEMA)


class _Member(io.RawIOBase):
    """Bytes of one member, inflated as they are read and checked at the end."""

    def __init__(self, f, offset: int, compressed: int, size: int, method: int, crc: int):
        f.seek(offset)
        head = f.read(30)
        if head[:4] != b"PK\x03\x04":
            raise zipfile.BadZipFile("no member where the directory says")
        f.seek(offset + 30 + sum(struct.unpack("<HH", head[26:30])))
        self.f, self.left, self.due, self.crc, self.seen, self.got = f, compressed, size, crc, 0, 0
        self.inflate = zlib.decompressobj(-15) if method == zipfile.ZIP_DEFLATED else None
        self.held = b""

    def readable(self):
        return True

    def readinto(self, into) -> int:
        out = b""
        while not out:
            if not self.held and self.left:
                self.held = self.f.read(min(self.left, CHUNK))
                if not self.held:
                    raise EOFError("archive ends within a member")
                self.left -= len(self.held)
            if self.inflate is None:
                out, self.held = self.held[:len(into)], self.held[len(into):]
            else:
                out = self.inflate.decompress(self.held, len(into))
                self.held = self.inflate.unconsumed_tail
            if not out and not self.held and not self.left:
                if self.got != self.due or self.seen != self.crc:
                    raise zipfile.BadZipFile("checksum or size differs")
                return 0
        self.seen, self.got = zlib.crc32(out, self.seen), self.got + len(out)
        into[:len(out)] = out
        return len(out)


def _member_lines(batches, batch_lines: int = 50_000):
    cols = ["archive", "member", "line_no", "line", "error"]
    for pdf in batches:
        for m in pdf.itertuples():
            buf = []
            try:
                if m.flags & 1 or m.method not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
                    raise NotImplementedError("encrypted" if m.flags & 1 else f"compression method {m.method}")
                with opened(m.archive) as f:
                    for i, line in enumerate(_records(io.BufferedReader(_Member(f, m.header_offset, m.compressed, m.size, m.method, m.crc), CHUNK))):
                        buf.append((m.archive, m.member, i, line, None))
                        if len(buf) >= batch_lines:
                            yield pd.DataFrame(buf, columns=cols)
                            buf = []
            except (zipfile.BadZipFile, zlib.error, NotImplementedError, EOFError, OSError, ValueError) as e:
                buf = [(m.archive, m.member, None, None, f"bad member: {e}")]
            if buf:
                yield pd.DataFrame(buf, columns=cols)


def expand_members(index: DataFrame, tasks: int | None = None) -> DataFrame:
    """(archive, member, line_no, line, error) of the members of an index, dealt evenly over ``tasks`` tasks.

    By default there is one task per member, up to four per core, or more where tasks would read over TASK_BYTES.
    """
    good = index.filter(F.col("error").isNull())
    if tasks is None:
        n, size = good.agg(F.count("*"), F.sum("compressed")).first()
        tasks = min(n, max(4 * index.sparkSession.sparkContext.defaultParallelism, (size or 0) // TASK_BYTES))
    lines = good.drop("error").repartition(max(1, tasks)).mapInPandas(_member_lines, LINES_SCHEMA)
    bad = index.filter(F.col("error").isNotNull())
    return lines.unionByName(bad.select("archive", "member", F.lit(None).cast("long").alias("line_no"), F.lit(None).cast("string").alias("line"), "error"))


def expand_archives(spark: SparkSession, root: str, glob: str = "*.zip") -> DataFrame:
    """:func:`expand_members` of the archives in a folder; the index is written once under the checkpoint folder."""
    from roadbook.session import materialize

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(root).select("path")      # contents aren't read
    return expand_members(materialize(archive_index(files), "archive-index"))


def member_frames(lines: DataFrame, year_col: str = "shard_year", materialize_lines: bool = True
                  ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Parse expanded member lines into text rows, one scan per distinct header.

    Returns (rows with ``archive``, ``member`` and ``shard_year``, inventory of
    (archive, member, column), errors). A member is known by its archive and
    its name. Headers are metadata (one line per member) and are gathered to
    plan the parse; data lines are parsed by ``from_csv`` on the executors.
    The expansion is written once under the checkpoint folder. Members with
    an error, such as a checksum that differs at their end, are left out
    whole and listed in ``errors``.
    """
    from roadbook.session import materialize
    from roadbook.sources.shards import year_from_name

    if materialize_lines:
        lines = materialize(lines, "archive-lines")
    errors = lines.filter(F.col("error").isNotNull()).select("archive", "member", "error")
    ok = lines.filter(F.col("error").isNull())
    bad = errors.filter(F.col("member").isNotNull()).select("archive", "member").distinct()
    ok = ok.join(bad, ["archive", "member"], "left_anti")
    by_header: dict[str, list[tuple[str, str]]] = {}
    for r in ok.filter(F.col("line_no") == 0).select("archive", "member", "line").collect():
        by_header.setdefault(r["line"], []).append((r["archive"], r["member"]))
    spark = lines.sparkSession
    frames, inv = [], []
    for header, members in by_header.items():
        names = [c.strip() for c in next(csv.reader([header]))]
        ddl = ", ".join(f"`{c}` string" for c in names)
        own = spark.createDataFrame(members, "archive string, member string")      # one row per member
        part = (ok.filter((F.col("line_no") > 0) & (F.length("line") > 0)).join(own, ["archive", "member"])
                .select("archive", "member", year_from_name(F.col("member")).alias(year_col),
                        F.from_csv("line", ddl, {"multiLine": "true", "escape": '"'}).alias("r"))
                .select("archive", "member", year_col, "r.*"))
        frames.append(part)
        inv += [(a, m, c) for a, m in members for c in names]
    inventory = spark.createDataFrame(inv, "archive string, member string, column string")
    if not frames:
        return spark.createDataFrame([], f"archive string, member string, {year_col} int"), inventory, errors
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out, inventory, errors
