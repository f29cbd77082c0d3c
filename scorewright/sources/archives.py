"""Archive members as rows (zip, tar, tar.gz, tar.bz2, standalone gz).

Runs in Python (stdlib ``zipfile``/``tarfile``/``gzip``) because Spark has no
archive reader; everything happens in memory inside the task, never on local
disk, so member names cannot escape anywhere.  Rows leave the task in small
pandas batches so a large archive never becomes one huge batch.
"""

from __future__ import annotations

import gzip
import io
import lzma
import posixpath
import tarfile
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

MEMBER_SCHEMA = T.StructType([
    T.StructField("submission", T.StringType()),
    T.StructField("archive_path", T.StringType()),
    T.StructField("member_path", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("size_bytes", T.LongType()),
    T.StructField("content", T.BinaryType()),
    T.StructField("depth", T.IntegerType()),
    T.StructField("error", T.StringType()),
])

_ROWS_PER_BATCH = 64


def archive_kind(name: str) -> str | None:
    """Which reader opens ``name`` (compound extensions first, see D1)."""
    low = name.lower()
    if low.endswith(".tar.gz") or low.endswith(".tgz"):
        return "tar"
    if low.endswith(".tar.bz2") or low.endswith(".tar.xz"):
        return "tar"
    if low.endswith(".zip"):
        return "zip"
    if low.endswith(".tar"):
        return "tar"
    if low.endswith(".gz"):
        return "gz"
    if low.endswith(".rar") or low.endswith(".7z"):
        return "unsupported"
    return None


def _members(name: str, data: bytes, max_member_bytes: int | None) -> Iterator[tuple[str, bytes | None]]:
    """(path, bytes) of each member; None for one above the limit."""
    kind = archive_kind(name)
    if kind == "zip":
        with zipfile.ZipFile(io.BytesIO(data)) as zf:
            for info in zf.infolist():
                if info.is_dir():
                    continue
                if info.flag_bits & 0x1:
                    raise ValueError(f"encrypted member {info.filename}")
                if max_member_bytes is not None and info.file_size > max_member_bytes:
                    yield info.filename, None
                    continue
                yield info.filename, zf.read(info)
    elif kind == "tar":
        with tarfile.open(fileobj=io.BytesIO(data), mode="r:*") as tf:
            for info in tf:
                if not info.isfile():
                    continue
                if max_member_bytes is not None and info.size > max_member_bytes:
                    yield info.name, None
                    continue
                fh = tf.extractfile(info)
                yield info.name, fh.read() if fh else b""
    elif kind == "gz":
        stem = name[: name.rfind(".")] if "." in name[1:] else name
        yield stem, gzip.decompress(data)
    elif kind == "unsupported":
        raise ValueError(f"no reader for {name}")
    else:
        raise ValueError(f"not an archive: {name}")


def _expand(it: Iterator[pd.DataFrame], max_depth: int, max_member_bytes: int | None) -> Iterator[pd.DataFrame]:
    rows: list[dict] = []

    def flush():
        nonlocal rows
        out = pd.DataFrame(rows, columns=[f.name for f in MEMBER_SCHEMA.fields])
        rows = []
        return out

    for pdf in it:
        for sub, apath, aname, data in zip(pdf["submission"], pdf["path"], pdf["name"], pdf["content"]):
            stack = [(apath, aname, bytes(data) if data is not None else b"", 1)]
            while stack:
                path, name, blob, depth = stack.pop()
                try:
                    found = list(_members(name, blob, max_member_bytes))
                except (zipfile.BadZipFile, tarfile.TarError, OSError, EOFError, ValueError,
                        lzma.LZMAError, zipfile.LargeZipFile) as exc:
                    rows.append({"submission": sub, "archive_path": path, "member_path": None, "name": None,
                                 "size_bytes": None, "content": None, "depth": depth,
                                 "error": f"Failed to extract {name}: {exc}"})
                    continue
                for mpath, mdata in found:
                    full = f"{path}!/{mpath}"
                    mname = posixpath.basename(mpath)
                    if mdata is None:
                        rows.append({"submission": sub, "archive_path": path, "member_path": full, "name": mname,
                                     "size_bytes": None, "content": None, "depth": depth,
                                     "error": f"member too large: {mpath}"})
                        continue
                    rows.append({"submission": sub, "archive_path": path, "member_path": full, "name": mname,
                                 "size_bytes": len(mdata), "content": mdata, "depth": depth, "error": None})
                    if depth < max_depth and archive_kind(mname) in ("zip", "tar", "gz"):
                        stack.append((full, mname, mdata, depth + 1))
                    if len(rows) >= _ROWS_PER_BATCH:
                        yield flush()
        if rows:
            yield flush()
    if rows:
        yield flush()


# FIXED VALUES: leading bytes of the formats the Python reader opens
ZIP_MAGIC = (b"PK\x03\x04", b"PK\x05\x06", b"PK\x07\x08")
GZIP_MAGIC = b"\x1f\x8b"
BZIP2_MAGIC = b"BZh"
XZ_MAGIC = b"\xfd7zXZ\x00"
TAR_MAGIC_OFFSET = 257
TAR_MAGIC = b"ustar"


def plausible_archive(content) -> F.Column:
    """True when the leading bytes match a readable archive format (tar is
    recognised at offset 257, or when compressed by its compressor's magic).
    Decided natively, so rows that cannot open never reach Python."""
    def starts(magic: bytes):
        return F.substring(content, 1, len(magic)) == F.lit(bytearray(magic))
    tar = F.substring(content, TAR_MAGIC_OFFSET + 1, len(TAR_MAGIC)) == F.lit(bytearray(TAR_MAGIC))
    out = tar | starts(GZIP_MAGIC) | starts(BZIP2_MAGIC) | starts(XZ_MAGIC)
    for m in ZIP_MAGIC:
        out = out | starts(m)
    return F.coalesce(out, F.lit(False))


def expand_archives(archives: DataFrame, max_depth: int = 1, max_member_bytes: int | None = None) -> DataFrame:
    """Member rows of every archive row (submission, path, name, content).

    ``max_depth=1`` opens only the given archives: archives found inside are
    emitted as members but not opened (reference behaviour; raise it to go
    deeper, D6).  A corrupt, encrypted or unsupported archive yields one row
    with ``error`` set and no members; content without any archive signature
    gets that row natively, without a trip through Python.  A member above
    ``max_member_bytes`` gets a row with ``error``; the others come out."""
    from ..session import ship_package
    ship_package(archives.sparkSession)
    content = F.col("content")
    if not isinstance(archives.schema["content"].dataType, T.BinaryType):
        content = F.encode(content, "UTF-8")
    src = archives.select("submission", "path", "name", content.alias("content")) \
        .withColumn("__ok", plausible_archive(F.col("content")))
    candidates = src.filter("__ok").drop("__ok")
    rejected = src.filter(~F.col("__ok")).select(
        "submission", F.col("path").alias("archive_path"), F.lit(None).cast("string").alias("member_path"),
        F.lit(None).cast("string").alias("name"), F.lit(None).cast("bigint").alias("size_bytes"),
        F.lit(None).cast("binary").alias("content"), F.lit(1).alias("depth"),
        F.concat(F.lit("Failed to extract "), F.col("name"), F.lit(": not a readable archive")).alias("error"))
    opened = candidates.mapInPandas(lambda it: _expand(it, max_depth, max_member_bytes), MEMBER_SCHEMA)
    return opened.unionByName(rejected)
