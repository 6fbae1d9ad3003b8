"""Work on files as data: manifests, sync plans, row counts, PEM blocks, object paths."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.shapes import quoted
from millrace.session import scratch_path

# The text around a PEM block, the scheme of an object path, the head of a URI.
PEM_BEGIN, PEM_END, PEM_DASHES = "-----BEGIN ", "-----END ", "-----"
OBJECT_SCHEME = "gs://"
SCHEME_AND_HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*:(//[^/]*)?"


FOUND = "path string, size long, modified timestamp, folder boolean"
BLOCK_BYTES = 8 << 20
READ_BYTES = 1 << 20


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def _uri(root: str, path: str) -> str:
    """The address of a path: only the scheme and host of ``root`` are taken over."""
    head = re.match(SCHEME_AND_HOST, root)
    return (head[0] if head else "file://") + quote(path)


def _qualified(spark: SparkSession, root: str) -> tuple[str, str]:
    """``root`` with scheme and host, and its plain path."""
    where = spark._jvm.org.apache.hadoop.fs.Path(root)
    full = where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toUri()
    path = full.getPath()
    host = f"//{full.getAuthority()}" if full.getAuthority() else "//"
    return f"{full.getScheme()}:{host}{quote(path)}", path


def _is_hidden(name: str) -> bool:
    """Names that no file scan reads."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _list_folders(root: str):
    """The entries of each folder of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                files, path = _open(_uri(root, folder))
                info = files.get_file_info(path)
                entries = [info] if info.is_file else files.get_file_info(pafs.FileSelector(path, allow_not_found=False))
                entries = [e for e in entries if e.is_file or e.type == pafs.FileType.Directory]
                kept = [e for e in entries if e is info or not _is_hidden(e.base_name)]
                base = folder.rstrip("/")
                for at in range(0, len(kept), 10_000):
                    some = kept[at:at + 10_000]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([folder if e is info else f"{base}/{e.base_name}" for e in some], pa.string()),
                        pa.array([e.size or 0 for e in some], pa.int64()),
                        pa.array([(e.mtime_ns or 0) // 1000 for e in some], pa.int64()).cast(pa.timestamp("us", "UTC")),
                        pa.array([not e.is_file for e in some], pa.bool_()),
                    ], names=["path", "size", "modified", "folder"])

    return run


def glob_pattern(glob: str) -> str:
    """The regular expression of a glob for file names: ``*``, ``?``, ``[..]``, ``{a,b}`` and backslashes."""
    out, depth, i = "", 0, 0
    while i < len(glob):
        c = glob[i]
        end = glob.find("]", i + 2) if c == "[" else -1
        if c == "\\" and i + 1 < len(glob):
            i += 1
            out += re.escape(glob[i])
        elif c == "*":
            out += "[^/]*"
        elif c == "?":
            out += "[^/]"
        elif end > 0:
            inner = glob[i + 1:end].replace("\\", "\\\\")
            out += "[" + ("^" + inner[1:] if inner[0] in "!^" else inner) + "]"
            i = end
        elif c == "{":
            out, depth = out + "(?:", depth + 1
        elif c == "}" and depth:
            out, depth = out + ")", depth - 1
        elif c == "," and depth:
            out += "|"
        else:
            out += re.escape(c)
        i += 1
    return f"^{out}$"


def list_files(
    spark: SparkSession, root: str, *, glob: str | None = None, recursive: bool = True,
) -> DataFrame:
    """Every file below ``root``: ``path`` relative to it, ``full_path``, ``size`` and ``modified``.

    Folders are listed in tasks, level by level: the folders of a level are dealt out to tasks, and what they hold is
    written to a table below the shared folder, whose folders are the next level. The driver learns how many there
    are, not which. A folder is listed by one task. Hidden files are left out, as scans leave them out.
    ``glob`` is for the names of files.
    """
    address, base = _qualified(spark, root)
    level = spark.range(1).select(F.lit(base).alias("path"))
    tasks, found = int(recursive), []
    if not recursive:
        found.append(level.mapInArrow(_list_folders(address), FOUND))
    widest = int(spark.conf.get("spark.sql.shuffle.partitions"))
    while tasks:
        folder = scratch_path(spark, "listing")
        level.repartition(min(tasks, widest)).mapInArrow(_list_folders(address), FOUND).write.parquet(folder)
        found.append(spark.read.schema(FOUND).parquet(folder))
        level = found[-1].where("folder").select("path")
        tasks = level.count()
    files = reduce(DataFrame.unionAll, found).where("not folder")
    if glob:
        files = files.where(F.substring_index("path", "/", -1).rlike(glob_pattern(glob)))
    start = len(base.rstrip("/")) + 2
    inside = F.startswith("path", F.lit(base.rstrip("/") + "/"))
    name = F.when(inside, F.substring("path", start, 1 << 30)).otherwise(F.substring_index("path", "/", -1))
    return files.select(name.alias("path"), F.col("path").alias("full_path"), "size", "modified")


def _scanned_path() -> Column:
    """The plain path of a scanned file. A plus sign is itself in a path."""
    key = F.regexp_replace(F.col("_metadata.file_path"), SCHEME_AND_HOST, "")
    return F.url_decode(F.replace(key, F.lit("+"), F.lit("%2B")))


def _reader(spark: SparkSession, fmt: str, recursive: bool, glob: str | None):
    out = spark.read.format(fmt).option("recursiveFileLookup", recursive)
    return out.option("pathGlobFilter", glob) if glob else out


def _hash_blocks(root: str):
    """The SHA-256 of each block of a file, read piece by piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = []
            for path, start, length in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                files, name = _open(_uri(root, path))
                state, left = hashlib.sha256(), length
                with files.open_input_file(name) as stream:
                    stream.seek(start)
                    while left:
                        piece = stream.read(min(READ_BYTES, left))
                        if not piece:
                            break
                        state.update(piece)
                        left -= len(piece)
                digests.append(None if left else state.hexdigest())  # the file has become shorter
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(digests, pa.string())], names=["full_path", "start", "digest"]
            )

    return run


def block_digests(spark: SparkSession, files: DataFrame, root: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``full_path`` and ``checksum`` of files of any size, from :func:`list_files` of ``root``.

    A file is cut into blocks at multiples of ``block_bytes``, whatever the splits; tasks hash blocks, a piece at a time, and
    the checksum is the SHA-256 of the blocks' digests in order, behind the block size. So a file is
    read by as many tasks as it has blocks, and exchanged parts change it. Null where a file has
    become shorter meanwhile.
    """
    address, _ = _qualified(spark, root)
    blocks = files.select("full_path", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(block_bytes).cast("long"))).alias("start"))
    blocks = blocks.select("full_path", "start", F.least(F.lit(block_bytes).cast("long"), F.col("size") - F.col("start")).alias("length"))
    blocks = blocks.repartition(F.col("full_path"), F.col("start"))
    hashed = blocks.mapInArrow(_hash_blocks(address), "full_path string, start long, digest string")
    parts = F.transform(F.array_sort(F.collect_list(F.struct("start", "digest"))), lambda x: x["digest"])
    whole = F.concat(F.lit(f"{block_bytes}:"), F.sha2(F.array_join(parts, "").cast("binary"), 256))
    return hashed.groupBy("full_path").agg(F.when(F.count("digest") == F.count(F.lit(1)), whole).alias("checksum"))


def file_manifest(
    spark: SparkSession,
    root: str,
    *,
    glob: str | None = None,
    recursive: bool = True,
    checksum: str | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per file below ``root``: ``path`` relative to it, ``size``, ``modified`` and,
    on request, a ``checksum``. Without one no file is opened.

    ``checksum="blocks"`` is for files of any size (:func:`block_digests`). ``checksum="content"`` is the SHA-256 of the bytes,
    as other tools give it; it brings each file into one task whole.
    ``checksum="lines"`` is for large text files, which it reads in splits: the number of lines
    and the sum of their hashes, as ``line_digest``. It does not tell the order of lines, so no
    plan takes it as proof of equal content.
    """
    if checksum not in (None, "blocks", "content", "lines"):
        raise ValueError("checksum is None, 'blocks', 'content' or 'lines'")
    files = list_files(spark, root, glob=glob, recursive=recursive)
    out = ["path", "size", "modified"]
    if checksum == "blocks":
        files = files.join(block_digests(spark, files, root, block_bytes), "full_path", "left")
        out.append("checksum")
    elif checksum == "content":
        scanned = _reader(spark, "binaryFile", recursive, glob).load(root)
        scanned = scanned.select(_scanned_path().alias("full_path"), F.sha2("content", 256).alias("found"))
        empty = F.when(F.col("size") == 0, F.sha2(F.lit(b""), 256))
        files = files.join(scanned, "full_path", "left").withColumn("checksum", F.coalesce("found", empty))
        out.append("checksum")
    elif checksum == "lines":
        hashed = F.sum(F.xxhash64("value").cast("decimal(20,0)"))
        lines = (
            _reader(spark, "text", recursive, glob)
            .option("lineSep", "\n")
            .load(root)
            .groupBy(_scanned_path().alias("full_path"))
            .agg(F.concat_ws(":", F.count(F.lit(1)), hashed.cast("string")).alias("digest"))
        )
        files = files.join(lines, "full_path", "left").withColumn("line_digest", F.coalesce("digest", F.lit("0:0")))
        out.append("line_digest")
    return files.select(*out)


def sync_plan(
    source: DataFrame, target: DataFrame, by: tuple[str, ...] = ("size", "checksum")
) -> DataFrame:
    """What a sync of ``source`` to ``target`` has to do, from their manifests.

    ``copy`` for files that are absent or differ in a column of ``by``. ``delete_source``, which
    may go once the copy has succeeded, only for files whose size and content ``checksum`` are
    known on both sides and equal, as is all else in ``by``. ``unknown`` for the rest: nothing tells the two apart, but nothing
    shows that they are the same. A path stands once in a manifest, so one left join does.
    """
    proof = {"size", "checksum"}
    sure = proof <= set(by) and proof <= set(source.columns) and proof <= set(target.columns)
    have = target.select(
        F.col("path"), *[F.col(quoted(c)).alias(f"_{c}") for c in by], F.lit(True).alias("_there")
    )
    same = [F.col(quoted(c)) == F.col(quoted(f"_{c}")) for c in by]
    differs, equal = F.lit(False), F.lit(sure)
    for test in same:
        differs = differs | F.coalesce(~test, F.lit(False))
        equal = equal & F.coalesce(test, F.lit(False))
    action = (
        F.when(F.col("_there").isNull() | differs, "copy").when(equal, "delete_source").otherwise("unknown")
    )
    return source.join(have, "path", "left").select(
        *[F.col(quoted(c)) for c in source.columns], action.alias("action")
    )


def file_row_counts(
    spark: SparkSession,
    root: str,
    header: int = 1,
    *,
    recursive: bool = False,
    glob: str | None = None,
) -> DataFrame:
    """Rows per file without its header lines: ``path``, ``file_name``, ``row_count``.

    Lines end at a line feed only, a last line without one counts, and empty files count 0.
    Large files are split over tasks and counted in parts.
    """
    lines = _reader(spark, "text", recursive, glob).option("lineSep", "\n").load(root)
    lines = lines.groupBy(_scanned_path().alias("full_path")).agg(F.count(F.lit(1)).alias("lines"))
    rows = F.greatest(F.coalesce("lines", F.lit(0)) - header, F.lit(0))
    files = list_files(spark, root, glob=glob, recursive=recursive)
    return files.join(lines, "full_path", "left").select(
        "path", F.substring_index("path", "/", -1).alias("file_name"), rows.cast("bigint").alias("row_count")
    )


def render_counts(counts: DataFrame) -> DataFrame:
    """Text lines ``name ====> n`` of :func:`file_row_counts`."""
    return counts.select(F.format_string("%s ====> %d", "file_name", "row_count").alias("value"))


def read_whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """``path`` and whole ``text`` of each file; for small files such as key material."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")
    )


def pem_blocks(df: DataFrame, col: str = "text") -> DataFrame:
    """One row per ``BEGIN x … END x`` block of a text column, other columns kept.

    Adds ``kind``, ``der_length`` and the SHA-256 ``fingerprint`` of the decoded bytes; a body
    that is not Base64 (blanks and line ends aside) gives nulls there. ``whole`` is false for a
    block without its end mark or with a label of other characters than A-Z, 0-9 and blank, whose
    values are nulls too. The text is cut at the begin marks and each piece at
    its end mark: plain searches, so that the work is linear in the text.
    """
    keep = [F.col(quoted(c)) for c in df.columns if c != col]
    pieces = F.split(F.col(quoted(col)), PEM_BEGIN)
    cut = df.select(*keep, F.explode(F.slice(pieces, 2, F.size(pieces))).alias("_piece"))
    named = cut.select(
        *keep,
        F.substring_index("_piece", PEM_DASHES, 1).alias("kind"),
        F.col("_piece"),
    )
    end = F.concat(F.lit(PEM_END), F.col("kind"), F.lit(PEM_DASHES))
    start = F.length("kind") + len(PEM_DASHES) + 1
    stop = F.instr("_piece", end)
    body = F.rtrim(F.substring("_piece", start, stop - start), F.lit(" \t\r\n"))
    whole = (stop > 0) & F.contains("_piece", F.lit(PEM_DASHES)) & F.col("kind").rlike("^[A-Z0-9 ]+$")
    kind = F.when(F.contains("_piece", F.lit(PEM_DASHES)), F.col("kind"))
    # The decoder passes over blanks, except after padding; only then are they taken out.
    decoded = F.try_to_binary("_body", F.lit("base64"))
    without_blanks = F.try_to_binary(F.regexp_replace("_body", r"\s", ""), F.lit("base64"))
    return (
        named.select(*keep, kind.alias("kind"), F.when(whole, body).alias("_body"), whole.alias("whole"))
        .select(*keep, "kind", "whole", F.coalesce(decoded, without_blanks).alias("_der"))
        .select(
            *keep,
            "kind",
            F.length("_der").alias("der_length"),
            F.sha2("_der", 256).alias("fingerprint"),
            "whole",
        )
    )


def object_path(col: Column | str, scheme: str = OBJECT_SCHEME, *, strict: bool = True) -> Column:
    """``scheme://bucket/object`` as a struct of ``bucket`` and ``object``.

    With ``strict`` a path of another scheme, or without an object part, fails the query;
    otherwise it gives a null struct.
    """
    path = F.col(col) if isinstance(col, str) else col
    rest = F.substring(path, F.lit(len(scheme) + 1), F.length(path))
    slash = F.instr(rest, "/")
    parts = F.struct(
        F.substring(rest, F.lit(1), slash - 1).alias("bucket"),
        F.substring(rest, slash + 1, F.length(rest)).alias("object"),
    )
    has_scheme = F.startswith(path, F.lit(scheme))
    if not strict:
        return F.when(has_scheme & (slash > 0), parts)
    return (
        F.when(path.isNull(), F.lit(None))
        .when(~has_scheme, F.raise_error(F.concat(F.lit(f"not a {scheme} path: "), path)))
        .when(slash == 0, F.raise_error(F.concat(F.lit("no object part: "), path)))
        .otherwise(parts)
    )
