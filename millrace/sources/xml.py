"""XML files read in splits: a file of any size is cut at the closing tags of its records."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from millrace.operators.shapes import quoted
from millrace.sources.options import OptionError, check_options

# Sections whose content is no markup, and their marks.
SECTION = r"(?s)<!\[CDATA\[.*?\]\]>|<!--.*?-->"
MARKS = r"<!--|-->|<!\[CDATA\[|\]\]>"
COMMENT_ONLY = r"(?s)(<!\[CDATA\[.*?\]\]>)|<!--.*?-->"
ATTRIBUTES = r"""(?:[^<>"'/]|"[^"]*+"|'[^']*+'|/(?!>))*+"""
OWN_OPTIONS = ("rowTag", "pathGlobFilter", "recursiveFileLookup")


def _pieces(spark: SparkSession, path, tag: str, files: Mapping[str, str]) -> DataFrame:
    """What stands between closing tags, in order: ``file, start, seq, pos, text``."""
    reader = spark.read.options(**files).option("lineSep", f"</{tag}>")
    lines = reader.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("seq"), "value",
    )
    # A closing tag may have blanks before its end.
    return lines.select("file", "start", "seq", F.posexplode(F.split("value", rf"</{re.escape(tag)}\s+>")).alias("pos", "text"))


def _is_cut() -> Column:
    """Whether a section begins or ends in the piece that does not do both there."""
    rest = F.regexp_replace("text", SECTION, "")
    return (F.contains("text", F.lit("<!")) | F.contains("text", F.lit("]]>")) | F.contains("text", F.lit("-->"))) & rest.rlike(MARKS)


def _state(text: str, state: str | None) -> str | None:
    """The mark that ends the section a piece ends in, from the one it begins in."""
    at = 0
    while True:
        if state is not None:
            at = text.find(state, at)
            if at < 0:
                return state
            at += 3
            state = None
        found = re.compile(r"<!--|<!\[CDATA\[").search(text, at)
        if found is None:
            return None
        at, state = found.end(), "-->" if found[0] == "<!--" else "]]>"


def _glued(tag: str):
    """Pieces of a file in order; those cut within a section are put together again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, held, state = None, [], None
        for batch in batches:
            done = []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if name != file:
                    if held:
                        done.append(f"</{tag}>".join(held))
                    file, held, state = name, [], None
                state = _state(text, state)
                held.append(text)
                if state is None:
                    done.append(f"</{tag}>".join(held))
                    held = []
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], names=["text"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([f"</{tag}>".join(held)], pa.string())], names=["text"])

    return run


def _records(pieces: DataFrame, tag: str) -> DataFrame:
    """One element text per record: an opened one up to the piece's end, closed ones before it."""
    name = re.escape(tag)
    opened, closed = rf"<{name}(?:\s{ATTRIBUTES})?>", rf"<{name}(?:\s{ATTRIBUTES})?/>"
    text = F.when(F.contains("text", F.lit("<!--")), F.regexp_replace("text", COMMENT_ONLY, "$1")).otherwise(F.col("text"))
    found = pieces.select(text.alias("text")).withColumn("at", F.regexp_instr("text", F.lit(opened)))
    before = F.when(F.col("at") > 0, F.substring("text", F.lit(1), F.col("at") - 1)).otherwise(F.col("text"))
    alone = F.when(F.contains("text", F.lit("/>")), F.regexp_extract_all(before, F.lit(closed), F.lit(0)))
    whole = F.when(F.col("at") > 0, F.array(F.concat(F.substring("text", F.col("at"), F.length("text")), F.lit(f"</{tag}>"))))
    none = F.array().cast("array<string>")
    return found.select(F.explode(F.concat(F.coalesce(alone, none), F.coalesce(whole, none))).alias("record"))


def read_xml_split(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | str,
    options: Mapping | None = None,
    *,
    tags_in_sections: bool | None = None,
    **kwargs,
) -> DataFrame:
    """The records of XML files as the built-in reader gives them, with each file read by as many tasks as it has splits.

    Options are those of the built-in reader (``rowTag`` is required). The text is cut at the closing tags of the
    records; what stands before a record's opening tag (prolog, comments, tags of parents) and behind the last one is
    left aside, and records that are closed at once (``<tag/>``) are taken too. Each record is parsed by itself.

    Closing tags within CDATA sections and comments are no ends of records. Files that have such (or
    ``tags_in_sections``, which spares the pass that looks for them) have their pieces put together in order, each file by one task as
    a stream; their parsing is spread again. Records must not hold elements of their own tag, and files are UTF-8.
    A record that its file ends in is malformed. An empty file has no records.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    settings = check_options("xml", {**(options or {}), **kwargs})
    tag = settings.get("rowTag")
    if not tag:
        raise OptionError("xml: rowTag is required")
    if settings.get("charset", settings.get("encoding", "UTF-8")).upper() != "UTF-8":
        raise OptionError("xml: files read in splits are UTF-8")
    files = {k: v for k, v in settings.items() if k in OWN_OPTIONS[1:]}
    target = path if isinstance(path, str) else list(path)
    pieces = _pieces(spark, target, tag, files)
    text = pieces.select("text")
    if tags_in_sections is not False:
        cut = pieces.where(_is_cut()).select("file").distinct()
        if tags_in_sections or not cut.isEmpty():
            order = pieces.join(cut, "file", "left_semi").repartition("file").sortWithinPartitions("file", "start", "seq", "pos")
            glued = order.select("file", "text").mapInArrow(_glued(tag), "text string").hint("rebalance")
            text = pieces.join(cut, "file", "left_anti").select("text").unionAll(glued)
    records = _records(text, tag)

    parse = {k: v for k, v in settings.items() if k not in OWN_OPTIONS}
    mode = parse.get("mode", "PERMISSIVE").upper()
    corrupt = parse.get("columnNameOfCorruptRecord", "_corrupt_record")
    own = corrupt in schema.fieldNames()
    full = schema
    if mode == "DROPMALFORMED":
        parse["mode"], parse["columnNameOfCorruptRecord"] = "PERMISSIVE", corrupt
        full = schema if own else StructType([*schema.fields, StructField(corrupt, StringType())])
    rows = records.select(F.inline(F.array(F.from_xml("record", full, parse))))
    if mode == "DROPMALFORMED":
        rows = rows.where(F.col(quoted(corrupt)).isNull())
    return rows.select(*[F.col(quoted(f.name)) for f in schema.fields])
