"""Reader option tables and their checks.

A profile names the options a format takes. Options that Spark accepts only on write, or
accepts without effect on read, are listed too, so that a job that passes them is told.
"""

from __future__ import annotations

import difflib
import json
import warnings
from collections.abc import Mapping
from dataclasses import dataclass, field

# Fixed values from here on: the option names that readers take.
FILE_OPTIONS = (
    "pathGlobFilter",
    "recursiveFileLookup",
    "modifiedBefore",
    "modifiedAfter",
    "basePath",
    "ignoreMissingFiles",
    "ignoreCorruptFiles",
)
MODES = ("PERMISSIVE", "DROPMALFORMED", "FAILFAST")
REBASE_MODES = ("EXCEPTION", "CORRECTED", "LEGACY")


@dataclass(frozen=True)
class Profile:
    """What a reader takes: option names, defaults, and how they may be combined."""

    fmt: str
    options: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    one_of: tuple[str, ...] = ()
    write_only: tuple[str, ...] = ()
    ignored: tuple[str, ...] = ()
    prefixes: tuple[str, ...] = ()
    stream_only: tuple[str, ...] = ()
    defaults: Mapping[str, str] = field(default_factory=dict)
    choices: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    renamed: Mapping[str, str] = field(default_factory=dict)  # older names, whole or as prefix
    needs_path: bool = True
    package: str | None = None

    def names(self) -> tuple[str, ...]:
        own = self.options + self.required + self.one_of + self.stream_only
        return own + (FILE_OPTIONS if self.needs_path else ())


PROFILES = {
    p.fmt: p
    for p in (
        Profile(
            "csv",
            options=(
                "header", "inferSchema", "delimiter", "sep", "quote", "escape", "multiLine",
                "encoding", "nullValue", "dateFormat", "timestampFormat",
                "timestampNTZFormat", "mode", "comment", "ignoreLeadingWhiteSpace",
                "ignoreTrailingWhiteSpace", "maxCharsPerColumn", "columnNameOfCorruptRecord",
                "enforceSchema", "lineSep",
            ),
            choices={"mode": MODES},
        ),
        Profile(
            "parquet",
            options=("mergeSchema", "datetimeRebaseMode", "int96RebaseMode"),
            choices={"datetimeRebaseMode": REBASE_MODES, "int96RebaseMode": REBASE_MODES},
        ),
        Profile(
            "json",
            options=(
                "multiLine", "primitivesAsString", "allowComments",
                "allowUnquotedFieldNames", "allowSingleQuotes", "mode",
                "columnNameOfCorruptRecord", "encoding", "dateFormat", "timestampFormat",
                "timestampNTZFormat", "dropFieldIfAllNull", "samplingRatio", "lineSep",
            ),
            choices={"mode": MODES},
        ),
        Profile(
            "avro",
            options=("avroSchema", "ignoreExtension", "mode", "datetimeRebaseMode"),
            write_only=("recordName", "recordNamespace", "compression"),
            choices={"mode": MODES, "datetimeRebaseMode": REBASE_MODES},
            package="org.apache.spark:spark-avro_2.13",
        ),
        Profile(
            "jdbc",
            options=(
                "user", "password", "driver", "fetchsize", "partitionColumn", "lowerBound",
                "upperBound", "numPartitions", "sessionInitStatement", "pushDownPredicate",
                "customSchema", "queryTimeout",
            ),
            required=("url",),
            one_of=("dbtable", "query"),
            write_only=("isolationLevel",),
            defaults={"fetchsize": "1000"},
            needs_path=False,
        ),
        Profile(
            "mongodb",
            options=(
                "readPreference.name", "partitioner", "aggregation.pipeline",
            ),
            required=("connection.uri", "database", "collection"),
            prefixes=("partitioner.options.", "spark.mongodb.read."),
            renamed={
                "uri": "connection.uri", "pipeline": "aggregation.pipeline",
                "partitionerOptions.": "partitioner.options.",
            },
            needs_path=False,
            package="org.mongodb.spark:mongo-spark-connector_2.13",
        ),
        Profile(
            "orc",
            options=("mergeSchema",),
            ignored=("datetimeRebaseMode",),
        ),
        Profile(
            "xml",
            options=(
                "attributePrefix", "valueTag", "charset", "encoding",
                "ignoreSurroundingSpaces", "excludeAttribute", "mode", "inferSchema",
                "rowValidationXSDPath", "columnNameOfCorruptRecord", "nullValue",
                "dateFormat", "timestampFormat", "timestampNTZFormat", "samplingRatio",
                "multiLine",
            ),
            required=("rowTag",),
            write_only=("rootTag",),
            choices={"mode": MODES},
        ),
        Profile("text", options=("lineSep", "wholetext", "encoding")),
        Profile("binaryFile"),
        Profile(
            "kafka",
            options=(
                "startingOffsets", "endingOffsets", "failOnDataLoss", "minPartitions",
                "fetchOffset.numRetries", "fetchOffset.retryIntervalMs", "includeHeaders",
                "startingTimestamp", "endingTimestamp", "groupIdPrefix",
            ),
            required=("kafka.bootstrap.servers",),
            one_of=("subscribe", "assign", "subscribePattern"),
            stream_only=("maxOffsetsPerTrigger", "minOffsetsPerTrigger", "maxTriggerDelay"),
            prefixes=("kafka.",),
            needs_path=False,
            package="org.apache.spark:spark-sql-kafka-0-10_2.13",
        ),
    )
}


class OptionError(ValueError):
    """An option is missing, unknown, or at odds with another."""


def _text(value) -> str:
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (dict, list)):
        return json.dumps(value)
    return str(value)


def profile(fmt: str) -> Profile:
    for name, found in PROFILES.items():
        if name.lower() == fmt.lower():
            return found
    raise OptionError(f"no reader profile for format {fmt!r}; known: {', '.join(PROFILES)}")


def _current(prof: Profile, name: str) -> str:
    """The name the connector knows today for an older one."""
    for old, new in prof.renamed.items():
        if old.endswith(".") and name.lower().startswith(old.lower()):
            return new + name[len(old):]
        if name.lower() == old.lower():
            return new
    return name


def check_options(fmt: str, given: Mapping, *, stream: bool = False) -> dict[str, str]:
    """Check ``given`` against the profile of ``fmt`` and return it in reader form.

    Names match without regard to case. Write-only and effect-free options are dropped with a
    warning; unknown names, missing ones and bad combinations raise :class:`OptionError`.
    """
    prof = profile(fmt)
    known = {n.lower(): n for n in prof.names()}
    out: dict[str, str] = dict(prof.defaults)
    for name, value in given.items():
        if value is None:
            continue
        name = _current(prof, name)
        low = name.lower()
        if low in known:
            if known[low] in prof.stream_only and not stream:
                raise OptionError(f"{prof.fmt}: {name} applies to streams only")
            out[known[low]] = _text(value)
        elif any(low == n.lower() for n in prof.write_only):
            warnings.warn(f"{prof.fmt}: {name} is a write option, left out", stacklevel=3)
        elif any(low == n.lower() for n in prof.ignored):
            warnings.warn(f"{prof.fmt}: {name} has no effect on read, left out", stacklevel=3)
        elif any(low.startswith(p.lower()) for p in prof.prefixes):
            out[name] = _text(value)
        else:
            near = difflib.get_close_matches(low, known, n=1)
            hint = f"; did you mean {known[near[0]]}?" if near else ""
            raise OptionError(f"{prof.fmt}: unknown option {name}{hint}")

    for name in prof.required:
        if not out.get(name):
            raise OptionError(f"{prof.fmt}: option {name} is required")
    if prof.one_of:
        chosen = [n for n in prof.one_of if out.get(n)]
        if len(chosen) != 1:
            raise OptionError(f"{prof.fmt}: give exactly one of {', '.join(prof.one_of)}")
    for name, allowed in prof.choices.items():
        if name in out and out[name].upper() not in allowed:
            raise OptionError(f"{prof.fmt}: {name} must be one of {', '.join(allowed)}")
    if prof.fmt == "jdbc":
        _check_jdbc(out)
    if prof.fmt == "kafka":
        _check_kafka(out, stream)
    return out


def _check_jdbc(out: Mapping[str, str]) -> None:
    bounds = ("partitionColumn", "lowerBound", "upperBound")
    present = [n for n in bounds if n in out]
    if not present:
        return
    missing = [n for n in (*bounds, "numPartitions") if n not in out]
    if missing:
        raise OptionError(f"jdbc: a partitioned read also needs {', '.join(missing)}")
    if "query" in out:
        raise OptionError("jdbc: a partitioned read takes dbtable, not query")


def _check_kafka(out: Mapping[str, str], stream: bool) -> None:
    if stream:
        if "endingOffsets" in out:
            raise OptionError("kafka: endingOffsets applies to batch reads only")
        return
    for name, word, number in (
        ("startingOffsets", "latest", -1), ("endingOffsets", "earliest", -2)
    ):
        value = out.get(name, "").strip()
        if value.startswith("{"):
            parts = [o for topic in json.loads(value).values() for o in topic.values()]
            banned = number in parts
        else:
            banned = value.lower() == word
        if banned:
            side = "start at" if name == "startingOffsets" else "end at"
            raise OptionError(f"kafka: a batch read cannot {side} {word}")
