"""Avro payloads without a connector: a batch of rows is decoded field by field, in columns.

Every row has a place in the batch's bytes. A field is read for all rows at once, which moves their
places on, so the work per field is a few array operations, whatever the number of rows. Items of
arrays and maps are read in rounds: the first item of all rows, then the second, and so on.
Writer schemas are resolved to a reader schema: fields by name or alias, defaults, promotions.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from millrace.sources.schemas import AVRO_PRIMITIVES, avro_to_struct

# What a writer's type may be read as, besides itself.
PROMOTIONS = {
    "int": ("long", "float", "double"), "long": ("float", "double"), "float": ("double",),
    "string": ("bytes",), "bytes": ("string",),
}
MILLIS_LIMIT = (1 << 63) // 1000
NOTHING = object()


class Unresolvable(ValueError):
    """A writer's type that cannot be read as the reader's."""


@dataclass
class Node:
    """One schema node with all named types put in place."""

    kind: str
    logical: str | None = None
    precision: int = 0
    scale: int = 0
    size: int = 0
    symbols: list[str] = field(default_factory=list)
    fields: list[Field] = field(default_factory=list)
    parts: list[Node] = field(default_factory=list)  # item, value or branches
    default: object = NOTHING

    def spark_type(self) -> T.DataType:
        return avro_to_struct(json.dumps({"type": "record", "name": "x", "fields": [{"name": "x", "type": self.text()}]}))["x"].dataType

    def text(self):
        """The node as a schema again."""
        if self.kind == "union":
            return [p.text() for p in self.parts]
        out = {"type": self.kind}
        if self.kind == "record":
            out |= {"name": f"r{id(self)}", "fields": [{"name": f.name, "type": f.node.text()} for f in self.fields]}
        elif self.kind == "array":
            out["items"] = self.parts[0].text()
        elif self.kind == "map":
            out["values"] = self.parts[0].text()
        elif self.kind in ("enum", "fixed"):
            out |= {"name": f"n{id(self)}", "symbols": self.symbols, "size": self.size}
        if self.logical:
            out |= {"logicalType": self.logical, "precision": self.precision, "scale": self.scale}
        elif self.kind in AVRO_PRIMITIVES:
            return self.kind
        return out


@dataclass
class Field:
    name: str
    aliases: list[str]
    node: Node
    default: object = NOTHING


def read_schema(text: str) -> Node:
    """The tree of an Avro schema given as JSON text."""
    return _node(json.loads(text), {}, "")


def _node(node, named: dict[str, Node | None], space: str) -> Node:
    if isinstance(node, list):
        return Node("union", parts=[_node(n, named, space) for n in node])
    if isinstance(node, str):
        if node in AVRO_PRIMITIVES:
            return Node(node)
        for name in (f"{space}.{node}" if space else node, node):
            if name in named:
                if named[name] is None:
                    raise ValueError(f"the Avro type {name!r} holds itself")
                return named[name]
        raise ValueError(f"unknown Avro type {node!r}")
    kind = node["type"]
    if not isinstance(kind, str) or (kind not in AVRO_PRIMITIVES and kind not in ("record", "enum", "fixed", "array", "map")):
        return _node(kind, named, space)
    out = Node(kind, node.get("logicalType"), int(node.get("precision", 0)), int(node.get("scale", 0)))
    if kind in ("record", "enum", "fixed"):
        name, space = node["name"], node.get("namespace", space)
        full = name if "." in name or not space else f"{space}.{name}"
        space = full.rpartition(".")[0]
        named[full] = None
        if kind == "record":
            for f in node["fields"]:
                out.fields.append(Field(f["name"], f.get("aliases", []), _node(f["type"], named, space), f.get("default", NOTHING)))
        out.symbols, out.size, out.default = node.get("symbols", []), int(node.get("size", 0)), node.get("default", NOTHING)
        named[full] = out
    elif kind in ("array", "map"):
        out.parts = [_node(node["items" if kind == "array" else "values"], named, space)]
    return out


class Rows:
    """A batch's bytes, and where each row stands in them."""

    def __init__(self, column: pa.Array) -> None:
        column = column.cast(pa.binary())
        _, ends, data = column.buffers()
        places = np.frombuffer(ends, np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
        self.bytes = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(1, np.uint8)
        self.at, self.end = places[:-1].copy(), places[1:]
        self.ok = np.ones(len(column), bool)

    def fail(self, rows: np.ndarray) -> None:
        self.ok[rows] = False

    def longs(self, rows: np.ndarray) -> np.ndarray:
        """A zig-zag number of up to ten bytes per row."""
        value, live = np.zeros(len(rows), np.uint64), np.arange(len(rows))
        for shift in range(0, 70, 7):
            inside = self.at[rows[live]] < self.end[rows[live]]
            self.fail(rows[live[~inside]])
            live = live[inside]
            byte = self.bytes[self.at[rows[live]]]
            self.at[rows[live]] += 1
            value[live] |= (byte & 0x7F).astype(np.uint64) << np.uint64(shift)
            live = live[byte >= 0x80]
            if not len(live):
                break
        self.fail(rows[live])
        return (value >> np.uint64(1)).view(np.int64) ^ -(value & np.uint64(1)).view(np.int64)

    def spans(self, rows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and lengths of so many bytes per row; none where they are not there."""
        fits = (lengths >= 0) & (lengths <= self.end[rows] - self.at[rows])
        self.fail(rows[~fits])
        lengths = np.where(fits, lengths, 0)
        starts = self.at[rows]
        self.at[rows] += lengths
        return starts, lengths

    def gather(self, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        shift = starts - (np.cumsum(lengths) - lengths)
        return self.bytes[np.repeat(shift, lengths) + np.arange(int(lengths.sum()))]

    def fixed(self, rows: np.ndarray, size: int) -> np.ndarray:
        """``size`` bytes per row, as a row of an array; zeros where they are not there."""
        starts, lengths = self.spans(rows, np.full(len(rows), size))
        out = np.zeros((len(rows), size), np.uint8)
        there = lengths == size
        out[there] = self.bytes[starts[there, None] + np.arange(size)]
        return out


Decoder = Callable[[Rows, np.ndarray], pa.Array]


def _text(found: pa.Array, rows: Rows, where: np.ndarray) -> pa.Array:
    try:
        return found.cast(pa.string())
    except pa.ArrowInvalid:
        values = found.to_pylist()
        for i, value in enumerate(values):
            try:
                values[i] = value.decode()
            except UnicodeDecodeError:
                rows.fail(where[i:i + 1])
                values[i] = ""
        return pa.array(values, pa.string())


def _binary(rows: Rows, where: np.ndarray, lengths: np.ndarray) -> pa.Array:
    starts, lengths = rows.spans(where, lengths)
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(where), [None, pa.py_buffer(ends), pa.py_buffer(rows.gather(starts, lengths))])


def _decimals(rows: Rows, where: np.ndarray, starts: np.ndarray, lengths: np.ndarray, node: Node) -> pa.Array:
    """Big-endian two's complement of at most 16 bytes; a longer or too large number fails its row."""
    long = lengths > 16
    rows.fail(where[long | (lengths == 0)])
    lengths = np.where(long, 0, lengths)
    there = lengths > 0
    low = np.zeros((len(where), 16), np.uint8)
    last = starts + lengths - 1
    for i in range(16):
        inside = i < lengths
        low[inside, i] = rows.bytes[last[inside] - i]
    sign = np.zeros(len(where), bool)
    sign[there] = rows.bytes[starts[there]] >= 0x80
    low[sign[:, None] & (np.arange(16) >= lengths[:, None])] = 0xFF
    whole = pa.Array.from_buffers(pa.decimal128(38, node.scale), len(where), [None, pa.py_buffer(low)])
    limit = 10 ** node.precision
    parts = low.view(np.int64).reshape(-1, 2)
    large = ~((parts[:, 1] == 0) & (parts[:, 0] >= 0) | (parts[:, 1] == -1) & (parts[:, 0] < 0))
    if limit < 1 << 63:
        large |= np.abs(parts[:, 0]) >= limit
    else:  # rare: compare the few that take more than eight bytes one by one
        for i in np.flatnonzero(large):
            number = (int(parts[i, 1]) << 64) + (int(parts[i, 0]) & ((1 << 64) - 1))
            large[i] = abs(number) >= limit
    rows.fail(where[large])
    whole = whole.take(pa.array(np.arange(len(where)), mask=large))
    return whole.cast(pa.decimal128(node.precision, node.scale))


def _numbers(kind: str) -> Decoder:
    def run(rows: Rows, where: np.ndarray) -> pa.Array:
        if kind in ("int", "long"):
            found = rows.longs(where)
            if kind == "int":
                wide = (found < -(1 << 31)) | (found >= 1 << 31)
                rows.fail(where[wide])
                found = np.where(wide, 0, found).astype(np.int32)
            return pa.array(found)
        if kind == "boolean":
            found = rows.fixed(where, 1)[:, 0]
            rows.fail(where[found > 1])
            return pa.array(found == 1)
        size = 4 if kind == "float" else 8
        return pa.array(rows.fixed(where, size).view(f"<f{size}")[:, 0].copy())

    return run


def _as_reader(kind: str, reader: Node, read: Decoder) -> Decoder:
    """Values of a plain writer's type as the reader's, with its logical type."""
    if kind != reader.kind and reader.kind not in PROMOTIONS.get(kind, ()):
        raise Unresolvable(f"{kind} cannot be read as {reader.kind}")
    target = to_arrow_type(reader.spark_type())

    def run(rows: Rows, where: np.ndarray) -> pa.Array:
        found = read(rows, where)
        if reader.kind == "string" and found.type == pa.binary():
            return _text(found, rows, where)
        if reader.kind == "bytes":
            return found.cast(pa.binary())
        if pa.types.is_timestamp(target):
            ticks = found.cast(pa.int64()).to_numpy()
            if reader.logical.endswith("millis"):
                wide = np.abs(ticks) >= MILLIS_LIMIT
                rows.fail(where[wide])
                ticks = np.where(wide, 0, ticks) * 1000
            return pa.array(ticks).cast(target)
        return found.cast(target, safe=False)

    return run


def _union(writer: Node, reader: Node) -> Decoder:
    target = to_arrow_type(reader.spark_type())
    branches: list[Decoder | None] = []
    for part in writer.parts:
        try:
            branches.append(resolve(part, reader))
        except Unresolvable:
            branches.append(None)
    if not any(branches):
        raise Unresolvable("no branch of the union can be read")

    def run(rows: Rows, where: np.ndarray) -> pa.Array:
        chosen = rows.longs(where)
        parts, index, size = [], np.zeros(len(where), np.int64), 0
        absent = np.ones(len(where), bool)
        for i, branch in enumerate(branches):
            mine = np.flatnonzero(chosen == i)
            if not len(mine):
                continue
            if branch is None:
                rows.fail(where[mine])
                continue
            parts.append(branch(rows, where[mine]))
            index[mine] = size + np.arange(len(mine))
            absent[mine] = False
            size += len(mine)
        rows.fail(where[(chosen < 0) | (chosen >= len(branches))])
        if not parts:
            return pa.nulls(len(where), target)
        return pa.concat_arrays(parts).take(pa.array(index, mask=absent))

    return run


def _into_union(writer: Node, reader: Node) -> Decoder:
    """A writer's type that is no union, read as the first branch that takes it."""
    rest = [p for p in reader.parts if p.kind != "null"]
    target = to_arrow_type(reader.spark_type())
    if writer.kind == "null":
        if len(rest) == len(reader.parts):
            raise Unresolvable("null where the reader has none")
        return lambda rows, where: pa.nulls(len(where), target)
    if len(rest) == 1:
        return resolve(writer, rest[0])
    for same in (True, False):
        for i, part in enumerate(rest):
            if same and part.kind != writer.kind:
                continue
            try:
                read = resolve(writer, part)
            except Unresolvable:
                continue
            if not pa.types.is_struct(target) or not target.num_fields or target.field(0).name != "member0":
                return lambda rows, where, read=read: read(rows, where).cast(target)

            def run(rows: Rows, where: np.ndarray, i=i, read=read) -> pa.Array:
                members = [pa.nulls(len(where), f.type) for f in target]
                members[i] = read(rows, where)
                return pa.StructArray.from_arrays(members, fields=list(target))

            return run
    raise Unresolvable(f"{writer.kind} fits no branch of the reader's union")


def _record(writer: Node, reader: Node) -> Decoder:
    target = to_arrow_type(reader.spark_type())
    wanted = {}
    for i, f in enumerate(reader.fields):
        name = next((n for n in (f.name, *f.aliases) if any(w.name == n for w in writer.fields)), None)
        if name is not None:
            wanted[name] = i
        elif f.default is NOTHING:
            raise Unresolvable(f"the writer has no field {f.name!r}, and there is no default")
    steps = []
    for w in writer.fields:
        i = wanted.get(w.name)
        steps.append((i, resolve(w.node, w.node if i is None else reader.fields[i].node)))
    defaults = {i: _default(f.node, f.default) for i, f in enumerate(reader.fields) if i not in wanted.values()}

    def run(rows: Rows, where: np.ndarray) -> pa.Array:
        columns: list = [None] * len(reader.fields)
        for i, read in steps:
            found = read(rows, where)
            if i is not None:
                columns[i] = found
        for i, value in defaults.items():
            columns[i] = pa.array([value], target.field(i).type).take(pa.array(np.zeros(len(where), np.int64)))
        if not columns:
            return pa.array([{}] * len(where), target)
        return pa.StructArray.from_arrays(columns, fields=list(target))

    return run


def _default(node: Node, value):
    """A default of the schema's JSON as a Python value. That of a union is of its first branch."""
    if node.kind == "union":
        return _default(node.parts[0], value)
    if node.kind == "record":
        return {f.name: _default(f.node, value.get(f.name, f.default)) for f in node.fields}
    if node.kind == "array":
        return [_default(node.parts[0], v) for v in value]
    if node.kind == "map":
        return [(k, _default(node.parts[0], v)) for k, v in value.items()]
    if node.kind in ("bytes", "fixed"):
        raw = value.encode("latin-1")
        if node.logical == "decimal":
            import decimal

            return decimal.Decimal(int.from_bytes(raw, "big", signed=True)).scaleb(-node.scale)
        return raw
    return value


def _items(writer: Node, reader: Node) -> Decoder:
    """Items of arrays and entries of maps."""
    value = resolve(writer.parts[0], reader.parts[0])
    key = _as_reader("string", Node("string"), lambda rows, where: _binary(rows, where, rows.longs(where)))
    reads = [key, value] if writer.kind == "map" else [value]
    target = to_arrow_type(reader.spark_type())
    kinds = [target.key_type, target.item_type] if writer.kind == "map" else [target.value_type]

    def next_block(rows: Rows, where: np.ndarray) -> np.ndarray:
        counts = rows.longs(where)
        rows.longs(where[counts < 0])  # a negative count has the block's size behind it
        counts = np.abs(counts)
        wide = counts > rows.end[where] - rows.at[where]
        rows.fail(where[wide])
        return np.where(wide | ~rows.ok[where], 0, counts)

    def run(rows: Rows, where: np.ndarray) -> pa.Array:
        live, left = np.arange(len(where)), next_block(rows, where)
        owners, parts = [], [[] for _ in reads]
        live = live[left > 0]
        while len(live):
            owners.append(live)
            for out, read in zip(parts, reads, strict=True):
                out.append(read(rows, where[live]))
            left[live] -= 1
            empty = live[left[live] == 0]
            left[empty] = next_block(rows, where[empty])
            live = live[(left[live] > 0) & rows.ok[where[live]]]
        owner = np.concatenate([np.empty(0, np.int64), *owners]).astype(np.int64)
        order = pa.array(np.argsort(owner, kind="stable"))
        columns = [
            (pa.concat_arrays(out) if out else pa.nulls(0, kind)).take(order).cast(kind)
            for out, kind in zip(parts, kinds, strict=True)
        ]
        ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(where)))]).astype(np.int32)
        if writer.kind == "map":
            return pa.MapArray.from_arrays(pa.array(ends), *columns).cast(target)
        return pa.ListArray.from_arrays(pa.array(ends), columns[0]).cast(target)

    return run


def _enum(writer: Node, reader: Node) -> Decoder:
    if reader.kind not in ("enum", "string"):
        raise Unresolvable(f"enum cannot be read as {reader.kind}")
    symbols = pa.array(writer.symbols, pa.string())
    known = np.array([reader.kind == "string" or s in reader.symbols for s in writer.symbols], bool)

    def run(rows: Rows, where: np.ndarray) -> pa.Array:
        index = rows.longs(where)
        wild = (index < 0) | (index >= len(symbols))
        index = np.where(wild, 0, index)
        found = symbols.take(pa.array(index))
        new = ~known[index] & ~wild
        if new.any() and reader.default is not NOTHING:
            import pyarrow.compute as pc

            found = pc.if_else(pa.array(new), pa.scalar(reader.default, pa.string()), found)
            new[:] = False
        rows.fail(where[wild | new])
        return found

    return run


def resolve(writer: Node, reader: Node) -> Decoder:
    """The decoder of what ``writer`` describes, to columns of the Spark type of ``reader``."""
    if writer.kind == "union":
        return _union(writer, reader)
    if reader.kind == "union":
        return _into_union(writer, reader)
    if writer.kind == "null":
        if reader.kind != "null":
            raise Unresolvable(f"null cannot be read as {reader.kind}")
        return lambda rows, where: pa.nulls(len(where))
    if writer.kind == "enum":
        return _enum(writer, reader)
    if writer.kind in ("record", "array", "map"):
        if reader.kind != writer.kind:
            raise Unresolvable(f"{writer.kind} cannot be read as {reader.kind}")
        return _record(writer, reader) if writer.kind == "record" else _items(writer, reader)
    if writer.kind in ("bytes", "fixed"):
        fixed = writer.kind == "fixed"
        if fixed and (reader.kind != "fixed" or reader.size != writer.size):
            raise Unresolvable("fixed types differ")

        def lengths(rows: Rows, where: np.ndarray) -> np.ndarray:
            return np.full(len(where), writer.size) if fixed else rows.longs(where)

        if reader.logical == "decimal":
            if writer.logical == "decimal" and writer.scale != reader.scale:
                raise Unresolvable("decimals differ in scale")
            return lambda rows, where: _decimals(rows, where, *rows.spans(where, lengths(rows, where)), reader)
        read: Decoder = lambda rows, where: _binary(rows, where, lengths(rows, where))
        return read if fixed else _as_reader("bytes", reader, read)
    if writer.kind == "string":
        return _as_reader("string", reader, lambda rows, where: _binary(rows, where, rows.longs(where)))
    return _as_reader(writer.kind, reader, _numbers(writer.kind))


def decode_column(column: pa.Array, decoder: Decoder) -> tuple[pa.Array, np.ndarray]:
    """Decoded rows, null where the bytes are null or do not fit; and which rows fit."""
    rows = Rows(column)
    present = np.flatnonzero(~column.is_null().to_numpy(zero_copy_only=False))
    found = decoder(rows, present)
    ok = rows.ok & (rows.at == rows.end)
    index, absent = np.zeros(len(column), np.int64), np.ones(len(column), bool)
    index[present] = np.arange(len(present))
    absent[present] = ~ok[present]
    fits = np.ones(len(column), bool)
    fits[present] = ok[present]
    return found.take(pa.array(index, mask=absent)), fits


def decode_avro_bytes(
    df: DataFrame, writer: str, reader: str | None = None, *, col: str = "value", name: str = "avroData",
    ok_col: str | None = None,
) -> DataFrame:
    """``df`` with the Avro bytes of ``col`` as the struct ``name`` of the reader's schema.

    Without ``reader`` the writer's schema is the reader's. Fields are matched by name or the reader's aliases;
    fields the writer lacks take the reader's default; ints are read as longs, floats and doubles, and text and bytes as
    one another. ``ok_col`` (``<name>_ok``) is false for bytes that do not fit the schema or go on behind it; their
    struct is null. Null bytes give a null struct and are no error. A schema that holds itself is refused.
    """
    target = read_schema(reader or writer)
    if target.kind != "record":
        raise ValueError("the Avro schema is not a record")
    resolve(read_schema(writer), target)  # tells now rather than in a task what cannot be read
    schema = T.StructType([
        *df.schema.fields, T.StructField(name, avro_to_struct(reader or writer)), T.StructField(ok_col or f"{name}_ok", T.BooleanType()),
    ])
    names = schema.fieldNames()
    place = df.columns.index(col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = resolve(read_schema(writer), target)
        for batch in batches:
            found, ok = decode_column(batch.column(place), decoder)
            yield pa.RecordBatch.from_arrays([*batch.columns, found, pa.array(ok)], names=names)

    return df.mapInArrow(run, nullable(schema))


def nullable(schema: T.StructType) -> T.StructType:
    """The same columns, none of them (nor any field within) declared NOT NULL."""

    def loose(kind: T.DataType) -> T.DataType:
        if isinstance(kind, T.StructType):
            return T.StructType([T.StructField(f.name, loose(f.dataType), True) for f in kind.fields])
        if isinstance(kind, T.ArrayType):
            return T.ArrayType(loose(kind.elementType), True)
        if isinstance(kind, T.MapType):
            return T.MapType(kind.keyType, loose(kind.valueType), True)
        return kind

    return loose(schema)


def _varint(value: int) -> bytes:
    value = (value << 1) ^ (value >> 63)
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    out.append(value)
    return bytes(out)


def _write(node: Node, value, out: bytearray) -> None:
    """Append one value. Of a union, the first branch that a value of this kind can be is taken."""
    kind = node.kind
    if kind == "union":
        null = value is None
        branch = next(i for i, p in enumerate(node.parts) if (p.kind == "null") == null)
        out += _varint(branch)
        _write(node.parts[branch], value, out)
    elif kind == "record":
        for f in node.fields:
            _write(f.node, value[f.name], out)
    elif kind in ("array", "map"):
        items = list(value.items() if isinstance(value, dict) else value)
        if items:
            out += _varint(len(items))
        for item in items:
            if kind == "map":
                _write(Node("string"), item[0], out)
                item = item[1]
            _write(node.parts[0], item, out)
        out += b"\0"
    elif kind == "null":
        pass
    elif kind == "boolean":
        out.append(bool(value))
    elif kind in ("int", "long"):
        out += _varint(value)
    elif kind in ("float", "double"):
        out += struct.pack("<f" if kind == "float" else "<d", value)
    elif kind == "enum":
        out += _varint(node.symbols.index(value))
    elif node.logical == "decimal":
        number = int(value.scaleb(node.scale))
        size = node.size or (number + (number < 0)).bit_length() // 8 + 1
        out += (b"" if kind == "fixed" else _varint(size)) + number.to_bytes(size, "big", signed=True)
    else:
        raw = value.encode() if isinstance(value, str) else value
        out += raw if kind == "fixed" else _varint(len(raw)) + raw


def _plain(node: Node, kind: pa.DataType, column: pa.Array) -> pa.Array:
    """A column with times and dates as the numbers that Avro writes."""
    if pa.types.is_timestamp(kind):
        ticks = column.cast(pa.timestamp("us", kind.tz)).cast(pa.int64())
        return pa.array([t if t is None else t // 1000 for t in ticks.to_pylist()]) if (node.logical or "").endswith("millis") else ticks
    return column.cast(pa.int32()) if pa.types.is_date(kind) else column


def encode_avro_bytes(df: DataFrame, schema: str, name: str = "value", *, keep: tuple[str, ...] = ()) -> DataFrame:
    """The rows as Avro bytes in the column ``name``, beside the columns of ``keep``.

    Fields are taken from the columns of the same name. Times may stand at the top level of the record. A null where the
    schema has none is an error, as is a value its type does not hold.
    """
    record = read_schema(schema)
    fields = [df.columns.index(f.name) for f in record.fields]
    kept = [df.columns.index(c) for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = []
            for f, i in zip(record.fields, fields, strict=True):
                node = next((p for p in f.node.parts if p.kind != "null"), f.node) if f.node.kind == "union" else f.node
                columns.append(_plain(node, batch.column(i).type, batch.column(i)).to_pylist())
            found = []
            for values in zip(*columns, strict=True) if columns else ((),) * batch.num_rows:
                out = bytearray()
                for f, value in zip(record.fields, values, strict=True):
                    _write(f.node, value, out)
                found.append(bytes(out))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), pa.array(found, pa.binary())], names=[*keep, name])

    out = T.StructType([*(df.schema[c] for c in keep), T.StructField(name, T.BinaryType())])
    return df.mapInArrow(run, nullable(out))


def failing(df: DataFrame, ok_col: str, what: str) -> DataFrame:
    """``df`` without the flag; a row whose flag is false ends the job."""
    stop = F.raise_error(F.lit(what)).cast("boolean")
    return df.where(F.when(F.col(ok_col), F.lit(True)).otherwise(stop)).drop(ok_col)
