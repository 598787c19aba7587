"""Avro binary <-> Arrow columns, a batch of messages at a time.

Stands in for Spark's Avro module where that is not on the class path. All messages of an Arrow
batch advance together, one schema node at a time, so the work per field is a few array operations
on the whole batch. Written from the public Avro specification.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

ARROW_PRIMITIVES = {
    "null": pa.null(),
    "boolean": pa.bool_(),
    "int": pa.int32(),
    "long": pa.int64(),
    "float": pa.float32(),
    "double": pa.float64(),
    "bytes": pa.binary(),
    "string": pa.string(),
}
FIXED_WIDTH = {"boolean": np.uint8, "float": np.dtype("<f4"), "double": np.dtype("<f8")}
# Logical type -> (Arrow type, microseconds or days per unit).
ARROW_LOGICAL_TYPES = {
    ("int", "date"): (pa.date32(), 1),
    ("long", "timestamp-millis"): (pa.timestamp("us", "UTC"), 1000),
    ("long", "timestamp-micros"): (pa.timestamp("us", "UTC"), 1),
    ("long", "local-timestamp-millis"): (pa.timestamp("us"), 1000),
    ("long", "local-timestamp-micros"): (pa.timestamp("us"), 1),
}


def is_decimal(node: dict) -> bool:
    return node["type"] in ("bytes", "fixed") and node.get("logicalType") == "decimal"


def value_branch(union: list) -> tuple[int, int, dict]:
    """Index of null (-1 if absent), index and schema of the one value branch."""
    null_at = next((i for i, b in enumerate(union) if b["type"] == "null"), -1)
    value_at = next(i for i, b in enumerate(union) if b["type"] != "null")
    return null_at, value_at, union[value_at]


def offsets_of(lengths: np.ndarray) -> np.ndarray:
    total = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=total[1:])
    if total[-1] > np.iinfo(np.int32).max:
        raise ValueError("a batch is over 2 GB; lower spark.sql.execution.arrow.maxRecordsPerBatch")
    return total.astype(np.int32)


def empty_of(node) -> pa.DataType:
    """The Arrow type of a schema node."""
    if isinstance(node, list):
        return empty_of(value_branch(node)[2])
    kind = node["type"]
    if kind == "record":
        return pa.struct([(f["name"], empty_of(f["type"])) for f in node["fields"]])
    if kind == "array":
        return pa.list_(empty_of(node["items"]))
    if kind == "map":
        return pa.map_(pa.string(), empty_of(node["values"]))
    if kind == "enum":
        return pa.string()
    if is_decimal(node):
        return pa.decimal128(node["precision"], node.get("scale", 0))
    if kind == "fixed":
        return pa.binary()
    logical = ARROW_LOGICAL_TYPES.get((kind, node.get("logicalType")))
    return logical[0] if logical else ARROW_PRIMITIVES[kind]


def takes_no_bytes(node) -> bool:
    if isinstance(node, list):
        return False
    if node["type"] == "record":
        return all(takes_no_bytes(f["type"]) for f in node["fields"])
    return node["type"] == "null" or (node["type"] == "fixed" and node["size"] == 0)


# ------------------------------------------------------------------ decoding


class Broken(ValueError):
    """Messages that do not follow the schema, named by the offset of their end in the batch."""

    def __init__(self, problem: str, ends: np.ndarray):
        super().__init__(problem)
        self.ends = ends


def _refuse(bad: np.ndarray, end: np.ndarray, problem: str) -> None:
    if bad.any():
        raise Broken(problem, end[bad])


class Batch:
    """The bytes of a batch of messages, and the steps that read them.

    Readers take `pos` and `end`, one offset per item, and return the values with the new `pos`.
    With `build` off a reader only moves on.
    """

    def __init__(self, messages: pa.Array):
        n = len(messages)
        bounds = np.frombuffer(messages.buffers()[1], np.int32)[
            messages.offset : messages.offset + n + 1
        ].astype(np.int64)
        data = messages.buffers()[2]
        data = data if data is not None else pa.py_buffer(b"")
        # Of a slice, only its own bytes.
        self.data = data.slice(int(bounds[0]), int(bounds[-1] - bounds[0]))
        bounds = bounds - bounds[0]
        self.bytes = np.frombuffer(self.data, np.uint8)
        self.start, self.end = bounds[:-1], bounds[1:]
        self._varint_ends = None

    def varint(self, pos, end):
        """One zig-zag varint per item."""
        _refuse(pos >= end, end, "message ends before a number")
        byte = self.bytes[pos]
        value = (byte & 0x7F).astype(np.uint64)
        at = pos + 1
        more = np.flatnonzero(byte >= 0x80)
        shift = 7
        while len(more):
            here = at[more]
            _refuse((here >= end[more]) | (shift > 63), end[more], "number without an end")
            byte = self.bytes[here]
            value[more] |= (byte & 0x7F).astype(np.uint64) << np.uint64(shift)
            at[more] = here + 1
            more = more[byte >= 0x80]
            shift += 7
        return _unzigzag(value), at

    def spans(self, pos, end):
        """Length-prefixed byte spans: their start and the position after them."""
        length, start = self.varint(pos, end)
        _refuse((length < 0) | (length > end - start), end, "message ends inside a string")
        return start, start + length

    def cut(self, start, stop, kind) -> pa.Array:
        """Copy the spans out as an Arrow array; spans are in message order."""
        n = len(start)
        # The spans and the gaps between them, alternating, cover the buffer without a copy.
        edges = np.empty(2 * n, np.int64)
        edges[0::2], edges[1::2] = start, stop
        both = pa.Array.from_buffers(
            kind, max(2 * n - 1, 0), [None, pa.py_buffer(edges.astype(np.int32)), self.data]
        )
        return both.take(pa.array(np.arange(0, 2 * n, 2)))

    def read(self, node, pos, end, build=True):
        if isinstance(node, list):
            return self.union(node, pos, end, build)
        kind = node["type"]
        if kind == "record":
            return self.record(node, pos, end, build)
        if kind in ("array", "map"):
            return self.collection(node, pos, end, build)
        if kind == "null":
            return pa.nulls(len(pos)), pos
        if kind in ("int", "long"):
            value, pos = self.varint(pos, end)
            self._refuse_long(node, value, end)
            return (_integers(node, value) if build else None), pos
        if kind == "enum":
            index, pos = self.varint(pos, end)
            unknown = (index < 0) | (index >= len(node["symbols"]))
            _refuse(unknown, end, "enum position out of range")
            return pa.array(node["symbols"], pa.string()).take(pa.array(index)), pos
        if kind in FIXED_WIDTH:
            dtype = np.dtype(FIXED_WIDTH[kind])
            after = self._skip(pos, end, dtype.itemsize)
            return (self._fixed_width(kind, pos) if build else None), after
        if kind == "fixed":
            start, stop = pos, self._skip(pos, end, node["size"])
        else:
            start, stop = self.spans(pos, end)
        if is_decimal(node):
            _refuse(stop - start > 16, end, "decimal of more than 16 bytes")
        if not build:
            return None, stop
        cut = self.cut(start, stop, pa.string() if kind == "string" else pa.binary())
        return (_decimals(node, cut) if is_decimal(node) else cut), stop

    def _skip(self, pos, end, width):
        _refuse(width > end - pos, end, "message ends inside a value")
        return pos + width

    @staticmethod
    def _refuse_long(node, value, end):
        if node["type"] == "int":
            _refuse(value != value.astype(np.int32), end, "int out of range")

    def _fixed_width(self, kind, pos):
        dtype = np.dtype(FIXED_WIDTH[kind])
        raw = self.bytes[pos[:, None] + np.arange(dtype.itemsize)]
        values = np.ascontiguousarray(raw).view(dtype).reshape(-1)
        return pa.array(values != 0 if kind == "boolean" else values, ARROW_PRIMITIVES[kind])

    def record(self, node, pos, end, build):
        columns, names = [], []
        for f in node["fields"]:
            wanted = build and not f.get("skip")
            column, pos = self.read(f["type"], pos, end, wanted)
            if wanted:
                columns.append(column)
                names.append(f["name"])
        if not build:
            return None, pos
        if not columns:
            return pa.array([{}] * len(pos), pa.struct([])), pos
        return pa.StructArray.from_arrays(columns, names), pos

    def union(self, node, pos, end, build):
        null_at, value_at, value_node = value_branch(node)
        branch, pos = self.varint(pos, end)
        present = branch == value_at
        _refuse(~(present | (branch == null_at)), end, "union position out of range")
        if present.all():
            return self.read(value_node, pos, end, build)
        values, after = self.read(value_node, pos[present], end[present], build)
        pos = pos.copy()
        pos[present] = after
        if not build:
            return None, pos
        return values.take(pa.array(np.cumsum(present) - 1, mask=~present)), pos

    def collection(self, node, pos, end, build):
        """Arrays and maps: blocks of items up to an empty block."""
        n, pos = len(pos), pos.copy()
        rows = np.arange(n)
        owners, items = [], []
        while len(rows):
            count, at = self.varint(pos[rows], end[rows])
            sized = count < 0
            if sized.any():
                _, at[sized] = self.varint(at[sized], end[rows[sized]])
                count = np.abs(count)
            # Every item takes a byte at least, so a larger count cannot be right.
            too_many = count > end[rows] - at
            _refuse((count < 0) | too_many, end[rows], "more items than bytes")
            pos[rows] = at
            rows, count = rows[count > 0], count[count > 0]
            if len(rows):
                self._block(node, rows, count, pos, end, build, owners, items)
        if not build:
            return None, pos
        item_type = _item_type(node)
        if not items:
            values = pa.array([], item_type)
            offsets = np.zeros(n + 1, np.int32)
        else:
            owner = np.concatenate(owners)
            values = pa.concat_arrays(items)
            if (np.diff(owner) < 0).any():
                values = values.take(pa.array(np.argsort(owner, kind="stable")))
            offsets = offsets_of(np.bincount(owner, minlength=n))
        offsets = pa.array(offsets, pa.int32())
        if node["type"] == "array":
            return pa.ListArray.from_arrays(offsets, values), pos
        keys, values = values.flatten()
        return _last_wins(pa.MapArray.from_arrays(offsets, keys, values)), pos

    def _block(self, node, rows, count, pos, end, build, owners, items):
        """Read `count` items for each of `rows`; adds them to `owners` and `items`."""
        item = node["items"] if node["type"] == "array" else None
        kind = item["type"] if isinstance(item, dict) else None
        if kind in FIXED_WIDTH:
            width = np.dtype(FIXED_WIDTH[kind]).itemsize
            first = pos[rows]
            pos[rows] = self._skip(first, end[rows], width * count)
            if build:
                owners.append(np.repeat(rows, count))
                items.append(self._fixed_width(kind, _runs(first, count, width)))
            return
        if kind in ("int", "long"):
            # Each number ends at the first byte below 0x80, so all ends are known up front.
            if self._varint_ends is None:
                self._varint_ends = np.flatnonzero(self.bytes < 0x80)
            ends = self._varint_ends
            first = np.searchsorted(ends, pos[rows])
            last = first + count - 1
            known = np.minimum(last, len(ends) - 1)
            outside = (last >= len(ends)) | (ends[known] >= end[rows])
            _refuse(outside, end[rows], "message ends inside an array")
            if build:
                which = _runs(first, count, 1)
                starts = np.where(which == np.repeat(first, count), 0, ends[which - 1] + 1)
                starts[np.cumsum(count) - count] = pos[rows]
                owner = np.repeat(rows, count)
                value, _ = self.varint(starts, end[owner])
                self._refuse_long(item, value, end[owner])
                owners.append(owner)
                items.append(_integers(item, value))
            pos[rows] = ends[last] + 1
            return
        left = count
        while len(rows):
            if node["type"] == "array":
                value, pos[rows] = self.read(item, pos[rows], end[rows], build)
            else:
                key, at = self.read({"type": "string"}, pos[rows], end[rows], build)
                value, pos[rows] = self.read(node["values"], at, end[rows], build)
                if build:
                    value = pa.StructArray.from_arrays([key, value], ["key", "value"])
            if build:
                owners.append(rows)
                items.append(value)
            left = left - 1
            rows, left = rows[left > 0], left[left > 0]


def _runs(first, count, step):
    """first, first + step, ... (count of them), for each item, one after the other."""
    total = np.cumsum(count)
    within = np.arange(total[-1] if len(total) else 0) - np.repeat(total - count, count)
    return np.repeat(first, count) + within * step


def _unzigzag(value):
    return (value >> np.uint64(1)).astype(np.int64) ^ -(value & np.uint64(1)).astype(np.int64)


def _integers(node, value):
    if node["type"] == "int":
        value = value.astype(np.int32)
    logical = ARROW_LOGICAL_TYPES.get((node["type"], node.get("logicalType")))
    if not logical:
        return pa.array(value)
    return pa.array(value * logical[1] if logical[1] != 1 else value).cast(logical[0])


def _decimals(node, cut: pa.Array) -> pa.Array:
    """Big-endian two's complement bytes as decimals."""
    if not len(cut):
        return pa.array([], empty_of(node))
    lengths = np.diff(np.frombuffer(cut.buffers()[1], np.int32)[cut.offset :][: len(cut) + 1])
    ends = np.frombuffer(cut.buffers()[1], np.int32)[cut.offset + 1 :][: len(cut)]
    data = np.frombuffer(cut.buffers()[2] or b"\0", np.uint8)
    back = np.arange(16)
    inside = back < lengths[:, None]
    raw = np.where(inside, data[np.where(inside, ends[:, None] - 1 - back, 0)], 0)
    sign = np.where(lengths > 0, data[np.where(lengths > 0, ends - lengths, 0)] >= 0x80, False)
    raw = np.where(inside, raw, np.where(sign[:, None], 0xFF, 0)).astype(np.uint8)
    kind = empty_of(node)
    return pa.Array.from_buffers(kind, len(cut), [None, pa.py_buffer(raw.tobytes())])


def _item_type(node):
    if node["type"] == "array":
        return empty_of(node["items"])
    return pa.struct([("key", pa.string()), ("value", empty_of(node["values"]))])


def _last_wins(maps: pa.MapArray) -> pa.MapArray:
    """Keep the last entry of a key that occurs more than once in a map."""
    keys = maps.keys
    lengths = np.diff(maps.offsets.to_numpy())
    if lengths.max(initial=0) < 2:
        return maps
    owner = np.repeat(np.arange(len(maps)), lengths)
    code = keys.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    pair = owner * (int(code.max()) + 1) + code
    _, last = np.unique(pair[::-1], return_index=True)
    if len(last) == len(pair):
        return maps
    kept = np.sort(len(pair) - 1 - last)
    offsets = offsets_of(np.bincount(owner[kept], minlength=len(maps)))
    chosen = pa.array(kept)
    return pa.MapArray.from_arrays(
        pa.array(offsets, pa.int32()), keys.take(chosen), maps.items.take(chosen)
    )


def _pieces(messages: pa.Array, limit: int = 1 << 24):
    """Slices of a batch of about `limit` bytes, so that one batch stays small in memory."""
    if not len(messages):
        return
    step = max(1, int(len(messages) * limit / max(messages.nbytes, 1)))
    for at in range(0, len(messages), step):
        yield messages.slice(at, step)


def decode(node: dict, messages: pa.Array, permissive: bool = False) -> pa.Array:
    """Messages of one record each as a struct array.

    Null messages become null rows. Broken messages raise; if `permissive` they become null rows
    too, and reading starts again without those found so far.
    """
    if messages.type != pa.binary():
        messages = messages.cast(pa.binary())
    parts = [_decode_piece(node, piece, permissive) for piece in _pieces(messages)]
    parts = parts or [_decode_piece(node, messages, permissive)]
    return parts[0] if len(parts) == 1 else pa.concat_arrays(parts)


def _decode_piece(node: dict, messages: pa.Array, permissive: bool) -> pa.Array:
    good = np.flatnonzero(messages.is_valid().to_numpy(zero_copy_only=False))
    left = messages.drop_null() if messages.null_count else messages
    while True:
        batch = Batch(left)
        bad = np.zeros(len(left), bool)
        try:
            if not takes_no_bytes(node):
                # Messages are told apart by where they end, which an empty one does not settle.
                bad = batch.start == batch.end
                _refuse(bad, batch.end, "empty message")
            values = batch.read(node, batch.start, batch.end)[0]
            break
        except Broken as problem:
            if not permissive:
                raise
            if not bad.any():
                bad = np.isin(batch.end, problem.ends)
            left, good = left.filter(pa.array(~bad)), good[~bad]
    if len(good) == len(messages):
        return values
    where = np.full(len(messages), -1)
    where[good] = np.arange(len(good))
    return values.take(pa.array(where, mask=where < 0))


# ------------------------------------------------------------------ encoding


def _binary(lengths: np.ndarray, data: np.ndarray) -> pa.Array:
    offsets = offsets_of(lengths)
    return pa.Array.from_buffers(
        pa.binary(),
        len(lengths),
        [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))],
    )


def varints(values: np.ndarray) -> pa.Array:
    """Zig-zag varints, one binary value per number."""
    values = values.astype(np.int64)
    zigzag = ((values << 1) ^ (values >> 63)).view(np.uint64)
    width = max(1, -(-int(zigzag.max(initial=0)).bit_length() // 7))
    if width == 1:
        return _binary(np.ones(len(values), np.int64), zigzag.astype(np.uint8))
    septets = zigzag[:, None] >> (np.uint64(7) * np.arange(width, dtype=np.uint64))
    used = septets > 0
    used[:, 0] = True
    raw = (septets & np.uint64(0x7F)).astype(np.uint8)
    raw[:, :-1] |= used[:, 1:].astype(np.uint8) << 7
    return _binary(used.sum(axis=1), raw[used])


def _fixed(values: np.ndarray, dtype) -> pa.Array:
    values = np.ascontiguousarray(values.astype(dtype))
    return _binary(
        np.full(len(values), values.dtype.itemsize), values.view(np.uint8).reshape(-1)
    )


def _joined(*columns) -> pa.Array:
    return pc.binary_join_element_wise(*columns, pa.scalar(b"", pa.binary()))


def _prefixed(values: pa.Array) -> pa.Array:
    return _joined(varints(pc.binary_length(values).to_numpy(zero_copy_only=False)), values)


def encode(node, column: pa.Array) -> pa.Array:
    """A column as one Avro binary value per row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(node, list):
        null_at, value_at, value_node = value_branch(node)
        if null_at < 0 or not column.null_count:
            values = encode(value_node, column)
            return _joined(pa.scalar(varints(np.array([value_at]))[0].as_py(), pa.binary()), values)
        present = column.is_valid().to_numpy(zero_copy_only=False)
        values = encode(value_node, column.drop_null())
        prefix, null = (varints(np.array([i]))[0].as_py() for i in (value_at, null_at))
        values = _joined(pa.scalar(prefix, pa.binary()), values)
        spread = values.take(pa.array(np.cumsum(present) - 1, mask=~present))
        return spread.fill_null(pa.scalar(null, pa.binary()))
    kind = node["type"]
    if kind == "null":
        return _binary(np.zeros(len(column), np.int64), np.zeros(0, np.uint8))
    if column.null_count:
        raise ValueError(f"null in a required {kind} field")
    if kind == "record":
        if not node["fields"]:
            return _binary(np.zeros(len(column), np.int64), np.zeros(0, np.uint8))
        children = zip(node["fields"], column.flatten(), strict=True)
        return _joined(*[_named(f, child) for f, child in children])
    if kind in ("int", "long"):
        logical = ARROW_LOGICAL_TYPES.get((kind, node.get("logicalType")))
        if logical:
            column = column.cast(logical[0]).cast(pa.int32() if kind == "int" else pa.int64())
        elif column.type not in (pa.int32(), pa.int64()):
            column = column.cast(ARROW_PRIMITIVES[kind])
        number = column.to_numpy(zero_copy_only=False)
        if kind == "int" and (number != number.astype(np.int32)).any():
            raise ValueError("int out of range")
        return varints(np.floor_divide(number, logical[1]) if logical else number)
    if kind == "enum":
        index = pc.index_in(column, pa.array(node["symbols"], column.type))
        if index.null_count:
            raise ValueError("value is not a symbol of the enum")
        return varints(index.to_numpy(zero_copy_only=False))
    if kind in FIXED_WIDTH:
        column = column.cast(ARROW_PRIMITIVES[kind])
        return _fixed(column.to_numpy(zero_copy_only=False), FIXED_WIDTH[kind])
    if is_decimal(node):
        column = _decimal_bytes(node, column)
        return column if kind == "fixed" else _prefixed(column)
    if kind == "fixed":
        if (pc.binary_length(column).to_numpy(zero_copy_only=False) != node["size"]).any():
            raise ValueError("value does not have the size of the fixed type")
        return column.cast(pa.binary())
    if kind in ("string", "bytes"):
        return _prefixed(column.cast(ARROW_PRIMITIVES[kind]).cast(pa.binary()))
    if kind == "array":
        items = encode(node["items"], column.flatten())
    else:
        start, stop = column.offsets[0].as_py(), column.offsets[-1].as_py()
        entries = column.keys.slice(start, stop - start), column.items.slice(start, stop - start)
        items = _joined(
            encode({"type": "string"}, entries[0]), encode(node["values"], entries[1])
        )
    return _blocks(np.diff(column.offsets.to_numpy()), items)


def _named(f: dict, child: pa.Array) -> pa.Array:
    try:
        return encode(f["type"], child)
    except ValueError as problem:
        raise ValueError(f"{f['name']}: {problem}") from None


def _blocks(counts: np.ndarray, items: pa.Array) -> pa.Array:
    """One block with all items of a row, then the empty block."""
    offsets = pa.array(offsets_of(counts), pa.int32())
    body = pc.binary_join(pa.ListArray.from_arrays(offsets, items), pa.scalar(b"", pa.binary()))
    some = counts > 0
    head = varints(counts[some])
    head = head.take(pa.array(np.cumsum(some) - 1, mask=~some))
    head = head.fill_null(pa.scalar(b"", pa.binary()))
    return _joined(head, body, pa.scalar(b"\0", pa.binary()))


def _decimal_bytes(node, column: pa.Array) -> pa.Array:
    """Decimals as big-endian two's complement bytes, as short as possible or of the fixed size."""
    column = column.cast(empty_of(node))
    raw = np.frombuffer(column.buffers()[1], np.uint8).reshape(-1, 16)
    raw = raw[column.offset : column.offset + len(column), ::-1]
    if node["type"] == "fixed":
        size = node["size"]
        pad = np.repeat(np.where(raw[:, :1] >= 0x80, 0xFF, 0), max(size - 16, 0), axis=1)
        wide = np.hstack([pad.astype(np.uint8), raw[:, max(16 - size, 0) :]])
        return _binary(np.full(len(column), size), wide.reshape(-1))
    sign = np.where(raw[:, :1] >= 0x80, 0xFF, 0)
    # A leading byte is spare if it only repeats the sign that the next byte carries too.
    spare = (raw[:, :-1] == sign) & ((raw[:, 1:] >= 0x80) == (sign > 0))
    leading = np.cumprod(spare, axis=1).sum(axis=1)
    kept = np.arange(16) >= leading[:, None]
    return _binary(16 - leading, raw[kept])
