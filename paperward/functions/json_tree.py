"""Replacing strings inside open JSON bodies.

The part no column expression can do: find string slots in a tree of unknown
shape, and write them back.  Which slots to replace is decided in Spark.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from paperward.functions.unicode import plain_form

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Keys whose strings come from the document's author, keys of
# recovered text, the mark left behind, and how deep a walk goes.
PAYLOAD_KEYS = ("payload", "name", "recovered", "authors", "before", "after")
RECOVERED_KEYS = ("recovered", "text")
REDACTED = "[redacted]"
MAX_DEPTH = 12

UNTRUSTED_FLAG = "payloadIsUntrusted"
REDACTED_FLAG = "payloadRedacted"

Slot = tuple[dict | list, str | int]


def slots(root, keys: tuple[str, ...], walk_listed: bool) -> Iterator[Slot]:
    """String slots at listed keys: the value itself or items of its array.

    Containers deeper than the bound are left alone.  ``walk_listed`` says
    whether other things found under a listed key are searched as well.
    """
    open_nodes = [(root, 0)]
    while open_nodes:
        node, depth = open_nodes.pop()
        if depth > MAX_DEPTH:
            continue
        entries = node.items() if isinstance(node, dict) else enumerate(node)
        for key, child in entries:
            if not (isinstance(node, dict) and key in keys):
                if isinstance(child, (dict, list)):
                    open_nodes.append((child, depth + 1))
            elif isinstance(child, str):
                yield node, key
            elif isinstance(child, list):
                for i, item in enumerate(child):
                    if isinstance(item, str):
                        yield child, i
                    elif walk_listed and isinstance(item, (dict, list)):
                        open_nodes.append((item, depth + 1))
            elif walk_listed and isinstance(child, dict):
                open_nodes.append((child, depth + 1))


def every_slot(root) -> Iterator[Slot]:
    """Every string slot whose value lies within the bound."""
    open_nodes = [(root, 0)]
    while open_nodes:
        node, depth = open_nodes.pop()
        if depth >= MAX_DEPTH:
            continue
        for key, child in node.items() if isinstance(node, dict) else enumerate(node):
            if isinstance(child, str):
                yield node, key
            elif isinstance(child, (dict, list)):
                open_nodes.append((child, depth + 1))


def _evidences(body) -> list:
    signals = body.get("signals") if isinstance(body, dict) else None
    if not isinstance(signals, list):
        return []
    found = [s.get("evidence") for s in signals if isinstance(s, dict)]
    return [e for e in found if isinstance(e, (dict, list))]


def recovered_slots(body) -> list[Slot]:
    return [
        slot for e in _evidences(body) for slot in slots(e, RECOVERED_KEYS, False)
    ]


def compare_slots(body) -> list[Slot]:
    return list(every_slot(body)) if isinstance(body, dict) else []


# Answer for a body that cannot be read; no redacted body is empty.
UNREADABLE = ""


def _no_constant(name: str):
    raise ValueError(f"{name} is no JSON")


def _load(text: str):
    """Parsed body, and whether an object in it has a key twice.

    The last value of a repeated key counts, so the earlier ones are in no tree, and
    the text as it came must not get out.  Raises ``ValueError`` also for nesting
    without end.
    """
    repeated = False

    def build(pairs: list) -> dict:
        nonlocal repeated
        made = dict(pairs)
        repeated = repeated or len(made) < len(pairs)
        return made

    try:
        return json.loads(text, parse_constant=_no_constant, object_pairs_hook=build), repeated
    except RecursionError as err:
        raise ValueError("nested too deeply") from err


def _dump(body) -> str:
    try:
        text = json.dumps(body, ensure_ascii=False, separators=(",", ":"))
        text.encode()
    except UnicodeEncodeError:  # half of a surrogate pair has to stay escaped
        return json.dumps(body, separators=(",", ":"))
    except RecursionError:
        return UNREADABLE
    return text


def _whole(text: str) -> str:
    """Text without halves of surrogate pairs, which Arrow cannot carry."""
    return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def _elide_untrusted(body) -> bool:
    """Elide untrusted signals in place; were there any?"""
    untrusted = [
        e
        for e in _evidences(body)
        if isinstance(e, dict) and e.get(UNTRUSTED_FLAG) is True
    ]
    for evidence in untrusted:
        for node, key in list(slots(evidence, PAYLOAD_KEYS, True)):
            node[key] = REDACTED
        evidence[REDACTED_FLAG] = True
    return bool(untrusted)


# ``body`` is the new text where the old must not stand, ``found`` the strings to be
# judged, null for a body that cannot be read.
_READ = (
    StructType()
    .add("body", StringType())
    .add("found", ArrayType(StructType().add("value", StringType()).add("plain", StringType())))
)
_FOUND = pa.list_(pa.field("element", pa.struct([("value", pa.string()), ("plain", pa.string())])))
_READ_ARROW = pa.struct([("body", pa.string()), ("found", _FOUND)])

# A worker has trees and strings of so many bytes of text at once, or of one longer text.
SLICE_BYTES = 1 << 20


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Start and length of each slice of an Arrow batch, whose own size is Spark's choice."""
    start = held = 0
    for i, size in enumerate(pc.binary_length(texts).to_pylist()):
        if i > start and held + (size or 0) > SLICE_BYTES:
            yield start, i - start
            start, held = i, 0
        held += size or 0
    if start < len(texts):
        yield start, len(texts) - start


def _read(text: str, elide: bool, find) -> dict:
    try:
        body, changed = _load(text)
    except ValueError:
        return {"body": UNREADABLE, "found": None}
    changed = (elide and _elide_untrusted(body)) or changed
    new = _dump(body) if changed else None
    if new == UNREADABLE:
        return {"body": UNREADABLE, "found": None}
    values = [_whole(node[key]) for node, key in find(body)] if find else []
    return {
        "body": new,
        "found": [{"value": v, "plain": None if v.isascii() else plain_form(v)} for v in values],
    }


def _reader(elide: bool, find):
    @F.arrow_udf(_READ)
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for bodies in batches:
            for part in _slices(bodies):
                texts = bodies.slice(*part).to_pylist()
                yield pa.array([None if b is None else _read(b, elide, find) for b in texts], _READ_ARROW)

    return read


def _rewrite(text: str, hits, find, flag: bool) -> str:
    body, _ = _load(text)
    for (node, key), hit in zip(find(body), hits):
        if hit:
            node[key] = REDACTED
    if flag:
        body[REDACTED_FLAG] = True
    return _dump(body)


def _writer(find, flag: bool):
    @F.arrow_udf(StringType())
    def write(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for bodies, hits in batches:
            for part in _slices(bodies):
                rows = zip(bodies.slice(*part).to_pylist(), hits.slice(*part).to_pylist())
                yield pa.array([None if b is None else _rewrite(b, h, find, flag) for b, h in rows], pa.string())

    return write


read_untrusted = _reader(True, None)
read_recovered, write_recovered = _reader(False, recovered_slots), _writer(recovered_slots, False)
read_report = _reader(True, recovered_slots)
read_compare, write_compare = _reader(False, compare_slots), _writer(compare_slots, True)
