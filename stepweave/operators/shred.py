"""Deeply nested JSON records as related flat tables (shared inlining).

The schema graph of all records tells the tables: elements that occur at most
once per parent are inlined into their nearest table; repeated elements (array
items and entries of key-value objects), elements shared by several parents and
recursive ones get tables of their own, with keys to their parents.

One pass over the records writes rows and schema together, one folder per table,
laid out as if no element were shared, recursive or too wide. Only if the
schema then shows one, the records are read again with what is known.

Paths: ``a.b`` for fields, ``[]`` for array items, ``{}`` for the entries of an
object whose keys are data (all whole numbers, or more than ``MAX_FIELDS``
different ones over all records, or named by the caller). What the caller knows
by its path keeps its place: neither a name met a second time elsewhere nor very
many names beside it move it.
"""

from __future__ import annotations

import json
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepweave.session import stored

MAX_FIELDS = 1000
#: Beyond so many (path, kind) pairs the schema graph is refused.
MAX_GRAPH = 100 * MAX_FIELDS
#: Rows of one Arrow batch, and places that a task keeps in mind before it passes on their schema.
BATCH_ROWS, MAX_PLACES = 20_000, 50 * MAX_FIELDS
#: The name under which schema rows are written beside the tables.
SCHEMA = "~schema"
_NUMBER_KEY = re.compile(r"-?[0-9]+")
ROOT = "$"


def _no_constant(token: str):
    raise ValueError(token)


def parse(text: str | None):
    """The JSON value of a whole text; ``...`` for what isn't valid JSON."""
    if text is None:
        return ...
    try:
        return json.loads(text, parse_constant=_no_constant)
    except (ValueError, RecursionError):
        return ...


def opened(value):
    """A value in which an object or array stored as JSON text counts as itself."""
    while isinstance(value, str) and value.lstrip()[:1] in ("{", "["):
        inner = parse(value)
        if not isinstance(inner, (dict, list)):
            break
        value = inner
    return value


def _kind(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, dict):
        return "object"
    if isinstance(value, list):
        return "vector" if value and all(isinstance(x, (int, float)) and not isinstance(x, bool) for x in value) else "array"
    return "boolean" if isinstance(value, bool) else "number" if isinstance(value, (int, float)) else "string"


@dataclass
class Graph:
    """kinds: for each path the kinds seen; maps: object paths whose keys are data; shared, recursive: names with a table of their own; known: paths that stay in place."""

    kinds: dict[str, set[str]] = field(default_factory=dict)
    maps: set[str] = field(default_factory=set)
    shared: set[str] = field(default_factory=set)
    recursive: set[str] = field(default_factory=set)
    known: set[str] = field(default_factory=set)

    def columns(self, table: str) -> dict[str, str]:
        """Inlined columns of a table and their SQL types."""
        out = {}
        for path, kinds in sorted(self.kinds.items()):
            owner, name = self.place(path)
            plain = kinds - {"null", "object", "array"}
            if owner == table and plain and name:
                out[name] = {frozenset(["number"]): "double", frozenset(["boolean"]): "boolean"}.get(frozenset(plain), "string")
        return out

    def place(self, path: str) -> tuple[str, str]:
        """The table that holds a path, and its column there ('' for the row itself)."""
        parts, cols = path.split("."), []
        table = at = parts[0]
        for p in parts[1:]:
            at = f"{at}.{p}"
            if p in ("[]", "{}"):
                table, cols = table + "".join("." + c for c in cols) + "." + p, []
            elif (p in self.recursive or p in self.shared) and at not in self.known:
                table, cols = "#" + p, []
            else:
                cols.append(p)
        return table, ".".join(cols)

    def tables(self) -> list[str]:
        return sorted({self.place(p)[0] for p in self.kinds} | {ROOT})


def _below(path: str, name: str, value, known: set[str]) -> tuple[str, bool]:
    """The path of an object's element, and whether its name is met again below itself: such an element starts over from the first place, or from ``#name`` where that place is known."""
    sub = f"{path}.{name.replace('.', '_')}"
    if isinstance(value, (dict, list)) and sub not in known:
        parts = path.split(".")
        if parts[0] == "#" + name:
            return parts[0], True
        if name in parts:
            first = ".".join(parts[: parts.index(name) + 1])
            return ("#" + name if first in known else first), True
    return sub, False


def _stays(path: str, name: str, known: set[str]) -> bool:
    """Whether an entry of an object whose keys are data is none, but an element that the caller knows."""
    return path in known and name not in ("[]", "{}")


class _Place:
    """A path of the schema graph with what a walk needs to know of it, made once per task."""

    __slots__ = ("path", "table", "column", "own_table", "is_map", "numbers_apart", "kinds", "plain", "deep", "item_", "entry_")

    def __init__(self, path: str, graph: Graph) -> None:
        self.path = path
        self.table, self.column = graph.place(path)
        name = path.rpartition(".")[2]
        self.own_table = "." in path and (name in graph.shared or name in graph.recursive) and path not in graph.known
        self.is_map = path in graph.maps
        self.numbers_apart = path + ".[]" in graph.known
        self.kinds: set[str] = set()
        self.plain: dict[str, _Place] = {}
        self.deep: dict[str, _Place] = {}
        self.item_: _Place | None = None
        self.entry_: _Place | None = None


class _Rows:
    """Rows of one Arrow batch."""

    def __init__(self) -> None:
        self.of: list[int] = []
        self.table: list[str] = []
        self.row_id: list[str] = []
        self.parent: list[str | None] = []
        self.keys: list[list[str]] = []
        self.kind: list[str] = []
        self.size: list[int] = []
        self.ends: list[int] = [0]
        self.names: list[str] = []
        self.values: list[str | None] = []

    def add(self, of: int, table: str, row_id: str, parent: str | None, keys: list[str], kind: str, size: int, columns: list[tuple[str, str | None]]) -> None:
        self.of.append(of)
        self.table.append(table)
        self.row_id.append(row_id)
        self.parent.append(parent)
        self.keys.append(keys)
        self.kind.append(kind)
        self.size.append(size)
        for name, value in columns:
            self.names.append(name)
            self.values.append(value)
        self.ends.append(len(self.names))

    def batch(self, ids: pa.Array) -> pa.RecordBatch:
        columns = pa.MapArray.from_arrays(pa.array(self.ends, pa.int32()), pa.array(self.names, pa.string()), pa.array(self.values, pa.string()))
        arrays = [
            ids.take(pa.array(self.of, pa.int64())), pa.array(self.table, pa.string()), pa.array(self.row_id, pa.string()), pa.array(self.parent, pa.string()),
            pa.array(self.keys, pa.list_(pa.string())), pa.array(self.kind, pa.string()), pa.array(self.size, pa.int32()), columns,
        ]
        return pa.RecordBatch.from_arrays(arrays, _NAMES)


_NAMES = ["id", "table", "row_id", "parent_id", "keys", "kind", "size", "columns"]


class _Walk:
    """Walks records by one graph, into rows, and notes the schema it meets."""

    def __init__(self, graph: Graph) -> None:
        self.graph = graph
        self.places: dict[str, _Place] = {}
        self.recursive: set[str] = set()
        self.root = self.at(ROOT)

    def at(self, path: str) -> _Place:
        place = self.places.get(path)
        if place is None:
            place = self.places[path] = _Place(path, self.graph)
        return place

    def below(self, place: _Place, name: str, value) -> _Place:
        nested = isinstance(value, (dict, list))
        met = place.deep if nested else place.plain
        sub = met.get(name)
        if sub is None:
            path, again = _below(place.path, name, value, self.graph.known)
            if again:
                self.recursive.add(f"{place.path}.{name}")
            sub = met[name] = self.at(path)
        return sub

    def item(self, place: _Place) -> _Place:
        if place.item_ is None:
            place.item_ = self.at(place.path + ".[]")
        return place.item_

    def entry(self, place: _Place) -> _Place:
        if place.entry_ is None:
            place.entry_ = self.at(place.path + ".{}")
        return place.entry_

    def schema(self) -> list[tuple[str, str]]:
        """(path, kind) of all that was met since the last call."""
        out = [(p.path, k) for p in self.places.values() for k in p.kinds] + [(p, "recursive") for p in self.recursive]
        self.places.clear()
        self.recursive.clear()
        self.root = self.at(ROOT)
        return out

    def record(self, of: int, value, rows: _Rows | None) -> None:
        """All elements of one record; row ids start at the record ('')."""
        todo = [(self.root, "", None, [], opened(value))]
        while todo:
            place, row_id, parent, keys, v = todo.pop()
            kind = self.kind(place, v)
            place.kinds.add(kind)
            columns: list[tuple[str, str | None]] = []
            if kind not in ("object", "array"):
                if kind != "null":
                    columns.append(("value", _text(v)))
                if rows is not None:
                    rows.add(of, place.table, row_id, parent, keys, kind, len(v) if kind == "vector" else 0, columns)
                continue
            inner = [(place, "", v)]
            while inner:
                at, prefix, x = inner.pop()
                if isinstance(x, list):
                    item, base = self.item(at), f"{row_id}/{prefix}["
                    for i, y in enumerate(x):
                        todo.append((item, f"{base}{i}]", row_id, [*keys, str(i)], opened(y)))
                    continue
                mapped = at.is_map or (bool(x) and all(_NUMBER_KEY.fullmatch(k) for k in x))
                for k, y in x.items():
                    y = opened(y)
                    sub = self.below(at, k, y)
                    if mapped and not _stays(sub.path, k, self.graph.known):
                        todo.append((self.entry(at), f"{row_id}/{prefix}{{{k}}}", row_id, [*keys, k], y))
                        continue
                    kind_y = self.kind(sub, y)
                    sub.kinds.add(kind_y)
                    name = k.replace(".", "_")
                    column = f"{prefix}.{name}" if prefix else name
                    if kind_y == "object" and sub.own_table:
                        todo.append((sub, f"{row_id}/{column}", row_id, keys, y))
                    elif kind_y in ("object", "array"):
                        inner.append((sub, column, y))
                    else:
                        columns.append((column, _text(y)))
            if rows is not None:
                rows.add(of, place.table, row_id, parent, keys, kind, len(v), columns)

    @staticmethod
    def kind(place: _Place, value) -> str:
        """Numbers alone are an array like any other where the caller knows the path of the items."""
        kind = _kind(value)
        return "array" if kind == "vector" and place.numbers_apart else kind


def _walked(records: DataFrame, id_col: str, json_col: str, graph: Graph, rows: bool, schema: bool) -> DataFrame:
    """Rows of all records, or their schema as rows of the table SCHEMA (path in row_id), or both from one pass."""
    idt = records.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = _Walk(graph)

        def noted(ids: pa.Array) -> pa.RecordBatch:
            out = _Rows()
            for path, kind in walk.schema():
                out.add(0, SCHEMA, path, None, [], kind, 0, [])
            return out.batch(ids)

        ids = None
        for batch in batches:
            ids, out = batch.column(0), _Rows()
            for i, text in enumerate(batch.column(1).to_pylist()):
                value = parse(text)
                if value is not ...:
                    walk.record(i, value, out if rows else None)
                if len(out.of) >= BATCH_ROWS:
                    yield out.batch(ids)
                    out = _Rows()
            if out.of:
                yield out.batch(ids)
            if len(walk.places) > MAX_PLACES and len(ids):
                note = noted(ids)  # forgets them, too
                if schema:
                    yield note
        if schema and ids is not None and len(ids):
            yield noted(ids)

    ddl = f"id {idt}, table string, row_id string, parent_id string, keys array<string>, kind string, size int, columns map<string,string>"
    base = records.select(F.col(id_col).alias("id"), json_col).where("id is not null")
    return base.mapInArrow(run, ddl).withColumnRenamed("id", id_col)


def _is_name(path: str, known: set[str]) -> bool:
    return "." in path and path.rpartition(".")[2] not in ("[]", "{}") and path not in known


def _wide(seen: DataFrame, known: set[str]) -> set[str]:
    """Objects with too many names, where the paths are too many for the driver."""
    name = F.col("path").contains(".") & ~F.substring_index("path", ".", -1).isin("[]", "{}") & ~F.col("path").isin(*known)
    counts = seen.where(name).select("path").distinct().groupBy(F.regexp_extract("path", r"(?s)^(.*)\.", 1).alias("of")).agg(F.count("*").alias("n"))
    return {r.of for r in counts.where(F.col("n") > MAX_FIELDS).collect()}


def _outermost(paths: set[str]) -> set[str]:
    return {p for p in paths if not any(c == "." and p[:i] in paths for i, c in enumerate(p))}


def _graph_of(rows: list, maps: set[str], stay: set[str]) -> Graph:
    """The graph of all (path, kind) pairs."""
    graph = Graph(maps=maps, known=stay)
    for path, kind in rows:
        if kind == "recursive":
            graph.recursive.add(path.rpartition(".")[2])
        else:
            graph.kinds.setdefault(path, set()).add(kind)
    # An object of one name below different parents is shared, unless it repeats or recurs.
    parents: dict[str, set[str]] = defaultdict(set)
    for path, kinds in graph.kinds.items():
        if "object" in kinds and "." in path and path not in stay and path.rsplit(".", 1)[1] not in ("[]", "{}"):
            parent, name = path.rsplit(".", 1)
            parents[name].add(parent)
    graph.shared = {n for n, p in parents.items() if len(p) > 1} - graph.recursive
    return graph


def _wide_in(rows: list, stay: set[str]) -> set[str]:
    names = Counter(p.rpartition(".")[0] for p in {r.path for r in rows} if _is_name(p, stay))
    return {p for p, n in names.items() if n > MAX_FIELDS}


def _staying(known: set[str] | None) -> set[str]:
    return {".".join(parts[:n]) for parts in (p.split(".") for p in known or ()) for n in range(1, len(parts) + 1)}


def _pairs(schema: DataFrame) -> DataFrame:
    return schema.select(F.col("row_id").alias("path"), "kind").distinct()


def analyse(records: DataFrame, json_col: str, maps: set[str] | None = None, known: set[str] | None = None) -> Graph:
    """The schema graph of all records; its size follows the number of different paths, not of records.

    ``known`` are paths that the caller will ask for: they and all above them stay in their places, whatever other records hold.
    Names are counted over all records; where an object has too many, the records are read again with its entries as data, once
    for each such object inside another. A graph of more than MAX_GRAPH pairs is an error.
    """
    found_maps, stay = set(maps or ()), _staying(known)
    keyed = records.select(F.lit(0).alias("id"), F.col(json_col).alias("json"))
    while True:
        seen = _pairs(_walked(keyed, "id", "json", Graph(maps=found_maps, known=stay), rows=False, schema=True))
        rows = seen.limit(MAX_GRAPH + 1).collect()
        wide = _wide_in(rows, stay) if len(rows) <= MAX_GRAPH else _wide(seen, stay)
        if not wide - found_maps:
            break
        found_maps |= _outermost(wide - found_maps)
    if len(rows) > MAX_GRAPH:
        raise ValueError(f"more than {MAX_GRAPH} paths and kinds in {json_col}; name the objects whose keys are data in maps")
    return _graph_of(rows, found_maps, stay)


def _text(value) -> str | None:
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, ensure_ascii=False)


def shredded(records: DataFrame, id_col: str, json_col: str, graph: Graph) -> DataFrame:
    """All rows of all tables by a known graph: id_col, table, row_id, parent_id, keys, kind, size, columns.

    A list of numbers is one value of kind 'vector', unless its items are known.
    ``row_id`` is unique within a record, and ``(id_col, parent_id)`` is the
    key of the parent row. ``keys`` are the entries' keys and the items' 0-based
    places on the way from the record to the row, its own last: those of the
    parent are its beginning. ``kind`` tells null, object, array, vector,
    string, number, boolean.

    Nulls: records without id are skipped; a NULL, empty or broken body gives
    no rows; JSON nulls in arrays and objects give rows of kind 'null' where
    the element is repeated, NULL columns elsewhere. Very long bodies are read
    whole. Repeated records give repeated rows. Extra columns are ignored.
    """
    return _walked(records, id_col, json_col, graph, rows=True, schema=False)


def written(records: DataFrame, id_col: str, json_col: str, maps: set[str] | None = None, known: set[str] | None = None) -> tuple[DataFrame, Graph]:
    """(rows as of :func:`shredded`, graph): written once, one folder per table; a filter on ``table`` reads that one alone."""
    stay = _staying(known)
    every = stored(_walked(records, id_col, json_col, Graph(maps=set(maps or ()), known=stay), rows=True, schema=True), "shredded", "table")
    rows = _pairs(every.where(F.col("table") == SCHEMA)).limit(MAX_GRAPH + 1).collect()
    graph = _graph_of(rows, set(maps or ()), stay)
    if len(rows) > MAX_GRAPH or _wide_in(rows, stay) - graph.maps or graph.shared or graph.recursive:
        graph = analyse(records, json_col, maps, known)
        every = stored(shredded(records, id_col, json_col, graph), "shredded", "table")
    return every, graph


def tables(records: DataFrame, id_col: str, json_col: str, maps: set[str] | None = None, known: set[str] | None = None) -> dict[str, DataFrame]:
    """Every flat table by name, typed, read from rows that are written once.

    Columns are the record's id, row_id, parent_id, keys, key and the inlined
    elements; where an inlined name clashes with one of these, it gets a
    leading ``_``.
    """
    every, graph = written(records, id_col, json_col, maps, known)
    keys = [id_col, "row_id", "parent_id", "keys", "key"]
    out = {}
    for name in graph.tables():
        cols = graph.columns(name) | ({"value": "string"} if name != ROOT and name[0] != "#" else {})
        typed = [F.try_element_at("columns", F.lit(c)).try_cast(t).alias(c if c not in keys else "_" + c) for c, t in cols.items()]
        rows = every.where((F.col("table") == name) & (F.col("kind") != "null")).withColumn("key", own_key(F.col("keys"), name))
        out[name] = rows.select(*keys, *typed)
    return out


def own_key(keys: Column, table: str) -> Column:
    """The key of a row among its siblings, NULL for rows of tables that do not repeat."""
    return F.try_element_at(keys, F.lit(-1)) if table.rpartition(".")[2] in ("[]", "{}") else F.lit(None).cast("string")
