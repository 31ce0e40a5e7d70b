"""TFRecord files of tf.Example records, as a Spark data source for reading and writing."""

from __future__ import annotations

import gzip
import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from stepweave.operators.skew import small_side
from stepweave.sources.files import file_system, listed

FEATURES = "features map<string,struct<bytes:array<binary>,floats:array<float>,ints:array<bigint>>>, file string, place bigint"


@cache
def _crc_table() -> list[int]:
    table = []
    for n in range(256):
        for _ in range(8):
            n = n >> 1 ^ (0x82F63B78 if n & 1 else 0)
        table.append(n)
    return table


def masked_crc(data: bytes) -> int:
    """The checksum of the record format (Castagnoli, rotated and shifted)."""
    table, crc = _crc_table(), 0xFFFFFFFF
    for b in data:
        crc = table[(crc ^ b) & 255] ^ crc >> 8
    crc ^= 0xFFFFFFFF
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def records(path: str, check: bool = False) -> Iterator[bytes]:
    """The payloads of a record file, plain or gzipped; one that breaks off fails."""
    with _opened(path) as f:
        while head := f.read(12):
            if len(head) < 12:
                raise ValueError(f"{path} breaks off in a record's head")
            size, crc = struct.unpack("<QI", head)
            body = f.read(size + 4)
            if len(body) < size + 4:
                raise ValueError(f"{path} breaks off in a record")
            if check and (masked_crc(head[:8]) != crc or masked_crc(body[:-4]) != struct.unpack("<I", body[-4:])[0]):
                raise ValueError(f"{path} has a record with a wrong checksum")
            yield body[:-4]


def _opened(path: str):
    where, inner = file_system(path)
    raw = where.open_input_stream(inner, compression=None)
    return gzip.open(raw) if path.endswith(".gz") else raw


def count_records(path: str) -> int:
    """How many records a file has, by their heads alone; the one that breaks off doesn't count."""
    if path.endswith(".gz"):
        n = 0
        try:
            for _ in records(path):
                n += 1
        except (ValueError, EOFError):
            pass
        return n
    where, inner = file_system(path)
    with where.open_input_file(inner) as f:
        n, at, end = 0, 0, f.size()
        while at + 12 <= end:
            at += 16 + struct.unpack("<Q", f.read_at(8, at))[0]
            n += at <= end
    return n


def framed(data: bytes) -> bytes:
    head = struct.pack("<Q", len(data))
    return head + struct.pack("<I", masked_crc(head)) + data + struct.pack("<I", masked_crc(data))


def _varint(buf: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = buf[at]
        at += 1
        value |= (b & 127) << shift
        if b < 128:
            return value, at
        shift += 7


def _fields(buf: bytes) -> Iterator[tuple[int, int, bytes | int]]:
    """(number, wire type, value) of every field of a message."""
    at = 0
    while at < len(buf):
        key, at = _varint(buf, at)
        number, wire = key >> 3, key & 7
        if wire == 0:
            value, at = _varint(buf, at)
        elif wire == 2:
            size, at = _varint(buf, at)
            value, at = buf[at : at + size], at + size
        elif wire == 5:
            value, at = buf[at : at + 4], at + 4
        elif wire == 1:
            value, at = buf[at : at + 8], at + 8
        else:
            raise ValueError(f"wire type {wire}")
        yield number, wire, value


def _signed(v: int) -> int:
    return v - (1 << 64) if v >= 1 << 63 else v


def decode_example(buf: bytes) -> dict[str, dict[str, list | None]]:
    """The feature map of a tf.Example; of bytes, floats and ints the one that is set."""
    out: dict[str, dict[str, list | None]] = {}
    for n, _, features in _fields(buf):
        if n != 1:
            continue
        for n2, _, entry in _fields(features):
            if n2 != 1:
                continue
            name, feature = "", b""
            for k, _, v in _fields(entry):
                name, feature = (v.decode("utf-8", "replace"), feature) if k == 1 else (name, v)
            got: dict[str, list | None] = {"bytes": None, "floats": None, "ints": None}
            for kind, _, lst in _fields(feature):
                values: list = []
                for _, wire, v in _fields(lst):
                    if kind == 1:
                        values.append(v)
                    elif kind == 2:
                        values += struct.unpack(f"<{len(v) // 4}f", v)
                    elif wire == 0:
                        values.append(_signed(v))
                    else:
                        at = 0
                        while at < len(v):
                            x, at = _varint(v, at)
                            values.append(_signed(x))
                got[("bytes", "floats", "ints")[kind - 1]] = values
            out[name] = got
    return out


def _put(value: int) -> bytes:
    value &= (1 << 64) - 1
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    out.append(value)
    return bytes(out)


def _block(number: int, data: bytes) -> bytes:
    return _put(number << 3 | 2) + _put(len(data)) + data


def encode_example(features: dict[str, dict[str, list | None]]) -> bytes:
    entries = b""
    for name in sorted(features):
        f = features[name]
        if f.get("bytes") is not None:
            body = _block(1, b"".join(_block(1, bytes(b)) for b in f["bytes"]))
        elif f.get("floats") is not None:
            body = _block(2, _block(1, struct.pack(f"<{len(f['floats'])}f", *f["floats"])))
        else:
            body = _block(3, _block(1, b"".join(_put(int(i)) for i in f.get("ints") or [])))
        entries += _block(1, _block(1, name.encode()) + _block(2, body))
    return _block(1, entries)


@dataclass
class _File(InputPartition):
    path: str


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.check = options["path"], options.get("check", "false") == "true"
        self.split, self.strict, self.heads = options.get("split"), options.get("mode", "skip") == "failfast", options.get("heads", "false") == "true"

    def partitions(self) -> list[InputPartition]:
        files = [p for p, folder in listed(self.path) if not folder]
        if not files:
            return [_File(self.path)]
        named = [(p, p.rsplit("/", 1)[-1]) for p in files]
        return [_File(p) for p, n in named if ".tfrecord" in n and not n.startswith(".") and (not self.split or f"-{self.split}." in n or n.startswith(self.split))]

    def read(self, partition: _File):
        """Rows of features, file and place; a broken record has no features, one that breaks off ends its file."""
        if self.heads:
            yield None, partition.path, count_records(partition.path)
            return
        place = 0
        try:
            for payload in records(partition.path, self.check):
                try:
                    found = {k: (v["bytes"], v["floats"], v["ints"]) for k, v in decode_example(payload).items()}
                except (ValueError, IndexError, struct.error):
                    if self.strict:
                        raise
                    found = None
                yield found, partition.path, place
                place += 1
        except (ValueError, EOFError):
            if self.strict:
                raise
            yield None, partition.path, place


@dataclass
class _Written(WriterCommitMessage):
    path: str


class _Writer(DataSourceWriter):
    """Each task writes a hidden file; the commit gives them their names."""

    def __init__(self, options: dict) -> None:
        self.path, self.name = options["path"], options.get("name", "data")

    def write(self, rows) -> WriterCommitMessage:
        import uuid

        os.makedirs(self.path, exist_ok=True)
        part = os.path.join(self.path, f".{uuid.uuid4().hex}")
        with open(part, "wb") as f:
            for row in rows:
                f.write(framed(encode_example({k: v.asDict() if hasattr(v, "asDict") else dict(zip(("bytes", "floats", "ints"), v)) for k, v in row["features"].items()})))
        return _Written(part)

    def commit(self, messages: list) -> None:
        done = [m for m in messages if m is not None]
        for i, m in enumerate(done):
            os.replace(m.path, os.path.join(self.path, f"{self.name}.tfrecord-{i:05d}-of-{len(done):05d}"))

    def abort(self, messages: list) -> None:
        for m in messages:
            if m is not None and os.path.exists(m.path):
                os.remove(m.path)


class TFRecordSource(DataSource):
    """``spark.read.format("tfrecord")``: one task per file, a map of features per record with its file and place.

    Broken records have NULL features, so that they can be counted; with ``mode`` "failfast" they fail.
    """

    @classmethod
    def name(cls) -> str:
        return "tfrecord"

    def schema(self) -> str:
        return FEATURES

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Writer(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TFRecordSource)


def _f(name: str) -> Column:
    return F.try_element_at("features", F.lit(name))


def _vectors(values: Column, n: Column) -> Column:
    """A flat list of n equal vectors as a list of vectors."""
    size = (F.size(values) / n).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice(values, i * size + 1, size)))


def numbered(raw: DataFrame, counts: DataFrame) -> DataFrame:
    """``raw`` with ``number``, the record's place in the order of all files; ``counts`` is file, place (its records), a row a file."""
    before = F.sum("place").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("file", F.coalesce(before, F.lit(0)).alias("_before"))
    return raw.join(small_side(offsets), "file", "left").withColumn("number", F.col("place") + F.coalesce("_before", F.lit(0))).drop("_before")


def demonstrations(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(episodes, steps) of records that hold one demonstration each, in the flattened nested layout.

    Names that older files use stand in for missing ones; an episode without
    path gets a name of its number among all records (:func:`numbered`), else
    within its file. Broken records are left out. Steps default to action zeros, reward 0 and
    discount 1; the first and the last one are flagged as such.
    """
    text = lambda c: F.coalesce(F.decode(F.get(c["bytes"], 0), "UTF-8"), F.lit(""))
    action = _f("steps/action")["floats"]
    n = F.coalesce(F.nullif(F.size(_f("steps/is_first")["ints"]), F.lit(-1)), (F.size(action) / 7).cast("int"))
    either = lambda a, b, kind: F.coalesce(_f(a)[kind], _f(b)[kind])
    path = text(_f("episode_metadata/file_path"))
    number = F.col("number") if "number" in raw.columns else F.col("place")
    base = raw.where("features is not null").select(
        number.alias("_i"), path.alias("source_file"), F.get(_f("episode_metadata/episode_id")["ints"], 0).cast("int").alias("episode_num"), n.alias("n"),
        _vectors(action, n).alias("action"), _vectors(either("steps/observation/state", "steps/observation/proprio", "floats"), n).alias("state"),
        *[either(f"steps/observation/image_{k}", f"steps/observation/images{k}", "bytes").alias(f"image_{k}") for k in range(4)],
        _f("steps/language_instruction")["bytes"].alias("words"), _vectors(_f("steps/language_embedding")["floats"], n).alias("language_embedding"),
        *[_f(f"steps/{k}")["ints"].alias(k) for k in ("is_first", "is_last", "is_terminal")], *[_f(f"steps/{k}")["floats"].alias(k) for k in ("reward", "discount")],
    )
    named = base.withColumn("episode_id", F.coalesce(F.nullif("source_file", F.lit("")), F.format_string("bridge_ep_%06d", F.col("_i"))))
    i = F.col("step_index")
    steps = named.where("n > 0").withColumn("step_index", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).select(
        "episode_id", "episode_num", "step_index", *[F.get(f"image_{k}", i).alias(f"image_{k}") for k in range(4)], F.get("state", i).alias("state"),
        F.coalesce(F.get("action", i), F.array_repeat(F.lit(0.0).cast("float"), 7)).alias("action"),
        F.coalesce(F.decode(F.get("words", i), "UTF-8"), F.lit("")).alias("language_instruction"), F.get("language_embedding", i).alias("language_embedding"),
        ((i == 0) | (F.coalesce(F.get("is_first", i), F.lit(0)) == 1)).alias("is_first"), ((i == F.col("n") - 1) | (F.coalesce(F.get("is_last", i), F.lit(0)) == 1)).alias("is_last"),
        (F.coalesce(F.get("is_terminal", i), F.lit(0)) == 1).alias("is_terminal"), F.coalesce(F.get("reward", i), F.lit(0.0)).cast("double").alias("reward"),
        F.coalesce(F.get("discount", i), F.lit(1.0)).cast("double").alias("discount"),
    )
    texts = F.filter(F.transform(F.coalesce("words", F.array().cast("array<binary>")), lambda w: F.decode(w, "UTF-8")), lambda w: w != "")
    episodes = named.select("episode_id", "source_file", "episode_num", F.coalesce(F.get(texts, 0), F.lit("")).alias("language_instruction"), F.col("n").alias("n_steps"), F.col("_i").alias("record_number"))
    return episodes, steps
