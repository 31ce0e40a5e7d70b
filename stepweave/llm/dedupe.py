"""Records that differ in writing only: case, punctuation, white space, field order.

Texts pass through a skip-and-fold table straight into two rolling polynomial
hashes; canonical strings are never built. Records whose hashes meet are then
compared with the smallest one of their group, skipping as they go.
"""

from __future__ import annotations

import json
import unicodedata
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepweave.operators.skew import join_heads
from stepweave.session import stored

_P = (np.uint64(2147483647), np.uint64(2147483629))
_B = (np.uint64(1000003), np.uint64(69069069))
_BLOCK = 1 << 21


@cache
def fold_table() -> np.ndarray:
    """For each code point what it folds to; 0: skip it. Letters and digits stay, without case."""
    table = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha() or unicodedata.category(ch)[0] == "N":
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _composed(text: str) -> str:
    """Composed form where a text may hold combining marks; plain ASCII stays as it is."""
    return text if text.isascii() else unicodedata.normalize("NFC", text)


@cache
def _powers(which: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done : done + step] = out[:step] * (out[done - 1] * _B[which] % _P[which]) % _P[which]
        done += step
    return out


def poly_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two 31-bit polynomial hashes and the number of kept characters of each text."""
    n = len(texts)
    sums, kept_n = [np.zeros(n, np.uint64), np.zeros(n, np.uint64)], np.zeros(n, np.int64)
    at = 0
    while at < n:
        upto, size = at, 0
        while upto < n and (upto == at or size + len(texts[upto]) <= _BLOCK):
            size += len(texts[upto])
            upto += 1
        part = [_composed(t) for t in texts[at:upto]]
        codes = fold_table()[_points("".join(part))]
        seg = np.repeat(np.arange(len(part)), [len(t) for t in part])[codes != 0]
        codes = codes[codes != 0].astype(np.uint64)
        counts = np.bincount(seg, minlength=len(part))
        starts = np.concatenate([[0], np.cumsum(counts)])
        place = np.arange(len(codes)) - starts[seg]
        longest = 1 << int(max(1, counts.max(initial=0)) - 1).bit_length()
        for k in (0, 1):
            terms = (codes + np.uint64(1)) * _powers(k, longest)[place] % _P[k]
            run = np.concatenate([[np.uint64(0)], np.cumsum(terms)])
            sums[k][at:upto] = (run[starts[1:]] - run[starts[:-1]]) % _P[k]
        kept_n[at:upto] = counts
        at = upto
    return sums[0], sums[1], kept_n


def _kept_blocks(text: str, block: int = 4096):
    for i in range(0, len(text), block):
        codes = fold_table()[_points(text[i : i + block])]
        yield codes[codes != 0]


def same_writing(a: str, b: str) -> bool:
    """Two-pointer comparison that skips what does not count, block by block."""
    a, b = _composed(a), _composed(b)
    if a == b:
        return True
    left, right = _kept_blocks(a), _kept_blocks(b)
    x = y = np.zeros(0, np.uint32)
    while True:
        while not len(x) and (more := next(left, None)) is not None:
            x = more
        while not len(y) and (more := next(right, None)) is not None:
            y = more
        k = min(len(x), len(y))
        if not k:
            return not len(x) and not len(y)
        if not np.array_equal(x[:k], y[:k]):
            return False
        x, y = x[k:], y[k:]


def record_fields(text: str) -> dict[str, str] | None:
    """Fields of a JSON object as text, nested ones by path; None if it is no object."""
    try:
        value = json.loads(text, parse_float=str, parse_int=str, parse_constant=str)
    except (ValueError, RecursionError):
        return None
    if not isinstance(value, dict):
        return None
    out: dict[str, str] = {}
    stack: list[tuple[str, object]] = [("", value)]
    while stack:
        path, v = stack.pop()
        if isinstance(v, (dict, list)):
            for k, x in v.items() if isinstance(v, dict) else enumerate(v):
                stack.append((f"{path}\x1f{k}", x))
            out[path + "\x1e"] = "object" if isinstance(v, dict) else "array"
        else:
            out[path] = "" if v is None else str(v).lower() if isinstance(v, bool) else str(v)
    return out


def same_record(a: str, b: str) -> bool:
    """Whether two objects have the same fields, each the same but for its writing."""
    if a == b:
        return True
    x, y = record_fields(a), record_fields(b)
    if x is None or y is None:
        return x is y and same_writing(a, b)
    return x.keys() == y.keys() and all(same_writing(v, y[k]) for k, v in x.items())


def record_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As :func:`poly_hashes`, for JSON objects, whatever the order of their fields."""
    owner, names, values = [], [], []
    for i, t in enumerate(texts):
        for k, v in (record_fields(t) or {"": t}).items():
            owner.append(i)
            names.append(k)
            values.append(v)
    n, own = len(texts), np.array(owner, np.int64)
    h = poly_hashes(values)
    weight = pd.util.hash_array(np.array(names, object), categorize=True) if names else np.zeros(0, np.uint64)
    out = []
    for k in (0, 1):
        w = (weight >> np.uint64(31 * k)) % _P[k]
        mixed = (h[k] + w + np.uint64(1)) * (w + np.uint64(7919)) % _P[k]
        mixed = mixed * (h[k] + h[2].astype(np.uint64) % _P[k] + np.uint64(1)) % _P[k]
        total = np.zeros(n, np.uint64)
        np.add.at(total, own, mixed)
        out.append(total % _P[k])
    return out[0], out[1], np.bincount(own, weights=h[2], minlength=n).astype(np.int64)


def writing_groups(records: DataFrame, id_col: str, text_col: str, kind: str = "text") -> DataFrame:
    """(id, keep_id): every record with the smallest id of those it equals but for writing.

    ``kind`` 'text' compares letters and digits in their order without case;
    'record' compares JSON objects field by field, in any field order.

    Nulls: rows without id or text are skipped. Texts without a letter or digit
    (empty ones too) equal each other. Repeated rows count once; an id with two
    contents appears once with each group. Texts that are no JSON object are
    compared as texts. Empty tables give no rows; extra columns are ignored.
    Copies of one content may be any share of the table: groups are reduced to
    their head before the shuffle and hot groups are spread when rows meet it.
    """
    hashes, same = (poly_hashes, same_writing) if kind == "text" else (record_hashes, same_record)
    base = records.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("id is not null and text is not null")

    def hashed(batches):
        for pdf in batches:
            h1, h2, kept = hashes(pdf.text.tolist())
            yield pdf.assign(h=(h1 << np.uint64(31) | h2).astype(np.int64), kept=kept)

    rows = stored(base.mapInPandas(hashed, f"id {base.schema['id'].dataType.simpleString()}, text string, h long, kept long"), "hashed")
    # Ids and counts first; texts only for the heads of groups of two or more rows.
    groups = stored(rows.groupBy("h", "kept").agg(F.count("*").alias("n"), F.min("id").alias("keep_id")), "groups")
    several = groups.where("n > 1")
    first = several.select(F.col("h").alias("h_"), F.col("kept").alias("kept_"), "keep_id", "n")
    texts = rows.join(first, (F.col("h") == F.col("h_")) & (F.col("kept") == F.col("kept_")) & (F.col("id") == F.col("keep_id")))
    heads = stored(texts.groupBy("h", "kept", "keep_id", "n").agg(F.min("text").alias("head")), "heads")

    @F.pandas_udf("boolean")
    def equal(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([same(x, y) for x, y in zip(a, b)], dtype=bool)

    met = join_heads(rows, heads, ["h", "kept"], "n", "id").select("id", "text", "h", "kept", "keep_id", equal("text", "head").alias("same"))
    met = stored(met.select("id", "h", "kept", "keep_id", "same", F.when(~F.col("same"), F.col("text")).alias("text")), "met")

    # Rows whose hashes collided with another content: grouped by their exact folded text.
    @F.pandas_udf("string")
    def folded(a: pd.Series) -> pd.Series:
        def flat(t: str) -> str:
            return "".join(map(chr, np.concatenate([*_kept_blocks(_composed(t)), np.zeros(0, np.uint32)])))

        def one(t: str) -> str:
            fields = record_fields(t) if kind == "record" else None
            return flat(t) if fields is None else json.dumps(sorted((k, flat(v)) for k, v in fields.items()))

        return a.map(one)

    strays = stored(met.where("not same").select("id", "h", "kept", F.sha2(folded("text"), 256).alias("full")), "strays")
    stray_heads = stored(strays.groupBy("h", "kept", "full").agg(F.min("id").alias("keep_id"), F.count("*").alias("n")), "stray_heads")
    regrouped = join_heads(strays, stray_heads, ["h", "kept", "full"], "n", "id").select("id", "keep_id")
    singles = groups.where("n = 1").select(F.col("keep_id").alias("id"), "keep_id")
    return singles.unionByName(met.where("same").select("id", "keep_id").unionByName(regrouped).distinct())


def copies(groups: DataFrame) -> DataFrame:
    """(keep_id, copy_id) of each row of :func:`writing_groups` that is not its group's own head."""
    return groups.where("id <> keep_id").select("keep_id", F.col("id").alias("copy_id"))


def collapsed(groups: DataFrame) -> DataFrame:
    """(keep_id, copies): one row per content with the number of records that have it."""
    return groups.groupBy("keep_id").agg(F.count("*").alias("copies"))
