"""Text expressions: stripping, placeholders, fences, JSON repair, path parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPACE = r"[\s\x1c-\x1f]"
# Fixed value: replies that stand for "nothing to say", whole texts in any case.
PLACEHOLDER = r"(?i)^(?:n/a|na|unknown|none|not applicable|no information|not enough information|unclear|unspecified|\.+|-)$"


def strip(text: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(text, rf"(?U)^{_SPACE}+|{_SPACE}+$", "")


def clean_field(text: Column) -> Column:
    """Stripped, and NULL where nothing or a placeholder is left."""
    bare = strip(text)
    return F.when((bare != "") & ~bare.rlike(PLACEHOLDER), bare)


def is_placeholder(text: Column) -> Column:
    return F.coalesce(strip(text).rlike(PLACEHOLDER), F.lit(False))


def filled(text: Column) -> Column:
    """Whether a field holds anything: neither NULL nor the empty text."""
    return F.coalesce(text != "", F.lit(False))


def or_default(*texts: Column) -> Column:
    """The first text that is filled, else NULL."""
    return F.coalesce(*[F.nullif(t, F.lit("")) for t in texts])


def strip_fences(text: Column) -> Column:
    """Without the opening and closing fence of a code block; fences in between stay."""
    return strip(F.regexp_replace(F.regexp_replace(text, r"\A\s*```(?:json)?\s*", ""), r"\s*```\s*\z", ""))


def fix_trailing_commas(text: Column) -> Column:
    return F.regexp_replace(text, r",\s*([}\]])", "$1")


def json_block(text: Column) -> Column:
    """The first ``[...]``, else the first ``{...}``, as short as possible; NULL without either."""
    found = lambda p: F.nullif(F.regexp_extract(text, p, 1), F.lit(""))
    return F.coalesce(found(r"(\[[\s\S]*?\])"), found(r"(\{[\s\S]*?\})"))


def safe_path_part(text: Column) -> Column:
    """Usable as a file name: separators become underscores, which are cut at the ends."""
    return F.btrim(F.translate(text, "/\\:", "___"), F.lit("_"))


def decode_bytes(value: Column) -> Column:
    """UTF-8 text of a binary value, empty for NULL."""
    return F.coalesce(F.decode(value, "UTF-8"), F.lit(""))


def head(text: Column, n: int) -> Column:
    """The first ``n`` characters, with an ellipsis if there are more."""
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n), F.lit("..."))).otherwise(text)


def tail(text: Column, n: int) -> Column:
    """The last ``n`` characters, after an ellipsis if there are more."""
    return F.when(F.length(text) > n, F.concat(F.lit("..."), F.right(text, F.lit(n)))).otherwise(text)


def numbered(prefix: str, number: Column, width: int, suffix: str = "") -> Column:
    """A zero-padded name such as step_00007.png."""
    return F.format_string(f"{prefix}%0{width}d{suffix}", number)


def percent(share: Column) -> Column:
    """A share as whole per cent, ties to even on the binary value."""
    return F.concat(F.bround(share * 100).cast("int").cast("string"), F.lit("%"))


def data_url(image: Column, mime: str = "image/jpeg") -> Column:
    return F.concat(F.lit(f"data:{mime};base64,"), F.base64(image))


def wrapped(text: str | None, width: int) -> str:
    """Greedy word wrap; a dash for nothing. For presentation on the driver."""
    lines: list[str] = []
    for word in (text or "").split():
        if lines and len(lines[-1]) + 1 + len(word) <= width:
            lines[-1] += " " + word
        else:
            lines.append(word)
    return "\n".join(lines) or "—"
