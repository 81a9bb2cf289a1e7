"""Text conformance as native expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _accent_pairs() -> tuple[str, str]:
    """Latin letters that decompose into one ASCII letter plus combining marks."""
    source, target = [], []
    for point in [*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)]:
        base, *marks = unicodedata.normalize("NFD", chr(point))
        if base.isascii() and marks and all(unicodedata.combining(m) for m in marks):
            source.append(chr(point))
            target.append(base)
    return "".join(source), "".join(target)


_ACCENTED, _PLAIN = _accent_pairs()
# Lower-case letters that decompose into no base letter.
_SPELLED_OUT = {"æ": "ae", "ß": "ss", "œ": "oe", "ø": "o", "đ": "d", "ł": "l", "ı": "i"}


def unaccent(value: Column) -> Column:
    out = F.translate(value, _ACCENTED, _PLAIN)
    for letter, plain in _SPELLED_OUT.items():
        out = F.replace(out, F.lit(letter), F.lit(plain))
    return out


def title_words(value: Column) -> Column:
    """Capitalise after every non-alphanumeric character, not only after blanks."""
    pieces = F.regexp_extract_all(value, F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"), F.lit(1))
    return F.array_join(F.transform(pieces, F.initcap), "")


def clean_place(value: Column) -> Column:
    plain = unaccent(F.trim(F.lower(value)))
    return F.nullif(title_words(F.regexp_replace(plain, r"\s+", " ")), F.lit(""))


def zip_prefix(value: Column) -> Column:
    return F.lpad(F.trim(value), 5, "0")


def upper_code(value: Column) -> Column:
    return F.upper(F.trim(value))
