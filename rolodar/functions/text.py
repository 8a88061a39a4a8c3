"""Text functions as columns; Arrow UDFs only where Spark has no expression (NFKD, sequence ratio)."""

from __future__ import annotations

import re
import unicodedata
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rolodar.functions import fixed


def py_text_key(text: str | None) -> str:
    t = unicodedata.normalize("NFKD", (text or "").strip())
    return re.sub(r"\s+", " ", "".join(c for c in t if not unicodedata.combining(c))).lower()


@F.pandas_udf(T.StringType())
def _foreign_key(text: pd.Series) -> pd.Series:
    return text.map(py_text_key, na_action="ignore")


def text_key(name: str | Column) -> Column:
    """Comparison form: compatibility letters without accents, single blanks, lower case; null becomes ''. Only text
    beyond ASCII leaves the JVM."""
    c = F.col(name) if isinstance(name, str) else name
    ascii_ = F.coalesce(F.rlike(c, F.lit(r"^\p{ASCII}*$")), F.lit(True))
    foreign = _foreign_key(F.when(~ascii_, c))
    return F.when(ascii_, F.lower(F.regexp_replace(clean(c), r"\s+", " "))).otherwise(foreign)


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once and written once, however often ``use`` mentions it.

    Chained columns would be copied into each other by the optimizer (most of all when a filter moves below them)."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


@F.pandas_udf(T.DoubleType())
def seq_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff/Obershelp ratio of lower-cased texts (two empty texts: 1.0; not symmetric)."""
    return pd.Series([SequenceMatcher(None, (x or "").lower(), (y or "").lower()).ratio() for x, y in zip(a, b, strict=True)])


@F.pandas_udf(T.DoubleType())
def best_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Highest sequence ratio between the names of two lists; null where either list is null."""

    def best(xs, ys) -> float | None:
        if xs is None or ys is None:
            return None
        return max((SequenceMatcher(None, (x or "").lower(), (y or "").lower()).ratio() for x in xs for y in ys), default=1.0)

    return pd.Series([best(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def lookup(table: dict[str, str], key: Column) -> Column:
    """Value of a small fixed table, null where there is none."""
    return F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)


def clean(c: Column) -> Column:
    """Trimmed text; null becomes ''."""
    return F.coalesce(F.trim(c), F.lit(""))


def label(c: Column) -> Column:
    return F.lower(clean(c))


def nickname_root(key: Column) -> Column:
    """Root of a name in comparison form."""
    return F.coalesce(lookup(fixed.NICKNAME_ROOT, key), key)


def uuid5(c: Column) -> Column:
    """Version-5 UUID of a text under the fixed namespace."""
    h = F.sha1(F.concat(F.unhex(F.lit(fixed.UUID_NAMESPACE)), F.encode(c, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 2), 16, 10).cast("int").bitwiseAND(0x3F).bitwiseOR(0x80)))
    return F.concat(
        F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 19, 2),
        F.lit("-"), F.substring(h, 21, 12),
    )


def source_priority(source: Column) -> Column:
    out = F.lit(0)
    for name, rank in fixed.SOURCE_PRIORITY.items():
        out = F.when(F.lower(source) == name, rank).otherwise(out)
    return out
