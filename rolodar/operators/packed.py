"""Several values packed in one field: infer the delimiters of every source, split, explode.

``unpack_fields`` turns text fields into one row per value with its place.

1. Double-quoted stretches are masked, so that separators inside them do not count.
2. ``delimiter_profile`` scores every candidate separator for every source (one scan, one small aggregation): over
   the values that hold the candidate, piece-count consistency (as many pieces as typed anchors: ``@`` signs,
   ten-digit runs) times piece-type regularity (share of pieces of the field's type).
3. Values are split by the separators accepted for their source. A blank is a weak separator: it only splits where
   every piece is regular by itself.
4. Each piece loses label, display name, angle brackets and enclosing quotes; pieces without a letter or digit go.

Everything stays in JVM expressions; the only shuffle is the profile's (rows = sources x candidates).

Defined results: null, blank and punctuation-only fields give no row; repeated values keep their own places; a null
source forms its own profile; unbalanced quotes count as ordinary characters from the last one on; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEP = ""
#: Separators hidden inside quotes, each by a private-use character.
_HIDE = ",;|/: \t\n\r"
_HIDDEN = "".join(chr(0xE000 + i) for i in range(len(_HIDE)))

#: name, pattern that splits, pattern that tells its presence
CANDIDATES: list[tuple[str, str, str]] = [
    ("line", r"[ \t]*[\r\n]+[ \t]*", r"[\r\n]"),
    ("colons", r"\s*:{3,}\s*", r":{3,}"),
    ("semicolon", r"\s*;(?!ext)[;\s]*", r";(?!ext)"),
    ("pipe", r"\s*\|[|\s]*", r"\|"),
    ("tab", r" *\t+ *", r"\t"),
    ("comma", r"\s*,(?! *ext)[,\s]*", r",(?! *ext)"),
    ("slash", r"\s+/\s+", r"\s/\s"),
    ("or", r"\s+(?:or|and|oder|ou)\s+", r"\s(?:or|and|oder|ou)\s"),
    ("space", r" +", r"[^\s,;|/:>] +[^\s,;|/:(<]"),
]


@dataclass(frozen=True)
class FieldType:
    """What a regular value of the field looks like, and what marks one in running text."""

    regular: str
    anchor: str


EMAIL = FieldType(r"^[^\s@<>\"(),;:|]+@[^\s@<>\"(),;:|]+\.[^\s@<>\"(),;:|.]+$", r"@")
PHONE = FieldType(
    r"(?i)^\+?[\d(][\d\s().\-]{5,}\d(?:\s*[,;]?\s*(?:ext\.?|x|#)\s*=?\s*\d{1,6})?$",
    r"(?:\+?\d{1,3}[-. ]?)?\(?\d{3}\)?[-. ]?\d{3}[-. ]?\d{4}",
)
BROKEN_EMAIL = FieldType(r"^\S*(?:@|#|\(at\))\S*$", r"@+|#|\(at\)")

FIELD_TYPES = {"emails": EMAIL, "phones": PHONE, "invalid_emails": BROKEN_EMAIL}


def mask_quotes(text: Column) -> Column:
    """Hide the separators inside balanced double quotes."""
    parts = F.split(text, '"', -1)
    hidden = F.transform(
        parts,
        lambda p, i: F.when((i % 2 == 1) & (i < F.size(parts) - 1), F.translate(p, _HIDE, _HIDDEN)).otherwise(p),
    )
    return F.when(F.contains(text, F.lit('"')), F.array_join(hidden, '"')).otherwise(text)


_OUTER = r"^[\s\u00A0\u2000-\u200B\u202F\u3000]+|[\s\u00A0\u2000-\u200B\u202F\u3000]+$"


def _has(p: Column, text: str) -> Column:
    return F.contains(p, F.lit(text))


def _guarded(test, change):
    return lambda p: F.when(test(p), change(p)).otherwise(p)


#: Steps of the cleaning; each is guarded by a plain test, as most pieces need none of them.
_CLEANING = [
    lambda p: F.regexp_replace(p, _OUTER, ""),
    _guarded(lambda p: _has(p, "::"), lambda p: F.regexp_replace(p, r"::\s*[\p{L} _-]*$", "")),
    _guarded(lambda p: F.endswith(p, F.lit(")")), lambda p: F.regexp_replace(p, r"\s+\([\p{L} ]+\)$", "")),
    _guarded(
        lambda p: _has(p, ":"),
        lambda p: F.regexp_replace(p, r"^(?i:mailto|tel|e-?mail|phone|work|home|mobile|cell|fax|main|other)\s*:\s*(?=\S)", ""),
    ),
    _guarded(lambda p: F.endswith(p, F.lit(">")), lambda p: F.regexp_replace(p, r"^(?s:.*)<([^<>]*)>$", "$1")),
    _guarded(
        lambda p: _has(p, '"'), lambda p: F.translate(F.regexp_replace(p, r'^\s*"([^"]*)"\s*$', "$1"), _HIDDEN, _HIDE)
    ),
    _guarded(lambda p: F.rlike(p, F.lit(r"^\s|\s$")), lambda p: F.regexp_replace(p, _OUTER, "")),
]


def clean_pieces(pieces: Column) -> Column:
    """Pieces without label, display name, angle brackets, enclosing quotes and outer blanks; unfilled ones go.

    One ``transform`` per step, so that no step copies the expression of the one before."""
    for step in _CLEANING:
        pieces = F.transform(pieces, step)
    return F.filter(pieces, lambda p: F.rlike(p, F.lit(_FILLED)))


_FILLED = r"[\p{L}\p{N}]"


def _by_field(kinds: dict[str, FieldType], make) -> Column:
    """make(kind) of the row's field."""
    out = None
    for name, kind in kinds.items():
        out = F.when(F.col("f") == name, make(kind)) if out is None else out.when(F.col("f") == name, make(kind))
    return out


def _stacked(df: DataFrame, key: Column, source: str, fields: list[str]) -> DataFrame:
    """k, s, f, m: one row per row and filled field, quotes masked; one scan for all fields."""
    cells = F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).cast("string").alias("v")) for f in fields])
    return (
        df.select(key.alias("k"), F.col(source).alias("s"), F.explode(cells).alias("c"))
        .where(F.rlike(F.col("c.v"), F.lit(_FILLED)))
        .select("k", "s", "c.f", mask_quotes(F.col("c.v")).alias("m"))
    )


def _score(name: str, kinds: dict[str, FieldType]):
    def score(ps: Column) -> Column:
        fits = _by_field(kinds, lambda k: F.size(F.filter(ps, lambda p: F.rlike(p, F.lit(k.regular)))))
        return F.struct(
            F.lit(name).alias("delimiter"),
            F.size(ps).alias("n"),
            (F.size(ps) == F.col("anchors")).cast("double").alias("same"),
            (fits / F.size(ps)).alias("regular"),
        )

    return score


def delimiter_profile(df: DataFrame, source: str, kinds: dict[str, FieldType]) -> DataFrame:
    """source, field, delimiter, n_values, consistency, regularity, score - of every candidate seen there."""
    base = _stacked(df, F.lit(None).cast("long"), source, list(kinds)).withColumn(
        "anchors", F.size(_by_field(kinds, lambda k: F.regexp_extract_all(F.translate(F.col("m"), _HIDDEN, _HIDE), F.lit(k.anchor), F.lit(0))))
    )
    tests = []
    for name, split_by, present in CANDIDATES:
        # The one-element array evaluates the pieces once.
        pieces = F.array(clean_pieces(F.split(F.col("m"), split_by, -1)))
        tests.append(F.when(F.rlike(F.col("m"), F.lit(present)), F.get(F.transform(pieces, _score(name, kinds)), F.lit(0))))
    return (
        base.select("s", "f", F.explode(F.array_compact(F.array(*tests))).alias("t"))
        .where(F.col("t.n") > 1)
        .groupBy(F.col("s").alias("source"), F.col("f").alias("field"), F.col("t.delimiter").alias("delimiter"))
        .agg(F.count("*").alias("n_values"), F.avg("t.same").alias("consistency"), F.avg("t.regular").alias("regularity"))
        .withColumn("score", F.col("consistency") * F.col("regularity"))
    )


def accepted_delimiters(profile: DataFrame, threshold: float, weak_threshold: float) -> DataFrame:
    """rule_source, rule_field, delims: the separators whose score reaches the threshold (a blank has its own)."""
    bar = F.when(F.col("delimiter") == "space", F.lit(weak_threshold)).otherwise(F.lit(threshold))
    return (
        profile.where(F.col("score") >= bar)
        .groupBy(F.col("source").alias("rule_source"), F.col("field").alias("rule_field"))
        .agg(F.sort_array(F.collect_set("delimiter")).alias("delims"))
    )


def split_field(masked: Column, delims: Column, kinds: dict[str, FieldType]) -> Column:
    """Array of the values in a quote-masked field, by the separators in ``delims``."""
    def mark(name: str, split_by: str, present: str):
        use = F.array_contains(delims, name)
        return lambda x: F.when(use & F.rlike(x, F.lit(present)), F.regexp_replace(x, split_by, SEP)).otherwise(x)

    one = F.array(masked)
    for candidate in CANDIDATES:
        if candidate[0] != "space":
            one = F.transform(one, mark(*candidate))
    x = F.get(one, F.lit(0))
    parts = F.transform(F.split(x, SEP, -1), lambda p: F.trim(p))

    def by_space(p: Column) -> Column:
        words = F.split(p, " +", -1)
        fits = _by_field(kinds, lambda k: F.forall(words, lambda w: F.rlike(w, F.lit(k.regular))))
        return F.when(_has(p, " ") & fits, words).otherwise(F.array(p))

    parts = F.when(F.array_contains(delims, "space") & _has(masked, " "), F.flatten(F.transform(parts, by_space))).otherwise(parts)
    return clean_pieces(parts)


def unpack_fields(
    df: DataFrame,
    key: str,
    fields: list[str],
    source: str = "source",
    kinds: dict[str, FieldType] | None = None,
    threshold: float = 0.3,
    weak_threshold: float = 0.05,
) -> DataFrame:
    """key, field_name, pos, item_value: one row per value of each field, in its written order."""
    kinds = {f: (kinds or FIELD_TYPES)[f] for f in fields}
    rules = accepted_delimiters(delimiter_profile(df, source, kinds), threshold, weak_threshold)
    rows = _stacked(df, F.col(key), source, fields)
    # One row per source and field on the right: a map-side join as long as it stays under the broadcast threshold.
    joined = rows.join(rules, F.col("s").eqNullSafe(F.col("rule_source")) & (F.col("f") == F.col("rule_field")), "left")
    delims = F.coalesce(F.col("delims"), F.array().cast("array<string>"))
    return (
        joined.withColumn("delims", delims)
        .select(F.col("k"), F.col("f"), F.posexplode(split_field(F.col("m"), F.col("delims"), kinds)).alias("p", "item_value"))
        .select(F.col("k").alias(key), F.col("f").alias("field_name"), (F.col("p") + 1).cast("int").alias("pos"), "item_value")
    )


def unpack(df: DataFrame, key: str, field: str, kind: FieldType, source: str = "source", threshold: float = 0.3) -> DataFrame:
    """``unpack_fields`` of one field of any name."""
    return unpack_fields(df, key, [field], source, {field: kind}, threshold)


def filled(column: Column) -> Column:
    """Whether a packed field holds at least one value (the test that ``unpack`` applies to whole fields)."""
    return F.coalesce(F.rlike(column, F.lit(_FILLED)), F.lit(False))
