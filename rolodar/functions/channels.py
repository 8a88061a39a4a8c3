"""E-mail and phone functions as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rolodar.functions import fixed
from rolodar.functions.text import clean, label, let, lookup

#: A mailbox: a local part, and a domain of labels that ends in letters.
EMAIL_IN_TEXT = r"[\w.%+'-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}"
#: Digits with what may stand between them; a number has at least ``PHONE_LENGTH`` characters of these.
DIGIT_RUN = r"\+?\d(?:[\d\s()./-]*\d)?"
PHONE_LENGTH = 8
#: How an extension is announced, and the forms it takes behind a number: (pattern, group of number, group of digits).
EXTENSION_WORD = r"(?i:extension|ext\.|ext|x)"
EXTENSION_FORMS = [
    (r"(?s)^(.*);\s*(\d{1,6})$", 1, 2),
    (r"(?s)^(.*[^\s,;/])[\s,;/]*" + EXTENSION_WORD + r"\s*(\d{1,6})$", 1, 2),
    (r"(?s)^(.*\S)\s*[pP](\d{1,6})#$", 1, 2),
]


def normalize_email(c: Column, keep_local_case: bool = True) -> Column:
    """Without blanks, domain (or all) in lower case; null where it is no address."""
    e = F.replace(clean(c), F.lit(" "), F.lit(""))
    low = F.concat(F.substring_index(e, "@", 1), F.lit("@"), F.lower(F.substring_index(e, "@", -1))) if keep_local_case else F.lower(e)
    return F.when(F.rlike(e, F.lit(f"^{EMAIL_IN_TEXT}$")), low)


def emails_in_text(c: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(EMAIL_IN_TEXT), F.lit(0))


def without_emails(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), EMAIL_IN_TEXT, ""))


def email_domain(c: Column) -> Column:
    return F.when(F.contains(c, F.lit("@")), F.lower(F.get(F.split(c, "@"), F.lit(1))))


def local_part(c: Column) -> Column:
    return F.when(F.contains(c, F.lit("@")), F.substring_index(c, "@", 1)).otherwise("")


def guess_first(local: Column) -> Column:
    """First name guessed from a mailbox name: its first part with a capital letter."""
    part = F.coalesce(F.get(F.filter(F.split(local, "[._-]+"), lambda p: p != ""), F.lit(0)), F.lit(""))
    return F.concat(F.upper(F.substring(part, 1, 1)), F.lower(F.substr(part, F.lit(2))))


def initial_from_local(local: Column, last: Column) -> Column:
    """Upper-case initial if the mailbox name is the family name after one or two letters."""
    lo, la = F.lower(local), F.lower(last)
    extra = F.length(lo) - F.length(la)
    return F.when((la != "") & F.endswith(lo, la) & extra.between(1, 2), F.upper(F.substring(lo, 1, 1))).otherwise("")


def phone_e164(c: Column, country: str = "US") -> Column:
    """International form by digit count; text without digits stays as it is. Numbers without a country code get that of
    ``country``; outside North America a leading 0 stands for it."""
    code = fixed.CALLING_CODE.get(country.upper(), "1")
    raw = clean(c)
    d = F.regexp_replace(raw, r"\D", "")
    n = F.length(d)
    local = d if code == "1" else F.regexp_replace(d, "^0", "")
    own = (n == 11) & F.startswith(d, F.lit("1")) if code == "1" else F.startswith(d, F.lit(code)) & (n >= 10 + len(code) - 1) & ~F.startswith(d, F.lit("0"))
    return (
        F.when(n == 0, raw)
        .when(F.startswith(raw, F.lit("+")), F.concat(F.lit("+"), d))
        .when(own, F.concat(F.lit("+"), d))
        .when(n.between(12, 15), F.concat(F.lit("+"), d))
        .otherwise(F.concat(F.lit(f"+{code}"), local))
    )


def phone_valid(c: Column) -> Column:
    return F.startswith(c, F.lit("+")) & (F.length(F.regexp_replace(c, r"\D", "")) >= 11)


def split_extension(c: Column) -> Column:
    """struct(value, extension) of one written number: the first form that fits."""

    def of_text(s: Column) -> Column:
        out = None
        for pattern, number, digits in EXTENSION_FORMS:
            value = F.regexp_replace(F.regexp_extract(s, pattern, number), r"^[\s,;/]+|[\s,;/]+$", "")
            found = F.struct(value.alias("value"), F.regexp_extract(s, pattern, digits).alias("extension"))
            fits = F.rlike(s, F.lit(pattern))
            out = F.when(fits, found) if out is None else out.when(fits, found)
        return out.otherwise(F.struct(s.alias("value"), F.lit("").alias("extension")))

    return let(clean(c), of_text)


def numbers_in_text(c: Column) -> Column:
    """The runs of digits in a text that are long enough for a phone number."""
    runs = F.regexp_extract_all(c, F.lit(DIGIT_RUN), F.lit(0))
    return F.filter(runs, lambda r: F.length(F.ltrim(r, F.lit("+"))) >= PHONE_LENGTH)


def split_values(raw: Column) -> Column:
    """Values of an export field: split at line breaks, bars, semicolons and three or more colons; blanks go."""
    return F.filter(F.transform(F.split(F.coalesce(raw, F.lit("")), r"[\r\n|;]+|:{3,}"), lambda p: F.trim(p)), lambda p: p != "")


def phone_values(raw: Column) -> Column:
    """array<struct(value, extension)> of an export field; a bare extension joins the number before it."""

    def of_segment(seg: Column) -> Column:
        parts = F.array(split_extension(seg))

        def runs(p: Column) -> Column:
            found = numbers_in_text(p["value"])
            each = F.transform(
                found, lambda m, i: F.struct(F.trim(m).alias("value"), F.when(i == F.size(found) - 1, p["extension"]).otherwise("").alias("extension"))
            )
            return F.when(F.size(found) > 0, each).otherwise(F.array(p))

        return F.flatten(F.transform(parts, runs))

    parts = F.filter(F.flatten(F.transform(split_values(raw), of_segment)), lambda p: p["value"] != "")
    bare = r"^(?:" + EXTENSION_WORD + r")?\s*(\d{1,6})$"
    empty = F.array().cast("array<struct<value:string,extension:string>>")

    def fold(acc: Column, p: Column) -> Column:
        ext = F.regexp_extract(p["value"], bare, 1)
        last = F.get(acc, F.size(acc) - 1)
        joins = (p["extension"] == "") & (ext != "") & (F.size(acc) > 0) & (last["extension"] == "")
        joined = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last["value"].alias("value"), ext.alias("extension"))))
        return F.when(joins, joined).otherwise(F.concat(acc, F.array(p)))

    return F.aggregate(parts, empty, fold)


def with_extension(value: Column, extension: Column) -> Column:
    return F.concat(value, F.when(F.coalesce(extension, F.lit("")) != "", F.concat(F.lit("x"), extension)).otherwise(""))


def export_label(raw: Column, phone: bool) -> Column:
    """struct(label, preferred) of a webmail export label; a leading star marks the preferred one."""
    t = clean(raw)
    low = F.lower(F.trim(F.regexp_replace(t, r"^\*+", "")))
    mobile = F.rlike(low, F.lit("mobile|cell|iphone")) if phone else F.lit(False)
    name = F.when(mobile, "mobile")
    for known in ("work", "home", "other"):
        name = name.when(F.contains(low, F.lit(known)), known)
    return F.struct(name.when(low != "", "other").otherwise("").alias("label"), F.startswith(t, F.lit("*")).alias("preferred"))


def type_tokens(params: Column) -> Column:
    """Type words of a vCard property's parameters (an array), without pref and internet."""

    def words(p: Column) -> Column:
        named = F.contains(p, F.lit("="))
        value = F.when(named & (F.lower(F.trim(F.substring_index(p, "=", 1))) == "type"), F.regexp_replace(p, "^[^=]*=", "")).when(~named, p)
        return F.split(F.coalesce(value, F.lit("")), "[;,]")

    flat = F.transform(F.flatten(F.transform(params, words)), lambda w: F.regexp_replace(F.lower(F.trim(w)), "^x-", ""))
    return F.filter(flat, lambda w: (w != "") & ~w.isin("pref", "internet"))


def apple_label(c: Column) -> Column:
    return F.coalesce(lookup(fixed.APPLE_LABELS, label(c)), label(c))


def unescape_vcard(c: Column) -> Column:
    for a, b in ((r"\;", ";"), (r"\,", ","), (r"\n", "\n"), (r"\N", "\n"), ("\\\\", "\\")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def dedupe(items: Column, key, build) -> Column:
    """First place of every key, with its first non-empty label. ``key(item)``, ``build(first item, label)``."""
    keys = F.array_distinct(F.transform(items, key))

    def one(k: Column) -> Column:
        same = F.filter(items, lambda x: key(x) == k)
        best = F.get(F.filter(F.transform(same, lambda x: x["label"]), lambda v: v != ""), F.lit(0))
        return build(F.get(same, F.lit(0)), F.coalesce(best, F.lit("")))

    return F.transform(keys, one)


def normalize_emails(items: Column, keep_local_case: bool = True, drop_invalid: bool = False) -> Column:
    """Valid addresses once each with their best label, then invalid ones once each, labelled so."""
    rows = F.filter(items, lambda x: clean(x["value"]) != "")
    tagged = F.transform(
        rows, lambda x: F.struct(clean(x["value"]).alias("raw"), normalize_email(x["value"], keep_local_case).alias("value"), label(x["label"]).alias("label"))
    )
    email = lambda v, b: F.struct(v.alias("value"), b.alias("label"))
    good = dedupe(F.filter(tagged, lambda x: x["value"].isNotNull()), lambda x: x["value"], lambda x, b: email(x["value"], b))
    bad = dedupe(F.filter(tagged, lambda x: x["value"].isNull()), lambda x: F.lower(x["raw"]), lambda x, b: email(x["raw"], F.lit("invalid")))
    return good if drop_invalid else F.concat(good, bad)


def normalize_phones(items: Column, drop_invalid: bool = False, country: str = "US") -> Column:
    """Numbers in international form once per number and extension; others follow as written, labelled invalid."""
    rows = F.filter(items, lambda x: clean(x["value"]) != "")
    tagged = F.transform(
        rows,
        lambda x: F.struct(
            clean(x["value"]).alias("raw"), phone_e164(x["value"], country).alias("value"), label(x["label"]).alias("label"), clean(x["extension"]).alias("extension")
        ),
    )
    phone = lambda v, b, e: F.struct(v.alias("value"), b.alias("label"), e.alias("extension"))
    key = lambda v, x: F.concat(v, F.lit("|"), x["extension"])
    good = dedupe(F.filter(tagged, lambda x: phone_valid(x["value"])), lambda x: key(x["value"], x), lambda x, b: phone(x["value"], b, x["extension"]))
    bad = dedupe(F.filter(tagged, lambda x: ~phone_valid(x["value"])), lambda x: key(x["raw"], x), lambda x, b: phone(x["raw"], F.lit("invalid"), x["extension"]))
    return good if drop_invalid else F.concat(good, bad)
