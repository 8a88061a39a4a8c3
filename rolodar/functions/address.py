"""Postal address functions as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rolodar.functions import fixed
from rolodar.functions.channels import dedupe
from rolodar.functions.text import clean, label, let, lookup

FIELDS = ["po_box", "extended", "street", "city", "state", "postal_code", "country", "label"]
def state_code(c: Column) -> Column:
    t = clean(c)
    return F.when(F.length(t) == 2, F.upper(t)).otherwise(F.coalesce(lookup(fixed.STATE_CODE, F.lower(t)), F.upper(t)))


def country_code(c: Column) -> Column:
    t = clean(c)
    return F.coalesce(lookup(fixed.COUNTRY_CODE, F.lower(t)), F.when(F.length(t) == 2, F.upper(t)).otherwise(t))


def split_tail(street: Column) -> Column:
    """struct(street, city, state, postal_code) of a street that ends in city, state and code, read from the right; null
    for any other. The city is what follows the last comma before the state, or all but the first word if there is none. What stays as street is one line."""
    trimmed = lambda c: F.regexp_replace(c, r"[,\s]+$", "")

    def of_code(code: Column) -> Column:
        digits = F.regexp_extract(code, r"^\d+", 0)

        def of_rest(rest: Column) -> Column:
            state = F.element_at(F.split(rest, r"[,\s]"), -1)
            body = trimmed(F.substr(rest, F.lit(1), F.length(rest) - F.length(state)))
            comma = F.contains(body, F.lit(","))
            city = F.when(comma, F.substring_index(body, ",", -1)).otherwise(F.regexp_replace(body, r"^\S+\s+", ""))
            head = trimmed(F.substr(body, F.lit(1), F.length(body) - F.length(city)))
            whole = F.struct(head.alias("street"), F.trim(city).alias("city"), state.alias("state"), digits.alias("postal_code"))
            parted = F.rlike(F.trim(body), F.lit(r"\S[,\s]+\S")) & ~F.rlike(head, F.lit(r"[\r\n]"))
            return F.when((F.length(digits) <= 10) & F.rlike(state, F.lit(r"^[A-Za-z][A-Za-z]$")) & parted, whole)

        return let(trimmed(F.substr(street, F.lit(1), F.length(street) - F.length(code))), of_rest)

    return F.when(F.rlike(street, F.lit(r"[,\s]\d{4,}(?:[-\s]\d+)?$")), let(F.regexp_extract(street, r"\d{4,}(?:[-\s]\d+)?$", 0), of_code))


def normalize_address(a: Column) -> Column:
    """Address struct with city, state and code cut off the street's end where they are missing, and codes for names."""
    get = lambda f: clean(a[f])
    open_ = (get("city") == "") | (get("state") == "") | (get("postal_code") == "")

    def of_tail(tail: Column) -> Column:
        fill = lambda f: F.when(get(f) != "", get(f)).otherwise(F.coalesce(tail[f], F.lit("")))
        return F.struct(
            get("po_box").alias("po_box"), get("extended").alias("extended"), F.coalesce(tail["street"], get("street")).alias("street"),
            fill("city").alias("city"), state_code(fill("state")).alias("state"), fill("postal_code").alias("postal_code"),
            country_code(a["country"]).alias("country"), label(a["label"]).alias("label"),
        )

    return let(F.when(open_, split_tail(get("street"))), of_tail)


def normalize_addresses(items: Column) -> Column:
    key = lambda a: F.concat_ws("\u001f", *[a[f] for f in FIELDS[:-1]])
    build = lambda a, b: F.struct(*[a[f].alias(f) for f in FIELDS[:-1]], b.alias("label"))
    return dedupe(F.transform(items, normalize_address), key, build)


def present(a: Column) -> Column:
    return F.concat_ws("", *[a[f] for f in ("street", "city", "state", "postal_code", "country", "po_box")]) != ""


def match_keys(items: Column) -> Column:
    """Distinct city, state and code triples with at least two of them filled."""
    triples = F.transform(items, lambda a: F.array(F.lower(a["city"]), F.upper(a["state"]), a["postal_code"]))
    return F.array_distinct(F.transform(F.filter(triples, lambda t: F.size(F.filter(t, lambda x: x != "")) >= 2), lambda t: F.array_join(t, "|")))


def display(a: Column) -> Column:
    return F.array_join(F.filter(F.array(*[a[f] for f in ("street", "city", "state", "postal_code", "country")]), lambda x: x != ""), ", ")
