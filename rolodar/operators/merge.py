"""Merging clusters: survivorship, label folds, deterministic ids, lineage, flattened view."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rolodar.functions import address, channels
from rolodar.functions.text import clean, source_priority, uuid5
from rolodar.operators import instants
from rolodar.runtime import cut

SURVIVING = [
    "prefix", "middle_name", "last_name", "maiden_name", "suffix", "suffix_professional", "nickname", "company", "title", "department", "linkedin_url",
]


def rank(df: DataFrame) -> DataFrame:
    """Adds ``rank``: instant (none is lowest), source priority, earlier record."""
    timed = instants.parse_instants(df, "source_timestamp", None, out="ts_us")
    return timed.withColumn("rank", F.struct("ts_us", source_priority(F.col("source")).alias("prio"), (-F.col("rec_idx")).alias("ord")))


def survivor(column: str) -> Column:
    """The non-empty value of the best-ranked record; '' if there is none."""
    return F.coalesce(F.max_by(F.col(column), F.when(F.col(column) != "", F.col("rank"))), F.lit(""))


def label_fold(items: DataFrame, by: list[str]) -> DataFrame:
    """One label per group of ``by``, folded in record order. A later label replaces the kept one together with its
    rank if its record ranks better, if it fills an empty label of equal priority, or if it is specific where the kept
    one is ``other`` and not ranked better."""
    step = F.struct(F.col("rec_idx"), F.col("pos"), F.col("label"), F.coalesce(F.col("ts_us"), F.lit(-(2**62))).alias("ts"), F.col("rank.prio").alias("prio"))
    listed = items.groupBy(*by).agg(F.array_sort(F.collect_list(step)).alias("steps"), F.min(F.struct("rec_idx", "pos")).alias("first"))

    def fold(kept: Column, new: Column) -> Column:
        better = lambda x, y: (x["ts"] > y["ts"]) | ((x["ts"] == y["ts"]) & (x["prio"] > y["prio"]))
        fills = (new["prio"] == kept["prio"]) & (kept["label"] == "") & (new["label"] != "")
        specific = (kept["label"] == "other") & ~new["label"].isin("", "other") & ~better(kept, new)
        return F.when(better(new, kept) | fills | specific, new).otherwise(kept)

    folded = F.aggregate(F.slice("steps", 2, 1_000_000_000), F.get("steps", F.lit(0)), fold)
    return listed.select(*by, "first", folded["label"].alias("label"))


@F.pandas_udf(T.StringType())
def _best_first(votes: pd.Series) -> pd.Series:
    """Winner of the weighted vote for a first name; spellings at least 0.9 alike vote together."""

    def winner(rows) -> str:
        keys = [(r["key"], r["weight"], r["explicit"], r["casing"]) for r in rows]
        groups: list[list] = []
        for k, w, e, c in keys:
            for g in groups:
                if SequenceMatcher(None, g[0], k).ratio() >= 0.9:
                    g[1] += w
                    g[2] |= e
                    break
            else:
                groups.append([k, w, e, c])
        pool = [g for g in groups if g[2]] or groups
        return max(pool, key=lambda g: g[1])[3] if pool else ""

    return votes.map(winner)


def first_name_votes(members: DataFrame) -> DataFrame:
    """cluster_id, best_first: first names vote 2 (network export) or 1, mailbox names 1.5 each."""
    weight = F.when(F.lower("source") == "linkedin", 2.0).otherwise(1.0)
    own = members.where("first_name <> ''").select("cluster_id", F.col("first_name").alias("casing"), weight.alias("w"), F.lit(True).alias("e"), F.struct("rec_idx", F.lit(-1).alias("pos")).alias("o"))
    boxes = members.select("cluster_id", "rec_idx", F.posexplode("emails").alias("pos", "m"))
    guess = channels.guess_first(channels.local_part(F.col("m.value")))
    boxes = boxes.select("cluster_id", guess.alias("casing"), F.lit(1.5).alias("w"), F.lit(False).alias("e"), F.struct("rec_idx", "pos").alias("o")).where("casing <> ''")
    votes = own.unionByName(boxes).groupBy("cluster_id", F.lower("casing").alias("key")).agg(
        F.sum("w").alias("weight"), F.max("e").alias("explicit"), F.min_by("casing", "o").alias("casing"), F.min("o").alias("o")
    )
    listed = votes.groupBy("cluster_id").agg(F.array_sort(F.collect_list(F.struct("o", "key", "weight", "explicit", "casing"))).alias("votes"))
    return listed.select("cluster_id", _best_first("votes").alias("best_first"))


def merge(normalized: DataFrame, clusters: DataFrame) -> DataFrame:
    """One contact per cluster, with id, channels, counts and the list of source keys."""
    # Used four times: the instants are parsed once.
    columns = ["rec_idx", "cluster_id", "source", "source_row_id", "first_name", "emails", "phones", "addresses", "invalid_emails", "non_standard_phones", *SURVIVING]
    members = cut(rank(normalized.join(clusters, "rec_idx")).select(*columns, "ts_us", "rank"))
    values = members.groupBy("cluster_id").agg(
        *[survivor(c).alias(c) for c in SURVIVING],
        F.count("*").cast("int").alias("source_row_count"),
        F.count_distinct(F.nullif(F.col("source"), F.lit(""))).cast("int").alias("sources"),
        F.sort_array(F.collect_list(F.concat_ws(":", "source", "source_row_id"))).alias("lineage_keys"),
        F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("rec_idx", "addresses"))), lambda x: x["addresses"]))).alias("addresses"),
        F.array_distinct(F.flatten(F.collect_list("invalid_emails"))).alias("invalid_emails"),
        F.array_distinct(F.flatten(F.collect_list("non_standard_phones"))).alias("non_standard_phones"),
    )
    mails = members.select("cluster_id", "rec_idx", "ts_us", "rank", F.posexplode("emails").alias("pos", "m")).select("*", "m.value", "m.label")
    mails = label_fold(mails, ["cluster_id", "value"]).groupBy("cluster_id").agg(F.sort_array(F.collect_list(F.struct("value", "label"))).alias("emails"))
    numbers = members.select("cluster_id", "rec_idx", "ts_us", "rank", F.posexplode("phones").alias("pos", "p")).select("*", "p.value", "p.label", "p.extension")
    numbers = label_fold(numbers, ["cluster_id", "value", "extension"])
    numbers = numbers.groupBy("cluster_id").agg(F.sort_array(F.collect_list(F.struct("value", "extension", "label"))).alias("phones"))
    out = values.join(mails, "cluster_id", "left").join(numbers, "cluster_id", "left").join(first_name_votes(members), "cluster_id", "left")
    named = lambda x: F.struct(x["value"].alias("value"), F.when(x["label"] == "", "other").otherwise(x["label"]).alias("label"))
    dialled = lambda x: F.struct(x["value"].alias("value"), F.when(x["label"] == "", "other").otherwise(x["label"]).alias("label"), x["extension"].alias("extension"))
    out = out.withColumns({
        "first_name": F.coalesce("best_first", F.lit("")),
        "emails": F.coalesce(F.transform("emails", named), F.array().cast("array<struct<value:string,label:string>>")),
        "phones": F.coalesce(F.transform("phones", dialled), F.array().cast("array<struct<value:string,label:string,extension:string>>")),
        "source_count": F.when(F.col("sources") > 0, F.col("sources")).otherwise(F.col("source_row_count")),
    })
    out = out.withColumn("full_name", F.array_join(F.filter(F.array("prefix", "first_name", "middle_name", "last_name", "suffix"), lambda x: x != ""), " "))
    phones = F.transform("phones", lambda p: channels.with_extension(p["value"], p["extension"]))
    identity = F.concat_ws(
        "::", "full_name", "company", "title", F.array_join(F.transform("emails", lambda e: e["value"]), ";"), F.array_join(phones, ";"), F.array_join("lineage_keys", "|")
    )
    return out.withColumn("contact_id", uuid5(F.trim(identity))).drop("sources", "best_first")


def render_pairs(items: Column) -> Column:
    """value::label texts joined by bars."""
    return F.array_join(F.transform(items, lambda x: F.concat(x["value"], F.lit("::"), x["label"])), "|")


def render_phones(items: Column) -> Column:
    return F.array_join(F.transform(items, lambda x: F.concat(channels.with_extension(x["value"], x["extension"]), F.lit("::"), x["label"])), "|")


CONTACT_COLUMNS = [
    "contact_id", "full_name", "prefix", "first_name", "middle_name", "last_name", "maiden_name", "suffix", "suffix_professional", "nickname",
    "company", "title", "department", "linkedin_url", "emails", "phones", "addresses_json", "source_count", "source_row_count",
]


def contact_table(merged: DataFrame) -> DataFrame:
    """The 19-column table of contacts as texts and counts."""
    out = merged.withColumn("addresses_json", F.to_json("addresses")).withColumn("emails", render_pairs(F.col("emails"))).withColumn("phones", render_phones(F.col("phones")))
    return out.select(*CONTACT_COLUMNS)


def lineage_table(normalized: DataFrame, clusters: DataFrame, merged: DataFrame) -> DataFrame:
    """One row per contact and source record, with its normalised and raw channels."""
    ids = merged.select("cluster_id", "contact_id")
    rows = normalized.join(clusters, "rec_idx").join(ids, "cluster_id")
    raw = lambda c: F.array_join(F.transform(c, lambda x: x["value"]), "|")
    return rows.select(
        "contact_id", "source", "source_row_id", F.col("full_name").alias("source_full_name"), F.col("company").alias("source_company"),
        F.col("title").alias("source_title"), render_pairs(F.col("emails")).alias("source_emails"), render_phones(F.col("phones")).alias("source_phones"),
        F.to_json("addresses").alias("source_addresses_json"), raw("raw_emails").alias("source_emails_raw"), raw("raw_phones").alias("source_phones_raw"),
        F.to_json("raw_addresses").alias("source_addresses_raw_json"),
    )


def flatten(merged: DataFrame) -> DataFrame:
    """First valid mailbox, number and address labelled home, work and other, as nine columns."""
    out = [F.col(c) for c in ("contact_id", "full_name", "company", "department", "title", "linkedin_url")]
    first = lambda arr, name: F.get(F.filter(arr, lambda x: x["label"] == name), F.lit(0))
    for name in ("home", "work", "other"):
        phone = first("phones", name)
        out += [
            clean(first("emails", name)["value"]).alias(f"{name}_email"),
            F.coalesce(channels.with_extension(phone["value"], phone["extension"]), F.lit("")).alias(f"{name}_phone"),
            F.coalesce(address.display(first("addresses", name)), F.lit("")).alias(f"{name}_address"),
        ]
    return merged.select(*out)


def duplicate_ids(contacts: DataFrame) -> DataFrame:
    """contact_id, n of ids that occur more than once (empty if all is well)."""
    return contacts.groupBy("contact_id").agg(F.count("*").alias("n")).where("n > 1")


def assert_unique_ids(contacts: DataFrame) -> None:
    bad = duplicate_ids(contacts).orderBy("contact_id").limit(5).collect()
    if bad:
        raise ValueError("repeated contact ids: " + ", ".join(r["contact_id"] for r in bad))


def apply_deliverability(merged: DataFrame, domains: DataFrame) -> DataFrame:
    """Relabels mailboxes of undeliverable domains (domain, deliverable) as invalid; of addresses that differ in case
    only, a valid one stays. Runs after ids are given."""
    rows = merged.select("contact_id", F.posexplode("emails").alias("pos", "e"))
    rows = rows.withColumn("domain", channels.email_domain(F.col("e.value"))).join(domains, "domain", "left")
    dead = ~F.coalesce("deliverable", F.lit(True))
    rows = rows.withColumn("label", F.when(dead, "invalid").otherwise(F.col("e.label")))
    best = rows.groupBy("contact_id", F.lower("e.value").alias("k")).agg(
        F.min_by(F.struct("e.value", "label"), F.struct((F.col("label") == "invalid").cast("int"), "pos")).alias("e"), F.min("pos").alias("pos")
    )
    emails = best.groupBy("contact_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "e"))), lambda x: x["e"]).alias("checked"))
    out = merged.join(emails, "contact_id", "left")
    return out.withColumn("emails", F.coalesce("checked", "emails")).drop("checked")
