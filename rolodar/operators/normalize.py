"""Normalisation of contact records: names, mailboxes, numbers, addresses. One projection, two Arrow UDFs, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolodar.config import Normalization
from rolodar.functions import address, channels, names
from rolodar.schema import as_contacts


def normalize(df: DataFrame, settings: Normalization = Normalization()) -> DataFrame:
    """Contact records in one spelling, with ``raw_emails``/``raw_phones``/``raw_addresses``, ``invalid_emails`` and
    ``non_standard_phones``.

    Order: mailboxes typed into the name move to the mailboxes; the name is parsed, parsed parts win over given ones
    (for suffixes the given one wins); an unparsable name is guessed from the first mailbox; a lone family name gets its
    initial from the mailbox; the full name is put together anew."""
    rows = as_contacts(df)
    typed = F.when(F.col("full_name_raw") != "", F.col("full_name_raw")).otherwise(F.col("full_name"))
    captured = F.transform(channels.emails_in_text(typed), lambda e: F.struct(e.alias("value"), F.lit("").alias("label")))
    rows = rows.withColumn("emails", F.concat("emails", captured)).withColumn("__typed", channels.without_emails(typed))
    parse = names.name_parser(list(settings.keep_generational_suffixes), list(settings.professional_suffixes), list(settings.name_prefixes))
    rows = rows.withColumn("__n", parse(F.col("__typed")))
    local = channels.local_part(F.coalesce(F.get("emails", F.lit(0))["value"], F.lit("")))
    local_words = F.filter(F.split(local, "[._-]+"), lambda p: p != "")
    second = F.coalesce(F.get(local_words, F.lit(1)), F.lit(""))
    cap = lambda c: F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substr(c, F.lit(2))))
    nothing = (F.col("__n.first") == "") & (F.col("__n.last") == "")
    rows = rows.withColumn("__g1", F.when(nothing, channels.guess_first(local)).otherwise("")).withColumn("__g2", F.when(nothing, cap(second)).otherwise(""))
    pick = lambda *cs: F.coalesce(*[F.nullif(c, F.lit("")) for c in cs], F.lit(""))
    bare = lambda c: channels.without_emails(F.col(c))
    given_prof, found_prof = F.col("suffix_professional"), F.array_join("__n.professional", "|")
    rows = rows.select(
        *[c for c in rows.columns if c in ("rec_idx", "full_name_raw", "nickname", "company", "title", "department", "linkedin_url", "source",
                                            "source_row_id", "source_timestamp", "notes")],
        F.col("emails").alias("raw_emails"), F.col("phones").alias("raw_phones"), F.col("addresses").alias("raw_addresses"), "emails", "phones", "addresses",
        pick(F.col("prefix"), F.col("__n.prefix")).alias("prefix"),
        pick(F.col("__n.first"), F.col("__g1"), bare("first_name")).alias("first_name"),
        pick(F.col("__n.middle"), bare("middle_name")).alias("middle_name"),
        pick(F.col("__n.last"), F.col("__g2"), bare("last_name")).alias("last_name"),
        pick(F.col("__n.maiden"), F.col("maiden_name")).alias("maiden_name"),
        pick(F.col("suffix"), F.col("__n.suffix")).alias("suffix"),
        pick(given_prof, found_prof).alias("suffix_professional"),
    )
    lone = (F.col("first_name") == "") & (F.col("last_name") != "")
    rows = rows.withColumn("first_name", F.when(lone, channels.initial_from_local(local, F.col("last_name"))).otherwise(F.col("first_name")))
    rows = rows.withColumn(
        "full_name", F.array_join(F.filter(F.array("prefix", "first_name", "middle_name", "last_name", "suffix"), lambda x: x != ""), " ")
    )
    rows = rows.withColumns({
        "emails": channels.normalize_emails(F.col("emails"), settings.keep_local_case, settings.drop_invalid_emails),
        "phones": channels.normalize_phones(F.col("phones"), settings.drop_invalid_phones, settings.default_phone_country),
        "addresses": address.normalize_addresses(F.col("addresses")),
    })
    bad = lambda c: F.filter(F.col(c), lambda x: x["label"] == "invalid")
    return rows.withColumns({
        "invalid_emails": F.transform(bad("emails"), lambda x: x["value"]),
        "non_standard_phones": F.transform(bad("phones"), lambda x: channels.with_extension(x["value"], x["extension"])),
    })
