"""Queries and SQL of the training-data problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolodar.llm import abuse, addresses, crossmatch, leaks, people, personal, survivors, tokens
from rolodar.operators import instants, packed
from rolodar.runtime import table


def _timed_records(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    rows = table(spark, sf_dir, "contact_records").select("rec_id", "contact_id", "source", "source_timestamp", "export_tz", *columns)
    rows = rows.where(F.trim("contact_id") != "")
    return instants.parse_instants(rows, "source_timestamp", "export_tz", unknown_zone="UTC")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _timed_records(spark, sf_dir, "emails", "phones", "company", "title")
    bundles = [
        survivors.Bundle("emails", ("emails",), packed.filled(F.col("emails"))),
        survivors.Bundle("phones", ("phones",), packed.filled(F.col("phones"))),
        survivors.Bundle("company", ("company",), F.trim("company") != ""),
        survivors.Bundle("title", ("title",), F.trim("title") != ""),
    ]
    # Every field is a bundle of its own, and none depends on another.
    out = survivors.choose_bundles(rows, "contact_id", "rec_id", "source", "utc_us", bundles, [])
    return out.select("contact_id", F.col("bundle").alias("field_name"), "rec_id")


def p3_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole bundles per contact: the profile link must belong to the chosen name, the job to the chosen mailboxes."""
    rows = _timed_records(
        spark, sf_dir, "emails", "phones", "company", "title", "department", "first_name", "middle_name", "last_name", "suffix", "linkedin_url"
    )
    bundles = [
        survivors.Bundle("name", ("first_name", "middle_name", "last_name", "suffix"), (F.trim("last_name") != "") & (F.trim("first_name") != "")),
        survivors.Bundle("job", ("company", "title", "department"), F.trim("company") != ""),
        survivors.Bundle("mailboxes", ("emails",), packed.filled(F.col("emails"))),
        survivors.Bundle("numbers", ("phones",), packed.filled(F.col("phones"))),
        survivors.Bundle("profile", ("linkedin_url",), F.trim("linkedin_url") != ""),
    ]
    return survivors.choose_bundles(
        rows, "contact_id", "rec_id", "source", "utc_us", bundles, [("profile", "name"), ("mailboxes", "job")]
    )


def p4_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every address with its location."""
    return addresses.locate(table(spark, sf_dir, "contact_addresses"), "address_id")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return addresses.pairs(p4_places(spark, sf_dir), "address_id", "location")


def p5_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries that name the same person as another one of their book."""
    return people.people(table(spark, sf_dir, "book_entries"), "entry_id", "book_id", "full_name_raw", "first_name", "nickname")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return addresses.pairs(p5_people(spark, sf_dir), "entry_id", "person")


def p6_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matching rows with score, mutual-nearest test and confidence."""
    return crossmatch.match(table(spark, sf_dir, "network_contacts"), table(spark, sf_dir, "card_contacts"), "net_id", "card_id")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p6_matches(spark, sf_dir).select("net_id", "card_id")


def _personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = table(spark, sf_dir, "contact_records")
    return personal.extract(records, "rec_id", "notes", records, ["first_name", "nickname"], "last_name")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _personal(spark, sf_dir).select("rec_id", "kind", "start_at").distinct()


def p7_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The notes with typed placeholders."""
    return personal.redact(table(spark, sf_dir, "contact_records"), "rec_id", "notes", _personal(spark, sf_dir))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode(table(spark, sf_dir, "documents"), "doc_id", "text")


def _leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.leaks(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "eval_items"), "item_id", "text")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leaks(spark, sf_dir).select("doc_id", "item_id").distinct()


def p9_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the repeated words, the longest verbatim match and its place."""
    return _leaks(spark, sf_dir)


def p9_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that stay."""
    return leaks.without_leaks(table(spark, sf_dir, "documents"), "doc_id", _leaks(spark, sf_dir)).select("doc_id", "source")


def _abuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = table(spark, sf_dir, "documents")
    model = abuse.fit_labels(corpus, "doc_id", "text", table(spark, sf_dir, "review_labels"), "doc_id", "abusive")
    return abuse.score(corpus, "doc_id", "text", model)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _abuse(spark, sf_dir).where("abuse >= 0.5").select("doc_id").distinct()


def p10_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate of abusive documents per feed."""
    scored = table(spark, sf_dir, "documents").select("doc_id", "source").join(_abuse(spark, sf_dir), "doc_id")
    return abuse.rates(scored, "source")


QUERIES = {
    "p3_found": p3_found,
    "p3_bundles": p3_bundles,
    "p4_found": p4_found,
    "p4_places": p4_places,
    "p5_found": p5_found,
    "p5_people": p5_people,
    "p6_found": p6_found,
    "p6_matches": p6_matches,
    "p7_found": p7_found,
    "p7_redacted": p7_redacted,
    "p8_ids": p8_ids,
    "p9_found": p9_found,
    "p9_matches": p9_matches,
    "p9_clean": p9_clean,
    "p10_found": p10_found,
    "p10_rates": p10_rates,
}
SQL: dict[str, str] = {}
