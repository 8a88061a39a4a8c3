"""Schema of contact records; empty text, never null, is a missing value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EMAILS = "array<struct<value:string,label:string>>"
PHONES = "array<struct<value:string,label:string,extension:string>>"
ADDRESSES = (
    "array<struct<po_box:string,extended:string,street:string,city:string,state:string,postal_code:string,country:string,label:string>>"
)
TEXTS = [
    "full_name_raw", "full_name", "prefix", "first_name", "middle_name", "last_name", "maiden_name", "suffix", "suffix_professional",
    "nickname", "company", "title", "department", "linkedin_url", "source", "source_row_id", "source_timestamp", "notes",
]
CONTACT = ", ".join([*(f"{t} string" for t in TEXTS), f"emails {EMAILS}", f"phones {PHONES}", f"addresses {ADDRESSES}"])


def empty(kind: str) -> Column:
    return F.array().cast(kind)


def _trimmed(items: Column, kind: str) -> Column:
    """The children with every text trimmed and nulls empty."""
    fields = [f.split(":")[0] for f in kind[len("array<struct<") : -2].split(",")]
    return F.transform(items, lambda x: F.struct(*[F.coalesce(F.trim(x[f]), F.lit("")).alias(f) for f in fields]))


def to_json(df: DataFrame) -> DataFrame:
    """One JSON text per record, nulls kept out."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("record"))


def from_json(df: DataFrame, column: str = "record") -> DataFrame:
    """Contact records of JSON texts; malformed texts are empty records."""
    return as_contacts(df.select(F.from_json(column, "rec_idx long, " + CONTACT).alias("r")).select("r.*"))


def as_contacts(df: DataFrame) -> DataFrame:
    """All contact columns in order: missing ones are added, nulls become empty; other columns are left out."""
    texts = [F.coalesce(F.trim(F.col(t).cast("string")), F.lit("")).alias(t) if t in df.columns else F.lit("").alias(t) for t in TEXTS]
    arrays = [
        F.coalesce(_trimmed(F.col(c).cast(k), k), empty(k)).alias(c) if c in df.columns else empty(k).alias(c)
        for c, k in (("emails", EMAILS), ("phones", PHONES), ("addresses", ADDRESSES))
    ]
    extra = [F.col("rec_idx").cast("long").alias("rec_idx")] if "rec_idx" in df.columns else []
    return df.select(*extra, *texts, *arrays)
