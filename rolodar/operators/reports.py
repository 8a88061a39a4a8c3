"""Quality, confidence, tags, ranking and insight views over merged contacts - expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolodar.config import Quality, Tagging
from rolodar.functions import fixed
from rolodar.functions.channels import email_domain
from rolodar.functions.text import clean

VALIDATION = [
    "email_valid_count", "email_total", "phone_valid_count", "phone_total", "addr_valid_count", "addr_total", "emails_detail", "phones_detail",
    "addresses_detail", "department_missing", "home_email_present", "work_email_present", "home_phone_present", "work_phone_present",
    "home_address_present", "work_address_present", "quality_score",
]
_ADDRESS_JSON = "array<struct<po_box:string,extended:string,street:string,city:string,state:string,postal_code:string,country:string,label:string>>"


def entries(rendered: Column) -> Column:
    """array<struct(value, label)> of a bar-joined value::label text."""
    parts = F.filter(F.split(F.coalesce(rendered, F.lit("")), r"\|"), lambda p: F.trim(p) != "")
    return F.transform(
        parts, lambda p: F.struct(F.trim(F.substring_index(p, "::", 1)).alias("value"), F.when(F.contains(p, F.lit("::")), F.lower(F.trim(F.substring_index(p, "::", -1)))).otherwise("").alias("label"))
    )


def valid_entry(x: Column) -> Column:
    return (x["value"] != "") & (x["label"] != "invalid")


def addresses_of(text: Column) -> Column:
    """Addresses of a JSON text; malformed text has none."""
    return F.coalesce(F.from_json(text, _ADDRESS_JSON), F.array().cast(_ADDRESS_JSON))


def valid_address(a: Column) -> Column:
    return (clean(a["street"]) != "") & ((clean(a["city"]) != "") | (clean(a["postal_code"]) != ""))


def view(flattened: DataFrame) -> DataFrame:
    """The flattened view as a map of ids: rows without an id are dropped, of a repeated id the last row counts."""
    others = [c for c in flattened.columns if c != "contact_id"]
    rows = flattened.where(F.trim("contact_id") != "").withColumn("__at", F.monotonically_increasing_id())
    last = rows.groupBy("contact_id").agg(F.max_by(F.struct(*others), "__at").alias("v"))
    return last.select("contact_id", "v.*")


def validate(contacts: DataFrame, flattened: DataFrame | None = None, weights: Quality = Quality()) -> DataFrame:
    """contact_id and names with counts, details, presence flags and the quality score."""
    rows = contacts.withColumns({"__e": entries(F.col("emails")), "__p": entries(F.col("phones")), "__a": addresses_of(F.col("addresses_json"))})
    count = lambda arr, ok: F.size(F.filter(arr, ok))
    rows = rows.withColumns({
        "email_valid_count": count("__e", valid_entry), "email_total": F.size("__e"),
        "phone_valid_count": count("__p", valid_entry), "phone_total": F.size("__p"),
        "addr_valid_count": count("__a", valid_address), "addr_total": F.size("__a"),
        "emails_detail": F.to_json(F.transform("__e", lambda x: F.struct(x["value"].alias("value"), x["label"].alias("label"), valid_entry(x).alias("valid")))),
        "phones_detail": F.to_json(F.transform("__p", lambda x: x["value"])),
        "addresses_detail": F.to_json(F.transform("__a", lambda a: F.struct(a["street"].alias("street"), a["city"].alias("city"), valid_address(a).alias("valid")))),
        "department_missing": (clean(F.col("department")) == "").cast("int"),
    })
    flags = [f"{w}_{c}" for c in ("email", "phone", "address") for w in ("home", "work")]
    if flattened is not None:
        rows = rows.join(view(flattened.select("contact_id", *flags)), "contact_id", "left")
        rows = rows.withColumns({f"{f}_present": (clean(F.col(f)) != "").cast("int") for f in flags})
    else:
        rows = rows.withColumns({f"{f}_present": F.lit(0) for f in flags})
    part = lambda n, t, full, some: F.when((F.col(t) > 0) & (F.col(n) == F.col(t)), full).when(F.col(n) > 0, some).otherwise(0)
    score = (
        part("email_valid_count", "email_total", weights.email_full, weights.email_partial)
        + part("phone_valid_count", "phone_total", weights.phone_full, weights.phone_partial)
        + F.when(F.col("addr_valid_count") > 0, weights.address_any).otherwise(0)
    )
    return rows.withColumn("quality_score", score).select("contact_id", "full_name", "company", "title", "department", "linkedin_url", *VALIDATION)


def quality_scored(contacts: DataFrame, validation: DataFrame) -> DataFrame:
    keep = [c for c in VALIDATION if not c.endswith("_detail")]
    return contacts.join(validation.select("contact_id", *keep), "contact_id", "left")


def coverage(validation: DataFrame) -> DataFrame:
    """One row: number of contacts, share of contacts with any mailbox, number, address."""
    share = lambda c: F.coalesce(F.round(100 * F.count_if(F.col(c) > 0) / F.count("*"), 2), F.lit(0.0))
    return validation.agg(
        F.count("*").alias("total_contacts"), share("email_total").alias("has_any_email_pct"), share("phone_total").alias("has_any_phone_pct"),
        share("addr_total").alias("has_any_address_pct"),
    )


def confidence(contacts: DataFrame, validation: DataFrame, flattened: DataFrame | None = None) -> DataFrame:
    """Contacts with confidence_score (0-100) and confidence_bucket."""
    v = validation.select("contact_id", "quality_score", "email_valid_count", "email_total", "phone_valid_count", "phone_total", "addr_valid_count")
    rows = contacts.join(v, "contact_id", "left")
    work = F.lit(0)
    if flattened is not None:
        rows = rows.join(view(flattened.select("contact_id", "work_email", "work_phone", "work_address")), "contact_id", "left")
        work = sum(((clean(F.col(c)) != "").cast("int") for c in ("work_email", "work_phone", "work_address")), F.lit(0))
    n = lambda c: F.coalesce(F.expr(f"try_cast({c} as int)"), F.lit(0))
    filled = lambda c: (clean(F.col(c)) != "").cast("int")
    backing = filled("emails") + filled("phones") + filled("linkedin_url") + (~clean(F.col("addresses_json")).isin("", "[]")).cast("int")
    rejected = lambda c: (F.size(entries(F.col(c))) > 0) & F.forall(entries(F.col(c)), lambda x: ~valid_entry(x))
    sources = F.coalesce(F.expr("try_cast(source_count as int)"), F.lit(1))
    yes = lambda cond, points: F.when(cond, points).otherwise(0)
    score = (
        F.round(F.greatest(F.lit(0), F.least(n("quality_score"), F.lit(100))) * 0.4).cast("int")
        + F.least(5 * backing, F.lit(20))
        + F.when(sources >= 3, 10).when(sources == 2, 6).otherwise(2)
        + 6 * filled("linkedin_url")
        + yes((filled("company") + filled("title")) > 0, 6)
        + 3 * filled("department")
        + F.least(2 * work, F.lit(6))
        + yes((n("email_total") > 0) & (n("email_valid_count") == n("email_total")), 5)
        + yes((n("phone_total") > 0) & (n("phone_valid_count") == n("phone_total")), 3)
        + yes(n("addr_valid_count") > 0, 2)
        + yes((filled("first_name") + filled("last_name")) == 2, 3)
        + 2 * filled("full_name")
        - yes(rejected("emails"), 5)
        - yes(rejected("phones"), 4)
    )
    score = F.greatest(F.lit(0), F.least(score, F.lit(100)))
    out = rows.select(*[F.col(c) for c in contacts.columns], score.alias("confidence_score"))
    s = F.col("confidence_score")
    return out.withColumn("confidence_bucket", F.when(s >= 80, "very_high").when(s >= 60, "high").when(s >= 40, "medium").otherwise("low"))


def confidence_summary(report: DataFrame) -> DataFrame:
    """bucket, count, pct - always the four buckets."""
    four = report.sparkSession.createDataFrame([(0, "very_high"), (1, "high"), (2, "medium"), (3, "low")], "ord int, bucket string")
    counts = report.groupBy(F.col("confidence_bucket").alias("bucket")).agg(F.count("*").alias("n"))
    total = report.agg(F.count("*").alias("total"))
    out = four.join(counts, "bucket", "left").crossJoin(F.broadcast(total))
    n = F.coalesce("n", F.lit(0))
    pct = F.when(F.col("total") > 0, F.round(100 * n / F.col("total"), 2)).otherwise(0.0)
    return out.orderBy("ord").select("bucket", n.alias("count"), pct.alias("pct"))


def confidence_metrics(report: DataFrame) -> DataFrame:
    """One row: number of contacts and their mean confidence."""
    mean = F.coalesce(F.round(F.avg("confidence_score"), 2), F.lit(0.0))
    return report.agg(F.count("*").alias("total_contacts"), mean.alias("mean_confidence"))


def notes_blob(lineage: DataFrame, notes: DataFrame) -> DataFrame:
    """contact_id, notes_blob: the notes (source, source_row_id, note) of a contact's records, in lineage order."""
    rows = lineage.select("contact_id", "source", "source_row_id").join(notes.where(F.trim("note") != ""), ["source", "source_row_id"])
    # Sources as they are loaded, then the places in their files as numbers.
    loaded = F.when(F.col("source") == "linkedin", 0).when(F.col("source") == "gmail", 1).when(F.col("source") == "mac_vcf", 2).otherwise(3)
    place = F.expr("try_cast(regexp_extract(source_row_id, '([0-9]+)$', 1) as bigint)")
    ordered = F.array_sort(F.collect_list(F.struct(loaded.alias("loaded"), "source", F.regexp_replace("source_row_id", r"[0-9]+$", "").alias("file"), place.alias("place"), "note")))
    return rows.groupBy("contact_id").agg(F.array_join(F.transform(ordered, lambda x: x["note"]), " | ").alias("notes_blob"))


def tag(contacts: DataFrame, notes: DataFrame | None = None, settings: Tagging = Tagging()) -> DataFrame:
    """Contacts with tags, relationship category, notes and referral priority."""
    rows = contacts
    if "confidence_score" not in rows.columns:
        rows = rows.withColumn("confidence_score", F.lit(0))
    rows = rows.join(notes, "contact_id", "left") if notes is not None else rows.withColumn("notes_blob", F.lit(""))
    rows = rows.withColumn("notes_blob", F.coalesce("notes_blob", F.lit("")))
    blob = F.lower(F.concat_ws(" ", *[clean(F.col(c)) for c in ("company", "title", "linkedin_url", "notes_blob")]))
    among = lambda words, hay: F.lit(False) if not words else F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(hay, w))
    domains = F.array_distinct(F.filter(F.transform(entries(F.col("emails")), lambda e: email_domain(e["value"])), lambda d: d.isNotNull()))
    colleague = among(settings.prior_companies, F.lower(clean(F.col("company")))) | F.exists(domains, lambda d: among(settings.prior_domains, d))
    local = F.exists(addresses_of(F.col("addresses_json")), lambda a: (F.lower(clean(a["state"])) == "ma") & among(settings.local_cities, F.lower(clean(a["city"]))))
    found = {
        "local_south_shore": local, "martial_arts": F.rlike(blob, F.lit(fixed.MARTIAL_ARTS)), "nutcracker_performance": F.rlike(blob, F.lit(fixed.NUTCRACKER)),
        "work_colleague": colleague,
    }
    rows = rows.withColumn("__tags", F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in sorted(found.items())])))
    has = lambda t: F.array_contains("__tags", t)
    category = (
        F.when(has("martial_arts") | has("nutcracker_performance"), "personal")
        .when(has("work_colleague") | (clean(F.col("linkedin_url")) != ""), "professional")
        .when(has("local_south_shore"), "local_referral")
        .otherwise("uncategorized")
    )
    weights = sum((F.when(has(name), w).otherwise(0) for name, w in settings.tag_weights), F.lit(0))
    score = F.coalesce(F.expr("try_cast(confidence_score as double)"), F.lit(0.0))
    priority = F.least(F.lit(100), F.bround(settings.confidence_weight * score + weights, 0)).cast("int")
    return rows.withColumn("tags", F.array_join("__tags", "|")).withColumn("relationship_category", category).withColumn("referral_priority_score", priority).drop("__tags")


def rank_referrals(tagged: DataFrame, text_order: bool = False) -> DataFrame:
    """Tagged contacts by priority and confidence (numbers; ``text_order`` compares the confidence as text)."""
    second = F.col("confidence_score").cast("string") if text_order else F.expr("try_cast(confidence_score as double)")
    return tagged.orderBy(F.desc("referral_priority_score"), second.desc_nulls_last(), "contact_id")


def top_confidence(report: DataFrame, contacts: DataFrame, n: int = 25) -> DataFrame:
    """The n best contacts of the two upper buckets, with the sources' count."""
    best = report.where(F.col("confidence_bucket").isin("very_high", "high")).select("contact_id", "confidence_score", "confidence_bucket")
    extra = contacts.select("contact_id", "full_name", F.expr("try_cast(source_count as int)").alias("source_count"))
    return best.join(extra, "contact_id", "left").orderBy(F.desc("confidence_score"), F.desc("source_count"), "contact_id").limit(n)


def top_referrals(tagged: DataFrame, n: int = 25) -> DataFrame:
    wanted = [c for c in ("contact_id", "full_name", "company", "tags", "relationship_category", "referral_priority_score", "confidence_score") if c in tagged.columns]
    return rank_referrals(tagged.select(*wanted)).limit(n)


def rejected_values(merged: DataFrame, column: str, head: int | None = None) -> DataFrame:
    """contact_id, value: one row per rejected mailbox or number, in order; the first ``head`` rows if that is given."""
    out = merged.select("contact_id", F.explode(column).alias("value"))
    out = out.withColumn("value", F.trim("value")).where("value <> ''").orderBy("contact_id", "value")
    return out if head is None else out.limit(head)


def display(df: DataFrame, n: int = 25) -> None:
    """The first rows on the standard output, as a notebook shows them."""
    df.show(n, truncate=False)
