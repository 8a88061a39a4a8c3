"""The whole pipeline: sources, resolution, merge, reports; and its command line."""

from __future__ import annotations

import argparse
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolodar import config as cfg
from rolodar.operators import merge, reports, resolve
from rolodar.operators.normalize import normalize
from rolodar.runtime import cut, session
from rolodar.sources import files


@dataclass
class Result:
    normalized: DataFrame
    clusters: DataFrame
    merged: DataFrame
    contacts: DataFrame
    lineage: DataFrame
    flattened: DataFrame


def unify(records: DataFrame, config: cfg.Config = cfg.Config(), deliverability: DataFrame | None = None) -> Result:
    """Contacts, lineage and views of contact records (any frame with the contact columns and ``rec_idx``)."""
    plain = normalize(records, config.normalization)
    keyed = cut(resolve.with_keys(plain))
    normalized = keyed.select(*plain.columns)
    clusters = cut(resolve.clusters(keyed, config.dedupe))
    merged = cut(merge.merge(normalized, clusters))
    if deliverability is not None and config.normalization.email_dns_mx_check:
        merged = merge.apply_deliverability(merged, deliverability)
    return Result(normalized, clusters, merged, merge.contact_table(merged), merge.lineage_table(normalized, clusters, merged), merge.flatten(merged))


def notes_of(records: DataFrame) -> DataFrame:
    return records.select("source", "source_row_id", F.col("notes").alias("note")).where("trim(note) <> ''")


def load(spark: SparkSession, config: cfg.Config) -> DataFrame:
    i = config.inputs
    return files.union_sources(files.read_linkedin(spark, i.linkedin_csv), files.read_gmail(spark, i.gmail_csv), files.read_vcards(spark, i.mac_vcf))


def deliverable_domains(spark: SparkSession, config: cfg.Config) -> DataFrame | None:
    """domain, deliverable of the table that ``inputs.deliverability_csv`` names, if the check is switched on. Executors
    look nothing up; the table is made beforehand."""
    path = config.inputs.deliverability_csv
    if not config.normalization.email_dns_mx_check or not files.exists(path, "deliverability table"):
        return None
    rows = files.read_stage_csv(spark, path, ["domain", "deliverable"])
    return rows.select(F.lower(F.trim("domain")).alias("domain"), F.lower(F.trim("deliverable")).isin("true", "1", "yes").alias("deliverable")).dropDuplicates(["domain"])


def stage_validate(contacts: DataFrame, flattened: DataFrame | None, config: cfg.Config) -> dict[str, DataFrame]:
    validation = reports.validate(contacts, flattened, config.quality)
    return {"validation_report": validation, "contact_quality_scored": reports.quality_scored(contacts, validation), "coverage_metrics": reports.coverage(validation)}


def stage_confidence(contacts: DataFrame, validation: DataFrame, flattened: DataFrame | None) -> dict[str, DataFrame]:
    report = reports.confidence(contacts, validation, flattened)
    return {"confidence_report": report, "confidence_summary": reports.confidence_summary(report), "confidence_metrics": reports.confidence_metrics(report)}


def stage_tag(report: DataFrame, notes: DataFrame | None, config: cfg.Config) -> dict[str, DataFrame]:
    tagged = reports.tag(report, notes, config.tagging)
    return {"tagged_contacts": tagged, "referral_targets": reports.rank_referrals(tagged)}


def stored(spark: SparkSession, config: cfg.Config, *names: str) -> DataFrame | None:
    """The first of the named tables that a former stage has written."""
    for name in names:
        path = os.path.join(config.output_dir, name)
        if files.exists(path, name):
            return files.read_stage_csv(spark, path)
    return None


def resume(spark: SparkSession, config: cfg.Config, stage: str) -> dict[str, str]:
    """One stage over the tables that former stages have written."""
    contacts, flattened = stored(spark, config, "consolidated_contacts"), stored(spark, config, "flattened_contacts")
    if stage == "validate":
        tables = stage_validate(contacts, flattened, config)
    elif stage == "confidence":
        tables = stage_confidence(contacts, stored(spark, config, "validation_report"), flattened)
    elif stage == "tag":
        tables = stage_tag(stored(spark, config, "confidence_report", "consolidated_contacts"), stored(spark, config, "contact_notes"), config)
    else:
        # Ranked targets, or the tagged contacts where none are stored.
        targets = stored(spark, config, "referral_targets", "tagged_contacts")
        tables = {"top_referrals": reports.top_referrals(targets), "top_confidence": reports.top_confidence(stored(spark, config, "confidence_report"), contacts)}
    return write(tables, config)


def write(tables: dict[str, DataFrame], config: cfg.Config) -> dict[str, str]:
    out = {}
    for name, df in tables.items():
        out[name] = os.path.join(config.output_dir, name)
        files.write_stage_csv(df, out[name], config.single_files)
    return out


def run(spark: SparkSession, config: cfg.Config) -> dict[str, str]:
    """All stages; returns the folder of every table written."""
    records = cut(load(spark, config))
    r = unify(records, config, deliverable_domains(spark, config))
    merge.assert_unique_ids(r.contacts)
    notes = cut(reports.notes_blob(r.lineage, notes_of(records)))
    checked = stage_validate(r.contacts, r.flattened, config)
    judged = stage_confidence(r.contacts, checked["validation_report"], r.flattened)
    tables = {"consolidated_contacts": r.contacts, "consolidated_lineage": r.lineage, "flattened_contacts": r.flattened, "contact_notes": notes}
    return write(tables | checked | judged | stage_tag(judged["confidence_report"], notes, config), config)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="Unify contact exports.")
    p.add_argument("stage", nargs="?", default="all", choices=["all", "validate", "confidence", "tag", "insights"])
    p.add_argument("--config")
    p.add_argument("--single-files", action="store_true", default=None, dest="outputs__single_files")
    for name in ("linkedin-csv", "gmail-csv", "mac-vcf", "deliverability-csv"):
        p.add_argument(f"--{name}", dest=f"inputs__{name.replace('-', '_')}")
    p.add_argument("--out-dir", dest="outputs__dir")
    p.add_argument("--default-phone-country", dest="normalization__default_phone_country")
    for name in ("keep-generational-suffixes", "professional-suffixes", "name-prefixes"):
        p.add_argument(f"--{name}", nargs="*", dest=f"normalization__{name.replace('-', '_')}")
    for name in ("first-name-similarity-threshold", "merge-score-threshold", "relaxed-merge-threshold"):
        p.add_argument(f"--{name}", type=float, dest=f"dedupe__{name.replace('-', '_')}")
    p.add_argument("--require-corroborator", action="store_true", default=None, dest="dedupe__require_corroborator")
    p.add_argument("--nickname-equivalence", action=argparse.BooleanOptionalAction, default=None, dest="dedupe__enable_nickname_equivalence")
    p.add_argument("--log-level")
    p.add_argument("--email-dns-mx-check", action="store_true", default=None, dest="normalization__email_dns_mx_check")
    args = vars(p.parse_args(argv))
    stage = args.pop("stage")
    config = cfg.load(args.pop("config"), **{k: v for k, v in args.items() if k != "log_level"})
    cfg.configure_logging(config, args["log_level"])
    spark = session()
    for name, path in (run(spark, config) if stage == "all" else resume(spark, config, stage)).items():
        print(name, path)


if __name__ == "__main__":
    main()
