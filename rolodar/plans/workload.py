"""A deterministic contact workload over the star-schema tables, written once in SQL that both engines read.

customer -> network export, supplier -> card file, users of events -> webmail export. The same person stands in
several sources under variants of the given name."""

from __future__ import annotations

from difflib import SequenceMatcher
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolodar.functions import fixed
from rolodar.runtime import table

_GROUPS = [[root, *variants] for root, variants in fixed.NICKNAMES.items()]
# Roots whose variants lead back to them alone, and whose spellings vote apart.
_apart = lambda g: all(SequenceMatcher(None, a, b).ratio() < 0.9 for a, b in combinations(g[:3], 2))
_GROUPS = [g for g in _GROUPS if all(fixed.NICKNAME_ROOT[n] == g[0] for n in g[:3]) and len(g) >= 2 and _apart(g)]
N = len(_GROUPS)


def _pick(index: str, values: list[str]) -> str:
    return "CASE " + index + " " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " ELSE '' END"


def _first(variant: int) -> str:
    return _pick(f"person % {N}", [g[min(variant, len(g) - 1)].capitalize() for g in _GROUPS])


ROOT = _pick(f"person % {N}", [g[0] for g in _GROUPS])


def projection(customer: str, supplier: str, events: str) -> str:
    """SQL of the contact rows."""
    return f"""
SELECT *, concat('family', CAST(person % 1201 AS VARCHAR(9))) AS last_name,
       CASE WHEN k % 7 = 0 THEN '' WHEN k % 11 = 0 THEN concat('bad', CAST(person AS VARCHAR(9)))
            ELSE concat({ROOT}, '.', CAST(person AS VARCHAR(9)), '@Mail', CAST(person % 50 AS VARCHAR(9)), '.example') END AS email,
       CASE WHEN k % 5 = 0 THEN '' WHEN k % 13 = 0 THEN CAST(person AS VARCHAR(9))
            ELSE concat('(', CAST(200 + person % 700 AS VARCHAR(9)), ') 555-', CAST(1000 + person % 9000 AS VARCHAR(9))) END AS phone,
       concat(CAST(100 + person AS VARCHAR(9)), ' Main St') AS street, concat('City', CAST(person % 40 AS VARCHAR(9))) AS city,
       CASE WHEN person % 3 = 0 THEN 'ma' WHEN person % 3 = 1 THEN 'New York' ELSE '' END AS state,
       CASE WHEN k % 4 = 0 THEN '' ELSE CAST(10000 + person AS VARCHAR(9)) END AS postal_code,
       CASE WHEN k % 6 = 0 THEN '' ELSE concat('Company ', CAST(k % 60 AS VARCHAR(9))) END AS company,
       CASE WHEN k % 3 = 0 THEN 'Buyer' WHEN k % 3 = 1 THEN '' ELSE 'Ballet teacher' END AS title,
       CASE WHEN source = 'linkedin' AND k % 3 = 0 THEN concat('https://www.linkedin.com/in/p', CAST(person AS VARCHAR(9))) ELSE '' END AS linkedin_url,
       CASE WHEN person % 97 = 0 THEN 'teaches tai chi' ELSE '' END AS note
FROM (
  SELECT 'linkedin' AS source, c_custkey AS k, c_custkey AS rec_idx, c_custkey % 5003 AS person, {_first(0).replace("person", "(c_custkey % 5003)")} AS first_name,
         concat('20', CAST(10 + c_custkey % 15 AS VARCHAR(9)), '-0', CAST(1 + c_custkey % 9 AS VARCHAR(9)), '-15T00:00:00') AS source_timestamp FROM {customer}
  UNION ALL
  SELECT 'mac_vcf', s_suppkey, 1000000000 + s_suppkey, s_suppkey % 5003, {_first(1).replace("person", "(s_suppkey % 5003)")}, '' FROM {supplier}
  UNION ALL
  SELECT 'gmail', user_id, 2000000000 + user_id, user_id % 5003, {_first(2).replace("person", "(user_id % 5003)")}, '' FROM (SELECT DISTINCT user_id FROM {events}) AS u
) AS base"""


SQL = projection("customer", "supplier", "events")


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The projected rows."""
    frames = {t: table(spark, sf_dir, t) for t in ("customer", "supplier", "events")}
    return spark.sql(projection("{customer}", "{supplier}", "{events}"), **frames)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as contact records."""
    r = rows(spark, sf_dir)
    one = lambda cond, s: F.when(cond, F.array(s)).otherwise(F.array())
    place = F.struct(
        F.lit("").alias("po_box"), F.lit("").alias("extended"), F.col("street"), F.col("city"), F.col("state"), F.col("postal_code"), F.lit("us").alias("country"),
        F.lit("home").alias("label"),
    )
    return r.select(
        "rec_idx", "source", F.col("k").cast("string").alias("source_row_id"), F.concat_ws(" ", "first_name", "last_name").alias("full_name_raw"), "first_name",
        "last_name", "company", "title", "linkedin_url", "source_timestamp", F.col("note").alias("notes"),
        one(F.col("email") != "", F.struct(F.col("email").alias("value"), F.lit("work").alias("label"))).alias("emails"),
        one(F.col("phone") != "", F.struct(F.col("phone").alias("value"), F.lit("home").alias("label"), F.lit("").alias("extension"))).alias("phones"),
        F.array(place).alias("addresses"),
    )
