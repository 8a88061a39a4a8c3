"""Entity resolution: lossless multi-key blocking, pair signals, match gate, clusters.

Records can only match inside a block (family name, else full name, first mailbox, first number). Inside it a pair can
only pass the gate if it shares a name, a nickname root, a mailbox or a profile - or, where a side has no name, any
corroborating value. These values are the join keys, so a frequent family name is never paired with itself in full.
``clusters`` folds records with equal evidence into their first one before pairing, so copies cost no pairs.

The similarity UDF only sees pairs whose outcome depends on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolodar.config import Dedupe
from rolodar.functions import address
from rolodar.functions.text import best_ratio, nickname_root, text_key
from rolodar.operators.graph import connected_components
from rolodar.runtime import cut


def with_keys(df: DataFrame) -> DataFrame:
    """Adds comparison forms, block key and evidence sets to normalised records (they need ``rec_idx``)."""
    rows = df.withColumns({"k_first": text_key("first_name"), "k_nick": text_key("nickname"), "k_last": text_key("last_name"), "k_full": text_key("full_name"), "k_suffix": text_key("suffix")})
    first_value = lambda c: F.coalesce(F.get(c, F.lit(0))["value"], F.lit(""))
    pick = lambda c: F.nullif(c, F.lit(""))
    block = F.coalesce(pick(F.col("k_last")), pick(F.col("k_full")), pick(first_value("emails")), pick(first_value("phones")), F.concat(F.lit("__blank_"), F.col("rec_idx").cast("string")))
    has = lambda raw, key: F.when(F.col(raw) != "", F.col(key))
    return rows.withColumns({
        "block_key": block,
        "candidates": F.array_distinct(F.array_compact(F.array(has("first_name", "k_first"), has("nickname", "k_nick")))),
        "roots": F.array_distinct(F.array_compact(F.array(nickname_root(has("first_name", "k_first")), nickname_root(has("nickname", "k_nick"))))),
        "s_email": F.array_distinct(F.transform("emails", lambda e: e["value"])),
        "s_phone": F.array_distinct(F.transform("phones", lambda p: p["value"])),
        "s_addr": address.match_keys(F.col("addresses")),
    })


EVIDENCE = [
    "rec_idx", "block_key", "source", "first_name", "candidates", "roots", "k_last", "suffix", "k_suffix", "linkedin_url", "s_email", "s_phone", "s_addr",
]


def candidate_pairs(keyed: DataFrame, dedupe: Dedupe = Dedupe()) -> DataFrame:
    """left, right (structs of evidence, left with the smaller index): every pair that may pass the gate, once."""
    tag = lambda t, arr: F.transform(arr, lambda v: F.concat(F.lit(t), v))
    names = F.concat(tag("n:", F.col("candidates")), tag("r:", F.col("roots")) if dedupe.enable_nickname_equivalence else F.array().cast("array<string>"))
    profile = F.when(F.col("linkedin_url") != "", F.array(F.concat(F.lit("u:"), "linkedin_url"))).otherwise(F.array().cast("array<string>"))
    keys = F.array_distinct(F.concat(names, tag("e:", F.col("s_email")), tag("p:", F.col("s_phone")), tag("a:", F.col("s_addr")), profile))
    rows = keyed.withColumn("keys", keys)
    side = F.struct(*EVIDENCE, "keys")
    coded = rows.select("block_key", F.explode("keys").alias("key"), side.alias("x"))
    left, right = coded.select("block_key", "key", F.col("x").alias("left")), coded.select("block_key", "key", F.col("x").alias("right"))
    pairs = left.join(right, ["block_key", "key"]).where("left.rec_idx < right.rec_idx")
    # A pair is kept under the smallest key it shares, so that no shuffle has to remove repeats.
    return pairs.where(F.col("key") == F.array_min(F.array_intersect("left.keys", "right.keys"))).select("left", "right")


def pair_signals(pairs: DataFrame, dedupe: Dedupe = Dedupe()) -> DataFrame:
    """Adds overlaps, number of corroborators, first-name similarity and score."""
    a, b = (lambda c: F.col(f"left.{c}")), (lambda c: F.col(f"right.{c}"))
    over = lambda c: F.arrays_overlap(a(c), b(c))
    out = pairs.withColumns({
        "email_overlap": over("s_email"), "phone_overlap": over("s_phone"), "addr_overlap": over("s_addr"),
        "same_profile": (a("linkedin_url") != "") & (a("linkedin_url") == b("linkedin_url")),
        "same_name": over("candidates"), "nick_equal": over("roots") & F.lit(dedupe.enable_nickname_equivalence),
        "same_suffix": (a("suffix") != "") & (F.lower(a("suffix")) == F.lower(b("suffix"))),
        "both_named": (F.size(a("candidates")) > 0) & (F.size(b("candidates")) > 0),
    })
    count = sum((F.col(c).cast("int") for c in ("email_overlap", "phone_overlap", "addr_overlap", "same_profile")), F.lit(0))
    out = out.withColumn("corroborators", count)
    cand = lambda s: F.when(F.col("both_named"), F.col(f"{s}.candidates")).otherwise(F.array(F.col(f"{s}.first_name")))
    # At most two names a side. Equal names need no measuring, and null lists are not measured.
    sure = F.col("same_name") & F.col("both_named")
    measured = best_ratio(F.when(~sure, cand("left")), F.when(~sure, cand("right")))
    out = out.withColumn("sim", F.coalesce(F.when(sure, F.lit(1.0)), measured))
    lifted = F.when(F.col("both_named") & F.col("nick_equal"), F.greatest(F.col("sim"), F.lit(0.96))).otherwise(F.col("sim"))
    out = out.withColumn("first_similarity", lifted).drop("sim")
    i = lambda c: F.col(c).cast("double")
    score = (
        0.7 * F.col("first_similarity") + 0.1 * i("same_suffix") + i("email_overlap") + i("phone_overlap") + 0.5 * i("addr_overlap") + 0.8 * i("same_profile")
    )
    return out.withColumn("score", score)


def gate(signals: DataFrame, dedupe: Dedupe = Dedupe()) -> Column:
    """Whether a pair is one person."""
    a, b = (lambda c: F.col(f"left.{c}")), (lambda c: F.col(f"right.{c}"))
    close = F.col("first_similarity") >= dedupe.first_name_similarity_threshold
    scored = (F.col("score") >= dedupe.merge_score_threshold) | (close & (F.col("score") >= dedupe.relaxed_merge_threshold))
    core = lambda s: (F.size(f"{s}.candidates") > 0) & (F.col(f"{s}.k_last") != "")
    backed = F.col("corroborators") > 0
    named = ~F.col("both_named") | F.col("same_name") | F.col("nick_equal") | F.col("email_overlap") | F.col("same_profile")
    network = (F.lower(a("source")) == "linkedin") | (F.lower(b("source")) == "linkedin")
    strict = (a("k_last") == b("k_last")) & (F.col("same_name") | F.col("nick_equal")) & (a("k_suffix") == b("k_suffix"))
    ok = scored & ((core("left") & core("right")) | backed) & named & (~network | F.col("email_overlap") | strict)
    return ok & backed if dedupe.require_corroborator else ok


def match_edges(keyed: DataFrame, dedupe: Dedupe = Dedupe()) -> DataFrame:
    """a, b: indexes of the pairs that pass the gate."""
    signals = pair_signals(candidate_pairs(keyed, dedupe), dedupe)
    return signals.where(gate(signals, dedupe)).select(F.col("left.rec_idx").alias("a"), F.col("right.rec_idx").alias("b"))


def clusters(keyed: DataFrame, dedupe: Dedupe = Dedupe()) -> DataFrame:
    """rec_idx, cluster_id (smallest index of the cluster) of every record.

    Records with equal evidence fold into one before they are paired: a copy has the links of its first record, so it
    belongs to that record's cluster if the gate lets the two meet, or if the first one links to anything at all."""
    same = F.sha2(F.to_json(F.struct("block_key", *[c for c in EVIDENCE if c not in ("rec_idx", "block_key")])), 256)
    rows = cut(keyed.select(*EVIDENCE, same.alias("same")))
    firsts = rows.groupBy("same").agg(F.min("rec_idx").alias("rep"), F.count("*").alias("n"))
    reps = cut(rows.join(firsts, (rows["same"] == firsts["same"]) & (F.col("rec_idx") == F.col("rep"))).drop(firsts["same"]))
    edges = cut(match_edges(reps, dedupe))
    twin = F.struct(*EVIDENCE)
    twins = pair_signals(reps.where("n > 1").select(twin.alias("left"), twin.alias("right")), dedupe)
    meets = twins.where(gate(twins, dedupe)).select(F.col("left.rec_idx").alias("rep"))
    linked = edges.select(F.col("a").alias("rep")).union(edges.select("b")).union(meets).distinct()
    copies = rows.select("same", "rec_idx").join(firsts.where("n > 1").join(linked, "rep"), "same").where("rec_idx <> rep")
    found = connected_components(edges.union(copies.select("rep", "rec_idx")), "a", "b").withColumnRenamed("node", "rec_idx")
    return keyed.select("rec_idx").join(found, "rec_idx", "left").select("rec_idx", F.coalesce("component", "rec_idx").alias("cluster_id"))
