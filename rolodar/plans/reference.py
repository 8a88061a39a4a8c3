"""Queries of the unification operators over the star-schema tables, each with its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolodar import config as cfg
from rolodar.functions import address, channels, fixed, names, text
from rolodar.operators import instants, merge, reports, resolve
from rolodar.operators.normalize import normalize
from rolodar.plans import pipeline, workload
from rolodar.runtime import cut, table

TAGGING = cfg.Tagging(prior_companies=("company 7",), prior_domains=("mail3.example",), local_cities=("city12", "city3"))
_W = f"w AS ({workload.SQL})"


def _keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut(resolve.with_keys(normalize(workload.records(spark, sf_dir))))


def contact_union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = workload.rows(spark, sf_dir)
    return r.select("rec_idx", "source", "first_name", "last_name", "email", "phone")


def email_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = workload.rows(spark, sf_dir)
    e = channels.normalize_email(F.col("email"))
    return r.select("rec_idx", F.coalesce(e, F.lit("")).alias("email_norm"), e.isNotNull().alias("is_valid"), F.coalesce(channels.email_domain(F.col("email")), F.lit("")).alias("domain"))


def phone_e164(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = workload.rows(spark, sf_dir).where("phone <> ''")
    p = channels.phone_e164(F.col("phone"))
    return r.select("rec_idx", p.alias("e164"), channels.phone_valid(p).alias("is_valid"))


def phone_extension(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = workload.rows(spark, sf_dir).where("phone <> ''")
    x = channels.split_extension(F.concat("phone", F.lit(" ext. "), (F.col("k") % 1000).cast("string")))
    return r.select("rec_idx", x["value"].alias("number"), x["extension"].alias("extension"))


def state_country_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    states = workload.rows(spark, sf_dir).select("state").distinct().select(F.lit("state").alias("kind"), F.col("state").alias("raw"), address.state_code(F.col("state")).alias("code"))
    return states.union(n.select(F.lit("country"), F.col("n_name"), address.country_code(F.col("n_name"))))


def address_match_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = normalize(workload.records(spark, sf_dir))
    return r.select("rec_idx", F.array_join(address.match_keys(F.col("addresses")), ";").alias("match_keys"))


def export_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.when(F.col("o_orderkey") % 2 == 0, "* ").otherwise(""), F.when(F.col("o_orderkey") % 3 == 0, "Work Mobile").when(F.col("o_orderkey") % 3 == 1, "Home").otherwise("Anders")).alias("raw"))
    x = channels.export_label(F.col("raw"), True)
    return o.select("o_orderkey", x["label"].alias("label"), x["preferred"].alias("preferred"))


def network_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "dd MMM yyyy").alias("raw"))
    timed = instants.parse_instants(o, "raw", None)
    return timed.select("o_orderkey", instants.micros_to_text(F.col("utc_us")).alias("utc_text"))


def block_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed(spark, sf_dir).select("rec_idx", "block_key")


def candidate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.candidate_pairs(_keyed(spark, sf_dir)).select(F.col("left.rec_idx").alias("a"), F.col("right.rec_idx").alias("b"))


def match_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.match_edges(_keyed(spark, sf_dir))


SCORED = cfg.Dedupe(merge_score_threshold=5.0, relaxed_merge_threshold=1.19)


def match_edges_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges under thresholds at which the weights of the evidence decide."""
    return resolve.match_edges(_keyed(spark, sf_dir), SCORED)


def entity_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.clusters(_keyed(spark, sf_dir))


def _unified(spark: SparkSession, sf_dir: str) -> pipeline.Result:
    return pipeline.unify(workload.records(spark, sf_dir))


def survivorship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unified(spark, sf_dir).merged.select("cluster_id", "company", "title", "linkedin_url", "source_row_count", "source_count")


def merged_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unified(spark, sf_dir).contacts


def lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unified(spark, sf_dir).lineage


def flattened_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unified(spark, sf_dir).flattened


def duplicate_id_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check on a table of which some ids are repeated (family names stand for ids), and on the unified one."""
    planted = workload.rows(spark, sf_dir).select(F.col("last_name").alias("contact_id"))
    return merge.duplicate_ids(planted.union(_unified(spark, sf_dir).contacts.select("contact_id")))


def merged_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _unified(spark, sf_dir).merged
    return m.select("cluster_id", merge.render_pairs(F.col("emails")).alias("emails"), merge.render_phones(F.col("phones")).alias("phones"), F.array_join("lineage_keys", "|").alias("lineage_keys"))


def best_first_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unified(spark, sf_dir).merged.select("cluster_id", F.col("first_name").alias("best_first"))


def pair_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = resolve.pair_signals(resolve.candidate_pairs(_keyed(spark, sf_dir)))
    flags = ["email_overlap", "phone_overlap", "addr_overlap", "same_profile", "same_name", "nick_equal", "corroborators"]
    return s.select(F.col("left.rec_idx").alias("a"), F.col("right.rec_idx").alias("b"), *flags)


def label_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of a customer's orders, folded per priority in order of their keys."""
    o = table(spark, sf_dir, "orders")
    label = F.element_at(F.array(*[F.lit(x) for x in ("", "other", "work", "home")]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    items = o.select(
        F.col("o_custkey").alias("owner"), F.col("o_orderpriority").alias("value"), F.col("o_orderkey").alias("rec_idx"), F.lit(0).alias("pos"), label.alias("label"),
        (F.col("o_orderkey") % 5).alias("ts_us"), F.struct((F.col("o_orderkey") % 3).alias("prio")).alias("rank"),
    )
    return merge.label_fold(items, ["owner", "value"]).select("owner", "value", "label")


def channel_dedupe_best_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mailboxes of an order's lines: once each with their first label, the broken ones last."""
    li = table(spark, sf_dir, "lineitem")
    bad = F.col("l_partkey") % 7 == 0
    value = F.when(bad, F.concat(F.lit("bad"), (F.col("l_suppkey") % 3).cast("string"))).otherwise(F.concat(F.lit("Box@Mail"), (F.col("l_suppkey") % 3).cast("string"), F.lit(".Example")))
    label = F.when(F.col("l_partkey") % 3 == 0, "").when(F.col("l_partkey") % 3 == 1, "Work").otherwise("home")
    item = F.struct(F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"), value.alias("value"), label.alias("label"))
    lists = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(item)).alias("items"))
    emails = channels.normalize_emails(F.transform("items", lambda x: F.struct(x["value"].alias("value"), x["label"].alias("label"))))
    return lists.select("l_orderkey", merge.render_pairs(emails).alias("emails"))


def quality_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _rendered(spark, sf_dir)
    return reports.quality_scored(c, reports.validate(c)).select("contact_id", "full_name", "email_valid_count", "phone_total", "department_missing", "quality_score")


def confidence_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.confidence_metrics(_confidence(spark, sf_dir))


def address_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = workload.rows(spark, sf_dir)
    line = F.concat("street", F.when(F.col("k") % 2 == 0, ", ").otherwise(" "), "city", F.lit(", MA "), (10000 + F.col("person")).cast("string"), F.when(F.col("k") % 3 == 0, "-1234").otherwise(""))
    t = r.select("rec_idx", address.split_tail(line).alias("t"))
    return t.select("rec_idx", *[f"t.{f}" for f in ("street", "city", "state", "postal_code")])


def email_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(channels.emails_in_text(F.col("text"))).alias("p", "email"))
    return d.select("doc_id", (F.col("p") + 1).cast("int").alias("pos"), "email", channels.email_domain(F.col("email")).alias("domain"))


def phone_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(channels.numbers_in_text(F.col("text"))).alias("p", "number"))
    return d.select("doc_id", (F.col("p") + 1).cast("int").alias("pos"), "number")


def contact_id_uuid5(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = workload.rows(spark, sf_dir)
    return r.select("rec_idx", text.uuid5(F.concat_ws("::", "first_name", "last_name", "email")).alias("contact_id"))


def _rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every projected row as a contact of its own, as stage files hold it."""
    r = workload.rows(spark, sf_dir)
    place = F.array(F.struct("street", "city", F.upper("state").alias("state"), "postal_code"))
    return r.select(
        F.col("rec_idx").cast("string").alias("contact_id"), F.concat_ws(" ", "first_name", "last_name").alias("full_name"), "first_name", "last_name", "company",
        "title", F.lit("").alias("department"), "linkedin_url",
        F.when(F.col("email") == "", "").when(F.startswith("email", F.lit("bad")), F.concat("email", F.lit("::invalid"))).otherwise(F.concat("email", F.lit("::work"))).alias("emails"),
        F.when(F.col("phone") == "", "").when(F.length("phone") < 6, F.concat("phone", F.lit("::invalid"))).otherwise(F.concat("phone", F.lit("::home"))).alias("phones"),
        F.to_json(place).alias("addresses_json"), (1 + F.col("k") % 3).cast("string").alias("source_count"), F.col("source"), F.col("k").cast("string").alias("source_row_id"),
        "note",
    )


def validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = reports.validate(_rendered(spark, sf_dir))
    return v.select("contact_id", "email_valid_count", "email_total", "phone_valid_count", "phone_total", "addr_valid_count", "quality_score")


def coverage_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.coverage(reports.validate(_rendered(spark, sf_dir)))


def _confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _rendered(spark, sf_dir)
    return reports.confidence(c, reports.validate(c))


def confidence_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _confidence(spark, sf_dir).select("contact_id", "confidence_score", "confidence_bucket")


def confidence_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.confidence_summary(_confidence(spark, sf_dir))


def top_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _confidence(spark, sf_dir)
    return reports.top_confidence(c, c).select("contact_id", "confidence_score", "source_count")


def notes_blob(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _rendered(spark, sf_dir)
    by_person = r.select(F.col("full_name").alias("contact_id"), "source", "source_row_id")
    return reports.notes_blob(by_person, r.select("source", "source_row_id", "note"))


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _confidence(spark, sf_dir)
    return reports.tag(c, c.where("note <> ''").select("contact_id", F.col("note").alias("notes_blob")), TAGGING)


def tags_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tagged(spark, sf_dir).select("contact_id", "tags", "relationship_category", "referral_priority_score")


def top_referrals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_referrals(_tagged(spark, sf_dir)).select("contact_id", "referral_priority_score", "confidence_score")


def invalid_email_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = normalize(workload.records(spark, sf_dir)).select(F.col("rec_idx").alias("contact_id"), "invalid_emails")
    return reports.rejected_values(r, "invalid_emails")


def nonstandard_phone_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = normalize(workload.records(spark, sf_dir)).select(F.col("rec_idx").alias("contact_id"), "non_standard_phones")
    return reports.rejected_values(r, "non_standard_phones")


def name_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = names.name_parser()(F.col("full_name_raw"))
    return table(spark, sf_dir, "contact_records").select("rec_id", n.alias("n")).select("rec_id", *[f"n.{p}" for p in names.PARTS])


def first_name_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "contact_records")
    return r.select("rec_id", text.seq_ratio("first_name", "nickname").alias("similarity"))


def text_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "contact_records").select("rec_id", text.text_key("company").alias("company_key"))


def unified_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole pipeline over the raw contact records."""
    r = table(spark, sf_dir, "contact_records").withColumnRenamed("rec_id", "rec_idx")
    mail = F.transform(channels.split_values("emails"), lambda v: F.struct(v.alias("value"), F.lit("").alias("label")))
    phone = F.transform(channels.phone_values("phones"), lambda v: F.struct(v["value"].alias("value"), F.lit("").alias("label"), v["extension"].alias("extension")))
    return pipeline.unify(r.withColumn("emails", mail).withColumn("phones", phone)).contacts


_STATE = "CASE WHEN length(state) = 2 THEN upper(state) " + " ".join(f"WHEN lower(state) = '{n}' THEN '{c}'" for n, c in fixed.STATE_CODE.items()) + " ELSE upper(state) END"
_COUNTRY = "CASE lower(n_name) " + " ".join("WHEN '" + n.replace("'", "''") + f"' THEN '{c}'" for n, c in fixed.COUNTRY_CODE.items()) + " ELSE CASE WHEN length(n_name) = 2 THEN upper(n_name) ELSE n_name END END"
_VALID = r"regexp_full_match(email, '[\w.%+''-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}')"
_NORM = "concat(split_part(email, '@', 1), '@', lower(split_part(email, '@', 2)))"
_DIGITS = "regexp_replace(phone, '[^0-9]', '', 'g')"
_E164 = f"CASE WHEN length({_DIGITS}) = 11 AND {_DIGITS} LIKE '1%' THEN concat('+', {_DIGITS}) WHEN length({_DIGITS}) BETWEEN 12 AND 15 THEN concat('+', {_DIGITS}) ELSE concat('+1', {_DIGITS}) END"
# Evidence of a projected row, in the words of SQL: block = family name, root of the given name, values.
_EV = f"""{_W}, n AS (SELECT *, lower(last_name) AS bk, lower(first_name) AS fk, {workload.ROOT} AS root,
  CASE WHEN {_VALID} THEN {_NORM} ELSE email END AS em,
  CASE WHEN phone = '' THEN '' WHEN length({_DIGITS}) >= 10 THEN {_E164} ELSE phone END AS ph,
  CASE WHEN state <> '' OR postal_code <> '' THEN concat_ws('|', lower(city), {_STATE}, postal_code) ELSE '' END AS ad FROM w)"""
_SHARE = "(l.root = r.root OR l.fk = r.fk OR (l.em <> '' AND l.em = r.em) OR (l.ph <> '' AND l.ph = r.ph) OR (l.ad <> '' AND l.ad = r.ad) OR (l.linkedin_url <> '' AND l.linkedin_url = r.linkedin_url))"
_PAIRS = f"SELECT l.rec_idx AS a, r.rec_idx AS b FROM n l JOIN n r ON l.bk = r.bk AND l.rec_idx < r.rec_idx WHERE {_SHARE}"
# A shared mailbox or profile implies an equal root here, and equal roots always score enough.
_EDGES = "SELECT l.rec_idx AS a, r.rec_idx AS b FROM n l JOIN n r ON l.bk = r.bk AND l.rec_idx < r.rec_idx WHERE l.root = r.root"
_SCORES = f"""SELECT l.rec_idx AS a, r.rec_idx AS b, l.fk = r.fk AS same_name, l.root = r.root AS nick, 0.7 * CASE WHEN l.fk = r.fk THEN 1.0 ELSE 0.96 END
  + CASE WHEN l.em <> '' AND l.em = r.em THEN 1 ELSE 0 END + CASE WHEN l.ph <> '' AND l.ph = r.ph THEN 1 ELSE 0 END + CASE WHEN l.ad <> '' AND l.ad = r.ad THEN 0.5 ELSE 0 END
  + CASE WHEN l.linkedin_url <> '' AND l.linkedin_url = r.linkedin_url THEN 0.8 ELSE 0 END AS score FROM n l JOIN n r ON l.bk = r.bk AND l.rec_idx < r.rec_idx WHERE {_SHARE}"""
_CLUSTERS = f"""{_EV}, e AS ({_EDGES}), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
  t AS (SELECT rec_idx AS node, rec_idx AS reach FROM n UNION SELECT t.node, u.b FROM t JOIN u ON t.reach = u.a),
  cl AS (SELECT node AS rec_idx, min(reach) AS cluster_id FROM t GROUP BY node)"""
_MERGED = f"""{_CLUSTERS}, m AS (SELECT n.*, cl.cluster_id, {_STATE} AS st, CASE WHEN em = '' THEN '' WHEN {_VALID} THEN 'work' ELSE 'invalid' END AS elab,
    CASE WHEN length({_DIGITS}) >= 10 THEN 'home' ELSE 'invalid' END AS plab FROM n JOIN cl ON n.rec_idx = cl.rec_idx),
  js AS (SELECT *, concat('{{"po_box":"","extended":"","street":"', street, '","city":"', city, '","state":"', st, '","postal_code":"', postal_code, '","country":"US","label":"home"}}') AS j FROM m),
  es AS (SELECT cluster_id, string_agg(em || '::' || elab, '|' ORDER BY em) AS emails, string_agg(em, ';' ORDER BY em) AS ev,
    min(CASE WHEN elab = 'work' THEN em END) AS work_email FROM (SELECT DISTINCT cluster_id, em, elab FROM m WHERE em <> '') GROUP BY 1),
  ps AS (SELECT cluster_id, string_agg(ph || '::' || plab, '|' ORDER BY ph) AS phones, string_agg(ph, ';' ORDER BY ph) AS pv,
    min(CASE WHEN plab = 'home' THEN ph END) AS home_phone FROM (SELECT DISTINCT cluster_id, ph, plab FROM m WHERE ph <> '') GROUP BY 1),
  ads AS (SELECT cluster_id, '[' || string_agg(j, ',' ORDER BY o) || ']' AS addresses_json FROM (SELECT cluster_id, j, min(rec_idx) AS o FROM js GROUP BY 1, 2) GROUP BY 1),
  fa AS (SELECT cluster_id, arg_min(concat_ws(', ', nullif(street, ''), nullif(city, ''), nullif(st, ''), nullif(postal_code, ''), 'US'), rec_idx) AS home_address FROM m GROUP BY 1),
  lk AS (SELECT cluster_id, string_agg(lk, '|' ORDER BY lk) AS lineage_keys FROM (SELECT cluster_id, concat(source, ':', CAST(k AS VARCHAR)) AS lk FROM m) GROUP BY 1),
  vo AS (SELECT cluster_id, lower(first_name) AS key, CASE source WHEN 'linkedin' THEN 2.0 ELSE 1.0 END AS wt, true AS ex, rec_idx * 2 AS o FROM m
    UNION ALL SELECT cluster_id, root, 1.5, false, rec_idx * 2 + 1 FROM m WHERE elab = 'work'),
  bf AS (SELECT cluster_id, arg_max(upper(key[1:1]) || key[2:], (wt, -o)) AS best_first FROM (SELECT cluster_id, key, sum(wt) AS wt, bool_or(ex) AS ex, min(o) AS o FROM vo GROUP BY 1, 2) WHERE ex GROUP BY 1)"""
_BEST = "coalesce(arg_max({c}, ({{r}})) FILTER (WHERE {c} <> ''), '') AS {c}"
_RANK = "CASE WHEN source_timestamp <> '' THEN concat('1', source_timestamp) ELSE '0' END || CASE source WHEN 'linkedin' THEN '3' WHEN 'mac_vcf' THEN '2' ELSE '1' END || lpad(CAST(9999999999 - n.rec_idx AS VARCHAR), 10, '0')"
# A contact of the merged table; the id is a version-5 UUID over its texts.
_CONTACT = f"""{_MERGED}, sv AS (SELECT cluster_id, {', '.join(_BEST.format(c=c).replace('{r}', _RANK.replace("n.rec_idx", "rec_idx")) for c in ('last_name', 'company', 'title', 'linkedin_url'))},
    CAST(count(*) AS INTEGER) AS source_row_count, CAST(count(DISTINCT source) AS INTEGER) AS source_count FROM m GROUP BY cluster_id),
  ct AS (SELECT sv.*, best_first AS first_name, concat_ws(' ', best_first, last_name) AS full_name, coalesce(emails, '') AS emails, coalesce(phones, '') AS phones, coalesce(work_email, '') AS work_email,
    coalesce(home_phone, '') AS home_phone, home_address, addresses_json, lineage_keys,
    sha1(from_hex('{fixed.UUID_NAMESPACE}') || encode(concat_ws('::', concat_ws(' ', best_first, last_name), company, title, coalesce(ev, ''), coalesce(pv, ''), lineage_keys))) AS h
    FROM sv JOIN bf USING (cluster_id) JOIN lk USING (cluster_id) JOIN ads USING (cluster_id) JOIN fa USING (cluster_id) LEFT JOIN es USING (cluster_id) LEFT JOIN ps USING (cluster_id)),
  co AS (SELECT *, concat(h[1:8], '-', h[9:12], '-5', h[14:16], '-', CASE WHEN instr('048c', h[17:17]) > 0 THEN '8' WHEN instr('159d', h[17:17]) > 0 THEN '9' WHEN instr('26ae', h[17:17]) > 0 THEN 'a' ELSE 'b' END, h[18:20], '-', h[21:32]) AS contact_id FROM ct)"""
_R = f"""{_W}, c AS (SELECT *, CAST(rec_idx AS VARCHAR) AS contact_id,
  CASE WHEN email = '' OR email LIKE 'bad%' THEN 0 ELSE 1 END AS ev, CASE WHEN email = '' THEN 0 ELSE 1 END AS et,
  CASE WHEN phone = '' OR length(phone) < 6 THEN 0 ELSE 1 END AS pv, CASE WHEN phone = '' THEN 0 ELSE 1 END AS pt, 1 AS av FROM w),
  q AS (SELECT *, CASE WHEN ev = 1 THEN 40 ELSE 0 END + CASE WHEN pv = 1 THEN 30 ELSE 0 END + 30 AS quality FROM c)"""
_CONF = f"""{_R}, s AS (SELECT *, least(100, greatest(0, CAST(round(quality * 0.4) AS INTEGER)
    + least(20, 5 * (et + pt + 1 + CASE WHEN linkedin_url <> '' THEN 1 ELSE 0 END))
    + CASE WHEN 1 + k % 3 >= 3 THEN 10 WHEN 1 + k % 3 = 2 THEN 6 ELSE 2 END + CASE WHEN linkedin_url <> '' THEN 6 ELSE 0 END
    + CASE WHEN company <> '' OR title <> '' THEN 6 ELSE 0 END + CASE WHEN ev = 1 THEN 5 ELSE 0 END + CASE WHEN pv = 1 THEN 3 ELSE 0 END + 2 + 3 + 2
    - CASE WHEN et = 1 AND ev = 0 THEN 5 ELSE 0 END - CASE WHEN pt = 1 AND pv = 0 THEN 4 ELSE 0 END)) AS score FROM q),
  b AS (SELECT *, CASE WHEN score >= 80 THEN 'very_high' WHEN score >= 60 THEN 'high' WHEN score >= 40 THEN 'medium' ELSE 'low' END AS bucket FROM s)"""
_TAGS = f"""{_CONF}, g AS (SELECT *,
    CASE WHEN upper(state) = 'MA' AND (city LIKE '%City12%' OR city LIKE '%City3%') THEN 1 ELSE 0 END AS t1,
    CASE WHEN note <> '' THEN 1 ELSE 0 END AS t2, CASE WHEN title LIKE 'Ballet%' THEN 1 ELSE 0 END AS t3,
    CASE WHEN lower(company) LIKE '%company 7%' OR (email NOT LIKE 'bad%' AND lower(email) LIKE '%@%mail3.example%') THEN 1 ELSE 0 END AS t4 FROM b),
  tg AS (SELECT *, concat_ws('|', CASE WHEN t1 = 1 THEN 'local_south_shore' END, CASE WHEN t2 = 1 THEN 'martial_arts' END,
    CASE WHEN t3 = 1 THEN 'nutcracker_performance' END, CASE WHEN t4 = 1 THEN 'work_colleague' END) AS tags,
    CASE WHEN t2 + t3 > 0 THEN 'personal' WHEN t4 = 1 OR linkedin_url <> '' THEN 'professional' WHEN t1 = 1 THEN 'local_referral' ELSE 'uncategorized' END AS cat,
    least(100, CAST(round_even(0.6 * score + 30 * t4 + 25 * t1 + 20 * t2 + 10 * t3, 0) AS INTEGER)) AS prio FROM g)"""

SQL: dict[str, str] = {
    "contact_union_sources": f"WITH {_W} SELECT rec_idx, source, first_name, last_name, email, phone FROM w",
    "email_normalize": f"WITH {_W} SELECT rec_idx, CASE WHEN {_VALID} THEN {_NORM} ELSE '' END AS email_norm, {_VALID} AS is_valid, CASE WHEN contains(email, '@') THEN lower(split_part(email, '@', 2)) ELSE '' END AS domain FROM w",
    "phone_e164": f"WITH {_W} SELECT rec_idx, {_E164} AS e164, length({_E164}) >= 12 AS is_valid FROM w WHERE phone <> ''",
    "phone_extension": f"WITH {_W} SELECT rec_idx, phone AS number, CAST(k % 1000 AS VARCHAR) AS extension FROM w WHERE phone <> ''",
    "state_country_codes": f"WITH {_W} SELECT DISTINCT 'state' AS kind, state AS raw, {_STATE} AS code FROM w UNION ALL SELECT 'country', n_name, {_COUNTRY} FROM nation",
    "address_match_keys": f"{'WITH ' + _EV} SELECT rec_idx, ad AS match_keys FROM n",
    "export_labels": "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'mobile' WHEN o_orderkey % 3 = 1 THEN 'home' ELSE 'other' END AS label, o_orderkey % 2 = 0 AS preferred FROM orders",
    "network_dates": "SELECT o_orderkey, strftime(date_trunc('day', o_orderdate), '%Y-%m-%d %H:%M:%S.%f') AS utc_text FROM orders",
    "block_keys": f"WITH {_EV} SELECT rec_idx, bk AS block_key FROM n",
    "candidate_pairs": f"WITH {_EV} {_PAIRS}",
    "match_edges": f"WITH {_EV} {_EDGES}",
    "match_edges_scored": f"WITH {_EV}, s AS ({_SCORES}) SELECT a, b FROM s WHERE (same_name OR nick) AND score >= 1.19",
    "entity_clusters": f"WITH RECURSIVE {_CLUSTERS} SELECT rec_idx, cluster_id FROM cl",
    "survivorship": f"WITH RECURSIVE {_CLUSTERS} SELECT cluster_id, {', '.join(_BEST.format(c=c).replace('{r}', _RANK) for c in ('company', 'title', 'linkedin_url'))}, CAST(count(*) AS INTEGER) AS source_row_count, CAST(count(DISTINCT source) AS INTEGER) AS source_count FROM n JOIN cl ON n.rec_idx = cl.rec_idx GROUP BY cluster_id",
    "validation_report": f"WITH {_R} SELECT contact_id, ev AS email_valid_count, et AS email_total, pv AS phone_valid_count, pt AS phone_total, av AS addr_valid_count, quality AS quality_score FROM q",
    "coverage_metrics": f"WITH {_R} SELECT count(*) AS total_contacts, CAST(round(100.0 * sum(et) / count(*), 2) AS DOUBLE) AS has_any_email_pct, CAST(round(100.0 * sum(pt) / count(*), 2) AS DOUBLE) AS has_any_phone_pct, CAST(100.0 AS DOUBLE) AS has_any_address_pct FROM q",
    "confidence_report": f"WITH {_CONF} SELECT contact_id, score AS confidence_score, bucket AS confidence_bucket FROM b",
    "confidence_summary": f"WITH {_CONF} SELECT v.bucket, coalesce(x.n, 0) AS \"count\", CAST(round(100.0 * coalesce(x.n, 0) / (SELECT count(*) FROM b), 2) AS DOUBLE) AS pct FROM (VALUES ('very_high'), ('high'), ('medium'), ('low')) AS v(bucket) LEFT JOIN (SELECT bucket, count(*) AS n FROM b GROUP BY bucket) x ON x.bucket = v.bucket",
    "top_confidence": f"WITH {_CONF} SELECT contact_id, score AS confidence_score, CAST(1 + k % 3 AS INTEGER) AS source_count FROM b WHERE bucket IN ('very_high', 'high') ORDER BY score DESC, source_count DESC, contact_id LIMIT 25",
    "notes_blob": f"WITH {_W} SELECT concat_ws(' ', first_name, last_name) AS contact_id, string_agg(note, ' | ' ORDER BY CASE source WHEN 'linkedin' THEN 0 WHEN 'gmail' THEN 1 ELSE 2 END, k) AS notes_blob FROM w WHERE note <> '' GROUP BY 1",
    "tags_category": f"WITH {_TAGS} SELECT contact_id, tags, cat AS relationship_category, prio AS referral_priority_score FROM tg",
    "top_referrals": f"WITH {_TAGS} SELECT contact_id, prio AS referral_priority_score, score AS confidence_score FROM tg ORDER BY prio DESC, score DESC, contact_id LIMIT 25",
    "invalid_email_explode": f"WITH {_W} SELECT rec_idx AS contact_id, email AS value FROM w WHERE email <> '' AND NOT {_VALID}",
    "nonstandard_phone_explode": f"WITH {_W} SELECT rec_idx AS contact_id, phone AS value FROM w WHERE phone <> '' AND length({_DIGITS}) < 10",
    "contact_id_uuid5": f"""WITH {_W}, h AS (SELECT rec_idx, sha1(from_hex('{fixed.UUID_NAMESPACE}') || encode(concat_ws('::', first_name, last_name, email))) AS h FROM w)
        SELECT rec_idx, concat(h[1:8], '-', h[9:12], '-5', h[14:16], '-', CASE WHEN instr('048c', h[17:17]) > 0 THEN '8' WHEN instr('159d', h[17:17]) > 0 THEN '9' WHEN instr('26ae', h[17:17]) > 0 THEN 'a' ELSE 'b' END, h[18:20], '-', h[21:32]) AS contact_id FROM h""",
    "duplicate_id_check": f"WITH {_W} SELECT last_name AS contact_id, count(*) AS n FROM w GROUP BY 1 HAVING count(*) > 1",
    "merged_channels": f"WITH RECURSIVE {_MERGED} SELECT c.cluster_id, coalesce(emails, '') AS emails, coalesce(phones, '') AS phones, lineage_keys FROM (SELECT DISTINCT cluster_id FROM m) c JOIN lk USING (cluster_id) LEFT JOIN es USING (cluster_id) LEFT JOIN ps USING (cluster_id)",
    "best_first_name": f"WITH RECURSIVE {_MERGED} SELECT cluster_id, best_first FROM bf",
    "merged_contacts": f"WITH RECURSIVE {_CONTACT} SELECT contact_id, full_name, '' AS prefix, first_name, '' AS middle_name, last_name, '' AS maiden_name, '' AS suffix, '' AS suffix_professional, '' AS nickname, company, title, '' AS department, linkedin_url, emails, phones, addresses_json, source_count, source_row_count FROM co",
    "lineage": f"WITH RECURSIVE {_CONTACT} SELECT contact_id, source, CAST(k AS VARCHAR) AS source_row_id, concat_ws(' ', js.first_name, js.last_name) AS source_full_name, js.company AS source_company, js.title AS source_title, CASE WHEN em = '' THEN '' ELSE em || '::' || elab END AS source_emails, CASE WHEN ph = '' THEN '' ELSE ph || '::' || plab END AS source_phones, '[' || j || ']' AS source_addresses_json, email AS source_emails_raw, phone AS source_phones_raw, concat('[{{\"po_box\":\"\",\"extended\":\"\",\"street\":\"', street, '\",\"city\":\"', city, '\",\"state\":\"', state, '\",\"postal_code\":\"', postal_code, '\",\"country\":\"us\",\"label\":\"home\"}}]') AS source_addresses_raw_json FROM js JOIN co ON js.cluster_id = co.cluster_id",
    "flattened_contacts": f"WITH RECURSIVE {_CONTACT} SELECT contact_id, full_name, company, '' AS department, title, linkedin_url, '' AS home_email, home_phone, home_address, work_email, '' AS work_phone, '' AS work_address, '' AS other_email, '' AS other_phone, '' AS other_address FROM co",
    "pair_signals": f"WITH {_EV} SELECT l.rec_idx AS a, r.rec_idx AS b, l.em <> '' AND l.em = r.em AS email_overlap, l.ph <> '' AND l.ph = r.ph AS phone_overlap, l.ad <> '' AND l.ad = r.ad AS addr_overlap, l.linkedin_url <> '' AND l.linkedin_url = r.linkedin_url AS same_profile, l.fk = r.fk AS same_name, l.root = r.root AS nick_equal, CAST(l.em <> '' AND l.em = r.em AS INTEGER) + CAST(l.ph <> '' AND l.ph = r.ph AS INTEGER) + CAST(l.ad <> '' AND l.ad = r.ad AS INTEGER) + CAST(l.linkedin_url <> '' AND l.linkedin_url = r.linkedin_url AS INTEGER) AS corroborators FROM n l JOIN n r ON l.bk = r.bk AND l.rec_idx < r.rec_idx WHERE {_SHARE}",
    "text_keys": r"SELECT rec_id, lower(strip_accents(trim(regexp_replace(coalesce(company, ''), '\s+', ' ', 'g')))) AS company_key FROM contact_records",
    "label_fold": """WITH i AS (SELECT o_custkey AS owner, o_orderpriority AS value, o_orderkey AS k, {'label': ['', 'other', 'work', 'home'][o_orderkey % 4 + 1], 'ts': o_orderkey % 5, 'prio': o_orderkey % 3} AS s FROM orders),
        l AS (SELECT owner, value, list(s ORDER BY k) AS xs FROM i GROUP BY 1, 2)
        SELECT owner, value, list_reduce(xs, lambda x, y: CASE WHEN (y.ts > x.ts OR (y.ts = x.ts AND y.prio > x.prio)) OR (y.prio = x.prio AND x.label = '' AND y.label <> '')
          OR (x.label = 'other' AND y.label NOT IN ('', 'other') AND NOT (x.ts > y.ts OR (x.ts = y.ts AND x.prio > y.prio))) THEN y ELSE x END).label AS label FROM l""",
    "channel_dedupe_best_label": """WITH i AS (SELECT l_orderkey, l_linenumber AS n, l_partkey AS p, l_partkey % 7 = 0 AS bad, CASE WHEN l_partkey % 7 = 0 THEN concat('bad', CAST(l_suppkey % 3 AS VARCHAR)) ELSE concat('Box@mail', CAST(l_suppkey % 3 AS VARCHAR), '.example') END AS v,
          CASE WHEN l_partkey % 3 = 0 THEN '' WHEN l_partkey % 3 = 1 THEN 'work' ELSE 'home' END AS lab FROM lineitem),
        d AS (SELECT l_orderkey, bad, v, min((n, p, v, lab)) AS o, coalesce(arg_min(lab, (n, p, lab)) FILTER (WHERE lab <> ''), '') AS lab FROM i GROUP BY 1, 2, 3)
        SELECT l_orderkey, string_agg(v || '::' || CASE WHEN bad THEN 'invalid' ELSE lab END, '|' ORDER BY bad, o) AS emails FROM d GROUP BY 1""",
    "quality_scored": f"WITH {_R} SELECT contact_id, concat_ws(' ', first_name, last_name) AS full_name, ev AS email_valid_count, pt AS phone_total, 1 AS department_missing, quality AS quality_score FROM q",
    "confidence_metrics": f"WITH {_CONF} SELECT count(*) AS total_contacts, CAST(round(avg(score), 2) AS DOUBLE) AS mean_confidence FROM b",
    "address_split": f"WITH {_W} SELECT rec_idx, CASE WHEN k % 2 = 0 THEN street ELSE split_part(street, ' ', 1) END AS street, CASE WHEN k % 2 = 0 THEN city ELSE concat('Main St ', city) END AS city, 'MA' AS state, CAST(10000 + person AS VARCHAR) AS postal_code FROM w",
    "email_extract": rf"WITH e AS (SELECT doc_id, regexp_extract_all(text, '{channels.EMAIL_IN_TEXT.replace(chr(39), chr(39) * 2)}') AS xs FROM documents WHERE text IS NOT NULL), u AS (SELECT doc_id, unnest(range(1, len(xs) + 1)) AS pos, xs FROM e) SELECT doc_id, CAST(pos AS INTEGER) AS pos, xs[pos] AS email, lower(split_part(xs[pos], '@', 2)) AS domain FROM u",
    "phone_extract": rf"WITH e AS (SELECT doc_id, list_filter(regexp_extract_all(text, '{channels.DIGIT_RUN}'), lambda x: length(ltrim(x, '+')) >= 8) AS xs FROM documents WHERE text IS NOT NULL), u AS (SELECT doc_id, unnest(range(1, len(xs) + 1)) AS pos, xs FROM e) SELECT doc_id, CAST(pos AS INTEGER) AS pos, xs[pos] AS number FROM u",
}

QUERIES = {
    f.__name__: f
    for f in (
        contact_union_sources, email_normalize, phone_e164, phone_extension, state_country_codes, address_match_keys, export_labels, network_dates,
        block_keys, candidate_pairs, match_edges, match_edges_scored, entity_clusters, survivorship, merged_contacts, lineage, flattened_contacts, duplicate_id_check,
        contact_id_uuid5, validation_report, coverage_metrics, confidence_report, confidence_summary, top_confidence, notes_blob, tags_category,
        merged_channels, best_first_name, pair_signals, label_fold, channel_dedupe_best_label, quality_scored, confidence_metrics, address_split, email_extract,
        phone_extract, top_referrals, invalid_email_explode, nonstandard_phone_explode, name_parse, first_name_similarity, text_keys, unified_records,
    )
}
