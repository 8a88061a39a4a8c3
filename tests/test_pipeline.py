"""The pipeline's behaviours, end to end on small records and files."""

import pytest
from pyspark.sql import functions as F

from rolodar import config as cfg
from rolodar.functions import channels
from rolodar.operators import merge, reports
from rolodar.operators.normalize import normalize
from rolodar.plans import pipeline
from rolodar.schema import CONTACT
from rolodar.sources import files



def records(spark, rows):
    """Contact records from dicts; missing fields are empty."""
    schema = "rec_idx long, " + CONTACT
    names = [f.name for f in spark.createDataFrame([], schema).schema]
    full = []
    for i, r in enumerate(rows):
        base = {n: "" for n in names} | {"rec_idx": i, "emails": [], "phones": [], "addresses": [], "source_row_id": str(i)} | r
        if not base["full_name_raw"]:
            base["full_name_raw"] = " ".join(x for x in (base["first_name"], base["last_name"]) if x)
        full.append(tuple(base[n] for n in names))
    return spark.createDataFrame(full, schema)


def email(v, label=""):
    return (v, label)


def contacts(spark, rows, **dedupe):
    return pipeline.unify(records(spark, rows), cfg.Config(dedupe=cfg.Dedupe(**dedupe)))


def test_nickname_equivalence_on_and_off(spark):
    rows = [
        {"source": "gmail", "first_name": "Bill", "last_name": "Doe", "emails": [email("a@x.example")]},
        {"source": "gmail", "first_name": "William", "last_name": "Doe", "emails": [email("b@x.example")]},
    ]
    assert contacts(spark, rows).contacts.count() == 1
    assert contacts(spark, rows, enable_nickname_equivalence=False).contacts.count() == 2


def test_explicit_nickname_links_and_is_exposed(spark):
    rows = [
        {"source": "gmail", "first_name": "William", "last_name": "Example", "emails": [email("w@x.example")]},
        {"source": "gmail", "first_name": "Will", "last_name": "Example", "nickname": "Billy", "emails": [email("w2@x.example")]},
    ]
    out = contacts(spark, rows).contacts.collect()
    assert len(out) == 1 and out[0]["nickname"] == "Billy"


def test_household_members_stay_apart(spark):
    home = [("", "", "1 Main St", "Boston", "MA", "02110", "US", "home")]
    rows = [
        {"source": "gmail", "first_name": "Alex", "last_name": "Resident", "addresses": home, "phones": [("4155550100", "", "")]},
        {"source": "gmail", "first_name": "Riley", "last_name": "Resident", "addresses": home, "phones": [("4155550101", "", "")]},
    ]
    out = contacts(spark, rows).contacts.collect()
    assert len(out) == 2 and {r["source_count"] for r in out} == {1}


def test_network_metadata_and_newer_timestamps_win(spark):
    rows = [
        {"source": "linkedin", "first_name": "Jordan", "last_name": "Example", "company": "Net Co", "title": "Chief", "linkedin_url": "https://linkedin.com/in/j"},
        {"source": "gmail", "first_name": "Jordan", "last_name": "Example", "company": "Web Co", "title": "Clerk"},
        {"source": "mac_vcf", "first_name": "Casey", "last_name": "Sample", "company": "Old Co", "source_timestamp": "2024-01-01T00:00:00Z"},
        {"source": "mac_vcf", "first_name": "Casey", "last_name": "Sample", "company": "New Co", "source_timestamp": "20240601T000000Z"},
    ]
    out = {r["last_name"]: r for r in contacts(spark, rows).contacts.collect()}
    assert (out["Example"]["company"], out["Example"]["title"]) == ("Net Co", "Chief")
    assert out["Sample"]["company"] == "New Co" and out["Sample"]["source_row_count"] == 2


def test_labels_fold_to_the_specific_one_and_blank_becomes_other(spark):
    rows = [
        {"source": "mac_vcf", "first_name": "Chris", "last_name": "Wright", "emails": [email("c@x.example", "other")]},
        {"source": "mac_vcf", "first_name": "Chris", "last_name": "Wright", "emails": [email("c@x.example", "work")]},
        {"source": "mac_vcf", "first_name": "Label", "last_name": "Less", "emails": [email("l@x.example")]},
    ]
    out = {r["last_name"]: r["emails"] for r in contacts(spark, rows).contacts.collect()}
    assert out == {"Wright": "c@x.example::work", "Less": "l@x.example::other"}


def test_ids_are_deterministic_and_unique(spark):
    rows = [{"source": "gmail", "first_name": f"Anna{i}", "last_name": "Berg", "emails": [email(f"a{i}@x.example")]} for i in range(5)]
    one, two = (sorted(r["contact_id"] for r in contacts(spark, rows).contacts.collect()) for _ in range(2))
    assert one == two and len(set(one)) == 5
    merge.assert_unique_ids(contacts(spark, rows).contacts)
    with pytest.raises(ValueError):
        merge.assert_unique_ids(spark.createDataFrame([("x",), ("x",)], "contact_id string"))


def test_lineage_flattened_and_reports(spark):
    home = [("", "", "1 Main St", "Boston", "MA", "02110", "US", "home")]
    r = contacts(spark, [
        {"source": "linkedin", "first_name": "Ann", "last_name": "Lee", "company": "Acme", "emails": [email("ann@acme.example", "work")], "notes": "tai chi class"},
        {"source": "gmail", "first_name": "Ann", "last_name": "Lee", "phones": [("4155552671", "home", "12")], "addresses": home},
        {"source": "gmail", "first_name": "Bob", "last_name": "Ray", "emails": [email("not-an-address")]},
    ])
    assert r.lineage.count() == 3
    flat = {x["full_name"]: x for x in r.flattened.collect()}
    assert flat["Ann Lee"]["work_email"] == "ann@acme.example" and flat["Ann Lee"]["home_phone"] == "+14155552671x12"
    assert flat["Ann Lee"]["home_address"] == "1 Main St, Boston, MA, 02110, US"
    v = reports.validate(r.contacts, r.flattened)
    scores = {x["full_name"]: x for x in v.collect()}
    assert scores["Ann Lee"]["quality_score"] == 100 and scores["Bob Ray"]["quality_score"] == 0
    c = reports.confidence(r.contacts, v, r.flattened)
    assert {x["full_name"]: x["confidence_bucket"] for x in c.collect()}["Bob Ray"] == "low"
    s = reports.confidence_summary(c).collect()
    assert [x["bucket"] for x in s] == ["very_high", "high", "medium", "low"] and sum(x["count"] for x in s) == 2
    notes = reports.notes_blob(r.lineage, pipeline.notes_of(records(spark, [{"source": "linkedin", "notes": "tai chi class"}])))
    t = {x["full_name"]: x for x in reports.tag(c, notes, cfg.Tagging(prior_companies=("acme",), local_cities=("boston",))).collect()}
    assert t["Ann Lee"]["tags"] == "local_south_shore|martial_arts|work_colleague" and t["Ann Lee"]["relationship_category"] == "personal"
    assert reports.rejected_values(r.merged, "invalid_emails").collect()[0]["value"] == "not-an-address"
    assert reports.coverage(v).collect()[0]["has_any_phone_pct"] == 50.0


def test_email_dedupe_keeps_the_local_part_and_best_label(spark):
    rows = [{"source": "gmail", "first_name": "A", "last_name": "B", "emails": [email("x@X.example"), email("x@x.example", "work"), email("SECOND@x.example", "home"), email("second@x.example")]}]
    out = normalize(records(spark, rows)).select("emails").first()["emails"]
    assert [(e["value"], e["label"]) for e in out] == [("x@x.example", "work"), ("SECOND@x.example", "home"), ("second@x.example", "")]


def test_address_dedupe_keeps_label(spark):
    a = ("", "", "1 Main St", "Boston", "Massachusetts", "02110", "usa", "")
    rows = [{"source": "gmail", "first_name": "A", "last_name": "B", "addresses": [a, a[:-1] + ("home",)]}]
    out = normalize(records(spark, rows)).select("addresses").first()["addresses"]
    assert len(out) == 1 and out[0]["label"] == "home" and out[0]["state"] == "MA" and out[0]["country"] == "US"


def test_phone_forms(spark):
    df = spark.createDataFrame([("(415) 555-2671",), ("1-415-555-2671",), ("+44 20 7946 0958",), ("abc",)], "p string")
    assert [r[0] for r in df.select(channels.phone_e164(F.col("p"))).collect()] == ["+14155552671", "+14155552671", "+442079460958", "abc"]
    vals = spark.createDataFrame([("415-555-2671 ext 12 ::: 415 555 9999;77",)], "p string").select(channels.phone_values(F.col("p")).alias("v")).first()["v"]
    assert [(v["value"], v["extension"]) for v in vals] == [("415-555-2671", "12"), ("415 555 9999", "77")]


def test_name_grammar():
    from rolodar.functions.names import Grammar
    from rolodar.functions import fixed

    g = Grammar(fixed.GENERATIONAL, fixed.PROFESSIONAL, fixed.PREFIXES)
    n = g.parse("Dr. Maria van der Berg (Smith), PhD/MBA, Jr")
    assert (n["prefix"], n["first"], n["last"], n["suffix"], n["maiden"], n["professional"]) == ("Dr.", "Maria", "van der Berg", "Jr", "Smith", ["PhD", "MBA"])
    assert g.parse(None)["full"] == ""


def test_vcards(spark, tmp_path):
    f = tmp_path / "cards.vcf"
    f.write_text(
        "BEGIN:VCARD\nVERSION:3.0\nFN:Casey Example\nN:Example;Casey;;;\nNICKNAME:Case\nitem1.EMAIL;type=INTERNET;type=WORK;type=pref:casey@work.example\n"
        "EMAIL;type=INTERNET:casey@home.example\nTEL;type=CELL;type=VOICE;type=pref:+1 415 555 0100\nTEL;type=VOICE:415-555-0101 x7\n"
        "ADR;type=HOME:;;1 Main\n  St;Boston;MA;02110;USA\nORG:Acme;Lab\nNOTE:plays\\, kung fu\nEND:VCARD\nBEGIN:VCARD\nFN:Second Card\nEND:VCARD\n"
    )
    rows = files.read_vcards(spark, str(f)).orderBy("source_row_id").collect()
    assert [r["source_row_id"] for r in rows] == ["0", "1"]
    a = rows[0]
    assert a["nickname"] == "Case" and a["first_name"] == "Casey" and a["company"] == "Acme" and a["notes"].startswith("plays")
    assert [e["label"] for e in a["emails"]] == ["work", "other"]
    assert [(p["label"], p["extension"]) for p in a["phones"]] == [("cell", ""), ("voice", "7")]
    assert a["addresses"][0]["street"] == "1 Main St" and a["addresses"][0]["label"] == "home"


def test_csv_sources_and_missing_files(spark, tmp_path):
    li = tmp_path / "net.csv"
    li.write_text('Notes:\n"some, noise"\nFirst Name,Last Name,URL,Email Address,Company,Position,Connected On\nAnn,Lee,https://www.linkedin.com/in/a,ann@x.example,Acme,Boss,04 Aug 2016\nBob,Ray,https://elsewhere.example/b,,,,\n')
    r = {x["first_name"]: x for x in files.read_linkedin(spark, str(li)).collect()}
    assert r["Ann"]["linkedin_url"] and r["Ann"]["emails"][0]["label"] == "home" and r["Ann"]["source_timestamp"] == "2016-08-04T00:00:00"
    assert r["Bob"]["linkedin_url"] == "" and r["Bob"]["source_row_id"] == "1"
    g = tmp_path / "web.csv"
    g.write_text('First Name,Nickname,E-mail 1 - Label,E-mail 1 - Value,Phone 1 - Label,Phone 1 - Value,Address 1 - Label,Address 1 - Street\nAnn,Annie,* Work,a@x.example ::: b@x.example,Mobile,415-555-2671 x12,Home,"1 Main St\nBoston, MA 02110"\n')
    x = files.read_gmail(spark, str(g)).first()
    assert x["nickname"] == "Annie" and [(e["value"], e["label"]) for e in x["emails"]] == [("a@x.example", "work"), ("b@x.example", "work")]
    assert [(p["label"], p["extension"]) for p in x["phones"]] == [("mobile", "12")]
    assert (x["addresses"][0]["street"], x["addresses"][0]["city"], x["addresses"][0]["state"]) == ("1 Main St", "Boston", "MA")
    assert files.read_gmail(spark, str(tmp_path / "none.csv")).count() == 0
    out = pipeline.run(spark, cfg.load(None, inputs__linkedin_csv=str(li), inputs__gmail_csv=str(g), outputs__dir=str(tmp_path / "out")))
    assert files.read_stage_csv(spark, out["consolidated_contacts"]).count() == 3
    # A stored stage is resumed on its own, with a deliverability table and in one file.
    dead = tmp_path / "domains.csv"
    dead.write_text("domain,deliverable\nx.example,false\n")
    config = cfg.load(None, inputs__linkedin_csv=str(li), inputs__deliverability_csv=str(dead), normalization__email_dns_mx_check=True, outputs__dir=str(tmp_path / "out"), outputs__single_files=True)
    out = pipeline.run(spark, config)
    emails = {r["first_name"]: r["emails"] for r in files.read_stage_csv(spark, out["consolidated_contacts"]).collect()}
    assert emails["Ann"] == "ann@x.example::invalid"
    for stage, name, rows in (("validate", "coverage_metrics", 1), ("confidence", "confidence_metrics", 1), ("tag", "referral_targets", 2), ("insights", "top_referrals", 2)):
        assert files.read_stage_csv(spark, pipeline.resume(spark, config, stage)[name]).count() == rows


def test_several_files_keep_their_rows_apart(spark, tmp_path):
    for name, who in (("a", ["Ann", "Bob"]), ("b", ["Cy"])):
        (tmp_path / f"net_{name}.csv").write_text("Notes:\nx\nFirst Name,Last Name,URL,Email Address,Company,Position,Connected On\n" + "".join(f'{w},"Lee, Jr\n",,,,,\n' for w in who))
        (tmp_path / f"c_{name}.vcf").write_text("".join(f"BEGIN:VCARD\nFN:{w} Ray\nEND:VCARD\n" for w in who))
    net = files.read_linkedin(spark, str(tmp_path / "net_*.csv"))
    cards = files.read_vcards(spark, str(tmp_path / "c_*.vcf"))
    got = [(r["source_row_id"], r["first_name"]) for r in net.orderBy("rec_idx").collect()]
    assert got == [("net_a.csv:0", "Ann"), ("net_a.csv:1", "Bob"), ("net_b.csv:0", "Cy")]
    assert [r["source_row_id"] for r in cards.orderBy("rec_idx").collect()] == ["c_a.vcf:0", "c_a.vcf:1", "c_b.vcf:0"]
    both = files.union_sources(net, cards)
    assert [r["source"] for r in both.orderBy("rec_idx").collect()] == ["linkedin"] * 3 + ["mac_vcf"] * 3 and both.select("rec_idx").distinct().count() == 6


def test_json_round_trip(spark):
    rows = records(spark, [{"source": "gmail", "first_name": " Ann ", "emails": [email(" a@x.example ", "work ")]}])
    from rolodar import schema

    back = schema.from_json(schema.to_json(rows)).first()
    assert back["first_name"] == "Ann" and back["emails"][0]["value"] == "a@x.example" and back["rec_idx"] == rows.first()["rec_idx"]
    assert schema.from_json(spark.createDataFrame([("{broken",), (None,)], "record string")).count() == 2


def test_flattened_view_drops_blank_ids_and_keeps_the_last(spark):
    v = spark.createDataFrame([("a", "1"), ("", "2"), (None, "3"), ("a", "4")], "contact_id string, work_email string").coalesce(1)
    assert [(r[0], r[1]) for r in reports.view(v).collect()] == [("a", "4")]


def test_phones_of_another_country(spark):
    df = spark.createDataFrame([("030 1234567",), ("+1 415 555 2671",), ("49 30 12345678",)], "p string")
    assert [r[0] for r in df.select(channels.phone_e164(F.col("p"), "DE")).collect()] == ["+49301234567", "+14155552671", "+493012345678"]


def test_address_lines():
    a = files.arrange_address({"street": "12 Elm Road\nSuite 5\nBoston, MA 02110\nUnited States", "city": "", "state": "", "postal_code": "", "country": ""})
    assert (a["street"], a["city"], a["state"], a["postal_code"], a["country"]) == ("12 Elm Road, Suite 5", "Boston", "MA", "02110", "United States")
    assert files.arrange_address({"street": "1 Main St", "city": "X"}) == {"street": "1 Main St", "city": "X"}


def test_name_pieces_follow_the_rules():
    from rolodar.functions.names import Grammar, split_name
    from rolodar.functions import fixed

    g = Grammar(fixed.GENERATIONAL, fixed.PROFESSIONAL, fixed.PREFIXES)
    # Hyphens part names, a title behind a comma stays a title, only the first bracket counts.
    n = g.parse("Mary-Jane Smith-Jones")
    assert (n["first"], n["middle"], n["last"]) == ("Mary", "Jane Smith", "Jones")
    assert (g.parse("Jane Doe, MS")["prefix"], g.parse("Jane Doe, MS")["professional"]) == ("MS", [])
    assert g.parse("Ann (Lee) Ray (Poe)")["maiden"] == "Lee"
    assert g.parse("Ann Ray PhD/foo")["professional"] == [] and g.parse("Ann Ray PhD/MBA")["professional"] == ["PhD", "MBA"]
    assert split_name("Ann de la Cruz") == ("Ann", "", "de la Cruz") and split_name("Ann L. Cruz") == ("Ann", "L.", "Cruz")


def test_config_zero_overrides(tmp_path):
    f = tmp_path / "c.yaml"
    f.write_text("dedupe:\n  merge_score_threshold: 1.5\nunknown: {a: 1}\n")
    assert cfg.load(str(f)).dedupe.merge_score_threshold == 1.5
    assert cfg.load(str(f), dedupe__merge_score_threshold=0.0).dedupe.merge_score_threshold == 0.0
