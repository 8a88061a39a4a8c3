"""Survivors, addresses, people and cross-source matches: cases, hostile input, brute force."""

import itertools

import pytest
from pyspark.sql import functions as F

from rolodar.llm import addresses, crossmatch, names, people, places, survivors


def test_survivors_against_brute_force(spark):
    rows = [(i, f"c{i % 3}" if i % 7 else None, ["gmail", "linkedin", "mac_vcf", "other"][i % 4], [None, 5, 9, 9][(i // 2) % 4], "v" if i % 5 else " ") for i in range(40)]
    rows += [(100, "solo", "gmail", 1, "v"), (101, " ", "gmail", 1, "v"), (102, " ", "gmail", 1, "v")]
    df = spark.createDataFrame(rows, "rec_id long, contact_id string, source string, at long, company string")
    got = {(r["contact_id"], r["rec_id"]) for r in survivors.winners(df, "contact_id", "rec_id", "source", "at", [survivors.Bundle("company", ("company",), F.trim("company") != "")]).collect()}
    order = {"linkedin": 0, "mac_vcf": 1, "gmail": 2}
    want = set()
    for g in ("c0", "c1", "c2"):
        m = [r for r in rows if r[1] == g and r[4].strip()]
        want.add((g, min(m, key=lambda r: (r[3] is None, -(r[3] or 0), order.get(r[2], 3), r[0]))[0]))
    assert got == want
    assert survivors.winners(df.limit(0), "contact_id", "rec_id", "source", "at", [survivors.Bundle("company", ("company",), F.trim("company") != "")]).count() == 0


def test_bundles_keep_dependencies(spark):
    rows = [
        (1, "g", "gmail", 10_000_000, "name A", "url A"),
        (2, "g", "gmail", 20_000_000, "name B", ""),
        (3, "g", "gmail", 15_000_000, "name C", "url C"),
        (4, "h", "gmail", 10_000_000, "name A", "url A"),
        (5, "h", "gmail", 20_000_000, "name A", ""),
    ]
    df = spark.createDataFrame(rows, "rec_id long, contact_id string, source string, at long, name string, url string")
    bundles = [survivors.Bundle("name", ("name",), F.col("name") != ""), survivors.Bundle("url", ("url",), F.col("url") != "")]
    out = survivors.choose_bundles(df, "contact_id", "rec_id", "source", "at", bundles, [("url", "name")]).collect()
    got = {(r["contact_id"], r["bundle"]): r["rec_id"] for r in out}
    # The newest name has no profile; name C with its own profile is worth more than name B alone.
    assert got == {("g", "name"): 3, ("g", "url"): 3, ("h", "name"): 5, ("h", "url"): 4}


def test_bundles_keep_untimed_rows_of_broken_groups(spark):
    rows = [
        (1, "g", "gmail", 10_000_000, "name A", "url A", ""),
        (2, "g", "gmail", 20_000_000, "name B", "", ""),
        (3, "g", "gmail", None, "", "", "job"),  # the only job stands on a row without an instant
        (4, "h", "gmail", -10_000_000, "name A", "url A", ""),  # before 1970
        (5, "h", "gmail", -5_000_000, "name B", "", "job"),
    ]
    df = spark.createDataFrame(rows, "rec_id long, contact_id string, source string, at long, name string, url string, job string")
    bundles = [survivors.Bundle(n, (n,), F.col(n) != "") for n in ("name", "url", "job")]
    out = survivors.choose_bundles(df, "contact_id", "rec_id", "source", "at", bundles, [("url", "name")]).collect()
    got = {(r["contact_id"], r["bundle"]): r["rec_id"] for r in out}
    assert got == {("g", "name"): 1, ("g", "url"): 1, ("g", "job"): 3, ("h", "name"): 4, ("h", "url"): 4, ("h", "job"): 5}


def test_bundles_against_brute_force(spark):
    """All choices of bundle values of small groups; the greatest sum of trust that breaks no dependency wins."""
    import random

    rng = random.Random(4)
    rows = []
    for g in range(25):
        for i in range(rng.randrange(2, 6)):
            pick = lambda p, n: rng.choice([f"{n}{k}" for k in range(3)]) if rng.random() < p else ""
            rows.append((len(rows), f"g{g}", "gmail", rng.choice([None, *range(1_000_000, 90_000_000, 7_000_000)]), pick(0.8, "n"), pick(0.7, "u"), pick(0.6, "m")))
    df = spark.createDataFrame(rows, "rec_id long, contact_id string, source string, at long, name string, url string, mail string")
    bundles = [survivors.Bundle(n, (n,), F.col(n) != "") for n in ("name", "url", "mail")]
    deps = [("url", "name"), ("mail", "url")]
    got: dict = {}
    for r in survivors.choose_bundles(df, "contact_id", "rec_id", "source", "at", bundles, deps).collect():
        got.setdefault(r["contact_id"], {})[r["bundle"]] = r["rec_id"]
    weights = {r["rec_id"]: r["w"] for r in df.select("rec_id", survivors.weight(F.col("at"), F.col("source")).alias("w")).collect()}
    names_ = ["name", "url", "mail"]
    for g in {r[1] for r in rows}:
        mine = [r for r in rows if r[1] == g]
        value = lambda r, n: r[4 + names_.index(n)]

        def allowed(chosen):
            for a, b in deps:
                if a in chosen and b in chosen:
                    left = [r for r in mine if value(r, a) == chosen[a] and value(r, b)]
                    if left and not any(value(r, b) == chosen[b] for r in left):
                        return False
            return True

        best = 0.0
        for combo in itertools.product(*[[None, *{value(r, n) for r in mine if value(r, n)}] for n in names_]):
            chosen = {n: v for n, v in zip(names_, combo) if v}
            if allowed(chosen):
                best = max(best, sum(max(weights[r[0]] for r in mine if value(r, n) == v) for n, v in chosen.items()))
        found = {n: value(next(r for r in mine if r[0] == k), n) for n, k in got.get(g, {}).items()}
        assert allowed(found) and abs(sum(weights[k] for k in got.get(g, {}).values()) - best) < 1e-6


P = ["street", "city", "state", "postal_code", "po_box", "extended_address"]


def located(spark, rows):
    df = spark.createDataFrame([(i, *r, "x") for i, r in enumerate(rows)], "address_id long, " + ", ".join(f"{c} string" for c in P) + ", location string")
    return {(r[0], r[1]) for r in addresses.pairs(addresses.locate(df, "address_id"), "address_id", "location").collect()}


def test_addresses(spark):
    filler = [(f"{n} Harborholhead Street", "Springfield", "IL", "62701", "", "") for n in range(500, 512)]
    rows = [
        ("12 North Main Rd., Apt 4B", "Springfield", "Illinois", "62701", "", ""),  # 0
        ("Apartment 4B, 12 N. Main Road\nSpringfield, IL 62701-1234", "", "", "", None, None),  # 1 = 0
        ("N MAIN RD 12", "Springfeld", "I.L.", "", "", "#4B"),  # 2 = 0
        ("12 South Main Road, Apt 4B", "Springfield", "IL", "62701", "", ""),  # 3 other direction
        ("12 N Main Road Apt 5B", "Springfield", "IL", "62701", "", ""),  # 4 other unit
        ("13 N Main Road Apt 4B", "Springfield", "IL", "62701", "", ""),  # 5 other number
        ("12 N Main Lane Apt 4B", "Springfield", "IL", "62701", "", ""),  # 6 other type
        ("12 N Main Road Apt 4B", "Shelbyville", "IL", "62565", "", ""),  # 7 other city
        ("PO Box 77", "Springfield", "IL", "62701", "", ""),  # 8
        ("", "Springfield", "IL", "62701", "P.O. Box 77", ""),  # 9 = 8
        ("501 Harborhollhead St", "Springfield", "IL", "62701", "", ""),  # 10 = filler 501
        ("501 Harborholhead", "Springfield", "", "62701", "", ""),  # 11 = filler 501, type missing
        ("", "", "", "", "", ""),
        (None, None, None, None, None, None),
    ] + filler
    got = located(spark, rows)
    base = 14
    same = [(0, 1), (0, 2), (1, 2), (8, 9), (10, 11), (10, base + 1), (11, base + 1)]
    assert got == set(same)
    assert located(spark, []) == set()


def test_assignment_against_brute_force():
    import random

    rng = random.Random(8)

    def plain_distance(a, b):
        d = {(i, j): i + j for i in range(len(a) + 1) for j in range(len(b) + 1) if not i * j}
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
        return d[len(a), len(b)]

    for _ in range(400):
        a, b = (["".join(rng.choice("ab") for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(1, 4))] for _ in range(2))
        if len(a) > len(b):
            a, b = b, a
        whole = plain_distance("".join(a), "".join(b))
        want = min([sum(plain_distance(x, y) for x, y in zip(a, p)) + sum(map(len, b)) - sum(len(y) for y in p) for p in itertools.permutations(b, len(a))] + [whole])
        assert places.assignment(a, b, 2) == min(want, 3)


def test_streets_of_one_block(spark):
    rows = [
        ("7 Hill Oakton Street", "Springfield", "IL", "62701", "", ""), ("7 Oakton Hill St", "Springfield", "IL", "62701", "", ""),  # words in another order
        ("9 Pebblekorland Ave", "Springfield", "IL", "62701", "", ""), ("9 Pebbleorlaand Ave", "Springfield", "IL", "62701", "", ""),  # two slips of a third
        ("9 Maple Ave", "Springfield", "IL", "62701", "", ""), ("8 Pebblekorland Ave", "Springfield", "IL", "62701", "", ""),
    ] + [(f"{n} {s} Road", "Springfield", "IL", "62701", "", "") for n in range(20, 40) for s in ("Northfall Mill", "Northfell Mill")]
    # Two frequent names, however close, are two streets.
    assert located(spark, rows) == {(0, 1), (2, 3)}


def test_places_hostile():
    for s in (None, "", "\x00", "," * 5000, "1" * 3000, "é́🙂 Street", "Box"):
        assert isinstance(places.parse(s, s, s, s, s, s), places.Place)


def paired(spark, rows):
    df = spark.createDataFrame([(i, *r, "x") for i, r in enumerate(rows)], "entry_id long, book_id long, full_name_raw string, first_name string, nickname string, person string")
    return {(r[0], r[1]) for r in addresses.pairs(people.people(df, "entry_id", "book_id", "full_name_raw", "first_name", "nickname"), "entry_id", "person").collect()}


def test_people(spark):
    rows = [
        (1, "Dr. Philip (Pip) Felquietti", "Philip", ""),  # 0
        (1, "felquietti, philip b.", "", None),  # 1
        (1, "Phillip Felquieti CPA", "", ""),  # 2
        (1, "P. Felquietti", "", ""),  # 3 an initial
        (1, "PhilipFelquietti", "Philip", ""),  # 4
        (1, "Leonard Felquietti", "", ""),  # 5 a relative
        (1, "Daniel Rolk Jr.", "", ""),  # 6
        (1, "Daniel Rolk, sr", "", ""),  # 7
        (1, "Rolk, Daniel, Jr", "", ""),  # 8
        (2, "Philip Felquietti", "", ""),  # 9 another book
        (None, "Philip Felquietti", "", ""), (1, "", "", ""), (1, None, None, None), (1, "🙂" * 300, "", ""),
    ]
    got = paired(spark, rows)
    group = {0, 1, 2, 3, 4}
    assert got == set(itertools.combinations(sorted(group), 2)) | {(6, 8)}
    assert paired(spark, []) == set()


def test_people_find_the_same_links_in_many_books(spark):
    """Slips that become frequent only because there are more books stay slips."""
    book = [("Henry Rolkowick", "Henry"), ("Henru Rolkowick", "Henru"), ("Hank Rolkowick", ""), ("Susan Pelmoski", ""), ("Susam Pelmoski", ""), ("Pelmoski, Sue Jr", ""), ("SUSAN PELMOSKI JR.", "")]
    few = [(b, f, g, "") for b in range(2) for f, g in book]
    many = [(b, f, g, "") for b in range(60) for f, g in book]
    for rows in (few, many):
        # Common names are common in proportion.
        rows = rows + [(1000 + i, f"{n} Otherman", n, "") for n in ("Henry", "Susan") for i in range(25 * len(rows) // 7)]
        got = {(a, b) for a, b in paired(spark, rows) if a < 14}
        assert got == {(x + d, y + d) for d in (0, 7) for x, y in ((0, 1), (0, 2), (1, 2), (3, 4), (5, 6))}


def test_too_frequent_for_a_slip():
    assert not people.too_frequent(1, 1) and not people.too_frequent(5, 100) and not people.too_frequent(50, 1000)
    assert people.too_frequent(30, 100) and people.too_frequent(300, 1000)


@pytest.mark.parametrize(("a", "b", "near"), [("rebecca", "rebbecca", True), ("harold", "harokd", True), ("katarzyna", "katrazyna", True), ("anna", "hanna", True), ("bob", "rob", True), ("daniel", "danielle", False)])
def test_one_slip(a, b, near):
    assert names.one_slip(a, b) is near and names.one_slip(b, a) is near


def test_cross_sources(spark):
    net = [
        (1, "Ignacio Kalenić", "ignacio.k@helm.example", "", "Helm Optics"), (2, "Susan Ray", "", "(200) 555-0001", ""), (3, "Susan Ray", "", "", ""),
        (4, "Bob Lee", "office@acme.example", "", ""), (5, "Ann Poe", "", "+1 200 555 0009", ""), (6, "Lee Chan", "", "", "The Bluewater Foods Group"),
        (7, None, None, None, None), (8, "Mo Varu", "shared@x.example", "", ""),
    ]
    card = [
        (101, "KALENIC, NACHO", "IGNACIO.K@HELM.EXAMPLE; other@x.example", "", "Else"), (102, "Sue Ray", "", "200-555-0001", ""), (103, "Susan Ray", "", "", "Nowhere"),
        (104, "Bob Lee", "office@acme.example", "", ""), (105, "Tom Poe", "", "2005550009", ""), (106, "Lee Chan", "", "", "Bluewater-Foods, Inc."),
        (107, "", "", "", ""), (108, "Mo Varu", "shared@x.example", "", ""), (109, "Dee Else", "shared@x.example", "", ""),
    ]
    cols = "full_name string, emails string, phones string, company string"
    n, c = spark.createDataFrame(net, f"net_id long, {cols}"), spark.createDataFrame(card, f"card_id long, {cols}")
    out = crossmatch.match(n, c, "net_id", "card_id").collect()
    # A name alone, a desk's mailbox, another person's number and a shared mailbox prove nothing.
    assert {(r["net_id"], r["card_id"]) for r in out} == {(1, 101), (2, 102), (6, 106)}
    assert all(0 <= r["confidence"] <= 1 for r in out)
    assert crossmatch.match(n.limit(0), c, "net_id", "card_id").count() == 0


def test_cross_sources_retrieve_slips_and_reject_rivals(spark):
    base = [(i, f"Person{chr(97 + i % 20)}x Family{chr(97 + i % 17)}y", f"own{i}@x.example", "", f"Firm {i % 5}") for i in range(40)]
    net = base + [(100, "Henry Plvibach", "", "", "Noxxia Brewing"), (101, "Mo Varu", "", "2005550100", ""), (102, "A. Tern", "", "", "Acme"), (103, "Ida Holm", "one@x.example", "", "")]
    card = [(k + 1000, n, m, p, c) for k, n, m, p, c in base] + [
        (2100, "Henry Pelvibach", "", "", "Noxxia Brewing"), (2101, "Mo Varu", "", "2005550100", ""), (2102, "Mo Varu", "", "200 555 0100", "Else"),  # twice on one side
        (2103, "Anna Tern", "", "", "Acme"), (2104, "Adam Tern", "", "", "Acme"),  # an initial that may mean either
        (2105, "Ida Holm", "two@x.example", "", ""),
    ]
    cols = "full_name string, emails string, phones string, company string"
    n, c = spark.createDataFrame(net, f"net_id long, {cols}"), spark.createDataFrame(card, f"card_id long, {cols}")
    got = {(r["net_id"], r["card_id"]) for r in crossmatch.match(n, c, "net_id", "card_id").collect()}
    assert got == {(i, i + 1000) for i in range(40)} | {(100, 2100), (101, 2101), (101, 2102)}


def test_retrieval_is_exact_above_the_bound(spark):
    """Every pair of the full cross product whose score exceeds the query's bound is retrieved."""
    import random

    rng = random.Random(9)
    firsts, lasts, firms = ["ann", "bob", "carl", "dora"], ["lee", "poe", "rolk"], ["acme", "helm", ""]

    def rows(n):
        out = []
        for i in range(n):
            mails = f"m{rng.randrange(12)}@x.example" if rng.random() < 0.5 else ""
            out.append((i, f"{rng.choice(firsts)} {rng.choice(lasts)}", mails, "", rng.choice(firms)))
        return spark.createDataFrame(out, "id long, n string, m string, p string, c string")

    parsed = [crossmatch.parse_records(rows(30), "id", "n", "m", "p", "c") for _ in range(2)]
    both = parsed[0].withColumn("side", F.lit("a")).unionByName(parsed[1].withColumn("side", F.lit("b")))
    both = both.withColumn("initial", F.when(F.col("root") != "", F.substring("root", 1, 1)).otherwise(F.substring("first", 1, 1)))
    both = crossmatch.index(crossmatch.with_terms(both)).cache()
    left, right = both.where("side = 'a'"), both.where("side = 'b'")
    found = {(r["a"], r["b"]) for r in crossmatch.retrieve(left, right).collect()}
    cards = {r["id"]: {t["term"] for t in r["weights"]} for r in right.collect()}
    wanted = set()
    for r in left.collect():
        singles = sorted((t["w"] for t in r["weights"] if not t["essential"]), reverse=True)
        for k, terms in cards.items():
            if sum(t["w"] for t in r["weights"] if t["term"] in terms) > sum(singles[:2]) + 1e-9:
                wanted.add((r["id"], k))
    assert wanted and wanted <= found


def test_cross_sources_do_not_lose_cases_among_many_rows(spark):
    base = [(i, f"Person{chr(97 + i % 20)}x Family{chr(97 + i % 17)}y", f"own{i}@x.example", "", f"Firm {i % 5}") for i in range(40)]
    # Two firms of one slip's distance from a third spelling, both established.
    base += [(200 + i, f"Person{chr(97 + i)}x Lumily", "", "", ["Lumwick Foods", "Lumfick Foods"][i % 2]) for i in range(12)]
    net = base + [
        (300, "Ida Holm", "", "", "Lumick Foods"), (301, "R. Varu", "r@x.example", "", ""), (304, "Ola Berg", "", "", "Huxmar Energy"),
        (302, "Ann Stern", "", "2005550100", "Acme"), (303, "Ann Stern", "a1@x.example, a2@x.example", "", "Helm Marine"),
    ]
    card = [(k + 1000, n, m, p, c) for k, n, m, p, c in base] + [
        (1300, "Ida Holm", "", "", "Lumwick Foods"),  # its slip may mean either firm
        (1301, "R. Varu", "r@x.example", "", "Else"), (1401, "K. Varu", "k@x.example", "", ""), (1304, "Ola Berg", "", "", "Huxuma Energy"),  # own mailbox, only initials
        # A common number proves 302, though a namesake at either row's employer scores higher on both sides.
        (1302, "Ann Stern", "", "200 555 0100, 2005550101", "Helm Marine"), (1303, "Ann Stern", "", "", "Acme"),
    ]
    cols = "full_name string, emails string, phones string, company string"
    n, c = spark.createDataFrame(net, f"net_id long, {cols}"), spark.createDataFrame(card, f"card_id long, {cols}")
    got = {(r["net_id"], r["card_id"]) for r in crossmatch.match(n, c, "net_id", "card_id").collect()}
    assert {(300, 1300), (301, 1301), (302, 1302)} <= got and not {(301, 1401), (304, 1304)} & got
