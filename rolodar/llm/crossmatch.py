"""Matching entities across two sources without keys: inverted-index BM25, mutual nearest, calibrated confidence.

Attributes become terms in one spelling (given name by its root, family name and company by their established
spelling, mailboxes, numbers by their digits, and the conjunction of the three names by sound). The index holds the
card side's terms with BM25 weights: inverse document frequency times the field's boost, and the record's length.

1. Retrieval: every row of the net side is a query. All cards whose score exceeds the query's bound are found, and only
   postings of essential terms are read for it (``retrieve`` states the bound). Hot terms - a family name that a tenth of
   all rows have, a huge employer, a switchboard - are never expanded.
2. Nearest test: a pair is nearest on both sides, or on one (a person may stand twice on the other). All rows that an own
   mailbox or number and the name prove to be a row's person are its nearest alike, as a namesake at the same employer
   refutes none of them, however well it scores.
3. Confidence: a logistic calibration of score and gap, fitted on retrieved pairs that a common own mailbox or number
   proves against namesakes and retrieved pairs whose names differ; at most ``max_fit`` of each, a documented bound. The
   gap is a share of the best score, because scores grow with the logarithm of the tables.
4. An exact check of the evidence follows: agreeing names, and an own mailbox, an own number or the employer.

All steps are keyed joins and aggregations.

Defined results: nulls and blanks are missing attributes; records without a family name match nothing; repeated rows
match like their copies; extra columns are ignored; empty tables give no rows; of equal scores all are nearest.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rolodar.llm import names
from rolodar.llm.addresses import established
from rolodar.llm.plaintext import plain
from rolodar.runtime import cut

# Legal forms and fillers of company names; local parts that name a desk, not a person.
_LEGAL = frozenset("inc incorporated ltd limited llc llp gmbh co corp corporation company group the ag plc sa sl bv kg holding holdings".split())
ROLES = ("office info hello contact kontakt sales support admin mail team service post hr jobs billing accounts help enquiries reception webmaster "
         "marketing noreply no-reply").split()  # fmt: skip
_MAIL = re.compile(r"[^\s;,|:<>\"()/]+@[^\s;,|:<>\"()/]+\.[^\s;,|:<>\"()/.]+")
_PHONE = re.compile(r"(?<!\d)\+?\d[\d ().\-]{7,16}\d(?!\d)")
K1, B = 1.2, 0.75
#: Boost of the terms that are evidence: own mailboxes and numbers, and a whole name with its employer.
BOOST = 3.0


def company_key(text: str | None) -> str:
    ws = re.findall(r"[a-z0-9]+", plain(text or ""))
    kept = [w for w in ws if w not in _LEGAL]
    return "".join(kept or ws)


def mailboxes(text: str | None) -> list[str]:
    return sorted({m.lower().strip(".") for m in _MAIL.findall(text or "")})


def numbers(text: str | None) -> list[str]:
    out = set()
    for m in _PHONE.findall(text or ""):
        d = re.sub(r"\D", "", m)
        out.add(d[-10:] if len(d) >= 10 else d)
    return sorted(d for d in out if len(d) >= 7)


def parse_records(df: DataFrame, key: str, name: str, emails: str, phones: str, company: str) -> DataFrame:
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for k, n, e, p, c in pdf.itertuples(index=False, name=None):
                person = names.parse(n)
                ws = person.words
                last = ws[-1] if ws else ""
                given = ws[0] if len(ws) > 1 else ""
                first = given or (person.initials[0] if person.initials else "")
                root = sorted(names.slip_roots(given))[0] if given else ""
                rows.append((k, root, first, last, person.suffix, names.phonetic(root), names.phonetic(last), mailboxes(e), numbers(p), company_key(c)))
            yield pd.DataFrame(rows, columns=["id", "root", "first", "last", "suffix", "sound_root", "sound_last", "mails", "phones", "company"])

    texts = "root string, first string, last string, suffix string, sound_root string, sound_last string"
    schema = f"id {kind}, {texts}, mails array<string>, phones array<string>, company string"
    parsed = df.select(key, name, emails, phones, company).mapInPandas(run, schema).where("last <> ''")
    return parsed.withColumns({c: F.array().cast("array<string>") for c in ("near_last", "near_sounds", "near_company")})


@F.pandas_udf(T.StringType())
def _sound(word: pd.Series) -> pd.Series:
    return word.map(names.phonetic)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _sounds(words: pd.Series) -> pd.Series:
    return words.map(lambda ws: sorted({names.phonetic(w) for w in ws}))


def canonical(rows: DataFrame) -> DataFrame:
    """One spelling for given-name roots, family names and companies of the stacked sides: one dictionary of distinct
    spellings, one deletion-neighbourhood join on it, and look-ups of the slips only. A spelling may be near
    several family names or companies - the more, the larger the dictionary; ``near_last``, ``near_sounds`` and
    ``near_company`` keep those that it does not take over and that are not rarer, whatever their numbers."""
    columns = ["root", "last", "company"]
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])
    spelled = rows.select(F.explode(cells).alias("s")).where("s.value <> ''").groupBy("s.column", "s.value").agg(F.count("*").alias("n"))
    slips = established(cut(spelled), "value", ["column"], others=True)
    # Known names are no slips of each other.
    known = sorted({r for rs in names.ROOTS.values() for r in rs})
    slips = slips.where((F.col("column") != "root") | ~F.col("value").isin(known))
    slips = cut(slips.withColumn("canon", F.coalesce("canon", "value")).withColumns({"sound": _sound("canon"), "sounds": _sounds("others")}))
    for c in columns:
        rows = rows.join(slips.where(F.col("column") == c).select(F.col("value").alias(c), "canon", "sound", "others", "sounds"), c, "left")
        if c != "company":
            rows = rows.withColumn(f"sound_{c}", F.coalesce("sound", f"sound_{c}"))
        if c != "root":
            rows = rows.withColumn(f"near_{c}", F.coalesce("others", f"near_{c}"))
        if c == "last":
            rows = rows.withColumn("near_sounds", F.coalesce("sounds", "near_sounds"))
        rows = rows.withColumn(c, F.coalesce("canon", c)).drop("canon", "sound", "others", "sounds")
    return rows


def _prefixed(tag: str, values: Column) -> Column:
    return F.transform(values, lambda v: F.concat(F.lit(tag), v))


def with_terms(rows: DataFrame) -> DataFrame:
    """Adds ``length`` and ``terms``: given name, family name, employer, mailboxes, numbers, and ``x:``, the conjunction of the three
    names (by sound), also with the spellings that a slip may stand for. A lone initial meets whole names of the other side and other initials; whole names meet each
    other, so that a frequent family name and a huge employer are never paired by an initial among themselves."""
    single = [
        F.when(F.col("root") != "", F.concat(F.lit("g:"), "root")), F.concat(F.lit("l:"), "last"), F.when(F.col("company") != "", F.concat(F.lit("c:"), "company")),
    ]
    lasts, firms = F.array_append("near_sounds", F.col("sound_last")), F.array_append("near_company", F.col("company"))
    joined = F.flatten(F.transform(lasts, lambda x: F.transform(firms, lambda y: F.concat_ws("|", x, y))))
    works = F.when(F.col("company") != "", joined).otherwise(F.array().cast("array<string>"))
    at_work = lambda tag, first: F.transform(works, lambda w: F.concat_ws("|", tag, first, w))
    whole = F.col("root") != ""
    mine, other = F.concat(F.lit("x:"), "side"), F.concat(F.lit("x:"), F.translate("side", "ab", "ba"))
    both = F.when(whole, at_work(F.lit("x:whole"), F.col("sound_root"))).otherwise(at_work(F.lit("x:short"), F.col("initial")))
    crossed = F.when(whole, at_work(other, F.col("initial"))).otherwise(at_work(mine, F.col("initial")))
    terms = F.concat(F.array_compact(F.array(*single)), both, crossed, _prefixed("m:", F.col("mails")), _prefixed("p:", F.col("phones")))
    # A record is as long as it was written: the other spellings of its employment do not count.
    written = F.size(F.filter("terms", lambda t: ~F.startswith(t, F.lit("x:")))) + F.when(F.col("company") != "", 2).otherwise(0)
    return rows.withColumn("terms", F.array_distinct(terms)).withColumn("length", written)


@F.pandas_udf(T.BooleanType())
def _agree(root: pd.Series, last: pd.Series, top_root: pd.Series, top_last: pd.Series) -> pd.Series:
    """Whether two names may be one person's."""

    def one(r: str, x: str, q: str, y: str) -> bool:
        near = names.one_slip(x, y) or names.jaro_winkler(x, y) >= 0.95
        return near and (r == q or (min(len(r), len(q)) >= 4 and names.one_slip(r, q)))

    return pd.Series([one(*v) for v in zip(root, last, top_root, top_last, strict=True)], dtype=bool)


def owners(postings: DataFrame) -> DataFrame:
    """term: the mailboxes and numbers that belong to one person: every full name on them agrees with the most frequent
    one; where no name is full, every initial and family name. Desks' mailboxes never do."""
    role = F.lower(F.regexp_extract("term", r"^m:([^@]+)@", 1)).isin(ROLES)
    named = postings.where(F.rlike("term", F.lit("^[mp]:")) & ~role)
    spelled = cut(named.groupBy("term", "root", "initial", "last", "suffix").agg(F.count("*").alias("n")))
    most = F.max(F.struct((F.col("root") != "").alias("whole"), "n", "root", "initial", "last", "suffix"))
    top = spelled.groupBy("term").agg(F.count("*").alias("k"), most.alias("t"))
    other = spelled.join(top.where("k > 1"), "term").where("not (root = t.root and initial = t.initial and last = t.last and suffix = t.suffix)")
    # Next to a full name, initials do not judge.
    other = other.where("root <> '' or not t.whole")
    first = F.col("t.whole") | (F.col("initial") == F.col("t.initial"))
    fits = first & (F.col("suffix") == F.col("t.suffix")) & _agree("root", "last", "t.root", "t.last")
    strangers = other.where(~fits).select("term").distinct()
    return top.select("term").join(strangers, "term", "left_anti")


def index(rows: DataFrame) -> DataFrame:
    """The rows with ``weights`` (term, weight, essential) and ``norm`` (BM25's length norm).

    A term weighs its inverse document frequency on the card side times its field's boost; terms that no card has, and
    mailboxes and numbers that several people share, weigh nothing."""
    postings = cut(rows.select("side", "id", "root", "initial", "last", "suffix", F.explode("terms").alias("term")))
    size = rows.where("side = 'b'").agg(F.count("*").alias("n_docs"), F.avg("length").alias("avg_len"))
    df = postings.groupBy("term").agg(F.count_if(F.col("side") == "b").alias("df"))
    own = owners(postings).withColumn("own", F.lit(True))
    # ``size`` is one row.
    stats = df.join(own, "term", "left").crossJoin(F.broadcast(size)).withColumn("own", F.coalesce("own", F.lit(False)))
    idf = F.log((F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1)
    field = F.substring("term", 1, 1)
    essential = F.when(field.isin("m", "p"), F.col("own")).otherwise(field == "x")
    boost = F.when(essential, BOOST).when(field.isin("m", "p"), 0.0).otherwise(1.0)
    stats = stats.select("term", F.when(F.col("df") > 0, idf * boost).otherwise(0.0).alias("w"), essential.alias("essential"))
    weighted = postings.select("side", "id", "term").join(stats, "term")
    weighted = weighted.groupBy("side", "id").agg(F.collect_list(F.struct("term", "w", "essential")).alias("weights"))
    norm = (K1 + 1) / (1 + K1 * (1 - B + B * F.col("length") / F.col("avg_len")))
    return rows.crossJoin(F.broadcast(size)).withColumn("norm", norm).drop("n_docs", "avg_len").join(weighted, ["side", "id"])


def _total(weights: Column) -> Column:
    return F.aggregate(F.transform(weights, lambda t: t["w"]), F.lit(0.0), lambda x, y: x + y)


def retrieve(left: DataFrame, right: DataFrame) -> DataFrame:
    """a, b of all pairs that share an essential posting (once for each).

    Exact pruning: what a card can reach without an essential term of the query is bounded by the query's two heaviest
    names (all three make the conjunction, which is essential); pairs above that bound are wanted, so the long postings
    of single names and employers, and those of shared mailboxes and numbers, are never read."""

    def posted(rows: DataFrame, name: str) -> DataFrame:
        terms = F.transform(F.filter("weights", lambda t: t["essential"] & (t["w"] > 0)), lambda t: t["term"])
        return rows.select(F.col("id").alias(name), F.explode(terms).alias("term"))

    return posted(left, "a").join(posted(right, "b"), "term").select("a", "b")


def namesakes(left: DataFrame, right: DataFrame, most: int) -> DataFrame:
    """a, b of rows with one family name among ``most`` rows of either side (lowest hash first): what chance brings
    together, for the calibration only."""
    some = lambda rows, name: rows.orderBy(F.xxhash64("id"), "id").limit(most).select(F.col("id").alias(name), "last")
    return some(left, "a").join(some(right, "b"), "last").select("a", "b")


def score_pairs(net: DataFrame, card: DataFrame, probes: int = 2_000) -> DataFrame:
    """a, b, evidence, BM25 score, and the gaps to the best partner on either side (as shares of its score), of all pairs
    above the bound; and, marked ``probe``, of some namesakes that were not retrieved."""
    rows = canonical(cut(net.withColumn("side", F.lit("a")).unionByName(card.withColumn("side", F.lit("b")))))
    rows = rows.withColumn("initial", F.when(F.col("root") != "", F.substring("root", 1, 1)).otherwise(F.substring("first", 1, 1)))
    both = cut(index(cut(with_terms(rows))))
    left, right = both.where("side = 'a'"), both.where("side = 'b'")
    record = F.struct("root", "last", "near_last", "initial", "suffix", "company", "sound_root", "sound_last", "weights", "norm")
    wanted = retrieve(left, right).withColumn("probe", F.lit(False)).unionByName(namesakes(left, right, probes).withColumn("probe", F.lit(True)))
    wanted = wanted.groupBy("a", "b").agg(F.min("probe").alias("probe"))
    pairs = wanted.join(left.select(F.col("id").alias("a"), record.alias("ra")), "a")
    pairs = pairs.join(right.select(F.col("id").alias("b"), record.alias("rb")), "b")
    theirs = F.transform("rb.weights", lambda t: t["term"])
    pairs = pairs.withColumn("shared", F.filter("ra.weights", lambda t: F.array_contains(theirs, t["term"])))
    names_of = F.sort_array(F.transform(F.filter("ra.weights", lambda t: ~t["essential"]), lambda t: t["w"]), asc=False)
    bound = F.coalesce(F.get(names_of, F.lit(0)), F.lit(0.0)) + F.coalesce(F.get(names_of, F.lit(1)), F.lit(0.0))
    total = _total(F.col("shared"))
    full = (F.col("ra.root") != "") & (F.col("rb.root") != "")
    proof = F.exists("shared", lambda t: t["essential"] & ~F.startswith(t["term"], F.lit("x:")))
    employer = F.exists("shared", lambda t: F.startswith(t["term"], F.lit("x:")))
    equal = lambda c: F.col(f"ra.{c}") == F.col(f"rb.{c}")
    # Slips that keep the sound may be two letters; all full names on an own mailbox or number have been found to agree.
    close = lambda c: F.levenshtein(f"ra.{c}", f"rb.{c}") <= F.when(equal(f"sound_{c}") | proof, 2).otherwise(1)
    last = close("last") | F.array_contains("ra.near_last", F.col("rb.last")) | F.array_contains("rb.near_last", F.col("ra.last"))
    first = F.when(full, equal("root") | proof | close("root")).otherwise(equal("initial"))
    out = cut(pairs.where((total > bound) | F.col("probe")).select(
        "a", "b", "probe", (total * F.col("rb.norm")).alias("score"), (first & last & equal("suffix")).alias("named"), full.alias("full"), proof.alias("proof"),
        employer.alias("employer"), (equal("root") & equal("last")).alias("same"),
    ))
    real = out.where(~F.col("probe"))
    out = out.join(real.groupBy("a").agg(F.max("score").alias("top_a")), "a", "left").join(real.groupBy("b").agg(F.max("score").alias("top_b")), "b", "left")
    out = out.withColumns({t: F.coalesce(t, "score") for t in ("top_a", "top_b")})
    gap = lambda top: F.when(F.col(top) > F.col("score"), 1 - F.col("score") / F.col(top)).otherwise(0.0)
    return out.withColumns({"gap_a": gap("top_a"), "gap_b": gap("top_b")})


def fit_confidence(pairs: DataFrame, max_fit: int = 20_000) -> tuple[float, float, float]:
    """Intercept and slopes (score, gap) of the logistic calibration: retrieved pairs with a proof and equal names
    against namesakes and pairs whose names differ; at most ``max_fit`` of each (lowest hash first)."""
    found = []
    for kind, y in (("named and proof and same and not probe", 1.0), ("probe or not named", 0.0)):
        rows = pairs.where(kind).orderBy(F.xxhash64("a", "b"), "a", "b").limit(max_fit).select("score", (F.col("gap_a") + F.col("gap_b")).alias("gap"), F.lit(y).alias("y"))
        found.append(rows.toPandas())
    rows = pd.concat(found)
    w = prior = np.array([-4.0, 2.0, -1.0])
    if rows["y"].nunique() == 2:
        x = np.column_stack([np.ones(len(rows)), rows["score"].to_numpy(float) / 10, rows["gap"].to_numpy(float)])
        y = rows["y"].to_numpy(float)
        # Both kinds count alike, however rare one is.
        share = np.where(y > 0, 0.5 / max(1, int(y.sum())), 0.5 / max(1, int((1 - y).sum()))) * min(len(y), 200)
        for _ in range(25):  # Newton steps towards the prior's side of a small ridge
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            h = (x * (share * p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(3)
            w = w + np.linalg.solve(h, x.T @ (share * (y - p)) - 0.5 * (w - prior))
    return float(w[0]), float(w[1]), float(w[2])


def match(
    net: DataFrame, card: DataFrame, net_key: str, card_key: str, name: str = "full_name", emails: str = "emails", phones: str = "phones",
    company: str = "company", threshold: float = 0.5,
) -> DataFrame:
    """net key, card key, score, mutual (each is the other's nearest), confidence; of all matching pairs.

    A pair matches if it is nearest on both sides, or - as a person may stand twice on one side - on one side, and sure
    enough: its confidence, from score and gap, reaches ``threshold``. Proven partners are nearest alike, without a gap.
    The exact check follows: agreeing names, and an own mailbox, an own number or the employer."""
    parsed = [parse_records(df, key, name, emails, phones, company) for df, key in ((net, net_key), (card, card_key))]
    pairs = cut(score_pairs(*parsed))
    b0, b1, b2 = fit_confidence(pairs)
    proven = F.col("named") & F.col("proof")
    gap = F.when(proven, 0.0).otherwise(F.col("gap_a") + F.col("gap_b"))
    z = F.lit(b0) + F.lit(b1) * F.col("score") / 10 + F.lit(b2) * gap
    nearest_a, nearest_b = F.col("gap_a") <= 1e-9, F.col("gap_b") <= 1e-9
    judged = pairs.withColumns({"confidence": 1 / (1 + F.exp(-z)), "mutual": nearest_a & nearest_b})
    seen = judged.where(~F.col("probe") & (proven | nearest_a | nearest_b) & (F.col("confidence") >= threshold) & F.col("named") & (F.col("proof") | F.col("employer")))
    # An initial stands for a person only next to a proof, or where it is nearest to nobody else.
    unsure = seen.where("not full and not proof")
    count_a, count_b = unsure.groupBy("a").agg(F.count("*").alias("na")), unsure.groupBy("b").agg(F.count("*").alias("nb"))
    seen = seen.join(count_a, "a", "left").join(count_b, "b", "left")
    kept = seen.where("full or proof or (mutual and na = 1 and nb = 1)")
    return kept.select(
        F.col("a").alias(net_key), F.col("b").alias(card_key), F.round("score", 4).alias("score"), "mutual", F.round("confidence", 4).alias("confidence")
    )
