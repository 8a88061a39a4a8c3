"""Same postal address written differently: which rows denote one location.

1. ``places.parse`` brings every row into parts, wherever they stand (one Arrow pass); equal parts fold into classes, so
   a place with very many rows costs one class per spelling from there on.
2. Blocks: a missing city is the city of its postal code, so codes and neighbouring codes of one city form one locality;
   city names with a slip take over their well-established neighbour. A block is a locality with house and box number,
   direction and unit - the hard vetoes, none of which is ever compared.
3. Deletion-neighbourhood index inside the blocks that hold several streets: spellings at most two slips apart share a
   string with letters deleted (of their ends, if they are long), be it of the words as they stand or in order of the
   alphabet.
4. Optimal component assignment decides such pairs: the least total distance over all assignments of one street's words
   to the other's. Two names that are both too frequent in the corpus for slips of each other stay two streets.
   Connected components of the accepted pairs are the streets of a block; a missing street type is its only one.

Shuffles are keyed by spelling or by block; the index holds spellings of crowded blocks, not rows. Pairs come from one
self join on the location.

Defined results: nulls and blanks are missing parts; rows with neither a house number with street nor a box number are
no location; a mistyped postal code does not matter where the city is given; identical rows pair; ties between two
neighbours leave a city's spelling as it is; extra columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rolodar.llm import places
from rolodar.operators.graph import connected_components
from rolodar.runtime import cut

PARTS = ["street", "city", "state", "postal_code", "po_box", "extended_address"]
_FIELDS = list(places.Place._fields)
_KEYS = [f for f in _FIELDS if f != "words"]
#: A slip of a street's name is at most this share of the name's own number.
SLIPS = 1 / 20


def parse_parts(df: DataFrame, key: str) -> DataFrame:
    """key and the parts of ``places.Place``."""
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            values = pdf[PARTS].astype(object).where(pdf[PARTS].notna(), None)
            parts = [places.parse(*row) for row in values.itertuples(index=False, name=None)]
            out = pd.DataFrame(parts, columns=_FIELDS, dtype=str)
            out.insert(0, key, pdf[key].to_numpy())
            yield out

    schema = f"`{key}` {kind}, " + ", ".join(f"`{f}` string" for f in _FIELDS)
    return df.select(key, *PARTS).mapInPandas(run, schema)


def deletions(text: Column) -> Column:
    """The text and all texts with one letter less."""
    cut_out = F.transform(
        F.sequence(F.lit(1), F.length(text)), lambda i: F.concat(F.substring(text, F.lit(1), i - 1), F.substring(text, i + 1, F.length(text)))
    )
    return F.when(F.length(text) >= 4, F.array_distinct(F.array_append(cut_out, text))).otherwise(F.array(text))


def neighbourhood(text: Column) -> Column:
    """Hashes that two texts at most two letters apart share. Long texts post the deletions of their first and of their
    last four letters, one of which holds at most one of the two slips; short ones their own with two letters deleted."""
    tagged = lambda tag, part: F.transform(deletions(part), lambda d: F.xxhash64(F.lit(tag), d))
    ends = F.concat(tagged("begins", F.left(text, F.lit(4))), tagged("ends", F.right(text, F.lit(4))))
    twice = F.transform(F.array_distinct(F.flatten(F.transform(deletions(text), deletions))), lambda d: F.xxhash64(F.lit("whole"), d))
    none = F.array().cast("array<bigint>")
    return F.concat(F.when(F.length(text) >= 8, ends).otherwise(none), F.when(F.length(text) <= 9, twice).otherwise(none))


def established(spellings: DataFrame, value: str, block: list[str] | None = None, ratio: int = 5, others: bool = False) -> DataFrame:
    """[block,] value, canon: the established neighbour that a rare spelling takes over, where there is exactly one
    best. ``spellings`` holds each value (per block) once, with its number ``n``. With ``others`` also the spellings
    without a best one (``canon`` is null), and the array ``others`` of all further spellings at one slip's distance that are not rarer."""
    block = block or []
    rows = spellings.where(F.length(value) > 0)
    variants = rows.select(*block, F.col(value).alias("v"), "n", F.explode(deletions(F.col(value))).alias("d"))
    left, right = variants.alias("l"), variants.alias("r")
    on = (F.col("l.d") == F.col("r.d")) & (F.col("l.v") != F.col("r.v")) & (F.col("r.n") >= (1 if others else ratio) * F.col("l.n"))
    for b in block:
        on = on & (F.col(f"l.{b}") == F.col(f"r.{b}"))
    near = left.join(right, on).select(*[F.col(f"l.{b}").alias(b) for b in block], F.col("l.v").alias("v"), F.col("r.v").alias("c"), "l.n", F.col("r.n").alias("m")).distinct()
    strong = F.col("m") >= ratio * F.col("n")
    letters = lambda c: F.array_sort(F.split(c, ""))
    # Neighbours share what is left without a letter of each; two places may differ then.
    slip = F.lit(others) & ((F.levenshtein("v", "c") <= 1) | (letters("v") == letters("c")))
    best = near.groupBy(*block, "v").agg(F.max(F.when(strong, F.struct("m", "c"))).alias("top"), F.collect_list(F.when(strong, F.col("m"))).alias("ms"), F.collect_list(F.when(slip, F.col("c"))).alias("cs"))
    clear = F.size(F.filter(F.col("ms"), lambda x: x * 2 > F.col("top.m"))) == 1
    if others:
        canon = F.when(clear, F.col("top.c"))
        return best.select(*block, F.col("v").alias(value), canon.alias("canon"), F.filter("cs", lambda c: ~c.eqNullSafe(canon)).alias("others"))
    return best.where(clear).select(*block, F.col("v").alias(value), F.col("top.c").alias("canon"))


def _apply(df: DataFrame, canon: DataFrame, value: str) -> DataFrame:
    out = df.join(canon, value, "left")
    return out.withColumn(value, F.coalesce("canon", value)).drop("canon")


@F.pandas_udf(T.IntegerType())
def _assigned(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([places.assignment(x.split(" "), y.split(" "), 2) for x, y in zip(a, b, strict=True)], dtype="int32")


def streets(in_block: DataFrame, corpus: DataFrame) -> DataFrame:
    """street, canon: the spellings of crowded blocks (``street`` names block and line) that are one street with others,
    with the one that stands for all. ``in_block``: street, place, line, words, n; ``corpus``: line, n_corpus."""
    crowded = in_block.groupBy("place").agg(F.count("*").alias("k")).where("k > 1").select("place")
    rows = cut(in_block.where("line <> ''").join(crowded, "place").join(corpus, "line"))
    ordered = F.array_join(F.array_sort(F.split("words", " ")), "")
    keys = F.array_distinct(F.flatten(F.transform(F.array_distinct(F.array("line", ordered)), neighbourhood)))
    posted = rows.select("place", "street", F.explode(keys).alias("d"))
    left, right = posted.select("place", "d", F.col("street").alias("s1")), posted.select("place", "d", F.col("street").alias("s2"))
    met = left.join(right, ["place", "d"]).where("s1 < s2").select("s1", "s2").distinct()
    side = lambda i: rows.select(F.col("street").alias(f"s{i}"), F.col("words").alias(f"w{i}"), F.col("line").alias(f"l{i}"), F.col("n_corpus").alias(f"n{i}"))
    met = met.join(side(1), "s1").join(side(2), "s2")
    low, high = F.least("n1", "n2"), F.greatest("n1", "n2")
    two_names = low - 2 * F.sqrt(low) > SLIPS * high
    most = F.when(F.least(F.length("l1"), F.length("l2")) >= 8, 2).otherwise(1)
    same = met.where(~two_names).withColumn("cost", _assigned("w1", "w2")).where(F.col("cost") <= most)
    return connected_components(same, "s1", "s2").toDF("street", "canon")


def locate(df: DataFrame, key: str) -> DataFrame:
    """key, location: rows of one location share the value."""
    same = F.md5(F.concat_ws("\u001f", *_KEYS))
    rows = parse_parts(df, key).where(((F.col("number") != "") & (F.col("line") != "")) | (F.col("box") != ""))
    rows = cut(rows.withColumn("class", same))
    # Cut wherever a frame is used more than once: plans stay small, and nothing is computed twice.
    classes = cut(rows.groupBy("class", *_KEYS).agg(F.count("*").alias("n"), F.max("words").alias("words")))
    cities = cut(classes.groupBy("city").agg(F.sum("n").alias("n")))
    classes = cut(_apply(classes, established(cities, "city"), "city"))

    # City and state of every postal code, and state of every city, by majority.
    def majority(by: str, of: str) -> DataFrame:
        votes = classes.where((F.col(by) != "") & (F.col(of) != "")).groupBy(by, of).agg(F.sum("n").alias("n"))
        return votes.groupBy(by).agg(F.max_by(of, F.struct("n", of)).alias(f"{by}_{of}"))

    full = classes.join(majority("zip", "city"), "zip", "left").join(majority("zip", "state"), "zip", "left")
    full = full.withColumn("city", F.when(F.col("city") != "", F.col("city")).otherwise(F.coalesce("zip_city", F.concat(F.lit("zip "), "zip"))))
    full = full.join(majority("city", "state"), "city", "left")
    state = F.when(F.col("state") != "", F.col("state")).otherwise(F.coalesce("city_state", "zip_state", F.lit("")))
    place = F.md5(F.concat_ws("\u001f", "city", state, "number", "direction", "unit", "box"))
    full = full.select("class", place.alias("place"), "line", "words", "kind", "n")
    full = cut(full.withColumn("street", F.md5(F.concat_ws("\u001f", "place", "line"))))

    # Slips of street names inside a block; how common a name is in the corpus guards streets with similar names.
    corpus = full.groupBy("line").agg(F.sum("n").alias("n_corpus"))
    in_block = full.groupBy("street", "place", "line").agg(F.sum("n").alias("n"), F.max("words").alias("words"))
    fixes = streets(in_block, corpus)
    full = cut(full.select("class", "street", "kind").join(fixes, "street", "left").select("class", F.coalesce("canon", "street").alias("street"), "kind"))

    # A missing type is the street's only one.
    kinds = full.where("kind <> ''").groupBy("street").agg(F.min("kind").alias("k1"), F.max("kind").alias("k2"))
    full = full.join(kinds, "street", "left")
    kind = F.when((F.col("kind") == "") & (F.col("k1") == F.col("k2")), F.col("k1")).otherwise(F.col("kind"))
    located = full.select("class", F.md5(F.concat_ws("\u001f", "street", kind)).alias("location"))
    return rows.select(key, "class").join(located, "class").select(key, "location")


def pairs(members: DataFrame, key: str, group: str) -> DataFrame:
    """<key>_1 < <key>_2 of all rows that share a group (one self join; skewed groups are split by AQE)."""
    m = members.select(key, group)
    several = m.groupBy(group).agg(F.count("*").alias("n")).where("n > 1").select(group)
    m = m.join(several, group)
    left, right = m.select(F.col(key).alias(f"{key}_1"), group), m.select(F.col(key).alias(f"{key}_2"), group)
    return left.join(right, group).where(F.col(f"{key}_1") < F.col(f"{key}_2")).select(f"{key}_1", f"{key}_2")
