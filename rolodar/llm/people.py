"""Variant spellings of names typed by people, linked within address books.

Block by phonetic codes of the name's words (any order, nicknames by their roots), compare blocked pairs with
Jaro-Winkler plus the nickname table, cluster the accepted pairs by connected components.

* A pair needs one word in common as the family name and another as the given name, whatever their order; each may
  carry a slip (Jaro-Winkler of at least ``threshold`` or one slip of the keyboard). Two spellings are two names, however
  close, if the rarer one is too frequent for a slip of the other: the lower bound of its number exceeds ``SLIPS`` of the
  other's. The test is the same at every size of the corpus.
* Generational suffixes are a hard veto: they are part of the block's key.
* Entries with only an initial as given name join afterwards, if all people it may stand for are one component.

Entries of a book with equal parts fold into one spelling first, and spellings are compared, not entries. A pair is
met under the smallest code it shares, so nothing is deduplicated by a shuffle; before it reaches Python it must share
a second code or another close word (JVM expressions), which most relatives do not. Blocks are books times codes; the
pairs of a component are formed once, at the end.

Defined results: nulls and blanks are missing parts; names without any word pair with nothing; entries with a null
book belong to no book; equal spellings pair; middle initials do not matter; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolodar.llm import names
from rolodar.operators.graph import connected_components
from rolodar.runtime import cut

_PARTS = "words array<string>, firsts array<string>, initials array<string>, suffix string, codes array<string>"


def codes(p: names.Person) -> list[str]:
    """Phonetic codes of all words; given names under every root they may stand for."""
    out = set()
    for w in {*p.words, *p.firsts}:
        out |= {names.phonetic(r) for r in names.slip_roots(w) | {w}}
    if len(p.words) == 1 and not p.firsts:
        # Typed without its blank: any given name it may begin or end with.
        w = p.words[0]
        out |= {names.phonetic(r) for n in range(3, len(w) - 2) for part in (w[:n], w[n:]) if part in names.ROOTS for r in names.roots(part)}
    return sorted(out)


def parse_entries(df: DataFrame, key: str, book: str, full: str, first: str, nickname: str) -> DataFrame:
    types = dict(df.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for k, b, f, g, n in pdf.itertuples(index=False, name=None):
                p = names.parse(f, g, n)
                rows.append((k, b, *p, codes(p)))
            yield pd.DataFrame(rows, columns=["id", "book", "words", "firsts", "initials", "suffix", "codes"])

    return df.where(F.col(book).isNotNull()).select(key, book, full, first, nickname).mapInPandas(
        run, f"id {types[key]}, book {types[book]}, {_PARTS}"
    )


#: A slip of a name is at most this share of the name's own number.
SLIPS = 1 / 20


def too_frequent(n: int, other: int) -> bool:
    """Whether ``n`` is more than slips of something that occurs ``other`` times can explain (by its lower bound)."""
    return n - 2 * n**0.5 > SLIPS * other


def _same(a: str, b: str, na: int, nb: int, threshold: float) -> bool:
    if a == b:
        return True
    if too_frequent(min(na, nb), max(na, nb)):
        return False
    return min(len(a), len(b)) >= 4 and (names.one_slip(a, b) or names.jaro_winkler(a, b) >= threshold)


class Side(NamedTuple):
    """One spelling: words, further given names, initials, and the corpus-wide number of each word."""

    words: list[str]
    firsts: list[str]
    initials: list[str]
    counts: dict[str, int]


@lru_cache(maxsize=20_000)
def read_side(text: str) -> Side:
    """A spelling from its packed text."""
    words, firsts, initials, numbers = (part.split(" ") if part else [] for part in text.split("|"))
    return Side(words, firsts, initials, dict(zip(dict.fromkeys(words + firsts), map(int, numbers))))


def compare(a: Side, b: Side, threshold: float, known: dict[str, int]) -> str:
    """'yes', 'initial' (the given name is only an initial on one side) or ''. ``known``: numbers of the known names."""
    ca, cb = a.counts, b.counts

    def same(x: str, y: str) -> bool:
        return _same(x, y, ca.get(x, 1), cb.get(y, 1), threshold)

    def given_roots(w: str, n: int) -> frozenset[str]:
        # A spelling that is too common for a slip of the names near it is a name of its own.
        near = names.near_names(w)
        return names.slip_roots(w) if not any(too_frequent(n, known.get(x, 0)) for x in near) else names.roots(w)

    def given(x: str, y: str) -> bool:
        return same(x, y) or bool(given_roots(x, ca.get(x, 1)) & given_roots(y, cb.get(y, 1)))

    weak = ""
    for i, x in enumerate(a.words):
        for j, y in enumerate(b.words):
            if not same(x, y):
                continue
            rest_a = [w for k, w in enumerate(a.words) if k != i]
            rest_b = [w for k, w in enumerate(b.words) if k != j]
            ga = rest_a or [w for w in a.firsts if w != x]
            gb = rest_b or [w for w in b.firsts if w != y]
            if ga and gb:
                if any(given(u, v) for u in ga for v in gb):
                    return "yes"
                # A nickname kept in a field of its own may stand for either.
                if rest_a and rest_b and any(names.nickname_equal(u, v) for u in rest_a for v in b.firsts if v not in b.words) and any(
                    names.nickname_equal(u, v) for u in rest_b for v in b.firsts
                ):
                    return "yes"
            elif ga and not gb and any(u[0] in b.initials for u in ga):
                weak = "initial"
            elif gb and not ga and any(u[0] in a.initials for u in gb):
                weak = "initial"
            elif not ga and not gb and set(a.initials) & set(b.initials):
                weak = "initial"
    # One side was typed without its blank.
    for p, q in ((a, b), (b, a)):
        if len(p.words) == 1 and len(q.words) >= 2:
            w = p.words[0]
            for f in {*q.words, *q.firsts}:
                for last in q.words:
                    if f != last and (names.one_slip(w, f + last) or names.one_slip(w, last + f)):
                        return "yes"
    if len(a.words) == 1 and len(b.words) == 1 and len(a.words[0]) >= 10 and names.one_slip(a.words[0], b.words[0]):
        return "yes"
    return weak


def spellings(parsed: DataFrame) -> DataFrame:
    """id (smallest entry), book, suffix, words, firsts, codes, side: every spelling of a book once, with the corpus-wide
    numbers of its words packed into ``side``."""
    parts = ["book", "suffix", "words", "firsts", "initials", "codes"]
    folded = parsed.groupBy(*parts).agg(F.min("id").alias("id"), F.count("*").alias("n"))
    folded = cut(folded.withColumn("all", F.array_distinct(F.concat("words", "firsts"))))
    spoken = folded.select("id", "n", F.posexplode("all").alias("pos", "w"))
    counts = spoken.groupBy("w").agg(F.sum("n").alias("total"))
    told = spoken.join(counts, "w").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "total"))).alias("told"))
    numbers = F.array_join(F.transform("told", lambda x: x["total"].cast("string")), " ")
    side = F.concat_ws("|", F.array_join("words", " "), F.array_join("firsts", " "), F.array_join("initials", " "), numbers)
    return folded.join(told, "id").select("id", "book", "suffix", "words", "firsts", "codes", side.alias("side"))


def known_numbers(parsed: DataFrame) -> dict[str, int]:
    """How often the names of the fixed nickname table occur (at most one number for each of them)."""
    spoken = parsed.select(F.explode(F.array_union("words", "firsts")).alias("w")).where(F.col("w").isin(sorted(names.ROOTS)))
    return {r["w"]: r["n"] for r in spoken.groupBy("w").agg(F.count("*").alias("n")).collect()}


def _close(x: Column, y: Column) -> Column:
    """Whether two lists hold different words that are at most two letters apart."""
    near = lambda u, v: (u != v) & (F.levenshtein(u, v, 2) >= 0)
    return F.exists(x, lambda u: F.exists(y, lambda v: near(u, v)))


def links(parsed: DataFrame, threshold: float = 0.93) -> DataFrame:
    """id_1, id_2, kind of all accepted pairs of different spellings."""
    known = known_numbers(parsed)
    rows = cut(spellings(parsed))
    coded = rows.select("id", "book", "suffix", "words", "firsts", "codes", "side", F.explode("codes").alias("code"))
    left = coded.select("book", "suffix", "code", *[F.col(c).alias(f"{c}_1") for c in ("id", "words", "firsts", "codes", "side")])
    right = coded.select("book", "suffix", "code", *[F.col(c).alias(f"{c}_2") for c in ("id", "words", "firsts", "codes", "side")])
    shared = F.array_intersect("codes_1", "codes_2")
    pairs = left.join(right, ["book", "suffix", "code"]).where((F.col("id_1") < F.col("id_2")) & (F.col("code") == F.array_min(shared)))
    lone = (F.size("words_1") < 2) | (F.size("words_2") < 2)
    pairs = pairs.where(lone | (F.size(shared) > 1) | _close(F.concat("words_1", "firsts_1"), F.concat("words_2", "firsts_2")))
    kind = dict(parsed.dtypes)["id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for i, j, p, q in pdf.itertuples(index=False, name=None):
                verdict = compare(read_side(p), read_side(q), threshold, known)
                if verdict:
                    out.append((i, j, verdict))
            yield pd.DataFrame(out, columns=["id_1", "id_2", "kind"])

    return pairs.select("id_1", "id_2", "side_1", "side_2").mapInPandas(run, f"id_1 {kind}, id_2 {kind}, kind string")


def people(df: DataFrame, key: str, book: str, full: str, first: str, nickname: str, threshold: float = 0.93) -> DataFrame:
    """key, person (smallest key of the component): entries that pair with no other are left out."""
    parsed = cut(parse_entries(df, key, book, full, first, nickname))
    found = cut(links(parsed, threshold))
    sure = connected_components(found.where("kind = 'yes'"), "id_1", "id_2")
    weak = found.where("kind = 'initial'")
    both = weak.select("id_1", "id_2").union(weak.select("id_2", "id_1")).toDF("x", "y")
    both = both.join(sure.toDF("y", "py"), "y", "left").withColumn("py", F.coalesce("py", "y"))
    # An initial may only join if everything it may stand for is one person.
    targets = both.groupBy("x").agg(F.min("py").alias("lo"), F.max("py").alias("hi"))
    # Only sides whose whole component agrees; an initial is seldom in a component of its own.
    joined = targets.where("lo = hi and x <> lo").join(sure.select(F.col("node").alias("x")), "x", "left_anti").select("x", "lo")
    # Entries of one spelling are one person.
    parts = [F.col(c) for c in ("book", "suffix", "words", "firsts", "initials", "codes")]
    same = parsed.select("id", F.md5(F.to_json(F.struct(*parts))).alias("same"))
    firsts = same.groupBy("same").agg(F.min("id").alias("low"), F.count("*").alias("n"))
    copies = same.join(firsts.where("n > 1"), "same").where("id <> low and same is not null").select("low", "id")
    named = parsed.where(F.size("codes") > 0).select("id")
    edges = sure.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    merged = connected_components(edges.union(joined).union(copies.join(named, "id", "left_semi").select("low", "id")), "a", "b")
    return merged.select(F.col("node").alias(key), F.col("component").alias("person"))
