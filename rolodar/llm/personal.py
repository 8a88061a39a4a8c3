"""Personal information inside free text: bootstrapped contextual extraction.

1. One pass finds candidates - what may be a mailbox, number, identity number, address or name - each with its layout
   (the way it is written) and the words on either side. A candidate is no finding yet.
2. Seeds are the few candidates that are proven without any context: mailboxes written plainly, numbers with country
   code or brackets, two strict identity-number layouts, streets with the whole word for their type, boxes in full, and
   names whose given and family name both stand in structured columns.
3. Seeds induce patterns: the one or two words before, the words after, and layouts. In every round Spark scores the
   graph of patterns and instances - the share of believed ones among the instances of a pattern that are known, where
   the seeds of another kind and names that the structured columns do not know speak against it - and believes the
   instances of high-scoring patterns, which score further patterns in the next round. Contexts so prove layouts,
   layouts prove contexts, and both find identifiers that no seed or list holds ("Ask for Xyz Abc").

Instances with equal evidence fold into classes before the rounds, so these cost by different evidence, not by rows.
Given names come as a Bloom filter of fixed size, which only says where a name in small letters may begin; what is
known is decided by joins with whole vocabularies. Nothing is capped.

Defined results: null and empty texts have no items; positions count characters from 1; overlapping readings of one
name keep the better one; repeated rows give their own items; empty tables give no rows; with few texts there are few
seeds, and the rounds find less beside them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolodar.llm import names
from rolodar.llm.places import TYPE_OF, TYPES
from rolodar.llm.plaintext import plain
from rolodar.runtime import cut

_I = re.IGNORECASE
_DOT = r"(?: dot | ?\(dot\) ?| ?\[dot\] ?|\.)"
_DOM = r"[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,}"
EMAIL = [
    re.compile(r"(?<![\w.+-])[\w.+%-]*\w\s?(?:@|\(at\)|\[at\])\s?" + _DOM),
    re.compile(r"(?<![\w.+-])[\w.+%-]*\w\s(?:@|\(at\)|\[at\])\s" + _DOM, _I),
    re.compile(r"(?<![\w.+-])[\w+%-]+(?:" + _DOT + r"[\w+%-]+)*(?: at | ?\(at\) ?| ?\[at\] ?)[\w-]+(?:" + _DOT + r"[^\W_][\w-]*)*" + _DOT + r"[^\W\d_]{2,}", _I),
]
_SEP = r"(?:[-.‑–  ]| / )"
_B, _E = r"(?<![\w+#$€/.-])", r"(?:(?=[xX]\d{1,6}(?!\w))|(?![\w-]|[./]\d))"
PHONE = [
    re.compile(_B + r"(?:\+?1[-.‑ ]?)?\(\d{3}\)[-.‑ ]?\d{3}[-.‑ ]?\d{4}" + _E),
    re.compile(_B + r"(?:\+?1[-.‑ ])?\d{3}" + _SEP + r"\d{3}" + _SEP + r"\d{4}" + _E),
    re.compile(r"(?<![\w+])\+1\d{10}" + _E),
    re.compile(_B + r"[2-9]\d{9}" + _E),
    re.compile(_B + r"\d{3}(?: \d){7}" + _E),
    re.compile(r"(?<![\w+/.-])(?:\+44|0044|0)[ -]?7\d{3}[ -]?\d{3}[ -]?\d{3}" + _E),
    re.compile(r"(?<![\w+/.-])(?:\+|00)[1-9]\d{0,2}(?:[ .-]?\(?\d{1,4}\)?){2,5}" + _E),
]
ID_NUMBER = [
    re.compile(_B + r"\d{3}([-‑ .])\d{2}\1\d{4}" + _E),
    re.compile(r"(?<![\w-])[A-Z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-Z](?![\w-])", _I),
    re.compile(r"(?<![\w-])[A-Z]\d{3}-\d{4}-\d{4}" + _E, _I),
    re.compile(r"(?<![\w-])[A-Z]\d{8}(?![\w-])", _I),
    re.compile(_B + r"\d{9}" + _E),
]
_STREET = "|".join(sorted(TYPE_OF, key=len, reverse=True))
_BOX = re.compile(r"(?<![\w-])(?:P\.? ?O\.? ?Box|POB|Post(?:al)? Box|Postfach|Box) ?#?\d+(?![\w-])", _I)
ADDRESS = [
    re.compile(r"(?<![\w$€.-])\d{1,5}[A-Za-z]?,? +(?:(?:N|S|E|W|North|South|East|West)\.? +)?[^\W\d_][\w'’-]*(?: [^\W\d_][\w'’-]*)?? +(?:" + _STREET + r")(?![\w-])", _I),
    _BOX,
]
SHAPES = [("email", EMAIL), ("id_number", ID_NUMBER), ("phone", PHONE), ("street_address", ADDRESS)]
#: What proves a candidate without any context.
SEEDS = {
    "email": re.compile(r"[^\s@()\[\]]+@[^\s@()\[\]]+"),
    "phone": re.compile(r"[+(].*"),
    "id_number": re.compile(r"\d{3}-\d{2}-\d{4}|[A-Z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-Z]"),
    "street_address": re.compile(r"\S+ [A-Z].* (?i:" + "|".join(t for t in TYPES if t != "way") + r")|(?i:P\.? ?O\.? ?Box.*)"),
}
_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*\.?")
_NEAR = re.compile(r"[^\W\d_]+|[^\s\w]|\d+")
# Titles that stand before names and are no part of them.
_TITLES = frozenset("mr mrs ms miss dr prof sir herr frau cc re fw fwd".split())


def _case(word: str) -> str:
    return "upper" if word.isupper() and len(word) > 1 else "title" if word[:1].isupper() else "lower"


def _around(text: str, start: int, end: int) -> tuple[str | None, str | None, str | None]:
    before = [w.lower() for w in _NEAR.findall(text[max(0, start - 40) : start])][-2:]
    after = [w.lower() for w in _NEAR.findall(text[end : end + 30])][:2]
    # A sentence's punctuation says nothing about what follows or precedes it.
    left = before[-1] if before and before[-1].isalpha() else None
    return (" ".join(before) if left else None), left, (" ".join(after) if after and after[0].isalpha() else None)


def layout(kind: str, value: str) -> str:
    """The way a value is written: digits, letters and words by their class."""
    if kind == "street_address":
        ws = re.findall(r"[^\W\d_]+", value.lower())
        if _BOX.fullmatch(value):
            return " ".join(ws)
        return f"{ws[-1]} {_case(value.split(' ', 1)[1].lstrip())}"
    if kind == "email":
        return re.sub(r"[^@()\[\] ]+", lambda m: m.group().lower() if m.group().lower() in ("at", "dot") else "a", value)
    return re.sub(r"\d", "9", re.sub(r"[^\W\d_]", "A", value))


@lru_cache(maxsize=50_000)
def _position(word: str) -> int:
    return int(hashlib.md5(word.encode("utf-8", "surrogatepass")).hexdigest()[:8], 16) % Bloom.SIZE


class Bloom:
    """Words by one hash into a bit array of fixed size: no false "absent"."""

    SIZE = 1 << 22

    def __init__(self, positions: np.ndarray) -> None:
        self.bits = np.zeros(self.SIZE, dtype=bool)
        self.bits[positions] = True

    def __contains__(self, word: str) -> bool:
        return bool(self.bits[_position(word)])


def find(text: str, givens) -> list[tuple]:
    """(kind, start, size, slot, seed, layout, given name, family name, left two words, left word, right words) of all
    candidates."""
    out: list[tuple] = []
    rest = text
    for kind, shapes in SHAPES:
        for regex in shapes:
            for m in regex.finditer(rest):
                a, b = m.span()
                seed = SEEDS[kind].fullmatch(m.group()) is not None
                out.append((kind, a + 1, b - a, a, seed, layout(kind, m.group()), None, None, *_around(text, a, b)))
            rest = regex.sub(lambda m: "\x00" * len(m.group()), rest)

    def name(start: int, stop: int, slot: int, order: str, given: str, last: str) -> None:
        out.append(("person_name", start + 1, stop - start, slot, False, order, given, last, *_around(text, start, stop)))

    ws = [(m.group(), m.start(), m.end()) for m in _WORD.finditer(rest)]
    for i, (w, a, _) in enumerate(ws):
        bare = w.rstrip(".")
        p = plain(bare)
        case = _case(bare)
        if p in _TITLES or len(bare) < 2:
            continue
        # Given name, perhaps an initial, family name - in one case, with nothing but blanks between.
        j = i + 1
        gap_ok = j < len(ws) and rest[ws[i][2] : ws[j][1]].strip(" ") == "" and not w.endswith(".")
        if gap_ok and len(ws[j][0].rstrip(".")) == 1 and j + 1 < len(ws) and rest[ws[j][2] : ws[j + 1][1]].strip(" ") == "":
            j += 1
        if gap_ok:
            last = ws[j][0].rstrip(".")
            if len(last) >= 3 and case == _case(last) and (case == "title" or p in givens):
                name(a, ws[j][1] + len(last), a, case, p, plain(last))
        # Family name, comma, given name.
        if i and rest[ws[i - 1][2] : a].strip(" ") == "," and not ws[i - 1][0].endswith(".") and p in givens:
            last, la, _ = ws[i - 1]
            if _case(last) == case and len(last) >= 3:
                name(la, a + len(bare), a, f"{case} reversed", p, plain(last))
    return out


def candidates(df: DataFrame, key: str, text: str, givens) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(givens)
    columns = ["id", "kind", "start_at", "size", "slot", "seed", "layout", "given", "last", "left2", "left1", "right"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for pdf in batches:
            rows = [(k, *c) for k, t in zip(pdf.iloc[:, 0], pdf.iloc[:, 1], strict=True) if t for c in find(t, known)]
            yield pd.DataFrame(rows, columns=columns)

    kind = dict(df.dtypes)[key]
    schema = f"id {kind}, kind string, start_at int, size int, slot int, seed boolean, layout string, given string, last string, left2 string, left1 string, right string"
    return df.where(F.trim(F.col(text)) != "").select(key, text).mapInPandas(run, schema)


def vocabulary(df: DataFrame, columns: list[str], word: str) -> DataFrame:
    """word: all distinct plain values of structured columns."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({word: sorted({plain(x).strip() for x in pdf.iloc[:, 0] if x})})

    cells = df.select(F.explode(F.array(*[F.col(c) for c in columns])).alias("w")).where("trim(w) <> ''").distinct()
    return cells.mapInPandas(run, f"{word} string").distinct()


def bloom(words: DataFrame, word: str, more: frozenset[str]) -> Bloom:
    """The filter of a vocabulary: at most ``Bloom.SIZE`` positions reach the driver, however long the vocabulary is."""
    at = words.select((F.conv(F.substring(F.md5(word), 1, 8), 16, 10).cast("long") % Bloom.SIZE).cast("int").alias("p")).distinct()
    own = [_position(w) for w in more]
    return Bloom(np.concatenate([at.toPandas()["p"].to_numpy(dtype=np.int64), np.array(own, dtype=np.int64)]))


#: How far a pattern of each sort can be believed.
WEIGHTS = {"left2": 0.9, "left1": 0.45, "right": 0.8, "layout": 0.8}
SEED_BELIEF = 0.95


def believe(classes: DataFrame, rounds: int) -> DataFrame:
    """class, belief of evidence classes (class, kind, n, seed, known, layout, left2, left1, right) after some rounds."""
    sorts = F.array(*[F.struct(F.lit(p).alias("sort"), F.lit(w).alias("weight"), F.col(p).alias("pattern")) for p, w in WEIGHTS.items()])
    edges = classes.select("class", "kind", "n", F.explode(sorts).alias("e")).select("class", "kind", "n", "e.*").where("pattern is not null")
    edges = cut(edges)
    first = F.when(F.col("seed"), F.lit(SEED_BELIEF)).otherwise(F.lit(0.0))
    start = classes.select("class", first.alias("first"), F.col("known").alias("given"), first.alias("belief"), first.alias("by_context"), "known", F.col("known").alias("told"))
    now = start
    for _ in range(rounds):
        # Layouts are scored by what contexts believe, not by what they made be believed themselves.
        told = edges.join(now.where("known").select("class", "belief", "by_context", "told"), "class").where("sort <> 'layout' or told")
        belief = F.when(F.col("sort") == "layout", F.col("by_context")).otherwise(F.col("belief"))
        by_kind = told.groupBy("sort", "pattern", "kind").agg(F.sum(F.col("n") * belief).alias("hits"), F.sum("n").alias("seen"))
        # What is believed to be of another kind speaks against the pattern; layouts belong to one kind anyway.
        every = by_kind.groupBy("sort", "pattern").agg(F.sum("hits").alias("all_hits"))
        scores = by_kind.join(every, ["sort", "pattern"]).withColumn(
            "score", F.col("hits") / (F.col("seen") + F.when(F.col("sort") == "layout", 0.0).otherwise(F.col("all_hits") - F.col("hits")) + 1)
        )
        reached = edges.join(scores.select("sort", "pattern", "kind", "score"), ["sort", "pattern", "kind"])
        # Only patterns that mostly lead to instances speak for a candidate.
        doubt = F.when(F.col("score") > 0.5, 1 - F.col("score") * F.col("weight")).otherwise(F.lit(1.0))
        context = F.when(F.col("sort") == "layout", 1.0).otherwise(doubt)
        # A context that leads to believed and other instances alike tells nothing about a layout.
        clear = (F.col("weight") >= 0.8) & (F.col("sort") != "layout") & ~F.col("score").between(0.1, 0.5)
        felt = reached.groupBy("class").agg(F.product(doubt).alias("doubt"), F.product(context).alias("context_doubt"), F.max(F.col("weight") >= 0.8).alias("felt"), F.max(clear).alias("context_felt"))
        now = start.select("class", "first", "given").join(felt, "class", "left")
        believed = lambda c: 1 - (1 - F.col("first")) * F.coalesce(c, F.lit(1.0))
        now = cut(now.select(
            "class", "first", "given", believed("doubt").alias("belief"), believed("context_doubt").alias("by_context"),
            (F.col("given") | F.coalesce("felt", F.lit(False))).alias("known"), (F.col("given") | F.coalesce("context_felt", F.lit(False))).alias("told"),
        ))
    return now.select("class", "belief")


def extract(
    df: DataFrame, key: str, text: str, lexicon: DataFrame, given_columns: list[str], family_column: str, rounds: int = 3, threshold: float = 0.5
) -> DataFrame:
    """key, kind, start_at, size, confidence of every item."""
    givens = cut(vocabulary(lexicon, given_columns, "given"))
    found = candidates(df, key, text, bloom(givens, "given", frozenset(names.ROOTS)))
    usual = df.sparkSession.createDataFrame([(n,) for n in sorted(names.ROOTS)], "given string")
    known_given = givens.union(usual).distinct().withColumn("is_given", F.lit(True))
    known_family = vocabulary(lexicon, [family_column], "last").withColumn("is_family", F.lit(True))
    found = found.join(known_given, "given", "left").join(known_family, "last", "left")
    person = F.col("kind") == "person_name"
    is_given, is_family = F.col("is_given").isNotNull(), F.col("is_family").isNotNull()
    # Small letters, capitals and a comma make a name only around a known given name.
    found = found.where(~person | is_given | (F.col("layout") == "title"))
    # Two capitalised words say nothing by themselves; an unknown name must be found by its contexts.
    named = F.when(is_given, F.concat("layout", F.lit(" given")))
    evidence = ["kind", "seed", "known", "layout", "left2", "left1", "right"]
    found = found.select(
        "id", "kind", "start_at", "size", "slot", (F.col("seed") | (person & is_given & is_family)).alias("seed"), (F.col("seed") | person).alias("known"),
        F.when(person, named).otherwise(F.col("layout")).alias("layout"), "left2", "left1", "right",
    )
    found = cut(found.withColumn("class", F.md5(F.concat_ws("\x01", *[F.coalesce(F.col(e).cast("string"), F.lit("\x00")) for e in evidence]))))
    classes = cut(found.groupBy("class", *evidence).agg(F.count("*").cast("double").alias("n")))
    beliefs = believe(classes, rounds).where(F.col("belief") >= threshold)
    kept = found.select("class", "id", "kind", "start_at", "size", "slot").join(beliefs, "class")
    # Two readings of one name: the more believable one, then the earlier.
    best = kept.groupBy("id", "kind", "slot").agg(F.max(F.struct("belief", (-F.col("start_at")).alias("at"), "size")).alias("b"))
    return best.select(
        F.col("id").alias(key), "kind", (-F.col("b.at")).cast("int").alias("start_at"), F.col("b.size").alias("size"), F.round("b.belief", 4).alias("confidence")
    )


PLACEHOLDERS = {"email": "[EMAIL]", "phone": "[PHONE]", "id_number": "[ID]", "street_address": "[ADDRESS]", "person_name": "[NAME]"}


def redact(df: DataFrame, key: str, text: str, items: DataFrame) -> DataFrame:
    """key, text with typed placeholders; rows without items keep their text, nulls stay null."""
    spans = items.groupBy(key).agg(F.collect_list(F.struct("start_at", "size", "kind")).alias("spans"))
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = []
            for t, found in zip(pdf.iloc[:, 1], pdf.iloc[:, 2], strict=True):
                if t is not None and found is not None:
                    end = len(t) + 1
                    for s in sorted(found, key=lambda x: (-x["start_at"], -x["size"])):
                        stop = min(s["start_at"] - 1 + s["size"], end)
                        t = t[: s["start_at"] - 1] + PLACEHOLDERS[s["kind"]] + t[stop:]
                        end = s["start_at"] - 1
                texts.append(t)
            yield pd.DataFrame({key: pdf.iloc[:, 0], text: texts})

    return df.select(key, text).join(spans, key, "left").mapInPandas(run, f"`{key}` {kind}, `{text}` string")
