"""Abusive, hateful or sexual content: FTRL-proximal logistic regression over hashed n-grams and skip-grams.

A text is scored passage by passage (sentences and lines) and takes its worst passage's probability. Words are put in
a plain spelling first: case, accents, look-alike and invisible letters, digits for letters, stretched letters,
letters set apart by blanks, dots or hyphens. A starred word becomes a word of the small general lexicon with the same
ends and length, if there is one. Features are hashed words, pairs, triples and pairs with one or two words between
them; a lexicon word also counts as its class, alone, with its neighbours, and with another class of its passage.

Labels are per document, so the fit looks for the guilty passages itself: all passages of clean documents are
negative; in an abusive document the passages that the model so far finds worst are positive and the rest undecided.
It starts from the lexicon's prior weights and from features whose log-odds are telling by their lower bound, and
repeats a few rounds. FTRL keeps a learning rate per weight, L1 makes most weights zero; what is left is broadcast (at
most 2**bits numbers, a parameter). Features of a whole batch are hashed and weighed as arrays.

The fit uses at most ``max_labels`` labelled documents of at most ``max_chars`` letters (documented bounds); scoring
covers every document in whole, with no shuffle but the rates' small aggregation.

Defined results: null, empty and blank texts score 0; documents labelled by several raters take the majority, ties are
left out of the fit; without any positive label only the lexicon's prior decides; repeated rows score alike.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolodar.llm.plaintext import plain

# A small general lexicon in four languages, by class. ``group``, ``you``, ``demean`` and ``harm`` hold
# words that are harmless by themselves and tell something only together.
LEXICON = {
    "insult": "idiot moron imbecile cretin bastard bitch whore slut asshole scumbag wanker twat dickhead jerk retard loser pig parasite "
    "dumbass motherfucker cunt arschloch wichser schlampe hure missgeburt schwein depp trottel fotze hurensohn connard "
    "connasse salaud salope abruti encule batard putain pute porc idiota imbecil cabron puta gilipollas cerdo estupido zorra",
    "filth": "fuck fucked fucking shit bullshit crap piss scheisse verpiss merde mierda joder tits dick cock cum fresse gueule",
    "sex": "nude nudes naked horny porn xxx sexy strip nackt nackte ficken titten desnuda desnudo nue nichons blowjob",
    "hate": "vermin subhuman ungeziefer vermine ratas ratten untermenschen abschaum nigger faggot kike gosse",
    "harm": "kill murder strangle rape choke chokes verreck krepier creve crever mueras muerete hang die died drop dead burn beat break teeth pulp verrecke "
    "rot hurt stab shoot strip",
    "group": "women woman immigrants immigrant foreigners foreigner refugees refugee gay gays lesbians disabled jews muslims blacks migrants "
    "frauen auslander fluchtlinge schwule behinderte juden etrangers immigres refugies femmes juifs musulmans mujeres inmigrantes "
    "extranjeros refugiados judios",
    "you": "you your yourself du dich dir dein deine tu toi te ta usted tus",
    "demean": "gutter worthless useless ugly stupid disgusting filth brainless brains inferior animals thieves rats bred dogs fat dumb dumm dummes "
    "wertlos widerlich stinkt pue pues sale gros espece inutil asqueroso basura largate trash echarlos verschwinden",
}
#: Weights that a class, and two classes in one passage, have before the fit, which adds what the labels tell.
PRIOR = {"insult": 5.4, "filth": 5.0, "sex": 4.2, "hate": 5.0, "harm": 1.8, "demean": 1.6}
PAIR_PRIOR = {
    ("insult", "you"): 1.8, ("filth", "you"): 1.8, ("sex", "you"): 2.0, ("demean", "you"): 2.0, ("harm", "you"): 2.8, ("demean", "insult"): 1.8,
    ("group", "hate"): 2.5, ("demean", "group"): 4.0, ("group", "harm"): 3.6, ("harm", "insult"): 1.8, ("filth", "insult"): 1.0, ("filth", "sex"): 1.8,
}
PRIOR_BIAS = -5.0
_LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "+": "t", "$": "s", "@": "a", "!": "i"})
_SPACED = re.compile(
    r"(?<![^\W_])[^\W\d_]([.\-])(?:[^\W\d_]\1)+[^\W\d_]+(?![^\W_])|(?<![^\W_])[^\W\d_](?: [^\W\d_]){2,}(?![^\W_])"
)
_TOKEN = re.compile(r"[^\W_]+(?:[+$@!*]+[^\W_]+)*[+$@](?![^\W_])|[^\W_]+(?:[+$@!*]+[^\W_]+)*")
_PASSAGE = re.compile(r"(?:(?! [-–—|/] )[^.!?\n\r…])+")
_RUN = re.compile(r"(.)\1+")


def squeeze(word: str) -> str:
    return _RUN.sub(r"\1", word)


_CLASS = {squeeze(w): c for c, ws in LEXICON.items() for w in ws.split()}
_SHAPES: dict[tuple[str, str, int], str] = {}
for _c, _ws in LEXICON.items():
    for _w in _ws.split():
        _SHAPES.setdefault((_w[0], _w[-1], len(_w)), squeeze(_w))


class _Unmasked(dict):
    """Spellings of tokens, found once (for so many tokens at a time)."""

    def __missing__(self, token: str) -> str:
        if len(self) > 200_000:
            self.clear()
        self[token] = found = unmask(token)
        return found


_UNMASKED = _Unmasked()


def unmask(token: str) -> str:
    """One spelling of a plain token."""
    if "*" in token:
        stars = token.count("*")
        head, tail = token.split("*", 1)[0], token.rsplit("*", 1)[1]
        if stars >= 1 and head and tail:
            found = _SHAPES.get((head[0], tail[-1], len(token)))
            return found or "*starred*"
    if not token.isalpha() and not token.isdigit() and any(c.isalpha() for c in token):
        token = token.translate(_LEET)
    return squeeze(token) if not token.isdigit() else "0"


def passages(text: str) -> list[list[str]]:
    """The words of every passage, in one spelling."""
    t = plain(text)
    t = _SPACED.sub(lambda m: re.sub(r"[ .\-]", "", m.group()), t)
    out = []
    for m in _PASSAGE.finditer(t):
        ws = [_UNMASKED[w] for w in _TOKEN.findall(m.group())]
        if ws:
            out.append(ws)
    return out


_KINDS = sorted(LEXICON)
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _mix(salt: int, *parts: np.ndarray) -> np.ndarray:
    """One hash of several, by multiplication and shifts."""
    h = np.full(len(parts[0]), salt, dtype=np.uint64)
    for x in parts:
        h = (h ^ x) * _M1
        h ^= h >> np.uint64(29)
    h *= _M2
    return h ^ (h >> np.uint64(32))


def class_feature(kind: str, mask: int) -> int:
    return int(_mix(6, np.array([_KINDS.index(kind)], dtype=np.uint64))[0] & np.uint64(mask))


def pair_feature(a: str, b: str, mask: int) -> int:
    i, j = sorted((_KINDS.index(a), _KINDS.index(b)))
    return int(_mix(9, np.array([i], dtype=np.uint64), np.array([j], dtype=np.uint64))[0] & np.uint64(mask))


class Hasher:
    """Hashed features of many passages at once: words, pairs, triples, pairs with one or two words between them,
    lexicon classes alone, beside their neighbours, and two in one passage."""

    def __init__(self, bits: int) -> None:
        self.mask = np.uint64((1 << bits) - 1)
        self.seen: dict[str, tuple[int, int]] = {}

    def _word(self, w: str) -> tuple[int, int]:
        found = self.seen.get(w)
        if found is None:
            kind = _CLASS.get(w)
            found = (zlib.crc32(w.encode("utf-8", "surrogatepass")), _KINDS.index(kind) if kind else -1)
            if len(self.seen) < 500_000:
                self.seen[w] = found
        return found

    def __call__(self, many: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """(passage, feature), repeats included."""
        look = self._word
        flat = [look(w) for ws in many for w in ws]
        both = np.array(flat, dtype=np.int64).reshape(-1, 2)
        word, kind = both[:, 0].astype(np.uint64), both[:, 1]
        at = np.repeat(np.arange(len(many)), [len(ws) for ws in many])
        rows, feats = [at], [_mix(1, word)]
        for salt, gap in ((2, 1), (3, 2), (4, 3)):
            here = at[:-gap] == at[gap:] if len(at) > gap else np.zeros(0, dtype=bool)
            rows.append(at[: len(here)][here])
            feats.append(_mix(salt, word[: len(here)][here], word[gap:][here] if len(here) else word[:0]))
        if len(at) > 2:
            here = at[:-2] == at[2:]
            rows.append(at[:-2][here])
            feats.append(_mix(5, word[:-2][here], word[1:-1][here], word[2:][here]))
        told = np.flatnonzero(kind >= 0)
        k = kind[told].astype(np.uint64)
        rows.append(at[told])
        feats.append(_mix(6, k))
        for salt, step in ((7, -1), (8, 1)):
            beside = told + step
            ok = (beside >= 0) & (beside < len(at))
            ok[ok] = at[beside[ok]] == at[told[ok]]
            rows.append(at[told[ok]])
            feats.append(_mix(salt, k[ok], word[beside[ok]]))
        held = np.zeros((len(many), len(_KINDS)), dtype=bool)
        held[at[told], kind[told]] = True
        for i in range(len(_KINDS)):
            for j in range(i + 1, len(_KINDS)):
                here = np.flatnonzero(held[:, i] & held[:, j])
                if len(here):
                    rows.append(here)
                    feats.append(_mix(9, np.full(len(here), i, dtype=np.uint64), np.full(len(here), j, dtype=np.uint64)))
        return np.concatenate(rows), (np.concatenate(feats) & self.mask).astype(np.int64)


def _distinct(rows: np.ndarray, feats: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs once each, ordered by row."""
    key = np.unique((rows.astype(np.int64) << bits) | feats)
    return key >> bits, key & ((1 << bits) - 1)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


@dataclass
class Model:
    """Sparse weights of a fitted classifier: sorted features and their weights."""

    bits: int
    bias: float
    at: np.ndarray
    weight: np.ndarray

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << self.bits, dtype=np.float32)
        out[self.at] = self.weight
        return out

    def texts(self, texts: list[str | None], table: np.ndarray | None = None, hasher: Hasher | None = None) -> np.ndarray:
        """Probability of the worst passage of every text."""
        table = self.dense() if table is None else table
        hasher = hasher or Hasher(self.bits)
        out = np.zeros(len(texts))
        many: list[list[str]] = []
        owner: list[int] = []
        size = 0

        def judge() -> None:
            rows, feats = hasher(many)
            hit = np.flatnonzero(table[feats])
            rows, feats = _distinct(rows[hit], feats[hit], self.bits)
            z = np.bincount(rows, weights=table[feats], minlength=len(many)) + self.bias
            np.maximum.at(out, np.array(owner, dtype=np.int64), _sigmoid(z))

        for i, t in enumerate(texts):
            found = passages(t) if t else []
            many += found
            owner += [i] * len(found)
            size += len(t) if t else 0
            if size > 2_000_000:
                judge()
                many, owner, size = [], [], 0
        if many:
            judge()
        return out

    def text(self, text: str | None) -> float:
        return float(self.texts([text])[0])


class Ftrl:
    """FTRL-proximal for logistic loss with one learning rate per coordinate, in small batches."""

    def __init__(self, size: int, alpha: float, beta: float, l1: float, l2: float) -> None:
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def step(self, rows: np.ndarray, feats: np.ndarray, y: np.ndarray, importance: np.ndarray, offset: np.ndarray) -> None:
        """One batch: (row, feature) of its passages; labels, importance and what is known beforehand by row."""
        at, place = np.unique(feats, return_inverse=True)
        w = self.weights(at)
        p = _sigmoid(offset + np.bincount(rows, weights=w[place], minlength=len(y)))
        g = np.bincount(place, weights=((p - y) * importance)[rows], minlength=len(at))
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


class Passages:
    """Features of all passages of the labelled documents as one sparse matrix (rows are passages)."""

    def __init__(self, texts: list[str], bits: int) -> None:
        many = [passages(t) for t in texts]
        self.doc = np.repeat(np.arange(len(texts)), [len(m) for m in many])
        rows, feats = Hasher(bits)([ws for m in many for ws in m])
        rows, self.feats = _distinct(rows, feats, bits)
        self.count = len(self.doc)
        self.starts = np.searchsorted(rows, np.arange(self.count + 1))
        self.rows = rows

    def sums(self, table: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, weights=table[self.feats], minlength=self.count)

    def take(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row in ``which``, feature)."""
        size = self.starts[which + 1] - self.starts[which]
        ends = np.cumsum(size)
        spot = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - size, size) + np.repeat(self.starts[which], size)
        return np.repeat(np.arange(len(which)), size), self.feats[spot]


def fit(
    texts: list[str], labels: list[int], bits: int = 20, rounds: int = 3, epochs: int = 3, alpha: float = 0.1, beta: float = 1.0,
    l1: float = 0.8, l2: float = 0.05, batch: int = 16, seed: int = 7,
) -> Model:
    """Weights from labelled texts; the guilty passages are found on the way.

    The lexicon's classes have prior weights, to which the fit adds: few labels leave a cautious lexicon model, many
    override it.
    A feature tells something by the lower bound of its log-odds (its estimate less some standard errors), which is the
    same test at every number of labels."""
    mask = (1 << bits) - 1
    bias_at = 1 << bits
    prior = np.zeros(bias_at + 1)
    for kind, w in PRIOR.items():
        prior[class_feature(kind, mask)] = w
    for (a, b), w in PAIR_PRIOR.items():
        prior[pair_feature(a, b, mask)] = w
    first = np.flatnonzero(prior)
    y = np.array(labels, dtype=float)
    m = Passages(texts, bits)
    used = np.unique(m.doc)
    n_pos, n_neg = int(y[used].sum()), int((1 - y[used]).sum())
    if not n_pos or not n_neg:
        return Model(bits, PRIOR_BIAS, first, prior[first])
    # Documents that hold a feature; equal documents count once.
    doc_of, feat_of = _distinct(m.doc[m.rows], m.feats, bits)
    cuts = np.searchsorted(doc_of, np.arange(len(texts) + 1))
    in_pos, in_neg = np.zeros(bias_at), np.zeros(bias_at)
    for value, count in ((1.0, in_pos), (0.0, in_neg)):
        for key in {feat_of[cuts[d] : cuts[d + 1]].tobytes() for d in used if y[d] == value}:
            count[np.frombuffer(key, dtype=np.int64)] += 1
    odds = np.log((in_pos + 0.5) / (n_pos + 1)) - np.log((in_neg + 0.5) / (n_neg + 1))
    odds -= 2.0 * np.sqrt(1 / (in_pos + 0.5) + 1 / (in_neg + 0.5))
    strong = np.zeros(bias_at)
    for kind in ("insult", "filth", "sex", "hate"):
        strong[class_feature(kind, mask)] = 1.0
    for pair in PAIR_PRIOR:
        strong[pair_feature(*pair, mask)] = 1.0
    # Mostly seen in abusive documents, or abusive by the lexicon and not mostly seen in clean ones.
    telling = (((odds > 0) & (in_pos >= 0.6 * (in_pos + in_neg))) | ((strong > 0) & (in_pos + 1 >= in_neg * n_pos / n_neg))).astype(float)
    known = ((in_pos + in_neg >= 2) | (telling > 0)).astype(float)
    # Share of the telling ones among a passage's known features: near 0 for what clean documents hold as well.
    odd = m.sums(telling) / np.maximum(6, m.sums(known))
    top = np.zeros(len(texts))
    np.maximum.at(top, m.doc, odd)
    bad = y[m.doc] == 1
    offset = m.sums(prior[:-1]) + PRIOR_BIAS
    rng = np.random.default_rng(seed)
    model: Ftrl | None = None
    for _ in range(rounds):
        if model is None:
            z = offset
            guilty = bad & (((odd >= np.maximum(0.3, 0.6 * top[m.doc])) & (odd > 0)) | (z > 0))
            clean = bad & (odd < 0.05) & (z < -1)
        else:
            z = offset + m.sums(model.weights(np.arange(bias_at))) + model.weights(np.array([bias_at]))[0]
            # A document without a suspicious passage is taken for a rater's error.
            guilty = bad & (((z > 0) & (odd > 0.1)) | ((z > -1.5) & (odd >= 0.3)))
            clean = bad & ~guilty & ((odd < 0.1) | ((z < -2.0) & (odd < 0.2)))
        # Raters err: a passage of a clean document that looks clearly abusive is left out.
        clean |= ~bad & (z < 3.0)
        model = Ftrl(bias_at + 1, alpha, beta, l1, l2)
        which = np.flatnonzero(guilty | clean)
        importance = np.where(guilty[which], max(1.0, min(4.0, 0.1 * clean.sum() / max(1, guilty.sum()))), 1.0)
        for _ in range(epochs):
            order = rng.permutation(len(which))
            for at in range(0, len(order), batch):
                part = order[at : at + batch]
                rows, feats = m.take(which[part])
                rows = np.concatenate([rows, np.arange(len(part))])
                feats = np.concatenate([feats, np.full(len(part), bias_at)])
                model.step(rows, feats, guilty[which[part]].astype(float), importance[part], offset[which[part]])
    assert model is not None
    kept = np.flatnonzero((np.abs(model.z[:bias_at]) > model.l1) | (prior[:-1] != 0))
    return Model(bits, PRIOR_BIAS + float(model.weights(np.array([bias_at]))[0]), kept, prior[kept] + model.weights(kept))


def fit_labels(
    corpus: DataFrame, key: str, text: str, labels: DataFrame, label_key: str, label: str, max_labels: int = 20_000, max_chars: int = 20_000, **options
) -> Model:
    """Fit on the reviewed documents: the majority of the raters, at most ``max_labels`` documents (lowest hash of the
    key first) of at most ``max_chars`` letters - the bounds of what the driver sees."""
    votes = labels.groupBy(F.col(label_key).alias("k")).agg(F.avg(F.col(label).cast("double")).alias("y")).where("y <> 0.5")
    votes = votes.orderBy(F.xxhash64("k"), "k").limit(max_labels)
    rows = corpus.select(F.col(key).alias("k"), F.col(text).alias("t")).join(votes, "k").where(f"trim(t) <> '' and length(t) <= {max_chars}").orderBy("k").collect()
    return fit([r["t"] for r in rows], [int(r["y"] > 0.5) for r in rows], **options)


def score(corpus: DataFrame, key: str, text: str, model: Model) -> DataFrame:
    """key, abuse: probability that the worst passage of the text is abusive; one row per document."""
    shared = corpus.sparkSession.sparkContext.broadcast(model)
    kind = dict(corpus.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        table, hasher = m.dense(), Hasher(m.bits)
        for pdf in batches:
            yield pd.DataFrame({key: pdf.iloc[:, 0], "abuse": m.texts(list(pdf.iloc[:, 1]), table, hasher)})

    return corpus.select(key, text).mapInPandas(run, f"`{key}` {kind}, abuse double")


def rates(scored: DataFrame, source: str, threshold: float = 0.5) -> DataFrame:
    """source, n_documents, n_abusive, rate."""
    hit = (F.col("abuse") >= threshold).cast("long")
    return scored.groupBy(source).agg(F.count("*").alias("n_documents"), F.sum(hit).alias("n_abusive"), F.round(F.avg(hit), 6).alias("rate"))
