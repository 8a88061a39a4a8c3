"""Evaluation texts leaking into a corpus, by suffix arrays of corpus shards.

Every stretch of a partition (a shard) is turned into word numbers of the evaluation vocabulary; all other words are
breaks, and runs shorter than a seed are dropped. A suffix array over what is left is built by prefix doubling, and
all suffixes of all test items are binary-searched in it at once. The intervals found are the locations of all
verbatim matches of at least ``seed`` words; neighbours on one diagonal join to the longest matches. Pairs of a
document and an item that are covered far enough for any passage within the rule go to an exact local alignment and,
if its whole stretch is edited too much, to an exact search of all passages; they decide whether the document repeats
at least ``min_words`` successive words of the item with few enough of them changed, dropped or added.

A document lies in one row, so nothing is shuffled; the test items are broadcast, at most ``max_items`` at a time, and
more of them take further passes over the corpus. Work grows with the corpus, memory with the stretch: the matches of
n-grams that are frequent in both are expanded for some items, or some documents, at a time.

Defined results: null and empty texts leak nothing; case, punctuation, line layout, accents, invisible and look-alike
characters do not matter; hyphenated parts count as one word; each document and item once; repeated document rows give
repeated results only through their own ids; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolodar.llm.plaintext import words, words_with_groups

STRETCH_WORDS = 3_000_000
#: Matches that are expanded at a time.
MOST_HITS = 8_000_000


@dataclass
class Items:
    """Test items as one array of word numbers with breaks (0) between them."""

    vocabulary: dict[str, int]
    tokens: np.ndarray
    item_of: np.ndarray
    groups: np.ndarray
    ids: list[int]
    starts: np.ndarray

    @classmethod
    def build(cls, rows: list[tuple[int, str]]) -> Items:
        vocabulary: dict[str, int] = {}
        tokens, item_of, groups, starts = [0], [-1], [-1], []
        for k, (_, text) in enumerate(rows):
            ws, gs = words_with_groups(text)
            starts.append(len(tokens))
            tokens += [vocabulary.setdefault(w, len(vocabulary) + 1) for w in ws] + [0]
            item_of += [k] * len(ws) + [-1]
            groups += gs + [-1]
        return cls(
            vocabulary, np.array(tokens, dtype=np.int64), np.array(item_of, dtype=np.int64), np.array(groups, dtype=np.int64),
            [i for i, _ in rows], np.array([*starts, len(tokens)], dtype=np.int64),
        )


def run_ends(tokens: np.ndarray) -> np.ndarray:
    """For each position the position of the next break."""
    n = len(tokens)
    ends = np.where(tokens == 0, np.arange(n), n)
    return np.minimum.accumulate(ends[::-1])[::-1]


def suffix_array(tokens: np.ndarray, depth: int) -> np.ndarray:
    """Positions of words in the order of their suffixes (up to ``depth`` words or a break), by prefix doubling."""
    live = np.flatnonzero(tokens > 0)
    ends = run_ends(tokens)
    rank = tokens.astype(np.int64)
    k = 1
    while k < depth:
        nxt = live + k
        second = np.where(nxt < ends[live], rank[np.minimum(nxt, len(tokens) - 1)], 0)
        key = rank[live] * (int(rank.max()) + 1) + second
        _, inverse = np.unique(key, return_inverse=True)
        rank = np.zeros_like(rank)
        rank[live] = inverse + 1
        if len(live) and inverse.max() + 1 == len(live):
            break
        k *= 2
    return live[np.argsort(rank[live], kind="stable")]


def _bound(tokens: np.ndarray, sa: np.ndarray, query: np.ndarray, at: np.ndarray, depth: int, upper: bool) -> np.ndarray:
    """Lower or upper bound in the suffix array of the first ``depth`` words at each query position."""
    lo, hi = np.zeros(len(at), dtype=np.int64), np.full(len(at), len(sa), dtype=np.int64)
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi) // 2
        pos = sa[np.minimum(mid, len(sa) - 1)]
        state = np.zeros(len(at), dtype=np.int8)  # -1: the shard's suffix is smaller
        over = np.zeros(len(at), dtype=bool)
        for j in range(depth):
            t = np.where(over, 0, tokens[np.minimum(pos + j, len(tokens) - 1)])
            over |= t == 0
            q = query[at + j]
            state = np.where(state == 0, np.sign(t - q), state)
        right = (state <= 0) if upper else (state < 0)
        lo = np.where(open_ & right, mid + 1, lo)
        hi = np.where(open_ & ~right, mid, hi)


def intervals(tokens: np.ndarray, items: Items, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The suffix array, and for every item position with ``seed`` words its interval there (positions, from, to)."""
    sa = suffix_array(tokens, seed)
    at = np.flatnonzero(items.tokens > 0)
    at = at[run_ends(items.tokens)[at] - at >= seed]
    if not len(sa) or not len(at):
        none = np.zeros(0, dtype=np.int64)
        return sa, none, none, none
    lo = _bound(tokens, sa, items.tokens, at, seed, upper=False)
    hi = _bound(tokens, sa, items.tokens, at, seed, upper=True)
    met = hi > lo
    return sa, at[met], lo[met], hi[met]


def expand(sa: np.ndarray, at: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (shard position, item position) of intervals."""
    size = hi - lo
    which = np.repeat(np.arange(len(at)), size)
    ends = np.cumsum(size)
    spot = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - size, size) + np.repeat(lo, size)
    return sa[spot], at[which]


def align(doc: np.ndarray, item: np.ndarray, penalty: float) -> tuple[int, int, int, int, int]:
    """Best local alignment: first and last item word (exclusive), agreeing words, first and last document word."""
    h = np.zeros((len(item) + 1, len(doc) + 1))
    step = penalty * np.arange(len(doc) + 1)
    for i, w in enumerate(item):
        row = np.zeros(len(doc) + 1)
        row[1:] = h[i, :-1] + np.where(doc == w, 1.0, -penalty)
        row = np.maximum(np.maximum(row, h[i] - penalty), 0.0)
        h[i + 1] = np.maximum.accumulate(row + step) - step
    i, j = np.unravel_index(int(h.argmax()), h.shape)
    last_i, last_j, same = int(i), int(j), 0
    while i > 0 and j > 0 and h[i, j] > 1e-9:
        hit = doc[j - 1] == item[i - 1]
        if abs(h[i, j] - h[i - 1, j - 1] - (1.0 if hit else -penalty)) < 1e-6:
            same += int(hit)
            i, j = i - 1, j - 1
        elif abs(h[i, j] - h[i - 1, j] + penalty) < 1e-6:
            i -= 1
        else:
            j -= 1
    return int(i), last_i, same, int(j), last_j


def repeated(doc: np.ndarray, item: np.ndarray, groups: np.ndarray, min_words: int, max_edits: float) -> tuple[int, int, int, int] | None:
    """First and last item word (exclusive), edits and last document word of the best passage that the document repeats,
    or null. A passage begins and ends with an agreeing word; those from all first words are searched at once, on the
    diagonals of ``doc`` (its word i + c stands on diagonal c for item word i)."""
    n = len(item)
    width = len(doc) - n + 1
    hits = np.lib.stride_tricks.sliding_window_view(doc, width) == item[:, None]
    begin = np.flatnonzero((groups[-1] - groups + 1 >= min_words) & hits.any(axis=1))
    step = np.arange(width)
    dist = np.zeros((len(begin), width))  # edits of item[begin:begin + size] against the best stretch up to a document word
    best, size = None, 0
    while len(begin):
        size += 1
        hit = hits[begin + size - 1]
        agreed = np.where(hit, dist, np.inf)
        row = agreed
        if size > 1:
            row = dist + ~hit
            row[:, :-1] = np.minimum(row[:, :-1], dist[:, 1:] + 1)
        dist = np.minimum.accumulate(row - step, axis=1) + step
        least = agreed.min(axis=1)
        fits = np.flatnonzero((groups[begin + size - 1] - groups[begin] + 1 >= min_words) & (least <= max_edits * size + 1e-9))
        if len(fits):
            k = int(fits[least[fits].argmin()])
            found = (size - int(least[k]), int(begin[k]), int(begin[k]) + size, int(least[k]), int(begin[k]) + size + int(agreed[k].argmin()))
            best = max(best, found) if best else found
        # Beyond the edits of the longest passage from here, no passage comes.
        kept = (begin + size < n) & (dist.min(axis=1) <= max_edits * (n - begin) + 1e-9)
        begin, dist = begin[kept], dist[kept]
    return best[1:] if best else None


@dataclass(frozen=True)
class Rule:
    """When a document repeats an item: so many successive words, at most this share of them edited."""

    min_words: int = 18
    max_edits: float = 0.17
    penalty: float = 2.0

    def _stretches(self) -> list[tuple[int, int]]:
        sizes = range(self.min_words, 8 * self.min_words)
        return [(n, int(self.max_edits * n + 1e-9)) for n in sizes]

    @property
    def seed(self) -> int:
        """Words in a row that every such passage holds unedited: k edits leave k + 1 runs."""
        return max(1, min(-(-(n - k) // (k + 1)) for n, k in self._stretches()))

    @property
    def min_cover(self) -> int:
        """Words that every such passage holds in runs of a seed: all runs but one may fall just short of it."""
        return max(self.seed, min(n - k - k * (self.seed - 1) for n, k in self._stretches()))


def shard_leaks(keys: list, texts: list[str | None], items: Items, rule: Rule) -> list[tuple]:
    """(key, item id, words, agreeing words, longest verbatim match, document word) of every leak in a shard."""
    get = items.vocabulary.get
    return token_leaks(keys, [np.array([get(w, 0) for w in words(text)], dtype=np.int64) for text in texts], items, rule)


def token_leaks(keys: list, doc_tokens: list[np.ndarray], items: Items, rule: Rule) -> list[tuple]:
    seed = rule.seed
    lengths = np.array([len(t) + 1 for t in doc_tokens], dtype=np.int64)
    starts = np.concatenate(([0], np.cumsum(lengths)))
    flat = np.zeros(int(starts[-1]) + 1, dtype=np.int64)
    for s, t in zip(starts, doc_tokens, strict=False):
        flat[s : s + len(t)] = t
    # Runs that cannot hold a seed are breaks too.
    ends = run_ends(flat)
    begins = np.maximum.accumulate(np.where(flat == 0, np.arange(len(flat)), -1)) + 1
    kept = np.where(ends - begins >= seed, flat, 0)
    sa, at, lo, hi = intervals(kept, items, seed)
    if not len(at):
        return []
    owner = items.item_of[at]
    per_item = np.bincount(owner, weights=hi - lo, minlength=len(items.ids))
    if per_item.max() > MOST_HITS and len(keys) > 1:
        # Too many matches of one item: in two parts, each of whole documents.
        half = len(keys) // 2
        return token_leaks(keys[:half], doc_tokens[:half], items, rule) + token_leaks(keys[half:], doc_tokens[half:], items, rule)
    out = []
    part = (np.cumsum(per_item) // MOST_HITS).astype(np.int64)[owner]
    for p in np.unique(part):
        mine = part == p
        out += _judge(keys, flat, starts, *expand(sa, at[mine], lo[mine], hi[mine]), items, rule)
    return out


def windows(diagonals: np.ndarray, slack: int) -> list[tuple[int, int]]:
    """Ranges of sorted diagonals, each at most twice ``slack`` wide, such that any diagonals within ``slack`` of each
    other stand together in one of them."""
    out = []
    for group in np.split(diagonals, np.flatnonzero(np.diff(diagonals) > slack) + 1):
        first, last = int(group[0]), int(group[-1])
        while last - first > 2 * slack:
            out.append((first, first + 2 * slack))
            first += max(1, slack)
        out.append((first, last))
    return out


def _judge(keys: list, flat: np.ndarray, starts: np.ndarray, spot: np.ndarray, at: np.ndarray, items: Items, rule: Rule) -> list[tuple]:
    """The leaks among matches (shard position, item position)."""
    seed, min_cover = rule.seed, rule.min_cover
    doc = np.searchsorted(starts, spot, side="right") - 1
    item = items.item_of[at]
    order = np.lexsort((spot, at - spot, item, doc))
    spot, at, doc, item = spot[order], at[order], doc[order], item[order]
    pair = doc * len(items.ids) + item
    out = []
    bounds = np.concatenate([[0], np.flatnonzero(np.diff(pair)) + 1, [len(pair)]])
    # A pair with fewer matches than a passage within the rule has cannot hold one.
    least = -(-min_cover // seed)
    for k0, k1 in zip(bounds[:-1][np.diff(bounds) >= least], bounds[1:][np.diff(bounds) >= least], strict=True):
        p_spot, p_at = spot[k0:k1], at[k0:k1]
        if (k1 - k0) * seed < min_cover or len(np.unique((p_at[:, None] + np.arange(seed)).ravel())) < min_cover:
            continue
        d, k = int(doc[k0]), int(item[k0])
        a, b = int(items.starts[k]), int(items.starts[k + 1]) - 1
        best = None
        # The seeds of a passage lie on diagonals no further apart than it has edits.
        slack = int(rule.max_edits * (b - a))
        diagonal = p_spot - p_at
        for lowest, highest in windows(np.unique(diagonal), slack):
            held = (diagonal >= lowest) & (diagonal <= highest)
            if len(np.unique((p_at[held][:, None] + np.arange(seed)).ravel())) < min_cover:
                continue
            low = max(int(starts[d]), lowest + a - slack)
            high = min(int(starts[d + 1]) - 1, highest + b + slack)
            i0, i1, same, j0, j1 = align(flat[low:high], items.tokens[a:b], rule.penalty)
            covered_words = len(set(items.groups[a + i0 : a + i1].tolist()))
            edits = max(i1 - i0, j1 - j0) - same
            if i1 <= i0 or covered_words < rule.min_words or edits > rule.max_edits * (i1 - i0):
                # The best alignment may run on through an edited stretch; a part of it may do alone.
                first = lowest + a - slack
                band = np.full(highest + b + slack - first, -1, dtype=np.int64)
                band[low - first : high - first] = flat[low:high]
                part = repeated(band, items.tokens[a:b], items.groups[a:b], rule.min_words, rule.max_edits)
                if part is None:
                    continue
                i0, i1, edits, j1 = part
                same, j1 = i1 - i0 - edits, j1 - (low - first)
                j0 = max(0, j1 - (i1 - i0))
                covered_words = len(set(items.groups[a + i0 : a + i1].tolist()))
            if covered_words >= rule.min_words and edits <= rule.max_edits * (i1 - i0) and (best is None or same > best[1]):
                best = (covered_words, same, low + j0 - int(starts[d]))
        if best:
            joined = (np.diff(p_spot) == 1) & (np.diff(p_at) == 1)
            runs = np.diff(np.flatnonzero(np.concatenate(([True], ~joined, [True]))))
            out.append((keys[d], items.ids[k], best[0], best[1], int(runs.max()) + seed - 1, best[2]))
    return out


def _passes(tests: DataFrame, test_key: str, test_text: str, max_items: int) -> Iterator[Items]:
    """The test items, at most about ``max_items`` at a time."""
    rows = tests.select(test_key, test_text).where(F.col(test_text).isNotNull()).distinct()
    parts = max(1, -(-rows.count() // max_items))
    for i in range(parts):
        mine = rows if parts == 1 else rows.where(F.pmod(F.xxhash64(test_key), F.lit(parts)) == i)
        yield Items.build(sorted((r[0], r[1]) for r in mine.collect()))


def leaks(
    corpus: DataFrame, key: str, text: str, tests: DataFrame, test_key: str, test_text: str, rule: Rule = Rule(), max_items: int = 20_000
) -> DataFrame:
    """key, item_id, n_words, n_same, longest_verbatim, at_word: one row per document and item leaked into it. Each
    ``max_items`` test items take one pass over the corpus."""
    out = None
    for items in _passes(tests, test_key, test_text, max_items):
        part = _leaks_of(corpus, key, text, items, dict(tests.dtypes)[test_key], rule)
        out = part if out is None else out.unionByName(part)
    return out


def _leaks_of(corpus: DataFrame, key: str, text: str, items: Items, item_kind: str, rule: Rule) -> DataFrame:
    shared = corpus.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys: list = []
        texts: list = []
        size = 0
        for pdf in batches:
            for k, t in zip(pdf.iloc[:, 0], pdf.iloc[:, 1], strict=True):
                keys.append(k)
                texts.append(t)
                size += len(t) // 5 if t else 0
            if size >= STRETCH_WORDS:
                yield frame(shard_leaks(keys, texts, shared.value, rule))
                keys, texts, size = [], [], 0
        yield frame(shard_leaks(keys, texts, shared.value, rule))

    names = [key, "item_id", "n_words", "n_same", "longest_verbatim", "at_word"]

    def frame(found: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(found, columns=names)

    kind = dict(corpus.dtypes)[key]
    return corpus.select(key, text).where(F.col(text).isNotNull()).mapInPandas(
        run, f"`{key}` {kind}, item_id {item_kind}, n_words int, n_same int, longest_verbatim int, at_word int"
    )


def without_leaks(corpus: DataFrame, key: str, found: DataFrame) -> DataFrame:
    """The corpus without documents that leak any item."""
    return corpus.join(found.select(key).distinct(), key, "left_anti")
