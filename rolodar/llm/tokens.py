"""Encoding of a corpus with a public byte-level BPE vocabulary, by a pair occurrence index.

The word pieces of a stretch of a partition are laid out once, each distinct word once, as linked symbol lists. An
index maps every mergeable pair to all its positions. The active ranks are applied in ascending order from a heap:
one step merges every occurrence of a pair at once and files the pairs that arise under their own ranks. A document
is put together from its words' lists, so repeated words cost nothing twice.

No shuffle; the vocabulary is read by the driver from a path and broadcast (its size is that of the file, fixed).

Defined results: null and empty texts give an empty list; strings that look like special tokens are ordinary text;
every other text, of any length and script, gives the ids of its bytes; rows and their order are kept as they are.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
# Fixed value: the public splitting pattern of byte-level BPE.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters laid out at once; bounds the memory of a task whatever its partition's size.
STRETCH_CHARS = 24_000_000


def byte_letters() -> dict[str, int]:
    """The public stand-in letter of every byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    shift = 0
    for b in range(256):
        if b not in plain:
            out[chr(256 + shift)] = b
            shift += 1
    return out


class Merges:
    """Sorted pair keys with rank and result of every merge, and the id of every byte."""

    def __init__(self, vocab: dict[str, int], merges: list) -> None:
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        result = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
        self.base = int(max(vocab.values())) + 1
        keys = left * self.base + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.left, self.right, self.result = left.astype(np.int32), right.astype(np.int32), result
        self.byte_ids = np.zeros(256, dtype=np.int32)
        for letter, b in byte_letters().items():
            self.byte_ids[b] = vocab[letter]

    @classmethod
    def load(cls, path: str) -> Merges:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        return cls(model["vocab"], model["merges"])

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where there is no such merge."""
        key = a.astype(np.int64) * self.base + b
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.ranks[at], -1)


def _leftmost(pos: np.ndarray, nxt: np.ndarray) -> np.ndarray:
    """Of occurrences of a pair of equal symbols, those that a left-to-right merge takes (every other one in a run)."""
    chained = np.zeros(len(pos), dtype=bool)
    chained[1:] = nxt[pos[:-1]] == pos[1:]
    starts = np.flatnonzero(~chained)
    depth = np.arange(len(pos)) - np.repeat(starts, np.diff(np.append(starts, len(pos))))
    return pos[depth % 2 == 0]


def encode_words(words: list[bytes], m: Merges) -> tuple[np.ndarray, np.ndarray]:
    """ids of all words one after the other, and the offset of each word."""
    lengths = np.fromiter((len(w) for w in words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths)
    n = int(ends[-1]) if len(words) else 0
    if n == 0:
        return np.zeros(0, dtype=np.int32), np.zeros(len(words) + 1, dtype=np.int64)
    sym = m.byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)].copy()
    nxt, prv = np.arange(1, n + 1, dtype=np.int64), np.arange(-1, n - 1, dtype=np.int64)
    last = ends[lengths > 0] - 1
    nxt[last] = -1
    prv[(ends - lengths)[lengths > 0]] = -1

    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def file(pos: np.ndarray, ranks: np.ndarray) -> None:
        keep = ranks >= 0
        pos, ranks = pos[keep], ranks[keep]
        if not len(pos):
            return
        order = np.argsort(ranks, kind="stable")
        pos, ranks = pos[order], ranks[order]
        cuts = np.flatnonzero(np.diff(ranks)) + 1
        heads = ranks[np.concatenate(([0], cuts))].tolist()
        for r, part in zip(heads, np.split(pos, cuts), strict=True):
            have = index.get(r)
            if have is None:
                index[r] = [part]
                heapq.heappush(heap, r)
            else:
                have.append(part)

    first = np.flatnonzero(nxt >= 0)
    file(first, m.rank(sym[first], sym[nxt[first]]))
    while heap:
        r = heapq.heappop(heap)
        parts = index.pop(r)
        pos = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
        a, b = m.left[r], m.right[r]
        pos = pos[(sym[pos] == a) & (nxt[pos] >= 0)]
        pos = pos[sym[nxt[pos]] == b]
        if not len(pos):
            continue
        if a == b:
            pos = _leftmost(np.sort(pos), nxt)
        gone = nxt[pos]
        after = nxt[gone]
        sym[pos], sym[gone], nxt[pos] = m.result[r], -1, after
        has = after >= 0
        prv[after[has]] = pos[has]
        before = prv[pos]
        left = before[before >= 0]
        spots = np.unique(np.concatenate((left, pos[has])))
        file(spots, m.rank(sym[spots], sym[nxt[spots]]))
    alive = sym >= 0
    counts = np.concatenate(([0], np.cumsum(alive)))
    return sym[alive], np.concatenate(([0], counts[ends]))


def encode_texts(texts: list[str | None], m: Merges) -> tuple[np.ndarray, np.ndarray]:
    """ids of all texts one after the other, and the offset of each text."""
    import regex

    find = regex.compile(SPLIT).findall
    number: dict[str, int] = {}
    uses: list[np.ndarray] = []
    sizes = np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        if text:
            own = np.array([number.setdefault(w, len(number)) for w in find(text)], dtype=np.int64)
            uses.append(own)
            sizes[i] = len(own)
    ids, offsets = encode_words([w.encode("utf-8", "surrogatepass") for w in number], m)
    use = np.concatenate(uses) if uses else np.zeros(0, dtype=np.int64)
    starts, lengths = offsets[use], offsets[use + 1] - offsets[use]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    out = ids[np.arange(total) + np.repeat(starts - (ends - lengths), lengths)] if total else ids[:0]
    word_ends = np.concatenate(([0], np.cumsum(sizes)))
    return out, np.concatenate(([0], ends))[word_ends]


def encode(df: DataFrame, key: str, text: str, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """key, ids (array<int>): the ids of every text, without special tokens."""
    shared = df.sparkSession.sparkContext.broadcast(Merges.load(vocabulary))
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value

        def flush(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            texts = table.column(1).to_pylist()
            ids, offsets = encode_texts(texts, m)
            lists = pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), pa.array(ids, type=pa.int32()))
            yield from pa.table([table.column(0).combine_chunks(), lists], names=[key, "ids"]).to_batches(max_chunksize=10_000)

        held: list[pa.RecordBatch] = []
        chars = 0
        for batch in batches:
            held.append(batch)
            chars += batch.column(1).nbytes
            if chars >= STRETCH_CHARS:
                yield from flush(held)
                held, chars = [], 0
        if held:
            yield from flush(held)

    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, ids array<int>")
