"""SentencePiece encoding and decoding over a relational lattice.

Per Arrow batch: the distinct words of its texts (with the white-space mark before them), the
lattice of their substrings of bounded length as an edge table (word, start,
length), equi-joined to the piece table; the edges are grouped by word and
folded.  Unigram models are folded by Viterbi (best sum of scores).  BPE models, whose
scores are merge ranks, have no best-sum segmentation; they are folded
by merging the neighbours whose joined edge has the best rank, leftmost first,
until no joined edge exists, which is what the model defines.  Characters that
no piece covers become byte pieces (or the unknown piece).

The piece table is bounded by the model file; it is read on the driver and
broadcast.  Texts are not shuffled; words are bounded by a batch.

Defined cases: NULL or empty texts have no pieces and decode to an empty text; very long
words are folded the same way, one by one; ``decode(encode(t)) == t`` for every
text without the white-space mark U+2581 (that mark itself decodes to a blank).
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytehash import mix
from .common import bounded_batches, fresh_name, slices

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
LONG_WORD = 48
#: Folded words that a task keeps for its next batches.
KNOWN_WORDS = 300_000
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+$")
NO_RANK = np.iinfo(np.int32).max


def _roll(h: np.ndarray, code: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return h * np.uint64(0x9E3779B97F4A7C15) + code + np.uint64(1)


class PieceTable:
    """(piece, id, score) rows of a model, with byte pieces and the kind of model."""

    def __init__(self, pieces, scores, kinds, bpe: bool, unknown: int = 0):
        self.bpe, self.unknown = bpe, unknown
        normal = [i for i, k in enumerate(kinds) if k == "normal"]
        self.ids = {pieces[i]: i for i in normal}
        # rank 0 is the best score; of equal scores the lower id
        self.rank = np.full(len(pieces), NO_RANK, np.int64)
        for r, i in enumerate(sorted(normal, key=lambda i: (-scores[i], i))):
            self.rank[i] = r
        self.by_rank = np.array(sorted(normal, key=lambda i: (-scores[i], i)), np.int64)
        self.score = np.array(scores, np.float64)
        self.longest = max((len(p) for p in self.ids), default=1)
        self.byte = {int(pieces[i][3:5], 16): i for i, k in enumerate(kinds) if k == "byte"}
        back = [p.replace(MARK, " ").encode() if k == "normal" else b"" for p, k in zip(pieces, kinds)]
        for b, i in self.byte.items():
            back[i] = bytes([b])
        self.back = back
        self._place()

    def _place(self):
        """Hash table of the pieces with two places for each key."""
        keys = []
        for p in self.ids:
            h = np.zeros(1, np.uint64)
            for c in p:
                h = _roll(h, np.array([ord(c)], np.uint64))
            keys.append((int(mix(h + np.uint64(len(p) << 40))[0]), self.ids[p]))
        size = 1 << max(4, (4 * len(keys)).bit_length())
        full: dict[int, tuple[int, int]] = {}
        for one in keys:
            at = one[0] & (size - 1)
            while one is not None:                          # a key that is pushed out goes to its other place
                one, full[at] = full.get(at), one
                if one is not None:
                    first, second = one[0] & (size - 1), (one[0] >> 32) & (size - 1)
                    at = second if at == first else first
        self.mask = np.uint64(size - 1)
        self.slot_key, self.slot_id = np.zeros(size, np.uint64), np.full(size, -1, np.int32)
        for at, (k, i) in full.items():
            self.slot_key[at], self.slot_id[at] = k, i
        self.seen = np.zeros(1 << 20, bool)                     # a place for most keys that are no piece to end at
        self.seen[[(k >> 44) for k, _ in keys]] = True

    def find(self, h: np.ndarray, size: int) -> np.ndarray:
        """Ids of the pieces with these rolling hashes and this length, -1 where there is none."""
        k = mix(h + np.uint64(size << 40))
        out = np.full(k.shape, -1, np.int32)
        at = np.flatnonzero(self.seen[(k >> np.uint64(44)).view(np.int64)])
        k = k.ravel()[at]
        a, b = (k & self.mask).view(np.int64), ((k >> np.uint64(32)) & self.mask).view(np.int64)
        out.ravel()[at] = np.where(self.slot_key[a] == k, self.slot_id[a], np.where(self.slot_key[b] == k, self.slot_id[b], np.int32(-1)))
        return out

    @classmethod
    def load(cls, path: str = MODEL_FILE) -> "PieceTable":
        import sentencepiece
        m = sentencepiece.SentencePieceProcessor(model_file=path)
        n = m.get_piece_size()
        kinds = ["byte" if m.is_byte(i) else "other" if m.is_control(i) or m.is_unknown(i) or m.is_unused(i) else "normal" for i in range(n)]
        # the model type is field 3 of the trainer settings; a unigram model's scores are log probabilities
        scores = [m.get_score(i) for i in range(n)]
        normal = [s for s, k in zip(scores, kinds) if k == "normal"]
        bpe = bool(normal) and all(float(s).is_integer() for s in normal)
        return cls([m.id_to_piece(i) for i in range(n)], scores, kinds, bpe, m.unk_id())

    def of_char(self, c: str) -> list[int]:
        """Pieces of a character that is no piece itself."""
        if self.byte:
            return [self.byte.get(b, self.unknown) for b in c.encode("utf-8", "surrogatepass")]
        return [self.unknown]


def words_of(text: str) -> list[str]:
    """Words with the marks before them; a mark stands before the text and for every blank."""
    return _WORD.findall(MARK + text.replace(" ", MARK)) if text else []


def lattice(words: list[str], table: PieceTable) -> pd.DataFrame:
    """Edge table (word, start, len, id) of all substrings, of words of one length, that are pieces.

    Substrings are exploded length by length as rolling hashes and joined to the piece table by
    hash and length.
    """
    n = len(words[0])
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64).reshape(len(words), n)
    h, out = np.zeros((len(words), n), np.uint64), []
    for size in range(1, min(n, table.longest) + 1):
        h = _roll(h[:, :n - size + 1], codes[:, size - 1:])
        found = table.find(h, size)
        word, start = np.nonzero(found >= 0)
        out.append((word, start, np.full(len(word), size), found[word, start]))
    word, start, size, ids = (np.concatenate(x) for x in zip(*out))
    return pd.DataFrame({"word": word, "start": start, "len": size, "id": ids.astype(np.int64)})


def fold_merges(n: int, rank: dict[tuple[int, int], int]) -> list[tuple[int, int]]:
    """Merge order fold of one word: (start, end) segments."""
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    end = list(range(1, n + 1))
    queue = []

    def offer(i):
        j = right[i]
        if j < n:
            r = rank.get((i, end[j]))
            if r is not None:
                heapq.heappush(queue, (r, i, end[i], end[j]))

    for i in range(n - 1):
        offer(i)
    alive = [True] * n
    while queue:
        _, i, mid, stop = heapq.heappop(queue)
        if not alive[i] or end[i] != mid or right[i] >= n or end[right[i]] != stop:
            continue
        j = right[i]
        alive[j] = False
        end[i], right[i] = stop, right[j]
        if right[j] < n:
            left[right[j]] = i
        offer(i)
        if left[i] >= 0:
            offer(left[i])
    out, i = [], 0
    while i < n:
        out.append((i, end[i]))
        i = right[i]
    return out


def fold_best(n: int, score: dict[tuple[int, int], float], unknown: float) -> list[tuple[int, int]]:
    """Viterbi fold of one word: segments of the best sum; of equal sums the longest last piece."""
    best, back = [0.0] + [-np.inf] * n, [0] * (n + 1)
    into: dict[int, list] = {}
    for (i, j), s in score.items():
        into.setdefault(j, []).append((i, s))
    for j in range(1, n + 1):
        edges = sorted(into.get(j, []))
        if not any(i == j - 1 for i, _ in edges):
            edges.append((j - 1, unknown))
        for i, s in edges:
            if best[i] + s > best[j]:
                best[j], back[j] = best[i] + s, i
    out, j = [], n
    while j > 0:
        out.append((back[j], j))
        j = back[j]
    return out[::-1]


def _fold_bulk(words: list[str], edges: pd.DataFrame, table: PieceTable) -> tuple[np.ndarray, np.ndarray]:
    """The merge fold of many short words of one length at once: (ids of all words, their number per word)."""
    n, m = len(words[0]), len(words)
    # rank of the edge [start, start + len) of every word
    grid = np.full((m, n + 1, n + 2), NO_RANK, np.int32)
    grid[edges["word"], edges["start"], edges["len"]] = table.rank[edges["id"].to_numpy()]
    following = np.tile(np.arange(1, n + 2), (m, 1))        # start of the next segment
    before = np.tile(np.arange(-1, n), (m, 1))              # start of the segment before
    is_start = np.ones((m, n), bool)
    rank = np.full((m, n), NO_RANK, np.int32)               # of the segment that starts here joined with the next
    rank[:, :-1] = grid[:, :n - 1, 2]
    todo = np.arange(m)
    while len(todo):
        at = np.argmin(rank[todo], 1)                       # least rank, leftmost
        ok = rank[todo, at] < NO_RANK
        todo, at = todo[ok], at[ok]
        mid = following[todo, at]
        end = following[todo, mid]
        is_start[todo, mid] = False
        rank[todo, mid] = NO_RANK
        following[todo, at] = end
        before[todo, end] = at
        # only the joined segment and the one before it have a new neighbour
        rank[todo, at] = grid[todo, at, np.where(end < n, following[todo, end] - at, n + 1)]
        left = before[todo, at]
        some = left >= 0
        rank[todo[some], left[some]] = grid[todo[some], left[some], end[some] - left[some]]
    w, i = np.nonzero(is_start)
    r = grid[w, i, following[w, i] - i]
    ids = table.by_rank[np.minimum(r, len(table.by_rank) - 1)].astype(np.int32)
    times = np.ones(len(w), np.int64)
    bare = np.flatnonzero(r >= NO_RANK)                     # single characters without a piece
    if len(bare):
        made = [table.of_char(words[x][y]) for x, y in zip(w[bare].tolist(), i[bare].tolist())]
        times[bare] = [len(x) for x in made]
        ids = np.repeat(ids, times)
        start = (np.cumsum(times) - times)[bare]
        size = times[bare]
        ids[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())] = list(chain.from_iterable(made))
    return ids, np.bincount(w, times, m).astype(np.int64)


def fold_words(words: list[str], table: PieceTable) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    """(some of the words, their ids one after the other, number of ids per word)."""
    by_length: dict[int, list[str]] = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    for n, group in by_length.items():
        step = max(1, 2_000_000 // ((n + 1) * (n + 2)))
        for k in range(0, len(group), step):
            some = group[k:k + step]
            edges = lattice(some, table)
            if table.bpe and n <= LONG_WORD:
                yield some, *_fold_bulk(some, edges, table)
                continue
            per = dict(tuple(edges.groupby("word")))
            out = []
            for x, w in enumerate(some):
                e = per.get(x)
                keys = list(zip(e["start"], e["start"] + e["len"])) if e is not None else []
                ids = dict(zip(keys, e["id"])) if e is not None else {}
                if table.bpe:
                    cut = fold_merges(n, {q: int(table.rank[p]) for q, p in ids.items()})
                else:
                    cut = fold_best(n, {q: table.score[p] for q, p in ids.items()}, float(table.score.min()) - 10)
                out.append(list(chain.from_iterable([ids[q]] if q in ids else chain.from_iterable(map(table.of_char, w[q[0]:q[1]])) for q in cut)))
            yield some, np.array(list(chain.from_iterable(out)), np.int32), np.array([len(x) for x in out], np.int64)


def encode_words(words: list[str], table: PieceTable) -> dict[str, np.ndarray]:
    """Word -> ids."""
    out: dict[str, np.ndarray] = {}
    for some, ids, size in fold_words(words, table):
        upto = np.cumsum(size).tolist()
        out.update(zip(some, [ids[a:b] for a, b in zip([0, *upto], upto)]))
    return out


class Known:
    """Folded words: a number per word, and the ids of all words in one array."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.ids, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def add(self, words: list[str], table: PieceTable) -> None:
        parts, sizes = [self.ids], [self.size]
        for some, ids, size in fold_words(words, table):
            self.number.update(zip(some, range(len(self.number), len(self.number) + len(some))))
            parts.append(ids)
            sizes.append(size)
        self.ids, self.size = np.concatenate(parts), np.concatenate(sizes)

    def of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of these word numbers one after the other, number of ids per word)."""
        size = self.size[words]
        start = (np.cumsum(self.size) - self.size)[words]
        return self.ids[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())], size


def encode_texts(texts: list[str], table: PieceTable, known: Known | None = None) -> list[np.ndarray]:
    """ids per text; ``known`` keeps the folded words of earlier texts (KNOWN_WORDS at most)."""
    split = [words_of(t) for t in texts]
    known = Known() if known is None else known
    if len(known.number) > KNOWN_WORDS:
        known.__init__()
    known.add(list(set(chain.from_iterable(split)).difference(known.number)), table)
    count = np.array([len(ws) for ws in split], np.int64)
    ids, size = known.of(np.fromiter(map(known.number.__getitem__, chain.from_iterable(split)), np.int64, count.sum()))
    upto = np.concatenate([[0], np.cumsum(size)])[np.cumsum(count)].tolist()
    return [ids[a:b] for a, b in zip([0, *upto], upto)]


def decode_ids(ids, table: PieceTable) -> str:
    ids = np.asarray(ids, np.int64)
    if len(ids) and (ids.min() < 0 or ids.max() >= len(table.back)):
        ids = ids[(ids >= 0) & (ids < len(table.back))]
    raw = b"".join(map(table.back.__getitem__, ids.tolist()))
    return raw[1:].decode("utf-8", "replace") if raw[:1] == b" " else raw.decode("utf-8", "replace")


def encode(docs: DataFrame, table: PieceTable, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` plus ``ids_col`` (array<int>)."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = Known()
        for text in batches:
            texts, out = [t or "" for t in text], []
            for a, b in slices(np.array([len(t) for t in texts])):
                out += encode_texts(texts[a:b], shared.value, known)
            yield pd.Series(out, dtype=object)

    return docs.withColumn(ids_col, ids(F.col(text_col)))


def decode(docs: DataFrame, table: PieceTable, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``docs`` with ``text_col`` made from ``ids_col``; NULL ids give an empty text, unknown ids nothing."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        return pd.Series([decode_ids(x, shared.value) if x is not None else "" for x in ids], dtype=object)

    return docs.withColumn(text_col, text(F.col(ids_col)))


def encode_with_check(docs: DataFrame, table: PieceTable) -> DataFrame:
    """``docs`` plus ids, n_pieces and round_trip (whether decoding gives the text back).

    Both directions run in one Python worker per task, which holds one copy of the pieces.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("ids array<int>, round_trip boolean")
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = Known()
        for text in batches:
            texts, out = [t or "" for t in text], []
            for a, b in slices(np.array([len(t) for t in texts])):
                out += encode_texts(texts[a:b], shared.value, known)
            same = [decode_ids(x, shared.value) == t for x, t in zip(out, texts)]
            yield pd.DataFrame({"ids": pd.Series(out, dtype=object), "round_trip": pd.Series(same, dtype=bool)})

    made = fresh_name(docs, "encoded")
    out = docs.withColumn(made, both(F.col("text")))
    return out.withColumns({"ids": F.col(made)["ids"], "n_pieces": F.size(F.col(made)["ids"]).cast("long"),
                            "round_trip": F.col(made)["round_trip"]}).drop(made)
