"""Operator 6: token counts of a unigram model, over a trie of distinct words.

A word's count is the number of pieces of its best segmentation: the one with
the greatest sum of log probabilities.  Workers insert the words they haven't
met in a trie; a node's best score extends those of its ancestors by the pieces
that end there, so a prefix that many words share is scored once, and the end of
a word stores its count.  Tries of words of up to ``LEVEL_CHARS`` code points
are scored level by level, a level at a time in numpy; longer words have a trie of
their own, walked depth first, with the same result.  A text's count is the sum
over its words.  No shuffle; memory is bounded by the word cache and one batch.

The pieces come from a sentencepiece file.  Their probabilities are fitted on
the whole corpus (``fit``): all words are counted, and in each round the pieces
of the words' best segmentations give new probabilities, each piece counted once
more than it was met; the first round starts from Zipf's law over the file's
order, 1 / (rank + 2.7).  Words are runs without ASCII white space, with the
file's word mark before them.  A code point that no piece covers is one token.
Of segmentations with equal scores the one with fewer pieces counts.

Cases: null and empty texts have no words and no tokens; a null doc_id stays
null; repeated rows give a row each; an empty table gives an empty result.
Other columns of the input are left out.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from habitra.llm.common import map_batches, materialise, small_batches, strings, text_of
from habitra.llm.tokenizing import CACHE_WORDS, encoder

WORD_MARK = "▁"
UNKNOWN = -30.0
#: Words that go in one trie.
TRIE_WORDS = 100_000
#: Code points of the longest words that are scored by level; each level costs a few calls, however few its nodes.
LEVEL_CHARS = 200
#: Code points of the words of one trie that is scored by level, which has at most as many nodes of some 50 bytes.
TRIE_CHARS = 2_000_000


class Endings:
    """Pieces read from their last code point on: states, and an open-addressed table of (state, code point) -> state."""

    BITS, NONE = 21, np.uint64(2**64 - 1)  # a code point has 21 bits
    SPREAD = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, scores: dict[str, float]):
        to: dict[int, int] = {}
        self.score = [-math.inf]  # by state; of those where only longer pieces end, minus infinity
        self.piece: list[str | None] = [None]
        for t, s in scores.items():
            at = 0
            for c in reversed(t):
                at = to.setdefault(at << self.BITS | ord(c), len(self.score))
                if at == len(self.score):
                    self.score.append(-math.inf)
                    self.piece.append(None)
            self.score[at], self.piece[at] = s, t
        self.score = np.array(self.score)
        size = max(4, (8 * len(to)).bit_length())
        self.shift, self.last = np.uint64(64 - size), np.uint64(2**size - 1)
        self.keys, self.to = np.full(2**size, self.NONE), np.full(2**size, -1, np.int64)
        key, value = np.fromiter(to, np.uint64, len(to)), np.fromiter(to.values(), np.int64, len(to))
        slot = key * self.SPREAD >> self.shift
        while key.size:  # the first of those that want a free slot gets it, the others go on to the next
            free = np.flatnonzero(self.keys[slot] == self.NONE)
            won = free[np.unique(slot[free], return_index=True)[1]]
            self.keys[slot[won]], self.to[slot[won]] = key[won], value[won]
            key, value, slot = np.delete(key, won), np.delete(value, won), np.delete(slot, won) + np.uint64(1) & self.last

    def step(self, state: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The states after one more code point to the left, -1 where no piece ends so."""
        key = state.astype(np.uint64) << np.uint64(self.BITS) | char
        slot = key * self.SPREAD >> self.shift
        found = self.keys[slot]
        go = np.flatnonzero((found != key) & (found != self.NONE))
        while go.size:
            slot[go] = slot[go] + np.uint64(1) & self.last
            found[go] = self.keys[slot[go]]
            go = go[(found[go] != key[go]) & (found[go] != self.NONE)]
        return np.where(found == key, self.to[slot], -1)


class TrieUnigram:
    """Counts of pieces in best segmentations under a unigram model."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        own = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        self.load({sp.id_to_piece(i): -math.log(k + 2.7) for k, i in enumerate(own)})

    @classmethod
    def of(cls, scores: dict[str, float]) -> TrieUnigram:
        """A model of given log probabilities; the last one is kept by worker."""
        key = hash(frozenset(scores.items()))
        if cls._last is None or cls._last[0] != key:
            made = cls.__new__(cls)
            made.load(scores)
            cls._last = (key, made)
        return cls._last[1]

    _last: tuple[int, TrieUnigram] | None = None

    def load(self, scores: dict[str, float]) -> None:
        self.scores = scores
        self.ending: dict[str, float | None] = {}  # each end of a piece -> its score, None where only longer pieces end so
        for t in scores:
            for k in range(1, len(t)):
                self.ending.setdefault(t[k:], None)
        self.ending |= scores
        self.states = Endings(scores)
        self.cache: dict[bytes, int] = {}

    def count_words(self, words: Iterable[str]) -> dict[str, int]:
        """Tokens of each word, by the words' tries."""
        short, long = self._by_length(words)
        out = {w: -best[depth][1] for w, depth, best, _ in self._walk(long)}
        for part in self._parts(short):
            at, pieces, _, _ = self._levels(part)
            out.update(zip(part, (-pieces[at]).tolist()))
        return out

    def piece_counts(self, n: dict[str, int]) -> Counter[str]:
        """How often each piece stands in the best segmentations of words that were met ``n`` times; code points without a piece are left out."""
        short, long = self._by_length(n)
        met: Counter[str] = Counter()
        for w, pieces in self.segment_words(long).items():
            for p in pieces:
                if p in self.scores:
                    met[p] += n[w]
        total = np.zeros(len(self.states.score), np.int64)
        for part in self._parts(short):
            at, _, back, state = self._levels(part)
            weight = np.array([n[w] for w in part], np.int64)
            while at.size:
                np.add.at(total, state[at], weight)
                at = back[at]
                at, weight = at[at > 0], weight[at > 0]
        met.update({self.states.piece[i]: int(total[i]) for i in np.flatnonzero(total) if i})
        return met

    @staticmethod
    def _by_length(words: Iterable[str]) -> tuple[list[str], list[str]]:
        """Words for the levels, in order, and longer ones."""
        short, long = [], []
        for w in words:
            (short if len(w) <= LEVEL_CHARS else long).append(w)
        return sorted(short), long

    @staticmethod
    def _parts(words: list[str]) -> Iterator[list[str]]:
        """The words of one trie after another."""
        first = size = 0
        for k, w in enumerate(words):
            if size and size + len(w) > TRIE_CHARS:
                yield words[first:k]
                first, size = k, 0
            size += len(w)
        if size:
            yield words[first:]

    def _levels(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The trie of sorted distinct words, scored by level: the node of each word's end; by node, minus its pieces, the node before its last piece, and that piece's state, 0 for a code point without one."""
        length = np.fromiter(map(len, words), np.int64, len(words))
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        start = np.cumsum(length) - length
        char, parent, back, state, pieces = np.zeros(len(chars) + 1, np.uint64), *np.zeros((3, len(chars) + 1), np.int64), np.zeros(len(chars) + 1, np.int32)
        best = np.zeros(len(chars) + 1)  # of the node's prefix; node 0 is the root
        end, score = np.zeros(len(words), np.int64), self.states.score
        top, active = 1, np.arange(len(words))
        for depth in range(int(length.max())):
            active = active[length[active] > depth]
            c, p = chars[start[active] + depth], end[active]
            new = np.ones(len(active), bool)  # words of one prefix stand together
            new[1:] = (c[1:] != c[:-1]) | (p[1:] != p[:-1])
            end[active] = top - 1 + np.cumsum(new)
            low, top = top, top + int(new.sum())
            char[low:top], parent[low:top] = c[new], p[new]
            node, at, s = np.arange(low, top), np.arange(low, top), np.zeros(top - low, np.int64)
            best[low:top] = -math.inf
            for k in range(depth + 1):
                s = self.states.step(s, char[at])
                at = parent[at]
                if k == 0:
                    alone = np.flatnonzero((s < 0) | (score[s] == -math.inf))
                    best[low + alone], pieces[low + alone], back[low + alone] = best[at[alone]] + UNKNOWN, pieces[at[alone]] - 1, at[alone]
                on = s >= 0
                node, at, s = node[on], at[on], s[on]
                if not node.size:
                    break
                sum_, n = best[at] + score[s], pieces[at] - 1
                better = (sum_ > best[node]) | (sum_ == best[node]) & (n > pieces[node]) & (score[s] > -math.inf)
                x = node[better]
                best[x], pieces[x], back[x], state[x] = sum_[better], n[better], at[better], s[better]
        return end, pieces, back, state

    def segment_words(self, words: Iterable[str]) -> dict[str, list[str]]:
        """The tokens themselves of each word."""
        out = {}
        for w, at, _, last in self._walk(words):
            pieces = out[w] = []
            while at:
                pieces.append(w[at - last[at] : at])
                at -= last[at]
            pieces.reverse()
        return out

    def _walk(self, words: Iterable[str]) -> Iterator[tuple[str, int, list[tuple[float, int]], list[int]]]:
        """Each word with its length, and by length of its prefixes: best score and minus its pieces, and the last piece's length."""
        root: dict = {}
        for w in words:
            node = root
            for c in w:
                node = node.setdefault(c, {})
            node[None] = w
        ending = self.ending
        best: list[tuple[float, int]] = [(0.0, 0)]  # by depth of the path: best score, and minus its pieces
        last = [0]  # and the length of the last of them
        path = ""
        stack = [(root, 0, "")]
        while stack:
            node, depth, c = stack.pop()
            if depth:
                path = path[: depth - 1] + c
                del best[depth:], last[depth:]
                score, pieces = best[depth - 1]
                size = 1
                top = (score + UNKNOWN, pieces - 1) if ending.get(c) is None else (-math.inf, 0)
                k = 1
                while k <= depth and (end := path[depth - k :]) in ending:
                    if (s := ending[end]) is not None:
                        score, pieces = best[depth - k]
                        if (score + s, pieces - 1) > top:
                            top, size = (score + s, pieces - 1), k
                    k += 1
                best.append(top)
                last.append(size)
            for c, child in node.items():
                if c is None:
                    yield child, depth, best, last
                else:
                    stack.append((child, depth + 1, c))

    def count_texts(self, texts: list[str]) -> list[tuple[int, int]]:
        """Words and tokens of each text."""
        cut = [t.encode().split() for t in texts]
        new = list(set().union(*cut).difference(self.cache))
        if len(self.cache) + len(new) > CACHE_WORDS:
            self.cache.clear()
            new = list(set().union(*cut))
        for k in range(0, len(new), TRIE_WORDS):
            part = {WORD_MARK + w.decode(): w for w in new[k : k + TRIE_WORDS]}
            self.cache |= {part[w]: n for w, n in self.count_words(part).items()}
        return [(len(words), sum([self.cache[w] for w in words])) for words in cut]


#: Distinct words that a task counts before it hands them on.
HELD_WORDS = 200_000


def word_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``word`` (with the mark) and ``n`` of all whole texts; each task adds up its own first."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def out() -> Iterator[pa.RecordBatch]:
            words = list(held.items())
            for at in range(0, len(words), 10_000):
                part = words[at : at + 10_000]
                yield pa.RecordBatch.from_pydict({"word": [WORD_MARK + w.decode() for w, _ in part], "n": pa.array([n for _, n in part], pa.int64())})
            held.clear()

        for b in batches:
            for t in strings(b, "text"):
                held.update(t.encode().split())
                if len(held) > HELD_WORDS:
                    yield from out()
        yield from out()

    counted = df.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def fit(df: DataFrame, model: str, rounds: int = 2, text_col: str = "text") -> dict[str, float]:
    """Log probabilities of the file's pieces for the texts of ``df``, by ``rounds`` of counting the pieces of best segmentations.

    Words are counted once over the whole corpus; what comes to the driver is a
    number for each piece.  Without words the starting probabilities stay.
    """
    words = materialise(word_counts(df, text_col), "word-counts")
    scores = TrieUnigram(model).scores
    for _ in range(rounds):
        sent = df.sparkSession.sparkContext.broadcast(scores)  # as many as the file has pieces

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            unigram, held = TrieUnigram.of(sent.value), Counter()
            n: dict[str, int] = {}

            def add() -> None:
                held.update(unigram.piece_counts(n))
                n.clear()

            for b in batches:
                n.update(zip(b.column("word").to_pylist(), b.column("n").to_pylist()))
                if len(n) >= TRIE_WORDS:
                    add()
            add()
            yield pa.RecordBatch.from_pydict({"piece": pa.array(list(held), pa.string()), "n": pa.array(list(held.values()), pa.int64())})

        met = {r["piece"]: r["n"] for r in words.mapInArrow(run, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n")).collect()}
        if not met:
            break
        total = math.log(sum(met.values()) + len(scores))
        scores = {p: math.log(met.get(p, 0) + 1) - total for p in scores}
    return scores


def token_counts(df: DataFrame, model: str, scores: dict[str, float] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, ``n_tokens`` of every whole text, by the model's pieces with fitted ``scores``, or as the file orders them."""
    sent = df.sparkSession.sparkContext.broadcast(scores)

    def make():
        unigram = TrieUnigram.of(sent.value) if sent.value else encoder(TrieUnigram, model)

        def rows(b: pa.RecordBatch) -> dict:
            counts = unigram.count_texts(strings(b, "text"))
            return {"doc_id": b.column("doc_id"), "n_words": [x for x, _ in counts], "n_tokens": [x for _, x in counts]}

        return rows

    return map_batches(text_of(df, id_col, text_col), make, "doc_id long, n_words long, n_tokens long")
