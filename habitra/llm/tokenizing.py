"""Byte-pair encoding shared by the operators that need token ids.

``TrieBPE`` is an encoder of its own: it inserts the distinct words of a batch
in a trie and walks it depth first.  Each node keeps the last token of the
encoding of its prefix, so a prefix that many words share is worked out once.
``ChunkEncoder`` lets the tokenizers library encode each distinct chunk of a
worker's texts once and joins the ids.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterable

import regex

#: Fixed value: the split pattern of byte-level tokenizers.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Entries a worker's word cache holds before it starts anew; it changes memory and speed, never ids.
CACHE_WORDS = 700_000
#: Words that go in one trie.
TRIE_WORDS = 20_000


def byte_alphabet() -> dict[str, int]:
    """Printable stand-in -> byte: printable Latin-1 stands for itself, the rest follows from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class TrieBPE:
    """Byte-level BPE of a tokenizer file, encoded over a trie of distinct words.

    A sequence of tokens is the encoding of its text exactly if no merge would
    cross any of its token borders.  So each prefix has one last token: the one
    token that ends there and follows the last token of the shorter prefix.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") or spec.get("normalizer"):
            raise ValueError(f"{path}: not a plain byte-level BPE")
        alphabet = byte_alphabet()
        vocab: dict[str, int] = model["vocab"]
        # words and tokens are handled as strings of code points below 256, one for each byte
        self.text = {i: "".join(chr(alphabet[c]) for c in t) for t, i in vocab.items()}
        self.bytes = {i: t.encode("latin-1") for i, t in self.text.items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes |= {i: t.encode() for t, i in self.special.items()}
        self.special_split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pair_rank: dict[tuple[int, int], int] = {}
        self.rank = dict.fromkeys(self.text, -1)
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        for k, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            whole = vocab[a + b]
            self.pair_rank[vocab[a], vocab[b]] = k
            if whole not in self.left:
                self.rank[whole], self.left[whole], self.right[whole] = k, vocab[a], vocab[b]
        self.ending: dict[str, int] = {}  # each end of a token -> the token's id, or -1 where only longer tokens end so
        for i, t in self.text.items():
            for k in range(1, len(t)):
                self.ending.setdefault(t[k:], -1)
            self.ending[t] = i if self.rank[i] < 0 or self._stays(self.left[i], self.right[i], self.rank[i]) else -1
        self.pairs: dict[tuple[int, int], bool] = {}
        self.cache: dict[str, bytes] = {}

    def _stays(self, a: int, b: int, limit: float = float("inf")) -> bool:
        """Whether no merge before the one ranked ``limit`` crosses the border of the tokens a and b."""
        while True:
            across = self.pair_rank.get((a, b))
            if across is not None and across < limit:
                return False
            ra, rb = self.rank[a], self.rank[b]
            if ra > rb:  # undo the later merge; of equal merges the left one comes first
                limit, a = ra, self.right[a]
            elif rb >= 0:
                limit, b = rb + 1, self.left[b]
            else:
                return True

    def _follows(self, a: int, b: int) -> bool:
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) > 500_000:
                self.pairs.clear()
            known = self.pairs[a, b] = self._stays(a, b)
        return known

    def encode_words(self, words: Iterable[str]) -> dict[str, list[int]]:
        """Ids of each word (a string of code points below 256), by one walk over the words' trie."""
        root: dict = {}
        for w in words:
            node = root
            for c in w:
                node = node.setdefault(c, {})
            node[None] = w
        out: dict[str, list[int]] = {}
        ending, follows, text = self.ending, self._follows, self.text
        last = [-1]  # by depth of the path: the last token of the prefix that ends there
        path = ""
        stack = [(root, 0, "")]
        while stack:
            node, depth, c = stack.pop()
            if depth:
                path = path[: depth - 1] + c
                del last[depth:]
                found, k = -1, 1
                while k <= depth:
                    token = ending.get(path[depth - k :])
                    if token is None:
                        break
                    if token >= 0 and (k == depth or follows(last[depth - k], token)):
                        found = token
                        break
                    k += 1
                if found < 0:
                    raise ValueError("no token fits; the vocabulary lacks a byte or a merge's part")
                last.append(found)
            for c, child in node.items():
                if c is None:
                    ids, at = [], depth
                    while at:
                        ids.append(last[at])
                        at -= len(text[last[at]])
                    out[child] = ids[::-1]
                else:
                    stack.append((child, depth + 1, c))
        return out

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        find = _pattern().findall
        cut: list[list[str]] = []
        for t in texts:
            if self.special_split and any(s in t for s in self.special):
                cut.append([x for i, part in enumerate(self.special_split.split(t)) for x in ([part] if i % 2 else find(part))])
            else:
                cut.append(find(t))
        out = []
        for words in cut:
            try:
                out.append(b"".join([self.cache[w] for w in words]))
            except KeyError:
                self._learn(cut[len(out) :] if len(out) == 0 else cut[len(out) : len(out) + 256])
                out.append(b"".join([self.cache[w] for w in words]))
        return out

    def _learn(self, cut: list[list[str]]) -> None:
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        new = set().union(*cut).difference(self.cache)
        self.cache |= {s: struct.pack("<I", i) for s, i in self.special.items() if s in new}
        todo = [w for w in new if w not in self.special]
        for k in range(0, len(todo), TRIE_WORDS):
            part = {w.encode().decode("latin-1"): w for w in todo[k : k + TRIE_WORDS]}
            self.cache |= {part[w]: struct.pack(f"<{len(ids)}I", *ids) for w, ids in self.encode_words(part).items()}

    def decode(self, ids: Iterable[int]) -> str:
        """Text of ids; bytes that aren't UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


def _pattern(compiled=[]):  # noqa: B006  compiled once in each worker
    if not compiled:
        compiled.append(regex.compile(BYTE_LEVEL_PATTERN))
    return compiled[0]


class ChunkEncoder:
    """The tokenizers library's ids of whole texts, with each distinct chunk encoded once.

    In a text of ASCII and Latin-1 letters the chunks are the tokenizer's own
    words (runs of letters, digits, runs of other signs), lowered here, and the
    library's model splits each; with an apostrophe, other signs or what may be a
    special token the chunks end at white space, and go through the whole
    tokenizer.  The tokenizer must drop white space, lower-case its text and
    never join signs across these borders, as word-level files do.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if "Lowercase" not in str(spec["normalizer"]) or "Removed" not in str(spec["pre_tokenizer"]) or "ByteLevel" not in str(spec["pre_tokenizer"]):
            raise ValueError(f"{path}: not a tokenizer that lower-cases and drops white space")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.words: dict[bytes, bytes] = {}
        self.chunks: dict[bytes, bytes] = {}
        self.word = re.compile(rb"[a-z\x80-\xff]+|[0-9]|[^a-z0-9\x80-\xff\s]+")
        self.other = re.compile("[^\x00-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]")
        self.stand_in = {b: c for c, b in byte_alphabet().items()}

    def cut(self, text: str) -> tuple[bool, list[bytes]]:
        """Whether the chunks are words, and the chunks."""
        raw = text.encode()
        if b"<|" in raw:  # may be a special token, whose case counts
            return False, raw.split()
        raw = raw.lower()
        if b"'" not in raw and (text.isascii() or not self.other.search(text)):
            return True, self.word.findall(raw)
        return False, raw.split()

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cuts = [self.cut(t) for t in texts]
        out: list[bytes] = []
        for are_words, chunks in cuts:
            known = self.words if are_words else self.chunks
            try:
                out.append(b"".join([known[w] for w in chunks]))
            except KeyError:
                self._learn(cuts if not out else cuts[len(out) : len(out) + 256])
                out.append(b"".join([known[w] for w in chunks]))
        return out

    def _learn(self, cuts: list[tuple[bool, list[bytes]]]) -> None:
        if len(self.words) + len(self.chunks) > CACHE_WORDS:
            self.words.clear()
            self.chunks.clear()
        tokenize, stand_in, pack = self.model.tokenize, self.stand_in, struct.pack
        for w in set().union(*[c for are_words, c in cuts if are_words]).difference(self.words):
            low = w.decode("latin-1") if w.isascii() else w.decode().lower().encode().decode("latin-1")
            ids = [t.id for t in tokenize(low.translate(stand_in))]
            self.words[w] = pack(f"<{len(ids)}I", *ids)
        new = list(set().union(*[c for are_words, c in cuts if not are_words]).difference(self.chunks))
        for w, e in zip(new, self.tokenizer.encode_batch_fast([w.decode() for w in new], add_special_tokens=False)):
            self.chunks[w] = pack(f"<{len(e.ids)}I", *e.ids)


_made: dict[tuple[type, str], object] = {}


def encoder(kind: type, path: str):
    """One encoder for each Python worker and file."""
    if (kind, path) not in _made:
        _made[kind, path] = kind(path)
    return _made[kind, path]
