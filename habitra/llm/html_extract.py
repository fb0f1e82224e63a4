"""Operator 3: main text of web pages by a recurrent block labeller.

A page is cut in blocks: the leaf texts between block-level tags.  Each block
gets the mean vector of its tag path (tags, classes, ids and roles, hashed), the
mean vector of its hashed words, and a few measures (length, share of links,
punctuation, place on the page).  A bidirectional LSTM in numpy reads the blocks
of the whole page in both directions and labels each as article or not, so a
block is judged with all that stands before and after it.  The weights come
from ``html_train.py``, which makes its own pages; they are a file of this
package.

Cases: a null or empty page, or one without article blocks, has the empty text;
broken markup (tags left open, quotes left open, no body) is read as far as it
goes, a head that isn't closed ends at the first tag that can't stand in it; text in scripts, styles, comments, templates and the head is never a
block; repeated rows give a row each; pages of any length are read whole; an
empty table gives an empty result.  Other columns are left out.
"""

from __future__ import annotations

import html
import re
import zlib
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from habitra.llm.common import map_batches, strings

PATH_BUCKETS, PATH_DIM = 1024, 16
WORD_BUCKETS, WORD_DIM = 1024, 8
MEASURES = 9
HIDDEN = 24
WEIGHTS = Path(__file__).with_name("html_lstm.npz")
#: Blocks times pages that go through the network at once.
CELLS = 60_000

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|title|textarea|iframe)\b[^>]*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[^>])*+)>|<[!?/][^>]*+>|([^<]++|<)",
    re.S | re.I,
)
_NAMES = re.compile(r"\b(class|id|role|aria-label|style|hidden)\b\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
#: Tags that don't end a block; all others do.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Text inside these is never shown or never text.
UNSEEN = frozenset("head template noscript svg select object".split())
#: What may stand in a head; any other tag that starts ends it.
IN_HEAD = frozenset("title meta link script style base noscript template html head".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A tag that starts ends open ones of these kinds at the top of the path.
_CLOSES = {"p": ("p",), "li": ("li", "p"), "dt": ("dd", "dt", "p"), "dd": ("dd", "dt", "p"), "tr": ("td", "th", "tr", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p"), "option": ("option",)} | {t: ("p",) for t in "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul figure".split()}


class Node:
    """An open element: its names (tag, then parts of its attributes), its parent, and what is known of the path down to it."""

    __slots__ = ("input", "names", "parent", "size", "tail", "total")

    def __init__(self, names: tuple[str, ...], parent: Node | None):
        self.names, self.parent = names, parent
        self.tail = ((parent.tail if parent else ()) + names)[-3:]
        self.total: np.ndarray | None = None  # of the vectors of all names on the path
        self.size = 0
        self.input: np.ndarray | None = None

    def path(self) -> tuple[str, ...]:
        """All names from the outermost element on."""
        out, at = [], self
        while at:
            out.append(at.names)
            at = at.parent
        return tuple(x for names in reversed(out) for x in names)


class Block:
    """A leaf text with the element that holds it and the share of its characters in links."""

    __slots__ = ("linked", "node", "text")

    def __init__(self, text: str, node: Node | None, linked: float):
        self.text, self.node, self.linked = text, node, linked

    @property
    def path(self) -> tuple[str, ...]:
        return self.node.path() if self.node else ()


def _names(tag: str, attributes: str) -> tuple[str, ...]:
    out = [tag]
    for m in _NAMES.finditer(attributes):
        kind, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if kind == "hidden":
            out.append("=hidden")
        elif kind == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                out.append("=hidden")
        else:
            out += ["." + x.lower() for x in _PART.findall(value)]
    return tuple(out)


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order, their references decoded and their white space made single."""
    out: list[Block] = []
    path: list[Node] = []
    opened: dict[str, int] = {}
    parts: list[str] = []
    in_links = link = unseen = 0
    lower = page.lower()
    closed_last = {t: lower.rfind(f"</{t}") for t in UNSEEN}  # an element that never ends hides nothing

    def end() -> None:
        nonlocal in_links
        text = " ".join(html.unescape("".join(parts)).split())
        if text and not unseen:
            out.append(Block(text, path[-1] if path else None, min(1.0, in_links / max(1, len(text)))))
        parts.clear()
        in_links = 0

    def leave() -> str:
        nonlocal unseen
        tag = path.pop().names[0]
        opened[tag] -= 1
        unseen -= tag in UNSEEN
        return tag

    for m in _TOKEN.finditer(page):
        text = m[5]
        if text is not None:
            parts.append(text)
            if link:
                in_links += len(text)
            continue
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "br" or tag == "img":
                parts.append(" ")
            elif tag == "a":
                link = 0 if m[2] else 1
            continue
        end()
        if m[2]:
            if opened.get(tag):
                while leave() != tag:
                    pass
        else:
            if opened.get("head") and tag not in IN_HEAD:
                while leave() != "head":
                    pass
            if tag not in VOID and not (tag in UNSEEN and tag != "head" and closed_last[tag] < m.end()):
                for closed in _CLOSES.get(tag, ()):
                    if path and path[-1].names[0] == closed:
                        leave()
                path.append(Node(_names(tag, m[4] or ""), path[-1] if path else None))
                opened[tag] = opened.get(tag, 0) + 1
                unseen += tag in UNSEEN
        link = 0
    end()
    return out


@lru_cache(maxsize=200_000)
def _bucket(word: str, buckets: int) -> int:
    return zlib.crc32(word.encode()) % buckets


def path_buckets(b: Block) -> list[int]:
    """Buckets of all names on a block's path, and once more of the last three as such."""
    tail = b.node.tail if b.node else ()
    return [_bucket(x, PATH_BUCKETS) for x in (*b.path, *("^" + x for x in tail))] or [0]


def features(page: list[Block]) -> tuple[list[list[int]], np.ndarray]:
    """For each block: buckets of its words, and its measures."""
    words, n = [], len(page)
    measures = np.zeros((n, MEASURES), np.float32)
    sizes = [len(b.text) for b in page]
    total, before = max(sum(sizes), 1), 0
    for i, b in enumerate(page):
        w = b.text.lower().split()
        words.append([_bucket(x.strip(".,;:!?()\"'"), WORD_BUCKETS) for x in w])
        stops = b.text.count(".") + b.text.count("!") + b.text.count("?")
        measures[i] = (np.log1p(len(w)) / 5, b.linked, min(1.0, 5 * stops / max(len(w), 1)), i / n, before / total, sizes[i] / total, min(1.0, np.log1p(n) / 6), b.text[-1] in ".!?:…\"'”)", "©" in b.text)
        before += sizes[i]
    return words, measures


def _mean(table: np.ndarray, lists: list[list[int]]) -> np.ndarray:
    sizes = np.array([len(x) for x in lists])
    flat = table[np.concatenate([np.asarray(x, np.int64) for x in lists])]
    return (np.add.reduceat(flat, np.concatenate([[0], np.cumsum(sizes)[:-1]]), axis=0) / sizes[:, None]).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Labeller:
    """The trained network."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = {k: np.asarray(v, np.float32) for k, v in weights.items()}

    @classmethod
    def load(cls) -> Labeller:
        with np.load(WEIGHTS) as f:
            return cls(dict(f))

    def _path(self, node: Node | None) -> np.ndarray:
        """The mean vector of a path's names: its parent's sum and its own names, so that a deep path isn't read again for each block."""
        table = self.w["path"]
        if node is None:
            return table[0]
        if node.input is None:
            chain = []
            at: Node | None = node
            while at and at.total is None:
                chain.append(at)
                at = at.parent
            for x in reversed(chain):
                own = table[[_bucket(k, PATH_BUCKETS) for k in x.names]].sum(0)
                x.total = own + x.parent.total if x.parent else own
                x.size = len(x.names) + (x.parent.size if x.parent else 0)
            last = table[[_bucket("^" + k, PATH_BUCKETS) for k in node.tail]].sum(0)
            node.input = (node.total + last) / (node.size + len(node.tail))
        return node.input

    def inputs(self, page: list[Block]) -> np.ndarray:
        words, measures = features(page)
        return np.concatenate([np.array([self._path(b.node) for b in page], np.float32), _mean(self.w["word"], words), measures], axis=1)

    def _direction(self, x: np.ndarray, mask: np.ndarray, side: str) -> np.ndarray:
        """States (steps, pages, HIDDEN) of one direction; x is (steps, pages, inputs) in reading order of that direction."""
        u = self.w["u" + side]
        z = x @ self.w["w" + side] + self.w["b" + side]
        h = np.zeros((x.shape[1], HIDDEN), np.float32)
        c = np.zeros_like(h)
        out = np.empty((*x.shape[:2], HIDDEN), np.float32)
        for t in range(len(x)):
            g = z[t] + h @ u
            i, f, o = _sigmoid(g[:, :HIDDEN]), _sigmoid(g[:, HIDDEN : 2 * HIDDEN]), _sigmoid(g[:, 2 * HIDDEN : 3 * HIDDEN])
            c_new = f * c + i * np.tanh(g[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            c = np.where(m, c_new, c)
            h = np.where(m, o * np.tanh(c), h)
            out[t] = h
        return out

    def probabilities(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Of each block of each page that it belongs to the article."""
        steps = max(map(len, pages))
        x = np.zeros((steps, len(pages), pages[0].shape[1]), np.float32)
        mask = np.zeros((steps, len(pages)), bool)
        for k, p in enumerate(pages):
            x[: len(p), k] = p
            mask[: len(p), k] = True
        forward = self._direction(x, mask, "f")
        back = self._direction(x[::-1], mask[::-1], "r")[::-1]
        p = _sigmoid(np.concatenate([forward, back], axis=2) @ self.w["out"] + self.w["bias"])[:, :, 0]
        return [p[: len(q), k] for k, q in enumerate(pages)]

    def texts(self, pages: list[str]) -> list[str]:
        """Main text of each page: article blocks joined by two line ends."""
        cut = [blocks(p) for p in pages]
        order = sorted((k for k in range(len(cut)) if cut[k]), key=lambda k: len(cut[k]))
        out = [""] * len(pages)
        while order:
            n = max(1, min(len(order), 256, CELLS // len(cut[order[-1]])))
            group, order = order[-n:], order[:-n]
            for k, p in zip(group, self.probabilities([self.inputs(cut[k]) for k in group])):
                out[k] = "\n\n".join(b.text for b, x in zip(cut[k], p) if x >= 0.5)
        return out


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text`` of every page."""
    pages = df.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))

    def make():
        net = Labeller.load()
        return lambda b: {"page_id": b.column("page_id"), "url": b.column("url"), "text": net.texts(strings(b, "html"))}

    return map_batches(pages, make, "page_id long, url string, text string", rows=500)
