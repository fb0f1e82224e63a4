"""Training of the block labeller: ``python -m habitra.llm.html_train`` writes its weights anew.

Pages are made here, with known labels, from a small grammar: an article in one
of many containers, and around and within it menus, headers, footers, sidebars,
notices, adverts, forms, related links and reader comments, in varied markup.
Words are invented, so that the network learns structure and the fixed words of
boilerplate rather than topics.  The same seed gives the same weights.
"""

from __future__ import annotations

import random

import numpy as np

from habitra.llm.html_extract import HIDDEN, MEASURES, PATH_BUCKETS, PATH_DIM, WEIGHTS, WORD_BUCKETS, WORD_DIM, Block, Labeller, blocks, features, path_buckets

SYLLABLES = "an ble ch de en er ing is la lo men nd on or pa qui re st th ti un ver wh za ö é ç ñ ä".split()
BOILER = {
    "nav": "home about contact news sport search login register help archive topics products blog shop menu back next".split(),
    "footer": "© copyright all rights reserved terms privacy policy imprint contact sitemap powered by cookies".split(),
    "notice": "we use cookies to improve your experience accept consent privacy settings this site agree subscribe please enable javascript warning".split(),
    "ad": "advertisement sponsored buy now offer sale free shipping discount click here promoted best price".split(),
    "form": "name email password submit send subscribe sign up your message search newsletter login".split(),
    "comments": "says reply posted on comment comments great thanks agree report ago like share anonymous".split(),
    "aside": "related articles popular posts most read recommended tags categories recent archive trending follow us".split(),
    "share": "share tweet facebook email print pin whatsapp like".split(),
}
CONTAINERS = ["<article>", "<main>", "<main><article>", '<div class="{}">', '<div id="{}">', '<section class="{}">', '<article class="{}">', '<div class="wrap"><div class="{}">', "<div>", "<section>", '<div role="main">', "<table><tr><td>"]
ARTICLE_NAMES = ["content", "post", "entry-content", "article-body", "story", "post-body", "main-content", "article", "text", "body-text", "post-content", "page-content", "entry", "storyBody", "main", "articleText", "blog-post", "mw-content"]
NOISE = {
    "nav": ["<nav>", '<div class="nav">', '<ul class="menu">', '<div id="menu">', '<nav class="navbar">', '<div class="breadcrumb">', '<div class="topbar">', '<ul id="navigation">', '<div role="navigation">', '<div class="main-menu">', '<div class="pagination">', '<div class="links">'],
    "header": ["<header>", '<div class="header">', '<div id="header">', '<header class="site-header">', '<div id="masthead">', '<div class="banner">', '<div class="top">', '<div role="banner">'],
    "footer": ["<footer>", '<div class="footer">', '<div id="footer">', '<footer class="site-footer">', '<div class="bottom">', '<div class="copyright">', '<div role="contentinfo">', '<div class="legal">'],
    "aside": ["<aside>", '<div class="sidebar">', '<div id="sidebar">', '<aside class="related">', '<div class="widget">', '<div class="related-posts">', '<div class="recommended">', '<section class="popular">', '<div role="complementary">', '<div class="promo-links">', '<div class="teaser">', '<div class="rail">'],
    "notice": ['<div class="cookie-notice">', '<div id="cookie-banner">', '<div class="notice">', '<div class="alert">', '<div class="gdpr">', '<div class="consent">', '<div role="alert">', '<div class="popup">', '<div class="modal">', '<div class="newsletter">', '<div class="message">', '<p class="notice">', '<div class="banner-cookie">', '<div class="disclaimer">', '<div class="paywall">', '<section class="cookies">', '<div role="dialog">'],
    "ad": ['<div class="ad">', '<div class="ads">', '<div class="advert">', '<div class="advertisement">', '<div id="ad-slot">', '<div class="sponsored">', '<div class="promo">', '<aside class="ad">', '<section class="ad-box">', '<div class="banner-ad">', '<div class="adsense">', '<ins class="adsbygoogle">', '<p class="ad">', '<div class="sponsor">'],
    "form": ["<form>", '<form class="search">', '<form id="login">', '<form action="/s">', '<div class="form">', '<form class="newsletter">', '<fieldset>', '<div class="signup">', '<form id="comment-form">'],
    "comments": ['<div class="comments">', '<section id="comments">', '<div id="comments">', '<ol class="commentlist">', '<div class="comment">', '<section class="comments">', '<div class="reader-comments">', '<div class="discussion">', '<ul class="comment-list">', '<div class="responses">', '<div class="replies">', '<div id="disqus">', '<aside class="comments">', '<section class="reviews">', '<section class="user-comments">'],
    "share": ['<div class="share">', '<div class="social">', '<ul class="share-buttons">', '<div class="sharing">', '<div class="tools">', '<div class="byline-share">'],
}


class Maker:
    """Pages with labels, from one random source."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def word(self) -> str:
        return "".join(self.r.choice(SYLLABLES) for _ in range(self.r.randint(1, 4)))

    def words(self, lo: int, hi: int, boiler: str | None = None, share: float = 0.0) -> str:
        n = self.r.randint(lo, hi)
        return " ".join(self.r.choice(BOILER[boiler]) if boiler and self.r.random() < share else self.word() for _ in range(n))

    def sentences(self, lo: int, hi: int, boiler: str | None = None, share: float = 0.0) -> str:
        return " ".join(self.words(2, 18, boiler, share).capitalize() + self.r.choice("....!?") for _ in range(self.r.randint(lo, hi)))

    def links(self, boiler: str) -> str:
        r, share = self.r, self.r.choice([0, 0, 0.5, 1])
        items = [f'<a href="/{k}">{self.words(1, r.choice([1, 2, 8]), boiler, share)}</a>' for k in range(r.randint(1, 12))]
        kind = r.random()
        if kind < 0.55:
            return "<ul>" + "".join(f"<li>{x}" + ("</li>" if r.random() < 0.9 else "") for x in items) + "</ul>"
        if kind < 0.75:
            return " | ".join(items)
        return "".join(f"<{t}>{x}</{t}>" for x in items for t in [r.choice(["p", "div", "h4"])])

    def noise(self, kind: str) -> str:
        r = self.r
        start = r.choice(NOISE[kind])
        tag = start[1:].split()[0].rstrip(">")
        words = kind if kind in BOILER else "nav"
        share = r.choice([0, 0, 0.3, 0.6, 0.9])
        if r.random() < 0.08 and kind in ("ad", "notice"):
            start = f"<{tag}>"
            share = 0.9
        if kind in ("nav", "aside", "share", "header"):
            inside = self.links(words)
            if kind == "header":
                inside = r.choice(["", f"<h1>{self.words(1, 6)}</h1>", f"<p>{self.words(1, 10)}</p>"]) + r.choice(["", inside])
            elif r.random() < 0.4:
                title = r.choice(["h2", "h3", "h4", "p"])
                inside = f"<{title}>{self.words(1, 4, words, 0.5)}</{title}>" + inside
            if kind == "aside" and r.random() < 0.5:
                inside += "".join(f"<p>{self.sentences(1, 4, words, r.choice([0, 0.2]))}</p>" for _ in range(r.randint(1, 4)))
        elif kind == "footer":
            inside = r.choice(["&copy; ", "© 2020 ", ""]) + self.words(1, 4, words, share) + r.choice([" &middot; ", " | ", ". "]) + self.sentences(1, 2, words, share)
            if r.random() < 0.5:
                inside += self.links(words)
        elif kind == "form":
            inside = "".join(r.choice([f"<label>{self.words(1, 3, words, share)}</label><input name=x>", f"<p>{self.sentences(1, 2, words, share)}</p>", f"<button>{self.words(1, 2, words, share)}</button>", f"<select><option>{self.word()}<option>{self.word()}</select>", f"<div>{self.words(1, 5, words, share)}</div>"]) for _ in range(r.randint(1, 5)))
        elif kind == "comments":
            inside = r.choice(["", f"<h3>{self.words(1, 3, words, 0.6)}</h3>"])
            item = r.choice(["li", "div", 'div class="comment"', "p", "article", 'div class="reply"', "blockquote"])
            for _ in range(r.randint(1, 8)):
                who = r.choice(["", f"<b>{self.word()}</b> {self.words(1, 3, words, share)}: ", f"<span>{self.word()}</span>", f"<h4>{self.word()}</h4>", f'<p class="author">{self.word()}</p>'])
                body = self.sentences(1, 5, words, share * 0.3)
                inside += f"<{item}>{who}" + r.choice([body, f"<p>{body}</p>"]) + f"</{item.split()[0]}>"
        else:
            inside = r.choice([self.sentences(1, 3, words, share), f"<p>{self.sentences(1, 3, words, share)}</p>", f'<a href="/x">{self.words(2, 10, words, share)}</a>', f"<h4>{self.words(1, 5, words, share)}</h4><p>{self.sentences(1, 2, words, share)}</p>"])
            if r.random() < 0.2:
                inside += f"<button>{self.words(1, 2, words, 0.7)}</button>"
        return f"\x01{start}{inside}</{tag}>\x02"

    def styled(self, text: str, style: str) -> str:
        """Odd texts are articles, too: lists of fragments, signs after words, capitals, repeated or single words."""
        words = text.split()
        if style == "bars":
            return " | ".join(words) + self.r.choice(["", " |", "."])
        if style == "signs":
            return " ".join(w + self.r.choice(["***", "###", "$$$", "&&&", "%%%", ""]) for w in words)
        if style == "caps":
            return "!! ".join(words).upper()
        if style == "repeats":
            return " ".join([self.r.choice(words)] * self.r.randint(1, 30))
        if style == "short":
            return " ".join(words[: self.r.randint(1, 3)]).rstrip(".") + self.r.choice([".", "", "."])
        if style == "numbers":
            return " ".join(self.r.choice([w, str(self.r.randint(0, 10**9)), "+1 (555) 010-7788", "a@b.org", "10.0.0.1"]) for w in words)
        return text

    def body(self) -> str:
        """The inside of an article."""
        r = self.r
        whole = r.choice(["plain"] * 5 + ["bars", "signs", "caps", "repeats", "short", "numbers", "mixed", "mixed"])
        odd = lambda text: self.styled(text, whole if whole != "mixed" else r.choice(["plain", "plain", "bars", "signs", "short", "numbers", "repeats"]))
        out = [f"<{h}>{odd(self.words(2, 12).capitalize())}</{h}>" for h in [r.choice(["h1", "h1", "h1", "h2"])] if r.random() < 0.85]
        for _ in range(r.choice([1, 2, 3, 4, 6, 8, 12, 25, 40])):
            k = r.random()
            if k < 0.55:
                text = odd(self.sentences(1, r.choice([1, 1, 3, 6, 10])))
                if r.random() < 0.2:
                    text = text.replace(" ", f' <a href="/w">{self.word()}</a> ', 1)
                if r.random() < 0.15:
                    text = "<b>" + text + r.choice(["</b>", "<br>", "</b><br>"])
                out.append(r.choice(["<p>{}</p>", "<p>{}</p>", "<p>{}", "<div>{}</div>"]).format(text))
            elif k < 0.62:
                out.append(f"<h2>{self.words(1, 6)}</h2>")
            elif k < 0.78:
                out.append("<p>" + odd(self.words(1, 5)) + r.choice([".", ":", ""]) + "</p>")
            elif k < 0.85:
                out.append("<ul>" + "".join(f"<li>{self.words(1, 15)}</li>" for _ in range(r.randint(1, 6))) + "</ul>")
            elif k < 0.90:
                out.append(f"<blockquote><p>{self.sentences(1, 3)}</p></blockquote>")
            elif k < 0.93:
                out.append("<table><tr>" + "</tr><tr>".join(f"<td>{self.words(1, 3)}</td><td>{self.words(1, 3)}</td>" for _ in range(r.randint(1, 3))) + "</tr></table>")
            elif k < 0.95:
                out.append(f"<pre>{self.words(3, 20)}</pre>")
            if r.random() < 0.07:
                out.append(self.noise(r.choice(["ad", "share", "aside", "form", "notice", "comments"])))
        for _ in range(r.choice([0, 0, 1, 2])):
            out.append("<p>" + self.styled(self.words(1, 6), r.choice(["short", "plain"])).capitalize() + r.choice([".", "", "."]) + "</p>")
        if r.random() < 0.12:
            out.append(self.noise(r.choice(["comments", "share", "aside", "ad"])))
        return "".join(out)

    def page(self) -> str:
        r = self.r
        start = r.choice(CONTAINERS).format(r.choice(ARTICLE_NAMES))
        close = "".join(f"</{t.split()[0].rstrip('>')}>" for t in reversed(start.strip("<").split("<")))
        above = [k for k, p in (("notice", 0.25), ("header", 0.4), ("nav", 0.7), ("ad", 0.4), ("form", 0.2), ("aside", 0.15)) if r.random() < p]
        below = [k for k, p in (("share", 0.2), ("comments", 0.4), ("aside", 0.4), ("ad", 0.3), ("form", 0.25), ("notice", 0.15), ("nav", 0.2), ("footer", 0.8)) if r.random() < p]
        if r.random() < 0.3:
            r.shuffle(above)
            r.shuffle(below)
        article = "" if r.random() < 0.02 else f"{start}{self.body()}{close}"
        inside = "".join(map(self.noise, above)) + article + "".join(map(self.noise, below))
        if r.random() < 0.3:
            inside = f'<div id="{r.choice(["page", "wrapper", "container", "root"])}">{inside}</div>'
        return "<!DOCTYPE html><html><head><title>x</title></head><body>" + inside + r.choice(["</body></html>", ""])

    def labelled(self) -> tuple[list[Block], np.ndarray]:
        """Blocks of a page, and 1 for each of the article; marks around noise are read off the text."""
        page = self.page()
        marked = page.replace("\x01", "<hr>\x01<hr>").replace("\x02", "<hr>\x02<hr>")
        out, labels, depth = [], [], 0
        for b in blocks(marked):
            if b.text == "\x01":
                depth += 1
            elif b.text == "\x02":
                depth -= 1
            else:
                out.append(b)
                labels.append(0.0 if depth else 1.0)
        return out, np.array(labels, np.float32)


def fresh(seed: int) -> dict[str, np.ndarray]:
    g = np.random.default_rng(seed)
    n_in = PATH_DIM + WORD_DIM + MEASURES
    w = {"path": g.normal(0, 0.3, (PATH_BUCKETS, PATH_DIM)), "word": g.normal(0, 0.2, (WORD_BUCKETS, WORD_DIM)), "out": g.normal(0, 0.2, (2 * HIDDEN, 1)), "bias": np.zeros(1)}
    for side in "fr":
        w["w" + side] = g.normal(0, n_in**-0.5, (n_in, 4 * HIDDEN))
        w["u" + side] = g.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN))
        w["b" + side] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
    return {k: v.astype(np.float32) for k, v in w.items()}


def _sig(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _run(x: np.ndarray, mask: np.ndarray, w: np.ndarray, u: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, list]:
    h = np.zeros((x.shape[1], HIDDEN), np.float32)
    c = np.zeros_like(h)
    z = x @ w + b
    out, kept = np.empty((*x.shape[:2], HIDDEN), np.float32), []
    for t in range(len(x)):
        g = z[t] + h @ u
        i, f, o, n = _sig(g[:, :HIDDEN]), _sig(g[:, HIDDEN : 2 * HIDDEN]), _sig(g[:, 2 * HIDDEN : 3 * HIDDEN]), np.tanh(g[:, 3 * HIDDEN :])
        m = mask[t][:, None]
        c_new = np.where(m, f * c + i * n, c)
        tc = np.tanh(c_new)
        h_new = np.where(m, o * tc, h)
        kept.append((h, c, i, f, o, n, tc, m))
        h, c = h_new, c_new
        out[t] = h
    return out, kept


def _back(x: np.ndarray, kept: list, dout: np.ndarray, w: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    du = np.zeros_like(u)
    dz = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
    dh = np.zeros((x.shape[1], HIDDEN), np.float32)
    dc = np.zeros_like(dh)
    for t in reversed(range(len(x))):
        h, c, i, f, o, n, tc, m = kept[t]
        dh = dh + dout[t]
        here = np.where(m, dh, 0)
        dcc = np.where(m, dc, 0) + here * o * (1 - tc * tc)
        dz[t] = np.concatenate([dcc * n * i * (1 - i), dcc * c * f * (1 - f), here * tc * o * (1 - o), dcc * i * (1 - n * n)], axis=1)
        du += h.T @ dz[t]
        dh = np.where(m, dz[t] @ u.T, dh)
        dc = np.where(m, dcc * f, dc)
    flat = dz.reshape(-1, 4 * HIDDEN)
    return x.reshape(-1, x.shape[2]).T @ flat, du, flat.sum(0), dz @ w.T


def train(steps: int = 1200, pages: int = 32, seed: int = 11, rate: float = 0.006) -> dict[str, np.ndarray]:
    """Adam on the mean log loss of blocks, over ``steps`` batches of new pages."""
    make, w = Maker(seed), fresh(seed)
    m1 = {k: np.zeros_like(v) for k, v in w.items()}
    m2 = {k: np.zeros_like(v) for k, v in w.items()}
    for step in range(1, steps + 1):
        made = [p for p in (make.labelled() for _ in range(pages)) if 0 < len(p[0]) <= 120]
        feats = [([path_buckets(b) for b in p], *features(p)) for p, _ in made]
        steps_n = max(len(p) for p, _ in made)
        n_in = PATH_DIM + WORD_DIM + MEASURES
        x = np.zeros((steps_n, len(made), n_in), np.float32)
        y, mask = np.zeros(x.shape[:2], np.float32), np.zeros(x.shape[:2], bool)
        for k, ((_, labels), (paths, words, measures)) in enumerate(zip(made, feats)):
            for t, (a, b) in enumerate(zip(paths, words)):
                x[t, k, :PATH_DIM] = w["path"][a].mean(0)
                x[t, k, PATH_DIM : PATH_DIM + WORD_DIM] = w["word"][b].mean(0)
            x[: len(labels), k, PATH_DIM + WORD_DIM :] = measures
            y[: len(labels), k], mask[: len(labels), k] = labels, True
        hf, kf = _run(x, mask, w["wf"], w["uf"], w["bf"])
        hr, kr = _run(x[::-1], mask[::-1], w["wr"], w["ur"], w["br"])
        h = np.concatenate([hf, hr[::-1]], axis=2)
        p = _sig(h @ w["out"] + w["bias"])[:, :, 0]
        d = np.where(mask, (p - y) / mask.sum(), 0).astype(np.float32)
        g = {"out": (h * d[:, :, None]).sum((0, 1))[:, None], "bias": np.array([d.sum()], np.float32)}
        dh = d[:, :, None] * w["out"][:, 0]
        g["wf"], g["uf"], g["bf"], dxf = _back(x, kf, dh[:, :, :HIDDEN], w["wf"], w["uf"])
        g["wr"], g["ur"], g["br"], dxr = _back(x[::-1], kr, dh[::-1, :, HIDDEN:], w["wr"], w["ur"])
        dx = dxf + dxr[::-1]
        g["path"], g["word"] = np.zeros_like(w["path"]), np.zeros_like(w["word"])
        for k, (paths, words, _) in enumerate(feats):
            for t, (a, b) in enumerate(zip(paths, words)):
                np.add.at(g["path"], a, dx[t, k, :PATH_DIM] / len(a))
                np.add.at(g["word"], b, dx[t, k, PATH_DIM : PATH_DIM + WORD_DIM] / len(b))
        now = rate * min(1.0, step / 50) * (1 - 0.9 * step / steps)
        for k, v in w.items():
            m1[k] += 0.1 * (g[k] - m1[k])
            m2[k] += 0.001 * (g[k] ** 2 - m2[k])
            v -= now * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)
        if step % 100 == 0:
            print(step, round(float(-np.log(np.where(y == 1, p, 1 - p)[mask] + 1e-7).mean()), 4), round(float(((p >= 0.5) == y)[mask].mean()), 4), flush=True)
    return w


def accuracy(net: Labeller, pages: int = 300, seed: int = 99) -> tuple[float, float]:
    """Shares of blocks, and of whole pages, that are labelled right on new pages."""
    make = Maker(seed)
    right = total = whole = n = 0
    for _ in range(pages):
        page, labels = make.labelled()
        if page:
            got = net.probabilities([net.inputs(page)])[0] >= 0.5
            ok = got == (labels == 1)
            right, total, whole, n = right + int(ok.sum()), total + len(ok), whole + bool(ok.all()), n + 1
    return right / total, whole / n


if __name__ == "__main__":
    trained = train()
    print("held-out accuracy of blocks and pages", accuracy(Labeller(trained)))
    np.savez_compressed(WEIGHTS, **{k: v.astype(np.float16) for k, v in trained.items()})
