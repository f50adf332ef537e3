"""Main text of web pages by a tree-structured graphical model.

The block elements of a page form a tree. Every node is content or not; node
potentials come from its tag, the names in its class, id and role, its text
and its links, and parent-child potentials tie it to its parent. Sum-product
messages, upward and then downward, give each node's marginal; the text of
nodes that are more likely content than not is kept. Weights are trained on
labelled pages by the same messages.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import is_text, tidy, together

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
BLOCK = frozenset("""html body head address article aside blockquote button center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup legend li main menu nav ol optgroup option p pre search section select summary svg
table caption tbody thead tfoot tr td th ul ins""".split())
NEVER = frozenset("head script style template noscript iframe svg".split())  # not shown as text
#: What an opening tag closes, within the bounds of the second set.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"})}
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
_NAME = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)

#: Groups of parts of names, as pages use them.
GROUPS = [re.compile(rf"(?<![a-z])(?:{p})(?![a-z])|(?:{q})") for p, q in (
    ("ad|ads|adv", "advert|adsby|sponsor|promo|banner|commercial|outbrain|taboola"),
    ("nav|tabs|toc|crumb", "navig|navbar|menu|breadcrumb|pagination|pager|skip-?link"),
    ("reply|replies|respond", "comment|disqus|discussion"),
    ("side|rail", "sidebar|widget|related|recommend|complementary|trending|popular|read-?more|more-?stories|teaser"),
    ("foot|legal", "footer|copyright|contentinfo|colophon|imprint"),
    ("head|top|logo|brand", "header|masthead|topbar|site-?title"),
    ("alert|gdpr|toast|modal", "cookie|consent|notice|popup|overlay|paywall|privacy|notification|warning|dialog|announce"),
    ("form|search|login|signup", "newsletter|subscribe|subscription|sign-?up|search-?box|contact-?form|register|poll"),
    ("share|social|follow|tags|byline|meta", "sharing|facebook|twitter|post-?meta|author-?box"),
    ("main|post|entry|text|story|body|prose", "article|content|story-?body|page-?body|post-?body"),
)]
TAGS = ["html", "body", "article", "main", "section", "div", "p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "nav", "header", "footer", "aside", "form",
        "fieldset", "table", "tr", "td", "th", "figure", "figcaption", "blockquote", "pre", "button", "select", "option", "dl", "dt", "dd", "address", "ins", "menu", "details", "dialog", "other"]
_TAG_AT = {t: i for i, t in enumerate(TAGS)}
N_KEY, N_SHAPE = len(TAGS) + len(GROUPS) + 1, 11


@dataclass
class Page:
    """Block elements in page order (parents before children) and text runs."""
    keys: list[tuple[str, str]] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    runs: list[tuple[int, str, int]] = field(default_factory=list)  # node, text, characters in links


def parse(source: str) -> Page:
    """The block tree of a page, whatever its markup leaves open or unopened,
    in time that grows with its length, however deep it is."""
    page = Page([("html", "")], [-1], [0])
    stack, hidden, linked = [0], 0, False
    at_tag: dict[str, list[int]] = {}  # places in the stack of the open elements of each tag, the root's aside
    text: list[str] = []
    link_chars = 0

    def flush() -> None:
        nonlocal link_chars
        if text:
            joined = " ".join("".join(text).split())
            if joined:
                page.runs.append((stack[-1], joined, min(link_chars, len(joined))))
            text.clear()
        link_chars = 0

    def add(raw: str) -> None:
        nonlocal link_chars
        if raw and not hidden:
            plain = html.unescape(raw) if "&" in raw else raw
            text.append(plain)
            if linked:
                link_chars += len(plain.strip())

    def close(i: int) -> None:
        nonlocal hidden
        for j in stack[i:]:
            hidden -= page.keys[j][0] in NEVER
            at_tag[page.keys[j][0]].pop()
        del stack[i:]

    def last(tags) -> int:
        return max((at_tag[t][-1] for t in tags if at_tag.get(t)), default=0)

    def close_open(tags, bounds) -> None:
        i = last(tags)
        if i > last(bounds):
            close(i)

    at, end = 0, len(source)
    while at < end:
        m = _TAG.search(source, at)
        if not m:
            add(source[at:])
            break
        add(source[at:m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        closing, attrs = m[1] or m[4], m[3] if m[2] else m[6]
        if not tag:
            continue
        if tag == "br":
            text.append(" ")
        elif tag == "a":
            linked = not closing
        elif tag in RAW and not closing:
            m = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(source, at)
            if tag == "textarea":
                add(source[at:m.start() if m else end])
            at = m.end() if m else end
        elif tag in BLOCK and not closing:
            flush()
            linked = False
            if tag not in ("option", "optgroup"):
                close_open({"p"}, {"button", "td", "th", "caption"})
            if tag in CLOSES:
                close_open(*CLOSES[tag])
            if tag == "html" or tag == "body" and at_tag.get(tag):
                continue
            names = " ".join(v.strip("\"'") for v in _NAME.findall(attrs)).lower() if attrs else ""
            page.keys.append((tag, names))
            page.parent.append(stack[-1])
            page.depth.append(len(stack))
            hidden += tag in NEVER
            at_tag.setdefault(tag, []).append(len(stack))
            stack.append(len(page.keys) - 1)
        elif tag in BLOCK:
            if tag == "p" or at_tag.get(tag):
                flush()
                linked = False
            if at_tag.get(tag):
                close(at_tag[tag][-1])
    flush()
    return page


class Keys(dict):
    """Columns of an element's tag and names, once per distinct pair."""

    def __missing__(self, key: tuple[str, str]) -> np.ndarray:
        if len(self) >= 100_000:
            self.clear()
        row = np.zeros(N_KEY)
        row[_TAG_AT.get(key[0], len(TAGS) - 1)] = 1
        if key[1]:
            row[len(TAGS):-1] = [bool(g.search(key[1])) for g in GROUPS]
        row[-1] = 1
        self[key] = row
        return row


class KeyScores(dict):
    """What an element's tag and names add to its scores, once per distinct pair."""

    def __init__(self, model: Model):
        self.keys, self.weights = Keys(), model.weights[:N_KEY]

    def __missing__(self, key: tuple[str, str]) -> tuple[float, float]:
        if len(self) >= 100_000:
            self.clear()
        self[key] = told = tuple((self.keys[key] @ self.weights).tolist())
        return told


def features(page: Page, keys: Keys) -> np.ndarray:
    """One row per node: tag and names, then its own and its subtree's text."""
    return np.concatenate([np.stack([keys[k] for k in page.keys]), shape(page)], axis=1)


def shape(page: Page) -> np.ndarray:
    """The features of each node's own and its subtree's text."""
    n = len(page.keys)
    own, links, ends = np.zeros(n), np.zeros(n), np.zeros(n)
    legal = np.zeros(n)
    for node, text, in_links in page.runs:
        own[node] += len(text)
        links[node] += in_links
        ends[node] += text.count(". ") + text.endswith((".", "!", "?"))
        legal[node] += "\xa9" in text
    below, below_links, direct = own.copy(), links.copy(), np.zeros(n)
    for i in range(n - 1, 0, -1):
        direct[page.parent[i]] += own[i]
        below[page.parent[i]] += below[i]
        below_links[page.parent[i]] += below_links[i]
    total = max(below[0], 1.0)
    return np.stack([
        np.log1p(own) / 6, links / np.maximum(own, 1), (own > 0) & (own < 40), below / total, below_links / np.maximum(below, 1),
        np.log1p(below) / 8, np.minimum(ends, 5) / 5, legal > 0, (own == 0) & (below > 0), direct / np.maximum(below, 1), np.minimum(page.depth, 10) * 0.1], axis=1)


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def messages(scores: np.ndarray, moves: np.ndarray, parent: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum-product on a forest given by ``parent`` (-1 for roots) and
    ``depth``: node marginals, and expected parent-child pairs. ``moves`` is
    parent state by child state; all potentials are logarithms."""
    order = np.argsort(depth, kind="stable")
    cuts = np.searchsorted(depth[order], np.arange(depth.max() + 2)) if len(depth) else np.zeros(1, dtype=int)
    levels = [order[a:b] for a, b in zip(cuts, cuts[1:])]
    up, sent = scores.copy(), np.zeros_like(scores)
    for nodes in levels[:0:-1]:
        sent[nodes] = _lse(moves[None] + up[nodes][:, None, :], 2)
        np.add.at(up, parent[nodes], sent[nodes])
    total, pairs = up.copy(), np.zeros_like(moves)
    for nodes in levels[1:]:
        above = total[parent[nodes]] - sent[nodes]
        both = above[:, :, None] + moves[None] + up[nodes][:, None, :]
        total[nodes] = up[nodes] + _lse(above[:, :, None] + moves[None], 1)
        flat = both.reshape(len(nodes), -1)
        pairs += np.exp(flat - _lse(flat, 1)[:, None]).sum(axis=0).reshape(moves.shape)
    return np.exp(total - _lse(total, 1)[:, None]), pairs


@dataclass
class Model:
    weights: np.ndarray
    moves: np.ndarray


def _forest(pages: list[Page]) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(p.keys) for p in pages], dtype=np.int64)
    base = np.cumsum(size) - size
    parent = np.concatenate([np.where(np.array(p.parent) < 0, -1, np.array(p.parent) + b) for p, b in zip(pages, base)])
    return parent, np.concatenate([np.array(p.depth, dtype=np.int64) for p in pages])


def train(pages: list[Page], labels: list[list[int]], steps: int = 150, rate: float = 0.1, l2: float = 2e-4) -> Model:
    """Weights of largest penalised likelihood of the labels of all nodes."""
    keys = Keys()
    x = np.concatenate([features(p, keys) for p in pages])
    y = np.concatenate([np.array(v, dtype=np.int64) for v in labels])
    parent, depth = _forest(pages)
    gold = np.eye(2)[y]
    inner = parent >= 0
    gold_pairs = np.zeros((2, 2))
    np.add.at(gold_pairs, (y[parent[inner]], y[inner]), 1)
    theta = [np.zeros((x.shape[1], 2)), np.zeros((2, 2))]
    mean, var = [np.zeros_like(w) for w in theta], [np.zeros_like(w) for w in theta]
    for step in range(1, steps + 1):
        prob, pairs = messages(x @ theta[0], theta[1], parent, depth)
        grads = [x.T @ (prob - gold) / len(x) + l2 * theta[0], (pairs - gold_pairs) / len(x) + l2 * theta[1]]
        for w, g, m, v in zip(theta, grads, mean, var):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return Model(*theta)


def main_texts(model: Model, sources: list[str], keys: KeyScores) -> list[str]:
    """The kept text of each page: runs of content nodes, joined by newlines."""
    pages = [parse(s) for s in sources]
    if not pages:
        return []
    scores = np.concatenate([np.array([keys[k] for k in p.keys]) + shape(p) @ model.weights[N_KEY:] for p in pages])
    parent, depth = _forest(pages)
    content = messages(scores, model.moves, parent, depth)[0][:, 1] >= 0.5
    out, base = [], 0
    for p in pages:
        out.append("\n".join(text for node, text, _ in p.runs if content[base + node]))
        base += len(p.keys)
    return out


def made_pages(n: int = 600) -> list[tuple[str, list[str]]]:
    """A fixed set of labelled pages: sources in which the markup around and
    inside the article varies, and the texts of the article's blocks."""
    rng = np.random.RandomState(17)
    parts = "the an of in er on re th ing tion le la de qu ou ment ich ung der os ado mi st an en al".split()
    vocabulary = ["".join(parts[k] for k in rng.randint(0, len(parts), 1 + i % 3)) for i in range(900)]
    pick = lambda xs: xs[rng.randint(len(xs))]

    def words(a: int, b: int) -> str:
        return " ".join(vocabulary[k] for k in rng.randint(0, len(vocabulary), rng.randint(a, b + 1)))

    def prose() -> str:
        kind = rng.randint(10)
        if kind == 0:
            return words(1, 5).capitalize() + pick([".", "", "!"])
        out = " ".join(words(4, 14).capitalize() + pick([".", ".", ".", "?"]) for _ in range(rng.randint(1, 8)))
        return out.upper().replace(".", "!!") if kind == 1 else out.replace(" ", "%%% ") if kind == 2 else out

    def links(k: int) -> list[str]:
        return [f'<a href="/{i}">{words(1, 3)}</a>' for i in range(k)]

    def menu() -> str:
        items = "".join(f"<li>{x}</li>" for x in links(rng.randint(2, 8)))
        return pick([f"<nav><ul>{items}</ul></nav>", f'<ul class="menu">{items}</ul>', f'<div id="nav">{" ".join(links(5))}</div>', f'<div class="navbar"><ul>{items}</ul></div>',
                     f'<nav class="breadcrumb">{" / ".join(links(3))}</nav>', f'<div role="navigation">{" | ".join(links(4))}</div>'])

    def advert() -> str:
        return pick([f'<div class="ad">{prose()}</div>', f'<div class="advertisement"><p>{prose()}</p></div>', f'<aside class="sponsored">{words(3, 9)}</aside>',
                     f'<div id="banner-ad"><a href="/x">{words(2, 8)}</a></div>', f'<div class="promo-box"><h3>{words(2, 4)}</h3><p>{prose()}</p></div>', f'<ins class="adsbygoogle">{words(2, 5)}</ins>'])

    def notice() -> str:
        return pick([f'<div class="cookie-notice"><p>{prose()}</p><button>{words(1, 2)}</button></div>', f'<div role="alert">{prose()}</div>', f'<div id="consent">{prose()}</div>',
                     f'<div class="notice">{prose()}</div>', f'<dialog class="gdpr modal"><p>{prose()}</p></dialog>', f'<section class="paywall"><p>{prose()}</p></section>'])

    def side() -> str:
        inner = f"<h3>{words(1, 3)}</h3>" + pick(["".join(f"<p>{x}</p>" for x in links(3)), f"<p>{prose()}</p>", "<ul>" + "".join(f"<li>{x}</li>" for x in links(4)) + "</ul>"])
        return pick([f"<aside>{inner}</aside>", f'<div id="sidebar">{inner}</div>', f'<div class="widget">{inner}</div>', f'<section class="related-posts">{inner}</section>', f'<div class="right-rail">{inner}</div>'])

    def form() -> str:
        return pick([f'<form><label>{words(1, 3)}</label><input name="q"><button>{words(1, 1)}</button></form>', f'<div class="newsletter"><p>{prose()}</p><form><p>{words(2, 5)}</p><input></form></div>',
                     f"<form action=\"/s\"><fieldset><legend>{words(1, 2)}</legend><select><option>{words(1, 1)}<option>{words(1, 1)}</select><textarea>{words(2, 6)}</textarea></fieldset></form>",
                     f'<div id="search-box"><form>{words(1, 2)} <input></form></div>'])

    def comments() -> str:
        each = "".join(pick([f"<p>{prose()}</p>", f'<div class="comment"><b>{words(1, 1)}</b> {prose()}</div>', f"<li>{prose()}</li>", f'<article class="comment"><p>{prose()}</p></article>']) for _ in range(rng.randint(1, 5)))
        return pick([f'<section id="comments"><h2>{words(1, 2)}</h2>{each}</section>', f'<div class="comment-list">{each}</div>', f'<div id="disqus_thread">{each}</div>', f'<ol class="replies">{each}</ol>'])

    def share() -> str:
        return pick([f'<div class="share">{" ".join(links(3))}</div>', f'<ul class="social"><li>{"<li>".join(links(3))}</ul>', f'<div class="byline">{words(2, 4)}</div>'])

    def foot() -> str:
        return pick([f"<footer>&copy; {words(1, 3)} &middot; {prose()}</footer>", f'<div class="footer"><p>{prose()}</p>{" ".join(links(3))}</div>', f'<footer class="site-footer">{menu()}<p>{words(3, 9)}</p></footer>', f'<p class="copyright">&copy; {words(2, 6)}</p>'])

    def top() -> str:
        return pick([f"<header><h1>{words(1, 3)}</h1>{menu()}</header>", f'<div id="header"><p>{words(1, 4)}</p></div>', f'<header class="masthead">{words(1, 4)}</header>', menu(), ""])

    out = []
    for _ in range(n):
        blocks: list[str] = []

        def take(text: str) -> str:
            blocks.append(" ".join(text.split()))
            return html.escape(text, quote=bool(rng.randint(2)))

        def inline(text: str) -> str:
            left, _, right = take(text).partition(" ")
            return pick([f"{left} {right}", f"<b>{left}</b> {right}", f"{left}\n  <em>{right}</em>", f"<b>{left} {right}<br>", f'<span class="x">{left}</span> {right}', f'{left} <a href="/y">{right[:12]}</a>{right[12:]}'])

        def article_blocks() -> str:
            body = ""
            for _ in range(rng.randint(1, 12)):
                kind = rng.randint(24)
                if kind < 15:
                    body += f"<p>{inline(prose())}" + pick(["</p>", "</p>", "</p>", ""])
                elif kind == 15:
                    body += f"<h2>{take(words(2, 6))}</h2>"
                elif kind == 16:
                    body += "<ul>" + "".join(f"<li>{take(words(3, 12))}</li>" for _ in range(3)) + "</ul>"
                elif kind == 17:
                    body += f"<blockquote><p>{take(prose())}</p></blockquote>"
                elif kind == 18:
                    body += f"<figure><img src=x><figcaption>{take(words(3, 9))}</figcaption></figure>"
                elif kind == 19:
                    body += "<table><tr>" + "".join(f"<td>{take(words(1, 4))}" for _ in range(3)) + "</table>"
                elif kind == 20:
                    body += f"<pre>{take(words(3, 20))}</pre>"
                elif kind == 21:
                    body += f"<div>{take(prose())}</div>"
                elif kind == 22:
                    body += advert()
                else:
                    body += pick([share, side, notice, form])()
            return body

        title = words(2, 9).capitalize()
        lead = f"<h1>{take(title)}</h1>" if rng.randint(6) else ""
        body = lead + article_blocks()
        wrap = pick(["<article>%s</article>"] * 3 + ["<main><article>%s</article></main>", '<div class="content">%s</div>', '<div id="post-12" class="entry-content">%s</div>', "<main>%s</main>",
                     '<section class="story-body">%s</section>', "<div>%s</div>", '<article class="post">%s', "%s", '<div class="article-text"><div>%s</div></div>'])
        before = "".join(f() for f in (top, menu, advert, notice, side) if rng.randint(2))
        after = "".join(f() for f in (side, share, comments, form, notice, advert) if rng.randint(3) == 0) + (foot() if rng.randint(5) else "")
        if "</" not in wrap:
            after = pick(["", foot() if "<article" in wrap else ""])
        if rng.randint(10) == 0:  # the article alone, of one block
            del blocks[:]
            before, body, after = "", f"<p>{inline(prose())}", ""
        head = f"<head><title>{title}</title><style>p{{margin:0}}</style><script>var t=\"</p>\";</script></head>"
        source = f"<!DOCTYPE html><html>{head}<body>{before}<!-- {words(1, 3)} -->{wrap % body}{after}" + pick(["</body></html>", ""])
        out.append((source, blocks))
    return out


def labels_of(page: Page, blocks: list[str]) -> list[int]:
    """1 for the nodes whose text is the article's, in its order, and for what
    holds nothing else; nodes without text take their children's part."""
    y, wanted = [-1] * len(page.keys), iter(blocks)
    nxt = next(wanted, None)
    for node, text, _ in page.runs:
        hit = text == nxt
        if hit:
            nxt = next(wanted, None)
        y[node] = int(hit) if y[node] < 0 else min(y[node], int(hit)) if not hit else y[node]
    shares = [[0, 0] for _ in y]
    for node, text, _ in page.runs:
        shares[node][y[node]] += len(text)
    for i in range(len(y) - 1, 0, -1):
        for k in (0, 1):
            shares[page.parent[i]][k] += shares[i][k]
    bare = {page.parent[i] for i, v in enumerate(y) if v == 1}  # a page or body that holds the article's blocks itself
    return [v if v >= 0 else int(i in bare) if page.keys[i][0] in ("html", "body") else int(a > 0 and 2 * a >= b)
            for i, (v, (b, a)) in enumerate(zip(y, shares))]


def learn(labelled: list[tuple[str, list[str]]] | None = None) -> Model:
    """Train on labelled pages ``(source, texts of the article's blocks)``, the
    fixed set of ``made_pages`` by default."""
    labelled = made_pages() if labelled is None else labelled
    pages = [parse(s) for s, _ in labelled]
    return train(pages, [labels_of(p, b) for p, (_, b) in zip(pages, labelled)])


#: Characters of the pages that are read together, unless one is longer.
TOGETHER = 4 << 20


def extract(pages: DataFrame, model: Model, column: str = "html") -> DataFrame:
    """``pages`` with ``text`` after its own columns (one of this name is
    replaced): the main text of ``column``. Character references are decoded,
    white space inside a block is one space, blocks are lines. A null or empty
    page, and one without content, has the empty text."""
    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        keys = KeyScores(model)
        for sources in series:
            sources = [s if is_text(s) else "" for s in sources]
            yield pd.Series([t for part in together(sources, TOGETHER) for t in main_texts(model, part, keys)], dtype=object)

    return pages.withColumn("text", F.pandas_udf(tidy(run), "string")(F.col(column).cast("string")))
