"""HTML extraction (op 4): a tree-structured graphical model over the DOM, in Arrow batches without a shuffle.

A page is read into a tree of block elements (scripts, styles, comments and controls hold no text; inline elements belong to the block that
they stand in). Each node is a binary variable: part of the article, or on the way to it. Unary potentials are linear in
features of the node (element, words of its class and id, text and link density of the node and of what lies below); parent-child
potentials connect each node with its parent. Sum-product message passing, upward and downward, gives every node's content
marginal; all pages of a batch are passed together, level by level. Weights are trained by gradient ascent on the likelihood of hand-labelled pages, with
the same message passing. Text of nodes whose marginal is at least one half is the article.

Scripts, styles and titles without end tag run to the end of the page; svg, iframe, object, canvas, select, template and noscript without one, or self-closing,
are empty. Names are whole (`svg-icon` is an element of its own), and the text of math stays in its block.

A block's character references are decoded and its white space becomes one space; blocks are joined in page order by an empty line.

Defined cases: a null or empty page, or one without an article, gives the empty text; broken, cut off or wrongly nested markup is read as far as
it goes; pages without id or with equal ids are read row by row; extra columns pass through `extract`, whose added columns replace columns
of the same names.
"""

from __future__ import annotations

import html as references
import re
from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from odspark.llm.common import add_columns, table
from odspark.llm.labelled_pages import PAGES

# Elements.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big center cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var nobr".split())
MATH = set("""math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose msub msup msubsup munder mover munderover mmultiscripts
 mprescripts mtable mtr mlabeledtr mtd maligngroup malignmark maction semantics annotation annotation-xml""".split())
INLINE |= MATH
CLOSED_BY_BLOCK = {"p"}
CLOSED_BY_SAME = set("li dt dd tr td th option p thead tbody tfoot".split())
SCOPES = set("ul ol dl table tr tbody thead body html div article section main".split())
TAG_GROUPS = ["article", "main", "section", "p", "heading", "item", "list", "nav", "footer", "header", "aside", "form", "table", "quote", "root", "other"]
GROUP = {**{t: t for t in ("article", "main", "section", "p", "nav", "footer", "header", "aside", "form")},
         **{f"h{k}": "heading" for k in range(1, 7)}, **{t: "item" for t in ("li", "dt", "dd")}, **{t: "list" for t in ("ul", "ol", "dl", "menu")},
         **{t: "table" for t in "table tr td th tbody thead tfoot caption".split()}, **{t: "quote" for t in ("blockquote", "pre", "figure", "figcaption")},
         **{t: "form" for t in ("fieldset", "button", "dialog")}, **{t: "root" for t in ("html", "body", "#root")}}
BOILER = set("""ad ads advert advertisement adverts banner promo promoted sponsor sponsored cookie cookies consent notice popup modal overlay nav navbar navigation menu
 sidebar side footer foot header masthead top bar share social related recommended newsletter subscribe breadcrumb breadcrumbs login signin search widget tags tag pagination pager copyright legal hidden
 disclaimer toolbar""".split())
READERS = set("comment comments reply replies respond discussion feedback reader readers disqus".split())
CONTENT = set("article content post entry main story body text page".split())

RAW = r"script|style|textarea|title"                                      # unclosed, they run to the end of the page
HIDDEN = set("noscript template select svg iframe object canvas".split())   # unclosed or self-closing, they are empty
ATTRS = r"((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})(?=[\s/>])[^>]*+>.*?(?:</\1\s*+>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+){ATTRS}>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)", re.S | re.I)
HIDDEN_TAG = re.compile(rf"<!--.*?(?:-->|\Z)|<(/?)({'|'.join(sorted(HIDDEN))}|script|style)(?=[\s/>])(?:{ATTRS}>|([^>]*+)(?:>|\Z))", re.S | re.I)
RAW_END = {t: re.compile(rf"</{t}\s*+>", re.I) for t in ("script", "style")}
SLASHED_VALUE = re.compile(r"=\s*+[^\s\"']+/\Z")                          # the slash belongs to a value without quotes
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
WORDS = re.compile(r"[a-z]+")
N_FEATURES = len(TAG_GROUPS) + 13


@dataclass
class Page:
    """Block elements of a page in document order, parents before children; node 0 is the root."""
    tag: list[str] = field(default_factory=lambda: ["#root"])
    parent: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])
    names: list[set] = field(default_factory=lambda: [set()])
    attrs: list[str] = field(default_factory=lambda: [""])
    blocks: list[tuple[int, str]] = field(default_factory=list)   # (node, text), in page order
    linked: list[int] = field(default_factory=lambda: [0])        # characters of the node's own text inside links


def name_words(attrs: str) -> set[str]:
    if not attrs:
        return set()
    return {w for m in NAMES.finditer(attrs) for w in WORDS.findall((m[1] or m[2] or m[3] or "").lower())}


def self_closing(attrs: str) -> bool:
    return attrs.endswith("/") and not SLASHED_VALUE.search(attrs)


def hidden_ends(html: str, at: int) -> dict[int, int]:
    """From `at` on, where each hidden element that has an end tag starts and ends; an end tag belongs to the last open start tag of its name."""
    ends: dict[int, int] = {}
    opened: dict[str, list[int]] = {t: [] for t in HIDDEN}
    unclosed: set[str] = set()
    while m := HIDDEN_TAG.search(html, at):
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag or self_closing(m[3] or m[4] or ""):
            continue
        if tag not in HIDDEN:
            if not m[1] and tag not in unclosed:                            # tags in a script's text are none
                if end := RAW_END[tag].search(html, at):
                    at = end.end()
                else:
                    unclosed.add(tag)
        elif not m[1]:
            opened[tag].append(m.start())
        elif opened[tag]:
            ends[opened[tag].pop()] = at
    return ends


def parse(html: str) -> Page:
    """The block tree of a page and the text blocks in it."""
    page, stack, at = Page(), [("#root", 0)], 0   # open elements with the node that their text belongs to
    run: list[str] = []
    links = 0
    ends = None
    where: dict[str, list[int]] = defaultdict(list)   # places of each open element in the stack
    scopes: list[int] = []                            # places of those that end a search

    def push(tag: str, node: int) -> None:
        where[tag].append(len(stack))
        if tag in SCOPES:
            scopes.append(len(stack))
        stack.append((tag, node))

    def flush() -> None:
        if run:
            text = " ".join(references.unescape("".join(run)).split())
            if text:
                page.blocks.append((stack[-1][1], text))
            run.clear()

    def close(upto: int) -> None:
        nonlocal links
        flush_needed = any(t not in INLINE or n != stack[upto - 1][1] for t, n in stack[upto:])
        if flush_needed:
            flush()
        for t, _ in stack[upto:]:
            links -= t == "a"
            where[t].pop()
        while scopes and scopes[-1] >= upto:
            scopes.pop()
        del stack[upto:]

    while m := TOKEN.search(html, at):
        if m.start() > at:
            text = html[at:m.start()]
            run.append(text)
            if links:
                page.linked[stack[-1][1]] += len(text.strip())
        at = m.end()
        tag = (m[3] or m[6] or "").lower()
        if not tag:
            continue
        if tag in HIDDEN:
            if not (m[2] or m[5]):
                if ends is None:
                    ends = hidden_ends(html, m.start())
                at = ends.get(m.start(), at)
            continue
        if m[2] or m[5]:
            k = where[tag][-1] if where[tag] else 0
            if k and not (tag in INLINE and scopes and scopes[-1] > k):
                close(k)
            elif tag == "p":
                flush()
            continue
        attrs = m[4] or m[7] or ""
        if tag == "br":
            run.append(" ")
            continue
        if tag in MATH and self_closing(attrs):
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        names = name_words(attrs)
        block = tag not in INLINE or bool(names & (BOILER | READERS))
        if not block:
            push(tag, stack[-1][1])
            links += tag == "a"
            continue
        if tag not in INLINE:
            # an open paragraph ends before a block; an open item or cell ends before its sibling
            for i in range(len(stack) - 1, 0, -1) if where["p"] or tag in CLOSED_BY_SAME and where[tag] else ():
                t = stack[i][0]
                if t in CLOSED_BY_BLOCK or t == tag and tag in CLOSED_BY_SAME:
                    close(i)
                    break
                if t in SCOPES or t in ("li", "td", "th") and tag != t:
                    break
        flush()
        node, up = len(page.tag), stack[-1][1]
        page.tag.append(tag)
        page.parent.append(up)
        page.depth.append(page.depth[up] + 1)
        page.names.append(names)
        page.attrs.append(attrs)
        page.linked.append(0)
        push(tag, node)
    if at < len(html):
        run.append(html[at:])
    flush()
    return page


def features(page: Page):
    """Feature matrix of a page's nodes."""
    import numpy as np

    n = len(page.tag)
    own, ends, below = np.zeros(n), np.zeros(n), np.zeros(n)
    linked = np.array(page.linked, float)
    for node, text in page.blocks:
        own[node] += len(text)
        ends[node] = max(ends[node], float(text[-1] in ".!?:;\"'…"))
    linked = np.minimum(linked, own)
    below[:] = own
    far = linked.copy()
    for v in range(n - 1, 0, -1):                 # children come after their parents
        below[page.parent[v]] += below[v]
        far[page.parent[v]] += far[v]
    x = np.zeros((n, N_FEATURES))
    for v in range(n):
        x[v, TAG_GROUPS.index(GROUP.get(page.tag[v], "other"))] = 1
        names = page.names[v]
        if names:
            x[v, -1], x[v, -2], x[v, -3] = bool(names & BOILER), bool(names & READERS), bool(names & CONTENT) and not names & (BOILER | READERS)
    x[:, -4] = own > 0
    x[:, -5] = np.log1p(own) / 5
    x[:, -6] = linked / np.maximum(own, 1)
    x[:, -7] = ends
    x[:, -8] = np.log1p(below) / 8
    x[:, -9] = far / np.maximum(below, 1)
    x[:, -10] = (below < 30)
    x[:, -11] = below / max(below[0], 1)
    x[:, -12] = below == 0
    x[:, -13] = 1
    return x


# ---- the model ----

@dataclass(frozen=True)
class Weights:
    unary: tuple[float, ...]      # score of "content" against "not", linear in the features
    pair: tuple[float, ...]       # log potentials of (parent, child): (0,0), (0,1), (1,0), (1,1)


def marginals(score, parent, depth, pair):
    """Content marginals of nodes and, for every node but the roots, of (parent, node) pairs [2 x 2]; several trees at once.

    score: log odds of the unary potentials; parent: node index, -1 for roots; depth: of each node. Upward messages from the deepest level,
    then downward.
    """
    import numpy as np

    n = len(score)
    psi = np.asarray(pair, float).reshape(2, 2)                     # psi[parent, child]
    up = np.stack([np.zeros(n), np.asarray(score, float)], 1)      # unary plus messages of the children
    order = np.argsort(depth, kind="stable")
    bounds = np.searchsorted(depth[order], np.arange(depth.max() + 2)) if n else [0]
    message = np.zeros((n, 2))                                      # of each node to its parent
    levels = [order[bounds[k]:bounds[k + 1]] for k in range(len(bounds) - 1)]
    for nodes in reversed(levels[1:]):
        message[nodes] = np.logaddexp(up[nodes, None, 0] + psi[None, :, 0], up[nodes, None, 1] + psi[None, :, 1])
        np.add.at(up, parent[nodes], message[nodes])
    belief = up.copy()
    both = np.zeros((n, 2, 2))
    for nodes in levels[1:]:
        p = parent[nodes]
        rest = belief[p] - message[nodes]                           # the parent without this child
        joint = rest[:, :, None] + psi[None] + up[nodes][:, None, :]
        belief[nodes] = np.logaddexp(joint[:, 0], joint[:, 1])
        top = joint.max(axis=(1, 2), keepdims=True)
        e = np.exp(joint - top)
        both[nodes] = e / e.sum(axis=(1, 2), keepdims=True)
    return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500))), both


def labels(page: Page):
    """0 / 1 labels of a labelled page: the article, what lies on the way to it, without dropped parts."""
    import numpy as np

    y = np.zeros(len(page.tag), int)
    for v in range(1, len(page.tag)):
        y[v] = int("data-keep" in page.attrs[v] or y[page.parent[v]] == 1 and "data-drop" not in page.attrs[v])
    for v in range(len(page.tag) - 1, 0, -1):
        y[page.parent[v]] |= y[v]
    return y


def train(pages: list[str] | None = None, steps: int = 600, rate: float = 0.5, ridge: float = 0.0005) -> Weights:
    """Weights by gradient ascent on the log likelihood of labelled pages; the gradient needs the marginals of nodes and pairs."""
    import numpy as np

    trees = [parse(h) for h in (PAGES if pages is None else pages)]
    x = np.concatenate([features(t) for t in trees])
    y = np.concatenate([labels(t) for t in trees])
    parent, depth = forest(trees)
    inner = np.flatnonzero(parent >= 0)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[parent[inner]], y[inner]), 1)
    unary, pair = np.zeros(x.shape[1]), np.zeros(4)
    speed_u, speed_p = np.full_like(unary, 1e-8), np.full_like(pair, 1e-8)
    for _ in range(steps):
        p, both = marginals(x @ unary, parent, depth, pair)
        gu = x.T @ (y - p) / len(y) - ridge * unary
        gp = (seen - both[inner].sum(0)).ravel() / len(y) - ridge * pair
        speed_u += gu ** 2
        speed_p += gp ** 2
        unary = unary + rate * gu / np.sqrt(speed_u)
        pair = pair + rate * gp / np.sqrt(speed_p)
    return Weights(tuple(unary.tolist()), tuple(pair.tolist()))


def forest(trees: list[Page]):
    """Parents and depths of several trees, numbered one after the other."""
    import numpy as np

    sizes = [len(t.tag) for t in trees]
    offset = np.concatenate([[0], np.cumsum(sizes)])[:-1] if trees else []
    parent = np.concatenate([np.where(np.array(t.parent) >= 0, np.array(t.parent) + o, -1) for t, o in zip(trees, offset, strict=True)]) if trees else np.zeros(0, int)
    return parent, np.concatenate([np.array(t.depth) for t in trees]) if trees else np.zeros(0, int)


def article(page: Page, marginal, least: float = 0.5) -> str:
    return "\n\n".join(text for node, text in page.blocks if marginal[node] >= least)


def extract_batch(pages: list[str], weights: Weights) -> list[str]:
    """Article texts of a batch of pages."""
    import numpy as np

    if not pages:
        return []
    trees = [parse(h) for h in pages]
    parent, depth = forest(trees)
    p, _ = marginals(np.concatenate([features(t) for t in trees]) @ np.array(weights.unary), parent, depth, weights.pair)
    out, at = [], 0
    for t in trees:
        out.append(article(t, p[at:at + len(t.tag)]))
        at += len(t.tag)
    return out


def extract(pages: DataFrame, html_col: str = "html", weights: Weights | None = None) -> DataFrame:
    """`pages` with text (the article) and n_chars."""
    weights = weights or train()

    def per_text(texts):
        out = extract_batch([t.decode() if t else "" for t in texts], weights)
        return out, [len(t) for t in out]

    return add_columns(pages, html_col, "text string, n_chars long", per_text)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: main text of every page."""
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
