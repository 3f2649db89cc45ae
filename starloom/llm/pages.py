"""Main text of web pages by a tree-structured graphical model.

Every node of a page's tree is content or not. A node's own features speak for one or the other;
parent-child potentials tie it to its parent and children. Sum-product messages, once up and once
down the tree, give each node's marginal exactly. Feature weights and potentials are fitted on
labelled pages.
"""

from __future__ import annotations

import html
import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Pages of the table that train the model beside the labelled ones below: those whose ids have
#: the smallest hashes. Their <article> and <main> subtrees are taken for content.
TRAINED_ON = 300
#: Longer pages are not trained on, and no more bytes in all, as the sample goes to the driver.
LONGEST_SAMPLED, MOST_SAMPLED = 4 << 20, 32 << 20
STEPS = 400
RATE = 1.0
DECAY = 1e-3

# Fixed values of HTML: elements without content, raw elements, elements that stand as blocks.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe object select svg math canvas audio video button head".split())
UNPARSED = frozenset("script style textarea title noscript iframe".split())
BLOCK = frozenset(
    "address article aside blockquote body dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - {"body", "html", "tr", "td", "th", "tbody", "thead", "tfoot"}
#: An opening tag ends an open element of the second kind, up to one of the third.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Parts of class names and ids that pages use for either kind.
ASIDE_NAMES = re.compile(
    r"(^|[^a-z])(nav|navbar|menu|header|masthead|footer|sidebar|side|aside|ads?|advert\w*|promo\w*|sponsor\w*|banner|cookies?|consent|"
    r"notice|alert|popup|modal|comments?|replies|respond|form|login|signup|search|share|sharing|social|related|recommend\w*|"
    r"subscribe|newsletter|widget|breadcrumbs?|pagination|pager|tags|copyright|legal|toolbar|skip)([^a-z]|$)"
)
MAIN_NAMES = re.compile(r"(^|[^a-z])(article|main|content|post|entry|story|body|text|page-content|prose)([^a-z]|$)")

TOKEN = re.compile(r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|$)|<[!?][^>]*(?:>|$)", re.S)
ATTRIBUTE = re.compile(r"(class|id|role|data-main)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


@dataclass
class Node:
    """An element, or a piece of text (then `tag` is empty)."""

    tag: str
    parent: int
    text: str = ""
    names: str = ""
    label: int | None = None
    chars: int = 0
    linked: int = 0
    stops: int = 0
    pieces: int = 0
    children: list[int] = field(default_factory=list)


def raw_ends(page: str, tag: str) -> dict[int, int]:
    """Where each element `tag` ends, by the place of its opening tag. Self-closed tags open
    nothing; those without a matching end tag are left out. A <body> ends an open <head>."""
    names = "|".join(sorted(UNPARSED | {tag} | ({"body"} if tag == "head" else set())))
    token = re.compile(rf"<!--.*?(?:-->|$)|<(/?)({names})(?=[\s/>])((?:[^>\"']|\"[^\"]*\"|'[^']*')*)", re.I | re.S)
    ends, opened, at = {}, [], 0
    while found := token.search(page, at):
        at = found.end()
        name = (found[2] or "").lower()
        if not name or not found[1] and found[3].rstrip().endswith("/"):
            continue
        if found[1]:
            if name == tag and opened:
                ends[opened.pop()] = page.find(">", at) + 1 or len(page)
        elif name == tag:
            opened.append(found.start())
        elif name == "body":
            ends.update((start, found.start()) for start in opened)
            opened.clear()
        else:
            end = re.compile(rf"</{name}[\s/>]", re.I).search(page, at)
            if end is None:
                break
            at = end.end()
    return ends


def parse(page: str, labelled: bool = False) -> list[Node]:
    """Nodes in page order, each after its parent. Nothing of scripts, styles, heads and controls.

    Of a control without an end tag only the tag is left out. `data-main` is read in labelled
    pages only, as any other page may use it for something else."""
    nodes = [Node("html", -1)]
    open_nodes = [0]
    at, skip = 0, None
    ends: dict[str, dict[int, int]] = {}

    def close(tags, stop=frozenset()) -> None:
        for depth in range(len(open_nodes) - 1, 0, -1):
            tag = nodes[open_nodes[depth]].tag
            if tag in tags:
                del open_nodes[depth:]
                return
            if tag in stop:
                return

    def add_text(text: str) -> None:
        if text and not text.isspace():
            parent = open_nodes[-1]
            nodes[parent].children.append(len(nodes))
            nodes.append(Node("", parent, text))
        elif text:
            nodes[open_nodes[-1]].children.append(-1)  # white space between pieces

    while at < len(page):
        found = TOKEN.search(page, at)
        if skip is not None:
            end = re.compile(rf"</{skip}[\s/>]", re.I).search(page, at) if skip in UNPARSED else None
            if skip in UNPARSED:
                if end is None:
                    break
                at, skip = page.find(">", end.start()) + 1 or len(page), None
                continue
        if found is None:
            add_text(page[at:])
            break
        add_text(page[at : found.start()])
        at = found.end()
        if found[2] is None:
            continue
        tag = found[2].lower()
        if found[4] == "":  # the page ends inside a tag
            break
        if found[1]:
            if tag == "p" and not any(nodes[k].tag == "p" for k in open_nodes):
                continue
            close({tag}, frozenset() if tag in BLOCK else BLOCK)
            continue
        if tag in ("html", "body") and tag == "html":
            continue
        if tag in RAW:
            if found[3].rstrip().endswith("/"):
                continue
            if tag in UNPARSED:
                skip = tag
            else:  # leave out what is inside, nested or not
                if tag not in ends:
                    ends[tag] = raw_ends(page, tag)
                at = ends[tag].get(found.start(), at)
            continue
        if tag in CLOSES_P:
            close({"p"}, {"td", "th", "table", "body", "article", "section", "div", "li", "main", "blockquote"})
        if tag in IMPLIED:
            close(*IMPLIED[tag])
        if tag in VOID:
            nodes[open_nodes[-1]].children.append(-1)
            continue
        attributes = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(found[3])} if found[3].strip() else {}
        label = attributes.pop("data-main", None)
        node = Node(tag, open_nodes[-1], names=" ".join(attributes.values()).lower(), label=int(label) if labelled and label is not None else None)
        nodes[open_nodes[-1]].children.append(len(nodes))
        nodes.append(node)
        if not found[3].rstrip().endswith("/"):
            open_nodes.append(len(nodes) - 1)
    return nodes


def measure(nodes: list[Node]) -> None:
    for k in range(len(nodes) - 1, -1, -1):
        node = nodes[k]
        if not node.tag:
            node.chars, node.pieces = len(node.text), 1
            node.stops = sum(node.text.count(c) for c in ".!?")
        if node.tag == "a":
            node.linked = node.chars
        if node.parent >= 0:
            parent = nodes[node.parent]
            parent.chars += node.chars
            parent.linked += node.linked
            parent.stops += node.stops
            parent.pieces += node.pieces


FEATURES: dict[str, int] = {}
WIDTH = 512


def _feature(name: str) -> int:
    """A feature's place: tags and the like hashed to 512 places."""
    place = FEATURES.get(name)
    if place is None:
        total = 0
        for c in name.encode():
            total = (total * 131 + c + 7) % 1_000_003
        place = FEATURES[name] = total % WIDTH
    return place


def features(nodes: list[Node], k: int) -> list[int]:
    node = nodes[k]
    size = min(int(math.log2(node.chars + 1)), 12)
    linked = int(4 * node.linked / node.chars) if node.chars else 0
    stops = min(3, int(math.log2(1 + 400 * node.stops / node.chars))) if node.chars else 0
    if not node.tag:
        return [_feature("text"), _feature(f"text size {size}"), _feature(f"text stops {stops}"), _feature("text in " + nodes[node.parent].tag)]
    out = [_feature("tag " + node.tag), _feature(f"linked {linked}"), _feature(f"size {size}"), _feature(f"stops {stops}"), _feature("bias")]
    if node.names:
        if ASIDE_NAMES.search(node.names):
            out.append(_feature("aside name"))
        elif MAIN_NAMES.search(node.names):
            out.append(_feature("main name"))
    return out


@dataclass
class Model:
    weights: np.ndarray
    #: Log potentials of (parent state, child state) for each kind of tie.
    ties: np.ndarray


FRAMES = frozenset(("html", "body", "div", "section", "center", "table", "tbody", "tr", "td"))


def tie_kind(nodes: list[Node], k: int) -> int:
    """0: a text in its element; 1: an element in a frame, where content may begin; 2: any other."""
    if not nodes[k].tag:
        return 0
    parent = nodes[nodes[k].parent]
    return 1 if parent.tag in FRAMES and not ASIDE_NAMES.search(parent.names) else 2


def _labels(nodes: list[Node]) -> list[int]:
    out = []
    for node in nodes:
        above = out[node.parent] if node.parent >= 0 else 0
        out.append(node.label if node.label is not None else above)
    return out


def fit(pages: list[list[Node]]) -> Model:
    """Weights by logistic regression, potentials from how labels of parents and children go
    together beyond chance (each label pair counted once more than seen)."""
    rows, columns, target = [], [], []
    ties = np.ones((3, 2, 2))
    for nodes in pages:
        labels = _labels(nodes)
        for k, node in enumerate(nodes):
            for f in features(nodes, k):
                rows.append(len(target))
                columns.append(f)
            target.append(labels[k])
            if node.parent >= 0:
                ties[tie_kind(nodes, k), labels[node.parent], labels[k]] += 1
    rows, columns, target = np.array(rows), np.array(columns), np.array(target, float)
    weights = np.zeros(WIDTH)
    scale = np.maximum(np.bincount(columns, minlength=WIDTH), 20.0)
    for _ in range(STEPS):
        error = 1 / (1 + np.exp(-np.bincount(rows, weights=weights[columns], minlength=len(target)))) - target
        weights -= RATE * (np.bincount(columns, weights=error[rows], minlength=WIDTH) / scale + DECAY * weights)
    share = ties / ties.sum(axis=(1, 2), keepdims=True)
    potentials = np.log(share / (share.sum(axis=2, keepdims=True) * share.sum(axis=1, keepdims=True)))
    return Model(weights, potentials)


def marginals(nodes: list[Node], model: Model) -> list[float]:
    """Probability of content of every node, by one pass of messages up and one down."""
    weights, ties = model.weights.tolist(), np.exp(model.ties).tolist()
    own = [sum(weights[f] for f in features(nodes, k)) for k in range(len(nodes))]
    belief = [(1.0, math.exp(max(min(s, 30.0), -30.0))) for s in own]
    up = [(1.0, 1.0)] * len(nodes)
    kinds = [0] + [tie_kind(nodes, k) for k in range(1, len(nodes))]
    for k in range(len(nodes) - 1, 0, -1):
        tie, (b0, b1) = ties[kinds[k]], belief[k]
        m0, m1 = tie[0][0] * b0 + tie[0][1] * b1, tie[1][0] * b0 + tie[1][1] * b1
        total = m0 + m1
        up[k] = (m0 / total, m1 / total)
        p = nodes[k].parent
        p0, p1 = belief[p][0] * up[k][0], belief[p][1] * up[k][1]
        total = p0 + p1
        belief[p] = (p0 / total, p1 / total)
    for k in range(1, len(nodes)):
        tie, p = ties[kinds[k]], belief[nodes[k].parent]
        r0, r1 = p[0] / max(up[k][0], 1e-300), p[1] / max(up[k][1], 1e-300)
        total = (r0 + r1) or 1.0
        r0, r1 = r0 / total, r1 / total
        b0 = belief[k][0] * (tie[0][0] * r0 + tie[1][0] * r1)
        b1 = belief[k][1] * (tie[0][1] * r0 + tie[1][1] * r1)
        total = (b0 + b1) or 1.0
        belief[k] = (b0 / total, b1 / total)
    return [b[1] / ((b[0] + b[1]) or 1.0) for b in belief]


def main_text(page: str, model: Model) -> str:
    """Blocks of content in page order, joined by two line breaks."""
    nodes = parse(page)
    measure(nodes)
    content = marginals(nodes, model)
    blocks: list[str] = []
    current: list[str] = []

    def end_block() -> None:
        text = " ".join(html.unescape("".join(current)).split())
        if text:
            blocks.append(text)
        current.clear()

    stack: list[tuple[int, int]] = [(0, 0)]
    while stack:
        k, child = stack.pop()
        node = nodes[k]
        if child == 0 and node.tag in BLOCK:
            end_block()
        if child < len(node.children):
            stack.append((k, child + 1))
            c = node.children[child]
            if c < 0:
                current.append(" ")
            elif nodes[c].tag:
                stack.append((c, 0))
            elif content[c] >= 0.5:
                current.append(nodes[c].text)
        elif node.tag in BLOCK:
            end_block()
    end_block()
    return "\n\n".join(blocks)


_LONG = "It was late in the year when the river rose, and nobody in the valley had seen so much rain. "
_MORE = "They moved the animals to higher ground; by morning the lower fields were gone. "
#: Labelled pages: a subtree with data-main="1" is content, one with "0" is not.
LABELLED = (
    f'<body><header class="masthead"><a href="/">Home</a><p>The valley paper</p></header><nav><ul><li><a href="/a">News</a></li><li><a href="/b">Sport</a></li></ul></nav><article data-main="1"><h1>The flood</h1><p>{_LONG}</p><p>{_MORE * 3}</p><p>So it went.</p><ul><li>Rain fell for nine days.</li><li>Three bridges broke.</li></ul><div class="ad" data-main="0">Buy boots now.</div><p>{_LONG}{_MORE}</p></article><aside class="sidebar"><h3>Most read</h3><ul><li><a href="/c">Ten best boots</a></li></ul></aside><footer>&copy; The valley paper. All rights reserved.</footer></body>',
    f'<body><div class="cookie-notice"><p>We use cookies. By reading on you agree to them.</p></div><div id="menu"><a href="/">Start</a> <a href="/x">About</a></div><div id="content" data-main="1"><h1>Bread</h1><h2>Flour</h2><p>{_MORE}</p><blockquote>{_LONG}</blockquote><p>Bake it.</p><table><tr><td>Flour</td><td>500 g</td></tr><tr><td>Water</td><td>350 g</td></tr></table></div><div id="comments"><h3>Comments</h3><div class="comment"><p>I tried this and it was very good, thank you for it.</p></div><div class="comment"><p>{_LONG}</p></div><form><label>Your name</label><input><p>Write a reply.</p></form></div><div class="footer"><p>Imprint and contact.</p></div></body>',
    f'<body><header><h1>My pages</h1></header><main data-main="1"><section><h2>First</h2><p>{_LONG * 2}</p><pre>x = 1</pre></section><section><h2>Second</h2><p>{_MORE}<a href="/q">a source</a> {_LONG}</p></section><div class="share-buttons" data-main="0"><a href="/s">Share</a> <a href="/t">Send</a></div><form class="newsletter" data-main="0"><p>Get our letter every week. It is free.</p></form></main><div class="related"><h4>Related</h4><p><a href="/r">Another story of the river</a></p></div><footer><p>{_MORE}</p></footer></body>',
    f'<body><div class="banner promo"><p>Only today: all boots at half the price!</p></div><div class="post"><div class="entry-text" data-main="1"><h1>Boots</h1><p>{_MORE}</p><p>{_LONG}</p><p>{_LONG}{_MORE}</p></div><div class="tags"><a href="/t1">boots</a> <a href="/t2">mud</a></div></div><section class="comments-area"><p>{_MORE}</p><p>Me too.</p></section><div class="widget"><p>Weather: rain, nine degrees.</p></div></body>',
    f'<body data-main="1"><p>{_LONG}</p><p>{_MORE}</p><p>{_LONG * 2}</p><p>The end.</p></body>',
    f'<body><nav><a href="/">Up</a></nav><div data-main="1"><h1>Plain</h1><p>{_LONG}</p><div><p>{_MORE * 2}</p><p>Yes.</p></div><p>{_LONG}</p></div><div class="alert"><p>This site will be closed on Sunday.</p></div><footer><div><p>Write to us at any time. We answer within a week.</p></div></footer></body>',
    f'<body><article data-main="1"><header><h1>Inside</h1><p>{_LONG}</p></header><p>{_MORE}</p><figure><figcaption>The river in spring.</figcaption></figure><aside class="advert" data-main="0"><p>{_LONG}</p></aside><p><b>{_LONG}</b> {_MORE}</p><footer data-main="0"><p>Filed under rivers.</p></footer></article><section id="respond"><h3>Leave a reply</h3><p>{_LONG}</p></section></body>',
)


def labelled_sample(pages: DataFrame, count: int) -> list[list[Node]]:
    """Trees of the sampled pages, <article> and <main> labelled as content.

    One row a page_id is read, none of more than LONGEST_SAMPLED bytes, in the order of the ids' hashes
    as long as they take MOST_SAMPLED bytes at most.
    """
    known = pages.select("page_id", "html").where((F.octet_length("html") <= LONGEST_SAMPLED) & F.col("page_id").isNotNull())
    chosen = known.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(count)
    sample = known.join(F.broadcast(chosen), "page_id", "left_semi").groupBy("page_id").agg(F.min("html").alias("html"))
    total = F.sum(F.octet_length("html")).over(Window.orderBy(F.xxhash64("page_id"), "page_id"))  # of `count` rows
    rows = sample.withColumn("total", total).where(F.col("total") <= MOST_SAMPLED).orderBy("page_id").collect()
    out = []
    for row in rows:
        nodes = parse(row.html)
        mains = [n for n in nodes if n.tag in ("article", "main")]
        for node in nodes:
            if node.tag in ("nav", "aside", "form") or ASIDE_NAMES.search(node.names):
                node.label = 0
        for node in mains:
            node.label = 1
        if mains:
            out.append(nodes)
    return out


def trained(pages: DataFrame, trained_on: int = TRAINED_ON, labelled: tuple[str, ...] = LABELLED) -> Model:
    trees = [parse(x, labelled=True) for x in labelled] * 20 + labelled_sample(pages, trained_on)
    for nodes in trees:
        if nodes[0].chars == 0:
            measure(nodes)
    return fit(trees)


def extracted(pages: DataFrame, trained_on: int = TRAINED_ON) -> DataFrame:
    """page_id, url, text and n_chars (code points) for each row of `pages`, from its whole html.

    The model is fitted on the labelled pages and a bounded sample. A null or empty html, and one
    without content, gives an empty text. Broken markup is read as far as it goes: a tag that the
    page ends in is dropped. Rows that repeat a page give equal results; null ids and urls are
    passed on; other columns are ignored; an empty table gives an empty result.
    """
    model = trained(pages, trained_on)

    def extract(batches):
        for batch in batches:
            texts = [main_text(x, model) if x else "" for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(extract, "page_id long, url string, text string, n_chars long")
