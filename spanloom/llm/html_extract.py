"""HTML extraction: a fitted classifier and a minimum cut separate content from boilerplate.

A page is read once into blocks (runs of text between block-level tags).  A block has binary features:
its tag, the landmark around it (article, main, nav, footer, ...), the class tokens of the nearest
element that has any and of the next one above (within the landmark), and how long, how linked and how
much of a sentence it is.  A logistic model over these features gives every block a cost of being called
boilerplate and one of being called content, -log of the probability of the contrary; they are the
capacities of its edges to the two terminals.  Neighbouring blocks are joined by smoothness edges that
weaken with their distance in the DOM, blocks of one parent by weaker ones.  The maximum flow's cut is
the labelling of least total cost; content blocks are the main text.

The weights are fitted to the pages themselves, on a bounded sample of them (``sample_pages``): blocks
inside landmarks (but not those in a box of a boilerplate class there) are the training labels, and each is shown with and without its landmark, so that the
other features learn to do without.  A prior holds what is known of HTML, the weights move away from it as
far as the sample asks.  Without pages to learn from, the prior stands.

Inside a block references are decoded, white space becomes one blank, and both ends are trimmed; blocks
are joined by an empty line in page order.  Scripts, styles, templates and comments never become blocks.
A form is boilerplate unless it holds landmarks or a box of a content class: then it wraps the page.  A box whose
class names boilerplate (comments, adverts, a newsletter) counts against all in it, inside an article too, unless
nothing else on the page is text; where a page has an article, what stands around it counts less.

Defined results: null or empty html gives ''; unclosed and stray tags are tolerated; a page without
content blocks gives ''; an unfinished tag at the end is dropped; repeated rows are extracted one by one;
rows of one id stay apart; other columns are ignored.  Time grows with the length of a page.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .toxicity import minimised

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|</?[a-zA-Z/][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role|itemprop|hidden|aria-hidden|style)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?", re.I)
#: Elements whose text is never read; the text runs to the end tag of the same name.
RAW = ("script", "style", "title", "textarea", "noscript", "template", "iframe", "noembed", "noframes", "xmp")
_RAW_END = {name: re.compile("</" + name, re.I) for name in RAW}
#: Elements that hold no article text, whatever is inside.
SILENT = frozenset("head select option button object svg math canvas audio video map datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img br".split())
#: Opening one of these ends an open paragraph.
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
_SAME = frozenset("li tr td th dt dd option".split())
_STOPS = frozenset("ul ol table div article section td dl body".split())
LANDMARKS = frozenset("article main nav footer aside header menu dialog search".split())
#: Landmarks whose inside is boilerplate, whatever other landmarks it holds.
AGAINST = frozenset("nav footer aside menu dialog search form".split())
ROLES = {"navigation": "nav", "menu": "menu", "menubar": "menu", "toolbar": "menu", "banner": "header", "contentinfo": "footer", "complementary": "aside", "search": "search", "dialog": "dialog", "alert": "dialog", "alertdialog": "dialog", "main": "main", "article": "article"}
#: Class tokens that name a state of the page, not the part, begin with these; parts that name any box end with those.
_STATES = frozenset("has is no not with without hide show js".split())
_BOXES = frozenset("box wrapper wrap container slot area block section list item items inner outer unit bar row col group holder links text".split())

#: The prior mean of the weights.
PRIOR = {
    "bias": 0.5, "in:article": 4.0, "in:main": 3.0, "in:nav": -6.0, "in:footer": -6.0, "in:aside": -6.0, "in:form": -7.0, "in:header": -4.0, "in:menu": -6.0, "in:dialog": -6.0, "in:search": -6.0, "in:boxed": -8.0, "in:outside": -4.0,
    "tag:p": 1.0, "tag:h1": 1.0, "tag:h2": 0.5, "tag:h3": 0.5, "tag:blockquote": 0.5, "tag:pre": 0.5, "tag:footer": -1.0, "tag:nav": -1.0, "chars:20": -1.0, "chars:40": -0.5, "chars:80": 0.0, "chars:160": 0.5, "chars:more": 1.5,
    "links:none": 0.3, "links:some": 0.0, "links:many": -1.0, "links:all": -2.5, "sentence": 0.5,
}
#: Class tokens of boilerplate and of content, in units of weight.
PRIOR |= {f"class:{x}": -5.0 for x in "ad ads advert adverts advertisement adsense banner sponsor sponsored promo promoted menu nav navbar navigation breadcrumb breadcrumbs sidebar footer foot masthead header topbar branding logo cookie cookies consent gdpr notice popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations comment comments discussion discussions reactions disqus reply replies respond pagination pager widget widgets copyright legal disclaimer skip toolbar outbrain taboola".split()}
PRIOR |= {f"class:{x}": 2.5 for x in "article articlebody post entry story content main body prose".split()}
#: Tokens whose boxes are boilerplate inside an article too, and those that never wrap an article.
BOXING = frozenset(k[6:] for k, v in PRIOR.items() if k.startswith("class:") and v < 0) - {"header"}
CHATTER = frozenset("comment comments discussion discussions reactions disqus reply replies respond".split())
#: Characters of unlinked text that make an article, for what stands around it.
ENOUGH = 140
SAMPLE_PAGES, DRIFT, NEAR, SIBLING = 2000, 0.02, 1.0, 0.5
#: Costs are whole numbers of this fraction, so that flows are exact.
UNIT = 1 << 10


@dataclass
class Block:
    text: str
    features: tuple[str, ...]
    landmark: str  # "" if there is none
    parent: int  # the element around the one that holds the block
    distance: int  # steps in the DOM from the block before
    box: int = 0  # the outermost element of a boilerplate class around it, within its landmark
    plain: int = 0  # characters that are no links


class _Element:
    """An open element; formatting elements repeat what holds for the block around them."""

    __slots__ = ("name", "number", "parent", "depth", "block", "landmark", "form", "near", "far", "silent", "box")

    def __init__(self, name, number, parent, depth, block, landmark, form, near, far, silent, box=0):
        self.name, self.number, self.parent, self.depth, self.block = name, number, parent, depth, block
        self.landmark, self.form, self.near, self.far, self.silent, self.box = landmark, form, near, far, silent, box


def class_parts(names: str) -> tuple[str, ...]:
    """What class tokens are about: the last part of each that does not name just a box; states say nothing."""
    out = []
    for token in names.lower().split():
        parts = [x for x in re.split(r"[-_]+", token) if x and not x.isdigit()]
        if parts and parts[0] not in _STATES:
            parts = parts[: next((i for i, x in enumerate(parts) if x in _STATES), len(parts))]  # post-with-sidebar is a post
            while len(parts) > 1 and parts[-1] in _BOXES:
                parts.pop()
            out.append(parts[-1])
    return tuple(dict.fromkeys(out))


def _features(text: str, linked: int, element: _Element) -> tuple[str, ...]:
    n, share = len(text), linked / max(1, len(text))
    chars = next((f"chars:{x}" for x in (20, 40, 80, 160) if n < x), "chars:more")
    links = "none" if not linked else "some" if share <= 0.3 else "many" if share <= 0.7 else "all"
    sentence = ("sentence",) if text[-1] in ".?!…。" else ()
    return ("bias", f"tag:{element.block}", chars, f"links:{links}", *sentence, *(f"class:{x}" for x in element.near), *(f"above:{x}" for x in element.far))


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page, in order."""
    out: list[Block] = []
    forms: list[int] = []  # the form around each block
    wrappers: set[int] = set()
    chatter: set[int] = set()
    root = _Element("", 0, 0, 0, "", "", 0, (), (), False)
    stack, opened, pieces = [root], Counter(), []
    linked = number = links = low = last_depth = at = 0

    def flush() -> None:
        nonlocal linked, low, last_depth
        if pieces:
            text = " ".join(html_lib.unescape("".join(pieces)).split())
            if text:
                e = stack[-1]
                out.append(Block(text, _features(text, linked, e), e.landmark, e.parent, (last_depth - min(low, e.depth)) + (e.depth - min(low, e.depth)), e.box, max(0, len(text) - linked)))
                forms.append(e.form)
                low = last_depth = e.depth
            pieces.clear()
        linked = 0

    def pop_to(i: int) -> None:
        nonlocal links, low
        if any(e.name not in INLINE for e in stack[i:]):
            flush()
        for e in stack[i:]:
            opened[e.name] -= 1
            links -= e.name == "a"
        del stack[i:]
        low = min(low, stack[-1].depth)

    def say(text: str) -> None:
        nonlocal linked
        if text and not stack[-1].silent:
            pieces.append(text)
            if links:
                linked += len(text)

    while True:
        m = _TOKEN.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if m[1]:
            i = next(i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name) if opened[name] > 0 else 0
            if name in INLINE:
                if i and all(e.name in INLINE for e in stack[i:]):
                    pop_to(i)
                elif i:  # a formatting tag closed across blocks: forget it
                    links -= name == "a"
                    opened[name] -= 1
                    del stack[i]
            elif i:
                pop_to(i)
            else:
                flush()
            continue
        if name in _RAW_END:
            end = _RAW_END[name].search(page, at)
            at = end.start() if end else len(page)
            flush()
            continue
        if name == "br":
            say(" ")
            continue
        if name in VOID:
            if name not in INLINE:
                flush()
            continue
        top = stack[-1]
        if name in INLINE:
            stack.append(_Element(name, top.number, top.parent, top.depth, top.block, top.landmark, top.form, top.near, top.far, top.silent, top.box))
            opened[name] += 1
            links += name == "a"
            continue
        flush()
        closes = name if name in _SAME else "p" if name in CLOSES_P else ""
        if closes and opened[closes] > 0:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == closes:
                    pop_to(i)
                    break
                if stack[i].name in _STOPS and name != "p":
                    break
        top = stack[-1]
        number += 1
        attributes = {k.lower(): (a or b or c or "") for k, a, b, c in _ATTRIBUTE.findall(m[3])} if m[3] else {}
        mark = ROLES.get(attributes.get("role", "").lower(), name if name in LANDMARKS else "")
        if mark == top.landmark or mark == "header" and top.landmark in ("article", "main"):
            mark = ""  # the heading of the article itself, or an article inside one, as of a comment
        near, far, landmark, form, box = top.near, top.far, top.landmark, top.form, top.box
        if mark:
            near, far, box = (), (), 0
            if form:
                wrappers.add(form)
            if landmark not in AGAINST:
                landmark = mark
        if name == "form":
            form = number
        if name not in ("body", "html") and (own := class_parts(" ".join(attributes.get(k, "") for k in ("class", "id", "itemprop")))):
            near, far = own, near
            known = [PRIOR.get(f"class:{x}", 0.0) for x in own]
            if not box and name != "main" and BOXING.intersection(own) and max(known) <= 0:
                box = number
                if CHATTER.intersection(own):
                    chatter.add(number)
            if form and max(known) > 0 and landmark not in ("article", "main"):
                wrappers.add(form)  # a form around the content of the page
        hidden = "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", "").lower()
        stack.append(_Element(name, number, top.number, top.depth + 1, name, landmark, form, near, far, top.silent or hidden or name in SILENT, box))
        opened[name] += 1
    flush()
    for block, form in zip(out, forms, strict=True):
        if form and form not in wrappers:
            block.landmark = "form"
    _settle_boxes(out, chatter)
    return out


def _settle_boxes(blocks: list[Block], chatter: set[int]) -> None:
    """Boxes of boilerplate classes count against their blocks, and so does standing outside the page's article.

    A box with next to no text beside it wraps the content, whatever its class says (readers' comments never do)."""
    sizes, total = Counter(), 0
    for b in blocks:
        if b.landmark not in AGAINST and b.landmark != "header":
            sizes[b.box] += b.plain
            total += b.plain
    wraps = {n for n, size in sizes.items() if n and n not in chatter and size >= ENOUGH > total - size}
    article = sum(b.plain for b in blocks if b.landmark in ("article", "main") and (not b.box or b.box in wraps)) >= ENOUGH
    for b in blocks:
        if b.box in wraps:
            b.features = tuple(f for f in b.features if PRIOR.get("class:" + f.partition(":")[2], 0.0) >= 0 or not f.startswith(("class:", "above:")))
        elif b.box and b.landmark in ("", "article", "main"):
            b.landmark = "boxed"
        if article and not b.landmark and "tag:h1" not in b.features:
            b.landmark = "outside"


def score(block: Block, weights: dict[str, float]) -> float:
    """Log odds of content; class tokens of the element above count half."""
    known = (weights[f] if f in weights else weights.get("class:" + f[6:], 0.0) / 2 if f.startswith("above:") else 0.0 for f in block.features)
    return sum(known) + weights.get(f"in:{block.landmark}", 0.0)


def costs(block: Block, weights: dict[str, float]) -> tuple[float, float]:
    """Cost of calling a block boilerplate, and of calling it content."""
    z = score(block, weights)
    return float(np.logaddexp(0, z)), float(np.logaddexp(0, -z))


def minimum_cut(source: list[float], sink: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes lie on the source's side of a minimum cut; edges hold both ways.

    A node whose terminals differ by more than all its edges together is settled by them, and its edges then
    count for its neighbours' terminals.  Maximum flow settles what is left."""
    whole = lambda x: round(x * UNIT)
    margin, room = [whole(a) - whole(b) for a, b in zip(source, sink, strict=True)], [0] * len(source)
    near: list[list[tuple[int, int]]] = [[] for _ in source]
    for i, j, c in edges:
        if w := whole(c):
            near[i].append((j, w))
            near[j].append((i, w))
            room[i] += w
            room[j] += w
    side: list[bool | None] = [None] * len(source)
    waiting = list(range(len(source)))
    while waiting:
        i = waiting.pop()
        if side[i] is None and abs(margin[i]) >= room[i]:
            side[i] = margin[i] > 0
            for j, w in near[i]:
                if side[j] is None:
                    margin[j] += w if side[i] else -w
                    room[j] -= w
                    waiting.append(j)
    open_ = [i for i, s in enumerate(side) if s is None]
    if open_:
        at = {i: k for k, i in enumerate(open_)}
        links = [(at[i], at[j], w) for i in open_ for j, w in near[i] if side[j] is None and i < j]
        for i, s in zip(open_, maximum_flow([margin[i] for i in open_], links), strict=True):
            side[i] = s
    return [bool(s) for s in side]


def maximum_flow(margin: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """The source's side of the minimum cut, by blocking flows over levels; margin is source minus sink."""
    n = len(margin)
    s, t = n, n + 1
    to, left, graph = [], [], [[] for _ in range(n + 2)]

    def join(i: int, j: int, forth: int, back: int) -> None:
        graph[i].append(len(to))
        graph[j].append(len(to) + 1)
        to.extend((j, i))
        left.extend((forth, back))

    for i, x in enumerate(margin):
        if x > 0:
            join(s, i, x, 0)
        elif x < 0:
            join(i, t, -x, 0)
    for i, j, w in edges:
        join(i, j, w, w)
    while True:
        level = [-1] * (n + 2)
        level[s], wave = 0, [s]
        while wave and level[t] < 0:
            following = []
            for i in wave:
                for e in graph[i]:
                    if left[e] and level[to[e]] < 0:
                        level[to[e]] = level[i] + 1
                        following.append(to[e])
            wave = following
        if level[t] < 0:
            return [x >= 0 for x in level[:n]]
        turn, path, i = [0] * (n + 2), [], s
        while True:
            if i == t:
                room = min(left[e] for e in path)
                cut = next(k for k, e in enumerate(path) if left[e] == room)
                for e in path:
                    left[e] -= room
                    left[e ^ 1] += room
                i = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while turn[i] < len(graph[i]):
                e = graph[i][turn[i]]
                if left[e] and level[to[e]] == level[i] + 1:
                    path.append(e)
                    i = to[e]
                    break
                turn[i] += 1
            else:
                if i == s:
                    break
                i = to[path.pop() ^ 1]
                turn[i] += 1


def smoothness(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Edges of neighbours, the weaker the more steps lie between them, and of blocks of one parent."""
    edges, last = [], {}
    for i, b in enumerate(blocks):
        if i:
            edges.append((i - 1, i, NEAR * 2 / max(2, b.distance)))
        if b.parent in last and last[b.parent] != i - 1:
            edges.append((last[b.parent], i, SIBLING))
        last[b.parent] = i
    return edges


def label_blocks(blocks: list[Block], weights: dict[str, float] = PRIOR) -> list[bool]:
    """True for content."""
    capacities = [costs(b, weights) for b in blocks]
    return minimum_cut([a for a, _ in capacities], [b for _, b in capacities], smoothness(blocks))


def main_text(page: str | None, weights: dict[str, float] = PRIOR) -> str:
    blocks = blocks_of(page or "")
    return "\n\n".join(b.text for b, keep in zip(blocks, label_blocks(blocks, weights), strict=True) if keep)


# ---------------------------------------------------------------- training
def seeds(page: str | None) -> Counter:
    """(features, label) of the blocks inside landmarks, with and without the landmark: how often."""
    found: Counter = Counter()
    for b in blocks_of(page or ""):
        if b.landmark and b.landmark not in ("boxed", "outside"):
            label = 0 if b.landmark in AGAINST or b.landmark == "header" else 1
            found[" ".join(b.features), label] += 1
            found[" ".join((*b.features, f"in:{b.landmark}")), label] += 1
    return found


def fit(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", sample_pages: int = SAMPLE_PAGES, drift: float = DRIFT) -> dict[str, float]:
    """Weights of the features, from about sample_pages pages, chosen by a hash of id and url."""
    rows = pages.where(F.col(html_col).isNotNull())
    share = sample_pages / max(1, rows.count())
    chosen = rows.where(F.pmod(F.xxhash64(F.col(id_col), F.col(url_col)), F.lit(1_000_000)) < share * 1_000_000).select(F.col(html_col).alias("html"))

    def learn(batches):
        for batch in batches:
            found = sum((seeds(x) for x in batch.column(0).to_pylist()), Counter())
            yield pa.RecordBatch.from_pydict({"features": pa.array([k[0] for k in found], pa.string()), "label": pa.array([k[1] for k in found], pa.int32()), "n": pa.array(found.values(), pa.int64())})

    counted = chosen.mapInArrow(learn, "features string, label int, n long").groupBy("features", "label").agg(F.sum("n").alias("n")).orderBy("features", "label").collect()
    return fitted([(r.features.split(), r.label, r.n) for r in counted], drift)


def fitted(rows: list[tuple[list[str], int, int]], drift: float = DRIFT) -> dict[str, float]:
    """Logistic regression, both classes of equal weight, drawn to the prior by drift per unit of weight."""
    total = Counter()
    for _, label, n in rows:
        total[label] += n
    if len(total) < 2:
        return dict(PRIOR)
    names = sorted({f for fs, _, _ in rows for f in fs if not f.startswith("above:")} | set(PRIOR))
    place = {f: i for i, f in enumerate(names)}
    at = [[place[f] for f in fs if f in place] for fs, _, _ in rows]
    row, col = np.repeat(np.arange(len(rows)), [len(x) for x in at]), np.array([i for x in at for i in x], np.int64)
    y = np.array([label for _, label, _ in rows], float)
    weight = np.array([n / total[label] / 2 for _, label, n in rows])
    prior = np.array([PRIOR.get(f, 0.0) for f in names])

    def value(x):
        z = np.bincount(row, x[col], minlength=len(rows))
        off = weight * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y)
        g = np.bincount(col, off[row], minlength=len(names)) + drift * (x - prior)
        return float(weight @ (np.logaddexp(0, z) - y * z)) + drift / 2 * float((x - prior) @ (x - prior)), g

    x = minimised(value, prior.copy(), 1e-7)
    return dict(zip(names, x.tolist(), strict=True))


def extract(pages: DataFrame, weights: dict[str, float] | None = None, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row of pages: its id, url, text and n_chars; without weights they are fitted to the pages."""
    weights = fit(pages, id_col=id_col, url_col=url_col, html_col=html_col) if weights is None else weights
    held = pages.sparkSession.sparkContext.broadcast(weights)  # one number per feature of a bounded sample

    def run(batches):
        for batch in batches:
            texts = [main_text(x, held.value) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "url": batch.column("url"), "text": pa.array(texts, pa.string()), "n_chars": pa.array(map(len, texts), pa.int64())})

    df = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    types = {c: pages.schema[x].dataType.simpleString() for c, x in (("id", id_col), ("url", url_col))}
    return df.mapInArrow(run, f"id {types['id']}, url {types['url']}, text string, n_chars long").withColumnsRenamed({"id": id_col, "url": url_col})
