"""HTML extraction (operator 5): wrapper induction by simple tree matching.

Per host, one page is the wrapper's skeleton (the one with the least hash, taken by a partial
aggregate).  Every page's DOM tree is aligned with its host's skeleton by simple tree matching,
which gives each node a slot that same-host pages share.  Texts are counted per slot over
different pages and over different articles: text that most of a host's pages and articles hold in the
same slot is template; what varies, and what copies of one article share, is content.  Varying slots of menus, adverts and the like are told from the article by their
elements and class names, since they vary too.
"""

from __future__ import annotations

import html as htmllib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renewlens.llm.common import int_array, pieces, stored

# Names fixed by HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul".split())
#: An open element of the first kind ends where one of the second begins.
ENDED_BY = {
    "p": frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option", "optgroup"]),
    "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "tr": frozenset(["tr", "tbody", "tfoot"]), "head": frozenset(["body"]),
}
#: An end tag doesn't reach over these.
SCOPES = frozenset("article aside body button caption footer form header html main nav section table td th".split())

# What is never article text: elements, and names (class, id and role).
DROPPED = frozenset("head script style noscript template title nav menu aside footer form button select option textarea input iframe object embed applet svg canvas audio video dialog map".split())
DROPPED_WORDS = frozenset("ad ads adv advert advertisement advertising adbox banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus footer header masthead menu modal nav navbar navigation newsletter notice notices notification pagination pager paywall popup promo promotion recommended related respond search share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget complementary contentinfo".split())
#: Beside such words a name of several parts still means what DROPPED_WORDS say ("site-footer", "ad-box") ...
PLACES = frozenset("site main top bottom left right primary secondary global box bar block area container wrapper wrap list item items link links buttons slot unit inner outer text bottombar topbar".split())
#: ... and beside these, the words that can't be the article's own head or body ("post-comments").
OF_ARTICLE = frozenset("post posts article articles entry page".split())
AROUND = frozenset("ad ads advert advertisement comments commentlist share sharing related recommended respond navigation nav pagination social sidebar".split())
MAIN = frozenset(["article", "main"])
#: A whole class, id or role that marks the main part of a page.
MAIN_NAMES = frozenset(["main", "main-content"])
#: Names that a text element of an article may have as well.
SOFT = frozenset(["recommended", "search", "social"])
TEXT = frozenset("p blockquote q pre h1 h2 h3 h4 h5 h6 li dd dt figure figcaption fieldset".split())
#: Never dropped by their names.
KEPT = frozenset(["html", "body", "main", "article"])

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAMING = frozenset(["class", "id", "role"])
_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\s*(?:!|;|$)", re.I)
_WORD = re.compile(r"[a-z]+|\d+")
#: Pairs of siblings beyond which the best alignment is computed by whole rows, keeping two bits a pair.
BEST_PAIRS = 40_000
#: A page whose blocks outside the common ones hold less than this share of its text is a copy of a common
#: article: of what is inside article or main, and of pages without such blocks, where template is text too.
OWN_SHARE_MAIN, OWN_SHARE = 0.5, 0.2


class Node:
    """An element: label (tag and class words), children (elements and strings), elements, slot once aligned."""

    __slots__ = ("tag", "label", "words", "hidden", "named", "soft", "main", "children", "elements", "slot", "shape")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.children, self.elements, self.slot = tag, [], [], 0
        self.words, self.hidden, self.named, self.soft, self.shape = frozenset(), False, False, False, 0
        self.main = 2 if tag == "main" else int(tag == "article")
        names = ""
        if attributes and not attributes.isspace():
            found = []
            for m in _ATTRIBUTE.finditer(attributes):
                name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
                if name in _NAMING:
                    found.append(value)
                elif name == "hidden":
                    self.hidden = True
                elif name == "aria-hidden":
                    self.hidden |= value.strip().lower() == "true"
                elif name == "style":
                    self.hidden |= bool(_DISPLAY.search(value))
            if found:
                names = " ".join(found).lower()
                self.words = frozenset(_WORD.findall(names))
                whole = names.split()
                if not MAIN_NAMES.isdisjoint(whole):
                    self.main = 2
                if self.words & DROPPED_WORDS and tag not in KEPT:
                    bad = [name for name in whole if surrounding(name)]
                    self.named = bool(bad)
                    self.soft = tag in TEXT and SOFT.issuperset(bad)
        self.label = f"{tag} {names}" if names else tag


def surrounding(name: str) -> bool:
    """Whether a class, id or role names what surrounds articles: a dropped word, or a compound of such words and of
    places; "has-sidebar" or "entry-header" isn't."""
    parts = _WORD.findall(name)
    if not any(p in DROPPED_WORDS for p in parts):
        return False
    if all(p in DROPPED_WORDS or p in PLACES or p.isdigit() for p in parts):
        return True
    return all(p in AROUND or p in OF_ARTICLE or p in PLACES or p.isdigit() for p in parts) and any(p in AROUND for p in parts)


def parse(page: str) -> Node:
    """The DOM tree of a page; unclosed and stray tags are mended as browsers do in the usual cases."""
    root = Node("#root")
    stack, at = [root], 0
    for begin, end, closing, tag, attributes in _tokens(page):
        if begin > at:
            stack[-1].children.append(page[at:begin])
        at = end
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if stack[i].tag in SCOPES and tag not in SCOPES:
                    break
            continue
        while len(stack) > 1 and tag in ENDED_BY.get(stack[-1].tag, ()):
            stack.pop()
        if tag in ENDED_BY["p"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    del stack[i:]
                    break
                if stack[i].tag in BLOCKS:
                    break
        node = Node(tag, attributes)
        stack[-1].children.append(node)
        stack[-1].elements.append(node)
        if tag not in VOID and tag not in RAW:
            stack.append(node)
    if at < len(page):
        stack[-1].children.append(page[at:])
    return root


def _tokens(page: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """Tags, comments and declarations: (begin, end, closing, tag, attributes); a raw element is one token."""
    at = 0
    while m := _TOKEN.search(page, at):
        begin, at = m.span()
        tag = m[2] or m[5] or ""
        closing = bool(m[1] or m[4])
        if tag and not closing and tag.lower() in RAW:
            close = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
            if close:
                end = page.find(">", close.start())
                at = end + 1 if end >= 0 else len(page)
            else:
                at = len(page)
        yield begin, at, closing, tag, (m[3] or m[6] or "")


def align(a: Node, b: Node, known: dict[tuple[int, int], int] | None = None) -> None:
    """Simple tree matching of two nodes of equal label: ``b``'s slots go to the matched nodes below ``a``;
    an unmatched node's slot is made of its parent's and its label.  known: weights computed so far."""
    known = {} if known is None else known
    stack = [(a, b)]
    while stack:
        x, y = stack.pop()
        x.slot = y.slot
        pairs = _matched(x.elements, y.elements, known)
        for i, c in enumerate(x.elements):
            if (j := pairs.get(i)) is not None:
                stack.append((c, y.elements[j]))
            else:
                own_slots(c, xxhash.xxh3_64_intdigest(c.label, seed=x.slot))


def _weight(a: Node, b: Node, known: dict[tuple[int, int], int]) -> int:
    """Size of the largest matching of two trees that keeps order and levels; 0 if their labels differ."""
    if a.label != b.label:
        return 0
    if not a.elements or not b.elements:
        return 1
    # pairs wait on the stack until the pairs below them are known
    stack = [(a, b)]
    while stack:
        x, y = stack[-1]
        key = id(x), id(y)
        missing: list[tuple[Node, Node]] = []
        if key not in known:
            if len(x.elements) * len(y.elements) > BEST_PAIRS:
                w = 1 + _by_rows(x.elements, y.elements, known, missing)[0]
            else:
                w = 1 + _best(x.elements, y.elements, known, missing)[0][0]
            if not missing:
                known[key] = w
        if missing:
            stack.extend(missing)
        else:
            stack.pop()
    return known[id(a), id(b)]


def _known(c: Node, d: Node, known: dict[tuple[int, int], int], missing: list[tuple[Node, Node]]) -> int:
    """Weight of two nodes of equal label; 0, and the pair is added to missing, if it isn't known yet."""
    if not c.elements or not d.elements:
        return 1
    if (w := known.get((id(c), id(d)))) is None:
        missing.append((c, d))
        return 0
    return w


def _best(x: list[Node], y: list[Node], known: dict[tuple[int, int], int], missing: list[tuple[Node, Node]]) -> list[list[int]]:
    """best[i][j]: weight of the best alignment of the siblings x[i:] and y[j:], if nothing is missing."""
    below = [0] * (len(y) + 1)
    best = [below]
    for c in reversed(x):
        row = [0] * (len(y) + 1)
        for j in range(len(y) - 1, -1, -1):
            most = below[j] if below[j] > row[j + 1] else row[j + 1]
            d = y[j]
            if c.label == d.label:
                w = below[j + 1] + (_known(c, d, known, missing) if c.elements and d.elements else 1)
                if w > most:
                    most = w
            row[j] = most
        best.append(row)
        below = row
    best.reverse()
    return best


def _shape(node: Node) -> int:
    """A hash of the node's labels all the way down: nodes of one shape weigh the same against any other."""
    order = [node]
    for n in order:
        order.extend(c for c in n.elements if not c.shape)
    for n in reversed(order):
        n.shape = xxhash.xxh3_64_intdigest(n.label + "".join(f" {c.shape}" for c in n.elements)) | 1
    return node.shape


def _by_rows(x: list[Node], y: list[Node], known: dict[tuple[int, int], int], missing: list[tuple[Node, Node]]) -> tuple[int, dict[int, int]]:
    """Weight and pairs of the best alignment of many siblings, as ``_best`` and ``_matched`` have them, if nothing
    is missing.  A row of the table is computed at once, each shape is weighed once, and of a pair only the way
    on is kept."""
    sx, sy = [_shape(c) for c in x], [_shape(d) for d in y]
    ones = dict(zip(sx, x)), dict(zip(sy, y))
    number = {s: k for k, s in enumerate(ones[1])}
    place = np.array([number[s] for s in sy])
    weights = {}
    for s, c in ones[0].items():
        row = np.zeros(len(number), np.int64)
        for t, d in ones[1].items():
            if c.label == d.label:
                row[number[t]] = _known(c, d, known, missing)
        weights[s] = row[place]
    if missing:
        return 0, {}
    below = np.zeros(len(y) + 1, np.int64)
    ways = []
    for s in reversed(sx):
        w = weights[s]
        row = np.zeros(len(y) + 1, np.int64)
        paired = below[1:] + w
        row[:-1] = np.maximum.accumulate(np.maximum(below[:-1], paired)[::-1])[::-1]
        ways.append((np.packbits((w > 0) & (row[:-1] == paired)), np.packbits(row[:-1] == below[:-1])))
        below = row
    ways.reverse()
    out, i, j = {}, 0, 0
    while i < len(x) and j < len(y):
        pair, skip = ((bits[j >> 3] >> (7 - (j & 7))) & 1 for bits in ways[i])
        if pair:
            out[i] = j
            i, j = i + 1, j + 1
        elif skip:
            i += 1
        else:
            j += 1
    return int(below[0]), out


def _matched(x: list[Node], y: list[Node], known: dict[tuple[int, int], int]) -> dict[int, int]:
    """Which of two lists of siblings match in the best alignment."""
    if not x or not y:
        return {}
    if len(x) == 1 and len(y) == 1:
        return {0: 0} if x[0].label == y[0].label else {}
    missing: list[tuple[Node, Node]] = []
    if len(x) * len(y) > BEST_PAIRS:
        out = _by_rows(x, y, known, missing)[1]
        if missing:
            for c, d in missing:
                _weight(c, d, known)
            out = _by_rows(x, y, known, [])[1]
        return out
    best = _best(x, y, known, missing)
    if missing:
        for c, d in missing:
            _weight(c, d, known)
        best = _best(x, y, known, [])
    out, i, j = {}, 0, 0
    while i < len(x) and j < len(y):
        w = _weight(x[i], y[j], known)
        if w and best[i][j] == best[i + 1][j + 1] + w:
            out[i] = j
            i, j = i + 1, j + 1
        elif best[i][j] == best[i + 1][j]:
            i += 1
        else:
            j += 1
    return out


def own_slots(node: Node, slot: int) -> None:
    """Slots of a skeleton, or of nodes that it lacks: by label and place among siblings of that label."""
    stack = [(node, slot)]
    while stack:
        n, s = stack.pop()
        n.slot = s
        seen: dict[str, int] = {}
        for c in n.elements:
            k = seen[c.label] = seen.get(c.label, 0) + 1
            stack.append((c, xxhash.xxh3_64_intdigest(f"{c.label} {k}", seed=s)))


def dropped(node: Node, inside_main: int) -> bool:
    if node.hidden or node.tag in DROPPED or (node.named and not (node.soft and inside_main)):
        return True
    return node.tag == "header" and not inside_main


def spare_article(root: Node) -> None:
    """If names would drop every article and main element of a page, what contains one isn't dropped by its name."""
    stack, named = [root], False
    while stack:
        n = stack.pop()
        if n.tag in MAIN:
            return
        for c in n.elements:
            if c.named:
                named = True
            elif not dropped(c, False):
                stack.append(c)
    if not named:
        return
    order = [root]
    for n in order:
        order.extend(c for c in n.elements if not c.hidden and c.tag not in DROPPED)
    holds = set()
    for n in reversed(order):
        if n.tag in MAIN or any(id(c) in holds for c in n.elements):
            holds.add(id(n))
            n.named = False


def blocks(root: Node) -> list[tuple[int, str, int]]:
    """(slot, text, 2 inside the main part, 1 inside an article, else 0) of the page's blocks in order, without what is
    never article text."""
    spare_article(root)
    out: list[tuple[int, str, int]] = []
    parts: list[str] = []
    owner = [root.slot, 0]

    def end() -> None:
        text = " ".join(htmllib.unescape("".join(parts)).split())
        parts.clear()
        if text:
            out.append((owner[0], text, owner[1]))

    # an explicit stack: pages may nest deeper than Python's
    stack: list[tuple] = [(root, 0, iter(root.children), None)]
    while stack:
        node, main, children, before = stack[-1]
        for c in children:
            if isinstance(c, str):
                parts.append(c)
                continue
            in_main = max(main, c.main)
            if dropped(c, in_main):
                if c.tag in BLOCKS:
                    end()
                continue
            held = None
            if c.tag in BLOCKS:
                end()
                held = tuple(owner)
                owner[:] = c.slot, in_main
            stack.append((c, in_main, iter(c.children), held))
            break
        else:
            if before is not None:
                end()
                owner[:] = before
            stack.pop()
    end()
    return out


def signature(slot: int, text: str) -> int:
    return xxhash.xxh3_64_intdigest(text, seed=slot) >> 1


def page_blocks(page: str | None, skeleton: Node | None) -> list[tuple[int, str, int]]:
    if not page:
        return []
    root = parse(page)
    if skeleton is None:
        own_slots(root, 1)
    else:
        align(root, skeleton)
    return blocks(root)


def main_text(found: list[tuple[int, str, int]], template: frozenset[int]) -> str:
    """The varying blocks; only those inside a main element, or inside articles, if the page has such blocks.
    Articles that hold less text than what is around them are cards, and all varying blocks count."""
    varying = [(text, main) for slot, text, main in found if signature(slot, text) not in template]
    inside = [text for text, main in varying if main]
    if any(main for *_, main in found) and not any(main == 2 for *_, main in found):
        around = sum(len(text) for text, main in varying if not main)
        if sum(map(len, inside)) < around:
            return "\n".join(text for text, _ in varying)
    return "\n".join(inside if any(main for *_, main in found) else [text for text, _ in varying])


class _Skeletons(dict):
    """Page -> its tree with slots; a few are kept."""

    def __missing__(self, page: str) -> Node:
        if len(self) > 64:
            self.clear()
        node = self[page] = parse(page)
        own_slots(node, 1)
        return node


def _page_signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """host, page (a hash of its blocks) and the page's different blocks: sign, characters, inside article or main."""
    skeletons = _Skeletons()
    block = pa.list_(pa.struct([("sign", pa.int64()), ("size", pa.int32()), ("main", pa.bool_())]))
    for batch in pieces(batches):
        hosts, keys, found = [], [], []
        for host, page, skeleton in zip(*(c.to_pylist() for c in batch.columns)):
            signs: dict[int, dict] = {}
            for slot, text, main in page_blocks(page, skeletons[skeleton] if skeleton else None):
                s = signature(slot, text)
                signs.setdefault(s, {"sign": s, "size": len(text), "main": main > 0})
            if signs:
                hosts.append(host)
                keys.append(xxhash.xxh3_64_intdigest(" ".join(map(str, signs))) >> 1)
                found.append(list(signs.values()))
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), int_array(keys), pa.array(found, block)], ["host", "page", "blocks"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    skeletons = _Skeletons()
    for batch in pieces(batches):
        texts = []
        for page, skeleton, template in zip(*(c.to_pylist() for c in batch.columns[2:])):
            found = page_blocks(page, skeletons[skeleton] if skeleton else None)
            texts.append(main_text(found, frozenset(template or ())))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), int_array([len(t) for t in texts])], ["page_id", "url", "text", "n_chars"])


def host_of(url: str = "url") -> Column:
    """Lower-case host of a URL without its port and user; null if there is none."""
    host = F.lower(F.regexp_extract(F.col(url).cast("string"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.when(host != "", host)


def wrappers(pages: DataFrame, least_share: float = 0.6, least_pages: int = 5) -> DataFrame:
    """host, skeleton (a page), template (signatures of slot and text) of every host.

    Template is what at least ``least_share`` of a host's different pages hold in the same slot, and of its
    different articles, if it has ``least_pages`` of these or more; hosts with fewer have no template.  Exact
    copies are one page; pages with little text besides what most pages share (OWN_SHARE) are copies of
    one article, so what only they share stays.  A host's template can't have more
    entries than a page has slots, divided by ``least_share``.  Pages without a host have no wrapper.
    """
    rows = pages.select(host_of().alias("host"), F.col("html").cast("string").alias("html"), F.xxhash64("page_id", "url").alias("h")).where("host is not null and html is not null and html <> ''")
    skeletons = stored(rows.groupBy("host").agg(F.count("*").alias("pages"), F.min(F.struct("h", "html"))["html"].alias("skeleton")), "skeletons")
    signs = rows.join(skeletons.where(F.col("pages") >= least_pages), "host").select("host", "html", "skeleton").mapInArrow(_page_signatures, "host string, page long, blocks array<struct<sign:long,size:int,main:boolean>>")
    different = stored(signs.dropDuplicates(["host", "page"]), "pages")
    pages_of = different.groupBy("host").agg(F.count("*").alias("pages"))
    counts = different.select("host", F.explode("blocks.sign").alias("sign")).groupBy("host", "sign").agg(F.count("*").alias("n"))
    common = (counts.join(pages_of, "host").where((F.col("pages") >= least_pages) & (F.col("n") >= F.col("pages") * least_share))
              .groupBy("host").agg(F.collect_list("sign").alias("common")))
    # the article of a page: a hash of its blocks that aren't common, 0 for copies of a common article
    body = F.expr("filter(blocks, b -> b.main or not exists(blocks, c -> c.main))")
    of = different.join(common, "host").select("host", F.expr("filter(blocks.sign, s -> array_contains(common, s))").alias("shared"), F.expr("exists(blocks, c -> c.main)").alias("in_main"), body.alias("body"), "common")
    of = of.select("host", "shared", "in_main", "body", F.expr("filter(body, b -> not array_contains(common, b.sign))").alias("own"))
    size = "aggregate({0}, 0L, (a, b) -> a + b.size)"
    least = F.when(F.col("in_main"), OWN_SHARE_MAIN).otherwise(OWN_SHARE)
    article = F.when(F.expr(size.format("own")) >= least * F.expr(size.format("body")), F.xxhash64("own.sign")).otherwise(0)
    articles = of.select("host", article.alias("article"), "shared")
    total = articles.select("host", "article").distinct().groupBy("host").agg(F.count("*").alias("articles"))
    held = (articles.select("host", "article", F.explode("shared").alias("sign")).distinct().groupBy("host", "sign").agg(F.count("*").alias("n"))
            .join(total, "host").where((F.col("articles") >= least_pages) & (F.col("n") >= F.col("articles") * least_share))
            .groupBy("host").agg(F.collect_list("sign").alias("template")))
    return stored(skeletons.select("host", "skeleton").join(held, "host", "left"), "wrappers")


def extract(pages: DataFrame, **options) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every row of ``pages``.

    Blocks of the article in page order, joined by one newline; white space inside a block is one space,
    character references are decoded; empty if there is no text or the html is null.  Repeated rows give
    repeated results; other columns aren't read; an empty table gives no rows.
    """
    known = wrappers(pages, **options).withColumnRenamed("host", "host_")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), host_of().alias("host"))
    both = rows.join(known, F.col("host") == F.col("host_"), "left").select("page_id", "url", "html", "skeleton", "template")
    return both.mapInArrow(_texts, "page_id long, url string, text string, n_chars long")
