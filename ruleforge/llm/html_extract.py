"""Main text of web pages by wrapper induction over aligned trees.

The pages of a host fall into layouts by their frame of sections, FRAME elements deep. Each layout of MIN_PAGES different pages or more has a
wrapper, and so have the other pages of a host together, as layout 0: the tree of one page, against which all
different pages of the layout are aligned by simple tree matching (the alignment of two child lists that keeps their order and pairs most nodes, level by level).
Text nodes of the wrapper that nearly all pages hold alike are constant, the others are slots. A page is then aligned with its wrapper again:
what pairs with a constant node and reads the same is template and goes. Of the slots' text that stays which is inside the
article or main element, where the page has one, and not in a part that its tag, role or whole class name calls a menu, header, footer, side bar, notice, advert,
form or reader comment; such parts differ from page to page as the article does, so alignment alone can't tell them.

Wrappers are sent to the executors while all of them together stay under BROADCAST_BYTES; beyond that they are joined by host and layout.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize, prepare, text_chunks

MIN_PAGES, CONSTANT, CONSTANT_INSIDE, FRAME = 4, 0.8, 0.95, 4
BROADCAST_BYTES = 16_000_000
#: Pairs of children between which the best pairing by scores is sought, and pairs of nodes of two pages from which on it isn't any more; lists beyond that are
#: paired by longest common subsequences of equal subtrees, then of equal shapes, then of equal labels.
LIST_PAIRS, PAGE_PAIRS = 400, 20_000
#: Bits of one table of a common subsequence; longer lists are halved.
TABLE_BITS = 1 << 28

_NAME = re.compile(r"[a-zA-Z][a-zA-Z0-9:-]*")
_STOP = re.compile(r"[\"'>]")
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|hidden|style|itemprop|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)

# Element names of the HTML standard.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template textarea iframe svg xmp noembed noframes".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
_SCOPES = frozenset("ul ol dl table select article section main body html div nav aside".split())
_DROPPED = frozenset("head title nav footer aside form button select input textarea menu dialog object audio video canvas map fieldset".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar alertdialog".split())
_SECTIONS = frozenset("html body div section article main nav header footer aside center table form".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
# Words of class names and ids that name parts outside an article; those of article and main elements themselves; words that say nothing beside them.
_PART = frozenset("ad ads adbox adslot adunit adsbygoogle advert adverts advertisement advertising adsense sponsor sponsored promo promos promotion banner cookie cookies cookiebar cookiebanner consent gdpr notice alert popup modal overlay newsletter subscribe subscription nav navbar navigation topnav mainnav subnav menu breadcrumb breadcrumbs sidebar widget footer header masthead topbar toolbar pagination pager share sharing social related recommended recommendations comment comments commentlist usercomments reply replies respond discussion disqus login signup search copyright".split())
_PART_ARTICLE = frozenset("ad ads advert advertisement sponsored promo teaser related comment comments reply replies".split())
_PLAIN = frozenset("article articles area bar block body bottom box button buttons card cards col column container content entry form grid group holder inner item items left link links list main module outer page panel post posts primary reader right row secondary section site slot stories story text title top unit user users wrap wrapper zone".split())
_HEAD = frozenset("header masthead banner".split())
#: What a page or its wrapper has or lacks says nothing of the element itself.
_HAS = ("has-", "with-", "no-", "without-", "is-")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_DIGIT = re.compile(r"\d")


def _named(tokens: list[str], parts: frozenset) -> set[str]:
    """The words of ``parts`` that whole class names consist of, beside words that say nothing: of ``share-buttons`` share, of ``share-price`` none."""
    out: set[str] = set()
    for token in tokens:
        words = [w for w in re.split(r"[-_]+", _CAMEL.sub("-", token).lower()) if w and not w.isdigit()]
        found = parts.intersection(words)
        if found and "-".join(words).startswith(_HAS) is False and all(w in found or w in _PLAIN for w in words):
            out |= found
    return out


class Page:
    """A tree as lists by node number, in page order: parents come before children, node 0 is the root. Text nodes have a text, elements None."""

    __slots__ = ("tag", "label", "name", "parent", "kids", "text", "bad", "head", "main", "headed", "end", "sign", "shape", "size", "weight")

    def __init__(self):
        self.tag, self.label, self.name, self.parent, self.kids, self.text = ["#root"], ["#root"], ["#root"], [-1], [[]], [None]
        self.bad, self.head, self.main, self.headed = [False], [False], [False], [False]

    def add(self, parent: int, tag: str, name: str, label: str, text: str | None = None, bad: bool = False, head: bool = False, main: bool = False) -> int:
        i = len(self.tag)
        self.tag.append(tag), self.name.append(name), self.label.append(label), self.parent.append(parent), self.kids.append([]), self.text.append(text)
        self.bad.append(bad), self.head.append(head), self.main.append(main), self.headed.append(False)
        if text is None or not text.isspace():
            self.kids[parent].append(i)
        return i

    def close(self) -> Page:
        """Ends of the subtrees, children first."""
        self.sign, end, parent = None, list(range(1, len(self.tag) + 1)), self.parent
        for i in range(len(end) - 1, 0, -1):
            if end[i] > end[parent[i]]:
                end[parent[i]] = end[i]
        self.end = end
        return self

    def signed(self) -> Page:
        """With signatures, shapes (labels alone), sizes and weights (2 an element, 1 a text) of the subtrees, which an alignment needs."""
        if self.sign is None:
            text, label, kids, n = self.text, self.label, self.kids, len(self.tag)
            sign, shape, size, weight, leaf = [0] * n, [0] * n, [1] * n, [1] * n, hash("#text")
            for i in range(n - 1, -1, -1):
                if text[i] is not None:
                    sign[i], shape[i] = hash(" ".join(text[i].split())), leaf
                    continue
                mine = kids[i]
                shape[i] = hash((label[i], *[shape[k] for k in mine]))
                sign[i] = hash((label[i], *[sign[k] for k in mine]))
                size[i] += sum([size[k] for k in mine])
                weight[i] += 1 + sum([weight[k] for k in mine])
            self.sign, self.shape, self.size, self.weight = sign, shape, size, weight
        return self


def _tags(page: str):
    """(text before, tag name or None, whether it closes, attributes) from start to end; each character is read a bounded number of times."""
    at, n, last, quotes = 0, len(page), page.rfind(">"), {'"': page.rfind('"'), "'": page.rfind("'")}
    trusted, text = True, []
    while True:
        i = page.find("<", at)
        if i < 0:
            break
        after = page[i + 1 : i + 2]
        if after in ("!", "?"):
            text.append(page[at:i])
            if page.startswith("<!--", i):
                j = page.find("-->", i + 4)
                at = n if j < 0 else j + 3
            elif page.startswith("<![CDATA[", i):
                j = page.find("]]>", i + 9)
                at = n if j < 0 else j + 3
            else:
                j = page.find(">", i)
                at = n if j < 0 else j + 1
            continue
        closes = after == "/"
        m = _NAME.match(page, i + 1 + closes)
        if m is None or i > last:
            if i > last:
                break
            text.append(page[at : i + 1])
            at = i + 1
            continue
        j, end = m.end(), -1
        while trusted and end < 0:
            stop = _STOP.search(page, j)
            if stop is None:
                break
            if stop.group() == ">":
                end = stop.start()
            elif stop.start() < quotes[stop.group()]:
                j = page.find(stop.group(), stop.end()) + 1
            else:
                break
        if end < 0:  # quotes that don't close: from here on they count for nothing
            trusted, end = False, page.find(">", m.end())
        name = m.group().lower()
        text.append(page[at:i])
        at = end + 1
        if name in _RAW and not closes:
            found = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
            j = page.find(">", found.end()) if found else -1
            at = n if j < 0 else j + 1
            continue
        yield "".join(text) if len(text) > 1 else text[0], name, closes, page[m.end() : end]
        text = []
    text.append(page[at:])
    yield "".join(text), None, False, ""


def parse(page: str, texts: bool = True) -> Page:
    """The tree of a page (its elements alone without ``texts``); unclosed and misnested tags are closed as browsers mostly would. Time and memory grow with its length alone."""
    tree = Page()
    stack, tags, block, open_ = [0], ["#root"], [0], {}

    def cut(k: int) -> None:
        for t in tags[k:]:
            open_[t].pop()
        del stack[k:], tags[k:], block[k:]

    def last(names) -> int:
        return max((open_[t][-1] for t in names if open_.get(t)), default=-1)

    for text, tag, closes, attributes in _tags(page):
        if text and texts:
            tree.add(stack[-1], "#text", "#text", "#text", _html.unescape(text) if "&" in text else text)
        if tag is None:
            continue
        if closes:
            k = last((tag,))
            if k > 0 and (tag not in _INLINE or k > block[-1]):
                cut(k)
            continue
        if tag in _CLOSES_P:
            if tags[block[-1]] == "p":
                cut(block[-1])
        elif tag in _ENDS:
            k = last(_ENDS[tag])
            if k > last(_SCOPES):
                cut(k)
        node = _element(tree, stack[-1], tag, attributes)
        if tag in _HEADINGS:
            tree.headed[stack[-1]] = True
        if tag not in _VOID and not attributes.endswith("/"):
            open_.setdefault(tag, []).append(len(stack))
            block.append(block[-1] if tag in _INLINE else len(stack))
            stack.append(node), tags.append(tag)
    return tree.close()


def _element(tree: Page, parent: int, tag: str, attributes: str) -> int:
    if not attributes or attributes.isspace() or attributes == "/":
        return tree.add(parent, tag, tag, tag, None, tag in _DROPPED, tag == "header", tag in ("article", "main"))
    found = {m.group(1).lower(): (m.group(2) or m.group(3) or m.group(4) or "") for m in _ATTRIBUTE.finditer(attributes)}
    tokens = f"{found.get('class', '')} {found.get('id', '')}".split()
    role = found.get("role", "").lower()
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
    main = tag in ("article", "main") or role in ("main", "article") or found.get("itemprop", "").lower() == "articlebody"
    # Names on the elements around an article describe the page, not a part of it.
    parts = set() if tag in ("html", "body") else _named(tokens, _PART_ARTICLE if main else _PART)
    bad = tag in _DROPPED or hidden or role in _ROLES or bool(parts)
    head = tag == "header" or tag not in _DROPPED and bool(_HEAD & parts)
    name, label = ".".join((tag, *tokens)), ".".join((tag, *(t for t in tokens if not _DIGIT.search(t))))
    tree.add(parent, "main" if role == "main" else tag, name, label, None, bad, head, main and not bad)
    return len(tree.tag) - 1


def layout(tree: Page) -> int:
    """The hash of a page's frame, never 0."""
    import xxhash

    out, todo = set(), [(0, "", FRAME)]
    while todo:
        node, path, depth = todo.pop()
        for k in tree.kids[node]:
            if tree.tag[k] in _SECTIONS:
                out.add(f"{path}/{tree.name[k]}")
                if depth > 1 and not tree.main[k]:
                    todo.append((k, f"{path}/{tree.name[k]}", depth - 1))
    h = xxhash.xxh3_64_intdigest("\0".join(sorted(out)))
    return (h - (1 << 64) if h >> 63 else h) or 1


def _rows(a: list, b: list) -> list[int]:
    """For each prefix of ``a`` the places of ``b`` (bits) where its common subsequence with ``b`` does not grow."""
    places: dict = {}
    for j, y in enumerate(b):
        places[y] = places.get(y, 0) | 1 << j
    whole, v, out = (1 << len(b)) - 1, (1 << len(b)) - 1, []
    for x in a:
        u = v & places.get(x, 0)
        v = (v + u | v - u) & whole
        out.append(v)
    return out


def _grown(a: list, b: list):
    """Lengths of the longest common subsequences of ``a`` and each prefix of ``b``."""
    import numpy as np

    places: dict = {}
    for j, y in enumerate(b):
        places[y] = places.get(y, 0) | 1 << j
    whole = v = (1 << len(b)) - 1
    for x in a:
        u = v & places.get(x, 0)
        v = (v + u | v - u) & whole
    bits = np.unpackbits(np.frombuffer(v.to_bytes(-(-len(b) // 8), "little"), np.uint8), bitorder="little")[: len(b)]
    return np.r_[0, np.cumsum(1 - bits.astype(np.int64))]


def common(a: list, b: list) -> list[tuple[int, int]]:
    """Places (in a, in b) of a longest common subsequence, in order; by tables of bits, of bounded size."""
    out, n = [], min(len(a), len(b))
    s = next((k for k in range(n) if a[k] != b[k]), n)
    e = next((k for k in range(n - s) if a[-1 - k] != b[-1 - k]), n - s)
    todo = [(s, len(a) - e, s, len(b) - e)]
    while todo:
        i, p, j, q = todo.pop()
        if i == p or j == q:
            continue
        if (p - i) * (q - j) > TABLE_BITS and p - i > 1:
            half = (i + p) // 2
            least = _grown(a[i:half], b[j:q]) + _grown(a[half:p][::-1], b[j:q][::-1])[::-1]
            cut = j + int(least.argmax())
            todo += [(i, half, j, cut), (half, p, cut, q)]
            continue
        rows = _rows(a[i:p], b[j:q])
        x, y = p - i, q - j
        while x and y:
            if rows[x - 1] >> y - 1 & 1:
                y -= 1
            else:
                x -= 1
                if not x or rows[x - 1] >> y - 1 & 1:
                    y -= 1
                    out.append((i + x, j + y))
    return [(k, k) for k in range(s)] + sorted(out) + [(len(a) - e + k, len(b) - e + k) for k in range(e)]


def _parts(a: list[int], b: list[int], x: Page, y: Page, most: int) -> tuple[list, list]:
    """(pairs, gaps) of two child lists: what is paired for good, and the stretches between where scores decide, of ``most`` pairs of children at most."""
    pairs, gaps = [], [(a, b)]
    for name in ("sign", "shape", "label"):
        of_x, of_y = getattr(x, name), getattr(y, name)
        rest = []
        for p, q in gaps:
            if len(p) * len(q) <= most:
                rest.append((p, q))
                continue
            i = j = 0
            for u, v in [*common([of_x[k] for k in p], [of_y[k] for k in q]), (len(p), len(q))]:
                if u > i and v > j:
                    rest.append((p[i:u], q[j:v]))
                if u < len(p):
                    pairs.append((p[u], q[v]))
                i, j = u + 1, v + 1
        gaps = rest
    return pairs, [g for g in gaps if len(g[0]) * len(g[1]) <= most]  # of what is still long, no two labels pair in order


def aligned(x: Page, y: Page) -> list[tuple[int, int]]:
    """Pairs (node of x, node of y) of text nodes that simple tree matching pairs and that read the same.

    Equal subtrees at both ends of two child lists are paired at once, which no other pairing can beat, and subtrees of equal shape node by node. The rest is
    paired by dynamic programming over the scores of all pairs of equal labels; in lists of more than LIST_PAIRS pairs equal subtrees, shapes and labels are paired first, by their longest
    common subsequences, and scores decide between them.
    """
    x.signed(), y.signed()
    score: dict = {}

    def middle(i: int, j: int) -> tuple[int, list[int], list[int]]:
        a, b, s, e = x.kids[i], y.kids[j], 0, 0
        n = min(len(a), len(b))
        while s < n and x.sign[a[s]] == y.sign[b[s]]:
            s += 1
        while e < n - s and x.sign[a[-1 - e]] == y.sign[b[-1 - e]]:
            e += 1
        return s, a[s : len(a) - e], b[s : len(b) - e]

    def worth(i: int, j: int) -> int:
        if x.sign[i] == y.sign[j]:
            return 2 * x.size[i]
        if x.shape[i] == y.shape[j]:
            return x.weight[i]
        return score.get((i, j), 0) if x.label[i] == y.label[j] else 0

    def table(a: list[int], b: list[int]) -> list[list[int]]:
        rows, width = [[0] * (len(b) + 1)], range(len(b))
        label = [y.label[j] for j in b]
        for i in a:
            up, row, best, mine, sign = rows[-1], [0], 0, x.label[i], x.sign[i]
            for k in width:
                if up[k + 1] > best:
                    best = up[k + 1]
                if label[k] == mine or y.sign[b[k]] == sign:
                    w = up[k] + worth(i, b[k])
                    if w > best:
                        best = w
                row.append(best)
            rows.append(row)
        return rows

    todo, parts = [(0, 0)] if x.shape[0] != y.shape[0] else [], {}
    while todo:
        i, j = todo.pop()
        if (i, j) in parts:
            continue
        _, a, b = middle(i, j)
        pairs, gaps = parts[i, j] = _parts(a, b, x, y, LIST_PAIRS if len(parts) + len(todo) <= PAGE_PAIRS else 0)
        todo += [(p, q) for p, q in pairs if x.shape[p] != y.shape[q]]
        todo += [(p, q) for a, b in gaps for p in a for q in b if x.label[p] == y.label[q] and x.shape[p] != y.shape[q]]
    for i, j in reversed(parts):  # children before parents
        _, a, b = middle(i, j)
        pairs, gaps = parts[i, j]
        found = sum([worth(*p) for p in pairs]) + sum([table(*g)[-1][-1] for g in gaps])
        score[i, j] = 2 + found + 2 * (x.size[i] - 1 - sum([x.size[k] for k in a]))

    out, todo = [], [(0, 0)]
    while todo:
        i, j = todo.pop()
        if x.shape[i] == y.shape[j]:
            if x.text[i] is not None:
                out += [(i, j)] if x.sign[i] == y.sign[j] else []
            else:
                todo += zip(x.kids[i], y.kids[j], strict=True)
            continue
        s, a, b = middle(i, j)
        todo += zip(x.kids[i][:s], y.kids[j][:s], strict=True)
        rest = len(x.kids[i]) - s - len(a)
        if rest:
            todo += zip(x.kids[i][-rest:], y.kids[j][-rest:], strict=True)
        pairs, gaps = parts[i, j]
        todo += pairs
        for a, b in gaps:
            rows, p, q = table(a, b), len(a), len(b)
            while p and q:
                if rows[p][q] == rows[p - 1][q]:
                    p -= 1
                elif rows[p][q] == rows[p][q - 1]:
                    q -= 1
                else:
                    p, q = p - 1, q - 1
                    todo.append((a[p], b[q]))
    return out


def constants(base: Page, pages: int, counts: dict[int, int]) -> list[int]:
    """The text nodes of a wrapper that stay the same, from how many of its pages hold each alike."""
    inside, within = {}, -1
    for i in range(len(base.tag)):
        within = max(within, base.end[i]) if base.main[i] else within
        inside[i] = i < within
    longest = max((i for i in inside if inside[i] and base.text[i] is not None and not base.text[i].isspace()), key=lambda i: (len(base.text[i]), i), default=None)
    # Copies of an article are no template: inside one only what nearly all pages share goes, and only if the articles differ.
    copied = longest is not None and 2 * counts.get(longest, 1) > pages
    return sorted(i for i, n in counts.items() if n - 1 >= (CONSTANT_INSIDE if inside[i] else CONSTANT) * (pages - 1) and not (inside[i] and copied))


class Wrapper:
    __slots__ = ("base", "constant")

    def __init__(self, base: str, constant):
        self.base, self.constant = parse(base), frozenset(constant)

    def template(self, tree: Page) -> set[int]:
        """The text nodes of a page that belong to the template."""
        return {i for i, j in aligned(tree, self.base) if j in self.constant} if self.constant else set()


def induce(pages: list[str]) -> Wrapper | None:
    """The wrapper of some pages of one layout, or None if fewer than MIN_PAGES differ; the same as the distributed one."""
    trees = {p: parse(p) for p in pages}
    if len(trees) < MIN_PAGES:
        return None
    base = min(trees)
    counts = Counter(j for t in trees.values() for _, j in aligned(t, trees[base]))
    return Wrapper(base, constants(trees[base], len(trees), counts))


def _mains(tree: Page) -> list[int]:
    """Outermost article or main elements; a main that holds articles gives way to them."""
    frames: list = [(len(tree.tag), -1, [])]
    i = 0
    while True:
        while i >= frames[-1][0] and len(frames) > 1:
            _, node, found = frames.pop()
            frames[-1][2].extend(found or [node])
        if i >= len(tree.tag):
            return frames[0][2]
        if tree.text[i] is None and tree.bad[i]:
            i = tree.end[i]
        elif tree.main[i] and tree.tag[i] == "main":
            frames.append((tree.end[i], i, []))
            i += 1
        elif tree.main[i]:
            frames[-1][2].append(i)
            i = tree.end[i]
        else:
            i += 1


def _beyond_links(tree: Page) -> list[bool]:
    """Whether each node holds text outside links."""
    out = [t is not None and not t.isspace() for t in tree.text]
    for i in range(len(out) - 1, 0, -1):
        if out[i] and tree.tag[i] != "a":
            out[tree.parent[i]] = True
    return out


def extract(page: str | None, wrapper: Wrapper | None = None, tree: Page | None = None) -> str:
    """The main text: blocks in page order, white space runs as one space; empty if there is none."""
    if not page:
        return ""
    tree = tree or parse(page)
    template = wrapper.template(tree) if wrapper else frozenset()
    mains = _mains(tree)
    beyond = None if mains else _beyond_links(tree)
    out: list = []
    for top in mains or [0]:
        i, ends = top if top == 0 else top + 1, []
        while i < tree.end[top]:
            while ends and ends[-1] <= i:
                ends.pop()
                out.append("\n")
            if tree.text[i] is not None:
                if i not in template:
                    out.append(tree.text[i])
            elif i:
                # A header inside an article that holds a heading is the article's title.
                if (tree.bad[i] or tree.head[i]) and not (mains and tree.head[i] and tree.headed[i]) or not mains and tree.tag[i] in ("ul", "ol") and not beyond[i]:
                    out.append("\n")
                    i = tree.end[i]
                    continue
                if tree.tag[i] not in _INLINE:
                    out.append("\n")
                    ends.append(tree.end[i])
            i += 1
        out.append("\n")
    return " ".join("".join(out).split())


def _framed(batches):
    """(host, key, layout) of each page."""
    import pyarrow as pa

    for batch in text_chunks(batches, columns=("html",)):
        yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("key"), pa.array([layout(parse(p, False)) for p in batch.column("html").to_pylist()], pa.int64())], ["host", "key", "layout"])


def _laid_out(batches):
    import pyarrow as pa

    for batch in text_chunks(batches, columns=("html",)):
        at = pa.array([layout(parse(p, False)) if p else None for p in batch.column("html").to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns, at], [*batch.schema.names, "layout"])


class _Wrappers:
    """Finds the wrapper of each row: among those sent along, by host and layout, or else in the row itself."""

    def __init__(self, shared):
        self.shared, self.made = shared, {}

    def of(self, batch):
        if self.shared is None:
            for at, base, constant in zip(batch.column("at").to_pylist(), batch.column("base").to_pylist(), batch.column("constant").to_pylist(), strict=True):
                yield None if base is None else (at, self._made(base, constant))
        else:
            known = self.shared.value
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                mine = known.get(host) if page else None
                tree = parse(page) if mine else None
                at = None if tree is None else layout(tree)
                at = at if tree is None or at in mine else 0
                yield (None, tree) if tree is None or at not in mine else (at, self._made(*mine[at]), tree)

    def _made(self, base, constant):
        key = (base, tuple(constant))
        if key not in self.made:
            if len(self.made) > 500:
                self.made.clear()
            self.made[key] = Wrapper(base, constant)
        return self.made[key]


def _matched(shared):
    """(host, layout, key, nodes): the text nodes of the wrapper that each page holds alike."""

    def run(batches):
        import pyarrow as pa

        wrappers = _Wrappers(shared)
        for batch in text_chunks(batches, columns=("html",)):
            at, nodes = [], []
            for found, page in zip(wrappers.of(batch), batch.column("html").to_pylist(), strict=True):
                if found is None or found[0] is None:
                    at.append(None), nodes.append([])
                    continue
                tree = found[2] if len(found) > 2 else parse(page)
                at.append(found[0]), nodes.append([j for _, j in aligned(tree, found[1].base)])
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(at, pa.int64()), batch.column("key"), pa.array(nodes, pa.list_(pa.int32()))], ["host", "layout", "key", "nodes"])

    return run


def _decided(batches):
    """From wrappers with the counts of their nodes: their constant nodes."""
    import pyarrow as pa

    for batch in batches:
        out = []
        for base, pages, nodes in zip(batch.column("base").to_pylist(), batch.column("pages").to_pylist(), batch.column("nodes").to_pylist(), strict=True):
            out.append(constants(parse(base), pages, {x["node"]: x["n"] for x in nodes or ()}))
        yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("layout"), batch.column("base"), pa.array(out, pa.list_(pa.int32()))], ["host", "layout", "base", "constant"])


def _extracted(shared):
    def run(batches):
        import pyarrow as pa

        wrappers = _Wrappers(shared)
        for batch in text_chunks(batches, columns=("html",)):
            texts = []
            for found, page in zip(wrappers.of(batch), batch.column("html").to_pylist(), strict=True):
                known = found is not None and found[0] is not None
                texts.append(extract(page, found[1] if known else None, found[-1] if found is not None and isinstance(found[-1], Page) else None))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return run


def _meeting(pages: DataFrame, wrappers: DataFrame):
    """(pages, shared): the wrappers as a broadcast value if they are small, else beside each page."""
    spark = pages.sparkSession
    size = wrappers.agg(F.sum(F.length("base") + 8 * F.size("constant") + 64)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        known: dict = {}
        for r in wrappers.collect():
            known.setdefault(r.host, {})[r.layout] = (r.base, list(r.constant))
        return pages, spark.sparkContext.broadcast(known)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pages.schema)
    rows = pages.mapInArrow(_laid_out, f"{kinds}, layout long")
    own = wrappers.select("host", "layout", F.col("base").alias("base1"), F.col("constant").alias("constant1"))
    rest = wrappers.filter("layout = 0").select("host", F.col("base").alias("base0"), F.col("constant").alias("constant0"))
    rows = rows.join(own, ["host", "layout"], "left").join(rest, "host", "left")
    mine = F.col("base1").isNotNull()
    return rows.select(*pages.columns, F.when(mine, F.col("layout")).otherwise(0).cast("long").alias("at"), F.coalesce("base1", "base0").alias("base"), F.when(mine, F.col("constant1")).otherwise(F.col("constant0")).alias("constant")), None


def wrappers_of(pages: DataFrame) -> DataFrame:
    """(host, layout, base, constant) of the layouts that have a wrapper, from all different pages (host, key, html); key is a digest of html.

    Pages of layouts without one meet in layout 0 of their host, if MIN_PAGES of them differ; if not, layout 0 is the host's most common layout.
    """
    frames = materialize(pages.mapInArrow(_framed, "host string, key string, layout long").distinct(), "frames")
    sizes = frames.groupBy("host", "layout").agg(F.count("*").alias("pages"), F.min("key").alias("key"))
    enough = F.col("pages") >= MIN_PAGES
    own = sizes.filter(enough)
    most = own.groupBy("host").agg(F.max_by(F.struct("pages", "key"), F.struct("pages", "layout")).alias("m"))
    others = sizes.filter(~enough).groupBy("host").agg(F.sum("pages").alias("pages"), F.min("key").alias("key")).filter(enough)
    rest = others.join(most, "host", "full").select("host", F.lit(0).cast("long").alias("layout"), F.coalesce("pages", "m.pages").alias("pages"), F.coalesce("key", "m.key").alias("key"), F.col("pages").isNull().alias("lent"))
    chosen = materialize(own.select("host", "layout", "pages", "key", F.lit(False).alias("lent")).unionByName(rest), "chosen")
    bases = pages.join(chosen.select("host", "key").distinct(), ["host", "key"]).groupBy("host", "key").agg(F.first("html").alias("base"))
    bases = materialize(chosen.join(bases, ["host", "key"]).select("host", "layout", "pages", "lent", "base", F.array().cast("array<int>").alias("constant")), "bases")
    met, shared = _meeting(pages.select("host", "key", "html"), bases.select("host", "layout", "base", "constant"))
    # Copies of a page count once.
    matched = met.mapInArrow(_matched(shared), "host string, layout long, key string, nodes array<int>").filter("layout is not null")
    matched = matched.groupBy("host", "layout", "key").agg(F.first("nodes").alias("nodes"))
    counts = matched.select("host", "layout", F.explode("nodes").alias("node")).groupBy("host", "layout", "node").agg(F.count("*").alias("n"))
    counts = materialize(counts.filter(F.col("n") > 1).groupBy("host", "layout").agg(F.collect_list(F.struct("node", "n")).alias("nodes")), "counts")
    decided = bases.filter("not lent").join(counts, ["host", "layout"], "left").select("host", "layout", "base", "pages", "nodes")
    decided = materialize(decided.mapInArrow(_decided, "host string, layout long, base string, constant array<int>"), "decided")
    # A lent layout 0 is the wrapper of the layout that its page comes from.
    lent = bases.filter("lent").select("host", "base", "layout").join(decided.select("host", "base", "constant").dropDuplicates(["host", "base"]), ["host", "base"]).select("host", "layout", "base", "constant")
    out = materialize(decided.unionByName(lent), "wrappers")
    for x in (frames, chosen, bases, counts, decided):
        discard(x)
    return out


def host_of(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/:?#]+)", 1))


def main_texts(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text.

    pages needs page_id, url and html; other columns are not read. Null or empty html gives an empty text. Pages without a host, and hosts with fewer than MIN_PAGES
    different pages, are read without a wrapper. Repeated rows stay. Pages may be of any length and depth. An empty table gives no rows.
    """
    prepare(pages.sparkSession)
    pages = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    hosts = pages.withColumn("host", host_of(F.col("url")))
    wrappers = wrappers_of(hosts.filter("host != '' and html != ''").select("host", F.md5("html").alias("key"), "html"))
    met, shared = _meeting(hosts, wrappers)
    kind = pages.schema["page_id"].dataType.simpleString()
    return met.mapInArrow(_extracted(shared), f"page_id {kind}, url string, text string")


def counted(pages: DataFrame) -> DataFrame:
    """main_texts() with n_chars, the code points of the text (0 if it is empty). Nulls, repeats and empty tables as there."""
    return main_texts(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
