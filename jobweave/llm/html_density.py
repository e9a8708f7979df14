"""Main text of web pages by composite text density.

Every node of a page's tree gets the characters, link characters, tags and link tags below it. Its composite density is characters per
tag, weighed down by the share of links against that of the whole body. The densities of a node's block children are summed up (a block
without such children counts with its own); the subtree with the greatest sum holds the article, and the least density on its path to the body is the threshold that
any further subtree must reach to count as content. Parts that are no article (navigation, forms, adverts, notices,
reader comments and the like) are taken out of the tree first, by element, role, or what a class or id names. A name may also tell what a wrapper holds or
shows (``content-sidebar-wrap``, ``has-sidebar``, ``comments-open``); a wrapper goes as well, unless it holds a heading, the main element or the
page's first article. Articles within an article that has a heading of its own are comments on it.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobweave.llm.common import filled

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>", re.S
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements that an opening tag closes if they are open, up to the first element named after the bar.
CLOSES = {
    "li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"),
    "th": ("td th", "tr table"), "option": ("option", "select"), "tbody": ("tr td th thead tbody", "table"), "tfoot": ("tr td th tbody", "table"),
}
CLOSES = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in CLOSES.items()}
CLOSES_P = BLOCKS - frozenset("body html head title option optgroup caption legend tbody td tfoot th thead tr summary".split())
P_HOLDERS = frozenset("td th li dd div article section main body table button blockquote".split())
#: Names of parts that are no article.
NO_ARTICLE = frozenset("nav footer aside form script style noscript template iframe button select textarea svg canvas head object dialog menu search noembed noframes".split())
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent notice notices alert popup modal overlay newsletter "
    "subscribe subscription signup login comment comments commentlist commentform disqus reply replies gdpr paywall".split()
)
#: Names of parts that a page is laid out in; within a wrapper's name they tell what else it holds.
LAYOUT_WORDS = frozenset(
    "banner menu nav navbar navigation breadcrumb breadcrumbs sidebar footer masthead share sharing social related recommended toolbar pagination pager widget skip".split()
)
#: First words and last words of names that tell what a part has or shows, and last words of a wrapper's name.
HAVING = frozenset("has have with without no show hide".split())
STATES = frozenset("open opened closed enabled disabled on off".split())
WRAPS = frozenset("wrap wrapper layout container grid columns row page inner".split())
HEADINGS = frozenset("h1 h2".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
#: Elements that may stand in a head; any other closes it.
IN_HEAD = frozenset("base basefont bgsound link meta title noscript script style template noframes".split())
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def is_noise(tag: str, attributes: str) -> bool:
    """Whether its element, role or visibility says that a part is no article."""
    if tag in NO_ARTICLE:
        return True
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return False
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and HIDDEN.search(value)):
            return True
        if name == "role" and value.lower() in ROLES:
            return True
    return False


def named_as(tag: str, attributes: str, in_article: bool) -> str:
    """What a class or id says: ``part`` for a part that is no article, ``wrapper`` for what holds or shows one beside others, else nothing."""
    if not attributes or "=" not in attributes or tag in ("body", "html", "main"):
        return ""
    found = ""
    for key, *values in ATTRIBUTE.findall(attributes):
        if key.lower() not in ("class", "id"):
            continue
        for name in "".join(values).split():
            words = [w.lower() for w in NAME_PART.findall(name)]
            layout = LAYOUT_WORDS if in_article else LAYOUT_WORDS | {"header"}
            # one word written as several, as in sideBar
            words = [name.lower()] if name.lower() in NOISE_WORDS | layout else words
            noisy = [i for i, w in enumerate(words) if w in NOISE_WORDS or w in layout]
            if not noisy or (tag == "article" and not NOISE_WORDS & set(words)):
                continue
            wraps = words[-1] in WRAPS and noisy[0] > 0 and not NOISE_WORDS & set(words)
            if words[0] in HAVING or (len(words) > 1 and words[-1] in STATES) or wraps:
                found = found or "wrapper"
            else:
                return "part"
    return found


def parse(page: str) -> tuple[list[str], list[int], list[tuple[int, str]], list[bool]]:
    """Tags, parents, ``(node, text)`` in page order and whether a node is out; node 0 is the root."""
    tags, parents, out, wrappers, texts = ["#root"], [-1], [False], [], []
    stack, at, size = [0], 0, len(page)
    inside_article = 0
    while at < size:
        found = TOKEN.search(page, at)
        begin = found.start() if found else size
        if begin > at:
            if tags[stack[-1]] == "head" and page[at:begin].strip():
                stack.pop()
            texts.append((stack[-1], page[at:begin]))
        if not found:
            break
        at = found.end()
        tag = found[2] or found[5]
        if not tag:
            continue
        tag = tag.lower()
        if found[1] or found[4]:
            depth = len(stack) - 1
            while depth and tags[stack[depth]] != tag:
                depth -= 1
            if depth:
                inside_article -= sum(tags[n] in ("article", "main") for n in stack[depth:])
                del stack[depth:]
            if tag in BLOCKS or tag == "br":
                texts.append((stack[-1], "\0"))
            continue
        if tag == "body" or (tags[stack[-1]] == "head" and tag not in IN_HEAD):
            head = next((n for n in range(len(stack)) if tags[stack[n]] == "head"), len(stack))
            inside_article -= sum(tags[n] in ("article", "main") for n in stack[head:])
            del stack[head:]
        if tag in CLOSES_P or tag in CLOSES:
            closing, until = CLOSES.get(tag, (frozenset(), frozenset()))
            wanted = closing | {"p"} if tag in CLOSES_P else closing
            bound = until | P_HOLDERS - closing
            depth = cut = len(stack)
            while depth > 1 and tags[stack[depth - 1]] not in bound:
                depth -= 1
                if tags[stack[depth]] in wanted:
                    cut = depth
            del stack[cut:]
        attributes = found[3] if found[2] else found[6]
        parent = stack[-1]
        tags.append(tag)
        parents.append(parent)
        says = named_as(tag, attributes or "", inside_article > 0)
        out.append(out[parent] or (tag == "header" and not inside_article) or says == "part" or is_noise(tag, attributes or ""))
        node = len(tags) - 1
        if says == "wrapper" and not out[node]:
            wrappers.append(node)
        if tag in BLOCKS or tag == "br":
            texts.append((node, "\0" if tag != "br" else " "))
        if tag in VOID or (attributes or "").rstrip().endswith("/") and tag not in BLOCKS:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        stack.append(node)
        inside_article += tag in ("article", "main")
    return tags, parents, texts, without_others(tags, parents, out, wrappers)


def without_others(tags: list[str], parents: list[int], out: list[bool], wrappers: list[int]) -> list[bool]:
    """``out``, the wrappers that hold no heading, main element or first article, and the articles within an article with a heading of its own."""
    inner = [n for n, tag in enumerate(tags) if tag == "article" and not out[n]]
    if not wrappers and len(inner) < 2:
        return out
    out = list(out)
    outer = [-1] * len(tags)  # the nearest article around each node
    headed = set()
    for node in range(1, len(tags)):
        up = parents[node]
        outer[node] = up if tags[up] == "article" else outer[up]
        if tags[node] in HEADINGS and not out[node]:
            headed.add(outer[node])
    for node in inner:
        out[node] = outer[node] > 0 and outer[node] in headed
    first = next((n for n in inner if not out[n]), -1)
    holds = [not gone and (n == first or tag == "main" or tag in HEADINGS) for n, (tag, gone) in enumerate(zip(tags, out, strict=True))]
    for node in range(len(tags) - 1, 0, -1):
        holds[parents[node]] |= holds[node]
    for node in wrappers:
        out[node] |= not holds[node]
    for node in range(1, len(tags)):
        out[node] = out[node] or out[parents[node]]
    return out


def content_nodes(tags: list[str], parents: list[int], texts: list[tuple[int, str]], out: list[bool]) -> list[bool]:
    """Which nodes lie in a subtree of content."""
    n = len(tags)
    chars, links, count, anchors = [0] * n, [0] * n, [0] * n, [0] * n
    linked = [False] * n
    for node in range(1, n):
        linked[node] = tags[node] == "a" or linked[parents[node]]
    for node, text in texts:
        if not out[node] and text != "\0":
            size = len("".join(text.split()))
            chars[node] += size
            if linked[node]:
                links[node] += size
    for node in range(n - 1, 0, -1):
        if not out[node]:
            up = parents[node]
            chars[up] += chars[node]
            links[up] += links[node]
            count[up] += count[node] + 1
            anchors[up] += anchors[node] + (tags[node] == "a")
    body = next((i for i in range(n) if tags[i] == "body"), 0)
    ratio = links[body] / chars[body] if chars[body] else 0.0
    density, sums, block = [0.0] * n, [0.0] * n, [False] * n
    for node in range(n - 1, -1, -1):
        c = chars[node]
        if c and not out[node]:
            lc, lt, t = links[node], anchors[node], count[node] or 1
            base = math.log(c * lc / max(1, c - lc) + ratio * c + math.e)
            density[node] = c / t * math.log(max(1.0, c / (lc or 1) * t / (lt or 1)) + 1e-9) / math.log(base + 1e-9) if base > 1 else c / t * math.log(c * t + 1.0)
            block[node] = tags[node] in BLOCKS or block[node]
            sums[node] = sums[node] or density[node]
            if node and block[node]:
                block[parents[node]] = True
                sums[parents[node]] += density[node]
    best = max((i for i in range(n) if not out[i] and block[i]), key=lambda i: (sums[i], -i), default=0)
    threshold, node = density[best], best
    while node > body:
        node = parents[node]
        if node >= 0 and chars[node]:
            threshold = min(threshold, density[node])
    marked = [False] * n
    marked[best] = True
    greatest = list(range(n))
    for node in range(n - 1, 0, -1):
        up = parents[node]
        if not out[node] and block[node] and sums[greatest[node]] > sums[greatest[up]]:
            greatest[up] = greatest[node]
    for node in range(body, n):
        if not out[node] and chars[node] and density[node] >= threshold and block[node]:
            marked[greatest[node]] = True
    for node in range(1, n):
        marked[node] = (marked[node] or marked[parents[node]]) and not out[node]
    return marked


def main_text(page: str) -> str:
    """The article's blocks in page order, one per line."""
    tags, parents, texts, out = parse(page)
    kept = content_nodes(tags, parents, texts, out)
    blocks, now = [], []
    for node, text in texts:
        if text == "\0":
            if now:
                blocks.append(now)
                now = []
        elif kept[node]:
            now.append(html.unescape(text) if "&" in text else text)
    if now:
        blocks.append(now)
    joined = (" ".join("".join(b).split()) for b in blocks)
    return "\n".join(b for b in joined if b)


def extract_pages(pages: DataFrame, markup: str = "html", columns: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``columns``, ``text`` and ``n_chars`` for every page: the article of the whole markup, empty if there is none.

    Null and empty markup give an empty text. Rows are handled one by one: repeated rows and nulls in ``columns`` come out as they went in;
    columns that are not named are not read. Character references are decoded and white space within a block is one blank.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p) for p in filled(batch.column("_markup")).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in columns], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*columns, "text", "n_chars"]
            )

    source = pages.select(*columns, F.col(markup).cast("string").alias("_markup"))
    kinds = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in columns)
    return source.mapInArrow(run, f"{kinds}, text string, n_chars long")
