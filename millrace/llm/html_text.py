"""The main text of web pages by tag-path ratios.

Every piece of text of a page has a path of tags (with their classes) from the root. Per path, text length and
punctuation are summed and divided by its pieces; both ratios are fused, smoothed over
neighbouring pieces in page order, and paths above a threshold (the deviation of all scores) are content.

Content paths say which part of the page is the article: the ``article`` or ``main`` that holds them, or else the
smallest part with nearly all of them. All blocks of that part are kept, short ones too; menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments are told by tag, role,
class and id, or as lists of links, wherever they stand, and have no say in the ratios.

A NULL or empty page gives an empty text. Each row is judged on its own, whatever its id; repeated rows
give repeated results. Markup that is cut off, not closed or wrongly nested is read as far as it goes.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.common import batch_of

# Names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe noembed noframes xmp svg math object select".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An open element of the values ends where one of the keys begins, unless an element of the second set is between.
CLOSED_BY = {
    **{t: (frozenset({"p"}), frozenset({"button", "table", "td", "th", "object"})) for t in BLOCKS - {"body", "html"}},
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu", "table"})),
    "dd": (frozenset({"dd", "dt"}), frozenset({"dl", "table"})),
    "dt": (frozenset({"dd", "dt"}), frozenset({"dl", "table"})),
    "tr": (frozenset({"tr"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "tbody": (frozenset({"thead", "tbody", "tfoot"}), frozenset({"table"})),
    "tfoot": (frozenset({"thead", "tbody"}), frozenset({"table"})),
}
OUTSIDE_TAGS = frozenset("head nav footer aside menu button label input dialog audio video canvas".split())
OUTSIDE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form menu menubar alert alertdialog dialog toolbar".split()
)
OUTSIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored sponsors promo promos promotion "
    "promoted banner sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs masthead header footer cookie "
    "cookies consent gdpr notice notices notification notifications alert alerts popup modal overlay subscribe "
    "subscription newsletter signup login comment comments disqus reply replies respond discussion related recommended "
    "recommendations share sharing social toolbar widget widgets pagination pager search copyright disclaimer sitemap".split()
)
#: Beside one of these in the same name a word of the list above says nothing ("article-header", "has-sidebar").
INSIDE_WORDS = frozenset("article entry post story content main has no with without body page".split())
COMMENT_WORDS = frozenset("comment comments disqus reply replies respond discussion".split())

_token = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
_attribute = re.compile(r"([a-zA-Z][\w:-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_word = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_punctuation = re.compile(r"[^\w\s]")
_closing = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>?", re.I) for t in RAW}

#: Weights of a piece and its neighbours in the smoothing.
KERNEL = np.array([1.0, 4.0, 6.0, 4.0, 1.0])
#: A part holds the article if it has this share of the content; another article beside it counts from half its size on.
MOST, BESIDE = 0.75, 0.5
#: Share of linked characters from which a part with two links or more is a list of links.
LINKED = 0.6


def _names(attributes: dict[str, str]) -> Iterator[set[str]]:
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        yield {w.lower() for w in _word.findall(name)}


class Page:
    """Elements of a page in page order (parents first) and the texts in them."""

    def __init__(self, html: str):
        self.tag, self.parent, self.path, self.outside = ["html"], [-1], [0], [False]
        self.comments: set[int] = set()
        self.named_outside: list[int] = []
        #: Element, text and block of every piece of text; a break is a text of white space.
        self.pieces: list[tuple[int, str, int]] = []
        self._paths: dict[tuple[int, str], int] = {}
        self._read(html)

    def _open(self, tag: str, parent: int, rest: str) -> int:
        found: dict[str, str] = {}
        for name, *values in _attribute.findall(rest) if rest else ():
            found.setdefault(name.lower(), next((unescape(v) for v in values if v), ""))
        label = f"{tag}.{' '.join(found.get('class', '').split())}"
        node = len(self.tag)
        self.tag.append(tag)
        self.parent.append(parent)
        self.path.append(self._paths.setdefault((self.path[parent], label), len(self._paths) + 1))
        hidden = "hidden" in found or "display:none" in found.get("style", "").replace(" ", "").lower()
        in_article = tag == "header" and self._inside(node, {"article", "main"})
        self.outside.append(
            tag in OUTSIDE_TAGS or hidden or found.get("role", "").lower() in OUTSIDE_ROLES or (tag == "header" and not in_article)
        )
        if tag in ("body", "html"):
            self.outside[node] = False
        elif any(w & COMMENT_WORDS and not w & {"no", "has", "with"} for w in _names(found)):
            self.outside[node] = True
            self.comments.add(node)
        elif tag == "form" or any(w & OUTSIDE_WORDS and not w & INSIDE_WORDS for w in _names(found)):
            self.named_outside.append(node)
        if found.get("role", "").lower() == "main" or found.get("itemprop", "").lower() == "articlebody":
            self.tag[node] = "main"
        return node

    def _inside(self, node: int, tags: set[str]) -> bool:
        node = self.parent[node]
        while node >= 0 and self.tag[node] not in tags:
            node = self.parent[node]
        return node >= 0

    def _read(self, html: str) -> None:
        stack, names, opened = [0], ["html"], Counter(["html"])
        block, at = 0, 0

        def pop() -> str:
            stack.pop()
            opened[names[-1]] -= 1
            return names.pop()

        while at < len(html):
            found = _token.search(html, at)
            text = html[at : found.start() if found else len(html)]
            if text:
                self.pieces.append((stack[-1], unescape(text), block))
            if not found:
                return
            at = found.end()
            tag = found["tag"] or found["tag2"]
            if not tag:
                continue
            tag, end = tag.lower(), found["end"] or found["end2"]
            if end:
                if tag == "br":
                    self.pieces.append((stack[-1], " ", block))
                if len(stack) > 1 and opened[tag] and tag not in ("html", "body"):
                    while (last := pop()) != tag:
                        block += last in BLOCKS
                    block += tag in BLOCKS
                if tag in ("td", "th"):
                    self.pieces.append((stack[-1], " ", block))
                continue
            rest = found["rest"] if found["tag"] else found["rest2"]
            if tag == "html" or (tag == "body" and opened["body"]):
                continue
            ends, until = CLOSED_BY.get(tag, (frozenset(), frozenset()))
            for kinds, bounds in ((ends, until), CLOSED_BY["div"] if tag in BLOCKS else (frozenset(), frozenset())):
                if any(opened[k] for k in kinds):
                    place = len(names) - 1
                    while place > 0 and names[place] not in kinds and names[place] not in bounds:
                        place -= 1
                    if place > 0 and names[place] in kinds:
                        while len(names) > place:
                            pop()
            block += tag in BLOCKS
            if tag in VOID or tag in ("td", "th"):
                self.pieces.append((stack[-1], " ", block))
            if tag in VOID:
                continue
            if tag in RAW:
                # The content is no part of the page's text.
                close = None if rest.endswith("/") and tag in ("svg", "math") else _closing[tag].search(html, at)
                at = close.end() if close else (at if rest.endswith("/") else len(html))
                continue
            stack.append(self._open(tag, stack[-1], rest))
            names.append(tag)
            opened[tag] += 1

    def _upwards(self, own: np.ndarray) -> np.ndarray:
        """Sums over each element and all inside it."""
        total = own.tolist()
        for node in range(len(total) - 1, 0, -1):
            total[self.parent[node]] += total[node]
        return np.array(total)

    def _outside(self) -> list[bool]:
        """Whether an element is in a part that is no article: by tag and role, or by name if it holds no article."""
        outside = list(self.outside)
        holds = self._upwards(np.array([
            (t in ("article", "main", "h1")) and n not in self.comments for n, t in enumerate(self.tag)
        ], np.int64))
        for node in self.named_outside:
            outside[node] |= self.tag[node] in ("article", "main", "h1") or not holds[node]
        for node in range(1, len(outside)):
            outside[node] |= outside[self.parent[node]]
        return outside

    def _content(self, nodes: np.ndarray, texts: list[str]) -> np.ndarray:
        """Which pieces lie on content paths."""
        paths = np.array(self.path)[nodes]
        _, of, times = np.unique(paths, return_inverse=True, return_counts=True)
        length = np.bincount(of, [len(t) for t in texts]) / times
        marks = np.bincount(of, [len(_punctuation.findall(t)) for t in texts]) / times
        fused = (length * (1.0 + marks))[of]
        near = np.ones(len(fused))
        smooth = np.convolve(fused, KERNEL)[2:-2] / np.convolve(near, KERNEL)[2:-2]
        score = np.bincount(of, smooth) / times
        return (score >= min(smooth.std(), score.max()))[of]

    def _article(self, weight: np.ndarray, outside: list[bool]) -> list[int]:
        """The elements whose blocks are the article."""
        total = weight[0]
        for kind in ("article", "main"):
            tops = [n for n, t in enumerate(self.tag) if t == kind and not outside[n] and not self._inside(n, {kind})]
            best = max((weight[n] for n in tops), default=0)
            if best and sum(weight[n] for n in tops) >= total / 2:
                return [n for n in tops if weight[n] >= best * BESIDE]
        inner: dict[int, list[int]] = {}
        for node in range(1, len(self.tag)):
            if weight[node] > 0:
                inner.setdefault(self.parent[node], []).append(node)
        part = 0
        while part in inner:
            best = max(inner[part], key=lambda n: weight[n])
            texts = any(self.tag[n] not in BLOCKS - {"p", "pre", "ul", "ol", "dl", "blockquote"} - HEADINGS for n in inner[part])
            cell = self.tag[best] in ("td", "th")
            if weight[best] < MOST * total or (texts and not cell and not self.tag[best] in ("body",)):
                break
            part = best
        return [part]

    def text(self) -> str:
        outside = self._outside()
        body = [(n, t, b) for n, t, b in self.pieces if not outside[n]]
        said = [(n, " ".join(t.split())) for n, t, _ in body]
        said = [(n, t) for n, t in said if t]
        if not said:
            return ""
        nodes, texts = np.array([n for n, _ in said]), [t for _, t in said]
        content = self._content(nodes, texts)
        size = np.array([len(t) for t in texts], float)
        count = len(self.tag)
        weight = self._upwards(np.bincount(nodes, size * content, count))
        roots = set(self._article(weight, outside))
        linked = [False] * count
        for node in range(1, count):
            linked[node] = self.tag[node] == "a" or linked[self.parent[node]]
        whole = self._upwards(np.bincount(nodes, size, count))
        in_links = self._upwards(np.bincount(nodes, size * np.array(linked)[nodes], count))
        links = self._upwards(np.array([t == "a" for t in self.tag], np.int64))
        # From the roots down: inside, but not in a list of links.
        kept = [n in roots for n in range(count)]
        for node in range(1, count):
            listed = (
                self.tag[node] in ("ul", "ol", "dl", "div", "section", "table") and node not in roots
                and links[node] > 1 and in_links[node] >= LINKED * whole[node]
            )
            kept[node] |= kept[self.parent[node]] and not listed and not outside[node]
        if not any(kept[n] and self.tag[n] == "h1" for n in range(count)):
            # The headline may stand in front of the part that holds the article.
            heads = [n for n in range(count) if self.tag[n] == "h1" and not outside[n]]
            if len(heads) == 1 and heads[0] < min(roots):
                kept[heads[0]] = True
                for node in range(heads[0] + 1, count):
                    kept[node] |= kept[self.parent[node]] and self.parent[node] >= heads[0] and not outside[node]
        blocks: dict[int, list[str]] = {}
        for node, text, block in body:
            if kept[node]:
                blocks.setdefault(block, []).append(text)
        found = (" ".join("".join(parts).split()) for _, parts in sorted(blocks.items()))
        return "\n\n".join(t for t in found if t)


def main_text(html: str | None) -> str:
    """The article of one page."""
    return Page(html).text() if html else ""


def extracted(pages: DataFrame) -> DataFrame:
    """Rows (page_id, url, text, n_chars): the main text of every page."""
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    names = ["page_id", "url", "html"]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column("html")]
            schema = pa.schema([
                batch.schema.field("page_id"), batch.schema.field("url"), ("text", pa.string()), ("n_chars", pa.int64())
            ])
            yield batch_of({
                "page_id": batch.column("page_id"), "url": batch.column("url"), "text": texts, "n_chars": [len(t) for t in texts]
            }, schema)

    kind = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint"
    return pages.select(*names).mapInArrow(extract, kind)
