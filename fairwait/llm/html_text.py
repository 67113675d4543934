"""Main text of web pages by paths that the pages of a host agree on.

1. Every page is parsed once; its containers are scored by the text that stands in them outside links and page furniture, with half of a
   container's score passed on to the one around it. The best one is lifted to the article or main part around it, or to a parent that
   holds its heading. Its path of tags and classes, with digits made equal, is the page's vote.
2. Spark counts the votes per host and path. A path with a fair share of its host's votes wins.
3. Every page is read again. All elements of the first winning path that it has give its text, in page order; a page that has none
   falls back on its own best container.

What is furniture is settled after the whole page is read. Element kinds such as ``nav`` always are. A word in a class or id
only makes an element a suspect: it is cleared where it holds the page's main part and half of its text, and where nothing else
of the page would be left; words that describe a layout (``has-sidebar``) are no suspicion at all. Work and memory grow with a page's
length, however deep its elements are nested.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import slices, stored, texts
from .url_filter import host_of

MIN_SHARE = 0.02  # of a host's votes, for a path to win; so a host has 50 at most
BODY_TEXT = 200  # characters outside links that a suspect needs to be the body of a page that has nothing else
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CONTAINERS = frozenset("body article main section div td".split())
# Element kinds and class words of page furniture, fixed values.
_FURNITURE = frozenset(
    "head title script style noscript template nav header footer aside button select option textarea label iframe svg canvas "
    "object audio video map menu dialog".split()
)
_FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb "
    "breadcrumbs sidebar side aside header masthead footer foot cookie cookies consent notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup login search share sharing social related recommended comment comments reply replies "
    "discussion disqus pagination pager widget toolbar skip".split()
)
_TALK = frozenset("comment comments reply replies discussion disqus".split())
_RELATED = frozenset(["related"])
_HIDDEN_CLASSES = frozenset("hidden is-hidden visually-hidden".split())
_LAYOUT = frozenset("has no not with without is overflow".split())  # first words of classes that describe what an element has
_FURNITURE_ROLES = frozenset("navigation banner complementary contentinfo search dialog alert menu menubar toolbar form".split())
_NEVER = frozenset("html body article main".split())
_WHOLE = frozenset("article main".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_BLOCKS = frozenset(
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr caption blockquote pre figure "
    "figcaption address details summary hr nav header footer aside form fieldset center title".split()
)
# A start tag that ends an open element of the listed kinds, up to the nearest enclosing container of the second list.
_ENDS = {
    "li": ({"li"}, {"ul", "ol"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}
_P_ENDERS = _BLOCKS - {"title", "html", "body", "caption", "thead", "tbody", "tfoot", "tr"}
_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)"  # comment
    r"|<(script|style|noscript|template|textarea|title|iframe)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"  # raw text
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"  # tag
    r"|<[/!?a-zA-Z][^>]*(?:>|\Z)"  # declaration or broken tag
    r"|[^<]+|<",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_WORD = re.compile(r"[a-z]+|[0-9]+", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


# What an element's name says: related matter; furniture, as part of a word or as a form; furniture, as its role; readers' comments.
_SEE_ALSO, _HINT, _ROLE, _COMMENTS = 1, 2, 3, 4


def suspicion(value: str) -> int:
    """What a class or id says: 0 for nothing, else the strongest of its words' meanings."""
    found = 0
    for token in value.lower().split():
        words = [w for w in _WORD.findall(token) if not w.isdigit()]
        named = [w for w in words if w in _FURNITURE_WORDS]
        if not named or words[0] in _LAYOUT:
            continue
        if not _TALK.isdisjoint(named):
            found = _COMMENTS
        elif _RELATED.issuperset(words):
            found = max(found, _SEE_ALSO)
        else:
            found = max(found, _ROLE if len(named) == len(words) else _HINT)
    return found


class Page:
    """The parsed page: elements with parent, path and whether they are furniture, and runs of text.

    A path is the number of a (path above, label) pair, so that deep pages don't hold a text per element.
    """

    def __init__(self, html: str):
        self.parent, self.tag, self.link = [-1], ["#root"], [False]
        self.box = [0]  # the container that an element is or stands in, 0 without one
        self.path, self.paths = [0], {}
        self.hard, self.soft, self.plain = [False], [0], [False]
        self.runs: list[tuple[int, int, str]] = []  # (block, element, text)
        self.block = 0
        self.opened: dict[str, int] = {}
        stack = [0]
        for m in _TOKEN.finditer(html):
            name = m.group(3)
            if name is None:
                text = m.group()
                if text[0] != "<" or text == "<":
                    self.runs.append((self.block, stack[-1], text))
                continue
            name = name.lower()
            if name in _BLOCKS:
                self.block += 1
            elif name == "br" or name in ("td", "th"):
                self.runs.append((self.block, stack[-1], " "))
            if m.group(2):
                self._close(stack, name)
            else:
                self._open(stack, name, m.group(4))
        self.out = self._furniture()

    def _cut(self, stack: list[int], k: int) -> None:
        for e in stack[k:]:
            self.opened[self.tag[e]] -= 1
        del stack[k:]

    def _close(self, stack: list[int], name: str) -> None:
        if not self.opened.get(name):
            return
        for k in range(len(stack) - 1, 0, -1):
            if self.tag[stack[k]] == name:
                self._cut(stack, k)
                return
            # An inline end tag does not reach beyond the block it stands in.
            if name not in _BLOCKS and name not in _FURNITURE and self.tag[stack[k]] in _BLOCKS:
                return

    def _open(self, stack: list[int], name: str, attributes: str) -> None:
        if name in _P_ENDERS and self.opened.get("p"):
            self._end(stack, {"p"}, _CONTAINERS | {"li", "blockquote", "figure"})
        if name in _ENDS:
            self._end(stack, *_ENDS[name])
        if name in _VOID or attributes.endswith("/"):
            return
        up = stack[-1]
        label, hard, soft = name, name in _FURNITURE, _HINT if name == "form" else 0
        if attributes:
            for key, *values in _ATTRIBUTE.findall(attributes):
                value, key = next((v for v in values if v), ""), key.lower()
                if key == "class":
                    classes = set(value.split())
                    label += "".join("." + re.sub(r"\d+", "0", c) for c in sorted(classes))
                    hard |= not _HIDDEN_CLASSES.isdisjoint(classes)
                if key in ("class", "id"):
                    soft = max(soft, suspicion(value))
                elif key == "role":
                    soft = max(soft, _ROLE if value.lower() in _FURNITURE_ROLES else 0)
                elif key == "hidden":
                    hard = True
                elif key == "aria-hidden":
                    hard |= value.lower() == "true"
                elif key == "style":
                    hard |= bool(_HIDDEN.search(value))
        e = len(self.tag)
        self.parent.append(up)
        self.tag.append(name)
        self.box.append(e if name in _CONTAINERS else self.box[up])
        # Classes hold no space, so a space can stand for a slash in them.
        self.path.append(self.paths.setdefault((self.path[up], label.replace("/", " ")), len(self.paths) + 1))
        self.hard.append(hard or self.hard[up])
        self.soft.append(0 if name in _NEVER else soft)
        self.plain.append(not soft)
        self.link.append(name == "a" or self.link[up])
        self.opened[name] = self.opened.get(name, 0) + 1
        stack.append(e)

    def _furniture(self) -> list[bool]:
        """Whether each element is furniture or stands in it, once the suspects are settled."""
        soft = self.soft
        if not any(soft):
            return self.hard
        n, talk, whole = len(self.tag), [False] * len(self.tag), [False] * len(self.tag)
        size, links, shown = [0] * n, [0] * n, 0
        for _, e, text in self.runs:
            k = 0 if text.isspace() else len(text)
            shown += k
            if not self.hard[e]:
                size[e] += k
                links[e] += k * self.link[e]
        for e in range(1, n):
            talk[e] = soft[e] == _COMMENTS or talk[self.parent[e]]
            whole[e] = self.tag[e] in _WHOLE or whole[self.parent[e]]
        for e in range(n - 1, 0, -1):
            size[self.parent[e]] += size[e]
            links[self.parent[e]] += links[e]
        for core in self._cores(size, talk):
            left, up = False, self.parent[core]
            while up > 0:
                if 2 * size[up] >= size[0]:
                    soft[up] = 0
                left = left or bool(soft[up])
                up = self.parent[up]
            if not left:
                break
        for e in range(1, n):
            if soft[e] == _SEE_ALSO and self.tag[e] == "section" and whole[e] and 2 * links[e] < size[e]:
                soft[e] = 0
        out = self._spread()
        if not any(not out[e] and not self.link[e] and not text.isspace() for _, e, text in self.runs):
            body = self._only(links, shown)
            while body > 0:
                soft[body] = 0
                body = self.parent[body]
            out = self._spread()
        return out

    def _spread(self) -> list[bool]:
        out = [False] * len(self.tag)
        for e in range(1, len(self.tag)):
            out[e] = self.hard[e] or bool(self.soft[e]) or out[self.parent[e]]
        return out

    def _cores(self, size: list[int], talk: list[bool]) -> Iterator[int]:
        """The longest main part, then the longest article that is no comment, then the first top heading; of each if there is one."""
        for kind in ("main", "article", "h1"):
            found = [e for e in range(1, len(self.tag)) if self.tag[e] == kind and not self.hard[e] and self.plain[e] and (kind == "main" or not talk[e])]
            if found:
                yield found[0] if kind == "h1" else max(found, key=lambda e: size[e])

    def _only(self, links: list[int], shown: int) -> int:
        """The hinted element, in no surer furniture, that is the body of a page without other text; 0 if none is.

        It has half of all text shown and ``BODY_TEXT`` characters, not counting what other suspects in it hold, and mostly no links.
        """
        n = len(self.tag)
        inside, sure = [0] * n, list(self.hard)
        for _, e, text in self.runs:
            inside[e] += 0 if text.isspace() or self.hard[e] else len(text)
        for e in range(n - 1, 0, -1):
            if not self.soft[e]:
                inside[self.parent[e]] += inside[e]
        for e in range(1, n):
            sure[e] = sure[e] or self.soft[e] not in (0, _HINT) or sure[self.parent[e]]
        fit = [e for e in range(1, n) if self.soft[e] == _HINT and not sure[e] and inside[e] >= BODY_TEXT and 2 * inside[e] >= shown and 2 * links[e] < inside[e]]
        return max(fit, key=lambda e: (inside[e], -e), default=0)

    def path_text(self, e: int) -> str:
        label = {number: text for (_, text), number in self.paths.items()}
        labels = []
        while e > 0:
            labels.append(label[self.path[e]])
            e = self.parent[e]
        return "/" + "/".join(reversed(labels))

    def path_number(self, path: str) -> int | None:
        """The number of a path that some element of the page has."""
        at = 0
        for label in path.split("/")[1:]:
            at = self.paths.get((at, label))
            if at is None:
                return None
        return at

    def _end(self, stack: list[int], kinds: set, until: set | frozenset) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if self.tag[stack[k]] in kinds:
                self._cut(stack, k)
                return
            if self.tag[stack[k]] in until:
                return

    def scores(self) -> dict[int, float]:
        """Score of every container."""
        out: dict[int, float] = {}
        for _, e, text in self.runs:
            n = len(text) - text.isspace() * len(text)
            if not n or self.out[e]:
                continue
            weight = -1.0 if self.link[e] else 1.0
            e = self.box[e]
            if not e:
                out[0] = out.get(0, 0.0) + weight * n
            while e > 0 and abs(weight) > 0.1:
                out[e] = out.get(e, 0.0) + weight * n
                weight /= 2
                e = self.box[self.parent[e]]
        return out

    def lifted(self, e: int) -> int:
        """The part of the page that ``e`` is the largest piece of.

        That is the nearest article or main part around it, else a parent with a heading of its own, outside other containers, before
        ``e``; as long as what it adds is not mostly links. The body is never it.
        """
        nearest = up = self._container(self.parent[e])
        headed = None
        while up > 0 and self.tag[up] != "body":
            if self.tag[up] in _WHOLE:
                return up if self._adds(up, e) else headed or e
            if headed is None and up == nearest and self._heading(up, e) and self._adds(up, e):
                headed = up
            up = self._container(self.parent[up])
        return headed or e

    def _container(self, e: int) -> int:
        """The container that ``e`` is or stands in; 0 or less if there is none."""
        return self.box[e] if e > 0 else e

    def _heading(self, up: int, e: int) -> bool:
        heads = [x for x in range(up + 1, e) if self.tag[x] in _HEADINGS and not self.out[x] and self._container(x) == up]
        if not heads:
            return False
        within = self._within(heads)
        return any(within[x] and not text.isspace() for _, x, text in self.runs)

    def _adds(self, up: int, e: int) -> bool:
        """Whether the text in ``up`` outside ``e`` and furniture is not mostly links."""
        around, own = self._within([up]), self._within([e])
        added = [(len(text), self.link[x]) for _, x, text in self.runs if around[x] and not own[x] and not self.out[x] and not text.isspace()]
        return sum(-n if link else n for n, link in added) > 0

    def _within(self, inside: list[int]) -> list[bool]:
        within = [False] * len(self.tag)
        for e in inside:
            within[e] = True
        for e in range(min(inside) + 1, len(self.tag)):
            within[e] = within[e] or within[self.parent[e]]
        return within

    def text(self, inside: list[int]) -> str:
        """Blocks of the elements without furniture, in page order."""
        within = self._within(inside)
        blocks: list[str] = []
        now, parts = -1, []
        for block, e, text in [*self.runs, (-2, inside[0], "")]:
            if block != now:
                words = " ".join(unescape("".join(parts)).split())
                if words:
                    blocks.append(words)
                now, parts = block, []
            if within[e] and not self.out[e]:
                parts.append(text)
        return "\n".join(blocks)


def best(scores: dict[int, float]) -> int | None:
    """The highest-scored container, ties to the first in the page."""
    found = [(s, -e) for e, s in scores.items() if s > 0]
    return -max(found)[1] if found else None


def vote(html: str) -> str | None:
    page = Page(html)
    e = best(page.scores())
    return None if e is None else page.path_text(page.lifted(e))


def read(html: str, paths: list[str]) -> str:
    """Text of the first path that the page has, all its elements with more text than links; else of its own best container, else empty."""
    page = Page(html)
    scores = page.scores()
    for p in paths:
        wanted = page.path_number(p)
        found = [] if wanted is None else [e for e, x in enumerate(page.path) if x == wanted and scores.get(e, 0) > 0]
        if found:
            return page.text(found)
    e = best(scores)
    if e is None:
        return ""
    e = page.lifted(e)
    return page.text([x for x, y in enumerate(page.path) if x == e or (y == page.path[e] and scores.get(x, 0) > 0)])


def winners(pages: DataFrame, host: str, html: str, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, paths): each host's winning paths, most votes first, ties in the order of the path's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array([vote(h) for h in texts(batch.column("html"))], pa.string())], ["host", "path"])

    votes = pages.select(F.col(host).alias("host"), F.col(html).alias("html")).mapInArrow(run, "host string, path string")
    counted = votes.filter("path IS NOT NULL").groupBy("host", "path").agg(F.count("*").alias("votes"))
    # Counted from the counts, so that a hot host is one short row per task.
    total = counted.groupBy("host").agg(F.sum("votes").alias("total"))
    rank = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("votes"), "path"))
    won = counted.withColumn("rank", rank).join(total, "host").filter(F.col("votes") >= min_share * F.col("total"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("rank", "path"))), lambda x: x["path"])
    return won.groupBy("host").agg(listed.alias("paths"))


def extract(pages: DataFrame, url: str = "url", html: str = "html", out: str = "main_text") -> DataFrame:
    """``pages`` less the html column, with the main text in ``out`` (replaced if it is there).

    Null and empty html, and pages without text outside their furniture, give an empty text. Very long and very deep pages are
    read whole, in time and memory that grow with their length. Pages without host vote together. Repeated rows are treated alike. The winners are written first, so that Spark knows their size when it
    chooses how to join them.
    """
    own = pages.drop(out) if out not in (url, html) else pages
    host, paths = "_host_of_page", "_paths_of_host"
    keyed = own.withColumn(host, host_of(F.col(url)))
    won = stored(winners(keyed, host, html), "paths").toDF(host, paths)
    joined = keyed.join(won, host, "left").drop(host)
    kept = [f for f in own.schema.fields if f.name not in (html, out)]
    schema = T.StructType([*kept, T.StructField(out, T.StringType())])
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, html):
            found = [read(h, p or []) for h, p in zip(texts(batch.column(html)), batch.column(paths).to_pylist())]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(found, pa.string())], [*names, out])

    return joined.mapInArrow(run, schema)
