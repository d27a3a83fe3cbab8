"""Main text of web pages, by what a host's pages agree on.

Each page scores its containers by the paragraph text they hold and votes for the best one's generalised
path of tags and classes. Votes are counted per host, and pages are read again
with their host's winning paths; a page without such a container falls back on its own best one.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

# Elements without content, elements whose content is not markup, block elements, elements left out.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset((
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul").split())
DROPPED = frozenset("script style noscript template textarea title head nav footer aside form button select iframe svg object canvas dialog menu".split())
CONTAINERS = frozenset(["", *"article body div main section td center blockquote dd".split()])  # "": a fragment's root
# Start tags that end an open element of the second group, up to the nearest of the third.
_IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
            "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
#: Words in a class, id or role that mark what is not the article.
NOISE = re.compile(
    r"(?:^|[-_\s])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|cookies?|consent|disclaimer|disqus|footer|header|login|menu|modal|nav\w*|newsletter|notices?|"
    r"pager|pagination|popup|promo\w*|recommend\w*|related|replies|reply|respond|share|sharing|sidebar|social|sponsor\w*|subscribe|toolbar|widget)(?:$|[-_\s\d])", re.I)
#: Parts of names that tell how a wrapper is laid out.
_STATE = re.compile(r"(?:^|(?<=[-_\s]))(?:has|with|without|no)[-_]+[^-_\s]+", re.I)
#: Noise that may well be longer than the article.
_LONG = re.compile(r"comment|disqus|repl(?:y|ies)|respond|cookie|consent|disclaimer", re.I)
_ARTICLE = ("article", "main")
_PARAGRAPHS = frozenset("p pre blockquote dd td li".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Possessive throughout, and every alternative that has begun ends with the page at the latest: time is linear in the page. A quote
# sign counts after "=" alone; one that is never closed is a sign like others.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|<(?P<end>/)?(?P<tag>[A-Za-z][^\s/>]*+)"
    r"(?P<attrs>(?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?|[\"'])*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


@dataclass(slots=True)
class Node:
    tag: str
    step: str
    up: Node | None
    length: int = 0  # of the path, whose text is only made where it is asked for
    dropped: bool = False
    noisy: str = ""  # class, id and role, if only they say that it is not the article
    links: int = 0
    inside: list = field(default_factory=list)  # str, Node, or None for a line break

    @property
    def path(self) -> str:
        """Steps from the page's root, without the root."""
        steps, n = [], self
        while n.up:
            steps.append(n.step)
            n = n.up
        return ">".join(reversed(steps))


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): next((html.unescape(v) for v in m.groups()[1:] if v is not None), "") for m in _ATTR.finditer(text)} if text.strip(" /\n\t") else {}


def _step(tag: str, attributes: dict[str, str]) -> str:
    """Tag and classes, numbers generalised."""
    classes = sorted({re.sub(r"\d+", "#", c.lower()) for c in attributes.get("class", "").split()})
    return ".".join([tag, *classes])


def parse(page: str) -> Node:
    """Block elements as a tree; inline elements only pass their text on, links count its length.

    What follows the last ``>`` is text, up to a comment; a tag that never ends reaches to that sign.
    """
    root = node = Node("", "", None)
    at, link = 0, 0
    named: list[Node] = []
    opened: Counter[str] = Counter()  # tags of the node and those above it
    last = page.rfind(">") + 1
    page, tail = page[:last], page[last:].partition("<!--")[0]

    def closed(n: Node) -> Node:
        """What is open once ``n``, the node or one above it, has ended."""
        x = node
        while x is not n.up:
            opened[x.tag] -= 1
            x = x.up
        return x

    def text(piece: str) -> None:
        if piece:
            piece = html.unescape(piece)
            node.inside.append(piece)
            if link:
                node.links += len(piece)

    while at < len(page):
        m = _TOKEN.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        if not m["tag"]:
            continue
        tag = m["tag"].lower()
        if m["end"]:
            if tag == "a":
                link = max(0, link - 1)
            elif opened[tag] > 0:
                n = node
                while n.tag != tag:
                    n = n.up
                node, link = closed(n), 0
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\s*+>", re.I).search(page, at)
            at = close.end() if close else len(page)
            continue
        if tag == "br" or tag == "hr":
            node.inside.append(None)
        elif tag == "a":
            link += 1
        elif tag not in VOID and (tag in BLOCK or tag in DROPPED):
            if node.tag == "p" and tag in BLOCK:
                node = closed(node)
            if tag in _IMPLIED and any(opened[x] > 0 for x in _IMPLIED[tag][0]):
                ends, until = _IMPLIED[tag]
                n = node
                while n.up and n.tag not in until and n.tag not in ends:
                    n = n.up
                if n.tag in ends:
                    node = closed(n)
            attributes = _attributes(m["attrs"]) if m["attrs"] else {}
            marks = " ".join(attributes.get(k, "") for k in ("class", "id", "role"))
            # A form may frame the whole page, as a name may.
            noisy = tag == "form" or tag not in ("html", "body", "article", "main") and bool(marks.strip()) and bool(NOISE.search(_STATE.sub(" ", marks)))
            hidden = "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", "")
            step, never = _step(tag, attributes), tag in DROPPED and tag != "form" or tag == "header" or hidden
            new = Node(tag, step, node, node.length + bool(node.up) + len(step), never or noisy)
            if noisy and not never:
                new.noisy = marks if marks.strip() else tag
                named.append(new)
            node.inside.append(new)
            opened[tag] += 1
            node, link = new, 0
    text(tail)
    if named:
        _restore(root, named)
    return root


def _own(n: Node) -> int:
    """Length of the text directly in the node, less its links."""
    return sum(len(x.strip()) for x in n.inside if isinstance(x, str)) - 2 * n.links


def _restore(root: Node, named: list[Node]) -> None:
    """Takes up elements dropped by name alone that hold most of the page's paragraph text or an article.

    Comments and notices can hold most of it: they stay out if there are other paragraphs, as does all that
    stands beside an article with text. Names within an article count unless most of the text is there.
    """
    order, todo = [], [(root, "", False)]  # parents first; the article or main it stands in, whether in a named element
    while todo:
        n, inside, named_above = todo.pop()
        order.append((n, inside, named_above))
        for x in n.inside:
            if isinstance(x, Node) and (x.noisy or not x.dropped):
                todo.append((x, "article" if "article" in (inside, n.tag) else "main" if n.tag == "main" else inside, named_above or bool(n.noisy)))
    size, holds, nested, clean, article = {}, {}, {}, 0, 0
    for n, inside, named_above in reversed(order):
        below = [x for x in n.inside if isinstance(x, Node) and id(x) in size]
        own = max(0, _own(n))
        size[id(n)] = own + sum(size[id(x)] for x in below)
        holds[id(n)] = any(holds[id(x)] or x.tag in _ARTICLE and size[id(x)] > 0 for x in below)
        nested[id(n)] = inside
        if own and not (named_above or n.noisy or n.tag in _HEADINGS):
            clean, article = clean + own, article + own * bool(inside or n.tag in _ARTICLE)
    for n in named:
        if id(n) not in size:
            continue
        most = 2 * size[id(n)] > size[id(root)] and not (clean and _LONG.search(n.noisy)) and bool(nested[id(n)] or not article)
        if most or holds[id(n)] and nested[id(n)] != "article":
            n.dropped = False


def blocks(node: Node) -> list[str]:
    """The node's text, one entry a block: white space as one blank, trimmed, empty ones left out."""
    out: list[str] = []
    held: list[str] = []

    def flush() -> None:
        line = " ".join("".join(held).split())
        held.clear()
        if line:
            out.append(line)

    # An explicit stack: pages may nest deeper than Python recurses.
    todo: list = [(node, 0)]
    while todo:
        n, i = todo.pop()
        if i == 0:
            flush()
        while i < len(n.inside):
            x = n.inside[i]
            i += 1
            if isinstance(x, str):
                held.append(x)
            elif x is None:
                flush()
            elif not x.dropped:
                todo.append((n, i))
                todo.append((x, 0))
                break
        else:
            flush()
    return out


def _walk(root: Node) -> Iterator[Node]:
    todo = [root]
    while todo:
        n = todo.pop()
        yield n
        todo.extend(x for x in reversed(n.inside) if isinstance(x, Node) and not x.dropped)


def scores(root: Node) -> dict[int, tuple[float, Node]]:
    """Containers by the text of their paragraphs: in full for the parent, half for the grandparent."""
    got: dict[int, tuple[float, Node]] = {}
    for n in _walk(root):
        own = _own(n)
        if own <= 0:
            continue
        up, part = (n, 1.0) if n.tag in CONTAINERS else (n.up, 1.0)
        for _ in range(2):
            while up and up.tag not in CONTAINERS:
                up = up.up
            if not up:
                break
            bonus = 1.25 if up.tag in ("article", "main") else 1.0
            got[id(up)] = (got.get(id(up), (0.0, up))[0] + own * part * bonus, up)
            up, part = up.up, part / 2
    return got


def _whole(root: Node, best: list[Node]) -> list[Node]:
    """The smallest containers that hold ``best`` and the paragraphs and headings beside them, not beyond an article.

    What frames the whole page (``body``, or a lone element in it) may hold other things in ``div``s: only
    paragraphs outside of these count there.
    """
    order = list(_walk(root))
    every: dict[int, int] = {}  # paragraphs and headings in a node, and those not in a div of it
    near: dict[int, int] = {}
    for n in reversed(order):
        below = [x for x in n.inside if isinstance(x, Node) and not x.dropped]
        own = int((n.tag in _PARAGRAPHS or n.tag in _HEADINGS) and _own(n) > 0)
        every[id(n)] = own + sum(every[id(x)] for x in below)
        near[id(n)] = own + sum(near[id(x)] for x in below if x.tag != "div")
    frames, f = set(), root
    while f:
        frames.add(id(f))
        below = [x for x in f.inside if isinstance(x, Node) and not x.dropped]
        f = below[0] if len(below) == 1 and below[0].tag not in _ARTICLE and _own(f) <= 0 else None
    out: list[Node] = []
    for n in best:
        top, at, more = n, n, False
        while at.up and at.tag not in _ARTICLE:
            up = at.up
            page = up.tag in ("", "html", "body")
            for x in up.inside:
                if more:
                    break
                if isinstance(x, Node) and x is not at and not x.dropped:
                    more = (0 if x.tag == "div" or page and x.tag in _HEADINGS else near[id(x)]) > 0 if page or id(up) in frames else every[id(x)] > 0
            more = more or up.tag in CONTAINERS and not page and _own(up) > 0
            if more and up.tag in CONTAINERS:
                top, more = up, False
            at = up
        if not any(x is top for x in out):
            out.append(top)
    return out


def vote(root: Node) -> tuple[str, float] | None:
    """Path and score of the page's best container, taken whole; the first in page order of equals."""
    best = max(scores(root).values(), key=lambda x: x[0], default=None)
    return (_whole(root, [best[1]])[0].path, best[0]) if best else None


def extract(root: Node, path: str | None) -> str:
    """Text of the outermost containers under ``path``, else of the page's own best one, taken whole."""
    found = [n for n in _walk(root) if n.length == len(path) and path.endswith(n.step) and n.path == path] if path else []
    found = [n for n in found if blocks(n)]
    if not found:
        best = max(scores(root).values(), key=lambda x: x[0], default=None)
        found = [best[1]] if best else []
    found = _whole(root, found)
    kept, chosen = [], {id(n) for n in found}
    for n in found:
        up = n.up
        while up and id(up) not in chosen:
            up = up.up
        if not up:
            kept.append(n)
    return "\n".join(line for n in kept for line in blocks(n))


def host(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


#: Hosts up to which the winners are broadcast (about 100 bytes each); beyond, pages are joined by host and salt.
BROADCAST_HOSTS = 100_000
SALTS = 64


def main_text(pages: DataFrame) -> DataFrame:
    """Per row of ``pages``: ``page_id, url, text, n_chars, path`` (the path used is the host's winner).

    Null or empty html gives empty text; null urls count as one host without a name; ties between paths go to
    the higher score, then the smaller path; repeated rows vote and stay. Other columns are not read.
    """
    rows = pages.select("page_id", "url", host(F.col("url")).alias("host"), F.coalesce("html", F.lit("")).alias("html"))

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [(h, v) for h, p in zip(batch["host"].to_pylist(), batch["html"].to_pylist(), strict=True) if (v := vote(parse(p)))]
            yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in got], pa.string()), pa.array([v[0] for _, v in got], pa.string()),
                                              pa.array([v[1] for _, v in got], pa.float64())], names=["host", "path", "score"])

    counted = rows.select("host", "html").mapInArrow(votes, "host string, path string, score double").groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("votes"), F.round(F.sum("score"), 1).alias("score"))
    best = counted.groupBy("host").agg(F.max(F.struct("votes", "score")).alias("m"))
    winners = written(counted.join(best, "host").filter("votes = m.votes AND score = m.score").groupBy("host").agg(F.min("path").alias("path")), "paths")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(parse(p), path) for p, path in zip(batch["html"].to_pylist(), batch["path"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                                              batch["path"]], names=["page_id", "url", "text", "n_chars", "path"])

    if winners.count() <= BROADCAST_HOSTS:
        joined = rows.join(F.broadcast(winners), "host", "left")
    else:
        salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS))
        spread = winners.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        joined = rows.withColumn("salt", salt).join(spread, ["host", "salt"], "left")
    kinds = dict(rows.dtypes)
    return joined.select("page_id", "url", "html", "path").mapInArrow(
        read, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long, path string")
