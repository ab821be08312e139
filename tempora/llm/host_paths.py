"""Main text of web pages by consensus host paths.

First pass: every page is parsed, its containers are scored by the text they hold near them, and each container is
named by its generalised path of tags and classes. Spark sums the scores per host and path and each host elects a path.
Second pass: every page is parsed again and the text is taken from the article around the container at its host's path. A
page that lacks it falls back to its own best container, as does one of another template: its own best container is the
best one of several pages of the host, and holds much more text than the elected one.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tempora.llm.common import ship, slices, stored

#: Tags of the HTML standard by what they do here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noframes xmp plaintext template".split())
DROPPED = frozenset("script style noscript iframe noframes template head nav header footer aside form menu button select textarea option input dialog svg math canvas audio video object embed applet map label fieldset title".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rb rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CONTAINERS = frozenset("article main section div body td center".split())
#: Open elements of these names end where the listed ones begin.
ENDED_BY = {
    "p": frozenset("address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot", "thead"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "option": frozenset(["option", "optgroup"]),
}
#: What an implied end does not reach beyond.
BARRIERS = frozenset("article aside body div footer form header li main nav ol section table td th tr ul dl".split())
#: Words of classes, ids and roles that mark what is not the article.
NOISE = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial banner breadcrumb breadcrumbs byline comment comments commenting complementary consent contentinfo cookie "
    "cookies dialog discussion disqus footer form gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice notices notification outbrain pager pagination "
    "popup promo promoted promotion recommended related replies reply respond search share sharing sidebar sidenav signup skip social sponsor sponsored sponsors subscribe subscription taboola "
    "toc toolbar topbar widget widgets".split()
)
#: Words that mark the article; they double a container's score.
SIGNAL = frozenset("article articlebody body content entry main post story text".split())
#: A container with a NOISE word is article text all the same if it holds this share of the page's text, with a SIGNAL word
#: or without one; its text then counts for so much in the score.
SHARE_NAMED, SHARE_UNNAMED, SUSPECT_SCORE = 0.5, 0.9, 0.25
#: Further templates of a host: paths that are the best of so many of its pages at least; so many paths at most, by pages.
TEMPLATE_PAGES, TEMPLATES = 2, 64
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+))")
WORD = re.compile(r"[a-z]+|[0-9]+")
SPACE = re.compile(r"\s+")


class Element:
    """An open or closed element: its generalised path, whether it is article text at all, and the suspects it lies in.

    A suspect is a block-level element named by a NOISE word; the page as a whole tells whether it is noise. A name with a
    part that has a SIGNAL and no NOISE word, and without a part of NOISE words alone ("content has-sidebar"), is no suspect.
    """

    __slots__ = ("tag", "path", "noise", "link", "words", "parent", "score", "suspects", "heard", "linked")

    def __init__(self, tag: str, attributes: str, parent: Element | None):
        words = named = ""
        if attributes and "=" in attributes:
            found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
            named = html.unescape(found.get("class", "")).lower()
            words = " ".join([named, found.get("id", "").lower(), found.get("role", "").lower(), found.get("itemprop", "").lower()])
            hidden = "hidden" in found or "display:none" in found.get("style", "").replace(" ", "").lower()
        else:
            hidden = bool(attributes) and "hidden" in attributes.lower().split()
        self.tag, self.parent, self.score = tag, parent, 0.0
        self.heard = self.linked = 0  # characters of its blocks, and those inside links
        self.words = set(WORD.findall(words)) if words else frozenset()
        suspect = tag not in ("body", "html") and not self.words.isdisjoint(NOISE)
        if suspect and not self.words.isdisjoint(SIGNAL):
            parts = [set(WORD.findall(part)) for part in words.split()]
            suspect = not any(not part.isdisjoint(SIGNAL) and part.isdisjoint(NOISE) for part in parts) or any(part and part <= NOISE for part in parts)
        self.noise = bool(parent and parent.noise) or tag in DROPPED or hidden or (suspect and tag in INLINE)
        self.suspects = (parent.suspects if parent else ()) + ((self,) if suspect else ())
        self.link = tag == "a" or bool(parent and parent.link)
        # Numbers in classes become 0, so that post-17 and post-18 are one path.
        classes = ".".join(sorted(re.sub(r"[0-9]+", "0", c) for c in named.split()))
        self.path = f"{parent.path if parent else ''}>{tag}" + (f".{classes}" if classes else "")


def without_noise(blocks: list[tuple[Element, str]]) -> list[tuple[Element, str]]:
    """The blocks that lie in no suspect but such as hold most of the page's text; without a SIGNAL word, prose as well."""
    held: dict[Element, int] = {}
    prose: set[Element] = set()
    for element, text in blocks:
        for e in element.suspects:
            held[e] = held.get(e, 0) + len(text)
            if element.tag in PROSE:
                prose.add(e)
    if not held:
        return blocks
    total = sum(len(text) for _, text in blocks)
    kept = {e for e, n in held.items() if n >= SHARE_NAMED * total and not e.words.isdisjoint(SIGNAL) or n >= SHARE_UNNAMED * total and e in prose}
    return [(e, text) for e, text in blocks if kept.issuperset(e.suspects)]


def parse(page: str) -> list[tuple[Element, str]]:
    """(innermost container, text) of each block of text that is not noise, in page order.

    A block ends where a block-level tag begins or ends; line breaks and inline tags do not end it. White space inside a
    block is one blank. Tags that are cut off by the end of the page are dropped; open elements end with it.
    """
    root = Element("html", "", None)
    stack, blocks, pieces, owner, at = [root], [], [], None, 0

    def flush() -> None:
        nonlocal pieces, owner
        if pieces:
            text = SPACE.sub(" ", html.unescape("".join(pieces))).strip()
            if text:
                blocks.append((owner, text))
        pieces, owner = [], None

    def heard(text: str) -> None:
        nonlocal owner
        top = stack[-1]
        if top.noise or not text:
            return
        if owner is None:
            if text.isspace():
                return
            owner = top
            while owner.tag in INLINE and owner.parent:
                owner = owner.parent
        pieces.append(text)
        owner.heard += len(text)
        owner.linked += len(text) if top.link else 0

    end, n = 0, len(page)
    while at < n:
        m = TOKEN.search(page, at)
        heard(page[end : m.start() if m else n])
        if m is None:
            break
        at = end = m.end()
        tag = m[2]
        if tag is None or not m[4]:
            continue  # comments, declarations, a tag without an end
        tag = tag.lower()
        if m[1]:
            if tag not in INLINE:
                flush()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    if tag not in INLINE or not any(e.tag not in INLINE for e in stack[k + 1 :]):
                        del stack[k:]
                    break
                if stack[k].tag in BARRIERS and tag in INLINE:
                    break
            continue
        if tag == "br" or tag == "wbr":
            if pieces:
                pieces.append(" " if tag == "br" else "")
            continue
        if tag not in INLINE:
            flush()
            for k in range(len(stack) - 1, 0, -1):
                if tag in ENDED_BY.get(stack[k].tag, ()):
                    del stack[k:]
                    break
                if stack[k].tag in BARRIERS:
                    break
            if tag == "body" and stack[-1].tag == "head":
                stack.pop()
        if tag == "html":
            continue
        element = Element(tag, m[3], stack[-1])
        if tag in VOID or m[3].endswith("/") and tag in ("svg", "path"):
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end = close.end() if close else n
            continue
        stack.append(element)
    flush()
    return without_noise(blocks)


def score(blocks: list[tuple[Element, str]]) -> dict[str, float]:
    """Scores by container path: a block counts fully for its own container, half for the next outer one, and so on.

    Text inside links does not count. Article-like names count double; text in a suspect counts for less.
    """
    total: dict[str, float] = {}
    for element, text in blocks:
        if element.link:
            continue
        share, e = len(text) * (SUSPECT_SCORE if element.suspects else 1.0), element
        while e is not None:
            if e.tag in CONTAINERS:
                liked = e.tag in ("article", "main") or not e.words.isdisjoint(SIGNAL)
                total[e.path] = total.get(e.path, 0.0) + share * (2 if liked else 1)
                share /= 2
            e = e.parent
    return total


def text_at(blocks: list[tuple[Element, str]], path: str) -> tuple[str, bool]:
    """The blocks inside containers at the path, joined by line ends; whether there was such a container with text."""
    inside = path + ">"
    found = [t for e, t in blocks if e.path == path or e.path.startswith(inside)]
    return "\n".join(found), bool(found)


def nearest(element: Element) -> Element:
    """The innermost container (or the root) that an element lies in or is."""
    while element.tag not in CONTAINERS and element.parent:
        element = element.parent
    return element


def article_at(blocks: list[tuple[Element, str]], path: str) -> tuple[str, bool]:
    """The blocks at the path, and what else belongs to their article, in page order; whether the path had text.

    Outside the containers at the path, all that is not mostly links belongs to it inside an ``article`` around them, or
    inside a ``main`` around them that holds no other article. Of the other containers around them, up to the body,
    only their own prose does: text that lies in no further container.
    """
    inside = path + ">"
    picked = [e.path == path or e.path.startswith(inside) for e, _ in blocks]
    if not any(picked):
        return "", False
    whole: set[Element] = set()
    around: set[Element] = set()
    articles = {}  # of each main: the outermost articles in it
    for (e, _), chosen in zip(blocks, picked):
        outermost = None
        while e is not None:
            if e.tag == "article":
                outermost = e
            elif e.tag == "main" and outermost:
                articles.setdefault(e, set()).add(outermost)
            if chosen and (e.path == path or path.startswith(e.path + ">")) and e.tag in CONTAINERS:
                around.add(e)
            e = e.parent
    for e in around:
        if e.tag == "article" or e.tag == "main" and len(articles.get(e, ())) < 2:
            whole.add(e)

    def belongs(e: Element) -> bool:
        if 2 * e.linked > e.heard:
            return False
        if e.tag in PROSE and nearest(e) in around:
            return True
        up: Element | None = e
        while up is not None:
            if up in whole:
                return True
            up = up.parent
        return False

    return "\n".join(t for (e, t), chosen in zip(blocks, picked) if chosen or belongs(e)), True


def own_best(blocks: list[tuple[Element, str]]) -> str | None:
    """The path with the highest score on this page; ties to the smaller path."""
    own = score(blocks)
    return min(own, key=lambda p: (-own[p], p)) if own else None


def host_of(url: str | None) -> str:
    rest = url.partition("://")[2] if url else ""
    return re.split(r"[/?#]", rest, maxsplit=1)[0].lower()


def elect_paths(pages: DataFrame) -> DataFrame:
    """(host, path, templates): per host the container path with the highest score over all its pages; ties to the smaller.

    ``templates``: the paths that are the best of TEMPLATE_PAGES of its pages or more, TEMPLATES at most, or null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "__html"):
            votes: dict[tuple[str, str], list] = {}
            for url, page in zip(part.column("__url").to_pylist(), part.column("__html").to_pylist()):
                own, host = score(parse(page or "")), host_of(url)
                for path, points in own.items():
                    votes.setdefault((host, path), [0.0, 0])[0] += points
                if own:
                    votes[host, min(own, key=lambda p: (-own[p], p))][1] += 1
            columns = [[k[0] for k in votes], [k[1] for k in votes], [v[0] for v in votes.values()], [v[1] for v in votes.values()]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.float64(), pa.int64()))], ["host", "path", "points", "pages"])

    votes = pages.mapInArrow(run, "host string, path string, points double, pages long").groupBy("host", "path").agg(F.sum("points").alias("points"), F.sum("pages").alias("pages"))
    votes = stored(votes, "host-votes")
    elected = votes.groupBy("host").agg(F.min_by("path", F.struct(-F.col("points"), F.col("path"))).alias("path"))
    rank = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("pages"), "path"))
    several = votes.where(F.col("pages") >= TEMPLATE_PAGES).withColumn("__rank", rank).where(F.col("__rank") <= TEMPLATES)
    templates = several.groupBy(F.col("host").alias("__t")).agg(F.sort_array(F.collect_list("path")).alias("templates"))
    return elected.join(templates, F.col("host") == F.col("__t"), "left").select("host", "path", F.when(F.size("templates") > 1, F.col("templates")).alias("templates"))


def extract_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, path, text): the main text of every row, ``path`` being the one it was taken from.

    A null, empty or text-free page has an empty text and a null path. Pages with a null or hostless url share the host ''.
    Repeated rows are extracted each; ties between paths go to the smaller one. Other columns are not read. A page of any
    length is read whole.
    """
    ship(pages.sparkSession)
    picked = pages.select(F.col("page_id"), F.col("url").alias("__url"), F.col("html").alias("__html"))
    elected = stored(elect_paths(picked), "host-paths")
    host = F.coalesce(F.lower(F.regexp_extract("__url", r"^(?s:.*?)://([^/?#]*)", 1)), F.lit(""))
    joined = picked.withColumn("__host", host).join(elected.select(F.col("host").alias("__h"), F.col("path").alias("__path"), F.col("templates").alias("__templates")), F.col("__host") == F.col("__h"), "left").drop("__h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "__html"):
            texts, paths = [], []
            for page, path, templates in zip(*(part.column(c).to_pylist() for c in ("__html", "__path", "__templates"))):
                blocks = parse(page or "")
                text, found = article_at(blocks, path) if path else ("", False)
                if not found or templates:
                    own = own_best(blocks)
                    if not found:
                        path = own
                        text = article_at(blocks, path)[0] if path else "\n".join(t for _, t in blocks)
                    elif own != path and own in templates and 2 * len(text) < len(other := article_at(blocks, own)[0]):
                        text, path = other, own
                texts.append(text)
                paths.append(path)
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("__url"), part.column("__host"), pa.array(paths, pa.string()), pa.array(texts, pa.string())], ["page_id", "url", "host", "path", "text"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"page_id {kind}, url string, host string, path string, text string")
