"""Main text of web pages by consensus host paths.

Pass 1 scores every container of every page by the text it holds; each page votes
for the generalised tag-class path of its best container, or of the outermost one
around it that adds to the article.  Spark adds the votes
up by host.  It also finds the paths whose text stays the same beside different
articles of a host: what stands there is no part of an article.  Pass 2 extracts
every page again with its host's winning paths, in order of votes, without the text at
such paths; a page that has no winning path falls back on its own best container.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_schema, cut, of_texts, slices

_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
#: The rest of a tag up to its >; a quoted value, which may hold that, comes after =.
_REST = re.compile(r"((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)>")
_ATTR = re.compile(r"""([^\s"'=<>/]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'=<>`]+))?""")
_DIGITS = re.compile(r"\d+")
_TOKEN = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+")
#: A longer path, or name of a container, is cut down to a digest of what came before.
_LONG = 240

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no markup; all but pre-formatted text is no text of the page either.
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
#: Elements that are never part of the article.
BOILER_TAGS = frozenset(
    "nav header footer aside form button select option datalist dialog menu template svg math canvas audio video "
    "object map head fieldset".split()
)
BOILER_ROLES = frozenset(
    "navigation banner contentinfo complementary search form menu menubar toolbar dialog alert alertdialog".split()
)
#: Words of a class or an id that mark what is not the article.
BOILER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar "
    "navigation menu menus breadcrumb breadcrumbs header masthead footer sidebar side aside widget widgets comment comments "
    "disqus reply replies respond discussion cookie cookies consent gdpr notice notices alert popup modal overlay "
    "announcement disclaimer newsletter subscribe subscription signup login share sharing social related recommended recommendations "
    "pagination pager toolbar search skip tags".split()
)
#: What follows "header" where it is that of a page.
HEADER_PARTS = frozenset("nav menu bar top wrap wrapper inner container logo area widget image banner ad ads".split())
#: Words that begin the class of an article element which is none of the page's own.
ASIDES = frozenset("comment comments reply replies ad ads advert advertisement related recommended sponsored promo teaser".split())
#: Words before one of these that speak of a page's layout.
LAYOUT_WORDS = frozenset("has with no without is".split())
#: Words that mark containers of the article; a header of theirs holds its title.
CONTENT_WORDS = frozenset("article content main post entry story body text".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dir div dl dt fieldset figcaption figure footer form h1 "
    "h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
CONTAINERS = frozenset("article main section div td body blockquote center".split())
#: An opening tag of the first kind ends an open one of the second, up to the nearest of the third.
CLOSES = {t: (frozenset({"p"}), CONTAINERS | {"li", "dd", "dt", "table", "th"}) for t in BLOCKS - {"body", "html"}} | {
    "li": (frozenset({"li", "p"}), frozenset({"ul", "ol", "menu"})),
    "dt": (frozenset({"dt", "dd", "p"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd", "p"}), frozenset({"dl"})),
    "tr": (frozenset({"tr", "td", "th", "p"}), frozenset({"table"})),
    "td": (frozenset({"td", "th", "p"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th", "p"}), frozenset({"tr", "table"})),
}
WEIGHT = {"article": 4.0, "main": 3.0, "section": 1.2, "div": 1.0, "td": 1.0, "blockquote": 0.5, "center": 0.8, "body": 0.4}


@dataclass(slots=True)
class Node:
    """A container; ``at`` is its number on the page."""

    at: int
    tag: str
    path: str
    parent: Node | None
    weight: float = 1.0
    own: float = 0.0
    link: float = 0.0
    blocks: list[tuple[int, str]] = field(default_factory=list)


def _words(value: str) -> list[str]:
    return [w.lower() for w in _TOKEN.findall(value)]


def _is_boiler(tag: str, attrs: dict[str, str], in_article: bool) -> bool:
    if tag in BOILER_TAGS:
        # A header inside the article holds its title.
        return not (tag == "header" and in_article)
    names = [_words(name) for name in (*attrs.get("class", "").split(), attrs.get("id", ""))]
    if tag in ("html", "body", "article", "main"):
        return tag in ("article", "main") and any(w and w[0] in ASIDES for w in names)
    if attrs.get("role", "").lower() in BOILER_ROLES:
        return True
    for words in names:
        if not words or words[0] in LAYOUT_WORDS or words[-1] == "header" and CONTENT_WORDS & {*words}:
            continue
        if words[0] == "header" and len(words) > 1 and words[1] not in HEADER_PARTS:
            continue
        if words[0] in BOILER_WORDS or words[-1] in BOILER_WORDS:
            return True
    return False


def _short(text: str) -> str:
    return text if len(text) <= _LONG else "~" + blake2b(text.encode(), digest_size=8).hexdigest()


def _tags(html: str) -> Iterator[tuple[int, int, str, str, bool]]:
    """(start, end, name, attributes, whether it closes) of each tag in order; comments and
    declarations have no name.  Takes where to go on from ``send``, for what holds no markup."""
    at, n = 0, len(html)
    quoted = True  # whether > may stand in quotes: not after a tag that only then has no end
    while (start := html.find("<", at)) >= 0:
        at = start + 1
        if html.startswith("<!--", start):
            end = html.find("-->", start + 4)
            at = n if end < 0 else end + 3
            yield start, at, "", "", False
            continue
        if html.startswith(("<!", "<?"), start):
            end = html.find(">", start)
            if end < 0:
                return
            at = end + 1
            yield start, at, "", "", False
            continue
        name = _NAME.match(html, start)
        if not name:
            continue
        rest = _REST.match(html, name.end()) if quoted else None
        if rest:
            at, raw = rest.end(), rest[1]
        else:
            quoted = False
            end = html.find(">", name.end())
            if end < 0:
                return
            at, raw = end + 1, html[name.end() : end]
        on = yield start, at, name[2].lower(), raw, bool(name[1])
        at = at if on is None else on


def parse(html: str | None) -> list[Node]:
    """The containers of a page in page order, with the blocks of text each holds
    itself or through elements that are none; what is not the article is left out.
    Time and memory follow the length of the page, however it nests."""
    html = html or ""
    root = Node(0, "html", "", None)
    nodes = [root]
    stack: list[tuple[str, Node, bool]] = [("html", root, False)]  # tag, its container, whether boilerplate
    depths: dict[str, list[int]] = {"html": [0]}  # where each tag stands on the stack
    paths: dict[tuple[str, str], str] = {}
    text: list[str] = []
    order = 0
    links = 0

    def flush() -> None:
        nonlocal order
        if text:
            _, node, boiler = stack[-1]
            if not boiler:
                block = " ".join(unescape("".join(text)).split())
                if block:
                    node.blocks.append((order, block))
                    order += 1
                    node.own += len(block)
            text.clear()

    def pop_to(depth: int) -> None:
        flush()
        while len(stack) > depth:
            depths[stack.pop()[0]].pop()

    def last(tags: frozenset[str]) -> int:
        return max((depths[t][-1] for t in tags if depths.get(t)), default=0)

    at, tags, on = 0, _tags(html), None
    while True:
        try:
            start, end, tag, raw, closing = tags.send(on)
        except StopIteration:
            break
        on = None
        if start > at:
            text.append(html[at:start])
            if links and not stack[-1][2]:
                stack[-1][1].link += start - at
        at = end
        if not tag:
            continue
        if closing:
            if tag == "a":
                links = max(0, links - 1)
            if depths.get(tag) and depths[tag][-1]:
                pop_to(depths[tag][-1])
            elif tag == "p":
                flush()
            continue
        if tag in RAW:
            closed = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            at = on = closed.end() if closed else len(html)
            continue
        if tag == "a":
            links = 1
        if tag == "br":
            text.append(" ")
        if tag in VOID and tag != "hr" or tag not in BLOCKS and tag not in BOILER_TAGS:
            continue
        flush()
        links = 0
        if tag == "hr":
            continue
        if tag in CLOSES:
            ends, stops = CLOSES[tag]
            while (depth := last(ends)) > last(stops):
                pop_to(depth)
        if tag == "html" or tag == "body" and depths.get("body"):
            continue
        attrs = {k.lower(): v.strip("\"'") for k, v in _ATTR.findall(raw)} if "=" in raw else {}
        _, node, boiler = stack[-1]
        boiler = boiler or _is_boiler(tag, attrs, bool(depths.get("article")))
        if tag in CONTAINERS and not boiler:
            classes = ".".join(sorted({_DIGITS.sub("#", c) for c in attrs.get("class", "").split()}))
            marks = {w for w in _words(attrs.get("class", "") + " " + attrs.get("id", "") + " " + attrs.get("itemprop", ""))}
            step = (node.path, f"{tag}.{_short(classes)}" if classes else tag)
            if step not in paths:
                paths[step] = _short(step[0]) + ">" + step[1]
            node = Node(len(nodes), tag, paths[step], node, WEIGHT[tag] * (2.0 if marks & CONTENT_WORDS else 1.0))
            nodes.append(node)
        depths.setdefault(tag, []).append(len(stack))
        stack.append((tag, node, boiler))
    text.append(html[at:])
    flush()
    return nodes


def _score(nodes: list[Node]) -> list[float]:
    """A container's own text and half its parts' text, less its links, by the kind of element."""
    total = [n.own for n in nodes]
    for n in reversed(nodes):
        if n.parent is not None:
            total[n.parent.at] += total[n.at] * 0.5
    # An article with a title alone still outranks what surrounds it.
    return [n.weight * (total[n.at] - 2 * n.link + (40 if n.tag in ("article", "main") else 0)) for n in nodes]


#: Share of a container's text from which what stands beside it is a part of the article.
_PART = 0.25


def _whole(best: Node, nodes: list[Node]) -> Node:
    """The outermost container around ``best`` that adds to the article: text of its own, as a
    title or a lead, or parts beside that are not small.  For the page itself only parts count."""
    held = [n.own - 2 * n.link for n in nodes]
    for n in reversed(nodes):
        if n.parent is not None:
            held[n.parent.at] += held[n.at]
    around = best.parent
    while around is not None:
        own = around.own - 2 * around.link if around.tag not in ("html", "body") else 0
        if own > 0 or held[around.at] - held[best.at] >= _PART * max(held[best.at], 1):
            best = around
        around = around.parent
    return best


def _best(nodes: list[Node]) -> tuple[Node | None, float]:
    """The container that holds the page's article, and the score of the best one in it; of equal ones the first."""
    score = _score(nodes)
    best = max(nodes[1:], key=lambda n: score[n.at], default=None)
    return (None, 0.0) if best is None else (_whole(best, nodes), score[best.at])


def vote(html: str | None) -> tuple[str, float] | None:
    """The generalised path of a page's best container, that of the page itself being empty, and
    1; None for a page without any text that could be its article."""
    best, score = _best(parse(html))
    return (best.path, 1.0) if score > 0 else None


def _picked(nodes: list[Node], chosen: str | None) -> list[Node]:
    """The containers at a path and all within them."""
    inside = [False] * len(nodes)
    for n in nodes:
        inside[n.at] = chosen is None or n.path == chosen or n.parent is not None and inside[n.parent.at]
    return [n for n in nodes if inside[n.at]]


def _joined(nodes: list[Node]) -> str:
    return "\n".join(b for _, b in sorted(b for n in nodes for b in n.blocks))


def evidence(html: str | None) -> tuple[str | None, list[tuple[str, bytes, bytes]]]:
    """(path voted for, [(path, digest of its text, digest of the article)]): the text that each
    container within the article holds itself, beside the article as a whole."""
    nodes = parse(html)
    best, score = _best(nodes)
    if score <= 0:
        return None, []
    picked = _picked(nodes, best.path)
    digest = lambda t: blake2b(t.encode(), digest_size=8).digest()
    held = [(n.path, digest(_joined([n]))) for n in picked if n.blocks]
    whole = digest("".join(p + d.hex() for p, d in held))
    return best.path, [(p, d, whole) for p, d in held] if len(held) > 1 else []


def extract(html: str | None, paths: list[str], repeated: frozenset[str] | set[str] = frozenset()) -> tuple[str, str]:
    """(text, path): blocks under every container that the first matching of ``paths``
    leads to, in page order; else under the page's own best container, else all there is.
    What containers at ``repeated`` paths hold themselves is left out."""
    nodes = parse(html)
    there = {n.path for n in nodes}
    chosen = next((p for p in paths if p in there), None)
    if chosen is None:
        best, _ = _best(nodes)
        chosen = None if best is None else best.path
    return _joined([n for n in _picked(nodes, chosen) if n.path not in repeated]), chosen or ""


def extract_pages(
    pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", top: int = 3, most: int = 200, beside: int = 3, broadcast_bytes: int = 64 << 20
) -> DataFrame:
    """(key, url, text, n_chars, host, path) for each row of ``pages``.

    The host is the lower-case netloc of the url; pages without one vote
    together under ''.  Each host keeps its ``top`` paths.  A path is no part of
    a host's articles if most of the texts found there stand beside ``beside`` different
    articles or more; a host keeps the ``most`` frequent of such paths.  The table
    of both is written and measured: up to ``broadcast_bytes`` it is broadcast, beyond
    that it is joined by host, with the pages of a host spread over salts.
    Null and empty html give an empty text; repeated rows give a row each; other
    columns are left aside, whatever their names.  Ties go to the first container
    of a page and the first path by name.  An empty table gives an empty result.
    """
    spark = pages.sparkSession
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url).cast("string"), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    rows = of_texts(pages).select(F.col(key).alias("k"), F.col(url).cast("string").alias("u"), F.col(html).cast("string").alias("h"), host.alias("host"))

    def voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Votes have no digests; a task adds up its own."""
        for batch in slices(batches):
            votes: dict[tuple[str, str], int] = {}
            held: dict[tuple[str, str, bytes, bytes], None] = {}
            for h, t in zip(batch["host"].to_pylist(), batch["h"].to_pylist()):
                path, found = evidence(t)
                if path is not None:
                    votes[h, path] = votes.get((h, path), 0) + 1
                held.update(dict.fromkeys((h, *f) for f in found))
            out = [(h, p, None, None, n) for (h, p), n in votes.items()] + [(*f, 0) for f in held]
            columns = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=k) for c, k in zip(columns, (pa.string(), pa.string(), pa.binary(), pa.binary(), pa.int64()))], names=["host", "path", "digest", "whole", "votes"]
            )

    seen = cut(rows.select("host", "h").mapInArrow(voted, "host string, path string, digest binary, whole binary, votes bigint"), "host-votes")

    def most_of(counted: DataFrame, n: int, name: str) -> DataFrame:
        """A host's n greatest; what is beyond is left before it is shuffled."""
        place = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("n"), "path"))
        own = counted.withColumn("place", place).where(F.col("place") <= n)
        return own.groupBy("host").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "path"))), lambda x: x["path"]).alias(name))

    votes = seen.where("digest is null").groupBy("host", "path").agg(F.sum("votes").alias("n"))
    texts = seen.where("digest is not null").select("host", "path", "digest", "whole").distinct().groupBy("host", "path", "digest").agg(F.count("*").alias("n"))
    same = texts.groupBy("host", "path").agg(F.sum("n").alias("all"), F.sum(F.when(F.col("n") >= beside, F.col("n")).otherwise(0)).alias("n")).where("n * 2 > all")
    about = cut(most_of(votes, top, "paths").join(most_of(same.select("host", "path", "n"), most, "repeated"), "host", "left"), "host-paths")

    size = about.agg(F.sum(F.length("host") + F.length(F.array_join("paths", " ")) + F.coalesce(F.length(F.array_join("repeated", " ")), F.lit(0)) + 64)).first()[0] or 0
    if size <= broadcast_bytes:
        joined = rows.join(F.broadcast(about), "host", "left")
    else:
        salts = 32
        salted = rows.withColumn("salt", F.pmod(F.xxhash64("k", "u"), F.lit(salts)).cast("int"))
        joined = salted.join(about.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))), ["host", "salt"], "left")
    kind = pages.schema[key].dataType.simpleString()
    ddl = f"k {kind}, u string, text string, n_chars bigint, host string, path string"
    arrow = arrow_schema(spark, ddl)

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            got = [extract(h, p or [], {*(r or ())}) for h, p, r in zip(*(batch[c].to_pylist() for c in ("h", "paths", "repeated")))]
            texts = [t for t, _ in got]
            columns = [batch["k"], batch["u"], texts, [len(t) for t in texts], batch["host"], [p for _, p in got]]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow)

    out = joined.select("k", "u", "h", "host", "paths", "repeated").mapInArrow(extracted, ddl)
    return out.withColumnsRenamed({"k": key, "u": url})
