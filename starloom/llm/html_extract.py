"""Main text of web pages by consensus of a host's pages.

1. Each page is parsed into containers and text blocks, in time proportional to its length. What a tag or a
   class marks as menu, header, footer, sidebar, notice, advert, form, script or reader comment is left out.
   A furniture element (nav, aside, footer and the like) counts if it is closed by its own end tag; a form, an element
   that is never closed, and a class or id count only where the element holds mostly links, or no article or main
   and at most half of the page's text (any share, if it stands outside an article or main with text, or names
   reader comments); beside words of another meaning, and on headings and paragraphs, only on mostly links.
2. Furniture without marks. Blocks outside an article or main vote: a text that stands on three or more different
   pages of a host, and on a fifth of them, is the host's, not the page's. (Pages differ if their longest blocks do, so
   copies of a page make no furniture.)
3. From the body down, the page's best is the first article or main that holds three quarters of the text
   at each step, or else the deepest such container beside which no text is left: links, single words and the
   host's furniture in containers of their own are no text. Beside an article or main only text outside containers of its own counts.
4. Pages vote for the generalised tag-class path of their best container
   (digits taken out, identifiers ignored), weighted by its share of the
   page's text. Spark counts the votes and each host gets a winning path.
5. Pages are parsed again and the text of the containers on the host's path is
   taken; a page without that path gives its own best container, and so does one whose best container holds
   those on the path with a quarter or less beside them.

Character references are decoded, white space inside a block becomes one space,
blocks are joined by a line feed. Cases: null, empty and unmarked html gives what text there is,
empty if none. Very long and malformed pages (open quotes, comments, tags and elements by the thousand) cost time
proportional to their length; an open tag at the end of a page has no text. A page without a host in its url uses its own best
container. Pages that repeat are extracted alike; each votes for paths. Ties of paths go to the least. Tags that are never closed end
with their parent. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starloom.llm.arrow import text_slices
from starloom.llm.common import written

# HTML's element kinds, and the words of classes and identifiers that mark what is not the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset("article body center content div main section td".split())
BLOCKS = CONTAINERS | frozenset("""address blockquote caption dd details dialog dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 head header hr html li nav ol optgroup option p pre select summary table tbody tfoot th thead title tr ul
aside""".split())
#: Elements without text of the page, whatever they hold.
DROPPED = frozenset("canvas datalist head iframe input noscript object select svg template title".split())
#: Elements beside the article; those never closed by their own end tag are weighed like marks.
FURNITURE = frozenset("aside button dialog footer form label legend menu nav".split())
#: What a head can hold; any other block ends it.
HEAD_PARTS = frozenset("head title template".split())
MARKS = frozenset("""ad ads adsense advert advertisement advertising adverts banner breadcrumb breadcrumbs captcha comment
comments consent cookie cookies copyright disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice
notices notification pager pagination paywall popup promo promoted promotion recommended related reply replies respond
share sharing sidebar signup skip social sponsor sponsored subscribe subscription tagcloud toolbar widget widgets""".split())
#: Marks of reader comments.
COMMENTS = frozenset("comment comments disqus reply replies respond".split())
#: Marks that count only outside an article: an article's own header belongs to it.
PAGE_MARKS = frozenset(("header",))
#: Elements that end an open element of the same line when they start.
ENDS = {
    "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")), "tr": frozenset(("tr", "td", "th")),
    "td": frozenset(("td", "th")), "th": frozenset(("td", "th")), "option": frozenset(("option",)),
}
#: Elements that a later element can end.
CLOSABLE = frozenset(("p", "li", "dt", "dd", "tr", "td", "th", "option"))
#: Words that make no other name of a mark they stand beside; a mark beside other words, as in share-price, is a weak one.
PLAIN = frozenset("""area articles bar block body bottom box btn button buttons col column container content count cta entry form
full global group header icon icons inline inner item items left link links list local mobile outer overlay page panel post posts
primary right row secondary section site slot small stories sub sticky text title top tray unit wide wrap wrapper""".split())
#: Words before a mark that say what the element is next to, or lacks.
MODIFIERS = frozenset("has have hide is no non not show sans with without".split())
#: Elements that hold a line or a paragraph: class words mark them weakly, identifiers not at all.
LINES = frozenset("h1 h2 h3 h4 h5 h6 p".split())
#: An element looked for by ENDS is not sought beyond these.
SCOPES = frozenset("article body div main ol section table ul dl select".split())
NEVER_MARKED = frozenset(("html", "body", "main", "article"))
ROLES = frozenset(("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "menu", "menubar", "alert"))
SPECIAL = (r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|textarea|xmp)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)")
#: A tag up to its first > outside quotation marks, or, if a quotation is never closed, to its first >.
QUOTED = r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
OPEN = r"|<(?P<end2>/?)(?P<tag2>[a-z][^\s/>]*+)(?P<attrs2>[^>]*+)>"
TOKEN = re.compile(SPECIAL + QUOTED + OPEN, re.S | re.I)
#: The same without quotations, for pages on which MOST_OPEN of them ran to the end.
PLAIN_TOKEN = re.compile(SPECIAL + "|(?P<end>(?!))(?P<tag>)(?P<attrs>)" + OPEN, re.S | re.I)
MOST_OPEN = 8
#: A / that ends an attribute's value, not the element.
VALUE_SLASH = re.compile(r"=\s*[^\s\"'=]*/\s*\Z")
UNFINISHED = re.compile(r"<[a-z/!?]", re.I)
ATTR = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
MARK = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
DIGITS = re.compile(r"\d+")
LEAST_SHARE = 0.75
#: Share of a page's text above which a class or id does not mark an element, and share that marks must leave.
MOST_MARKED, LEAST_LEFT = 0.5, 0.1
#: Characters that marks need not leave more than.
ENOUGH_LEFT = 200
#: Pages of a host, and their share, from which a block is the host's.
LEAST_PAGES, LEAST_PAGE_SHARE = 3, 0.2


@dataclass
class Page:
    """Containers in page order (step of the path, parent) and blocks in page order (container, text, characters in links)."""
    #: The last step of a container's path; empty for the root and the body, at which paths begin.
    steps: list[str] = field(default_factory=lambda: [""])
    parents: list[int] = field(default_factory=lambda: [-1])
    #: Whether a container is an article or main, or in one.
    article: list[bool] = field(default_factory=lambda: [False])
    top: list[bool] = field(default_factory=lambda: [False])
    out: list[bool] = field(default_factory=lambda: [False])
    blocks: list[tuple[int, str, int]] = field(default_factory=list)

    def path(self, c: int) -> str:
        steps = []
        while self.steps[c]:
            steps.append(f">{self.steps[c]}")
            c = self.parents[c]
        return "".join(reversed(steps))

    def on_path(self, path: str) -> list[bool]:
        """Whether each container has that path."""
        wanted = path.split(">")[1:]
        upto = [0]  # steps of the path that a container's own path begins with, -1 if it differs
        for c in range(1, len(self.steps)):
            before = upto[self.parents[c]]
            if not self.steps[c]:
                upto.append(0)
            else:
                upto.append(before + 1 if 0 <= before < len(wanted) and wanted[before] == self.steps[c] else -1)
        return [n == len(wanted) and not out and (c > 0 or not wanted) for c, (n, out) in enumerate(zip(upto, self.out))]


@dataclass
class Mark:
    """An element that its tag, class or id may mark: the mark it lies in (-1: none), whether that is in an article, and what it holds."""
    parent: int
    weak: bool
    within: bool
    comment: bool = False
    article: bool = False
    #: A furniture element that its own end tag has closed.
    sure: bool = False
    text: int = 0
    linked: int = 0


NO_MARK, WEAK, STRONG, COMMENT = 0, 1, 2, 3


def _word(m: str) -> str:
    """The mark that a word is, or is put together with, as topnav and commentlist are; empty if none."""
    if m in MARKS:
        return m
    for k in range(2, len(m) - 1):
        if m[:k] in MARKS and m[k:] in PLAIN:
            return m[:k]
        if m[k:] in MARKS and (m[:k] in PLAIN or m[:k] == "side"):
            return m[k:]
    return ""


def mark_of(name: str) -> int:
    """How a class or an id marks its element."""
    found, other, before, comment = NO_MARK, False, "", False
    for m in MARK.findall(name):
        m = m.lower()
        mark = _word(m)
        if before in MODIFIERS and mark:
            return NO_MARK
        if mark:
            found = STRONG
            comment = comment or mark in COMMENTS
        elif m not in PLAIN and len(m) > 2:
            other = True
        before = m
    return WEAK if found and other else COMMENT if comment else found


def _attributes(raw: str, tag: str) -> tuple[list[str], bool, int]:
    """Classes, whether attributes hide the element, and how its class and id mark it."""
    classes, hidden, marked = [], False, NO_MARK
    for name, a, b, c in ATTR.findall(raw):
        name, value = name.lower(), a or b or c
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "role" and value.lower() in ROLES):
            hidden = True
        elif name == "class":
            classes = value.split()
            marked = max([marked, *map(mark_of, classes)])
        elif name == "id" and tag in BLOCKS and tag not in LINES:
            marked = max(marked, mark_of(value))
    return classes, hidden, min(marked, WEAK) if tag in LINES else marked


def counted(marks: list[Mark], total: int, inside: list[int], article: bool) -> list[bool]:
    """Which marks leave out what they hold. total: the page's text; inside: text in each mark itself; article: whether an unmarked one has text."""
    # Beside an article with text, a mark outside it counts whatever its size; the others' shares are of the rest.
    beside = [m.sure or (article and not m.within and not m.weak and (m.comment or not m.article)) for m in marks]

    def spread(drops: list[bool]) -> list[bool]:
        for k, m in enumerate(marks):  # a mark comes after that it lies in
            drops[k] = drops[k] or (m.parent >= 0 and drops[m.parent])
        return drops

    def decide(of: int, links_only: bool) -> list[bool]:
        drops = []
        for m, clear in zip(marks, beside):
            links = m.linked > 0 and m.linked >= m.text
            small = not (m.weak or links_only or m.text > MOST_MARKED * of)
            drops.append(clear or (not m.article and (links or small or (m.comment and not links_only))))
        return spread(drops)

    def left(drops: list[bool]) -> int:
        return total - sum(n for n, drop in zip(inside, drops) if drop)

    rest = left(spread(beside.copy()))
    drops = decide(rest, False)
    return drops if left(drops) >= min(LEAST_LEFT * rest, ENOUGH_LEFT) else decide(rest, True)


@dataclass(slots=True)
class Open:
    """An open element: its container, whether it is left out, the mark it lies in, its own mark, and the nearest element that a later one can end."""
    tag: str
    container: int = 0
    out: bool = False
    mark: int = -1
    own: int = -1
    near: int = 0


def parse(html: str) -> Page:
    page = Page()
    stack = [Open("")]
    count: Counter[str] = Counter()  # open elements
    marks: list[Mark] = []
    mark_in = [-1]  # of each container
    pieces: list[tuple[int, list[tuple[str, int, int]]]] = []  # container; text, characters in links, mark
    buffer: list[tuple[str, int, int]] = []

    def flush():
        if buffer:
            pieces.append((stack[-1].container, buffer.copy()))
            buffer.clear()

    def pop(to: int):
        while len(stack) > to:
            tag = stack[-1].tag
            if tag in BLOCKS:
                flush()
            count[tag] -= 1
            stack.pop()

    def text(raw: str):
        if raw and not stack[-1].out:
            raw = unescape(raw)
            buffer.append((raw, len(raw.strip()) if count["a"] > 0 else 0, stack[-1].mark))

    # Behind the last > there is no whole tag.
    at, end, token, unclosed = 0, html.rfind(">") + 1, TOKEN, 0
    while m := token.search(html, at, end):
        text(html[at : m.start()])
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if not tag:
            if m[0].startswith("<![CDATA["):
                text(m[0][9:].removesuffix("]]>"))
            if at == end and not re.search(r"-->\Z|\]\]>\Z" if m[0].startswith(("<!--", "<![")) else r"</[a-z]+\s*>\Z" if m["raw"] else r">\Z", m[0], re.I):
                at = len(html)  # never closed: the rest of the page is in it
            continue
        if not m["tag"] and token is TOKEN:
            unclosed += 1
            token = PLAIN_TOKEN if unclosed == MOST_OPEN else TOKEN
        tag = tag.lower()
        if m["end"] or m["end2"]:
            if count[tag] > 0:
                depth = len(stack) - 1
                while stack[depth].tag != tag:
                    depth -= 1
                if stack[depth].own >= 0 and (tag in FURNITURE or tag == "header") and tag != "form":
                    marks[stack[depth].own].sure = True
                pop(depth)
            elif tag in BLOCKS:
                flush()
            continue
        if tag == "br" or tag == "hr":
            flush() if tag == "hr" else text(" ")
            continue
        if tag in VOID:
            continue
        if tag in BLOCKS:
            if count["head"] > 0 and tag not in HEAD_PARTS:
                pop(max(d for d in range(1, len(stack)) if stack[d].tag == "head"))
            # A block ends an open paragraph; items, cells and options end their like.
            ends = ENDS.get(tag)
            d = stack[-1].near
            while d:
                if stack[d].tag == "p" or (ends and stack[d].tag in ends):
                    pop(d)
                    break
                d = stack[d - 1].near
            flush()
        attrs = m["attrs"] if m["tag"] else m["attrs2"]
        above = stack[-1]
        element = Open(tag, above.container, above.out, above.mark, -1, above.near)
        in_article = count["article"] > 0 or count["main"] > 0
        classes: list[str] = []
        marked = NO_MARK
        if not above.out and attrs and not attrs.isspace():
            classes, hidden, marked = _attributes(attrs, tag)
            element.out = hidden and tag not in NEVER_MARKED
        if tag in DROPPED:
            element.out = True
        elif not element.out and tag not in NEVER_MARKED:
            if (tag == "header" or any(c.lower() in PAGE_MARKS for c in classes)) and not in_article:
                marked = max(marked, WEAK if tag in LINES else STRONG)
            if tag in FURNITURE:
                marked = max(marked, STRONG)
        if marked and not element.out and tag not in NEVER_MARKED:
            marks.append(Mark(element.mark, marked == WEAK, in_article, marked == COMMENT))
            element.mark = element.own = len(marks) - 1
        # An article within an article, or one that is marked itself, is a reader's comment or the like.
        if tag in ("article", "main") and not element.out and not marked and not in_article:
            k = element.mark
            while k >= 0 and not marks[k].article:
                marks[k].article = True
                k = marks[k].parent
        if tag in CONTAINERS and not element.out:
            step = "" if tag == "body" else ".".join([tag, *sorted(DIGITS.sub("", c).replace(">", "") for c in classes)])
            page.steps.append(step)
            page.parents.append(element.container)
            page.top.append(tag in ("article", "main"))
            page.article.append(page.top[-1] or page.article[element.container])
            element.container = len(page.steps) - 1
            mark_in.append(element.mark)
        if not (attrs and tag not in BLOCKS and attrs.rstrip().endswith("/") and not VALUE_SLASH.search(attrs)):
            if tag in SCOPES:
                element.near = 0
            elif tag in CLOSABLE:
                element.near = len(stack)
            stack.append(element)
            count[tag] += 1
    if at < len(html):
        rest = html[at:]
        cut = UNFINISHED.search(rest, max(0, end - at))
        text(rest[: cut.start()] if cut else rest)
    pop(1)
    flush()

    total, inside, drops, article = 0, [0] * len(marks), [], False
    if marks:
        for container, parts in pieces:
            for raw, linked, m in parts:
                n = max(0, len(" ".join(raw.split())) - linked)
                total += n
                if m < 0:
                    article = article or (page.article[container] and n > 0)
                    continue
                inside[m] += n
                marks[m].text += n
                marks[m].linked += linked
        for m in reversed(marks):  # those within before those around them
            if m.parent >= 0 and not m.sure:
                marks[m.parent].text += m.text
                marks[m.parent].linked += m.linked
        drops = counted(marks, total, inside, article)
    drops.append(False)  # for -1
    page.out = [drops[m] for m in mark_in]
    for container, parts in pieces:
        kept = [p for p in parts if not drops[p[2]]]
        text = " ".join("".join(p[0] for p in kept).split())
        if text:
            page.blocks.append((container, text, min(sum(p[1] for p in kept), len(text))))
    return page


def block_key(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def _weights(page: Page, furniture: frozenset) -> list[float]:
    """Characters of each container and those in it, less those in links and in the host's furniture."""
    total = [0.0] * len(page.steps)
    for container, text, linked in page.blocks:
        if not furniture or block_key(text) not in furniture:
            total[container] += max(0, len(text) - linked)
    for c in range(len(total) - 1, 0, -1):
        total[page.parents[c]] += total[c]
    return total


def best_container(page: Page, furniture: frozenset = frozenset()) -> tuple[int, float]:
    """The best container of a page, and its share of the page's text."""
    total = _weights(page, furniture)
    kids: dict[int, int] = {}  # the heaviest container in each, the first on ties
    for c in range(len(total) - 1, 0, -1):
        p = page.parents[c]
        if p not in kids or total[c] >= total[kids[p]]:
            kids[p] = c
    chain = [0]
    while (kid := kids.get(chain[-1], 0)) and total[chain[-1]] and total[kid] >= LEAST_SHARE * total[chain[-1]]:
        chain.append(kid)
        if page.top[kid]:
            break
    # The deepest of the chain that holds each container, as a place in the chain.
    place = {c: k for k, c in enumerate(chain)}
    under = [0] * len(total)
    for c in range(1, len(total)):
        under[c] = place.get(c, under[page.parents[c]])
    last = len(chain) - 1
    for container, text, linked in page.blocks:
        if under[container] < last and 2 * linked < len(text) and (not furniture or block_key(text) not in furniture) and (
                chain[under[container]] == container or (" " in text and not page.top[chain[-1]])):
            last = under[container]
    return chain[last], (total[chain[last]] / total[0] if total[0] else 0.0)


def extract(html: str, path: str | None, furniture: frozenset = frozenset()) -> str:
    """The text of the containers on the path; of the page's best container if there is none, or if it holds them and little else."""
    page = parse(html)
    chosen = page.on_path(path) if path is not None else [False] * len(page.steps)
    if any(chosen):  # of containers that share the path, those of nothing but links and furniture are not it
        weight = _weights(page, furniture)
        some = any(c and w for c, w in zip(chosen, weight))
        chosen = [c and (w > 0 or not some) for c, w in zip(chosen, weight)]
    taken = _within(page, chosen)
    best = best_container(page, furniture)[0]
    own = _within(page, [c == best for c in range(len(page.steps))])
    size = [sum(len(text) - linked for container, text, linked in page.blocks if t[container]) for t in (taken, own)]
    if not any(taken) or (all(o >= t for o, t in zip(own, taken)) and size[0] >= LEAST_SHARE * size[1]):
        taken = own
    return "\n".join(text for container, text, _ in page.blocks if taken[container])


def _within(page: Page, chosen: list[bool]) -> list[bool]:
    """Whether each container is chosen or in one that is."""
    taken = list(chosen)
    for c in range(1, len(taken)):
        taken[c] = taken[c] or taken[page.parents[c]]
    return taken


def _block_votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, block, page) for the distinct blocks of a page outside articles; a page is named by its longest block."""
    for part, htmls in text_slices(batches, "html"):
        hosts, blocks, names = [], [], []
        for host_, html in zip(part.column("host").to_pylist(), htmls):
            page = parse(html)
            found = {block_key(text) for container, text, _ in page.blocks if not page.article[container]}
            if found:
                name = block_key(max((text for _, text, _ in page.blocks), key=lambda t: (len(t), t)))
                hosts += [host_] * len(found)
                blocks += found
                names += [name] * len(found)
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(blocks, pa.int64()), pa.array(names, pa.int64())],
                                         ["host", "block", "page"])


def _furniture_of(part: pa.RecordBatch) -> list[frozenset]:
    return [frozenset(x or ()) for x in part.column("furniture").to_pylist()]


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in text_slices(batches, "html"):
        paths, shares = [], []
        for html, furniture in zip(texts, _furniture_of(part)):
            page = parse(html)
            best, share = best_container(page, furniture)
            paths.append(page.path(best))
            shares.append(share)
        yield pa.RecordBatch.from_arrays([part.column("host"), pa.array(paths, pa.string()), pa.array(shares, pa.float64())],
                                         ["host", "path", "share"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, htmls in text_slices(batches, "html"):
        found = [extract(h, p, f) for h, p, f in zip(htmls, part.column("path").to_pylist(), _furniture_of(part))]
        yield pa.RecordBatch.from_arrays(
            [part.column("page_id"), part.column("url"), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
            ["page_id", "url", "text", "n_chars"])


def host(url: Column) -> Column:
    """Lower-cased host of a url without a leading www; null without one."""
    name = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/@?#]*@)?(?:www\.)?([^/:?#]+)", 1)
    return F.when(name != "", name)


def host_furniture(pages: DataFrame) -> DataFrame:
    """(furniture_host, furniture): for each host the keys of the blocks that are the host's.

    A block stands on a fifth of a host's pages, so a host has at most five times a page's blocks of them.
    """
    votes = written(pages.filter("host is not null").select("host", "html").mapInArrow(_block_votes, "host string, block long, page long"), "block-votes")
    n = votes.groupBy("host").agg(F.count_distinct("page").alias("pages")).select(F.col("host").alias("of"), "pages")
    blocks = votes.groupBy("host", "block").agg(F.count_distinct("page").alias("n")).filter(F.col("n") >= LEAST_PAGES)
    kept = blocks.join(n, F.col("host") == F.col("of")).filter(F.col("n") >= LEAST_PAGE_SHARE * F.col("pages"))
    return kept.groupBy(F.col("host").alias("furniture_host")).agg(F.collect_set("block").alias("furniture"))


def winning_paths(pages: DataFrame) -> DataFrame:
    """(host, path): for each host the path with the most votes, the least path on ties. ``pages`` have their host's furniture."""
    votes = pages.filter("host is not null").select("host", "html", "furniture").mapInArrow(_votes, "host string, path string, share double")
    # Shares as whole thousandths, so that the sums do not depend on their order.
    counted = votes.groupBy("host", "path").agg(F.sum(F.round(F.col("share") * 1000).cast("long")).alias("votes"))
    return counted.groupBy("host").agg(F.min_by("path", F.struct(-F.col("votes"), "path")).alias("path"))


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of ``pages`` (page_id, url, html)."""
    rows = pages.select("page_id", "url", "html", host(F.col("url")).alias("host"))
    # Tables of hosts are written, so that their size is known: small ones are broadcast, large ones are joined by host.
    furniture = written(host_furniture(rows), "furniture")
    rows = rows.join(furniture, F.col("host") == F.col("furniture_host"), "left").drop("furniture_host")
    winners = written(winning_paths(rows), "paths").withColumnRenamed("host", "winner_host")
    id_type = rows.schema["page_id"].dataType.simpleString()
    return (rows.join(winners, F.col("host") == F.col("winner_host"), "left").select("page_id", "url", "html", "path", "furniture")
            .mapInArrow(_texts, f"page_id {id_type}, url string, text string, n_chars long"))
