"""Main text of web pages by wrapper induction.

1. *Trees.* Every page is parsed into a DOM tree. Its *skeleton* keeps element labels (tag
   plus class and id without digits); neighbouring siblings of one label are
   folded into one node, so lists and paragraphs of any number are one node.
2. *Alignment.* The skeletons of a host are merged pairwise by simple tree
   matching (the matching of the children in order that aligns the most nodes). A merged node
   knows how many pages have it, its most frequent texts (mergeable counts), and
   how much text it held. Merging runs inside tasks first; partial templates of a host are
   merged in two rounds, so a host with a third of all pages is no hot task, and what is shuffled is
   as small as the templates, whatever the number of pages.
3. *Wrapper.* The content root is the slot that holds the article: an ``article`` or
   ``main`` element if the template has one, else the deepest slot with most of the varying
   text. Menus, headers, footers, sidebars, notices, adverts, forms and comments (told by
   element, class, id and role) are chrome: they vary from page to page as well.
   The pages that have a text in a slot (its path of labels, from the innermost article on)
   are counted exactly; a text that ``TEMPLATE_SHARE`` of the pages with the root (``LEAST_PAGES`` at
   least) have in one slot is template. Other texts in the same slot are not. For the
   choice of the root alone, the shares of a node's texts are those of its frequent ones.
4. *Extraction.* The text of each page's content root without the template's texts and
   without chrome, block by block. A page in which the root is missing is judged alone by
   the same rules.

A host with fewer pages, or whose pages are all copies of each other, shows no template; then
only the rules on chrome apply.

Scale. The counts are combined in the tasks (``TEXTS_HELD``) and then by host, slot and digest,
so a hot host's texts are spread over all tasks; what is left per host is what most of its pages
share. Wrappers (about 1 KB a host) are broadcast if they prove to be under
``BROADCAST_BYTES``; beyond that they meet the pages in a sort-merge join, whose hot hosts
adaptive execution splits.

Defined results: null html counts as empty, and empty html has an empty text; a null URL, or
one without a host, is of the host ``""``; repeated rows are extracted each; an empty table
gives an empty result. Only page_id, url and html are read, so extra columns cannot clash.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import salt_count, written

#: Pages of a host that must agree on a text before it counts as template.
LEAST_PAGES = 8
#: Share of a host's pages with the content root that must have a text before it counts as template.
TEMPLATE_SHARE = 0.8
#: Frequent texts a template node counts; a count is short by at most a 17th of the node's texts.
MOST_TEXTS = 16
#: Levels of blocks that a template tells apart; pages are read and extracted at any depth, and
#: what is deeper counts for the slot at that level.
MOST_DEPTH = 150
#: Children of a template node; beyond it those of one label become one node, as all do when the root is chosen.
MOST_CHILDREN = 48
#: Hosts whose partial templates a task holds at once.
HOSTS_HELD = 2000
#: Counted texts a task holds at once.
TEXTS_HELD = 200_000
BROADCAST_BYTES = 32 << 20
SCHEMA = "page_id long, url string, text string, n_chars long"
PARTIAL_SCHEMA = "host string, template string"
COUNTED_SCHEMA = "host string, template string, slot long, text long, pages long, chars long"
ROOT_SCHEMA = "host string, root string, slot long, slots array<long>, chars long"

#: Kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style noscript template iframe svg math object canvas audio video head title select textarea button datalist".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                  "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody "
                  "td tfoot th thead tr ul".split())
CLOSED_BY_BLOCK = frozenset(("p",))
CLOSES = {"li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")), "tr": frozenset(("tr", "td", "th")),
          "td": frozenset(("td", "th")), "th": frozenset(("td", "th")), "option": frozenset(("option",)),
          "tbody": frozenset(("tr", "td", "th", "tbody", "thead")), "tfoot": frozenset(("tr", "td", "th", "tbody", "thead"))}
SCOPE = frozenset("table ul ol dl html body article section div main td th".split())
#: Chrome by element, by role, and by a word of class or id.
CHROME_TAGS = frozenset("nav footer aside form dialog menu search".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
CHROME_WORDS = frozenset("ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie "
                         "cookies disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notices notification pagination "
                         "paywall popup promo promotion related replies responses share sharing sidebar signup skip social sponsor sponsored subscribe "
                         "subscription tags toolbar topbar widget widgets".split())
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
NEVER_CHROME = frozenset("html body article main h1 h2 h3 h4 h5 h6".split())


class Node:
    """An element; ``parts`` are its children and texts in order."""
    __slots__ = ("tag", "label", "chrome", "parts")

    def __init__(self, tag: str, attrs: list[tuple[str, str | None]], in_article: bool = False):
        self.tag, self.parts = tag, []
        names = " ".join(v for k, v in attrs if k in ("class", "id") and v)
        self.label = tag if not names else tag + "." + ".".join(sorted(set(re.sub(r"\d+", "", names).split())))
        role = next((v for k, v in attrs if k == "role" and v), "").lower()
        self.chrome = tag not in ("html", "body", "main") and (
            tag in CHROME_TAGS or tag in RAW or (tag == "header" and not in_article) or role in CHROME_ROLES
            or any(k == "hidden" for k, _ in attrs) or (tag not in NEVER_CHROME and self.named(names))
            or (tag == "article" and self.named(names)))

    @staticmethod
    def named(names: str) -> bool:
        return any(w.lower() in CHROME_WORDS for w in NAME_WORD.findall(names))


class Trees(HTMLParser):
    """Builds a tree; closes what the text leaves open."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#", [])
        self.open = [self.root]
        self.count: dict[str, int] = defaultdict(int)  # open elements by tag

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self.shut(CLOSED_BY_BLOCK)
        if tag in CLOSES:
            self.shut(CLOSES[tag])
        # A second html or body element adds nothing.
        if tag in ("html", "body") and self.count[tag]:
            return
        node = Node(tag, attrs, bool(self.count["article"] or self.count["main"]))
        self.open[-1].parts.append(node)
        if tag not in VOID:
            self.open.append(node)
            self.count[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open[-1].tag == tag and tag in RAW:
            self.close_from(len(self.open) - 1)

    def close_from(self, i: int):
        for n in self.open[i:]:
            self.count[n.tag] -= 1
        del self.open[i:]

    def handle_endtag(self, tag):
        if not self.count[tag]:
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                self.close_from(i)
                return
            # An inline end tag does not close the blocks inside which it stands.
            if tag not in BLOCK and self.open[i].tag in BLOCK:
                return

    def shut(self, tags: frozenset):
        if not any(self.count[t] for t in tags):
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                self.close_from(i)
            elif self.open[i].tag in SCOPE:
                return

    def handle_data(self, data):
        self.open[-1].parts.append(data)


def tree(html: str) -> Node:
    parser = Trees()
    parser.feed(html)
    parser.close()
    return parser.root


def own_text(node: Node) -> str:
    """Text of a node outside its block children."""
    out, todo = [], [iter(node.parts)]
    while todo:
        for p in todo[-1]:
            if isinstance(p, str):
                out.append(p)
            elif p.tag == "br":
                out.append(" ")
            elif p.tag not in BLOCK and not p.chrome:
                todo.append(iter(p.parts))
                break
        else:
            todo.pop()
    return " ".join("".join(out).split())


def block_children(node: Node) -> Iterator[Node]:
    """Nearest block elements (and chrome) under a node."""
    todo = [iter(node.parts)]
    while todo:
        for p in todo[-1]:
            if not isinstance(p, str):
                if p.tag in BLOCK or p.chrome:
                    yield p
                else:
                    todo.append(iter(p.parts))
                    break
        else:
            todo.pop()


@lru_cache(maxsize=1 << 16)
def below(slot: int, label: str) -> int:
    """The slot of a label under a slot; an article's or main's own starts anew, wherever it stands."""
    start = 0 if label.split(".")[0] in ("article", "main") else slot
    return digest(f"{start} {label}")


def digest(text: str) -> int:
    """64 bits of a text, never 0."""
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True) or 1


# A template node is a list: [label, pages, digest of its text or, if it varies, {digest: [pages, characters of one]} of
# the frequent ones, characters, chrome, children].
LABEL, PAGES, SAME, CHARS, CHROME, CHILDREN = range(6)


def skeleton(node: Node, depth: int = 0) -> list:
    """A page's template: folded blocks; chrome is kept as a leaf."""
    if node.chrome:
        text = ""
    elif depth < MOST_DEPTH:
        text = own_text(node)
    else:
        text = " ".join(t for _, _, t in blocks(node) if t)
    same = blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest() if text else "-"
    out = [node.label, 1, same, len(text), int(node.chrome), []]
    if not node.chrome and depth < MOST_DEPTH:
        for child in block_children(node):
            if child.tag in VOID:
                continue
            s = skeleton(child, depth + 1)
            if out[CHILDREN] and out[CHILDREN][-1][LABEL] == s[LABEL]:
                fold(out[CHILDREN][-1], s)
            else:
                out[CHILDREN].append(s)
    return out


def fold(a: list, b: list) -> None:
    """Neighbouring siblings of a page become one node; their texts in order are its text."""
    both = "".join(n[SAME] if isinstance(n[SAME], str) else json.dumps(n[SAME], sort_keys=True) for n in (a, b))
    a[SAME] = blake2b(both.encode(), digest_size=8).hexdigest()
    a[CHARS] += b[CHARS]
    a[CHILDREN] = aligned(a[CHILDREN], b[CHILDREN], fold)


def frequent(n: list) -> dict[str, list[int]]:
    """Pages and characters of a template node's frequent texts."""
    return n[SAME] if isinstance(n[SAME], dict) else {n[SAME]: [n[PAGES], n[CHARS] // n[PAGES]]}


def merge(a: list, b: list) -> list:
    """Two templates of one label become one (the first is changed)."""
    if isinstance(a[SAME], dict) or a[SAME] != b[SAME]:
        a[SAME] = counts = frequent(a)
        for text, (pages, chars) in frequent(b).items():
            counts[text] = [counts[text][0] + pages if text in counts else pages, chars]
        if len(counts) > MOST_TEXTS:
            least = sorted((n for n, _ in counts.values()), reverse=True)[MOST_TEXTS]
            a[SAME] = {text: [n - least, chars] for text, (n, chars) in counts.items() if n > least}
    a[PAGES] += b[PAGES]
    a[CHARS] += b[CHARS]
    a[CHROME] = int(a[CHROME] and b[CHROME])
    a[CHILDREN] = aligned(a[CHILDREN], b[CHILDREN], merge)
    return a


def matched(a: list, b: list) -> int:
    """Simple tree matching: the most nodes that two trees align, roots included."""
    if a[LABEL] != b[LABEL]:
        return 0
    x, y = a[CHILDREN], b[CHILDREN]
    if [n[LABEL] for n in x] == [n[LABEL] for n in y]:
        return 1 + sum(map(matched, x, y))
    last = [0] * (len(y) + 1)
    for m in x:
        row = [0]
        for j, n in enumerate(y):
            row.append(max(row[j], last[j + 1], last[j] + (matched(m, n) if m[LABEL] == n[LABEL] else 0)))
        last = row
    return 1 + last[-1]


def aligned(x: list, y: list, join) -> list:
    """Children of two matched nodes, aligned in order; what has no partner is kept in its place."""
    if [n[LABEL] for n in x] == [n[LABEL] for n in y]:
        for a, b in zip(x, y):
            join(a, b)
        return x
    score = [[0] * (len(y) + 1)]
    for m in x:
        row = [0]
        for j, n in enumerate(y):
            row.append(max(row[j], score[-1][j + 1], score[-1][j] + (matched(m, n) if m[LABEL] == n[LABEL] else 0)))
        score.append(row)
    out, i, j = [], len(x), len(y)
    while i or j:
        if i and score[i][j] == score[i - 1][j]:
            i -= 1
            out.append(x[i])
        elif j and score[i][j] == score[i][j - 1]:
            j -= 1
            out.append(y[j])
        else:
            i, j = i - 1, j - 1
            join(x[i], y[j])
            out.append(x[i])
    out.reverse()
    if len(out) > MOST_CHILDREN:
        slots: dict[str, list] = {}
        for n in out:
            if n[LABEL] in slots:
                merge(slots[n[LABEL]], n)
            else:
                slots[n[LABEL]] = n
        out = list(slots.values())
    return out


def merged(templates: list[str]) -> str:
    """One template out of several of a host, in an order that does not depend on their arrival."""
    out = None
    for t in sorted(templates):
        t = json.loads(t)
        out = t if out is None else merge(out, t)
    return json.dumps(out, ensure_ascii=False, separators=(",", ":"))


def collapsed(node: list) -> list:
    """A template whose children of one label are one node, as a path of labels means them."""
    slots: dict[str, list] = {}
    for c in node[CHILDREN]:
        if c[LABEL] in slots:
            merge(slots[c[LABEL]], c)
        else:
            slots[c[LABEL]] = c
    node[CHILDREN] = [collapsed(slots[label]) for label in sorted(slots)]
    return node


def varying(node: list, pages: int) -> int:
    """Characters of varying text in a template's node, chrome left out; the host has so many pages."""
    if node[CHROME]:
        return 0
    counts = frequent(node)
    short = (node[PAGES] - sum(n for n, _ in counts.values())) / (MOST_TEXTS + 1)
    least = TEMPLATE_SHARE * min(node[PAGES], pages)
    constant = sum(n * chars for n, chars in counts.values() if n + short >= least)
    return max(0, node[CHARS] - constant) + sum(varying(c, pages) for c in node[CHILDREN])


def wrapper(template: str) -> tuple[str, int, list[int], int]:
    """A host's content root: path of labels to it, its slot, the slots under it and their characters."""
    top = collapsed(json.loads(template))
    pages = top[PAGES]
    total = varying(top, pages)
    path, node = [], top

    def article(n: list, tag: str) -> list[str] | None:
        """Path to the element of a kind with most varying text."""
        found = None
        for c in n[CHILDREN]:
            if c[CHROME]:
                continue
            own = [c[LABEL]] if c[LABEL].split(".")[0] == tag else None
            if own is None and (deeper := article(c, tag)):
                own = [c[LABEL], *deeper]
            if own and (found is None or at(c, own[1:])[CHARS] >= 0 and varying(c, pages) > found[0]):
                found = (varying(c, pages), own)
        return found[1] if found else None

    def at(n: list, labels: list[str]) -> list:
        for label in labels:
            n = next(c for c in n[CHILDREN] if c[LABEL] == label)
        return n

    path = article(top, "article") or article(top, "main") or []
    if path:
        node = at(top, path)
    else:
        while True:
            best = max((c for c in node[CHILDREN] if not c[CHROME]), key=lambda c: varying(c, pages), default=None)
            # Into the one child with nearly all of the text, unless it is a paragraph of its own.
            if best is None or not total or varying(best, pages) < 0.9 * total or best[LABEL].split(".")[0] not in ("html", "body", "div", "section", "center", "table", "tbody", "tr", "td"):
                break
            path.append(best[LABEL])
            node = best
    slot = 0
    for label in path:
        slot = below(slot, label)
    slots: set[int] = set()

    def walk(n: list, here: int) -> None:
        slots.add(here)
        for c in n[CHILDREN]:
            if not c[CHROME]:
                walk(c, below(here, c[LABEL]))

    walk(node, slot)
    return json.dumps(path, ensure_ascii=False, separators=(",", ":")), slot, sorted(slots), text_chars(node)


def text_chars(node: list) -> int:
    return 0 if node[CHROME] else node[CHARS] + sum(map(text_chars, node[CHILDREN]))


def blocks(page: Node, roots: list[Node] | None = None) -> Iterator[tuple[int, bool, str | None]]:
    """(slot, whether it is a heading's, text) of the blocks in the roots (or the page) in page order, chrome
    left out; an element's start gives its slot without a text."""
    inside = None if roots is None else set(map(id, roots))
    inline: list[str] = []

    def end(slot: int, heading: bool) -> Iterator[tuple[int, bool, str | None]]:
        text = " ".join("".join(inline).split())
        inline.clear()
        if text:
            yield slot, heading, text

    yield 0, False, None
    # Open elements: what is left of their parts, slot, whether a heading, whether shown, levels of blocks, whether a block.
    todo = [(iter(page.parts), 0, False, inside is None or id(page) in inside, 0, True)]
    while todo:
        parts, slot, heading, shown, depth, block = todo[-1]
        for p in parts:
            if isinstance(p, str):
                if shown:
                    inline.append(p)
            elif p.tag == "br":
                inline.append(" ")
            elif p.chrome:
                if p.tag in BLOCK:
                    yield from end(slot, heading)
            elif p.tag in BLOCK:
                yield from end(slot, heading)
                here, title = below(slot, p.label) if depth < MOST_DEPTH else slot, p.label[:2] in ("h1", "h2", "h3")
                yield here, title, None
                todo.append((iter(p.parts), here, title, shown or id(p) in inside, depth + 1, True))
                break
            else:
                todo.append((iter(p.parts), slot, heading, shown, depth, False))
                break
        else:
            todo.pop()
            if block:
                yield from end(slot, heading)


def find(node: Node, path: list[str]) -> list[Node]:
    """Nodes of a page at a path of labels, in page order."""
    found = [node]
    for label in path:
        found = [c for n in found for c in block_children(n) if c.label == label and not c.chrome]
    return found


def roots_of(node: Node, tag: str) -> list[Node]:
    """Outermost elements of a kind outside chrome."""
    out, todo = [], [node]
    while todo:
        n = todo.pop()
        if n is not node and n.tag == tag:
            out.append(n)
        else:
            todo += [c for c in block_children(n) if not c.chrome][::-1]
    return out


def main_text(html: str, wrap: str | None) -> str:
    page = tree(html)
    path, template = json.loads(wrap) if wrap else ([], [])
    named = path and path[-1].split(".")[0] in ("article", "main")
    roots = find(page, path) if path else []
    if not roots or not named:
        roots = roots_of(page, "article") or roots_of(page, "main") or roots or [page]
    skip = frozenset(template)
    return "\n".join(t for slot, heading, t in blocks(page, roots) if t is not None and not (skip and not heading and digest(f"{slot} {t}") in skip))


def counted(page: Node) -> dict[tuple[int, int], int]:
    """Characters of a page's texts by slot and digest; a slot itself has digest 0. Headings belong to their article."""
    out: dict[tuple[int, int], int] = {}
    for slot, heading, text in blocks(page):
        if text is None:
            out.setdefault((slot, 0), 0)
        elif not heading:
            key = slot, digest(f"{slot} {text}")
            out[key] = out.get(key, 0) + len(text)
    return out


def host_of(url: Column) -> Column:
    """Lower-case host of a URL, "" if it has none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^.*?://([^/?#]*)", 1)), F.lit(""))


def wrappers(pages: DataFrame) -> DataFrame:
    """One wrapper per host. ``pages``: host, html."""
    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list] = {}
        texts: dict[tuple[str, int, int], list[int]] = {}

        def out() -> pd.DataFrame:
            trees = [(h, json.dumps(t, ensure_ascii=False, separators=(",", ":")), 0, 0, 0, 0) for h, t in held.items()]
            counts = [(h, None, slot, text, n, chars) for (h, slot, text), (n, chars) in texts.items()]
            return pd.DataFrame(trees + counts, columns=["host", "template", "slot", "text", "pages", "chars"])

        for f in frames:
            for host, html in zip(f["host"], f["html"]):
                page = tree(html)
                s = skeleton(page)
                held[host] = merge(held[host], s) if host in held else s
                for (slot, text), chars in counted(page).items():
                    count = texts.setdefault((host, slot, text), [0, 0])
                    count[0] += 1
                    count[1] += chars
                if len(held) >= HOSTS_HELD or len(texts) >= TEXTS_HELD:
                    yield out()
                    held.clear()
                    texts.clear()
        if held:
            yield out()

    def together(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"host": [frame["host"].iloc[0]], "template": [merged(frame["template"].tolist())]})

    def finish(frame: pd.DataFrame) -> pd.DataFrame:
        root, slot, slots, chars = wrapper(merged(frame["template"].tolist()))
        return pd.DataFrame({"host": [frame["host"].iloc[0]], "root": [root], "slot": [slot], "slots": [slots], "chars": [chars]})

    found = written(pages.mapInPandas(partial, COUNTED_SCHEMA), "page-templates")
    parts = found.where("template is not null").select("host", "template")
    salt = F.pmod(F.xxhash64("template"), F.lit(salt_count(pages.sparkSession)))
    parts = parts.withColumn("salt", salt).groupBy("host", "salt").applyInPandas(together, PARTIAL_SCHEMA)
    roots = written(parts.groupBy("host").applyInPandas(finish, ROOT_SCHEMA), "page-roots")

    counts = found.where("template is null")
    having = counts.where("text = 0").groupBy("host", "slot").agg(F.sum("pages").alias("having"))
    hosts = roots.join(having, ["host", "slot"]).select("host", "slots", "chars", "having")
    texts = counts.where("text <> 0").groupBy("host", "slot", "text").agg(F.sum("pages").alias("pages"), F.sum("chars").alias("held"))
    shared = texts.where(F.col("pages") >= LEAST_PAGES).join(hosts, "host").where(F.col("pages") >= TEMPLATE_SHARE * F.col("having"))
    template = shared.groupBy("host").agg(F.sort_array(F.collect_list("text")).alias("texts"), F.first("chars").alias("all"),
                                          F.sum(F.when(F.expr("array_contains(slots, slot)"), F.col("held")).otherwise(0)).alias("held"))
    # Pages that agree in nearly everything are copies of each other, not a template.
    template = template.where(F.col("held") <= 0.5 * F.col("all")).select("host", "texts")
    listed = F.coalesce(F.to_json("texts"), F.lit("[]"))
    return roots.join(template, "host", "left").select("host", F.concat(F.lit("["), "root", F.lit(","), listed, F.lit("]")).alias("wrapper"))


def extract_main_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per row of ``pages``: page_id, url, text (main text), n_chars."""
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"),
                        host_of(F.col(url)).alias("host"))
    found = written(wrappers(rows.select("host", "html")), "wrappers")
    size = found.agg(F.coalesce(F.sum(F.octet_length("host") + F.octet_length("wrapper") + 64), F.lit(0))).first()[0]
    joined = rows.join(F.broadcast(found) if size <= BROADCAST_BYTES else found, "host", "left")

    def extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            texts = [main_text(h, w) for h, w in zip(f["html"], f["wrapper"])]
            yield pd.DataFrame({"page_id": f["page_id"], "url": f["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    return joined.select("page_id", "url", "html", "wrapper").mapInPandas(extract, SCHEMA)
