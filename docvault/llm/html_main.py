"""Main-text extraction from whole HTML pages with a site style tree.

1. Each page is parsed once, in time linear in its length, into blocks of text and a tree of elements.  What names
   itself as furniture (by tag, role, class or id) is marked, and the article region is chosen: the largest candidate
   and its siblings of the same kind, in page order.  Inside an article a class or id marks furniture only if all of
   its words do (``share-bar``, not ``share-price``); what else repeats there is for the tree to find.
2. The trees of one host are merged into a site style tree: an element is identified by its path of tags, classes
   and ids (long numbers in classes and all numbers in ids count as one).
   For each such node, over the host's pages with different main text: the *presentation* importance is the entropy
   of its child sequences, the *content* importance is one minus the mean entropy of its texts over pages (a text
   on every page has entropy 1), and the composite is ``(1 - G**l) * presentation + G**l * content`` with ``l``
   child sequences (Yi, Liu and Li, 2003).
3. In branches of low importance, the blocks whose own text repeats over the host's pages (its content importance is low
   too) are removed from each page's region: with many child sequences the composite is low on any large host, whatever
   the texts.  Headings and paragraphs that stand directly in the article are not in branches.  Exact copies of an
   article count as one page, so they don't look like furniture.

Scale: one map parses and writes pages with their blocks; the tree is built from narrow rows with partial
aggregates, so a host with a third of all pages is no hot task; only pages that lose a branch take part in a join,
and Spark picks its kind from the written size.

Defined results: a null or empty html gives an empty text; a null or odd url counts as host ''; repeated pages are
pages of their own; pages without an article element fall back to main, then to content containers, then to
the body without link lists (of which the tree removes what repeats on the host); unclosed elements end where HTML
says; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docvault.llm.common import numbered, stage_table, table

MIN_PAGES = 5  # different pages of a host below which its tree says nothing
LOW = 0.2  # importance below which a branch is removed
GAMMA = 0.9
MOSTLY = 0.6  # share of the page's text above which a class name alone marks no furniture

# HTML element names by their role here, and words that name furniture in classes and ids.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math object select option canvas".split())
BLOCK = frozenset("address article aside blockquote body br dd details dialog div dl dt fieldset figcaption figure footer form "
                  "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot "
                  "th thead tr ul caption legend center".split())
NOISE_TAGS = frozenset("head nav footer aside form button dialog menu search label fieldset".split()) | RAW
PLAIN = frozenset("html body article main p h1 h2 h3 h4 h5 h6 br hr".split())
CLOSES_P = BLOCK - {"br", "body", "html"}
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}
NOISE_WORDS = frozenset("ad ads adv adbox adslot adunit outbrain taboola teaser teasers advert advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr "
                        "notice notices alert popup modal overlay newsletter subscribe subscription signup login sidebar aside rail menu nav "
                        "navbar navigation breadcrumb breadcrumbs pagination pager footer masthead topbar toolbar comment comments "
                        "disqus respond reply replies share sharing social related recommended recommendations widget widgets "
                        "copyright disclaimer hidden feedback".split())
HEADER_WORDS = frozenset(["header"])
NEUTRAL_WORDS = frozenset("all area article articles bar block body bottom box btn button buttons card cards col column container content count "
                          "desktop display email facebook feed fixed form global grid group head header heading holder icon icons id inline inner is "
                          "item items js label large latest left link links list main media mini mobile module native new news outer page panel "
                          "popular post posts primary print reader readers right row secondary section site slot small space sticky stories story "
                          "text the thread title top twitter unit user users wrap wrapper zone".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
CONTENT_WORDS = frozenset("content article post entry story main".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
                   r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
OPEN_COMMENT = re.compile(r"<!--|<!\[CDATA\[")
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|([^\s=\"'/>]+)")
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
DIGITS, NUMBER = re.compile(r"\d+"), re.compile(r"\d{3,}")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _furniture(name: str) -> bool:
    """Whether all words of a class or id speak of furniture, and not only one of them."""
    words = {w.lower() for w in NAME_WORD.findall(name)}
    return not NOISE_WORDS.isdisjoint(words) and all(w in NOISE_WORDS or w in NEUTRAL_WORDS or len(w) == 1 for w in words)


def _hash(*parts) -> int:
    import xxhash

    h = xxhash.xxh64_intdigest("\x1f".join(map(str, parts)).encode("utf-8", "replace"))
    return h - (1 << 64) if h >> 63 else h


class Page:
    """Elements (parent, tag, path, noise marks, child tags) and blocks (lists of (element, text))."""

    def __init__(self, text: str):
        self.parent, self.tag, self.path, self.hard, self.soft = [-1], ["html"], [_hash("html")], [False], [False]
        self.content, self.children, self.kind = [False], [[]], ["html"]  # kind: the tag, or the role that stands for one
        self.blocks: list[list[tuple[int, str]]] = []
        self._parse(text)
        self._judge()

    def _open(self, up: int, tag: str, raw: str, in_article: bool) -> int:
        attrs = {}
        if raw and not raw.isspace():
            for m in ATTRIBUTE.finditer(raw):
                name = (m[1] or m[5]).lower()
                value = next((x for x in (m[2], m[3], m[4]) if x is not None), "")
                attrs.setdefault(name, entities.unescape(value) if "&" in value else value)
        names = f"{attrs.get('class', '')} {attrs.get('id', '')}"
        words = {w.lower() for w in NAME_WORD.findall(names)} if not names.isspace() else ()
        hidden = ("hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or bool(HIDDEN.search(attrs.get("style", ""))))
        role = attrs.get("role", "").lower()
        plain = tag in ("html", "body", "main")
        self.hard.append(not plain and (tag in NOISE_TAGS or hidden or role in NOISE_ROLES or (tag == "header" and not in_article)))
        named = not NOISE_WORDS.isdisjoint(words)
        if in_article:
            soft = named and any(_furniture(x) for x in names.split())
        else:
            soft = named or not HEADER_WORDS.isdisjoint(words)
        self.soft.append(not plain and soft)
        self.content.append(not CONTENT_WORDS.isdisjoint(words))
        self.parent.append(up)
        self.tag.append(tag)
        self.kind.append({"article": "article", "main": "main"}.get(role, tag))
        style = NUMBER.sub("0", attrs.get("class", "")), DIGITS.sub("0", attrs.get("id", ""))  # col-1 is not col-2, but post-1234 any post
        self.path.append(_hash(self.path[up], tag, *style))
        self.children.append([])
        self.children[up].append(tag)
        return len(self.tag) - 1

    def _parse(self, text: str) -> None:
        stack, block, pos, articles = [0], [], 0, 0
        tags, kind, end, last = self.tag, self.kind, len(text), text.rfind(">")
        depths: dict[str, list[int]] = {}  # of the open elements by tag, rising
        unclosed = set()  # raw tags without an end tag in the rest

        def put(a, b):
            if a < b:
                chunk = text[a:b]
                block.append((stack[-1], entities.unescape(chunk) if "&" in chunk else chunk))

        def flush():
            nonlocal block
            if block:
                self.blocks.append(block)
                block = []

        def nearest(names):
            return max((depths[t][-1] for t in names if depths.get(t)), default=0)

        def close_to(depth):
            nonlocal articles
            while len(stack) > depth:
                i = stack.pop()
                depths[tags[i]].pop()
                articles -= kind[i] in ("article", "main")

        while pos < end:
            if pos > last:  # no tag ends any more: text up to a comment
                m = OPEN_COMMENT.search(text, pos)
                put(pos, m.start() if m else end)
                break
            m = TOKEN.search(text, pos)
            if not m:
                put(pos, end)
                break
            put(pos, m.start())
            pos = m.end()
            name = m[2] or m[5]
            if not name:
                continue
            tag = name.lower()
            if tag in BLOCK:
                flush()
            if m[1] or m[4]:  # an end tag: closes the nearest open element of that name
                if d := nearest((tag,)):
                    close_to(d)
                continue
            attrs = m[3] if m[2] else m[6]
            if tag in CLOSES_P and (d := nearest(("p",))):  # no other block is open in a paragraph
                close_to(d)
            if tag in SIBLINGS:
                scope = nearest(SCOPES[tag])
                while (d := nearest(SIBLINGS[tag])) > scope:
                    close_to(d)
                    if tag != "tr":
                        break
            if tag in VOID:
                continue
            if tag in RAW and not attrs.endswith("/"):
                stop = None if tag in unclosed else re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(text, pos)
                if not stop:
                    unclosed.add(tag)
                pos = stop.end() if stop else (end if tag in ("script", "style", "textarea", "title") else pos)
                continue
            if tag in ("html", "body") and depths.get(tag):
                continue
            stack.append(self._open(stack[-1], tag, attrs, articles > 0))
            depths.setdefault(tag, []).append(len(stack) - 1)
            articles += kind[stack[-1]] in ("article", "main")
            if attrs.endswith("/") and tag not in BLOCK:
                close_to(len(stack) - 1)
        flush()

    def _judge(self) -> None:
        n = len(self.tag)
        up, tag = self.parent, self.tag
        hard = self.hard
        for i in range(1, n):
            hard[i] = hard[i] or hard[up[i]]
        size, linked = [0] * n, [0] * n
        for b in self.blocks:
            for i, t in b:
                if not hard[i]:
                    size[i] += len(t)
                    if tag[i] == "a":
                        linked[i] += len(t)
        for i in range(n - 1, 0, -1):
            size[up[i]] += size[i]
            linked[up[i]] += size[i] if tag[i] == "a" else linked[i]
        noise = [False] * n
        for i in range(n):
            soft = self.soft[i] and size[i] <= MOSTLY * size[0]
            noise[i] = hard[i] or soft or (i > 0 and noise[up[i]])
        def text_of(i):
            return not noise[i] and size[i] > 0 and linked[i] <= MOSTLY * size[i]

        region = [0]
        for wanted in (lambda i: self.kind[i] == "article", lambda i: self.kind[i] == "main", lambda i: self.content[i] and tag[i] in BLOCK):
            found = [i for i in range(1, n) if not noise[i] and wanted(i) and size[i]]
            if found:
                best = max(found, key=lambda i: (text_of(i), size[i], -i))  # lists of links last
                same = (lambda i: self.kind[i] == self.kind[best]) if self.kind[best] in ("article", "main") else (lambda i: self.path[i] == self.path[best])
                region = [i for i in found if i == best or (up[i] == up[best] and same(i) and text_of(i))]
                break
        inside = [False] * n
        for i in region:
            inside[i] = True
        for i in range(1, n):
            inside[i] = (inside[i] or inside[up[i]]) and not noise[i]
            if region == [0] and tag[i] in BLOCK and tag[i] not in ("html", "body") and size[i] and linked[i] > MOSTLY * size[i]:
                inside[i] = False  # without an article: lists of links are no text
        owner = [-1] * n  # the nearest element that may be removed as a branch
        for i in range(1, n):
            owner[i] = i if tag[i] in BLOCK and self.kind[i] not in PLAIN else owner[up[i]]
        self.inside, self.owner = inside, owner

    def main(self) -> list[tuple[str, int | None]]:
        """Blocks of the region: (text, path of the branch that holds it or null)."""
        out = []
        for b in self.blocks:
            kept = [(i, t) for i, t in b if self.inside[i]]
            text = " ".join("".join(t for _, t in kept).split())
            if text:
                own = self.owner[kept[0][0]]
                out.append((text, self.path[own] if own >= 0 else None))
        return out

    def nodes(self) -> list[tuple[int, int, int]]:
        """(path, child sequence, text) of each branch and block, as hashes."""
        out, styles = set(), {}
        for b in self.blocks:
            b = [(i, t) for i, t in b if self.inside[i]] or b  # the text that main() gives
            own = self.owner[b[0][0]]
            text = " ".join("".join(t for _, t in b).split())
            if own >= 0 and text:
                if own not in styles:
                    styles[own] = _hash(*self.children[own])
                out.add((self.path[own], styles[own], _hash(text)))
        return sorted(out)


SCHEMA = ("page_id long, url string, rid long, host string, main_hash long, blocks array<struct<text:string,path:long,feature:long>>, "
          "nodes array<struct<path:long,style:long,feature:long>>")


def _parsed(batches):
    import pyarrow as pa

    blocks = pa.list_(pa.struct([("text", pa.string()), ("path", pa.int64()), ("feature", pa.int64())]))
    nodes = pa.list_(pa.struct([("path", pa.int64()), ("style", pa.int64()), ("feature", pa.int64())]))
    for whole in batches:
        for at in range(0, whole.num_rows, 500):
            batch = whole.slice(at, 500)
            out = []
            for text in batch.column("html").to_pylist():
                page = Page(text or "")
                main = page.main()
                out.append((_hash(*[t for t, _ in main]), [{"text": t, "path": p, "feature": _hash(t)} for t, p in main],
                            [dict(zip(("path", "style", "feature"), x, strict=True)) for x in page.nodes()]))
            cols = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("page_id", "url", "rid", "host")], pa.array(cols[0], pa.int64()),
                 pa.array(cols[1], blocks), pa.array(cols[2], nodes)],
                names=["page_id", "url", "rid", "host", "main_hash", "blocks", "nodes"])


def _seen(parsed: DataFrame) -> DataFrame:
    return parsed.select("host", "main_hash", F.explode("nodes").alias("n")).select("host", "main_hash", "n.path", "n.style", "n.feature")


def _texts(seen: DataFrame) -> DataFrame:
    """``host, path, feature, c``: the pages of each text of a node."""
    return (seen.groupBy("host", "path", "feature", "main_hash").agg(F.lit(1).alias("one"))
            .groupBy("host", "path", "feature").agg(F.count("*").alias("c")))


def importance(parsed: DataFrame) -> DataFrame:
    """The site style tree: ``host, path, n_pages, presentation, content, composite`` for every node of every host."""
    seen = _seen(parsed)
    pages = (seen.groupBy("host", "path", "main_hash").agg(F.min("style").alias("style"))
             .groupBy("host", "path", "style").agg(F.count("*").alias("k")))
    m = F.col("n_pages")
    shape = pages.groupBy("host", "path").agg(
        F.sum("k").alias("n_pages"), F.count("*").alias("n_styles"), F.sum(F.col("k") * F.log("k")).alias("_klogk"))
    # entropy to base m: (ln m - sum(k ln k) / m) / ln m
    shape = shape.where(m > 1).withColumn("presentation", 1 - F.col("_klogk") / (m * F.log(m)))
    texts = _texts(seen).groupBy("host", "path").agg(F.avg(F.log("c")).alias("_logc"))
    tree = shape.join(texts, ["host", "path"]).withColumn("content", 1 - F.col("_logc") / F.log(m))
    damp = F.pow(F.lit(GAMMA), F.col("n_styles"))
    return tree.select("host", "path", "n_pages", "presentation", "content",
                       ((1 - damp) * F.col("presentation") + damp * F.col("content")).alias("composite"))


def parse(pages: DataFrame) -> DataFrame:
    """``page_id, url, html`` → the pages' blocks and nodes (``SCHEMA``), written."""
    host = F.regexp_extract(F.lower(F.coalesce("url", F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    rows = numbered(pages.select("page_id", "url", "html"), "rid")
    rows = rows.select("page_id", "url", "rid", host.alias("host"), "html")
    return stage_table(rows.mapInArrow(_parsed, SCHEMA), "pages")


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, html`` → ``page_id, url, text, n_chars``."""
    parsed = parse(pages)
    low = importance(parsed).where((F.col("n_pages") >= MIN_PAGES) & (F.col("composite") < LOW)).select("host", "path", "n_pages")
    low = stage_table(low, "low-nodes")
    repeated = _texts(_seen(parsed).join(low.select("host", "path"), ["host", "path"])).join(low, ["host", "path"])
    repeated = repeated.where(1 - F.log("c") / F.log("n_pages") < LOW).select("host", "path", "feature")
    marks = F.array_distinct(F.transform("blocks", lambda b: F.struct(b["path"].alias("path"), b["feature"].alias("feature"))))
    used = parsed.select("rid", "host", F.explode(marks).alias("b")).select("rid", "host", "b.path", "b.feature")
    lost = used.where("path is not null").join(stage_table(repeated, "repeated-texts"), ["host", "path", "feature"])
    lost = stage_table(lost.groupBy("rid").agg(F.collect_set(F.struct("path", "feature")).alias("lost")), "lost")
    out = parsed.select("page_id", "url", "rid", "blocks").join(lost, "rid", "left")
    kept = F.filter("blocks", lambda b: b["path"].isNull() | F.col("lost").isNull() | ~F.array_contains(
        F.col("lost"), F.struct(b["path"].alias("path"), b["feature"].alias("feature"))))
    text = F.array_join(F.transform(kept, lambda b: b["text"]), " ")
    return out.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))


def query(spark, sf_dir):
    """op9: every page."""
    return extract(table(spark, sf_dir, "pages"))


SQL = None
