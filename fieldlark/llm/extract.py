"""Main-text extraction: template deduction from equivalence classes of tokens across the pages of a host.

Tokens are the element paths of a page (tag and class names, without inline markup) and its text blocks under them. Spark
folds each token's counts on the host's pages into an occurrence vector (two sums of hashes of (page, count)); tokens of a host
with equal vectors form an equivalence class. A class is valid if it has several tokens, is on SUPPORT of at least LEAST_PAGES pages, and is
ordered: its tokens begin in the same order on each of its pages. The element tokens of valid classes, nested by their
paths, are the host's template; its text tokens are the constants of the template. The text between them is variable, and each path of
variable text belongs to the deepest template element around it, a slot. The container is the deepest template element that
holds MOST_TEXT of the variable text of the host's pages without an article or main element, which alone need it. All pages of all hosts are counted; a hot host is combined before the
shuffle, and only template rows leave that step. Paths are hashes made from the parent's hash, so that deep nesting costs
no more than flat markup.

A page's text is what stands in its slots. Tags and class names only name slots: those in article elements count where
there are some, else those in the main element, else those in the container, else all; navigation, headers, footers, asides,
notices, adverts, forms, reader comments, scripts and styles are none. In an article only elements (navigation, asides, footers, forms),
hidden ones and holders of reader comments (COMMENTS) are left out, whatever other class names say. Constants of the template go, in articles too. A page of which
constants are more than MOST_CONSTANT (MOST_ELSEWHERE outside articles) is a copy of its neighbours, and keeps them.

Null or empty html, or html without text: empty text. Null url: pages of the nameless host. Pages are read whole, cut-off
markup included. Repeated rows give repeated results and count as pages of their own. Character references are decoded after the
markup is cut. Extra columns are not read, whatever their names.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import hot_join, small, stored, table

#: Share of a host's pages that a template class is on, the least pages of a host with a template, and the share of the
#: variable text that the container must hold.
SUPPORT, LEAST_PAGES, MOST_TEXT = 0.8, 4, 0.9
#: Share of the text in a page's articles, or elsewhere, from which on its constants aren't a template but a copied text.
MOST_CONSTANT, MOST_ELSEWHERE = 0.5, 0.8
#: Characters of templates that are broadcast at most; beyond that they are joined to the pages.
MOST_BROADCAST = 1 << 25

# Elements by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|textarea|iframe|svg|object|select|title"
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br math mfrac mi mn mo mroot mrow ms mspace msqrt mstyle msub msubsup msup mtext".split())
SKIPPED = frozenset("nav aside footer form head dialog menu button fieldset legend input option datalist menuitem".split())
#: Elements that can be the container, and elements that are article text whatever their class names say.
BOXES = ("html", "body", "div", "section", "main", "article", "center", "table", "layer")
PROSE = frozenset("html body p h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption dt dd br".split())
#: Class, id and role words that mark what is not the article.
NOISE = re.compile(
    r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|breadcrumbs?|sidebar|side|aside|rail|ads?|adverts?|advertisement|advertising|adsense|promo|promotion|sponsor(?:ed)?|banner|cookies?|consent|gdpr|"
    r"notice|notices|notification|alert|popup|modal|overlay|newsletter|subscribe|signup|comments?|commentlist|replies|reply|respond|disqus|discussion|share|sharing|social|related|recommended|"
    r"footer|masthead|toolbar|pagination|pager|widget|form|login|search|skip|hidden|contentinfo|complementary|copyright|legal|disclaimer)(?:$|[\s_-])",
    re.I,
)
#: Whole class names and ids of the holders of reader comments, for which HTML has no element; the only ones that count in an article.
COMMENTS = frozenset("comment comments comment-list commentlist comments-area comment-section respond disqus_thread".split())
#: Words that mark inline text as none of the article's.
INLINE_NOISE = re.compile(r"(?:^|\s)(?:ad|ads|advert|advertisement|sponsored|share|social|comments?)(?:$|\s)", re.I)
HEADER = re.compile(r"(?:^|[\s_-])(?:header|topbar|site-title|branding)(?:$|[\s_-])", re.I)

_PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(?P<raw>{RAW})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*|[^>]*)(?:>|\Z)""",
    re.S | re.I,
)
_ATTR = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_SPACES = re.compile(r"\s+")
_CLOSES = {t: frozenset(x.split()) for t, x in {"p": "p", "li": "li p", "dt": "dt dd p", "dd": "dt dd p", "tr": "tr td th p", "td": "td th p", "th": "td th p", "option": "option"}.items()}
_BARRIER = {"p": frozenset(), "li": frozenset("ul ol menu".split()), "dt": frozenset(["dl"]), "dd": frozenset(["dl"]), "tr": frozenset(["table"]), "td": frozenset(["tr", "table"]), "th": frozenset(["tr", "table"])}
_ENDS_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul p".split())


class _Element:
    __slots__ = ("tag", "path", "noise", "role", "at")

    def __init__(self, tag: str, path: int, noise: bool, role: str, at: int):
        self.tag, self.path, self.noise, self.role, self.at = tag, path, noise, role, at


class Elements:
    """The block elements of a page in order, the document itself first: hashes of their paths, parents' places, tags."""

    def __init__(self):
        self.paths, self.parents, self.tags = [0], [0], [""]

    def add(self, parent: int, tag: str, names: str) -> int:
        step = f"{tag}{'.' + '.'.join(sorted(set(names.split()))) if names else ''}"
        self.paths.append(_hash(self.paths[parent], step))
        self.parents.append(parent)
        self.tags.append(tag)
        return len(self.paths) - 1

    def nearest(self, wanted: frozenset[int]) -> list[int]:
        """For each element the place of the deepest one around it (or itself) whose path is wanted; -1 without one."""
        out = []
        for i, (path, parent) in enumerate(zip(self.paths, self.parents, strict=True)):
            out.append(i if path in wanted else out[parent] if i else -1)
        return out


_HIDES = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
_ARTICLE, _MAIN = re.compile(r"(?:^|\s)article(?:$|\s)"), re.compile(r"(?:^|\s)main(?:$|\s)")


def _attributes(attrs: str | None) -> tuple[str, bool]:
    """The class, id and role words of an element, and whether it is hidden."""
    names, gone = "", False
    for name, value in _ATTR.findall(attrs or ""):
        value, name = value.strip("\"'"), name.lower()
        if name in ("hidden", "aria-hidden"):
            gone |= value.lower() != "false"
        elif name == "style":
            gone |= bool(_HIDES.search(value))
        elif value:
            names += " " + value
    return names, gone


def _role(up: str, tag: str, names: str) -> str:
    """article; spare for an article whose names say otherwise (it counts if there is no other); main; or ''."""
    if up in ("article", "spare"):
        return up
    if tag == "article" or _ARTICLE.search(names):
        return "spare" if NOISE.search(names) else "article"
    return "main" if up == "main" or tag == "main" or _MAIN.search(names) else ""


def _is_noise(up: _Element, tag: str, names: str, role: str) -> bool:
    """Whether an element is none of the article's, by its tag or names; an outermost article or main element never is by its names."""
    if tag in SKIPPED:
        return True
    named = names and tag not in PROSE and (role == up.role or role == "")
    if up.role in ("article", "spare"):
        return bool(COMMENTS.intersection(names.lower().split())) and tag not in PROSE
    return bool(named and NOISE.search(names)) or role not in ("article", "spare") and (tag == "header" or bool(named and HEADER.search(names)))


def blocks(page: str) -> tuple[list[tuple[int, str, bool, str]], Elements]:
    """Text blocks (place of the element, text, noise, role) in page order, and the block elements."""
    stack, out, elements, text = [_Element("", 0, False, "", 0)], [], Elements(), []
    at, muted = 0, ""  # `muted`: the inline element whose text is hidden, by its tag
    depth = 0

    def flush() -> None:
        if text:
            s = _SPACES.sub(" ", entities.unescape("".join(text))).strip()
            text.clear()
            if s:
                e = stack[-1]
                out.append((e.at, s, e.noise, e.role))

    for m in _PIECE.finditer(page):
        if m.start() > at and not muted:
            text.append(page[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag, end = tag.lower(), bool(m["end"])
        if tag in INLINE:
            if tag == muted:
                depth += -1 if end else 1
                if not depth:
                    muted = ""
            elif not end and not muted and m["attrs"] and tag not in VOID:
                names, gone = _attributes(m["attrs"])
                if gone or INLINE_NOISE.search(names):
                    muted, depth = tag, 1
            if tag == "br" and not muted:
                text.append(" ")
            continue
        muted = ""  # a block element ends what inline markup hid
        names, gone = ("", False) if end else _attributes(m["attrs"])
        cell = tag in ("td", "th")
        if cell and len(stack) > 1 and stack[-1].tag not in ("td", "th") and not gone and not NOISE.search(names):
            text.append(" ")  # the cells of a row are one block
            continue
        flush()
        if end:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        closes = _CLOSES.get(tag, frozenset(["p"]) if tag in _ENDS_P else frozenset())
        if closes:
            wall = _BARRIER.get(tag, frozenset())
            for i in range(len(stack) - 1, 0, -1):
                t = stack[i].tag
                if t in closes:
                    del stack[i:]
                    break
                if t in wall or t in ("div", "article", "section", "main", "table", "body", "blockquote"):
                    break
        if tag in VOID or cell and not gone and not NOISE.search(names):
            continue
        up = stack[-1]
        role = _role(up.role, tag, names)
        noise = up.noise or gone or _is_noise(up, tag, names, role)
        at_element = elements.add(up.at, tag, names)
        stack.append(_Element(tag, elements.paths[at_element], noise, role, at_element))
    if at < len(page) and not muted:
        text.append(page[at:] if not page[at:].startswith("<") else "")
    flush()
    return out, elements


def _hash(path: int, s: str) -> int:
    """Of a path and a step, for the path of an element; of a path and \0 with a text, for a token."""
    import xxhash

    return xxhash.xxh64_intdigest(path.to_bytes(8, "little", signed=True) + s.encode("utf-8", "replace")) - (1 << 63)


def token(path: int, text: str) -> int:
    return _hash(path, f"\0{text}")


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each page's tokens with their counts and the place of the first; text blocks outside noise only.

    The characters of the document's own token say whether it has an article or main element.
    """
    names = ["host", "token", "path", "is_text", "chars", "page", "n", "at"]
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
    for batch in batches:
        rows: list[tuple] = []
        for host, page, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            found, elements = blocks(body or "")
            seen: dict[tuple[int, str], list] = {(0, ""): [0, int(any(role for _, _, noise, role in found if not noise))]}
            for p in elements.paths:
                seen.setdefault((p, ""), [0, 0])[0] += 1
            for e, s, noise, _ in found:
                if not noise:
                    x = seen.setdefault((elements.paths[e], s), [0, 0])
                    x[0] += 1
                    x[1] += len(s)
            rows += [(host, token(p, s), p, bool(s), c, page, n, i) for i, ((p, s), (n, c)) in enumerate(seen.items())]
            if len(rows) > 50_000:
                yield _batch(rows, names, kinds)
                rows = []
        yield _batch(rows, names, kinds)


def _batch(rows: list[tuple], names: list[str], kinds: tuple) -> pa.RecordBatch:
    cols = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)


def _sums(batches: Iterator[pa.RecordBatch], template_of) -> Iterator[pa.RecordBatch]:
    """(host, path, depth, box, slot, chars) of the template elements of each page: the variable text within, and whether some lies right there.

    The document itself (path 0) stands for all of the page's variable text.
    """
    names, kinds = ["host", "path", "depth", "box", "slot", "chars"], (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.int64())
    for batch in batches:
        rows: dict[tuple, list] = {}
        for host, body, template in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), template_of(batch), strict=True):
            found, elements = blocks(body or "")
            within, right = [0] * len(elements.paths), set()
            near = elements.nearest(template.nodes)
            for e, s, noise, _ in found:
                if not noise and token(elements.paths[e], s) not in template.constants:
                    within[e] += len(s)
                    right.add(near[e])
            for i in range(len(within) - 1, 0, -1):
                within[elements.parents[i]] += within[i]
            depth = [0] * len(within)
            for i in range(len(within)):
                depth[i] = depth[elements.parents[i]] + 1 if i else 0
                if within[i] and (not i or elements.paths[i] in template.nodes):
                    x = rows.setdefault((host, elements.paths[i], depth[i], elements.tags[i] in BOXES), [False, 0])
                    x[0] |= i in right
                    x[1] += within[i]
        yield _batch([(*k, *v) for k, v in rows.items()], names, kinds)


@dataclass(frozen=True)
class Template:
    """What extraction needs of a host's template: hashes of constants, paths of its elements, of the slots and their container."""

    constants: frozenset[int] = frozenset()
    nodes: frozenset[int] = frozenset()
    slots: frozenset[int] = frozenset()
    container: int | None = None

    @staticmethod
    def of(constants, nodes, slots=None, container=None) -> Template:
        return Template(frozenset(constants or ()), frozenset(nodes or ()), frozenset(slots or ()), container)

    def holds(self, elements: Elements) -> list[bool]:
        """Whether a slot of the template is around each element, inside the container."""
        slot, inside = elements.nearest(self.slots), elements.nearest(frozenset(() if self.container is None else (self.container,)))
        return [a >= 0 and b >= 0 for a, b in zip(slot, inside, strict=True)]


NO_TEMPLATE = Template()
_PARTS = ("constants", "nodes", "slots", "container")


def _with_templates(rows: DataFrame, learnt: DataFrame):
    """(rows, a function of their batches that gives each row's template): sent to the tasks up to MOST_BROADCAST characters, else joined."""
    parts = [c for c in _PARTS if c in learnt.columns]
    numbers = sum((F.coalesce(F.size(c), F.lit(0)) for c in parts if c != "container"), F.lit(0))
    if (learnt.agg(F.sum(numbers * 20 + F.length("host")).alias("n")).first()["n"] or 0) <= MOST_BROADCAST:
        known = rows.sparkSession.sparkContext.broadcast({r["host"]: Template.of(*(r[c] for c in parts)) for r in learnt.collect()})  # MOST_BROADCAST characters at most
        return rows, lambda batch: (known.value.get(h, NO_TEMPLATE) for h in batch.column("host").to_pylist())
    return hot_join(rows, learnt, "host", "left"), lambda batch: (Template.of(*x) for x in zip(*(batch.column(c).to_pylist() for c in parts), strict=True))


def templates(pages: DataFrame) -> DataFrame:
    """(host, constants, nodes, slots, container): hashes of the host's constant text blocks, paths of its template's elements and slots, and that of their container.

    `pages` has host, page (a number of the page's own) and html.
    """
    tokens = stored(pages.select("host", "page", "html").mapInArrow(_tokens, "host string, token long, path long, is_text boolean, chars long, page long, n int, at int"))
    h = F.xxhash64("page", "n")
    vectors = stored(
        tokens.groupBy("host", "token").agg(
            F.struct(F.bit_xor(h).alias("x"), F.sum(h.bitwiseAND(F.lit((1 << 31) - 1))).alias("s")).alias("vector"),
            F.count("*").alias("pages"), F.first("path").alias("path"), F.first("is_text").alias("is_text"),
        )
    )
    hosts = small(stored(vectors.where("path = 0 and not is_text").select("host", F.col("pages").alias("all_pages"))))
    frequent = vectors.join(hosts, "host").where((F.col("pages") >= SUPPORT * F.col("all_pages")) & (F.col("all_pages") >= LEAST_PAGES))
    large = stored(frequent.groupBy("host", "vector").agg(F.count("*").alias("size")).where("size > 1"))
    members = stored(frequent.where("path <> 0").join(small(large.select("host", "vector")), ["host", "vector"], "left_semi").select("host", "vector", "token", "path", "is_text"))
    # ordered: on each page the same sequence of tokens
    placed = tokens.select("host", "token", "page", "at").join(small(members.select("host", "token", "vector")), ["host", "token"])
    orders = placed.groupBy("host", "vector", "page").agg(F.xxhash64(F.transform(F.array_sort(F.collect_set(F.struct("at", "token"))), lambda x: x["token"])).alias("o"))
    valid = stored(orders.groupBy("host", "vector").agg(F.min("o").alias("a"), F.max("o").alias("b")).where("a = b").select("host", "vector"))
    template = members.join(small(valid), ["host", "vector"], "left_semi")
    known = stored(template.groupBy("host").agg(F.sort_array(F.collect_set(F.when(F.col("is_text"), F.col("token")))).alias("constants"), F.sort_array(F.collect_set(F.when(~F.col("is_text"), F.col("path")))).alias("nodes")))
    # variable text within the template's elements, on the pages that name no article; the deepest around a text is its slot
    bare = stored(tokens.where("path = 0 and not is_text and chars = 0").select("host", "page").distinct().join(small(known.select("host")), "host", "left_semi"))
    rows, template_of = _with_templates(pages.join(small(bare), ["host", "page"], "left_semi").select("host", "html"), known)
    sums = rows.mapInArrow(lambda b: _sums(b, template_of), "host string, path long, depth int, box boolean, slot boolean, chars long")
    sums = stored(sums.groupBy("host", "path").agg(F.max("depth").alias("depth"), F.bool_or("box").alias("box"), F.bool_or("slot").alias("slot"), F.sum("chars").alias("chars")))
    slots = sums.where("slot and path <> 0").groupBy("host").agg(F.sort_array(F.collect_set("path")).alias("slots"))
    whole = small(stored(sums.where("path = 0").select("host", F.col("chars").alias("whole"))))
    held = sums.where("box and path <> 0").join(whole, "host").where(F.col("chars") >= MOST_TEXT * F.col("whole"))
    container = held.groupBy("host").agg(F.max_by("path", "depth").alias("container"))
    return stored(known.join(slots, "host", "left").join(container, "host", "left").select("host", *_PARTS))


def page_text(page: str | None, template: Template = NO_TEMPLATE) -> str:
    """The text in a page's slots."""
    found, elements = blocks(page or "")
    clean = [(e, s, role) for e, s, noise, role in found if not noise]
    roles = {role for _, _, role in clean}
    wanted = next((x for x in ("article", "spare", "main") if x in roles), "")
    clean = [(e, s) for e, s, role in clean if not wanted or role == wanted]
    if template.constants:
        slots = [(e, s) for e, s in clean if token(elements.paths[e], s) not in template.constants]
        most = MOST_CONSTANT if wanted in ("article", "spare") else MOST_ELSEWHERE
        whole = sum(len(s) for _, s in clean)
        if whole - sum(len(s) for _, s in slots) <= most * whole:
            clean = slots
    if not wanted and template.slots:
        holds = template.holds(elements)
        clean = [(e, s) for e, s in clean if holds[e]] or clean
    return "\n\n".join(s for _, s in clean)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for rows of (page_id, url, html)."""
    url, html = F.coalesce(F.col("url").cast("string"), F.lit("")), F.col("html").cast("string")
    rows = pages.select("page_id", "url", F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)).alias("host"), html.alias("html"))
    learnt = templates(rows.select("host", F.xxhash64("page_id", "url", "html").alias("page"), "html"))
    spark, kinds = pages.sparkSession, "page_id long, url string, text string, n_chars long"
    rows = rows.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html", "host")
    joined, template_of = _with_templates(rows, learnt)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [page_text(body, t) for body, t in zip(batch.column("html").to_pylist(), template_of(batch), strict=True)]
            n = pa.array(np.array([len(s) for s in text], np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()), n], names=["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, kinds)


def op2_main_text(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
