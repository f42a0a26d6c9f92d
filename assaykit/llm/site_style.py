"""Main text of web pages by site style trees.

The pages of a host are merged into one tree of presentation styles: a node is the path of
block elements from the body, each with its tag and classes. A node's importance joins the
entropy of its presentations over the host's pages with that of its contents: what looks and
reads alike on all pages is noise. Only (host, node, feature) counts travel; a host's
pages are never brought together. The tree is built from whole pages; names only lower a node's
importance in it. Branches of low importance are removed from each page, and blocks of important
nodes are kept. What the tree leaves open, as too few pages have it, is decided by names and by
article and main.
"""

from __future__ import annotations

import html as entities
import re

from pyspark.sql import DataFrame, functions as F

from .arrays import chunked
from .tables import small_enough, stored
from .token_counts import rows_batch

#: Pages of different content that a node needs before its entropy says anything.
LEAST_PAGES = 8
LOW_IMPORTANCE = 0.2
#: Share of the contents, against the presentations, in a node's importance.
CONTENT_SHARE = 0.9
#: What is left of the importance of a node named as noise, and of one with a word of such names.
NAMED, HINTED = 0.15, 0.5
#: Weight of text in article or main against other text that the tree leaves open.
MAIN_WEIGHT = 4
BROADCAST_HOSTS = 100_000

BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
    "optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements of which nothing is text of the page.
SILENT = set(
    "audio button canvas datalist embed head iframe input map meter noframes noscript object picture "
    "progress script select style svg template textarea title video".split())
#: What may stand in a head; anything else ends it, as its closing tag may be left out.
IN_HEAD = set("base head html link meta noframes noscript script style template title".split())
#: Silent elements that no closing tag of an outer element ends.
SEALED = set("object select svg template".split())
RAW = set("script style textarea title noframes iframe xmp".split())
NOISE_TAGS = set("aside dialog footer form menu nav search".split())
NOISE_ROLES = set(
    "alert alertdialog banner comment complementary contentinfo dialog form menu menubar navigation search "
    "toolbar".split())
#: Whole class names or ids. Those that also name ordinary content are not among them.
NOISE_WORDS = set(
    "ad ads adbox adslot advert advertisement advertising adverts aside banner breadcrumb "
    "breadcrumbs comment comments consent cookie cookies copyright dialog disqus footer form "
    "gdpr login masthead menu modal nav navbar navigation newsletter "
    "outbrain pager pagination paywall popup promo promoted promotion sidebar signup "
    "sponsor sponsored subscribe subscription taboola toolbar topbar".split())
#: Words in class names and ids that make noise more likely.
HINT_WORDS = NOISE_WORDS | set(
    "alert discussion legal notice notices notification recommended related replies reply respond "
    "search share sharing social widget widgets".split())
#: Names of containers of reader comments; commentary is none.
COMMENTS = re.compile(r"(?<![a-z])comments?(?![a-z])|comments$|(?<![a-z])commentlist")
#: Words before a noise word that only say where on the page it is, as in site-footer.
PLACES = set("bottom global left main mobile page primary right secondary site top".split())
#: Words that make a name a state of its element, as in no-sidebar or comments-open.
STATES = set("allow closed disabled enabled has hidden hide no off on open with without".split())
MAIN_TAGS = ("article", "main")
#: Elements that hold the page or its text, whatever their names say.
UNNAMED = {"html", "body", *MAIN_TAGS}
#: An element of the key ends the open elements of the value, up to the nearest one of the third.
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.DOTALL)
ATTRIBUTE = re.compile(r"(?<![^\s\"'/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORD = re.compile(r"[a-z]+")

_NODES = "host string, node long, content long, style long, page long, weight double"
_TEXTS = "page_id long, url string, text string, n_chars long"


class Element:
    __slots__ = ("tag", "path", "noise", "main", "kids")

    def __init__(self, tag: str, path: str, noise: bool, main: str):
        self.tag, self.path, self.noise, self.main, self.kids = tag, path, noise, main, []


def names_noise(name: str) -> bool:
    """Whether a class name or id is a noise word, one at a place of the page, or says comments."""
    if name in NOISE_WORDS:
        return True
    *before, last = WORD.findall(name) or [""]
    if STATES.intersection(before) or last in STATES:
        return False
    return bool(COMMENTS.search(name)) or bool(before) and last in NOISE_WORDS and PLACES.issuperset(before)


def opened(parent: Element, tag: str, attributes: str) -> Element:
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)} \
        if attributes else {}
    classes = found.get("class", "").lower()
    names = set() if tag in UNNAMED else {*classes.split(), found.get("id", "").lower()}
    inside = parent.main
    named = tag in NOISE_TAGS or any(names_noise(name) for name in names) \
        or (found.get("role", "").lower() in NOISE_ROLES and tag not in UNNAMED)
    if (tag == "header" or "header" in names) and not inside:
        named = True
    noise = parent.noise or named
    main = tag if tag in MAIN_TAGS else "main" if found.get("role", "").lower() == "main" else ""
    if inside == "article" or not main or noise:
        main = inside
    hinted = any(HINT_WORDS.intersection(WORD.findall(name)) for name in names)
    style = ".".join([tag, *sorted(set(WORD.findall(classes)))]) + ("!" if named else "?" if hinted else "")
    return Element(tag, f"{parent.path}/{style}", noise, main)


def blocks_of(page: str):
    """The page's text blocks in order, as (element, text), and its block elements in order."""
    root = Element("", "", False, "")
    stack, elements, blocks, words = [root], [root], [], []
    at = 0
    # The open silent element and the silent elements and blocks that are open inside it.
    silent: list[str] = []

    def flush():
        text = " ".join("".join(words).split())
        words.clear()
        if text:
            blocks.append((stack[-1], text))

    def close(depth: int):
        flush()
        del stack[depth:]

    while at < len(page):
        m = TOKEN.search(page, at)
        piece = page[at : m.start() if m else len(page)]
        if silent == ["head"] and piece.strip():
            silent.clear()
        if not silent:
            if piece:
                words.append(entities.unescape(piece) if "&" in piece else piece)
        if not m:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing, attributes = m[1] or m[4], m[3] or m[6] or ""
        if silent == ["head"] and not closing and tag not in IN_HEAD:
            silent.clear()
        if tag in RAW and not closing:
            end = re.compile(rf"</{tag}\b[^>]*>|\Z", re.I).search(page, at)
            at = end.end()
            if tag in SILENT or silent:
                words.append(" ")
                continue
        if silent and tag == "body" and not closing:
            silent.clear()
        if closing and tag in silent:
            while silent.pop() != tag:
                pass
            continue
        if tag in SILENT and tag not in VOID:
            if not closing and not attributes.endswith("/") and not (silent and tag == "head"):
                silent.append(tag)
            continue
        if silent:
            if not closing:
                if tag in BLOCKS and tag not in VOID and not attributes.endswith("/"):
                    silent.append(tag)
                continue
            if SEALED.intersection(silent) or tag == "p" or all(e.tag != tag for e in stack):
                continue
            silent.clear()
        if tag == "br":
            words.append(" ")
        if tag not in BLOCKS:
            continue
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    close(depth)
                    break
            else:
                flush()
            continue
        flush()
        if stack[-1].tag == "p":
            close(len(stack) - 1)
        ends, upto = IMPLIED_END.get(tag, (set(), set()))
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in upto:
                break
            if stack[depth].tag in ends:
                close(depth)
        if tag == "hr":
            continue
        element = opened(stack[-1], tag, attributes)
        stack[-1].kids.append(element.path.rpartition("/")[2])
        stack.append(element)
        elements.append(element)
    flush()
    return blocks, elements


def code(text: str) -> int:
    """A 64-bit number of a text."""
    import hashlib

    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def size(blocks) -> int:
    return sum(len(text) for _, text in blocks)


def kept_blocks(blocks, important=frozenset()) -> list:
    """The blocks that no noise style hides, or all if it hides every one. Text in article or main
    weighs more than other text: unless that outweighs it, only it and what lies on important paths
    is kept."""
    left = [b for b in blocks if not b[0].noise] or blocks
    inside = [b for b in left if b[0].main]
    if inside and MAIN_WEIGHT * size(inside) >= size(left) - size(inside):
        return [b for b in left if b[0].main or b[0].path in important]
    return left


def style_nodes(batches):
    """Per page and node that holds text: hashes of the node, its content and its presentation."""
    for batch in chunked(batches, "html"):
        rows = []
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            blocks, elements = blocks_of(page or "")
            under: dict[str, list[str]] = {}
            for element, text in blocks:
                path = element.path
                while path:
                    under.setdefault(path, []).append(text)
                    path = path.rpartition("/")[0]
            looks: dict[str, list[str]] = {}
            for element in elements:
                if element.path in under:
                    looks.setdefault(element.path, []).append(">".join(dict.fromkeys(element.kids)))
            # Pages that differ in noise alone count once in the nodes of their text.
            whole = code("\n".join(text for _, text in kept_blocks(blocks)))
            for path, texts in under.items():
                look = "|".join(dict.fromkeys(looks.get(path, ())))
                weight = NAMED if "!" in path else HINTED if "?" in path else 1.0
                rows.append((host, code(path), code("\n".join(texts)), code(look), whole, weight))
        yield rows_batch(rows, _NODES)


def judged_nodes(pages: DataFrame) -> DataFrame:
    """(host, node, low, alike) of nodes on enough of the host's pages: whether its importance is
    low, and whether it is so without regard to names, as it looks and reads alike on the pages.

    Pages of one content count once. With m pages, a content found on c of them has the entropy
    log c / log m; the contents' mean taken from 1 is the content's importance. The entropy of
    the presentations, to the base m, is the presentation's.
    """
    seen = stored(pages.mapInArrow(style_nodes, _NODES).distinct())
    per = ["host", "node"]
    pages_of = seen.groupBy(*per).agg(F.count("*").alias("m"), F.min("weight").alias("weight")).where(F.col("m") >= LEAST_PAGES)
    contents = seen.groupBy(*per, "content").agg(F.count("*").alias("c")).groupBy(*per).agg(
        F.avg(F.log("c")).alias("spread"))
    styles = seen.groupBy(*per, "style").agg(F.count("*").alias("c")).groupBy(*per).agg(
        F.sum(F.col("c") * F.log("c")).alias("bound"))
    both = pages_of.join(contents, per).join(styles, per)
    content = 1 - F.col("spread") / F.log("m")
    style = 1 - F.col("bound") / (F.col("m") * F.log("m"))
    importance = CONTENT_SHARE * content + (1 - CONTENT_SHARE) * style
    return both.select(*per, (importance * F.col("weight") < LOW_IMPORTANCE).alias("low"),
                       (importance < LOW_IMPORTANCE).alias("alike"))


def without_branches(blocks, low: set[int]) -> list:
    """The blocks that lie in none of the branches."""
    known: dict[str, bool] = {}

    def dull(path: str) -> bool:
        if path not in known:
            known[path] = bool(path) and (code(path) in low or dull(path.rpartition("/")[0]))
        return known[path]

    return [b for b in blocks if not dull(b[0].path)]


def page_texts(batches):
    for batch in chunked(batches, "html"):
        rows = []
        for page_id, url, page, nodes in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3)):
            blocks = blocks_of(page or "")[0]
            important = frozenset()
            judged = nodes.as_py()
            if judged:
                left = without_branches(blocks, {r["node"] for r in judged if r["low"]})
                # Names alone leave no page without a text.
                blocks = left or without_branches(blocks, {r["node"] for r in judged if r["alike"]})
                high = {r["node"] for r in judged if not r["low"]}
                important = {path for path in {b[0].path for b in blocks} if code(path) in high}
            text = "\n\n".join(text for _, text in kept_blocks(blocks, important))
            rows.append((page_id, url, text, len(text)))
        yield rows_batch(rows, _TEXTS)


def main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per input row: page_id, url, text, n_chars (code points).

    Blocks of the main text are joined by an empty line; white space inside a block is one
    space; character references are decoded. Null or empty html gives an empty text; pages with a
    null url count as one host. Repeated rows give repeated rows, and count once in the tree. An
    empty table gives no rows; other columns are not read.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[^/?#]*//([^/?#]*)", 1))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.col(html_col).alias("html"), host.alias("host"))
    judged = stored(judged_nodes(rows.select("host", "html")))
    lists = stored(judged.groupBy("host").agg(
        F.collect_list(F.struct("node", "low", "alike")).alias("judged")))
    if small_enough(judged, BROADCAST_HOSTS):
        lists = F.broadcast(lists)
    return rows.join(lists, "host", "left").select("page_id", "url", "html", "judged").mapInArrow(
        page_texts, _TEXTS)
