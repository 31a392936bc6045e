"""HTML extraction by equivalence-class template deduction.

A page is cut into tokens: its tags, told apart by the path of elements around them, and pieces of text (a
block's, from one block-level tag or line break to the next), told apart by path and hash.
For every host, a token's occurrence vector says how often it stands on each of the host's distinct pages.
Tokens that share a vector form an equivalence class.  A class is valid if it has two tokens at least (an element is
two, its start and its end) and these stand once on nearly all of the host's pages.  An element nests if the elements
around it belong to valid classes too; these elements and the text of valid classes are the host's template.  What lies
between template tokens is a slot.  The element of the template that holds most of the text in slots is the article,
and every page gives the slots inside it, without those in menus, forms, notices and the like.  Text in such elements
is never given, so it makes no tokens.

The vectors are never gathered: a vector's signature is the sum over pages of a hash of (page, count), a decimal of 38
digits that no number of pages fills.  So classes come from one aggregate by (host, token), combined before the
shuffle, whatever the size of a host.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Container, Iterable, Iterator

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, stage

#: Share of a host's distinct pages that have a template token at least.
SUPPORT = 0.7
#: Distinct pages that have a template's piece of text at least; what one or two pages say is never taken for template.
TEXT_PAGES = 3
#: Characters of class names that stand in a path as they are.
NAME_CHARS = 64
#: Tokens of an equivalence class at least.
CLASS_TOKENS = 2
#: Share of the text in slots that the article element holds at least (an element that calls itself one: half of this).
MAIN_SHARE = 0.6

# Element names and roles of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title svg math iframe object canvas".split())
BLOCKS = frozenset("""address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre
    section select summary table tbody td tfoot th thead title tr ul""".split())
ASIDE = frozenset("""nav header footer aside form menu dialog button select head script style noscript template
    textarea title svg math iframe object canvas""".split())
ASIDE_WORDS = frozenset("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments
    consent cookie cookies disqus footer footnotes form header masthead menu modal nav navbar navigation newsletter notice
    notices popup promo promoted promotion related replies responses share sharing sidebar social sponsor sponsored
    subscribe toolbar widget""".split())
ASIDE_PLACES = frozenset("""area bar block bottom box buttons container fixed global icons inner inline item items left links list
    main outer page posts primary right secondary section site sticky top wrap wrapper""".split())
ARTICLE_WORDS = frozenset("article content entry main post story".split())
ASIDE_ROLES = frozenset("banner navigation complementary contentinfo search form dialog alert alertdialog menu menubar".split())
LEAVES = frozenset("""address blockquote caption dd dl dt figcaption h1 h2 h3 h4 h5 h6 hgroup legend li ol option p pre
    summary table tbody td tfoot th thead tr ul""".split())
CLOSES_P = BLOCKS - frozenset("br body html head title caption tbody td tfoot th thead tr option".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                  r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
                  r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=\s|/|$)""", re.I)
_WORDS = re.compile(r"[A-Za-z]+")
_SPACE = re.compile(r"\s+")


def _attributes(source: str) -> dict[str, str]:
    if not source or source.isspace():
        return {}
    return {m[1].lower(): next((g for g in m.groups()[1:] if g is not None), "") for m in _ATTRIBUTE.finditer(source)}


def _label(tag: str, attributes: dict[str, str]) -> tuple[str, bool, bool]:
    """An element's name in paths, whether it stands apart from an article, and whether it calls itself one."""
    names = [_WORDS.findall(n.lower()) for k in ("class", "id") for n in attributes.get(k, "").split()]
    named = [w for words in names for w in words]
    role = attributes.get("role", "").lower()
    article = tag in ("article", "main") or role in ("article", "main") or (
        tag in ("div", "section") and bool(ARTICLE_WORDS.intersection(named)))
    apart = (tag in ASIDE or role in ASIDE_ROLES or "hidden" in attributes
             or attributes.get("aria-hidden", "").lower() == "true"
             or (tag not in ("html", "body", "article", "main") and any(map(_says_aside, names))))
    return _name(tag, attributes.get("class", "")), apart, article and not apart


def _says_aside(words: list[str]) -> bool:
    """Whether a class or id says nothing but that an element stands apart: "cookie-notice" does, "header-files" doesn't."""
    return bool(ASIDE_WORDS.intersection(words)) and ASIDE_PLACES.issuperset(w for w in words if w not in ASIDE_WORDS)


def _name(tag: str, classes: str) -> str:
    """The tag and all class names of an element; the separators "." and "/" are escaped in these.

    Long names give way to their hash, behind a space, which no class name has.
    """
    if not classes:
        return tag
    name = "".join("." + w.replace("%", "%25").replace("/", "%2F").replace(".", "%2E") for w in sorted(set(classes.split())))
    if len(name) > NAME_CHARS:
        name = f". {xxhash.xxh3_128_hexdigest(name.encode('utf-8', 'replace'))}"
    return tag + name


def walk(source: str):
    """Events of a page: (kind, path, apart, article, text, in a link).

    Kinds are "open" (a block-level element, the last of ``path``, begins), "break" (one ends, or a line does) and
    "text".  ``path`` is the tuple of block-level elements around the event.  Unclosed elements end with
    the one around them, and a paragraph at the next block.
    """
    stack: list[tuple[str, str, bool, bool]] = []  # tag, name, apart, block
    path: tuple[str, ...] = ()
    apart = links = 0
    at, n = 0, len(source)

    def pop() -> None:
        nonlocal path, apart, links
        tag, _, aside, block = stack.pop()
        apart -= aside
        links -= tag == "a"
        if block:
            path = path[:-1]

    for m in _TAG.finditer(source):
        if m.start() < at:
            continue  # inside raw text
        if m.start() > at:
            yield "text", path, apart > 0, False, source[at:m.start()], links > 0
        at = m.end()
        end_tag, tag, inner = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if tag is None:
            if m[0].startswith("<![CDATA["):
                yield "text", path, apart > 0, False, m[0][9:].removesuffix("]]>"), links > 0
            continue
        tag = tag.lower()
        block = tag in BLOCKS
        if end_tag:
            if block:
                yield "break", path, apart > 0, False, "", False
            # An end tag closes the nearest open element of its name, not across a table cell or an article's edge.
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if depth is not None and (block or not any(e[3] and e[0] != "p" for e in stack[depth + 1:])):
                while len(stack) > depth:
                    pop()
            continue
        attributes = _attributes(inner)
        if tag in CLOSES_P:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][3]), None)
            if depth is not None and stack[depth][0] == "p":
                while len(stack) > depth:
                    pop()
        if tag in ("li", "option", "dt", "dd", "tr", "td", "th"):
            peers = {"li": {"li"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
                     "td": {"td", "th"}, "th": {"td", "th"}}[tag]
            edge = {"li": {"ul", "ol", "menu"}, "option": {"select"}, "dt": {"dl"}, "dd": {"dl"}}.get(tag, {"table", "tbody"})
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in peers | edge), None)
            if depth is not None and stack[depth][0] in peers:
                while len(stack) > depth:
                    pop()
        name, aside, article = _label(tag, attributes)
        if tag in VOID:
            if block:
                yield "break", path, apart > 0, False, "", False
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
            at = end.end() if end else n
            continue
        stack.append((tag, name, aside, block))
        apart += aside
        links += tag == "a"
        if block:
            path = path + (name,)
            yield "open", path, apart > 0, article, "", False
    if at < n:
        rest = source[at:]
        yield "text", path, apart > 0, False, rest, links > 0


def pieces(events: list) -> Iterator[list[tuple[tuple[str, ...], str, bool]]]:
    """Texts (path, text, in a link) of each block of a page, without what stands apart."""
    current = []
    for event, path, apart, _, text, link in events:
        if event == "text":
            if not apart:
                current.append((path, text, link))
        elif current:
            yield current
            current = []
    if current:
        yield current


def _plain(texts: Iterable[str]) -> str:
    return _SPACE.sub(" ", html.unescape("".join(texts))).strip()


def piece_hash(path: tuple[str, ...], plain: str) -> int:
    """Hash of a piece of text and the elements around it, as a signed long."""
    return xxhash.xxh64_intdigest("\n".join(("/".join(path), plain)).encode("utf-8", "replace"), 9) - (1 << 63)


def tokens(source: str) -> list[tuple[str, int | None, int, int, bool, bool]]:
    """Distinct tokens of a page: (path, hash of a piece of text or None, occurrences, characters, barred, article).

    An element has the characters of article text under it.  They count under every path around them (the whole page's
    path is empty), but not inside links or elements that stand apart.  Elements that stand apart, and single blocks of
    text, are barred from being the article.  A piece of text has its own characters, none inside links; pieces in
    elements that stand apart are left out.
    """
    seen: Counter[tuple[str, ...]] = Counter({(): 1})
    chars: Counter[tuple[str, ...]] = Counter()
    kind: dict[tuple[str, ...], tuple[bool, bool]] = {}
    texts: dict[tuple[tuple[str, ...], int], list[int]] = {}
    events = list(walk(source))
    for event, path, apart, article, _, _ in events:
        if event == "open":
            seen[path] += 1
            was = kind.get(path, (path[-1].partition(".")[0] in LEAVES, False))
            kind[path] = (was[0] or apart, was[1] or article)
    for piece in pieces(events):
        own = 0
        for path, text, link in piece:
            size = 0 if link else len(_SPACE.sub(" ", text).strip())
            if size:
                own += size
                for i in range(len(path) + 1):
                    chars[path[:i]] += size
        plain, path = _plain(text for _, text, _ in piece), piece[0][0]
        if plain:
            count = texts.setdefault((path, piece_hash(path, plain)), [0, 0])
            count[0] += 1
            count[1] += own
    named: dict[tuple[str, ...], str] = {p: "/".join(p) for p in seen}
    return ([(named[p], None, k, chars[p], *kind.get(p, (False, False))) for p, k in seen.items()]
            + [(named[p], h, k, c, False, False) for (p, h), (k, c) in texts.items()])


def main_text(source: str, main: str | None, fixed: Container[int] = ()) -> str:
    """Blocks of the page's article, joined by line feeds.

    ``main`` is the path of the article in the host's template; a page without it uses its own best
    element.  ``fixed`` has the hashes of the template's pieces of text, which are left out.  White space in
    a block becomes one space, and character references are decoded.
    """
    events = list(walk(source))
    if main is None or main and not any(e == "open" and "/".join(p) == main for e, p, *_ in events):
        main = own_main(tokens(source))
    root = tuple(main.split("/")) if main else ()
    blocks = []
    for piece in pieces(events):
        block = _plain(text for path, text, _ in piece if path[:len(root)] == root)
        if block and not (fixed and piece_hash(piece[0][0], block) in fixed):
            blocks.append(block)
    return "\n".join(blocks)


def own_main(found: list[tuple[str, int | None, int, int, bool, bool]]) -> str:
    """The article path by one page alone: the largest that calls itself one, or else the deepest with most of the text."""
    usable = [(p, k, c, article) for p, piece, k, c, barred, article in found if piece is None and not barred and c]
    if not usable:
        return ""
    most = max(c for _, _, c, _ in usable)
    named = [x for x in usable if x[3] and x[2] >= MAIN_SHARE / 2 * most]
    large = named or [x for x in usable if x[2] >= MAIN_SHARE * most]
    return max(large, key=lambda x: (x[2] if named else 0, x[0].count("/"), x[0]))[0]


def host_of(url):
    """Host of a url column, lower-cased; empty without one."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def _vector(page: int, count: int) -> int:
    """Hash of a page's entry in an occurrence vector, of 63 bits."""
    return xxhash.xxh64_intdigest(count.to_bytes(4, "little"), page) >> 1


def distinct_pages(pages: DataFrame) -> DataFrame:
    """``host``, ``html``: one row for each host and html.

    Hashes are counted first; only pages that recur on their host are then sorted and reduced, before and after the shuffle.
    """
    rows = pages.withColumn("hash", F.md5("html"))
    copied = stage(rows.groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("host", "hash"),
                   "html-copied")
    alone = rows.join(copied, ["host", "hash"], "left_anti")
    again = rows.join(copied, ["host", "hash"], "left_semi").dropDuplicates(["host", "hash"])
    return alone.select("host", "html").unionByName(again.select("host", "html"))


def templates(pages: DataFrame) -> DataFrame:
    """``host``, ``main``, ``template``, ``fixed``: each host's article path, and the paths of its template and its pieces
    of text (path, piece, chars).

    ``pages`` has host and html (bytes).
    """
    def run(batch):
        out = {k: [] for k in ("host", "path", "piece", "count", "chars", "barred", "article", "vector")}
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            page = xxhash.xxh64_intdigest(source, 3)
            for token in tokens(source.decode("utf-8", "replace")):
                for k, v in zip(out, (host, *token, _vector(page, token[2]))):
                    out[k].append(v)
        yield out

    found = map_arrow(distinct_pages(pages.select("host", "html")), run, "host string, path string, piece long, count int, "
                                                         "chars long, barred boolean, article boolean, vector long")
    token = found.groupBy("host", "path", "piece").agg(
        F.count(F.lit(1)).alias("pages"), F.count_if(F.col("count") == 1).alias("once"), F.sum("chars").alias("chars"),
        F.bool_or("barred").alias("barred"), F.bool_or("article").alias("article"),
        F.sum(F.col("vector").cast("decimal(28,0)")).alias("vector"))
    token = stage(token.where(F.col("piece").isNull() | (F.col("once") >= TEXT_PAGES)), "html-tokens")
    hosts = token.groupBy("host").agg(F.max("pages").alias("n"))
    token = token.join(hosts, "host").where(F.col("pages") >= SUPPORT * F.col("n"))
    # Equivalence classes: tokens of one host whose vectors are the same.
    classes = (token.groupBy("host", "vector")
               .agg(F.min("once").alias("once"), F.min("n").alias("n"),
                    F.sum(F.when(F.col("piece").isNull(), 2).otherwise(1)).alias("size")))
    valid = (classes.where(F.col("once") >= SUPPORT * F.col("n")).where(F.col("size") >= CLASS_TOKENS)
             .select("host", "vector"))
    # Nesting: all elements around an element must be of valid classes.  A host has few valid tokens, as each stands once
    # on most of its pages.
    def around(path):
        steps = F.split(path, "/")
        return F.transform(F.sequence(F.lit(1), F.size(steps)), lambda i: F.array_join(F.slice(steps, 1, i), "/"))

    element, text = F.col("piece").isNull(), F.struct("path", "piece", "chars")
    template = token.join(valid, ["host", "vector"]).groupBy("host").agg(
        F.collect_set(F.when(element, F.col("path"))).alias("valid"),
        F.collect_list(F.when(~element, text)).alias("fixed")).select(
        "host", F.filter("valid", lambda p: F.forall(around(p), lambda q: F.array_contains("valid", q))).alias("template"),
        "fixed")
    template = stage(template, "html-nested")
    # Text in slots: an element's text but for the template's pieces in it.
    inside = F.expr("""aggregate(filter(fixed, f -> path = '' or f.path = path or startswith(f.path, concat(path, '/'))),
                                 0L, (a, f) -> a + f.chars)""")
    slots = (token.where(element).join(template, "host").where(F.expr("array_contains(template, path)"))
             .withColumn("chars", F.col("chars") - inside)
             .where("not barred and chars > 0").drop("template", "fixed"))
    most = slots.groupBy("host").agg(F.max("chars").alias("most"))
    rated = slots.join(most, "host").withColumn(
        "rank", F.when(F.col("article") & (F.col("chars") >= MAIN_SHARE / 2 * F.col("most")),
                       F.struct(F.lit(2).alias("k"), F.col("chars").alias("c"), F.length("path").alias("d"), "path"))
        .when(F.col("chars") >= MAIN_SHARE * F.col("most"),
              F.struct(F.lit(1).alias("k"), F.lit(0).cast("long").alias("c"), F.length("path").alias("d"), "path")))
    best = rated.where("rank is not null").groupBy("host").agg(F.max("rank").alias("rank"))
    return stage(template.join(best.select("host", F.col("rank.path").alias("main")), "host", "left"), "html-templates")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: ``page_id``, ``url``, ``text`` (the article's, empty if none), ``n_chars``.

    A null html is empty; a null url, or one without a host, makes pages of the host "".  Hosts of few pages
    have a template as well; a page that doesn't fit its host's is judged by itself.  Repeated rows stay
    repeated, other columns are ignored, and an empty table gives no rows.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host"),
                        F.coalesce(F.col(html_col).cast("string").cast("binary"), F.lit(b"")).alias("html"))
    found = templates(rows.select("host", "html"))

    def run(batch):
        texts = [main_text(h.decode("utf-8", "replace"), m, frozenset(fixed or ()))
                 for h, m, fixed in zip(*(batch.column(k).to_pylist() for k in ("html", "main", "fixed")))]
        yield {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": texts,
               "n_chars": [len(t) for t in texts]}

    return map_arrow(rows.join(found.select("host", "main", F.col("fixed.piece").alias("fixed")), "host", "left"), run,
                     "page_id long, url string, text string, n_chars long")


__all__ = ["distinct_pages", "extract", "host_of", "main_text", "own_main", "piece_hash", "pieces", "templates", "tokens", "walk"]
