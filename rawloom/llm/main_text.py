"""Main text of web pages by a site style tree.

Each page is read into a tree of elements. The whole pages of one host, menus, boxes and footers included,
are merged into the host's style tree: branches at one path are one node, which counts how its pages
present it (the kinds of its children) and what they say in it. A branch that the pages of a host show
alike has a low entropy, so low importance, and goes from every page. Of branches whose names or roles say
menu, advert or the like only the presentation counts, as such boxes say something else on every page.
Articles and main elements begin paths of their own, wherever a page has them. What is left of
a page is its text: in its article if it marks one, and without what names and roles still tell apart,
which is all there is for hosts with few pages.
"""

import html as references
import re
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import broadcastable, free_name, stored, table

# Elements by what HTML and common usage say about them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset("body html dd dt li tbody td tfoot th thead tr optgroup option legend".split())
SIBLINGS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "tbody": ("tbody", "thead", "tfoot", "tr", "td", "th"), "tfoot": ("tbody", "thead", "tr", "td", "th"), "p": ("p",),
}
SCOPES = frozenset("table ul ol dl article section div nav aside header footer main body html select td th".split())
NOISE = frozenset(
    "nav aside form script style noscript template svg button select textarea iframe object canvas head dialog menu audio "
    "video title footer xmp noembed noframes map datalist".split()
)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
NOISE_NAMES = frozenset(
    "ad ads advert advertisement adverts advertising adsense adbox banner banners sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice notices alert sidebar side-bar comment comments commentlist reader-comments disqus replies respond menu menus nav navbar "
    "navigation breadcrumb breadcrumbs footer masthead topbar share sharing social related recommended widget widgets popup modal overlay newsletter "
    "subscribe subscription pagination pager skip-link".split()
)
# Names that mean noise also inside an article, where others (social, related, menu, notice of a term) may well be what it is about.
NOISE_IN_ARTICLES = frozenset(
    "ad ads advert advertisement adverts advertising adsense adbox ad-box ad-banner ad-container ad-slot sponsored cookie cookies cookie-notice "
    "cookie-banner cookie-consent gdpr notice notices sidebar side-bar comment comments comment-list comments-area commentlist reader-comments "
    "disqus respond nav navbar navigation breadcrumb breadcrumbs pagination pager newsletter social-share share-buttons related-posts "
    "related-articles skip-link".split()
)
#: Noise around an article or a main element, by how much it says: a form or the beginning of a name is often the whole page's; a whole name, a
#: role or one of these tags counts if nothing else is marked; what is hidden or not content never does.
WEAK, STRONG, NEVER = 1, 2, 3
AROUND = frozenset("aside footer header menu nav".split())
#: Importance below which a branch goes, pages that must show it, and the weight of contents against presentation.
LEAST, PAGES, CONTENT = 0.2, 3, 0.9
#: (Host, branch) pairs that a broadcast may hold.
SMALL = 1_000_000

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>=\s*(?:"[^"]*"|'[^']*'|[^\s"'>][^\s>]*)|[^>=]++|=)*+)>|<[!?/][^>]*>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")


@dataclass(slots=True)
class Element:
    tag: str
    name: str = ""
    noise: int = 0  # 0, WEAK, STRONG or NEVER
    article: bool = False
    main: bool = False
    inside: int = 0  # 2 in an article, 1 in a main element
    parts: list = field(default_factory=list)  # texts and elements in order


def _tag_noise(tag: str, inside: int) -> int:
    if tag == "form":
        return WEAK
    if tag in AROUND:
        return STRONG if tag in NOISE or (tag == "header" and not inside) else 0
    return NEVER if tag in NOISE else 0


def _element(tag: str, attributes: str, above: Element) -> Element:
    inside = 2 if above.article else max(above.inside, above.main)
    noise = _tag_noise(tag, inside)
    if not attributes:
        return Element(tag, tag, noise, tag == "article", tag == "main", inside)
    names, role, hidden = [], "", False
    for key, a, b, c in _ATTRIBUTE.findall(attributes):
        value, key = (a or b or c).lower(), key.lower()
        if key == "role":
            role = value.strip()
        elif key == "hidden" or key == "aria-hidden":
            hidden |= key == "hidden" or value == "true"
        elif key == "class" or key == "id":
            names += value.split()
    if hidden:
        noise = NEVER
    elif role in NOISE_ROLES:
        noise = max(noise, STRONG)
    if noise < STRONG and tag not in ("html", "body"):
        if any(n in (NOISE_IN_ARTICLES if inside == 2 else NOISE_NAMES) for n in names):
            noise = STRONG
        elif not inside and any(re.split(r"[-_]+", n)[0] in NOISE_NAMES for n in names):
            noise = WEAK
    return Element(tag, ".".join([tag, *sorted(names)]), noise, tag == "article" and not noise, (tag == "main" or role == "main") and not noise, inside)


def tree(page: str) -> Element:
    """The elements of a page; ends that are missing are found as browsers do for common cases."""
    root = Element("#root", "#root")
    stack, at, n = [root], 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            stack[-1].parts.append(page[at:])
            break
        if m.start() > at:
            stack[-1].parts.append(page[at : m.start()])
        at = m.end()
        tag = m.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if m.group(1):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if tag not in BLOCK and stack[k].tag in SCOPES:
                    break
            else:
                if tag == "p":
                    stack[-1].parts.append(Element("p", "p"))
            continue
        attributes = m.group(3)
        if tag in CLOSES_P:
            _close(stack, ("p",))
        if tag in SIBLINGS and tag != "p":
            _close(stack, SIBLINGS[tag])
        element = _element(tag, attributes, stack[-1])
        stack[-1].parts.append(element)
        if tag in VOID or attributes.endswith("/") and tag not in BLOCK:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = n if end is None else end.end()
            continue
        stack.append(element)
    return root


def _close(stack: list, tags: tuple) -> None:
    """Close the innermost open element of ``tags`` in the scope."""
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag in tags:
            del stack[k:]
            return
        if stack[k].tag in SCOPES and stack[k].tag not in tags:
            return


def _marked(element: Element, kind: str) -> list[list]:
    """Outermost elements marked as article (or main) in page order: outside noise, and below WEAK and STRONG noise."""
    out, todo = [[], [], []], [(element, 0)]
    while todo:
        e, around = todo.pop()
        around = max(around, e.noise)
        if around == NEVER:
            continue
        if getattr(e, kind):
            out[around].append(e)
            continue
        todo += [(p, around) for p in reversed(e.parts) if isinstance(p, Element)]
    return out


def _held(elements: list, articles: bool = True) -> int:
    """Characters of text that elements hold outside noise, without those of articles if so told."""
    total, todo = 0, list(elements)
    while todo:
        for p in todo.pop().parts:
            if isinstance(p, str):
                total += sum(map(len, p.split()))
            elif not p.noise and (articles or not p.article):
                todo.append(p)
    return total


def _below(above: int, name: str) -> int:
    return xxhash.xxh64_intdigest(name, above & 0xFFFFFFFFFFFFFFFF) >> 1


#: Paths of articles and main elements; no element has such a name.
ARTICLE, MAIN = _below(0, "#article"), _below(0, "#main")


def _path(above: int, e: Element) -> int:
    """Path of an element below another's; ``html`` and ``body``, which a page may leave out, are no step."""
    return ARTICLE if e.article else MAIN if e.main else above if e.tag in ("html", "body") else _below(above, e.name)


def prune(root: Element, low: frozenset) -> None:
    """Take the branches at ``low`` paths out of a tree; an end of a block stays in place of a block."""
    todo = [(root, 0)]
    while todo:
        e, above = todo.pop()
        kept = []
        for p in e.parts:
            if isinstance(p, Element):
                path = _path(above, p)
                if path in low:
                    p = Element(p.tag, p.name)
                else:
                    todo.append((p, path))
            kept.append(p)
        e.parts = kept


def regions(root: Element) -> list:
    """Where the text is: in articles or main elements, else anywhere.

    Articles win over main elements that hold less outside them. Those outside noise win over those below a form or
    below a name that only begins like noise, unless these hold more; what is left counts if nothing else does.
    """
    best, most = [root], 0
    for around, (articles, mains) in enumerate(zip(_marked(root, "article"), _marked(root, "main"))):
        if around == STRONG and most:
            break
        found, held = articles, _held(articles)
        if mains and _held(mains, False) > held:
            found, held = mains, _held(mains)
        if held > most:
            best, most = found, held
    return best


def _lines(element: Element, out: list) -> None:
    """Append the texts of an element, with None where a block begins or ends."""
    todo = [(element, False)]
    while todo:
        e, ended = todo.pop()
        if isinstance(e, str):
            out.append(e)
            continue
        if ended:
            out.append(None)
            continue
        if e.tag in BLOCK:
            out.append(None)
        elif e.tag == "br":
            out.append("\n")
        if e.noise:
            continue
        if e.tag in BLOCK:
            todo.append((e, True))
        todo += [(p, False) for p in reversed(e.parts)]


def main_text(page: str, low: frozenset = frozenset()) -> str:
    """Blocks of the main text, a line each."""
    out: list = []
    root = tree(page)
    if low:
        prune(root, low)
    for e in regions(root):
        _lines(e, out)
        out.append(None)
    blocks, now = [], []
    for piece in [*out, None]:
        if piece is not None:
            now.append(piece)
        elif now:
            text = " ".join(references.unescape("".join(now)).split())
            if text:
                blocks.append(text)
            now = []
    return "\n".join(blocks)


def branches(page: str) -> list[tuple[int, int, int, int, int, int]]:
    """(path, path above, named as noise, presentation, contents, main text of the page) of a page's branches that hold text.

    A page has one row for each path. Articles and main elements are no branches themselves, and what is around the
    page's main text doesn't count as named.
    """
    seen: dict[int, list] = {}
    root = tree(page)
    whole: list = []
    found = regions(root)
    for region in found:
        _lines(region, whole)
    around = {id(region) for region in found}
    todo = [(0, 0, root, iter(root.parts), [], [])]
    while todo:
        path, above, e, parts, kinds, texts = todo[-1]
        for p in parts:
            if isinstance(p, str):
                text = " ".join(p.split())
                if text:
                    texts.append(xxhash.xxh64_digest(text))
            else:
                kinds.append(p.name)
                todo.append((_path(path, p), path, p, iter(p.parts), [], []))
                break
        else:
            todo.pop()
            if id(e) in around and todo:
                around.add(id(todo[-1][2]))
            if texts and todo:
                text = xxhash.xxh64_digest(b"".join(texts))
                todo[-1][5].append(text)
                if path != above and not e.article and not e.main:
                    own = seen.setdefault(path, [above, 1, [], []])
                    own[1] &= e.noise >= STRONG and id(e) not in around
                    own[2] += kinds
                    own[3].append(text)
    number = lambda data: xxhash.xxh64_intdigest(data) >> 1
    whole = number(" ".join("".join(p or " " for p in whole).split()))
    return [(path, above, noise, number("\0".join(kinds)), number(b"".join(texts)), whole) for path, (above, noise, kinds, texts) in seen.items()]


def _entropy(seen: DataFrame, feature: str) -> DataFrame:
    """Entropy of a feature over the pages that have a branch, to the base of their number."""
    counts = seen.groupBy("site", "path", feature).agg(F.count("*").cast("double").alias("c"))
    total, spread = F.sum("c"), F.sum(F.col("c") * F.log("c"))
    return counts.groupBy("site", "path").agg(
        total.alias("pages"), F.when(total > 1, 1 - spread / (total * F.log(total))).otherwise(F.lit(1.0)).alias(feature)
    )


def style_tree(pages: DataFrame, page: str = "html", host: str = "host", least: float = LEAST, least_pages: int = PAGES) -> DataFrame:
    """(``site``, ``path``) of the outermost branches that the pages of a host show alike.

    Pages of one main text are one page. A branch counts as named like noise if it is so on all pages.
    """
    names = ["site", "path", "above", "noise", "style", "content", "whole"]

    def rows(batches):
        for batch in batches:
            out = [[] for _ in names]
            for site, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for row in branches(text or ""):
                    for column, value in zip(out, (site, *row)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), *[pa.array(o, pa.int64()) for o in out[1:]]], names)

    every = pages.where(F.col(host) != "").select(F.col(host).alias("site"), page)
    every = every.mapInArrow(rows, ", ".join(["site string", *[f"{n} long" for n in names[1:]]]))
    # Of the pages of one text one shows a branch, the same one each time; both entropies read it.
    first = F.min(F.struct(*names[2:6])).alias("first")
    seen = stored(every.groupBy("site", "path", "whole").agg(first, F.min("noise").alias("named")).select("site", "path", "named", "first.*"), "presentations")
    style = _entropy(seen, "style")
    content = _entropy(seen, "content").drop("pages")
    known = seen.groupBy("site", "path").agg(F.min("named").alias("named"), F.min("above").alias("above"))
    importance = F.when(F.col("named") > 0, F.col("style")).otherwise((1 - CONTENT) * F.col("style") + CONTENT * F.col("content"))
    low = style.join(content, ["site", "path"]).join(known, ["site", "path"]).where((F.col("pages") >= least_pages) & (importance < least))
    low = stored(low.select("site", "path", "above"), "unimportant")
    outer = low.select("site", F.col("path").alias("above"))
    return low.join(outer, ["site", "above"], "left_anti").select("site", "path")


def extract(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """Adds ``text`` and ``n_chars`` to every row; columns of these names are replaced.

    White space in a block becomes one blank, blocks are joined by line feeds in page order. NULL and
    empty pages, and pages without main text, give an empty text. Branches below articles are compared with those
    below articles of other pages of the host, and so for main elements and the rest of the page; pages without a host
    are read alone, and so are those of hosts with fewer than three texts. Repeated rows stay, but copies of a text count as one page of their host; an empty table
    stays empty.
    """
    from .url_filter import canonical

    site, paths = free_name(pages, "site"), free_name(pages, "paths")
    placed = pages.withColumn(site, canonical(F.col(url))[0])
    branch = stored(style_tree(placed, page, site), "branches")
    low = branch.groupBy("site").agg(F.collect_list("path").alias(paths)).withColumnRenamed("site", site)
    low = F.broadcast(low) if broadcastable(branch, SMALL) else low

    @F.pandas_udf("string")
    def text_of(texts: pd.Series, low_paths: pd.Series) -> pd.Series:
        return pd.Series([main_text(t or "", frozenset(() if p is None else p)) for t, p in zip(texts, low_paths)], dtype=object)

    return (
        placed.join(low, site, "left")
        .withColumn("text", text_of(F.col(page), F.col(paths)))
        .withColumn("n_chars", F.length("text").cast("long"))
        .drop(site, paths)
    )


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")
