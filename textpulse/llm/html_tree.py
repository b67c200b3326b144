"""HTML extraction by site style trees.

The pages of a host are merged into one tree of styles: a branch is the chain of block
elements, with classes and ids, from the body down. Each branch has an importance: the
entropy, over the host's pages of different content, of how it is laid out (its children's styles) and of what it
says. A branch that looks and reads alike on most pages is noise and leaves every page, with
what the standard names of elements, roles and classes already call page furniture.
"""

from __future__ import annotations

import html
import re

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpulse.llm.common import append_columns, broadcast_if_small, store
from textpulse.llm.urls import url_host

#: A branch is judged on hosts with this many pages of different content that have it; it goes when its importance
#: (0 to 1) is lower than this, unless it carries this share of the host's text.
LEAST_PAGES, LEAST_IMPORTANCE, MAIN_SHARE = 8, 0.3, 0.05

#: Weight of layout against content; it falls with each child that a branch has.
DAMPING = 0.9

#: Fixed values of HTML: elements that hold no text of a page, that stand as blocks, that are
#: empty, and that end an open paragraph.
HIDDEN = set("head title script style noscript template iframe svg math object select option datalist button audio video canvas map".split())
BLOCKS = set(
    "body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th"
    " blockquote pre figure figcaption address details summary hgroup fieldset legend center"
    " nav header footer aside form dialog menu search hr".split()
)
EMPTY = set("area base br col embed hr img input link meta param source track wbr".split())
ENDS_P = BLOCKS - {"body", "td", "th", "tr", "thead", "tbody", "tfoot", "caption", "legend"}
FURNITURE = {"nav", "footer", "aside", "form", "dialog", "menu", "search"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog"}
NAMES = set(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies"
    " disclaimer footer login menu modal nav navbar navigation newsletter notice pagination popup promo related"
    " search share sidebar social sponsor sponsored subscribe toolbar widget".split()
)
HEADERS = {"header", "masthead"}

#: Elements of one kind that end the open one beside them, and where that search stops.
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
SCOPES = {"body", "article", "main", "section", "div", "ul", "ol", "dl", "table", "nav", "aside", "footer", "header", "form", "blockquote"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title|noscript|iframe)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")


class Element:
    __slots__ = ("tag", "path", "noise", "main", "named", "outside")

    def __init__(self, tag: str, path: str, noise: bool, main: str, named: bool = False, outside: bool = True):
        self.tag, self.path, self.noise, self.main = tag, path, noise, main
        # Noise by a class or id, and whether it is in no article or main element.
        self.named, self.outside = named, outside


def _style(tag: str, rest: str) -> tuple[str, set[str], str]:
    """(style, name words, role) of a start tag."""
    style, words, role = tag, set(), ""
    for name, a, b, c in _ATTRIBUTE.findall(rest) if rest else ():
        value = html.unescape(a or b or c).lower()
        if name.lower() == "role":
            role = value.strip()
        else:
            words.update(w for w in _SPLIT.split(value) if w)
            style += ("." if name.lower() == "class" else "#") + "-".join(sorted(value.split()))
    return style, words, role


def blocks(page: str) -> list[tuple[str, bool, str, str]]:
    """(branch, noise, main part, text) of every block of a page, in page order.

    The main part is "article", "main" or "". Missing end tags are made up as browsers do for
    paragraphs, list items and cells; stray ones are passed over. Name words do not make
    noise of an article or main element, nor of what holds it; inside of one they do.
    """
    stack = [Element("body", "body", False, "")]
    made: list[tuple[str, bool, str, str, list[Element]]] = []
    text: list[str] = []

    def flush() -> None:
        if text:
            plain = " ".join(html.unescape("".join(text)).split())
            text.clear()
            if plain:
                holder = next(e for e in reversed(stack) if e.tag in BLOCKS)
                named = [e for e in stack if e.named]
                made.append((holder.path, any(e.noise for e in stack), stack[-1].main, plain, named))

    def close_to(tags: tuple[str, ...], scopes: set[str]) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in tags:
                flush()
                del stack[depth:]
                return
            if stack[depth].tag in scopes:
                return

    at = 0
    for token in _TOKEN.finditer(page):
        if token.start() > at:
            text.append(page[at : token.start()])
        at = token.end()
        tag = (token[3] or "").lower()
        if not tag:
            continue
        if token[2]:
            if tag in BLOCKS:
                flush()
            if tag == "body" or tag == "html":
                continue
            if any(e.tag == tag for e in stack[1:]):
                while stack[-1].tag != tag:
                    stack.pop()
                stack.pop()
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in ENDS_P:
            close_to(("p",), SCOPES)
        if tag in SIBLINGS:
            close_to(SIBLINGS[tag], SCOPES - {"tr", "li"})
        if tag in BLOCKS:
            flush()
        if tag in EMPTY or tag in ("html", "body"):
            continue
        style, words, role = _style(tag, token[4])
        over = stack[-1]
        main = over.main
        if tag == "article" or (tag == "main" or role == "main") and not main:
            main = "article" if tag == "article" else "main"
        noise = tag in FURNITURE or tag in HIDDEN or role in ROLES or (not over.main and tag == "header")
        named = bool(words & NAMES) or (not over.main and bool(words & HEADERS))
        if (tag in ("article", "main") or role == "main") and over.main != "article":
            if not any(e.named and not e.outside for e in stack):
                named = False
            # Blocks before it in what holds it are judged at the end.
            for e in stack:
                if e.outside:
                    e.named = False
        path = f"{over.path}/{style}" if tag in BLOCKS else over.path
        stack.append(Element(tag, path, noise, main, named, not over.main))
    if at < len(page):
        text.append(page[at:])
    flush()
    return [(path, noise or any(e.named for e in named), main, plain) for path, noise, main, plain, named in made]


def _wanted(found: list[tuple[str, bool, str, str]], low: set[str]) -> str:
    parts = {main for _, noise, main, _ in found if not noise}
    part = "article" if "article" in parts else "main" if "main" in parts else ""

    def gone(path: str) -> bool:
        steps = path.split("/")
        return any("/".join(steps[:k]) in low for k in range(2, len(steps) + 1))

    return "\n".join(
        text for path, noise, main, text in found
        if not noise and (main == part or not part) and not (low and gone(path))
    )


def _branches():
    """Per page: a digest of its main part, and what each branch and its parents look like and say."""

    def step(pages):
        digests, out = [], []
        for page in pages:
            found = blocks(page or "")
            digests.append(xxhash.xxh64_intdigest(_wanted(found, set())) >> 1)
            looks: dict[str, list[str]] = {}
            says: dict[str, list[str]] = {}
            for path, _, _, text in found:
                steps = path.split("/")
                for k in range(2, len(steps) + 1):
                    branch = "/".join(steps[:k])
                    looks.setdefault(branch, []).append(steps[k] if k < len(steps) else "")
                    says.setdefault(branch, []).append(text)
            out.append([
                {"branch": b, "look": xxhash.xxh64_intdigest("/".join(looks[b])) >> 1,
                 "say": xxhash.xxh64_intdigest("\n".join(says[b])) >> 1,
                 "chars": sum(map(len, says[b])), "children": len(set(looks[b]))}
                for b in looks
            ])
        return digests, out

    return step


def low_branches(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """(host, low): the branches of each host that carry little, as an array; stored.

    Importance = (1 - DAMPING ** children) * layout entropy + DAMPING ** children * content
    entropy, each over the pages that have the branch, in units of their logarithm. Pages of
    one main part are one page, as far as a branch is alike on them: copies are no evidence.
    """
    kind = "array<struct<branch:string,look:long,say:long,chars:long,children:int>>"
    narrow = pages.select(url_host(F.col(url)).alias("host"), F.col(page).alias("html"))
    found = append_columns(narrow, ["html"], f"digest long, branches {kind}", _branches)
    found = found.select("host", "digest", F.inline("branches"))
    found = found.groupBy("host", "branch", "digest", "look", "say").agg(F.max("chars").alias("chars"), F.max("children").alias("children"))
    found = store(found, "style-branches")

    def entropy(value: str) -> DataFrame:
        counts = found.groupBy("host", "branch", value).agg(F.count("*").alias("n"))
        m = F.sum("n")
        # The entropy of counts n with sum m is log m - sum(n log n) / m.
        bits = F.log(m) - F.sum(F.col("n") * F.log("n")) / m
        return counts.groupBy("host", "branch").agg(m.alias("m"), F.when(m > 1, bits / F.log(m)).otherwise(1.0).alias(f"{value}_h"))

    # Text that is said again on another page counts once.
    said = (
        found.groupBy("host", "branch", "say").agg(F.max("chars").alias("chars"), F.max("children").alias("children"))
        .groupBy("host", "branch").agg(F.sum("chars").alias("chars"), F.max("children").alias("children"))
    )
    whole = said.filter(~F.contains(F.substring("branch", 6, 1 << 30), F.lit("/"))).groupBy("host").agg(F.sum("chars").alias("all_chars"))
    met = found.groupBy("host", "branch", "digest").agg(F.count("*")).groupBy("host", "branch").agg(F.count("*").alias("pages"))
    fade = F.pow(F.lit(DAMPING), F.col("children"))
    judged = (
        entropy("look").drop("m").join(entropy("say").drop("m"), ["host", "branch"]).join(said, ["host", "branch"])
        .join(met, ["host", "branch"]).join(whole, "host")
        .withColumn("importance", (1 - fade) * F.col("look_h") + fade * F.col("say_h"))
    )
    low = judged.filter(
        (F.col("pages") >= LEAST_PAGES) & (F.col("importance") < LEAST_IMPORTANCE) & (F.col("chars") < MAIN_SHARE * F.col("all_chars"))
    )
    return store(low.groupBy("host").agg(F.sort_array(F.collect_list("branch")).alias("low")), "low-branches")


def extract(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """All rows and columns, with _text: the blocks of the main part, joined by line feeds.

    The main part is every article, else the main element, else the body; without branches
    that are page furniture by name or low in importance on their host. White space in a
    block becomes one space, ``br`` too. Null and empty pages have an empty text; URLs without
    a host form one site. Repeated rows count once for a branch.
    """
    low = low_branches(pages, url, page).withColumnRenamed("host", "_host").withColumnRenamed("low", "_low")
    joined = pages.withColumn("_host", url_host(F.col(url))).join(broadcast_if_small(low, 1 << 10), "_host", "left")
    joined = joined.select(*[F.col(f"`{c}`") for c in pages.columns], "_low")

    def start():
        return lambda bodies, lows: [[_wanted(blocks(b or ""), set(l or ())) for b, l in zip(bodies, lows)]]

    return append_columns(joined, [page, "_low"], "_text string", start).drop("_low")
