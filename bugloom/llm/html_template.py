"""Main text of web pages by the template that equivalence classes of tokens show.

1. A page is a sequence of tokens: elements under their path of tags and classes, and the texts of blocks under theirs.
2. For each token of a host its occurrence vector (how often it stands on which page) is aggregated as a hash, with the
   sum of its places, before any shuffle, so no host's pages meet in one task.
3. Tokens of one vector are a class.  One that holds elements and texts and is on enough pages may be part of the host's
   template.  It is valid on a page if its tokens stand there in their order (that of their places' sums), once or over
   and over, and if its instances nest with those of classes on more pages: each in one gap of the other.
4. Texts of a valid class in one of its own elements (in marked articles: directly) are the template's; what stands in the
   remaining slots is extracted, block by block.  A class that holds an article's heading is of copies: its texts stay.
5. Of the slots, those that tags mark as no text (menus, forms), and those that link away or bear a name such as
   `comments` on most of the host's pages are left out; where slots remain in a marked article and outside, those in it
   are the text.
"""

from __future__ import annotations

import hashlib
import html
import re
from bisect import bisect
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import dropped, mapped, stored, table

#: Pages, and share of a host's pages, from which a class says something: a host has at most a page's tokens / CLASS_SHARE.
MIN_PAGES = 3
CLASS_SHARE = 0.05
#: Share of a host's pages from which links or a name tell what a slot is.
SUPPORT = 0.5
#: Bytes of all templates up to which they are shipped to every task; beyond, pages meet them by host.
SHIPPED = 16 << 20
MOST_LINKED = 0.5

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var wbr img label svg".split())
MATH = frozenset("math maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics".split())
INLINE |= MATH
#: Elements whose content is no text; they don't end the block that they stand in.  A drawing may close itself.
RAW = "script|style|noscript|template|svg|iframe|textarea|title|object|annotation|annotation-xml"
#: Elements that are never part of the text, and classes, ids and roles that say the same if a host's pages share them.
CHROME_TAGS = frozenset("head nav header footer aside form menu dialog button select input fieldset".split())
CHROME_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert comment comments disqus reply replies sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead share sharing social related newsletter subscribe subscription signup login search popup modal overlay pagination pager toolbar widget".split()
)
CONTENT = frozenset("article main".split())
#: Their ids are made of what they are about.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TITLED = HEADINGS | frozenset("section body html".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
CLOSES_OWN = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<(?:svg|annotation|{'|'.join(sorted(MATH))})(?![\w-])(?:[^>\"'/]++|\"[^\"]*+\"|'[^']*+'|/(?!>))*+/>|<(?P<raw>{RAW})(?![\w-])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|[^<]+|<", re.S | re.I)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
#: Between the elements of a path, and before a chrome word: neither stands in a tag or class name.
SEP, MARK = " ", "\t"


def label(tag: str, attrs: str) -> tuple[str, bool, str]:
    """A structural token of an element, whether its content isn't the page's text, and a name that hints so or ''."""
    names, chrome, word = [], tag in CHROME_TAGS, ""
    if attrs:
        for kind, *value in _NAMED.findall(attrs):
            v = "".join(value).lower()
            if tag not in CONTENT and not (kind.lower() == "id" and tag in TITLED):
                word = next((w for w in v.split() if w in CHROME_WORDS), word)
            if kind.lower() == "class":
                names = sorted(v.split())
        if "hidden" in attrs:  # the attribute itself, not a class that is named so
            bare = re.sub(r"\"[^\"]*\"|'[^']*'", "", attrs)
            chrome |= bool(re.search(r"(?<![\w-])hidden(?![\w-])", bare) or re.search(r"aria-hidden\s*=\s*[\"']?true", attrs))
    return ".".join([tag, *names]), chrome, word


class Page:
    """The tokens of a page.

    elements: places of each element's path; marks: elements with a chrome word; blocks: (path, chrome, in content, text,
    characters of links, [element with a chrome word, whether it holds an article] of each around it that has one, place).
    """

    def __init__(self, source: str) -> None:
        self.elements: dict[str, list[int]] = {"": [0]}
        self.marks: set[str] = set()
        self.blocks: list[tuple[str, bool, bool, str, int, list[list], int]] = []
        place = 0
        stack: list[tuple[str, str, bool, bool, list | None]] = [("", "", False, False, None)]  # tag, path, chrome, content, mark
        text: list[str] = []
        linked, in_link = 0, 0

        def close() -> None:
            nonlocal linked, place
            if text:
                if joined := " ".join(html.unescape("".join(text)).split()):
                    tag, path, _, content, _ = next(x for x in reversed(stack) if x[0] not in INLINE)
                    place += 1
                    own = tag in HEADINGS and content  # an article's header holds its heading
                    chrome = any(x[2] and not (own and x[0] == "header" and x[3]) for x in stack)
                    self.blocks.append((path, chrome, content, joined, linked, [x[4] for x in stack if x[4]], place))
                text.clear()
            linked = 0

        def pop_to(i: int) -> None:
            nonlocal in_link
            in_link -= sum(x[0] == "a" for x in stack[i:])
            del stack[i:]

        for m in _TOKEN.finditer(source):
            tag = m["tag"]
            if tag is None:
                piece = m[0]  # also a comment, a raw element or a closed drawing, which hold no text
                if piece[0] != "<" or piece == "<":
                    text.append(piece)
                    linked += len(piece) if in_link else 0
                continue
            tag = tag.lower()
            if tag not in INLINE:
                close()
            if m["end"]:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == tag:
                        pop_to(i)
                        break
                    if tag in INLINE and stack[i][0] not in INLINE:  # an inline element never closes a block
                        break
                continue
            if tag in VOID:
                continue
            if tag in CLOSES_P or tag in CLOSES_OWN:
                over = CLOSES_OWN.get(tag, {"p"})
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in over:
                        pop_to(i)
                        break
                    if stack[i][0] not in INLINE:
                        break
            name, chrome, word = label(tag, m["attrs"])
            _, path, _, content, _ = stack[-1]
            mark = [f"{path}{SEP}{name}{MARK}{word}", False] if word else None
            if mark:
                self.marks.add(mark[0])
            if tag in INLINE:
                stack.append((tag, path, chrome, content, mark))
                in_link += tag == "a"
            else:
                path = f"{path}{SEP}{name}"
                place += 1
                self.elements.setdefault(path, []).append(place)
                if tag in CONTENT:
                    for x in stack:
                        if x[4]:
                            x[4][1] = True
                stack.append((tag, path, chrome, content or tag in CONTENT, mark))
        close()


def _hash(*parts: object) -> int:
    return int.from_bytes(hashlib.blake2b("\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def _tag(path: str) -> str:
    return path.rpartition(SEP)[2].partition(".")[0]


class Template:
    """What a host's pages share: total pages; classes as (pages, tokens in order); hashes of paths that link and of marks."""

    def __init__(self, total: int = 0, classes: list[tuple[int, list[int]]] = (), linking: list[int] = (), marks: list[int] = ()) -> None:
        self.total, self.linking, self.marks = total, frozenset(linking), frozenset(marks)
        self.classes = sorted(classes, key=lambda c: (-c[0], c[1]))
        self.of = {t: k for k, (_, tokens) in enumerate(self.classes) for t in tokens}
        self.order = {t: i for _, tokens in self.classes for i, t in enumerate(tokens)}

    def valid(self, places: dict[int, list[int]]) -> set[int]:
        """The numbers of the classes that are ordered and nest on a page; places: of its tokens."""
        held: dict[int, list[tuple[int, int]]] = {}
        for t, at in places.items():
            if (k := self.of.get(t)) is not None:
                held.setdefault(k, []).extend((x, self.order[t]) for x in at)
        accepted: dict[int, list[list[int]]] = {}
        for k in sorted(held):
            size, found = len(self.classes[k][1]), sorted(held[k])
            if len(found) % size or any(i % size != o for i, (_, o) in enumerate(found)):
                continue
            instances = [[x for x, _ in found[i : i + size]] for i in range(0, len(found), size)]
            if all(_nest(a, b) for others in accepted.values() for a in others for b in instances):
                accepted[k] = instances
        return set(accepted)


def _nest(a: list[int], b: list[int]) -> bool:
    """Whether one instance stands in one gap of the other, or before or after it."""
    return bisect(a, b[0]) == bisect(a, b[-1]) or bisect(b, a[0]) == bisect(b, a[-1])


class Hashes(dict):
    """Hashes of paths, each worked out once."""

    def __missing__(self, path: str) -> int:
        self[path] = out = _hash(path)
        return out


def tokens_on(page: Page, hashes: Hashes) -> tuple[dict[int, list[int]], list[int]]:
    """(places of every token of a page, the token of each block); blocks that are no text have none: 0."""
    places = {hashes[path]: at for path, at in page.elements.items()}
    texts = []
    for path, chrome, _, text, _, _, place in page.blocks:
        texts.append(0 if chrome else _hash(path, text))
        if not chrome:
            places.setdefault(texts[-1], []).append(place)
    return places, texts


def main_text(page: Page, template: Template, hashes: Hashes | None = None) -> str:
    """The blocks of the slots that the template leaves.

    Where it leaves none, as on a host of copies, it can't tell the page from itself: then all blocks outside chrome count.
    """
    hashes = Hashes() if hashes is None else hashes
    places, texts = tokens_on(page, hashes)
    good = template.valid(places) if template.classes else ()
    copies, site = set(), []
    for (path, chrome, content, *_), t in zip(page.blocks, texts, strict=True):
        k = template.of.get(t)
        site.append(k if not chrome and k in good and any(template.of.get(hashes[p]) == k for p in ((path,) if content else _around(path))) else None)
        if site[-1] is not None and _tag(path) in HEADINGS and (content or template.classes[k][0] < template.total):
            copies.add(k)
    slots, rest = [], []
    for b, k in zip(page.blocks, site, strict=True):
        path, chrome, content, _, _, marks, _ = b
        if chrome or any(hashes[m] in template.marks and not holds for m, holds in marks) or (not content and hashes[path] in template.linking):
            continue
        rest.append(b)
        if k is None or (content and (k in copies or _tag(path) in HEADINGS)) or (not content and k in copies):
            slots.append(b)
    slots = slots or rest
    inside = any(b[2] for b in slots)
    return "\n".join(b[3] for b in slots if b[2] == inside)


def _around(path: str) -> Iterator[str]:
    """The path and those of the elements around it."""
    while path:
        yield path
        path = path.rpartition(SEP)[0]
    yield ""


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)), F.lit(""))


#: kind: 0 element, 1 text, 2 mark; vector: hash of the occurrence vector; many: occurrences; place: sum of their places.
TOKENS = "host string, token long, kind int, pages long, vector long, many long, place long, chars long, linked long"
_U = (1 << 64) - 1


def _seen(page: int, many: int) -> int:
    """A page's part of an occurrence vector's hash; parts are combined by exclusive or."""
    x = (page ^ (many * 0x9E3779B97F4A7C15)) * 0xD6E8FEB86659FD93 & _U
    x = (x ^ (x >> 32)) * 0xD6E8FEB86659FD93 & _U
    x ^= x >> 32
    return x - (1 << 64) if x >> 63 else x


def tokens_of(pages: DataFrame) -> DataFrame:
    """TOKENS of each host; pages: page_id, host, html."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            if len(hashes) > 1_000_000:
                hashes.clear()
            rows: dict[tuple[str, int], list[int]] = {}
            for page_id, host, source in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2)), strict=True):
                page, number = Page(source or ""), _hash(page_id, source)
                places, texts = tokens_on(page, hashes)
                is_text, once = set(texts), _seen(number, 1)
                for t, at in places.items():
                    r = rows.setdefault((host, t), [int(t in is_text), 0, 0, 0, 0, 0, 0])
                    r[1] += 1
                    r[2] ^= once if len(at) == 1 else _seen(number, len(at))
                    r[3] += len(at)
                    r[4] += sum(at)
                for m in page.marks:
                    rows.setdefault((host, hashes[m]), [2, 0, 0, 0, 0, 0, 0])[1] += 1
                for path, chrome, _, text, linked, _, _ in page.blocks:
                    if not chrome:
                        r = rows[host, hashes[path]]
                        r[5] += len(text)
                        r[6] += linked
            columns = list(zip(*((*k, *v) for k, v in rows.items()), strict=True)) or [[]] * 9
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.string(), pa.int64(), pa.int32()] + [pa.int64()] * 6, strict=True)], [x.split()[0] for x in TOKENS.split(", ")])

    found = mapped(pages.select("page_id", "host", "html"), of, TOKENS)
    return found.groupBy("host", "token").agg(F.max("kind").alias("kind"), *(F.sum(c).alias(c) for c in ("pages", "many", "place", "chars", "linked")), F.bit_xor("vector").alias("vector"))


def templates_of(tokens: DataFrame) -> DataFrame:
    """host, total, classes, linking, marks, stored; tokens: of tokens_of()."""
    hosts = stored(tokens.filter(F.col("token") == F.lit(_hash(""))).select("host", F.col("pages").alias("total")), "op5-hosts")
    size = hosts.agg(F.sum(F.octet_length("host") + 32)).first()[0] or 0
    # stored, so that a host with most of the tokens is thinned out before its rows meet
    kept = tokens.join(F.broadcast(hosts) if size <= SHIPPED else hosts.hint("merge"), "host").filter(F.col("pages") >= CLASS_SHARE * F.col("total"))
    t = stored(kept, "op5-often")
    groups = t.filter((F.col("kind") < 2) & (F.col("pages") >= MIN_PAGES)).groupBy("host", "pages", "vector", "many")
    classes = groups.agg(F.sort_array(F.collect_list(F.struct("place", "token"))).alias("t"), F.min("kind").alias("least"), F.max("kind").alias("most")).filter("least = 0 AND most = 1")
    classes = classes.groupBy("host").agg(F.collect_list(F.struct("pages", F.col("t.token").alias("tokens"))).alias("classes"))
    most = F.col("pages") >= SUPPORT * F.col("total")
    links = most & (F.col("kind") == 0) & (F.col("chars") > 0) & (F.col("linked") > MOST_LINKED * F.col("chars"))
    marks = most & (F.col("kind") == 2) & (F.col("pages") >= MIN_PAGES)
    rest = t.groupBy("host").agg(F.first("total").alias("total"), F.collect_list(F.when(links, F.col("token"))).alias("linking"), F.collect_list(F.when(marks, F.col("token"))).alias("marks"))
    out = stored(rest.join(classes, "host", "left").select("host", "total", "classes", "linking", "marks"), "op5-templates")
    dropped(hosts, t)
    return out


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row.

    Null and empty html: an empty text; pages without a url share a host; each of several like rows is extracted; html of
    any length is read whole; further columns are ignored, whatever their names.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host_of(F.col("url")).alias("host"), "html")
    tokens = stored(tokens_of(pages), "op5-tokens")
    templates = templates_of(tokens)
    dropped(tokens)
    in_classes = F.aggregate(F.coalesce("classes", F.array()), F.lit(0), lambda a, c: a + F.size(c["tokens"]) + 4)
    size = templates.agg(F.sum(8 * (in_classes + F.size("linking") + F.size("marks") + 16))).first()[0] or 0

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Template] = {}
        hashes = Hashes()
        for batch in batches:
            if len(hashes) > 1_000_000:
                hashes.clear()
            texts, hosts = [], batch.column(2).to_pylist()
            for i, source in enumerate(batch.column(3).to_pylist()):
                if hosts[i] not in known:
                    if len(known) > 10_000:
                        known.clear()
                    classes = [(c["pages"], c["tokens"]) for c in batch.column(5)[i].as_py() or []]
                    known[hosts[i]] = Template(batch.column(4)[i].as_py() or 0, classes, *(batch.column(k)[i].as_py() or [] for k in (6, 7)))
                texts.append(main_text(Page(source or ""), known[hosts[i]], hashes))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    joined = pages.join(F.broadcast(templates) if size <= SHIPPED else templates.hint("merge"), "host", "left")
    return mapped(joined.select("page_id", "url", "host", "html", "total", "classes", "linking", "marks"), of, "page_id long, url string, text string, n_chars long")


def op5_html_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of each page; see extracted() for nulls, empty tables and rows that repeat."""
    return extracted(table(spark, "pages", sf_dir))
