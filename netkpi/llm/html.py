"""Main text of web pages by site template removal.

Every page is read into its elements, and each element's subtree is hashed bottom-up from its tags and texts. Spark counts
per host in how many pages with different main texts a subtree recurs (copies of one article count once, so that they
do not look like a template). Subtrees that recur across many pages of their host are deleted; from what is left comes
the text of the article, without the elements that stand for menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles and reader comments by tag, role or class. A host with too few pages to show its template has only the latter.

Inside an article, paragraphs and headings are never taken for a template: short ones recur by chance. Containers are.

Defined results: null or empty html gives an empty text; a page without article or main element gives the text of its
body; a page whose url is null or has no host is of no host, so nothing recurs for it; rows that repeat a page are read one by
one and give the same text; elements that are never closed end with what holds them; unknown elements are inline;
`br` is white space; an empty table gives an empty table. All columns of the table are kept, whatever their names, but
one named main_text, which is replaced.
"""
from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Callable, Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from netkpi.llm.shared import BROADCAST_BYTES
from netkpi.sources.tables import materialize

#: A subtree is of the template when it recurs in at least so many different main texts of its host, and in this share of them.
MANY_PAGES, MANY_SHARE = 5, 0.01

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp
 small span strike strong sub sup time tt u var wbr""".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
 footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Parts of a text that may recur by chance.
PARAGRAPHS = frozenset("p li td th tr dd dt pre blockquote figcaption summary h1 h2 h3 h4 h5 h6".split())
#: A start tag ends open elements of these names, up to the nearest one that holds them.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "tbody": (("tbody", "thead", "tfoot", "tr", "td", "th"), ("table",)), "tfoot": (("tbody", "thead", "tfoot", "tr", "td", "th"), ("table",)),
    "thead": (("tbody", "tfoot", "tr", "td", "th"), ("table",)), "option": (("option",), ("select",)), "body": (("head",), ("html",)),
}
#: An end tag or a paragraph's implied end does not reach beyond these; end tags of tables do.
HOLDS = frozenset("td th caption table button object template html body".split())
TABLE = frozenset("table tbody thead tfoot tr td th caption html body".split())

#: Elements that are no part of an article, by tag, by role, and by words of their class or id.
DROP_TAGS = frozenset("""head script style noscript template nav footer aside iframe object svg canvas select button
 textarea input dialog menu title link meta audio video map""".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
DROP_WORDS = frozenset("""ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar nav navbar
 navigation menu breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe
 subscription signup login share sharing social related recommended recommendations widget toolbar pagination pager skip search""".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus replies respond".split())
#: Reasons to drop an element; all but the last are cancelled when an article stands inside it.
KEEP, WEAK, FORM, HEADER, STRONG = 0, 1, 2, 3, 4

TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)
 |<([a-zA-Z][^\s/>]*)((?:=\s*+"[^"]*+"|=\s*+'[^']*+'|[^>])*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|([^<]+|<)""", re.S | re.X)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(text)}


def reason(tag: str, held: dict[str, str], in_main: bool) -> int:
    """Why an element is dropped."""
    whole = tag in ("article", "main", "body", "html")
    names = (held.get("class", "") + " " + held.get("id", "")).split()
    words = set(names) if whole else {w.lower() for n in names for w in WORD.findall(n)}
    if tag in DROP_TAGS or words & COMMENT_WORDS or held.get("role", "").lower() in DROP_ROLES:
        return STRONG
    if "hidden" in held or held.get("aria-hidden") == "true" or "display:none" in held.get("style", "").replace(" ", "").lower():
        return STRONG
    if tag == "form":
        return FORM
    if tag == "header" or "header" in words and not in_main and not whole and tag not in HEADINGS:
        return HEADER
    return WEAK if words & DROP_WORDS and not whole else KEEP


class Page:
    """Elements of a page in order, with parent, reason to be dropped and subtree hash, and texts and block borders between them."""

    def __init__(self, source: str) -> None:
        # main: 2 in an article, 1 in the main element or one of that role, 0 elsewhere
        self.tag, self.parent, self.why, self.hash, self.main = ["#"], [-1], [KEEP], [0], [0]
        self.inner: list[list[bytes]] = [[]]
        self.events: list[tuple[int, str | None]] = []  # element and text, or None at the border of a block
        self.open, self.opened = [0], Counter()
        self._read(source)
        while len(self.open) > 1:
            self._close()
        self.has_main = any(self.main)

    def _read(self, source: str) -> None:
        at, end, match = 0, len(source), TOKEN.match
        while at < end:
            m = match(source, at)
            at = m.end()
            if m[4] is not None:
                self._text(m[4])
            elif m[2]:
                tag = m[2].lower()
                self._start(tag, m[3])
                if tag in RAW:
                    close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(source, at)
                    at = close.start() if close else at if tag in ("title", "textarea") else end
            elif m[1]:
                self._end(m[1].lower())

    def _text(self, raw: str) -> None:
        text = entities.unescape(raw) if "&" in raw else raw
        here = self.open[-1]
        self.events.append((here, text))
        if words := text.split():
            self.inner[here].append(" ".join(words).encode("utf-8", "surrogatepass"))

    def _start(self, tag: str, rest: str) -> None:
        block = tag in BLOCK
        if block and self.opened["p"]:
            self._end_open(("p",), HOLDS)
        if tag in ENDS:
            self._end_open(*ENDS[tag])
        held = attributes(rest) if rest and not rest.isspace() else {}
        parent, here, main, why = self.open[-1], len(self.tag), 0, KEEP
        if held or tag not in INLINE and tag not in ("p", "li", "div"):
            why = reason(tag, held, self.main[parent] > 0)
            role = held.get("role", "").lower()
            if tag == "article" or role == "article" or held.get("itemprop") == "articleBody":
                main = 2
            elif tag == "main" or role == "main":
                main = 1
        if main and why == KEEP:
            for up in self.open:
                if self.why[up] != STRONG:
                    self.why[up] = KEEP
        elif tag == "h1":
            for up in self.open:
                if self.why[up] == FORM:
                    self.why[up] = KEEP
        self.tag.append(tag)
        self.parent.append(parent)
        self.why.append(why)
        self.hash.append(0)
        self.inner.append([])
        self.main.append(max(self.main[parent], main if why == KEEP else 0))
        if block:
            self.events.append((here, None))
        elif tag == "br":
            self.events.append((parent, " "))
        self.open.append(here)
        self.opened[tag] += 1
        if tag in VOID:
            self._close()

    def _close(self) -> None:
        here = self.open.pop()
        tag, inner = self.tag[here], self.inner[here]
        self.opened[tag] -= 1
        if inner:  # a subtree without text is of no account
            mark = blake2b(tag.encode("utf-8", "surrogatepass") + b"\x00" + b"\x01".join(inner), digest_size=8).digest()
            self.hash[here] = int.from_bytes(mark, "little", signed=True)
            self.inner[self.parent[here]].append(b"\x02" + mark)
            self.inner[here] = []
        if tag in BLOCK:
            self.events.append((here, None))

    def _end_open(self, names: tuple[str, ...], holds) -> None:
        """Close the outermost open element of these names below the nearest one that holds them."""
        found, left = None, sum(self.opened[n] for n in names)
        for k in range(len(self.open) - 1, 0, -1):
            tag = self.tag[self.open[k]]
            if not left or tag in holds and tag not in names:
                break
            if tag in names:
                found, left = k, left - 1
        if found is not None:
            while len(self.open) > found:
                self._close()

    def _end(self, tag: str) -> None:
        if not self.opened[tag]:
            return
        inline = tag not in BLOCK
        for k in range(len(self.open) - 1, 0, -1):
            other = self.tag[self.open[k]]
            if other == tag:
                while len(self.open) > k:
                    self._close()
                return
            if inline and other in BLOCK or other in HOLDS and tag not in TABLE:
                return

    def dropped(self, gone: Callable[[int], bool] | None = None) -> list[int]:
        """Per element 0 if it stays, 1 if it or what holds it goes, 2 if only its headings stay (the header of an article).

        gone: tells of a hash whether that subtree is of the template.
        """
        out = [0] * len(self.tag)
        for k in range(1, len(self.tag)):
            up, why = out[self.parent[k]], self.why[k]
            own_header = why == HEADER and self.main[self.parent[k]] > 0
            if up == 1 or why and not own_header:
                out[k] = 1
            elif own_header or up == 2 and self.tag[k] not in HEADINGS:
                out[k] = 2
            if not out[k] and gone and self.may_recur(k) and gone(self.hash[k]):
                out[k] = 1
        return out

    def may_recur(self, k: int) -> bool:
        """Elements whose subtrees count as template: containers, on a page without article all but headings; never what is or holds one."""
        tag = self.tag[k]
        if not self.hash[k] or tag not in BLOCK or tag in ("html", "body", "article", "main") or self.main[k] > self.main[self.parent[k]]:
            return False
        return tag not in PARAGRAPHS or not self.has_main and tag not in HEADINGS

    def text(self, out: list[int]) -> str:
        """Blocks of the elements that stay, joined by line ends: of articles; of the main element if they hold less than half of it."""
        held = [0, 0, 0]
        for k, piece in self.events:
            if piece is not None and not out[k]:
                held[self.main[k]] += len(piece.strip())
        least = 0
        if any(m and not o for m, o in zip(self.main, out, strict=True)):
            least = 2 if held[2] >= held[1] else 1
        blocks, parts = [], []
        for k, piece in [*self.events, (0, None)]:
            if piece is None:
                if parts:
                    blocks.append(" ".join("".join(parts).split()))
                    parts = []
            elif not out[k] and self.main[k] >= least:
                parts.append(piece)
        return "\n".join(b for b in blocks if b)

    def recurring(self) -> list[int]:
        """Hashes of the subtrees that may be of the template."""
        return sorted({self.hash[k] for k in range(1, len(self.tag)) if self.may_recur(k)})


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of every page: host, hash of its main text before the template goes, hashes of subtrees."""
    for batch in batches:
        content, found = [], []
        for source in batch.column("html"):
            page = Page(source.as_py() or "")
            text = page.text(page.dropped())
            content.append(int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True))
            found.append(page.recurring())
        yield pa.RecordBatch.from_arrays(
            [batch.column("host"), pa.array(content, pa.int64()), pa.array(found, pa.list_(pa.int64()))], ["host", "content", "subtrees"])


def templates(pages: DataFrame, many: int = MANY_PAGES, share: float = MANY_SHARE) -> DataFrame:
    """host, subtree, n_contents of the subtrees that recur; pages: columns host, html. Written."""
    seen = materialize(pages.filter("host <> ''").select("host", "html").mapInArrow(
        _subtrees, "host string, content long, subtrees array<long>"), "html-subtrees")
    # pages with the same text on a host count once; rows are reduced in the map tasks, so a large host makes no large task
    sizes = seen.select("host", "content").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("n_host"))
    counts = (seen.select("host", "content", F.explode("subtrees").alias("subtree")).distinct()
              .groupBy("host", "subtree").agg(F.count(F.lit(1)).alias("n_contents")).filter(F.col("n_contents") >= many))
    often = materialize(counts, "html-recurring").join(materialize(sizes, "html-hosts"), "host")
    return materialize(often.filter(F.col("n_contents") >= share * F.col("n_host")).select("host", "subtree", "n_contents"), "html-templates")


def main_text(pages: DataFrame, many: int = MANY_PAGES, share: float = MANY_SHARE, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """All columns of pages (url, html and any others), and main_text.

    The templates are sent to all tasks while their measured size is within most_bytes; beyond that each page is joined with
    those of its own subtrees that are of its host's template.
    """
    pages = pages.drop("main_text")
    names = [f"_c{i}" for i in range(len(pages.columns))]
    at = dict(zip(pages.columns, names, strict=True))
    rows = pages.toDF(*names).withColumn("host", F.coalesce(host(F.col(at["url"])), F.lit(""))).withColumn("html", F.col(at["html"]))
    found = templates(rows, many, share)
    held = None
    if 128 * found.count() <= most_bytes:
        rows = rows.withColumn("gone", F.lit(None).cast("array<long>"))
        held = _by_host(found)
    else:
        key = F.xxhash64("host", "html")  # equal pages share their list; of two that only share the key each has what it needs
        own = (rows.filter("host <> ''").select("host", "html").mapInArrow(_own_subtrees, "host string, html string, subtrees array<long>")
               .select("host", key.alias("_key"), F.explode("subtrees").alias("subtree")).distinct())
        gone = own.join(found, ["host", "subtree"]).groupBy("_key").agg(F.collect_set("subtree").alias("gone"))
        rows = rows.withColumn("_key", key).join(materialize(gone, "html-gone").hint("merge"), "_key", "left").drop("_key")
    kept = [f for f in rows.schema.fields if f.name in names]
    schema = StructType([*kept, StructField("main_text", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for name, source, own in zip(batch.column("host"), batch.column("html"), batch.column("gone"), strict=True):
                page = Page(source.as_py() or "")
                marked = held.get(name.as_py(), frozenset()) if held is not None else set(own.as_py() or ())
                texts.append(page.text(page.dropped(marked.__contains__ if marked else None)))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(texts, pa.string())], [*names, "main_text"])

    return rows.mapInArrow(run, schema).toDF(*pages.columns, "main_text")


def _own_subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [Page(s.as_py() or "").recurring() for s in batch.column("html")]
        yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("html"), pa.array(found, pa.list_(pa.int64()))],
                                         ["host", "html", "subtrees"])


def _by_host(found: DataFrame) -> dict[str, frozenset[int]]:
    """Template subtrees of each host; their number was checked before."""
    out: dict[str, set[int]] = {}
    for name, subtree in found.select("host", "subtree").toLocalIterator():
        out.setdefault(name, set()).add(subtree)
    return {k: frozenset(v) for k, v in out.items()}
