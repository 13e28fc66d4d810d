"""Main text of web pages by tag-path ratios.

A page is read once into leaves: runs of text with their path of elements from the root,
their block and their share inside links. Leaves of one path are one class: its *text ratio*
is its characters per leaf and its *punctuation ratio* its sentence marks per leaf, each less
the share inside links. Both are smoothed over the leaves in page order, a neighbour
weighing as much as its path is alike; they are scaled by their largest, fused as
independent evidence, and averaged over the leaves of a path. Paths at or above
one standard deviation (at most half of the best) are content.

What is taken is whole: the `article` elements that hold most of the selected text, else
`main`, else the deepest element that holds nearly all of it without children that
hold none. Short blocks between selected ones (headings, list items, captions) thus stay.

Never content: menus, footers, sidebars, forms, scripts, styles, comments of readers, and
whatever class, id or role calls a notice, an advert or the like (a container with such a
name that holds a heading and more than half of the page is kept). Of a header inside an
article only headings stay. Character references are decoded, white space in a block (any
of Unicode) becomes one space, blocks are joined by an empty line; a line break is white space.

A page is one row and is judged by itself, so there is no shuffle; a task holds one page at a
time beside its batch. Pages cut off anywhere are read up to there; a tag without its end is
dropped. Null, empty and blank pages, and pages of nothing but markup, give an empty text.
Pages of any length are read whole, repeated rows each. Other columns stay as they are; one
named like the result is replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import bounded_batches, fields, tidy, without

#: Elements by what they mean for text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe noframes noembed xmp".split())
NEVER = frozenset("head title script style noscript iframe noframes noembed template svg math canvas object audio video nav footer aside dialog button select textarea datalist menu".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar".split())
#: Elements whose class or id may name them, and the names.
NAMED = frozenset("article details div dl figure form ol p section table ul".split())
READERS = frozenset("comment comments commentlist disqus guestbook replies reply respond".split())
CHROME = frozenset(
    "ad ads adsbygoogle advert advertisement advertising adverts alert banner breadcrumb breadcrumbs consent cookie cookies copyright disclaimer footer gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo promotion recommended related search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget".split()
)
#: An open element of the key ends where one of these starts.
ENDS_P = BLOCKS - frozenset("body caption dd dt head html legend li optgroup option summary tbody td tfoot th thead title tr".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"}, "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"}, "option": {"option", "optgroup"}, "head": {"body"}}
#: Elements beyond which no open element is ended by a start or end tag inside.
FENCES = frozenset("table td th caption ul ol dl article aside body button dialog div footer form header html main nav section template".split())

TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>"
    r"|<[A-Za-z!?/][^>]*(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
MARKS = re.compile(r"[.,;:!?…。，、；：！？]")
KEEP, DROP, HEADINGS_ONLY = range(3)
#: Weights of a leaf's neighbours at distance 0, 1 and 2: a normal curve.
NEAR = [math.exp(-d * d / 2) for d in range(3)]


class Page:
    """Leaves of a page and the elements that hold them."""

    def __init__(self, html: str):
        self.parent, self.name, self.leaves = [-1], [""], []  # leaf: element, path, block, text, in link, article, main, chrome
        self.chrome_up, self.chrome_has_heading = [-1], [False]
        self.block = 0
        # Open elements: name, id, path, what stays, in link, article, main, chrome.
        self.open = [("", 0, (), KEEP, False, -1, -1, 0)]
        at, m = 0, TOKEN.search(html)
        while m:
            if m.start() > at:
                self.text(html[at : m.start()])
            at = m.end()
            if m["name"]:
                name = m["name"].lower()
                if m["end"]:
                    self.ended(name)
                else:
                    self.started(name, m["attrs"] or "")
                    if name in RAW and self.open[-1][0] == name:
                        rest = re.compile(f"</{name}(?=[\\s/>]|\\Z)", re.IGNORECASE).search(html, at)
                        stop = rest.start() if rest else len(html)
                        if name not in NEVER:
                            self.text(html[at:stop])
                        at = stop
            m = TOKEN.search(html, at)
        if at < len(html):
            self.text(html[at:])

    def text(self, raw: str) -> None:
        _, element, path, stays, in_link, article, main, chrome = self.open[-1]
        if stays == KEEP:
            self.leaves.append((element, path, self.block, entities.unescape(raw), in_link, article, main, chrome))

    def started(self, name: str, attrs: str) -> None:
        if name == "body" and any(e[0] == "body" for e in self.open) or name == "html" and len(self.open) > 1:
            return
        self.close_implied(name)
        if name in BLOCKS:
            self.block += 1
        if name in EMPTY:
            if name == "br":
                self.text("\n")
            return
        _, above, path, stays, in_link, article, main, chrome = self.open[-1]
        said = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(attrs)} if attrs else {}
        words = {w.lower() for w in NAME_PART.findall(f"{said.get('class', '')} {said.get('id', '')}")} if name in NAMED and said else set()
        number = len(self.parent)
        self.parent.append(above)
        self.name.append(name)
        if name in HEADINGS and stays == HEADINGS_ONLY:
            stays = KEEP
        elif stays == KEEP:
            roles = set(said.get("role", "").lower().split())
            if name in NEVER or roles & ROLES or words & READERS:
                stays = DROP
            elif name == "header" or "header" in words and name != "article" and article >= 0:
                stays = HEADINGS_ONLY if article >= 0 or main >= 0 else DROP
            elif name == "form" or name != "article" and words & CHROME:
                self.chrome_up.append(chrome)
                self.chrome_has_heading.append(False)
                chrome = len(self.chrome_up) - 1
            if stays == KEEP and (name in ("article", "main", "h1") or "main" in roles):
                up = chrome
                while up > 0:
                    self.chrome_has_heading[up] = True
                    up = self.chrome_up[up]
            if stays == KEEP and name == "article" and article < 0:
                article = number
            if stays == KEEP and (name == "main" or "main" in roles) and main < 0:
                main = number
        label = f"{name}.{min(words)}" if words else name
        self.open.append((name, number, (*path, label), stays, in_link or name == "a", article, main, chrome))

    def close_implied(self, name: str) -> None:
        """End what the start of name ends: a paragraph, or an element that can't hold it."""
        for k in range(len(self.open) - 1, 0, -1):
            held = self.open[k][0]
            if held == "p" and name in ENDS_P or name in CLOSED_BY.get(held, ()):
                del self.open[k:]
                self.block += 1
                if held == "p":
                    return
            elif held in FENCES:
                return

    def ended(self, name: str) -> None:
        if name in BLOCKS:
            self.block += 1
        if name == "br":
            self.text("\n")
        inline = name not in BLOCKS
        for k in range(len(self.open) - 1, 0, -1):
            held = self.open[k][0]
            if held == name:
                if name not in ("body", "html"):
                    del self.open[k:]
                return
            if inline and held in FENCES:
                return


def likeness(a: tuple, b: tuple) -> float:
    """Share of labels that two paths begin with together."""
    same = 0
    for x, y in zip(a, b):
        if x != y:
            break
        same += 1
    return 2 * same / (len(a) + len(b)) if a or b else 1.0


def smoothed(values: list[float], paths: list[tuple]) -> list[float]:
    known, out = {}, []
    for i, own in enumerate(paths):
        total = weight = 0.0
        for j in range(max(0, i - 2), min(len(paths), i + 3)):
            pair = own, paths[j]
            if pair not in known:
                known[pair] = likeness(*pair)
            w = NEAR[abs(i - j)] * known[pair]
            total, weight = total + w * values[j], weight + w
        out.append(total / weight)
    return out


def scaled(values: list[float]) -> list[float]:
    """Values by their largest, kept off 0 and 1 so that evidence can be combined."""
    most = max(values)
    return [0.05 + 0.9 * v / most if most > 0 else 0.5 for v in values]


def content_paths(leaves: list[tuple]) -> set[tuple]:
    """Paths whose fused ratio reaches the threshold; leaves are (path, text, in link), none blank."""
    count, chars, marks, linked = defaultdict(int), defaultdict(int), defaultdict(int), defaultdict(int)
    for path, text, in_link in leaves:
        size = len("".join(text.split()))
        count[path] += 1
        chars[path] += size
        marks[path] += len(MARKS.findall(text))
        linked[path] += size if in_link else 0
    paths = [leaf[0] for leaf in leaves]
    plain = {p: 1 - linked[p] / chars[p] for p in count}
    text_ratio = scaled(smoothed([chars[p] / count[p] * plain[p] for p in paths], paths))
    mark_ratio = scaled(smoothed([marks[p] / count[p] * plain[p] for p in paths], paths))
    fused = [t * m / (t * m + (1 - t) * (1 - m)) for t, m in zip(text_ratio, mark_ratio)]
    sums = defaultdict(float)
    for p, f in zip(paths, fused):
        sums[p] += f
    means = {p: sums[p] / count[p] for p in count}
    mean = sum(fused) / len(fused)
    spread = math.sqrt(sum((f - mean) ** 2 for f in fused) / len(fused))
    bound = min(spread, max(means.values()) / 2)
    return {p for p, v in means.items() if v >= bound}


def region(page: Page, leaves: list[tuple], chosen: set[tuple]) -> list[bool]:
    """For each leaf whether the content holds it."""
    mass = [len(leaf[3].strip()) if leaf[1] in chosen else 0 for leaf in leaves]
    total = sum(mass)
    for field in (5, 6):  # article, then main
        holds = defaultdict(int)
        for leaf, m in zip(leaves, mass):
            holds[leaf[field]] += m
        holds.pop(-1, None)
        taken = {e for e, m in holds.items() if m > 0}
        if sum(holds.values()) * 2 >= total and taken:
            return [leaf[field] in taken for leaf in leaves]
    below, plain, linked = ([0] * len(page.parent) for _ in range(3))
    for leaf, m in zip(leaves, mass):
        below[leaf[0]] += m
        (linked if leaf[4] else plain)[leaf[0]] += len(leaf[3].strip())
    for e in range(len(below) - 1, 0, -1):
        for sums in (below, plain, linked):
            sums[page.parent[e]] += sums[e]
    top = max((e for e in range(len(below)) if below[e] >= 0.9 * total), default=0)
    while page.name[top] in HEADINGS or page.name[top] == "p" or page.name[top] not in BLOCKS and top > 0:
        top = page.parent[top]
    out = []
    for leaf in leaves:
        e, child = leaf[0], -1
        while e != top and e > 0:
            e, child = page.parent[e], e
        # Boxes without selected text aren't content, nor are lists and tables of links.
        chrome = child >= 0 and not below[child] and (page.name[child] in ("div", "section") or linked[child] > plain[child])
        out.append(e == top and not chrome)
    return out


def main_text(html: str | None) -> str:
    """The main text of one page."""
    if not html:
        return ""
    page = Page(html)
    size, total = [0] * len(page.chrome_up), 0
    for leaf in page.leaves:
        n = len(leaf[3].strip())
        total += n
        up = leaf[7]
        while up > 0:
            size[up] += n
            up = page.chrome_up[up]
    gone = [False] * len(size)
    for c in range(1, len(size)):
        gone[c] = gone[page.chrome_up[c]] or not (page.chrome_has_heading[c] and 2 * size[c] > total)
    leaves = [leaf for leaf in page.leaves if not gone[max(leaf[7], 0)]]
    told = [(leaf[1], leaf[3], leaf[4]) for leaf in leaves if leaf[3].strip()]
    if not told:
        return ""
    blocks = defaultdict(list)
    for leaf, kept in zip(leaves, region(page, leaves, content_paths(told))):
        if kept:
            blocks[leaf[2]].append(leaf[3])
    texts = [" ".join("".join(parts).split()) for _, parts in sorted(blocks.items())]
    return "\n\n".join(t for t in texts if t)


def extract(pages: DataFrame, *, html: str = "html", text: str = "text", keep_html: bool = True) -> DataFrame:
    """pages with the main text of each; keep_html=False leaves the source column out."""
    bounded_batches(pages.sparkSession)
    rows = without(pages, *({text} - {html}))
    kept = without(rows, html) if text == html or not keep_html else rows
    # Columns by place: their names may hold anything.
    places = [f"c{i}" for i in range(len(kept.columns))]
    given = rows.select(*[F.col(f"`{c}`").alias(p) for c, p in zip(kept.columns, places)], F.col(f"`{html}`").alias("html"))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = pa.array([main_text(h.as_py()) for h in b.column("html")], pa.string())
            yield pa.RecordBatch.from_arrays([*[b.column(p) for p in places], texts], names=[*places, "text"])

    found = given.mapInArrow(run, ", ".join(filter(None, [fields(given.drop("html")), "text string"])))
    return found.toDF(*kept.columns, text)


def op11_tag_path_text(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages, keep_html=False).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op11_sql() -> str:
    """What the given pages hold between the tags of their article, said without ratios: each has
    one article of headings, paragraphs, bold text and line breaks."""
    return r"""
WITH inside AS (
  SELECT page_id, url, regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(?:</article>|<footer|$)', 1), '<[^>]*$', '') AS s
  FROM pages),
cut AS (
  SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(s, '</?(?:p|h1)>', chr(1), 'g'), '<br>', ' ', 'g'), '<[^>]*>', '', 'g') AS s
  FROM inside),
decoded AS (
  SELECT page_id, url, regexp_replace(replace(replace(replace(replace(s, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', ''''), '&amp;?', '&', 'g') AS s
  FROM cut),
joined AS (
  SELECT page_id, url, array_to_string(list_filter(list_transform(string_split(s, chr(1)), lambda x : trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x : x <> ''), chr(10) || chr(10)) AS text
  FROM decoded)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM joined"""
