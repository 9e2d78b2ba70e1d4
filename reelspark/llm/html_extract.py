"""Main text of web pages by the maximum-scoring subsequence of words and tags.

A page becomes a sequence of text and tags: words score the weight of where they stand, a tag costs.
One linear scan finds the contiguous region of the largest sum. It is applied from the inside out: a
part (a ``div``, list, table, form, anything with a name) is first reduced to its own best region and
then counts with that region's sum in the part around it, so an advert in the middle of an article
offers nothing and does not tear it apart. Nothing but a scan leaves text out; scripts and the like
are no text.

Weights come from labelled pages: those that mark their content themselves by one ``<article>`` or
``<main>``. They are log-odds of the words of a block, of a tag, or of a name (a word in class, id or
role), inside against outside, with prior counts for what the labelled pages do not show.
"""

from __future__ import annotations

import heapq
import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark import scratch
from reelspark.llm.sampling import about

#: Labelled pages that weights are fitted on, at most (in expectation; chosen by hash of the html).
MAX_LABELLED = 5_000
#: The fewest words under a name that is learnt, on the labelled pages together.
NAME_WORDS = 200
#: Prior words and tags per place.
PRIOR = 30.0
MOST, LEAST_WORD, LEAST_TAG = 3.0, 0.2, 0.001
#: Weight of a word inside the page's only article, at least; log-odds from which a name speaks against its part.
MARKED_WORD, AGAINST = 1.0, -1.5
#: A part whose name speaks against it counts all the same if the text elsewhere is less than this share of its own
#: (of one with a plain name: and if it has the page's main heading). A mark counts unless the text outside is that many times its own.
SPARE, SPARE_PLAIN, OUTSIDE = 0.25, 0.1, 4

#: Elements whose content is no text: code, controls, and what is shown by other means. The fallback of an ``object`` and the lettering of an
#: ``svg`` drawing are left out with them; ``math`` is text.
_RAW = ("script", "style", "noscript", "template", "svg", "iframe", "object", "select", "button", "textarea", "canvas", "audio", "video", "title", "head")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Blocks that articles are made of.
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre figure figcaption table caption thead tbody tfoot tr th td hr details summary".split())
#: Elements that are scanned by themselves.
_PARTS = frozenset("article aside center details dialog dir div dl fieldset figure footer form header hgroup main menu nav ol search section table ul".split())
#: Blocks that hold text, not parts: a name of several words says what they are about.
_LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 td th dt dd blockquote pre figcaption caption summary".split())
#: Elements that stand for parts that are not the article; forms are also put around whole pages.
_NOISE_TAGS = frozenset("nav header footer aside menu dialog search".split())
_FORM_TAGS = frozenset("form fieldset".split())
#: Words in class, id or role that stand for parts that are not the article: those that say so plainly, and those with other uses.
_PLAIN = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored cookie cookies consent gdpr sidebar sidebars menu menus nav navbar"
    " navigation breadcrumb breadcrumbs comment comments commentlist disqus related recommended recommendations footer masthead share sharing social"
    " newsletter subscribe subscription signup login pager pagination contentinfo outbrain taboola".split()
)
_DOUBTFUL = frozenset(
    "promo promotion banner notice notices alert popup modal overlay widget respond reply replies discussion header search toc skip toolbar copyright"
    " legal disclaimer complementary tags hidden".split()
)
#: Words of compound names that say how a part is built and not what is in it.
_BUILT = frozenset(
    "area articles bar block blocks box btn button buttons card cards cell col column container content cta entry form grid group holder icon icons inner item items"
    " left link links list module outer panel placeholder post posts right row rows section slot stories strip top bottom unit widget widgets wrap wrapper".split()
)
#: Quotes count after an equals sign only; elsewhere a tag ends at the next >.
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>=]++|=\s*+(?:"[^"]*"|'[^']*')|=)*+)>""", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'])(class|id|role|aria-label|style|hidden)(?=[\s=/]|$)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_HREF = re.compile(r"""(?:^|\s)href\s*=""", re.I)
_END_RAW = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in _RAW}
_MARK = re.compile(r"<(/?)(article|main)\b", re.I)
_ROLE_MAIN = re.compile(r"""\srole\s*=\s*["']?main\b""", re.I)
_CLOSES_P = _BLOCK - {"body", "html"}
#: Blocks that end at the next of their kind.
_CLOSES_SAME = frozenset("li dd dt td th tr option".split())
#: Words that say of a whole layout whether it has the part named next.
_ABOUT_LAYOUT = frozenset("has with no without".split())
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


def _names(attributes: str) -> tuple[tuple[str, ...], ...]:
    """The names of an element, each as its words: ``class="top-nav siteAd"`` gives (top, nav) and (site, ad).

    A word after has, with, no or without, and the words between, are about the layout and left out.
    """
    out = []
    for kind, *values in _ATTRIBUTE.findall(attributes):
        value, kind = "".join(values), kind.lower()
        if kind == "hidden":
            out.append(("hidden",))
        elif kind == "style":
            if re.search(r"display\s*:\s*none", value, re.I):
                out.append(("hidden",))
        else:
            for name in value.split() if kind in ("class", "role") else [value]:
                words = [w.lower() for w in _WORDS.findall(name)]
                about = next((k for k, w in enumerate(words) if w in _ABOUT_LAYOUT), None)
                if words := words[:about]:
                    out.append(tuple(words))
    return tuple(out)


def _mark_of(page: str) -> str:
    """By what the page marks its content: its only outermost ``article``, else ``main``, else ``role``; empty if by nothing."""
    depth, outermost = {"article": 0, "main": 0}, {"article": 0, "main": 0}
    for m in _MARK.finditer(page):
        name = m[2].lower()
        if m[1]:
            depth[name] = max(0, depth[name] - 1)
        else:
            outermost[name] += depth[name] == 0
            depth[name] += 1
    for name in ("article", "main"):
        if outermost[name] == 1:
            return name
    return "role" if not outermost["main"] and len(_ROLE_MAIN.findall(page)) == 1 else ""


class Part:
    """An element that is scanned by itself: the part around it, its tag and names, its own words outside links."""

    __slots__ = ("outer", "tag", "names", "inside", "words", "heading")

    def __init__(self, outer: int, tag: str, names: tuple[tuple[str, ...], ...], inside: bool):
        self.outer, self.tag, self.names, self.inside = outer, tag, names, inside
        self.words, self.heading = 0, False


def parse(page: str) -> tuple[list[tuple], list[Part], int]:
    """(events, parts, number of the part that is the mark or -1).

    Events: ("text", text, number of words, block, part), where the block of a linked text ends in
    ``>a``; ("tag", name, part); ("open", part) and ("close", part). Part 0 is the page. Open paragraphs end where a block
    begins, items where the next begins; end tags without a beginning are passed over.
    """
    events: list[tuple] = []
    parts = [Part(-1, "", (), False)]
    mark_kind, mark = _mark_of(page), -1
    # Open elements: name, part (its own or the one around), block, linked, whether it is a part; how many are open by name.
    stack: list[tuple[str, int, str, bool, bool]] = [("", 0, "body", False, True)]
    open_names: dict[str, int] = {}

    def close() -> None:
        name, part, _, _, own = stack.pop()
        open_names[name] -= 1
        if own:
            events.append(("close", part))

    at, last_end = 0, page.rfind(">")
    while at < len(page):
        m = _TOKEN.search(page, at) if at <= last_end or page.find("<!--", at) >= 0 else None
        end = m.start() if m else len(page)
        if end > at:
            _, part, block, linked, _ = stack[-1]
            text = page[at:end]
            n = len(text.split())
            events.append(("text", text, n, block + ">a" if linked else block, part))
            if not linked:
                parts[part].words += n
        if not m:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if name in _END_RAW:
            if not m[1] and not m[3].rstrip().endswith("/"):
                stop = _END_RAW[name].search(page, at)
                at = stop.end() if stop else len(page) if name in ("script", "style") else at
            events.append(("tag", name, stack[-1][1]))
            continue
        is_block = name in _BLOCK
        if m[1]:
            if open_names.get(name):
                while stack[-1][0] != name and (is_block or stack[-1][0] not in _BLOCK):
                    close()
                if stack[-1][0] == name:
                    close()
            events.append(("tag", "/" + name, stack[-1][1]))
            continue
        if is_block and len(stack) > 1 and (stack[-1][0] == "p" if name in _CLOSES_P else False):
            close()
        if name in _CLOSES_SAME and stack[-1][0] == name or name == "a" and stack[-1][0] == "a":
            close()
        _, outer, block, linked, _ = stack[-1]
        events.append(("tag", name, outer))
        if name == "h1":
            parts[outer].heading = True
        if name in _VOID:
            continue
        names = _names(m[3]) if m[3] else ()
        own = name in _PARTS or bool(names) and name not in ("body", "html")
        if own:
            is_mark = mark < 0 and (name == mark_kind or mark_kind == "role" and ("main",) in names)
            if is_mark and name == "article" and any(len(w) == 1 and w[0] in _PLAIN for w in names):
                is_mark = False  # a comment or the like
            parts.append(Part(outer, "main" if ("main",) in names and name != "article" else name, names, is_mark or parts[outer].inside))
            outer = len(parts) - 1
            if is_mark:
                mark = outer
            events.append(("open", outer))
        elif not is_block and name != "a":
            continue
        stack.append((name, outer, name if is_block else block, linked or name == "a" and bool(_HREF.search(m[3])), own))
        open_names[name] = open_names.get(name, 0) + 1
    while len(stack) > 1:
        close()
    return events, parts, mark


def _prior(key: str) -> float:
    """Share of a block's, tag's or name's words that are content as far as nothing else is known."""
    if key.startswith("@"):
        return 0.05 if key[1:] in _PLAIN or key[1:] in _DOUBTFUL or key[1:2] == "<" else 0.5
    if key.startswith("<"):
        name = key.strip("</")
        return 0.9 if name not in _BLOCK or name in _PROSE else 0.44
    if key.endswith(">a"):
        return {"p>a": 0.8, "li>a": 0.25}.get(key, 0.38)
    return {"p": 0.9, "body": 0.6, "div": 0.6, "section": 0.7, "html": 0.1}.get(key, 0.8)


class Weights:
    """Scores from counts {key: (inside, outside)}; a key is a block, < and a tag, @ and a name, or @< and a tag as a name."""

    def __init__(self, counts: dict[str, tuple[int, int]]):
        self.counts, self.known, self.judged = counts, {}, {}

    def odds(self, key: str) -> float:
        if key not in self.known:
            inside, outside = self.counts.get(key, (0, 0))
            p = _prior(key)
            odds = math.log((inside + PRIOR * p) / (outside + PRIOR * (1 - p)))
            self.known[key] = max(-MOST, min(MOST, odds))
        return self.known[key]

    def word(self, block: str) -> float:
        odds = self.odds(block)
        return max(odds, LEAST_WORD) if odds > 0 else odds

    def tag(self, name: str) -> float:
        """Never positive: the less a tag is seen in content, the more it costs."""
        return min(-LEAST_TAG, self.odds("<" + name))

    def against(self, part: Part, in_article: bool) -> tuple[float, bool] | None:
        """What speaks against a part: its log-odds, and whether plainly; None if nothing does."""
        key = (part.tag, part.names, in_article)
        if key not in self.judged:
            self.judged[key] = self._against(*key)
        return self.judged[key]

    def _against(self, tag: str, names: tuple[tuple[str, ...], ...], in_article: bool) -> tuple[float, bool] | None:
        if tag in ("main", "body", "html"):
            return None
        found = []
        if (tag in _NOISE_TAGS and not (tag == "header" and in_article)) or tag in _FORM_TAGS:
            if (odds := self.odds("@<" + tag)) < AGAINST:
                found.append((odds, tag in _NOISE_TAGS))
        for words in names:
            bad = [w for w in words if self.odds("@" + w) < AGAINST]
            whole = len(bad) == len(words)
            # In an article prose has names of its own, such as legal-analysis: there every word must say so, but for those on the build.
            told = whole or (all(w in bad or w in _BUILT for w in words) if in_article else tag not in _LEAVES and tag != "article")
            if bad and told and (whole or tag != "article"):
                found.append((min(self.odds("@" + w) for w in bad), whole and any(w in _PLAIN for w in bad)))
        return (min(o for o, _ in found), any(s for _, s in found)) if found else None


def best_region(scores: list[float]) -> tuple[int, int]:
    """Bounds of the contiguous region of the largest positive sum, the first of equals; empty if none is positive."""
    best, bounds, total, start = 0.0, (0, 0), 0.0, 0
    for k, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, k
        total += s
        if total > best:
            best, bounds = total, (start, k + 1)
    return bounds


def _judged(parts: list[Part], mark: int, weights: Weights) -> tuple[list[float | None], bool]:
    """For each part what its words score because of names, or None; and whether the mark counts.

    Names never silence a page: the part with most words is spared if there is next to nothing elsewhere
    (see ``SPARE``), then the parts in it are looked at in the same way.
    """
    n = len(parts)

    def suspects(bounded: bool) -> tuple[list[tuple[float, bool] | None], list[int]]:
        own: list[tuple[float, bool] | None] = [None] * n
        near = [-1] * n  # the nearest part, itself included, that something speaks against
        for k in range(1, n):
            p = parts[k]
            own[k] = None if k == mark else weights.against(p, parts[p.outer].inside or parts[p.outer].tag == "article")
            near[k] = k if own[k] else -1 if bounded and k == mark else near[p.outer]
        return own, near

    own, near = suspects(mark >= 0)
    marked = mark >= 0
    if marked:
        outside = sum(p.words for k, p in enumerate(parts) if not p.inside and near[k] < 0)
        if outside > OUTSIDE * sum(p.words for p in parts if p.inside):
            marked = False
            own, near = suspects(False)

    above = [-1] * n
    clear, total, heading = [0] * n, [0] * n, [False] * n
    inner: list[list[int]] = [[] for _ in range(n)]
    content, outermost = 0, []
    for k, p in enumerate(parts):
        if near[k] >= 0:
            clear[near[k]] += p.words
            heading[near[k]] |= p.heading
        elif p.inside or not marked:
            content += p.words
        if near[k] == k:
            above[k] = -1 if marked and k == mark else near[p.outer]
            if above[k] >= 0:
                inner[above[k]].append(k)
            elif p.inside or not marked:
                outermost.append(k)
    for k in range(n - 1, -1, -1):
        total[k] += clear[k]
        if above[k] >= 0:
            total[above[k]] += total[k]
            heading[above[k]] |= heading[k]
    heap = [(-total[k], k) for k in outermost]
    heapq.heapify(heap)
    while heap:
        size, k = heapq.heappop(heap)
        plain = own[k][1]
        if content < -size * (SPARE_PLAIN if plain else SPARE) and (heading[k] or not plain):
            own[k] = None
            content += clear[k]
            for x in inner[k]:
                heapq.heappush(heap, (-total[x], x))
    noise: list[float | None] = [None] * n
    for k in range(1, n):
        around = None if marked and k == mark else noise[parts[k].outer]
        mine = own[k][0] if own[k] else None
        noise[k] = mine if around is None else around if mine is None else min(around, mine)
    return noise, marked


class _Scan:
    """The entries of a part so far: their scores, and what they offer (a block's text, a part's offers, or nothing)."""

    __slots__ = ("scores", "offers", "block", "texts")

    def __init__(self):
        self.scores: list[float] = []
        self.offers: list = []
        self.block, self.texts = 0.0, []

    def add(self, score: float, offer=None) -> None:
        self.scores.append(score)
        self.offers.append(offer)

    def end_block(self) -> None:
        """A block is whole: its own scan keeps all of it or nothing."""
        if self.texts:
            first, last = best_region([self.block])
            self.add(self.block, "".join(self.texts) if last > first else None)
            self.block, self.texts = 0.0, []

    def result(self) -> tuple[float, list]:
        self.end_block()
        first, last = best_region(self.scores)
        return sum(self.scores[first:last]), [x for x in self.offers[first:last] if x is not None]


def main_text(page: str | None, weights: Weights) -> str:
    """The blocks that the scans keep, one a line; references decoded, white space single and trimmed."""
    events, parts, mark = parse(page or "")
    noise, marked = _judged(parts, mark, weights)
    open_scans = [_Scan()]
    for event in events:
        kind, scan = event[0], open_scans[-1]
        if kind == "text":
            _, text, n, block, part = event
            if noise[part] is not None:
                weight = noise[part]
            elif marked:
                weight = max(MARKED_WORD, weights.word(block)) if parts[part].inside else -MOST
            else:
                weight = weights.word(block)
            scan.texts.append(text)
            scan.block += n * weight
        elif kind == "tag":
            name, part = event[1], event[2]
            cost = -LEAST_TAG if noise[part] is not None or marked and parts[part].inside else weights.tag(name)
            if name.lstrip("/") in _BLOCK:
                scan.end_block()
                scan.add(cost)
            elif scan.texts:
                scan.block += cost
                if name in ("br", "wbr", "/br"):
                    scan.texts.append(" ")
        elif kind == "open":
            open_scans.append(_Scan())
        else:
            total, offers = open_scans.pop().result()
            scan = open_scans[-1]
            if parts[event[1]].tag in _BLOCK or any(not isinstance(x, str) for x in offers):
                scan.end_block()
                scan.add(total, offers or None)
            elif offers:
                scan.texts += offers
                scan.block += total
    blocks, rest = [], [open_scans[0].result()[1]]
    while rest:
        top = rest.pop()
        if isinstance(top, str):
            if block := " ".join(html.unescape(top).split()):
                blocks.append(block)
        else:
            rest += reversed(top)
    return "\n".join(blocks)


def _counts(page: str, counts: dict[str, list[int]]) -> None:
    """Add the words of a page that marks its content to ``counts`` {key: [inside, outside]}.

    A part's words count for its names. Blocks and tags are counted only where no name speaks against the part.
    """
    events, parts, mark = parse(page)
    if mark < 0:
        return
    noise, _ = _judged(parts, -1, Weights({}))
    words = [[0, 0] for _ in parts]
    for event in events:
        if event[0] == "text":
            _, _, n, key, part = event
            words[part][not parts[part].inside] += n
        elif event[0] == "tag":
            _, name, part = event
            n, key = 1, "<" + name
        else:
            continue
        if n and noise[part] is None:
            counts.setdefault(key, [0, 0])[not parts[part].inside] += n
    for k in range(len(parts) - 1, 0, -1):
        p = parts[k]
        for own in {w for words_ in p.names for w in words_} | ({"<" + p.tag} if p.tag in _NOISE_TAGS | _FORM_TAGS else set()):
            for i in (0, 1):
                counts.setdefault("@" + own, [0, 0])[i] += words[k][i]
        for i in (0, 1):
            words[p.outer][i] += words[k][i]


def fit(pages: DataFrame, html_col: str = "html", max_labelled: int = MAX_LABELLED) -> Weights:
    """Weights from the pages that mark their content by one article or main element."""
    page = F.col(html_col).cast("string")
    labelled = pages.select(page.alias("html")).filter(F.regexp_count(F.col("html"), F.lit(r"(?i)<(?:article|main)\b")) == 1)
    labelled = labelled.filter(about(F.xxhash64("html"), max_labelled, labelled.count()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[int]] = {}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                _counts(text, counts)
        rows = list(counts.items())
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.string()), *(pa.array([v[i] for _, v in rows], pa.int64()) for i in (0, 1))], ["key", "inside", "outside"])

    sums = labelled.mapInArrow(count, "key string, inside long, outside long").groupBy("key").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
    sums = scratch.written(sums, "html-counts")
    known = set(_BLOCK) | set(_VOID) | set(_RAW) | {"a", "b", "i", "em", "strong", "span", "u", "s", "small", "sub", "sup", "code", "font", "label", "abbr", "cite", "q", "time", "mark"}
    # Blocks and tags are those of HTML, a few hundred; names are those of the labelled sample.
    is_name = F.col("key").startswith("@")
    names = F.regexp_extract("key", r"^</?([a-z0-9]+)$", 1)
    kept = sums.filter(~is_name & (~F.col("key").startswith("<") | names.isin(*sorted(known)))).collect()
    seen = F.col("inside") + F.col("outside")
    kept += sums.filter(is_name & (seen >= NAME_WORDS)).collect()
    return Weights({r["key"]: (r["inside"], r["outside"]) for r in kept})


def extract(pages: DataFrame, weights: Weights, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars.

    Null, empty and textless html give an empty text; null ids and urls are carried along, repeated
    rows kept. A page without any marked content is judged by the same weights. Other columns are
    not read. Narrow: a page at a time. Empty in, empty out.
    """

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p, weights) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(convert, "page_id long, url string, text string, n_chars long")


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract(pages, fit(pages))
