"""Main text of pages by equivalence classes of template tokens.

Tokens of a page are its tags, told apart by their path of open elements, and
its text nodes with their path. Over the pages of one host, tokens with the
same occurrence vector (how often each page has them) form a class: they come
from the same piece of the host's template. The tags that every page has once
are the skeleton; its gaps locate every other token, so that equal tokens in
different gaps have different roles. Classes of roles that are large and
frequent enough and lie in one gap are valid and nested there. What lies
between template tokens are slots: text that no valid class holds.

Occurrence vectors are never gathered: a vector is known by an exclusive-or of
hashes of (body, count), which combines on the map side, so a host with a third
of all pages is no burden. What is left per host are the tokens that at least
half of its bodies share, which is bounded by the size of a page.

Pages of a host with the same body, the text that only the elements' kinds
choose, count once, by one representative: copies of an article never make it
a template, and no row cancels another in a vector.

The main text are the slots, on every page: template text goes inside articles
too. Menus, page headers, footers, sidebars, notices, adverts, forms and reader
comments are elements of these kinds by tag, role, class or id and go as well,
and where a page has `article` or `main` elements, so does what lies outside.

Defined results: NULL and empty pages give an empty text; a NULL or unusual URL
belongs to the host ''; hosts with too few different bodies have an empty
template, so only the elements' kinds decide; bodies that differ anywhere in
their text count as different; broken markup is read leniently (unknown end
tags are skipped, open elements end with their parents, a tag without an end is
text); an empty table gives no rows. A page takes time and memory in proportion
to its length, however deep its elements are nested.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import table
from ledgerlake.session import materialise

MIN_PAGES = 3  # support of a valid class, in different bodies
MIN_TOKENS = 3  # size of a valid class
SHARE = 0.5  # of a host's bodies

# fixed values of the markup language
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg textarea title".split())
BLOCK = frozenset("""address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul""".split())
# elements that end an open paragraph or item of their kind
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LISTS = frozenset("ul ol dl table select".split())

# kinds of elements that are not main text
APART = frozenset("nav footer aside form script style noscript template iframe svg button select textarea dialog menu head input".split())
APART_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
APART_WORDS = frozenset("""ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments cookie cookies consent
disclaimer footer gdpr header login masthead menu menus modal nav navbar navigation newsletter notice notices pagination popup promo related
replies responses share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget widgets""".split())


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)
    return found


# elements over which the end of an open paragraph is not sought, and those at which an open item is sought
BARRIERS = frozenset("article section div td li".split())
ITEMS = frozenset(ENDS) | LISTS


# an open element: tag, path (a hash of the labels from the outermost element to this one), apart, in an article, place of the
# innermost open p with no barrier above it (-1 where there is none), place of the innermost item or list
PAGE = ("", 0, False, False, -1, -1)


class Reader:
    """Events of a page in page order, with what encloses them."""

    def __init__(self) -> None:
        import re
        self.markup = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)(?:([^>\"']{0,99})>)?", re.S)
        self.special = re.compile(r"[>\"']")
        self.attribute = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
        self.word = re.compile(r"[a-z]+|[0-9]+")
        self.raw_end = {tag: re.compile(f"</{tag}", re.I | re.A) for tag in RAW}

    def apart(self, tag: str, attributes: str, inside_article: bool) -> tuple[bool, str]:
        """(not main text, label of the element in paths)."""
        label, apart = tag, tag in APART or (tag == "header" and not inside_article)
        if attributes.strip():
            for name, value in self.attribute.findall(attributes):
                value = value.strip("\"'").lower()
                if name.lower() == "role":
                    apart = apart or (value in APART_ROLES and not (inside_article and value == "banner"))
                    continue
                label += ("." if name.lower() == "class" else "#") + value
                if tag not in ("body", "html", "article", "main"):
                    words = value.split() if inside_article else self.word.findall(value)
                    apart = apart or bool(APART_WORDS.intersection(words))
        return apart, label

    def _tag_end(self, html: str, at: int, known: dict) -> int:
        """Place after the tag whose attributes begin at `at`, -1 where it has no end. Quoted values may hold '>'.
        `known` keeps the last special character found and the quotes that lead to no end, so that a page is searched once."""
        met = []
        while True:
            lo, hi = known["next"]
            if not lo <= at <= hi:
                m = self.special.search(html, at)
                hi = m.start() if m else len(html)
                known["next"] = at, hi
            if hi == len(html) or hi in known["endless"]:
                break
            if html[hi] == ">":
                return hi + 1
            met.append(hi)
            close = html.find(html[hi], hi + 1)
            if close < 0:
                break
            at = close + 1
        known["endless"].update(met)
        return -1

    def events(self, html: str) -> Iterator[tuple]:
        """(kind, path, apart, in_article, text, blocks so far)."""
        import html as entities
        import xxhash
        name_of = xxhash.xxh3_64_intdigest
        stack: list[tuple] = []
        count: Counter = Counter()  # open elements by tag
        known = {"next": (1, 0), "endless": set()}
        top, at, block, pos, end = PAGE, 0, 0, 0, len(html)
        search, unescape = self.markup.search, entities.unescape

        def close(down_to: int) -> tuple:
            for e in stack[down_to:]:
                count[e[0]] -= 1
            del stack[down_to:]
            return stack[-1] if stack else PAGE

        while True:
            m = search(html, pos) if pos < end else None
            if m:
                closing, tag, attributes = m.groups()
                after = m.end()
                if tag is not None and attributes is None:  # quotes, or many attributes
                    after = self._tag_end(html, m.end(), known)
                    if after < 0:  # not a tag: text
                        pos = m.start() + 1
                        continue
                    attributes = html[m.end():after - 1]
            text = html[at:m.start() if m else end]
            if text:
                if text.isspace():
                    yield "space", top[1], top[2], top[3], " ", block
                else:
                    yield "text", top[1], top[2], top[3], unescape(text), block
            if not m:
                return
            pos = at = after
            if tag is None:
                continue
            tag = tag.lower()
            is_block = tag in BLOCK
            if is_block:
                block += 1
            if closing:
                if count[tag]:
                    top = close(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag))
                continue
            if is_block and top[4] >= 0:
                top = close(top[4])
            if tag in ENDS:
                k = top[5]
                while k >= 0 and stack[k][0] not in LISTS:
                    if stack[k][0] in ENDS[tag]:
                        top = close(k)
                        break
                    k = stack[k - 1][5] if k else -1
            apart, label = self.apart(tag, attributes, top[3])
            path, apart, inside = name_of(label.encode("utf-8", "surrogatepass"), top[1]), top[2] or apart, top[3] or tag in ("article", "main")
            yield "open", path, apart, inside, "", block
            if tag == "br":
                yield "space", top[1], top[2], top[3], " ", block
            if tag in VOID or attributes.endswith("/") or attributes.rstrip().endswith("/"):
                continue
            if tag in RAW:
                stop = self.raw_end[tag].search(html, pos)
                pos = at = end if stop is None else html.find(">", stop.end()) + 1 or end
                continue
            here = len(stack)
            top = (tag, path, apart, inside, here if tag == "p" else -1 if tag in BARRIERS else top[4], here if tag in ITEMS else top[5])
            stack.append(top)
            count[tag] += 1


def _hash(text: str) -> int:
    import xxhash
    h = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >= 1 << 63 else h


def text_token(path: int, text: str) -> int:
    return _hash(f"{path}\n{' '.join(text.split())}")


def located(tokens: list[tuple[int, bool]], skeleton: dict[int, int]) -> Iterator[tuple[int, float]]:
    """(role, place) of a page's tokens (token, is text): the skeleton's tags are marks, others lie in the gap after the last mark."""
    gap = -1
    for token, is_text in tokens:
        mark = None if is_text else skeleton.get(token)
        if mark is None:
            yield _hash(f"{gap} {token}"), gap + 0.5
        else:
            gap = mark
            yield token, float(gap)


def tokens_of(events: list[tuple]) -> list[tuple[int, bool]]:
    """(token, is text) of the events that are no space."""
    return [(text_token(e[1], e[4]), True) if e[0] == "text" else (e[1] - (1 << 64) if e[1] >> 63 else e[1], False) for e in events if e[0] != "space"]


def bodies(pages: DataFrame) -> DataFrame:
    """(host, body, tokens, texts): the tokens of one page of each different body, of (host, page, html)."""
    schema = "host string, body long, page long, tokens array<long>, texts array<boolean>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            rows = []
            for html in batch.column("html").to_pylist():
                events = list(reader.events(html))
                rows.append((_hash(joined(chosen(events))), tokens_of(events)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"), pa.array([r[0] for r in rows], pa.int64()), batch.column("page"),
                 pa.array([[t for t, _ in r[1]] for r in rows], pa.list_(pa.int64())),
                 pa.array([[x for _, x in r[1]] for r in rows], pa.list_(pa.bool_()))],
                names=["host", "body", "page", "tokens", "texts"])

    return pages.select("host", "page", "html").mapInArrow(run, schema).groupBy("host", "body").agg(
        F.min(F.struct("page", "tokens", "texts")).alias("one")).select("host", "body", "one.tokens", "one.texts")


def occurrences(found: DataFrame, by_role: bool) -> DataFrame:
    """(host, token, is_text, pages, total, vector, place) of the tags of (host, body, tokens, texts), or with
    the skeleton at hand of the roles of all tokens; rows combined within a batch."""
    schema = "host string, token long, is_text boolean, pages long, total long, vector long, place double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[tuple[str, int, bool], list] = {}
            skeletons = batch.column("skeleton").to_pylist() if by_role else [None] * batch.num_rows
            for host, body, tokens, texts, skeleton in zip(*(batch.column(c).to_pylist() for c in ("host", "body", "tokens", "texts")), skeletons):
                page = list(zip(tokens, texts))
                if by_role:
                    marks = {t: k for k, t in enumerate(skeleton)}
                    placed = [(role, x, place) for (role, place), (_, x) in zip(located(page, marks), page)]
                else:
                    placed = [(t, x, n / len(page)) for n, (t, x) in enumerate(page) if not x]
                seen: dict[tuple[int, bool], list] = {}
                for token, is_text, place in placed:
                    seen.setdefault((token, is_text), [0, place])[0] += 1
                for (token, is_text), (count, place) in seen.items():
                    row = held.setdefault((host, token, is_text), [0, 0, 0, 0.0])
                    row[0] += 1
                    row[1] += count
                    row[2] ^= _hash(f"{body} {count}")
                    row[3] += place
            keys, rows = list(held), list(held.values())
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()),
                 pa.array([k[2] for k in keys], pa.bool_()), *[pa.array([r[i] for r in rows], pa.int64()) for i in range(3)],
                 pa.array([r[3] for r in rows], pa.float64())],
                names=["host", "token", "is_text", "pages", "total", "vector", "place"])

    return found.mapInArrow(run, schema).groupBy("host", "token", "is_text").agg(
        F.sum("pages").alias("pages"), F.sum("total").alias("total"), F.bit_xor("vector").alias("vector"),
        F.sum("place").alias("place"))


def classes_of(tokens: pd.DataFrame) -> tuple[pd.DataFrame, list[pd.DataFrame]]:
    """(the root, all classes) of one host's frequent tokens, each in page order."""
    tokens = tokens.assign(at=tokens.place / tokens.pages).sort_values(["at", "token"])
    classes = [g for _, g in tokens.groupby(["vector", "pages", "total"], sort=False)]
    return max(classes, key=lambda g: (g.pages.iloc[0], g.total.iloc[0] == g.pages.iloc[0], len(g))), classes


def nested(tokens: pd.DataFrame) -> tuple[list[int], list[int]]:
    """(skeleton in page order, template text) of one host's frequent tokens.

    A class is valid if it is large enough; the class of the tokens that every
    page has once is the root, which no size is asked of. Other valid classes
    are nested into the gap of the root that their first token falls into; a
    class whose tokens lie in different gaps repeats across the page and is not
    part of one piece of template.
    """
    root, classes = classes_of(tokens)
    marks = root["at"].to_numpy()
    skeleton, text = root[~root.is_text].token.tolist(), root[root.is_text].token.tolist()
    for g in classes:
        if g is root or len(g) < MIN_TOKENS:
            continue
        gap = np.searchsorted(marks, g["at"].to_numpy(), side="right")
        if gap.min() == gap.max():
            skeleton += g[~g.is_text].token.tolist()
            text += g[g.is_text].token.tolist()
    return skeleton, text


def templates(pages: DataFrame) -> DataFrame:
    """(host, skeleton, text): the marks and the template text, by role, of each host that has a template."""
    def marks(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"host": [group.host.iloc[0]], "skeleton": [classes_of(group)[0].token.tolist()]})

    def run(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"host": [group.host.iloc[0]], "text": [nested(group)[1]]})

    found, _ = materialise(bodies(pages), "bodies")
    sizes = found.groupBy("host").agg(F.count("*").alias("host_bodies")).where(F.col("host_bodies") >= MIN_PAGES)

    def shared(counted: DataFrame) -> DataFrame:
        # at least half of the bodies hold each of these tokens, so a host has about two pages' worth at most
        return counted.where(F.col("pages") >= MIN_PAGES).join(sizes, "host").where(
            F.col("pages") >= F.col("host_bodies") * F.lit(SHARE))

    skeletons, _ = materialise(shared(occurrences(found, False)).groupBy("host").applyInPandas(
        marks, "host string, skeleton array<long>"), "skeletons")
    placed = found.join(skeletons, "host")
    text = shared(occurrences(placed, True)).groupBy("host").applyInPandas(run, "host string, text array<long>")
    return skeletons.join(text, "host")


def chosen(events: list[tuple]) -> list[tuple]:
    """The text and space events that their elements' kinds leave: inside the articles where there are any."""
    articles = any(kind == "open" and inside and not apart for kind, _, apart, inside, _, _ in events)
    return [e for e in events if e[0] != "open" and not e[2] and (e[3] or not articles)]


def joined(events: list[tuple]) -> str:
    """The events' text, a line per block."""
    blocks: list[tuple[int, list[str]]] = []
    for *_, text, block in events:
        if not blocks or blocks[-1][0] != block:
            blocks.append((block, []))
        blocks[-1][1].append(text)
    lines = (" ".join("".join(parts).split()) for _, parts in blocks)
    return "\n".join(line for line in lines if line)


def main_text(html: str, skeleton: dict[int, int], template: set[int], reader: Reader) -> str:
    """The slots that the skeleton locates, of the elements that can hold main text."""
    events = list(reader.events(html))
    if template:
        roles = located(tokens_of(events), skeleton)
        events = [e for e in events if e[0] == "space" or next(roles)[0] not in template or e[0] == "open"]
    return joined(chosen(events))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text) of each page."""
    src = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                       F.coalesce(F.col(html_col), F.lit("")).alias("html"), host_of(F.col(url_col)).alias("host"))
    found, _ = materialise(templates(src.select("host", F.xxhash64("page_id", "url").alias("page"), "html")), "templates")
    id_type = dict(pages.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            htmls, skeletons, known = (batch.column(c).to_pylist() for c in ("html", "skeleton", "template"))
            out = [main_text(h, {t: k for k, t in enumerate(s or ())}, set(t or ()), reader)
                   for h, s, t in zip(htmls, skeletons, known)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string())],
                                             names=["page_id", "url", "text"])

    return src.join(found.select("host", "skeleton", F.col("text").alias("template")), "host", "left") \
        .select("page_id", "url", "html", "skeleton", "template").mapInArrow(run, f"page_id {id_type}, url string, text string")


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
