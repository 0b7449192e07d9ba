"""Main text of web pages: markup roles, and a suffix array of each host's undecided text."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from carelake.llm.arrays import Prefixes, pieces, text_bytes, word_hashes
from carelake.session import stored

# A run of so many equal tokens on two pages of a host is boilerplate.
REPEATED_TOKENS = 8
# Pages of one host whose suffixes are sorted together.
HOST_PAGES = 256

# Element and attribute names of HTML and what they usually hold.
DROPPED = frozenset("head script style noscript template iframe object svg canvas nav footer aside form button select "
                    "textarea option dialog menu audio video".split())
HEADERS = frozenset(["header"])
MAIN = frozenset(["article", "main"])
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav "
                   "ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
FURNITURE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|sidebar|menu|nav\w*|breadcrumbs?|footer|header|masthead|"
    r"comments?|respond|disqus|cookies?|consent|notices?|newsletter|subscri\w*|popup|modal|share|sharing|social|related|"
    r"widget)(?:$|[\s_-])")
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)"
# Where an open element of this name ends at the start of one that cannot be inside it.
CLOSES = {"p": BLOCKS - {"br"}, "li": frozenset(["li"]), "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]),
          "th": frozenset(["td", "th", "tr"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
          "option": frozenset(["option"])}


# A comment or declaration, or a tag with its attributes; quoted values can hold any sign. One cut off ends the page.
MARKUP = re.compile(r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*(?:>|\Z)"
                    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(/?)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
# Elements whose class or id, unlike their name, gives way to an article inside.
WRAPPERS = frozenset(["div", "section"])
RAW_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])|\Z", re.I) for name in ("script", "style", "noscript", "template", "textarea")}


KEPT, NAMED, DROP = range(3)


def furniture(attributes: str) -> int:
    """Whether a tag's attributes say that its content is no main text: DROP, or NAMED if only its class or id does."""
    found = KEPT
    for name, *given in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), unescape("".join(given)).lower()
        if name == "hidden" or name == "role" and value in ROLES or name == "aria-hidden" and value == "true":
            return DROP
        if name in ("class", "id") and FURNITURE.search(value):
            found = NAMED
    return found


class Blocks:
    """Blocks of visible text of a page in order, with whether markup puts each in the article."""

    def __init__(self):
        self.open: list[tuple[str, int, bool, bool]] = []  # name, whether dropped from here on, in the article, saved
        self.names: Counter[str] = Counter()  # of what is open, so that stray end tags cost nothing
        self.blocks: list[tuple[str, bool, bool]] = []
        self.text: list[str] = []
        # Saved: kept as an article, inside what its class or id calls furniture.
        self.dropped, self.main, self.saved = KEPT, False, False

    def _break(self) -> None:
        if self.text:
            words = " ".join("".join(self.text).split())
            if words:
                self.blocks.append((words, self.main, self.saved))
            self.text = []

    def _start(self, tag: str, attributes: str) -> None:
        while self.open and tag in CLOSES.get(self.open[-1][0], ()):
            self._close(len(self.open) - 1)
        if tag in BLOCKS:
            self._break()
        if tag in VOID:
            return
        marked = DROP if tag in DROPPED or tag in HEADERS and not self.main else furniture(attributes) if attributes else KEPT
        if tag in MAIN or tag in ("html", "body"):
            marked = KEPT
        elif marked == NAMED and tag not in WRAPPERS:
            marked = DROP
        # A layout's class can hold a word of furniture. There an article counts that doesn't name itself so, too;
        # an article in an article is a comment on it.
        if tag in MAIN and self.dropped == NAMED and not self.names["article"] and furniture(attributes) == KEPT:
            self.dropped, self.saved = KEPT, True
        self.dropped, self.main = max(self.dropped, marked), self.main or tag in MAIN
        self.open.append((tag, self.dropped, self.main, self.saved))
        self.names[tag] += 1

    def _close(self, at: int) -> None:
        closed = [name for name, *_ in self.open[at:]]
        if any(name in BLOCKS for name in closed):
            self._break()
        del self.open[at:]
        self.names.subtract(closed)
        _, self.dropped, self.main, self.saved = self.open[-1] if self.open else ("", KEPT, False, False)

    def _end(self, tag: str) -> None:
        if self.names[tag]:
            # All that is looked at here is closed, so a page takes time in proportion to its tags.
            self._close(next(at for at in range(len(self.open) - 1, -1, -1) if self.open[at][0] == tag))
        elif tag in BLOCKS:
            self._break()

    def of(self, page: str) -> list[tuple[str, bool]]:
        at = 0
        while at < len(page):
            found = MARKUP.search(page, at)
            data = page[at:found.start() if found else len(page)]
            if data and not self.dropped:
                self.text.append(unescape(data) if "&" in data else data)
            if not found:
                break
            at = found.end()
            closing, tag, attributes, empty = found.groups()
            if not tag:
                continue
            tag = tag.lower()
            if closing:
                self._end(tag)
            else:
                self._start(tag, attributes)
                if tag in RAW_ENDS:
                    at = RAW_ENDS[tag].search(page, at).start()
        self._break()
        # Where the page has an article of its own, those in furniture are comments or teasers.
        own = any(main and not saved for _, main, saved in self.blocks)
        return [(text, main) for text, main, saved in self.blocks if not (own and saved)]


PARSED = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("article", T.StringType()),
    T.StructField("undecided", T.ArrayType(T.StringType()))])


def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task over (page_id, url, html): the article's text, or the blocks to be decided where no article is marked."""
    for batch in batches:
        articles, undecided = [], []
        for html in batch.column(2):
            blocks = Blocks().of(html.as_py() or "")
            article = [text for text, main in blocks if main]
            articles.append(" ".join(article))
            undecided.append([] if article else [text for text, _ in blocks])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(articles, pa.string()), pa.array(undecided, pa.list_(pa.string()))],
            names=PARSED.names)


def suffix_array(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order and ranks of all suffixes of a sequence of integers, by prefix doubling."""
    n = len(values)
    rank, width = np.unique(values, return_inverse=True)[1].astype(np.int64), 1
    while True:
        second = np.full(n, -1, np.int64)
        second[:max(n - width, 0)] = rank[width:]
        order = np.lexsort((second, rank))
        step = (rank[order[1:]] != rank[order[:-1]]) | (second[order[1:]] != second[order[:-1]])
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(step)])
        if n == 0 or rank.max() == n - 1 or width >= n:
            return order, rank
        width *= 2


def covered(values: np.ndarray, page: np.ndarray, least: int) -> np.ndarray:
    """Which tokens lie in a run of ``least`` tokens that another page has as well.

    Suffixes with ``least`` tokens in common are neighbours in the suffix array;
    their group counts if it holds two pages. Runs end at the page's end, where
    a token of its own stands.
    """
    n = len(values)
    if n < least:
        return np.zeros(n, bool)
    order, _ = suffix_array(values)
    # Equal beginnings of neighbours, compared token by token up to the length asked for.
    padded = np.concatenate([values, -1 - np.arange(least)])
    same = np.ones(n - 1, bool)
    for i in range(least):
        same &= padded[order[1:] + i] == padded[order[:-1] + i]
    group = np.concatenate([[0], np.cumsum(~same)])
    low = np.full(group[-1] + 1, np.iinfo(np.int64).max)
    high = np.full(group[-1] + 1, -1)
    np.minimum.at(low, group, page[order])
    np.maximum.at(high, group, page[order])
    return runs_at(order[(low < high)[group]], least, n)


def runs_at(starts: np.ndarray, least: int, n: int) -> np.ndarray:
    """Which of n tokens lie in the runs of ``least`` tokens with these starts."""
    out = np.zeros(n + 1, np.int64)
    np.add.at(out, starts, 1)
    np.add.at(out, np.minimum(starts + least, n), -1)
    return np.cumsum(out)[:n] > 0


WINDOWS = T.StructType([T.StructField("host", T.LongType()), T.StructField("window", T.LongType()), T.StructField("row", T.LongType()),
                        T.StructField("at", T.IntegerType())])


def window_rows(least: int):
    """A task over (row, host, text): the hash and place of every run of ``least`` tokens of each page."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, hosts = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            data, offsets = text_bytes(batch.column(2))
            for first, last in pieces(offsets):
                hashes, firsts = word_hashes(data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
                count = np.maximum(np.diff(firsts) - least + 1, 0)
                owner = np.repeat(np.arange(last - first), count)
                at = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
                begin = firsts[owner] + at
                found = Prefixes(hashes, "window").part(begin, begin + least)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hosts[first + owner]), pa.array(found.astype(np.int64)), pa.array(rows[first + owner]),
                     pa.array(at.astype(np.int32))], names=WINDOWS.names)

    return scan


def repeated_windows(pages: DataFrame, least: int) -> DataFrame:
    """Columns (row, host, undecided) -> (row, repeated): where runs of ``least`` tokens start that another page of the host has.

    Counts of hashes, with partial aggregates, so a host can have any number of pages.
    """
    windows = (pages.select("row", F.xxhash64("host").alias("host"), F.array_join("undecided", " ").alias("text"))
               .mapInArrow(window_rows(least), WINDOWS))
    several = stored(windows.groupBy("host", "window").agg(F.min("row").alias("low"), F.max("row").alias("high"))
                     .where("low < high").select("host", "window"), "repeated-windows")
    return windows.join(several, ["host", "window"]).groupBy("row").agg(F.collect_list("at").alias("repeated"))


def unique_runs(pages: pd.DataFrame, least: int = REPEATED_TOKENS) -> list[str]:
    """The texts of a host's pages without what is covered by repeated runs; token streams are joined in one array.

    ``repeated`` has the starts of runs in each page that repeat elsewhere on the host.
    """
    streams = [[word for block in blocks for word in block.split(" ")] for blocks in pages["undecided"]]
    words = pd.factorize(np.array([w for s in streams for w in s], dtype=object))[0] if any(streams) else np.zeros(0, np.int64)
    lengths = np.array([len(s) for s in streams])
    page = np.repeat(np.arange(len(streams)), lengths + 1)
    values = np.full(len(page), -1, np.int64)
    ends = np.cumsum(lengths + 1) - 1
    inside = np.ones(len(page), bool)
    inside[ends] = False
    values[inside] = words
    values[ends] = (words.max() + 1 if len(words) else 0) + np.arange(len(streams))  # a page's end is like no other token
    begins = ends - lengths
    elsewhere = np.concatenate([b + np.asarray(at, np.int64) for b, at in zip(begins, pages["repeated"])])
    gone = covered(values, page, least) | runs_at(elsewhere, least, len(values))
    return [" ".join(w for w, g in zip(s, gone[b:b + len(s)]) if not g) for s, b in zip(streams, begins)]


TEXT = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("text", T.StringType())])


def main_text(pages: DataFrame, host_pages: int = HOST_PAGES, least: int = REPEATED_TOKENS) -> DataFrame:
    """Columns (page_id, url, html) -> one row per page: page_id, url, text, n_chars.

    A page that marks its article (article or main) has its text from there,
    without menus, headers, footers, sidebars, notices, adverts, forms, scripts,
    styles and comments inside. It is also taken from a div or section whose
    class or id names furniture, as layouts are called after what they hold; an
    article inside another one is not. Repeats don't count against it: copies of an
    article on one host are still articles. On other pages what such markup
    leaves is undecided, and the host decides: all its pages' token streams form
    a suffix array, runs that repeat across pages go, unique ones stay. A host
    with more pages is dealt into groups of about ``host_pages`` at random, so a
    group is bounded, and runs of ``least`` tokens are also counted over all its
    pages, so what repeats in different groups only goes as well.

    Null html is an empty page, with empty text. A null or odd address is a host
    of its own kind. Repeated rows stay; extra columns are ignored.
    """
    parsed = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html").mapInArrow(parse, PARSED)
    parsed = parsed.withColumn("host", F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), HOST, 1)))
    parsed = stored(parsed.withColumn("row", F.monotonically_increasing_id()), "parsed-pages")
    decided = parsed.where(F.size("undecided") == 0).select("page_id", "url", F.col("article").alias("text"))
    open_ = parsed.where(F.size("undecided") > 0)
    sizes = open_.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / host_pages).alias("groups"))
    dealt = open_.join(sizes, "host").withColumn("group", F.pmod(F.xxhash64("page_id", "url"), F.col("groups")))

    def judge(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"page_id": group["page_id"].astype("Int64"), "url": group["url"], "text": unique_runs(group, least)})

    small = dealt.where("groups = 1").withColumn("repeated", F.array().cast("array<int>"))
    large = dealt.where("groups > 1")
    large = (large.join(repeated_windows(large, least), "row", "left")
             .withColumn("repeated", F.coalesce("repeated", F.array().cast("array<int>"))))
    judged = small.unionByName(large).select("host", "group", "page_id", "url", "undecided", "repeated").groupBy("host", "group").applyInPandas(judge, TEXT)
    return decided.unionByName(judged).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
