"""Catalog feeds (Atom with acquisition links): parsing, offline pages and a network data source."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.error import HTTPError
from urllib.parse import quote_plus
from urllib.request import Request, urlopen

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..functions.text import unicode_trim
from ..schemas import FEED

USER_AGENT = "siltstone/1"


def parse_feed(pages: DataFrame, value: str = "value") -> DataFrame:
    """Add ``feed`` to XML texts. A page whose root is no feed (an HTML notice, say), or broken XML, fails the query."""
    root = F.regexp_extract(F.col(value), r"(?s)\A﻿?\s*(?:<\?.*?\?>\s*|<!--.*?-->\s*|<!DOCTYPE[^>]*>\s*)*<(?:[\w.-]+:)?([\w.-]+)[\s/>]", 1)
    parsed = F.from_xml(F.col(value), FEED, {"ignoreNamespace": "true", "mode": "FAILFAST"})
    wrong = F.raise_error(F.concat(F.lit("not a catalog feed: root element is "), root)).cast(FEED)
    return pages.withColumn("feed", F.when(root == "feed", parsed).otherwise(wrong))


def xml_text(value: Column) -> Column:
    """A string as the text of an element: markup and carriage returns, which parsers replace, as references."""
    for c, reference in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\r", "&#13;")):
        value = F.replace(value, F.lit(c), F.lit(reference))
    return value


def feed_entries(pages: DataFrame, value: str = "value") -> DataFrame:
    """One row per entry in feed order: the page's other columns, position and the entry's fields."""
    others = [c for c in pages.columns if c != value]
    return parse_feed(pages, value).select(*others, F.posexplode("feed.entry").alias("position", "e")).select(*others, "position", "e.*")


def category_titles(pages: DataFrame, value: str = "value") -> DataFrame:
    """The trimmed, non-empty titles of a category feed, in feed order."""
    titles = feed_entries(pages, value).select("position", unicode_trim("title").alias("category"))
    return titles.where("category <> ''").orderBy("position")


def read_pages(spark: SparkSession, folder: str, pattern: str = "*.xml") -> DataFrame:
    """Saved feed pages: value and file_name."""
    pages = spark.read.option("pathGlobFilter", pattern).text(folder, wholetext=True)
    return pages.select("value", F.col("_metadata.file_name").alias("file_name"))


def fetch(url: str, timeout: float) -> bytes:
    """A page; any status but 200 is an error that quotes at most 256 bytes of it."""
    try:
        with urlopen(Request(url, headers={"User-Agent": USER_AGENT, "Accept": "application/atom+xml,application/xml"}), timeout=timeout) as answer:  # noqa: S310
            if answer.status == 200:
                return answer.read()
            status, said = answer.status, answer.read(256)
    except HTTPError as e:
        status, said = e.code, e.read(256)
    raise OSError(f"{url}: status {status}: {said!r}")


def discovered_categories(spark: SparkSession, base: str, timeout: float = 90) -> list[str]:
    """The categories that a catalog names, in its order."""
    page = fetch(f"{base.rstrip('/')}/categories", timeout).decode()
    return [r["category"] for r in category_titles(spark.createDataFrame([(page,)], "value string")).collect()]


def page_urls(base: str, category: str, start: int, count: int, lang: str) -> str:
    return f"{base.rstrip('/')}/entries?start={start}&count={count}&lang={quote_plus(lang)}&category={quote_plus(category)}"


def walk_pages(get: Callable[[int], str], most: int = 1000) -> Iterator[str]:
    """Feed pages from start 0 on. Ends at an empty page, at the total, or when the server ignores the start (that page is kept)."""
    start = 0
    for _ in range(most):
        page = get(start)
        n, total, told = page_counts(page)
        if n == 0:
            return
        yield page
        if told != start or (total > 0 and start + n >= total):
            return
        start += n


def page_counts(page: str) -> tuple[int, int, int]:
    """How many entries a feed page has, the total that it tells (0: none), and its start."""
    import xml.etree.ElementTree as ET

    root = ET.fromstring(page)  # noqa: S314
    if root.tag.rpartition("}")[2] != "feed":
        raise ValueError(f"not a catalog feed: root element is {root.tag}")
    names = [(c.tag.rpartition("}")[2], c.text) for c in root]
    number = {n: int(text or 0) for n, text in names if n in ("totalResults", "startIndex")}
    return sum(n == "entry" for n, _ in names), number.get("totalResults", 0), number.get("startIndex", 0)


def named_categories(page: str) -> list[str]:
    """The titles of a category feed, trimmed; empty ones are left out."""
    import xml.etree.ElementTree as ET

    titles = [c.text or "" for e in ET.fromstring(page) for c in e if e.tag.endswith("}entry") and c.tag.endswith("}title")]  # noqa: S314
    return [t.strip() for t in titles if t.strip()]


@dataclass
class Asked(InputPartition):
    """Pages of one category and language; in streams only the entries from ``start`` up to ``end``."""

    site: str
    lang: str
    start: int = 0
    end: int = -1


class Catalog:
    """What the batch and the stream reader know of a catalog: its address and what is asked of it."""

    def __init__(self, options):
        self.base = options["baseUrl"]
        self.categories = [c for c in re.split(r"[,\n]", options.get("categories", "")) if c]
        self.langs = [c for c in options.get("lang", "eng").split(",") if c]
        self.keep_going = options.get("keepGoing", "false").lower() == "true"
        self.count, self.most, self.timeout = int(options.get("count", "100")), int(options.get("maxPages", "1000")), float(options.get("timeout", "90"))

    def page(self, site: str, lang: str, start: int, count: int) -> str:
        return fetch(page_urls(self.base, site, start, count, lang), self.timeout).decode()

    def sites(self) -> list[str]:
        """The categories that were named, or all that the catalog names."""
        return self.categories or named_categories(fetch(f"{self.base.rstrip('/')}/categories", self.timeout).decode())


class CatalogReader(DataSourceReader):
    """One partition per category and language; pages are walked inside it."""

    def __init__(self, options):
        self.catalog = Catalog(options)

    def partitions(self):
        return [Asked(site, lang) for site in self.catalog.sites() for lang in self.catalog.langs]

    def read(self, partition):
        if partition is None:  # nothing is asked for
            return
        site, lang, c = partition.site, partition.lang, self.catalog
        pages = []
        try:
            pages = list(walk_pages(lambda start: c.page(site, lang, start, c.count), c.most))
        except Exception as e:
            if not c.keep_going:
                raise
            yield site, lang, -1, None, str(e)
            return
        for k, page in enumerate(pages):
            yield site, lang, k, page, None


class CatalogStreamReader(DataSourceStreamReader):
    """Offsets are how many entries of every category and language have been read.

    A batch asks for the entries from one offset to the next, so it is the same
    when it is repeated. The driver asks each category for its total only.
    """

    def __init__(self, options):
        self.catalog = Catalog(options)

    def initialOffset(self):
        return {}

    def latestOffset(self):
        c, out = self.catalog, {}
        for site in c.sites():
            for lang in c.langs:
                try:
                    n, total, _ = page_counts(c.page(site, lang, 0, 1))
                except Exception:
                    if not c.keep_going:
                        raise
                    continue  # its entries come with a later batch
                if n and not total:
                    raise ValueError(f"the catalog tells no total of category {site}: read it as a batch")
                out[f"{lang}:{site}"] = total
        return out

    def partitions(self, start, end):
        out = []
        for key, last in sorted(end.items()):
            lang, _, site = key.partition(":")
            out += [Asked(site, lang, k, min(k + self.catalog.count, last)) for k in range(start.get(key, 0), last, self.catalog.count)]
        return out

    def read(self, partition):
        c, start = self.catalog, partition.start
        while start < partition.end:
            asked = partition.end - start
            page = c.page(partition.site, partition.lang, start, asked)
            n, _, told = page_counts(page)
            if n > asked or told not in (0, start):
                raise ValueError(f"category {partition.site}: {asked} entries from {start} were asked for, {n} from {told} came")
            if n == 0:
                return
            yield partition.site, partition.lang, start, page, None
            start += n

    def commit(self, end):
        pass


class CatalogSource(DataSource):
    """``spark.read.format("catalog_feed")``: site, lang, page, value, error.

    Options: baseUrl, categories (joined by commas or line ends; default: all
    that the catalog names), lang (joined by commas), count, maxPages, timeout,
    and keepGoing: a category that fails is one row with its error, in place of
    an error of the query.

    Options, not filters, say what is asked of the server: a source of Spark 4.1
    that takes filters keeps them for other queries on the same DataFrame, which
    then lose rows. ``spark.readStream`` reads what catalogs add at their ends:
    each batch the entries that came since the last; ``page`` is then the
    number of the page's first entry. Entries that are changed or put before
    others are seen by batch reads only.
    """

    @classmethod
    def name(cls):
        return "catalog_feed"

    def schema(self):
        return "site string, lang string, page int, value string, error string"

    def reader(self, schema):
        return CatalogReader(self.options)

    def streamReader(self, schema):
        return CatalogStreamReader(self.options)


def read_catalog(spark: SparkSession, base: str, stream: bool = False, **options: str) -> DataFrame:
    """Pages of a catalog. Of the server, only the categories and languages of the options are asked for."""
    spark.dataSource.register(CatalogSource)
    reader = spark.readStream if stream else spark.read
    return reader.format("catalog_feed").options(baseUrl=base, **options).load()
