"""Fetching as a Python data source: pages are landed as they come and read from then on from disk.

The policy: five answers "too many requests" and three transport errors are retried, a pause stands
between calls, a missing page is an empty one. The transport is a parameter; there is none by default, as the engine
itself opens no network.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

# Retries and pauses in seconds.
BUSY_RETRIES, BUSY_PAUSE, ERROR_RETRIES, ERROR_PAUSE, LEAST_PAUSE, MOST_PAUSE = 5, 30.0, 3, 3.0, 2.5, 4.5


class Response:
    def __init__(self, status: int, body: str, retry_after: float | None = None):
        self.status, self.body, self.retry_after = status, body, retry_after


def fetched(get: Callable[[str], Response], url: str, sleep: Callable[[float], None] = time.sleep) -> str:
    """The body of a page, '' of a missing one; raises when the retries are used up (SC17)."""
    busy = errors = 0
    while True:
        try:
            r = get(url)
        except OSError:
            errors += 1
            if errors > ERROR_RETRIES:
                raise
            sleep(ERROR_PAUSE)
            continue
        if r.status == 429:
            busy += 1
            if busy > BUSY_RETRIES:
                raise RuntimeError(f"{url}: too many requests")
            sleep(r.retry_after if r.retry_after is not None else BUSY_PAUSE)
        elif r.status == 404:
            return ""
        elif r.status >= 400:
            raise RuntimeError(f"{url}: status {r.status}")
        else:
            return r.body


class Listed(InputPartition):
    def __init__(self, urls: list[str]):
        self.urls = urls


class PageSource(DataSource):
    """Option urls: one a line. Option get: a pickled callable is given by subclassing and overriding get()."""

    @classmethod
    def name(cls) -> str:
        return "ledgerlark_pages"

    def schema(self) -> str:
        return "url string, html string"

    def get(self, url: str) -> Response:
        raise RuntimeError("no transport: subclass PageSource and override get()")

    def reader(self, schema):
        return PageReader(self.options.get("urls", "").split(), self.get)


class PageReader(DataSourceReader):
    def __init__(self, urls: list[str], get: Callable[[str], Response]):
        self.urls, self.get = urls, get

    def partitions(self):
        """One site, one pace: all urls in one partition."""
        return [Listed(self.urls)]

    def read(self, partition):
        for i, url in enumerate(partition.urls):
            if i:
                time.sleep(random.uniform(LEAST_PAUSE, MOST_PAUSE))
            yield url, fetched(self.get, url)


class Pages(InputPartition):
    """Pages first to last of one locale's listing, without the first page's leading blocks that an earlier batch has."""

    def __init__(self, locale: str, query: str, first: int, last: int, skip: int, most: int):
        self.locale, self.query, self.first, self.last, self.skip, self.most = locale, query, first, last, skip, most


class ListingSource(DataSource):
    """A listing in pages as a stream (SC1): each raw block once, over restarts too, as long as the listing only grows at its end.

    A locale's pages go on until one holds fewer than per_page raw blocks, counted before anything is parsed. Where a name finds
    nothing, its other apostrophe spellings are tried in turn. The offset is, by locale, the spelling, the number of full pages and
    the blocks of the page after them. The driver only probes for the end, in steps that double and then halve; tasks fetch the pages.

    Options: locales (comma-joined), query, per_page, block (text that begins a block), pages_per_task. Subclasses override page().
    """

    @classmethod
    def name(cls) -> str:
        return "ledgerlark_listing"

    def schema(self) -> str:
        return "locale string, query string, page int, pos int, block string"

    def page(self, locale: str, query: str, number: int) -> Response:
        raise RuntimeError("no transport: subclass ListingSource and override page()")

    def streamReader(self, schema):
        return ListingReader(self.options, self.page)


class ListingReader(DataSourceStreamReader):
    def __init__(self, options: dict, page: Callable[[str, str, int], Response], pause: tuple[float, float] = (0.0, 0.0)):
        self.locales = options.get("locales", "").split(",")
        self.spellings = spellings(options.get("query", ""))
        self.per_page, self.block = int(options.get("per_page", 100)), options.get("block", "<article")
        self.pages_per_task = int(options.get("pages_per_task", 20))
        self.page, self.pause = page, pause

    def blocks(self, locale: str, query: str, number: int) -> list[str]:
        """A page's raw blocks, each from where it begins to where the next one does."""
        html = fetched(lambda _: self.page(locale, query, number), f"{locale} {query} {number}")
        return [self.block + rest for rest in html.split(self.block)[1:]]

    def initialOffset(self) -> dict:
        return {locale: [0, 0, 0] for locale in self.locales}

    def end_of(self, locale: str) -> list[int]:
        """[spelling, full pages, blocks after them]: the first page that isn't full, found by doubling steps and halving."""
        for spelling, query in enumerate(self.spellings):
            count = len(self.blocks(locale, query, 1))
            if count or spelling == len(self.spellings) - 1:
                break
        if count < self.per_page:
            return [spelling if count else 0, 0, count]
        full, short = 1, 2  # the last page known to be full, a page to try
        while (count := len(self.blocks(locale, query, short))) >= self.per_page:
            full, short = short, short * 2
        while short - full > 1:
            middle = (full + short) // 2
            seen = len(self.blocks(locale, query, middle))
            if seen >= self.per_page:
                full = middle
            else:
                short, count = middle, seen
        return [spelling, full, count]

    def latestOffset(self) -> dict:
        return {locale: self.end_of(locale) for locale in self.locales}

    def partitions(self, start: dict, end: dict) -> list[Pages]:
        out = []
        for locale, (spelling, full, rest) in sorted(end.items()):
            same = start.get(locale, [spelling, 0, 0])[0] == spelling
            first, skip = (start[locale][1] + 1, start[locale][2]) if same and locale in start else (1, 0)
            last = full + (1 if rest else 0)
            for at in range(first, last + 1, self.pages_per_task):
                upto = min(at + self.pages_per_task - 1, last)
                out.append(Pages(locale, self.spellings[spelling], at, upto, skip if at == first else 0, rest if upto == full + 1 else self.per_page))
        return out

    def read(self, partition: Pages):
        """Blocks beyond the end that was probed wait for the next batch."""
        for number in range(partition.first, partition.last + 1):
            if number > partition.first:
                time.sleep(random.uniform(*self.pause))
            found = self.blocks(partition.locale, partition.query, number)
            for pos, block in enumerate(found[: partition.most if number == partition.last else self.per_page]):
                if number > partition.first or pos >= partition.skip:
                    yield partition.locale, partition.query, number, pos, block

    def commit(self, end: dict) -> None:
        pass


# Marks that stand for an apostrophe in a name.
APOSTROPHES = "'`’ʼ"


def spellings(name: str) -> list[str]:
    """A name, and where it has an apostrophe, its spellings with each other mark (FN23 for one text)."""
    marks = [name.translate({ord(m): a for m in APOSTROPHES}) for a in APOSTROPHES]
    return list(dict.fromkeys([name, *marks]))


def all_pages(get_page: Callable[[int], str], block: str, per_page: int) -> list[str]:
    """Pages until one holds fewer than per_page raw blocks, counted before anything is parsed (SC1)."""
    out = []
    while True:
        out.append(get_page(len(out) + 1))
        if out[-1].count(block) < per_page:
            return out
