"""Main text of web pages: page structure, and what pages of a host have in common.

A page is cut into blocks of text. What is inside an article or main element is content;
what is inside menus, headers, footers, sidebars, notices, adverts, forms and comments is
not; other blocks are neither by their markup. The token streams of all blocks outside the
content of a host's pages are put one after the other and sorted by suffix. Runs of
RUN tokens or more that occur on different pages lie next to each other in that order;
what they cover is boilerplate. A page's text is its content, and on pages without a
content element the unique runs of the blocks that no markup decides.

Content elements keep what other pages repeat: an article may quote, and copies of an
article are articles.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RUN = 8
PAGES_PER_SHARD = 4096

# Element names and the words of classes, ids and roles by their use
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
CONTENT = frozenset("article main".split())
# What holds a page or its content is not chrome by a word of its class, as in "has-sidebar"
HOLDERS = CONTENT | {"html", "body"}
CHROME = frozenset(
    "aside button dialog fieldset footer form head header iframe input menu nav noscript object script select style svg "
    "template textarea title".split()
)
CHROME_WORDS = frozenset(
    "ad ads advert advertisement adverts alert banner breadcrumb breadcrumbs comment comments complementary consent contentinfo "
    "cookie cookies dialog disclaimer footer header masthead menu modal nav navbar navigation newsletter notice notices popup promo "
    "promoted related reply search share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
# A start of one of these ends an open paragraph; a start ends an open element of its own kind
ENDS_PARAGRAPH = BLOCKS - {"br", "html", "body", "head"}
ENDS_ITSELF = frozenset("dd dt li option p td th tr".split())

MARKUP = re.compile(
    r"""<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([A-Za-z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*)(?:>|$)""", re.S
)
ATTRIBUTE = re.compile(r"""([^\s=/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s]+)))?""")
PARTS = re.compile(r"[\s_-]+")


def _is_chrome(tag: str, attributes: str) -> bool:
    if tag in CHROME:
        return True
    if not attributes.strip():
        return False
    for name, *values in ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name in ("class", "id", "role") and tag not in HOLDERS and CHROME_WORDS & set(PARTS.split("".join(values).lower())):
            return True
        if name == "hidden" or name == "aria-hidden" and "".join(values).lower() == "true":
            return True
    return False


def blocks(page: str) -> list[tuple[str, list[str]]]:
    """(zone, words) of each block in page order; zone is content, chrome or plain."""
    found: list[tuple[str, list[str]]] = []
    pieces: list[str] = []
    open_tags: list[tuple[str, str]] = []  # name, and the zone inside
    opened: dict[str, list[int]] = {}  # the depths of the open elements of a name
    zone = "plain"

    def close_block() -> None:
        words = html.unescape("".join(pieces)).split()
        if words:
            found.append((zone, words))
        pieces.clear()

    def leave(depth: int) -> None:
        nonlocal zone
        while len(open_tags) > depth:
            opened[open_tags.pop()[0]].pop()
        zone = open_tags[-1][1] if open_tags else "plain"

    at = 0
    while at < len(page):
        mark = MARKUP.search(page, at)
        if not mark:
            pieces.append(page[at:])
            break
        pieces.append(page[at : mark.start()])
        at = mark.end()
        if not mark[2]:
            continue
        tag = mark[2].lower()
        if tag in BLOCKS or tag in RAW or tag in CHROME:
            close_block()
        if mark[1]:
            if opened.get(tag):
                leave(opened[tag][-1])
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*(?:>|$)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in VOID or mark[3].rstrip().endswith("/") and tag not in BLOCKS:
            continue
        if tag in ENDS_PARAGRAPH or tag in ENDS_ITSELF:
            # the innermost open block ends if it is a paragraph or of the same kind
            inner = max((depths[-1] for name in BLOCKS if (depths := opened.get(name))), default=-1)
            if inner >= 0 and (open_tags[inner][0] == "p" or open_tags[inner][0] == tag and tag in ENDS_ITSELF):
                leave(inner)
        if _is_chrome(tag, mark[3]):
            inside = "chrome"
        elif tag in CONTENT or re.search(r"""role\s*=\s*["']?main\b""", mark[3], re.I):
            inside = "chrome" if zone == "chrome" else "content"
        else:
            inside = zone
        opened.setdefault(tag, []).append(len(open_tags))
        open_tags.append((tag, inside))
        zone = inside
    close_block()
    return found


def repeated(pages: list[np.ndarray], names: list[int], run: int = RUN) -> list[np.ndarray]:
    """For each token stream, which of its tokens lie in a run that another page has too.

    ``names`` tells which page a stream is of. The suffixes of all streams are sorted by
    their first ``run`` tokens, doubling the sorted length; a stream's end is a token of its
    own, so no run goes over it.
    """
    sizes = [len(p) for p in pages]
    if not sum(sizes):
        return [np.zeros(0, bool) for _ in pages]
    total = sum(sizes) + len(pages)
    text, page_of = np.empty(total, np.int64), np.empty(total, np.int64)
    at, starts = 0, []
    for i, p in enumerate(pages):
        starts.append(at)
        text[at : at + len(p)], text[at + len(p)] = p + len(pages), i
        page_of[at : at + len(p) + 1] = names[i]
        at += len(p) + 1
    rank = np.unique(text, return_inverse=True)[1]
    length = 1
    while length < run:
        step = min(length, run - length)
        ahead = np.concatenate((rank[step:], np.full(step, -1)))
        rank = np.unique((rank << 32) + ahead + 1, return_inverse=True)[1]
        length += step
    suffixes = np.argsort(rank, kind="stable")
    ordered = page_of[suffixes]
    first = np.flatnonzero(np.concatenate(([True], rank[suffixes][1:] != rank[suffixes][:-1])))
    shared = np.minimum.reduceat(ordered, first) != np.maximum.reduceat(ordered, first)
    begins = shared[rank]
    covered = np.zeros(total + 1, np.int64)
    where = np.flatnonzero(begins)
    np.add.at(covered, where, 1)
    np.add.at(covered, np.minimum(where + run, total), -1)
    covered = np.cumsum(covered)[:total] > 0
    return [covered[s : s + n] for s, n in zip(starts, sizes, strict=True)]


def run_hashes(words: list[str], known: dict[str, int], run: int = RUN) -> np.ndarray:
    """64 bits for each run of ``run`` words, the same in every task. ``known`` remembers words."""
    n = max(0, len(words) - run + 1)
    for w in set(words) - known.keys():
        known[w] = int.from_bytes(hashlib.blake2b(w.encode("utf-8", "replace"), digest_size=8).digest(), "little")
    each, found = np.array([known[w] for w in words], np.uint64), np.zeros(n, np.uint64)
    for i in range(run if n else 0):
        found = found * np.uint64(0x9E3779B97F4A7C15) + each[i : i + n]
        found ^= found >> np.uint64(29)
    return found.view(np.int64)


def covered_by(begins: np.ndarray, size: int, run: int = RUN) -> np.ndarray:
    """Which of ``size`` tokens lie in a run that begins where ``begins`` is true."""
    steps = np.zeros(size + 1, np.int64)
    where = np.flatnonzero(begins)
    np.add.at(steps, where, 1)
    np.add.at(steps, where + run, -1)
    return np.cumsum(steps)[:size] > 0


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def _boilerplate(pages: DataFrame) -> DataFrame:
    """(page, n_repeated, dropped): for each page that has tokens outside its content, how
    many of them other pages of its host repeat, and which of those in plain blocks, counted
    through the plain blocks. ``pages`` has (page, host, html); equal pages have one name
    and count as one page.

    A host of more than PAGES_PER_SHARD rows is cut into shards. The suffix array finds what
    pages of one shard share; what shards share is found by the hashes of the runs, which
    are combined over the shards and handed back to those that have them."""

    def streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for page, host, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                outside = [(zone == "plain", words) for zone, words in blocks(text or "") if zone != "content"]
                if outside:
                    rows.append((page, host, [w for _, words in outside for w in words], [p for p, words in outside for _ in words]))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = (pa.int64(), pa.string(), pa.list_(pa.string()), pa.list_(pa.bool_()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["page", "host", "words", "plain"]
            )

    found = pages.mapInArrow(streams, "page long, host string, words array<string>, plain array<boolean>")
    found = found.groupBy("page", "host").agg(F.first("words").alias("words"), F.first("plain").alias("plain"))
    hosts = pages.groupBy("host").agg(F.count("*").alias("pages"))
    shard = F.pmod(F.col("page"), F.ceil(F.col("pages") / PAGES_PER_SHARD))
    found = found.join(hosts, "host").select("host", shard.alias("shard"), "page", "words", "plain")

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[str, int] = {}
            for page, host, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = [w for zone, words in blocks(text or "") if zone != "content" for w in words]
                hashes = np.unique(run_hashes(words, known))
                n = len(hashes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([host] * n, pa.string()), pa.array(np.full(n, page), pa.int64()), pa.array(hashes)], names=["host", "page", "run"]
                )

    large = F.broadcast(hosts.where(F.col("pages") > PAGES_PER_SHARD))  # a row for each PAGES_PER_SHARD rows at most
    cut = pages.join(large, "host").select("page", "host", "html").mapInArrow(runs, "host string, page long, run long").join(large, "host")
    shards = cut.groupBy("host", "run").agg(F.collect_set(shard).alias("shards")).where(F.size("shards") > 1)
    handed = shards.select(
        "host", F.explode("shards").alias("shard"), F.col("run").alias("page"),
        F.lit(None).cast("array<string>").alias("words"), F.lit(None).cast("array<boolean>").alias("plain"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for _, group in groupby(rows, key=lambda r: r[:2]):
            group, shared = list(group), []
            for row in group:
                if row[3] is None:
                    shared.append(row[2])
            group, shared = [row for row in group if row[3] is not None], np.array(shared, np.int64)
            known: dict[str, int] = {}
            numbers: dict[str, int] = {}
            tokens = [np.array([numbers.setdefault(w, len(numbers)) for w in r[3]], np.int64) for r in group]
            marks = repeated(tokens, list(range(len(group))))
            if len(shared):
                marks = [m | covered_by(np.isin(run_hashes(r[3], known), shared), len(m)) for m, r in zip(marks, group, strict=True)]
            dropped = [np.flatnonzero(m[np.array(r[4], bool)]) for m, r in zip(marks, group, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[2] for r in group], pa.int64()),
                    pa.array([int(m.sum()) for m in marks], pa.int64()),
                    pa.array(dropped, pa.list_(pa.int32())),
                ],
                names=["page", "n_repeated", "dropped"],
            )

    # sorted, so that a task sees its shards one after the other and holds one of them
    n = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = found.unionByName(handed).repartition(n, "host", "shard").sortWithinPartitions("host", "shard")
    return dealt.mapInArrow(run, "page long, n_repeated long, dropped array<int>")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id_col, url_col, text, n_repeated) for each row of ``pages``.

    ``text`` is the main text, white space inside a block made one blank and blocks joined
    by one; ``n_repeated`` is the number of the page's tokens outside its content that other
    pages of the host repeat. A null or empty page has an empty text; a null or relative
    url belongs to the host without a name; repeated rows have the same text each, and do
    not count as each other's copies; an empty table gives an empty result.
    """
    page = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), page.alias("html"), F.xxhash64(host_of(F.col(url_col)), page).alias("page")
    )
    named = rows.select("page", host_of(F.col("url")).alias("host"), "html")
    marks = _boilerplate(named)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            content, plain = [], []
            for text in batch.column(3).to_pylist():
                found = blocks(text)
                main = [w for zone, words in found if zone == "content" for w in words]
                content.append(" ".join(main) if main else None)
                plain.append(None if main else [w for zone, words in found if zone == "plain" for w in words])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(content, pa.string()), pa.array(plain, pa.list_(pa.string()))],
                names=["id", "url", "page", "content", "plain"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    read = rows.select("id", "url", "page", "html").mapInArrow(
        texts, f"id {kind}, url string, page long, content string, plain array<string>"
    )
    joined = read.join(marks.hint("shuffle_hash"), "page", "left")
    dropped = F.coalesce("dropped", F.array().cast("array<int>"))
    unique = F.when(F.size(dropped) > 0, F.filter("plain", lambda w, i: ~F.array_contains(dropped, i))).otherwise(F.col("plain"))
    return joined.select(
        F.col("id").alias(id_col), F.col("url").alias(url_col),
        F.coalesce("content", F.array_join(unique, " "), F.lit("")).alias("text"),
        F.coalesce("n_repeated", F.lit(0)).cast("long").alias("n_repeated"),
    )
