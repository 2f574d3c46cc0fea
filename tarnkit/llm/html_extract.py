"""Main text of web pages, by container paths that the pages of a host agree on."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnkit.llm.components import stored
from tarnkit.llm.html_pages import Page
from tarnkit.llm.workers import add_columns, slices
from tarnkit.operators.lookups import fits_broadcast

#: Containers with a smaller share of their page's score don't vote.
LEAST_SHARE = 0.1


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to / ? # or the end, A-Z lower-cased; empty without ``://``."""
    host = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def container_votes(pages: DataFrame, html: str, host: Column) -> DataFrame:
    """host, path, share, wide, beside: each page's containers with their share of the page's score and, as ``wide``, the container
    that holds the article's other parts too. Where ``beside`` is set it is a container beside ``path``, the page's best."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 256):
                rows, beside = [], set()
                for name, source in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    page = Page(source or "")
                    total = sum(page.scores.values())
                    rows += [(name, p, s / total, page.widened(p), None) for p, s in page.scores.items() if s >= LEAST_SHARE * total]
                    best = page.best()
                    beside |= {(name, best, 0.0, None, p) for p in page.scores if not _nested(p, best)}
                rows += beside
                types = (pa.string(), pa.string(), pa.float64(), pa.string(), pa.string())
                columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays(columns, ["host", "path", "share", "wide", "beside"])

    rows = pages.select(host.alias("host"), F.col(f"`{html}`").cast("string")).filter("host != ''")
    return rows.mapInArrow(score, "host string, path string, share double, wide string, beside string")


def _nested(a: str, b: str) -> bool:
    """Whether one of two paths lies in the other; the empty one holds all."""
    return not a or not b or f"{a}>".startswith(f"{b}>") or f"{b}>".startswith(f"{a}>")


def host_paths(pages: DataFrame, html: str, host: Column) -> DataFrame:
    """host, path, wide, beside: the path with the most votes of each host, of equal ones the last by name; the container most pages
    with it would widen it to; and those beside it on pages where it is best. Votes are added up
    before the shuffle, so a host with very many pages is as good as any."""
    votes = container_votes(pages, html, host).groupBy("host", "path", "wide", "beside")
    votes = stored(votes.agg(F.sum("share").alias("share"), F.count(F.lit(1)).alias("n")), "votes")
    paths = votes.filter("beside IS NULL").groupBy("host", "path")
    paths = paths.agg(F.round(F.sum("share"), 6).alias("votes"), F.max(F.struct("n", "wide")).alias("most"))
    top = paths.groupBy("host").agg(F.max(F.struct("votes", "path", "most")).alias("top"))
    top = top.select("host", F.col("top.path").alias("path"), F.col("top.most.wide").alias("wide"))
    beside = votes.filter("beside IS NOT NULL").join(top, ["host", "path"], "left_semi")
    beside = beside.groupBy("host").agg(F.collect_set("beside").alias("beside"))
    return top.join(beside, "host", "left")


def read_page(source: str, path: str | None, wide: str | None, beside: frozenset[str]) -> tuple[str | None, str]:
    """The path a page's text is taken from, and the text.

    That is the host's, unless it holds less than LEAST_SHARE of the page's prose and the page's own best container
    is not one that stands beside the host's on other pages: then the page is laid out in another way. Without a host's path it is the page's own."""
    page = Page(source, wide)
    best = page.best()
    if best is None:
        return None, ""
    held = page.held()
    text = page.text() if path is not None else ""
    if not text or held.get(wide, 0) < LEAST_SHARE * held[""] and best not in beside and not _nested(best, path):
        target = page.widened(best)
    else:
        target = page.widened(wide, inside_only=True)
    if target != wide:
        text = Page(source, target).text()
    return (target, text) if text else (None, "")


def extract_pages(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """``pages`` without ``html`` but with host, path and text: the article of each page.

    A first pass scores the containers of every page by the text directly in them and, at half weight, in containers within; a
    path names each, generalised to tags and classes with numbers masked. Pages of a host vote, the winning path is widened to the container
    that holds the article's other parts too, and a second pass takes the text inside all elements on it, or in the page's own best
    container where the host's path has no text or the page another layout (:func:`read_page`). Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments within are left out.
    Character references are decoded, white space becomes one space, blocks are joined by one space.

    Null or empty html gives an empty text and no path; null urls and those without a host have the empty host, whose
    pages have nothing in common: each is read by itself. Repeated rows are kept. Columns host, path and text of the input are replaced. Pages don't move while the winning paths measure small
    enough to broadcast; beyond that they are joined by host, which adaptive execution splits.
    """
    host = host_of(F.col(f"`{url}`"))
    paths = stored(host_paths(pages, html, host), "host-paths")
    kept = [c for c in pages.columns if c not in ("host", "path", "text", html)]
    rows = pages.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{html}`").cast("string").alias("__html"), host.alias("host"))
    found = rows.join(F.broadcast(paths) if fits_broadcast(paths) else paths, "host", "left")
    found = found.select(*[F.col(f"`{c}`") for c in kept], "host", "path", "__html", "wide", "beside")
    n = len(kept)

    def extract(part: pa.RecordBatch) -> list[pa.Array]:
        read = [read_page(h or "", p, w, frozenset(b or ())) for p, h, w, b in zip(*[part.column(k).to_pylist() for k in range(n + 1, n + 5)])]
        return [pa.array([r[0] for r in read], pa.string()), pa.array([r[1] for r in read], pa.string())]

    added = T.StructType().add("__path", "string").add("text", "string")
    read = add_columns(found, added, extract, 256)
    return read.select(*[F.col(f"`{c}`") for c in kept], "host", F.col("__path").alias("path"), "text")
