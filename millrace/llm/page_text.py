"""Main text of pages, by deducing the template that the pages of a host share.

Tokens of a page are the paths of its block elements (names, classes and ids from the root on, so a
token has one role) and its blocks of text by the slot they stand in. Tokens of a host with the
same occurrence vector (how often they occur on each of the host's pages) are an equivalence class. A vector is
known by its number of pages and two sums of hashes of page and count, which are worked out by
partial aggregates, so a host of any size is never gathered. A class is valid if it lies on most
of the host's pages and holds an element: its elements nest, since a path holds its parents' paths. Texts of valid
classes are the template's; what is left in the slots is the pages' own, and the slots that hold
most of it, links apart, are the main ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import staged
from millrace.llm.page_blocks import Page, read_page
from millrace.llm.shingles import mix
from millrace.llm.urls import parse

LEAST_PAGES = 3  # a template is deduced from so many pages
SLOT_SHARE = 0.2  # main slots hold this share of what the largest one holds
BROADCAST_BYTES = 32 << 20  # templates of all hosts are sent to the tasks up to this size, else joined
SLICE_PAGES = 2000
PAGE, TAG, TEXT, SLOT = range(4)
STATS = "host long, kind int, token long, slot long, semantic boolean, pages long, sum1 long, sum2 long, chars long, linked long"
SUMS = ("pages", "sum1", "sum2", "chars", "linked")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _marks(counts: dict[int, int], page: int) -> tuple[list[int], list[int]]:
    """Two hashes below 2**31 of the page and each token's count; their sums over pages fit a long."""
    mixed = mix(np.fromiter(counts.values(), np.uint64, len(counts)) + mix(np.full(1, page, np.uint64)))
    return (mixed >> np.uint64(33)).tolist(), (mixed & np.uint64(0x7FFFFFFF)).tolist()


def _page_stats(page: Page, key: int) -> Iterator[tuple[tuple, tuple]]:
    """``(kind, token, slot, semantic)`` and the sums of one page."""
    yield (PAGE, 0, 0, False), (1, 0, 0, 0, 0)
    if page.paths:
        for token, one, two in zip(page.paths, *_marks(page.paths, key), strict=True):
            yield (TAG, token, 0, False), (1, one, two, 0, 0)
    texts: dict[int, int] = {}
    slots: dict[tuple, list[int]] = {}
    held = {}
    for block in page.blocks:
        token = block.token()
        texts[token] = texts.get(token, 0) + 1
        held[token] = block
        mass = slots.setdefault((block.slot, block.semantic), [0, 0])
        mass[0] += len(block.text)
        mass[1] += block.linked
    if texts:
        for (token, count), one, two in zip(texts.items(), *_marks(texts, key), strict=True):
            block = held[token]
            yield (TEXT, token, block.slot, block.semantic), (1, one, two, count * len(block.text), count * block.linked)
    for (slot, semantic), (chars, linked) in slots.items():
        yield (SLOT, 0, slot, semantic), (1, 0, 0, chars, linked)


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_PAGES):
            rows, sums = batch.slice(at, SLICE_PAGES), {}
            for host, source in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                key = xxhash.xxh3_64_intdigest(source or "")
                for name, values in _page_stats(read_page(source), key):
                    known = sums.get((host, *name))
                    sums[(host, *name)] = values if known is None else tuple(map(int.__add__, known, values))
            if not sums:
                continue
            host, kind, token, slot, semantic = zip(*sums, strict=True)
            yield pa.RecordBatch.from_arrays([
                pa.array(host, pa.int64()), pa.array(kind, pa.int32()), pa.array(map(_signed, token), pa.int64()),
                pa.array(map(_signed, slot), pa.int64()), pa.array(semantic, pa.bool_()),
                *(pa.array(x, pa.int64()) for x in zip(*sums.values(), strict=True)),
            ], names=["host", "kind", "token", "slot", "semantic", *SUMS])


def templates(pages: DataFrame) -> DataFrame:
    """Per host of ``pages`` (``host``, ``html``), its template texts and main slots: ``host, fixed, slots``.

    ``fixed`` holds no text where the main slots hold more text of the template than of their own: then
    the pages are copies of one another, and what they share is what they say.
    """
    stats = pages.select("host", "html").mapInArrow(_stats, STATS)
    stats = stats.groupBy("host", "kind", "token", "slot", "semantic").agg(*(F.sum(c).alias(c) for c in SUMS))
    stats = staged(stats.where((F.col("kind") != TEXT) | (F.col("pages") >= LEAST_PAGES)), "page-tokens")
    count = stats.where(F.col("kind") == PAGE).select("host", F.col("pages").alias("all_pages"))
    tokens = stats.where(F.col("kind").isin(TAG, TEXT)).join(count, "host").where(
        (F.col("pages") >= LEAST_PAGES) & (2 * F.col("pages") > F.col("all_pages"))
    )
    classes = tokens.where(F.col("kind") == TAG).select("host", "pages", "sum1", "sum2").distinct()
    fixed = tokens.where(F.col("kind") == TEXT).join(classes, ["host", "pages", "sum1", "sum2"], "left_semi")
    fixed = fixed.select("host", "token", "slot", "chars", "linked")

    own = stats.where(F.col("kind") == SLOT).groupBy("host", "slot", "semantic").agg(
        F.sum("chars").alias("chars"), F.sum("linked").alias("linked")
    )
    taken = fixed.groupBy("host", "slot").agg(F.sum("chars").alias("fixed_chars"), F.sum("linked").alias("fixed_linked"))
    own = own.join(taken, ["host", "slot"], "left").select(
        "host", "slot", "semantic", F.coalesce("fixed_chars", F.lit(0).cast("long")).alias("fixed_chars"),
        (F.col("chars") - 2 * F.col("linked")).alias("mass"),
        (F.col("chars") - 2 * F.col("linked") - F.coalesce(F.col("fixed_chars") - 2 * F.col("fixed_linked"), F.lit(0))).alias("own"),
    )
    # Articles are preferred where a host marks them at all; their copies are no template.
    score = F.greatest("own", F.when(F.col("semantic"), F.col("mass")).otherwise(F.col("own")))
    own = own.withColumn("score", score)
    best = own.groupBy("host").agg(F.max("semantic").alias("any_semantic"), F.max_by("score", F.struct("semantic", "score")).alias("best"))
    main = own.join(best, "host").where(
        (F.col("semantic") == F.col("any_semantic")) & (F.col("score") > 0) & (F.col("score") >= SLOT_SHARE * F.col("best"))
    )
    main = main.groupBy("host").agg(
        F.collect_set("slot").alias("slots"), (F.sum("fixed_chars") > F.sum("own")).alias("copies")
    )
    texts = fixed.groupBy("host").agg(F.collect_set("token").alias("fixed"))
    return main.join(texts, "host", "left").select(
        "host", "slots", F.when(F.col("fixed").isNull() | F.col("copies"), F.array().cast("array<long>")).otherwise(F.col("fixed")).alias("fixed"),
    )


def main_text(page: Page, slots: frozenset[int], fixed: frozenset[int]) -> str:
    """What the main slots hold besides the template's texts; blocks of links outside of articles are left out.

    Where a page has none of the host's main slots, its own articles or else its largest slots are taken.
    """
    if not any(b.slot in slots for b in page.blocks):
        mass: dict[int, int] = {}
        for marked in (True, False):
            for b in page.blocks:
                if b.semantic == marked and b.token() not in fixed:
                    mass[b.slot] = mass.get(b.slot, 0) + len(b.text) - 2 * b.linked
            if mass:
                break
        most = max(mass.values(), default=0)
        slots = frozenset(s for s, n in mass.items() if n > 0 and n >= SLOT_SHARE * most)
    kept = []
    for b in page.blocks:
        inside = b.slot in slots or not slots.isdisjoint(b.containers)
        if 2 * b.linked > len(b.text) and not (b.semantic and b.slot in slots):
            inside = False
        if inside and (not fixed or b.token() not in fixed):
            kept.append(b.text)
    return " ".join(kept)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict = {}
    mask = (1 << 64) - 1
    for batch in batches:
        hosts, sources = batch.column(3).to_pylist(), batch.column(2).to_pylist()
        texts = []
        for i, (host, source) in enumerate(zip(hosts, sources, strict=True)):
            if host not in known:
                if len(known) > 4096:
                    known.clear()
                slots, fixed = (batch.column(c)[i].as_py() or [] for c in (4, 5))
                known[host] = frozenset(x & mask for x in slots), frozenset(x & mask for x in fixed)
            texts.append(main_text(read_page(source), *known[host]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
        )


def extract_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """The main text of every page: ``<id>, <url>, text``.

    The pages of a host share a template, deduced from all of them; a host of fewer than
    ``LEAST_PAGES`` pages has none, and its pages go by their elements and the text in them. Pages whose url is null or
    has no ``://`` count as one host.

    A null, empty or textless page has an empty text. Every row is worked on, repeated ones alike; ids may be
    null; other columns are not read. An empty table gives no rows. Pages are read twice and moved only
    if the templates are too large to be sent to the tasks.
    """
    id_type = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
        F.xxhash64(parse(F.col(url_col))[0]).alias("host"),
    )
    found = staged(templates(rows), "templates")
    size = found.agg(F.sum(F.size("slots") + F.size("fixed") + 8)).first()[0] or 0
    if 8 * size <= BROADCAST_BYTES:
        found = F.broadcast(found)
    both = rows.join(found, "host", "left").select("page_id", "url", "html", "host", "slots", "fixed")
    out = both.mapInArrow(_extract, f"page_id {id_type}, url string, text string")
    return out.select(F.col("page_id").alias(id_col), F.col("url").alias(url_col), "text")
