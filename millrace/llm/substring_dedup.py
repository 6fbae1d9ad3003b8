"""Passages that repeat across documents, by MinHash banding of paragraphs."""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.colliding import colliding, scan_tasks
from millrace.llm.common import bloom_words, may_be_in, staged, text_slices
from millrace.llm.linking import link_by_keys, parity_sketch
from millrace.llm.shingles import WORDS_PER_SHINGLE, WordHashes, mix, shingles

PASSAGE_WORDS = 32  # the shortest paragraph that counts
GUARANTEE = 51  # a run of so many equal words holds an anchored paragraph in common for certain
SPAN = GUARANTEE - PASSAGE_WORDS  # a paragraph is anchored in every so many consecutive places
PERCENT = 75
SIMILARITY = PERCENT / 100
RECALL = 0.97
SEED = np.uint64(0x51_7C_C1_B7_27_22_0A_95)
LINES = "node long, doc_id long, pos int, words int, sketch binary, grams array<long>"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def tune_bands(similarity: float = SIMILARITY, recall: float = RECALL, rows: int = 2) -> int:
    """The least number of bands of ``rows`` values that finds a pair of this similarity with ``recall``."""
    bands = 1
    while 1 - (1 - similarity**rows) ** bands < recall:
        bands += 1
    return bands


ROWS = 2
BANDS = tune_bands(rows=ROWS)
FACTORS = mix(np.arange(1, ROWS * BANDS + 1, dtype=np.uint64) * SEED) | np.uint64(1)
PLACES = mix(np.arange(101, 101 + PASSAGE_WORDS, dtype=np.uint64) * SEED) | np.uint64(1)
MORE = np.uint64(31)  # the bits of a longer stretch's key that hold its words beyond PASSAGE_WORDS


def anchors(grams: np.ndarray, span: int) -> np.ndarray:
    """Places of the least hash of every ``span`` consecutive ones (all, where there are fewer)."""
    if len(grams) <= span:
        return np.array([int(grams.argmin())]) if len(grams) else np.empty(0, np.int64)
    least, wide = np.arange(len(grams)), 1
    while wide < span:  # the first least place of a window, from those of two windows that make it up
        step = min(wide, span - wide)
        one, two = least[:-step], least[step:]
        least, wide = np.where(grams[two] < grams[one], two, one), wide + step
    return least[np.append(True, least[1:] != least[:-1])]


def passages(
    words: np.ndarray, size: int = PASSAGE_WORDS, grams: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Keys and first words of the anchored paragraphs of ``size`` words in the running text.

    Where a paragraph begins is told by the words after that place alone, so equal runs of
    ``GUARANTEE`` words have one in common, whatever stands around them and wherever lines break.
    """
    if len(words) < size:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    grams = shingles(words) if grams is None else grams
    starts = anchors(grams, GUARANTEE - size)
    starts = starts[starts + size <= len(words)]
    per = size - WORDS_PER_SHINGLE + 1
    inner = grams[starts[:, None] + np.arange(per)]
    return mix((inner * PLACES[:per]).sum(axis=1, dtype=np.uint64) ^ SEED), starts


def lines_of(text: str, hashes: WordHashes) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Hashes of all words, and first and last word of each line of at least ``PASSAGE_WORDS``."""
    hashes.trim()
    lines = [line.split() for line in text.encode().lower().split(b"\n")]
    words = list(itertools.chain.from_iterable(lines))
    spans, at = [], 0
    for line in lines:
        if len(line) >= PASSAGE_WORDS:
            spans.append((at, at + len(line)))
        at += len(line)
    return np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words)), spans


def band_keys(grams: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A key per line and band: the hash of the least values of its rows. A line's shingles begin at its start."""
    least = np.stack([np.minimum.reduceat(grams * factor, starts) for factor in FACTORS], axis=1)
    least = least.reshape(len(starts), BANDS, ROWS)
    keys = np.tile(np.arange(BANDS, dtype=np.uint64) + np.uint64(1), (len(starts), 1))
    for row in range(ROWS):
        keys = mix(keys ^ least[:, :, row])
    return keys


def line_grams(grams: np.ndarray, first: int, last: int) -> np.ndarray:
    """The shingles of a line, of those of its whole text."""
    return grams[first:last - WORDS_PER_SHINGLE + 1]


def _emit() -> Callable:
    """Keys of all paragraphs. A place is twice the first word, plus one for a line."""
    hashes = WordHashes()

    def slice_keys(ids: np.ndarray, texts: list[str | None]) -> tuple:
        keys, places, owners = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        sets, of, at = [], [], []
        for doc_id, text in zip(ids, texts, strict=True):
            words, lines = lines_of(text or "", hashes)
            if len(words) < PASSAGE_WORDS:
                continue
            grams = shingles(words)
            found, starts = passages(words, grams=grams)
            keys.append(found)
            places.append(2 * starts)
            owners.append(np.full(len(found), doc_id, dtype=np.int64))
            for first, last in lines:
                sets.append(line_grams(grams, first, last))
                of.append(doc_id)
                at.append(2 * first + 1)
        if sets:
            keys.append(band_keys(np.concatenate(sets), np.cumsum([0, *map(len, sets[:-1])])).ravel())
            places.append(np.repeat(np.array(at, dtype=np.int64), BANDS))
            owners.append(np.repeat(np.array(of, dtype=np.int64), BANDS))
        return np.concatenate(keys), np.concatenate(owners), np.concatenate(places).astype(np.int32)

    def run(batch: pa.RecordBatch):
        for rows in text_slices(batch, 1):
            yield slice_keys(rows.column(0).to_numpy(zero_copy_only=False), rows.column(1).to_pylist())

    return run


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of a document that stand at the given places, with their shingle sets."""
    hashes = WordHashes()
    for batch in batches:
        for part in text_slices(batch, 1):
            rows = []
            for doc_id, text, wanted in zip(*(c.to_pylist() for c in part.columns), strict=True):
                wanted = set(wanted)
                words, lines = lines_of(text or "", hashes)
                grams = shingles(words)
                for first, last in lines:
                    if 2 * first + 1 in wanted:
                        line = words[first:last]
                        found = np.unique(line_grams(grams, first, last))
                        order = mix(np.arange(len(line), dtype=np.uint64) + SEED)
                        node = mix((line * order).sum(keepdims=True, dtype=np.uint64)).view(np.int64)
                        rows.append((int(node[0]), doc_id, 2 * first + 1, len(line), parity_sketch(found), found.view(np.int64)))
            if rows:
                node, doc_id, pos, words, marks, grams = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node, pa.int64()), pa.array(doc_id, pa.int64()), pa.array(pos, pa.int32()),
                     pa.array(words, pa.int32()), pa.array(marks, pa.binary()), pa.array(grams, pa.list_(pa.int64()))],
                    names=["node", "doc_id", "pos", "words", "sketch", "grams"],
                )


def tied_lines(keyed: DataFrame, contents: DataFrame) -> DataFrame:
    """``node, component`` of the lines tied by pairs with a common key (``key``, ``node``) and Jaccard ``SIMILARITY``.

    Pairs are taken as :func:`link_by_keys` gives them, so a line that very many documents vary costs some
    comparisons per variant, and no link between lines of different components is left out. A pair's
    sets meet only if sizes and parity sketches do not rule it out.
    """
    profiles = contents.select("node", F.size("grams").cast("long").alias("n"), "sketch")
    sets = [contents.select(F.col("node").alias(x), F.col("grams").alias(f"grams_{x}")) for x in "ab"]

    def verify(pairs: DataFrame) -> DataFrame:
        both = pairs.join(sets[0], "a").join(sets[1], "b")
        shared = F.size(F.array_intersect("grams_a", "grams_b"))
        every = F.size("grams_a") + F.size("grams_b") - shared
        return both.where(100 * shared >= PERCENT * every).select("a", "b")

    return link_by_keys(keyed, verify, profiles, PERCENT)


def _longer() -> Callable:
    """Keys of the wanted stretches with 1, 2, ... more words before or after them, fewer than ``SPAN``.

    A wanted place is the first word and, in five bits each, the least numbers of words before and after (0: none),
    then two bits for what the document itself asks for, before and after. The key ends in the number of words that
    were added; a place is twice the first word of the longer stretch, plus one if its document asks.
    """
    hashes = WordHashes()
    steps = np.arange(SPAN - 1)
    number = (steps + 1).astype(np.uint64)

    def run(batch: pa.RecordBatch):
        for rows in text_slices(batch, 1):
            ids, texts, wanted = rows.column(0).to_numpy(zero_copy_only=False), rows.column(1).to_pylist(), rows.column(2).to_pylist()
            texts = [hashes.of(t) for t in texts]
            ends = np.cumsum([len(t) for t in texts])
            words = np.append(np.concatenate(texts), np.uint64(0))
            per = [len(w) for w in wanted]
            codes = np.fromiter(itertools.chain.from_iterable(wanted), dtype=np.int64, count=sum(per))
            doc = np.repeat(np.arange(len(per)), per)
            low = np.append(0, ends)[doc]
            starts, high = (codes >> 12) + low, ends[doc]
            whole = (words[starts[:, None] + np.arange(PASSAGE_WORDS)] * PLACES).sum(axis=1, dtype=np.uint64)
            for side, least in ((2, codes >> 7 & 31), (1, codes >> 2 & 31)):
                some = np.flatnonzero(least)
                first = starts[some, None]
                at = first - 1 - steps if side == 2 else first + PASSAGE_WORDS + steps
                there = at >= low[some, None] if side == 2 else at < high[some, None]
                there &= number >= least[some, None].astype(np.uint64)
                added = mix(words[np.clip(at, 0, len(words) - 1)]) * PLACES[:SPAN - 1]
                grown = mix(np.cumsum(added, axis=1, dtype=np.uint64) ^ mix(whole[some] + np.uint64(side))[:, None])
                keys = mix(grown ^ SEED) & ~MORE | number
                places = np.broadcast_to(at if side == 2 else first, at.shape) - low[some, None]
                asked = (codes[some] // side & 1)[:, None]
                owners = np.broadcast_to(ids[doc[some], None], at.shape)
                yield keys[there], owners[there], (2 * places + asked)[there].astype(np.int32)

    return run


def to_run_ends(stretches: DataFrame, docs: DataFrame, tasks: int) -> DataFrame:
    """Longer stretches ``cluster, id, start, words`` that reach the ends of equal runs.

    A document's words within a run that an earlier document holds too lie in the run's stretches, but for fewer
    than ``SPAN`` words before its first one and after its last. Any stretch held by an earlier document (a late one) may be
    the first or the last of such a run, and asks for the words around it as far as other late stretches do
    not cover them. Earlier documents with a stretch that asks answer. Rows are those that ask, and of each longer
    stretch the one of least id.
    """
    first = stretches.groupBy("cluster").agg(F.min("id").alias("first_id"))
    late = F.when(F.col("id") > F.col("first_id"), F.col("start"))
    rows = stretches.select("cluster", "id", "start").join(first, "cluster").withColumn("late", late)
    around = Window.partitionBy("id").orderBy("start").rangeBetween
    most = SPAN - 1
    before, after = (F.count("late").over(around(*r)) == 0 for r in ((-PASSAGE_WORDS, -most), (most, PASSAGE_WORDS)))
    rows = rows.select(
        "cluster", "id", "start",
        F.when(before, F.col("late") - F.min("late").over(around(1 - most, 0)) + 1).alias("before"),
        F.when(after, F.max("late").over(around(0, most - 1)) - F.col("late") + 1).alias("after"),
    )
    rows = staged(rows, "chains")
    ends = rows.where("before is not null or after is not null").groupBy("cluster").agg(
        F.coalesce(F.min("before"), F.lit(0)).alias("least_before"), F.coalesce(F.min("after"), F.lit(0)).alias("least_after"),
        F.max("id").alias("last_id"),
    )
    own = F.when(F.col("before").isNotNull(), 2).otherwise(0) + F.when(F.col("after").isNotNull(), 1).otherwise(0)
    code = 4096 * F.col("start").cast("long") + 128 * F.col("least_before") + 4 * F.col("least_after") + own
    wanted = rows.join(ends, "cluster").where("id <= last_id").groupBy(F.col("id").alias("doc_id")).agg(
        F.collect_set(code).alias("wanted")
    )
    wanted = staged(wanted, "ends")
    some = may_be_in(bloom_words(wanted, "doc_id"), docs, "doc_id").join(wanted, "doc_id").select("doc_id", "text", "wanted")
    found = staged(colliding(some, _longer, tasks, asked=True), "longer")
    return found.select(
        F.col("key").alias("cluster"), "id", F.expr("cast(pos div 2 as int)").alias("start"),
        F.expr(f"cast({PASSAGE_WORDS} + (key & {MORE}) as int)").alias("words"),
    )


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Passages that stand in several documents: ``<id>, keep_id, start_word, n_words, kept``.

    Paragraphs are of two kinds: lines of at least ``PASSAGE_WORDS`` words, and stretches of that many
    words in the running text whose beginnings the words themselves decide (:func:`passages`). The
    lines' sets of five-word shingles are banded by MinHash, with bands tuned for a recall of ``RECALL``
    at ``SIMILARITY``; colliding lines that size and parity sketch leave are verified by exact
    Jaccard and clustered by components. A stretch has the one band of all its words; what repeats is followed to
    the ends of the equal run (:func:`to_run_ends`), so every word in a run of ``GUARANTEE`` words or more that an
    earlier document holds is reported. Of each cluster over several documents, the one of smallest id (``keep_id``) keeps its paragraphs.

    A row is a stretch of words of one document, put together from overlapping or adjoining paragraphs with the same
    ``keep_id``; ``kept`` is true in that document. Documents without such passages have no row. Words are what lies
    between ASCII white space, counted from 0; A-Z are lower-cased.

    Null, empty and short texts have no paragraphs. Rows that repeat an id are taken to repeat
    the text and count as one document; rows without id are left out. An empty table gives no rows. Only the two named columns are read.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    tasks = scan_tasks(docs)
    docs = docs.where("doc_id is not null")
    members = staged(colliding(docs, _emit, tasks), "paragraphs")

    lines = members.where("pos % 2 = 1")
    wanted = lines.groupBy(F.col("id").alias("doc_id")).agg(F.collect_set("pos").alias("wanted"))
    wanted = staged(wanted, "wanted")
    some = may_be_in(bloom_words(wanted, "doc_id"), docs, "doc_id")
    found = staged(some.join(wanted, "doc_id").select("doc_id", "text", "wanted").mapInArrow(_lines, LINES), "lines")
    contents = staged(found.dropDuplicates(["node"]).select("node", "sketch", "grams"), "contents")
    places = found.select("node", F.col("doc_id").alias("id"), "pos", "words").distinct()
    keyed = lines.join(places, ["id", "pos"]).select("key", "node").distinct()
    ends = tied_lines(staged(keyed, "line-keys"), contents)
    start = F.expr("cast(pos div 2 as int)").alias("start")
    lines = places.join(ends, "node", "left").select(F.coalesce("component", "node").alias("cluster"), "id", start, "words")

    stretches = members.where("pos % 2 = 0").select(
        F.col("key").alias("cluster"), "id", start, F.lit(PASSAGE_WORDS).alias("words")
    )
    every = stretches.unionAll(lines).unionAll(to_run_ends(stretches, docs, tasks))
    keep = every.groupBy("cluster").agg(F.min("id").alias("keep_id"), F.max("id").alias("last"))
    every = every.join(keep.where("keep_id < last"), "cluster")
    every = every.select("id", "keep_id", "start", (F.col("start") + F.col("words")).alias("stop"))
    return merged(every, ["id", "keep_id"]).select(
        F.col("id").alias(id_col), "keep_id", F.col("start").alias("start_word"),
        (F.col("stop") - F.col("start")).alias("n_words"), (F.col("id") == F.col("keep_id")).alias("kept"),
    )


def merged(spans: DataFrame, by: list[str]) -> DataFrame:
    """Overlapping and adjoining spans (``start``, ``stop``) of equal ``by`` as one.

    ``by`` has to hold the document, whose length bounds what is sorted together.
    """
    rows = spans.groupBy(*by, "start").agg(F.max("stop").alias("stop"))
    order = Window.partitionBy(*by).orderBy("start")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("fresh", (reach.isNull() | (F.col("start") > reach)).cast("int"))
    rows = rows.withColumn("run", F.sum("fresh").over(order))
    return rows.groupBy(*by, "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("run")


def cut_words(text: Column, cuts: Column) -> Column:
    """A text without the given word ranges; what is left is joined by a line break."""

    @F.pandas_udf("string")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, ranges in batches:
            yield pd.Series([_without(t, r) for t, r in zip(texts, ranges, strict=True)], dtype=object)

    return run(text, cuts)


def _without(text: str | None, cuts) -> str | None:
    if text is None or cuts is None or not len(cuts):
        return text
    raw = text.encode()
    spots = [m.span() for m in WORD.finditer(raw)]
    left, at = [], 0
    for cut in sorted(cuts, key=lambda c: c["start"]):
        first, last = int(cut["start"]), min(int(cut["stop"]), len(spots))
        if first < last:
            left.append(raw[at:spots[first][0]])
            at = max(at, spots[last - 1][1])
    left.append(raw[at:])
    parts = [p.decode().strip(" \t\r\n") for p in left]
    return "\n".join(p for p in parts if p)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every repeated passage cut out of all documents but the one that keeps it.

    Columns stay as they are but for the text; documents that held nothing else are left with an
    empty text.
    """
    spans = repeated_passages(docs, id_col, text_col).where("not kept").select(
        F.col(id_col).alias("cut_id"), F.col("start_word").alias("start"),
        (F.col("start_word") + F.col("n_words")).alias("stop"),
    )
    spans = merged(spans, ["cut_id"]).groupBy("cut_id").agg(F.collect_list(F.struct("start", "stop")).alias("cuts"))
    names = docs.columns
    aside = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("row_id"))
    joined = aside.join(spans, F.col("row_id") == F.col("cut_id"), "left")
    text = F.when(F.col("cuts").isNull(), F.col("row")[text_col]).otherwise(cut_words(F.col("row")[text_col], F.col("cuts")))
    return joined.select(*((text if n == text_col else F.col("row")[n]).alias(n) for n in names))
