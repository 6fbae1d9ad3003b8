"""Stretches of words that repeat with a period, by minimizers at several scales.

At the scale ``w`` the periods above ``w`` and up to ``2 w`` are sought. Runs of ``2 w`` words (grams) are
hashed and the least hash of each window of ``w`` grams is a minimizer. Inside a repetition of
smallest period ``q`` equal grams lie multiples of ``q`` apart (a gram is no shorter than ``q``, so any other
distance would make a smaller period), and a window holds the same grams as the window ``q`` words on. So
where four periods lie together, two equal neighbouring minimizers are ``q`` apart: they are
the seed, which is followed word by word to both ends. Seeds overlap their copies, so they are
repetitions already; ordinary text has next to none. Periods up to ``SHORT`` are read off directly, by
comparing the text with itself that many words on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shingles import MIX_A, mix

LEAST_WORDS, LEAST_PERIODS = 6, 4
SHORT = 8  # periods compared directly; the least window of minimizers
SLICE_BYTES = 2 << 20  # text at hand at a time, or one text
RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _least_length(period):
    return np.maximum(LEAST_WORDS, LEAST_PERIODS * period)


def _sliding(values: np.ndarray, width: int, fold: np.ufunc, fill: int) -> np.ndarray:
    """``fold`` over each ``width`` values from every place on; ``fill`` stands behind the end."""
    n = len(values)
    padded = np.full(-(-n // width) * width + width, fill, dtype=values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = fold.accumulate(blocks, axis=1).ravel()
    behind = fold.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return fold(behind[:n], ahead[width - 1:width - 1 + n])


def _seeds(grams: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of minimizers and the distance to the next equal one, where that fits the scale."""
    top = int(np.iinfo(np.uint64).max)
    least = _sliding(grams, width, np.minimum, top)
    # A gram is a minimizer if the largest of the minima of the windows it lies in is itself.
    chosen = _sliding(least[::-1], width, np.maximum, 0)[::-1] == grams
    places = np.flatnonzero(chosen)
    found = grams[places]
    order = np.argsort(found, kind="stable")
    places, found = places[order], found[order]
    lags = places[1:] - places[:-1]
    fits = (found[1:] == found[:-1]) & (lags > width) & (lags <= 2 * width)
    return places[:-1][fits], lags[fits]


def _reach(words: np.ndarray, at: int, lag: int, step: int) -> int:
    """The last place from ``at`` on, in direction ``step``, up to which words ``lag`` apart are equal."""
    size = 64
    while True:
        low, high = (at, min(at + size, len(words) - lag)) if step > 0 else (max(at - size + 1, 0), at + 1)
        same = words[low:high] == words[low + lag:high + lag]
        if not same.all():
            return low + int(np.argmin(same)) - 1 if step > 0 else high - int(np.argmin(same[::-1]))
        if step > 0:
            at = high
            if high == len(words) - lag:
                return high - 1
        else:
            at = low - 1
            if low == 0:
                return 0
        size *= 2


def find_runs(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All runs in texts laid one after the other: rows ``start, length, period``, by start and period.

    ``words`` are numbers of words; behind each text stands a number that occurs nowhere else.
    """
    found = []
    longest = int(lengths.max(initial=0))
    for lag in range(1, min(SHORT, longest // LEAST_PERIODS) + 1):
        same = np.zeros(len(words) - lag + 2, dtype=np.int8)
        same[1:-1] = words[lag:] == words[:-lag]
        turns = np.diff(same)
        first, length = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
        length = length - first + lag
        long = length >= _least_length(lag)
        found.append(np.stack([first[long], length[long], np.full(long.sum(), lag)], axis=1))

    grams, place, width = mix(words.view(np.uint64)), np.arange(len(words)), 1
    while width < 2 * SHORT:
        grams, width = _doubled(grams, width), 2 * width
    width //= 2
    while LEAST_PERIODS * (width + 1) <= longest:
        fits = lengths >= LEAST_PERIODS * (width + 1)
        if not fits.all():  # shorter texts are done with
            keep = np.repeat(fits, lengths + 1)
            grams, place, starts, lengths = grams[keep], place[keep], starts[fits], lengths[fits]
        at, lags = _seeds(grams, width)
        found.append(_extended(words, place[at], lags))
        grams, width = _doubled(grams, 2 * width), 2 * width

    runs = np.concatenate([np.empty((0, 3), np.int64), *found]).astype(np.int64)
    # The same stretch may come with a multiple of its smallest period.
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[new]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _doubled(grams: np.ndarray, width: int) -> np.ndarray:
    """Hashes of grams twice as wide. Places too near the end get hashes of their own."""
    out = grams * MIX_A
    n = max(0, len(grams) - width)
    out[:n] += grams[width:]
    out[n:] += np.arange(len(grams) - n, dtype=np.uint64)
    return mix(out)


def _extended(words: np.ndarray, at: np.ndarray, lags: np.ndarray) -> np.ndarray:
    """The runs that seeds lie in, each once."""
    out, lag, end = [], -1, -1
    for i in np.lexsort((at, lags)).tolist():
        place, now = int(at[i]), int(lags[i])
        if now == lag and place <= end:
            continue
        if words[place] != words[place + now]:  # grams of equal hash that are not equal
            continue
        lag, end = now, _reach(words, place, now, 1)
        first = _reach(words, place, now, -1)
        length = end - first + 1 + now
        if length >= _least_length(now):
            out.append((first, length, now))
    return np.array(out, dtype=np.int64).reshape(-1, 3)


def _slices(texts: list[bytes | None]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text or b"") > SLICE_BYTES:
            yield start, i
            start, size = i, 0
        size += len(text or b"") + 1
    if start < len(texts):
        yield start, len(texts)


def _searched(texts: list[bytes | None]) -> tuple[list[list[dict]], list[bytes]]:
    """Runs of each text, and the text without their repeats."""
    numbers: dict[bytes, int] = {}
    split = [text.split() if text else [] for text in texts]
    lengths = np.array([len(words) for words in split], dtype=np.int64)
    starts = np.cumsum(lengths + 1) - lengths - 1
    flat = np.empty(int((lengths + 1).sum()), dtype=np.int64)
    for i, words in enumerate(split):
        at = int(starts[i])
        flat[at:at + len(words)] = [numbers.setdefault(w, len(numbers)) for w in words]
        flat[at + len(words)] = -1 - i
    found = find_runs(flat, starts, lengths)
    gone = np.zeros(len(flat) + 1, dtype=np.int64)
    np.add.at(gone, found[:, 0] + found[:, 2], 1)
    np.add.at(gone, found[:, 0] + found[:, 1], -1)
    kept = np.cumsum(gone) == 0
    of = np.searchsorted(starts, found[:, 0], side="right") - 1
    runs: list[list[dict]] = [[] for _ in texts]
    for i, (start, length, period) in zip(of.tolist(), found.tolist(), strict=True):
        runs[i].append({"start": start - int(starts[i]), "length": length, "period": period})
    rest = [
        b" ".join(words if not runs[i] else [w for w, k in zip(words, kept[starts[i]:].tolist()) if k])
        for i, words in enumerate(split)
    ]
    return runs, rest


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).to_pylist()
        for start, end in _slices(texts):
            runs, rest = _searched(texts[start:end])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(start, end - start), pa.array(runs, RUNS), pa.array(rest, pa.binary())],
                names=["id", "runs", "collapsed"],
            )


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All periodic runs of every text: ``<id>, runs, collapsed``.

    A run is a stretch of consecutive words (what lies between ASCII white space, as it stands) that has
    a smallest period ``q``, at least ``LEAST_WORDS`` words and ``LEAST_PERIODS`` periods, and that goes on with that
    period at neither end. ``runs`` are ``start, length, period`` in words, by start and period. ``collapsed`` is the text
    without the words that a run holds after its first period, joined by one space.

    A null, empty or blank text has no runs and an empty rest. Every row is worked on by itself, so ids may be
    null or repeated; other columns are not read. An empty table gives no rows. There is no
    shuffle; a task holds ``SLICE_BYTES`` of text at a time, or one text that is longer.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(
        _run, f"id {kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed binary"
    )
    return found.select(F.col("id").alias(id_col), "runs", F.col("collapsed").cast("string").alias("collapsed"))


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id>, text``: in a tenth of the texts, by a checksum of the id, the words from one place on repeat.

    With ``h`` the checksum, ``g = h div 10`` and ``n`` words, where ``h % 10 = 0`` and ``n > 0`` the words from ``a = g % n`` on
    become the first ``p`` of them, over and over, ``p = 1 + (n - a) div (3 + g % 8)``. A null id plants nothing.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    words = F.regexp_extract_all(F.col(text_col), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    some = docs.select(F.col(id_col), F.col(text_col).alias("text"), h.alias("h"))
    some = some.withColumn("words", F.when(F.col("h") % 10 == 0, words))
    some = some.withColumn("g", F.expr("h div 10")).withColumn("n", F.size("words").cast("long"))
    some = some.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    some = some.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    planted = F.expr("array_join(transform(words, (w, i) -> if(i < a, w, words[cast(a + (i - a) % p as int)])), ' ')")
    return some.select(id_col, F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))
