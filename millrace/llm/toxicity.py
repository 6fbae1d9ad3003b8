"""Toxicity by maximum-scoring segments over token log-odds with Dirichlet priors."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import staged, text_slices

TOKEN = re.compile(r"[^\W\d_]+")
PREFIXES = (6, 5, 4)  # stems: the beginnings of longer words, marked with a trailing hyphen
PRIOR, PRIOR_EACH = 500.0, 0.5  # Dirichlet prior: dealt out by the frequency in both classes, and to each term
LEAST_Z, LEAST_LOG_ODDS, LEAST_DOCS = 3.3, 2.0, 5
MAX_LABELLED = 50_000  # the classifier is fitted on about so many labelled documents at most
LINE_PART = 4  # one in so many labelled documents calibrates; terms are learned from the others
TOP_SCORE = 9.0
NO_HIT, TOP_EVIDENCE, BINS_PER_UNIT = -12.0, 80.0, 4
COUNTS = "term string, docs1 long, docs0 long, uses0 long"
SCAN = "evidence double, best double, segments int, tokens long, spans array<struct<start:int,end:int,score:double>>"


def tokens_of(text: str | None) -> list[str]:
    return TOKEN.findall(text.lower()) if text else []


def stems_of(word: str) -> list[str]:
    return [word[:n] + "-" for n in PREFIXES if len(word) > n]


def maximal_segments(hits: list[tuple[int, float]], penalty: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments, in linear time: ``(first token, last token, score)``.

    ``hits`` are the positions and positive scores of scored tokens, in order; every token
    between two of them scores ``-penalty``. A segment is maximal when no longer one that holds it
    scores more and no part of it does.
    """
    # First, last, sum left of it, sum up to its end, and the nearest segment before it with a smaller left sum.
    # Those between the two have larger left sums, so a search that passes this one passes them as well.
    done: list[tuple[int, int, float, float, int]] = []
    total, last = 0.0, None
    for position, score in hits:
        if last is not None:
            total -= penalty * (position - last - 1)
        last = position
        first, left, right = position, total, total + score
        total = right
        at = len(done) - 1
        while True:
            while at >= 0 and done[at][2] >= left:
                at = done[at][4]
            if at < 0 or done[at][3] >= right:
                done.append((first, position, left, right, at))
                break
            first, _, left, _, before = done[at]
            del done[at:]
            at = before
    return [(a, b, right - left) for a, b, left, right, _ in done]


@dataclass
class ToxicModel:
    """Scores of terms, the decay of chance scores, and the line from evidence to log-odds."""

    scores: dict[str, float] = field(default_factory=dict)
    penalty: float = 0.1
    decay: float = 1.0
    intercept: float = -2.0
    slope: float = 1.0

    def scorer(self) -> Callable[[str], float]:
        """Score of a token above 0, or 0. A word's own entry counts, else its longest stem's."""
        cache: dict[str, float] = {}
        scores = self.scores

        def score(word: str) -> float:
            found = cache.get(word)
            if found is None:
                found = scores.get(word)
                if found is None:
                    found = next((scores[s] for s in stems_of(word) if s in scores), 0.0)
                if len(cache) > 500_000:
                    cache.clear()
                cache[word] = found
            return found

        return score

    def evidence_of(self, words: list[str], score: Callable[[str], float]):
        """``evidence, best, segments``: how far the segments lie beyond what chance explains.

        A segment of score S is expected ``tokens * exp(-decay * S)`` times in a text of that many unrelated
        tokens. The evidence is the sum of the negative logs over all segments expected less
        than once; where there are none it is that of the best one.
        """
        hits = [(i, s) for i, s in enumerate(map(score, words)) if s]
        if not hits:
            return NO_HIT, 0.0, []
        segments = maximal_segments(hits, self.penalty)
        chance = math.log(len(words))
        beyond = [self.decay * s - chance for _, _, s in segments]
        significant = [x for x in beyond if x > 0]
        evidence = sum(significant) if significant else max(beyond)
        found = [s for s, x in zip(segments, beyond, strict=True) if x > 0]
        return min(TOP_EVIDENCE, max(NO_HIT + 1, evidence)), max(s for _, _, s in segments), found


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per piece of a batch: documents of either class that hold a term, and its uses in class 0."""
    for batch in (piece for whole in batches for piece in text_slices(whole, 0)):
        docs: tuple[Counter, Counter] = Counter(), Counter()
        uses: Counter = Counter()
        totals = [0, 0, 0]
        stems: dict[str, list[str]] = {}
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = Counter(tokens_of(text))
            terms: Counter = Counter(words)
            for word, n in words.items():
                if word not in stems:
                    stems[word] = stems_of(word)
                for stem in stems[word]:
                    terms[stem] += n
            docs[toxic].update(terms.keys())
            totals[1 - toxic] += len(words)
            if not toxic:
                uses.update(terms)
                totals[2] += sum(words.values())
        terms = list(docs[0].keys() | docs[1].keys())
        yield pa.RecordBatch.from_pydict({
            "term": ["", *terms],
            "docs1": pa.array([totals[0], *(docs[1][t] for t in terms)], pa.int64()),
            "docs0": pa.array([totals[1], *(docs[0][t] for t in terms)], pa.int64()),
            "uses0": pa.array([totals[2], *(uses[t] for t in terms)], pa.int64()),
        })


def _labelled(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """The labels to learn from, one per id: the more frequent one, toxic in a tie; ``line`` marks those that calibrate.

    Held-out ids and rows without label don't count. Of the rest, about ``MAX_LABELLED`` ids
    are taken by their hash, so the frame is of bounded size and is sent to the tasks that read
    the documents; their texts stay where they are.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    known = known.where(~is_held_out(F.col(id_col))).groupBy(F.col(id_col).alias("label_id")).agg(
        (F.avg(F.col(label_col).cast("double")) >= 0.5).cast("int").alias("toxic")
    )
    line = F.pmod(F.xxhash64(F.lit("line"), "label_id"), F.lit(LINE_PART)) == 0
    known = staged(known.withColumn("line", line), "labelled")
    ids = max(known.count(), MAX_LABELLED)
    return F.broadcast(known.where(F.pmod(F.xxhash64("label_id"), F.lit(ids)) < MAX_LABELLED))


def fit_scores(train: DataFrame) -> ToxicModel:
    """Term scores from ``train`` (``text``, ``toxic``), over all of its rows.

    A term is a word or a stem. Its score is the log of the odds of its frequency in toxic
    documents over that in others, where a Dirichlet prior adds to both classes counts in
    proportion to the term's frequency in the two together. Terms whose log-odds are not
    ``LEAST_Z`` standard deviations from none, below ``LEAST_LOG_ODDS`` or in fewer than ``LEAST_DOCS`` toxic documents
    score nothing; the others are the model, which is bounded by the labelled sample. Words that a scored stem would
    take in although they themselves tell against it are kept with score 0.
    """
    counts = train.select("text", "toxic").mapInArrow(_count_terms, COUNTS).groupBy("term").agg(
        *(F.sum(c).alias(c) for c in ("docs1", "docs0", "uses0"))
    )
    counts = staged(counts.where(f"term = '' or docs1 >= {LEAST_DOCS} or docs0 >= {LEAST_DOCS}"), "terms")
    whole = counts.where("term = ''").first()
    if whole is None or not whole["docs1"] or not whole["docs0"]:
        return ToxicModel()
    n1, n0 = float(whole["docs1"]), float(whole["docs0"])
    prior = F.lit(PRIOR_EACH) + F.lit(PRIOR) * (F.col("docs1") + F.col("docs0")) / F.lit(n1 + n0)
    y1, y0 = F.col("docs1") + prior, F.col("docs0") + prior
    log_odds = F.log(y1 / (F.lit(n1 + PRIOR) - y1)) - F.log(y0 / (F.lit(n0 + PRIOR) - y0))
    scored = counts.where("term <> ''").select(
        "*", log_odds.alias("log_odds"), (log_odds / F.sqrt(1 / y1 + 1 / y0)).alias("z")
    )
    chosen = scored.where(
        f"docs1 >= {LEAST_DOCS} and z >= {LEAST_Z} and log_odds >= {LEAST_LOG_ODDS}"
    ).orderBy(F.desc("z"), "term").collect()
    if not chosen:
        return ToxicModel()
    scores = {r["term"]: min(TOP_SCORE, r["log_odds"]) for r in chosen}
    stems = [t for t in scores if t.endswith("-")]
    taken_in = F.lit(False)
    for n in PREFIXES:
        some = [s[:-1] for s in stems if len(s) == n + 1]
        if some:
            taken_in = taken_in | (F.substring("term", 1, n).isin(some) & (F.length("term") > n))
    against = scored.where(
        taken_in & ~F.endswith("term", F.lit("-")) & (F.col("log_odds") < 0) & (F.col("z") < -1)
    ).orderBy("z", "term").collect()
    for row in against:
        scores.setdefault(row["term"], 0.0)

    # Chance scores: what a token of a document that is not toxic scores, and how often.
    uses = float(whole["uses0"])
    rates = np.array([(r["uses0"] + 0.5) / (uses + 1.0) for r in chosen])
    worth = np.array([scores[r["term"]] for r in chosen])
    penalty = max(0.1, 4 * float(rates @ worth))
    return ToxicModel(scores, penalty, _decay(rates, worth, penalty))


def _decay(rates: np.ndarray, worth: np.ndarray, penalty: float) -> float:
    """The positive root of ``sum(rate * exp(x * score)) = 1`` over all tokens."""
    rest = max(0.0, 1.0 - float(rates.sum()))

    def excess(x: float) -> float:
        return float(rates @ np.exp(np.minimum(x * worth, 500))) + rest * math.exp(-x * penalty) - 1.0

    low, high = 1e-6, 1.0
    while excess(high) < 0 and high < 64:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return low


def scan(model: ToxicModel, text: Column) -> Column:
    """Struct of the evidence in a text and the token ranges of its significant passages."""

    @F.pandas_udf(SCAN)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        score = model.scorer()
        for texts in batches:
            rows = []
            for text in texts:
                words = tokens_of(text)
                evidence, best, found = model.evidence_of(words, score)
                spans = [{"start": a, "end": b + 1, "score": s} for a, b, s in found]
                rows.append((evidence, best, len(found), len(words), spans))
            yield pd.DataFrame(rows, columns=["evidence", "best", "segments", "tokens", "spans"])

    return run(text)


def calibrate(model: ToxicModel, judged: DataFrame) -> ToxicModel:
    """Fit the line from evidence to log-odds on ``judged`` (``evidence``, ``toxic``).

    All rows count, as a histogram of bounded size.
    """
    bins = judged.groupBy(
        F.round(F.col("evidence") * BINS_PER_UNIT).cast("int").alias("bin"), "toxic"
    ).count().collect()
    if not bins:
        return model
    x = np.array([b["bin"] / BINS_PER_UNIT for b in bins])
    y = np.array([float(b["toxic"]) for b in bins])
    n = np.array([float(b["count"]) for b in bins])
    # Two pseudo-documents of either class keep the line finite where the classes are apart.
    x = np.append(x, [NO_HIT, NO_HIT, 10.0, 10.0])
    y, n = np.append(y, [0, 1, 0, 1]), np.append(n, [1.0, 0.05, 0.05, 1.0])
    w = np.array([-1.0, 0.3])
    design = np.stack([np.ones_like(x), x], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (n * (y - p)) - 1e-3 * w
        curve = (design * (n * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    model.intercept, model.slope = float(w[0]), float(w[1])
    return model


def probability(model: ToxicModel, evidence: Column) -> Column:
    line = F.lit(model.intercept) + F.lit(model.slope) * evidence
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-line))


def is_held_out(id_col: Column) -> Column:
    """Rows that no label is learned from: crc32 of the id as text leaves no rest by 5."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
) -> ToxicModel:
    """The model from labelled rows that are not held out (see :func:`_labelled`).

    Terms are learned from some of them and the line from evidence to log-odds from others, so it is not made too steep by
    documents whose own words were learned. Only labelled documents are scanned.
    """
    known = _labelled(labels, id_col, label_col)
    labelled = docs.select(F.col(id_col).alias("label_id"), F.col(text_col).alias("text"))
    model = fit_scores(labelled.join(known.where("not line"), "label_id"))
    judged = labelled.join(known.where("line"), "label_id").select("toxic", scan(model, F.col("text"))["evidence"].alias("evidence"))
    return calibrate(model, judged)


def toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic",
) -> tuple[DataFrame, ToxicModel]:
    """Score every document: ``<id>, held_out, score, predicted, evidence, best, segments, tokens, spans``.

    Every maximal scoring segment of a text's token scores is found in one linear scan; those
    that chance does not explain in a text of that length are its toxic passages (``spans``,
    token ranges), and what they amount to is turned into a probability.

    A null, empty or wordless text has no evidence and gets the score of that. Repeated rows are scored
    each; ids that are null or repeated do no harm. Where no labels are known, the model has no terms and every score is the same
    low one. An empty table gives no rows. Only the two named columns of ``docs`` are read.
    """
    model = fit(docs, labels, id_col, text_col, label_col)
    scanned = docs.select(F.col(id_col), scan(model, F.col(text_col)).alias("s")).select(id_col, "s.*")
    score = probability(model, F.col("evidence"))
    out = scanned.select(
        id_col, is_held_out(F.col(id_col)).alias("held_out"), score.alias("score"),
        (score >= 0.5).cast("int").alias("predicted"), "evidence", "best", "segments", "tokens", "spans",
    )
    return out, model
