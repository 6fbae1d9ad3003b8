"""URL verdicts: host rules first, then naive Bayes over segmented host and path words."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import LOWER, UPPER, staged

RULES = (
    ("net", "/", "block"), ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
)
# Words that tell of a site to block before any row is seen: words of SEED_WEIGHT uses in the pages and of
# SEED_BLOCKS in blocked urls, which rows that say otherwise outweigh.
SEEDS = (
    "ad", "ads", "adult", "banner", "bet", "bets", "betting", "casino", "escort", "gamble",
    "gambling", "hentai", "malware", "nude", "phish", "poker", "popup", "porn", "sex", "slots",
    "spam", "torrent", "track", "tracker", "tracking", "viagra", "warez", "xxx",
)
SEED_WEIGHT, SEED_BLOCKS = 50, 20
LEAST_LETTERS = 2  # of a word; a letter on its own is none
OTHER = "<other>"
SMOOTHING = 1.0
CANDIDATES, SPLITS = "word string, part_id long", "part string, words array<string>"


def parse(url: Column) -> tuple[Column, Column]:
    """Host and path: what follows the first ``://``; both empty where there is none."""
    form = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, form, 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, form, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, start, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(start))
        rule = F.when(fits, name + start).otherwise(rule)
        verdict = F.when(fits, says).otherwise(verdict)
    return rule, verdict


@dataclass
class WordModel:
    """Unigram costs of known words. An unknown stretch costs more the longer it is."""

    costs: dict[str, float]
    unknown: float

    def segment(self, text: str) -> list[str]:
        """The cheapest split of ``text`` into words, by Viterbi; an unknown stretch is one piece."""
        longest = max(map(len, self.costs), default=0)
        best: list[tuple[float, int, bool]] = [(0.0, 0, True)]
        for end in range(1, len(text) + 1):
            choice = (best[end - 1][0] + self.unknown, end - 1, False)
            for start in range(max(0, end - longest), end):
                cost = self.costs.get(text[start:end])
                if cost is not None and best[start][0] + cost < choice[0]:
                    choice = (best[start][0] + cost, start, True)
            best.append(choice)
        words, end = [], len(text)
        while end:
            _, start, known = best[end]
            if known or not words or words[-1][0]:
                words.append((known, [text[start:end]]))
            else:
                words[-1][1].append(text[start:end])
            end = start
        return ["".join(reversed(letters)) for _, letters in reversed(words)]

    def tokens(self, part: str) -> list[str]:
        return [w if w in self.costs else OTHER for w in self.segment(part)]


def name_parts(host: Column, path: Column) -> Column:
    """Runs of letters in all host labels but the last, and in the path, in order."""
    labels = F.split(F.substring_index(host, ":", 1), r"\.")
    names = F.when(F.size(labels) > 1, F.slice(labels, F.lit(1), F.size(labels) - 1)).otherwise(labels)
    return F.regexp_extract_all(F.lower(F.concat(F.array_join(names, " "), F.lit(" "), path)), F.lit(r"(\p{L}+)"), 1)


def learn_words(pages: DataFrame, text_col: str, seeds=SEEDS) -> DataFrame:
    """Uses (``word, uses``) of all words in all pages' text, without markup. Seeds are always known."""
    plain = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), r"(?s)<(script|style)\b.*?</\1>|<[^>]*>", " ")
    words = pages.select(F.explode(F.split(F.lower(plain), r"[^\p{L}]+")).alias("word"))
    counts = words.where(F.length("word") >= LEAST_LETTERS).groupBy("word").agg(F.count("*").alias("uses"))
    more = pages.sparkSession.createDataFrame([(s, SEED_WEIGHT) for s in seeds], "word string, uses long")
    return counts.unionAll(more).groupBy("word").agg(F.sum("uses").alias("uses"))


def _candidates(lengths: list[int]) -> Callable:
    """All substrings of each part that are as long as some word is."""

    def rows(ids: list[int], parts: list[str]) -> Iterator[tuple[str, int]]:
        for part_id, part in zip(ids, parts, strict=True):
            for start in range(len(part)):
                for length in lengths:
                    if start + length > len(part):
                        break
                    yield part[start:start + length], part_id

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = rows(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            while some := list(itertools.islice(found, 20_000)):
                words, ids = zip(*some, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(ids, pa.int64())], names=["word", "part_id"])

    return run


def _splits(total: float) -> Callable:
    """The split of each part by the words found in it."""
    # A word has the cost of its frequency; a letter on its own that of a guess among all words.
    unknown = max(8.0, math.log(total))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                rows = batch.slice(at, 1000)
                parts, known = rows.column(0).to_pylist(), rows.column(1).to_pylist()
                out = [
                    WordModel({w["word"]: -math.log(w["uses"] / total) for w in words or ()}, unknown).tokens(part)
                    for part, words in zip(parts, known, strict=True)
                ]
                yield pa.RecordBatch.from_arrays([pa.array(parts, pa.string()), pa.array(out, pa.list_(pa.string()))], names=["part", "words"])

    return run


def split_parts(parts: DataFrame, words: DataFrame) -> DataFrame:
    """``part, words``: each distinct ``part`` split by the unigram model of ``words`` (``word, uses``).

    A part's substrings are joined to the words, so each part is split by its own few words and no task holds
    the vocabulary. Words of all lengths and frequencies count. What comes to the driver is the lengths that
    occur and the sum of uses.
    """
    parts = staged(parts.distinct().select(F.monotonically_increasing_id().alias("part_id"), "part"), "url-parts")
    lengths = sorted(r["n"] for r in words.select(F.length("word").alias("n")).distinct().collect())
    total = float(words.agg(F.sum("uses")).first()[0] or 1)
    some = parts.mapInArrow(_candidates(lengths), CANDIDATES).distinct()
    known = some.join(words, "word").groupBy("part_id").agg(F.collect_list(F.struct("word", "uses")).alias("known"))
    return parts.join(known, "part_id", "left").select("part", "known").mapInArrow(_splits(total), SPLITS)


def fit_bayes(judged: DataFrame, seeds=SEEDS) -> tuple[float, DataFrame]:
    """Log-odds of ``block``: of a url before its tokens, and of each token (``token, odds``).

    ``judged`` has ``tokens`` and the numbers of rows that a rule blocks (``block``) or allows (``allow``).
    Multinomial naive Bayes with add-one smoothing; a seed has ``SEED_BLOCKS`` uses in blocked urls beforehand.
    """
    known = judged.where("block + allow > 0")
    uses = known.select(F.explode("tokens").alias("token"), "block", "allow")
    more = judged.sparkSession.createDataFrame([(s, SEED_BLOCKS, 0) for s in seeds], "token string, block long, allow long")
    uses = uses.unionAll(more).groupBy("token").agg(F.sum("block").alias("block"), F.sum("allow").alias("allow"))
    uses = staged(uses, "url-tokens")
    all_uses = uses.agg(F.sum("block"), F.sum("allow"), F.count("*")).first()
    block, allow = (float(all_uses[i] or 0) + SMOOTHING * (all_uses[2] + 1) for i in (0, 1))
    odds = F.log((F.col("block") + SMOOTHING) / block) - F.log((F.col("allow") + SMOOTHING) / allow)
    rows = known.agg(F.sum("block"), F.sum("allow")).first()
    start = math.log(((rows[0] or 0) + 1.0) / ((rows[1] or 0) + 1.0))
    # Decimals, whose sum does not depend on the order of rows.
    return start, uses.select("token", odds.cast("decimal(18,12)").alias("odds"))


def judge_urls(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", text_col: str = "html",
    rules=RULES,
) -> DataFrame:
    """Verdict on every row's url: ``<id>, host, path, rule, verdict, tokens, log_odds``.

    A url on which a rule falls has the verdict of the longest such rule. All others are judged
    by the words in their host and path: names run together are split by a unigram model of the
    pages' own words (:func:`split_parts`), and naive Bayes, learned from the urls that rules decide and from
    some uses of seed words, tells ``block`` (log-odds above 0) from ``allow``. Tokens that no such url holds say nothing.

    A null url, one without ``://`` or an empty one has an empty host and path, no rule, no tokens, and the
    verdict of the prior. Repeated rows are judged each. An empty table gives no rows. Only the
    three named columns are read.
    """
    host, path = parse(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("row_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = staged(rows.select("*", rule.alias("rule"), verdict.alias("ruled")), "url-rows")
    urls = rows.groupBy("host", "path").agg(
        F.count_if(F.col("ruled") == "block").alias("block"), F.count_if(F.col("ruled") == "allow").alias("allow")
    )
    urls = staged(urls.select("*", name_parts(F.col("host"), F.col("path")).alias("parts")), "urls")
    words = staged(learn_words(pages, text_col), "words")
    splits = staged(split_parts(urls.select(F.explode("parts").alias("part")), words), "url-splits")
    url = ["host", "path", "block", "allow"]
    placed = urls.select(*url, F.posexplode_outer("parts").alias("at", "part")).join(splits, "part", "left")
    placed = placed.groupBy(*url).agg(F.array_sort(F.collect_list(F.struct("at", "words"))).alias("found"))
    found = F.filter(F.transform("found", lambda f: f["words"]), lambda w: w.isNotNull())
    judged = staged(placed.select(*url, F.flatten(found).alias("tokens")), "url-judged")
    start, odds = fit_bayes(judged)
    sums = judged.select("host", "path", F.explode_outer("tokens").alias("token")).join(odds, "token", "left")
    sums = sums.groupBy("host", "path").agg(F.coalesce(F.sum("odds"), F.lit(0)).cast("double").alias("sum"))
    judged = judged.join(sums, ["host", "path"]).select("host", "path", "tokens", (F.col("sum") + start).alias("log_odds"))
    method = F.when(F.col("log_odds") > 0, "block").otherwise("allow")
    return rows.join(judged, ["host", "path"]).select(
        F.col("row_id").alias(id_col), "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), "tokens", "log_odds"
    )
