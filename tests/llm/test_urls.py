import itertools
import math
import re
from collections import Counter

import pytest

from millrace.llm.common import table
from millrace.llm.urls import OTHER, RULES, SEED_BLOCKS, SEED_WEIGHT, SEEDS, WordModel, judge_urls

SCHEMA = "page_id long, url string, html string, host string, verdict string, tokens string"
HTML = "<p>casino news games club paper</p><script>var x</script> news paper club casino games " * 3
URLS = [
    None, "", "no-scheme/path", "http://", "://", "http://NET/", "http://a.net", "http://a.net/x", "http://xnet/",
    "http://example.net/en/1", "http://m.EXAMPLE.net/en/1?q=/de/", "http://example.net/EN/", "https://example.com/de/x",
    "https://a.example.com/de", "http://b.org/fr/?x", "http://b.org?/fr/", "http://org/fr/y#z", "http://b.com/fr/",
    "http://h?x://y/z", "x://y://z/w", "http://ÄÖ.net/", "http://u:p@h.net:80/", "http://\n.net/", "http://newspaperclub.com/1",
    "http://casinogames.com/adult/ads", "http://newspaper.com/news", "http://a.net/x",
]


def pages(spark):
    rows = [(i, u, HTML if i % 2 else None, "x", "y", None) for i, u in enumerate(URLS)]
    return spark.createDataFrame([*rows, (None, "http://a.net/", None, None, None, None), (1, None, None, None, None, None)], SCHEMA)


def parsed(url):
    found = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    if not found:
        return "", ""
    return "".join(c.lower() if c.isascii() else c for c in found[1]), found[2]


def rule(host, path):
    fits = [r for r in RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return (best[0] + best[1], best[2]) if best else (None, None)


def test_rules(spark):
    rows = judge_urls(pages(spark)).collect()
    assert len(rows) == pages(spark).count()
    by_id = {r.page_id: r for r in rows if r.page_id not in (None, 1)}
    for i, r in by_id.items():
        host, path = parsed(URLS[i])
        name, verdict = rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, name), URLS[i]
        assert r.verdict in ("allow", "block") and (verdict is None or r.verdict == verdict)
    assert judge_urls(pages(spark).limit(0)).count() == 0


def test_method_splits_names(spark):
    rows = {r.page_id: r for r in judge_urls(pages(spark)).collect() if r.page_id is not None}
    assert rows[23].tokens == ["news", "paper", "club"]
    assert rows[24].tokens == ["casino", "games", "adult", "ads"] and rows[24].verdict == "block"
    assert "casino" in SEEDS


def test_viterbi_is_the_cheapest_split():
    costs = {"a": 3.0, "ab": 2.0, "b": 2.5, "abc": 4.1, "c": 1.0, "bc": 2.2}
    model = WordModel(costs, 5.0)
    for n in range(1, 7):
        for text in map("".join, itertools.product("abc", repeat=n)):
            best = math.inf
            for cuts in itertools.product([0, 1], repeat=n - 1):
                edges = [0, *(i + 1 for i, c in enumerate(cuts) if c), n]
                best = min(best, sum(costs.get(text[a:b], math.inf) for a, b in itertools.pairwise(edges)))
            words = model.segment(text)
            assert "".join(words) == text
            assert abs(sum(costs[w] for w in words) - best) < 1e-9
    assert model.segment("xyabz") == ["xy", "ab", "z"]
    assert model.segment("") == []


def brute_verdicts(rows):
    """Tokens, log-odds and verdict of ``(url, html)`` rows, from the definitions."""
    uses = Counter()
    for _, html in rows:
        plain = re.sub(r"(?s)<(script|style)\b.*?</\1>|<[^>]*>", " ", html or "")
        uses.update(w for w in re.findall(r"[^\W\d_]+", plain.lower()) if len(w) > 1)
    uses.update(dict.fromkeys(SEEDS, SEED_WEIGHT))
    total = sum(uses.values())
    model = WordModel({w: -math.log(n / total) for w, n in uses.items()}, max(8.0, math.log(total)))
    judged = []
    for url, _ in rows:
        host, path = parsed(url)
        labels = host.split(":")[0].split(".")
        names = " ".join(labels[:-1] if len(labels) > 1 else labels)
        parts = re.findall(r"[^\W\d_]+", f"{names} {path}".lower())
        judged.append((rule(host, path)[1], [w if w in uses else OTHER for part in parts for w in model.segment(part)]))
    said = {v: Counter(w for verdict, words in judged if verdict == v for w in words) for v in ("block", "allow")}
    said["block"].update(dict.fromkeys(SEEDS, SEED_BLOCKS))
    seen = set(said["block"]) | set(said["allow"])
    sizes = {v: sum(c.values()) + len(seen) + 1 for v, c in said.items()}
    rows_of = Counter(verdict for verdict, _ in judged)
    start = math.log((rows_of["block"] + 1) / (rows_of["allow"] + 1))
    out = []
    for verdict, words in judged:
        odds = start + sum(
            math.log((said["block"][w] + 1) / sizes["block"]) - math.log((said["allow"][w] + 1) / sizes["allow"])
            for w in words if w in seen
        )
        out.append((words, odds, verdict or ("block" if odds > 0 else "allow")))
    return out


def same_as_brute(rows, found):
    for (words, odds, verdict), row in zip(brute_verdicts(rows), found, strict=True):
        assert row.tokens == words
        assert row.log_odds == pytest.approx(odds, abs=1e-6)
        assert row.verdict == verdict or abs(odds) < 1e-6


def test_verdicts_against_brute_force(spark):
    rows = [(u, HTML if i % 2 else None) for i, u in enumerate(URLS)]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string")
    same_as_brute(rows, judge_urls(frame).orderBy("page_id").collect())


def test_driver_verdicts_against_brute_force(spark, sf):
    pages = table(spark, sf, "pages")
    rows = [(r.url, r.html) for r in pages.orderBy("page_id").collect()]
    same_as_brute(rows, judge_urls(pages).orderBy("page_id").collect())


def test_seeds_are_outweighed(spark):
    rows = [(i, f"http://b.org/fr/poker/{i}", None) for i in range(200)]
    rows += [(200 + i, f"http://b.net/paper/{i}", None) for i in range(200)]
    rows += [(400, "http://b.com/poker", None), (401, "http://b.com/casino", None)]
    found = {r.page_id: r.verdict for r in judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert (found[400], found[401]) == ("allow", "block")


def test_rare_and_long_words_are_known(spark):
    word = "donaudampfschifffahrtsgesellschaft"
    rows = [(0, f"http://{word}paper.com/", f"<p>{word} paper"), (1, "http://a.com/" + "z" * 3000 + "paper", "paper")]
    found = {r.page_id: r.tokens for r in judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found[0] == [word, "paper"] and found[1] == [OTHER, OTHER, "paper"]
