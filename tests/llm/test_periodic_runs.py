"""Periodic runs against a search over all periods, with the odd rows."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import periodic_runs


def brute_force(words):
    """Every maximal stretch of every period, without those that have a smaller one."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.append((i, j + q - i, q))
            i = max(i + 1, j)
    return sorted((r for r in found if not any(p < r[2] and s <= r[0] and r[0] + r[1] <= s + k for s, k, p in found)), key=lambda r: (r[0], r[2]))


def texts(seed, count):
    rng = random.Random(seed)
    for _ in range(count):
        n, letters = rng.randint(0, 160), rng.choice([1, 2, 3, 5, 30])
        words = [f"w{rng.randrange(letters)}" for _ in range(n)]
        for _ in range(rng.randint(0, 3) if n else 0):
            a = rng.randrange(n)
            p, old = 1 + (n - a) // rng.randint(3, 10), list(words)
            for i in range(a, rng.randint(a, n)):
                words[i] = old[a + (i - a) % p]
        if rng.random() < 0.2:  # runs inside the period of a longer run
            words = ((words[:3] or ["x"]) * rng.randint(3, 9) + ["y"]) * rng.randint(3, 7)
        yield words


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_the_search_over_all_periods(seed):
    batch = list(texts(seed, 300))
    words, bounds = periodic_runs._numbered([[w.encode() for w in t] for t in batch])
    assert periodic_runs.runs_of(words, bounds) == [brute_force(t) for t in batch]


def test_long_runs():
    for words in (["a"] * 100_000, ["a", "b", "a"] * 30_000 + ["c"], [f"w{k % 4096}" for k in range(20_000)]):
        numbers, bounds = periodic_runs._numbered([[w.encode() for w in words]])
        n = len(words) - (words[-1] == "c")
        assert periodic_runs.runs_of(numbers, bounds) == [[(0, n, len(set(words[:n])) if words[0] != "a" or words[1] == "a" else 3)]]


def test_odd_rows(spark, rows):
    given = [(1, "a b " * 4 + "c", 0), (2, None, 0), (3, "", 0), (4, " \n\t ", 0), (1, "a b " * 4 + "c", 0), (None, "x " * 7, 0), (5, "é\x0bé\x0cé\ré\né é", 0), (6, "word " * 60_000 + "end", 0), (7, "a A a A a A", 0)]
    frame = spark.createDataFrame(given, "doc_id long, text string, runs int").repartition(2)
    found = [(r["doc_id"], r["n_words"], [tuple(x.values()) for x in r["runs"]], r["collapsed"]) for r in rows(periodic_runs.find_runs(frame), "doc_id")]
    run = (1, 9, [(0, 8, 2)], "a b c")
    assert found == [(None, 7, [(0, 7, 1)], "x"), run, run, (2, 0, [], ""), (3, 0, [], ""), (4, 0, [], ""), (5, 6, [(0, 6, 1)], "é"), (6, 60_001, [(0, 60_000, 1)], "word end"), (7, 6, [], "a A a A a A")]
    assert periodic_runs.find_runs(frame.where("doc_id = 99")).count() == 0
    other = frame.select(F.col("doc_id").cast("string").alias("name"), F.col("text").alias("body"))
    assert periodic_runs.find_runs(other, "name", "body").columns == ["name", "n_words", "runs", "collapsed"]


def test_cycles(spark):
    plain = " ".join(f"w{k}" for k in range(50))
    given = [(k, plain) for k in range(60)] + [(None, plain), (61, None), (62, "")]
    found = {r.doc_id: r.text for r in periodic_runs.with_cycles(spark.createDataFrame(given, "doc_id long, text string")).collect()}
    for k, text in given:
        h, words = zlib.crc32(str(k).encode()), (text or "").split()
        if k is not None and h % 10 == 0 and words:
            a, n = h // 10 % len(words), len(words)
            p = 1 + (n - a) // (3 + h // 10 % 8)
            text = " ".join(words[i] if i < a else words[a + (i - a) % p] for i in range(n))
        assert found[k] == text
    assert sum(found[k] != plain for k in range(60)) >= 2
