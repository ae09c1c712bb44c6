"""Run detection against brute force over all places and periods."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from caseload.llm.op12_runs import Grammar, collapse_runs, runs_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words):
    """{(start, length): period} of all runs, straight from the definition."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def numbers(texts):
    offsets = np.cumsum([0, *map(len, texts)])
    return np.array([x for t in texts for x in t], np.int64), offsets


@st.composite
def repeating(draw):
    """Texts over few words in which stretches repeat."""
    words = draw(st.lists(st.integers(0, 2), max_size=60))
    for _ in range(draw(st.integers(0, 3))):
        if words:
            a = draw(st.integers(0, len(words) - 1))
            p = draw(st.integers(1, 9))
            for i in range(a, draw(st.integers(a, len(words)))):
                words[i] = words[a + (i - a) % p]
    return words


@settings(max_examples=200, deadline=None)
@given(st.lists(repeating(), min_size=1, max_size=6))
def test_runs_of_many_texts(texts):
    found = runs_of(*numbers(texts))
    for t, words in enumerate(texts):
        assert sorted(tuple(map(int, r[1:])) for r in found[found[:, 0] == t]) == brute(words)


@pytest.mark.parametrize("words", [
    [0] * 5, [0] * 6, [0, 1] * 3, [0, 1] * 4, [0] * 7 + [1] * 9, [0, 0, 1] * 4 + [2], ([0, 1, 0, 2] * 4 + [3]) * 4,
    list(range(300)) * 4, list(range(300)) * 3 + list(range(299)),
])
def test_edges(words):
    assert [tuple(map(int, r[1:])) for r in runs_of(*numbers([words]))] == brute(words)


def test_extension_equals_word_by_word():
    rng = np.random.default_rng(5)
    word = np.concatenate([[100], np.tile(rng.integers(0, 3, 90), 9), rng.integers(0, 2, 200), np.zeros(300, int), [101]])
    grammar = Grammar(word.astype(np.int64), 100)
    a = rng.integers(1, len(word) - 2, 400)
    b = rng.integers(a + 1, len(word) - 1)
    ahead, back = grammar.extend(a, b, 1), grammar.extend(a, b, -1)
    for x, y, f, g in zip(a, b, ahead, back):
        n = 0
        while y + n < len(word) and word[x + n] == word[y + n]:
            n += 1
        m = 0
        while word[x - m] == word[y - m]:
            m += 1
        assert (n, m) == (f, g)


def test_steps_do_not_follow_length():
    """A grammar of a long periodic text is small, whatever its length."""
    sizes = [len(Grammar(np.concatenate([[9], np.tile([0, 1, 2], n), [10]]), 9).name) - 3 * n for n in (1_000, 100_000)]
    assert sizes[1] < 3.2 * 100 * sizes[0]


def test_query_against_brute_force(spark, rows, tmp_path):
    """The registered query over rows that hold every defined case."""
    from caseload.llm import QUERIES

    texts = {i: " ".join(f"w{(i * 7 + k * k) % (3 + i % 11)}" for k in range(i % 97)) for i in range(300)}
    texts |= {
        1001: None, 1002: "", 1003: " \t\n ", 1004: "a\xa0b " * 30, 1005: "x " * 20_000, 1006: "ab abc " * 9 + "a\x1cb",
        1007: "the cat sat " * 4 + "and the cat sat " * 4, 1008: "é" * 5000 + " y" * 6,
    }
    data = [(i, t) for i, t in texts.items()] + [(5, texts[5]), (None, "z z z z z z"), (None, None)]
    spark.createDataFrame(
        [(i, t, 7, "k") for i, t in data], "doc_id long, text string, runs int, collapsed string",
    ).write.parquet(f"{tmp_path}/documents.parquet")
    expected = []
    for i, t in data:
        words = WORD.findall(t or "")
        h = zlib.crc32(str(i).encode()) if i is not None else None
        n, g = len(words), (h or 0) // 10
        if h is not None and h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (k - a) % p] for k in range(a, n)]
        runs = brute(words) if n < 2000 else [(0, n, 1)]
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in sorted(runs, key=lambda r: (r[0], r[2])))
        expected.append((
            i, len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2], sha(lines), sha(collapsed(words, runs)),
        ))
    key = lambda r: tuple((x is not None, x) for x in r)
    got = [tuple(r) for r in QUERIES["op12_runs"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=key) == sorted(expected, key=key)
    assert sum(r[1] > 0 for r in expected) > 30


def test_columns_and_empty_tables(spark, rows):
    docs = spark.createDataFrame([(1, "a a a a a a b", "kept")], "doc_id long, text string, start string")
    assert [tuple(r) for r in collapse_runs(docs).collect()] == [(1, "a a a a a a b", "kept", [(0, 6, 1)], "a b")]
    assert collapse_runs(docs.limit(0)).collect() == []
