"""Decontamination against the full table of edit distances."""

from __future__ import annotations

import random
import re

from hypothesis import given, settings, strategies as st

from caseload.llm import op05_decontaminate as op

WORDS = [f"w{i}" for i in range(60)]


def closest(item, text):
    """Least edits between the item and any run of the text."""
    last = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        now = [i]
        for j, t in enumerate(text, 1):
            now.append(min(last[j - 1] + (w != t), last[j] + 1, now[-1] + 1))
        last = now
    return min(last)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.lists(st.integers(0, 3), max_size=14))
def test_myers(item, text):
    distance, begin, end = op.Pattern(item).best(text)
    assert distance == closest(item, text)
    if distance < len(item):
        assert closest(item, text[begin:end]) == distance


def split(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())


def brute_force(docs, items):
    out = set()
    for doc, text in docs:
        for item, want in items:
            w = split(want)
            if len(w) >= op.MIN_WORDS and closest(w, split(text)) <= int(op.BUDGET * len(w) + 1e-9):
                out.add((doc, item, closest(w, split(text))))
    return out


def sample(seed):
    rng = random.Random(seed)
    items = [(i, " ".join(rng.choice(WORDS) for _ in range(rng.choice((3, 5, 8, 14, 30))))) for i in range(12)]
    docs = []
    for i in range(60):
        text = [rng.choice(WORDS) for _ in range(rng.choice((0, 5, 40)))]
        if i % 3:
            part = rng.choice(items)[1].split()
            for _ in range(rng.randrange(0, 2 + len(part) // 4)):
                at = rng.randrange(len(part))
                part[at : at + rng.choice((0, 1))] = rng.choice(([], [rng.choice(WORDS)]))
                part = part or ["w1"]
            at = rng.randrange(len(text) + 1)
            text[at:at] = part
        docs.append((i, rng.choice((" ", ", ", "\n")).join(w.upper() if rng.random() < 0.2 else w for w in text)))
    return docs, items


def test_equals_brute_force(spark, docs_of, monkeypatch):
    for seed, words in ((1, op.ITEM_WORDS), (2, 40)):
        monkeypatch.setattr(op, "ITEM_WORDS", words)
        docs, items = sample(seed)
        docs += [(100, None), (101, ""), (102, items[4][1] + " x " * 50_000 + items[4][1]), (0, docs[0][1])]
        frame = spark.createDataFrame([*items, (50, None), (51, "")], "item_id long, text string")
        got = [(r.doc_id, r.item_id, r.distance) for r in op.find_contamination(docs_of(docs), frame).collect()]
        assert set(got) == brute_force(docs, items)
        assert len(list(op.item_blocks(frame, words))) >= (1 if words > 1000 else 2)


def test_drop_keeps_columns_and_clean_rows(spark, docs_of):
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta")], "item_id long, text string")
    docs = docs_of([(1, "so Alpha, beta; gamma delta epsilon zeta!"), (2, "alpha beta"), (3, None), (None, "clean"), (2, "alpha beta")])
    docs = docs.selectExpr("*", "7 as hits", "8 as row", "9 as item_id")
    kept = op.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.hits, r.row, r.item_id) for r in kept.collect()) == [(0, 7, 8, 9), (2, 7, 8, 9), (2, 7, 8, 9), (3, 7, 8, 9)]
    none = spark.createDataFrame([], "item_id long, text string")
    assert op.drop_contaminated(docs, none).count() == 5 and op.find_contamination(docs, none).count() == 0
    assert op.find_contamination(docs_of([]), items).count() == 0


def test_short_items_are_found_as_they_are(spark, docs_of):
    items = [(1, "Yes."), (2, "E=mc^2"), (3, "alpha beta"), (4, "one two three four"), (5, "?!"), (6, "beta gamma")]
    docs = [
        (1, "alpha yes, alpha beta yes"), (2, "as e = mc^2 says"), (3, "alpha x beta"), (4, "one two three four"), (5, "one two four three"), (6, "?! eyes"),
        (7, "alpha beta gamma " * 3),
    ]
    # two pieces of a longer item are the short items' words
    longer = [(7, "alpha beta gamma delta one")]
    frame = spark.createDataFrame(items + longer, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.distance, r.begin, r.end) for r in op.find_contamination(docs_of(docs), frame).collect() if r.item_id != 7}
    assert got == {(1, 1, 0, 1, 2), (1, 3, 0, 2, 4), (2, 2, 0, 1, 4), (4, 4, 0, 0, 4), (7, 3, 0, 0, 2), (7, 6, 0, 1, 3)}
    assert {r.doc_id for r in op.drop_contaminated(docs_of(docs), frame).collect()} == {3, 5, 6}


def characters(text):
    unspaced = "\u3040-\u30ff\u3400-\u9fff\u0e01-\u0e5b"
    return re.findall(f"[{unspaced}]|[a-z0-9\u00c0-\u0dff]+", re.sub("[\u3000-\u3003\uff00-\uff0f\uff1a-\uff20]", " ", text.lower()))


def test_texts_without_spaces_match_by_character(spark, docs_of):
    items = [(1, "床前明月光，疑是地上霜。"), (2, "首都"), (3, "カレーを食べました"), (4, "กรุงเทพมหานคร"), (5, "été à Paris")]
    docs = [
        (1, "李白写道：「床前明月光疑是地上霜」，很有名。"), (2, "床前看月光，疑是地下霜"), (3, "床前看月亮，疑似地下水"), (4, "北京是中国的首都。"), (5, "首 abc 都"),
        (6, "昨日、カレーを食べましたよ"), (7, "ฉันอยู่กรุงเทพมหานครนานแล้ว"), (8, "L’été à Paris, enfin"), (9, "首，都"), (10, "clean"),
    ]
    want = {
        (d, i, closest(w, characters(t))) for d, t in docs for i, x in items
        if (w := characters(x)) and closest(w, characters(t)) <= int(op.BUDGET * len(w) + 1e-9)
    }
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.distance) for r in op.find_contamination(docs_of(docs), frame).collect()}
    assert got == want
    assert {(1, 1, 0), (2, 1, 2), (4, 2, 0), (6, 3, 0), (7, 4, 0), (8, 5, 0)} <= got
    assert not {3, 5, 10} & {d for d, *_ in got}
