"""Round trip of the token store against the tokenizers library itself."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from caseload.llm import op01_token_store as store

PATH = store.vocabulary_path()
TOKENIZER = Tokenizer.from_file(PATH)
ODD = ["", " ", "a\nb\r\nc\td", "don't we'll 'S", "x y z", "<|endoftext|> <|startoftext|>x", "é ́a", "ß ẞ ΑΣ Σ",
       "\x1c\x1d\x85 |", "日本語 テキスト", "a" * 5000, "123 4.5%", "   lead", "trail  \n"]


def ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_encoder_equals_library(text):
    assert np.frombuffer(store.Encoder(PATH, "<u4")(text), "<u4").tolist() == ids(text)


def test_encoder_odd_texts_and_small_cache(monkeypatch):
    monkeypatch.setattr(store, "CACHE_BYTES", 500)
    encode = store.Encoder(PATH, "<u4")
    for text in ODD * 2:
        assert np.frombuffer(encode(text), "<u4").tolist() == ids(text)


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(-(2**62), 2**62, 5000))
    slots = store.PerfectHash.build(keys).slots(keys)
    assert sorted(slots.tolist()) == list(range(len(keys)))


def expected(rows):
    start, out = 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1])):
        got = ids(text) + [2]
        out.append((i, start, len(got), zlib.crc32(np.array(got, "<u4").tobytes())))
        start += len(got)
    return out


def test_round_trip(spark, docs_of):
    rows = [(i * 7 - 30, t) for i, t in enumerate(ODD)] + [(5, None), (5, "b"), (5, "b"), (None, "no key"), (2**62, "far")]
    path = store.write_tokens(docs_of(rows))
    got = [tuple(r) for r in store.read_tokens(spark, path).orderBy("start").collect()]
    assert got == expected(rows)
    opened = store.TokenStore(path)
    for key in {i for i, _ in rows} - {None}:
        texts = sorted((t for i, t in rows if i == key), key=lambda t: (t is not None, t))
        assert [g.tolist() for g in opened.get(key)] == [ids(t) + [2] for t in texts]
    assert opened.get(123456) == []


def test_empty_and_clashing_columns(spark, docs_of):
    empty = docs_of([]).selectExpr("doc_id", "text", "1 as start", "2 as shard")
    assert store.read_tokens(spark, store.write_tokens(empty)).count() == 0


@pytest.mark.parametrize("width", ["<u2", "<u4"])
def test_payload_is_raw(spark, docs_of, width, monkeypatch):
    monkeypatch.setattr(store, "id_type", lambda path: width)
    path = store.write_tokens(docs_of([(2, "two words"), (1, "one")]).coalesce(1))
    opened = store.TokenStore(path)
    raw = b"".join(
        opened.files.open_input_file(f"{opened.root}/{s['name']}.bin").read() for s in opened.manifest["shards"]
    )
    assert np.frombuffer(raw, width).tolist() == ids("one") + [2] + ids("two words") + [2]


FIVE = ["J̌", "H̱", "T̈", "W̊", "Y̊"]  # capitals whose mark joins the small letter only


def test_ids_equal_the_library_on_odd_texts():
    from caseload.llm import op01_token_store as store

    path = store.vocabulary_path()
    encoder, library = store.Encoder(path, store.id_type(path)), store._tokenizer(path)
    texts = FIVE + [
        "", " ", "\n\n", "A b.,", "́ b", "İ I", "ſ K", "A\tB\r C\x0bD", "<|endoftext|> Ab<|endoftext|>c", "don't DON'T 'tis",
        "(word) [x], a1b2 -- !! word,%%% ***", "x" * 5000, "été ÉtÉ, 中文 text", "'s 'S it's", "a.b,c", "@a_b~`", "\x00 a",
    ]
    for text in texts + [" ".join(texts)]:
        ids = np.frombuffer(encoder(text), store.id_type(path)).tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids, text


def test_small_pieces_and_caches_give_the_same_ids(monkeypatch):
    import pyarrow as pa

    from caseload.llm import op01_token_store as store

    path = store.vocabulary_path()
    texts = [f"Word{i % 7} an other,{i} (thing) {'z' * (i % 5)}  end\n" * (i % 4) for i in range(60)]
    plain = b"".join(raw for raw, _ in store.Encoder(path, "<u2").encode(pa.array(texts), 2))
    monkeypatch.setattr(store, "PIECE_CHUNKS", 5)
    monkeypatch.setattr(store, "CACHE_BYTES", 2000)
    encoder = store.Encoder(path, "<u2")
    found = list(encoder.encode(pa.array(texts), 2))
    assert b"".join(raw for raw, _ in found) == plain
    library = store._tokenizer(path)
    assert [int(n) for _, counts in found for n in counts] == [len(library.encode(t, add_special_tokens=False).ids) + 1 for t in texts]
    assert len(encoder.new) + len(encoder.old) < 60


def test_a_worker_forgets_the_encoder_when_other_work_begins(spark):
    """Tasks of another module empty what the store keeps in their process."""
    from caseload.llm import common

    calls = []
    common.on_leave("elsewhere", lambda: calls.append(1))
    store._encoder(PATH, "<u2")
    assert store._encoder.cache_info().currsize
    common._leave[store.__name__]()
    assert not store._encoder.cache_info().currsize and not calls
    del common._leave["elsewhere"]
