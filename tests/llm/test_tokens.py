"""Token output and packing against whole-text encoding."""

from __future__ import annotations

import functools
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from signals.llm import packing, token_output
from signals.llm.common import fresh_path
from signals.llm.tokens import WordEncoder, vocabulary_path

TEXTS = [
    None, "", " ", "\n\n", "it's  the THE don't\tx y", "A" * 300 + " b", "<|endoftext|> a b",
    "ÉÀ é ́x ​  z 12 34", "word " * 3000, "word " * 3000, "x", "日本語 テキスト ΣΑΣ ΣΑΣ.",
]


@functools.cache
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path())


def whole(text):
    return [*tokenizer().encode(text or "", add_special_tokens=False).ids, 1]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@pytest.fixture
def docs(spark):
    rows = [(i if i != 3 else None, t, i) for i, t in enumerate(TEXTS)] + [(10, "x", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, start long").repartition(3)


@pytest.fixture(scope="module")
def encoder():
    return WordEncoder(vocabulary_path(), 1, limit=6)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(codec="utf-8") | st.sampled_from(" \n\t'<|>sEndoftxÀéß7²_ ")))
def test_any_text_encodes_like_the_whole(encoder, text):
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == whole(text)


def test_words_encode_like_whole_texts(encoder):
    for text in TEXTS:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == whole(text)


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files_round_trip(spark, docs, encoding):
    path = token_output.write_tokens(
        docs, fresh_path(spark, "t"), vocabulary_path(), encoding=encoding
    )
    rows = [r.asDict() for r in token_output.token_digest(spark, path).collect()]
    source = sorted(
        ((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (-1 if r[0] is None else r[0])
    )
    want, start = [], 0
    for doc_id, text in source:
        ids = whole(text)
        want.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    got = [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    picked = token_output.read_tokens(spark, path, ["doc_id", "tokens"]).where("doc_id = 4").collect()
    assert [r.tokens for r in picked] == [whole(TEXTS[4])]


def test_unknown_encoding_is_refused(docs):
    with pytest.raises(ValueError):
        token_output.write_tokens(docs, "/nowhere", vocabulary_path(), encoding="other")


def test_empty_table(spark, docs):
    path = token_output.write_tokens(docs.limit(0), fresh_path(spark, "t"), vocabulary_path())
    assert token_output.token_digest(spark, path).count() == 0
    assert packing.pack(docs.limit(0), vocabulary_path()).count() == 0


def test_pieces_cover_every_id_once(spark, docs):
    pieces = packing.pack(docs, vocabulary_path(), open_windows=3, merge_parts=2).collect()
    by_window, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_window[p.sequence_id].append((p.offset, p.length))
        by_doc[p.doc_id].append(p)
    for runs in by_window.values():
        at = 0
        for offset, length in sorted(runs):
            assert offset == at and length > 0
            at += length
        assert at <= 2048
    for doc_id, text in {r.doc_id: r.text for r in docs.collect()}.items():
        ids = whole(text)
        copies = 2 if doc_id == 10 else 1
        assert sum(p.length for p in by_doc[doc_id]) == copies * len(ids)
        for p in by_doc[doc_id]:
            assert p.ids_crc32 == crc(ids[p.start : p.start + p.length])
            assert p.doc_tokens == len(ids)


def test_little_padding(spark):
    words = ["word " * (137 * i % 2500) for i in range(600)]
    docs = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string").repartition(8)
    pieces = packing.pack(docs, vocabulary_path())
    used = pieces.groupBy("sequence_id").sum("length").collect()
    total = sum(r[1] for r in used)
    assert len(used) * 2048 - total < 0.03 * total


def test_columns_encode_like_single_texts(monkeypatch):
    rng = random.Random(8)
    texts = [None, "", " ", "\n", "a", "Élan vital\n\nx  y", "漢字 ab", "tab\there"] + [
        "".join(rng.choice("ab é漢😀.\n -1") for _ in range(rng.randrange(60))) for _ in range(200)
    ]
    encoder = WordEncoder(vocabulary_path(), 1)
    column = pa.array(texts, pa.string())
    counts, ids = encoder.encode_column(column)
    assert ids.astype("<u4").tobytes() == b"".join(encoder.encode(t) for t in texts)
    assert counts.tolist() == [len(encoder.encode(t)) // 4 for t in texts]
    counts, ids = encoder.encode_column(column.slice(5, 3))
    assert ids.astype("<u4").tobytes() == b"".join(encoder.encode(t) for t in texts[5:8])
    assert [len(x) for x in encoder.encode_column(column.slice(0, 0))] == [0, 0]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), column], names=["i", "t"])
    for size in (1, 50, 10**6):
        monkeypatch.setattr(token_output, "SLICE_BYTES", size)
        cut = list(token_output.slices(batch))
        assert pa.Table.from_batches(cut) == pa.Table.from_batches([batch])
    assert len(cut) == 1 and not list(token_output.slices(batch.slice(0, 0)))
