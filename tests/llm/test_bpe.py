from __future__ import annotations

from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from daybook.llm import bpe

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    found = bpe.Encoder(RANKS)
    yield found
    found.close()


def same(texts, encoder):
    splitter = bpe.Splitter(public_tokenizers.PATTERN)
    for text, (ids, decoded) in zip(texts, bpe.encode_run(texts, splitter, encoder), strict=True):
        assert ids.tolist() == LIBRARY.encode_ordinary(text)
        assert decoded == text.encode()


def test_like_the_library(encoder):
    same(
        ["", " ", "a", "  two  spaces ", "tail \n", "\n\nlead", "it's we'll 'd", "½ Ⅷ 3rd x²", "漢字 한국 😀", "\x1c \x85 \xa0x",
         "z" * 5000, "ab" * 700, " " * 3000, "é" * 600, "a <|endoftext|> b", "x " * 500],
        encoder,
    )


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab eE\n\t '.,s1½é漢\x1c\xa0_*"), max_size=40), max_size=6))
def test_any_text(texts):
    found = bpe.Encoder.__new__(bpe.Encoder)
    found.__dict__.update(_shared().__dict__)
    same(texts, found)


_KNOWN: list[bpe.Encoder] = []


def _shared():
    if not _KNOWN:
        _KNOWN.append(bpe.Encoder(RANKS))
    return _KNOWN[0]


def test_remembered_pieces_are_those_of_the_vocabulary():
    bytes_only = {bytes([i]): i for i in range(256)}
    texts = [b"qzqzqz", b"xyxyxyxy", b"wvwvwv", b"qpqpqp", b"jkjkjk"]
    expected = [LIBRARY.encode_ordinary(t.decode()) for t in texts]
    for _ in range(2):
        plain = bpe.Encoder(bytes_only)  # what another vocabulary gave is forgotten
        assert [i.tolist() for i in plain.encode(texts)[0]] == [list(t) for t in texts]
        assert plain.encode(texts)[1] == texts
        plain.close()
        known = bpe.Encoder(RANKS, run_chars=3 * bpe.REMEMBERED)
        for _ in range(2):
            assert [i.tolist() for i in known.encode(texts)[0]] == expected
        assert len(known.known) == 3
        known.close()


def test_pieces_just_below_and_above_the_long_limit(encoder):
    pieces = [b"ab" * (bpe.LONG_PIECE // 2 + d) for d in (-1, 0, 1)]
    ids, decoded = encoder.encode(pieces)
    for piece, own, text in zip(pieces, ids, decoded):
        assert own.tolist() == LIBRARY.encode_ordinary(piece.decode())
        assert text == piece


def test_runs_and_digests(spark, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(bpe, "RUN_CHARS", 100)
    rows = bpe.digests(odd_docs, RANKS, public_tokenizers.PATTERN).collect()
    texts = [r["text"] or "" for r in odd_docs.collect()]

    def expected(text):
        ids = LIBRARY.encode_ordinary(text)
        return len(ids), sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha256(text.encode()).hexdigest()

    found = sorted((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows)
    assert found == sorted(map(expected, texts))
    assert bpe.encode(no_docs, RANKS, public_tokenizers.PATTERN).count() == 0
    whole = bpe.encode(odd_docs.where("doc_id = 1"), RANKS, public_tokenizers.PATTERN).first()
    assert whole["ids"] == LIBRARY.encode_ordinary(odd_docs.where("doc_id = 1").first()["text"])
