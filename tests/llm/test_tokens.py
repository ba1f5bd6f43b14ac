"""Token counts and byte-level BPE against the libraries themselves."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from lakegauge.llm.bpe import ChunkEncoder, decode_ids, encode_documents, load_codec
from lakegauge.llm.tokens import safe_parts, token_counts

PIECES = public_tokenizers.path("piece_bpe_32k.model")
JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def pieces():
    return SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def codec():
    return load_codec(JSON, RANKS, public_tokenizers.PATTERN)


@pytest.mark.parametrize("part_bytes", [40, 1 << 16])
def test_counts_are_the_library_s(documents, texts, pieces, part_bytes):
    rows = token_counts(documents, PIECES, part_bytes=part_bytes, batch_bytes=3000).collect()
    assert len(rows) == len(texts)
    for row in rows:
        text = texts[row.doc_id]
        n_tokens = len(pieces.encode(text))
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(text.encode()), n_tokens, n_tokens > 4096)


def test_parts_lose_only_single_spaces():
    text = "ab cd  ef 1 2\n3 é f"
    assert list(safe_parts(text, 1)) == ["ab", "cd  ef", "1", "2\n3 é f"]
    assert list(safe_parts("x" * 100, 10)) == ["x" * 100]


def test_counts_of_odd_documents(odd_documents, no_documents, pieces):
    rows = token_counts(odd_documents, PIECES).collect()
    assert len(rows) == odd_documents.count()
    by_key = {row.doc_id: row for row in rows if row.doc_id is not None}
    assert (by_key[0].n_bytes, by_key[0].n_tokens) == (0, 0) == (by_key[1].n_bytes, by_key[1].n_tokens)
    for row in odd_documents.where("doc_id > 1").collect():
        assert by_key[row.doc_id].n_tokens == len(pieces.encode(row.text))
    assert token_counts(no_documents, PIECES).columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert token_counts(no_documents, PIECES).count() == 0


def encode(frame, **options):
    return encode_documents(frame, JSON, RANKS, public_tokenizers.PATTERN, **options)


def digests(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    packed = np.array(ids, "<u4").tobytes()
    return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


@pytest.mark.parametrize("chunk_bytes", [32, 512])
def test_ids_are_the_library_s(documents, texts, library, chunk_bytes):
    for row in encode(documents, chunk_bytes=chunk_bytes).collect():
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == digests(library, texts[row.doc_id])


def test_ids_of_odd_documents(odd_documents, no_documents, library, codec):
    rows = encode(odd_documents, with_ids=True).collect()
    assert len(rows) == odd_documents.count()
    whole = {row.doc_id: row.text or "" for row in odd_documents.where("doc_id IS NOT NULL").collect()}
    for row in rows:
        if row.doc_id is not None:
            assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == digests(library, whole[row.doc_id])
            assert decode_ids(row.ids, codec) == row.decoded == whole[row.doc_id]
    assert encode(no_documents).count() == 0


def test_random_texts_encode_as_whole(library, codec):
    source = random.Random(2)
    plain = [chr(c) for c in [9, 10, 13, *range(32, 127), *range(0xA1, 0x250)]]
    odd = [" ", "a", "é", "\xa0", " ", "  ", "\n", "<|endoftext|>", "😀", "中", "é", "1", "\x00", "!"]
    for letters, width in ((plain, 80), (odd, 120)):
        for _ in range(800):
            text = "".join(source.choice(letters if source.random() < 0.6 else [" ", "a", "'s", "\n"]) for _ in range(width))
            stretches = ChunkEncoder(codec, 16).encode(text)
            ids = library.encode(text, add_special_tokens=False).ids
            assert b"".join(s[0] for s in stretches) == np.array(ids, "<u4").tobytes()
            decoded = b"".join(s[1] for s in stretches).decode("utf-8", "replace")
            assert decoded == library.decode(ids, skip_special_tokens=False)


def test_shared_passages_are_encoded_once(codec):
    source = random.Random(5)
    passage = " ".join("".join(source.choices("abcdefgh", k=5)) for _ in range(2000))
    encoder = ChunkEncoder(codec, 256)
    encoder.encode("one " + passage)
    assert encoder.hits == 0
    encoder.encode("another beginning " + passage + " and end")
    assert encoder.hits > 20


def test_a_full_table_changes_nothing(codec, library):
    text = " ".join(str(n * n) for n in range(3000))
    stretches = ChunkEncoder(codec, 64, table_bytes=5000).encode(text)
    ids = library.encode(text, add_special_tokens=False).ids
    assert b"".join(s[0] for s in stretches) == np.array(ids, "<u4").tobytes()
