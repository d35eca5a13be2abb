import random

import numpy as np
import public_tokenizers
import pyarrow as pa

from tests.llm import brute
from tests.llm.conftest import SMALL, frame
from urbanlens.llm import bpe
from urbanlens.llm.chunks import encode_rows
from urbanlens.llm.common import text_blocks


def ids_of(texts):
    with open(public_tokenizers.path(bpe.RANK_FILE), "rb") as f:
        coder = bpe.Bpe(f.read(), public_tokenizers.PATTERN)
    out = []
    for lo, hi, data, offsets in text_blocks(pa.array(texts, pa.string()), 4096):
        ids, ends = encode_rows(data, offsets, coder.chunks, coder.encode_chunks)
        raw, at = coder.decode(ids)
        for i in range(hi - lo):
            out.append(ids[ends[i] : ends[i + 1]].tolist())
            assert raw[at[ends[i]] : at[ends[i + 1]]].tobytes().decode() == texts[lo + i]
    return out


def test_equals_the_public_encoder():
    rnd = random.Random(1)
    letters = " \n\t'sdtrevm  aéèß中文　 \u0085\x1c\x1f .!?109é \U0001f600ÀÉ’-_"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(4000)]
    texts += ["a" * 5000, "ab" * 3000, " " * 1000, "\n" * 500 + "x", "é" * 2000, "".join(rnd.choice("abcdefgh") for _ in range(20_000))]
    coder = brute.encoding()
    assert ids_of(texts) == [coder.encode_ordinary(t) for t in texts]


def test_equal_ranks_merge_leftmost_first():
    raw = b"YQ== 0\nYg== 1\nYWE= 2\nYWFh 3\n"  # a, b, aa, aaa
    coder = bpe.Bpe(raw, public_tokenizers.PATTERN)
    assert coder.merge(b"aaaaa") == [2, 3] and coder.merge(b"aaab") == [3, 1]


def test_short_pre_tokens_merge_like_long_ones(monkeypatch):
    rnd = random.Random(3)
    with open(public_tokenizers.path(bpe.RANK_FILE), "rb") as f:
        coder = bpe.Bpe(f.read(), public_tokenizers.PATTERN)
    for letters, n in (("aaab", 9), ("abcdefgh", 30), ("etaoinshr", 12), ("éèaß中文", 8), ("ab", 40), ("a", bpe.SHORT), ("the", bpe.SHORT - 1)):
        for _ in range(200):
            piece = "".join(rnd.choice(letters) for _ in range(rnd.randint(2, n))).encode()
            if piece in coder.ranks:
                continue
            short = coder.merge_short(piece)
            with monkeypatch.context() as m:
                m.setattr(bpe, "SHORT", 0)
                assert coder.merge(piece) == short
    assert not any(coder.places) and not any(coder.low)  # the queue is left empty


def test_query_round_trip_and_edges(spark, small_docs):
    import hashlib

    coder = brute.encoding()
    got = {r.doc_id: r for r in bpe.query(spark, SMALL).collect()}
    for i, t, _ in small_docs:
        ids = np.array(coder.encode_ordinary(t or ""), "<u4")
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    docs = frame(spark, [(1, None), (2, ""), (None, "x y"), (3, "x y"), (3, "x y")])
    out = bpe.encode_documents(spark, docs, "").collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in out) == [(0, 2), (1, 0), (2, 0), (3, 2), (3, 2)]
    assert bpe.encode_documents(spark, docs.where("false"), "").count() == 0
