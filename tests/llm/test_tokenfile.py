import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tests.llm.conftest import SMALL, frame
from urbanlens.llm import idcoder, tokenfile
from urbanlens.llm.chunks import distinct


def library():
    t = Tokenizer.from_file(public_tokenizers.path(tokenfile.TOKENIZER))
    t.encode_special_tokens = True
    return t


def expected(docs):
    rows = sorted(((i, t or "") for i, t in docs), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    at, out = 0, []
    for (i, _), e in zip(rows, library().encode_batch([t for _, t in rows], add_special_tokens=False), strict=True):
        ids = np.array([*e.ids, 2], "<u4")
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_query_equals_the_library(spark, small_docs):
    got = sorted((r.start, r) for r in tokenfile.query(spark, SMALL).collect())
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for _, r in got] == expected([(i, t) for i, t, _ in small_docs])


def test_chunks_equal_whole_texts():
    with open(public_tokenizers.path(tokenfile.TOKENIZER), "rb") as f:
        encoder = tokenfile.Encoder(f.read())
    rnd = random.Random(1)
    letters = [*" \n\t'sdtrevm  aéèß中文　 \u0085\x1c.!?109é \U0001f600ÀÉ’-_İΣς", "<|endoftext|>"]
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(4000)] + ["a" * 3000]
    got = []
    for _, size, ids in encoder.rows(pa.array(texts)):
        got += [x.tolist() for x in np.split(ids, np.cumsum(size)[:-1])]
    assert got == [e.ids for e in library().encode_batch(texts, add_special_tokens=False)]


def test_blocks_and_edges(spark, scratch):
    docs = [(3, "b c"), (1, None), (2, ""), (None, "no id"), (3, "b c"), (3, "a"), (9, "long words " * 20_000)]
    path = f"{scratch}/ids"
    tokenfile.write(frame(spark, docs), path, block_ids=4)
    rows = sorted((r.start, r) for r in tokenfile.read_back(spark, path).collect())
    assert [(r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for _, r in rows] == expected(docs)
    assert spark.read.parquet(path).count() > 3
    none = f"{scratch}/none"
    tokenfile.write(frame(spark, []), none)
    assert tokenfile.read_back(spark, none).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 1000, 70_000])
def test_coder_round_trip(n):
    rnd = np.random.default_rng(n)
    for ids in (rnd.integers(0, 49408, n), np.zeros(n, int), rnd.integers(0, 3, n), rnd.zipf(1.5, n) % 49408, np.arange(n) % 17):
        raw = idcoder.encode_block([None, 5], np.array([0, n]), ids, 49408)
        names, sizes, back = idcoder.decode_block(raw)
        assert names == [None, 5] and sizes.tolist() == [0, n] and (back == ids).all()
    if n > 1000:
        assert len(idcoder.encode_block([1], np.array([n]), np.arange(n) % 17, 49408)) < n / 4


def test_damage_is_found():
    raw = bytearray(idcoder.encode_block([1], np.array([300]), np.arange(300), 49408))
    for at in (0, 5, 9, len(raw) // 2, len(raw) - 1):
        bad = raw.copy()
        bad[at] ^= 1
        with pytest.raises(ValueError, match="damaged"):
            idcoder.decode_block(bytes(bad))
    with pytest.raises(ValueError, match="damaged"):
        idcoder.decode_block(b"")


def test_literals_of_added_tokens_equal_the_library(spark, scratch):
    default = Tokenizer.from_file(public_tokenizers.path(tokenfile.TOKENIZER))
    rnd = random.Random(3)
    letters = [*" \n\t'sdtmaé中\u0301\u00a0.<|>", "<|endoftext|>", "<|startoftext|>", "<|endoftext", "oftext|>", "<|ENDOFTEXT|>"]
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30))) for _ in range(3000)]
    texts += ["a<|endoftext|>b", "<|endof", "text|>", "<|endoftext|>" * 3, "x <|startoftext|> y"]
    with open(public_tokenizers.path(tokenfile.TOKENIZER), "rb") as f:
        encoder = tokenfile._loaded(f.read())
    got = []
    for _, size, ids in encoder.rows(pa.array(texts)):
        got += [x.tolist() for x in np.split(ids, np.cumsum(size)[:-1])]
    want = [e.ids for e in default.encode_batch(texts, add_special_tokens=False)]
    assert got == want and sum(49407 in x for x in want) > 1000
    tokenfile.write(frame(spark, list(enumerate(texts[-5:]))), f"{scratch}/ids")
    rows = sorted(tuple(r) for r in tokenfile.read_back(spark, f"{scratch}/ids").collect())
    sizes = [len(x) + 1 for x in want[-5:]]
    assert [r[:3] for r in rows] == [(i, sum(sizes[:i]), n) for i, n in enumerate(sizes)]
    assert [np.frombuffer(r[3], "<u4").tolist() for r in rows] == [[*x, 2] for x in want[-5:]]


def test_distinct_chunks_are_the_dictionary():
    for values in ([b"", b"ab", b"ab", b"c\x00", "é中".encode(), b""], [b""], []):
        chunks = pa.array(values, pa.large_binary()).dictionary_encode()
        assert distinct(chunks) == chunks.dictionary.to_pylist()
        part = pa.DictionaryArray.from_arrays(pa.array([], pa.int32()), chunks.dictionary[1:])
        assert distinct(part) == chunks.dictionary.to_pylist()[1:]


def test_letter_chunks_of_any_case_and_length_are_the_library_s():
    with open(public_tokenizers.path(tokenfile.TOKENIZER), "rb") as f:
        coder = tokenfile.Encoder(f.read())
    texts = ["a", "word", "Word", "WORD", "qzxvkjw" * 20, "é", "École", "łódź", "straße", "ſo", "ab1", "中文", "1234", "a" * 50]
    got = [np.frombuffer(x, "<u4").tolist() for x in coder.encode_chunks([x.encode() for x in texts])]
    assert got == [coder.tokenizer.encode(x, add_special_tokens=False).ids for x in texts]
