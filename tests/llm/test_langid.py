import numpy as np
import pyarrow as pa

from tests.llm.conftest import frame
from urbanlens.llm import langid
from urbanlens.llm.common import text_blocks


def test_held_out_accuracy(spark):
    import duckdb

    folder = "/root/testdata/sf0.01"
    truth = dict(duckdb.sql(f"select doc_id, lang from '{folder}/documents.parquet' where length(text) > 100").fetchall())
    rows = [r for r in langid.query(spark, folder).collect() if r.doc_id in truth]
    held = [r for r in rows if r.held_out]
    assert held and np.mean([truth[r.doc_id] == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_filter_holds_what_was_learned_and_counts_match_brute_force(spark):
    train = spark.createDataFrame([("aa", "abcd efgh " * 50), ("bb", "ijkl mnop " * 50), (None, "abcd"), ("aa", None)], "lang string, text string")
    model = langid.fit(train)
    assert model.langs == ["aa", "bb"]
    _, _, data, offsets = next(text_blocks(pa.array(["Abcd ef", "ijkl", "", "zz"])))
    read, found = langid.hits(model, data, offsets)
    assert read.tolist() == [4, 1, 0, 0]
    assert found[0].tolist() == [4, 0] and found[1].tolist() == [0, 1]


def test_more_than_one_mask_word(spark):
    words = [f"{a}{b}{c}{d}" for a in "abcdefgh" for b in "ijklm" for c in "nop" for d in "qr"][:80]
    train = spark.createDataFrame([(f"l{i:02}", (w + " ") * 30) for i, w in enumerate(words)], "lang string, text string")
    model = langid.fit(train)
    assert model.table.shape[0] == 2
    docs = frame(spark, [(i, w + " " + w) for i, w in enumerate(words)])
    assert all(r.lang_pred == f"l{r.doc_id:02}" for r in langid.predict(docs, model).collect())


def test_edge_rows(spark):
    model = langid.fit(spark.createDataFrame([("en", "the cat sat on the mat " * 40), ("de", "der hund und die katze " * 20)], "lang string, text string"))
    docs = frame(spark, [(1, None), (2, ""), (3, "123 !!"), (4, "the cat"), (4, "the cat"), (None, "der hund " * 200_000), (6, "xq")])
    out = {(r.doc_id, r.n_chars): r for r in langid.predict(docs, model).collect()}
    assert [out[i, n].lang_pred for i, n in ((1, None), (2, 0), (3, 6), (4, 7), (None, 1_800_000))] == ["und", "und", "und", "en", "de"]
    assert out[6, 2].score == 0.0 and out[6, 2].lang_pred == "en"  # nothing found: the language with most text
    assert langid.predict(docs, model).count() == 7
    kept = langid.reject_unidentified(spark, docs, "")
    assert kept.columns == docs.columns and kept.count() == 4
    none = langid.fit(docs.where("false"))
    assert {r.lang_pred for r in langid.predict(docs, none).collect()} == {"und"}
    assert langid.predict(docs.where("false"), model).count() == 0


def plain_grams(text):
    """Byte 4-grams of the folded text without two blanks in succession."""
    b = bytes(langid._FOLD[np.frombuffer(text.encode(), np.uint8)].astype(np.uint8).tolist()) if text else b""
    return [b[i : i + 4] for i in range(len(b) - 3) if b"  " not in b[i : i + 4]]


def test_correction_and_prediction_equal_brute_force(spark):
    from collections import Counter

    texts = {"aa": "banana cabana tamada salama kavala " * 30, "bb": "skrit frimp glunk trisk flomb " * 30, "cc": "banana skrit olo mundo cabo " * 30}
    bits = 9  # few slots: false hits are common, so the correction matters
    model = langid.fit(spark.createDataFrame(list(texts.items()), "lang string, text string"), slot_bits=bits)
    kept = {}
    for lang, text in texts.items():
        counts = Counter(plain_grams(text))
        kept[lang] = {g for g, n in counts.items() if n >= langid.MIN_SHARE * sum(counts.values())}
    slots = lambda g: [int(x[0]) for x in langid.slots_of(np.array([int.from_bytes(g, "little")], np.uint32), bits)]
    filled = {lang: {s for g in grams for s in slots(g)} for lang, grams in kept.items()}
    rate = {lang: min((len(f) / 2**bits) ** langid.HASHES, 0.999) for lang, f in filled.items()}
    assert model.langs == sorted(texts) and np.allclose(model.false_rate, [rate[x] for x in model.langs])
    asked = ["banana cabana", "skrit glunk mundo", "olo olo cabo", "zzzz qqqq wwww", "tamada frimp banana trisk", "xy"]
    got = {r.text: r for r in langid.predict(frame(spark, list(enumerate(asked))), model).collect()}
    most = max(model.langs, key=lambda x: len(plain_grams(texts[x])))
    for text in asked:
        grams = plain_grams(text)
        sure = {}
        for lang in model.langs:
            found = sum(all(s in filled[lang] for s in slots(g)) for g in grams)
            sure[lang] = max(0.0, (found - len(grams) * rate[lang]) / (1 - rate[lang]))
        total = sum(sure.values())
        want = max(model.langs, key=lambda x: sure[x]) if total > 0 else most
        assert got[text].lang_pred == want
        assert abs(got[text].score - (sure[want] / total if total > 0 else 0.0)) < 1e-9
