import math
import random
import zlib

import numpy as np
from llm_plain import docs, odd_rows
from pyspark.sql import functions as F

from syncledger.llm import language as lg
from syncledger.llm.common import is_training


def samples(n=80, seed=1):
    rng = random.Random(seed)
    parts = {"aa": ["ba", "lo", "mi", "ta"], "bb": ["sch", "ung", "er", "ß"], "cc": ["ción", "ar", "que", "ñ"]}
    out = []
    for i in range(n):
        lang = ["aa", "bb", "cc"][i % 3]
        words = ["".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(4, 40))]
        out.append((i, " ".join(words), lang))
    return out


def plain_bits(text, sample, order=lg.ORDER):
    """Code length of a text under counts of a sample, byte by byte."""
    seen = {}
    for t in sample:
        b = bytes(order) + t.encode()
        for i in range(order, len(b)):
            for k in range(order + 1):
                seen.setdefault(b[i - k:i], {}).setdefault(b[i], 0)
                seen[b[i - k:i]][b[i]] += 1
    b, bits = bytes(order) + text.encode(), 0.0
    for i in range(order, len(b)):
        for k in range(order, -1, -1):
            after = seen.get(b[i - k:i], {})
            total = sum(after.values()) + len(after)
            if b[i] in after:
                bits -= math.log2(after[b[i]] / total)
                break
            if after:
                bits -= math.log2(len(after) / total)
        else:
            bits += 8
    return bits


def test_code_lengths_are_exact(spark):
    rows = samples()
    model = lg.train(docs(spark, rows))
    assert model.languages == ["aa", "bb", "cc"]
    texts = ["balo mita", "schung erß", "ción qqq 日本", "x", rows[0][1] * 3]
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    got = lg._Coder(model).bits_of(data, np.cumsum([0, *map(len, raw)]))
    for k, t in enumerate(texts):
        for j, lang in enumerate(model.languages):
            want = plain_bits(t, [x for _, x, y in rows if y == lang])
            assert abs(got[k, j] - want) < 1e-3 * (1 + want)


def test_held_out_accuracy_and_training_split(spark):
    rows = samples(300)
    table = docs(spark, rows)
    split = is_training("doc_id", 3, 1)
    held = {r["doc_id"] for r in table.filter(~split).collect()}
    assert held == {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1}
    # the held-out labels are not looked at
    hidden = table.withColumn("lang", F.when(split, F.col("lang")).otherwise("zz"))
    out = {r["doc_id"]: r for r in lg.identify(table, lg.train(hidden, split)).collect()}
    right = sum(out[i]["lang_pred"] == lang for i, _, lang in rows if i in held)
    assert right >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in out.values())


def test_odd_rows(spark):
    model = lg.train(docs(spark, samples()))
    table = docs(spark, [*odd_rows(), (50, "123 456 !!")])
    out = lg.identify(table, model).collect()
    assert len(out) == len(odd_rows()) + 1
    und = {r["doc_id"] for r in out if r["lang_pred"] == "und"}
    assert und == {1, 2, 3, 50}
    assert all(r["score"] == 0 for r in out if r["lang_pred"] == "und")
    assert lg.identify(docs(spark, []), model).count() == 0
    untrained = lg.train(docs(spark, [(1, "text", None)]))
    assert {r["lang_pred"] for r in lg.identify(table, untrained).collect()} == {"und"}


def test_long_text_in_blocks_equals_one_pass(spark):
    model = lg.train(docs(spark, samples()))
    text = (samples()[0][1] + " ") * 20_000
    data = np.frombuffer(text.encode(), np.uint8)
    one = -lg._Coder(model).logs(lg.gram_codes(data, np.array([0, len(data)]))).sum(axis=0, dtype=np.float64)
    cut = lg._Coder(model).bits_of(data, np.array([0, len(data)]))[0]
    assert np.allclose(one, cut)


def test_only_texts_without_a_language_go(spark):
    rows = samples()
    model = lg.train(docs(spark, rows))
    junk = [(900, "12345"), (901, None), (902, "日本語の文章です。" * 30), (903, "ba.")]
    table = docs(spark, [*rows, *junk])
    kept = lg.keep_identified(table, model)
    assert kept.columns == table.columns
    got = {r["doc_id"]: r for r in kept.collect()}
    assert set(got) == {i for i, _, _ in rows} | {903}
    assert got[903]["lang"] == "aa"


def test_languages_in_few_long_texts_are_learned(spark):
    """Three long texts a language, each far above the sample: all are learned, from a sample of about that size."""
    rows, rng = [], random.Random(3)
    for k in range(8):
        parts = [chr(97 + 3 * k + j) + "ae"[j % 2] for j in range(2)] + [chr(0x430 + k)]
        for i in range(3):
            rows.append((10 * k + i, " ".join(rng.choice(parts) * rng.randint(1, 3) for _ in range(30_000)), f"l{k}"))
    table = docs(spark, rows)
    model = lg.train(table, sample_bytes=2000)
    assert model.languages == [f"l{k}" for k in range(8)]
    assert all((np.isfinite(g).all() and (g[:, k] > -8).any()) for g in model.logs for k in range(8))
    ask = docs(spark, [(i, t[:500]) for i, t, _ in rows])
    assert {r["doc_id"]: r["lang_pred"] for r in lg.identify(ask, model).collect()} == {i: x for i, _, x in rows}


def test_pieces_of_a_long_text_count_like_the_whole(spark):
    text = " ".join(t for _, t, _ in samples(900))
    assert len(text.encode()) > 2 * lg.PIECE
    model = lg.train(docs(spark, [(None, text, "aa"), (None, "other words", "bb")]))
    data = np.frombuffer(text.encode(), np.uint8)
    codes, n = np.unique(lg.gram_codes(data, np.array([0, len(data)])), return_counts=True)
    whole = lg.compile_model(["aa"], np.zeros(len(codes), np.int64), codes, n)
    assert np.allclose(model.log2(codes)[:, 0], whole.log2(codes)[:, 0])
