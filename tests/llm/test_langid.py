import math
import zlib

import numpy as np
import pyarrow as pa

from trailmark.llm.arrowtext import FOLD, mix, text_slices
from trailmark.llm.langid import DIMENSIONS, PLAIN, counts, even_share, fit, identify, training_set

WORDS = {"aa": "the of and to in is with that was for".split(), "bb": "der die und das nicht ist mit für über auf".split(), "cc": "el la de que en los por con niño más".split()}


def rows(n=240):
    rng = np.random.default_rng(3)
    return [(i, " ".join(rng.choice(WORDS[lang], 30)), lang, "clash") for i in range(n) for lang in [["aa", "bb", "cc"][i % 3]]]


def brute_counts(text):
    want = np.zeros(DIMENSIONS)
    raw = text.encode()
    for k in (1, 2, 3):
        for at in range(len(raw) - k + 1):
            gram = raw[at : at + k]
            if all(PLAIN[b] for b in gram):
                h = 0
                for j, b in enumerate(gram):
                    h = int(FOLD[b]) if j == 0 else (h * 31 + int(FOLD[b])) % (1 << 64)
                want[int(mix(np.array([h], np.uint64))[0]) % DIMENSIONS] += 1
    return want


def test_counts_equal_a_plain_loop():
    texts = ["Ab c", "", "é!x yz", "a"]
    for _, _, data, offsets in text_slices(pa.array(texts)):
        got = counts(data, offsets)
    for i, text in enumerate(texts):
        assert (got[i] == brute_counts(text)).all()


def test_predictions_equal_brute_force(spark):
    """Every text against every centroid, one by one."""
    docs = spark.createDataFrame([(i, t, lang) for i, t, lang, _ in rows(90)], "doc_id long, text string, lang string")
    model = fit(*training_set(docs, 3000))
    got = {r.doc_id: r for r in identify(docs).collect()}
    for i, text, _, _ in rows(90):
        v = [math.log1p(n) * w for n, w in zip(brute_counts(text), model.idf.tolist(), strict=True)]
        size = math.sqrt(sum(x * x for x in v))
        cosines = [sum(a * b for a, b in zip(v, centre.tolist(), strict=True)) / size for centre in model.centres]
        best = max(range(len(cosines)), key=cosines.__getitem__)
        assert got[i].lang_pred == model.languages[model.owner[best]] and abs(got[i].score - cosines[best]) < 1e-5


def test_accuracy_and_odd_rows(spark):
    odd = [(1000, None, None, "x"), (1001, "", "aa", "x"), (1002, "123 !!", "aa", "x"), (1003, "der und " * 4000, "bb", "x"), (1003, "the of", "aa", "x"), (None, "the of and", "aa", "x"), (1004, "日本語の文", None, "x")]
    got = identify(spark.createDataFrame(rows() + odd, "doc_id long, text string, lang string, score string")).collect()
    assert len(got) == 247
    held = [r for r in got if r.held_out and r.doc_id < 1000]
    truth = {i: lang for i, _, lang, _ in rows()}
    assert held and all(r.lang_pred == truth[r.doc_id] for r in held)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (1000, 1001, 1002))
    assert by[None].lang_pred == "aa" and by[1004].lang_pred in WORDS and by[1004].rejected
    assert all(0 <= r.score <= 1 for r in got)


def test_nothing_to_learn_or_judge(spark):
    schema = "doc_id long, text string, lang string"
    assert identify(spark.createDataFrame([], schema)).count() == 0
    assert identify(spark.createDataFrame([(1, "word", None)], schema)).first().lang_pred == "und"


def test_a_rare_language_in_a_skewed_corpus(spark):
    assert even_share([6, 3000], 100) == 94 and even_share([1, 2], 100) == 2 and even_share([5, 5, 5], 2) == 1 and even_share([], 9) == 9
    rng = np.random.default_rng(4)
    docs = spark.createDataFrame([(i, " ".join(rng.choice(WORDS[lang], 30)), lang) for i in range(3000) for lang in ["cc" if i % 300 < 2 else "aa"]], "doc_id long, text string, lang string")
    assert sorted(set(training_set(docs, 40)[1])) == ["aa", "cc"] and len(training_set(docs, 40)[1]) == 40
    got = identify(docs, most_training=40).collect()
    assert all(r.lang_pred == ("cc" if r.doc_id % 300 < 2 else "aa") for r in got)
