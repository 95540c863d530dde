import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from lapakdw.llm import langid

DOC = "doc_id long, text string, lang string, score double, lang_pred string"
PARTS = {
    "en": ["th", "er", "on", "an", "ing", "wh"],
    "de": ["sch", "ein", "ung", "ß", "ä", "lich"],
    "fr": ["eau", "eux", "é", "ç", "oi", "ment"],
}


def docs(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(PARTS))
        words = ["".join(rng.choices(PARTS[lang], k=rng.randrange(1, 4))) for _ in range(rng.randrange(2, 40))]
        rows.append((i, " ".join(words), lang))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, 0.0, "zz") for i, t, lang in rows], DOC)


def is_held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_held_out_accuracy(spark):
    rows = docs(600)
    found = langid.predictions(frame(spark, rows))
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    truth = {i: lang for i, _, lang in rows}
    held = [r for r in found.collect() if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if is_held(i)}
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in held)


def test_held_out_languages_change_nothing(spark):
    rows = docs(150, seed=2)
    other = [(i, t, "xx" if is_held(i) else lang) for i, t, lang in rows]
    one, two = (sorted(map(tuple, langid.predictions(frame(spark, x)).collect())) for x in (rows, other))
    assert one == two


def test_nulls_texts_without_letters_and_long_ones(spark):
    odd = [(1000, None, "en"), (1001, "", "en"), (1002, "123 !?", None), (None, "the thing", "en"), (1003, "sch ein " * 100_000, None), (1003, "sch ein", None)]
    found = langid.predictions(frame(spark, docs(120) + odd)).collect()
    assert len(found) == 126
    by_id = {r["doc_id"]: r for r in found}
    assert [by_id[i]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3
    assert by_id[1002]["score"] == 0.0 and by_id[1003]["lang_pred"] == "de"
    assert by_id[None]["held_out"] is False


def test_nothing_to_learn_from(spark):
    found = langid.predictions(frame(spark, [(1, "the thing", None), (2, "x", None)])).collect()
    assert [(r["lang_pred"], r["score"]) for r in found] == [("und", 0.0)] * 2
    assert langid.predictions(frame(spark, [])).count() == 0


def test_document_frequencies_cover_all_documents(spark):
    rows = docs(200, seed=4)
    n, counts = langid.document_frequencies(frame(spark, rows).repartition(7))
    expected = np.zeros(langid.BINS, int)
    for _, text, _ in rows:
        bins, _, _ = langid.gram_bins([text])
        seen = np.unique(np.concatenate(bins))
        expected[seen[seen < langid.BINS]] += 1
    assert n == 200 and (counts == expected).all()


def test_grams_of_a_text_do_not_depend_on_its_neighbours():
    texts = ["abc", "", "é", "xyz abc", ""]
    bins, starts, letters = langid.gram_bins(texts)
    alone = [np.sort(np.concatenate([b[b < langid.BINS] for b in langid.gram_bins([t])[0]])) for t in texts]
    together = [np.sort(x[x < langid.BINS]) for x in langid._per_text(bins, starts)]
    assert all((a == b).all() for a, b in zip(alone, together))
    assert letters.tolist() == [3, 0, 1, 6, 0]


def test_uncertain_documents_go_and_others_keep_all_columns(spark):
    df = frame(spark, docs(200) + [(900, "12", "en"), (901, None, "en")])
    left = langid.keep_identified(df)
    assert left.columns == df.columns
    assert left.where(F.col("doc_id") >= 900).count() == 0 and left.count() > 190
