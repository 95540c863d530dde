import random

from lapakdw.llm import decontam
from tests.helpers import plan
from tests.llm.brute import contamination

DOC, ITEM = "doc_id long, text string, _id long, _key long, items string", "item_id long, text string, prints string"


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(*d, 1, 2, "x") for d in docs], DOC),
        spark.createDataFrame([(*i, "x") for i in items], ITEM),
    )


def check(spark, docs, items):
    d, b = frames(spark, docs, items)
    found = sorted((tuple(r) for r in decontam.contamination(d, b).collect()), key=str)
    assert found == sorted(contamination(docs, items), key=str)


def sample(seed, few=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(few)] + ["É", "straße"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 40)))) for i in range(25)]
    docs = []
    for i in range(60):
        ws = rng.choices(vocabulary, k=rng.randrange(0, 200))
        if i % 3:
            part = rng.choice(items)[1].split()
            cut = rng.randrange(len(part))
            at = rng.randrange(len(ws) + 1)
            ws[at:at] = part[cut : cut + rng.randrange(1, 30)]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(w.upper() if rng.random() < 0.1 else w for w in ws)))
    return docs, items


def test_random_texts(spark):
    check(spark, *sample(1))


def test_few_words_with_many_overlaps(spark):
    check(spark, *sample(2, few=2))


def test_exactly_thirteen_words_and_one_less(spark):
    ws = [f"a{i}" for i in range(20)]
    items = [(7, " ".join(ws))]
    docs = [(1, "x " + " ".join(ws[3:16]) + " y"), (2, "x " + " ".join(ws[3:15]) + " y")]
    check(spark, docs, items)
    d, b = frames(spark, docs, items)
    assert [r["n_hit"] for r in decontam.contamination(d, b).orderBy("doc_id").collect()] == [13, 0]


def test_nulls_repeats_and_items_of_all_lengths(spark):
    items = [(1, "one"), (1, "one"), (2, None), (3, ""), (None, "two three"), (4, "q " * 15), (5, "!!!")]
    docs = [(1, "One, two three!"), (1, "One, two three!"), (None, "ONE"), (2, None), (3, ""), (4, "q " * 400), (1, "other one")]
    check(spark, docs, items)


def test_empty_tables(spark):
    check(spark, [], [(1, "a")])
    check(spark, [(1, "a b")], [])


def test_contaminated_documents_go_and_others_keep_all_columns(spark):
    ws = " ".join(f"a{i}" for i in range(13))
    docs = [(1, ws), (1, "clean"), (2, ws + " z" * 248), (3, ws + " z" * 247), (None, ws), (4, None)]
    d, b = frames(spark, docs, [(1, ws)])
    left = decontam.drop_contaminated(d, b)
    assert left.columns == d.columns
    assert sorted((r["doc_id"], (r["text"] or "")[:5]) for r in left.collect()) == [(1, "clean"), (2, "a0 a1"), (4, "")]


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(decontam, "broadcast_if_measured", lambda df: df)
    check(spark, *sample(3))


def test_windows_meet_in_their_fingerprint(spark):
    """Any 13 words have a fingerprint of their own, wherever they stand."""
    from pyspark.sql import functions as F

    rng = random.Random(5)
    part = [f"p{i}" for i in range(13)]
    rows = [[f"x{rng.randrange(9)}" for _ in range(k)] + part + ["end"] * (k % 3) for k in range(30)]
    df = spark.createDataFrame([(r,) for r in rows], "ws array<string>")
    own = decontam.winnow(F.array(*map(F.lit, part)))[0]
    assert df.where(F.array_contains(decontam.winnow(F.col("ws")), own)).count() == len(rows)


def test_words_are_counted_where_texts_are_cut(spark):
    """Beyond the candidates, no text is cut again for the number of its words."""
    d, b = frames(spark, *sample(4))
    cut = plan(decontam.find_hits(d, b)).count("regexp_extract_all")
    assert cut > 0 and plan(decontam.contamination(d, b)).count("regexp_extract_all") == cut
