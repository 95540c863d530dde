import datetime as dt
import random

import pytest

from lapakdw.llm import urls

ENTRY = "key string, day date, action string, category string, intervals int"
CAPTURE = "page_id long, url string, fetched date, list_key string, hit string"
D = dt.date(2024, 1, 1)


def day(n):
    return None if n is None else D + dt.timedelta(days=n)


def frames(spark, captures, entries):
    return (
        spark.createDataFrame([(p, u, day(n), "x", "y") for p, u, n in captures], CAPTURE),
        spark.createDataFrame([(k, day(n), a, c, 1) for k, n, a, c in entries], ENTRY),
    )


def keys_of(host, path):
    labels = host.split(".")
    out = [".".join(labels[-i:]) for i in range(1, len(labels) + 1)]
    segments = [s for s in path.split("/") if s]
    return out + [host + "/" + "/".join(segments[:i]) for i in range(1, len(segments) + 1)]


def brute(captures, entries):
    """Walk the entries of every covering key up to the fetch day."""
    rows = []
    for page, host, path, n in captures:
        best = (False, None, None, None, None)
        for key in keys_of(host, path):
            days: dict[int, tuple] = {}
            for k, m, action, category in entries:
                if k == key and m is not None:
                    days[m] = max(days.get(m, ("", "")), (action, category))
            past = [m for m in sorted(days) if m <= n]
            if past and days[past[-1]][0] == "add":
                later = [m for m in sorted(days) if m > past[-1]]
                best = (True, key, days[past[-1]][1], day(past[-1]), day(later[0]) if later else None)
        rows.append((page, day(n), *best))
    return rows


@pytest.mark.parametrize("broadcast", [True, False])
def test_against_a_walk_through_the_list(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(urls, "broadcast_if_measured", lambda df: df)
    rng = random.Random(1)
    hosts = ["a.example", "b.a.example", "example", "c.test", "x.c.test"]
    places = [(rng.choice(hosts), "/".join(rng.choices(["en", "de", "p"], k=rng.randrange(0, 3)))) for _ in range(150)]
    captures = [(i, host, path, rng.randrange(0, 60)) for i, (host, path) in enumerate(places)]
    entries = [
        (rng.choice([*hosts, "a.example/en", "c.test/de/p", "test"]), rng.randrange(0, 60), rng.choice(["add", "remove"]), rng.choice("uvw"))
        for _ in range(60)
    ]
    c, e = frames(spark, [(p, f"https://{h}/{s}?q=1#f", n) for p, h, s, n in captures], entries)
    found = urls.filter_captures(c, e).drop("url")
    assert found.columns == ["page_id", "fetched", "blocked", "list_key", "category", "listed_from", "listed_to"]
    assert sorted(map(tuple, found.collect())) == sorted(brute(captures, entries))


def test_bounds_of_an_interval(spark):
    entries = [("a.b", 3, "add", "u"), ("a.b", 5, "remove", "u"), ("a.b", 5, "add", "v"), ("a.b", 9, "add", "w")]
    c, e = frames(spark, [(n, "http://a.b/", n) for n in range(12)], entries)
    blocked = {r["page_id"]: r["category"] for r in urls.filter_captures(c, e).collect()}
    assert [blocked[n] for n in range(12)] == [None] * 3 + ["u"] * 2 + [None] * 4 + ["w"] * 3


def test_nulls_malformed_and_repeated_captures(spark):
    c, e = frames(
        spark,
        [(1, None, 1), (2, "no address", 1), (3, "http://", 1), (4, "http://a.b", None), (5, "http://A.B.:80/x", 4),
         (5, "http://A.B.:80/x", 4), (None, "ftp://u@a.b", 4), (6, "http://a.b/" + "x/" * 3000, 4)],
        [("a.b", 1, "add", None), (None, 1, "add", "x"), ("a.b", None, "add", "x"), ("a.b", 2, "other", "x")],
    )
    found = [(r["page_id"], r["blocked"]) for r in urls.filter_captures(c, e).collect()]
    assert sorted(found, key=str) == sorted(
        [(1, False), (2, False), (3, False), (4, False), (5, True), (5, True), (None, True), (6, True)], key=str
    )


def test_empty_tables(spark):
    c, e = frames(spark, [], [("a", 1, "add", "x")])
    assert urls.filter_captures(c, e).count() == 0
    c, e = frames(spark, [(1, "http://a", 1)], [])
    assert [r["blocked"] for r in urls.filter_captures(c, e).collect()] == [False]


def test_categories_are_lists_of_their_own(spark):
    entries = [("a.b", 1, "add", "spam"), ("a.b", 2, "add", "adult"), ("a.b", 3, "remove", "spam"), ("a.b", 5, "remove", "adult"),
               ("a.b", 7, "remove", "u"), ("a.b", 7, "add", "v"), ("a.b", 8, "add", None), ("a.b", 9, "remove", "v")]
    c, e = frames(spark, [(n, "http://a.b/", n) for n in range(11)], entries)
    rows = {r["page_id"]: r for r in urls.filter_captures(c, e, by_category=True).collect()}
    assert [rows[n]["blocked"] for n in range(11)] == [False, True, True, True, True, False, False, True, True, True, True]
    assert [rows[n]["category"] for n in (1, 2, 3, 4, 7, 8, 9)] == ["spam", "adult", "adult", "adult", "v", None, None]
    assert rows[1]["listed_to"] == day(3) and rows[2]["listed_to"] == day(5) and rows[8]["listed_to"] is None


def test_times_within_a_day(spark):
    def at(hour):
        return dt.datetime(2024, 1, 1, hour)

    e = spark.createDataFrame([("a.b", at(15), "add", "u"), ("a.b", at(18), "remove", "u")], "key string, day timestamp, action string, category string")
    c = spark.createDataFrame([(h, "http://a.b/", at(h)) for h in (10, 15, 17, 18)], "page_id long, url string, fetched timestamp")
    for by_category in (False, True):
        found = {r["page_id"]: r["blocked"] for r in urls.filter_captures(c, e, by_category).collect()}
        assert found == {10: False, 15: True, 17: True, 18: False}
