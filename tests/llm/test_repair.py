import hashlib
import itertools
import random
import re
import zlib

import pytest

from lapakdw.llm import repair
from lapakdw.llm.shipping import importable

FIELDS = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
NOT_BLANK = re.compile(r"[^\x20\x09-\x0D]")
AFTER = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def faults(rows):
    seen, found = set(), []
    for _, role, text in rows:
        letters = NOT_BLANK.findall(text)
        if not letters:
            found.append("b")
        elif (role, text) in seen:
            found.append("d")
        else:
            found.append("-" if letters[-1] in ".!?" else "t")
        seen.add((role, text))
    return found


def cheapest(rows, marks):
    """Least (cost, audit, repaired rows) by trying every edit of the rest from the back, per letter before."""
    after_end = {"": (0, "", ()), "a": (0, "", ()), "u": (5, "I", (("assistant", ""),)), "s": (10, "II", (("user", ""), ("assistant", "")))}
    best = after_end
    for (_, role, text), mark in reversed(list(zip(rows, marks))):
        here = {}
        more = 5 if mark == "t" else 0
        for state in ("", "s", "u", "a"):
            ways = [(best[state][0] + 2, "D" + best[state][1], best[state][2])]
            if mark in "t-":
                follows = "a" if state == "u" else "u"
                name = {"a": "assistant", "u": "user"}[follows]
                c, s, r = best[follows]
                ways.append((c + 1 + more, "R" + s, ((name, text), *r)))
                if role[:1] in AFTER[state]:
                    c, s, r = best[AFTER[state][role[:1]]]
                    ways.append((c + more, "K" + s, ((role, text), *r)))
            here[state] = min(ways)
        for _ in range(3):  # rows inserted in front of this one
            for state in ("", "s", "u", "a"):
                follows = "a" if state == "u" else "u"
                c, s, r = here[follows]
                here[state] = min(here[state], (c + 5, "I" + s, (({"a": "assistant", "u": "user"}[follows], ""), *r)))
        best = here
    return best[""]


def brute(table):
    """The audit of (conv_id, turn, role, text) rows in plain Python."""
    conversations = {}
    for conv, turn, role, text in table:
        conversations.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, rows in conversations.items():
        rows = order(rows)
        marks = faults(rows)
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        letters = [r[:1] for _, r, _ in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(letters, letters[1:]))
        cost, audit, fixed = cheapest(rows, marks)
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in fixed))
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()
        out[conv] = (gaps, *(marks.count(m) for m in "bdt"), illegal, cost, audit, sha)
    return out


def damaged(table):
    out = []
    for conv, turn, role, text in table:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        code = zlib.crc32(key.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if code == 0:
            continue
        if code == 1:
            text = ""
        if code == 2:
            text = re.sub("[.!?]", "", text)
        if code == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if code == 3 else 1)
    return out


def found(df):
    assert df.columns == COLUMNS
    rows = [tuple(r) for r in df.collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


def random_table(seed, conversations, longest, roles="suaat"):
    rng = random.Random(seed)
    names = {"s": "system", "u": "user", "a": "assistant", "t": "tool"}
    texts = ["Yes.", "No!", "why?", "cut", "", " \t\n", "ends. ", "odd ", "Ü.", "same."]
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randrange(1, longest + 1)):
            rows.append((conv, rng.choice([turn, turn, turn + 2, None]), names[rng.choice(roles)], rng.choice(texts) + rng.choice(["", "", str(turn) + "."])))
    return rows


def test_small_lattices_against_every_edit():
    """All words of edits up to a length, judged one by one."""
    rng = random.Random(5)
    for _ in range(60):
        rows = [(rng.choice("suat"), rng.choice("bdt---")) for _ in range(rng.randrange(0, 4))]
        best = None
        for length in range(len(rows) + 5):
            for word in itertools.product("DIKR", repeat=length):
                at, state, cost = 0, "", 0
                for edit in word:
                    if edit == "I":
                        state, cost = ("a" if state == "u" else "u"), cost + 5
                        continue
                    if at == len(rows):
                        break
                    role, mark = rows[at]
                    at += 1
                    if edit == "D":
                        cost += 2
                    elif mark in "bd" or (edit == "K" and role not in AFTER[state]):
                        break
                    else:
                        cost += (edit == "R") + 5 * (mark == "t")
                        state = AFTER[state][role] if edit == "K" else "a" if state == "u" else "u"
                else:
                    if at == len(rows) and state in ("", "a"):
                        best = min(best or (cost, "".join(word)), (cost, "".join(word)))
        audit, behind, cost = repair.repairs(rows)[0]
        assert (cost, audit) == best
        assert behind in (0, 3)


@pytest.mark.parametrize("seed", range(6))
def test_lattices_against_plain_search(seed):
    rng = random.Random(seed)
    for _ in range(80):
        rows = [(rng.choice("suaat"), rng.choice("bdt-----")) for _ in range(rng.randrange(0, 40))]
        audit, _, cost = repair.repairs(rows)[0]
        expected = cheapest([(None, {"s": "s", "u": "u", "a": "a", "t": "t"}[r], "") for r, _ in rows], [m for _, m in rows])
        assert (cost, audit) == expected[:2]


def test_prices_never_exceed_what_an_arc_costs():
    rows = [("u", "-"), ("u", "t"), ("s", "-"), ("a", "d"), ("a", "-")]
    arcs = repair.lattice(rows, repair.FINAL, True)
    prices = [0] * (len(arcs) + 1)
    assert repair.auction(arcs, prices, 0, repair.highest(rows, repair.FINAL)) == prices[0]
    assert all(prices[i] <= cost + prices[to] for i, out in enumerate(arcs) for _, cost, to in out)


@pytest.mark.parametrize("chunk_rows", [128, 3])
def test_random_conversations(spark, sql_settings, chunk_rows):
    importable(spark)
    rows = random_table(1, 60, 9) + random_table(2, 3, 70)[:100]
    table = spark.createDataFrame(rows, FIELDS).repartition(3)
    assert found(repair.audit_conversations(table, chunk_rows)) == brute(rows)


def test_one_conversation_over_many_tasks(spark, sql_settings):
    importable(spark)
    sql_settings(spark__sql__adaptive__enabled="false")
    rng = random.Random(9)
    rows = [(7, i // 2, rng.choice(["user", "assistant", "assistant", "system"]), f"{rng.choice('abc')} {i % 50}{rng.choice(['.', ''])}") for i in range(900)]
    rows += [(8, 0, "user", "hi."), (8, 1, "assistant", "ho.")]
    table = spark.createDataFrame(rows, FIELDS)
    chunks = repair.chunked(table, 16)
    assert chunks.where("conv_id = 7").select("part").distinct().count() > 1
    assert found(repair.audit_conversations(table, 16)) == brute(rows)


def test_many_copies_of_one_row(spark):
    importable(spark)
    rows = [(1, 0, "user", "again."), (1, 5, "assistant", "fine.")]
    table = spark.createDataFrame(rows, FIELDS).union(spark.createDataFrame([rows[0]] * 500, FIELDS))
    gaps, blank, duplicate, truncated, illegal, cost, audit, _ = found(repair.audit_conversations(table))[1]
    assert (gaps, blank, duplicate, truncated, illegal) == (4, 0, 500, 0, 500)
    assert cost == 1000 and audit == "D" * 0 + "K" + "D" * 500 + "K"


def test_damage_of_given_conversations(spark, sf_dir):
    importable(spark)
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    expected = brute(damaged(rows))
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    expected |= {conv: empty for conv, *_ in rows if conv not in expected}
    assert found(repair.damaged_audit(table)) == expected


def test_nulls_empty_long_and_dropped(spark):
    importable(spark)
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [
        (None, None, None, None), (None, None, "user", "no id."), (None, 3, "assistant", "x" * 5_000_000 + "."),
        (5000, None, "user", None), (5000, None, "", "role is empty."), (dropped, 0, "user", "gone."),
        (6000, 2**62, "user", "late."), (6000, 1, "assistant", "early."), (6001, 1, "üser", "odd letter."),
    ]
    odd = FIELDS + ", part int, seq int, n int, fault string, cost int"
    table = spark.createDataFrame([(*r, 1, 2, 3, "f", 4) for r in rows], odd)
    expected = brute(damaged(rows))
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    expected |= {conv: empty for conv, *_ in rows if conv not in expected}
    assert dropped not in brute(damaged(rows))
    assert found(repair.damaged_audit(table)) == expected


def test_empty_table(spark):
    importable(spark)
    empty = spark.createDataFrame([], FIELDS)
    assert found(repair.damaged_audit(empty)) == {} == found(repair.audit_conversations(empty))
    assert repair.repaired_turns(empty).collect() == []


@pytest.mark.parametrize("chunk_rows", [128, 2])
def test_repaired_turns_are_what_the_hash_covers(spark, chunk_rows):
    importable(spark)
    rows = random_table(4, 20, 8)
    table = spark.createDataFrame(rows, FIELDS)
    fixed = {}
    for r in repair.repaired_turns(table, chunk_rows).orderBy("conv_id", "position").collect():
        assert r["position"] == len(fixed.setdefault(r["conv_id"], []))
        fixed[r["conv_id"]].append(f"{r['role']}:{r['text']}")
        assert (r["edit"] == "I") <= (r["text"] == "")
    shas = {conv: hashlib.sha256("\n".join(fixed.get(conv, [])).encode()).hexdigest() for conv in {r[0] for r in rows}}
    assert shas == {conv: row[-1] for conv, row in brute(rows).items()}
