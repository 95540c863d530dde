"""Every query of the package over the smallest driver tables: against SQL, or against plain Python."""

import base64
import math

import duckdb
import numpy as np
import pytest
import tiktoken
from public_tokenizers import PATTERN

import __spark_entry__ as entry
from compare import connect, difference
from lapakdw.llm import licenses
from lapakdw.llm.queries import SQL, VOCABULARY, queries
from tests.conftest import SF_SMALL
from tests.helpers import plan
from tests.llm import brute
from tests.llm.test_licenses import COLUMNS
from tests.llm.test_licenses import brute as licenses_brute

QUERIES = queries()
NATIVE = [name for name in QUERIES if name.split("_")[0] in ("op1", "op3", "op6", "op8")]


@pytest.fixture(scope="module")
def con():
    return connect(SF_SMALL)


def rows(name):
    return duckdb.connect().execute(f"SELECT * FROM '{SF_SMALL}/{name}.parquet'").fetchall()


def documents():
    return [(r[0], r[1]) for r in rows("documents")]


def test_all_queries_are_registered():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", SQL)
def test_query_equals_sql(spark, con, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), con, SQL[name]) is None


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans_have_no_python_and_no_all_pairs(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert not any(word in text for word in ("CartesianProduct", "NestedLoopJoin", "Python", "Pandas", "Arrow"))


def test_secrets(spark, sf_dir):
    found = {r["doc_id"]: r for r in QUERIES["op2_token_efficiency_secrets"](spark, sf_dir).collect()}
    assert len(found) == len(documents())
    for doc_id, text in documents():
        spans, r = brute.base_spans(text), found[doc_id]
        told = ",".join(f"{kind}:{a}:{b}" for a, kind, b in spans)
        assert r["base_sha256"] == brute.sha(told)
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[1] == k for s in spans) for k in ("assign", "access", "hex")]
        assert [s for s in r["spans"].split(",") if s and not s.startswith("random")] == [s for s in told.split(",") if s]


def test_top_k(spark, sf_dir):
    data = [(r[0], [math.floor(64 * float(x)) for x in r[1]]) for r in rows("embeddings")]
    ids, matrix = np.array([i for i, _ in data]), np.array([v for _, v in data])
    expected = []
    for i, v in data:
        if i % 20 == 0:
            scores = matrix @ np.array(v)
            best = sorted((-s, j) for s, j in zip(scores.tolist(), ids.tolist()) if j != i)[:20]
            expected += [(i, n, j, -s) for n, (s, j) in enumerate(best, start=1)]
    assert sorted(map(tuple, QUERIES["op4_tiled_top_k"](spark, sf_dir).collect())) == sorted(expected)


def test_bpe(spark, sf_dir):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VOCABULARY, "rb"))}
    own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = sorted(map(tuple, QUERIES["op5_byte_bpe"](spark, sf_dir).collect()))
    expected = []
    for doc_id, text in documents():
        ids = own.encode_ordinary(text or "")
        expected.append((doc_id, len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(text or "")))
    assert found == sorted(expected)


def test_licenses(spark, sf_dir):
    found = QUERIES["op6_license_rules"](spark, sf_dir)
    assert found.columns == COLUMNS
    assert sorted(map(tuple, found.collect()), key=str) == sorted(licenses_brute(documents()), key=str)
    assert len(licenses.rule_table()) > 200


def test_quality_and_language_are_learnt(spark, sf_dir):
    truth = {r[0]: r[2] for r in rows("documents")}
    found = QUERIES["op9_language_id"](spark, sf_dir).collect()
    held = [r["lang_pred"] == truth[r["doc_id"]] for r in found if r["held_out"]]
    assert len(found) == len(truth) and np.mean(held) > 0.95
    labels = {r[0]: r[1] for r in rows("labels")}
    scored = QUERIES["op7_additive_quality"](spark, sf_dir).collect()
    assert len(scored) == len(truth)
    held = [r["predicted"] == labels[r["doc_id"]] for r in scored if r["held_out"] and r["doc_id"] in labels]
    assert np.mean(held) > 0.8


def test_near_duplicates(spark, sf_dir):
    docs = documents()
    found = {r["doc_id"]: r["class_id"] for r in QUERIES["op10_order_minhash"](spark, sf_dir).collect()}
    assert found == dict(zip([d[0] for d in docs], brute.classes(docs)))
