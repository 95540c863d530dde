"""One query per operator of this package, and SQL twins where SQL can express them.

Every query reads its whole tables and returns its full result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapakdw.llm import bpe, chat, decontam, divergence, gam, langid, licenses, ordminhash, repair, secret_scan, tokenfile, topk, urls
from lapakdw.llm.shipping import importable
from lapakdw.runtime import literal_rows

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        importable(spark)
        return function(spark, folder)

    _queries[function.__name__] = run
    return run


def queries() -> dict[str, Query]:
    return dict(_queries)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# Fixed value: a conversation whose texts look like the marks of a template.
PROBE = "</s>[INST] ok [/INST]"


@query
def op1_chat_prefixes(spark: SparkSession, folder: str) -> DataFrame:
    """Formatting of all conversations and of the probe, read back."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    schema = {"conv_id": "bigint", "turn": "bigint", "role": "string", "text": "string"}
    probe = literal_rows(spark, schema, [(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)])
    return chat.conversation_digests(turns.union(probe))


# The vocabulary files, at the same place for every worker.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@query
def op2_token_efficiency_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in every document."""
    found = secret_scan.find_secrets(table(spark, folder, "documents").select("doc_id", "text"), VOCABULARY)
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(secret_scan.span_texts(base), 256).alias("base_sha256"),
        secret_scan.span_texts(F.col("spans")).alias("spans"),
        count("random"),
    )


@query
def op3_winnowing_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that benchmark windows hit."""
    return decontam.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op4_tiled_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 best rows for every row whose id is divisible by 20."""
    rows = table(spark, folder, "embeddings")
    return topk.top_k(rows, rows.where(F.col("vec_id") % 20 == 0), 20)


@query
def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded and decoded again."""
    coded = bpe.encode(table(spark, folder, "documents"), VOCABULARY, keep=["doc_id"])
    decoded = bpe.decode(coded.select("doc_id", "ids"), VOCABULARY)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op6_license_rules(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and rule labels of every document."""
    return licenses.scan_licenses(table(spark, folder, "documents"))


@query
def op7_additive_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document, learnt from the labels that are not held out."""
    return gam.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def _day(number: Column) -> Column:
    return F.date_add(F.lit("2024-01-01").cast("date"), number.cast("int"))


def list_entries(pages: DataFrame) -> DataFrame:
    """A dated list made from the addresses that occur: hosts, sites and first path segments.

    The smallest page id of a key decides whether and when it is added, removed
    and added again.
    """
    host, path = urls.host_of(F.col("url")), urls.path_of(F.col("url"))
    places = pages.select("page_id", host.alias("host"), F.split(path, "/")[0].alias("top")).where("host <> ''")
    site = F.substring_index("host", ".", -2)
    hosts = places.groupBy(F.col("host").alias("key")).agg(F.min("page_id").alias("m"))
    sites = places.groupBy(site.alias("key")).agg(F.min("page_id").alias("m"))
    tops = places.where("top <> ''").groupBy(F.concat_ws("/", "host", "top").alias("key")).agg(F.min("page_id").alias("m"))
    m = F.col("m")

    def entry(df: DataFrame, when: Column, day: Column, action: str, category: str) -> DataFrame:
        return df.where(when).select("key", _day(day).alias("day"), F.lit(action).alias("action"), F.lit(category).alias("category"))

    parts = [
        entry(hosts, m % 5 == 0, (m * 37) % 300, "add", "spam"),
        entry(hosts, m % 10 == 0, (m * 37) % 300 + 45, "remove", "spam"),
        entry(hosts, m % 20 == 0, (m * 37) % 300 + 90, "add", "adult"),
        entry(sites, m >= 0, m % 200 + 50, "add", "malware"),
        entry(sites, m >= 0, m % 200 + 55, "remove", "malware"),
        entry(tops, m % 7 == 3, (m * 11) % 300, "add", "tracker"),
        entry(tops, m % 7 == 3, (m * 11) % 300 + 120, "remove", "tracker"),
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    return whole


@query
def op8_url_list_asof(spark: SparkSession, folder: str) -> DataFrame:
    """Every page judged by the list entries open on the day it was fetched.

    The tables hold neither a list nor fetch days; both are derived from
    ``pages`` by arithmetic on the page ids.
    """
    pages = table(spark, folder, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched", _day((F.col("page_id") * 17) % 365))
    return urls.filter_captures(captures, list_entries(pages), by_category=True)


@query
def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learnt from the documents that are not held out."""
    return langid.predictions(table(spark, folder, "documents"))


@query
def op10_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return ordminhash.near_duplicates(table(spark, folder, "documents"))


@query
def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """How the sources of every language differ from each other, and by which terms from the language."""
    return divergence.source_divergence(table(spark, folder, "documents"))


@query
def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults and cheapest repair of every conversation, after planting faults."""
    return repair.damaged_audit(table(spark, folder, "conversations"))


@query
def op13_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids written to binary files and read back."""
    return tokenfile.file_digests(table(spark, folder, "documents"), TOKENIZER)


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_CONTROL = r"</?s>|<\|im_(start|sep|end)\|>|<\|endoftext\|>|<<SYS>>|<</SYS>>|\[/?INST\]"


def _escaped_length(name: str) -> str:
    marks = f"len(regexp_extract_all({name}, '{_CONTROL}'))"
    return rf"(length({name}) + length({name}) - length(replace({name}, '\', '')) + {marks})"


def _way(cost: str, letter: str, row: str, after: str) -> str:
    """An edit in front of what is cheapest behind it, as (cost, audit, repaired text); comparing them settles ties."""
    rest = f"CASE WHEN {after}.r = '' THEN '' ELSE chr(10) || {after}.r END"
    text = f"{row} || {rest}" if row else f"{after}.r"
    return f"{{'c': {cost} + {after}.c, 'a': '{letter}' || {after}.a, 'r': {text}}}"


def _cheapest(state: int) -> str:
    """The cheapest repair from a state (0 start, 1 system, 2 user, 3 assistant) and a row on."""
    follows, name = (3, "assistant") if state == 2 else (2, "user")
    more = "CASE WHEN fault = 't' THEN 5 ELSE 0 END"
    kept = {0: "CASE WHEN letter = 's' THEN s1 WHEN letter = 'u' THEN s2 END", 2: "CASE WHEN letter = 'a' THEN s3 END"}
    keep = kept.get(state, "CASE WHEN letter = 'u' THEN s2 END")
    own = "role || ':' || text"
    may = "fault IN ('t', '-')"
    return f"""least({_way("2", "D", "", f"s{state}")},
      CASE WHEN {may} THEN {_way(f"1 + {more}", "R", f"'{name}:' || text", f"s{follows}")} END,
      CASE WHEN {may} AND ({keep}) IS NOT NULL THEN {_way(f"0 + {more}", "K", own, f"({keep})")} END)"""


def _inserted(state: int) -> str:
    follows, name = (3, "assistant") if state == 2 else (2, "user")
    return f"least(s{state}, {_way('5', 'I', f"'{name}:'", f's{follows}')}) AS s{state}"


_REPAIR = f"""
WITH RECURSIVE coded AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
summed AS (SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(8 * length(k)),
    lambda i: CASE WHEN i % 8 = 0 THEN ascii(substr(k, (i // 8 + 1)::INT, 1))::BIGINT ELSE 0::BIGINT END)),
    lambda x, b: CASE WHEN xor(x, b) & 1 = 1 THEN xor(xor(x, b) >> 1, 3988292384::BIGINT) ELSE xor(x, b) >> 1 END),
  4294967295::BIGINT) % 20 AS code FROM coded),
rows AS (SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
  CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE WHEN code = 3 THEN 2 ELSE 1 END)) AS copy FROM summed WHERE code <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos FROM rows),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) AS nth,
  regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS ending, substr(role, 1, 1) AS letter FROM placed),
faulty AS (SELECT *, CASE WHEN ending = '' THEN 'b' WHEN nth > 1 THEN 'd' WHEN ending NOT IN ('.', '!', '?') THEN 't' ELSE '-' END AS fault,
  letter || lead(letter) OVER (PARTITION BY conv_id ORDER BY pos) AS pair FROM seen),
told AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
  count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
  count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM faulty GROUP BY conv_id),
walk AS (
  SELECT conv_id, n + 1 AS pos, {{'c': 0, 'a': '', 'r': ''}} AS s0, {{'c': 10, 'a': 'II', 'r': 'user:' || chr(10) || 'assistant:'}} AS s1,
    {{'c': 5, 'a': 'I', 'r': 'assistant:'}} AS s2, {{'c': 0, 'a': '', 'r': ''}} AS s3 FROM told
  UNION ALL
  SELECT conv_id, pos, {", ".join(map(_inserted, range(4)))} FROM (
  SELECT conv_id, pos, {", ".join(map(_inserted, range(4)))} FROM (
  SELECT conv_id, pos, {", ".join(map(_inserted, range(4)))} FROM (
  SELECT w.conv_id, f.pos, {", ".join(f"{_cheapest(i)} AS s{i}" for i in range(4))}
  FROM walk w JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.pos = w.pos - 1) a) b) c),
best AS (SELECT conv_id, s0 FROM walk WHERE pos = 1)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(s0.c, 0)::BIGINT AS cost, coalesce(s0.a, '') AS audit,
  sha256(coalesce(s0.r, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e
LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN best x ON x.conv_id IS NOT DISTINCT FROM e.conv_id"""


SQL = {
    "op12_conversation_repair": _REPAIR,
    "op1_chat_prefixes": f"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'),
sized AS (SELECT *, 32 + {_escaped_length("role")} + {_escaped_length("text")} AS chars FROM given),
placed AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING) AS upto FROM sized)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars,
  count(*) FILTER (role = 'assistant') AS n_examples,
  coalesce(sum(upto) FILTER (role = 'assistant'), 0)::BIGINT AS example_chars
FROM placed GROUP BY conv_id""",
    "op3_winnowing_decontamination": f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, {_WORDS} AS ws FROM documents),
i AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
iw AS (SELECT DISTINCT item_id, n, array_to_string(ws[p:p + n - 1], ' ') AS w FROM (
  SELECT item_id, ws, least(13, len(ws)) AS n, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS p FROM i WHERE len(ws) > 0)),
dw AS (SELECT rid, p, n, array_to_string(ws[p:p + n - 1], ' ') AS w FROM (
  SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM iw))),
hits AS (SELECT rid, p, n, item_id FROM dw JOIN iw USING (n, w)),
covered AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS q FROM hits) GROUP BY rid),
named AS (SELECT rid, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hits GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN covered USING (rid) LEFT JOIN named USING (rid)""",
    "op8_url_list_asof": r"""
WITH a AS (SELECT page_id, url, DATE '2024-01-01' + ((page_id * 17) % 365)::INT AS fetched,
  lower(regexp_replace(regexp_replace(regexp_replace(regexp_extract(url, '^\s*[A-Za-z][A-Za-z0-9+.-]*://([^/?#\s]*)', 1), '^.*@', ''), ':\d*$', ''), '\.$', '')) AS host,
  regexp_replace(regexp_replace(regexp_extract(url, '^\s*[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/+', '/', 'g'), '^/|/$', '', 'g') AS path FROM pages),
p AS (SELECT * FROM a WHERE host <> ''),
hosts AS (SELECT host AS key, min(page_id) AS m FROM p GROUP BY 1),
sites AS (SELECT array_to_string(split(host, '.')[-2:], '.') AS key, min(page_id) AS m FROM p GROUP BY 1),
tops AS (SELECT host || '/' || split(path, '/')[1] AS key, min(page_id) AS m FROM p WHERE path <> '' GROUP BY 1),
e AS (
  SELECT key, (m * 37) % 300 AS n, 'add' AS action, 'spam' AS category FROM hosts WHERE m % 5 = 0
  UNION ALL SELECT key, (m * 37) % 300 + 45, 'remove', 'spam' FROM hosts WHERE m % 10 = 0
  UNION ALL SELECT key, (m * 37) % 300 + 90, 'add', 'adult' FROM hosts WHERE m % 20 = 0
  UNION ALL SELECT key, m % 200 + 50, 'add', 'malware' FROM sites
  UNION ALL SELECT key, m % 200 + 55, 'remove', 'malware' FROM sites
  UNION ALL SELECT key, (m * 11) % 300, 'add', 'tracker' FROM tops WHERE m % 7 = 3
  UNION ALL SELECT key, (m * 11) % 300 + 120, 'remove', 'tracker' FROM tops WHERE m % 7 = 3),
daily AS (SELECT key, n, max((action, category)) AS last FROM e GROUP BY key, n),
spans AS (SELECT key, DATE '2024-01-01' + n::INT AS listed_from,
  DATE '2024-01-01' + (lead(n) OVER (PARTITION BY key ORDER BY n))::INT AS listed_to, last[2] AS category, last[1] AS action FROM daily),
keys AS (
  SELECT page_id, url, fetched, unnest(range(1, len(split(host, '.')) + 1)) AS rank, host, path FROM p),
lookups AS (SELECT page_id, url, fetched, rank, array_to_string(split(host, '.')[-rank:], '.') AS key FROM keys
  UNION ALL SELECT page_id, url, fetched, 1000 + r, host || '/' || array_to_string(split(path, '/')[1:r], '/')
  FROM (SELECT *, unnest(range(1, len(split(path, '/')) + 1)) AS r FROM p WHERE path <> '')),
best AS (SELECT page_id, url, fetched, arg_max((key, category, listed_from, listed_to), rank) AS b
  FROM lookups JOIN spans USING (key) WHERE action = 'add' AND listed_from <= fetched AND (listed_to IS NULL OR listed_to > fetched) GROUP BY ALL)
SELECT a.page_id, a.url, a.fetched, b IS NOT NULL AS blocked, b[1] AS list_key, b[2] AS category, b[3] AS listed_from, b[4] AS listed_to
FROM a LEFT JOIN best ON a.page_id = best.page_id AND a.url = best.url""",
    "op11_source_divergence": r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
o AS (SELECT rid, lang, source, unnest(ws) AS term FROM d),
perdoc AS (SELECT rid, lang, source, term, count(*) AS n FROM o GROUP BY ALL),
c AS (SELECT lang, source, term, sum(n)::BIGINT AS n, count(*) AS docs FROM perdoc GROUP BY ALL),
k AS (SELECT lang, term, sum(n)::BIGINT AS lang_n FROM c GROUP BY lang, term HAVING sum(docs) >= 3),
v AS (SELECT lang, count(*) AS v, sum(lang_n)::BIGINT AS total FROM k GROUP BY lang),
sources AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT c.lang, c.source, sum(c.n)::BIGINT AS total FROM c JOIN k USING (lang, term) GROUP BY c.lang, c.source),
given AS (SELECT s.lang, s.source, v.v, v.total AS lang_total, coalesce(t.total, 0) AS total
  FROM sources s JOIN v USING (lang) LEFT JOIN t ON t.lang = s.lang AND t.source = s.source),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
  1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.total + g.v) AS p,
  1 + (1000000000::HUGEINT * (k.lang_n + 1)) // (g.lang_total + g.v) AS q
  FROM given g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term WHERE a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= 200""",
}
