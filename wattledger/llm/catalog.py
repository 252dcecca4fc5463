"""The operators as named queries over the given tables."""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chat, contamination, jaccard, licenses, packing, pii, quality, ranking, shards, token_counts, token_files, urls, whitening
from .tables import new_folder

QUERIES = {}
SQL = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdicts of all documents."""
    return quality.judge(_table(spark, sf_dir, "documents"))


QUERIES["op7_quality"] = op7_quality


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words in every document."""
    found = contamination.scan(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


QUERIES["op5_decontamination"] = op5_decontamination

_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")

SQL["op5_decontamination"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
cut AS (SELECT item_id, w, least(len(w), 13) AS l, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS a
        FROM b WHERE len(w) > 0),
phrase AS (SELECT DISTINCT item_id, l, array_to_string(w[a:a + l - 1], ' ') AS p FROM cut),
start AS (SELECT r, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM d, (SELECT DISTINCT l FROM phrase)
          WHERE len(w) >= l),
occ AS (SELECT r, i, l, item_id FROM (SELECT r, i, l, array_to_string(w[i:i + l - 1], ' ') AS p FROM start)
        JOIN phrase USING (l, p)),
hit AS (SELECT r, count(DISTINCT pos) AS n FROM (SELECT r, unnest(range(i, i + l)) AS pos FROM occ) GROUP BY r),
ids AS (SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY id) AS list
        FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM occ) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(ids.n, 0) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256,
       coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN ids USING (r)"""


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.packed(_table(spark, sf_dir, "documents"))


QUERIES["op10_packing"] = op10_packing


def op1_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of near copies of all documents, and how many links each document has."""
    return jaccard.linked(_table(spark, sf_dir, "documents"))


QUERIES["op1_jaccard"] = op1_jaccard
SQL["op1_jaccard"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[a:a + 4], ' ') AS shingle
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS a FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON b.shingle = a.shingle AND b.doc_id <> a.doc_id
           GROUP BY ALL),
link AS (SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * i >= 80 * (p.n + q.n - i)),
reach AS (SELECT doc_id, doc_id AS other FROM d UNION SELECT r.doc_id, l.y FROM reach r JOIN link l ON l.x = r.other)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id, coalesce(any_value(k), 0) AS n_links
FROM reach LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT x AS doc_id, count(*) AS k FROM link GROUP BY x) USING (doc_id) GROUP BY doc_id"""


def _id_digests(keys, starts, lengths, ids) -> pa.RecordBatch:
    raw, ends = memoryview(ids.astype("<u4", copy=False)).cast("B"), lengths.cumsum()
    crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip((ends - lengths).tolist(), ends.tolist())]
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(starts), pa.array(lengths), pa.array(crc, pa.int64())],
                                      names=["doc_id", "start", "n_tokens", "ids_crc32"])


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every document, read back from the token files."""
    path = new_folder(spark, "tokens")
    token_files.write(_table(spark, sf_dir, "documents"), path)
    return token_files.read(spark, path, _id_digests, "doc_id long, start long, n_tokens long, ids_crc32 long")


QUERIES["op2_token_files"] = op2_token_files


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents."""
    return token_counts.count(_table(spark, sf_dir, "documents"))


QUERIES["op9_token_counts"] = op9_token_counts


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on the addresses of all pages."""
    return urls.judge(_table(spark, sf_dir, "pages"))


QUERIES["op4_url_filters"] = op4_url_filters
SQL["op4_url_filters"] = """
WITH rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
              FROM pages),
part AS (SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                   'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
rule(h, p, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                               ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
best AS (SELECT host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
         FROM (SELECT DISTINCT host, path FROM part) JOIN rule
         ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY host, path)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM part LEFT JOIN best USING (host, path)"""


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard and slot of every document."""
    return shards.placed(_table(spark, sf_dir, "documents"))


QUERIES["op3_sharding"] = op3_sharding

_CONTROL = "</s>[INST] ok [/INST]"


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of control strings, formatted and read back."""
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.sql(f"SELECT * FROM VALUES (-7L, 0L, 'user', '{_CONTROL}'), (-7L, 1L, 'assistant', '{_CONTROL}') AS t(conv_id, turn, role, text)")
    read = chat.parsed(chat.formatted(chat.log_of(rows.unionByName(own))))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("loss_texts", "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
                       F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                       F.char_length("formatted").cast("long").alias("formatted_chars"))


QUERIES["op6_chat"] = op6_chat
SQL["op6_chat"] = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
shown AS (SELECT *, length(role) + length(text) + length('<s>[INST]  [/INST] </s>')
                 + len(regexp_extract_all(role, '[<\[]\\*(/?s>|/?INST\])'))
                 + len(regexp_extract_all(text, '[<\[]\\*(/?s>|/?INST\])')) AS chars FROM t),
agg AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
               coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
               sum(chars) AS chars FROM shown GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(chars AS BIGINT) AS formatted_chars FROM agg"""


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and labels of every document."""
    found = licenses.scan(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")


QUERIES["op8_licenses"] = op8_licenses


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: counts and digest of the base kinds, and all spans."""
    return pii.digest(pii.scan(_table(spark, sf_dir, "documents")))


QUERIES["op11_pii"] = op11_pii


def _near(words):
    return f"regexp_matches(near, '(^|[^a-z0-9])({'|'.join(words)})([^a-z0-9]|$)')"


def _pii_kind(number: int, k: pii.Kind, pattern: str, cut: str, good: str) -> str:
    """Spans of one kind: proposals and the pieces between them give the places."""
    if not k.base:
        good = (f"({good}) AND score >= {pii.ACCEPTED} AND NOT regexp_matches(before, '[A-Za-z0-9]$') "
                "AND NOT regexp_matches(after, '^[0-9]')")
    return f"""
SELECT r, {number} AS k, '{k.name}' AS kind, s, s + length(m) AS e FROM (
  SELECT *, greatest(0, least(100, {k.score} + CASE WHEN {_near(k.words)} THEN {pii.RAISED} ELSE 0 END
                                   - CASE WHEN {_near(pii.DOUBT)} THEN {pii.LOWERED} ELSE 0 END)) AS score
  FROM (SELECT r, s, before, after, {cut} AS m,
               translate(before || ' | ' || after, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS near
        FROM (SELECT r, ms[i] AS m, right(ps[i], {pii.CONTEXT}) AS before, left(ps[i + 1], {pii.CONTEXT}) AS after,
                     CAST(list_sum(list_transform(ps[1:i], lambda x: length(x)))
                          + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s
              FROM (SELECT r, ms, string_split_regex(t, '{pattern}') AS ps, unnest(range(1, len(ms) + 1)) AS i
                    FROM (SELECT r, t, regexp_extract_all(t, '{pattern}') AS ms FROM d) WHERE len(ms) > 0)))
  WHERE m <> '') WHERE {good}"""


def _pii_sql() -> str:
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    luhn = (f"list_sum(list_transform(range(1, length({digits}) + 1), lambda j: CASE WHEN (length({digits}) - j) % 2 = 0 "
            f"THEN CAST({digits}[j] AS INT) WHEN CAST({digits}[j] AS INT) > 4 THEN 2 * CAST({digits}[j] AS INT) - 9 "
            f"ELSE 2 * CAST({digits}[j] AS INT) END)) % 10 = 0")
    part = "0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    plain = "replace(m, ' ', '')"
    number = f"({plain}[5:] || {plain}[1:4])"
    mod = (f"list_reduce([0] || list_transform(range(1, length({number}) + 1), lambda j: CASE WHEN {number}[j] BETWEEN '0' AND '9' "
           f"THEN ascii({number}[j]) - 48 ELSE ascii({number}[j]) - 55 END), lambda a, c: (a * CASE WHEN c < 10 THEN 10 ELSE 100 END + c) % 97) = 1")
    length = "(MAP {" + ", ".join(f"'{c}': {n}" for c, n in pii.IBAN_LENGTHS.items()) + "})[m[1:2]]"
    cut = (f"CASE WHEN length({plain}) >= {length} THEN regexp_extract(m, '^[A-Z0-9]( ?[A-Z0-9]){{' || ({length} - 1) || '}}') ELSE '' END")
    rules = {"email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "m", "true"),
             "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "m", rf"regexp_full_match(m, '{part}(\.{part}){{3}}')"),
             "card": (r"[0-9]([\x20-]?[0-9])+", "m", f"length({digits}) BETWEEN 16 AND 19 AND {luhn}"),
             "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "m", f"length({digits}) BETWEEN 8 AND 15"),
             "iban": ("[A-Z]{2}[0-9]{2}( ?[A-Z0-9]){11,30}", cut, mod),
             "ssn": ("[0-9]{3}-[0-9]{2}-[0-9]{4}", "m", "NOT regexp_matches(m, '^(000|666|9)|-00-|-0000$')"),
             "secret": ("[0-9A-Fa-f]{32,128}", "m", "regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Fa-f]')")}
    found = " UNION ALL ".join(_pii_kind(i, k, *rules[k.name]) for i, k in enumerate(pii.KINDS))
    count = ", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in pii.BASE)
    counted = ", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in pii.BASE)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
span AS ({found}),
agg AS (SELECT r, {counted}, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY k, s) AS spans,
               string_agg(kind || ':' || s || ':' || e, ',' ORDER BY k, s) FILTER (WHERE k < {len(pii.BASE)}) AS base FROM span GROUP BY r)
SELECT doc_id, {count}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN agg USING (r)"""


SQL["op11_pii"] = _pii_sql()


def op12_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return ranking.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES["op12_ranking"] = op12_ranking
_TERMS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')")
SQL["op12_ranking"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
full_ AS (SELECT r, doc_id, w, CAST(len(w) AS BIGINT) AS n FROM d WHERE len(w) > 0),
corpus AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM full_),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM full_) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM tf, corpus GROUP BY term, n_docs),
part AS (SELECT r, term, weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_docs) // n_terms)))) AS part
         FROM tf JOIN weight USING (term) JOIN full_ USING (r), corpus),
scored AS (SELECT item_id, r, doc_id, CAST(sum(part) AS BIGINT) AS score FROM q JOIN part USING (term) JOIN full_ USING (r) GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
WHERE rank <= 50"""


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whitened embeddings, a row for each component."""
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


QUERIES["op13_whitening"] = op13_whitening
