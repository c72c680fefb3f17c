"""The registered queries of the text operators; SQL beside those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelframe.llm import chat, codes, decontaminate, langid, linedup, packing, quality, simhash, sketch, tokencount, topk, trie, warc
from parcelframe.llm.common import held_out

QUERIES = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op3_compression_quality")
def _(spark, folder):
    docs = table(spark, folder, "documents")
    model = quality.train(docs.select("doc_id", "text"), table(spark, folder, "labels"), ~held_out(F.col("doc_id")))
    return quality.score_quality(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query("op4_merge_counts")
def _(spark, folder):
    return tokencount.count_tokens(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


@query("op6_simhash_groups")
def _(spark, folder):
    return simhash.group_near(table(spark, folder, "documents"))


@query("op8_language_id")
def _(spark, folder):
    docs = table(spark, folder, "documents")
    model = langid.train(docs.filter(~held_out(F.col("doc_id"))))
    return langid.identify(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


# The template's marks add 20 code points to a turn; a text with a mark or an escape sign that would be read as one has one more
# for each of them.
_CHAT_SQL = r"""WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(20 + length(role) + length(text) + CASE WHEN regexp_matches(text, '</?s>|\[/?INST\]|\\\\|\\$')
        THEN len(regexp_extract_all(text, '\\|</?s>|\[/?INST\]')) ELSE 0 END) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id"""


@query("op5_chat_round_trip", _CHAT_SQL)
def _(spark, folder):
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    says = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-7, 0, "user", says), (-7, 1, "assistant", says)], turns.schema)
    return chat.read_back(chat.format_turns(turns.unionByName(added)))


@query("op9_best_fit_packing")
def _(spark, folder):
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end=1)


# Base 32 spelled out: four bits for each hexadecimal digit of the digest, a letter for each five of them.
_WARC_SQL = """WITH hashed AS (
    SELECT page_id, coalesce(html, '') AS body, CAST(strlen(coalesce(html, '')) AS BIGINT) AS size, sha1(coalesce(html, '')) AS hex FROM pages),
owned AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS owner FROM hashed),
bits AS (SELECT *, array_to_string(list_transform(range(1, 41), lambda k:
    lpad(bin(strpos('0123456789abcdef', substr(hex, k, 1)) - 1), 4, '0')), '') AS b FROM owned)
SELECT page_id, size AS payload_bytes, array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + 16 * substr(b, 5 * k + 1, 1)::INT + 8 * substr(b, 5 * k + 2, 1)::INT + 4 * substr(b, 5 * k + 3, 1)::INT
    + 2 * substr(b, 5 * k + 4, 1)::INT + substr(b, 5 * k + 5, 1)::INT, 1)), '') AS payload_digest,
    CASE WHEN owner IS NULL OR page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> owner THEN owner END AS refers_to FROM bits"""


@query("op10_warc_round_trip", _WARC_SQL)
def _(spark, folder):
    return warc.archived_records(warc.archive_pages(table(spark, folder, "pages"), least=0))


@query("op2_line_alignment")
def _(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    n = F.coalesce(F.size("lines"), F.lit(0))
    return linedup.remove_shared(docs, lines_col="lines").select("doc_id", "text", n.alias("n_removed"), "lines")


@query("op1_template_leaks")
def _(spark, folder):
    return decontaminate.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op7_invertible_sketch")
def _(spark, folder):
    return sketch.fingerprints(table(spark, folder, "documents"))


_USABLE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
_TOP_SQL = f"""WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings WHERE {_USABLE}),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10"""


@query("op11_exact_top_k", _TOP_SQL)
def _(spark, folder):
    return topk.top_k(table(spark, folder, "embeddings"), every=100, k=10, scale=1024)


# crc32 spelled out: a byte is xored in, then eight steps (the -1) shift by one bit each and xor the polynomial if that bit was set.
_CRC = """xor(4294967295, list_reduce(flatten(list_transform(range(1, length(c::VARCHAR) + 1),
    lambda i: [ascii(substr(c::VARCHAR, i, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END, 4294967295::BIGINT))"""

_TRIE_SQL = f"""WITH turns AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, role, text) AS s FROM turns GROUP BY c),
heads AS (SELECT c, s, {_CRC} % 9 AS h FROM own),
built AS (SELECT a.c, list_concat(coalesce(b.s, [])[1:a.h], a.s[a.h + 1:]) AS s FROM heads a LEFT JOIN own b ON b.c = a.c - a.c % 5),
steps AS (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM built),
nodes AS MATERIALIZED (SELECT s[1:d] AS p, d, min(c) AS c, count(*) AS n, string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(s) = d) AS ends
    FROM steps GROUP BY s[1:d], d),
kids AS MATERIALIZED (SELECT p[1:d - 1] AS p, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
above AS (SELECT u.p, u.d, CASE WHEN u.d = 0 THEN 0 ELSE (u.n - 1) * strlen(u.p[u.d].text) END AS saved,
    CASE WHEN k.n IS NULL THEN 1 ELSE 0 END AS leaf, unnest(range(0, u.d + 1)) AS e FROM nodes u LEFT JOIN kids k ON k.d = u.d AND k.p = u.p),
sums AS MATERIALIZED (SELECT p[1:e] AS p, e AS d, sum(saved) AS saved, sum(leaf) AS leaves FROM above GROUP BY p[1:e], e)
SELECT v.c AS conv_id, v.d AS depth, w.c AS parent_conv_id, v.n AS n_convs, CAST(coalesce(k.n, 0) AS BIGINT) AS n_children,
    CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(v.ends, '')) AS ends_sha256
FROM nodes v JOIN sums s ON s.d = v.d AND s.p = v.p LEFT JOIN kids k ON k.d = v.d AND k.p = v.p
LEFT JOIN nodes w ON w.d = v.d - 1 AND w.p = v.p[1:v.d - 1]"""


@query("op12_conversation_trie", _TRIE_SQL)
def _(spark, folder):
    return trie.conversation_trie(table(spark, folder, "conversations"))


def _nearest(book: str) -> str:
    """The nearest entry of each part; 'd' comes first in the struct, so ties go to the lower entry."""
    return f"""SELECT x.vec_id, x.label, x.p, any_value(x.v) AS v,
    min({{'d': list_dot_product(x.v, x.v) - 2 * list_dot_product(x.v, b.v) + list_dot_product(b.v, b.v), 'k': b.k}}) AS best
    FROM cut x JOIN {book} b ON b.p = x.p GROUP BY x.vec_id, x.label, x.p"""


def _moved(near: str, book: str) -> str:
    return f"""SELECT b.p, b.k, coalesce(m.v, b.v) AS v FROM {book} b LEFT JOIN (
    SELECT p, k, list(floor(s / n) ORDER BY i) AS v FROM (SELECT p, best.k AS k, i, sum(v[i]) AS s, count(*) AS n
        FROM {near}, range(1, 1 + (SELECT max(len(v)) FROM cut)) r(i) GROUP BY ALL) GROUP BY p, k) m ON m.p = b.p AND m.k = b.k"""


_CODES_SQL = f"""WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings WHERE {_USABLE}),
cut AS MATERIALIZED (SELECT vec_id, label, p, e[1 + p * len(e) // 16 : (p + 1) * len(e) // 16] AS v FROM v, range(0, 16) r(p)),
seeds AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS k FROM v ORDER BY vec_id LIMIT 64),
book0 AS MATERIALIZED (SELECT p, k, v FROM cut JOIN seeds USING (vec_id)),
near0 AS MATERIALIZED ({_nearest("book0")}),
book1 AS MATERIALIZED ({_moved("near0", "book0")}),
near1 AS MATERIALIZED ({_nearest("book1")}),
book2 AS MATERIALIZED ({_moved("near1", "book1")}),
near2 AS MATERIALIZED ({_nearest("book2")}),
told AS (SELECT sha256(string_agg(list_aggregate(list_transform(v, lambda x: x::BIGINT), 'string_agg', ','), ',' ORDER BY p, k)) AS sha FROM book2),
coded AS (SELECT vec_id, label, string_agg(lower(lpad(hex(best.k), 2, '0')), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
    FROM near2 GROUP BY vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT sha FROM told) AS codebooks_sha256 FROM coded"""


@query("op13_vector_codes", _CODES_SQL)
def _(spark, folder):
    return codes.compress(table(spark, folder, "embeddings"), parts=16, entries=64, rounds=2, scale=256)
