"""The registered queries opN_<name> and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import ann, embedding_dedup, exact_dedup, importance, jaccard_join, language, mixing, pii, prefix_trie, quality, sentencepiece, suffix_dedup, url_filter
from .common import crc_mod, table

#: Fixed rules of the url query (verdict, host, path).
URL_RULES = [
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
]


def op1_suffix_array_dedup(spark, sf_dir):
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    model = quality.train(docs, table(spark, sf_dir, "labels"), ~held)
    return quality.score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


def op3_ngram_jaccard_join(spark, sf_dir):
    return jaccard_join.similarity_components(table(spark, sf_dir, "documents"), k=3, num=90, den=100).select("doc_id", "n_shingles", "component_id")


def op4_url_filters(spark, sf_dir):
    return url_filter.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op5_nearest_neighbours(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    return ann.search(rows, rows.where(F.col("vec_id") % 50 == 0), k=5)


def op6_embedding_near_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.98)


def op7_sentencepiece(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece.encode_with_check(docs, sentencepiece.PieceTable.load()).select("doc_id", "n_pieces", "round_trip", "ids")


def op8_pii(spark, sf_dir):
    found = pii.find_pii(table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select("doc_id", *[f"n_{k}" for k in pii.BASE_KINDS], F.sha2(pii.spans_text(F.col("base")), 256).alias("base_sha256"),
                        pii.spans_text(F.col("spans")).alias("spans"))


def op9_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False))
    return language.identify(docs, language.train(docs, ~held)).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op10_source_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"), labels=table(spark, sf_dir, "labels")).select("doc_id", "size", "source_size", "target", "taken")


def op11_prefix_trie(spark, sf_dir):
    return prefix_trie.build(table(spark, sf_dir, "conversations"))


def op12_exact_dedup(spark, sf_dir):
    return exact_dedup.deduplicate(spark, f"{sf_dir.rstrip('/')}/documents.parquet").select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op13_importance_resampling(spark, sf_dir):
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP4_SQL = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), rules(verdict, host, path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), hits AS (
  SELECT p.page_id, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host) DESC, length(r.path) DESC, r.verdict DESC) AS k
  FROM parts p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
)
SELECT p.page_id, p.host, p.path, h.rule, coalesce(h.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN hits h ON h.page_id = p.page_id AND h.k = 1
"""

# crc32 of the UTF-8 bytes of a text, over a table of the 256 one-byte remainders: table ``crc_bytes(t)``, a list
_BIT = "CASE WHEN {0} & 1 = 1 THEN xor({0} >> 1, 3988292384) ELSE {0} >> 1 END"
CRC_CTE = ("crc_steps AS (SELECT i, i::BIGINT AS s0 FROM range(256) r(i)), "
           + ", ".join(f"crc_step{k + 1} AS (SELECT i, {_BIT.format(f's{k}')} AS s{k + 1} FROM crc_step{k or 's'})" for k in range(8))
           + ", crc_bytes AS (SELECT list(s8 ORDER BY i) AS t FROM crc_step8)")


def crc_sql(text: str) -> str:
    """Unsigned crc32 of the SQL expression ``text``; ``crc_bytes`` must be in scope."""
    codes = (f"list_transform(range(0, length(hex(encode({text}))) // 2), lambda i: "
             f"16 * (instr('0123456789ABCDEF', substr(hex(encode({text})), 2 * i + 1, 1)) - 1) + instr('0123456789ABCDEF', substr(hex(encode({text})), 2 * i + 2, 1)) - 1)")
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda a, b: xor(a >> 8, crc_bytes.t[(xor(a, b) & 255) + 1])), 4294967295)"


OP11_SQL = f"""
WITH {CRC_CTE},
turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST,
                            sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, {crc_sql('conv_id::VARCHAR')} % 9 AS head, conv_id - conv_id % 5 AS source FROM (SELECT DISTINCT conv_id FROM turns), crc_bytes
), parts AS (
  SELECT c.conv_id, 0 AS part, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.source AND t.pos <= c.head
  UNION ALL SELECT c.conv_id, 1, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.head
), paths AS (
  SELECT c.conv_id, coalesce(list([p.role, p.text] ORDER BY p.part, p.pos) FILTER (p.conv_id IS NOT NULL), []) AS path
  FROM convs c LEFT JOIN parts p ON p.conv_id = c.conv_id GROUP BY c.conv_id
), prefixes AS (
  SELECT conv_id, len(path) AS n, d AS depth, path[1:d] AS prefix, path[d] AS last_turn FROM paths, unnest(range(0, len(path) + 1)) u(d)
), nodes AS (
  SELECT prefix, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         CASE WHEN any_value(depth) = 0 THEN 0 ELSE (count(*) - 1) * any_value(octet_length(encode(coalesce(last_turn[2], '')))) END AS tokens,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '') AS ends
  FROM prefixes GROUP BY prefix
), children AS (
  SELECT prefix[1:depth - 1] AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), values_ AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.prefix = n.prefix
), sums AS (
  SELECT v.prefix[1:d] AS prefix, sum(v.tokens) AS saved_tokens, count_if(v.n_children = 0) AS n_leaves
  FROM values_ v, unnest(range(0, v.depth + 1)) u(d) GROUP BY 1
)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, s.n_leaves::BIGINT AS n_leaves,
       s.saved_tokens::BIGINT AS saved_tokens, sha256(v.ends) AS ends_sha256
FROM values_ v JOIN sums s ON s.prefix = v.prefix LEFT JOIN nodes p ON v.depth > 0 AND p.prefix = v.prefix[1:v.depth - 1]
"""

OP12_SQL = """
WITH texts AS (SELECT doc_id, coalesce(text, '') AS body FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
       row_number() OVER (PARTITION BY body ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(body) AS text_sha256
FROM texts
"""


def _words_sql(table_name: str, key: str) -> str:
    lowered = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"
    return f"SELECT {key}, regexp_extract_all({lowered}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM {table_name}"


OP13_SQL = f"""
WITH {CRC_CTE},
docs AS (SELECT *, row_number() OVER () AS nr FROM ({_words_sql('documents', 'doc_id')})),
found AS (SELECT nr, unnest(words) AS word FROM docs),
wanted AS (SELECT unnest(words) AS word FROM ({_words_sql('benchmark', 'item_id')})),
vocabulary AS (
  SELECT word, {crc_sql('word')} % 10000 AS bucket FROM (SELECT word FROM found UNION SELECT word FROM wanted), crc_bytes
), s AS (SELECT bucket, count(*) AS n FROM found JOIN vocabulary USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM wanted JOIN vocabulary USING (word) GROUP BY bucket),
totals AS (SELECT (SELECT count(*) FROM found) AS s_all, (SELECT count(*) FROM wanted) AS t_all),
gain AS (
  SELECT b AS bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (s_all + 10000)::DOUBLE / ((coalesce(s.n, 0) + 1)::DOUBLE * (t_all + 10000)::DOUBLE)))::BIGINT AS g
  FROM totals, range(10000) r(b) LEFT JOIN s ON s.bucket = b LEFT JOIN t ON t.bucket = b
), weights AS (SELECT nr, sum(g)::BIGINT AS weight FROM found JOIN vocabulary USING (word) JOIN gain USING (bucket) GROUP BY nr),
hashed AS (SELECT nr, sha256('2024:' || coalesce(doc_id::VARCHAR, '')) AS h FROM docs),
scored AS (
  SELECT nr, doc_id, len(words) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(h, 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM docs JOIN hashed USING (nr) LEFT JOIN weights USING (nr)
), ranked AS (
  SELECT nr, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST, nr) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (nr)
"""

#: query name -> (function, SQL or None)
QUERIES = {
    "op1_suffix_array_dedup": (op1_suffix_array_dedup, None),
    "op2_quality_classifier": (op2_quality_classifier, None),
    "op3_ngram_jaccard_join": (op3_ngram_jaccard_join, None),
    "op4_url_filters": (op4_url_filters, OP4_SQL),
    "op5_nearest_neighbours": (op5_nearest_neighbours, None),
    "op6_embedding_near_dedup": (op6_embedding_near_dedup, None),
    "op7_sentencepiece": (op7_sentencepiece, None),
    "op8_pii": (op8_pii, None),
    "op9_language_id": (op9_language_id, None),
    "op10_source_mixing": (op10_source_mixing, None),
    "op11_prefix_trie": (op11_prefix_trie, OP11_SQL),
    "op12_exact_dedup": (op12_exact_dedup, OP12_SQL),
    "op13_importance_resampling": (op13_importance_resampling, OP13_SQL),
}
