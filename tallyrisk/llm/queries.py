"""Registered queries of the training-data operators: each applies its operator to its whole table.

``QUERIES`` maps a name to a callable (spark, sf_dir) -> DataFrame, ``ORACLE`` to DuckDB SQL where SQL can express it.
"""
from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe_stream, chat_format, embedding_dedup, language_id, lexical_search, license_scan, nn_descent, order_minhash, packing,
               substring_dedup, token_align, token_count, url_filter)
from .common import Runner, table

# ---------------------------------------------------------------- op1: URL filters
RULES = [url_filter.Rule("net", "/", "block"), url_filter.Rule("example.net", "/en/", "allow"),
         url_filter.Rule("example.com", "/de/", "block"), url_filter.Rule("org", "/fr/", "allow")]
#: Block list of the query (a parameter): sites, each with the usual host prefixes and three suffixes.
BLOCKED_SITES = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
PREFIXES = ("", "www.", "m.", "blog.")
SUFFIXES = (".example.com", ".example.net", ".example.org")


def blocked_hosts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(p + s + d,) for s in BLOCKED_SITES for p in PREFIXES for d in SUFFIXES], "key string")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return (url_filter.filter_urls(pages, RULES, blocked_hosts(spark))
            .select("page_id", "host", "path", "rule", "verdict", "is_listed"))


OP1_SQL = f"""
WITH u AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
rules(rh, rp, rv) AS (VALUES {', '.join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in RULES)}),
hosts(h) AS (SELECT p || s || d FROM (VALUES {', '.join(f"('{p}')" for p in PREFIXES)}) a(p),
   (VALUES {', '.join(f"('{s}')" for s in BLOCKED_SITES)}) b(s), (VALUES {', '.join(f"('{d}')" for d in SUFFIXES)}) c(d)),
j AS (
  SELECT u.*, (SELECT max_by(rh || rp, length(rh || rp)) FROM rules
               WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)) AS rule,
         host IN (SELECT h FROM hosts) AS is_listed FROM u)
SELECT page_id, host, path, rule, is_listed,
       coalesce((SELECT rv FROM rules WHERE rh || rp = rule), CASE WHEN is_listed THEN 'block' ELSE 'allow' END) AS verdict
FROM j
"""

# ---------------------------------------------------------------- op2: approximate nearest neighbours
def op2_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nn_descent.nearest(rows, F.col("vec_id") % 100 == 0)


# ---------------------------------------------------------------- op3: chat formatting
EXTRA_CHAT = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(EXTRA_CHAT, "conv_id long, turn long, role string, text string")
    return chat_format.digest(chat_format.format_chats(rows.unionByName(extra)))


OP3_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, row_number() OVER w AS i, lag(role, 1, '') OVER w AS prev,
         CASE role WHEN 'system' THEN 'System' WHEN 'user' THEN 'User' WHEN 'assistant' THEN 'Assistant'
           ELSE '\9' || replace(replace(replace(replace(role, '\', '\0'), '###', '\1'), '</turn>', '\2'), ':', '\3') END AS shown,
         replace(replace(replace(text, '\', '\0'), '###', '\1'), '</turn>', '\2') AS esc
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY i)) AS loss_sha256,
       CAST(sum(4 + length(shown) + 2 + length(esc) + 8) AS BIGINT) AS formatted_chars,
       bool_and((prev, role) IN (('', 'system'), ('', 'user'), ('system', 'user'), ('user', 'assistant'), ('assistant', 'user')))
         AND last(role ORDER BY i) = 'assistant' AS valid
FROM e GROUP BY conv_id
"""

# ---------------------------------------------------------------- op4: embedding near-dedup
def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_links(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


# ---------------------------------------------------------------- op5: MinHash near-dedup
def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


# ---------------------------------------------------------------- op6: BPE encoding and decoding
def op6_bpe_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("word_bpe_49k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe_stream.decode(bpe_stream.encode(docs, path).drop("text"), path)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


# ---------------------------------------------------------------- op7: language ID
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents: the language column is the declaration, the source the host."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return language_id.identify(docs).select("doc_id", "language", "posterior", "accepted", "text_language")


def pages_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages: declared markup language, address suffix and host; the text is the page without scripts and tags."""
    html, url = F.col("html"), F.col("url")
    pages = table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract(html, r"(?is)<html[^>]*\blang=[\"']?([a-z-]+)", 1).alias("lang"), url_filter.host_of(url).alias("host"),
        F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1>", " "), r"(?s)<[^>]*>|&[a-z#0-9]+;", " ").alias("text"))
    return (language_id.identify(pages, language_id.Evidence("text", "lang", "host"))
            .select("page_id", "language", "posterior", "accepted", "text_language"))


# ---------------------------------------------------------------- op8: license scans
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: source / language / thousand / document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.concat_ws(
        "/", "source", "lang", F.floor(F.col("doc_id") / 1000).cast("string"), F.col("doc_id").cast("string")).alias("path"))
    return license_scan.scan(docs).drop("text")


_TW = [(i, n, w, c) for i, (n, t) in enumerate(license_scan.ALL) for w, c in sorted(Counter(license_scan.template_words(t)).items())]
OP8_SQL = rf"""
WITH tw(t, license, w, c) AS (VALUES {', '.join(f"({i}, '{n}', '{w}', {c})" for i, n, w, c in _TW)}),
d AS (SELECT doc_id, text, concat_ws('/', source, lang, CAST(doc_id // 1000 AS VARCHAR), CAST(doc_id AS VARCHAR)) AS path FROM documents),
n AS (SELECT count(text) AS n FROM d),
dw AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda x: x <> '') AS ws FROM d),
df AS (SELECT w, count(*) AS df FROM (SELECT DISTINCT doc_id, unnest(ws) AS w FROM dw) GROUP BY w),
words AS (SELECT w FROM df UNION SELECT w FROM tw),
idf AS (SELECT w, ln((1 + n) / (1 + coalesce(df, 0))) + 1 AS idf FROM words CROSS JOIN n LEFT JOIN df USING (w)),
tn AS (SELECT t, license, sqrt(sum((c * idf) ** 2)) AS norm FROM tw JOIN idf USING (w) GROUP BY t, license),
b AS (SELECT doc_id, text, regexp_split_to_array(text, '{license_scan.BLOCK_END}') AS blocks FROM d),
l AS (SELECT doc_id, unnest(list_distinct(list_concat(string_split(text, chr(10)), blocks,
        flatten(list_transform(blocks, lambda x: regexp_split_to_array(x, '{license_scan.SENTENCE_END}'))), [text]))) AS line FROM b),
lw AS (SELECT doc_id, line, w, count(*) AS c FROM (
         SELECT doc_id, line, unnest(regexp_split_to_array(lower(line), '[^a-z0-9]+')) AS w FROM l) WHERE w <> '' GROUP BY ALL),
lx AS (SELECT doc_id, line, w, c, idf FROM lw JOIN idf USING (w)),
ln AS (SELECT doc_id, line, sqrt(sum((c * idf) ** 2)) AS norm, sum(c) AS n FROM lx GROUP BY ALL),
dot AS (SELECT doc_id, line, t, sum(lx.c * lx.idf * tw.c * lx.idf) AS dot FROM lx JOIN tw USING (w) GROUP BY ALL),
sc AS (SELECT doc_id, line, license, ln.n, round(dot / (ln.norm * tn.norm), 6) AS score
       FROM dot JOIN ln USING (doc_id, line) JOIN tn USING (t)),
own AS (SELECT * FROM sc WHERE score >= {license_scan.THRESHOLD} QUALIFY row_number() OVER (
          PARTITION BY doc_id ORDER BY license IN ({', '.join(f"'{x}'" for x in license_scan.WEAK)}), score DESC, license, line) = 1),
f AS (SELECT d.doc_id, d.path, own.license AS own_license, own.score, regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir,
             coalesce(own.n / greatest(len(ws), 1) >= {license_scan.FILE_SHARE}, false) AS license_file
      FROM d JOIN dw USING (doc_id) LEFT JOIN own USING (doc_id)),
named AS (SELECT dir, own_license FROM f WHERE license_file
          QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, path) = 1),
near AS (SELECT f.doc_id, named.own_license AS near FROM f JOIN named ON f.dir = named.dir OR starts_with(f.dir, named.dir || '/')
         QUALIFY row_number() OVER (PARTITION BY f.doc_id ORDER BY length(named.dir) DESC) = 1)
SELECT f.doc_id, path, own_license, score, license_file, coalesce(own_license, near) AS license,
       CASE WHEN own_license IS NOT NULL THEN 'own' WHEN near IS NOT NULL THEN 'inherited' ELSE 'none' END AS basis
FROM f LEFT JOIN near USING (doc_id)
"""


# ---------------------------------------------------------------- op9: packing
def vocabulary(name: str) -> str:
    """Path of a public tokenizer file (a parameter of the operators; never copied)."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary("byte_bpe_50k.tiktoken"))


# ---------------------------------------------------------------- op10: substring dedup
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = substring_dedup.substring_dedup(docs)
    span = F.transform("removed", lambda s: F.concat_ws("-", s["start"], s["end"]))
    return out.select("doc_id", F.size("removed").cast("long").alias("n_spans"),
                      F.array_join(span, ",").alias("spans"), "text")


# ---------------------------------------------------------------- op11: token counts
def op11_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_count.count_tokens(docs, vocabulary("piece_bpe_32k.model")).select("doc_id", "n_bytes", "n_tokens", "over_limit")


# ---------------------------------------------------------------- op12: cross-tokenizer alignment
def op12_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_align.align(docs, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


# ---------------------------------------------------------------- op13: ranked lexical search
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                 table(spark, sf_dir, "benchmark").select("item_id", "text"))


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP13_SQL = f"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
dn AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
s AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS l FROM dn),
w AS (SELECT term, CAST(floor(1000 * ln((2 * nd + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, s GROUP BY term, nd),
dm AS (SELECT doc_id, 100 - 75 + (75 * n * nd) // l AS m FROM dn, s),
q AS (SELECT item_id, term, count(*) AS c FROM (
        SELECT item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM benchmark) GROUP BY ALL),
sc AS (SELECT item_id, doc_id, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
       FROM q JOIN tf USING (term) JOIN w USING (term) JOIN dm USING (doc_id) GROUP BY ALL)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM sc WHERE score > 0) WHERE rank <= {lexical_search.TOP}
"""

QUERIES: dict[str, Runner] = {
    "op1_url_filter": op1_url_filter,
    "op2_nn_descent": op2_nn_descent,
    "op3_chat_format": op3_chat_format,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_order_minhash": op5_order_minhash,
    "op6_bpe_stream": op6_bpe_stream,
    "op7_language_id": op7_language_id,
    "pages_language_id": pages_language_id,
    "op8_license_scan": op8_license_scan,
    "op9_packing": op9_packing,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_token_count": op11_token_count,
    "op12_token_align": op12_token_align,
    "op13_lexical_search": op13_lexical_search,
}
ORACLE: dict[str, str] = {
    "op1_url_filter": OP1_SQL,
    "op3_chat_format": OP3_SQL,
    "op8_license_scan": OP8_SQL,
    "op13_lexical_search": OP13_SQL,
}
