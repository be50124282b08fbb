"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsieve.llm import (
    best_fit,
    bloom_cascade,
    cgk_decontam,
    conversation_repair,
    conversation_sql,
    divide_skip,
    lexical_search,
    license_scan,
    line_dedup,
    piecewise_hash,
    quality_mil,
    rp_forest,
    token_orc,
    warc_index,
)
from rowsieve.llm.common import read, scratch


def _tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents; a fifth of the ids by checksum is held out of training."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").where(fold != 0).select("doc_id", F.col("quality").alias("label"))
    scored = quality_mil.score(docs, quality_mil.train(docs, labels))
    held_out = F.coalesce(fold == 0, F.lit(False)).alias("held_out")
    predicted = (F.col("score") >= quality_mil.THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", held_out, "score", predicted)


def op2_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written to ORC and read back."""
    folder = scratch(spark, "tokens")
    token_orc.write_tokens(read(spark, sf_dir, "documents"), folder, _tokenizer(), end_id=1)
    return token_orc.checksums(token_orc.read_tokens(spark, folder))


def op3_rp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all vectors at a cosine of 0.9 or more, whatever their labels."""
    return rp_forest.near_vectors(read(spark, sf_dir, "embeddings"), 0.9)


OP3_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
n AS (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS len FROM v
  WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
link AS (SELECT a.vec_id AS x, b.vec_id AS y FROM n a JOIN n b ON a.vec_id <> b.vec_id AND a.len > 0 AND b.len > 0
  WHERE list_inner_product(a.e, b.e) / (a.len * b.len) >= 0.9),
reach(x, y) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x),
comp AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
num AS (SELECT x, count(*) AS n FROM link GROUP BY x)
SELECT v.vec_id, coalesce(num.n, 0) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN comp c ON c.x = v.vec_id LEFT JOIN num ON num.x = v.vec_id
"""


def op4_cgk_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that a document holds up to a tenth of its words, for all
    documents and items."""
    return cgk_decontam.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


# The rules of the URL filter.
URL_RULES = {
    "org/": "allow",
    "example.org/es/": "block",
    "example.org/en/1": "block",
    "com/fr/": "allow",
    "com/de/": "block",
}
# A host with one of these labels is on the block list.
BLOCKED_LABELS = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")


def op5_bloom_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages judged by rules and, without one, by a block list of hosts.

    The list holds every host of the table that has a blocked label.
    """
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    hosts = pages.select(bloom_cascade.host_path(F.col("url"))[0].alias("host"))
    labels = F.array(*[F.lit(x) for x in BLOCKED_LABELS])
    blocked = hosts.where(F.arrays_overlap(F.split("host", "\\.", -1), labels))
    return bloom_cascade.judge(pages, URL_RULES, blocked).drop("url")


_HOST_SQL = "translate(CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*') ELSE '' END, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_RULES_SQL = ", ".join(
    f"('{r.partition('/')[0]}', '/{r.partition('/')[2]}', '{r}', '{v}')" for r, v in URL_RULES.items()
)
OP5_SQL = f"""
WITH p AS (
  SELECT page_id, url, {_HOST_SQL} AS host,
    CASE WHEN strpos(url, '://') > 0
      THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
r(h, p, rule, verdict) AS (VALUES {_RULES_SQL}),
best AS (
  SELECT page_id, url, r.rule, r.verdict,
    row_number() OVER (PARTITION BY page_id, url ORDER BY length(r.rule) DESC, r.rule) AS n
  FROM p JOIN r ON (p.host = r.h OR ends_with(p.host, '.' || r.h)) AND starts_with(p.path, r.p))
SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.verdict,
  CASE WHEN list_has_any(string_split(p.host, '.'), [{", ".join(f"'{x}'" for x in BLOCKED_LABELS)}])
  THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN (SELECT * FROM best WHERE n = 1) b ON p.page_id = b.page_id AND p.url = b.url
"""


def op6_jaccard_divide_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents by links of 0.85 or more on runs of four words."""
    rule = divide_skip.Rule(words=4, numerator=85, denominator=100)
    return divide_skip.jaccard_components(read(spark, sf_dir, "documents"), rule)


def op7_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back by way of their index."""
    folder = scratch(spark, "warc")
    warc_index.write_archive(read(spark, sf_dir, "pages"), folder)
    return warc_index.read_archive(spark, folder).drop("url", "payload")


OP6_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE
    WHEN len(w) >= 4 THEN [array_to_string(w[i:i + 3], ' ') for i in range(1, len(w) - 2)]
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
p AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
link AS (SELECT a.doc_id AS x, b.doc_id AS y FROM p a JOIN p b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach(x, y) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x),
c AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT s.doc_id, len(s.s) AS n_shingles, c.component_id FROM s JOIN c ON c.x = s.doc_id
"""


# Five hexadecimal digits are four digits of base 32.
_BASE32_SQL = """array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(
    (cast('0x' || substr(sha, cast(1 + 5 * (i // 4) as bigint), 5) as bigint) >> cast(15 - 5 * (i % 4) as bigint)) & 31
    as bigint) + 1, 1) for i in range(0, 32)], '')"""
OP7_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS sha FROM p),
d AS (SELECT page_id, payload_bytes, {_BASE32_SQL} AS payload_digest FROM h),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to FROM g
"""


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents, as files ``source/lang/thousand/doc_id``."""
    docs = read(spark, sf_dir, "documents")
    thousand = F.floor(F.col("doc_id") / 1000).cast("string")
    path = F.concat_ws("/", "source", "lang", thousand, F.col("doc_id").cast("string"))
    files = docs.select("doc_id", path.alias("path"), "text")
    return license_scan.scan(files).drop("text")


_WORDS_SQL = "regexp_extract_all(lower({}), '[a-z0-9]+(?:[.][0-9]+)*')"
def _templates_sql(texts: dict[str, str]) -> str:
    return ", ".join(f"('{n}', '{t}', {-i})" for i, (n, t) in enumerate(sorted(texts.items())))


def _parts_sql(names: str) -> str:
    """Normed weights ``licence, w, part`` of the templates in a table."""
    return f"""(SELECT licence, w, x / sqrt(sum(x * x) OVER (PARTITION BY licence)) AS part FROM (
      SELECT t.licence, t.w, t.tf * coalesce(idf.idf, (SELECT ln(1 + count(*)) + 1 FROM f)) AS x FROM (
        SELECT licence, w, count(*) AS tf FROM (SELECT licence, unnest({_WORDS_SQL.format('template')}) AS w FROM {names}) GROUP BY ALL) t
      LEFT JOIN idf ON idf.w = t.w))"""


def _cosine_sql(units: str, names: str, parts: str) -> str:
    """Best template of each unit ``(u, text)`` as ``u, score, rank, licence``."""
    return f"""(
  SELECT u, max(struct_pack(score := score, rank := rank, licence := licence)) AS best FROM (
    SELECT c.u, n.rank, n.licence, round(coalesce(sum(c.x * t.part), 0) / sqrt(sum(c.x * c.x)), 6) AS score
    FROM (SELECT u, k.w, k.tf * idf.idf AS x FROM (
      SELECT u, w, count(*) AS tf FROM (SELECT u, unnest({_WORDS_SQL.format('text')}) AS w FROM {units}) GROUP BY ALL) k
      JOIN idf ON idf.w = k.w) c
    CROSS JOIN {names} n LEFT JOIN {parts} t ON t.w = c.w AND t.licence = n.licence
    GROUP BY c.u, n.rank, n.licence) GROUP BY u)"""


# No document is named like a licence file, so full texts alone license a directory.
OP8_SQL = f"""
WITH notices(licence, template, rank) AS (VALUES {_templates_sql(license_scan.NOTICES)}),
texts(licence, template, rank) AS (VALUES {_templates_sql(license_scan.TEXTS)}),
f AS (SELECT doc_id, concat_ws('/', source, lang, cast(doc_id // 1000 as varchar), cast(doc_id as varchar)) AS path,
  concat_ws('/', source, lang, cast(doc_id // 1000 as varchar)) AS dir, text FROM documents),
dw AS (SELECT w, count(*) AS df FROM (SELECT DISTINCT doc_id, unnest({_WORDS_SQL.format('text')}) AS w FROM f) GROUP BY w),
idf AS (SELECT w, ln((1 + (SELECT count(*) FROM f)) / (1 + df)) + 1 AS idf FROM dw),
notice_parts AS {_parts_sql('notices')},
text_parts AS {_parts_sql('texts')},
line AS (SELECT struct_pack(d := doc_id, l := l) AS u, string_split(text, chr(10))[l] AS text
  FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS l FROM f)
  WHERE regexp_matches(lower(string_split(text, chr(10))[l]), '{'|'.join(sorted({w for t in license_scan.NOTICES.values() for w in t.lower().rstrip('.').replace(',', '').replace('-', ' ').split()}))}')),
doc AS (SELECT doc_id AS u, text FROM f),
header AS (SELECT u.d AS doc_id, max(struct_pack(score := best.score, first := -u.l, licence := best.licence)) AS h
  FROM {_cosine_sql('line', 'notices', 'notice_parts')} WHERE best.score >= {license_scan.HEADER} GROUP BY u.d),
whole AS (SELECT u AS doc_id, best.score AS score, best.licence AS licence
  FROM {_cosine_sql('doc', 'texts', 'text_parts')} WHERE best.score >= {license_scan.FILE}),
placed AS (SELECT f.dir, min(struct_pack(worse := -w.score, path := f.path, licence := w.licence)) AS b
  FROM whole w JOIN f ON f.doc_id = w.doc_id GROUP BY f.dir)
SELECT f.doc_id, f.path, coalesce(w.licence, h.licence, b.licence) AS licence,
  CASE WHEN w.licence IS NOT NULL THEN 'text' WHEN h.licence IS NOT NULL THEN 'header' ELSE p.dir END AS licence_source,
  coalesce(w.score, h.score, -b.worse) AS score
FROM f LEFT JOIN header ON header.doc_id = f.doc_id LEFT JOIN whole w ON w.doc_id = f.doc_id
LEFT JOIN placed p ON f.dir = p.dir
"""


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' pieces of at most 2048 tokens, packed into sequences."""
    pieces = best_fit.token_pieces(read(spark, sf_dir, "documents"), _tokenizer(), end_id=0, capacity=2048)
    return best_fit.pack(pieces, 2048)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without lines that an earlier line equals or, from ten words on,
    matches up to one word."""
    kept = line_dedup.dedup_lines(read(spark, sf_dir, "documents"), exact_words=1)
    return kept.select(
        "doc_id",
        F.col("removed_lines").cast("long").alias("removed_lines"),
        F.length("text").cast("long").alias("kept_chars"),
        F.md5(F.col("text").cast("binary")).alias("kept_md5"),
    )


OP10_SQL = r"""
WITH x AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
e AS (SELECT doc_id, l - 1 AS l, list_filter(regexp_split_to_array(
    translate(ls[l], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda y: y <> '') AS w
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS l FROM x)),
t AS (SELECT doc_id, l, w, array_to_string(w, ' ') AS t FROM e WHERE len(w) >= 1),
d AS (SELECT t, any_value(w) AS w, len(any_value(w)) AS n, min(struct_pack(d := doc_id, l := l)) AS pl FROM t GROUP BY t),
m AS (SELECT * FROM d WHERE n >= 10),
v AS (SELECT t, n, pl, i, array_to_string(w[1:i - 1] || w[i + 1:], ' ') AS v
  FROM (SELECT t, w, n, pl, unnest(range(1, n + 1)) AS i FROM m)),
f AS (SELECT v, n, i, min(pl) AS first FROM v GROUP BY v, n, i),
near AS (SELECT v.t FROM v JOIN f ON v.v = f.v AND v.n = f.n AND v.i = f.i WHERE f.first < v.pl
  UNION SELECT v.t FROM v JOIN m AS d ON v.v = d.t WHERE d.pl < v.pl
  UNION SELECT d.t FROM v JOIN m AS d ON v.v = d.t WHERE v.pl < d.pl),
gone AS (SELECT t.doc_id, list(t.l) AS ls FROM t JOIN d ON t.t = d.t
  WHERE struct_pack(d := t.doc_id, l := t.l) <> d.pl OR t.t IN (SELECT t FROM near) GROUP BY t.doc_id),
k AS (SELECT x.doc_id, coalesce(len(g.ls), 0) AS removed_lines,
    array_to_string([y for y, i in x.ls if not list_contains(coalesce(g.ls, []), i - 1)], chr(10)) AS text
  FROM x LEFT JOIN gone g ON g.doc_id = x.doc_id)
SELECT doc_id, removed_lines, length(text) AS kept_chars, md5(text) AS kept_md5 FROM k
"""


def op11_norm_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty best documents, of all, for each benchmark item."""
    return lexical_search.rank(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


_TERMS_SQL = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP11_SQL = f"""
WITH t AS (SELECT doc_id, {_TERMS_SQL} AS ts FROM documents WHERE text IS NOT NULL),
s AS (SELECT count(*) AS docs, sum(len(ts)) AS words FROM t WHERE len(ts) > 0),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS_SQL}) AS term FROM benchmark) GROUP BY ALL),
d AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(ts) AS n, unnest(ts) AS term FROM t)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, cast(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM d, s GROUP BY term),
x AS (SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // words)))) AS score
  FROM q JOIN w USING (term) JOIN d USING (term) CROSS JOIN s GROUP BY item_id, doc_id),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM x WHERE score > 0)
SELECT item_id, cast(rank AS INTEGER) AS rank, doc_id, cast(score AS BIGINT) AS score FROM r WHERE rank <= 20
"""


def op12_piecewise_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their texts edited by the next document."""
    return piecewise_hash.compare_in_order(read(spark, sf_dir, "documents"))


def op13_branch_and_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations damaged and repaired; those without a row left have nothing to do."""
    rows = read(spark, sf_dir, "conversations")
    found = conversation_repair.report(conversation_repair.repair(conversation_repair.damaged(rows)))
    every = rows.select(F.col("conv_id").cast("long")).distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    found = every.alias("e").join(found.alias("f"), F.col("e.conv_id").eqNullSafe(F.col("f.conv_id")), "left")
    return found.select(
        "e.conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


QUERIES = {
    "op1_quality_mil": op1_quality_mil,
    "op2_token_orc": op2_token_orc,
    "op3_rp_forest": op3_rp_forest,
    "op4_cgk_decontam": op4_cgk_decontam,
    "op5_bloom_cascade": op5_bloom_cascade,
    "op6_jaccard_divide_skip": op6_jaccard_divide_skip,
    "op7_warc_index": op7_warc_index,
    "op8_license_scan": op8_license_scan,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_line_dedup": op10_line_dedup,
    "op11_norm_buckets": op11_norm_buckets,
    "op12_piecewise_hash": op12_piecewise_hash,
    "op13_branch_and_bound": op13_branch_and_bound,
}
ORACLES: dict[str, str] = {
    "op3_rp_forest": OP3_SQL,
    "op5_bloom_cascade": OP5_SQL,
    "op6_jaccard_divide_skip": OP6_SQL,
    "op7_warc_index": OP7_SQL,
    "op8_license_scan": OP8_SQL,
    "op10_line_dedup": OP10_SQL,
    "op11_norm_buckets": OP11_SQL,
    "op13_branch_and_bound": conversation_sql.REPAIR_SQL,
}
