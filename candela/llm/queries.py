"""Thin queries over the operators of this subpackage, with DuckDB SQL where SQL can state them."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.llm.bpe import round_trip
from candela.llm.decontaminate import find_contamination
from candela.llm import conversations, langid, licenses, merkle, quality_rules, topk, toxicity
from candela.llm.simhash import near_duplicates
from candela.llm.substring_dedup import substring_dedup
from candela.llm.url_rules import judge
from candela.llm.warc import page_of, read_warc, write_warc

TOKENIZER = os.environ.get("CANDELA_TOKENIZER") or public_tokenizers.path("word_bpe_49k.json")

WORD = r"[^ \t\n\x0B\f\r]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document less those in 13-word windows that start in a document of smaller id."""
    return substring_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


OP1_SQL = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k FROM w, unnest(range(1, len(ws) - 11)) AS t(i) WHERE len(ws) >= 13),
f AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT win.doc_id, unnest(range(i, i + 13)) AS p FROM win JOIN f USING (k) WHERE m < win.doc_id)),
words AS (SELECT doc_id, p, ws[p] AS x FROM w, unnest(range(1, len(ws) + 1)) AS t(p)),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS s FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(s, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id
"""

def held_out(doc_id, folds: int, fold: int):
    """Is the row kept from learning: crc32 of its id as text modulo ``folds`` is ``fold``. A null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def toxicity_fold(doc_id):
    return ~held_out(doc_id, 4, 2)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by the recurrent network, learnt from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    weights = toxicity.fit(docs, table(spark, sf_dir, "labels"), learn=toxicity_fold)
    return toxicity.score(docs, weights).select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", "predicted")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by the sparse logistic regression, learnt from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, learn=lambda i: ~held_out(i, 3, 1))
    return langid.predict(docs, model).select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "lang_pred", "score")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of three-word shingles and component of fingerprints within two bits, for every document."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


# fixed values: the rules the task states (host, path, verdict)
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
             ("com", "/de/", "block")]


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, longest fitting rule and verdict of every page's url; allowed where no rule fits."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge(table(spark, sf_dir, "pages"), rules, default="allow")


OP5_SQL = """
WITH r(rh, rp, v) AS (VALUES """ + ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES) + """),
a AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS h0 FROM a),
p AS (SELECT page_id, translate(h0, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(h0) + 1), '^[^?#]*') AS path FROM h),
m AS (SELECT p.*, rh || rp AS rule, v, row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rh || rp) DESC NULLS LAST, length(rh) DESC, v DESC) AS k
      FROM p LEFT JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM m WHERE k = 1
"""


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every document and whether the base rules and the learnt decision list keep it."""
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                         (~failed & F.col("good")).alias("kept"), F.col("rule"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document under the public tokenizer, as digests."""
    return round_trip(table(spark, sf_dir, "documents"), TOKENIZER)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every document: best one, its coverage, and all found with their places."""
    return licenses.scan(table(spark, sf_dir, "documents")).select("doc_id", "license", "coverage", F.to_json("matches").alias("matches"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document words inside any occurrence of a 10-word window of a benchmark item."""
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), with_ids=False)


OP9_SQL = """
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
t AS (SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS k
      FROM b, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS u(i) WHERE len(ws) > 0),
sizes AS (SELECT DISTINCT n FROM t),
win AS (SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS k FROM d, sizes, unnest(range(1, len(ws) - n + 2)) AS u(i) WHERE len(ws) >= n),
m AS (SELECT doc_id, i, win.n, item_id FROM win JOIN t ON win.k = t.k AND win.n = t.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC archives and read back by byte ranges."""
    records = read_warc(write_warc(table(spark, sf_dir, "pages")), payloads=False)
    return records.select(page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                          page_of(F.col("refers_to")).alias("refers_to"))


OP10_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS m FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> m THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> m THEN m END AS refers_to
FROM f
"""

# the byte-wise table of CRC-32, from its polynomial, and the checksum of the decimal text s
CRC_TABLE = """crc AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)) ORDER BY i) AS tab
        FROM range(256) r(i))"""


def crc32_sql(s: str) -> str:
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split({s}, ''), lambda x: CAST(ascii(x) AS BIGINT))), "
            "lambda c, b: xor(c >> 8, tab[1 + (xor(c, b) & 255)])))")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and the root that its tampered leaf leads to."""
    rows = merkle.manifest(merkle.document_leaves(table(spark, sf_dir, "documents")))
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("proof", ""), 256).alias("proof_sha256"), "folded_root",
                       (F.col("folded_root") == F.col("root")).alias("verified"))


def _leaf_sql(text: str) -> str:
    fields = ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)
    return "sha256(" + " || ".join(f"coalesce(strlen({x}) || ':' || {x}, '-')" for x in fields) + ")"


OP11_SQL = f"""
WITH RECURSIVE {CRC_TABLE},
d AS (SELECT doc_id, coalesce('+' || lang, '') AS g, {_leaf_sql("text")} AS leaf,
             CASE WHEN {crc32_sql("CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN {_leaf_sql(f"translate(text, '{merkle.UPPER}', '{merkle.LOWER}')")} END AS changed
      FROM documents, crc),
l AS (SELECT *, row_number() OVER () AS rid, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM d),
node(g, lvl, pos, n, h) AS (SELECT g, 0, pos, n, leaf FROM l
  UNION ALL SELECT g, lvl + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM node WHERE n > 1 GROUP BY g, lvl, pos // 8, n),
sub AS (SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM node WHERE n = 1),
top(lvl, pos, n, h) AS (SELECT 0, pos, n, subroot FROM sub
  UNION ALL SELECT lvl + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY lvl, pos // 8, n),
inner_proof AS (SELECT rid, string_agg(h, '' ORDER BY lvl, node.pos) AS p FROM l JOIN node ON l.g = node.g AND node.n > 1
                AND node.pos // 8 = l.pos >> (3 * lvl + 3) AND node.pos <> l.pos >> (3 * lvl) GROUP BY rid),
outer_proof AS (SELECT sub.g, string_agg(h, '' ORDER BY lvl, top.pos) AS p FROM sub JOIN top ON top.n > 1
                AND top.pos // 8 = sub.pos >> (3 * lvl + 3) AND top.pos <> sub.pos >> (3 * lvl) GROUP BY sub.g),
fold(rid, g, i, lvl, h) AS (SELECT rid, g, pos, 0, coalesce(changed, leaf) FROM l
  UNION ALL SELECT rid, fold.g, i // 8, fold.lvl + 1, sha256(string_agg(CASE WHEN node.pos = i THEN fold.h ELSE node.h END, '' ORDER BY node.pos))
  FROM fold JOIN node ON fold.g = node.g AND fold.lvl = node.lvl AND node.n > 1 AND node.pos // 8 = i // 8 GROUP BY rid, fold.g, i, fold.lvl),
mid AS (SELECT rid, g, arg_max(h, lvl) AS h FROM fold GROUP BY rid, g),
fold2(rid, i, lvl, h) AS (SELECT rid, pos, 0, h FROM mid JOIN sub USING (g)
  UNION ALL SELECT rid, i // 8, fold2.lvl + 1, sha256(string_agg(CASE WHEN top.pos = i THEN fold2.h ELSE top.h END, '' ORDER BY top.pos))
  FROM fold2 JOIN top ON fold2.lvl = top.lvl AND top.n > 1 AND top.pos // 8 = i // 8 GROUP BY rid, i, fold2.lvl),
folded AS (SELECT rid, arg_max(h, lvl) AS folded_root FROM fold2 GROUP BY rid)
SELECT doc_id, leaf, subroot, (SELECT h FROM top WHERE n = 1) AS root, sha256(coalesce(inner_proof.p, '') || coalesce(outer_proof.p, '')) AS proof_sha256,
       folded_root, folded_root = (SELECT h FROM top WHERE n = 1) AS verified
FROM l JOIN sub USING (g) JOIN folded USING (rid) LEFT JOIN inner_proof USING (rid) LEFT JOIN outer_proof ON outer_proof.g = l.g
"""


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every damaged conversation and the cheapest edits that give it a right order of roles."""
    return conversations.repair(conversations.damaged(table(spark, sf_dir, "conversations")), present="present")


_SOLID = r"[^\x20\x09-\x0D]"
_STATES = "abcd"  # nothing yet, after s, after u, after a


def _edits_sql(state: int) -> str:
    """Cheapest way to use up the row in a state: (cost, letters), over the four ways to go on behind it."""
    def way(cost: str, letter: str, to: int, when: str) -> str:
        to = _STATES[to]
        return f"CASE WHEN {when} THEN {{'c': {to}.c + {cost}, 's': '{letter}' || {to}.s}} ELSE {{'c': 1000000000000, 's': ''}} END"
    stays = [way("4", "D", state, "true"), way("3 + 3 * cut", "R", conversations.INSERT[state], "must = 0")]
    stays += [way("3 * cut", "K", to, f"must = 0 AND i = '{kind}'") for kind, to in conversations.KEEP[state].items()]
    return f"least({', '.join(stays)})"


def _inserts_sql(state: str, to: str, more: str = "") -> str:
    return f"least({state}, {{'c': {to}.c + 3, 's': 'I' || {to}.s}}" + (f", {{'c': {more}.c + 6, 's': 'II' || {more}.s}})" if more else ")")


OP12_SQL = f"""
WITH RECURSIVE {CRC_TABLE},
src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               {crc32_sql("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind FROM conversations, crc),
hurt AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
         FROM src, unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) WHERE kind <> 0),
put AS (SELECT *, coalesce(CAST(conv_id AS VARCHAR), '') AS g, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, left(text, 64), sha256(text)) AS rn,
               count(*) OVER (PARTITION BY conv_id) AS n FROM hurt),
seen AS (SELECT *, row_number() OVER (PARTITION BY g, role, text ORDER BY rn) > 1 AS again, NOT regexp_matches(text, '{_SOLID}') AS blank,
                left(role, 1) AS i, lag(left(role, 1)) OVER (PARTITION BY g ORDER BY rn) AS before FROM put),
r AS (SELECT *, CASE WHEN blank OR again THEN 1 ELSE 0 END AS must,
             CASE WHEN NOT blank AND NOT again AND NOT regexp_matches(regexp_extract(text, '({_SOLID})[\x20\x09-\x0D]*$', 1), '[.!?]') THEN 1 ELSE 0 END AS cut FROM seen),
v(g, rn, a, b, c, d) AS (SELECT DISTINCT g, n + 1, {{'c': 0::BIGINT, 's': ''}}, {{'c': 6::BIGINT, 's': 'II'}}, {{'c': 3::BIGINT, 's': 'I'}}, {{'c': 0::BIGINT, 's': ''}} FROM r
  UNION ALL SELECT g, rn, {_inserts_sql("wa", "wc", "wd")}, {_inserts_sql("wb", "wc", "wd")}, {_inserts_sql("wc", "wd")}, {_inserts_sql("wd", "wc")}
  FROM (SELECT r.g, r.rn, {_edits_sql(0)} AS wa, {_edits_sql(1)} AS wb, {_edits_sql(2)} AS wc, {_edits_sql(3)} AS wd FROM v JOIN r ON r.g = v.g AND r.rn = v.rn - 1)),
best AS (SELECT g, a.c AS cost, a.s AS audit FROM v WHERE rn = 1),
edit AS (SELECT g, e, k, count(*) FILTER (e <> 'I') OVER (PARTITION BY g ORDER BY k) AS rn, count(*) FILTER (e <> 'D') OVER (PARTITION BY g ORDER BY k) AS p,
                count(*) FILTER (e <> 'D') OVER (PARTITION BY g) % 2 AS odd
         FROM (SELECT g, audit[k] AS e, k FROM best, unnest(range(1, length(audit) + 1)) t(k))),
fixed AS (SELECT edit.g, string_agg(CASE WHEN e = 'K' THEN role WHEN (p - odd) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY k) AS t
          FROM edit LEFT JOIN r ON r.g = edit.g AND r.rn = edit.rn WHERE e <> 'D' GROUP BY edit.g),
fig AS (SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
               sum(cut) AS truncated, count(*) FILTER (before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY g)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
       CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(CAST(conv_id AS VARCHAR), '') AS g FROM conversations) o LEFT JOIN fig USING (g) LEFT JOIN best USING (g) LEFT JOIN fixed USING (g)
"""


def op13_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best inner products of every vector whose id 100 divides, against all vectors."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), "id % 100 = 0", k=10)


OP13_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
      FROM (SELECT * FROM v WHERE vec_id % 100 = 0) q JOIN v c ON c.vec_id IS DISTINCT FROM q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id NULLS LAST) AS k FROM s)
SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score FROM r WHERE k <= 10
"""

QUERIES = {
    "op1_substring_dedup": (op1_substring_dedup, OP1_SQL),
    "op2_toxicity": (op2_toxicity, None),
    "op3_language_id": (op3_language_id, None),
    "op4_simhash": (op4_simhash, None),
    "op5_url_rules": (op5_url_rules, OP5_SQL),
    "op6_quality_rules": (op6_quality_rules, None),
    "op7_bpe": (op7_bpe, None),
    "op8_license_scan": (op8_license_scan, None),
    "op9_decontamination": (op9_decontamination, OP9_SQL),
    "op10_warc": (op10_warc, OP10_SQL),
    "op11_merkle": (op11_merkle, OP11_SQL),
    "op12_conversation_repair": (op12_conversation_repair, OP12_SQL),
    "op13_top_k": (op13_top_k, OP13_SQL),
}
