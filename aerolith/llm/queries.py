"""The contract queries: each applies its operator to a whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm.common import read_table
from aerolith.llm.decontamination import contamination
from aerolith.llm.embeddings import near_vectors
from aerolith.llm.fingerprints import paired_fingerprints
from aerolith.llm.html_text import extract_text
from aerolith.llm.language import identify_language
from aerolith.llm.line_dedup import dedup_lines
from aerolith.llm.lm_scoring import score_documents
from aerolith.llm.merkle import verified_manifest
from aerolith.llm.ngram_join import near_duplicate_groups
from aerolith.llm.packing import pack_documents
from aerolith.llm.quality import score_quality
from aerolith.llm.sharding import shard_documents
from aerolith.llm.spelling import spelling_variants

Query = Callable[[SparkSession, str], DataFrame]


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_language(read_table(spark, sf_dir, "documents"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_groups(read_table(spark, sf_dir, "documents"), k=4, percent=85).select("doc_id", "n_shingles", "component_id")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_documents(read_table(spark, sf_dir, "documents"), shards=8)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read_table(spark, sf_dir, "pages"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target is made of the documents that are labelled good and not toxic."""
    return score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels").where("quality = 1 and toxic = 0"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(read_table(spark, sf_dir, "documents"))


def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paired_fingerprints(read_table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(read_table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verified_manifest(read_table(spark, sf_dir, "documents"))


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    found = {k: f for k, f in globals().items() if k.startswith("op") and k[2].isdigit()}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))


LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3_SQL = rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT item_id, w, least(10, len(w)) AS n FROM (SELECT item_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark) WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS t FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM items)),
places AS (SELECT rid, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS t FROM (SELECT rid, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
hits AS (SELECT rid, i, places.n AS n, item_id FROM places JOIN windows ON places.n = windows.n AND places.t = windows.t),
covered AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT rid, i, n FROM hits)) GROUP BY 1),
named AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (rid) LEFT JOIN named USING (rid)"""

OP4_SQL = rf"""
WITH RECURSIVE docs AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({LOWERED}, '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (SELECT DISTINCT rid, array_to_string(list_slice(w, i, i + 3), ' ') AS t FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM docs WHERE len(w) > 0)),
sizes AS (SELECT rid, count(*) AS n FROM shingles GROUP BY 1),
shared AS (SELECT a.rid AS a, b.rid AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.t = b.t AND a.rid < b.rid GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.rid = a JOIN sizes y ON y.rid = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT rid, rid AS o FROM docs UNION SELECT reach.rid, edges.b FROM reach JOIN edges ON edges.a = reach.o)
SELECT d.doc_id, coalesce(any_value(sizes.n), 0)::BIGINT AS n_shingles, min(o.doc_id) AS component_id
FROM docs d JOIN reach ON reach.rid = d.rid JOIN docs o ON o.rid = reach.o LEFT JOIN sizes ON sizes.rid = d.rid GROUP BY d.rid, d.doc_id"""


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR END"


def _crc32(text: str) -> str:
    """Unsigned crc32 of a text of codes below 256, a bit at a time: each byte enters with the first of its eight steps."""
    c, rest = f"unicode({text}[i])::BIGINT", "0, 0, 0, 0, 0, 0, 0"
    steps = f"flatten(list_transform(range(1, length({text}) + 1), lambda i: CASE WHEN {c} < 128 THEN [{c}, {rest}] ELSE [195, {rest}, {c} - 64, {rest}] END))"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {steps}), lambda a, b: xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1))), 4294967295)"


def _tree(name: str, first: str, depth: int, fanout: int = 16) -> str:
    """Levels of nodes (g, i, h) from `first`; a tree's last node goes up unchanged, its runs are `name`_r0, `name`_r1, ... (g, i, hs)."""
    parts, above = [], first
    for k in range(depth):
        parts.append(f"{name}_r{k} AS (SELECT g, i // {fanout} AS i, list(h ORDER BY i) AS hs, any_value(n) AS n FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM {above}) GROUP BY 1, 2)")
        parts.append(f"{name}_{k + 1} AS (SELECT g, i, CASE WHEN n = 1 THEN hs[1] ELSE sha256(array_to_string(hs, '')) END AS h FROM {name}_r{k})")
        above = f"{name}_{k + 1}"
    return ",\n".join(parts)


def _climb(name: str, first: str, fold: str, depth: int, fanout: int = 16) -> str:
    """From `first` (rid, g, i, proof and the digest `fold`) up the tree: siblings are appended and the digest is folded."""
    parts, below = [], first
    for k in range(depth):
        step = f"{fanout} ** {k}" if k else "1"
        at = f"((b.i // ({step})::BIGINT) % {fanout})"
        left, right = f"array_to_string(hs[:{at}], '')", f"array_to_string(hs[{at} + 2:], '')"
        parts.append(f"{fold}_{k + 1} AS (SELECT b.* EXCLUDE (proof, {fold}), b.proof || {left} || {right} AS proof, CASE WHEN r.n = 1 THEN b.{fold} ELSE sha256({left} || b.{fold} || {right}) END AS {fold} FROM {below} b JOIN {name}_r{k} r ON r.g = b.g AND r.i = b.i // ({fanout} * {step})::BIGINT)")
        below = f"{fold}_{k + 1}"
    return ",\n".join(parts)


#: Deep enough for 16 ** 5 rows of a source and 16 ** 3 sources.
OP12_SQL = f"""
WITH docs AS (SELECT doc_id, coalesce('g' || source, '') AS g, sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', 'n_chars', 'text')))}) AS leaf,
  CASE WHEN {_crc32('(doc_id::VARCHAR)')} % 5 = 0 THEN sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', 'n_chars', "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")))}) END AS changed FROM documents),
leaves AS (SELECT *, row_number() OVER () AS rid, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, leaf AS h FROM docs),
{_tree('t', '(SELECT g, i, h FROM leaves)', 5)},
subroots AS (SELECT g AS of, h AS subroot, 0 AS g, row_number() OVER (ORDER BY g) - 1 AS i, h FROM t_5),
{_tree('u', '(SELECT g, i, h FROM subroots)', 3)},
start AS (SELECT rid, doc_id, leaf, g, i, coalesce(changed, leaf) AS f, '' AS proof FROM leaves),
{_climb('t', 'start', 'f', 5)},
middle AS (SELECT f_5.rid, f_5.doc_id, f_5.leaf, s.subroot, s.g, s.i, f_5.f AS e, f_5.proof FROM f_5 JOIN subroots s ON s.of = f_5.g),
{_climb('u', 'middle', 'e', 3)}
SELECT doc_id, leaf, subroot, (SELECT h FROM u_3) AS root, sha256(proof) AS proof_sha256, e AS folded_root, e = (SELECT h FROM u_3) AS verified FROM e_3"""

OP11_SQL = rf"""
WITH RECURSIVE found AS (SELECT doc_id, unnest(regexp_extract_all({LOWERED}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
counted AS (SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS named, run, count(*) AS c FROM found WHERE length(run) >= 5 GROUP BY 1, 2),
hashed AS (SELECT run, c, {_crc32('named')} AS h FROM counted),
words AS (SELECT word, sum(c)::BIGINT AS n FROM (SELECT CASE WHEN h % 97 = 0 THEN run[:(h % length(run))::INT] || run[(h % length(run))::INT + 2:] ELSE run END AS word, c FROM hashed) WHERE length(word) >= 5 GROUP BY 1 HAVING sum(c) >= 3),
cut AS (SELECT word, i, word[:i] || word[i + 2:] AS r FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
near AS (SELECT a.word, b.word AS other FROM cut a JOIN cut b ON a.r = b.r AND a.i = b.i AND a.word != b.word UNION SELECT word, r FROM cut JOIN (SELECT word AS r FROM words) USING (r) UNION SELECT r, word FROM cut JOIN (SELECT word AS r FROM words) USING (r)),
best AS (SELECT near.word, count(*) AS n_near, list(struct_pack(m := -o.n, w := near.other) ORDER BY -o.n, near.other)[1] AS b FROM near JOIN words o ON o.word = near.other GROUP BY 1),
forms AS (SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.m >= 2 * n THEN b.w END AS form, CASE WHEN -b.m >= 2 * n THEN -b.m END AS form_n FROM words LEFT JOIN best USING (word)),
path AS (SELECT word, word AS here, 0 AS k FROM forms UNION ALL SELECT path.word, forms.form, k + 1 FROM path JOIN forms ON forms.word = path.here WHERE forms.form IS NOT NULL),
roots AS (SELECT word, arg_max(here, k) AS root FROM path GROUP BY 1)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)"""

OP13_SQL = """
WITH RECURSIVE rows AS (SELECT row_number() OVER () AS rid, * FROM embeddings),
good AS (SELECT rid, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM rows WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x != 0)) > 0),
links AS (SELECT a.rid AS a, b.rid AS b FROM good a JOIN good b ON a.label = b.label AND a.rid != b.rid AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (SELECT rid, rid AS o FROM rows UNION SELECT reach.rid, links.b FROM reach JOIN links ON links.a = reach.o),
least AS (SELECT reach.rid, min(o.vec_id) AS component_id FROM reach JOIN rows o ON o.rid = reach.o GROUP BY 1)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = rows.rid) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept FROM rows JOIN least USING (rid)"""


def oracle_sql() -> dict[str, str]:
    """The queries that SQL can express; the others are held against plain Python, round trips or held-out rows in tests."""
    return {"op3_benchmark_decontamination": OP3_SQL, "op4_ngram_jaccard_join": OP4_SQL, "op11_spelling_variants": OP11_SQL, "op12_merkle_manifest": OP12_SQL, "op13_embedding_near_dedup": OP13_SQL}
