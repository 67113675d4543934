"""The registered queries of the corpus operators, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, exact_dedup, hard_negatives, html_text, langid, license_scan, line_dedup, merkle, near_dedup, norm_search, packing, url_filter
from .common import table

# Vocabulary file of the queries; it lies at the same path on every machine.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_topk_products(spark: SparkSession, sf: str) -> DataFrame:
    """The 20 largest whole-number products of every twentieth vector."""
    whole = F.transform("embedding", lambda x: F.floor(F.lit(64) * x.cast("double")).cast("double"))
    vectors = table(spark, sf, "embeddings").filter(norm_search.finite(F.col("embedding"))).select("vec_id", whole.alias("v"))
    return norm_search.top_products(vectors, F.col("vec_id") % 20 == 0, 20)


ORACLE["op2_topk_products"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 20
"""

URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


@query
def op7_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Every page's URL judged by the given rules, else by the mined ones."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    return url_filter.judge(pages, "url", URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query
def op5_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Digests of every document's tokens and of the text decoded from them."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    coded = bpe.decode(bpe.encode(docs, VOCABULARY), VOCABULARY)
    listed = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op8_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Components of documents that share four fifths of their four-word shingles."""
    groups = near_dedup.near_groups(table(spark, sf, "documents"), words=4, percent=80)
    return groups.select("doc_id", "n_shingles", "component_id", "kept")


ORACLE["op8_near_dedup"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, shingle FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS shingle FROM w)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM met JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * m >= 80 * (x.n + y.n - m)),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
"""


@query
def op9_packing(spark: SparkSession, sf: str) -> DataFrame:
    """All documents in sequences of 1024 tokens, piece by piece."""
    pieces = packing.pack(table(spark, sf, "documents"), VOCABULARY, 1024)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


@query
def op4_language(spark: SparkSession, sf: str) -> DataFrame:
    """The language of every document, learned from three quarters of the labelled ones."""
    docs = table(spark, sf, "documents")
    model = langid.fit(docs, ~langid.held_out())
    asked = docs.select("doc_id", langid.held_out().alias("held_out"), "text")
    return langid.predict(asked, model).select("doc_id", "held_out", "lang_pred", "score")


@query
def op1_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every document less its runs of lines that stand earlier, with the number of lines deleted."""
    kept = line_dedup.dedup_lines(table(spark, sf, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "text", F.col("n_dropped").cast("bigint").alias("n_dropped"))


@query
def op6_main_text(spark: SparkSession, sf: str) -> DataFrame:
    """The main text of every page."""
    found = html_text.extract(table(spark, sf, "pages").select("page_id", "url", "html"), out="text")
    return found.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


@query
def op3_nearest(spark: SparkSession, sf: str) -> DataFrame:
    """The 5 nearest vectors found for every fiftieth one."""
    return ann.nearest(table(spark, sf, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0, 5)


@query
def op10_licenses(spark: SparkSession, sf: str) -> DataFrame:
    """The licence of every document, its own or that of the nearest folder; folders are source, then hundreds of ids."""
    path = F.concat_ws("/", "source", F.floor(F.col("doc_id") / 100).cast("string"), F.col("doc_id").cast("string"))
    files = table(spark, sf, "documents").select("doc_id", path.alias("path"), "text")
    return license_scan.scan(files).select("doc_id", "license", F.round("score", 6).alias("score"), "origin", "origin_path")


_WORDS = "list_filter(string_split_regex(lower({}), '[^a-z0-9]+'), lambda x: x <> '')"
_TEMPLATES = ", ".join(f"('{name}', '{text}')" for name, text in license_scan.TEMPLATES.items())
# Every line is scored here, with or without a cue: cues only save work.
ORACLE["op10_licenses"] = f"""
WITH t(license, text) AS (VALUES {_TEMPLATES}),
tc AS (SELECT license, word, count(*) AS tf FROM (SELECT license, unnest({_WORDS.format("text")}) AS word FROM t) GROUP BY ALL),
idf AS (SELECT word, ln({1 + len(license_scan.TEMPLATES)}.0 / (1 + count(*))) + 1 AS idf FROM tc GROUP BY word),
weights AS (SELECT license, word, r / sqrt(sum(r * r) OVER (PARTITION BY license)) AS weight
  FROM (SELECT license, word, tf * idf AS r FROM tc JOIN idf USING (word))),
files AS (SELECT doc_id, source || '/' || (doc_id // 100)::VARCHAR || '/' || doc_id::VARCHAR AS path, text FROM documents),
lines AS (SELECT doc_id, pos, line, {_WORDS.format("line")} AS words FROM (
  SELECT doc_id, unnest(range(len(l))) AS pos, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM files))),
near AS (SELECT *, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS run
  FROM lines JOIN (SELECT list(word) AS known FROM idf) ON true
  WHERE 2 * len(list_filter(words, lambda x: list_contains(known, x))) >= greatest(len(words), 1)),
segments AS (
  SELECT doc_id, 'line' AS kind, pos, length(line) AS chars, words FROM lines
  UNION ALL SELECT doc_id, 'run', min(pos), length(string_agg(line, chr(10) ORDER BY pos)), flatten(list(words ORDER BY pos))
    FROM near GROUP BY doc_id, run HAVING count(*) > 1),
counted AS (SELECT doc_id, kind, pos, chars, word, count(*) AS tf FROM (SELECT doc_id, kind, pos, chars, unnest(words) AS word FROM segments) GROUP BY ALL),
valued AS (SELECT counted.*, tf * coalesce(idf, ln({1 + len(license_scan.TEMPLATES)}.0) + 1) AS raw FROM counted LEFT JOIN idf USING (word)),
sized AS (SELECT doc_id, kind, pos, chars, sqrt(sum(raw * raw)) AS size FROM valued GROUP BY ALL),
dots AS (SELECT doc_id, kind, pos, license, sum(raw * weight) AS dot FROM valued JOIN weights USING (word) GROUP BY ALL),
scored AS (SELECT *, round(dot / size, 9) AS score FROM dots JOIN sized USING (doc_id, kind, pos) WHERE round(dot / size, 9) >= {license_scan.THRESHOLD}),
own AS (SELECT doc_id, license, score FROM scored QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, license) = 1),
chars AS (SELECT doc_id, greatest(coalesce(sum(chars) FILTER (kind = 'line'), 0), coalesce(sum(chars) FILTER (kind = 'run'), 0)) AS licensed
  FROM (SELECT DISTINCT doc_id, kind, pos, chars FROM scored) GROUP BY doc_id),
holders AS (SELECT regexp_extract(path, '^(.*)/', 1) AS folder, license, score, path FROM files JOIN own USING (doc_id) JOIN chars USING (doc_id)
  WHERE licensed >= {license_scan.FILE_SHARE} * length(text)),
folders AS (SELECT * FROM holders QUALIFY row_number() OVER (PARTITION BY folder ORDER BY score DESC, path, license) = 1),
up AS (SELECT doc_id, f.license, f.score, f.path FROM files JOIN folders f ON files.path LIKE f.folder || '/%'
  WHERE doc_id NOT IN (SELECT doc_id FROM own) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length(f.folder) DESC) = 1)
SELECT doc_id, coalesce(own.license, up.license) AS license, round(coalesce(own.score, up.score), 6) AS score,
  CASE WHEN own.license IS NOT NULL THEN 'own' WHEN up.license IS NOT NULL THEN 'inherited' END AS origin,
  CASE WHEN own.license IS NOT NULL THEN files.path ELSE up.path END AS origin_path
FROM files LEFT JOIN own USING (doc_id) LEFT JOIN up USING (doc_id)
"""


@query
def op13_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with the one that stays of those equal without white space."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = exact_dedup.dedup(docs, columns=["doc_id"], digests=True)
    return found.withColumnRenamed("digest", "text_sha256").select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE["op13_exact_dedup"] = r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS chars, sha256(regexp_replace(coalesce(text, ''), '[ \t\n\x0B\f\r]', '', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  row_number() OVER w = 1 AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS LAST)
"""


LEAF = ["doc_id", "source", "lang", "n_chars", "text"]


@query
def op12_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's leaf, subroot, root and proof, and the root its tampered or original leaf leads to."""
    docs = table(spark, sf, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    held = F.when(tampered, merkle.leaf(["doc_id", "source", "lang", F.col("n_chars") + 1, "text"]))
    found = merkle.manifest(docs, LEAF, "lang", held=held)
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _leaf_sql(chars: str) -> str:
    values = ["doc_id", "source", "lang", chars, "text"]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}::VARCHAR)::VARCHAR || ':' || {v}::VARCHAR, '-')" for v in values) + ")"


# crc32 of the decimal digits, bit by bit; the trees level by level, for groups first, then for the subroots.
_CRC_SQL = """xor(4294967295, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
  lambda s, c: list_reduce(list_prepend(xor(s, c), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, i: xor(x >> 1, (x & 1) * 3988292384::UBIGINT))))"""


def _nodes_sql(name: str, leaves: str) -> str:
    return f"""{name}(tree, level, pos, h, n) AS (
  SELECT tree, 0, pos, h, n FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM {name} WHERE n > 1 GROUP BY tree, level, pos // 2, n
)"""


def _fold_sql(name: str, start: str, nodes: str) -> str:
    return f"""{name}(id, tree, level, pos, h, proof) AS (
  SELECT id, tree, 0, pos, h, proof FROM {start}
  UNION ALL
  SELECT f.id, f.tree, f.level + 1, f.pos // 2, sha256(string_agg(CASE WHEN t.pos = f.pos THEN f.h ELSE t.h END, '' ORDER BY t.pos)),
    f.proof || coalesce(string_agg(t.h, '' ORDER BY t.pos) FILTER (t.pos <> f.pos), '')
  FROM {name} f JOIN {nodes} t ON f.tree = t.tree AND f.level = t.level AND f.pos // 2 = t.pos // 2 AND t.n > 1
  GROUP BY f.id, f.tree, f.level, f.pos, f.proof
)"""


ORACLE["op12_merkle_manifest"] = f"""
WITH RECURSIVE rows_ AS (SELECT doc_id, coalesce('1' || lang, '0') AS tree, {_leaf_sql("n_chars")} AS leaf,
    CASE WHEN doc_id IS NOT NULL AND {_CRC_SQL} % 7 = 0 THEN {_leaf_sql("(n_chars + 1)")} ELSE {_leaf_sql("n_chars")} END AS held FROM documents),
leaves AS (SELECT *, row_number() OVER () AS id, leaf AS h, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS LAST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY tree) AS n FROM rows_),
{_nodes_sql("nodes", "leaves")},
subroots AS (SELECT tree AS name, h FROM nodes WHERE n = 1),
top_leaves AS (SELECT '' AS tree, name, h, row_number() OVER (ORDER BY encode(name)) - 1 AS pos, count(*) OVER () AS n FROM subroots),
{_nodes_sql("top_nodes", "top_leaves")},
claims AS (SELECT id, tree, pos, held AS h, '' AS proof FROM leaves),
{_fold_sql("folded", "claims", "nodes")},
top_claims AS (SELECT f.id, '' AS tree, t.pos, f.h, f.proof FROM folded f JOIN nodes s ON f.tree = s.tree AND f.level = s.level AND s.n = 1 JOIN top_leaves t ON t.name = f.tree),
{_fold_sql("top_folded", "top_claims", "top_nodes")},
root AS (SELECT level, h FROM top_nodes WHERE n = 1)
SELECT l.doc_id, l.leaf, s.h AS subroot, root.h AS root, sha256(f.proof) AS proof_sha256, f.h AS folded_root, f.h = root.h AS verified
FROM leaves l JOIN subroots s ON l.tree = s.name JOIN top_folded f ON f.id = l.id JOIN root ON f.level = root.level
"""


@query
def op11_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    """For every hundredth vector and its positives, the best rows of other labels within the score window."""
    whole = F.transform("embedding", lambda x: F.floor(F.lit(256) * x.cast("double")).cast("double"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf, "embeddings").filter(norm_search.finite(F.col("embedding")))
    return hard_negatives.mine(vectors.select("vec_id", label.alias("label"), whole.alias("v")), F.col("vec_id") % 100 == 0)


ORACLE["op11_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), n AS (
  SELECT anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS r
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
)
SELECT anchor_id, positive_id, CAST(r AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE r <= 10
"""
