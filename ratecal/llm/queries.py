"""Registered queries over whole tables, and the SQL of those that SQL can express."""

from pyspark.sql import DataFrame, SparkSession

from ratecal.llm import bpe, extract, language, lm, minhash, phrases, pii, quality, search, templates, toxicity, urls, vectors
from ratecal.llm.ship import ship

RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality_classifier(spark, folder):
    return quality.scored(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op2_embedding_dedup(spark, folder):
    return vectors.groups(_table(spark, folder, "embeddings"))


def op3_html_extraction(spark, folder):
    return extract.extract(_table(spark, folder, "pages"))


def op4_byte_bpe(spark, folder):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digests(_table(spark, folder, "documents"), path, public_tokenizers.PATTERN)


def op5_toxicity(spark, folder):
    return toxicity.scored(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op6_language_id(spark, folder):
    return language.predicted(_table(spark, folder, "documents"))


def op7_url_filter(spark, folder):
    return urls.judge(_table(spark, folder, "pages"), RULES)


def op8_template_decontamination(spark, folder):
    return templates.matches(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op9_pitman_yor_scores(spark, folder):
    return lm.scores(_table(spark, folder, "documents"))


def op10_minhash_dedup(spark, folder):
    return minhash.groups(_table(spark, folder, "documents"))


def op11_ranked_search(spark, folder):
    return search.ranked(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op12_phrase_collocations(spark, folder):
    return phrases.mined(_table(spark, folder, "documents"))


def op13_pii_deobfuscation(spark, folder):
    return pii.digests(_table(spark, folder, "documents"))


LLM_QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_classifier, op2_embedding_dedup, op3_html_extraction, op4_byte_bpe, op5_toxicity, op6_language_id, op7_url_filter,
        op8_template_decontamination, op9_pitman_yor_scores, op10_minhash_dedup, op11_ranked_search,
        op12_phrase_collocations, op13_pii_deobfuscation,
    )
}

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

# components of `links` (a, b) over `nodes` (id), by walking from every node
_REACH = """reach AS (
  SELECT id AS a, id AS b FROM nodes
  UNION SELECT r.a, l.b FROM reach r JOIN (SELECT a, b FROM links UNION ALL SELECT b, a FROM links) l ON r.b = l.a
), part AS (SELECT a AS id, min(b) AS component_id FROM reach GROUP BY 1)"""

LLM_SQL = {
    "op2_embedding_dedup": f"""WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.vec_id < q.vec_id AND len(p.e) = len(q.e)
  WHERE list_cosine_similarity(p.e, q.e) >= 0.9
), nodes AS (SELECT vec_id AS id FROM embeddings), {_REACH},
degree AS (SELECT id, count(*) AS n FROM (SELECT a AS id FROM links UNION ALL SELECT b FROM links) GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN part p ON p.id = vec_id LEFT JOIN degree d ON d.id = vec_id""",
    # The given pages hold no redirects or canonical links: a page without a rule is allowed, and one
    # with a link has no answer here.
    "op7_url_filter": f"""WITH parts AS (
  SELECT page_id, html, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), {_LOWER}) AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages
), rules(verdict, h, p) AS (VALUES {", ".join(str(r) for r in RULES)}
), fits AS (
  SELECT page_id, host, path, html, max_by(h || p, length(h || p)) AS rule, max_by(verdict, length(h || p)) AS ruling
  FROM parts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY ALL
)
SELECT page_id, host, path, rule, coalesce(ruling, CASE WHEN NOT regexp_matches(coalesce(html, ''),
  '(?is)<link[^>]*canonical|<meta[^>]*http-equiv[^>]*refresh') THEN 'allow' END) AS verdict FROM fits""",
    "op10_minhash_dedup": f"""WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 3
      THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM words
), sizes AS (SELECT doc_id, len(s) AS n FROM sets),
shingles AS (SELECT doc_id, unnest(s) AS x FROM sets),
links AS (
  SELECT p.doc_id AS a, q.doc_id AS b FROM shingles p JOIN shingles q ON p.x = q.x AND p.doc_id < q.doc_id
  JOIN sizes m ON m.doc_id = p.doc_id JOIN sizes k ON k.doc_id = q.doc_id
  GROUP BY 1, 2, m.n, k.n HAVING 100 * count(*) >= 85 * (m.n + k.n - count(*))
), nodes AS (SELECT doc_id AS id FROM documents), {_REACH}
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sizes JOIN part ON id = doc_id""",
    "op11_ranked_search": f"""WITH terms(id, t) AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '{_TERM}') FROM documents
), sizes AS (SELECT row_number() OVER () AS r, id, t, CAST(len(t) AS BIGINT) AS n FROM terms WHERE len(t) > 0
), total AS (SELECT CAST(count(*) AS BIGINT) AS all_docs, CAST(sum(n) AS BIGINT) AS all_terms FROM sizes),
tf AS (SELECT r, x, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(t) AS x FROM sizes) GROUP BY ALL),
wanted AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '{_TERM}')) AS x FROM benchmark),
df AS (SELECT x, CAST(floor(1000 * ln((2 * all_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM tf, total GROUP BY x, all_docs),
scores AS (
  SELECT item_id, id AS doc_id, r,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * all_docs) // all_terms)))) AS BIGINT) AS score
  FROM wanted JOIN df USING (x) JOIN tf USING (x) JOIN sizes USING (r), total GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 50""",
    "op12_phrase_collocations": f"""WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), {_LOWER}), '[.,;:!?\x0A-\x0D]')) AS p FROM documents
), words AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
sizes AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
spots AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, range(1, 6) AS lengths(k)),
f AS (SELECT lang, k, w[i:i + k - 1] AS g, CAST(count(*) AS BIGINT) AS f FROM spots GROUP BY ALL HAVING count(*) >= 100),
cuts AS (SELECT lang, k, g, f AS a, unnest(range(1, k)) AS c FROM f WHERE k > 1),
scores AS (
  SELECT t.lang, t.k, t.g, a, c, p.f AS l, q.f AS r, n,
    CAST(1000 * a::HUGEINT * n::HUGEINT // (p.f::HUGEINT * q.f::HUGEINT) AS BIGINT) AS score
  FROM cuts t JOIN f p ON p.lang = t.lang AND p.g = t.g[1:c] JOIN f q ON q.lang = t.lang AND q.g = t.g[c + 1:t.k] JOIN sizes s ON s.lang = t.lang
  QUALIFY row_number() OVER (PARTITION BY t.lang, t.g ORDER BY score, c) = 1
),
inner_parts AS (
  SELECT lang, g[i:i + m - 1] AS g, max(f) AS longer
  FROM (SELECT lang, g, f, k, m, unnest(range(1, k - m + 2)) AS i FROM f, range(2, 5) AS parts(m) WHERE m < k) GROUP BY ALL
)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM (SELECT *, array_to_string(g, ' ') AS phrase FROM scores) s LEFT JOIN inner_parts i ON i.lang = s.lang AND i.g = s.g
WHERE longer IS NULL OR 100 * longer < 100 * a QUALIFY rank <= 2000""",
}
