"""Registered queries of the subpackage: one ``opN_<name>`` per operator over its whole
table, and DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (decontaminate, fingerprint, html, language, licenses, manifest, mixing, neardup, quality, rules, search, substrings,
                        urls)
from quarry.llm.store import table

#: production parameters
MIX_ALPHA, MIX_EPOCHS, MIX_SEED = 0.5, 1.0, 17
URL_RULES = [
    urls.Rule("org", "/", "allow"),
    urls.Rule("example.org", "/es/", "block"),
    urls.Rule("example.org", "/en/1", "block"),
    urls.Rule("com", "/fr/", "allow"),
    urls.Rule("com", "/de/", "block"),
]


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's copies in the tempered mixture (mass ** 0.5, one epoch)."""
    docs = table(spark, sf_dir, "documents")
    mixed = mixing.mix_sources(docs, alpha=MIX_ALPHA, epochs=MIX_EPOCHS, seed=MIX_SEED)
    return mixed.withColumn("mix_rate", F.round("mix_rate", 6))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score; rows with crc32(doc_id) mod 5 = 0 are not learned."""
    held = quality.held_out(F.col("doc_id"), 5, 0)
    scored = quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learn_from=~held)
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language; rows with crc32(doc_id) mod 4 = 2 are not learned."""
    docs = table(spark, sf_dir, "documents")
    learned = language.learned_rows(F.col("doc_id"), 4, 2)
    model = language.train(docs.where(learned))
    found = language.identify(docs, model)
    return found.select("doc_id", (~learned).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by the rules, else by the list: the addresses of pages whose
    document (its number is in the path) is labelled low quality."""
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    number = F.regexp_extract(urls.url_path(F.col("url")), r"/(\d{1,18})", 1)
    bad = labels.where("quality = 0").select(F.col("doc_id").alias("_doc")).distinct()
    listed = (pages.select("url", F.when(number != "", number.cast("bigint")).alias("_doc"))
              .join(bad, "_doc", "left_semi").select("url"))
    judged = urls.filter_urls(pages, listed, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "listed", "canonical")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its words in repeated 20-word windows."""
    done = substrings.remove_repeats(table(spark, sf_dir, "documents"), window=20)
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component at a similarity of 0.85 of 3-word shingles."""
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"), neardup.Likeness(words=3, percent=85))
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, as (doc_id, item_id) pairs; clean ones have no row."""
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every license statement in the documents."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    return html.main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("bigint"))


def op10_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited form."""
    return fingerprint.edited_fingerprints(table(spark, sf_dir, "documents"))


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, subroot, root and proof, and the proof after tampering."""
    return manifest.tampered_documents(table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all documents for every benchmark item."""
    return search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=10)


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's base measures and the verdict of the voting rules."""
    found = rules.quality_rules(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                        F.round("posterior", 6).alias("posterior"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_quality": op2_quality,
    "op3_language": op3_language,
    "op4_url_filter": op4_url_filter,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_decontamination": op7_decontamination,
    "op8_license_scan": op8_license_scan,
    "op9_html_text": op9_html_text,
    "op10_fingerprint": op10_fingerprint,
    "op11_manifest": op11_manifest,
    "op12_ranked_search": op12_ranked_search,
    "op13_quality_rules": op13_quality_rules,
}

ORACLES: dict[str, str] = {
    "op1_mix_sources": f"""
WITH masses AS (SELECT source, CAST(coalesce(sum(length(text)), 0) AS BIGINT) AS mass FROM documents GROUP BY source),
weighted AS (SELECT source, mass, CASE WHEN mass > 0 THEN pow(CAST(mass AS DOUBLE), {MIX_ALPHA}) ELSE 0.0 END AS weight FROM masses),
rates AS (SELECT source, CASE WHEN mass > 0 THEN weight / (SELECT sum(weight) FROM weighted)
            * (SELECT CAST(sum(mass) AS DOUBLE) FROM weighted) * {MIX_EPOCHS} / mass ELSE 0.0 END AS rate FROM weighted),
parted AS (SELECT source, rate, greatest(CAST(ceil(rate) AS INTEGER), 1) AS parts FROM rates WHERE rate > 0),
terms AS (SELECT source, k, sum(exp(-rate / parts) * pow(rate / parts, k) / factorial(CAST(k AS INTEGER)))
            OVER (PARTITION BY source ORDER BY k) AS cdf
          FROM parted, range(0, {mixing.TERMS + 1}) t(k)),
drawn AS (SELECT d.doc_id, d.source, p.rate, i.part,
            CAST('0x' || substr(md5('{MIX_SEED}|' || d.doc_id || '|' || i.part), 1, {mixing.DIGITS}) AS BIGINT)
              / CAST({16 ** mixing.DIGITS} AS DOUBLE) AS u
          FROM documents d JOIN parted p ON d.source IS NOT DISTINCT FROM p.source,
               LATERAL (SELECT unnest(range(1, p.parts + 1)) AS part) i),
counts AS (SELECT w.doc_id, w.rate, count(t.k) AS n FROM drawn w JOIN terms t
             ON w.source IS NOT DISTINCT FROM t.source AND t.cdf <= w.u GROUP BY w.doc_id, w.rate)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, round(c.rate, 6) AS mix_rate, CAST(j.copy AS INTEGER) AS mix_copy,
       md5('order{MIX_SEED}|' || d.doc_id || '|' || j.copy) AS mix_order
FROM documents d JOIN counts c USING (doc_id), LATERAL (SELECT unnest(range(0, c.n)) AS copy) j
""",
    "op4_url_filter": r"""
WITH parsed AS (
  SELECT page_id, url,
    lower(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's')) AS host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path,
    regexp_extract(url, '^.*?://[^?#]*\?([^#]*)', 1, 's') AS query FROM pages),
canon AS (
  SELECT *, array_to_string(list_filter(string_split(query, '&'), lambda x: x <> '' AND NOT starts_with(x, 'utm_')), '&') AS kept FROM parsed),
urls AS (
  SELECT page_id, host, path, CASE WHEN url IS NULL THEN NULL ELSE
    regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^www\.', '') || regexp_replace(path, '/+$', '')
    || CASE WHEN kept <> '' THEN '?' || kept ELSE '' END END AS canonical,
    CASE WHEN regexp_extract(path, '/(\d{1,18})', 1) <> '' THEN CAST(regexp_extract(path, '/(\d{1,18})', 1) AS BIGINT) END AS doc
  FROM canon),
rules(rule, h, p, v) AS (VALUES ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
  ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'), ('com/de/', 'com', '/de/', 'block')),
best AS (
  SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule, arg_max(v, length(rule)) AS v
  FROM (SELECT DISTINCT page_id, host, path FROM urls) u JOIN rules
    ON (u.host = rules.h OR ends_with(u.host, '.' || rules.h)) AND starts_with(u.path, rules.p)
  GROUP BY page_id, host, path),
listed AS (
  SELECT DISTINCT canonical FROM urls WHERE canonical IS NOT NULL AND doc IN (SELECT doc_id FROM labels WHERE quality = 0))
SELECT u.page_id, u.host, u.path, b.rule, l.canonical IS NOT NULL AS listed, u.canonical,
  coalesce(b.v, CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM urls u LEFT JOIN best b ON u.page_id = b.page_id AND u.host = b.host AND u.path = b.path
  LEFT JOIN listed l ON u.canonical = l.canonical
""",
    "op6_near_duplicates": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE [words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] FOR i IN range(1, len(words) - 1)] END) AS shingles FROM w),
n AS (SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n FROM s),
flat AS (SELECT doc_id, unnest(shingles) AS x FROM s),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM flat a JOIN flat b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * i >= 85 * (p.n + q.n - i)),
sym AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.doc_id, e.b FROM reach r JOIN sym e ON r.other = e.a)
SELECT n.doc_id, n.n AS n_shingles, c.component_id, n.doc_id = c.component_id AS kept
FROM n JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)
""",
    # quadratic in a text's words only through arrays of at most its own length
    "op5_substring_dedup": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
wins AS (SELECT doc_id, unnest(range(1, len(words) - 18)) AS s, words FROM w WHERE len(words) >= 20),
keyed AS (SELECT doc_id, s, md5(array_to_string(words[s:s + 19], ' ')) AS h FROM wins),
later AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY h ORDER BY doc_id, s) AS r FROM keyed) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, s + i AS p FROM later, range(0, 20) t(i)),
flat AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM w),
kept AS (SELECT f.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY f.p) AS text
         FROM flat f LEFT JOIN gone g ON f.doc_id = g.doc_id AND f.p = g.p WHERE g.p IS NULL GROUP BY f.doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
""",
    # crc32 is spelled out: a byte a step of the outer fold, a bit a step of the inner one
    "op11_manifest": r"""
WITH RECURSIVE base AS (
  SELECT doc_id, source, lang, n_chars, text, coalesce(CASE WHEN doc_id IS NULL THEN NULL ELSE
    xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1),
      lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT))),
      lambda c, b: list_reduce(list_prepend(xor(c, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
        lambda x, y: xor(x >> 1, CASE WHEN x % 2 = 1 THEN CAST(3988292384 AS BIGINT) ELSE 0 END)))) END % 5 = 0, false) AS chosen FROM documents),
head AS (
  SELECT *, coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
    || coalesce(octet_length(encode(lang)) || ':' || lang, '-') || coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') AS h,
    CASE WHEN chosen THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS changed FROM base),
digests AS (
  SELECT doc_id, coalesce('=' || source, '') AS g, sha256(h || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
    sha256(h || coalesce(octet_length(encode(changed)) || ':' || changed, '-')) AS now FROM head),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM digests),
low(lvl, g, pos, digest, n) AS (
  SELECT 0, g, pos, leaf, n FROM leaves
  UNION ALL
  SELECT lvl + 1, g, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)), (max(n) + 15) // 16 FROM low WHERE n > 1 GROUP BY lvl, g, pos // 16),
subroots AS (SELECT g, digest AS subroot, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM low WHERE n = 1),
high(lvl, pos, digest, n) AS (
  SELECT 0, pos, subroot, n FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)), (max(n) + 15) // 16 FROM high WHERE n > 1 GROUP BY lvl, pos // 16),
steps_low AS (
  SELECT a.lvl, a.g, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS l,
    coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS r
  FROM low a JOIN low b ON a.lvl = b.lvl AND a.g = b.g AND a.pos // 16 = b.pos // 16 WHERE a.n > 1 GROUP BY a.lvl, a.g, a.pos),
steps_high AS (
  SELECT a.lvl, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS l,
    coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS r
  FROM high a JOIN high b ON a.lvl = b.lvl AND a.pos // 16 = b.pos // 16 WHERE a.n > 1 GROUP BY a.lvl, a.pos),
ways AS (
  SELECT f.g, f.pos, s.lvl, s.l, s.r FROM leaves f JOIN steps_low s ON s.g = f.g AND s.pos = f.pos // CAST(pow(16, s.lvl) AS BIGINT)
  UNION ALL
  SELECT f.g, f.pos, 100 + s.lvl, s.l, s.r FROM leaves f JOIN subroots t ON t.g = f.g JOIN steps_high s ON s.pos = t.pos // CAST(pow(16, s.lvl) AS BIGINT)),
paths AS (
  SELECT g, pos, list({'l': l, 'r': r} ORDER BY lvl) AS steps, string_agg(l || r, '' ORDER BY lvl) AS way FROM ways GROUP BY g, pos),
proofs AS (
  SELECT f.doc_id, f.leaf, t.subroot, (SELECT digest FROM high WHERE n = 1) AS root, sha256(coalesce(p.way, '')) AS proof_sha256,
    list_reduce(list_prepend({'l': f.now, 'r': ''}, coalesce(p.steps, [])), lambda a, s: {'l': sha256(s.l || a.l || s.r), 'r': ''}).l AS folded_root
  FROM leaves f JOIN subroots t ON t.g = f.g LEFT JOIN paths p ON p.g = f.g AND p.pos = f.pos)
SELECT *, folded_root = root AS verified FROM proofs
""",
    "op12_ranked_search": r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
items AS (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)),
asked AS (SELECT item_id, term, count(*) AS repeats FROM items GROUP BY ALL),
totals AS (SELECT count(*) AS n_docs, CAST(coalesce(sum(len(t)), 0) AS BIGINT) AS n_terms FROM docs WHERE len(t) > 0),
flat AS (SELECT r, unnest(t) AS term FROM docs),
postings AS (SELECT r, term, count(*) AS tf FROM flat WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
            FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), totals),
impacts AS (SELECT p.r, p.term, w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (25 + (75 * len(d.t) * n_docs) // n_terms))) AS x
            FROM postings p JOIN weights w USING (term) JOIN docs d USING (r), totals),
scored AS (SELECT a.item_id, i.r, CAST(sum(i.x * a.repeats) AS BIGINT) AS score FROM asked a JOIN impacts i USING (term) GROUP BY ALL),
ranked AS (SELECT s.item_id, d.doc_id, s.score, CAST(row_number() OVER (PARTITION BY s.item_id ORDER BY s.score DESC, d.doc_id NULLS LAST) AS INTEGER) AS rank
           FROM scored s JOIN docs d USING (r) WHERE s.score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
""",
}
