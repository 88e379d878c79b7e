"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from muniment.llm import decontaminate, html, negatives, packing, pieces, quality, repeats, runs, secrets, simhash, suffixes, urls, wordpiece
from muniment.llm.common import read


def op1_html_extraction(spark, sf_dir):
    return html.main_text(read(spark, sf_dir, "pages"))


def op2_suffix_array(spark, sf_dir):
    return suffixes.substring_dedup(read(spark, sf_dir, "documents")).drop("spans")


def op3_decontamination(spark, sf_dir):
    found = decontaminate.find_matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), size=10)
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op4_secrets(spark, sf_dir):
    found = secrets.scan_secrets(read(spark, sf_dir, "documents"))
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.KINDS[:3]))
    return found.select("doc_id", of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"),
                        F.sha2(listed(base), 256).alias("base_sha256"), listed("spans").alias("spans"))


def op5_quality(spark, sf_dir):
    return quality.quality_rules(read(spark, sf_dir, "documents"))


def op6_simhash(spark, sf_dir):
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op7_sentencepiece(spark, sf_dir):
    return pieces.encode_texts(read(spark, sf_dir, "documents"))


def op8_substring_dedup(spark, sf_dir):
    return repeats.repeat_dedup(read(spark, sf_dir, "documents")).drop("spans")


#: The rules by which pages are judged.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def op9_url_filters(spark, sf_dir):
    return urls.url_verdicts(read(spark, sf_dir, "pages"), urls.rule_table(spark, URL_RULES))


def op10_token_counts(spark, sf_dir):
    return wordpiece.token_counts(read(spark, sf_dir, "documents"))


def op11_hard_negatives(spark, sf_dir):
    vectors = read(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine_negatives(vectors, label=label, anchors=F.col("vec_id") % 100 == 0)


def op12_packing(spark, sf_dir):
    return packing.pack(read(spark, sf_dir, "documents"))


def op13_periodic_runs(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    planted = docs.select("doc_id", runs.repeat_tails(docs.text, docs.doc_id).alias("text"))
    return runs.periodic_runs(planted).drop("runs")


QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_suffix_array": op2_suffix_array,
    "op3_decontamination": op3_decontamination,
    "op4_secrets": op4_secrets,
    "op5_quality": op5_quality,
    "op6_simhash": op6_simhash,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_url_filters": op9_url_filters,
    "op10_token_counts": op10_token_counts,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_packing": op12_packing,
    "op13_periodic_runs": op13_periodic_runs,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLE: dict[str, str] = {
    "op3_decontamination": f"""
        WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_TERMS} AS w FROM documents),
        t AS (SELECT item_id, {_TERMS} AS w FROM benchmark),
        q AS (SELECT item_id, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS k
              FROM t, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS u(i) WHERE len(w) > 0),
        o AS (SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS k FROM d, (SELECT DISTINCT n FROM q), unnest(range(1, len(w) - n + 2)) AS u(i)),
        m AS (SELECT DISTINCT r, i, n, item_id FROM o JOIN q USING (n, k)),
        hits AS (SELECT r, count(DISTINCT i + j) AS n_hit FROM m, unnest(range(0, n)) AS u(j) GROUP BY r),
        found AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM m GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hits USING (r) LEFT JOIN found USING (r)""",
    "op8_substring_dedup": f"""
        WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
        o AS (SELECT r, doc_id, i, array_to_string(w[i : i + 12], ' ') AS k FROM d, unnest(range(1, len(w) - 11)) AS u(i)),
        first AS (SELECT k, min(doc_id) AS m FROM o GROUP BY k),
        hits AS (SELECT DISTINCT r, i + j AS p FROM o JOIN first USING (k), unnest(range(0, 13)) AS u(j) WHERE m < doc_id),
        kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS body, count(*) AS n
                 FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) ANTI JOIN hits USING (r, p) GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (r)""",
    "op9_url_filters": r"""
        WITH c AS (
            SELECT page_id, row_number() OVER () AS n,
                   CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
        e AS (SELECT page_id, n, split_part(split_part(rest, '#', 1), '?', 1) AS rest FROM c),
        u AS (SELECT page_id, n, translate(split_part(rest, '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                     CASE WHEN instr(rest, '/') > 0 THEN substr(rest, instr(rest, '/')) ELSE '' END AS path FROM e),
        r(rhost, rpath, action) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
        m AS (SELECT n, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(action, length(rhost || rpath)) AS action
              FROM u JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY n)
        SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM u LEFT JOIN m USING (n)""",
    "op11_hard_negatives": """
        WITH r AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
                   FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.r AS a, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
              FROM r a JOIN r b ON a.r <> b.r WHERE a.vec_id % 100 = 0),
        p AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) AS nth FROM s WHERE same),
        n AS (SELECT p.a, p.anchor_id, p.vec_id AS positive_id, nth, p.score AS positive_score, s.vec_id AS negative_id, s.score AS negative_score,
                     row_number() OVER (PARTITION BY p.a, nth ORDER BY s.score DESC, s.vec_id) AS rank
              FROM p JOIN s ON p.a = s.a AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score WHERE nth <= 5)
        SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5""",
}
