"""Registered queries of the numbered operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (decontamination, filter_audit, hidden_markov, line_dedup, mixing, nearest, simhash,
                         source_divergence, substring_dedup, token_files, toxicity, url_filters, warc_zip)

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
URL_RULES = [url_filters.Rule("block", "net"), url_filters.Rule("allow", "example.net", "/en/"),
             url_filters.Rule("block", "example.com", "/de/"), url_filters.Rule("allow", "org", "/fr/")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.frame.select("doc_id", "held_out", "score", "predicted")


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.url_verdicts(table(spark, sf_dir, "pages"), URL_RULES)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.without_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest.nearest(vectors, vectors.filter("vec_id % 20 = 0"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_zip.read_packages(warc_zip.write_packages(table(spark, sf_dir, "pages")))


def op10_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hidden_markov.language_model(table(spark, sf_dir, "documents")).frame


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.source_divergence(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.without_repeated_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def token_digest(documents: DataFrame) -> DataFrame:
    # This vocabulary lower-cases, drops white space and never looks across it.
    files = token_files.write_token_files(documents, tokenizer_path(), END_ID, per_word=True)
    return token_files.read_token_files(files)


def op9_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_url_filters": op2_url_filters,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_nearest": op4_nearest,
    "op5_mixing": op5_mixing,
    "op6_simhash": op6_simhash,
    "op7_decontamination": op7_decontamination,
    "op8_warc": op8_warc,
    "op9_token_ids": op9_token_ids,
    "op10_hidden_markov": op10_hidden_markov,
    "op11_source_divergence": op11_source_divergence,
    "op12_filter_audit": op12_filter_audit,
    "op13_line_dedup": op13_line_dedup,
}

WORDS_SQL = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"

ORACLES: dict[str, str] = {
    "op2_url_filters": """
        WITH rest AS (
          SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
        parts AS (
          SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
        rules(verdict, rule_host, rule_path) AS (
          VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
        best AS (
          SELECT page_id, host, path, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
                 max_by(verdict, length(rule_host || rule_path)) AS verdict
          FROM parts LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
          GROUP BY page_id, host, path)
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM best""",
    "op3_substring_dedup": f"""
        WITH docs AS (SELECT doc_id, {WORDS_SQL} AS words FROM documents),
        windows AS (
          SELECT doc_id, i, array_to_string(words[i:i + 49], ' ') AS passage
          FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM docs WHERE len(words) >= 50)),
        firsts AS (SELECT passage, min(doc_id) AS first_id FROM windows GROUP BY passage),
        gone AS (
          SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS place
          FROM windows JOIN firsts USING (passage) WHERE first_id < doc_id),
        words AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM docs),
        kept AS (
          SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY place) AS kept
          FROM words ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
        SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n_kept, 0) AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM docs LEFT JOIN kept USING (doc_id)""",
    "op8_warc": """
        WITH bodies AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
        digests AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS hex FROM bodies),
        chunks AS (SELECT page_id, payload_bytes, hex, list_transform(range(0, 8),
                     lambda k: ('0x' || substr(hex, 5 * k + 1, 5))::BIGINT) AS chunk FROM digests),
        named AS (SELECT page_id, payload_bytes, array_to_string(list_transform(chunk, lambda v:
                     list_reduce(list_transform([15, 10, 5, 0], lambda s:
                       substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> s) & 31)::INT + 1, 1)), lambda a, b: a || b)), '') AS payload_digest
                  FROM chunks),
        held AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS holder FROM named)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> holder THEN holder END AS refers_to FROM held""",
    "op11_source_divergence": r"""
        WITH docs AS (
          SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                 regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
        occurring AS (SELECT row_id, lang, source, unnest(terms) AS term FROM docs),
        vocabulary AS (SELECT lang, term FROM occurring GROUP BY lang, term HAVING count(DISTINCT row_id) >= 10),
        terms AS (SELECT lang, count(*)::HUGEINT AS v FROM vocabulary GROUP BY lang),
        counted AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM occurring JOIN vocabulary USING (lang, term) GROUP BY ALL),
        groups AS (SELECT DISTINCT lang, source FROM docs),
        full_counts AS (
          SELECT g.lang, g.source, v.term, coalesce(n, 0) AS n FROM groups g JOIN vocabulary v USING (lang)
          LEFT JOIN counted USING (lang, source, term)),
        own AS (
          SELECT lang, source, term, n, 1 + (1000000000 * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p
          FROM full_counts JOIN terms USING (lang)),
        whole AS (
          SELECT lang, term, 1 + (1000000000 * (sum(n) + 2)) // (sum(sum(n)) OVER (PARTITION BY lang) + 2 * any_value(v)) AS q
          FROM full_counts JOIN terms USING (lang) GROUP BY lang, term),
        sums AS (
          SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
          FROM own a JOIN own b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        pairs AS (
          SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
          FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
        apart AS (
          SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value
          FROM own JOIN whole USING (lang, term) WHERE n > 0 AND p > q),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
          FROM (SELECT * FROM pairs UNION ALL SELECT * FROM apart))
        SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= 10""",
    "op12_filter_audit": rf"""
        WITH docs AS (
          SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, {WORDS_SQL} AS words FROM documents),
        masks AS (
          SELECT part, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic, [
              len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
              100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text), regexp_matches(text, '[#$%&*|]'),
              doc_id > min(doc_id) OVER (PARTITION BY text)] AS fails
          FROM docs LEFT JOIN labels USING (doc_id)),
        counts AS (
          SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS bad FROM masks GROUP BY ALL),
        letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        orders AS (
          SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
          WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
        steps AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders),
        ranks AS (
          SELECT part, filter_order, fails, n, good, bad,
                 least(CASE WHEN fails[1] THEN strpos(filter_order, 'A') ELSE 6 END, CASE WHEN fails[2] THEN strpos(filter_order, 'B') ELSE 6 END,
                       CASE WHEN fails[3] THEN strpos(filter_order, 'C') ELSE 6 END, CASE WHEN fails[4] THEN strpos(filter_order, 'D') ELSE 6 END,
                       CASE WHEN fails[5] THEN strpos(filter_order, 'E') ELSE 6 END) AS gone
          FROM counts, orders),
        report AS (
          SELECT part, filter_order, step, sum(n) FILTER (gone > step) AS kept, sum(n) FILTER (gone = step) AS removed,
                 sum(n) FILTER (fails[strpos('ABCDE', filter_order[step])] AND gone < step) AS redundant,
                 sum(n) FILTER (fails[strpos('ABCDE', filter_order[step])] AND len(list_filter(fails, lambda f: f)) = 1) AS unique_fails,
                 sum(good) FILTER (gone = step) AS good_lost, sum(bad) FILTER (gone = step) AS toxic_lost
          FROM ranks JOIN steps USING (filter_order) GROUP BY part, filter_order, step)
        SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
               coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
               coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
               (sum(coalesce(removed, 0)) OVER (PARTITION BY part, filter_order[step]))::BIGINT AS shapley
        FROM report""",
    "op13_line_dedup": r"""
        WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        lines AS (SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS place FROM docs),
        keys AS (
          SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
        judged AS (SELECT *, length(key) >= 10 AND doc_id > min(doc_id) OVER (PARTITION BY key) AS gone FROM keys)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
        FROM judged GROUP BY doc_id""",
}
