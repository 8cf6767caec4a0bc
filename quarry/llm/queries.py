"""Registered queries of the corpus operators, each over its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (byte_bpe, decontam, filter_audit, jaccard_join, line_dedup, lm_score, packing,
                        periodic, quality, token_count, toxicity, url_filter, warc)
from quarry.llm.common import WORD, scratch_path, table

URL_RULES = (
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
)
SEQUENCE_TOKENS, END_ID = 4096, 2


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES, keep=("page_id",))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        "base_failed", "kept")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"),
                          SEQUENCE_TOKENS, END_ID)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return toxicity.score_toxicity(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "text", F.col("__removed").cast("long").alias("n_removed_lines"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "class_id", "n_links", "n_link_texts")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    return warc.read_warc(spark, path, with_payload=False).select(
        F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = token_count.unigram_vocabulary(tokenizer_path("piece_bpe_32k.model"))
    return token_count.count_tokens(table(spark, sf_dir, "documents"), scores)


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lm_score.score_documents(docs, lm_score.fit_network(docs))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(tokenizer_path("byte_bpe_50k.tiktoken"))
    coded = byte_bpe.encode(table(spark, sf_dir, "documents"), ranks, decoded=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """`docs` with the tail of every tenth text (by hash of its id) made periodic: word i >= a becomes word
    a + (i - a) % p, words joined by one blank."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    chosen = docs.withColumn("__words", F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))))
    n = F.size("__words")
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    tail = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(
        "__words", F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
    return chosen.withColumn("text", F.when(n > 0, F.array_join(tail, " ")).otherwise(F.col("text"))).drop("__words")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_periodic_tails(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic.find_runs(docs)
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_url_filters": op1_url_filters,
    "op2_quality_rules": op2_quality_rules,
    "op3_decontamination": op3_decontamination,
    "op4_packing": op4_packing,
    "op5_toxicity": op5_toxicity,
    "op6_line_dedup": op6_line_dedup,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_warc": op8_warc,
    "op9_token_counts": op9_token_counts,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_filter_audit": op13_filter_audit,
}

ORACLE = {
    "op1_url_filters": """
WITH rules(verdict, host, path) AS (VALUES
  ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
parts AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
fits AS (
  SELECT p.page_id, max_by(r.host || r.path, length(r.host || r.path)) AS rule,
         max_by(r.verdict, length(r.host || r.path)) AS verdict
  FROM parts p JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY p.page_id)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f USING (page_id)
""",
    "op6_line_dedup": """
WITH RECURSIVE lines AS (
  SELECT doc_id, none, no, line, trim(translate(line, chr(9) || chr(11) || chr(12) || chr(13), '    ')) AS t
  FROM (SELECT doc_id, text IS NULL AS none, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS no FROM documents)),
seq AS (
  SELECT doc_id, no, t, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS w,
         row_number() OVER (ORDER BY doc_id, no) AS pos,
         row_number() OVER (PARTITION BY doc_id ORDER BY no) AS i
  FROM lines WHERE t <> ''),
grown AS (
  SELECT doc_id, pos, i, pos AS last, t AS run, w FROM seq
  UNION ALL
  SELECT g.doc_id, g.pos, g.i, s.pos, g.run || chr(10) || s.t, g.w + s.w
  FROM grown g JOIN seq s ON s.pos = g.last + 1 AND s.doc_id = g.doc_id
  WHERE g.last - g.pos < 50 AND (g.w < 50 OR g.w - (SELECT x.w FROM seq x WHERE x.pos = g.pos) < 50)),
runs AS (SELECT pos, last, run FROM grown WHERE w >= 50),
copies AS (
  SELECT pos, last FROM (SELECT *, min(pos) OVER (PARTITION BY run) AS first FROM runs) WHERE pos > first),
gone AS (SELECT DISTINCT s.doc_id, s.no FROM copies c JOIN seq s ON s.pos BETWEEN c.pos AND c.last)
SELECT l.doc_id, count(g.no) AS n_removed_lines,
       CASE WHEN NOT l.none THEN coalesce(
         string_agg(CASE WHEN g.no IS NULL THEN l.line END, chr(10) ORDER BY l.no), '') END AS text
FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.no = l.no
GROUP BY l.doc_id, l.none
""",
    "op8_warc": """
WITH sized AS (
  SELECT page_id, coalesce(html, '') AS payload, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
marked AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload) AS top FROM sized)
SELECT page_id, n AS payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN n >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id < top THEN top END AS refers_to
FROM marked
""",
    "op13_filter_audit": """
WITH t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
marks AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
  FROM labels GROUP BY doc_id),
failed AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         {'A': len(words) < 200, 'B': 100 * list_unique(words) < 50 * len(words),
          'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text),
          'D': regexp_matches(text, '[#$%&*|]'),
          'E': coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY text), false)} AS f
  FROM t LEFT JOIN marks m ON t.doc_id = m.doc_id),
cells AS (
  SELECT part, f, good, toxic, count(*) AS n,
         CASE WHEN f.A THEN 'A' ELSE '' END || CASE WHEN f.B THEN 'B' ELSE '' END || CASE WHEN f.C THEN 'C' ELSE '' END
         || CASE WHEN f.D THEN 'D' ELSE '' END || CASE WHEN f.E THEN 'E' ELSE '' END AS letters
  FROM failed GROUP BY ALL),
l AS (SELECT * FROM (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) v(x)),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS letter,
         substr(filter_order, 1, step - 1) AS earlier
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
counts AS (
  SELECT part, filter_order, step, letter,
    sum(n) FILTER (translate(letters, earlier, '') = letters AND NOT contains(letters, letter)) AS kept,
    sum(n) FILTER (translate(letters, earlier, '') = letters AND contains(letters, letter)) AS removed,
    sum(n) FILTER (translate(letters, earlier, '') <> letters AND contains(letters, letter)) AS redundant,
    sum(n) FILTER (letters = letter) AS unique_fails,
    sum(n) FILTER (translate(letters, earlier, '') = letters AND contains(letters, letter) AND good) AS good_lost,
    sum(n) FILTER (translate(letters, earlier, '') = letters AND contains(letters, letter) AND toxic) AS toxic_lost
  FROM cells, steps GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept,
       CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
       CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
       CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(removed) OVER (PARTITION BY part, letter), 0) AS BIGINT) AS shapley
FROM counts
""",
}
