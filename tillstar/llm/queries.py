"""Registered queries of this package, each over whole tables, and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm import bpe, langid, lexical, licenses, perplexity, rules, warc
from tillstar.llm.common import prepare, read
from tillstar.llm.decontam import contaminated
from tillstar.llm.line_dedup import dedup_lines
from tillstar.llm.near_dup import near_duplicates
from tillstar.llm.repeats import remove_repeats
from tillstar.llm.sentencepiece import round_trip
from tillstar.llm.word_runs import word_runs
from tillstar.session import hadoop_path, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]):
    QUERIES[f.__name__] = f
    return f


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


ORACLES["op3_line_dedup"] = r"""
WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM cut),
keyed AS (
  SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
owners AS (
  SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (owner IS NOT NULL AND owner <> doc_id) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (owner IS NULL OR owner = doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN owners USING (key) GROUP BY doc_id
"""


@query
def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text and what they decode to, as digests."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    coded = round_trip(docs)
    return coded.select(
        "doc_id",
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_ids"),
        F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"),
    )


@query
def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~langid.held_out()))
    found = langid.predict(docs, model)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "accepted")


@query
def op1_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents"))


@query
def op7_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "documents"), words=4)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op8_simhash_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "start", "n_windows", "similarity").distinct()


ORACLES["op8_simhash_decontam"] = r"""
WITH texts AS (
  SELECT 0 AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
worded AS (
  SELECT kind, id, string_split(trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')), ' ') AS w FROM texts),
shingled AS (
  SELECT kind, id, list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) AS sh FROM worded WHERE len(w) >= 5),
docs AS (SELECT id AS doc_id, sh, len(sh) AS n FROM shingled WHERE kind = 0),
items AS (SELECT id AS item_id, sh, len(sh) AS k FROM shingled WHERE kind = 1),
seeds AS (SELECT DISTINCT item_id, k, unnest(sh) AS h FROM items),
places AS (SELECT doc_id, n, unnest(sh) AS h, generate_subscripts(sh, 1) - 1 AS p FROM docs),
starts AS (SELECT DISTINCT doc_id, item_id, k, greatest(0, least(p, n - k)) AS start FROM places JOIN seeds USING (h)),
wins AS (SELECT s.doc_id, s.item_id, s.start, unnest(d.sh[s.start + 1 : s.start + s.k]) AS h FROM starts s JOIN docs d USING (doc_id)),
wcount AS (SELECT doc_id, item_id, start, h, count(*) AS a FROM wins GROUP BY ALL),
wsize AS (SELECT doc_id, item_id, start, sum(a) AS size FROM wcount GROUP BY ALL),
icount AS (SELECT item_id, h, count(*) AS b FROM (SELECT item_id, unnest(sh) AS h FROM items) GROUP BY ALL),
overlap AS (
  SELECT doc_id, item_id, start, sum(least(a, b)) AS o FROM wcount JOIN icount USING (item_id, h) GROUP BY ALL),
sims AS (
  SELECT doc_id, item_id, start, o, size + k - o AS u FROM overlap JOIN wsize USING (doc_id, item_id, start) JOIN items USING (item_id)),
kept AS (SELECT doc_id, item_id, start, o::DOUBLE / u::DOUBLE AS similarity FROM sims WHERE 100 * o >= 80 * u)
SELECT doc_id, item_id, arg_min(start, (-similarity, start))::BIGINT AS start, count(*) AS n_windows, max(similarity) AS similarity
FROM kept GROUP BY doc_id, item_id
"""


@query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    streams, members = scratch_path(spark, "streams"), scratch_path(spark, "archives")
    warc.write_archives(pages, streams)
    index = warc.normalise(spark, streams, members)
    fs, path = hadoop_path(spark, streams)
    fs.delete(path, True)
    found = warc.read_records(index, payloads=False)
    return found.select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"), "refers_to")


ORACLES["op2_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS n, sha1(html) AS digest FROM p),
top AS (SELECT digest, max(page_id) AS top FROM d WHERE n >= 1000 GROUP BY digest)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
  CASE WHEN top <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN top <> page_id THEN top END AS refers_to
FROM d LEFT JOIN top USING (digest)
"""


@query
def op6_perplexity_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = perplexity.judge(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "perplexity")


@query
def op9_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = rules.statistics(read(spark, sf_dir, "documents"))
    out = langid.held_out("doc_id", 3, 1)
    model = rules.fit(stats, read(spark, sf_dir, "labels").where(~out))
    return rules.score(stats, model).select("doc_id", out.alias("held_out"), "score", "predicted")


@query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents")).select("doc_id", "n_hits", "identifiers", "licenses")


ORACLES["op4_license_scan"] = licenses.twin()


@query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical.build(read(spark, sf_dir, "documents"))
    return lexical.search(index, read(spark, sf_dir, "benchmark"), k=50)


ORACLES["op11_lexical_search"] = r"""
WITH cut AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
sized AS (SELECT r, doc_id, terms, len(terms)::BIGINT AS n FROM cut WHERE len(terms) > 0),
totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM sized),
scaled AS (SELECT r, doc_id, terms, 100 - 50 + ((50 * n * docs) // words) AS m FROM sized, totals),
postings AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(terms) AS term FROM scaled) GROUP BY ALL),
items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM postings, totals GROUP BY term),
scores AS (
  SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM items JOIN weights USING (term) JOIN postings USING (term) JOIN scaled USING (r) GROUP BY ALL),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
  FROM scores WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 50
"""


@query
def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    coded = bpe.decode(bpe.encode(docs).drop("text"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def planted_periods(docs: DataFrame) -> DataFrame:
    """The texts that op13 is asked about: one document in ten repeats a stretch of its words to its end."""
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    h = F.crc32(F.col("doc_id").cast("string"))
    chosen = docs.withColumn("_w", F.when(h % 10 == 0, words)).withColumn("_n", F.when(h % 10 == 0, F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))))
    g = F.floor(h / 10)
    n = F.col("_n")
    a = (g % F.greatest(n, F.lit(1))).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    rest = F.slice(F.flatten(F.array_repeat(F.slice("_w", a + 1, p), F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    text = F.when(n > 0, F.array_join(F.concat(F.slice("_w", F.lit(1), a), rest), " ")).otherwise(F.col("text"))
    return chosen.withColumn("text", text).drop("_w", "_n")


@query
def op13_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = word_runs(planted_periods(read(spark, sf_dir, "documents").select("doc_id", "text")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    found = found.withColumn("_longest", longest)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("_longest.s")).alias("start"),
        F.col("_longest.length").alias("length"),
        (-F.col("_longest.p")).alias("period"),
        F.floor(1000 * F.col("_longest.length") / -F.col("_longest.p")).cast("long").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"),
    )
