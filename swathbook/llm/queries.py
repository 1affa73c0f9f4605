"""The registered queries of this subpackage, on whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swathbook.llm.html_text import extract_text, fit_extractor
from swathbook.llm.language import fit_languages, identify_languages
from swathbook.llm.mixing import mix
from swathbook.llm.near_documents import SPREAD, near_duplicates
from swathbook.llm.near_lines import FINE, lines_gone, text_key
from swathbook.llm.phrases import hit_words, phrase_matches
from swathbook.llm.quality import fit_quality, score_quality
from swathbook.llm.sharding import assign_shards
from swathbook.llm.spelling import count_words, spelling_variants
from swathbook.llm.token_counts import token_counts
from swathbook.llm.topk import quantise, top_k
from swathbook.llm.url_filter import judge_urls
from swathbook.llm.whitening import fit_whitening, whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's number of lines, of those that go, and the hash of the text that stays (null for a null text, which has no line).

    A row for each document; documents alike in id and text fare alike.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    gone = lines_gone(docs, fine=FINE).withColumnRenamed("doc_id", "id")
    docs = docs.select("doc_id", text_key("text").alias("key"), F.split("text", "\n", -1).alias("lines"))
    judged = docs.join(gone, docs["doc_id"].eqNullSafe(gone["id"]) & (docs["key"] == gone["text_key"]), "left")
    judged = judged.withColumn("gone", F.coalesce("gone", F.array().cast("array<int>")))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    text = F.when(F.col("lines").isNotNull(), F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n"))
    n_lines = F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines")).cast("long")
    return judged.select("doc_id", n_lines.alias("n_lines"), F.size("gone").cast("long").alias("n_removed"), F.md5(text).alias("kept_md5"))


@_query
def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"), spread=SPREAD).select("doc_id", "class_id", "class_rows")


@_query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside benchmark windows, and the items they come from."""
    found = phrase_matches(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), near=False)
    return found.select("doc_id", "phrase_hits", hit_words().alias("n_hit")).select(
        "doc_id",
        F.col("phrase_hits.n_words").alias("n_words"),
        "n_hit",
        F.size("phrase_hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("phrase_hits.items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


#: Words and windows in SQL.
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE["op9_decontamination"] = f"""
WITH b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS p
  FROM b, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS t(i) WHERE len(w) > 0),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM win),
occ AS (SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS p FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS t(i)),
hit AS (SELECT o.doc_id, o.i, o.n, win.item_id FROM occ o JOIN win ON o.n = win.n AND o.p = win.p),
pos AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM hit, unnest(range(i, i + n)) AS t(k) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)"""


#: Host, path and verdict of the rules.
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


@_query
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page. A page's outcome is the label of the document with its number: good and not toxic."""
    labels = table(spark, sf_dir, "labels").withColumn("outcome", F.when((F.col("quality") == 1) & (F.col("toxic") == 0), 1).otherwise(0))
    found = judge_urls(table(spark, sf_dir, "pages"), labels, RULES)
    return found.select("page_id", "host", "path", "rule", "verdict", F.round("rate", 6).alias("rate"), F.round("low", 6).alias("low"))


_SUFFIX = "CASE WHEN len(l) > 2 AND length(l[-1]) = 2 AND l[-2] IN ('ac', 'co', 'com', 'edu', 'gov', 'net', 'org') THEN l[-2] || '.' || l[-1] ELSE l[-1] END"


def _weight(level: str, parent: str) -> str:
    return f"""SELECT coalesce(least(greatest(1 / CASE WHEN s > 0 THEN s END - 1, 1.0), 1000.0), 1000.0) AS weight FROM (
      SELECT (sum(n * (good / n - {parent}) * (good / n - {parent})) - sum({parent} * (1 - {parent})))
        / nullif(greatest(sum({parent} * (1 - {parent}) * (n - 1)), 0), 0) AS s FROM {level})"""


ORACLE["op4_url_filter"] = rf"""
WITH p AS (SELECT page_id, lower(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)) AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
names AS (SELECT host, suffix, CASE WHEN len(l) >= len(string_split(suffix, '.')) + 1
    THEN array_to_string(list_slice(l, len(l) - len(string_split(suffix, '.')), len(l)), '.') ELSE host END AS domain
  FROM (SELECT host, l, {_SUFFIX} AS suffix FROM (SELECT DISTINCT host, string_split(host, '.') AS l FROM p))),
h AS (SELECT host, count(*) AS n, CAST(sum(CASE WHEN quality = 1 AND toxic = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS good
  FROM p JOIN labels ON page_id = doc_id WHERE host <> '' GROUP BY host),
d AS (SELECT domain, suffix, sum(n) AS n, sum(good) AS good FROM h JOIN names USING (host) GROUP BY ALL),
s AS (SELECT suffix, sum(n) AS n, sum(good) AS good, (SELECT sum(good) / sum(n) FROM h) AS all_rate FROM d GROUP BY suffix),
sr AS (SELECT suffix, (good + weight * all_rate) / (n + weight) AS suffix_rate FROM s, ({_weight('s', 'all_rate')})),
dp AS (SELECT d.*, suffix_rate FROM d JOIN sr USING (suffix)),
dr AS (SELECT domain, suffix_rate, (good + weight * suffix_rate) / (n + weight) AS domain_rate FROM dp, ({_weight('dp', 'suffix_rate')})),
hp AS (SELECT h.*, domain_rate FROM h JOIN names USING (host) JOIN dr USING (domain)),
hw AS ({_weight('hp', 'domain_rate')}),
hr AS (SELECT host, n, (good + weight * domain_rate) / (n + weight) AS own_rate FROM hp, hw),
j AS (SELECT host, coalesce(n, 0) + weight AS total,
    coalesce(own_rate, domain_rate, sr.suffix_rate, (SELECT sum(good) / sum(n) FROM h)) AS rate
  FROM names LEFT JOIN hr USING (host) LEFT JOIN dr USING (domain) LEFT JOIN sr USING (suffix), hw),
k AS (SELECT host, rate, rate - 1.645 * sqrt(rate * (1 - rate) / (total + 1)) AS low FROM j),
r AS (SELECT * FROM (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
    ('com', '/fr/', 'allow'), ('com', '/de/', 'block')) AS t(rh, rp, rv)),
best AS (SELECT page_id, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(rv, length(rh || rp)) AS rv
  FROM p JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(rv, CASE WHEN low < 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
  round(rate, 6) AS rate, round(low, 6) AS low FROM p JOIN k USING (host) LEFT JOIN best USING (page_id)"""


@_query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that the mix takes."""
    documents, _ = mix(table(spark, sf_dir, "documents"))
    return documents.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


ORACLE["op10_mixing"] = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight, 2.0::DOUBLE * source_size AS cap FROM s),
l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size, least(cap, weight * (SELECT arg_min(level, cap / weight) FROM l WHERE level * weight <= cap)) AS target FROM l),
p AS (SELECT doc_id, source, size, CAST(sum(size) OVER (PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR)) ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS b FROM d)
SELECT doc_id, size, source_size, target,
  CAST(greatest(0, least(size, CAST(round(target) AS BIGINT) - b)) + greatest(0, least(size, CAST(round(target) AS BIGINT) - b - source_size)) AS BIGINT) AS taken
FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source"""


@_query
def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best matches of every fiftieth vector."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", quantise("embedding").alias("v"))
    return top_k(vectors, vectors.where("vec_id % 50 = 0"), 5)


ORACLE["op6_top_k"] = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, e.vec_id, CAST(list_inner_product(q.v, e.v) AS BIGINT) AS score FROM e q JOIN e ON q.vec_id <> e.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""


@_query
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    found = assign_shards(table(spark, sf_dir, "documents"), ["lang", "source", "n_chars"])
    none = F.lit(None).cast("int")
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", none.alias("grown_shard"), "curve_index")


@_query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from the documents that are not held out."""
    held_out = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 4 == 2
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    model = fit_languages(documents.where("not held_out"))
    found = identify_languages(documents.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))


#: The vocabulary file, from the installed public tokenizers.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


@_query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of tokens of every document."""
    return token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), VOCABULARY).select("doc_id", "n_tokens")


@_query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability that a document is of quality and that it is toxic; kept if the first and not the second is likely."""
    documents, targets = table(spark, sf_dir, "documents"), ["quality", "toxic"]
    found = score_quality(documents, fit_quality(documents, table(spark, sf_dir, "labels"), targets), targets)
    score, toxic = F.col("p_quality").alias("score"), F.col("p_toxic").alias("toxic_score")
    return found.select("doc_id", score, toxic, ((F.col("p_quality") >= 0.5) & (F.col("p_toxic") < 0.5)).alias("keep"))


@_query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form and root of every word of the documents."""
    found = spelling_variants(count_words(table(spark, sf_dir, "documents")))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def _crc_table() -> list[int]:
    """Remainders of the 256 byte values by the reflected polynomial of crc32."""
    out = []
    for value in range(256):
        for _ in range(8):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        out.append(value)
    return out


#: Words in one-byte letters, since DuckDB counts the edits of bytes: A-Z cannot occur in a word.
_WIDE = "".join(map(chr, range(0xC0, 0x100)))
_NARROW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789!#$%&()*+,-./:;<=>?@[]^_{|}~"[:64]
ORACLE["op11_spelling_variants"] = rf"""
WITH RECURSIVE r AS (SELECT doc_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents),
k AS (SELECT doc_id, run, count(*) AS c FROM r WHERE length(run) >= 5 GROUP BY ALL),
t AS (SELECT {_crc_table()}::BIGINT[] AS crc),
bytes AS (SELECT doc_id, run, c, list_transform(string_split(regexp_replace(hex(encode(doc_id || ':' || run)), '(..)', '\1 ', 'g'), ' ')[:-2],
    lambda x: (16 * (strpos('0123456789ABCDEF', substr(x, 1, 1)) - 1) + strpos('0123456789ABCDEF', substr(x, 2, 1)) - 1)::BIGINT) AS b FROM k),
h AS (SELECT doc_id, run, c, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, b), lambda a, x: xor(a >> 8, crc[1 + (xor(a, x) & 255)]))) AS h FROM bytes, t),
w AS (SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2) ELSE run END AS word, c FROM h),
words AS (SELECT word, CAST(sum(c) AS BIGINT) AS n, translate(word, '{_WIDE}', '{_NARROW}') AS narrow FROM w WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
near AS (SELECT a.word, b.word AS near, b.n AS near_n FROM words a JOIN words b
  ON length(b.word) BETWEEN length(a.word) - 1 AND length(a.word) + 1 AND a.word <> b.word AND levenshtein(a.narrow, b.narrow) = 1),
best AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM near GROUP BY word),
j AS (SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * n THEN near END AS form, CASE WHEN near_n >= 2 * n THEN near_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS at FROM j UNION ALL SELECT chain.word, j.form FROM chain JOIN j ON chain.at = j.word WHERE j.form IS NOT NULL),
ends AS (SELECT chain.word, chain.at AS root FROM chain JOIN j ON chain.at = j.word WHERE j.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM j JOIN ends USING (word)"""


@_query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every embedding."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whiten(vectors, fit_whitening(vectors, "embedding"))


@_query
def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    found = extract_text(pages.select("page_id", "url", "html"), fit_extractor(pages))
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))
