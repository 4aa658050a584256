"""Queries of the numbered operators over the whole given tables, and SQL where it can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import table
from strata.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str):
    def add(fn):
        QUERIES[name] = fn
        return fn
    return add


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@query("op1_packing")
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.packing import pack
    pieces = pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op2_sharding")
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.sharding import shard_documents
    return shard_documents(table(spark, sf_dir, "documents"))


@query("op3_html_extraction")
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.html import extract
    return extract(table(spark, sf_dir, "pages"))


@query("op4_decontamination")
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.decontam import leaks
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op7_warc")
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.warc import base32, read_warc, write_warc
    path = scratch_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    records = read_warc(spark, path).withColumn("sha1", F.sha1("payload"))
    # a revisit has no payload; its header gives both
    size = F.coalesce(F.octet_length("payload").cast("long"), F.col("payload_bytes"))
    digest = F.coalesce(base32(F.col("sha1")), F.col("payload_digest"))
    return records.select("page_id", size.alias("payload_bytes"), digest.alias("payload_digest"), "record_type", "refers_to")


ORACLE["op7_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS h FROM p),
f AS (SELECT h, payload_bytes, min(page_id) AS first_id FROM d GROUP BY h, payload_bytes)
SELECT d.page_id, d.payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + ((('0x' || substr(d.h, (1 + 5 * (i // 4))::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN f.first_id = d.page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN f.first_id = d.page_id THEN NULL ELSE f.first_id END AS refers_to
FROM d JOIN f ON d.h = f.h AND d.payload_bytes = f.payload_bytes
"""


@query("op9_jaccard_join")
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.jaccard import jaccard_components
    return jaccard_components(table(spark, sf_dir, "documents"))


_WORDS = "list_filter(regexp_split_to_array({}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"

ORACLE["op9_jaccard_join"] = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS sh FROM d),
c AS (SELECT min(doc_id) AS rep, sh, len(sh) AS n FROM s WHERE len(sh) > 0 GROUP BY sh),
e AS (SELECT rep, n, unnest(sh) AS g FROM c),
f AS (SELECT g FROM e GROUP BY g HAVING count(*) > 1),
x AS (SELECT e.* FROM e JOIN f ON e.g = f.g),
p AS (SELECT a.rep AS a, b.rep AS b, count(*) AS o, any_value(a.n) AS na, any_value(b.n) AS nb
      FROM x a JOIN x b ON a.g = b.g AND a.rep < b.rep AND 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n GROUP BY a.rep, b.rep),
l AS (SELECT a, b FROM p WHERE 100 * o >= 85 * (na + nb - o)),
u AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT a AS node, a AS other FROM u UNION SELECT r.node, u.b FROM r JOIN u ON r.other = u.a),
m AS (SELECT node, min(other) AS root FROM r GROUP BY node)
SELECT s.doc_id, len(s.sh)::BIGINT AS n_shingles, coalesce(m.root, c.rep, s.doc_id) AS component_id
FROM s LEFT JOIN c ON s.sh = c.sh LEFT JOIN m ON m.node = c.rep
"""


@query("op10_substring_dedup")
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.substring import remove_repeats
    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("_n_words").alias("n_words"), F.col("_n_removed").alias("n_removed"), F.col("_sha256").alias("kept_sha256"))


ORACLE["op10_substring_dedup"] = f"""
WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
v AS (SELECT doc_id, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50),
k AS (SELECT v.doc_id, v.i, md5(array_to_string(d.w[v.i:v.i + 49], ' ')) AS h FROM v JOIN d ON v.doc_id = d.doc_id),
f AS (SELECT h, min(doc_id) AS first_id FROM k GROUP BY h),
g AS (SELECT k.doc_id, k.i FROM k JOIN f ON k.h = f.h AND f.first_id < k.doc_id),
o AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM g),
q AS (SELECT doc_id, list(j) AS gone FROM o GROUP BY doc_id),
t AS (SELECT d.doc_id, d.w, q.gone, CASE WHEN q.gone IS NULL THEN d.w ELSE
        list_transform(list_filter(range(1, len(d.w) + 1), lambda j: NOT list_contains(q.gone, j)), lambda j: d.w[j]) END AS kept
      FROM d LEFT JOIN q ON d.doc_id = q.doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256 FROM t
"""


@query("op8_embedding_near_dedup")
def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.vectors import near_vectors
    return near_vectors(table(spark, sf_dir, "embeddings"))


ORACLE["op8_embedding_near_dedup"] = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings),
z AS (SELECT vec_id, x, sqrt(list_dot_product(x, x)) AS norm FROM v
      WHERE x IS NOT NULL AND len(list_filter(x, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND list_dot_product(x, x) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM z a JOIN z b
      ON a.vec_id <> b.vec_id AND list_dot_product(a.x, b.x) / (a.norm * b.norm) >= 0.9),
r AS (SELECT a AS node, a AS other FROM l UNION SELECT r.node, l.b FROM r JOIN l ON r.other = l.a),
m AS (SELECT node, min(other) AS root FROM r GROUP BY node),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, coalesce(m.root, v.vec_id) AS component_id,
  coalesce(m.root, v.vec_id) = v.vec_id AS kept
FROM v LEFT JOIN n ON n.a = v.vec_id LEFT JOIN m ON m.node = v.vec_id
"""


@query("op6_language_id")
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.langid import identify
    return identify(table(spark, sf_dir, "documents"))


@query("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.toxicity import toxicity
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op11_conversation_repair")
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.conversations import damage, repair_report
    conversations = table(spark, sf_dir, "conversations")
    told = repair_report(damage(conversations)).withColumnRenamed("conv_id", "_conv")
    every = conversations.select("conv_id").distinct()
    met = every.join(told.hint("merge"), F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return met.select("conv_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in numbers], F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


@query("op13_spelling_variants")
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.spelling import group_variants, mistyped, runs, vocabulary
    found = runs(table(spark, sf_dir, "documents")).select(mistyped(F.col("doc_id"), F.col("run")).alias("word"))
    return group_variants(vocabulary(found))


# crc32 of a string's bytes, by a table that a rule makes
_CRC_TABLE = ("(SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)), "
              "lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc)")
_CRC32 = ("xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(octet_length(encode({0}))), "
          "lambda i: ('0x' || substr(hex({0}), (2 * i + 1)::INT, 2))::BIGINT)), "
          "lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255)::INT + 1])), 4294967295)")

ORACLE["op13_spelling_variants"] = f"""
WITH RECURSIVE t AS {_CRC_TABLE},
r AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
c AS (SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS k, run, count(*) AS times FROM r GROUP BY ALL),
h AS (SELECT run, times, {_CRC32.format('k')} AS h FROM c, t),
m AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, times FROM h),
v AS (SELECT word, sum(times)::BIGINT AS n FROM m WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
p AS (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM v),
d AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM p),
e AS (SELECT a.word AS u, b.word AS near, b.n FROM d a JOIN d b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
      UNION SELECT d.word, v.word, v.n FROM d JOIN v ON d.less = v.word
      UNION SELECT v.word, d.word, d.n FROM d JOIN v ON d.less = v.word),
b AS (SELECT u, count(*) AS n_near, max(n) AS top, arg_min(near, (-n, near)) AS best FROM e GROUP BY u),
f AS (SELECT v.word, CASE WHEN b.top >= 2 * v.n THEN b.best END AS form, v.n, coalesce(b.n_near, 0)::BIGINT AS n_near,
        CASE WHEN b.top >= 2 * v.n THEN b.top END AS form_n FROM v LEFT JOIN b ON v.word = b.u),
g AS (SELECT word, word AS root, 0 AS step FROM f UNION ALL SELECT g.word, f.form, step + 1 FROM g JOIN f ON g.root = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, arg_max(g.root, g.step) AS root, f.n, f.n_near, f.form_n FROM f JOIN g ON f.word = g.word GROUP BY ALL
"""


@query("op12_suffix_array_dedup")
def op12_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.suffixes import remove_repeated_bytes
    out = remove_repeated_bytes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("_n_bytes").alias("n_bytes"), F.col("_n_removed").alias("n_removed"),
                      F.col("_n_spans").alias("n_spans"), F.sha2("_kept", 256).alias("kept_sha256"))
