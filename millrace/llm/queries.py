"""The registered queries of the operators, and the SQL that gives the same rows."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import table, with_package
from millrace.llm.conversations import damaged, repair_blocks, repair_conversations
from millrace.llm.embedding_dedup import near_duplicates
from millrace.llm.exact_dedup import exact_duplicates
from millrace.llm.ngram_join import similar_documents
from millrace.llm.packing import pack
from millrace.llm.page_text import extract_text
from millrace.llm.periodic_runs import periodic_runs, with_planted_runs
from millrace.llm.pieces import encode_and_decode
from millrace.llm.sharding import byte_shards
from millrace.llm.substring_dedup import repeated_passages
from millrace.llm.toxicity import toxicity
from millrace.llm.urls import judge_urls
from millrace.llm.warc import read_archive, write_archive
from millrace.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = functools.wraps(fn)(lambda spark, sf_dir: fn(with_package(spark), sf_dir))
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document."""
    scored, _ = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.drop("spans")


@query("op2_embedding_dedup")
def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its number of links and its component."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op3_ngram_join", """
WITH w AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x20\\x09-\\x0D]+') AS words
    FROM documents
), s AS (
    SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN []
        WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
        ELSE list_transform(range(1, len(words) - 3),
                            lambda i: array_to_string(list_slice(words, i, i + 4), ' ')) END) AS grams
    FROM w
), g AS (SELECT doc_id, unnest(grams) AS gram FROM s),
n AS (SELECT doc_id, len(grams)::BIGINT AS n_shingles FROM s),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM g AS a JOIN g AS b ON a.gram = b.gram AND a.doc_id <> b.doc_id
    JOIN n AS x ON x.doc_id = a.doc_id JOIN n AS y ON y.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id
    HAVING 100 * count(*) >= 75 * (min(x.n_shingles) + min(y.n_shingles) - count(*))
), reach AS (
    WITH RECURSIVE r AS (
        SELECT doc_id, doc_id AS other FROM n
        UNION SELECT r.doc_id, links.b FROM r JOIN links ON r.other = links.a
    ) SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id
)
SELECT doc_id, n_shingles, component_id FROM n JOIN reach USING (doc_id)
""")
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its number of shingles and its component."""
    return similar_documents(table(spark, sf_dir, "documents"))


@query("op4_exact_dedup", """
WITH n AS (
    SELECT doc_id,
           sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
    FROM documents
)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM n WINDOW w AS (PARTITION BY text_sha256)
""")
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row of its group of equal texts that stays."""
    return exact_duplicates(table(spark, sf_dir, "documents"))


@query("op5_best_fit_packing")
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    return pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


@query("op6_pieces")
def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded to piece ids and decoded again."""
    model = functools.partial(tokenizer_file, "piece_bpe_32k.model")
    docs = encode_and_decode(table(spark, sf_dir, "documents"), model)
    return docs.select(
        "doc_id", F.size("ids").cast("long").alias("n_ids"),
        F.xxhash64("ids").alias("ids_hash"), F.crc32(F.col("decoded").cast("binary")).alias("decoded_crc32"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


@query("op7_substring_dedup")
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of a document that stands in other documents too."""
    return repeated_passages(table(spark, sf_dir, "documents"))


@query("op8_url_filter")
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    return judge_urls(table(spark, sf_dir, "pages")).drop("tokens")


@query("op9_warc", """
WITH n AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
           sha256(coalesce(html, '')) AS payload_digest
    FROM pages
), m AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM n)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END
           AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM m
""")
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to a content-addressed archive, and what is read back from it."""
    path = scratch_path(spark, "archive")
    write_archive(table(spark, sf_dir, "pages"), path)
    return read_archive(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query("op10_byte_shards")
def op10_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 contiguous shards of near-equal bytes."""
    return byte_shards(table(spark, sf_dir, "documents"))


@query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document, after repeats have been planted in a tenth of them."""
    found = periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")
    found = found.select("doc_id", "runs", "collapsed", longest.alias("m")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("m.col2")).alias("start"),
        F.col("m.length").alias("length"), (-F.col("m.col3")).alias("period"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
    return found.withColumn("exponent_milli", F.expr("1000 * length div period"))


@query("op12_conversation_repair", """
WITH RECURSIVE k AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
    FROM conversations
), c AS (
    SELECT *, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda x: ascii(x)::BIGINT)),
        lambda x, b: list_reduce([xor(x, b), 0, 0, 0, 0, 0, 0, 0, 0],
                                 lambda y, z: xor(y >> 1, 3988292384 * (y & 1))))) % 20 AS what
    FROM k
), d AS (
    SELECT conv_id, turn, CASE WHEN what = 4 THEN 'user' ELSE role END AS role,
           CASE what WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
    FROM c, range(CASE what WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)
), n AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
           regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS kept
    FROM d
), f AS (
    SELECT *, left(role, 1) AS r, left(lead(role) OVER (PARTITION BY conv_id ORDER BY i), 1) AS r2,
           count(*) OVER (PARTITION BY conv_id) AS n,
           CASE WHEN kept = '' THEN 'blank'
                WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                WHEN right(kept, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
    FROM n
), e AS (
    SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000000 WHEN fault = 'truncated' THEN 5 ELSE 0 END AS price
    FROM f
), v AS (
    SELECT DISTINCT conv_id, n + 1 AS i, 0::BIGINT AS v0, 10::BIGINT AS v1, 5::BIGINT AS v2, 0::BIGINT AS v3 FROM e
    UNION ALL
    SELECT conv_id, i, least(b0, b2 + 5, b3 + 10), least(b1, b2 + 5, b3 + 10), least(b2, b3 + 5), least(b3, b2 + 5)
    FROM (
        SELECT e.conv_id, e.i,
            least(v0 + 2, v2 + 1 + price, CASE r WHEN 's' THEN v1 + price WHEN 'u' THEN v2 + price END) AS b0,
            least(v1 + 2, v2 + 1 + price, CASE r WHEN 'u' THEN v2 + price END) AS b1,
            least(v2 + 2, v3 + 1 + price, CASE r WHEN 'a' THEN v3 + price END) AS b2,
            least(v3 + 2, v2 + 1 + price, CASE r WHEN 'u' THEN v2 + price END) AS b3
        FROM v JOIN e ON e.conv_id IS NOT DISTINCT FROM v.conv_id AND e.i = v.i - 1
    )
), a AS (
    SELECT v.conv_id, v.i, [v0, v1, v2, v3] AS now, r, role, text, price
    FROM v LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM v.conv_id AND e.i = v.i
), w AS (
    SELECT conv_id, 1::BIGINT AS i, 0 AS s, '' AS audit, []::VARCHAR[] AS lines, 0::BIGINT AS cost FROM e WHERE i = 1
    UNION ALL
    SELECT conv_id, CASE edit WHEN 'I' THEN i ELSE i + 1 END,
           CASE edit WHEN 'D' THEN s WHEN 'K' THEN kept ELSE missing END, audit || edit,
           CASE edit WHEN 'D' THEN lines WHEN 'K' THEN list_append(lines, role || ':' || text)
                ELSE list_append(lines, wanted || ':' || CASE edit WHEN 'R' THEN text ELSE '' END) END,
           cost + CASE edit WHEN 'D' THEN 2 WHEN 'I' THEN 5 WHEN 'R' THEN price + 1 ELSE price END
    FROM (
        SELECT *, CASE WHEN r IS NOT NULL AND after[s + 1] + 2 = now[s + 1] THEN 'D'
                       WHEN now[missing + 1] + 5 = now[s + 1] THEN 'I'
                       WHEN after[kept + 1] + price = now[s + 1] THEN 'K' ELSE 'R' END AS edit
        FROM (
            SELECT w.*, a.now, b.now AS after, a.r, a.role, a.text, a.price,
                   CASE s WHEN 2 THEN 3 ELSE 2 END AS missing, CASE s WHEN 2 THEN 'assistant' ELSE 'user' END AS wanted,
                   CASE WHEN s = 0 AND a.r = 's' THEN 1 WHEN s = 2 AND a.r = 'a' THEN 3 WHEN s <> 2 AND a.r = 'u' THEN 2 END AS kept
            FROM w JOIN a ON a.conv_id IS NOT DISTINCT FROM w.conv_id AND a.i = w.i
            LEFT JOIN a AS b ON b.conv_id IS NOT DISTINCT FROM w.conv_id AND b.i = w.i + 1
            WHERE a.r IS NOT NULL OR s IN (1, 2)
        )
    )
), z AS (
    SELECT w.conv_id, w.audit, w.lines, w.cost FROM w
    JOIN (SELECT conv_id, max(i) AS i, max(length(audit)) AS l FROM w GROUP BY conv_id) AS m
      ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.i = w.i AND m.l = length(w.audit)
), g AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (i < n AND r || r2 NOT IN ('su', 'ua', 'au')) AS illegal
    FROM e GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS o
LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM o.conv_id
""")
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation with the faults of its damaged rows and the cheapest edits that repair it."""
    given = table(spark, sf_dir, "conversations")
    found = repair_conversations(repair_blocks(damaged(given)))
    sums = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    every = given.select(F.col("conv_id").cast("long").alias("id")).distinct()
    return every.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("id").alias("conv_id"), *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in sums),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"),
    )


@query("op13_main_text")
def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page, by the template of its host."""
    found = extract_text(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
