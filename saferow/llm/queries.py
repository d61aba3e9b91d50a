"""The registered queries, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saferow.llm import (binary, decontam, langid, mixing, quality, resampling, simhash, suffixarray, suffixtree,
                         tokens, toxicity, warc, whitening)
from saferow.llm.common import scratch, table

try:  # the folder of public vocabularies is a parameter; this is its usual place
    import public_tokenizers
except ImportError:
    public_tokenizers = None


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    if public_tokenizers is None:
        raise RuntimeError("no public_tokenizers: pass the path of the vocabulary to the operator")
    return public_tokenizers.path(name)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix(mixing.units_of(table(spark, sf_dir, "documents")))
    rows = plan.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int"))))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), vocabulary())


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = binary.write_token_files(table(spark, sf_dir, "documents"), scratch(spark, "token-frames"), vocabulary())
    return binary.read_token_files(manifest)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixarray.deduplicate(table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixtree.deduplicate(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(table(spark, sf_dir, "pages"), scratch(spark, "archives"))
    return warc.read_archives(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = whitening.whitened(table(spark, sf_dir, "embeddings"))
    return got.withColumn("deviation", F.col("deviation").cast("long"))


def op13_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {f.__name__: f for f in (op1_mix_sources, op2_token_counts, op3_toxicity, op4_language, op5_token_files,
                                   op6_decontaminate, op7_suffix_array_dedup, op8_substring_dedup, op9_quality,
                                   op10_simhash, op11_warc, op12_whitening, op13_target_resampling)}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

#: SQL of the base32 spelling of a hex digest (5 hex digits are 4 letters).
_BASE32 = """array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + (((('0x' || substr(HEX, 1 + (i // 4) * 5, 5))::INT) >> (15 - 5 * (i % 4))) & 31), 1)), '')"""

ORACLE = {
    "op11_warc": f"""
    WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
    h AS (SELECT page_id, octet_length(encode(body)) AS payload_bytes, sha1(body) AS hex,
                 min(page_id) OVER (PARTITION BY body) AS least FROM p)
    SELECT page_id, payload_bytes, {_BASE32.replace("HEX", "hex")} AS payload_digest,
           CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> least THEN least END AS refers_to FROM h""",
    "op13_target_resampling": r"""
    WITH tab AS (SELECT list(v ORDER BY i) AS crc_of FROM (
        SELECT i, list_reduce(list_prepend(i, range(0, 8)),
                   lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
        FROM (SELECT unnest(range(0, 256)) AS i))),
    texts AS (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
    w AS (SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
    runs AS (SELECT kind, id, unnest(w) AS f FROM w
             UNION ALL SELECT kind, id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w),
    names AS (SELECT f, encode(f) AS raw FROM (SELECT DISTINCT f FROM runs)),
    bytes AS (SELECT f, list_transform(range(0, octet_length(raw)),
                     lambda i: ('0x' || substr(hex(raw), 2 * i + 1, 2))::BIGINT) AS b FROM names),
    bucket AS (SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, b),
                    lambda c, x: xor(c >> 8, crc_of[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS k FROM bytes, tab),
    counted AS (SELECT k, count(*) FILTER (kind = 'd') AS s, count(*) FILTER (kind = 'b') AS t
                FROM runs JOIN bucket USING (f) GROUP BY 1),
    totals AS (SELECT sum(s)::DOUBLE AS alls, sum(t)::DOUBLE AS allt FROM counted),
    gain AS (SELECT k, floor(1000 * ln(((t + 1)::DOUBLE * (alls + 10000)) / ((s + 1)::DOUBLE * (allt + 10000))))::BIGINT AS g
             FROM counted, totals),
    sums AS (SELECT id, count(*) AS n, sum(g) AS total FROM runs JOIN bucket USING (f) JOIN gain USING (k)
             WHERE kind = 'd' GROUP BY 1),
    d AS (SELECT w.id AS doc_id, len(w.w) AS n_words, coalesce(n, 0) AS n_features,
                 CASE WHEN n > 0 THEN floor(total / n)::BIGINT ELSE 0 END AS weight,
                 ('0x' || substr(sha256('7:' || w.id), 1, 8))::BIGINT AS h
          FROM w LEFT JOIN sums ON sums.id = w.id WHERE kind = 'd'),
    scored AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM d),
    ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n
               FROM scored WHERE n_words >= 20)
    SELECT scored.doc_id, n_features, weight, score, CASE WHEN r <= (25 * n) // 100 THEN r END AS rank
    FROM scored LEFT JOIN ranked ON ranked.doc_id = scored.doc_id""",
    "op8_substring_dedup": f"""
    WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
    p AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50),
    win AS (SELECT doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS h FROM p),
    low AS (SELECT h, min(doc_id) AS least FROM win GROUP BY 1),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS k FROM win JOIN low USING (h) WHERE doc_id > least),
    each_word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS k FROM d),
    kept AS (SELECT e.doc_id, string_agg(e.x, ' ' ORDER BY e.k) AS t, count(*) AS n
             FROM each_word e ANTI JOIN gone g ON g.doc_id = e.doc_id AND g.k = e.k GROUP BY 1)
    SELECT d.doc_id, len(d.w) AS n_words, len(d.w) - coalesce(kept.n, 0) AS n_removed,
           sha256(coalesce(kept.t, '')) AS kept_sha256
    FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id""",
    "op6_decontaminate": r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    iw AS (SELECT DISTINCT item_id, least(len(w), 10) AS size,
                  unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1),
                         lambda i: array_to_string(w[i : i + least(len(w), 10) - 1], ' '))) AS win
           FROM b WHERE len(w) > 0),
    sizes AS (SELECT DISTINCT size FROM iw),
    dw AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size),
    m AS (SELECT dw.doc_id, iw.item_id, dw.i, dw.size
          FROM (SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS win FROM dw) dw
          JOIN iw ON iw.size = dw.size AND iw.win = dw.win),
    h AS (SELECT doc_id, count(DISTINCT p) AS n_hit
          FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM m) GROUP BY 1),
    it AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
           FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM m) GROUP BY 1)
    SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(it.n_items, 0) AS n_items,
           sha256(coalesce(it.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN h ON h.doc_id = d.doc_id LEFT JOIN it ON it.doc_id = d.doc_id""",
}
