"""The queries of this subpackage, by name, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, jaccard, language, lines, middle, minhash, mixing, packing, perplexity, quality, radix, sharding, warc
from .common import small_batches


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, table(spark, sf_dir, "pages")).drop("url", "problem")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def remainder(doc_id: str, n: int) -> Column:
    """crc32 of the number as text, modulo n."""
    return F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % n


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    model = language.train(docs, ~held_out)
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    model = quality.train(docs, table(spark, sf_dir, "labels"), ~held_out)
    return quality.score_documents(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc.doc_id", "n_lines", "n_dropped", "doc.text")


def op6_ngram_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.quality_rules(table(spark, sf_dir, "documents"))


def op7_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_groups(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radix.exact_groups(table(spark, sf_dir, "documents"))


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokenizers(table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    forms = middle.fill_in_middle(table(spark, sf_dir, "documents"))
    restored = middle.restore(F.col("output"), F.col("form"))
    return forms.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored, 256).alias("restored_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_sharding": op2_sharding,
    "op3_language_id": op3_language_id,
    "op4_quality": op4_quality,
    "op5_line_dedup": op5_line_dedup,
    "op6_ngram_perplexity": op6_ngram_perplexity,
    "op7_pfair_mixing": op7_pfair_mixing,
    "op8_ngram_jaccard": op8_ngram_jaccard,
    "op9_packing": op9_packing,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_minhash": op11_minhash,
    "op12_alignment": op12_alignment,
    "op13_fill_in_middle": op13_fill_in_middle,
}

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_PARTS = " || ".join(
    f"substr('{_BASE32}', 1 + ((('0x' || substr(sha1(body), {5 * i + 1}, 5))::BIGINT >> {s}) & 31)::INT, 1)"
    for i in range(8) for s in (15, 10, 5, 0)
)

SQL: dict[str, str] = {
    "op1_warc": f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
        d AS (SELECT page_id, strlen(body) AS payload_bytes, {_PARTS} AS payload_digest, body FROM p),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY body) AS first_id FROM d)
        SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
            CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN page_id > first_id THEN first_id END AS refers_to
        FROM f""",
    # levenshtein() counts bytes here: the characters, fewer than 127 in the given tables, are renamed to single bytes.
    "op5_line_dedup": """
        WITH RECURSIVE chars AS (SELECT c, row_number() OVER (ORDER BY c) AS k
            FROM (SELECT DISTINCT unnest(string_split(text, '')) AS c FROM documents)),
        maps AS MATERIALIZED (SELECT string_agg(c, '' ORDER BY k) AS a, string_agg(chr(k::INT), '' ORDER BY k) AS b FROM chars),
        placed AS MATERIALIZED (SELECT doc_id, pos AS line_no, parts[pos] AS raw, trim(parts[pos], ' ') AS line
            FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS pos
                FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))),
        kinds AS MATERIALIZED (SELECT DISTINCT line, length(line) AS n, translate(line, a, b) AS m
            FROM placed, maps WHERE trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> ''),
        links AS MATERIALIZED (SELECT x.line AS x, y.line AS y FROM kinds x JOIN (SELECT *, unnest([-2, -1, 0, 1, 2]) AS d FROM kinds) y
            ON x.n = y.n + y.d WHERE x.n >= 20 AND y.n >= 20 AND x.line <> y.line AND levenshtein(x.m, y.m) <= 2),
        reach AS (SELECT line AS x, line AS y FROM kinds UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
        groups AS (SELECT x AS line, min(y) AS g FROM reach GROUP BY x),
        marked AS (SELECT placed.*, g, row_number() OVER (PARTITION BY g ORDER BY doc_id, line_no) AS k FROM placed LEFT JOIN groups USING (line))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (g IS NOT NULL AND k > 1) AS n_dropped,
            coalesce(string_agg(raw, chr(10) ORDER BY line_no) FILTER (g IS NULL OR k = 1), '') AS text
        FROM marked GROUP BY doc_id""",
    "op8_ngram_jaccard": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS shingle
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
        n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        links AS MATERIALIZED (
            SELECT p.x, p.y FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS overlap FROM s a JOIN s b USING (shingle)
                WHERE a.doc_id <> b.doc_id GROUP BY ALL) p JOIN n nx ON nx.doc_id = p.x JOIN n ny ON ny.doc_id = p.y
            WHERE 100 * overlap >= 75 * (nx.n + ny.n - overlap)),
        reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
        SELECT r.x AS doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.y) AS component_id
        FROM reach r LEFT JOIN n ON n.doc_id = r.x GROUP BY r.x""",
    "op10_exact_dedup": r"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
        g AS (SELECT *, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM n)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g""",
    "op11_minhash": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i:i + 1], ' ') AS shingle
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM d WHERE len(w) > 0)),
        n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        links AS MATERIALIZED (
            SELECT p.x, p.y FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS overlap FROM s a JOIN s b USING (shingle)
                WHERE a.doc_id <> b.doc_id GROUP BY ALL) p JOIN n nx ON nx.doc_id = p.x JOIN n ny ON ny.doc_id = p.y
            WHERE 100 * overlap >= 80 * (nx.n + ny.n - overlap)),
        reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
        SELECT r.x AS doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.y) AS component_id, r.x = min(r.y) AS kept
        FROM reach r LEFT JOIN n ON n.doc_id = r.x GROUP BY r.x""",
    "op13_fill_in_middle": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
        u AS (SELECT *, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS units, ('0x' || substr(h, 1, 8))::BIGINT AS h1,
            ('0x' || substr(h, 9, 8))::BIGINT AS h2, ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
        c AS (SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS lo,
            greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS hi FROM u),
        p AS (SELECT *, coalesce(array_to_string(units[1:lo], ''), '') AS pre, coalesce(array_to_string(units[lo + 1:hi], ''), '') AS mid,
            coalesce(array_to_string(units[hi + 1:], ''), '') AS suf,
            CASE WHEN t = '' OR h3 % 100 >= 90 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
                WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM c)
        SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
            CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
            sha256(t) AS restored_sha256 FROM p""",
}
