"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlark.llm import audit, bpe, licenses, lines, mixing, near_dedup, neighbours, quality, resample, secrets, suffixes, toxicity, vectors


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = quality.quality_rules(docs, keep_text=False)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "word_distance")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secrets.scan_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans")


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), size=3, num=85, den=100)


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("id") % 50 == 0, k=5)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.digest_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    out = toxicity.score_documents(docs, model)
    return out.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_matches")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("kept")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.plan_mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op11_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"), least=0.93)


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("text")
    return resample.resample(docs, target, share=(10, 100), least=20, seed="2024").select("doc_id", "n_features", "weight", "score", "rank")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text", "source"), table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return audit.audit(docs, labels)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_secrets": op2_secrets,
    "op3_near_dedup": op3_near_dedup,
    "op4_neighbours": op4_neighbours,
    "op5_line_dedup": op5_line_dedup,
    "op6_bpe_round_trip": op6_bpe_round_trip,
    "op7_toxicity": op7_toxicity,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_mixing": op9_mixing,
    "op10_licenses": op10_licenses,
    "op11_vector_dedup": op11_vector_dedup,
    "op12_resampling": op12_resampling,
    "op13_filter_audit": op13_filter_audit,
}

LOWERED = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def _licenses_sql() -> str:
    """Every alignment of every template, by a join on words."""
    quote = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    phrases = ", ".join(f"('{label}', {quote(p.split())}, ' {p} ')" for p, label in licenses.PHRASES.items())
    templates = ", ".join(f"({t}, '{label}', {quote(text.split())}, {quote(f' {k} ' for k in keys)})" for t, (label, text, keys) in enumerate(licenses.TEMPLATES))
    return rf"""
        WITH d AS (SELECT doc_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        j AS (SELECT *, ' ' || array_to_string(w, ' ') || ' ' AS s FROM d),
        p(label, words, inside) AS (VALUES {phrases}), t(t, label, words, keys) AS (VALUES {templates}),
        hit AS (SELECT doc_id, label, unnest(list_filter(range(len(w)), lambda i: w[i + 1:i + len(words)] = words)) AS i FROM j JOIN p ON contains(s, inside)),
        base AS (SELECT doc_id, count(*) AS n, min(i) AS lo, max(i) AS hi, list(DISTINCT label) AS labels FROM hit GROUP BY doc_id),
        can AS (SELECT doc_id, t, len(words) AS n FROM j JOIN t ON len(list_filter(keys, lambda k: contains(s, k))) > 0),
        tw AS (SELECT t, unnest(words) AS word, unnest(range(len(words))) AS place FROM t),
        dw AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS place FROM d WHERE doc_id IN (SELECT doc_id FROM can)),
        best AS (SELECT doc_id, t, max(k) AS k FROM (SELECT doc_id, t, dw.place - tw.place AS a, count(*) AS k FROM dw JOIN tw USING (word) GROUP BY ALL) GROUP BY ALL),
        own AS (SELECT doc_id, label, max(k / n::DOUBLE) AS share FROM can JOIN best USING (doc_id, t) JOIN t USING (t) GROUP BY ALL HAVING max(k / n::DOUBLE) >= {licenses.LEAST}),
        found AS (SELECT doc_id, list(label) AS labels, max(share) AS share FROM own GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(base.n, 0) AS n_base, lo AS first_word, hi AS last_word,
               array_to_string(list_sort(coalesce(base.labels, [])), ',') AS base_labels,
               array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(found.labels, [])))), ',') AS labels,
               CASE WHEN base.n > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0::DOUBLE) END AS score
        FROM d LEFT JOIN base USING (doc_id) LEFT JOIN found USING (doc_id)"""


SQL: dict[str, str] = {
    "op3_near_dedup": rf"""
        WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWERED}, '[^\x20\x09-\x0D]+') AS w FROM documents),
        e AS (SELECT doc_id, w, unnest(CASE WHEN len(w) >= 3 THEN range(1, len(w) - 1) WHEN len(w) > 0 THEN [1] ELSE [] END) AS i FROM d),
        s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS x FROM e),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
        l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
        k AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
        reach AS (SELECT doc_id, doc_id AS r FROM d UNION SELECT reach.doc_id, k.b FROM reach JOIN k ON reach.r = k.a)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) LEFT JOIN n USING (doc_id)""",
    "op8_substring_dedup": """
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        b AS (SELECT doc_id, k * 1000 AS o, substr(h, 2000 * k + 1, 2098) AS h FROM (SELECT *, unnest(range(len(h) // 2000 + 1)) AS k FROM d)),
        w AS (SELECT doc_id, o + i AS i, md5_number(substr(h, 2 * i + 1, 100)) AS s FROM (SELECT *, unnest(range(0, least(1000, len(h) // 2 - 49))) AS i FROM b)),
        m AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s HAVING count(*) > 1),
        hit AS (SELECT doc_id, i FROM w JOIN m USING (s) WHERE least < doc_id),
        g AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (
                SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS new FROM hit)),
        r AS (SELECT doc_id, min(i) AS lo, max(i) + 50 AS hi FROM g GROUP BY doc_id, run),
        x AS (SELECT *, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS before FROM r),
        k AS (SELECT doc_id, count(*) AS n_spans, sum(hi - lo) AS gone, max(hi) AS hi, string_agg(substr(h, 2 * before + 1, 2 * (lo - before)), '' ORDER BY lo) AS head FROM x JOIN d USING (doc_id) GROUP BY doc_id)
        SELECT doc_id, len(h) // 2 AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(hi, 0) + 1))) AS kept_sha256
        FROM d LEFT JOIN k USING (doc_id)""",
    "op10_licenses": _licenses_sql(),
    "op5_line_dedup": r"""
        WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
        e AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM d),
        k AS (SELECT *, regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS key FROM e),
        c AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE c.key IS NOT NULL) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
        FROM k LEFT JOIN c USING (key) GROUP BY doc_id""",
    "op9_mixing": r"""
        WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
        s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
        r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM s),
        w AS (SELECT *, CAST(k % 3 + 1 AS DOUBLE) AS w, source_size * 3.0::DOUBLE AS cap FROM r),
        l AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE)
                  - coalesce(sum(cap) OVER (ORDER BY cap / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                  / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM w),
        f AS (SELECT arg_min(level, {'r': cap / w, 'k': k}) AS level FROM l WHERE cap >= level * w),
        t AS (SELECT source, source_size, least(cap, coalesce(f.level * w, cap)) AS target FROM l, f),
        j AS (SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
                     CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null ' || text)), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u
              FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
        SELECT doc_id, size, source_size, target,
               CAST((floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) * size AS BIGINT) AS taken FROM j""",
    "op11_vector_dedup": """
        WITH RECURSIVE e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
        u AS (SELECT *, sqrt(list_dot_product(v, v)) AS n FROM e WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
        l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id WHERE list_dot_product(a.v, b.v) / (a.n * b.n) >= 0.93::DOUBLE),
        k AS (SELECT a, count(*) AS n FROM l GROUP BY a),
        reach AS (SELECT vec_id, vec_id AS r FROM e UNION SELECT reach.vec_id, l.b FROM reach JOIN l ON reach.r = l.a)
        SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id) c LEFT JOIN k ON k.a = c.vec_id""",
    "op12_resampling": rf"""
        WITH tab AS (SELECT list_transform(range(256), lambda x: list_reduce(list_concat([x], range(8)), lambda c, i: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
        d AS (SELECT doc_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        x AS (SELECT word, count(*) AS n FROM (SELECT unnest(w) AS word FROM d) GROUP BY word),
        y AS (SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark) GROUP BY word),
        h AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM x UNION SELECT word FROM y)),
        b AS (SELECT word, xor(list_reduce(list_concat([4294967295], list_transform(range(len(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))), lambda c, v: xor(t[(xor(c, v) & 255) + 1], c >> 8)), 4294967295) % 10000 AS bucket FROM h, tab),
        s AS (SELECT bucket, sum(n) AS n FROM x JOIN b USING (word) GROUP BY bucket), t AS (SELECT bucket, sum(n) AS n FROM y JOIN b USING (word) GROUP BY bucket),
        z AS (SELECT (SELECT coalesce(sum(n), 0) FROM s)::DOUBLE + 10000 AS big_s, (SELECT coalesce(sum(n), 0) FROM t)::DOUBLE + 10000 AS big_t),
        g AS (SELECT word, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * big_s / ((coalesce(s.n, 0) + 1)::DOUBLE * big_t))) AS BIGINT) AS gain FROM b LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket), z),
        k AS (SELECT doc_id, CAST(sum(gain) AS BIGINT) AS weight FROM (SELECT doc_id, unnest(w) AS word FROM d) JOIN g USING (word) GROUP BY doc_id),
        o AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
                     coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM d LEFT JOIN k USING (doc_id)),
        r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM o WHERE n_features >= 20)
        SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT count(*) FROM r) * 10 // 100 THEN rank END AS rank FROM o LEFT JOIN r USING (doc_id)""",
    "op13_filter_audit": r"""
        WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        q AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
        f AS (SELECT d.doc_id, part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
                     100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * len(t) AS c, regexp_matches(t, '[#$%&*|]') AS dd,
                     coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false) AS e FROM d LEFT JOIN q ON q.doc_id = d.doc_id),
        m AS (SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * dd::INT + 16 * e::INT AS mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
        l(x, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
        p AS (SELECT v.x || w.x || y.x || z.x || u.x AS filter_order, [v.bit, w.bit, y.bit, z.bit, u.bit] AS bits FROM l v, l w, l y, l z, l u WHERE v.bit | w.bit | y.bit | z.bit | u.bit = 31),
        s AS (SELECT filter_order, CAST(k AS INTEGER) AS step, bits[k] AS bit, coalesce(list_sum(bits[1:k - 1]), 0) AS before FROM p, range(1, 6) r(k)),
        o AS (SELECT part, filter_order, step, bit,
                     coalesce(sum(n) FILTER (WHERE mask & (before | bit) = 0), 0) AS kept, coalesce(sum(n) FILTER (WHERE mask & bit > 0 AND mask & before = 0), 0) AS removed,
                     coalesce(sum(n) FILTER (WHERE mask & bit > 0 AND mask & before > 0), 0) AS redundant, coalesce(sum(n) FILTER (WHERE mask = bit), 0) AS unique_fails,
                     coalesce(sum(good) FILTER (WHERE mask & bit > 0 AND mask & before = 0), 0) AS good_lost, coalesce(sum(toxic) FILTER (WHERE mask & bit > 0 AND mask & before = 0), 0) AS toxic_lost
              FROM m, (SELECT filter_order, step, bit::BIGINT AS bit, before::BIGINT AS before FROM s) s GROUP BY ALL)
        SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
               CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM o""",
}
