"""The registered queries of this folder, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brackish.llm import alignment, centroids, decontam, langid, lines, mixing, packing, pages, quality, simhash, substring, toxicity, vectors
from brackish.llm.texts import fold
from brackish.session import in_utc
from brackish.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER, PIECE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def query(name: str, sql: str | None = None):
    def keep(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(in_utc(spark), folder)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn

    return keep


def _sha(column: str):
    return F.sha2(F.col(column).cast("binary"), 256)


@query("op1_language_id")
def op1_language_id(spark, folder):
    docs = table(spark, folder, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    profiles = langid.fit_profiles(docs.where(~held_out))
    found = langid.identify(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def _tokens_sql(source: str, key: str) -> str:
    """Tokens of a table's texts; placeholders stand in front of their values."""
    text = "coalesce(text, '')"
    for _ in range(2):
        text = f"regexp_replace({text}, '([\\p{{Ll}}\\p{{N}},;\\x01] )(\\p{{Lu}}\\p{{Ll}}+)', '\\1' || chr(1) || '\\2', 'g')"
    text = f"regexp_replace({text}, '(\\p{{N}}+(?:[.,]\\p{{N}}+)*)', ' ' || chr(2) || '\\1 ', 'g')"
    text = f"regexp_replace({text}, '(\\x02[\\p{{N}}.,]*) +(%|(?:{'|'.join(decontam.UNITS)})\\b)', '\\1 ' || chr(3) || '\\2', 'g')"
    between = r"(?:[^\p{L}\p{M}\p{N}\x01\x02\x03.,]|[.,]+(?:[^\p{N}]|$))+"
    return f"SELECT {key}, list_filter(regexp_split_to_array({text}, '{between}'), lambda t: t <> '') AS tokens FROM {source} WHERE {key} IS NOT NULL"


def _windows_sql(source: str, key: str, length: str) -> str:
    return f"""
        SELECT {key}, pos, array_to_string(list_transform(part, lambda t: CASE WHEN t[1] IN (chr(1), chr(2), chr(3)) THEN t[1] ELSE lower(t) END), ' ') AS form,
               list_transform(list_filter(part, lambda t: t[1] IN (chr(1), chr(2), chr(3))), lambda t: substring(t, 2)) AS slots,
               len(list_filter(part, lambda t: t[1] NOT IN (chr(1), chr(2), chr(3)))) AS literals
        FROM (SELECT {key}, pos, list_slice(tokens, pos, pos + n - 1) AS part
              FROM (SELECT {key}, tokens, n, unnest(generate_series(1, len(tokens) - n + 1)) AS pos FROM (SELECT *, {length} FROM {source})))"""


@query(
    "op2_decontam",
    f"""
    WITH docs AS ({_tokens_sql("documents", "doc_id")}), items AS ({_tokens_sql("benchmark", "item_id")}),
    lengths AS (SELECT 8 AS n UNION SELECT len(tokens) FROM items WHERE len(tokens) BETWEEN 5 AND 7),
    there AS (SELECT * FROM ({_windows_sql("items", "item_id", "least(len(tokens), 8) AS n")}) WHERE literals >= 5),
    here AS (SELECT * FROM ({_windows_sql("docs", "doc_id", "unnest((SELECT list(n) FROM lengths)) AS n")}) WHERE literals >= 5),
    sizes AS (SELECT item_id, count(*) AS item_windows FROM there GROUP BY item_id),
    met AS (SELECT h.doc_id, t.item_id, h.pos - t.pos AS line, t.pos, list_zip(t.slots, h.slots) AS pairs FROM here h JOIN there t ON h.form = t.form),
    aligned AS (SELECT doc_id, item_id, line, list(pos) AS spots, list_distinct(flatten(list(pairs))) AS pairs FROM met GROUP BY ALL),
    found AS (
        SELECT doc_id, item_id, CAST(len(list_distinct(flatten(list(spots)))) AS BIGINT) AS matched_windows,
               CAST(max(len(list_filter(pairs, lambda p: p[1] <> p[2]))) AS BIGINT) AS changed_slots
        FROM aligned WHERE len(pairs) = len(list_distinct(list_transform(pairs, lambda p: p[1]))) GROUP BY doc_id, item_id)
    SELECT doc_id, item_id, matched_windows, item_windows, changed_slots, changed_slots = 0 AS exact
    FROM found JOIN sizes USING (item_id) WHERE matched_windows >= least(6, item_windows)
    """,
)
def op2_decontam(spark, folder):
    return decontam.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op3_toxicity")
def op3_toxicity(spark, folder):
    docs, labels = table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = toxicity.fit(docs.where(~held_out), labels.where(~held_out), "toxic")
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("op4_simhash")
def op4_simhash(spark, folder):
    groups = simhash.near_groups(table(spark, folder, "documents"), words=3, bits=3)
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


# A line's key in SQL: white space of ASCII off both ends, A-Z lower-cased.
_SQL_KEY = "translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op5_line_dedup",
    f"""
    WITH cut AS (
        SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
    keyed AS (SELECT doc_id, pos, line, {_SQL_KEY} AS key FROM cut),
    repeated AS (
        SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20
        GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
    judged AS (
        SELECT k.doc_id, k.pos, k.line, r.key IS NOT NULL AND k.doc_id < r.last AS gone
        FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
    SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
    FROM judged GROUP BY doc_id
    """,
)
def op5_line_dedup(spark, folder):
    cut = lines.dedupe_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_dropped", _sha("text").alias("kept_sha256"))


@query(
    "op6_top_k",
    """
    WITH usable AS (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT q.vec_id AS query_id, c.vec_id,
               CAST(list_sum(list_transform(generate_series(1, len(q.v)), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
        FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0),
    placed AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
    SELECT query_id, rank, vec_id, score FROM placed WHERE rank <= 10
    """,
)
def op6_top_k(spark, folder):
    return vectors.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, k=10, scale=1024.0)


@query(
    "op7_substring_dedup",
    """
    WITH split AS (
        SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '') AS words FROM documents),
    starts AS (
        SELECT doc_id, words, unnest(generate_series(1, len(words) - 49)) AS pos FROM split WHERE len(words) >= 50),
    windows AS (SELECT doc_id, pos, hash(list_slice(words, pos, pos + 49)) AS h FROM starts),
    late AS (
        SELECT doc_id, list(pos) AS spots FROM (
            SELECT doc_id, pos, min(doc_id) OVER (PARTITION BY h) AS low FROM windows) WHERE low < doc_id GROUP BY doc_id),
    covered AS (
        SELECT doc_id, list_distinct(flatten(list_transform(spots, lambda p: generate_series(p, p + 49)))) AS gone FROM late),
    kept AS (
        SELECT s.doc_id, s.words, c.gone, list_sort(coalesce(c.gone, [])) AS sorted FROM split s LEFT JOIN covered c USING (doc_id)),
    each AS (
        SELECT doc_id, len(words) AS n_words, len(sorted) AS n_removed,
               CASE WHEN gone IS NULL THEN words
                    ELSE list_transform(list_filter(generate_series(1, len(words)), lambda i: NOT list_contains(sorted, i)), lambda i: words[i]) END AS left_over
        FROM kept)
    SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
           sha256(coalesce(array_to_string(left_over, ' '), '')) AS kept_sha256
    FROM each
    """,
)
def op7_substring_dedup(spark, folder):
    cut = substring.drop_repeats(table(spark, folder, "documents").select("doc_id", "text"), window=50)
    return cut.select("doc_id", "n_words", "n_removed", _sha("text").alias("kept_sha256"))


@query("op8_main_text")
def op8_main_text(spark, folder):
    return pages.extract(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


@query("op9_quality")
def op9_quality(spark, folder):
    docs, labels = table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels")
    held_out = fold(F.col("doc_id"), 3) == 1
    model = quality.fit(docs.where(~held_out), labels.where(~held_out), "quality")
    return quality.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("op10_packing")
def op10_packing(spark, folder):
    return packing.pack(table(spark, folder, "documents"), TOKENIZER, end_id=2, window=4096)


def _rounds_sql(rounds: int) -> str:
    """Lloyd's rounds as one chain of tables: centroids c0, assignments a0, centroids c1, ..."""
    apart = "list_sum(list_transform(generate_series(1, 64), lambda i: (k.v[i] - c.v[i]) * (k.v[i] - c.v[i])))"
    parts = []
    for n in range(rounds + 1):
        parts.append(f"""a{n} AS MATERIALIZED (
            SELECT row, any_value(vec_id) AS vec_id, arg_min(num, (d, num)) AS cluster, CAST(min(d) AS BIGINT) AS distance
            FROM (SELECT k.row, k.vec_id, c.num, {apart} AS d FROM kept k CROSS JOIN c{n} c) GROUP BY row)""")
        if n < rounds:
            parts.append(f"""m{n} AS (
            SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v
            FROM (SELECT cluster, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
                  FROM (SELECT a.cluster, unnest(k.v) AS x, generate_subscripts(k.v, 1) AS i FROM a{n} a JOIN kept k USING (row)) GROUP BY cluster, i)
            GROUP BY cluster),
        c{n + 1} AS MATERIALIZED (SELECT c.num, coalesce(m.v, c.v) AS v FROM c{n} c LEFT JOIN m{n} m ON c.num = m.cluster)""")
    return ",\n        ".join(parts)


@query(
    "op11_centroids",
    f"""
    WITH kept AS MATERIALIZED (
        SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    c0 AS MATERIALIZED (
        SELECT CAST(row_number() OVER (ORDER BY draw NULLS LAST) - 1 AS INTEGER) AS num, v
        FROM (SELECT v, sha256('3:' || CAST(vec_id AS VARCHAR)) AS draw FROM kept ORDER BY draw NULLS LAST LIMIT 8)),
        {_rounds_sql(10)}
    SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
           CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
    FROM a10 JOIN c10 c ON c.num = cluster
    """,
)
def op11_centroids(spark, folder):
    found = centroids.cluster(table(spark, folder, "embeddings"), k=8, rounds=10, tag="3")
    number = F.col("cluster") + 1
    hashes = F.array(*[F.sha2(F.lit(",".join(map(str, c))).cast("binary"), 256) for c in found.centroids.tolist()] or [F.lit("")])
    inertias = F.array(*[F.lit(i).cast("long") for i in found.inertias or [0]])
    return found.rows.select(
        F.col("key").alias("vec_id"), "cluster", "distance", F.element_at(inertias, number).alias("cluster_inertia"),
        F.lit(sum(found.inertias)).cast("long").alias("inertia"), F.element_at(hashes, number).alias("centroid_sha256"),
    )


@query(
    "op12_mixing",
    """
    WITH sized AS (
        SELECT row_number() OVER () AS row, doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
               coalesce(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT), 0) AS place
        FROM documents),
    sources AS (
        SELECT source, row_number() OVER (ORDER BY source NULLS LAST) AS source_no, CAST(sum(size) AS BIGINT) AS source_size
        FROM sized GROUP BY source),
    rated AS (
        SELECT *, source_size * CAST(2 AS DOUBLE) AS most, CAST([3, 1, 2][(source_no - 1) % 3 + 1] AS DOUBLE) AS weight FROM sources),
    upto AS (
        SELECT *, sum(most) OVER w - most AS full_before, sum(weight) OVER w - weight AS weight_before,
               1.5 * sum(source_size) OVER () AS budget, sum(weight) OVER () AS weights, row_number() OVER w AS spot
        FROM rated WINDOW w AS (ORDER BY most / weight, source_no ROWS UNBOUNDED PRECEDING)),
    level AS (
        SELECT CAST(budget - full_before AS DOUBLE) / (weights - weight_before) AS level FROM upto
        WHERE CAST(budget - full_before AS DOUBLE) * weight <= most * (weights - weight_before) ORDER BY spot LIMIT 1),
    goals AS (SELECT source, source_no, source_size, least(most, weight * level) AS target, CAST(floor(budget) AS BIGINT) AS budget FROM upto, level),
    queued AS (
        SELECT row, doc_id, size, source_no, source_size, target, budget,
               CAST(sum(size) OVER (PARTITION BY source_no ORDER BY place, doc_id NULLS FIRST, size, row ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS before
        FROM sized JOIN goals ON sized.source IS NOT DISTINCT FROM goals.source),
    served AS (
        SELECT *, copy * source_size + before AS ahead, least(size, CAST(floor(target) AS BIGINT) - (copy * source_size + before)) AS words
        FROM queued, (SELECT unnest([0, 1]) AS copy)),
    placed AS (
        SELECT *, CAST(sum(words) OVER (ORDER BY (ahead + words) / target, source_no, before, copy ROWS UNBOUNDED PRECEDING) AS BIGINT) - words AS start
        FROM served WHERE words > 0),
    taken AS (
        SELECT row, CAST(sum(least(words, budget - start)) AS BIGINT) AS taken, min(start) AS first_at FROM placed WHERE start < budget GROUP BY row)
    SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken, first_at FROM queued LEFT JOIN taken USING (row)
    """,
)
def op12_mixing(spark, folder):
    return mixing.mix(table(spark, folder, "documents"), weights=(3, 1, 2), share=1.5, copies=2)


@query("op13_alignment")
def op13_alignment(spark, folder):
    return alignment.aligned(table(spark, folder, "documents"), BYTE_TOKENIZER, PIECE_TOKENIZER)
