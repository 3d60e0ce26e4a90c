"""The operators applied to whole tables, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from livegauge.llm import language, licenses, sentencepiece, toxicity, warc
from livegauge.llm.audit import filter_audit
from livegauge.llm.clustering import centroid_clusters
from livegauge.llm.contamination import contaminated_documents
from livegauge.llm.exact import exact_groups
from livegauge.llm.minhash import near_duplicates
from livegauge.llm.packing import pack
from livegauge.llm.sharding import byte_shards
from livegauge.llm.vectors import near_vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded: number of ids, their CRC-32 as little-endian 32-bit numbers, and the decoded text's SHA-256."""
    return sentencepiece.round_trip(table(spark, sf_dir, "documents"), sentencepiece.load_pieces())


@query
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_shards(table(spark, sf_dir, "documents"))


@query
def op5_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


@query
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = licenses.standard_texts()
    return licenses.document_licenses(table(spark, sf_dir, "documents"), licenses.known_digests(spark, known), runs=licenses.known_runs(known))


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


@query
def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


@query
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archive(table(spark, sf_dir, "pages"), warc.archive_folder(spark))
    return warc.read_archive(index).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query
def op10_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


@query
def op11_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op12_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters(table(spark, sf_dir, "embeddings"))


ORACLES["op10_exact"] = """
    WITH t AS (
      SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
      FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, text_sha256
    FROM t WINDOW w AS (PARTITION BY text_sha256)"""


ORACLES["op5_vectors"] = """
    WITH RECURSIVE v AS (
      SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links AS MATERIALIZED (
      SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
    reach AS (
      SELECT a AS v, least(a, b) AS r FROM links
      UNION SELECT l.b, reach.r FROM reach JOIN links l ON l.a = reach.v),
    low AS (SELECT v, min(r) AS r FROM reach GROUP BY v),
    degree AS (SELECT a AS v, count(DISTINCT b) AS n FROM links GROUP BY a)
    SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(r, vec_id)) AS component_id,
           vec_id = least(vec_id, coalesce(r, vec_id)) AS kept
    FROM embeddings LEFT JOIN low ON vec_id = low.v LEFT JOIN degree ON vec_id = degree.v"""

ORACLES["op8_minhash"] = """
    WITH RECURSIVE w AS (
      SELECT doc_id, list_filter(string_split_regex(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
               lambda x: x <> '') AS w
      FROM documents),
    s AS MATERIALIZED (
      SELECT doc_id, unnest(CASE WHEN len(w) < 2 THEN [w[1]]
                            ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END) AS s
      FROM w WHERE len(w) > 0),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    pairs AS (
      SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
      FROM s x JOIN s y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
    links AS MATERIALIZED (
      SELECT a, b FROM pairs JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 80 * (p.n + q.n - k)),
    both_ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach AS (
      SELECT a AS v, least(a, b) AS r FROM both_ways
      UNION SELECT l.b, reach.r FROM reach JOIN both_ways l ON l.a = reach.v),
    low AS (SELECT v, min(r) AS r FROM reach GROUP BY v)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(r, doc_id)) AS component_id,
           doc_id = least(doc_id, coalesce(r, doc_id)) AS kept
    FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN low ON doc_id = low.v"""

ORACLES["op9_warc"] = """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
                 max(page_id) OVER (PARTITION BY html) AS newest FROM p)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 1000 AND newest <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 1000 AND newest <> page_id THEN newest END AS refers_to
    FROM d"""


def _license_sql() -> str:
    """The canonical form by regular expressions; known texts enter as their canonical forms."""
    names: dict[str, str] = {}
    for name, texts in sorted(licenses.standard_texts().items()):
        for text in texts:
            names.setdefault(licenses.canonical(text), name)
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({quoted(form)}, {quoted(name)})" for form, name in names.items())
    form = "' ' || trim(regexp_replace(lower(regexp_replace(part, {copyright}, '', 'g')), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) || ' '"
    form = form.format(
        copyright=quoted(
            r"(?im)^[ \t]*(?:(?:copyright|\(c\)|©)[ \t]*)+(?:(?:\(c\)|©|[0-9]{4}|by\b)[^\n]*)$|^[ \t]*all rights reserved\.?[ \t]*$"
        )
    )
    for a, b in sorted(licenses.EQUIVALENT.items(), key=lambda x: -len(x[0])):
        form = f"replace({form}, {quoted(f' {a} ')}, {quoted(f' {b} ')})"
    return f"""
    WITH known(form, license) AS (VALUES {known}),
    parts AS (
      SELECT doc_id, -1 AS unit, text AS part FROM documents WHERE text <> ''
      UNION ALL SELECT doc_id, 0, unnest(string_split(text, chr(10))) FROM documents WHERE text <> ''),
    forms AS MATERIALIZED (SELECT doc_id, unit, trim({form}) AS form FROM parts),
    found AS (
      SELECT doc_id, unit, license FROM forms JOIN known USING (form)
      UNION ALL
      SELECT doc_id, -2, license FROM forms f JOIN known k ON contains(' ' || f.form || ' ', ' ' || k.form || ' ')
      WHERE unit = -1 AND len(string_split(k.form, ' ')) >= {licenses.RUN_WORDS})
    SELECT doc_id, any_value(f.text_license) AS text_license, coalesce(any_value(f.licenses), '') AS licenses,
           coalesce(any_value(f.n_units), 0) AS n_units, coalesce(any_value(f.n_runs), 0) AS n_runs
    FROM documents LEFT JOIN (
      SELECT doc_id, min(license) FILTER (unit = -1) AS text_license, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses,
             count(*) FILTER (unit >= -1) AS n_units, count(*) FILTER (unit < -1) AS n_runs
      FROM found GROUP BY doc_id) f USING (doc_id)
    GROUP BY doc_id"""


ORACLES["op6_licenses"] = _license_sql()


ORACLES["op11_audit"] = """
    WITH RECURSIVE t AS (
      SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
             list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
      FROM documents),
    marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
              FROM labels GROUP BY doc_id),
    fails AS (
      SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, [
               len(w) < 100,
               100 * len(list_distinct(w)) < 80 * len(w),
               100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text),
               regexp_matches(text, '[#$%&*|]'),
               coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS f
      FROM t LEFT JOIN marks USING (doc_id)),
    counted AS (
      SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic, len(list_filter(f, lambda x: x)) AS bad FROM fails GROUP BY part, f),
    orders(o) AS (
      SELECT '' UNION ALL SELECT o || l FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l) WHERE NOT contains(o, l)),
    steps AS (
      SELECT o AS filter_order, step, ascii(o[step]) - 64 AS filter, list_transform(range(1, step), lambda i: ascii(o[i]) - 64) AS before
      FROM orders, range(1, 6) AS r(step) WHERE length(o) = 5),
    done AS (
      SELECT part, filter_order, step, filter, f[filter] AS hit, len(list_filter(before, lambda i: f[i])) > 0 AS gone, bad, n, good, toxic
      FROM steps, counted),
    summed AS (
      SELECT part, filter_order, CAST(step AS INTEGER) AS step, any_value(filter) AS filter,
             CAST(coalesce(sum(n) FILTER (NOT gone AND NOT hit), 0) AS BIGINT) AS kept,
             CAST(coalesce(sum(n) FILTER (NOT gone AND hit), 0) AS BIGINT) AS removed,
             CAST(coalesce(sum(n) FILTER (gone AND hit), 0) AS BIGINT) AS redundant,
             CAST(coalesce(sum(n) FILTER (hit AND bad = 1), 0) AS BIGINT) AS unique_fails,
             CAST(coalesce(sum(good) FILTER (NOT gone AND hit), 0) AS BIGINT) AS good_lost,
             CAST(coalesce(sum(toxic) FILTER (NOT gone AND hit), 0) AS BIGINT) AS toxic_lost
      FROM done GROUP BY part, filter_order, step)
    SELECT * EXCLUDE (filter), CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley FROM summed"""

ORACLES["op12_contamination"] = """
    WITH t AS (
      SELECT row_number() OVER () AS line, doc_id, list_filter(string_split_regex(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^0-9a-z\\x{80}-\\x{10FFFF}]+'),
               lambda x: x <> '') AS w
      FROM documents),
    b AS (
      SELECT item_id, list_filter(string_split_regex(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^0-9a-z\\x{80}-\\x{10FFFF}]+'),
               lambda x: x <> '') AS w
      FROM benchmark),
    windows AS MATERIALIZED (
      SELECT DISTINCT item_id, len(g) AS size, array_to_string(g, ' ') AS g
      FROM (SELECT item_id, unnest(list_transform(range(1, greatest(2, len(w) - 8)), lambda i: w[i:i + 9])) AS g FROM b WHERE len(w) > 0)),
    sizes AS (SELECT DISTINCT size FROM windows),
    runs AS (
      SELECT line, size, unnest(range(1, len(w) - size + 2)) AS i, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS g
      FROM t, sizes WHERE len(w) >= size),
    found AS MATERIALIZED (SELECT line, i, size, item_id FROM runs JOIN windows USING (size, g)),
    hit AS (SELECT line, count(DISTINCT p) AS n_hit FROM (SELECT line, unnest(range(i, i + size)) AS p FROM found) GROUP BY line),
    held AS (
      SELECT line, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT line, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY line)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AS contaminated
    FROM t LEFT JOIN hit USING (line) LEFT JOIN held USING (line)"""


def _cluster_sql(rounds: int = 10) -> str:
    """The rounds written out one after the other."""
    assign = """
    a{n} AS MATERIALIZED (
      SELECT line, v, arg_min(k, (d, k)) AS k, min(d) AS d
      FROM (SELECT line, v, k, CAST(list_sum(list_transform(range(1, 65), lambda i: (v[i] - c[i]) * (v[i] - c[i]))) AS BIGINT) AS d FROM rows_, c{n}) GROUP BY line, v)"""
    move = """,
    c{m} AS MATERIALIZED (
      SELECT c{n}.k, coalesce(moved.c, c{n}.c) AS c
      FROM c{n} LEFT JOIN (
        SELECT k, list(x ORDER BY i) AS c
        FROM (SELECT k, i, (sum(x) - (((sum(x) % count(*)) + count(*)) % count(*))) // count(*) AS x
              FROM (SELECT k, generate_subscripts(v, 1) AS i, CAST(unnest(v) AS HUGEINT) AS x FROM a{n}) GROUP BY k, i)
        GROUP BY k) moved USING (k)),"""
    turns = "".join(assign.format(n=n) + move.format(n=n, m=n + 1) for n in range(rounds)) + assign.format(n=rounds)
    return f"""
    WITH rows_ AS MATERIALIZED (
      SELECT row_number() OVER () AS line, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    c0 AS MATERIALIZED (
      SELECT CAST(row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS INTEGER) AS k, v AS c
      FROM (SELECT sha256('3:' || vec_id) AS h, v FROM rows_ ORDER BY h NULLS LAST, v LIMIT 8)),{turns}
    SELECT vec_id, k AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
           sha256(array_to_string(c, ',')) AS centroid_sha256
    FROM a{rounds} JOIN rows_ USING (line) JOIN c{rounds} USING (k)"""


ORACLES["op13_clusters"] = _cluster_sql()
