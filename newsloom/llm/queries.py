"""The operators on the given tables, and the SQL some of them are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_dir
from .alignment import align
from .curriculum import taken
from .dart_minhash import near_dedup
from .exact_dedup import exact_dedup
from .label_propagation import shard
from .line_frequency import line_rules
from .packing import pack
from .reverse_search import search
from .secret_owners import KINDS, find_secrets, shown
from .site_quality import site_quality
from .token_counts import token_counts
from .token_files import read_token_files, write_token_files
from .toxicity import toxicity


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def packed(docs: DataFrame) -> DataFrame:
    pieces = pack(docs, _vocabulary("byte_bpe_50k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op1_exact_dedup(spark, sf_dir):
    return exact_dedup(documents(spark, sf_dir))


def op2_label_propagation(spark, sf_dir):
    return shard(documents(spark, sf_dir))


def op6_secret_owners(spark, sf_dir):
    found = find_secrets(documents(spark, sf_dir))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(shown("base"), 256).alias("base_sha256"), shown("all").alias("spans")
    )


def op9_curriculum(spark, sf_dir):
    return taken(documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", "taken", F.round("first_position", 6).alias("first_position")
    )


def op8_near_dedup(spark, sf_dir):
    return near_dedup(documents(spark, sf_dir))


def op3_packing(spark, sf_dir):
    return packed(documents(spark, sf_dir))


def op4_line_rules(spark, sf_dir):
    return line_rules(documents(spark, sf_dir))


def op10_site_quality(spark, sf_dir):
    return site_quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_token_files(spark, sf_dir):
    path = scratch_dir(spark, "token-files")
    write_token_files(documents(spark, sf_dir), path, _vocabulary("word_bpe_49k.json"))
    return read_token_files(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op7_token_counts(spark, sf_dir):
    return token_counts(documents(spark, sf_dir), _vocabulary("word_bpe_49k.json"))


def op11_alignment(spark, sf_dir):
    digest = lambda groups: F.when(groups == "", "").otherwise(F.sha2(groups, 256))
    found = align(documents(spark, sf_dir), _vocabulary("byte_bpe_50k.json"), _vocabulary("piece_bpe_32k.model"), shown=digest)
    return found.withColumnRenamed("groups", "groups_sha256")


def op12_reverse_search(spark, sf_dir):
    return search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_toxicity(spark, sf_dir):
    return toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for name, query in globals().items() if name.startswith("op") and name[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": _EXACT,
        "op4_line_rules": _LINES,
        "op6_secret_owners": _secrets(),
        "op9_curriculum": _CURRICULUM,
        "op12_reverse_search": _SEARCH,
    }


_EXACT = r"""WITH d AS (
        SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
    g AS (SELECT sha256(norm) AS h, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY ALL)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256
    FROM (SELECT doc_id, sha256(norm) AS h FROM d) JOIN g USING (h)"""

_LINES = r"""WITH d AS (
        SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
    w AS (SELECT r, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM d),
    five AS (
        SELECT r, i, list_slice(words, i, i + 4) AS win
        FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM w)),
    again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM five) WHERE n > 1),
    covered AS (
        SELECT r, count(DISTINCT p) AS n_repeat_words
        FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM again) GROUP BY r),
    line AS (
        SELECT r, source, line, lower(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'))) AS norm
        FROM (SELECT r, source, unnest(string_split(text, chr(10))) AS line FROM d)),
    word_line AS (
        SELECT *, len(string_split(norm, ' ')) AS words FROM line WHERE norm <> ''),
    dup AS (SELECT r, sum(n - 1) AS n_dup_lines FROM (
        SELECT r, line, count(*) AS n FROM word_line GROUP BY ALL) GROUP BY r),
    over_limit AS (SELECT source, norm FROM word_line GROUP BY ALL HAVING count(DISTINCT r) > 20),
    gone AS (
        SELECT r, sum(words) AS gone FROM word_line l
        JOIN over_limit o ON l.norm = o.norm AND l.source IS NOT DISTINCT FROM o.source GROUP BY r),
    counted AS (
        SELECT doc_id, len(words)::BIGINT AS n_words,
               length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
               (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
               coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
               (len(words) - coalesce(gone, 0))::BIGINT AS left_words
        FROM d JOIN w USING (r) LEFT JOIN dup USING (r) LEFT JOIN covered USING (r) LEFT JOIN gone USING (r))
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
           NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND left_words >= 0.3 * n_words AS kept
    FROM counted"""

_CURRICULUM = r"""WITH d AS (
        SELECT doc_id, source, md5(doc_id::VARCHAR) AS k,
               len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS size FROM documents),
    s AS (
        SELECT *, 3 * source_size / w AS ratio FROM (
            SELECT source, source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS turn, turn + 1 AS w
            FROM (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source))),
    c AS (
        SELECT *, ((SELECT sum(source_size) FROM s) - coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
               / (sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS lam
        FROM s WINDOW o AS (ORDER BY ratio, source)),
    lev AS (SELECT min(lam) FILTER (ratio >= lam) AS lam FROM (SELECT *, row_number() OVER (ORDER BY ratio, source) AS i FROM c)
            WHERE i = (SELECT min(i) FROM (SELECT ratio, lam, row_number() OVER (ORDER BY ratio, source) AS i FROM c) WHERE ratio >= lam)),
    t AS (SELECT source, source_size, turn, least((3 * source_size)::DOUBLE, lam * w) AS target FROM s, lev),
    p AS (
        SELECT d.doc_id, d.size, t.source_size, t.target, t.turn,
               coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS c
        FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
    q AS (SELECT *, floor(target)::BIGINT AS whole, c / target AS y FROM p)
    SELECT doc_id, size::BIGINT AS size, source_size, target,
           (greatest(least(whole - c, size), 0) + greatest(least(whole - c - source_size, size), 0)
            + greatest(least(whole - c - 2 * source_size, size), 0))::BIGINT AS taken,
           CASE WHEN size > 0 AND whole > c THEN round(CASE turn WHEN 0 THEN (sqrt(2.25 - 2.0 * y) - 1.5) / -1.0 WHEN 1 THEN y
                ELSE (sqrt(0.25 + 2.0 * y) - 0.5) / 1.0 END, 6) + 0.0 END AS first_position
    FROM q"""


_SEARCH = r"""WITH d AS (
        SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents WHERE text IS NOT NULL),
    i AS (
        SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
    item AS (SELECT item_id, term, count(*) AS times FROM i GROUP BY ALL),
    s AS (SELECT count(*)::HUGEINT AS docs, sum(len(t))::HUGEINT AS terms FROM d WHERE len(t) > 0),
    tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM d) GROUP BY ALL),
    q AS (
        SELECT doc_id, term, (1000000000 * tf::HUGEINT) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)) AS q
        FROM tf, s WHERE term IN (SELECT term FROM item)),
    w AS (
        SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
        FROM (SELECT term, count(*) AS df FROM q GROUP BY term), s),
    scored AS (
        SELECT item_id, doc_id, sum(times * w * q)::BIGINT AS score
        FROM item JOIN w USING (term) JOIN q USING (term) GROUP BY ALL)
    SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
        SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
    WHERE rank <= 10"""


def _secrets() -> str:
    kinds = []
    for kind, (pattern, group, least) in KINDS.items():
        p = "'" + pattern.replace("'", "''") + "'"
        kinds.append(f"""SELECT r, source, lang, '{kind}' AS kind, unnest(range(1, len(f) + 1)) AS i,
            list_sum(list_transform(g[1:i], lambda x: length(x))) + list_sum(list_transform(f[1:i], lambda x: length(x))) AS stop,
            length(f[i]) AS size, v[i] AS value, {least} AS least
            FROM (SELECT r, source, lang, regexp_extract_all(text, {p}) AS f, regexp_extract_all(text, {p}, {group}) AS v,
                  string_split_regex(text, {p}) AS g FROM d WHERE regexp_matches(text, {p}))""")
    return f"""WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
                   coalesce(text, '') AS text FROM documents),
        m AS ({" UNION ALL ".join(kinds)}),
        f AS (SELECT r, source, lang, kind, (stop - size)::BIGINT AS start, stop::BIGINT AS stop, value,
                     (stop - length(value))::BIGINT AS value_start FROM m WHERE length(value) >= least),
        o AS (SELECT value, count(DISTINCT source) AS owners, count(DISTINCT source || '/' || lang) AS repos FROM f GROUP BY value),
        e AS (
            SELECT r, kind, start, stop, CASE kind WHEN 'assign' THEN 1 WHEN 'access' THEN 2 ELSE 3 END AS rank FROM f
            UNION ALL
            SELECT DISTINCT r, verdict, value_start, stop, CASE verdict WHEN 'live' THEN 4 ELSE 5 END FROM (
                SELECT r, value_start, stop, CASE WHEN owners > 1 OR repos > 3 THEN 'copied'
                    WHEN length(value) >= 16 AND len(list_distinct(string_split(value, ''))) >= 8
                         AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') THEN 'live' END AS verdict
                FROM f JOIN o USING (value)) WHERE verdict IS NOT NULL),
        g AS (
            SELECT r, count(*) FILTER (rank = 1) AS n_assign, count(*) FILTER (rank = 2) AS n_access,
                   count(*) FILTER (rank = 3) AS n_hex,
                   string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank <= 3) AS base,
                   string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank, stop) AS spans
            FROM e GROUP BY r)
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM d LEFT JOIN g USING (r)"""
