"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.catalog.registry import Query
from tidemark.llm import (
    alignment, gru_lm, html_template, jaccard_fragments, language, minhash, packing, quality_rules, quality_trees, segmentation,
    simhash, spelling, url_lists,
)
from tidemark.llm.tables import in_fold, read, ship_code
from tidemark.session import prepare

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_code(spark)
            return function(prepare(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def _sql_words(names) -> str:
    return ", ".join(f"'{w}'" for w in names)


OP9_SQL = rf"""
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), lined AS (
    SELECT *, list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
    FROM cut
), windows AS (
    SELECT doc_id, unnest(generate_series(1, len(words) - 2)) AS place, words FROM cut WHERE len(words) > 2
), keyed AS (
    SELECT doc_id, place, words[place] || ' ' || words[place + 1] || ' ' || words[place + 2] AS key FROM windows
), counted AS (
    SELECT doc_id, place, count(*) OVER (PARTITION BY doc_id, key) AS times FROM keyed
), covered AS (
    SELECT doc_id, count(DISTINCT word) AS n_repeat_words
    FROM (SELECT doc_id, unnest([place, place + 1, place + 2]) AS word FROM counted WHERE times > 1)
    GROUP BY doc_id
), counts AS (
    SELECT l.doc_id, len(words)::BIGINT AS n_words,
           length(array_to_string(words, ''))::BIGINT AS word_chars,
           (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
           (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
           coalesce(c.n_repeat_words, 0)::BIGINT AS n_repeat_words,
           len(lines)::BIGINT AS n_lines,
           len(list_filter(words, lambda w: lower(w) IN ({_sql_words(quality_rules.STOP_WORDS)}))) AS n_stop_words,
           len(list_filter(words, lambda w: upper(w) <> lower(w))) AS n_letter_words,
           len(list_filter(words, lambda w: w LIKE '%!')) AS n_shouted_words
    FROM lined l LEFT JOIN covered c ON c.doc_id = l.doc_id
), failed AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed
       AND word_chars BETWEEN 2.0 * n_words AND 12.0 * n_words
       AND n_symbols <= 0.1 * n_words
       AND n_stop_words >= 0.05 * n_words
       AND n_letter_words >= 0.7 * n_words
       AND n_shouted_words <= 0.5 * n_words
       AND n_dup_lines <= 0.4 * n_lines AS kept
FROM failed
"""


@register("op9_quality_rules", OP9_SQL)
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base verdict and rule verdict of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.measure(docs).drop("text")


@register("op5_best_fit_packing")
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every token of every document at its place in a sequence of at most 2,048 tokens."""
    return packing.pack_documents(read(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op10_simhash_components")
def op10_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and the smallest id that links reach from it."""
    groups = simhash.group_documents(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@register("op6_language_id")
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; the fold of remainder 1 is held out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", in_fold("doc_id", 3, 1))
    filters = language.learn(docs.filter(~F.col("held_out")))
    return language.identify(docs.select("doc_id", "text", "held_out"), filters).drop("text")


@register("op4_minhash_fingerprints")
def op4_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edited form, with likeness to it and to the next text."""
    return minhash.with_next(read(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op8_gru_lm")
def op8_gru_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram base and recurrent model's log10 probability of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = in_fold("doc_id", 10, 0)
    vocabulary, model, counts = gru_lm.learn(docs.filter(~held_out))
    return gru_lm.score(docs, vocabulary, model, counts).withColumn("held_out", held_out)


@register("op3_quality_trees")
def op3_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; the fold of remainder 0 is held out."""
    held_out = in_fold("doc_id", 5, 0)
    rows = quality_trees.described(read(spark, sf_dir, "documents").select("doc_id", "text"))
    labels = read(spark, sf_dir, "labels").select("doc_id", "quality").filter(~held_out)
    return quality_trees.classify(rows, quality_trees.learn(rows, labels)).withColumn("held_out", held_out)


@register("op1_html_template")
def op1_html_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_template.extract(read(spark, sf_dir, "pages").select("page_id", "url", "html"))


def _number(text: str, modulus: int) -> str:
    """A number below the modulus from a text, in Spark SQL."""
    return f"cast(conv(substr(md5({text}), 1, 7), 16, 10) as int) % {modulus}"


def _captures(pages: DataFrame) -> DataFrame:
    """Pages with a fetch time of the year, from the page's number."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 365).cast("int"))
    return pages.select("page_id", "url", day.cast("timestamp").alias("fetched_at"))


def _list_entries(pages: DataFrame) -> DataFrame:
    """Dated entries for the hosts, parent domains and first path segments that pages have."""
    seen = pages.select(
        url_lists.plain_host(F.col("url")).alias("host"),
        F.regexp_extract("url", "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)", 1).alias("segment"),
    ).filter("host <> ''")
    hosts = seen.select("host").distinct()
    sections = seen.filter("segment <> ''").select(F.concat("host", F.lit("/"), "segment").alias("host")).distinct()
    parents = hosts.select(F.regexp_replace("host", r"^[^.]*\.", "").alias("host")).filter("host like '%.%.%'").distinct()

    def entry(of: DataFrame, name: str, action: str, verdict: str, first: int, among: int, keep: str) -> DataFrame:
        day = f"date_add(date'2024-01-01', {first} + {_number('host', among)})"
        return of.filter(keep).select(
            F.lit(name).alias("list_name"), F.col("host").alias("pattern"), F.lit(action).alias("action"),
            F.lit(verdict).alias("verdict"), F.expr(f"cast({day} as timestamp)").alias("listed_at"),
        )

    some, few = _number("concat(host, 'a')", 3) + " = 0", _number("concat(host, 'b')", 4) + " = 0"
    parts = [
        entry(hosts, "hosts", "add", "block", 0, 100, some),
        entry(hosts, "hosts", "remove", "block", 130, 40, some),
        entry(hosts, "hosts", "add", "block", 220, 60, some),
        entry(parents, "domains", "add", "block", 60, 30, "true"),
        entry(parents, "domains", "remove", "block", 150, 30, "true"),
        entry(sections, "sections", "add", "allow", 40, 200, few),
        entry(sections, "sections", "remove", "allow", 260, 60, few),
    ]
    return reduce(DataFrame.unionByName, parts)


def _entries_sql() -> str:
    def number(text: str, modulus: int) -> str:
        return f"(('0x' || substr(md5({text}), 1, 7))::INT % {modulus})"

    some, few = number("host || 'a'", 3) + " = 0", number("host || 'b'", 4) + " = 0"
    rows = [
        ("hosts", "hosts", "add", "block", 0, 100, some), ("hosts", "hosts", "remove", "block", 130, 40, some),
        ("hosts", "hosts", "add", "block", 220, 60, some), ("parents", "domains", "add", "block", 60, 30, "true"),
        ("parents", "domains", "remove", "block", 150, 30, "true"),
        ("sections", "sections", "add", "allow", 40, 200, few), ("sections", "sections", "remove", "allow", 260, 60, few),
    ]
    return " UNION ALL ".join(
        f"SELECT '{name}' AS list_name, host AS pattern, '{action}' AS action, '{verdict}' AS verdict, "
        f"(DATE '2024-01-01' + {first} + {number('host', among)})::TIMESTAMP AS listed_at FROM {of} WHERE {keep}"
        for of, name, action, verdict, first, among, keep in rows
    )


OP2_SQL = rf"""
WITH captures AS (
    SELECT page_id, url, (DATE '2024-01-01' + (page_id % 365)::INT)::TIMESTAMP AS fetched_at,
           lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS host,
           list_filter(string_split(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1), '/'),
                       lambda s: s <> '') AS segments
    FROM pages
), hosts AS (
    SELECT DISTINCT host FROM captures WHERE host <> ''
), sections AS (
    SELECT DISTINCT host || '/' || segments[1] AS host FROM captures WHERE host <> '' AND len(segments) > 0
), parents AS (
    SELECT DISTINCT regexp_replace(host, '^[^.]*\.', '') AS host FROM hosts WHERE regexp_replace(host, '^[^.]*\.', '') LIKE '%.%.%'
), entries AS (
    {_entries_sql()}
), intervals AS (
    SELECT * FROM (
        SELECT *, lead(listed_at) OVER (PARTITION BY list_name, pattern ORDER BY listed_at) AS until FROM entries
    ) WHERE action = 'add'
), found AS (
    SELECT c.page_id, i.*, row_number() OVER (
        PARTITION BY c.page_id ORDER BY length(pattern) DESC, listed_at DESC, list_name
    ) AS place
    FROM captures c JOIN intervals i
      ON ((c.host || '/' || array_to_string(c.segments, '/') || '/') LIKE (i.pattern || '/%')
          OR (c.host || '/' || array_to_string(c.segments, '/') || '/') LIKE ('%.' || i.pattern || '/%'))
     AND i.listed_at <= c.fetched_at AND (i.until IS NULL OR c.fetched_at < i.until)
)
SELECT c.page_id, c.url, c.fetched_at, coalesce(f.verdict, 'none') AS verdict, f.list_name, f.pattern, f.listed_at
FROM captures c LEFT JOIN found f ON f.page_id = c.page_id AND f.place = 1
"""


@register("op2_url_lists", OP2_SQL)
def op2_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page capture against the list entries that were active when it was fetched."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return url_lists.evaluate(_captures(pages), _list_entries(pages))


@register("op7_nbest_segmentation")
def op7_nbest_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best piece ids, the best scores and the round trip of every document."""
    return segmentation.segment_documents(read(spark, sf_dir, "documents").select("doc_id", "text"))


OP11_SQL = r"""
WITH RECURSIVE cut AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), placed AS (
    SELECT doc_id, words, unnest(generate_series(1, greatest(len(words) - 3, 1))) AS place FROM cut WHERE len(words) > 0
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(words[place:place + 3], ' ') AS shingle FROM placed
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id
), links AS (
    SELECT c.a, c.b FROM common c JOIN sizes x ON x.doc_id = c.a JOIN sizes y ON y.doc_id = c.b
    WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)
), reach AS (
    SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(r.b, d.doc_id))::BIGINT AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
LEFT JOIN (SELECT a, min(b) AS b FROM reach GROUP BY a) r ON r.a = d.doc_id
"""


@register("op11_jaccard_fragments", OP11_SQL)
def op11_jaccard_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size of every document and the smallest id that links of similar sets reach from it."""
    return jaccard_fragments.group_documents(read(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op12_pointer_alignment")
def op12_pointer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of a byte-level and a piece tokenizer, for every document."""
    return alignment.align(read(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op13_spelling_variants")
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the vocabulary with its near words, its form and the root of its forms."""
    return spelling.variants(read(spark, sf_dir, "documents").select("doc_id", "text"))
