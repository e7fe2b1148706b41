"""Every query of the engine's own operators by name, with its SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from curamill.functions import lexicons as L, text as X
from curamill.operators import chunk, clean, dedup, enrich, ingest, quality, search
from curamill.plans import pipeline, sql
from curamill.session import scratch, settle, table
from curamill.sources import files, sinks

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _add(name: str, run: Query, oracle: str | None = None) -> None:
    _QUERIES[name] = run
    if oracle:
        _SQL[name] = oracle


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _of(name: str, *columns: str) -> Query:
    return lambda spark, folder: table(spark, folder, name).select(*columns) if columns else table(spark, folder, name)


# ---- sources and validation -------------------------------------------------------------------------------------

_add(
    "s_source_counts",
    lambda s, d: table(s, d, "documents").groupBy("source", "layout").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")),
    "SELECT source, layout, count(*) AS n, sum(length(text))::BIGINT AS chars FROM documents GROUP BY ALL",
)
_add("s10_fingerprint", lambda s, d: table(s, d, "processed").select("filename", files.fingerprint("text").alias("hash")), "SELECT filename, md5(text) AS hash FROM processed")


def _json_lines(s: SparkSession, d: str) -> DataFrame:
    path = scratch(s, "json")
    sinks.write_json_lines(table(s, d, "enriched").drop("created_at"), path)
    return files.read_json_lines(s, path, files.ENRICHED).select("chunk_id", F.array_join("keywords", " ").alias("keywords"), "entity_count", F.size("entity_types").alias("n_types"), "primary_topic", "structure.paragraph_count", "document_metadata.file_size", F.md5("text").alias("hash"))


_add("s7_json_lines", _json_lines, "SELECT chunk_id, array_to_string(keywords, ' ') AS keywords, entity_count, coalesce(cardinality(entity_types), -1)::INT AS n_types, primary_topic, structure.paragraph_count AS paragraph_count, document_metadata.file_size AS file_size, md5(text) AS hash FROM enriched")


def _csv_report(s: SparkSession, d: str) -> DataFrame:
    path = scratch(s, "csv")
    sinks.write_csv_report(table(s, d, "quality_report").select("report_id", "category", "passes_threshold"), path)
    return s.read.option("header", "true").schema("report_id bigint, category string, passes_threshold boolean").csv(path)


_add("k8_csv_report", _csv_report, "SELECT report_id, nullif(category, '') AS category, passes_threshold FROM quality_report")


def _routed(s: SparkSession, d: str) -> DataFrame:
    path = scratch(s, "routed")
    sinks.write_routed(_validated(s, d).withColumn("is_valid", F.col("validation_status") == "valid").select("filename", "is_valid"), path, "is_valid")
    return s.read.parquet(path).filter("NOT is_valid").select("filename")


def _validated(s: SparkSession, d: str) -> DataFrame:
    return ingest.validate(table(s, d, "processed").select("filename", "text"))


_VALID = f"""
WITH v AS (SELECT filename, text, length({sql.strip("text")}) AS stripped_length, {sql.special_ratio("text")} AS special_ratio, {sql.non_ascii_ratio("text")} AS non_ascii_ratio,
  {sql.fields("text")} AS w FROM processed),
x AS (SELECT *, CASE WHEN text IS NOT NULL THEN len(w) END AS n_words, CASE WHEN len(w) > 0 THEN len(list_distinct(w)) / len(w) END AS word_diversity FROM v),
y AS (SELECT *, CASE WHEN text IS NULL THEN 'error' WHEN stripped_length = 0 THEN 'invalid' ELSE 'valid' END AS status,
  CASE WHEN text IS NULL THEN ['No text'] WHEN stripped_length = 0 THEN ['Empty text'] ELSE list_filter([
    CASE WHEN stripped_length < 50 THEN 'Text too short: ' || stripped_length || ' characters' END,
    CASE WHEN special_ratio > 0.3 THEN 'High special character ratio: ' || printf('%.2f%%', round(special_ratio * 100, 2)) END,
    CASE WHEN non_ascii_ratio > 0.5 THEN 'High non-ASCII ratio: ' || printf('%.2f%%', round(non_ascii_ratio * 100, 2)) END,
    CASE WHEN n_words > 10 AND word_diversity < 0.3 THEN 'Low word diversity: ' || printf('%.2f%%', round(word_diversity * 100, 2)) END], lambda i: i IS NOT NULL) END AS issues FROM x)
"""
_add(
    "v_validation",
    lambda s, d: _validated(s, d).select("filename", "stripped_length", F.round("special_ratio", 9).alias("special_ratio"), F.round("non_ascii_ratio", 9).alias("non_ascii_ratio"), "n_words", F.round("word_diversity", 9).alias("word_diversity"), "validation_status"),
    _VALID + "SELECT filename, stripped_length, round(special_ratio, 9) AS special_ratio, round(non_ascii_ratio, 9) AS non_ascii_ratio, n_words, round(word_diversity, 9) AS word_diversity, status AS validation_status FROM y",
)
_add("v7_issues", lambda s, d: _validated(s, d).select("filename", F.concat_ws("; ", "validation_issues").alias("issues")), _VALID + "SELECT filename, array_to_string(issues, '; ') AS issues FROM y")
_add(
    "v9_stats",
    lambda s, d: ingest.validation_stats(_validated(s, d)),
    _VALID + "SELECT count(*) AS total_files, count_if(status = 'valid') AS successful, count_if(status = 'invalid') AS empty, count_if(status = 'error') AS failed, count_if(len(issues) > 0) AS with_issues, round(100 * count_if(status = 'valid') / count(*), 2) AS success_percent FROM y",
)

_add("k2_rejects", _routed, _VALID + "SELECT filename FROM y WHERE status <> 'valid'")

# ---- cleaning: over texts with a suffix that gives every step something to do --------------------------------------

SUFFIX = "\nPage 3 of 9\n12\n • item one\n1) first\n2 . second\nwell- \nknown fact !! So what?? yes,no a.b\nSame line\nSame line\n\n\n\nSee https://ex.org/a?b=1&c=2#frag or ops@ex.org  now\t...\x0cend\r\nlast\r"
_D = f"text || {' || '.join(sql.q(p) if i % 2 == 0 else p for i, p in enumerate(SUFFIX.replace(chr(10), '§chr(10)§').replace(chr(12), '§chr(12)§').replace(chr(13), '§chr(13)§').replace(chr(9), '§chr(9)§').split('§')))}"


_ORACLES: dict[str, str] = {}  # of the steps, over ``x``


def _step(name: str, make: Callable[[Column], Column], oracle: str, ctes: str = "") -> None:
    _ORACLES[name] = oracle

    def run(s: SparkSession, d: str) -> DataFrame:
        rows = table(s, d, "processed").select("filename", F.concat("text", F.lit(SUFFIX)).alias("x"))
        return rows.select("filename", make(F.col("x")).alias("y")).select("filename", F.md5("y").alias("hash"), F.length("y").alias("size"))

    _add(name, run, f"WITH {ctes}d AS (SELECT filename, {_D} AS x FROM processed), e AS (SELECT filename, {oracle} AS y FROM d{', maps' if ctes else ''}) SELECT filename, md5(y) AS hash, length(y) AS size FROM e")


_LINES = "string_split(x, chr(10))"
_MAPS = sql.maps(clean.PLAIN, clean.WINDOWS) + ", "
_step("c1_repair", clean.repaired, sql.repaired("x"), _MAPS)
_step("c2_html_text", lambda x: clean.html_text(F.concat(F.lit("<p>a<b>b</b><!-- c --></p>"), x)), sql.without_tags("'<p>a<b>b</b><!-- c --></p>' || x"))
_step("c3_nfkc", clean.nfkc, sql.nfkc("x"), _MAPS)
_step("c4_mask_urls", clean.mask_urls, f"regexp_replace(x, {sql.q(L.URL)}, '[URL]', 'g')")
_step("c4_mask_emails", clean.mask_emails, f"regexp_replace(x, {sql.q(L.EMAIL)}, '[EMAIL]', 'g')")
_step("c4_extract", lambda x: F.concat_ws(" ", clean.urls(x), clean.emails(x)), f"array_to_string(list_concat(regexp_extract_all(x, {sql.q(L.URL)}), regexp_extract_all(x, {sql.q(L.EMAIL)})), ' ')")
_step("c5_page_lines", clean.drop_page_lines, rf"replace(array_to_string(list_filter({_LINES}, lambda v: NOT regexp_matches(v, '(?i)^[ \t]*(?:page[ \t]*)?[0-9]+[ \t]*(?:of[ \t]*[0-9]+)?[ \t]*\z')), chr(10)), chr(12), chr(10))")
_step("c6_hyphens", clean.join_hyphens, r"regexp_replace(x, '([\p{L}\p{N}_]+)-[ \t]*\n\s*([\p{L}\p{N}_]+)', '\1\2', 'g')")
_step("c7_bullets", clean.bullets, rf"regexp_replace(x, '(^|\n)\s*{L.BULLET}\s+', '\1- ', 'g')")
_step("c7_numbered", clean.numbered, r"regexp_replace(x, '(^|\n)[ \t]*([0-9]+)[ \t]*[.)][ \t]+', '\1\2. ', 'g')")
_step("c8_punctuation", clean.punctuation, r"regexp_replace(regexp_replace(regexp_replace(x, '([.!?])[.!?]+', '\1', 'g'), '\s+([.,!?;:])', '\1', 'g'), '([.,!?;:])([a-zA-Z])', '\1 \2', 'g')")
_step("c8_compat", lambda x: clean.punctuation(x, compat=True), r"regexp_replace(regexp_replace(x, '[.!?]{2,}', '\\1', 'g'), '[.,!?;:][a-zA-Z]', '\\1 \\2', 'g')")
_step("c9_repeated_lines", clean.drop_repeated_lines, f"array_to_string(list_filter({_LINES}, lambda v, i: i = 1 OR {sql.strip('v')} = '' OR v <> {_LINES}[i-1]), chr(10))")
_WHITE = sql.strip(rf"regexp_replace(regexp_replace(array_to_string(list_transform(string_split(regexp_replace(regexp_replace(x, '{L.CONTROL}', '', 'g'), '\r\n?', chr(10), 'g'), chr(10)), lambda v: {sql.strip('v')}), chr(10)), ' {{2,}}', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')")
_step("c10_whitespace", clean.whitespace, _WHITE)


def _metrics(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "processed").select("filename", F.concat("text", F.lit(SUFFIX)).alias("x"))
    return rows.withColumn("y", clean.whitespace(F.col("x"))).select("filename", *clean.metrics(F.col("x"), F.col("y")))


_METRICS = f"""WITH d AS (SELECT filename, {_D} AS x FROM processed), e AS (SELECT filename, x, {_WHITE} AS y FROM d),
m AS (SELECT filename, length(x) AS original_length, length(y) AS cleaned_length, length(x) - length(y) AS chars_removed,
  CASE WHEN length(x) > 0 THEN round((length(x) - length(y)) * 100 / length(x), 2) ELSE 0.0 END AS cleanup_ratio_percent,
  CASE WHEN length(x) > 0 THEN round(length(y) / length(x), 3) ELSE 0.0 END AS compression_ratio,
  length(x) - length(replace(x, chr(10), '')) AS original_lines, length(y) - length(replace(y, chr(10), '')) AS cleaned_lines FROM e)
"""
_add("c12_metrics", _metrics, _METRICS + "SELECT * FROM m")
_add("c13_stats", lambda s, d: _metrics(s, d).agg(F.count("original_length").alias("n"), F.sum("chars_removed").alias("chars_removed"), F.round(F.avg("cleanup_ratio_percent"), 4).alias("mean_ratio")), _METRICS + "SELECT count(original_length) AS n, sum(chars_removed)::BIGINT AS chars_removed, round(avg(cleanup_ratio_percent), 4) AS mean_ratio FROM m")
_add("c11_language", lambda s, d: table(s, d, "documents").select("doc_id", X.language("text").alias("found")), f"SELECT doc_id, {sql.language('text')} AS found FROM documents")
_CHAIN = ["c3_nfkc", "c4_mask_urls", "c4_mask_emails", "c5_page_lines", "c6_hyphens", "c7_bullets", "c7_numbered", "c8_punctuation", "c9_repeated_lines", "c10_whitespace"]


def _cleaning_sql(source: str, key: str) -> str:
    """CTEs ending in ``cleaned``: ``key``, ``text`` and, as ``x``, the cleaned text of ``source``."""
    steps = [f"s0 AS (SELECT {key}, text, {sql.repaired('text')} AS x FROM {source}, maps)", f"s1 AS (SELECT {key}, text, CASE WHEN contains(x, '<') AND contains(x, '>') THEN {sql.without_tags('x')} ELSE x END AS x FROM s0)"]
    for i, name in enumerate(_CHAIN, 2):
        steps.append(f"s{i} AS MATERIALIZED (SELECT {key}, text, {_ORACLES[name]} AS x FROM s{i - 1}{', maps' if name == 'c3_nfkc' else ''})")
    return _MAPS + ", ".join([*steps, f"cleaned AS (SELECT * FROM s{len(_CHAIN) + 1})"])


_add(
    "c_clean",
    lambda s, d: clean.clean(table(s, d, "processed").select("filename", "text")).select("filename", "status", "detected_language", "cleaned_length", "chars_removed", F.md5("cleaned_text").alias("hash")),
    f"WITH {_cleaning_sql('processed', 'filename')} SELECT filename, CASE WHEN text IS NULL THEN 'failed' ELSE 'success' END AS status, {sql.language('x')} AS detected_language, length(x) AS cleaned_length, length(text) - length(x) AS chars_removed, md5(x) AS hash FROM cleaned",
)

# ---- quality ------------------------------------------------------------------------------------------------------


def _scored(s: SparkSession, d: str) -> DataFrame:
    return quality.score(table(s, d, "documents").select("doc_id", "text")).drop("text")


_SCORED = sql.quality("documents", "doc_id")
_WEAKEST = f"CASE least({', '.join(quality.FAMILIES)}) " + " ".join(f"WHEN {f} THEN '{f}'" for f in quality.FAMILIES) + " END"


def _score(name: str, columns: dict[str, str]) -> None:
    """columns: ours -> the name in the SQL's ``scored``."""
    _add(
        name,
        lambda s, d: _scored(s, d).select("doc_id", *[F.round(c, 6).alias(c) if c.startswith(("flesch", "avg", "trans", "lex", "length_v", "content", "number", "cap", "words_per", "alpha")) or c in quality.FAMILIES else F.col(c) for c in columns]),
        _SCORED + "SELECT doc_id, " + ", ".join(f"round(({v})::DOUBLE, 6) AS {c}" if c.startswith(("flesch", "avg", "trans", "lex", "length_v", "content", "number", "cap", "words_per", "alpha")) or c in quality.FAMILIES else f"{v} AS {c}" for c, v in columns.items()) + " FROM scored",
    )


_score("q1_readability", {"flesch_reading_ease": "ease", "flesch_kincaid_grade": "grade", "avg_sentence_length": "asl", "readability": "readability"})
_score("q2_coherence", {"transition_ratio": "transition", "lexical_cohesion": "cohesion", "length_variance": "variance", "coherence": "coherence"})
_score("q3_information_density", {"lexical_diversity": "diversity", "content_word_ratio": "content", "avg_word_length": "word_length", "number_ratio": "numbers", "information_density": "information_density"})
_score("q4_completeness", {"ends_properly": "ends", "has_truncation": "truncated", "has_conclusion": "concluded", "completeness": "completeness"})
_score("q5_linguistic_quality", {"capitalization_ratio": "capitals", "words_per_sentence": "wps", "alpha_ratio": "alpha", "linguistic_quality": "linguistic_quality"})
_add(
    "q6_composite",
    lambda s, d: _scored(s, d).select("doc_id", F.round("composite_score", 6).alias("composite_score"), "category", "passes_threshold"),
    _SCORED + f"SELECT doc_id, round(composite_score, 6) AS composite_score, {sql.CATEGORY} AS category, composite_score >= 0.5 AS passes_threshold FROM scored",
)
_add(
    "q9_weakest",
    lambda s, d: _scored(s, d).select("doc_id", "weakest_metric", F.round("weakest_score", 6).alias("weakest_score")),
    _SCORED + "SELECT doc_id, CASE least(readability, coherence, information_density, completeness, linguistic_quality) WHEN readability THEN 'readability' WHEN coherence THEN 'coherence' WHEN information_density THEN 'information_density' WHEN completeness THEN 'completeness' ELSE 'linguistic_quality' END AS weakest_metric, round(least(readability, coherence, information_density, completeness, linguistic_quality), 6) AS weakest_score FROM scored",
)
_add(
    "q10_stats",
    lambda s, d: quality.stats(_scored(s, d)).select("category", "n", *[F.round(c, 6).alias(c) for c in ("min_score", "mean_score", "max_score")]),
    _SCORED + f"SELECT {sql.CATEGORY} AS category, count(*) AS n, round(min(composite_score), 6) AS min_score, round(avg(composite_score), 6) AS mean_score, round(max(composite_score), 6) AS max_score FROM scored GROUP BY 1",
)
_REPORT = ["composite_score", *quality.FAMILIES]
_add(
    "q11_report",
    lambda s, d: quality.report(_scored(s, d), "doc_id").select("doc_id", *[F.round(c, 6).alias(c) for c in _REPORT], "category", "passes_threshold", "weakest_metric"),
    _SCORED + "SELECT doc_id, " + ", ".join(f"round({c}::DOUBLE, 6) AS {c}" for c in _REPORT) + f", {sql.CATEGORY} AS category, composite_score >= 0.5 AS passes_threshold, {_WEAKEST} AS weakest_metric FROM scored",
)

# ---- deduplication ------------------------------------------------------------------------------------------------

_HASH = f"md5({sql.comparable('text')})"
_add("d1_comparable", lambda s, d: table(s, d, "documents").select("doc_id", F.md5(X.comparable("text")).alias("hash"), F.length(X.comparable("text")).alias("size")), f"SELECT doc_id, {_HASH} AS hash, length({sql.comparable('text')}) AS size FROM documents")
_add("d3_exact_groups", lambda s, d: dedup.exact_groups(table(s, d, "documents"), "doc_id"), f"SELECT {_HASH} AS hash, min(doc_id) AS first, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
_add(
    "d4_shingles",
    lambda s, d: table(s, d, "documents").select("doc_id", F.size(X.char_shingles(X.comparable("text"))).alias("n_char3"), F.size(X.word_shingles(X.comparable("text"))).alias("n_word5")),
    f"WITH c AS (SELECT doc_id, {sql.comparable('text')} AS t FROM documents), w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, ' +'), lambda v: v <> '') AS w FROM c) SELECT doc_id, CASE WHEN length(t) >= 3 THEN len(list_distinct(list_transform(range(1, length(t) - 1), lambda i: t[i:i+2]))) ELSE 0 END AS n_char3, CASE WHEN len(w) >= 5 THEN len(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')))) ELSE 0 END AS n_word5 FROM w",
)
_FUZZY = f"""c AS (SELECT doc_id, {sql.comparable('text')} AS t FROM documents WHERE text IS NOT NULL),
w AS (SELECT doc_id, list_filter(regexp_split_to_array(t, ' +'), lambda v: v <> '') AS w FROM c),
s AS (SELECT doc_id, list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')))) AS g FROM w WHERE len(w) >= 5),
r AS (SELECT g, min(doc_id) AS a, len(g) AS n FROM s GROUP BY g),
e AS (SELECT a, n, unnest(g) AS x FROM r),
p AS (SELECT l.a AS a, r.a AS b, l.n AS n, r.n AS m, count(*) AS k FROM e l JOIN e r ON l.x = r.x AND l.a < r.a GROUP BY ALL)"""
_add(
    "d7_verified_pairs",
    lambda s, d: dedup.fuzzy_edges(table(s, d, "documents"), "doc_id").select("a", "b", F.round("score", 6).alias("score")),
    f"""WITH {_FUZZY}
SELECT a, b, round(k / (n + m - k), 6) AS score FROM p WHERE k / (n + m - k) >= 0.8
UNION ALL SELECT r.a, s.doc_id, 1.0 FROM s JOIN r USING (g) WHERE s.doc_id <> r.a""",
)
_add("d6_candidates_compat", lambda s, d: dedup.fuzzy_edges(table(s, d, "documents"), "doc_id", options=dedup.COMPAT).select("a", "b"))
_add(
    "d11_semantic_pairs",
    lambda s, d: dedup.semantic_edges(table(s, d, "embeddings"), "vec_id").select("a", "b"),
    "SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.95",
)
_add(
    "d11_nearest",
    lambda s, d: dedup.nearest(table(s, d, "embeddings"), table(s, d, "embeddings").filter("vec_id % 50 = 0"), "vec_id").select("query_id", "vec_id", F.round("score", 6).alias("score")),
    "SELECT a.vec_id AS query_id, b.vec_id AS vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS score FROM embeddings a, embeddings b WHERE a.vec_id % 50 = 0 AND list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.4",
)


def _resolved(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    docs = table(s, d, "documents")
    edges = dedup.exact_edges(docs, "doc_id")
    return docs, edges, dedup.resolve(docs, "doc_id", edges, docs.select("doc_id", F.col("n_chars").alias("score")))


_RESOLVED = f"WITH h AS (SELECT doc_id, lang, n_chars, {_HASH} AS hash FROM documents), g AS (SELECT hash, min(doc_id) AS component, min_by(doc_id, (-n_chars, doc_id)) AS kept FROM h GROUP BY hash), r AS (SELECT doc_id, lang, component, kept, doc_id = kept AS is_kept FROM h JOIN g USING (hash)) "
_add("d13_representative", lambda s, d: _resolved(s, d)[2], _RESOLVED + "SELECT doc_id, component, kept, is_kept FROM r")


def _survivors(s: SparkSession, d: str) -> DataFrame:
    docs, _, resolved = _resolved(s, d)
    return dedup.survivors(docs, "doc_id", resolved).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


_add("d15_survivors_by_lang", _survivors, _RESOLVED + "SELECT lang, count(*) AS n FROM r WHERE is_kept GROUP BY lang")


def _report(s: SparkSession, d: str) -> DataFrame:
    _, edges, resolved = _resolved(s, d)
    return dedup.report(resolved, "doc_id", edges)


_add("d16_report", _report, _RESOLVED + "SELECT doc_id AS removed, kept, 'exact' AS reason FROM r WHERE NOT is_kept")


def _dedup_stats(s: SparkSession, d: str) -> DataFrame:
    docs, edges, resolved = _resolved(s, d)
    return dedup.stats(docs, "doc_id", resolved, edges)


_add("d17_stats", _dedup_stats, _RESOLVED + "SELECT count(*) AS total_files, count_if(is_kept) AS unique_files, count_if(NOT is_kept) AS exact_duplicates, 0::BIGINT AS fuzzy_duplicates, 0::BIGINT AS semantic_duplicates, count_if(NOT is_kept) AS total_duplicates_removed, round(100 * count_if(NOT is_kept) / count(*), 2) AS rate_percent FROM r")


def _groups(s: SparkSession, d: str) -> DataFrame:
    docs = table(s, d, "documents")
    edges = settle(dedup.exact_edges(docs, "doc_id").unionByName(dedup.fuzzy_edges(docs, "doc_id")), "edges")
    return dedup.resolve(docs, "doc_id", edges)


_add(
    "d12_groups",
    _groups,
    f"""WITH RECURSIVE {_FUZZY},
h AS (SELECT doc_id, {_HASH} AS hash FROM documents WHERE text IS NOT NULL), x AS (SELECT hash, min(doc_id) AS first FROM h GROUP BY hash),
edges AS (SELECT a, b FROM p WHERE k / (n + m - k) >= 0.8 UNION SELECT r.a, s.doc_id FROM s JOIN r USING (g) WHERE s.doc_id <> r.a UNION SELECT first, doc_id FROM h JOIN x USING (hash) WHERE doc_id <> first),
{sql.components("edges")}, c0 AS (SELECT node, least(node, min(other)) AS component FROM reach GROUP BY node)
SELECT doc_id, coalesce(component, doc_id) AS component, coalesce(component, doc_id) AS kept, coalesce(component, doc_id) = doc_id AS is_kept FROM (SELECT DISTINCT doc_id FROM documents) LEFT JOIN c0 ON doc_id = node""",
)

# ---- chunking -----------------------------------------------------------------------------------------------------


def _chunked(strategy: str) -> Query:
    def run(s: SparkSession, d: str) -> DataFrame:
        out = chunk.chunk(table(s, d, "documents").select("doc_id", "text"), "doc_id", options=chunk.Chunking(strategy=strategy))
        return out.select("doc_id", "chunk_index", "total_chunks", F.md5("chunk_text").alias("hash"), "char_count")

    return run


for _name in ("h1_recursive", "h2_fixed", "h3_semantic"):
    _add(_name, _chunked(_name[3:]))
_add("h5_default", _chunked("unknown"))


def _within(strategy: str) -> Query:
    """What must hold of the chunks of each document: they stand in it, in order, from its first to its last solid
    character, none is over the size where the strategy has a last resort, and the metadata are the document's."""

    def run(s: SparkSession, d: str) -> DataFrame:
        docs = table(s, d, "documents").select("doc_id", "text").filter("text IS NOT NULL")
        parts = chunk.chunk(docs.withColumn("whole", F.col("text")), "doc_id", options=chunk.Chunking(strategy=strategy))
        bare = X.strip("whole")
        at = F.struct("chunk_index", "chunk_text")
        return parts.groupBy("doc_id").agg(
            F.every(F.contains("whole", F.col("chunk_text"))).alias("inside"),
            F.max((F.col("char_count") > 2048).cast("int")).alias("over"),
            F.every(F.col("document_metadata.char_count") == F.length("whole")).alias("described"),
            (F.count(F.lit(1)) == F.max("total_chunks")).alias("counted"),
            F.max(F.when(F.col("chunk_index") == 0, bare.startswith(F.col("chunk_text")))).alias("first"),
            F.max_by(bare.endswith(F.col("chunk_text")), at).alias("last"),
        )

    return run


for _name in ("recursive", "fixed", "unknown"):
    _add(
        f"h_{_name}_holds",
        _within(_name),
        f"SELECT doc_id, true AS inside, 0 AS over, true AS described, true AS counted, true AS first, true AS last FROM documents WHERE {sql.strip('text')} <> ''",
    )
_add("h19_sizes", lambda s, d: chunk.size_histogram(_measured(s, d)), "SELECT length(text) // 4 // 100 * 100 AS from_tokens, count(*) AS n FROM chunks WHERE text IS NOT NULL GROUP BY 1")
_add(
    "h4_token_windows",
    _chunked("token"),
    rf"""WITH t AS (SELECT doc_id, regexp_extract_all(text, '\s*(?:[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}\s])') AS t FROM documents WHERE text IS NOT NULL),
w AS (SELECT doc_id, t, range(0, greatest(len(t) - 51, 0) + 1, 462) AS starts FROM t WHERE len(t) > 0),
c AS (SELECT doc_id, unnest(range(len(starts))) AS chunk_index, len(starts) AS total_chunks, unnest(list_transform(starts, lambda i: {sql.strip("array_to_string(t[i+1:i+512], '')")})) AS x FROM w)
SELECT doc_id, chunk_index, total_chunks, md5(x) AS hash, length(x) AS char_count FROM c""",
)


def _measured(s: SparkSession, d: str) -> DataFrame:
    return chunk.position(chunk.chunk_metrics(table(s, d, "chunks").select("chunk_id", "source_file", "chunk_index", "total_chunks", "text"), "text"))


_CHUNKS = f"""WITH b AS (SELECT chunk_id, source_file, chunk_index, total_chunks, text, {sql.strip("text")} AS bare FROM chunks),
m AS (SELECT *, length(text) // 4 AS token_count, length(text) AS char_count, coalesce(right(bare, 1) IN ('.', '!', '?'), false) AS ends_complete, coalesce(regexp_matches(bare, '^\\p{{Lu}}'), false) AS starts_complete,
  len(list_filter(regexp_split_to_array(text, '[.!?]+'), lambda v: {sql.strip("v")} <> '')) AS sentence_count, len({sql.fields("text")}) AS word_count,
  coalesce(starts_with(bare, '-') OR ends_with(bare, '-'), false) AS has_boundary_issues, chunk_index / greatest(total_chunks, 1) AS position_ratio FROM b),
c AS (SELECT *, token_count BETWEEN 100 AND 1000 AS is_valid, round(greatest(0, 1.0::DOUBLE - CASE WHEN ends_complete THEN 0 ELSE 0.3::DOUBLE END - CASE WHEN starts_complete THEN 0 ELSE 0.2::DOUBLE END - CASE WHEN has_boundary_issues THEN 0.2::DOUBLE ELSE 0 END), 6) AS quality_score,
  CASE WHEN position_ratio < 0.25 THEN 'beginning' WHEN position_ratio < 0.75 THEN 'middle' WHEN position_ratio IS NOT NULL THEN 'end' END AS position_category FROM m)
"""
_CHUNK_COLUMNS = ["chunk_id", "token_count", "char_count", "is_valid", "ends_complete", "starts_complete", "sentence_count", "word_count", "has_boundary_issues", "position_category"]
_add(
    "h7_chunk_metrics",
    lambda s, d: _measured(s, d).select(*_CHUNK_COLUMNS, F.round("quality_score", 6).alias("quality_score"), F.round("position_ratio", 6).alias("position_ratio")),
    _CHUNKS + f"SELECT {', '.join(_CHUNK_COLUMNS)}, quality_score, round(position_ratio, 6) AS position_ratio FROM c",
)
_add(
    "h17_stats",
    lambda s, d: chunk.stats(_measured(s, d)),
    _CHUNKS + "SELECT count(DISTINCT source_file) AS total_documents, count(*) AS total_chunks, floor(avg(token_count))::INT AS mean_tokens, floor(quantile_cont(token_count, 0.5))::INT AS median_tokens, floor(stddev_pop(token_count))::INT AS std_tokens FROM c",
)
_add(
    "h18_report",
    lambda s, d: chunk.report(_measured(s, d)),
    _CHUNKS + "SELECT source_file, count(*) AS num_chunks, floor(avg(token_count))::INT AS avg_tokens_per_chunk, round(avg(quality_score), 3) AS avg_quality_score, count_if(token_count < 100) AS chunks_too_small, count_if(token_count > 1000) AS chunks_too_large FROM c GROUP BY source_file",
)

# ---- enrichment ---------------------------------------------------------------------------------------------------

_texts = _of("enriched", "chunk_id", "text")
_KEYS = rf"""WITH t AS (SELECT DISTINCT chunk_id, text FROM enriched),
w AS (SELECT chunk_id, text, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+')) AS w, generate_subscripts(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+'), 1) AS i FROM t),
f AS (SELECT chunk_id, text, w, count(*) AS n, min(i) AS first FROM w WHERE regexp_full_match(w, '\p{{L}}{{2,}}') AND NOT list_contains({sql.array(L.STOP_WORDS)}, w) GROUP BY ALL),
k0 AS (SELECT chunk_id, text, list(w ORDER BY n DESC, first)[1:5] AS keywords FROM f GROUP BY ALL),
k AS (SELECT t.chunk_id, t.text, coalesce(k0.keywords, []) AS keywords FROM t LEFT JOIN k0 ON t.chunk_id = k0.chunk_id AND t.text = k0.text)
"""


def _keyed(s: SparkSession, d: str) -> DataFrame:
    return _texts(s, d).distinct().withColumn("keywords", enrich.keywords("text"))


_add("e3_keywords", lambda s, d: _keyed(s, d).select("chunk_id", F.array_join("keywords", " ").alias("keywords")), _KEYS + "SELECT chunk_id, array_to_string(keywords, ' ') AS keywords FROM k")
_add(
    "e3_corpus_keywords",
    lambda s, d: enrich.corpus_keywords(_texts(s, d).distinct(), "chunk_id").select("chunk_id", F.array_join("keywords", " ").alias("keywords")),
    # A key has one row here, made of all its texts; every key of the test tables that has words has one text with keywords.
    _KEYS + "SELECT chunk_id, array_to_string(keywords, ' ') AS keywords FROM k WHERE len(keywords) > 0",
)
_add(
    "e8_summary",
    lambda s, d: _texts(s, d).select("chunk_id", F.md5(enrich.summary("text")).alias("hash")),
    f"WITH b AS (SELECT chunk_id, text, {sql.sentences('text')} AS s FROM enriched) SELECT chunk_id, md5(CASE WHEN len(s) <= 2 THEN text ELSE s[1] || ' ' || s[-1] END) AS hash FROM b",
)
_PATTERNED = ", ".join("CASE WHEN " + " OR ".join(f"contains(lower(text), {sql.q(m)})" for m in marks) + f" THEN {sql.q(question)} END" for marks, question in L.PATTERN_QUESTIONS)
_ASKED = ", ".join(f"CASE WHEN len(keywords) > {i} THEN replace({sql.q(t)}, '%s', keywords[{i + 1}]) END" for i, t in enumerate(L.QUESTION_TEMPLATES))
_add("e9_questions", lambda s, d: _keyed(s, d).select("chunk_id", F.array_join(enrich.questions(F.col("keywords"), F.col("text")), "|").alias("questions")), _KEYS + f"SELECT chunk_id, array_to_string(list_filter([{_ASKED}, {_PATTERNED}], lambda v: v IS NOT NULL)[1:5], '|') AS questions FROM k")
_POINTS = ", ".join(f"{{'minus': -(len(list_intersect(words, {sql.array(v)})) + 2 * len(list_intersect(keywords, {sql.array(v)}))), 'o': {i}, 'name': {sql.q(k)}}}" for i, (k, v) in enumerate(L.TOPICS.items()))
_add(
    "e10_topics",
    lambda s, d: _keyed(s, d).withColumn("r", enrich.topic_ranking(F.col("text"), F.col("keywords"))).select("chunk_id", F.array_join(F.transform("r", lambda t: F.concat_ws(":", t["name"], (-t["minus"]).cast("string"))), ",").alias("topics")),
    _KEYS + rf", p AS (SELECT chunk_id, keywords, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS words FROM k), r AS (SELECT chunk_id, list_filter(list_sort([{_POINTS}]), lambda t: t.minus < 0) AS r FROM p) SELECT chunk_id, array_to_string(list_transform(r, lambda t: t.name || ':' || (-t.minus)), ',') AS topics FROM r",
)
_CODE = " OR ".join(f"contains(text, {sql.q(m)})" for m in L.CODE_MARKS)
_HEADED = rf"""len(list_filter(range(1, len(l)), lambda i: length({sql.strip("l[i]")}) BETWEEN 1 AND 99 AND length({sql.strip("l[i+1]")}) > 50)) > 0 AS has_headings,
 regexp_matches(text, '(^|\n)\s*[-*•]\s+|[0-9]+\.\s+') AS has_lists, regexp_matches(text, '[0-9]') AS has_numbers, {_CODE} AS has_code, regexp_matches(text, 'https?://') AS has_urls,
 len(list_filter(string_split(text, chr(10) || chr(10)), lambda v: {sql.strip("v")} <> '')) AS paragraph_count, length(text) - length(replace(text, '?', '')) AS question_marks"""
_add(
    "e11_structure",
    lambda s, d: _texts(s, d).select("chunk_id", enrich.structure("text").alias("s")).select("chunk_id", "s.*"),
    f"WITH b AS (SELECT chunk_id, text, string_split(text, chr(10)) AS l FROM enriched) SELECT chunk_id, {_HEADED} FROM b",
)
_add("e5_entities", lambda s, d: _texts(s, d).select("chunk_id", F.explode(enrich.entities(F.col("text"))).alias("e")).select("chunk_id", "e.*"))

_add(
    "e_enrich",
    lambda s, d: enrich.enrich(_texts(s, d).distinct(), features=enrich.Features(keyword_methods=("frequency",))).select(
        "chunk_id", *[F.array_join(c, "|").alias(c) for c in ("keywords", "potential_questions", "topics")], F.md5("summary").alias("summary"), "primary_topic", "structure.*"
    ),
    _KEYS
    + rf""", p AS (SELECT *, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS words, {sql.sentences('text')} AS s, string_split(text, chr(10)) AS l FROM k),
r AS (SELECT *, list_filter(list_sort([{_POINTS}]), lambda t: t.minus < 0) AS r FROM p)
SELECT chunk_id, array_to_string(keywords, '|') AS keywords, array_to_string(list_filter([{_ASKED}, {_PATTERNED}], lambda v: v IS NOT NULL)[1:5], '|') AS potential_questions,
  array_to_string(list_transform(list_filter(r, lambda t: t.minus <= -2), lambda t: t.name), '|') AS topics, md5(CASE WHEN len(s) <= 2 THEN text ELSE s[1] || ' ' || s[-1] END) AS summary,
  CASE WHEN text IS NULL THEN NULL WHEN len(r) > 0 THEN r[1].name ELSE 'general' END AS primary_topic, {_HEADED} FROM r""",
)
_add(
    "e2_keywords",
    lambda s, d: enrich.enrich(_texts(s, d).distinct(), features=enrich.Features(entities=False, summary=False, questions=False, topics=False)).select("chunk_id", F.explode("keyword_details").alias("keyword", "d")).select("chunk_id", "keyword", F.round("d.score", 6).alias("score"), "d.method"),
)
_N_KEYS, _N_ENT = "coalesce(len(keywords), 0)", "coalesce(entity_count, 0)"
_add(
    "e18_stats",
    lambda s, d: enrich.stats(table(s, d, "enriched")),
    f"SELECT count(*) AS total_chunks, count_if({_N_KEYS} > 0) AS with_keywords, round(avg(CASE WHEN {_N_KEYS} > 0 THEN {_N_KEYS} END), 4) AS mean_keywords, count_if({_N_ENT} > 0) AS with_entities, round(avg(CASE WHEN {_N_ENT} > 0 THEN {_N_ENT} END), 4) AS mean_entities FROM enriched",
)

# ---- the viewer's queries -----------------------------------------------------------------------------------------

_view = _of("enriched")
_ORDER = "ORDER BY source_file, chunk_index, chunk_id"
_add("w1_lookup_position", lambda s, d: search.lookup(_view(s, d), position=5).select("chunk_id", "source_file", "chunk_index"), f"SELECT chunk_id, source_file, chunk_index FROM enriched {_ORDER} LIMIT 1 OFFSET 5")
_add(
    "w2_detail",
    lambda s, d: search.detail(_view(s, d)).select("chunk_id", F.array_join("keywords", " ").alias("keywords"), F.size("entity_types").alias("n_types"), "summary", F.md5("preview").alias("preview")),
    "SELECT chunk_id, array_to_string(keywords[1:10], ' ') AS keywords, cardinality(entity_types) AS n_types, summary[1:200] AS summary, md5(text[1:300]) AS preview FROM enriched",
)
_add("w3_overview", lambda s, d: search.overview(_view(s, d)), f"SELECT count(*) AS total_chunks, count_if({_N_KEYS} > 0) AS with_keywords, round(sum({_N_KEYS}) / count(*), 4) AS mean_keywords FROM enriched")
_add("w4_top_keywords", lambda s, d: search.top_keywords(_view(s, d)), "SELECT keyword, count(*) AS n FROM (SELECT unnest(keywords) AS keyword FROM enriched) GROUP BY keyword ORDER BY n DESC, keyword LIMIT 10")
_TYPED = "(SELECT unnest(map_entries(entity_types)) AS e FROM enriched)"
_add("w5_entity_distribution", lambda s, d: search.entity_distribution(_view(s, d)), f"SELECT e.key AS label, sum(len(e.value))::BIGINT AS n FROM {_TYPED} GROUP BY 1 ORDER BY n DESC, label LIMIT 10")
_add("w6_topic_distribution", lambda s, d: search.topic_distribution(_view(s, d), 10), "SELECT primary_topic AS topic, count(*) AS n FROM enriched WHERE primary_topic IS NOT NULL GROUP BY 1 ORDER BY n DESC, topic LIMIT 10")
_add("w7_structure_counts", lambda s, d: search.structure_counts(_view(s, d)), "SELECT count_if(structure.has_headings) AS with_headings, count_if(structure.has_lists) AS with_lists, count_if(structure.has_code) AS with_code, count_if(structure.has_numbers) AS with_numbers, count_if(structure.has_urls) AS with_urls FROM enriched")
_add(
    "w8_quality_bins",
    lambda s, d: search.quality_bins(_view(s, d)),
    "WITH b AS (SELECT CASE WHEN quality_score >= 0.9 THEN 'excellent' WHEN quality_score >= 0.7 THEN 'good' WHEN quality_score >= 0.5 THEN 'fair' ELSE 'poor' END AS bin FROM enriched WHERE quality_score IS NOT NULL) SELECT bin, count(*) AS n, round(100 * count(*) / (SELECT count(*) FROM b), 2) AS percent FROM b GROUP BY bin",
)
_add(
    "w9_keyword_search",
    lambda s, d: search.keyword_search(_view(s, d), "Ticket").select("chunk_id", F.md5(search.snippet("Ticket")).alias("snippet")),
    "SELECT chunk_id, CASE WHEN strpos(lower(text), 'ticket') > 0 THEN md5(text[greatest(strpos(lower(text), 'ticket') - 50, 1) : strpos(lower(text), 'ticket') + 55]) END AS snippet FROM enriched WHERE len(list_filter(coalesce(keywords, []), lambda k: lower(k) = 'ticket')) > 0 OR contains(lower(text), 'ticket')",
)
_add(
    "w11_entity_search",
    lambda s, d: search.entity_search(_view(s, d), "3").select("chunk_id", "matched_type"),
    "WITH m AS (SELECT chunk_id, list_sort(list_transform(list_filter(map_entries(entity_types), lambda e: len(list_filter(e.value, lambda t: contains(lower(t), '3'))) > 0), lambda e: e.key)) AS hits FROM enriched WHERE entity_types IS NOT NULL) SELECT chunk_id, hits[1] AS matched_type FROM m WHERE len(hits) > 0",
)
_add("w12_topic_search", lambda s, d: search.topic_search(_view(s, d), "Finance").select("chunk_id"), "SELECT chunk_id FROM enriched WHERE len(list_filter(coalesce(topics, []), lambda t: lower(t) = 'finance')) > 0")
_add("w13_list_topics", lambda s, d: search.list_topics(_view(s, d)), "SELECT topic, count(*) AS n FROM (SELECT unnest(topics) AS topic FROM enriched) GROUP BY topic")
_add("w14_list_entities", lambda s, d: search.list_entities(_view(s, d), "money"), f"SELECT 'MONEY' AS label, entity, count(*) AS n FROM (SELECT unnest(e.value) AS entity FROM {_TYPED} WHERE e.key = 'MONEY') GROUP BY entity ORDER BY n DESC, entity LIMIT 50")


def _compare(s: SparkSession, d: str) -> DataFrame:
    rows = _view(s, d)
    ends = rows.agg(F.min("chunk_id").alias("first"), F.max("chunk_id").alias("last")).first()
    return search.compare(rows, ends["first"], ends["last"]).select("chunk_id_a", "chunk_id_b", "token_count_a", "token_count_b", F.array_join(F.array_sort("shared_topics"), ",").alias("shared_topics"))


_add("w15_compare", _compare, "WITH e AS (SELECT min(chunk_id) AS a, max(chunk_id) AS b FROM enriched), x AS (SELECT * FROM enriched WHERE chunk_id = (SELECT a FROM e) LIMIT 1), y AS (SELECT * FROM enriched WHERE chunk_id = (SELECT b FROM e) LIMIT 1) SELECT x.chunk_id AS chunk_id_a, y.chunk_id AS chunk_id_b, x.token_count AS token_count_a, y.token_count AS token_count_b, array_to_string(list_sort(list_intersect(x.topics, y.topics)), ',') AS shared_topics FROM x, y")
_add(
    "w16_export_summary",
    lambda s, d: search.export_summary(_view(s, d)).select("total_chunks", "total_documents", "mean_tokens", "mean_quality", "n_keywords", F.element_at("top_keywords", 1)["keyword"].alias("top_keyword"), F.element_at("top_topics", 1)["topic"].alias("top_topic"), F.size("chunks_by_entity_type").alias("n_types")),
    f"SELECT count(*) AS total_chunks, count(DISTINCT source_file) AS total_documents, round(avg(token_count), 4) AS mean_tokens, round(avg(quality_score), 4) AS mean_quality, sum({_N_KEYS})::BIGINT AS n_keywords, (SELECT keyword FROM (SELECT unnest(keywords) AS keyword FROM enriched) GROUP BY keyword ORDER BY count(*) DESC, keyword LIMIT 1) AS top_keyword, (SELECT primary_topic FROM enriched WHERE primary_topic IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS top_topic, (SELECT count(DISTINCT e.key) FROM {_TYPED}) AS n_types FROM enriched",
)

# ---- orchestration ------------------------------------------------------------------------------------------------

_QUALITY = sql.quality("(SELECT doc_id, x AS text FROM cleaned)", "doc_id").strip().removeprefix("WITH ")
_ALIKE = _FUZZY.replace("FROM documents WHERE text IS NOT NULL", "FROM passing")
_add(
    "o3_funnel",
    lambda s, d: pipeline.funnel(table(s, d, "documents"), pipeline.Config(chunking=chunk.Chunking(strategy="token")), key="doc_id"),
    rf"""WITH RECURSIVE valid AS (SELECT doc_id, text FROM documents WHERE text IS NOT NULL AND {sql.strip('text')} <> ''), {_cleaning_sql('valid', 'doc_id')}, {_QUALITY},
passing AS (SELECT doc_id, x AS text, composite_score AS score FROM cleaned JOIN scored USING (doc_id) WHERE composite_score >= 0.5), {_ALIKE},
h AS (SELECT doc_id, {_HASH} AS hash FROM passing), x AS (SELECT hash, min(doc_id) AS first FROM h GROUP BY hash),
edges AS (SELECT a, b FROM p WHERE k / (n + m - k) >= 0.8 UNION SELECT r.a, s.doc_id FROM s JOIN r USING (g) WHERE s.doc_id <> r.a UNION SELECT first, doc_id FROM h JOIN x USING (hash) WHERE doc_id <> first),
{sql.components("edges")}, c0 AS (SELECT node, least(node, min(other)) AS component FROM reach GROUP BY node),
g0 AS (SELECT doc_id, text, row_number() OVER (PARTITION BY coalesce(component, doc_id) ORDER BY score DESC, doc_id) AS place FROM passing LEFT JOIN c0 ON doc_id = node),
t0 AS (SELECT len(regexp_extract_all(text, '\s*(?:[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}\s])')) AS n FROM g0 WHERE place = 1),
z AS (SELECT (SELECT count(*) FROM valid) AS n_valid, (SELECT count(*) FROM passing) AS n_passing, (SELECT count(*) FROM t0) AS n_kept, (SELECT sum(greatest(n - 51, 0) // 462 + 1)::BIGINT FROM t0 WHERE n > 0) AS n_chunks)
SELECT unnest([0, 1, 2, 3, 4, 5]) AS stage_no, unnest({sql.array(list(pipeline.STAGES))}) AS stage, unnest([n_valid, n_valid, n_passing, n_kept, n_chunks, n_chunks]) AS n_rows FROM z""",
)
