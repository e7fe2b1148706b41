"""Queries over the test tables, and their SQL where SQL can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from curamill.llm import encoding, leaks, level, mix, near, quality, sentences, split, survivor
from curamill.llm.prose import ANY_COMMON
from curamill.session import table

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks above the token maximum: those the splitter cuts."""
    chunks = table(spark, folder, "chunks").select("chunk_id", "text")
    return split.split_oversized(chunks).filter("piece_count > 1").select("chunk_id").distinct()


def p1_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Every chunk as pieces under the token maximum."""
    chunks = table(spark, folder, "chunks").select("chunk_id", "source_file", "text")
    return split.split_oversized(chunks).drop("text")


def p1_cover(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold of the pieces of each text: together, overlaps once, they are as long as it, and none is over the limit."""
    chunks = table(spark, folder, "chunks").select("chunk_id", "text", F.md5("text").alias("hash"))
    pieces = split.split_oversized(chunks).drop("text")
    first = F.count_if(F.col("piece_index") == 0)
    fresh = F.coalesce(F.length("piece_text"), F.lit(0)) - F.col("overlap_chars")
    return pieces.groupBy("chunk_id", "hash").agg(first.alias("deliveries"), (F.sum(fresh) / first).cast("bigint").alias("covered"), F.every(F.coalesce("piece_tokens", F.lit(0)) <= 1000).alias("within"), F.every((F.col("piece_index") == 0) | (F.col("overlap_chars") >= 200)).alias("overlapping"))


def _quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score_quality(table(spark, folder, "enriched").select("chunk_id", "text"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Enriched chunks that are lists, tables or junk."""
    return _quality(spark, folder).filter("NOT is_prose").select("chunk_id").distinct()


def p2_statistics(spark: SparkSession, folder: str) -> DataFrame:
    """True figures for every enriched chunk."""
    return _quality(spark, folder)


#: The statistics that plain patterns give as well.
FIGURES = ["word_count", "common_share", "line_end_share", "words_per_line", "distinct_share", "symbol_ratio", "digit_share", "mean_word_length"]


def p2_figures(spark: SparkSession, folder: str) -> DataFrame:
    """Words, lines, symbols and figures of every enriched chunk."""
    return quality.text_statistics(table(spark, folder, "enriched").select("chunk_id", "text")).select("chunk_id", *[F.round(c, 6).alias(c) for c in FIGURES])


def _graded(spark: SparkSession, folder: str) -> DataFrame:
    return level.grade_texts(table(spark, folder, "cleaned").select("output_file", "text"), keep_text=False)


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Files of prose on university level."""
    return _graded(spark, folder).filter("is_prose AND level = 4").select("output_file").distinct()


def p3_levels(spark: SparkSession, folder: str) -> DataFrame:
    """A level for every file."""
    return _graded(spark, folder)


#: Columns of a quality record that are voted on.
REPORT_FIELDS = ["composite_score", "category", "passes_threshold", "readability", "coherence", "information_density", "completeness", "linguistic_quality", "weakest_metric", "output_path"]


def _reports(spark: SparkSession, folder: str) -> DataFrame:
    """Quality records with the file they are about and the way their filename is written, which tells the tool."""
    reports = table(spark, folder, "quality_report")
    name = F.regexp_extract(F.lower(F.trim("filename")), r"([a-z0-9]+_\d{8}_\d+)(_[a-z]+)?( \(\d+\))?\.txt$", 0)
    stem = F.regexp_extract(name, r"^([a-z0-9]+_\d{8}_\d+)", 1)
    file = F.when(stem != "", stem).otherwise(F.lower(F.trim("filename")))
    style = F.concat_ws(
        "/",
        F.regexp_extract(name, r"_([a-z]+)( \(\d+\))?\.txt$", 1),
        F.when(F.col("filename").rlike(r"\\"), "windows path").when(F.col("filename").rlike("/"), "path"),
        F.when(F.col("filename").rlike(r"\(\d+\)"), "copy"),
        F.when(F.col("filename").rlike(r"^\s|\s$"), "padded"),
        F.when(F.col("filename") == F.upper("filename"), "upper").when(F.col("filename") != F.lower("filename"), "mixed"),
    )
    readability = F.when(F.col("readability") > 1, F.col("readability") / 100).otherwise(F.col("readability"))
    return reports.select("*", file.alias("file"), style.alias("written")).withColumn("readability", readability)


def _fused(spark: SparkSession, folder: str) -> survivor.Fused:
    reports = _reports(spark, folder)
    every = [c for c in reports.columns if c not in ("file", "written")]
    return survivor.fuse(reports, "file", "report_id", REPORT_FIELDS, "written", "composite_score", "assessed_at", counted=every)


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """The surviving record of each file with several."""
    return _fused(spark, folder).golden.filter("n_records > 1").select(F.col("representative_id").alias("report_id"))


def p4_golden(spark: SparkSession, folder: str) -> DataFrame:
    """One record per file, each field by weighted votes."""
    return _fused(spark, folder).golden.drop("field_confidence")


def p4_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """How many different records each file has."""
    return _fused(spark, folder).golden.select("file", "n_records")


def _repaired(spark: SparkSession, folder: str) -> DataFrame:
    return encoding.repair_encoding(table(spark, folder, "processed").select("filename", "text"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Files whose text was read with a wrong encoding."""
    return _repaired(spark, folder).filter("garbled").select("filename").distinct()


def p5_restored(spark: SparkSession, folder: str) -> DataFrame:
    """The garbled files with their text as it was, and how much cleaning really removed."""
    found = _repaired(spark, folder).filter("garbled").select("filename", "encoding_chain", "restoration", "garbled_lines", "restored_text", F.length("restored_text").alias("restored_length"))
    cleaned = table(spark, folder, "cleaned").select("source_file", "cleaned_length").groupBy("source_file").agg(F.max("cleaned_length").alias("cleaned_length"))
    stem = F.regexp_replace("filename", r"\.[^.]*$", "_processed.txt")
    return found.withColumn("source_file", stem).join(cleaned, "source_file", "left").withColumn("true_chars_removed", F.col("restored_length") - F.col("cleaned_length")).drop("cleaned_length")


#: TESTDATA.md sets three words and 0.6 for this problem.
NEAR = near.Sketching(shingle=3, threshold=0.6)


def _near(spark: SparkSession, folder: str) -> near.NearDuplicates:
    return near.near_duplicates(table(spark, folder, "deduplicated"), "filename", options=NEAR)


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of files that repeat each other with small changes."""
    return near.expand(_near(spark, folder)).select(F.col("a").alias("filename_a"), F.col("b").alias("filename_b"))


def p6_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Every file with its class of equal texts, its links and its group."""
    return _near(spark, folder).groups().withColumnRenamed("id", "filename")


def _leaks(spark: SparkSession, folder: str) -> DataFrame:
    return leaks.find_leaks(table(spark, folder, "documents"), table(spark, folder, "eval_items"))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with the items they leak."""
    return _leaks(spark, folder).select("doc_id", "item_id")


def p7_items(spark: SparkSession, folder: str) -> DataFrame:
    """How far each test item leaked."""
    items = table(spark, folder, "eval_items").select("item_id", "task", "lang")
    hits = _leaks(spark, folder).groupBy("item_id").agg(F.count(F.lit(1)).alias("n_documents"), F.max("n_words").alias("longest_run"))
    return items.join(hits, "item_id", "left").na.fill(0, ["n_documents", "longest_run"])


#: Where the vocabulary lies on this cluster's machines.
TOKENIZER = os.environ.get("TOKENIZER_FILE", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")


def _mixture(spark: SparkSession, folder: str) -> mix.Mixture:
    return mix.mix(table(spark, folder, "documents"), table(spark, folder, "mix_targets"), TOKENIZER)


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    """Sources too small for their share."""
    return _mixture(spark, folder).report.filter("short").select("source")


def p8_report(spark: SparkSession, folder: str) -> DataFrame:
    """Target and reached share of each source."""
    return _mixture(spark, folder).report


def p8_drawn(spark: SparkSession, folder: str) -> DataFrame:
    """The texts drawn, with their number of copies."""
    return _mixture(spark, folder).drawn


def p8_holds(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold of each source: nothing over the budget or the repeats, and less than one document under the budget unless
    the source is used up."""
    report = _mixture(spark, folder).report
    used_up = F.col("supply_tokens") * F.col("max_repeats")
    longest = 10_000  # tokens; no document of the test tables is longer
    return report.select(
        "source",
        (F.col("drawn_tokens") <= F.col("target_tokens")).alias("within_budget"),
        (F.col("most_copies") <= F.col("max_repeats")).alias("within_repeats"),
        (F.col("drawn_tokens") > F.least(F.col("target_tokens") - longest, used_up - 1)).alias("filled"),
        (F.col("short") == (used_up < F.col("target_tokens"))).alias("told"),
    )


def _sentences(spark: SparkSession, folder: str) -> DataFrame:
    prose = table(spark, folder, "documents").filter("layout = 'prose'").select("doc_id", "text")
    return sentences.split_sentences(prose)


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """Where each sentence of the prose documents begins."""
    return _sentences(spark, folder).select("doc_id", "start_pos").distinct()


def p9_sentences(spark: SparkSession, folder: str) -> DataFrame:
    """The sentences of the prose documents."""
    return _sentences(spark, folder)


def p9_cover(spark: SparkSession, folder: str) -> DataFrame:
    """How many letters and digits of each document stand in its sentences."""
    return _sentences(spark, folder).groupBy("doc_id").agg(F.sum(F.length(F.regexp_replace("sentence", r"[^\p{L}\p{N}]", ""))).alias("solid"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (p1_found, p1_pieces, p1_cover, p2_found, p2_statistics, p2_figures, p3_found, p3_levels, p4_found, p4_golden, p4_sizes, p5_found, p5_restored, p6_found, p6_groups, p7_found, p7_items, p8_found, p8_report, p8_drawn, p8_holds, p9_found, p9_sentences, p9_cover)}


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": "SELECT DISTINCT chunk_id FROM chunks WHERE length(text) // 4 > 1000",
        "p1_cover": "SELECT chunk_id, md5(text) AS hash, count(*) AS deliveries, coalesce(length(text), 0) AS covered, true AS within, true AS overlapping FROM chunks GROUP BY chunk_id, text",
        "p2_figures": _P2,
        "p4_found": _P4,
        "p4_sizes": r"SELECT coalesce(nullif(regexp_extract(lower(trim(filename)), '([a-z0-9]+_\d{8}_\d+)', 1), ''), lower(trim(filename))) AS file, count(DISTINCT report_id) AS n_records FROM quality_report WHERE filename IS NOT NULL GROUP BY 1",
        "p6_found": _P6,
        "p6_groups": _P6_GROUPS,
        "p7_found": _P7,
        "p7_items": _P7_ITEMS,
        # No source is close to its limit, so sizes in bytes tell the same as sizes in tokens.
        "p8_found": "SELECT t.source FROM mix_targets t LEFT JOIN (SELECT source, sum(strlen(text)) AS size FROM documents GROUP BY source) d ON t.source = d.source WHERE coalesce(size, 0) * max_repeats < target_share * (SELECT sum(strlen(text)) FROM documents)",
        "p8_holds": "SELECT source, true AS within_budget, true AS within_repeats, true AS filled, true AS told FROM mix_targets",
        "p9_cover": r"SELECT doc_id, length(regexp_replace(text, '[^\p{L}\p{N}]', '', 'g')) AS solid FROM documents WHERE layout = 'prose' AND regexp_matches(text, '[\p{L}\p{N}]')",
    }


_P4 = r"""
WITH r AS (
  SELECT *, regexp_extract(lower(trim(filename)), '([a-z0-9]+_\d{8}_\d+)', 1) AS file,
    (report_id IS NOT NULL)::int + (coalesce(filename,'') <> '')::int + (composite_score IS NOT NULL)::int + (coalesce(category,'') <> '')::int
    + (passes_threshold IS NOT NULL)::int + (readability IS NOT NULL)::int + (coherence IS NOT NULL)::int + (information_density IS NOT NULL)::int
    + (completeness IS NOT NULL)::int + (linguistic_quality IS NOT NULL)::int + (coalesce(weakest_metric,'') <> '')::int
    + (coalesce(output_path,'') <> '')::int + (assessed_at IS NOT NULL)::int AS filled
  FROM quality_report),
d AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY file, report_id ORDER BY assessed_at DESC, filled DESC) = 1),
m AS (SELECT file, count(*) AS n, max(coalesce(composite_score, -1)) AS s, max(assessed_at) AS a, max(filled) AS f FROM d GROUP BY file)
SELECT min(report_id) AS report_id FROM d JOIN m USING (file)
WHERE n > 1 AND coalesce(composite_score, -1) = s AND assessed_at = a AND filled = f GROUP BY file
"""

_P7 = r"""
WITH d AS (SELECT DISTINCT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM eval_items),
dg AS (SELECT doc_id, array_to_string(w[p:p+11], ' ') AS g FROM d, range(1, greatest(len(w) - 10, 1)) t(p) WHERE len(w) >= 12),
ig AS (SELECT DISTINCT item_id, array_to_string(w[p:p+11], ' ') AS g FROM i, range(1, greatest(len(w) - 10, 1)) t(p) WHERE len(w) >= 12)
SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (g)
"""

_P6 = r"""
WITH d AS (SELECT DISTINCT filename, text FROM deduplicated WHERE text IS NOT NULL),
w AS (SELECT filename, text, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM d),
s AS (SELECT DISTINCT filename, array_to_string(w[p:p+2], ' ') AS g FROM w, range(1, greatest(len(w) - 1, 1)) t(p) WHERE len(w) >= 3),
n AS (SELECT filename, count(*) AS n FROM s GROUP BY filename),
c AS (SELECT a.filename AS filename_a, b.filename AS filename_b, count(*) AS nb FROM s a JOIN s b ON a.g = b.g AND a.filename < b.filename GROUP BY ALL)
SELECT filename_a, filename_b FROM c JOIN n x ON x.filename = filename_a JOIN n y ON y.filename = filename_b WHERE nb >= 0.6 * (x.n + y.n - nb)
"""

_P6_GROUPS = r"""
WITH RECURSIVE d AS (SELECT DISTINCT filename, text FROM deduplicated WHERE filename IS NOT NULL),
w AS (SELECT filename, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM d),
s AS (SELECT filename, CASE WHEN len(w) >= 3 THEN list_sort(list_distinct(list_transform(range(1, len(w) - 1), lambda p: array_to_string(w[p:p+2], ' ')))) END AS g FROM w),
k AS (SELECT g, min(filename) AS class_id FROM s WHERE g IS NOT NULL GROUP BY g),
e AS (SELECT class_id, len(g) AS n, unnest(g) AS x FROM k),
p AS (SELECT l.class_id AS a, r.class_id AS b, l.n AS n, r.n AS m, count(*) AS nb FROM e l JOIN e r ON l.x = r.x AND l.class_id < r.class_id GROUP BY ALL),
edges AS (SELECT a, b FROM p WHERE nb >= 0.6 * (n + m - nb)),
ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach AS (SELECT a AS node, b AS other FROM ways UNION SELECT r.node, v.b FROM reach r JOIN ways v ON r.other = v.a),
c AS (SELECT node, least(node, min(other)) AS group_id FROM reach GROUP BY node),
n AS (SELECT a AS node, count(*) AS n_links FROM ways GROUP BY a)
SELECT DISTINCT filename, class_id, coalesce(group_id, class_id) AS group_id, coalesce(n_links, 0) AS n_links
FROM s LEFT JOIN k USING (g) LEFT JOIN c ON class_id = c.node LEFT JOIN n ON class_id = n.node
"""

_P7_ITEMS = r"""
WITH d AS (SELECT DISTINCT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM eval_items),
dg AS (SELECT doc_id, p, array_to_string(w[p:p+11], ' ') AS g FROM d, range(1, greatest(len(w) - 10, 1)) t(p) WHERE len(w) >= 12),
ig AS (SELECT item_id, p AS q, array_to_string(w[p:p+11], ' ') AS g FROM i, range(1, greatest(len(w) - 10, 1)) t(p) WHERE len(w) >= 12),
h AS (SELECT doc_id, item_id, p, p - q AS shift, p - row_number() OVER (PARTITION BY doc_id, item_id, p - q ORDER BY p) AS run FROM dg JOIN ig USING (g)),
r AS (SELECT doc_id, item_id, count(*) + 11 AS n FROM h GROUP BY doc_id, item_id, shift, run),
x AS (SELECT item_id, count(DISTINCT doc_id) AS n_documents, max(n) AS longest_run FROM r GROUP BY item_id)
SELECT e.item_id, task, lang, coalesce(n_documents, 0) AS n_documents, coalesce(longest_run, 0) AS longest_run FROM eval_items e LEFT JOIN x ON e.item_id = x.item_id
"""

_LISTED = ", ".join("'" + w.replace("'", "''") + "'" for w in sorted(ANY_COMMON))
_BLANK = r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_P2 = rf"""
WITH a AS (SELECT chunk_id, text, list_transform(regexp_extract_all(text, '[\p{{L}}\p{{M}}\p{{N}}]+'), lambda v: lower(v)) AS w,
  list_filter(list_transform(string_split(text, chr(10)), lambda v: regexp_replace(v, '{_BLANK}+$', '')), lambda v: v <> '') AS l,
  length(regexp_replace(text, '{_BLANK}', '', 'g')) AS solid FROM enriched),
b AS (SELECT *, len(w) AS n, len(l) AS m FROM a)
SELECT chunk_id, n AS word_count,
  round(CASE WHEN n > 0 THEN len(list_filter(w, lambda v: list_contains([{_LISTED}], v))) / n ELSE 0.0 END, 6) AS common_share,
  round(CASE WHEN m > 0 THEN len(list_filter(l, lambda v: contains('{quality.FINAL.replace("'", "''")}', v[-1:]))) / m ELSE 0.0 END, 6) AS line_end_share,
  round(CASE WHEN m > 0 THEN n / m ELSE 0.0 END, 6) AS words_per_line, round(CASE WHEN n > 0 THEN len(list_distinct(w)) / n ELSE 0.0 END, 6) AS distinct_share,
  round(CASE WHEN solid > 0 THEN len(regexp_extract_all(regexp_replace(text, '{_BLANK}', '', 'g'), '[^\p{{L}}\p{{M}}\p{{N}}]')) / solid ELSE 0.0 END, 6) AS symbol_ratio,
  round(CASE WHEN n > 0 THEN len(list_filter(w, lambda v: regexp_matches(v, '^\p{{Nd}}'))) / n ELSE 0.0 END, 6) AS digit_share,
  round(CASE WHEN n > 0 THEN list_sum(list_transform(w, lambda v: length(v))) / n ELSE 0.0 END, 6) AS mean_word_length
FROM b WHERE text IS NOT NULL
"""
