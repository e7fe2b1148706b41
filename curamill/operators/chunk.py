"""Chunking: four ways of splitting a text, and the metrics of each chunk."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from curamill.functions import text as X
from curamill.functions.columns import make_room

# The separators each strategy tries, strongest first.
LADDERS = {
    "recursive": ["\n\n\n", "\n\n", "\n", ". ", "! ", "? ", " ", ""],
    "fixed": ["\n\n", "\n", ". ", " ", ""],
    "default": ["\n\n", "\n", " ", ""],
}
OUTPUTS = ("chunk_id", "chunk_index", "total_chunks", "chunk_text", "token_count", "char_count", "is_valid", "chunking_strategy", "ends_complete", "starts_complete", "sentence_count", "word_count", "has_boundary_issues", "quality_score", "document_metadata", "position_ratio", "position_category")


@dataclass(frozen=True)
class Chunking:
    strategy: str = "recursive"
    size: int = 512
    overlap: int = 50
    min_tokens: int = 100
    max_tokens: int = 1000
    chars_per_token: int = 4

    def __post_init__(self):
        if not 0 <= self.overlap < self.size:
            raise ValueError("overlap must be smaller than size")


def _parts(text: str, ladder: list[str], size: int) -> list[str]:
    """Pieces of at most ``size`` characters where the ladder allows; each separator opens the piece it precedes."""
    if len(text) <= size:
        return [text] if text else []
    at = next((i for i, s in enumerate(ladder) if s == "" or s in text), len(ladder) - 1)
    separator, rest = ladder[at], ladder[at + 1 :]
    if separator == "":
        return [text[i : i + size] for i in range(0, len(text), size)]
    head, *tail = text.split(separator)
    pieces = ([head] if head else []) + [separator + t for t in tail]
    out: list[str] = []
    for piece in pieces:
        out += [piece] if len(piece) <= size or not rest else _parts(piece, rest, size)
    return out


def pack(pieces: list[str], size: int, overlap: int) -> list[str]:
    """Neighbouring pieces joined up to ``size``; each chunk begins with the last pieces of the one before, as far as
    they fit into ``overlap``. Chunks are stripped, empty ones dropped."""
    out: list[str] = []
    held: list[str] = []
    length = 0
    for piece in pieces:
        if held and length + len(piece) > size:
            out.append("".join(held))
            first = 0
            while first < len(held) and (length > overlap or length + len(piece) > size):
                length -= len(held[first])
                first += 1
            held = held[first:]
        held.append(piece)
        length += len(piece)
    out.append("".join(held))
    return [c for c in (x.strip() for x in out) if c]


def split_text(text: str, options: Chunking) -> list[str]:
    size, overlap = options.size * options.chars_per_token, options.overlap * options.chars_per_token
    ladder = LADDERS.get(options.strategy, LADDERS["default"])
    return pack(_parts(text, ladder, size), size, overlap)


def _sentence_pieces(x: Column) -> Column:
    return F.split(F.regexp_replace(x, r"([.!?。！？]+\s*)", "$1\x01"), "\x01")


def pieces(x: str | Column, options: Chunking = Chunking()) -> Column:
    """The chunks of a text as an array; ``token`` windows over words and marks stay in the JVM."""
    c = F.col(x) if isinstance(x, str) else x
    if options.strategy == "token":
        step = options.size - options.overlap

        def cut_tokens(t: Column) -> Column:
            starts = F.sequence(F.lit(0), F.greatest(F.size(t) - options.overlap - 1, F.lit(0)), F.lit(step))
            return F.when(F.size(t) > 0, F.transform(starts, lambda i: X.strip(F.array_join(F.slice(t, i + 1, options.size), ""))))

        return X.let(F.regexp_extract_all(c, F.lit(r"\s*(?:[\p{L}\p{N}]+|[^\p{L}\p{N}\s])"), F.lit(0)), cut_tokens)
    if options.strategy == "semantic":
        size, overlap = options.size * options.chars_per_token, options.overlap * options.chars_per_token

        @F.arrow_udf("array<string>")
        def packed(parts: pa.Array) -> pa.Array:
            return pa.array([None if p is None else pack([x for x in p if x], size, overlap) for p in parts.to_pylist()], pa.list_(pa.string()))

        return packed(_sentence_pieces(c))

    @F.arrow_udf("array<string>")
    def cut(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else split_text(t, options) for t in texts.to_pylist()], pa.list_(pa.string()))

    return cut(c)


def chunk_metrics(df: DataFrame, text: str, options: Chunking = Chunking()) -> DataFrame:
    """Adds the metrics of a chunk that follow from its text."""
    c = F.col(text)
    bare = X.strip(c)
    out = df.withColumn("token_count", X.approx_tokens(c)).withColumn("char_count", F.length(c))
    out = out.withColumn("is_valid", F.col("token_count").between(options.min_tokens, options.max_tokens))
    out = out.withColumn("ends_complete", F.coalesce(F.right(bare, F.lit(1)).isin(".", "!", "?"), F.lit(False)))
    out = out.withColumn("starts_complete", F.coalesce(bare.rlike(r"^\p{Lu}"), F.lit(False)))
    out = out.withColumn("sentence_count", F.size(F.filter(F.split(c, "[.!?]+"), lambda s: X.strip(s) != "")))
    out = out.withColumn("word_count", F.size(X.fields(c)))
    out = out.withColumn("has_boundary_issues", F.coalesce(bare.startswith("-") | bare.endswith("-"), F.lit(False)))
    quality = F.lit(1.0) - F.when(F.col("ends_complete"), 0.0).otherwise(0.3) - F.when(F.col("starts_complete"), 0.0).otherwise(0.2) - F.when(F.col("has_boundary_issues"), 0.2).otherwise(0.0)
    return out.withColumn("quality_score", F.greatest(quality, F.lit(0.0)))


def position(df: DataFrame, index: str = "chunk_index", total: str = "total_chunks") -> DataFrame:
    ratio = F.col(index) / F.greatest(F.col(total), F.lit(1))
    return df.withColumn("position_ratio", ratio).withColumn("position_category", F.when(ratio < 0.25, "beginning").when(ratio < 0.75, "middle").when(ratio.isNotNull(), "end"))


def chunk(df: DataFrame, name: str, text: str = "text", options: Chunking = Chunking()) -> DataFrame:
    """One row per chunk: the input's columns without the text, and ``OUTPUTS``. Null, empty and blank texts give no
    chunk. ``chunk_id`` is the name without ``.txt``, an underscore and the index. Clashing input columns come out as
    ``<name>_input``."""
    df = make_room(df, OUTPUTS, keep=[name, text])
    kept = [c for c in df.columns if c != text]
    about = F.struct(F.col(name).cast("string").alias("source_file"), F.octet_length(text).cast("bigint").alias("file_size"), F.length(text).cast("bigint").alias("char_count"), F.floor(F.length(text) / options.chars_per_token).alias("estimated_tokens"))
    out = df.select(*kept, about.alias("document_metadata"), pieces(text, options).alias("__p"))
    out = out.select(*kept, "document_metadata", F.size("__p").alias("total_chunks"), F.posexplode("__p").alias("chunk_index", "chunk_text"))
    stem = F.regexp_replace(F.col(name).cast("string"), r"\.txt$", "")
    out = out.withColumn("chunk_id", F.concat_ws("_", stem, F.col("chunk_index").cast("string"))).withColumn("chunking_strategy", F.lit(options.strategy))
    return position(chunk_metrics(out, "chunk_text", options))


def stats(chunks: DataFrame, document: str = "source_file") -> DataFrame:
    """One row: documents, chunks, and mean, median and population deviation of the sizes, cut to whole tokens."""
    return chunks.agg(
        F.countDistinct(document).alias("total_documents"),
        F.count(F.lit(1)).alias("total_chunks"),
        F.avg("token_count").cast("int").alias("mean_tokens"),
        F.percentile("token_count", F.lit(0.5)).cast("int").alias("median_tokens"),
        F.stddev_pop("token_count").cast("int").alias("std_tokens"),
    )


def size_histogram(chunks: DataFrame, width: int = 100) -> DataFrame:
    """(from_tokens, n): how many chunks there are by size in steps of ``width`` tokens; steps without any are left out."""
    step = F.floor(F.col("token_count") / width) * width
    return chunks.filter("token_count IS NOT NULL").groupBy(step.cast("int").alias("from_tokens")).agg(F.count(F.lit(1)).alias("n")).orderBy("from_tokens")


def report(chunks: DataFrame, document: str = "source_file", options: Chunking = Chunking()) -> DataFrame:
    """A row per document, most chunks first, then by name."""
    return (
        chunks.groupBy(document)
        .agg(
            F.count(F.lit(1)).alias("num_chunks"),
            F.avg("token_count").cast("int").alias("avg_tokens_per_chunk"),
            F.round(F.avg("quality_score"), 3).alias("avg_quality_score"),
            F.count_if(F.col("token_count") < options.min_tokens).alias("chunks_too_small"),
            F.count_if(F.col("token_count") > options.max_tokens).alias("chunks_too_large"),
        )
        .orderBy(F.desc("num_chunks"), document)
    )
