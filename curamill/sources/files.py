"""Reading raw files, texts, JSON lines and result tables."""

from __future__ import annotations

import io
import xml.etree.ElementTree as ET
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from curamill.operators.clean import html_to_text
from curamill.sources.charset import decode_bytes
from curamill.sources.pdf import read_pages

SUPPORTED = ("txt", "md", "html", "pdf", "docx")
#: Columns of enriched chunks, as JSON lines hold them.
ENRICHED = """chunk_id string, chunk_index int, total_chunks int, text string, token_count int, char_count int, source_file string, is_valid boolean,
chunking_strategy string, ends_complete boolean, starts_complete boolean, sentence_count int, word_count int, has_boundary_issues boolean, quality_score double,
document_metadata struct<source_file:string,file_size:bigint,char_count:bigint,estimated_tokens:bigint>, position_ratio double, position_category string,
keywords array<string>, keyword_details map<string,struct<score:double,method:string>>, entities array<struct<text:string,label:string,start:int,end:int>>,
entity_types map<string,array<string>>, entity_count int, summary string, potential_questions array<string>, topics array<string>, primary_topic string,
topic_scores map<string,int>, structure struct<has_headings:boolean,has_lists:boolean,has_numbers:boolean,has_code:boolean,has_urls:boolean,paragraph_count:int,question_marks:int>,
enrichment_timestamp timestamp, enrichment_version string, enrichment_error string"""
_WORD_NS = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_KIND = T.StructType([T.StructField(n, t) for n, t in (("text", T.StringType()), ("encoding", T.StringType()), ("page_count", T.IntegerType()), ("paragraph_count", T.IntegerType()), ("error_message", T.StringType()))])
_ARROW = pa.struct([("text", pa.string()), ("encoding", pa.string()), ("page_count", pa.int32()), ("paragraph_count", pa.int32()), ("error_message", pa.string())])


def read_docx(data: bytes) -> tuple[str, int]:
    """The paragraphs joined by blank lines, and their number, empty ones included."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        root = ET.fromstring(z.read("word/document.xml"))
    found = ["".join(t.text or "" for t in p.iter(f"{_WORD_NS}t")) for p in root.iter(f"{_WORD_NS}p")]
    return "\n\n".join(found), len(found)


def read_pdf(data: bytes) -> tuple[str, int]:
    """Pages, each with a blank line behind it, and their number."""
    pages = read_pages(data)
    return "".join(p + "\n\n" for p in pages), len(pages)


def extract(kind: str, data: bytes) -> dict:
    row = dict.fromkeys(("text", "encoding", "page_count", "paragraph_count", "error_message"))
    try:
        if kind in ("txt", "md", "html"):
            row["text"], row["encoding"] = decode_bytes(data)
            if kind == "html":
                row["text"] = html_to_text(row["text"])
        elif kind == "docx":
            row["text"], row["paragraph_count"] = read_docx(data)
        elif kind == "pdf":
            row["text"], row["page_count"] = read_pdf(data)
        else:
            row["error_message"] = f"unsupported format: {kind}"
    except Exception as e:  # noqa: BLE001 - one bad file must not end the scan
        row["error_message"] = str(e) or type(e).__name__
    return row


@F.arrow_udf(_KIND)
def _extracted(kinds: pa.Array, contents: pa.Array) -> pa.Array:
    return pa.array([extract(k or "", c or b"") for k, c in zip(kinds.to_pylist(), contents.to_pylist())], _ARROW)


def fingerprint(content: str | Column) -> Column:
    """What tells whether two files have the same bytes."""
    return F.md5(content)


def _empty_files(spark: SparkSession, folder: str) -> DataFrame:
    """Rows for the files of no bytes, which Spark's own listing leaves out; their names alone pass the driver."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    rows = [(f.getPath().toString(), f.getModificationTime() / 1000) for f in found if f.isFile() and not f.getLen() and f.getPath().getName()[0] not in "._"]
    empty = spark.createDataFrame(rows, "path string, seconds double")
    return empty.select("path", F.timestamp_seconds("seconds").alias("modificationTime"), F.lit(0).cast("bigint").alias("length"), F.unhex(F.lit("")).alias("content"))


def scan_folder(spark: SparkSession, folder: str) -> DataFrame:
    """One row per file right in ``folder``: name, format, size, fingerprint and the extracted text. Files of other
    formats and unreadable ones have a null text and an ``error_message``."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(folder)
    raw = raw.select("path", "modificationTime", "length", "content").unionByName(_empty_files(spark, folder))
    name = F.element_at(F.split("path", "/"), -1)
    kind = F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1))
    out = raw.select(name.alias("filename"), kind.alias("format"), F.col("length").alias("size_bytes"), fingerprint("content").alias("file_hash"), "modificationTime", _extracted(kind, F.col("content")).alias("x"))
    return out.select("filename", "format", "size_bytes", "file_hash", "modificationTime", "x.*", F.length("x.text").cast("bigint").alias("char_count"))


def read_texts(spark: SparkSession, folder: str) -> DataFrame:
    """(filename, text) of every ``*.txt`` file in a folder."""
    raw = spark.read.text(f"{folder}/*.txt", wholetext=True)
    return raw.select(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("filename"), F.col("value").alias("text"))


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Rows of a JSON-lines file; blank lines are skipped, missing fields null."""
    return spark.read.schema(schema).json(path)


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """(filename, composite_score) of a score file in JSON lines; empty if there is none."""
    schema = "filename string, composite_score double"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    exists = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)
    return spark.read.schema(schema).json(path) if exists else spark.createDataFrame([], schema)
