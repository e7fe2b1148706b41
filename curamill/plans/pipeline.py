"""The curation pipeline: validate, clean, score, deduplicate, chunk, enrich; each stage timed and reported."""

from __future__ import annotations

import argparse
import dataclasses
import json
import sys
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from curamill.operators import chunk, clean, dedup, enrich, ingest, quality
from curamill.session import build, clear, settle
from curamill.sources import files, sinks

STAGES = ("ingest", "clean", "quality", "dedup", "chunk", "enrich")


@dataclass(frozen=True)
class Config:
    """``semantic_threshold``: cosine from which files count as duplicates of meaning; without one that pass is left out."""

    cleaning: clean.Cleaning = clean.Cleaning()
    quality_threshold: float = 0.5
    fuzzy: dedup.Fuzzy = dedup.Fuzzy()
    semantic_threshold: float | None = None
    chunking: chunk.Chunking = chunk.Chunking()
    features: enrich.Features = enrich.Features()

    @staticmethod
    def load(path: str) -> Config:
        """A JSON file with any of the sections; what it leaves out keeps its default."""
        with open(path) as f:
            given = json.load(f)
        kinds = {"cleaning": clean.Cleaning, "fuzzy": dedup.Fuzzy, "chunking": chunk.Chunking, "features": enrich.Features}
        return Config(**{k: kinds[k](**v) if k in kinds else v for k, v in given.items()})


@dataclass
class Stage:
    """What a stage made: all its rows, the flag of those that go on (None: all), the columns they take along, and its
    reports by name."""

    rows: DataFrame
    flag: str | None
    carried: list[str]
    reports: dict[str, DataFrame] = field(default_factory=dict)

    @property
    def passed(self) -> DataFrame:
        return (self.rows.filter(self.flag) if self.flag else self.rows).select(*self.carried)


@dataclass
class Run:
    """The last stage's rows, what each stage made, and what happened."""

    output: DataFrame | None = None
    stages: dict[str, Stage] = field(default_factory=dict)
    report: list[dict] = field(default_factory=list)
    status: str = "running"


class StageFailed(RuntimeError):
    """A stage failed; ``run`` tells how far it went."""

    def __init__(self, name: str, run: Run, cause: Exception):
        super().__init__(f"{name}: {cause}")
        self.run = run


def _ingest(d: DataFrame, config: Config) -> Stage:
    checked = settle(ingest.validate(d).withColumn("is_valid_file", F.col("validation_status") == "valid"), "ingest")
    return Stage(checked, "is_valid_file", ["filename", "text"], {"stats": ingest.validation_stats(checked)})


def _clean(d: DataFrame, config: Config) -> Stage:
    cleaned = settle(clean.clean(d, options=config.cleaning).drop("text").withColumnRenamed("cleaned_text", "text"), "clean")
    return Stage(cleaned, None, ["filename", "text"], {"stats": clean.clean_stats(cleaned)})


def _quality(d: DataFrame, config: Config) -> Stage:
    scored = settle(quality.score(d, threshold=config.quality_threshold), "quality")
    return Stage(scored, "passes_threshold", ["filename", "text", "composite_score"], {"report": quality.report(scored, "filename"), "stats": quality.stats(scored)})


def _dedup(d: DataFrame, config: Config) -> Stage:
    edges = settle(dedup.passes(d, "filename", fuzzy=config.fuzzy, semantic_threshold=config.semantic_threshold), "edges")
    scores = d.select("filename", F.col("composite_score").alias("score")) if "composite_score" in d.columns else None
    resolved = settle(dedup.resolve(d, "filename", edges, scores), "resolved")
    placed = settle(d.select("filename", "text").join(resolved, "filename"), "dedup")
    groups = resolved.filter("NOT is_kept").groupBy("kept").agg(F.array_sort(F.collect_list("filename")).alias("removed"))
    return Stage(placed, "is_kept", ["filename", "text"], {"report": dedup.report(resolved, "filename", edges), "groups": groups, "stats": dedup.stats(d, "filename", resolved, edges)})


def _chunk(d: DataFrame, config: Config) -> Stage:
    pieces = settle(chunk.chunk(d, "filename", options=config.chunking).withColumnsRenamed({"filename": "source_file", "chunk_text": "text"}), "chunk")
    return Stage(pieces, None, pieces.columns, {"report": chunk.report(pieces, options=config.chunking), "sizes": chunk.size_histogram(pieces), "stats": chunk.stats(pieces)})


def _enrich(d: DataFrame, config: Config) -> Stage:
    rows = settle(enrich.enrich(d, features=config.features), "enrich")
    return Stage(rows, None, rows.columns, {"stats": enrich.stats(rows)})


def run(documents: DataFrame, config: Config = Config(), skip: tuple[str, ...] = (), key: str = "filename", text: str = "text") -> Run:
    """Take (filename, text) rows through the stages. Each stage's rows, those that don't go on included, are written to
    shared storage once, so later ones don't repeat it. A failing stage ends the run with ``StageFailed``, which holds the
    report so far."""
    unknown = set(skip) - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stages: {sorted(unknown)}")
    done, rows = Run(), documents.select(F.col(key).alias("filename"), F.col(text).alias("text"))
    for name, make in zip(STAGES, (_ingest, _clean, _quality, _dedup, _chunk, _enrich)):
        if name in skip:
            done.report.append({"stage": name, "status": "skipped", "seconds": 0.0, "rows": None, "rejected": None})
            continue
        began = time.time()
        try:
            stage = make(rows, config)
            rows = stage.passed
            count, every = rows.count(), stage.rows.count()
        except Exception as e:
            done.report.append({"stage": name, "status": "failed", "seconds": round(time.time() - began, 3), "rows": None, "rejected": None, "error": str(e)[:500]})
            done.status = "failed"
            raise StageFailed(name, done, e) from e
        done.stages[name], done.output = stage, rows
        done.report.append({"stage": name, "status": "completed", "seconds": round(time.time() - began, 3), "rows": count, "rejected": every - count})
    done.status = "completed"
    return done


def write(done: Run, folder: str) -> None:
    """Everything the run made, below ``folder``: a folder by stage, with the rows (in folders by the stage's flag, if it
    has one) and its reports as CSV, those with nested columns as JSON. Chunks come as JSON lines and as a readable dump,
    enriched chunks as JSON lines."""
    for name, stage in done.stages.items():
        place = f"{folder}/{name}"
        if name in ("chunk", "enrich"):
            sinks.write_json_lines(stage.rows, f"{place}/rows")
        elif stage.flag:
            sinks.write_routed(stage.rows, f"{place}/rows", stage.flag)
        else:
            sinks.write_table(stage.rows, f"{place}/rows")
        if name == "chunk":
            sinks.write_chunk_text(stage.rows.withColumnRenamed("text", "chunk_text"), f"{place}/readable")
        for title, report in stage.reports.items():
            if any(t.startswith(("array", "struct", "map")) for _, t in report.dtypes):
                sinks.write_json_lines(report, f"{place}/{title}")
            else:
                sinks.write_csv_report(report, f"{place}/{title}")


def summary(done: Run) -> list[str]:
    """A line per stage, and below it the stage's one-row statistics."""
    lines = []
    for r in done.report:
        lines.append(f"{r['stage']}: {r['status']}, {r['seconds']} s, rows {r['rows']}, rejected {r['rejected']}" + (f", {r['error']}" if "error" in r else ""))
        stats = done.stages[r["stage"]].reports.get("stats") if r["stage"] in done.stages else None
        if stats is not None:
            lines += [f"  {json.dumps(row.asDict(), default=str)}" for row in stats.limit(20).collect()]
    return lines


def funnel(documents: DataFrame, config: Config = Config(), key: str = "filename", text: str = "text") -> DataFrame:
    """(stage_no, stage, n_rows): how many rows pass each stage."""
    found = run(documents, config, key=key, text=text)
    return documents.sparkSession.createDataFrame([(i, r["stage"], r["rows"]) for i, r in enumerate(found.report)], "stage_no int, stage string, n_rows long")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """``python -m curamill.plans.pipeline INPUT OUTPUT``: 0 if all went well, 1 otherwise. A report is always written."""
    p = argparse.ArgumentParser(description="Curate the documents of a folder")
    p.add_argument("input")
    p.add_argument("output")
    p.add_argument("--config")
    p.add_argument("--skip", nargs="*", default=[], choices=STAGES)
    p.add_argument("--chunk-size", type=int)
    p.add_argument("--quality-threshold", type=float)
    p.add_argument("--semantic-threshold", type=float)
    a = p.parse_args(argv)
    config = Config.load(a.config) if a.config else Config()
    if a.chunk_size is not None:
        config = dataclasses.replace(config, chunking=dataclasses.replace(config.chunking, size=a.chunk_size))
    if a.quality_threshold is not None:
        config = dataclasses.replace(config, quality_threshold=a.quality_threshold)
    if a.semantic_threshold is not None:
        config = dataclasses.replace(config, semantic_threshold=a.semantic_threshold)
    spark = spark or build()
    found, error, began = Run(), None, time.time()
    try:
        found = run(files.scan_folder(spark, a.input), config, tuple(a.skip))
        write(found, a.output)
    except Exception as e:  # noqa: BLE001 - the report must come out
        error = str(e)[:500]
        found = e.run if isinstance(e, StageFailed) else found
        print(f"failed: {error[:300]}", file=sys.stderr)
    print("\n".join(summary(found)))
    report = {"status": "failed" if error else "completed", "error": error, "total_seconds": round(time.time() - began, 3), "stages": found.report, "generated_at": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())}
    spark.createDataFrame([(json.dumps(report),)], "value string").coalesce(1).write.mode("overwrite").text(f"{a.output}/report")
    clear(spark)
    return 1 if error else 0


if __name__ == "__main__":
    sys.exit(main())
