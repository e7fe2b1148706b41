"""The engine's own operators against small specifications in plain Python and hand-computed rows."""

import io
import itertools
import json
import re
import zipfile
import zlib
from pathlib import Path
from types import SimpleNamespace

import duckdb
import numpy as np
import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from curamill import session
from curamill.functions import encoders, text as X
from curamill.functions.columns import make_room
from curamill.functions.register import register
from curamill.functions.skew import join_unique
from curamill.operators import chunk, clean, dedup, enrich, ingest, keywords, quality, search
from curamill.operators.components import connected_components
from curamill.plans import catalogue, pipeline, viewer
from curamill.sources import charset, files, pdf, sinks
from curamill.streaming import curate

EDGE = ["", " ", " x ", "a.b", "a ,b !!", "...", "A\nA\nB\nA", "\n\n", "x \nx", "\x1cfs\x1f", "Page 3 of 9\n12\ntext 12 text", "Ünïcode Straße ÉCOLE", "日本語。", "a_b-c", "x" * 5000, "no. 5 is 3.14 ok? Yes! (see p. 2)"]


def column(spark, values, expr):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, text string")
    return [r[0] for r in rows.select("i", expr(F.col("text")).alias("y")).orderBy("i").select("y").collect()]


def texts(data):
    found = duckdb.connect().execute(f"SELECT text FROM '{data}/documents.parquet' WHERE text IS NOT NULL").fetchall()
    return [t for (t,) in found] + EDGE


def test_strip_and_fields_are_pythons(spark, data):
    values = texts(data)
    assert column(spark, values, X.strip) == [v.strip() for v in values]
    assert column(spark, values, X.fields) == [v.split() for v in values]


def test_ratios_are_pythons(spark, data):
    values = texts(data)
    special = [sum(not c.isalnum() and not c.isspace() for c in v) / len(v) if v else None for v in values]
    got = column(spark, values, X.special_ratio)
    # Characters that are numeric without being digits or letters in one of the two are the only ones to differ.
    assert all(a == b or abs(a - b) < 0.02 for a, b in zip(got, special))
    assert column(spark, values, X.non_ascii_ratio) == [sum(ord(c) > 127 for c in v) / len(v) if v else None for v in values]


def test_repeated_lines(spark, data):
    def spec(v):
        lines = v.split("\n")
        return "\n".join(x for i, x in enumerate(lines) if i == 0 or not x.strip() or x != lines[i - 1])

    values = texts(data)
    assert column(spark, values, clean.drop_repeated_lines) == [spec(v) for v in values]


def test_punctuation_in_both_modes(spark):
    assert column(spark, ["a,b ,c!! d..."], clean.punctuation) == ["a, b, c! d."]
    assert column(spark, ["a,b!!"], lambda c: clean.punctuation(c, compat=True)) == ["a\\1 \\2\\1"]


def test_page_lines_hyphens_bullets(spark):
    assert column(spark, ["a\nPage 3 of 9\n12\nb 12 c"], clean.drop_page_lines) == ["a\nb 12 c"]
    assert column(spark, ["well-\nknown"], clean.join_hyphens) == ["wellknown"]
    assert column(spark, ["• a\n  ▪ b"], clean.bullets) == ["- a\n- b"]


def test_shingles(spark):
    values = ["abcd", "ab", "", "日本語日本語"]
    assert [set(x) for x in column(spark, values, X.char_shingles)] == [{v[i : i + 3] for i in range(len(v) - 2)} for v in values]
    assert column(spark, ["a b c d e a b c d e"], X.word_shingles)[0] == ["a b c d e", "b c d e a", "c d e a b", "d e a b c", "e a b c d"]


def test_make_room_renames_clashes(spark):
    df = spark.createDataFrame([(1, 2, 3)], "text int, Score int, score_input int")
    assert make_room(df, ["score"], keep=["text"]).columns == ["text", "Score_input", "score_input_input"]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_join_unique_matches_a_plain_join(spark, how):
    left = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500).alias("k"), "id").withColumn("k", F.when(F.col("id") == 5, None).otherwise(F.col("k")))
    right = spark.range(300).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    rows = lambda df: sorted(((r["k"] is not None, r["k"] or 0, r["id"], r["v"] or 0) for r in df.collect()))
    assert rows(join_unique(left, right, ["k"], how)) == rows(left.join(right, "k", how))


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(1, i) for i in range(2, 40)]
    edges = spark.createDataFrame([*chain, *star, (7, 7), (1, 2), (500, 501)], "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    assert all(got[i] == 100 for i in range(100, 141)) and all(got[i] == 1 for i in range(1, 40)) and got[501] == 500
    assert connected_components(edges.limit(0)).count() == 0


def test_validation_edges(spark):
    rows = spark.createDataFrame([("n", None), ("e", ""), ("b", " \n"), ("s", "x" * 49), ("m", "word " * 20), ("o", "This is a plain sentence of more than fifty characters, yes.")], "filename string, text string")
    got = {r["filename"]: (r["validation_status"], r["validation_issues"]) for r in ingest.validate(rows).collect()}
    assert got["n"][0] == "error" and got["e"] == ("invalid", ["Empty text"]) and got["b"][0] == "invalid"
    assert got["s"] == ("valid", ["Text too short: 49 characters"]) and got["m"][1] == ["Low word diversity: 5.00%"] and got["o"] == ("valid", [])


def test_clean_nulls_and_clashes(spark):
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "See https://a.b/c?d or me@x.org\r\n\r\n\r\n\r\nend")], "status int, text string")
    got = {r["status_input"]: r for r in clean.clean(rows).collect()}
    assert got[1]["cleaned_text"] is None and got[1]["status"] == "failed" and got[2]["cleaned_text"] == ""
    assert got[3]["cleaned_text"] == "See [URL] or [EMAIL]\n\nend" and got[3]["extracted_emails"] == ["me@x.org"]


def test_html_and_repair():
    assert clean.html_to_text("<p>a<b>b</b><!-- c --><script>d</script></p>") == "abd"
    assert clean.repair("cafÃ© &amp; thÃ©\r\nx") == "café & thé\nx"


def test_quality_bands_and_ties(spark):
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "One. Two."), (4, "12 34. 56 78!")], "id int, text string")
    got = {r["id"]: r for r in quality.score(rows).collect()}
    assert got[1]["completeness"] == 0.0 and got[1]["readability"] == 0.5 and got[2]["information_density"] == 0.3
    assert got[4]["linguistic_quality"] == 0.5 and got[1]["weakest_metric"] == "completeness"
    assert column(spark, ["0.8", "0.65", "0.5", "0.35", "0.1"], lambda c: quality.category(c.cast("double"))) == ["excellent", "good", "acceptable", "poor", "very_poor"]


def test_fuzzy_pairs_against_brute_force(spark):
    base = [" ".join(f"w{(i * 7 + j) % 97}x{i}" for j in range(60)) for i in range(6)]
    docs = [(i, b) for i, b in enumerate(base)] + [(10, base[0].upper()), (11, base[1].replace("w20x1", "other")), (12, base[2] + " tail"), (13, None), (14, ""), (15, "too short")]
    df = spark.createDataFrame(docs, "id long, text string")

    def grams(t):
        w = re.sub(r"[^\w ]", "", t.lower()).split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    sets = {i: grams(t) for i, t in docs if t}
    want = {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8}
    assert {(r["a"], r["b"]) for r in dedup.fuzzy_edges(df, "id").collect()} == want
    tight = dedup.Fuzzy(bucket=1)  # every bucket is joined block by block
    assert {(r["a"], r["b"]) for r in dedup.fuzzy_edges(df, "id", options=tight).collect()} == want


def test_semantic_pairs_and_search(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    base = rng.standard_normal((60, 32))
    near = base[:20] + 0.1 * rng.standard_normal((20, 32))
    vectors = np.concatenate([base, near])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)] + [(1000, None), (1001, [0.0] * 32)], "vec_id long, embedding array<float>")
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    want = {(i, j) for i, j in itertools.combinations(range(80), 2) if unit[i] @ unit[j] >= 0.95}
    got = {(r["a"], r["b"]) for r in dedup.semantic_edges(df, "vec_id").collect()}
    assert got <= want and len(got) >= 0.9 * len(want) > 10
    found = dedup.nearest(df, df.filter("vec_id % 10 = 0"), "vec_id", threshold=0.9, block=3).collect()
    assert {(r["query_id"], r["vec_id"]) for r in found} == {(i, j) for i in range(0, 80, 10) for j in range(80) if unit[i] @ unit[j] >= 0.9}


def test_resolution_prefers_score_then_name(spark):
    rows = spark.createDataFrame([("a", "x y"), ("b", "X  y"), ("c", "x, y"), ("d", "z")], "filename string, text string")
    edges = dedup.exact_edges(rows, "filename")
    scores = spark.createDataFrame([("b", 0.9), ("c", 0.9)], "filename string, score double")
    out = dedup.resolve(rows, "filename", edges, scores)
    assert {r["filename"]: r["kept"] for r in out.collect()} == {"a": "b", "b": "b", "c": "b", "d": "d"}
    assert sorted(r["filename"] for r in dedup.survivors(rows, "filename", out).collect()) == ["b", "d"]
    assert dedup.stats(rows, "filename", out, edges).first()["rate_percent"] == 50.0


@pytest.mark.parametrize("strategy", ["recursive", "fixed", "other"])
def test_splitter_invariants(data, strategy):
    options = chunk.Chunking(strategy=strategy, size=50, overlap=10)
    for t in texts(data):
        pieces = chunk.split_text(t, options)
        assert all(0 < len(p) <= 200 for p in pieces)
        assert "".join(t.split()) == "" or "".join(pieces[0].split())[:20] == "".join(t.split())[:20][: len("".join(pieces[0].split())[:20])]
        at = 0
        for p in pieces:  # every chunk is a stretch of the text, in order
            found = t.find(p, max(0, at - 210))
            assert found >= 0
            at = found + len(p)


def test_chunk_metrics_edges(spark):
    rows = spark.createDataFrame([("d.txt", "One two. Three four five. " * 200), ("e.txt", ""), ("n.txt", None)], "name string, text string")
    out = chunk.chunk(rows, "name").orderBy("chunk_index").collect()
    assert {r["name"] for r in out} == {"d.txt"} and [r["chunk_index"] for r in out] == list(range(len(out)))
    assert out[0]["chunk_id"] == "d_0" and out[0]["position_category"] == "beginning" and all(r["char_count"] <= 2048 for r in out)
    scored = chunk.chunk_metrics(spark.createDataFrame([("-low",), ("Up.",), (" ",)], "t string"), "t").collect()
    assert [r["quality_score"] for r in scored] == [1 - 0.3 - 0.2 - 0.2, 1.0, 1 - 0.3 - 0.2]


def test_enrichment_edges(spark):
    rows = spark.createDataFrame([(1, "Apple pear apple. Pear plum. How to fix the example? It costs $5.00 on 2024-01-02."), (2, ""), (3, None)], "topics int, text string")
    got = {r["topics_input"]: r for r in enrich.enrich(rows, features=enrich.Features(keyword_methods=("frequency",))).collect()}
    assert got[1]["keywords"][:3] == ["apple", "pear", "plum"] and got[1]["entity_types"]["MONEY"] == ["$5.00"] and got[1]["entity_types"]["DATE"] == ["2024-01-02"]
    assert got[1]["potential_questions"][-1] == "Can you provide examples?" and got[2]["primary_topic"] == "general" and got[3]["keywords"] is None
    same = enrich.corpus_keywords(rows.select("topics", "text"), "topics").collect()
    assert [r["keywords"] for r in same] == [got[1]["keywords"]]


def test_features_can_be_switched_off(spark):
    rows = spark.createDataFrame([(1, "The bank lent money to Paris. It was a good loan. The bank said so.")], "id int, text string")
    off = enrich.enrich(rows, features=enrich.Features(False, False, False, False, False)).first()
    assert all(off[c] is None for c in ("keywords", "keyword_details", "entities", "entity_types", "entity_count", "summary", "potential_questions", "topics", "primary_topic", "topic_scores"))
    assert off["structure"]["paragraph_count"] == 1 and off["enrichment_version"] == "1.0" and off["enrichment_timestamp"] is not None
    some = enrich.enrich(rows, features=enrich.Features(keywords=False, keyword_methods=("frequency",))).first()
    assert some["keywords"] is None and some["potential_questions"][0] == "What is bank?" and some["primary_topic"] == "finance"


def test_files_in_every_format(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("Größe".encode())
    (tmp_path / "b.md").write_bytes("Größe".encode("cp1252"))
    (tmp_path / "c.html").write_text("<b>x</b>y")
    (tmp_path / "d.xyz").write_text("?")
    body = '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:p><w:t>one</w:t></w:p><w:p/><w:p><w:t>two</w:t></w:p></w:document>'
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("word/document.xml", body)
    (tmp_path / "e.docx").write_bytes(buffer.getvalue())
    (tmp_path / "f.docx").write_bytes(b"broken")
    got = {r["filename"]: r for r in files.scan_folder(spark, str(tmp_path)).collect()}
    assert got["a.txt"]["text"] == got["b.md"]["text"] == "Größe" and got["c.html"]["text"] == "xy"
    assert got["e.docx"]["text"] == "one\n\n\n\ntwo" and got["e.docx"]["paragraph_count"] == 3
    assert got["d.xyz"]["text"] is None and got["f.docx"]["error_message"]


def a_pdf(contents, packed=False, font=b"<< /Type /Font /Subtype /Type1 /Encoding /WinAnsiEncoding >>", extra=b""):
    pages = [f"<< /Type /Page /Parent 2 0 R /Contents {10 + i} 0 R >>".encode() for i in range(len(contents))]
    kids = b" ".join(f"{20 + i} 0 R".encode() for i in range(len(contents)))
    plain = {1: b"<< /Type /Catalog /Pages 2 0 R >>", 2: b"<< /Type /Pages /Kids [" + kids + b"] /Resources << /Font << /F1 3 0 R >> >> >>", 3: font, **{20 + i: p for i, p in enumerate(pages)}}
    out = b"%PDF-1.5\n"
    if packed:
        head, body = b"", b""
        for n, v in plain.items():
            head, body = head + f"{n} {len(body)} ".encode(), body + v + b" "
        data = zlib.compress(head + body)
        out += f"90 0 obj << /Type /ObjStm /N {len(plain)} /First {len(head)} /Filter /FlateDecode /Length {len(data)} >> stream\n".encode() + data + b"\nendstream endobj\n"
    else:
        out += b"".join(f"{n} 0 obj ".encode() + v + b" endobj\n" for n, v in plain.items())
    for i, c in enumerate(contents):
        data = zlib.compress(c)
        out += f"{10 + i} 0 obj << /Filter [/FlateDecode] /Length {len(data)} >>\nstream\r\n".encode() + data + b"\nendstream\nendobj\n"
    return out + extra + b"trailer << /Root 1 0 R >>\n%%EOF"


@pytest.mark.parametrize("packed", [False, True])
def test_pdf_pages(packed):
    first = b"BT /F1 12 Tf 72 700 Td (Caf\\351 \\(two\\)) Tj 0 -14 Td [(Wo) -20 (rld) -400 (again)] TJ T* <48C9> Tj ET"
    assert pdf.read_pages(a_pdf([first, b"BT /F1 9 Tf 1 0 0 1 72 700 Tm (a) Tj 1 0 0 1 90 700 Tm (b) Tj 1 0 0 1 72 680 Tm (c) ' ET", b"q Q"], packed)) == ["Café (two)\nWorld again\nHÉ", "a b\nc", ""]


def test_pdf_code_maps_and_failures(spark, tmp_path):
    cmap = b"2 beginbfchar <0001> <65E5> <0002> <672C> endbfchar 1 beginbfrange <0010> <0012> <0041> endbfrange"
    wide = b"<< /Type /Font /Subtype /Type0 /ToUnicode 50 0 R >>"
    body = a_pdf([b"BT /F1 9 Tf <00010002001000110012> Tj ET"], font=wide, extra=b"50 0 obj << /Length 3 >> stream\n" + cmap + b"\nendstream endobj\n")
    assert pdf.read_pages(body) == ["日本ABC"]
    named = b"<< /Type /Font /Subtype /Type1 /Encoding << /Differences [65 /eacute /uni20AC /fi] >> >>"
    assert pdf.read_pages(a_pdf([b"BT /F1 9 Tf (ABCD) Tj ET"], font=named)) == ["é€fiD"]
    (tmp_path / "a.pdf").write_bytes(body)
    (tmp_path / "b.pdf").write_bytes(b"no")
    (tmp_path / "c.pdf").write_bytes(body.replace(b"/Root", b"/Encrypt 9 0 R /Root"))
    got = {r["filename"]: r for r in files.scan_folder(spark, str(tmp_path)).collect()}
    assert (got["a.pdf"]["text"], got["a.pdf"]["page_count"], got["a.pdf"]["error_message"]) == ("日本ABC\n\n", 1, None)
    assert got["b.pdf"]["error_message"] == "not a PDF file" and got["c.pdf"]["error_message"] == "encrypted PDF"


@given(st.binary(max_size=300))
def test_pdf_reader_ends_on_any_bytes(data):
    try:
        pdf.read_pages(b"%PDF-1.4\n1 0 obj << /Type /Catalog /Pages 2 0 R >> endobj 2 0 obj << /Kids [3 0 R 2 0 R] >> endobj 3 0 obj << /Type /Page /Contents 4 0 R >> endobj 4 0 obj << >> stream\n" + data + b"\nendstream endobj " + data)
    except ValueError:
        pass


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0, True, ["x"]), ("b", None, False, None)], "name string, v double, ok boolean, l array<string>")
    sinks.write_routed(df, str(tmp_path / "r"), "ok")
    assert sorted(p.name for p in (tmp_path / "r").iterdir() if p.is_dir()) == ["ok=false", "ok=true"]
    sinks.write_csv_report(df, str(tmp_path / "c"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "c")).count() == 2
    sinks.write_json_lines(df, str(tmp_path / "j"))
    assert files.read_json_lines(spark, str(tmp_path / "j"), "name string, v double").filter("v IS NULL").count() == 1
    assert files.read_scores(spark, str(tmp_path / "none")).count() == 0


def test_sql_functions(spark):
    register(spark)
    row = spark.sql("SELECT cm_strip(' a ') AS s, cm_comparable('A,  b!') AS c, cm_tokens('a b.') AS t, cm_approx_tokens('abcdefgh') AS n").first()
    assert (row["s"], row["c"], row["t"], row["n"]) == ("a", "a b", ["a", "b", "."], 2)
    assert spark.sql("SELECT * FROM cm_split('hello')").first()["chunk_text"] == "hello"


def test_repair_undoes_repeated_damage():
    whole = "“Crème brûlée” à 5 €"
    twice = "".join(clean.WINDOWS[b] for b in "".join(clean.WINDOWS[b] for b in whole.encode()).encode())
    assert clean.repair(twice) == clean.repair(whole) == '"Crème brûlée" à 5 €' and clean.repair("Ã\x81GIL") == "ÁGIL"
    assert clean.repair("a &amp; b") == "a & b" and clean.repair("<i>&amp;") == "<i>&amp;"


GOOD = "The town library moved its books to a nearby school. The mayor thanked every helper warmly. Many visitors came to see the new rooms. " * 6


def test_pipeline(spark):
    rows = spark.createDataFrame([("a.txt", GOOD), ("b.txt", GOOD + " "), ("c.txt", ""), ("d.txt", None)], "filename string, text string")
    done = pipeline.run(rows)
    assert done.status == "completed" and [r["rows"] for r in done.report][:4] == [2, 2, 2, 1] and done.output.filter("keywords IS NOT NULL").count() >= 1
    assert [r["rejected"] for r in done.report][:4] == [2, 0, 0, 1]
    with pytest.raises(ValueError):
        pipeline.run(rows, skip=("nothing",))


def test_pipeline_command_and_viewer(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    for name, text in (("a.txt", GOOD), ("b.txt", GOOD.upper()), ("c.txt", ""), ("d.html", f"<p>{GOOD.replace('library', 'museum').replace('school', 'castle')}</p>")):
        (tmp_path / "in" / name).write_text(text)
    out = tmp_path / "out"
    assert pipeline.main([str(tmp_path / "in"), str(out), "--semantic-threshold", "0.99"], spark) == 0
    report = json.loads(spark.read.text(str(out / "report")).first()[0])
    assert [r["status"] for r in report["stages"]] == ["completed"] * 6 and [r["rejected"] for r in report["stages"]][:4] == [1, 0, 0, 1]
    assert {p.name for p in (out / "ingest" / "rows").iterdir() if p.is_dir()} == {"is_valid_file=false", "is_valid_file=true"}
    assert spark.read.option("header", "true").csv(str(out / "dedup" / "report")).first()["reason"] == "exact"
    assert spark.read.json(str(out / "dedup" / "groups")).first()["removed"] == ["b.txt"]
    assert spark.read.text(str(out / "chunk" / "readable")).filter("value LIKE '===%'").count() == spark.read.json(str(out / "chunk" / "rows")).count()
    assert viewer.main([str(out / "enrich" / "rows"), "--search-keyword", "museum"], spark) == 0
    shown = capsys.readouterr().out
    assert "d.html" in shown and "dedup: completed" in shown and '"exact_duplicates": 1' in shown


def test_failed_run_reports_its_stages(spark, tmp_path, monkeypatch):
    def broken(*_):
        raise RuntimeError("no scorer")

    monkeypatch.setattr(pipeline, "_quality", broken)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text(GOOD)
    assert pipeline.main([str(tmp_path / "in"), str(tmp_path / "out")], spark) == 1
    report = json.loads(spark.read.text(str(tmp_path / "out" / "report")).first()[0])
    assert report["status"] == "failed" and [r["status"] for r in report["stages"]] == ["completed", "completed", "failed"] and "no scorer" in report["stages"][2]["error"]


def test_passes_leave_copies_to_the_first(spark, monkeypatch):
    other = GOOD.replace("mayor", "major")
    rows = spark.createDataFrame([(1, GOOD), (2, GOOD.upper()), (3, GOOD), (4, other), (5, other)], "id int, text string")
    seen = []
    real = dedup.fuzzy_edges
    monkeypatch.setattr(dedup, "fuzzy_edges", lambda d, *a: seen.append(sorted(r["id"] for r in d.collect())) or real(d, *a))
    edges = dedup.passes(rows, "id", fuzzy=dedup.Fuzzy(threshold=0.5), semantic_threshold=0.9)
    assert seen == [[1, 4]] and {(r["a"], r["b"], r["method"]) for r in edges.collect()} >= {(1, 2, "exact"), (1, 3, "exact"), (4, 5, "exact"), (1, 4, "fuzzy")}


def test_semantic_edges_against_all_pairs(spark):
    rng = np.random.default_rng(0)
    base = rng.standard_normal((60, 16))
    vectors = np.concatenate([base, base + 0.05 * rng.standard_normal(base.shape), base[:5]])
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(900, None), (901, [0.0] * 16), (902, [1.0, 2.0])]
    got = {(r["a"], r["b"]) for r in dedup.semantic_edges(spark.createDataFrame(rows, "id long, embedding array<double>"), "id", block=7).collect()}
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    want = {(i, j) for i in range(len(unit)) for j in range(i + 1, len(unit)) if unit[i] @ unit[j] >= 0.95}
    assert got == want and len(want) > 60


@pytest.mark.parametrize("codec, text", [("cp1252", "Le garçon a payé l’addition à l’hôtel. “Voilà”, dit-il."), ("cp1250", "Zażółć gęślą jaźń, proszę o rachunek za pokój i śniadanie."), ("cp1251", "Спасибо за покупку, приходите ещё."), ("koi8-r", "Спасибо за покупку, приходите ещё."), ("cp1253", "Ευχαριστούμε πολύ για την απόδειξη."), ("shift_jis", "領収書をご覧ください。合計は三十ドルでした。"), ("euc_jp", "領収書をご覧ください。"), ("gb18030", "我们在前台买了花园椅，一共二十三元。"), ("big5", "請慢用，謝謝光臨。今天的湯很好喝。"), ("euc_kr", "영수증을 보관해 주세요."), ("cp874", "กรุณาเก็บใบเสร็จเลขที่ไว้ด้วยค่ะ"), ("utf-8", "Größe"), ("utf-16", "Größe")])
def test_charsets(codec, text):
    assert charset.decode_bytes(text.encode(codec))[0] == text


def test_keyword_methods():
    text = "Solar panels power the old mill. The solar panels were cheap. A miller in Leeds bought solar panels and NASA sold the batteries."
    best = keywords.by_statistics(text)
    assert len(best) == 5 and all(a[1] >= b[1] for a, b in zip(best, best[1:])) and any("solar panels" in k for k, _ in best)
    terms = keywords._Terms("Red fox. Red dog.")
    # by hand: counts 2, 1, 1; mean 4/3, deviation sqrt(2/9); 'red' stands in both sentences, next to two words on its right
    norm = 4 / 3 + (2 / 9) ** 0.5
    related = 1 + 1 * 2 / 2
    assert terms.weights["red"] == pytest.approx(related * np.log(np.log(3.5)) / (2 / norm / related + 1 / related))
    assert keywords.by_statistics("") == [] == keywords.by_frequency("") == keywords.by_encoder("", encoders.hashed_ngrams)
    assert keywords.cascade("the of and")[:1] == [] and keywords.cascade("ox", 5)[0][2] == "frequency" and keywords.cascade(text)[0][2] == "statistical"
    found = keywords.cascade(text, 3, encoder=encoders.hashed_ngrams)
    assert [m for *_, m in found] == ["embedding"] * 3 and len({k for k, *_ in found}) == 3


def test_a_failing_text_keeps_its_row(spark):
    def fails(texts):
        if any("bad" in t for t in texts):
            raise ValueError("encoder")
        return encoders.hashed_ngrams(texts)

    rows = spark.createDataFrame([(1, "A bad text."), (2, "A good text from Paris by Maria Lopez.")], "id int, text string")
    got = {r["id"]: r for r in enrich.enrich(rows, features=enrich.Features(encoder=fails)).collect()}
    assert got[1]["keywords"] is None and "encoder" in got[1]["enrichment_error"] and got[1]["summary"] == "A bad text."
    assert got[2]["keywords"] and got[2]["enrichment_error"] is None and got[2]["entity_types"] == {"GPE": ["Paris"], "PERSON": ["Maria Lopez"]}


def test_settled_tables_need_a_shared_folder_on_a_cluster():
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: d), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(RuntimeError):
        session.shared_folder(cluster)
    cluster.conf.get = lambda k, d: "hdfs:///shared"
    assert session.shared_folder(cluster) == "hdfs:///shared"


def test_settled_tables_can_be_cleared(spark):
    kept = session.settle(spark.range(3), "gone")
    folder = Path(session._own_folder(spark))
    assert kept.count() == 3 and any(p.name.startswith("gone") for p in folder.iterdir())
    session.clear(spark)
    assert not folder.exists() and session.settle(spark.range(2), "new").count() == 2


def test_dashboard_and_size_histogram(spark):
    scored = quality.score(spark.createDataFrame([(1, GOOD), (2, "")], "id int, text string"))
    panels = {k: v.collect() for k, v in sinks.score_dashboard(scored, "id").items()}
    assert sum(r["n"] for r in panels["histogram"]) == 2 and panels["best"][0]["id"] == 1 and panels["worst"][0]["id"] == 2
    sizes = chunk.size_histogram(spark.createDataFrame([(99,), (100,), (199,), (None,)], "token_count int")).collect()
    assert [(r["from_tokens"], r["n"]) for r in sizes] == [(0, 1), (100, 2)]


def test_texts_of_a_folder(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo")
    (tmp_path / "b.md").write_text("no")
    assert [tuple(r) for r in files.read_texts(spark, str(tmp_path)).collect()] == [("a.txt", "one\ntwo")]


def test_stream(spark, tmp_path):
    text = "The town library moved its books to a nearby school. The mayor thanked every helper warmly. "
    spark.createDataFrame([("a", text), ("b", text.upper()), ("c", None)], "filename string, text string").withColumn("at", F.timestamp_seconds(F.lit(1_700_000_000))).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("filename string, text string, at timestamp").parquet(str(tmp_path / "in"))
    q = curate.curate_stream(stream, "at").writeStream.format("memory").queryName("curated").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("curated").count() == 1


def test_entry(spark):
    assert entry.entry(spark).columns == ["lang", "n"]


def test_lookup_and_compare(spark, data):
    rows = spark.read.parquet(f"{data}/enriched.parquet")
    some = rows.agg(F.min("chunk_id")).first()[0]
    assert search.lookup(rows, some).first()["chunk_id"] == some and search.lookup(rows, "none").count() == 0
    assert search.compare(rows, some, "none").count() == 0


@pytest.mark.parametrize("name", catalogue.oracle_sql())
def test_sql_parity(spark, data, name):
    from collections import Counter

    from tools.compare import plain

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in Path(data).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    df = catalogue.queries()[name](spark, data)
    cols = sorted(df.columns)
    cur = con.execute(catalogue.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    order = [names.index(c) for c in cols]
    want = Counter(tuple(plain(float(r[i]) if type(r[i]).__name__ == "Decimal" else r[i]) for i in order) for r in cur.fetchall())
    assert Counter(tuple(plain(x) for x in r) for r in df.select(*cols).collect()) == want
