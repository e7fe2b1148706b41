"""Sentence boundaries, with abbreviations, collocations and sentence starters learned unsupervised per language."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from curamill.functions.columns import fenced, make_room
from curamill.llm.prose import COMMON, WORD, find_words, language_of
from curamill.session import settle

OUTPUTS = ("sentence_index", "start_pos", "end_pos", "sentence")
NUMBER = "##"
_BLOCK = regex.compile(r"\n[^\S\n]*\n\s*")
_TOKEN = regex.compile(r"\S+")
_OPENERS, _CLOSERS = "\"'“„«‹‘(\\[{¿¡—–‚", "\"'”“’»›)\\]}」』）｣"
_LEAD = regex.compile(rf"^[{_OPENERS}]+")
_TAIL = regex.compile(rf"[{_CLOSERS},;:]+$")
_CAND = regex.compile(rf"[.!?…]+(?:\s?[»›]|[{_CLOSERS}])*(?=\s)|[。！？｡।]+[{_CLOSERS}]*")
_PAIRS = {"“": "”", "„": "“”", "«": "»", "‹": "›", "「": "」", "『": "』", "(": ")", "（": "）", "[": "]", "｢": "｣"}
_QUOTES = frozenset("“„«‹「『\"｢")
_MARKS = regex.compile("[“”„«»‹›「」『』()（）\\[\\]\"｢｣]")
_CASELESS = regex.compile(r"\p{Lo}")
_NO_SPACE = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}]")
_THAI = regex.compile(r"\p{Thai}")
_OTHER_FINALS = frozenset("!?…。！？")


@dataclass(frozen=True)
class Learning:
    """Thresholds on log-likelihood ratios; whatever reaches one is learned. Beyond ``saturation`` uses of a word only
    their shares count, so that corpora of all sizes are judged alike. A word is no abbreviation if sentences begin after its
    stop ``ordinary`` times as often as after other final marks or more; from ``ending`` on, an abbreviation may close a sentence."""

    abbreviation: float = 0.3
    collocation: float = 7.88
    starter: float = 30.0
    final: float = 30.0
    saturation: int = 1000
    ordinary: float = 0.5
    ending: float = 0.15


@dataclass
class Language:
    """What was learned of one language. ``enders``: abbreviations that often close a sentence. ``finals``: endings
    that close a sentence before a blank where the script has no full stop."""

    abbreviations: set[str] = field(default_factory=set)
    enders: set[str] = field(default_factory=set)
    collocations: set[tuple[str, str]] = field(default_factory=set)
    starters: set[str] = field(default_factory=set)
    lower_only: set[str] = field(default_factory=set)
    finals: set[str] = field(default_factory=set)


@lru_cache(maxsize=1 << 17)
def kind(token: str) -> str:
    """The type of a token: lower case, without opening marks, elided articles or a final stop; numbers are one type."""
    core = _LEAD.sub("", token)
    core = _TAIL.sub("", core)
    if core.endswith("."):
        core = core[:-1]
    for mark in "’'":
        head, cut, tail = core.partition(mark)
        if cut and len(head) <= 2 and tail:
            core = tail
    if core and core[0].isdigit():
        return NUMBER
    return core.lower()


def stops(token: str) -> bool:
    """Whether the token, closing marks aside, ends with one full stop."""
    core = _TAIL.sub("", token)
    return core.endswith(".") and not core.endswith("..") and len(core) > 1


def capital(token: str) -> bool:
    core = _LEAD.sub("", token)
    return bool(core) and (core[0].isupper() or (len(core) > 1 and core[1].isupper()))


@lru_cache(maxsize=1 << 17)
def _looks(token: str) -> tuple[str, bool, bool, bool]:
    """Type, ``stops``, ``capital``, and whether it ends with another final mark."""
    dot = stops(token)
    return kind(token), dot, capital(token), not dot and _TAIL.sub("", token)[-1:] in _OTHER_FINALS


def _language(text: str) -> str:
    return language_of(text, find_words(text.lower()))


def _blocks(text: str) -> Iterator[tuple[int, str]]:
    at = 0
    for gap in _BLOCK.finditer(text):
        if gap.start() > at:
            yield at, text[at : gap.start()]
        at = gap.end()
    if at < len(text):
        yield at, text[at:]


def _count(text: str, counts: Counter) -> None:
    """Adds (language, what, a, b) counts of one text: ``t`` tokens by type and stop, ``P`` and ``p`` pairs around
    a stop by the next one's case, ``s`` types after another final mark, ``o`` letter case inside sentences, ``f``/``e`` endings before blanks and ends."""
    whole = None
    for _, block in _blocks(text):
        tokens = block.split()
        language = _language(block)
        if language == "und":
            whole = whole or _language(text)
            language = whole
        before = None
        for token in tokens:
            name, dot, high, end = _looks(token)
            if not name:
                before = None
                continue
            counts[language, "t", name, "." if dot else ""] += 1
            if before is not None:
                last, last_dot, last_end = before
                if last_dot:
                    counts[language, "P" if high else "p", last, name] += 1
                elif last_end:
                    counts[language, "s", name, ""] += 1
                elif name != NUMBER:
                    counts[language, "o", name, "A" if high else "a"] += 1
            before = (name, dot, end)
        if _THAI.search(block):
            for token in tokens[:-1]:
                if _THAI.search(token[-1:]):
                    counts[language, "f", token[-3:], ""] += 1
            if _THAI.search(tokens[-1][-1:]):
                counts[language, "e", tokens[-1][-3:], ""] += 1


def _ratio(c1: Column, c2: Column, c12: Column, n: Column) -> Column:
    """Dunning's log-likelihood ratio of c12 joint occurrences, with the sign of the association."""
    p, p1, p2 = c2 / n, c12 / c1, (c2 - c12) / F.greatest(n - c1, F.lit(1.0))

    def part(hits: Column, misses: Column, q: Column) -> Column:
        q = F.least(F.greatest(q, F.lit(1e-12)), F.lit(1 - 1e-12))
        return hits * F.log(q) + misses * F.log(1 - q)

    a, b, c, d = c12, c1 - c12, c2 - c12, F.greatest(n - c1 - c2 + c12, F.lit(0.0))
    value = -2 * (part(a, b, p) + part(c, d, p) - part(a, b, p1) - part(c, d, p2))
    return F.when(p1 > p2, value).otherwise(-value)


def _by_language(df: DataFrame, columns: list[str]) -> dict[str, list]:
    """All rows by language."""
    out: dict[str, list] = {}
    for r in df.select("language", *columns).collect():
        out.setdefault(r["language"], []).append(tuple(r[c] for c in columns))
    return out


def _once(df: DataFrame, text: str) -> DataFrame:
    """Each different text once, so that copies don't weigh more. Only texts that are repeated meet an aggregation; the
    others merely pass a join with the keys of those, which needs no shuffle of texts while the keys are few."""
    keyed = df.filter(F.col(text).isNotNull()).select(F.col(text).alias("text"), F.md5(text).alias("k"))
    repeated = settle(keyed.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("k"), "repeated")
    copies = keyed.join(repeated, "k", "left_semi").groupBy("k").agg(F.min("text").alias("text"))
    return keyed.join(repeated, "k", "left_anti").select("text").unionByName(copies.select("text"))


def learn(df: DataFrame, text: str = "text", options: Learning = Learning()) -> dict[str, Language]:
    """Statistics over every different text of ``df``. Counting combines in each task and map-side; the ratios are computed
    distributed, and only the learned lists, which are whole, reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            rows = [(*k, n) for k, n in counts.items()]
            counts.clear()
            columns = list(zip(*rows)) if rows else [()] * 5
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in columns[:4]), pa.array(columns[4], pa.int64())], ["language", "what", "a", "b", "n"])

        for batch in batches:
            for value in batch.column(0).to_pylist():
                _count(value, counts)
            if len(counts) > 300_000:
                yield flush()
        yield flush()

    raw = _once(df, text).mapInArrow(count, "language string, what string, a string, b string, n bigint")
    counts = settle(raw.groupBy("language", "what", "a", "b").agg(F.sum("n").cast("double").alias("n")), "counts")

    tokens = counts.filter("what = 't'").groupBy("language", F.col("a").alias("name")).agg(F.sum("n").alias("c"), F.sum(F.when(F.col("b") == ".", F.col("n")).otherwise(0.0)).alias("cp"))
    total = tokens.groupBy("language").agg(F.sum("c").alias("n_tokens"), F.sum("cp").alias("n_stops"))
    size = F.length(F.regexp_replace("name", r"\.", "")).cast("double")
    inner = F.length("name") - size
    seen = F.least(F.col("c"), F.lit(float(options.saturation)))
    stopped = F.col("cp") / F.col("c") * seen
    score = _ratio(seen, F.col("n_stops"), stopped, F.col("n_tokens")) * F.exp(-size) * (inner + 1) * F.pow(size, -(seen - stopped))
    # A word of a single letter followed by a stop is an initial, which is decided by its neighbours, not by this score.
    scored = tokens.filter((F.col("cp") > 0) & (F.col("name") != NUMBER) & (size > 0) & F.col("name").rlike(r"^[\p{L}\p{M}.]+$")).join(F.broadcast(total), "language").withColumn("score", score)
    candidates = settle(scored.filter(F.col("score") >= options.abbreviation).select("language", "name", "score"), "candidates")

    pairs = counts.filter("what IN ('p', 'P')").groupBy("language", F.col("a").alias("w1"), F.col("b").alias("w2")).agg(F.sum("n").alias("c12"), F.sum(F.when(F.col("what") == "P", F.col("n")).otherwise(0.0)).alias("capitals"))
    marked = pairs.join(candidates.select("language", F.col("name").alias("w1"), F.lit(True).alias("short")), ["language", "w1"], "left")
    after_stop = marked.filter(F.col("short").isNull() & (F.length("w1") > 1) & (F.col("w1") != NUMBER)).select("language", F.col("w2").alias("name"), F.col("c12").alias("n"))
    after_mark = counts.filter("what = 's'").select("language", F.col("a").alias("name"), "n")
    begins = after_stop.unionByName(after_mark).groupBy("language", "name").agg(F.sum("n").alias("cs"))
    breaks = begins.groupBy("language").agg(F.sum("cs").alias("n_breaks"))
    starters = begins.join(tokens.select("language", "name", "c"), ["language", "name"]).join(F.broadcast(total), "language").join(F.broadcast(breaks), "language")
    starters = starters.withColumn("score", _ratio(F.col("n_breaks"), F.greatest("c", "cs"), F.col("cs"), F.col("n_tokens"))).filter(F.col("score") >= options.starter)
    starters = settle(starters.select("language", "name", "score"), "starters")
    model: dict[str, Language] = {}
    for v, rows in _by_language(starters, ["name"]).items():
        model.setdefault(v, Language()).starters = {x[0] for x in rows}

    # A capital after the stop tells of a new sentence if the word is a learned starter or else written small inside sentences,
    # as seen here or as function words are.
    cases = counts.filter("what = 'o'").groupBy("language", F.col("a").alias("name")).agg(F.sum(F.when(F.col("b") == "a", F.col("n")).otherwise(0.0)).alias("score"), F.sum(F.when(F.col("b") == "A", F.col("n")).otherwise(0.0)).alias("upper"))
    small = cases.filter("score > 1 AND upper * 5 < score").select("language", "name")
    function = df.sparkSession.createDataFrame([(v, w) for v, words in COMMON.items() for w in words], "language string, name string")
    started = starters.filter(F.col("name") != NUMBER).select("language", "name").union(small).filter(F.length("name") > 1).union(function).distinct().withColumn("starts", F.lit(1.0))
    usual = after_mark.join(started, ["language", "name"], "left").groupBy("language").agg((F.sum(F.col("n") * F.coalesce("starts", F.lit(0.0))) / F.sum("n")).alias("usual"))
    begun = F.sum(F.col("capitals") * F.coalesce("starts", F.lit(0.0))) / F.sum("c12")
    ends = marked.filter("short").join(started.withColumnRenamed("name", "w2"), ["language", "w2"], "left").groupBy("language", F.col("w1").alias("name")).agg(begun.alias("begun"))
    ends = candidates.join(ends, ["language", "name"], "left").join(F.broadcast(usual), "language", "left")
    share = F.coalesce(F.col("begun"), F.lit(0.0)) / F.greatest(F.coalesce("usual", F.lit(1.0)), F.lit(0.5))
    abbreviations = settle(ends.select("language", "name", share.alias("share")).filter(F.col("share") < options.ordinary), "abbreviations")
    for v, rows in _by_language(abbreviations, ["name", "share"]).items():
        own = model.setdefault(v, Language())
        own.abbreviations = {x[0] for x in rows}
        own.enders = {x[0] for x in rows if x[1] >= options.ending}

    # How strongly the next type depends on this one having a stop, against the types that follow any stop.
    firsts = pairs.groupBy("language", "w1").agg(F.sum("c12").alias("c1"))
    seconds = pairs.groupBy("language", "w2").agg(F.sum("c12").alias("c2"))
    n_pairs = pairs.groupBy("language").agg(F.sum("c12").alias("n"))
    tied = pairs.join(firsts, ["language", "w1"]).join(seconds, ["language", "w2"]).join(F.broadcast(n_pairs), "language").filter("c12 > 1")
    tied = tied.withColumn("score", _ratio(F.col("c1"), F.col("c2"), F.col("c12"), F.col("n"))).filter((F.col("score") >= options.collocation) & ((F.col("c12") >= 0.25 * F.col("c1")) | (F.col("w1") == NUMBER)))
    tied = tied.join(abbreviations.select("language", F.col("name").alias("w1"), F.lit(True).alias("short")), ["language", "w1"], "left")
    tied = tied.filter(F.coalesce("short", F.lit(False)) | (F.length("w1") == 1) | (F.col("w1") == NUMBER) | (F.col("w2") == NUMBER))
    tied = tied.join(starters.select("language", F.col("name").alias("w2"), F.lit(True).alias("starts")), ["language", "w2"], "left").filter(F.col("starts").isNull() | (F.col("w2") == NUMBER))
    for v, rows in _by_language(tied, ["w1", "w2"]).items():
        model.setdefault(v, Language()).collocations = set(rows)

    follow = pairs.join(abbreviations.select("language", F.col("name").alias("w1")), ["language", "w1"]).select("language", F.col("w2").alias("name")).distinct()
    for v, rows in _by_language(cases.filter("score > 1 AND upper * 20 < score").join(follow, ["language", "name"], "left_semi"), ["name"]).items():
        model.setdefault(v, Language()).lower_only = {x[0] for x in rows}

    blanks = counts.filter("what IN ('f', 'e')").groupBy("language", F.col("a").alias("name")).agg(F.sum("n").alias("c"), F.sum(F.when(F.col("what") == "e", F.col("n")).otherwise(0.0)).alias("ce"))
    sums = blanks.groupBy("language").agg(F.sum("c").alias("n"), F.sum("ce").alias("n_ends"))
    finals = blanks.join(F.broadcast(sums), "language").withColumn("score", _ratio(F.col("c"), F.col("n_ends"), F.col("ce"), F.col("n")))
    often = (F.col("c") - F.col("ce")) >= 0.02 * (F.col("n") - F.col("n_ends"))
    for v, rows in _by_language(finals.filter((F.col("score") >= options.final) & often), ["name"]).items():
        model.setdefault(v, Language()).finals = {x[0] for x in rows}
    return model


def _straight(block: str, a: int, b: int) -> bool:
    """Whether straight quotes at ``a`` and ``b`` belong together: near ones do, others if the first opens and the second closes a word."""
    if b - a <= 400:
        return True
    opens = (a == 0 or block[a - 1].isspace() or block[a - 1] in _OPENERS) and not block[a + 1].isspace()
    return opens and not block[b - 1].isspace() and not block[b + 1 : b + 2].isalnum()


def _enclosed(block: str) -> list[tuple[int, int, bool]]:
    """(open, close, is a quotation) of paired marks, however far apart; a mark without a partner in the block encloses nothing."""
    open_marks: list[tuple[int, str]] = []
    found = []
    for m in _MARKS.finditer(block):
        mark, at = m.group(), m.start()
        match = next((k for k in range(len(open_marks) - 1, -1, -1) if mark in _PAIRS.get(open_marks[k][1], "") or (mark == '"' == open_marks[k][1] and _straight(block, open_marks[k][0], at))), None)
        if match is not None:
            found.append((open_marks[match][0], at, open_marks[match][1] in _QUOTES))
            del open_marks[match:]
        elif mark in _PAIRS or mark == '"':
            open_marks.append((at, mark))
    return sorted(found)


def _line_ends(block: str) -> list[int]:
    """The line breaks that separate sentences whose first one has no final mark.

    In text wrapped at a width, a break is hard where the next word would still have fitted. A line after a hard
    break is a sentence of its own if most lines of the block are such, else if it is a heading at the block's head or
    a signature at its foot and clearly too short for a wrapped line."""
    lines = block.split("\n")
    if len(lines) == 1:
        return []
    sizes = sorted((len(x.rstrip()) for x in lines), reverse=True)
    width = next((a for a, b in zip(sizes, sizes[1:]) if a <= 1.25 * b), sizes[-1])  # a line much longer than any other tells nothing
    found, clear, at = [], [], 0
    for i, (line, following) in enumerate(zip(lines, lines[1:])):
        at += len(line) + 1
        word = following.split(None, 1)[0] if following.strip() else ""
        dense = bool(_NO_SPACE.search(word[:3])) and not line.rstrip()[-1:].isascii()
        room = width - len(line.rstrip()) - (1 if dense else len(word) + 1)
        if room >= 0:
            found.append(at - 1)
            if room >= 8 and i in (0, len(lines) - 2):
                clear.append(at - 1)
    if len(found) * 2 > len(lines) - 1:
        every = [m.start() for m in regex.finditer("\n", block)]
        return every if len(lines) > 2 or found == every and room >= 3 else clear
    return clear


def _ends_sentence(block: str, mark: regex.Match, end: int, after: int, model: Language, quoted: bool) -> bool:
    """Whether the final mark, which with its closing marks reaches to ``end``, closes a sentence; the next text begins at ``after``."""
    signs = mark.group()
    nxt = block[after]
    rest = _TOKEN.match(block, after).group()
    following = _LEAD.sub("", rest) or rest
    if signs[0] in "。！？｡":
        return not (quoted and after == end and nxt not in "「『“\"（｢")
    if signs[0] == "।":
        return not (quoted and nxt not in "“\"(")
    if following[0] in ",;:，、":
        return False
    if signs.startswith(("...", "…")):
        return following[0].isupper() or bool(_CASELESS.match(following)) or nxt in _QUOTES
    low = following[0].islower() and not capital(following)
    if signs[0] != ".":
        return not low
    start = mark.start()
    while start > 0 and not block[start - 1].isspace():
        start -= 1
    token = block[start : mark.start() + 1]
    w1, w2 = kind(token), kind(rest)
    if quoted and low:
        return False
    if (w1, w2) in model.collocations:
        return False
    if low:
        return False
    short = w1 in model.abbreviations
    if len(w1) == 1 and w1.isalpha() and not short and not _CASELESS.match(w1):
        return w2 in model.starters and len(kind(rest)) > 1 and not stops(rest)
    if not short:
        return True
    if nxt in _QUOTES or nxt in "¿¡(":
        return w1 in model.enders
    if w2 == NUMBER:
        return w1 in model.enders
    if w1 in model.enders:
        return True
    return (w2 in model.starters or w2 in model.lower_only) and capital(rest) and "." in w1


def boundaries(text: str, model: dict[str, Language]) -> list[tuple[int, int]]:
    """(start, end) of each sentence in characters of ``text``; marks that open a sentence belong to it."""
    out: list[tuple[int, int]] = []
    whole = None
    for offset, block in _blocks(text):
        language = _language(block)
        if language == "und":
            whole = whole or _language(text)
            language = whole
        own = model.get(language) or Language()
        spans = _enclosed(block)
        opens = {a for a, _, _ in spans}
        cuts = {0}

        for mark in _CAND.finditer(block):
            end = mark.end()
            while end - 1 in opens:  # a mark that opens the next sentence
                end -= 1
            after = end
            while after < len(block) and block[after].isspace():
                after += 1
            if after >= len(block):
                continue
            if any(a < end - 1 < b for a, b, _ in spans):
                continue
            quoted = any(b < end and a < mark.start() < b and q for a, b, q in spans)
            if _ends_sentence(block, mark, end, after, own, quoted):
                cuts.add(after)
        for at in _line_ends(block):
            after = at
            while after < len(block) and block[after].isspace():
                after += 1
            if after < len(block) and not any(a < at < b for a, b, _ in spans):
                head = block[:at].rstrip()
                following = _LEAD.sub("", block[after : after + 40])[:1]
                if head and head[-1] not in ",-、，" and following.isalnum() and not following.islower():
                    cuts.add(after)
        if _THAI.search(block):
            finals = (model.get("th") or own).finals
            for token in _TOKEN.finditer(block):
                if token.group()[-3:] in finals and _THAI.search(token.group()[-1:]):
                    after = token.end()
                    while after < len(block) and block[after].isspace():
                        after += 1
                    if after < len(block):
                        cuts.add(after)
        order = sorted(cuts)
        for a, b in zip(order, [*order[1:], len(block)]):
            piece = block[a:b]
            lead = len(piece) - len(piece.lstrip())
            piece = piece.strip()
            if WORD.search(piece):
                out.append((offset + a + lead, offset + a + lead + len(piece)))
            elif out and piece:
                out[-1] = (out[-1][0], offset + a + lead + len(piece))
    return out


def split_sentences(df: DataFrame, text: str = "text", options: Learning = Learning(), training: DataFrame | None = None) -> DataFrame:
    """One row per sentence: the input's columns without the text, ``sentence_index`` from 0, ``start_pos`` (number of
    characters before its first one), ``end_pos`` and ``sentence``.

    The statistics come from all of ``training`` (``df`` by default), by the language each block of text is in.
    Blank lines always separate; a single line break separates where the text isn't just wrapped. Marks inside a
    quotation or bracket never separate. Texts that are null, empty or without a letter or digit give no row. Repeated rows
    are split each for itself. Clashing input columns come out as ``<name>_input``. Nothing but the counts is shuffled.
    """
    df = make_room(df, OUTPUTS, keep=[text])
    model = df.sparkSession.sparkContext.broadcast(learn(training if training is not None else df, text, options))  # the learned lists

    @F.arrow_udf("array<struct<start_pos:int,end_pos:int>>")
    def find(texts: pa.Array) -> pa.Array:
        rows = [[{"start_pos": a, "end_pos": b} for a, b in boundaries(t, model.value)] if t is not None else None for t in texts.to_pylist()]
        return pa.array(rows, pa.list_(pa.struct([("start_pos", pa.int32()), ("end_pos", pa.int32())])))

    kept = [c for c in df.columns if c != text]
    found = fenced(df, __s=find(text)).select(*kept, text, F.posexplode("__s").alias("sentence_index", "__p"))
    return found.select(*kept, "sentence_index", "__p.*", F.substring(F.col(text), F.col("__p.start_pos") + 1, F.col("__p.end_pos") - F.col("__p.start_pos")).alias("sentence"))
