"""Reading level of each text by regularised ordinal regression, calibrated on graded text."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from curamill.functions.columns import make_room
from curamill.llm.graded import GRADED
from curamill.llm.prose import COMMON, Analysis, analyse, find_words, language_of
from curamill.session import settle

LANGUAGES = tuple(COMMON)
LEVELS = ("primary", "lower_secondary", "upper_secondary", "university")
FEATURES = ("log_sentence_length", "log_word_length", "long_share", "diversity", "rarity", "connectives", "clause_marks")
# Words that join clauses or arguments, by language.
CONNECTIVES = {
    "en": "although because whenever however therefore notwithstanding provided whereas consequently subsequently nevertheless moreover particularly whose whether pursuant irrespective unless insofar when".split(),
    "fr": "bien comme lorsque cependant nonobstant toutefois néanmoins conformément préalablement ultérieurement dont ainsi quoique puisque afin lequel laquelle notamment quand".split(),
    "de": "obwohl weil sobald dass sofern ungeachtet insofern gemäß jedoch dennoch anschließend welche welcher wenngleich soweit indem nachdem wodurch wenn".split(),
    "es": "aunque porque cuando como obstante siempre conformidad posteriormente previamente cuyo cuya sino mientras además conforme cualquier dicha dicho".split(),
}
_CONNECTIVES = {k: frozenset(v) for k, v in CONNECTIVES.items()}
OUTPUTS = ("language", "sentence_share", "is_prose", "level_score", "level", "level_name")


@dataclass(frozen=True)
class Grading:
    """``table``: how many of each language's most frequent words every task holds at most; the counts of all others are
    joined, so it decides the cost and not the result. ``penalty`` is the ridge on the coefficients. ``draws``: passages of ``passage`` sentences drawn per
    level from the graded text, up to ``easier`` of each from the level below. ``least_share``: texts with a smaller share of words in sentences are no prose."""

    table: int = 5000
    penalty: float = 0.02
    draws: int = 60
    passage: int = 4
    easier: float = 0.4
    least_share: float = 0.8
    least_words: int = 8
    seed: int = 11


def features(found: Analysis, rarity: dict[str, float] | None, rarest: float = 0.0) -> list[float]:
    """Of the words in sentences only; without ``rarity`` its place is left 0. Word order matters for none but ``diversity``, which is taken over stretches
    of 40 words so that it doesn't fall with length."""
    marks = _CONNECTIVES[found.language]
    lower = [[w.lower() for w in s] for s in found.sentences]
    words = [w for s in lower for w in s]
    n, m = len(words), len(lower)
    letters = [len(w) for w in words if not w[0].isdigit()] or [1]
    stretches = [words[i : i + 40] for i in range(0, max(1, n - 19), 40)]
    return [
        math.log(n / m),
        math.log(sum(letters) / len(letters)),
        sum(x >= 10 for x in letters) / len(letters),
        sum(len(set(s)) / len(s) ** 0.8 for s in stretches) / len(stretches),
        sum(rarity.get(w, rarest) for w in words if not w[0].isdigit()) / len(letters) if rarity is not None else 0.0,
        sum(w in marks for w in words) / m,
        sum(s.count(",") + s.count(";") + s.count(":") for s in found.spans) / m,
    ]


def graded_passages(options: Grading) -> list[tuple[str, int, str]]:
    """(language, level, text) drawn from the graded sentences, the same for the same seed. Texts of a level hold easier
    sentences too: up to a share of ``easier`` of each passage comes from the level below."""
    rng = np.random.default_rng(options.seed)
    out = []
    for language, levels in GRADED.items():
        for level, sentences in levels.items():
            for _ in range(options.draws):
                k = min(int(rng.integers(2, options.passage + 2)), len(sentences))
                below = levels.get(level - 1, [])
                m = min(int(rng.integers(0, int(k * options.easier) + 1)), len(below))
                own, plain = rng.choice(len(sentences), k - m, replace=False), rng.choice(max(len(below), 1), m, replace=False)
                parts = [sentences[i] for i in own] + [below[i] for i in plain]
                out.append((language, level, " ".join(parts[i] for i in rng.permutation(k))))
    return out


class OrdinalModel:
    """Cumulative logit: P(level <= k) = sigmoid(theta_k - w.x), with features standardised within each language."""

    def __init__(self, penalty: float):
        self.penalty = penalty
        self.mean: dict[str, np.ndarray] = {}
        self.scale: dict[str, np.ndarray] = {}

    def standardised(self, language: str, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean[language]) / self.scale[language], -4, 4)

    def fit(self, languages: list[str], x: np.ndarray, y: np.ndarray, steps: int = 1500, rate: float = 0.3) -> OrdinalModel:
        for language in set(languages):
            own = x[[v == language for v in languages]]
            self.mean[language], self.scale[language] = own.mean(axis=0), own.std(axis=0) + 1e-6
        z = np.stack([self.standardised(v, r) for v, r in zip(languages, x)])
        k = int(y.max())
        w, first, gaps = np.zeros(z.shape[1]), -1.0, np.zeros(k - 2)
        state = np.zeros(len(w) + 1 + len(gaps))
        for _ in range(steps):
            theta = first + np.concatenate([[0], np.cumsum(np.exp(gaps))])
            f = z @ w
            sig = 1 / (1 + np.exp(-(theta[None, :] - f[:, None])))  # P(y <= j)
            full = np.concatenate([np.zeros((len(y), 1)), sig, np.ones((len(y), 1))], axis=1)
            p = np.maximum(full[np.arange(len(y)), y] - full[np.arange(len(y)), y - 1], 1e-9)
            slope = full * (1 - full)
            hi, lo = slope[np.arange(len(y)), y], slope[np.arange(len(y)), y - 1]
            g_f = (hi - lo) / p  # d(-log p)/df
            g_theta = np.zeros(k - 1)
            for j in range(1, k):
                g_theta[j - 1] = (-(hi[y == j] / p[y == j]).sum() + (lo[y == j + 1] / p[y == j + 1]).sum()) / len(y)
            g_gaps = np.exp(gaps) * np.array([g_theta[j + 1 :].sum() for j in range(k - 2)])
            gradient = np.concatenate([z.T @ g_f / len(y) + self.penalty * w, [g_theta.sum()], g_gaps])
            state = 0.9 * state + gradient
            w = w - rate * 0.1 * state[: len(w)]
            first -= rate * 0.1 * state[len(w)]
            gaps = gaps - rate * 0.1 * state[len(w) + 1 :]
        self.w, self.theta = w, first + np.concatenate([[0], np.cumsum(np.exp(gaps))])
        return self

    def score(self, language: str, x: list[float]) -> float:
        """Expected level, between 1 and the highest."""
        f = float(self.standardised(language, np.array(x)) @ self.w)
        return 1 + float((1 / (1 + np.exp(self.theta - f))).sum())

    def level(self, language: str, x: list[float]) -> int:
        f = float(self.standardised(language, np.array(x)) @ self.w)
        return 1 + int((f > self.theta).sum())


def count_words(df: DataFrame, text: str) -> DataFrame:
    """``language``, ``word``, ``n``: how often each word of each language stands in the whole table."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {v: Counter() for v in LANGUAGES}

        def flush() -> pa.RecordBatch:
            rows = [(v, w, n) for v, c in held.items() for w, n in c.items()]
            for c in held.values():
                c.clear()
            a, b, n = zip(*rows) if rows else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(n, pa.int64())], ["language", "word", "n"])

        for batch in batches:
            for value in batch.column(0).to_pylist():
                words = find_words(value.lower())
                language = language_of(value, words)
                if language in held:
                    held[language].update(words)
            if sum(map(len, held.values())) > 200_000:
                yield flush()
        yield flush()

    counted = df.filter(F.col(text).isNotNull()).select(text).mapInArrow(count, "language string, word string, n bigint")
    return counted.filter(~F.col("word").rlike(r"^\d")).groupBy("language", "word").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Rarity:
    """-log10 frequency of words, in units of 1 / ``UNIT`` so that sums don't depend on their order. ``words`` has every
    word of the table as (language, word, rarity); ``near`` up to ``Grading.table`` of the most frequent of each language and
    ``graded`` those of the graded text, both bounded and on the driver. ``rarest`` is the value of words the table lacks."""

    words: DataFrame
    near: dict[str, dict[str, int]]
    graded: dict[str, dict[str, int]]
    rarest: dict[str, int]


UNIT = 10**9


def _lowest(words: dict[int, int], most: int) -> int:
    """The lowest step from which on there are no more than ``most`` words."""
    total, lowest = 0, 2**30
    for step in sorted(words, reverse=True):
        total += words[step]
        if total > most:
            break
        lowest = step
    return lowest


def word_rarity(df: DataFrame, text: str, options: Grading) -> Rarity:
    """Rarities by the counts of all words over the whole table; equal counts of a language have equal rarity."""
    counted = settle(count_words(df, text), "words")
    totals = dict.fromkeys(LANGUAGES, 1) | {r["language"]: r["n"] + 1 for r in counted.groupBy("language").agg(F.sum("n").alias("n")).collect()}
    total = F.create_map(*[F.lit(x) for pair in totals.items() for x in pair])[F.col("language")]
    every = counted.withColumn("rarity", F.round(-F.log10(F.col("n") / total) * UNIT).cast("bigint"))
    # Words from a frequency on that no more than ``table`` words of their language reach; histograms of a few hundred steps.
    step = F.floor(F.log2("n") * 16).cast("int")
    steps = every.groupBy("language", step.alias("step")).agg(F.count(F.lit(1)).alias("words")).collect()
    lowest = {v: _lowest({r["step"]: r["words"] for r in steps if r["language"] == v}, options.table) for v in LANGUAGES}
    from_step = F.create_map(*[F.lit(x) for pair in lowest.items() for x in pair])[F.col("language")]
    near: dict[str, dict[str, int]] = {v: {} for v in LANGUAGES}
    for r in every.filter(step >= from_step).collect():  # at most ``table`` words a language
        near[r["language"]][r["word"]] = r["rarity"]
    own = {(v, w.lower()) for v, levels in GRADED.items() for sentences in levels.values() for s in sentences for w in find_words(s)}
    graded: dict[str, dict[str, int]] = {v: {} for v in LANGUAGES}
    for r in every.join(F.broadcast(df.sparkSession.createDataFrame(sorted(own), "language string, word string")), ["language", "word"], "left_semi").collect():
        graded[r["language"]][r["word"]] = r["rarity"]
    rarest = {v: round((math.log10(totals[v]) + 0.5) * UNIT) for v in LANGUAGES}
    return Rarity(every.drop("n"), near, graded, rarest)


def fit(rarity: dict[str, tuple[dict[str, float], float]], options: Grading = Grading()) -> OrdinalModel:
    """The model for these frequencies, fitted on the graded passages alone."""
    graded = graded_passages(options)
    x, y, languages = [], [], []
    for language, level, text in graded:
        found = analyse(text)
        if not found.sentences:
            continue
        found.language = language
        x.append(features(found, *rarity[language]))
        y.append(level)
        languages.append(language)
    return OrdinalModel(options.penalty).fit(languages, np.array(x), np.array(y))


def grade_texts(df: DataFrame, text: str = "text", options: Grading = Grading(), keep_text: bool = True) -> DataFrame:
    """The input's columns (without the text itself unless ``keep_text``) and ``language``, ``sentence_share``, ``is_prose``, ``level_score`` (expected level, 1 to
    4), ``level`` and ``level_name``.

    A level is given to texts in en, fr, de or es with at least ``least_words`` words in sentences, measured on those
    sentences; ``is_prose`` tells whether nearly all words stand in sentences, so that mixtures can be told apart. Other
    texts and languages get a null level. Null texts have null in every output, empty ones language ``und`` and share 0. Repeated
    rows get the same level. Clashing input columns come out as ``<name>_input``. Two passes over the whole table, one
    for the word frequencies and one for the levels. Of the words in sentences those outside ``Grading.table`` are joined
    to their counts, and the sums to the rows, which are written once in between.
    """
    df = make_room(df, OUTPUTS, keep=[text])
    rarity = word_rarity(df, text, options)
    scale = {v: {w: n / UNIT for w, n in words.items()} for v, words in rarity.graded.items()}
    model = fit({v: (scale[v], rarity.rarest[v] / UNIT) for v in LANGUAGES}, options)
    shared = df.sparkSession.sparkContext.broadcast((rarity.near, model))  # table words a language
    word = pa.struct([("word", pa.string()), ("times", pa.int32())])
    kinds = pa.struct([("language", pa.string()), ("sentence_share", pa.float64()), ("x", pa.list_(pa.float64())), ("near", pa.int64()), ("letters", pa.int32()), ("far", pa.list_(word))])

    @F.arrow_udf("struct<language:string,sentence_share:double,x:array<double>,near:bigint,letters:int,far:array<struct<word:string,times:int>>>")
    def measure(texts: pa.Array) -> pa.Array:
        table, _ = shared.value
        rows = []
        for value in texts.to_pylist():
            if value is None:
                rows.append(None)
                continue
            found = analyse(value)
            row = {"language": found.language, "sentence_share": found.share}
            if found.language in table and found.sentence_words >= options.least_words:
                known, near, far, n = table[found.language], 0, Counter(), 0
                for w in (w.lower() for s in found.sentences for w in s):
                    if not w[0].isdigit():
                        n += 1
                        if (own := known.get(w)) is None:
                            far[w] += 1
                        else:
                            near += own
                row |= {"x": features(found, None), "near": near, "letters": max(n, 1), "far": [{"word": w, "times": k} for w, k in far.items()]}
            rows.append(row)
        return pa.array(rows, kinds)

    @F.arrow_udf("struct<level_score:double,level:int>")
    def grade(languages: pa.Array, x: pa.Array, rare: pa.Array) -> pa.Array:
        _, model = shared.value
        rows = []
        for language, own, r in zip(languages.to_pylist(), x.to_pylist(), rare.to_pylist()):
            if own is None:
                rows.append(None)
                continue
            own[FEATURES.index("rarity")] = r
            rows.append({"level_score": round(model.score(language, own), 4), "level": model.level(language, own)})
        return pa.array(rows, pa.struct([("level_score", pa.float64()), ("level", pa.int32())]))

    columns = [c for c in df.columns if keep_text or c != text]
    measured = settle(df.select(*columns, F.monotonically_increasing_id().alias("__row"), measure(text).alias("__g")), "measured")
    far = measured.select("__row", F.col("__g.language").alias("language"), F.explode("__g.far").alias("w")).select("__row", "language", "w.*")
    rarest = F.create_map(*[F.lit(x) for pair in rarity.rarest.items() for x in pair])[F.col("language")]
    sums = far.join(rarity.words, ["language", "word"], "left").groupBy("__row").agg(F.sum(F.col("times") * F.coalesce("rarity", rarest)).alias("__far"))
    rare = (F.col("__g.near") + F.coalesce("__far", F.lit(0))) / F.lit(UNIT) / F.col("__g.letters")
    graded = measured.join(sums, "__row", "left").withColumn("__l", grade("__g.language", "__g.x", rare))
    names = F.array(*[F.lit(v) for v in LEVELS])
    return graded.select(
        *columns, "__g.language", "__g.sentence_share", (F.col("__g.sentence_share") >= options.least_share).alias("is_prose"), "__l.level_score", "__l.level", F.element_at(names, F.col("__l.level")).alias("level_name")
    )
