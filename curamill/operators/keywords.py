"""Keywords of one text: by an encoder, by local statistics, or by frequency."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from statistics import median

import numpy as np

from curamill.functions import lexicons as L
from curamill.functions.encoders import Encoder

_STOP = frozenset(L.STOP_WORDS)
_WORD = re.compile(r"[^\W_]+")
_TERM = re.compile(r"[^\W_]+(?:['’-][^\W_]+)*|[^\w\s]")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n{2,}")


def by_frequency(text: str, n: int = 5) -> list[tuple[str, float]]:
    """The most frequent lower-cased alphabetic words of two letters or more without stop words, each with .5; of equally
    frequent ones the first."""
    found = Counter(w for w in _WORD.findall(text.lower()) if len(w) > 1 and w.isalpha() and w not in _STOP)
    return [(w, 0.5) for w, _ in found.most_common(n)]


def _near(a: str, b: str) -> float:
    """1 minus the edit distance in shares of the longer string; 0 for lengths that alone put it under a half."""
    if a == b:
        return 1.0
    if 2 * min(len(a), len(b)) < max(len(a), len(b)):
        return 0.0
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (x != y))
    return 1 - row[-1] / max(len(a), len(b), 1)


class _Terms:
    """What a text's terms are weighed by: case, position, frequency, neighbours and spread over sentences."""

    def __init__(self, text: str):
        self.sentences = [_TERM.findall(s) for s in _SENTENCE.split(text) if s.strip()]
        self.count: Counter[str] = Counter()
        self.acronyms: Counter[str] = Counter()
        self.capitals: Counter[str] = Counter()
        self.places: dict[str, list[int]] = defaultdict(list)
        self.left: dict[str, Counter[str]] = defaultdict(Counter)
        self.right: dict[str, Counter[str]] = defaultdict(Counter)
        for at, sentence in enumerate(self.sentences):
            before = None
            for i, token in enumerate(sentence):
                term = token.lower()
                if not self.is_term(term):
                    before = None
                    continue
                self.count[term] += 1
                self.places[term].append(at)
                self.acronyms[term] += len(token) > 1 and token.isupper()
                self.capitals[term] += i > 0 and token[0].isupper() and not token.isupper()
                if before is not None:
                    self.right[before][term] += 1
                    self.left[term][before] += 1
                before = term
        self.weights = {t: self.weight(t, *self.usual()) for t in self.count}

    @staticmethod
    def is_term(token: str) -> bool:
        return token[0].isalnum()

    def usual(self) -> tuple[float, int]:
        """Mean and deviation, added up, of the counts of words that can be keywords; the highest count."""
        if not hasattr(self, "_usual"):
            counts = [n for t, n in self.count.items() if t not in _STOP] or [1]
            mean = sum(counts) / len(counts)
            self._usual = mean + math.sqrt(sum((n - mean) ** 2 for n in counts) / len(counts)), max(self.count.values(), default=1)
        return self._usual

    def weight(self, term: str, norm: float, most: int) -> float:
        """The smaller, the more of a keyword."""
        n = self.count[term]
        case = max(self.acronyms[term], self.capitals[term]) / (1 + math.log(n))
        position = math.log(3 + median(self.places[term]))
        spread = len(set(self.places[term])) / len(self.sentences)
        sides = sum(len(c) / c.total() for c in (self.left[term], self.right[term]) if c)
        related = 1 + sides * n / most
        return related * math.log(position) / (case + n / norm / related + spread / related) if position > 1 else 0.0

    def follows(self, a: str, b: str) -> float:
        """How probably ``a`` and ``b`` stand together, from either side."""
        together = self.right[a][b]
        return together / self.count[a] * together / self.count[b]


def by_statistics(text: str, n: int = 5, longest: int = 3, alike: float = 0.9) -> list[tuple[str, float]]:
    """Runs of up to ``longest`` terms, within a sentence and without marks between, that neither begin nor end with a stop
    word, ranked by the product of their terms' weights over their frequency; of two that are alike by edit distance the
    better stays. The score is 1 minus the weight."""
    terms = _Terms(text)
    runs: Counter[tuple[str, ...]] = Counter()
    for sentence in terms.sentences:
        low = [t.lower() for t in sentence]
        for i in range(len(low)):
            for k in range(1, longest + 1):
                run = tuple(low[i : i + k])
                if len(run) < k or not terms.is_term(run[-1]):
                    break
                if run[0] in _STOP or run[-1] in _STOP or any(t.isdigit() or len(t) < 3 for t in (run[0], run[-1])):
                    continue
                runs[run] += 1
    ranked = []
    for run, times in runs.items():
        product, total = 1.0, 0.0
        for i, t in enumerate(run):
            if t in _STOP:  # inside: judged by how firmly it ties its neighbours
                loose = 1 - terms.follows(run[i - 1], t) * terms.follows(t, run[i + 1]) if i + 1 < len(run) else 1.0
                product *= 1 + loose
                total -= loose
            else:
                product *= terms.weights[t]
                total += terms.weights[t]
        ranked.append((product / (times * max(1 + total, 1e-9)), " ".join(run)))
    kept: list[tuple[float, str]] = []
    for weight, phrase in sorted(ranked):
        if len(kept) == n:
            break
        if all(min(len(phrase), len(other)) <= alike * max(len(phrase), len(other)) or _near(phrase, other) <= alike for _, other in kept):
            kept.append((weight, phrase))
    return [(phrase, 1 - weight) for weight, phrase in kept]


def by_encoder(text: str, encoder: Encoder, n: int = 5, longest: int = 3, diversity: float = 0.5) -> list[tuple[str, float]]:
    """Runs of up to ``longest`` words, stop words left out, nearest to the text's own vector, each next one by nearness
    to the text against nearness to those already taken; with their cosine to the text."""
    words = [w for w in _WORD.findall(text.lower()) if len(w) > 1 and w not in _STOP]
    phrases = list(dict.fromkeys(" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)))
    if not phrases:
        return []
    vectors = np.asarray(encoder([text, *phrases]), np.float64)
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    to_text, own = vectors[1:] @ vectors[0], vectors[1:]
    taken = [int(np.argmax(to_text))]
    while len(taken) < min(n, len(phrases)):
        worth = (1 - diversity) * to_text - diversity * (own @ own[taken].T).max(axis=1)
        worth[taken] = -np.inf
        taken.append(int(np.argmax(worth)))
    return [(phrases[i], round(float(to_text[i]), 4)) for i in taken]


def cascade(text: str, n: int = 5, methods: tuple[str, ...] = ("embedding", "statistical", "frequency"), encoder: Encoder | None = None) -> list[tuple[str, float, str]]:
    """(keyword, score, method) of the first method that finds any; embedding is passed over without an encoder."""
    for method in methods:
        if method == "embedding" and encoder is None:
            continue
        found = by_encoder(text, encoder, n) if method == "embedding" else by_statistics(text, n) if method == "statistical" else by_frequency(text, n)
        if found:
            return [(k, float(s), method) for k, s in found]
    return []
