"""Telling sentences from lists, tables and junk inside one text, and the language of a text."""

from __future__ import annotations

import re
from dataclasses import dataclass

import regex

# Common function words by language, lower case.
COMMON = {
    "en": "the of and to in a is that it was for on are with as i his they be at one have this from or had by not but what all were we when your can said there use an each which she do how their if will up about out many then them these so some her would him into has two more no way could my than been who its now did get may part over after before while our you me he was am does done being also only very just until during since without near".split(),
    "fr": "le la les un une des du de et à en est que qui dans pour par sur au aux ce cette ces il elle nous vous ils elles je tu on se ne pas plus avec sans son sa ses leur leurs mais ou où donc si été était a ont sont être avoir fait comme tout tous après avant chez très bien peut quand dont y ai mon ma mes notre votre voici encore jamais afin ainsi".split(),
    "de": "der die das den dem des ein eine einen einem einer eines und in zu von mit auf für ist im am um an bei nach aus über vor durch wie es sich nicht auch als dass wir sie ich er ihr uns ihn war wird wurde werden haben hat hatte sind kann noch nur oder aber wenn mehr so zum zur bis gegen ohne unter zwischen sehr hier mein sein ihre mir dir man".split(),
    "es": "el la los las un una unos unas de del y a al en que es por para con se no su sus lo le les como más pero o este esta estos estas ese esa hay ha han fue era son está están ser tener muy ya todo todos si sin sobre entre cuando donde mi mis me te nos yo tú él ella nosotros desde hasta también porque qué cada otro otra".split(),
}
_OF = {}
for _lang, _list in COMMON.items():
    for _w in _list:
        _OF.setdefault(_w, []).append(_lang)
COMMON_SETS = {k: frozenset(v) for k, v in COMMON.items()}
ANY_COMMON = frozenset(_OF)
#: Grammatical words that mark a Chinese or Japanese line without a final mark as a sentence.
_CJK_GRAMMAR = regex.compile("[了在是把请吗这着过]|非常|已经|一共|没有|です|ます|ました|でした|ません|でしょう|ください")
WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+")
_PLAIN_WORD = re.compile(r"[^\W_]+")
_MARKS = re.compile("[\u0300-\u036f\u0483-\u0489\u0591-\u05bd\u0610-\u061a\u064b-\u065f\u0900-\u0dff\u0e00-\u0eff\u0f00-\u109f\u1700-\u17ff\u1ab0-\u1cff\u1dc0-\u1dff\u20d0-\u20ff\u3099\u309a\ua66f-\uabff\ufe00-\ufe2f\U00010000-\U0010ffff]")
_END = re.compile(r"[.!?…]+[\"'”’»)\]]*(?=\s|$)|[。！？।｡]+[」』”’）｣\"]*")
_BLOCK = re.compile(r"\n[^\S\n]*\n")
_KANA, _HAN, _THAI, _DEVA, _CYRL, _HANG = (regex.compile(rf"\p{{{s}}}") for s in ("Hiragana", "Han", "Thai", "Devanagari", "Cyrillic", "Hangul"))
_LATIN = regex.compile(r"\p{Latin}")
_FOREIGN = re.compile("[\u0400-\u052f\u0900-\u097f\u0e00-\u0e7f\u1100-\u11ff\u3040-\u30ff\u3130-\u318f\u3400-\u9fff\uac00-\ud7af\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")
_CJK, _OTHER = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}]"), regex.compile(r"[\p{Devanagari}\p{Cyrillic}\p{Hangul}]")
_SCRIPTS = (_CJK, _THAI, _DEVA, _CYRL, _HANG, regex.compile(r"\p{Greek}"), regex.compile(r"\p{Arabic}"))
_LIST_MARK = regex.compile(r"^[^\S\n]*(?:[-*•◦▪▫–|]|\d+[.)]\s)", regex.M)
_SYMBOL = regex.compile(r"[^\p{L}\p{M}\p{N}\s]")


@dataclass
class Analysis:
    """Words and sentences of a text. ``sentences``: the words of each stretch that reads like a sentence, as written."""

    language: str
    words: list[str]
    sentences: list[list[str]]
    spans: list[str]

    @property
    def sentence_words(self) -> int:
        return sum(map(len, self.sentences))

    @property
    def share(self) -> float:
        return self.sentence_words / len(self.words) if self.words else 0.0


def find_words(text: str) -> list[str]:
    """Runs of letters, their marks and digits, as written."""
    return WORD.findall(text) if not text.isascii() and _MARKS.search(text) else _PLAIN_WORD.findall(text)


def language_of(text: str, words: list[str]) -> str:
    """en, fr, de, es by common words; ja, zh, th, hi, ru, ko by script; und otherwise."""
    if not text.isascii() and _FOREIGN.search(text):
        counts = {"ja": 3 * len(_KANA.findall(text)), "zh": len(_HAN.findall(text)), "th": len(_THAI.findall(text)), "hi": len(_DEVA.findall(text)), "ru": len(_CYRL.findall(text)), "ko": len(_HANG.findall(text))}
        best = max(counts, key=counts.get)
        if counts[best] * 2 > sum(1 for _ in _LATIN.finditer(text)):
            if best == "zh" and counts["ja"] * 4 > counts["zh"]:
                return "ja"
            return best
    votes = dict.fromkeys(COMMON, 0)
    for w in filter(ANY_COMMON.__contains__, words):
        for lang in _OF[w]:
            votes[lang] += 1
    best = max(votes, key=votes.get)
    return best if votes[best] > 0 else "und"


def _runs_on(span: str) -> bool:
    """Whether short lines are a sentence wrapped in a narrow column: most breaks stand inside a phrase, after a word or
    comma and before a small letter, or after a common word, and common words are as frequent before the last line as in prose."""
    lines = [x for x in map(str.strip, span.split("\n")) if x]
    inside = 0
    for line, following in zip(lines, lines[1:]):
        last = line.rpartition(" ")[2].lower()
        inside += last in ANY_COMMON or (line[-1].isalpha() or line[-1] == ",") and following[0].islower()
    words = find_words(" ".join(lines[:-1]).lower())
    return inside * 2 >= len(lines) - 1 and sum(w in ANY_COMMON for w in words) >= 0.2 * len(words)


def _reads_like_sentence(span: str, words: list[str], ended: bool) -> bool:
    foreign = not span.isascii() and _FOREIGN.search(span) is not None
    if not ended and not foreign:
        return False
    n = len(words)
    solid_words = [w for w in words if not w[0].isdigit()]
    numbers, letters = n - len(solid_words), sum(map(len, solid_words))
    if letters < 3:
        return False
    solid = len(span) - span.count(" ") - span.count("\n")
    if foreign:
        if sum(x.search(span) is not None for x in _SCRIPTS) > 1:
            return False  # scan noise takes its signs from everywhere
        if _CJK.search(span):
            return letters >= 0.35 * solid and (ended or (letters >= 5 and not _LIST_MARK.search(span) and _CJK_GRAMMAR.search(span) is not None))
        if letters >= 0.6 * solid:
            if _THAI.search(span):
                return letters >= 12
            if _OTHER.search(span):
                return ended and n >= 3
    if not ended or n < 3 or letters < 0.6 * solid or numbers > 0.4 * n:
        return False
    breaks = span.count("\n")
    if breaks > 1 and n < 3 * (breaks + 1) and letters < 20 * (breaks + 1) and not _runs_on(span):
        return False
    return sum(w.lower() in ANY_COMMON for w in words) >= max(1, 0.08 * n)


def analyse(text: str) -> Analysis:
    """Sentences are looked for in each block between blank lines: a stretch up to a final mark that holds words
    rather than figures and symbols, some of them common words, and whose lines are not one or two words long. A
    list running into a sentence gives it only its last line. In Chinese and Japanese a line of its own may lack
    the final mark if its grammar is a sentence's."""
    every, sentences, spans = [], [], []

    def take(span: str, words: list[str], ended: bool) -> None:
        if words and _reads_like_sentence(span, words, ended):
            sentences.append(words)
            spans.append(span)

    for block in _BLOCK.split(text):
        at = 0
        stops = [m.end() for m in _END.finditer(block)]
        for stop in [*stops, None]:
            span = block[at:stop].strip()
            at = stop
            if not span:
                continue
            words = find_words(span)
            every += words
            ended = stop is not None
            if not words:
                continue
            if "\n" in span:
                if not span.isascii() and _FOREIGN.search(span) and _CJK.search(span) and (not ended or _CJK_GRAMMAR.search(span)):
                    *lines, last = span.split("\n")
                    for line in lines:
                        take(line.strip(), find_words(line), False)
                    take(last, find_words(last), ended)
                    continue
                if ended and _LIST_MARK.search(span):
                    span = span.rpartition("\n")[2]
                    words = find_words(span)
            take(span, words, ended)
    return Analysis(language_of(text, [w.lower() for w in every]), every, sentences, spans)


def symbol_ratio(text: str) -> float:
    solid = len(text) - sum(map(str.isspace, text))
    return len(_SYMBOL.findall(text)) / solid if solid else 0.0
