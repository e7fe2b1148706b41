"""Pieces of DuckDB SQL that say what the text kernel computes."""

from __future__ import annotations

import unicodedata

from curamill.functions import lexicons as L


def q(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def array(values: list[str]) -> str:
    return "[" + ", ".join(map(q, values)) + "]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{L.BLANK}+|{L.BLANK}+$', '', 'g')"


def fields(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{L.BLANK}+'), lambda w: w <> '')"


def tokens(x: str) -> str:
    return rf"regexp_extract_all({x}, '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}\s]')"


def sentences(x: str) -> str:
    return rf"list_filter(list_transform(string_split(regexp_replace({x}, '([.!?]+)\s+', '\1' || chr(1), 'g'), chr(1)), lambda v: {strip('v')}), lambda v: v <> '')"


def special_ratio(x: str) -> str:
    kept = r"[\p{L}\p{N}\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{0b}\x{1c}-\x{1f}]"
    return f"CASE WHEN length({x}) > 0 THEN length(regexp_replace({x}, '{kept}', '', 'g')) / length({x}) END"


def non_ascii_ratio(x: str) -> str:
    return rf"CASE WHEN length({x}) > 0 THEN length(regexp_replace({x}, '[\x{{00}}-\x{{7f}}]', '', 'g')) / length({x}) END"


def comparable(x: str) -> str:
    one = f"regexp_replace(lower({x}), '{L.BLANK}+', ' ', 'g')"
    return strip(rf"regexp_replace({one}, '[^\p{{L}}\p{{M}}\p{{N}}_ ]', '', 'g')")


def band(x: str, lo: float, hi: float, fall: float, floor: float) -> str:
    return f"CASE WHEN {x} < {lo} THEN {x} / {lo} WHEN {x} <= {hi} THEN 1.0 ELSE greatest({floor}, 1 - ({x} - {hi}) / {fall}) END"


def quality(table: str, key: str) -> str:
    """CTEs ending in ``scored``: the measures and scores of each row."""
    stop = array(L.STOP_WORDS)
    shared = "len(list_intersect(c[i], c[i+1]))"
    return f"""
WITH b AS (SELECT {key}, coalesce(text, '') AS x, {sentences("coalesce(text, '')")} AS s FROM {table}),
b1 AS (SELECT *, list_transform(s, lambda v: {tokens("lower(v)")}) AS st FROM b),
b2 AS (SELECT *, flatten(st) AS t, list_transform(st, lambda v: list_filter(list_distinct(v), lambda z: NOT list_contains({stop}, z))) AS c FROM b1),
b3 AS (SELECT *, list_filter(t, lambda v: regexp_full_match(v, '\\p{{L}}+')) AS w FROM b2),
b4 AS (SELECT *, len(s) AS n_sentences, len(t) AS n_tokens, len(w) AS n_words,
  list_sum(list_transform(w, lambda v: greatest(1, len(regexp_extract_all(v, '[aeiouyàâäéèêëîïôöùûüáíóúñ]+')))))::DOUBLE AS syl,
  list_filter(range(1, len(s)), lambda i: len(c[i]) > 0 AND len(c[i+1]) > 0) AS pairs FROM b3),
m AS (SELECT {key}, n_sentences, n_tokens, n_words,
  CASE WHEN n_words > 0 AND n_sentences > 0 THEN 206.835 - 1.015 * (n_words / n_sentences) - 84.6 * (syl / n_words) END AS ease,
  CASE WHEN n_words > 0 AND n_sentences > 0 THEN 0.39 * (n_words / n_sentences) + 11.8 * (syl / n_words) - 15.59 END AS grade,
  CASE WHEN n_words > 0 AND n_sentences > 0 THEN n_words / n_sentences END AS asl,
  CASE WHEN n_sentences >= 2 THEN len(list_filter(range(1, len(s) + 1), lambda i: len(list_intersect(st[i], {array(L.TRANSITIONS)})) > 0 OR regexp_matches(lower(s[i]), {q("|".join(L.TRANSITION_PHRASES))}))) / n_sentences END AS transition,
  CASE WHEN n_sentences >= 2 THEN coalesce(list_avg(list_transform(pairs, lambda i: {shared} / (len(c[i]) + len(c[i+1]) - {shared}))), 0.1) END AS cohesion,
  CASE WHEN n_sentences >= 2 THEN list_stddev_pop(list_transform(st, lambda v: len(v)::DOUBLE)) / (list_avg(list_transform(st, lambda v: len(v))) + 1) END AS variance,
  CASE WHEN n_tokens >= 10 THEN len(list_distinct(t)) / n_tokens END AS diversity,
  CASE WHEN n_tokens >= 10 THEN len(list_filter(w, lambda v: NOT list_contains({stop}, v))) / n_tokens END AS content,
  CASE WHEN n_tokens >= 10 AND n_words > 0 THEN list_avg(list_transform(w, lambda v: length(v))) END AS word_length,
  CASE WHEN n_tokens >= 10 THEN len(list_filter(t, lambda v: regexp_matches(v, '[0-9]'))) / n_tokens END AS numbers,
  CASE WHEN n_sentences > 0 THEN regexp_matches(s[-1], '[.!?]$') END AS ends,
  CASE WHEN n_sentences > 0 THEN regexp_matches(lower(x), {q(L.TRUNCATION)}) END AS truncated,
  CASE WHEN n_sentences > 0 THEN regexp_matches(lower(x), {q("|".join(L.CONCLUSIONS))}) END AS concluded,
  CASE WHEN n_sentences > 0 THEN len(list_filter(s, lambda v: regexp_matches(v, '^\\p{{Lu}}'))) / n_sentences END AS capitals,
  CASE WHEN n_sentences > 0 THEN n_words / n_sentences END AS wps,
  CASE WHEN length(x) > 0 THEN length(regexp_replace(x, '[^\\p{{L}}]', '', 'g')) / length(x) END AS alpha
  FROM b4),
f AS (SELECT *,
  CASE WHEN ease IS NULL THEN 0.5 ELSE 0.4 * (CASE WHEN ease < 0 THEN 0.0 WHEN ease < 30 THEN ease / 60 WHEN ease <= 80 THEN 0.5 + (ease - 30) / 100 ELSE 1.0 END)
    + 0.3 * (CASE WHEN grade < 6 THEN 0.5 WHEN grade <= 12 THEN 1.0 WHEN grade <= 16 THEN 1 - (grade - 12) * 0.075 ELSE 0.5 END) + 0.3 * ({band("asl", 10, 25, 25, 0.0)}) END AS readability,
  CASE WHEN n_sentences < 2 THEN 0.5 ELSE 0.3 * least(1.0, 3 * transition) + 0.5 * ({band("cohesion", 0.2, 0.4, 0.6, 0.5)}) + 0.2 * greatest(0.0, 1 - variance / 2) END AS coherence,
  CASE WHEN n_tokens < 10 THEN 0.3 ELSE 0.3 * least(1.0, diversity / 0.6) + 0.3 * least(1.0, content / 0.6) + 0.2 * (CASE WHEN word_length IS NULL THEN 0.5 ELSE {band("word_length", 4, 7, 5, 0.5)} END) + 0.2 * ({band("numbers", 0.05, 0.15, 0.15, 0.5)}) END AS information_density,
  CASE WHEN n_sentences = 0 THEN 0.0 ELSE 0.3 * (CASE WHEN ends THEN 1.0 ELSE 0.3 END) + 0.3 * (CASE WHEN truncated THEN 0.2 ELSE 1.0 END) + 0.2 * (CASE WHEN concluded THEN 1.0 ELSE 0.7 END)
    + 0.2 * (CASE WHEN n_tokens < 50 THEN 0.3 WHEN n_tokens < 100 THEN 0.7 ELSE 1.0 END) END AS completeness,
  CASE WHEN n_sentences = 0 OR n_words = 0 THEN 0.5 ELSE 0.3 * capitals + 0.4 * ({band("wps", 10, 25, 25, 0.5)}) + 0.3 * least(1.0, alpha / 0.7) END AS linguistic_quality FROM m),
scored AS (SELECT *, (0.2 * readability + 0.25 * coherence + 0.25 * information_density + 0.15 * completeness + 0.15 * linguistic_quality)::DOUBLE AS composite_score FROM f)
"""


CATEGORY = "CASE WHEN composite_score >= 0.8 THEN 'excellent' WHEN composite_score >= 0.65 THEN 'good' WHEN composite_score >= 0.5 THEN 'acceptable' WHEN composite_score >= 0.35 THEN 'poor' ELSE 'very_poor' END"


def by_character(x: str, mapping: str) -> str:
    """``x`` with each character replaced by what the SQL map ``mapping`` has for it."""
    return f"array_to_string(list_transform(string_split({x}, ''), lambda v: coalesce({mapping}[v], v)), '')"


def literal_map(pairs: dict[str, str]) -> str:
    return "MAP {" + ", ".join(f"{q(k)}: {q(v)}" for k, v in pairs.items()) + "}"


def compatibility() -> dict[str, str]:
    """Every character of the basic plane and its NFKC form, where that differs from its NFC form."""
    found = {}
    for code in (*range(0x80, 0xD800), *range(0xF900, 0x10000)):
        c = chr(code)
        if (k := unicodedata.normalize("NFKC", c)) != unicodedata.normalize("NFC", c):
            found[c] = k
    return found


def nfkc(x: str) -> str:
    return f"nfc_normalize({by_character(x, 'nfkc')})"


def repaired(x: str) -> str:
    """Lines that are UTF-8 read as Windows-1252, up to three times over, read again, plain quotes and ligatures, plain line ends."""
    line = "list_transform(string_split(v, ''), lambda c: bytes[c])"
    back = f"TRY(decode(unhex(array_to_string({line}, ''))))"
    known = f"len(list_filter({line}, lambda b: b IS NULL)) = 0"
    fixed = f"string_split({x}, chr(10))"
    for _ in range(3):
        fixed = f"list_transform({fixed}, lambda v: CASE WHEN {known} AND length({back}) < length(v) THEN {back} ELSE v END)"
    return f"replace(replace({by_character(f'array_to_string({fixed}, chr(10))', 'plain')}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"


def maps(plain: dict[int, str], windows: str) -> str:
    """The CTE ``maps``, a row to be joined where ``nfkc`` and ``repaired`` are used."""
    bytes_of = {c: f"{b:02x}" for b, c in enumerate(windows) if b}
    return f"maps AS (SELECT {literal_map(compatibility())} AS nfkc, {literal_map(bytes_of)} AS bytes, {literal_map({chr(k): v for k, v in plain.items()})} AS plain)"


def without_tags(x: str) -> str:
    return f"regexp_replace({x}, '(?s)<!--.*?-->|<[!?][^>]*>|</?[a-zA-Z][^>]*>', '', 'g')"


def language(x: str) -> str:
    """As the kernel's ``language``."""
    words = f"regexp_split_to_array(lower({x}), '[^\\p{{L}}]+')"
    best = ", ".join(f"{{'n': len(list_filter({words}, lambda v: list_contains({array(w)}, v))), 'o': {-i}, 'lang': {q(k)}}}" for i, (k, w) in enumerate(L.LANGUAGE_WORDS.items()))
    kana, han = (f"(length({x}) - length(regexp_replace({x}, '[\\x{{{a}}}-\\x{{{b}}}]', '', 'g')))" for a, b in (("3040", "30ff"), ("4e00", "9fff")))
    most = f"list_max([{best}])"
    return f"CASE WHEN {x} IS NULL THEN NULL WHEN ({kana} + {han}) * 4 > length({x}) THEN CASE WHEN {kana} * 5 > {han} THEN 'ja' ELSE 'zh' END WHEN {most}.n > 0 THEN {most}.lang ELSE 'unknown' END"


def components(edges: str) -> str:
    """Recursive CTE ``reach`` (node, other) over the CTE ``edges`` (a, b), for small graphs."""
    return f"ways AS (SELECT a, b FROM {edges} UNION SELECT b, a FROM {edges}), reach AS (SELECT a AS node, b AS other FROM ways UNION SELECT r.node, e.b FROM reach r JOIN ways e ON r.other = e.a)"
