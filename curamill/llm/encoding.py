"""Text garbled by wrong decoding: predict the encoding chain from byte bigrams, invert it, verify it decodes strictly."""

from __future__ import annotations

import codecs
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from curamill.functions.columns import fenced, make_room

# How bytes written in one encoding were read as another. Names of public codecs; "1252" is
# Windows-1252 with its five unassigned bytes kept as control characters, as most software reads it.
CHAINS = (
    ("utf-8", "1252"),
    ("utf-8", "latin-1"),
    ("utf-8", "cp1251"),
    ("utf-8", "cp1250"),
    ("utf-8", "cp437"),
    ("utf-8", "cp850"),
    ("utf-8", "mac_roman"),
    ("utf-8", "cp932"),
    ("utf-8", "gb18030"),
    ("1252", "cp1251"),
    ("1252", "cp437"),
    ("1252", "cp850"),
    ("1252", "mac_roman"),
    ("cp437", "1252"),
    ("cp850", "1252"),
    ("mac_roman", "1252"),
    ("cp1251", "1252"),
    ("gb18030", "1252"),
    ("cp932", "1252"),
    ("euc_jp", "1252"),
    ("big5", "1252"),
    ("euc_kr", "1252"),
    ("1252", "utf-8"),
)
TWICE = (("utf-8", "1252"), ("utf-8", "latin-1"))
LOST = "1252>utf-8"
_SINGLE = frozenset({"1252", "cp437", "cp850", "mac_roman", "cp1251"})
#: Clean text in many scripts, for the classes a sample of the corpus may lack.
CLEAN = (
    "Señor, ¿más té? ½ ración de jamón con piñones y café. Mañana habrá más; ¡qué ilusión! El niño comió paella en Málaga.",
    "Garçon, l’addition s’il vous plaît… Crème brûlée à 6,50 €, où êtes-vous né ? L’été dernier, Noël à l’hôtel, forêt, île, œuvre.",
    "Grüße aus Köln: Müsli, Brötchen, Käse für 3,20 €, Straße, Fußgänger, Übergrößen, Ärger, Öl. „Schön“, sagte er – „sehr schön“.",
    "São Paulo, ação nº 3, coração, pão, avó, mãe, ÇA VA, À BIENTÔT, ÉTÉ, SÃO JOÃO, AÇÃO, ÂNGELO, CRÈME BRÛLÉE, CAFÉ, FRÜHSTÜCK.",
    "“Keep it,” she said — it’s 20 °C, ±5 %, £4, ©, ®, §7, •, …, ™, × 2, naïve café, résumé, jalapeño, façade, 100 µg, ¼, ¾.",
    "Zażółć gęślą jaźń, Dvořák, Škoda, Þór, smørrebrød, ångström, æble, İstanbul, ığdır, čeština, őrült, Łódź.",
    "КАССА 4 ИТОГО 12, спасибо за покупку. Ваш чек номер 15, приходите ещё. Гостиница «Заря», улица Мира, дом 7, Москва.",
    "Ευχαριστούμε πολύ, απόδειξη αριθμός 12, σύνολο 8 ευρώ. Καλημέρα σας, το ξενοδοχείο είναι στην Αθήνα.",
    "請慢用，謝謝光臨。合計三百元，收據號碼十二。今天的湯很好喝，明天再來。会计深夜换了台灯，账单一共二十三元。",
    "領収書をご覧ください。合計は三十ドルでした。毛布を裏口まで届けてください。コーヒー、テラス、レジ、ありがとうございます。",
    "영수증을 보관해 주세요. 합계는 만 원입니다. 감사합니다, 또 오세요. 호텔 로비에서 기다리겠습니다.",
    "กรุณาเก็บใบเสร็จเลขที่ไว้ด้วยค่ะ ขอบคุณครับ ราคา 20 บาท ประตูข้างปิดแล้ว",
    "कृपया रसीद संभाल कर रखें। कुल 20 रुपये हुए। धन्यवाद, फिर आइए। मेहमान सुबह जल्दी पहुँचे।",
)
_HIGH = regex.compile(r"[^\x00-\x7f]")
_MIXED = regex.compile(r"\p{Latin}[\p{Cyrillic}\p{Greek}─-▟√∂ﾀ-ﾟ]|[\p{Cyrillic}\p{Greek}─-▟√∂ﾀ-ﾟ]\p{Latin}|[�\x80-\x9f]")
_GAPS = regex.compile(r"([ \t\r]+)")
OUTPUTS = ("garbled", "encoding_chain", "restoration", "garbled_lines", "restored_text")


_FROM_1252 = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(256))
_TO_1252 = codecs.charmap_build(_FROM_1252)


def encode(text: str, codec: str) -> bytes:
    """Strict; raises UnicodeError."""
    return codecs.charmap_encode(text, "strict", _TO_1252)[0] if codec == "1252" else text.encode(codec)


def decode(data: bytes, codec: str, errors: str = "strict") -> str:
    return codecs.charmap_decode(data, errors, _FROM_1252)[0] if codec == "1252" else data.decode(codec, errors)


def garble(text: str, chain: str) -> str | None:
    """``text`` as the chain would have garbled it; None if the chain can't hold it or doesn't change it."""
    out = text
    try:
        for step in chain.split(" "):
            written, read = step.split(">")
            out = decode(encode(out, written), read, "replace")
    except UnicodeError:
        return None
    return None if out == text else out


def invert(text: str, chain: str) -> str | None:
    """The text before the chain, if every step back is strictly possible; None otherwise."""
    out = text
    if chain == LOST:
        return None
    try:
        for step in reversed(chain.split(" ")):
            written, read = step.split(">")
            out = decode(encode(out, read), written)
    except UnicodeError:
        return None
    return out if out != text and "�" not in out else None


NAMES = tuple(f"{w}>{r}" for w, r in CHAINS) + tuple(f"{w}>{r} {w}>{r}" for w, r in TWICE)


@dataclass(frozen=True)
class Training:
    """The classifier is fitted on the non-ASCII lines of at most ``records`` records (those with the least hash of
    their text), at most ``lines`` of ``line_chars`` characters each. Everything else reads whole texts."""

    records: int = 2000
    lines: int = 10
    line_chars: int = 300
    buckets: int = 8192
    smoothing: float = 0.1


class Classifier:
    """Multinomial over hashed byte bigrams that touch a non-ASCII byte. Class 0 is clean text, which is expected far
    more often than any chain: ``PRIOR`` is its lead in log-likelihood."""

    PRIOR = 6.0

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        self.buckets = len(weights)

    @staticmethod
    def bigrams(lines: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of the bigrams of the lines, one after the other, and where each line's begin."""
        data = [x.encode("utf-8", "surrogatepass") for x in lines]
        b = np.frombuffer(b"\n" + b"\n".join(data) + b"\n", np.uint8).astype(np.int64)
        high = b >= 128
        at = np.flatnonzero(high[:-1] | high[1:])
        ends = np.cumsum([len(x) + 1 for x in data])
        starts = np.searchsorted(at, np.concatenate([[0], ends[:-1]]))
        return ((b[at] * 256 + b[at + 1]) * 2654435761 >> 7) % buckets, starts

    @classmethod
    def fit(cls, lines: list[str], options: Training) -> Classifier:
        counts = np.full((options.buckets, len(NAMES) + 1), options.smoothing)
        lines = [x for x in lines if not _suspicious(x)] + list(CLEAN) * 5
        for k in range(len(NAMES) + 1):
            texts = lines if k == 0 else [t for t in (garble(x, NAMES[k - 1]) for x in lines) if t is not None]
            if texts:
                counts[:, k] += np.bincount(cls.bigrams(texts, options.buckets)[0], minlength=options.buckets)
        return cls(np.log(counts / counts.sum(axis=0)).astype(np.float32))

    def scores(self, lines: list[str]) -> np.ndarray:
        """Log-likelihood of each line, which must not be ASCII, in each class."""
        found, starts = self.bigrams(lines, self.buckets)
        out = np.add.reduceat(self.weights[found], starts, axis=0)
        out[:, 0] += self.PRIOR
        return out

    def likelihood(self, text: str) -> float:
        """Log-likelihood of the text's non-ASCII bigrams as clean text; 0 for ASCII."""
        found, _ = self.bigrams([text], self.buckets)
        return float(self.weights[found, 0].sum())


#: The bytes of a replacement character as each chain's reader shows them; what stood there is lost, whatever the rest.
_MARKS = {decode("�".encode(), r): f"{w}>{r}" for w, r in CHAINS[:7]} | {"锟斤拷": "utf-8>gb18030"}
_LOST_MARK = regex.compile("|".join(map(regex.escape, _MARKS)))
_RUN = regex.compile(r"[¡-¿À-ÿ]{3}|[‚ƒ][^\s]{1,2}[‚ƒ]")


def _suspicious(line: str) -> bool:
    """Whether a sampled line may itself be garbled; such lines don't train the clean class."""
    return bool(_MIXED.search(line)) or bool(_RUN.search(line)) or any(invert(line, f"{w}>{r}") for w, r in CHAINS[:9])


def _wordlike(line: str, back: str, chain: str) -> bool:
    """Whether what came out is words: enough letters among all characters. Single bytes always decode, so that is all
    there is to go by for them. Where several bytes make a character, letters enough among those beyond ASCII will do
    too, as in lists of figures, but there must be new ones, and more of them in a line with as many different marks as
    scan noise has."""
    solid = [c for c in back if not c.isspace()]
    high = [c for c in solid if c > "\x7f"]
    single = chain.split(">")[0] in _SINGLE
    if not any(sum(map(str.isalpha, x)) >= 0.4 * len(x) for x in ([solid] if single else [solid, high])):
        return False
    fresh = sum(c.isalpha() and c not in line for c in back)
    marks = {c for c in back if "!" <= c <= "~" and not c.isalnum()}
    return single or fresh >= (4 if len(marks) > 4 else 2)


@dataclass
class Finding:
    chain: str
    restored: str | None  # None where nothing could be restored
    whole: bool


def examine(line: str, scores: np.ndarray, model: Classifier) -> Finding | None:
    """None for a clean line. The likeliest chains are tried in turn; one holds if the line, or failing that single
    stretches between blanks, decode strictly and then read like clean text, or like text garbled once more."""
    order = np.argsort(-scores)
    mark = _LOST_MARK.search(line)
    lost = Finding(_MARKS[mark.group()], None, False) if mark else None
    if order[0] == 0:
        return lost
    before = model.likelihood(line)
    for k in order:
        if k == 0:
            break
        chain = NAMES[k - 1]
        if chain == LOST:
            if "�" in line:
                return Finding(chain, None, False)
            continue
        back = invert(line, chain)
        whole = back is not None
        if back is None:
            back = "".join(invert(p, chain) or p for p in _GAPS.split(line))
            if back == line:
                continue
        if _LOST_MARK.search(back):
            if mark:
                continue  # the mark was only read differently
            whole = False
        if not chain.startswith("utf-8") and not _wordlike(line, back, chain):
            continue  # scan noise: what comes out must at least be words
        if back.isascii():
            return Finding(chain, back, whole)
        proven = whole and chain.startswith("utf-8")  # sequences of several bytes that hold throughout are no accident
        gain = model.likelihood(back) - before
        if gain < (0.0 if proven else model.PRIOR):
            continue
        after = model.scores([back])[0]
        if after.argmax() == 0:
            return Finding(chain, back, whole)
        further = examine(back, after, model)
        if further is not None and further.restored is not None:
            return Finding(f"{further.chain} {chain}", further.restored, whole and further.whole)
        if further is not None or not whole:  # some of it came back
            return Finding(chain, back, False)
        if proven:
            return Finding(chain, back, True)
    return Finding(LOST, None, False) if "�" in line else lost


_RESULT = pa.struct([("chain", pa.string()), ("restoration", pa.string()), ("lines", pa.int32()), ("text", pa.string())])


def repair_text(text: str, model: Classifier) -> dict | None:
    """None for clean text, else the chains, how far it was restored, the number of garbled lines and the text."""
    lines = text.split("\n")
    at = [i for i, line in enumerate(lines) if not line.isascii()]
    if not at:
        return None
    chains, bad, whole, some = [], 0, True, False
    scores = model.scores([lines[i] for i in at])
    for j, i in enumerate(at):
        if not scores[j].argmax() and not _LOST_MARK.search(lines[i]):
            continue
        found = examine(lines[i], scores[j], model)
        if found is None:
            continue
        bad += 1
        if found.chain not in chains:
            chains.append(found.chain)
        whole = whole and found.whole
        if found.restored is not None:
            lines[i], some = found.restored, True
    if not bad:
        return None
    return {"chain": ", ".join(chains), "restoration": "full" if whole else "partial" if some else "none", "lines": bad, "text": "\n".join(lines) if some else None}


def sample_lines(df: DataFrame, text: str, options: Training) -> list[str]:
    """Lines of the texts with the least hashes. A limit on the hash, from the number of different texts, lets through about
    as many as are wanted over all tasks together, so what they send to the driver doesn't grow with the table."""
    hashed = df.filter(F.col(text).rlike(r"[^\x00-\x7f]")).select(F.shiftrightunsigned(F.xxhash64(text), 1).alias("h"), F.col(text).alias("text"))
    different = hashed.agg(F.approx_count_distinct("h", 0.02)).first()[0]
    below = min(2**63 - 1, int(2**63 * 1.5 * options.records / max(different, 1)))
    high = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x00-\x7f]"))
    lines = F.transform(F.slice(high, 1, options.lines), lambda x: F.substring(x, 1, options.line_chars))
    rows = hashed.filter(F.col("h") <= below).select("h", lines.alias("lines")).groupBy("h").agg(F.min("lines").alias("lines"))
    return [x for r in rows.orderBy("h").limit(options.records).collect() for x in r["lines"]]


def repair_encoding(df: DataFrame, text: str = "text", options: Training = Training()) -> DataFrame:
    """The input's columns and ``garbled``, ``encoding_chain`` (written>read, steps in order of damage; several lines'
    chains by commas), ``restoration`` (full, partial or none), ``garbled_lines`` and ``restored_text``, which is the
    text itself where nothing was garbled.

    A multinomial classifier on hashed byte bigrams is trained on lines of the table itself, synthetically garbled
    through every known chain. Each line is classified for itself, since files may be garbled in part. A predicted
    chain counts only if its inverse decodes strictly and reads better; text whose bytes were lost (replacement
    characters) is garbled but has no way back. Texts in plain ASCII never reach Python.

    Null texts give ``garbled`` null and null elsewhere; empty texts are clean. Repeated rows are judged each for
    itself, alike. Input columns named like an output come out as ``<name>_input``. An empty table gives an empty result.
    """
    df = make_room(df, OUTPUTS, keep=[text])
    model = Classifier.fit(sample_lines(df, text, options), options)
    weights = df.sparkSession.sparkContext.broadcast(model.weights)  # buckets x chains, under 1 MB

    @F.arrow_udf("struct<chain:string,restoration:string,lines:int,text:string>")
    def repair(texts: pa.Array) -> pa.Array:
        own = Classifier(weights.value)
        return pa.array([None if t is None else repair_text(t, own) for t in texts.to_pylist()], _RESULT)

    looked = fenced(df, __r=repair(F.when(F.col(text).rlike(r"[^\x00-\x7f]"), F.col(text))))
    return looked.select(
        *df.columns,
        F.when(F.col(text).isNotNull(), F.col("__r.chain").isNotNull()).alias("garbled"),
        F.col("__r.chain").alias("encoding_chain"),
        F.col("__r.restoration").alias("restoration"),
        F.when(F.col(text).isNotNull(), F.coalesce("__r.lines", F.lit(0))).alias("garbled_lines"),
        F.coalesce("__r.text", text).alias("restored_text"),
    )
