"""Telling in which encoding bytes were written."""

from __future__ import annotations

import re
import unicodedata

MARKS = ((b"\xef\xbb\xbf", "utf-8-sig"), (b"\xff\xfe", "utf-16"), (b"\xfe\xff", "utf-16"))
#: Names of public codecs, in the order in which equals are preferred.
CODECS = ("cp1252", "cp1250", "cp1251", "koi8-r", "cp1253", "cp1255", "cp874", "shift_jis", "euc_jp", "gb18030", "big5", "euc_kr", "mac_roman", "cp437")
#: Characters that are frequent where their script is written.
FREQUENT = frozenset(
    "éèàçêôîûùëïâœäöüßñáíóúżłąęśćńźěščřžýůťďőű"
    "оеаинтсрвлкмдпу"
    "αοιετσνηυρπκμλςάέήίόύώ"
    "יוהלאתרבמש"
    "านรอกเงมยลวดทสตะปบคห"
    "的一是不了在人有我他这中大来上国到说们为子和你地出道也时年得就那要下以生会自着去之过家学对可里后小么心多天而能好都然没于起还发成事只作当想看文无开手十用主行方又如前所本见经头面公同三已老从动两长"
)
_FINE = frozenset("“”‘’„–—…«»°€£§©®·•、。，！？「」『』（）：；¿¡½¼¾ºª²³×±µ　")
_RUN = re.compile("[^\x00-\x7f]+")


def _script(c: str) -> str:
    """A coarse script: the first word of the character's name."""
    return unicodedata.name(c, "?").split(" ")[0]


def plausibility(text: str) -> float:
    """How much the characters beyond ASCII look written on purpose, from -2 to 1 on average: frequent letters well, marks of
    print and other letters of a script so-so, and symbols, control characters and a change of script or case in a word badly."""
    total = n = 0.0
    for run in _RUN.finditer(text):
        before = text[run.start() - 1 : run.start()]
        for c in run.group():
            n += 1
            kind = unicodedata.category(c)
            if c in FREQUENT or c.lower() in FREQUENT or "ぁ" <= c <= "ヺ" or "가" <= c <= "힣":
                total += 1
            elif c in _FINE:
                total += 0.5
            elif kind[0] == "L":
                total += 0.2
            elif kind[0] != "M":
                total -= 2
            if before.isalpha() and kind[0] == "L":
                if before.islower() and c.isupper():
                    total -= 1.5
                if _script(before) != _script(c) and not {_script(before), _script(c)} <= {"CJK", "HIRAGANA", "KATAKANA"}:
                    total -= 1.5
            before = c
    return total / n if n else 0.0


def decode_bytes(data: bytes) -> tuple[str, str]:
    """Text and the encoding it was read in: what a byte-order mark says, else UTF-8 if valid, else of the codecs that
    decode all of it the one whose text is most plausible, else Windows-1252 with replacement characters."""
    for mark, name in MARKS:
        if data.startswith(mark):
            return data.decode(name, "replace"), name
    try:
        return data.decode("utf-8"), "utf-8"
    except UnicodeDecodeError:
        pass
    best, found = -1e9, None
    for codec in CODECS:
        try:
            text = data.decode(codec)
        except UnicodeDecodeError:
            continue
        worth = plausibility(text)
        if worth > best + 1e-9:
            best, found = worth, (text, "windows-1252" if codec == "cp1252" else codec)
    return found or (data.decode("cp1252", "replace"), "windows-1252")
