"""Personal data in texts, also in disguise.

Base patterns are found in the text as it is. For disguised data, transducers rewrite the text step by step: homoglyphs
and invisible characters, spelled digits, then "at" and "dot". Every step keeps the source range of each character it
writes, so the steps compose, the same detectors run over the rewritten text, and what they find is mapped back to the
source. All offsets count code points. Each document is handled by itself; nothing is shuffled.
"""

import hashlib
import re
import unicodedata
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foroscope.llm.common import Memo, id_text, row_key, ship_by_value, to_batch

ship_by_value(__name__)

KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match can only begin where a run of digits begins, and takes it whole: linear on long runs, with the same matches.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGITS = re.compile(r"[^0-9]+")

#: Letters of other scripts that look like Latin ones.
LOOKALIKES = dict(zip("аеорсухіјѕԁһкмтвнАЕОРСУХІЈЅКМТВНαοιυνρκτΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
                      "aeopcyxijsdhkmtbhAEOPCYXIJSKMTBHaoiuvpktABEZHIKMNOPTYX", strict=True))
#: Characters without width.
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
#: Names of digits in the languages of the corpus.
DIGIT_NAMES = {
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8",
    "nine": "9", "oh": "0", "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7",
    "huit": "8", "neuf": "9", "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5",
    "sechs": "6", "sieben": "7", "acht": "8", "neun": "9", "cero": "0", "uno": "1", "dos": "2", "tres": "3",
    "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
#: Names of the signs, in pairs that go together.
AT, DOT, PLUS = r"at|arobase|arroba|klammeraffe", r"dot|point|punkt|punto", r"plus|más"
PAIRS = (("at", "dot"), ("arobase", "point"), ("arroba", "punto"), ("(?:klammeraffe|at)", "punkt"))


@Memo
def single_characters() -> dict[int, str]:
    """Code point to its plain form: lookalikes, full-width and other compatibility forms of ASCII."""
    table = {ord(a): b for a, b in LOOKALIKES.items()}
    table.update(dict.fromkeys(map(ord, INVISIBLE), ""))
    ranges = ((0x00A0, 0x00A0), (0x00B2, 0x00B9), (0x02B0, 0x02B8), (0x0660, 0x0669), (0x06F0, 0x06F9), (0x2000, 0x200A),
              (0x2010, 0x2015), (0x2024, 0x2024), (0x202F, 0x202F), (0x2070, 0x209C), (0x2460, 0x249B), (0xFE52, 0xFE6B),
              (0xFF01, 0xFF5E), (0x1D400, 0x1D7FF), (0x3000, 0x3002))
    for first, last in ranges:
        for code in range(first, last + 1):
            char = chr(code)
            plain = unicodedata.normalize("NFKC", char).strip("()")
            digit = unicodedata.digit(char, None)
            if digit is not None:
                table[code] = str(digit)
            elif unicodedata.category(char) == "Zs":
                table[code] = " "
            elif unicodedata.category(char) == "Pd":
                table[code] = "-"
            elif code in (0x3002,):
                table[code] = "."
            elif plain and plain.isascii() and plain.isprintable():
                table[code] = plain
    return table


@Memo
def odd_table() -> np.ndarray:
    flags = np.zeros(0x110000, bool)
    flags[list(single_characters())] = True
    return flags


def odd_places(text: str) -> list[int]:
    """Where the text has characters that stand for plain ones."""
    if text.isascii():
        return []
    return np.flatnonzero(odd_table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]).tolist()


class Mapped:
    """A rewritten text; character i stands for source[starts[i]:ends[i]]."""

    def __init__(self, text: str, starts: np.ndarray, ends: np.ndarray):
        self.text, self.starts, self.ends = text, starts, ends

    @classmethod
    def of(cls, text: str, offset: int = 0) -> "Mapped":
        place = np.arange(offset, offset + len(text))
        return cls(text, place, place + 1)

    def rewrite(self, pattern: re.Pattern, output) -> "Mapped":
        """Each match becomes ``output(match)``, whose characters stand for the whole match."""
        return self.replace((*m.span(), output(m)) for m in pattern.finditer(self.text))

    def replace(self, changes) -> "Mapped":
        """Each (start, end, new) in order: the new characters stand for the whole stretch."""
        parts, starts, ends, at = [], [], [], 0
        for a, b, new in changes:
            if new == self.text[a:b]:
                continue
            parts += [self.text[at:a], new]
            starts += [self.starts[at:a], np.full(len(new), self.starts[a])]
            ends += [self.ends[at:a], np.full(len(new), self.ends[b - 1])]
            at = b
        if not parts:
            return self
        return Mapped("".join([*parts, self.text[at:]]), np.concatenate([*starts, self.starts[at:]]),
                      np.concatenate([*ends, self.ends[at:]]))

    def plain(self) -> "Mapped":
        """Odd characters become plain ones."""
        places = odd_places(self.text)
        if not places:
            return self
        table = single_characters()
        new = list(self.text)
        for p in places:
            new[p] = table[ord(new[p])]
        origin = np.repeat(np.arange(len(new)), list(map(len, new)))
        return Mapped("".join(new), self.starts[origin], self.ends[origin])

    def source(self, start: int, end: int) -> tuple[int, int]:
        return int(self.starts[start]), int(self.ends[end - 1])


NAME = "|".join(sorted(DIGIT_NAMES, key=len, reverse=True))
GAP = r"[\x20,;/().-]{1,3}"
#: At least four digit names or digits in a row, two of them names.
SPELLED = re.compile(rf"(?<![^\W_])(?:(?:{NAME}|[0-9]+){GAP}){{3,}}(?:{NAME}|[0-9]+)(?![^\W_])", re.I)
SPELLED_HINT = re.compile(rf"(?<![^\W_])(?:{NAME}){GAP}(?:{NAME}|[0-9]+){GAP}(?:{NAME}|[0-9])", re.I)
ONE_NAME = re.compile(NAME, re.I)
GAP_IN_NUMBER = re.compile(rf"(?<=[0-9]){GAP}(?=[0-9])")
PLUS_NAME = re.compile(rf"(?<![^\W_])(?:{PLUS})\x20(?=[0-9])", re.I)
#: Signs between brackets, or as words between blanks; a sign between blanks counts only beside the other one.
OPEN, CLOSE = r"\x20?[(\[{<]\x20?", r"\x20?[)\]}>]\x20?"
BRACKETED_AT = re.compile(rf"{OPEN}(?:@|{AT}){CLOSE}", re.I)
BRACKETED_DOT = re.compile(rf"{OPEN}(?:\.|{DOT}){CLOSE}", re.I)
BLANKS = r"[\x20\t\r\n]{1,4}"


def around(word: str) -> str:
    """A sign as a word between blanks or line breaks, or between hyphens."""
    return rf"(?:{BLANKS}(?:{word}){BLANKS}|\x20-(?:{word})-\x20?)"


def chain(dot: str, label: str = r"[A-Za-z0-9%+_-]") -> re.Pattern:
    """Labels with dots between them, taken whole, so that a scan over chains is linear."""
    return re.compile(rf"(?<![A-Za-z0-9._%+-]){label}++(?:{dot}{label}++)*+", re.I)


PLAIN_CHAIN, SPACED_HOST = chain(r"\."), chain(r"(?:\x20?\.\x20?)", "[A-Za-z0-9-]")
ANY_DOT = re.compile(rf"{around(DOT)}|\x20?\.\x20?", re.I)
WORD_DOT = re.compile(around(DOT), re.I)
#: Local part, sign, host of an address with its last dot in words, by language.
WORDS = [(chain(rf"(?:\.|{around(dot)})"), re.compile(rf"{around(at)}|\x20?@\x20?", re.I),
          chain(rf"(?:\.|{around(dot)})", "[A-Za-z0-9-]")) for at, dot in PAIRS]
SPACED_AT, WORD_AT = re.compile(r"\x20@\x20?|@\x20"), re.compile(around(AT), re.I)
#: Words that end no host name.
NO_LABELS = frozenset("the a an of on in is and to it or for with was that this".split())
TOP_LABEL = re.compile(r"[A-Za-z]{2,24}")
#: "at" in words before a host with plain dots is an address only where a line begins, behind a cue, or if the part before
#: it is no plain word: "meet me at example.com" is prose. Endings and cues.
TOPS = frozenset("com org net edu gov info io co eu de fr es uk us it nl example test".split())
CUE = r"(?:e-?mail|mail|contact|write(?:\x20to)?|reach|address|correo|courriel|kontakt)"
BEFORE = re.compile(rf"(?:\n[\x20\t]*|(?<![A-Za-z]){CUE}(?:\x20is|\x20at)?[:\x20]{{1,2}})$", re.I)
ODD_NAME = re.compile(r"[0-9._%+]")
#: Words that stand before "at" in prose.
NOT_NAMES = frozenset("""me us you it him her them look looked looking found available hosted meet met only also online site
 live here there visit see and or is are was were be been page pages shop store office home""".split())
#: Single letters with a blank between all of them.
LETTERS = re.compile(r"(?<!\S)(?<!\s[A-Za-z0-9._%+-]\x20)(?:[A-Za-z0-9._%+-]\x20){2,}+@\x20(?:[A-Za-z0-9.-]\x20)++[A-Za-z](?!\S)")
SPELLED_IP = re.compile(rf"(?<![0-9.])[0-9]{{1,3}}(?:(?:\.|{around(DOT)})[0-9]{{1,3}}){{3}}(?![0-9])", re.I)
#: Four groups of one to three spelled digits with a dot, as a sign or a word, between them.
ONE_DIGIT = rf"(?:{NAME}|[0-9])"
GROUP = rf"{ONE_DIGIT}(?:[\x20-]{ONE_DIGIT}){{0,2}}"
NAMED_IP = re.compile(rf"(?<![^\W_])(?<![0-9]\.)(?:{GROUP})(?:(?:\x20?\.\x20?|{around(DOT)})(?:{GROUP})){{3}}(?![^\W_])", re.I)
HINT = re.compile(rf"[(\[{{<]\x20?(?:@|\.|{AT}|{DOT})\x20?[)\]}}>]|[\x20\t\n-](?:{DOT})[\x20\t\r\n-]|\x20@|@\x20|"
                  rf"[\x20\t\n-](?:{AT})[\x20\t\r\n-]{{1,4}}[A-Za-z0-9-]+\.[A-Za-z]", re.I)
#: Hints are looked at with so many characters on both sides, and as many more as an identifier may take.
REACH = 320
#: A word that no identifier takes up: plain letters, not the name of a digit or a sign.
PLAIN_WORD = re.compile(rf"(?!(?:{NAME}|{AT}|{DOT}|{PLUS})(?![^\W\d_]))[^\W\d_]{{2,}}[,;:!?]?", re.I)
TOKEN = re.compile(r"\S+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        total += x if i % 2 == 0 else x * 2 - 9 * (x > 4)
    return total % 10 == 0


def emails(text: str):
    """Leftmost matches without overlap: each sign takes the whole run of characters before it."""
    last = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and (c := text[start - 1]).isascii() and (c.isalnum() or c in "._%+-"):
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            last = m.end()
        at = text.find("@", max(at + 1, last))


def matches(text: str):
    """Base spans (kind number, start, end)."""
    for a, b in emails(text):
        yield 0, a, b
    if "." in text:
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
                yield 1, *m.span()
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = NOT_DIGITS.sub("", m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield 2, *m.span()
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(NOT_DIGITS.sub("", m.group())) <= 15:
                yield 3, *m.span()


def plain(token: str) -> bool:
    return token.isascii() and PLAIN_WORD.fullmatch(token) is not None


def windows(text: str) -> list[tuple[int, int]]:
    """Parts of the text that may hold disguised data; each ends, on either side, between two plain words."""
    places = odd_places(text)
    places += [m.start() for m in SPELLED_HINT.finditer(text)]
    places += [m.start() for m in HINT.finditer(text)]
    if not places:
        return []
    tokens = [m.span() for m in TOKEN.finditer(text)] or [(0, len(text))]
    starts = [a for a, _ in tokens]
    safe: dict[int, bool] = {}

    def is_plain(i: int) -> bool:
        if i not in safe:
            safe[i] = plain(text[slice(*tokens[i])])
        return safe[i]

    found: list[list[int]] = []
    for p in sorted(places):
        last = max(bisect_right(starts, p + REACH) - 1, 0)
        if found and last <= found[-1][1]:
            continue
        first = max(bisect_right(starts, p - REACH) - 1, 0)
        least = found[-1][1] + 1 if found else 0
        while first > least and not (is_plain(first) and is_plain(first - 1)):
            first -= 1
        while last + 1 < len(tokens) and not (is_plain(last) and is_plain(last + 1)):
            last += 1
        if found and first <= least:
            found[-1][1] = last
        else:
            found.append([first, last])
    return [(tokens[a][0], tokens[b][1]) for a, b in found]


def spelled_number(m: re.Match) -> str:
    if len(ONE_NAME.findall(m.group())) < 2:
        return m.group()
    return GAP_IN_NUMBER.sub("", ONE_NAME.sub(lambda x: DIGIT_NAMES[x.group().lower()], m.group()))


def host_of(text: str, first: int, end: int, worded: bool) -> tuple[int, str] | None:
    """Longest part of a chain of labels that is a host name, with at least one dot in words if asked for."""
    best, at, labels, words = None, first, [], False
    while at < end:
        dot = ANY_DOT.search(text, at, end)
        label = text[at:dot.start() if dot else end]
        if label.lower() in NO_LABELS:
            break
        labels.append(label)
        if len(labels) > 1 and TOP_LABEL.fullmatch(label) and (words or not worded):
            best = at + len(label), ".".join(labels)
        if not dot:
            break
        words |= WORD_DOT.match(text, dot.start()) is not None
        at = dot.end()
    return best


def addresses(text: str, local: re.Pattern, sign: re.Pattern, host: re.Pattern, worded: bool, accept=None):
    """(start, end, address) of disguised addresses: a chain, a sign, a chain."""
    last = 0
    for m in local.finditer(text):
        at = sign.match(text, m.end()) if m.start() >= last else None
        right = host.match(text, at.end()) if at else None
        found = host_of(text, right.start(), right.end(), worded) if right else None
        if found and (accept is None or accept(m, found[1])):
            last = found[0]
            yield m.start(), last, ANY_DOT.sub(".", m.group()) + "@" + found[1]


def named(begins: bool):
    """Whether a plain chain before "at" is the name of a mailbox."""
    def accept(m: re.Match, host: str) -> bool:
        ahead = m.string[max(m.start() - 32, 0):m.start()]
        cue = BEFORE.search(ahead) or (begins and not m.string[:m.start()].strip())
        name = m.group()
        return host.rsplit(".", 1)[1].lower() in TOPS and name.lower() not in NOT_NAMES and bool(
            cue or ODD_NAME.search(name))
    return accept


def named_ip(m: re.Match) -> str:
    """Spelled groups as numbers, if some digit was spelled."""
    if not ONE_NAME.search(m.group()):
        return m.group()
    groups = [ONE_NAME.sub(lambda x: DIGIT_NAMES[x.group().lower()], g) for g in ANY_DOT.sub(".", m.group()).split(".")]
    return ".".join(NOT_DIGITS.sub("", g) for g in groups)


def unmask(part: Mapped) -> Mapped:
    part = part.plain()
    part = part.rewrite(LETTERS, lambda m: m.group().replace(" ", ""))
    part = part.rewrite(NAMED_IP, named_ip)
    part = part.rewrite(SPELLED, spelled_number)
    part = part.rewrite(PLUS_NAME, lambda m: "+")
    part = part.rewrite(BRACKETED_AT, lambda m: "@")
    part = part.rewrite(BRACKETED_DOT, lambda m: ".")
    part = part.rewrite(SPELLED_IP, lambda m: ANY_DOT.sub(".", m.group()))
    for patterns in WORDS:
        part = part.replace(addresses(part.text, *patterns, True))
    begins = bool(len(part.starts)) and part.starts[0] == 0
    part = part.replace(addresses(part.text, PLAIN_CHAIN, WORD_AT, PLAIN_CHAIN, False, named(begins)))
    return part.replace(addresses(part.text, PLAIN_CHAIN, SPACED_AT, SPACED_HOST, False))


def find(text: str) -> tuple[list[tuple], list[tuple]]:
    """Base spans, and the further ones that the transducers uncover: (start, kind number, end), in order.

    A further span may hold base spans of its kind, which are then parts of a disguised one, but cuts none.
    """
    base = sorted((a, k, b) for k, a, b in matches(text))
    more = set()
    for first, last in windows(text):
        part = unmask(Mapped.of(text[first:last], first))
        for k, a, b in matches(part.text):
            start, end = part.source(a, b)
            if part.text[a:b] != text[start:end]:  # rewritten, so not a base match
                more.add((start, k, end))
    kept: list[tuple] = []
    for start, k, end in sorted(more, key=lambda s: (s[0], s[1], -s[2])):
        cuts = any(start < e and s < end and not (x == k and start <= s and e <= end) for s, x, e in base)
        if not cuts and not any(x == k and start < e and s < end for s, x, e in kept[-8:]):
            kept.append((start, k, end))
    return base, kept


def joined(spans: list[tuple]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


RESULT = pa.schema([("id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()),
                    ("spans", pa.string()), ("n_disguised", pa.int64())])


def scan(batches):
    for batch in batches:
        rows = []
        for text in batch.column("text").to_pylist():
            base, more = find(text or "")
            counts = [sum(k == n for _, k, _ in base) for n in range(len(KINDS))]
            rows.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + more), len(more)))
        yield to_batch(RESULT, batch.column("id"), *(list(c) for c in zip(*rows, strict=True)))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: the number of base spans of each kind, their digest, all spans, disguised ones.

    ``spans`` lists kind:start:end by start, then kind, in code points of the source. Disguised spans never touch base
    spans; base spans are never changed.

    Null and empty texts have no spans. Repeated rows and rows without an id are handled each by itself. An empty
    table gives an empty result; further columns are ignored.
    """
    return docs.select(row_key(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        scan, "id long, " + "".join(f"n_{k} long, " for k in KINDS) + "base_sha256 string, spans string, n_disguised long")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Digest of the search over ``documents``."""
    return personal_data(docs).withColumn("id", id_text("id")).withColumnRenamed("id", "doc_id")
