"""Personal data, also behind disguises, with spans in the source text.

Transducers rewrite a text and keep, for each character they give out, the source characters it stands for: look-alike
letters and full-width forms become ASCII and invisible signs go; spelled digits become digits; "at" and "dot" in
brackets, or as words inside what reads as an address, become their signs. Identifiers are looked for in the source
and in the rewritten text; spans of the latter are mapped back and added unless one of the former, of the same kind,
holds them whole.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import numbered, pieces, texts

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

#: Cyrillic and Greek letters that look like ASCII letters, in two equally long rows.
LOOK_ALIKES = dict(zip("аеорсухіјѕԁһАВЕКМНОРСТХІЈЅαορνικτΑΒΕΗΙΚΜΝΟΡΤΧΖ", "aeopcyxijsdhABEKMHOPCTXIJSaopvikTABEHIKMNOPTXZ"))
#: Characters that take no room on the page.
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
DIGITS = {w: str(i) for i, w in enumerate("zero one two three four five six seven eight nine".split())}
#: The digits in German, French and Spanish, zero first; read only three or more in a row, all in one language.
OTHER_DIGITS = (
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
)
#: Number words above nine, as the parts of an IP address may be spelled.
TEENS = {w: 10 + i for i, w in enumerate("ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split())}
TENS = {w: 10 * i for i, w in enumerate("twenty thirty forty fifty sixty seventy eighty ninety".split(), 2)}
#: Fixed values: "at" and "dot" as other languages say them.
OTHER_AT, OTHER_DOT = "arobase|arroba|klammeraffe|ät", "punkt|point|punto"
#: Words before a plain name that make "name at host.example" read as an address.
CUES = frozenset("email e-mail mail contact write reach to address from".split())

#: Endings that make bare words with "at" and "dot" read as an address whatever stands before.
ENDINGS = frozenset("com org net edu gov info biz io co uk de fr es it nl eu us ca au ch at be pl se no jp cn in br ru".split())
#: Words of plain prose that are no label or, unless listed above, no ending of a worded address.
PROSE = frozenset(
    "a an the this that these those each every any some all both one two of on or and as by to if so we he she you they them his her its "
    "our your their my is are was were been has had from for with than then when where who which what how into onto over under not but "
    "polka red blue green black white small big tiny single last first next "
    "product products matrix plot plots chart charts pattern patterns dress dresses notation point points size print prints line lines".split()
)
#: What no worded address has as a name or label before a dot.
ARTICLES = frozenset("a an the this that each every".split())
#: Hosts that give addresses to anyone, so that a plain word before a worded "at" reads as a name.
HOSTS = frozenset("gmail googlemail yahoo hotmail outlook icloud aol gmx proton protonmail fastmail yandex zoho".split())
#: Plain words before "at" that are no name, even before such a host.
NOT_NAMES = PROSE | frozenset("me us him it mail mails email emails look looks looking available contact reach account accounts address sign log here there down issues support work working works team".split())

_STRANGE = re.compile("[\u00ad\u0180-\u200f\u202a-\u20ab\u20ad-\U0010ffff]")
_EVERY_DIGIT = "|".join([*DIGITS, *OTHER_DIGITS]).replace(" ", "|")
_NUMBER = "|".join([*DIGITS, *TEENS, *TENS, "hundred", "and"])
_DIGIT = "(?:" + "|".join(DIGITS) + ")"
_SPELLED = re.compile(rf"(?i)\b{_DIGIT}(?:[ \t,-]++{_DIGIT}\b)*+(?![A-Za-z0-9_])")
_ONE = re.compile(rf"(?i){_DIGIT}")
_BLANKS = r"(?<![ \t])[ \t]++"  # of any length, tried from its first blank only, so that long runs take linear time
_GAP = r"(?:[ \t-]++|[.]|[ \t]?[()][ \t]?)"
_DIGIT_AFTER = re.compile(rf"{_GAP}[0-9]")
_BRACKETED = re.compile(rf"(?i)(?:{_BLANKS})?[\[({{<][ \t]*+(?:(?P<at>at|@|{OTHER_AT})|dot|[.]|{OTHER_DOT})[ \t]*+[\])}}>][ \t]*+")
_OTHERS = [(re.compile(rf"(?i)\b(?:{w})(?:[ \t,-]++(?:{w})\b){{2,}}(?![\w])"), re.compile(rf"(?i){w}"), {x: str(i) for i, x in enumerate(w.split("|"))}) for w in (x.replace(" ", "|") for x in OTHER_DIGITS)]
_PLUS = re.compile(rf"(?i)\bplus[ \t]+(?=[0-9]|(?:{_EVERY_DIGIT})\b)")
_OTHER_PARTS = "|".join(rf"(?:{w})\b(?:[ \t-]++(?:{w})\b)*+" for w in (x.replace(" ", "|") for x in OTHER_DIGITS))
_PART = rf"(?:[0-9]++|(?:{_NUMBER})\b(?:[ \t-]++(?:{_NUMBER})\b)*+|{_OTHER_PARTS})"
_IP_PART = re.compile(rf"(?i)(?<![\w.]){_PART}(?![\w])")
_ANY_DOT = re.compile(rf"(?i){_BLANKS}(?:dot|{OTHER_DOT})[ \t]++")
_OTHER_AT = re.compile(rf"(?i)(?<=[A-Za-z0-9_%+-])[ \t]++(?:at|{OTHER_AT})[ \t]++(?=[A-Za-z0-9])")
_OTHER_RIGHT = re.compile(rf"(?i)[A-Za-z0-9-]++(?:(?:\.|[ \t]++(?:dot|{OTHER_DOT})[ \t]++)[A-Za-z0-9-]++)+")
_AT = re.compile(r"(?i)(?<=[A-Za-z0-9_%+-])[ \t]++at[ \t]++(?=[A-Za-z0-9])|@")
_RIGHT = re.compile(r"(?i)[A-Za-z0-9-]++(?:(?:\.|[ \t]++dot[ \t]++)[A-Za-z0-9-]++)+")
_DOT = re.compile(rf"(?i){_BLANKS}dot[ \t]+")
_SPACED = re.compile(rf"(?<=[A-Za-z0-9_%+-])[ \t]++@[ \t]*+(?=[A-Za-z0-9])|(?<=[A-Za-z0-9_%+-])@[ \t]++(?=[A-Za-z0-9])")
_SPACED_DOT = re.compile(r"(?<![ \t])[ \t]*+\.[ \t]*+")
_SPACED_RIGHT = re.compile(r"[A-Za-z0-9-]++(?:[ \t]*+\.[ \t]*+[A-Za-z0-9-]++)*?[ \t]*+\.[ \t]*+(?:com|org|net|edu|gov|info|biz|io)(?![A-Za-z0-9-])")
_LABEL = re.compile(r"(?i)(?:(?P<word>[ \t]+dot[ \t]+)|\.)?(?P<label>[A-Za-z0-9-]+)")
_ENDING = re.compile(r"[A-Za-z]{2,}")
_SIGNED = re.compile(r"[A-Za-z][A-Za-z0-9]*(?:[._+%][A-Za-z0-9]+){1,2}|[A-Za-z]{3,}[0-9]+")
_HINT_GAP = _GAP.replace("++", "+")  # the engine that looks through batches knows no possessive repeats
#: What a text with a disguise holds; plain enough to be looked for in a whole batch of texts at once.
_HINT = (
    rf"[ \t]@|@[ \t]|\b(?:dot|at|{OTHER_DOT})[ \t]*[\])}}>]|[\[({{<][ \t]*[.@][ \t]*[\])}}>]|\b(?:{OTHER_AT})\b|[ \t](?:dot|{OTHER_DOT})[ \t]|\bplus[ \t]|[ \t]at[ \t]+[a-z0-9-]+[.][a-z0-9]"
    rf"|\b(?:{_EVERY_DIGIT})[ \t,-]+(?:{_EVERY_DIGIT})[ \t,-]|\b{_DIGIT}{_HINT_GAP}[0-9]|[0-9]{_HINT_GAP}{_DIGIT}\b"
)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str):
    """Leftmost matches that don't overlap, found from each @ so that long runs without one cost nothing."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            yield "email", start, free
        at = text.find("@", max(at + 1, free))


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of all kinds in a text as it stands, by start and then kind."""
    out = list(emails(text))
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(int(x[-4:]) <= 255 and len(x.lstrip("0")) <= 3 for x in m.group().split("."))]
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 10 <= sum(map(str.isdigit, m.group())) <= 15]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


class Tape:
    """A text with, for each of its characters, where its source begins and ends."""

    def __init__(self, text: str):
        self.text, self.start, self.end = text, np.arange(len(text)), np.arange(1, len(text) + 1)

    def rewrite(self, changes: list[tuple[int, int, str]]) -> None:
        """Put each string in the place of a stretch; its characters stand for the whole stretch."""
        if not changes:
            return
        text, start, end, at = [], [], [], 0
        for i, j, new in changes:
            text += [self.text[at:i], new]
            start += [self.start[at:i], np.full(len(new), self.start[i])]
            end += [self.end[at:i], np.full(len(new), self.end[j - 1])]
            at = j
        self.text = "".join([*text, self.text[at:]])
        self.start, self.end = np.concatenate([*start, self.start[at:]]), np.concatenate([*end, self.end[at:]])


def fold(c: str) -> str:
    """The ASCII sign that a strange character looks like; nothing for invisible ones; itself otherwise."""
    if c in INVISIBLE:
        return ""
    plain = LOOK_ALIKES.get(c) or unicodedata.normalize("NFKC", c)
    if len(plain) == 1 and not plain.isascii() and plain.isdecimal():
        plain = str(unicodedata.decimal(plain))
    return plain if len(plain) == 1 and plain.isascii() else c


def left_of(text: str, end: int, low: int, dots: str) -> int:
    """Where the name before ``end`` begins, over any of the words ``dots`` between its parts; ``end`` if there is none.

    It walks back over the name alone, however long that is, and not before ``low``.
    """
    start = at = end
    while True:
        while start > low and text[start - 1] in _LOCAL:
            start -= 1
        if start == at:
            return end if at == end else before
        before = start
        blank = start
        while blank > low and text[blank - 1] in " \t":
            blank -= 1
        word = next((w for w in dots.split("|") if blank < start and text[max(low, blank - len(w)) : blank].lower() == w), None)
        at = blank - len(word) if word else start
        while word and at > low and text[at - 1] in " \t":
            at -= 1
        if not word or at == blank - len(word):
            return start
        start = at


def gap_before(text: str, i: int) -> int:
    """Where the gap before ``i`` begins that may stand between two digits of a number: blanks and hyphens, a dot or a bracket."""
    at = i
    while at and text[at - 1] in " \t-":
        at -= 1
    if at < i and not (at and i - at == 1 and text[at - 1] in "()"):
        return at
    if at and text[at - 1] == "." and at == i:
        return at - 1
    if at and text[at - 1] in "()":
        return at - 2 if at > 1 and text[at - 2] in " \t" else at - 1
    return at


def spelled(run: str) -> str:
    return "".join(DIGITS[m.group().lower()] for m in _ONE.finditer(run))


def spelled_runs(text: str) -> list[tuple[int, int, str]]:
    """Changes that give spelled digits as digits: three or more in a row, or fewer next to digits."""
    out, end = [], -1
    for m in _SPELLED.finditer(text):
        i, j = m.span()
        gap = gap_before(text, i)
        near = _DIGIT_AFTER.match(text, j) or gap < i and gap and text[gap - 1] in "0123456789"
        if near or end >= 0 and gap == end < i or len(_ONE.findall(m.group())) > 2:
            out.append((i, j, spelled(m.group())))
            end = j
    return out


def other_runs(text: str) -> list[tuple[int, int, str]]:
    """Changes that give digits spelled in another language as digits."""
    out = [(m.start(), m.end(), "".join(values[x.lower()] for x in one.findall(m.group()))) for run, one, values in _OTHERS for m in run.finditer(text)]
    out.sort()
    return [c for k, c in enumerate(out) if not k or c[0] >= out[k - 1][1]]


def part_of_ip(words: str) -> str:
    """One part of a spelled IP address: digits one by one, or a number up to 999 in words."""
    own = [w for w in re.split("[ \t-]+", words.lower()) if w != "and"]
    if words.isdigit():
        return words
    for _, _, values in _OTHERS:
        if all(w in values for w in own):
            return "".join(values[w] for w in own)
    if len(own) > 1 and all(w in DIGITS for w in own):
        return "".join(DIGITS[w] for w in own)
    total = 0
    for w in own:
        total = max(1, total) * 100 if w == "hundred" else total + (int(DIGITS[w]) if w in DIGITS else TEENS.get(w) or TENS[w])
    return str(total)


def worded_ips(text: str) -> list[tuple[int, int, str]]:
    """Changes that give four numbers with the word "dot" between them as an address; numbers in words are found run by run."""
    out, chain = [], []
    for m in _IP_PART.finditer(text):
        dot = _ANY_DOT.match(text, chain[-1].end()) if chain else None
        chain = [*chain, m] if dot and dot.end() == m.start() else [m]
        if len(chain) == 4:
            out.append((chain[0].start(), m.end(), ".".join(part_of_ip(x.group()) for x in chain)))
            chain = []
    return out


def foreign(text: str) -> list[tuple[int, int, str]]:
    """Changes in addresses whose "at" or "dot" is said in another language; a plain "at" needs a known ending."""
    out, free = [], 0
    for at in _OTHER_AT.finditer(text):
        left, right = left_of(text, at.start(), free, f"dot|{OTHER_DOT}"), _OTHER_RIGHT.match(text, at.end())
        if left == at.start() or not right:
            continue
        last = re.split("[. \t]", right.group())[-1].lower()
        dots = [d for d in (*_ANY_DOT.finditer(text, left, at.start()), *_ANY_DOT.finditer(text, at.end(), right.end()))]
        known = last in ENDINGS and any(d.group().strip().lower() != "dot" for d in dots)
        if known or at.group().strip().lower() != "at" and _ENDING.fullmatch(last):
            out += sorted([(d.start(), d.end(), ".") for d in dots] + [(at.start(), at.end(), "@")])
            free = right.end()
    return out


def worded(text: str) -> list[tuple[int, int, str]]:
    """Changes that give the words "at" and "dot" as signs where they stand inside what reads as an address."""
    out, free = [], 0
    for at in _AT.finditer(text):
        if at.start() < free:
            continue
        left, right = left_of(text, at.start(), free, "dot"), _RIGHT.match(text, at.end())
        if left == at.start() or not right:
            continue
        labels = list(_LABEL.finditer(text, at.end(), right.end()))
        while len(labels) > 1:
            last = labels[-1]["label"].lower()
            if last in ENDINGS or (_ENDING.fullmatch(last) and last not in PROSE):
                break
            labels.pop()
        words = [m for m in labels if m["word"]]
        dots = list(_DOT.finditer(text, left, at.start()))
        names = _DOT.split(text[left : at.start()])
        while len(names) > 1 and any(n.lower() in ARTICLES for n in names[:-1]):
            names, dots = names[1:], dots[1:]
        sure = at.group() == "@" or any(m["label"].lower() in ENDINGS for m in labels[1:])
        if len(labels) < 2 or (words and any(m["label"].lower() in (ARTICLES if sure else PROSE) for m in labels[:-1])):
            continue
        if at.group() != "@":
            name = names[-1].lower()
            if words or dots:
                fits = sure or bool(dots) or name not in NOT_NAMES
            else:
                host = labels[-2]["label"].lower() in HOSTS and name not in NOT_NAMES
                cued = name not in NOT_NAMES and name.isalpha() and last_known(labels) and (cue_before(text, left) or text.strip() == text[left : labels[-1].end()])
                fits = (host or cued or bool(_SIGNED.fullmatch(name))) and text[labels[-1].end() : labels[-1].end() + 1] not in ("/", "(", "_", "@")
            if not fits:
                continue
        out += [(d.start(), d.end(), ".") for d in dots]
        if at.group() != "@":
            out.append((at.start(), at.end(), "@"))
        out += [(m.start("word"), m.end("word"), ".") for m in words]
        free = labels[-1].end()
    return out


def cue_before(text: str, i: int) -> bool:
    """Whether the word before ``i``, after any blanks of its line, is a cue."""
    while i and text[i - 1] in " \t":
        i -= 1
    words = text[max(0, i - 16) : i].rsplit("\n", 1)[-1].split()
    return bool(words) and words[-1].lower().rstrip(":") in CUES and text[i - 1] not in "\n\r"


def spaced(text: str) -> list[tuple[int, int, str]]:
    """Changes that close up an address with blanks around its sign or its dots, where it ends as none but addresses do."""
    out, free = [], 0
    for at in _SPACED.finditer(text):
        left, right = left_of(text, at.start(), free, "dot"), _SPACED_RIGHT.match(text, at.end())
        if left < at.start() and right:
            out.append((at.start(), at.end(), "@"))
            out += [(m.start(), m.end(), ".") for m in _SPACED_DOT.finditer(text, at.end(), right.end())]
            free = right.end()
    return out


def last_known(labels: list) -> bool:
    return labels[-1]["label"].lower() in ENDINGS


def hinted(texts: list[str]) -> list[bool]:
    """Which texts may hold words or signs to rewrite, once look-alike letters are folded."""
    return pc.match_substring_regex(pa.array(texts, pa.string()), _HINT, ignore_case=True).to_pylist()


def normalised(text: str, hint: bool) -> Tape | None:
    """The text without its disguises; None where there is nothing to rewrite."""
    strange = _STRANGE.search(text)
    if not strange and not hint:
        return None
    tape = Tape(text)
    if strange:
        tape.rewrite([(m.start(), m.end(), new) for m in _STRANGE.finditer(text) if (new := fold(m.group())) != m.group()])
    tape.rewrite([(m.start(), m.end(), "@" if m["at"] else ".") for m in _BRACKETED.finditer(tape.text)])
    tape.rewrite(worded_ips(tape.text))
    tape.rewrite([(m.start(), m.end(), "+") for m in _PLUS.finditer(tape.text)])
    tape.rewrite(other_runs(tape.text))
    tape.rewrite(spelled_runs(tape.text))
    tape.rewrite(spaced(tape.text))
    tape.rewrite(foreign(tape.text))
    tape.rewrite(worded(tape.text))
    return tape if tape.text != text else None


def all_spans(text: str, hint: bool | None = None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """The spans of the text as it stands, and all spans: those and the new ones behind disguises."""
    base = plain_spans(text)
    tape = normalised(text, hinted([text])[0] if hint is None else hint)
    if tape is None:
        return base, base
    more = []
    for kind, i, j in plain_spans(tape.text):
        a, b = int(tape.start[i]), int(tape.end[j - 1])
        if not any(k == kind and x <= a and b <= y for k, x, y in base):
            more.append((kind, a, b))
    return base, sorted(base + more, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span's kind in its place; of overlapping spans all characters go, under the first one's kind."""
    out, at = [], 0
    for kind, i, j in spans:
        if i >= at:
            out += [text[at:i], f"[{kind.upper()}]"]
        at = max(at, j)
    return "".join([*out, text[at:]])


def find_pii(docs: DataFrame, mask: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, base, spans`` (arrays of kind, start, end in code points, end exclusive) for every whole text.

    ``mask`` adds ``masked``, the text with its spans replaced. Null and empty texts have no spans; a null text stays
    null when masked. Repeated rows repeat, null ids stay null; other columns aren't read, whatever their names. No documents give no rows.
    """
    span = "array<struct<kind:string,start:bigint,end:bigint>>"
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for b in pieces(batches):
            own = texts(b)
            found = list(map(all_spans, own, hinted(own)))
            lists = [pa.array([[dict(zip(("kind", "start", "end"), s)) for s in f[k]] for f in found], kind) for k in (0, 1)]
            columns, names = [b.column("doc_id"), *lists], ["doc_id", "base", "spans"]
            if mask:
                columns.append(pa.array([x if x is None else masked(x, f[1]) for x, f in zip(b.column("text").to_pylist(), found)], pa.string()))
                names.append("masked")
            yield pa.RecordBatch.from_arrays(columns, names)

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, f"doc_id long, base {span}, spans {span}" + ", masked string" * mask)


def mask_column(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows, all other columns as they are, whatever their names, with the spans of their text masked.

    Null stays null and an empty text empty; repeated rows repeat; of an empty table nothing comes.
    """

    plain, schema = numbered(docs)
    k = docs.columns.index(text_col)

    def run(batches):
        for b in pieces(batches, name=f"c{k}"):
            own = b.column(k).to_pylist()
            new = [x if not x else masked(x, all_spans(x, h)[1]) for x, h in zip(own, hinted([x or "" for x in own]))]
            yield b.set_column(k, b.schema.field(k), pa.array(new, b.schema.field(k).type))

    return plain.mapInArrow(run, schema).toDF(*docs.columns)
