"""Personal data in texts, also in disguise, with offsets into the text as it is.

Plain identifiers are found by pattern. For the disguised ones, three transducers rewrite the text one after another: characters
that look like others (other widths and scripts, O for 0 among digits), digits spelled as words, and the words or
brackets that stand for @ and for a dot. Each keeps what it replaced, so the span of an identifier in the last text is mapped
back, step by step, to the characters of the first.
"""

import hashlib
import re
import unicodedata
from bisect import bisect_left, bisect_right
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ratecal.llm import chars

KINDS = ("email", "ip", "card", "phone")

# Digits from 0 to 9 as words.
DIGITS = {
    "en": "zero one two three four five six seven eight nine",
    "de": "null eins zwei drei vier fünf sechs sieben acht neun",
    "es": "cero uno dos tres cuatro cinco seis siete ocho nueve",
    "fr": "zéro un deux trois quatre cinq six sept huit neuf",
}
# Letters of other scripts and the Latin letter that each looks like.
LOOKALIKES = {
    "аәӑ": "a", "еєё": "e", "оοσ": "o", "рρ": "p", "сϲ": "c", "уγ": "y", "хχ": "x", "іιї": "i", "ѕ": "s", "јϳ": "j", "ԁ": "d", "һ": "h",
    "к": "k", "м": "m", "т": "t", "в": "b", "α": "a", "ν": "v", "ո": "n", "ս": "u", "ɡ": "g", "ӏ": "l", "ԛ": "q", "ԝ": "w", "п": "n",
    "АΑ": "A", "ВΒ": "B", "ЕΕ": "E", "НΗ": "H", "ІΙ": "I", "ЈͿ": "J", "КΚ": "K", "МΜ": "M", "Ν": "N", "ОΟ": "O", "РΡ": "P", "ТΤ": "T",
    "ХΧ": "X", "УΥ": "Y", "ЅՏ": "S", "СϹ": "C", "Ζ": "Z",
    "‐‑‒–—―−": "-", "。․﹒": ".", "﹫": "@", "﹢": "+",
}
# Last labels that make a domain of spelled dots likely; those that are words of prose are left out.
ENDINGS = "com org net edu gov mil int info biz io dev app ai co uk eu de fr es ch ca au jp cn ru br nl se pl pt tv xyz online site test example local".split()

IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")


def emails(text):
    """Spans of `[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`. Only the characters around an @ are looked at, so long
    runs without one take no longer than others."""
    last = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            last = domain.end()
        at = text.find("@", max(at + 1, last))


def ips(text):
    """Spans of four numbers up to 255 between dots."""
    for m in IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (p.lstrip("0") for p in m[0].split("."))):
            yield m.span()


def luhn(digits):
    """Whether the check digit of a card number is right."""
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _only_digits(part):
    return part.replace(" ", "").replace("-", "")


def cards(text):
    """Spans of 16 to 19 digits, single blanks or hyphens between them, with a right check digit."""
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(digits := _only_digits(m[0])) <= 19 and luhn(digits):
            yield m.span()


def phones(text):
    """Spans of 8 to 15 digits after a plus."""
    for m in PHONE.finditer(text):
        if 8 <= sum(map(str.isdigit, m[0])) <= 15:
            yield m.span()


def base(text):
    """Spans of the plain identifiers, by kind."""
    return {"email": list(emails(text)), "ip": list(ips(text)), "card": list(cards(text)), "phone": list(phones(text))}


def cards_within(text):
    """Card numbers in runs of digits that are too long or wrong as a whole: consecutive groups of four or more digits, the
    longest from the left."""
    for m in CARD.finditer(text):
        if m.end() - m.start() < 16:
            continue
        groups = [(m.start() + g.start(), m.start() + g.end()) for g in re.finditer("[0-9]+", m[0])]
        i = 0
        while i < len(groups):
            found = None
            size, digits = 0, ""
            for j in range(i, len(groups)):
                a, b = groups[j]
                if b - a < 4 or (size := size + b - a) > 19:
                    break
                digits += text[a:b]
                if size >= 16 and luhn(digits):
                    found = j
            if found is None:
                i += 1
            else:
                yield groups[i][0], groups[found][1]
                i = found + 1


def phones_within(text):
    """Phone numbers in front of further numbers: the most groups of digits that are a phone number together."""
    for m in PHONE.finditer(text):
        count, end = 0, None
        for g in re.finditer("[0-9]+", m[0]):
            count += g.end() - g.start()
            if count > 15:
                break
            if count >= 8:
                end = m.start() + g.end()
        if end:
            yield m.start(), end


class Tape:
    """A text after edits (start, stop, replacement) of another, in order; `back` maps spans to the other."""

    def __init__(self, text, edits):
        parts, last, size = [], 0, 0
        self.own, self.end, self.start, self.stop = [], [], [], []
        for a, b, new in edits:
            parts += [text[last:a], new]
            size += a - last
            self.own.append(size)
            size += len(new)
            self.end.append(size)
            self.start.append(a)
            self.stop.append(b)
            last = b
        self.text = "".join([*parts, text[last:]]) if edits else text

    def _first(self, at):
        """Start of what the character at `at` stands for."""
        k = bisect_right(self.end, at)  # the first edit that ends behind it
        if k < len(self.own) and self.own[k] <= at:
            return self.start[k]
        return at if not k else at - self.end[k - 1] + self.stop[k - 1]

    def back(self, start, stop):
        """The span of the source from the first character's source to the end of the last one's."""
        last = stop - 1
        k = bisect_right(self.end, last)
        if k < len(self.own) and self.own[k] <= last:
            return self._first(start), self.stop[k]
        return self._first(start), self._first(last) + 1


@lru_cache(maxsize=1)
def _folds():
    """What each character that is not ASCII stands for: the ASCII one of its compatibility form or of its decimal value,
    a letter that looks like it, a blank, or nothing."""
    table = {}
    for code in range(0x80, 0x20000):
        c = chr(code)
        kind = unicodedata.category(c)
        if kind == "Nd":
            table[c] = str(unicodedata.decimal(c))
        elif kind == "Zs":
            table[c] = " "
        elif kind == "Cf":
            table[c] = ""
        elif len(same := unicodedata.normalize("NFKC", c)) == 1 and 0x20 < ord(same) < 0x7F:
            table[c] = same
    for like, c in LOOKALIKES.items():
        table.update(dict.fromkeys(like, c))
    return table


# not ASCII, and neither a letter of the European languages nor one of the marks beside them
ODD = re.compile("[\u00a0\u00aa\u00ad\u00b2\u00b3\u00b9\u00ba\u0250-\U0010ffff]")


def fold(text):
    """Characters of other scripts and widths as the ASCII ones that they look like."""
    if text.isascii():
        return Tape(text, [])
    table = _folds()
    return Tape(text, [(m.start(), m.end(), table[m[0]]) for m in ODD.finditer(text) if m[0] in table])


# a number in which letters stand for digits: no other letters beside it, and digits prevail; or a first digit after a plus
MIXED = re.compile(r"(?<=\+)[Il|](?=[ (.-]{0,2}[0-9])|(?<![A-Za-z0-9])(?=[0-9OoIl|]*[0-9][OoIl|]|[OoIl|]+[0-9])[0-9OoIl|]+(?![A-Za-z0-9])")
_AS_DIGIT = {"O": "0", "o": "0", "I": "1", "l": "1", "|": "1"}


def digits_like(text):
    """O, o, I, l and | as digits in numbers."""
    edits = []
    for m in MIXED.finditer(text):
        wrong = [k for k in range(m.start(), m.end()) if text[k] in _AS_DIGIT]
        if 2 * len(wrong) <= m.end() - m.start() or text[m.start() - 1 : m.start()] == "+":
            edits += [(k, k + 1, _AS_DIGIT[text[k]]) for k in wrong]
    return Tape(text, edits)


_VALUE = {word: str(d) for words in DIGITS.values() for d, word in enumerate(words.split())}
_WORD = "|".join(sorted(_VALUE, key=len, reverse=True))
_GAP = r"(?:[ \t]{1,3}|[ \t]?[-,/_][ \t]?)"
SPELLED = re.compile(rf"(?<=[0-9][ -])oh(?=[ -][0-9])|(?<![^\W\d_])(?:plus{_GAP}?(?=[0-9(]|{_WORD})|(?:{_WORD})+(?![^\W\d_])(?:{_GAP}(?:(?:{_WORD})+|oh)(?![^\W\d_]))*)", re.I)
_PIECE = re.compile(rf"plus|oh|{_WORD}|[^\w]+|_", re.I)


def spelled(text):
    """Spelled digits as digits; consecutive ones become one number. `plus` in front of a digit is +."""
    edits = []
    for m in SPELLED.finditer(text):
        pieces = list(_PIECE.finditer(text, m.start(), m.end()))
        for k, p in enumerate(pieces):
            word = p[0].lower()
            if word == "plus":
                edits.append((*p.span(), "+"))
            elif word == "oh":
                edits.append((*p.span(), "0"))
            elif word in _VALUE:
                edits.append((*p.span(), _VALUE[word]))
            elif k:
                edits.append((*p.span(), ""))
    return Tape(text, edits)


_OPEN, _CLOSE = r"[\[({<]\s{0,2}", r"\s{0,2}[\])}>]"
_BRACKETED = rf"\s{{0,2}}{_OPEN}(?:dot|punkt|punto|point|\.){_CLOSE}\s{{0,2}}"
_BARE = r"\s{1,2}dot\s{1,2}|(?<=[A-Za-z0-9])[_-]dot[_-](?=[A-Za-z0-9])"
_DOT = rf"(?:\.|{_BRACKETED}|{_BARE})"
AT = re.compile(
    rf"@|(?P<box>\s{{0,2}}{_OPEN}(?:at|@|arroba){_CLOSE}\s{{0,2}})|(?<=[A-Za-z0-9])(?P<bare>\s{{1,2}}(?:at|arroba)\s{{1,2}}|[_-]at[_-])(?=[A-Za-z0-9])", re.I
)
HOST = re.compile(rf"[A-Za-z0-9](?:[A-Za-z0-9]|-(?!dot-))*(?:{_DOT}[A-Za-z0-9](?:[A-Za-z0-9]|-(?!dot-))*)+", re.I)
DISGUISED = re.compile(rf"{_BRACKETED}|{_BARE}", re.I)
DOT_BEFORE = re.compile(rf"(?:{_BRACKETED}|{_BARE})\Z", re.I)
BETWEEN_DIGITS = re.compile(rf"(?<=[0-9])(?:{_BRACKETED}|{_BARE})(?=[0-9])", re.I)


def _local(text, end):
    """Where the local part that ends at `end` begins, and the disguised dots in it."""
    dots, start = [], end
    while True:
        while start and text[start - 1] in LOCAL:
            start -= 1
        dot = DOT_BEFORE.search(text, max(0, start - 16), start) if start < end else None
        if not dot or not dot.start() or text[dot.start() - 1] not in LOCAL:
            return start, dots
        dots.append((*dot.span(), "."))
        start = dot.start()


def at_and_dot(text):
    """Words and brackets for @ and dots: between the parts of what is an address then, and dots between digits. A bare
    `at` in prose is no sign: the domain must end in one of ENDINGS and have a spelled dot, or the local part a digit or mark."""
    edits = {(a, b): (a, b, ".") for a, b in (m.span() for m in BETWEEN_DIGITS.finditer(text))}
    done = 0
    for m in AT.finditer(text):
        a, b = m.span()
        if m[0] == "@":
            while a > done and text[a - 1] == " " and m.start() - a < 2:
                a -= 1
            while text[b : b + 1] == " " and b - m.end() < 2:
                b += 1
        host = HOST.match(text, b) if a >= done and a else None
        if not host or text[a - 1] not in LOCAL:
            continue
        start, dots = _local(text, a)
        domain = [(host.start() + d.start(), host.start() + d.end(), ".") for d in DISGUISED.finditer(host[0])]
        plain = (a, b) == m.span() and m[0] == "@"
        likely = re.split(r"[^A-Za-z0-9]+", host[0])[-1].lower() in ENDINGS
        marked = any(not c.isalpha() for c in text[start:a])
        if plain and not domain and not dots:
            continue
        if not plain and not m["box"] and not (likely and (domain or marked or m[0] == "@")):
            continue
        if m["box"] and not likely and not (domain or marked):
            continue
        for e in (*dots, (a, b, "@"), *domain):
            edits[e[:2]] = e
        done = host.end()
    out, last = [], 0
    for e in sorted(edits.values()):
        if e[0] >= last:
            out.append(e)
            last = e[1]
    return Tape(text, out)


STEPS = (fold, digits_like, spelled, at_and_dot)
_SIGN = re.compile("[0-9@]")


def added(text, plain):
    """Spans of identifiers that only the rewritten text shows, by kind, in characters of `text`; those within a plain one
    of the kind, or across the end of one, and repeats of a single digit, are left out."""
    tapes, now = [], text
    for step in STEPS:
        tape = step(now)
        if tape.own:
            tapes.append(tape)
            now = tape.text
    out = {kind: [] for kind in KINDS}
    if not _SIGN.search(now):
        return out
    found = base(now) if tapes else plain
    found = {**found, "card": [*found["card"], *cards_within(now)], "phone": [*found["phone"], *phones_within(now)]}
    for kind, spans in found.items():
        held = sorted(plain[kind])
        starts, stops = [a for a, _ in held], [b for _, b in held]
        mapped = set()
        for a, b in spans:
            if kind == "card" and len(set(_only_digits(now[a:b]))) == 1:
                continue  # words such as null, said again and again
            for tape in reversed(tapes):
                a, b = tape.back(a, b)
            mapped.add((a, b))
        for a, b in sorted(mapped):
            i, j = bisect_right(stops, a), bisect_left(starts, b)  # the plain ones that it touches are i to j
            if i >= j or (a <= starts[i] and b >= stops[j - 1] and (a, b) != held[i]):
                out[kind].append((a, b))
    return out


def spans_text(found):
    return ",".join(f"{kind}:{a}:{b}" for kind in KINDS for a, b in sorted(set(found[kind])))


def scan(text):
    """Plain spans, and all spans, of each kind."""
    plain = base(text)
    more = added(text, plain)
    return plain, {kind: sorted({*plain[kind], *more[kind]}) for kind in KINDS}


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (plain identifiers), base_sha256 (of the plain spans), spans (all of them) for
    each row of `docs`; spans are kind:start:end in code points, end exclusive. NULL is an empty text. Rows stay as
    they are, repeated ones and those without an id too. One pass, no shuffle."""
    counts = [T.StructField(f"n_{kind}", T.LongType()) for kind in KINDS]
    fields = [*counts, T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]

    def run(texts):
        both = [scan(t) for t in texts]
        sha = [hashlib.sha256(spans_text(plain).encode()).hexdigest() for plain, _ in both]
        return [*[[len(plain[kind]) for plain, _ in both] for kind in KINDS], sha, [spans_text(every) for _, every in both]]

    return chars.add_columns(docs.select("doc_id", "text"), "text", fields, run).drop("text")


def masked(text, every):
    """`text` with every span replaced by its kind in brackets; spans that overlap become one, named by the first."""
    parts, last = [], 0
    for a, b, kind in sorted((a, b, kind) for kind in KINDS for a, b in every[kind]):
        if a >= last:
            parts += [text[last:a], f"[{kind}]"]
        last = max(last, b)
    return "".join([*parts, text[last:]])


def redacted(docs: DataFrame, name: str = "text") -> DataFrame:
    """`docs` with the text without personal data as column `name`, at the end; NULL becomes an empty text. All other
    columns stay as they are."""
    source = docs if name == "text" else docs.drop(name)
    inner = chars.free_name(source, "_redacted")
    marked = chars.add_columns(source, "text", [T.StructField(inner, T.StringType())], lambda texts: [[masked(t, scan(t)[1]) for t in texts]])
    kept = [f"`{c}`" for c in source.columns if c != name]
    return marked.selectExpr(*kept, f"`{inner}` AS `{name}`")
