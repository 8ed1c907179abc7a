"""Personal data, also when disguised, with spans in the source text.

Plain identifiers are found on the text as it stands. Disguised ones are found on a normalised copy
made by a chain of transducers - look-alike characters, spelled digits, "at"/"dot" spellings - each of
which keeps, for every character it writes, the source characters it stands for. A span found there
maps back to the source; it is added if it holds at least one rewritten character and doesn't overlap a
plain span of its kind.

Edge cases: a null text counts as empty and has no spans; null and repeated ids are handled row by
row; offsets are code points, ends exclusive; extra columns are never read by ``spans``, and
``redact`` hands them through as they are. Patterns run in linear time on texts of any length.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tokloom.llm import bytetext as B
from tokloom.llm.common import named_rows

KINDS = ("email", "ip", "card", "phone")
#: Bytes of text that are worked on at once; hashing its words takes some fifty times as many for a moment.
SLICE_BYTES = 1 << 20

_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]*+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# a run of digits is tried from its first digit only: later starts fail in the same place
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

Span = tuple[int, int]


def emails(text: str) -> list[Span]:
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at - _LOCAL_END.match(text[done:at][::-1]).end()
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end()))
            done = domain.end()
        else:
            done = at + 1  # the sign is in neither part, so nothing before it can matter any more
        at = text.find("@", done)
    return found


def _small(part: str) -> bool:
    digits = part.lstrip(".0")
    return len(digits) < 3 or len(digits) == 3 and int(digits) <= 255


def ips(text: str) -> list[Span]:
    return [m.span() for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def cards(text: str) -> list[Span]:
    return [m.span() for m in _CARD.finditer(text)
            if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d)]


def phones(text: str) -> list[Span]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]


def plain_spans(text: str) -> dict[str, list[Span]]:
    digit = _DIGIT.search(text) is not None
    return {"email": emails(text), "ip": ips(text) if digit else [],
            "card": cards(text) if digit else [], "phone": phones(text) if digit else []}


# --- transducers ------------------------------------------------------------------------------

#: Letters of other scripts that look like a Latin one (fixed values).
LOOK_ALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j",
    "ѕ": "s", "ԁ": "d", "һ": "h", "ӏ": "l", "ԛ": "q", "ԝ": "w", "А": "A", "В": "B", "Е": "E",
    "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "І": "I",
    "ο": "o", "α": "a", "ν": "v", "ρ": "p", "ι": "i", "κ": "k", "Α": "A", "Β": "B", "Ε": "E",
    "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Χ": "X",
    "ı": "i", "ɡ": "g", "。": ".", "․": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-",
    "−": "-",
}
#: Characters that are not seen and are left out (fixed values).
UNSEEN = "​‌‍⁠﻿­"
#: Ranges in which a character of one-character ASCII compatibility form is replaced by that form.
_FORMS = [(0x00A0, 0x00A0), (0x2000, 0x200A), (0x2070, 0x209C), (0x2460, 0x2468), (0xFE50, 0xFE6B),
          (0xFF01, 0xFF5E), (0x1D400, 0x1D7FF), (0x202F, 0x202F), (0x3000, 0x3000)]


def _char_table() -> dict[int, str]:
    out = {ord(k): v for k, v in LOOK_ALIKES.items()} | {ord(c): "" for c in UNSEEN}
    for lo, hi in _FORMS:
        for c in range(lo, hi + 1):
            form = unicodedata.normalize("NFKC", chr(c))
            if len(form) == 1 and form.isascii():
                out[c] = form
    for c in range(0x0600, 0x1E960):
        if unicodedata.category(chr(c)) == "Nd":
            out[c] = str(unicodedata.decimal(chr(c)))
    return out


_CHARS = _char_table()
_ODD = re.compile("[" + "".join(map(re.escape, map(chr, sorted(_CHARS)))) + "]")

#: Digit words of English, German, French and Spanish, zero to nine (fixed values).
DIGIT_WORDS = (
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
)
_VALUE = {w: str(i) for line in DIGIT_WORDS for i, w in enumerate(line.split())}
_TIMES = {"double": 2, "triple": 3}
_SIGNS = {"dot": ".", "point": ".", "punkt": ".", "punto": ".", "plus": "+", "dash": "-", "minus": "-",
          "hyphen": "-"}
_WORD = "|".join(sorted({*_VALUE}, key=len, reverse=True))
_GAP = r"[\x20\t,;_/-]{1,3}"
#: A number told in words: at least three digit words, with signs and written digits between them.
_TOLD = re.compile(
    rf"(?<!\w)(?:plus{_GAP})?(?:(?:double|triple){_GAP})?(?:{_WORD}|[0-9]+)"
    rf"(?:{_GAP}(?:(?:dot|point|punkt|punto|dash|minus|hyphen){_GAP})?(?:(?:double|triple){_GAP})?"
    rf"(?:{_WORD}|[0-9]+)(?!\w))+", re.IGNORECASE)
_PART = re.compile(r"\w+")

_OPEN, _CLOSE = r"\s{0,2}[\[({<]\s{0,2}", r"\s{0,2}[\])}>]\s{0,2}"
_AT_SIGN = rf"(?:{_OPEN}(?:at|@|arroba){_CLOSE})"
_DOT_SIGN = rf"(?:{_OPEN}(?:dot|\.|punkt|punto|point){_CLOSE})"
_AT_WORD = r"(?:\s{1,2}(?:at|arroba)\s{1,2}|_at_)"
_DOT_WORD = r"(?:\s{1,2}(?:dot|punkt|punto|point)\s{1,2}|_dot_)"
_ANY_DOT = rf"(?:{_DOT_SIGN}|{_DOT_WORD}|\.)"
#: A told address: its sign is in brackets, or a plain word followed by a disguised dot.
_ADDRESS = re.compile(
    rf"(?<![A-Za-z0-9%+-])[A-Za-z0-9%+-]+(?:{_ANY_DOT}[A-Za-z0-9%+-]+){{0,4}}?"
    rf"(?:(?P<sign>{_AT_SIGN}|@)|(?P<word>{_AT_WORD}))"
    rf"[A-Za-z0-9-]+(?:(?:(?P<dot>{_DOT_SIGN}|{_DOT_WORD})|\.)[A-Za-z0-9-]+)+", re.IGNORECASE)
_QUAD = re.compile(rf"(?<![0-9])[0-9]{{1,3}}(?:{_ANY_DOT}[0-9]{{1,3}}){{3}}(?![0-9])", re.IGNORECASE)
_AT_ANY = re.compile(rf"{_AT_SIGN}|{_AT_WORD}", re.IGNORECASE)
_DOT_ANY = re.compile(rf"{_DOT_SIGN}|{_DOT_WORD}", re.IGNORECASE)
_BRACKETED = re.compile(r"[\[({<]\s{0,2}(?:at|@|arroba|dot|\.|punkt|punto|point)\s{0,2}[\])}>]",
                        re.IGNORECASE)


def _hashes_of(words) -> np.ndarray:
    cased = sorted({v for w in words for v in (w, w.replace("ü", "Ü").replace("é", "É"))})
    return np.array([B.run_hashes(*_one(w.encode()))[0] for w in cased])


def _one(raw: bytes):
    return np.frombuffer(raw, np.uint8), np.array([0]), np.array([len(raw)])


_VALUE_HASHES = _hashes_of(_VALUE)
_CHAIN_HASHES = _hashes_of([*_SIGNS, *_TIMES])
_DOT_HASHES = _hashes_of(["dot", "punkt", "punto", "point"])
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_IS_DIGIT = np.zeros(256, bool)
_IS_DIGIT[48:58] = True
_IS_OPEN = np.zeros(256, bool)
_IS_OPEN[list(b"[({<")] = True


def hints(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: can it hold a character to replace, a told number, a told sign? Only a false no would
    matter, so each test asks for less than its transducer: a character from U+0100 on or a
    no-break space or soft hyphen; three neighbouring words of a told number; a word for the dot or an opening bracket."""
    raw, starts = B.flat(text)
    raw = B.LOWER[raw]
    begin, end, first = B.runs(_IN_WORD[raw], starts)
    h = B.run_hashes(raw, begin, end)

    def per_text(flags, bounds, least=1):
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[bounds[1:]] - total[bounds[:-1]] >= least

    odd = raw >= 0xC4
    odd[:-1] |= (raw[:-1] == 0xC2) & np.isin(raw[1:], (0xA0, 0xAD, 0xB2, 0xB3, 0xB9))
    sign = per_text(np.isin(h, _DOT_HASHES), first) | per_text(_IS_OPEN[raw], starts)
    value = np.isin(h, _VALUE_HASHES)
    chain = value | np.isin(h, _CHAIN_HASHES) | _IS_DIGIT[raw[begin]] if len(h) else value
    told = np.zeros(len(h), bool)
    told[:-2] = chain[:-2] & chain[1:-1] & chain[2:] & (value[:-2] | value[1:-1] | value[2:])
    return per_text(odd, starts), per_text(told, first), sign


Edit = tuple[int, int, str]


class Tracked:
    """A text with, for each character, the source span that it stands for."""

    def __init__(self, text: str):
        self.text, self.start, self.end = text, range(len(text)), range(1, len(text) + 1)
        self.edited: list[Span] = []

    def rewrite(self, edits: list[Edit]) -> None:
        """Replace disjoint ascending spans; each new character stands for its whole old span."""
        if not edits:
            return
        text, start, end, at = [], [], [], 0
        for lo, hi, new in edits:
            text += [self.text[at:lo], new]
            start += self.start[at:lo]
            end += self.end[at:lo]
            start += [self.start[lo]] * len(new)
            end += [self.end[hi - 1]] * len(new)
            self.edited.append((self.start[lo], self.end[hi - 1]))
            at = hi
        text.append(self.text[at:])
        start += self.start[at:]
        end += self.end[at:]
        self.text, self.start, self.end = "".join(text), start, end


def _char_edits(text: str) -> list[Edit]:
    return [(m.start(), m.end(), _CHARS[ord(m[0])]) for m in _ODD.finditer(text)]


def _digit_edits(text: str) -> list[Edit]:
    out = []
    for m in _TOLD.finditer(text):
        parts = [p[0].lower() for p in _PART.finditer(m[0])]
        if sum(p in _VALUE for p in parts) < 3:
            continue
        times, at = 1, m.start()
        edits = []
        for p in _PART.finditer(m[0]):
            word = p[0].lower()
            if word in _TIMES:
                times = _TIMES[word]
                continue
            new = _SIGNS.get(word) or _VALUE.get(word, word) * times
            edits.append((at, m.start() + p.end(), new))
            times, at = 1, m.start() + p.end()
        out += edits
    return out


def _sign_edits(text: str) -> list[Edit]:
    out: list[Edit] = []
    for m in _ADDRESS.finditer(text):
        if m["sign"] is None and m["dot"] is None:
            continue
        out += [(m.start() + a.start(), m.start() + a.end(), "@") for a in _AT_ANY.finditer(m[0])]
        out += [(m.start() + d.start(), m.start() + d.end(), ".") for d in _DOT_ANY.finditer(m[0])]
    for m in _QUAD.finditer(text):
        out += [(m.start() + d.start(), m.start() + d.end(), ".") for d in _DOT_ANY.finditer(m[0])]
    out.sort()
    return [e for i, e in enumerate(out) if not i or e[0] >= out[i - 1][1]]


def normalised(text: str, odd: bool, number: bool, sign: bool) -> Tracked | None:
    """The text after all transducers that its hints allow; None when none of them changes it."""
    t = Tracked(text)
    if odd:
        t.rewrite(_char_edits(text))
        if t.edited:
            _, number, sign = (bool(x[0]) for x in hints(pa.array([t.text])))
    if number:
        t.rewrite(_digit_edits(t.text))
    if sign or number:
        t.rewrite(_sign_edits(t.text))
    return t if t.edited else None


def added_spans(text: str, plain: dict[str, list[Span]], *hint: bool) -> dict[str, list[Span]]:
    """Spans that only the normalised text shows."""
    out: dict[str, list[Span]] = {k: [] for k in KINDS}
    t = normalised(text, *hint)
    if t is None:
        return out
    edited, any_edit = sorted(t.edited), [lo for lo, _ in sorted(t.edited)]
    for kind, found in plain_spans(t.text).items():
        for lo, hi in found:
            span = (t.start[lo], max(t.end[lo:hi]))
            at = bisect.bisect_left(any_edit, span[0])
            if at < len(edited) and edited[at][0] < span[1] and not _overlaps(plain[kind], span):
                out[kind].append(span)
    return out


def _overlaps(spans: list[Span], span: Span) -> bool:
    """Does ``span`` share a character with one of these ascending disjoint spans?"""
    at = bisect.bisect_left(spans, (span[1],)) - 1
    return at >= 0 and spans[at][1] > span[0]


def told(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{k}:{lo}:{hi}" for k in KINDS for lo, hi in sorted(spans[k]))


def all_spans(column: pa.Array):
    """For each text in turn: the text (null as empty), its plain and its added spans."""
    for text, *hint in zip(column.to_pylist(), *hints(column)):
        plain = plain_spans(text or "")
        yield text or "", plain, added_spans(text or "", plain, *hint)


def redacted(text: str, plain: dict[str, list[Span]], added: dict[str, list[Span]]) -> str:
    """The text with every span replaced by its kind; overlapping spans become one, named by the first."""
    spans = sorted((lo, -hi, k) for k in KINDS for lo, hi in plain[k] + added[k])
    out, at = [], 0
    for lo, hi, kind in spans:
        if lo >= at:
            out += [text[at:lo], f"<{kind.upper()}>"]
        at = max(at, -hi)
    return "".join([*out, text[at:]]) if spans else text


def spans(docs: DataFrame) -> DataFrame:
    """(doc_id, n_<kind> and base_sha256 of the plain spans, spans with the added ones, n_added)."""
    def run(batches):
        for batch in batches:
            for part in B.slices(batch, "text", SLICE_BYTES):
                counts, digests, found, n_added = [], [], [], []
                for _, plain, added in all_spans(part.column("text")):
                    counts.append([len(plain[k]) for k in KINDS])
                    digests.append(hashlib.sha256(told(plain).encode()).hexdigest())
                    found.append(told({k: plain[k] + added[k] for k in KINDS}))
                    n_added.append(sum(map(len, added.values())))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(c, pa.int64()) for c in zip(*counts)),
                     pa.array(digests, pa.string()), pa.array(found, pa.string()),
                     pa.array(n_added, pa.int64())],
                    ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])

    return named_rows(docs, doc_id="long", text="string").mapInArrow(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
             "spans string, n_added long")


def redact(docs: DataFrame) -> DataFrame:
    """All rows and columns, with the spans in ``text`` replaced; null texts stay null.

    ``n_chars``, where there is one, is counted anew for the texts that changed.
    """
    names = docs.columns
    at, n = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(batches):
        for batch in batches:
            for part in B.slices(batch, "text", SLICE_BYTES):
                old = part.column(at).to_pylist()
                new = [None if t is None else redacted(*found)
                       for t, found in zip(old, all_spans(part.column(at)))]
                columns = part.columns
                columns[at] = pa.array(new, columns[at].type)
                if n is not None:
                    size = zip(columns[n].to_pylist(), old, new)
                    columns[n] = pa.array([k if a == b else len(b) for k, a, b in size],
                                          columns[n].type)
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return docs.mapInArrow(run, docs.schema)
