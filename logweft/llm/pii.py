"""Personal data under disguise, found in a normalised text and reported where it stands in the source.

Three transducers rewrite a text in turn, and each remembers which characters of its input every stretch of its
output came from: look-alike and invisible characters; digits spelled as words; at and dot written as words or in
brackets.  The detectors (email, ip, card, phone) run over the source, which gives the base spans, and over the
rewritten text; a find there that rests on something rewritten is mapped back through the three and added, unless
it overlaps a base span of its kind.  Positions are code points, ends exclusive.

All detectors take time in proportion to the text, also for long runs of digits, signs or letters that come to
nothing.  A row is handled where it lies, whole, with no shuffle.

Defined cases: a null text is empty; an empty text has no spans; overlapping spans of several kinds are all
reported, and become one mark when masked; repeated rows are alike; other columns are kept, except one named like
the added one, which is replaced.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The kinds, in the order in which spans with the same start are listed.
KINDS = ("email", "ip", "card", "phone")

# --- detectors ---------------------------------------------------------------------------------------------

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DOUBLED = [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of a local part, @ and a domain with a dot; looked up from each @ to both sides."""
    free, at = 0, text.find("@")
    while at >= 0:
        before = text[free:at]
        local = len(before) - len(before.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if local else None
        if domain:
            yield at - local, domain.end()
        # No match reaches over an @, so what lies before this one is settled.
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
            yield m.span()


def luhn(digits: str) -> bool:
    """The check digit of a card number."""
    total = sum(map(int, digits[-1::-2])) + sum(_DOUBLED[int(d)] for d in digits[-2::-2])
    return total % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if 14 <= m.end() - m.start() <= 37:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            yield m.span()


DETECTORS: dict[str, Callable[[str], Iterator[tuple[int, int]]]] = {"email": emails, "ip": ips, "card": cards, "phone": phones}


def detect(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind index, end)`` of all finds, in order."""
    return sorted((s, k, e) for k, kind in enumerate(KINDS) for s, e in DETECTORS[kind](text))


# --- transducers -------------------------------------------------------------------------------------------


class Rewritten:
    """A text after some stretches were replaced, with the way back."""

    def __init__(self, source: str, edits: list[tuple[int, int, str]]):
        """``edits``: start, end and replacement of stretches that do not overlap, in order."""
        out, at, place = [], 0, 0
        self.begins, self.sources, self.lengths = [0], [0], [0]
        self.edits = []
        for start, end, new in edits:
            out += [source[at:start], new]
            place += start - at
            self.edits.append((place, place + len(new), start, end))
            place += len(new)
            at = end
        out.append(source[at:])
        self.text = "".join(out)
        self.starts = [e[0] for e in self.edits]

    def touches(self, start: int, end: int) -> bool:
        """Whether something in ``[start, end)``, or removed inside it, was rewritten."""
        at = bisect_right(self.starts, end - 1) - 1
        return at >= 0 and (self.edits[at][1] > start or self.edits[at][0] > start)

    def back(self, start: int, end: int) -> tuple[int, int]:
        """The source stretch that ``[start, end)`` came from; a replaced stretch counts whole."""
        return self._back(start, 0), self._back(end - 1, 1)

    def _back(self, place: int, last: int) -> int:
        at = bisect_right(self.starts, place) - 1
        if at < 0:
            return place + last
        _, end, source, source_end = self.edits[at]
        if place < end:
            return source_end if last else source
        return source_end + place - end + last


# Letters of other scripts that look like Latin ones.
LOOKALIKES = dict(zip(
    "авеёкмнорстухіјѕԁһԛԝАВЕЁКМНОРСТУХІЈЅαβεικνορτυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ。٠",
    "abeekmhopctyxijsdhqwABEEKMHOPCTYXIJSaBeikvoptuxABEZHIKMNOPTYX.0", strict=True))
LOOKALIKES |= dict.fromkeys("\u2010\u2011\u2012\u2013\u2014\u2015\u2212", "-")
_BEYOND = re.compile(r"[^\x00-\x7f]")
INVISIBLE = "­​‌‍⁠﻿"

# The digits' names in the languages of the texts.
DIGIT_WORDS = {
    **dict(zip("zero one two three four five six seven eight nine".split(), "0123456789", strict=True)),
    **dict(zip("null eins zwei drei vier fünf sechs sieben acht neun".split(), "0123456789", strict=True)),
    **dict(zip("zéro un deux trois quatre cinq six sept huit neuf".split(), "0123456789", strict=True)),
    **dict(zip("cero uno dos tres cuatro cinco seis siete ocho nueve".split(), "0123456789", strict=True)),
}
_NAME = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_DOT = r"(?:dot|punkt|point|punto)"
#: At least three names in a row, with digits and dots between them; a leading plus may be a word.
_SPELLED = re.compile(
    rf"(?<!\w)(?:(?P<plus>plus)[ -])?(?:{_NAME})(?:[ -]{{1,3}}(?:{_DOT} )?(?:(?:{_NAME})(?!\w)|[0-9]++(?!\w))){{2,}}+",
    re.IGNORECASE)
_PART = re.compile(rf"{_NAME}|{_DOT}|[0-9]+", re.IGNORECASE)
_NAMES = frozenset(DIGIT_WORDS)
# The names of the sign @, words that stand before a plain "at", and endings of domains.  Endings that
# source files have too (py, rs, sh, md, cc, so, ps) are left out: "error at main.py".
_AT = r"(?:at|arroba|arobase|arobas|arrobase|klammeraffe)"
_PROSE = frozenset(
    "a an and are available be been found he her here him hosted i is it live look looked looking looks me more not or "
    "see seen she site that the them there they this us visit was we were you".split())
ENDINGS = frozenset(
    "com org net edu gov mil int info biz name pro mobi museum aero coop jobs travel cat asia post tel app dev cloud online "
    "site store shop tech blog xyz email example invalid test "
    "ac ad ae af ag ai al am ao aq ar as at au aw ax az ba bb bd be bf bg bh bi bj bm bn bo br bs bt bw by bz ca cd cf cg "
    "ch ci ck cl cm cn co cr cu cv cw cx cy cz de dj dk dm do dz ec ee eg er es et eu fi fj fk fm fo fr ga gd ge gf gg gh "
    "gi gl gm gn gp gq gr gs gt gu gw gy hk hm hn hr ht hu id ie il im in io iq ir is it je jm jo jp ke kg kh ki km kn kp "
    "kr kw ky kz la lb lc li lk lr ls lt lu lv ly ma mc me mg mh mk ml mm mn mo mp mq mr ms mt mu mv mw mx my mz na nc ne "
    "nf ng ni nl no np nr nu nz om pa pe pf pg ph pk pl pm pn pr pt pw qa re ro ru rw sa sb sc sd se sg si sk sl sm sn "
    "sr ss st su sv sx sy sz tc td tf tg th tj tk tl tm tn to tr tt tv tw tz ua ug uk us uy uz va vc ve vg vi vn vu wf ws "
    "ye yt za zm zw".split())
_BRACKETED = re.compile(
    rf" ?[\[({{<] ?(?:(?P<at>{_AT}|@)|(?P<dot>{_DOT}|\.)) ?[\])}}>] ?", re.IGNORECASE)
_SAID_AT = re.compile(rf" {_AT}(?= )", re.IGNORECASE)
#: A domain label by label, its dots written, spoken or in brackets.
_LABELS = re.compile(
    rf"[A-Za-z0-9-]++(?:(?:\.| {_DOT} | ?[\[({{<] ?(?:{_DOT}|\.) ?[\])}}>] ?)[A-Za-z0-9-]++)*+", re.IGNORECASE)
_SAID_DOT = re.compile(rf" {_DOT} ", re.IGNORECASE)
_DOT_BEFORE = re.compile(rf" {_DOT} \Z", re.IGNORECASE)
_DIGIT_DOT = re.compile(rf"(?<=[0-9]) {_DOT} (?=[0-9])", re.IGNORECASE)


def _plain(char: str) -> str:
    if char in INVISIBLE:
        return ""
    if char in LOOKALIKES:
        return LOOKALIKES[char]
    digit = unicodedata.decimal(char, None)
    if digit is not None:
        return str(digit)
    form = unicodedata.normalize("NFKC", char)
    return form if len(form) == 1 and form.isascii() and form.isprintable() else char


@cache
def _changed() -> dict[str, str]:
    """All characters that ``_plain`` changes, and to what."""
    return {c: new for c in map(chr, range(128, sys.maxunicode + 1)) if (new := _plain(c)) != c}


def look_alikes(text: str) -> Rewritten | None:
    """Characters that look like ASCII ones, and invisible ones."""
    if text.isascii() or _changed().keys().isdisjoint(_BEYOND.findall(text)):
        return None
    edits = [(m.start(), m.end(), new) for m in _BEYOND.finditer(text) if (new := _changed().get(m[0])) is not None]
    return Rewritten(text, edits)


def spelled_digits(text: str) -> Rewritten | None:
    """Runs of digits' names."""
    if _NAMES.isdisjoint(text.lower().replace("-", " ").split(" ")):
        return None
    edits = []
    for m in _SPELLED.finditer(text):
        parts = _PART.findall(m[0][5:] if m["plus"] else m[0])
        if sum(p.lower() in _NAMES for p in parts) >= 3:
            digits = "".join(p if p.isdigit() else DIGIT_WORDS.get(p.lower(), ".") for p in parts)
            edits.append((m.start(), m.end(), ("+" if m["plus"] else "") + digits))
    return Rewritten(text, edits) if edits else None


def _said_ats(text: str) -> Iterator[tuple[int, int, int, int]]:
    """Where the name of an @ stands between a local part and a domain: start of the part, the name with its spaces, end
    of the domain.  A domain with written dots only needs a known ending, and no word of prose before the name.

    Domains do not overlap, and a local part is looked for after the last domain, so each character is seen once.
    """
    free = 0
    for m in _SAID_AT.finditer(text):
        domain = _LABELS.match(text, m.end() + 1)
        if not domain or m.start() < free:
            continue
        labels = domain[0].split(".")
        said = " " in domain[0] or any(b in domain[0] for b in "[({<")
        if not said and (len(labels) < 2 or labels[-1].lower() not in ENDINGS):
            continue
        start = last = m.start()
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start == last or not said and text[start:last].lower() in _PROSE:
            continue
        while dot := _DOT_BEFORE.search(text[max(free, start - 8): start]):
            end = start - len(dot[0])
            begin = end
            while begin > free and text[begin - 1] in _LOCAL:
                begin -= 1
            if begin == end:
                break
            start = begin
        free = domain.end()
        yield start, m.start(), m.end() + 1, domain.end()


def said_signs(text: str) -> Rewritten | None:
    """At and dot in brackets, as words between parts of an address, and dots as words between digits."""
    found: dict[int, tuple[int, int, str]] = {}
    if any(b in text for b in "[({<"):
        for m in _BRACKETED.finditer(text):
            found[m.start()] = (m.start(), m.end(), "@" if m["at"] else ".")
    for start, at, at_end, end in _said_ats(text):
        found[at] = (at, at_end, "@")
        for d in [*_SAID_DOT.finditer(text, start, at), *_SAID_DOT.finditer(text, at_end, end)]:
            found[d.start()] = (d.start(), d.end(), ".")
    lower = text.lower()
    if any(f" {w} " in lower for w in ("dot", "punkt", "point", "punto")):
        for m in _DIGIT_DOT.finditer(text):
            found[m.start()] = (m.start(), m.end(), ".")
        for after in [e[1] for e in found.values() if e[2] == "@"] + [m + 1 for m in _places(text, "@")]:
            domain = _LABELS.match(text, after)
            for d in _SAID_DOT.finditer(text, after, domain.end()) if domain else ():
                found.setdefault(d.start(), (d.start(), d.end(), "."))
    edits, end = [], 0
    for edit in sorted(found.values()):
        if edit[0] >= end:
            edits.append(edit)
            end = edit[1]
    return Rewritten(text, edits) if edits else None


def _places(text: str, char: str) -> list[int]:
    return [m.start() for m in re.finditer(re.escape(char), text)]


TRANSDUCERS = (look_alikes, spelled_digits, said_signs)


def find_spans(text: str | None) -> list[tuple[int, int, int, bool]]:
    """``(start, kind index, end, base)`` of all spans, base and added, in order."""
    text = text or ""
    base = detect(text)
    spans = [(*s, True) for s in base]
    steps, now = [], text
    for transducer in TRANSDUCERS:
        step = transducer(now)
        if step is not None:
            steps.append(step)
            now = step.text
    if not steps:
        return spans
    stand = [([s for s, k, _ in base if k == kind], [e for _, k, e in base if k == kind]) for kind in range(len(KINDS))]
    for start, kind, end in detect(now):
        touched = False
        for step in reversed(steps):
            touched = touched or step.touches(start, end)
            start, end = step.back(start, end)
        starts, ends = stand[kind]
        before = bisect_right(starts, end - 1)
        if touched and not (before and ends[before - 1] > start):
            spans.append((start, kind, end, False))
    return sorted(set(spans))


# --- rows --------------------------------------------------------------------------------------------------

_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))


def find_pii(docs: DataFrame, column: str = "pii") -> DataFrame:
    """All columns and ``pii``: an array of kind, start, end, and whether it is a base span."""
    kept = [c for c in docs.columns if c != column]
    rows = docs.select(*kept)
    schema = rows.withColumn(
        column, F.lit(None).cast("array<struct<kind:string,start:bigint,end:bigint,base:boolean>>")).schema
    text_at = kept.index("text")

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                spans = [
                    [{"kind": KINDS[k], "start": s, "end": e, "base": b} for s, k, e, b in find_spans(t)]
                    for t in part.column(text_at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(spans, _SPANS)], [*kept, column])

    return rows.mapInArrow(run, schema)


def spans_text(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def mask(text: str, spans: list[tuple[int, int, int, bool]]) -> str:
    """``text`` with each span, or each stretch of overlapping ones, replaced by the kind of its first in brackets."""
    out, at = [], 0
    for start, kind, end, _ in spans:
        if start >= at:
            out += [text[at:start], "[", KINDS[kind].upper(), "]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask_pii(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` masked; nulls stay."""
    text_at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                texts = [mask(t, find_spans(t)) if t else t for t in part.column(text_at).to_pylist()]
                yield part.set_column(text_at, "text", pa.array(texts, part.schema.field(text_at).type))

    return docs.mapInArrow(run, docs.schema)
