"""Personal information in free text: a semi-Markov conditional random field over candidate segments.

Segments are whole spans of one type (email, phone, id_number, address, person), proposed by the shapes such information has; every
span is scored by features of the whole span and of what stands around it. Text outside spans scores 0. The best set of spans that
don't overlap is found by dynamic programming over the candidates' boundaries, so boundaries and types are chosen together. The
weights are the maximum-likelihood ones of the same model over labelled texts (pii_train).
"""

from __future__ import annotations

import bisect
import json
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache
from pathlib import Path
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.registry import R
from millrace.session import table

WEIGHTS = Path(__file__).with_name("pii_weights.json")
#: Words in at least this part of all texts have a class of their own (word_classes), all others are rare. A text has few distinct
#: words, so the number of classed words is bounded by the mean number of distinct words divided by it, whatever the corpus.
CLASSED = 1 / 2000
#: A word is one half of names if it stands in pairs of capitalised words at this part of its capitalised places at least, and if its
#: partners are different ones at this part of the pairs.
PAIRED, NAMELIKE = 0.25, 0.4


class Span(NamedTuple):
    start: int
    end: int
    kind: str
    shape: str


PARTICLES = "de|del|della|di|da|dos|das|do|von|van|der|den|ter|al|el|bin|ibn|la|le|du|st"
# Single words that go before or after a span and tell its type, by their general meaning, in the languages of the texts.
BEFORE = {
    "title": "mr mrs ms miss sir madam dr prof professor doctor chef cook baker brother sister father mother aunt auntie uncle cousin neighbour neighbor friend grandma grandpa colleague señor señora don doña herr frau monsieur madame mme श्री श्रीमती",
    "to": "to from of off and with for à a an de von nach für pour para chez del da do",
    "agent": "by par por द्वारा met meet told ask asked call called named name signed sender author contact host teacher owner photographer thanks dear hi hello regards love merci danke gracias nom nombre",
    "phone": "tel telephone phone fax mobile cell whatsapp call ring dial text sms number hotline telefon handy téléphone appelez teléfono llamen llame ruft anruf फोन फ़ोन",
    "email": "mail mailto e-mail email write contact address inbox correo courriel schreibt escriban écrivez ईमेल",
    "id": "ssn aadhaar passport dni nif nie nino pan uid id licence license identity insurance security tax taxpayer social steuer-id ausweis personalausweis reisepass pasaporte passeport national sécurité card",
    "place": "at lives live visit visiting located location address street near moved moving house bei en au aux in into adresse anschrift dirección पता",
    "number": "order lot batch ean isbn issn published table row ratio bake energy heat serves gas version page sku item invoice part no nr before portion ref model article serial edition step total barcode charge lote réf",
}
AFTER_PERSON = frozenset("says said wrote writes told tells taught teaches swears who brought brings made makes bakes cooks cooked thinks recommends sent shared once still whose dit écrit dice escribe sagt schreibt meint nimmt ने से".split())
_BEFORE = {w: k for k, v in BEFORE.items() for w in v.split()}
_TITLES = frozenset(BEFORE["title"].split())

_WORD = r"[^\W\d_]+(?:['’][^\W\d_]+)?"
_AT = r"(?:\s?@\s?|\s?[\[({]\s?(?:at|AT)\s?[\])}]\s?|\s(?:at|AT)\s)"
_DOT = r"(?:\.|\s?[\[({]\s?(?:dot|DOT)\s?[\])}]\s?|\s(?:dot|DOT)\s)"
_EMAILS = [
    re.compile(rf"(?<![\w.+\-@])(?P<user>[\w](?:[\w.+\-]*\w)?)(?P<at>{at})(?P<host>[^\W_](?:[\w\-]*\w)?(?:{_DOT}[^\W_][\w\-]*)*{_DOT}[^\W\d_]{{2,24}})(?![\w@])")
    for at in (r"\s?@\s?|\s?[\[({]\s?(?:at|AT)\s?[\])}]\s?", r"\s(?:at|AT)\s")
]
_PHONE = re.compile(r"(?<![\w.,/\-+@#])(?P<n>(?:\+\s?|\(\+?)?\d+\)?(?:(?: ?[\-./(]|\) ?|[  ])\(?\d+\)?)*)(?P<ext>\s?(?:ext\.?|x|extension|poste|durchw\.?)\s?\d{1,5})?(?![\w@]|-\d|/\d)", re.I)
_IDS = {
    "3-2-4": r"\d{3}[- ]\d{2}[- ]\d{4}", "4-4-4": r"\d{4}[- ]\d{4}[- ]\d{4}", "12": r"\d{12}", "2-3-3-3": r"\d{2} ?\d{3} ?\d{3} ?\d{3}", "8a": r"\d{8}[- ]?[A-Z]", "aa6": r"[A-Z]{1,2} ?\d{6,8}", "aa2-7": r"[A-Z]{2}\d{2}-\d{7,11}",
    "aa222a": r"[A-Z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-Z]", "aaaaa4a": r"[A-Z]{5}\d{4}[A-Z]", "a7a": r"[A-Z]-?\d{7}-?[A-Z]", "9": r"\d{9,11}", "1-2-2-2-3-3": r"\d ?\d{2} ?\d{2} ?\d{2} ?\d{3} ?\d{3}(?: ?\d{2})?",
}
_ID = [(name, re.compile(rf"(?<![\w.+/#\-])(?:{rx})(?![\w@]|-\w|/\d)")) for name, rx in _IDS.items()]
_CAP = r"[^\W\d_a-zß-ÿ][^\W\d_]*(?:['’\-][^\W\d_]+)*"
_TYPES = "street|st|road|rd|avenue|ave|lane|ln|drive|dr|row|court|ct|close|way|place|pl|square|sq|terrace|crescent|gardens|grove|hill|mews|boulevard|blvd|parkway"
_UNIT = r"(?:(?:[Ff]lat|[Aa]pt\.?|[Aa]partment|[Uu]nit|[Ss]uite|[Rr]oom|[Aa]ppt\.?)\s+\w{1,4},\s+)?"
_NUMBER = r"\d{1,5}(?:[A-Za-z]|/\d{1,3})?"
_STREETS = [
    ("en", re.compile(rf"(?<![\w/.,\-]){_UNIT}{_NUMBER},?\s+(?:(?:St\.\s+)?{_CAP}\s+){{1,3}}(?i:{_TYPES})\b")),
    ("fr", re.compile(rf"(?<![\w/.,\-]){_UNIT}\d{{1,4}}(?:\s(?:bis|ter))?,?\s+(?i:rue|avenue|chemin|allée|boulevard|place|impasse|quai|route|cours)\s+(?:(?:de\sla|de\sl['’]|des|du|de|d['’])\s?)?{_CAP}(?:\s{_CAP})?")),
    ("es", re.compile(rf"\b(?:C/|Calle|Avda\.?|Avenida|Plaza|Paseo|Camino)\s?(?:(?:de\slas?|de\slos|del|de)\s)?{_CAP}(?:\s{_CAP})?,?\s+\d{{1,4}}(?:,\s\d{{1,2}}[ºª°]\s?[A-Z]?\b)?")),
    ("de", re.compile(rf"\b(?:{_CAP}\s)?[^\W\d_a-zß-ÿ][^\W\d_]*(?:straße|strasse|str\.|weg|gasse|platz|allee|ring|damm|ufer)\s\d{{1,4}}(?:\s?[a-z])?\b")),
    ("box", re.compile(r"\b(?:P\.?\s?O\.?\s?Box|Postfach|Apartado(?: de correos)?|B\.?P\.?|Boîte postale)\s\d{2,6}")),
]
#: In lower case, one of what any match of the pattern holds.
_STREET_KEYS = {
    "en": _TYPES.split("|"), "fr": ("rue", "avenue", "chemin", "allée", "boulevard", "place", "impasse", "quai", "route", "cours"), "es": ("c/", "calle", "avda", "avenida", "plaza", "paseo", "camino"),
    "de": ("straße", "strasse", "str.", "weg", "gasse", "platz", "allee", "ring", "damm", "ufer"), "box": ("box", "postfach", "apartado", "p.", "bp", "b.p", "boîte"),
}
_BRACKET_AT = re.compile(r"[\[({]\s?at\s?[\])}]")
#: What every telephone number and every shape of an identity number holds.
_MANY_DIGITS = re.compile(r"\d(?:[\s.\-/()]{0,3}\d){4}|[A-Z]{5}\d{4}")
_CODE = r"(?:[A-Z]{1,2}\d{1,2}[A-Z]? \d[A-Z]{2}|(?:- )?\d{4,6})"
#: What may follow a street: postcode and town of so many words, or town and postcode.
_TAILS = [re.compile(rf",? (?:(?P<before>\d{{4,6}} {town})|(?P<town>{town})(?:,? (?P<code>{_CODE}))?)(?![\w@.+]*\s?[@\[{{(])(?!\w)") for town in (rf"{_CAP}(?: {_CAP}){{{n}}}" for n in range(3))]

_FAMILY = r"[^\W\d_]+(?:['’\-][^\W\d_]+)*"
_PARTS = rf"(?:(?:{PARTICLES}) )*"
_INITIAL = r"[^\W\d_a-zß-ÿ]\."
_FREE, _ENDS = r"(?<![\w@.\-+])", r"(?![\w@]|[.\-]\w)"
#: Two capitalised words, initials and particles between them; lookahead, so that every first word has its turn.
_TWO = re.compile(rf"(?=[^\W\d_a-zß-ÿ]){_FREE}(?=(?P<a>{_CAP}) (?P<i>(?:{_INITIAL} )?)(?P<p>(?i:{_PARTS}))(?P<b>{_CAP}){_ENDS})")
_LISTED = re.compile(rf"{_FREE}(?=(?P<p>(?i:{_PARTS}))(?P<a>{_CAP}), (?P<b>{_CAP})(?P<i>(?: {_INITIAL}(?!\w))?){_ENDS})")
_COMMA_CAP = re.compile(r", [^\W\d_a-zß-ÿ]")
_INITIALS = re.compile(rf"(?=[^\W\d_a-zß-ÿ]\.)(?<![\w@.])(?P<i>(?:{_INITIAL} ?){{1,2}})(?P<p>(?i:{_PARTS}))(?P<b>{_FAMILY}){_ENDS}")
_SMALL = r"[^\W\d_A-ZÀ-Þ]+(?:['’\-][^\W\d_A-ZÀ-Þ]+)*"
_TWO_SMALL = re.compile(rf"{_FREE}(?=(?P<a>{_SMALL}) (?P<i>)(?P<p>{_PARTS})(?P<b>{_SMALL}){_ENDS})")
_FREE_WORD = re.compile(rf"{_FREE}{_WORD}(?![\w@]|\.\w)")
#: Capitalised words within a sentence.
_INSIDE = re.compile(rf"(?<=[\w,;] )(?=[^\W\d_a-zß-ÿ]){_WORD}(?![\w@]|\.\w)")


@lru_cache(maxsize=100_000)
def plain(word: str) -> str:
    """A word in lower case without accents."""
    import unicodedata

    return "".join(c for c in unicodedata.normalize("NFKD", word.casefold()) if not unicodedata.combining(c))


def _digits(text: str) -> int:
    return sum(c.isdigit() for c in text)


class Classes(dict[str, str]):
    """Class of each word, in lower case without accents, that has one."""

    @cached_property
    def ordinary(self) -> frozenset[str]:
        """Words that are no part of names."""
        return frozenset(w for w, c in self.items() if c in "lsc")



def word_class(word: str, classes: Classes) -> str:
    """Class of a word in the corpus: l small within sentences, g first and f second half of names, c capitalised, s opens sentences, r rare."""
    whole = classes.get(plain(word))
    if whole or "-" not in word:
        return whole or "r"
    found = {classes.get(plain(w), "r") for w in word.split("-")}
    return next(c for c in "lscgfr" if c in found)


def _opened(text: str, start: int, end: int) -> int:
    """start where the bracket there closes within the number, -1 where it closes at its end, end where it never does."""
    depth = 0
    for i in range(start, end):
        depth += (text[i] == "(") - (text[i] == ")")
        if not depth:
            return start if i < end - 1 else -1
    return end


def _phones(m: re.Match, text: str) -> Iterator[Span]:
    """A run of digits as it stands, and every part of it between blanks that has as many digits as a number may have."""
    run, start = m["n"], m.start()
    edges = [0, *(g.end() for g in re.finditer(r"[ \u00a0](?=\(?\d)", run))]
    ends = [*(e - 1 for e in edges[1:]), len(run)]
    sizes = [_digits(run[a:b]) for a, b in zip(edges, ends, strict=True)]
    for i, a in enumerate(edges):
        n = single = 0
        for j in range(i, len(ends)):
            n += sizes[j]
            single += sizes[j] == 1
            if n > 16 or single > 2:  # numbers have at most two groups of one digit
                break
            if n < 7:
                continue
            s, e = start + a, start + ends[j]
            if text[e - 1] == ")" and text.count("(", s, e) < text.count(")", s, e):
                e -= 1
            if text[s] == "(" and (depth := _opened(text, s, e)) != s:  # the number as a whole is in brackets, or what opens never closes
                s, e = s + 1, e - (depth < 0)
            last = j == len(ends) - 1
            if last and m["ext"]:
                yield Span(s, m.end(), "phone", "ext" if not i else "later ext")
            yield Span(s, e, "phone", "part" if i and not last else "head" if not last else "tail" if i else "cut" if m["ext"] else "whole")


def _persons(text: str, classes: Classes) -> Iterator[Span]:
    for m in _TWO.finditer(text):
        if not (m["a"][0].isupper() and m["b"][0].isupper()) or m["a"].lower() in _TITLES:  # a script without case, or no part of the name
            continue
        a, b = word_class(m["a"], classes), word_class(m["b"], classes)
        if a in "ls" and b in "ls" and _cue(text, m.start("a")) not in ("title", "agent"):
            continue
        yield Span(m.start("a"), m.end("b"), "person", "two" + " initial" * bool(m["i"]) + " particle" * bool(m["p"]))
    for m in _LISTED.finditer(text) if _COMMA_CAP.search(text) else ():
        a, b = word_class(m["a"], classes), word_class(m["b"], classes)
        if a in "ls" or b in "ls" and _cue(text, m.start("p")) not in ("title", "agent", "to"):
            continue
        for start in {m.start("p"), m.start("a")}:
            yield Span(start, m.end("b"), "person", "listed" + " particle" * (start != m.start("a")))
            if m["i"]:
                yield Span(start, m.end("i"), "person", "listed initial" + " particle" * (start != m.start("a")))
    for m in _INITIALS.finditer(text):
        yield Span(m.start(), m.end(), "person", "initials" + " particle" * bool(m["p"]))
    for m in _TWO_SMALL.finditer(text) if any(w[:1].islower() and classes.get(plain(w.strip(".,;:!?()\"'»«")), "r") in "gfr" for w in set(text.split()) - classes.ordinary) else ():
        a = classes.get(plain(m["a"]), "r")
        if a in "gf" or a == "r" and _cue(text, m.start("a")) in ("title", "agent", "to"):
            b = word_class(m["b"], classes)
            if b != "l":
                yield Span(m.start("a"), m.end("b"), "person", "small" + " particle" * bool(m["p"]))


def _cue(text: str, at: int) -> str:
    """What the last word before a place tells of what follows, if anything."""
    m = re.search(rf"({_WORD})[\s.:]*$", text[max(0, at - 30) : at])
    return _BEFORE.get(m[1].lower(), "") if m else ""


def candidates(text: str, classes: Classes) -> list[Span]:
    """Every span that may be one, whole shapes and their shorter readings; as long as it takes."""
    out: set[Span] = set()
    # what a shape can't do without is looked for first; most texts lack it
    low = text.lower()
    signed, worded = "@" in text or _BRACKET_AT.search(low), " at " in low
    numbers = _MANY_DIGITS.search(text)
    for m in (m for rx, there in zip(_EMAILS, (signed, worded), strict=True) if there for m in rx.finditer(text)):
        kind = m["at"].strip()
        shape = "sign" if m["at"] == "@" else "spaced" if kind == "@" else "word" if kind.lower() == "at" else "bracket"
        dots = "dots" if re.fullmatch(r"[\w.\-]+", m["host"]) else "spelled"
        out.add(Span(m.start(), m.end(), "email", f"{shape} {dots}"))
    for m in _PHONE.finditer(text) if numbers else ():
        out.update(_phones(m, text))
    for name, rx in _ID if numbers else ():
        for m in rx.finditer(text):
            out.add(Span(m.start(), m.end(), "id_number", name))
    for name, rx in _STREETS:
        for m in rx.finditer(text) if any(k in low for k in _STREET_KEYS[name]) else ():
            out.add(Span(m.start(), m.end(), "address", f"{name} street"))
            for tail in _TAILS:
                t = tail.match(text, m.end())
                if t and (name == "box" or text[m.end()] == "," or t["before"]):
                    out.add(Span(m.start(), t.end(), "address", f"{name} {'code' if t['before'] or t['code'] else 'town'}"))
                    if t["town"] and t["code"]:
                        out.add(Span(m.start(), t.end("town"), "address", f"{name} town"))
    out.update(_persons(text, classes))
    return sorted(s for s in out if "\n\n" not in text[s.start : s.end])


def _around(text: str, s: Span, classes: Classes) -> tuple[str, str, str, str]:
    """Kinds of the last and the last but one token before a span and of the first after it, and the two before together."""
    before, after = text[max(0, s.start - 40) : s.start], text[s.end : s.end + 24]
    line = before.rpartition("\n")[2]
    found = re.findall(rf"{_WORD}|[^\w\s]|\d+", line)

    def kind(t: str) -> str:
        if t[0].isalpha():
            cue = _BEFORE.get(t.lower())
            return cue or f"{'Cap' if t[0].isupper() else 'low'} {word_class(t, classes)}"
        return "digits" if t[0].isdigit() else t if t in "(,:.;—–-@#!?/’'\"“”«»*•" else "sign"

    one = kind(found[-1]) if found else "line start"
    if one in (":", "#", ".", "(") and len(found) > 1:
        one = f"{one} {kind(found[-2])}" if one != "." or kind(found[-2]) in ("title", "id", "phone", "number") else one
    two = kind(found[-2]) if len(found) > 1 else "line start"
    m = re.match(rf"(\s*)({_WORD}|[^\w\s]|\d+)", after)
    if not m:
        nxt = "end"
    elif "\n" in m[1]:
        nxt = "line end"
    elif m[2][0].isalpha():
        nxt = "verb" if m[2].lower() in AFTER_PERSON else f"{'Cap' if m[2][0].isupper() else 'low'} {word_class(m[2], classes)}"
    else:
        nxt = "digits" if m[2][0].isdigit() else m[2] if m[2] in ",.;:()!?-—’'\"”»+<@/%#" else "sign"
    return one, two, nxt, f"{two} | {one}" if one in ("agent", "to", "low l", ",", "title") and two != "line start" else one


_CONTACT_AFTER = re.compile(r"[\s,;:(<]*(?:\+?\(?\d[\d()./ \-]{6,}|[\w.+\-]+\s?@|tel\b|mail\b|e-?mail\b|phone\b)", re.I)
_UNIT_AFTER = re.compile(r"\s?(?:kcal|kJ|g\b|kg|ml|%|°|cm|people|min|€|\$|pcs|times)")
_DATE_OR_RANGE = re.compile(r"\d{1,2}[/.]\d{1,2}[/.]\d{2,4}|(?:19|20)\d\d-\d\d-\d\d|(?:1[89]|20)\d\d\s?[-–]\s?(?:1[89]|20)\d\d|\d{1,4}-\d{1,4}-\d{1,4}")


def _titled(text: str, s: Span) -> bool:
    """Whether the span is within a line of capitalised words, as headings are."""
    start, end = text.rfind("\n", 0, s.start) + 1, text.find("\n", s.end)
    line = text[max(start, s.start - 60) : s.start] + text[s.end : min(end if end >= 0 else len(text), s.end + 60)]
    found = [w for w in re.findall(_WORD, line) if len(w) > 3]
    return len(found) > 0 and all(w[0].isupper() for w in found)


def features(text: str, s: Span, classes: Classes, within: bool = False) -> list[str]:
    """The features of a whole span: its shape, its parts, the words around it, and whether it is within a longer one of its type."""
    value, before, after = text[s.start : s.end], text[max(0, s.start - 2) : s.start], text[s.end : s.end + 30]
    one, two, nxt, pair = _around(text, s, classes)
    out = [f"{s.kind}", f"{s.kind} {s.shape}", f"{s.kind} after {one}"]
    if s.kind == "id_number" or s.kind == "phone":
        cues = {_BEFORE.get(w.lower()) for w in re.findall(_WORD, text[max(0, s.start - 40) : s.start].rpartition("\n")[2])[-3:]}
        out += [f"{s.kind} near {k}" for k in sorted(c for c in cues if c in ("id", "phone", "number"))]
    if "\n" in value:
        out.append(f"{s.kind} line end inside")
    if within:
        out.append(f"{s.kind} within a longer one")
    if s.kind == "email":
        user, host = re.split(_AT, value)[0], re.split(_AT, value)[-1]
        out.append("email user " + ("signs" if re.search(r"[\d._+]", user) else f"plain {word_class(user, classes)}"))
        out.append(f"email {s.shape} host labels {min(4, len(re.split(_DOT, host)))}")
        out.append("email path after" if after[:1] == "/" else "email no path")
    elif s.kind == "phone":
        groups = re.findall(r"\d+", value)
        lead = "+" if value[0] == "+" else "(" if value[0] == "(" else "00" if value.startswith("00") else "0" if value[0] == "0" else "n"
        out += [f"phone lead {lead} {s.shape}", f"phone digits {min(16, _digits(value))}", f"phone lead {lead} digits {min(16, _digits(value))}", f"phone groups {min(5, len(groups))}", f"phone shape {lead} {'-'.join(str(len(g)) for g in groups[:5])}"]
        if _DATE_OR_RANGE.fullmatch(value):
            out.append("phone like a date or range")
        out += [f"phone sign {x}" for x in sorted(set(re.findall(r"[^\d \u00a0]", value)))]
        out.append("phone after sign" if before[-1:] in ("#", "№") else "phone clear")
        out.append("phone unit after" if _UNIT_AFTER.match(after) else "phone no unit")
        if any(rx.fullmatch(value) for _, rx in _ID):
            out.append("phone may be an id")
    elif s.kind == "id_number":
        out.append(f"id letters {bool(re.search('[A-Z]', value))}")
        out.append(f"id {s.shape} after {'cue' if 'id' in one else 'number' if 'number' in one else 'other'}")
        if _UNIT_AFTER.match(after):
            out.append("id unit after")
    elif s.kind == "address":
        out.append(f"address {s.shape.split()[-1]}")
        words = [word_class(w, classes) for w in re.findall(_WORD, value)]
        out += ["address number first"] if value[0].isdigit() else []
        out.append(f"address small words {min(3, words.count('l'))}")
        if re.match(r"\s[a-zà-ÿ]+ers\b|-", after):
            out.append("address goes on")
        out.append("address capital after" if re.match(rf",? {_CAP}(?![\w.+\-]*\s?@)", after) else "address no capital after")
    else:
        parts = [w for w in re.findall(_FAMILY, value) if len(w) > 1 and not re.fullmatch(PARTICLES, w, re.I)]
        kinds = [word_class(w, classes) for w in parts] or ["none"]
        shape = s.shape.split()[0]
        case = "upper" if value.isupper() else "small" if value.islower() else "cap"
        out += [f"person {shape} {kinds[0]}+{kinds[-1]}" if len(kinds) > 1 else f"person {shape} {kinds[0]}", f"person {shape} last {kinds[-1]}", f"person {shape} first {kinds[0]}"]
        out += [f"person case {case} {shape}", f"person {shape} {pair} >", f"person < {nxt}", f"person {shape} after {one} {kinds[0]}+{kinds[-1]}", f"person {shape} {kinds[0]}+{kinds[-1]} < {nxt}"]
        if any(len(w) < 3 for w in parts):
            out.append("person short part")
        if any(w.isupper() != value.isupper() for w in parts if len(w) > 1) and case != "cap":
            out.append("person mixed case")
        if any(w[0].isupper() and re.fullmatch(PARTICLES, w, re.I) for w in re.findall(_WORD, value)) and case == "cap":
            out.append("person particle upper")
        if any(_BEFORE.get(w.lower()) == "title" for w in parts):
            out.append("person title inside")
        if s.kind == "person" and _titled(text, s):
            out.append(f"person in a heading {shape}")
        if _CONTACT_AFTER.match(after):
            out.append("person contact after")
        if re.match(r"[’']s\b", after):
            out.append("person genitive")
        out.append("person whole line" if "line" in one and nxt in ("line end", "end") else "person in a line")
    return out


def contained(spans: list[Span]) -> list[bool]:
    """For each span whether another of its kind holds it; spans are sorted."""
    out = [False] * len(spans)
    reach: dict[str, int] = {}
    same: dict[tuple[int, int, str], int] = {}
    for i in sorted(range(len(spans)), key=lambda i: (spans[i].start, -spans[i].end)):
        s = spans[i]
        key = (s.start, s.end, s.kind)
        out[i] = out[same[key]] if key in same else reach.get(s.kind, -1) >= s.end
        same.setdefault(key, i)
        reach[s.kind] = max(reach.get(s.kind, -1), s.end)
    return out


def decode(spans: list[Span], scores: list[float]) -> list[Span]:
    """The set of spans without overlap that has the greatest total score, by dynamic programming over the spans' ends."""
    order = sorted((i for i in range(len(spans)) if scores[i] > 0), key=lambda i: (spans[i].end, spans[i].start))
    ends = [spans[i].end for i in order]
    best: list[float] = [0.0]
    take: list[int | None] = []
    for n, i in enumerate(order):
        before = bisect.bisect_right(ends, spans[i].start, 0, n)
        with_it = best[before] + scores[i]
        take.append(before if with_it > best[n] else None)
        best.append(max(best[n], with_it))
    chosen, n = [], len(order)
    while n:
        if take[n - 1] is None:
            n -= 1
        else:
            chosen.append(spans[order[n - 1]])
            n = take[n - 1]
    return chosen[::-1]


@lru_cache(maxsize=2)
def _weights(path: str) -> dict[str, float]:
    return json.loads(Path(path).read_text())


def find(text: str | None, weights: dict[str, float], classes: Classes) -> list[Span]:
    """The spans of personal information in a text, in their order; null and empty texts have none."""
    if not text:
        return []
    spans = candidates(text, classes)
    return decode(spans, [sum(weights.get(f, 0.0) for f in features(text, s, classes, w)) for s, w in zip(spans, contained(spans), strict=True)]) if spans else []


class Counts:
    """What word classes are told from: per word its texts, places and places within sentences; and pairs of capitalised words.

    Words in mail addresses and the like don't count. A pair is a run of exactly two capitalised words (initials, particles between).
    """

    def __init__(self) -> None:
        self.texts: Counter[str] = Counter()
        self.forms: Counter[str] = Counter()
        self.capital: Counter[str] = Counter()
        self.pairs: Counter[tuple[str, str]] = Counter()

    def add(self, text: str) -> None:
        found = _FREE_WORD.findall(text)
        self.forms.update(found)
        self.texts.update(set(map(plain, set(found))))
        self.capital.update(map(plain, _INSIDE.findall(text)))
        end = -1
        for m in _TWO.finditer(text):
            start, stop = m.start("a"), m.end("b")
            if not (m["a"][0].isupper() and m["b"][0].isupper()):
                continue
            chained, end = start <= end, stop
            if m["a"].lower() in _TITLES:
                end = -1
                continue
            if chained or re.match(rf" {_CAP}", text[stop : stop + 4]) or _goes_back(text, start):
                continue
            self.pairs[plain(m["a"]), plain(m["b"].rpartition("-")[2])] += 1

    def size(self) -> int:
        return len(self.forms) + len(self.pairs)

    def places(self) -> tuple[Counter[str], Counter[str]]:
        """Places of every word, and those in small letters."""
        every, small = Counter(), Counter()
        for w, n in self.forms.items():
            every[plain(w)] += n
            if not w[0].isupper():
                small[plain(w)] += n
        return every, small

    def rows(self) -> pa.RecordBatch:
        """word, partner (null for the word's own counts), texts, places (of the pair), small, capital; the counts start anew."""
        words = list(self.texts)
        pairs = list(self.pairs)
        none = [0] * len(pairs)
        places, small = self.places()
        columns = [pa.array([*words, *(a for a, _ in pairs)], pa.string()), pa.array([*([None] * len(words)), *(b for _, b in pairs)], pa.string())]
        columns += [pa.array([*(c[w] for w in words), *rest], pa.int64()) for c, rest in ((self.texts, none), (places, self.pairs.values()), (small, none), (self.capital, none))]
        self.__init__()
        return pa.RecordBatch.from_arrays(columns, names=["word", "partner", "texts", "places", "small", "capital"])


def _goes_back(text: str, at: int) -> bool:
    """Whether a capitalised word that is no title stands right before."""
    m = re.search(rf"({_CAP}) $", text[max(0, at - 24) : at])
    return bool(m) and m[1].lower() not in _TITLES


def class_of(places: int, small: int, capital: int, seconds: int, firsts: int, before: int, after: int) -> str:
    """Class of a word from its places, those in small letters, those capitalised within sentences, its different partners where it is
    the first and the second of a pair, and the places of these pairs."""
    if small > places / 2:
        return "l"
    partners, pairs = (seconds, before) if before >= after else (firsts, after)
    if pairs and pairs >= PAIRED * (places - small) and partners >= NAMELIKE * pairs:
        return "g" if before >= after else "f"
    return "s" if capital < places / 10 else "c"


def classes_of(rows: list[tuple]) -> Classes:
    """Classes from a word and the counts that class_of takes."""
    return Classes((w, class_of(*r)) for w, *r in rows)


def word_classes(docs: DataFrame, text: str, share: float = CLASSED) -> Classes:
    """Class of every word, in lower case without accents, that is in at least share of all texts (and three); counted over all of them, whole.

    The classes are statistics of the corpus: what a word counts as depends on all texts, not on their order or number.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                if t:
                    counts.add(t)
                    if counts.size() > 300_000:
                        yield counts.rows()
        yield counts.rows()

    rows = docs.select(F.col(text).alias("t"))
    least = max(3, math.ceil(rows.count() * share))
    pairs = rows.mapInArrow(run, "word string, partner string, texts long, places long, small long, capital long").groupBy("word", "partner").agg(*[F.sum(c).alias(c) for c in ("texts", "places", "small", "capital")])
    zero, one, alone = F.lit(0).cast("long"), F.lit(1).cast("long"), F.col("partner").isNull()

    def counts(word: str, own: bool, first: bool, second: bool) -> Column:
        mine = [F.col(c) if own else zero for c in ("texts", "places", "small", "capital")]
        there = [one if first else zero, one if second else zero, F.col("places") if first else zero, F.col("places") if second else zero]
        return F.struct(F.col(word).alias("w"), *[c.alias(n) for c, n in zip([*mine, *there], sums, strict=True)])

    sums = ("texts", "places", "small", "capital", "seconds", "firsts", "before", "after")
    each = pairs.select(F.explode(F.when(alone, F.array(counts("word", True, False, False))).otherwise(F.array(counts("word", False, True, False), counts("partner", False, False, True)))).alias("x")).select("x.*")
    found = each.groupBy("w").agg(*[F.sum(c).alias(c) for c in sums]).where(F.col("texts") >= least)
    return classes_of([tuple(r) for r in found.drop("texts").collect()])


def local_classes(texts: Iterable[str], share: float = CLASSED) -> Classes:
    """As word_classes, of texts at hand."""
    counts, n = Counts(), 0
    for t in texts:
        counts.add(t)
        n += 1
    least = max(3, math.ceil(n * share))
    seconds, firsts = Counter(a for a, _ in counts.pairs), Counter(b for _, b in counts.pairs)
    before, after = Counter(), Counter()
    for (a, b), k in counts.pairs.items():
        before[a] += k
        after[b] += k
    places, small = counts.places()
    return classes_of([(w, *(c[w] for c in (places, small, counts.capital, seconds, firsts, before, after))) for w, k in counts.texts.items() if k >= least])


def personal_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", *, weights: str = str(WEIGHTS)) -> DataFrame:
    """key, redacted, spans (array of start, end, pii_type, pii_value) of every row.

    Starts and ends count characters. redacted has [EMAIL], [PHONE], [ID_NUMBER], [ADDRESS] or [PERSON] for each span and all else
    unchanged; null stays null. Row-local but for the classes of words, which come from all texts.
    """
    classes = docs.sparkSession.sparkContext.broadcast(word_classes(docs, text))

    @F.arrow_udf("struct<redacted:string,spans:array<struct<start:int,end:int,pii_type:string,pii_value:string>>>")
    def run(batch: pa.Array) -> pa.Array:
        w, rows = _weights(weights), []
        for t in batch.to_pylist():
            spans = find(t, w, classes.value)
            out, at = [], 0
            for s in spans:
                out += [t[at : s.start], f"[{s.kind.upper()}]"]
                at = s.end
            rows.append({"redacted": None if t is None else "".join(out) + t[at:], "spans": [{"start": s.start, "end": s.end, "pii_type": s.kind, "pii_value": t[s.start : s.end]} for s in spans]})
        span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("pii_type", pa.string()), ("pii_value", pa.string())])
        return pa.array(rows, pa.struct([("redacted", pa.string()), ("spans", pa.list_(span))]))

    return docs.select(F.col(key), run(F.col(text)).alias("_r")).select(key, F.col("_r.redacted").alias("redacted"), F.col("_r.spans").alias("spans"))


@R.query("p10_redacted")
def p10_redacted(spark: SparkSession, root: str) -> DataFrame:
    """doc_id, redacted, n_spans of every document."""
    return personal_spans(table(spark, root, "documents")).select("doc_id", "redacted", F.size("spans").alias("n_spans"))


@R.query("p10_found")
def p10_found(spark: SparkSession, root: str) -> DataFrame:
    """doc_id, pii_type, pii_value, once per document, type and value."""
    spans = personal_spans(table(spark, root, "documents")).select("doc_id", F.explode("spans").alias("s"))
    return spans.select("doc_id", "s.pii_type", "s.pii_value").distinct()
