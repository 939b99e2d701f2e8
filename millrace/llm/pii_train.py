"""Training of the semi-Markov field of pii: python -m millrace.llm.pii_train writes pii_weights.json.

The labelled texts are composed here: sentence frames written for this purpose, in five languages, and names, places, dishes and
numbers made by rule from syllables and shapes. None of it is taken from a corpus, and no list of names is used, at training or
after. TEXTS bounds their number. They form WORLDS corpora, each with names and frames of its own and its own word classes, from few
names that come again to names that never do, so that the weights rest on what a word does rather than on which word it is. The
likelihood sums over all sets of candidate spans without overlap, by forward and backward sums over the spans' boundaries.
"""

from __future__ import annotations

import bisect
import json
import math
import random
import re

import numpy as np

from millrace.llm.pii import WEIGHTS, Span, candidates, contained, features, local_classes

TEXTS, WORLDS, ROUNDS, RIDGE, SEED = 14000, 14, 16, 1e-3, 7

# Parts that names, towns and coined dishes are made of by rule.
_OPEN = "b br c ch d dr f g gr h j k kl l m n p pr r s sh st t th v w y z".split()
_VOWEL = "a e i o u ai ei ie ou á é ö ü".split()
_CLOSE = ["", "", "", "n", "r", "l", "s", "m", "t", "k", "nd", "rk", "ss"]
_ENDS = "ic man sen wright ova enko ides oglu ger ault ano ery dahl kar shi better well hurst".split()

# Ordinary words of the languages of the texts, strung together at random where only what a span is itself should count.
_PLAIN = (
    "was like because when never often then here after before while only very about again under this that those our his their some any without between since until maybe rather quite both each which could would should came went saw gave took found kept ate likes knows feels heard old small warm "
    "war wie weil nie dann hier nach nur sehr oder und aber kam ging sah gab fand kennt alte kleine était comme parce jamais puis ici après seulement très mais vint donna connaît vieux petite era como porque nunca luego aquí después muy pero vino conoce vieja था और लेकिन यहाँ बहुत फिर"
).split()

FRAMES = [
    # persons
    "I learned this one from {p} during a rainy holiday.", "{p} brought two trays to the potluck.", "Big applause for {p}, our baker of the year.", "Our landlord {p} keeps bees behind the shed.", "Yesterday {p} phoned about the missing whisk.", "The column was written by {p} for a local paper.", "Dr. {p} advised less sugar.", "Prof. {p} measured the acidity twice.", "Mrs {p} still grinds the flour herself.",
    "Mr. {p} owns that orchard.", "Best wishes,\n{p}", "Kind regards\n{p}", "Yours, {p}", "Posted by {p} in Baking", "Author: {p}", "Text: {p}", "Photographer: {p}", "Words by {p}", "According to {p}, the yeast was stale.", "She married {p} in the same year.", "I asked {p} whether rye would do.", "Have you met {p}? What a cook.", "Guests were {p}, {p} and {p}.", "Contact person: {p}", "Dear {p},\nyour parcel is here.",
    "Hello {p}, the oven is free now.", "Jury: {p} (chair), {p}", "Nobody beats {p} at noodles.", "This belongs to {p}.", "Give the keys to {p}!", "With {p} we picked plums all day.", "Then {p} wrote: more garlic!", "{p} thinks the crumb is too dense.", "{p}", "– {p}", "~ {p}", "My colleague {p} sent me the link.", "Grandma {p} never used a scale.", "Cook {p} recommends a longer rest.", "Interview: {p}, pastry school", "Speaker {p} opens the workshop.", "Winner of last year: {p}!", "Reply to {p}", "@{h}: tell {p} to bring plates",
    "Von {p} habe ich den Trick mit dem Topf.", "Frau {p} backt jeden Freitag.", "Herr {p} schreibt uns aus Bremen.", "Herzlichst, {p}", "Viele Umarmungen, {p}", "Servus, {p}", "Amitiés, {p}", "Saludos, {p}", "Con cariño, {p}", "Autorin: {p}", "Laut {p} reicht eine Prise.", "Wir trafen {p} beim Backkurs.", "Mein Nachbar {p} hat den Ofen gebaut.", "Bei {p} schmeckte es besser.",
    "C’est {p} qui m’a montré le geste.", "Signé {p}", "Madame {p} tient la boutique.", "Auteur : {p}", "Selon {p}, il faut moins de beurre.", "Un grand bravo à {p} !", "Chez {p}, on mange tard.", "{p} écrit que la pâte colle.",
    "Aprendí el truco con {p} en verano.", "La señora {p} vende miel.", "Autora: {p}", "Según {p}, falta comino.", "Un saludo, {p}", "Le pregunté a {p} por el horno.", "{p} dice que no lleva ajo.",
    "मैंने इसे {p} से सीखा था", "{p} का सुझाव बहुत काम आया", "लेखक: {p}", "श्री {p} रोज़ रोटी बनाते थे",
    "Rezept von {p}, leicht gekürzt.", "Ein Lob von {p}, der lange wartete.", "Das Foto ist von {p}", "Una idea de {p}, la vecina.", "Fotos de {p}", "Une recette de {p}, ma tante.", "L’idée vient de {p} et de {p}.", "Message for {p}, please forward.", "A letter from {p}, long overdue.", "News from {p}", "With help of {p}, finally.", "Ein Gruß an {p}, bis bald.", "Un mensaje para {p}, urgente.", "Un mot pour {p}, vite.",
    "{l} {l} {p} {l} {l}.", "{l} {l} {l} {p}.", "{p} {l} {l} {l}.", "{l} {l} {p}, {l} {l}.", "{L} {l} {p} {l} {l} {f}.", "{L} {p} {l} {l}.", "{L} {p} {l}, {l} {l} {l}.", "{L}: {p}", "{L} {l} {l} {p}!", "{u} {u} {p} {u} {l}.", "{l} {u} {p}.", "{p} {l} {u} {u}.", "{p} {u} {l} {u}.", "{p} {u} {f}.", "{L} {u} {l} {p}.", "{L} {u} {p} {u}.", "{p} {l} {l} {w}.", "{L} {l} {p} {l} {p} {l}.",
    # mail
    "Reach me via {e} any time.", "Feedback? {e}", "E-mail: {e}", "Our newsletter goes out from {e} monthly.", "Kindly drop a line at {e} if lost.", "New address is {e}, the older one bounced.", "({e})", "Anmeldung per {e}", "Rückfragen an {e} bitte.", "Inscription : {e}", "Une question ? {e}", "Consultas a {e}", "Mándame una foto a {e} cuando puedas.", "ईमेल: {e}", "{e}",
    # phone
    "Mobile {t}", "Phone: {t}", "Reservations under {t} only.", "Text me: {t}", "Our hotline {t} is free of charge.", "Dial {t} for the delivery desk.", "You'll get me on {t} most evenings.", "Is {t} still your number?", "Telefon {t}", "Rufnummer {t}", "Erreichbar sind wir unter der {t} ab acht.", "Téléphone : {t}", "Joignable au {t} le soir.", "Teléfono {t}", "Mi móvil es el {t} ahora.", "फ़ोन: {t}", "{t}", "New number: {t}. Old one: {t}", "Phones {t} / {t}", "Emergency {t} or {t}",
    # identity numbers
    "Her {i} was printed on the voucher.", "I accidentally shared my {i} here, please remove it.", "ID: {i}", "{i} (copy attached)", "Registered with {i} since spring.", "The clerk wanted {i} and a signature.", "Guest card, {i}", "Bitte {i} aus dem Beitrag löschen.", "Ausweis: {i}", "Mon {i} figure sur le reçu.", "Papiers : {i}", "Su {i} aparece en la lista.", "पहचान: {i}", "Scanned: {i}", "Volunteer list, {i}",
    # addresses
    "Come by {a} after school.", "The shop moved to {a} last month.", "Shipping: {a}", "Parcels for us: {a}.", "They live in {a} now.", "Find the stall near {a}.", "Party at {a}, bring chairs.", "{a}", "Return labels show {a}.", "Unsere Küche: {a}", "Der Laden ist in der {a} zu finden.", "Notre boutique, {a}.", "Livraison : {a}", "Vivimos en {a} desde enero.", "Tienda: {a}", "ठिकाना {a}",
    # several
    "Reach {p} on {t}.", "{p}, {e}", "{p} <{e}>", "{p} – {t}", "{p}; {a}; {t}", "{p}\n{a}", "{p}\n{e}\n{t}", "Sender: {p}, {a}", "Host {p} lives at {a}, phone {t}.", "Questions go to {p} ({e}).", "Customer {p}, {i}, {t}", "Kontakt: {p}, {t}, {e}", "Contacter {p} : {t}", "Avisar a {p} ({t})", "{p} | {e} | {t}", "{i}, {p}", "{p} ({t}) has spare jars", "{p}, {a}",
]
HARMLESS = [
    "{D}", "{D}", "{C} {D}", "{D} with {D}", "{C}’s {D}", "{D} ({C} Version)", "{D} ({C} Edition)", "{C} {D} from {w}", "{D} à la {C}", "{C} and {C} {D}", "My {C} {D} was great.", "{D} / {C} {D}", "The {C} Bakery sells it.", "{w} Market opens early.", "In {w} they eat it cold.", "People of {w} add more {f}.", "Farmers near {w} harvest late.", "The {w} Festival starts soon.", "Made by {C} Foods.",
    "Parcel no. {9999-9999} got lost.", "Ref. {9999-9999}", "Batch code {A9999}", "Lot no. {2099-99-99}", "Barcode {9999999999999}", "EAN: {9999999999999}", "ISBN {999-9-99-999999-9}", "In print {1899}–{1999}, now rare.", "From {1999}-{2009} it was sold out.", "Steep for 5-10-15 hours.", "Mix 3:2:1 or {999}-{999}-{999} ml.", "{9 999} kJ / {999} kcal", "Contains {999} kcal per bar.", "Made {99/99/2099} by hand.", "Dated {2099}-{99}-{99}.", "Invoice {99999999}", "Article {99999999} is sold out.", "Page {99}, line {9}", "Model {A999}-{99}",
    "See {99} of {999}", "Set to {999} °C / {999} °F", "It weighs {9999} g", "Only @ {9.99} a kilo", "Thanks @{h}", "Ask @{h} about it", "Meet us at shop.example/menu", "See pots.example/{h} instead", "look at shop dot example", "{9} Road runners won.", "Take {99} Lane tickets.", "{99} Court sessions later it was legal.", "Wide Street-style wraps", "The Long Road Cafe is shut.", "First {D}, then {D}.", "Try {C} {f} or {C} {f}.", "Size {X}. Then stir.", "Grade {X}. Next stop {w}.", "Vitamin {X}. Good stuff.", "{f}, {f} and {f}", "{F}, {f}", "{F}, Raw", "{C} {f} powder",
    "Cheers {g}, as always.", "{g} said it was fine.", "Ask {g} first.", "{g}'s pan", "Saint {C} day", "Uncle {g} came late.", "Monday Morning {f}", "On {w} Hill it snowed.", "Add {f}, stir, and rest.", "Use less {f} next time.", "I like {f} and {f} together.", "Too much {f} spoils the {f}.", "Der {F} wird kalt.", "Das {F} in {w} war gut.", "In {w} gibt es {F} mit {F}.", "Die {F} Suppe kocht.", "Le {f} de {w} est doux.", "El {f} de {w} se vende poco.", "À {w}, on en fait une soupe.", "À {w}, c’est servi froid avec {f}.", "A {w} llega poco {f}.", "From {w}, with {f}.", "Ships to {w}, never to {w}.", "Nach {w}, dann weiter.", "{D}-{F}", "{C} {F}-{F}", "{C} Deep-{F}", "{C} Pan-Roast", "Shirt size {X}. We ship fast.", "Block {X}. Turn left.", "Cup size {X}. Mix it all.", "Team {X}. Stir it well.", "Plan {X}. The oven was cold.", "Hall {X}. Bring {f}.", "{w} में {f} मिलता है", "{f} डालें और मिलाएँ", "{9} {f}", "{99} g {f}", "- {9} {C} {f}", "Serves {9}-{9}.", "Score: {99} {99} {99} {99} {99}",
    "{L} {l} {l} {f} {l}.", "{L} {l} {C} {l} {l}.", "{L} {l} {w} {l} {l}.", "{l} {l} {w}.", "{L} {l} {l} {l} {D}.", "{C} {l} {l} {l}.", "{L} {f} {l} {l}.", "{w} {l} {l}.", "{u} {u} {C} {u}.", "{L} {u} {l} {C}.", "{L} {u} {u} {f}.", "{C} {u} {l} {u}.",
    "Weeks {99} {99} {99}", "Charge {99999} {99}", "Table {99}-{999}", "No. {9999999}", "Rated {9.9} by {999} readers", "{C} {C} {D}", "{D} in {w} Sauce", "Special: {C} {D}", "New {C} {D}!", "{w} {D}", "{C}-Style {D}", "{D} (after {C})", "Winter {D} for {C} Day",
]


class Maker:
    """One small corpus: its names, its frames and harmless look-alikes."""

    def __init__(self, seed: int, frames: list[str] = FRAMES, harmless: list[str] = HARMLESS, givens: list[str] | None = None, families: list[str] | None = None) -> None:
        self.r = random.Random(seed)
        some = self.r.sample(frames, max(1, len(frames) * 2 // 3)) if frames is FRAMES else frames
        self.frames, self.harmless = some, harmless
        self.givens = givens or [self.coin(self.r.randrange(1, 3), self.pick("a", "e", "o", "i", "an", "us", "el", "")) for _ in range(self.pick(12, 40, 40, 120, 600))]
        self.families = families or [self.coin(self.r.randrange(1, 3), self.pick(*_ENDS, "", "")) for _ in range(self.pick(25, 50, 300, 1500, 6000))]
        self.foods = [self.coin(self.r.randrange(1, 3), "").lower() for _ in range(60)]
        self.dishes = [self.coin(self.r.randrange(1, 3), "") for _ in range(25)]
        self.styles = [self.coin(self.r.randrange(1, 3), self.pick("y", "ed", "")) for _ in range(25)]
        self.places = [self.pick("", "New ", "Lower ", "East ", "") + self.coin(2, self.pick("ton", "burg", "dale", "")) + self.pick("", " Bay", " Coast") for _ in range(self.pick(4, 15, 40))]
        self.coined = [self.coin(self.r.randrange(1, 4), "") for _ in range(self.pick(20, 200, 2000))]
        self.streets = [self.coin(self.r.randrange(1, 3), "") for _ in range(20)]

    def pick(self, *xs):
        return self.r.choice(xs)

    def coin(self, syllables: int, end: str) -> str:
        return ("".join(self.pick(*_OPEN) + self.pick(*_VOWEL) + self.pick(*_CLOSE) for _ in range(syllables)) + end).capitalize()

    def digits(self, shape: str) -> str:
        return "".join(str(self.r.randrange(10)) if c == "9" else self.r.choice("ABCDEFGHJKLMNPRSTVXYZ") if c == "A" else c for c in shape)

    def family(self) -> str:
        f = self.pick(*self.families)
        return f + "-" + self.pick(*self.families) if self.r.random() < 0.06 else f

    def person(self) -> str:
        g, f, i = self.pick(*self.givens), self.family(), self.pick(*"ABCDEFGHIJKLMNOPRSTUVXYZÉÖ")
        form = self.r.random()
        part = self.pick("de", "von", "van", "dos", "al", "del", "de la", "van der")
        name = f"{g} {f}" if form < 0.55 else f"{g} {i}. {f}" if form < 0.62 else f"{i}. {f}" if form < 0.73 else f"{f}, {g}" if form < 0.85 else f"{g} {part} {f}" if form < 0.92 else f"{f} {g}" if form < 0.95 else f"{part} {f}, {g}" if form < 0.957 else f"{f}, {g} {i}."
        x = self.r.random()
        return name.upper() if x < 0.08 else name.lower() if x < 0.14 and ". " not in name and "," not in name else name

    def email(self) -> str:
        g, f, x = self.pick(*self.givens).lower(), self.pick(*self.families).lower(), self.pick(*self.foods)
        user = self.pick(f"{g}.{f}", f"{g[0]}{f}", f"{f}{self.r.randrange(999)}", f"{g}+{x}", f"{x}.{g}", f"{g}_{f}{self.r.randrange(99)}", f"{g}-{f}", g, f"{x}_{x}")
        host = self.pick("example.org", "post.example", f"{x}.test", f"mail.{x}.invalid", "web.example.net", f"{x}-{f}.example")
        *head, last = host.split(".")
        form = self.r.random()
        if form < 0.55:
            return (f"{user}@{host}").upper() if form < 0.07 else f"{user}@{host}"
        if form < 0.65:
            return f"{user} @ {host}"
        if form < 0.77:
            at, dot = self.pick(("(at)", "(dot)"), (" [at] ", " [dot] "), (" {at} ", " {dot} "), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" AT ", " DOT "))
            return f"{user}{at}{dot.join(head)}{dot}{last}"
        if form < 0.87:
            return f"{user} at {'.'.join(head)} dot {last}"
        return f"{user}{self.pick(' {at} ', ' [at] ', ' (at) ', '(at)')}{host}"

    def phone(self) -> str:
        shape = self.pick(
            "+9-999-999-9999", "+9 (999) 999-9999", "(099) 9999 9999", "+99 99 9999 9999", "00 99 999 9999999", "00999999999999", "09999 999999", "09999 999 999", "999-9999", "999.999.9999", "+99 999 999 999", "+99 99 99999 999", "099/9999999", "09.99.99.99.99", "09 99 99 99 99", "0999-9999 999", "+99 99999 99999", "+99 9999 999999", "(999) 999-9999", "+99 9 99 99 99 99", "0999 999999", "999-999-9999",
            "+99 (9) 999 99 99", "+99 (0)99 9999999", "+9 999 999 9999", "999 999 9999", "999 99 99 99", "+99.999.999.999", "099 9999 9999", "(09999) 999999", "099-9999999", "+999 99 999 99 99", "(999)999-9999",
        )
        return self.digits(shape) + (f"{self.pick(' ext. ', ' ext ', ' x', ' extension ', ' poste ')}{self.r.randrange(10, 9999)}" if self.r.random() < 0.08 else "")

    def id_number(self) -> str | tuple[str, str]:
        cue, shape = self.pick(
            ("SSN", "999-99-9999"), ("Social Security", "999 99 9999"), ("Aadhaar", "9999 9999 9999"), ("aadhaar number", "9999-9999-9999"), ("UID", "999999999999"), ("Steuer-ID", "99 999 999 999"), ("tax id", "99999999999"), ("DNI", "99999999-A"), ("NIF", "99999999A"), ("passport", "AA 999999"), ("Reisepass", "A9999999"), ("passport number", "AA9999999"), ("licence", "AA99-9999999"),
            ("insurance number", "AA 99 99 99 A"), ("NINO", "AA999999A"), ("PAN", "AAAAA9999A"), ("NIE", "A9999999A"), ("sécurité sociale", "9 99 99 99 999 999 99"), ("passport no.", "999999999"), ("license", "A9999999"),
        )
        x = self.r.random()
        return ("" if x < 0.25 else cue + self.pick(" ", ": ", " no. ", " ", " no: "), self.digits(shape))

    def address(self) -> str:
        n, town, name = self.r.randrange(1, 400), self.pick(*self.places), self.pick(*self.streets)
        code = self.digits(self.pick("AA99 9AA", "A9 9AA", "99999", "- 999999"))
        form = self.r.random()
        if form < 0.55:
            unit = self.pick("", "", "", "Flat 7, ", "Apt 31, ", "Suite 6, ", "Flat 1A, ", "Room 9, ")
            street = f"{unit}{n}{self.pick('', '', 'C', '/2')} {self.pick('', 'North ', 'St. ', 'Great ')}{name} {self.pick('Street', 'St', 'Road', 'Rd', 'Avenue', 'Ave', 'Lane', 'Drive', 'Row', 'Court', 'Close', 'Way', 'Terrace', 'Square')}"
            return street + self.pick("", f", {town}", f", {town} {code}", f", {town}, {code}")
        if form < 0.68:
            return f"{self.pick('P.O. Box', 'PO Box', 'P.O.Box', 'Postfach', 'Apartado')} {n * 13}" + self.pick("", f", {town}", f" {town}", f", {town} {code}")
        if form < 0.79:
            return f"{n}{self.pick('', ' bis', ',')} {self.pick('rue', 'chemin', 'allée', 'avenue', 'quai')} {self.pick('du ', 'de la ', 'des ', '')}{name}" + self.pick("", f", {self.digits('99999')} {town}", f", {town}")
        if form < 0.9:
            return f"{self.pick('C/', 'C/ ', 'Calle ', 'Avenida ', 'Plaza ')}{self.pick('', 'del ', 'de la ')}{name}, {n}" + self.pick("", ", 3º A") + self.pick("", f", {self.digits('99999')} {town}", f", {town}")
        return f"{name}{self.pick('weg', 'straße', 'str.', 'gasse', 'platz')} {n}{self.pick('', 'b')}" + self.pick("", f", {self.digits('99999')} {town}")

    def fill(self, slot: str) -> str:
        if slot == "D":
            return f"{self.pick(*self.styles)} {self.pick(*self.dishes)}" if self.r.random() < 0.5 else f"{self.pick(*self.styles)} {self.pick(*self.coined)} {self.pick(*self.dishes)}"
        if slot in ("C", "w", "f", "g"):
            return self.pick(*{"C": self.coined, "w": self.places, "f": self.foods, "g": self.givens}[slot])
        if slot in ("l", "L"):
            return self.pick(*_PLAIN) if slot == "l" else self.pick(*_PLAIN).capitalize()
        if slot == "u":  # a word that hardly comes again
            return self.coin(self.r.randrange(1, 4), "").lower()
        if slot == "F":
            return self.pick(*self.foods).capitalize()
        if slot == "X":
            return self.pick(*"ABCDK")
        return self.pick(*self.foods) + self.pick("_", "") + self.pick(*self.foods) if slot == "h" else self.digits(slot)

    def text(self) -> tuple[str, list[tuple[int, int, str]]]:
        """A text with its spans."""
        kinds = {"p": ("person", self.person), "e": ("email", self.email), "t": ("phone", self.phone), "a": ("address", self.address), "i": ("id_number", self.id_number)}
        out, spans = "", []
        for n in range(self.r.randrange(1, 6)):
            if n:
                out += self.pick(" ", " ", " ", "\n", "\n\n")
            for part in re.split(r"(\{[^{}]+\})", self.pick(*(self.harmless if self.r.random() < 0.55 else self.frames))):
                slot = part[1:-1] if part[:1] == "{" else ""
                if slot in kinds:
                    kind, make = kinds[slot]
                    cue, value = got if isinstance(got := make(), tuple) else ("", got)
                    out += cue
                    spans.append((len(out), len(out) + len(value), kind))
                    out += value
                else:
                    out += self.fill(slot) if slot else part
        return out, spans


def _log_add(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a + math.log1p(math.exp(b - a)) if b > -math.inf else a


def marginals(spans: list[Span], scores: list[float]) -> tuple[float, list[float]]:
    """log Z over all sets of spans without overlap, and each span's probability."""
    order = sorted(range(len(spans)), key=lambda i: (spans[i].end, spans[i].start))
    ends = [spans[i].end for i in order]
    before = [bisect.bisect_right(ends, spans[i].start, 0, n) for n, i in enumerate(order)]
    forward = [0.0]
    for n, i in enumerate(order):
        forward.append(_log_add(forward[n], forward[before[n]] + scores[i]))
    outside = [-math.inf] * (len(order) + 1)
    outside[-1] = 0.0
    probability = [0.0] * len(spans)
    for n in range(len(order) - 1, -1, -1):
        i, out = order[n], outside[n + 1]
        probability[i] = math.exp(min(0.0, out + forward[before[n]] + scores[i] - forward[-1]))
        outside[n] = _log_add(outside[n], out)
        outside[before[n]] = _log_add(outside[before[n]], out + scores[i])
    return forward[-1], probability


def train(texts: int = TEXTS, rounds: int = ROUNDS, seed: int = SEED) -> dict[str, float]:
    """Weights of greatest likelihood with a ridge, by Adam over shuffled texts."""
    index: dict[str, int] = {}
    data = []
    for world in range(WORLDS):
        maker = Maker(seed * 1000 + world)
        made = [maker.text() for _ in range(texts // WORLDS)]
        classes = local_classes(t for t, _ in (made if world % 7 else made[:100]))
        for text, gold in made:
            spans = candidates(text, classes)
            if not spans:
                continue
            rows = [np.array(sorted({index.setdefault(f, len(index)) for f in features(text, s, classes, w)})) for s, w in zip(spans, contained(spans), strict=True)]
            left = {(a, b, k) for a, b, k in gold}
            truth = []
            for s in spans:  # a span proposed in two shapes counts once
                truth.append(float(s[:3] in left))
                left.discard(s[:3])
            data.append((spans, rows, np.array(truth)))
    w, m, v = (np.zeros(len(index)) for _ in range(3))
    rng, step = np.random.default_rng(seed), 0
    for k in range(rounds):
        order = rng.permutation(len(data))
        for start in range(0, len(order), 64):
            g = RIDGE * w
            for j in order[start : start + 64]:
                spans, rows, truth = data[j]
                _, p = marginals(spans, [float(w[r].sum()) for r in rows])
                for r, d in zip(rows, np.array(p) - truth, strict=True):
                    if d:
                        np.add.at(g, r, d / 64)
            step += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w -= 0.05 / (1 + k / 10) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return {f: round(float(w[i]), 3) for f, i in sorted(index.items()) if abs(w[i]) >= 0.01}


if __name__ == "__main__":
    WEIGHTS.write_text(json.dumps(train(), ensure_ascii=False, indent=0) + "\n")
