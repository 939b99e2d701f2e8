import random
from itertools import combinations

import pytest

from millrace.llm.pii import WEIGHTS, Classes, Span, _weights, candidates, contained, decode, features, find, local_classes, personal_spans, word_classes
from millrace.llm.pii_train import FRAMES, HARMLESS, Maker, marginals

W = _weights(str(WEIGHTS))
CLASSES = Classes({w: "l" for w in "salt butter soup with from and of for to the call write ask name chef thanks recipe by tip".split()} | {w: "c" for w in "street lane old mill bakery".split()})


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Write to ana.smith@example.org for it.", [("email", "ana.smith@example.org")]),
        ("mail: ana_7 [at] larder [dot] example", [("email", "ana_7 [at] larder [dot] example")]),
        ("or at the.pan.greta@example.com.", [("email", "the.pan.greta@example.com")]),
        ("Follow @thelazyladle. Sold @ 2.50/kg.", []),
        ("Call +1 (646) 555 0117 ext. 54 now", [("phone", "+1 (646) 555 0117 ext. 54")]),
        ("My number ((020) 7946 0987) changed", [("phone", "(020) 7946 0987")]),
        ("Order #8124-7972 arrived. Published 1998-2004.", []),
        ("They noted Passport No RX 946395 on the form.", [("id_number", "RX 946395")]),
        ("Please delete my 00474864-E from the thread!", [("id_number", "00474864-E")]),
        ("We meet at Flat 4, 382 Lantern Row, Pellamwick QX22 2ZV on Sunday.", [("address", "Flat 4, 382 Lantern Row, Pellamwick QX22 2ZV")]),
        ("5 Lane swimmers ate 40 wraps.", []),
        ("Thanks to Greta Halmond for the tip.", [("person", "Greta Halmond")]),
        ("Thanks to Halmond, Greta for the tip.", [("person", "Halmond, Greta")]),
        ("Recipe by J. Halmond.", [("person", "J. Halmond")]),
        ("The Old Mill Bakery uses butter.", []),
        ("", []),
        (None, []),
    ],
)
def test_spans(text, want):
    assert [(s.kind, text[s.start : s.end]) for s in find(text, W, CLASSES)] == want


def test_decode_is_best():
    r = random.Random(1)
    for _ in range(200):
        spans = sorted({Span(a, a + r.randrange(1, 6), "x", str(i)) for i in range(8) for a in [r.randrange(15)]})
        scores = [r.uniform(-1, 2) for _ in spans]
        value = dict(zip(spans, scores, strict=True))

        def free(c):
            return all(a.end <= b.start or b.end <= a.start for a, b in combinations(c, 2))

        best = max(sum(value[s] for s in c) for n in range(len(spans) + 1) for c in combinations(spans, n) if free(c))
        got = decode(spans, scores)
        assert free(got) and abs(sum(value[s] for s in got) - best) < 1e-9


def test_marginals_sum_over_all_sets():
    import math

    r = random.Random(2)
    for _ in range(50):
        spans = sorted({Span(a, a + r.randrange(1, 6), "x", str(i)) for i in range(6) for a in [r.randrange(10)]})
        scores = [r.uniform(-2, 2) for _ in spans]
        sets = [c for n in range(len(spans) + 1) for c in combinations(range(len(spans)), n) if all(spans[a].end <= spans[b].start or spans[b].end <= spans[a].start for a, b in combinations(c, 2))]
        mass = [math.exp(sum(scores[i] for i in c)) for c in sets]
        z, p = marginals(spans, scores)
        assert abs(z - math.log(sum(mass))) < 1e-9
        for i in range(len(spans)):
            assert abs(p[i] - sum(m for m, c in zip(mass, sets, strict=True) if i in c) / sum(mass)) < 1e-9


# Sentences and names that neither the training texts nor the test tables hold.
SAID = [
    "We are grateful to {p} for lending the mixer.", "Last night {p} fried the plantains twice.", "Rumour has it that {p} owns a secret grill.", "Kudos to {p} and {p} for organising it.", "An evening with {p} at the stove.", "Mr {p} opened a café here.", "It was {p} who spilled the stock.", "Nobody except {p} liked the olives.", "Letter to {p}:", "Illustrated by {p}.", "Editor: {p}", "Cheers,\n{p}", "{p} says it keeps for months.",
    "Even {p} asked for seconds.", "Doctor {p} warned about raw beans.", "The stall of {p} sold out.", "Das Brot von {p} war knusprig.", "Fragen wir doch {p} nach dem Ofen.", "Liebe Grüße, {p}", "On doit ce plat à {p}, je crois.", "Bises, {p}", "Dicen que {p} cocina con leña.", "Besos, {p}", "कल {p} घर आए थे",
    "Ping me: {e}", "Our inbox {e} is full.", "Send a postcard or {e}, whichever suits.", "Schreib doch mal {e} an.", "Mi correo: {e}", "Pick up the phone, {t} works all day.", "Landline {t}", "Voicemail on {t} only.", "Ruf an: {t}", "Mon portable : {t}", "Catering desk {t}, ask for prices.", "Passenger with {i} left a cake box.", "Her {i} leaked in the chat.", "Scan shows {i}.", "Party moved over to {a} tonight.", "The pantry at {a} has spare flour.", "Bring it to {a}.", "Unser Hof: {a}", "Le four, {a}.",
    "{p}, {t}", "{p} / {e}", "Caterer {p}, {a}", "{p} ({t})",
]
UNSAID = [
    "{D}", "{D} with {D}", "Nothing beats {f} on rainy days.", "We ate {f} and {f} near {w}.", "Grown around {w}, sold as {f}.", "Tracking code {9999-9999}.", "Seen in {1999}-{2009} menus.", "Boil it for 7-9-11 minutes.", "Weighs {999} g, costs {9.9} euro.", "Dial the heat down to {99}.", "Receipt {99999999} is lost.", "The {C} Tavern closed.", "{C}’s {D}", "On {99/99/2099} it rained.", "Der {F} Auflauf gelingt immer.", "Follow @{h}!", "Total energy {999} kcal.", "Ich mag {F} mit {F}.", "Le {f} brûle vite.", "Falta {f}, sobra {f}.",
]
FIRST = "Bogdan Aoife Thabo Keiko Lindiwe Casimir Oluwaseun Tariq Signe Wanjiru Eirlys Goran Haruto Ximena Piotr Nkechi Ronan Svetlana Tuan Ulrika Vusi Yevgeny Zsofia Malakai Ngaire Dorotea Fergus Ilse Kwabena Lorcan".split()
LAST = "Kowalczyk Gallagher Nkosi Yamamoto Diallo Whitcombe Petrov O’Rourke Achterberg Szabo Mwangi Lindqvist Haugen Castellanos Brzezinski Okonkwo Featherstone Nakashima Vuković Trelawney Abernathy Mbeki Thorvaldsen Iyer Papadakis Zielinski McAllister Rautavaara Dubois Eszterhas".split()


def test_held_out_frames_and_names():
    """Sentences and names that the training never saw: at least nine tenths found, nine tenths right, of persons and of all."""
    learnt = " ".join(FRAMES + HARMLESS).lower()
    assert not [w for w in FIRST + LAST if w.lower() in learnt]
    assert not set(SAID) & set(FRAMES)
    maker = Maker(777, SAID, UNSAID, FIRST, LAST)
    made = [maker.text() for _ in range(2000)]
    classes = local_classes(t for t, _ in made)
    for kinds in ({"person"}, {"phone", "email", "address", "id_number", "person"}):
        hit = said = true = 0
        for text, gold in made:
            want = {(k, text[a:b]) for a, b, k in gold if k in kinds}
            got = {(s.kind, text[s.start : s.end]) for s in find(text, W, classes) if s.kind in kinds}
            hit, said, true = hit + len(want & got), said + len(got), true + len(want)
        assert hit / said > 0.9 and hit / true > 0.9, (kinds, hit / said, hit / true)


def test_unknown_names_need_no_list():
    said = ["Thanks to {} for the tip.", "I met {} at the fair.", "Our friend {} brought dumplings.", "We are grateful to {} for this."]
    classes = Classes(CLASSES | {w: "l" for w in "i met at fair our friend brought dumplings we are grateful this".split()})
    for frame in said:
        for name in ("Bogdan Kowalczyk", "Aoife Gallagher", "Mei-Ling Wong", "Bartholomew O’Rourke", "J. Whitcombe", "Nkemelu, Chidi"):
            text = frame.format(name)
            assert [text[s.start : s.end] for s in find(text, W, classes) if s.kind == "person"] == [name], text


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("01 23 45 67 89 06 12 34 56 78", {"01 23 45 67 89", "06 12 34 56 78"}),
        ("2 0171 2345678", {"0171 2345678"}),
        ("(+1 646 555 0117)", {"+1 646 555 0117"}),
        ("(+1 (646) 555 0140 ext. 60)", {"+1 (646) 555 0140 ext. 60"}),
        ("(020) 7946 0987", {"(020) 7946 0987"}),
    ],
)
def test_every_part_of_a_run_of_digits_is_proposed(text, want):
    assert want <= {text[s.start : s.end] for s in candidates(text, Classes()) if s.kind == "phone"}


def test_long_mailbox():
    """No span is too long."""
    for n in (100, 161, 5000):
        mail = "a" * n + "@example.org"
        assert [(s.kind, s.end - s.start) for s in find(f"Mail {mail} now", W, CLASSES)] == [("email", n + 12)]


def test_contained():
    r = random.Random(4)
    for _ in range(200):
        spans = sorted({Span(a, a + r.randrange(1, 8), r.choice("xy"), str(i)) for i in range(9) for a in [r.randrange(12)]})
        want = [any(o.kind == s.kind and o.start <= s.start and s.end <= o.end and o[:2] != s[:2] for o in spans) for s in spans]
        assert contained(spans) == want


def test_word_classes(spark):
    texts = [f"then Ada {x} ate soup." for x in ("Aaa", "Bbb", "Ccc", "Ddd", "Eee")] + ["The soup of Old Town, in Old Town"] * 3 + ["soup for ana@soup.example", None, ""]
    got = word_classes(spark.createDataFrame([(t,) for t in texts], "t string"), "t")
    assert got == local_classes(t for t in texts if t) and got["ada"] == "g" and got["soup"] == "l" and got["town"] == "c"
    assert "aaa" not in got and "ana" not in got


def test_table(spark):
    df = spark.createDataFrame([(1, "Mail ana@example.org or ana@example.org!", 0, "x"), (2, None, 0, "x"), (3, "", 0, "x"), (1, "plain", 0, "x")], "doc_id bigint, text string, spans int, redacted string")
    got = {(r["doc_id"], r["redacted"], len(r["spans"])) for r in personal_spans(df).collect()}
    assert got == {(1, "Mail [EMAIL] or [EMAIL]!", 2), (2, None, 0), (3, "", 0), (1, "plain", 0)}
    assert personal_spans(df.limit(0)).count() == 0


def test_very_long():
    text = "Stir the soup, 12 20 31. " * 20_000 + "Mail ana@example.org now. " + "a" * 100_000 + " " + "7 " * 50_000 + "12 " * 5_000
    assert ("email", "ana@example.org") in [(s.kind, text[s.start : s.end]) for s in find(text, W, CLASSES)]
    assert candidates("x", Classes()) == [] and features("Call 555-0148", Span(5, 13, "phone", "whole"), Classes())
