"""The tagger over whole texts, and spans however they are written."""

import random

import pytest

from layerhouse.llm import pii

WIDE = str.maketrans("0123456789@", "０１２３４５６７８９＠")
ARABIC = str.maketrans("0123456789", "٠١٢٣٤٥٦٧٨٩")


@pytest.fixture(scope="module")
def trained(spark):
    rng = random.Random(21)
    word = lambda: "".join(rng.choice(["an", "the", "or", "ing", "ly", "at"]) for _ in range(rng.randint(1, 3)))

    def prose(n):
        return " ".join(word() for _ in range(n))

    make = {"email": lambda: f"{word()}.{word()}@{word()}.example.com", "ip": lambda: ".".join(str(rng.randint(1, 255)) for _ in range(4))}
    docs = [(i, f"{prose(20)} {make[k]()} {prose(12)} {rng.randint(1, 2100)} {prose(9)}") for i, k in enumerate(list(make) * 500)]
    return pii.learn(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)), make, prose


FORMS = {
    "upper": ("email", lambda t: t.replace("@", " (AT) ")),
    "words": ("email", lambda t: t.replace("@", " at ").replace(".", " dot ").replace(" dot ", ".", 1)),
    "wide sign": ("email", lambda t: t.translate(WIDE)),
    "wide digits": ("ip", lambda t: t.translate(WIDE)),
    "other digits": ("ip", lambda t: t.translate(ARABIC)),
    "brackets": ("ip", lambda t: t.replace(".", "[.]")),
}


@pytest.mark.parametrize("form", FORMS)
def test_forms_that_avoid_the_patterns_are_found(trained, form):
    net, make, prose = trained
    kind, write = FORMS[form]
    texts = []
    for _ in range(60):
        before, own = prose(12), write(make[kind]())
        texts.append((f"{before} {own} {prose(12)}", (len(before) + 1, len(before) + 1 + len(own), kind)))
    found = pii.all_spans(net, [t for t, _ in texts])
    assert not any(base for base, _ in found)
    assert sum(any(k == kind and s < want[1] and e > want[0] for s, e, k in spans)
               for (_, want), (_, spans) in zip(texts, found, strict=True)) >= 45
    assert pii.all_spans(net, [prose(80) for _ in range(40)]) == [([], [])] * 40


def test_the_windows_that_are_run_give_the_spans_of_all(trained):
    net, make, prose = trained
    rng = random.Random(3)
    texts = ["", "x", "7", "at"]
    for n in range(120):
        parts = [prose(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 4)):
            kind, write = rng.choice(list(FORMS.values()))
            long = "x" * rng.choice([0, 0, 20, 90]) if kind == "email" else ""
            parts += [long + write(make[kind]()), prose(rng.randint(0, 40))]
        texts.append(" ".join(parts))
    some = pii.tagged_spans(net, texts)
    assert some == pii.tagged_spans(net, texts, everywhere=True) and sum(map(len, some)) > 60


def test_validity_is_judged_by_the_plain_form():
    for kind, text in (("email", "name (AT) host.de"), ("email", "name at host dot com"), ("email", "name@host.de"),
                       ("ip", "1[.]2[.]3[.]4"), ("ip", "1 dot 2 dot 3 dot 4")):
        assert pii.valid(kind, text) and pii.SIGN.search(text)
    assert not pii.valid("email", "meet me at home") and not pii.valid("ip", "1[.]2[.]3[.]999")
    assert pii.folded("é １２＠ ٣") == "é 12@ 3"
