"""Registered queries without SQL: whole results against brute force on a small table."""

import hashlib
import random
import re
import string
import zlib
from collections import Counter

import pytest

import __spark_entry__ as entry
from layerhouse.llm import pii
from layerhouse.llm.registry import QUERIES

WORDS_OF = {"en": "the and ing of hand over house", "de": "der und ein schaf ich haus über", "fr": "le la être maison où nous"}
BLANK = r"[^\x20\x09-\x0D]+"


def test_oracle_entries_are_sql():
    given = entry.oracle_sql()
    assert all(isinstance(sql, str) for sql in given.values())
    assert not {"op2_minhash", "op3_language_id", "op4_pii"} & set(given)


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    rng = random.Random(12)
    docs = []
    for i in range(160):
        lang = rng.choice(list(WORDS_OF))
        words = [rng.choice(WORDS_OF[lang].split()) + rng.choice(["", "s", "en", "x"]) for _ in range(rng.randint(8, 60))]
        if i % 4 == 0:
            words.insert(3, rng.choice(["a.b@c.example.org", "10.0.0.1", "300.1.1.1", "4111 1111 1111 1111", "+1 (619) 555-1368"]))
        docs.append((i, " ".join(words), lang if i % 7 else None))
    docs += [(200 + i, docs[i][1] + rng.choice(["", " tail", "\n"]), "en") for i in range(30)]
    docs += [(300, None, "en"), (301, "", None), (302, "12 345 !", "de"), (303, "one Two", "en"), (304, "ONE two", "en")]
    folder = str(tmp_path_factory.mktemp("registered"))
    spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3).write.parquet(f"{folder}/documents.parquet")
    return folder, docs


def shingles(text):
    words = re.findall(BLANK, (text or "").translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_near_copies_of_the_query(spark, table):
    folder, docs = table
    sets, group = {d: shingles(t) for d, t, _ in docs}, {d: d for d, _, _ in docs}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((group[a], group[b]))
                group = {d: low if g == high else g for d, g in group.items()}
    got = {r["doc_id"]: tuple(r) for r in QUERIES["op2_minhash"](spark, folder).select(
        "doc_id", "n_shingles", "component_id", "kept").collect()}
    assert got == {d: (d, len(sets[d]), group[d], group[d] == d) for d in sets}
    assert len(set(group.values())) < len(docs)


def grams(text):
    found = Counter()
    for word in "".join(c if c.isalpha() else " " for c in (text or "").lower()).split():
        framed = f" {word} "
        found.update(framed[i:i + n] for n in (1, 2, 3) for i in range(len(framed) - n + 1) if framed[i:i + n] != " ")
    return found


def place_of_ties(gram):
    """The stated order of equally frequent n-grams: by their hash."""
    bits = (1 << 64) - 1
    x = 0
    for c in gram:
        x = (x << 21 | ord(c)) & bits
    x = (x + 8 * 0x9E3779B97F4A7C15) & bits
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & bits
    x = (x ^ x >> 27) * 0x94D049BB133111EB & bits
    return (x ^ x >> 31) >> 20


def ranks(counts):
    """The 400 first n-grams; equally frequent ones share their mean place."""
    order = sorted(counts, key=lambda g: (-counts[g], place_of_ties(g)))
    places = {}
    for place, gram in enumerate(order):
        places.setdefault(counts[gram], []).append(place)
    return {g: min(sum(p) / len(p), 400) for g in order[:400] for p in [places[counts[g]]]}


def test_languages_of_the_query(spark, table):
    folder, docs = table
    held = {d: zlib.crc32(str(d).encode()) % 4 == 2 for d, _, _ in docs}
    told = {}
    for d, text, lang in docs:
        if lang and not held[d] and grams(text):
            told.setdefault(lang, Counter()).update(grams(text))
    profiles = {lang: {g: n for n, g in enumerate(sorted(c, key=lambda g: (-c[g], place_of_ties(g)))[:400])} for lang, c in told.items()}
    got = {r["doc_id"]: r for r in QUERIES["op3_language_id"](spark, folder).collect()}
    assert len(got) == len(docs)
    for d, text, _ in docs:
        own, r = ranks(grams(text)), got[d]
        assert r["held_out"] == held[d]
        if not own:
            assert (r["lang_pred"], r["score"]) == ("und", 0)
            continue
        far = {lang: sum(abs(p[g] - n) if g in p else 400 for g, n in own.items()) / (400 * len(own)) for lang, p in profiles.items()}
        near, second = sorted([*far.values(), 1.0])[:2]
        assert far[r["lang_pred"]] == pytest.approx(near)
        assert r["score"] == pytest.approx(second / max(near + second, 1e-12))


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+){3}",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    found = []
    for n, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                    "card": lambda: 14 <= len(digits) <= 19 and pii.luhn(digits), "phone": lambda: 10 <= len(digits) <= 15}[kind]():
                found.append((m.start(), n, m.end(), kind))
    return [(kind, s, e) for s, _, e, kind in sorted(found)]


def test_personal_data_of_the_query(spark, table):
    folder, docs = table
    got = {r["doc_id"]: r for r in QUERIES["op4_pii"](spark, folder).collect()}
    assert len(got) == len(docs)
    for d, text, _ in docs:
        spans, r = [f"{k}:{s}:{e}" for k, s, e in plain_spans(text)], got[d]
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(x.startswith(k) for x in spans) for k in pii.KINDS]
        assert r["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert set(spans) <= set(filter(None, r["spans"].split(",")))
    assert sum(r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"] for r in got.values()) > 20
