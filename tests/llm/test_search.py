"""Benchmark passages, personal data."""

from __future__ import annotations

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import collected, frame  # noqa: F401

from salesmart.llm import decontamination, pii

WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(docs, items):
    words = lambda t: WORDS.findall((t or "").encode().lower())
    patterns = {}
    for i, t in items:
        w = words(t)
        if i is None:
            continue
        for p in [tuple(w)] if 0 < len(w) < 10 else [tuple(w[k : k + 10]) for k in range(len(w) - 9)]:
            patterns.setdefault(p, set()).add(str(i))
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(p) for p in patterns}:
            for a in range(len(w) - n + 1):
                if tuple(w[a : a + n]) in patterns:
                    hit |= set(range(a, a + n))
                    found |= patterns[tuple(w[a : a + n])]
        out.append((i, len(w), len(hit), len(found), sorted(found)))
    return sorted(out, key=repr)


def sample():
    rng = random.Random(2)
    text = lambda n: " ".join(rng.choice(["a", "bb", "çé", "d4", "E"]) for _ in range(n))
    items = [(k, text(rng.randrange(8, 30))) for k in range(20)] + [(30, "one"), (31, "Two, words"), (32, ""), (33, None), (None, text(20)), (34, "!!!"), (2, text(12)), (9, "b " * 40)]
    items.append((40, items[0][1]))
    docs = [(k, text(rng.randrange(0, 700))) for k in range(60)] + [(60, None), (61, ""), (62, "one"), (62, "one"), (None, "two; WORDS"), (63, "b " * 3000), (64, "tw\x00o words")]
    docs += [(70 + k, text(40) + " " + (items[k][1] or "") + " " + text(10)) for k in range(25)]
    return docs, items


@pytest.mark.parametrize("round_bytes", [decontamination.ROUND_BYTES, 400])
def test_benchmark_words(frame, round_bytes):
    docs, items = sample()
    found = decontamination.contamination(frame(docs), frame(items, "item_id long, text string", 1), round_bytes=round_bytes)
    assert [(*r[:4], list(r[4])) for r in collected(found)] == brute(docs, items)


def test_other_columns_stay(frame):
    docs = frame([(1, "one", "x", 4)], "doc_id long, text string, hit_spans string, n_words int")
    found = decontamination.contamination(docs, frame([(1, "one")], "item_id long, text string"), keep=docs.columns, names=("w", "h", "i", "l"), round_bytes=1)
    assert [tuple(r) for r in found.collect()] == [(1, "one", "x", 4, 1, 1, 1, ["1"])]


def test_no_items_or_rows(frame):
    none = frame([], "item_id long, text string")
    assert [r[1:4] for r in collected(decontamination.contamination(frame([(1, "a b")]), none))] == [(2, 0, 0)]
    assert decontamination.contamination(frame([]), none).count() == 0


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain(text):
    out = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"\D", "", m[0])
            good = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 12 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), order, kind, m.end()))
    return [(k, a, b) for a, _, k, b in sorted(out)]


def base(text):
    return [(s["kind"], s["start"], s["end"]) for s in pii.find(text) if s["base"]]


TEXTS = ["", "a@b.c x@y.z@q.w", "@@a@b..c a.b+c%d@e-f.g.h. é@x.yz", "1.2.3.4.5.6.7.8 256.1.1.1 1.2.3 00001.002.3.4 1.2.3.4444", "4111 1111 1111 1111 4111-1111-1111-1112",
         "call +1 (555) 010-9999 or +49.30.1234567 ++1 2 +12", "1" * 5000, "+1(((((" * 500, "x" * 5000 + "@", "a@" * 2000, "9" * 4000 + ".1.1.1"]


@pytest.mark.parametrize("text", TEXTS)
def test_base_spans(text):
    assert base(text) == plain(text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1 2.@-+(5é%4", max_size=60))
def test_base_spans_of_any_text(text):
    assert base(text) == plain(text)


def test_more_kinds_and_scores():
    found = pii.find("IBAN DE89 3704 0044 0532 0130 00 and SSN 078-05-1120, code 078-05-1120" + " x" * 40 + " 219-09-9999, DE89 3704 0044 0532 0130 01")
    assert [(s["kind"], s["base"]) for s in found if s["kind"] in ("iban", "ssn")] == [("iban", False), ("ssn", False), ("ssn", False)]
    assert pii.mod97("GB82WEST12345698765432")
    near, far = pii.find("mail a@b.cd")[0]["score"], pii.find("x a@b.cd")[0]["score"]
    assert near > far
    assert pii.masked("to a@b.cd!", pii.find("to a@b.cd!")) == "to <email>!"


DE, GB = "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32"


@pytest.mark.parametrize("text, found", [
    (f"{DE} {GB}", [DE, GB]), (f"{DE} {DE} {GB}", [DE, DE, GB]), (f"AB12 {DE}", [DE]), (f"GB82 {DE}", [DE]), (f"DE00 1234 {GB} {DE}", [GB, DE]),
    (f"{DE} 1234", [DE]), (DE.replace(" ", "") + " " + GB.replace(" ", ""), [DE.replace(" ", ""), GB.replace(" ", "")]), (f"x{DE}", []), (DE[:-1] + "1", []),
])
def test_adjacent_and_prefixed_account_numbers(text, found):
    assert [text[s["start"] : s["end"]] for s in pii.find(text) if s["kind"] == "iban"] == found


# examples of the IBAN registry
@pytest.mark.parametrize("text", [
    "BG80BNBG96611020345678", "HR1210010051863000160", "CY17002001280000001200527600", "EE382200221020145685", "LV80BANK0000435195001", "LT121000011101001000",
    "MT84MALT011000012345MTLCAST001S", "SI56263300012039086", "IS140159260076545510730339", "TR330006100519786457841326", "SA0380000000608010167519", "AE070331234567890123456", "NO9386011117947"])
def test_account_numbers_of_other_countries(text):
    assert [(s["kind"], s["start"], s["end"]) for s in pii.find(f"to {text}.") if not s["base"]] == [("iban", 3, 3 + len(text))]


def test_pii_rows(frame):
    docs = frame([(1, None, 0), (2, "", 0), (None, "é a@b.cd", 0), (3, "a@b.cd", 1), (3, "a@b.cd", 1), (4, "y " * 200_000 + "a@b.cd", 0)], "doc_id long, text string, pii int")
    found = [(i, [(s.kind, s.start, s.end) for s in spans]) for i, spans in collected(pii.find_pii(docs))]
    assert found == [(1, []), (2, []), (3, [("email", 0, 6)]), (3, [("email", 0, 6)]), (4, [("email", 400000, 400006)]), (None, [("email", 2, 8)])]
    assert pii.find_pii(docs.limit(0)).count() == 0
