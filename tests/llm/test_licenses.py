"""Licence templates and phrases against regular expressions and plain Python."""

from __future__ import annotations

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import SMALL, collected, frame  # noqa: F401

from salesmart.llm import licenses, queries
from salesmart.llm.license_texts import TEMPLATES


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_base(text):
    words = plain_words(text)
    places = [(p, label) for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
              for p in range(len(words)) if words[p : p + len(phrase.split())] == phrase.split()]
    starts = [p for p, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), sorted({label for _, label in places})


def as_regex(markup):
    """The template as a regular expression over words that each end with a space."""
    parts = licenses._MARK.split(markup)
    out = []
    wording = lambda t: "".join(re.escape(w.decode()) + " " for w in licenses.words_of(t))
    for k, piece in enumerate(parts):
        if k % 2 == 0:
            out.append(wording(piece))
        elif piece == "beginOptional":
            out.append("(?:")
        elif piece == "endOptional":
            out.append(")?")
        else:
            given = dict(re.findall(r'(\w+)="([^"]*)"', piece))
            out.append("(?:" + "|".join(wording(w) for w in given["match"].split("|")) + ")" if "match" in given else "(?:[^ ]+ ){%s,%s}" % tuple(given["words"].split("-")))
    return re.compile("(?<![^ ])" + "".join(out))


def written_out(markup, rng):
    """One text that a template accepts."""
    def fill(m):
        given = dict(re.findall(r'(\w+)="([^"]*)"', m[1]))
        if "match" in given:
            return rng.choice(given["match"].split("|"))
        least, most = map(int, given["words"].split("-"))
        return " ".join(rng.choice(["Jane", "Doe", "inc", "2020"]) for _ in range(rng.randint(least, most)))

    text = re.sub(r"<<beginOptional>>(.*?)<<endOptional>>", lambda m: m[1] if rng.random() < 0.5 else "", markup, flags=re.DOTALL)
    return re.sub(r"<<(var;.*?)>>", fill, text)


@pytest.mark.parametrize("number", range(len(TEMPLATES)))
def test_each_template_accepts_its_wording_only(number):
    rng = random.Random(number)
    label, markup = TEMPLATES[number]
    automaton = licenses.compile_template(label, markup)
    for _ in range(5):
        text = written_out(markup, rng)
        words = licenses.words_of(text)
        end, far = automaton.run(words + [b"and", b"more"])
        assert end >= len(words) and far < 1
        mandatory = [i for i, w in enumerate(words) if w in {automaton.word[p] for p in range(len(automaton.word))} and w not in (b"jane", b"doe")]
        broken = list(words)
        broken[mandatory[-1]] += b"x"
        assert automaton.run(broken)[0] < len(words)


MARKUPS = ["a <<beginOptional>>b<<endOptional>> c", 'a <<var;name="x";words="0-2">> b', 'a b <<var;name="x";words="1-2">> <<beginOptional>>c <<beginOptional>>d<<endOptional>><<endOptional>> e',
           'a <<var;name="x";match="b|b c|d">> c', '<<var;name="x";match="b|c">> a <<beginOptional>>b<<endOptional>>', "a a b", '<<beginOptional>>b<<endOptional>> c <<var;name="x";words="2-3">>']


@settings(max_examples=300, deadline=None)
@given(st.sampled_from(MARKUPS), st.lists(st.sampled_from("abcde"), min_size=1, max_size=14))
def test_automaton_equals_regular_expression(markup, words):
    scanner = licenses.Scanner([("x", markup)], {})
    found = licenses.arrays.texts(licenses.pa.array([" ".join(words)], licenses.pa.string()))
    got = [m[1:] for m in scanner.scan(*found)[2][0]]
    pattern, text = as_regex(markup), "".join(w + " " for w in words)
    starts = [m.start() for m in re.finditer(r"(?<![^ ])[^ ]", text)]
    want, taken = [], 0
    for p, start in enumerate(starts):
        if p < taken:
            continue
        ends = [q + 1 for q in range(p, len(words)) if pattern.fullmatch("".join(w + " " for w in words[p : q + 1]))]
        if ends:
            want.append((p, max(ends)))
            taken = max(ends)
        del start
    assert got == want


@pytest.mark.parametrize("markup", ['<<var;name="x";words="0-3">> a', "<<beginOptional>>a<<endOptional>>", "a <<endOptional>>", "a <<beginOptional>> b", "a <<other>> b", ""])
def test_faulty_templates_are_refused(markup):
    with pytest.raises(ValueError):
        licenses.compile_template("x", markup)


def rows():
    rng = random.Random(9)
    filler = lambda n: " ".join(rng.choice(["the", "mit", "License", "apache", "general", "public", "é1"]) for _ in range(n))
    docs = [(k, filler(rng.randrange(0, 80))) for k in range(60)] + [(60, None), (61, ""), (62, "?!"), (None, "MIT license"), (63, "mit-license, MIT\nLICENSE"), (63, "mit-license, MIT\nLICENSE")]
    docs += [(64, "word " * 60_000 + "Released under the MIT License."), (65, "general public license " * 5000), (66, "w" * 300_000 + " apache license")]
    return docs


def test_base_equals_plain_python(frame):
    found = licenses.scan_licenses(frame(rows()), keep=["doc_id"])
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, list(r.base_labels)) for r in found.collect()), key=repr)
    assert got == sorted(((i, *brute_base(t)) for i, t in rows()), key=repr)


def test_labels_scores_and_places(frame):
    apache, mit = TEMPLATES[1], next(t for t in TEMPLATES if t[0] == "mit" and "hereby" in t[1])
    body = written_out(mit[1], random.Random(1))
    docs = [(1, "x y. Licensed under the Apache License, Version 2.0. z"), (2, "the Apache License"), (3, f"Copyright (c) 2020 Me. {body} end"), (4, body.replace("WARRANTIES", "warrants")),
            (5, "plain words only"), (6, "This work is licensed under the GNU General Public License, version 3."), (7, "Licensed under CC BY-NC 4.0."), (8, "Released under the MIT License.")]
    found = {r.doc_id: r for r in licenses.scan_licenses(frame(docs), keep=["doc_id"]).collect()}
    assert {i: list(r.labels) for i, r in found.items()} == {
        1: ["apache", "apache-2.0"], 2: ["apache"], 3: ["mit"], 4: [], 5: [], 6: ["gpl", "gpl-3.0"], 7: ["cc-by-nc-4.0"], 8: ["mit"]}
    assert [found[i].score for i in (1, 2, 3, 5, 6, 7, 8)] == [1, 0.5, 1, 0, 1, 1, 1] and 0.3 < found[4].score < 1
    assert [tuple(m) for m in found[1].matches] == [(apache[0], 2, 10)]


def test_other_columns_stay(frame):
    docs = frame([(1, "mit license", "x", 4)], "doc_id long, text string, labels string, score int")
    names = tuple(f"{n}_" for n in licenses.COLUMNS)
    found = licenses.scan_licenses(docs, keep=docs.columns, names=names).collect()
    assert [tuple(r)[:8] for r in found] == [(1, "mit license", "x", 4, 2, 1, 0, 0)]


def test_query(spark, frame):
    found = queries.op13_license_scan(spark, SMALL)
    assert dict(found.dtypes) == {"doc_id": "bigint", **{c: "bigint" for c in ("n_words", "n_base", "first_word", "last_word")}, "base_labels": "string", "labels": "string", "score": "double"}
    given = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    want = sorted(((i, *(b := brute_base(t))[:4], ",".join(b[4])) for i, t in given), key=repr)
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in found.collect()), key=repr) == want
    assert licenses.scan_licenses(frame([]), keep=["doc_id"]).count() == 0
