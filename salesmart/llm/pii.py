"""Personal data: patterns propose spans, checksums confirm them, words nearby move their score.

Base kinds are proposed leftmost first and never overlap within a kind; a proposal that fails its check is dropped
whole; an account number is searched for again from its next place. Further kinds are kept if their score reaches ``LEAST_SCORE``. Every search takes time in proportion to the
text, also in texts that are one long run of digits or letters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Kinds in the order in which spans that start together are listed.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")
#: Scores before and gains from a word nearby; so many code points to either side are nearby.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.5, "iban": 0.8, "ssn": 0.3}
GAIN, NEAR, LEAST_SCORE = 0.3, 48, 0.5
CONTEXT = {
    "email": ("mail", "contact", "correo", "courriel"), "ip": ("ip", "server", "host", "address"),
    "card": ("card", "visa", "credit", "karte", "tarjeta", "carte"), "phone": ("phone", "call", "tel", "fax", "mobile"),
    "iban": ("iban", "bank", "account", "konto", "cuenta", "compte"), "ssn": ("ssn", "social", "security"),
}
#: Lengths of account numbers by country, as the IBAN registry lists them.
IBAN_LENGTHS = {"AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29, "BY": 28,
                "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18,
                "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HN": 28, "HR": 21, "HU": 28,
                "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20,
                "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28,
                "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24,
                "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26,
                "UA": 29, "VA": 22, "VG": 24, "XK": 20, "YE": 30}

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN_HEAD = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?= ?[A-Z0-9])")
_IBAN_REST = {n: re.compile(rf"(?: ?[A-Z0-9]){{{n - 4}}}") for n in {*IBAN_LENGTHS.values()}}
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_NOT_DIGITS = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97(account: str) -> bool:
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The local part is the whole run of its characters before an @, as far back as the last match."""
    end, at = 0, text.find("@")
    low = 0
    while at >= 0:
        low = max(low, end)
        local = at - low - len(text[low:at].rstrip(_LOCAL))
        if local and (domain := _DOMAIN.match(text, at + 1)):
            end = domain.end()
            yield at - local, end
        low = at + 1
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> Iterator[tuple[str, int, int]]:
    for start, end in emails(text):
        yield "email", start, end
    if not _DIGIT.search(text):
        return
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            yield "ip", m.start(), m.end()
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(digits := _NOT_DIGITS.sub("", m[0])) <= 19 and luhn(digits):
            yield "card", m.start(), m.end()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGITS.sub("", m[0])) <= 15:
                yield "phone", m.start(), m.end()


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost first; the search goes on after a confirmed number, or after the start of a proposal that fails."""
    at = 0
    while m := _IBAN_HEAD.search(text, at):
        at = m.start() + 1
        need = IBAN_LENGTHS.get(m[0][:2])
        if need and (rest := _IBAN_REST[need].match(text, m.end())) and mod97((m[0] + rest[0]).replace(" ", "")):
            at = rest.end()
            yield m.start(), at


def more_spans(text: str) -> Iterator[tuple[str, int, int]]:
    if not _DIGIT.search(text):
        return
    for start, end in ibans(text):
        yield "iban", start, end
    for m in _SSN.finditer(text):
        area, group, serial = m[0].split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield "ssn", m.start(), m.end()


def score(text: str, kind: str, start: int, end: int) -> float:
    near = (text[max(0, start - NEAR) : start] + " " + text[end : end + NEAR]).lower()
    return min(1.0, SCORES[kind] + GAIN * any(w in CONTEXT[kind] for w in re.findall(r"[^\W\d_]+", near)))


def find(text: str) -> list[dict]:
    """All spans by start, then kind: kind, start, end, score, base."""
    found = [{"kind": k, "start": a, "end": b, "score": score(text, k, a, b), "base": True} for k, a, b in base_spans(text)]
    for k, a, b in more_spans(text):
        if (s := score(text, k, a, b)) >= LEAST_SCORE:
            found.append({"kind": k, "start": a, "end": b, "score": s, "base": False})
    return sorted(found, key=lambda s: (s["start"], KINDS.index(s["kind"])))


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("base", pa.bool_())]))


def find_pii(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: id and ``pii``, an array of (kind, start, end, score, base); offsets in code points, end exclusive.

    NULL and empty texts have no spans. Ids may be NULL or repeat. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(0, batch.num_rows, 512):
                part = batch.slice(row, 512)
                found = [find(t or "") for t in part.column(text_column).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(id_column), pa.array(found, SPANS)], [id_column, "pii"])

    kind = dict(docs.dtypes)[id_column]
    return docs.select(id_column, text_column).mapInArrow(run, f"`{id_column}` {kind}, pii array<struct<kind:string,start:long,end:long,score:double,base:boolean>>")


def masked(text: str, spans: list[dict]) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first is named."""
    out, end = [], 0
    for s in spans:
        if s["start"] >= end:
            out += [text[end : s["start"]], f"<{s['kind']}>"]
        end = max(end, s["end"])
    return "".join([*out, text[end:]])
