"""PII: regular expressions propose spans, checksums confirm them, context words adjust the score.

Base kinds (email, ip, card, phone) are reported whenever their pattern and check hold; the method
adds ``iban`` (mod-97) and ``ssn`` (a weak pattern that only nearby context lifts over the threshold).

Defined cases: null or empty text has no span; offsets are code points, ends exclusive; a repeated
row gives a repeated result; a null ``doc_id`` is passed on; other columns are ignored. Every
pattern is linear in the text: runs are entered only at their first character.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame

from .common import map_texts

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
CONTEXT = {
    "email": ("mail", "contact", "@"), "ip": ("ip", "host", "server", "address"), "card": ("card", "visa", "credit", "pay"),
    "phone": ("phone", "tel", "call", "mobile", "fax"), "iban": ("iban", "bank", "account"), "ssn": ("ssn", "social", "security"),
}
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.8, "ssn": 0.3}
WINDOW, BOOST, LEAST = 40, 0.3, 0.5


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    s = iban.replace(" ", "")
    if not 15 <= len(s) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def emails(text: str):
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            end = m.end()
            yield start, end
        at = text.find("@", max(end, at + 1))


def propose(text: str):
    """Confirmed ``(kind, start, end)``, leftmost and non-overlapping within each kind."""
    for s, e in emails(text):
        yield "email", s, e
    for m in IP.finditer(text):
        if all(len(p := x.lstrip("0")) < 4 and int(p or 0) <= 255 for x in m[0].split(".")):
            yield "ip", m.start(), m.end()
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield "card", m.start(), m.end()
    for m in PHONE.finditer(text):
        if 10 <= sum(map(str.isdigit, m[0])) <= 15:
            yield "phone", m.start(), m.end()
    for m in IBAN.finditer(text):
        if mod97(m[0]):
            yield "iban", m.start(), m.end()
    for m in SSN.finditer(text):
        yield "ssn", m.start(), m.end()


def spans(text: str) -> list[tuple[int, int, str, float]]:
    """``(start, kind index, end, score)`` ordered by start, then kind; base kinds always stay."""
    out = []
    for kind, s, e in propose(text):
        near = (text[max(0, s - WINDOW) : s] + " " + text[e : e + WINDOW]).lower()
        score = min(1.0, PRIOR[kind] + BOOST * any(w in near for w in CONTEXT[kind]))
        if kind in BASE or score >= LEAST:
            out.append((s, KINDS.index(kind), e, score))
    return sorted(out)


def find_pii(docs: DataFrame) -> DataFrame:
    """One row per document: ``spans`` array of (kind, start, end, score)."""

    def make(ids, texts):
        return {"doc_id": ids, "spans": [[{"kind": KINDS[k], "start": s, "end": e, "score": x} for s, k, e, x in spans(t)] for t in texts]}

    return map_texts(docs, "doc_id long, spans array<struct<kind:string,start:long,end:long,score:double>>", make)


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns, derived from the spans with SQL functions."""
    from pyspark.sql import functions as F

    text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    of_kind = lambda kind: lambda s: s["kind"] == kind
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select(
        "doc_id",
        *(F.size(F.filter("spans", of_kind(k))).cast("long").alias(f"n_{k}") for k in BASE),
        F.sha2(F.array_join(F.transform(base, text), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", text), ",").alias("spans"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("top_score"),
    )


def op1_pii(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return digest(find_pii(table(spark, sf_dir, "documents")))


def reference_digest(text: str) -> str:
    """What ``base_sha256`` must be, for tests."""
    s = ",".join(f"{KINDS[k]}:{a}:{e}" for a, k, e, _ in spans(text) if k < len(BASE))
    return hashlib.sha256(s.encode()).hexdigest()
