"""Secrets: all rules as one minimised deterministic automaton, one pass over the bytes of a text.

Base kinds (assign, access, hex) are reported whenever their pattern and length hold; the method adds
``github``, ``slack`` and ``key_block``. Offsets are code points, ends exclusive. The length of
``hex`` is part of its automaton (a run of hex digits is one match, however long); the other lengths are
checked on the match, and a match that fails is dropped without a second try.

Defined cases: null or empty text has no span; a repeated row gives a repeated result; a null ``doc_id``
is passed on; other columns are ignored; an empty table gives an empty result. Time is linear in the text.
"""

from __future__ import annotations

import re
from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .automaton import Automaton
from .common import map_texts, ship, table

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# (kind, pattern, least code points of the match; of the value for assign), in the order of the report
RULES = (
    ("assign", ASSIGN, 6),
    ("access", r"AKIA[A-Z0-9]+", 20),
    ("hex", r"[0-9a-f]{24,}", 24),
    ("github", r"gh[opsu]_[A-Za-z0-9]+", 40),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]+", 20),
    ("key_block", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0),
)
BASE = ("assign", "access", "hex")
KINDS = tuple(kind for kind, _, _ in RULES)
VALUE = re.compile(ASSIGN.encode())
BUFFER = 4 << 20  # bytes scanned at a time; a longer text is scanned alone


@cache
def automaton() -> Automaton:
    return Automaton([pattern for _, pattern, _ in RULES], runs=(KINDS.index("hex"),))


def confirmed(kind: int, match: bytes) -> bool:
    if KINDS[kind] == "assign":
        match = VALUE.fullmatch(match)[2]
    return len(match) >= RULES[kind][2]


def spans_of(texts: list[str], rules: Automaton | None = None) -> list[list[tuple[int, int, int]]]:
    """Per text ``(start, kind index, end)`` ordered by start, then kind."""
    out: list = []
    rules = rules or automaton()
    data = [t.encode() for t in texts]
    at = 0
    while at < len(data):
        to, size = at + 1, len(data[at])
        while to < len(data) and size + len(data[to]) < BUFFER:
            size += len(data[to])
            to += 1
        out += scan_some(data[at:to], rules)
        at = to
    return out


def scan_some(data: list[bytes], rules: Automaton) -> list[list[tuple[int, int, int]]]:
    buffer = b"\xff".join([*data, b""])
    begins = np.cumsum([0, *(len(d) + 1 for d in data)])
    out: list = [[] for _ in data]
    for kind, start, end in rules.scan(np.frombuffer(buffer, np.uint8)):
        if confirmed(kind, buffer[start:end]):
            i = int(np.searchsorted(begins, start, "right")) - 1
            out[i].append((start - int(begins[i]), kind, end - int(begins[i])))
    for i, found in enumerate(out):
        found.sort()
        if found and not data[i].isascii():  # byte offsets to code points; matches are ASCII
            points, last, shifted = 0, 0, []
            for start, kind, end in found:
                points += len(data[i][last:start].decode(errors="ignore"))
                last = start
                shifted.append((points, kind, points + end - start))
            out[i] = shifted
    return out


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row per document: ``spans`` array of (kind, start, end)."""
    ship(docs.sparkSession)
    rules = automaton()  # compiled once, on the driver; the arrays travel with the function

    def make(ids, texts):
        found = spans_of(texts, rules)
        return {"doc_id": ids, "spans": [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans] for spans in found]}

    return map_texts(docs, "doc_id long, spans array<struct<kind:string,start:long,end:long>>", make)


def op13_secret_scan(spark, sf_dir: str) -> DataFrame:
    text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    of_kind = lambda kind: lambda s: s["kind"] == kind
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return find_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *(F.size(F.filter("spans", of_kind(k))).cast("long").alias(f"n_{k}") for k in BASE),
        F.sha2(F.array_join(F.transform(base, text), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", text), ",").alias("spans"),
    )


def oracle_sql() -> str:
    """DuckDB: per kind the matches and the text between them; their lengths add up to the offsets."""
    parts = []
    for i, (kind, pattern, least) in enumerate(RULES):
        p = pattern.replace("'", "''")
        measured = f"regexp_extract(m, '{p}', 2)" if kind == "assign" else "m"
        parts.append(f"""
  SELECT doc_id, {i} AS nth, '{kind}' AS kind, pos AS start, pos + length(m) AS stop
  FROM (SELECT doc_id, m, sum(length(g) + length(m)) OVER (PARTITION BY row ORDER BY i) - length(m) AS pos
        FROM (SELECT doc_id, row, unnest(regexp_extract_all(t, '{p}')) AS m,
                     unnest(regexp_split_to_array(t, '{p}')) AS g,
                     unnest(range(len(regexp_split_to_array(t, '{p}')))) AS i
              FROM docs WHERE regexp_matches(t, '{p}')))
  WHERE m IS NOT NULL AND length({measured}) >= {least}""")
    return f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS row, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(parts)}),
joined AS (
  SELECT doc_id, {", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in BASE)},
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, nth) AS spans,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, nth) FILTER (WHERE nth < {len(BASE)}) AS base
  FROM found GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs d LEFT JOIN joined USING (doc_id)
"""


ORACLE_SQL = oracle_sql()
