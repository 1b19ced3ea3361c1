"""Personal data: patterns propose spans, checksums confirm them, context words move the score.

``find_spans`` works on one text and ``find_pii`` / ``redact_pii`` on a table.
Spans are in code points, the end exclusive. A null text counts as empty.

Base kinds (``email``, ``ip``, ``card``, ``phone``) are decided by pattern and
validator alone. Further kinds come from scoring: ``iban`` (mod-97 confirmed)
and ``ssn`` (a bare number that only nearby context words turn into a hit).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from framequarry.llm._shared import slices, table

BASE_KINDS = ("email", "ip", "card", "phone")
EXTRA_KINDS = ("iban", "ssn")
KINDS = BASE_KINDS + EXTRA_KINDS

# An email's local part never holds "@", so every "@" is tried once and the
# local part is read backwards from it; the digit runs are possessive. Both
# keep the search linear on texts without any white space.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_NOT_DIGIT = re.compile(r"[^0-9]+")

#: Context words by kind, with what each adds to a proposal's score.
CONTEXT = {
    "iban": {"iban": 0.4, "bank": 0.2, "account": 0.2, "konto": 0.2, "cuenta": 0.2, "compte": 0.2, "bic": 0.2, "example": -0.2, "invalid": -0.4},
    "ssn": {"ssn": 0.5, "social": 0.3, "security": 0.3, "taxpayer": 0.4, "version": -0.4, "part": -0.3, "isbn": -0.5, "order": -0.3},
}
#: Score of a proposal before its context: a confirmed checksum weighs most.
PRIOR = {"iban": 0.6, "ssn": 0.3}
THRESHOLD = 0.6
CONTEXT_CHARS = 48
_WORD = re.compile(r"[A-Za-z]+")


def luhn(digits: str) -> bool:
    """Whether a string of digits has a valid Luhn check digit."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k & 1:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def mod97(code: str) -> bool:
    """Whether an account number (letters and digits only) has a valid mod-97 checksum."""
    turned = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free = 0
    for m in _DOMAIN.finditer(text):
        start = at = m.start()
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            free = m.end()
            yield start, free


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
            yield m.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 10 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
            yield m.span()


def context_score(kind: str, text: str, start: int, end: int) -> float:
    """Score of a confirmed proposal: its kind's prior, moved by the words around it."""
    weights = CONTEXT[kind]
    near = text[max(0, start - CONTEXT_CHARS) : start] + " " + text[end : end + CONTEXT_CHARS]
    return PRIOR[kind] + sum(weights.get(w, 0.0) for w in {w.lower() for w in _WORD.findall(near)})


def _extras(text: str) -> Iterator[tuple[int, int, str]]:
    for m in _IBAN.finditer(text):
        code = m.group().replace(" ", "")
        if 15 <= len(code) <= 34 and mod97(code) and context_score("iban", text, *m.span()) >= THRESHOLD:
            yield (*m.span(), "iban")
    for m in _SSN.finditer(text):
        if m.group()[:3] not in ("000", "666") and context_score("ssn", text, *m.span()) >= THRESHOLD:
            yield (*m.span(), "ssn")


def find_spans(text: str | None) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """(base spans, all spans) of a text, each sorted by start and then by kind as listed.

    Added spans never overlap a base span.
    """
    text = text or ""
    base = [(s, e, kind) for kind, f in zip(BASE_KINDS, (_emails, _ips, _cards, _phones), strict=True) for s, e in f(text)]
    order = {kind: k for k, kind in enumerate(KINDS)}
    base.sort(key=lambda x: (x[0], order[x[2]]))
    more = [x for x in _extras(text) if not any(x[0] < e and s < x[1] for s, e, _ in base)]
    return base, sorted(base + more, key=lambda x: (x[0], order[x[2]]))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for s, e, kind in spans)


def redact(text: str | None) -> str | None:
    """A text with every span replaced by its kind in brackets; overlapping spans count as one, named by the first."""
    if not text:
        return text
    out, at = [], 0
    merged: list[list] = []
    for s, e, kind in find_spans(text)[1]:
        if merged and s < merged[-1][1]:
            merged[-1][1] = max(e, merged[-1][1])
        else:
            merged.append([s, e, kind])
    for s, e, kind in merged:
        out += [text[at:s], f"[{kind.upper()}]"]
        at = e
    return "".join(out) + text[at:]


_SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: counts of base spans, their digest, and all spans as text.

    Null ids stay null, repeated rows stay repeated, an empty table gives an
    empty result; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [find_spans(t) for t in batch.column(1).to_pylist()]
            counts = [[sum(x[2] == kind for x in base) for base, _ in rows] for kind in BASE_KINDS]
            digests = [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array([joined(full) for _, full in rows], pa.string())],
                names=["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans"],
            )

    return docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"cast(`{text_col}` as string) text").mapInArrow(run, _SCHEMA)


def redact_pii(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with personal data in ``text_col`` replaced and ``length_col`` (if present) brought up to date."""
    names = docs.columns
    at, length = names.index(text_col), names.index(length_col) if length_col in names else -1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [redact(t) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            if length >= 0:
                columns[length] = pa.array([None if t is None else len(t) for t in texts], batch.schema.field(length).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))
