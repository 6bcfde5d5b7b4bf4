"""Secrets in texts: fixed patterns, and high entropy in sliding windows.

A candidate is a maximal run of token characters. It belongs to the narrowest character
class that holds it, and each class has its own entropy bound. A window of ``width``
characters slides over the candidate; the counts of its characters change by one in and
one out, so a step costs the same for any width. Windows at or above the bound are
joined into spans. Runs on the allow-list, and runs of one plain kind (words, numbers),
are suppressed. Spans of the fixed patterns are always reported.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorloom.llm.common import id_and_text, map_rows

# The base patterns and the least lengths of their matches.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?((?-i:[A-Za-z0-9+/_.=-]+))", re.I | re.A
)
ASSIGN_WORDS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "entropy")

# Runs that look random but are known not to be secret.
ALLOWED = (
    r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}",  # identifiers
    r"(?i:.*(?:example|sample|placeholder|changeme|dummy|redacted|xxxx).*)",
    r"(?i:.*(?:0123456789|abcdefghij|qwertyuiop).*)",
    r"(?:https?|www|ftp)[/_.=-].*",
)
CLASSES = (
    ("hex", re.compile(r"[0-9a-fA-F]+"), 3.0),
    ("upper", re.compile(r"[A-Z0-9]+"), 3.4),
    ("lower", re.compile(r"[a-z0-9]+"), 3.4),
    ("mixed", re.compile(r"[A-Za-z0-9+/_=-]+"), 3.7),
)


@dataclass(frozen=True)
class EntropySettings:
    """``width``: characters per window, also the least length of a candidate."""

    width: int = 20
    bounds: tuple[float, ...] = tuple(c[2] for c in CLASSES)
    allowed: tuple[str, ...] = field(default=ALLOWED)


def _base_spans(text: str) -> list[tuple[int, int, int]]:
    found = []
    if ":" in text or "=" in text:
        low = text.lower()
        if any(word in low for word in ASSIGN_WORDS):
            found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


class EntropyScan:
    """Scans candidates with the settings; made once per task."""

    def __init__(self, settings: EntropySettings):
        self.width = width = settings.width
        self.bounds = settings.bounds
        self.candidate = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{width},}}={{0,2}}")
        self.allowed = re.compile("|".join(f"(?:{p})" for p in settings.allowed)) if settings.allowed else None
        # a character seen c times in a window adds c * log2(c) / width to the lack of entropy
        self.terms = [0.0] + [c * math.log2(c) / width for c in range(1, width + 1)]

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        found = []
        for match in self.candidate.finditer(text):
            run = match.group()
            bound = self._bound(run)
            if bound is not None:
                found += [(match.start() + a, 3, match.start() + b) for a, b in self.windows(run, bound)]
        return found

    def _bound(self, run: str) -> float | None:
        digits = any(c in "0123456789" for c in run)
        letters = any(c.isalpha() for c in run)
        if not (digits and letters):  # plain words, numbers and rules of one sign
            return None
        if self.allowed is not None and self.allowed.fullmatch(run):
            return None
        return next(b for (_, pattern, _), b in zip(CLASSES, self.bounds) if pattern.fullmatch(run))

    def windows(self, run: str, bound: float) -> list[tuple[int, int]]:
        """Joined windows of the run whose entropy reaches the bound."""
        width, terms, full = self.width, self.terms, math.log2(self.width)
        counts: dict[str, int] = {}
        lack, spans = 0.0, []
        for at, new in enumerate(run):
            had = counts.get(new, 0)
            counts[new] = had + 1
            lack += terms[had + 1] - terms[had] if had < width else 0.0
            if at >= width:
                old = run[at - width]
                had = counts[old]
                counts[old] = had - 1
                lack += terms[had - 1] - terms[had]
            if at >= width - 1 and full - lack >= bound - 1e-9:
                start = at - width + 1
                if spans and start <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], at + 1)
                else:
                    spans.append((start, at + 1))
        return spans


def _joined(spans: Iterable[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def _scan(batches: Iterator[pa.RecordBatch], settings: EntropySettings) -> Iterator[pa.RecordBatch]:
    scan = EntropyScan(settings)
    for batch in batches:
        rows = []
        for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
            base = _base_spans(text)
            more = scan.spans(text)
            rows.append((doc_id, base, more))
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.array([r[0] for r in rows], pa.int64()),
                **{
                    f"n_{kind}": pa.array([sum(s[1] == k for s in r[1]) for r in rows], pa.int64())
                    for k, kind in enumerate(KINDS[:3])
                },
                "base_sha256": pa.array([hashlib.sha256(_joined(r[1]).encode()).hexdigest() for r in rows]),
                "spans": pa.array([_joined(sorted(r[1] + r[2])) for r in rows]),
                "n_entropy": pa.array([len(r[2]) for r in rows], pa.int64()),
            }
        )


SCAN_SCHEMA = (
    "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_entropy bigint"
)


def find_secrets(docs: DataFrame, settings: EntropySettings | None = None, id_col="doc_id", text_col="text"):
    """One row per document: counts of the base kinds, their digest, and all spans.

    Positions are code points with exclusive ends. Null and empty texts have no spans;
    a null identifier stays null; repeated rows give repeated results; other columns are
    not read. Texts of any length are scanned in one pass over their characters.
    """
    return map_rows(id_and_text(docs, id_col, text_col), _scan, SCAN_SCHEMA, settings or EntropySettings())


def mask(text: str, scan: EntropyScan, mark: str) -> str:
    spans = sorted((start, end) for start, _, end in _base_spans(text) + scan.spans(text))
    parts, at = [], 0
    for start, end in spans:
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]]) if spans else text


def _mask(batches, column: int, settings, mark):
    scan = EntropyScan(settings)
    for batch in batches:
        texts = [None if t is None else mask(t, scan, mark) for t in batch.column(column).to_pylist()]
        yield batch.set_column(column, batch.schema.field(column), pa.array(texts, batch.schema.field(column).type))


def mask_secrets(docs: DataFrame, settings: EntropySettings | None = None, text_col="text", mark="[secret]"):
    """The same rows and columns, with each secret in the text replaced by ``mark``.

    Overlapping spans become one mark. Null texts stay null. A column ``n_chars`` of the
    input is set to the new length where the text changed.
    """
    masked = map_rows(
        docs, _mask, docs.schema, docs.columns.index(text_col), settings or EntropySettings(), mark
    )
    if "n_chars" in docs.columns and text_col != "n_chars":
        kind = docs.schema["n_chars"].dataType
        masked = masked.withColumn("n_chars", F.length(text_col).cast(kind))
    return masked
