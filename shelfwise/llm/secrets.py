"""Secret scan: fixed patterns, and sliding-window Shannon entropy over candidate strings.

Base kinds (leftmost, non-overlapping within a kind): ``assign`` (the value given to a
password-like name), ``access`` (access key ids), ``hex`` (long lower-case hex runs).
The entropy kind looks at candidate strings of at least ``window`` characters.  For each
character class a window slides over every run of that class; counts are updated for the
character that leaves and the one that enters, so a step costs O(1).  Windows at or over
the class's threshold that mix letters and digits are merged into spans.  Spans that
touch a base span or that hold a match of the allow-list are suppressed; the rest of the
candidate is not.

Offsets are code points, end exclusive.

Cases: null and empty texts have no spans; repeated rows are scanned each on their own;
texts are scanned whole, however long; an empty table gives an empty result; further
columns are passed through by ``redact`` and not looked at by ``scan``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import slices
from shelfwise.session import ship

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_HINTS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}")
#: Character classes and the bits per character from which a window of WINDOW is random-looking.
CLASSES = ((re.compile(r"[0-9A-Fa-f]{20,}"), 3.2), (re.compile(r"[A-Za-z0-9]{20,}"), 3.7), (re.compile(r"[A-Za-z0-9+/_-]{20,}"), 3.9))
ALLOW = (r"(?i)example|sample|placeholder|changeme|dummy", r"(.)\1{5,}", r"(?i)0123456|1234567|abcdefg")
UUID = re.compile(r"[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}")

_clog = [0.0, 0.0]


def _counts_logs(window: int) -> list[float]:
    """c * log2(c) for the counts that a window can hold."""
    _clog.extend(c * math.log2(c) for c in range(len(_clog), window + 2))
    return _clog


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the three fixed patterns."""
    out = []
    low = text.lower()
    if any(h in low for h in ASSIGN_HINTS):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return out


def random_windows(run: str, threshold: float, window: int = WINDOW) -> list[tuple[int, int]]:
    """Merged spans of windows with at least ``threshold`` bits per character and both letters and digits."""
    if len(run) < window:
        return []
    counts: dict[str, int] = {}
    total, digits, letters, found = 0.0, 0, 0, []
    most, full, logs = math.log2(window), len(run), _counts_logs(window)
    for i, c in enumerate(run):
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += logs[n + 1] - logs[n]
        digits += c.isdigit()
        letters += c.isalpha()
        if i >= window:
            c = run[i - window]
            n = counts[c]
            counts[c] = n - 1
            total += logs[n - 1] - logs[n]
            digits -= c.isdigit()
            letters -= c.isalpha()
        if window - 1 <= i < full and digits >= 2 and letters and most - total / window >= threshold:
            a, b = i - window + 1, i + 1
            if found and a <= found[-1][1]:
                found[-1] = (found[-1][0], b)
            else:
                found.append((a, b))
    return found


class Scanner:
    def __init__(self, allow: tuple[str, ...] = ALLOW, window: int = WINDOW):
        self.allow, self.window = [re.compile(a) for a in allow], window

    def entropy_spans(self, text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
        out = []
        for m in CANDIDATE.finditer(text):
            word = m[0]
            if not any("0" <= c <= "9" for c in word) or UUID.fullmatch(word):
                continue
            spans = []
            for kind, threshold in CLASSES:
                for run in kind.finditer(word):
                    spans += [(m.start() + run.start() + a, m.start() + run.start() + b) for a, b in random_windows(run[0], threshold, self.window)]
            merged: list[tuple[int, int]] = []
            for a, b in sorted(spans):
                if merged and a <= merged[-1][1]:
                    merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
                else:
                    merged.append((a, b))
            out += [(a, b, "entropy") for a, b in merged if not any(a < y and x < b for x, y, _ in base) and not any(p.search(text, a, b) for p in self.allow)]
        return out

    def spans(self, text: str | None) -> list[tuple[int, int, str]]:
        if not text:
            return []
        base = base_spans(text)
        every = base + self.entropy_spans(text, base)
        return sorted(every, key=lambda s: (s[0], KINDS.index(s[2])))


def scan(docs: DataFrame, allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """doc_id and spans: array of (kind, start, end), by start, then kind."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(allow)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in slices(batches, "text"):
            spans = [[{"kind": k, "start": a, "end": b} for a, b, k in scanner.spans(t)] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, kind)], ["doc_id", "spans"])

    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, spans array<struct<kind:string,start:long,end:long>>")


def mask(text: str, spans: list[tuple[int, int, str]], label: str) -> str:
    out, at = [], 0
    for a, b, _ in spans:
        if b <= at:
            continue
        out += [text[at : max(a, at)], label] if a >= at else []
        at = b
    return "".join(out) + text[at:]


def redact(docs: DataFrame, allow: tuple[str, ...] = ALLOW, label: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``label``; all columns stay."""
    ship(docs.sparkSession)
    docs = docs.withColumn("text", F.col("text").cast("string"))
    place = [c.lower() for c in docs.columns].index("text")
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(allow)
        for batch in slices(batches, names[place]):
            texts = [mask(t, scanner.spans(t), label) if t else t for t in batch.column(place).to_pylist()]
            columns = [pa.array(texts, pa.string()) if c == place else batch.column(c) for c in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, docs.schema)
