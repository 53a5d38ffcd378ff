"""Secret scans: fixed patterns plus sliding-window entropy.

Method. Candidate strings are the maximal runs of a character class (hex,
base64). A window of ``window`` characters slides over each candidate;
its Shannon entropy is kept by incremental counts: with S the sum of
c * log2(c) over the character counts c, entropy = log2(w) - S / w, and a
step changes two counts. Overlapping windows at or above the class's threshold
merge into one span. The allow-list (words, counters, identifiers such as
UUIDs, documented sample keys) applies to the parts of a run between
separators: a window is suppressed if every part it touches is on the list as a
whole, whatever else the run holds. Pattern matches (assign, access, hex) are
always kept.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratal.llm.arrow import slices

# The patterns of the contract and the order of the kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")  # maximal runs: the same matches as [0-9a-f]+ of 24 or more
KINDS = ["assign", "access", "hex", "entropy_hex", "entropy_base64"]

# Candidate classes of the entropy scan: kind, maximal runs, threshold in bits.
CLASSES = [
    ("entropy_hex", re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{20,}"), 3.0),
    ("entropy_base64", re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"), 3.7),
]
WINDOW = 20
_WORD = r"(?:[A-Z]?[a-z]{1,24}|[A-Z]{1,24})"  # longer than any word: a letters-only token
ALLOW = [
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",  # UUIDs
    # documented sample keys, as a whole
    r"AKIA(?:IOSFODNN7|I44QH8DHB)EXAMPLE|wJalrXUtnFEMI/?K7MDENG/?bPxRfiCYEXAMPLEKEY|je7MtGbClwBF/?2Zp9Utk/?h3yCo8nvbEXAMPLEKEY",
    rf"[_/=+-]*{_WORD}(?:[_/=+-]+{_WORD})*[_/=+-]*",  # words of one case or capitalised, paths of them
    r"[0-9]+",  # counters, dates
]
SEPARATORS = "_/=+-"

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    found: list[Span] = []
    if ":" in text or "=" in text:
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return found


def _c_log_c(window: int) -> list[float]:
    return [0.0] + [c * math.log2(c) for c in range(1, window + 1)]


def hot_windows(candidate: str, threshold: float, window: int, table: list[float],
                allowed: list[bool] | None = None) -> list[tuple[int, int]]:
    """Merged spans of the windows of ``candidate`` with entropy >= threshold
    that hold a character not ``allowed``."""
    counts: dict[str, int] = {}
    total, spans = 0.0, []
    bad = -1  # the last character not allowed
    most = (math.log2(window) - threshold) * window + 1e-9  # entropy >= threshold: total <= most
    for at, ch in enumerate(candidate):
        if at >= window:  # leaves before the next enters: never more than ``window`` are counted
            old = candidate[at - window]
            c = counts[old]
            counts[old] = c - 1
            total += table[c - 1] - table[c]
        c = counts.get(ch, 0)
        counts[ch] = c + 1
        total += table[c + 1] - table[c]
        if allowed is None or not allowed[at]:
            bad = at
        if at >= window - 1 and total <= most and bad > at - window:
            start, end = at - window + 1, at + 1
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], end)
            else:
                spans.append((start, end))
    return spans


def allowed_parts(candidate: str, allow: re.Pattern) -> list[bool]:
    """For each character of a run: whether it is a separator, or stands in a
    part, or a chain of parts, that is on the allow-list as a whole."""
    out = [ch in SEPARATORS for ch in candidate]
    bounded = _bounded(allow.pattern, allow.flags)
    for m in bounded.finditer(candidate):
        out[m.start():m.end()] = [True] * (m.end() - m.start())
    return out


@lru_cache(maxsize=8)
def _bounded(pattern: str, flags: int) -> re.Pattern:
    # from the first character of a part to the end of one, in the run; separators before it need no
    # match (they are allowed), and trying at each of them would read a long row of separators again and again
    return re.compile(rf"(?<![^{SEPARATORS}])(?=[^{SEPARATORS}])(?:{pattern})(?![^{SEPARATORS}])", flags)


def entropy_spans(text: str, allow: re.Pattern, window: int = WINDOW, classes=None) -> list[Span]:
    found: list[Span] = []
    table = _c_log_c(window)
    for kind, run, threshold in classes or CLASSES:
        for m in run.finditer(text):
            candidate = m.group()
            if len(candidate) < window or allow.fullmatch(candidate):
                continue
            hot = hot_windows(candidate, threshold, window, table)
            if hot:
                hot = hot_windows(candidate, threshold, window, table, allowed_parts(candidate, allow))
            found += [(kind, m.start() + a, m.start() + b) for a, b in hot]
    return found


def scan_text(text: str | None, allow: re.Pattern, window: int = WINDOW) -> list[Span]:
    """All spans of a text, in order of start, then kind as listed, then end."""
    if not text:
        return []
    spans = base_spans(text) + entropy_spans(text, allow, window)
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def compile_allow(allow: list[str]) -> re.Pattern:
    return re.compile("|".join(f"(?:{a})" for a in allow) or r"(?!)", re.ASCII | re.DOTALL)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", allow: list[str] = ALLOW,
                 window: int = WINDOW) -> DataFrame:
    """(id_col, spans array<struct<kind, start, end>>) per row of ``docs``;
    positions are code points, ends exclusive.

    Defined cases: a null or empty text has no spans; a null id stays null;
    overlapping spans of different kinds are all returned; repeated rows give
    repeated results; an empty table gives an empty result. Whole texts are
    scanned in one pass without a shuffle; only the two named columns are
    read.
    """
    allowed = compile_allow(allow)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            spans = [[{"kind": k, "start": s, "end": e} for k, s, e in scan_text(t, allowed, window)]
                     for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(spans, kind)], names=["id", "spans"])

    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind_of = dict(plain.dtypes)["id"]
    return (plain.mapInArrow(run, f"id {kind_of}, spans array<struct<kind:string,start:long,end:long>>")
            .withColumnRenamed("id", id_col))


def redact_text(text: str | None, allow: re.Pattern, mark: str, window: int = WINDOW) -> str | None:
    """The text with every span (overlapping ones as one) replaced by ``mark``."""
    spans = scan_text(text, allow, window)
    if not spans:
        return text
    out, at = [], 0
    last = -1
    for _, start, end in spans:
        if start >= last:
            out += [text[at:start], mark]
            last = at = end
        elif end > last:
            last = at = end
    return "".join(out) + text[at:]


def redact_secrets(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", allow: list[str] = ALLOW,
                   window: int = WINDOW) -> DataFrame:
    """``docs`` with the secrets of ``text_col`` replaced; all other columns
    and rows unchanged (null stays null)."""
    allowed = compile_allow(allow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text_col):
            i = b.schema.get_field_index(text_col)
            texts = [redact_text(t, allowed, mark, window) for t in b.column(i).to_pylist()]
            yield b.set_column(i, b.schema.field(i), pa.array(texts, b.schema.field(i).type))

    return docs.mapInArrow(run, docs.schema)
