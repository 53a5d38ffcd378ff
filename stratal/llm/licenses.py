"""Licence scans by conditional compression.

Method. Every licence cue of a text has a block: the words around it, as far
as the longest template that could hold it reaches. The block is compressed
alone and with each template of the table as zstandard raw dictionary, and the
templates are ranked by the bytes they save. From the best on, a template is
confirmed by its exact wording: aligned with the block word by word, with the
cue inside, identifying words (name, clause, version) must all be there, no
other identifying word may stand between them, and a tolerance covers the
other words only. The first one confirmed is the cue's notice, or of those
that save within ``CLOSE`` bytes of it the one with the fewest differences; its words are
masked, so cues inside it ask no more. A cue for which no template is
confirmed gives no row. Neither templates nor notices are limited in number.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratal.llm.arrow import slices
from stratal.llm.notices import BSD_3_CLAUSE, IDS, MIT_OPENING, NOTICES

# Wording of public licence notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "BSD-3-Clause": BSD_3_CLAUSE,
    "MIT-text": MIT_OPENING,
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
# All texts of every licence: the ones above and those of the table.
ALL = {name: tuple(([TEMPLATES[name]] if name in TEMPLATES else []) + list(NOTICES.get(name, ())) + list(IDS.get(name, ())))
       for name in TEMPLATES | NOTICES}
CUE = re.compile(r"licen[sc]e|redistribution and use|permission is hereby granted|permission to use|creative commons|"
                 r"\bcc[ -]by\b|\bcc0\b|\bgnu [al]?gpl\b|public domain|mit no attribution", re.IGNORECASE | re.ASCII)
# Names that declare a licence by themselves: SPDX ids with a version, and further ids of an expression.
ID_CUE = re.compile(r"\b(?:Apache-2\.0|[AL]?GPL-[23]\.[01]|[AL]?GPLv[23](?:\.1)?|MPL-2\.0|BSD-[23]-Clause|CC0-1\.0|MIT-0|0BSD)(?![A-Za-z0-9])"
                    r"|(?<=\bOR )(?:MIT|ISC|Unlicense)\b|(?<=\bAND )(?:MIT|ISC|Unlicense)\b", re.ASCII)
WORD = re.compile(r"[^\W_]+", re.ASCII)
LEVEL = 9  # of the compression
NEUTRAL = b" " + bytes(97 + (k * k + 7 * k // 3) % 26 for k in range(256))
CLOSE = 3  # bytes: templates that save so much less than the first confirmed one are as good; fewer differences decide
# Words that tell licences apart: required where a notice has them, never inside one that has not.
NAMES = frozenset("""mit bsd apache gnu gpl lgpl agpl lesser library affero mozilla mpl cc cc0 nc sa nd noncommercial
    sharealike noderivatives noderivs non commercial share alike derivatives zero universal isc unlicense documentation
    simplified revised neither endorse advertising acknowledgement substantial portions appear fee unencumbered waived
    """.split())
# Required where a notice has them, but common enough to stand inside others.
COMMON = frozenset("license general public creative commons attribution by redistribution granted new clause".split())
# The words before and after a notice that make it another one: GPL after Lesser, 2.0 before .1, MIT before -Modern.
BEFORE = frozenset("lesser affero library non".split())
AFTER = re.compile(r"\.(?!0+(?!\w))[0-9]|-(?!only\b|or\b)[A-Za-z]", re.ASCII)


def words(text: str) -> list[tuple[str, int, int]]:
    return [(m.group().lower(), m.start(), m.end()) for m in WORD.finditer(text)]


def wording(block: str, template: str) -> tuple[int, int, int, int, int] | None:
    """(start, end, missing, extra, words) of the template's best alignment in
    the block: template words missing, and block words between the first and
    the last aligned word that are not in the template; None if nothing aligns."""
    a, b = [w for w, _, _ in words(template)], words(block)
    match = [m for m in SequenceMatcher(None, a, [w for w, _, _ in b], autojunk=False).get_matching_blocks() if m.size]
    if not match:
        return None
    first, last = match[0].b, match[-1].b + match[-1].size - 1
    same = sum(m.size for m in match)
    return b[first][1], b[last][2], len(a) - same, last - first + 1 - same, len(a)


def spelled(word: str) -> str:
    """Licence as license, v3 as 3."""
    if word.startswith("licenc"):
        return "licens" + word[6:]
    return word[1:] if word[0] == "v" and word[1:].isdigit() else word


class Notice:
    """A template ready for alignment."""

    def __init__(self, name: str, text: str):
        self.name, self.text = name, text
        self.words = [spelled(w) for w, _, _ in words(text)]
        self.numbered = any(w.isdigit() for w in self.words)
        self.required = [w in COMMON or self.names(w) for w in self.words]
        if not any(self.required):  # a template without identifying words: all of them are
            self.required = [True] * len(self.words)
        self.needs = Counter(w for w, r in zip(self.words, self.required) if r)
        self.counts = Counter(self.words)
        # a bare id is a word of other languages, too ("mit"): it must stand there as it is written
        self.id = text.removeprefix("License: ") if text in IDS.get(name, ()) or text == f"License: {name}" else ""

    def names(self, word: str) -> bool:
        # numbers are versions, but count clauses where the notice has none
        return word in NAMES or self.numbered and word.isdigit()


@lru_cache(maxsize=256)
def notice(name: str, text: str) -> Notice:
    return Notice(name, text)


def align(form: Notice, block: list[str | None], most: int) -> tuple[int, int, int, int] | None:
    """(differences, first word, end, words aligned): the place of the block
    where the template has the fewest differences, a replaced word being one;
    None if there are more than ``most``, or one in an identifying word. Masked
    words (None) are never aligned nor passed over."""
    far = most + 1
    skip = [far if w is None or form.names(w) else 1 for w in block]
    # per block position: (differences, -aligned, first aligned word or -1, end of the last one)
    row = [(0, 0, -1, -1)] * (len(block) + 1)
    for word, needed in zip(form.words, form.required):
        lose = far if needed else 1
        d, same, first, end = row[0]
        now = [(d + lose, same, first, end)]
        for j, other in enumerate(block):
            d, same, first, end = row[j]
            if other == word:
                best = (d, same - 1, j if first < 0 else first, j + 1)
            else:
                best = (d + max(lose, skip[j]), same, first, end)
            d, same, first, end = row[j + 1]
            best = min(best, (d + lose, same, first, end))
            d, same, first, end = now[j]
            now.append(min(best, (d + (skip[j] if first >= 0 else 0), same, first, end)))
        row = now
    d, same, first, end = min(row)
    return (d, first, end, -same) if first >= 0 and d <= most else None


def plain_words(text: str) -> bytes:
    """What is compressed: the words alone, lower-case and spelled alike, whatever the line breaks and marks are."""
    return " ".join(spelled(w) for w, _, _ in words(text)).encode()


@lru_cache(maxsize=64)
def _compressors(templates: tuple[tuple[str, str], ...]) -> list[tuple[str, zstandard.ZstdCompressor]]:
    """One compressor per template (its raw dictionary), and one without (name '')."""
    out = [("", zstandard.ZstdCompressor(level=LEVEL, write_content_size=False))]
    for name, text in templates:
        raw = zstandard.ZstdCompressionDict(plain_words(text), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        raw.precompute_compress(level=LEVEL)
        out.append((name, zstandard.ZstdCompressor(level=LEVEL, dict_data=raw, write_content_size=False)))
    return out


def reductions(block: bytes, templates: tuple[tuple[str, str], ...]) -> list[int]:
    """Bytes each template saves as raw dictionary of the block, in their order.

    Letters of fewer than 64 bytes are stored as they are, longer rows of them in
    fewer bits: with neutral letters behind the block both sizes are of the second kind."""
    (_, alone), *primed = _compressors(templates)
    block += NEUTRAL
    size = len(alone.compress(block))
    return [size - len(c.compress(block)) for _, c in primed]


def size_reductions(block: str, templates: dict[str, str]) -> list[tuple[int, str]]:
    """(bytes saved by the template as raw dictionary, name), best first."""
    pairs = tuple(templates.items())
    saved = reductions(plain_words(block), pairs)
    return sorted(((n, name) for n, (name, _) in zip(saved, pairs)), key=lambda x: (-x[0], x[1]))


def cues(text: str) -> list[tuple[int, int]]:
    return sorted({m.span() for c in (CUE, ID_CUE) for m in c.finditer(text)})


def regions(text: str, reach: int) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """(start, stop, cues): the text within ``reach`` characters of a cue, joined where it overlaps."""
    held: list[tuple[int, int]] = []
    start = stop = -1
    for at, end in cues(text):
        if held and at - reach > stop:
            yield start, stop, held
            held = []
        if not held:
            start = max(0, at - reach)
        held.append((at, end))
        stop = min(len(text), max(stop, end + reach))
    if held:
        yield start, stop, held


def blocks(form: Notice, spell: list[str], index: dict[str, list[int]], most: int) -> list[tuple[int, int]]:
    """Word ranges that may hold the template with at most ``most``
    differences: around every place of its rarest identifying word."""
    if any(w not in index for w in form.needs):
        return []
    anchor = min(form.needs, key=lambda w: (len(index[w]) * form.counts[w], w))
    offsets = [q for q, w in enumerate(form.words) if w == anchor]
    size = len(form.words)
    out = []
    for low, high in sorted({(max(0, p - q - most), p - q + size + most) for p in index[anchor] for q in offsets}):
        have = Counter(spell[low:high])
        if (all(have[w] >= n for w, n in form.needs.items())
                and sum(min(n, have[w]) for w, n in form.counts.items()) >= size - most):
            out.append((low, high))
    return out


def confirm(form: Notice, spell: list[str | None], low: int, high: int, cue: tuple[int, int],
            max_differences: float) -> tuple[int, int, int, int] | None:
    """(differences, first word, end, words aligned) of the template's best
    alignment in words low..high that holds a word of the cue, or None."""
    most = int(max_differences * len(form.words))
    index: dict[str, list[int]] = {}
    for i in range(low, high):
        if spell[i] is not None:
            index.setdefault(spell[i], []).append(i)
    fits = []
    for a, b in blocks(form, spell, index, most):
        a, b = max(a, low), min(b, high)
        fit = align(form, spell[a:b], most)
        if fit and a + fit[1] < cue[1] and a + fit[2] > cue[0]:
            fits.append((fit[0], a + fit[1], a + fit[2], fit[3]))
    return min(fits, default=None)


def scan_text(text: str | None, templates: dict[str, str | tuple[str, ...]] = ALL, max_differences: float = 0.2) -> list[dict]:
    """Confirmed licence notices of a whole text, in order of position."""
    found = []
    if not text or not (CUE.search(text) or ID_CUE.search(text)):
        return found
    forms = [notice(name, t) for name, ts in templates.items() for t in ((ts,) if isinstance(ts, str) else ts)]
    table = tuple((f.name, f.text) for f in forms)
    longest = max((len(f.text) for f in forms), default=0)
    for start, stop, asked in regions(text, 2 * longest):
        places = words(text[start:stop])
        spell: list[str | None] = [spelled(w) for w, _, _ in places]
        ends = [start + e for _, _, e in places]
        have = Counter(spell)
        # templates whose identifying words are all in the region: no other can be confirmed there
        able = [k for k, f in enumerate(forms) if all(have[w] >= n for w, n in f.needs.items())]
        reach = max((len(forms[k].words) + int(max_differences * len(forms[k].words)) for k in able), default=0)
        for at, end in asked:
            first = bisect_right(ends, at)  # the words of the cue
            last = first
            while last < len(places) and start + places[last][1] < end:
                last += 1
            if not able or first == last or None in spell[first:last]:
                continue
            low, high = max(0, first - reach), min(len(places), last + reach)
            for i in range(low, high):  # up to the next notices taken
                if spell[i] is None:
                    low, high = (i + 1, high) if i < first else (low, min(high, i))
            saved = reductions(" ".join(spell[low:high]).encode(), table)
            best = None
            for k in sorted(able, key=lambda k: (-saved[k], len(forms[k].text), forms[k].name)):
                if best and saved[k] < best[0] - CLOSE:
                    break
                fit = confirm(forms[k], spell, low, high, (first, last), max_differences)
                if fit is None:
                    continue
                differ, i, j, same = fit
                other = i and spell[i - 1] in BEFORE and spell[i] in NAMES | COMMON
                if other or AFTER.match(text, ends[j - 1]) or forms[k].id not in text[start + places[i][1]:ends[j - 1]]:
                    continue
                if best is None or differ < best[1]:
                    best = (best[0] if best else saved[k], differ, i, j, same, k)
                if not differ:
                    break
            if best:
                _, _, i, j, same, k = best
                spell[i:j] = [None] * (j - i)
                found.append({"license": forms[k].name, "start": start + places[i][1], "end": ends[j - 1], "saved": saved[k],
                              "missing": len(forms[k].words) - same, "extra": j - i - same})
    return sorted(found, key=lambda x: (x["start"], x["end"], x["license"]))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  templates: dict[str, str | tuple[str, ...]] = ALL, max_differences: float = 0.2) -> DataFrame:
    """(id_col, licenses array<struct<license, start, end, saved, missing,
    extra>>) per row; positions are code points.

    Defined cases: a null or empty text has none; a null id stays null; of
    the templates confirmed at a cue the one with the largest size reduction
    wins, among close ones that with the fewest differences, then the
    shortest; notices never overlap; repeated rows give
    repeated results; an empty table gives an empty result. Whole texts, no
    shuffle; only the two named columns are read.
    """
    names = ["license", "start", "end", "saved", "missing", "extra"]
    kind = pa.list_(pa.struct([(n, pa.string() if n == "license" else pa.int64()) for n in names]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            out = [scan_text(t, templates, max_differences) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(out, kind)], names=["id", "licenses"])

    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    fields = ", ".join(f"{n}: {'string' if n == 'license' else 'long'}" for n in names)
    return (plain.mapInArrow(run, f"id {dict(plain.dtypes)['id']}, licenses array<struct<{fields}>>")
            .withColumnRenamed("id", id_col))
