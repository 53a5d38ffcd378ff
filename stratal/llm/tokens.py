"""Encoding of many short strings with a tokenizer file of the tokenizers
library, and of whole texts through a bounded memory of their pieces."""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

GROUP = 512  # strings per call of the library
MEMORY = 1 << 19  # pieces a Python worker remembers
ODD = re.compile("[\x00\x1c-\x1f]")  # where white space of Python and of the library differ, and our mark
_LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
# where the split pattern ends a word whatever stands around: a letter before an ASCII character that is none, a single
# line end before the next word
CUT = re.compile(rf"(?<=[{_LETTERS}])(?=[\t-\r!-@\[-`{{-~])|(?<=[!-~{_LETTERS}]\n)(?=[!-~{_LETTERS}])")
LEAD = re.compile(r"(?:^| )(?:\s|\Z)")


class Encoder:
    """Ids of independent strings, many per library call.

    Strings are joined with a special token of the file, which the library
    cuts out before anything else, so each is encoded as if alone; strings
    that hold a special token themselves are encoded one by one.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = [t.content for t in added.values()]
        plain = [(i, t.content) for i, t in added.items() if t.special and not (t.lstrip or t.rstrip or t.normalized)]
        self.sep_id, self.sep = plain[0] if plain else (None, None)

    def one(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def has_special(self, text: str) -> bool:
        return any(s in text for s in self.special)

    def flat(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all strings, ids per string)."""
        if self.sep is None or self.has_special("".join(strings)):
            odd = {i for i, s in enumerate(strings) if self.sep is None or self.has_special(s)}
            if odd:
                ids, lens = self.flat([s for i, s in enumerate(strings) if i not in odd])
                plain = iter(np.split(ids, np.cumsum(lens)[:-1]) if len(lens) else [])
                parts = [self.one(s) if i in odd else next(plain) for i, s in enumerate(strings)]
                return np.concatenate(parts), np.array([len(x) for x in parts], np.int64)
        if not strings:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        joined = [self.sep.join(strings[k:k + GROUP]) for k in range(0, len(strings), GROUP)]
        between = np.array([self.sep_id], np.uint32)
        parts = []
        for encoding in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False):
            parts += [np.array(encoding.ids, np.uint32), between]
        ids = np.concatenate(parts[:-1])
        cuts = np.flatnonzero(ids == self.sep_id)
        if len(cuts) != len(strings) - 1:
            raise ValueError("the separator token was not kept apart")
        return ids[ids != self.sep_id], np.diff(np.concatenate([[-1], cuts, [len(ids)]])) - 1


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def spread(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The slices flat[start:start + len], one after another."""
    total = int(lens.sum())
    kind = np.int32 if max(len(flat), total) < 1 << 31 else np.int64
    at = np.repeat((starts - (np.cumsum(lens) - lens)).astype(kind), lens)
    at += np.arange(total, dtype=kind)
    return flat[at]


def id_column(ids: np.ndarray, lens: np.ndarray) -> pa.Array:
    """A binary column: each row's ids as little-endian unsigned 32-bit."""
    ends = np.concatenate([[0], np.cumsum(lens) * 4]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lens),
                                 [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(ids.astype("<u4").tobytes())])


class TextEncoder:
    """Ids of whole texts for a byte-level file that splits before spaces.

    The split pattern always starts a new word at a space that a non-space
    follows, so a text is its first piece and the pieces " x..." after it;
    each is looked up. Unknown pieces are cut further where the pattern always
    ends a word as well (``CUT``: before punctuation, after a line end), so
    that a word is one unit whatever follows it, and only unknown units go to
    the library. At most ``memory`` units are remembered per worker; beyond it
    units are encoded anew per slice. Texts with control characters on which the white-space
    classes differ, or with special tokens, go to the library whole.
    """

    def __init__(self, path: str, memory: int = MEMORY):
        self.encoder, self.memory = encoder(path), memory
        tokenizer = self.encoder.tokenizer
        tokens = map(tokenizer.id_to_token, range(tokenizer.get_vocab_size()))
        self.spaced = np.array([(t or "")[:1] == "\u0120" for t in tokens])  # the byte-level sign of a space
        self.codes: dict[str, int] = {}
        self.flat = np.empty(1 << 20, np.uint32)
        self.starts = np.empty(1 << 16, np.int64)
        self.lens = np.empty(1 << 16, np.int64)
        self.n = self.used = 0

    def _store(self, ids: np.ndarray, lens: np.ndarray) -> None:
        n, used = self.n + len(lens), self.used + len(ids)
        if n > len(self.starts):
            self.starts = np.resize(self.starts, 2 * n)
            self.lens = np.resize(self.lens, 2 * n)
        if used > len(self.flat):
            self.flat = np.resize(self.flat, 2 * used)
        self.starts[self.n:n] = self.used + np.cumsum(lens) - lens
        self.lens[self.n:n] = lens
        self.flat[self.used:used] = ids
        self.n, self.used = n, used

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per word) of words behind a space: only a word's first id begins with one."""
        if words:
            lines = [" " + " ".join(words[k:k + GROUP]) for k in range(0, len(words), GROUP)]
            found = self.encoder.tokenizer.encode_batch_fast(lines, add_special_tokens=False)
            ids = np.concatenate([np.array(e.ids, np.uint32) for e in found])
            first = np.flatnonzero(self.spaced[ids])
            if len(first) == len(words) and first[0] == 0:
                return ids, np.diff(np.append(first, len(ids)))
        return self.encoder.flat([" " + w for w in words])

    def _units(self, units: list[str], extra: dict[str, int]) -> np.ndarray:
        """Codes of units; what is not known goes to the library, each once."""
        found = np.fromiter(map(self.codes.get, units, repeat(-2)), np.int64, len(units))
        gaps = np.flatnonzero(found == -2)
        wanted = [units[i] for i in gaps]
        new = [u for u in dict.fromkeys(wanted) if u not in extra]
        # remembered units are stored before all others
        base, room = self.n, max(0, self.memory - len(self.codes)) if self.n == len(self.codes) else 0
        new.sort(key=str.isalpha)
        plain = sum(map(str.isalpha, new))  # words of letters behind a space, last
        self._store(*self.encoder.flat([u[1:] if u[:1] == "\0" else " " + u for u in new[:len(new) - plain]]))
        self._store(*self._words(new[len(new) - plain:]))
        now = dict(zip(new, range(base, base + len(new))))
        self.codes.update(zip(new[:room], range(base, base + room)))
        extra.update(zip(new[room:], range(base + room, base + len(new))))
        found[gaps] = [now[u] if u in now else extra[u] for u in wanted]
        return found

    def _lookup(self, pieces: list[str], extra: dict[str, int]) -> np.ndarray:
        """Codes of distinct pieces ('\0' marks a text's first piece); -1: not a piece."""
        found = np.fromiter(map(self.codes.get, pieces, repeat(-2)), np.int64, len(pieces))
        gaps = np.flatnonzero(found == -2)
        wanted = [pieces[i] for i in gaps]
        good = [p for p in wanted if p not in extra] if extra else wanted
        blob = " ".join(good)
        odd = bool(ODD.search(blob.replace("\0", ""))) or self.encoder.has_special(blob)
        if odd or LEAD.search(blob):
            bad = {p for p in good if not p or p[0].isspace() or odd and bool(ODD.search(p.lstrip("\0")) or self.encoder.has_special(p))}
            extra.update(dict.fromkeys(bad, -1))
            good = [p for p in good if p not in bad]
        spaced = [p for p in good if " " in p] if blob.count(" ") >= len(good) else []  # of texts cut by hand
        if spaced:
            good = [p for p in good if " " not in p]
        if not good and not spaced:
            found[gaps] = [extra[p] for p in wanted]
            return found
        letters = np.fromiter(map(str.isalpha, good), bool, len(good))  # each a unit itself
        mixed, plain = [good[i] for i in np.flatnonzero(~letters)], [good[i] for i in np.flatnonzero(letters)]
        # "\x1f" between the units of a piece, "\0" before those that no space precedes
        cut = CUT.sub("\x1f\0", " ".join(mixed))
        units = cut.replace(" ", "\x1f").split("\x1f") if mixed else []
        raw = np.frombuffer(cut.encode(), np.uint8)
        first = np.flatnonzero(np.concatenate([[True], raw[(raw == 32) | (raw == 31)] == 32])) if mixed else np.empty(0, np.int64)
        codes = self._units(units + plain + spaced, extra)
        size = np.diff(np.append(first, len(units)))
        own, many = codes[first], size > 1
        if many.any():  # pieces of several units: stored for this slice
            parts, size = codes[:len(units)][np.repeat(many, size)], size[many]
            lens = self.lens[parts]
            own[many] = np.arange(self.n, self.n + len(size))
            self._store(spread(self.flat, self.starts[parts], lens), np.add.reduceat(lens, np.cumsum(size) - size))
        if len(good) == len(wanted):
            late = np.empty(len(good), np.int64)
            late[~letters], late[letters] = own, codes[len(units):]
            found[gaps] = late
        else:
            at = dict(zip(mixed + plain + spaced, [*own.tolist(), *codes[len(units):].tolist()]))
            found[gaps] = [at[p] if p in at else extra[p] for p in wanted]
        return found

    def _codes(self, lists: pa.ListArray, extra: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
        """(code of every piece, first piece of each text and the end): each
        distinct piece of the slice is looked up once."""
        coded = lists.flatten().dictionary_encode()
        one = pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary)
        pieces = pc.binary_join(one, " ")[0].as_py().split(" ")  # far faster than value by value
        if len(pieces) != len(coded.dictionary):  # none, or some with spaces
            pieces = coded.dictionary.to_pylist()
        codes = self._lookup(pieces, extra)
        return codes[coded.indices.to_numpy()] if len(coded) else codes, lists.offsets.to_numpy().astype(np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids per text)."""
        if not texts:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        extra: dict[str, int] = {}
        whole = {i: self.encoder.one(t) for i, t in enumerate(texts) if "\0" in t}  # our mark
        plain = pa.array(["\0" if i in whole else "\0" + t for i, t in enumerate(texts)], pa.string())
        lists = pc.split_pattern(plain, " ")
        codes, off = self._codes(lists, extra)
        bad = np.minimum.reduceat(codes, off[:-1]) < 0
        if bad.any():
            split = lists.to_pylist()
            for i in np.flatnonzero(bad):
                if ODD.search(texts[i]) or self.encoder.has_special(texts[i]):
                    whole[i] = self.encoder.one(texts[i])
                    split[i] = ["\0"]
                else:
                    split[i] = re.split(r" (?=\S)", texts[i])
                    split[i][0] = "\0" + split[i][0]
            codes, off = self._codes(pa.array(split, pa.list_(pa.string())), extra)
        lens = self.lens[codes]
        ids = spread(self.flat, self.starts[codes], lens)
        through = np.concatenate([[0], np.cumsum(lens)])[off]
        counts = np.diff(through)
        if whole:
            parts = np.split(ids, through[1:-1])
            for i, a in whole.items():
                parts[i], counts[i] = a, len(a)
            ids = np.concatenate(parts)
        if self.n > len(self.codes):  # forget what did not fit: it is stored after the remembered pieces
            self.n = len(self.codes)
            self.used = int(self.starts[self.n - 1] + self.lens[self.n - 1]) if self.n else 0
        return ids, counts


@lru_cache(maxsize=2)
def text_encoder(path: str, memory: int = MEMORY) -> TextEncoder:
    return TextEncoder(path, memory)
