"""Encoding with the ``tokenizers`` library, one distinct word at a time.

A text is cut at each space and line's end that has no other white space beside
it. The pre-tokenizers of the vocabularies used here never join characters
across such a place, so a text's ids are the ids of its words one after the
other. Words repeat a lot: each Python worker keeps bounded tables of ids, finds
a batch's words there with numpy (see ``words``), and asks the library only for
unknown atoms of words, many at a time.

A text with other white space or very long words is cut at its single spaces
and encoded chunk by chunk. A text that holds one of the vocabulary's special
strings goes to the library whole, because there the special string is cut out
first.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa

from .words import Table, byte_set, column_bytes, hashes, rows_of, runs

# Single-threaded: Spark already runs one worker per core.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_ODD_SPACE = re.compile(r"\s\s|^\s|\s$")
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Chunks (about 200 bytes each) after which a worker's table becomes its old one.
CACHE_LIMIT = 400_000
#: Longer chunks are not kept in a table.
LONG = 256
#: A run that ends in a letter or digit, then ASCII punctuation without the apostrophe (it
#: begins contractions). "\u0130" is left out: lower-cased it ends in a combining mark.
_SIMPLE = re.compile("([^\\s]*[0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f])"
                     r"([!-&(-/:-@\[-`{-~]*)")
_MARK = "\x01"
#: Words (about 50 bytes each) after which a worker's word table starts anew.
WORD_LIMIT = 1_500_000
#: Unknown words in one call of the library.
_CALL = 4096
_CUTS = byte_set(b" \n")
#: White space that isn't a space or a line's end (and the mark): ASCII, and the lead bytes of the rest.
_OTHER_SPACE = byte_set([1, 9, 11, 12, 13, 28, 29, 30, 31])
_LEADS = byte_set([0xC2, 0xE1, 0xE2, 0xE3])
#: What tells words after a space from others in their keys.
_LED = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PUNCT = byte_set([c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"])
_ALNUM = byte_set([c for c in range(48, 123) if chr(c).isalnum()])


def core_ends(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where the ASCII punctuation at each word's end begins, if a letter or digit is before
    it that the pre-tokenizers cut it from (see ``_SIMPLE``); else the word's end."""
    out = ends.copy()
    at = np.flatnonzero(_PUNCT[data[ends - 1]])
    begin, last = starts[at], ends[at] - 1
    going = np.arange(len(at))
    while len(going):  # back over the punctuation, together in all words that have more of it
        last[going] -= 1
        going = going[last[going] >= begin[going]]
        going = going[_PUNCT[data[last[going]]]]
    had = last >= begin
    at, last, begin = at[had], last[had], begin[had]
    c, lead = data[last], data[np.maximum(last - 1, 0)]
    latin = ((lead == 0xC3) & (c != 0x97) & (c != 0xB7) | (lead >= 0xC4) & (lead <= 0xC8) & ((lead != 0xC4) | (c != 0xB0))
             | (lead == 0xC9) & (c <= 0x8F)) & (c >= 0x80) & (c < 0xC0) & (last > begin)
    ok = _ALNUM[c] | latin
    out[at[ok]] = last[ok] + 1
    return out


def odd_rows(data: np.ndarray, offsets: np.ndarray, specials: list[str]) -> np.ndarray:
    """Rows that single spaces and line ends alone don't cut safely: with other white space,
    white space at either end or side by side, or a special string."""
    n = len(offsets) - 1
    cut = _CUTS[data]
    bad = _OTHER_SPACE[data]
    bad[1:] |= cut[1:] & cut[:-1]
    filled = np.flatnonzero(np.diff(offsets) > 0)
    first, last = offsets[filled], offsets[filled + 1] - 1
    bad[first] |= cut[first]
    bad[last] |= cut[last]
    odd = np.zeros(n, bool)
    odd[np.searchsorted(offsets, np.flatnonzero(bad), side="right") - 1] = True
    # Wide white space is told by two or three bytes; only rows with a lead byte are looked at.
    lead = np.flatnonzero(_LEADS[data])
    if len(lead):
        after = data[np.minimum(lead + 1, len(data) - 1)]
        third = data[np.minimum(lead + 2, len(data) - 1)]
        kind = data[lead]
        wide = ((kind == 0xC2) & ((after == 0x85) | (after == 0xA0)) | (kind == 0xE1) & (after == 0x9A) & (third == 0x80)
                | (kind == 0xE2) & (after == 0x80) & ((third <= 0x8A) | (third == 0xA8) | (third == 0xA9) | (third == 0xAF))
                | (kind == 0xE2) & (after == 0x81) & (third == 0x9F) | (kind == 0xE3) & (after == 0x80) & (third == 0x80))
        odd[np.searchsorted(offsets, lead[wide], side="right") - 1] = True
    raw = None
    for s in specials:
        raw = data.tobytes() if raw is None else raw
        if (k := raw.find(s.encode())) >= 0:
            while k >= 0:
                odd[np.searchsorted(offsets, k, side="right") - 1] = True
                k = raw.find(s.encode(), k + 1)
    return odd




def cut_chunks(text: str) -> list[str]:
    """The chunks of a text, each but the first with its leading space."""
    parts = _CUT.split(text) if _ODD_SPACE.search(text) else text.split(" ")
    return parts[:1] + [" " + p for p in parts[1:]]


def is_regular(chunk: str) -> bool:
    """One leading space and no other white space at either end."""
    return len(chunk) > 1 and chunk[0] == " " and not chunk[1].isspace() and not chunk[-1].isspace()


class ChunkTable:
    """chunk -> value, bounded; ``missing`` computes the values of new chunks.

    A full table becomes the old one; what is met again moves over from there,
    so frequent chunks stay known.
    """

    def __init__(self, missing, limit: int = CACHE_LIMIT):
        self.known: dict = {}
        self.old: dict = {}
        self.missing = missing
        self.limit = limit

    def values(self, batch: list[list[str]]):
        """For each list of chunks, the list of their values."""
        if len(self.known) > self.limit:
            self.known, self.old = {}, self.known
        known, old = self.known, self.old
        new = set().union(*batch).difference(known)
        if new and old:
            known.update((c, old[c]) for c in new if c in old)
            new = new.difference(known)
        if new:
            new = list(new)
            known.update(zip(new, self.missing(new)))
        for chunks in batch:
            yield map(known.__getitem__, chunks)


class Encoder:
    """Ids of whole texts by ``tokenizers``, without added special tokens.

    A chunk's ids come from its atoms: lines, and the ASCII punctuation at a
    line's end apart from the letter or digit before it. Chunks and atoms are
    kept in tables by what follows the cut space.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        #: Whether the vocabulary's normalizer lowers all letters: then A-Z needn't be told from a-z.
        self.lowers = '"Lowercase"' in json.dumps(json.loads(self.tok.to_str()).get("normalizer"))
        size = self.tok.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.specials = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        # Whether a leading space shows in the ids, and what tells joined atoms apart.
        ids = self.tok.encode("\n", add_special_tokens=False).ids
        self.lead = " " if self._whole(" a") != self._whole("a") else ""
        self.between = "\n" if len(ids) == 1 else f" {_MARK} "
        mark = ids or self.tok.encode(self.between, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        self.bodies = ChunkTable(self._bodies)
        self.atoms = ChunkTable(self._atoms)
        self.literal = ChunkTable(lambda new: [self._whole(c) for c in new])
        #: Whether a word after a line's end has the ids that it has alone.
        self.splits = self._whole("\na") == self._whole("\n") + self._whole("a")
        self._forget()

    def _whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _joined(self, atoms: list[str]) -> list[bytes] | None:
        """Ids of atoms from one call, or None if their ends can't be told."""
        ids = np.array(self.tok.encode(self.between.join(atoms), add_special_tokens=False).ids, self.dtype)
        ends = np.flatnonzero(ids == self.mark)
        if self.mark is None or len(ends) != len(atoms) - 1:
            return None
        raw, w = ids.tobytes(), self.dtype.itemsize
        return [raw[a:b] for a, b in zip([0, *((ends + 1) * w).tolist()], [*(ends * w).tolist(), len(raw)])]

    def _atoms(self, new: list[str]) -> list[bytes]:
        out = dict.fromkeys(new)
        plain = [a for a in new if "\n" not in a and _MARK not in a]
        for i in range(0, len(plain), 512):
            part = plain[i:i + 512]
            if (got := self._joined(part)) is not None:
                out.update(zip(part, got))
        return [self._whole(a) if v is None else v for a, v in out.items()]

    def _cut(self, body: str) -> list[str] | None:
        """The atoms of a space and ``body``, or None if the body is long or its ends are white space."""
        if len(body) <= LONG and (m := _SIMPLE.fullmatch(body)):
            return [self.lead + m[1], m[2]] if m[2] else [self.lead + body]
        if not 0 < len(body) <= LONG or body[0].isspace() or body[-1].isspace():
            return None
        lines = body.split("\n")
        if len(lines) > 1 and any(not x or x[0].isspace() or x[-1].isspace() for x in lines):
            return [" " + body]
        out, lead = [], self.lead
        for line in lines:
            if out:
                out.append("\n")
            if m := _SIMPLE.fullmatch(line):
                out.append(lead + m[1])
                if m[2]:
                    out.append(m[2])
            else:
                out.append(lead + line)
            lead = ""
        return out

    def _bodies(self, new: list[str]) -> list[bytes | None]:
        cut = [self._cut(b) for b in new]
        return [None if atoms is None else b"".join(got)
                for atoms, got in zip(cut, self.atoms.values([a or [] for a in cut]))]

    def _literal(self, chunk: str) -> bytes:
        return self._whole(chunk) if len(chunk) > LONG else next(next(self.literal.values([[chunk]])))

    def _odd(self, text: str) -> bytes:
        """Ids of a text with runs of white space or long chunks."""
        first, *rest = _CUT.split(text)
        return self._literal(first) + b"".join([
            self._literal(" " + c) if v is None else v
            for c, v in zip(rest, next(self.bodies.values([rest])))])

    def _forget(self):
        """Empty tables; row 0 of the pool is a line's end."""
        end = np.frombuffer(self._whole("\n"), self.dtype)
        self.table, self.pool, self.at, self.size = Table(), end.copy(), np.zeros(1, np.int64), np.array([len(end)])
        self.table.add(np.ones(1, np.uint64))

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lead: bool):
        """(ids end to end, number of ids of each) of some units, after a lead or without."""
        before, after = (self.lead if lead else "").encode(), self.between.encode()
        width = len(before) + len(after)
        size = ends - starts + width
        to = np.cumsum(size) - size
        text = np.zeros(int(size.sum()), np.uint8)
        for k, c in enumerate(before):
            text[to + k] = c
        for k, c in enumerate(after):
            text[to + size - len(after) + k] = c
        inner = np.arange(len(text)) - np.repeat(to + len(before), size)
        mine = (inner >= 0) & (inner < np.repeat(ends - starts, size))
        text[mine] = data[(inner + np.repeat(starts, size))[mine]]
        raw = text[:len(text) - len(after)].tobytes().decode()
        ids = np.array(self.tok.encode_batch_fast([raw], add_special_tokens=False)[0].ids, self.dtype)
        marks = np.flatnonzero(ids == self.mark) if self.mark is not None else np.zeros(0, np.int64)
        if len(marks) == len(starts) - 1:
            sizes = np.diff(np.concatenate([[-1], marks, [len(ids)]])) - 1
            return np.delete(ids, marks), sizes
        got = [np.frombuffer(self._whole(before.decode() + bytes(data[i:j]).decode()), self.dtype)
               for i, j in zip(starts.tolist(), ends.tolist())]
        return np.concatenate(got), np.array([len(g) for g in got])

    def _rows(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lead: np.ndarray) -> np.ndarray:
        """Rows of units in the pool; unknown ones are encoded, many at a time, and added."""
        keys = hashes(data, starts, ends) ^ np.where(lead, _LED, np.uint64(0))
        keys[keys < 2] = 2
        at = self.table.find(keys)
        unknown = np.flatnonzero(at < 0)
        if len(unknown):
            new, first = np.unique(keys[unknown], return_index=True)
            first = unknown[first]
            order = np.argsort(lead[first], kind="stable")
            new, first = new[order], first[order]
            plain = int(len(first) - lead[first].sum())
            cuts = sorted({*range(0, plain, _CALL), *range(plain, len(first), _CALL), plain, len(first)})
            got = [self._learn(data, starts[first[i:j]], ends[first[i:j]], i >= plain) for i, j in zip(cuts, cuts[1:])]
            sizes = np.concatenate([n for _, n in got])
            self.at = np.concatenate([self.at, len(self.pool) + np.cumsum(sizes) - sizes])
            self.size = np.concatenate([self.size, sizes])
            self.pool = np.concatenate([self.pool, *[g for g, _ in got]])
            self.table.add(new)
            at[unknown] = self.table.find(keys[unknown])
        return at

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows end to end, number of ids of each row); null rows are empty."""
        if self.table.rows > WORD_LIMIT:
            self._forget()
        data, offsets = column_bytes(column)
        # What words are encoded from; a special string that only arises by lowering makes a row odd too.
        told = _LOWER[data] if self.lowers else data
        specials = [s.lower() for s in self.specials] if self.lowers else self.specials
        odd = odd_rows(told, offsets, specials) if self.splits else np.diff(offsets) > 0
        starts, ends = runs(data, offsets, _CUTS)
        row = np.repeat(np.arange(len(column)), rows_of(starts, offsets))
        odd[row[ends - starts > LONG]] = True
        if odd.any():
            keep = ~odd[row]
            starts, ends, row = starts[keep], ends[keep], row[keep]
        if len(starts):
            begins = starts == offsets[row]
            line = ~begins & (data[starts - 1] == 10)
            core = core_ends(data, starts, ends)
            tail = core < ends
            # Units in order: each word's core, then the punctuation after it.
            n = 1 + tail
            first = np.cumsum(n) - n
            after = first[tail] + 1
            begin, end, led = (np.zeros(int(n.sum()), t) for t in (np.int64, np.int64, bool))
            begin[first], end[first], led[first] = starts, core, ~begins & ~line
            begin[after], end[after] = core[tail], ends[tail]
            units = self._rows(told, begin, end, led)
            # Row 0 of the pool, a line's end, before the words that follow one.
            n = n + line
            at = np.zeros(int(n.sum()), np.int64)
            mine = np.ones(len(at), bool)
            mine[(np.cumsum(n) - n)[line]] = False
            at[mine] = units
            sizes = self.size[at]
            ids = self.pool[np.repeat(self.at[at] - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))]
            counts = np.bincount(np.repeat(row, n), sizes, len(column)).astype(np.int64)
        else:
            ids, counts = np.zeros(0, self.dtype), np.zeros(len(column), np.int64)
        return self._with_odd(data, offsets, odd, ids, counts) if odd.any() else (ids, counts)

    def _with_odd(self, data, offsets, odd, ids, counts):
        """The odd rows' ids put among those of the others."""
        own = np.flatnonzero(odd)
        got = [np.frombuffer(self._by_chunks(bytes(data[offsets[i]:offsets[i + 1]]).decode()), self.dtype)
               for i in own.tolist()]
        counts[own] = [len(g) for g in got]
        whole, edge = np.zeros(int(counts.sum()), self.dtype), np.cumsum(counts) - counts
        whole[np.repeat(~odd, counts)] = ids
        for i, g in zip(own, got):
            whole[edge[i]:edge[i] + len(g)] = g
        return whole, counts

    def _by_chunks(self, text: str) -> bytes:
        """Ids of a text with special strings, other white space or long words."""
        return self._whole(text) if any(s in text for s in self.specials) else self._odd(text)

    def encode_ended(self, column: pa.Array, end_id: int, dtype) -> tuple[np.ndarray, np.ndarray]:
        """Like :meth:`encode_column`, with ``end_id`` after each row's ids."""
        ids, counts = self.encode_column(column)
        counts = counts + 1
        last = np.cumsum(counts) - 1
        out = np.empty(int(counts.sum()), dtype)
        mine = np.ones(len(out), bool)
        mine[last] = False
        out[mine], out[last] = ids, end_id
        return out, counts

    def encode(self, texts: list[str]):
        """The ids of each text, as an array."""
        ids, counts = self.encode_column(pa.array(texts, pa.string()))
        return np.split(ids, np.cumsum(counts)[:-1]) if texts else []


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker and vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def sliced(batch, rows: int = 256):
    """Row slices of an Arrow batch, to bound what is held as Python objects."""
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)
