"""Exact encoding of whole texts piece by piece with the tokenizers library.

Both public vocabularies split a text before their merges, and a single blank
or line break between two non-blank characters always ends such a part. Texts
are cut there, each distinct piece is encoded once by the library and kept in a
table per worker, bounded by bytes, as a piece can be of any length; a text is the
concatenation of its pieces. A piece that ends in full stops or commas after a letter is split once more.
"""

from __future__ import annotations

import os
import re
import unicodedata

import numpy as np

KEPT_BYTES = 64 << 20  # a worker's table: texts, ids and ENTRY bytes a piece
IDS_BYTES = 256 << 20  # the same of a table of ids; a piece met again after the table was emptied is encoded again
ENTRY = 180
JOINED = 2048
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
_OTHER_SPACE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]


def load_tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _single_spaced(text: str) -> bool:
    """Whether single blanks or line breaks between words are all the white space of a text."""
    flat = text.replace("\n", " ")
    return not (flat[0] == " " or flat[-1] == " " or "  " in flat or any(c in text for c in _OTHER_SPACE))


def _stem(piece: str) -> str:
    """The piece without final full stops and commas, if a letter stands before them."""
    if piece[-1] not in ".,":
        return piece
    stem = piece.rstrip(".,")
    last = stem[-1:] if stem[-1:].isascii() else unicodedata.normalize("NFC", stem[-1]).lower()
    return stem if last.isalpha() else piece


class PieceIds:
    """Token ids of texts for a byte-level vocabulary, as little-endian bytes.

    ``kept`` has pieces by their text without the blank before them; a piece
    that starts a line or holds other white space is kept under its own text,
    one that starts a text in ``first``.
    """

    def __init__(self, path: str, dtype: str):
        self.tokenizer, self.dtype = load_tokenizer(path), dtype
        vocabulary = self.tokenizer.get_vocab()
        self.begins = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.begins[[i for token, i in vocabulary.items() if token.startswith("Ġ")]] = True  # a blank in byte-level text
        self.kept: dict[str, bytes] = {}
        self.first: dict[str, bytes] = {}
        self.size = 0

    def _each(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _after_blank(self, pieces: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for start in range(0, len(pieces), JOINED):
            part = pieces[start:start + JOINED]
            ids = np.array(self.tokenizer.encode_batch_fast([" " + " ".join(part)], add_special_tokens=False)[0].ids, dtype=self.dtype)
            at = np.flatnonzero(self.begins[ids])
            if len(at) == len(part) and at[0] == 0:
                data, width = ids.tobytes(), ids.itemsize
                ends = [*(at[1:] * width).tolist(), len(data)]
                out += [data[a:b] for a, b in zip((at * width).tolist(), ends)]
            else:
                out += self._each([" " + p for p in part])
        return out

    def _learn(self, missing: set[str]) -> None:
        words = {p for p in missing if p.split() == [p]}
        others = list(missing - words)
        self._keep(others, self._each(others))
        stems = {p: _stem(p) for p in words}
        new = list(set(stems.values()).difference(self.kept))
        self._keep(new, self._after_blank(new))
        ended = [(p, s, p[len(s):]) for p, s in stems.items() if len(s) < len(p)]
        tails = list({tail for _, _, tail in ended})
        tail_ids = dict(zip(tails, self._each(tails)))
        self._keep([p for p, _, _ in ended], [self.kept[s] + tail_ids[tail] for _, s, tail in ended])

    def _keep(self, pieces: list[str], ids: list[bytes], table: dict | None = None) -> None:
        (self.kept if table is None else table).update(zip(pieces, ids))
        self.size += sum(map(len, pieces)) + sum(map(len, ids)) + ENTRY * len(pieces)

    @staticmethod
    def _pieces(text: str) -> list[str]:
        """The first piece as it stands, the later ones without one blank before a word."""
        if not text:
            return []
        if _single_spaced(text):
            return text.replace("\n", " \n").split(" ")
        pieces = _CUT.split(text)
        return pieces[:1] + [p[1:] if p[0] == " " and p[1:].split() == [p[1:]] else p for p in pieces[1:]]

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.size > IDS_BYTES:
            self.kept, self.first, self.size = {}, {}, 0
        plans, missing, starts = [], set(), {}
        for text in texts:
            pieces = self._pieces(text)
            found = list(map(self.kept.get, pieces))
            if pieces:
                found[0] = self.first.get(pieces[0])
            holes = {} if all(found) else {i: pieces[i] for i, ids in enumerate(found) if not ids}
            if 0 in holes:
                starts[holes[0]] = None
            missing.update(p for i, p in holes.items() if i)
            plans.append((found, holes))
        self._learn(missing)
        self._keep(list(starts), self._each(list(starts)), self.first)
        for found, holes in plans:
            for i, p in holes.items():
                found[i] = self.kept[p] if i else self.first[p]
        return [b"".join(found) for found, _ in plans]


class PieceCounts:
    """Token counts for a vocabulary with word ends, which drops white space: pieces stand between blanks and line breaks."""

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.kept: dict[str, int] = {"": 0}
        self.size = 0

    def _each(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list[int]:
        """Counts of words of letters only, each of which has one word end."""
        out: list[int] = []
        for start in range(0, len(words), JOINED):
            part = words[start:start + JOINED]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids)
            at = np.flatnonzero(self.ends[ids]) if len(ids) else np.empty(0, dtype="int64")
            out += np.diff(at, prepend=-1).tolist() if len(at) == len(part) else self._each(part)
        return out

    def learn(self, pieces: set[str]) -> None:
        if self.size > KEPT_BYTES:
            self.kept, self.size = {"": 0}, 0
        stems = {p: _stem(p) for p in pieces.difference(self.kept)}
        new = [s for s in dict.fromkeys(stems.values()) if s not in self.kept]
        words = [s for s in new if s.isalpha()]
        others = [s for s in new if not s.isalpha()]
        self._keep(dict(zip(words, self._words(words))))
        self._keep(dict(zip(others, self._each(others))))
        ended = {p: s for p, s in stems.items() if len(s) < len(p)}
        tails = list({p[len(s):] for p, s in ended.items()})
        tail = dict(zip(tails, self._each(tails)))
        self._keep({p: self.kept[s] + tail[p[len(s):]] for p, s in ended.items()})

    def _keep(self, counts: dict[str, int]) -> None:
        self.kept.update(counts)
        self.size += sum(map(len, counts)) + ENTRY * len(counts)
