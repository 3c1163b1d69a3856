"""Whole texts to token ids, every distinct stretch between blanks or line ends encoded once a worker.

Both kinds of vocabulary end a token before a blank or line end that follows no white space (the pre-tokeniser of the
byte-level one cuts there; no piece of the other has either after another character), so the stretches of a text encode
one by one to what the whole text encodes to. Stretches are kept with their ids up to a fixed number, so each is handed
to the tokeniser library once; longer ones are not kept, and texts in which a stretch does not come back as it was are
encoded as they are.
"""

from __future__ import annotations

import itertools
import os
import re
from collections.abc import Callable

import numpy as np

#: Fixed place of the public vocabulary files on this kind of machine; a parameter of everything that uses them.
BYTE_LEVEL, PIECES = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
#: Stretches kept by a worker, and the longest one that is kept, in characters.
KEPT, SHORT = 400_000, 48
_CUT, _RUN = re.compile(r"(?<=\S)(?=[ \n])"), re.compile(r"\s[ \n]")
#: Stretches of a byte-level vocabulary that go to the library as one text.
TOGETHER = 100


def stretched(whole: str) -> list[str]:
    """The text cut before every blank or line end that follows no white space of any kind."""
    if "\0" in whole or _RUN.search(whole):
        return _CUT.split(whole)
    parts = whole.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")  # each of them follows none
    return parts if parts[0] else parts[1:]


def byte_symbols() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it prints, else the next from U+0100 on."""
    prints = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """A byte-level vocabulary of the tokenizers library. ``special``: strings of special tokens in a text become those tokens."""

    def __init__(self, path: str = BYTE_LEVEL, special: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        #: A special token's string may hold anything, so texts with one are not cut.
        self.marks = sorted(t.content for t in self.tokenizer.get_added_tokens_decoder().values()) if special else []
        symbol = byte_symbols()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        entries = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.bytes = [bytes(symbol[c] for c in e) if all(c in symbol for c in e) else e.encode() for e in entries]

        self.sizes = np.array([len(b) for b in self.bytes])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_stretches(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many each stretch has); many go to the library as one text, each of which ends where its bytes do."""
        got = self.encode(["".join(texts[i : i + TOGETHER]) for i in range(0, len(texts), TOGETHER)])
        ids = np.concatenate(got)
        chars = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        raw = np.frombuffer("".join(texts).encode("utf-8", "surrogatepass"), np.uint8)
        begins = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))  # of characters
        return ids, np.diff(np.searchsorted(np.cumsum(self.sizes[ids]), begins[chars], side="right"), prepend=0)


class Pieces:
    """A vocabulary of pieces with byte fallback of the sentencepiece library, which puts a blank before each text itself."""

    marks: tuple[str, ...] = ()

    def __init__(self, path: str = PIECES):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any("▁" in n.lstrip("▁") or "\n" in n for n in names):
            raise ValueError("a piece holds a blank after another character, or a line end: texts cannot be cut there")
        self.blank = names.index("▁")
        self.bytes = [bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Of texts that begin with a blank, or with a line end: then the library's own blank is a piece by itself, and goes."""
        got = self.model.encode([t[1:] if t[0] == " " else t for t in texts], num_threads=1)
        for t, ids in zip(texts, got):
            if t[0] == "\n" and ids.pop(0) != self.blank:
                raise ValueError("a line end has become part of a piece")
        return [np.array(ids, np.uint32) for ids in got]

    def encode_stretches(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = self.model.encode([t[1:] if t[0] == " " else t for t in texts], num_threads=1)
        sizes = np.fromiter(map(len, got), np.int64, len(got))
        ids = np.fromiter(itertools.chain.from_iterable(got), np.uint32, int(sizes.sum()))
        own = np.fromiter((t[0] == "\n" for t in texts), bool, len(texts))
        first = (np.cumsum(sizes) - sizes)[own]
        if (ids[first] != self.blank).any():
            raise ValueError("a line end has become part of a piece")
        return np.delete(ids, first), sizes - own


class Table:
    """The bytes of all entries of a vocabulary, one after another: what ids stand for is read off by slices."""

    def __init__(self, entries: list[bytes]):
        self.sizes = np.array([len(e) for e in entries], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))[:-1]
        self.flat = np.frombuffer(b"".join(entries), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.flat[stretches(self.starts[ids], self.sizes[ids])]


def stretches(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of all stretches, one after another."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(total)


def grown(x: np.ndarray, n: int) -> np.ndarray:
    """x with room for n values at least."""
    return x if n <= len(x) else np.concatenate((x, np.empty(max(len(x), n - len(x)), x.dtype)))


class Encoder:
    """Token ids of whole texts by a vocabulary; ``lead``: of a blank and the text."""

    def __init__(self, vocabulary: ByteLevel | Pieces, lead: bool, kept: int = KEPT, short: int = SHORT):
        self.vocabulary, self.lead, self.kept, self.short = vocabulary, lead, kept, short
        self.table = Table(vocabulary.bytes)
        self._clear()

    def _clear(self) -> None:
        self.memo: dict = {}
        # stretch k has flat[ends[k] : ends[k + 1]]; there are n of them
        self.flat, self.ends, self.sound, self.n = np.empty(1 << 16, np.uint32), np.zeros(1 << 16, np.int64), np.ones(1 << 16, bool), 0

    def _add(self, texts: list[str]) -> None:
        """Encodes stretches and keeps their ids."""
        plain = [t for t in texts if t[0] in " \n" and not t[-1].isspace()]
        if len(plain) < len(texts):  # the others could become one token with what follows
            for t in set(texts).difference(plain):
                self._put([t])
        self._put(plain)

    def _put(self, texts: list[str]) -> None:
        if not texts:
            return
        fresh, sizes = self.vocabulary.encode_stretches(texts)
        n, first = self.n, int(self.ends[self.n])
        self.flat, self.ends, self.sound = grown(self.flat, first + len(fresh)), grown(self.ends, n + len(texts) + 1), grown(self.sound, n + len(texts))
        self.flat[first : first + len(fresh)] = fresh
        self.ends[n + 1 : n + len(texts) + 1] = first + np.cumsum(sizes)
        back, given = self.table.joined(fresh).tobytes(), "".join(texts).encode("utf-8", "surrogatepass")
        if back == given:
            self.sound[n : n + len(texts)] = True
        else:
            ends = np.concatenate(([0], np.cumsum(self.table.sizes[fresh])))[np.cumsum(sizes)].tolist()
            self.sound[n : n + len(texts)] = [back[a:b] == t.encode("utf-8", "surrogatepass") for a, b, t in zip([0, *ends], ends, texts)]
        self.memo.update(zip(texts, range(n, n + len(texts))))
        self.n += len(texts)

    def _parts(self, text: str) -> list[str]:
        """Stretches that encode one by one; empty for a text that has to be encoded as it is."""
        whole = " " + text if self.lead else text
        return [] if any(m in whole for m in self.vocabulary.marks) else stretched(whole)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all texts, how many each has, whether its bytes come back as they were)."""
        if len(self.memo) > self.kept:
            self._clear()
        cut = [self._parts(t) for t in texts]
        every = list(itertools.chain.from_iterable(cut))
        at = np.fromiter(map(self.memo.get, every, itertools.repeat(-1)), np.int64, len(every))
        new = at < 0
        unknown = list(itertools.compress(every, new.tolist()))
        fresh = set(unknown)
        long = [p for p in fresh if len(p) > self.short]
        self._add([p for p in fresh if len(p) <= self.short])
        kept = self.n
        self._add(long)  # for this batch only
        at[new] = np.fromiter(map(self.memo.__getitem__, unknown), np.int64, len(unknown))
        for p in long:
            del self.memo[p]
        sizes = self.ends[at + 1] - self.ends[at]
        ids = self.flat[stretches(self.ends[at], sizes)]
        bounds = np.concatenate(([0], np.cumsum([len(c) for c in cut]))).astype(np.int64)
        total, sound = np.concatenate(([0], np.cumsum(sizes))), np.concatenate(([0], np.cumsum(~self.sound[at])))
        counts, good = total[bounds[1:]] - total[bounds[:-1]], sound[bounds[1:]] == sound[bounds[:-1]]
        self.n = kept
        redo = [i for i, (t, c) in enumerate(zip(texts, cut)) if (self.lead or t) and (not c or not good[i])]
        if redo:
            pieces = np.split(ids, total[bounds[1:-1]])
            for i in redo:
                whole = " " + texts[i] if self.lead else texts[i]
                pieces[i] = self.vocabulary.encode([whole])[0]
                counts[i], good[i] = len(pieces[i]), self.table.joined(pieces[i]).tobytes() == whole.encode("utf-8", "surrogatepass")
            ids = np.concatenate(pieces)
        return ids, counts, good


_made: dict[tuple, Encoder] = {}


def once(key: tuple, make: Callable[[], Encoder]) -> Encoder:
    """The worker's own encoder for a key (its kind, path and options): vocabularies are read once and what is kept stays."""
    if key not in _made:
        _made[key] = make()
    return _made[key]


def byte_level(path: str, lead: bool, special: bool, kept: int = KEPT) -> Encoder:
    return once(("byte-level", path, lead, special, kept), lambda: Encoder(ByteLevel(path, special), lead, kept))


def of_pieces(path: str) -> Encoder:
    return once(("pieces", path), lambda: Encoder(Pieces(path), True))
