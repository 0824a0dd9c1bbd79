"""Token ids of whole texts with a public tokenizer, word by word with a cache."""
from __future__ import annotations

import functools
import itertools
import os
import re

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

END_ID = 1
#: Words, and units of words, kept in the cache of one Python worker; beyond it the cache starts anew.
CACHE_WORDS = 300_000
#: UTF-8 of the letters from U+00C0 to U+017F, but for the dotted I, whose lower case is two characters.
_LATIN = rb"\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|\xc4[\x80-\xaf\xb1-\xbf]|\xc5[\x80-\xbf]"
#: What the tokenizer's own splitting takes as one unit, in words of visible ASCII and these letters.
_UNIT = re.compile(rb"'(?:s|t|re|ve|m|ll|d)|(?:[a-z]|" + _LATIN + rb")+|[0-9]|[!-/:-@\[-`{-~]+")
_LATIN_WORD = re.compile(rb"(?:[!-~]|" + _LATIN + rb")+").fullmatch
#: The byte-level alphabet: bytes that are no visible Latin-1 character stand as characters from U+0100 on, in order.
_ALPHABET = {b: 256 + n for n, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255))}
#: A special token of the vocabulary; texts never match it, as it is only looked for between units.
_BETWEEN = "<|endoftext|>"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@functools.lru_cache(maxsize=1)
def encoder(path: str) -> "WordEncoder":
    """One encoder a Python worker, so that its cache serves task after task."""
    return WordEncoder(path)


class _Numbered(dict):
    """Numbers keys as they are first met, and notes the new ones."""

    def __init__(self) -> None:
        self.new: list[bytes] = []

    def __missing__(self, key: bytes) -> int:
        self[key] = n = len(self)
        self.new.append(key)
        return n


class _Lists:
    """Arrays of ids, by number, end to end."""

    def __init__(self) -> None:
        self.start, self.length, self.flat, self.n, self.used = np.zeros(1024, np.int64), np.zeros(1024, np.int32), np.zeros(4096, np.uint16), 0, 0

    @staticmethod
    def _room(a: np.ndarray, n: int) -> np.ndarray:
        return a if n <= len(a) else np.concatenate([a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)])

    def extend(self, lengths: np.ndarray, flat: np.ndarray) -> None:
        n, used = self.n + len(lengths), self.used + len(flat)
        self.start, self.length, self.flat = self._room(self.start, n), self._room(self.length, n), self._room(self.flat, used)
        self.length[self.n:n] = lengths
        self.start[self.n:n] = self.used + np.cumsum(lengths) - lengths
        self.flat[self.used:used] = flat
        self.n, self.used = n, used

    def gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lengths, and the lists end to end, of the given numbers."""
        n = self.length[at]
        ends = np.cumsum(n, dtype=np.int64)
        return n, self.flat[np.repeat(self.start[at] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)]


class WordEncoder:
    """Ids of texts. The tokenizer drops white space and never joins across it, so the ids of a text are
    those of its words in order, and a distinct word is encoded once. Words of Latin letters and ASCII split
    further into the tokenizer's units (letters, single digits, signs), which repeat more often than words."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids are kept in 16 bits")
        self.between = self.tokenizer.token_to_id(_BETWEEN)
        self.plain = Tokenizer.from_file(path)
        self.plain.encode_special_tokens = True
        self._clear()

    def _clear(self) -> None:
        self.words, self.word_ids = _Numbered(), _Lists()
        self.units, self.unit_ids = _Numbered(), _Lists()

    def _encode(self, units: list[bytes]) -> None:
        """Appends the ids of units. A unit of Latin letters, a digit or signs is one word of the model as
        it stands; other words go through the whole tokenizer, many as one text, a special token between them."""
        tokenize = self.plain.model.tokenize
        for i in range(0, len(units), 1000):
            some = units[i:i + 1000]
            ids = [[t.id for t in tokenize(u.decode("latin-1").translate(_ALPHABET))] if _LATIN_WORD(u) else None for u in some]
            rest = [j for j, x in enumerate(ids) if x is None]
            if rest:
                texts = [some[j].decode() for j in rest]
                if any("<|" in t for t in texts):
                    found = [e.ids for e in self.plain.encode_batch(texts, add_special_tokens=False)]
                else:
                    flat = np.array(self.tokenizer.encode(_BETWEEN.join([*texts, ""]), add_special_tokens=False).ids)
                    found = [x[:-1].tolist() for x in np.split(flat, np.flatnonzero(flat == self.between) + 1)[:-1]]
                for j, x in zip(rest, found, strict=True):
                    ids[j] = x
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            self.unit_ids.extend(lengths, np.fromiter(itertools.chain.from_iterable(ids), np.uint16, int(lengths.sum())))

    def _learn(self) -> None:
        """Encodes the words that numbering met for the first time."""
        new, self.words.new = self.words.new, []
        if not new:
            return
        split = [_UNIT.findall(w if w.isascii() else w.decode().lower().encode()) if _LATIN_WORD(w) else (w,) for w in new]
        at = np.fromiter(map(self.units.__getitem__, itertools.chain.from_iterable(split)), np.int64)
        units, self.units.new = self.units.new, []
        self._encode(units)
        lengths, flat = self.unit_ids.gather(at)
        counts = np.fromiter(map(len, split), np.int64, len(split))
        ends = np.cumsum(np.concatenate([[0], lengths]), dtype=np.int64)[np.concatenate([[0], np.cumsum(counts)])]
        self.word_ids.extend(np.diff(ends), flat)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts (UTF-8) end to end, each with END_ID at its end; and where each begins, with the end of all."""
        if max(len(self.words), len(self.units)) > CACHE_WORDS:
            self._clear()
        number, parts, counts = self.words.__getitem__, [], []
        for t in texts:
            words = t.lower().split()  # of ASCII letters; the tokenizer lowers all
            counts.append(len(words))
            parts.append(np.fromiter(map(number, words), np.int64, len(words)))
        self._learn()
        n, flat = self.word_ids.gather(np.concatenate(parts) if parts else np.zeros(0, np.int64))
        bounds = np.cumsum(np.concatenate([[0], n]), dtype=np.int64)[np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]).astype(np.int64)]
        ids = np.insert(flat, bounds[1:], END_ID)
        return ids, bounds + np.arange(len(bounds))
