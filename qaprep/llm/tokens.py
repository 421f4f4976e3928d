"""Token ids of whole texts with a ``tokenizers`` file, word by word.

The vocabularies here split a text at white space before any merge, so the ids of a text are those of its
words in a row. A task keeps the ids of the words it has met and asks the library for new words only; a
text whose words can't be told apart safely, or that holds the string of a special token (which the library
turns into that token), goes to the library whole. The ids are the library's in either case.
"""

from __future__ import annotations

import json
import os
import re
from collections import defaultdict
from functools import cached_property
from itertools import chain, count, islice

import numpy as np

# Fixed value: how byte-level vocabularies split a text ahead of the merges.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_characters() -> dict[str, int]:
    """How byte-level files write bytes: those that print stand for themselves, the others for the
    characters from 256 on, in their order."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in prints)}


def _content(path: str) -> dict:
    with open(path, encoding="utf-8") as source:
        return json.load(source)


def _merged(model: dict) -> list[str]:
    return ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]


def rank_file(content: dict) -> dict[bytes, int] | None:
    """The tokens of a byte-level file as bytes with their ids, if every merge makes a token of a higher id
    than the merge before; else None."""
    model, splitter = content["model"], content.get("pre_tokenizer") or {}
    if content.get("normalizer") or splitter.get("type") != "ByteLevel" or not splitter.get("use_regex", True) or splitter.get("add_prefix_space"):
        return None
    byte_of, merged = _byte_characters(), _merged(model)
    ids = [model["vocab"][m] for m in merged]
    if any(a >= b for a, b in zip(ids, ids[1:], strict=False)) or not all(c in model["vocab"] for c in byte_of):
        return None
    return {bytes(byte_of[c] for c in token): model["vocab"][token] for token in [*byte_of, *merged]}


#: The character that ends a word in ``suffix_file``; plain words do not hold it.
WORD_END = "\x01"


def suffix_file(content: dict) -> dict[bytes, int] | None:
    """The tokens of a lower-casing file whose words end in a suffix, as bytes with their ids. The last byte and the
    suffix are one symbol from the start, as their ids are below those of all merges; None if they
    are not, or if the file does anything else. Tokens that hold the byte of ``WORD_END`` itself are left out."""
    model, steps = content["model"], (content.get("pre_tokenizer") or {}).get("pretokenizers") or []
    kinds = [s["type"] for s in (content.get("normalizer") or {}).get("normalizers") or []]
    suffix, byte_of, merged = model.get("end_of_word_suffix"), _byte_characters(), _merged(model)
    if kinds != ["NFC", "Replace", "Lowercase"] or [s["type"] for s in steps] != ["Split", "ByteLevel"] or not suffix or steps[1].get("use_regex") or steps[1].get("add_prefix_space"):
        return None
    if steps[0].get("behavior") != "Removed" or not steps[0].get("invert") or steps[0]["pattern"].get("Regex") != _SUFFIX_PATTERN:
        return None
    single = [*byte_of, *(c + suffix for c in byte_of)]
    ids = [model["vocab"][m] for m in merged]
    if any(a >= b for a, b in zip(ids, ids[1:], strict=False)) or any(model["vocab"].get(c, ids[0]) >= ids[0] for c in single):
        return None
    end, vocab, ranks = WORD_END.encode(), model["vocab"], {}
    tokens, gap = [*single, *merged], "\u0400"  # all tokens are put into bytes at once
    bodies = gap.join([t.removesuffix(suffix) for t in tokens]).translate(str.maketrans({c: chr(b) for c, b in byte_of.items()}))
    for token, body in zip(tokens, bodies.split(gap), strict=True):
        if WORD_END not in body:
            ranks[body.encode("latin-1") + end * token.endswith(suffix)] = vocab[token]
    ranks[end] = len(vocab) + 1  # never left alone
    return ranks


#: Characters that no normal form changes, whose classes are the same in every Unicode version and whose
#: lower case does not depend on their neighbours; and how the file's pattern cuts words of them.
_PLAIN = re.compile("[\n -~\u00a1-\u012f\u0131-\u017f]*")
_LETTERS, _NUMBERS = "a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u017f", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
_SUFFIX_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"  # fixed value, of the file read here
_PLAIN_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^ {_LETTERS}{_NUMBERS}]+")
_ENDED = f"\\g<0>{WORD_END}"


class WordEncoder:
    """Ids of texts as little-endian bytes of ``dtype``.

    ``spaced``: a word's ids include the one blank ahead of it (byte-level vocabularies); words are then
    cut at single blanks only. Otherwise white space is dropped by the vocabulary and any blank or line end cuts.
    ``most``: words kept; beyond it a byte-level vocabulary keeps those of the batch at hand, the other starts afresh. A byte-level file whose merges are in the order
    of their ids is a rank file, too: the faster library for those gives the same ids and needs no table. The slower
    one is loaded when a text or word first needs it."""

    def __init__(self, path: str, spaced: bool, most: int = 300_000):
        content = _content(path)
        self.path = path
        self.special = [t["content"] for t in content.get("added_tokens") or []]
        size = len(content["model"]["vocab"]) + len(set(self.special).difference(content["model"]["vocab"]))
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.spaced, self.most = spaced, most
        self.known: dict[str, bytes | None] = {}
        self._clear()
        ranks = rank_file(content) if spaced else None
        self.ranked = None
        if ranks is not None:
            import tiktoken

            self.ranked = tiktoken.Encoding("ranked", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})
        suffixed = None if spaced else suffix_file(content)
        self.pieces = None
        if suffixed is not None:
            import tiktoken

            self.pieces = tiktoken.Encoding("pieces", pat_str=f"[^ {WORD_END}]+{WORD_END}| ", mergeable_ranks=suffixed, special_tokens={})
            self.blank = suffixed[b" "]

    @cached_property
    def tokenizer(self):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, dtype=self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _plain_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """By the library of rank files, many words in one text: a blank behind each, whose id no word has."""
        text = _PLAIN_PIECES.sub(_ENDED, " ".join(words).lower())
        ids = np.asarray(self.pieces.encode_ordinary(text + " "), dtype=self.dtype)
        blank = ids == self.blank
        return ids[~blank], np.diff(np.r_[-1, np.flatnonzero(blank)]) - 1

    def _library_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        encoding = self.tokenizer.encode([" " + w for w in words] if self.spaced else words, is_pretokenized=True, add_special_tokens=False)
        cuts = np.searchsorted(np.asarray(encoding.word_ids, dtype=np.int64), np.arange(len(words) + 1))
        return np.asarray(encoding.ids, dtype=self.dtype), np.diff(cuts)

    def _learned(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words (none empty) in a row, and how many each word has."""
        flat, sizes = [np.zeros(0, self.dtype)], [np.zeros(0, np.int64)]
        for at in range(0, len(words), 4096):
            some = words[at : at + 4096]
            if self.pieces is not None and _PLAIN.fullmatch("".join(some)):
                ids, n = self._plain_words(some)
            else:
                plain = np.array([self.pieces is not None and _PLAIN.fullmatch(w) is not None for w in some])
                n, own = np.zeros(len(some), np.int64), {}
                for kind, read, step in ((True, self._plain_words, 4096), (False, self._library_words, 512)):
                    chosen = [w for w, p in zip(some, plain.tolist(), strict=True) if p == kind]
                    read_of = [read(chosen[i : i + step]) for i in range(0, len(chosen), step)]
                    if read_of:
                        own[kind], n[plain == kind] = (np.concatenate(x) for x in zip(*read_of, strict=True))
                which = np.repeat(plain, n)
                ids = np.zeros(len(which), self.dtype)
                for kind, values in own.items():
                    ids[which == kind] = values
            flat.append(ids)
            sizes.append(n)
        return np.concatenate(flat), np.concatenate(sizes)

    def _clear(self) -> None:
        self.number: defaultdict[str, int] = defaultdict(count(1).__next__, {"": 0})  # a new word takes the next number
        self.ids, self.starts, self.filled = np.zeros(1 << 16, self.dtype), np.zeros(1 << 14, dtype=np.int64), 0

    def _by_number(self, parts: list[list[str]]) -> list[bytes]:
        """The ids of texts, each a list of words: words are numbered in one pass, ids gathered by number."""
        if len(self.number) > self.most:
            self._clear()
        have, words = len(self.number), np.array([len(p) for p in parts], dtype=np.int64)
        numbers = np.fromiter(map(self.number.__getitem__, chain.from_iterable(parts)), dtype=np.int64, count=int(words.sum()))
        new = list(islice(self.number, have, None))
        if new:
            flat, sizes = self._learned(new)
            while self.filled + len(flat) > len(self.ids):
                self.ids = np.r_[self.ids, np.zeros_like(self.ids)]
            while have + len(new) + 1 > len(self.starts):
                self.starts = np.r_[self.starts, np.zeros_like(self.starts)]
            self.ids[self.filled : self.filled + len(flat)] = flat
            self.starts[have + 1 : have + 1 + len(new)] = self.filled + np.cumsum(sizes)
            self.filled += len(flat)
        first = self.starts[numbers]
        sizes = self.starts[numbers + 1] - first
        ends = np.cumsum(sizes)
        raw = self.ids[np.repeat(first - (ends - sizes), sizes) + np.arange(int(sizes.sum()))].tobytes()
        cuts = (np.r_[0, ends][np.r_[0, np.cumsum(words)]] * self.dtype.itemsize).tolist()
        return [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _learn(self, words: list[str]) -> None:
        for at in range(0, len(words), 512):
            some = words[at : at + 512]
            ids, sizes = self._library_words(some)
            raw, cuts = ids.tobytes(), (np.r_[0, np.cumsum(sizes)] * self.dtype.itemsize).tolist()
            self.known.update(zip(some, (raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        special = [i for i, t in enumerate(texts) if any(s in t for s in self.special)]
        if special:
            out = self._ordinary(["" if any(s in t for s in self.special) else t for t in texts])
            for i, ids in zip(special, self.whole([texts[i] for i in special]), strict=True):
                out[i] = ids
            return out
        return self._ordinary(texts)

    def _ordinary(self, texts: list[str]) -> list[bytes]:
        if self.ranked is not None:
            return [np.asarray(self.ranked.encode_ordinary(t), dtype=self.dtype).tobytes() for t in texts]
        if not self.spaced:
            if self.pieces is not None:
                texts = [t.lower() if _PLAIN.fullmatch(t) else t for t in texts]
            return self._by_number([t.replace("\n", " ").split(" ") for t in texts])
        parts = [t.split(" ") for t in texts]
        wanted: set[str] = set()
        for p in parts:
            wanted.update(p[1:])
        if len(self.known) > self.most:  # those of this batch stay
            self.known = {w: self.known[w] for w in wanted.intersection(self.known)}
        new = wanted.difference(self.known)
        # a word with white space at an edge belongs to a longer run of it
        odd = [w for w in new if not w or w[0].isspace() or w[-1].isspace()]
        self.known.update(dict.fromkeys(odd))
        self._learn(list(new.difference(odd)))
        out: list[bytes | None] = []
        firsts = self.whole([p[0] for p in parts])
        for part, first in zip(parts, firsts, strict=True):
            ids = [self.known[w] for w in part[1:]]
            out.append(None if None in ids or (part[0] and part[0][-1].isspace()) else first + b"".join(ids))
        left = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(left, self.whole([texts[i] for i in left]), strict=True):
            out[i] = ids
        return out
