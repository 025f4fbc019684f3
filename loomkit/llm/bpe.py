"""Fast token ids of many texts with a ``tokenizers`` byte-level BPE file.

A text without a space before another white-space character falls apart at its
spaces: the pre-tokenizer starts a new word there, so each stretch encodes to
the same ids alone as within the text.  Every distinct stretch is encoded once
and remembered, in two generations of bounded bytes (a stretch longer than
``LONGEST`` is not remembered).  Other texts fall apart only at single spaces
between two other characters, and are encoded a few of these pieces at a time.
New stretches are encoded as texts of ``CALL`` bytes or little more, whose ids are dealt out by
the number of bytes each stands for; no call sees more, unless one stretch alone is longer.

With the usual byte-level split, a word ends where letters are followed by what is none: a new stretch that
begins with Latin letters falls apart once more behind them.  Both parts are remembered, too, and the letters,
one word, need the file's merges only.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MEMORY = 96 << 20  # bytes remembered per generation and worker, overhead included
OVERHEAD = 200  # bytes that a remembered stretch costs beside its text and ids
LONGEST = 4096
CALL = 128 << 10  # bytes of text given to the tokenizer at once: its own result is some 30 times as large
_ODD = re.compile(r" (?:\s|\Z)")
_SINGLE = re.compile(r"(?<=\S) (?=\S)")
# Latin letters, then nothing or what begins with an ASCII character that is none
_LETTERS = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([\x00-\x40\x5B-\x60\x7B-\x7F].*)?", re.DOTALL)


def _usual_split(file: dict) -> bool:
    """Whether words are split as by byte-level BPE's own pattern, of the text as it is, and no added token begins with a letter or space."""
    split = file.get("pre_tokenizer") or {}
    starts = [t["content"][:1] for t in file.get("added_tokens") or []]
    return (file.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True) is True
            and not split.get("add_prefix_space", True) and all(c.isascii() and not c.isalpha() and not c.isspace() for c in starts))


def _letters_of_bytes() -> dict[int, str]:
    """Byte-level BPE's character for each byte: itself if it can be seen in Latin-1, else one from 256 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in seen]
    return {**{b: chr(b) for b in seen}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


_AS_LETTERS = _letters_of_bytes()


def _runs(sizes: list[int], limit: int):
    """Consecutive index ranges that reach ``limit`` at their last member (one member at least)."""
    lo, total = 0, 0
    for i, n in enumerate(sizes):
        total += n
        if total >= limit:
            yield lo, i + 1
            lo, total = i + 1, 0
    if lo < len(sizes):
        yield lo, len(sizes)


class Encoder:
    """Texts to ids; what it remembers are little-endian 32-bit words."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        vocab = self.tok.get_vocab()  # byte-level: a character stands for a byte
        self.bytes_of_id = np.zeros(max(vocab.values()) + 1, np.int64)
        for piece, i in vocab.items():
            self.bytes_of_id[i] = len(piece)
        self.model = self.tok.model if _usual_split(json.loads(self.tok.to_str())) else None
        self.new: dict[str, bytes] = {}  # stretches without their space; what follows letters has one before it
        self.old: dict[str, bytes] = {}
        self.held = 0

    def _keep(self, words: list[str], ids: list[bytes]) -> None:
        """Remember stretches; a generation goes over its bound by one block's at most."""
        if self.held > MEMORY:
            self.old, self.new, self.held = self.new, {}, 0
        if max(map(len, words), default=0) > LONGEST:
            short = [(w, x) for w, x in zip(words, ids, strict=True) if len(w) <= LONGEST]
            words, ids = [w for w, _ in short], [x for _, x in short]
        self.new.update(zip(words, ids, strict=True))
        self.held += sum(map(len, words)) + sum(map(len, ids)) + OVERHEAD * len(words)

    def _joined(self, words: list[str], before: str, skip: int = 0) -> list[bytes]:
        """Ids of each word behind ``before``, without the first ``skip``."""
        coded: list[bytes] = []
        for lo, hi in _runs([len(before) + len(w) for w in words], CALL):
            part = words[lo:hi]
            ids = np.array(self.tok.encode_batch_fast([before + before.join(part)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.cumsum(self.bytes_of_id[ids])
            words_end = np.cumsum(np.array(pc.binary_length(pa.array(part, pa.string())), np.int64) + len(before))
            cut = np.searchsorted(ends, words_end) + 1
            if cut[-1] != len(ids) or (ends[cut - 1] != words_end).any():
                raise ValueError("ids don't end where the stretches do: not a byte-level file")
            raw, cut = ids.tobytes(), cut.tolist()
            coded += [raw[4 * (i + skip):4 * j] for i, j in zip([0, *cut], cut, strict=False)]
        return coded

    def _merged(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters alone, each with a space before it."""
        space, tokenize = _AS_LETTERS[0x20], self.model.tokenize
        ids: list[int] = []
        cut = [0]
        for w in words:
            ids += [t.id for t in tokenize(space + (w if w.isascii() else w.encode().decode("latin-1").translate(_AS_LETTERS)))]
            cut.append(4 * len(ids))
        raw = np.array(ids, "<u4").tobytes()
        return list(map(raw.__getitem__, map(slice, cut, cut[1:])))

    def _behind_letter(self, rests: list[str]) -> list[bytes]:
        """Ids of what follows letters (given with a space before it)."""
        return self._joined([x[1:] for x in rests], " a", len(self.tok.encode(" a", add_special_tokens=False).ids))

    def _recall(self, keys: list[str], code) -> list[bytes]:
        """Ids of distinct ``keys``; ``code`` gives those that neither generation holds, the new one then holds all."""
        found = list(map(self.new.get, keys))
        lack = [i for i, x in enumerate(found) if x is None]
        if lack:
            older = [self.old.get(keys[i]) for i in lack]
            coded = iter(code([keys[i] for i, x in zip(lack, older, strict=True) if x is None]))
            for i, x in zip(lack, older, strict=True):
                found[i] = next(coded) if x is None else x
            self._keep([keys[i] for i in lack], [found[i] for i in lack])
        return found

    def _stretches(self, words: list[str]) -> list[bytes]:
        """Ids of distinct stretches that are not remembered."""
        if self.model is None:
            return self._joined(words, " ")
        parts = [m.groups() if (m := _LETTERS.fullmatch(w)) else (None, w) for w in words]
        alone = [h for h, r in parts if r is None]
        head = dict(zip(alone, self._merged(alone), strict=True))
        heads = list({h: 0 for h, r in parts if r is not None and h is not None and h not in head})
        head.update(zip(heads, self._recall(heads, self._merged), strict=True))
        rests = list({" " + r: 0 for h, r in parts if r is not None and h is not None})
        rest = dict(zip(rests, self._recall(rests, self._behind_letter), strict=True))
        others = iter(self._joined([r for h, r in parts if h is None], " "))
        return [next(others) if h is None else head[h] if r is None else head[h] + rest[" " + r] for h, r in parts]

    def _whole(self, text: str) -> bytes:
        """Ids of a text with odd white space, in pieces cut at single spaces."""
        cuts = [0]
        for m in _SINGLE.finditer(text):
            if m.start() - cuts[-1] >= CALL:
                cuts.append(m.start())
        pieces = [text[i:j] for i, j in zip(cuts, [*cuts[1:], len(text)], strict=True)]
        return b"".join(np.array(self.tok.encode_batch_fast([x], add_special_tokens=False)[0].ids, "<u4").tobytes() for x in pieces)

    def encode(self, text: str) -> np.ndarray:
        ids, _ = self.encode_many(pa.array([text], pa.string()))
        return ids

    def encode_many(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, number of ids of each); ``end_id`` follows each text if given."""
        strings = texts.to_pylist()
        n = len(strings)
        odd = [i for i, t in enumerate(strings) if _ODD.search(t)]
        plain = texts
        if odd:
            mask = np.zeros(n, bool)
            mask[odd] = True
            plain = pc.if_else(pa.array(mask), "", texts)
        parts = pc.split_pattern(plain, " ")
        count = np.diff(np.array(parts.offsets))  # stretches of each text; the first has no space before it
        words = parts.flatten()
        head = np.zeros(len(words), bool)
        head[np.cumsum(count) - count] = True
        coded = words.dictionary_encode()
        known = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = self._recall(known, self._stretches)
        special = words.filter(pa.array(head)).to_pylist()
        first_ids: list[bytes] = []
        for lo, hi in _runs([len(w) for w in special], CALL):
            first_ids += [np.array(e.ids, "<u4").tobytes() for e in self.tok.encode_batch_fast(special[lo:hi], add_special_tokens=False)]
        for i in odd:
            first_ids[i] = self._whole(strings[i])
        found += first_ids
        tail = [] if end_id is None else [np.array([end_id], "<u4").tobytes()]
        found += tail
        at = np.array(coded.indices).astype(np.int64)
        at[head] = len(known) + np.arange(n)
        if tail:
            at = np.insert(at, np.cumsum(count), len(found) - 1)
            count = count + 1
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        first = np.cumsum(size) - size
        pool = np.frombuffer(b"".join(found), "<u4")
        each = size[at]
        ends = np.cumsum(each)
        ids = pool[np.arange(ends[-1] if len(ends) else 0) + np.repeat(first[at] - (ends - each), each)]
        upto = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(count)])]
        return ids, np.diff(upto)


_KNOWN: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    if path not in _KNOWN:
        _KNOWN[path] = Encoder(path)
    return _KNOWN[path]
