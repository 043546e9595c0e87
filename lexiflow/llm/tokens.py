"""Whole-text encoding with a public tokenizer file, through a bounded memo.

A text is cut at points where the tokenizer's own splitting rule always cuts
(before a lone space for the byte-level files; at ASCII white space for the
word files, which drop it), so the ids of a text are the ids of its chunks in
order. Chunks repeat, so each distinct one is encoded once per worker."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable

import numpy as np

# White space as the byte-level splitting rule sees it (fixed values).
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
WHITE_CHARS = frozenset(re.findall(f"[{WHITE}]", "".join(map(chr, range(0x3001)))))
CHUNK = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")

#: Distinct chunks a worker keeps before it falls back to those of its last batch.
MEMO_ENTRIES = {"byte": 300_000, "word": 600_000}


def byte_chunks(text: str) -> list[str]:
    """Pieces that a byte-level tokenizer encodes independently of each other."""
    return CHUNK.findall(text)


def word_chunks(text: str) -> list[bytes]:
    """Pieces between ASCII white space, for tokenizers that drop white space."""
    return text.encode().split()


#: A word between white space that the word files encode to a single id of its own.
MARK = "\x02"
#: A space and a line feed as the byte-level files spell them.
PART_START = ("\u0120", "\u010a")


class TextEncoder:
    """Encodes whole texts to little-endian uint32 id bytes.

    ``kind`` is ``byte`` or ``word``, see the two chunk functions. A text that
    holds one of the file's special strings goes to the tokenizer whole."""

    def __init__(self, path: str, kind: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.firsts = {s[:1] for s in self.special}
        self.memo: dict = {}
        self.most = MEMO_ENTRIES[kind]
        self.encode_plain = self._words if kind == "word" else self._bytes
        mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids if kind == "word" else []
        self.mark = mark[0] if len(mark) == 1 else None
        # by id: opens a part of a text (byte files), closes a word (word files)
        vocab = self.tokenizer.get_vocab()
        self.opens, self.closes = (np.zeros(1 + max(vocab.values(), default=0), dtype=bool) for _ in range(2))
        close = getattr(self.tokenizer.model, "end_of_word_suffix", None) if kind == "word" else None
        for token, i in vocab.items():
            self.opens[i] = token[:1] in PART_START
            self.closes[i] = bool(close) and token.endswith(close)

    def _one(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _many(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, encoded in lines of many words. A word of letters is cut off
        after its closing id: each word has at least one, so as many as words means one
        each. All others have marks between them."""
        out: dict[bytes, bytes] = {}

        def encoded(some, between):
            groups = [some[at:at + 500] for at in range(0, len(some), 500)]
            lines = [between.join([w.decode() for w in g]) for g in groups]
            for g, e in zip(groups, self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)):
                yield g, np.array(e.ids, dtype="<u4")

        for g, ids in encoded([w for w in words if w.isalpha()] if self.closes.any() else [], " "):
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) == len(g) and ends[-1] == len(ids):
                raw, at = ids.tobytes(), [0, *(ends * 4).tolist()]
                out.update(zip(g, [raw[i:j] for i, j in zip(at, at[1:])]))
        for g, ids in encoded([w for w in words if w not in out and MARK.encode() not in w] if self.mark is not None else [], f" {MARK} "):
            at = np.flatnonzero(ids == self.mark)
            if len(at) == len(g) - 1:
                raw, ends = ids.tobytes(), (at * 4).tolist()
                out.update(zip(g, [raw[i:j] for i, j in zip([0, *[x + 4 for x in ends]], [*ends, len(raw)])]))
        return [out[w] if w in out else self._one(w.decode()) for w in words]

    def _words(self, texts: list[str]) -> list[bytes]:
        cut = [word_chunks(t) for t in texts]
        seen: set[bytes] = set()
        for c in cut:
            seen.update(c)
        memo = self.memo
        fresh = list(seen.difference(memo))
        memo.update(zip(fresh, self._many(fresh)))
        out = [b"".join(map(memo.__getitem__, c)) for c in cut]
        if len(memo) > self.most:
            self.memo = {c: memo[c] for c in seen}
        return out

    def _parts(self, parts: list[str]) -> dict[str, bytes | None]:
        """Ids of parts of texts between single spaces. Line feeds are marked by a
        space before them, so a part is one of: text that followed a space, or a line
        feed and the text after it. One that is empty or borders on other white space
        has no ids of its own: None. All others are encoded together: their bytes hold
        a space or a line feed only in front, so an id that starts with one opens a part."""
        white, out = WHITE_CHARS, dict.fromkeys(parts)
        words = [p for p in parts if p and p[0] not in white and p[-1] not in white]
        after = [p for p in parts if len(p) > 1 and p[0] == "\n" and p[1] not in white and p[-1] not in white]
        for some, space in ((words, " "), (after, "")):
            groups = [some[at:at + 500] for at in range(0, len(some), 500)]
            lines = [space + space.join(g) for g in groups]
            for g, e in zip(groups, self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)):
                ids = np.array(e.ids, dtype="<u4")
                at = np.flatnonzero(self.opens[ids])
                if len(at) == len(g) and at[0] == 0:
                    raw, ends = ids.tobytes(), [*(at * 4).tolist(), 4 * len(ids)]
                    out.update(zip(g, [raw[i:j] for i, j in zip(ends, ends[1:])]))
                else:
                    out.update((p, self._one(space + p)) for p in g)
        return out

    def _bytes(self, texts: list[str]) -> list[bytes]:
        cut = [t.replace("\n", " \n").split(" ") for t in texts]
        # the head has no space before it, but the same rule for its end
        heads = [c.pop(0) for c in cut]
        seen: set[str] = set()
        for c in cut:
            seen.update(c)
        memo, out = self.memo, []
        memo.update(self._parts(list(seen.difference(memo))))
        for t, head, parts in zip(texts, heads, cut):
            try:
                out.append(b"".join([self._one(head) if not (head and (head[0] in WHITE_CHARS or head[-1] in WHITE_CHARS)) else None, *map(memo.__getitem__, parts)]))
            except TypeError:  # white space in a row
                out.append(b"".join(map(self._one, byte_chunks(t))))
        if len(memo) > self.most:
            self.memo = {p: memo[p] for p in seen}
        return out

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        texts = list(texts)
        # a first character is looked for much faster than a string
        whole = [i for i, t in enumerate(texts) if any(c in t for c in self.firsts) and any(s in t for s in self.special)]
        if not whole:
            return self.encode_plain(texts)
        out = self.encode_plain(["" if i in set(whole) else t for i, t in enumerate(texts)])
        for i in whole:
            out[i] = self._one(texts[i])
        return out


_ENCODERS: dict[tuple[str, str], TextEncoder] = {}


def encoder(path: str, kind: str) -> TextEncoder:
    """One encoder per worker process and file, so the memo outlives a task."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if (path, kind) not in _ENCODERS:
        _ENCODERS[path, kind] = TextEncoder(path, kind)
    return _ENCODERS[path, kind]
