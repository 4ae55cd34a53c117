"""Token ids of whole texts from a tokenizers file, with each distinct chunk of a worker's texts encoded once.

A text is cut where the tokenizer's own pre-tokenizer must cut it too, so the ids of the chunks, put one after
the other, are the ids of the text; `tests/llm` compares them with the whole encoding. Texts of ASCII and Latin letters
are cut together, as bytes in numpy, and each chunk that they share is looked up once; others are cut by a regular
expression. Ids are held as bytes, little-endian unsigned 32-bit, which is also what checksums are taken of.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

MOST_BYTES = 112 << 20  # of chunks that a worker remembers, about; beyond, it forgets and encodes anew
LONG_CHUNK = 256  # characters; longer ones aren't remembered
LINES = 256  # chunks that the tokenizer gets as one text
ENTRY = 200  # bytes that a chunk takes besides its characters and ids: two objects and their place in the dictionary
BLANK = "\t-\r \x85\xa0  -     　"
LETTER = "A-Za-zÀ-ÖØ-öø-įı-ɏ"  # without the one whose lower case has a mark of its own
# Places where any of the pre-tokenizers cuts, whatever comes before and after: behind a run of Latin letters
# that an ASCII character follows, and behind a run of ASCII signs and digits without an apostrophe that an
# ASCII letter, white space or the end follows. All else stays with its neighbours up to the next white space.
_WORD = rf"[{LETTER}]++(?![^\x00-\x7f])"
_SIGNS = r"[!-&(-@\[-`{-~]++(?=[A-Za-z\t-\r ]|\Z)"
#: For pre-tokenizers that drop white space.
WORDS = re.compile(rf"{_WORD}|{_SIGNS}|[^\t-\r ]+")
#: For byte-level ones: one space belongs to what follows it, other white space stands alone.
SPACED = re.compile(rf" ?{_WORD}| ?{_SIGNS}| ?[^{BLANK}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+")
#: Kinds of bytes: letters (with all bytes of LETTER's), white space, signs and digits, the apostrophe; 0 for all others.
_KIND = np.zeros(256, np.uint8)
_KIND[0x21:0x7F] = 3
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0xC0), *range(0xC3, 0xCA)]] = 1
_KIND[[0x20, *range(0x09, 0x0E)]] = 2
_KIND[0x27] = 4
CHUNKS = {"word_bpe_49k.json": WORDS, "byte_bpe_50k.json": SPACED}


class Known(dict):
    """The ids of chunks; those that it is asked for and doesn't have are noted, and have no ids yet."""

    def __init__(self):
        self.missing: list[str] = []

    def __missing__(self, chunk: str) -> bytes:
        self.missing.append(chunk)
        return b""


def _odd_rows(data: np.ndarray, kind: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows with a character other than white space, printable ASCII and LETTER."""
    lead = np.flatnonzero(data >= 0xC3)
    first, second = data[lead], data[np.minimum(lead + 1, len(data) - 1)]
    no_letter = (first == 0xC3) & ((second == 0x97) | (second == 0xB7)) | (first == 0xC4) & (second == 0xB0) | (first == 0xC9) & (second >= 0x90)
    odd = np.concatenate([np.flatnonzero(kind == 0), lead[no_letter]])
    return np.unique(np.searchsorted(at, odd, "right") - 1)


def _cuts(data: np.ndarray, kind: np.ndarray, at: np.ndarray, spaced: bool) -> np.ndarray:
    """Where chunks begin: at rows, between letters and signs, and around white space, as WORDS or SPACED have it.

    Nothing is cut beside an apostrophe, as a contraction may stand there. Without `spaced`, white space is a chunk.
    """
    letter, blank, sign = kind == 1, kind == 2, kind == 3
    cut = np.zeros(len(data) + 1, bool)
    inner = cut[1:-1]
    inner |= letter[:-1] & sign[1:] | sign[:-1] & letter[1:]
    inner |= blank[1:] & ~blank[:-1]
    after = blank[:-1] & ~blank[1:]  # a place behind white space
    inner |= after & (data[:-1] != 0x20) if spaced else after
    if spaced:  # of white space that something follows in its row, the last character stands by itself or with that
        ends = np.flatnonzero(after)
        first = np.zeros(len(data) + 1, bool)
        first[at] = True
        cut[ends[~first[ends + 1]]] = True
    cut[at] = True
    return np.flatnonzero(cut[:-1])


class Encoder:
    """Encode texts with one of the public tokenizer files, without adding special tokens.

    With `marks`, the strings of special tokens that stand in a text become their ids, as the library does by itself;
    without, they are ordinary text. A text with such a string is encoded as a whole.
    """

    def __init__(self, name: str, marks: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.pattern = CHUNKS[name]
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.marks = added if marks else []
        self.tokenizer.encode_special_tokens = not marks
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.widths = np.zeros(max(vocab.values()) + 1, np.int64)  # bytes of each token: one for each of its characters
        for token, k in vocab.items():
            self.widths[k] = len(token.removesuffix("</w>"))
        self.forget()

    def forget(self) -> None:
        self.known = Known()
        self.size = 0

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text; a null counts as empty and has none."""
        if whole := [k for k, t in enumerate(texts) if t and any(m in t for m in self.marks)]:
            out = dict.fromkeys(whole)
            for k in whole:
                out[k] = np.array(self.tokenizer.encode(texts[k], add_special_tokens=False).ids, "<u4").tobytes()
            rest = iter(self._encode([t for k, t in enumerate(texts) if k not in out]))
            return [out[k] if k in out else next(rest) for k in range(len(texts))]
        return self._encode(texts)

    def _encode(self, texts: list[str | None]) -> list[bytes]:
        column = pa.array([t or "" for t in texts], pa.large_string())
        _, places, content = column.buffers()
        at = np.frombuffer(places, np.int64, len(texts) + 1)
        data = np.frombuffer(content, np.uint8, at[-1]) if at[-1] else np.zeros(0, np.uint8)
        kind = _KIND[data]
        odd = _odd_rows(data, kind, at)
        if not len(odd):
            return self._together(data, _cuts(data, kind, at, self.pattern is SPACED), at)
        late = set(odd.tolist())
        rest = iter(self._encode([t for k, t in enumerate(texts) if k not in late]) if len(late) < len(texts) else [])
        found = dict(zip(odd.tolist(), self._apart([texts[k] for k in odd]), strict=True))
        return [found[k] if k in late else next(rest) for k in range(len(texts))]

    def _together(self, data: np.ndarray, start: np.ndarray, at: np.ndarray) -> list[bytes]:
        """The ids of texts without odd bytes: `data` from `at` on, with chunks from `start` on."""
        if not len(data):
            return [b""] * (len(at) - 1)
        spaced = self.pattern is SPACED
        edges = pa.py_buffer(np.append(start, len(data)))
        chunks = pa.Array.from_buffers(pa.large_string(), len(start), [None, edges, pa.py_buffer(data)]).dictionary_encode()
        names = chunks.dictionary.to_pylist()
        ids = [self.known.get(c) for c in names]
        new = [k for k, x in enumerate(ids) if x is None and not (not spaced and names[k][0] in "\t\n\v\f\r ")]
        if new and self.size > MOST_BYTES:
            self.forget()
        for k, x in zip(new, self._learn([names[k] for k in new]), strict=True):
            ids[k] = x
        ids = [x or b"" for x in ids]
        size = np.array([len(x) for x in ids], np.int64) // 4
        flat, begin = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(size) - size
        which = chunks.indices.to_numpy()
        n = size[which]
        end = np.cumsum(n)
        out = flat[np.repeat(begin[which] - (end - n), n) + np.arange(end[-1])].tobytes()
        row = (4 * np.append(0, end)[np.searchsorted(start, at)]).tolist()
        return [out[a:b] for a, b in zip(row[:-1], row[1:], strict=True)]

    def _learn(self, chunks: list[str]) -> Iterator[bytes]:
        """The ids of chunks that aren't known; all but long ones are remembered."""
        for lo in range(0, len(chunks), 20_000):
            part = chunks[lo : lo + 20_000]
            for c, ids in zip(part, self._ids(part), strict=True):
                if len(c) <= LONG_CHUNK:
                    self.known[c] = ids
                    self.size += ENTRY + len(c) + len(ids)
                yield ids

    def _ids(self, chunks: list[str]) -> list[bytes]:
        """The ids of chunks. Most go to the tokenizer as lines, which it cuts there, and are told apart by their tokens' bytes."""
        spaced = self.pattern is SPACED
        out: list[bytes | None] = [None] * len(chunks)
        lines = [k for k, c in enumerate(chunks) if (spaced or c.isascii()) and not c[-1].isspace()]
        if len(lines) > 1:
            texts = ["".join([f"{chunks[k]}\n" for k in lines[a : a + LINES]]) for a in range(0, len(lines), LINES)]
            found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            ids = np.array([x for part in found for x in part], "<u4")
            ends = np.append(0, np.cumsum(self.widths[ids]))
            size = np.array([len(chunks[k].encode()) for k in lines], np.int64)
            stop = np.cumsum(size + spaced) - spaced  # where white space has ids, a line's end is a token of one byte
            first, last = np.searchsorted(ends, stop - size, "left"), np.searchsorted(ends, stop, "left")
            if ends[-1] == stop[-1] + spaced and (ends[first] == stop - size).all() and (ends[last] == stop).all():
                content = ids.tobytes()
                for k, a, b in zip(lines, (4 * first).tolist(), (4 * last).tolist(), strict=True):
                    out[k] = content[a:b]
        rest = [k for k, x in enumerate(out) if x is None]
        for k, e in zip(rest, self.tokenizer.encode_batch_fast([chunks[k] for k in rest], add_special_tokens=False) if rest else [], strict=True):
            out[k] = struct.pack(f"<{len(e)}I", *e.ids)
        return out

    def _apart(self, texts: list[str | None]) -> list[bytes]:
        """The ids of any texts."""
        cut = [self.pattern.findall(t or "") for t in texts]
        # one walk over the chunks; only texts with a chunk that isn't known are put together again
        out, late = [], []
        get, missing = self.known.__getitem__, self.known.missing
        missing.clear()
        for k, c in enumerate(cut):
            before = len(missing)
            out.append(b"".join(map(get, c)))
            if len(missing) > before:
                late.append(k)
        if not late:
            return out
        need = set(missing)
        if self.size > MOST_BYTES:
            self.forget()
            need = set().union(*[cut[k] for k in late])
        new = list(need)
        long = {c: ids for c, ids in zip(new, self._learn(new), strict=True) if len(c) > LONG_CHUNK}
        known = self.known
        for k in late:
            out[k] = b"".join([long[x] if x in long else known[x] for x in cut[k]] if long else map(known.__getitem__, cut[k]))
        return out


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(name: str, marks: bool = False) -> Encoder:
    """The worker's encoder for a file; the tokenizer lives as long as the worker."""
    if (name, marks) not in _encoders:
        _encoders[name, marks] = Encoder(name, marks)
    return _encoders[name, marks]


def text_groups(texts: list[str | None], limit: int = 1 << 19):
    """Ranges of texts of about `limit` characters together; a longer text is a range of its own."""
    lo, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t or "")
        if size >= limit:
            yield lo, k + 1
            lo, size = k + 1, 0
    if lo < len(texts):
        yield lo, len(texts)
