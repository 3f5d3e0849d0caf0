"""Whole texts as arrays: words of many documents hashed at once with numpy.

An Arrow string column already holds its UTF-8 bytes in one buffer, so the
words of a batch are found and hashed with a handful of array passes and no
Python string per word. A null text counts as an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20  # text handled at a time; bounds the working arrays, not the text

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Bytes of a word when words are runs of anything but white space.
TOKEN = ~_SPACE
#: Bytes of a word when words are runs of letters and digits (every non-ASCII byte counts as one).
ALNUM = np.zeros(256, bool)
for _lo, _hi in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    ALNUM[_lo:_hi + 1] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

_BYTE_KEY = np.random.default_rng(20240117).integers(1, 2**63, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over a 64-bit value."""
    h = np.asarray(h, np.uint64).copy()
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and, per row, where its text starts (one more entry than rows)."""
    col = col.fill_null("").cast(pa.large_string())
    _, offsets, data = col.buffers()
    offs = np.frombuffer(offsets, np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8)[offs[0]:offs[-1]] if data is not None and len(col) else np.zeros(0, np.uint8)
    return raw, offs - offs[0]


def chunks(batch: pa.RecordBatch, text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text each; a longer text is a slice of its own."""
    if not batch.num_rows:
        return
    _, offs = buffers(batch.column(text))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(offs, offs[at] + limit, "right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def lower_bytes(raw: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 capitals to small letters, byte for byte, so offsets stay."""
    out = _LOWER[raw]
    lead = np.flatnonzero(raw[:-1] == 0xC3)
    if lead.size:
        b = raw[lead + 1]
        lat = lead[(b >= 0x80) & (b <= 0x9E) & (b != 0x97)] + 1
        out[lat] += 0x20
    return out


_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}
_BACK = np.uint64(pow(int(_STEP), -1, 2**64))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """step^i and step^-i modulo 2^64 for i < n."""
    if _POWERS["up"].size < n:
        for name, base in (("up", _STEP), ("down", _BACK)):
            p = np.full(n + n // 4, base, np.uint64)
            p[0] = 1
            _POWERS[name] = np.cumprod(p)
    return _POWERS["up"], _POWERS["down"]


class Words:
    """Words of a chunk: ``hash`` and ``doc`` per word, ``at`` and ``end`` (bytes) per word,
    ``starts`` per document (index of its first word, one more entry than documents)."""

    def __init__(self, col: pa.Array, word: np.ndarray = TOKEN, ascii_only: bool = False, as_is: bool = False):
        raw, offs = buffers(col)
        self.raw, self.offs = raw, offs
        self.bytes = raw if as_is else _LOWER[raw] if ascii_only else lower_bytes(raw)
        inside = word[raw]
        edge = inside[1:] != inside[:-1]
        cut = np.zeros(raw.size + 1, bool)
        if raw.size:
            cut[1:-1] = edge
            cut[offs] = True  # a word never runs over a document's end
        bounds = np.flatnonzero(cut)
        runs = inside[bounds[:-1]] if raw.size else np.zeros(0, bool)
        self.at, self.end = bounds[:-1][runs], bounds[1:][runs]
        self.len = self.end - self.at
        self.starts = np.searchsorted(self.at, offs)
        self.doc = np.repeat(np.arange(len(col)), np.diff(self.starts))
        # sum of key[byte] * step^position over a word's bytes, modulo 2^64, from running sums
        up, down = _powers(raw.size + 1)
        total = np.zeros(raw.size + 1, np.uint64)
        np.cumsum(_BYTE_KEY[self.bytes] * up[:raw.size], out=total[1:])
        self._total, self._down = total, down
        self.hash = mix((total[self.end] - total[self.at]) * down[self.at])

    def part(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hash of the bytes from ``a`` to ``b`` (arrays of byte indexes)."""
        return mix((self._total[b] - self._total[a]) * self._down[a])

    def prefix(self, n: int) -> np.ndarray:
        """Hash of each word's first ``n`` bytes (the whole word if shorter)."""
        return self.part(self.at, np.minimum(self.at + n, self.end))


class Runs:
    """Hashes of any run of words: ``of(a, b)`` for words a to b (arrays), from running sums."""

    def __init__(self, words: np.ndarray):
        up, self._down = _powers(words.size + 1)
        self._total = np.zeros(words.size + 1, np.uint64)
        np.cumsum(words * up[:words.size], out=self._total[1:])

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((self._total[b] - self._total[a]) * self._down[a] + (b - a).astype(np.uint64))


def shingles(words: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``n`` words inside one document, and each run's document. A
    document of 1 to n - 1 words has one shingle, its whole word list."""
    count = np.diff(starts)
    docs = np.repeat(np.arange(count.size), np.maximum(count - n + 1, 0))
    if words.size >= n:
        ok = np.arange(words.size - n + 1)
        doc_of = np.repeat(np.arange(count.size), count)
        ok = ok[doc_of[ok] == doc_of[ok + n - 1]]
        h = np.zeros(ok.size, np.uint64)
        for j in range(n):
            h = (h + words[ok + j]) * _STEP
            h ^= h >> np.uint64(29)
    else:
        h = np.zeros(0, np.uint64)
    short = np.flatnonzero((count > 0) & (count < n))
    extra = np.zeros(short.size, np.uint64)
    for k, d in enumerate(short):
        for w in words[starts[d]:starts[d + 1]]:
            extra[k:k + 1] = (extra[k:k + 1] + w) * _STEP + np.uint64(7)
    h, docs = np.concatenate([mix(h), mix(extra)]), np.concatenate([docs, short])
    order = np.argsort(docs, kind="stable")
    return h[order], docs[order]


def group_sum(values: np.ndarray, group: np.ndarray, n: int) -> np.ndarray:
    """Sums per group number, in double."""
    return np.bincount(group, weights=values, minlength=n).astype(np.float64)
