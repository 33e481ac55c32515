"""Words of a text: runs of letters and digits, without case and diacritics (dotless i equals i)."""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import regex
import xxhash

_WORD = re.compile(r"[^\W_]+")
_MARKS = regex.compile(r"\p{Mn}+")
_MEMO_LIMIT = 500_000


def fold(text: str) -> str:
    """Case-folded text without diacritics; its length can differ from the input's."""
    t = text.casefold()
    if not t.isascii():
        t = _MARKS.sub("", unicodedata.normalize("NFD", t)).replace("ı", "i")
    return t


def words(text: str) -> list[str]:
    return _WORD.findall(fold(text))


class WordHash(dict):
    """Memo of 64-bit word hashes that empties itself before it grows large."""

    def __missing__(self, w: str) -> int:
        if len(self) > _MEMO_LIMIT:
            self.clear()
        h = self[w] = xxhash.xxh64_intdigest(w)
        return h


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash, vectorised."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _bits(at: list | tuple, size: int) -> int:
    if len(at) < 64:
        out = 0
        for i in at:
            out |= 1 << i
        return out
    raw = bytearray(size // 8 + 1)
    for i in at:
        raw[i >> 3] |= 1 << (i & 7)
    return int.from_bytes(raw, "little")


def edit_distance(a: list, b: list, limit: int) -> int:
    """Words inserted, removed or replaced; anything above ``limit`` comes back as ``limit + 1``.

    Bit-parallel: one column of the distance table is one integer, so long texts cost
    their lengths' product over the machine word.
    """
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    lo = 0
    while lo < len(a) and lo < len(b) and a[lo] == b[lo]:
        lo += 1
    ea, eb = len(a), len(b)
    while ea > lo and eb > lo and a[ea - 1] == b[eb - 1]:
        ea, eb = ea - 1, eb - 1
    a, b = a[lo:ea], b[lo:eb]
    if not a or not b:
        return min(len(a) + len(b), limit + 1)
    where: dict = {}
    for i, w in enumerate(a):
        where.setdefault(w, []).append(i)
    # only frequent words keep their integer, so that memory stays far below the square of the length
    places = {w: _bits(at, len(a)) for w, at in where.items() if len(at) >= 64}
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, d = full, 0, len(a)
    for j, w in enumerate(b):
        eq = places.get(w) or _bits(where.get(w, ()), len(a))
        diag = (((eq & up) + up) ^ up) | eq
        plus = down | (~(diag | up) & full)
        minus = up & diag
        if plus & top:
            d += 1
        elif minus & top:
            d -= 1
        if d - (len(b) - 1 - j) > limit:
            return limit + 1
        plus, minus = ((plus << 1) | 1) & full, (minus << 1) & full
        eq |= down
        up = minus | (~(eq | plus) & full)
        down = plus & eq
    return min(d, limit + 1)
