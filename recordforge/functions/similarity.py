"""Token-sort similarity on batches of candidate pairs (runs inside tasks).

``similarity(a, b) = 100 * 2 * LCS(a, b) / (len(a) + len(b))`` on the
sorted-token strings (the public definition of an InDel ratio). A pair
matches iff ``200 * LCS >= t * (len(a) + len(b))`` (exact integers).

The kernel is vectorised with numpy over all candidate pairs of a chunk:

1. length band: ``200 * min(la, lb) >= t * (la + lb)``;
2. character-histogram bound: the L1 distance of the two character
   histograms is a lower bound of the InDel distance, so pairs with
   ``100 * L1 > (100 - t) * (la + lb)`` cannot match;
3. exact LCS length by the bit-parallel recurrence of Allison-Dix / Hyyrö
   (``V = (V + U) | (V - U)``) on arrays of uint64 words, as many as the
   shorter string needs. Beyond ``MAX_WORDS`` words the same recurrence runs on
   Python integers, whose additions are then the faster ones.

Both filters are lossless; only step 3 decides. Step 3 works through the
remaining pairs in slices of at most ``SLICE_BYTES`` of masks and characters, by
ascending length, so one long string costs its own slice only; within a slice the
recurrence goes through ``LANES`` pairs at a time, whose state stays in the processor's cache.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np

WORD = 64
MAX_WORDS = 16
HIST_BUCKETS = 64
SLICE_BYTES = 8_000_000
LANES = 8_192


def _lcs_bigint(a: str, b: str) -> int:
    if len(a) > len(b):
        a, b = b, a
    pm: dict[str, int] = {}
    for i, ch in enumerate(a):
        pm[ch] = pm.get(ch, 0) | (1 << i)
    mask = (1 << len(a)) - 1
    v = mask
    for ch in b:
        u = v & pm.get(ch, 0)
        v = ((v + u) | (v - u)) & mask
    return len(a) - bin(v).count("1")


def lcs_length(a: str, b: str) -> int:
    """Reference scalar LCS length (any length)."""
    return _lcs_bigint(a, b)


class PairScorer:
    """Scores candidate pairs over one table of strings."""

    def __init__(self, strings):
        self.strings = list(strings)
        n = len(self.strings)
        self.lens = np.fromiter(map(len, self.strings), dtype=np.int64, count=n)
        self.flat = np.frombuffer("".join(self.strings).encode("utf-32-le"), dtype=np.uint32)
        self.starts = np.cumsum(self.lens) - self.lens

    @cached_property
    def hist(self) -> np.ndarray:
        """Character histograms folded into HIST_BUCKETS buckets (still a bound), made when they are first asked for."""
        n = len(self.strings)
        bucket = (self.flat ^ (self.flat >> 1 & 32)) % HIST_BUCKETS  # apart: small letters, and digits with signs
        cell = np.repeat(np.arange(n) * HIST_BUCKETS, self.lens) + bucket
        return np.bincount(cell, minlength=n * HIST_BUCKETS).reshape(n, HIST_BUCKETS).astype(np.int32)

    def _chars(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All characters of the strings ``ids``: their codes, and for each its string (as a place in ``ids``) and its place there."""
        lens = self.lens[ids]
        owner = np.repeat(np.arange(len(ids)), lens)
        pos = np.arange(len(owner)) - np.repeat(np.cumsum(lens) - lens, lens)
        return self.flat[self.starts[ids][owner] + pos], owner, pos

    def matches(self, ia: np.ndarray, ib: np.ndarray, threshold: int, histograms: bool = True) -> np.ndarray:
        """Boolean mask over pairs (ia[k], ib[k]) with similarity >= threshold. Without ``histograms`` (for pairs
        that such a bound has passed already) all pairs in the length band are scored."""
        t = int(threshold)
        la = self.lens[ia]
        lb = self.lens[ib]
        tot = la + lb
        ok = (200 * np.minimum(la, lb) >= t * tot) & (tot > 0)
        idx = np.nonzero(ok)[0]
        for at in range(0, len(idx) if histograms else 0, 10_000):  # the gathered histograms fit the processor's cache
            part = idx[at : at + 10_000]
            l1 = np.abs(self.hist[ia[part]] - self.hist[ib[part]]).sum(axis=1)
            ok[part[100 * l1 > (100 - t) * tot[part]]] = False
        idx = np.nonzero(ok)[0]
        if not len(idx):
            return ok
        # orient: short side first
        swap = la[idx] > lb[idx]
        a = np.where(swap, ib[idx], ia[idx])
        b = np.where(swap, ia[idx], ib[idx])
        lcs = self._lcs(a, b)
        ok[idx[200 * lcs < t * tot[idx]]] = False
        return ok

    def distances(self, ia: np.ndarray, ib: np.ndarray) -> np.ndarray:
        """Exact InDel distances ``la + lb - 2 * LCS`` of the pairs (ia[k], ib[k])."""
        la, lb = self.lens[ia], self.lens[ib]
        swap = la > lb
        return la + lb - 2 * self._lcs(np.where(swap, ib, ia), np.where(swap, ia, ib))

    def _lcs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.zeros(len(a), dtype=np.int64)
        words = -(-self.lens[a] // WORD)
        order = np.lexsort((self.lens[b], words))
        order = order[np.searchsorted(words[order], 1) :]  # an empty string has nothing in common with any
        long = np.searchsorted(words[order], MAX_WORDS, side="right")
        for k in order[long:]:
            out[k] = _lcs_bigint(self.strings[a[k]], self.strings[b[k]])
        order = order[:long]
        at = 0
        while at < len(order):
            to = min(len(order), at + 32_768)
            # halve the slice until its masks and characters fit
            while to - at > 1 and self._slice_bytes(a[order[at:to]], b[order[at:to]]) > SLICE_BYTES:
                to = at + (to - at) // 2
            part = order[at:to]
            out[part] = self._lcs_words(a[part], b[part], int(words[part[-1]]))
            at = to
        return out

    def _slice_bytes(self, a: np.ndarray, b: np.ndarray) -> int:
        short = np.unique(a)
        longest = int(self.lens[b].max())
        words = -(-int(self.lens[short].max()) // WORD)
        vocab = np.count_nonzero(np.bincount(self._chars(short)[0]))
        return 8 * words * (len(short) * (vocab + 1) + 4 * len(a)) + 4 * longest * len(np.unique(b))

    def _lcs_words(self, a: np.ndarray, b: np.ndarray, words: int) -> np.ndarray:
        order = np.argsort(self.lens[b], kind="stable")
        a, b = a[order], b[order]
        la, lb = self.lens[a], self.lens[b]
        short, own_a = np.unique(a, return_inverse=True)
        long, own_b = np.unique(b, return_inverse=True)
        flat, owner, pos = self._chars(short)
        vocab = np.flatnonzero(np.bincount(flat))
        spot = np.full(int(vocab[-1]) + 2, len(vocab), dtype=np.int32)  # a character of its own for all others, with empty masks
        spot[vocab] = np.arange(len(vocab))
        masks = np.zeros(len(short) * (len(vocab) + 1) * words, dtype=np.uint64)
        np.bitwise_or.at(masks, (owner * (len(vocab) + 1) + spot[flat]) * words + pos // WORD, np.left_shift(np.uint64(1), (pos % WORD).astype(np.uint64)))
        masks = masks.reshape(-1, words)
        # step by step the characters of each long string; past its end come empty masks, which change nothing
        flat, owner, pos = self._chars(long)
        chars = np.full((int(lb[-1]), len(long)), len(vocab), dtype=np.int32)
        chars[pos, owner] = spot[np.minimum(flat, len(spot) - 1)]
        v = np.full((words, len(a)), np.uint64(0xFFFFFFFFFFFFFFFF), dtype=np.uint64)
        for at in range(0, len(a), LANES):
            part = slice(at, at + LANES)
            self._recur(v[:, part], masks, own_a[part] * (len(vocab) + 1), chars, own_b[part], int(lb[part][-1]))
        # zeros of V within the short string's length
        zeros = np.zeros(len(a), dtype=np.int64)
        for w in range(words):
            held = np.clip(la - w * WORD, 0, WORD)
            keep = np.where(held >= WORD, np.uint64(0xFFFFFFFFFFFFFFFF), np.left_shift(np.uint64(1), held.astype(np.uint64) % np.uint64(WORD)) - np.uint64(1))
            zeros += held - np.bitwise_count(v[w] & keep).astype(np.int64)
        out = np.empty(len(a), dtype=np.int64)
        out[order] = zeros
        return out

    @staticmethod
    def _recur(v, masks, base, chars, own_b, steps):
        """``steps`` characters of the recurrence on the words ``v``, in place."""
        n, words = len(base), len(v)
        at, u, total = np.empty(n, np.int64), np.empty(n, np.uint64), np.empty(n, np.uint64)
        if words == 1:
            masks, v = masks[:, 0], v[0]
            for k in range(steps):
                np.add(chars[k].take(own_b), base, out=at)
                np.take(masks, at, out=u, mode="clip")
                np.bitwise_and(v, u, out=u)
                np.add(v, u, out=total)
                np.bitwise_xor(v, u, out=u)
                np.bitwise_or(total, u, out=v)
            return
        for k in range(steps):
            np.add(chars[k].take(own_b), base, out=at)
            mask = masks.take(at, axis=0)
            carry = np.zeros(n, dtype=np.uint64)
            for w in range(words):
                vw = v[w]
                np.bitwise_and(vw, mask[:, w], out=u)
                np.add(vw, u, out=total)
                over = total < vw
                total += carry
                over |= total < carry
                np.bitwise_xor(vw, u, out=u)
                np.bitwise_or(total, u, out=vw)
                carry = over.astype(np.uint64)


def token_sort_ratio(a: str, b: str) -> float:
    """Scalar reference: 100 * 2 * LCS / (la + lb) on sorted tokens."""
    sa = " ".join(sorted(a.split()))
    sb = " ".join(sorted(b.split()))
    if not sa and not sb:
        return 100.0
    return 100.0 * 2 * lcs_length(sa, sb) / (len(sa) + len(sb))
