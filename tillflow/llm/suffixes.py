"""Two-stage suffix sorting of a byte string, and the repeats it shows."""

from __future__ import annotations

import numpy as np


def words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place as one big-endian number, zeros beyond the end."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    out = np.empty(len(text) + 1, np.uint64)
    for k in range(min(8, len(out))):
        out[k::8] = padded[k : k + (len(padded) - k) // 8 * 8].view(">u8")
    return out[:-1]


def dense_ranks(keys: np.ndarray, bits: int) -> np.ndarray:
    """Ranks of ``keys``, numbers of ``bits`` bits, from 1; equal ones rank equal."""
    place = len(keys).bit_length()
    if bits + place <= 64:  # key and place in one word: sorting words is faster than ordering them
        both = np.sort(keys << np.uint64(place) | np.arange(len(keys), dtype=np.uint64))
        by, keys = (both & np.uint64((1 << place) - 1)).view(np.int64), both >> np.uint64(place)
    else:
        by = np.argsort(keys)
        keys = keys[by]
    out = np.empty(len(keys), np.uint64)
    out[by] = np.cumsum(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return out


def string_ranks(text: np.ndarray, span: int) -> tuple[np.ndarray, int]:
    """Ranks of the strings of ``width`` bytes from each place, and that width.

    It is at most ``span``, and wide enough for a word to hold the ranks that make up ``span`` bytes
    where that takes no more than doubling the width. After the places of ``text`` come
    ``span + width`` ranks of zero, for strings beyond its end.
    """
    bits = (len(text) + 1).bit_length()
    width = max(1, min(span, (64 - bits) // 8))
    ranks = dense_ranks(words(text) >> np.uint64(64 - 8 * width), 8 * width)
    while width * 2 <= span and width * (64 // bits) < span:
        next_ = np.append(ranks[width:], np.zeros(min(width, len(ranks)), np.uint64))
        ranks = dense_ranks(ranks << np.uint64(bits) | next_, 2 * bits)
        width *= 2
    return np.append(ranks, np.zeros(span + width, np.uint64)), width


def sort_directly(ranks: np.ndarray, width: int, at: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes ``at`` by their first ``depth`` bytes, as many ranks at a time as a word holds."""
    bits = int(ranks.max(initial=1)).bit_length()
    order, tied, group, skip = at.copy(), np.arange(len(at)), np.zeros(len(at), np.uint64), 0
    several = 64 // bits
    while skip < depth and len(tied):
        keys = group
        for _ in range(several - (skip > 0)):
            # a last step that would pass ``depth`` looks at bytes seen before again
            keys = keys << np.uint64(bits) | ranks[order[tied] + min(skip, max(depth - width, 0))]
            skip += width
            if skip >= depth:
                break
        by = np.argsort(keys)
        order[tied], keys = order[tied][by], keys[by]
        fresh = np.append(True, keys[1:] != keys[:-1])
        alone = fresh & np.append(fresh[1:], True)
        group = np.cumsum(fresh)[~alone].astype(np.uint64)
        tied = tied[~alone]
    return order


def suffix_order(text: np.ndarray, depth: int, ranks: np.ndarray, width: int) -> np.ndarray:
    """Suffix array of ``text`` (uint8), right in the first ``depth`` bytes of each suffix.

    ``ranks`` and ``width`` are those of ``string_ranks``.

    Only suffixes smaller than their successor are sorted by content. A suffix that is
    larger follows from the one after it: the buckets of first bytes are scanned upwards,
    and each suffix found hands its predecessor the next place at the head of that one's
    bucket. The end of the text counts as smaller than any byte.
    """
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    steps = np.ones(n, np.int8)  # of the last suffix: larger than the empty one
    rise = np.sign(text[1:].astype(np.int16) - text[:-1]).astype(np.int8)
    steps[:-1] = -rise
    change = np.flatnonzero(steps)
    larger = np.repeat(steps[change] > 0, np.diff(change, prepend=-1))
    direct = sort_directly(ranks, width, np.flatnonzero(~larger), depth)
    heads = text[direct]
    cut = np.searchsorted(heads, np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[text[-1]].append(np.array([n - 1]))  # the empty suffix comes first
    out = []
    for c in range(256):
        bucket = []
        wave = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        while len(wave):  # runs of one byte induce within their own bucket
            bucket.append(wave)
            before = wave[wave > 0] - 1
            wave = before[(text[before] == c) & larger[before]]
        bucket.append(direct[cut[c] : cut[c + 1]])
        done = np.concatenate(bucket)
        out.append(done)
        before = done[done > 0] - 1
        before = before[larger[before] & (text[before] > c)]
        if len(before):
            first = text[before]
            by = np.argsort(first, kind="stable")
            first, before = first[by], before[by]
            edges = np.flatnonzero(np.append(True, first[1:] != first[:-1]))
            for a, b in zip(edges, np.append(edges[1:], len(first)), strict=True):
                waiting[first[a]].append(before[a:b])
    return np.concatenate(out)


def common_prefix_at_least(ranks: np.ndarray, width: int, order: np.ndarray, span: int) -> np.ndarray:
    """For each neighbour pair in ``order``: is their common prefix ``span`` bytes or longer?

    All suffixes of ``order`` hold at least ``span`` bytes.
    """
    same = np.ones(max(len(order) - 1, 0), bool)
    left, right = order[:-1], order[1:]
    live = np.arange(len(same))
    for skip in [*range(0, span - width, width), span - width]:
        eq = ranks[left[live] + skip] == ranks[right[live] + skip]
        same[live[~eq]] = False
        live = live[eq]
    return same


def repeated_starts(
    text: np.ndarray, starts: np.ndarray, span: int, place: np.ndarray
) -> np.ndarray:
    """Which of ``starts`` begin a string of ``span`` bytes that another start of lower ``place`` begins.

    ``starts`` ascend; ``place`` ranks them. Equal places do not count as earlier.
    """
    ranks, width = string_ranks(text, span)
    order = suffix_order(text, span, ranks, width)
    where = np.full(len(text), -1, np.int64)
    where[starts] = np.arange(len(starts))
    order = order[where[order] >= 0]
    out = np.zeros(len(starts), bool)
    if not len(order):
        return out
    same = common_prefix_at_least(ranks, width, order, span)
    heads = np.flatnonzero(np.append(True, ~same))
    ranks = place[where[order]]
    least = np.minimum.reduceat(ranks, heads)
    sizes = np.diff(np.append(heads, len(order)))
    out[where[order]] = ranks > np.repeat(least, sizes)
    return out
