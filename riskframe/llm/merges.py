"""Byte-level BPE by merge replay over many distinct words at once.

All words lie in one array of symbols with links to the next and the previous one. An inverted index holds, for each
rank, the positions whose pair merges to it. Ranks are taken in ascending order; a merge touches its neighbours only,
and the pairs it makes are added to the index.
"""

from __future__ import annotations

import base64
import heapq

import numpy as np

_NONE = np.int64(-1)


class MergeTable:
    """The ranks of a vocabulary: bytes of a token to its rank, which is its id too."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.single = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        if (self.single < 0).any():
            raise ValueError("a vocabulary needs all 256 single bytes")
        keys, merged = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    merged.append(rank)
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        self.keys, self.merged = np.array(keys, np.int64)[order], np.array(merged, np.int64)[order]
        # A merge may make a pair that ranks before it. Only then does the order within a word matter.
        self.backwards = np.zeros(len(self.bytes_of), bool)
        for part in (self.keys >> 32, self.keys & 0xFFFFFFFF):
            self.backwards[part[self.merged < part]] = True

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank each pair merges to, -1 if none."""
        if not len(left) or not len(self.keys):
            return np.full(len(left), _NONE)
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.merged[at], _NONE)


def load_ranks(path: str) -> MergeTable:
    """A vocabulary file with a base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return MergeTable({base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)})


def replay(words: list[bytes], table: MergeTable) -> list[bytes]:
    """The ids of every word as little-endian unsigned 32-bit bytes.

    A word that is a token is that token; every other starts from single bytes.
    """
    found = [b"" if (rank := table.ranks.get(word)) is None else rank.to_bytes(4, "little") for word in words]
    open_words = [i for i, word in enumerate(words) if word and not found[i]]
    if not open_words:
        return found
    data = b"".join(words[i] for i in open_words)
    sizes = np.fromiter((len(words[i]) for i in open_words), np.int64, len(open_words))
    n = len(data)
    symbol = table.single[np.frombuffer(data, np.uint8)]
    word = np.repeat(np.arange(len(open_words)), sizes)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    last = np.cumsum(sizes) - 1
    after[last] = -1
    before[last[:-1] + 1] = -1

    index: dict[int, list[np.ndarray]] = {}
    queue: list[int] = []

    def add(positions: np.ndarray, ranks: np.ndarray) -> None:
        some = ranks >= 0
        positions, ranks = positions[some], ranks[some]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        positions, ranks = positions[order], ranks[order]
        cuts = np.flatnonzero(np.diff(ranks)) + 1
        edges = [0, *cuts.tolist(), len(ranks)]
        for rank, start, end in zip(ranks[edges[:-1]].tolist(), edges, edges[1:]):
            if rank not in index:
                index[rank] = []
                heapq.heappush(queue, rank)
            index[rank].append(positions[start:end])

    starts = np.flatnonzero(after >= 0)
    add(starts, table.rank_of(symbol[starts], symbol[starts + 1]))
    while queue:
        rank = heapq.heappop(queue)
        groups = index.pop(rank)
        at = groups[0] if len(groups) == 1 else np.unique(np.concatenate(groups))
        at = at[(symbol[at] >= 0) & (after[at] >= 0)]  # still the left half of some pair ...
        at = at[table.rank_of(symbol[at], symbol[after[at]]) == rank]  # ... and of this one
        if not len(at):
            continue
        if table.backwards[rank]:  # one merge a word, then look again
            first = np.ones(len(at), bool)
            first[1:] = word[at[1:]] != word[at[:-1]]
            if not first.all():
                index[rank] = [at[~first]]
                heapq.heappush(queue, rank)
            at = at[first]
        else:  # in a run of overlapping pairs every other one merges, from the left
            chained = np.zeros(len(at), bool)
            chained[1:] = after[at[:-1]] == at[1:]
            if chained.any():
                place = np.arange(len(at))
                head = np.maximum.accumulate(np.where(chained, 0, place))
                at = at[(place - head) % 2 == 0]
        gone = after[at]
        symbol[at], symbol[gone] = rank, -1
        beyond = after[gone]
        after[at] = beyond
        inner = beyond >= 0
        before[beyond[inner]] = at[inner]
        right = at[inner]
        left = before[at]
        left = left[left >= 0]
        touched = np.unique(np.concatenate([left, right])) if len(left) and len(right) else np.concatenate([left, right])
        add(touched, table.rank_of(symbol[touched], symbol[after[touched]]))
    stay = symbol >= 0
    ids = symbol[stay].astype("<u4").tobytes()
    ends = (np.cumsum(np.bincount(word[stay], minlength=len(open_words))) * 4).tolist()
    for i, start, end in zip(open_words, [0, *ends], ends):
        found[i] = ids[start:end]
    return found
