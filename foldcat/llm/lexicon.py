"""A minimal acyclic transducer: sorted words in, token ids out, read from a memory-mapped file.

Words that end alike share states. Each arc holds how many accepted words it skips, so that the sum
along a path is the word's rank in sorted order, and the rank finds the word's ids. A state is named by
the place of its first arc; the arcs of all states are sorted by state and label, so that many words are
looked up at once, letter by letter. An arc also holds its target and whether the target accepts.
"""

from __future__ import annotations

import mmap

import numpy as np

_MAGIC = b"FOLDLEX2"


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """The image of a transducer that maps each word to its ids."""
    words = sorted(entries)
    # A state is [accepts, {label: state}]; a frozen one is known by its number in ``frozen``.
    frozen: dict[tuple, int] = {}
    states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []

    def freeze(node: list) -> int:
        key = (node[0], tuple(sorted(node[1].items())))
        found = frozen.get(key)
        if found is None:
            found = frozen[key] = len(states)
            states.append(key)
        return found

    # The open path holds the states of the last word; all that branches off is frozen.
    path: list[list] = [[False, {}]]
    last = b""
    for word in words:
        shared = 0
        while shared < min(len(word), len(last)) and word[shared] == last[shared]:
            shared += 1
        while len(path) > shared + 1:
            done = path.pop()
            path[-1][1][last[len(path) - 1]] = freeze(done)
        for _ in word[shared:]:
            path.append([False, {}])
        path[-1][0] = True
        last = word
    while len(path) > 1:
        done = path.pop()
        path[-1][1][last[len(path) - 1]] = freeze(done)
    root = freeze(path[0])

    below = [0] * len(states)  # a state's targets are frozen before it
    first, labels, targets, skips = [0], [], [], []
    for number, (accepts, arcs) in enumerate(states):
        count = int(accepts)
        for label, target in arcs:
            labels.append(first[number] << 8 | label)
            targets.append(target)
            skips.append(count)
            count += below[target]
        below[number] = count
        first.append(len(labels))
    # A state without arcs is named by the place behind all arcs, where nothing is found.
    named = [first[n] if arcs else len(labels) for n, (_, arcs) in enumerate(states)]
    offsets = np.zeros(len(words) + 1, np.uint32)
    if words:
        offsets[1:] = np.cumsum([len(entries[w]) for w in words])
    parts = [
        np.array([named[root], states[root][0], len(states), len(labels), len(words), int(offsets[-1])], np.uint32),
        np.array(labels, np.uint64),
        np.array([named[t] for t in targets], np.uint32),
        np.array([skip << 1 | states[t][0] for skip, t in zip(skips, targets)], np.uint32),
        offsets,
        np.array([i for w in words for i in entries[w]], np.uint32),
    ]
    return _MAGIC + b"".join(p.tobytes() for p in parts)


class Lexicon:
    """Look words up in an image on disk; its pages are shared by all processes of a machine."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            mapped = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        if mapped[: len(_MAGIC)] != _MAGIC:
            raise ValueError("not a lexicon")
        at = len(_MAGIC)

        def numbers(count: int, kind=np.uint32) -> np.ndarray:
            nonlocal at
            part = np.frombuffer(mapped, kind, count, at)
            at += part.nbytes
            return part

        self._root, self._accepts, self.n_states, n_arcs, self.n_words, n_ids = numbers(6).tolist()
        self._labels = numbers(n_arcs, np.uint64)
        self._targets = numbers(n_arcs)
        self._skips = numbers(n_arcs)
        self._offsets = numbers(self.n_words + 1)
        self._ids = numbers(n_ids)

    def get(self, word: bytes) -> list[int] | None:
        """The ids of a word, or None if the lexicon does not hold it."""
        return self.get_all([word])[0]

    def get_all(self, words: list[bytes]) -> list[list[int] | None]:
        """The same for each of many words."""
        found: list[list[int] | None] = [None] * len(words)
        letters = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words], dtype=np.int64)
        # Of each word still on its way: its number, the place of its next letter, its state, rank and end.
        number = np.arange(len(words))
        at = np.concatenate([np.zeros(1, np.int64), ends])[:-1]
        state = np.full(len(words), self._root, np.uint64)
        rank = np.zeros(len(words), np.int64)
        accepts = np.full(len(words), bool(self._accepts))
        while number.size:
            done = at == ends[number]
            if done.any():
                held = done & accepts
                low = self._offsets[rank[held]].tolist()
                high = self._offsets[rank[held] + 1].tolist()
                for n, a, b in zip(number[held].tolist(), low, high):
                    found[n] = self._ids[a:b].tolist()
                number, at, state, rank = number[~done], at[~done], state[~done], rank[~done]
            if not (number.size and self._labels.size):
                break
            sought = state << np.uint64(8) | letters[at]
            arc = np.minimum(np.searchsorted(self._labels, sought), self._labels.size - 1)
            there = self._labels[arc] == sought
            arc, number, at = arc[there], number[there], at[there] + 1
            skip = self._skips[arc]
            rank = rank[there] + (skip >> 1)
            accepts, state = skip & 1 == 1, self._targets[arc].astype(np.uint64)
        return found
