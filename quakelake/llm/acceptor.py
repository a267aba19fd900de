"""Minimised acceptors of words, composed with a transducer of one edit."""

from __future__ import annotations

from collections.abc import Iterable, Iterator


class Acceptor:
    """The smallest deterministic machine without cycles that accepts just the given words.

    Words come sorted. When a word leaves the path of the one before, the states it leaves can get
    no more arcs: each is replaced by an equal state if there is one.
    """

    def __init__(self, words: Iterable[str]) -> None:
        self.arcs: list[dict[str, int]] = [{}]
        self.final: list[bool] = [False]
        known: dict[tuple, int] = {}
        path, before = [0], ""

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                state = path.pop()
                kind = (self.final[state], *self.arcs[state].items())
                self.arcs[path[-1]][before[len(path) - 1]] = known.setdefault(kind, state)

        for word in words:
            same = 0
            while same < len(before) and same < len(word) and before[same] == word[same]:
                same += 1
            close(same)
            for letter in word[same:]:
                self.arcs[path[-1]][letter] = len(self.arcs)
                path.append(len(self.arcs))
                self.arcs.append({})
                self.final.append(False)
            self.final[path[-1]] = True
            before = word
        close(0)


class OneEdit:
    """An acceptor, composed with one replaced or inserted letter, composed with the acceptor again.

    A state of the composition is a pair of states of the acceptor, and whether the edit has been
    made. Before it both are the same state; after it both read the same letters to the end.
    ``width`` is the length of the longer word of a pair: a replacement joins two words of that
    length, an insertion one that is a letter shorter with one of it.
    """

    def __init__(self, acceptor: Acceptor, width: int) -> None:
        self.acceptor = acceptor
        self.width = width
        self._open: dict[tuple[int, int, int], bool] = {}
        self._edits: dict[tuple[int, int], list[tuple[str, str, int, int, int]]] = {}

    def _meets(self, one: int, two: int, left: int) -> bool:
        """Whether both states accept a common string of ``left`` letters."""
        key = (one, two, left)
        found = self._open.get(key)
        if found is None:
            arcs = self.acceptor.arcs
            if left:
                others = arcs[two]
                found = any(
                    letter in others and self._meets(state, others[letter], left - 1)
                    for letter, state in arcs[one].items()
                )
            else:
                found = self.acceptor.final[one] and self.acceptor.final[two]
            self._open[key] = found
        return found

    def _common(self, one: int, two: int, left: int) -> Iterator[str]:
        arcs, stack = self.acceptor.arcs, [(one, two, "")]
        while stack:
            one, two, read = stack.pop()
            rest = left - len(read)
            if not self._meets(one, two, rest):
                continue
            if not rest:
                yield read
                continue
            others = arcs[two]
            stack.extend((state, others[letter], read + letter) for letter, state in arcs[one].items() if letter in others)

    def _edits_at(self, state: int, left: int) -> list[tuple[str, str, int, int, int]]:
        """Edits that lead to a common rest: letters of the first and second word, and what follows.

        ``left`` are the letters the longer word has still to read.
        """
        key = (state, left)
        if key not in self._edits:
            arcs = sorted(self.acceptor.arcs[state].items())
            found = [
                (a, b, one, two, left - 1)
                for i, (a, one) in enumerate(arcs)
                for b, two in arcs[i + 1 :]
                if self._meets(one, two, left - 1)
            ]
            found += [("", b, state, two, left - 1) for b, two in arcs if self._meets(state, two, left - 1)]
            self._edits[key] = found
        return self._edits[key]

    def pairs(self) -> Iterator[tuple[str, str]]:
        """Each pair once, the shorter word first.

        Of equal letters in a row any one may be the inserted one: the last of them stands for all,
        so the rest does not start with it.
        """
        stack = [(0, "")]
        while stack:
            state, read = stack.pop()
            left = self.width - len(read)
            if not left:
                continue
            for a, b, one, two, rest in self._edits_at(state, left):
                for same in self._common(one, two, rest):
                    if a or not same.startswith(b):
                        yield read + a + same, read + b + same
            stack.extend((after, read + letter) for letter, after in self.acceptor.arcs[state].items())
