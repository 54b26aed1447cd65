"""A minimal acyclic transducer from words to number sequences, held in flat arrays."""

from __future__ import annotations

import io
from collections.abc import Iterable, Sequence

import numpy as np

#: The arrays of a file, in order, and the type of all.
_ARRAYS = ("arcs", "targets", "arc_outputs", "finals", "final_outputs", "outputs")
_TYPE = np.dtype("<i8")


class _State:
    """A state of the word added last: not yet shared, its outputs may still move."""

    __slots__ = ("arcs", "final", "rest")

    def __init__(self):
        self.arcs: list[list] = []  # [byte, output, target]
        self.final, self.rest = False, ()

    def prepend(self, output: tuple) -> None:
        for arc in self.arcs:
            arc[1] = output + arc[1]
        if self.final:
            self.rest = output + self.rest


def compile_words(entries: Iterable[tuple[bytes, Sequence[int]]]) -> bytes:
    """The file of the minimal transducer of ``entries``, distinct words in byte order.

    Words arrive sorted, so once a word leaves a prefix the states behind it never
    change again: each is replaced by an equal one met before (same arcs, targets
    and outputs), which shares suffixes. An output is moved towards the start as
    far as all words through an arc agree, which makes equal states equal.
    """
    register: dict[tuple, int] = {}
    arcs, targets, arc_outputs, finals, final_outputs = [], [], [], [], []
    outputs: list[int] = []
    slices: dict[tuple, int] = {(): 0}  # an output's place; its length is in the low byte range

    def placed(output: tuple) -> int:
        at = slices.get(output)
        if at is None:
            at = slices[output] = (len(outputs) << 20) | len(output)
            outputs.extend(output)
        return at

    def freeze(state: _State) -> int:
        key = (state.final, state.rest, tuple(map(tuple, state.arcs)))
        found = register.get(key)
        if found is None:
            found = register[key] = len(finals)
            finals.append(int(state.final))
            final_outputs.append(placed(state.rest))
            for byte, output, target in state.arcs:
                arcs.append(found << 8 | byte)
                targets.append(target)
                arc_outputs.append(placed(output))
        return found

    path, last = [_State()], b""
    for word, output in entries:
        shared = next((i for i, (a, b) in enumerate(zip(word, last, strict=False)) if a != b), min(len(word), len(last)))
        for depth in range(len(last), shared, -1):
            path[depth - 1].arcs[-1][2] = freeze(path.pop())
        rest = tuple(output)
        for depth in range(shared):
            arc = path[depth].arcs[-1]
            same = next((i for i, (a, b) in enumerate(zip(arc[1], rest, strict=False)) if a != b), min(len(arc[1]), len(rest)))
            if same < len(arc[1]):
                path[depth + 1].prepend(arc[1][same:])
                arc[1] = arc[1][:same]
            rest = rest[same:]
        for depth in range(shared, len(word)):
            path[depth].arcs.append([word[depth], rest, None])
            path.append(_State())
            rest = ()
        path[-1].final, path[-1].rest = True, rest
        last = word
    for depth in range(len(last), 0, -1):
        path[depth - 1].arcs[-1][2] = freeze(path.pop())
    start = freeze(path[0])
    order = np.argsort(np.array(arcs, _TYPE), kind="stable")
    columns = [np.array(c, _TYPE) for c in (arcs, targets, arc_outputs, finals, final_outputs, outputs)]
    columns[:3] = [c[order] for c in columns[:3]]
    out = io.BytesIO()
    out.write(np.array([start, *map(len, columns)], _TYPE).tobytes())
    for column in columns:
        out.write(column.tobytes())
    return out.getvalue()


class Transducer:
    """Looks many words up at once in a memory-mapped file of ``compile_words``."""

    def __init__(self, path: str):
        data = np.memmap(path, _TYPE, mode="r")
        head = 1 + len(_ARRAYS)
        self.start, at = int(data[0]), head
        for name, size in zip(_ARRAYS, data[1:head], strict=True):
            setattr(self, name, data[at : at + int(size)])
            at += int(size)

    def look_up(self, chars: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which of the words ``chars[ends[i]:ends[i + 1]]`` are known, output lengths, outputs.

        All words take their k-th step together: one binary search among the arcs.
        """
        starts, lengths = ends[:-1], np.diff(ends)
        state = np.full(len(lengths), self.start, np.int64)
        alive = np.arange(len(lengths))
        steps: list[tuple[np.ndarray, np.ndarray]] = []  # words and the slices they put out
        done = np.zeros(len(lengths), bool)
        step = 0
        while len(alive):
            over = lengths[alive] == step
            finished = alive[over]
            accepted = finished[self.finals[state[finished]] > 0]
            done[accepted] = True
            steps.append((accepted, self.final_outputs[state[accepted]]))
            alive = alive[~over]
            if not len(alive) or not len(self.arcs):
                break
            wanted = state[alive] << 8 | chars[starts[alive] + step]
            arc = np.minimum(np.searchsorted(self.arcs, wanted), len(self.arcs) - 1)
            hit = self.arcs[arc] == wanted
            alive, arc = alive[hit], arc[hit]
            state[alive] = self.targets[arc]
            steps.append((alive, self.arc_outputs[arc]))
            step += 1
        sizes = np.zeros(len(lengths), np.int64)
        for words, slices in steps:
            sizes[words] += slices & 0xFFFFF
        sizes[~done] = 0
        cursor = np.cumsum(sizes) - sizes
        found = np.empty(int(sizes.sum()), np.int64)
        for words, slices in steps:
            keep = done[words]
            words, slices = words[keep], slices[keep]
            size = slices & 0xFFFFF
            within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            found[np.repeat(cursor[words], size) + within] = self.outputs[np.repeat(slices >> 20, size) + within]
            cursor[words] += size
        return done, sizes, found
