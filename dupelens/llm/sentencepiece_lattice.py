"""SentencePiece encoding and decoding by N-best segmentation over the piece lattice.

Text becomes a leading space symbol followed by the text with its spaces as that symbol. Every piece of the vocabulary
that occurs at a position is an edge with the score that the model file gives; a character that no piece covers is an edge of its
UTF-8 bytes. The best segmentation is the path of greatest total score. Forward Viterbi scores are the exact heuristic
of a backward A* search that yields paths in falling order of score.

No piece holds a space symbol after another character, nor a line break, so the lattice falls apart at those places
(checked when the model is loaded), and further between two characters that stand in no piece. Each distinct cell so
made is solved once per block of texts, all cells of a block together: numpy walks the tree of pieces from all positions,
then carries the two best scores of each position forward, one position of all cells at a time. The N best segmentations
of a whole text differ from the best one only in the N - 1 parts whose second best is closest, and only these parts are
searched by A*.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, count, pairwise
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from dupelens.llm.tables import texts, tidy
from dupelens.llm.words import chunks, utf8

SPACE = "▁"
PART = re.compile(f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+")
LONGEST_CACHE = 200_000
#: Bytes of texts whose parts are told apart together, and characters of cells that are solved together; both bound the
#: memory of a task, a longer text is a block of its own.
BLOCK_BYTES = 1 << 20
TOGETHER = 100_000
#: A cell of more characters is solved alone.
LONG_CELL = 64
MISSING = object()
NEVER = float("-inf")
BEST = 4
BYTE_GAP = 10.0
#: Pieces at or below this score are in the model file for completeness only.
UNWANTED = -1e8

Path = tuple[float, tuple[int, ...]]


@dataclass
class Solved:
    """Best score of each string, how much its second best segmentation loses, and the ids of the best."""

    score: np.ndarray
    loss: np.ndarray
    ids: pa.LargeListArray


@dataclass
class Block:
    """The distinct parts of a block of texts, solved; ``index`` names those of text ``i`` from ``rows[i]`` to
    ``rows[i + 1]``; ``raw`` and ``at`` are the bytes that were cut into parts."""

    parts: pa.LargeStringArray
    solved: Solved
    index: np.ndarray
    rows: np.ndarray
    raw: np.ndarray
    at: np.ndarray


def _distinct(raw: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, pa.LargeStringArray]:
    """The bytes cut at ``begins``: for each piece the index of its string, and the distinct strings."""
    ends = np.append(begins, len(raw)).astype(np.int64)
    cut = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(raw)))
    made = cut.dictionary_encode()
    return made.indices.to_numpy(), made.dictionary


def _lists(sizes: np.ndarray, values: np.ndarray) -> pa.LargeListArray:
    return pa.LargeListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int64()), pa.array(values, pa.int32()))


class Lattice:
    """Pieces, scores and byte pieces of a model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.piece: list[str | bytes] = []
        self.score: dict[str, tuple[float, int]] = {}
        self.byte: dict[int, int] = {}
        for i in range(model.get_piece_size()):
            name = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte[int(name[3:5], 16)] = i
                self.piece.append(bytes([int(name[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.piece.append("")
            else:
                self.score[name] = (model.get_score(i), i)
                self.piece.append(name)
        if any(re.search(f"[^{SPACE}]{SPACE}|\n", p) for p in self.score):
            raise ValueError("pieces of this model cross a space or a line break")
        # Pieces and all their beginnings; a beginning that is no piece has no score.
        self.found: dict[str, tuple[float, int] | None] = {p[:n]: None for p in self.score for n in range(1, len(p) + 1)}
        self.found.update(self.score)
        # The same as a tree by character: for each its edge, if a piece ends there, and what may follow.
        self.tree: dict = {}
        for name, edge in self.found.items():
            node = self.tree
            for char in name[:-1]:
                node = node.setdefault(char, [None, {}])[1]
            node.setdefault(name[-1], [None, {}])[0] = edge
        self.inside = {p[i : i + 2] for p in self.score for i in range(len(p) - 1)}
        self.bytes = [p if isinstance(p, bytes) else p.encode("utf-8") for p in self.piece]
        self.raw = pa.array(self.bytes, pa.large_binary())
        self.fallback = min((s for s, _ in self.score.values() if s > UNWANTED), default=0.0) - BYTE_GAP
        self._arrays()
        self.known: dict[str, tuple[float, tuple[int, ...], float]] = {}
        self.several: dict[tuple[str, int], list[Path]] = {}

    def _arrays(self) -> None:
        """The tree for numpy. Characters of pieces have numbers from 1 (0: all others), which are also the nodes they
        lead to from the root; a step from a node by a character is one number in a sorted array."""
        chars = sorted(set(chain.from_iterable(self.found)))
        number = {c: i for i, c in enumerate(chars, 1)}
        self.number = np.zeros(0x110000, np.int64)
        self.number[[ord(c) for c in chars]] = range(1, len(chars) + 1)
        self.width = len(chars) + 1
        longer = [p for p in self.found if len(p) > 1]
        node = number | {p: i for i, p in enumerate(longer, self.width)}
        steps = np.array([node[p[:-1]] * self.width + number[p[-1]] for p in longer], np.int64)
        order = np.argsort(steps)
        self.steps, self.leads = steps[order], order + self.width
        self.pairs = np.sort(np.array([number[p[0]] * self.width + number[p[1]] for p in self.inside], np.int64))
        edges = [(node[p], *edge) for p, edge in self.score.items()]
        self.node_score = np.full(self.width + len(longer), np.nan)
        self.node_id = np.full(self.width + len(longer), -1, np.int32)
        self.node_score[[n for n, _, _ in edges]] = [s for _, s, _ in edges]
        self.node_id[[n for n, _, _ in edges]] = [i for _, _, i in edges]
        self.chars = np.array([1 if isinstance(p, bytes) else len(p) for p in self.piece], np.int64)

    def by_bytes(self, char: str) -> tuple[float, tuple[int, ...]]:
        raw = char.encode("utf-8", "surrogatepass")
        return self.fallback * len(raw), tuple(self.byte[b] for b in raw)

    def forward(self, part: str) -> tuple[list[float], list[list[tuple[int, float, tuple[int, ...]]]]]:
        """Viterbi scores of all positions, and the edges ``(begin, score, ids)`` that end at each."""
        n = len(part)
        best = [0.0] + [float("-inf")] * n
        ending: list[list[tuple[int, float, tuple[int, ...]]]] = [[] for _ in range(n + 1)]
        for i in range(n):
            here, j, single = best[i], i + 1, False
            while j <= n and (edge := self.found.get(part[i:j], MISSING)) is not MISSING:
                if edge is not None:
                    single |= j == i + 1
                    ending[j].append((i, edge[0], (edge[1],)))
                    best[j] = max(best[j], here + edge[0])
                j += 1
            if not single:
                score, ids = self.by_bytes(part[i])
                ending[i + 1].append((i, score, ids))
                best[i + 1] = max(best[i + 1], here + score)
        return best, ending

    def paths(self, part: str, most: int) -> list[Path]:
        """The ``most`` best segmentations ``(score, ids)``, by backward A* with forward scores as the rest of the way."""
        if (part, most) in self.several:
            return self.several[part, most]
        best, ending = self.forward(part)
        out: list[Path] = []
        order = count()
        queue = [(-best[-1], -next(order), len(part), 0.0, ())]
        while queue and len(out) < most:
            _, _, at, behind, ids = heapq.heappop(queue)
            if at == 0:
                out.append((behind, ids))
                continue
            for begin, edge, own in ending[at]:
                heapq.heappush(queue, (-(best[begin] + edge + behind), -next(order), begin, edge + behind, own + ids))
        if len(self.several) >= LONGEST_CACHE:
            self.several.clear()
        self.several[part, most] = out
        return out

    def solve(self, part: str) -> tuple[float, tuple[int, ...], float]:
        """Best score and ids of a part, and how much its second best segmentation loses: Viterbi with the two best
        scores of each position. Between two characters that stand in no piece the lattice falls apart further, and
        the second best differs in the side where that costs least."""
        n, inside, known = len(part), self.inside, self.known
        if len(known) >= LONGEST_CACHE:
            known.clear()
        cuts = [i for i in range(1, n) if part[i - 1 : i + 1] not in inside]
        if cuts:
            sides = [part[a:b] for a, b in zip([0, *cuts], [*cuts, n], strict=True)]
            solved = [known.get(p) or self.solve(p) for p in sides]
            found = known[part] = (
                sum(map(itemgetter(0), solved)),
                tuple(chain.from_iterable(map(itemgetter(1), solved))),
                min(map(itemgetter(2), solved)),
            )
            return found
        first, second = [NEVER] * (n + 1), [NEVER] * (n + 1)
        back: list = [None] * (n + 1)
        first[0] = 0.0
        for i in range(n):
            one, two = first[i], second[i]
            node, j, single = self.tree, i, False
            while j < n:
                step = node.get(part[j])
                if step is None:
                    break
                edge, node = step
                j += 1
                if edge is None:
                    continue
                single = single or j == i + 1
                gain = edge[0]
                score = one + gain
                if score > first[j]:
                    other = two + gain
                    second[j] = first[j] if first[j] > other else other
                    first[j] = score
                    back[j] = (i, edge[1])
                elif score > second[j]:
                    second[j] = score
            if not single:
                gain, ids = self.by_bytes(part[i])
                j, score = i + 1, one + gain
                if score > first[j]:
                    second[j] = max(first[j], two + gain)
                    first[j] = score
                    back[j] = (i, ids)
                elif score > second[j]:
                    second[j] = score
        at, ids = n, []
        while at:
            at, own = back[at]
            ids.extend((own,) if isinstance(own, int) else own[::-1])
        ids.reverse()
        found = known[part] = (first[n], tuple(ids), first[n] - second[n])
        return found

    def _edges(self, points: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> list[tuple[np.ndarray, ...]]:
        """For each length of a piece the edges ``(position, cell, score, id)`` of the cells, by position in the cell;
        ``sizes`` rise. An edge of bytes has id -1."""
        shorter = np.searchsorted(sizes, np.arange(sizes[-1]), "right")
        at = np.repeat(np.arange(sizes[-1]), len(sizes) - shorter)
        cell = np.concatenate([np.arange(n, len(sizes)) for n in shorter])
        point = points[begins[cell] + at]
        node = self.number[point]
        score, ids = self.node_score[node], self.node_id[node]
        raw = 1 + (point >= 0x80) + (point >= 0x800) + (point >= 0x10000)
        out = [(at, cell, np.where(ids < 0, self.fallback * raw, score), ids)]
        while len(node):
            more = np.flatnonzero(at + len(out) < sizes[cell])
            at, cell, node = at[more], cell[more], node[more]
            step = node * self.width + self.number[points[begins[cell] + at + len(out)]]
            found = np.minimum(np.searchsorted(self.steps, step), len(self.steps) - 1)
            more = np.flatnonzero(self.steps[found] == step)
            at, cell, node = at[more], cell[more], self.leads[found[more]]
            ends = np.flatnonzero(self.node_id[node] >= 0)
            out.append((at[ends], cell[ends], self.node_score[node[ends]], self.node_id[node[ends]]))
        return out

    def _viterbi(self, points: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
        """As ``solve`` for many cells of rising ``sizes``: scores, losses, and the edges of the best segmentations as
        steps ``(cell, id, end)`` from the ends of the cells."""
        n, longest = len(sizes), int(sizes[-1])
        first, second = np.full((longest + 1, n), NEVER), np.full((longest + 1, n), NEVER)
        back = np.full((longest + 1, n), -1, np.int32)
        first[0] = 0.0
        edges = self._edges(points, begins, sizes)
        splits = [np.searchsorted(at, np.arange(longest + 1)).tolist() for at, *_ in edges]
        for i in range(longest):
            for j, (split, (_, cells, gains, ids)) in enumerate(zip(splits, edges, strict=True), i + 1):
                a, b = split[i], split[i + 1]
                if a == b:
                    continue
                cell, gain = cells[a:b], gains[a:b]
                score, before = first[i, cell] + gain, first[j, cell]
                better = score > before
                other = np.where(better, second[i, cell] + gain, second[j, cell])
                second[j, cell] = np.maximum(other, np.minimum(score, before))
                first[j, cell] = np.maximum(score, before)
                back[j, cell[better]] = ids[a:b][better]
        steps, cell, at = [], np.arange(n), sizes
        while len(cell):
            own = back[at, cell]
            steps.append((cell, own, at))
            at = at - np.where(own < 0, 1, self.chars[own])
            cell, at = cell[at > 0], at[at > 0]
        last = np.arange(n)
        return first[sizes, last], first[sizes, last] - second[sizes, last], steps

    def _solve_cells(self, points: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> Solved:
        """The cells ``points[begins : begins + sizes]``, which hold no place where the lattice falls apart."""
        score, loss = np.zeros(len(sizes)), np.zeros(len(sizes))
        order = np.argsort(sizes, kind="stable")
        total = np.append(0, np.cumsum(sizes[order]))
        edges: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        # Cells of like sizes together, so that little of the arrays stays unused.
        borders = [0, LONG_CELL // 16, LONG_CELL // 4, LONG_CELL]
        for low, high in pairwise(np.searchsorted(sizes[order], borders, "right").tolist()):
            for a, b in chunks(total[low : high + 1], TOGETHER):
                some = order[low + a : low + b]
                score[some], loss[some], steps = self._viterbi(points, begins[some], sizes[some])
                edges += [(some[cell], own, begins[some[cell]] + at - 1) for cell, own, at in steps]
        alone: list[tuple[int, tuple[int, ...]]] = []
        for c in order[sizes[order] > LONG_CELL].tolist():
            cell = points[begins[c] : begins[c] + sizes[c]]
            score[c], ids, loss[c] = self.solve(cell.tobytes().decode("utf-32-le"))
            alone.append((c, ids))
        many = np.zeros(len(sizes), np.int64)
        spelt = []
        for cell, own, at in edges:
            many[cell] += 1
            for k in np.flatnonzero(own < 0).tolist():
                spelt.append(self.by_bytes(chr(points[at[k]]))[1])
                many[cell[k]] += len(spelt[-1]) - 1
        for c, ids in alone:
            many[c] = len(ids)
        end = np.cumsum(many)
        values = np.zeros(int(many.sum()), np.int32)
        for c, ids in alone:
            values[end[c] - len(ids) : end[c]] = ids
        raw = iter(spelt)
        for cell, own, _ in edges:
            end[cell] -= 1
            values[end[cell]] = own
            for k in np.flatnonzero(own < 0).tolist():
                ids = next(raw)
                end[cell[k]] -= len(ids) - 1
                values[end[cell[k]] : end[cell[k]] + len(ids)] = ids
        return Solved(score, loss, _lists(many, values))

    def solve_all(self, parts: pa.LargeStringArray) -> Solved:
        """``solve`` for an array of distinct parts, none of them empty."""
        made = [self._solve_parts(parts.slice(a, b - a)) for a, b in chunks(utf8(parts)[1], BLOCK_BYTES)]
        score, loss = (np.concatenate([getattr(m, name) for m in made] or [np.zeros(0)]) for name in ("score", "loss"))
        none = _lists(np.zeros(0, np.int64), np.zeros(0, np.int32))
        return Solved(score, loss, pa.concat_arrays([m.ids for m in made] or [none]))

    def _solve_parts(self, parts: pa.LargeStringArray) -> Solved:
        raw, at = utf8(parts)
        points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), "<u4")
        place = np.flatnonzero((raw & 0xC0) != 0x80)
        number = self.number[points]
        pair = number[:-1] * self.width + number[1:]
        cut = np.ones(len(points), bool)
        if len(self.pairs):
            cut[1:] = self.pairs[np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)] != pair
        first = np.searchsorted(place, at[:-1])
        cut[first] = True
        begins = np.flatnonzero(cut)
        index, cells = _distinct(raw, place[begins])
        one = np.zeros(len(cells), np.int64)
        one[index] = np.arange(len(index))
        sizes = np.diff(np.append(begins, len(points)))
        solved = self._solve_cells(points, begins[one], sizes[one])
        first = np.searchsorted(begins, first)
        ids = solved.ids.take(pa.array(index))
        many = np.add.reduceat(ids.value_lengths().to_numpy(), first)
        return Solved(
            np.add.reduceat(solved.score[index], first),
            np.minimum.reduceat(solved.loss[index], first),
            _lists(many, ids.flatten().to_numpy()),
        )

    def block(self, column: pa.Array) -> Block:
        """The parts of the texts of a column (null: empty), as ``parts`` gives them."""
        column = column.cast(pa.large_string()).fill_null("")
        lead, none = pa.scalar(SPACE, pa.large_string()), pa.scalar("", pa.large_string())
        spaced = pc.binary_join_element_wise(lead, pc.replace_substring(column, " ", SPACE), none)
        raw, at = utf8(pc.if_else(pc.equal(pc.binary_length(column), 0), column, spaced))
        line, space = raw == ord("\n"), np.zeros(len(raw), bool)
        symbol = SPACE.encode("utf-8")
        space[:-2] = (raw[:-2] == symbol[0]) & (raw[1:-1] == symbol[1]) & (raw[2:] == symbol[2])
        first = line | space
        first[3:] &= ~(space[3:] & space[:-3])
        first[1:] |= line[:-1]
        first[at[:-1][at[:-1] < at[1:]]] = True
        begins = np.flatnonzero(first)
        index, parts = _distinct(raw, begins)
        return Block(parts, self.solve_all(parts), index, np.searchsorted(begins, at), raw, at)

    def best_ids(self, part: str) -> tuple[int, ...]:
        return (self.known.get(part) or self.solve(part))[1]

    def parts(self, text: str) -> list[str]:
        return PART.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def nearest(self, block: Block, row: int, most: int) -> list[tuple[float, list[tuple[int, int]]]]:
        """The ``most`` best segmentations of a text as ``(score, [(part, rank of its segmentation)])``, best first, each
        naming only the parts that differ from the best."""
        index = block.index[block.rows[row] : block.rows[row + 1]]
        total = float(block.solved.score[index].sum())
        losses = block.solved.loss[index]
        near = np.argpartition(losses, most - 1)[: most - 1] if len(index) >= most else np.arange(len(index))
        options: list[tuple[float, list[tuple[int, int]]]] = [(0.0, [])]
        for i in sorted(near.tolist()):
            if not np.isfinite(losses[i]):
                continue
            choices = self.paths(block.parts[index[i]].as_py(), most)
            options = sorted(
                (
                    (loss + choices[0][0] - score, changed + [(i, rank)] * (rank > 0))
                    for loss, changed in options
                    for rank, (score, _) in enumerate(choices)
                ),
                key=lambda o: o[0],
            )[:most]
        return [(total - loss, changed) for loss, changed in options]

    def n_best(self, text: str, most: int = BEST) -> tuple[list[int], list[tuple[float, list[tuple[int, int]]]], list[str]]:
        """The ids of the best segmentation; the ``most`` best as ``nearest`` gives them; and the parts."""
        block = self.block(pa.array([text], pa.string()))
        ids = block.solved.ids.take(pa.array(block.index)).flatten().to_pylist()
        return ids, self.nearest(block, 0, most), self.parts(text)

    def segmentation(self, parts: list[str], changed: list[tuple[int, int]], most: int = BEST) -> list[int]:
        """The ids of one of the N best."""
        other = dict(changed)
        return [t for i, p in enumerate(parts) for t in (self.paths(p, most)[other[i]][1] if i in other else self.best_ids(p))]

    def decode(self, ids: list[int]) -> str:
        """The text of ids; a space symbol in the text comes back as a space."""
        raw = self.bytes
        return b"".join([raw[i] for i in ids]).decode("utf-8", "replace").replace(SPACE, " ")[1:]


@lru_cache(maxsize=2)
def lattice(path: str) -> Lattice:
    return Lattice(path)


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


SCHEMA = "ids array<int>, n_tokens long, score double, nbest_scores array<double>, nbest_tokens array<long>, decoded boolean"


def _columns(column: pa.Array, model: Lattice, most: int) -> list[pa.Array]:
    block = model.block(column)
    taken = block.solved.ids.take(pa.array(block.index))
    ids = taken.flatten()
    at = np.append(0, np.cumsum(taken.value_lengths().to_numpy()))[block.rows]
    made, ends = utf8(model.raw.take(ids).view(pa.large_string()))
    sizes = block.solved.ids.value_lengths().to_numpy()
    several, tokens, same = [], [], []

    def longer(part: int, rank: int) -> int:
        return len(model.paths(block.parts[part].as_py(), most)[rank][1]) - int(sizes[part])

    for row in range(len(column)):
        best = model.nearest(block, row, most)
        several.append([s for s, _ in best])
        index = block.index[block.rows[row] : block.rows[row + 1]]
        more = [sum(longer(index[i], rank) for i, rank in changed) for _, changed in best]
        tokens.append([int(at[row + 1] - at[row]) + m for m in more])
        same.append(np.array_equal(made[ends[at[row]] : ends[at[row + 1]]], block.raw[block.at[row] : block.at[row + 1]]))
    return [
        pa.ListArray.from_arrays(pa.array(at, pa.int32()), ids),
        pa.array(np.diff(at), pa.int64()),
        pa.array([s[0] for s in several], pa.float64()),
        pa.array(several, pa.list_(pa.float64())),
        pa.array(tokens, pa.list_(pa.int64())),
        pa.array(same, pa.bool_()),
    ]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    _, at = utf8(batch.column("text"))
    for first, last in chunks(at, BLOCK_BYTES):
        yield batch.slice(first, last - first)


def encoded(docs: DataFrame, path: str | None = None, most: int = BEST) -> DataFrame:
    """``doc_id`` with the ids of the best segmentation and the scores and lengths of the ``most`` best ones.

    ``decoded`` tells whether decoding the ids gives the text back. Null and empty texts have no ids, score 0 and
    one segmentation. Every row gives a row; an empty table an empty result; other columns are left out.
    """
    path = path or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = lattice(path)
        names = ["doc_id", "ids", "n_tokens", "score", "nbest_scores", "nbest_tokens", "decoded"]
        for batch in batches:
            for part in _slices(batch):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *_columns(part.column("text"), model, most)], names=names)
        tidy(model.known, model.several)

    return texts(docs).mapInArrow(run, "doc_id long, " + SCHEMA)


def decoded(ids: DataFrame, path: str | None = None) -> DataFrame:
    """``(doc_id, text)`` of rows with ``doc_id`` and ``ids`` (null: empty)."""
    path = path or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = lattice(path)
        for batch in batches:
            whole = [model.decode(x.as_py() or []) for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(whole, pa.string())], names=["doc_id", "text"])

    return ids.selectExpr("cast(doc_id as long) doc_id", "ids").mapInArrow(run, "doc_id long, text string")
