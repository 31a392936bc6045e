"""SentencePiece encoding with the N best segmentations, and decoding.

The lattice of a text has an edge for every piece of the vocabulary found in it, weighted by the
piece's score; a character that is no piece itself has one edge of its byte pieces at a penalty.  A forward
Viterbi pass gives the best score of every prefix.  The search for the N best runs backwards from
the end: the Viterbi score of the prefix still open is an exact heuristic, so paths leave the
queue in the order of their total score.

Where no piece of the vocabulary holds a space mark behind another character, no piece crosses such a
place, and a text's lattice is a chain of its words' lattices.  Each distinct word then has one forward Viterbi pass that
keeps its best segmentation and the loss of its second-best; the N best of a text differ from its best in at most N - 1
words, those whose second-best loses least, and the backward search runs on these alone.
"""

from __future__ import annotations

import heapq
import re
import zlib
from array import array

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, only_cache

SPACE = "▁"
#: A character that is no piece scores this much less than the lowest that is one.
UNKNOWN_PENALTY = 10.0
#: Words whose lattices a task remembers.
WORD_CACHE = 1 << 20


class _Words(dict):
    """Numbers of words; a new one gets the next and is learned."""

    def __init__(self, learn):
        self.learn = learn

    def __missing__(self, word: str) -> int:
        self[word] = k = len(self)
        self.learn(word)
        return k


class Vocabulary:
    """Pieces and scores of a SentencePiece model file, and the lattices of texts over them."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(len(self.pieces)) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.special = {i for i in range(len(self.pieces)) if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)}
        self.automaton = ahocorasick.Automaton()
        self.shown = np.array([bytes([self.byte_of[i]]) if i in self.byte_of else b"" if i in self.special
                               else p.replace(SPACE, " ").encode() for i, p in enumerate(self.pieces)], object)
        self.dummy = sp.normalize("a") == SPACE + "a"
        self.single, scores = set(), []
        for i, piece in enumerate(self.pieces):
            if i in self.special or i in self.byte_of:
                continue
            self.automaton.add_word(piece, (len(piece), i, sp.get_score(i)))
            if len(piece) == 1:
                self.single.add(piece)
                scores.append(sp.get_score(i))
        self.automaton.make_automaton()
        self.unknown_score = min(scores, default=0.0) - UNKNOWN_PENALTY
        plain = [p for i, p in enumerate(self.pieces) if i not in self.special and i not in self.byte_of]
        breaks = "".join(c for c in "\n\r\t" if not any(c in p for p in plain))
        crossed = any(SPACE in p.lstrip(SPACE) for p in plain)
        word = f"{SPACE}*[^{SPACE}{breaks}]+|{SPACE}+" + (f"|[{breaks}]" if breaks else "")
        self.words = re.compile("(?s).+" if crossed else word)
        self._forget()

    def _forget(self) -> None:
        self.at = _Words(self.learn)
        self.ids, self.ends, self.best, self.loss = array("i"), array("q", [0]), array("d"), array("d")

    def edges(self, word: str) -> list[tuple[int, int, tuple[int, ...], float]]:
        """(start, end, ids, score) of the lattice, by end and then the longest first."""
        found = [(e + 1 - n, e + 1, (i,), s) for e, (n, i, s) in self.automaton.iter(word)]
        unknown = [(k, k + 1, self._fallback(c), self.unknown_score) for k, c in enumerate(word) if c not in self.single]
        return sorted(found + unknown, key=lambda x: (x[1], x[0])) if unknown else found

    def _fallback(self, c: str) -> tuple[int, ...]:
        if not self.bytes:
            return (self.model.unk_id(),)
        return tuple(self.bytes[b] for b in c.encode("utf-8", "surrogatepass"))

    @staticmethod
    def forward(n: int, edges) -> tuple[list[float], list]:
        """Best score of every prefix, and the edge that ends it."""
        score, last = [0.0] + [-np.inf] * n, [None] * (n + 1)
        for e in edges:
            s = score[e[0]] + e[3]
            if s > score[e[1]]:
                score[e[1]], last[e[1]] = s, e
        return score, last

    def learn(self, word: str) -> None:
        """Remember a word's best segmentation, and by how much the second-best is worse (infinite without one)."""
        n = len(word)
        best, second = [0.0] + [-np.inf] * n, [-np.inf] * (n + 1)
        last: list[tuple] = [()] * (n + 1)
        if self.single.issuperset(word):
            found = ((e + 1 - k, e + 1, i, s) for e, (k, i, s) in self.automaton.iter(word))
        else:
            found = self.edges(word)
        for start, end, ids, s in found:
            x = best[start] + s
            if x > best[end]:
                y = second[start] + s
                second[end] = best[end] if best[end] > y else y
                best[end], last[end] = x, (start, ids)
            elif x > second[end]:
                second[end] = x
        path, at = [], n
        while at:
            at, ids = last[at]
            path.append(ids)
        for ids in reversed(path):
            self.ids.append(ids) if isinstance(ids, int) else self.ids.extend(ids)
        self.ends.append(len(self.ids))
        self.best.append(best[n])
        self.loss.append(best[n] - second[n])

    def n_best(self, word: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The ``n`` best (score, ids) of a word, best first: backward A* over its lattice."""
        edges = self.edges(word)
        score, _ = self.forward(len(word), edges)
        ending: list[list] = [[] for _ in range(len(word) + 1)]
        for e in edges:
            ending[e[1]].append(e)
        queue, made, out = [(-score[len(word)], 0, len(word), 0.0, ())], 1, []
        while queue and len(out) < n:
            _, _, at, tail, ids = heapq.heappop(queue)
            if at == 0:
                out.append((tail, ids))
                continue
            for e in ending[at]:
                if score[e[0]] > -np.inf:
                    g = tail + e[3]
                    heapq.heappush(queue, (-(score[e[0]] + g), made, e[0], g, e[2] + ids))
                    made += 1
        return out

    def encode(self, text: str, n: int) -> list[tuple[float, np.ndarray]]:
        """The ``n`` best (score, ids) of a text, best first; an empty text has one, without pieces."""
        if len(self.at) > WORD_CACHE:
            self._forget()
        words = self.words.findall(self.model.normalize(text))
        if not words:
            return [(0.0, np.zeros(0, np.int32))]
        k = np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))
        ends, best, loss = np.frombuffer(self.ends, np.int64), np.frombuffer(self.best), np.frombuffer(self.loss)
        first, size = ends[k], ends[k + 1] - ends[k]
        place = np.cumsum(size) - size
        ids = np.frombuffer(self.ids, np.int32)[np.repeat(first - place, size) + np.arange(size.sum())]
        out = [(float(best[k].sum()), ids)]
        if n == 1:
            return out
        losses = loss[k]
        near = np.argsort(losses, kind="stable")[:n - 1] if len(words) < 64 else self._least(losses, n - 1)
        choices = []
        for j in near.tolist():
            if losses[j] < np.inf:
                own = tuple(ids[place[j]:place[j] + size[j]].tolist())
                ways = self.n_best(words[j], n)
                ways.remove(next((x for x in ways if x[1] == own), ways[0]))
                choices.append((j, [(max(0.0, best[k[j]] - s), w) for s, w in ways]))
        del ends, best, loss  # arrays that lend their memory can't grow
        for cost, changed in self._cheapest(choices, n - 1):
            parts, at = [], 0
            for j, way in sorted(changed):
                parts += [ids[at:place[j]], np.array(way, np.int32)]
                at = place[j] + size[j]
            out.append((out[0][0] - cost, np.concatenate([*parts, ids[at:]])))
        return out

    @staticmethod
    def _least(losses: np.ndarray, n: int) -> np.ndarray:
        bound = np.partition(losses, n - 1)[n - 1]
        near = np.flatnonzero(losses <= bound)
        return near[np.argsort(losses[near], kind="stable")[:n]]

    @staticmethod
    def _cheapest(choices, n: int):
        """The ``n`` cheapest ways to change one or more words: (cost, [(word, ids)])."""
        # A state has changed words up to index i, the last of them to its way w; what comes after is unchanged and
        # costs nothing, so costs leave the queue in order.
        queue, made, out = [], 0, []

        def push(cost, i, w, before):
            nonlocal made
            if i < len(choices) and w < len(choices[i][1]):
                heapq.heappush(queue, (cost + choices[i][1][w][0], made, i, w, cost, before))
                made += 1

        for i in range(len(choices)):
            push(0.0, i, 0, ())
        while queue and len(out) < n:
            cost, _, i, w, base, before = heapq.heappop(queue)
            changed = (*before, (choices[i][0], choices[i][1][w][1]))
            out.append((cost, changed))
            push(base, i, w + 1, before)
            for j in range(i + 1, len(choices)):
                push(cost, j, 0, changed)
        return out

    def decode(self, ids) -> str:
        """The text of ids: space marks become spaces, byte pieces UTF-8, and the leading dummy space goes."""
        text = b"".join(self.shown[np.asarray(ids, np.int64)]).decode("utf-8", "replace")
        return text[1:] if self.dummy and text.startswith(" ") else text


_VOCABULARIES: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The task's vocabulary of a file."""
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary(path)
    only_cache(("pieces", path), _VOCABULARIES[path]._forget)
    return _VOCABULARIES[path]


def encode(docs: DataFrame, path: str, n: int = 4, with_ids: bool = True,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ``n`` best segmentations of every row's whole text, a row each.

    Columns: doc_id, rank (from 1), score, n_pieces, ids_crc32 (little-endian unsigned 32-bit ids), round_trip
    (whether the ids decode to the text), and ids where ``with_ids``.  Null texts are empty; an empty text has one
    segmentation without pieces, a text with fewer than ``n`` has them all.  Ties are in search order, the same
    in every run.  Repeated rows stay repeated, other columns are ignored, no rows give none.
    """
    names = ["doc_id", "rank", "score", "n_pieces", "ids_crc32", "round_trip"] + ["ids"] * with_ids

    def run(batch):
        v, out = vocabulary(path), {k: [] for k in names}
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            text = text or ""
            for rank, (score, ids) in enumerate(v.encode(text, n), 1):
                row = (doc, rank, score, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), v.decode(ids) == text, ids)
                for k, x in zip(names, row):
                    out[k].append(x)
        yield out

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(rows, run, "doc_id long, rank int, score double, n_pieces long, ids_crc32 long, round_trip boolean"
                     + (", ids array<int>" if with_ids else ""))


def decode(rows: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """The rows' ids (array of int) as ``text``, beside ``doc_id`` and ``rank``; null ids give a null text."""
    def run(batch):
        v = vocabulary(path)
        yield {"doc_id": batch.column("doc_id"), "rank": batch.column("rank"),
               "text": [None if ids is None else v.decode(ids) for ids in batch.column("ids").to_pylist()]}

    return map_arrow(rows.select("doc_id", "rank", F.col(ids_col).alias("ids")), run, "doc_id long, rank int, text string")
