"""Greedy word-piece counts by a linear longest-match automaton; no piece is ever built."""

from __future__ import annotations

import base64
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import map_arrow, remembers, working

ROOT, SUFFIX_ROOT = 0, 1


class Automaton:
    """A trie of word-initial and of later pieces with failure links.

    ``pops[v]`` is how many pieces are complete when the text leaves node ``v`` by its failure link, and
    ``fail[v]`` where matching goes on, -1 for nowhere. Both are set breadth first when the trie is built,
    so a word costs one step per byte plus one per popped piece.
    """

    def __init__(self, initial: list[bytes], later: list[bytes]):
        self.step: dict[int, int] = {}  # node << 8 | byte -> node
        self.fail, self.pops = [-1, -1], [0, 0]
        ends, children = set(), [[], []]
        for root, pieces in ((ROOT, initial), (SUFFIX_ROOT, later)):
            for piece in pieces:
                node = root
                for byte in piece:
                    key = node << 8 | byte
                    if key not in self.step:
                        self.step[key] = len(self.fail)
                        children[node].append((byte, len(self.fail)))
                        self.fail.append(-1), self.pops.append(0), children.append([])
                    node = self.step[key]
                if node > SUFFIX_ROOT:
                    ends.add(node)
        level = [ROOT, SUFFIX_ROOT]
        while level:
            below = []
            for parent in level:
                for byte, node in children[parent]:
                    below.append(node)
                    if node in ends:
                        self.fail[node], self.pops[node] = SUFFIX_ROOT, 1
                        continue
                    at, popped = self.fail[parent], self.pops[parent]
                    while at >= 0 and at << 8 | byte not in self.step:
                        popped += self.pops[at]
                        at = self.fail[at]
                    if at >= 0:
                        self.fail[node], self.pops[node] = self.step[at << 8 | byte], popped
            level = below

    def count(self, word: bytes) -> int:
        """Pieces of a word by greedy longest match; -1 when a part of it has no piece."""
        step, fail, pops = self.step.get, self.fail, self.pops
        node = pieces = 0
        for byte in word:
            to = step(node << 8 | byte)
            while to is None:
                at = fail[node]
                if at < 0:
                    return -1
                pieces += pops[node]
                node = at
                to = step(node << 8 | byte)
            node = to
        while node > SUFFIX_ROOT:
            at = fail[node]
            if at < 0:
                return -1
            pieces += pops[node]
            node = at
        return pieces


@lru_cache(2)
def rank_file_automaton(path: str) -> Automaton:
    """The tokens of a rank file as pieces: those that begin with a blank begin a word, the blank being
    understood; every token without a blank may follow, and single bytes may also begin a word."""
    with open(path, "rb") as lines:
        tokens = [base64.b64decode(line.split()[0]) for line in lines if line.strip()]
    later = [t for t in tokens if b" " not in t]
    initial = {t[1:] for t in tokens if len(t) > 1 and t[:1] == b" "} | {t for t in later if len(t) == 1}
    return Automaton(sorted(initial), later)


def count_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_tokens, n_unknown.

    Words stand between the characters ``[\\x20\\x09-\\x0D]``. n_tokens is the sum of their greedy
    word-piece lengths over the vocabulary in ``path``; a word that no pieces cover is one token and counts
    in n_unknown (with every single byte in the vocabulary there is none). Null and empty texts have no
    words; overlong words cost their length; rows that repeat and null ids stay; an empty table gives none;
    other columns are not read.
    """

    def run(batches):
        working("word_pieces")
        automaton = rank_file_automaton(path)
        known = _known.setdefault(path, {})
        for batch in batches:
            texts = [(t or "").encode("utf-8", "replace").split() for t in batch.column("text").to_pylist()]
            if len(known) > 400_000:
                known.clear()
            n_tokens, n_unknown = [], []
            for words in texts:
                long = 0
                for word in set(words):
                    if word not in known:
                        known[word] = automaton.count(word)
                        long += len(word) > 64
                lengths = list(map(known.__getitem__, words))
                missing = lengths.count(-1)
                n_tokens.append(sum(lengths) + 2 * missing)
                n_unknown.append(missing)
                if long:
                    for word in [w for w in set(words) if len(w) > 64]:
                        del known[word]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in ([len(w) for w in texts], n_tokens, n_unknown))],
                ["doc_id", "n_words", "n_tokens", "n_unknown"],
            )

    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()
    return map_arrow(picked, run, f"doc_id {kind}, n_words long, n_tokens long, n_unknown long")


_known: dict[str, dict[bytes, int]] = {}


def _forget() -> None:
    _known.clear()
    rank_file_automaton.cache_clear()


remembers("word_pieces", _forget)
