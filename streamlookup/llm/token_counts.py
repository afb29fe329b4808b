"""Token counts of a sentencepiece BPE model by rank-synchronous array merging.

Distinct pre-tokens are held as one ragged numpy array of symbols. In each step
every sequence applies its lowest-rank pair, all sequences at once, and those
with no pair left leave the array; what counts is the symbols that survive.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from sentencepiece import SentencePieceProcessor

from streamlookup.llm.batches import map_slices

LIMIT = 4096

# Pre-tokens whose counts a worker remembers, and the longest one it remembers.
CACHED_PRETOKENS = 500_000
CACHED_LENGTH = 48

SPACE = "▁"  # how the model writes a blank

# Symbols merged in one array; a longer batch of pre-tokens is cut into several.
ARRAY_SYMBOLS = 1 << 20

_NONE = np.iinfo(np.int32).max


class PieceModel:
    """A sentencepiece BPE model with byte fallback, as arrays.

    A symbol is a piece or a single character of one. ``cost`` is how many tokens
    a symbol is at the end: 1, or its bytes in UTF-8 if it is no piece. Pairs of
    symbols that make a piece have the rank of its score.
    """

    def __init__(self, path: str):
        self.processor = processor = SentencePieceProcessor(model_file=path)
        ids = range(processor.get_piece_size())
        if not any(map(processor.is_byte, ids)) or any(map(processor.is_unused, ids)):
            raise ValueError("only models with byte fallback and without unused pieces are supported")
        special = (processor.is_byte, processor.is_control, processor.is_unknown)
        scores = {processor.id_to_piece(i): processor.get_score(i) for i in ids if not any(f(i) for f in special)}
        # No piece crosses these cuts, so no merge does.
        if any(re.search(f"[^{SPACE}]{SPACE}", p) or ("\n" in p and p != "\n") for p in scores):
            raise ValueError("a piece of the model spans a cut between pre-tokens")
        self.cut = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")

        symbols = {p: i for i, p in enumerate(dict.fromkeys(chain(scores, chain.from_iterable(scores))))}
        # The last four symbols are any other character of one to four bytes.
        self.n = len(symbols) + 4
        self.cost = np.array([1 if p in scores else len(p.encode()) for p in symbols] + [1, 2, 3, 4], np.int64)
        points = np.arange(0x110000)
        self.symbol_of = len(symbols) + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        for p, i in symbols.items():
            if len(p) == 1:
                self.symbol_of[ord(p)] = i

        ranks = {score: rank for rank, score in enumerate(sorted(set(scores.values()), reverse=True))}
        pairs = {
            symbols[p[:i]] * self.n + symbols[p[i:]]: (ranks[score], symbols[p])
            for p, score in scores.items()
            for i in range(1, len(p))
            if p[:i] in symbols and p[i:] in symbols
        }
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k][0] for k in self.keys.tolist()] + [_NONE], np.int32)
        self.merged = np.array([pairs[k][1] for k in self.keys.tolist()] + [0], np.int64)
        self.counts: dict[str, int] = {}

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Indices of the pairs in ``ranks``; the last one for what is no pair."""
        key = left * self.n + right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, at, len(self.keys))

    def merge(self, texts: list[str]) -> np.ndarray:
        """How many tokens each non-empty, normalised pre-token is."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        total = np.zeros(len(texts), np.int64)
        symbol = self.symbol_of[np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")]
        owner = np.repeat(np.arange(len(texts)), lengths)

        def pairs(at: np.ndarray) -> np.ndarray:
            """For symbols ``at`` places, their pair with the next one of the same sequence."""
            after = np.minimum(at + 1, len(symbol) - 1)
            found = self._look_up(symbol[at], symbol[after])
            return np.where((after != at) & (owner[at] == owner[after]), found, len(self.keys))

        pair = pairs(np.arange(len(symbol)))
        while len(symbol):
            rank = self.ranks[pair]
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            size = np.diff(np.r_[first, len(symbol)])
            least = np.repeat(np.minimum.reduceat(rank, first), size)
            if (done := least == _NONE).any():
                np.add.at(total, owner[done], self.cost[symbol[done]])
                symbol, owner, pair, rank, least = (a[~done] for a in (symbol, owner, pair, rank, least))
                if not len(symbol):
                    break
            hits = self._apart(np.flatnonzero(rank == least))
            hits = self._in_turn(hits, symbol, owner, pair, least)
            symbol[hits] = self.merged[pair[hits]]
            stays = np.ones(len(symbol), bool)
            stays[hits + 1] = False
            place = np.cumsum(stays) - 1
            symbol, owner, pair = symbol[stays], owner[stays], pair[stays]
            changed = place[hits]
            changed = np.unique(np.r_[changed, np.maximum(changed - 1, 0)])
            pair[changed] = pairs(changed)
        return total

    @staticmethod
    def _apart(hits: np.ndarray) -> np.ndarray:
        """Of hits that overlap, every second one, from the left."""
        turn = np.arange(len(hits))
        start = np.r_[True, np.diff(hits) != 1]
        return hits[(turn - np.maximum.accumulate(np.where(start, turn, 0))) % 2 == 0]

    def _in_turn(self, hits, symbol, owner, pair, least) -> np.ndarray:
        """The hits that may be applied at once. Where one of several merges in a
        sequence makes a pair of no higher rank, that pair would come before the
        later merges, so only the first is applied."""
        who = owner[hits]
        same = np.r_[False, who[1:] == who[:-1]]
        several = same | np.r_[same[1:], False]
        if not several.any():
            return hits
        at = hits[several]
        made = self.merged[pair[at]]
        left = np.where(np.isin(at - 2, hits), self.merged[pair[at - 2]], symbol[at - 1])
        left_rank = np.where((at > 0) & (owner[at - 1] == owner[at]), self.ranks[self._look_up(left, made)], _NONE)
        after = np.minimum(at + 2, len(symbol) - 1)
        right = self.ranks[self._look_up(made, symbol[after])]
        right_rank = np.where((at + 2 < len(symbol)) & (owner[after] == owner[at]), right, _NONE)
        unsafe = np.unique(owner[at[np.minimum(left_rank, right_rank) <= least[at]]])
        return hits[~(same & np.isin(who, unsafe))]

    def _learn(self, pretokens: set[str]) -> None:
        waiting, symbols = [], 0
        for pretoken in pretokens:
            waiting.append(pretoken)
            symbols += len(pretoken)
            if symbols >= ARRAY_SYMBOLS:
                self.counts.update(zip(waiting, self.merge(waiting).tolist()))
                waiting, symbols = [], 0
        if waiting:
            self.counts.update(zip(waiting, self.merge(waiting).tolist()))

    def count(self, texts: list[str | None]) -> list[int]:
        """Tokens of each whole text; 0 for a NULL or empty one."""
        split = [self.cut.findall(self.processor.normalize(text)) if text else [] for text in texts]
        wanted = set(chain.from_iterable(split))
        if len(self.counts) + len(wanted) > CACHED_PRETOKENS:
            self.counts = {}
        unknown = wanted.difference(self.counts)
        self._learn(unknown)
        found = [sum(map(self.counts.__getitem__, pretokens)) for pretokens in split]
        for pretoken in unknown:
            if len(pretoken) > CACHED_LENGTH:
                del self.counts[pretoken]
        return found


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    """The worker's model; what it remembers serves all tasks of the worker."""
    return PieceModel(path)


def count_tokens(docs: DataFrame, model: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit``
    tokens) of every whole text, as the sentencepiece library counts them.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read. A NULL or empty
    text has 0 bytes and tokens. There is a row per row of ``docs``, repeated or not,
    and none for an empty table. Nothing is shuffled.
    """

    def count(doc_ids: list, texts: list) -> dict:
        tokens = piece_model(model).count(texts)
        return {
            "doc_id": doc_ids,
            "n_bytes": [len((text or "").encode()) for text in texts],
            "n_tokens": tokens,
            "over_limit": [n > limit for n in tokens],
        }

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    return map_slices(docs.select("doc_id", "text"), count, schema)
