"""Re-Pair grammars of token-id sequences, and their byte format.

A block holds the ids of whole documents, one after the other. Re-Pair runs in rounds:
every pair of neighbouring symbols is counted, and of the pairs that stand there often
enough the more frequent ones win where occurrences overlap; each pair that still wins
often enough becomes a nonterminal that takes its place. The rounds go on until no pair is
frequent or a round shortens the sequence too little. No rule spans two documents, so a
document is a range of symbols and is decoded without its neighbours; with the expansion
length of each rule, so is any range of ids.

Bytes of a block, all little-endian:

    4 bytes   "RPB1"
    5 x u32   first nonterminal, documents, symbols, rules, rounds
    u32       rules before each round, then all of them        rounds + 1
    u32       left symbols, right symbols, expansion lengths   3 x rules
    u32       symbols before each document, then all of them   documents + 1
    i64       doc_id of each document                          documents
    u8        whether the doc_id is known                      documents
    u16       low halves of the symbols                        symbols
    u16       their high halves, left out where all are 0      symbols or none
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

MAGIC = b"RPB1"
#: A pair becomes a rule where it can be replaced so often in a block.
LEAST_COUNT = 6
#: A round that shortens the sequence by less than this share is the last one.
LEAST_GAIN = 0.02
MAX_ROUNDS = 40
_LEAST_BITS = 12


@dataclass
class Grammar:
    """first: the least nonterminal. Rule i rewrites first + i to left[i], right[i]."""

    first: int
    left: np.ndarray
    right: np.ndarray
    length: np.ndarray
    rounds: np.ndarray
    symbols: np.ndarray
    places: np.ndarray

    def expansion(self, symbols: np.ndarray) -> np.ndarray:
        """How many ids each symbol stands for."""
        out = np.ones(len(symbols), dtype=np.int64)
        rule = symbols >= self.first
        out[rule] = self.length[symbols[rule] - self.first]
        return out

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids of some symbols. Rules of a round use earlier rounds only."""
        for r in range(len(self.rounds) - 2, -1, -1):
            rule = symbols >= self.first + self.rounds[r]
            at = np.flatnonzero(rule)
            if not len(at):
                continue
            which = symbols[at] - self.first
            symbols = np.repeat(symbols, 1 + rule)
            at += np.arange(len(at))
            symbols[at] = self.left[which]
            symbols[at + 1] = self.right[which]
        return symbols

    def document(self, i: int) -> np.ndarray:
        return self.expand(self.symbols[self.places[i] : self.places[i + 1]])

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids `start` to `stop` of the block; only the symbols that cover them expand."""
        ends = np.cumsum(self.expansion(self.symbols))
        stop = min(stop, int(ends[-1]) if len(ends) else 0)
        if start >= stop:
            return np.zeros(0, dtype=np.int64)
        a = int(np.searchsorted(ends, start, side="right"))
        b = int(np.searchsorted(ends, stop, side="left")) + 1
        before = int(ends[a - 1]) if a else 0
        return self.expand(self.symbols[a:b])[start - before : stop - before]


def _pairs(symbols: np.ndarray, at: np.ndarray, seed: int) -> tuple[np.ndarray, ...]:
    """Of pairs at some positions those that own their bucket, each one's bucket, and which
    pair owns a bucket.

    A bucket is owned by one of the pairs that fall into it, so its count is exact; the
    others wait for the next round, which deals pairs to buckets anew.
    """
    keys = ((symbols[:-1] << 32) | symbols[1:])[at]
    spread = (keys.view(np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    bits = max(_LEAST_BITS, len(at).bit_length())
    bucket = (spread >> np.uint64(64 - bits)).view(np.int64)
    owner = np.empty(1 << bits, dtype=np.int64)
    owner[bucket] = keys
    own = np.flatnonzero(owner[bucket] == keys)
    return at[own], bucket[own], owner


def _winners(at: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Which of the pairs at ascending positions win: no two that overlap.

    A pair wins against neighbours of less weight. Of a chain of equal pairs (one
    symbol repeated) every second one wins.
    """
    near = at[1:] - at[:-1] == 1
    wins = np.ones(len(at), dtype=bool)
    same = np.flatnonzero(near & (weight[1:] == weight[:-1])) + 1
    if len(same):
        begins = np.ones(len(same), dtype=bool)
        begins[1:] = same[1:] - same[:-1] > 1
        head = same[begins][np.cumsum(begins) - 1] - 1
        wins[same] = (same - head) % 2 == 0
    wins[1:] &= ~near | (weight[1:] >= weight[:-1])
    wins[:-1] &= ~near | (weight[:-1] >= weight[1:])
    return wins


def re_pair(
    ids: np.ndarray,
    counts: np.ndarray,
    least_count: int = LEAST_COUNT,
    least_gain: float = LEAST_GAIN,
) -> Grammar:
    """The grammar of a block: ids of all documents, and how many each document has."""
    symbols = ids.astype(np.int64)
    first = int(symbols.max(initial=0)) + 1
    places = np.concatenate([[0], np.cumsum(counts)])
    ends = np.zeros(len(symbols), dtype=bool)
    ends[places[1:][counts > 0] - 1] = True
    left, right, length, rounds = [], [], [], [0]
    lengths = np.zeros(0, dtype=np.int64)
    # where a pair may still be frequent: not behind a document's last symbol
    alive = ~ends
    while len(rounds) <= MAX_ROUNDS:
        at, bucket, owner = _pairs(symbols, np.flatnonzero(alive), len(rounds))
        count = np.bincount(bucket, minlength=len(owner))[bucket]
        # a rare pair stays so, as rounds only take occurrences away
        alive[at[count < least_count]] = False
        often = np.flatnonzero(count >= least_count)
        at, bucket = at[often], bucket[often]
        # the more frequent pair wins; a bucket's number decides between equal counts
        wins = np.flatnonzero(_winners(at, count[often] * len(owner) + bucket))
        at, bucket = at[wins], bucket[wins]
        won = np.bincount(bucket, minlength=len(owner))
        keep = np.flatnonzero(won[bucket] >= least_count)
        at, bucket = at[keep], bucket[keep]
        if not len(at) or len(at) < least_gain * len(symbols):
            break
        rules = np.flatnonzero(won >= least_count)
        new = np.empty(len(owner), dtype=np.int64)
        new[rules] = first + rounds[-1] + np.arange(len(rules))
        made = owner[rules]
        a, b = made >> 32, made & 0xFFFFFFFF
        sizes = [
            np.where(s < first, 1, lengths[np.maximum(s - first, 0)] if len(lengths) else 1)
            for s in (a, b)
        ]
        left.append(a)
        right.append(b)
        length.append(sizes[0] + sizes[1])
        lengths = np.concatenate([lengths, length[-1]])
        rounds.append(rounds[-1] + len(made))
        symbols[at] = new[bucket]
        ends[at] = ends[at + 1]
        stays = np.ones(len(symbols), dtype=bool)
        stays[at + 1] = False
        # the pairs on both sides of a new symbol are new ones
        alive[at] = True
        alive[np.maximum(at - 1, 0)] = True
        stays = np.flatnonzero(stays)
        symbols, ends, alive = symbols[stays], ends[stays], alive[stays]
        alive &= ~ends
    done = np.concatenate([[0], np.flatnonzero(ends) + 1])
    places = done[np.concatenate([[0], np.cumsum(counts > 0)])]
    join = lambda parts: np.concatenate([np.zeros(0, dtype=np.int64), *parts])
    return Grammar(
        first, join(left), join(right), join(length), np.array(rounds), symbols, places
    )


def to_bytes(grammar: Grammar, doc_ids: np.ndarray, known: np.ndarray) -> bytes:
    head = [
        grammar.first, len(doc_ids), len(grammar.symbols), len(grammar.left), len(grammar.rounds) - 1
    ]
    parts = [MAGIC]
    for values in (
        head, grammar.rounds, grammar.left, grammar.right, grammar.length, grammar.places
    ):
        parts.append(np.asarray(values).astype("<u4").tobytes())
    parts.append(doc_ids.astype("<i8").tobytes())
    parts.append(known.astype("u1").tobytes())
    parts.append((grammar.symbols & 0xFFFF).astype("<u2").tobytes())
    high = grammar.symbols >> 16
    if high.any():
        parts.append(high.astype("<u2").tobytes())
    return b"".join(parts)


def from_bytes(data: bytes) -> tuple[Grammar, np.ndarray, np.ndarray]:
    """The grammar of a block, its doc_ids, and which of them are known."""
    if data[:4] != MAGIC:
        raise ValueError("not a block of token ids")
    at = 4

    def take(n: int, kind: str) -> np.ndarray:
        nonlocal at
        values = np.frombuffer(data, dtype=kind, count=n, offset=at)
        at += values.nbytes
        return values.astype(np.int64)

    first, n_docs, n_symbols, n_rules, n_rounds = take(5, "<u4").tolist()
    rounds = take(n_rounds + 1, "<u4")
    left, right, length = (take(n_rules, "<u4") for _ in range(3))
    places = take(n_docs + 1, "<u4")
    doc_ids, known = take(n_docs, "<i8"), take(n_docs, "u1") > 0
    symbols = take(n_symbols, "<u2")
    if at < len(data):
        symbols |= take(n_symbols, "<u2") << 16
    return Grammar(first, left, right, length, rounds, symbols, places), doc_ids, known
