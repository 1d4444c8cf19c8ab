"""Periodic runs of words, found on a grammar of each text.

A run is a stretch of consecutive words with a smallest period q (words q apart are equal), at
least ``max(shortest, 3 q)`` words long, that no neighbour extends with that period.

Re-Pair turns the word ids of a text into a grammar: pairs of neighbouring symbols that occur
twice or more become a nonterminal, frequent ones first. Many texts are worked on at once; in a
round every pair is replaced where it is more frequent than the pairs it overlaps (ties are
broken by a fixed scramble), which is what replacing one pair after another does where pairs
do not touch. The rounds end when no pair of a text occurs twice. What is left of a text, the
root, is cut into a balanced tree, so that every node has one boundary between two parts.

The lowest node that holds a run holds it across its boundary. So the runs inside a node that
reach its boundary are computed once for each nonterminal, at its first place, and taken to all
the places where the derivation has it. Cut by the ends of a node, a run may come out too short; the
node above then has the whole, and of intervals with one period those inside another are dropped.

At a boundary a run reaches at least ``q + max(4, (q + 1) // 2)`` words to one side, so that many
words next to the boundary equal those q away. This is looked up in prefix hashes for every q of a
node at once; a hash can only let a wrong q through. What passes is extended word by word, exactly.

Texts are independent of each other, so there is no shuffle; a task holds a chunk of texts, or one
longer text. Null and empty texts have no words and no runs. Repeated rows are worked on one by
one, a null id stays null, an empty table gives an empty result, extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from panelloom.llm.common import arrow_rows, column, per_chunk, texts
from panelloom.llm.words import coded, joined, split

SHORTEST = 24
REPEATS = 3  # a run holds its period this often
PROBE = 4
TEXT_BYTES = 2 << 20
PAIRS_AT_ONCE = 4 << 20
ODD = 0x9E3779B97F4A7C15


@dataclass
class Grammar:
    """Rules of many texts. Symbols below ``words`` are words of one text; symbol ``words + k`` is rule k."""

    words: int
    left: np.ndarray
    right: np.ndarray
    size: np.ndarray  # words that each symbol stands for
    root: np.ndarray  # symbols left, text after text
    begin: np.ndarray  # each one's first word
    text: np.ndarray  # and its text


def _scramble(x: np.ndarray) -> np.ndarray:
    return (x.astype(np.uint64) * np.uint64(ODD)) >> np.uint64(40)


def _repeated(key: np.ndarray) -> np.ndarray:
    """Whether a key may occur twice: false only where it cannot."""
    cell = ((key.astype(np.uint64) * np.uint64(ODD)) >> np.uint64(43)).astype(np.int64)
    return np.bincount(cell, minlength=1 << 21)[cell] > 1


def re_pair(codes: np.ndarray, first: np.ndarray) -> Grammar:
    """The grammar of each text; ``first`` is its first word among ``codes``, with one entry more than texts."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    # The same word of two texts is two symbols, so that no rule spans texts.
    names, sym = np.unique(text << 32 | codes, return_inverse=True)
    words = len(names)
    begin = np.arange(len(sym))
    lefts, rights, sizes = [], [], [np.ones(words, dtype=np.int64)]
    made, done = words, []
    while len(sym):
        at = np.flatnonzero(text[1:] == text[:-1])
        key = sym[at] << 31 | sym[at + 1]
        some = _repeated(key)
        at, key = at[some], key[some]
        # Of touching occurrences of one pair (a a a) every second counts, from the left.
        chained = np.zeros(len(at), dtype=bool)
        chained[1:] = (at[1:] == at[:-1] + 1) & (key[1:] == key[:-1])
        heads = np.flatnonzero(~chained)
        place = np.arange(len(at)) - np.repeat(heads, np.diff(np.append(heads, len(at))))
        at, key = at[place % 2 == 0], key[place % 2 == 0]
        kinds, which, times = np.unique(key, return_inverse=True, return_counts=True)
        often = times[which] > 1
        at, which = at[often], which[often]
        rank = np.zeros(len(sym) + 1, dtype=np.uint64)  # of the pair that begins at a symbol
        rank[at] = np.minimum(times[which], (1 << 38) - 1).astype(np.uint64) << np.uint64(24) | _scramble(which)
        before, after = rank[at - 1], rank[at + 1]
        before[at == 0] = 0
        # Equal ranks of different pairs are left for a later round but for the pair that comes first.
        wins = (rank[at] >= before) & (rank[at] > after)
        at, which = at[wins], which[wins]
        clash = np.zeros(len(at), dtype=bool)
        clash[1:] = at[1:] == at[:-1] + 1
        at, which = at[~clash], which[~clash]
        chosen = np.bincount(which, minlength=len(kinds))
        stay = chosen[which] > 1
        at, which = at[stay], which[stay]
        if not len(at):
            rest = np.flatnonzero(often)
            if not len(rest):
                done.append((sym, begin, text))
                break
            # Every pair was beaten in all places but one: take the foremost of the most frequent pairs alone.
            at, which = _foremost(rank, sym)
            kinds = np.array([sym[at[0]] << 31 | sym[at[0] + 1]])
            chosen = np.array([len(at)])
        used = np.flatnonzero(chosen > 1)
        number = np.zeros(len(chosen), dtype=np.int64)
        number[used] = made + np.arange(len(used))
        lefts.append(kinds[used] >> 31)
        rights.append(kinds[used] & ((1 << 31) - 1))
        known = np.concatenate(sizes)
        sizes = [known, known[lefts[-1]] + known[rights[-1]]]
        made += len(used)
        sym = sym.copy()
        sym[at] = number[which]
        keep = np.ones(len(sym), dtype=bool)
        keep[at + 1] = False
        # A text in which nothing was replaced may still have pairs that lost everywhere; it goes on if it has any.
        active = np.zeros(len(first), dtype=bool)
        active[text[at]] = True
        active[text[np.flatnonzero(rank[:-1])]] = True
        goes = active[text]
        over = keep & ~goes
        if over.any():
            done.append((sym[over], begin[over], text[over]))
        sym, begin, text = sym[keep & goes], begin[keep & goes], text[keep & goes]
    root, begin, text = (np.concatenate(x) for x in zip(*done, strict=True)) if done else (np.zeros(0, dtype=np.int64),) * 3
    order = np.argsort(begin, kind="stable")
    none = [np.zeros(0, dtype=np.int64)]
    return Grammar(words, np.concatenate(lefts or none), np.concatenate(rights or none), np.concatenate(sizes), root[order], begin[order], text[order])


def _foremost(rank: np.ndarray, sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places, not touching, of the pair with the highest rank."""
    best = int(rank[:-1].argmax())
    at = np.flatnonzero((sym[:-1] == sym[best]) & (sym[1:] == sym[best + 1]))
    out, last = [], -2
    for i in at.tolist():
        if i > last + 1:
            out.append(i)
            last = i
    return np.array(out), np.zeros(len(out), dtype=np.int64)


def _nodes(g: Grammar, ends: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Boundary, begin and end of every node that may hold a run; rules first, with their places.

    Returns ``boundary, low, high, rule`` (-1 for nodes of a root) and ``places_rule, places_begin``.
    """
    big = g.size[g.root] >= least
    sym, at = g.root[big], g.begin[big]
    rules, begins = [], []
    while True:
        inner = sym >= g.words
        sym, at = sym[inner], at[inner]
        if not len(sym):
            break
        rules.append(sym - g.words)
        begins.append(at)
        left, right = g.left[sym - g.words], g.right[sym - g.words]
        sym, at = np.concatenate([left, right]), np.concatenate([at, at + g.size[left]])
        sym, at = sym[g.size[sym] >= least], at[g.size[sym] >= least]
    none = np.zeros(0, dtype=np.int64)
    places_rule, places_begin = np.concatenate([none, *rules]), np.concatenate([none, *begins])
    rule, one = np.unique(places_rule, return_index=True)
    low = places_begin[one]
    boundary, high = low + g.size[g.left[rule]], low + g.size[rule + g.words]

    # The root's k symbols: the boundary before symbol m has the span of the largest power of two that divides m.
    head = np.flatnonzero(np.r_[True, g.text[1:] != g.text[:-1]]) if len(g.text) else none
    counts = np.diff(np.append(head, len(g.text)))
    base = np.repeat(head, counts)
    m = np.arange(len(g.text)) - base
    total = np.repeat(counts, counts)
    mid = np.flatnonzero(m)
    reach = m[mid] & -m[mid]
    until = m[mid] + reach
    first = g.begin[base[mid] + m[mid] - reach]
    last = np.where(until < total[mid], g.begin[np.minimum(base[mid] + until, len(g.text) - 1)], ends[g.text[mid]])
    wide = last - first >= least
    boundary = np.concatenate([boundary, g.begin[mid[wide]]])
    low, high = np.concatenate([low, first[wide]]), np.concatenate([high, last[wide]])
    rule = np.concatenate([rule, np.full(int(wide.sum()), -1)])
    return boundary, low, high, rule, places_rule, places_begin


def _power(n: int) -> np.ndarray:
    return np.cumprod(np.append(np.uint64(1), np.full(n, ODD, dtype=np.uint64)))


def _candidates(x: np.ndarray, boundary: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``node, period, from``: words from ``from`` on equal those ``period`` later, as far as a run needs it."""
    power = _power(len(x))
    sums = np.append(np.uint64(0), np.cumsum(x * power[:-1]))
    gram = np.zeros(len(x) + PROBE, dtype=np.uint64)
    for k in range(PROBE):
        gram[: len(x) - k] += x[k:] * power[k]
    longest = (high - low) // REPEATS
    for right in (True, False):
        room = np.minimum(longest, (high - boundary if right else boundary - low) - PROBE)
        node = np.flatnonzero(room > 0)
        upto = np.cumsum(room[node])
        start = 0
        while start < len(node):
            stop = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + PAIRS_AT_ONCE)))
            some, sizes = node[start:stop], room[node[start:stop]]
            period = np.arange(1, sizes.sum() + 1) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            whose = np.repeat(some, sizes)
            near = boundary[whose] - (0 if right else PROBE)
            hit = gram[near] == gram[near + period if right else near - period]
            period, whose = period[hit], whose[hit]
            length = np.maximum(PROBE, (period + 1) // 2)
            at = boundary[whose] if right else boundary[whose] - period - length
            fits = (at + period + length <= high[whose]) & (at >= low[whose])
            period, whose, length, at = period[fits], whose[fits], length[fits], at[fits]
            same = (sums[at + length] - sums[at]) * power[period] == sums[at + period + length] - sums[at + period]
            yield whose[same], period[same], at[same]
            start = stop


def _extent(x: np.ndarray, at: int, period: int, low: int, high: int) -> tuple[int, int]:
    """The stretch around ``at`` inside ``[low, high)`` whose words equal those ``period`` apart."""
    begin, step = at, 64
    while begin > low:
        back = max(low, begin - step)
        other = np.flatnonzero(x[back:begin] != x[back + period : begin + period])
        if len(other):
            begin = back + int(other[-1]) + 1
            break
        begin, step = back, 4 * step
    end, step = at, 64
    while end < high - period:
        on = min(high - period, end + step)
        other = np.flatnonzero(x[end:on] != x[end + period : on + period])
        if len(other):
            end += int(other[0])
            break
        end, step = on, 4 * step
    return begin, end + period


def find_runs(codes: np.ndarray, first: np.ndarray, shortest: int = SHORTEST) -> tuple[np.ndarray, ...]:
    """``text, start, length, period`` of all runs, by text, start and period; starts count from the text's first word."""
    none = (np.zeros(0, dtype=np.int64),) * 4
    if not len(codes):
        return none
    g = re_pair(codes, first)
    boundary, low, high, rule, places_rule, places_begin = _nodes(g, first[1:], shortest)
    x = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xC2B2AE3D27D4EB4F)
    found: list[tuple[int, int, int, int]] = []  # node, start, end, period
    last: tuple[int, int, int, int] | None = None
    for nodes, periods, places in _candidates(x, boundary, low, high):
        for node, q, at in zip(nodes.tolist(), periods.tolist(), places.tolist(), strict=True):
            if last and last[0] == node and q % last[3] == 0 and last[1] <= at and last[2] >= at + q and last[2] - last[1] >= REPEATS * q:
                continue  # the same stretch, at a multiple of its period
            begin, end = _extent(codes, at, q, int(low[node]), int(high[node]))
            if end - begin >= max(shortest, REPEATS * q):
                last = (node, begin, end, q)
                found.append(last)
    if not found:
        return none
    node, start, end, period = np.array(found, dtype=np.int64).T

    # To every place of the node's rule.
    ruled = rule[node] >= 0
    order = np.argsort(places_rule, kind="stable")
    of_rule, where = places_rule[order], places_begin[order]
    a, b = np.searchsorted(of_rule, rule[node[ruled]], "left"), np.searchsorted(of_rule, rule[node[ruled]], "right")
    copies = b - a
    each = np.repeat(np.arange(len(a)), copies)
    shift = where[np.repeat(a, copies) + np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)] - low[node[ruled]][each]
    start = np.concatenate([start[~ruled], start[ruled][each] + shift])
    end = np.concatenate([end[~ruled], end[ruled][each] + shift])
    period = np.concatenate([period[~ruled], period[ruled][each]])

    text = np.searchsorted(first, start, "right") - 1
    order = np.lexsort((-end, start, period, text))
    text, start, end, period = text[order], start[order], end[order], period[order]
    # Inside another interval of the same period and text: a later start, no later end.
    group = np.r_[True, (text[1:] != text[:-1]) | (period[1:] != period[:-1])]
    lift = np.cumsum(group) * (int(end.max()) + 1)
    upto = np.maximum.accumulate(end + lift)
    whole = np.r_[True, (end + lift)[1:] > upto[:-1]]
    text, start, end, period = text[whole], start[whole], end[whole], period[whole]
    # One stretch, several periods: the smallest.
    order = np.lexsort((period, end, start, text))
    text, start, end, period = text[order], start[order], end[order], period[order]
    least = np.r_[True, (text[1:] != text[:-1]) | (start[1:] != start[:-1]) | (end[1:] != end[:-1])]
    text, start, end, period = text[least], start[least], end[least], period[least]
    order = np.lexsort((period, start, text))
    return text[order], (start - first[text])[order], (end - start)[order], period[order]


def stays(first: np.ndarray, text: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Of all words, those that no run holds after its first period."""
    change = np.zeros(int(first[-1]) + 1, dtype=np.int64)
    np.add.at(change, first[text] + start + period, 1)
    np.add.at(change, first[text] + start + length, -1)
    return np.cumsum(change[:-1]) == 0


def runs(docs: DataFrame, shortest: int = SHORTEST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each run: ``doc_id``, ``start``, ``length``, ``period`` (in words), ``unit`` (the words of its first period)."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            words, first = split(column(batch, "text"))
            text, start, length, period = find_runs(coded(words)[0], first, shortest)
            at = first[text] + start
            units = [" ".join(words[a : a + q].to_pylist()) for a, q in zip(at.tolist(), period.tolist(), strict=True)]
            return pa.RecordBatch.from_arrays(
                [column(batch, "doc_id").take(pa.array(text)), pa.array(start), pa.array(length), pa.array(period), pa.array(units, pa.string())],
                ["doc_id", "start", "length", "period", "unit"],
            )

        return work

    return texts(docs, id_col, text_col).mapInArrow(
        per_chunk(make, TEXT_BYTES), "doc_id long, start long, length long, period long, unit string"
    )


def collapse(docs: DataFrame, shortest: int = SHORTEST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_runs``; ``start``, ``length``, ``period``, ``exponent_milli`` of the run that repeats most (null
    without a run); ``runs`` (every run's ``start,length,period`` and a line feed); ``text``: the words that stay."""
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs", "text"]

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            words, first = split(column(batch, "text"))
            text, start, length, period = find_runs(coded(words)[0], first, shortest)
            counts = np.bincount(text, minlength=batch.num_rows)
            best: list = [(None,) * 4] * batch.num_rows
            shown = [""] * batch.num_rows
            ends = np.cumsum(counts)
            for t in np.flatnonzero(counts).tolist():
                here = slice(ends[t] - counts[t], ends[t])
                rows = list(zip(start[here].tolist(), length[here].tolist(), period[here].tolist(), strict=True))
                s, n, q = min(rows, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
                best[t] = (s, n, q, 1000 * n // q)
                shown[t] = "".join(f"{s},{n},{q}\n" for s, n, q in rows)
            kept = joined(words, first, stays(first, text, start, length, period))
            numbers = [pa.array([b[k] for b in best], pa.int64()) for k in range(4)]
            return pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), pa.array(counts, pa.int64()), *numbers, pa.array(shown, pa.string()), pa.array(kept, pa.large_binary()).cast(pa.large_string()).cast(pa.string())],
                names,
            )

        return work

    with arrow_rows(docs.sparkSession, 1000):
        return texts(docs, id_col, text_col).mapInArrow(
            per_chunk(make, TEXT_BYTES),
            "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs string, text string",
        )
