"""Secrets by pattern and by inferred grammar.

Base patterns find assignments, access keys and long hexadecimal runs. What they find in the
documents are labelled credentials, one class per pattern. From each class a
prefix tree over character kinds is built and its states are merged as long as their futures are
statistically compatible (Hoeffding's bound on the frequencies of ending and of every next kind,
down the tree): the result is a probabilistic automaton of the format. Every token as long as the
shortest labelled credential, and every one of ``CANDIDATE`` characters, is a candidate; its score is
the mean log-likelihood per character under the best credential automaton less that under the
automaton of plain tokens.

Tokens without a pattern may be credentials, so they are not plain by themselves. Words, numbers and
what signs join of them are; of the other ones those are taken as plain that score below all but ``MISS`` of held-out
credentials mixed among them ("spies"), in each of ``ROUNDS`` rounds. The cutoff lies midway between the score that all but
``MISS`` of the held-out credentials reach and the one that all but ``FALSE`` of these plain tokens
stay below; where the two overlap it is the former, and it is never below zero, where a token is as
likely plain. How many candidates are above it is not bounded. Candidates at or above it become spans
of kind ``format``. Spans of the patterns always stay; a candidate that reaches beyond one is scored
as a whole and may add a span around it, one within a span adds nothing. A format that no pattern
labels is not learned.

Positions are code points, ends exclusive. A null or empty text has no spans. Repeated rows
are scanned one by one. Where the documents hold fewer than ``LEAST`` credentials of a class it
teaches no automaton; without any there are only base spans. Extra columns are not read, and
``redact`` passes them through.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.llm.common import BATCH_ROWS, arrow_rows, chunks, column, per_chunk, texts
from panelloom.session import pin

# The base patterns. Letters of the keyword in either case, ASCII only.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE, LEAST_ACCESS = 6, 20
KEYWORDS = ("passw", "secret", "token", "api")
KINDS = ("assign", "access", "hex", "format")

CANDIDATE = 16
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{6,}")  # no label is shorter
DIGIT = re.compile("[0-9]")
PART = "(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]+)"
ORDINARY = re.compile(rf"[+/_.=-]*{PART}(?:[+/_.=-]+{PART})*[+/_.=-]*|[+/_.=-]+")
SAMPLE_TOKENS = 3000
MARK = "[SECRET]"

SYMBOLS = 9
STOP = SYMBOLS  # the symbol of an end
LONGEST = 64  # a longer example teaches its first characters
CONFIDENCE = 0.05
LEAST = 5
ROUNDS = 4
MISS, FALSE = 0.02, 0.002
FLOOR = 1e-4  # probability of what an automaton has not seen


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base patterns, sorted; kinds as positions in ``KINDS``."""
    spans = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    # Runs are maximal either way, so the length may stand in the pattern.
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def candidates(text: str, shortest: int = CANDIDATE) -> list[tuple[int, int]]:
    return [m.span() for m in TOKEN.finditer(text) if m.end() - m.start() >= shortest]


def kinds_of(token: str) -> np.ndarray:
    """Digit, a-f, g-z, A-F, G-Z, base64 signs, joining signs, point, equals."""
    table = np.full(128, SYMBOLS - 1, dtype=np.int8)
    for k, chars in enumerate(("0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", "+/", "_-", ".")):
        table[[ord(c) for c in chars]] = k
    return table[np.frombuffer(token.encode("ascii"), dtype=np.uint8)]


class PrefixTree:
    """Prefix tree of examples with counts, and its merged form."""

    def __init__(self, examples: Iterable[str]):
        self.next: list[dict[int, int]] = [{}]
        self.count: list[dict[int, int]] = [{}]
        for example in examples:
            state = 0
            for symbol in kinds_of(example[:LONGEST]).tolist():
                self._see(state, symbol)
                if symbol not in self.next[state]:
                    self.next[state][symbol] = len(self.next)
                    self.next.append({})
                    self.count.append({})
                state = self.next[state][symbol]
            self._see(state, STOP)

    def _see(self, state: int, symbol: int, times: int = 1) -> None:
        self.count[state][symbol] = self.count[state].get(symbol, 0) + times

    def compatible(self, a: int, b: int) -> bool:
        """Whether no frequency, here or further on along shared symbols, differs beyond chance."""
        todo = [(a, b)]
        half = np.sqrt(0.5 * np.log(2 / CONFIDENCE))
        while todo:
            a, b = todo.pop()
            na, nb = sum(self.count[a].values()), sum(self.count[b].values())
            if not na or not nb:
                continue
            bound = half * (na**-0.5 + nb**-0.5)
            for symbol in self.count[a].keys() | self.count[b].keys():
                if abs(self.count[a].get(symbol, 0) / na - self.count[b].get(symbol, 0) / nb) > bound:
                    return False
            todo += [(self.next[a][s], self.next[b][s]) for s in self.next[a].keys() & self.next[b].keys() if self.next[a][s] != self.next[b][s]]
        return True

    def fold(self, into: int, tree: int) -> None:
        """Add the subtree below ``tree`` to the state ``into`` and what follows it."""
        todo = [(into, tree)]
        while todo:
            a, b = todo.pop()
            for symbol, times in self.count[b].items():
                self._see(a, symbol, times)
            for symbol, child in self.next[b].items():
                if symbol in self.next[a]:
                    todo.append((self.next[a][symbol], child))
                else:
                    self.next[a][symbol] = child

    def merged(self) -> Automaton:
        """Red states are kept; a blue one, a child of a red state, joins the first compatible red state or turns red."""
        red = [0]
        while True:
            known = set(red)
            blue = [(s, symbol) for s in red for symbol in sorted(self.next[s]) if self.next[s][symbol] not in known]
            if not blue:
                break
            parent, symbol = blue[0]
            child = self.next[parent][symbol]
            home = next((r for r in red if self.compatible(r, child)), None)
            if home is None:
                red.append(child)
            else:
                self.next[parent][symbol] = home
                self.fold(home, child)
        place = {s: i for i, s in enumerate(red)}
        follow = np.zeros((len(red) + 1, SYMBOLS), dtype=np.int32) + len(red)  # the last state: never seen
        chance = np.full((len(red) + 1, SYMBOLS + 1), np.log(FLOOR))
        for s in red:
            total = sum(self.count[s].values())
            for symbol, times in self.count[s].items():
                chance[place[s], symbol] = np.log((times + FLOOR) / (total + FLOOR * (SYMBOLS + 1)))
            for symbol, child in self.next[s].items():
                follow[place[s], symbol] = place[child]
        return Automaton(follow, chance)


@dataclass
class Automaton:
    follow: np.ndarray
    chance: np.ndarray  # logarithms; the last column is that of an end

    def score(self, tokens: list[str]) -> np.ndarray:
        """Mean log-likelihood per character, all tokens stepped together."""
        sizes = np.array([len(t) for t in tokens], dtype=np.int64)
        flat = kinds_of("".join(tokens))
        starts = np.cumsum(sizes) - sizes
        state, total = np.zeros(len(tokens), dtype=np.int32), np.zeros(len(tokens))
        active = np.argsort(-sizes, kind="stable")
        for k in range(int(sizes.max(initial=0))):
            active = active[: np.searchsorted(-sizes[active], -k, side="left")]
            symbol = flat[starts[active] + k]
            total[active] += self.chance[state[active], symbol]
            state[active] = self.follow[state[active], symbol]
        return (total + self.chance[state, STOP]) / np.maximum(1, sizes)


@dataclass
class Grammar:
    credentials: list[Automaton]
    plain: Automaton | None
    cutoff: float
    shortest: int = CANDIDATE

    def score(self, tokens: list[str]) -> np.ndarray:
        if not tokens or not self.credentials:
            return np.full(len(tokens), -np.inf)
        best = np.max([a.score(tokens) for a in self.credentials], axis=0)
        return best - (self.plain.score(tokens) if self.plain else np.log(1 / SYMBOLS))


def taught(plain: list[str]) -> Automaton | None:
    return PrefixTree(plain).merged() if len(plain) >= LEAST else None


def known_plain(halves: list[list[Automaton]], held: list[list[str]], tokens: list[str]) -> list[str]:
    """Words and numbers, and what of the others scores below all but ``MISS`` of the held-out credentials mixed among them.

    Credentials that one round leaves are fewer among the others of the next one and stand out more.
    """
    ordinary = [t for t in tokens if ORDINARY.fullmatch(t)]
    others = sorted(set(tokens) - set(ordinary))
    for k in range(ROUNDS):
        half, spies = halves[k % 2], held[k % 2]
        spies = spies[:: max(1, -(-5 * len(spies) // max(1, len(others))))]
        scores = Grammar(half, taught(others + spies), np.inf).score(others + spies)
        low = np.quantile(scores[len(others) :], MISS)
        others = [t for t, s in zip(others, scores.tolist()) if s < low]
    return sorted(ordinary + others)


def fit(credentials: list[list[str]], unlabelled: list[str], shortest: int = CANDIDATE) -> Grammar:
    """Automata of all labelled credentials; plain tokens and cutoff by automata of one half and credentials of the other."""
    classes = [c for c in credentials if len(c) >= LEAST]
    tokens = sorted(set(unlabelled) - {t for c in credentials for t in c})
    if not classes:
        return Grammar([], taught(tokens), np.inf, shortest)
    halves = [[PrefixTree(c[k::2]).merged() for c in classes] for k in (0, 1)]
    held = [[t for c in classes for t in c[1 - k :: 2]] for k in (0, 1)]
    known = known_plain(halves, held, tokens)
    grammar = Grammar([PrefixTree(c).merged() for c in classes], taught(known), np.inf, shortest)
    own = np.concatenate([Grammar(halves[k], grammar.plain, np.inf).score(held[k]) for k in (0, 1)])
    reached, passed = np.quantile(own, MISS), np.quantile(grammar.score(known), 1 - FALSE) if known else 0.0
    grammar.cutoff = max(0.0, float(min(reached, (reached + passed) / 2)))
    return grammar


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Grammar:
    """Credentials, ordinary words and other tokens of all documents; of each class the automata learn from ``SAMPLE_TOKENS``.

    The tokens stay where they are; only the chosen ones come to the driver.
    """

    def run(batches):
        for batch in batches:
            for part in chunks(batch):
                labelled, others = set(), set()
                for text in column(part, "text").to_pylist():
                    spans = base_spans(text)
                    for start, kind, end in spans:
                        labelled.add((kind, ASSIGN.match(text, start)[2] if kind == 0 else text[start:end]))
                    if not spans:
                        others.update(TOKEN.findall(text))
                        continue
                    for start, end in candidates(text, LEAST_VALUE):
                        if not any(s < end and start < e for s, _, e in spans):
                            others.add(text[start:end])
                # A word is the same wherever it stands, so each is looked at once.
                labelled |= {(4 if ORDINARY.fullmatch(t) and not DIGIT.search(t) else 3, t) for t in others}
                rows = sorted({(k, t[:LONGEST]) for k, t in labelled})
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.string())], ["kind", "token"]
                )

    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        tokens = pin(texts(docs, id_col, text_col).mapInArrow(run, "kind int, token string").distinct())  # read once for each class
    shortest = min(CANDIDATE, tokens.where("kind < 3").agg(F.min(F.length("token"))).first()[0] or CANDIDATE)
    long_enough = tokens.where((F.col("kind") < 3) | (F.length("token") >= shortest))
    chosen = [
        long_enough.where(F.col("kind") == kind).orderBy(F.xxhash64("token"), "token").limit(SAMPLE_TOKENS) for kind in range(5)
    ]
    rows = reduce(DataFrame.unionAll, chosen).collect()
    by_kind = [sorted(r["token"] for r in rows if r["kind"] == k) for k in range(5)]
    return fit(by_kind[:3], by_kind[3] + by_kind[4], shortest)


def spans_of(grammar: Grammar, texts_: list[str]) -> list[list[tuple[int, int, int]]]:
    """All spans of every text, sorted; candidates of all texts are scored together."""
    found = [base_spans(t) for t in texts_]
    open_ = []
    for i, text in enumerate(texts_):
        for start, end in candidates(text, grammar.shortest):
            if not any(s <= start and end <= e for s, _, e in found[i]):
                open_.append((i, start, end))
    words = sorted({texts_[i][a:b] for i, a, b in open_})
    scores = dict(zip(words, grammar.score(words).tolist(), strict=True))
    for i, start, end in open_:
        if scores[texts_[i][start:end]] >= grammar.cutoff:
            found[i].append((start, 3, end))
    return [sorted(f) for f in found]


def spell(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame, grammar: Grammar, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, numbers of base spans, the digest of base spans, and all spans."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = spans_of(grammar, column(batch, "text").to_pylist())
            base = [[s for s in f if s[1] < 3] for f in found]
            counts = [pa.array([sum(s[1] == k for s in b) for b in base], pa.int64()) for k in range(3)]
            digests = pa.array([hashlib.sha256(spell(b).encode()).hexdigest() for b in base], pa.string())
            arrays = [column(batch, "doc_id"), *counts, digests, pa.array([spell(f) for f in found], pa.string())]
            return pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

        return work

    form = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return texts(docs, id_col, text_col).mapInArrow(per_chunk(make), form)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every run of overlapping spans replaced by one mark."""
    out, upto = [], 0
    for start, _, end in spans:
        if start >= upto:
            out += [text[upto:start], MARK]
        upto = max(upto, end)
    return "".join([*out, text[upto:]])


def redact(docs: DataFrame, grammar: Grammar, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The documents with their secrets masked; a length column, if there is one, follows the text."""
    names = [c.lower() for c in docs.columns]
    at = names.index(text_col.lower())
    length = names.index(length_col.lower()) if length_col.lower() in names else None

    def run(batches):
        for batch in batches:
            for part in chunks(batch, batch.schema.field(at).name):
                old = part.column(at).to_pylist()
                found = spans_of(grammar, [t or "" for t in old])
                new = [masked(t, f) if f else t for t, f in zip(old, found, strict=True)]
                arrays = list(part.columns)
                arrays[at] = pa.array(new, arrays[at].type)
                if length is not None:
                    sizes = zip(arrays[length].to_pylist(), new, found, strict=True)
                    arrays[length] = pa.array([len(t) if f and n is not None else n for n, t, f in sizes], arrays[length].type)
                yield pa.RecordBatch.from_arrays(arrays, schema=part.schema)

    return docs.mapInArrow(run, docs.schema)
