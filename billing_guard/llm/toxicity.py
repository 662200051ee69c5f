"""Toxicity by a weighted finite-state pattern grammar.

A lexicon turns a clause's words into symbols (insult, threat verb, target,
negation, reporting verb, quotation mark, other).  Five small transducers read the
symbols: one each for insults, threats, targets, negation and reported speech.
Their synchronous composition is one table of states (:func:`compose`); on an
insult or a completed threat it names the *path*: plain, targeted, negated, reported
insult, or threat.  A document's evidence is the lexicon weight of its matches summed
per path, also per hundred words; a logistic layer weighs the paths.

Learned: insult stems (word beginnings that labelled toxic documents hold far more
often than others, by G-squared) and the path weights, from a bounded sample of
labelled rows, at most ``Plan.toxic`` and ``Plan.clean`` of each label, outside the
held-out fold.  Fixed: the closed-class word lists below.  Scoring reads whole texts.

Edge cases: NULL and empty texts hold no match and get the score of no evidence;
without any labelled row the seed lexicon and the prior path weights apply; rows with
a NULL label teach nothing; conflicting labels of one document count as toxic;
repeated rows each get their row; only doc_id, text and toxic are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billing_guard.llm.common import fold, words, written

# --- the alphabet and its closed-class words (fixed values) ---------------------------
INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, OTHER = "ITGNRQ."
_TARGETS = """you your yours yourself he she they him them her his their these those
du dich dir ihr euch dein deine sie er tu te toi vous ton votre il elle ils tú te ti
usted ustedes tu su él ella ellos""".split()
_NEGATIONS = """not never no nobody isn aren wasn weren don doesn didn won without hardly
nicht nie niemals kein keine keinen ohne ne pas jamais sans aucun aucune nunca jamás sin
ningún ninguna""".split()
_REPORTS = """said says say saying told tells wrote writes quoted quotes called claims claimed
reported reportedly according sagte sagt schrieb schreibt zitierte behauptet dit disait
écrit cite affirme dijo dice escribió citó afirma""".split()
_THREATS = """kill hurt destroy beat murder stab shoot burn crush umbringen töten schlagen
zerstören tuer frapper détruire matar golpear destruir""".split()
_SEEDS = """idiot moron stupid loser scum trash worthless pathetic disgusting clown
dummkopf vollidiot abschaum connard imbécile ordure imbécil estúpido basura""".split()

PATHS = ("plain", "targeted", "negated", "reported", "threat")
_NEAR = 4        # words between a target and what it goes with
_NEGATED_FOR = 3  # words a negation reaches
_SEED_WEIGHT = 3.0
_CLAUSE_END = re.compile(r"[.!?;\n]+")
_PIECE = re.compile(r"\w+|[\"“”„«»]")


# --- transducers -------------------------------------------------------------------
@dataclass(frozen=True)
class Transducer:
    """A deterministic machine: (state, symbol) -> (state, output)."""

    start: int
    arcs: dict[tuple[int, str], tuple[int, bool]]

    def __call__(self, state: int, symbol: str) -> tuple[int, bool]:
        return self.arcs[state, symbol]


def _countdown(trigger: str, reach: int) -> Transducer:
    """True on each symbol up to ``reach`` symbols after a trigger."""
    arcs = {}
    for state in range(reach + 1):
        for symbol in "ITGNRQ.":
            arcs[state, symbol] = (reach, state > 0) if symbol == trigger else (max(0, state - 1), state > 0)
    return Transducer(0, arcs)


def _echo(symbol: str) -> Transducer:
    return Transducer(0, {(0, s): (0, s == symbol) for s in "ITGNRQ."})


def _reported() -> Transducer:
    """True after a reporting verb until the clause ends, and between quotation marks."""
    arcs = {}
    for said in (0, 1):
        for quoted in (0, 1):
            for symbol in "ITGNRQ.":
                to = (said | (symbol == REPORT)) * 2 + (quoted ^ (symbol == QUOTE))
                arcs[said * 2 + quoted, symbol] = (to, bool(said or quoted))
    return Transducer(0, arcs)


def compose(*machines: Transducer) -> dict[tuple, dict[str, tuple[tuple, tuple[bool, ...]]]]:
    """The synchronous composition: its reachable states with their arcs."""
    start = tuple(m.start for m in machines)
    table: dict = {}
    waiting = [start]
    while waiting:
        state = waiting.pop()
        if state in table:
            continue
        table[state] = {}
        for symbol in "ITGNRQ.":
            steps = [m(s, symbol) for m, s in zip(machines, state)]
            table[state][symbol] = (tuple(s for s, _ in steps), tuple(o for _, o in steps))
            waiting.append(table[state][symbol][0])
    return table


_START = (0, 0, 0, 0, 0)
_GRAMMAR = compose(_echo(INSULT), _countdown(THREAT, _NEAR), _countdown(TARGET, _NEAR),
                   _countdown(NEGATION, _NEGATED_FOR), _reported())


def clause_matches(symbols: str) -> list[tuple[int, str]]:
    """(place, path) of each match in a clause's symbols."""
    found = []
    state = _START
    for place, symbol in enumerate(symbols):
        state, (insult, threatened, targeted, negated, reported) = _GRAMMAR[state][symbol]
        if insult:
            near = targeted or TARGET in symbols[place + 1:place + 1 + _NEAR]
            path = ("reported" if reported else "negated" if negated
                    else "targeted" if near else "plain")
            found.append((place, path))
        elif symbol == TARGET and threatened and not (negated or reported):
            found.append((place, "threat"))
    return found


# --- the lexicon ---------------------------------------------------------------------
@dataclass
class Grammar:
    """Stem weights and the logistic layer over path evidence."""

    stems: dict[str, float] = field(default_factory=lambda: dict.fromkeys(_SEEDS, _SEED_WEIGHT))
    weights: np.ndarray = field(default_factory=lambda: np.array(
        [0.8, 1.0, 0.3, 0.3, 1.0] + [0.2] * len(PATHS)))
    bias: float = -3.0

    def __post_init__(self) -> None:
        self._finder = None

    def __getstate__(self):
        return self.stems, self.weights, self.bias

    def __setstate__(self, state):
        self.stems, self.weights, self.bias = state
        self._finder = None

    def finder(self):
        """A multi-pattern automaton over stems and threat verbs."""
        if self._finder is None:
            import ahocorasick

            found = ahocorasick.Automaton()
            for stem in self.stems:
                found.add_word(stem, len(stem))
            for verb in _THREATS:
                if not found.exists(verb):
                    found.add_word(verb, len(verb))
            found.make_automaton()
            self._finder = found
        return self._finder

    def symbol(self, word: str) -> tuple[str, float]:
        """Class and weight of a word; the longest stem that begins it counts."""
        for size in range(len(word), 2, -1):
            weight = self.stems.get(word[:size])
            if weight is not None:
                return INSULT, weight
        if word in _CLASSES:
            return _CLASSES[word], 1.0
        return (QUOTE if not word[0].isalnum() and word != "_" else OTHER), 0.0

    def evidence(self, text: str | None) -> np.ndarray:
        """Summed weights per path, and the same per hundred words (as log1p)."""
        sums = np.zeros(len(PATHS))
        if not text:
            return np.zeros(2 * len(PATHS))
        low = text.lower()
        ends = None
        seen = set()
        for last, size in self.finder().iter(low):
            first = last - size + 1
            if first and (low[first - 1].isalnum() or low[first - 1] == "_"):
                continue
            if ends is None:
                ends = [0, *(m.end() for m in _CLAUSE_END.finditer(low)), len(low)]
                bounds = np.array(ends)
            clause = int(np.searchsorted(bounds, first, side="right")) - 1
            if clause in seen:
                continue
            seen.add(clause)
            pieces = _PIECE.findall(low[ends[clause]:ends[clause + 1]])
            marked = [self.symbol(p) for p in pieces]
            for place, path in clause_matches("".join(s for s, _ in marked)):
                sums[PATHS.index(path)] += marked[place][1]
        if not seen:
            return np.zeros(2 * len(PATHS))
        return np.log1p(np.concatenate([sums, 100 * sums / max(1, len(words(low)))]))

    def score(self, text: str | None) -> float:
        x = float(self.evidence(text) @ self.weights) + self.bias
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


_CLASSES = ({w: THREAT for w in _THREATS} | {w: TARGET for w in _TARGETS}
            | {w: NEGATION for w in _NEGATIONS} | {w: REPORT for w in _REPORTS})


# --- learning ----------------------------------------------------------------------------
@dataclass(frozen=True)
class Plan:
    """Bounds of the labelled sample and of the lexicon."""

    toxic: int = 2000
    clean: int = 6000
    stems: int = 400         # at most, the strongest
    shortest: int = 4
    longest: int = 9
    documents: int = 4       # toxic documents a stem must occur in
    evidence: float = 24.0   # least G-squared of a stem
    seed: int = 11


def labelled_sample(docs: DataFrame, labels: DataFrame, keep: Column, plan: Plan) -> DataFrame:
    """(text, toxic) of at most ``plan.toxic`` / ``plan.clean`` rows, in hash order."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & keep)
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    picked = None
    for value, size in ((1, plan.toxic), (0, plan.clean)):
        part = (known.where(F.col("toxic") == value)
                .orderBy(F.xxhash64("doc_id", F.lit(plan.seed)), "doc_id").limit(size))
        picked = part if picked is None else picked.unionByName(part)
    return (docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")  # bounded by plan
            .groupBy("text").agg(F.max("toxic").alias("toxic")))  # copies teach once


def _stem_counts(plan: Plan):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            toxic, clean = Counter(), Counter()
            for text, label in zip(batch["text"], batch["toxic"]):
                stems = {w[:k] for w in set(words(text))
                         for k in range(plan.shortest, min(plan.longest, len(w)) + 1)}
                (toxic if label else clean).update(stems)
            keys = list(toxic | clean)
            yield pd.DataFrame({"stem": keys, "n1": [toxic[k] for k in keys],
                                "n0": [clean[k] for k in keys]})
    return count


def _g_squared(a: float, b: float, n1: float, n0: float) -> float:
    total = 0.0
    for seen, size in ((a, n1), (b, n0)):
        for x, share in ((seen, (a + b) / (n1 + n0)), (size - seen, 1 - (a + b) / (n1 + n0))):
            if x > 0:
                total += x * math.log(x / (size * share))
    return 2 * total


def choose_stems(counts: list[tuple[str, int, int]], n1: int, n0: int, plan: Plan) -> dict[str, float]:
    """Stems by falling evidence; one that another chosen one begins or extends is left out."""
    rated = sorted(((_g_squared(a, b, n1, n0), len(stem), stem, a, b) for stem, a, b in counts),
                   key=lambda r: (-round(r[0], 6), -r[1], r[2]))
    chosen: dict[str, float] = {}
    for power, _, stem, a, b in rated:
        if power < plan.evidence or len(chosen) >= plan.stems:
            break
        if not any(stem.startswith(c) or c.startswith(stem) for c in chosen):
            chosen[stem] = math.log((a + 0.5) / (n1 + 1)) - math.log((b + 0.5) / (n0 + 1))
    return chosen


def fit_layer(x: np.ndarray, y: np.ndarray, start: Grammar, steps: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton steps, drawn towards the prior path weights."""
    prior = np.append(start.weights, start.bias)
    z = np.column_stack([x, np.ones(len(x))])
    pull = np.append(np.full(x.shape[1], 0.05), 1e-4)
    w = prior.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - y) + pull * (w - prior)
        curve = (z * (p * (1 - p))[:, None]).T @ z + np.diag(pull + 1e-6)
        step = np.linalg.solve(curve, gradient)
        size = np.abs(step).max()
        w -= step * min(1.0, 1.0 / max(size, 1e-12))
        if size < 1e-6:
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, plan: Plan = Plan()) -> Grammar:
    """Learn the lexicon and the path weights outside the held-out fold."""
    sample = written(labelled_sample(docs, labels, fold("doc_id", folds) != held_out, plan),
                     "toxicity_sample")
    grammar = Grammar()
    n1, n0 = (sample.where(F.col("toxic") == v).count() for v in (1, 0))
    if not n1 or not n0:
        return grammar
    least = (F.col("n1") >= plan.documents) & (F.col("n1") * n0 > 3 * F.col("n0") * n1)
    # every kept stem is in at least plan.documents of the bounded sample's texts
    counts = (sample.mapInPandas(_stem_counts(plan), "stem string, n1 long, n0 long")
              .groupBy("stem").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).where(least)
              .orderBy(F.desc(F.col("n1") / n1 - F.col("n0") / n0), "stem").limit(20 * plan.stems))
    learned = choose_stems([(r["stem"], r["n1"], r["n0"]) for r in counts.collect()], n1, n0, plan)
    seeds = {s: _SEED_WEIGHT for s in _SEEDS if not any(s.startswith(c) or c.startswith(s) for c in learned)}
    grammar.stems = seeds | learned
    held = grammar

    @F.pandas_udf("array<double>")
    def evidence(texts: pd.Series) -> pd.Series:
        return pd.Series([held.evidence(t).tolist() for t in texts])

    rows = sample.select(evidence("text").alias("x"), "toxic").collect()  # bounded by plan
    x = np.array([r["x"] for r in rows])
    grammar.weights, grammar.bias = fit_layer(x, np.array([float(r["toxic"]) for r in rows]), grammar)
    return grammar


def score_column(grammar: Grammar, text: Column) -> Column:
    """Score of a whole text between 0 and 1."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([grammar.score(t) for t in texts])

    return score.asNondeterministic()(text)  # evaluated once, never pushed into a filter


def score_toxicity(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """doc_id, score for every row of ``docs``."""
    return docs.select("doc_id", score_column(grammar, F.col("text")).alias("score"))
