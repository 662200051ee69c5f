"""Language identification by a bidirectional gated recurrent network over bytes.

A small network reads a text's UTF-8 bytes forwards and backwards and gives every
byte position a distribution over the learned languages; a document's
probabilities are the mean over all its positions.  The network is trained in
numpy by backpropagation through time, on the driver, from a bounded sample: at
most ``per_language`` documents of each language, ``span`` bytes of each
(:class:`TrainingPlan`).  Prediction reads whole texts: they are cut into windows
of ``WINDOW`` bytes that are read side by side, so memory depends on the window
batch and never on a text's length.

Edge cases: a NULL text, or one without any letter, is ``und`` with score 0; NULL
or ``und`` languages and NULL texts teach nothing; with no labelled row at all
every text is ``und``; repeated rows each get their row; only the id and text
columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billing_guard.llm.common import fold, written

UNDETERMINED = "und"
WINDOW = 64
_LETTER = re.compile(r"[^\W\d_]")
_ROWS = 8192  # windows read side by side


@dataclass(frozen=True)
class TrainingPlan:
    """Bounds of the training sample and the training run."""

    per_language: int = 400  # documents of each language
    span: int = 384          # bytes of each of them
    documents: int = 25_600  # of all languages: fewer of each where there are many
    hidden: int = 6          # state size of each direction
    steps: int = 300
    batch: int = 192
    rate: float = 0.02
    seed: int = 7


@dataclass
class Network:
    """Weights; ``x`` maps a byte to its three gate inputs, for each direction."""

    languages: list[str]
    x: list[np.ndarray]      # 2 x (256, 3H): update, reset, candidate
    h: list[np.ndarray]      # 2 x (H, 2H): update and reset
    c: list[np.ndarray]      # 2 x (H, H): candidate
    out: np.ndarray          # (2H, L)
    bias: np.ndarray         # (L,)

    def parameters(self) -> list[np.ndarray]:
        return [*self.x, *self.h, *self.c, self.out, self.bias]


def _initial(languages: list[str], hidden: int, rng: np.random.Generator) -> Network:
    def normal(*shape: int, scale: float) -> np.ndarray:
        return rng.normal(0, scale, shape).astype(np.float32)

    return Network(languages,
                   [normal(256, 3 * hidden, scale=0.3) for _ in range(2)],
                   [normal(hidden, 2 * hidden, scale=0.3) for _ in range(2)],
                   [normal(hidden, hidden, scale=0.3) for _ in range(2)],
                   normal(2 * hidden, len(languages), scale=0.3),
                   np.zeros(len(languages), np.float32))


def _tanh(a: np.ndarray, spare: np.ndarray | None = None) -> np.ndarray:
    """tanh by its Pade approximant x(27 + x^2) / (27 + 9 x^2), exact +-1 from 3 on;
    in place.  Training and prediction both use it: numpy's own tanh takes three times
    as long."""
    np.clip(a, np.float32(-3), np.float32(3), out=a)
    square = np.multiply(a, a, out=spare)
    square += np.float32(27)
    a *= square
    square *= np.float32(9)
    square -= np.float32(216)
    a /= square
    return a


def _sigmoid(a: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * _tanh(np.float32(0.5) * a) + np.float32(0.5)


def _read(net: Network, side: int, codes: np.ndarray, mask: np.ndarray, keep: bool):
    """States after each byte, in reading order; with ``keep`` also what training needs.

    ``codes`` is (T, B); where ``mask`` is 0 (padding) the state is carried on.
    """
    steps, rows = codes.shape
    hidden = net.c[side].shape[0]
    state = np.zeros((rows, hidden), np.float32)
    states = np.empty((steps, rows, hidden), np.float32)
    kept = []
    order = range(steps) if side == 0 else range(steps - 1, -1, -1)
    x, wh, wc = net.x[side], net.h[side], net.c[side]
    for t in order:
        given = x[codes[t]]
        gates = _sigmoid(given[:, :2 * hidden] + state @ wh)
        update, reset = gates[:, :hidden], gates[:, hidden:]
        candidate = _tanh(given[:, 2 * hidden:] + (reset * state) @ wc)
        new = state + (update * mask[t][:, None]) * (candidate - state)
        if keep:
            kept.append((t, state, update, reset, candidate))
        state = states[t] = new
    return states, kept


def _gradients(net: Network, codes: np.ndarray, mask: np.ndarray, labels: np.ndarray):
    """Mean cross-entropy over all positions and its gradients (through time)."""
    hidden = net.c[0].shape[0]
    runs = [_read(net, side, codes, mask, True) for side in (0, 1)]
    both = np.concatenate([runs[0][0], runs[1][0]], axis=2)
    logits = both @ net.out + net.bias
    logits -= logits.max(axis=2, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=2, keepdims=True)
    n = max(float(mask.sum()), 1.0)
    column = np.arange(codes.shape[1])
    loss = -float((np.log(p[:, column, labels] + 1e-9) * mask).sum()) / n
    p[:, column, labels] -= 1
    p *= mask[:, :, None] / np.float32(n)
    d_out = np.tensordot(both, p, axes=([0, 1], [0, 1]))
    d_bias = p.sum(axis=(0, 1))
    d_both = p @ net.out.T
    grads: list[list[np.ndarray]] = [[], [], []]
    for side in (0, 1):
        d_states = d_both[:, :, side * hidden:(side + 1) * hidden]
        dx, dh, dc = (np.zeros_like(w[side]) for w in (net.x, net.h, net.c))
        carried = np.zeros_like(d_states[0])
        for t, before, update, reset, candidate in reversed(runs[side][1]):
            d = carried + d_states[t]
            m = mask[t][:, None]
            d_cand = d * update * m * (1 - candidate ** 2)
            d_reset_state = d_cand @ net.c[side].T
            d_update = d * (candidate - before) * m * update * (1 - update)
            d_reset = d_reset_state * before * reset * (1 - reset)
            d_gates = np.concatenate([d_update, d_reset], axis=1)
            dc += (reset * before).T @ d_cand
            dh += before.T @ d_gates
            np.add.at(dx, codes[t], np.concatenate([d_gates, d_cand], axis=1))
            carried = d * (1 - update * m) + d_reset_state * reset + d_gates @ net.h[side].T
        for held, g in zip(grads, (dx, dh, dc)):
            held.append(g)
    return loss, [*grads[0], *grads[1], *grads[2], d_out, d_bias]


def train(sample: list[tuple[str, bytes]], plan: TrainingPlan = TrainingPlan()) -> Network | None:
    """Fit the network to (language, bytes) pairs with Adam; ``None`` for no pairs."""
    sample = [(lang, data) for lang, data in sample if data]
    languages = sorted({lang for lang, _ in sample})
    if not languages:
        return None
    rng = np.random.default_rng(plan.seed)
    net = _initial(languages, plan.hidden, rng)
    windows, labels = [], []
    for lang, data in sorted(sample):
        for start in range(0, len(data), WINDOW // 2):
            windows.append(data[start:start + WINDOW])
            labels.append(languages.index(lang))
    labels_all = np.array(labels)
    by_label = [np.flatnonzero(labels_all == k) for k in range(len(languages))]
    first = [np.zeros_like(w) for w in net.parameters()]
    second = [np.zeros_like(w) for w in net.parameters()]
    for step in range(1, plan.steps + 1):
        rows = np.concatenate([rng.choice(ix, -(-plan.batch // len(by_label))) for ix in by_label])
        codes, mask = _matrix([windows[i] for i in rows])
        _, grads = _gradients(net, codes, mask, labels_all[rows])
        norm = np.sqrt(sum(float((g ** 2).sum()) for g in grads))
        rate = plan.rate * (1 - step / (plan.steps + 1))
        for w, g, m, v in zip(net.parameters(), grads, first, second):
            g = g * np.float32(min(1.0, 1.0 / (norm + 1e-9)))
            m *= 0.9
            m += 0.1 * g
            v *= 0.99
            v += 0.01 * g * g
            w -= (rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return net


def _matrix(windows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(WINDOW, B) byte codes and the mask of real bytes."""
    data = b"".join(w.ljust(WINDOW, b"\0") for w in windows)
    codes = np.frombuffer(data, np.uint8).reshape(-1, WINDOW).T
    lengths = np.array([len(w) for w in windows])
    return codes, (np.arange(WINDOW)[:, None] < lengths).astype(np.float32)


def _states(net: Network, side: int, codes: np.ndarray, padded: list[np.ndarray]) -> np.ndarray:
    """As :func:`_read` without training: (T, H, B) states, on reused buffers.

    The sigmoid is ``(1 + tanh(a / 2)) / 2``; its inner half is folded into the weights.
    """
    steps, rows = codes.shape
    hidden = net.c[side].shape[0]
    half = np.float32(0.5)
    tables = [np.ascontiguousarray(net.x[side][:, k * hidden:(k + 1) * hidden] * f)
              for k, f in enumerate((half, half, np.float32(1)))]
    weights = [np.ascontiguousarray(net.h[side][:, k * hidden:(k + 1) * hidden] * half) for k in (0, 1)]
    weights.append(net.c[side])
    update, reset, candidate, product = (np.empty((rows, hidden), np.float32) for _ in range(4))
    states = np.empty((steps, rows, hidden), np.float32)
    state = np.zeros((rows, hidden), np.float32)

    def gate(k: int, given: np.ndarray, into: np.ndarray, codes_t: np.ndarray) -> None:
        np.take(tables[k], codes_t, axis=0, out=into, mode="clip")
        np.matmul(given, weights[k], out=product)
        into += product
        _tanh(into, product)
        if k < 2:
            into *= half
            into += half

    for t in range(steps) if side == 0 else range(steps - 1, -1, -1):
        gate(0, state, update, codes[t])
        gate(1, state, reset, codes[t])
        reset *= state
        gate(2, reset, candidate, codes[t])
        if padded[t].size:
            update[padded[t]] = 0
        candidate -= state
        candidate *= update
        np.add(state, candidate, out=states[t])
        state = states[t]
    return states


def _window_sums(net: Network, codes: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per window: summed probabilities, and positions labelled with each language."""
    padded = [np.flatnonzero(m == 0) for m in mask]
    codes = codes.astype(np.intp)
    forward = _states(net, 0, codes, padded)
    backward = _states(net, 1, codes, padded)
    hidden = net.c[0].shape[0]
    to, back = (np.ascontiguousarray(net.out[part].T) for part in (slice(hidden), slice(hidden, None)))
    sums = np.zeros((len(net.languages), codes.shape[1]), np.float32)
    votes = np.zeros_like(sums)
    for t in range(codes.shape[0]):
        p = to @ forward[t].T
        p += back @ backward[t].T
        p += net.bias[:, None]
        best = p.max(axis=0)
        own = p == best
        p -= best
        np.exp(p, out=p)
        p *= mask[t] / p.sum(axis=0)
        sums += p
        votes += own if not padded[t].size else own * mask[t]
    return sums.T, votes.T


def _scored(net: Network, texts: list[str | None]) -> pd.DataFrame:
    """Prediction, score and share of agreeing positions for each text."""
    size = len(net.languages)
    sums = np.zeros((len(texts), size))
    votes = np.zeros((len(texts), size))
    known = np.array([bool(t) and _LETTER.search(t) is not None for t in texts], bool)
    windows: list[bytes] = []
    owners: list[int] = []

    def flush() -> None:
        if windows:
            codes, mask = _matrix(windows)
            s, v = _window_sums(net, np.ascontiguousarray(codes), mask)
            np.add.at(sums, owners, s)
            np.add.at(votes, owners, v)
            windows.clear()
            owners.clear()

    for i in np.flatnonzero(known):
        data = texts[i].encode("utf-8", "replace")
        for start in range(0, len(data), WINDOW):
            windows.append(data[start:start + WINDOW])
            owners.append(i)
            if len(windows) == _ROWS:
                flush()
    flush()
    total = np.maximum(sums.sum(axis=1), 1e-9)
    best = sums.argmax(axis=1)
    rows = np.arange(len(texts))
    score = np.where(known, sums[rows, best] / total, 0.0)
    share = np.where(known, votes[rows, best] / np.maximum(votes.sum(axis=1), 1e-9), 0.0)
    names = np.array([*net.languages, UNDETERMINED], object)
    return pd.DataFrame({"lang_pred": names[np.where(known, best, size)],
                         "score": np.clip(score, 0, 1), "share": np.clip(share, 0, 1)})


def language_column(net: Network | None, text: Column) -> Column:
    """struct(lang_pred, score, share) of a whole text."""
    if net is None:
        return F.struct(F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"),
                        F.lit(0.0).alias("share"))

    @F.pandas_udf("lang_pred string, score double, share double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield _scored(net, texts.tolist())

    return predict.asNondeterministic()(text)  # evaluated once, never pushed into a filter


_SPARE, _THINNED = 4, 64  # rows ranked for one that is taken; languages whose rows are thinned


def training_sample(docs: DataFrame, keep: Column, plan: TrainingPlan = TrainingPlan()) -> list[tuple[str, bytes]]:
    """At most ``plan.per_language`` rows of each language (at least one, and fewer where
    the languages would have more than ``plan.documents``), in the order of a hash of the row, each cut to ``plan.span`` characters from a hashed place on."""
    order = F.xxhash64("doc_id", "text", F.lit(plan.seed))
    rows = docs.where(keep & (F.length("text") > 0) & F.col("lang").isNotNull()
                      & (F.col("lang") != UNDETERMINED))
    place = F.lit(1) + F.pmod(order, F.greatest(F.length("text") - plan.span + 1, F.lit(1))).cast("int")
    cut = rows.select("lang", F.substring(F.col("text"), place, F.lit(plan.span)).alias("part"),
                      order.alias("nth"))
    ranked = Window.partitionBy("lang").orderBy("nth", "part")
    counts = written(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    most = max(1, min(plan.per_language, plan.documents // max(1, counts.count())))
    # of a frequent language only about _SPARE times the rows wanted, those with the least
    # hashes, go on to its ranking; beyond the first ones no language holds many rows
    frequent = counts.where(F.col("n") > _SPARE * most).orderBy(F.col("n").desc(), "lang").limit(_THINNED).collect()
    for r in frequent:
        below = -2**63 + int(2**64 * _SPARE * most / r["n"])
        cut = cut.where((F.col("lang") != r["lang"]) | (F.col("nth") < F.lit(below)))
    sample = (cut.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= most)
              .select("lang", "part"))
    return [(r["lang"], r["part"].encode("utf-8", "replace")) for r in sample.collect()]


def fit(docs: DataFrame, folds: int = 5, held_out: int = 0, plan: TrainingPlan = TrainingPlan()) -> Network | None:
    """Train on ``docs`` (doc_id, text, lang) outside the held-out fold."""
    return train(training_sample(docs, fold("doc_id", folds) != held_out, plan), plan)


def predict_languages(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, lang_pred, score, share for every row of ``docs`` (doc_id, text)."""
    return docs.select("doc_id", language_column(net, F.col("text")).alias("p")).select("doc_id", "p.*")
