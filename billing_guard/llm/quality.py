"""Quality by an interpolated modified Kneser-Ney model over words.

Trained on all trusted documents (quality label 1).  A word is a run of bytes up to and
with its white space, so the words of a text hold all its bytes; it stands for itself as a
64-bit hash.  The counts of lower orders are continuation counts (in how many longer
n-grams one ends).  Each order has three discounts from its counts of counts.  Below the words
a modified Kneser-Ney model of byte ``ORDER``-grams, trained on the distinct trusted words and
interpolated down to the uniform distribution over bytes, spells them, so every text has a
probability.

The word model and what it adds to each text are taken bucket by bucket, in passes over the
texts (``wordmodel``): neither the model nor a text is held whole by a task, and no table has
the texts' n-grams.  Texts are marked as trusted where they lie as long as the trusted ids are
at most ``_IDS_SENT``; beyond, trusted texts meet their ids in a join and are written once.
The spelling model, which stays small, is dealt by hash into shards of about ``SHARD_ROWS``
rows in the shared folder.  Tables are deleted once their last reader has written what it
makes of them.

A document's perplexity is that of its bytes.  It is kept if its perplexity is at most its
language's ``quantile`` among trusted documents (all trusted ones, for a language without).

Edge cases: NULL and empty texts have a NULL perplexity and are not kept; without any
trusted text the model is uniform and every non-empty text is kept; a NULL language is a
language of its own; conflicting labels trust a document if one does; repeated rows each
get their row (equal texts, by a 64-bit hash, share their sum); a text without white space
is one word; only doc_id, text, lang and doc_id, quality are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billing_guard.llm.common import written
from billing_guard.llm.tokenfile import open_path
from billing_guard.llm.wordmodel import LEAST, PASSES, SCALE, discounts_of, hashed_words, job_settings, mixed, ranked, word_sums
from billing_guard.session import delete_work, qualified, work_count, work_path, written_observed

ORDER = 4             # of the spelling model
QUANTILE = 0.99
SHARD_ROWS = 2_000_000
_AT_ONCE = 4_000_000  # bytes scored at a time
_KEPT_SHARDS = 2      # shards a worker keeps between batches
_IDS_SENT = 4_000_000  # trusted ids that are sent to all tasks, so that no text moves


def gram_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """ORDER-gram codes at every byte of the texts (zero bytes before each), and where
    each text's codes start."""
    stops = np.cumsum([len(t) for t in texts], dtype=np.int64)
    starts = np.concatenate([np.zeros(1, np.int64), stops[:-1]]) if len(texts) else stops
    return _codes(np.frombuffer(b"".join(texts), np.uint8), starts, stops), starts


def _codes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """ORDER-gram codes at every byte of some pieces of ``data``, one piece after the other."""
    sizes = stops - starts
    firsts = np.cumsum(sizes) - sizes
    at = np.arange(sizes.sum())
    own = data[at + np.repeat(starts - firsts, sizes)].astype(np.uint32)
    codes, place = own.copy(), at - np.repeat(firsts, sizes)
    for k in range(1, ORDER):
        later = np.flatnonzero(place >= k)
        codes[later] |= own[later - k] << np.uint32(8 * k)
    return codes


def _chunks(texts: list[str | None]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Non-empty texts in groups of about ``_AT_ONCE`` bytes."""
    rows, group, size = [], [], 0
    for k, text in enumerate(texts):
        if text:
            data = text.encode("utf-8", "replace")
            rows.append(k)
            group.append(data)
            size += len(data)
            if size >= _AT_ONCE:
                yield rows, group
                rows, group, size = [], [], 0
    if rows:
        yield rows, group


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for _, group in _chunks(batch["text"].tolist()):
            codes, n = np.unique(gram_codes(group)[0], return_counts=True)
            yield pd.DataFrame({"code": codes.astype(np.int64), "c": n})


def trusted_ids(labels: DataFrame) -> DataFrame:
    return (labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull())
            .select("doc_id").distinct())


def discounts(order_counts: DataFrame) -> dict[str, float]:
    """Modified Kneser-Ney discounts for counts of 1, 2, and 3 or more."""
    return discounts_of(list(order_counts.agg(*(F.coalesce(F.sum((F.col("c") == k).cast("long")), F.lit(0))
                                                for k in (1, 2, 3, 4))).first()))


def train(texts: DataFrame) -> DataFrame:
    """key (order << 32 | code), p, gamma of the model of ``texts`` (text)."""
    counts = {ORDER: written(texts.mapInPandas(_count, "code long, c long").groupBy("code")
                             .agg(F.sum("c").alias("c")), "grams")}
    for k in range(ORDER - 1, 0, -1):
        suffix = F.col("code").bitwiseAND(F.lit((1 << 8 * k) - 1))
        counts[k] = written(counts[k + 1].groupBy(suffix.alias("code"))
                            .agg(F.count(F.lit(1)).alias("c")), "grams")
    gammas, lower, tables = {}, None, {}
    for k in range(1, ORDER + 1):
        d = discounts(counts[k])
        grams = counts[k].withColumn("h", F.shiftright("code", 8))
        cut = F.when(F.col("c") == 1, d["d1"]).when(F.col("c") == 2, d["d2"]).otherwise(d["d3"])
        contexts = grams.groupBy("h").agg(F.sum("c").alias("total"), (F.sum(cut) / F.sum("c")).alias("gamma"))
        gammas[k] = contexts.select(F.col("h").alias("code"), "gamma")
        own = grams.join(contexts, "h").withColumn("seen", (F.col("c") - cut) / F.col("total"))
        if lower is None:
            p = F.col("seen") + F.col("gamma") / 256
        else:
            below = lower.select(F.col("code").alias("suffix"), F.col("p").alias("below"))
            own = own.withColumn("suffix", F.col("code").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1))) \
                .join(below, "suffix")
            p = F.col("seen") + F.col("gamma") * F.col("below")
        lower = tables[k] = written(own.select("code", p.alias("p")), "probabilities")
    model = None
    for k in range(1, ORDER + 1):
        rows = tables[k]
        # a context need not be an n-gram itself: nothing precedes the zero bytes
        rows = (rows.join(gammas[k + 1], "code", "full") if k < ORDER
                else rows.withColumn("gamma", F.lit(None).cast("double")))
        rows = rows.select((F.col("code") + (k << 32)).alias("key"), "p", "gamma")
        model = rows if model is None else model.unionByName(rows)
    # the empty context: its weight on the uniform distribution
    empty = gammas[1].select(F.lit(0).cast("long").alias("key"), F.lit(1 / 256).alias("p"), "gamma")
    return model.unionByName(empty)


def write_shards(model: DataFrame, shard_rows: int = SHARD_ROWS, path: str | None = None) -> tuple[str, int]:
    """The model in hashed shards of a folder (by default a new one); (folder, number of shards)."""
    model = written(model, "model")
    shards = max(1, -(-model.count() // shard_rows))
    folder = qualified(model.sparkSession, path or work_path(model.sparkSession, "model_shards"))
    (model.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
     .repartition(shards, "shard").write.partitionBy("shard").parquet(folder))
    return folder, shards


_SHARDS: dict[tuple[str, int], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def _shard(folder: str, shard: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys with p and gamma of one shard."""
    if (folder, shard) not in _SHARDS:
        import pyarrow.dataset as ds
        from pyarrow import fs

        store, inner = open_path(f"{folder}/shard={shard}")
        if store.get_file_info(inner).type == fs.FileType.NotFound:
            held = np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
        else:
            t = ds.dataset(inner, filesystem=store, format="parquet").to_table(["key", "p", "gamma"])
            key = t["key"].to_numpy()
            order = np.argsort(key)
            held = key[order], t["p"].to_numpy()[order], t["gamma"].to_numpy()[order].astype(float)
        while len(_SHARDS) >= _KEPT_SHARDS:
            _SHARDS.pop(next(iter(_SHARDS)))
        _SHARDS[folder, shard] = held
    return _SHARDS[folder, shard]


def joined(folder: str, shards: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """p and gamma of the keys (NaN where the model has none), shard after shard."""
    p, gamma = np.full(len(keys), np.nan), np.full(len(keys), np.nan)
    for shard in range(shards):
        held, ps, gs = _shard(folder, shard)
        if len(held):
            at = np.minimum(np.searchsorted(held, keys), len(held) - 1)
            found = np.flatnonzero(held[at] == keys)
            p[found], gamma[found] = ps[at[found]], gs[at[found]]
    return p, gamma


def log_probabilities(folder: str, shards: int, grams: np.ndarray) -> np.ndarray:
    """Natural logarithm of the probability of each distinct ORDER-gram's last byte."""
    _, empty = joined(folder, shards, np.zeros(1, np.int64))
    levels = [np.unique(grams.astype(np.int64) & ((1 << 8 * k) - 1)) for k in range(1, ORDER + 1)]
    contexts = [np.zeros(1, np.int64), *(np.unique(g >> 8) for g in levels[1:])]
    below_codes, below = np.zeros(1, np.int64), np.array([1 / 256])
    weights = np.nan_to_num(empty, nan=1.0)
    for k in range(1, ORDER + 1):
        codes = levels[k - 1]
        p, _ = joined(folder, shards, codes + (k << 32))
        if k > 1:
            _, weights = joined(folder, shards, contexts[k - 1] + ((k - 1) << 32))
            weights = np.nan_to_num(weights, nan=1.0)  # never a context: back off in full
        weight = weights[np.searchsorted(contexts[k - 1], codes >> 8)]
        lower = below[np.searchsorted(below_codes, codes & ((1 << 8 * (k - 1)) - 1))]
        below_codes, below = codes, np.where(np.isnan(p), weight * lower, p)
    return np.log(below)


def word_spans(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The joined texts (none empty); of each word its start, end, 64-bit hash and text."""
    joint = b"".join(texts)
    stops = np.cumsum([len(t) for t in texts])
    ends, words = hashed_words(np.frombuffer(joint, np.uint8), stops)
    starts = np.concatenate([[0], ends[:-1]])
    return joint, starts, ends, words, np.searchsorted(stops, starts, side="right")


def before(words: np.ndarray, text: np.ndarray, steps: int) -> np.ndarray:
    """The hash of the word so many words before each in its text; 0 before the first."""
    out = np.zeros_like(words)
    out[steps:] = np.where(text[steps:] == text[:len(text) - steps], words[:len(words) - steps], 0)
    return out


class _Recent:
    """Of words met lately a number each, by their hashes: a word takes the place of another."""

    def __init__(self, bits: int = 20):
        self.keys, self.numbers = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits)
        self.mask = np.uint64((1 << bits) - 1)

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words' numbers, and where those are that have none."""
        at = (words & self.mask).astype(np.int64)
        return self.numbers[at], np.flatnonzero(self.keys[at] != words)

    def put(self, words: np.ndarray, numbers: np.ndarray | float) -> None:
        at = (words & self.mask).astype(np.int64)
        self.keys[at] = words  # of several for one place the last, here and below
        self.numbers[at] = numbers


def _vocabulary(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    met = _Recent()
    for batch in batches:
        for _, group in _chunks(batch["text"].tolist()):
            joint, starts, ends, words, _ = word_spans(group)
            new = met.find(words)[1]
            found, first, _, _ = ranked(words[new])
            met.put(found, 0.0)
            first = new[first]
            yield pd.DataFrame({"c": found.view(np.int64), "text": [
                joint[s:e].decode("utf-8", "replace") for s, e in zip(starts[first].tolist(), ends[first].tolist())]})


def _spelled(folder: str, shards: int, words: list[bytes]) -> np.ndarray:
    """Logarithm of each word's probability by the spelling model."""
    codes, starts = gram_codes(words)
    return _spelled_codes(folder, shards, codes, starts)


#: Spelling of the words and byte n-grams a Python worker met lately, of one model.
_SPELLED: dict[str, tuple[_Recent, _Recent]] = {}


def _recent(folder: str) -> tuple[_Recent, _Recent]:
    if folder not in _SPELLED:
        _SPELLED.clear()
        _SPELLED[folder] = _Recent(), _Recent()
    return _SPELLED[folder]


def _spelled_codes(folder: str, shards: int, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    keys = mixed(codes.astype(np.uint64) + np.uint64(1))
    logs, new = _recent(folder)[1].find(keys)
    if len(new):
        grams, first, _, rank = ranked(codes[new])
        found = np.maximum(log_probabilities(folder, shards, grams), np.log(LEAST))
        logs[new] = found[rank]
        _recent(folder)[1].put(keys[new[first]], found)
    return np.add.reduceat(logs, starts)


def _word_logs(folder: str, shards: int, joint: bytes, starts: np.ndarray, ends: np.ndarray,
               words: np.ndarray) -> np.ndarray:
    """Logarithm of the probability of each word of the texts by its spelling."""
    logs, new = _recent(folder)[0].find(words)
    if len(new):
        found, first, _, rank = ranked(words[new])
        s, e = starts[new[first]], ends[new[first]]
        spelled = _spelled_codes(folder, shards, _codes(np.frombuffer(joint, np.uint8), s, e), np.cumsum(e - s) - (e - s))
        logs[new] = spelled[rank]
        _recent(folder)[0].put(found, spelled)
    return logs


def spelling_column(folder: str, shards: int, text: Column) -> Column:
    """base: the logarithm of the text's probability word by word from their spelling
    alone; words; size in bytes.  All NULL for an empty text."""

    @F.pandas_udf("base double, words long, size long")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = np.full((len(texts), 3), np.nan)
            for rows, group in _chunks(texts.tolist()):
                joint, starts, ends, words, text = word_spans(group)
                out[rows, 0] = np.bincount(text, _word_logs(folder, shards, joint, starts, ends, words), len(group))
                out[rows, 1] = np.bincount(text, minlength=len(group))
                out[rows, 2] = [len(t) for t in group]
            yield pd.DataFrame({"base": pd.Series(out[:, 0]).astype(object).where(~np.isnan(out[:, 0]), None),
                                "words": pd.array(out[:, 1], "Int64"), "size": pd.array(out[:, 2], "Int64")})

    return score.asNondeterministic()(text)


def perplexities(docs: DataFrame, training: DataFrame) -> DataFrame:
    """doc_id, lang, perplexity per byte (NULL for an empty text) by the model of ``training`` (text)."""
    texts = [x.select("text", F.lit(k).alias("trusted"), F.lit(not k).alias("wanted"))
             for x, k in ((docs, False), (training, True))]
    return _perplexities(docs, texts[0].unionByName(texts[1]))


def _perplexities(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """``perplexities`` of ``docs``, which are the wanted ones of ``texts`` (text, trusted, wanted)."""
    spark = docs.sparkSession
    shards_path, sums_path = work_path(spark, "model_shards"), work_path(spark, "sums")
    spelled_path, since = work_path(spark, "spelled"), work_count()
    vocabulary = written(texts.where("trusted").select("text").mapInPandas(_vocabulary, "c long, text string")
                         .distinct(), "words")
    folder, shards = write_shards(train(vocabulary.select("text")), path=shards_path)
    spelled = vocabulary.select("c", F.exp(spelling_column(folder, shards, F.col("text"))["base"]).alias("p0"))
    with job_settings(spark, rows=50_000):
        spelled.write.parquet(spelled_path)
    delete_work(spark, since)
    named = docs.withColumn("t", F.xxhash64("text"))
    weight = word_sums(texts.withColumn("t", F.xxhash64("text")), spelled_path, sums_path)
    base = named.select("doc_id", "lang", "t", spelling_column(folder, shards, F.col("text")).alias("s"))
    total = F.col("s.base")
    if weight is not None:
        # equal texts have a row each in every pass
        found = (spark.read.schema("t long, more long").parquet(sums_path).groupBy("t")
                 .agg((F.sum("more") / (F.count(F.lit(1)) / PASSES)).alias("more")))
        base = base.join(found, "t", "left")
        total = total + weight * F.col("s.words") + F.coalesce(F.col("more") / SCALE, F.lit(0.0))
    return base.select("doc_id", "lang", F.exp(-total / F.col("s.size")).alias("perplexity"))


def classify_quality(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """doc_id, lang, perplexity, threshold, keep for every row of ``docs``."""
    spark = docs.sparkSession
    with job_settings(spark):
        trusted, seen = written_observed(trusted_ids(labels), "trusted_ids", ids=F.count(F.lit(1)))
        path, since = work_path(spark, "perplexities"), work_count()
        given = docs.select("doc_id", "lang", "text")
        if (seen["ids"] or 0) <= _IDS_SENT:
            marked = given.join(F.broadcast(trusted.withColumn("trusted", F.lit(True))), "doc_id", "left")
            scored = _perplexities(given, marked.select(
                "text", F.coalesce("trusted", F.lit(False)).alias("trusted"), F.lit(True).alias("wanted")))
        else:
            training = given.join(trusted, "doc_id", "left_semi").select("text")
            scored = perplexities(given, written(training, "training"))
        scored.write.parquet(path)
        delete_work(spark, since)
    scored = spark.read.schema(scored.schema).parquet(path)
    known = scored.where(F.col("perplexity").isNotNull()).join(trusted, "doc_id", "left_semi")
    top = F.percentile_approx("perplexity", quantile, 10_000)
    by_language = known.groupBy(F.col("lang").alias("l")).agg(top.alias("own"))
    overall = known.agg(top.alias("all")).first()["all"]
    threshold = F.coalesce("own", F.lit(overall).cast("double"))
    return (scored.join(by_language, F.col("lang").eqNullSafe(F.col("l")), "left")
            .select("doc_id", "lang", "perplexity", threshold.alias("threshold"))
            .withColumn("keep", F.col("perplexity").isNotNull()
                        & F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))))
