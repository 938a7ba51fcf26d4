"""A hidden Markov language model trained by Baum-Welch over partitions.

The ``own`` most frequent words are symbols of their own; every other word is a
symbol with the words that end in the same three bytes (a class of them). A state
gives a symbol, and the symbol a word by the word's share of its class, one
unknown word in each class included; so the model is a distribution over texts.

Word counts of the whole corpus are summed by Spark. The ``top`` most frequent
words with their counts go to every task (a bounded table); the counts of all
other words meet the documents that hold them in a join. Expected counts of
Baum-Welch are summed by Spark, one row for each symbol. Words are known by a
64-bit hash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridecast.llm.text import RollingHash, bytes_of, mix, pieces_of, words_of
from stridecast.scratch import written

CLASS_BITS = 10
CLASSES = 1 << CLASS_BITS
#: Tokens between two ends of the sequences that Baum-Welch reads: whole texts, cut into such stretches.
STRETCH = 128
_HASH = RollingHash(5)
ENCODED = (
    "rid bigint, doc_id bigint, learn boolean, n_tokens bigint, top_known bigint, log_own double, log_top double, "
    "log_class double, symbols binary, n_rare bigint, rare array<bigint>, rare_n array<bigint>"
)


@dataclass
class Vocabulary:
    words: np.ndarray  # hashes of the top words, sorted
    counts: np.ndarray
    symbols: np.ndarray  # their symbols
    own: int
    ends: int  # training texts
    total: int  # training tokens, ends included
    distinct: int  # distinct training tokens, the end included
    class_total: np.ndarray  # of the words that are not symbols of their own, with 0.5 for each and for an unknown one
    frequency: np.ndarray  # of symbols

    @property
    def size(self) -> int:
        return self.own + CLASSES + 1

    @property
    def log_room(self) -> float:
        return float(np.log10(self.total + 0.5 * (self.distinct + 1)))


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, its class in the lowest bits; and the number of words before each text."""
    data, at = bytes_of(texts, lower=True)
    begin, end, before = words_of(data, at)
    named = _HASH.of(_HASH.prefix_bytes(data), begin, end)
    tail = np.zeros(len(begin), np.uint64)
    for i in (1, 2, 3):
        place = end - i
        tail = tail * np.uint64(256) + np.where(place >= begin, data[np.maximum(place, 0)], 0).astype(np.uint64) if len(data) else tail
    kind = mix(tail) & np.uint64(CLASSES - 1)
    return ((named & ~np.uint64(CLASSES - 1)) | kind).view(np.int64), before


def _summed(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(words, kind="stable")
    words, counts = words[order], counts[order]
    if not len(words):
        return words, counts
    first = np.flatnonzero(np.concatenate([[True], np.diff(words) != 0]))
    return words[first], np.add.reduceat(counts, first)


def _count(batches):
    """Words and their counts, summed over as much of a task as a million words hold."""
    held: list = []
    size = 0
    for batch in batches:
        for part in pieces_of(batch, "text"):
            words, _ = _tokens(part.column("text"))
            held.append(_summed(words, np.ones(len(words), np.int64)))
            size += len(held[-1][0])
            if size > 1_000_000:
                merged = _summed(*(np.concatenate(x) for x in zip(*held, strict=True)))
                held, size = [merged], len(merged[0])
                if size > 500_000:
                    yield pa.record_batch([pa.array(x) for x in merged], ["w", "n"])
                    held, size = [], 0
    if held:
        merged = _summed(*(np.concatenate(x) for x in zip(*held, strict=True)))
        yield pa.record_batch([pa.array(x) for x in merged], ["w", "n"])


def _crossing(rows: DataFrame, part: Column, wanted: int, first: bool = False) -> tuple[int | None, int]:
    """The value of ``part`` (few different ones) at which ``wanted`` rows are reached, from the highest down or
    the lowest up, and how many of them are left for its own rows. None if there are not so many rows."""
    sizes = rows.groupBy(part.cast("bigint").alias("part")).count().collect()
    for value, n in sorted(sizes, reverse=not first):
        if n >= wanted:
            return value, wanted
        wanted -= n
    return None, wanted


def most_frequent(counts: DataFrame, top: int) -> DataFrame:
    """The ``top`` rows of ``counts`` (w, c; c from 1 up) with the highest c, those with the least w of equals.

    Histograms find how far down they go: by the bits of c, then within these, then by w among equal ones. So hardly
    more rows than wanted are put in order, however many tasks hold them.
    """
    bits, left = _crossing(counts, F.length(F.bin("c")), top)
    if bits is None:
        return counts
    low = 1 << (bits - 1)
    step = max(1, low >> 12)
    part = F.floor((F.col("c") - low) / step)
    own = counts.where(F.col("c").between(low, 2 * low - 1))
    at, left = _crossing(own, part, left)
    least, above = low + at * step, low + (at + 1) * step
    near = F.col("c") >= above
    if step == 1:
        edge, _ = _crossing(counts.where(F.col("c") == least), F.shiftright("w", 52), left, first=True)
        near = near | ((F.col("c") == least) & (F.shiftright("w", 52) <= edge))
    else:
        near = near | (F.col("c") >= least)
    return counts.where(near).orderBy(F.desc("c"), "w").limit(top)


def vocabulary(rows: DataFrame, top: int, own: int) -> tuple[Vocabulary, DataFrame]:
    """What tasks need to know of the training texts' words, and the whole table of words with counts (w, c)."""
    learn = rows.where("learn")
    counts = learn.select("text").mapInArrow(_count, "w bigint, n bigint").groupBy("w").agg(F.sum("n").alias("c"))
    counts = written(counts, "word-counts")
    ends = learn.count()
    kinds = counts.groupBy(F.pmod("w", F.lit(CLASSES)).cast("int").alias("kind")).agg(F.sum("c"), F.count("*")).collect()
    found = most_frequent(counts, top).orderBy(F.desc("c"), "w").toArrow()
    words, count = found.column("w").to_numpy(), found.column("c").to_numpy()
    own = min(own, len(words))
    symbols = np.where(np.arange(len(words)) < own, np.arange(len(words)), own + (words & (CLASSES - 1)))
    mass, distinct = np.zeros(CLASSES), np.zeros(CLASSES)
    for kind, c, n in kinds:
        mass[kind], distinct[kind] = c, n
    np.subtract.at(mass, words[:own] & (CLASSES - 1), count[:own])
    np.subtract.at(distinct, words[:own] & (CLASSES - 1), 1)
    total = int(sum(c for _, c, _ in kinds)) + ends
    order = np.argsort(words, kind="stable")
    return (
        Vocabulary(
            words[order],
            count[order],
            symbols[order].astype(np.int64),
            own,
            ends,
            total,
            int(sum(n for *_, n in kinds)) + (ends > 0),
            mass + 0.5 * distinct + 0.5,
            np.concatenate([count[:own], mass, [ends]]).astype(np.float64),
        ),
        counts,
    )


def _encoder(vocab: Vocabulary):
    log_class = np.log10(vocab.class_total)

    def run(batches):
        known = len(vocab.words)
        log_top = np.log10(vocab.counts + 0.5)
        end = np.log10(vocab.ends + 0.5)
        for batch in batches:
            for part in pieces_of(batch, "text"):
                words, at = _tokens(part.column("text"))
                place = np.minimum(np.searchsorted(vocab.words, words), max(known - 1, 0))
                is_top = (vocab.words[place] == words) if known else np.zeros(len(words), bool)
                symbol = vocab.own + (words & (CLASSES - 1))
                logs = np.zeros(len(words))
                if known:
                    symbol = np.where(is_top, vocab.symbols[place], symbol)
                    logs = np.where(is_top, log_top[place], 0.0)
                is_own = symbol < vocab.own
                in_class = np.where(is_own, 0.0, log_class[words & (CLASSES - 1)])

                def sums(values, at=at):
                    upto = np.concatenate([[0], np.cumsum(values)])
                    return upto[at[1:]] - upto[at[:-1]]

                rare, ids, counts, bytes_ = [], [], [], []
                short = symbol.astype("<u2")
                for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                    w, n = np.unique(words[a:b][~is_top[a:b]], return_counts=True)
                    rare.append(int(n.sum()))
                    ids.append(w)
                    counts.append(n)
                    bytes_.append(short[a:b].tobytes() + np.array([vocab.size - 1], "<u2").tobytes())
                edges = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                columns = [
                    part.column("rid"),
                    part.column("doc_id"),
                    part.column("learn"),
                    pa.array(np.diff(at) + 1),
                    pa.array(sums(is_top.astype(np.int64)) + (vocab.ends > 0)),
                    pa.array(sums(np.where(is_own, logs, 0.0)) + end),
                    pa.array(sums(np.where(is_own, 0.0, logs))),
                    pa.array(sums(in_class)),
                    pa.array(bytes_, pa.binary()),
                    pa.array(rare, pa.int64()),
                    pa.ListArray.from_arrays(edges, np.concatenate(ids).astype(np.int64)),
                    pa.ListArray.from_arrays(edges, np.concatenate(counts).astype(np.int64)),
                ]
                yield pa.record_batch(columns, [c.strip().split(" ")[0] for c in ENCODED.split(",")])

    return run


@dataclass
class Model:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # symbol x state


def _first_model(vocab: Vocabulary, states: int) -> Model:
    rng = np.random.default_rng(3)
    share = (vocab.frequency + 0.5) / (vocab.frequency + 0.5).sum()
    emit = share[:, None] * rng.uniform(0.5, 1.5, (vocab.size, states))
    move = np.full((states, states), 0.05 / max(states - 1, 1))
    np.fill_diagonal(move, 0.95 if states > 1 else 1.0)
    return Model(np.full(states, 1 / states), move, emit / emit.sum(axis=0))


def _stretches(parts: list[np.ndarray], limit: int):
    """Groups of at most ``limit`` tokens, as stretches sorted by length."""
    cut = [p[i : i + STRETCH] for p in parts for i in range(0, len(p), STRETCH)]
    step = max(1, limit // STRETCH)
    for a in range(0, len(cut), step):
        yield sorted(cut[a : a + step], key=len, reverse=True)


def expected_counts(model: Model, cut: list[np.ndarray], emitted: np.ndarray, moved: np.ndarray, started: np.ndarray) -> None:
    """Add the expected counts of stretches (longest first) by scaled forward and backward recursions."""
    lengths = np.array([len(x) for x in cut])
    steps = int(lengths[0])
    active = np.searchsorted(-lengths, -np.arange(1, steps + 1), "right")
    padded = np.zeros((len(cut), steps), np.int64)
    padded[np.arange(steps)[None, :] < lengths[:, None]] = np.concatenate(cut)
    states = len(model.start)
    emit, move = model.emit.astype(np.float32), model.move.astype(np.float32)
    forward = np.zeros((steps, len(cut), states), np.float32)
    given = [emit[padded[: active[t], t]] for t in range(steps)]
    now = model.start.astype(np.float32) * given[0]
    forward[0] = now / now.sum(axis=1, keepdims=True)
    for t in range(1, steps):
        n = active[t]
        now = (forward[t - 1, :n] @ move) * given[t]
        forward[t, :n] = now / now.sum(axis=1, keepdims=True)
    back = np.ones((len(cut), states), np.float32)
    seen = np.zeros((steps, len(cut), states), np.float32)
    for t in range(steps - 1, -1, -1):
        n = active[t]
        both = forward[t, :n] * back[:n]
        scale = both.sum(axis=1, keepdims=True)
        seen[t, :n] = both / scale
        if t:
            ahead = given[t] * back[:n]
            # Expected moves from t - 1 to t: each row sums to one.
            prior = forward[t - 1, :n]
            weight = ((prior @ move) * ahead).sum(axis=1, keepdims=True)
            moved += move * (prior.T @ (ahead / weight))
            back[:n] = ahead @ move.T
            back[:n] /= back[:n].max(axis=1, keepdims=True)
    started += seen[0].sum(axis=0)
    here = np.arange(len(cut))[None, :] < active[:, None]
    symbols, weights = padded.T[here], seen[here]
    for k in range(states):
        emitted[:, k] += np.bincount(symbols, weights[:, k], minlength=len(emitted))


def _expect(model: Model):
    def run(batches):
        states = len(model.start)
        emitted, moved, started = np.zeros_like(model.emit), np.zeros((states, states)), np.zeros(states)
        for batch in batches:
            held, size = [], 0
            for value in batch.column("symbols").to_pylist():
                held.append(np.frombuffer(value, "<u2"))
                size += len(held[-1])
                if size > 1 << 17:
                    for cut in _stretches(held, 1 << 17):
                        expected_counts(model, cut, emitted, moved, started)
                    held, size = [], 0
            for cut in _stretches(held, 1 << 17):
                expected_counts(model, cut, emitted, moved, started)
        # Rows -1 and below: the start and the moves.
        rows = np.concatenate([emitted, started[None, :], moved])
        number = np.concatenate([np.arange(len(emitted)), -1 - np.arange(states + 1)])
        kept = rows.sum(axis=1) > 0
        yield pa.record_batch(
            [pa.array(number[kept]), *(pa.array(rows[kept, k]) for k in range(states))], ["row", *(f"s{k}" for k in range(states))]
        )

    return run


def baum_welch(encoded: DataFrame, vocab: Vocabulary, states: int, rounds: int, weight: float = 50.0) -> Model:
    """A model after ``rounds`` rounds over all training texts.

    A state's symbol shares lean on the corpus' shares with the weight of ``weight`` tokens.
    """
    model = _first_model(vocab, states)
    share = (vocab.frequency + 0.5) / (vocab.frequency + 0.5).sum()
    names = [f"s{k}" for k in range(states)]
    symbols = encoded.where("learn").select("symbols")
    for _ in range(rounds):
        parts = symbols.mapInArrow(_expect(model), "row bigint, " + ", ".join(f"{n} double" for n in names))
        # One row for each symbol and state: the size of the model.
        found = parts.groupBy("row").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
        rows = np.zeros((vocab.size + states + 1, states))
        place = found.column("row").to_numpy()
        place = np.where(place >= 0, place, vocab.size - 1 - place)
        if not len(place):
            break
        rows[place] = np.stack([found.column(n).to_numpy() for n in names], axis=1)
        emitted = rows[: vocab.size] + weight * share[:, None]
        started, moved = rows[vocab.size] + 1, rows[vocab.size + 1 :] + 1
        model = Model(started / started.sum(), moved / moved.sum(axis=1, keepdims=True), emitted / emitted.sum(axis=0))
    return model


def log_likelihoods(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    """log10 of each whole sequence's probability, by the scaled forward recursion, all sequences side by side."""
    lengths = np.array([len(x) for x in texts])
    order = np.argsort(-lengths, kind="stable")
    flat = np.concatenate([texts[i] for i in order]).astype(np.int64)
    lengths = lengths[order]
    begin = np.cumsum(lengths) - lengths
    active = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), "right")
    out = np.zeros(len(texts))
    now = model.start * model.emit[flat[begin]]
    for t in range(1, int(lengths[0])):
        n = active[t]
        if n < len(now):
            out[order[n : len(now)]] += np.log10(now[n:].sum(axis=1))
            now = now[:n]
        now = (now @ model.move) * model.emit[flat[begin[:n] + t]]
        if t % 8 == 0:
            scale = now.sum(axis=1)
            out[order[:n]] += np.log10(scale)
            now /= scale[:, None]
    out[order[: len(now)]] += np.log10(now.sum(axis=1))
    return out


def _likelihood(model: Model):
    def run(batches):
        for batch in batches:
            values = [np.frombuffer(v, "<u2") for v in batch.column("symbols").to_pylist()]
            ends = np.cumsum([len(v) for v in values])
            found, a = [], 0
            while a < len(values):
                past = ends[a - 1] if a else 0
                b = max(a + 1, int(np.searchsorted(ends, past + (1 << 21), "right")))
                found.append(log_likelihoods(model, values[a:b]))
                a = b
            if found:
                kept = [batch.column(c) for c in batch.schema.names if c != "symbols"]
                names = [c for c in batch.schema.names if c != "symbols"]
                yield pa.record_batch([*kept, pa.array(np.concatenate(found))], [*names, "log_symbols"])

    return run


def score_texts(
    docs: DataFrame, learn: Column, states: int = 8, rounds: int = 4, top: int = 1 << 18, own: int = 8192
) -> DataFrame:
    """doc_id, learn, n_tokens, n_known, train_tokens, base_score, score for every row.

    Tokens are words between ASCII white space in lower case (A-Z) and one end for each text. ``learn``
    is an expression over ``doc_id`` that marks the rows to learn from (null: learnt from). ``base_score`` is the log10
    probability under smoothed word counts, ``score`` under the hidden Markov model.

    Null and empty texts are one end. Ids may be null. Rows that repeat each get a row; each is learnt from.
    Other columns are not read. An empty table gives no rows; with nothing to learn from every word is unknown.
    """
    if not 0 < own <= top or own + CLASSES + 1 > 1 << 16:
        raise ValueError("symbols are numbered in 16 bits, and those with a word of their own are top words")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.xxhash64("doc_id", text).alias("rid"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(learn, F.lit(True)).alias("learn"),
        text.alias("text"),
    )
    vocab, counts = vocabulary(rows, top, own)
    encoded = written(rows.mapInArrow(_encoder(vocab), ENCODED), "encoded")
    # Words outside the bounded table meet their counts; the sums go back by row.
    rare = encoded.where("n_rare > 0").select("rid", F.explode(F.arrays_zip("rare", "rare_n")).alias("x"))
    rare = rare.select("rid", F.col("x.rare").alias("w"), F.col("x.rare_n").alias("n"))
    count = F.coalesce("c", F.lit(0))
    sums = (
        rare.join(counts, "w", "left")
        .groupBy("rid")
        .agg(
            F.sum(F.col("n") * F.log10(count + 0.5)).alias("log_rare"),
            F.sum(F.when(count > 0, F.col("n")).otherwise(0)).alias("rare_known"),
            F.sum("n").alias("rare_all"),
        )
    )
    model = baum_welch(encoded, vocab, states, rounds)
    plain = [c.strip().split(" ")[0] for c in ENCODED.split(",") if "rare array" not in c and "rare_n" not in c]
    scored = encoded.select(*plain).mapInArrow(
        _likelihood(model),
        ", ".join(c for c in ENCODED.split(", ") if c.split(" ")[0] not in ("symbols", "rare", "rare_n")) + ", log_symbols double",
    )
    # Equal rows share a ``rid`` and were summed together: their share is one of so many.
    copies = F.coalesce(F.col("rare_all") / F.col("n_rare"), F.lit(1.0))
    log_rare = F.coalesce(F.col("log_rare") / copies, F.lit(0.0))
    known = F.coalesce((F.col("rare_known") / copies).cast("bigint"), F.lit(0))
    logs = F.col("log_own") + F.col("log_top") + log_rare
    return scored.join(sums, "rid", "left").select(
        "doc_id",
        "learn",
        "n_tokens",
        (F.col("top_known") + known).alias("n_known"),
        F.lit(vocab.total).cast("bigint").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.lit(vocab.log_room)).alias("base_score"),
        (F.col("log_symbols") + F.col("log_top") + log_rare - F.col("log_class")).alias("score"),
    )
