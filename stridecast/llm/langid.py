"""Language identification by averaged hashed subword embeddings and a linear softmax.

Subwords are byte n-grams, with a space wherever white space stands, hashed into
buckets. A text is the average of its subwords' embeddings; a softmax layer gives
the languages. Both are fitted by stochastic gradient descent in numpy on a
bounded sample (``rows_per_lang`` rows of each of ``max_langs`` languages at most).
A part of the sample is held back to calibrate the probabilities by a temperature
and to find the score under which a prediction is rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stridecast.llm.text import _WHITE, bytes_of, pieces_of

ORDERS = (2, 3)
UNKNOWN = "und"
#: The largest hash of a row: 63 bits.
_MOST = (1 << 63) - 1


@dataclass
class LanguageModel:
    langs: list[str]
    table: np.ndarray  # bucket x language: embedding times softmax weights
    bias: np.ndarray
    temperature: float
    least: float  # scores under this are rejected


def _buckets(data: np.ndarray, order: int, bits: int) -> np.ndarray:
    n = len(data) - order + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    code = np.full(n, order, np.uint32)
    for i in range(order):
        code = (code ^ data[i : i + n]) * np.uint32(0x01000193)
    code = (code ^ (code >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return (code >> np.uint32(32 - bits)).astype(np.int64)


def _plain(data: np.ndarray) -> np.ndarray:
    return np.where(_WHITE[data], np.uint8(32), data)


def _features(bits: int):
    """lang and hash, then the buckets that occur and how often, as bytes; rows that repeat, once for each task."""

    def run(batches):
        seen: set = set()
        for batch in batches:
            names = list(zip(batch.column("lang").to_pylist(), batch.column("at").to_pylist(), strict=True))
            new = [name not in seen and not seen.add(name) for name in names]
            batch = batch.filter(pa.array(new, pa.bool_()))
            for part in pieces_of(batch, "text"):
                data, at = bytes_of(part.column("text"), lower=True)
                rows = []
                for a, b in zip(at[:-1], at[1:], strict=True):
                    found = np.concatenate([_buckets(_plain(data[a:b]), k, bits) for k in ORDERS])
                    bucket, count = np.unique(found, return_counts=True)
                    rows.append((bucket.astype("<i4").tobytes(), count.astype("<f4").tobytes()))
                columns = [pa.array(x, pa.binary()) for x in zip(*rows, strict=True)]
                yield pa.record_batch([part.column("lang"), part.column("at"), *columns], ["lang", "at", "b", "c"])

    return run


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _fit(rows: list, langs: list[str], bits: int, width: int, epochs: int, rate: float) -> LanguageModel:
    rng = np.random.default_rng(7)
    embed = rng.normal(0, 0.1, (1 << bits, width)).astype(np.float32)
    weight = rng.normal(0, 0.1, (width, len(langs))).astype(np.float32)
    bias = np.zeros(len(langs), np.float32)
    code = {lang: i for i, lang in enumerate(langs)}
    items = []
    for row in rows:
        bucket, count = np.frombuffer(row["b"], "<i4"), np.frombuffer(row["c"], "<f4")
        if len(bucket):
            items.append((code[row["lang"]], bucket, count / count.sum()))
    order = rng.permutation(len(items))
    cut = max(1, len(items) * 4 // 5)
    fit, held = order[:cut], order[cut:]
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(fit).tolist():
            lang, bucket, share = items[i]
            mean = share @ embed[bucket]
            wrong = _softmax(mean @ weight + bias)
            wrong[lang] -= 1
            back = weight @ wrong
            weight -= step * np.outer(mean, wrong)
            bias -= step * wrong * 0.1
            # Subwords are rare in a text: their share is scaled up so that each moves.
            embed[bucket] -= (step * np.sqrt(share))[:, None] * back[None, :]
    table = embed @ weight
    logits = np.array([share @ table[bucket] + bias for _, bucket, share in (items[i] for i in held)]).reshape(-1, len(langs))
    truth = np.array([items[i][0] for i in held], int)
    heat, least = 1.0, 0.0
    if len(truth):
        grid = np.geomspace(0.05, 20, 60)
        loss = [-np.log(_softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in grid]
        heat = float(grid[int(np.argmin(loss))])
        sure = _softmax(logits / heat)
        right = sure.max(axis=1)[sure.argmax(axis=1) == truth]
        # Half the least score of a right answer held back: such texts are kept with room to spare.
        least = min(0.5, float(right.min()) / 2) if len(right) else 0.0
    return LanguageModel(langs, table, bias, heat, least)


def train(
    docs: DataFrame,
    learn: Column | None = None,
    rows_per_lang: int = 600,
    max_langs: int = 256,
    bits: int = 15,
    width: int = 16,
    epochs: int = 6,
    rate: float = 0.5,
) -> LanguageModel | None:
    """A model from rows with text and lang for which ``learn`` holds; None if there are none.

    The sample of a language is the ``rows_per_lang`` rows with the least hashes of ``doc_id`` and text, so it is the
    same on every run and spread over the table. Rows that repeat both (or have no id and one text) are one
    row of it. If there are more than ``max_langs`` languages, the most frequent count.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    if learn is not None:
        rows = rows.where(learn)
    rows = rows.select("lang", "text", F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 1).alias("at"))
    cuts = _cuts(rows, rows_per_lang, max_langs)
    if not cuts:
        return None
    sample = rows.where(F.col("at") <= _by_lang(cuts)).mapInArrow(_features(bits), "lang string, at bigint, b binary, c binary")
    first = sample.groupBy("lang", "at").agg(F.first("b").alias("b"), F.first("c").alias("c"))
    found = sorted(first.collect(), key=lambda r: (r["lang"], r["at"]))  # no more than the sample
    return _fit(found, sorted(cuts), bits, width, epochs, rate)


def _by_lang(numbers: dict[str, int]) -> Column:
    out = F.lit(-1)
    for lang, number in numbers.items():
        out = F.when(F.col("lang") == lang, number).otherwise(out)
    return out


def _share(rows: int, distinct: int, spare: float) -> int:
    """The hash (63 bits) below which ``spare`` times as many of the ``distinct`` ones lie as are wanted."""
    return int(min(1.0, spare * rows / max(distinct, 1)) * (_MOST + 1)) if spare * rows < distinct else _MOST


def _cuts(rows: DataFrame, rows_per_lang: int, max_langs: int) -> dict[str, int]:
    """For each language the hash of the last row of its sample.

    A sketch tells how many different rows there are about, so few hashes have to be put in order; each task
    gives out its least ones only. Should they be too few after all, a larger share is taken.
    """
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("at").alias("distinct"))
    distinct = {r["lang"]: r["distinct"] for r in sizes.orderBy(F.desc("n"), "lang").limit(max_langs).collect()}
    cuts, spare = {}, 4.0
    while open_langs := [lang for lang in distinct if lang not in cuts]:
        shares = {lang: _share(rows_per_lang, distinct[lang], spare) for lang in open_langs}
        near = rows.where(F.col("at") <= _by_lang(shares)).select("lang", "at").distinct()
        nth = F.row_number().over(Window.partitionBy("lang").orderBy("at"))
        last = near.withColumn("nth", nth).where(F.col("nth") <= rows_per_lang).groupBy("lang").agg(F.max("nth").alias("n"), F.max("at").alias("at"))
        for row in last.collect():
            if row["n"] == rows_per_lang or shares[row["lang"]] == _MOST:
                cuts[row["lang"]] = row["at"]
        spare *= 8
    return cuts


def _scores(part: pa.RecordBatch, model: LanguageModel) -> np.ndarray:
    data, at = bytes_of(part.column("text"), lower=True)
    data = _plain(data)
    bits = int(np.log2(len(model.table)))
    total = np.zeros((len(at) - 1, len(model.langs)))
    count = np.zeros(len(at) - 1)
    for order in ORDERS:
        found = _buckets(data, order, bits)
        # Subwords that would run into the next text lie beyond ``last``.
        first = np.minimum(at[:-1], len(found))
        last = np.clip(at[1:] - order + 1, first, len(found))
        count += last - first
        for k in range(len(model.langs)):
            sums = np.concatenate([[0.0], np.cumsum(model.table[:, k][found], dtype=np.float64)])
            total[:, k] += sums[last] - sums[first]
    mean = total / np.maximum(count, 1)[:, None]
    return _softmax((mean + model.bias) / model.temperature)


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """All columns, with ``lang_pred``, ``lang_score`` (0 to 1) and ``lang_rejected`` added or replaced.

    Only ``text`` is read. Null texts and texts without a letter are ``und`` with
    score 0 and rejected, and so is every text without a model. Otherwise the most
    likely language is given, rejected if its calibrated probability is under the
    model's limit. Repeated rows get the same answer; an empty table gives none.
    """
    new = {"lang_pred": pa.string(), "lang_score": pa.float64(), "lang_rejected": pa.bool_()}
    kept = [c for c in docs.columns if c not in new]
    schema = docs.select(*kept, F.lit("").alias("lang_pred"), F.lit(0.0).alias("lang_score"), F.lit(True).alias("lang_rejected")).schema

    def run(batches):
        import regex

        letter = regex.compile(r"\p{L}").search
        for batch in batches:
            for part in pieces_of(batch, "text"):
                known = np.array([bool(t) and letter(t) is not None for t in part.column("text").to_pylist()], bool)
                names, score = np.full(len(known), UNKNOWN, object), np.zeros(len(known))
                if model is not None and known.any():
                    sure = _scores(part, model)
                    best = sure.argmax(axis=1)
                    names[known] = np.array(model.langs, object)[best[known]]
                    score[known] = sure.max(axis=1)[known]
                rejected = ~known | (score < (model.least if model else 1.0))
                columns = [part.column(c) for c in kept] + [pa.array(names, pa.string()), pa.array(score), pa.array(rejected)]
                yield pa.record_batch(columns, [*kept, *new])

    return docs.select(*kept).mapInArrow(run, schema)
