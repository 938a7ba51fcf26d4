"""Spelling variants: words one edit apart, by composing acceptor, one-edit transducer and acceptor.

An edit falls into the first or the second half of a word, and the other half stays. So
the vocabulary's acceptor is cut into parts: all words of length L (and those longer by one)
that agree outside the places [a, b) of the edit. Each part is minimised, composed and
enumerated by itself. Parts with more than ``most`` words are cut in halves of [a, b)
again; with one place left a part holds few words, whatever the size of the vocabulary.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridecast.llm.acceptor import Acceptor, near_pairs
from stridecast.scratch import written

#: The letters of words, and those that are lower-cased.
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ("len", "a", "b", "head", "tail")
FOUND = "word string, near bigint, best string, best_n bigint"


def runs(docs: DataFrame) -> DataFrame:
    """doc_id and run of every run of letters in the texts, A-Z in lower case."""
    text = F.translate(F.col("text").cast("string"), UPPER, LOWER)
    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("run"))


def misspelt(found: DataFrame, divisor: int = 97) -> DataFrame:
    """word: the runs, one code point deleted where ``divisor`` divides the crc32 of ``doc_id:run``. No id: an empty one."""
    named = F.concat(F.coalesce("doc_id", F.lit("")), F.lit(":"), F.col("run"))
    marked = found.select("run", F.crc32(named.cast("binary")).alias("h"))
    at = F.col("h") % F.char_length("run")
    less = F.concat(F.substr("run", F.lit(1), at.cast("int")), F.substr("run", (at + 2).cast("int")))
    return marked.select(F.when(F.col("h") % divisor == 0, less).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, least_chars: int, least: int) -> DataFrame:
    """word and n (occurrences) of the words that are long and frequent enough."""
    counts = words.where(F.char_length("word") >= least_chars).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= least)


def _keyed(words: DataFrame) -> DataFrame:
    """The words under what stays outside [a, b): words of length ``len`` whole, those longer by one with a place more."""
    more = F.char_length("word") - F.col("len")
    middle = F.substr("word", F.col("a") + 1, F.col("b") - F.col("a") + more)
    head, tail = F.substr("word", F.lit(1), F.col("a")), F.substr("word", F.col("b") + more + 1)
    return words.select("len", "a", "b", head.alias("head"), tail.alias("tail"), middle.alias("middle"), "word", "n")


def _halves(words: DataFrame, least_chars: int) -> DataFrame:
    """Every word among those of its length and, as the longer one, among those shorter by one; both halves."""
    size = F.char_length("word")
    lengths = F.filter(F.array(size, size - 1), lambda x: x >= least_chars)
    each = words.withColumn("len", F.explode(lengths))
    half = F.floor(F.col("len") / 2).cast("int")
    sides = F.array(F.struct(F.lit(0).alias("a"), half.alias("b")), F.struct(half.alias("a"), F.col("len").alias("b")))
    return _keyed(each.withColumn("side", F.explode(sides)).select("word", "n", "len", "side.a", "side.b"))


def _cut(crowded: DataFrame) -> DataFrame:
    """The words of crowded parts in parts with half the places. A part with one place stays."""
    middle = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
    sides = F.array(F.struct("a", middle.alias("b")), F.struct(middle.alias("a"), "b"))
    return _keyed(crowded.withColumn("side", F.explode(sides)).select("word", "n", "len", "side.a", "side.b"))


def _settled(middles: dict[str, tuple[str, int]], size: int, open_end: bool) -> list[tuple[str, int, str, int]]:
    """Of the words of a part that have near words there: how many, and the most frequent (the smallest of equals)."""
    found: dict[str, list] = {}
    for one, two in near_pairs(Acceptor(sorted(middles)), size, open_end):
        for x, y in ((one, two), (two, one)):
            word, n = middles[y]
            held = found.get(x)
            if held is None:
                found[x] = [1, word, n]
            else:
                held[0] += 1
                if n > held[2] or n == held[2] and word < held[1]:
                    held[1:] = word, n
    return [(middles[x][0], *held) for x, held in found.items()]


def _compose(batches):
    """Rows of a part follow each other."""
    names = [c.split(" ")[0] for c in FOUND.split(", ")]
    types = [pa.string(), pa.int64(), pa.string(), pa.int64()]

    def shown(rows):
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    now, middles, out = None, {}, []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in (*KEY, "middle", "word", "n")]
        for *key, middle, word, n in zip(*columns, strict=True):
            if key != now:
                if len(middles) > 1:
                    out += _settled(middles, now[2] - now[1], now[0] == now[2])
                    if len(out) > 10_000:
                        yield shown(out)
                        out = []
                now, middles = key, {}
            middles[middle] = (word, n)
    if len(middles) > 1:
        out += _settled(middles, now[2] - now[1], now[0] == now[2])
    if out:
        yield shown(out)


def near_words(words: DataFrame, least_chars: int, most: int = 20_000) -> DataFrame:
    """word, near, best, best_n of every part in which a word (word, n; distinct) has near words."""
    parts, found = _halves(words, least_chars), None
    while True:
        crowded = parts.groupBy(*KEY).count().where((F.col("count") > most) & (F.col("b") - F.col("a") > 1)).select(*KEY)
        crowded = written(crowded, "crowded-parts")
        any_crowded = not crowded.isEmpty()
        small = parts.join(crowded, [*KEY], "left_anti") if any_crowded else parts
        pairs = small.repartition(*KEY).sortWithinPartitions(*KEY).mapInArrow(_compose, FOUND)
        found = pairs if found is None else found.unionByName(pairs)
        if not any_crowded:
            return found
        parts = written(_cut(parts.join(crowded, [*KEY], "left_semi")), "parts")


def _roots(forms: DataFrame) -> DataFrame:
    """word and root of the words with a form, by following twice as many forms in each round."""
    links = forms
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = written(links.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), "further"), "roots")
        if links.where("further IS NOT NULL").isEmpty():
            return links.select("word", "root")
        links = links.select("word", "root")


def variants(words: DataFrame, least_chars: int = 5, most: int = 20_000) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of a vocabulary (word, n; distinct words of ``least_chars`` or more).

    Near words differ by one inserted, deleted or replaced code point. A word's form is its near word of the largest
    n (the smallest of equals in code-point order), if that is twice the word's n or more; else null. The root is
    what following forms ends at, the word itself without a form.
    """
    best = F.min_by(F.struct("best", "best_n"), F.struct(-F.col("best_n"), F.col("best")))
    near = near_words(words, least_chars, most).groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("top"))
    known = words.join(near, "word", "left")
    is_form = F.col("top.best_n") >= 2 * F.col("n")
    known = known.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("top.best")).alias("form"),
        F.when(is_form, F.col("top.best_n")).alias("form_n"),
    )
    known = written(known, "word-forms")
    roots = _roots(known.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return known.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, least_chars: int = 5, least: int = 3, divisor: int = 97) -> DataFrame:
    """``variants`` of the words in the whole texts of ``docs``.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF, only A-Z in lower case; where ``divisor`` divides the crc32 of
    ``doc_id:run``, one code point of the run is deleted. They count from ``least_chars`` code points and ``least``
    occurrences on. Null and empty texts hold no words, a null id reads as an empty one, rows that repeat each
    count, other columns are not read. An empty table gives no rows.
    """
    words = written(vocabulary(misspelt(runs(docs), divisor), least_chars, least), "vocabulary")
    return variants(words, least_chars)
