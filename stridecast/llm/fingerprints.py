"""SimHash fingerprints of documents in column expressions, and search within a Hamming radius.

Every word votes on 64 bits with the bits of its hash, weighted by its length,
since long words are rare ones. Votes are added up two bits to a sum: bit j in
the low and bit j + 32 in the high half of a bigint, 32 sums for 64 bits.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stridecast.scratch import written

#: Texts are cut into words here; words of three letters or fewer have the weight 1.
SEPARATORS = r"[\x20\x09-\x0D]+"
_PAIR = (1 << 32) + 1
_SUMS = [f"_v{j}" for j in range(32)]
#: A document, by order.
KEY = ["named", "at", "head", "hash"]
#: Copies of one document that a task gives rows at a time.
COPIES = 1 << 16


def _votes() -> list[Column]:
    """Sums over rows with ``word``; an empty word has no vote. Weights are cut at 255, so a sum holds 8 million words."""
    weight = F.when(F.col("word") == "", 0).otherwise(F.greatest(F.least(F.length("word"), F.lit(255)) - 3, F.lit(1)))
    weight = weight.cast("bigint")
    bits = F.xxhash64("word")
    sums = [
        F.sum(F.shiftrightunsigned(bits, j).bitwiseAND(F.lit(_PAIR)) * weight).alias(name) for j, name in enumerate(_SUMS)
    ]
    return [*sums, F.sum(weight).alias("_weight")]


def _bits() -> Column:
    """The fingerprint from the sums: a bit is set if more than half of the weight voted for it. No word: 0."""

    def bit(j: int) -> Column:
        low = F.col(_SUMS[j % 32]).bitwiseAND(F.lit((1 << 32) - 1))
        votes = low if j < 32 else F.shiftrightunsigned(F.col(_SUMS[j - 32]), 32)
        value = 1 << j if j < 63 else -(1 << 63)
        return F.when(2 * votes > F.col("_weight"), F.lit(value).cast("bigint")).otherwise(F.lit(0).cast("bigint"))

    return reduce(lambda a, b: a.bitwiseOR(b), map(bit, range(64)))


def _words(text: str) -> Column:
    return F.explode(F.split(F.lower(F.col(text)), SEPARATORS))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with ``KEY``, which tells texts under an id apart and orders them, and their text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("bigint")
    return docs.select(
        doc_id.isNotNull().alias("named"),
        F.coalesce(doc_id, F.lit(0).cast("bigint")).alias("at"),
        F.substring(text, 1, 16).alias("head"),
        F.unhex(F.md5(text.cast("binary"))).alias("hash"),
        text.alias("text"),
    )


def _chained(rows: DataFrame, rows_per_block: int | None) -> DataFrame:
    """KEY, copies, third (of the text's code points) and the key before it as ``_named`` … (before the first: the last).

    Keys are cut into ranges of about ``rows_per_block``; only one row of each range meets the others. Without a
    number, ranges and their number both grow with the square root of the keys.
    """
    keys = rows.groupBy(*KEY).agg(
        F.count("*").alias("copies"), F.max(F.floor(F.length("text") / 3).cast("int")).alias("third")
    )
    keys = written(keys, "fingerprint-keys")
    n = keys.count()
    parts = max(1, -(-n // (rows_per_block or 8 * max(1, isqrt(n)))))
    # Written, because the ranges of a second run may be cut elsewhere.
    cut = keys.repartitionByRange(parts, *KEY).withColumn("part", F.spark_partition_id())
    keys = written(cut, "fingerprint-ranges")
    key = F.struct(*KEY)
    order = Window.orderBy("part")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = keys.groupBy("part").agg(F.max(key).alias("end"))
    ends = ends.select("part", F.coalesce(F.lag("end").over(order), F.last("end").over(whole)).alias("end"))
    within = Window.partitionBy("part").orderBy(*KEY)
    chained = keys.withColumn("before", F.lag(key).over(within)).join(ends, "part")
    before = F.coalesce("before", "end")
    chained = chained.select(*KEY, "copies", "third", *[before[c].alias(f"_{c}") for c in KEY])
    return written(chained, "fingerprint-order")


def _copied(prints: DataFrame) -> DataFrame:
    """A row for each copy, the first of a key with the text before it, the others with their own. Copies are dealt in chunks."""
    chunks = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("copies") - 1) / COPIES))
    dealt = prints.withColumn("chunk", F.explode(chunks)).repartition(*KEY, "chunk")
    start = F.col("chunk") * COPIES
    copy = F.explode(F.sequence(start, F.least(start + COPIES, F.col("copies")) - 1))
    first = F.col("copy") == 0
    return dealt.withColumn("copy", copy).select(
        F.when(F.col("named"), F.col("at")).alias("doc_id"),
        "n_chars",
        F.lower(F.hex(F.when(first, F.col("sha_1")).otherwise(F.col("sha_2")))).alias("edited_sha256"),
        F.col("fp_0").alias("fp"),
        F.when(first, F.col("fp_1")).otherwise(F.col("fp_2")).alias("edited_fp"),
        F.when(first, F.col("next_fp")).otherwise(F.col("fp_0")).alias("next_fp"),
    )


def with_edits(docs: DataFrame, rows_per_block: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fp, edited_fp, next_fp for every row.

    The edited text has its last third replaced by the beginning of the next
    document's, in descending order of ids (after the last: the first). The order is found over keys alone;
    whole texts are shuffled once, and each document sends its successor only the beginning that it needs.

    Null texts are empty; an empty text has fingerprint 0. A null id comes before all others. Rows that
    repeat an id are ordered by their first 16 characters, then by the MD5 of their text, by which texts under an id are
    told apart; rows that repeat both are worked out once and each have a row, so neither a hot id nor a hot text
    gathers anywhere. Other columns are not read. An empty table gives no rows.
    """
    rows = _keyed(docs)
    order = _chained(rows, rows_per_block)
    texts = rows.groupBy(*KEY).agg(F.first("text").alias("text"))
    to = order.select(*[F.col(f"_{c}").alias(c) for c in KEY], *[F.col(c).alias(f"to_{c}") for c in KEY], "third")
    beginnings = texts.join(to, KEY).select(
        *[F.col(f"to_{c}").alias(c) for c in KEY], F.substr("text", F.lit(1), F.col("third")).alias("next")
    )
    paired = texts.join(order.select(*KEY, "copies", "third"), KEY).join(beginnings, KEY)
    n = F.length("text")
    kept = F.substr("text", F.lit(1), n - F.col("third"))
    own = F.concat(kept, F.substr("text", F.lit(1), F.col("third")))
    bodies = F.array(F.col("text"), F.concat(kept, "next"), F.when(F.col("copies") > 1, own))
    each = paired.select(*KEY, "copies", n.cast("bigint").alias("n_chars"), F.posexplode(bodies).alias("version", "body"))
    sha = F.when(F.col("version") > 0, F.unhex(F.sha2(F.col("body").cast("binary"), 256)))
    keys = [*KEY, "copies", "n_chars", "version", "sha"]
    voted = each.where("body IS NOT NULL").withColumn("sha", sha).select(*keys, _words("body").alias("word"))
    prints = voted.groupBy(*keys).agg(*_votes()).select(*keys, _bits().alias("fp"))

    def of(version: int, name: str) -> Column:
        return F.max(F.when(F.col("version") == version, F.col(name))).alias(f"{name}_{version}")

    prints = prints.groupBy(*KEY, "copies", "n_chars").agg(*[of(v, "fp") for v in range(3)], of(1, "sha"), of(2, "sha"))
    prints = written(prints, "fingerprints")
    before = prints.select(*[F.col(c).alias(f"_{c}") for c in KEY], F.col("fp_0").alias("next_fp"))
    following = order.join(before, [f"_{c}" for c in KEY]).select(*KEY, "next_fp")
    return _copied(prints.join(following, KEY))


def with_near(found: DataFrame, asked: Column, radius: int = 3) -> DataFrame:
    """``found`` with n_near: for ``asked`` rows, the number of other rows whose ``fp`` is within ``radius`` bits, else null.

    ``found`` is read four times, so it should be a written table. Rows that share a fingerprint are counted before any join.
    """
    counts = found.groupBy("fp").agg(F.count("*").alias("n"))
    near = within_radius(counts, found.where(asked), radius, radius + 2)
    rows = counts.select(F.col("fp").alias("near_fp"), "n")
    near = near.join(rows, "near_fp").groupBy("fp").agg((F.sum("n") - 1).alias("n_near"))
    return found.join(near, "fp", "left").withColumn("n_near", F.when(asked, F.col("n_near")))


def fingerprint(docs: DataFrame) -> DataFrame:
    """doc_id, fp of every id. Null and empty texts: 0. Rows that repeat an id vote together."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    words = docs.select("doc_id", text).select("doc_id", _words("text").alias("word"))
    return words.groupBy("doc_id").agg(*_votes()).select("doc_id", _bits().alias("fp"))


def within_radius(prints: DataFrame, queries: DataFrame, radius: int = 3, blocks: int = 5) -> DataFrame:
    """fp, near_fp, distance: the distinct fingerprints of ``prints`` within ``radius`` bits of those of ``queries``.

    The 64 bits are cut into ``blocks`` blocks. If at most ``radius`` bits differ, some
    ``blocks - radius`` blocks agree: there is a table for each choice of them, filed under their
    bits. Both sides are distinct fingerprints, so copies meet once.
    """
    if not 0 <= radius < blocks:
        raise ValueError("there must be more blocks than bits that may differ")
    cuts = [64 * i // blocks for i in range(blocks + 1)]

    def mask(chosen) -> int:
        value = sum(((1 << cuts[i + 1]) - (1 << cuts[i])) for i in chosen)
        return value - (1 << 64) if value >> 63 else value

    tables = [F.struct(F.lit(i).alias("table"), F.col("fp").bitwiseAND(F.lit(mask(c)).cast("bigint")).alias("bits"))
              for i, c in enumerate(combinations(range(blocks), blocks - radius))]
    filed = prints.select("fp").distinct().select(F.col("fp").alias("near_fp"), F.inline(F.array(*tables)))
    asked = queries.select("fp").distinct().select("fp", F.inline(F.array(*tables)))
    apart = F.bit_count(F.col("fp").bitwiseXOR(F.col("near_fp")))
    return (
        asked.join(filed, ["table", "bits"])
        .select("fp", "near_fp", apart.alias("distance"))
        .where(F.col("distance") <= radius)
        .distinct()
    )
