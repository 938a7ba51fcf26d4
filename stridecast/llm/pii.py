"""Personal data: patterns propose spans, checksums confirm them, nearby words move the score.

Everything is a column expression. Starts come from the lengths of the matches
and of the text between them, so positions are code points. Patterns take
possessive runs where nothing after a run can call it back: a match is found in
time linear in the text, and no pattern recurses. Sums over the matches of a text run in
chunks, and pieces of it are cut from blocks: the time grows with the text and its matches, not with their product.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = "array<struct<kind:string,start:bigint,end:bigint,score:double,value:string>>"
NEARBY = 48  # code points before a span that are searched for context words
CHUNK = 256  # values that are summed up one by one
BLOCK = 4096  # code points of the blocks that pieces of a text are cut from


@dataclass(frozen=True)
class Kind:
    """``hint``: what a text must hold for the pattern to be tried. ``score`` plus ``lift`` with a context word."""

    name: str
    pattern: str
    hint: str
    check: object = None
    score: float = 0.6
    lift: float = 0.3
    context: str = ""


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _each(n: Column) -> Column:
    """0 … n - 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _running(values: Column, join) -> Column:
    """For integers from 0 up: before each one, what ``join`` (a sum or maximum) makes of those before it, from 0 on.

    Arrays grow by copying, so the values are taken in chunks, and the chunks' results likewise.
    """

    def within(chunk: Column) -> Column:
        def step(acc: Column, value: Column) -> Column:
            return F.struct(join(acc["upto"], value).alias("upto"), F.array_append(acc["before"], acc["upto"]).alias("before"))

        none = F.struct(F.lit(0).alias("upto"), F.array().cast("array<int>").alias("before"))
        return F.aggregate(chunk, none, step)

    def chunks(values: Column) -> Column:
        n = F.ceil(F.size(values) / CHUNK).cast("int")
        return F.transform(_each(n), lambda k: within(F.slice(values, k * CHUNK + 1, F.lit(CHUNK))))

    def whole(parts: Column) -> Column:
        before = within(F.transform(parts, lambda p: p["upto"]))["before"]
        each = F.zip_with(parts, before, lambda p, b: F.transform(p["before"], lambda x: join(b, x)))
        return F.flatten(each)

    return _let(values, lambda v: _let(chunks(v), whole))


def _blocks(text: Column) -> Column:
    """The text in blocks of ``BLOCK`` code points."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def _piece(blocks: Column, start: Column, end: Column) -> Column:
    """The text from ``start`` to ``end``, from its blocks."""
    first = F.floor(start / BLOCK).cast("int")
    count = F.floor((end - 1) / BLOCK).cast("int") - first + 1
    held = F.array_join(F.slice(blocks, first + 1, count), "")
    return F.when(end > start, F.substr(held, start - first * BLOCK + 1, end - start)).otherwise("")


def octets(value: Column) -> Column:
    """Every part between dots is at most 255."""

    def fits(part: Column) -> Column:
        short = F.regexp_replace(part, "^0+(?=[0-9])", "")
        return F.when(F.length(short) <= 3, short.cast("int") <= 255).otherwise(False)

    return F.forall(F.split(value, r"\."), fits)


def luhn(value: Column) -> Column:
    """13 to 19 digits whose check digit is right."""

    def total(digits: Column) -> Column:
        def add(acc: Column, i: Column) -> Column:
            digit = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
            doubled = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
            return acc + F.when(i % 2 == 1, doubled).otherwise(digit)

        return F.aggregate(_each(F.length(digits)), F.lit(0), add)

    return _let(
        _digits(value), lambda d: F.when(F.length(d).between(13, 19), total(d) % 10 == 0).otherwise(False)
    )


def nine_to_fifteen_digits(value: Column) -> Column:
    return F.length(_digits(value)).between(9, 15)


def mod97(value: Column) -> Column:
    """An account number whose check digits are right: letters count 10 to 35, the first four signs go last."""

    def rest(account: Column) -> Column:
        turned = F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4)))

        def add(acc: Column, sign: Column) -> Column:
            code = F.ascii(sign)
            return F.when(code < 65, acc * 10 + code - 48).otherwise(acc * 100 + code - 55) % 97

        return F.aggregate(F.split(turned, ""), F.lit(0), lambda a, s: F.when(s == "", a).otherwise(add(a, s)))

    return _let(F.replace(value, F.lit(" "), F.lit("")), lambda v: F.length(v).between(15, 34) & (rest(v) == 1))


#: The first four kinds and their limits are given. The others need a checksum or a context word.
KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        r"@[A-Za-z0-9-]",
        score=0.7,
        context="mail|contact|write|kontakt|courriel|correo",
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
        octets,
        context="ip|host|server|address|adresse",
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9])++",
        r"[0-9](?:[\x20-]?[0-9]){12}",
        luhn,
        score=0.7,
        context="card|visa|master|credit|karte|carte|tarjeta",
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        r"\+[0-9]",
        nine_to_fifteen_digits,
        context="phone|tel|call|fax|mobil|llama",
    ),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        r"[A-Z]{2}[0-9]{2}[ A-Z0-9]{11}",
        mod97,
        score=0.9,
        context="iban|account|konto|compte|cuenta",
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
        score=0.3,
        lift=0.5,
        context="ssn|social security",
    ),
    Kind(
        "tel",
        r"(?<![0-9+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])",
        r"[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}",
        score=0.3,
        lift=0.5,
        context="phone|tel|call|fax|mobil|llama",
    ),
    Kind(
        "secret",
        r"(?i)(?<![a-z0-9])(?:token|api[_-]?key|secret|password)\s{0,4}[=:]\s{0,4}[\"']?[a-z0-9+/_-]{16,}+[\"']?",
        r"(?i)(?:token|key|secret|password)\s{0,4}[=:]",
        score=0.8,
    ),
)
BASE = ("email", "ip", "card", "phone")


def _proposed(text: Column, kind: Kind) -> Column:
    """Leftmost matches of one kind that pass its check, with their score."""

    def located(parts: Column) -> Column:
        found, gaps = parts["found"], parts["gaps"]
        # A gap and the match after it; where the match starts is what was before, and the gap.
        steps = F.transform(found, lambda value, i: F.length(F.get(gaps, i)) + F.length(value))
        before = _running(steps, lambda a, b: a + b)
        return F.transform(
            F.arrays_zip(found.alias("value"), before.alias("before")),
            lambda x, i: F.struct(x["value"].alias("value"), (x["before"] + F.length(F.get(gaps, i))).alias("start"), i.alias("i")),
        )

    def nearby(parts: Column, span: Column) -> Column:
        """Up to ``NEARBY`` code points before a span. A match takes two at least, and there is one between two matches."""
        low = F.greatest(span["i"] - NEARBY // 3 - 1, F.lit(0))

        def end(text: Column) -> Column:
            return F.substr(text, F.greatest(F.length(text) - NEARBY + 1, F.lit(1)))

        def with_match(k: Column) -> Column:
            return F.concat(end(F.get(parts["gaps"], k)), F.when(k < span["i"], end(F.get(parts["found"], k))).otherwise(""))

        return end(F.array_join(F.transform(F.sequence(low, span["i"]), with_match), ""))

    def scored(parts: Column, span: Column) -> Column:
        score = F.lit(kind.score)
        if kind.context:
            near = F.lower(nearby(parts, span)).rlike(f"(?<![a-z])(?:{kind.context})")
            score = score + F.when(near, kind.lift).otherwise(0.0)
        return F.struct(
            F.lit(kind.name).alias("kind"),
            span["start"].cast("bigint").alias("start"),
            (span["start"] + F.length(span["value"])).cast("bigint").alias("end"),
            score.alias("score"),
            span["value"].alias("value"),
        )

    def spans(parts: Column) -> Column:
        found = located(parts)
        if kind.check is not None:
            found = F.filter(found, lambda s: kind.check(s["value"]))
        return F.transform(found, lambda s: scored(parts, s))

    parts = F.struct(
        F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("found"),
        F.split(text, kind.pattern, -1).alias("gaps"),
    )
    return F.when(text.rlike(kind.hint), _let(parts, spans)).otherwise(F.array().cast(SPAN))


def with_pii(docs: DataFrame, least: float = 0.5, kinds=KINDS) -> DataFrame:
    """All columns, and ``pii``: the spans with a score of ``least`` or more, by kind in the order of ``kinds``, then by start.

    A span has kind, start and end (code points, end exclusive), score and value.
    Only ``text`` is read; null and empty texts have no spans. Every row is judged
    alone, so repeated rows get equal spans; an empty table stays empty. A column named ``pii`` is replaced.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = F.concat(*[F.filter(_proposed(text, k), lambda s: s["score"] >= least) for k in kinds])
    return docs.withColumn("pii", found)


def redacted(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The same columns with every span of ``text`` replaced by its kind in brackets, and ``n_chars`` (if there) counted anew.

    Spans that overlap are replaced together, under the kind of the first. Null texts stay null.
    """
    kept = docs.columns

    def plain(spans: Column) -> Column:
        return F.transform(
            F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"]))),
            lambda s: F.struct(s["start"].cast("int").alias("start"), s["end"].cast("int").alias("end"), s["kind"].alias("kind")),
        )

    def cut(spans: Column, blocks: Column) -> Column:
        # Up to where the spans before each one reach; one that starts before that is replaced with them.
        reached = _running(F.transform(spans, lambda s: s["end"]), F.greatest)

        def shown(s: Column) -> Column:
            kind = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
            return F.when(s["start"] >= s["at"], F.concat(_piece(blocks, s["at"], s["start"]), kind)).otherwise("")

        def joined(placed: Column) -> Column:
            end = F.array_max(F.transform(placed, lambda s: s["end"]))
            rest = _piece(blocks, end, F.length(F.col("text")))
            return F.concat(F.array_join(F.transform(placed, shown), ""), rest)

        placed = F.zip_with(
            spans,
            reached,
            lambda s, at: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), at.alias("at")),
        )
        return _let(placed, joined)

    def replaced() -> Column:
        return _let(plain(F.col("pii")), lambda spans: _let(_blocks(F.col("text")), lambda blocks: cut(spans, blocks)))

    marked = with_pii(docs.withColumn("text", F.col("text").cast("string")), least)
    changed = marked.withColumn("text", F.when(F.size("pii") > 0, replaced()).otherwise(F.col("text")))
    if "n_chars" in kept:
        changed = changed.withColumn(
            "n_chars", F.when(F.size("pii") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
        )
    return changed.select(*kept)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(marked: DataFrame) -> DataFrame:
    """Counts of the base kinds and the spans as text."""
    spans = F.col("pii")

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    given = F.filter(spans, lambda s: s["kind"].isin(*BASE))
    base = F.sha2(_joined(given).cast("binary"), 256).alias("base_sha256")
    return marked.select("doc_id", *map(count, BASE), base, _joined(spans).alias("spans"))
