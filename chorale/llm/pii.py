"""Personal data: regular expressions propose spans, checksums confirm them, nearby words adjust the score.

Only DataFrame functions are used.  A text is searched once per kind; the positions of matches follow from the lengths of
what lies between them.  All expressions are linear in the text: runs of characters are possessive and a search
starts only at the start of a run or at the end of the last match, which finds the same leftmost matches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import quoted, text_of, unused, without

_LOCAL = "[A-Za-z0-9._%+-]"


@dataclass(frozen=True)
class Kind:
    """A kind of span: its expression, a text that must occur for it, its score, and the words that raise it."""

    name: str
    pattern: str
    needs: str | None
    score: float
    words: str
    base: bool


#: Base kinds in the order of the contract, then the kinds that the method adds.
KINDS = (
    Kind("email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.8, "mail|contact|write|kontakt|correo|courriel", True),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", 0.6, "ip|host|server|address|login|from", True),
    Kind("card", r"[0-9](?:[\x20-]?+[0-9])++", None, 0.7, "card|visa|credit|karte|carte|tarjeta|pay", True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", 0.6, "tel|phone|call|fax|mobile|telefon|anruf", True),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?+[A-Z0-9]){11,30}+(?![A-Za-z0-9])", None, 0.7, "iban|account|bank|konto|compte|cuenta", False),
    Kind("ssn", r"(?<![A-Za-z0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9-])", "-", 0.3, "ssn|social security|tax id", False),
    Kind("secret", r"(?<![A-Za-z0-9])[0-9a-f]{32,64}+(?![A-Za-z0-9])", None, 0.3, "token|secret|key|password|passwd", False),
)
BASE_KINDS = tuple(k.name for k in KINDS if k.base)
#: Score that an added span must reach; base spans stay whatever their score.
MIN_SCORE = 0.5
#: Code points before a span (back to the last match of its kind) in which context words count, and what they add.
CONTEXT, CONTEXT_BONUS = 40, 0.25


def luhn_ok(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    value = lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int"))
    each = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(c == "", F.lit(0)).otherwise(value(F.when(c == "", F.lit("0")).otherwise(c), i)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97_ok(text: Column) -> Column:
    """Whether an IBAN (letters and digits) leaves 1 modulo 97 with its first four characters moved to the end."""
    moved = F.concat(F.substring(text, 5, 1 << 30), F.substring(text, 1, 4))
    step = lambda a, c: F.when(c == "", a).when(c.between("0", "9"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.split(moved, ""), F.lit(0), step) == 1


def _confirmed(kind: str, match: Column) -> Column:
    if kind == "ip":
        short = lambda p: F.ltrim(p, F.lit("0"))
        return F.forall(F.split(match, r"\."), lambda p: (F.length(short(p)) < 3) | ((F.length(short(p)) == 3) & (short(p) <= "255")))
    if kind == "card":
        digits = F.translate(match, " -", "")
        return F.when(F.length(digits).between(16, 19), luhn_ok(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(F.translate(match, " +().-", "")).between(8, 15)
    if kind == "iban":
        return mod97_ok(F.translate(match, " ", ""))
    if kind == "ssn":
        return ~match.rlike("^(?:000|666|9..)|-00-|-0000$")
    return F.lit(True)


_SPAN = "struct<kind:string,start:int,end:int,score:double>"
#: Elements of a block of the running sums and maxima.
_BLOCK = 256


def _running(values: Column, step) -> Column:
    """For each element of an array what ``step`` makes, from 0, of all before it: sums over whole blocks, then inside the block.

    A fold that grows an array copies it for every element; this takes a block's steps for each.  The array must be a column, as
    it is read more than once.
    """
    first = F.array(F.lit(0))
    whole = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / _BLOCK).cast("int")), lambda b: F.aggregate(F.slice(values, b * _BLOCK + 1, F.lit(_BLOCK)), F.lit(0), step))
    starts = F.aggregate(whole, first, lambda acc, x: F.concat(acc, F.array(step(F.element_at(acc, -1), x))))
    blocks = F.zip_with(
        starts, F.transform(F.sequence(F.lit(0), F.size(starts) - 2), lambda b: F.slice(values, b * _BLOCK + 1, F.lit(_BLOCK))),
        lambda start, part: F.transform(part, lambda _, i: F.aggregate(F.slice(part, F.lit(1), i), start, step)),
    )
    return F.when(F.size(values) > 0, F.flatten(F.filter(blocks, lambda b: b.isNotNull()))).otherwise(F.array().cast("array<int>"))


def _spans(kind: Kind, matches: str, between: str, starts: str) -> Column:
    """Confirmed matches with their positions in code points; ``between`` holds what lies before each match, ``starts`` where that begins."""

    def span(m: Column) -> Column:
        match, before = m[matches], m[between]
        start = m[starts] + F.length(before)
        near = F.lower(F.right(before, F.lit(CONTEXT))).rlike(f"(?<![a-z])(?:{kind.words})")
        score = F.lit(kind.score) + F.when(near, F.lit(CONTEXT_BONUS)).otherwise(F.lit(0.0))
        keep = _confirmed(kind.name, match)
        if not kind.base:
            keep = keep & (score >= MIN_SCORE)
        found = F.struct(F.lit(kind.name).alias("kind"), start.alias("start"), (start + F.length(match)).alias("end"), score.alias("score"))
        return F.when(keep, found)

    each = F.transform(F.arrays_zip(matches, between, starts), span)
    return F.when(F.size(matches) > 0, F.filter(each, lambda s: s.isNotNull())).otherwise(F.array().cast(f"array<{_SPAN}>"))


def find_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` plus ``pii``: an array of (kind, start, end, score), by kind as listed, then start.

    Positions count code points, the end exclusive, in the whole text, whatever its length.  A null or empty text has no
    spans.  Repeated rows stay.  An input column called pii (in any case) is replaced, also where it holds the text.  An
    empty table gives no rows.
    """
    names = without(docs, "pii").columns
    columns = [F.col(quoted(c)) for c in names]
    given, *rest = unused((*names, "pii"), "given", *(f"{part}_{k.name}" for part in ("match", "between", "length", "start") for k in KINDS))
    found, between, lengths, starts = (dict(zip(KINDS, rest[i * len(KINDS) :])) for i in range(4))
    none = F.array().cast("array<string>")
    text = F.col(given)

    def matches(kind: Kind) -> Column:
        spans = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
        return spans if kind.needs is None else F.when(F.contains(text, F.lit(kind.needs)), spans).otherwise(none)

    one = docs.select(*columns, text_of(F.col(quoted(text_col))).alias(given))
    two = one.select("*", *[matches(k).alias(found[k]) for k in KINDS])
    # As many parts as matches: what follows the last one is not needed.
    parts = lambda k: F.when(F.size(found[k]) > 0, F.slice(F.split(text, k.pattern, -1), F.lit(1), F.size(found[k]))).otherwise(none)
    three = two.select(*columns, *found.values(), *[parts(k).alias(between[k]) for k in KINDS])
    sizes = lambda k: F.zip_with(found[k], between[k], lambda m, b: F.length(m) + F.length(b))
    four = three.select("*", *[sizes(k).alias(lengths[k]) for k in KINDS])
    five = four.select("*", *[_running(F.col(lengths[k]), lambda a, x: a + x).alias(starts[k]) for k in KINDS])
    return five.select(*columns, F.concat(*[_spans(k, found[k], between[k], starts[k]) for k in KINDS]).alias("pii"))


def redact(found: DataFrame, text_col: str = "text") -> DataFrame:
    """The result of ``find_pii`` with every span (overlapping ones together) replaced by its kind in brackets; a null text stays null.

    Of overlapping spans the first names the kind (of those the longest).  All other columns stay.
    """
    given = F.col(quoted(text_col))
    spans, ends, high, pieces = unused(found.columns, "spans", "ends", "high", "pieces")
    ordered = F.array_sort(F.transform("pii", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("minus_end"), s["kind"].alias("kind"))))
    one = found.withColumn(spans, ordered)
    two = one.withColumn(ends, F.transform(spans, lambda s: -s["minus_end"]))
    three = two.withColumn(high, _running(F.col(ends), lambda a, x: F.greatest(a, x)))
    # What is kept before each span that begins where the ones before have ended.
    each = F.zip_with(spans, high, lambda s, h: F.when(s["start"] >= h, F.struct(h.alias("start"), s["start"].alias("end"), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("mark"))))
    four = three.withColumn(pieces, F.filter(each, lambda p: p.isNotNull()))

    def block(part: Column) -> Column:
        # A substring is found from the start of its text, so pieces are taken from the text of their block.
        start = part[0]["start"]
        text = F.substr(given, start + 1, F.element_at(part, -1)["end"] - start)
        return F.aggregate(
            F.array(text), F.lit(""), lambda _, t: F.array_join(F.transform(part, lambda p: F.concat(F.substr(t, p["start"] - start + 1, p["end"] - p["start"]), p["mark"])), "")
        )

    numbers = F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / _BLOCK).cast("int"))
    blocks = F.transform(F.transform(numbers, lambda b: F.slice(pieces, b * _BLOCK + 1, F.lit(_BLOCK))), block)
    masked = F.concat(F.array_join(blocks, ""), F.substr(given, F.array_max(ends) + 1))
    out = F.when(F.size(pieces) > 0, masked).otherwise(given)
    return four.select([out.alias(c) if c.lower() == text_col.lower() else F.col(quoted(c)) for c in found.columns])


def spans_text(pii: Column, base_only: bool = False) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    spans = F.filter(pii, lambda s: s["kind"].isin(*BASE_KINDS)) if base_only else pii
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(pii: Column, kind: str) -> Column:
    return F.size(F.filter(pii, lambda s: s["kind"] == kind)).cast("long")
