"""Personal data: patterns propose spans, checksums confirm them, context adjusts scores.

Proposals are the leftmost, non-overlapping matches of one pattern per kind.  IP parts
are bounded, card numbers pass Luhn, IBANs have their country's length and pass mod 97,
phone numbers have 9 to 15 digits; what fails is dropped.  Local phone numbers (without +) are weak proposals:
only a context word close before lifts them over the threshold.  Every span carries a
score.  All of it is Spark expressions; positions are code points, read off the
lengths of the texts between matches.

The patterns use possessive quantifiers and start where a run of their characters
starts (or where the last match ended), which finds the same matches without
backtracking over long runs.  An IBAN's proposal is its first four characters with the
run of words after them: every whole number of words is tried, the longest valid one is
the span, and a proposal that fails hides nothing that starts inside it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality import let

#: kind: (cheap test that a match is possible, pattern)
BASE = {
    "email": ("@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (".", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": (None, r"[0-9](?:[\x20-]?[0-9])++"),
    "phone": ("+", r"\+[0-9][\x20().0-9-]+[0-9]"),
}
ADDED = {
    "iban": (None, r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+[A-Za-z0-9]*+))[A-Z]{2}[0-9]{2}"),
    "local_phone": (None, r"(?<![0-9A-Za-z+().-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z-])"),
}
KINDS = (*BASE, *ADDED)
#: IBAN lengths by country (ISO 13616).  Other codes may have any length from 15 to 34.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU"}
#: Score of a confirmed proposal, and what a context word within ``NEAR`` code points before adds.
SCORES = {"email": 0.8, "ip": 0.7, "card": 0.9, "phone": 0.7, "iban": 0.9, "local_phone": 0.4}
CONTEXT = {
    "email": r"(?i)\b(?:e-?mail|contact|write)\b",
    "ip": r"(?i)\b(?:ip|host|server|address)\b",
    "card": r"(?i)\b(?:card|credit|debit|visa|payment)\b",
    "phone": r"(?i)\b(?:phone|tel|call|mobile|fax)\b",
    "iban": r"(?i)\b(?:iban|account|bank|konto)\b",
    "local_phone": r"(?i)\b(?:phone|tel|call|mobile|fax)\b",
}
BONUS, NEAR, THRESHOLD = 0.1, 40, 0.5
#: Characters that a match of an IBAN's pattern takes; group 1 holds the run.
IBAN_START = 4
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
_IBAN = "^(?:{}|(?!{})[A-Z]{{2}}[A-Z0-9]{{13,32}})$".format(
    "|".join(f"(?:{c.replace(' ', '|')})[A-Z0-9]{{{n - 2}}}" for n, c in IBAN_LENGTHS.items()),
    "|".join(c.replace(" ", "|") for c in IBAN_LENGTHS.values()))
_SPAN = "array<struct<start:int,rank:int,kind:string,end:int,score:double>>"


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def step(acc: Column, i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return acc + F.when(i % 2 == 0, twice).otherwise(d)
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def mod97(plain: Column) -> Column:
    """Whether the check digits of an IBAN without blanks hold: its letters as 10 to 35, the
    first four characters last, modulo 97 is 1."""
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def step(acc: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code < 65, acc * 10 + code - 48).otherwise(acc * 100 + code - 55) % 97
    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), step) == 1


def iban_in(run: Column) -> Column:
    """The longest valid IBAN that is a whole number of the run's first words, or null."""
    def valid(words: Column) -> Column:
        return let(F.replace(words, F.lit(" "), F.lit("")), lambda plain: F.when(plain.rlike(_IBAN), mod97(plain)).otherwise(False))

    words = let(F.split(run, " "), lambda w: F.transform(F.sequence(F.size(w), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(w, 1, n), " ")))
    return F.get(F.filter(words, valid), F.lit(0))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _valid(kind: str) -> Callable[[Column], Column]:
    if kind == "ip":
        return lambda m: m.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        return lambda m: let(_digits(m), lambda d: F.when(F.length(d).between(12, 19), luhn(d)).otherwise(False))
    if kind == "phone":
        return lambda m: F.length(_digits(m)).between(9, 15)
    return lambda m: F.lit(True)


def _confirmed(kind: str) -> Callable[[Column], Column]:
    """What of a proposal is confirmed, or null."""
    return iban_in if kind == "iban" else lambda m: F.when(_valid(kind)(m), m)


def _spans(text: Column, kind: str, matches: Column, gaps: Column) -> Column:
    """The confirmed spans of one kind.  ``gaps`` are the texts between the ``matches``."""
    lit = F.struct

    def step(acc: Column, pair: Column) -> Column:
        return let(_confirmed(kind)(pair["match"]), lambda found: add(acc, pair, found))

    def add(acc: Column, pair: Column, found: Column) -> Column:
        start = acc["at"] + F.length(pair["gap"])
        end = start + F.length(found)
        after = start + (IBAN_START if kind == "iban" else F.length(pair["match"]))
        before = F.substring(text, F.greatest(start - NEAR, F.lit(0)) + 1, F.least(start, F.lit(NEAR)))
        score = F.lit(SCORES[kind]) + F.when(before.rlike(CONTEXT[kind]), F.lit(BONUS)).otherwise(F.lit(0.0))
        span = lit(start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"),
                   end.alias("end"), score.alias("score"))
        keep = found.isNotNull() & (start >= acc["free"]) & (score >= THRESHOLD)
        return lit(after.alias("at"), F.when(keep, end).otherwise(acc["free"]).alias("free"),
                   F.when(keep, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    pairs = F.zip_with(matches, F.slice(gaps, F.lit(1), F.size(matches)), lambda m, g: lit(m.alias("match"), g.alias("gap")))
    empty = F.expr(f"cast(array() as {_SPAN})")
    found = F.aggregate(pairs, lit(F.lit(0).alias("at"), F.lit(0).alias("free"), empty.alias("spans")), step, lambda acc: acc["spans"])
    return F.when(F.size(matches) > 0, found).otherwise(empty)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, entities), one row per row of ``docs``: entities are (start, rank, kind, end,
    score) structs in order of start and kind, code points, ends exclusive.

    * Null and empty texts have none.  Whole texts are searched, however long; repeated rows get
      the same result; an empty table gives an empty one.  Only the id and the text are read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    digits = rows.withColumn("has_digits", F.col("text").rlike("[0-9]"))
    none = F.expr("cast(array() as array<string>)")

    def possible(kind: str) -> Column:
        sign = {**BASE, **ADDED}[kind][0]
        test = F.contains(F.col("text"), F.lit(sign)) if sign else F.col("has_digits")
        return test if kind == "email" else test & F.col("has_digits")

    patterns = {k: p for k, (_, p) in {**BASE, **ADDED}.items()}
    matched = digits.select("doc_id", "text", *[
        F.when(possible(k), F.regexp_extract_all("text", F.lit(p), F.lit(int(k == "iban")))).otherwise(none).alias(k) for k, p in patterns.items()])
    cut = matched.select("*", *[
        F.when(F.size(k) > 0, F.split("text", p, -1)).otherwise(none).alias(f"{k}_gaps") for k, p in patterns.items()])
    spans = [_spans(F.col("text"), k, F.col(k), F.col(f"{k}_gaps")) for k in KINDS]
    return cut.select("doc_id", F.sort_array(F.concat(*spans)).alias("entities"))


def report(docs: DataFrame, **options) -> DataFrame:
    """Per document: the counts of the base kinds, ``base_sha256`` of their spans, ``spans`` of all
    kinds (kind:start:end, comma-joined), and ``scores`` of the same spans."""
    def told(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    found = find(docs, **options)
    base = F.filter("entities", lambda s: s["rank"] < len(BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter("entities", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, BASE), F.sha2(told(base), 256).alias("base_sha256"), told(F.col("entities")).alias("spans"),
                        F.col("entities")["score"].alias("scores"))
