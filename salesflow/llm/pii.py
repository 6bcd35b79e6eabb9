"""Operator 6, personal data: regular expressions propose spans, checksums confirm them, nearby words adjust scores.

Everything is made of Spark's own functions. For each kind, `regexp_extract_all` gives the matches and `split` by
the same expression gives the gaps between them, so that offsets are running sums of lengths. Kinds are worked on
only in texts that hold what every match needs (an @, a +, sixteen digits); running sums go block by block, so a
text with very many matches costs little more than its length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality import let

# The kinds in the order in which they are listed, the patterns of the base kinds, and their limits.
# Repeats are possessive, and no match is tried from within a run that was tried from its start (or from the end of
# the match before): the same matches as the plain patterns, in time linear in the text and without recursion.
KINDS = ["email", "ip", "card", "phone", "iban"]
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Account numbers: the published length of each country's.
IBAN_LENGTHS = {
    code[:2]: int(code[2:])
    for code in (
        "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 "
        "FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 "
        "LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 "
        "SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30"
    ).split()
}
CARD_DIGITS = (16, 19)
PHONE_DIGITS = (8, 15)
# End of the fixed values.



def iban_pattern() -> str:
    """Account numbers of exactly their country's length, so that capitals and digits after one are left out."""
    by_length: dict[int, list[str]] = {}
    for code, length in IBAN_LENGTHS.items():
        by_length.setdefault(length, []).append(code)
    kinds = (rf"(?:{'|'.join(codes)})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{length - 4}}}" for length, codes in sorted(by_length.items()))
    return rf"\b(?:{'|'.join(kinds)})\b"


PATTERNS["iban"] = iban_pattern()

#: A text without a match of this has none of the kind.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){15}", "phone": r"\+[0-9]", "iban": r"\b[A-Z]{2}[0-9]{2}"}
#: Words that speak for a kind when they stand within CONTEXT characters of a span.
CONTEXT_WORDS = {
    "email": ["mail", "contact", "write", "address"],
    "ip": ["ip", "host", "server", "address", "login"],
    "card": ["card", "visa", "credit", "payment", "carte", "karte", "tarjeta"],
    "phone": ["phone", "call", "tel", "mobile", "fax", "telefon"],
    "iban": ["iban", "account", "bank", "konto", "compte", "cuenta"],
}
CONTEXT = 40
#: Per cent: what a confirmed span starts from, and what a context word adds.
BASE_SCORE = {"email": 80, "ip": 50, "card": 80, "phone": 60, "iban": 90}
CONTEXT_SCORE = 20
BLOCK = 256


def running_sums(lengths: Column) -> Column:
    """The sum of all elements before each one, by blocks: the sums within each block, then those of the blocks."""

    def grow(start: Column) -> Callable[[Column, Column], Column]:
        return lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x))

    def sums(items: Column, start: Column) -> Column:
        made = F.aggregate(items, F.array(start), grow(start))
        return F.slice(made, 1, F.size(items))

    zero = F.lit(0)
    blocks = F.transform(
        F.sequence(zero, ((F.size(lengths) - 1) / BLOCK).cast("int")), lambda b: F.slice(lengths, b * BLOCK + 1, BLOCK)
    )
    totals = lambda parts: F.transform(parts, lambda x: F.aggregate(x, zero, lambda a, y: a + y))
    within = lambda parts: let(
        sums(totals(parts), zero), lambda starts: F.flatten(F.transform(parts, lambda x, b: sums(x, F.get(starts, b))))
    )
    return F.when(F.size(lengths) > 0, let(blocks, within)).otherwise(F.array().cast("array<int>"))


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the digits of a number pass Luhn's check."""

    def value(digit: Column, i: Column) -> Column:
        twice = digit.cast("int") * 2
        return F.when(i % 2 == 0, digit.cast("int")).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    values = F.transform(F.filter(F.split(F.reverse(number), ""), lambda c: c != ""), value)
    return F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an account number, its first four characters moved to its end and letters read as 10 to 35, leaves 1."""
    moved = F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(4)))
    values = F.transform(
        F.filter(F.split(moved, ""), lambda c: c != ""),
        lambda c: F.when(c.between("0", "9"), c.cast("int")).otherwise(F.ascii(c) - 55),
    )
    step = lambda a, x: F.when(x < 10, a * 10 + x).otherwise(a * 100 + x) % 97
    return F.aggregate(values, F.lit(0), step) == 1


def confirmed(kind: str, match: Column) -> Column:
    """Whether a proposed match is one of its kind."""
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: p.rlike("^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$"))
    if kind == "card":
        return let(digits(match), lambda d: F.length(d).between(*CARD_DIGITS) & luhn(d))
    if kind == "phone":
        return F.length(digits(match)).between(*PHONE_DIGITS)
    if kind == "iban":
        return mod97(F.replace(match, F.lit(" "), F.lit("")))
    return F.lit(True)


def kind_spans(kind: str, text: Column) -> Column:
    """array<struct<start, end, score>> of the confirmed matches of a kind in a text, in code points."""
    pattern = PATTERNS[kind]
    words = "|".join(CONTEXT_WORDS[kind])

    def place(matches: Column, gaps: Column) -> Column:
        lengths = F.transform(matches, lambda m, i: F.length(F.get(gaps, i)) + F.length(m))

        def score(start: Column, end: Column) -> Column:
            near = F.substr(text, F.greatest(start - CONTEXT + 1, F.lit(1)), end - start + 2 * CONTEXT)
            spoken = F.lower(near).rlike(rf"\b(?:{words})")
            return F.lit(BASE_SCORE[kind]) + F.when(spoken, CONTEXT_SCORE).otherwise(0)

        def span(m: Column, i: Column, sums: Column) -> Column:
            start = F.get(sums, i) + F.length(F.get(gaps, i))
            return F.when(confirmed(kind, m), let(start, lambda s: F.struct(
                s.alias("start"), (s + F.length(m)).alias("end"), score(s, s + F.length(m)).alias("score"))))

        return let(running_sums(lengths), lambda sums: F.filter(
            F.transform(matches, lambda m, i: span(m, i, sums)), lambda x: x.isNotNull()))

    def found(text: Column) -> Column:
        matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        return let(matches, lambda m: let(F.split(text, pattern, -1), lambda gaps: place(m, gaps)))

    none = F.array().cast("array<struct<start:int,end:int,score:int>>")
    needed = F.contains(text, F.lit("@")) if kind == "email" else text.rlike(NEEDS[kind])
    return F.when(needed, found(text)).otherwise(none)


def spans_text(kind: str, spans: Column, what: str = "end") -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s[what].cast("string"))), ",")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Personal data of every whole text, one row per input row, without user functions or a shuffle.

    Columns: the id, the columns named in `keep`, n_email, n_ip, n_card, n_phone, base_sha256 (of the spans of the
    four base kinds), spans (all spans, by kind and start), scores (kind:start:score) and n_iban. Null and empty
    texts have no spans (empty string, and the digest of nothing); null and repeated ids stay rows of their own;
    other columns are not read, so their names can't clash.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    every = F.struct(*(kind_spans(kind, F.col("_text")).alias(kind) for kind in KINDS))
    found = docs.select(F.col(id_col), *(keep or []), text.alias("_text")).select(id_col, *(keep or []), every.alias("_found"))
    spans = {kind: F.col(f"_found.{kind}") for kind in KINDS}
    count = lambda kind: F.size(spans[kind]).cast("long").alias(f"n_{kind}")

    def joined(kinds: list[str], what: str = "end") -> Column:
        return F.array_join(F.filter(F.array(*(spans_text(k, spans[k], what) for k in kinds)), lambda x: x != ""), ",")

    return found.select(
        id_col, *(keep or []), *(count(k) for k in KINDS[:4]), F.sha2(joined(KINDS[:4]), 256).alias("base_sha256"),
        joined(KINDS).alias("spans"), joined(KINDS, "score").alias("scores"), count("iban"),
    )


def redact_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, every span of personal data replaced by its kind in brackets; a span that
    overlaps an earlier one goes with it. Null texts stay null."""
    kind_of = lambda kind, spans: F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.lit(f"[{kind.upper()}]").alias("mark")))

    def rebuilt(text: Column, spans: Column) -> Column:
        def add(a: Column, s: Column) -> Column:
            before = F.substr(text, a["at"] + 1, s["start"] - a["at"])
            more = F.when(s["start"] >= a["at"], F.concat(a["parts"], F.array(before, s["mark"]))).otherwise(a["parts"])
            return F.struct(F.greatest(a["at"], s["end"]).alias("at"), more.alias("parts"))

        none = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
        rest = lambda a: F.concat(F.array_join(a["parts"], ""), F.substr(text, a["at"] + 1))
        return F.aggregate(spans, none, add, rest)

    def clean(text: Column) -> Column:
        every = F.sort_array(F.concat(*(kind_of(kind, kind_spans(kind, text)) for kind in KINDS)))
        return let(every, lambda spans: F.when(F.size(spans) > 0, rebuilt(text, spans)).otherwise(text))

    text = F.col(text_col)
    return docs.withColumn(text_col, F.when(text.isNotNull(), let(text, clean)))
