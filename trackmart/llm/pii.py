"""Personal data: patterns propose spans, checks confirm them, context adjusts the score.

Spark's regular expressions return matched strings without positions. Splitting a
text by a pattern gives what lies between its matches, so the running lengths of
gaps and matches are the positions. All offsets are code points, ends exclusive.

Patterns are written so that matching stays linear on any text: possessive runs, and
a start only where the previous character does not belong to the run, or where the
previous match ended.

Kinds
-----
``email``, ``ip``, ``card``, ``phone`` are the base kinds: leftmost non-overlapping
matches of fixed patterns; a match that fails its check is dropped and not retried.
``iban`` (mod-97) and ``ssn`` (needs a context word) are added by the method. An added
span never replaces or shortens a base span; one that overlaps a base span is left
out. Scores: base 0.6 for a pattern, 0.8 where a checksum or range confirms it, plus
0.2 when a context word of the kind stands within the 40 characters before the span.

Rules
-----
* Null text counts as empty; empty text has no span.
* Rows are independent: repeated rows and ties need no rule; an empty table gives an
  empty result; further columns are not read and may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmart.llm.common import documents, exact

_LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# A separator between two digits belongs to the number: it is marked first, so that
# a number is one run of a character class.
_MARK, _SPARE = "\ue000", "\ue001"
CARD = rf"[0-9][0-9{_MARK}]++"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
# Numbers that run into a neighbouring number, which the base patterns take as one.
CARD_ALONE = r"(?<![0-9])[0-9]{4}([\x20-]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])"
PHONE_ALONE = r"\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])"

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")
WINDOW = 40
CONTEXT = {
    "email": "mail|contact|write",
    "ip": r"\bip\b|address|host|server",
    "card": "card|visa|payment|credit",
    "phone": r"phone|call|tel\b|mobile",
    "iban": "iban|account|bank",
    "ssn": "ssn|social security|tax id",
}


@dataclass(frozen=True)
class Kind:
    """How spans of one kind are found and confirmed."""

    name: str
    pattern: str
    hint: str  # what every match contains, to pass over other texts
    check: object  # Column -> Column
    score: float


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    values = F.reverse(F.split(digits, ""))
    doubled = F.transform(
        values,
        lambda d, i: F.when(
            i % 2 == 1,
            F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2),
        ).otherwise(d.cast("int")),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, b: a + b) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an account number passes the mod-97 check; letters count 10 to 35."""
    plain = F.regexp_replace(iban, " ", "")
    turned = F.split(F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4))), "")

    def step(rest, c):
        digit = F.ascii(c) <= 57
        return F.when(digit, (rest * 10 + F.ascii(c) - 48) % 97).otherwise(
            (rest * 100 + F.ascii(c) - 55) % 97
        )

    return F.aggregate(turned, F.lit(0), step) == 1


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _card(match: Column) -> Column:
    n = F.length(_digits(match))
    return F.when(n.between(14, 19), luhn(_digits(match))).otherwise(False)


def _ip(match: Column) -> Column:
    def small(part):
        short = F.regexp_replace(part, "^0+(?=[0-9])", "")
        return F.when(F.length(short) <= 3, short.cast("int") <= 255).otherwise(False)

    return F.forall(F.split(match, "\\."), small)


def _phone(match: Column) -> Column:
    return F.length(_digits(match)).between(10, 15)


def _always(match: Column) -> Column:
    return F.lit(True)


BASE_RULES = (
    Kind("email", EMAIL, "@", _always, 0.6),
    Kind("ip", IP, ".", _ip, 0.8),
    Kind("card", CARD, "", _card, 0.8),
    Kind("phone", PHONE, "+", _phone, 0.6),
)
ADDED_RULES = (
    Kind("card", CARD_ALONE, "", _card, 0.8),
    Kind("phone", PHONE_ALONE, "+", _phone, 0.6),
    Kind("iban", IBAN, "", mod97, 0.8),
    Kind("ssn", SSN, "-", _always, 0.6),
)
_SPANS = "array<struct<from:int,nth:int,to:int,kind:string,match:string,score:double>>"


def confirmed(found: Column, gaps: Column, rule: Kind) -> Column:
    """Confirmed spans of a kind from its matches and the gaps between them.

    The fold keeps the place in the text and appends a span where the check passes.
    """
    steps = F.arrays_zip(
        F.slice(gaps, F.lit(1), F.size(found)).alias("gap"), found.alias("match")
    )

    def step(walk, x):
        start = walk["at"] + F.length(x["gap"])
        end = start + F.length(x["match"])
        span = F.struct(
            start.alias("from"),
            F.lit(KINDS.index(rule.name)).alias("nth"),
            end.alias("to"),
            F.lit(rule.name).alias("kind"),
            x["match"].alias("match"),
            F.lit(rule.score).alias("score"),
        )
        spans = F.when(rule.check(x["match"]), F.concat(walk["spans"], F.array(span))).otherwise(
            walk["spans"]
        )
        return F.struct(end.alias("at"), spans.cast(_SPANS).alias("spans"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))
    return F.aggregate(steps, start, step)["spans"]


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, base and added spans (from, nth, to, kind, match, score)."""
    rules = (*BASE_RULES, *ADDED_RULES)
    text = F.coalesce(exact(text_col), F.lit(""))
    marked = F.regexp_replace(
        F.translate(text, _MARK, _SPARE), r"(?<=[0-9])[\x20-](?=[0-9])", _MARK
    )
    has_digit = text.rlike("[0-9]")
    read = docs.select(
        exact(id_col).alias("doc_id"),
        text.alias("text"),
        F.when(has_digit, marked).otherwise("").alias("marked"),
        has_digit.alias("has_digit"),
    )
    # Two steps, as a pattern would otherwise run once for every use of its matches.
    columns, spans = [], []
    for n, rule in enumerate(rules):
        source = F.col("marked") if rule.pattern == CARD else F.col("text")
        hint = F.col("text").contains(rule.hint) if rule.hint else F.col("has_digit")
        hint = hint & F.col("has_digit") if rule.name != "email" else hint
        found = F.regexp_extract_all(source, F.lit(rule.pattern), F.lit(0))
        none = F.array().cast("array<string>")
        columns.append(F.when(hint, found).otherwise(none).alias(f"found{n}"))
        columns.append(
            F.when(hint, F.split(source, rule.pattern)).otherwise(none).alias(f"gaps{n}")
        )
        spans.append(
            F.when(F.size(f"found{n}") > 0, confirmed(F.col(f"found{n}"), F.col(f"gaps{n}"), rule))
            .otherwise(F.array().cast(_SPANS))
            .alias(f"spans{n}")
        )
    each = read.select("doc_id", "text", *columns).select("doc_id", "text", *spans)
    base = F.sort_array(F.concat(*(f"spans{n}" for n in range(len(BASE_RULES)))))
    added = F.concat(*(f"spans{n}" for n in range(len(BASE_RULES), len(rules))))
    joined = each.select("doc_id", "text", base.alias("base"), added.alias("added"))
    apart = F.filter(
        "added",
        lambda a: ~F.exists("base", lambda b: (a["from"] < b["to"]) & (b["from"] < a["to"])),
    )
    scored = lambda spans: F.transform(spans, _in_context)
    return (
        joined.withColumn("added", apart)
        .withColumn("base", scored(F.col("base")))
        .withColumn("added", F.filter(scored(F.col("added")), _accepted))
        .drop("text")
    )


def _in_context(span: Column) -> Column:
    """The span with its score raised when a context word stands shortly before it."""
    start = F.greatest(span["from"] - WINDOW, F.lit(0))
    before = F.lower(F.substr(F.col("text"), start + 1, span["from"] - start))
    near = F.lit(False)
    for kind, words in CONTEXT.items():
        near = near | ((span["kind"] == kind) & before.rlike(words))
    score = span["score"] + F.when(near, F.lit(0.2)).otherwise(F.lit(0.0))
    return span.withField("score", F.round(score, 3))


def _accepted(span: Column) -> Column:
    """A number that only looks like a social security number needs its context."""
    return (span["kind"] != "ssn") | (span["score"] > 0.7)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    part = lambda s: F.concat_ws(":", s["kind"], s["from"].cast("string"), s["to"].cast("string"))
    return F.concat_ws(",", F.transform(spans, part))


def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = find_spans(documents(spark, folder))
    spans = F.sort_array(F.concat("base", "added"))
    scores = F.transform(spans, lambda s: F.format_number(s["score"], 3))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in BASE),
        F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        listed(spans).alias("spans"),
        F.concat_ws(",", scores).alias("scores"),
    )
