"""Personal data in texts, in DataFrame functions only.

Regular expressions propose spans, validators confirm them (the Luhn sum of card numbers, mod-97 of
bank accounts, ranges of addresses), and words near a span raise or lower its score. Spans of the
base kinds stay whatever their score is; those of the other kinds need ``ACCEPTED``.

Everything happens in one projection of the row: no shuffle, no Python, no state beside the row. The
expressions of the base kinds are written so that Java's engine neither recurses nor starts again
inside a run of characters it has already given up: a text of one endless run takes linear time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .tables import let

#: Score from which a span of a kind beyond the base ones is reported.
ACCEPTED = 50
#: What a near word of its kind adds to the score of a span, and a near word of ``DOUBT`` takes away.
RAISED = LOWERED = 30
#: Code points looked at on each side of a span, up to the next proposal of its kind.
CONTEXT = 40
DOUBT = ("checksum", "commit", "order", "sample", "version")
#: Spans of a kind that are placed together; bounds the copying while positions are summed up.
PLACED = 256

# Length of an account number (IBAN) by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "CH": 21, "CR": 22,
    "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22,
    "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27,
    "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19,
    "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22,
    "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "XK": 20,
}


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def mod97(account: Column) -> Column:
    """Remainder of an account number: its first four characters go last, letters become 10 to 35."""
    turned = F.split(F.concat(F.substring(account, 5, 64), F.substring(account, 1, 4)), "")
    step = lambda r, c: F.when(c.rlike("[0-9]"), (r * 10 + F.ascii(c) - 48) % 97).otherwise((r * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(turned, F.lit(0), step)


def card(m: Column) -> Column:
    return F.length(digits(m)).between(16, 19) & F.call_function("luhn_check", digits(m))


_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


def address(m: Column) -> Column:
    return m.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")


def account(m: Column) -> Column:
    return mod97(F.replace(m, F.lit(" "), F.lit(""))) == 1


def account_only(m: Column) -> Column:
    """The front of a proposal that is as long as accounts of its country are; null for an unknown country."""
    length = F.create_map(*[F.lit(v) for kv in IBAN_LENGTHS.items() for v in kv])[F.substring(m, 1, 2)]
    front = F.call_function("regexp_extract", m, F.concat(F.lit("^[A-Z0-9](?: ?[A-Z0-9]){"), (length - 1).cast("string"), F.lit("}")), F.lit(0))
    return F.when(length.isNotNull() & (F.length(F.replace(m, F.lit(" "), F.lit(""))) >= length), front)


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    score: int
    words: tuple[str, ...]
    valid: Callable[[Column], Column] = lambda m: F.lit(True)
    #: Part of a proposal that is the span; null if none.
    cut: Callable[[Column], Column] = lambda m: m
    base: bool = False


KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 90,
         ("contact", "email", "mail"), base=True),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 60, ("address", "host", "ip", "server"), address, base=True),
    Kind("card", "[0-9](?:[ -]?[0-9])++", 80, ("card", "credit", "mastercard", "payment", "visa"), card, base=True),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", 60, ("call", "fax", "mobile", "phone", "tel"),
         lambda m: F.length(digits(m)).between(8, 15), base=True),
    Kind("iban", "[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}", 80, ("account", "bank", "iban", "konto"), account, account_only),
    Kind("ssn", "[0-9]{3}-[0-9]{2}-[0-9]{4}", 40, ("social security", "ssn"),
         lambda m: ~m.rlike("^(?:000|666|9)|-00-|-0000$")),
    Kind("secret", "[0-9A-Fa-f]{32,128}", 40, ("api key", "key", "password", "secret", "token"),
         lambda m: m.rlike("[0-9]") & m.rlike("[A-Fa-f]")),
)
BASE = tuple(k.name for k in KINDS if k.base)
SPAN = "struct<kind:string,start:int,end:int,text:string,score:int>"


def near(text: Column, words: tuple[str, ...]) -> Column:
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return low.rlike(f"(^|[^a-z0-9])({'|'.join(words)})([^a-z0-9]|$)")


def judged(kind: Kind, row: Column, start: Column) -> Column:
    """The span of a proposal, null where it fails its validator or its score is too low."""
    around = F.concat(row["before"], F.lit(" | "), row["after"])
    score = (F.lit(kind.score) + F.when(near(around, kind.words), RAISED).otherwise(0) - F.when(near(around, DOUBT), LOWERED).otherwise(0))
    score = F.greatest(F.lit(0), F.least(F.lit(100), score))

    def span(m: Column) -> Column:
        good = F.coalesce(kind.valid(m), F.lit(False))
        if not kind.base:
            good = good & (score >= ACCEPTED) & ~row["before"].rlike("[A-Za-z0-9]$") & ~F.substring(row["after"], 1, 1).rlike("[0-9]")
        return F.when(good, F.struct(F.lit(kind.name).alias("kind"), start.alias("start"), (start + F.length(m)).alias("end"), m.alias("text"),
                                     score.alias("score")))

    return let(kind.cut(row["match"]), span).cast(SPAN)


def spans_of(text: Column, kind: Kind) -> Column:
    """The spans of one kind in order. ``text`` is not null.

    Proposals and the text between them give the places: the lengths of both are summed up in runs
    of ``PLACED``, so that no long array is copied once for each of its members.
    """
    none = F.array().cast(f"array<{SPAN}>")

    def placed(proposals: Column) -> Column:
        def member(found: Column, left: Column) -> Column:
            return F.struct(F.length(left["rest"]).alias("gap"), F.right(left["rest"], F.lit(CONTEXT)).alias("before"), left["after"].alias("after"),
                            found.alias("match"))

        def rows(rest: Column) -> Column:
            ends = F.arrays_zip(F.slice(rest, 1, F.size(proposals)).alias("rest"),
                                F.transform(F.slice(rest, 2, F.size(proposals)), lambda r: F.left(r, F.lit(CONTEXT))).alias("after"))
            return F.zip_with(proposals, ends, member)

        def one(acc: Column, row: Column) -> Column:
            start = acc["at"] + row["gap"]
            return F.struct((start + F.length(row["match"])).alias("at"), F.concat(acc["out"], F.array(judged(kind, row, start))).alias("out"))

        def run(acc: Column, members: Column) -> Column:
            first = F.struct(acc["at"].alias("at"), none.alias("out"))
            return let(F.aggregate(members, first, one),
                       lambda r: F.struct(r["at"].alias("at"), F.concat(acc["out"], F.array(r["out"])).alias("out")))

        def runs(members: Column) -> Column:
            last = F.ceil(F.size(members) / PLACED).cast("int") - 1
            return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(members, i * PLACED + 1, PLACED))

        zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{SPAN}>>").alias("out"))
        all_ = F.aggregate(let(let(F.split(text, kind.pattern, -1), rows), runs), zero, run)
        return F.filter(F.flatten(all_["out"]), lambda s: s.isNotNull())

    return let(F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), lambda p: F.when(F.size(p) > 0, placed(p)).otherwise(none))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """(doc_id, spans) of every row of ``docs``: kind, start, end (code points, end exclusive), text and score
    of each span, by kind as ``kinds`` lists them, then by start.

    A null text counts as empty and has no spans; a null key stays null; repeated rows are scanned
    each; an empty table gives no rows; other columns are not looked at, whatever their names are.
    Spans of different kinds may overlap, those of one kind do not.
    """
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    return rows.select("doc_id", F.concat(*[spans_of(F.col("text"), k) for k in kinds]).alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans as one string."""
    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select("doc_id", *map(count, BASE), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
