"""Personal data in texts: regular expressions propose spans, checksums confirm them, nearby
words adjust the score. DataFrame functions only; one narrow pass, no shuffle.

The place of a match follows from the pieces between matches: a text is split at the pattern
and the lengths of pieces and matches add up. A document without the characters that a
pattern needs skips it. An account number is tried at every place where one can start: its
pattern takes no characters, so a failed check never costs the number that begins inside it.

Patterns are written with possessive quantifiers and look-behinds where these leave the
matches as they are. The matcher then neither recurses nor tries one run of characters from
each of its positions, so very long runs of digits or dots neither overflow a stack nor take
quadratic time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinemetrics.llm.common import text_or_empty, unused

_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


# characters of an account number by country, as registered or in use
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_pattern() -> str:
    """A place where an account number starts, the number in group 1: as long as its country
    has it; of other countries the longest that the groups of four allow."""
    known = []
    for n, countries in _IBAN_LENGTHS.items():
        groups, rest = divmod(n - 4, 4)
        tail = rf"\x20?[A-Z0-9]{{{rest}}}" if rest else ""
        known.append(rf"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{groups}}}{tail}")
    codes = "|".join(_IBAN_LENGTHS.values()).replace(" ", "|")
    other = rf"(?!{codes})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{2,7}}(?:\x20?[A-Z0-9]{{1,3}})?"
    return rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?=((?:{'|'.join([*known, other])})(?![A-Za-z0-9])))"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    needed: str  # a text without this expression has no match
    base_score: float
    words: str  # context words that raise the score
    always: bool = True  # kept whatever the score
    inside: bool = False  # the pattern finds places only, group 1 the value: values may overlap


# fixed values: kinds in the order of the result, patterns, scores and context words
KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@", 0.9, "e-?mail|contact|write to|correo|courriel",
    ),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]", 0.6, r"\bip\b|address|server|host|adresse"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"(?:[0-9][\x20-]?){16}", 0.9, "card|visa|credit|karte|carte|tarjeta"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", 0.6, r"phone|\btel|call|mobile|telefon"),
    Kind(
        "iban",
        _iban_pattern(),
        "[A-Z]{2}[0-9]{2}", 0.8, "iban|account|konto|compte|cuenta", always=False, inside=True,
    ),
    Kind(
        "ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "[0-9]-[0-9]{2}-[0-9]",
        0.3, r"ssn|social security|sozialversicherung", always=False,
    ),
)
CONTEXT_CHARS = 40
CONTEXT_BONUS = 0.3
MIN_SCORE = 0.5

# the longest account number with its blanks is below this many characters
_INSIDE_CHARS = 48

_MATCHES = "array<struct<start:int,end:int,value:string,near:string>>"
_SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"


def _matches(text: Column, kind: Kind) -> Column:
    """Places and texts of the leftmost matches, with the text before and after each."""
    # a character before the text: a split drops an empty piece before an empty match
    led = F.concat(F.lit("\n"), text) if kind.inside else text
    values = F.regexp_extract_all(led, F.lit(kind.pattern), F.lit(1 if kind.inside else 0))
    pieces = F.split(led, kind.pattern, -1)
    none = F.array().cast(_MATCHES)

    def taken(x: Column) -> Column:
        return F.lit("") if kind.inside else x["value"]

    # from the last match to the first: the text after each
    def back(acc: Column, x: Column) -> Column:
        rest = F.concat(taken(x), x["next"], acc["rest"])
        skip = F.char_length(x["value"])
        return F.struct(
            F.substring(rest, F.lit(1), F.lit(CONTEXT_CHARS + _INSIDE_CHARS)).alias("rest"),
            F.concat(acc["after"], F.array(F.substring(rest, skip + 1, F.lit(CONTEXT_CHARS)))).alias("after"),
        )

    following = F.arrays_zip(F.slice(pieces, 2, F.size(values)).alias("next"), values.alias("value"))
    last = F.struct(F.lit("").alias("rest"), F.array().cast("array<string>").alias("after"))
    after = F.reverse(F.aggregate(F.reverse(following), last, back)["after"])

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x["piece"])
        end = start + F.char_length(x["value"])
        before = F.right(F.concat(acc["tail"], x["piece"]), F.lit(CONTEXT_CHARS))
        found = F.struct(
            start.alias("start"), end.alias("end"), x["value"].alias("value"),
            F.concat(before, F.lit("\n"), x["after"]).alias("near"),
        )
        return F.struct(
            (start + F.char_length(taken(x))).alias("at"),
            F.right(F.concat(before, taken(x)), F.lit(CONTEXT_CHARS)).alias("tail"),
            F.concat(acc["found"], F.array(found)).alias("found"),
        )

    all_of = F.arrays_zip(F.slice(pieces, 1, F.size(values)).alias("piece"), values.alias("value"), after.alias("after"))
    first = F.struct(F.lit(-1 if kind.inside else 0).alias("at"), F.lit("").alias("tail"), none.alias("found"))
    return F.when(text.rlike(kind.needed), F.aggregate(all_of, first, step)["found"]).otherwise(none)


def _apart(found: Column) -> Column:
    """The leftmost of matches that overlap."""

    def step(acc: Column, m: Column) -> Column:
        return F.when(m["start"] >= acc["end"], F.struct(m["end"].alias("end"), F.concat(acc["found"], F.array(m)).alias("found"))).otherwise(acc)

    return F.aggregate(found, F.struct(F.lit(0).alias("end"), F.array().cast(_MATCHES).alias("found")), step)["found"]


def luhn(digits: Column) -> Column:
    """Whether up to 20 digits pass the Luhn check."""
    padded = F.lpad(digits, 20, "0")
    doubled = F.translate(padded, "0123456789", "0246813579")
    total = F.lit(0)
    for i in range(1, 21):
        total = total + F.substring(padded if i % 2 == 0 else doubled, i, 1).cast("int")
    return total % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number (letters and digits, country first) leaves 1 modulo 97."""
    moved = F.concat(F.substring(account, 5, 40), F.substring(account, 1, 4))

    def step(acc: Column, i: Column) -> Column:
        value = F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), F.substr(moved, i, F.lit(1))) - 1
        return (acc * F.when(value > 9, 100).otherwise(10) + value) % 97

    return F.aggregate(F.sequence(F.lit(1), F.char_length(moved)), F.lit(0), step) == 1


def _confirmed(kind: Kind, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.char_length(digits)
    if kind.name == "ip":
        return value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind.name == "card":
        return F.when((n >= 16) & (n <= 19), luhn(digits)).otherwise(False)
    if kind.name == "phone":
        return (n >= 8) & (n <= 15)
    if kind.name == "iban":
        return mod97(F.regexp_replace(value, " ", ""))
    return F.lit(True)


def _spans(text: Column, kind: Kind) -> Column:
    kept = F.filter(_matches(text, kind), lambda m: _confirmed(kind, m["value"]))
    kept = _apart(kept) if kind.inside else kept

    def scored(m: Column) -> Column:
        near = F.lower(m["near"]).rlike(kind.words)
        score = F.when(near, F.lit(min(1.0, kind.base_score + CONTEXT_BONUS))).otherwise(F.lit(kind.base_score))
        return F.struct(F.lit(kind.name).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), score.alias("score"))

    spans = F.transform(kept, scored)
    return spans if kind.always else F.filter(spans, lambda s: s["score"] >= MIN_SCORE)


def find_pii(docs: DataFrame) -> DataFrame:
    """``docs`` (text, any other columns) plus ``spans``: array<struct<kind, start, end, score>>.

    Places are code points, end exclusive; kinds come in the order of ``KINDS``, each by start.
    Proposed spans that fail their check are dropped without another try: IP parts at most
    255, cards of 16 to 19 digits under Luhn, phones of 8 to 15 digits. An IBAN is as long as
    its country has it (any length for a country without a known one), passes modulo 97 and is
    tried at each place. Email, ip, card and phone spans stay whatever their score; iban and
    ssn spans need ``MIN_SCORE``, which an ssn reaches only with a context word in the
    ``CONTEXT_CHARS`` of text on either side of it, other spans and all.

    Null and empty texts have no spans. A column called spans is replaced; rows are kept as
    they are, repeated ones too; an empty table stays empty.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "spans"]
    names = [unused(docs, f"_{k.name}") for k in KINDS]
    found = docs.select("*", *[_spans(text_or_empty(), k).alias(n) for k, n in zip(KINDS, names)])
    return found.select(*rest, F.concat(*[F.col(n) for n in names]).cast(_SPANS).alias("spans"))
