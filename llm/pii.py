"""Personal data in texts: patterns propose, checksums confirm, nearby words adjust the score.

Four base kinds are reported whatever their score: e-mail addresses, IPv4 addresses, payment cards (Luhn) and
phone numbers with a plus sign. Further kinds are proposed by their own patterns, must pass their validator (Luhn,
mod-97, number ranges) and are reported if the score reaches the threshold: the prior of the kind, plus or minus what
words close by give. Close by are the `BEFORE` code points before and the `AFTER` code points after a candidate, up
to the next candidate of the same kind. Added spans overlap no base span and none of a kind listed before.

Everything is built-in functions. Patterns are possessive and start only where a run starts, so that a text of any
length is read once; places come from prefix sums in log n rounds over arrays, never by appending to one. Spans
are in code points, ends exclusive.

Defined cases. A null or empty text has no spans and stays as it is. Repeated rows give repeated results. An empty
table gives no rows. Other columns are kept by `redact` and not read by `scan`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.arrays import highest, lowest_behind, matches, quoted

#: Code points before and after a candidate that count as close by, what a word there adds or takes, and the
#: score from which an added span is reported.
BEFORE, AFTER = 40, 20
NEAR, DOUBT, THRESHOLD = 0.35, 0.3, 0.6

_SPANS = "array<struct<start:int,kind:int,end:int,score:double>>"
_FOUND = "array<struct<start:int,end:int,text:string,before:string,after:string>>"

# Lengths of international bank account numbers by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20,
    "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27,
    "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24,
    "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TR": 26,
}

#: Words before a number that make it less likely to be personal, whatever its kind.
DOUBTFUL = r"(?i)\b(?:order|invoice|isbn|issn|doi|version|page|tracking|serial|part|article|ticket)\b"


@dataclass(frozen=True)
class Kind:
    """pattern: Java; guard: a text that every match holds, if any; valid: SQL over the candidate c;
    end: SQL of the span's length if shorter than the match; context: words that raise the score."""

    name: str
    pattern: str
    valid: str = "true"
    guard: str | None = None
    prior: float = 1.0
    context: str | None = None
    length: str = "length(c.text)"


def _digits(text: str) -> str:
    return rf"regexp_replace({text}, '[^0-9]', '')"


def luhn(digits: str) -> str:
    """SQL: whether a text of digits passes Luhn's check."""
    return f"""(aggregate(transform(split(reverse({digits}), ''), (d, i) -> int(d) * (1 + i % 2)), 0,
        (acc, v) -> acc + v - CASE WHEN v > 9 THEN 9 ELSE 0 END) % 10 = 0)"""


def mod97(text: str) -> str:
    """SQL: whether an account number without spaces passes the check by 97, letters being 10 to 35."""
    turned = f"split(concat(substring({text}, 5), substring({text}, 1, 4)), '')"
    return f"""(aggregate({turned}, 0, (acc, ch) -> CASE WHEN ch < 'A' THEN (acc * 10 + int(ch)) % 97
        ELSE (acc * 100 + ascii(ch) - 55) % 97 END) = 1)"""


def _count(text: str, least: int, most: int) -> str:
    return f"length({_digits(text)}) BETWEEN {least} AND {most}"


def _iban_length() -> str:
    cases = " ".join(f"WHEN '{c}' THEN {n}" for c, n in IBAN_LENGTHS.items())
    return f"(CASE substring(c.text, 1, 2) {cases} ELSE 99 END)"


_PLAIN = "replace(c.text, ' ', '')"
_PART = r"regexp_extract(c.text, '(?:^|[ -])((?:[3-6])[0-9]{12,18})(?:[ -]|$)', 1)"
_OCTETS = r"forall(split(c.text, '\\.'), p -> length(regexp_replace(p, '^0+', '')) <= 3 AND coalesce(try_cast(p AS int), 0) <= 255)"

# The four base kinds in their order. They match what the plain patterns match.
BASE = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", guard="@"),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)", _OCTETS, guard="."),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?+[0-9])++",
        f"CASE WHEN {_count('c.text', 14, 19)} THEN {luhn(_digits('c.text'))} ELSE false END",
    ),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", _count("c.text", 10, 15), guard="+"),
)

#: Kinds that the method adds, in order of precedence. Priors below the threshold need a word close by.
ADDED = (
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?+[A-Z0-9]){11,40}+",
        f"CASE WHEN length({_PLAIN}) >= {_iban_length()} THEN {mod97(f'substring({_PLAIN}, 1, {_iban_length()})')} ELSE false END",
        prior=0.9,
        context=r"(?i)\b(?:iban|account|bank|konto|cuenta|compte)\b",
        # As far as the country's length, spaces between included.
        length=rf"length(regexp_extract(c.text, concat('^(?:[A-Z0-9] ?){{', {_iban_length()} - 1, '}}[A-Z0-9]'), 0))",
    ),
    # A card number beside other digits, which the base pattern takes for one long number.
    Kind(
        "card_beside",
        r"[0-9](?:[\x20-]?+[0-9])++",
        rf"CASE WHEN {_count('c.text', 20, 60)} AND {_PART} <> '' THEN {luhn(_PART)} ELSE false END",
        prior=0.7,
        context=r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|karte|tarjeta|carte)\b",
    ),
    Kind(
        "card_short",
        r"(?<![0-9])[0-9](?:[\x20-]?+[0-9])++",
        f"CASE WHEN {_count('c.text', 13, 13)} THEN {luhn(_digits('c.text'))} ELSE false END",
        prior=0.4,
        context=r"(?i)\b(?:card|visa|mastercard|credit|debit|karte|tarjeta|carte)\b",
    ),
    Kind(
        "ipv6",
        r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])",
        guard=":",
        prior=0.8,
    ),
    Kind(
        "ssn",
        r"(?<![0-9A-Za-z-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9A-Za-z-])",
        guard="-",
        prior=0.6,
        context=r"(?i)\b(?:ssn|social security)\b",
    ),
    Kind(
        "phone_local",
        r"(?<![0-9A-Za-z+.-])\(?[0-9][0-9().\x20-]{5,18}[0-9](?![0-9A-Za-z])",
        _count("c.text", 7, 15),
        prior=0.3,
        context=r"(?i)\b(?:phone|tel|telephone|call|mobile|cell|fax|handy|telefon|tel[eé]fono|t[eé]l[eé]phone)\b",
    ),
)
KINDS = tuple(k.name for k in (*BASE, *ADDED))


def _candidates(text: str, kind: Kind) -> Column:
    """All matches with places and what stands beside them. Gaps come from splitting at the same matches."""
    pattern = quoted(kind.pattern)
    seen = f"contains({text}, {quoted(kind.guard)}) AND {text} RLIKE {pattern}" if kind.guard else f"{text} RLIKE {pattern}"
    item = f"""struct(ends[i] - length(m) AS start, ends[i] AS end, m AS text,
        right(x.g[i], {BEFORE}) AS before, left(x.g[i + 1], {AFTER}) AS after)"""
    return F.expr(f"CASE WHEN {seen} THEN {matches(text, pattern, item)} ELSE CAST(array() AS {_FOUND}) END")


def _score(kind: Kind) -> str:
    near = f"c.before RLIKE {quoted(kind.context)} OR c.after RLIKE {quoted(kind.context)}" if kind.context else "false"
    doubt = f"c.before RLIKE {quoted(DOUBTFUL)}"
    return f"round({kind.prior}D + CASE WHEN {near} THEN {NEAR}D ELSE 0D END - CASE WHEN {doubt} THEN {DOUBT}D ELSE 0D END, 6)"


def _spans(candidates: str, kind: Kind, number: int) -> Column:
    """The valid candidates as spans with scores."""
    start = "c.start + instr(c.text, " + _PART + ") - 1" if kind.name == "card_beside" else "c.start"
    length = f"length({_PART})" if kind.name == "card_beside" else kind.length
    return F.expr(
        f"""CAST(transform(filter({candidates}, c -> {kind.valid}), c -> struct({start} AS start, {number} AS kind,
          {start} + {length} AS end, {_score(kind)} AS score)) AS {_SPANS})"""
    )


def _joined(spans: str, new: str, number: int) -> Column:
    """spans and those new ones that overlap none of them, sorted."""
    up_to = highest(f"transform(a, s -> CASE WHEN s.kind = {number} THEN -1 ELSE s.end END)")
    behind = lowest_behind(f"transform(a, s -> CASE WHEN s.kind = {number} THEN 2147483647 ELSE s.start END)")
    return F.expr(
        f"""CASE WHEN size({new}) = 0 THEN {spans} ELSE
          transform(array(sort_array(concat({spans}, {new}))), a -> transform(array(struct({up_to} AS hi, {behind} AS lo)),
            x -> filter(a, (s, i) -> s.kind <> {number} OR (x.hi[i] <= s.start AND x.lo[i] >= s.end)))[0])[0] END"""
    )


def find(docs: DataFrame, added: tuple[Kind, ...] = ADDED, threshold: float = THRESHOLD) -> DataFrame:
    """docs with _base and _spans, sorted arrays of (start, kind, end, score), kinds as numbers."""
    out = docs.withColumn("_text", F.coalesce(F.col("text"), F.lit("")))
    for number, kind in enumerate(BASE):
        out = out.withColumn("_found", _candidates("_text", kind))
        out = out.withColumn(f"_kind{number}", _spans("_found", kind, number))
    names = [f"_kind{number}" for number in range(len(BASE))]
    out = out.withColumn("_base", F.sort_array(F.concat(*names))).drop(*names).withColumn("_spans", F.col("_base"))
    for number, kind in enumerate(added, len(BASE)):
        out = out.withColumn("_found", _candidates("_text", kind)).withColumn("_new", _spans("_found", kind, number))
        out = out.withColumn("_new", F.expr(f"filter(_new, s -> s.score >= {threshold}D)"))
        out = out.withColumn("_spans", _joined("_spans", "_new", number))
    return out.drop("_text", "_found", "_new")


def _written(spans: str) -> Column:
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return F.expr(f"array_join(transform({spans}, s -> concat_ws(':', {names}[s.kind], s.start, s.end)), ',')")


def scan(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of the base spans, and all spans, for every row."""
    found = find(docs.select("doc_id", "text"))
    count = lambda kind: F.expr(f"cast(size(filter(_base, s -> s.kind = {kind})) as long)")
    return found.select(
        "doc_id",
        *[count(number).alias(f"n_{kind.name}") for number, kind in enumerate(BASE)],
        F.sha2(_written("_base"), 256).alias("base_sha256"),
        _written("_spans").alias("spans"),
    )


def redact(docs: DataFrame, mask: str = "[PII]") -> DataFrame:
    """The rows with every span replaced by the mask; overlapping spans become one. Null stays null."""
    found = find(docs.select(F.struct("*").alias("_row"), "text"))
    # reach[i]: the end of all spans up to the i-th one; the text from there to the next start stays.
    before = "CASE WHEN i = 0 THEN 0 ELSE x.reach[i - 1] END"
    start = "CASE WHEN i = size(_spans) THEN size(x.chars) ELSE _spans[i].start END"
    whole = F.expr(
        f"""CASE WHEN size(_spans) = 0 THEN text ELSE
          transform(array(struct(split(text, '') AS chars, {highest("transform(_spans, s -> s.end)")} AS reach)), x ->
            array_join(transform(sequence(0, size(_spans)), i -> concat(
              array_join(slice(x.chars, {before} + 1, greatest({start} - {before}, 0)), ''),
              CASE WHEN i < size(_spans) AND {start} >= {before} THEN {quoted(mask)} ELSE '' END)), ''))[0] END"""
    )
    return found.select(
        *[whole.alias(c) if c == "text" else F.col("_row").getField(c).alias(c) for c in docs.columns]
    )
