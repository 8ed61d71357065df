"""Secrets in texts: fixed patterns, and sliding-window entropy of candidate strings.

Fixed patterns give the spans of the kinds assign, access and hex. In addition, maximal runs of a
character class are candidates. A window slides over each; its Shannon entropy follows from
sum(c * log2 c) over its character counts; sum and counts are changed by the one character that leaves and the one
that enters, so a candidate costs as much as it is long. From the first to the last window that reaches the class's threshold a span is added, unless the
candidate is on the allow list. What earlier spans cover of a candidate, and harmless words in it, are cut out
before: the rest, joined, is what windows slide over, if it is as long as a window and not on the allow list
itself. The span found there is reported without the covered parts, so it may come in pieces, and with the words
that lie inside. Spans are in code points, ends exclusive, and those of entropy overlap no other.

Defined cases. A null or empty text has no spans. Repeated rows give repeated results. An empty table
gives no rows. Other columns are kept by `redact` and not read by `scan`.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.arrays import below, highest, matches, quoted

# The patterns of the three base kinds, in the order of the kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")

#: Words that say nothing: they are cut out of a candidate, the rest is judged.
WORDS = (
    r"(?i)example|placeholder|changeme|xxxxxxxx|dummy|sample",
    r"(?i)0123456789|abcdefghij",
)
#: Candidates that are never reported by entropy.
SHAPES = (
    r"^[0-9]+$",  # numbers
    r"^[A-Za-z]+$",  # words
    r"^[-+/_=]*(.)\1*[-+/_=]*$",  # one character over and over
    r"^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$",  # UUIDs
    r"^[A-Za-z]+([-_/=+]+[A-Za-z]+)+[-_/=+]*$",  # words joined by signs
)
ALLOWED = (*SHAPES, *WORDS)


@dataclass(frozen=True)
class EntropyClass:
    kind: str
    pattern: str
    window: int  # at most 62 characters
    threshold: float
    alphabet: str


CLASSES = (
    EntropyClass("entropy_hex", r"[0-9a-fA-F]{16,}", 16, 2.75, string.hexdigits),
    EntropyClass("entropy_base64", r"[A-Za-z0-9+/_=-]{20,}", 20, 3.7, string.ascii_letters + string.digits + "+/_=-"),
)

_NO_SPANS = "CAST(array() AS array<struct<start:int,kind:int,end:int,text:string>>)"
_NO_PLACES = "CAST(array() AS array<struct<start:int,end:int>>)"
_TRIMMED = "regexp_replace(c.rest, '^[-+/_=]+|[-+/_=]+$', '')"


def _places(text: str, pattern: str) -> str:
    """SQL: start and end of all matches."""
    return matches(text, quoted(pattern), "struct(ends[i] - length(m) AS start, ends[i] AS end)")


def _spans(text: str, pattern: str, kind: int) -> Column:
    """All matches with their places."""
    found = matches(
        text, quoted(pattern), f"struct(ends[i] - length(m) AS start, {kind} AS kind, ends[i] AS end, m AS text)"
    )
    return F.expr(f"CASE WHEN {text} RLIKE {quoted(pattern)} THEN {found} ELSE {_NO_SPANS} END")


def _entropy_span(klass: EntropyClass) -> str:
    """SQL: what of c.rest reaches the threshold, as (low, high); null if no window does.

    The window's counts go along, ten characters of the alphabet in a long, six bits each: the character that leaves
    gives back its one, the one that enters adds its own.
    """
    w = klass.window
    g = "array(0D, 0D, " + ", ".join(f"{n} * log2({n})" for n in range(2, w + 1)) + ")"
    count = lambda c: f"int(shiftright(acc.counts[{c} div 10], int(6 * ({c} % 10))) & 63)"
    one = lambda c: f"CASE WHEN k = {c} div 10 THEN shiftleft(1L, int(6 * ({c} % 10))) ELSE 0L END"
    hot = f"i >= {w} AND round({_log2(w)} - s / {w}, 9) >= {klass.threshold}"
    start = f"struct(array_repeat(0L, {-(-len(klass.alphabet) // 10)}), 0D, NULL, NULL)"
    # Arrays of one value name what would be worked out repeatedly. in: the one that enters, out: that leaves, or -1.
    return f"""
        transform(array(struct(transform(split(c.rest, ''), ch -> instr('{klass.alphabet}', ch) - 1) AS codes, {g} AS g)), x ->
          aggregate(sequence(1, size(x.codes)), CAST({start} AS struct<counts:array<bigint>,s:double,low:int,high:int>),
            (acc, i) -> transform(array(struct(x.codes[i - 1] AS in, CASE WHEN i > {w} THEN x.codes[i - {w} - 1] ELSE -1 END AS out)), z ->
              transform(array(struct(
                  {count('z.in')} - CASE WHEN z.in = z.out THEN 1 ELSE 0 END AS n,
                  CASE WHEN z.out >= 0 THEN {count('z.out')} - 1 ELSE 0 END AS m)), y ->
                transform(array(acc.s + x.g[y.n + 1] - x.g[y.n] - (x.g[CASE WHEN z.out >= 0 THEN y.m + 1 ELSE 0 END] - x.g[y.m])), s ->
                  struct(
                    transform(acc.counts, (v, k) -> v + {one('z.in')} - CASE WHEN z.out >= 0 THEN {one('z.out')} ELSE 0L END) AS counts,
                    s AS s,
                    CASE WHEN {hot} THEN coalesce(acc.low, i - {w}) ELSE acc.low END AS low,
                    CASE WHEN {hot} THEN i ELSE acc.high END AS high))[0])[0])[0],
            acc -> struct(acc.low AS low, acc.high AS high)))[0]"""


def _cut(words: str) -> str:
    """SQL: the candidate c with what is cut out of it (places in c.text) and the places that remain, null for all.

    q holds the spans' starts, and how far they reach up to each of them; both only rise.
    """
    first, behind = below("q.reach", "c.start + 1"), below("q.starts", "c.end")
    return f"""
        transform(array(struct(
            transform(filter(slice(_spans, {first} + 1, {behind} - {first}), b -> b.start < c.end AND c.start < b.end),
              b -> struct(greatest(b.start - c.start, 0) AS start, least(b.end, c.end) - c.start AS end)) AS covered,
            {words} AS words)),
          x -> struct(c.start AS start, c.text AS text, array_sort(x.covered) AS covered,
            CASE WHEN size(x.covered) + size(x.words) > 0 THEN filter(sequence(0, length(c.text) - 1),
              i -> NOT exists(x.covered, r -> r.start <= i AND i < r.end) AND NOT exists(x.words, r -> r.start <= i AND i < r.end))
            END AS places))[0]"""


def _pieces(kind: int) -> str:
    """SQL: the spans of the candidate c, whose places from c.hot.low to c.hot.high are found, without covered parts."""
    piece = lambda a, b: f"array(struct(c.start + {a} AS start, {kind} AS kind, c.start + {b} AS end, c.text AS text))"
    return f"""
        transform(array(struct(
            coalesce(c.places[c.hot.low], c.hot.low) AS low, coalesce(c.places[c.hot.high - 1] + 1, c.hot.high) AS high)),
          x -> aggregate(filter(c.covered, r -> r.end > x.low AND r.start < x.high), struct(x.low AS at, {_NO_SPANS} AS found),
            (acc, r) -> struct(greatest(acc.at, r.end) AS at,
              CASE WHEN r.start > acc.at THEN concat(acc.found, {piece('acc.at', 'r.start')}) ELSE acc.found END AS found),
            acc -> CASE WHEN acc.at < x.high THEN concat(acc.found, {piece('acc.at', 'x.high')}) ELSE acc.found END))[0]"""


def _log2(n: int) -> str:
    return repr(math.log2(n)) + "D"


def add_spans(docs: DataFrame, classes: tuple[EntropyClass, ...] = CLASSES) -> DataFrame:
    """docs with _base and _spans: arrays of (start, kind, end, text), sorted, kinds as numbers."""
    out = docs.withColumn("_text", F.coalesce(F.col("text"), F.lit("")))
    out = out.withColumn("_assign", _spans("_text", ASSIGN, 0))
    value = ASSIGN.replace("\\", "\\\\").replace("'", "\\'")
    out = out.withColumn("_assign", F.expr(f"filter(_assign, s -> length(regexp_extract(s.text, '{value}', 2)) >= 12)"))
    out = out.withColumn(
        "_base", F.sort_array(F.concat("_assign", _spans("_text", ACCESS, 1), _spans("_text", HEX, 2)))
    )
    allowed = lambda x: "(" + " OR ".join(f"{x} RLIKE '" + p.replace("\\", "\\\\") + "'" for p in SHAPES) + ")"
    listed = "|".join(f"(?:{p})" for p in WORDS)
    words = f"CASE WHEN c.text RLIKE '{listed}' THEN {_places('c.text', listed)} ELSE {_NO_PLACES} END"
    out = out.withColumn("_spans", F.col("_base"))
    reach = highest("transform(_spans, s -> s.end)")
    for klass in classes:
        kind = KINDS.index(klass.kind)
        out = out.withColumn("_candidates", _spans("_text", klass.pattern, kind))
        rest = """CASE WHEN c.places IS NULL THEN c.text ELSE
            transform(array(split(c.text, '')), chars -> array_join(transform(c.places, i -> chars[i]), ''))[0] END"""
        for step in (
            f"filter(_candidates, c -> NOT {allowed('c.text')})",
            f"transform(array(struct(transform(_spans, s -> s.start) AS starts, {reach} AS reach)), "
            f"q -> transform(_candidates, c -> {_cut(words)}))[0]",
            f"transform(_candidates, c -> struct(c.start, c.text, c.covered, c.places, {rest} AS rest))",
            f"filter(_candidates, c -> length(c.rest) >= {klass.window} AND (c.places IS NULL OR NOT {allowed(_TRIMMED)}))",
            f"transform(_candidates, c -> struct(c.start, c.text, c.covered, c.places, {_entropy_span(klass)} AS hot))",
            f"flatten(transform(filter(_candidates, c -> c.hot.low IS NOT NULL), c -> {_pieces(kind)}))",
        ):
            out = out.withColumn("_candidates", F.expr(step))
        out = out.withColumn("_spans", F.concat("_spans", "_candidates"))
    return out.withColumn("_spans", F.sort_array("_spans")).drop("_text", "_assign", "_candidates")


def _written(spans: str) -> Column:
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return F.expr(f"array_join(transform({spans}, s -> concat_ws(':', {names}[s.kind], s.start, s.end)), ',')")


def scan(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of the base spans, and all spans, for every row."""
    found = add_spans(docs.select("doc_id", "text"))
    count = lambda kind: F.expr(f"cast(size(filter(_base, s -> s.kind = {kind})) as long)")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_written("_base"), 256).alias("base_sha256"),
        _written("_spans").alias("spans"),
    )


def redact(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """The rows with every secret replaced by the mask; overlapping spans become one. Null stays null."""
    found = add_spans(docs.select(F.struct("*").alias("_row"), "text"))
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
