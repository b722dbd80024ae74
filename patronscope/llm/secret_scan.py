"""Secret scan with DataFrame functions only: fixed patterns and sliding-window entropy.

Base kinds are three patterns whose positions follow from the matches and the text between
them. The method adds ``entropy`` spans: candidate strings of ``MIN_CANDIDATE`` or more
characters of the base64 alphabets are read through a window of ``WINDOW`` characters; the
counts of the window change by one character in and one out per step, and with them the sum
that gives the Shannon entropy. A candidate is a secret if the entropy of some window
reaches the bound of its character class. Candidates that an allow-list pattern or string
covers, and candidates that overlap a base span, add nothing.

Every step is a JVM expression on one row; nothing is shuffled. A document that no
pattern can match costs one regular-expression pass per kind. Work grows with the length of a text
and, but for the sort of its spans, with their number: no pattern repeats a group, every step of the window changes six numbers,
sums and maxima run over blocks, and spans that overlap are found by such a maximum.

Defined cases: NULL text is ''; positions are code points; repeated rows are repeated;
other columns are ignored by ``spans`` and kept by ``redact``; no rows give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronscope.llm.common import free

#: The base patterns, and least lengths of what they match (fixed values).
ASSIGN = (
    r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_VALUE = 6

WINDOW = 20
MIN_CANDIDATE = 20
_WORD = "A-Za-z0-9+/=_-"
CANDIDATE = rf"(?<![{_WORD}])[{_WORD}]{{{MIN_CANDIDATE},}}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-"
#: Bits per character that a window must reach, by the class of the candidate.
BOUNDS = {"hex": 3.0, "mixed": 3.6, "single_case": 3.9}
#: Candidates that are no secrets: UUIDs, plain numbers, words without digits, and texts
#: that say they are placeholders; also file and link paths, see ``is_path``.
ALLOWED_PATTERNS = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"^[0-9+/=_-]+$",
    r"^[A-Za-z+/=_-]+$",
    r"(?i)example|placeholder|your[_-]|xxxxx",
)

FOUND = "struct<start:bigint,kind_no:int,end:bigint,kind:string,own:string>"
#: Up to so many spans are cut out of a text by position.
FEW_SPANS = 64
#: Elements of an array over which a running sum is built anew for each.
_BLOCK = 128
#: Counts of 5 bits, twelve in a number.
_COUNT_BITS, _PER_NUMBER = 5, 12
_NUMBERS = -(-(len(ALPHABET) + 1) // _PER_NUMBER)


def _none(kind: str) -> Column:
    return F.expr(f"cast(array() as array<{kind}>)")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once: the one element of an array."""
    return F.get(F.transform(F.array(value), body), 0)


def running(values: Column, both: Callable[[Column, Column], Column]) -> Column:
    """The running fold of an array of numbers from 0, up to and with each element.

    Nothing that grows is passed from element to element (Spark would copy it at every step): each block is folded, then
    each element within its block, after the fold of the blocks before.
    """

    def fold(xs: Column) -> Column:
        return F.aggregate(xs, F.lit(0).cast("long"), lambda acc, x: both(acc, x).cast("long"))

    def over(xs: Column) -> Column:
        def block(i: Column) -> Column:
            return F.slice(xs, i * _BLOCK + 1, F.lit(_BLOCK))

        numbers = F.sequence(F.lit(0), F.floor(F.size(xs) / _BLOCK).cast("int"))

        def after(folds: Column) -> Column:
            def part(i: Column) -> Column:
                known = F.struct(block(i).alias("own"), fold(F.slice(folds, F.lit(1), i)).alias("before"))
                return _let(
                    known,
                    lambda k: F.transform(
                        k["own"], lambda x, at: both(k["before"], fold(F.slice(k["own"], F.lit(1), at + 1)))
                    ),
                )

            return F.flatten(F.transform(numbers, part))

        return _let(F.transform(numbers, lambda i: fold(block(i))), after)

    return _let(values, over)


def _sum(a: Column, b: Column) -> Column:
    return a + b


def _spans(text: Column, pattern: str, kind_no: int, kind: str, value: Column | None = None) -> Column:
    """Spans of the pattern's matches and what they match, leftmost first; ``value``: the texts to judge by length."""

    def located(found: Column) -> Column:
        before = F.slice(F.split(text, pattern, -1), 1, F.size(found))
        steps = F.zip_with(before, found, lambda x, y: F.char_length(x) + F.char_length(y))
        judged = found if value is None else value
        rows = F.arrays_zip(found.alias("own"), running(steps, _sum).alias("end"), judged.alias("judged"))
        kept = F.filter(rows, lambda x: F.char_length(x["judged"]) >= (0 if value is None else ASSIGN_VALUE))
        return F.transform(
            kept,
            lambda x: F.struct(
                (x["end"] - F.char_length(x["own"])).alias("start"),
                F.lit(kind_no).alias("kind_no"),
                x["end"].alias("end"),
                F.lit(kind).alias("kind"),
                x["own"].alias("own"),
            ),
        )

    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), located)


def _or_none(condition: Column, spans: Column) -> Column:
    """``spans`` where the text can match at all, else no spans."""
    return F.when(condition, spans).otherwise(_none(FOUND))


def characters(text: Column) -> Column:
    """The code points of a text, one by one."""
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


def window_entropy(text: Column, window: int = WINDOW) -> Column:
    """The largest entropy of ``window`` neighbouring characters, by incremental counts.

    The counts are ``_NUMBERS`` numbers of twelve counts each. A step adds one to the count of the character
    that enters, takes one from that of the character that leaves, and changes the sum of
    ``c log c`` by the difference of these two.
    """
    if not 1 < window < 1 << _COUNT_BITS:
        raise ValueError("a count takes five bits")
    sums = [c * math.log2(c) if c else 0.0 for c in range(window + 1)]
    steps = F.array(*[F.lit(b - a) for a, b in zip(sums, sums[1:])])
    # where the count of a character is: the number, and the bits below it
    places = F.array(
        *[
            F.lit((i // _PER_NUMBER << 6) + _COUNT_BITS * (i % _PER_NUMBER))
            for i in range(len(ALPHABET) + 1)
        ]
    )
    codes = F.transform(characters(text), lambda c: F.get(places, F.instr(F.lit(ALPHABET), c)))
    # -2: the window is not full yet, -1: it is full for the first time
    before = F.concat(F.array_repeat(F.lit(-2), window - 1), F.array(F.lit(-1)))

    def count(acc: Column, at: Column) -> Column:
        number = acc[f"w{_NUMBERS - 1}"]
        for i in reversed(range(_NUMBERS - 1)):
            number = F.when(at < (i + 1 << 6), acc[f"w{i}"]).otherwise(number)
        return _shifted("shiftright", number, at).bitwiseAND(F.lit((1 << _COUNT_BITS) - 1)).cast("int")

    def step(acc: Column, x: Column) -> Column:
        a, b = x["a"], x["b"]
        leaves = b >= 0
        change = F.get(steps, count(acc, a)) - F.when(leaves, F.get(steps, count(acc, b) - 1)).otherwise(0.0)
        total = acc["total"] + F.when(a == b, F.lit(0.0)).otherwise(change)
        numbers = []
        for i in range(_NUMBERS):
            enters_here = (a >= (i << 6)) & (a < (i + 1 << 6))
            leaves_here = (b >= (i << 6)) & (b < (i + 1 << 6))
            one = F.lit(1).cast("long")
            more = F.when(enters_here, _shifted("shiftleft", one, a)).otherwise(0)
            less = F.when(leaves_here, _shifted("shiftleft", one, b)).otherwise(0)
            numbers.append((acc[f"w{i}"] + more - less).alias(f"w{i}"))
        least = F.when(b >= -1, F.least(acc["least"], total)).otherwise(acc["least"])
        return F.struct(*numbers, total.alias("total"), least.alias("least"))

    # the largest entropy has the smallest sum
    none = F.lit(window * math.log2(window))
    start = F.struct(
        *[F.lit(0).cast("long").alias(f"w{i}") for i in range(_NUMBERS)],
        F.lit(0.0).alias("total"),
        none.alias("least"),
    )
    def best(codes: Column) -> Column:
        left = F.slice(F.concat(before, codes), 1, F.size(codes))
        pairs = F.arrays_zip(codes.alias("a"), left.alias("b"))
        return F.aggregate(pairs, start, step, lambda acc: F.lit(math.log2(window)) - acc["least"] / window)

    return _let(codes, best)


def _shifted(function: str, number: Column, at: Column) -> Column:
    """``number`` shifted by the place within a number; places are 64 apart from one number to the next."""
    return F.call_function(function, number, at.bitwiseAND(F.lit(63)))


def is_path(text: Column) -> Column:
    """Whether a text is runs of letters or of digits with separators between them."""
    return (
        text.rlike("^/?[A-Za-z0-9]")
        & text.rlike("[A-Za-z0-9]/?$")
        & text.rlike("[A-Za-z0-9][/_-]+[A-Za-z0-9]")
        & ~text.rlike("[^A-Za-z0-9/_-]|[A-Za-z][0-9]|[0-9][A-Za-z]")
    )


def is_secret(text: Column, allowed: Sequence[str] = ()) -> Column:
    """Whether a candidate's entropy reaches its class's bound and no allow-list entry covers it."""
    is_hex = text.rlike(r"^[0-9a-f]+$|^[0-9A-F]+$")
    is_mixed = text.rlike("[a-z]") & text.rlike("[A-Z]") & text.rlike("[0-9]")
    bound = (
        F.when(is_hex, BOUNDS["hex"]).when(is_mixed, BOUNDS["mixed"]).otherwise(BOUNDS["single_case"])
    )
    suppressed = F.lit(False)
    for pattern in ALLOWED_PATTERNS:
        suppressed = suppressed | text.rlike(pattern)
    suppressed = suppressed | is_path(text)
    if allowed:
        suppressed = suppressed | text.isin(list(allowed))
    return F.when(suppressed, F.lit(False)).otherwise(window_entropy(text) >= bound)


def _apart(base: Column, candidates: Column) -> Column:
    """Candidates that overlap no base span.

    Candidates don't overlap each other. So, in the order of their starts, one is apart if the base spans before
    it have ended and the next span starts behind it.
    """

    def judged(spans: Column) -> Column:
        ends = F.transform(spans, lambda x: F.when(x["kind"] == "entropy", 0).otherwise(x["end"]))
        starts = F.transform(F.slice(spans, 2, F.size(spans)), lambda x: x["start"])
        rows = F.arrays_zip(
            spans.alias("x"), running(ends, F.greatest).alias("ended"), starts.alias("next")
        )
        apart = F.filter(
            rows,
            lambda r: (r["x"]["kind"] == "entropy")
            & (r["ended"] <= r["x"]["start"])
            & (r["next"].isNull() | (r["next"] >= r["x"]["end"])),
        )
        return F.transform(apart, lambda r: r["x"])

    return _let(F.array_sort(F.concat(base, candidates)), judged)


def with_spans(documents: DataFrame, name: str, allowed: Sequence[str] = ()) -> DataFrame:
    """Adds the column ``name``, an array of all spans by start and then kind."""
    text_name, base_name, more_name = (free(documents, f"secret_{x}") for x in ("text", "base", "more"))
    text = F.col(text_name)
    base = F.concat(
        _or_none(
            text.rlike(ASSIGN),
            _spans(text, ASSIGN, 0, "assign", F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))),
        ),
        _or_none(text.contains("AKIA"), _spans(text, ACCESS, 1, "access")),
        _or_none(text.rlike(HEX), _spans(text, HEX, 2, "hex")),
    )
    candidates = _or_none(text.rlike(CANDIDATE), _spans(text, CANDIDATE, 3, "entropy"))
    more = F.col(more_name)
    apart = F.when(F.size(base_name) > 0, _apart(F.col(base_name), more)).otherwise(more)
    added = F.when(F.size(more) > 0, F.filter(apart, lambda x: is_secret(x["own"], allowed))).otherwise(more)
    named = ("start", "kind_no", "end", "kind")
    spans = F.transform(F.array_sort(F.concat(base_name, added)), lambda x: F.struct(*[x[n].alias(n) for n in named]))
    return (
        documents.withColumn(text_name, F.coalesce(F.col("text").cast("string"), F.lit("")))
        .withColumn(base_name, base)
        .withColumn(more_name, candidates)
        .withColumn(name, spans)
        .drop(text_name, base_name, more_name)
    )


def _joined(spans: Column) -> Column:
    named = F.transform(
        spans,
        lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(named, ",")


def spans(documents: DataFrame, allowed: Sequence[str] = ()) -> DataFrame:
    """Per document: spans of each base kind, their digest, and all spans as text."""
    found = with_spans(documents.select("doc_id", "text"), "all", allowed)
    s = F.col("all")

    def count(kind: str) -> Column:
        return F.size(F.filter(s, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter(s, lambda x: x["kind"] != "entropy")
    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(s).alias("spans"),
    )


def redact(documents: DataFrame, mark: str = "[SECRET]", allowed: Sequence[str] = ()) -> DataFrame:
    """The documents with each span (overlapping ones as one) replaced by ``mark``."""
    name = free(documents, "secret_spans")
    found = with_spans(documents, name, allowed)
    text = F.col("text").cast("string")

    def gaps(spans: Column) -> Column:
        """What lies before, between and after the spans."""

        def between(ended: Column) -> Column:
            before = F.concat(F.array(F.lit(0).cast("long")), ended)
            starts = F.concat(F.transform(spans, lambda x: x["start"]), F.array(F.char_length(text).cast("long")))
            rows = F.arrays_zip(before.alias("start"), starts.alias("end"))
            last = F.size(starts) - 1
            return F.filter(rows, lambda x, i: (x["end"] >= x["start"]) | (i == last))

        return _let(running(F.transform(spans, lambda x: x["end"]), F.greatest), between)

    def piece(x: Column) -> Column:
        return F.substring(text, (x["start"] + 1).cast("int"), (x["end"] - x["start"]).cast("int"))

    def joined(own: Column) -> Column:
        def part(x: Column) -> Column:
            return F.array_join(F.slice(own, (x["start"] + 1).cast("int"), (x["end"] - x["start"]).cast("int")), "")

        return F.array_join(F.transform(gaps_name, part), mark)

    gaps_name = free(found, "secret_gaps")
    found = found.withColumn(gaps_name, gaps(F.col(name)))
    # a substring is sought from the start of the text: many of them are cut from its characters
    few = F.array_join(F.transform(gaps_name, piece), mark)
    many = _let(characters(text), joined)
    rebuilt = F.when(F.size(name) <= FEW_SPANS, few).otherwise(many)
    result = found.withColumn("text", F.when(F.size(name) > 0, rebuilt).otherwise(text))
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        result = result.withColumn("n_chars", F.char_length("text").cast(kind))
    return result.select(documents.columns)
