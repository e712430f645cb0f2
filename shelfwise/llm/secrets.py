"""Secret scan: known key formats, and sliding-window entropy over candidate strings (DataFrame functions only)."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _any_case(word: str) -> str:
    """The letters of an ASCII word in either case, as a pattern that every engine reads alike."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


#: Assignments: the keyword, then the value as group 2. Matches are found first and judged by length afterwards,
#: so that a short value hides what follows inside its match.
ASSIGN = ("(" + "|".join(_any_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
          + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_CHARS = 12
#: Runs of the class are maximal, so the least length can stand in the pattern.
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"


@dataclass(frozen=True)
class Alphabet:
    """A character class whose runs of ``window`` characters or more are candidates; a window is suspicious
    from ``bits`` of Shannon entropy a character on."""

    kind: str
    chars: str
    window: int
    bits: float


#: Random strings of these windows have about 3.5 and 4.0 bits, words and identifiers rarely over 3.3 and 3.8.
ALPHABETS = (Alphabet("entropy_hex", "[0-9A-Fa-f]", 24, 3.35), Alphabet("entropy_text", r"[A-Za-z0-9+/_=-]", 20, 3.9))

#: Candidates that hold one of these are no secrets: placeholders, alphabets in order, UUIDs.
ALLOWED = ("(?i)example|sample|dummy|placeholder|changeme|redacted|x{6}|0123456789|abcdefghij"
           "|[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}")

#: Entropy is summed in whole units of 2**-20 bits.
UNIT = 1 << 20
#: Elements of an array whose running sums are formed together, and characters of a candidate scanned together.
CHUNK, STRETCH = 512, 128


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _scan(xs: Column, start: Column) -> Column:
    """Running sums of a short array, the start first."""
    return F.aggregate(xs, F.array(start), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))


def running_sums(xs: Column) -> Column:
    """Sums before each element of an array of longs; in chunks, as growing an array copies it."""
    return let(xs, _running_sums)


def _running_sums(xs: Column) -> Column:
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.greatest(F.size(xs), F.lit(1)) - 1) / CHUNK).cast("int")),
                         lambda c: F.slice(xs, c * CHUNK + 1, F.lit(CHUNK)))
    totals = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x))
    bases = _scan(totals, F.lit(0).cast("long"))
    sums = F.zip_with(chunks, F.slice(bases, F.lit(1), F.size(chunks)), lambda c, b: _scan(c, b))
    return F.flatten(F.transform(sums, lambda s: F.slice(s, F.lit(1), F.size(s) - 1)))


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """array<struct<start, end, found>> of the leftmost matches that do not overlap, by code points. Texts
    between the matches give the positions; ``found`` is the group's string."""
    p = F.lit(pattern)
    size = lambda xs: F.transform(xs, lambda x: F.length(x).cast("long"))

    def place(x: Column) -> Column:
        gap, length = size(F.slice(x["between"], F.lit(1), F.size(x["whole"]))), size(x["whole"])
        found = x["whole"] if group == 0 else F.regexp_extract_all(text, p, F.lit(group))
        rows = F.arrays_zip(running_sums(F.zip_with(gap, length, lambda g, n: g + n)).alias("base"), gap.alias("gap"),
                            length.alias("length"), found.alias("found"))
        return F.transform(rows, lambda r: F.struct(
            (r["base"] + r["gap"]).alias("start"), (r["base"] + r["gap"] + r["length"]).alias("end"), r["found"].alias("found")))

    both = F.struct(F.regexp_extract_all(text, p, F.lit(0)).alias("whole"), F.split(text, pattern, -1).alias("between"))
    none = F.array().cast("array<struct<start:bigint,end:bigint,found:string>>")
    return F.when(F.rlike(text, p), let(both, place)).otherwise(none)


def entropy_units(window: int) -> list[int]:
    """Whole-number c * log2(c) for the counts 0 to ``window``, in units of 2**-20 bits."""
    return [0, *(round(c * math.log2(c) * UNIT) for c in range(1, window + 1))]


def entropy_limit(a: Alphabet) -> int:
    """A window is suspicious when its sum of c * log2(c) is at most this."""
    return entropy_units(a.window)[a.window] - round(a.bits * a.window * UNIT)


def _hot_ends(piece: Column, a: Alphabet) -> Column:
    """'1' for every character of an ASCII string at which a suspicious window ends, else '0'.

    The state holds the count of every character as a string of 128 counts, and the sum of c * log2(c); a
    step takes the entering character in, the leaving one out, and touches nothing else."""
    table = F.array(*(F.lit(x).cast("long") for x in entropy_units(a.window)))
    at = lambda char: F.ascii(char) + 1
    count = lambda counts, char: F.ascii(F.substr(counts, at(char), F.lit(1))) - 48
    cost = lambda n: F.element_at(table, n + 1)
    put = lambda counts, char, n: F.overlay(counts, F.chr(n + 48), at(char), F.lit(1))

    def step(s: Column, i: Column) -> Column:
        leaves, enters = F.substr(piece, i - a.window, F.lit(1)), F.substr(piece, i, F.lit(1))
        leave = lambda n: F.struct(
            put(s["counts"], leaves, n - 1).alias("counts"), (s["total"] + cost(n - 1) - cost(n)).alias("total"))
        left = F.when(i > a.window, let(count(s["counts"], leaves), leave)).otherwise(
            F.struct(s["counts"].alias("counts"), s["total"].alias("total")))

        def enter(t: Column) -> Column:
            return let(count(t["counts"], enters), lambda n: F.struct(
                put(t["counts"], enters, n + 1).alias("counts"), (t["total"] + cost(n + 1) - cost(n)).alias("total")))

        return let(let(left, enter), lambda t: F.struct(t["counts"].alias("counts"), t["total"].alias("total"), F.concat(
            s["hot"], F.when((i >= a.window) & (t["total"] <= F.lit(entropy_limit(a))), F.lit("1")).otherwise(F.lit("0"))).alias("hot")))

    zero = F.struct(F.lit("0" * 128).alias("counts"), F.lit(0).cast("long").alias("total"), F.lit("").alias("hot"))
    return F.aggregate(F.sequence(F.lit(1), F.length(piece)), zero, step, lambda s: s["hot"])


def suspicious(candidate: Column, a: Alphabet) -> Column:
    """The characters that lie in a suspicious window, as '1' in a string of '0' and '1'. A candidate is cut
    into stretches, each scanned with the end of the one before it."""
    over = a.window - 1

    def scan(parts: Column) -> Column:
        def one(part: Column, k: Column) -> Column:
            before = F.when(k > 0, F.right(F.element_at(parts, F.greatest(k, F.lit(1))), F.lit(over))).otherwise(F.lit(""))
            return let(F.concat(before, part), lambda x: F.substr(
                _hot_ends(x, a), F.length(x) - F.length(part) + 1, F.length(part)))

        return F.array_join(F.transform(parts, one), "")

    ends = let(F.regexp_extract_all(candidate, F.lit(f".{{1,{STRETCH}}}"), F.lit(0)), scan)
    return F.regexp_replace(ends, F.lit(f"0(?=0{{0,{over - 1}}}1)"), F.lit("1"))


def _plain(word: Column) -> Column:
    """Words, identifiers and paths without digits: no lower-case letter before a capital, no run of capitals
    before a lower-case one."""
    return ~F.rlike(word, F.lit("[0-9]")) & ~F.rlike(word, F.lit("[a-z][A-Z]|[A-Z]{2}[a-z]"))


def _numbers(word: Column) -> Column:
    """Digits and separators only: dates, amounts, telephone and serial numbers."""
    return ~F.rlike(word, F.lit("[A-Za-z]"))


def entropy_spans(text: Column, a: Alphabet, allowed: str) -> Column:
    """array<struct<start, end>>: stretches of suspicious windows in the candidates that are not allowed."""
    candidates = F.filter(matches(text, f"{a.chars}{{{a.window},}}"), lambda x: ~(
        F.rlike(x["found"], F.lit(allowed)) | _plain(x["found"]) | _numbers(x["found"])))
    runs = F.transform(candidates, lambda x: F.transform(matches(suspicious(x["found"], a), "1+"), lambda r: F.struct(
        (x["start"] + r["start"]).alias("start"), (x["start"] + r["end"]).alias("end"))))
    return F.flatten(runs)


def _named(found: Column, rank: int, kind: str) -> Column:
    return F.transform(found, lambda x: F.struct(
        x["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), x["end"].alias("end")))


def scan_secrets(docs: DataFrame, alphabets: Sequence[Alphabet] = ALPHABETS, allowed: str = ALLOWED, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, spans) for every row of ``docs``; spans: array<struct<start, rank, kind, end>> in order.

    Base spans, each kind's leftmost matches that do not overlap: ``assign`` (keyword, sign and a value of 12
    characters or more), ``access`` (18 or more), ``hex`` (16 or more). Entropy spans: a run of ``window`` or
    more characters of an alphabet is a candidate unless the allow-list or one of two rules (plain words,
    plain numbers) clears it; every window of it whose Shannon entropy a character reaches the alphabet's
    bound is part of a span, and windows that overlap or touch make one. Entropy spans may overlap base spans, which
    always stay. Positions count code points, the end is exclusive. Spans are ordered by start, then as listed here.

    A null text is an empty one and has no spans. Texts of any length are scanned whole, within their row:
    no rows are shuffled. Repeated rows give equal rows; a null id stays null; other columns are not read; an
    empty table gives no rows."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    text = F.col("text")
    assign = F.filter(matches(text, ASSIGN, 2), lambda x: F.length(x["found"]) >= ASSIGN_CHARS)
    kinds = [("assign", assign), ("access", matches(text, ACCESS)), ("hex", matches(text, HEX))]
    kinds += [(a.kind, entropy_spans(text, a, allowed)) for a in alphabets]
    named = [_named(found, rank, kind) for rank, (kind, found) in enumerate(kinds)]
    return src.select("doc_id", F.array_sort(F.concat(*named)).alias("spans"))


def secret_digest(result: DataFrame) -> DataFrame:
    """The query's columns: counts and digest of the base spans, and all spans as text."""
    spans = F.col("spans")
    write = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    number = lambda rank: F.size(F.filter(spans, lambda x: x["rank"] == rank)).cast("long")
    return result.select(
        "doc_id", number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"),
        F.sha2(write(F.filter(spans, lambda x: x["rank"] < 3)), 256).alias("base_sha256"), write(spans).alias("spans"))
