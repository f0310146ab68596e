"""Cutting long texts into pieces of bounded size, in built-in expressions, and repairs that need the lines before."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lorebank.functions.text import BLANK, once, trimmed

# A sentence and the end of one, by the format's own rule (the blank after it belongs to it).
_SENTENCE = rf"(?:\G|(?<=[.!?]))[^.!?]++[.!?]++(?:{BLANK}|\z)"
_AFTER_SENTENCE = rf"(?<=[.!?]{BLANK})"

_RUNS = "array<struct<first:int,n:int>>"


def _runs(sizes: Column, limit: int, gap: int) -> Column:
    """Runs (first, n) of sizes whose sum, with ``gap`` between any two, stays within the limit, filled in order.

    A size beyond it stands alone, zeros at a start vanish. The fold carries numbers only, and the runs so far."""
    state = F.struct(*(F.lit(0).alias(c) for c in ("at", "first", "n", "size")), F.array().cast(_RUNS).alias("done"))

    def with_last(s: Column) -> Column:
        return F.concat(s["done"], F.array(F.struct(s["first"].alias("first"), s["n"].alias("n"))))

    def step(s: Column, x: Column) -> Column:
        full = (s["n"] > 0) & (s["size"] + gap + x > limit)
        begins = full | (s["n"] == 0)
        return F.struct(
            (s["at"] + 1).alias("at"), F.when(begins, s["at"]).otherwise(s["first"]).alias("first"),
            F.when(begins, (x > 0).cast("int")).otherwise(s["n"] + 1).alias("n"),
            F.when(begins, x).otherwise(s["size"] + gap + x).alias("size"),
            F.when(full, with_last(s)).otherwise(s["done"]).alias("done"),
        )

    return F.aggregate(sizes, state, step, lambda s: F.when(s["n"] > 0, with_last(s)).otherwise(s["done"]))


def _joined_runs(pieces: Column, limit: int, between: str) -> Column:
    """Pieces joined within the limit, an array of texts."""
    return once(
        pieces,
        lambda p: F.transform(_runs(F.transform(p, lambda x: F.length(x)), limit, len(between)), lambda r: F.array_join(F.slice(p, r["first"] + 1, r["n"]), between)),
    )


def pack_lines(c: Column, limit: int) -> Column:
    """Runs of whole lines of at most ``limit`` characters; a longer line stands alone, blank lines at a start vanish."""
    return _joined_runs(F.split(c, "\n", -1), limit, "\n")


def sentences(c: Column, lossless: bool = False) -> Column:
    """Sentences with the blank after them. Not lossless: a tail without an end and text before an inner dot are lost."""
    if lossless:
        return F.filter(F.split(c, _AFTER_SENTENCE, -1), lambda s: s != "")
    return F.regexp_extract_all(c, F.lit(_SENTENCE), F.lit(0))


def split_long(c: Column, limit: int = 3000, lossless: bool = False, trim_lone: bool = True) -> Column:
    """A text beyond the limit as runs of whole sentences within it, trimmed; a longer sentence stays whole.

    Without ``trim_lone`` a sentence within the limit that is the only one of its text stays as it was found, with the blank after it."""

    def parts(t: Column) -> Column:
        found = once(sentences(t, lossless), lambda s: F.when(F.size(s) == 0, F.array(t)).otherwise(s))
        packed = lambda s: F.filter(F.transform(_joined_runs(s, limit, ""), trimmed), lambda p: p != "")
        if trim_lone:
            return packed(found)
        return once(found, lambda s: F.when((F.size(s) == 1) & (F.length(s[0]) <= limit), s).otherwise(packed(s)))

    return once(c, lambda t: F.when(F.length(t) <= limit, F.array(t)).when(t.isNotNull(), parts(t)))


def bisect(c: Column, share: float = 0.15) -> Column:
    """Two parts: at the middle line if neither is too small, else at the first space from the middle on."""

    def at_space(t: Column) -> Column:
        middle = F.floor(F.length(t) / 2).cast("int")
        found = F.call_function("locate", F.lit(" "), t, middle + 1)
        return once(F.when(found > 0, found - 1).otherwise(middle), lambda n: F.array(F.substring(t, F.lit(1), n), F.substring(t, n + 1, F.length(t))))

    def by_lines(t: Column) -> Column:
        def halves(lines: Column) -> Column:
            middle = F.greatest(F.lit(1), F.floor(F.size(lines) / 2).cast("int"))
            return F.array(F.array_join(F.slice(lines, F.lit(1), middle), "\n"), F.array_join(F.slice(lines, middle + 1, F.size(lines)), "\n"))

        return once(F.split(t, "\n", -1), halves)

    def either(t: Column) -> Column:
        return once(by_lines(t), lambda h: F.when(F.least(F.length(h[0]), F.length(h[1])) > share * F.length(t), h).otherwise(at_space(t)))

    return once(c, lambda t: F.when(t.isNotNull(), either(t)))


def without_ghosts(text: str, span: int = 12, long_title: int = 300) -> tuple[str, int]:
    """Drops repeated front matter behind the real one, and counts it."""
    lines = text.split("\n")
    rule = [i for i, line in enumerate(lines) if line.strip() == "---"]
    if not lines or lines[0].strip() != "---" or len(rule) < 2:
        return text, 0
    out, i, removed = lines[: rule[1] + 1], rule[1] + 1, 0
    while i < len(lines):
        if lines[i].strip() == "---":
            near = range(i + 1, min(len(lines), i + span))
            close = next((j for j in near if lines[j].strip() == "---"), None)
            titles = [j for j in near if lines[j].startswith("title:") and (close is None or j < close)]
            end = close if titles and close is not None else titles[-1] if titles and len(lines[titles[-1]]) > long_title else None
            if end is not None:
                removed, i = removed + 1, end + 1
                continue
        out.append(lines[i])
        i += 1
    return "\n".join(out), removed


def needs_split(source: Column, out: Column, share: float = 0.65) -> Column:
    """The output is too short for its source."""
    return F.length(out) < F.length(source) * F.lit(share)


@F.pandas_udf(T.StructType().add("text", T.StringType()).add("removed", T.IntegerType()))
def _without_ghosts(texts: pd.Series) -> pd.DataFrame:
    rows = [(None, 0) if t is None else without_ghosts(t) for t in texts]
    return pd.DataFrame(rows, columns=["text", "removed"])


def strip_ghost_blocks(c: Column) -> Column:
    """(text, removed): a text without repeated front matter. Python sees those with three rules at least, no others."""
    third = F.octet_length(F.substring_index(c, "---", 3)) < F.octet_length(c)
    held = _without_ghosts(F.when(third, c))
    return F.struct(F.coalesce(held["text"], c).alias("text"), held["removed"].alias("removed"))


def unpack(pieces: DataFrame, key: str, pos: str, text: str) -> DataFrame:
    """One text a key: its pieces in order, trimmed, a blank line between."""
    rows = F.sort_array(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(text).alias("t"))))
    return pieces.groupBy(key).agg(F.trim(F.array_join(F.transform(rows, lambda r: F.trim(r["t"])), "\n\n")).alias(text))
