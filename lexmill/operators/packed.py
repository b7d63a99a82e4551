"""Several values packed in one text field -> one row per value.

The text is read by a parsing expression grammar (PEG): alternatives are tried
in order and a failed one gives its input back.

    field    <- blank* (wrapped / list) blank* end
    wrapped  <- open list close                     the brackets of the whole text: [] {} () and others
    list     <- item (separator item)*              empty items are dropped
    item     <- number? blank* (quoted / nothing / value)
    quoted   <- q (escape / doubled / char)* q      followed by separator, number or end
    nothing  <- "null" / "None"                     in a square list that has a quoted item
    value    <- (bracketed / inner / !separator !number char)*
    bracketed<- open (bracketed / char)* close      separators inside part nothing; the value keeps its brackets
    inner    <- blank q char* q                     a quoted part within a value, before a blank, separator or end
    number   <- "(1)" / "1)" / "1." with the next number in sequence

A quote that never closes, or closes in the middle of a value, makes ``quoted``
fail; the parser goes back to its start, reads it as ``value`` and flags it. So
does a bracket without its counterpart with ``bracketed``. Counterparts are
found once per text, so going back costs no second search. Nothing is shuffled:
a row's values depend on that row alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters that separate values.
SEPARATORS = ",;|/•·\t\n\r、，；।॥｜¦‖"
#: Opening quote -> closing quote.
QUOTES = {'"': '"', "'": "'", "“": "”", "‘": "’", "«": "»", "„": "“", "`": "`"}
#: Opening bracket -> closing bracket.
BRACKETS = {"[": "]", "{": "}", "(": ")", "【": "】"}

_CLOSING = frozenset(BRACKETS.values())
_NUMBER = re.compile(r"\(?(\d{1,4})[.)](?=\s|[^\W\d]|[\"'“‘«])")
_BLANK = re.compile(r"\s*")
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


def _counterparts(s: str) -> dict[int, int]:
    """Place of each opening bracket that has its closing one -> place of that."""
    out: dict[int, int] = {}
    open_: dict[str, list[int]] = {}
    order: list[tuple[int, str]] = []
    for i, c in enumerate(s):
        if c in BRACKETS:
            order.append((i, BRACKETS[c]))
            open_.setdefault(BRACKETS[c], []).append(i)
        elif c in _CLOSING and open_.get(c):
            while True:  # brackets opened since then and not closed have no counterpart
                at, close = order.pop()
                open_[close].pop()
                if close == c:
                    out[at] = i
                    break
    return out


class _Reader:
    """One field text under the grammar. ``blank_separates``: values are single words, so blanks separate and nothing is kept together."""

    def __init__(self, text: str, blank_separates: bool, square: bool = False):
        self.s, self.n, self.square = text, len(text), square
        self.pairs = _counterparts(text) if any(c in BRACKETS for c in text) else {}
        self.seps = set(SEPARATORS) | ({" ", " "} if blank_separates else set())
        self.blank_separates = blank_separates
        self.numbered = False
        self.next_number = 1

    def blanks(self, i: int) -> int:
        while i < self.n and self.s[i].isspace() and (self.s[i] not in self.seps):
            i += 1
        return i

    def number(self, i: int) -> int | None:
        """End of the number mark at i, if it is the next of the sequence."""
        m = _NUMBER.match(self.s, i)
        if m and int(m[1]) == self.next_number and (i == 0 or self.s[i - 1].isspace() or self.s[i - 1] in self.seps):
            return m.end()
        return None

    def quoted(self, i: int) -> tuple[str, int] | None:
        """The value and its end, or None: not a well-formed quoted value."""
        close = QUOTES.get(self.s[i]) if i < self.n else None
        if close is None:
            return None
        out, j = [], i + 1
        while j < self.n:
            c = self.s[j]
            if c == "\\" and j + 1 < self.n:
                d = self.s[j + 1]
                if d == "u" and re.fullmatch("[0-9a-fA-F]{4}", self.s[j + 2 : j + 6]):
                    out.append(chr(int(self.s[j + 2 : j + 6], 16)))
                    j += 6
                else:
                    out.append(_ESCAPES.get(d, d))
                    j += 2
            elif c == close:
                if self.s[j : j + 2] == close * 2 and not self.at_boundary(j + 1):
                    out.append(c)
                    j += 2
                    continue
                if self.at_boundary(j + 1):
                    text = "".join(out)
                    # 😀: the two halves of one character
                    return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace"), j + 1
                if self.s[j : j + 2] == close * 2:
                    out.append(c)
                    j += 2
                    continue
                return None
            else:
                out.append(c)
                j += 1
        return None

    def at_boundary(self, j: int) -> bool:
        k = self.blanks(j)
        return k >= self.n or self.s[k] in self.seps or (self.numbered and self.number(k) is not None)

    def inner(self, i: int) -> int | None:
        """End of the quoted part that begins at i, within a value."""
        close = QUOTES.get(self.s[i])
        if close is None or i == 0 or not self.s[i - 1].isspace():
            return None
        j = self.s.find(close, i + 1) + 1
        return j if j and (j >= self.n or self.s[j].isspace() or self.s[j] in self.seps) else None

    def value(self, i: int) -> tuple[str, int, set[str]]:
        """The text up to the next separator outside of brackets and quoted parts, its end and flags."""
        j, flags, closed = i, set(), set()
        while j < self.n and self.s[j] not in self.seps:
            if self.numbered and j > i and self.s[j - 1].isspace() and self.number(j) is not None:
                break
            c, end = self.s[j], None
            if not self.blank_separates:
                if c in BRACKETS and (at := self.pairs.get(j)) is not None:
                    end = at + 1
                elif c in QUOTES and j > i:
                    end = self.inner(j)
            if end is not None:
                if any(x in self.seps for x in self.s[j:end]):
                    flags.add("inner_separator")
                j = end
                continue
            if c in BRACKETS and j not in self.pairs or c in _CLOSING and j not in closed:
                if c in BRACKETS or not self.blank_separates:
                    flags.add("unbalanced_bracket")
            elif c in BRACKETS:
                closed.add(self.pairs[j])
            j += 1
        return self.s[i:j], j, flags

    def values(self) -> tuple[list[str], set[str]]:
        out: list[str] = []
        nothing: list[int] = []
        any_quoted = False
        flags: set[str] = set()
        i = self.blanks(0)
        self.numbered = self.number(i) is not None
        while i < self.n:
            i = self.blanks(i)
            if i < self.n and self.s[i] in self.seps:
                i += 1
                continue
            if self.numbered and (e := self.number(i)) is not None:
                self.next_number += 1
                i = e
                while i < self.n and self.s[i].isspace():
                    i += 1
            if i >= self.n:
                break
            got = self.quoted(i)
            if got is None:
                raw, i, more = self.value(i)
                flags |= more
                value = raw.strip()
                if value[:1] in QUOTES or value[-1:] in QUOTES.values():
                    trimmed = value.strip("\"“”«»„`")
                    trimmed = trimmed[1:] if trimmed[:1] in "'‘" and trimmed.count("'") + trimmed.count("‘") == 1 else trimmed
                    if trimmed != value and "inner_separator" not in more:
                        flags.add("malformed_quote")
                        value = trimmed.strip()
                elif self.square and value in ("null", "None"):
                    nothing.append(len(out))
            else:
                any_quoted = True
                value, i = got[0].strip(), got[1]
            if value:
                out.append(value)
        if any_quoted and nothing:
            out = [v for k, v in enumerate(out) if k not in set(nothing)]
        return out, flags


def parse_packed(text: str | None, blank_separates: bool = False) -> tuple[list[str], str]:
    """(values in order, error flags joined by "|").

    Null and blank texts hold no value. A bracket around the whole text that is
    opened and not closed (or the reverse) is dropped; it and any bracket without
    its counterpart is flagged ``unbalanced_bracket``. A quote that does not
    enclose a value is flagged ``malformed_quote``; a value whose brackets or
    quoted parts hold separators is kept whole and flagged ``inner_separator``.
    """
    s = (text or "").strip()
    flags: set[str] = set()
    if not s:
        return [], ""
    square = False
    if s[0] in BRACKETS or s[-1] in _CLOSING:
        pairs = _counterparts(s)
        if pairs.get(0) == len(s) - 1:
            if s[0] in "[{" or not _NUMBER.match(s):
                square, s = s[0] == "[", s[1:-1]
        elif s[0] in "[{" and 0 not in pairs:
            s = s[1:]
            flags.add("unbalanced_bracket")
        elif s[-1] in "]}" and len(s) - 1 not in pairs.values():
            s = s[:-1]
            flags.add("unbalanced_bracket")
    out, more = _Reader(s, blank_separates, square).values()
    return out, "|".join(sorted(flags | more))


def split_packed(df: DataFrame, id_col: str, fields: Iterable[str], word_fields: Iterable[str] = (), min_values: int = 1) -> DataFrame:
    """One row (id, field, pos, item, n_items, errors) per value of each field.

    ``word_fields``: fields whose values are single words, so that blanks
    separate too. ``min_values``: leave out fields with fewer values. Null,
    empty and blank texts give no row; repeated values and ids stay; other
    columns of ``df`` are not read. pos counts the kept values from 1.
    """
    fields, words = list(fields), frozenset(word_fields)
    long = df.select(F.col(id_col).alias("id"), F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("text")) for f in fields])).alias("x"))
    long = long.select("id", "x.field", "x.text").where(F.col("text").isNotNull())
    id_type = dict(long.dtypes)["id"]
    if min_values > 1:  # one plain value: no separator of any kind
        mark = "[" + re.escape(SEPARATORS) + r"\[\{\(\"]|\d[.)]"
        plain = ~F.col("text").rlike(mark) & ~(F.col("field").isin(*words) & F.trim("text").rlike("[ \u00a0]") if words else F.lit(False))
        long = long.where(~plain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, rows, names, pos, items, counts, errors = b.column(0), [], [], [], [], [], []
            for i, (f, t) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)):
                values, flags = parse_packed(t, f in words)
                if len(values) < min_values:
                    continue
                k = len(values)
                rows += [i] * k
                names += [f] * k
                pos += range(1, k + 1)
                items += values
                counts += [k] * k
                errors += [flags] * k
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows, pa.int64())), pa.array(names, pa.string()), pa.array(pos, pa.int64()), pa.array(items, pa.string()), pa.array(counts, pa.int64()), pa.array(errors, pa.string())], names=["id", "field", "pos", "item", "n_items", "errors"])

    return long.mapInArrow(run, f"id {id_type}, field string, pos long, item string, n_items long, errors string").withColumnRenamed("id", id_col)
