"""Text that looks the same, brought to one form.

Two tokens look the same if one turns into the other by edits of weight zero:
look-alike letters (Cyrillic a for Latin a), look-alike sequences (a vowel sign
written in two parts), and ignorables (anything that cannot be seen). Any other
edit has a weight: a mark or a letter dropped, added or changed. The vocabulary
of tokens written in plain letters is held in tries; a weighted edit automaton
walks a trie along a dirty token, the lightest path first, and drops paths
whose weight reaches the cut-off. The plain token of least weight, then the most
frequent, is the canonical spelling. A token that reaches none is normalised by
the table.

Distribution: tokens are counted (partial sums before the shuffle), then placed
by their first ``HEAD`` base letters, which tokens that look the same share. A
trie holds the plain tokens of one head and is dropped behind it: it is a sorted
list, a node being a range of it, so it needs little more memory than its
tokens. Nothing is broadcast or collected.
"""

from __future__ import annotations

import heapq
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.plans.runtime import durable

#: Weights of an edit that can be seen: of a mark, of a letter. Paths of CUTOFF and more are dropped, so nothing that can be seen changes.
MARK, LETTER, CUTOFF = 0.7, 1.0, 0.5
#: Base letters that place a token.
HEAD = 3

# --- fixed values -----------------------------------------------------------
#: Look-alikes of Latin letters in other alphabets, by letter.
LATIN_LOOKALIKES = {
    "a": "аɑα", "b": "Ьƅ", "c": "сϲⅽ", "d": "ԁⅾ", "e": "еҽ℮", "f": "ƒϝ", "g": "ɡց", "h": "һհ", "i": "іıιⅰ", "j": "јϳ",
    "k": "κк", "l": "ⅼӏǀ", "m": "ⅿ", "n": "ոռη", "o": "оοօσ", "p": "рρ", "q": "ԛզ", "r": "ᴦ", "s": "ѕꜱ", "t": "τ", "u": "սυʋ",
    "v": "ѵνⅴ", "w": "ԝաѡ", "x": "хχⅹ", "y": "уүγ", "z": "ᴢ",
    "A": "АΑ", "B": "ВΒ", "C": "СϹⅭ", "D": "Ⅾ", "E": "ЕΕ", "G": "Ԍ", "H": "НΗ", "I": "ІΙӀⅠ", "J": "ЈͿ", "K": "КΚK", "L": "Ⅼ", "M": "МΜⅯ",
    "N": "Ν", "O": "ОΟՕ", "P": "РΡ", "Q": "Ԛ", "S": "ЅՏ", "T": "ТΤ", "U": "Ս", "V": "ѴⅤ", "W": "Ԝ", "X": "ХΧⅩ", "Y": "ҮΥ", "Z": "Ζ",
}
#: Devanagari vowels written in parts: the parts and the letter they look like.
DEVANAGARI_PARTS = {
    "अा": "आ", "अॅ": "ॲ", "अॆ": "ऄ", "अॉ": "ऑ", "अॊ": "ऒ", "अो": "ओ", "अौ": "औ", "आॅ": "ऑ", "आॆ": "ऒ", "आे": "ओ", "आै": "औ",
    "उु": "ऊ", "एॅ": "ऍ", "एॆ": "ऎ", "एे": "ऐ", "ाॅ": "ॉ", "ाॆ": "ॊ", "ाे": "ो", "ाै": "ौ", "ॅा": "ॉ", "ॆा": "ॊ", "ेा": "ो", "ैा": "ौ",
}
#: Colons that stand for a visarga after a Devanagari letter, and for a colon elsewhere.
COLONS = "：꞉׃˸։∶"
# ---------------------------------------------------------------------------

_DEVA = "ऀ-ॿ"
_TO_LATIN = {ord(x): c for c, xs in LATIN_LOOKALIKES.items() for x in xs}
_PARTS = re.compile("|".join(sorted(DEVANAGARI_PARTS, key=len, reverse=True)))
#: Marks drawn on the same spot twice look like one.
_TWICE = re.compile("([̀-ͯऀ-ं़ु-ै्॒॑])\\1+")
_ORDER = [(re.compile("([ा-ौॎॏऀ-ः]+)(़)"), r"\2\1"), (re.compile("([ऀ-ः])([ा-ौॎॏ])"), r"\2\1")]


def _ignorable(c: str) -> bool:
    """Nothing is drawn for it: format and control characters, joiners, selectors, fillers."""
    return unicodedata.category(c) in ("Cf", "Cc") or c in "͏ᅟᅠ឴឵ㅤﾠ" or "᠋" <= c <= "᠏" or "︀" <= c <= "️" or "\U000e0000" <= c <= "\U000e0fff"


def _blank(c: str) -> bool:
    return unicodedata.category(c) in ("Zs", "Zl", "Zp") or c in "\t\n\r\v\f\x85"


@lru_cache(maxsize=1 << 14)
def _compatible(c: str) -> str:
    """Full- and half-width forms, ligatures, number forms, styled, circled and positional letters to plain ones.

    By Unicode's own mappings: those of width and style whole, those of
    ligatures and circles where plain Latin letters come out. Raised and lowered
    letters and fractions look different and stay.
    """
    tag = unicodedata.decomposition(c).partition(" ")[0]
    if tag not in ("<wide>", "<narrow>", "<font>", "<compat>", "<circle>", "<isolated>", "<initial>", "<medial>", "<final>"):
        return c
    plain = unicodedata.normalize("NFKC", c)
    if tag in ("<compat>", "<circle>"):
        letters = unicodedata.normalize("NFD", plain)
        return plain if letters[0].isalpha() and all(x.isascii() and not x.isspace() or x in "·ʼ" or unicodedata.combining(x) for x in letters) else c
    return plain if tag in ("<wide>", "<narrow>", "<font>") or len(plain) <= 3 else c


@lru_cache(maxsize=1 << 16)
def table_form(token: str) -> str:
    """One token (no blanks) in the ordinary letters of its own script, by table alone."""
    s = "".join(_compatible(c) for c in token if not _ignorable(c))
    s = unicodedata.normalize("NFD", s)
    # own script: other alphabets' look-alikes are Latin unless a letter shows that they are meant
    if any(ord(c) in _TO_LATIN for c in s):
        foreign = sum(1 for c in s if c.isalpha() and "Ͱ" <= c <= "֏" and ord(c) not in _TO_LATIN)
        latin = sum(1 for c in s if c.isascii() and c.isalpha())
        if latin >= foreign:
            s = s.translate(_TO_LATIN)
    for c in COLONS:
        s = s.replace(c, ":")
    s = re.sub(f"(?<=[{_DEVA}]):+", lambda m: "ः" * len(m[0]), s)
    while True:  # each rewrite moves a nukta or sign forward or shortens the token, so this ends
        t = s
        for rx, to in _ORDER:
            t = rx.sub(to, t)
        t = _PARTS.sub(lambda m: DEVANAGARI_PARTS[m[0]], _TWICE.sub(r"\1", t))
        if t == s:
            return unicodedata.normalize("NFC", s)
        s = t


_VOWELS = re.compile("[ऄ-औॠॡॲ-ॷ]")


def head(token: str) -> str:
    """The first base letters: without marks, ignorables and colons, look-alikes as Latin, vowels of one script as one."""
    if token.isascii() and token.isprintable():
        return token.replace(":", "")[:HEAD]
    out = ""
    for c in token:
        if _ignorable(c) or c in COLONS or c == ":":
            continue
        for x in unicodedata.normalize("NFD", _compatible(c)).translate(_TO_LATIN):
            if unicodedata.category(x)[0] != "M" and x != ":":
                out += x
        if len(out) >= HEAD:
            break
    return _VOWELS.sub("अ", out[:HEAD])


class Automaton:
    """Plain tokens in a trie, and the walk along a dirty token."""

    def __init__(self) -> None:
        self.counts: dict[str, tuple[int, str]] = {}
        self.tokens: list[str] = []

    def add(self, token: str, n: int) -> None:
        self.counts[unicodedata.normalize("NFD", token)] = (n, token)

    @staticmethod
    @lru_cache(maxsize=1 << 16)
    def _steps(token: str, i: int) -> tuple[tuple[str, int], ...]:
        """What a path of weight zero may read at i: (letters on the trie, next i)."""
        c = token[i]
        out = [(c, i + 1)]
        if _ignorable(c) or (i and token[i - 1] == c and _TWICE.fullmatch(c * 2)):
            out.append(("", i + 1))
        plain = unicodedata.normalize("NFD", _compatible(c))
        if plain != c:
            out.append((plain, i + 1))
        if (o := ord(c)) in _TO_LATIN:
            out.append((_TO_LATIN[o], i + 1))
        if c == ":" or c in COLONS:
            out += [("ः", i + 1), (":", i + 1)]
        if (p := DEVANAGARI_PARTS.get(token[i : i + 2])) is not None:
            out.append((p, i + 2))
            if (q := DEVANAGARI_PARTS.get(p + token[i + 2 : i + 3])) is not None:
                out.append((q, i + 3))
        return tuple(dict.fromkeys(out))

    def canonical(self, token: str, cutoff: float = CUTOFF) -> str | None:
        """The plain token of least weight below ``cutoff``; ties: the most frequent, then the least in code point order."""
        if len(self.tokens) != len(self.counts):
            self.tokens = sorted(self.counts)
        token, tokens = unicodedata.normalize("NFD", token), self.tokens
        weigh = lambda c: MARK if unicodedata.combining(c) or unicodedata.category(c)[0] == "M" else LETTER
        best: tuple[float, int, str] | None = None
        heap, seen = [(0.0, 0, "", 0, len(tokens))], set()  # weight, place in the token, letters read on the trie, range of the node
        while heap:
            cost, i, path, lo, hi = heapq.heappop(heap)
            if best is not None and cost > best[0]:
                break
            if (i, path) in seen:
                continue
            seen.add((i, path))
            if i == len(token) and tokens[lo] == path:
                n, plain = self.counts[path]
                best = min(best or (cost, 1, ""), (cost, -n, plain)) if best else (cost, -n, plain)
            moves = [(0.0, letters, j) for letters, j in self._steps(token, i)] if i < len(token) else []
            if cost + MARK < cutoff:  # edits that can be seen: drop, change or add a letter
                if i < len(token):
                    moves.append((weigh(token[i]), "", i + 1))
                for c in {t[len(path)] for t in tokens[lo:hi] if len(t) > len(path)}:
                    moves.append((weigh(c), c, i))
                    if i < len(token):
                        moves.append((max(weigh(c), weigh(token[i])), c, i + 1))
            for w, letters, j in moves:
                if cost + w >= cutoff:
                    continue
                to = path + letters
                a, z = (bisect_left(tokens, to, lo, hi), bisect_left(tokens, to + "\U0010ffff", lo, hi)) if letters else (lo, hi)
                if a < z:
                    heapq.heappush(heap, (cost + w, j, to, a, z))
        return best and unicodedata.normalize("NFC", best[2])


#: Ordinary letters: printable ASCII, composed Latin, Devanagari without precomposed nukta letters.
_ORDINARY = "!-~\\u00c0-\\u0130\\u0134-\\u013e\\u0141-\\u0148\\u014a-\\u017e\\u0900-\\u0928\\u092a-\\u0930\\u0932\\u0933\\u0935-\\u0957\\u0960-\\u097f"
#: What may still be wrong with a value of ordinary letters: blanks, double signs, signs in parts or out of order, letters NFC composes with a nukta, colons.
_FAULTS = "^ | $|  |([\\u0900-\\u0902\\u093c\\u0941-\\u0948\\u094d\\u0951\\u0952])\\1|[अआउए][ा-ौ]|[ॅॆेै]ा|ा[ॅॆेै]|[ऀ-ः़ा-ौ]़|[ऀ-ः][ा-ौॎॏ]|[\\u0928\\u0930\\u0933]\\u093c|[\\u094d\\u0951-\\u0954]\\u093c|[\\u0951-\\u0954]\\u094d|[\\u0951\\u0953\\u0954]\\u0952|[\\u094e\\u094f]\\u093c|[\\u0900-\\u097f]:"
_SPLIT = "[\\s\\x0B\\x85\\p{Z}]+"


def looks_plain(col: Column) -> Column:
    """True if the value is in its consistent form for certain (a JVM-side test)."""
    return col.rlike(f"^[{_ORDINARY} ]+$") & ~col.rlike(_FAULTS)


_ALL_ORDINARY, _ANY_FAULT = re.compile(f"[{_ORDINARY}]+"), re.compile(_FAULTS)


def is_plain(token: str) -> bool:
    """``looks_plain`` of one token: its ``table_form`` is itself."""
    return _ALL_ORDINARY.fullmatch(token) is not None and not _ANY_FAULT.search(token)


def canonical_tokens(tokens: DataFrame) -> DataFrame:
    """(token, form) of every dirty token of ``tokens`` (token, n, plain)."""

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([head(t) for t in b.column(0).to_pylist()], pa.string())], names=["token", "n", "plain", "head"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, last = Automaton(), None
        for b in batches:
            found, forms = [], []
            for token, n, plain, at in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if at != last:  # sorted by head, plain tokens first: nothing behind is reached again
                    automaton, last = Automaton(), at
                if plain:
                    automaton.add(token, n)
                else:
                    found.append(token)
                    forms.append(automaton.canonical(token) or table_form(token))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(forms, pa.string())], names=["token", "form"])

    with_head = tokens.select("token", "n", "plain").mapInArrow(heads, "token string, n long, plain boolean, head string")
    placed = with_head.repartition("head").sortWithinPartitions(F.col("head"), F.col("plain").desc(), F.col("token"))
    return placed.mapInArrow(walk, "token string, form string")


def canonical_values(values: DataFrame) -> DataFrame:
    """(value, form) of every distinct value of ``values`` (value) that isn't plain.

    Null values are left out. A value of nothing but blanks and ignorables has
    the form ''. The plain values serve as vocabulary.
    """
    counted = durable(values.where(F.col("value").isNotNull() & (F.col("value") != "")).groupBy("value").agg(F.count("*").alias("n")).withColumn("plain", looks_plain(F.col("value"))))
    tokens = counted.select("n", "plain", F.explode(F.split("value", _SPLIT)).alias("token")).where("token <> ''")
    # a plain token within a dirty value is vocabulary, too
    tokens = tokens.groupBy("token").agg(F.sum("n").alias("n")).withColumn("plain", looks_plain(F.col("token")))
    forms = canonical_tokens(tokens)
    dirty = counted.where(~F.col("plain")).select("value", F.posexplode(F.split("value", _SPLIT)).alias("pos", "token"))
    joined = dirty.join(forms.withColumnRenamed("form", "f"), "token", "left").withColumn("f", F.when(F.col("token") == "", None).otherwise(F.coalesce("f", "token")))
    # a token may come out empty (ignorables only); such and outer blanks leave no blank behind
    built = joined.groupBy("value").agg(F.array_sort(F.collect_list(F.when(F.coalesce(F.col("f"), F.lit("")) != "", F.struct("pos", "f")))).alias("x"))
    return built.select("value", F.concat_ws(" ", F.col("x.f")).alias("form"))


def visual_forms(df: DataFrame, id_col: str, fields: list[str]) -> DataFrame:
    """(id, field, form) of every non-empty value that is not in its consistent form.

    Null and empty values give no row; repeated ids and rows stay, each with its
    own. Columns other than those named are not read.
    """
    long = df.select(F.col(id_col).alias("id"), F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])).alias("x")).select("id", "x.field", "x.value")
    long = long.where(F.col("value").isNotNull() & (F.col("value") != ""))
    forms = canonical_values(long.select("value"))
    out = long.where(~looks_plain(F.col("value"))).join(forms, "value").where(F.col("form") != F.col("value"))
    return out.select(F.col("id").alias(id_col), "field", "form")
