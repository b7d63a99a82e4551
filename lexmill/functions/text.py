"""String functions of the lexicon, as Column expressions (no Python in the rows)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEVANAGARI = "[ऀ-ॿ]"
#: Nukta letters written as one character, and their base letters.
NUKTA = {chr(0x958 + i): x for i, x in enumerate("कखगजडढफय")} | {"\u0929": "न", "\u0931": "र", "\u0934": "ळ"}
#: Accented letters folded for safety matching, and what they become.
FOLDED, FOLDS = "āīūēōṛṇṣḥṁ", "aiueornshm"


def strip(c: Column) -> Column:
    """Without outer white space."""
    return F.regexp_replace(c, "^\\s+|\\s+$", "")


def squash(c: Column) -> Column:
    """White space runs as one blank, none outside."""
    return F.trim(F.regexp_replace(c, "\\s+", " "))


def has_devanagari(c: Column) -> Column:
    return F.coalesce(c.rlike(DEVANAGARI), F.lit(False))


def definition_lang(c: Column, script: str = DEVANAGARI, latin: str = "[A-Za-z]") -> Column:
    """hi, en or mixed by the scripts found; empty, null and punctuation are en."""
    a, b = F.coalesce(c.rlike(script), F.lit(False)), F.coalesce(c.rlike(latin), F.lit(False))
    return F.when(a & b, "mixed").when(a, "hi").otherwise("en")


def normalize_hindi(c: Column) -> Column:
    """Nuktas dropped, final virama dropped, outer blanks dropped."""
    for whole, base in NUKTA.items():
        c = F.replace(c, F.lit(whole), F.lit(base))
    return strip(F.regexp_replace(strip(F.replace(c, F.lit("़"), F.lit(""))), "्+$", ""))


def normalize_roman(c: Column) -> Column:
    """Lower case; only letters, digits, _ and single blanks (accents stay)."""
    return squash(F.regexp_replace(F.lower(c), "[^\\p{L}\\p{N}_\\s]", ""))


def definition_hash(c: Column) -> Column:
    return F.md5(squash(F.lower(c)))


def is_variant(a: Column, b: Column) -> Column:
    return normalize_hindi(a) == normalize_hindi(b)


def normalize_safety(c: Column) -> Column:
    """Lower case ASCII letters, digits and blanks; accents folded; other marks deleted without a gap."""
    return F.regexp_replace(F.translate(F.lower(strip(c)), FOLDED, FOLDS), "[^a-z0-9\\s]", "")


def contains_term(c: Column, terms: Column) -> Column:
    """True if a token of the text is in the array ``terms`` (whole tokens only)."""
    return F.coalesce(F.arrays_overlap(F.split(strip(normalize_safety(c)), "\\s+"), terms), F.lit(False))


def keyboard_word(c: Column) -> Column:
    return F.lower(strip(c))


#: Words that keep their v.
V_WORDS = ("vakeel", "vyapaari", "vyaapaar")


def v_to_w(c: Column, exceptions: tuple[str, ...] = V_WORDS) -> Column:
    """v -> w in each word but at its start; words in ``exceptions`` stay."""

    def word(w: Column) -> Column:
        turned = F.concat(F.substring(w, 1, 1), F.regexp_replace(F.substring(w, 2, 1 << 20), "v", "w"))
        return F.when(F.lower(w).isin(*exceptions), w).otherwise(turned) if exceptions else turned

    return F.array_join(F.transform(F.split(c, " "), word), " ")


#: Scholarly romanization to common spelling, in this order.
ISO_STEPS = (
    ("ā̃", "aan"), ("ī̃", "i"), ("ū̃", "oon"), ("ẽ", "en"), ("õ", "on"), ("[̀-ͯ]", ""), ("jñ", "gy"),
    ("ā", "aa"), ("ī", "i"), ("ū", "oo"), ("ē", "e"), ("ō", "o"), ("ṛ", "ri"), ("ṝ", "ri"), ("ṃ", "n"), ("ṁ", "n"), ("ḥ", "h"),
    ("ṅ", "n"), ("ñ", "n"), ("ṇ", "n"), ("ṭ", "t"), ("ḍ", "d"), ("ṣ", "sh"), ("ś", "sh"), ("ġ", "g"),
    ("ã", "an"), ("ĩ", "in"), ("ũ", "un"), ("c(?=[aeiou])", "ch"), ("c$", "ch"),
)
#: Endings and nasals, in this order.
ISO_ENDS = (
    ("aay$", "ai"), ("aay(?=[^aeiou])", "ai"), ("ay$", "ai"), ("ay(?=[^aeiou])", "ai"), ("aa$", "a"), ("ee$", "i"), ("oo$", "u"),
    ("nm", "m"), ("nb", "mb"), ("np", "mp"),
)


#: Spellings settled by custom.
ISO_FIXES = {
    "woh": "woh", "yeh": "yeh", "wah": "woh", "yah": "yeh", "bahan": "behen", "mai": "main", "maidam": "madam", "sar": "sir", "accha": "achcha", "gae": "gaye",
    "chah": "chhah", "maan": "maa", "kŕpaya": "kripya", "koolha": "kulha", "eeshwar": "ishwar", "eeshwara": "ishwar", "bhagwaan": "bhagwan", "bhagawaan": "bhagwan",
    "allaah": "allah", "jeeja": "jija", "naxoon": "nakhun", "naaxoon": "nakhun", "nakhoon": "nakhun", "jnyan": "gyaan", "jnyaan": "gyaan", "zindagee": "zindagi",
    "khadee": "khadi", "ladkee": "ladki", "betee": "beti", "nadee": "nadi", "daada": "dada", "daadi": "dadi", "naana": "nana", "naani": "nani", "chaacha": "chacha",
    "chaachi": "chachi", "maama": "mama", "maami": "mami", "paapa": "papa", "taaya": "taya", "taai": "tai", "bhaabhi": "bhabhi", "saala": "sala", "saali": "sali",
    "bhaai": "bhai", "jaao": "jao", "khaao": "khao", "gyaarah": "gyarah", "baarah": "barah", "athaarah": "atharah", "tumhaara": "tumhara", "maatha": "matha",
    "jeebh": "jibh", "khaana": "khana", "chaawal": "chawal", "tamaatar": "tamatar", "aalu": "aaloo", "joos": "juice", "neembu": "nimbu", "dhanyawaad": "dhanyavaad",
    "aao": "aao", "baap": "baap", "saas": "saas", "daamaad": "daamaad", "sarkar": "sarkar", "chunav": "chunav", "azaadi": "azaadi", "ganatantra": "ganatantra",
    "pujari": "pujari", "maulvi": "maulvi", "padri": "padri",
}


def iso_to_common(c: Column, exceptions: tuple[str, ...] = V_WORDS, fixes: dict[str, str] | None = None) -> Column:
    """Scholarly (ISO style) romanization in common spelling; ``fixes``: whole texts to replace (a small table), by default ISO_FIXES."""
    fixes = ISO_FIXES if fixes is None else fixes
    for pattern, to in ISO_STEPS:
        c = F.regexp_replace(c, pattern, to)
    c = v_to_w(c, exceptions)
    for pattern, to in ISO_ENDS:
        c = F.regexp_replace(c, pattern, to)
    if fixes:
        table = F.create_map(*[F.lit(x) for kv in fixes.items() for x in kv])
        return F.coalesce(table[F.lower(c)], squash(c))
    return squash(c)


def query_tokens(c: Column) -> Column:
    """Tokens of a search text; an empty one has none."""
    return F.filter(F.split(strip(c), "\\s+"), lambda t: t != "")


def contains_literal(c: Column, q: str) -> Column:
    """Case-insensitive substring; %, _ and \\ are ordinary characters."""
    return F.coalesce(F.contains(F.lower(c), F.lit(q.lower())), F.lit(False))


def highlight(c: Column, q: str) -> Column:
    """Occurrences of q (any case) between <mark> and </mark>."""
    return F.regexp_replace(c, "(?i)(\\Q" + q.replace("\\E", "") + "\\E)", "<mark>$1</mark>") if q else c


def preview(*columns: Column) -> Column:
    """The first that is neither null nor empty; else ''."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))


def diff_class(actual: Column, expected: Column) -> Column:
    """What kind of difference two romanizations have."""
    la, le = F.length(actual), F.length(expected)
    pairs = F.filter(F.zip_with(F.split(actual, ""), F.split(expected, ""), lambda a, b: F.when(a != b, F.concat(a, b)).otherwise("")), lambda p: p != "")
    vw = F.exists(pairs, lambda p: p.isin("vw", "wv"))
    vowel = F.exists(pairs, lambda p: p.rlike("^[aeiou][aeiou]$"))
    same = F.when(F.size(pairs) == 0, "none").when(vw & vowel, "v_w_and_vowel").when(vw, "v_w").when(vowel, "vowel_length").otherwise("other_consonant")
    return F.when(la == le, same).when(F.rtrim(actual, F.lit("a")) == F.rtrim(expected, F.lit("a")), "trailing_schwa").when(la < le - 1, "missing_chars").when(la > le + 1, "extra_chars").otherwise("length_mismatch")
