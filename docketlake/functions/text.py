"""String columns. White space means what Python's ``str.strip`` takes off, never Java's ASCII ``\\s``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space in a Java pattern: the Unicode property and the four separators that it leaves out.
WS = r"[\s\x1c-\x1f]"
CYRILLIC = "[А-Яа-яЁё]"

# Latin spelling of each Cyrillic letter.
LATIN = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "e",
    "ж": "zh", "з": "z", "и": "i", "й": "i", "к": "k", "л": "l", "м": "m",
    "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u",
    "ф": "f", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch",
    "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "yu", "я": "ya",
}

# Short labels of outcomes.
SHORT_LABELS = {
    "Claim (application, complaint) SATISFIED": "Satisfied",
    "Claim (application, complaint) LEFT WITHOUT CONSIDERATION": "Left without consideration",
    "Proceedings in the case have been TERMINATED": "Proceedings terminated",
    "Application RETURNED to applicant": "Returned to applicant",
    "REFUSED to satisfy the claim (application, complaint)": "Refused",
    "Case joined to another case": "Joined to another case",
    "ACCEPTANCE OF APPLICATION IS DENIED": "Acceptance denied",
    "Claim (application, complaint) PARTIALLY SATISFIED": "Partially satisfied",
    "Transferred according to jurisdiction, jurisdiction": "Transferred (jurisdiction)",
    "(no solution recorded)": "No solution recorded",
}

#: Longest text that is kept inline, and what remains of a longer one.
INLINE_LIMIT, INLINE_KEPT = 32_000, 31_900


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"(?U)^{WS}+|{WS}+$", "")


def collapse(c: Column) -> Column:
    """S-5: each run of white space, no-break spaces among it, becomes one space; none at the ends."""
    return F.trim(F.regexp_replace(c, rf"(?U){WS}+", " "))


def clean(c: Column) -> Column:
    """S-6: ``collapse``, null becoming empty."""
    return F.coalesce(collapse(c), F.lit(""))


def blank(c: Column) -> Column:
    """Null, or nothing but white space."""
    return c.isNull() | (strip(c) == "")


def label_blank(c: Column, label: str) -> Column:
    """PF-3: stripped, or the label where that leaves nothing."""
    return F.when(blank(c), F.lit(label)).otherwise(strip(c))


def key_of(c: Column, length: int = 16) -> Column:
    """S-7: the first hex digits of the SHA-1."""
    return F.substring(F.sha1(c), 1, length)


def share_of(c: Column, pattern: str = CYRILLIC) -> Column:
    """PF-15: characters of a class as a share of all; 0 for an empty text."""
    return F.regexp_count(c, F.lit(pattern)) / F.greatest(F.length(c), F.lit(1))


def looks_untranslated(c: Column, pattern: str = CYRILLIC, limit: float = 0.30) -> Column:
    return F.coalesce(share_of(c, pattern) > limit, F.lit(False))


def needs_translation(c: Column, pattern: str | None = CYRILLIC) -> Column:
    """PF-12: not blank, no link, date, time or plain number, and with a character of the class (PF-13: None for any)."""
    t = strip(c)
    skip = t.startswith("http") | t.rlike(r"\A\d{2}\.\d{2}\.\d{4}\z") | t.rlike(r"\A\d{2}:\d{2}\z") | t.rlike(r"\A[\d-]+\z")
    wanted = ~blank(c) & ~skip
    return F.coalesce(wanted & t.rlike(pattern) if pattern else wanted, F.lit(False))


def passthrough_norm(line: Column, pattern: str = CYRILLIC) -> Column:
    """PF-14: the normalised line, or null where there is nothing to translate in it."""
    norm = collapse(line)
    return F.when(norm.rlike(pattern), norm)


def transliterate(c: Column) -> Column:
    """S-1: letter by letter; a capital gives a capital first letter."""
    table = F.create_map(*[F.lit(x) for pair in LATIN.items() for x in pair])

    def one(ch: Column) -> Column:
        piece = F.try_element_at(table, F.lower(ch))
        capital = F.concat(F.upper(F.substring(piece, 1, 1)), F.substring(piece, 2, 9))
        return F.when(piece.isNull(), ch).when(ch != F.lower(ch), capital).otherwise(piece)

    return F.array_join(F.transform(F.split(c, ""), one), "")


def first_word(title: Column) -> Column:
    """S-2: the run of letters and hyphens that a title starts with, else the whole title."""
    return F.coalesce(F.nullif(F.regexp_extract(title, "^([A-Za-zА-Яа-яЁё-]+)", 1), F.lit("")), title)


def safe_name(c: Column, default: str = "UnknownCourt") -> Column:
    """S-3: each other character becomes an underscore; none at the ends."""
    name = F.regexp_replace(F.regexp_replace(c, r"(?U)[^\w\-]", "_"), "^_+|_+$", "")
    return F.when(F.coalesce(name, F.lit("")) == "", F.lit(default)).otherwise(name)


def safe_file_stem(c: Column, longest: int = 60, default: str = "case") -> Column:
    """S-4: each run of other characters becomes an underscore; cut to length."""
    stem = F.substring(F.regexp_replace(F.regexp_replace(c, r"(?U)[^\w\-]+", "_"), "^_+|_+$", ""), 1, longest)
    return F.when(F.coalesce(stem, F.lit("")) == "", F.lit(default)).otherwise(stem)


def court_name(title: Column) -> Column:
    """H-2: a short Latin name out of a page's title."""
    return safe_name(transliterate(first_word(title)))


def shorten(c: Column, labels: dict[str, str] | None = None) -> Column:
    """S-15: a short label, or the value itself."""
    table = F.create_map(*[F.lit(x) for pair in (SHORT_LABELS if labels is None else labels).items() for x in pair])
    return F.coalesce(F.try_element_at(table, c), c)


def contains_any(c: Column, words: list[str]) -> Column:
    """S-16: whether the lower-cased text contains one of the words."""
    return F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(F.lower(c), w))


def inline(c: Column, path: Column, what: str = "text", limit: int = INLINE_LIMIT, kept: int = INLINE_KEPT) -> Column:
    """S-8: a text over the limit becomes a marker line with its path, then its beginning."""
    return F.when(F.length(c) > limit, F.concat(F.lit(f"[TRUNCATED -- full {what} in "), path, F.lit("]\n"), F.substring(c, 1, kept))).otherwise(c)


def without_marker(c: Column) -> Column:
    """S-9: the stripped text without a marker line at its start."""
    return F.regexp_replace(strip(c), r"^\[TRUNCATED[^\]]*\]\n", "")


def with_stem_suffix(path: Column, suffix: str = "_EN") -> Column:
    """S-18: the suffix goes before the extension."""
    return F.when(path.rlike(r"\.[^./]*$"), F.regexp_replace(path, r"(\.[^./]*)$", f"{suffix}$1")).otherwise(F.concat(path, F.lit(suffix)))


def labelled_entry(label: Column, name: Column) -> Column:
    """S-19: ``label: name``; either alone if the other is empty or both are the same."""
    a, b = F.coalesce(label, F.lit("")), F.coalesce(name, F.lit(""))
    return F.when((a != "") & (b != "") & (a != b), F.concat(a, F.lit(": "), b)).when(b != "", b).otherwise(a)


def set_page(url: Column, page: Column) -> Column:
    """U-1: the first ``page=`` gets the number, else one is added; all other bytes stay."""
    number = page.cast("string")
    added = F.concat(url, F.when(F.contains(url, F.lit("?")), "&").otherwise("?"), F.lit("page="), number)
    replaced = F.regexp_replace(url, F.lit(r"(?s)^(.*?[?&])page=\d*"), F.concat(F.lit("$1page="), number))
    return F.when(url.rlike(r"[?&]page=\d*"), replaced).otherwise(added)


def site_of(url: Column) -> Column:
    """U-2: scheme and authority."""
    return F.concat(F.try_parse_url(url, F.lit("PROTOCOL")), F.lit("://"), F.try_parse_url(url, F.lit("AUTHORITY")))


def three_segments(url: Column) -> Column:
    """U-4: what stands before the third slash, and a slash."""
    return F.concat(F.substring_index(url, "/", 3), F.lit("/"))
