"""Column functions over text. All of them are built-in expressions, with Python's idea of white space."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loamwork import constants as C


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(C.BLANKS))


def words(text: Column) -> Column:
    return F.filter(F.split(text, f"{C.WS}+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[^{C.WS[1:-1]}]+"))


def first_words(text: Column, n: int) -> Column:
    return F.array_join(F.slice(words(text), 1, n), " ")


def clean_text(text: Column) -> Column:
    """Stripped lines without page furniture; at most one empty line in a row. Null counts as empty."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), C.LINE_END), strip)
    kept = F.array_join(F.filter(lines, lambda x: ~x.rlike(C.NOISE_LINE)), "\n")
    return strip(F.regexp_replace(kept, "\n{3,}", "\n\n"))


def is_english(text: Column) -> Column:
    """Whether enough words of the lower-cased text are frequent English ones; false without words."""
    low = F.lower(text)
    # matches are counted in place, without an array of words
    found = F.regexp_count(low, F.lit("[a-z']+"))
    frequent = F.regexp_count(low, F.lit(f"(?<![a-z'])(?:{'|'.join(C.ENGLISH)})(?![a-z'])"))
    return F.when(found > 0, frequent / found >= C.ENGLISH_SHARE).otherwise(F.lit(False))


def normalize_title(title: Column) -> Column:
    plain = F.regexp_replace(F.lower(title), "[^a-z0-9 ]+", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(plain, C.TITLE_NOISE, " "), " +", " "))


def block_word(title: Column) -> Column:
    return F.substring(F.substring_index(title, " ", 1), 1, 12)


def block_length(title: Column) -> Column:
    return F.floor(F.length(title) / 10).cast("int")


def title_signals(title: Column, signals: dict[str, str] | None = None) -> Column:
    """The canonical name of each cue in the title, repeats included; ["no_signal"] without one."""
    low = F.lower(title)
    found = F.array_compact(F.array(*[F.when(low.contains(k), F.lit(v)) for k, v in (signals or C.TITLE_SIGNALS).items()]))
    return F.when(F.size(found) == 0, F.array(F.lit("no_signal"))).otherwise(found)


def _any(low: Column, keywords: list[str]) -> Column:
    out = low.contains(keywords[0])
    for k in keywords[1:]:
        out = out | low.contains(k)
    return out


def first_signal(title: Column, signals: dict[str, list[str]] | None = None) -> Column:
    """The first category one of whose keywords is in the title, or null."""
    low, out = F.lower(title), None
    for category, keywords in (signals or C.AUDIT_SIGNALS).items():
        out = F.when(_any(low, keywords), category) if out is None else out.when(_any(low, keywords), category)
    return out


def all_signals(title: Column, signals: dict[str, list[str]] | None = None) -> Column:
    low = F.lower(title)
    return F.array_compact(F.array(*[F.when(_any(low, k), F.lit(c)) for c, k in (signals or C.PILOT_SIGNALS).items()]))


def domain_of(url: Column) -> Column:
    """The host with its port, in lower case, without one leading "www."."""
    netloc = F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return F.regexp_replace(F.lower(netloc), "^www\\.", "")


def slugify(name: Column) -> Column:
    """Lower case, accents folded for Latin letters, other runs of characters to "_"; "unnamed" without any."""
    plain, folded = "", ""
    import unicodedata

    for code in range(0xC0, 0x250):
        base = unicodedata.normalize("NFKD", chr(code)).encode("ascii", "ignore").decode()
        if len(base) == 1:
            plain, folded = plain + chr(code), folded + base
    ascii_only = F.regexp_replace(F.translate(name, plain, folded), "[^\\x00-\\x7F]", "")
    slug = F.regexp_replace(F.regexp_replace(F.lower(ascii_only), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.when(slug == "", "unnamed").otherwise(slug)


def section_compliance(text: Column) -> Column:
    """A third for each section header up to 1, halved without a bullet; 0 for blank text."""
    upper = F.upper(text)
    present = sum((F.when(upper.contains(s), 1).otherwise(0) for s in C.SUMMARY_SECTIONS), F.lit(0))
    share = F.least(F.lit(1.0), present / 3) * F.when(text.contains("-"), 1.0).otherwise(0.5)
    return F.when(strip(text) == "", 0.0).otherwise(share)


def title_of(text: Column) -> Column:
    return F.substring_index(F.coalesce(text, F.lit("")), "\n", 1)


def prompt_user(task: str, title: Column, text: Column, max_words: int = 600, max_chars: int = 6000) -> Column:
    """The user message of an annotation request."""
    if task == "summarize":
        return F.concat(F.lit("TITLE: "), title, F.lit("\n\nOPPORTUNITY TEXT:\n"), first_words(text, max_words))
    return F.concat(F.lit("CATEGORIES: " + ", ".join(C.CATEGORIES) + "\n\nTITLE: "), title, F.lit("\n\nOPPORTUNITY TEXT:\n"), F.substring(text, 1, max_chars))


def version_of(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def example_prompt(instructions: str, exemplar: str, answer: str, posting: Column, raw: bool = True) -> Column:
    """Instructions, one solved example and the posting; the flat form ends in a fixed boundary line."""
    shown = f"{instructions}\n\n=== EXAMPLE ===\n{exemplar}\n\nCORRECT SUMMARY:\n{answer}\n=== END EXAMPLE ===\n\nNow summarize this opportunity the same way:\n\n"
    if raw:
        return F.concat(F.lit(shown + "OPPORTUNITY:\n"), posting, F.lit("\n\nTARGET OUTPUT:\n"))
    return F.concat(F.lit(shown), posting)


def service_prompt(posting: Column) -> Column:
    """The prompt of the summarizing endpoint, which names an older list of sections."""
    return F.concat(F.lit(C.SERVICE_PROMPT), posting)


def category_index(category: Column) -> Column:
    """The place of a category in the taxonomy from 0, or null."""
    at = F.array_position(F.array(*map(F.lit, C.CATEGORIES)), category)
    return F.when(at > 0, (at - 1).cast("int"))
