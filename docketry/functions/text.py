"""Text repair and folding as native column expressions."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# (?U) makes \s the Unicode white-space class; the four separators are white space to Python only.
SPACES = r"(?U)[\s\x1c-\x1f]+"

# Characters that betray UTF-8 bytes read as Latin-1.
DAMAGE_MARKS = "[ÃÂâ�]"

NON_ASCII = r"[^\x00-\x7F]"

TOKEN = r"[\p{L}\p{N}_]{2,}"


def collapse_spaces(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, SPACES, " "))


def repair_collapsed(clean: Column) -> Column:
    """Undo UTF-8 text that was decoded as Latin-1; ``clean`` is already collapsed.

    A text is repaired only if it carries a damage mark, fits Latin-1, and its bytes are valid
    UTF-8; otherwise it stays as it is.
    """
    latin = ~clean.rlike(r"[^\x{00}-\x{FF}]")
    repaired = F.try_validate_utf8(F.encode(clean, "ISO-8859-1").cast("string"))
    return F.when(clean.rlike(DAMAGE_MARKS) & latin, F.coalesce(repaired, clean)).otherwise(clean)


def repair_text(text: Column) -> Column:
    """Collapse white space, then repair."""
    return repair_collapsed(collapse_spaces(text))


def repair_columns(df: DataFrame, sources: dict[str, Column]) -> DataFrame:
    """Repaired texts as columns, in two projections so that each text is collapsed once."""
    clean = df.withColumns({n: collapse_spaces(c) for n, c in sources.items()})
    return clean.withColumns({n: repair_collapsed(F.col(f"`{n}`")) for n in sources})


def fold_columns(df: DataFrame, sources: dict[str, Column]) -> DataFrame:
    """Folded texts as columns, one projection per step for the same reason."""
    repaired = repair_columns(df, {n: c.cast("string") for n, c in sources.items()})
    return repaired.withColumns({n: fold_repaired(F.col(f"`{n}`")) for n in sources})


@lru_cache(maxsize=1)
def _fold_tables() -> tuple[dict[str, str], dict[str, str]]:
    """Characters whose compatibility decomposition leaves one, or several, ASCII characters."""
    single, several = {}, {}
    for point in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= point <= 0xDFFF:
            continue
        char = chr(point)
        ascii_part = "".join(c for c in unicodedata.normalize("NFKD", char) if c < "\x80")
        if len(ascii_part) == 1:
            single[char] = ascii_part
        elif ascii_part:
            several[char] = ascii_part
    return single, several


def strip_to_ascii(text: Column) -> Column:
    """NFKD decomposition without the characters outside ASCII."""
    single, several = _fold_tables()
    out = F.translate(text, "".join(single), "".join(single.values()))
    listed = "\x02".join(f"{char}\x01{ascii_part}" for char, ascii_part in several.items())
    pairs = F.str_to_map(F.lit(listed), F.lit("\x02"), F.lit("\x01"))
    spelled = F.array_join(
        F.transform(F.split(out, ""), lambda c: F.coalesce(F.try_element_at(pairs, c), c)), ""
    )
    # Plain ASCII needs nothing, and the character-by-character form only runs where some
    # character folds to several. A translation finds these faster than a long character class.
    has_several = F.translate(text, "".join(several), "") != text
    folded = F.regexp_replace(F.when(has_several, spelled).otherwise(out), NON_ASCII, "")
    return F.when(text.rlike(NON_ASCII), folded).otherwise(text)


def fold_repaired(text: Column) -> Column:
    folded = collapse_spaces(F.lower(strip_to_ascii(text)))
    return F.coalesce(folded, F.lit(""))


def fold_text(text: Column) -> Column:
    """Repair, strip to lower-case ASCII, collapse; null becomes the empty string."""
    return fold_repaired(repair_text(text.cast("string")))


def label_of(folded: Column, labels: dict[str, str]) -> Column:
    """The canonical label of a folded text, or null if it has none."""
    known = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return F.try_element_at(known, folded)


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def key_or_missing(key: Column) -> Column:
    """A lookup key: null and the literal word share the key ``missing``."""
    return F.coalesce(key.cast("string"), F.lit("missing"))


def words(text: Column) -> Column:
    """Lower-case runs of at least two word characters, in text order."""
    return F.regexp_extract_all(F.lower(text_or_empty(text)), F.lit(f"({TOKEN})"), F.lit(1))


def bigrams(tokens: Column) -> Column:
    """Neighbouring tokens joined by one blank."""
    firsts = F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - 1, F.lit(0)))
    seconds = F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 1, F.lit(0)))
    return F.zip_with(firsts, seconds, lambda a, b: F.concat_ws(" ", a, b))
